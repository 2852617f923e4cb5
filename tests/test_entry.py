"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_contract(spark):
    e = _entry_module()
    df = e.entry(spark)
    assert df.count() > 0 and "crisis_score" in df.columns
    q, s = e.queries(), e.oracle_sql()
    assert len(q) >= 100 and set(s) <= set(q)
    assert all(callable(f) for f in q.values()) and all(isinstance(x, str) and x.strip() for x in s.values())
    bad = [n for n in q if not n.replace("_", "").isalnum() or n.lower() != n]
    assert not bad


def test_cli_list(capsys):
    from pricelens.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert len(out) >= 100 and out[0].count("\t") == 2


def test_a_broken_optional_module_leaves_the_rest(monkeypatch, capsys):
    import importlib

    import __spark_entry__ as entry
    real = importlib.import_module

    def broken(name, *a):
        if name == "pricelens.llm.queries":
            raise SyntaxError("broken")
        return real(name, *a)
    monkeypatch.setattr(entry.importlib, "import_module", broken)
    names = entry.queries()
    assert "crisis_scores" in names and not any(n.startswith("op") and n[2:3].isdigit() for n in names)
    assert "cannot be imported" in capsys.readouterr().err
    assert "crisis_scores" in entry.oracle_sql()
