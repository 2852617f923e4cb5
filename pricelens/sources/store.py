"""Stage-boundary tables: derived inputs written once as Parquet and re-read.

The price panel and the daily weather signal are aggregates of the large
fact tables.  Like the reference's stage CSVs, they are written once per
input snapshot to the shared folder named by ``spark.checkpoint.dir`` and
every later query reads the small Parquet table instead of re-joining the
fact tables.  The written table also cuts lineage: a lost executor
recomputes from it, not from the raw scans.

The key of a stored table is the path, size and modification time of every
input file and a hash of the package code, so a changed input or changed code
is never served from a stale table.  A table is written under a unique name and
published by a rename, so readers and other writers never see half of one.
Set ``pricelens.materialize=false`` to plan everything from the raw scans.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from pricelens.session import checkpoint_dir


_CODE_HASH: list = []


def _code_hash() -> str:
    """Hash of the package sources: a code change never reuses an old table."""
    if not _CODE_HASH:
        h = hashlib.sha1()
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        outer = os.path.dirname(root)
        if os.path.isdir(root):
            for d, _, files in sorted(os.walk(root)):
                for f in sorted(files):
                    if f.endswith(".py"):
                        with open(os.path.join(d, f), "rb") as fh:
                            h.update(fh.read())
        elif zipfile.is_zipfile(outer):  # the package runs from an archive
            with zipfile.ZipFile(outer) as z:
                for f in sorted(n for n in z.namelist() if n.endswith(".py")):
                    h.update(z.read(f))
        else:
            raise OSError(f"the package sources are neither a folder nor an archive: {root}")
        _CODE_HASH.append(h.hexdigest())
    return _CODE_HASH[0]


def _fs(spark: SparkSession, path: str):
    """(file system, Hadoop path): local and remote stores are treated alike."""
    jp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jp


def _fingerprint(spark: SparkSession, paths) -> str:
    """Code hash + (path, size, modification time) of every input file.

    An input whose status cannot be read raises: nothing is served by name alone.
    """
    h = hashlib.sha1(_code_hash().encode())
    for p in sorted(paths):
        fs, jp = _fs(spark, p)
        files = fs.listFiles(jp, True)
        seen = []
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("\n".join([p, *sorted(seen)]).encode())
    return h.hexdigest()[:16]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing will read again (a consumed landing)."""
    fs, jp = _fs(spark, path)
    fs.delete(jp, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, jp = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(jp)) if fs.exists(jp) else []


def _exists(spark: SparkSession, path: str, mark: str = "_SUCCESS") -> bool:
    fs, jp = _fs(spark, f"{path}/{mark}")
    return fs.exists(jp)


def _publish(spark: SparkSession, built: str, path: str, mark: str = "_SUCCESS") -> None:
    """Move a finished table to its place; a table that another job published first stays."""
    fs, src = _fs(spark, built)
    _, dst = _fs(spark, path)
    if not _exists(spark, path, mark) and not fs.rename(src, dst) and not _exists(spark, path, mark):
        raise OSError(f"cannot publish {built} as {path}")
    if fs.exists(src):
        fs.delete(src, True)
    # a rename onto a folder that appeared meanwhile puts the table inside it
    _, inner = _fs(spark, f"{path}/{built.rsplit('/', 1)[-1]}")
    if fs.exists(inner):
        fs.delete(inner, True)


_LOCKS: dict = {}
_LOCKS_GUARD = threading.Lock()


def materialized(spark: SparkSession, name: str, inputs, build) -> DataFrame:
    """Return ``build()`` as a stored Parquet table (written on first use).

    Queries built from several driver threads share one build per table.
    """
    if spark.conf.get("pricelens.materialize", "true").lower() != "true":
        return build()
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_tables/{name}_{_fingerprint(spark, inputs)}"
    if not _exists(spark, path):
        with _LOCKS_GUARD:
            lock = _LOCKS.setdefault(path, threading.Lock())
        with lock:
            if not _exists(spark, path):
                built = f"{path}.{uuid.uuid4().hex}"
                build().write.parquet(built)
                _publish(spark, built, path)
    return spark.read.parquet(path)


def materialized_model(spark: SparkSession, name: str, inputs, fit, load=None):
    """``fit()``'s model, fitted once per input snapshot, saved with its ``save(path)`` and read by
    ``load(spark, path)`` in every query.  The mark is written last, so half a model is never read."""
    if spark.conf.get("pricelens.materialize", "true").lower() != "true":
        return fit()
    if load is None:
        from pricelens.ml.grouped_trees import TreeModel
        load = TreeModel.load
    mark = "meta/_SUCCESS"
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_models/{name}_{_fingerprint(spark, inputs)}"
    if not _exists(spark, path, mark):
        with _LOCKS_GUARD:
            lock = _LOCKS.setdefault(path, threading.Lock())
        with lock:
            if not _exists(spark, path, mark):
                built = f"{path}.{uuid.uuid4().hex}"
                fit().save(built)
                _publish(spark, built, path, mark)
    return load(spark, path)
