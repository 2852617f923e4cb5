import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept int, batch string, part string, component_id string"


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "in", "er", "on", "re", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    """Rows with nulls, empty, short and long texts, repeated rows, copies, near copies and shared passages."""
    rng = random.Random(5)
    base = words(rng, 200).split()
    passage = words(rng, 60)
    texts = {k: words(rng, rng.randint(1, 150)) for k in range(1, 40)}
    for k in range(40, 60):
        copy = list(base)
        for i in rng.sample(range(200), rng.randint(0, 6)):
            copy[i] = f"w{k}x{i}"
        texts[k] = " ".join(copy)
    for k in range(60, 70):
        texts[k] = words(rng, rng.randint(0, 80)) + " " + passage + "\n" + words(rng, rng.randint(0, 80))
    texts |= {70: "", 71: " \n\t ", 72: "one two", 73: "One TWO", 74: "é ñ ÀB É", 75: texts[3], 76: texts[3], 77: words(rng, 3000), 78: "x", 79: "a b c d", 80: texts[79] if 79 in texts else "a b c d",
              81: "dup line\n" * 5 + words(rng, 30), 82: "same word " * 40, 83: " ".join(base[:120]), 84: "mail a.b@c-d.example.com, ip 10.0.0.1 phone +49 (30) 123-456-78 card 4111 1111 1111 1111"}
    rows = [(k, t, "en", f"src{k % 3}", len(t), "w", 1, "b", "p", "c") for k, t in texts.items()]
    rows += [(None, texts[5], None, None, None, None, None, None, None, None), (90, None, "en", "src0", 0, "w", 1, "b", "p", "c"), rows[6], rows[6]]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
