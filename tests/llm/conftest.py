import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, _k1 string"


def corpus() -> list[tuple]:
    """Rows with nulls, empty and long texts, copies, near copies, shared lines
    and passages, ties and repeated rows; columns that clash with results."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice(["an", "the", "or", "er", "ín", "st", "Be"]) for _ in range(rnd.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(rnd.randint(25, 120)) for _ in range(40)]
    passage = text(60)
    texts = [None, "", " \t\n ", "one", "a b", "x" * 5000, text(8000), "ab " * 900, "\n".join([base[0]] * 3)]
    texts += base + [base[1]] * 12 + [base[2] + " tail", base[3].replace("the", "THE")]
    texts += [f"{b}\nShared Line \n{passage}\n{text(9)}" for b in base[:14]] + ["shared line\n\nlast"]
    texts += [t[:-3] for t in base[20:26]]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or ""), i, "y", "z") for i, t in enumerate(texts)]
    rows += [(None, base[5], "en", "s1", 1, 0, None, None)] * 2 + [rows[12]] * 2 + [(None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
