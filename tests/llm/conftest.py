import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, row long, kept string, size string, name string"


def texts() -> list:
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(3, 120))) for _ in range(40)]
    long = " ".join(word() for _ in range(2600))
    near = base[0].split()
    out = [*base, base[1], base[1].replace(" ", "\n\t", 3), base[1] + " ", base[2].upper(), long, long, long[:-1] + "x", " ".join([*near, "tail"]), " ".join(["head", *near]), "", None, " ", "\x0b\f", "word", "two words", None, "", "Ünïcode 🙂 text", "<|endoftext|> marks", "A" * 5000, "\x00 nul"]
    return out


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and very long texts, copies, ties, repeated rows, and columns whose names clash with internal ones."""
    found = [(i, t, None if i % 7 == 3 else "en", None if i % 5 == 4 else f"s{i % 4}", None if i % 6 == 0 else len(t or ""), "x", 1, "k", "z", "n") for i, t in enumerate(texts())]
    return [*found, found[5], found[5]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
