import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the river stone field under seven lamps a quiet morning of green wind over old houses and little boats".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) + rng.choice(["", "s", "ly", "er"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, odd characters."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 12, 40, 80, 200)]
    rows = [
        (None, None, None, None, None), (0, None, "en", "a", 0), (1, "", "en", "a", 0), (2, "", None, "b", 0),
        (3, " \n\t ", "de", None, 4), (4, "one", "en", "a", 3), (5, base[2], "en", "a", 1), (5, base[2], "en", "a", 1),
        (6, base[2] + " end", "fr", "b", 1), (None, base[3], "en", "a", 1), (7, base[3], "en", "a", 1),
        (8, prose(rng, 12_000), "en", "c", 1), (9, "x" * 30_000, "en", "c", 1), (10, "é" * 50 + "́ Ünï 漢字 \U0001f600 " * 9, "es", "c", 1),
        (11, "a\x1cb c d e <|endoftext|> f\u0085g", "en", "a", 1),
        (12, "\n".join(["same line here now"] * 6 + ["other"]), "en", "a", 1), (13, "of of of of of of of of of of of of of", "en", "a", 1),
    ]
    rows += [(100 + i, prose(rng, rng.randint(5, 90)), rng.choice(["en", "de", None]), rng.choice("abc"), i) for i in range(40)]
    rows += [(200 + i, base[4], "en", "hot", 1) for i in range(30)]
    rows += [(300 + i, base[4].replace(" the ", " its ", i) + " tail" * (i % 2), "en", "hot", 1) for i in range(6)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def clashing(df, names=("h", "cls", "size", "label", "pid", "c", "k", "path", "weight", "tokens", "score", "leaf", "host")):
    """``df`` with extra columns under names that operators might use."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
