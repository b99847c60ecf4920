import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
#: Columns that operators use for themselves, to be met in the input too.
CLASH = "key rep size shard digest comp same cell n class rank hash kept copies lang_pred __id prints points"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, blanks, ties, repeated rows, a long text and columns of clashing names."""
    rng = random.Random(4)
    long = prose(rng, 40_000)
    near = prose(rng, 200)
    rows = [
        (1, None, None, None), (2, "", "en", "b"), (3, " \n\t", None, "b"), (4, "Hello  World", "en", "a"), (5, "HelloWorld", "en", "a"), (6, "Hello World ", "de", "a"),
        (7, "Hello World", "en", None), (7, "Hello World", "en", None), (8, long, "en", "c"), (9, long + " x", "fr", "c"), (None, "orphan text here", "en", "c"), (None, None, None, None),
        (10, near, "en", "b"), (11, near + " tail", "en", "b"), (12, "ünï côdé ß 漢字 😀 end", "fr", "a"), (13, "one two", "en", "a"), (14, "12345 67890", None, "a"),
    ]
    rows += [(100 + i, prose(rng, 5 + i), "en", "hot") for i in range(20)]
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASH.split():
        df = df.selectExpr("*", f"1 AS {c}")
    return df


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


def rows_of(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
