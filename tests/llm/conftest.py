import random

import pytest

EXTRA = "label int, features string, fp long, row long, h long, score double, text_ string, r string, t int, n_words long, tokens long, component_id string"


def documents_of(spark, rows):
    """documents with extra columns whose names the operators use inside."""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    full = [(i, t, "en", "src0", None if t is None else len(t), None, "f", 1, 2, 3, 0.5, "x", "y", 4, 5, 6, "z") for i, t in rows]
    return spark.createDataFrame(full, schema)


SYLLABLES = ["ta", "ri", "mo", "ne", "lu", "ks", "es", "on", "ing", "é"]


def prose(rng, n):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


@pytest.fixture(scope="session")
def texts():
    """Texts with the awkward cases first."""
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (4, "one"), (None, "no id"), (None, None),
            (5, "日本語 テキスト é\x1c x"), (6, "a" * 70_000), (7, "ab " * 20_000), (8, "Same line\nSame line\nother words here\nSame line"),
            (9, "<|endoftext|> x <|endoftext|>")]
    rows += [(10 + k, prose(rng, rng.randint(3, 200))) for k in range(60)]
    rows += [(100 + k, rows[20][1] + (" end" if k % 2 else "")) for k in range(12)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return documents_of(spark, texts).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents_of(spark, [])


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def as_docs(spark):
    return lambda rows: documents_of(spark, rows)
