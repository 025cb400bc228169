from __future__ import annotations

import pytest

CASES = [
    # doc_id, text, lang, source
    (1, "the cat sat on the mat and looked at the dog who slept", "en", "a"),
    (2, "the cat sat on the mat and looked at the dog who slept", "en", "a"),
    (3, "THE cat\tsat on  the mat and\nlooked at the dog who slept ", "en", None),
    (4, "", "en", "b"),
    (5, None, None, "b"),
    (6, "word", "de", "b"),
    (7, "12 34 !?", None, "c"),
    (8, "mail me at jo.doe@example.org or +1 (555) 010-9999, card 4111 1111 1111 1111, ip 10.0.0.255", "en", "c"),
    (9, "x" * 30_000 + " " + "lang und breit " * 3_000, "de", "d"),
    (10, "el perro y la casa", "es", ""),
    (None, "a row without an id that is not empty", "en", "a"),
    (11, "a repeated row of some words", "en", "a"),
    (11, "a repeated row of some words", "en", "a"),
    (12, "ein anderes wort", None, None),
]
EXTRA = "size n id key shard score range start place block first label bands component keep doc most fall copy times v"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and other columns with names used inside."""
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in CASES]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in EXTRA.split():
        df = df.selectExpr("*", f"'other' as `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def table_of(spark):
    def make(name, sf="sf0.001"):
        return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")

    return make
