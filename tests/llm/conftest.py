from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with the edge cases that every operator must take: nulls, empty, blank, long, ties, repeats."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(6000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s0"),
        (2, "alpha  beta\tgamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s0"),
        (3, None, None, None), (4, "", "en", "s1"), (5, " \n\t ", "de", "s1"), (6, long, "fr", "s0"), (7, long + " tail", "fr", "s0"),
        (8, "One two\nOne two\nthree", "en", "s2"), (8, "One two\nOne two\nthree", "en", "s2"), (None, "no id here but words enough to count as ten words", "en", "s3"),
        (9, "###$$$ %%% &&&", None, "s0"), (10, "Released under the MIT License.\nmail a.b@c.example 4417744280351547", "en", "s4"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="session")
def clashing(documents):
    """The same with more columns, some of which have names that the operators use inside."""
    from pyspark.sql import functions as F

    names = ["key", "node", "digest", "raw", "label", "bucket", "size", "cluster", "kept", "n", "score", "spans", "pairs", "features"]
    return documents.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
