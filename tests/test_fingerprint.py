"""Multiset fingerprints against counted rows."""

from __future__ import annotations

import random
from collections import Counter

from layerflow.operators.setops import fingerprint_check, unbalanced_rows

SCHEMA = "a string, b string, n double"


def _told(spark, source, kept, rejected):
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (source, kept, rejected)]
    one = fingerprint_check(*frames).collect()
    assert len(one) == 1 and tuple(one[0])[:3] == (len(source), len(kept), len(rejected))
    found = {tuple(r)[:3]: r.missing - r.extra for r in unbalanced_rows(*frames).collect()}
    want = Counter(source)
    want.subtract(Counter(kept + rejected))
    assert found == {k: v for k, v in want.items() if v}
    assert one[0].balanced == (not found)
    return one[0].balanced


def test_balance_and_named_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "", None]), rng.choice(["x", "y", None]), rng.choice([0.5, None])) for _ in range(60)]
    assert _told(spark, rows, rows[:20], rows[20:])
    assert not _told(spark, rows, rows[:20], rows[21:])                       # one lost
    assert not _told(spark, rows, rows[:20], rows[20:-1] + [("z", "z", 1.0)])  # as many rows, one of them another
    # a null's place counts
    assert not _told(spark, [("x", None, 1.0)], [(None, "x", 1.0)], [])
    # two copies for one, and one for two
    assert not _told(spark, [("p", "q", 1.0)] * 2 + [("r", "s", 1.0)], [("p", "q", 1.0)], [("r", "s", 1.0)] * 2)
    assert _told(spark, [], [], [])


def test_no_row_is_shuffled(spark, capsys):
    df = spark.createDataFrame([("x", "y", 1.0)], SCHEMA)
    fingerprint_check(df, df, df.limit(0)).explain()
    plan = capsys.readouterr().out
    assert "partial_sum" in plan and "hashpartitioning(a" not in plan and "Join" not in plan
