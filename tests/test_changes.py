"""Change classes and histories against a plain replay."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from layerflow.operators import changes

SCHEMA = "a string, b int, price double, note string, seen int"
KEY, WATCHED = ["a", "b"], ["price", "note"]


def _batch(rng, t):
    keys = [(a, b) for a in "xyz" for b in range(4)]
    return [(a, b, rng.choice([1.0, 2.0, None]), rng.choice(["p", "", None]), t) for a, b in rng.sample(keys, 8)]


def _replay(batches, whole):
    """key -> versions [values, from, to], one batch after another; and the classes of each batch."""
    held, classes = {}, []
    for t, rows in batches:
        told, now = {}, {(r[0], r[1]) for r in rows}
        for r in rows:
            versions = held.setdefault((r[0], r[1]), [])
            last = versions[-1] if versions and versions[-1][2] is None else None
            told[r[:2]] = "inserted" if last is None else "unchanged" if last[0][2:4] == r[2:4] else "changed"
            if told[r[:2]] == "changed":
                last[2] = t
            if told[r[:2]] != "unchanged":
                versions.append([r, t, None])
        for k, versions in held.items():
            if whole and k not in now and versions[-1][2] is None:
                versions[-1][2] = t
                told[k] = "deleted"
        classes.append(told)
    return sorted(((*v, f, e) for vs in held.values() for v, f, e in vs), key=repr), classes


def _check(spark, whole):
    rng = random.Random(7)
    batches = [(t, _batch(rng, t)) for t in (10, 20, 30)]
    want, classes = _replay(batches, whole)
    history = None
    for (t, rows), told in zip(batches, classes, strict=True):
        df = spark.createDataFrame(rows, SCHEMA)
        if history is None:
            history = changes.open_history(df, F.lit(t))
            continue
        found = changes.classify_changes(changes.as_of(history, F.lit(t)), df, KEY, WATCHED, whole)
        assert {(r.a, r.b): r[changes.CHANGE] for r in found.collect()} == told
        history = changes.apply_changes(history, df, KEY, WATCHED, F.lit(t), whole)
        again = changes.apply_changes(history, df, KEY, WATCHED, F.lit(t), whole)
        assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, history.collect()), key=repr)
    assert sorted(map(tuple, history.collect()), key=repr) == want


def test_partial_batches(spark):
    _check(spark, whole=False)


def test_whole_batches_close_what_they_lack(spark):
    _check(spark, whole=True)


def test_corrected_batch_empty_batch_and_null_keys(spark):
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    history = changes.open_history(df([("x", 1, 1.0, None, 0)]), F.lit(1))
    # null and empty text are different values; a second version of the same time replaces the first
    one = changes.apply_changes(history, df([("x", 1, 1.0, "", 0)]), KEY, WATCHED, F.lit(2))
    two = changes.apply_changes(one, df([("x", 1, 3.0, "", 0)]), KEY, WATCHED, F.lit(2))
    assert sorted(map(tuple, two.collect())) == [("x", 1, 1.0, None, 0, 1, 2), ("x", 1, 3.0, "", 0, 2, None)]
    assert changes.apply_changes(two, df([]), KEY, WATCHED, F.lit(3)).count() == 2
    # a null key matches nothing: it is inserted every time
    nulls = df([(None, 1, 1.0, "n", 0)])
    assert [r[changes.CHANGE] for r in changes.classify_changes(nulls, nulls, KEY, WATCHED).collect()] == ["inserted"]


def test_a_history_is_read_once(spark, capsys):
    df = spark.createDataFrame([("x", 1, 1.0, None, 0)], SCHEMA)
    changes.apply_changes(changes.open_history(df, F.lit(1)), df, KEY, WATCHED, F.lit(2)).explain()
    assert capsys.readouterr().out.count("Join") == 1
