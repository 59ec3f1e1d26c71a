"""Hand-written expectations for rules and scalar functions (FIXTURES section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from layerflow.functions import identity as ident
from layerflow.functions import text
from layerflow.functions.lease import remaining_lease
from layerflow.operators import groups, rules
from layerflow.plans import ledger
from layerflow.streaming.incremental import effective_window


def _col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def _eval(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def _passes(spark, values, rule_fn, dtype="string"):
    df = _col(spark, values, dtype)
    r = rule_fn("v")
    return _eval(df, F.coalesce(r.passes, F.lit(False)))


def test_date_rule(spark):
    got = _passes(spark, ["2012-1", "2012-01", "2012-13", "2012-001", "2012-01-05", None], rules.rule_date)
    assert got == [True, True, False, False, False, False]


def test_pattern_rule(spark):
    got = _passes(spark, ["04 TO 06", " 04 TO 06 ", "4 TO 6", "06 TO 04"], rules.rule_pattern)
    assert got == [True, True, False, True]


def test_bounds_rule(spark):
    got = _passes(spark, ["19.99", "20", "300", "300.01", "x", None], rules.rule_bounds)
    assert got == [False, True, True, False, False, False]


def test_cross_field_rule(spark):
    df = spark.createDataFrame([(0, 2012, "2012-01"), (1, 2013, "2012-01"), (2, None, "2012-01")],
                               "i int, y bigint, m string")
    r = rules.rule_not_after("y", "m")
    assert _eval(df, F.coalesce(r.passes, F.lit(False))) == [True, False, False]


def test_positive_rule(spark):
    assert _passes(spark, [0.0, 0.01, None], rules.rule_positive, "double") == [False, True, False]


def test_rare_category(spark):
    rows = ["a"] * 4 + ["b"] * 5 + ["  ", None]
    df = _col(spark, rows)
    r = rules.rule_rare("v", 5)
    out = groups.attach_frequency(df, ["v"], rules.FREQ_PREFIX)
    got = _eval(out, F.coalesce(r.passes, F.lit(False)))
    assert got == [False] * 4 + [True] * 5 + [False, False]


def test_error_list_keeps_rule_order(spark):
    df = spark.createDataFrame([(0, "2012-13", 0.0, 2030)], "i int, month string, resale_price double, lease bigint")
    rs = [rules.rule_date("month"), rules.rule_not_after("lease", "month"), rules.rule_positive("resale_price")]
    got = _eval(df, rules.error_list(rs))
    assert got == ["invalid_date, lease_commence_after_transaction, invalid_resale_price"]
    ok = spark.createDataFrame([(0, "2012-03", 1.0, 2000)], "i int, month string, resale_price double, lease bigint")
    assert _eval(ok, rules.error_list(rs)) == [None]


def test_iqr_fences(spark):
    df = spark.createDataFrame([("g", float(x)) for x in [1, 2, 3, 4, 100]], "g string, v double")
    b = groups.iqr_bounds(df, ["g"], "v").collect()[0]
    assert (b.q1, b.q3, b.lower, b.upper) == (2.0, 4.0, -1.0, 7.0)
    flagged = groups.iqr_flag(df, ["g"], "v").where("_outlier").select("v").collect()
    assert [r.v for r in flagged] == [100.0]


def test_iqr_null_group_never_flagged(spark):
    df = spark.createDataFrame([(None, float(x)) for x in [1, 2, 3, 4, 100]], "g string, v double")
    assert groups.iqr_flag(df, ["g"], "v").where("_outlier").count() == 0


def test_remaining_lease(spark):
    df = _col(spark, [1979, 1900, 2030, None], "bigint")
    y, m = remaining_lease("v", "2024-01-31")
    got = [tuple(r) for r in df.orderBy("i").select(y, m).collect()]
    assert got == [(53, 11), (0, 0), (104, 11), (None, None)]
    y1, m1 = remaining_lease("v", dt.date(2024, 1, 1))
    assert tuple(df.where("i = 0").select(y1, m1).collect()[0]) == (54, 0)


def test_identifier(spark):
    df = spark.createDataFrame([(0, "2015-03", " ang mo kio", "12A45", 345678.9)],
                               "i int, month string, town string, block string, mean double")
    parts = [ident.digits_prefix("block"), ident.mean_prefix("mean"), ident.month_digits("month"), ident.initial("town")]
    rid = ident.build_identifier(parts)
    row = df.select(rid.alias("id"), ident.identifier_valid(parts, rid).alias("ok")).collect()[0]
    assert (row.id, row.ok) == ("S1243403A", True)


def test_identifier_parts(spark):
    df = spark.createDataFrame([(0, "5", 5.5), (1, "ABC", 5.5)], "i int, block string, mean double")
    got = [tuple(r) for r in df.orderBy("i").select(ident.digits_prefix("block"), ident.mean_prefix("mean")).collect()]
    assert got == [("005", "05"), (None, "05")]
    m = spark.createDataFrame([(0, "2015-3"), (1, "2015-003"), (2, "2015")], "i int, m string")
    assert _eval(m, ident.month_digits("m")) == ["03", "003", None]


def test_sha256(spark):
    df = _col(spark, ["a|b"])
    assert _eval(df, ident.sha256("v")) == ["0eab8a0a3380abf4c7d1fb0b43b66aafbb64a4b953e4eb2dccca579461912d0c"]


def test_surrogate_key_null_differs_from_empty(spark):
    df = spark.createDataFrame([(0, "x", None), (1, "x", "")], "i int, a string, b string")
    k = _eval(df, ident.surrogate_key(["a", "b"]))
    assert k[0] != k[1]


def test_reconcile():
    assert ledger.reconcile(41, 1, 42, "cleaned", "raw")[0] == ledger.SUCCEEDED
    status, reason = ledger.reconcile(40, 1, 42, "cleaned", "raw")
    assert status == ledger.MISMATCH and "1 row(s) unaccounted" in reason
    assert ledger.reconcile(40, 1, None, "cleaned", "raw")[0] == ledger.SUCCEEDED


def test_effective_window():
    full = (dt.date(2012, 1, 1), dt.date(2016, 12, 31))
    assert effective_window("FULL", "2014-03-10", "2012-01-01", "2016-12-31") == full
    assert effective_window("MERGE", "1900-01-01 00:00:00", "2012-01-01", "2016-12-31") == full
    assert effective_window(" merge ", "2014-03-10T00:00:00", "2012-01-01", "2016-12-31", 7) == (
        dt.date(2014, 3, 3), dt.date(2016, 12, 31))


def test_text_helpers(spark):
    df = _col(spark, ["  ang mo kio\t", None])
    assert _eval(df, text.normalize("v")) == ["ANG MO KIO", None]
    e = _col(spark, ['{"ErrorMessage": "boom"}', "plain"])
    assert _eval(e, text.clean_error("v")) == ["boom", "plain"]
    n = spark.createDataFrame([(0, "Ang Mo-Kio 2", "d1"), (1, "--", "d2")], "i int, n string, id string")
    assert _eval(n, text.sanitize_name("n", "id")) == ["AngMoKio2", "d2"]


def test_distributed_quartiles_equal_percentile(spark):
    """A single hot group spread over partitions gives the same quartiles as ``percentile``."""
    big = spark.range(50000).select(F.lit("hot").alias("g"), (F.col("id") % 997 * 1.5).alias("v"))
    small = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    df = big.unionByName(small)
    exact = {r.g: (r.q1, r.q3) for r in groups.iqr_bounds(df, ["g"], "v", method="percentile").collect()}
    dist = {r.g: (r.q1, r.q3) for r in groups.iqr_bounds(df, ["g"], "v", method="distributed").collect()}
    assert exact.keys() == dist.keys()
    for k in exact:
        assert all(abs(a - b) < 1e-9 for a, b in zip(exact[k], dist[k]))
    auto = groups.iqr_bounds(df, ["g"], "v", hot_rows=1000).collect()  # forces the distributed form
    assert {r.g: (r.q1, r.q3) for r in auto}.keys() == exact.keys()
    # per-partition tables too large to broadcast: sort-merge joins on (group, partition)
    merged = {r.g: (r.q0, r.q1) for r in groups.exact_quantiles(df, ["g"], "v", [0.25, 0.75], max_rows=0).collect()}
    assert merged.keys() == exact.keys()
    for k in exact:
        assert all(abs(a - b) < 1e-9 for a, b in zip(exact[k], merged[k]))


def test_quartile_forms_agree_bit_for_bit(spark):
    """Random doubles in groups of many sizes, one without a name: no fence depends on the form."""
    import random

    from layerflow.operators import profile

    rng = random.Random(7)
    data = [(g or None, rng.uniform(-1, 1) * 10 ** rng.randint(-3, 9)) for g in range(97) for _ in range(rng.randint(1, 40))]
    data += [(None, None), (97, None), (98, float("inf")), (98, 1.0), (99, 2.5), (99, 2.5)]
    df = spark.createDataFrame(data, "g bigint, v double").repartition(5)

    def bits(bounds):
        return {r[0]: tuple(x.hex() for x in r[1:]) for r in bounds.collect()}

    want = bits(groups.iqr_bounds(df, ["g"], "v", method="percentile"))
    assert len(want) == 99 and None in want
    assert bits(groups.iqr_bounds(df, ["g"], "v", method="distributed")) == want
    assert bits(groups.iqr_bounds(df, ["g"], "v", hot_rows=3)) == want
    narrow = {k: v[:2] for k, v in want.items()}
    assert bits(groups.exact_quantiles(df, ["g"], "v", [0.25, 0.75], max_rows=0)) == narrow
    exact, dist = (profile.profile_numeric(df, ["g", "v"], method=m).select("column", "q1", "median", "q3") for m in ("percentile", "distributed"))
    assert bits(exact) == bits(dist)
    # decimals that are one double: cast before they are ranked, in both forms
    close = spark.range(40).select(F.lit(1).alias("g"), (F.lit("1234567890123456789.0").cast("decimal(24,3)") + F.col("id") * F.lit("0.001").cast("decimal(4,3)")).alias("v"))
    assert bits(groups.iqr_bounds(close, ["g"], "v", method="percentile")) == bits(groups.iqr_bounds(close, ["g"], "v", method="distributed"))


def test_profile_numeric_distributed_equals_percentile(spark):
    """Column quartiles without one task per column match the one-pass ``percentile``."""
    from layerflow.operators import profile

    df = spark.range(40000).select((F.col("id") % 1013 * 0.25).alias("a"), (F.col("id") * 3 % 7).alias("b"),
                                   F.lit(None).cast("double").alias("c"))
    cols = ["a", "b", "c"]
    one = {r.column: tuple(r)[1:] for r in profile.profile_numeric(df, cols, method="percentile").collect()}
    dist = {r.column: tuple(r)[1:] for r in profile.profile_numeric(df, cols, method="distributed").collect()}
    auto = profile.profile_numeric(df, cols, hot_values=100)  # forces the distributed form
    assert auto.columns == profile.profile_numeric(df, cols, method="percentile").columns
    assert one.keys() == dist.keys() == {"a", "b", "c"}
    for k in one:
        for x, y in zip(one[k], dist[k]):
            assert (x is None and y is None) or abs(x - y) < 1e-9, (k, one[k], dist[k])
    assert {r.column for r in auto.collect()} == set(cols)


def test_profile_report_written_and_read_back(spark, scratch):
    """Every profile frame is written as JSON and reads back with the same rows."""
    import os

    from layerflow.operators import profile

    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    frames = profile.profile_report(df, ["p_brand", "p_type", "p_name"], ["p_size", "p_retailprice"],
                                    ["p_brand", "p_name"], ["p_partkey"], name="part")
    out = os.path.join(scratch, "profile")
    profile.write_profile(frames, out)
    for name, frame in frames.items():
        back = spark.read.json(os.path.join(out, name))
        assert back.count() == frame.count(), name
        if name in profile.BOUNDED_FRAMES:
            assert len([f for f in os.listdir(os.path.join(out, name)) if f.endswith(".json")]) <= 1, name


def test_month_window_starts_with_the_month():
    assert effective_window("MERGE", "2014-03-10", "2012-01-01", "2016-12-31", 7, months=True)[0] == dt.date(2014, 3, 1)
    assert effective_window("MERGE", "2014-03-05", "2012-01-01", "2016-12-31", 7, months=True)[0] == dt.date(2014, 2, 1)


def test_month_range_up_to_the_last_year(spark):
    from layerflow.operators.filters import date_range
    df = spark.createDataFrame([("2012-01",), ("2016-9",), ("9999-12",), ("bad",)], "month string")
    for end in ("9999-12-31", "2016-12-31"):
        a, b = (sorted(r.month for r in date_range(df, "month", "2000-01-01", end, prune=p).collect()) for p in (True, False))
        assert a == b and len(a) == (3 if end[0] == "9" else 2)
