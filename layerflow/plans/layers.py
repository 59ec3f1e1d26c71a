"""One plan per layer: tag every input row once, then split.

Each ``tag_*`` function returns *all* input rows with an ``_outcome``
column: NULL for a kept row, else the reject reason. Writing that one
frame (see ``plans.run``) gives the kept layer, the quarantine rows and
the counts for the gate from a single DAG; ``kept`` and ``rejected`` are
two filters over it.

Order inside the cleaned layer: surrogate key on the raw text, normalise,
rules, best row per key among passing rows, remaining lease, price
outliers among the kept rows. Transformed: group mean per
(month, town, flat type), identifier, validity, best row per identifier.
Hashed: missing identifier, sha256.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions import identity as ident
from layerflow.functions.lease import remaining_lease
from layerflow.functions.text import month_date, normalize_text
from layerflow.operators import groups
from layerflow.operators import dedup
from layerflow.operators.dedup import ROW_ID, dedup_tag
from layerflow.operators.rules import FREQ_PREFIX, Rule, resale_rules, validate
from layerflow.schema import NATURAL_KEY, PRICE

# Reject reasons and stage names.
FIELD_FAILED = "field_validation_failed"
DUPLICATE_LOWER_PRICE = "duplicate_key_lower_price"
PRICE_OUTLIER = "anomalous_price_iqr_outlier"
INCOMPLETE_IDENTIFIER = "incomplete_resale_identifier"
MISSING_IDENTIFIER = "missing_resale_identifier"
OUTSIDE_RANGE = "outside_date_range"
BLANK_ROW = "blank_row"
REASONS = (FIELD_FAILED, DUPLICATE_LOWER_PRICE, PRICE_OUTLIER, INCOMPLETE_IDENTIFIER, MISSING_IDENTIFIER, OUTSIDE_RANGE, BLANK_ROW)
STAGES = ["source", "raw", "cleaned", "transformed", "hashed"]
NORMALIZED_COLUMNS = ["town", "street_name", "flat_model"]
DATE_RANGE_START = "2012-01-01"
DATE_RANGE_END = "2016-12-31"

OUTCOME = "_outcome"
ERRORS = "_validation_errors"
VALID_ID = "_identifier_valid"
IDENTIFIER = "resale_identifier"
IDENTIFIER_HASH = "resale_identifier_hash"
SURROGATE = "surrogate_key"
INTERNAL = [OUTCOME, ERRORS, VALID_ID, ROW_ID, "_is_winner", "_outlier", "_group_mean"]


@dataclass
class LayerSpec:
    """Column roles and parameters of one dataset's layers."""
    natural_key: list[str] = field(default_factory=lambda: list(NATURAL_KEY))
    price: str = PRICE
    tiebreak: list[str] = field(default_factory=list)   # after price, all descending
    lineage: list[str] = field(default_factory=list)    # carried, never part of a key
    normalize: list[str] = field(default_factory=lambda: list(NORMALIZED_COLUMNS))
    category_k: int = 5
    outlier_keys: list[str] = field(default_factory=lambda: ["town", "flat_type"])
    mean_keys: list[str] = field(default_factory=lambda: ["month", "town", "flat_type"])
    as_of: dt.date | str | None = None                  # remaining-lease date; None = today
    quantile_accuracy: int | None = None                # None = exact quartiles
    hot_group_rows: int = groups.HOT_GROUP_ROWS         # above this, quartiles are computed distributed
    month_col: str = "month"
    partition_by: str | None = None                     # e.g. "month": merges rewrite touched months only
    range_start: str = DATE_RANGE_START
    range_end: str = DATE_RANGE_END

    def rules(self) -> list[Rule]:
        return resale_rules(self.category_k)

    def dedup_key(self, columns: list[str]) -> list[str]:
        """All columns but price, surrogate key, lineage and ``_`` columns."""
        skip = {self.price, SURROGATE, *self.lineage}
        return [c for c in columns if c not in skip and not c.startswith("_")]


def _first_reason(*pairs: tuple[Column, str]) -> Column:
    expr = None
    for cond, reason in pairs:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


# ---------------------------------------------------------------- raw

def in_range(df: DataFrame, spec: LayerSpec) -> Column:
    """Month parses and lies within [range start, range end]."""
    m = month_date(spec.month_col)
    return m.isNotNull() & (m >= F.lit(spec.range_start).cast("date")) & (m <= F.lit(spec.range_end).cast("date"))


def all_null(df: DataFrame) -> Column:
    """Every column NULL."""
    cond = F.lit(True)
    for c in df.columns:
        if c.startswith("_"):
            continue
        cond = cond & F.col(c).isNull()
    return cond


def raw_rows(source: DataFrame, spec: LayerSpec) -> DataFrame:
    """Rows of the source in the month range, fully blank rows removed."""
    return source.where(in_range(source, spec) & ~all_null(source))


# ---------------------------------------------------------------- cleaned

Reuse = Callable[[DataFrame], DataFrame]


def _same(df: DataFrame) -> DataFrame:
    return df


def tag_cleaned(raw: DataFrame, spec: LayerSpec, reuse: Reuse = _same, check_small: bool = False,
                counts: dict[str, DataFrame] | None = None) -> DataFrame:
    """All raw rows with surrogate key, normalised text, lease and ``_outcome``.

    ``raw`` brings its row ids; the rows themselves are read again by each
    consumer and never copied. ``reuse`` is applied to the narrow frames with
    more than one consumer (category counts, ids and prices of the passing
    rows, the few rows whose key may repeat); the runner writes them once to
    the staging folder. ``check_small`` counts per-group tables before
    broadcasting them. ``counts`` gives the category frequencies when ``raw``
    is only a part of the rows that they are counted over.
    """
    keyed = raw.withColumn(SURROGATE, ident.surrogate_key(spec.natural_key))
    normed = normalize_text(keyed, spec.normalize)
    rules = spec.rules()
    if counts is None:
        cats = list(dict.fromkeys(r.frequency_of for r in rules if r.frequency_of))
        counted = reuse(groups.value_counts(normed, cats))
        counts = {c: counted.where(F.col("column") == c).select(F.col("value").alias("v"), F.col("count").alias(f"{FREQ_PREFIX}{c}"))
                  for c in cats}
    checked = validate(normed, rules, ERRORS, counts)
    passed = F.col(ERRORS).isNull()

    key = spec.dedup_key(raw.columns)
    order = [spec.price, *spec.tiebreak]
    price = F.col(spec.price).alias(f"_w_{spec.price}")
    prices = reuse(checked.where(passed).select(ROW_ID, F.xxhash64(*key).alias("_kh"), *spec.outlier_keys, price))
    lost = reuse(dedup.losers(checked.where(passed), prices, key, order, ROW_ID, "_kh", reuse, check_small))
    deduped = groups.join_small(checked, lost.withColumn("_lost", F.lit(True)), [ROW_ID], check=check_small)
    survivor = passed & F.col("_lost").isNull()

    bounds = groups.iqr_bounds(groups.join_small(prices, lost, [ROW_ID], how="left_anti", check=check_small),
                               spec.outlier_keys, f"_w_{spec.price}", accuracy=spec.quantile_accuracy, hot_rows=spec.hot_group_rows)
    # written once: the broadcast check counts the written table instead of recomputing the quartiles
    bounds = reuse(bounds.select(*spec.outlier_keys, "lower", "upper"))
    flagged = (groups.join_small(deduped, bounds, spec.outlier_keys, check=check_small)
               .withColumn("_outlier", survivor & groups.outside(spec.price)))

    years, months = remaining_lease("lease_commence_date", spec.as_of)
    return (flagged
            .withColumn("remaining_lease_years", F.when(survivor, years))
            .withColumn("remaining_lease_months", F.when(survivor, months))
            .withColumn(OUTCOME, _first_reason(
                (~passed, FIELD_FAILED),
                (~survivor, DUPLICATE_LOWER_PRICE),
                (F.col("_outlier"), PRICE_OUTLIER)))
            .drop("lower", "upper", "_lost", "_outlier"))


# ---------------------------------------------------------------- transformed

def identifier_parts(df: DataFrame, spec: LayerSpec, check_small: bool = False,
                     reuse: Reuse = _same) -> DataFrame:
    """Rows plus the four identifier parts (L3-L6) and the group mean.

    The means table goes through ``reuse`` (written once by the runner), so
    the broadcast check and the join read it instead of averaging twice.
    """
    means = reuse(groups.group_mean(df, spec.mean_keys, spec.price, "_group_mean"))
    j = groups.join_small(df, means, spec.mean_keys, check=check_small)
    return j.select(
        "*",
        ident.digits_prefix("block", 3).alias("block_part"),
        ident.mean_prefix("_group_mean", 2).alias("price_part"),
        ident.month_digits(spec.month_col).alias("month_part"),
        ident.initial("town").alias("town_part"),
    )


def tag_transformed(cleaned: DataFrame, spec: LayerSpec, reuse: Reuse = _same,
                    check_small: bool = False) -> DataFrame:
    """All cleaned rows with ``resale_identifier``, ``_identifier_valid`` and ``_outcome``."""
    with_id = with_identifier(cleaned, spec, check_small, reuse)
    order = [spec.price, *spec.tiebreak, F.unhex(SURROGATE)]  # the digest's bytes order like its hex text, in half the space
    return identifier_outcome(dedup_tag(with_id, [IDENTIFIER], order, ROW_ID, flag="_is_winner", eligible=F.col(VALID_ID),
                                        reuse=reuse, check_small=check_small))


def with_identifier(cleaned: DataFrame, spec: LayerSpec, check_small: bool = False, reuse: Reuse = _same) -> DataFrame:
    """Cleaned rows with ``resale_identifier`` and ``_identifier_valid``."""
    parts = identifier_parts(cleaned, spec, check_small, reuse)
    pcols = [F.col("block_part"), F.col("price_part"), F.col("month_part"), F.col("town_part")]
    return (parts.withColumn(IDENTIFIER, ident.build_identifier(pcols))
            .withColumn(VALID_ID, ident.identifier_valid(pcols, F.col(IDENTIFIER)))
            .drop("block_part", "price_part", "month_part", "town_part", "_group_mean"))


def identifier_outcome(deduped: DataFrame) -> DataFrame:
    """Rows with ``_outcome`` from their identifier's validity and the best-row flag."""
    return (deduped.withColumn(OUTCOME, _first_reason(
                (~F.col(VALID_ID), INCOMPLETE_IDENTIFIER),
                (~F.col("_is_winner"), DUPLICATE_LOWER_PRICE)))
            .drop("_is_winner"))


# ---------------------------------------------------------------- hashed

def tag_hashed(transformed: DataFrame) -> DataFrame:
    """All transformed rows with ``resale_identifier_hash`` and ``_outcome``; identifier dropped."""
    gone = ident.missing(IDENTIFIER)
    return (transformed
            .withColumn(IDENTIFIER_HASH, F.when(~gone, ident.sha256(IDENTIFIER)))
            .withColumn(OUTCOME, F.when(gone, F.lit(MISSING_IDENTIFIER))))


# ---------------------------------------------------------------- split

def kept(tagged: DataFrame, keep_row_id: bool = False) -> DataFrame:
    """Rows without an outcome, internal columns removed.

    ``keep_row_id`` keeps ``_rid`` so that a lazy chain can feed the next layer.
    """
    out = tagged.where(F.col(OUTCOME).isNull())
    drop = [c for c in INTERNAL if c in tagged.columns and not (keep_row_id and c == ROW_ID)]
    return out.drop(*drop)


def rejected(tagged: DataFrame, stage: str) -> DataFrame:
    """Rows with an outcome, tagged as quarantine rows (B11 shape, no time yet)."""
    out = tagged.where(F.col(OUTCOME).isNotNull())
    return (out.withColumn("_failure_reason", F.col(OUTCOME))
            .withColumn("_failed_stage", F.lit(stage))
            .drop(*[c for c in [OUTCOME, ROW_ID] if c in out.columns]))


def layer_chain(source: DataFrame, spec: LayerSpec) -> dict[str, DataFrame]:
    """Lazy tagged frames of every layer, each feeding the next (no writes)."""
    raw = raw_rows(source, spec)
    cleaned_tag = tag_cleaned(raw, spec)
    transformed_tag = tag_transformed(kept(cleaned_tag, keep_row_id=True), spec)
    hashed_tag = tag_hashed(kept(transformed_tag, keep_row_id=True))
    return {"raw": raw, "cleaned": cleaned_tag, "transformed": transformed_tag, "hashed": hashed_tag}
