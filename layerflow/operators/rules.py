"""Row validation rules.

A rule is a name plus a boolean Column that is true when the row passes.
Rules are plain Column expressions, so users add their own without UDFs.
The rare-category rule reads the batch frequency of a value; those
frequencies are attached first by one grouped count (see ``groups``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions.text import month_ok, strip
from layerflow.operators.groups import attach_frequency

# Rule thresholds and the floor-range pattern.
MIN_CATEGORY_FREQUENCY = 5
STOREY_RANGE_PATTERN = r"^[0-9]{2} TO [0-9]{2}$"
FLOOR_AREA_MIN_SQM = 20
FLOOR_AREA_MAX_SQM = 300

FREQ_PREFIX = "_freq_"


@dataclass(frozen=True)
class Rule:
    name: str
    passes: Column
    frequency_of: str | None = None  # column whose batch frequency the rule reads


def rule_date(col: str = "month", name: str = "invalid_date") -> Rule:
    """Month text parses as ``YYYY-M(M)``."""
    return Rule(name, month_ok(col))


def rule_rare(col: str, k: int = MIN_CATEGORY_FREQUENCY, name: str | None = None) -> Rule:
    """Non-blank, and the trimmed value occurs at least ``k`` times in the batch."""
    v = strip(F.col(col).cast("string"))
    passes = v.isNotNull() & (v != "") & (F.col(f"{FREQ_PREFIX}{col}") >= k)
    return Rule(name or f"invalid_{col}", passes, frequency_of=col)


def rule_pattern(col: str, pattern: str = STOREY_RANGE_PATTERN, name: str | None = None) -> Rule:
    """Trimmed text matches the pattern."""
    return Rule(name or f"invalid_{col}", strip(F.col(col).cast("string")).rlike(pattern))


def rule_bounds(col: str, lo: float = FLOOR_AREA_MIN_SQM, hi: float = FLOOR_AREA_MAX_SQM,
                name: str | None = None) -> Rule:
    """Numeric and ``lo <= v <= hi`` (C8). NaN fails."""
    v = F.col(col).try_cast("double")
    return Rule(name or f"invalid_{col}", v.isNotNull() & ~F.isnan(v) & (v >= lo) & (v <= hi))


def rule_not_after(year_col: str = "lease_commence_date", month_col: str = "month",
                   name: str = "lease_commence_after_transaction") -> Rule:
    """Start year is not after the transaction year; unreadable fails."""
    year = F.col(year_col).try_cast("bigint")
    tx_year = strip(F.split_part(F.col(month_col).cast("string"), F.lit("-"), F.lit(1))).try_cast("bigint")
    return Rule(name, year <= tx_year)


def rule_positive(col: str, name: str | None = None) -> Rule:
    """Numeric and > 0."""
    v = F.col(col).try_cast("double")
    return Rule(name or f"invalid_{col}", v.isNotNull() & ~F.isnan(v) & (v > 0))


def resale_rules(k: int = MIN_CATEGORY_FREQUENCY) -> list[Rule]:
    """The eight transaction rules, in their fixed reporting order (C11)."""
    return [
        rule_date("month"),
        rule_rare("town", k),
        rule_rare("flat_type", k),
        rule_rare("flat_model", k),
        rule_pattern("storey_range"),
        rule_bounds("floor_area_sqm", name="invalid_floor_area"),
        rule_not_after("lease_commence_date", "month"),
        rule_positive("resale_price"),
    ]


def error_list(rules: list[Rule]) -> Column:
    """Names of failed rules, in rule order, joined by ``", "``; NULL when all pass (C11).

    ``concat_ws`` skips the NULLs of passing rules, so no array is built per row.
    """
    text = F.concat_ws(", ", *[F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.name)) for r in rules])
    return F.nullif(text, F.lit(""))


def validate(df: DataFrame, rules: list[Rule], errors_col: str = "_validation_errors",
             counts: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows plus ``errors_col`` (C11). Frequencies are attached and removed again.

    ``counts`` gives, for each category column, kept frequencies (v, ``_freq_<col>``) in place of those of ``df``.
    """
    freq_cols = list(dict.fromkeys(r.frequency_of for r in rules if r.frequency_of))
    if counts is None:
        with_freq = attach_frequency(df, freq_cols, FREQ_PREFIX)
    else:
        with_freq = df
        for c in freq_cols:
            side = counts[c].withColumnRenamed("v", f"_fv_{c}")
            with_freq = with_freq.join(side, strip(F.col(c).cast("string")) == F.col(f"_fv_{c}"), "left").drop(f"_fv_{c}")
    out = with_freq.withColumn(errors_col, error_list(rules))
    return out.drop(*[f"{FREQ_PREFIX}{c}" for c in freq_cols])


def split(df: DataFrame, errors_col: str = "_validation_errors") -> tuple[DataFrame, DataFrame]:
    """(passed without the error column, failed with it)."""
    passed = df.where(F.col(errors_col).isNull()).drop(errors_col)
    failed = df.where(F.col(errors_col).isNotNull())
    return passed, failed
