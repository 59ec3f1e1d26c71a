"""Change capture at a merge: rows classed by a hash of the watched columns, and their history.

A merge knows which keys it inserts and updates, but not which updates change
anything. Here stored and incoming rows are compared by one hash of the columns
that count as a change, in one full outer join on the key, so a re-read month
that brings the same rows again shows as unchanged. ``apply_changes`` keeps
every version of a key with the interval in which it held.

Keys are unique in a batch (take the best row of each first); a null key is like no
other, as in the merge. Null values are values: null to null is unchanged. Batches come
in the order of their times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, CHANGED, UNCHANGED, DELETED = "inserted", "changed", "unchanged", "deleted"
CHANGE = "_change"
FROM, TO = "valid_from", "valid_to"


def change_hash(columns: list[str], prefix: str = "") -> Column:
    """SHA-256 of the columns' values; a null differs from every text, and values can't run together."""
    fields = F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def _same_key(key: list[str]) -> Column:
    cond = F.lit(True)
    for c in key:
        cond = cond & (F.col(f"s__{c}") == F.col(f"b__{c}"))
    return cond


def _sides(stored: DataFrame, batch: DataFrame, watched: list[str]) -> tuple[DataFrame, DataFrame]:
    s = stored.select(*[F.col(c).alias(f"s__{c}") for c in stored.columns], change_hash(watched).alias("s__hash"))
    b = batch.select(*[F.col(c).alias(f"b__{c}") for c in batch.columns], change_hash(watched).alias("b__hash"))
    return s, b


def _class(whole: bool) -> Column:
    return (F.when(F.col("s__hash").isNull(), INSERTED)
            .when(F.col("b__hash").isNull(), DELETED if whole else UNCHANGED)
            .when(F.col("s__hash") == F.col("b__hash"), UNCHANGED).otherwise(CHANGED))


def classify_changes(stored: DataFrame, batch: DataFrame, key: list[str], watched: list[str], whole: bool = False) -> DataFrame:
    """Key columns and ``_change`` of every batch row: inserted, changed or unchanged.

    With ``whole`` the batch is all that should be stored, so stored keys that it lacks come as deleted.
    Only keys and hashes of either side are joined, not the rows.
    """
    s, b = _sides(stored.select(*key, *[c for c in watched if c not in key]), batch.select(*key, *[c for c in watched if c not in key]), watched)
    s, b = s.select(*[f"s__{c}" for c in key], "s__hash"), b.select(*[f"b__{c}" for c in key], "b__hash")
    joined = s.join(b, _same_key(key), "full_outer" if whole else "right")
    return joined.select(*[F.coalesce(f"b__{c}", f"s__{c}").alias(c) for c in key], _class(whole).alias(CHANGE))


def open_history(batch: DataFrame, at: Column) -> DataFrame:
    """The history that starts with this batch: each row holds from ``at`` on."""
    return batch.select("*", at.alias(FROM), F.lit(None).alias(TO)).withColumn(TO, F.lit(None).cast(_type(batch, at)))


def _type(df: DataFrame, at: Column):
    return df.select(at.alias("at")).schema["at"].dataType


def apply_changes(history: DataFrame, batch: DataFrame, key: list[str], watched: list[str], at: Column, whole: bool = False) -> DataFrame:
    """The history after a batch that holds from ``at`` on.

    A changed row closes the key's open version at ``at`` and opens a new one; an unchanged one leaves the
    open version as it is, columns outside ``watched`` included; with ``whole``, versions of keys that the batch
    lacks are closed. A batch applied again changes nothing, and a version that was opened at the
    same time is replaced, so a corrected batch leaves no empty interval. The history is read once:
    closed versions pass the same join, where they match nothing.
    """
    cols = [c for c in history.columns if c not in (FROM, TO)]
    s, b = _sides(history, batch.select(*cols), watched)
    joined = s.join(b, _same_key(key) & F.col(f"s__{TO}").isNull(), "full_outer")
    kind = history.schema[TO].dataType
    at = at.cast(kind)
    had, closed = F.col("s__hash").isNotNull(), F.col(f"s__{TO}").isNotNull()
    change = _class(whole)
    ends = had & ~closed & change.isin(CHANGED, DELETED)

    def version(prefix: str, since: Column, until: Column) -> Column:
        return F.struct(*[F.col(f"{prefix}__{c}").alias(c) for c in cols], since.alias(FROM), until.alias(TO))

    old = F.when(had & ~(ends & (F.col(f"s__{FROM}") == at)),
                 version("s", F.col(f"s__{FROM}"), F.when(ends, at).otherwise(F.col(f"s__{TO}"))))
    new = F.when(F.col("b__hash").isNotNull() & change.isin(INSERTED, CHANGED), version("b", at, F.lit(None).cast(kind)))
    rows = joined.select(F.explode(F.filter(F.array(old, new), lambda v: v.isNotNull())).alias("v"))
    return rows.select(*[F.col(f"v.{c}").alias(c) for c in history.columns])


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The rows that held at a time, without their intervals."""
    return history.filter((F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at))).drop(FROM, TO)
