"""Keep the best row per key; the others are rejected.

Skew-safe plan. The winner of each key is found by an aggregation
(``max_by`` of the row id ordered by price, then tie-breakers); partial
aggregation collapses a hot key on the map side, so no task ever holds a
whole group. The rows are then tagged by an equi-join on the *row id*,
which is unique and spreads evenly over partitions, instead of a join or
window on the (possibly hot) key.

A row id must be unique over the frame. For data read from Parquet,
``file_row_id`` gives one from the file path and the row's index in its
file (stable across task retries); joined fixtures can use a unique
column combination.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.operators.groups import join_small

ROW_ID = "_rid"


def file_row_id(df: DataFrame, alias: str = ROW_ID) -> DataFrame:
    """Add a unique, retry-stable row id to a frame read straight from files.

    The id is (hash of the file path, row index in that file); it does not
    depend on how the files are split into tasks.
    """
    rid = F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"),
                   F.col("_metadata.row_index").alias("i"))
    return df.withColumn(alias, rid)


def _order_struct(order: list[Column | str]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}")
                      for i, c in enumerate(order)])


def winners(df: DataFrame, keys: list[str], order: list[Column | str],
            row_id: str = ROW_ID, carry: list[str] | None = None) -> DataFrame:
    """One row per key: the id of the row with the greatest ``order`` (NULLs lowest).

    ``order`` is compared left to right, all descending: e.g. price, then
    tie-breaker columns. Keys compare NULL-equal, as in a pandas groupby
    with ``dropna=False``. Without ``carry`` only the row id is returned;
    with it, the keys and the winning row's ``carry`` columns come along.
    """
    if not carry:
        return (df.groupBy(*keys)
                .agg(F.max_by(F.col(row_id), _order_struct(order)).alias(row_id))
                .select(row_id))
    best = F.max_by(F.struct(F.col(row_id).alias(row_id), *[F.col(c).alias(c) for c in carry]),
                    _order_struct(order))
    return df.groupBy(*keys).agg(best.alias("_w")).select(
        *keys, F.col(f"_w.{row_id}").alias(row_id), *[F.col(f"_w.{c}").alias(f"_w_{c}") for c in carry])


def dedup_tag(df: DataFrame, keys: list[str], order: list[Column | str],
              row_id: str = ROW_ID, flag: str = "_is_winner",
              eligible: Column | None = None, reuse: Callable[[DataFrame], DataFrame] | None = None,
              check_small: bool = False) -> DataFrame:
    """All rows plus ``flag``: true for the one kept row of each key.

    With ``eligible`` set, only those rows compete (others get ``flag`` NULL).
    ``reuse`` writes the winners' ids once; with ``check_small`` they are counted
    and, if few, broadcast, so that the rows are not shuffled by their ids.
    """
    cand = df if eligible is None else df.where(eligible)
    win = winners(cand, keys, order, row_id)
    win = (win if reuse is None else reuse(win)).withColumn(flag, F.lit(True))
    tagged = join_small(df, win, [row_id], check=check_small)
    won = F.coalesce(F.col(flag), F.lit(False))
    if eligible is not None:
        won = F.when(eligible, won)
    return tagged.withColumn(flag, won)


def losers(df: DataFrame, hashed: DataFrame, keys: list[str], order: list[Column | str], row_id: str, hash_col: str,
           reuse: Callable[[DataFrame], DataFrame], check_small: bool = False) -> DataFrame:
    """Ids of the rows that are not the best of their key.

    ``hashed`` has each row's id and ``hash_col``, ``xxhash64`` of its keys. A hash that
    occurs once belongs to a key that occurs once, so only 8 bytes of each row
    are counted; the rows of the other hashes alone are grouped by their whole keys, so that
    keys of one hash stay apart.
    """
    again = reuse(hashed.groupBy(hash_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(hash_col))
    needed = list(dict.fromkeys([row_id, *keys, *[c for c in order if isinstance(c, str)]]))
    extra = [c.alias(f"_o{i}") for i, c in enumerate(order) if not isinstance(c, str)]
    maybe = join_small(df.withColumn(hash_col, F.xxhash64(*keys)), again, [hash_col], how="left_semi", check=check_small)
    maybe = reuse(maybe.select(*needed, *extra))
    best = winners(maybe, keys, [c if isinstance(c, str) else f"_o{i}" for i, c in enumerate(order)], row_id)
    return maybe.select(row_id).join(best, row_id, "left_anti")


def dedup_keep_max(df: DataFrame, keys: list[str], order: list[Column | str],
                   row_id: str = ROW_ID) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded): the highest-ordered row of each key is kept."""
    tagged = dedup_tag(df, keys, order, row_id, flag="_is_winner")
    kept = tagged.where(F.col("_is_winner")).drop("_is_winner")
    discarded = tagged.where(~F.col("_is_winner")).drop("_is_winner")
    return kept, discarded


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (G3 check, F6)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1))


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if any key occurs twice (G3). One aggregation job over 64-bit hashes; whole keys are compared only if a hash repeats."""
    if not df.groupBy(F.xxhash64(*keys).alias("_kh")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).collect():
        return
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise RuntimeError(f"duplicate key(s) remain after dedup, e.g. {dup[0].asDict()}")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows that share their composite key with another row."""
    return duplicate_keys(df, keys).agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
