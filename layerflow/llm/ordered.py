"""Places and running totals of rows inside their groups, with no group held by one task.

The rows are dealt by ranges of (group, order), so a group with a third of all
rows spans many tasks. Every task counts its own stretch; what it must add is
the total of the tasks before it, and only its first group can go on from
there. So the table of additions has at most one row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.llm.common import ship_code, written


def _same_as_before(column: pa.Array, last) -> np.ndarray:
    """For every row whether its value (null alike null) is that of the row before it."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ahead = pa.concat_arrays([pa.array([last], column.type), column.slice(0, len(column) - 1)])
    alike = pc.or_(pc.fill_null(pc.equal(column, ahead), False), pc.and_(pc.is_null(column), pc.is_null(ahead)))
    return alike.to_numpy(zero_copy_only=False)


def running(groups: list[str], sums: list[str], xors: list[str]):
    """An Arrow step over sorted rows: place in the group and running totals, as far as this task can see."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last = TaskContext.get().partitionId(), 0, None
        count, carry = 0, {c: np.zeros(1, np.int64) for c in [*sums, *xors]}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for g in groups:
                new |= ~_same_as_before(batch.column(g), None if last is None else last[g])
            new[0] |= last is None
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))  # -1: the group of the batch before
            place = at - start + np.where(start < 0, count - 1, 0)
            columns = {"_part": np.full(n, part, np.int32), "_row": row + at, "_pos": place}
            for c in [*sums, *xors]:
                values = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                fold = np.bitwise_xor if c in xors else np.add
                total = np.concatenate([[0], fold.accumulate(values)])
                before = total[np.maximum(start, 0)]
                out = (total[1:] ^ before) if c in xors else total[1:] - before
                old = start < 0
                out[old] = fold(out[old], carry[c])
                columns[f"_run_{c}"] = out
                carry[c] = out[-1:]
            count, row = int(place[-1]) + 1, row + n
            last = {g: batch.column(g)[n - 1].as_py() for g in groups}
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns.values())], names=[*batch.schema.names, *columns])
    return step


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str, sums: tuple[str, ...] = (), xors: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``_pos``, the place (from 0) of a row in its group by ``order`` (nulls first), and ``_run_<c>``
    with the running sum or exclusive or up to the row of every column c of ``sums`` and ``xors`` (bigint, no nulls).

    ``df`` should be a written table: it is read twice, once to choose the ranges.
    """
    ship_code(df.sparkSession)
    keys = [*groups, *order]
    totals = [f"_run_{c}" for c in [*sums, *xors]]
    schema = T.StructType([*df.schema, T.StructField("_part", T.IntegerType()), T.StructField("_row", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in ["_pos", *totals]]])
    rows = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(running(groups, list(sums), list(xors)), schema), name)
    ends = rows.groupBy("_part").agg(
        F.min_by(F.struct(F.lit(0).alias("_"), *groups), "_row").alias("first"),
        F.max_by(F.struct(F.lit(0).alias("_"), *groups), "_row").alias("last"),
        F.max_by(F.struct("_pos", *totals), "_row").alias("end")).orderBy("_part").collect()  # one row for each partition
    added, before = [], None
    for e in ends:
        go_on = before is not None and before[0] == e["first"]
        extra = before[1] if go_on else [0] * (1 + len(totals))
        if go_on:
            added.append((e["_part"], *extra))
        mine = [e["end"]["_pos"] + 1, *[e["end"][c] for c in totals]]
        if e["first"] == e["last"]:  # one group fills the task
            mine = [(a ^ b) if i > len(sums) else a + b for i, (a, b) in enumerate(zip(extra, mine))]
        before = (e["last"], mine)
    if not added:
        return rows.drop("_part", "_row")
    names = ["_at", *[f"_more{i}" for i in range(1 + len(totals))]]
    more = df.sparkSession.createDataFrame(added, T.StructType([T.StructField("_at", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in names[1:]]]))
    firsts = rows.groupBy("_part").agg(F.min("_row").alias("_"), F.min_by(F.struct(F.lit(0).alias("_"), *groups), "_row").alias("_first"))
    more = more.join(firsts.select(F.col("_part").alias("_at"), "_first"), "_at")
    joined = rows.join(F.broadcast(more), (F.col("_part") == F.col("_at")) & F.struct(F.lit(0).alias("_"), *groups).eqNullSafe(F.col("_first")), "left")
    add = F.coalesce(F.col("_more0"), F.lit(0))
    columns = {"_pos": F.col("_pos") + add}
    for i, c in enumerate(totals, 1):
        extra = F.coalesce(F.col(f"_more{i}"), F.lit(0))
        columns[c] = F.col(c).bitwiseXOR(extra) if i > len(sums) else F.col(c) + extra
    return joined.withColumns(columns).drop("_part", "_row", "_first", *names)
