"""Ranks over a total order, without a window that holds a whole group.

Rows are sorted by one range shuffle on keys and tie-break together, so that a group of equal keys, however
large, spreads over as many partitions as its rows fill. Each partition counts by itself; where a group goes
on in the next partition is settled from one summary row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.shared import drop_tables, settled


def ranked(df: DataFrame, keys: Sequence[str], tie: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``rank`` (ascending in the order of keys, equal for equal keys), ``first`` (no row of the
    same keys before this one) and ``alone`` (no other row of the same keys), as a settled table.

    Keys and tie-break are longs without nulls. Of rows equal in all of them one is kept.
    """
    order = [*keys, *tie]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, start, last, waiting = TaskContext.get().partitionId(), 0, 0, None, None
        for rows in batches:
            if not rows.num_rows:
                continue
            columns = [rows.column(name).to_numpy(zero_copy_only=False) for name in order]
            equal = np.ones((2, rows.num_rows), bool)  # to the row before: in the keys, in everything
            for k, column in enumerate(columns):
                as_before = np.append(last is not None and last[k] == column[0], column[1:] == column[:-1])
                equal[int(k >= len(keys)) :] &= as_before
            equal[1] &= equal[0]
            if waiting is not None:
                yield _finished(*waiting, bool(equal[0, 0]))
            starts = np.maximum.accumulate(np.where(equal[0], start, count + np.arange(rows.num_rows)))
            waiting, last = (rows, part, equal, starts), [column[-1] for column in columns]
            count, start = count + rows.num_rows, int(starts[-1])
        if waiting is not None:
            yield _finished(*waiting, False)

    schema = df.selectExpr("*", "0 as _part", "0L as _start", "true as _first", "true as _alone").schema
    local = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(work, schema)
    local = settled(local, f"{name}-sorted")
    key = F.struct(*keys)
    parts = local.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.max("_start").alias("tail"))
    summary, offset, high, tail = [], 0, None, 0  # one row for each partition, in their order
    for row in sorted(parts.collect(), key=lambda row: row._part):
        goes_on = row.low == high
        if goes_on:
            summary[-1]["_is_followed"] = True
        head = tail if goes_on else offset
        summary.append({"_part": row._part, "_offset": offset, "_head": head, "_goes_on": goes_on, "_tail": row.tail, "_is_followed": False})
        high, tail, offset = row.high, head if row.tail == 0 else offset + row.tail, offset + row.tail + 1
    carried = df.sparkSession.createDataFrame(
        summary, "_part int, _offset long, _head long, _goes_on boolean, _tail long, _is_followed boolean"
    )
    in_head = (F.col("_start") == 0) & F.col("_goes_on")
    in_tail = (F.col("_start") == F.col("_tail")) & F.col("_is_followed")
    found = local.join(F.broadcast(carried), "_part").select(
        *df.columns,
        F.when(F.col("_start") == 0, F.col("_head")).otherwise(F.col("_offset") + F.col("_start")).alias("rank"),
        (F.col("_first") & ~in_head).alias("first"),
        (F.col("_alone") & ~in_head & ~in_tail).alias("alone"),
    )
    out = settled(found, name)
    drop_tables(local)
    return out


def _finished(rows: pa.RecordBatch, part: int, equal: np.ndarray, starts: np.ndarray, goes_on: bool) -> pa.RecordBatch:
    followed = np.append(equal[0, 1:], goes_on)
    added = {
        "_part": pa.array(np.full(len(starts), part, np.int32)),
        "_start": pa.array(starts.astype(np.int64)),
        "_first": pa.array(~equal[0]),
        "_alone": pa.array(~equal[0] & ~followed),
    }
    out = pa.RecordBatch.from_arrays([*rows.columns, *added.values()], names=[*rows.schema.names, *added])
    return out.filter(pa.array(~equal[1]))


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str) -> tuple[DataFrame, dict[tuple[int, object], int]]:
    """``df`` with ``_part`` and ``_local``, settled, and the offset of every (partition, group): offset plus
    ``_local`` numbers the rows of each group from 0 in the given order.

    Sorted by one range shuffle on group and order, a hot group fills many partitions. There are at most as
    many offsets as partitions and groups together.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counts = TaskContext.get().partitionId(), {}
        for rows in batches:
            coded = rows.column(group).dictionary_encode("encode")
            codes, local = coded.indices.to_numpy(zero_copy_only=False), np.empty(rows.num_rows, np.int64)
            for code, value in enumerate(coded.dictionary.to_pylist()):
                at = np.nonzero(codes == code)[0]
                local[at] = counts.get(value, 0) + np.arange(len(at))
                counts[value] = counts.get(value, 0) + len(at)
            added = [pa.array(np.full(rows.num_rows, part, np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, "_part", "_local"])

    schema = df.selectExpr("*", "0 as _part", "0L as _local").schema
    local = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).mapInArrow(work, schema)
    local = settled(local, name)
    offsets, total = {}, {}
    counts = local.groupBy("_part", group).agg(F.count("*").alias("n")).collect()
    for row in sorted(counts, key=lambda row: row._part):
        offsets[row._part, row[group]] = total.get(row[group], 0)
        total[row[group]] = total.get(row[group], 0) + row.n
    return local, offsets
