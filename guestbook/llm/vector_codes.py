"""Vector code compression: a codebook for each part of the vectors, with norm-of-sum bounds.

A component x becomes the whole number floor(256 * x), so that all that follows is exact. Vectors are cut into equal
consecutive parts; a part is coded by the nearest entry of its position's codebook (squared Euclidean distance, ties to
the lower index). In every round all parts are assigned, and each entry moves to the floor of the mean of its parts;
an entry without parts stays.

The codebooks of all rounds are kept. A row carries, for each part, its entry, a lower bound of the distance to any
other entry, and the round in which that bound was measured. Entries have since moved by the norm of the sum of their
moves - the distance between their places then and now - which is never more than the sum of the moves' norms, so the
bound less the longest such displacement still holds. Only a part whose own distance is not below that is compared
with all entries again, and its bound gets the stamp of the round. A round is one pass over the rows, whose last row in
each task has the sums that move the entries; only those sums and the codebooks reach the driver.

Defined results: rows whose vector is null or holds null or non-finite components are left out. Shorter vectors than
the longest, and lengths that the number of parts does not divide, are filled up with zeros. Whole numbers are held to
a range in which a row's error fits a long (2**27 either way for 64 components). Codebooks start with the rows of the
smallest ids, rows with the same id in the order of their bytes; with fewer rows than entries there are fewer entries.
Rows that share an id are rows of their own. A sum of errors beyond a long is null. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.operators.joins import join_lookup
from guestbook.shared import drop_tables, settled

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
ROWS_AT_ONCE = 1024

STATE = "vec_id long, label {}, vector binary, codes binary, bounds binary, stamps binary, error long, cells array<struct<cell:int,total:long>>"
CELLS = pa.list_(pa.struct([("cell", pa.int32()), ("total", pa.int64())]))


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, label: str, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, vector) with the whole numbers as 32-bit integers, settled, and how many a part has."""
    components = F.col(f"`{vector}`").cast("array<double>")
    rows = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), components.alias("vector"))
    if rows.schema["label"].dataType.typeName() == "void":
        rows = rows.withColumn("label", F.col("label").cast("string"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & finite)
    width = -(-(rows.agg(F.max(F.size("vector"))).first()[0] or 0) // parts)
    most = math.isqrt(2**62 // max(1, width * parts)) // 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = rows.column("vector")
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            filled = np.zeros((rows.num_rows, width * parts))
            filled[np.arange(width * parts) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(SCALE * filled), -most, most).astype("<i4")
            yield rows.set_column(2, "vector", pa.array([row.tobytes() for row in whole], pa.binary()))

    schema = rows.withColumn("vector", F.lit(b"")).schema
    return settled(rows.mapInArrow(work, schema), "whole-vectors"), width


def first_codebooks(vectors: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """(part, entry, component) from the rows of the smallest ids."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    found = np.frombuffer(b"".join(bytes(row.vector) for row in rows), "<i4").astype(np.int64)
    return found.reshape(len(rows), parts, width).swapaxes(0, 1)


class Bounds:
    """How far the entries have moved since each round: from the history of codebooks (round, part, entry, component)."""

    def __init__(self, history: np.ndarray):
        self.books, self.now = history[-1], len(history) - 1
        moved = np.sqrt(((history[-1] - history).astype(float) ** 2).sum(axis=3))  # round, part, entry
        n = moved.shape[2]
        others = np.where(np.eye(n, dtype=bool), -1.0, moved[:, :, None, :])  # the longest way of any entry but one's own
        self.moved = np.maximum(0.0, others.max(axis=3))

    def scanned(self, x: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry, its squared distance, and the distance of the next, by comparing with all."""
        found = ((x[:, None, :] - self.books[part][None]) ** 2).sum(axis=2)
        code = found.argmin(axis=1)
        nearest = found[np.arange(len(x)), code]
        if found.shape[1] == 1:
            return code, nearest, np.full(len(x), np.inf)
        return code, nearest, np.sqrt(np.partition(found, 1, axis=1)[:, 1].astype(float))

    def assigned(self, x: np.ndarray, codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, int]:
        """Squared distances of the parts of ``x`` (row, part, component) to their entries after all rows that need it
        have been scanned anew, and how many were. ``codes``, ``bounds`` and ``stamps`` (row, part) are brought up to
        date; a bound below zero asks for a scan."""
        distances, scans = np.empty(codes.shape, np.int64), 0
        for part in range(codes.shape[1]):
            code, mine = codes[:, part], x[:, part]
            distances[:, part] = ((mine - self.books[part][code]) ** 2).sum(axis=1)
            moved = self.moved[stamps[:, part], part, code]
            with np.errstate(invalid="ignore"):
                least = bounds[:, part] - moved - 1e-9 * (bounds[:, part] + moved)  # more than the floats can be wrong by
                least[np.isnan(least)] = np.inf  # there is no other entry
            near = np.nonzero(~((least > 0) & (distances[:, part] < least**2)))[0]
            for k in range(0, len(near), ROWS_AT_ONCE):
                some = near[k : k + ROWS_AT_ONCE]
                codes[some, part], distances[some, part], bounds[some, part] = self.scanned(mine[some], part)
                stamps[some, part] = self.now
            scans += len(near)
        return distances, scans


def assigned(state: DataFrame, history: np.ndarray, label_type: str) -> DataFrame:
    """One round over the rows, and a last row in each task with counts and sums for each entry: a cell is
    (part, entry, place), where place 0 has the count."""
    parts, entries, width = history.shape[1:]
    first = "codes" not in state.columns
    held = state.sparkSession.sparkContext.broadcast(history)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds_now = Bounds(held.value)
        sums, label_kind = np.zeros((parts, entries, width + 1), np.int64), pa.null()

        def column(rows: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind).reshape(rows.num_rows, parts)

        for rows in batches:
            n, label_kind = rows.num_rows, rows.column("label").type
            x = np.frombuffer(b"".join(rows.column("vector").to_pylist()), "<i4").astype(np.int64).reshape(n, parts, width)
            if first:
                codes, bounds, stamps = np.zeros((n, parts), np.int64), np.full((n, parts), -1.0), np.zeros((n, parts), np.int64)
            else:
                codes, stamps = (column(rows, name, "u1").astype(np.int64) for name in ("codes", "stamps"))
                bounds = column(rows, "bounds", "<f8").copy()
            distances, _ = bounds_now.assigned(x, codes, bounds, stamps)
            for part in range(parts):
                sums[part, :, 0] += np.bincount(codes[:, part], minlength=entries)
                for place in range(width):
                    np.add.at(sums[part, :, place + 1], codes[:, part], x[:, part, place])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("vec_id"), rows.column("label"), rows.column("vector"),
                    *[pa.array([row.tobytes() for row in held], pa.binary()) for held in (codes.astype("u1"), bounds.astype("<f8"), stamps.astype("u1"))],
                    pa.array(distances.sum(axis=1)), pa.nulls(n, CELLS),
                ],
                names=[*NAMES],
            )
        if sums.any():
            at = np.flatnonzero(sums)
            cells = [{"cell": cell, "total": total} for cell, total in zip(at.tolist(), sums.ravel()[at].tolist())]
            nothing = [pa.nulls(1, kind) for kind in (pa.int64(), label_kind, *[pa.binary()] * 4, pa.int64())]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array([cells], CELLS)], names=[*NAMES])

    return state.mapInArrow(work, STATE.format(label_type))


NAMES = ("vec_id", "label", "vector", "codes", "bounds", "stamps", "error", "cells")


def moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: a sum for each cell reaches the driver."""
    cells = state.select(F.explode("cells").alias("c")).groupBy("c.cell").agg(F.sum(F.col("c.total").cast("decimal(38,0)")).alias("total"))
    parts, entries, width = books.shape
    sums = {row.cell: int(row.total) for row in cells.collect()}
    out = books.copy()
    for part in range(parts):
        for entry in range(entries):
            base = (part * entries + entry) * (width + 1)
            if n := sums.get(base):
                out[part, entry] = [sums.get(base + 1 + place, 0) // n for place in range(width)]
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) of every row that takes part, a byte for each part, and the final codebooks
    (part, entry, component)."""
    if entries > 256:
        raise ValueError("an index has to fit a byte")
    vectors, width = whole_vectors(rows, vec_id, vector, label, parts)
    label_type = vectors.schema["label"].dataType.simpleString()
    history = [first_codebooks(vectors, parts, entries, width)]
    state = vectors
    if not history[0].shape[1]:
        return vectors.selectExpr("vec_id", "label", "cast(null as binary) as codes", "0L as error"), history[0]
    for number in range(rounds + 1):
        last, state = state, settled(assigned(state, np.stack(history), label_type), f"codes-{number}")
        if number < rounds:
            history.append(moved(state, history[-1]))
        drop_tables(last)
        state = state.select(*NAMES[:-1]).filter("vector is not null")
    return state.select("vec_id", "label", "codes", "error"), history[-1]


def with_label_error(found: DataFrame) -> DataFrame:
    """``found`` with ``label_error``, the error summed over equal labels; rows without a label are equal."""
    key = {"no_label": F.col("label").isNull(), "label_text": F.coalesce(F.col("label").cast("string"), F.lit(""))}
    found = found.withColumns(key)
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    sums = found.groupBy(*key).agg(total)
    return join_lookup(found, sums, [*key], costly=True).drop(*key)
