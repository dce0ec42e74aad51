"""Exact deduplication against a history of digests in minimal perfect hash tables.

A document is known by the SHA-256 of its text without white space. The distinct digests of the history are
dealt over buckets by their leading bits. Every bucket becomes one minimal perfect hash: a few levels of bit
arrays send each digest to a slot of its own, and the slot holds the full digest, the winner so far and the
number of its copies. A later batch is first brought down to its distinct digests, each of which is looked up
in its bucket and compared byte by byte with the digest in the slot: members are repeats of the history,
nonmembers have been grouped among themselves. Only digests travel, never texts; copies meet in partial
aggregates, so that a group with a third of all rows reaches a bucket as a single row.

Defined results: a null text is an empty one. A null ``doc_id`` comes after all others when ties are broken.
Of rows with the same ``doc_id`` and equally long texts the first as read stays; each counts in ``group_size``. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, encoded_texts_of, narrow
from guestbook.shared import settled

WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
BUCKET_DIGESTS = 100_000
LEVELS = 24
SLACK = 2.0

DIGESTS = "doc_id long, digest binary, n_points int"
SHARD = "bucket int, sizes array<int>, bits binary, digests binary, winners array<long>, winner_rows array<long>, points array<int>, copies array<long>"
LOOKED_UP = "digest binary, doc_id long, row_id long, n_points int, copies long, known boolean"


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest and number of code points of every row's whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            points = pc.fill_null(pc.utf8_length(rows.column("text")), 0).cast(pa.int32())
            found = [hashlib.sha256(t.translate(None, WHITE_SPACE)).digest() for t in encoded_texts_of(rows.column("text"))]
            yield batch(doc_id=rows.column("doc_id"), digest=pa.array(found, pa.binary()), n_points=points)

    return narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text").mapInArrow(work, DIGESTS)


def _winner() -> Column:
    """Most code points first, then the smallest id, then the first row; a null id loses against any other."""
    return F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("minus_id"), F.bitwise_not("row_id").alias("minus_row")))


def distinct(rows: DataFrame) -> DataFrame:
    """One row for each digest: its winner and its number of copies."""
    return (
        rows.groupBy("digest")
        .agg(_winner().alias("best"), F.sum("copies").alias("copies"))
        .select("digest", F.bitwise_not("best.minus_id").alias("doc_id"), F.bitwise_not("best.minus_row").alias("row_id"), "best.n_points", "copies")
    )


def _halves(digest: bytes) -> np.ndarray:
    return np.frombuffer(digest, dtype="<u8").reshape(-1, 4)


def _positions(halves: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each digest on a level: its words are uniform already, a level mixes them anew."""
    mixed = (halves[:, 1] ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31)) ^ halves[:, 2]) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Levels of bit arrays; a digest alone at its position of a level has the rank of that bit as its slot.

    The few digests that no level sets apart come last, in the order of their bytes, and are found by search.
    """

    sizes: list[int]
    bits: np.ndarray
    rest: list[bytes]

    @classmethod
    def over(cls, found: list[bytes]) -> PerfectHash:
        halves, left = _halves(b"".join(found)), np.arange(len(found))
        sizes, bits = [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(len(left) * SLACK))
            at = _positions(halves[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, bool), sorted(found[i] for i in left))

    def slots(self, found: list[bytes]) -> np.ndarray:
        """Slot of every digest; -1 where the structure already shows that it is no member."""
        halves, ranks = _halves(b"".join(found)), np.cumsum(self.bits) - self.bits
        slots, left, start = np.full(len(found), -1, np.int64), np.arange(len(found)), 0
        for level, size in enumerate(self.sizes):
            at = start + _positions(halves[left], level, size)
            hit = self.bits[at]
            slots[left[hit]] = ranks[at[hit]]
            left, start = left[~hit], start + size
        placed, rest = int(self.bits.sum()), {digest: k for k, digest in enumerate(self.rest)}
        for i in left:
            slots[i] = placed + rest[found[i]] if found[i] in rest else -1
        return slots


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", (F.conv(F.substring(F.hex("digest"), 1, 7), 16, 10).cast("long") % buckets).cast("int"))


@dataclass
class History:
    """Minimal perfect hash tables over the distinct digests of all documents seen so far, as a table."""

    shards: DataFrame
    buckets: int

    @classmethod
    def of(cls, rows: DataFrame, expected: int = 0) -> History:
        """From ``distinct`` rows. The number of buckets follows the number of digests, or of those that are
        expected to be looked up at once if they are more."""
        rows = settled(rows, "distinct-digests")
        buckets = max(1, -(-max(rows.count(), expected) // BUCKET_DIGESTS))

        def build(table: pa.Table) -> pa.Table:
            found = table.column("digest").to_pylist()
            hashed = PerfectHash.over(found)
            order = np.empty(len(found), np.int64)
            order[hashed.slots(found)] = np.arange(len(found))
            table = table.take(order)
            return pa.table(
                {
                    "bucket": table.column("bucket")[:1],
                    "sizes": pa.array([hashed.sizes], pa.list_(pa.int32())),
                    "bits": [np.packbits(hashed.bits).tobytes()],
                    "digests": [b"".join(table.column("digest").to_pylist())],
                    "winners": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "winner_rows": pa.array([table.column("row_id").to_pylist()], pa.list_(pa.int64())),
                    "points": pa.array([table.column("n_points").to_pylist()], pa.list_(pa.int32())),
                    "copies": pa.array([table.column("copies").to_pylist()], pa.list_(pa.int64())),
                }
            )

        shards = _bucketed(rows, buckets).groupBy("bucket").applyInArrow(build, SHARD)
        return cls(settled(shards, "digest-history"), buckets)

    def look_up(self, rows: DataFrame) -> DataFrame:
        """The slots' rows and the given ``distinct`` rows; ``known`` says that a given digest is a member."""

        def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
            out = [_looked_up(theirs.column("digest").to_pylist(), theirs, np.zeros(len(theirs), bool))]
            if len(ours):
                shard = {name: ours.column(name)[0].as_py() for name in ours.column_names}
                size = sum(shard["sizes"])
                slots = [shard["digests"][at : at + 32] for at in range(0, len(shard["digests"]), 32)]
                bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=size).astype(bool)
                hashed = PerfectHash(shard["sizes"], bits, slots[int(bits.sum()) :])
                found = theirs.column("digest").to_pylist()
                known = [k >= 0 and slots[k] == digest for k, digest in zip(hashed.slots(found), found)]
                held = pa.table({"doc_id": pa.array(shard["winners"], pa.int64()), "row_id": pa.array(shard["winner_rows"], pa.int64()), "n_points": pa.array(shard["points"], pa.int32()), "copies": pa.array(shard["copies"], pa.int64())})
                out = [_looked_up(found, theirs, np.array(known, bool)), _looked_up(slots, held, np.ones(len(slots), bool))]
            return pa.concat_tables(out)

        return (
            self.shards.groupBy("bucket")
            .cogroup(_bucketed(rows, self.buckets).groupBy("bucket"))
            .applyInArrow(compare, LOOKED_UP)
        )


def _looked_up(found: list[bytes], table: pa.Table, known: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "digest": pa.array(found, pa.binary()),
            "doc_id": table.column("doc_id").cast(pa.int64()),
            "row_id": table.column("row_id").cast(pa.int64()),
            "n_points": table.column("n_points").cast(pa.int32()),
            "copies": table.column("copies").cast(pa.int64()),
            "known": pa.array(known, pa.bool_()),
        }
    )


def exact_duplicates(docs: DataFrame, in_history: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Group of every document among the history and the rest of ``docs``.

    ``in_history`` is a condition on ``doc_id`` that says which documents form the history; it only decides
    which digests go into the tables and which are looked up, never the result. Columns: doc_id, keep_id,
    group_size, kept, text_sha256, in_history (the text is one of the history's).
    """
    rows = digests(docs, doc_id, text).withColumns({"_old": F.coalesce(in_history, F.lit(False)), "row_id": F.monotonically_increasing_id()})
    rows = settled(rows, "digests")
    counted = rows.withColumn("copies", F.lit(1).cast("long"))
    arrived = counted.filter("not _old")
    history = History.of(distinct(counted.filter("_old")), arrived.count())
    looked_up = history.look_up(distinct(arrived))
    groups = (
        looked_up.groupBy("digest")
        .agg(_winner().alias("best"), F.sum("copies").alias("group_size"), F.max("known").alias("in_history"))
        .select("digest", F.bitwise_not("best.minus_id").alias("keep_id"), F.bitwise_not("best.minus_row").alias("keep_row"), "group_size", "in_history")
    )
    # A hot digest is one row of ``groups`` and many of ``rows``: adaptive execution splits its partition.
    return rows.hint("merge").join(settled(groups, "digest-groups"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "in_history",
    )
