"""Packing token sequences: dominance reduction, then best fit.

Documents are encoded whole, each with an end id; only those longer than ``capacity`` are cut, into full pieces after
a first one that holds what is left over. What has to be packed is then a number of pieces for each length, which is
all that the plan is made from: a table of at most ``capacity`` rows however many documents there are.

The plan first fixes sets of one to three pieces that dominate every other sequence with the same piece j, after
Martello and Toth: j alone if nothing else fits; j with a piece that fills the sequence; j with the largest piece that
fits, if at most one more piece fits or no two that fit are longer together; j with the largest pair that fits, if at
most two fit and no pair that fits is longer in its longer or in its shorter piece. Exchanging pieces turns any packing
into one with the fixed sequence and no more sequences, so an optimum is left. A set is fixed as often as its pieces
last, and lengths are gone through again until nothing more can be fixed. The remainder goes in descending order of
length into the fullest sequence that has room. Sequences of one make are planned together, so that the plan has a few
entries for each length.

Pieces are numbered within their lengths by one range shuffle of slim rows (a length that a third of all pieces have
fills many partitions), look up their number in the plan, and are joined with their ids.

Defined results: a null text is an empty one, of which only the end id remains. Rows that share an id, and rows
without one, are documents of their own. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, narrow
from guestbook.llm.chunk_ids import encoder
from guestbook.llm.ordered import numbered
from guestbook.shared import settled

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length int, ids binary, id_bytes int"
ROW_GROUP_BYTES = 16 << 20


@dataclass
class Plan:
    """Where the pieces of every length go. ``entries``: length -> (first number, pieces in a sequence, first
    sequence, place in the sequence), ascending by the first number of a piece of that length."""

    capacity: int
    entries: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    used: dict[int, int] = field(default_factory=dict)
    sequences: int = 0
    fixed: int = 0

    @classmethod
    def of(cls, counts: dict[int, int], capacity: int) -> Plan:
        """From the number of pieces of every length."""
        plan = cls(capacity)
        left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            left[length] = n
        for lengths, times in reduced(left):
            plan.add([(length, lengths.count(length)) for length in dict.fromkeys(lengths)], times)
        plan.fixed = plan.sequences
        for pattern, times in best_fit(left, capacity):
            plan.add(pattern, times)
        return plan

    def add(self, pattern: list[tuple[int, int]], times: int) -> None:
        """``times`` sequences with so many pieces of each length."""
        place = 0
        for length, n in pattern:
            number = self.used.get(length, 0)
            self.entries.setdefault(length, []).append((number, n, self.sequences, place))
            self.used[length] = number + n * times
            place += n * length
        self.sequences += times

    def arrays(self) -> dict[int, np.ndarray]:
        return {length: np.array(entries, np.int64) for length, entries in self.entries.items()}


def reduced(left: np.ndarray) -> Iterator[tuple[list[int], int]]:
    """Dominating sets and how often each is fixed; what they use is taken off ``left``."""
    changed = True
    while changed:
        changed = False
        for length in np.flatnonzero(left)[::-1].tolist():
            while left[length] and (found := dominating(left, length)):
                times = min(int(left[x]) // found.count(x) for x in found)
                for x in found:
                    left[x] -= times
                changed = True
                yield found, times


def dominating(left: np.ndarray, length: int) -> list[int] | None:
    """A set with a piece of this length that dominates every other one, if a rule proves one."""
    room = len(left) - 1 - length
    left[length] -= 1
    others = np.flatnonzero(left[: room + 1]).tolist()  # lengths that fit, ascending
    n_of = [int(left[x]) for x in others]
    left[length] += 1
    if not others:
        return [length]
    largest = others[-1]
    least: list[int] = []
    for x, n in zip(others, n_of):
        least += [x] * min(n, 3 - len(least))
        if len(least) == 3:
            break
    if largest == room or sum(least[:2]) > room or len(least) < 2:
        return [length, largest]
    if len(least) == 3 and sum(least) <= room:
        return None
    longest, shorter = _best_pair(others, n_of, room)
    if longest <= largest:
        return [length, largest]
    n_of[-1] -= 1
    at = bisect.bisect_right(others, room - largest) - 1
    if at == len(others) - 1 and not n_of[-1]:
        at -= 1
    return [length, largest, others[at]] if at >= 0 and others[at] >= shorter else None


def _best_pair(lengths: list[int], n_of: list[int], room: int) -> tuple[int, int]:
    """The longest two pieces together that fit, and the longest shorter piece of any two that fit."""
    longest = shorter = 0
    high = len(lengths) - 1
    for low, x in enumerate(lengths):
        while high >= 0 and lengths[high] + x > room:
            high -= 1
        if high < low or high == low and n_of[low] < 2:
            break
        longest, shorter = max(longest, x + lengths[high]), x
    return longest, shorter


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns and how many sequences have each, pieces in descending order of length."""
    open_by_room: list[list[tuple[list[tuple[int, int]], int]]] = [[] for _ in range(capacity + 1)]
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        for room in range(length, capacity):
            if not n:
                break
            fits, found = room // length, open_by_room[room]
            while n and found:
                pattern, times = found.pop()
                filled = min(times, n // fits)
                if filled:
                    open_by_room[room - fits * length].append((pattern + [(length, fits)], filled))
                    n, times = n - filled * fits, times - filled
                if times and n:
                    open_by_room[room - n * length].append((pattern + [(length, n)], 1))
                    n, times = 0, times - 1
                if times:
                    found.append((pattern, times))
        fits = capacity // length
        if n >= fits:
            open_by_room[capacity - fits * length].append(([(length, fits)], n // fits))
        if n % fits:
            open_by_room[capacity - n % fits * length].append(([(length, n % fits)], 1))
        left[length] = 0
    return [group for groups in open_by_room for group in groups]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids of every document, with ``end_id`` after them, in pieces of at most ``capacity``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        end, width, full = np.array([end_id], made.kind).tobytes(), made.width, capacity * made.width
        for rows in batches:
            of, number, starts, found = [], [], [], []
            for row, ids in enumerate(made.texts(rows.column("text"))):
                ids += end
                cuts = [0, *range(len(ids) % full or full, len(ids) + 1, full)]
                of += [row] * (len(cuts) - 1)
                number += range(len(cuts) - 1)
                starts += cuts[:-1]
                found += [ids[a:b] for a, b in zip(cuts, cuts[1:])]
            ids = pa.array(found, pa.binary())
            lengths = np.fromiter(map(len, found), np.int32, len(found)) // width
            yield batch(
                doc_id=rows.column("doc_id").take(pa.array(of, pa.int64())),
                piece=pa.array(number, pa.int32()),
                start=pa.array(np.array(starts, np.int64) // width),
                length=pa.array(lengths.astype(np.int32)),
                ids=ids,
                id_bytes=pa.array(np.full(len(found), width, np.int32)),
            )

    return narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, sequence_id, offset) of every piece of a settled table (key, length)."""
    counts = {row.length: row.n for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = Plan.of(counts, capacity)  # at most ``capacity`` lengths
    local, offsets = numbered(cut.select("length", "key"), "length", ["key"], "numbered-pieces")
    held = cut.sparkSession.sparkContext.broadcast((plan.arrays(), offsets))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, offsets = held.value
        for rows in batches:
            lengths, parts = rows.column("length").to_numpy(), rows.column("_part").to_numpy()
            number, sequence, offset = rows.column("_local").to_numpy().copy(), np.empty(rows.num_rows, np.int64), np.empty(rows.num_rows, np.int64)
            for part, length in set(zip(parts.tolist(), lengths.tolist())):
                mine = (parts == part) & (lengths == length)
                n = number[mine] + offsets[part, length]
                first, each, start, place = entries[length][np.searchsorted(entries[length][:, 0], n, "right") - 1].T
                sequence[mine] = start + (n - first) // each
                offset[mine] = place + (n - first) % each * length
            yield batch(key=rows.column("key"), sequence_id=pa.array(sequence), offset=pa.array(offset))

    return local.mapInArrow(work, "key long, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start (its document's ids before it), length, ids (little-endian unsigned integers of
    ``id_bytes`` bytes), sequence_id and offset (its place there) of every piece."""
    cut = pieces(docs, path, end_id, capacity, doc_id, text).withColumn("key", F.monotonically_increasing_id())
    cut = settled(cut, "pieces")
    where = settled(placed(cut.select("key", "length"), capacity), "placed-pieces")
    return cut.join(where.hint("merge"), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and lengths (of its pieces) of every sequence: at most ``capacity`` pieces meet in a row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    found = packed.groupBy("sequence_id", "id_bytes").agg(parts.alias("parts"))
    whole = F.aggregate("parts.ids", F.lit(b""), lambda held, ids: F.concat(held, ids))
    return found.select("sequence_id", "id_bytes", whole.alias("ids"), F.col("parts.length").alias("lengths"))


def digested(packed: DataFrame) -> DataFrame:
    """``packed`` with ``ids_crc32`` (of unsigned 32-bit integers) in place of the ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            widths, ids = rows.column("id_bytes").to_pylist(), rows.column("ids")
            found = [zlib.crc32(np.frombuffer(x.as_buffer(), f"<u{width}").astype("<u4").tobytes()) for x, width in zip(ids, widths)]
            passed = ("doc_id", "piece", "start", "length", "sequence_id", "offset")
            yield batch(**{name: rows.column(name) for name in passed}, ids_crc32=pa.array(found, pa.int64()))

    schema = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids_crc32 long"
    return packed.withColumn("length", F.col("length").cast("long")).mapInArrow(work, schema)
