"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in a fixed shuffled order, are cut into blocks. With weight w, its share of the sum of all
weights, the k-th block of a source is released at floor((k - 1) / w) and due at ceil(k / w); earliest deadline first
fills one slot after the other. Weights are taken as the exact fractions that they are, so that at every slot each
source that is not used up has had its target share to less than one block, however many sources and rows there are.
Where no block is released - some sources are used up - slots stay empty until the next is.

A block has as many rows as asked for, one for instance, over any number of rows. If none are asked for, it has one up
to ``MOST_BLOCKS`` rows in all, and beyond as many as leave ``MOST_BLOCKS`` blocks and one for each source at most.

The schedule is cut into rounds of many blocks. The driver only finds how many blocks of every source each round
begins with, without placing them: blocks that are due by a round's end fill its slots in any order, and the few that
are not - one of a source at most - take what is left by their deadlines. Rows then go to the tasks of their rounds,
and each of these places the blocks of its own rounds. How rounds are cut changes no place.
Numbering the rows of a source takes one range shuffle, in which a hot source fills many partitions. All rows are
placed.

Defined results: a null source is a source of its own. Sources without a positive weight come after all others, in
equal shares. Rows of equal source and id follow each other in the order of a hash of all their columns. Columns that
are not read pass through; ``block``, ``slot`` and ``position`` are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.ordered import numbered

MOST_BLOCKS = 1 << 20
ROUNDS, LEAST_IN_ROUND, MOST_IN_ROUND, IN_ROUND_OF_SOURCE = 512, 1 << 8, 1 << 16, 1 << 5


def tempered(counts: dict[str | None, int], temperature: float = 0.5) -> dict[str | None, float]:
    """Weights between the sources' sizes (1) and equal parts (0)."""
    return {source: n**temperature for source, n in counts.items()}


def whole_weights(weights: list) -> list[int]:
    """Whole numbers in the exact proportions of the weights; 0 for what is not positive."""
    exact = [Fraction(w) if w is not None and math.isfinite(w) and w > 0 else Fraction(0) for w in weights]
    common = math.lcm(*[w.denominator for w in exact])
    return [int(w * common) for w in exact]


def slots_of(weights: list[int], blocks: list[int], start: int = 0, first: list[int] | None = None, slot: int = 0) -> list[np.ndarray]:
    """The slot of every block of every source, from ``start`` on: earliest deadline first among the released ones.

    With ``first``, that of the blocks from each source's first one on, when the ones before are placed before ``slot``.
    """
    total, first = sum(weights), first or [0] * len(blocks)
    out = [np.zeros(n - k, np.int64) for k, n in zip(first, blocks)]
    waiting = [(k * total // w, -(-(k + 1) * total // w), s, k) for s, (w, k, n) in enumerate(zip(weights, first, blocks)) if k < n]
    heapq.heapify(waiting)  # release, deadline, source, block
    ready: list[tuple[int, int, int]] = []
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, deadline, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, k))
        _, s, k = heapq.heappop(ready)
        out[s][k - first[s]] = start + slot
        slot, k = slot + 1, k + 1
        if k < blocks[s]:
            heapq.heappush(waiting, (k * total // weights[s], -(-(k + 1) * total // weights[s]), s, k))
    return out


def rounds_of(weights: list[int], blocks: list[int], most: int) -> Iterator[tuple[int, list[int], int]]:
    """Rounds of about ``most`` blocks of the same schedule: the slot at which each begins, how many blocks of every
    source are placed when it ends, and its last slot that is filled."""
    total, slot, done = sum(weights), 0, [0] * len(blocks)
    live = [s for s, n in enumerate(blocks) if n]
    while live:
        span, left = most, sum(blocks[s] - done[s] for s in live)
        while True:
            end = slot + span
            due = [max(done[s], min(end * weights[s] // total, blocks[s])) for s in live]
            n = sum(due) - sum(done[s] for s in live)
            if 2 * n >= most or n == left:
                break
            span *= 2
        released = [np.array([k * total // weights[s] for k in range(done[s], k_end)], np.int64) for s, k_end in zip(live, due)]
        released = np.sort(np.maximum(np.concatenate(released), slot), kind="stable")
        filled = np.arange(n) + np.maximum.accumulate(released - np.arange(n))  # by blocks that are due in the round
        waiting = [(k * total // weights[s], -(-(k + 1) * total // weights[s]), s) for s, k in zip(live, due) if k < blocks[s]]
        others = _left_over(filled, sorted(x for x in waiting if x[0] < end), slot, end)
        begin, last, slot = slot, max([*others.values(), int(filled[-1]) if n else -1]), end
        for s, k in zip(live, due):
            done[s] = k + (s in others)
        yield begin, done.copy(), last
        live = [s for s in live if done[s] < blocks[s]]


def _left_over(filled: np.ndarray, waiting: list[tuple[int, int, int]], slot: int, end: int) -> dict[int, int]:
    """Source -> slot of the blocks (release, deadline, source) that find one before ``end`` which is not filled."""
    goes_on = np.append(np.diff(filled) == 1, False)
    runs = np.nonzero(~goes_on)[0]  # the last place of every run of filled slots
    found, ready, at = {}, [], 0
    while ready or at < len(waiting):
        if not ready:
            slot = max(slot, waiting[at][0])
        place = int(np.searchsorted(filled, slot))
        if place < len(filled) and filled[place] == slot:
            slot = int(filled[runs[np.searchsorted(runs, place)]]) + 1
        if slot >= end:
            break
        while at < len(waiting) and waiting[at][0] <= slot:
            heapq.heappush(ready, waiting[at][1:])
            at += 1
        found[heapq.heappop(ready)[1]] = slot
        slot += 1
    return found


@dataclass
class Schedule:
    """Of each round: its place in the schedule, how many blocks of every source stand before it, and rows."""

    weights: tuple[list[int], list[int]]
    rows: list[int]
    block_rows: int
    begins: list[tuple[int, int, int]]  # which weights hold, the slot from which they do, the slot in these
    done: np.ndarray  # for each round and at the end, by source
    before: np.ndarray

    @classmethod
    def of(cls, weights: list, rows: list[int], block_rows: int | None = None) -> Schedule:
        """From each source's weight and number of rows."""
        block_rows = block_rows or max(1, -(-sum(rows) // MOST_BLOCKS))
        whole, blocks = whole_weights(weights), [-(-n // block_rows) for n in rows]
        most = max(LEAST_IN_ROUND, min(sum(blocks) // ROUNDS, MOST_IN_ROUND), IN_ROUND_OF_SOURCE * len(rows))
        both = whole, [1 - bool(w) for w in whole]
        begins, done, start, last, before = [], [[0] * len(rows)], 0, -1, [0] * len(rows)
        for which, some in enumerate(both):
            for slot, placed, filled in rounds_of(some, [n if w else 0 for w, n in zip(some, blocks)], most):
                begins.append((which, start, slot))
                done.append([a + b for a, b in zip(before, placed)])
                last = max(last, start + filled)
            before, start = done[-1], last + 1
        done = np.array(done, np.int64)
        return cls(both, rows, block_rows, begins, done, np.minimum(done * block_rows, np.array(rows, np.int64)).sum(axis=1))

    def rounds(self, source: int, block: np.ndarray) -> np.ndarray:
        """The rounds of blocks of a source."""
        return np.searchsorted(self.done[1:, source], block, "right")

    def placed(self, number: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For the blocks of every source in a round: slots, and how many rows stand before each."""
        which, start, slot = self.begins[number]
        first, end = self.done[number].tolist(), self.done[number + 1].tolist()
        slots = slots_of(self.weights[which], end, start, first, slot)
        flat = np.concatenate(slots)
        sizes = [np.minimum(self.block_rows, n - self.block_rows * np.arange(a, b)) for n, a, b in zip(self.rows, first, end)]
        order, sizes = np.argsort(flat), np.concatenate(sizes)
        starts = np.empty(len(flat), np.int64)
        starts[order] = self.before[number] + np.cumsum(sizes[order]) - sizes[order]
        return slots, np.split(starts, np.cumsum([len(some) for some in slots])[:-1])

    @cached_property
    def slots(self) -> np.ndarray:
        """The slots of all blocks, one source after the other."""
        return self._all[0]

    @cached_property
    def starts(self) -> np.ndarray:
        """How many rows stand before each block, one source after the other."""
        return self._all[1]

    @cached_property
    def _all(self) -> list[np.ndarray]:
        each = [self.placed(number) for number in range(len(self.begins))]
        return [np.concatenate([some[k][s] for s in range(len(self.rows)) for some in each]) for k in range(2)]


def mixed(
    docs: DataFrame, weights: dict | None = None, block_rows: int | None = None, doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """``docs`` with ``block`` (its number in the source), ``slot`` and ``position`` (0, 1, ... over all rows), sorted
    by position over all partitions.

    Without ``weights`` they follow the square roots of the sources' row counts.
    """
    docs = docs.drop("block", "slot", "position")
    columns = [F.col(f"`{name}`") for name in docs.columns]
    keyed = docs.select(
        F.col(f"`{source}`").alias("source"),
        F.xxhash64(F.col(f"`{doc_id}`"), F.lit("mix")).alias("drawn"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(*columns).alias("tie"),
        F.struct(*columns).alias("row"),  # its names cannot clash with these
    )
    local, offsets = numbered(keyed, "source", ["drawn", "doc_id", "tie"], "numbered")
    counts: dict[str | None, int] = {row.source: row.n for row in local.groupBy("source").agg(F.count("*").alias("n")).collect()}
    sources = sorted(counts, key=lambda name: (name is None, name))
    weights = tempered(counts) if weights is None else weights
    schedule = Schedule.of([weights.get(name) for name in sources], [counts[name] for name in sources], block_rows) if sources else None
    held = docs.sparkSession.sparkContext.broadcast((schedule, {name: s for s, name in enumerate(sources)}, offsets))

    def to_rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule, index, offsets = held.value
        for rows in batches:
            names, parts = rows.column("source").to_pylist(), rows.column("_part").to_pylist()
            number = rows.column("_local").to_numpy() + np.array([offsets[key] for key in zip(parts, names)], np.int64)
            of = np.array([index[name] for name in names], np.int64)
            rounds = np.empty(len(of), np.int64)
            for s in np.unique(of).tolist():
                rounds[of == s] = schedule.rounds(s, number[of == s] // schedule.block_rows)
            added = [pa.array(x) for x in (rounds, of, number)]
            yield pa.RecordBatch.from_arrays([rows.column("row"), *added], names=["row", "round", "of", "number"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule, last, table = held.value[0], -1, None
        for rows in batches:
            rounds, of, number = (rows.column(name).to_numpy() for name in ("round", "of", "number"))
            block = number // schedule.block_rows
            slot, position = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
            for this in np.unique(rounds).tolist():
                if this != last:
                    slots, starts = schedule.placed(this)
                    first = schedule.done[this] - np.cumsum([0, *map(len, slots)])[:-1]
                    last, table = this, (first, np.concatenate(slots), np.concatenate(starts))
                first, slots, starts = table
                mine = np.nonzero(rounds == this)[0]
                at = block[mine] - first[of[mine]]
                slot[mine], position[mine] = slots[at], starts[at] + number[mine] % schedule.block_rows
            added = [pa.array(x) for x in (block, slot, position)]
            yield pa.RecordBatch.from_arrays([*rows.column("row").flatten(), *added], names=schema.names)

    schema = docs.selectExpr("*", "0L as block", "0L as slot", "0L as position").schema
    dealt = local.mapInArrow(to_rounds, local.selectExpr("row", "0L as round", "0L as of", "0L as number").schema)
    dealt = dealt.repartitionByRange("round").sortWithinPartitions("round")
    return dealt.mapInArrow(work, schema).sortWithinPartitions("position")


def in_order(placed: DataFrame) -> DataFrame:
    """Rows sorted by position over all partitions: files written from this follow the schedule."""
    return placed.repartitionByRange("position").sortWithinPartitions("position")
