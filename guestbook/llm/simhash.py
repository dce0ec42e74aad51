"""SimHash near-duplicates: exact pairs of 64-bit fingerprints from vantage-point trees.

A tree whose vantage points come from a bounded sample deals every distinct fingerprint to one home shard: at
each node those within the median distance of the vantage point go left, the others right. As a query, a
fingerprint also goes to the shards across each boundary that the triangle inequality cannot exclude: left
if ``d - radius <= median``, right if ``d + radius > median``. Inside a shard a smaller tree of the same kind
prunes branches for whole arrays of queries, and leaves compare fingerprints bit by bit. So every pair within the radius is found,
in the home shard of one of its two ends. A shard is dealt over tasks in blocks: each home block meets each block of
the queries, so that a task holds two blocks however many fingerprints a shard has or is asked by. It sends on no pairs
but the forest that they span. Copies in other shards, which queries are, grow faster than the fingerprints: about
with their power 1.75 at the radius of 4 bits.

Copies share a fingerprint and meet in a partial aggregate, so that the trees see each fingerprint once.

Defined results: a null text is an empty one; a text without words has fingerprint zero, which links like any
other. A null ``doc_id`` is no component's name unless nothing else is in it. Repeated rows keep their own
result rows. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, encoded_texts_of, narrow
from guestbook.llm.components import components, joined
from guestbook.operators.joins import join_lookup
from guestbook.shared import settled

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
SHARD_FINGERPRINTS = 100_000
SAMPLE = 4_096  # fingerprints that the top tree is grown from, or this many for each of its shards:
SAMPLE_OF_SHARD = 8
MOST_SHARDS = 50_000
BLOCK = 200_000  # fingerprints of either side that a task holds
PAIRS_AT_ONCE = 1 << 20
LEAF = 96
CHUNK = 1 << 15


def fingerprint(text: bytes) -> int:
    """Bits that are set in over half of the hashes of all shingles. ``bytes.split`` and ``bytes.lower`` know
    exactly the white space and the letters meant here."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - SHINGLE_WORDS + 1].tolist()
    ends = ends[SHINGLE_WORDS - 1 :].tolist()
    set_bits, count, digest = np.zeros(64, np.int64), len(starts), xxhash.xxh64_digest
    for at in range(0, count, CHUNK):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(set_bits * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) with the fingerprint's bits as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [fingerprint(text) for text in encoded_texts_of(rows.column("text"))]
            yield batch(doc_id=rows.column("doc_id"), fp=pa.array(np.array(found, np.uint64).view(np.int64)))

    rows = narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(work, "doc_id long, fp long")


def distances(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point)


class Tree:
    """Vantage-point tree. ``nodes`` holds (vantage point, median, left, right); a leaf is its number."""

    def __init__(self, sample: np.ndarray, leaf: int):
        self.nodes: list[tuple[np.uint64, int, int, int]] = []
        self.leaves: list[np.ndarray] = []
        self.leaf = max(1, leaf)
        self.top = self._grow(sample, 0)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        if len(points) > self.leaf and depth < 60:
            vantage = points[(depth * 7919) % len(points)]
            far = distances(points, vantage)
            median = int(np.median(far))
            near = far <= median
            if near.all():  # a tie at the top: cut below it
                median = int(far.max()) - 1
                near = far <= median
            if 0 < near.sum() < len(points):
                at = len(self.nodes)
                self.nodes.append((vantage, median, 0, 0))
                left, right = self._grow(points[near], depth + 1), self._grow(points[~near], depth + 1)
                self.nodes[at] = (vantage, median, left, right)
                return at
        self.leaves.append(points)
        return -len(self.leaves)

    def visits(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions of the queries whose ball of that radius may meet it); radius 0 gives the home."""
        todo = [(self.top, np.arange(len(queries)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield -node - 1, at
                continue
            vantage, median, left, right = self.nodes[node]
            far = distances(queries[at], vantage).astype(np.int16)
            todo += [(left, at[far - radius <= median]), (right, at[far + radius > median])]


def _pairs(home: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (query, home) of all pairs of different fingerprints within the radius."""
    order = np.argsort(home)
    tree = Tree(home, LEAF)
    sorted_home = home[order]
    for leaf, at in tree.visits(queries, radius):
        points = tree.leaves[leaf]
        places = order[np.searchsorted(sorted_home, points)]
        for start in range(0, len(at), CHUNK):
            some = at[start : start + CHUNK]
            i, j = np.nonzero(np.bitwise_count(queries[some][:, None] ^ points[None, :]) <= radius)
            different = queries[some[i]] != points[j]
            yield some[i[different]], places[j[different]]


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that span the same components as all pairs within ``radius`` of ``distinct(fp)``."""
    spark, count = distinct.sparkSession, distinct.count()
    shards = min(MOST_SHARDS, max(1, -(-count // SHARD_FINGERPRINTS)))
    wanted = max(SAMPLE, SAMPLE_OF_SHARD * shards)
    share = min(1.0, wanted / max(1, count))
    kept = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) <= int(share * (1 << 40)))
    sample = np.array([row.fp for row in kept.limit(2 * wanted).collect()], np.int64).view(np.uint64)
    top = spark.sparkContext.broadcast(Tree(np.sort(sample), -(-len(sample) // shards)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            points = rows.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.empty(len(points), np.int32)
            for leaf, at in top.value.visits(points, 0):
                home[at] = leaf
            for leaf, at in top.value.visits(points, radius):
                yield batch(
                    shard=pa.array(np.full(len(at), leaf, np.int32)),
                    fp=pa.array(points[at].view(np.int64)),
                    home=pa.array(home[at] == leaf),
                )

    def search(table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        asks = table.column("asks").to_numpy()
        homes, queries = np.nonzero(~asks)[0], np.nonzero(asks)[0]
        label, held, size = np.arange(len(points)), [], 0
        if len(homes) and len(queries):
            for q, h in _pairs(points[homes], points[queries], radius):
                held.append((queries[q], homes[h]))
                size += len(q)
                if size > PAIRS_AT_ONCE:
                    label, held, size = _joined(label, held), [], 0
        label = _joined(label, held)
        linked = np.nonzero(label != np.arange(len(label)))[0]
        signed = points.view(np.int64)
        return pa.table({"u": signed[linked], "v": signed[label[linked]]})

    dealt = settled(distinct.mapInArrow(deal, "shard int, fp long, home boolean"), "dealt-fingerprints")
    sizes = dealt.groupBy("shard").agg(F.count_if("home").alias("homes"), F.count("*").alias("queries"))
    blocks = sizes.selectExpr("shard", f"ceil(homes / {BLOCK}) as home_blocks", f"ceil(queries / {BLOCK}) as query_blocks")
    dealt = join_lookup(dealt, blocks.filter("home_blocks > 0"), "shard", costly=True)
    own, every = "pmod(xxhash64(fp, 'block'), {0}_blocks)", "explode(sequence(0L, {0}_blocks - 1L))"
    asking = dealt.selectExpr("shard", "fp", f"{own.format('query')} as q", f"{every.format('home')} as h", "true as asks")
    held = dealt.filter("home").selectExpr("shard", "fp", f"{every.format('query')} as q", f"{own.format('home')} as h", "false as asks")
    return asking.unionByName(held).groupBy("shard", "h", "q").applyInArrow(search, "u long, v long")


def _joined(label: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return joined(label, *(np.concatenate(ends) for ends in zip(*links))) if links else label


def near_duplicates(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links)."""
    rows = settled(fingerprints(docs, doc_id, text), "fingerprints")
    by_print = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(near_links(by_print.select("fp"), radius))
    members = by_print.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = settled(members.join(least, "root").select("fp", "component_id"), "near-groups")
    # A hot fingerprint is one row of ``named`` and many of ``rows``: adaptive execution splits its partition.
    return rows.hint("merge").join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
