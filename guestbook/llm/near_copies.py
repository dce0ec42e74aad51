"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sides. Fingerprints over the same shingles go through the vantage-point trees of ``simhash``,
which give the links of texts whose fingerprints differ in few bits. Others come from MinHash bands: a text has ``BANDS`` of them, each a hash of ``ROWS`` minima over its shingles
under as many multipliers. Two texts of similarity s share a band with probability 1 - (1 - s**ROWS)**BANDS: 0.999995
at 0.8, more above. Every candidate link is verified by the exact Jaccard similarity of the two sets. Texts with
equal sets are one class and are compared once.

Links are verified in two rounds. First each member of a band is compared with the band's hub, the member that meets
the most texts in all its bands: of an original and its copies, which may be less similar to each other than to it,
that is the original. So a large group of near copies is connected by few comparisons for each member. The second round takes only texts of bands
whose members are still in different components, and pairs them by prefixes: with its shingles in ascending order of
how many of these texts have them, a set of n shares one of its first n - ceil(0.8 n) + 1 with every set that is
similar enough (the smaller of two sets by a shorter prefix still). So texts that share a template, but not 0.8 of
their shingles, meet by their rare shingles alone, that is mostly not at all; what they have in common is in no prefix.
Sizes, places in the prefix and the number of shingles that a set has alone leave out pairs that cannot reach the
similarity any more. Sets are compared row by row in Spark, whatever their sizes.

Defined results: words are parted by ASCII white space and compared without the case of ASCII letters, as in
``simhash``; up to five words are one shingle; texts without words are copies of each other. Extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, encoded_texts_of, give_back, narrow
from guestbook.llm.components import components
from guestbook.llm.simhash import near_links
from guestbook.operators.joins import join_lookup
from guestbook.shared import drop_tables, settled

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 6
SEED = 42
CHUNK = 128
BITS_AT_ONCE = 1 << 15
PART = 256  # texts of a batch that are held as Python objects at a time
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: max(1, len(words) - SHINGLE_WORDS + 1)].tolist()
    ends = ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends)]), np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One long for each band."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), CHUNK):
        np.minimum(least, np.multiply.outer(hashes[at : at + CHUNK], MULTIPLIERS).min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes of the set; 0 for none."""
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        set_bits += np.unpackbits(hashes[at : at + BITS_AT_ONCE].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "little", signed=True)


def _sketches(rows: DataFrame) -> DataFrame:
    """(key, d1, d2, size, fp, bands): digest, size and fingerprint of the set, and the bands of one that is not empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            digests, sizes, prints, found = [], [], [], []
            for at in range(0, rows.num_rows, PART):
                for hashes in map(shingles, encoded_texts_of(rows.column("text").slice(at, PART))):
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    sizes.append(len(hashes))
                    prints.append(fingerprint(hashes))
                    found.append(bands(hashes) if len(hashes) else np.empty(0, np.int64))
            digests = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield batch(
                key=rows.column("key"),
                d1=pa.array(digests[:, 0].copy()),
                d2=pa.array(digests[:, 1].copy()),
                size=pa.array(sizes, pa.int64()),
                fp=pa.array(prints, pa.int64()),
                bands=pa.array(found, pa.list_(pa.int64())),
            )
        give_back()

    return rows.mapInArrow(work, "key long, d1 long, d2 long, size long, fp long, bands array<long>")


def _sets(rows: DataFrame) -> DataFrame:
    """(key, shingles) with the hashes of the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, PART):
                some = rows.slice(at, PART)
                held = [shingles(text).view(np.int64) for text in encoded_texts_of(some.column("text"))]
                yield batch(key=some.column("key"), shingles=pa.array(held, pa.list_(pa.int64())))
        give_back()

    return rows.mapInArrow(work, "key long, shingles array<long>")


def _verified(sets: DataFrame, pairs: DataFrame, similarity: float, name: str) -> DataFrame:
    """The ``pairs(u, v)`` whose sets are similar enough."""
    left = sets.select(F.col("key").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("key").alias("v"), F.col("shingles").alias("b"))
    compared = pairs.join(left.hint("merge"), "u").join(right.hint("merge"), "v")
    compared = compared.select("u", "v", F.size(F.array_intersect("a", "b")).alias("n_both"), (F.size("a") + F.size("b")).alias("n"))
    return settled(compared.filter(F.col("n_both") >= similarity * (F.col("n") - F.col("n_both"))).select("u", "v"), name)


def _by_prefix(sets: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) of different ``roots(key, root)`` among all that may be similar enough.

    Any order of shingles that is the same for all sets gives all pairs; the ascending one keeps prefixes apart.
    """
    each = settled(sets.select("key", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")), "shingle-rows")
    times = each.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1")
    found = each.hint("merge").join(times, "shingle", "left").withColumn("times", F.coalesce("times", F.lit(1)))
    order = F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("order")
    prefix = F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - 1e-9).cast("int") + 1
    found = found.groupBy("key", "size").agg(order, F.count_if(F.col("times") == 1).alias("own"))
    found = found.select("key", "size", "own", F.posexplode(F.slice("order", F.lit(1), prefix)).alias("at", "o"))
    found = found.filter("o.times > 1").select("key", "size", "own", "at", F.col("o.shingle").alias("shingle"))
    found = found.hint("merge").join(roots, "key")
    ends = found.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("shingle")
    found = settled(found.hint("merge").join(ends, "shingle", "left_semi"), "prefixes")
    # Of two sets the smaller one needs a shorter prefix: it shares more than that part of itself with a larger one.
    shorter = F.col("size") - F.ceil(F.lit(2 * similarity / (1 + similarity)) * F.col("size") - 1e-9) + 1
    smaller = found.filter(F.col("at") < shorter)
    smaller = smaller.selectExpr("shingle", "key as v", "root as v_root", "size as v_size", "own as v_own", "at as v_at")
    both = found.hint("merge").join(smaller, "shingle").filter("(v_size, v) < (size, key) and root <> v_root")
    both = both.filter(_fits(similarity, "size", "v_size"))
    least = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("size") + F.col("v_size")) - 1e-9)
    both = both.filter(F.least(F.col("size") - F.col("own"), F.col("v_size") - F.col("v_own")) >= least)
    before = F.least(F.col("at") - F.col("own"), F.col("v_at") - F.col("v_own"))
    both = both.filter(F.least(F.col("size") - F.col("at"), F.col("v_size") - F.col("v_at")) + before >= least)
    return both.selectExpr("least(key, v) as u", "greatest(key, v) as v").distinct()


def _by_trees(alone: DataFrame) -> DataFrame:
    """Pairs (u, v) of ``alone(key, fp)``: texts with one fingerprint, each with the first of them, and the first texts
    of fingerprints that the trees link."""
    prints = settled(alone.groupBy("fp").agg(F.min("key").alias("first")), "fingerprints")
    linked = near_links(prints.select("fp"))
    linked = join_lookup(linked, prints.selectExpr("fp as u", "first as a"), "u", costly=True)
    linked = join_lookup(linked, prints.selectExpr("fp as v", "first as b"), "v", costly=True)
    equal = alone.select("key", "fp").hint("merge").join(prints, "fp").filter("key <> first")
    return equal.selectExpr("first as u", "key as v").unionByName(linked.selectExpr("least(a, b) as u", "greatest(a, b) as v"))


def _fits(similarity: float, a: str, b: str) -> str:
    return f"least({a}, {b}) >= {similarity} * greatest({a}, {b})"


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, key: str = "key", text: str = "text") -> DataFrame:
    """(key, component) for every row; ``key`` is a long, without nulls and repeats, and ``component`` the smallest
    one that is reachable over links."""
    rows = narrow(docs, key=key, text=text)
    sketches = settled(_sketches(rows), "sketches")
    classes = settled(sketches.groupBy("d1", "d2").agg(F.min("key").alias("node")), "classes")
    alone = settled(sketches.hint("merge").join(classes.select(F.col("node").alias("key")), "key", "left_semi"), "one-of-each")
    every = settled(alone.select(F.col("key").alias("node"), "size", F.explode("bands").alias("band")), "bands")
    shared = every.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met = settled(every.hint("merge").join(shared, "band"), "met-in-bands")  # a hot band is split by adaptive execution
    often = met.groupBy("node").agg(F.sum("n").alias("met"))
    met = settled(met.drop("n").hint("merge").join(often, "node"), "band-members")
    central = F.max(F.struct("met", F.bitwise_not("node").alias("other"))).alias("c")
    hubs = met.groupBy("band").agg(central).select("band", F.bitwise_not("c.other").alias("hub"))
    members = settled(met.drop("met").hint("merge").join(hubs, "band"), "hub-members")
    sizes = members.filter("node = hub").select("hub", F.col("size").alias("hub_size")).distinct()
    asked = members.filter("node <> hub").select("node", "hub", "size").distinct().hint("merge").join(sizes, "hub")
    asked = asked.filter(_fits(similarity, "size", "hub_size")).selectExpr("least(hub, node) as u", "greatest(hub, node) as v")
    asked = settled(asked.unionByName(_by_trees(alone)).distinct(), "first-pairs")
    wanted = asked.selectExpr("explode(array(u, v)) as key").distinct()
    sets = settled(_sets(join_lookup(rows, wanted, "key", "left_semi", costly=True)), "sets")
    links = _verified(sets, asked, similarity, "hub-links")
    drop_tables(every, alone, met, sets, asked)
    roots = settled(components(links), "hub-components")
    placed = members.hint("merge").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band")
    open_ends = settled(placed.hint("merge").join(mixed, "band", "left_semi").select(F.col("node").alias("key"), "root").distinct(), "open-ends")
    sets = settled(_sets(join_lookup(rows, open_ends.select("key"), "key", "left_semi")), "open-sets")
    more = _verified(sets, settled(_by_prefix(sets, open_ends, similarity), "prefix-pairs"), similarity, "cross-links")
    roots = components(links.unionByName(more))
    drop_tables(sets, open_ends, members)
    named = classes.hint("merge").join(roots, "node", "left").select("d1", "d2", F.coalesce("root", "node").alias("component"))
    # A set with many copies is one row of ``named`` and many of ``sketches``: adaptive execution splits its partition.
    return sketches.select("key", "d1", "d2").hint("merge").join(named, ["d1", "d2"]).select("key", "component")
