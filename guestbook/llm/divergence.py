"""Source divergence audit: how far the sources of a language are apart in their use of words.

A first pass counts, exactly, in how many documents of a language each term stands; terms in fewer than ``min_docs``
are dropped. The kept terms of a language are dealt over shards by a 128-bit digest, and every shard becomes a minimal
perfect hash: a few levels of bit arrays in which each term has a bit of its own, whose rank is the term's slot, and
the terms themselves in slot order. The shards are broadcast, at most ``PASS_BYTES`` of them at a time: a second pass
over the texts looks terms up, compares them with the stored ones, and increments a dense array of slots for each
group of a language and a source, which tasks add up and send on as few rows. A vocabulary beyond the limit takes
further passes.

Smoothed shares in parts of 1,000,000,000 are whole numbers: p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)) with the
V kept terms of the language and N their occurrences in a group (or, for the language itself, in all of it). Part
``pair`` compares a source with each other source of its language: the sum of the absolute differences of p over all
kept terms. Terms are dealt over blocks in which a few dense rows, one for each source, are compared. Part ``term``
holds the ``top`` terms that a source has more of than its language, by the difference of p.

Defined results: null texts, languages and sources are empty strings. A term is a run of characters that are not ASCII,
or ASCII letters, of which A to Z are lower-cased. Every row is a document. A group without terms takes part with
count 0; a language without kept terms has pairs of value 0 and no terms. Equal values are ranked by the item's UTF-8
bytes. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestbook.llm.batches import batch
from guestbook.operators.joins import join_lookup
from guestbook.shared import settled

MIN_DOCS = 30
TOP = 50
SHARD_TERMS = 1 << 16
LEVELS = 64
PASS_BYTES = 64 << 20  # of kept terms that are broadcast at a time
ROWS_AT_ONCE = 256
HELD_TERMS = 1_000_000  # distinct terms that a task of the first pass holds
REMEMBERED = 500_000  # terms of a language whose slots a task remembers
DENSE_CELLS = 8 << 20  # counters that a task of the second pass holds
BLOCK_CELLS = 1 << 18  # shares that are compared at a time
TILE_SOURCES = 1_000

LETTERS = bytes(c if c > 127 else c | 32 if chr(c).isalpha() else 32 for c in range(256))
SHARD = "lang string, shard int, n_shards int, n_terms int, sizes array<int>, bits binary, terms array<string>"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(LETTERS).split() if text else []


def rows_of(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    return docs.select(*[F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")).alias(name) for name, x in (("lang", lang), ("source", source), ("text", text))])


def document_counts(rows: DataFrame) -> DataFrame:
    """(lang, term, n_docs) of every term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for rows in batches:
            for at in range(0, rows.num_rows, ROWS_AT_ONCE):
                some = rows.slice(at, ROWS_AT_ONCE)
                for lang, text in zip(some.column("lang").to_pylist(), some.column("text").cast(pa.binary()).to_pylist()):
                    counts[lang].update(set(terms_of(text)))
                if sum(map(len, counts.values())) > HELD_TERMS:
                    yield from _sent(counts)
                    counts.clear()
        yield from _sent(counts)

    found = rows.select("lang", "text").mapInArrow(work, "lang string, term string, n_docs long")
    return found.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))


def _sent(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, found in counts.items():
        terms = pa.array(list(found), pa.binary()).cast(pa.string())
        yield batch(lang=pa.array([lang] * len(found), pa.string()), term=terms, n_docs=pa.array(list(found.values()), pa.int64()))


def _digests(terms: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, terms)), "<u8").reshape(-1, 2)


def _positions(digests: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    mixed = (digests[:, 0] ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31)) ^ digests[:, 1]) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(29))) % np.asarray(size, np.uint64)).astype(np.int64)


def perfect_hash(terms: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits in a row, and the slot of every term: on each level of twice as many bits as
    terms are left, those that are alone at their position get its bit."""
    digests, left = _digests(terms), np.arange(len(terms))
    sizes, bits, at_bit = [], [], np.zeros(len(terms), np.int64)
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("two terms share a 128-bit digest")
        size = max(8, 2 * len(left))
        at = _positions(digests[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        at_bit[left[placed]] = sum(sizes) + at[placed]
        sizes.append(size)
        bits.append(alone)
        left = left[~placed]
    bits = np.concatenate(bits)
    return sizes, bits, (np.cumsum(bits) - 1)[at_bit]


def shards_of(kept: DataFrame) -> DataFrame:
    """The kept (lang, term) rows as one perfect hash for each shard."""
    n_shards = F.ceil(F.count("*") / SHARD_TERMS).cast("int").alias("n_shards")
    dealt = join_lookup(kept, kept.groupBy("lang").agg(n_shards), "lang")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            digests = _digests(rows.column("term").cast(pa.binary()).to_pylist())
            shard = digests[:, 1] % rows.column("n_shards").to_numpy().astype(np.uint64)
            yield rows.append_column("shard", pa.array(shard.astype(np.int32)))

    def build(table: pa.Table) -> pa.Table:
        sizes, bits, slots = perfect_hash(table.column("term").cast(pa.binary()).to_pylist())
        order = np.empty(len(slots), np.int64)
        order[slots] = np.arange(len(slots))
        first = table.slice(0, 1)
        return pa.table(
            {
                **{name: first.column(name) for name in ("lang", "shard", "n_shards")},
                "n_terms": pa.array([len(slots)], pa.int32()),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                "terms": pa.array([table.column("term").take(pa.array(order)).to_pylist()], pa.list_(pa.string())),
            }
        )

    dealt = dealt.select("lang", "term", "n_shards").mapInArrow(deal, "lang string, term string, n_shards int, shard int")
    return dealt.groupBy("lang", "shard").applyInArrow(build, SHARD)


@dataclass
class TermTable:
    """Shards of one language: a term's slot, or -1. Shards that are not held have no bits."""

    n_shards: int
    sizes: np.ndarray  # of each shard's levels
    starts: np.ndarray  # where a level's bits begin
    bits: np.ndarray
    ranks: np.ndarray
    terms: pa.Array

    @classmethod
    def of(cls, rows: list) -> TermTable:
        """From rows of ``shards_of`` in the order of their slots."""
        depth = max(len(row.sizes) for row in rows)
        sizes, starts, at = np.zeros((rows[0].n_shards, depth), np.int64), np.zeros((rows[0].n_shards, depth), np.int64), 0
        for row in rows:
            n = np.array(row.sizes, np.int64)
            sizes[row.shard, : len(n)], starts[row.shard, : len(n)] = n, at + np.cumsum(n) - n
            at += int(n.sum())
        bits = np.concatenate([np.unpackbits(np.frombuffer(row.bits, np.uint8), count=sum(row.sizes)) for row in rows]).astype(bool)
        terms = pa.array([term for row in rows for term in row.terms], pa.string()).cast(pa.binary())
        return cls(rows[0].n_shards, sizes, starts, bits, (np.cumsum(bits) - 1).astype(np.int32), terms)

    def slots(self, terms: list[bytes]) -> np.ndarray:
        digests = _digests(terms)
        shard = (digests[:, 1] % np.uint64(self.n_shards)).astype(np.int64)
        found, left = np.full(len(terms), -1, np.int64), np.arange(len(terms))
        for level in range(self.sizes.shape[1]):
            left = left[self.sizes[shard[left], level] > 0]
            at = self.starts[shard[left], level] + _positions(digests[left], level, self.sizes[shard[left], level])
            hit = self.bits[at]
            found[left[hit]] = self.ranks[at[hit]]
            left = left[~hit]
        there = np.nonzero(found >= 0)[0]
        same = pc.equal(self.terms.take(pa.array(found[there])), pa.array(terms, pa.binary()).take(pa.array(there)))
        found[there[~same.to_numpy(zero_copy_only=False)]] = -1
        return found


def _passes(shards: DataFrame) -> Iterator[list[tuple[str, int]]]:
    """Consecutive (lang, shard) of at most ``PASS_BYTES`` together; a shard is at most a part of that."""
    size = F.expr("octet_length(bits) + aggregate(terms, 0L, (n, term) -> n + octet_length(term) + 8) + octet_length(lang) + 64")
    held, total = [], 0
    for row in sorted(shards.select("lang", "shard", "n_terms", size.alias("n_bytes")).collect()):
        if held and total + row.n_bytes > PASS_BYTES:
            yield held
            held, total = [], 0
        held.append(row)
        total += row.n_bytes
    if held:
        yield held


def recounted(rows: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, slot, n) of every kept term that occurs in a group, and (lang, slot, term)."""
    spark, base, cells, bases = rows.sparkSession, 0, [], []
    for number, some in enumerate(_passes(shards)):
        keys = spark.createDataFrame([(row.lang, row.shard) for row in some], "lang string, shard int")
        by_lang: dict[str, list] = defaultdict(list)
        for row in sorted(shards.join(F.broadcast(keys), ["lang", "shard"]).collect(), key=lambda row: (row.lang, row.shard)):
            by_lang[row.lang].append(row)
        first = {}
        for lang, held in by_lang.items():
            first[lang] = base
            for row in held:
                bases.append((lang, row.shard, base))
                base += row.n_terms
        tables = {lang: TermTable.of(held) for lang, held in by_lang.items()}
        cells.append(settled(_counted(rows, tables, first), f"counts-{number}"))
    if not cells:
        return spark.createDataFrame([], "lang string, source string, slot long, n long"), spark.createDataFrame([], "lang string, slot long, term string")
    counted = cells[0]
    for more in cells[1:]:
        counted = counted.unionByName(more)
    starts = spark.createDataFrame(bases, "lang string, shard int, base long")
    named = join_lookup(shards.select("lang", "shard", "terms"), starts, ["lang", "shard"])
    named = named.select("lang", "base", F.posexplode("terms").alias("at", "term"))
    return counted, named.select("lang", (F.col("base") + F.col("at")).alias("slot"), "term")


def _counted(rows: DataFrame, tables: dict[str, TermTable], first: dict[str, int]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((tables, first))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, first = shared.value
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        dense: dict[tuple[str, str], np.ndarray] = {}
        for rows in batches:
            for at in range(0, rows.num_rows, ROWS_AT_ONCE):
                some = rows.slice(at, ROWS_AT_ONCE)
                groups: dict[tuple[str, str], Counter] = defaultdict(Counter)
                for lang, source, text in zip(some.column("lang").to_pylist(), some.column("source").to_pylist(), some.column("text").cast(pa.binary()).to_pylist()):
                    if lang in tables:
                        groups[lang, source].update(terms_of(text))
                for (lang, source), found in groups.items():
                    slots = known[lang]
                    if len(slots) > REMEMBERED:
                        slots.clear()
                    new = [term for term in found if term not in slots]
                    slots.update(zip(new, tables[lang].slots(new).tolist()))
                    where = np.fromiter(map(slots.__getitem__, found), np.int64, len(found))
                    times = np.fromiter(found.values(), np.int64, len(found))
                    if (lang, source) not in dense:
                        if sum(map(len, dense.values())) > DENSE_CELLS:
                            yield from sent(dense)
                            dense.clear()
                        dense[lang, source] = np.zeros(len(tables[lang].terms), np.int64)
                    dense[lang, source][where[where >= 0]] += times[where >= 0]
        yield from sent(dense)

    def sent(dense: dict[tuple[str, str], np.ndarray]) -> Iterator[pa.RecordBatch]:
        first = shared.value[1]
        for (lang, source), counts in dense.items():
            at = np.flatnonzero(counts)
            names = {"lang": pa.array([lang] * len(at), pa.string()), "source": pa.array([source] * len(at), pa.string())}
            yield batch(**names, slot=pa.array(at + first[lang]), n=pa.array(counts[at]))

    found = rows.mapInArrow(work, "lang string, source string, slot long, n long")
    return found.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))


def _share(n: str, total: str) -> Column:
    """p of a count, whose product with 10**9 may exceed a long."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 5 as decimal(19,0))) div cast({total} + 5 * n_kept as decimal(19,0))")


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language."""
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_sources"), F.first("n_kept").alias("n_kept"))
    sizes = sizes.select(
        "lang",
        F.greatest(F.lit(1), F.ceil(F.col("n_sources") * F.col("n_kept") / BLOCK_CELLS)).alias("n_blocks"),
        F.ceil(F.col("n_sources") / TILE_SOURCES).alias("n_tiles"),
    )
    tile = F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile")
    share = F.when(F.col("n_kept") > 0, _share("0", "n_group")).otherwise(0).cast("long").alias("p")
    every = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    rows = join_lookup(groups.select("lang", "source", F.lit(None).cast("long").alias("slot"), share), sizes, "lang")
    rows = rows.select("lang", every, "n_tiles", "source", "slot", "p").select("lang", "block", tile, "source", "slot", "p")
    block = F.pmod(F.col("slot"), F.col("n_blocks")).alias("block")
    found = join_lookup(cells.select("lang", "source", "slot", "p"), sizes, "lang").select("lang", block, tile, "source", "slot", "p")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, tile = (x.as_py() for x in key)
        bare = table.filter(pc.is_null(table.column("slot")))
        held = table.filter(pc.is_valid(table.column("slot")))
        sources = bare.take(pc.sort_indices(bare, sort_keys=[("source", "ascending")]))
        names = sources.column("source").combine_chunks()
        slots, column = np.unique(held.column("slot").to_numpy(), return_inverse=True)
        shares = np.repeat(sources.column("p").to_numpy()[:, None], len(slots), axis=1)
        row = pc.index_in(held.column("source"), names).to_numpy().astype(np.int64)
        shares[row, column] = held.column("p").to_numpy()
        left, right, values = [], [], []
        for i in range(tile * TILE_SOURCES, min(len(names), (tile + 1) * TILE_SOURCES)):
            left.append(np.full(len(names) - i - 1, i))
            right.append(np.arange(i + 1, len(names)))
            values.append(np.abs(shares[i + 1 :] - shares[i]).sum(axis=1))
        left, right, values = (np.concatenate(x or [np.zeros(0, np.int64)]).astype(np.int64) for x in (left, right, values))
        return pa.table(
            {
                "lang": pa.array([lang] * len(left), pa.string()),
                "a": names.take(pa.array(left)),
                "b": names.take(pa.array(right)),
                "value": pa.array(values),
            }
        )

    partly = rows.unionByName(found).groupBy("lang", "block", "tile").applyInArrow(compare, "lang string, a string, b string, value long")
    whole = partly.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return whole.select("lang", both.alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank (from 1 for each group and part)."""
    rows = rows_of(docs, text, lang, source)
    kept = settled(document_counts(rows).filter(F.col("n_docs") >= min_docs).select("lang", "term"), "kept-terms")
    counted, named = recounted(rows, settled(shards_of(kept), "term-shards"))
    occurring = rows.groupBy("lang", "source").agg(F.count("*").alias("n_documents"))
    in_group = counted.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    n_kept = kept.groupBy("lang").agg(F.count("*").alias("n_kept"))
    groups = join_lookup(join_lookup(occurring, in_group, ["lang", "source"], "left", costly=True), n_kept, "lang", "left", costly=True)
    groups = groups.select("lang", "source", F.coalesce("n_group", F.lit(0)).alias("n_group"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"))
    groups = groups.withColumn("n_lang", F.sum("n_group").over(Window.partitionBy("lang")))
    groups = settled(groups, "groups")
    cells = join_lookup(counted, groups, ["lang", "source"]).withColumn("p", _share("n", "n_group").cast("long"))
    cells = settled(cells, "shares")
    pairs = _pairs(cells, groups).withColumn("part", F.lit("pair"))
    of_lang = cells.withColumn("in_lang", F.sum("n").over(Window.partitionBy("lang", "slot")))
    more = of_lang.withColumn("value", F.col("p") - _share("in_lang", "n_lang").cast("long")).filter("value > 0")
    more = join_lookup(more.select("lang", "source", "slot", "value"), named, ["lang", "slot"], costly=True)
    more = more.select("lang", "source", F.col("term").alias("item"), "value", F.lit("term").alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    found = pairs.withColumn("rank", rank).unionByName(more.withColumn("rank", rank).filter(F.col("rank") <= top))
    return found.select("lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int"))
