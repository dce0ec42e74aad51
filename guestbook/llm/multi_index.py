"""Near-duplicate embeddings by an inverted multi-index.

Each half of a unit vector is quantised by a codebook of its own; a vector lives in the cell (i, j) of the grid
of both. A query visits cells by the multi-sequence order: each half ranks its codewords by how far the query is
outside their regions, and cells are taken by ascending sums of both until a bound beyond which the target share
of neighbours at the threshold is found. The staircase of cells below the bound is that traversal. Candidates
are verified with the exact cosine in double precision.

Codebooks and bound come from a bounded sample; every vector is indexed. The bound is what the target share needs of
the neighbours that are in the sample, of neighbours simulated in directions between vectors of the sample (which stay
in its subspace, if it lies in one), and of neighbours in any direction, whichever is most. It is never more than the
squared distance 2 * (1 - threshold) of two linked unit vectors, beyond which no link lies: a target of 1 is that.
Equal vectors are one class with a number of copies. Work is dealt by the first codeword, in blocks: each home
block of at most ``BLOCK`` classes meets each query block of its shard once, so that a task holds two blocks
however many vectors crowd a cell. A task sends on a count for each class and the forest that its links span,
never pairs. When only one of two linked vectors visits the other's cell, that visit counts for both.

Defined results: vectors that are null, zero, or hold null or non-finite components have no links and are
components of their own. Vectors of different lengths do not link; each length has an index of its own. A null vec_id is no component's name
unless nothing else is in it. Repeated rows are vectors of their own. Other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch
from guestbook.llm.components import components, joined
from guestbook.shared import settled

THRESHOLD = 0.95
TARGET_RECALL = 0.9995
SAMPLE = 16_384
SAMPLE_OF_WORD = 64
REAL_PAIRS_OF = 4_096  # vectors of the sample that are compared with each other
MOST_CODEWORDS = 1_024
BLOCK = 4_096
ROUNDS = 8


def units(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; the largest component is scaled first, so that no square is out of range."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=np.finfo(np.float64).tiny)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def codewords(count: int) -> int:
    """Of each half for so many vectors: about sixteen to a cell, up to the largest codebooks."""
    return int(np.clip(2 ** round(np.log2(max(1.0, np.sqrt(count) / 4))), 1, MOST_CODEWORDS))


def squared_distances(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum(0, (points**2).sum(1)[:, None] - 2 * points @ words.T + (words**2).sum(1))


def codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; a codeword that loses all its points stays where it is."""
    words = np.unique(points, axis=0)
    words = words[np.random.default_rng(seed).permutation(len(words))[:k]]
    for _ in range(ROUNDS):
        nearest = squared_distances(points, words).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        words = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], words)
    return words


@dataclass
class MultiIndex:
    """Two codebooks and the bound on how far outside a cell a query may be."""

    halves: list[np.ndarray]
    gaps: list[np.ndarray]
    bound: float = np.inf

    @classmethod
    def of(cls, sample: np.ndarray, count: int, threshold: float, recall: float) -> MultiIndex:
        """``count`` vectors will be indexed."""
        k, cut = codewords(count), sample.shape[1] // 2
        halves = [codebook(sample[:, :cut], k, 1), codebook(sample[:, cut:], k, 2)]
        index = cls(halves, [np.sqrt(squared_distances(words, words)) for words in halves])
        farthest = max(0.0, 2 * (1 - threshold))
        if recall < 1:
            random, asked = np.random.default_rng(3), [index._beyond(*_pairs_within(sample[:REAL_PAIRS_OF], threshold))]
            between = sample[random.permutation(len(sample))] - sample[random.permutation(len(sample))]
            for away in (between, random.standard_normal(sample.shape)):
                away = away - (away * sample).sum(1, keepdims=True) * sample
                length = np.linalg.norm(away, axis=1, keepdims=True)
                near = threshold * sample + np.sqrt(1 - threshold**2) * away / np.where(length > 0, length, 1)
                asked.append(index._beyond(sample, near))
            farthest = min(farthest, max(float(np.quantile(sums, recall)) for sums in asked if len(sums)))
        index.bound = farthest + 1e-9
        return index

    def _beyond(self, queries: np.ndarray, near: np.ndarray) -> np.ndarray:
        """For pairs of vectors: how far each query is outside the cell of its neighbour."""
        found = []
        for at in range(0, len(queries), 4096):
            cells, outside = self.cells(near[at : at + 4096]), self.outside(queries[at : at + 4096])
            every = np.arange(len(cells))
            found.append(outside[0][every, cells[:, 0]] + outside[1][every, cells[:, 1]])
        return np.concatenate(found or [np.zeros(0)])

    def _parts(self, points: np.ndarray) -> list[np.ndarray]:
        cut = self.halves[0].shape[1]
        return [points[:, :cut], points[:, cut:]]

    def cells(self, points: np.ndarray) -> np.ndarray:
        found = [squared_distances(part, words).argmin(axis=1) for part, words in zip(self._parts(points), self.halves)]
        return np.stack(found, axis=1)

    def outside(self, points: np.ndarray) -> list[np.ndarray]:
        """For each half: squared distance from every point to the plane between its own region and each other."""
        out = []
        for part, words, gaps in zip(self._parts(points), self.halves, self.gaps):
            far = squared_distances(part, words)
            own = far.argmin(axis=1)
            gap = gaps[own]
            over = (far - far[np.arange(len(part)), own][:, None]) / (2 * np.where(gap > 0, gap, 1))
            out.append(np.where(gap > 0, over, 0) ** 2)
        return out


def _pairs_within(points: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of different vectors that link, both ways; of very many, evenly spaced ones."""
    linked = points @ points.T >= threshold
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    step = max(1, len(a) // SAMPLE)
    return points[a[::step]], points[b[::step]]


def _valid(vector: str) -> str:
    return (
        f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        f" and exists({vector}, x -> x <> 0)"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _links(index: MultiIndex, threshold: float, table: pa.Table) -> pa.Table:
    """Counts (cid, n) and forest edges (u, v) of one home block and one query block."""
    home = table.column("home").to_numpy()
    order = np.concatenate((np.nonzero(home)[0], np.nonzero(~home)[0]))
    table = table.take(order)
    cut = int(home.sum())
    cids, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
    counts, label = np.zeros(len(table), np.int64), np.arange(len(table))
    if 0 < cut < len(table):
        points = units(_matrix(table.column("vector").combine_chunks()))
        cells, outside = index.cells(points), index.outside(points)
        shard = int(table.column("shard")[0].as_py())
        for j in np.unique(cells[:cut, 1]).tolist():
            at = np.nonzero(cells[:cut, 1] == j)[0]
            asking = cut + np.nonzero(outside[0][cut:, shard] + outside[1][cut:, j] <= index.bound)[0]
            for start in range(0, len(asking), 1024):
                some = asking[start : start + 1024]
                q, y = np.nonzero(points[some] @ points[at].T >= threshold)
                q, y = some[q], at[y]
                apart = cids[q] != cids[y]
                q, y = q[apart], y[apart]
                np.add.at(counts, q, copies[y])
                unasked = outside[0][y, cells[q, 0]] + outside[1][y, cells[q, 1]] > index.bound
                np.add.at(counts, y[unasked], copies[q[unasked]])
                label = joined(label, q, y)
    tied = np.nonzero(label != np.arange(len(label)))[0]
    linked = np.nonzero(counts)[0]
    return pa.table(
        {
            "u": np.concatenate((cids[linked], cids[tied])),
            "v": np.concatenate((cids[linked], cids[label[tied]])),
            "n": np.concatenate((counts[linked], np.zeros(len(tied), np.int64))),
        }
    )


def class_links(classes: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """(u, v, n) over ``classes(cid, vector, copies)`` of equal length: a row with u = v adds n links to class
    u, any other is an edge of a forest that spans the links."""
    spark, count = classes.sparkSession, classes.count()
    wanted = max(SAMPLE, SAMPLE_OF_WORD * codewords(count))
    share = min(1.0, wanted / max(1, count))
    drawn = classes.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 40)) <= int(share * (1 << 40)))
    sample = units(_matrix(drawn.select("vector").limit(2 * wanted).toArrow().column(0).combine_chunks()))
    index = spark.sparkContext.broadcast(MultiIndex.of(sample, count, threshold, recall))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            points = units(_matrix(rows.column("vector")))
            homes, outside = index.value.cells(points), index.value.outside(points)
            q, i = np.nonzero(outside[0] + outside[1].min(axis=1)[:, None] <= index.value.bound)
            at = np.concatenate((np.arange(len(points)), q))
            flags = np.arange(len(at)) < len(points)
            shard = np.concatenate((homes[:, 0], i)).astype(np.int32)
            taken = rows.take(pa.array(at))
            yield batch(shard=pa.array(shard), home=pa.array(flags), **{n: taken.column(n) for n in taken.schema.names})

    vector = classes.schema["vector"].dataType.simpleString()
    dealt = settled(classes.mapInArrow(deal, f"shard int, home boolean, cid long, vector {vector}, copies long"), "dealt")
    sizes = {(row.shard, row.home): row.n for row in dealt.groupBy("shard", "home").agg(F.count("*").alias("n")).collect()}
    blocks = {key: -(-n // BLOCK) for key, n in sizes.items()}  # two numbers for each codeword
    table = spark.createDataFrame(
        [(shard, blocks.get((shard, True), 0), blocks.get((shard, False), 0)) for shard in {s for s, _ in sizes}],
        "shard int, home_blocks int, query_blocks int",
    )
    own = "pmod(xxhash64(cid, 'block'), {})"
    every = "sequence(0L, {} - 1L)"
    met = (
        dealt.join(F.broadcast(table), "shard")
        .filter("home_blocks > 0 and query_blocks > 0")
        .selectExpr(
            "*",
            f"if(home, array({own.format('home_blocks')}), {every.format('home_blocks')}) as h",
            f"if(home, {every.format('query_blocks')}, array({own.format('query_blocks')})) as q",
        )
        .selectExpr("shard", "home", "cid", "vector", "copies", "explode(h) as h", "q")
        .selectExpr("shard", "home", "cid", "vector", "copies", "h", "explode(q) as q")
    )
    return met.groupBy("shard", "h", "q").applyInArrow(
        lambda table: _links(index.value, threshold, table), "u long, v long, n long"
    )


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept, for every row."""
    rows = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    usable = F.coalesce(F.expr(_valid("vector")), F.lit(False))
    lengths = sorted(row.size for row in rows.filter(usable).select(F.size("vector").alias("size")).distinct().collect())
    apart = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if lengths:
        classes = rows.filter(usable).groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        classes = settled(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
        of_length = [classes.filter(F.size("vector") == n).select("cid", "vector", "copies") for n in lengths]
        found = reduce(DataFrame.unionByName, [settled(class_links(some, threshold, recall), "class-links") for some in of_length])
        counts = found.filter("u = v").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
        roots = components(found.filter("u <> v").select("u", "v")).withColumnRenamed("node", "cid")
        named = classes.join(counts, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = named.join(least, "root").select(
            "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        )
        linked = rows.filter(usable).hint("merge").join(settled(named, "named-classes"), "vector")
        apart = linked.select("vec_id", "n_links", "component_id").unionByName(apart)
    return apart.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
