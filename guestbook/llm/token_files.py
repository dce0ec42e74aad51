"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

A file set is a folder of Parquet parts, so that Spark's own writers commit them and any store that Spark
knows can hold them. A row is a block: the ids of consecutive documents as little-endian unsigned integers of
``id_bytes`` bytes, their doc_ids, and the end of each document within the block in Elias-Fano form, from which
select gives the offset of any document. Blocks follow each other by (shard, block); shards are ranges of
doc_id, whose bounds come from the ids of all rows, and one shuffle deals them. A block closes at ``BLOCK_IDS`` ids; a longer document has its own.
``start`` in the whole id array is the sum of the shards before, a number for each partition that the driver
adds up, plus what the block states itself.

Defined results: a null text is an empty one, of which only the end id remains. A null ``doc_id`` sorts last;
rows with the same ``doc_id`` are ordered by text. Extra columns are not read. An empty table gives an empty
file set. Texts are encoded once, where they are read; only ids travel, and the texts of rows that share an id.
Besides the files, only this shuffle is written.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, narrow
from guestbook.llm.chunk_ids import encoder
from guestbook.llm.elias_fano import EliasFano
from guestbook.operators.joins import join_lookup

BLOCK_IDS = 1 << 16
ROW_GROUP_BYTES = 16 << 20

BOUND_PARTS = 32  # a bound between shards is off by a part of so many of a shard's rows at most

ENCODED = "shard int, doc_id long, tie string, ids binary, id_bytes int"
BLOCK = (
    "shard int, block int, n_docs int, n_ids long, ids_before long, id_bytes int, ids binary, doc_ids binary,"
    " known_ids binary, low_bits int, low binary, high binary, samples binary"
)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text with the tokenizer file at ``path``, append ``end_id`` to each, and write the blocks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        end = np.array([end_id], made.kind).tobytes()
        for rows in batches:
            ids = pa.array([found + end for found in made.texts(rows.column("text"))], pa.binary())
            width = pa.array(np.full(rows.num_rows, made.width, np.int32))
            yield batch(shard=shards_of(rows.column("doc_id"), bounds), doc_id=rows.column("doc_id"), tie=rows.column("tie"), ids=ids, id_bytes=width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, width = TaskContext.get().partitionId(), 0
        block, before, doc_ids, held = 0, 0, [], []

        def closed() -> pa.RecordBatch:
            ends = np.cumsum([len(ids) // width for ids in held], dtype=np.int64)
            total = int(ends[-1])
            coded = EliasFano.of(ends, total)
            row = {
                "shard": shard, "block": block, "n_docs": len(held), "n_ids": total, "ids_before": before, "id_bytes": width,
                "ids": b"".join(held), "doc_ids": np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
                "known_ids": np.packbits([i is not None for i in doc_ids]).tobytes(),
                "low_bits": coded.low_bits, "low": coded.low, "high": coded.high, "samples": coded.samples,
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

        size = 0
        for rows in batches:
            for i, ids, width in zip(rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist(), rows.column("id_bytes").to_pylist()):
                n = len(ids) // width
                if held and size + n > BLOCK_IDS:
                    yield closed()
                    block, before, doc_ids, held, size = block + 1, before + size, [], [], 0
                doc_ids.append(i)
                held.append(ids)
                size += n
        if held:
            yield closed()

    rows = narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    n_shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows, n_shards)
    repeated = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    rows = join_lookup(rows, repeated.select("doc_id", F.lit(True).alias("is_repeated")), "doc_id", "left", costly=True)
    tie = F.when(F.col("doc_id").isNull() | F.col("is_repeated"), F.col("text"))
    encoded = rows.select("doc_id", tie.alias("tie"), "text").mapInArrow(encode, ENCODED)
    order = (F.col("doc_id").asc_nulls_last(), F.col("tie").asc_nulls_first())
    # A range shuffle would look at its input twice, to find bounds, and so encode the texts twice.
    placed = encoded.repartitionById(n_shards, "shard").sortWithinPartitions(*order)
    placed.mapInArrow(work, BLOCK).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)


def _bounds(rows: DataFrame, n_shards: int) -> np.ndarray:
    """The highest ``doc_id`` of every shard but the last, for shards of about as many rows each."""
    low = rows.agg(F.min("doc_id")).first()[0]
    if low is None or n_shards == 1:
        return np.array([], np.int64)
    above = F.col("doc_id").cast("decimal(20,0)") - F.lit(low)  # the distance is counted in doubles, which have 53 bits
    shares = [k / n_shards for k in range(1, n_shards)]
    found = rows.agg(F.percentile_approx(above, shares, BOUND_PARTS * n_shards)).first()[0]
    return np.array([min(low + int(x), (1 << 63) - 1) for x in found], np.int64)


def shards_of(doc_ids: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The shard of every ``doc_id``: equal ones share one, and a null one stands in the last."""
    found = np.searchsorted(bounds, doc_ids.fill_null(0).to_numpy()).astype(np.int32)
    return pa.array(np.where(doc_ids.is_null().to_numpy(zero_copy_only=False), np.int32(len(bounds)), found))


BLOCK_SCHEMA = pa.schema(
    [(name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in (x.split() for x in BLOCK.split(", "))]
)


def boundaries(row: dict) -> EliasFano:
    return EliasFano(row["n_docs"], row["n_ids"], row["low_bits"], row["low"], row["high"], row["samples"])


def read_document(row: dict, k: int) -> np.ndarray:
    """Ids of the k-th document of a block, by two selects."""
    coded = boundaries(row)
    start, end = coded.select(k - 1) if k else 0, coded.select(k)
    return np.frombuffer(row["ids"], f"<u{row['id_bytes']}")[start:end]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 (of unsigned 32-bit integers)."""
    blocks = spark.read.schema(BLOCK).parquet(folder)
    totals = sorted((row.shard, row.n) for row in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    sums = [0, *itertools.accumulate(n for _, n in totals)]
    starts = spark.sparkContext.broadcast({shard: start for (shard, _), start in zip(totals, sums)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
                ends = boundaries(row).all()
                begins = np.concatenate(([0], ends[:-1]))
                known = np.unpackbits(np.frombuffer(row["known_ids"], np.uint8), count=row["n_docs"]).astype(bool)
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                yield batch(
                    doc_id=pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~known),
                    start=pa.array(begins + row["ids_before"] + starts.value[row["shard"]]),
                    n_tokens=pa.array(ends - begins),
                    ids_crc32=pa.array(crcs, pa.int64()),
                )

    return blocks.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")
