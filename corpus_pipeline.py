"""A training-data pipeline over ``documents``: every stage is one operator of ``guestbook.llm``.

Every stage reads what the stage before kept, as a table. The first three drop documents: those in no known
language, those of which line deduplication leaves nothing, and all but one of each group of near-duplicates
(five-word shingles, Jaccard similarity 0.8 or more).
Mixing keeps every document and puts them in the order of its schedule, which the files keep; the last stage
reads that order from the files and returns it with the token ids.
"""

from __future__ import annotations

import functools
import re

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.llm import byte_bpe, language, lines, mixing, near_copies
from guestbook.shared import drop_tables, scope, settled

LEAST_SCORE = 0.3
WORD_BYTES = 16
BATCH_BYTES = 4 << 20  # of whole texts that go to Python and back at a time
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def size_in_bytes(setting: str) -> int:
    """A setting's number of bytes: plain, or with a unit like ``64MB``."""
    number, unit = re.fullmatch(r"(\d+) *([kmgt]?)i?b?", setting.strip().lower()).groups()
    return int(number) << 10 * "-kmgt".index(unit or "-")


def tidy(stage):
    """Hold the batches of texts small, and of the tables that a stage writes, leave those that its result reads."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, min(BATCH_BYTES, size_in_bytes(spark.conf.get(BATCH_SETTING))))
        with scope(spark) as tables:
            return tables.keep(stage(spark, docs, sf_dir))

    return run_stage


@tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language learned from the labelled ones that are not held out; ``und`` and
    scores under ``LEAST_SCORE`` are rejected. The columns stay as they are."""
    learned = language.learn(docs.filter(~language.held_out()))
    found = language.predict(docs, learned)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(kept).select(*docs.columns)


@tidy
def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines with four words or ``WORD_BYTES`` bytes for each of
    them; documents of which nothing is left go."""
    found = lines.without_repeated_lines(docs, word_bytes=WORD_BYTES)
    return found.filter("kept").withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@tidy
def deduplicate_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of every group of near-duplicates: by doc_id, a null one last, then by the row's own key, so
    that repeated rows, rows that share an id and rows without one leave one row too."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])  # its names cannot clash with the key
    keyed = settled(docs.select(F.monotonically_increasing_id().alias("key"), row.alias("row")), "keyed")
    groups = near_copies.near_copies(keyed.select("key", "row.text"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    ids = keyed.select("key", "row.doc_id").join(groups, "key")
    first = ids.groupBy("component").agg(F.min(order).getField("key").alias("key")).select("key")
    return keyed.join(settled(first, "first-of-group"), "key", "left_semi").select("row.*")


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the schedule, one by one: sources by the square roots of their sizes."""
    return mixing.mixed(docs, block_rows=1).select(*docs.columns)


@tidy
def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the place of its row in the files: (part, row) is the training order."""
    try:
        docs = docs.withColumns({"part": F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"), "row": F.col("_metadata.row_index")})
    except AnalysisException:  # the rows do not come from files
        docs = docs.withColumns({"part": F.lit(None).cast("int"), "row": F.lit(None).cast("long")})
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = byte_bpe.with_token_ids(docs.select("doc_id", "text", "lang", "source", "part", "row"), path, public_tokenizers.PATTERN)
    return found.drop("text")


STAGES = [
    ("language", identify_language),
    ("lines", deduplicate_lines),
    ("near-duplicates", deduplicate_near),
    ("mixing", mix_sources),
    ("tokens", encode_bytes),
]

#: Learned filters, fingerprints and merges are beyond SQL: tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scope(spark) as tables:  # what a stage writes for itself goes with it
            done = tables.keep(settled(stage(spark, docs, sf_dir), f"stage-{name}"))
        drop_tables(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
