"""Line deduplication by a suffix array over line ids.

Every line that is not blank is known by a 128-bit digest. The array of all suffixes of all documents' line
sequences is sorted by prefix doubling: ranks of single lines first, then of runs of 2, 4, ... lines, each rank
from the pair of ranks of a run's two halves, sorted by a range shuffle with the place as a tie-break. A suffix
whose prefix occurs only once takes no further part. Suffixes with the same rank at a length are an interval of
the array whose longest common prefix has at least that length, and the interval's first row is the earliest
copy.

A repeated run counts from ``min_words`` words in all its lines together. With ``word_bytes`` a line has at least
a word for each such number of UTF-8 bytes, so that long lines count in scripts without spaces too. Every line that lies in a later copy
of such a run is deleted; the earliest copy (smallest doc_id, then place) stays. A line that is not blank has a
word at least, so each run that counts is covered by runs of at most ``min_words`` lines that count: the least
that start at its lines and the least that end there. The array is therefore sorted to that depth, which takes
log2(min_words) rounds however long the longest repeat is, and the maximal runs are the unions of overlapping
later copies.

Defined results: a null text is an empty one. Blank lines are never deleted, unless nothing else is left: then
the text is empty and ``kept`` is false (also where it was empty before). White space around a line does not
count. A null ``doc_id`` comes last. Rows with the same doc_id and the same text are one document: all of them
lose the same lines. Columns that are not read pass through; ``n_lines``, ``n_removed`` and ``kept`` are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, encoded_texts_of, texts_of
from guestbook.llm.ordered import ranked
from guestbook.shared import drop_tables, settled

MIN_WORDS = 4
ROWS_AT_ONCE = 256  # texts that a task holds as Python objects
PLACE = ["doc", "version", "pos"]
LINES = "doc long, version long, pos long, d1 long, d2 long, words int"


def _identity(doc_id: str, text: str) -> tuple[Column, Column]:
    """A document: its id, a null one last, and a hash of its text."""
    last = F.lit(2**63 - 1)
    return F.coalesce(F.col(f"`{doc_id}`").cast("long"), last), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def line_table(docs: DataFrame, min_words: int, doc_id: str = "doc_id", text: str = "text", word_bytes: int | None = None) -> DataFrame:
    """Lines that are not blank: place, digest, and number of words up to ``min_words``."""

    def counted(line: bytes) -> int:
        words = len(line.split(None, min_words)[:min_words])
        return min(min_words, max(words, len(line) // word_bytes)) if word_bytes else words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (rows.slice(at, ROWS_AT_ONCE) for rows in batches for at in range(0, rows.num_rows, ROWS_AT_ONCE)):
            at, places, found, words = [], [], [], []
            for row, held in enumerate(encoded_texts_of(rows.column("text"))):
                lines = [line for line in map(bytes.strip, held.split(b"\n")) if line]
                at.append(np.full(len(lines), row))
                places.append(np.arange(len(lines)))
                found += [xxhash.xxh3_128_digest(line) for line in lines]
                words += [counted(line) for line in lines]
            if found:
                at, digests = pa.array(np.concatenate(at)), np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                yield batch(
                    doc=rows.column("doc").take(at),
                    version=rows.column("version").take(at),
                    pos=pa.array(np.concatenate(places)),
                    d1=pa.array(digests[:, 0].copy()),
                    d2=pa.array(digests[:, 1].copy()),
                    words=pa.array(words, pa.int32()),
                )

    doc, version = _identity(doc_id, text)
    return docs.select(doc.alias("doc"), version.alias("version"), F.col(f"`{text}`").alias("text")).mapInArrow(work, LINES)


def _ahead(runs: DataFrame, by: int, name: str) -> DataFrame:
    """The rank of the run that starts ``by`` lines later."""
    return runs.select("doc", "version", (F.col("pos") - by).alias("pos"), F.col("rank").alias(name))


def suffix_ranks(lines: DataFrame, depth: int) -> dict[int, DataFrame]:
    """Length 1, 2, 4, ... up to ``depth`` -> (place, rank, first) of every run of that length that occurs
    elsewhere too. Ranks of length 1 also carry ``words``."""
    found = {1: ranked(lines, ["d1", "d2"], PLACE, "runs-1").filter("not alone").drop("d1", "d2", "alone")}
    length = 1
    while 2 * length <= depth:
        half = found[length].select(*PLACE, F.col("rank").alias("left"))
        pairs = half.join(_ahead(found[length], length, "right"), PLACE)
        length *= 2
        found[length] = ranked(pairs, ["left", "right"], PLACE, f"runs-{length}").filter("not alone").select(*PLACE, "rank", "first")
    return found


def _least_runs(single: DataFrame, min_words: int) -> DataFrame:
    """(doc, version, pos, len) of the shortest runs with ``min_words`` words that start or end at a line."""
    place = Window.partitionBy("doc", "version").orderBy("pos")
    ends, starts = F.lit(None).cast("int"), F.lit(None).cast("int")
    steps = []
    for sign in (1, -1):
        words, unbroken = F.col("words"), F.lit(True)
        conditions = [(1, words >= min_words)]
        for k in range(1, min_words):
            unbroken = unbroken & (F.lead("pos", sign * k).over(place) == F.col("pos") + sign * k)
            words = words + F.lead("words", sign * k).over(place)
            conditions.append((k + 1, unbroken & (words >= min_words)))
        steps.append(F.coalesce(*[F.when(enough, F.lit(k)) for k, enough in conditions]))
    starts, ends = steps
    return (
        single.select("doc", "version", "pos", starts.alias("starts"), ends.alias("ends"))
        .select("doc", "version", F.explode(F.array(F.struct("pos", F.col("starts").alias("len")), F.struct((F.col("pos") - F.col("ends") + 1).alias("pos"), F.col("ends").alias("len")))).alias("run"))
        .select("doc", "version", "run.*")
        .filter("len is not null")
    )


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, version, pos, len): runs that count and occur earlier too. Together they cover exactly the
    lines to delete."""
    ranks = suffix_ranks(lines, min_words)
    runs = settled(_least_runs(ranks[1], min_words), "least-runs")
    found = runs.filter("len = 1").join(ranks[1].filter("not first"), PLACE, "left_semi")
    for length in range(2, min_words + 1):
        power = 1 << length.bit_length() - 1
        some = runs.filter(F.col("len") == length).distinct()
        if length == power:
            later = some.join(ranks[power].filter("not first"), PLACE, "left_semi")
        else:
            halves = some.join(_ahead(ranks[power], 0, "left"), PLACE).join(_ahead(ranks[power], length - power, "right"), PLACE)
            later = ranked(halves, ["left", "right"], PLACE, f"runs-{length}").filter("not first").select(*some.columns)
        found = found.unionByName(later)
    return found


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", word_bytes: int | None = None) -> DataFrame:
    """``docs`` without the later copies of repeated runs, with ``n_lines`` (not blank, before), ``n_removed``
    and ``kept``."""
    docs = docs.drop("n_lines", "n_removed", "kept")
    runs = later_copies(line_table(docs, min_words, doc_id, text, word_bytes), min_words)
    gone = runs.groupBy("doc", "version").agg(F.collect_set(F.struct("pos", "len")).alias("runs"))
    doc, version = _identity(doc_id, text)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])  # its names cannot clash with those of the join
    marked = docs.select(doc.alias("doc"), version.alias("version"), row.alias("row")).join(gone, ["doc", "version"], "left").select("row", "runs")
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, ROWS_AT_ONCE):
                some = rows.slice(start, ROWS_AT_ONCE)
                columns = some.column("row").flatten()
                texts, n_lines, n_removed = [], [], []
                for held, runs in zip(texts_of(columns[at]), some.column("runs").to_pylist()):
                    lines = held.split("\n")
                    full = [k for k, line in enumerate(lines) if line.strip(WHITE_SPACE)]
                    out = {full[k] for run in runs or () for k in range(run["pos"], run["pos"] + run["len"])}
                    left = "\n".join(line for k, line in enumerate(lines) if k not in out) if out else held
                    texts.append(left if len(out) < len(full) else "")
                    n_lines.append(len(full))
                    n_removed.append(len(out))
                columns[at] = pa.array(texts, pa.string())
                kept = pa.array(np.array(n_removed) < np.array(n_lines))
                added = [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), kept]
                yield pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)

    schema = docs.withColumns({"n_lines": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit(True)}).schema
    return marked.mapInArrow(work, schema)


WHITE_SPACE = " \t\n\r\v\f"
