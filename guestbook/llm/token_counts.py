"""Token counts by a two-tier lookup of lengths.

What is looked up are words as white space parts them, each a pre-token or a few: no pre-token reaches over
white space. A first pass over all texts counts words inside every task, in a summary of bounded size, and the
summaries' heaviest entries are added up: no word of a text is ever shuffled. The lengths of the most frequent
ones make the first tier, a compact table of bounded size that is broadcast. The second pass adds up lengths; a
word that the first tier lacks is encoded by the library and stays in the worker's cache for a while. The first
tier decides nothing but speed.

Defined results: a null text is an empty one with no tokens. Special strings within a text are as the library
takes them. Repeated rows give repeated results. Extra columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, narrow, texts_of
from guestbook.llm.pieces import GROUP_CHARS, Memory, gaps, groups, segments

SUMMARY = 1 << 18
SENT = 1 << 11
FREQUENT = 1 << 15
LONGEST = 64
CACHED_WORDS = 300_000
SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to ``str.split`` alone
WORD = regex.compile(r"\S+")


@functools.cache
def load(path: str):
    """The library's tokenizer; one per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def words(text: str) -> list[str]:
    return WORD.findall(text) if any(char in text for char in SEPARATORS) else text.split()


def lengths_of(path: str, some: list[str]) -> list[int]:
    return [len(found.ids) for found in load(path).encode_batch_fast(some, add_special_tokens=False)]


@dataclass
class FrequentLengths:
    """Compact table: the pieces joined, where each one ends, and its length in tokens."""

    joined: bytes
    ends: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, pieces: list[str], lengths: list[int]) -> FrequentLengths:
        encoded = [piece.encode() for piece in pieces]
        ends = np.cumsum([len(piece) for piece in encoded], dtype=np.uint32)
        return cls(b"".join(encoded), ends, np.array(lengths, np.uint8))

    def table(self) -> dict[str, int]:
        ends = self.ends.tolist()
        return {self.joined[a:b].decode(): n for a, b, n in zip([0, *ends], ends, self.lengths.tolist())}


class TwoTiers:
    """The broadcast lengths, and behind them the worker's own."""

    def __init__(self, frequent: FrequentLengths, path: str):
        self.frequent = frequent.table()
        self.others = Memory(functools.partial(lengths_of, path), CACHED_WORDS)

    def count(self, lists: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        found = [list(map(self.frequent.get, some)) for some in lists]
        missed = [[some[i] for i in gaps(values)] for some, values in zip(lists, found)]
        return [sum(filter(None, values)) + sum(rest) for values, rest in zip(found, self.others.look_up(missed))]


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", most: int = FREQUENT) -> FrequentLengths:
    """First tier: the ``most`` most frequent words over all texts, by summaries of ``SUMMARY`` words a
    task of which the ``SENT`` heaviest are sent on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for rows in batches:
            for held in texts_of(rows.column("text")):
                for part in segments(held):
                    counts.update(words(part))
                    if len(counts) > SUMMARY:
                        counts = Counter(dict(counts.most_common(SUMMARY // 2)))
        best = [(piece, n) for piece, n in counts.most_common(SENT) if len(piece) <= LONGEST]
        yield batch(piece=pa.array([x[0] for x in best], pa.string()), n=pa.array([x[1] for x in best], pa.int64()))

    summaries = narrow(docs, text=text).mapInArrow(work, "piece string, n long")
    top = summaries.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(most).collect()
    pieces = [row.piece for row in top]
    pairs = [(piece, n) for piece, n in zip(pieces, lengths_of(path, pieces)) if n < 256]
    return FrequentLengths.of([piece for piece, _ in pairs], [n for _, n in pairs])


def token_counts(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether there are more than ``limit`` tokens."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = TwoTiers(frequent.value, path)
        for rows in batches:
            counts = []
            for some in groups(texts_of(rows.column("text"))):
                if len(some) == 1 and len(some[0]) > GROUP_CHARS:
                    counts.append(sum(tiers.count([words(part)])[0] for part in segments(some[0])))
                else:
                    counts += tiers.count([words(held) for held in some])
            n_tokens = pa.array(counts, pa.int64())
            yield batch(
                doc_id=rows.column("doc_id"),
                n_bytes=pc.fill_null(pc.binary_length(rows.column("text")), 0).cast(pa.int64()),
                n_tokens=n_tokens,
                over_limit=pc.greater(n_tokens, limit),
            )

    rows = narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
