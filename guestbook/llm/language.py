"""Language identification by bit-sliced Bloom filters of character n-grams.

One filter serves all languages: each of its slots holds a bitmask with a bit for every language. Learning
sets a language's bit in the slots of the n-grams that its texts use often enough; a query ands the masks in
an n-gram's slots and so gets all the languages that contain it at once. The set bits are counted per language
over all n-grams of a whole text, the hits expected from false positives are taken off, and the language with
the largest share decides. ``score`` is that share, 0 to 1, so that text in no known language scores low.

Learning reads at most about ``SAMPLE_ROWS`` labelled texts of each language, chosen by a hash of the id; the
filter has a fixed size. Prediction reads whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text when there
is nothing to learn from. Equal shares go to the first language in alphabetical order. Rows without a label
teach nothing. Repeated rows give repeated results. Other columns are never read. An empty table gives an empty
result.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, narrow, texts_of
from guestbook.llm.pieces import groups

GRAMS = (2, 3, 4)
SAMPLE_ROWS = 2_000
SLOT_BITS = 20
PROBES = 2
MIN_SHARE = 2e-5  # of a language's n-grams of one length: rarer ones are noise
CHARS = 1 << 18
ROWS_AT_ONCE = 256  # texts that a task holds as Python objects
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """Code point -> lower-case letter, or a space for whatever is no letter. One table per worker."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    table[marks()] = marks()  # marks belong to the word they stand in
    return table


@functools.cache
def marks() -> np.ndarray:
    return np.array([p for p in range(0x300, 0x3000) if unicodedata.category(chr(p)) in ("Mn", "Mc")], np.uint32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def cleaned(text: str) -> np.ndarray:
    """Lower-case letters and single spaces, with a space at both ends: n-grams see where words begin."""
    points = letters()[code_points(text)]
    points = np.concatenate(([32], points, [32])).astype(np.uint32)
    keep = points != 32
    keep[1:] |= keep[:-1]
    keep[0] = True
    return points[keep]


def hashed_grams(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all n-grams but those that reach over a space into the next word."""
    if len(points) < n:
        return np.zeros(0, np.uint64)
    windows = len(points) - n + 1
    mixed = np.full(windows, n, np.uint64)
    inside = np.ones(windows, bool)
    for k in range(n):
        some = points[k : k + windows]
        mixed = (mixed ^ some) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if 0 < k < n - 1:
            inside &= some != 32
    if n == 2:
        inside &= (points[:windows] != 32) | (points[1 : windows + 1] != 32)
    return mixed[inside]


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((hashes >> np.uint64(20 * k + 3)) & mask).astype(np.int64) for k in range(PROBES)]


@dataclass
class LanguageFilter:
    """``masks``: for each slot one byte for every eight languages."""

    languages: list[str]
    masks: np.ndarray
    false_positives: np.ndarray

    @classmethod
    def of(cls, grams: dict[str, np.ndarray]) -> LanguageFilter:
        """From the hashes of the n-grams of every language."""
        languages = sorted(grams)
        masks = np.zeros((1 << SLOT_BITS, max(1, -(-len(languages) // 8))), np.uint8)
        for k, language in enumerate(languages):
            for at in slots(grams[language]):
                masks[at, k // 8] |= np.uint8(1 << k % 8)
        fill = np.array([np.mean(masks[:, k // 8] >> (k % 8) & 1) for k in range(len(languages))])
        return cls(languages, masks, fill**PROBES)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """How many n-grams each language contains: the masks of the slots are anded, then counted by value."""
        first, *more = slots(hashes)
        found = np.zeros(8 * self.masks.shape[1], np.int64)
        for byte in range(self.masks.shape[1]):
            anded = self.masks[first, byte]
            for at in more:
                anded = anded & self.masks[at, byte]
            values = np.bincount(anded, minlength=256)
            found[8 * byte : 8 * byte + 8] = values @ (np.arange(256)[:, None] >> np.arange(8) & 1)
        return found[: len(self.languages)]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and corrected share of its n-grams; very long texts are counted in pieces."""
        total, hits, has_letter = 0, np.zeros(len(self.languages), np.int64), False
        for at in range(0, len(text), CHARS):
            points = cleaned(text[max(0, at - 3) : at + CHARS])
            has_letter = has_letter or bool(((points != 32) & ~np.isin(points, marks())).any())
            for n in GRAMS:
                hashes = hashed_grams(points, n)
                total += len(hashes)
                hits += self.hits(hashes)
        if not has_letter or not total or not self.languages:
            return UNKNOWN, 0.0
        shares = (hits / total - self.false_positives) / np.maximum(1e-9, 1 - self.false_positives)
        best = int(np.argmax(shares))
        return self.languages[best], float(np.clip(shares[best], 0.0, 1.0))


def learn(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageFilter:
    """From rows with a text and a language. A language's sample is the rows whose hashed id falls under a
    threshold that its row count sets."""
    rows = narrow(labelled, doc_id=doc_id, text=text, lang=lang).filter("text is not null and lang is not null")
    counts = {row.lang: row.n for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageFilter.of({})
    sampled = F.lit(False)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 40))
    for language, n in sorted(counts.items()):
        sampled = sampled | ((F.col("lang") == language) & (drawn < int(min(1.0, SAMPLE_ROWS / n) * (1 << 40))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            by_lang: dict[str, list[str]] = {}
            for language, held in zip(rows.column("lang").to_pylist(), texts_of(rows.column("text"))):
                by_lang.setdefault(language, []).append(held)
            for language, texts in by_lang.items():
                for some in groups(texts):
                    points = np.concatenate([cleaned(held) for held in some])
                    for n in GRAMS:
                        grams, times = np.unique(hashed_grams(points, n), return_counts=True)
                        yield batch(
                            lang=pa.array([language] * len(grams), pa.string()),
                            n=pa.array(np.full(len(grams), n, np.int32)),
                            gram=pa.array(grams.view(np.int64)),
                            times=pa.array(times),
                        )

    grams = rows.filter(sampled).mapInArrow(work, "lang string, n int, gram long, times long")
    grams = grams.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    found: dict[str, np.ndarray] = {}
    table = grams.toArrow()  # bounded by the sample
    for language in sorted(counts):
        mine = table.filter(pa.compute.equal(table.column("lang"), language))
        n, gram, times = (mine.column(name).to_numpy() for name in ("n", "gram", "times"))
        often = [gram[(n == k) & (times >= max(2, MIN_SHARE * times[n == k].sum()))] for k in GRAMS]
        found[language] = np.concatenate(often).view(np.uint64)
    return LanguageFilter.of(found)


def predict(docs: DataFrame, learned: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    held = docs.sparkSession.sparkContext.broadcast(learned)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (rows.slice(at, ROWS_AT_ONCE) for rows in batches for at in range(0, rows.num_rows, ROWS_AT_ONCE)):
            found = [held.value.predict(one) for one in texts_of(rows.column(text))]
            rows = rows.append_column("lang_pred", pa.array([language for language, _ in found], pa.string()))
            yield rows.append_column("score", pa.array([score for _, score in found], pa.float64()))

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(work, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth document by the CRC of its id as text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 == 0, F.lit(False))


def language_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the rows that are not held out."""
    learned = learn(docs.filter(~held_out(doc_id)), doc_id, text, lang)
    rows = narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    out = predict(rows, learned)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
