"""Byte-level BPE over length-bucketed matrices.

Distinct pre-tokens become rows of byte ids, padded to the length of their bucket. In every round each row
merges its leftmost pair of the lowest rank; ranks come from a hash table of pairs, only the two pairs beside
a merge are looked up again, the columns move together by one, and rows without a pair to merge leave. What a
pre-token encodes to stays in the worker's bounded cache. Pre-tokens too long for a matrix are merged with a
heap. Decoding gathers the bytes of the ids from one flat array.

Defined results: a null text is an empty one, with no ids. Characters that are special strings elsewhere are
ordinary text. Repeated rows give repeated results. Other columns are passed on only where said. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch, give_back, narrow, texts_of
from guestbook.llm.pieces import ChunkMemory, Memory

BUCKETS = (2, 4, 8, 12, 16, 24, 32, 64, 128, 256)
BUCKET_OF = [next(width for width in BUCKETS if length <= width) for length in range(BUCKETS[-1] + 1)]
CELLS = 1 << 18
CACHED = 300_000
NONE = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)


class PairTable:
    """Open addressing: (left id, right id) -> rank of the token that they make."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(len(pairs) * 3).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY, np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys, todo = self._key(pairs[:, 0], pairs[:, 1]), np.arange(len(pairs))
        at = self._start(keys)
        while len(todo):
            free = todo[self.keys[at[todo]] == EMPTY]
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.ranks[at[placed]] = keys[placed], ranks[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs given as flat arrays; NONE where there is no such token or a side is padding."""
        out, todo = np.full(len(left), NONE, np.int32), np.nonzero((left >= 0) & (right >= 0))[0]
        keys = self._key(left[todo], right[todo])
        at = self._start(keys)
        while len(todo):
            held = self.keys[at]
            hit = held == keys
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (held != EMPTY)
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & (len(self.keys) - 1)
        return out


class ByteBpe:
    """Merges of a rank file; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right))
                    made.append(rank)
        self.table = PairTable(np.array(pairs, np.int64).reshape(-1, 2), np.array(made, np.int32))
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        encoded = [piece.encode() for piece in pieces]
        out: list[bytes] = [b""] * len(pieces)
        by_bucket: dict[int, list[int]] = {width: [] for width in BUCKETS}
        whole = self.ranks.get
        for i, piece in enumerate(encoded):
            if (rank := whole(piece)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > BUCKETS[-1]:
                out[i] = self._heap_merged(piece)
            elif piece:
                by_bucket[BUCKET_OF[len(piece)]].append(i)
        for width, rows in by_bucket.items():
            step = max(1, CELLS // width)
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                for i, ids in zip(some, self._matrix_merged([encoded[i] for i in some], width)):
                    out[i] = ids
        return out

    def _matrix_merged(self, pieces: list[bytes], width: int) -> list[bytes]:
        padded = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8).reshape(-1, width)
        lengths = np.array([len(piece) for piece in pieces])
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[padded], np.int32(-1))
        ranks = self.table.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        rows = np.arange(len(pieces))
        out: list[bytes] = [b""] * len(pieces)
        while len(rows):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            lowest = ranks[np.arange(len(rows)), best] if ranks.shape[1] else np.full(len(rows), NONE)
            done = lowest == NONE
            if done.any():
                ready, held = ids[done], ids[done] >= 0
                flat, ends = ready[held].astype("<u4").tobytes(), 4 * np.cumsum(held.sum(axis=1))
                start = 0
                for row, end in zip(rows[done].tolist(), ends.tolist()):
                    out[row], start = flat[start:end], end
                live = ~done
                ids, ranks, rows, best, lowest = ids[live], ranks[live], rows[live], best[live], lowest[live]
                if not len(rows):
                    break
            every, columns = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[every, best] = lowest
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= best[:, None]), axis=1)
            for beside in (best - 1, best):
                there = np.nonzero((beside >= 0) & (beside < ranks.shape[1]))[0]
                at = beside[there]
                ranks[there, at] = self.table.look_up(ids[there, at], ids[there, at + 1])
        return out

    def _heap_merged(self, piece: bytes) -> bytes:
        """The same merges for one long piece, in n log n steps."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        rank_of, end = self.ranks.get, len(parts)
        heap = [(rank, i) for i in range(end - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else end
            if j >= end or rank_of(parts[i] + parts[j]) != rank:  # a merge nearby has changed this pair
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[j] < end:
                before[after[j]] = i
                if (follows := rank_of(parts[i] + parts[after[j]])) is not None:
                    heapq.heappush(heap, (follows, i))
            if before[i] >= 0 and (precedes := rank_of(parts[before[i]] + parts[i])) is not None:
                heapq.heappush(heap, (precedes, before[i]))
        return np.array([self.ranks[part] for part in parts if part is not None], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        out, every = [], np.frombuffer(ids, "<u4")
        for at in range(0, len(every), CELLS):
            some = every[at : at + CELLS]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            out.append(self.flat[np.repeat(self.starts[some] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@functools.cache
def load(ranks_path: str, pattern: str) -> tuple[ByteBpe, ChunkMemory]:
    """The merges, and the ids of chunks of text and of the pre-tokens in them. One per worker."""
    with open(ranks_path, "rb") as file:
        bpe = ByteBpe({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())})
    pieces, compiled = Memory(bpe.encode_pieces, CACHED), regex.compile(pattern)

    def encode(chunks: list[str]) -> list[bytes]:
        return list(map(b"".join, pieces.look_up([compiled.findall(chunk) for chunk in chunks])))

    return bpe, ChunkMemory(encode, CACHED, pieces)


def encode_texts(texts: list[str], ranks_path: str, pattern: str) -> Iterator[bytes]:
    """The ids of every text."""
    return map(b"".join, load(ranks_path, pattern)[1].look_up(texts))


def with_token_ids(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (binary, little-endian unsigned 32-bit integers) and ``n_tokens``.

    Columns of these names are replaced. A task forgets its chunks at its end: the worker's memory is free for others.
    """
    docs = docs.drop("token_ids", "n_tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = list(encode_texts(texts_of(rows.column(text)), ranks_path, pattern))
            rows = rows.append_column("token_ids", pa.array(ids, pa.binary()))
            yield rows.append_column("n_tokens", pa.array([len(x) // 4 for x in ids], pa.int64()))
        load(ranks_path, pattern)[1].clear()
        give_back()

    schema = docs.withColumns({"token_ids": F.lit(b""), "n_tokens": F.lit(0).cast("long")}).schema
    return docs.mapInArrow(work, schema)


def round_trips(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes that they decode to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bpe = load(ranks_path, pattern)[0]
            lengths, id_digests, byte_digests = [], [], []
            for ids in encode_texts(texts_of(rows.column("text")), ranks_path, pattern):
                lengths.append(len(ids) // 4)
                id_digests.append(hashlib.sha256(ids).hexdigest())
                byte_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield batch(
                doc_id=rows.column("doc_id"),
                n_tokens=pa.array(lengths, pa.int64()),
                ids_sha256=pa.array(id_digests, pa.string()),
                decoded_sha256=pa.array(byte_digests, pa.string()),
            )

    rows = narrow(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
