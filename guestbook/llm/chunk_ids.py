"""Ids of whole texts by a tokenizer file, each distinct chunk of a batch encoded once.

A chunk is a run of white space and the word after it: no pre-token reaches from a word over white space into the
next, so the ids of a text are those of its chunks in a row. Arrow splits the texts and codes their words; only
distinct words that the worker does not remember go to the library, already cut into pre-tokens where these are
certain (Latin letters and ASCII), so that the library has nothing to do but merge. Everything else - chunks in
other scripts, texts that hold an added token, tokenizers that are not byte-level BPE - goes to the library's
tokenizer as it stands.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from guestbook.llm.pieces import CHUNK, segments

SLICE_BYTES = 12 << 20
LONG_CHARS = 2 << 20
CACHED_WORDS = 1_500_000
CACHED_CHUNKS = 200_000
LONGEST = 64  # characters of a chunk that is remembered
SHORT = 8  # characters of a pre-token that is remembered besides the chunks that it stands in
AT_ONCE = 4_000  # pre-tokens in one call of the library

#: White space before a space: there a chunk does not begin at every space.
BEFORE_SPACE = r"[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}] "
ONE_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
KNOWN_CHARS = re.compile("[\x00-ɏ]*")

# The pre-token pattern and the printable stand-ins of bytes in byte-level BPE vocabularies.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
STAND_INS = dict(zip([b for b in range(256) if b not in PRINTABLE], range(256, 512)))


class Encoder:
    """A tokenizer file, and what this worker remembers of its chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.kind = "<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.kind[2])
        self.added = [token["content"] for token in spec["added_tokens"]]
        cut = spec["pre_tokenizer"] or {}
        self.by_chunks = (
            spec["model"]["type"] == "BPE" and spec["normalizer"] is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex") is True and not cut.get("add_prefix_space")
            and all(chr(STAND_INS.get(b, b)) in spec["model"]["vocab"] for b in range(256))
        )
        if self.by_chunks:
            self.n_bytes = np.zeros(max(spec["model"]["vocab"].values()) + 1, np.int64)
            for token, i in spec["model"]["vocab"].items():
                self.n_bytes[i] = len(token)
            bare = {"pre_tokenizer": None, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None}
            self.merger = Tokenizer.from_str(json.dumps(spec | bare))
        self.plain: dict[str, bytes] = {}  # pre-tokens and chunks that do not stand after a single space
        self.words, self.used = pa.array([], pa.string()), np.zeros(0, np.int32)  # words after a space; the slice that used them last
        self.ids, self.bounds, self.slices = np.zeros(0, self.kind), np.zeros(1, np.int64), 0

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of every text of a column in the file's integers, in its order; a null text is empty."""
        column = pc.fill_null(column, "")
        if not self.by_chunks:
            for text in column:
                yield self._by_library([text.as_py()])[0]
            return
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            some = column.slice(at, end - at)
            if len(some) == 1 and len(text := some[0].as_py()) > LONG_CHARS and not self._holds_added(some)[0]:
                yield b"".join(b"".join(self._sliced(pa.array([part]))) for part in segments(text, LONG_CHARS))
            else:
                yield from self._sliced(some)
            at = end

    def _holds_added(self, column: pa.Array) -> np.ndarray:
        found = np.zeros(len(column), bool)
        for token in self.added:
            found |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        return found

    def _sliced(self, column: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(column, BEFORE_SPACE).to_numpy(zero_copy_only=False)
        added = self._holds_added(column)
        out: list[bytes] = [b""] * len(column)
        regular = np.nonzero(~(odd | added))[0]
        for k, ids in zip(regular.tolist(), self._regular(column.take(pa.array(regular)))):
            out[k] = ids
        for k in np.nonzero(odd & ~added)[0].tolist():
            out[k] = b"".join(self._chunks(CHUNK.findall(column[k].as_py())))
        for k in np.nonzero(added)[0].tolist():
            out[k] = self._by_library([column[k].as_py()])[0]
        return out

    def _regular(self, column: pa.Array) -> Iterator[bytes]:
        """Texts in which a chunk begins at every space: the first chunk of each stands without one."""
        split = pc.split_pattern(column, " ")
        bounds, words = split.offsets.to_numpy().astype(np.int64), split.values
        heads = self._chunks(words.take(pa.array(bounds[:-1])).to_pylist())
        coded = words.dictionary_encode()
        at, n_kept = self._words(coded.dictionary)
        at = at[coded.indices.to_numpy()]
        n = np.diff(self.bounds)[at]
        n[bounds[:-1]] = 0
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.bounds[at] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        rows = np.append(0, ends)[bounds].tolist()
        self._forget(n_kept)
        for head, a, b in zip(heads, rows, rows[1:]):
            yield head + ids[a:b].tobytes()

    def _words(self, words: pa.Array) -> tuple[np.ndarray, int]:
        """Where the ids of distinct words that stand after a space are held, after those that were not have been
        added; and how many of all the held words may be kept."""
        self.slices += 1
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        missing = np.nonzero(at < 0)[0]
        is_long = pc.greater(pc.utf8_length(words.take(pa.array(missing))), LONGEST).to_numpy(zero_copy_only=False)
        missing = np.concatenate((missing[~is_long], missing[is_long]))
        at[missing] = len(self.words) + np.arange(len(missing))
        n_kept = len(self.words) + len(missing) - int(is_long.sum())
        new = words.take(pa.array(missing))
        found = self._new_chunks([" " + word for word in new.to_pylist()])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        self.words = pa.concat_arrays([self.words, new])
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), self.kind)))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.used = np.concatenate((self.used, np.zeros(len(missing), np.int32)))
        self.used[at] = self.slices
        return at, n_kept

    def _forget(self, n_kept: int) -> None:
        """Drop long words, and beyond the limit the half that was not used for longest."""
        keep = np.arange(len(self.words)) < n_kept
        if n_kept > CACHED_WORDS:
            keep &= self.used > np.partition(self.used, n_kept // 2)[n_kept // 2]
        if not keep.all():
            sizes = np.diff(self.bounds)
            self.ids, sizes = self.ids[np.repeat(keep, sizes)], sizes[keep]
            self.words, self.used = self.words.filter(pa.array(keep)), self.used[keep]
            self.bounds = np.append(0, np.cumsum(sizes))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as they stand."""
        if len(self.plain) > CACHED_CHUNKS:
            self.plain.clear()
        missing = list(dict.fromkeys(chunk for chunk in chunks if chunk not in self.plain))
        known = dict(zip(missing, self._new_chunks(missing)))
        self.plain.update((chunk, ids) for chunk, ids in known.items() if len(chunk) <= LONGEST)
        return [known[chunk] if chunk in known else self.plain[chunk] for chunk in chunks]

    def _new_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks: those that are several pre-tokens, or not surely one, are cut first."""
        single, compound, strange = [], [], []
        for chunk in chunks:
            if ONE_WORD.fullmatch(chunk):
                single.append(chunk)
            elif KNOWN_CHARS.fullmatch(chunk):
                compound.append(chunk)
            else:
                strange.append(chunk)
        known = dict(zip(single, self._merged(single)))
        cut = [PRE_TOKEN.findall(chunk) for chunk in compound]
        pieces = {piece: known.get(piece) or self.plain.get(piece) for some in cut for piece in some}
        new = [piece for piece, ids in pieces.items() if ids is None]
        pieces.update(zip(new, self._merged(new)))
        known.update((chunk, b"".join([pieces[piece] for piece in some])) for chunk, some in zip(compound, cut))
        known.update(zip(strange, self._by_library(strange)))
        self.plain.update((piece, pieces[piece]) for piece in new if len(piece) <= SHORT)
        return [known[chunk] for chunk in chunks]

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of pre-tokens."""
        shown = [_shown(piece) for piece in pieces]
        ids = [np.zeros(0, self.kind)]
        for k in range(0, len(shown), AT_ONCE):
            lot = [shown[k : k + AT_ONCE]]
            ids.append(np.array(self.merger.encode_batch_fast(lot, is_pretokenized=True, add_special_tokens=False)[0].ids, self.kind))
        ids = np.concatenate(ids)
        # A stand-in is a character for each byte, so the tokens' lengths tell where the ids of each piece end.
        ends = np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)))
        ends = (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1) * self.width
        held, ends = ids.tobytes(), ends.tolist()
        return [held[a:b] for a, b in zip([0, *ends], ends)]

    def _by_library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(text.ids, self.kind).tobytes() for text in found]


def _shown(piece: str) -> str:
    """The stand-ins of a piece's bytes."""
    if piece.isascii() and piece[1:].isalpha():
        return "Ġ" + piece[1:] if piece[0] == " " else piece if piece.isalpha() else piece.translate(STAND_INS)
    return piece.encode().decode("latin-1").translate(STAND_INS)


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)
