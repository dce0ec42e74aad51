import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import rows
from guestbook import shared
from guestbook.llm import byte_bpe, chunk_ids, token_counts, token_files
from guestbook.llm.elias_fano import EliasFano
from guestbook.llm.pieces import Memory
from llm.conftest import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

random.seed(4)
TEXTS = ODD + [
    "x <|endoftext|> y<|startoftext|>z",
    "it's WE'LL 's 'S ''s 12345 Ᲊ ꟎  \n\n  end ",
    "".join(random.choice("abcdeéñ \n'1ßΣİ漢😀") for _ in range(4000)),
    "ab" * 700 + "\n\n\n x",
    "".join(random.choice("abcd") for _ in range(900)),
    "naïve é ﬁ ǅ",
]


@pytest.fixture(scope="module")
def table(documents):
    return documents([(i, text) for i, text in enumerate(TEXTS)] + [(3, TEXTS[3]), (5, "other"), (None, "no id")])


def pairs(table):
    return [(row.doc_id, row.text or "") for row in table.collect()]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(table, library):
    want = []
    for doc_id, text in pairs(table):
        ids = library.encode_ordinary(text)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(byte_bpe.round_trips(table, RANKS, public_tokenizers.PATTERN)) == sorted(want, key=repr)


def test_token_id_column(table, library):
    got = byte_bpe.with_token_ids(table.withColumn("n_tokens", F.lit("clash")), RANKS, public_tokenizers.PATTERN)
    for row in got.collect():
        assert np.frombuffer(row.token_ids, "<u4").tolist() == library.encode_ordinary(row.text or "")
        assert row.n_tokens == len(row.token_ids) // 4
    assert got.columns == [*table.columns, "token_ids", "n_tokens"]


def test_matrix_and_heap_merge_alike():
    bpe = byte_bpe.load(RANKS, public_tokenizers.PATTERN)[0]
    pieces = ["".join(random.choice("aab bé") for _ in range(random.randint(1, 200))) for _ in range(300)]
    merged = bpe._matrix_merged([piece.encode() for piece in pieces], 512)
    assert merged == [bpe._heap_merged(piece.encode()) for piece in pieces]


def test_very_long_texts_go_in_parts(monkeypatch, library):
    monkeypatch.setattr("guestbook.llm.pieces.GROUP_CHARS", 100)
    texts = ["some words, " * 50, "short", "x" * 500]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in byte_bpe.encode_texts(texts, RANKS, public_tokenizers.PATTERN)]
    assert got == [library.encode_ordinary(text) for text in texts]


def test_memory_stays_bounded():
    asked = []
    cache = Memory(lambda pieces: [asked.append(p) or p.upper() for p in pieces], most=3, longest=4)
    for text in ("a b c", "a d e", "a b", "toolong a", "toolong"):
        assert cache.look_up([text.split()]) == [text.upper().split()]
        assert len(cache.young) <= 8 and len(cache.old) <= 8
    assert asked.count("a") <= 2 and asked.count("toolong") == 2


def test_counts_equal_the_library(table):
    tokenizer = Tokenizer.from_file(WORDS)
    want = [(i, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False).ids), n > 20) for i, t in pairs(table)]
    assert rows(token_counts.token_counts(table, WORDS, limit=20)) == sorted(want, key=repr)


def test_first_tier_changes_nothing(table, monkeypatch):
    want = rows(token_counts.token_counts(table, WORDS))
    monkeypatch.setattr(token_counts, "SENT", 1)
    monkeypatch.setattr(token_counts, "SUMMARY", 4)
    assert rows(token_counts.token_counts(table, WORDS)) == want


def test_frequent_table_is_compact_and_whole(table):
    frequent = token_counts.frequent_lengths(table, WORDS, most=50)
    held = frequent.table()
    assert 0 < len(held) <= 50 and all(n == len(Tokenizer.from_file(WORDS).encode(p).ids) for p, n in held.items())


def test_files_read_back_what_the_library_gives(spark, table, tmp_path, monkeypatch):
    for block_ids in (64, 1 << 16):
        monkeypatch.setattr(token_files, "BLOCK_IDS", block_ids)
        folder = f"{tmp_path}/{block_ids}"
        token_files.write_tokens(table, folder, BYTES, end_id=2)
        tokenizer, start, want = Tokenizer.from_file(BYTES), 0, []
        for doc_id, text in sorted(pairs(table), key=lambda p: (p[0] is None, p[0] or 0, p[1])):
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert rows(token_files.read_tokens(spark, folder)) == sorted(want, key=repr)
        blocks = [row.asDict() for row in spark.read.parquet(folder).collect()]
        some = max(blocks, key=lambda b: b["n_docs"])
        whole = np.frombuffer(some["ids"], f"<u{some['id_bytes']}").tolist()
        assert sum((token_files.read_document(some, k).tolist() for k in range(some["n_docs"])), []) == whole


def test_only_files_and_one_shuffle_are_written(spark, table, tmp_path, monkeypatch):
    written, new_path = [], shared.new_table_path
    monkeypatch.setattr(shared, "new_table_path", lambda spark, name: written.append(name) or new_path(spark, name))
    token_files.write_tokens(table, f"{tmp_path}/files", BYTES, end_id=2)
    assert written == ["lookup"]  # of ids that several rows share


def test_shards_are_even_ranges_of_ids(spark, documents, tmp_path):
    ids = [2**62 + 3 * i for i in range(600)] + [2**62 + 9] * 40 + [None] * 3
    token_files.write_tokens(documents([(i, f"text {k}") for k, i in enumerate(ids)]), f"{tmp_path}/files", BYTES, end_id=2)
    held = {}
    for block in spark.read.parquet(f"{tmp_path}/files").orderBy("shard", "block").collect():
        known = np.unpackbits(np.frombuffer(block.known_ids, np.uint8), count=block.n_docs)
        held.setdefault(block.shard, []).extend(i if k else None for i, k in zip(np.frombuffer(block.doc_ids, "<i8").tolist(), known))
    assert sum(held.values(), []) == sorted((i for i in ids if i is not None)) + [None] * 3
    assert sorted(held) == list(range(4)) and all(130 <= len(some) <= 220 for some in held.values())
    assert sum(2**62 + 9 in some for some in held.values()) == 1
    assert token_files.write_tokens(documents([(2**63 - 1, "a"), (-(2**63), "b"), (0, None)]), f"{tmp_path}/far", BYTES, end_id=2) is None
    assert sorted(row.doc_id for row in token_files.read_tokens(spark, f"{tmp_path}/far").collect()) == [-(2**63), 0, 2**63 - 1]


def test_empty_tables(spark, documents, tmp_path):
    none = documents([])
    token_files.write_tokens(none, f"{tmp_path}/none", BYTES, end_id=2)
    assert token_files.read_tokens(spark, f"{tmp_path}/none").count() == 0
    assert token_counts.token_counts(none, WORDS).count() == 0
    assert byte_bpe.round_trips(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_elias_fano_selects_every_position():
    for universe in (0, 1, 70, 1000, 10**6):
        for count in (1, 2, 65, 700):
            positions = np.sort(np.random.default_rng(count).integers(0, universe + 1, count))
            coded = EliasFano.of(positions, universe)
            assert coded.all().tolist() == positions.tolist() == [coded.select(k) for k in range(count)]
    assert EliasFano.of(np.arange(0, 10**6, 100), 10**6).n_bytes() * 8 < 10**4 * 9.5


def test_encoded_chunks_equal_the_library(monkeypatch):
    made = chunk_ids.Encoder(BYTES)
    letters = "abcdeéñ \n'1ßΣİ漢😀  \t\x0b\x1c\x85\r\xa0 ªº.,$​́"
    rng = random.Random(5)
    texts = TEXTS + ["'really don't'll ª × ǀ", "a  b   c ", "x <|endoftext|>y " * 3] + ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000)]
    want = [made._by_library([text or ""])[0] for text in texts]
    for slice_bytes, cached, long in ((1 << 20, 1 << 20, 1 << 20), (500, 50, 40)):
        monkeypatch.setattr(chunk_ids, "SLICE_BYTES", slice_bytes)
        monkeypatch.setattr(chunk_ids, "CACHED_CHUNKS", cached)
        monkeypatch.setattr(chunk_ids, "CACHED_WORDS", cached)
        monkeypatch.setattr(chunk_ids, "LONG_CHARS", long)
        assert list(made.texts(pa.array(texts, pa.string()))) == want
    assert not made.whole.encode("").ids and chunk_ids.Encoder(WORDS).by_chunks is False


def test_clashing_columns(spark, documents, tmp_path):
    table = documents([(1, "some words"), (2, None), (2, "again"), (None, "no id")])
    clash = table.withColumns({name: F.lit(name) for name in ("ids", "tie", "is_repeated", "n", "id_bytes", "shard", "piece", "n_tokens", "start", "n_bytes")})
    for name, docs in (("plain", table), ("clash", clash)):
        token_files.write_tokens(docs, f"{tmp_path}/{name}", BYTES, end_id=2)
    assert rows(token_files.read_tokens(spark, f"{tmp_path}/plain")) == rows(token_files.read_tokens(spark, f"{tmp_path}/clash"))
    assert rows(token_counts.token_counts(clash, WORDS)) == rows(token_counts.token_counts(table, WORDS))
    assert rows(byte_bpe.round_trips(clash, RANKS, public_tokenizers.PATTERN)) == rows(byte_bpe.round_trips(table, RANKS, public_tokenizers.PATTERN))
