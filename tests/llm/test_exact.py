import hashlib

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from guestbook.llm.exact import PerfectHash, exact_duplicates
from llm.conftest import ODD


def expected(pairs):
    groups = {}
    for doc_id, text in pairs:
        bare = (text or "").translate({ord(c): None for c in " \t\n\r\v\f"})
        groups.setdefault(hashlib.sha256(bare.encode()).hexdigest(), []).append((doc_id, text or ""))
    out = []
    for digest, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(doc_id, order[0][0], len(members), k == 0, digest) for k, (doc_id, _) in enumerate(order)]
    return sorted(out, key=repr)


PAIRS = (
    [(i, text) for i, text in enumerate(ODD)]
    + [(100 + i, f"copyé{i % 7} " + " " * (i % 3)) for i in range(60)]
    + [(None, "a"), (None, "only here"), (200, "same row"), (200, "same row"), (7, "a "), (3, " a")]
)


def test_groups_equal_brute_force_whatever_the_history(documents):
    for history in (F.lit(False), F.lit(True), F.col("doc_id") < 120, F.col("doc_id") % 3 == 0):
        got = exact_duplicates(documents(PAIRS), history).drop("in_history")
        assert rows(got) == expected(PAIRS)


def test_empty_table_and_clashing_columns(documents):
    assert exact_duplicates(documents([]), F.col("doc_id") < 5).count() == 0
    clashing = documents(PAIRS).withColumns({name: F.lit(name) for name in ("digest", "_old", "bucket", "copies", "keep_id", "known")})
    assert rows(exact_duplicates(clashing, F.col("doc_id") < 120).drop("in_history")) == expected(PAIRS)


def test_one_row_stays_of_rows_that_share_an_id(documents):
    pairs = [(7, "a b"), (7, "a  b"), (7, "a b"), (9, "ab"), (5, "x"), (5, "x"), (None, "y"), (None, "y")]
    for history in (F.lit(False), F.lit(True), F.col("doc_id") < 6):
        got = exact_duplicates(documents(pairs), history).collect()
        kept = [(row.doc_id, row.keep_id, row.group_size) for row in got if row.kept]
        assert sorted(kept, key=repr) == [(5, 5, 2), (7, 7, 4), (None, None, 2)] and len(got) == 8


def test_history_tells_which_texts_it_knows(documents):
    got = exact_duplicates(documents([(1, "a"), (2, "b"), (9, "a"), (8, "c")]), F.col("doc_id") < 5)
    assert dict(rows(got.select("doc_id", "in_history"))) == {1: True, 2: True, 9: True, 8: False}


def test_perfect_hash_is_minimal_and_compares_bytes():
    found = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    hashed = PerfectHash.over(found)
    assert sorted(hashed.slots(found).tolist()) == list(range(3000))
    others = [hashlib.sha256(f"x{i}".encode()).digest() for i in range(500)]
    table = np.empty(3000, object)
    table[hashed.slots(found)] = found
    assert not any(k >= 0 and table[k] == digest for k, digest in zip(hashed.slots(others), others))


def test_digests_that_no_level_sets_apart_are_found(monkeypatch):
    monkeypatch.setattr("guestbook.llm.exact.LEVELS", 1)
    found = [hashlib.sha256(str(i).encode()).digest() for i in range(200)]
    hashed = PerfectHash.over(found)
    assert hashed.rest and sorted(hashed.slots(found).tolist()) == list(range(200))


def test_many_buckets(documents, monkeypatch):
    monkeypatch.setattr("guestbook.llm.exact.BUCKET_DIGESTS", 5)
    assert rows(exact_duplicates(documents(PAIRS), F.col("doc_id") < 120).drop("in_history")) == expected(PAIRS)
