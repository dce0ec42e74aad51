import random

import numpy as np
import pytest
import xxhash
from conftest import SMALL, rows

from pyspark.sql import functions as F
from guestbook.llm import simhash
from guestbook.llm.components import components, joined
from llm.conftest import ODD, roots


def plain_fingerprint(text):
    words, word = [], ""
    for char in (text or "") + " ":
        if char in " \t\n\r\v\f":
            words += [word] if word else []
            word = ""
        else:
            word += chr(ord(char) + 32) if "A" <= char <= "Z" else char
    shingles = [words[i : i + 4] for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(" ".join(shingle).encode(), seed=42).intdigest() for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected(pairs):
    pairs = sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))
    prints = [plain_fingerprint(text) for _, text in pairs]
    links = [(i, j) for i in range(len(pairs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    return sorted([(p[0], f"{f:016x}", pairs[r][0]) for p, f, r in zip(pairs, prints, roots(len(pairs), links))], key=repr)


def near_copies(n, seed=5):
    random.seed(seed)
    base = [" ".join(random.choice("alpha Beta gamma delta eps zeta eta".split()) for _ in range(120)) for _ in range(12)]
    return [(i, base[i % 12] + " x" * (i % 5)) for i in range(n)]


def test_equal_to_brute_force(documents):
    pairs = near_copies(80) + [(100 + i, text) for i, text in enumerate(ODD)] + [(None, "a b c d e"), (3, "two words"), (3, "two words")]
    assert rows(simhash.near_duplicates(documents(pairs))) == expected(pairs)


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    pairs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows(queries()["op8_simhash_near_dedup"](spark, SMALL)) == expected(pairs)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("shard, block", [(20, 200_000), (100_000, 200_000), (100, 30), (100_000, 50)])
def test_trees_find_every_pair(spark, monkeypatch, shard, block):
    monkeypatch.setattr(simhash, "SHARD_FINGERPRINTS", shard)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 10)
    monkeypatch.setattr(simhash, "SAMPLE", 64)
    random.seed(2)
    found = {random.getrandbits(64) for _ in range(150)}
    for base in list(found)[:40]:
        for _ in range(4):
            flipped = base
            for bit in random.sample(range(64), random.randint(0, 6)):
                flipped ^= 1 << bit
            found.add(flipped)
    signed = np.array(sorted(found), np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {row.node: row.root for row in components(links).collect()}
    order = sorted(signed)
    pairs = [(i, j) for i in range(len(order)) for j in range(i) if ((order[i] ^ order[j]) & (2**64 - 1)).bit_count() <= 4]
    want = roots(len(order), pairs)
    assert [got.get(x, x) for x in order] == [order[r] for r in want]


def test_clashing_columns(documents):
    pairs = near_copies(30)
    clash = documents(pairs).withColumns({name: F.lit(name) for name in ("fp", "node", "root", "shard", "home", "fingerprint", "component_id")})
    assert rows(simhash.near_duplicates(clash)) == expected(pairs)


def test_links_are_joined_like_one_by_one():
    draw = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        a, b = draw.integers(0, n, n // 2), draw.integers(0, n, n // 2)
        want = roots(n, zip(a.tolist(), b.tolist()))
        assert joined(np.arange(n), a, b).tolist() == want
        half = len(a) // 2
        assert joined(joined(np.arange(n), a[:half], b[:half]), a[half:], b[half:]).tolist() == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(7, 7), (60, 50)]
    got = {row.node: row.root for row in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {i: 0 for i in range(1, 30)} | {60: 50}
