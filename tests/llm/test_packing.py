import functools
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from conftest import rows
from guestbook.llm import packing
from llm.conftest import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    """The least number of sequences, by trying every set for the longest piece."""

    @functools.cache
    def least(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = len(left)
        for size in range(len(rest) + 1):
            for some in set(itertools.combinations(rest, size)):
                if first + sum(some) <= capacity:
                    best = min(best, 1 + least(tuple((Counter(rest) - Counter(some)).elements())))
        return best

    return least(tuple(sorted(lengths, reverse=True)))


def test_fixed_sets_keep_an_optimum():
    rng, fixed = random.Random(3), Counter()
    for _ in range(400):
        capacity = rng.choice((10, 17, 30))
        lengths = [rng.randint(rng.choice((1, capacity // 4)), capacity) for _ in range(rng.randint(1, 9))]
        left = np.bincount(lengths, minlength=capacity + 1)
        found = list(packing.reduced(left))
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        assert Counter(lengths) == Counter(rest) + Counter(x for some, times in found for x in some * times)
        assert all(sum(some) <= capacity for some, _ in found)
        fixed.update(len(some) for some, _ in found)
        assert sum(times for _, times in found) + fewest(rest, capacity) == fewest(lengths, capacity)
    assert min(fixed[1], fixed[2], fixed[3]) > 10


def test_best_fit_in_bulk_is_best_fit_one_by_one():
    rng = random.Random(4)
    for _ in range(100):
        capacity = rng.choice((10, 50))
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))]
        bins = []
        for length in sorted(lengths, reverse=True):
            room = [(capacity - sum(held), k) for k, held in enumerate(bins) if sum(held) + length <= capacity]
            if room:
                bins[min(room)[1]].append(length)
            else:
                bins.append([length])
        found = packing.best_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
        got, used = Counter(), Counter()
        for pattern, times in found:
            got[sum(x * n for x, n in pattern)] += times
            for x, n in pattern:
                used[x] += n * times
        assert got == Counter(map(sum, bins)) and used == Counter(lengths)  # sequences with equal room are alike


def test_plan_does_not_grow_with_the_pieces():
    rng = np.random.default_rng(5)
    lengths, n = np.unique(np.minimum(2048, rng.lognormal(6, 1, 100_000).astype(int) + 1), return_counts=True)
    plans = [packing.Plan.of(dict(zip(lengths.tolist(), (n * k).tolist())), 2048) for k in (1, 1_000_000)]
    sizes = [sum(map(len, plan.entries.values())) for plan in plans]
    assert sizes[1] < 3 * sizes[0] < 100_000
    for k, plan in zip((1, 1_000_000), plans):
        assert plan.fixed > 0 and plan.sequences <= 1.01 * -(-int((lengths * n).sum()) * k // 2048)
        assert plan.used == dict(zip(lengths.tolist(), (n * k).tolist()))


def verified(found, texts, end_id, capacity):
    """Rows of the operator against the library, document by document and sequence by sequence."""
    tokenizer = Tokenizer.from_file(BYTES)
    want = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        want.update((doc_id, k, a, b - a, tuple(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    held = [(row, np.frombuffer(row.ids, f"<u{row.id_bytes}")) for row in found]
    assert want == Counter((row.doc_id, row.piece, row.start, row.length, tuple(ids.tolist())) for row, ids in held)
    places = {}
    for row in found:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for some in places.values():
        ends = list(itertools.accumulate(length for _, length in sorted(some)))
        assert [offset for offset, _ in sorted(some)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(places)


def test_pieces_against_the_library(documents):
    rng = random.Random(6)
    texts = [(i, text) for i, text in enumerate(ODD)] + [(3, "same id"), (3, "same id"), (None, "no id"), (None, "no id"), (99, "wörd, " * 9000)]
    texts += [(200 + i, "word " * rng.randint(0, 60)) for i in range(300)]
    table = documents(texts).withColumns({"ids": F.lit("clash"), "piece": F.lit("clash"), "key": F.lit("clash"), "length": F.lit(None), "_part": F.lit(1)})
    for capacity in (2048, 64):
        found = packing.packed(table, BYTES, end_id=0, capacity=capacity)
        n = verified(found.collect(), texts, 0, capacity)
        assert n == len({row.sequence_id for row in found.select("sequence_id").collect()})
        whole = {row.sequence_id: row for row in packing.sequences(found).collect()}
        assert len(whole) == n
        for row in found.collect():
            sequence = np.frombuffer(whole[row.sequence_id].ids, f"<u{row.id_bytes}")
            assert sequence[row.offset : row.offset + row.length].tobytes() == row.ids
    digests = packing.digested(packing.packed(table, BYTES, end_id=0))
    tokenizer = Tokenizer.from_file(BYTES)
    assert [row.ids_crc32 for row in digests.filter("doc_id = 5").collect()] == [zlib.crc32(np.array([*tokenizer.encode("a").ids, 0], "<u4").tobytes())]


def test_empty_table(documents):
    assert rows(packing.packed(documents([]), BYTES, end_id=0)) == []


def test_query_at_the_smallest_scale(spark):
    from guestbook.llm.queries import LLM_QUERIES

    found = LLM_QUERIES["op12_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    tokenizer, want = Tokenizer.from_file(BYTES), Counter()
    for row in docs:
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((row.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert want == Counter((row.doc_id, row.piece, row.start, row.length, row.ids_crc32) for row in found)
    used = {row.sequence_id for row in found}
    assert len(used) <= 1.02 * -(-sum(row.length for row in found) // 2048)
