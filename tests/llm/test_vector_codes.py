import hashlib
import math
import random

import numpy as np
import pytest
from conftest import rows
from guestbook.llm import vector_codes
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(data, parts, entries, rounds):
    """Plain k-means of the contract in Python integers: {row number: (code, error)}, codebooks and errors by label."""
    kept = [(i, v, label) for i, v, label in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, [math.floor(256 * x) for x in v] + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0))
    books = [[row[1][p * width : (p + 1) * width] for row in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p]))

    def assign():
        return [[nearest(p, row[1][p * width : (p + 1) * width]) for p in range(parts)] for row in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [row[1][p * width : (p + 1) * width] for row, codes in zip(kept, found) if codes[p][1] == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in codes) for codes in found]
    by_label = {}
    for row, error in zip(kept, errors):
        by_label[row[2]] = by_label.get(row[2], 0) + error
    out = [(row[0], "".join(f"{k:02x}" for _, k in codes), error, by_label[row[2]]) for row, codes, error in zip(kept, found, errors)]
    return sorted(out, key=repr), hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()


def codes(table, **how):
    found, books = vector_codes.vector_codes(table, **how)
    found = vector_codes.with_label_error(found).select("vec_id", F.lower(F.hex("codes")), "error", "label_error")
    return rows(found), vector_codes.digest(books)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(13)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    made = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], rng.choice([0, 1, None])) for i in rng.sample(range(1000), 300)]
    made += [(2000 + k, [0.25 * k] * 8, 2) for k in range(4)] * 3
    odd = [None, [], [1.0], [None] * 8, [math.nan] * 8, [math.inf] + [0.0] * 7, [0.0] * 8, [-0.0] * 8, [-1e-9] * 8, [1000.0] * 8]
    return made + [(3000 + k, v, None) for k, v in enumerate(odd)] + [(None, [0.5] * 8, 1)]


def test_against_plain_rounds(spark, data):
    table = spark.createDataFrame(data, SCHEMA).repartition(5)
    for parts, entries, rounds in ((4, 6, 2), (2, 16, 5), (8, 1, 2), (3, 5, 1), (4, 256, 0)):
        assert codes(table, parts=parts, entries=entries, rounds=rounds) == brute(data, parts, entries, rounds)


def test_bounds_spare_scans_and_stay_right():
    """Over several rounds most parts are not scanned, and none is wrong: bounds keep the stamps of earlier rounds."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (2, 10, 4))
    x = (centres[np.arange(2), rng.integers(0, 10, (2000, 1))] + rng.integers(-90, 90, (2000, 2, 4))).astype(np.int64)
    books = x[:10].swapaxes(0, 1).copy()
    history, state, scans = [books], (np.zeros((2000, 2), np.int64), np.full((2000, 2), -1.0), np.zeros((2000, 2), np.int64)), []
    for _ in range(9):
        distances, scanned = vector_codes.Bounds(np.stack(history)).assigned(x, *state)
        scans.append(scanned)
        every = ((x[:, :, None] - history[-1][None]) ** 2).sum(axis=3)
        assert (state[0] == every.argmin(axis=2)).all() and (distances == every.min(axis=2)).all()
        new = history[-1].copy()
        for part in range(2):
            for entry in range(10):
                if (mine := state[0][:, part] == entry).any():
                    new[part, entry] = x[mine, part].sum(axis=0) // mine.sum()
        history.append(new)
    assert scans[0] == 4000 and max(scans[3:]) < 2000 and len(set(state[2].ravel().tolist())) > 2


def test_displacement_is_that_of_the_sum_of_moves():
    there_and_back = np.array([[[[0], [50]]], [[[9], [50]]], [[[1], [50]]]])
    assert vector_codes.Bounds(there_and_back).moved[0, 0].tolist() == [0.0, 1.0]  # not 9 + 8


def test_far_values_are_held_and_do_not_crash(spark):
    data = [(1, [1e300, -1e300], 1), (2, [5.0, 1e30], 1), (3, [0.0, 0.0], 1), (4, [1e-300, -1e-300], 2)]
    found, _ = codes(spark.createDataFrame(data, SCHEMA), parts=2, entries=2)
    assert len(found) == 4 and found[0][2] >= 0
    assert all(row[3] is not None for row in found)


def test_empty_tables_and_clashing_columns(spark, data):
    assert codes(spark.createDataFrame([], SCHEMA))[0] == []
    assert codes(spark.createDataFrame([(1, None, 1)], SCHEMA))[0] == []
    assert codes(spark.createDataFrame([(1, [], None), (2, [], 1)], SCHEMA))[0] == [(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)]
    clashing = spark.createDataFrame(data, SCHEMA).withColumns({name: F.lit("clash") for name in ("vector", "codes", "error", "cells", "no_label", "stamps")})
    assert codes(clashing, parts=4, entries=6) == brute(data, 4, 6, 2)
    no_label = spark.createDataFrame(data, SCHEMA).withColumn("label", F.lit(None))
    assert codes(no_label, parts=4, entries=6) == brute([(i, v, None) for i, v, _ in data], 4, 6, 2)


def test_query_against_plain_rounds(spark):
    from guestbook.llm.queries import LLM_QUERIES

    data = [(row.vec_id, row.embedding, row.label) for row in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = LLM_QUERIES["op13_vector_codes"](spark, "/root/testdata/sf0.001")
    want, digest = brute(data, 16, 64, 2)
    assert rows(got) == [(*row, digest) for row in want]
