import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.llm import multi_index
from llm.conftest import roots

SCHEMA = "vec_id long, embedding array<float>, label int"
DOUBLES = SCHEMA.replace("float", "double")


def vectors(n=600, dim=16, seed=1):
    random = np.random.default_rng(seed)
    base = random.standard_normal((n, dim))
    for i in range(0, n, 3):  # groups of near copies at all distances around the threshold
        base[i] = base[i % 60] + random.standard_normal(dim) * random.uniform(0, 0.45)
    return [[float(np.float32(x)) for x in row] for row in base]


def expected(data, threshold=0.95):
    points = np.array([row[1] for row in data], np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    linked = points @ points.T >= threshold
    np.fill_diagonal(linked, False)
    ids = [row[0] for row in data]
    root = roots(len(data), zip(*np.nonzero(linked)))
    return sorted(((i, int(n), ids[r], i == ids[r]) for i, n, r in zip(ids, linked.sum(1), root)), key=repr)


def test_exact_when_all_cells_are_visited(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 100)
    data = [(i, v, 0) for i, v in enumerate(vectors())]
    assert rows(multi_index.near_vectors(spark.createDataFrame(data, SCHEMA), recall=1.0)) == expected(data)


def sets_of_vectors(kind, n, seed=5):
    """Vectors of rank 3 in 24 components, in clusters, or with few components that are not zero; near copies of some."""
    random = np.random.default_rng(seed)
    if kind == "rank 3":
        base = random.standard_normal((n, 3)) @ random.standard_normal((3, 24))
    elif kind == "clusters":
        base = random.standard_normal((12, 24))[random.integers(0, 12, n)] + 0.12 * random.standard_normal((n, 24))
    else:
        base = random.standard_normal((n, 24)) * (random.random((n, 24)) < 0.15)
        base[:, 0] += 0.01
    copies = random.integers(0, n, n // 4)
    base[: len(copies)] = base[copies] * random.uniform(0.5, 2, (len(copies), 1)) + 0.02 * base[random.permutation(n)[: len(copies)]]
    return base


@pytest.mark.parametrize("kind", ["rank 3", "clusters", "sparse"])
def test_recall_off_isotropic_data(spark, kind):
    """With the codebooks of a million vectors, of which the sample has few."""
    points = multi_index.units(sets_of_vectors(kind, 3000))
    linked = points @ points.T >= 0.95
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    for recall, least in ((multi_index.TARGET_RECALL, 0.99), (1.0, 1.0)):
        index = multi_index.MultiIndex.of(points[::3], 1_000_000, 0.95, recall)
        visited = index._beyond(points[a], points[b]) <= index.bound
        back = index._beyond(points[b], points[a]) <= index.bound
        assert len(a) > 500 and np.mean(visited | back) >= least
    data = [(i, [float(x) for x in row], 0) for i, row in enumerate(points[:600])]
    got, want = rows(multi_index.near_vectors(spark.createDataFrame(data, DOUBLES), recall=1.0)), expected(data)
    assert got == want


def test_lengths_out_of_range(spark):
    data = [(1, [1e200, 1e200], 0), (2, [2e200, 2e200], 0), (3, [1e-200, 0.0], 0), (4, [2e-200, 0.0], 0), (5, [1e-310, 0.0], 0)]
    got = multi_index.near_vectors(spark.createDataFrame(data, DOUBLES)).collect()
    assert {row.vec_id: row.component_id for row in got} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}


def test_clashing_columns(spark):
    data = [(i, v, 0) for i, v in enumerate(vectors(60))]
    table = spark.createDataFrame(data, SCHEMA)
    clash = table.withColumns({name: F.lit(name) for name in ("vector", "cid", "n", "u", "v", "shard", "home", "copies", "kept", "n_links")})
    assert rows(multi_index.near_vectors(clash)) == rows(multi_index.near_vectors(table))


def test_recall_and_no_link_below_the_threshold(spark):
    data = [(i, v, 0) for i, v in enumerate(vectors(900, 32, 2))]
    got, want = rows(multi_index.near_vectors(spark.createDataFrame(data, SCHEMA))), expected(data)
    assert all(a[1] <= b[1] for a, b in zip(got, want))
    assert sum(row[1] for row in got) >= 0.99 * sum(row[1] for row in want)


def test_odd_vectors_and_copies(spark):
    one, two = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    nan, inf = float("nan"), float("inf")
    data = [(1, one, 0), (2, one, 1), (3, [2.0, 0.0, 0.0, 0.0], 0), (4, two, 0), (5, None, 0), (6, [0.0] * 4, 0), (7, [1.0, None, 0.0, 0.0], 0)]
    data += [(8, [nan, 0.0, 0.0, 0.0], 0), (9, [inf, 0.0, 0.0, 0.0], 0), (10, [], 0), (11, [1.0, 0.0], 0), (None, two, 0), (4, two, 0)]
    got = rows(multi_index.near_vectors(spark.createDataFrame(data, SCHEMA)))
    linked = [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False)]
    assert got == sorted(linked + [(i, 0, i, True) for i in range(5, 12)], key=repr)


def test_empty_table_and_only_odd_vectors(spark):
    assert multi_index.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows(multi_index.near_vectors(spark.createDataFrame([(1, [0.0], 0)], SCHEMA))) == [(1, 0, 1, True)]


def test_every_cell_in_the_staircase_is_visited():
    points = multi_index.units(np.array(vectors(400, 16, 3)))
    index = multi_index.MultiIndex.of(points, 40_000, 0.95, 0.999)
    cells, outside = index.cells(points), index.outside(points)
    every = np.arange(len(points))
    assert (outside[0][every, cells[:, 0]] == 0).all() and (outside[1][every, cells[:, 1]] == 0).all()


def test_query_keeps_every_vector(spark):
    from conftest import SMALL

    from __spark_entry__ import queries

    held = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    data = [(row.vec_id, row.embedding, 0) for row in held.collect()]
    assert rows(queries()["op1_multi_index"](spark, SMALL)) == expected(data)


def test_vectors_of_every_length_link(spark):
    data = [(i, [1.0, float(i % 2), 0.5]) for i in range(6)] + [(10, [0.0, 1.0]), (11, [0.0, 2.0]), (12, [1.0, 0.0]), (20, [3.0]), (21, [4.0]), (22, [-1.0])]
    got = multi_index.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    found = {row.vec_id: (row.n_links, row.component_id) for row in got.collect()}
    assert found == {i: (2, i % 2) for i in range(6)} | {10: (1, 10), 11: (1, 10), 12: (0, 12), 20: (1, 20), 21: (1, 20), 22: (0, 22)}
