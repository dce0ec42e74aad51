import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from guestbook.llm import mixing

SCHEMA = "doc_id long, source string, position string"


def by_source(spark, sizes):
    data, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            data.append((i, source, "clash"))
            i += 1
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def off_by(weights, rows, slots):
    """Blocks by which each source is farthest from its target share, over the slots up to its last block."""
    total, worst = sum(map(Fraction, weights)), []
    for w, n, mine in zip(weights, rows, slots):
        share, done = float(Fraction(w) / total), np.arange(1, n + 1)
        worst.append(max(np.abs(done - share * (mine + 1)).max(), np.abs(done - 1 - share * mine).max()))
    return worst


def test_less_than_one_block_off_at_every_slot():
    for seed in range(12):
        draw = random.Random(seed)
        weights = [draw.random() ** 3 for _ in range(draw.randint(1, 25))]
        rows = [draw.randint(1, 200) for _ in weights]
        whole = mixing.whole_weights(weights)
        assert [Fraction(w, sum(whole)) for w in whole] == [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
        slots = mixing.slots_of(whole, rows)
        assert len(set(np.concatenate(slots).tolist())) == sum(rows) and max(off_by(weights, rows, slots)) < 1 + 1e-9


@pytest.mark.parametrize("n_sources, n_rows", [(20, 30_000_000), (20_000, 500_000), (200, 1_000_000)])
def test_less_than_one_block_off_at_scale(n_sources, n_rows):
    """One source with a third of the rows, the others equal; square-root weights, as in the query."""
    rows = [n_rows // 3] + [2 * n_rows // (3 * (n_sources - 1))] * (n_sources - 1)
    weights = [n**0.5 for n in rows]
    schedule = mixing.Schedule.of(weights, rows)
    assert len(schedule.slots) <= mixing.MOST_BLOCKS + n_sources
    blocks = [-(-n // schedule.block_rows) for n in rows]
    slots = np.split(schedule.slots, np.cumsum(blocks)[:-1])
    assert max(off_by(weights, blocks, slots)) < 1 + 1e-6
    assert len(np.unique(schedule.slots)) == sum(blocks) and len(np.unique(schedule.starts)) == sum(blocks)


def walk(sizes, weights, block_rows):
    """(source, slot, block) of each row in order: at every slot, the released block with the first deadline."""
    out, slot = [], 0
    for positive in (True, False):
        live = {s: Fraction(weights.get(s) or 0) if positive else Fraction(1) for s in sizes if ((weights.get(s) or 0) > 0) == positive}
        live, start, done = {s: w / sum(live.values()) for s, w in live.items()}, slot, Counter()
        while any(done[s] * block_rows < sizes[s] for s in live):
            now = slot - start
            free = [
                (-(-(done[s] + 1) // w), s is None, s)
                for s, w in live.items()
                if done[s] * block_rows < sizes[s] and done[s] / w // 1 <= now
            ]
            if free:
                s = min(free, key=lambda x: (x[0], x[1], x[2] or ""))[2]
                out += [(s, slot, done[s])] * min(block_rows, sizes[s] - done[s] * block_rows)
                done[s] += 1
            slot += 1
        slot = out[-1][1] + 1 if out else 0
    return out


@pytest.mark.parametrize("block_rows", [1, 7])
@pytest.mark.parametrize("weights", [{"a": 0.2, "b": 0.5, "c": 0.3, None: 0.0}, {"a": 3, "b": -1, "c": 0.1, None: 1}, {}], ids=str)
def test_places_follow_a_plain_walk_over_the_slots(spark, block_rows, weights):
    sizes = {"a": 120, "b": 40, "c": 5, None: 12}
    got = mixing.mixed(by_source(spark, sizes), weights, block_rows).collect()
    assert [(row.source, row.slot, row.block) for row in sorted(got, key=lambda row: row.position)] == walk(sizes, weights, block_rows)
    assert sorted(row.position for row in got) == list(range(len(got)))
    assert len({row.doc_id for row in got}) == len(got)


def test_same_places_over_any_number_of_partitions(spark):
    docs = by_source(spark, {"hot": 300, "b": 20, "c": 1})
    want = rows(mixing.mixed(docs))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(mixing.mixed(docs.repartition(13))) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_repeats_and_empty(spark):
    data = [(None, None, None), (None, None, None), (1, "a", None), (1, "a", None), (2, None, "x")]
    got = mixing.mixed(spark.createDataFrame(data, SCHEMA))
    assert sorted(row.position for row in got.collect()) == [0, 1, 2, 3, 4]
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_more_sources_than_blocks_and_larger_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 4)
    sizes = {f"s{k}": k + 1 for k in range(9)}
    got = mixing.mixed(by_source(spark, sizes)).collect()
    assert [(row.source, row.slot, row.block) for row in sorted(got, key=lambda row: row.position)] == walk(sizes, {s: n**0.5 for s, n in sizes.items()}, 12)


def test_clashing_columns_pass_through(spark):
    names = ("_part", "_local", "_hash", "_row", "row", "tie", "drawn", "slot", "block")
    docs = by_source(spark, {"a": 30, "b": 9})
    got = mixing.mixed(docs.withColumns({name: F.lit(name) for name in names}))
    assert got.columns == ["doc_id", "source", *names[:-2], "block", "slot", "position"]
    assert rows(got.select("doc_id", "source", "slot", "position")) == rows(mixing.mixed(docs).select("doc_id", "source", "slot", "position"))
    assert rows(got.select(*names[:-2]).distinct()) == [names[:-2]]


def test_files_keep_the_order(spark, tmp_path):
    mixing.in_order(mixing.mixed(by_source(spark, {"a": 50, "b": 9}))).write.parquet(str(tmp_path / "m"))
    placed = spark.read.parquet(str(tmp_path / "m")).selectExpr("position", "_metadata.file_name as f", "_metadata.row_index as r")
    assert [row.position for row in sorted(placed.collect(), key=lambda row: (row.f, row.r))] == list(range(59))


def test_query_places_every_document(spark):
    from __spark_entry__ import queries

    got = queries()["op5_source_mix"](spark, SMALL).collect()
    assert sorted(row.position for row in got) == list(range(200))
    assert len({row.doc_id for row in got}) == 200


def test_rounds_place_every_block_as_one_schedule_does(monkeypatch):
    """However the schedule is cut, also where sources are used up, slots stay empty or sources have no weight."""
    for seed in range(60):
        draw = random.Random(seed)
        weights = [draw.choice([draw.random() ** 3, draw.randint(1, 5), 1e-4, 0, None]) for _ in range(draw.randint(1, 25))]
        blocks = [draw.randint(1, 200) for _ in weights]
        whole = mixing.whole_weights(weights)
        first = mixing.slots_of(whole, [n if w else 0 for w, n in zip(whole, blocks)])
        last = max((int(some[-1]) for some in first if len(some)), default=-1)
        rest = mixing.slots_of([1 - bool(w) for w in whole], [0 if w else n for w, n in zip(whole, blocks)], last + 1)
        want = np.concatenate([some if w else later for w, some, later in zip(whole, first, rest)])
        monkeypatch.setattr(mixing, "LEAST_IN_ROUND", draw.choice([1, 7, 40, 1000]))
        monkeypatch.setattr(mixing, "IN_ROUND_OF_SOURCE", 0)
        schedule = mixing.Schedule.of(weights, blocks, 1)
        assert np.array_equal(schedule.slots, want)
        assert np.array_equal(schedule.starts[np.argsort(want)], np.arange(sum(blocks)))


@pytest.mark.parametrize("block_rows", [1, 2])
def test_blocks_that_are_asked_for_hold_over_any_number_of_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 4)
    sizes = {f"s{k}": k + 1 for k in range(9)}
    got = mixing.mixed(by_source(spark, sizes), None, block_rows).collect()
    assert [(row.source, row.slot, row.block) for row in sorted(got, key=lambda row: row.position)] == walk(sizes, {s: n**0.5 for s, n in sizes.items()}, block_rows)


def test_query_and_stage_do_not_depend_on_the_most_blocks(spark, monkeypatch):
    import corpus_pipeline
    from __spark_entry__ import queries

    def results():
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        staged = [row.doc_id for row in dict(corpus_pipeline.STAGES)["mixing"](spark, docs, SMALL).select("doc_id").collect()]
        return rows(queries()["op5_source_mix"](spark, SMALL)), staged

    want = results()
    assert len(want[1]) == 200
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 4)
    assert results() == want


def test_rows_come_in_the_order_of_the_schedule(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_IN_ROUND", 8)
    monkeypatch.setattr(mixing, "IN_ROUND_OF_SOURCE", 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = mixing.mixed(by_source(spark, {"a": 300, "b": 40, None: 9}))
        assert got.rdd.getNumPartitions() > 1
        assert [row.position for row in got.collect()] == list(range(349))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
