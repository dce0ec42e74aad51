import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.llm import ordered
from guestbook.llm.lines import line_table, suffix_ranks, without_repeated_lines
from llm.conftest import ODD


def expected(pairs, min_words):
    """By the rule as it is stated: any repeated run with enough words, every occurrence but the earliest."""
    docs = sorted({(i is None, i or 0, t or "") for i, t in pairs})
    held = {}
    for key in docs:
        lines = key[2].split("\n")
        full = [k for k, line in enumerate(lines) if line.strip(" \t\n\r\v\f")]
        held[key] = (lines, full, [lines[k].strip(" \t\n\r\v\f") for k in full])
    # The order among rows of one doc_id is a hash of the text; no test has repeats across those.
    first, gone = {}, {key: set() for key in docs}
    for key in docs:
        bare = held[key][2]
        for a in range(len(bare)):
            for b in range(a + 1, len(bare) + 1):
                run = tuple(bare[a:b])
                if sum(len(line.split()) for line in run) >= min_words and first.setdefault(run, (key, a)) != (key, a):
                    gone[key].update(range(a, b))
    out = []
    for i, t in pairs:
        lines, full, _ = held[i is None, i or 0, t or ""]
        removed = gone[i is None, i or 0, t or ""]
        drop = {full[k] for k in removed}
        left = "\n".join(line for k, line in enumerate(lines) if k not in drop) if len(removed) < len(full) else ""
        out.append((i, left, len(full), len(removed), len(removed) < len(full)))
    return sorted(out, key=repr)


def found(documents, pairs, min_words):
    return rows(without_repeated_lines(documents(pairs), min_words).select("doc_id", "text", "n_lines", "n_removed", "kept"))


@pytest.mark.parametrize("min_words", [1, 2, 3, 5, 7])
def test_equal_to_brute_force(documents, min_words):
    random.seed(min_words)
    lines = ["a", "b", "c", "", "two words", "three words here", " a", "a\r", "one line of five words"]
    pairs = [(i, "\n".join(random.choice(lines) for _ in range(random.randint(0, 9)))) for i in range(60)]
    pairs += [(None, "a\nb\nunheard of line"), (70, "a\n" * 30), (71, "b\n" * 30 + "b")]
    assert found(documents, pairs, min_words) == expected(pairs, min_words)


def test_odd_texts_repeated_rows_and_clashing_columns(documents):
    pairs = [(i, text) for i, text in enumerate(ODD)] + [(50, "a line that comes twice"), (50, "a line that comes twice"), (51, "a line that comes twice\nx")]
    assert found(documents, pairs, 4) == expected(pairs, 4)
    clashing = documents(pairs).withColumns({n: F.lit(n) for n in ("doc", "version", "pos", "len", "rank", "kept", "d1", "_part")})
    got = without_repeated_lines(clashing, 4)
    assert rows(got.select("doc_id", "text", "n_lines", "n_removed", "kept")) == expected(pairs, 4)
    assert got.select("pos").distinct().collect()[0][0] == "pos"


def test_empty_table(documents):
    assert without_repeated_lines(documents([])).count() == 0


def test_ranks_order_the_runs(documents, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = [(i, "\n".join("abab"[: i % 5])) for i in range(40)]
        ranks = suffix_ranks(line_table(documents(pairs), 4), 4)
        assert sorted(ranks) == [1, 2, 4]
        for length, table in ranks.items():
            runs = {}
            for row in table.collect():
                text = pairs[row.doc][1].split("\n")
                runs.setdefault(row.rank, set()).add(tuple(text[row.pos : row.pos + length]))
            assert all(len(same) == 1 for same in runs.values())
            assert table.filter("first").count() == len(runs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_over_partition_borders(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(k, i) for k in (1, 5, 5, 9) for i in range(50)] + [(7, 1), (8, 2), (8, 3)]
        got = ordered.ranked(spark.createDataFrame(data, "k long, i long"), ["k"], ["i"], "t").collect()
        assert len(got) == 50 * 3 + 3  # of equal rows one is kept
        assert len({(row.k, row.rank) for row in got}) == 5 and len({row.rank for row in got}) == 5
        assert [row.k for row in sorted(got, key=lambda r: (r.rank, r.i))] == sorted(row.k for row in got)
        assert {(row.k, row.i) for row in got if row.first} == {(1, 0), (5, 0), (9, 0), (7, 1), (8, 2)}
        assert {row.k for row in got if row.alone} == {7}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
