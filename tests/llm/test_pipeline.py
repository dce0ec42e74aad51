import public_tokenizers
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import check
import corpus_pipeline
from guestbook.llm import byte_bpe, language, simhash
from llm.conftest import ODD
from llm.test_lines import expected as lines_expected


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near-duplicates", "mixing", "tokens"]


def test_language_keeps_clean_documents(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = documents([(10_000 + i, text) for i, text in enumerate(ODD)])
    kept = stage("language")(spark, docs.unionByName(odd), SMALL)
    assert kept.columns == docs.columns
    assert rows(kept.filter("doc_id < 10000")) == rows(docs)
    left = {row.text for row in kept.filter("doc_id >= 10000").collect()}
    assert not left & {"", None, " ", "\n\n", "\t \r\n", "😀", "漢字 かな"}


def test_lines_stage_by_brute_force(spark, documents):
    docs = documents([(i, "\n".join(["a common line here", f"own {i % 9} words {i % 9}", "x"][: i % 4])) for i in range(40)])
    want = [(i, text, len(text)) for i, text, _, _, kept in lines_expected([(r.doc_id, r.text) for r in docs.collect()], 4) if kept]
    got = stage("lines")(spark, docs, SMALL)
    assert got.columns == docs.columns and rows(got.select("doc_id", "text", "n_chars")) == sorted(want, key=repr)


def test_lines_stage_takes_scripts_without_spaces(spark, documents):
    long, halves, short = "本網站使用餅乾以改善您的瀏覽體驗並分析流量請點此同意", ["使用者條款與隱私權政策聲明", "版權所有未經許可不得轉載"], "點此同意"
    pairs = [(1, "\n".join([long, "甲", *halves, short])), (2, "\n".join(["乙", long, "丙", *halves, "丁", short]))]
    got = rows(stage("lines")(spark, documents(pairs), SMALL).select("doc_id", "text"))
    assert got == [(1, pairs[0][1]), (2, "\n".join(["乙", "丙", "丁", short]))]


def test_near_duplicates_stage_keeps_one_row_of_each_group(spark, documents):
    one, two, three = ("some words that come first " * 9, "quite other words here " * 9, "a third text with nothing shared " * 9)
    repeated = [(7, one)] * 1000
    clashing = [(8, two), (8, three)]
    kept = rows(stage("near-duplicates")(spark, documents(repeated + clashing), SMALL).select("doc_id", "text"))
    assert kept == sorted([(7, one), (8, two), (8, three)], key=repr)
    # Of two texts under one id, the one in a group with a smaller id goes.
    kept = rows(stage("near-duplicates")(spark, documents([(1, one), (8, one), (8, two), (9, two)]), SMALL).select("doc_id", "text"))
    assert kept == sorted([(1, one), (8, two)], key=repr)
    # Null ids: one row stays of a group without ids, none of a group that has an id.
    kept = rows(stage("near-duplicates")(spark, documents([(None, one), (None, one), (None, two), (3, two)]), SMALL).select("doc_id", "text"))
    assert kept == sorted([(None, one), (3, two)], key=repr)


def test_mixing_stage_keeps_all_rows_in_the_order_of_the_schedule(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage("mixing")(spark, docs, SMALL).write.parquet(str(tmp_path / "m"))
    mixed = spark.read.parquet(str(tmp_path / "m"))
    assert rows(mixed) == rows(docs)
    last = stage("tokens")(spark, mixed, SMALL).select("part", "row", "doc_id").collect()
    order = [row.doc_id for row in sorted(last)]
    placed = corpus_pipeline.mixing.mixed(docs).select("position", "doc_id").collect()
    assert order == [row.doc_id for row in sorted(placed)]


@pytest.mark.parametrize("name", ["language", "lines", "near-duplicates", "mixing", "tokens"])
def test_stages_take_empty_tables_and_odd_rows(spark, documents, name):
    assert stage(name)(spark, documents([]), SMALL).count() == 0
    odd = documents([(None, None, None, None, None), *enumerate(ODD), (3, ODD[3]), (3, "other")])
    assert stage(name)(spark, odd, SMALL).count() >= 0


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SMALL).drop("part", "row")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = step(spark, docs, SMALL)
    texts = {row.doc_id: row.text for row in docs.collect()}
    found = got.collect()
    assert sorted(row.doc_id for row in found) == sorted(texts)
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)[0]
    assert all(bpe.decode(row.token_ids).decode() == texts[row.doc_id] for row in found)
    assert language.UNKNOWN == "und" and simhash.RADIUS == 4


@pytest.mark.parametrize("name", ["language", "lines", "near-duplicates", "mixing"])
def test_stages_pass_clashing_columns_through(spark, documents, name):
    names = ("doc", "version", "_runs", "row", "_key", "_part", "_local", "lang_pred_", "component", "key")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = stage(name)(spark, docs.withColumns({x: F.lit(x) for x in names}), SMALL)
    assert got.columns == [*docs.columns, *names]
    assert rows(got.select(*docs.columns)) == rows(stage(name)(spark, docs, SMALL))
    assert [tuple(row) for row in got.select(*names).distinct().collect()] == [names]


@pytest.mark.parametrize("name", ["op1_multi_index", "op2_exact_dedup", "op7_line_dedup", "op11_source_divergence", "op13_vector_codes"])
def test_query_equals_sql(spark, database, name):
    assert check.difference(spark, database, SMALL, name) is None
