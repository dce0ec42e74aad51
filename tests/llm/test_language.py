import zlib
from collections import Counter

import numpy as np
from conftest import SMALL, rows
from pyspark.sql import functions as F

from guestbook.llm import language
from llm.conftest import ODD

MEDIUM = SMALL.replace("0.001", "0.01")


def test_held_out_accuracy(spark):
    from __spark_entry__ import queries

    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = queries()["op6_language_id"](spark, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in got)
    apart = [row.lang == row.lang_pred for row in got if row.held_out]
    assert len(apart) > 100 and np.mean(apart) > 0.98
    assert all(0 <= row.score <= 1 for row in got)


def test_inputs_are_the_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = language.learn(docs)
    want = rows(language.predict(docs, learned).select("text", "lang_pred", "score"))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None), "doc_id": F.lit(1), "score": F.lit("clash")})
    assert rows(language.predict(other, learned).select("text", "lang_pred", "score")) == want


def test_odd_texts(spark, documents):
    learned = language.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = {row.doc_id: row for row in language.predict(documents(list(enumerate(ODD))), learned).collect()}
    for i, text in enumerate(ODD):
        has_letter = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == (not has_letter), text
        assert 0 <= got[i].score <= 1
    assert got[ODD.index("漢字 かな")].score < 0.1


def test_nothing_to_learn_from(documents, spark):
    none = documents([])
    assert language.language_of(none).count() == 0
    unlabelled = documents([(1, "some words", None, "s", 1), (None, None, None, None, None)])
    assert [row.lang_pred for row in language.language_of(unlabelled).collect()] == ["und", "und"]


def test_filter_has_no_false_negatives_and_counts_like_sets():
    random = np.random.default_rng(0)
    grams = {f"l{k}": random.integers(0, 2**63, 500, dtype=np.uint64) for k in range(11)}
    grams["l3"][:100] = grams["l0"][:100]
    held = language.LanguageFilter.of(grams)
    for k, name in enumerate(held.languages):
        hits = held.hits(grams[name])
        assert hits[k] == 500
        for j, other in enumerate(held.languages):
            shared = len(set(grams[name].tolist()) & set(grams[other].tolist()))
            assert shared <= hits[j] <= shared + 5


def test_long_texts_are_counted_whole(spark, monkeypatch):
    learned = language.learn(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang = 'fr'").head(20)
    text = " ".join(row.text for row in rows)
    whole = learned.predict(text)
    monkeypatch.setattr(language, "CHARS", 1000)
    parts = learned.predict(text)
    assert whole[0] == parts[0] == "fr" and abs(whole[1] - parts[1]) < 0.01


def test_marks_alone_are_no_letters(spark, documents):
    learned = language.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = language.predict(documents([(1, "́̂ ः"), (2, "é"), (3, "12 ́")]), learned).select("doc_id", "lang_pred", "score")
    found = {row.doc_id: row for row in got.collect()}
    assert (found[1].lang_pred, found[1].score, found[3].lang_pred) == ("und", 0.0, "und") and found[2].lang_pred != "und"


def test_counts_by_plain_sets(spark):
    """Grams of one text counted with sets of plain strings, against the filter's corrected shares."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = language.learn(docs)
    held = {}
    for lang in learned.languages:
        times = {n: Counter() for n in language.GRAMS}
        for row in docs.filter(docs.lang == lang).collect():
            for n in language.GRAMS:
                times[n].update(plain_grams(row.text, n))
        held[lang] = {gram for n, counts in times.items() for gram, k in counts.items() if k >= max(2, language.MIN_SHARE * counts.total())}
    for row in docs.limit(60).collect():
        grams = [gram for n in language.GRAMS for gram in plain_grams(row.text, n)]
        share = {lang: sum(gram in own for gram in grams) / len(grams) for lang, own in held.items()}
        lang, score = learned.predict(row.text)
        assert lang == max(sorted(share), key=share.get) and abs(score - share[lang]) < 0.02


def plain_grams(text, n):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    joined = " " + " ".join(words) + " "
    return [gram for gram in (joined[i : i + n] for i in range(len(joined) - n + 1)) if " " not in gram[1:-1] and gram.strip()]


def test_clashing_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clash = docs.withColumns({name: F.lit(name) for name in ("held_out", "lang_pred", "score", "gram", "times", "n")})
    assert rows(language.language_of(clash)) == rows(language.language_of(docs))
