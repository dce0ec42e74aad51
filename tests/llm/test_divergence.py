import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import rows
from guestbook.llm import divergence
from llm.conftest import ODD
from pyspark.sql import functions as F

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(docs, min_docs, top=50):
    """The contract word for word, over (doc_id, text, lang, source, n_chars) rows."""
    docs = [(text or "", lang or "", source or "") for _, text, lang, source, _ in docs]
    in_docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = TERM.findall(text.translate(LOWER))
        in_docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = sorted(term for term, n in in_docs[lang].items() if n >= min_docs)
        groups = {source: held for (of, source), held in counts.items() if of == lang}
        whole = sum(groups.values(), Counter())

        def shares(held, kept=kept):
            total = sum(held[term] for term in kept) + 5 * len(kept)
            return {term: 1 + 10**9 * (held[term] + 5) // total for term in kept}

        q, p = shares(whole), {source: shares(held) for source, held in groups.items()}
        for source in groups:
            pairs = [(other, sum(abs(p[source][t] - p[other][t]) for t in kept)) for other in groups if other != source]
            terms = [(t, p[source][t] - q[t]) for t in kept if groups[source][t] > 0 and p[source][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda item: (-item[1], item[0].encode()))
                out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "aBéx漢ß" for b in ("", "q", "Zü", "ǹ", "k")] + ["\u0085", " x", "the"]
    made = [(i, rng.choice([" ", "\n", ", ", "1", "_"]).join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 30))), rng.choice(["en", "fr", None, "", "x y"]), rng.choice(["s", "t", "ß", None, "", "tie", "Tie"]), 1) for i in range(300)]
    made += [(1000 + i, text, "en", "odd", None) for i, text in enumerate(ODD)] + [(1, "the the", "en", "s", 1)] * 3
    return made + [(None, None, None, None, None), (2000, "rare", "solo", "one", 1), (2001, "", "none", "a", 1), (2002, "!", "none", "b", 1)]


def test_against_brute_force(spark, docs):
    table = spark.createDataFrame(docs, SCHEMA)
    for min_docs, top in ((5, 50), (12, 3), (1, 2), (10_000, 50)):
        assert rows(divergence.source_divergence(table, min_docs, top)) == brute(docs, min_docs, top)


def test_passes_flushes_shards_and_tiles_change_nothing(spark, docs, monkeypatch):
    table, want = spark.createDataFrame(docs, SCHEMA), brute(docs, 3)
    for name, value in (("SHARD_TERMS", 7), ("PASS_BYTES", 600), ("HELD_TERMS", 20), ("REMEMBERED", 5), ("DENSE_CELLS", 10), ("BLOCK_CELLS", 16), ("TILE_SOURCES", 2), ("ROWS_AT_ONCE", 9)):
        monkeypatch.setattr(divergence, name, value)
    assert rows(divergence.source_divergence(table, 3)) == want


def test_perfect_hash_gives_every_term_a_slot_and_knows_strangers():
    terms = [f"term{i}".encode() for i in range(5000)]
    sizes, bits, slots = divergence.perfect_hash(terms)
    assert sorted(slots.tolist()) == list(range(5000)) and bits.sum() == 5000 and len(sizes) < 24
    row = type("Row", (), {"n_shards": 1, "shard": 0, "sizes": sizes, "bits": __import__("numpy").packbits(bits).tobytes(), "terms": [t.decode() for _, t in sorted(zip(slots, terms))]})
    table = divergence.TermTable.of([row])
    assert table.slots(terms).tolist() == slots.tolist()
    assert set(table.slots([f"other{i}".encode() for i in range(5000)]).tolist()) == {-1}
    assert table.slots([]).tolist() == []


def test_empty_table_and_clashing_columns(spark, docs):
    assert rows(divergence.source_divergence(spark.createDataFrame([], SCHEMA))) == []
    clashing = spark.createDataFrame(docs, SCHEMA).withColumns({name: F.lit("clash") for name in ("slot", "n", "item", "term", "p", "n_kept", "block", "shard")})
    assert rows(divergence.source_divergence(clashing, 5)) == brute(docs, 5)


def test_query_against_brute_force(spark):
    from guestbook.llm.queries import LLM_QUERIES

    docs = [tuple(row) for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = rows(LLM_QUERIES["op11_source_divergence"](spark, "/root/testdata/sf0.001"))
    assert got == brute(docs, 30) and any(row[2] == "term" for row in got)
