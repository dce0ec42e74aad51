import math
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.functions import labels, text
from guestbook.operators import sentiment, summary
from guestbook.schema import Columns

C = Columns(key=("id",))
LEXICON = [("good", 2.0), ("bad", -2.0), ("great", 3.0), (":)", 1.0)]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, valence double")


def reviews(spark, *pairs):
    data = [("h", i, p, n) for i, (p, n) in enumerate(pairs)]
    return spark.createDataFrame(data, "Hotel_Name string, id int, Positive_Review string, Negative_Review string")


def evaluate(spark, values, function):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


# Text and what is left of it.
PLAIN = [
    ("Visit http://x.y/z now www.a.b <b>Bold</b> it's 5 o'clock!", "visit  now  bold its  oclock"),
    ("No Negative", ""),
    ("no positive", ""),
    (None, ""),
    ("", ""),
    ("Caffè naïve ½ ² 日本 ٣", "caffè naïve ½ ² 日本 "),
    ("a < b\n c > d", "a  b\n c  d"),
    ("under_score nbsp em", "under_score nbsp em"),
    ("https", ""),
    ("<a><b>x>", "x"),
    ("tab\tand\x0bvt\x1cfs", "tab\tand\x0bvt\x1cfs"),
]


def test_plain_text(spark):
    assert evaluate(spark, [given for given, _ in PLAIN], text.plain_text) == [left for _, left in PLAIN]


def test_words_and_strip_follow_unicode_space(spark):
    values = [x or "" for x, _ in PLAIN] + ["  padded  ", "\x1cz\x85"]
    assert evaluate(spark, values, text.stripped) == [x.strip() for x in values]
    assert evaluate(spark, values, lambda x: text.kept_words(x)) == [x.split() for x in values]


def test_bare_words(spark):
    values = ["good,", "(bad)", ":)", "it's", "!!!", ""]
    assert evaluate(spark, values, text.bare_word) == ["good", "bad", ":)", "it's", "!!!", ""]


# Answer and what is left of it.
REASONED = [
    ("plain", "plain"),
    ("<think>a\nb</think>answer", "answer"),
    ("x<think></think>y", "xy"),
    ("<think>a</think>b<think>a</think>c<think>d</think>", "bc<think>d</think>"),
    ("<think>open", "<think>open"),
    ("close</think>", "close</think>"),
    ("<think>a<think>b</think>c", "<think>a<think>b</think>c"),
    ("", ""),
    (None, None),
]


def test_reasoning_block(spark):
    assert evaluate(spark, [given for given, _ in REASONED], text.without_reasoning) == [left for _, left in REASONED]


def test_valences(spark, lexicon):
    df = reviews(spark, ("Good, GREAT food", "bad"), ("", None), ("table :)", "good bad"))
    for max_bytes in (1 << 20, 0):
        got = sentiment.review_valences(
            df, ["id"], {"p": "Positive_Review", "n": "Negative_Review"}, lexicon, max_bytes=max_bytes
        )
        assert rows(got) == [(0, 5.0, -2.0), (1, 0.0, 0.0), (2, 1.0, 0.0)]


def test_negations_and_boosters(spark, lexicon):
    rules = {"negations": ["not"], "boosters": {"very": 0.293, "slightly": -0.293, "pretty": 0.293}}
    lexicon = spark.createDataFrame([*LEXICON, ("pretty", 1.0)], "word string, valence double")
    df = reviews(
        spark, ("very good", ""), ("slightly bad", ""), ("not good", ""), ("not very good", ""), ("not a b c good", ""),
        ("very x y good", ""), ("good", "very"), ("Not, VERY good!", ""), ("very not good", ""), ("pretty good", ""),
        ("pretty", ""), ("very bad not bad", ""),
    )
    got = sentiment.review_valences(df, ["id"], {"p": "Positive_Review"}, lexicon, **rules)
    expected = [2.293, -1.707, -1.48, 2.293 * -0.74, 2.0, 2 + 0.293 * 0.9, 2.0, 2.293 * -0.74]
    expected += [2 * -0.74 - 0.293 * 0.95]  # the intensifier takes the sign that the negation has left
    expected += [2.0, 0.0]  # a word of the lexicon is no modifier, an intensifier has no valence
    expected += [-2.293 + (2 * 0.74 + 0.293 * 0.9)]  # "very" is three words before the second "bad", by then turned
    assert [r.p for r in got.orderBy("id").collect()] == pytest.approx(expected)


def test_compound(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (-50.0,)], "s double")
    got = [r[0] for r in df.select(labels.compound(F.col("s"))).collect()]
    assert got == [0.0, 2 / math.sqrt(19), -50 / math.sqrt(2515)]


def test_seasonal_and_yearly(spark, lexicon):
    date = F.when(F.col("id") < 2, F.lit("2017-01-05").cast("date"))
    df = reviews(spark, ("good", "No Negative"), ("bad", ""), ("great", "")).withColumns(
        {"Hotel_Address": F.lit("x"), "Reviewer_Score": F.col("id") * 2.0, "Review_Date": date}
    )
    seasonal = sentiment.seasonal_sentiment(df, lexicon, C)
    assert rows(seasonal.select("Season", "avg_reviewer_score", "review_count")) == [("Winter", 1.0, 2), (None, 4.0, 1)]
    year = sentiment.yearly_sentiment(seasonal).first()
    assert year.year_sentiment == pytest.approx(3 / math.sqrt(24) / 2) and year.year_score == 2.5
    assert year.label == "Neutrale"


def test_published_rules_are_the_default(spark, lexicon):
    df = reviews(spark, ("not good", ""), ("very good", ""), ("good", "")).withColumns(
        {"Hotel_Address": F.col("id").cast("string"), "Reviewer_Score": F.lit(5.0), "Review_Date": F.lit("2017-01-05").cast("date")}
    )
    ruled = [r.avg_sentiment for r in sentiment.seasonal_sentiment(df, lexicon, C).orderBy("Hotel_Address").collect()]
    assert ruled[0] < 0 < ruled[2] < ruled[1]
    plain = sentiment.seasonal_sentiment(df, lexicon, C, negations=(), boosters={}).collect()
    assert len({r.avg_sentiment for r in plain}) == 1


def test_year_label(spark):
    df = spark.createDataFrame([(0.4,), (0.39,), (0.0,), (-0.01,)], "x double")
    assert [r[0] for r in df.select(labels.year_label(F.col("x"))).collect()] == ["Positivo", "Neutrale", "Neutrale", "Negativo"]


# Positive text, negative text, class: a strong word on one side decides, then the only side with a text, then the
# mean of both classes weighted by length. The comments give the weighted means.
JUDGED = [
    ("good", "bad", 0),  # 1/7
    ("good", "No Negative", 1),
    ("No Positive", "bad", -1),
    ("No Positive", "Nothing", 0),
    ("", "", 0),
    ("  ", "none", 0),
    ("all was good", "bad", 1),
    ("good", "everything bad", -1),
    ("all good", "always bad", 0),  # -2/18
    ("overall good", "bad", 1),  # 9/15
    ("great great great food", "bad", 1),  # 19/25
    ("good", "a long text that says bad", -1),  # -21/29
    ("good bad", "x", 0),
    ("good room", "plain words", 1),  # 9/20
    ("good\nall", "bad", 1),
    (" Good ", "BAD ", 0),
    ("allgood", "x all", -1),
    ("good view", "noisy room at night", 1),  # 9/28
]
PAIRS = [pair[:2] for pair in JUDGED]
CLASSES = [pair[2] for pair in JUDGED]


def test_review_rule(spark, lexicon):
    got = sentiment.review_sentiment(reviews(spark, *PAIRS), lexicon, c=C).orderBy("id").collect()
    assert [r.sentiment_value for r in got] == CLASSES
    names = {1: "positive", 0: "neutral", -1: "negative"}
    assert [r.sentiment for r in got] == [names[value] for value in CLASSES]


def valence_model(log):
    """A loader that notes its calls, of a model that knows the lexicon and notes the texts it is sent."""
    valences = dict(LEXICON)

    def load():
        with open(log, "a") as file:
            file.write("load\n")

        def score(batch):
            with open(log, "a") as file:
                file.writelines(f"text {x!r}\n" for x in batch)
            totals = batch.map(lambda x: sum(valences.get(word, 0.0) for word in x.split()))
            return (totals > 0.2).astype("int32") - (totals < -0.2).astype("int32")

        return score

    return load


def test_model_hook(spark, tmp_path):
    df = sentiment.model_sentiment(reviews(spark, *PAIRS), valence_model(tmp_path / "log"), c=C).orderBy("id")
    assert [r.sentiment_value for r in df.collect()] == CLASSES


def test_model_sees_each_needed_text_once(spark, tmp_path):
    pairs = [("all was good", "bad"), ("good", "No Negative"), ("No Positive", "Nothing"), ("good", "bad"), ("fine", "")]
    got = sentiment.model_sentiment(reviews(spark, *pairs).coalesce(1), valence_model(tmp_path / "log"), c=C)
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert rows(got.select("id", "sentiment_value")) == [(0, 1), (1, 1), (2, 0), (3, 0), (4, 0)]
    noted = (tmp_path / "log").read_text().splitlines()
    assert noted.count("load") == 1
    assert sorted(x for x in noted if x != "load") == ["text 'bad'", "text 'fine'", "text 'good'", "text 'good'"]


def test_classes_of_lemmas_without_stop_words(spark, tmp_path):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "word string, valence double")
    lemmas = spark.createDataFrame([("goods", "good"), ("worse", "bad")], "form string, lemma string")
    df = reviews(spark, ("The goods", ""), ("the", "Worse!"), ("good bad", ""), (None, "the"))
    for max_bytes in (1 << 20, 0):
        more = {"stop_words": ["the", "bad"], "lemmas": lemmas, "max_bytes": max_bytes}
        got = sentiment.review_sentiment(df, lexicon, c=C, **more)
        assert rows(got.select("id", "sentiment_value")) == [(0, 1), (1, -1), (2, 1), (3, 0)]
        got = sentiment.model_sentiment(df, valence_model(tmp_path / "log"), c=C, **more)
        assert rows(got.select("id", "sentiment_value")) == [(0, 1), (1, -1), (2, 1), (3, 0)]


def test_null_texts_are_empty(spark, lexicon):
    got = sentiment.review_sentiment(reviews(spark, (None, "bad"), (None, None)), lexicon, c=C).orderBy("id").collect()
    assert [r.sentiment_value for r in got] == [-1, 0]


def test_entity_labels(spark):
    cases = {
        0.2: "Neutrale", 0.21: "Piuttosto Positivo", 0.4: "Molto Positivo", -0.2: "Neutrale", -0.25: "Piuttosto Negativo",
        -0.3: "Neutrale", -0.35: "Neutrale", -0.4: "Molto Negativo", None: "Nessuna recensione",
    }
    df = spark.createDataFrame([(x,) for x in cases], "m double")
    assert [r[0] for r in df.select(labels.entity_label(F.col("m"))).collect()] == list(cases.values())


def test_entity_sentiment(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", -1)], "Hotel_Name string, sentiment_value int")
    assert rows(sentiment.entity_sentiment(df)) == [("a", 0.5, "Molto Positivo"), ("b", -1.0, "Molto Negativo")]
    assert rows(sentiment.label_of_entity(df, "b")) == [("b", "Molto Negativo")]
    assert rows(sentiment.label_of_entity(df, "nobody")) == [("nobody", "Nessuna recensione")]


def test_normalised_texts(spark):
    df = reviews(spark, ("The Rooms, the rooms were 2 nice!", ""), ("No Positive", ""), ("the", ""))
    lemmas = spark.createDataFrame([("rooms", "room"), ("were", "be")], "form string, lemma string")
    for max_bytes in (1 << 20, 0):
        got = sentiment.normalised_texts(df, "Positive_Review", ["the"], lemmas, C, max_bytes)
        assert rows(got) == [(0, "room room be nice"), (1, ""), (2, "")]
    assert rows(sentiment.normalised_texts(df, "Positive_Review", ["the"], c=C))[0] == (0, "rooms rooms were nice")


def test_summary_corpus(spark):
    df = reviews(spark, ("p0", "n0"), ("p1", "No Negative"), ("p2", "n2"), ("p3", "n3")).withColumn(
        "Total_Number_of_Reviews_Reviewer_Has_Given", F.lit(10) - F.col("id")
    )
    picked = summary.summary_reviews(df, 2, C)
    assert rows(picked.select("id", "place")) == [(2, 2), (3, 1)]
    assert rows(summary.corpus(picked, C)) == [("h", "p3 ; n3. p2 ; n2. ")]


def test_extractive_summary(spark):
    df = reviews(spark, ("the room. the pool is a dream!", "the room"), ("the room", "the room. 123")).withColumn(
        "Total_Number_of_Reviews_Reviewer_Has_Given", F.col("id")
    )
    assert rows(summary.extractive_summary(df, 1, c=C)) == [("h", "the pool is a dream")]


def test_summaries_keep_the_entity_without_a_name(spark):
    df = reviews(spark, ("the room. the pool is a dream!", "the room")).withColumns(
        {"Hotel_Name": F.lit(None).cast("string"), "Total_Number_of_Reviews_Reviewer_Has_Given": F.col("id")}
    )
    assert rows(summary.extractive_summary(df, 1, c=C)) == [(None, "the pool is a dream")]


def test_model_summary(spark):
    df = spark.createDataFrame([("text",)], "corpus string")
    answered = df.select(summary.model_summary(F.col("corpus"), lambda: lambda batch: "<think>x</think>" + batch))
    assert answered.first()[0] == "text"


ENTRIES = [("the bomb", 3.0), ("the bomb squad", -1.0), ("squad good", 5.0), ("Kiss of death", -1.5), ("not  good", -4.0)]
# Text, and its sum by plain words, with phrases, with "but", with emphasis, and with all of them and two rules.
COUNTED = [
    ("good bad", 0.0, 0.0, 0.0, 0.0, 0.0),
    ("the bomb", 0.0, 3.0, 0.0, 0.0, 3.0),
    ("This is The Bomb squad good!", 2.0, 1.0, 2.0, 2.292, 1.292),  # the longest phrase takes "squad", "good" counts alone
    ("the bomb. The bomb, squad", 0.0, 2.0, 0.0, 0.0, 2.0),
    ("kiss of death, kiss of", 0.0, -1.5, 0.0, 0.0, -1.5),
    ("good but bad", 0.0, 0.0, -2.0, 0.0, -2.0),
    ("good. But, good but great!", 7.0, 7.0, 8.5, 7.292, 8.792),  # only the first contrast word parts the text
    ("but", 0.0, 0.0, 0.0, 0.0, 0.0),
    ("GOOD but bad!!", 0.0, 0.0, -2.0, 1.317, -2.2175),
    ("good?? really???", 2.0, 2.0, 2.0, 2.96, 2.96),
    ("good??", 2.0, 2.0, 2.0, 2.36, 2.36),
    ("bad!!!!!!", -2.0, -2.0, -2.0, -3.168, -3.168),
    ("GREAT GOOD", 5.0, 5.0, 5.0, 5.0, 5.0),  # nothing but capitals is no emphasis
    ("BAD food", -2.0, -2.0, -2.0, -2.733, -2.733),
    ("not the bomb", 0.0, 3.0, 0.0, 0.0, -2.22),
    ("not good", 2.0, -4.0, 2.0, 2.0, -4.0),
    ("very GOOD food", 2.0, 2.0, 2.0, 2.733, 3.026),
    ("", 0.0, 0.0, 0.0, 0.0, 0.0),
    (None, 0.0, 0.0, 0.0, 0.0, 0.0),
]


@pytest.mark.parametrize("max_bytes", [0, 1 << 25])
def test_phrases_contrast_and_emphasis(spark, lexicon, max_bytes):
    texts = spark.createDataFrame([(i, row[0]) for i, row in enumerate(COUNTED)], "id int, t string")
    every, phrases = sentiment.split_lexicon(lexicon.unionByName(spark.createDataFrame(ENTRIES, "word string, valence double")))
    assert (every.count(), phrases.count()) == (len(LEXICON), len(ENTRIES))
    rules = {"negations": ["not"], "boosters": {"very": 0.293}}
    ways = [{}, {"phrases": phrases}, {"contrast": ["but"]}, {"emphasis": True}, {"phrases": phrases, "contrast": ["but"], "emphasis": True, **rules}]
    for n, way in enumerate(ways, 1):
        got = sentiment.review_valences(texts, ["id"], {"s": "t"}, every, max_bytes=max_bytes, **way)
        found = {row.id: row.s for row in got.collect()}
        assert [found[i] for i in range(len(COUNTED))] == pytest.approx([row[n] for row in COUNTED]), way


def test_two_texts_of_a_review_keep_their_phrases_and_marks_apart(spark, lexicon):
    df = spark.createDataFrame([(1, "the bomb!", "good bad the"), (2, None, "bomb? ? good")], "id int, a string, b string")
    phrases = spark.createDataFrame(ENTRIES, "phrase string, valence double")
    got = sentiment.review_valences(df, ["id"], {"x": "a", "y": "b"}, lexicon, phrases=phrases, emphasis=True)
    assert {row.id: (round(row.x, 6), round(row.y, 6)) for row in got.collect()} == {1: (3.292, 0.0), 2: (0.0, 2.36)}


def test_split_forms_expand_in_place(spark):
    df = spark.createDataFrame([(1, "We cannot say, gonna go the way"), (2, "the"), (3, None), (4, "gonna")], "id int, t string")
    splits = spark.createDataFrame([("cannot", ["can", "not"]), ("gonna", ["going", "the", "to"])], "form string, words array<string>")
    lemmas = spark.createDataFrame([("going", "go"), ("can", "be able")], "form string, lemma string")
    for max_bytes in (0, 1 << 25):
        got = sentiment.normalised_texts(df, "t", ["the"], lemmas, C, max_bytes, splits)
        assert rows(got) == [(1, "we be able not say go to go way"), (2, ""), (3, ""), (4, "go to")]
        got = sentiment.normalised_texts(df, "t", (), None, C, max_bytes, splits)
        assert rows(got)[0] == (1, "we can not say going the to go the way")


def test_lemmas_are_looked_up_in_the_lexicon_alone(spark, lexicon):
    lemmas = spark.createDataFrame([("goods", "good"), ("worse", "bad"), ("great", "thing"), ("mixed", "Good bad bad")], "form string, lemma string")
    assert rows(sentiment.lemma_valences(lexicon, lemmas)) == [(":)", 1.0), ("bad", -2.0), ("good", 2.0), ("goods", 2.0), ("mixed", -2.0), ("worse", -2.0)]
    df = reviews(spark, ("goods goods great", "worse mixed"), ("great", None))
    got = sentiment.review_sentiment(df, lexicon, c=C, lemmas=lemmas)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_the_model_is_sent_what_its_tokens_allow(spark):
    sent = []

    def count(words):
        assert len(set(words)) == len(words)
        return [len(word) for word in words]

    texts = sentiment.pd.Series(["aa  bb", "aaaa bb cc", "aaaaaa", "", "a a a a a a", "a\tbbb c"])
    got = sentiment.within_tokens(texts, count, 5)
    assert got.tolist() == ["aa  bb", "aaaa", None, "", "a a a a a", "a\tbbb c"]
    assert sentiment.within_tokens(texts[:0], count, 5).tolist() == []

    def load_model():
        def classes(texts):
            assert texts.notna().all() and all(sum(map(len, text.split())) <= 5 for text in texts)
            return texts.str.len() % 3 - 1

        return classes

    df = reviews(spark, ("aa bb cc", "dddddd"), ("no positive", "a b"), ("toolong x", None))
    got = sentiment.model_sentiment(df, load_model, c=C, load_counter=lambda: count, most_tokens=5)
    assert got.count() == 3 and not sent


def test_small_lookups_move_no_text(spark):
    """The same texts as by joins, also of odd forms, and no row for a word."""
    texts = [(1, "We cannot say, gonna go the way"), (2, "the"), (3, None), (4, "lé œuf x_¹ Ⅷ cannot"), (5, "twice gone")]
    df = spark.createDataFrame(texts, "id int, t string")
    splits = spark.createDataFrame([("cannot", ["can", "not"]), ("gonna", ["going", "the", None]), ("say", None)], "form string, words array<string>")
    lemmas = [("going", "go"), ("can", 'be "able"'), ("œuf", "œufs"), ("Ⅷ", "\U0001f600"), ("way", None), (None, "none")]
    lemmas = spark.createDataFrame([*lemmas, *[(f"w{n}", "w") for n in range(500)]], "form string, lemma string")
    for stop in ((), ["the"]):
        for more in ({"lemmas": lemmas}, {"lemmas": lemmas, "splits": splits}, {"splits": splits}):
            got = sentiment.normalised_texts(df, "t", stop, c=C, **more)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Generate" not in plan
            assert rows(got) == rows(sentiment.normalised_texts(df, "t", stop, c=C, max_bytes=0, **more))
    twice = spark.createDataFrame([("twice", "a"), ("twice", "b")], "form string, lemma string")
    assert {row.t for row in sentiment.normalised_texts(df, "t", ["the"], twice, C).collect()} >= {"a b gone"}


def test_a_model_of_lemmas_shuffles_nothing(spark, tmp_path):
    lemmas = spark.createDataFrame([("goods", "good")], "form string, lemma string")
    got = sentiment.model_sentiment(reviews(spark, ("goods", "bad")), valence_model(tmp_path / "log"), c=C, lemmas=lemmas)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_bare_words_of_a_whole_text(spark):
    texts = [
        "good, (bad) :) it's !!! a-b", "", " ", "!!!", "...x", "x...", "!a! !-! --", "a,b,, ,c", "\t[x]\x1c{y}\x85'z'\u2003\\w\\", "\n!\n.a\n", "é! ¡é «é» 日。", "a!! !!b ^_^ $5 \U0001f600! !\U0001f600",
        "\u00a0!x\u00a0", "~`a`~ <b>c</b> \"q\" x&y; @me #tag",
    ]
    by_word = evaluate(spark, texts, lambda x: F.transform(text.words(x), text.bare_word))
    assert evaluate(spark, texts, lambda x: text.words(text.with_bare_words(x))) == by_word
    assert by_word[0] == ["good", "bad", ":)", "it's", "!!!", "a-b"]


def test_small_lexicons_take_phrases_without_a_row_for_a_word(spark, lexicon):
    """The same sums as by joins, also where phrases overlap, repeat words or reach over the end."""
    entries = [("good", -1.0), ("good good", 7.0), ("good good good", 1.5), ("bad bad bad", 2.0), ("the bomb", None), ("a good bad", 0.25), ("!!! good", 9.0), ("great", 0.5)]
    phrases = spark.createDataFrame([*ENTRIES, *entries], "phrase string, valence double")
    texts = ["good good good good good", "a good bad bad bad", "Bad bad", "the bomb squad good good", "!!! good", "a good", "x", "", None, "great; GREAT"]
    df = spark.createDataFrame([(i, text, texts[-1 - i]) for i, text in enumerate(texts)], "id int, a string, b string")
    for punctuated in (True, False):
        more = {"phrases": phrases, "punctuated": punctuated}
        got = sentiment.review_valences(df, ["id"], {"x": "a", "y": "b"}, lexicon, **more)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
        assert plan.count("split(") == 2  # each text's words are listed once
        assert rows(got) == rows(sentiment.review_valences(df, ["id"], {"x": "a", "y": "b"}, lexicon, max_bytes=0, **more))
