"""Sentiment from a supplied lexicon or scorer, by season and by entity.

``lexicon(word, valence)`` has one row per word. Tokens meet it in a broadcast join of measured size and are
summed per review before anything is shuffled, so one small row per review travels, never its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.functions import labels
from guestbook.functions.fixed_values import (
    AFTER_CONTRAST,
    BEFORE_CONTRAST,
    CAPITALS,
    DISTANCE_DAMPING,
    EMPTY_NEGATIVES,
    EMPTY_POSITIVES,
    EXCLAMATION,
    MANY_QUESTIONS,
    MODEL_TOKENS,
    MOST_EXCLAMATIONS,
    MOST_QUESTIONS,
    NEGATION_FACTOR,
    NEGATIONS,
    QUESTION,
    STRENGTHENING,
    STRENGTHENING_WORDS,
    STRONG_WORDS,
    WEAKENING_WORDS,
)
from guestbook.functions.parsing import in_city
from guestbook.functions.text import bare, bare_word, kept_words, plain_text, stripped, with_bare_words, words
from guestbook.operators.joins import BROADCAST_BYTES, inline_lookup, join_lookup
from guestbook.operators.prepare import with_total_review
from guestbook.operators.scores import of_entity
from guestbook.schema import REVIEWS, Columns
from guestbook.shared import settled

# Of a judged review, what the review rule needs besides the two classes.
RULE = ("_pos_strong", "_neg_strong", "_pos_length", "_neg_length")

INTENSIFIERS = {word: STRENGTHENING for word in STRENGTHENING_WORDS} | {word: -STRENGTHENING for word in WEAKENING_WORDS}


def _effects(
    before: Sequence[str], negations: Sequence[str], boosters: Mapping[str, float], in_lexicon: Column
) -> dict[str, Column]:
    """For each of the three words before a word, nearest first, what it adds to a valence's strength and by what
    it turns it. A word that has a valence of its own is no modifier."""
    out = {}
    for name, damping in zip(before, DISTANCE_DAMPING):
        word, push = F.col(name), F.lit(0.0)
        for amount in sorted(set(boosters.values())):
            push = F.when(word.isin([x for x, value in boosters.items() if value == amount]), amount * damping).otherwise(push)
        turn = F.when(word.isin(list(negations)), NEGATION_FACTOR).otherwise(1.0)
        own = F.array_contains(in_lexicon, word)
        out |= {f"{name}_push": F.when(own, 0.0).otherwise(push), f"{name}_turn": F.when(own, 1.0).otherwise(turn)}
    return out


def _adjusted(valence: Column, before: Sequence[str]) -> Column:
    """An intensifier pushes the valence as it stands by then away from zero or towards it; a negation turns it."""
    for name in before:
        push = F.col(f"{name}_push")
        valence = (valence + F.when(valence < 0, -push).otherwise(push)) * F.col(f"{name}_turn")
    return valence


def review_valences(
    df: DataFrame,
    keep: Sequence[str],
    texts: Mapping[str, str],
    lexicon: DataFrame,
    negations: Sequence[str] = (),
    boosters: Mapping[str, float] | None = None,
    punctuated: bool = True,
    max_bytes: int = BROADCAST_BYTES,
    phrases: DataFrame | None = None,
    contrast: Sequence[str] = (),
    emphasis: bool = False,
) -> DataFrame:
    """Sum of word valences per review: the ``keep`` columns, which must identify a review, and for every
    entry of ``texts`` (result name -> text column) the sum over that text; 0 for an empty one. Words are
    compared in lower case and, in ``punctuated`` texts, without the punctuation around them.

    With ``negations`` or ``boosters`` the words before a word modify it; a booster has no valence itself. A
    lexicon above ``max_bytes`` meets the tokens in a shuffle, in which adaptive execution splits hot words.

    ``phrases(phrase, valence)`` are entries of several words. From left to right, the longest phrase that begins at a
    word that no phrase has taken yet counts in place of its words. What comes before the first ``contrast`` word of a
    text weighs half, what comes after it one and a half times. With ``emphasis``, words in capitals among others that
    are not count more, and closing marks push a text's sum away from zero. Texts stay where they are. With phrases and
    no other rule, a small lexicon is held against the words where they stand, and nothing moves; else the valued words
    and phrases of a text travel, with their places.
    """
    boosters = dict(boosters or {})
    if phrases is not None and not (negations or boosters or contrast or emphasis):
        entries_of = inline_lookup(_entries(lexicon, phrases), "word", "entries", max_bytes)
        if entries_of is not None:
            return _phrased(df, keep, texts, entries_of, punctuated)
    placed = phrases is not None or bool(contrast) or emphasis

    def listed_text(text: Column) -> Column:
        if emphasis:
            return text
        return with_bare_words(F.lower(text)) if placed and punctuated else F.lower(text)

    sides = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                words(listed_text(F.coalesce(F.col(column), F.lit("")))).alias("pieces"),
                (_marks(F.coalesce(F.col(column), F.lit(""))) if emphasis else F.lit(0.0)).alias("marks"),
            )
            for name, column in texts.items()
        ]
    )
    kept = [F.col(name) for name in keep]
    listed = df.select(*kept, F.explode(sides).alias("_side"))
    listed = listed.select(*kept, F.col("_side.name").alias("_text"), "_side.pieces", F.col("_side.marks").alias("_marks"))
    before = ["before1", "before2", "before3"] if negations or boosters else []
    zipped = ["pieces", *before, *(["shout"] if emphasis else [])]
    if emphasis:
        listed = listed.withColumn("shout", _shouted(F.col("pieces"))).withColumn("pieces", F.transform("pieces", F.lower))
    if emphasis and punctuated:
        listed = listed.withColumn("pieces", F.transform("pieces", bare_word))
    for n, name in enumerate(before, 1):
        listed = listed.withColumn(name, F.concat(F.array(*[F.lit("")] * n), "pieces"))
    carried = [*kept, "_text"]
    if placed:
        turn = F.lit(None).cast("int")
        for name in contrast:
            turn = F.least(turn, F.nullif(F.array_position("pieces", name).cast("int"), F.lit(0)))
        longest = phrases.agg(F.max(F.size(words(F.col("phrase"))))).first()[0] or 1 if phrases is not None else 1
        listed = listed.withColumns({"_turn": turn - 1, "_all": F.col("pieces")})
        tokens = listed.select(*carried, "_marks", "_turn", "_all", F.posexplode(F.arrays_zip(*zipped)).alias("_at", "_token"))
        tokens = tokens.select(*carried, "_marks", "_turn", "_at", F.slice("_all", F.col("_at") + 1, F.lit(longest)).alias("_next"), "_token.*")
        tokens = tokens.filter(F.col("pieces").isNotNull())
    elif before:
        tokens = listed.select(*carried, F.explode(F.arrays_zip(*zipped)).alias("_token")).select(*carried, "_token.*")
        tokens = tokens.filter(F.col("pieces").isNotNull())
    else:
        tokens = listed.select(*carried, F.explode("pieces").alias("pieces"))
    if punctuated and not placed:
        # Two steps, so that the trimming is evaluated once per word.
        tokens = tokens.withColumn("_bare", bare(F.col("pieces")))
        word = F.when(F.col("_bare") == "", F.col("pieces")).otherwise(F.col("_bare"))
        tokens = tokens.withColumn("word", word).drop("pieces", "_bare")
    else:
        tokens = tokens.withColumnRenamed("pieces", "word")
    valued = join_lookup(
        tokens, lexicon.select("word", F.col("valence").cast("double").alias("_valence")), "word", "left", max_bytes=max_bytes
    )
    if placed:
        valued = valued.withColumn("_size", F.lit(1))
    if phrases is not None:
        entries = phrases.select(words(F.lower("phrase")).alias("_phrase"), F.col("valence").cast("double").alias("_valence"))
        entries = entries.withColumns({"word": F.col("_phrase")[0], "_size": F.size("_phrase")})
        found = join_lookup(tokens, entries, "word", max_bytes=max_bytes)
        found = found.filter(F.slice("_next", F.lit(1), F.col("_size")) == F.col("_phrase")).select(*valued.columns)
        valued = valued.unionByName(found)
    value = F.col("_valence")
    if emphasis:
        shout = F.when(F.col("shout"), F.when(value < 0, -CAPITALS).when(value > 0, CAPITALS).otherwise(0.0)).otherwise(0.0)
        valued = valued.withColumn("_valence", value + shout)
    if before:
        # Only words with a valence have the words before them looked at. Of the lexicon, the modifiers in it
        # are all that matters there: no more words than there are modifiers.
        modifiers = lexicon.filter(F.col("word").isin([*negations, *boosters])).agg(F.collect_set("word"))
        valued = valued.withColumns({name: F.when(value.isNotNull(), bare_word(F.col(name))) for name in before})
        value = F.when(F.col("word").isin(list(boosters)), 0.0).otherwise(value) if boosters else value
        # Columns of their own, so that the optimizer does not repeat them in every branch of the sum.
        valued = valued.withColumns(_effects(before, negations, boosters, modifiers.scalar()))
        value = _adjusted(value, before)
    if contrast:
        valued = valued.withColumn("_value", value)
        value = F.col("_value") * F.when(F.col("_at") < F.col("_turn"), BEFORE_CONTRAST).when(F.col("_at") > F.col("_turn"), AFTER_CONTRAST).otherwise(1.0)
    if phrases is not None:
        entry = F.struct("_text", "_at", (-F.col("_size")).alias("_longest"), value.alias("_value"))
        gathered = valued.groupBy(*keep).agg(
            F.array_sort(F.collect_list(F.when(value.isNotNull(), entry))).alias("_entries"), *_mark_columns(texts, emphasis)
        )
        sums = {name: _taken(name) for name in texts}
    else:
        sums = {name: F.coalesce(F.sum(F.when(F.col("_text") == name, value)), F.lit(0.0)) for name in texts}
        gathered = valued.groupBy(*keep).agg(*[total.alias(name) for name, total in sums.items()], *_mark_columns(texts, emphasis))
        sums = {name: F.col(name) for name in texts}
    if emphasis:
        gathered = gathered.select("*") if phrases is None else gathered.select("*", *[total.alias(name) for name, total in sums.items()])
        sums = {name: F.col(name) + F.signum(F.col(name)) * F.col(f"_marks_{name}") for name in texts}
    return gathered.select(*keep, *[total.alias(name) for name, total in sums.items()])


def _mark_columns(texts: Mapping[str, str], emphasis: bool) -> list[Column]:
    """What each text's closing marks add, if they count: it is the same in all rows of a text."""
    return [F.coalesce(F.max(F.when(F.col("_text") == name, F.col("_marks"))), F.lit(0.0)).alias(f"_marks_{name}") for name in texts if emphasis]


def _marks(text: Column) -> Column:
    def times(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    questions = times("?")
    asked = F.when(questions > MOST_QUESTIONS, MANY_QUESTIONS).when(questions > 1, questions * QUESTION).otherwise(0.0)
    return F.least(times("!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + asked


def _shouted(pieces: Column) -> Column:
    """For every word, whether it is in capitals in a text of which not all words are."""
    upper = F.transform(pieces, lambda word: (word == F.upper(word)) & (word != F.lower(word)))
    return F.when(F.forall(upper, lambda is_upper: is_upper), F.transform(pieces, lambda word: F.lit(False))).otherwise(upper)


def _taken(text: str) -> Column:
    """Sum of a text's entries that are taken: by place, the longest first, each where the one before ends at the latest."""
    entries = F.filter("_entries", lambda entry: entry["_text"] == text)
    none = F.struct(F.lit(0).alias("free"), F.lit(0.0).alias("total"))

    def step(held: Column, entry: Column) -> Column:
        taken = F.struct((entry["_at"] - entry["_longest"]).alias("free"), (held["total"] + entry["_value"]).alias("total"))
        return F.when(entry["_at"] >= held["free"], taken).otherwise(held)

    return F.aggregate(entries, none, step, lambda held: held["total"])


def _entries(lexicon: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per word, its own entry and those of the phrases that begin with it, the longest first, with the words that follow."""
    listed = lexicon.select(F.array("word").alias("_phrase"), F.col("valence").cast("double").alias("_value"))
    listed = listed.unionByName(phrases.select(words(F.lower("phrase")).alias("_phrase"), F.col("valence").cast("double").alias("_value")))
    entry = F.struct((-F.size("_phrase")).alias("_longest"), "_value", F.slice("_phrase", 2, F.size("_phrase")).alias("_rest"))
    listed = listed.filter(F.col("_value").isNotNull()).select(F.col("_phrase")[0].alias("word"), entry.alias("_entry"))
    return listed.groupBy("word").agg(F.array_sort(F.collect_list("_entry")).alias("entries"))


def _phrased(
    df: DataFrame, keep: Sequence[str], texts: Mapping[str, str], entries_of: Callable[[Column], Column], punctuated: bool
) -> DataFrame:
    """Each text's sum over the entries that are taken, without a row for every word."""
    plain = {name: F.lower(F.coalesce(F.col(column), F.lit(""))) for name, column in texts.items()}
    pieces = {name: words(with_bare_words(text) if punctuated else text) for name, text in plain.items()}
    listed = df.select(*keep, *[split.alias(f"_pieces_{name}") for name, split in pieces.items()])

    def found(name: str) -> Column:
        pieces = F.col(f"_pieces_{name}")

        def longest(word: Column, at: Column) -> Column:
            def is_here(entry: Column) -> Column:
                rest = entry["_rest"]  # its first word is looked at alone, since slices are copies
                return (entry["_longest"] == -1) | ((F.get(pieces, at + 1) == F.get(rest, F.lit(0))) & (F.slice(pieces, at + 2, F.size(rest)) == rest))

            return F.get(F.filter(entries_of(word), is_here), F.lit(0))

        def step(held: Column, entry: Column) -> Column:
            taken = F.struct((-entry["_longest"] - 1).alias("skip"), (held["total"] + entry["_value"]).alias("total"))
            skipped = F.struct((held["skip"] - 1).alias("skip"), held["total"].alias("total"))
            return F.when(held["skip"] > 0, skipped).when(entry.isNull(), held).otherwise(taken)

        none = F.struct(F.lit(0).alias("skip"), F.lit(0.0).alias("total"))
        return F.aggregate(F.transform(pieces, longest), none, step, lambda held: held["total"])

    return listed.select(*keep, *[found(name).alias(name) for name in texts])


def split_lexicon(lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A ``lexicon(word, valence)`` with entries of several words as the words and ``phrases(phrase, valence)``."""
    several = F.size(words(F.col("word"))) > 1
    return lexicon.filter(~several), lexicon.filter(several).select(F.col("word").alias("phrase"), "valence")


def seasonal_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    c: Columns = REVIEWS,
    negations: Sequence[str] = NEGATIONS,
    boosters: Mapping[str, float] = INTENSIFIERS,
    max_bytes: int = BROADCAST_BYTES,
    **rules,
) -> DataFrame:
    """Mean compound sentiment, mean score and review count per entity, address and season, by the published
    negations and intensifiers or others; with none of them, words count by themselves. ``rules``: phrases, contrast
    and emphasis of ``review_valences``."""
    seasons = with_total_review(df, c).withColumn("Season", labels.season(F.col(c.date)))
    keep = [c.entity, c.address, "Season", c.score, *c.key]
    totals = review_valences(
        seasons, keep, {"_total": "Total_Review"}, lexicon, negations, boosters, max_bytes=max_bytes, **rules
    )
    return (
        totals.withColumn("Net_Sentiment", labels.compound(F.col("_total")))
        .groupBy(c.entity, c.address, "Season")
        .agg(
            F.avg("Net_Sentiment").alias("avg_sentiment"),
            F.avg(c.score).alias("avg_reviewer_score"),
            F.count("*").alias("review_count"),
        )
        .orderBy(c.entity, c.address, "Season")
    )


def seasons_in_city(seasonal: DataFrame, city: str, c: Columns = REVIEWS) -> DataFrame:
    return seasonal.filter(in_city(F.col(c.address), city))


def entities_in_city(seasonal: DataFrame, city: str, c: Columns = REVIEWS) -> DataFrame:
    return seasons_in_city(seasonal, city, c).select(c.entity).distinct()


def yearly_sentiment(seasonal: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Unweighted mean of the season means per entity, and its label."""
    return (
        seasonal.groupBy(c.entity)
        .agg(F.avg("avg_sentiment").alias("year_sentiment"), F.avg("avg_reviewer_score").alias("year_score"))
        .withColumn("label", labels.year_label(F.col("year_sentiment")))
    )


def _judged(df: DataFrame, strong_words: Sequence[str], c: Columns) -> DataFrame:
    """The two texts stripped, lower-cased and emptied of sentinels, with what the review rule needs of them."""

    def side(column: str, empty: Sequence[str]) -> Column:
        text = F.lower(stripped(F.coalesce(F.col(column), F.lit(""))))
        return F.when(text.isin(*empty), F.lit("")).otherwise(text)

    out = df.withColumn("_pos", side(c.positive_text, EMPTY_POSITIVES)).withColumn(
        "_neg", side(c.negative_text, EMPTY_NEGATIVES)
    )
    return out.select(
        c.entity,
        *c.key,
        F.col("_pos"),
        F.col("_neg"),
        labels.has_strong_word(F.col("_pos"), strong_words).alias("_pos_strong"),
        labels.has_strong_word(F.col("_neg"), strong_words).alias("_neg_strong"),
        F.length("_pos").alias("_pos_length"),
        F.length("_neg").alias("_neg_length"),
    )


def _combined(positive_class: Column, negative_class: Column) -> Column:
    return labels.review_class(*[F.col(name) for name in RULE], positive_class, negative_class)


def _normalised(
    df: DataFrame,
    keep: Sequence[str],
    texts: Sequence[str],
    stop_words: Sequence[str],
    lemmas: DataFrame | None,
    max_bytes: int,
    splits: DataFrame | None = None,
) -> DataFrame:
    """The ``keep`` columns, which must identify a review, and the texts plain, without stop words, each word
    as its lemma. Small tables to look words up in are held against the words where they stand, and nothing moves. With
    larger ones, reviews are dealt out once as they are; lookups that fit a broadcast leave a review's words in their
    task, where they come together again."""
    if lemmas is None and splits is None:
        plain = {
            name: F.array_join(kept_words(plain_text(F.col(name)), stop_words), " ") if stop_words else plain_text(F.col(name))
            for name in texts
        }
        return df.select(*keep, *[plain[name].alias(name) for name in texts])
    lemma_of = lemmas is not None and inline_lookup(lemmas, "form", "lemma", max_bytes)
    pieces_of = splits is not None and inline_lookup(splits, "form", "words", max_bytes)
    if lemma_of is not None and pieces_of is not None:
        return df.select(*keep, *[_looked_up(plain_text(F.col(name)), stop_words, lemma_of, pieces_of).alias(name) for name in texts])
    first = stop_words if splits is None else ()
    sides = F.array(*[F.struct(F.lit(n).alias("side"), kept_words(plain_text(F.col(name)), first).alias("words")) for n, name in enumerate(texts)])
    listed = df.select(*keep, *texts).repartition(*keep).select(*keep, F.explode(sides).alias("_side"))
    tokens = listed.select(*keep, "_side.side", F.posexplode_outer("_side.words").alias("_at", "form"))
    place = ["side", "_at"]
    if splits is not None:
        found = join_lookup(tokens, splits.select("form", F.col("words").alias("_pieces")), "form", "left", max_bytes=max_bytes)
        pieces = F.posexplode(F.coalesce("_pieces", F.array("form"))).alias("_piece", "form")
        tokens, place = found.select(*keep, *place, pieces), [*place, "_piece"]
        if stop_words:  # a review keeps a row when all its words go
            tokens = tokens.withColumn("form", F.when(~F.col("form").isin(list(stop_words)), F.col("form")))
    word = F.col("form")
    if lemmas is not None:
        tokens = join_lookup(tokens, lemmas.select("form", "lemma"), "form", "left", max_bytes=max_bytes)
        word = F.coalesce("lemma", "form")
    # One review's words come together here, never more.
    spoken = F.array_sort(F.collect_list(F.struct(*place, word.alias("word"))))
    gathered = tokens.groupBy(*keep).agg(spoken.alias("_words"))

    def side(n: int) -> Column:
        mine = F.filter("_words", lambda word: word["side"] == n)
        return F.array_join(F.transform(mine, lambda word: word["word"]), " ")

    return gathered.select(*keep, *[side(n).alias(name) for n, name in enumerate(texts)])


def _looked_up(
    plain: Column, stop_words: Sequence[str], lemma_of: Callable[[Column], Column] | bool, pieces_of: Callable[[Column], Column] | bool
) -> Column:
    """A plain text whose forms are replaced in place: by their words, then, without stop words, by their lemmas."""
    listed = kept_words(plain, () if pieces_of else stop_words)
    if pieces_of:
        listed = F.flatten(F.transform(listed, lambda form: F.coalesce(pieces_of(form), F.array(form))))
        if stop_words:
            listed = F.filter(listed, lambda form: ~form.isin(list(stop_words)))
    if lemma_of:
        listed = F.transform(listed, lambda form: F.coalesce(lemma_of(form), form))
    return F.array_join(listed, " ")


def lemma_valences(lexicon: DataFrame, lemmas: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``lexicon(word, valence)`` for forms as they stand in a text: a form of ``lemmas(form, lemma)`` has the valence of
    its lemma, or the sum over its words, and any other word its own."""
    named = lexicon.select("word", F.col("word").alias("lemma"), F.lit(0).alias("_is_form"))
    named = named.unionByName(lemmas.select(F.col("form").alias("word"), "lemma", F.lit(1).alias("_is_form")))
    named = named.groupBy("word").agg(F.max_by("lemma", "_is_form").alias("lemma"))
    pieces = named.select("word", F.explode(words(F.lower("lemma"))).alias("_lemma"))
    valued = join_lookup(pieces, lexicon.select(F.col("word").alias("_lemma"), F.col("valence").cast("double").alias("valence")), "_lemma", max_bytes=max_bytes)
    return settled(valued.groupBy("word").agg(F.sum("valence").alias("valence")), "lemma-valences")


def review_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    strong_words: Sequence[str] = STRONG_WORDS,
    c: Columns = REVIEWS,
    stop_words: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
    **rules,
) -> DataFrame:
    """Class -1/0/1 of every review: entity, key, ``sentiment_value`` and ``sentiment``.

    Texts are classed after stop words went and ``lemmas(form, lemma)`` replaced their forms. Where no word modifies
    another, the lemmas are looked up in the lexicon instead of in the texts, whose words then stay where they are.
    """
    keep = [c.entity, *c.key, *RULE]
    if lemmas is not None and not rules.get("negations") and not rules.get("boosters"):
        lexicon, lemmas = lemma_valences(lexicon, lemmas, max_bytes), None
    judged = _normalised(_judged(df, strong_words, c), keep, ["_pos", "_neg"], stop_words, lemmas, max_bytes)
    totals = review_valences(
        judged, keep, {"_p": "_pos", "_n": "_neg"}, lexicon, punctuated=False, max_bytes=max_bytes, **rules
    )
    p, n = (labels.compound_class(labels.compound(F.col(name))) for name in ("_p", "_n"))
    value = _combined(p, n)
    return totals.select(c.entity, *c.key, value.alias("sentiment_value"), labels.class_name(value).alias("sentiment"))


def entity_sentiment(reviews: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Label of every entity from the ``sentiment_value`` of its reviews."""
    return (
        reviews.groupBy(c.entity)
        .agg(F.avg("sentiment_value").alias("mean_sentiment"))
        .withColumn("label", labels.entity_label(F.col("mean_sentiment")))
    )


def label_of_entity(reviews: DataFrame, entity: str, c: Columns = REVIEWS) -> DataFrame:
    """One row with the label of one entity; says so when it has no reviews."""
    return of_entity(reviews, entity, c).agg(F.avg("sentiment_value").alias("_mean")).select(
        F.lit(entity).alias(c.entity), labels.entity_label(F.col("_mean")).alias("label")
    )


Scorer = Callable[[pd.Series], pd.Series]
TokenCounter = Callable[[list[str]], Sequence[int]]


def within_tokens(texts: pd.Series, count: TokenCounter, most: int) -> pd.Series:
    """The texts up to the last word with which they stay within ``most`` tokens; words are counted one by one, each
    distinct one once. A text that fits stays as it is; one whose first word is too long becomes None."""
    listed = [text.split() for text in texts]
    distinct = list(dict.fromkeys(word for some in listed for word in some))
    tokens = dict(zip(distinct, count(distinct) if distinct else ()))
    out = []
    for text, some in zip(texts, listed):
        fits = int((np.cumsum([tokens[word] for word in some]) <= most).sum())
        out.append(text if fits == len(some) else " ".join(some[:fits]) or None)
    return pd.Series(out, index=texts.index, dtype=object)


def text_classes(
    texts: Sequence[Column],
    load_scorer: Callable[[], Scorer],
    load_counter: Callable[[], TokenCounter] | None = None,
    most_tokens: int = MODEL_TOKENS,
) -> Column:
    """Struct of the classes -1/0/1 of several texts by a user's own model; a NULL text gets 0 and is not sent.

    ``load_scorer`` runs once per task and returns a function from a batch of cleaned texts to classes. With
    ``load_counter``, which returns a function from words to their numbers of tokens by the model's tokenizer, the model
    is sent the words that fit into ``most_tokens``.
    """
    names = [f"t{n}" for n in range(len(texts))]

    @F.pandas_udf(", ".join(f"{name} int" for name in names))
    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = load_scorer()
        count = load_counter() if load_counter else None
        for batch in batches:
            asked = pd.concat([batch[name] for name in names], ignore_index=True)
            if count is not None:
                there = asked.notna()
                asked = asked.astype(object).where(there, None)
                asked[there] = within_tokens(asked[there], count, most_tokens)
            classes, sent = np.zeros(len(asked), np.int32), asked.notna().to_numpy()
            if sent.any():
                classes[sent] = score(asked[sent].reset_index(drop=True))
            yield pd.DataFrame(classes.reshape(len(names), -1).T, columns=names)

    return classify(F.struct(*[text.alias(name) for name, text in zip(names, texts)]))


def model_sentiment(
    df: DataFrame,
    load_scorer: Callable[[], Scorer],
    strong_words: Sequence[str] = STRONG_WORDS,
    c: Columns = REVIEWS,
    stop_words: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
    load_counter: Callable[[], TokenCounter] | None = None,
    most_tokens: int = MODEL_TOKENS,
) -> DataFrame:
    """``review_sentiment`` with a user's model in place of the lexicon.

    The model sees the texts that the rule still needs: none where a strong word decides, and none that is
    empty. Without lemmas nothing is shuffled.
    """
    keep = [c.entity, *c.key, *RULE]
    judged = _normalised(_judged(df, strong_words, c), keep, ["_pos", "_neg"], stop_words, lemmas, max_bytes)
    undecided = F.col("_pos_strong") == F.col("_neg_strong")
    asked = [
        F.when(undecided & (F.col(length) > 0), F.col(text)) for text, length in (("_pos", "_pos_length"), ("_neg", "_neg_length"))
    ]
    classed = judged.withColumn("_classes", text_classes(asked, load_scorer, load_counter, most_tokens))
    value = _combined(F.col("_classes.t0"), F.col("_classes.t1"))
    return classed.select(c.entity, *c.key, value.alias("sentiment_value"), labels.class_name(value).alias("sentiment"))


def normalised_texts(
    df: DataFrame,
    texts: str | Sequence[str],
    stop_words: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    c: Columns = REVIEWS,
    max_bytes: int = BROADCAST_BYTES,
    splits: DataFrame | None = None,
) -> DataFrame:
    """Key of each review and its plain texts without stop words, each word as its lemma.

    ``lemmas(form, lemma)`` has one row per form; a form that is not in it stays as it is. ``splits(form, words)`` has
    forms that stand for several words ("cannot"); these take the form's place, in their order, before stop words go.
    Words are parted by single spaces, and an empty text stays empty.
    """
    texts = [texts] if isinstance(texts, str) else list(texts)
    if lemmas is None and splits is None:
        plain = [F.array_join(kept_words(plain_text(F.col(name)), stop_words), " ").alias(name) for name in texts]
        return df.select(*c.key, *plain)
    return _normalised(df, list(c.key), texts, stop_words, lemmas, max_bytes, splits)
