"""Descriptive words and the scores of the reviews that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import ADJECTIVE, ADJECTIVE_ENDINGS, DESCRIPTIVE_POS
from guestbook.operators.joins import BROADCAST_BYTES, join_lookup
from guestbook.operators.topk import first_k_per_group
from guestbook.schema import REVIEWS, Columns
from guestbook.shared import settled


def descriptive_words(lexicon: DataFrame) -> DataFrame:
    """Words of ``lexicon(word, pos)`` with an adjective or adverb sense; satellite adjectives do not count."""
    return lexicon.filter(F.col("pos").isin(*DESCRIPTIVE_POS)).select("word")


def descriptive_forms(
    words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``words(word, ...)``, one for each word, that are descriptive words or inflected forms of one.

    Base forms are looked up like words: those that ``exceptions(form, base)`` names for a form ("better", "good") or,
    for a form that it does not name, those that the endings of comparison leave ("quickest", "quick"; "nicer", "nice"),
    which hold for adjectives alone. A row stays as often as it came.
    """
    bare = words.select("word").distinct()
    ruled = [F.when(F.col("word").endswith(ending), F.concat(F.expr(f"left(word, length(word) - {len(ending)})"), F.lit(other))) for ending, other in ADJECTIVE_ENDINGS]
    if exceptions is None:
        by_rule, named = bare, None
    else:
        listed = exceptions.select(F.col("form").alias("word"), F.col("base").alias("_base")).distinct()
        known = join_lookup(bare, listed, "word", "left", max_bytes=max_bytes)
        by_rule, named = known.filter(F.col("_base").isNull()).select("word"), known.filter(F.col("_base").isNotNull())
    ruled_bases = by_rule.select("word", F.explode(F.array(*ruled)).alias("_base")).filter("_base <> ''")
    candidates = bare.select("word", F.col("word").alias("_base"), F.array(*map(F.lit, DESCRIPTIVE_POS)).alias("_as"))
    candidates = candidates.unionByName(ruled_bases.withColumn("_as", F.array(F.lit(ADJECTIVE))))
    if named is not None:
        candidates = candidates.unionByName(named.withColumn("_as", F.array(*map(F.lit, DESCRIPTIVE_POS))))
    asked = candidates.select("word", "_base", F.explode("_as").alias("_pos"))
    senses = lexicon.filter(F.col("pos").isin(*DESCRIPTIVE_POS)).select(F.col("word").alias("_base"), F.col("pos").alias("_pos"))
    found = join_lookup(asked, senses, ["_base", "_pos"], "left_semi", max_bytes=max_bytes).select("word").distinct()
    return join_lookup(words, found, "word", "left_semi", costly=True, max_bytes=max_bytes)


def _word_scores(
    df: DataFrame, texts: dict[str, str], lexicon: DataFrame, min_frequency: int, c: Columns, max_bytes: int, inflected: bool = False,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Aggregate first, look words up afterwards: the lexicon meets each frequent word once, not each token,
    and a word that fills a third of the table is already one row per input partition when it is shuffled."""
    sides = F.array(*[F.struct(F.lit(side).alias("polarity"), F.col(name).alias("text")) for side, name in texts.items()])
    tokens = (
        df.select(F.col(c.score), F.explode(sides).alias("_side"))
        .select(
            F.col(c.score),
            F.col("_side.polarity").alias("polarity"),
            F.explode(F.split(F.lower(F.col("_side.text")), r"\s+")).alias("word"),
        )
        .filter(F.col("word") != "")
    )
    frequent = (
        tokens.groupBy("polarity", "word")
        .agg(F.avg(c.score).alias("avg_score"), F.count("word").alias("word_count"))
        .filter(F.col("word_count") >= min_frequency)
    )
    if inflected:
        found = descriptive_forms(settled(frequent, "frequent-words"), lexicon, exceptions, max_bytes)
    else:
        found = join_lookup(frequent, descriptive_words(lexicon), "word", "left_semi", max_bytes=max_bytes)
    return found.select("polarity", "word", "avg_score", "word_count")


def positive_words(
    df: DataFrame, lexicon: DataFrame, min_frequency: int = 1000, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Words of the positive texts, best mean score first."""
    scores = _word_scores(df, {"positive": c.positive_text}, lexicon, min_frequency, c, max_bytes).drop("polarity")
    return scores.orderBy(F.desc("avg_score"), "word")


def negative_words(
    df: DataFrame, lexicon: DataFrame, min_frequency: int = 1000, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Words of the negative texts, worst mean score first."""
    scores = _word_scores(df, {"negative": c.negative_text}, lexicon, min_frequency, c, max_bytes).drop("polarity")
    return scores.orderBy("avg_score", "word")


def word_scores(
    df: DataFrame,
    lexicon: DataFrame,
    min_frequency: int = 1000,
    c: Columns = REVIEWS,
    max_bytes: int = BROADCAST_BYTES,
    inflected: bool = False,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Both word tables in one scan, told apart by ``polarity``. With ``inflected``, forms of descriptive words count
    too, each as itself; see ``descriptive_forms``."""
    texts = {"positive": c.positive_text, "negative": c.negative_text}
    return _word_scores(df, texts, lexicon, min_frequency, c, max_bytes, inflected, exceptions)


def top_words(
    df: DataFrame, lexicon: DataFrame, n: int = 20, min_frequency: int = 100, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The n best words of the positive texts and the n worst of the negative ones, from one scan.

    The rank runs over the small table of frequent words, of which Spark keeps n before the shuffle.
    """
    best_first = F.when(F.col("polarity") == "positive", -F.col("avg_score")).otherwise(F.col("avg_score"))
    return first_k_per_group(word_scores(df, lexicon, min_frequency, c, max_bytes), ["polarity"], [best_first, "word"], n)
