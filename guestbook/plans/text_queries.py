"""Queries on the text relation: words, sentiment and summaries."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from guestbook.functions import labels
from guestbook.functions.text import plain_text, without_reasoning
from guestbook.operators import prepare, sentiment, summary, words
from guestbook.plans.registry import query, rounded
from guestbook.plans.relations import TEXT, lexicon, table, text_reviews
from guestbook.shared import new_table_path
from guestbook.sources import export_word_scores

SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
PUNCTUATION = string.punctuation.replace("'", "''")
LINES = "string_split(text, chr(10))"
ODD = f"array_to_string(list_filter({LINES}, lambda x, i: i % 2 = 1), chr(10))"
EVEN = f"array_to_string(list_filter({LINES}, lambda x, i: i % 2 = 0), chr(10))"
TR = f"""with r as (select doc_id, source as Hotel_Name, concat(source, ' ', lang) as Hotel_Address,
      date '2016-01-01' + cast(doc_id % 365 as integer) as Review_Date,
      cast(2.5 as double) + (doc_id % 16) * cast(0.5 as double) as Reviewer_Score,
      case when doc_id % 11 = 0 then 'No Positive' when doc_id % 7 = 0 then text else {ODD} end as Positive_Review,
      case when doc_id % 11 = 0 then text when doc_id % 7 = 0 or {EVEN} = '' then 'No Negative'
        else {EVEN} end as Negative_Review,
      (doc_id * 13) % 97 as Total_Number_of_Reviews_Reviewer_Has_Given from documents),
    lex as (select distinct word, cast(length(word) % 9 - 4 as double) as valence,
      case length(word) % 4 when 0 then 'a' when 1 then 'r' when 2 then 's' else 'n' end as pos,
      substring(word, 1, 3) as lemma
      from (select unnest(string_split_regex(lower(text), '[\\t-\\r ]+')) as word from benchmark) where word <> '')"""


# --- words ---------------------------------------------------------------------------------------------


def word_scores_sql(column: str) -> str:
    return f"""select word, avg(Reviewer_Score) as avg_score, count(*) as word_count
      from (select Reviewer_Score, unnest(string_split_regex(lower({column}), '[\\t-\\r ]+')) as word from r)
      where word <> '' and word in (select word from lex where pos in ('a', 'r'))
      group by word having count(*) >= 20"""


@query("q1a_positive_words", f"{TR} {word_scores_sql('Positive_Review')}")
def _(spark, sf_dir):
    return words.positive_words(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), 20)


@query("q1b_negative_words", f"{TR} {word_scores_sql('Negative_Review')}")
def _(spark, sf_dir):
    return words.negative_words(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), 20)


@query(
    "q1_word_scores",
    f"""{TR} select 'positive' as polarity, * from ({word_scores_sql("Positive_Review")})
    union all select 'negative' as polarity, * from ({word_scores_sql("Negative_Review")})""",
)
def _(spark, sf_dir):
    return words.word_scores(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), 20)


# A stand-in for inflected words: of two words of the lexicon that share their first three letters, the longer one is
# named as a form of the shorter, and all others go by the endings of comparison.
EXCEPTION_SQL = """select a.word as form, b.word as base from {lex} a join {lex} b
    on substring(a.word, 1, 3) = substring(b.word, 1, 3) and length(a.word) = length(b.word) + 3"""


@query(
    "q1_word_scores_of_inflected_words",
    f"""{TR}, exc as ({EXCEPTION_SQL.format(lex="lex")}),
    w as (select 'positive' as polarity, Reviewer_Score, unnest(string_split_regex(lower(Positive_Review), '[\t-\r ]+')) as word from r
      union all select 'negative', Reviewer_Score, unnest(string_split_regex(lower(Negative_Review), '[\t-\r ]+')) from r),
    f as (select polarity, word, avg(Reviewer_Score) as avg_score, count(*) as word_count from w where word <> ''
      group by 1, 2 having count(*) >= 20),
    cand as (select word, word as base, 'a r' as pos from f
      union all select word, base, 'a r' from f join exc on form = word
      union all select word, left(word, length(word) - 2), 'a' from f where word like '%er' and word not in (select form from exc)
      union all select word, left(word, length(word) - 1), 'a' from f where word like '%er' and word not in (select form from exc)
      union all select word, left(word, length(word) - 3), 'a' from f where word like '%est' and word not in (select form from exc)
      union all select word, left(word, length(word) - 2), 'a' from f where word like '%est' and word not in (select form from exc))
    select * from f where word in (select cand.word from cand join lex on lex.word = base and contains(cand.pos, lex.pos)
      where lex.pos in ('a', 'r'))""",
)
def _(spark, sf_dir):
    lex = lexicon(spark, sf_dir)
    exceptions = spark.sql(EXCEPTION_SQL, lex=lex)
    return words.word_scores(text_reviews(spark, sf_dir), lex, 20, inflected=True, exceptions=exceptions)


@query("q1c_descriptive_words", f"{TR} select word from lex where pos in ('a', 'r')")
def _(spark, sf_dir):
    return words.descriptive_words(lexicon(spark, sf_dir))


@query(
    "q1d_top_words",
    f"""{TR} select * from (select 'positive' as polarity, * from ({word_scores_sql("Positive_Review")})
      order by avg_score desc, word limit 20)
    union all select * from (select 'negative' as polarity, * from ({word_scores_sql("Negative_Review")})
      order by avg_score, word limit 20)""",
)
def _(spark, sf_dir):
    return words.top_words(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), 20, 20)


@query(
    "s3_word_score_export",
    f"""{TR} select 'positive' as polarity, * from ({word_scores_sql("Positive_Review")})
    union all select 'negative' as polarity, * from ({word_scores_sql("Negative_Review")})""",
)
def _(spark, sf_dir):
    path = new_table_path(spark, "word-scores")
    export_word_scores(words.word_scores(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), 20), path)
    schema = "word string, avg_score double, word_count bigint, polarity string"
    return spark.read.schema(schema).option("header", True).csv(path)


# --- sentiment by season -------------------------------------------------------------------------------


@query(
    "p10_total_review",
    f"""{TR} select doc_id, length(t) as n_chars, md5(t) as digest
    from (select doc_id, concat_ws(' ', Positive_Review, Negative_Review) as t from r)""",
)
def _(spark, sf_dir):
    merged = prepare.with_total_review(text_reviews(spark, sf_dir))
    return merged.select("doc_id", F.length("Total_Review").alias("n_chars"), F.md5("Total_Review").alias("digest"))


def tokens_sql(source: str, punctuated: bool = True) -> str:
    """Words of (doc_id, side, t) with their place in the text."""
    bare = f"trim(lower(w), '{PUNCTUATION}')"
    word = f"case when {bare} = '' then lower(w) else {bare} end" if punctuated else "lower(w)"
    return f"""select doc_id, side, ix, {word} as word
      from (select doc_id, side, unnest(ws) as w, generate_subscripts(ws, 1) as ix
        from (select doc_id, side, string_split_regex(t, '[{SPACE}]+') as ws from ({source})))"""


BOTH = "select doc_id, 'a' as side, concat_ws(' ', Positive_Review, Negative_Review) as t from r"
COMPOUND = "s / sqrt(s * s + 15)"
TOTALS = f"""tok as ({tokens_sql(BOTH)}),
    total as (select doc_id, coalesce(sum(valence), 0) as s from tok left join lex using (word) group by doc_id)"""
RULES = {"negations": ["the", "in"], "boosters": {"and": 0.293, "of": 0.293, "that": -0.293}}
PLAIN = {"negations": [], "boosters": {}}
# The lexicon of the ruled queries: words of four letters or more, so that of the modifiers only "that" can be in
# it. A modifier (kind, amount, distance) applies in turn to the value as it stands; "that" has no value itself.
RULED_TOTALS = f"""lexl as (select word, valence from lex where length(word) >= 4),
    modifier as (select * from (values ('the', 'turn', -0.74e0), ('in', 'turn', -0.74e0), ('and', 'push', 0.293e0),
      ('of', 'push', 0.293e0), ('that', 'push', -0.293e0)) as m(word, kind, amount) where word not in (select word from lexl)),
    tok as ({tokens_sql(BOTH)}),
    near as (select doc_id, ix, word, lag(word, 1, '') over w as b1, lag(word, 2, '') over w as b2,
      lag(word, 3, '') over w as b3 from tok window w as (partition by doc_id order by ix)),
    found as (select near.doc_id, m1.kind as k1, m1.amount as a1, m2.kind as k2, m2.amount * 0.95e0 as a2, m3.kind as k3,
        m3.amount * 0.9e0 as a3, case when near.word in ('and', 'of', 'that') then 0 else valence end as x0
      from near join lexl on near.word = lexl.word left join modifier m1 on b1 = m1.word
      left join modifier m2 on b2 = m2.word left join modifier m3 on b3 = m3.word),
    x1 as (select *, case k1 when 'turn' then x0 * a1 when 'push' then x0 + a1 * case when x0 < 0 then -1 else 1 end
      else x0 end as x1 from found),
    x2 as (select *, case k2 when 'turn' then x1 * -0.74e0 when 'push' then x1 + a2 * case when x1 < 0 then -1 else 1 end
      else x1 end as x2 from x1),
    x3 as (select *, case k3 when 'turn' then x2 * -0.74e0 when 'push' then x2 + a3 * case when x2 < 0 then -1 else 1 end
      else x2 end as x3 from x2),
    total as (select r.doc_id, coalesce(sum(x3), 0) as s from r left join x3 using (doc_id) group by 1)"""


def long_words(spark, sf_dir):
    return lexicon(spark, sf_dir).filter("length(word) >= 4")


def _compounds(spark, sf_dir, valences=lexicon, **rules):
    merged = prepare.with_total_review(text_reviews(spark, sf_dir))
    totals = sentiment.review_valences(merged, ["doc_id"], {"s": "Total_Review"}, valences(spark, sf_dir), **rules)
    return totals.select("doc_id", F.round(labels.compound(F.col("s")), 6).alias("compound"))


@query("q5a_compound_sentiment", f"{TR}, {TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total")
def _(spark, sf_dir):
    return _compounds(spark, sf_dir)


@query("q5a_compound_sentiment_large_lexicon", f"{TR}, {TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total")
def _(spark, sf_dir):
    return _compounds(spark, sf_dir, max_bytes=0)


@query(
    "q5a_compound_sentiment_with_rules",
    f"{TR}, {RULED_TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total",
)
def _(spark, sf_dir):
    return _compounds(spark, sf_dir, long_words, **RULES)


# The first two and the first three words of each text of ``benchmark``, where these are words in small letters.
PHRASE_SQL = """select phrase, cast(length(phrase) % 7 - 3 as double) as valence from (
      select distinct regexp_extract(lower(text), '^[a-z]+ [a-z]+', 0) as phrase from {benchmark}
      union select distinct regexp_extract(lower(text), '^[a-z]+ [a-z]+ [a-z]+', 0) as phrase from {benchmark}) x
    where phrase <> ''"""
PHRASED_TOTALS = f"""tok as ({tokens_sql(BOTH)}),
    phr as ({PHRASE_SQL.format(benchmark="benchmark")}),
    ent as (select doc_id, ix as place, 1 as n, valence as v from tok join lex using (word)
      union all select a.doc_id, a.ix, 2, valence from tok a join tok b on b.doc_id = a.doc_id and b.ix = a.ix + 1
        join phr on phrase = concat(a.word, ' ', b.word)
      union all select a.doc_id, a.ix, 3, valence from tok a join tok b on b.doc_id = a.doc_id and b.ix = a.ix + 1
        join tok c on c.doc_id = a.doc_id and c.ix = a.ix + 2 join phr on phrase = concat(a.word, ' ', b.word, ' ', c.word)),
    fold as (select doc_id, list_reduce(list(struct_pack(place := place::bigint, n := n::bigint, v := v) order by place, n desc),
        lambda a, x: case when x.place >= a.place then struct_pack(place := x.place + x.n, n := 0::bigint, v := a.v + x.v) else a end,
        struct_pack(place := 0::bigint, n := 0::bigint, v := 0::double)).v as s from ent group by doc_id),
    total as (select r.doc_id, coalesce(s, 0) as s from r left join fold using (doc_id))"""
CONTRAST_TOTALS = f"""tok as ({tokens_sql(BOTH)}),
    turn as (select doc_id, min(ix) as turn from tok where word = 'and' group by 1),
    total as (select doc_id, coalesce(sum(valence * case when ix < turn then 0.5e0 when ix > turn then 1.5e0 else 1 end), 0) as s
      from tok left join turn using (doc_id) left join lex using (word) group by doc_id)"""
EMPHASIS_TOTALS = f"""raw as (select doc_id, t, string_split_regex(t, '[{SPACE}]+') as ws from ({BOTH})),
    tone as (select doc_id, len(list_filter(ws, lambda w: w = upper(w) and w <> lower(w))) < len(ws) as mixed,
      least(length(t) - length(replace(t, '!', '')), 4) * 0.292e0 + case when length(t) - length(replace(t, '?', '')) > 3 then 0.96e0
        when length(t) - length(replace(t, '?', '')) > 1 then (length(t) - length(replace(t, '?', ''))) * 0.18e0 else 0 end as marks
      from raw),
    cased as (select doc_id, ix, w from (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as ix from raw)),
    tok as ({tokens_sql(BOTH)}),
    sums as (select doc_id, coalesce(sum(valence + case when mixed and w = upper(w) and w <> lower(w) then sign(valence) * 0.733e0 else 0 end), 0) as s
      from tok join cased using (doc_id, ix) join tone using (doc_id) left join lex using (word) group by doc_id),
    total as (select doc_id, s + sign(s) * marks as s from sums join tone using (doc_id))"""


def _phrases(spark, sf_dir):
    return spark.sql(PHRASE_SQL, benchmark=table(spark, sf_dir, "benchmark"))


@query("q5a_compound_sentiment_of_phrases", f"{TR}, {PHRASED_TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total")
def _(spark, sf_dir):
    return _compounds(spark, sf_dir, phrases=_phrases(spark, sf_dir))


@query("q5a_compound_sentiment_with_contrast", f"{TR}, {CONTRAST_TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total")
def _(spark, sf_dir):
    return _compounds(spark, sf_dir, contrast=["and"])


@query("q5a_compound_sentiment_with_emphasis", f"{TR}, {EMPHASIS_TOTALS} select doc_id, round({COMPOUND}, 6) as compound from total")
def _(spark, sf_dir):
    return _compounds(spark, sf_dir, emphasis=True)


def seasonal_sql(totals: str) -> str:
    return f"""{TR}, {totals},
    sea as (select Hotel_Name, Hotel_Address, case when month(Review_Date) in (12, 1, 2) then 'Winter'
      when month(Review_Date) in (3, 4, 5) then 'Spring' when month(Review_Date) in (6, 7, 8) then 'Summer'
      else 'Autumn' end as Season, avg({COMPOUND}) as avg_sentiment,
      avg(Reviewer_Score) as avg_reviewer_score, count(*) as review_count
      from r join total using (doc_id) group by 1, 2, 3)"""


SEASONAL, RULED_SEASONAL = seasonal_sql(TOTALS), seasonal_sql(RULED_TOTALS)
SEASONS = "select * replace (round(avg_sentiment, 6) as avg_sentiment) from sea"


def _seasonal(spark, sf_dir):
    return sentiment.seasonal_sentiment(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), TEXT, **PLAIN)


def _ruled_seasonal(spark, sf_dir):
    return sentiment.seasonal_sentiment(text_reviews(spark, sf_dir), long_words(spark, sf_dir), TEXT, **RULES)


@query("q5_seasonal_sentiment", f"{SEASONAL} {SEASONS}")
def _(spark, sf_dir):
    return rounded(_seasonal(spark, sf_dir), "avg_sentiment")


@query("q5_seasonal_sentiment_with_rules", f"{RULED_SEASONAL} {SEASONS}")
def _(spark, sf_dir):
    return rounded(_ruled_seasonal(spark, sf_dir), "avg_sentiment")


@query("q5c_entities_in_city", f"{SEASONAL} select distinct Hotel_Name from sea where contains(Hotel_Address, 'fr')")
def _(spark, sf_dir):
    return sentiment.entities_in_city(_seasonal(spark, sf_dir), "fr")


@query(
    "q5c_entity_seasons",
    f"""{SEASONAL} select * replace (round(avg_sentiment, 6) as avg_sentiment) from sea
    where contains(Hotel_Address, 'fr') and Hotel_Name = 'src7'""",
)
def _(spark, sf_dir):
    in_city = sentiment.seasons_in_city(_seasonal(spark, sf_dir), "fr")
    return rounded(in_city.filter(F.col("Hotel_Name") == "src7"), "avg_sentiment")


YEARLY = """y as (select Hotel_Name, avg(avg_sentiment) as year_sentiment, avg(avg_reviewer_score) as year_score
      from sea group by 1)
    select Hotel_Name, round(year_sentiment, 6) as year_sentiment, round(year_score, 6) as year_score,
      case when year_sentiment >= 0.4 then 'Positivo' when year_sentiment < 0 then 'Negativo' else 'Neutrale' end as label
    from y"""


@query("q5d_yearly_sentiment", f"{SEASONAL}, {YEARLY}")
def _(spark, sf_dir):
    return rounded(sentiment.yearly_sentiment(_seasonal(spark, sf_dir)), "year_sentiment", "year_score")


@query("q5d_yearly_sentiment_with_rules", f"{RULED_SEASONAL}, {YEARLY}")
def _(spark, sf_dir):
    return rounded(sentiment.yearly_sentiment(_ruled_seasonal(spark, sf_dir)), "year_sentiment", "year_score")


# --- review and entity sentiment -----------------------------------------------------------------------


def plain_sql(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), 'http[^{SPACE}]+|www[^{SPACE}]+|https[^{SPACE}]+', '', 'g')"
    out = f"regexp_replace({out}, '<[^\\n]*?>', '', 'g')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}_{SPACE}]', '', 'g')"
    out = f"regexp_replace({out}, '\\p{{Nd}}+', '', 'g')"
    return f"case when lower({text}) in ('no negative', 'no positive') then '' else {out} end"


def normalised_sql(source: str) -> str:
    """(doc_id, side, t) of ``source`` with t plain, without stop words, and in lemmas; no row where nothing is left."""
    return f"""select doc_id, side, string_agg(coalesce(lemma, form), ' ' order by ix) as t
      from (select doc_id, side, unnest(ws) as form, generate_subscripts(ws, 1) as ix
        from (select doc_id, side, string_split_regex({plain_sql("t")}, '[{SPACE}]+') as ws from ({source})))
      left join lex on word = form where form not in ('', 'the', 'of', 'and') group by 1, 2"""


def judged_sql(text: str, empty: str) -> str:
    bare = f"lower(regexp_replace(coalesce({text}, ''), '^[{SPACE}]+|[{SPACE}]+$', '', 'g'))"
    return f"case when {bare} in ({empty}) then '' else {bare} end"


STRONG = ("and", "that", "with")
STRONG_SQL = "[" + ", ".join(f"'{word}'" for word in STRONG) + "]"


def review_rule_sql(classes: str) -> str:
    """``cl(doc_id, Hotel_Name, v)`` from ``classes``, a query for (doc_id, pc, nc) over ``j``."""
    return f"""j as (select doc_id, Hotel_Name, {judged_sql("Positive_Review", "'no positive'")} as p,
        {judged_sql("Negative_Review", "'nothing', 'none', 'no negative'")} as n from r),
    cls as ({classes}),
    f as (select j.doc_id, Hotel_Name, pc, nc, length(p) as pl, length(n) as nl,
        list_has_any(string_split_regex(p, '[{SPACE}]+'), {STRONG_SQL}) as ps,
        list_has_any(string_split_regex(n, '[{SPACE}]+'), {STRONG_SQL}) as ns from j join cls using (doc_id)),
    m as (select *, pc * (greatest(pl, 1) / cast(greatest(pl, 1) + greatest(nl, 1) as double))
        + nc * (greatest(nl, 1) / cast(greatest(pl, 1) + greatest(nl, 1) as double)) as mix from f),
    cl as (select doc_id, Hotel_Name, cast(case when ns and not ps then -1 when ps and not ns then 1
        when pl > 0 and nl = 0 then pc when nl > 0 and pl = 0 then nc
        when mix > 0.3 then 1 when mix < -0.3 then -1 else 0 end as integer) as v from m)"""


LEXICON_SIDES = f"""select doc_id, 'p' as side, {plain_sql("p")} as t from j
    union all select doc_id, 'n' as side, {plain_sql("n")} as t from j"""
LEXICON_CLASSES = f"""select doc_id, max(c) filter (where side = 'p') as pc, max(c) filter (where side = 'n') as nc
    from (select doc_id, side, case when {COMPOUND} >= 0.05 then 1 when {COMPOUND} <= -0.05 then -1 else 0 end as c
      from (select doc_id, side, coalesce(sum(valence), 0) as s from ({tokens_sql(LEXICON_SIDES, punctuated=False)})
        left join lex using (word) group by 1, 2)) group by doc_id"""
LENGTH_CLASSES = f"""select doc_id,
      case when p = '' then 0 else length({plain_sql("p")}) % 3 - 1 end as pc,
      case when n = '' then 0 else length({plain_sql("n")}) % 3 - 1 end as nc from j"""
JUDGED_SIDES = "select doc_id, 'p' as side, p as t from j union all select doc_id, 'n' as side, n as t from j"
LEMMA_CLASSES = f"""select j.doc_id, coalesce(max(c) filter (where side = 'p'), 0) as pc,
      coalesce(max(c) filter (where side = 'n'), 0) as nc from j left join
      (select doc_id, side, case when {COMPOUND} >= 0.05 then 1 when {COMPOUND} <= -0.05 then -1 else 0 end as c
       from (select doc_id, side, coalesce(sum(valence), 0) as s from ({tokens_sql(normalised_sql(JUDGED_SIDES), punctuated=False)})
         left join lex using (word) group by 1, 2)) using (doc_id) group by 1"""
LEMMA_LENGTH_CLASSES = f"""select j.doc_id, case when any_value(p) = '' then 0 else
        coalesce(max(length(t)) filter (where side = 'p'), 0) % 3 - 1 end as pc,
      case when any_value(n) = '' then 0 else coalesce(max(length(t)) filter (where side = 'n'), 0) % 3 - 1 end as nc
      from j left join ({normalised_sql(JUDGED_SIDES)}) using (doc_id) group by 1"""
CLASS_NAME = "case when v > 0 then 'positive' when v < 0 then 'negative' else 'neutral' end"
ENTITY_LABEL = """case when a is null then 'Nessuna recensione' when a > 0.2 and a < 0.4 then 'Piuttosto Positivo'
    when a >= 0.4 then 'Molto Positivo' when a < -0.2 and a > -0.3 then 'Piuttosto Negativo'
    when a <= -0.4 then 'Molto Negativo' else 'Neutrale' end"""


def _by_lexicon(spark, sf_dir):
    return sentiment.review_sentiment(text_reviews(spark, sf_dir), lexicon(spark, sf_dir), STRONG, TEXT)


@query("q9a_plain_text", f"{TR} select doc_id, {plain_sql('Positive_Review')} as p, {plain_sql('Negative_Review')} as n from r")
def _(spark, sf_dir):
    df = text_reviews(spark, sf_dir)
    return df.select("doc_id", plain_text(F.col("Positive_Review")).alias("p"), plain_text(F.col("Negative_Review")).alias("n"))


STOP_WORDS = ["the", "of", "and"]


SIDES = """select doc_id, 'p' as side, Positive_Review as t from r union all
    select doc_id, 'n' as side, Negative_Review as t from r"""


@query(
    "q9a_normalised_text",
    f"""{TR}, n as ({normalised_sql(SIDES)})
    select r.doc_id, coalesce(max(t) filter (where side = 'p'), '') as Positive_Review,
      coalesce(max(t) filter (where side = 'n'), '') as Negative_Review from r left join n using (doc_id) group by 1""",
)
def _(spark, sf_dir):
    df, lex = text_reviews(spark, sf_dir), lexicon(spark, sf_dir)
    return sentiment.normalised_texts(df, ["Positive_Review", "Negative_Review"], STOP_WORDS, lex, TEXT)


# Long words of the lexicon stand for two: their first four letters, of which some are stop words, and the rest.
SPLIT_SQL = """splits as (select word as form, [substring(word, 1, 4), substring(word, 5)] as pieces from lex where length(word) >= 7)"""


@query(
    "q9a_normalised_split_forms",
    f"""{TR}, {SPLIT_SQL},
    w as (select doc_id, side, unnest(ws) as form, generate_subscripts(ws, 1) as ix
      from (select doc_id, side, string_split_regex({plain_sql("t")}, '[{SPACE}]+') as ws from ({SIDES}))),
    x as (select doc_id, side, ix, unnest(coalesce(pieces, [w.form])) as form,
        generate_subscripts(coalesce(pieces, [w.form]), 1) as sub from w left join splits on splits.form = w.form where w.form <> ''),
    n as (select doc_id, side, string_agg(coalesce(lemma, form), ' ' order by ix, sub) as t from x left join lex on word = form
      where form not in ('the', 'of', 'and', 'stat') group by 1, 2)
    select r.doc_id, coalesce(max(t) filter (where side = 'p'), '') as Positive_Review,
      coalesce(max(t) filter (where side = 'n'), '') as Negative_Review from r left join n using (doc_id) group by 1""",
)
def _(spark, sf_dir):
    df, lex = text_reviews(spark, sf_dir), lexicon(spark, sf_dir)
    splits = lex.filter("length(word) >= 7").selectExpr("word as form", "array(substring(word, 1, 4), substring(word, 5)) as words")
    stop = [*STOP_WORDS, "stat"]
    return sentiment.normalised_texts(df, ["Positive_Review", "Negative_Review"], stop, lex, TEXT, splits=splits)


@query(
    "q9b_review_sentiment",
    f"""{TR}, {review_rule_sql(LEXICON_CLASSES)}
    select doc_id, Hotel_Name, v as sentiment_value, {CLASS_NAME} as sentiment from cl""",
)
def _(spark, sf_dir):
    return _by_lexicon(spark, sf_dir)


@query(
    "q9b_review_sentiment_of_lemmas",
    f"""{TR}, {review_rule_sql(LEMMA_CLASSES)}
    select doc_id, Hotel_Name, v as sentiment_value, {CLASS_NAME} as sentiment from cl""",
)
def _(spark, sf_dir):
    df, lex = text_reviews(spark, sf_dir), lexicon(spark, sf_dir)
    return sentiment.review_sentiment(df, lex, STRONG, TEXT, STOP_WORDS, lex)


def load_length_model():
    """A model whose classes SQL can state: the length of the text modulo 3."""
    return lambda texts: texts.str.len() % 3 - 1


@query(
    "q9c_model_sentiment",
    f"""{TR}, {review_rule_sql(LENGTH_CLASSES)}
    select doc_id, Hotel_Name, v as sentiment_value, {CLASS_NAME} as sentiment from cl""",
)
def _(spark, sf_dir):
    return sentiment.model_sentiment(text_reviews(spark, sf_dir), load_length_model, STRONG, TEXT)


def load_token_counter():
    """A tokenizer that SQL can state: a token for every four characters of a word, or part of them."""
    return lambda words: [-(-len(word) // 4) for word in words]


def cut_class_sql(text: str) -> str:
    """Class of a text by its length after it was cut to 100 tokens."""
    return f"""case when {text} = '' or fits = 0 and n > 0 then 0 when fits = n then length(plain) % 3 - 1 else kept % 3 - 1 end"""


CUT_CLASSES = f"""select doc_id, max(c) filter (where side = 'p') as pc, max(c) filter (where side = 'n') as nc from (
      select doc_id, side, {cut_class_sql("raw")} as c from (
        select doc_id, side, raw, plain, count(w) as n, count(w) filter (where total <= 100) as fits,
          cast(coalesce(sum(length(w) + 1) filter (where total <= 100), 1) - 1 as bigint) as kept
        from (select *, sum((length(w) + 3) // 4) over (partition by doc_id, side order by ix) as total from (
            select doc_id, side, raw, plain, unnest(ws) as w, generate_subscripts(ws, 1) as ix
            from (select *, case when len(list_filter(string_split_regex(plain, '[{SPACE}]+'), lambda x: x <> '')) = 0 then [null]
                else list_filter(string_split_regex(plain, '[{SPACE}]+'), lambda x: x <> '') end as ws
              from (select doc_id, 'p' as side, p as raw, {plain_sql("p")} as plain from j
                union all select doc_id, 'n', n, {plain_sql("n")} from j))))
        group by doc_id, side, raw, plain)) group by doc_id"""


@query(
    "q9c_model_sentiment_within_tokens",
    f"""{TR}, {review_rule_sql(CUT_CLASSES)}
    select doc_id, Hotel_Name, v as sentiment_value, {CLASS_NAME} as sentiment from cl""",
)
def _(spark, sf_dir):
    df = text_reviews(spark, sf_dir)
    return sentiment.model_sentiment(df, load_length_model, STRONG, TEXT, load_counter=load_token_counter, most_tokens=100)


@query(
    "q9c_model_sentiment_of_lemmas",
    f"""{TR}, {review_rule_sql(LEMMA_LENGTH_CLASSES)}
    select doc_id, Hotel_Name, v as sentiment_value, {CLASS_NAME} as sentiment from cl""",
)
def _(spark, sf_dir):
    df, lex = text_reviews(spark, sf_dir), lexicon(spark, sf_dir)
    return sentiment.model_sentiment(df, load_length_model, STRONG, TEXT, STOP_WORDS, lex)


@query(
    "q9d_entity_sentiment",
    f"""{TR}, {review_rule_sql(LEXICON_CLASSES)}
    select Hotel_Name, round(a, 6) as mean_sentiment, {ENTITY_LABEL} as label
    from (select Hotel_Name, avg(v) as a from cl group by 1)""",
)
def _(spark, sf_dir):
    return rounded(sentiment.entity_sentiment(_by_lexicon(spark, sf_dir)), "mean_sentiment")


@query(
    "q9d_label_of_entity",
    f"""{TR}, {review_rule_sql(LEXICON_CLASSES)}
    select 'src7' as Hotel_Name, {ENTITY_LABEL} as label from (select avg(v) as a from cl where Hotel_Name = 'src7')""",
)
def _(spark, sf_dir):
    return sentiment.label_of_entity(_by_lexicon(spark, sf_dir), "src7")


# --- summaries -----------------------------------------------------------------------------------------

PICKED = f"""{TR}, pk as (select * from (select *, row_number() over (partition by Hotel_Name
      order by Total_Number_of_Reviews_Reviewer_Has_Given, doc_id) as place
      from r where Positive_Review <> 'No Positive' and Negative_Review <> 'No Negative') where place <= 50)"""


@query("q10a_summary_reviews", f"{PICKED} select Hotel_Name, doc_id, place from pk")
def _(spark, sf_dir):
    return summary.summary_reviews(text_reviews(spark, sf_dir), c=TEXT).select("Hotel_Name", "doc_id", "place")


CORPUS = "string_agg(concat(Positive_Review, ' ; ', Negative_Review, '. '), '' order by place) as corpus"


@query("q10b_corpus", f"{PICKED} select Hotel_Name, {CORPUS} from pk group by 1")
def _(spark, sf_dir):
    return summary.corpus(summary.summary_reviews(text_reviews(spark, sf_dir), c=TEXT), TEXT)


def unnamed(df):
    """One entity without a name, which summaries must not lose."""
    return df.withColumn("Hotel_Name", F.expr("nullif(Hotel_Name, 'src3')"))


@query(
    "q10c_extractive_summary",
    f"""{PICKED.replace("source as Hotel_Name", "nullif(source, 'src3') as Hotel_Name")},
    lines as (select Hotel_Name, place, 1 as side, regexp_extract_all(Positive_Review, '[^.!?\\n]+') as l from pk
      union all select Hotel_Name, place, 2 as side, regexp_extract_all(Negative_Review, '[^.!?\\n]+') as l from pk),
    sent as (select *, regexp_extract_all(lower(sentence), '\\p{{L}}+') as ws
      from (select Hotel_Name, place, side, generate_subscripts(l, 1) as ix, trim(unnest(l)) as sentence from lines)),
    kept as (select *, count(*) over (partition by Hotel_Name) as n from sent where len(ws) > 0),
    tok as (select Hotel_Name, place, side, ix, n, len(ws) as ln, unnest(ws) as word from kept),
    cnt as (select Hotel_Name, place, side, ix, n, ln, word, count(*) as tf from tok group by all),
    wt as (select *, tf / cast(ln as double) * ln(n / cast(count(*) over (partition by Hotel_Name, word) as double)) as w
      from cnt),
    sw as (select Hotel_Name, place, side, ix, round(sum(w), 6) as weight from wt group by all),
    top as (select *, row_number() over (partition by Hotel_Name order by weight desc, place, side, ix) as rk from sw)
    select Hotel_Name, string_agg(sentence, '. ' order by place, side, ix) as summary
    from (select top.*, sentence from top join sent on top.Hotel_Name is not distinct from sent.Hotel_Name
      and top.place = sent.place and top.side = sent.side and top.ix = sent.ix) where rk <= 3 group by 1""",
)
def _(spark, sf_dir):
    return summary.extractive_summary(unnamed(text_reviews(spark, sf_dir)), c=TEXT)


@query(
    "q10c_model_summary",
    f"{PICKED} select Hotel_Name, md5(corpus) as digest from (select Hotel_Name, {CORPUS} from pk group by 1)",
)
def _(spark, sf_dir):
    corpora = summary.corpus(summary.summary_reviews(text_reviews(spark, sf_dir), c=TEXT), TEXT)

    def load():  # a model whose answers SQL can state: some reasoning, then the text itself
        return lambda texts: "<think>read it all</think>" + texts

    return corpora.select("Hotel_Name", F.md5(summary.model_summary(F.col("corpus"), load)).alias("digest"))


@query(
    "q10d_without_reasoning",
    f"{TR} select doc_id, md5(concat(Positive_Review, Negative_Review)) as digest from r",
)
def _(spark, sf_dir):
    answer = F.concat(F.col("Positive_Review"), F.lit("<think>"), F.reverse("Negative_Review"), F.lit("</think>"), F.col("Negative_Review"))
    return text_reviews(spark, sf_dir).select("doc_id", F.md5(without_reasoning(answer)).alias("digest"))
