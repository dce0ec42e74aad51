"""The operators of this subpackage over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.llm import byte_bpe, chat, divergence, exact, language, lines, mixing, multi_index, packing, simhash, token_counts, token_files, vector_codes
from guestbook.shared import new_table_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(run):
        LLM_QUERIES[name] = run
        if sql is not None:
            LLM_ORACLES[name] = sql
        return run

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


OP2_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256,
    2 * doc_id < (select max(doc_id) from documents) as old
  from documents
), g as (
  select text_sha256, count(*) as group_size, bool_or(old) as in_history,
    first(doc_id order by n desc, doc_id) as keep_id
  from d group by text_sha256
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256, in_history from d join g using (text_sha256)
"""


@_query("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the ids is the history, the younger half arrives."""
    docs = _documents(spark, sf_dir)
    last = docs.agg(F.max("doc_id")).first()[0] or 0
    return exact.exact_duplicates(docs, F.col("doc_id") * 2 < last)


@_query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


@_query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to the shared folder and read back."""
    folder = new_table_path(spark, "token-files")
    token_files.write_tokens(_documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, folder)


@_query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of(_documents(spark, sf_dir))


OP7_SQL = r"""
with raw as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as k
  from documents
), cut as (
  select doc_id, k, line, regexp_replace(line, '^[ \t\n\r\v\f]+|[ \t\n\r\v\f]+$', '', 'g') as bare from raw
), solid as (
  select doc_id, k, bare, row_number() over (partition by doc_id order by k) as pos,
    greatest(len(regexp_split_to_array(bare, '[ \t\n\r\v\f]+')), strlen(bare) // 16) as words
  from cut where bare <> ''
), runs as (
  select doc_id, pos, 1 as len, words, [bare] as content from solid
  union all
  select a.doc_id, a.pos, n.len, a.words + b.words + coalesce(c.words, 0) + coalesce(d.words, 0),
    list_filter([a.bare, b.bare, c.bare, d.bare], lambda x: x is not null)
  from solid a cross join (values (2), (3), (4)) n(len)
  join solid b on b.doc_id = a.doc_id and b.pos = a.pos + 1
  left join solid c on c.doc_id = a.doc_id and c.pos = a.pos + 2 and n.len >= 3
  left join solid d on d.doc_id = a.doc_id and d.pos = a.pos + 3 and n.len = 4
  where (n.len < 3 or c.pos is not null) and (n.len < 4 or d.pos is not null)
), later as (
  select doc_id, pos, len from (
    select doc_id, pos, len, row_number() over (partition by content order by doc_id, pos) as copy from runs where words >= 4
  ) where copy > 1
), gone as (
  select distinct f.doc_id, f.k from solid f join later l on f.doc_id = l.doc_id and f.pos >= l.pos and f.pos < l.pos + l.len
), counted as (
  select c.doc_id, count(*) filter (where c.bare <> '') as n_lines, count(g.k) as n_removed,
    string_agg(c.line, chr(10) order by c.k) filter (where g.k is null) as text
  from cut c left join gone g on c.doc_id = g.doc_id and c.k = g.k group by c.doc_id
)
select doc_id, case when n_removed < n_lines then text else '' end as text, n_lines, n_removed, n_removed < n_lines as kept
from counted
"""


@_query("op7_line_dedup", OP7_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated runs of lines with four words or more, where a line has a word for
    each 16 bytes at least."""
    return lines.without_repeated_lines(_documents(spark, sf_dir).select("doc_id", "text"), word_bytes=16)


@_query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trips(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


OP1_SQL = """
with recursive v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
), u as (
  select r, vec_id, case when e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and list_max(list_transform(e, lambda x: abs(x))) > 0 then e end as e from v
), links as (
  select a.r as a, b.r as b from u a join u b on a.r <> b.r and len(a.e) = len(b.e)
  where list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95
), reached as (
  select r as a, r as b from u union select reached.a, links.b from reached join links on reached.b = links.a
), least as (
  select reached.a as r, min(u.vec_id) as component_id from reached join u on u.r = reached.b group by reached.a
)
select u.vec_id, (select count(*) from links where links.a = u.r) as n_links, component_id, u.vec_id = component_id as kept
from u join least using (r)
"""


@_query("op1_multi_index", OP1_SQL)
def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query("op5_source_mix")
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, one by one, when sources are weighted by the square roots of their sizes."""
    return mixing.mixed(_documents(spark, sf_dir).select("doc_id", "source"), block_rows=1)


# Tools that the conversations are read as using: every user turn is a call, every assistant turn answers the
# call of the turn before.
TOOLS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "to": {"enum": ["de", "en", "es", "fr"]}},
        "required": ["text", "to"],
        "additionalProperties": False,
    },
}


def tool_traffic(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results out of user and assistant turns, by the lengths of their texts.

    Some calls need the next one, some the one before; some limits are out of range, some targets no choice.
    """
    length = F.length("text")
    name_of = lambda turn: F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), turn)
    turn = F.col("turn")
    search = F.to_json(F.struct(F.col("text").alias("query"), (length % 60).alias("limit")))
    target = F.element_at(F.array(*[F.lit(x) for x in ("de", "en", "es", "fr", "xx")]), (length % 5 + 1).cast("int"))
    translate = F.to_json(F.struct(F.col("text").alias("text"), target.alias("to")))
    needs = F.when(length % 4 == 0, F.array(name_of(turn + 2))).when(length % 4 == 1, F.array(name_of(turn - 2)))
    calls = conversations.filter("role = 'user'").select(
        "conv_id",
        "turn",
        name_of(turn).alias("call_id"),
        F.when(length % 2 == 0, "search").otherwise("translate").alias("name"),
        F.when(length % 2 == 0, search).otherwise(translate).alias("arguments"),
        F.coalesce(needs, F.array().cast("array<string>")).alias("needs"),
    )
    answers = conversations.filter("role = 'assistant'")
    return calls, answers.select("conv_id", name_of(turn - 1).alias("call_id"), F.col("text").alias("content"))


@_query("op3_chat_format")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with its tool calls linked, ordered, validated and written as canonical JSON."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = tool_traffic(conversations)
    return chat.chats(conversations.filter("role is null or role not in ('user', 'assistant')"), calls, results, TOOLS)


@_query("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 tokens over all documents, with a digest of every piece."""
    return packing.digested(packing.packed(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


OP11_SQL = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), t as (
  select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), kept as (
  select lang, term from t group by lang, term having count(distinct doc) >= 30
), sizes as (
  select lang, count(k.term) as v from (select distinct lang from d) left join kept k using (lang) group by lang
), found as (
  select lang, source, term, count(*) as n from t join kept using (lang, term) group by lang, source, term
), grouped as (
  select g.lang, g.source, coalesce(sum(f.n), 0) as n_group
  from (select distinct lang, source from d) g left join found f on f.lang = g.lang and f.source = g.source group by g.lang, g.source
), share as (
  select g.lang, g.source, k.term, coalesce(f.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(f.n, 0) + 5)) // (g.n_group + 5 * s.v)::hugeint as p
  from grouped g join kept k on k.lang = g.lang join sizes s on s.lang = g.lang
  left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term
), whole as (
  select f.lang, f.term, 1 + (1000000000::hugeint * (sum(f.n) + 5)) // (any_value(l.n_lang) + 5 * any_value(s.v))::hugeint as q
  from found f join sizes s on s.lang = f.lang join (select lang, sum(n_group) as n_lang from grouped group by lang) l on l.lang = f.lang
  group by f.lang, f.term
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
  from grouped a join grouped b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from share a join share b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source
  ) x on x.lang = a.lang and x.source = a.source and x.item = b.source
), items as (
  select lang, source, 'pair' as part, item, value from pairs
  union all
  select s.lang, s.source, 'term', s.term, s.p - w.q from share s join whole w on w.lang = s.lang and w.term = s.term where s.n > 0 and s.p > w.q
), ranked as (
  select lang, source, part, item, value::bigint as value,
    row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank
  from items
)
select * from ranked where part = 'pair' or rank <= 50
"""


@_query("op11_source_divergence", OP11_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and the terms that set each apart."""
    return divergence.source_divergence(_documents(spark, sf_dir))


OP13_START = """
with v as (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), x as (
  select vec_id, k // w as part, k % w as i, e[k + 1] as x
  from (select vec_id, e, len(e) // 16 as w, unnest(range(len(e))) as k from v)
), c0 as (
  select part, entry, i, x as c
  from x join (select vec_id, row_number() over (order by vec_id) - 1 as entry from v qualify entry < 64) using (vec_id)
)"""

OP13_ROUND = """, a{n} as (
  select vec_id, part, m % 1024 as entry, m // 1024 as d
  from (
    select vec_id, part, min(d * 1024 + entry) as m
    from (select vec_id, part, entry, sum((x - c) * (x - c))::bigint as d from x join c{n} using (part, i) group by vec_id, part, entry)
    group by vec_id, part
  )
)"""

OP13_MOVE = """, c{m} as (
  select part, entry, i, case when n is null then c else (s - (s % n + n) % n) // n end as c
  from c{n} left join (
    select part, entry, i, sum(x)::bigint as s, count(*) as n from a{n} join x using (vec_id, part) group by part, entry, i
  ) using (part, entry, i)
)"""

OP13_END = """, r as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a2 group by vec_id
)
select r.vec_id, r.code, r.error, (sum(r.error) over (partition by v.label))::bigint as label_error,
  (select sha256(string_agg(c::varchar, ',' order by part, entry, i)) from c2) as codebooks_sha256
from r join v using (vec_id)
"""

OP13_SQL = "".join([OP13_START, *[OP13_ROUND.format(n=n) + OP13_MOVE.format(n=n, m=n + 1) for n in range(2)], OP13_ROUND.format(n=2), OP13_END])


@_query("op13_vector_codes", OP13_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code of 16 bytes for every vector, with its error and a digest of the codebooks."""
    found, books = vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    code = F.lower(F.hex("codes")).alias("code")
    digest = F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    return vector_codes.with_label_error(found).select("vec_id", code, "error", "label_error", digest)
