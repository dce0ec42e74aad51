"""Review-shaped relations over the driver's tables.

A relation is built with the columns a query asks for and only the dimension joins those columns need, the
same way for Spark and for the oracle. ``{S}`` is the text type of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import POINTS_OF_INTEREST
from guestbook.functions.parsing import tag_list
from guestbook.schema import Columns

STAR = Columns(key=("l_orderkey", "l_linenumber", "l_partkey"))
TEXT = Columns(key=("doc_id",))

# Joins a column may need, in join order: alias -> (table, condition, aliases it depends on).
STAR_JOINS = {
    "o": ("orders", "l.l_orderkey = o.o_orderkey", ()),
    "c": ("customer", "o.o_custkey = c.c_custkey", ("o",)),
    "cn": ("nation", "c.c_nationkey = cn.n_nationkey", ("o", "c")),
    "s": ("supplier", "l.l_suppkey = s.s_suppkey", ()),
    "sn": ("nation", "s.s_nationkey = sn.n_nationkey", ("s",)),
    "sr": ("region", "sn.n_regionkey = sr.r_regionkey", ("s", "sn")),
    "p": ("part", "l.l_partkey = p.p_partkey", ()),
}

QUOTE = "chr(39)"

# Columns of the star relation: name -> (expression, joins it needs). One row per lineitem, one entity per
# supplier. Scores are exact binary fractions, so that sums do not depend on their order.
STAR_COLUMNS = {
    "Hotel_Name": ("s.s_name", ("s",)),
    "Hotel_Address": (
        "concat(s.s_name, ' arr ', cast(s.s_suppkey as {S}), ' ', sr.r_name)",
        ("s", "sn", "sr"),
    ),
    "Review_Date": ("cast(l.l_shipdate as date)", ()),
    "Review_Date_Raw": (
        "concat(cast(month(l.l_shipdate) as {S}), '/', cast(day(l.l_shipdate) as {S}), '/',"
        " cast(year(l.l_shipdate) as {S}))",
        (),
    ),
    "Reviewer_Nationality": ("case when cn.n_nationkey = 7 then ' ' else cn.n_name end", ("o", "c", "cn")),
    "Reviewer_Score": (
        "cast(case when l.l_quantity <= 2 then 2.5 when l.l_quantity <= 6 then 5.0 when l.l_quantity <= 20 then 8.0"
        " when l.l_quantity <= 38 then 9.0 else 10.0 end as double)",
        (),
    ),
    "Reviewer_Score_Raw": ("case when l.l_linenumber = 3 then 'NA' else cast(cast(l.l_quantity as int) as {S}) end", ()),
    "Tags_Raw": (
        f"concat('[', {QUOTE}, ' ', p.p_type, ' ', {QUOTE}, ', ', {QUOTE}, ' ', p.p_brand, ' ', {QUOTE}, ', ',"
        f" {QUOTE}, ' ', o.o_orderpriority, ' ', {QUOTE}, ']')",
        ("o", "p"),
    ),
    "days_since_review_raw": ("concat(cast(l.l_linenumber as {S}), ' days')", ()),
    "Review_Total_Positive_Word_Counts": ("cast(l.l_quantity as int) % 7", ()),
    "Review_Total_Negative_Word_Counts": ("l.l_linenumber % 3", ()),
    "Positive_Review": ("concat('part ', cast(l.l_partkey as {S}))", ()),
    "Negative_Review": ("concat('line ', cast(l.l_linenumber as {S}))", ()),
    "lat": (
        "case when s.s_suppkey % 10 = 3 then null"
        " else cast(45.455 as double) + (s.s_suppkey % 50) * cast(0.001 as double) end",
        ("s",),
    ),
    "lng": (
        "case when s.s_suppkey % 10 = 3 then null"
        " else cast(9.18 as double) + (s.s_suppkey % 20) * cast(0.002 as double) end",
        ("s",),
    ),
    "l_orderkey": ("l.l_orderkey", ()),
    "l_linenumber": ("l.l_linenumber", ()),
    "l_partkey": ("l.l_partkey", ()),
}

STAR_KEY = STAR.key

GAZETTEER_SQL = """
select concat(s.s_name, ' Arrondissement ', cast(s.s_suppkey as {S}), ' ', r.r_name) as address,
  cast(45.455 as double) + (s.s_suppkey % 50) * cast(0.001 as double) as g_lat,
  cast(9.18 as double) + (s.s_suppkey % 20) * cast(0.002 as double) as g_lng
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey join {region} r on n.n_regionkey = r.r_regionkey
where s.s_suppkey % 10 = 3 and s.s_suppkey % 20 <> 13
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star_joins(columns: tuple[str, ...]) -> list[str]:
    """Aliases of the joins the columns need, in join order."""
    needed = {alias for name in columns for alias in STAR_COLUMNS[name][1]}
    needed |= {alias for name in needed for alias in STAR_JOINS[name][2]}
    return [alias for alias in STAR_JOINS if alias in needed]


def star_sql(columns: tuple[str, ...], text: str, quote: str = "{}") -> str:
    """The star relation as SQL; ``quote`` is how the engine refers to a table of a name."""
    joins = " ".join(
        f"join {quote.format(STAR_JOINS[alias][0])} {alias} on {STAR_JOINS[alias][1]}" for alias in star_joins(columns)
    )
    fields = ", ".join(f"{STAR_COLUMNS[name][0]} as {name}" for name in columns).replace("{S}", text)
    return f"select {fields} from {quote.format('lineitem')} l {joins}"


def reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Star relation with the given columns. ``Tags`` is the parsed form of ``Tags_Raw``."""
    wanted = tuple(dict.fromkeys("Tags_Raw" if name == "Tags" else name for name in columns))
    sources = {STAR_JOINS[alias][0]: None for alias in star_joins(wanted)}
    sources = {name: table(spark, sf_dir, name) for name in sources}
    sources["lineitem"] = table(spark, sf_dir, "lineitem")
    out = spark.sql(star_sql(wanted, "string", "{{{}}}"), **sources)
    if "Tags" in columns:
        out = out.select(*[tag_list(F.col("Tags_Raw")).alias("Tags") if n == "Tags" else F.col(n) for n in columns])
    return out


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("supplier", "nation", "region")
    sql = GAZETTEER_SQL.replace("{S}", "string")
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews over ``documents``: the whole text of each document, its lines going in turn to the positive
    and the negative side; every 11th document is all negative, every other 7th all positive."""
    lines = "split(text, '\\n')"
    odd = f"array_join(filter({lines}, (x, i) -> i % 2 = 0), '\\n')"
    even = f"array_join(filter({lines}, (x, i) -> i % 2 = 1), '\\n')"
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "source as Hotel_Name",
        "concat(source, ' ', lang) as Hotel_Address",
        "date_add(date'2016-01-01', cast(doc_id % 365 as int)) as Review_Date",
        "cast(2.5 as double) + (doc_id % 16) * cast(0.5 as double) as Reviewer_Score",
        f"case when doc_id % 11 = 0 then 'No Positive' when doc_id % 7 = 0 then text else {odd} end as Positive_Review",
        f"case when doc_id % 11 = 0 then text when doc_id % 7 = 0 or {even} = '' then 'No Negative'"
        f" else {even} end as Negative_Review",
        "(doc_id * 13) % 97 as Total_Number_of_Reviews_Reviewer_Has_Given",
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the sentiment, part-of-speech and lemma dictionaries: the words of ``benchmark``."""
    return (
        table(spark, sf_dir, "benchmark")
        .selectExpr("explode(split(lower(text), '\\\\s+')) as word")
        .filter("word <> ''")
        .distinct()
        .selectExpr(
            "word",
            "cast(length(word) % 9 - 4 as double) as valence",
            "case length(word) % 4 when 0 then 'a' when 1 then 'r' when 2 then 's' else 'n' end as pos",
            "word as form",
            "substring(word, 1, 3) as lemma",
        )
    )


def poi_values_sql() -> str:
    rows = ", ".join(
        "('{}', cast({!r} as double), cast({!r} as double), '{}')".format(name.replace("'", "''"), lat, lng, city)
        for name, lat, lng, city in POINTS_OF_INTEREST
    )
    return f"select * from (values {rows}) as poi(Monument, poi_lat, poi_lng, City)"
