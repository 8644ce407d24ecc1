"""Registered queries: titles, ids, genres, dates, numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratefuse.functions import parse, text
from ratefuse.operators import analyze, keyed, merge
from ratefuse.operators.merge import ADAPTIVE
from ratefuse.plans import derived, sql, tables
from ratefuse.plans.derived import flat
from ratefuse.plans.registry import query
from ratefuse.sources import readers
from ratefuse.sources.specs import ADAPTIVE_SPECS, STATIC_SPECS


@query(
    "title_normalize",
    f"WITH t AS (SELECT doc_id, {sql.before_dedupe('text')} AS title FROM documents),"
    f" {sql.dedupe_long('d', 't', 'doc_id', 'title')} SELECT doc_id, title FROM d",
)
def title_normalize(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select("doc_id", text.normalize_title(F.col("text")).alias("title"))


@query(
    "title_normalize_twice",
    f"WITH a AS (SELECT p_partkey, {sql.title('p_name || chr(32) || p_type || chr(32) || p_name')}"
    f" AS once FROM part) SELECT p_partkey, once, {sql.title('once')} AS twice FROM a",
)
def title_normalize_twice(spark, d):
    named = F.concat_ws(" ", "p_name", "p_type", "p_name")
    once = tables.table(spark, d, "part").select(
        "p_partkey", text.normalize_title(named).alias("once")
    )
    return once.withColumn("twice", text.normalize_title(F.col("once")))


_TRANSLIT = sql.before_dedupe("replace(text, 'ß', 'ss')", the_first=True)
_LISTED = sql.before_dedupe("text", punct=r"[!-/:-@\[-`{-~]")
_KEPT = sql.before_dedupe("text", the=" the$")


@query(
    "title_variants",
    f"""WITH t AS (SELECT doc_id, {_TRANSLIT} AS translit, {_LISTED} AS listed_punctuation,
      {_KEPT} AS kept_the, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'),
        '\\s+', ' ', 'g')) AS stripped,
      coalesce(nullif(lang, ''), nullif(source, '')) AS fallback FROM documents),
    {sql.dedupe_long('a', 't', 'doc_id', 'translit')},
    {sql.dedupe_long('b', 't', 'doc_id', 'listed_punctuation')},
    {sql.dedupe_long('c', 't', 'doc_id', 'kept_the')}
    SELECT doc_id, a.translit, b.listed_punctuation, c.kept_the, stripped, fallback
    FROM t JOIN a USING (doc_id) JOIN b USING (doc_id) JOIN c USING (doc_id)""",
)
def title_variants(spark, d):
    c = F.col("text")
    return tables.table(spark, d, "documents").select(
        "doc_id",
        text.normalize_title(c, fold="translit", the_before_collapse=True).alias("translit"),
        text.normalize_title(c, punct="list").alias("listed_punctuation"),
        text.normalize_title(c, bare_the="keep").alias("kept_the"),
        text.strip_to_alnum(c).alias("stripped"),
        text.first_non_blank(F.col("lang"), F.col("source")).alias("fallback"),
    )


@query(
    "token_dedup",
    r"""WITH t AS (SELECT doc_id, string_split_regex(text, '\s+') AS parts FROM documents),
    u AS (SELECT doc_id, unnest(parts) AS token, unnest(range(len(parts))) AS pos FROM t),
    f AS (SELECT doc_id, token, min(pos) AS pos FROM u WHERE token <> '' GROUP BY doc_id, token)
    SELECT doc_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens
    FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id""",
)
def token_dedup(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select("doc_id", text.dedupe_tokens(F.col("text")).alias("tokens"))


@query(
    "id_canonicalize",
    r"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END
      AS id FROM orders""",
)
def id_canonicalize(spark, d):
    key = F.col("o_orderkey").cast("string")
    printed = (
        F.when(F.col("o_orderkey") % 7 == 0, "")
        .when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), key, F.lit(".0 ")))
        .otherwise(key)
    )
    return tables.table(spark, d, "orders").select(
        "o_orderkey", text.canonical_id(printed).alias("id")
    )


_KEYS = ["ID_IMDB", "ID_RT", "ID_METACRITIC", "ID_MOVIELENS"]


@query(
    "entity_key",
    f"WITH {sql.STATIC_MERGED}, {sql._KEYED.format(p='st', t='wide')}"
    " SELECT norm_title, year_cluster, entity_key, triple_key, entity_key AS raw_key FROM st_wide_k",
)
def entity_key(spark, d):
    wide = derived.wide(spark, d)
    return wide.select(
        "norm_title", "year_cluster",
        text.joined_key([F.col(c) for c in _KEYS]).alias("entity_key"),
        text.joined_key([F.col(c) for c in _KEYS[1:]]).alias("triple_key"),
        text.joined_key([F.col(c) for c in _KEYS], canonical=False).alias("raw_key"),
    )


_PRINTED = {"ID_IMDB": "{}.0", "ID_RT": "  {} ", "ID_METACRITIC": "{}", "ID_MOVIELENS": "{}.0 "}
_PRINTED_SQL = ", ".join(
    f"coalesce('{a}' || {c} || '{b}', '{'' if c == 'ID_METACRITIC' else 'NA'}')"
    for c, (a, b) in ((c, p.split("{}")) for c, p in _PRINTED.items())
)


@query(
    "entity_key_printed",
    f"WITH {sql.STATIC_MERGED}, {sql._KEYED.format(p='st', t='wide')} SELECT norm_title, year_cluster,"
    f" entity_key, concat_ws('|', {_PRINTED_SQL}) AS raw_key FROM st_wide_k",
)
def entity_key_printed(spark, d):
    """Ids as files print them, padded or as decimals; an empty text stands for a missing one."""
    printed = {c: F.format_string(p.replace("{}", "%s"), c) for c, p in _PRINTED.items()}
    texts = {
        c: F.when(F.col(c).isNotNull(), t).otherwise(F.lit("") if c == "ID_METACRITIC" else F.lit(None))
        for c, t in printed.items()
    }
    wide = derived.wide(spark, d).withColumns(texts)
    return wide.select(
        "norm_title", "year_cluster", text.joined_key([F.col(c) for c in _KEYS]).alias("entity_key"),
        text.joined_key([F.col(c) for c in _KEYS], canonical=False).alias("raw_key"),
    )


@query(
    "year_fallback",
    f"""WITH {sql.RECORDS} SELECT row_id, CAST(CASE row_id % 3 WHEN 0 THEN coalesce(y, 1999) WHEN 1 THEN y
      ELSE CASE WHEN y % 100 <= 25 THEN 2000 ELSE 1900 END + y % 100 END AS INTEGER) AS static_year,
      CAST(CASE row_id % 3 WHEN 0 THEN 1999 WHEN 1 THEN y ELSE y % 100 END AS INTEGER) AS adaptive_year
    FROM rec""",
)
def year_fallback(spark, d):
    """Titles with and without a year beside a release_year of four digits, decimals or two digits."""
    n, y = F.col("row_id"), F.col("y").cast("string")
    in_title = F.when(n % 3 == 0, F.concat(F.lit(" ("), y, F.lit(")")))
    raw = tables.records(spark, d).select(
        "row_id", F.concat("base", F.coalesce(in_title, F.lit(""))).alias("title"),
        F.lit("").alias("genres"), F.lit("3").alias("average_rating"),
        F.when(n % 3 == 0, "1999").when(n % 3 == 1, F.concat(y, F.lit(".0")))
        .otherwise((F.col("y") % 100).cast("string")).alias("release_year"),
    )
    return raw.select(
        "row_id",
        STATIC_SPECS["movielens"].fields(raw)["year"].alias("static_year"),
        ADAPTIVE_SPECS["movielens"].fields(raw)["year"].alias("adaptive_year"),
    )


@query(
    "film_signature",
    f"""WITH {sql.STATIC_MERGED} SELECT norm_title, year_cluster, array_to_string(list_filter([
      'ID_IMDB=' || ID_IMDB, 'ID_METACRITIC=' || ID_METACRITIC, 'ID_MOVIELENS=' || ID_MOVIELENS,
      'ID_RT=' || ID_RT], lambda x: x IS NOT NULL), '|') AS film_sig FROM st_wide""",
)
def film_signature(spark, d):
    return derived.wide(spark, d).select(
        "norm_title", "year_cluster", text.film_signature(_KEYS).alias("film_sig")
    )


@query(
    "keyword_filter",
    f"WITH {sql.RECORDS}, {sql.PARSED_STATIC} SELECT source, row_id, title, year FROM st_parsed"
    r" WHERE regexp_matches(title, '(?i)\b(Bolt|gear|gizmo)\b')",
)
def keyword_filter(spark, d):
    rows = derived.parsed(spark, d).select("source", "row_id", "title", "year")
    return rows.filter(text.has_keyword(F.col("title"), ["Bolt", "gear", "gizmo"]))


@query(
    "content_fingerprint",
    "SELECT doc_id, substr(sha256(text), 1, 12) AS fingerprint FROM documents",
)
def content_fingerprint(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query(
    "dataset_tag",
    """SELECT page_id, CASE WHEN lower(url) LIKE '%imdb%' THEN 'IMDB'
      WHEN lower(url) LIKE '%movielens%' THEN 'MOVIELENS'
      WHEN lower(url) LIKE '%metacritic%' THEN 'METACRITIC'
      WHEN lower(url) LIKE '%rotten%' OR lower(url) LIKE '%rt%' THEN 'RT'
      ELSE 'DATA' END AS tag FROM pages""",
)
def dataset_tag(spark, d):
    pages = tables.table(spark, d, "pages")
    return pages.select("page_id", readers.dataset_tag(F.col("url")).alias("tag"))


@query(
    "genre_split",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {sql.PARSED_ADAPTIVE}
    SELECT 'static' AS dialect, source, row_id, array_to_string(genres, '|') AS genres,
      CAST(len(genres) AS INTEGER) AS n FROM st_parsed UNION ALL
    SELECT 'adaptive', source, row_id, array_to_string(genres, '|'), CAST(len(genres) AS INTEGER)
    FROM ad_parsed""",
)
def genre_split(spark, d):
    def part(dialect):
        return derived.parsed(spark, d, dialect).select(
            F.lit(dialect.name).alias("dialect"), "source", "row_id", "genres",
            F.size("genres").alias("n"),
        )

    return flat(part(merge.STATIC).unionByName(part(ADAPTIVE)))


@query(
    "first_non_empty",
    f"WITH {sql.STATIC_MERGED} SELECT norm_title, year_cluster,"
    " coalesce(genres_found, '') AS genres FROM st_wide",
)
def first_non_empty(spark, d):
    return flat(derived.wide(spark, d).select("norm_title", "year_cluster", "genres"))


@query(
    "date_cascade",
    f"""WITH {sql.RECORDS} SELECT 'imdb' AS source, row_id, CAST({sql._IMDB_DATE} AS VARCHAR)
      AS released FROM raw_imdb UNION ALL SELECT 'metacritic', row_id,
      CAST({sql.rolled('(' + sql.cascade('release_date', '%d-%b-%y') + ')')} AS VARCHAR) FROM raw_meta""",
)
def date_cascade(spark, d):
    c = F.col("release_date")
    imdb = tables.raw_source(spark, d, "imdb").select(
        F.lit("imdb").alias("source"), "row_id",
        parse.date_cascade(c, parse.MONTH_DAY_YEAR).alias("released"),
    )
    meta = tables.raw_source(spark, d, "metacritic").select(
        F.lit("metacritic").alias("source"), "row_id",
        parse.roll_century(parse.date_cascade(c, parse.DAY_MONTH_SHORT_YEAR)).alias("released"),
    )
    return flat(imdb.unionByName(meta))


_SHORT = "strftime(make_date(1926 + CAST(o_orderkey % 150 AS INTEGER), month(o_orderdate), 1), '%d-%b-%y')"


@query(
    "century_rollover",
    f"""WITH t AS (SELECT o_orderkey, {_SHORT} AS printed FROM orders),
    p AS (SELECT *, CAST(try_strptime(printed, '%d-%b-%y') AS DATE) AS released FROM t)
    SELECT o_orderkey, printed, CAST({sql.rolled('released')} AS VARCHAR) AS released FROM p""",
)
def century_rollover(spark, d):
    shown = F.make_date(
        F.lit(1926) + (F.col("o_orderkey") % 150).cast("int"), F.month("o_orderdate"), F.lit(1)
    )
    printed = tables.table(spark, d, "orders").select(
        "o_orderkey", F.date_format(shown, "dd-MMM-yy").alias("printed")
    )
    parsed = F.try_to_date("printed", parse.DAY_MONTH_SHORT_YEAR)
    return flat(printed.withColumn("released", parse.roll_century(parsed)))


@query(
    "date_fallback",
    f"WITH {sql.RECORDS} SELECT row_id, CAST({sql.RT_DATE} AS VARCHAR) AS released FROM raw_rt",
)
def date_fallback(spark, d):
    released = parse.date_fallback(F.col("original_release_date"), F.col("streaming_release_date"))
    return flat(tables.raw_source(spark, d, "rt_audience").select("row_id", released.alias("released")))


@query(
    "year_from_title",
    rf"""WITH {sql.RECORDS} SELECT row_id, try_cast(nullif(regexp_extract(title, '\((\d{{4}})\)', 1),
      '') AS INTEGER) AS year FROM raw_ml""",
)
def year_from_title(spark, d):
    return tables.raw_source(spark, d, "movielens").select(
        "row_id", parse.year_in_text(F.col("title")).alias("year")
    )


@query(
    "year_in_text",
    r"""WITH t AS (SELECT doc_id, text || ' (' || (doc_id % 100) || ') ' || (1900 + doc_id % 120) AS t
      FROM documents) SELECT doc_id,
      try_cast(nullif(regexp_extract(t, '\((\d{4})\)', 1), '') AS INTEGER) AS first_parens,
      try_cast(nullif(regexp_extract(t, '\((\d{2,4})\)\s*$', 1), '') AS INTEGER) AS trailing_parens,
      try_cast(nullif(regexp_extract(t, '(\d{4})$', 1), '') AS INTEGER) AS at_end,
      try_cast(nullif(regexp_extract(t, '^(\d{2,4})', 1), '') AS INTEGER) AS at_start,
      try_cast(nullif(regexp_extract(t, '(\d{2,4})', 1), '') AS INTEGER) AS first_digits FROM t""",
)
def year_in_text(spark, d):
    n = F.col("doc_id")
    printed = F.concat(
        "text", F.lit(" ("), (n % 100).cast("string"), F.lit(") "), (n % 120 + 1900).cast("string")
    )
    docs = tables.table(spark, d, "documents").select("doc_id", printed.alias("t"))
    modes = {
        "first_parens": "first_parens", "trailing_parens": "trailing_parens", "end": "at_end",
        "start": "at_start", "first_digits": "first_digits",
    }
    return docs.select(
        "doc_id", *[parse.year_in_text(F.col("t"), m).alias(name) for m, name in modes.items()]
    )


@query(
    "year_pivot",
    """WITH t AS (SELECT o_orderkey, CAST(o_orderkey % 130 AS INTEGER) AS y FROM orders)
    SELECT o_orderkey, CASE WHEN y >= 100 THEN y WHEN y <= 25 THEN y + 2000 ELSE y + 1900 END
      AS pivot_25, CASE WHEN y >= 100 THEN y WHEN y < 70 THEN y + 2000 ELSE y + 1900 END AS pivot_69,
      CASE WHEN y >= 100 THEN y ELSE y + 1900 END AS always_1900,
      CASE WHEN y >= 100 THEN y ELSE y + 2000 END AS always_2000 FROM t""",
)
def year_pivot(spark, d):
    y = (F.col("o_orderkey") % 130).cast("int")
    return tables.table(spark, d, "orders").select(
        "o_orderkey",
        parse.pivot_year(y).alias("pivot_25"),
        parse.pivot_year(y, 69).alias("pivot_69"),
        parse.pivot_year(y, -1).alias("always_1900"),
        parse.pivot_year(y, 99).alias("always_2000"),
    )


@query(
    "best_rating",
    f"""WITH {sql.RECORDS} SELECT 'metacritic' AS source, row_id, round({sql.BEST_META}, 6) AS rating,
      round({sql.BEST_META_10}, 6) AS rating_0_10 FROM raw_meta UNION ALL
    SELECT 'rt_audience', row_id, {sql.RT_RATING}, NULL FROM raw_rt""",
)
def best_rating(spark, d):
    critic, user = F.col("metascore"), F.col("userscore")
    meta = tables.raw_source(spark, d, "metacritic").select(
        F.lit("metacritic").alias("source"), "row_id",
        parse.first_score(critic, user).alias("rating"),
        parse.first_score_0_10(critic, user).alias("rating_0_10"),
    )
    rt = tables.raw_source(spark, d, "rt_audience").select(
        F.lit("rt_audience").alias("source"), "row_id",
        F.coalesce(
            parse.number(F.col("tomatometer_rating")), parse.number(F.col("audience_rating"))
        ).alias("rating"),
        F.lit(None).cast("double").alias("rating_0_10"),
    )
    return flat(meta.unionByName(rt))


@query(
    "round_half_even",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
      round_even(l_extendedprice / 64 * 10, 0) / 10 AS one_place,
      round_even(l_extendedprice / 64 * 100, 0) / 100 AS two_places FROM lineitem""",
)
def round_half_even(spark, d):
    value = F.col("l_extendedprice") / 64
    return tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
        parse.half_even(value, 1).alias("one_place"),
        parse.half_even(value, 2).alias("two_places"),
    )


@query(
    "stable_row_id",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders",
)
def stable_row_id(spark, d):
    orders = tables.table(spark, d, "orders").select("o_orderkey")
    return keyed.dense_row_id(orders, "o_orderkey")


@query(
    "stable_row_id_sparse",
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS row_id FROM orders",
)
def stable_row_id_sparse(spark, d):
    """Numbers along a key that is a hash: hardly any two of its values lie close."""
    orders = tables.table(spark, d, "orders").select(
        "o_orderkey", F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("key")
    )
    return keyed.dense_row_id(orders, "key").drop("key")


@query(
    "seeded_sample",
    "SELECT o_orderkey, o_totalprice FROM orders"
    " ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 5",
)
def seeded_sample(spark, d):
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return analyze.seeded_sample(orders, "o_orderkey", 5, 42)
