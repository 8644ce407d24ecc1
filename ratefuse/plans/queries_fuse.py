"""Registered queries: cleaning, merging, scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ratefuse.functions.parse import count_present, half_even, row_mean, row_median
from ratefuse.functions.text import film_signature, normalize_title
from ratefuse.operators import clean, cluster, keyed, merge, score
from ratefuse.operators.merge import ADAPTIVE, STATIC
from ratefuse.operators.stored import stored
from ratefuse.plans import derived, sql, tables
from ratefuse.plans.derived import SOURCES, flat
from ratefuse.plans.registry import query
from ratefuse.sources.discover import discover
from ratefuse.sources.specs import STATIC_SPECS

_ROUTED = """st_routed AS (SELECT *, CASE WHEN reason IS NOT DISTINCT FROM 'missing year' THEN 'invalid'
    WHEN n > 1 THEN 'duplicate' WHEN reason IS NOT NULL THEN 'invalid' ELSE 'clean' END AS kind,
    CASE WHEN n > 1 AND reason IS DISTINCT FROM 'missing year' THEN 'duplicate title+year'
      ELSE reason END AS why
  FROM (SELECT *, row_number() OVER (PARTITION BY source, title, year ORDER BY row_id) AS n
    FROM st_parsed))"""
_CANONICAL = "source, row_id, id, title, title_raw, year, CAST(release_date AS VARCHAR) AS release_date,\
 array_to_string(genres, '|') AS genres, round(rating, 6) AS rating"


@query(
    "classify_rows",
    f"WITH {sql.RECORDS}, {sql.PARSED_STATIC} SELECT source, row_id, title, year, reason FROM st_parsed",
)
def classify_rows(spark, d):
    return derived.parsed(spark, d).select("source", "row_id", "title", "year", "reason")


@query(
    "route_rows",
    f"WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {_ROUTED}"
    f" SELECT {_CANONICAL}, kind, why AS reason FROM st_routed",
)
def route_rows(spark, d):
    return flat(clean.route(stored(derived.parsed(spark, d), "parsed")))


@query(
    "route_rows_adaptive",
    f"""WITH {sql.RECORDS}, {sql.PARSED_ADAPTIVE}, v AS (SELECT row_id, source, row_number() OVER
      (PARTITION BY source, title, year ORDER BY row_id) AS n FROM ad_parsed WHERE reason IS NULL)
    SELECT {_CANONICAL}, CASE WHEN n > 1 THEN 'duplicate' WHEN reason IS NOT NULL THEN 'invalid'
      ELSE 'clean' END AS kind, CASE WHEN n > 1 THEN 'duplicate title+year' ELSE reason END AS reason
    FROM ad_parsed LEFT JOIN v USING (source, row_id)""",
)
def route_rows_adaptive(spark, d):
    return flat(clean.route(stored(derived.parsed(spark, d, ADAPTIVE), "parsed"), "after"))


@query(
    "reject_rows",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {_ROUTED}
    SELECT i.row_id, originalTitle, primaryTitle, i.genres, averageRating, i.release_date, kind,
      why AS reason FROM (SELECT row_id, originalTitle, originalTitle AS primaryTitle, genres,
      CAST(averageRating AS VARCHAR) AS averageRating, release_date FROM raw_imdb) i
    JOIN st_routed r ON r.source = 'imdb' AND r.row_id = i.row_id WHERE kind <> 'clean'""",
)
def reject_rows(spark, d):
    raw = tables.raw_source(spark, d, "imdb")
    _, rejects = clean.split_routed(clean.route(clean.parse_source(raw, STATIC_SPECS["imdb"])))
    return raw.join(rejects.select("row_id", "kind", "reason"), "row_id")


_RAW = {"imdb": ("raw_imdb", "originalTitle, originalTitle AS primaryTitle, genres,"
                 " CAST(averageRating AS VARCHAR) AS averageRating, release_date"),
        "metacritic": ("raw_meta", "movie_title, genre, metascore, userscore, release_date"),
        "movielens": ("raw_ml", "title, genres, CAST(average_rating AS VARCHAR) AS average_rating"),
        "rt_audience": ("raw_rt", "movie_title, genres, original_release_date,"
                        " streaming_release_date, tomatometer_rating, audience_rating")}


@query(
    "reject_rows_all",
    f"WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {_ROUTED} " + " UNION ALL BY NAME ".join(
        f"SELECT r.source, i.*, kind, why AS reason FROM (SELECT row_id, {columns} FROM {table}) i"
        f" JOIN st_routed r ON r.source = '{source}' AND r.row_id = i.row_id WHERE kind <> 'clean'"
        for source, (table, columns) in _RAW.items()
    ),
)
def reject_rows_all(spark, d):
    every = None
    for source, raw in tables.raw_sources(spark, d).items():
        _, rejects = clean.split_routed(clean.route(clean.parse_source(raw, STATIC_SPECS[source])))
        rows = raw.join(rejects.select("row_id", "kind", "reason"), "row_id")
        if "average_rating" in rows.columns:
            rows = rows.withColumn("average_rating", F.col("average_rating").cast("string"))
        rows = rows.withColumn("source", F.lit(source))
        every = rows if every is None else every.unionByName(rows, allowMissingColumns=True)
    return every


_UNDESCRIBED = f"""{sql.RECORDS}, x AS (SELECT row_id, row_id AS id,
  {sql.title("base || ' (Remake)'")} AS title, base || ' (Remake)' AS title_raw,
  CAST(y AS INTEGER) AS year, d AS release_date,
  {sql.genres("CASE WHEN row_id % 13 = 0 THEN '' ELSE p_type || '|' || p_name END", "[|,]")} AS genres,
  coalesce(CASE WHEN row_id % 5 <> 0 THEN CAST(r AS DOUBLE) END,
    CASE WHEN r / 10 <= 10 THEN CAST(CAST(r / 10 AS VARCHAR) AS DOUBLE) * 10 END) AS rating
  FROM dated)"""


@query(
    "discovered_source",
    f"""WITH {_UNDESCRIBED} SELECT id, title, title_raw, year, strftime(release_date, '%Y-%m-%d')
      AS release_date, array_to_string(genres, '|') AS genres, round(rating, 6) AS rating,
      CASE WHEN trim(title) = '' THEN '{clean.EMPTY_TITLE}'
        WHEN year IS NULL OR year NOT BETWEEN 1870 AND 2025 THEN '{clean.INVALID_YEAR}'
        WHEN rating IS NULL THEN '{clean.MISSING_RATING}' END AS reason FROM x""",
)
def discovered_source(spark, d):
    raw = tables.undescribed(tables.records(spark, d))
    spec = discover("x", [c for c in raw.columns if c != "row_id"])
    return flat(clean.parse_source(raw, spec).drop("source", "row_id"))


def _clean_query(source):
    @query(
        f"clean_{'rt' if source == 'rt_audience' else source}",
        f"WITH {sql.STATIC} SELECT {_CANONICAL} FROM st_clean WHERE source = '{source}'",
    )
    def run(spark, d):
        raw = tables.raw_source(spark, d, source)
        return flat(clean.keep_clean(clean.parse_source(raw, STATIC_SPECS[source])))


for _source in SOURCES:
    _clean_query(_source)


@query("clean_adaptive", f"WITH {sql.ADAPTIVE} SELECT {_CANONICAL} FROM ad_clean")
def clean_adaptive(spark, d):
    return flat(derived.cleaned(spark, d, ADAPTIVE))


@query(
    "dedup_keep_first",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC} SELECT source, title, year, min(row_id) AS row_id
    FROM st_parsed GROUP BY source, title, year""",
)
def dedup_keep_first(spark, d):
    rows = derived.parsed(spark, d)
    return keyed.first_per_key(rows, clean.KEY, F.col("row_id"), ["row_id"])


@query(
    "dup_flag_all",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC} SELECT source, title, year, row_id,
      count(*) OVER (PARTITION BY source, title, year) AS copies FROM st_parsed
    QUALIFY copies > 1""",
)
def dup_flag_all(spark, d):
    rows = derived.parsed(spark, d).select("source", "title", "year", "row_id")
    return keyed.flag_duplicates(stored(rows, "parsed"), clean.KEY, ["source", "row_id"])


@query(
    "stage_counts",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {_ROUTED} SELECT source, count(*) AS rows_in,
      count(*) FILTER (kind = 'clean') AS rows_clean,
      count(*) FILTER (kind = 'invalid') AS rows_invalid,
      count(*) FILTER (kind = 'duplicate') AS rows_duplicate FROM st_routed GROUP BY source""",
)
def stage_counts(spark, d):
    return clean.stage_counts(clean.route(stored(derived.parsed(spark, d), "parsed")))


@query(
    "movie_rating_join",
    """SELECT p_partkey, p_name, round_even(r * 100, 0) / 100 AS average_rating FROM part LEFT JOIN
      (SELECT l_partkey, avg(l_quantity / 10) AS r FROM lineitem GROUP BY l_partkey)
      ON l_partkey = p_partkey""",
)
def movie_rating_join(spark, d):
    movies = tables.table(spark, d, "part").select("p_partkey", "p_name")
    ratings = tables.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_quantity") / 10).alias("stars")
    )
    return clean.mean_ratings(movies, ratings, "p_partkey", "stars")


@query(
    "long_union",
    f"""WITH {sql.STATIC} SELECT source, title, year, array_to_string(genres, '|') AS genres,
      CASE WHEN source = 'imdb' THEN id END AS ID_IMDB,
      CASE WHEN source = 'metacritic' THEN id END AS ID_METACRITIC,
      CASE WHEN source = 'movielens' THEN id END AS ID_MOVIELENS,
      CASE WHEN source = 'rt_audience' THEN id END AS ID_RT,
      CASE WHEN source = 'imdb' THEN rating END AS rating_imdb,
      round(CASE WHEN source = 'metacritic' THEN rating END, 6) AS rating_metacritic,
      CASE WHEN source = 'movielens' THEN rating END AS rating_movielens,
      CASE WHEN source = 'rt_audience' THEN rating END AS rating_rt_audience FROM st_clean""",
)
def long_union(spark, d):
    frames = {}
    for name, raw in tables.raw_sources(spark, d).items():
        spec = STATIC_SPECS[name]
        rows = clean.keep_clean(clean.parse_source(raw, spec), columns=clean.MERGED)
        frames[name] = rows.select(
            "title", "year", "genres", F.col("id").alias(spec.id_column),
            F.col("rating").alias(spec.rating_column),
        )
    return flat(merge.long_union(frames))


@query(
    "canonicalize_columns",
    f"""WITH {sql.ADAPTIVE} SELECT CASE source WHEN 'imdb' THEN 'imdb_data' ELSE 'my_new_source' END
      AS source, title, year AS release_year, CASE WHEN source = 'imdb' THEN id END AS ID_IMDB,
      CASE WHEN source = 'imdb' THEN rating END AS rating_imdb,
      CASE WHEN source <> 'imdb' THEN id END AS ID_MY_NEW_SOURCE,
      CASE WHEN source <> 'imdb' THEN rating END AS rating_my_new_source
    FROM ad_clean WHERE source IN ('imdb', 'rt_audience')""",
)
def canonicalize_columns(spark, d):
    raws = tables.raw_sources(spark, d)
    frames = {}
    for name, stem in (("imdb", "imdb_data"), ("rt_audience", "my_new_source")):
        rows = clean.parse_source(raws[name], derived.ADAPTIVE_SPECS[name])
        rows = clean.keep_clean(rows, "after", clean.MERGED).select(
            F.col("id").cast("double").cast("string").alias("ID"), "title", "year", "rating"
        )
        frames[stem] = merge.canonicalize_columns(rows, stem)
    return merge.long_union(frames)


_STEMS = {"imdb": "imdb_data", "metacritic": "metacritic_movies",
          "movielens": "movielens_aggregated", "rt_audience": "rotten_tomatoes_movies"}


@query(
    "canonicalize_columns_all",
    f"WITH {sql.ADAPTIVE} SELECT CASE source "
    + " ".join(f"WHEN '{s}' THEN '{stem}'" for s, stem in _STEMS.items())
    + " END AS source, title, year AS release_year, " + ", ".join(
        f"CASE WHEN source = '{s}' THEN id END AS {sql.SOURCES[s]},"
        f" CASE WHEN source = '{s}' THEN rating END AS rating_{s}" for s in _STEMS
    ) + " FROM ad_clean",
)
def canonicalize_columns_all(spark, d):
    raws = tables.raw_sources(spark, d)
    frames = {}
    for name, stem in _STEMS.items():
        rows = clean.parse_source(raws[name], derived.ADAPTIVE_SPECS[name])
        rows = clean.keep_clean(rows, "after", clean.MERGED).select(
            F.col("id").cast("double").cast("string").alias("ID"), "title", "year", "rating"
        )
        frames[stem] = merge.canonicalize_columns(rows, stem)
    return merge.long_union(frames)


@query(
    "year_cluster",
    f"""WITH {sql.STATIC_MERGED} SELECT norm_title, year, n_rows, year_cluster FROM st_clusters""",
)
def year_cluster(spark, d):
    years = cluster.distinct_years(derived.long(spark, d), "norm_title")
    return cluster.year_clusters(years, "norm_title")


@query(
    "year_cluster_null_years",
    f"""WITH {sql.RECORDS}, {sql.PARSED_ADAPTIVE}, y AS (SELECT DISTINCT title, year FROM ad_parsed),
    s AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 0 WHEN year IS NULL
      OR year - lag(year) OVER w > 1 THEN 1 ELSE 0 END AS step
      FROM y WINDOW w AS (PARTITION BY title ORDER BY year NULLS LAST))
    SELECT title, year, CAST(1 + sum(step) OVER (PARTITION BY title ORDER BY year NULLS LAST)
      AS INTEGER) AS year_cluster FROM s""",
)
def year_cluster_null_years(spark, d):
    rows = derived.parsed(spark, d, ADAPTIVE)
    clustered = cluster.year_clusters(cluster.distinct_years(rows, "title"), "title", base=1)
    return clustered.drop("n_rows")


_WIDE = (
    f"norm_title, year_cluster, {sql.IDS}, title, release_year,"
    f" coalesce(genres_found, '') AS genres, release_date, {sql.r6(sql.RATINGS)}, n_rows"
)


@query("long_to_wide", f"WITH {sql.STATIC_MERGED} SELECT {_WIDE} FROM st_wide")
def long_to_wide(spark, d):
    return flat(derived.wide(spark, d))


@query("long_to_wide_adaptive", f"WITH {sql.ADAPTIVE_MERGED} SELECT {_WIDE} FROM ad_wide")
def long_to_wide_adaptive(spark, d):
    return flat(derived.wide(spark, d, ADAPTIVE))


@query(
    "group_meta",
    f"WITH {sql.STATIC_MERGED} SELECT norm_title, year_cluster, title, release_year, release_date"
    " FROM st_wide",
)
def group_meta(spark, d):
    wide = derived.wide(spark, d)
    return flat(wide.select("norm_title", "year_cluster", "title", "release_year", "release_date"))


@query(
    "group_provenance",
    f"""WITH {sql.STATIC_MERGED} SELECT l.norm_title, l.year, l.source, l.row_id, l.title,
      l.year_cluster, w.title AS chosen_title, w.release_year AS chosen_year
    FROM st_long l JOIN st_wide w USING (norm_title, year_cluster)""",
)
def group_provenance(spark, d):
    return merge.group_provenance(stored(derived.long(spark, d), "long"))


_SIGNED = """lng AS (SELECT o_orderkey AS row_id, 'ID_PART=' || o_custkey AS film_sig,
    year(o_orderdate) AS year, CASE WHEN o_orderstatus = 'F' THEN p_name ELSE p_name || ' ' || lower(p_type)
    END AS norm_title FROM orders JOIN part ON p_partkey = o_custkey)"""


@query(
    "unify_by_signature",
    f"""WITH {_SIGNED}, c AS (SELECT film_sig, norm_title, count(*) AS n FROM lng GROUP BY ALL),
    best AS (SELECT film_sig, first(norm_title ORDER BY n DESC, length(norm_title) DESC,
      norm_title DESC) AS best FROM c GROUP BY film_sig),
    size AS (SELECT film_sig, count(*) AS n, min(year) AS y FROM lng GROUP BY film_sig)
    SELECT row_id, film_sig, CASE WHEN n > 1 THEN best ELSE norm_title END AS norm_title,
      CAST(CASE WHEN n > 1 THEN y ELSE year END AS INTEGER) AS year
    FROM lng JOIN best USING (film_sig) JOIN size USING (film_sig)""",
)
def unify_by_signature(spark, d):
    orders, part = tables.table(spark, d, "orders"), tables.table(spark, d, "part")
    joined = orders.join(part, F.col("p_partkey") == F.col("o_custkey"))
    rows = joined.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("ID_PART"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") == "F", F.col("p_name"))
        .otherwise(F.concat_ws(" ", "p_name", F.lower("p_type"))).alias("norm_title"),
    )
    signed = rows.select("row_id", film_signature(["ID_PART"]).alias("film_sig"), "year", "norm_title")
    return cluster.unify_by_signature(stored(signed, "signed"), "film_sig", ["row_id"])


_FILMS = (
    f"{sql.IDS}, title, release_year, genres, release_date, {sql.r6(sql.RATINGS)}, count_ratings"
)


@query("merge_sources", f"WITH {sql.STATIC_MERGED} SELECT {_FILMS} FROM st_films")
def merge_sources(spark, d):
    return flat(merge.merge_sources(derived.cleaned(spark, d, STATIC, clean.MERGED), SOURCES))


@query("merge_sources_adaptive", f"WITH {sql.ADAPTIVE_MERGED} SELECT {_FILMS} FROM ad_films")
def merge_sources_adaptive(spark, d):
    return flat(derived.films(spark, d, ADAPTIVE))


@query(
    "ambiguous_films",
    f"WITH {sql.ADAPTIVE_MERGED} SELECT {_FILMS} FROM ad_rated QUALIFY"
    " count(*) OVER (PARTITION BY title, release_year) > 1",
)
def ambiguous_films(spark, d):
    rated = merge.keep_rated(
        derived.wide(spark, d, ADAPTIVE), replace(ADAPTIVE, drop_ambiguous=False)
    )
    return flat(merge.ambiguous_films(stored(rated, "rated")))


@query(
    "ambiguous_films_both",
    f"WITH {sql.RECORDS}, {sql.PARSED_STATIC}, {sql.CLEAN_STATIC}, {sql.MERGED_STATIC},"
    f" {sql.PARSED_ADAPTIVE}, {sql.CLEAN_ADAPTIVE}, {sql.MERGED_ADAPTIVE}, u AS (SELECT * FROM st_rated"
    f" UNION ALL BY NAME SELECT * FROM ad_rated) SELECT {_FILMS} FROM u QUALIFY"
    " count(*) OVER (PARTITION BY title, release_year) > 1",
)
def ambiguous_films_both(spark, d):
    """Films of both results in one table: what both have is there twice."""
    rated = merge.keep_rated(derived.wide(spark, d)).unionByName(
        merge.keep_rated(derived.wide(spark, d, ADAPTIVE), replace(ADAPTIVE, drop_ambiguous=False))
    )
    return flat(merge.ambiguous_films(stored(rated, "rated")))


_COUNT_THREE = " + ".join(
    f"CAST(rating_{s} IS NOT NULL AS INTEGER)" for s in sql.SOURCES if s != "movielens"
)


@query(
    "films_without_column",
    f"WITH {sql.STATIC_MERGED}, u AS (SELECT {sql.IDS}, title, release_year, coalesce(genres_found, '')"
    " AS genres, release_date, rating_imdb, rating_metacritic, CAST(NULL AS DOUBLE) AS rating_movielens,"
    f" rating_rt_audience, {_COUNT_THREE} AS count_ratings FROM st_wide) SELECT {_FILMS} FROM u"
    " WHERE count_ratings >= 2",
)
def films_without_column(spark, d):
    """A wide table that lacks a rating column: it is added as nulls and counts for nothing."""
    return flat(merge.keep_rated(derived.wide(spark, d).drop("rating_movielens")))


@query(
    "min_sources_filter",
    f"WITH {sql.STATIC_MERGED} SELECT norm_title, year_cluster, {sql.COUNT} AS count_ratings"
    f" FROM st_wide WHERE {sql.COUNT} >= 3",
)
def min_sources_filter(spark, d):
    count = count_present([F.col(c) for c in merge.COUNTED_RATINGS])
    wide = derived.wide(spark, d).select("norm_title", "year_cluster", count.alias("count_ratings"))
    return wide.filter(F.col("count_ratings") >= 3)


@query(
    "count_available",
    f"WITH {sql.STATIC_MERGED} SELECT norm_title, year_cluster, {sql.COUNT} AS count_ratings"
    " FROM st_wide",
)
def count_available(spark, d):
    count = count_present([F.col(c) for c in merge.COUNTED_RATINGS])
    return derived.wide(spark, d).select("norm_title", "year_cluster", count.alias("count_ratings"))


@query(
    "final_ranking",
    f"""WITH {sql.STATIC_MERGED} SELECT {_FILMS}, row_number() OVER (ORDER BY count_ratings DESC,
      release_year DESC NULLS LAST, title, {", ".join(f"{c} NULLS LAST" for c in sql.SOURCES.values())})
      AS rank FROM st_films""",
)
def final_ranking(spark, d):
    return flat(merge.with_rank(derived.stored_films(spark, d)))


_NORMS = sql.r6("imdb_norm, movielens_norm, metacritic_norm, rt_norm")


@query("rating_rescale", f"WITH {sql.STATIC_SCORED} SELECT {sql.IDS}, {_NORMS} FROM st_norm")
def rating_rescale(spark, d):
    scaled = score.rescale_fixed(derived.films(spark, d))
    return flat(scaled.select(*sql.SOURCES.values(), *score.NORM_COLUMNS))


_NORMS_AD = sql.r6(", ".join(sql.NORMS_ADAPTIVE))


@query("rescale_inferred", f"WITH {sql.ADAPTIVE_SCORED} SELECT {sql.IDS}, {_NORMS_AD} FROM ad_norm")
def rescale_inferred(spark, d):
    scaled = score.rescale_inferred(derived.stored_films(spark, d, ADAPTIVE))
    return flat(scaled.select(*sql.SOURCES.values(), *sql.NORMS_ADAPTIVE))


_SCORES = sql.r6("superscore_mean, superscore_median")


@query(
    "superscore",
    f"WITH {sql.STATIC_SCORED} SELECT {sql.IDS}, num_available_ratings, {_SCORES} FROM st_scored",
)
def superscore(spark, d):
    scored = score.score(derived.films(spark, d))
    return flat(
        scored.select(*sql.SOURCES.values(), "num_available_ratings", "superscore_mean",
                      "superscore_median")
    )


@query(
    "superscore_adaptive",
    f"WITH {sql.ADAPTIVE_SCORED} SELECT {sql.IDS}, title, release_year, genres, release_date,"
    f" {sql.r6(sql.RATINGS)}, count_ratings, {_NORMS_AD}, num_available_ratings,"
    " superscore_mean_0_10, superscore_median_0_10 FROM ad_scored",
)
def superscore_adaptive(spark, d):
    return flat(derived.scored(spark, d, ADAPTIVE))


_LINE_LISTS = (
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_quantity,"
    " list_filter([l_quantity / 5, CASE WHEN l_returnflag <> 'A' THEN l_discount * 100 END,"
    " CASE WHEN l_linestatus = 'F' THEN l_tax * 100 END], lambda x: x IS NOT NULL) AS v FROM lineitem"
)


@query(
    "row_mean_median",
    f"WITH t AS ({_LINE_LISTS}) SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,"
    " l_extendedprice, l_quantity, round(list_avg(v), 6) AS mean, round(list_median(v), 6) AS median"
    " FROM t",
)
def row_mean_median(spark, d):
    values = [
        F.col("l_quantity") / 5,
        F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 100),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax") * 100),
    ]
    return flat(
        tables.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice",
            "l_quantity", row_mean(values).alias("mean"), row_median(values).alias("median"),
        )
    )


_ALL = (
    f"{sql.IDS}, title, release_year, genres, release_date, {sql.r6(sql.RATINGS)}, count_ratings,"
    f" {_NORMS}, num_available_ratings, {_SCORES}"
)


@query(
    "end_to_end",
    f"WITH {sql.STATIC_SCORED} SELECT {_ALL} FROM st_scored WHERE num_available_ratings >= 2",
)
def end_to_end(spark, d):
    return flat(derived.scored(spark, d))


def _bounds(columns, low, high, table):
    parts = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), {low}) AS {c}_a,"
        f" quantile_cont(CAST({c} AS DOUBLE), {high}) AS {c}_b" for c in columns
    )
    return f"b AS (SELECT {parts} FROM {table})"


def _treated(c, method):
    a, b, spread = f"{c}_a", f"{c}_b", f"({c}_b - {c}_a)"
    low, high = f"({a} - {spread} * 1.5::DOUBLE)", f"({b} + {spread} * 1.5::DOUBLE)"
    if method == "percentile_cap":
        return f"CASE WHEN {c} < {a} THEN {a} WHEN {c} > {b} THEN {b} ELSE {c} END"
    if method == "cap":
        return (
            f"CASE WHEN {spread} = 0 THEN {c} WHEN {c} < {low} THEN {low}"
            f" WHEN {c} > {high} THEN {high} ELSE {c} END"
        )
    return f"CASE WHEN {spread} <> 0 AND ({c} < {low} OR {c} > {high}) THEN NULL ELSE {c} END"


_CAPPED = list(score.NORM_COLUMNS)


@query(
    "superscore_capped",
    f"WITH {sql.STATIC_SCORED}, {_bounds(_CAPPED, 0.25, 0.75, 'st_norm')}, t AS (SELECT {sql.IDS}, "
    + ", ".join(f"{_treated(c, 'cap')} AS {c}" for c in _CAPPED)
    + " FROM st_norm, b), s AS (" + sql.scored("t", _CAPPED) + f") SELECT {sql.IDS}, {_NORMS},"
    f" num_available_ratings, {_SCORES} FROM s WHERE num_available_ratings >= 2",
)
def superscore_capped(spark, d):
    scored = derived.scored(spark, d, outliers="cap")
    return flat(
        scored.select(*sql.SOURCES.values(), *_CAPPED, "num_available_ratings", "superscore_mean",
                      "superscore_median")
    )


_LINES = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"]
_VALUES = ["price", "tax_share"]
_LINE_TABLE = """t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
    strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
    l_extendedprice * l_extendedprice / 1000 AS price,
    CASE WHEN l_returnflag <> 'R' THEN 1 / (0.02::DOUBLE + l_tax + l_discount) END AS tax_share
  FROM lineitem)"""


def _outlier_query(name, method, low, high):
    # Seven places: the squared prices have seven, so no value lies on a rounding tie.
    shown = ", ".join(f"round({_treated(c, method)}, 7) AS {c}" for c in _VALUES)

    @query(
        name,
        f"WITH {_LINE_TABLE}, {_bounds(_VALUES, low, high, 't')}"
        f" SELECT {', '.join(_LINES)}, {shown} FROM t, b",
    )
    def run(spark, d):
        price, tax = F.col("l_extendedprice"), F.col("l_tax")
        rows = tables.table(spark, d, "lineitem").select(
            *_LINES[:-1], F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
            (price * price / 1000).alias("price"),
            F.when(F.col("l_returnflag") != "R", 1 / (F.lit(0.02) + tax + F.col("l_discount")))
            .alias("tax_share"),
        )
        return flat(score.treat_outliers(rows, _VALUES, method), 7)


_outlier_query("outlier_cap", "cap", 0.25, 0.75)
_outlier_query("outlier_null", "nan", 0.25, 0.75)
_outlier_query("outlier_percentile_cap", "percentile_cap", 0.05, 0.95)
