"""Registered queries: validation and analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratefuse.operators import analyze, clean, merge, validate
from ratefuse.operators.merge import ADAPTIVE
from ratefuse.operators.stored import stored
from ratefuse.plans import derived, sql, tables
from ratefuse.plans.derived import flat
from ratefuse.plans.registry import query

_RATINGS = ["rating_imdb", "rating_metacritic", "rating_movielens", "rating_rt_audience"]
_WIDE_RATINGS = ", ".join(
    f"CASE WHEN source = '{s}' THEN rating END AS rating_{s}" for s in sql.SOURCES
)
# All parsed rows, bad ones too, with one rating column per source.
_UNCHECKED = f"""{sql.RECORDS}, {sql.PARSED_STATIC}, t AS (SELECT source, row_id, title, year,
  {_WIDE_RATINGS} FROM st_parsed)"""
_LIMITS = {"rating_imdb": (1, 9), "rating_metacritic": (5, 95), "rating_movielens": (0, 5)}
_MAX_YEAR = 2026


def _unchecked(spark, d):
    rows = derived.parsed(spark, d)
    ratings = [
        F.when(F.col("source") == s, F.col("rating")).alias(f"rating_{s}") for s in sql.SOURCES
    ]
    return rows.select("source", "row_id", "title", "year", *ratings)


def _finding(check, column, count, wording, where="t"):
    return (
        f"SELECT 'raw' AS df_name, '{check}' AS \"check\", '{column}' AS \"column\","
        f" {count} AS n_bad, 'raw: ' || {count} || ' {wording}' AS message FROM {where}"
    )


def _range_sql(c, low, high):
    return _finding(
        "range", c, f"count(*) FILTER ({c} NOT BETWEEN {low} AND {high})",
        f"values out of range in {c}",
    )


_DUPES = "(SELECT count(*) AS n FROM t GROUP BY title, year)"
_BAD_YEAR = f"year IS NULL OR year NOT BETWEEN 1888 AND {_MAX_YEAR}"
_YEAR_SQL = _finding(
    "year", "year", f"count(*) FILTER ({_BAD_YEAR})", "rows with an invalid year in year"
)
_DUPE_SQL = _finding(
    "duplicate", "title,year", "CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT)",
    "rows are duplicates of (title,year)", _DUPES,
)
_DEFAULTS = " UNION ALL ".join(
    _range_sql(c, *validate.rating_range(c)) for c in _RATINGS
)
_LIMIT_SQL = " UNION ALL ".join(_range_sql(c, *r) for c, r in _LIMITS.items())


@query(
    "validate_report",
    f"WITH {_UNCHECKED}, f AS ({_YEAR_SQL} UNION ALL {_DEFAULTS} UNION ALL {_DUPE_SQL})"
    " SELECT * FROM f WHERE n_bad > 0",
)
def validate_report(spark, d):
    return validate.validate_table(stored(_unchecked(spark, d), "raw"), "raw", _MAX_YEAR)


_SOURCE_LIMITS = validate.RATING_RANGES | _LIMITS
_LOW, _HIGH = (
    "CASE source " + " ".join(
        f"WHEN '{c.removeprefix('rating_')}' THEN {r[k]}" for c, r in _SOURCE_LIMITS.items()
    ) + " END"
    for k in (0, 1)
)


@query(
    "validate_by_source",
    f"""WITH {sql.RECORDS}, {sql.PARSED_STATIC}, k AS (
      SELECT source, count(*) AS n, count(*) FILTER ({_BAD_YEAR}) AS y,
        count(*) FILTER (rating NOT BETWEEN {_LOW} AND {_HIGH}) AS r
      FROM st_parsed GROUP BY source, title, year
    ), s AS (
      SELECT 'raw/' || source AS df_name, CAST(sum(y) AS BIGINT) AS y, CAST(sum(r) AS BIGINT) AS r,
        CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS d
      FROM k GROUP BY source
    ), f AS (
      SELECT df_name, 'year' AS "check", 'year' AS "column", y AS n_bad,
        'rows with an invalid year in year' AS said FROM s
      UNION ALL SELECT df_name, 'range', 'rating', r, 'values out of range in rating' FROM s
      UNION ALL SELECT df_name, 'duplicate', 'title,year', d,
        'rows are duplicates of (title,year)' FROM s
    )
    SELECT df_name, "check", "column", n_bad, df_name || ': ' || n_bad || ' ' || said AS message
    FROM f WHERE n_bad > 0""",
)
def validate_by_source(spark, d):
    rows = derived.parsed(spark, d)
    return validate.validate_by_source(rows, "raw", _MAX_YEAR, _SOURCE_LIMITS)


@query(
    "validate_ranges",
    f"WITH {_UNCHECKED}, f AS ({_LIMIT_SQL}) SELECT * FROM f WHERE n_bad > 0",
)
def validate_ranges(spark, d):
    rows = stored(_unchecked(spark, d), "raw")
    found = validate.validate_table(rows, "raw", _MAX_YEAR, ranges=_LIMITS)
    return found.filter(F.col("check") == "range")


@query(
    "validate_duplicates",
    f"WITH {_UNCHECKED} SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_bad FROM {_DUPES}",
)
def validate_duplicates(spark, d):
    return validate.duplicate_rows(_unchecked(spark, d), ["title", "year"])


_OUT = " OR ".join(
    f"coalesce({c} NOT BETWEEN {low} AND {high}, false)" for c, (low, high) in _LIMITS.items()
)


@query(
    "invalid_rows",
    f"WITH {_UNCHECKED} SELECT source, row_id, title, year, {sql.r6(', '.join(_RATINGS))} FROM t"
    f" WHERE {_BAD_YEAR} OR {_OUT}",
)
def invalid_rows(spark, d):
    rows = stored(_unchecked(spark, d), "raw")
    return flat(validate.invalid_rows(rows, _MAX_YEAR, _LIMITS))


_SPEC_ROWS = f"""{sql.RECORDS}, {sql.PARSED_ADAPTIVE}, t AS (SELECT row_id AS ID,
  CASE WHEN row_id % 23 = 0 THEN title || '!' WHEN row_id % 29 = 0 THEN '' ELSE title END AS title,
  year AS release_year, genres, rating FROM ad_parsed)"""


def _spec_rows(spark, d):
    n = F.col("row_id")
    title = F.when(n % 23 == 0, F.concat("title", F.lit("!"))).when(n % 29 == 0, "").otherwise(
        F.col("title")
    )
    return derived.parsed(spark, d, ADAPTIVE).select(
        n.alias("ID"), title.alias("title"), F.col("year").alias("release_year"), "genres", "rating"
    )


_CLEANED = r"trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
_ERR_YEAR = f"CASE WHEN release_year NOT BETWEEN 1870 AND 2025 THEN '{validate.ERR_YEAR}' END"
_ERR_RATING = f"CASE WHEN rating IS NULL THEN '{validate.ERR_RATING}' END"


@query(
    "validate_schema",
    f"""WITH {_SPEC_ROWS} SELECT ID, title, release_year, array_to_string(genres, '|') AS genres,
      round(rating, 6) AS rating, array_to_string(list_filter([
        CASE WHEN trim(title) = '' THEN '{validate.ERR_TITLE}' WHEN title <> {_CLEANED}
          THEN '{validate.ERR_DIRTY}' END, {_ERR_YEAR}, {_ERR_RATING},
        CASE WHEN n > 1 THEN '{validate.ERR_DUPLICATE}' END], lambda e: e IS NOT NULL), '|') AS errors,
      n > 1 AS is_duplicate
    FROM (SELECT *, row_number() OVER (PARTITION BY title, release_year ORDER BY ID) AS n FROM t)""",
)
def validate_schema(spark, d):
    return flat(validate.check_schema(stored(_spec_rows(spark, d), "rows")))


@query(
    "validate_schema_drop",
    f"""WITH {_SPEC_ROWS}, c AS (SELECT * EXCLUDE title, {_CLEANED} AS title FROM t)
    SELECT ID, release_year, array_to_string(genres, '|') AS genres, round(rating, 6) AS rating, title
    FROM c WHERE title <> '' AND release_year BETWEEN 1870 AND 2025 AND rating IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY title, release_year ORDER BY ID) = 1""",
)
def validate_schema_drop(spark, d):
    policy = validate.RulePolicy("drop", "error", "rewrite", all_errors=False)
    return flat(validate.valid_rows(validate.check_schema(stored(_spec_rows(spark, d), "rows"), policy), policy))


@query(
    "validate_schema_count",
    f"""WITH {_SPEC_ROWS}, c AS (SELECT *, title <> '' AND title = {_CLEANED}
      AND coalesce(release_year BETWEEN 1870 AND 2025, true) AND rating IS NOT NULL AS good FROM t),
    n AS (SELECT *, row_number() OVER (PARTITION BY title, release_year ORDER BY ID) AS n FROM c
      WHERE good)
    SELECT count(*) AS valid, count(*) FILTER (n > 1) AS repeated,
      (SELECT count(*) FROM t) - count(*) AS invalid FROM n""",
)
def validate_schema_count(spark, d):
    checked = validate.check_schema(stored(_spec_rows(spark, d), "rows"), validate.RulePolicy("count"))
    good = F.size("errors") == 0
    return checked.agg(
        F.count_if(good).alias("valid"), F.count_if("is_duplicate").alias("repeated"),
        F.count_if(~good).alias("invalid"),
    )


_FILE_RULES = [
    {"field": "ID", "type": "int64", "rule": "must be preserved unchanged"},
    {"field": "title", "type": "str", "rule": "must not be empty, must be unique (title, release_year)"},
    {"field": "release_year", "type": "int64 | pd.NA", "rule": "value <=2005 & realistic (1870-2025)"},
    {"field": "genres", "type": "list[str]", "rule": "optional"},
    {"field": "rating", "type": "float", "rule": "must never be NaN, > 0.5, nice to have"},
]


@query(
    "validate_rules",
    f"""WITH {_SPEC_ROWS}, n AS (SELECT *, row_number() OVER (PARTITION BY title, release_year
      ORDER BY ID) AS n FROM t)
    SELECT ID, title, release_year, array_to_string(list_filter([
      CASE WHEN title = '' THEN '{validate.ERR_TITLE}' END,
      CASE WHEN release_year < 1870 OR release_year > 2005 THEN '{validate.ERR_YEAR}' END,
      CASE WHEN rating IS NULL THEN '{validate.ERR_RATING}' WHEN NOT rating > 0.5
        THEN 'rating out of range' END,
      CASE WHEN n > 1 THEN '{validate.ERR_DUPLICATE}' END], lambda e: e IS NOT NULL), '|') AS errors
    FROM n""",
)
def validate_rules(spark, d):
    checked = validate.check_schema(_spec_rows(spark, d), spec=_FILE_RULES)
    return flat(checked.select("ID", "title", "release_year", "errors"))


_NO_ID_ROWS = f"""{_SPEC_ROWS}, w AS (SELECT CASE WHEN ID % 3 = 0 THEN ID END AS ID, title,
  release_year, array_to_string(genres, '|') AS genres, rating FROM t)"""


def _rows_without_ids(spark, d):
    rows = _spec_rows(spark, d).withColumn("ID", F.when(F.col("ID") % 3 == 0, F.col("ID")))
    genres = F.array_join("genres", "|").alias("genres")
    return rows.select("ID", "title", "release_year", genres, "rating")


def _no_id_query(name, policy, columns, condition):
    first = "row_number() OVER (PARTITION BY title, release_year ORDER BY ID NULLS LAST, genres, rating NULLS FIRST)"

    @query(
        name,
        f"WITH {_NO_ID_ROWS}, n AS (SELECT *, {first} AS n FROM w) SELECT ID, title, release_year,"
        f" genres, round(rating, 6) AS rating{columns} FROM n WHERE {condition}",
    )
    def run(spark, d):
        rules = [
            {"field": "title", "type": "str", "rule": "must not be empty, unique (title, release_year)"},
            {"field": "rating", "type": "float", "rule": "must never be NaN"},
        ]
        rows = _rows_without_ids(spark, d).withColumn("title", F.col("title"))
        checked = validate.check_schema(rows, policy, rules)
        if policy.on_duplicate == "drop_first":
            return flat(validate.valid_rows(checked, policy))
        return flat(checked.drop("errors"))


_no_id_query("repeats_without_id", validate.RulePolicy(), ", n > 1 AS is_duplicate", "true")
_no_id_query(
    "validate_schema_drop_first", validate.RulePolicy("drop_first"), "",
    "n = 1 AND title <> '' AND rating IS NOT NULL",
)


_STATS = ["rating_imdb", "rating_movielens", "rating_metacritic", "rating_rt_audience"]


def _stats_sql(c):
    def r(x):
        return f"round_even({x} * 100, 0) / 100"

    return (
        f"SELECT '{c}' AS name, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,"
        f" {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, {r(f'median({c})')} AS median,"
        f" count({c}) AS count FROM st_films"
    )


@query(
    "rating_stats",
    f"WITH {sql.STATIC_MERGED} " + " UNION ALL ".join(_stats_sql(c) for c in _STATS),
)
def rating_stats(spark, d):
    return analyze.rating_stats(derived.stored_films(spark, d), _STATS)


_CORR = ["imdb_norm", "movielens_norm", "metacritic_norm", "rt_norm", "superscore_mean",
         "superscore_median"]


@query(
    "rating_corr",
    f"WITH {sql.STATIC_SCORED} " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({min(a, b)}, {max(a, b)}), 6) AS corr"
        " FROM st_scored" for a in _CORR for b in _CORR
    ),
)
def rating_corr(spark, d):
    return flat(analyze.rating_corr(derived.scored(spark, d), _CORR))


def _bin(c, bins=20):
    low, high = f"min({c}) OVER ()", f"max({c}) OVER ()"
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {low} = {high} THEN 1 ELSE CAST(least(floor("
        f"{bins}::DOUBLE * ({c} - {low}) / ({high} - {low})) + 1, {bins}) AS INTEGER) END"
    )


@query(
    "rating_histogram",
    f"WITH {sql.STATIC_MERGED}, b AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {_bin(c)} AS bin FROM st_films" for c in _STATS
    ) + ") SELECT name, bin, count(*) AS rows FROM b WHERE bin IS NOT NULL GROUP BY name, bin",
)
def rating_histogram(spark, d):
    return analyze.histogram(derived.stored_films(spark, d), _STATS)


@query(
    "rating_pair_density",
    f"WITH {sql.STATIC_MERGED}, b AS (SELECT "
    + ", ".join(f"{_bin(c)} AS {c}" for c in _STATS) + " FROM st_films), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS bin_a, {b} AS bin_b FROM b"
        for i, a in enumerate(_STATS) for b in _STATS[i + 1:]
    ) + ") SELECT *, count(*) AS rows FROM p WHERE bin_a IS NOT NULL AND bin_b IS NOT NULL GROUP BY ALL",
)
def rating_pair_density(spark, d):
    return analyze.pair_density(derived.stored_films(spark, d), _STATS)


@query(
    "score_line",
    f"WITH {sql.STATIC_SCORED} SELECT round(least(min(superscore_mean), min(superscore_median)), 6)"
    " AS low, round(greatest(max(superscore_mean), max(superscore_median)), 6) AS high FROM st_scored",
)
def score_line(spark, d):
    return flat(
        analyze.score_line(derived.scored(spark, d), "superscore_mean", "superscore_median")
    )


@query(
    "source_count_dist",
    f"WITH {sql.STATIC_MERGED} SELECT count_ratings, count(*) AS films FROM st_films"
    " GROUP BY count_ratings",
)
def source_count_dist(spark, d):
    return analyze.value_counts(derived.films(spark, d), "count_ratings")


_PROFILED = {
    "ID_IMDB": "bigint", "ID_METACRITIC": "bigint", "ID_MOVIELENS": "bigint", "ID_RT": "bigint",
    "title": "string", "release_year": "int", "genres": "array<string>", "release_date": "date",
    "rating_imdb": "double", "rating_movielens": "double", "rating_metacritic": "double",
    "rating_rt_audience": "double", "count_ratings": "int",
}


@query(
    "column_profile",
    f"WITH {sql.STATIC_MERGED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS rows"
        " FROM st_films" for c, t in _PROFILED.items()
    ),
)
def column_profile(spark, d):
    return analyze.column_profile(derived.films(spark, d))


@query(
    "genre_coverage",
    f"WITH {sql.STATIC_MERGED} SELECT count(*) FILTER (genres <> '') AS with_genres,"
    " count(*) AS rows FROM st_films",
)
def genre_coverage(spark, d):
    return analyze.with_genres(derived.films(spark, d))


_SOURCE_KEYS = f"""{sql.STATIC_MERGED}, m AS (SELECT DISTINCT {sql.title('title')} AS title,
    release_year AS year FROM st_films),
  k AS (SELECT DISTINCT source, title, year FROM st_clean),
  j AS (SELECT k.*, m.title IS NOT NULL AS merged FROM k LEFT JOIN m
    ON m.title = k.title AND m.year IS NOT DISTINCT FROM k.year)"""


@query(
    "source_coverage",
    f"""WITH {_SOURCE_KEYS}, r AS (SELECT source, count(*) AS rows FROM st_clean GROUP BY source)
    SELECT source, any_value(rows) AS rows, count(*) AS keys, count(*) FILTER (merged) AS found,
      round_even(count(*) FILTER (merged) / count(*) * 100 * 100, 0) / 100 AS percent
    FROM j JOIN r USING (source) GROUP BY source""",
)
def source_coverage(spark, d):
    rows = stored(derived.cleaned(spark, d, columns=clean.MERGED), "clean")
    return analyze.source_coverage(rows, merge.merge_sources(rows, derived.SOURCES))


@query("lost_keys", f"WITH {_SOURCE_KEYS} SELECT source, title, year FROM j WHERE NOT merged")
def lost_keys(spark, d):
    rows = stored(derived.cleaned(spark, d, columns=clean.MERGED), "clean")
    return analyze.lost_keys(rows, merge.merge_sources(rows, derived.SOURCES))


@query(
    "lost_examples",
    f"WITH {_SOURCE_KEYS} SELECT source, title, year FROM j WHERE NOT merged AND source = 'imdb'"
    " ORDER BY title, year LIMIT 10",
)
def lost_examples(spark, d):
    rows = stored(derived.cleaned(spark, d, columns=clean.MERGED), "clean")
    lost = analyze.lost_keys(rows, merge.merge_sources(rows, derived.SOURCES))
    return lost.filter(F.col("source") == "imdb").orderBy("title", "year").limit(10)


@query(
    "lost_examples_all",
    f"WITH {_SOURCE_KEYS} SELECT source, title, year FROM j WHERE NOT merged QUALIFY row_number()"
    " OVER (PARTITION BY source ORDER BY title, year) <= 10",
)
def lost_examples_all(spark, d):
    rows = stored(derived.cleaned(spark, d, columns=clean.MERGED), "clean")
    lost = stored(analyze.lost_keys(rows, merge.merge_sources(rows, derived.SOURCES)), "lost")
    first, *others = (
        lost.filter(F.col("source") == s).orderBy("title", "year").limit(10)
        for s in derived.SOURCES
    )
    for part in others:
        first = first.unionByName(part)
    return first


@query(
    "rating_quantiles",
    "WITH q AS (SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS prob) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, CAST(prob AS DOUBLE) AS prob, (SELECT count(*) FROM lineitem) AS n,"
        f" round(list_extract(v, CAST(row_number() OVER (ORDER BY prob) AS BIGINT)), 6) AS value"
        f" FROM q, (SELECT quantile_cont({c}, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS v"
        " FROM lineitem)"
        for c in ("l_extendedprice", "l_quantity", "l_discount")
    ),
)
def rating_quantiles(spark, d):
    from ratefuse.operators.quantiles import quantile_table

    lines = tables.table(spark, d, "lineitem")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    return flat(quantile_table(lines, ["l_extendedprice", "l_quantity", "l_discount"], probs))
