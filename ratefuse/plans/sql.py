"""SQL building blocks (DuckDB) for checking the registered queries.

Written from the definitions alone, with plain joins and windows, so that they share
no logic with the DataFrame code they check.
"""

from __future__ import annotations


def fold(x: str) -> str:
    return rf"lower(regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g'))"


def before_dedupe(x: str, punct: str = r"[^\w\s]", the: str = r"\bthe\s*$",
                  the_first: bool = False) -> str:
    """Everything of the title form but the token dedupe."""
    t = rf"regexp_replace({fold(x)}, '\s*\(\d{{4}}\)\s*$', '')"
    t = rf"regexp_replace({t}, '\s*\([^)]*\)\s*$', '')"
    t = rf"regexp_replace({t}, '{punct}', ' ', 'g')"
    if the_first:
        return rf"trim(regexp_replace(regexp_replace({t}, '{the}', ''), '\s+', ' ', 'g'))"
    t = rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"
    return rf"trim(regexp_replace({t}, '{the}', ''))"


def dedupe(x: str) -> str:
    parts = f"string_split({x}, ' ')"
    return (
        f"array_to_string(list_filter({parts}, lambda token, i:"
        f" list_position({parts}, token) = i AND token <> ''), ' ')"
    )


def dedupe_long(name: str, table: str, key: str, column: str) -> str:
    """CTEs that dedupe the tokens of long texts (by grouping, not by list search)."""
    return f"""{name}_u AS (SELECT {key}, unnest(string_split({column}, ' ')) AS token,
    unnest(range(len(string_split({column}, ' ')))) AS pos FROM {table}
), {name}_f AS (SELECT {key}, token, min(pos) AS pos FROM {name}_u WHERE token <> ''
  GROUP BY {key}, token
), {name} AS (SELECT {key}, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS {column}
  FROM {table} LEFT JOIN {name}_f USING ({key}) GROUP BY {key})"""


def title(x: str, **options) -> str:
    return dedupe(before_dedupe(x, **options))


def genres(x: str, separator: str, stop: str = "") -> str:
    return (
        f"coalesce(list_filter(list_transform(string_split_regex({x}, '{separator}'),"
        f" lambda g: trim(g)), lambda g: g <> '' AND g <> '{stop}'), [])"
    )


RECORDS = r"""
rec AS (
  SELECT o_orderkey AS row_id, p_name || ' ' || p_brand AS base, o_orderpriority AS pr,
    CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 89 = 0 THEN 1800
      ELSE year(o_orderdate) + (o_custkey % 7) * 3 END END AS y,
    month(o_orderdate) AS m, least(day(o_orderdate), 28) AS dd,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 101 END AS r,
    p_type, p_name
  FROM orders JOIN part ON p_partkey = o_custkey
), dated AS (SELECT *, make_date(y, m, dd) AS d FROM rec
), raw_imdb AS (
  SELECT row_id, base AS originalTitle,
    CASE WHEN row_id % 13 = 0 THEN '' ELSE p_type || ',' || p_name END AS genres,
    CASE WHEN row_id % 17 = 0 THEN strftime(d, '%Y')
      WHEN row_id % 19 = 0 THEN strftime(d, '%B %Y')
      ELSE strftime(d, '%B %-d, %Y') END AS release_date, r / 10 AS averageRating
  FROM dated WHERE pr = '1-URGENT'
), raw_meta AS (
  SELECT row_id, upper(base) || '!' AS movie_title,
    CASE WHEN row_id % 13 = 0 THEN '' ELSE p_type || ',' || p_name END AS genre,
    CASE WHEN row_id % 5 <> 0 THEN CAST(r AS VARCHAR) END AS metascore,
    coalesce(CAST(r / 10 AS VARCHAR), 'tbd') AS userscore,
    CASE WHEN row_id % 17 = 0 THEN strftime(d, '%Y')
      WHEN row_id % 19 = 0 THEN strftime(d, '%B %Y')
      ELSE strftime(d, '%-d-%b-%y') END AS release_date
  FROM dated WHERE pr = '2-HIGH'
), raw_ml AS (
  SELECT row_id, base || ', The' || coalesce(' (' || CAST(y AS VARCHAR) || ')', '') AS title,
    CASE WHEN row_id % 13 = 0 THEN '' ELSE p_type || '|' || p_name END AS genres,
    r / 20 AS average_rating
  FROM dated WHERE pr = '3-MEDIUM'
), raw_rt AS (
  SELECT row_id, replace(base, 'e', 'é') AS movie_title,
    CASE WHEN row_id % 13 = 0 THEN '' ELSE p_type || ',' || p_name END AS genres,
    CASE WHEN row_id % 17 <> 0 THEN strftime(d, '%Y-%m-%d') END AS original_release_date,
    CASE WHEN row_id % 17 = 0 THEN strftime(d, '%Y-%m-%d') END AS streaming_release_date,
    CASE WHEN row_id % 3 <> 0 THEN CAST(r AS VARCHAR) END AS tomatometer_rating,
    CAST(r AS VARCHAR) AS audience_rating
  FROM dated WHERE pr IN ('4-NOT SPECIFIED', '5-LOW')
)"""


def cascade(x: str, first: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({x}, '{first}'), try_strptime({x}, '%B %Y'),"
        rf" CASE WHEN regexp_full_match({x}, '\d{{4}}') THEN CAST({x} || '-01-01' AS TIMESTAMP) END)"
        f" AS DATE)"
    )


def rolled(x: str) -> str:
    return f"CASE WHEN year({x}) > 2025 THEN CAST({x} - INTERVAL 100 YEAR AS DATE) ELSE {x} END"


BEST_META = (
    "coalesce(try_cast(metascore AS DOUBLE), CASE WHEN try_cast(userscore AS DOUBLE) <= 10"
    " THEN try_cast(userscore AS DOUBLE) * 10 ELSE try_cast(userscore AS DOUBLE) END)"
)
BEST_META_10 = (
    "coalesce(CASE WHEN try_cast(metascore AS DOUBLE) > 0 THEN try_cast(metascore AS DOUBLE) / 10"
    " END, try_cast(userscore AS DOUBLE))"
)
RT_RATING = "coalesce(try_cast(tomatometer_rating AS DOUBLE), try_cast(audience_rating AS DOUBLE))"
RT_DATE = (
    "CAST(coalesce(try_strptime(original_release_date, '%Y-%m-%d'),"
    " try_strptime(streaming_release_date, '%Y-%m-%d')) AS DATE)"
)


def _parsed(name: str, parts: list[tuple], required: set[str], year_first: bool) -> str:
    selects = []
    for source, table, raw, year, date, genre, rating in parts:
        selects.append(
            f"SELECT '{source}' AS source, row_id, row_id AS id, {title(raw)} AS title,"
            f" {raw} AS title_raw, CAST({year} AS INTEGER) AS year, {date} AS release_date,"
            f" {genre} AS genres, {rating} AS rating FROM {table}"
        )
    wanted = ", ".join(f"'{s}'" for s in sorted(required))
    first = "WHEN source = 'movielens' AND year IS NULL THEN 'missing year'" if year_first else ""
    return f"""{name}_in AS ({" UNION ALL ".join(selects)}
), {name} AS (SELECT *, CASE {first} WHEN trim(title) = '' THEN 'empty title'
    WHEN year IS NULL OR year NOT BETWEEN 1870 AND 2025 THEN 'invalid year'
    WHEN source IN ({wanted}) AND rating IS NULL THEN 'missing rating' END AS reason
  FROM {name}_in)"""


_IMDB_DATE = cascade("release_date", "%B %d, %Y")
_META_DATE = rolled("(" + cascade("release_date", "%d-%b-%y") + ")")
_META_DATE_AD = "CAST(try_strptime(release_date, '%d-%b-%y') AS DATE)"
_NO_DATE = "CAST(NULL AS DATE)"

PARSED_STATIC = _parsed(
    "st_parsed",
    [
        ("imdb", "raw_imdb", "originalTitle", f"year({_IMDB_DATE})", _IMDB_DATE,
         genres("genres", "[|,]"), "averageRating"),
        ("metacritic", "raw_meta", "movie_title", f"year({_META_DATE})", _META_DATE,
         genres("genre", ","), BEST_META),
        ("movielens", "raw_ml", "title", r"nullif(regexp_extract(title, '\((\d{4})\)', 1), '')",
         _NO_DATE, genres("genres", r"\|"), "average_rating"),
        ("rt_audience", "raw_rt", "movie_title", f"year({RT_DATE})", RT_DATE,
         genres("genres", ","), RT_RATING),
    ],
    {"metacritic", "movielens", "rt_audience"}, True,
)
PARSED_ADAPTIVE = _parsed(
    "ad_parsed",
    [
        ("imdb", "raw_imdb", "originalTitle",
         r"nullif(regexp_extract(trim(release_date), '(\d{4})$', 1), '')", _IMDB_DATE,
         genres("genres", ","), "averageRating"),
        ("metacritic", "raw_meta", "movie_title", f"year({_META_DATE_AD})", _META_DATE_AD,
         genres("genre", ","), BEST_META_10),
        ("movielens", "raw_ml", "title",
         r"nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '')", _NO_DATE,
         genres("genres", r"\|", "(no genres listed)"), "average_rating"),
        ("rt_audience", "raw_rt", "movie_title",
         "substr(coalesce(original_release_date, streaming_release_date), 1, 4)", RT_DATE,
         genres("genres", "[,&/]"), RT_RATING),
    ],
    {"imdb", "metacritic", "movielens", "rt_audience"}, False,
)
CLEAN_STATIC = """st_clean AS (
  SELECT * EXCLUDE (n, reason) FROM (SELECT *, row_number() OVER
    (PARTITION BY source, title, year ORDER BY row_id) AS n FROM st_parsed)
  WHERE n = 1 AND reason IS NULL)"""
CLEAN_ADAPTIVE = """ad_clean AS (
  SELECT * EXCLUDE (n, reason) FROM (SELECT *, row_number() OVER
    (PARTITION BY source, title, year ORDER BY row_id) AS n FROM ad_parsed WHERE reason IS NULL)
  WHERE n = 1)"""

SOURCES = {
    "imdb": "ID_IMDB", "metacritic": "ID_METACRITIC", "movielens": "ID_MOVIELENS",
    "rt_audience": "ID_RT",
}
IDS = ", ".join(SOURCES.values())
RATINGS = ", ".join(f"rating_{s}" for s in SOURCES)
COUNT = " + ".join(f"CAST(rating_{s} IS NOT NULL AS INTEGER)" for s in SOURCES)


def _merged(p: str, key: str, base: int, genre_filter: str) -> str:
    picks = ", ".join(
        f"first(id ORDER BY row_id) FILTER (WHERE source = '{s}') AS {i},"
        f" first(rating ORDER BY row_id) FILTER (WHERE source = '{s}' AND rating IS NOT NULL)"
        f" AS rating_{s}"
        for s, i in SOURCES.items()
    )
    return f"""{p}_keyed AS (SELECT *, {key} AS norm_title FROM {p}_clean
), {p}_years AS (SELECT norm_title, year, count(*) AS n_rows FROM {p}_keyed GROUP BY ALL
), {p}_steps AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 0
    WHEN year IS NULL OR year - lag(year) OVER w > 1 THEN 1 ELSE 0 END AS step
  FROM {p}_years WINDOW w AS (PARTITION BY norm_title ORDER BY year NULLS LAST)
), {p}_clusters AS (SELECT norm_title, year, n_rows, CAST({base} + sum(step) OVER
    (PARTITION BY norm_title ORDER BY year NULLS LAST) AS INTEGER) AS year_cluster FROM {p}_steps
), {p}_long AS (SELECT k.*, year_cluster FROM {p}_keyed k JOIN {p}_clusters c
  ON k.norm_title = c.norm_title AND k.year IS NOT DISTINCT FROM c.year
), {p}_wide AS (SELECT norm_title, year_cluster, {picks},
    first(title ORDER BY source, title, row_id) AS title, min(year) AS release_year,
    array_to_string(first(genres ORDER BY source, row_id) {genre_filter}, '|') AS genres_found,
    CAST(min(release_date) AS VARCHAR) AS release_date, count(*) AS n_rows
  FROM {p}_long GROUP BY norm_title, year_cluster
), {p}_rated AS (SELECT {IDS}, title, release_year, coalesce(genres_found, '') AS genres,
    release_date, {RATINGS}, {COUNT} AS count_ratings
  FROM {p}_wide WHERE {COUNT} >= 2)"""


MERGED_STATIC = _merged("st", title("title"), 0, "FILTER (WHERE len(genres) > 0)") + (
    ", st_films AS (SELECT * FROM st_rated)"
)
MERGED_ADAPTIVE = _merged("ad", "title", 1, "") + (
    ", ad_films AS (SELECT * FROM ad_rated QUALIFY"
    " count(*) OVER (PARTITION BY title, release_year) = 1)"
)

NORMS = {
    "imdb_norm": "rating_imdb", "movielens_norm": "rating_movielens * 2",
    "metacritic_norm": "rating_metacritic / 10", "rt_norm": "rating_rt_audience / 10",
}
NORM_EXPRESSIONS = ", ".join(f"{x} AS {n}" for n, x in NORMS.items())


def scored(source: str, norms: list[str], suffix: str = "", rounded: bool = False) -> str:
    """Films plus count, mean and median of the normalised columns."""
    present = f"list_filter([{', '.join(norms)}], lambda x: x IS NOT NULL)"
    mean, median = f"list_avg({present})", f"list_median({present})"
    if rounded:
        mean, median = f"round_even({mean} * 10, 0) / 10", f"round_even({median} * 10, 0) / 10"
    count = f"CAST(len({present}) AS INTEGER)"
    return (
        f"SELECT *, {count} AS num_available_ratings,"
        f" CASE WHEN {count} >= 2 THEN {mean} END AS superscore_mean{suffix},"
        f" CASE WHEN {count} >= 2 THEN {median} END AS superscore_median{suffix} FROM {source}"
    )


SCORED_STATIC = (
    f"st_norm AS (SELECT *, {NORM_EXPRESSIONS} FROM st_films), st_scored AS ("
    + scored("st_norm", list(NORMS)) + ")"
)


def _inferred(column: str) -> str:
    top = f"(SELECT max({column}) FROM ad_films)"
    return (
        f"CASE WHEN {top} <= 5.5 THEN {column} * 2 WHEN {top} > 10 THEN {column} / 10"
        f" ELSE {column} END AS {column.removeprefix('rating_')}_norm"
    )


NORMS_ADAPTIVE = [f"{s}_norm" for s in SOURCES]
SCORED_ADAPTIVE = (
    "ad_norm AS (SELECT *, " + ", ".join(_inferred(f"rating_{s}") for s in SOURCES)
    + " FROM ad_films), ad_scored AS ("
    + scored("ad_norm", NORMS_ADAPTIVE, "_0_10", True) + ")"
)

STATIC = ", ".join([RECORDS, PARSED_STATIC, CLEAN_STATIC])
ADAPTIVE = ", ".join([RECORDS, PARSED_ADAPTIVE, CLEAN_ADAPTIVE])
STATIC_MERGED = ", ".join([STATIC, MERGED_STATIC])
ADAPTIVE_MERGED = ", ".join([ADAPTIVE, MERGED_ADAPTIVE])
STATIC_SCORED = ", ".join([STATIC_MERGED, SCORED_STATIC])
ADAPTIVE_SCORED = ", ".join([ADAPTIVE_MERGED, SCORED_ADAPTIVE])

_KEYED = "{p}_{t}_k AS (SELECT *, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS k{i}" for i, c in enumerate(["ID_IMDB", "ID_RT", "ID_METACRITIC", "ID_MOVIELENS"])
) + """,
  concat_ws('|', coalesce(CAST(ID_IMDB AS VARCHAR), 'NA'), coalesce(CAST(ID_RT AS VARCHAR), 'NA'),
    coalesce(CAST(ID_METACRITIC AS VARCHAR), 'NA'), coalesce(CAST(ID_MOVIELENS AS VARCHAR), 'NA'))
    AS entity_key,
  concat_ws('|', coalesce(CAST(ID_RT AS VARCHAR), 'NA'),
    coalesce(CAST(ID_METACRITIC AS VARCHAR), 'NA'), coalesce(CAST(ID_MOVIELENS AS VARCHAR), 'NA'))
    AS triple_key FROM {p}_{t})"""
KEYED = ", ".join(_KEYED.format(p=p, t=t) for p in ("ad", "st") for t in ("wide", "films"))
BOTH = ", ".join([RECORDS, PARSED_STATIC, CLEAN_STATIC, MERGED_STATIC,
                  PARSED_ADAPTIVE, CLEAN_ADAPTIVE, MERGED_ADAPTIVE, KEYED])


def r6(names: str) -> str:
    """Doubles rounded to six places under their own names."""
    return ", ".join(f"round({n.strip()}, 6) AS {n.strip()}" for n in names.split(","))
