"""From raw source rows to canonical rows, every rejected row with its reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratefuse.functions.parse import FIRST_YEAR, LAST_YEAR
from ratefuse.functions.text import normalize_title
from ratefuse.operators.keyed import first_ids, first_per_key
from ratefuse.sources.specs import SourceSpec

# Reject reasons.
EMPTY_TITLE = "empty title"
MISSING_YEAR = "missing year"
INVALID_YEAR = "invalid year"
MISSING_RATING = "missing rating"
DUPLICATE = "duplicate title+year"

CANONICAL = [
    "source", "row_id", "id", "title", "title_raw", "year", "release_date", "genres", "rating",
]
KEY = ["source", "title", "year"]
MERGED = [c for c in CANONICAL if c != "title_raw"]


def reject_reason(
    rating_required: bool = True, year_first: bool = False, last_year: int = LAST_YEAR
) -> Column:
    """The first rule a row breaks, null if it breaks none.

    ``year_first``: a row without a year is reported as such before all other rules.
    """
    bad_year = F.col("year").isNull() | ~F.col("year").between(FIRST_YEAR, last_year)
    rules = [
        F.when(F.trim("title") == "", EMPTY_TITLE),
        F.when(bad_year, INVALID_YEAR),
    ]
    if year_first:
        rules.insert(0, F.when(F.col("year").isNull(), MISSING_YEAR))
    if rating_required:
        rules.append(F.when(F.col("rating").isNull(), MISSING_RATING))
    return F.coalesce(*rules)


def parse_source(
    raw: DataFrame, spec: SourceSpec, row_id: str = "row_id", keep: list[Column] = (),
    last_year: int = LAST_YEAR,
) -> DataFrame:
    """Canonical columns plus ``reason`` for every raw row; one projection, no shuffle.

    ``keep``: further expressions over the raw columns, such as ``raw_record``.
    ``last_year``: the latest year of a valid row.
    """
    fields = spec.fields(raw)
    title = normalize_title(fields["title_raw"], **dict(spec.title_options))
    parsed = raw.select(
        F.lit(spec.name).alias("source"),
        F.col(row_id).cast("long").alias("row_id"),
        fields.get("id", F.col(row_id)).cast("long").alias("id"),
        title.alias("title"),
        *[fields[c].alias(c) for c in ("title_raw", "year", "release_date", "genres", "rating")],
        *keep,
    )
    reason = reject_reason(spec.rating_required, spec.year_first, last_year)
    return parsed.withColumn("reason", reason)


def parse_sources(
    raws: dict[str, DataFrame], specs: dict[str, SourceSpec], last_year: int = LAST_YEAR
) -> DataFrame:
    """All sources in one table, so that the later steps shuffle once for all of them."""
    parts = [parse_source(raw, specs[name], last_year=last_year) for name, raw in raws.items()]
    return reduce(DataFrame.unionByName, parts)


def keep_clean(
    parsed: DataFrame, claim: str = "before", columns: list[str] | None = None
) -> DataFrame:
    """Valid rows, the first of each (source, title, year), with the columns asked for.

    ``claim='before'``: the first row takes the key even if it is invalid, and then
    shadows later valid ones.  ``claim='after'``: only valid rows take keys.
    """
    columns = columns or CANONICAL
    carried = [c for c in columns if c not in KEY and c != "row_id"]
    if claim == "after":
        # An invalid row has no rank, so it cannot be the first of its key.
        rank = F.when(F.col("reason").isNull(), F.col("row_id"))
    else:
        rank = F.col("row_id")
    first = first_per_key(parsed, KEY, rank, [*carried, "reason", "row_id"])
    valid = F.col("row_id").isNotNull() & F.col("reason").isNull()
    return first.filter(valid).select(*columns)


def route(parsed: DataFrame, claim: str = "before") -> DataFrame:
    """Every row with ``kind`` (clean, invalid, duplicate) and ``reason``.

    The row that owns a key is found by aggregation and matched back on the unique row
    id, so rows of one key never meet in one task.  Rows rejected for a missing year
    have no key.
    """
    no_key = F.col("reason").eqNullSafe(MISSING_YEAR)
    eligible = ~no_key if claim == "before" else F.col("reason").isNull()
    owners = first_ids(parsed, KEY, "row_id", eligible).select(
        "source", "row_id", F.lit(True).alias("owner")
    )
    marked = parsed.join(owners, ["source", "row_id"], "left")
    repeated = F.col("owner").isNull() & ~no_key
    if claim == "after":
        repeated = repeated & F.col("reason").isNull()
    kind = F.when(repeated, "duplicate").when(F.col("reason").isNotNull(), "invalid")
    reason = F.when(repeated, DUPLICATE).otherwise(F.col("reason"))
    return marked.select(
        *CANONICAL, kind.alias("kind"), reason.alias("reason")
    ).fillna({"kind": "clean"})


def split_routed(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rejects of a routed table."""
    clean = routed.filter(F.col("kind") == "clean").select(*CANONICAL)
    return clean, routed.filter(F.col("kind") != "clean")


def raw_record(raw: DataFrame, row_id: str = "row_id") -> Column:
    """All original columns of a raw row as JSON text (``record``), nulls included."""
    columns = [c for c in raw.columns if c != row_id]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record")


def with_records(rejects: DataFrame, parsed: DataFrame) -> DataFrame:
    """Rejects with the raw record they came from, matched on the unique row id."""
    records = parsed.select("source", "row_id", "record")
    return rejects.join(records, ["source", "row_id"])


def mean_ratings(movies: DataFrame, ratings: DataFrame, key: str, rating: str) -> DataFrame:
    """Each movie with the mean of its ratings (two places), null if it has none."""
    means = ratings.groupBy(key).agg((F.rint(F.avg(rating) * 100) / 100).alias("average_rating"))
    return movies.join(means, key, "left")


def stage_counts(routed: DataFrame) -> DataFrame:
    """Per source: rows read, rows behind cleaning, and what was lost to which kind."""
    def rows_of(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    return routed.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows_in"),
        rows_of("clean").alias("rows_clean"),
        rows_of("invalid").alias("rows_invalid"),
        rows_of("duplicate").alias("rows_duplicate"),
    )
