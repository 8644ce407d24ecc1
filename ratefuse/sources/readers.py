"""CSV and Parquet scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratefuse.operators.keyed import prefix_sums
from ratefuse.sources.quoted import read_quoted, value_count
from ratefuse.sources.specs import SourceSpec

_CORRUPT = "_corrupt_record"


def _strings(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line (a metadata read of one row)."""
    return spark.read.csv(path, header=True, escape='"').columns


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    strict: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All-string CSV scan with a header line.

    Short rows are kept and padded with nulls.  A row with too many values is skipped,
    or fails the job if ``strict``.  ``multi_line``: quoted values may hold newlines.
    """
    columns = columns or csv_header(spark, path)
    if multi_line:
        return read_quoted(spark, path, columns, strict).drop("row_id")
    # Without all columns parsed, a row with too many values would go unnoticed.
    reader = spark.read.options(header=True, escape='"', columnPruning=False)
    if strict:
        return reader.schema(_strings(columns)).option("mode", "FAILFAST").csv(path)
    schema = _strings(columns + [_CORRUPT])
    rows = (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    # A row that is not as long as the header and has a last value is longer; without one,
    # its values are counted.
    longer = F.col(columns[-1]).isNotNull() | (value_count(F.col(_CORRUPT)) > len(columns))
    too_long = F.col(_CORRUPT).isNotNull() & longer
    return rows.filter(~too_long).drop(_CORRUPT)


def read_source(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """Scan one source file with the columns its header names, numbered in file order."""
    if spec.multi_line:
        return read_quoted(spark, path, csv_header(spark, path), spec.strict)
    return with_file_row_id(read_csv(spark, path, None, spec.strict))


def with_file_row_id(rows: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows of a file scan from 1 in file order.

    Each file block is read in order by one task, so the position in a block is known
    without a sort; only one row per block goes through the running sum of offsets.
    """
    data = rows.columns
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    blocks = placed.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first")
    )
    offsets = prefix_sums(blocks, "_size", ["_file", "_start"], "_offset")
    row_id = F.col("_offset") + F.col("_at") - F.col("_first") + 1
    return placed.join(offsets, ["_file", "_start"]).select(row_id.alias(name), *data)


def read_directory(spark: SparkSession, pattern: str, columns: list[str] = ()) -> DataFrame:
    """All CSV files of a glob, tagged with their stem; stage outputs are skipped.

    Each file is read by its own header, files of one header in one scan.  Columns meet by
    name; those that a file lacks are null in its rows, and ``columns`` are there in any case.
    """
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").load(pattern).filter(~is_stage_output(name))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(r.path for r in files.select("path").collect()):  # names, no contents
        by_header.setdefault(tuple(csv_header(spark, path)), []).append(path)
    rows = spark.createDataFrame([], _strings([*columns, "source"]))
    for header, paths in by_header.items():
        part = read_csv(spark, paths, list(header))
        tagged = part.withColumn("source", file_stem(F.col("_metadata.file_name")))
        rows = rows.unionByName(tagged, allowMissingColumns=True)
    return rows


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def is_stage_output(name: Column) -> Column:
    # Name parts of files that are results, not sources.
    endings = ["merged.csv", "all_movies_wide.csv", "all_movies_wide_fuzzy.csv"]
    parts = ["_invalid_records", "_duplicates"]
    found = F.lit(False)
    for e in endings:
        found = found | name.endswith(e)
    for p in parts:
        found = found | name.contains(p)
    return found


def order_breaks(
    spark: SparkSession, path: str, key: Callable[[DataFrame], Column]
) -> DataFrame:
    """Places (file, row_index) of a Parquet table whose row comes before the row ahead of it.

    ``key`` gives the value that must not fall from row to row, in file order.  Each file is
    looked at by itself; of all files only the first and the last value meet.
    """
    rows = spark.read.parquet(path)
    placed = rows.select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"),
        key(rows).alias("key"),
    )
    ahead = F.lag("key").over(Window.partitionBy("file").orderBy("row_index"))
    inside = placed.withColumn("ahead", ahead).filter(F.col("key") < F.col("ahead"))
    ends = placed.groupBy("file").agg(
        F.min_by("key", "row_index").alias("key"), F.max_by("key", "row_index").alias("last")
    )
    ahead = F.lag("last").over(Window.orderBy("file"))
    between = ends.withColumn("ahead", ahead).filter(F.col("key") < F.col("ahead"))
    return inside.select("file", "row_index").unionByName(
        between.select("file", F.lit(0).cast("long").alias("row_index"))
    )


def dataset_tag(name: Column) -> Column:
    """Tag of the source a file name points to, ``DATA`` if it points to none."""
    # Parts of a file name and the tag they stand for, first match wins.
    tags = {
        "imdb": "IMDB", "movielens": "MOVIELENS", "metacritic": "METACRITIC",
        "rotten": "RT", "rt": "RT",
    }
    lowered = F.lower(name)
    known = [F.when(lowered.contains(part), tag) for part, tag in tags.items()]
    return F.coalesce(*known, F.lit("DATA"))


def read_rules(spark: SparkSession, path: str) -> list[dict]:
    """Row schema rules, a JSON array of ``{field, type, rule}`` (one entry per field)."""
    rules = spark.read.schema("field string, type string, rule string").json(path, multiLine=True)
    return [r.asDict() for r in rules.collect()]


def load_stages(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Stage outputs by name; one that does not exist is left out."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except AnalysisException:
            continue
    return found


def file_inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """SHA-256, name and size of every file a glob matches."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(
        F.sha2(F.col("content"), 256).alias("sha256"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
    )
