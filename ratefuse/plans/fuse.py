"""The configured run: source files in, stage tables, rejects, findings and films out."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratefuse.functions import parse
from ratefuse.operators import clean, merge, score, validate
from ratefuse.operators.merge import ADAPTIVE, STATIC
from ratefuse.sources import readers, writers
from ratefuse.sources.discover import discover
from ratefuse.sources.specs import ADAPTIVE_SPECS, SourceSpec, lookup

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunConfig:
    """What a run reads, how it treats it and where it writes.

    ``sources`` maps a source name to ``{"file_path": ...}``, or to ``{"movies_path": ...,
    "ratings_path": ...}`` for a source that comes as films and single ratings.  Sources with
    a ``shared_id`` (a raw column that names the same film in each of them) get the same title
    for the same id.  ``last_year`` is the latest year that cleaning keeps, ``max_year`` the
    latest one that validation accepts.
    """

    base_uri: str
    sources: dict[str, dict]
    run_id: str
    max_year: int
    dialect: str = "static"
    min_ratings: int = 2
    outliers: str = "none"
    outlier_options: dict[str, float] = field(default_factory=dict)
    save_intermediate: bool = True
    allow_empty: bool = False
    final_format: str = "parquet"
    last_year: int = parse.LAST_YEAR

    def path(self, stage: str) -> str:
        return f"{self.base_uri.rstrip('/')}/{stage}"

    def run_path(self, stage: str) -> str:
        """Of a table that keeps the results of several runs; a repeated run replaces its own."""
        return f"{self.path(stage)}/run_id={self.run_id}"


def _spec(spark: SparkSession, name: str, config: RunConfig) -> SourceSpec | None:
    if config.dialect == "adaptive" and name in ADAPTIVE_SPECS:
        return ADAPTIVE_SPECS[name]
    spec, options = lookup(name), config.sources[name]
    if spec is None and options.get("discover"):
        return discover(name, readers.csv_header(spark, options["file_path"]))
    return spec


def _read(spark: SparkSession, spec: SourceSpec, options: dict[str, str]) -> DataFrame:
    if "movies_path" not in options:
        return readers.read_source(spark, spec, options["file_path"])
    movies = readers.read_source(spark, spec, options["movies_path"])
    ratings = readers.read_csv(spark, options["ratings_path"], strict=spec.strict)
    stars = ratings.select("movieId", parse.number(F.col("rating")).alias("stars"))
    return clean.mean_ratings(movies, stars, "movieId", "stars")


def _parse(
    spark: SparkSession, spec: SourceSpec, options: dict[str, str], last_year: int
) -> DataFrame:
    """Parsed rows of one source, each with its raw record and shared id."""
    raw = _read(spark, spec, options)
    shared = F.col(options["shared_id"]) if "shared_id" in options else F.lit(None)
    keep = [clean.raw_record(raw), shared.cast("string").alias("shared_id")]
    return clean.parse_source(raw, spec, keep=keep, last_year=last_year)


def parse_configured(spark: SparkSession, config: RunConfig) -> tuple[DataFrame, list[str]]:
    """Parsed rows of all sources whose plan can be built, and the names of these sources."""
    parts, names = [], []
    for name, options in config.sources.items():
        spec = _spec(spark, name, config)
        if spec is None:
            log.warning("no source definition for %s, skipped", name)
            continue
        try:
            parts.append(_parse(spark, spec, options, config.last_year))
            names.append(spec.name)
        except Exception:
            log.exception("source %s failed, skipped", name)
    if not parts:
        raise ValueError("no source could be read")
    return reduce(DataFrame.unionByName, parts), names


def store_sources(
    spark: SparkSession, config: RunConfig, path: str
) -> tuple[DataFrame, list[str], list[tuple]]:
    """Parse and write each source by itself; a source that fails stops no other one.

    An unknown name, a missing file and a row that cannot be read are all recorded as findings
    of their source.  Returns the rows of the sources that were written, their names, and the
    findings.
    """
    written, names, failed, schema = [], [], [], None
    for name, options in config.sources.items():
        try:
            spec = _spec(spark, name, config)
            if spec is None:
                raise LookupError("no source definition")
            part = _parse(spark, spec, options, config.last_year)
            writers.write_table(part, f"{path}/{spec.name}")
        except Exception as error:  # any failure of a source is its own
            log.exception("source %s failed, skipped", name)
            reason = (str(error).strip() or repr(error)).splitlines()[0]
            failed.append((name, "source", "", None, f"{name}: not read: {reason}"))
            continue
        written.append(f"{path}/{spec.name}")
        names.append(spec.name)
        schema = part.schema
    if not written:
        raise ValueError("no source could be read")
    return spark.read.schema(schema).parquet(*written), names, failed


KINDS = ("clean", "invalid", "duplicate")


def run(spark: SparkSession, config: RunConfig) -> dict[str, str]:
    """Run all stages.  Each one is written and read back, so that none is computed twice
    and a lost executor costs at most the stage it was in.  Rows are counted while they are
    written.  Returns the paths.
    """
    dialect = ADAPTIVE if config.dialect == "adaptive" else STATIC
    paths = {
        s: config.path(s)
        for s in ("parsed", "routed", "cleaned", "wide", "merged", "ambiguous", "invalid", "duplicates",
                  "scored", "final")
    } | {s: config.run_path(s) for s in ("rejects", "findings", "failures", "summary")}
    parsed, names, failed = store_sources(spark, config, paths["parsed"])
    writers.write_findings(
        spark.createDataFrame([(*f, config.run_id) for f in failed], f"{validate.FINDING}, run_id string"),
        paths["failures"],
    )
    routed = clean.route(parsed, dialect.claim)
    counts = writers.write_counted(
        routed, paths["routed"],
        {(s, k): F.count_if((F.col("source") == s) & (F.col("kind") == k)) for s in names for k in KINDS},
        partition_by=["source", "kind"],
    )
    routed = spark.read.schema(routed.schema).parquet(paths["routed"])
    cleaned, rejects = clean.split_routed(routed)
    writers.write_rejects(clean.with_records(rejects, parsed), paths["rejects"], config.run_id)
    if not any(counts[s, "clean"] for s in names) and not config.allow_empty:
        raise ValueError("no row survived cleaning")
    if config.save_intermediate:
        writers.write_table(cleaned, paths["cleaned"], partition_by=["source"])
    _report_sources(cleaned, "cleaned", config, paths)

    if any("shared_id" in config.sources[s] for s in config.sources):
        ids = parsed.select("source", "row_id", "shared_id")
        long = merge.with_group_title(cleaned.join(ids, ["source", "row_id"]), dialect, ["shared_id"])
    else:
        long = merge.with_group_title(cleaned, dialect)
    wide = merge.merge_long(long, names, dialect)
    writers.write_table(wide, paths["wide"])
    wide = spark.read.schema(wide.schema).parquet(paths["wide"])
    films = merge.keep_rated(wide, dialect, config.min_ratings)
    total = writers.write_counted(merge.ranked(films), paths["merged"], {"films": F.count(F.lit(1))})
    films = spark.read.schema(films.schema).parquet(paths["merged"])
    rated = merge.keep_rated(wide, replace(dialect, drop_ambiguous=False), config.min_ratings)
    writers.write_table(merge.ambiguous_films(rated), paths["ambiguous"])
    _report(films, "merged", config, paths)

    scored = score.score(
        films, dialect, config.min_ratings, config.outliers, **config.outlier_options
    )
    writers.write_table(scored, paths["scored"])
    scored = spark.read.schema(scored.schema).parquet(paths["scored"])
    final = score.keep_scored(scored, config.min_ratings)
    writers.write_table(merge.ranked(final), paths["final"], config.final_format)
    _report(scored, "final", config, paths)
    _summary(spark, counts, names, [f[0] for f in failed], total["films"], config, paths)
    return paths


def _report_sources(rows: DataFrame, stage: str, config: RunConfig, paths: dict[str, str]) -> None:
    """Findings of each source of a stage, its invalid rows, and its repeated ones."""
    found = validate.validate_by_source(rows, stage, config.max_year)
    _write_findings(found, stage, config, paths)
    bad = validate.invalid_by_source(rows, config.max_year)
    writers.write_table(bad, f"{paths['invalid']}/{stage}")
    repeated = validate.duplicated_rows(rows, ["source", "row_id"], within=["source"])
    writers.write_table(repeated, f"{paths['duplicates']}/{stage}")


def _write_findings(found: DataFrame, stage: str, config: RunConfig, paths: dict[str, str]) -> None:
    tagged = found.withColumn("run_id", F.lit(config.run_id))
    writers.write_findings(tagged, f"{paths['findings']}/stage={stage}")


def _report(df: DataFrame, stage: str, config: RunConfig, paths: dict[str, str]) -> None:
    """Findings of a stage, and its invalid rows (an empty table if there are none)."""
    found = validate.validate_table(df, stage, config.max_year, allow_empty=config.allow_empty)
    _write_findings(found, stage, config, paths)
    bad = validate.invalid_rows(df, config.max_year)
    writers.write_table(bad, f"{paths['invalid']}/{stage}")


def _summary(
    spark: SparkSession, counts: dict[tuple[str, str], int], names: list[str], failed: list[str],
    films: int, config: RunConfig, paths: dict[str, str],
) -> None:
    """Run record: ids, parameters, rows per source and kind, number of films, paths.

    The counts were taken while the stages were written.
    """
    rows = [
        (s, sum(counts[s, k] for k in KINDS), *[counts[s, k] for k in KINDS]) for s in sorted(names)
    ]
    record = spark.createDataFrame(
        [(config.run_id, config.dialect, config.min_ratings, config.outliers, rows, failed, films,
          paths["final"])],
        "run_id string, dialect string, min_ratings int, outliers string, sources array<struct<"
        "source string, rows_in long, rows_clean long, rows_invalid long, rows_duplicate long>>,"
        " failed array<string>, films long, final_path string",
    )
    record.write.mode("overwrite").json(paths["summary"])
