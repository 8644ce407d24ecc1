"""Sinks: result tables, rejects, findings, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, StructType


def csv_ready(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, so that a CSV sink can hold them."""
    columns = []
    for field in df.schema.fields:
        nested = isinstance(field.dataType, (ArrayType, StructType))
        columns.append(F.to_json(field.name).alias(field.name) if nested else F.col(field.name))
    return df.select(*columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a result; nested columns become JSON text in CSV."""
    out = csv_ready(df) if fmt == "csv" else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(df: DataFrame, path: str, counts: dict[str, Column], **options) -> dict[str, int]:
    """Write a result and count on the way: each count comes from the rows that are written."""
    seen = Observation()
    named = {f"n{i}": c for i, c in enumerate(counts.values())}
    write_table(df.observe(seen, *[c.alias(n) for n, c in named.items()]), path, **options)
    return {name: seen.get[f"n{i}"] for i, name in enumerate(counts)}


def write_rejects(rejects: DataFrame, path: str, run_id: str) -> None:
    """Write the rejected rows of a run, laid out by source and kind, tagged with the run."""
    tagged = rejects.withColumn("run_id", F.lit(run_id))
    write_table(tagged, path, partition_by=["source", "kind"])


def write_findings(findings: DataFrame, path: str) -> None:
    """Write the findings of a validation as JSON lines."""
    findings.write.mode("overwrite").json(path)
