"""Duplicate reports as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import record_key
from twinfold.schema import MatchSchema


def report_columns(schema: MatchSchema) -> list[str]:
    return [c for n in schema.names for c in (f"{n}_1", f"{n}_2", f"{n}_score", f"{n}_status")]


def report_header(schema: MatchSchema) -> str:
    return "|".join(c for n in schema.names for c in (f"{n}_1", f"{n}_2", "score", "status"))


def report_line(schema: MatchSchema) -> Column:
    cells = []
    for c in report_columns(schema):
        value = F.col(c)
        if c.endswith("_score"):
            value = F.round(value, 6).cast("string")
        cells.append(F.coalesce(value, F.lit("")))
    return F.concat_ws("|", *cells)


def report_lines(report: DataFrame, schema: MatchSchema) -> DataFrame:
    return report.select("rec_key_1", report_line(schema).alias("value"))


def write_dup_report(report: DataFrame, schema: MatchSchema, path: str, mode: str = "errorifexists") -> None:
    """Text lines, the header first, then those of a record together, in descending order of the lines.

    Files follow each other in this order, each a range of records. Values keep every character but line breaks.
    """
    header = report.sparkSession.createDataFrame([(0, "", report_header(schema))], "part int, rec_key_1 string, value string")
    rows = header.union(report_lines(report, schema).select(F.lit(1), "rec_key_1", "value"))
    rows.orderBy("part", "rec_key_1", F.desc("value")).select("value").write.mode(mode).text(path)


def read_dup_report(spark: SparkSession, schema: MatchSchema, path: str) -> DataFrame:
    """Written report lines as columns, with ``rec_key_1`` and ``rec_key_2`` as in the report."""
    lines = spark.read.text(path).where(F.col("value") != report_header(schema))
    cells = F.split("value", r"\|", -1)
    columns = [
        F.when(cells[i] != "", cells[i].cast("double")).alias(c) if c.endswith("_score") else cells[i].alias(c)
        for i, c in enumerate(report_columns(schema))
    ]
    read = lines.select(*columns)
    keys = [record_key(f"{schema.id_field.name}_{n}", f"{schema.database_field.name}_{n}").alias(f"rec_key_{n}") for n in (1, 2)]
    return read.select(*keys, *read.columns)
