"""Positional ``|``-delimited text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import fill_pattern, split_pipe, trim_control
from twinfold.schema import MatchSchema
from twinfold.session import stage


def drop_blank(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(trim_control(column) != "")


def read_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Text lines as ``value`` with ``line_at``, which orders lines as in their file.

    Bytes that do not decode become U+FFFD.
    """
    text = spark.read.text(path)
    if encoding.lower().replace("_", "-") in ("utf-8", "utf8"):
        value = F.make_valid_utf8("value")
    else:
        value = F.decode(F.col("value").cast("binary"), encoding)
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    return text.select(value.alias("value"), at.alias("line_at"))


def named_cells(cells: Column, schema: MatchSchema) -> list[Column]:
    return [F.coalesce(F.get(cells, F.lit(f.pos)), F.lit("")).alias(f.name) for f in schema.by_pos]


def parse_lines(lines: DataFrame, schema: MatchSchema, column: str = "value") -> DataFrame:
    """Lines to one column per schema field, other columns kept."""
    others = [c for c in lines.columns if c != column]
    cells = lines.withColumn("_cells", split_pipe(column))
    return cells.select(*others, *named_cells(F.col("_cells"), schema))


def read_pipe(spark: SparkSession, path: str, schema: MatchSchema, encoding: str = "utf-8") -> DataFrame:
    return parse_lines(drop_blank(read_lines(spark, path, encoding)), schema)


def pipe_line(schema: MatchSchema) -> Column:
    """Fields at their positions joined by ``|``; positions no field has stay empty."""
    by_pos = {f.pos: f.name for f in schema.fields}
    cells = [
        F.coalesce(F.col(by_pos[p]), F.lit("")) if p in by_pos else F.lit("") for p in range(schema.max_pos + 1)
    ]
    return F.concat_ws("|", *cells)


def joined_line(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def write_pipe(df: DataFrame, path: str, schema: MatchSchema, mode: str = "errorifexists") -> None:
    df.select(pipe_line(schema).alias("value")).write.mode(mode).text(path)


def marked_bad(checked: DataFrame, column: str = "value") -> DataFrame:
    """Bad lines with their ``[reason]`` appended."""
    return checked.where("reason IS NOT NULL").select(
        F.concat(F.col(column), F.lit(" ["), F.col("reason"), F.lit("]")).alias("value")
    )


def write_good_bad(checked: DataFrame, good: str, bad: str, mode: str = "errorifexists") -> None:
    """Good lines in one folder, bad ones with their reason in another; lines are validated once."""
    checked = stage(checked.select("value", "reason"), "checked")
    checked.where("reason IS NULL").select("value").write.mode(mode).text(good)
    marked_bad(checked).write.mode(mode).text(bad)


def write_by_pattern(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One output folder per fill pattern, with the lines of a pattern in few files."""
    cells = F.split("value", r"\|", -1)
    rows = lines.select(fill_pattern(cells).alias("pattern"), "value").hint("rebalance", "pattern")
    rows.write.mode(mode).partitionBy("pattern").text(path)
