"""Column fill rates and fill patterns.

One pass folds the lines into a table of distinct fill patterns with counts; every
figure is derived from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from twinfold.functions.text import fill_pattern, trim_control
from twinfold.session import stage


def _split(column: str, separator: str):
    return F.split(trim_control(column), "\\Q" + separator + "\\E", -1)


def patterns(lines: DataFrame, column: str = "value", separator: str = "|") -> DataFrame:
    """(pattern, used, columns, lines) over non-blank lines."""
    return (
        lines.where(trim_control(column) != "")
        .groupBy(fill_pattern(_split(column, separator)).alias("pattern"))
        .agg(F.count("*").alias("lines"))
        .select(
            "pattern",
            F.length(F.replace("pattern", F.lit("0"), F.lit(""))).alias("used"),
            F.length("pattern").alias("columns"),
            "lines",
        )
    )


def _percent(part, whole):
    return F.round(part * F.lit(100.0) / whole, 6)


def totals(pats: DataFrame) -> DataFrame:
    return pats.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.coalesce(F.max("columns"), F.lit(0)).alias("columns")
    )


def column_presence(pats: DataFrame) -> DataFrame:
    """Per 1-based column: lines that fill it and their share of all lines."""
    whole = totals(pats)
    filled = (
        pats.select(F.posexplode(F.split("pattern", "")).alias("at", "bit"), "lines")
        .where("bit IN ('0', '1')")
        .groupBy((F.col("at") + 1).alias("column"))
        .agg(F.sum(F.when(F.col("bit") == "1", F.col("lines")).otherwise(0)).alias("used_lines"))
    )
    # one-row totals joined by a constant key
    return (
        filled.withColumn("one", F.lit(1))
        .join(F.broadcast(whole.select(F.col("lines").alias("total"), F.lit(1).alias("one"))), "one")
        .select("column", "used_lines", _percent(F.col("used_lines"), F.col("total")).alias("percent"))
    )


def pattern_counts(pats: DataFrame) -> DataFrame:
    """Lines per pattern and the share among patterns with as many used columns."""
    share = F.sum("lines").over(W.partitionBy("used"))
    return pats.select("pattern", "used", "lines", _percent(F.col("lines"), share).alias("percent"))


def used_columns(pats: DataFrame) -> DataFrame:
    """Lines per number of used columns, from none to all, zeros included."""
    whole = totals(pats)
    every = whole.select(
        F.explode(F.sequence(F.lit(0).cast("int"), F.col("columns").cast("int"))).alias("used"),
        F.col("lines").alias("total"),
    )
    counts = pats.groupBy("used").agg(F.sum("lines").alias("n"))
    lines = F.coalesce("n", F.lit(0))
    return every.join(counts, "used", "left").select(
        "used", lines.alias("lines"), _percent(lines, F.col("total")).alias("percent")
    )


def pattern_order(counted: DataFrame) -> DataFrame:
    """Patterns grouped by used columns, most frequent first, later pattern first on ties."""
    return counted.orderBy("used", F.desc("lines"), F.desc("pattern"))


def profile(lines: DataFrame, column: str = "value", separator: str = "|") -> DataFrame:
    """The whole profile as rows (section, item, lines, percent)."""
    pats = stage(patterns(lines, column, separator), "patterns")
    nothing = F.lit(None).cast("double")
    whole = totals(pats)
    parts = [
        whole.select(F.lit("lines").alias("section"), F.lit("").alias("item"), F.col("lines"), nothing.alias("percent")),
        whole.select(F.lit("columns"), F.lit(""), F.col("columns").cast("long"), nothing),
        column_presence(pats).select(F.lit("column"), F.col("column").cast("string"), F.col("used_lines"), F.col("percent")),
        used_columns(pats).select(F.lit("used"), F.col("used").cast("string"), F.col("lines"), F.col("percent")),
        pattern_counts(pats).select(F.lit("pattern"), F.col("pattern"), F.col("lines"), F.col("percent")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out
