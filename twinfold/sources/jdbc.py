"""Relational extraction: run queries, clean the cells, emit positional rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import REPEAT_SEP, cell_text, json_element, split_repeated, suffix_language

JSON_TAGS = ("text", "_f")
LANG_TAG = "_i"
REPEATED = ("title",)
ID_COLUMN = "reference_ptr_id"


@dataclass(frozen=True)
class Split:
    """Read a query in parts: ranges of a whole-number column of its result."""

    column: str
    parts: int


def _as_table(query: str) -> str:
    return f"({query.strip().rstrip(';')}) q"


def bounds_query(query: str, split: Split) -> str:
    return f"SELECT min({split.column}) AS low, max({split.column}) AS high FROM {_as_table(query)}"


def read_options(query: str, split: Split | None = None, low: int | None = None, high: int | None = None) -> dict[str, str]:
    """Options of a database read: one task for each range of the column, or one in all. Rows
    below, above or without a value of the column are read as well."""
    options = {"dbtable": _as_table(query)}
    if split is None or low is None or high is None:
        return options
    return options | {
        "partitionColumn": split.column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, min(split.parts, high - low + 1))),
    }


def run_queries(
    spark: SparkSession, queries: list[str], jdbc: dict[str, str] | None = None, split: Split | None = None
) -> list[DataFrame]:
    """One frame per query, sent to the database when ``jdbc`` holds its options, else run
    over the session's views. With ``split`` the database is asked for ranges of a column."""
    if jdbc is None:
        return [spark.sql(q) for q in queries]
    frames = []
    for q in queries:
        low = high = None
        if split is not None:
            low, high = spark.read.format("jdbc").options(**jdbc).option("query", bounds_query(q, split)).load().first()
        frames.append(spark.read.format("jdbc").options(**jdbc, **read_options(q, split, low, high)).load())
    return frames


def union_positional(frames: list[DataFrame]) -> DataFrame:
    """Append results by position, under the first result's names."""
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def read_jdbc_queries(
    spark: SparkSession, queries: list[str], jdbc: dict[str, str] | None = None, split: Split | None = None
) -> DataFrame:
    return union_positional(run_queries(spark, queries, jdbc, split))


def clean_record(
    df: DataFrame,
    json_tags: tuple[str, ...] = JSON_TAGS,
    lang_tag: str = LANG_TAG,
    repeated: tuple[str, ...] = REPEATED,
    sep: str = REPEAT_SEP,
    id_column: str = ID_COLUMN,
) -> DataFrame:
    """Cells to plain text, one row per value of each repetitive field, language to the id."""
    names = df.columns
    out = df.select(*[cell_text(F.col(c).cast("string")).alias(c) for c in names])
    if json_tags:
        out = out.select(*[json_element(c, json_tags, lang_tag, sep).alias(c) for c in names])
    out = out.select(*[F.replace(F.col(c), F.lit("|"), F.lit(" ")).alias(c) for c in names])
    for c in names:
        if c in repeated:
            out = out.withColumn(c, F.explode(split_repeated(c, sep)))
    ids = [i for i, c in enumerate(names) if c.lower() == id_column.lower()]
    if not ids:
        return out
    moved = out.select(suffix_language(F.array(*names), ids[0]).alias("_cells"))
    return moved.select(*[F.get("_cells", F.lit(i)).alias(c) for i, c in enumerate(names)])


def queries_to_records(
    spark: SparkSession,
    queries: list[str],
    jdbc: dict[str, str] | None = None,
    split: Split | None = None,
    **cleaning,
) -> DataFrame:
    """Extract, clean and append; each query keeps its own id column and column names
    while its rows are cleaned."""
    return union_positional([clean_record(f, **cleaning) for f in run_queries(spark, queries, jdbc, split)])
