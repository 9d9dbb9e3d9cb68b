"""``<add><doc><field name=...>`` files to positional records per document type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.functions.text import REPEAT_SEP, join_repeated

# Element and attribute names of the document files.
ROW_TAG = "doc"
_DOC = T.StructType(
    [
        T.StructField(
            "field",
            T.ArrayType(
                T.StructType([T.StructField("_name", T.StringType()), T.StructField("_VALUE", T.StringType())])
            ),
        )
    ]
)


def read_xml_docs(
    spark: SparkSession, folder: str, include: str = ".*", exclude: str | None = None, encoding: str = "utf-8"
) -> DataFrame:
    """One row per document: ``file`` and ``fields``, the (name, value) list in order."""
    docs = (
        spark.read.format("xml")
        .option("rowTag", ROW_TAG)
        .option("charset", encoding)
        .option("ignoreSurroundingSpaces", "false")
        .schema(_DOC)
        .load(folder)
    )
    name = F.col("_metadata.file_name")
    keep = name.rlike(f"^(?:{include})$")
    if exclude:
        keep = keep & ~name.rlike(f"^(?:{exclude})$")
    fields = F.transform(
        F.coalesce(F.col("field"), F.array()),
        lambda f: F.struct(f["_name"].alias("name"), F.coalesce(f["_VALUE"], F.lit("")).alias("value")),
    )
    return docs.where(keep).select(name.alias("file"), fields.alias("fields"))


def values_of(name: str, fields: str = "fields"):
    """All values of one field of a document, in order."""
    return F.filter(F.col(fields), lambda f: f["name"] == name)["value"]


def with_type(docs: DataFrame) -> DataFrame:
    return docs.withColumn("type", F.lower(F.get(values_of("type"), F.lit(0))))


def known_types(docs: DataFrame, tables: dict[str, dict[str, int]]) -> DataFrame:
    return with_type(docs).where(F.col("type").isin([t.lower() for t in tables]))


def skipped_by_type(docs: DataFrame, tables: dict[str, dict[str, int]]) -> DataFrame:
    """Documents left out, per reason and type."""
    typed = with_type(docs)
    reason = F.when(F.coalesce("type", F.lit("")) == "", "unknown document type").otherwise("unknown conversion table")
    known = F.coalesce(F.col("type").isin([t.lower() for t in tables]), F.lit(False))
    return (
        typed.where(~known)
        .groupBy(reason.alias("reason"), F.coalesce("type", F.lit("")).alias("type"))
        .agg(F.count("*").alias("docs"))
    )


def docs_to_lines(docs: DataFrame, tables: dict[str, dict[str, int]], sep: str = REPEAT_SEP) -> DataFrame:
    """(type, value): each known document as a line laid out by its type's table."""
    line = F.lit(None).cast("string")
    for doc_type, table in tables.items():
        at = {pos: name for name, pos in table.items() if name != "type"}
        cells = [
            join_repeated(values_of(at[p]), sep) if p in at else F.lit("") for p in range(max(table.values()) + 1)
        ]
        line = F.when(F.col("type") == doc_type.lower(), F.concat_ws("|", *cells)).otherwise(line)
    return known_types(docs, tables).select("type", line.alias("value"))


def write_by_type(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.hint("rebalance", "type").write.mode(mode).partitionBy("type").text(path)


def xml_to_pipe(
    spark: SparkSession,
    folder: str,
    out: str,
    tables: dict[str, dict[str, int]],
    include: str = ".*",
    exclude: str | None = None,
    mode: str = "errorifexists",
) -> None:
    write_by_type(docs_to_lines(read_xml_docs(spark, folder, include, exclude), tables), out, mode)
