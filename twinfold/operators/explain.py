"""Score given pairs of records and say why they are, or are not, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.functions.compare import DENIED, NEEDS_MAX, prepared, score_fields
from twinfold.schema import MatchSchema


def score_pairs(pairs: DataFrame, schema: MatchSchema, exact: bool = True) -> DataFrame:
    """Pairs with ``<f>_1``, ``<f>_2`` per field: add similarity, scores, statuses, verdict.

    The similarity is exact for every pair, duplicate or not; with ``exact=False`` it is
    0 for a pair no tier can accept, which spares most of the work.
    """
    names = pairs.columns
    scored = score_fields(prepared(prepared(pairs, schema, "_1"), schema, "_2"), schema, exact)
    added = [c for f in schema.compared for c in (f"score_{f.name}", f"status_{f.name}")]
    return scored.select(*names, "similarity", *added, "min_fields", "matched_fields", "duplicate")


def pair_up(requests: DataFrame, docs: DataFrame, records: DataFrame, schema: MatchSchema) -> DataFrame:
    """Requests (key_1, key_2) joined with an input document and a stored record each."""
    one = docs.select(F.col("rec_key").alias("key_1"), *[F.col(n).alias(f"{n}_1") for n in schema.names])
    two = records.select(F.col("rec_key").alias("key_2"), *[F.col(n).alias(f"{n}_2") for n in schema.names])
    return requests.join(one, "key_1").join(two, "key_2")


#: Why a pair is, or is not, a duplicate.
DUPLICATE, TOO_FAR, DENIED_BY, NOT_EQUAL, TOO_FEW = "duplicate", "below_tiers", "denied", "not_identical", "too_few_fields"


def explain_pairs(pairs: DataFrame, schema: MatchSchema) -> DataFrame:
    """Scored pairs with ``reason`` (a code), ``fields`` (name, both values, score and
    status of each compared field) and ``report``, the same as text."""
    scored = score_pairs(pairs, schema)
    denied, strict = F.lit(False), F.lit(False)
    fields = []
    for f in schema.compared:
        status = F.col(f"status_{f.name}")
        denied, strict = denied | (status == DENIED), strict | (status == NEEDS_MAX)
        fields.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.coalesce(f"{f.name}_1", F.lit("")).alias("value_1"),
                F.coalesce(f"{f.name}_2", F.lit("")).alias("value_2"),
                F.round(f"score_{f.name}", 6).alias("score"),
                status.alias("status"),
            )
        )
    reason = (
        F.when(F.col("duplicate"), DUPLICATE)
        .when(F.col("min_fields").isNull(), TOO_FAR)
        .when(denied, DENIED_BY)
        .when(strict & (F.col("similarity") < 1.0), NOT_EQUAL)
        .otherwise(TOO_FEW)
    )
    told = scored.withColumns({"reason": reason, "fields": F.array(*fields)})
    line = lambda x: F.concat_ws("\t", x["status"], x["name"], x["value_1"], x["value_2"])
    summary = F.concat_ws(
        "\t",
        F.col("reason"),
        F.format_string("%.6f", "similarity"),
        F.concat_ws("/", F.col("matched_fields").cast("string"), F.coalesce(F.col("min_fields").cast("string"), F.lit("-"))),
        F.coalesce(f"{schema.index_field.name}_1", F.lit("")),
        F.coalesce(f"{schema.index_field.name}_2", F.lit("")),
    )
    return told.withColumn("report", F.concat_ws("\n", summary, F.array_join(F.transform("fields", line), "\n")))

