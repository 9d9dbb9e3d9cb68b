"""Records nearest to given texts."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from twinfold.functions.similarity import ngram_similarity
from twinfold.functions.text import normalize_text
from twinfold.session import stage

TOP = 10
STEP = 256
TEXTS = 256
RECORDS = 2_000


def similar_field_topk(
    records: DataFrame,
    texts: DataFrame | list[str],
    field: str,
    key: str = "rec_key",
    k: int = TOP,
    n: int = 3,
    normalized: str | None = None,
    as_is: bool = False,
) -> DataFrame:
    """(query, text, rank, similarity, key, field): the ``k`` records most similar to each text.

    ``texts`` is a list, numbered from 0, or a table (query, text) of any size. Texts and
    records are dealt into parts of bounded size and every part of texts meets every part
    of records; each meeting keeps its own best ``k`` per text. Ties go to the smaller key.
    ``as_is`` compares the texts without normalising them, ``normalized`` names a stored
    normalised column.
    """
    if isinstance(texts, list):
        texts = records.sparkSession.createDataFrame(list(enumerate(texts)), "query int, text string")
    norm = (lambda c: F.coalesce(F.col(c), F.lit(""))) if as_is else (lambda c: F.coalesce(normalize_text(c), F.lit("")))
    asked = stage(texts.select("query", norm("text").alias("norm")), "texts")
    stored = F.coalesce(F.col(normalized), F.lit("")) if normalized else norm(field)
    rows = records.select(F.col(key).alias("key"), F.col(field).alias("value"), stored.alias("norm"))
    rows = stage(rows, "records")
    across, down = math.ceil(max(1, asked.count()) / TEXTS), math.ceil(max(1, rows.count()) / RECORDS)
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    own = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    left = asked.withColumn("part", own("query", across)).withColumn("slice", every(down))
    right = rows.withColumn("slice", own("key", down)).withColumn("part", every(across))

    def best(queries: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        kept = []
        lengths = batch["norm"].str.len().to_numpy()
        for query, text in zip(queries["query"], queries["norm"]):
            # lengths alone bound the similarity: likeliest records first, stop when no
            # remaining one can beat the k-th kept
            ceiling = np.minimum(lengths, len(text)) / np.maximum(np.maximum(lengths, len(text)), 1)
            order, old = np.argsort(-ceiling, kind="stable"), None
            for start in range(0, len(order), STEP):
                at = order[start : start + STEP]
                bar = 0.0 if old is None or len(old) < k else float(old["similarity"].iloc[-1])
                if ceiling[at[0]] < bar:
                    break
                sims = ngram_similarity([text] * len(at), batch["norm"].iloc[at].tolist(), n, bar)
                fresh = batch.iloc[at][["key", "value"]].assign(query=query, similarity=sims)
                both = fresh if old is None else pd.concat([old, fresh])
                old = both.sort_values(["similarity", "key"], ascending=[False, True]).head(k)
            if old is not None:
                kept.append(old)
        shape = ["query", "similarity", "key", "value"]
        return pd.concat(kept)[shape] if kept else pd.DataFrame(columns=shape)

    kind = asked.schema["query"].dataType.simpleString()
    # a part costs far more than its bytes: tasks stay many
    tasks = 4 * int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = (side.repartition(tasks, "part", "slice").groupBy("part", "slice") for side in (left, right))
    near = left.cogroup(right)
    near = near.applyInPandas(best, f"query {kind}, similarity double, key string, value string")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("similarity"), "key"))
    return (
        near.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query", "rank", "similarity", F.col("key").alias(key), F.col("value").alias(field))
    )


def similar_docs_detail(topk: DataFrame, records: DataFrame, k2: int, key: str = "rec_key") -> DataFrame:
    """All stored fields of the first ``k2`` records of each text."""
    first = topk.where(F.col("rank") <= k2).select("query", "rank", "similarity", key)
    return first.join(records, key)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
