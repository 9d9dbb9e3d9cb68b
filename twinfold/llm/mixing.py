"""Mixing sources to target weights by the cube method.

Every document of a source is to be taken ``target / size of the source`` times: the whole part surely, the fraction
by a balanced draw. The draw starts from all fractions as inclusion probabilities and moves them at random inside
the null space of two constraints, the source's words and its documents, until they reach 0 or 1. Three open
documents always leave one free direction, so a pass settles all but two. Blocks of a source are worked off apart,
their last two documents each are balanced again among themselves, and of the two that a source has in the end the
choice with the least deviation of words is taken (the landing).
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import WORD, numbered, stage, with_kept

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 8192
FAN = 2048
_EDGE = 1e-9


def source_targets(units: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """Targets of sources (source, source_size, n_docs, target) from units (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A target stops
    at ``most`` times its source's size; the excess goes to the others by weight until none is above.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = numbered(sources, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = stage(sources.withColumn("weight", weight).withColumn("top", F.col("source_size") * float(most)), "sources")
    level, stopped = None, -1
    while True:  # each round stops at least one more source
        full = F.lit(False) if level is None else F.col("top") <= F.col("weight") * F.lit(level)
        now = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("top"))).alias("top"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("stopped"),
        ).first()
        if now.stopped == stopped or not now.weight:
            break
        stopped = now.stopped
        level = ((now["all"] or 0) * share - (now.top or 0.0)) / now.weight
    target = F.least("top", F.col("weight") * F.lit(float(level or 0.0)))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def settle(size: np.ndarray, chance: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Move ``chance`` in the null space of both constraints until at most two values are left between 0 and 1."""
    size, chance = size.astype(float).tolist(), chance.astype(float).tolist()
    luck = iter(draw.random(len(size) + 8).tolist())
    live: list[int] = []
    for i in range(len(size)):
        if not _EDGE < chance[i] < 1 - _EDGE:
            chance[i] = float(round(chance[i]))
            continue
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = (size[j] for j in live)
        way = (b - c, c - a, a - b)
        if not any(way):
            way = (1.0, -1.0, 0.0)
        ahead = [((1 - chance[j]) / w if w > 0 else chance[j] / -w if w else np.inf) for j, w in zip(live, way)]
        back = [(chance[j] / w if w > 0 else (1 - chance[j]) / -w if w else np.inf) for j, w in zip(live, way)]
        most, least = min(ahead), min(back)
        if next(luck) * (most + least) < least:
            move, first = most, ahead.index(most)
        else:
            move, first = -least, back.index(least)
        for k, (j, w) in enumerate(zip(live, way)):
            x = chance[j] + move * w
            chance[j] = float(round(x)) if k == first or not _EDGE < x < 1 - _EDGE else x
        live = [j for j in live if 0 < chance[j] < 1]
    return np.array(chance)


def land(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Round the last open documents: least deviation of words, then of documents."""
    open_ = np.nonzero((chance > 0) & (chance < 1))[0]
    if not len(open_):
        return chance
    words, docs = (size[open_] * chance[open_]).sum(), chance[open_].sum()

    def off(choice: tuple) -> tuple:
        taken = np.array(choice)
        return abs((size[open_] * taken).sum() - words), abs(taken.sum() - docs), choice

    out = chance.copy()
    out[open_] = min(itertools.product((0, 1), repeat=len(open_)), key=off)
    return out


def _pass(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One block: large documents first, so that those left open are small."""
    source, bucket, last = key
    rows = rows.sort_values(["size", "order"], ascending=[False, True], kind="stable").reset_index(drop=True)
    seed = [zlib.crc32(str(source).encode()), int(bucket), len(rows), int(pd.isna(source))]
    size = rows["size"].to_numpy(float)
    chance = settle(size, rows["chance"].to_numpy(float), np.random.default_rng(seed))
    rows["chance"] = land(size, chance) if last else chance
    return rows.drop(columns="last")


def mix(units: DataFrame, targets: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """How often each unit is taken: ``units`` (doc: anything, source, size, order) with source_size, target, copies.

    ``order`` is a long that breaks ties of size. Units of size 0 are drawn like all others and add nothing.
    A source without words has target 0 and none of its units is taken. Equal rows are drawn each for itself.
    """
    factor = F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0))
    whole = F.floor(factor + _EDGE)
    units = units.withColumnRenamed("source", "_source").join(
        targets.select(F.col("source").alias("_of"), "source_size", "n_docs", "target"),
        F.col("_source").eqNullSafe(F.col("_of")),
    )
    columns = ["doc", "source", "size", "order", "source_size", "target", "whole", "buckets", "bucket", "chance"]
    units = (
        units.withColumn("source", F.col("_source"))
        .withColumn("whole", whole)
        .withColumn("chance", F.greatest(F.lit(0.0), factor - whole))
        .withColumn("buckets", F.ceil(F.col("n_docs") / block))
        .withColumn("bucket", F.expr("pmod(xxhash64(order, 7), buckets)"))
        .select(*columns)
    )
    schema, done = units.schema, None
    while True:
        rows = units.withColumn("last", F.col("buckets") <= 1)
        rows = stage(rows.groupBy("source", "bucket", "last").applyInPandas(_pass, schema), "drawn")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled = rows.filter(~open_)
        done = settled if done is None else done.union(settled)
        units = rows.filter(open_)
        if units.isEmpty():
            break
        units = units.withColumn("buckets", F.ceil(F.col("buckets") / fan)).withColumn(
            "bucket", F.floor(F.col("bucket") / fan)
        )
    copies = (F.col("whole") + F.round("chance")).cast("long")
    return done.select("doc", "source", "size", "source_size", "target", copies.alias("copies"))


def document_units(docs: DataFrame, *ids: str) -> DataFrame:
    """Units of ``docs`` (text, source and the columns ``ids``): words of the text, null: 0."""
    rows = with_kept(docs, ["text", "source"], ids)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    order = F.xxhash64(*[F.col(f"kept{i}") for i in range(len(ids))], "text", "source")
    doc = F.struct(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(ids)])
    return rows.select(doc.alias("doc"), "source", size.alias("size"), order.alias("order"))


def mix_documents(docs: DataFrame, *ids: str) -> DataFrame:
    """The mix of ``docs`` (text, source and the columns ``ids``, which return as struct ``doc``)."""
    units = stage(document_units(docs, *ids), "units")
    return mix(units, source_targets(units))
