"""Field comparators, match policies, tiers and the verdict as column expressions."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.similarity import SLACK, dice, ngram_similarity
from twinfold.functions.text import REPEAT_SEP, normalize_key, normalize_text, regexp_group, trim_control
from twinfold.schema import DENY_DUP, MAX_SCORE, Field, MatchSchema

MATCH, NO_MATCH, NEEDS_MAX = "MATCH", "NO_MATCH", "NEEDS_MAX"
DENIED, IGNORED, NOT_COMPARED = "DENIED", "IGNORED", "NOT_COMPARED"


def title_text(schema: MatchSchema, raw: Column | None = None) -> Column:
    raw = F.col(schema.index_field.name) if raw is None else raw
    return F.coalesce(normalize_text(raw), F.lit(""))


def first_author(raw: Column) -> Column:
    return F.substring_index(raw, REPEAT_SEP, 1)


def comparable(field: Field, raw) -> Column:
    """The value a field is compared by; empty means the field is ignored.

    ``raw`` maps a field name to its raw column. A field whose required field is
    empty is ignored as well.
    """
    value = F.coalesce(raw(field.name), F.lit(""))
    if field.kind == "exact":
        value = normalize_key(value)
    elif field.kind == "regexp":
        value = normalize_key(regexp_group(value, field.pattern, field.group))
    elif field.kind == "authors":
        value = normalize_text(first_author(value))
    else:
        value = normalize_text(value)
    if field.required:
        need = trim_control(F.coalesce(raw(field.required), F.lit("")))
        value = F.when(need == "", "").otherwise(value)
    return value


def status(field: Field, a: Column, b: Column, matched: Column) -> Column:
    miss = {DENY_DUP: DENIED, MAX_SCORE: NEEDS_MAX}.get(field.match, NO_MATCH)
    return F.when((a == "") | (b == ""), IGNORED).when(matched, MATCH).otherwise(miss)


def tier_min_fields(schema: MatchSchema, similarity: Column) -> Column:
    """Fields required at this similarity: the first tier it reaches, null if none."""
    chain = None
    for tier in schema.ordered_tiers:
        reached = similarity >= tier.min_value - SLACK
        need = F.lit(tier.min_fields)
        chain = F.when(reached, need) if chain is None else chain.when(reached, need)
    return chain


def verdict(similarity: Column, min_fields: Column, statuses: list[Column]) -> tuple[Column, Column]:
    """(matched fields, duplicate?) from per-field statuses."""
    matched = sum((F.when(s == MATCH, 1).otherwise(0) for s in statuses), F.lit(0))
    ok = min_fields.isNotNull() & (matched >= min_fields)
    for s in statuses:
        ok = ok & (s != DENIED) & ((s != NEEDS_MAX) | (similarity >= 1.0 - SLACK))
    return matched, ok


def _approximate(schema: MatchSchema) -> list[Field]:
    return schema.of_kind("ngram", "authors")


def _similarities(schema: MatchSchema, exact: bool, columns: list[Column]) -> Column:
    """Struct of the similarity and the score of each approximate field.

    Columns: known matches, "needs maximum" flag, both index texts, both texts of each
    approximate field. The short fields come first: what they match decides the lowest
    tier a pair can still reach, and the index texts are compared down to that tier only.
    """
    n, tiers = schema.ngram, [(t.min_value, t.min_fields) for t in schema.tiers]
    rules = [(f.match, f.min_score if f.kind == "ngram" else schema.author_score) for f in _approximate(schema)]
    names = ["similarity"] + [f"s{i}" for i in range(len(rules))]

    @F.pandas_udf(", ".join(f"{c} double" for c in names))
    def scored(known: pd.Series, needs_max: pd.Series, *cols: pd.Series) -> pd.DataFrame:
        texts = [c.fillna("").tolist() for c in cols]
        matches = known.to_numpy(dtype=np.int64).copy()
        top = needs_max.to_numpy(dtype=bool).copy()
        hopeless = np.zeros(len(matches), dtype=bool)
        out = {}
        for at, (match, cut) in enumerate(rules):
            a, b = texts[2 + 2 * at], texts[3 + 2 * at]
            score = ngram_similarity(a, b, n)
            out[names[1 + at]] = score
            both = np.array([bool(x) and bool(y) for x, y in zip(a, b)], dtype=bool)
            hit = both & (score >= cut - SLACK)
            matches += hit
            if match == DENY_DUP:
                hopeless |= both & ~hit
            elif match == MAX_SCORE:
                top |= both & ~hit
        floor = np.full(len(matches), 2.0)
        for value, fields in tiers:
            floor = np.where(matches >= fields, np.minimum(floor, value), floor)
        floor = np.where(top, np.maximum(floor, 1.0), floor)
        floor = np.where(hopeless, 2.0, floor)
        if exact:
            floor = np.zeros(len(matches))
        similarity = ngram_similarity(texts[0], texts[1], n, floor)
        return pd.DataFrame({"similarity": similarity, **out}, columns=names)

    return scored(*columns)


def equality_statuses(df: DataFrame, schema: MatchSchema) -> DataFrame:
    """``status_<f>`` of exact and regexp fields from ``v_<f>_1`` and ``v_<f>_2``."""
    return df.withColumns(
        {
            f"status_{f.name}": status(
                f, F.col(f"v_{f.name}_1"), F.col(f"v_{f.name}_2"), F.col(f"v_{f.name}_1") == F.col(f"v_{f.name}_2")
            )
            for f in schema.equality
        }
    )


def still_possible(schema: MatchSchema) -> Column:
    """False once equality fields deny the pair or leave too few fields to match."""
    ok = F.lit(True)
    lost = F.lit(0)
    for f in schema.equality:
        s = F.col(f"status_{f.name}")
        ok = ok & (s != DENIED)
        lost = lost + F.when(s == MATCH, 0).otherwise(1)
    return ok & (F.lit(len(schema.compared)) - lost >= schema.min_fields)


def score_fields(df: DataFrame, schema: MatchSchema, exact: bool = False) -> DataFrame:
    """Add similarity, ``score_<f>``, ``status_<f>``, matched_fields, min_fields, duplicate.

    Needs ``t_1, t_2`` (normalised index field), ``v_<f>_1``, ``v_<f>_2`` and, for
    dice fields, ``d_<f>_1``, ``d_<f>_2``. Unless ``exact``, the similarity of a pair
    that no tier can accept is reported as 0.
    """
    approx = _approximate(schema)
    out = {}
    for f in schema.compared:
        if f not in approx:
            a, b = F.col(f"v_{f.name}_1"), F.col(f"v_{f.name}_2")
            score = F.when(a == b, F.lit(1.0)).otherwise(F.lit(0.0))
            if f.kind == "dice":
                # only texts that have to be compared are sent
                texts = [F.when((a != b) & (a != "") & (b != ""), F.col(f"d_{f.name}_{i}")) for i in (1, 2)]
                score = F.when(a == b, F.lit(1.0)).otherwise(dice(*texts))
            out[f"score_{f.name}"] = F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(score)
            cut = f.min_score if f.kind == "dice" else 1.0
            out[f"status_{f.name}"] = status(f, a, b, score >= cut - SLACK)
    df = df.withColumns(out) if out else df
    done = [F.col(f"status_{f.name}") for f in schema.compared if f not in approx]
    known = sum((F.when(s == MATCH, 1).otherwise(0) for s in done), F.lit(0))
    needs_max = F.lit(False)
    for s in done:
        needs_max = needs_max | (s == NEEDS_MAX)
    columns = [known, needs_max, F.col("t_1"), F.col("t_2")]
    for f in approx:
        columns += [F.col(f"v_{f.name}_1"), F.col(f"v_{f.name}_2")]
    df = df.withColumn("_s", _similarities(schema, exact, columns))
    out = {"similarity": F.col("_s.similarity")}
    for i, f in enumerate(approx):
        a, b = F.col(f"v_{f.name}_1"), F.col(f"v_{f.name}_2")
        score = F.col(f"_s.s{i}")
        cut = f.min_score if f.kind == "ngram" else schema.author_score
        out[f"score_{f.name}"] = F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(score)
        out[f"status_{f.name}"] = status(f, a, b, score >= cut - SLACK)
    df = df.withColumns(out).drop("_s")
    df = df.withColumn("min_fields", tier_min_fields(schema, F.col("similarity")))
    matched, dup = verdict(
        F.col("similarity"), F.col("min_fields"), [F.col(f"status_{f.name}") for f in schema.compared]
    )
    titled = (F.col("t_1") != "") & (F.col("t_2") != "")
    return df.withColumns({"matched_fields": matched, "duplicate": F.coalesce(titled & dup, F.lit(False))})


def prepared(df: DataFrame, schema: MatchSchema, suffix: str = "") -> DataFrame:
    """Add ``t`` and, per compared field, ``v_<f>``.

    A dice value may be a whole abstract, so ``v_<f>`` is its digest, and ``d_<f>`` the text.
    """

    def raw(name: str) -> Column:
        return F.col(f"{name}{suffix}")

    out = {f"t{suffix}": title_text(schema, raw(schema.index_field.name))}
    for f in schema.compared:
        out[f"{'d' if f.kind == 'dice' else 'v'}_{f.name}{suffix}"] = comparable(f, raw)
    df = df.withColumns(out)
    more = {}
    for f in schema.of_kind("dice"):
        text = F.col(f"d_{f.name}{suffix}")
        more[f"v_{f.name}{suffix}"] = F.when(text == "", "").otherwise(F.md5(text))
    return df.withColumns(more) if more else df


cloudpickle.register_pickle_by_value(sys.modules[__name__])
