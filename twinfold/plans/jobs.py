"""Whole jobs put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import clean_query, fill_pattern, normalize_key, split_pipe
from twinfold.operators.dedup import (
    Duplicates,
    Prepared,
    duplicate_keys,
    duplicate_report,
    find_duplicates,
    nearest_links,
    prepare,
    report_links,
    with_key,
)
from twinfold.operators.explain import explain_pairs
from twinfold.operators.pairs import drop_higher_id, no_dup, take_no_dup_light, take_no_duplicated
from twinfold.operators.validate import validate
from twinfold.schema import MatchSchema
from twinfold.session import stage
from twinfold.sources.pipe import parse_lines


@dataclass
class Check:
    """Outcome of a check: factored report, keys of duplicates, rows without any."""

    duplicates: Duplicates
    report: DataFrame
    dup_keys: DataFrame
    no_dup: DataFrame


def good_records(lines: DataFrame, schema: MatchSchema, column: str = "value") -> DataFrame:
    """Good lines as keyed records."""
    good = validate(lines, schema, column).where("reason IS NULL").drop("reason")
    return with_key(parse_lines(good, schema, column), schema)


def _check(
    batch: DataFrame | Prepared, schema: MatchSchema, index: DataFrame | Prepared | None, order: str | Column, block_limit: int
) -> Check:
    if not isinstance(batch, Prepared):
        batch = prepare(with_key(batch, schema), schema)
    dups = find_duplicates(batch, schema, index, block_limit)
    keys = duplicate_keys(dups)
    return Check(dups, duplicate_report(dups), keys, no_dup(batch.input, keys, order))


def self_check(batch: DataFrame | Prepared, schema: MatchSchema, order: str | Column, block_limit: int = 64) -> Check:
    return _check(batch, schema, None, order, block_limit)


def index_check(
    batch: DataFrame | Prepared, index: DataFrame | Prepared, schema: MatchSchema, order: str | Column, block_limit: int = 64
) -> Check:
    """``index``: records, or a stored match index, which is read where it lies."""
    return _check(batch, schema, index, order, block_limit)


@dataclass
class DoubleCheck:
    own: Check
    stored: Check
    no_dup_1: DataFrame
    no_dup_2: DataFrame


def double_check(
    batch: DataFrame,
    index: DataFrame | Prepared,
    schema: MatchSchema,
    order: str | Column,
    light: bool = False,
    block_limit: int = 64,
) -> DoubleCheck:
    """Check the batch, normalised once, against itself and against the index.

    ``no_dup_1``: rows without a duplicate in the index, or, with ``light``, both
    no-duplicate sets together. ``no_dup_2``: rows in both sets.
    """
    batch = prepare(with_key(batch, schema), schema)
    own = self_check(batch, schema, order, block_limit)
    stored = index_check(batch, index, schema, order, block_limit)
    own_rows, stored_rows = stage(own.no_dup, "no_dup_self"), stage(stored.no_dup, "no_dup_index")
    both = take_no_duplicated(own_rows, stored_rows)
    first = take_no_dup_light(stored_rows, own_rows, order) if light else stored_rows
    return DoubleCheck(own, stored, first, both)


def lookup_duplicates(queries: DataFrame, index: DataFrame | Prepared, schema: MatchSchema, quantity: int) -> DataFrame:
    """Duplicates of each query record in the index, the ``quantity`` most similar ones."""
    dups = find_duplicates(with_key(queries, schema), schema, index)
    links = stage(nearest_links(dups, quantity), "nearest")
    ranks = links.select(F.col("key_1").alias("rec_key_1"), F.col("key_2").alias("rec_key_2"), "rank")
    return report_links(dups, links.drop("rank")).join(ranks, ["rec_key_1", "rec_key_2"])


def records_without_dups(batch: DataFrame, pairs: DataFrame, id_column: str, id_1: str, id_2: str) -> DataFrame:
    """What a rebuilt index holds: of each pair the record with the larger id is left out."""
    return drop_higher_id(batch, pairs, id_column, id_1, id_2)


def split_by_pattern(lines: DataFrame, schema: MatchSchema, column: str = "value") -> DataFrame:
    """Every line with its fill pattern and its reason, if bad. Lines with two fields or
    fewer get no pattern."""
    cells = F.split(column, r"\|", -1)
    checked = validate(lines, schema, column)
    short = F.size(cells) <= 2
    return checked.withColumn("pattern", F.when(~short, fill_pattern(cells)))


def explain_lines(requests: DataFrame, records: DataFrame, schema: MatchSchema) -> DataFrame:
    """Why raw lines are, or are not, duplicates of stored records: requests (doc, id) with outcome, reason and report.

    ``records`` hold the normalised id that ``index.build_index`` adds. Lines are cleaned as queries are: entities are
    resolved and ``:`` is a space. A line without a cell for each field, null included, is a ``bad_line``, an unknown id ``not_found``; both
    have no reason and no report. Each record of an id has a row.
    """
    cells = split_pipe(clean_query("doc"))
    asked = requests.select("doc", "id", cells.alias("_cells"), normalize_key("id").alias("_id"))
    good = F.coalesce(F.size("_cells") > schema.max_pos, F.lit(False))
    one = asked.where(good).select("doc", "id", "_id", *[c.alias(f"{n}_1") for n, c in _cells_by_name(schema)])
    own = F.col(f"{schema.id_field.name}_norm").alias("_id")
    two = records.select(own, *[F.col(n).alias(f"{n}_2") for n in schema.names])
    told = explain_pairs(one.join(two, "_id"), schema)
    known = two.select("_id").distinct()
    rest = lambda rows, outcome: rows.select(
        "doc", "id", F.lit(outcome).alias("outcome"), *[F.lit(None).cast("string").alias(c) for c in ("reason", "report")]
    )
    found = told.select("doc", "id", F.lit("explained").alias("outcome"), "reason", "report")
    missing = rest(one.join(known, "_id", "left_anti"), "not_found")
    return found.unionByName(missing).unionByName(rest(asked.where(~good), "bad_line"))


def _cells_by_name(schema: MatchSchema) -> list[tuple[str, Column]]:
    return [(f.name, F.coalesce(F.get("_cells", F.lit(f.pos)), F.lit(""))) for f in schema.by_pos]
