"""Work on duplicate pairs and on the record sets they leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import trim_control


def _first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One whole row per key. Aggregation keeps one row per key and task before the
    shuffle, so a key with most of the rows costs no more than any other."""
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def dedup_pairs(pairs: DataFrame, key_1: str = "rec_key_1", key_2: str = "rec_key_2") -> DataFrame:
    """Drop self pairs, keep one row per unordered pair: the smallest by first key, then
    by the other columns."""
    rest = [c for c in pairs.columns if c not in (key_1, key_2)]
    low, high = F.least(key_1, key_2), F.greatest(key_1, key_2)
    named = pairs.where(F.col(key_1) != F.col(key_2)).withColumns({"_low": low, "_high": high})
    return _first_per(named, ["_low", "_high"], [key_1, key_2, *rest]).drop("_low", "_high")


def merge_dup_ids(pairs: DataFrame, key_1: str = "rec_key_1", key_2: str = "rec_key_2") -> DataFrame:
    """Keys on either side of a pair."""
    both = F.explode(F.array(key_1, key_2)).alias("rec_key")
    return pairs.select(both).distinct()


def dup_map(pairs: DataFrame, key_1: str = "rec_key_1", key_2: str = "rec_key_2") -> DataFrame:
    """Smaller key to each of its duplicates, one row per entry of the map."""
    return (
        pairs.where(F.col(key_1) != F.col(key_2))
        .select(F.least(key_1, key_2).alias("rec_key"), F.greatest(key_1, key_2).alias("dup_key"))
        .distinct()
    )


def first_per_key(rows: DataFrame, order: str | Column, key: str = "rec_key") -> DataFrame:
    return _first_per(rows, [key], [order])


def no_dup(batch: DataFrame, dup_keys: DataFrame, order: str | Column) -> DataFrame:
    """Rows whose key is in no pair, the first one per key."""
    return first_per_key(batch.join(dup_keys.select("rec_key"), "rec_key", "left_anti").select(*batch.columns), order)


def take_no_duplicated(own: DataFrame, remote: DataFrame) -> DataFrame:
    """Rows of the first set whose key is in both."""
    return own.join(remote.select("rec_key"), "rec_key", "left_semi").select(*own.columns)


def take_no_dup_light(remote: DataFrame, own: DataFrame, order: str | Column) -> DataFrame:
    """Both sets together, one row per key, the remote set's row first."""
    both = remote.withColumn("_set", F.lit(0)).unionByName(own.withColumn("_set", F.lit(1)))
    return _first_per(both, ["rec_key"], ["_set", order]).drop("_set")


def intersect_ids(own: DataFrame, remote: DataFrame) -> DataFrame:
    return own.select("rec_key").intersect(remote.select("rec_key"))


def except_ids(batch: DataFrame, dup_keys: DataFrame) -> DataFrame:
    return batch.select("rec_key").subtract(dup_keys.select("rec_key"))


def drop_higher_id(batch: DataFrame, pairs: DataFrame, id_column: str, id_1: str, id_2: str) -> DataFrame:
    """Of each pair remove the record with the larger numeric id."""

    def number(c: str) -> Column:
        return trim_control(F.col(c).cast("string")).try_cast("bigint")

    denied = (
        pairs.select(number(id_1).alias("a"), number(id_2).alias("b"))
        .where("a <> b")
        .select(F.greatest("a", "b").alias("_id"))
        .distinct()
    )
    return batch.withColumn("_id", number(id_column)).join(denied, "_id", "left_anti").select(*batch.columns)


def report_order(report: DataFrame, key: str, line: str) -> DataFrame:
    """Report rows of one record together, in descending text order."""
    return report.orderBy(key, F.desc(line))
