"""A stored match index: everything a check needs of the stored side, made once.

A folder holds the records with their contents, the contents with their comparable values, and the blocking tables of
one rule set, each dealt out into buckets by the key that checks join it on. A check joins them in place: nothing of
the index is normalised, hashed or moved again, however many batches are checked against it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.operators.blocking import IndexBlocks, index_blocks
from twinfold.operators.dedup import Prepared, _values, contents, members, with_key
from twinfold.schema import MatchSchema
from twinfold.session import stage

#: Tables of an index and the key that each is dealt out by.
KEYS = {
    "records": "rec_key", "rows": "content_id", "contents": "content_id", "plain": "k", "heavy": "k", "split": "k",
    "groups": "group", "hubs": "group",
}
#: Input rows for each bucket, if no number is given.
ROWS_A_BUCKET = 1_000_000


def _write(df: DataFrame, path: str, name: str, buckets: int) -> None:
    """Write a table in sorted buckets; the catalog forgets it at once, its files stay."""
    made, key = f"made_{uuid.uuid4().hex}", KEYS[name]
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{name}").saveAsTable(made)
    df.sparkSession.sql(f"DROP TABLE {made}")


def _read(spark: SparkSession, path: str, name: str, buckets: int, columns: str) -> DataFrame:
    made, key = f"read_{uuid.uuid4().hex}", KEYS[name]
    spark.sql(
        f"CREATE TABLE {made} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
    )
    df = spark.read.table(made)
    spark.sql(f"DROP TABLE {made}")
    return df


def build_match_index(
    df: DataFrame, schema: MatchSchema, path: str, block_limit: int = 64, buckets: int | None = None
) -> None:
    """Store the records ``df`` for checks by one rule set, in place of what the folder held."""
    spark = df.sparkSession
    own = stage(members(df, schema), "members")
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-own.count() // ROWS_A_BUCKET))
    rows = own.select("content_id", "rec_key", *_values(schema))
    classes = stage(contents(rows, schema), "contents")
    blocks = index_blocks(classes, schema, block_limit)
    raw = [c for c in with_key(df, schema).columns if c not in ("rec_key", "content_id")]
    tables = {
        "records": own.select("rec_key", "content_id", *raw),
        "rows": own.select("content_id", "rec_key"),
        "contents": classes,
        "plain": blocks.plain, "heavy": blocks.heavy, "split": blocks.split, "groups": blocks.groups, "hubs": blocks.hubs,
    }
    about = []
    for name, table in tables.items():
        _write(table, path, name, buckets)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        about.append((name, buckets, columns, None))
    about += [(str(size), buckets, None, bytearray(ranks)) for size, ranks in blocks.ranks.items()]
    about = spark.createDataFrame(about, "name string, buckets int, columns string, ranks binary")
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def open_match_index(spark: SparkSession, path: str) -> Prepared:
    """The index in a folder, ready for ``find_duplicates`` and the jobs."""
    about = {r.name: r for r in spark.read.parquet(f"{path}/about").collect()}  # a row for each table
    read = {name: _read(spark, path, name, about[name].buckets, about[name].columns) for name in KEYS}
    ranks = {int(name): bytes(r.ranks) for name, r in about.items() if r.ranks is not None}
    blocks = IndexBlocks(read["plain"], read["heavy"], read["split"], read["groups"], read["hubs"], ranks, read["contents"])
    return Prepared(read["records"], read["rows"], read["contents"], blocks)


def find_records(index: Prepared, schema: MatchSchema, keys: DataFrame | list[str]) -> DataFrame:
    """Stored records of some record keys; of a list, only the buckets and row groups that can hold them are read."""
    records = index.input.select("rec_key", *schema.names)
    if isinstance(keys, list):
        return records.where(F.col("rec_key").isin(keys))
    return records.join(keys.select("rec_key").distinct(), "rec_key", "left_semi")
