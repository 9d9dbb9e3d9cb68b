"""The record index: a table of stored records with raw and normalised fields.

``records`` holds one row per record key. Next to it is a gram table, which may be empty
but never describes records that are gone: building without grams and resetting empty
it. Upsert and delete return the new rows; store them under a new path to leave readers
of the old one alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import char_ngrams, normalize_key, normalize_text, record_key
from twinfold.operators.validate import validate
from twinfold.schema import MatchSchema
from twinfold.sources.pipe import parse_lines, pipe_line


def index_records(df: DataFrame, schema: MatchSchema) -> DataFrame:
    """rec_key, raw fields and ``<f>_norm`` per field."""
    norms = [
        (normalize_key(f.name) if f.kind in ("id", "database") else normalize_text(f.name)).alias(f"{f.name}_norm")
        for f in schema.by_pos
    ]
    key = record_key(schema.id_field.name, schema.database_field.name).alias("rec_key")
    return df.select(key, *schema.names, *norms)


def index_grams(records: DataFrame, schema: MatchSchema) -> DataFrame:
    """(gram, rec_key) of the index field, distinct per record."""
    title = f"{schema.index_field.name}_norm"
    return records.where(F.col(title) != "").select(
        F.explode(F.array_distinct(char_ngrams(title, schema.ngram))).alias("gram"), "rec_key"
    )


def lines_to_index(lines: DataFrame, schema: MatchSchema, column: str = "value") -> DataFrame:
    """Records of the good lines."""
    good = validate(lines, schema, column).where("reason IS NULL").drop("reason")
    return index_records(parse_lines(good, schema, column), schema)


def build_index(
    df: DataFrame, schema: MatchSchema, path: str, append: bool = False, grams: bool = False, files: int | None = None
) -> None:
    """Store records (and grams, clustered by gram); overwrite unless ``append``.

    Appending needs the same choice of ``grams`` as before."""
    mode = "append" if append else "overwrite"
    records = index_records(df, schema)
    (records.repartition(files, "rec_key") if files else records).write.mode(mode).parquet(f"{path}/records")
    if grams:
        rows = index_grams(records, schema)
        rows = rows.repartitionByRange(files, "gram", "rec_key") if files else rows.repartitionByRange("gram", "rec_key")
        rows.write.mode(mode).parquet(f"{path}/grams")
    elif not append:
        _no_grams(df.sparkSession, path)


def reset_index(spark: SparkSession, schema: MatchSchema, path: str) -> None:
    """Leave an empty index of the right shape."""
    shape = ", ".join(["rec_key string", *(f"`{n}` string" for n in schema.names), *(f"`{n}_norm` string" for n in schema.names)])
    spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{path}/records")
    _no_grams(spark, path)


def _no_grams(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], "gram string, rec_key string").write.mode("overwrite").parquet(f"{path}/grams")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/records")


def export_index(records: DataFrame, schema: MatchSchema) -> DataFrame:
    """Stored raw fields as pipe lines."""
    return records.select(pipe_line(schema).alias("value"))


def index_upsert(records: DataFrame, new: DataFrame, order: str | Column | None = None) -> DataFrame:
    """New rows replace stored rows of the same key; the last by ``order`` wins among them."""
    if order is not None:
        latest = new.groupBy("rec_key").agg(F.max_by(F.struct(*records.columns), order).alias("_row"))
        new = latest.select("_row.*")
    fresh = new.select(*records.columns)
    return records.join(fresh.select("rec_key"), "rec_key", "left_anti").select(*records.columns).unionByName(fresh)


def index_delete(records: DataFrame, schema: MatchSchema, id_: str, database: str | None = None) -> DataFrame:
    """Rows that stay after deleting an id, or all ids with a prefix (``abc*``)."""
    ident = F.col(schema.id_field.name)
    hit = ident.startswith(id_[:-1]) if id_.endswith("*") else ident == id_
    if database is not None:
        hit = hit & (F.lower(schema.database_field.name) == database.lower())
    return records.where(~F.coalesce(hit, F.lit(False)))


def get_by_id(records: DataFrame, schema: MatchSchema, ids: DataFrame | str) -> DataFrame:
    """Stored records of one id, or of a table of ids in column ``id``."""
    own = f"{schema.id_field.name}_norm"
    if isinstance(ids, str):
        return records.where(F.col(own) == normalize_key(F.lit(ids)))
    wanted = ids.select(normalize_key("id").alias(own)).distinct()
    return records.join(wanted, own, "left_semi").select(*records.columns)


def audit_index(records: DataFrame, schema: MatchSchema, strict: bool = True) -> DataFrame:
    """Records lacking a required field. ``strict`` flags them even when the field that
    needs it is empty."""
    bad = F.lit(False)
    for f in schema.by_pos:
        if f.required:
            lacking = F.coalesce(F.col(f.required), F.lit("")) == ""
            if not strict:
                lacking = lacking & (F.coalesce(F.col(f.name), F.lit("")) != "")
            bad = bad | lacking
    return records.where(bad)


class Term:
    """A search condition over stored fields; combine with ``&``, ``|`` and ``~``."""

    def __init__(self, test: Column, weight: Column):
        self.test, self.weight = test, weight

    def __and__(self, other: Term) -> Term:
        return Term(self.test & other.test, self.weight + other.weight)

    def __or__(self, other: Term) -> Term:
        return Term(self.test | other.test, self.weight + other.weight)

    def __invert__(self) -> Term:
        return Term(~self.test, F.lit(0))


def term(field: str, text: str, ngram: int = 3) -> Term:
    """Records whose field holds every n-gram of the text; shorter texts must be a word."""
    stored = F.col(f"{field}_norm")
    wanted = normalize_text(F.lit(text))
    grams = char_ngrams(wanted, ngram, pad=False)
    inside = F.forall(grams, lambda g: F.contains(stored, g))
    word = F.array_contains(F.split(stored, " "), wanted)
    hit = F.coalesce(F.when(F.length(wanted) >= ngram, inside).otherwise(word), F.lit(False))
    return Term(hit, F.when(hit, F.greatest(F.size(grams), F.lit(1))).otherwise(0))


def search(records: DataFrame, condition: Term, fields: list[str] | None = None, count: int | None = None) -> DataFrame:
    """Hits, most matched grams first, then by key; only the best ``count`` if that is given."""
    hits = records.where(condition.test).withColumn("weight", condition.weight)
    shown = ["rec_key", *(fields or [c for c in records.columns if c != "rec_key"])]
    hits = hits.orderBy(F.desc("weight"), "rec_key")
    return (hits if count is None else hits.limit(count)).select(*shown)


def hit_count(records: DataFrame, condition: Term) -> DataFrame:
    return records.where(condition.test).agg(F.count("*").alias("hits"))
