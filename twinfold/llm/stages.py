"""The operators as stages of a corpus pipeline: from rows of documents to rows of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm import minhash, mixing, pieces, repeats, toxicity
from twinfold.llm.common import stage_by, table

#: Near-duplicates of the pipeline: five words, similarity 0.8.
FOREST = minhash.Forest(alike=80, depth=3)


def _plain(docs: DataFrame) -> DataFrame:
    """The documents' own columns under their names, all others numbered, so that nothing clashes."""
    own = ("doc_id", "text", "source", "n_chars")
    return docs.toDF(*[c if c in own else f"x{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5; null and empty texts stay."""
    rows = _plain(docs)
    model = toxicity.learn(rows, table(spark, sf_dir, "labels"))
    return rows.filter(toxicity.score(model, F.col("text")) < 0.5).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least id; documents without words all stay."""
    rows = _plain(docs)
    linked = minhash.link_documents(rows, *rows.columns, forest=FOREST)
    return linked.filter("first").select(*rows.columns).toDF(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that occur more than once; no document goes, n_chars is counted anew."""
    rows = _plain(docs)
    left = repeats.remove_repeats(rows)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    columns = [new.get(c, F.col("doc")[f"c{i}"]).alias(c) for i, c in enumerate(rows.columns)]
    return left.select(*columns).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    rows = _plain(docs)
    keyed = stage_by(rows.withColumn("row", F.monotonically_increasing_id()), "row", "documents")
    mixed = mixing.mix_documents(keyed.select("row", "text", "source"), "row").filter("copies > 0")
    copies = mixed.select(F.col("doc.row").alias("row"), F.col("copies").cast("int").alias("copies"))
    taken = keyed.join(copies.hint("shuffle_hash"), "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*rows.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these read back as the text (``token_ids``, ``n_tokens``,
    ``reads_back``). A column that has such a name already gets a line below it."""
    rows = _plain(docs)
    encoded = pieces.encode_documents(rows.select(F.struct(*rows.columns).alias("doc"), "text"), with_text=False)
    new = {"token_ids": "ids", "n_tokens": "n_tokens", "reads_back": "exact"}
    out = encoded.select(*[F.col("doc")[c] for c in rows.columns], *new.values())
    old = [c + "_" if c.lower() in new else c for c in docs.columns]
    return out.toDF(*old, *new)
