"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm import centroids, chat, collocations, fuzzyhash, licenses, minhash, mixing, oracles, packing, pieces, repeats, toxicity, urls, vectors
from twinfold.llm.common import pick, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_cube_mix")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"), "doc_id")
    taken = F.col("size") * F.col("copies")
    return mixed.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), "source", "copies"
    )


@query("op2_clause_grammar")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels, "doc_id")


@query("op3_lsh_forest", oracles.NEAR_DOCUMENTS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = minhash.link_documents(table(spark, sf_dir, "documents"), "doc_id")
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_piecewise_hash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fuzzyhash.compare_with_next(table(spark, sf_dir, "documents"), "doc_id")
    return prints.select("doc.doc_id", *[c for c in prints.columns if c != "doc"])


@query("op5_host_trust")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_pages(table(spark, sf_dir, "pages"), "page_id")
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


@query("op6_repeated_strings")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(pick(table(spark, sf_dir, "documents"), "doc_id", "text"), with_text=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return left.select(
        F.col("doc.c0").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query("op7_sentence_pieces")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    rows = docs.select(F.struct("doc_id").alias("doc"), "text")
    encoded = pieces.encode_documents(rows, one_in=1, with_text=False)
    return encoded.select("doc.doc_id", "n_tokens", "ids", "exact", "parity")


@query("op8_packed_rows")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return packed.withColumns({c: F.sha2(c, 256) for c in ("ids", "positions")})


@query("op9_neighbour_descent", oracles.NEAR_VECTORS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")


#: The conversation that op10 adds: both texts are made of control strings.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op10_chat_examples", oracles.CHAT_EXAMPLES)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TURNS, turns.schema)
    return chat.read_back(chat.format_chats(turns.union(more)))


@query("op11_licence_index", oracles.LICENCES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), "doc_id")


@query("op12_centroid_drift", oracles.CENTROID_CLUSTERS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", "vec_id").drop("scans")


@query("op13_phrase_tiles", oracles.PHRASES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))
