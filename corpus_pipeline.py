"""A training corpus from documents: without toxic ones, near copies and repeated passages, mixed by source, as tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinfold.llm import stages
from twinfold.llm.common import stage, table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.drop_near_copies),
    ("repeated_strings", stages.cut_repeats),
    ("source_mix", stages.mix_sources),
    ("sentence_pieces", stages.encode),
]

#: Learned scores, sketches and balanced draws have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
