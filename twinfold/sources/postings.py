"""Full-text search by postings, ranked by how rare the matched grams are.

Next to the record index lies a table (field, gram, rec_key), sorted so that a search reads the row groups of its own
grams only, and a table of how many records hold each gram. A text is sought from its rarest gram on: the records of
that one are kept while those of the others are counted. Texts shorter than a gram are sought as whole words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import char_ngrams, normalize_text
from twinfold.session import stage

#: Marks a posting of a whole word that is shorter than a gram.
WORD = "\u0002"


@dataclass(frozen=True)
class Condition:
    """What a record has to hold; combine with ``&``, ``|`` and ``~``."""

    kind: str
    parts: tuple

    def __and__(self, other: Condition) -> Condition:
        return Condition("and", (self, other))

    def __or__(self, other: Condition) -> Condition:
        return Condition("or", (self, other))

    def __invert__(self) -> Condition:
        return Condition("not", (self,))


def has(field: str, text: str) -> Condition:
    """The field holds every n-gram of the text, or the text as a word if it is shorter; an empty text is held by none."""
    return Condition("has", (field, text))


def _grams(norm: Column, ngram: int) -> Column:
    """Grams of a normalised text, and its words that are shorter than one."""
    words = F.filter(F.split(norm, " "), lambda w: (w != "") & (F.length(w) < ngram))
    return F.array_distinct(F.concat(char_ngrams(norm, ngram, pad=False), F.transform(words, lambda w: F.concat(F.lit(WORD), w))))


def build_postings(records: DataFrame, fields: list[str], path: str, ngram: int = 3) -> None:
    """Store the postings of ``<field>_norm`` of the records of an index, in place of what the folder held."""
    every = [
        records.select(F.lit(f).alias("field"), F.explode(_grams(F.coalesce(f"{f}_norm", F.lit("")), ngram)).alias("gram"), "rec_key")
        for f in fields
    ]
    rows = every[0]
    for more in every[1:]:
        rows = rows.union(more)
    rows = rows.distinct().repartitionByRange("field", "gram", "rec_key").sortWithinPartitions("field", "gram", "rec_key")
    rows.write.mode("overwrite").parquet(f"{path}/postings")
    stored = records.sparkSession.read.parquet(f"{path}/postings")
    counts = stored.groupBy("field", "gram").agg(F.count("*").alias("n"))
    counts.repartitionByRange("field", "gram").sortWithinPartitions("field", "gram").write.mode("overwrite").parquet(f"{path}/counts")
    records.select("rec_key").distinct().write.mode("overwrite").parquet(f"{path}/keys")


class Postings:
    """The stored postings of a folder."""

    def __init__(self, spark: SparkSession, path: str, ngram: int = 3):
        self.spark, self.ngram = spark, ngram
        self.rows, self.counts, self.keys = (spark.read.parquet(f"{path}/{n}") for n in ("postings", "counts", "keys"))
        self.size = self.keys.count()

    def _asked(self, text: str) -> list[str]:
        """Grams of a text that is sought."""
        norm = normalize_text(F.lit(text))
        short = F.when(norm != "", F.array(F.concat(F.lit(WORD), norm))).otherwise(F.array().cast("array<string>"))
        grams = F.when(F.length(norm) >= self.ngram, F.array_distinct(char_ngrams(norm, self.ngram, pad=False))).otherwise(short)
        return self.spark.range(1).select(grams.alias("grams")).head().grams

    def _holding(self, field: str, text: str) -> DataFrame:
        """(rec_key, weight) of the records that hold a text."""
        grams = self._asked(text)
        own = self.counts.where((F.col("field") == field) & F.col("gram").isin(grams))
        counts = sorted((r.n, r.gram) for r in own.collect())  # at most a row for each gram of the text
        if not grams or len(counts) < len(grams):
            return self.keys.where("false").withColumn("weight", F.lit(0.0))
        weight = sum(math.log(1 + self.size / n) for n, _ in counts)
        at = lambda gs: self.rows.where((F.col("field") == field) & F.col("gram").isin(gs)).select("rec_key")
        found, rest = at([counts[0][1]]), [g for _, g in counts[1:]]
        if rest:
            other = at(rest).join(found, "rec_key", "left_semi").groupBy("rec_key").agg(F.count("*").alias("n"))
            found = other.where(F.col("n") == len(rest)).select("rec_key")
        return found.withColumn("weight", F.lit(weight))

    def matches(self, condition: Condition) -> DataFrame:
        """(rec_key, weight): records that meet a condition; the weight adds up those of the texts that they hold."""
        kind, parts = condition.kind, condition.parts
        if kind == "has":
            return self._holding(*parts)
        if kind == "not":
            return self.keys.join(self.matches(parts[0]), "rec_key", "left_anti").withColumn("weight", F.lit(0.0))
        if kind == "and":
            one, two = parts
            if two.kind == "not":
                return self.matches(one).join(self.matches(two.parts[0]), "rec_key", "left_anti")
            if one.kind == "not":
                return self.matches(two & one)
            other = self.matches(two).withColumnRenamed("weight", "other")
            return self.matches(one).join(other, "rec_key").select("rec_key", (F.col("weight") + F.col("other")).alias("weight"))
        both = self.matches(parts[0]).union(self.matches(parts[1]))
        return both.groupBy("rec_key").agg(F.sum("weight").alias("weight"))

    def search(self, condition: Condition, count: int | None = None) -> DataFrame:
        """Matches, rarest texts first, then by key; only the best ``count`` if that is given."""
        found = self.matches(condition).orderBy(F.desc("weight"), "rec_key")
        return found if count is None else found.limit(count)

    def hit_count(self, condition: Condition) -> DataFrame:
        return self.matches(condition).agg(F.count("*").alias("hits"))


def put_records(postings: Postings, records: DataFrame, fields: list[str], path: str) -> None:
    """Store new postings under ``path``: those of ``records`` in place of the stored ones with the same keys.

    Only postings of new records are made; the others are carried over as they are."""
    keys = records.select("rec_key").distinct()
    old = postings.rows.join(keys, "rec_key", "left_anti")
    staged = f"{path}/new"
    build_postings(records, fields, staged, postings.ngram)
    _carry(postings, old, postings.spark.read.parquet(f"{staged}/postings"), postings.keys.union(keys).distinct(), path)


def delete_records(postings: Postings, keys: DataFrame, path: str) -> None:
    """Store the postings under ``path`` without those of some record keys (rec_key)."""
    keys = keys.select("rec_key").distinct()
    old = postings.rows.join(keys, "rec_key", "left_anti")
    _carry(postings, old, old.where("false"), postings.keys.join(keys, "rec_key", "left_anti"), path)


def _carry(postings: Postings, old: DataFrame, new: DataFrame, keys: DataFrame, path: str) -> None:
    rows = old.select("field", "gram", "rec_key").union(new.select("field", "gram", "rec_key"))
    rows = rows.repartitionByRange("field", "gram", "rec_key").sortWithinPartitions("field", "gram", "rec_key")
    rows.write.mode("overwrite").parquet(f"{path}/postings")
    stored = stage(postings.spark.read.parquet(f"{path}/postings").groupBy("field", "gram").agg(F.count("*").alias("n")), "counts")
    stored.repartitionByRange("field", "gram").sortWithinPartitions("field", "gram").write.mode("overwrite").parquet(f"{path}/counts")
    keys.write.mode("overwrite").parquet(f"{path}/keys")
