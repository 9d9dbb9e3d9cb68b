"""Licence notices in texts, found by a positional index of rare words.

Notices are templates: words at positions, some of which are key phrases that have to stand there. The index has a
posting (word, template, position) for each word. One pass over the texts counts words and lists the licence words each
text holds; how many texts hold a word gives its weight. Of each template the key word that the fewest texts hold is
its anchor: a text that lacks it lacks the notice. Texts with an anchor are looked up: each licence word at its place
proposes where the template would begin, proposals meet at equal beginnings, and a beginning counts if all key words
agree there and the words that agree have enough of the template's weight.

Only DataFrame functions run; what is sent to all tasks is the table of templates, some hundred rows by definition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.common import kept_struct, stage, with_kept

#: A word of a lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Hundredths of a template's weight that have to agree.
LEAST = 60
#: Weight of a word that no text holds, at most.
HEAVIEST = 40


@dataclass(frozen=True)
class Template:
    """A notice in words, the phrases in it that must stand, and whether it is one of the base phrases."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_places(self) -> set[int]:
        """Positions of the key phrases' words."""
        out: set[int] = set()
        for phrase in self.keys:
            part = phrase.split()
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(part)] == part)
            out |= set(range(at, at + len(part)))
        return out


# The base phrases with their labels, and words of well-known notices.
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("mit", "released under the mit license", ("the mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("permission is hereby granted", "free of charge"),
    ),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", ("redistribution and use",)),
    Template("gpl", "this program is free software you can redistribute it", ("is free software", "redistribute it")),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("subject to the terms", "mozilla public license"),
    ),
    Template(
        "public-domain",
        "this is free and unencumbered software released into the public domain",
        ("released into the public domain",),
    ),
)


def lexicon(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    """All words of the templates."""
    return sorted({w for t in templates for w in t.words})


def _lowered(text: Column) -> Column:
    """A-Z in lower case; the two other letters whose lower case is an ASCII letter stay apart."""
    odd = text.contains("İ") | text.contains("K")
    return F.lower(F.when(odd, F.translate(text, "İK", "ıĸ")).otherwise(text))


def _words_of(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _scan(rows: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(row, kept, n_words, held, hits): licence words held, and where they stand if a template's key words are all held."""
    known = lexicon(templates)
    words = F.regexp_extract_all(_lowered(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    worded = rows.select(F.monotonically_increasing_id().alias("row"), "kept", words.alias("words"))
    held = worded.withColumn("held", F.array_intersect("words", _words_of(known)))
    able = F.lit(False)
    for t in templates:
        keys = sorted({t.words[i] for i in t.key_places()})
        able = able | (F.size(F.array_intersect("held", _words_of(keys))) == len(keys))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = F.when(able, F.filter(placed, lambda x: x["word"].isin(known)))
    return held.select("row", "kept", F.size("words").cast("long").alias("n_words"), "held", hits.alias("hits"))


def weights(texts: int, held: dict[str, int], templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Weight of each word: one, and one more for each time that the texts holding it can be doubled."""
    out = {}
    for word in lexicon(templates):
        n = held.get(word, 0)
        out[word] = 1 + sum(n << k <= texts for k in range(1, HEAVIEST + 1))
    return out


def _postings(spark: SparkSession, templates: tuple[Template, ...], weight: dict[str, int], held: dict[str, int]) -> DataFrame:
    """(word, template, place, weight, is_key, anchor, total, n_keys, label, base) for each word of each template."""
    rows = []
    for number, t in enumerate(templates):
        keys = t.key_places()
        anchor = min((held.get(t.words[i], 0), t.words[i]) for i in keys)[1]
        total = sum(weight[w] for w in t.words)
        for place, word in enumerate(t.words):
            is_key = str(place in keys).lower()
            rows.append(
                f"('{word}', {number}, {place}, {weight[word]}L, {is_key}, '{anchor}', {total}L, {len(keys)}L, '{t.label}', {str(t.base).lower()})"
            )
    names = "word, template, place, weight, is_key, anchor, total, n_keys, label, base"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS postings({names})")


def _found(texts: DataFrame, postings: DataFrame, least: int) -> DataFrame:
    """(row, label, base, begin, agree, total): each place where a template stands."""
    hits = texts.filter("hits is not null").select("row", "held", F.explode("hits").alias("hit"))
    hits = hits.select("row", "held", F.col("hit.at").alias("at"), F.col("hit.word").alias("word"))
    met = hits.join(F.broadcast(postings), "word").filter(F.array_contains("held", F.col("anchor")) & (F.col("at") >= F.col("place")))
    begins = met.groupBy("row", "template", (F.col("at") - F.col("place")).alias("begin")).agg(
        F.sum("weight").alias("agree"),
        F.count(F.when(F.col("is_key"), 1)).alias("keys"),
        *[F.first(c).alias(c) for c in ("total", "n_keys", "label", "base")],
    )
    return begins.filter((F.col("keys") == F.col("n_keys")) & (100 * F.col("agree") >= least * F.col("total")))


def scan_licenses(
    docs: DataFrame, *keep: str, templates: tuple[Template, ...] = TEMPLATES, least: int = LEAST
) -> DataFrame:
    """Licence notices of each row of ``docs`` (text and the columns ``keep``).

    Returns ``keep``, n_words, n_base (places of base phrases), first_word and last_word (their smallest and largest
    first word, null without any), base_labels and labels (of all templates; both distinct, sorted, joined by commas)
    and score (the largest share of a template's weight that stands in the text, 0 without any). Null and empty texts
    have no words. Equal rows each have a result and each count for the weights; an empty table has none.
    """
    spark = docs.sparkSession
    rows = with_kept(docs, ["text"], keep).select("text", kept_struct(keep).alias("kept"))
    texts = stage(_scan(rows, templates), "licence_words")
    # a row for each word of the templates
    held = dict(texts.select(F.explode("held").alias("word")).groupBy("word").count().collect())
    weight = weights(texts.count(), held, templates)
    found = _found(texts, _postings(spark, templates, weight, held), least)
    of_base = lambda c: F.when(F.col("base"), F.col(c))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_row = found.groupBy("row").agg(
        F.count(of_base("begin")).alias("n_base"),
        F.min(of_base("begin")).cast("long").alias("first_word"),
        F.max(of_base("begin")).cast("long").alias("last_word"),
        joined(of_base("label")).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max(F.col("agree") / F.col("total")).alias("score"),
    )
    out = texts.select("row", "kept", "n_words").join(by_row, "row", "left")
    empty = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    shown = [(F.coalesce(c, empty[c]) if c in empty else F.col(c)).alias(c) for c in columns]
    return out.select(*[F.col(f"kept.kept{i}").alias(f"kept{i}") for i in range(len(keep))], *shown).toDF(*keep, *columns)
