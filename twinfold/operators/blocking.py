"""Candidate pairs: lossless blocking keys, rare-gram prefixes, hot-key splitting.

A pair that reaches tier (t, m) must agree on some set of equality fields (see
``MatchSchema.equality_subsets``) and, when t is high enough, share rare n-grams of
the index field. Blocks on equality fields that stay small are joined as they are.
Larger ones meet in cells of like lengths, or, in a stored index, are split by adding a
shared gram to the key. Nothing is capped: every pair a tier could accept is either returned or
implied.

Some blocks need no comparing: records that agree on a *certain* set (see
``MatchSchema.certain_sets``) are duplicates of each other whatever else they hold. Such
a group is returned as a star, each member paired with the group's first, and stays
linear in its size; the other pairs inside it are implied.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.similarity import SLACK, ngram_similarity
from twinfold.functions.text import char_ngrams
from twinfold.schema import DENY_DUP, MAX_SCORE, Field, MatchSchema
from twinfold.session import stage

RANK_BUCKETS = 65536
RANK_SAMPLE = 1_000_000
#: Contents of one side that meet in a task at once, and grams that are counted at once.
CELL = 1024
SLICE = 8192
#: Such cells, and characters of titles, that lie along a side of a task's part.
TILES = 16
PART_CHARS = 16 << 20
#: Characters of short fields that are compared before titles, and pairs of these that a task keeps.
BRIEF = 64
SEEN = 500_000


@dataclass(frozen=True)
class GramRule:
    """At similarity t, a string of length len loses at most ``slope*len + extra`` grams."""

    size: int
    slope: float
    extra: float

    def lost(self, length: Column) -> Column:
        return F.floor(length * F.lit(self.slope) + F.lit(self.extra + SLACK)).cast("int")


def gram_rule(threshold: float, n: int) -> GramRule | None:
    """The gram filter that loses no pair of this similarity, if there is one.

    Replacing one n-gram by a different one costs at least 1/n, so at distance d at
    most n*d grams have no counterpart. For n = 3 and lower similarities bigrams
    still work: one differing character spoils two bigrams and costs 1, except in
    the last two positions of an aligned run.
    """
    if threshold > 1 - 1 / n:
        return GramRule(n, n * (1 - threshold), 0.0)
    if n == 3 and threshold > 0.5:
        return GramRule(2, 2 * (1 - threshold), 2 / 3)
    return None


@dataclass(frozen=True)
class Family:
    """One kind of blocking key: agreeing fields, whole title or not, tier threshold."""

    number: int
    fields: tuple[Field, ...]
    title: bool
    threshold: float


def plan_blocks(schema: MatchSchema) -> list[Family]:
    families: list[Family] = []
    for tier in schema.ordered_tiers:
        for subset in schema.equality_subsets(tier) or [()]:
            families.append(Family(len(families), subset, tier.min_value >= 1.0, tier.min_value))
    return families


def describe_blocks(schema: MatchSchema) -> list[str]:
    out = []
    for f in plan_blocks(schema):
        keys = [x.name for x in f.fields] + ([schema.index_field.name] if f.title else [])
        rule = None if f.title else gram_rule(f.threshold, schema.ngram)
        out.append(f"{f.threshold}: equal({', '.join(keys)})" + (f" grams({rule.size})" if rule else ""))
    return out


def gram_ranks(titles: DataFrame, size: int) -> bytes:
    """Quantised document frequency of every gram bucket, a fixed 64 KB.

    Prefix filtering only needs some fixed order of grams, so a sampled, bucketed
    frequency changes the cost of a run and never its result.
    """
    share = min(1.0, RANK_SAMPLE / max(1, titles.count()))
    sample = titles.sample(share, 17) if share < 1 else titles
    counts = (
        sample.select(F.explode(F.array_distinct(char_ngrams("t", size))).alias("g"))
        .groupBy(F.pmod(F.xxhash64("g"), F.lit(RANK_BUCKETS)).alias("bucket"))
        .count()
        .collect()
    )
    ranks = bytearray(RANK_BUCKETS)
    for row in counts:
        ranks[row["bucket"]] = min(255, 1 + int(8 * math.log2(row["count"])))
    return bytes(ranks)


def gram_prefix(title: str, rule: GramRule, ranks: bytes) -> Column:
    """The rarest grams of a title, enough that similar titles share at least one."""
    bucket = lambda g: F.pmod(F.xxhash64(g), F.lit(RANK_BUCKETS)).cast("int")
    ranked = F.transform(
        F.array_distinct(char_ngrams(title, rule.size)),
        lambda g: F.struct(F.substring(F.lit(ranks), bucket(g) + 1, F.lit(1)).alias("r"), g.alias("g")),
    )
    return F.slice(F.array_sort(ranked), F.lit(1), rule.lost(F.length(title)) + 1)["g"]


def _denying(schema: MatchSchema) -> list[Field]:
    return [f for f in schema.equality if f.match == DENY_DUP]


def _payload(schema: MatchSchema) -> list[Column]:
    """What a block row carries so that hopeless pairs die inside the join."""
    cols = [F.col("content_id"), F.length("t").alias("len")]
    for f in _denying(schema):
        v = F.col(f"v_{f.name}")
        cols.append(F.when(v != "", F.xxhash64(v)).alias(f"h_{f.name}"))
    if schema.certain_sets():
        cols.append(certain_keys(schema).alias("certain"))
    return cols


def certain_keys(schema: MatchSchema, titled: bool | None = None) -> Column:
    """Digests of the certain sets a content fills; ``titled`` picks those with or without
    the index field."""
    keys = []
    for number, (fields, title) in enumerate(schema.certain_sets()):
        if titled is not None and title != titled:
            continue
        values = [F.col(f"v_{f.name}") for f in fields]
        filled = F.col("t") != ""
        for v in values:
            filled = filled & (v != "")
        text = F.concat_ws("\u0002", F.lit(str(number)), *values, *([F.col("t")] if title else []))
        keys.append(F.when(filled, F.unhex(F.md5(text))))
    return F.array_compact(F.array(*keys).cast("array<binary>"))


def certain_rows(classes: DataFrame, schema: MatchSchema, titled: bool | None = None) -> DataFrame:
    """(group, content_id, first_key): the certain groups a content belongs to. All members
    of a group are duplicates of each other."""
    return classes.select(F.explode(certain_keys(schema, titled)).alias("group"), "content_id", "first_key")


def _hubs(rows: DataFrame) -> DataFrame:
    """First content of every group that has several."""
    return (
        rows.groupBy("group")
        .agg(F.min(F.struct("first_key", "content_id")).alias("hub"), F.count("*").alias("n"))
        .select("group", F.col("hub.content_id").alias("hub"), "n")
    )


def certain_pairs(left: DataFrame, right: DataFrame | None, schema: MatchSchema) -> DataFrame:
    """Members of each certain group with the group's first content; across two tables,
    members of either side with the first of the other."""
    rows = certain_rows(left, schema)
    if right is None:
        hubs = stage(_hubs(rows).where("n > 1"), "hubs")
        star = rows.join(hubs, "group").where("content_id <> hub")
        return star.select(
            F.least("content_id", "hub").alias("content_1"), F.greatest("content_id", "hub").alias("content_2")
        )
    others = certain_rows(right, schema)
    return _stars_across(rows, stage(_hubs(rows), "hubs"), others, stage(_hubs(others), "hubs"))


def _stars_across(rows: DataFrame, hubs: DataFrame, others: DataFrame, other_hubs: DataFrame) -> DataFrame:
    """Members of groups of either side with the first of the other."""
    near = rows.join(other_hubs, "group").select(F.col("content_id").alias("content_1"), F.col("hub").alias("content_2"))
    far = others.join(hubs, "group").select(F.col("hub").alias("content_1"), F.col("content_id").alias("content_2"))
    return near.unionByName(far)


def _earlier(families: list[Family]) -> list[str]:
    """Columns with the keys of all families, if some have one threshold: what meets in an earlier one is left to it."""
    return [f"e_{f.number}" for f in families] if len({f.threshold for f in families}) < len(families) else []


def _met_before(fam: Family, families: list[Family], columns: list[str]) -> list[str]:
    """Of these columns, those of families before this one that accept the same pairs."""
    before = [f"e_{f.number}" for f in families if f.number < fam.number and f.threshold == fam.threshold]
    return [e for e in before if e in columns]


def _meet_once(families: list[Family]) -> bool:
    """Are pairs of blocks and cells distinct, as all families accept the same and leave them to the first one?"""
    return len(families) == 1 or all(f.fields or f.title for f in families) and len({f.threshold for f in families}) == 1


def _equality_rows(classes: DataFrame, schema: MatchSchema, families: list[Family], once: bool = False) -> DataFrame:
    """A row for each key that a content fills. ``once`` adds its keys in all families (0: none)."""
    keys = []
    for fam in families:
        values = [F.col(f"v_{f.name}") for f in fam.fields]
        present = F.lit(True)
        for v in values:
            present = present & (v != "")
        parts = [F.lit(fam.number), *values] + ([F.col("t")] if fam.title else [])
        keys.append(
            F.when(
                present,
                F.struct(F.xxhash64(*parts).alias("k"), F.lit(fam.number).alias("family")),
            )
        )
    names = _earlier(families) if once else []
    own = [F.coalesce(key["k"], F.lit(0).cast("long")).alias(n) for key, n in zip(keys, names)]
    return (
        classes.where(F.col("t") != "")
        .select(F.explode(F.array_compact(F.array(*keys))).alias("key"), *_payload(schema), *own)
        .select("key.k", "key.family", *_payload_names(schema), *names)
    )


def _payload_names(schema: MatchSchema) -> list[str]:
    return (
        ["content_id", "len"]
        + [f"h_{f.name}" for f in _denying(schema)]
        + (["certain"] if schema.certain_sets() else [])
    )


def _block_sizes(left: DataFrame, right: DataFrame | None) -> DataFrame:
    """Rows per key, counted before any shuffle of rows; lone keys are dropped."""
    if right is None:
        return left.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    both = left.select("k", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("k", F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        both.groupBy("k")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .where("l > 0 AND r > 0")
        .select("k", F.greatest("l", "r").alias("n"))
    )


def _main_groups(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Per crowded key the certain group with most of its rows: (k, main)."""
    held = rows.join(hot, "k", "left_semi").select("k", F.explode("certain").alias("main"))
    counts = held.groupBy("k", "main").agg(F.count("*").alias("n"))
    return counts.groupBy("k").agg(F.max(F.struct("n", "main"))["main"].alias("main"))


def _join_blocks(
    left: DataFrame,
    right: DataFrame | None,
    sizes: DataFrame,
    schema: MatchSchema,
    families: list[Family],
    salt_rows: int,
    crowd: int,
) -> DataFrame:
    """Pairs of rows with one key, but for those inside a certain group.

    In a key with more than ``crowd`` rows, the members of its largest certain group are
    not joined with each other at all: the other rows meet all rows. So a block whose
    rows all belong to one group makes no pairs, whatever its size.
    """
    small = sizes.where(F.col("n") <= crowd)
    if not schema.certain_sets():
        return _join_rows(left, left if right is None else right, sizes, schema, families, salt_rows, right is None)
    found = _join_rows(left, left if right is None else right, small, schema, families, salt_rows, right is None)
    hot = sizes.where(F.col("n") > crowd)
    both = left if right is None else left.unionByName(right)
    main = stage(_main_groups(both.select("k", "certain"), hot), "main")
    inside = F.coalesce(F.array_contains("certain", F.col("main")), F.lit(False))
    sides = [r.join(main, "k", "left").withColumn("main", inside) for r in ([left] if right is None else [left, right])]
    rest = sides[0].where(~F.col("main"))
    if right is None:
        return found.unionByName(_join_rows(rest, sides[0], hot, schema, families, salt_rows, True))
    more = _join_rows(rest, sides[1], hot, schema, families, salt_rows, False)
    last = _join_rows(sides[0].where("main"), sides[1].where(~F.col("main")), hot, schema, families, salt_rows, False)
    return found.unionByName(more).unionByName(last)


def _hopeful(schema: MatchSchema, families: list[Family], columns: list[str]) -> Column:
    """What rows ``a`` and ``b`` of one key show before their values are seen: lengths near enough, no denying
    field that differs, no certain group in common and, by their ``columns``, no earlier family that they meet in."""
    longer = F.greatest(F.col("a.len"), F.col("b.len"))
    shorter = F.least(F.col("a.len"), F.col("b.len"))
    threshold = F.lit(0.0)
    for fam in families:
        threshold = F.when(F.col("a.family") == fam.number, F.lit(fam.threshold)).otherwise(threshold)
    keep = shorter >= longer * threshold - SLACK
    for f in _denying(schema):
        x, y = F.col(f"a.h_{f.name}"), F.col(f"b.h_{f.name}")
        keep = keep & F.coalesce(x == y, F.lit(True))
    if schema.certain_sets():
        keep = keep & ~F.arrays_overlap("a.certain", "b.certain")
    for fam in families:
        for e in _met_before(fam, families, columns):
            keep = keep & ((F.col("a.family") != fam.number) | (F.col(f"a.{e}") == 0) | (F.col(f"a.{e}") != F.col(f"b.{e}")))
    return keep


def _join_rows(
    left: DataFrame,
    right: DataFrame,
    sizes: DataFrame,
    schema: MatchSchema,
    families: list[Family],
    salt_rows: int,
    same: bool,
) -> DataFrame:
    """Pairs of rows with one key. Keys over ``salt_rows`` rows are cut into that many
    rows per task: the left side by hash, the right side copied to every cut. ``same``:
    both sides are of one table, and ``main`` rows are on the right only."""
    cuts = F.ceil(F.col("n") / F.lit(salt_rows)).cast("int")
    a = left.join(sizes, "k").withColumn("salt", F.pmod(F.xxhash64("content_id"), cuts).cast("int")).alias("a")
    b = (
        right.join(sizes, "k")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), cuts - 1)))
        .alias("b")
    )
    keep = _hopeful(schema, families, left.columns)
    one, two = F.col("a.content_id"), F.col("b.content_id")
    if same:
        keep = keep & ((one < two) | F.col("b.main") if "main" in right.columns else one < two)
    on = (F.col("a.k") == F.col("b.k")) & (F.col("a.salt") == F.col("b.salt"))
    pairs = a.join(b, on & keep)
    if same:
        one, two = F.least(one, two), F.greatest(one, two)
    return pairs.select(one.alias("content_1"), two.alias("content_2"))


def _gram_rows(rows: DataFrame, schema: MatchSchema, families: list[Family], ranks: dict[int, bytes]) -> DataFrame:
    """Add one shared gram to each key: ``rows`` need k, family, t and the payload."""
    prefix = F.lit(None).cast("array<string>")
    for fam in families:
        rule = gram_rule(fam.threshold, schema.ngram)
        prefix = F.when(F.col("family") == fam.number, gram_prefix("t", rule, ranks[rule.size])).otherwise(prefix)
    return (
        rows.withColumn("gram", F.explode(prefix))
        .withColumn("k", F.xxhash64("k", "gram"))
        .select("k", "family", *_payload_names(schema))
    )


def title_grams(text: str, size: int) -> set[str]:
    """The distinct grams of a title, as ``char_ngrams`` has them."""
    padded = "\x01" * (size - 1) + text
    return {padded[i : i + size] for i in range(len(text))}


def _gram_codes(sides: list[list[str]], size: int) -> list[list[np.ndarray]]:
    """The distinct grams of each text, as sorted numbers that mean the same on all sides."""
    if size > 3:
        numbers: dict[str, int] = {}
        number = lambda g: numbers.setdefault(g, len(numbers))
        return [[np.array(sorted(number(g) for g in title_grams(t, size)), np.int64) for t in texts] for texts in sides]

    def coded(text: str) -> np.ndarray:
        padded = "\x01" * (size - 1) + text
        codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        out = codes[: len(text)]
        for i in range(1, size):
            out = (out << 21) | codes[i : i + len(text)]
        return np.unique(out)

    return [[coded(t) for t in texts] for texts in sides]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common grams of each text of one side with each of the other, in slices of the grams that both have."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    flat = [np.concatenate(side) for side in (left, right)]
    owner = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    both = np.intersect1d(*[np.unique(x) for x in flat], assume_unique=True)
    if not len(both):
        return out
    places = []
    for grams, rows in zip(flat, owner):
        at = np.minimum(np.searchsorted(both, grams), len(both) - 1)
        held = both[at] == grams
        places.append((rows[held], at[held]))
    for start in range(0, len(both), SLICE):
        width = min(SLICE, len(both) - start)
        tables = []
        for side, (rows, at) in zip((left, right), places):
            table = np.zeros((len(side), width), np.float32)
            inside = (at >= start) & (at < start + width)
            table[rows[inside], at[inside] - start] = 1.0
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _cell_names(schema: MatchSchema) -> list[str]:
    return [f"c_{f.name}" for f in schema.compared] + (["certain"] if schema.certain_sets() else [])


def _cell_fields(schema: MatchSchema) -> list[Column]:
    """What a row shows of its fields in a cell: digests of equality fields (0: empty), short texts, and whether a long
    one is filled."""
    out = []
    for f in schema.compared:
        v = F.col(f"v_{f.name}")
        if f in schema.equality:
            v = F.when(v != "", F.xxhash64(v).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
        out.append((v != "" if f.kind == "dice" else v).alias(f"c_{f.name}"))
    return out


def _coded(values: list) -> tuple[np.ndarray, list]:
    """The place of each value among the distinct ones, and these."""
    places: dict = {}
    return np.array([places.setdefault(v, len(places)) for v in values], np.int64), list(places)


def _allowed(rule: GramRule, sides: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Whether grams allow the rule's similarity for each text of one side with each of the other; shared grams."""
    grams = _gram_codes(sides, rule.size)
    shared = shared_counts(*grams)
    held = [np.array([len(g) for g in x], np.float32) for x in grams]
    lost = [np.floor(np.array([len(t) for t in x], float) * rule.slope + (rule.extra + SLACK)) for x in sides]
    return (held[0][:, None] - shared <= lost[0][:, None]) & (held[1] - shared <= lost[1]), shared


def _alike(cut: float, n: int, one: list[str], two: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which short texts of two sides are both filled, and which of these may be as similar as ``cut``."""
    (at, x), (to, y) = _coded(one), _coded(two)
    both = np.array([t != "" for t in x])[:, None] & np.array([t != "" for t in y])
    may, rule = both, gram_rule(cut, n)
    if rule is not None:
        brief = np.minimum(np.array([len(t) for t in x])[:, None], np.array([len(t) for t in y])) < 2 * n
        may = both & (brief | _allowed(rule, [x, y])[0])
    return both[np.ix_(at, to)], may[np.ix_(at, to)]


@dataclass(frozen=True)
class Shown:
    """What tasks need to know of a field: its column in a cell, kind, least similarity and match policy."""

    column: str
    kind: str
    cut: float | None
    match: str | None


def _shown(schema: MatchSchema) -> list[Shown]:
    kind = lambda f: "equal" if f in schema.equality else f.kind
    cut = lambda f: schema.author_score if f.kind == "authors" else f.min_score
    return [Shown(f"c_{f.name}", kind(f), cut(f), f.match) for f in schema.compared]


def _lowest_tier(a: pd.DataFrame, b: pd.DataFrame, shown: list[Shown], tiers: list[tuple[float, int]], n: int) -> np.ndarray:
    """The lowest similarity at which each row of one side can be a duplicate of each of the other, by what can be seen
    of their fields; 2 if none."""
    return _tier_of([_seen_of(f, a[f.column], b[f.column], n) for f in shown], shown, tiers, (len(a), len(b)))


def _seen_of(f: Shown, x: pd.Series, y: pd.Series, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where both sides of a field are filled, and where they may match."""
    if f.kind == "equal":
        x, y = x.to_numpy(np.int64), y.to_numpy(np.int64)
        both = (x != 0)[:, None] & (y != 0)
        return both, both & (x[:, None] == y)
    if f.kind == "dice":
        both = x.to_numpy(bool)[:, None] & y.to_numpy(bool)
        return both, both
    return _alike(f.cut, n, x.tolist(), y.tolist())


def _lowest_of_pairs(
    a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, shown: list[Shown], tiers: list[tuple[float, int]], n: int, seen: dict
) -> np.ndarray:
    """``_lowest_tier`` of the pairs of rows ``x`` and ``y``, with the similarity of texts of up to ``BRIEF`` characters;
    different ones are compared once in a task, which keeps what it has ``seen``."""
    told = []
    for f in shown:
        if f.kind in ("equal", "dice"):
            one, two = (s[f.column].to_numpy()[at] for s, at in ((a, x), (b, y)))
            both = (one != 0) & (two != 0)
            told.append((both, both & (one == two) if f.kind == "equal" else both))
            continue
        (at, one), (to, two) = _coded(a[f.column].tolist()), _coded(b[f.column].tolist())
        codes, back = np.unique(at[x] * len(two) + to[y], return_inverse=True)
        texts = [(one[c // len(two)], two[c % len(two)]) for c in codes.tolist()]
        known = seen.setdefault(f.column, {})
        if len(known) > SEEN:
            known.clear()
        fresh = [t for t in texts if t not in known and t[0] and t[1] and max(map(len, t)) <= BRIEF]
        similar = ngram_similarity([p for p, _ in fresh], [q for _, q in fresh], n, f.cut) >= f.cut - SLACK
        known.update(zip(fresh, similar.tolist()))
        both = np.array([bool(p and q) for p, q in texts], bool)
        told.append((both[back], np.array([bool(p and q) and known.get((p, q), True) for p, q in texts], bool)[back]))
    return _tier_of(told, shown, tiers, x.shape)


def _tier_of(
    told: list[tuple[np.ndarray, np.ndarray]], shown: list[Shown], tiers: list[tuple[float, int]], shape: tuple[int, ...]
) -> np.ndarray:
    matched, denied, top = np.zeros(shape, np.int16), np.zeros(shape, bool), np.zeros(shape, bool)
    for f, (both, may) in zip(shown, told):
        matched += may
        if f.match == DENY_DUP:
            denied |= both & ~may
        elif f.match == MAX_SCORE:
            top |= both & ~may
    lowest = np.full(shape, 2.0)
    for value, fields in tiers:
        lowest = np.where(matched >= fields, np.minimum(lowest, value), lowest)
    lowest = np.where(top, np.maximum(lowest, 1.0), lowest)
    return np.where(denied, 2.0, lowest)


def _near_in_cells(
    left: DataFrame,
    right: DataFrame | None,
    schema: MatchSchema,
    families: list[Family],
    confirm: bool = False,
    counted: float | None = None,
    ends: str = "content_id",
) -> DataFrame:
    """Pairs of rows with one key whose lengths and numbers of shared grams allow their family's similarity, and whose
    fields some tier; not those inside a certain group, nor those that meet in an earlier family of the same threshold
    if rows hold their keys of these.

    Rows meet in cells of like lengths only, cells in parts of bounded size, and each pair once; pairs leave a part
    cell by cell. ``left`` and ``right`` need k, family, t, content_id and ``_cell_names``. ``confirm`` keeps only pairs
    whose similarity reaches a tier that their fields allow. ``shared`` is the number of shared grams in families of
    the similarity ``counted``. ``ends`` is what rows are shown by.
    """
    rules = {f.number: (gram_rule(f.threshold, schema.ngram), f.threshold) for f in families}
    place = F.lit(None).cast("int")
    for number, (_, threshold) in rules.items():
        # a little wider than the threshold, so that rounding can't part two lengths by more than one place
        width = -math.log(threshold - 1e-3)
        place = F.when(F.col("family") == number, F.floor(F.log(F.length("t")) / width).cast("int")).otherwise(place)
    keys = [c for c in left.columns if c.startswith("e_")]
    names = ["k", "family", "t", *dict.fromkeys(["content_id", ends]), *_cell_names(schema), *keys]
    met = {f.number: _met_before(f, families, keys) for f in families}
    one = left.select(*names, place.alias("at"), F.lit(0).alias("up"))
    # of one table, a row meets its own place and the one above; of two tables, also the one below
    steps = [0, 1] if right is None else [-1, 0, 1]
    two = (left if right is None else right).select(*names, place.alias("own"), F.explode(F.array(*map(F.lit, steps))).alias("up"))
    two = two.withColumn("at", F.col("own") + F.col("up")).drop("own").select(one.columns)
    sides = [s.withColumn("k", F.xxhash64("k", "family", "at")).drop("at") for s in (one, two)]
    part_of = lambda rows, chars: F.ceil(F.greatest(rows / F.lit(TILES * CELL), chars / F.lit(PART_CHARS))).cast("int")
    sizes = [s.groupBy("k").agg(part_of(F.count("*"), F.sum(F.length("t"))).alias(n)) for s, n in zip(sides, ("l", "r"))]
    sizes = stage(sizes[0].join(sizes[1], "k"), "cells")
    dealt = []
    for number, (side, own, other) in enumerate(((sides[0], "l", "r"), (sides[1], "r", "l"))):
        part = F.pmod(F.xxhash64("content_id", "family"), F.col(own)).cast("int").alias(f"{own}_part")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_part")
        rows = side.join(sizes, "k").select(*names, "up", F.lit(number).alias("side"), part, every)
        # under new columns, as both sides may be one table
        dealt.append(rows.toDF(*rows.columns))
    same, size, seen = right is None, CELL, {}
    kind = left.schema[ends].dataType
    text = kind.simpleString() == "string"
    shown, tiers, n = _shown(schema), [(t.min_value, t.min_fields) for t in schema.tiers], schema.ngram
    brief = any(f.kind not in ("equal", "dice") for f in shown)

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pa.RecordBatch | None:
        rule, threshold = rules[int(a["family"].iloc[0])]
        lengths = [s["t"].str.len().to_numpy(float) for s in (a, b)]
        short = np.minimum(lengths[0][:, None], lengths[1])
        keep = short >= np.maximum(lengths[0][:, None], lengths[1]) * threshold - SLACK
        if not keep.any():
            return None
        ids = [s["content_id"].tolist() for s in (a, b)]
        if same:
            # pairs of one place meet from both sides
            order = {c: i for i, c in enumerate(sorted({*ids[0], *ids[1]}))}
            rank = [np.array([order[c] for c in s]) for s in ids]
            keep &= (b["up"].to_numpy() > 0) | (rank[0][:, None] < rank[1])
        for e in met[int(a["family"].iloc[0])]:
            one, two = a[e].to_numpy(np.int64), b[e].to_numpy(np.int64)
            keep &= (one[:, None] != two) | (one == 0)[:, None]
        if "certain" in a.columns:
            codes = _coded([g for s in (a, b) for gs in s["certain"] for g in map(bytes, gs)])[0]
            last = np.cumsum([len(gs) for s in (a, b) for gs in s["certain"]])
            held = [np.unique(x) for x in np.split(codes, last[:-1])]
            keep &= shared_counts(held[: len(a)], held[len(a) :]) == 0
        lowest = _lowest_tier(a, b, shown, tiers, n) if shown else np.full(keep.shape, threshold)
        keep &= lowest <= 1.0
        # titles that some pair is left for, each once
        live = [np.nonzero(keep.any(axis=1 - i))[0] for i in (0, 1)]
        if not len(live[0]):
            return None
        keep, lowest = keep[np.ix_(*live)], lowest[np.ix_(*live)]
        (at, one), (to, two) = (_coded([s["t"].iat[i] for i in rows]) for s, rows in zip((a, b), live))
        fits, shared = _allowed(rule, [one, two])
        keep &= (fits & (shared > 0))[np.ix_(at, to)]
        x, y = np.nonzero(keep)
        if confirm:
            fine = np.empty(len(x), bool)
            for start in range(0, len(x), 65536):
                cut = slice(start, start + 65536)
                floor = np.maximum(lowest[x[cut], y[cut]], threshold)
                if brief:
                    floor = np.maximum(floor, _lowest_of_pairs(a, b, live[0][x[cut]], live[1][y[cut]], shown, tiers, n, seen))
                may = np.nonzero(floor <= 1.0)[0]
                texts = [one[i] for i in at[x[cut][may]]], [two[i] for i in to[y[cut][may]]]
                fine[cut] = False
                fine[start + may] = ngram_similarity(*texts, n, floor[may], unlike=True) >= floor[may] - SLACK
            x, y = x[fine], y[fine]
        if not len(x):
            return None
        count = shared[at[x], to[y]].astype(np.int32)
        none = None if threshold == counted else np.ones(len(x), bool)
        x, y = live[0][x], live[1][y]
        told = [pa.array(s[ends].tolist(), pa.string() if text else pa.binary()) for s in (a, b)]
        if same:
            # both sides in one column, so that each pair can be turned round
            told = [pa.concat_arrays(told)] * 2
            turn = rank[0][x] > rank[1][y]
            x, y = np.where(turn, y + len(a), x), np.where(turn, x, y + len(a))
        return pa.record_batch([told[0].take(pa.array(x)), told[1].take(pa.array(y)), pa.array(count, mask=none)], names=out)

    def near(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pa.Table.from_batches(list(rows)).to_pandas()
        # texts of about one length share a tile, so that few lengths and grams meet in vain
        both = both.iloc[np.argsort(both["t"].str.len().to_numpy(), kind="stable")]
        a, b = (both[both["side"] == number] for number in (0, 1))
        for i in range(0, len(a), size):
            for j in range(0, len(b), size):
                found = meet(a.iloc[i : i + size], b.iloc[j : j + size])
                if found is not None:
                    yield found

    stem = ends.removeprefix("first_").removesuffix("_id")
    out = [f"{stem}_1", f"{stem}_2", "shared"]
    shape = f"{out[0]} {kind.simpleString()}, {out[1]} {kind.simpleString()}, shared int"
    # a part costs far more than its bytes: tasks stay many, so that each has parts of several sizes
    part = ["k", "l_part", "r_part"]
    tasks = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt[0].unionByName(dealt[1]).repartition(tasks, *part).groupBy(*part).applyInArrow(near, shape)


def _kinds_of(schema: MatchSchema) -> tuple[list[Family], list[Family], list[Family], list[Family]]:
    """All families, those with an equal field or title, those on grams alone, and those whose blocks grams can split."""
    families = plan_blocks(schema)
    keyed = [f for f in families if f.fields or f.title]
    gram_only = [f for f in families if not f.fields and not f.title]
    for f in gram_only:
        if gram_rule(f.threshold, schema.ngram) is None:
            raise ValueError(
                f"{schema.name}: the tier at {f.threshold} needs no equal field and is too low for a gram filter"
            )
    return families, keyed, gram_only, [f for f in keyed if not f.title and gram_rule(f.threshold, schema.ngram)]


def _without_fields(side: DataFrame, schema: MatchSchema, gram_only: list[Family], extra: list[str] | None = None) -> DataFrame:
    """Rows of one key for each family on grams alone."""
    numbers = F.array(*[F.lit(f.number) for f in gram_only])
    more = [*(extra or []), *_payload(schema), *_cell_fields(schema)]
    every = side.where(F.col("t") != "").select("t", F.explode(numbers).alias("family"), *more)
    return every.withColumn("k", F.col("family").cast("long"))


def _all_found(found: list[DataFrame], counted: float | None) -> DataFrame:
    """Distinct pairs, with the number of shared grams where it is known if they are ``counted``."""
    pairs = _any_found(found, counted)
    if counted is None:
        return pairs.distinct()
    return pairs.groupBy("content_1", "content_2").agg(F.max("shared").alias("shared"))


def _any_found(found: list[DataFrame], counted: float | None) -> DataFrame:
    pairs = None
    for some in found:
        shared = F.col("shared") if "shared" in some.columns else F.lit(None).cast("int")
        some = some.select("content_1", "content_2", *([] if counted is None else [shared.alias("shared")]))
        pairs = some if pairs is None else pairs.unionByName(some)
    return pairs


@dataclass(frozen=True)
class _Found:
    """Candidate pairs of blocks, cells and certain groups; the last are in none of the others."""

    blocks: DataFrame | None
    cells: DataFrame | None
    stars: DataFrame | None


def _find(
    left: DataFrame,
    right: DataFrame | None,
    schema: MatchSchema,
    block_limit: int,
    salt_rows: int,
    confirm: bool,
    counted: float | None,
    ends: str = "content_id",
) -> _Found:
    families, keyed, gram_only, splittable = _kinds_of(schema)
    sides = [left] if right is None else [left, right]
    blocks = cells = None
    crowds: list[list[DataFrame]] = [[] for _ in sides]
    extra, early = [] if ends == "content_id" else [ends], _earlier(keyed)

    if keyed:
        rows = [_equality_rows(side, schema, keyed, True) for side in sides]
        sizes = stage(_block_sizes(rows[0], rows[1] if right is not None else None), "sizes")
        split = F.col("family").isin([f.number for f in splittable]) if splittable else F.lit(False)
        whole = [r.join(sizes, "k").where(~split | (F.col("n") <= block_limit)).drop("n") for r in rows]
        blocks = _join_blocks(whole[0], whole[1] if right is not None else None, sizes, schema, keyed, salt_rows, block_limit)
        if splittable:
            hot = sizes.where(F.col("n") > block_limit).select("k")
            for at, (side, r) in enumerate(zip(sides, rows)):
                shown = side.select("content_id", "t", *extra, *_cell_fields(schema))
                crowds[at].append(r.where(split).join(hot, "k", "left_semi").join(shown, "content_id"))
    if gram_only:
        for at, side in enumerate(sides):
            rows = _without_fields(side, schema, gram_only, extra)
            crowds[at].append(rows.withColumns({e: F.lit(0).cast("long") for e in early}) if early else rows)
    if crowds[0]:
        names = ["k", "family", "t", "content_id", *extra, *_cell_names(schema), *early]
        parts = []
        for some in crowds:
            one = some[0].select(*names)
            for more in some[1:]:
                one = one.unionByName(more.select(*names))
            parts.append(stage(one, "crowded"))
        other = parts[1] if right is not None else None
        cells = _near_in_cells(parts[0], other, schema, splittable + gram_only, confirm, counted, ends)
    stars = certain_pairs(left, right, schema) if schema.certain_sets() else None
    return _Found(blocks, cells, stars)


def candidate_pairs(
    left: DataFrame,
    right: DataFrame | None,
    schema: MatchSchema,
    block_limit: int = 64,
    salt_rows: int = 4096,
    confirm: bool = False,
    counted: float | None = None,
) -> DataFrame:
    """Distinct (content_1, content_2) that may be duplicates, certain groups as stars.

    ``left`` and ``right`` are content tables (see ``dedup.contents``); ``right=None``
    pairs a table with itself, smaller id first. For ``confirm`` and ``counted`` see ``_near_in_cells``.
    """
    found = _find(left, right, schema, block_limit, salt_rows, confirm, counted)
    met = [x for x in (found.blocks, found.cells) if x is not None]
    stars = [] if found.stars is None else [found.stars]
    if not _meet_once(plan_blocks(schema)):
        return _all_found(met + stars, counted)
    # only stars, which are as many as their members, can say a pair twice
    return _any_found(met + [x.distinct() for x in stars], counted)


def near_titles(
    left: DataFrame, right: DataFrame | None, schema: MatchSchema, threshold: float, block_limit: int = 64, salt_rows: int = 4096
) -> DataFrame:
    """(key_1, key_2, shared): ``shared_grams`` of all candidate pairs, by the first keys of their contents.

    Where all families are of this threshold, the pairs of cells leave with their keys and counts and are stored
    nowhere; else all pairs are."""
    other = left if right is None else right

    def keyed(pairs: DataFrame) -> DataFrame:
        for n, side in ((1, left), (2, other)):
            pairs = pairs.join(side.select(F.col("content_id").alias(f"content_{n}"), F.col("first_key").alias(f"key_{n}")), f"content_{n}")
        return pairs.select("key_1", "key_2", "shared")

    families = plan_blocks(schema)
    if not _meet_once(families) or families[0].threshold != threshold:
        pairs = candidate_pairs(left, right, schema, block_limit, salt_rows, counted=threshold)
        return keyed(shared_grams(pairs, left, other, schema, threshold))
    found = _find(left, right, schema, block_limit, salt_rows, False, threshold, "first_key")
    out = found.cells
    rest = [x for x in (found.blocks, None if found.stars is None else found.stars.distinct()) if x is not None]
    if rest:
        more = keyed(shared_grams(_any_found(rest, None), left, other, schema, threshold))
        out = more if out is None else out.unionByName(more)
    return out


#: Rows of a stored block that are joined where they lie.
PLAIN = 1024


@dataclass(frozen=True)
class IndexBlocks:
    """Blocking tables of a stored index, each dealt out by its first column.

    ``plain`` and ``heavy`` hold its rows (k, family and payload) in blocks of up to ``PLAIN`` rows and in larger
    ones, ``split`` the keys (k) whose rows are held by key and gram. ``groups`` are its certain groups (group,
    content_id, first_key) and ``hubs`` the first of each (group, hub). ``ranks`` are the gram ranks by size.
    ``contents`` are its contents: where titles alone decide, these meet in cells and no grams are stored.
    """

    plain: DataFrame
    heavy: DataFrame
    split: DataFrame
    groups: DataFrame
    hubs: DataFrame
    ranks: dict[int, bytes]
    contents: DataFrame


def index_blocks(classes: DataFrame, schema: MatchSchema, block_limit: int = 64) -> IndexBlocks:
    """Blocking tables of an index with these contents. Which blocks are split by grams is settled here."""
    families, keyed, gram_only, splittable = _kinds_of(schema)
    gram_only = gram_only if schema.compared else []
    sizes_needed = {gram_rule(f.threshold, schema.ngram).size for f in gram_only + splittable}
    ranks = {size: gram_ranks(classes.select("t"), size) for size in sizes_needed}
    rows, split = _equality_rows(classes, schema, keyed) if keyed else None, None
    if splittable:
        may = rows.where(F.col("family").isin([f.number for f in splittable]))
        split = stage(may.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > block_limit).select("k"), "split")
        crowded = rows.join(split, "k", "left_semi").join(classes.select("content_id", "t"), "content_id")
        rows = rows.join(split, "k", "left_anti").unionByName(_gram_rows(crowded, schema, splittable, ranks))
    if gram_only:
        more = _gram_rows(_without_fields(classes, schema, gram_only), schema, gram_only, ranks)
        rows = more if rows is None else rows.unionByName(more)
    if rows is None:
        none = F.lit(0).cast("long").alias("k"), F.lit(0).alias("family")
        rows = classes.where("false").select(*none, *_payload(schema))
    rows = stage(rows, "blocks")
    if split is None:
        split = rows.where("false").select("k")
    large = stage(rows.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > PLAIN).select("k"), "large")
    groups = certain_rows(classes, schema)
    return IndexBlocks(
        rows.join(large, "k", "left_anti"), rows.join(large, "k", "left_semi"), split,
        groups, _hubs(groups).select("group", "hub"), ranks, classes,
    )


def probe_blocks(
    left: DataFrame,
    blocks: IndexBlocks,
    schema: MatchSchema,
    salt_rows: int = 4096,
    crowd: int = 64,
    confirm: bool = False,
    counted: float | None = None,
) -> DataFrame:
    """Distinct (content_1, content_2): contents of a batch and of a stored index that may be duplicates.

    The batch's keys travel to the index's blocks; these stay in place. Only heavy blocks that the batch asks for,
    and blocks for which it has more than ``salt_rows`` rows, are dealt out anew; so are the titles of both where
    titles alone decide. For ``confirm`` and ``counted`` see ``_near_in_cells``.
    """
    families, keyed, gram_only, splittable = _kinds_of(schema)
    found, probe = [], None
    if gram_only and not schema.compared:
        cells = [_without_fields(side, schema, gram_only) for side in (left, blocks.contents)]
        found.append(_near_in_cells(*cells, schema, gram_only, confirm, counted))
        gram_only = []
    if keyed:
        probe = _equality_rows(left, schema, keyed)
        if splittable:
            rows = stage(probe, "keys")
            crowded = rows.join(blocks.split, "k", "left_semi").join(left.select("content_id", "t"), "content_id")
            probe = rows.join(blocks.split, "k", "left_anti")
            probe = probe.unionByName(_gram_rows(crowded, schema, splittable, blocks.ranks))
    if gram_only:
        more = _gram_rows(_without_fields(left, schema, gram_only), schema, gram_only, blocks.ranks)
        probe = more if probe is None else probe.unionByName(more)
    if probe is not None:
        found += _probed(stage(probe, "probe"), blocks, schema, families, salt_rows, crowd)
    if schema.certain_sets():
        rows = certain_rows(left, schema)
        found.append(_stars_across(rows, stage(_hubs(rows), "hubs"), blocks.groups, blocks.hubs))
    return _all_found(found, counted)


def _probed(
    probe: DataFrame, blocks: IndexBlocks, schema: MatchSchema, families: list[Family], salt_rows: int, crowd: int
) -> list[DataFrame]:
    """Pairs of a batch's keys with a stored index's blocks."""
    many = stage(probe.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > salt_rows).select("k"), "many")
    a, b = probe.join(many, "k", "left_anti").alias("a"), blocks.plain.alias("b")
    near = a.join(b, (F.col("a.k") == F.col("b.k")) & _hopeful(schema, families, []))
    near = near.select(F.col("a.content_id").alias("content_1"), F.col("b.content_id").alias("content_2"))
    asked = probe.select("k").distinct()
    rest = blocks.heavy.join(asked, "k", "left_semi").unionByName(blocks.plain.join(many, "k", "left_semi"))
    rest = stage(rest, "heavy")
    sizes = stage(_block_sizes(probe, rest), "sizes")
    return [near, _join_blocks(probe, rest, sizes, schema, families, salt_rows, crowd)]


def shared_grams(pairs: DataFrame, left: DataFrame, right: DataFrame, schema: MatchSchema, threshold: float) -> DataFrame:
    """Candidate pairs whose index fields share enough n-grams for ``threshold``, with
    the number of distinct grams they share (content_1, content_2, shared).

    ``pairs`` that were counted for this threshold (see ``candidate_pairs``) are not counted again."""
    if "shared" in pairs.columns:
        pairs = stage(pairs, "counted")
        rest = shared_grams(pairs.where("shared IS NULL").drop("shared"), left, right, schema, threshold)
        return pairs.where("shared IS NOT NULL").unionByName(rest)
    rule = gram_rule(threshold, schema.ngram)

    def side(rows: DataFrame, n: int) -> DataFrame:
        return rows.select(F.col("content_id").alias(f"content_{n}"), F.col("t").alias(f"t_{n}"))

    joined = pairs.join(side(left, 1), "content_1").join(side(right, 2), "content_2")
    sized = joined.withColumns({f"len_{n}": F.length(f"t_{n}") for n in (1, 2)})
    close = sized.where(F.least("len_1", "len_2") >= F.greatest("len_1", "len_2") * F.lit(threshold) - SLACK)

    @F.pandas_udf("shared int, one int, two int")
    def count(one: pd.Series, two: pd.Series) -> pd.DataFrame:
        # a text is in many pairs of a batch
        held = {t: title_grams(t, rule.size) for t in {*one, *two}}
        rows = [(len(held[x] & held[y]), len(held[x]), len(held[y])) for x, y in zip(one, two)]
        return pd.DataFrame(rows, columns=["shared", "one", "two"])

    counted = close.withColumn("_n", count("t_1", "t_2")).withColumn("shared", F.col("_n.shared"))
    enough = F.col("shared") > 0
    for n, held in ((1, "one"), (2, "two")):
        enough = enough & (F.col(f"_n.{held}") - F.col("shared") <= rule.lost(F.col(f"len_{n}")))
    return counted.where(enough).select("content_1", "content_2", "shared")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
