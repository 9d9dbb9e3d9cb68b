"""Find duplicates within a batch or between a batch and an index.

Rows with the same comparable content are folded into one *content* first, so a
group of copies of any size is compared once. Results keep that factored form:
pairs of different contents, plus every further copy listed against the first
record of its content. ``expand_pairs`` turns it into record pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from twinfold.functions.compare import (
    IGNORED,
    MATCH,
    NOT_COMPARED,
    equality_statuses,
    prepared,
    score_fields,
    still_possible,
    tier_min_fields,
)
from twinfold.functions.text import record_key
from twinfold.operators.blocking import IndexBlocks, candidate_pairs, certain_keys, certain_rows, probe_blocks
from twinfold.schema import MatchSchema
from twinfold.session import release, stage

#: Records of one side of a group that meet in a task when pairs are listed.
PART = 16_384


def with_key(df: DataFrame, schema: MatchSchema) -> DataFrame:
    if "rec_key" in df.columns:
        return df
    key = record_key(schema.id_field.name, schema.database_field.name)
    # never null, so joins on it add no null test that would compute the key again
    return df.withColumn("rec_key", F.coalesce(key, F.lit("")))


def members(df: DataFrame, schema: MatchSchema) -> DataFrame:
    """Input rows with rec_key, comparable values and the id of their content."""
    rows = prepared(with_key(df, schema), schema)
    values = [F.col("t")] + [F.col(f"v_{f.name}") for f in schema.compared]
    digest = F.unhex(F.md5(F.concat_ws("\u0002", *values)))
    return rows.withColumn("content_id", F.coalesce(digest, F.lit(b"")))


def _values(schema: MatchSchema) -> list[str]:
    return ["t"] + [f"v_{f.name}" for f in schema.compared] + [f"d_{f.name}" for f in schema.of_kind("dice")]


def comparable_rows(df: DataFrame, schema: MatchSchema) -> DataFrame:
    """What matching needs of each row; raw fields stay in the input."""
    return members(df, schema).select("content_id", "rec_key", *_values(schema))


def contents(rows: DataFrame, schema: MatchSchema) -> DataFrame:
    """One row per content: comparable values, smallest and largest key, number of rows."""
    return rows.groupBy("content_id").agg(
        *[F.first(v).alias(v) for v in _values(schema)],
        F.min("rec_key").alias("first_key"),
        F.max("rec_key").alias("last_key"),
        F.count("*").alias("n_rows"),
    )


def _side(side: DataFrame, suffix: str, names: list[str]) -> DataFrame:
    return side.select(
        F.col("content_id").alias(f"content{suffix}"), *[F.col(c).alias(f"{c}{suffix}") for c in names]
    )


def verify_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, schema: MatchSchema) -> DataFrame:
    """Candidate pairs that are duplicates, with similarity, scores and statuses.

    ``pairs`` are staged. Long texts join only the pairs that their other fields leave possible."""
    texts = [f"d_{f.name}" for f in schema.of_kind("dice")]
    sides = [_side(rows, f"_{n}", [c for c in _values(schema) if c not in texts]) for n, rows in ((1, left), (2, right))]
    joined = pairs.join(sides[0], "content_1").join(sides[1], "content_2")
    possible = equality_statuses(joined, schema).where(still_possible(schema))
    if texts:
        for n, rows in ((1, left), (2, right)):
            possible = possible.join(_side(rows, f"_{n}", texts), f"content_{n}")
    scored = score_fields(possible, schema).where("duplicate")
    return scored.select(
        "content_1",
        "content_2",
        "similarity",
        "matched_fields",
        "min_fields",
        *[c for f in schema.compared for c in (f"score_{f.name}", f"status_{f.name}")],
    )


def copies_are_duplicates(schema: MatchSchema) -> Column:
    """Would two rows of this content be duplicates? Similarity is 1, so only the
    number of filled fields decides."""
    need = tier_min_fields(schema, F.lit(1.0))
    return F.coalesce((F.col("t") != "") & (_filled(schema) >= need), F.lit(False))


@dataclass
class Duplicates:
    """Staged result of one check. ``left`` and ``right`` are content tables, ``*_rows``
    the comparable rows, ``*_input`` the untouched input; a self check has one side."""

    schema: MatchSchema
    left_input: DataFrame
    right_input: DataFrame
    left_rows: DataFrame
    right_rows: DataFrame
    left: DataFrame
    right: DataFrame
    pairs: DataFrame
    self_check: bool


@dataclass(frozen=True)
class Prepared:
    """A table made ready to be matched: the input, its comparable rows and its contents."""

    input: DataFrame
    rows: DataFrame
    contents: DataFrame
    #: Blocking tables, if it is a stored index.
    blocks: IndexBlocks | None = None


def prepare(df: DataFrame, schema: MatchSchema) -> Prepared:
    """Normalise a table once, for any number of checks."""
    rows = stage(comparable_rows(df, schema), "rows")
    return Prepared(df, rows, stage(contents(rows, schema), "contents"))


def find_duplicates(
    batch: DataFrame | Prepared,
    schema: MatchSchema,
    index: DataFrame | Prepared | None = None,
    block_limit: int = 64,
) -> Duplicates:
    """Check ``batch`` against itself, or against ``index``.

    A stored index (see ``sources.match_index``) is joined where it lies."""
    left = batch if isinstance(batch, Prepared) else prepare(batch, schema)
    right = left if index is None else index if isinstance(index, Prepared) else prepare(index, schema)
    if right.blocks is not None and index is not None:
        candidates = probe_blocks(left.contents, right.blocks, schema, confirm=True)
    else:
        candidates = candidate_pairs(
            left.contents, None if index is None else right.contents, schema, block_limit, confirm=True
        )
    release(left.contents.sparkSession)
    candidates = stage(candidates, "candidates")
    release(left.contents.sparkSession)
    pairs = stage(verify_pairs(candidates, left.contents, right.contents, schema), "pairs")
    release(left.contents.sparkSession)
    return Duplicates(
        schema, left.input, right.input, left.rows, right.rows, left.contents, right.contents, pairs, index is None
    )


def _scores(schema: MatchSchema) -> list[str]:
    return ["similarity", "matched_fields"] + [c for f in schema.compared for c in (f"score_{f.name}", f"status_{f.name}")]


_ENDS = ["content_1", "key_1", "content_2", "key_2"]


def _pair_rows(dups: Duplicates) -> DataFrame:
    """One row per pair of linked contents, shown by a key of each side."""
    ends = ["first_key", "last_key"]
    one, two = F.col("first_key_1"), F.col("first_key_2")
    shown = dups.pairs.join(_side(dups.left, "_1", ends), "content_1").join(_side(dups.right, "_2", ends), "content_2")
    shown = shown.withColumns(
        {
            "key_1": F.when((one == two) & (F.col("last_key_2") == one), F.col("last_key_1")).otherwise(one),
            "key_2": F.when(one == two, F.col("last_key_2")).otherwise(two),
        }
        # contents that only occur under one and the same key are no pair
    ).where("key_1 <> key_2")
    if dups.self_check:
        swap = F.col("key_1") > F.col("key_2")
        ordered = [F.when(swap, F.col(x)).otherwise(F.col(y)).alias(y) for x, y in zip(_ENDS[2:] + _ENDS[:2], _ENDS)]
    else:
        ordered = _ENDS
    return shown.select(*ordered, *_scores(dups.schema))


def _filled(schema: MatchSchema) -> Column:
    return sum((F.when(F.col(f"v_{f.name}") != "", 1).otherwise(0) for f in schema.compared), F.lit(0))


def _self_copies(dups: Duplicates) -> DataFrame:
    """Contents held by several records that are duplicates of each other."""
    schema = dups.schema
    score = [F.lit(1.0).alias("similarity"), _filled(schema).alias("matched_fields")]
    for f in schema.compared:
        empty = F.col(f"v_{f.name}") == ""
        score.append(F.when(empty, F.lit(0.0)).otherwise(F.lit(1.0)).alias(f"score_{f.name}"))
        score.append(F.when(empty, IGNORED).otherwise(MATCH).alias(f"status_{f.name}"))
    several = copies_are_duplicates(schema) & (F.col("first_key") != F.col("last_key"))
    return dups.left.where(several).select("content_id", "first_key", "last_key", *score)


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select("content_id", "rec_key").distinct()


def _self_copy_rows(dups: Duplicates) -> DataFrame:
    """Each further key of a content against its first key."""
    copies = _self_copies(dups).join(_keys(dups.left_rows), "content_id").where("first_key <> rec_key")
    return copies.select(
        F.col("content_id").alias("content_1"), F.col("first_key").alias("key_1"),
        F.col("content_id").alias("content_2"), F.col("rec_key").alias("key_2"), *_scores(dups.schema)
    )


def _index_copy_rows(dups: Duplicates, side: str) -> DataFrame:
    """Each further key of a linked content against the first partner of that content."""
    own, other = ("1", "2") if side == "left" else ("2", "1")
    near, far = (dups.left, dups.right) if side == "left" else (dups.right, dups.left)
    rows = dups.left_rows if side == "left" else dups.right_rows
    scores = _scores(dups.schema)
    ends = far.select(F.col("content_id").alias("partner"), "first_key", "last_key")
    several = near.where("first_key <> last_key").select("content_id", F.col("first_key").alias("shown"))
    linked = dups.pairs.select(
        F.col(f"content_{own}").alias("content_id"), F.col(f"content_{other}").alias("partner"), *scores
    ).join(several, "content_id")
    best = (
        linked.join(ends, "partner")
        .groupBy("content_id", "shown")
        .agg(F.min_by(F.struct("partner", "first_key", "last_key", *scores), F.struct("first_key", "partner")).alias("p"))
        .select("content_id", "shown", "p.*")
    )
    copies = best.join(_keys(rows), "content_id").where("rec_key <> shown")
    key = F.when(F.col("first_key") == F.col("rec_key"), F.col("last_key")).otherwise(F.col("first_key"))
    return (
        copies.withColumn("key", key)
        .where("key <> rec_key")
        .select(
            F.col("content_id").alias(f"content_{own}"), F.col("rec_key").alias(f"key_{own}"),
            F.col("partner").alias(f"content_{other}"), F.col("key").alias(f"key_{other}"), *scores
        )
        .select(*_ENDS, *scores)
    )


def linked_keys(dups: Duplicates) -> DataFrame:
    """The factored result: one row per pair of linked contents and one per further
    copy, as contents, keys and scores. Every record that has a duplicate appears."""
    if dups.self_check:
        return _pair_rows(dups).unionByName(_self_copy_rows(dups))
    return (
        _pair_rows(dups)
        .unionByName(_index_copy_rows(dups, "left"))
        .unionByName(_index_copy_rows(dups, "right"))
    )


def _raw_records(df: DataFrame, schema: MatchSchema, keys: DataFrame, n: int) -> DataFrame:
    """Raw fields of the shown keys; only their rows are normalised again, and none of an
    index that stores their contents."""
    shown = with_key(df, schema).join(keys, "rec_key", "left_semi")
    return (
        (shown if "content_id" in df.columns else members(shown, schema))
        .groupBy(F.col("content_id").alias(f"content_{n}"), F.col("rec_key").alias(f"key_{n}"))
        .agg(F.min(F.struct(*schema.names)).alias(f"record_{n}"))
    )


def duplicate_report(dups: Duplicates) -> DataFrame:
    """Report rows: per field both values, score and status; then similarity and
    number of matched fields."""
    return report_links(dups, linked_keys(dups))


def report_links(dups: Duplicates, links: DataFrame) -> DataFrame:
    """Report rows of given links (contents, keys and scores)."""
    schema = dups.schema
    links = stage(links, "links")
    keys = [links.select(F.col(f"key_{n}").alias("rec_key")) for n in (1, 2)]
    if dups.self_check:
        keys = [keys[0].unionByName(keys[1])] * 2
    one = _raw_records(dups.left_input, schema, keys[0], 1)
    two = _raw_records(dups.right_input, schema, keys[1], 2)
    shown = links.join(one, ["content_1", "key_1"]).join(two, ["content_2", "key_2"])
    out = [F.col("key_1").alias("rec_key_1"), F.col("key_2").alias("rec_key_2")]
    for f in schema.by_pos:
        out += [F.col(f"record_{n}.{f.name}").alias(f"{f.name}_{n}") for n in (1, 2)]
        if f.kind == "index":
            score, status = F.col("similarity"), F.lit(MATCH)
        elif f in schema.compared:
            score, status = F.col(f"score_{f.name}"), F.col(f"status_{f.name}")
        else:
            score, status = F.lit(None).cast("double"), F.lit(NOT_COMPARED)
        out += [score.alias(f"{f.name}_score"), status.alias(f"{f.name}_status")]
    return shown.select(*out, "similarity", F.col("matched_fields").cast("int").alias("matched_fields"))


def _reach(dups: Duplicates, side: str) -> DataFrame:
    """Per content of one side, the smallest and largest key among its partners."""
    own, other = ("content_1", "content_2") if side == "left" else ("content_2", "content_1")
    partners = dups.right if side == "left" else dups.left
    ends = partners.select(F.col("content_id").alias(other), F.col("first_key").alias("low"), F.col("last_key").alias("high"))
    return dups.pairs.select(own, other).join(ends, other).select(F.col(own).alias("content_id"), "low", "high")


def duplicate_keys(dups: Duplicates) -> DataFrame:
    """Keys of every record that has a duplicate, on either side."""
    out = None
    jobs = [("left", dups.left_rows), ("right", dups.right_rows)]
    for side, rows in jobs[:1] if dups.self_check else jobs:
        reach = _reach(dups, side)
        if dups.self_check:
            own = _self_copies(dups).select("content_id", F.col("first_key").alias("low"), F.col("last_key").alias("high"))
            reach = reach.unionByName(_reach(dups, "right")).unionByName(own)
        spans = reach.groupBy("content_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        # a record is a duplicate when some partner has another key
        keys = (
            rows.select("content_id", "rec_key")
            .join(spans, "content_id")
            .where("low <> rec_key OR high <> rec_key")
            .select("rec_key")
        )
        out = keys if out is None else out.unionByName(keys)
    return out.distinct()


def group_members(dups: Duplicates) -> DataFrame:
    """(group, side, content_id, rec_key): members of certain groups. With the pairs of
    different contents this is the whole result: all members of a group, and all records
    of a content that ``copies_are_duplicates``, are duplicates of each other."""
    out = None
    for side, (classes, rows) in enumerate([(dups.left, dups.left_rows), (dups.right, dups.right_rows)]):
        own = certain_rows(classes, dups.schema).select("group", "content_id")
        own = own.join(_keys(rows), "content_id").select("group", F.lit(side + 1).alias("side"), "content_id", "rec_key")
        out = own if out is None else out.unionByName(own)
        if dups.self_check:
            break
    return out


def _top_keys(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """The ``most`` smallest record keys of each group of rows."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy("rec_key"))
    return rows.withColumn("_n", rank).where(F.col("_n") <= most).drop("_n")


def nearest_links(dups: Duplicates, quantity: int) -> DataFrame:
    """Links of each left record to its ``quantity`` most similar duplicates on the right,
    smaller keys first, with ``rank``. Complete: members of certain groups count as well.

    Groups that include the index field have similarity 1, so more than ``quantity`` of a
    group's keys (one may be the record's own) can't matter; they are ranked before they
    meet the records.
    """
    schema, most = dups.schema, quantity + 1
    keys = _keys(dups.right_rows)
    titled = certain_rows(dups.right, schema, True).select("group", "content_id").join(keys, "content_id")
    titled = _top_keys(titled, ["group"], most).select("group", F.col("content_id").alias("content_2")).distinct()
    own = certain_rows(dups.left, schema, True).select("group", F.col("content_id").alias("content_1"))
    implied = own.join(titled, "group").select("content_1", "content_2")
    loose = certain_rows(dups.right, schema, False).select("group", F.col("content_id").alias("content_2"))
    own = certain_rows(dups.left, schema, False).select("group", F.col("content_id").alias("content_1"))
    implied = implied.unionByName(own.join(loose, "group").select("content_1", "content_2")).distinct()
    implied = implied.join(dups.pairs.select("content_1", "content_2"), ["content_1", "content_2"], "left_anti")
    scores = _scores(schema)
    scored = verify_pairs(stage(implied, "implied"), dups.left, dups.right, schema)
    pairs = dups.pairs.select("content_1", "content_2", *scores).unionByName(scored.select("content_1", "content_2", *scores))
    right = _top_keys(keys, ["content_id"], most)
    right = right.select(F.col("content_id").alias("content_2"), F.col("rec_key").alias("key_2"))
    left = _keys(dups.left_rows).select(F.col("content_id").alias("content_1"), F.col("rec_key").alias("key_1"))
    links = pairs.join(right, "content_2").join(left, "content_1").where("key_1 <> key_2")
    best = F.row_number().over(W.partitionBy("key_1", "key_2").orderBy(F.desc("similarity"), "content_1", "content_2"))
    links = links.withColumn("_best", best).where("_best = 1").drop("_best")
    rank = F.row_number().over(W.partitionBy("key_1").orderBy(F.desc("similarity"), "key_2"))
    return links.withColumn("rank", rank).where(F.col("rank") <= quantity).select(*_ENDS, *scores, "rank")


def _held(rows: DataFrame) -> DataFrame:
    """(content_id, rec_key, many): records by content, and whether their key is in several contents."""
    keys = _keys(rows)
    return keys.join(keys.groupBy("rec_key").agg((F.count("*") > 1).alias("many")), "rec_key")


def _in_groups(classes: DataFrame, held: DataFrame, schema: MatchSchema) -> DataFrame:
    """Records by each certain group of their content, with all its groups and those before this one."""
    groups = classes.select("content_id", certain_keys(schema).alias("groups"))
    every = groups.select("content_id", "groups", F.posexplode("groups").alias("place", "group"))
    every = every.select("group", "content_id", "groups", F.slice("groups", F.lit(1), F.col("place")).alias("before"))
    return every.join(held, "content_id").withColumn("own", F.lit(False))


def _met(one: DataFrame, two: DataFrame, same: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of records of one group, each two contents in their first common group only. Large groups are dealt
    out in parts, each of one side with each of the other, so that pairs are made where they are returned."""
    count = lambda rows, n: rows.groupBy("group").agg(F.count("*").alias(n))
    sizes = count(one, "l").join(count(two, "r"), "group")
    sizes = stage(sizes.where("l > 1") if same else sizes, "groups")
    tasks = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = ["group", "l_part", "r_part"]

    def dealt(side: DataFrame, own: str, other: str, name: str) -> DataFrame:
        parts = lambda n: F.ceil(F.col(n) / F.lit(PART)).cast("int")
        place = F.pmod(F.xxhash64("content_id", "rec_key"), parts(own)).cast("int").alias(f"{own}_part")
        every = F.explode(F.sequence(F.lit(0), parts(other) - 1)).alias(f"{other}_part")
        rows = side.join(sizes, "group").select(*side.columns, place, every)
        # a pair costs far more than its bytes: tasks stay many
        return rows.repartition(tasks, *part).alias(name)

    def pairs(x: DataFrame, y: DataFrame) -> DataFrame:
        a, b = dealt(x, "l", "r", "a"), dealt(y, "r", "l", "b")
        new = (F.size("a.before") == 0) | ~F.arrays_overlap("a.before", "b.groups")
        if same:
            new = F.when(F.col("a.own"), F.col("a.rec_key") < F.col("b.rec_key")).otherwise(
                (F.col("a.content_id") < F.col("b.content_id")) & new
            )
        on = new & (F.col("a.rec_key") != F.col("b.rec_key"))
        for c in part:
            on = on & (F.col(f"a.{c}") == F.col(f"b.{c}"))
        return a.join(b.hint("merge"), on).select(F.col("a.rec_key").alias("a"), F.col("b.rec_key").alias("b"))

    return _each_once(one, two, pairs)


def _each_once(one: DataFrame, two: DataFrame, pairs: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Pairs of keys that have one content each, and the rest, which may come again by another content."""
    plain = [rows.where(~F.col("many")) for rows in (one, two)]
    more = pairs(one.where("many"), two).unionByName(pairs(plain[0], two.where("many")))
    return pairs(*plain), more


def expand_pairs(dups: Duplicates) -> DataFrame:
    """Every pair of record keys the factored result stands for, those inside certain
    groups included. The output holds one row per pair, so a large group makes it large
    by nature; only pairs of keys with several contents are stored on the way to it."""
    schema, same = dups.schema, dups.self_check
    held = [stage(_held(dups.left_rows), "held")]
    held.append(held[0] if same else stage(_held(dups.right_rows), "held"))
    found = []
    linked = dups.pairs.select("content_1", "content_2")
    if schema.certain_sets():
        sides = [_in_groups(dups.left, held[0], schema), _in_groups(dups.right, held[1], schema)]
        if same:
            # the records of a content are a group of their own
            none = F.array().cast("array<binary>")
            copies = _self_copies(dups).select("content_id").join(held[0], "content_id")
            copies = copies.select(F.col("content_id").alias("group"), "content_id", none.alias("groups"), none.alias("before"), "rec_key", "many", F.lit(True).alias("own"))
            sides = [stage(sides[0].unionByName(copies), "members")] * 2
        found.append(_met(*sides, same))
        for n, classes in ((1, dups.left), (2, dups.right)):
            groups = classes.select(F.col("content_id").alias(f"content_{n}"), certain_keys(schema).alias(f"groups_{n}"))
            linked = linked.join(groups, f"content_{n}")
        linked = linked.where(~F.arrays_overlap("groups_1", "groups_2")).select("content_1", "content_2")
    elif same:
        own = F.col("content_id")
        linked = linked.unionByName(_self_copies(dups).select(own.alias("content_1"), own.alias("content_2")))

    def joined(x: DataFrame, y: DataFrame) -> DataFrame:
        left = x.select(F.col("content_id").alias("content_1"), F.col("rec_key").alias("a"))
        right = y.select(F.col("content_id").alias("content_2"), F.col("rec_key").alias("b"))
        pairs = linked.join(left, "content_1").join(right, "content_2")
        return pairs.where("a < b OR content_1 <> content_2 AND a <> b" if same else "a <> b").select("a", "b")

    found.append(_each_once(*held, joined))
    if same:
        ends = F.least("a", "b").alias("rec_key_1"), F.greatest("a", "b").alias("rec_key_2")
    else:
        ends = F.col("a").alias("rec_key_1"), F.col("b").alias("rec_key_2")
    out = again = None
    for once, more in found:
        out = once if out is None else out.unionByName(once)
        again = more if again is None else again.unionByName(more)
    return out.select(*ends).unionByName(again.select(*ends).distinct())
