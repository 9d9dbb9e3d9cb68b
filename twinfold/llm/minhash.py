"""Near-duplicate documents: an LSH forest over MinHash signatures, confirmed on full shingle sets.

Documents with the same set of shingles are one class. A class has ``VALUES`` MinHash values, and each of ``TREES``
orders starts at another place of them. Every order is sorted, so that a class lies next to those with which it has
the longest common prefix: the prefix is long where the order is crowded and short where it is not. Neighbours with at
least ``DEPTH`` values in common are candidates. Classes with the same first ``DEPTH`` values are a region of that
order. In regions of more than ``REGION`` classes the most central class is a candidate for all of them as well, for
copies of one original that are all near to it but not to each other; it is found by agreement with a few pivots, in
one pass. Candidates are confirmed by the exact intersection of both sets.

Neighbours are few, so links may be missing. Last, therefore, all pairs of a region that lie in different components
and agree in enough values are decided: what is outside the region's largest component meets the whole region, in
blocks of bounded weight. A block first finds by signatures which of its classes have such pairs, then gets the sets
of these and returns links that join its components; no pair leaves it. A pair is decided in the first order only
that has it in one region.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import Bytes, Rolling, batches, kept_struct, mixed, stage, stage_by, with_kept
from twinfold.llm.graph import components

WORDS = 5
#: Sets are alike where 100 * intersection >= ALIKE * union.
ALIKE = 85
VALUES = 64
TREES = 16
#: Values that a region agrees on, and the step from order to order.
DEPTH = 4
REGION = 64
#: Pairs are confirmed if their share of agreeing MinHash values is at most so many standard errors below the threshold.
ERRORS = 5
PIVOTS = 8
CHUNK = 256
#: Weight of a block on either side: a class weighs 1, and 1 more for so many shingles.
BLOCK = 512
HEAVY = 2048

_WORD = Rolling(31)
_DRAW = np.random.default_rng(32)
_TIMES = _DRAW.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _DRAW.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_PLACE = mixed(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingle_sets(texts: Bytes) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    n = len(texts)
    if not len(texts.data):
        return [np.empty(0, np.uint64)] * n
    data = _LOWER[texts.data]
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[texts.starts] = True
    begins = np.nonzero(inside & (first[:-1] | ~np.append(False, inside[:-1])))[0]
    stops = np.nonzero(inside & (first[1:] | ~np.append(inside[1:], False)))[0] + 1
    if first[-1]:  # an empty text after the last byte
        first[-1] = False
    if len(begins) == 0:
        return [np.empty(0, np.uint64)] * n
    word = mixed(_WORD.windows_between(data, begins, stops) + (stops - begins).astype(np.uint64))
    full = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        full += word[k : k + len(full)] * _PLACE[k]
    full = mixed(full)
    lo, hi = np.searchsorted(begins, texts.starts), np.searchsorted(begins, texts.ends)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b - a >= WORDS:
            out.append(np.unique(full[a : b - WORDS + 1]))
        elif b > a:
            out.append(mixed((word[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (32 bits) of sets that are not empty."""
    out = np.empty((len(sets), VALUES), np.uint32)
    if sets:
        flat = np.concatenate(sets)
        starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
        for j in range(VALUES):
            out[:, j] = np.minimum.reduceat(((flat ^ _FLIP[j]) * _TIMES[j]) >> np.uint64(32), starts)
    return out


def _sketch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 2 << 20):
        sets = shingle_sets(Bytes(batch.column("text")))
        some = [i for i, x in enumerate(sets) if len(x)]
        values = signatures([sets[i] for i in some])
        sums = np.zeros((2, len(sets)), np.uint64)
        sign: list[bytes | None] = [None] * len(sets)
        for k, i in enumerate(some):
            sums[0, i], sums[1, i] = sets[i].sum(), mixed(sets[i]).sum()
            sign[i] = values[k].astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.array(sign, pa.binary()),
            ],
            ["row", "n_shingles", "sum1", "sum2", "sign"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    """MinHash values of a column of signatures."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, VALUES)


@dataclass(frozen=True)
class Forest:
    """Threshold in hundredths, and the depth at which its regions begin."""

    alike: int = ALIKE
    depth: int = DEPTH

    @property
    def likely(self) -> int:
        """Agreeing values that a pair needs to be confirmed."""
        share = self.alike / 100
        return math.floor((share - ERRORS * math.sqrt(share * (1 - share) / VALUES)) * VALUES)


def _prefix(tree, depth: int):
    """Key of a region: tree and first ``depth`` values of its order."""
    twice = F.concat("sign", "sign")
    return F.xxhash64(tree, F.lit(depth), twice.substr(tree * (4 * DEPTH) + 1, F.lit(4 * depth)))


def _orders(classes: DataFrame, depth: int) -> DataFrame:
    """The classes of all regions with more than one (key, size, tree, id, sign, weight)."""
    keys = classes.select("id", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sign")
    keys = keys.select("id", "tree", _prefix(F.col("tree"), depth).alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    rows = stage(keys.join(sizes, "key"), "regions")
    return stage(rows.join(classes.select("id", "sign", "weight"), "id"), "orders")


def _neighbours(likely: int, depth: int):
    """Rows (tree, id, order) as they are sorted to pairs that lie next to each other."""

    def neighbours(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in rows:
            if not batch.num_rows:
                continue
            own = (batch.column("tree").to_numpy(), batch.column("id").to_numpy(), _matrix(batch.column("order")))
            tree, ids, values = own if before is None else map(np.concatenate, zip(before, own))
            before = tree[-1:], ids[-1:], values[-1:]
            same = values[1:] == values[:-1]
            near = (tree[1:] == tree[:-1]) & same[:, :depth].all(axis=1) & (same.sum(axis=1) >= likely)
            at = np.nonzero(near)[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[at + 1])], ["hub", "other"])

    return neighbours


def _neighbour_pairs(orders: DataFrame, forest: Forest) -> DataFrame:
    """Pairs with the longest common prefix in each sorted order.

    Two that a border of partitions parts are no pair; another order or the last step finds what that costs.
    """
    start = F.col("tree") * (4 * DEPTH) + 1
    rows = orders.select("tree", "id", F.concat("sign", "sign").substr(start, F.lit(4 * VALUES)).alias("order"))
    rows = rows.repartitionByRange("tree", "order", "id").sortWithinPartitions("tree", "order", "id")
    return rows.mapInArrow(_neighbours(forest.likely, forest.depth), "hub long, other long")


def _central(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Agreement of each class with the pivots of its region."""
    for batch in batches(rows, 8 << 20):
        signs, total = _matrix(batch.column("sign")), np.zeros(batch.num_rows, np.int32)
        pivots = batch.column("pivots").to_pylist()
        known: dict[bytes, np.ndarray] = {}
        for i, some in enumerate(pivots):
            for p in some:
                if p not in known:
                    known[p] = np.frombuffer(p, "<u4")
                total[i] += (signs[i] == known[p]).sum()
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("id"), batch.column("sign"), pa.array(total)], ["key", "id", "sign", "near"]
        )


def _near_hub(likely: int):
    def near_hub(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 8 << 20):
            near = (_matrix(batch.column("sign")) == _matrix(batch.column("hub_sign"))).sum(axis=1) >= likely
            keep = pa.array(np.nonzero(near)[0])
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("hub", "other")], ["hub", "other"])

    return near_hub


def _hub_pairs(wide: DataFrame, likely: int) -> DataFrame:
    """Pairs of the classes of large regions with the most central one of each."""
    some = wide.groupBy("key", F.expr(f"pmod(xxhash64(id), {PIVOTS})").alias("part")).agg(F.max_by("sign", "id").alias("sign"))
    pivots = some.groupBy("key").agg(F.collect_list("sign").alias("pivots"))
    near = wide.join(pivots, "key").mapInArrow(_central, "key long, id long, sign binary, near int")
    near = stage(near, "central")
    hubs = near.groupBy("key").agg(F.max_by(F.struct("id", "sign"), F.struct("near", "id")).alias("top"))
    hubs = hubs.select("key", F.col("top.id").alias("hub"), F.col("top.sign").alias("hub_sign"))
    both = near.join(hubs, "key").filter("id <> hub").select("hub", "hub_sign", F.col("id").alias("other"), "sign")
    return both.mapInArrow(_near_hub(likely), "hub long, other long")


def _runs(rows: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of the rows with equal values in a column that rows are sorted by."""
    held: list[pa.RecordBatch] = []
    for batch in rows:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        if held and held[-1].column(column)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for end in (np.nonzero(values[1:] != values[:-1])[0] + 1).tolist():
            yield pa.Table.from_batches([*held, batch.slice(start, end - start)])
            held, start = [], end
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _open_pairs(block: pa.Table, likely: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of a block to decide, those that agree most first."""
    left, outside, ids, group = (block[c].to_numpy() for c in ("left", "outside", "id", "group"))
    signs = _matrix(block["sign"])
    x, y = np.nonzero(left)[0], np.nonzero(~left)[0]
    agree = np.empty((len(x), len(y)), np.int16)
    for k, i in enumerate(x):
        agree[k] = (signs[y] == signs[i]).sum(axis=1)
    # two that are both outside the largest component meet twice
    open_ = (agree >= likely) & (group[x][:, None] != group[y]) & (~outside[y] | (ids[x][:, None] < ids[y]))
    i, j = np.nonzero(open_)
    agree, i, j = agree[i, j], x[i], y[j]
    seen = np.zeros(len(i), bool)
    for tree in range(int(block["tree"][0].as_py()) if len(i) else 0):
        some = (tree * DEPTH + np.arange(depth)) % VALUES
        seen |= (signs[np.ix_(i, some)] == signs[np.ix_(j, some)]).all(axis=1)
    order = np.argsort(-agree, kind="stable")
    order = order[~seen[order]]
    return i[order], j[order]


def _taking_part(likely: int, depth: int):
    def taking_part(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(rows, "block"):
            some = np.unique(np.concatenate(_open_pairs(block, likely, depth)))
            if len(some):
                yield from block.take(pa.array(some)).combine_chunks().to_batches()

    return taking_part


def _joining(least: int, likely: int, depth: int):
    def joining(block: pa.Table, sets: pa.Table) -> pa.Table:
        a, b, top = [], [], {}
        items = {i: np.frombuffer(x, "<u8") for i, x in zip(sets["id"].to_pylist(), sets["items"].to_pylist())}

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        if block.num_rows:
            ids, group = block["id"].to_pylist(), block["group"].to_pylist()
            for i, j in zip(*(x.tolist() for x in _open_pairs(block, likely, depth))):
                x, y = root(group[i]), root(group[j])
                if x != y and alike(items[ids[i]], items[ids[j]], least):
                    top[x] = y
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return joining


def _crossing(orders: DataFrame, groups: DataFrame, texts: DataFrame, classes: DataFrame, forest: Forest) -> DataFrame:
    """Links (a, b) that join different components of a region, after all of its pairs between these were decided."""
    rows = orders.join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    rows = rows.select("key", "tree", "id", "sign", "weight", F.coalesce("component", "id").alias("group"))
    sizes = rows.groupBy("key", "group").agg(F.sum("weight").alias("weight"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("weight", "group")).alias("top"), F.sum("weight").alias("all"))
    number = lambda weight: F.ceil(weight / BLOCK).cast("int")
    sizes = sizes.filter(F.col("all") > F.col("top.weight")).select(
        "key", F.col("top.group").alias("main"), number(F.col("all") - F.col("top.weight")).alias("parts"),
        number(F.col("all")).alias("all_parts"),
    )
    rows = stage(rows.join(sizes, "key").withColumn("outside", F.col("group") != F.col("main")), "parted")
    part = lambda n: F.expr(f"cast(pmod(xxhash64(id), {n}) as int)")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.filter("outside").withColumn("left", F.lit(True)).withColumn("i", part("parts")).withColumn("j", every("all_parts"))
    right = rows.withColumn("left", F.lit(False)).withColumn("j", part("all_parts")).withColumn("i", every("parts"))
    columns = [F.xxhash64("key", "i", "j").alias("block"), "tree", "id", "sign", "group", "left", "outside"]
    both = left.select(*columns).union(right.select(*columns))
    both = both.repartition("block").sortWithinPartitions("block")
    some = stage(both.mapInArrow(_taking_part(forest.likely, forest.depth), both.schema), "open")
    ends = some.groupBy("id").agg(F.collect_set("block").alias("chunks")).join(classes.select("id", "row"), "id")
    sets = texts.join(ends.hint("shuffle_hash"), "row").select("text", "id", "chunks")
    sets = sets.mapInArrow(_sets, "chunk long, id long, items binary")
    found = some.groupBy("block").cogroup(sets.groupBy("chunk"))
    return stage(found.applyInArrow(_joining(forest.alike, forest.likely, forest.depth), "a long, b long"), "crossing")


def _sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 2 << 20):
        sets = shingle_sets(Bytes(batch.column("text")))
        chunks = batch.column("chunks").to_pylist()
        which = [i for i, some in enumerate(chunks) for _ in some]
        raw = [x.astype("<u8").tobytes() for x in sets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for some in chunks for c in some], pa.int64()),
                batch.column("id").take(pa.array(which, pa.int64())),
                pa.array([raw[i] for i in which], pa.binary()),
            ],
            ["chunk", "id", "items"],
        )


def alike(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= least * (len(a) + len(b) - common)


def _confirm(least: int):
    def confirm(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        items = {i: np.frombuffer(x, "<u8") for i, x in zip(sets["id"], sets["items"])}
        linked = [alike(items[a], items[b], least) for a, b in zip(pairs["hub"], pairs["other"])]
        return pairs.assign(linked=linked)[["hub", "other", "linked"]]

    return confirm


def _confirmed(pairs: DataFrame, texts: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Compare the full sets of ``pairs`` (hub, other): adds linked.

    Sets travel to chunks of pairs. A pair goes to the chunk of its least neighbour two steps away, so the sets of a
    group are sent about once; a chunk with many pairs is split by their other side.
    """
    n = max(1, pairs.count() // CHUNK)
    both = pairs.union(pairs.select("other", "hub")).toDF("id", "next")
    home = stage(both.groupBy("id").agg(F.least(F.min("next"), F.first("id")).alias("home")), "homes")
    far = both.join(home.withColumnRenamed("id", "next"), "next").groupBy("id").agg(F.min("home").alias("far"))
    home = home.join(far, "id").select("id", F.least("home", "far").alias("home"))
    placed = pairs.join(home.withColumnRenamed("id", "other"), "other")
    sizes = placed.groupBy("home").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("split"))
    chunk = F.expr(f"pmod(xxhash64(home, pmod(xxhash64(other), split)), {n})")
    placed = stage(placed.join(sizes, "home").select("hub", "other", chunk.alias("chunk")), "placed")
    ends = placed.select("chunk", F.explode(F.array("hub", "other")).alias("id")).distinct()
    ends = ends.groupBy("id").agg(F.collect_list("chunk").alias("chunks"))
    ends = ends.join(classes.select("id", "row"), "id")
    sets = texts.join(ends.hint("shuffle_hash"), "row").select("text", "id", "chunks")
    sets = sets.mapInArrow(_sets, "chunk long, id long, items binary")
    found = placed.groupBy("chunk").cogroup(sets.groupBy("chunk"))
    return stage(found.applyInPandas(_confirm(least), "hub long, other long, linked boolean"), "confirmed")


def near_duplicates(texts: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """(row, n_shingles, component) of staged ``texts`` (row, text): the component is the least row of its group.

    A text without words has no shingles and is a component of its own.
    """
    sketch = "row long, n_shingles long, sum1 long, sum2 long, sign binary"
    sketch = stage(texts.select("row", "text").mapInArrow(_sketch, sketch), "sketch")
    id_ = F.xxhash64("sum1", "sum2", "n_shingles").alias("id")
    weight = F.expr(f"1 + n_shingles div {HEAVY}").alias("weight")
    some = sketch.filter("n_shingles > 0").select(id_, "row", "sign", weight)
    classes = some.groupBy("id").agg(F.min("row").alias("row"), F.max("sign").alias("sign"), F.max("weight").alias("weight"))
    classes = stage(classes, "classes")
    orders = _orders(classes, forest.depth)
    pairs = _neighbour_pairs(orders, forest)
    pairs = pairs.union(_hub_pairs(orders.filter(F.col("size") > REGION).select("key", "id", "sign"), forest.likely))
    # the end that was the hub stays the hub: chunks of pairs are made around it
    least, most = F.least("hub", "other").alias("x"), F.greatest("hub", "other").alias("y")
    pairs = pairs.groupBy(least, most).agg(F.min("hub").alias("hub"))
    pairs = pairs.select("hub", F.when(F.col("hub") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("other"))
    tried = _confirmed(stage(pairs, "pairs"), texts, classes, forest.alike)
    links = tried.filter("linked").select(F.col("hub").alias("a"), F.col("other").alias("b"))
    groups = components(links)
    more = _crossing(orders, groups, texts, classes, forest)
    if not more.isEmpty():
        groups = components(links.union(more))
    whole = sketch.select("row", "n_shingles", F.when(F.col("n_shingles") > 0, id_).alias("id"))
    whole = whole.join(groups.withColumnRenamed("node", "id"), "id", "left")
    whole = whole.withColumn("group", F.coalesce("component", "id"))
    return whole.select("row", "n_shingles", "group")


def link_documents(docs: DataFrame, *keep: str, forest: Forest = Forest()) -> DataFrame:
    """Shingle count and component of each row of ``docs`` (doc_id, text and the columns ``keep``).

    Returns ``keep``, n_shingles, component_id (least doc_id that links lead to, its own included; null ids are passed
    over), kept (doc_id is component_id) and first (one row of each component: least doc_id, null last, then any).
    Rows without words are linked with nothing. Equal texts are linked, whatever their ids.
    """
    others = tuple(c for c in keep if c not in ("doc_id", "text"))
    rows, other = with_kept(docs, ["doc_id", "text"], others), kept_struct(others)
    row = F.monotonically_increasing_id().alias("row")
    texts = stage_by(rows.select(row, F.col("doc_id").alias("doc"), "text", other.alias("other")), "row", "texts")
    found = stage(near_duplicates(texts, forest), "found")
    # groups are settled on ids alone: texts stay where they are, and a large group is a number of small rows
    ids = stage(texts.select("row", "doc").join(found, "row"), "ids")
    firsts = ids.filter("group is not null").groupBy("group").agg(
        F.min("doc").alias("least"), F.min(F.struct(F.col("doc").isNull(), "doc", "row"))["row"].alias("head")
    )
    ids = ids.join(stage(firsts, "firsts"), "group", "left")
    none = F.col("group").isNull()
    component = F.when(none, F.col("doc")).otherwise(F.col("least"))
    ids = ids.select(
        "row",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
        (none | (F.col("head") == F.col("row"))).alias("first"),
    )
    both = texts.join(stage(ids, "decided").hint("shuffle_hash"), "row")
    own = {"doc_id": "doc", "text": "text"}
    kept = [F.col(own.get(c) or f"other.kept{others.index(c)}").alias(f"kept{i}") for i, c in enumerate(keep)]
    out = both.select(*kept, "n_shingles", "component_id", "kept", "first")
    return out.toDF(*keep, "n_shingles", "component_id", "kept", "first")
