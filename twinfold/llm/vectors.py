"""Near-duplicate vectors by NN-descent.

Each vector starts with the nearest of a few random-projection leaves. A round joins the lists over shared
neighbours: who is on a list, or has it on its own, is compared with all others there, and every vector keeps its
nearest. Lists whose last entry is still above the threshold are saturated and grow. Whatever is compared and reaches
the threshold joins its ends' components, also where it is pushed out of a full list. Vectors whose lists were full of
links may have others that no list has room for: components are searched for links between such vectors exactly, in
blocks, where the angle between their centres leaves room for one.

The components are audited against brute force, over a sample that grows with the table and adds nothing to them; below
``RECALL`` there are new leaves, and after ``SEEDS`` of these all vectors are compared, in blocks.

Every link has both ends in one component. So the links of each vector are then
counted exactly inside its component, which also serves those whose neighbours outnumber any list. Angles are
metric: all members within half the threshold's angle of their component's centre are linked with each other and are
only counted; the others are compared with the component in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.llm.common import kept_struct, mixed, stage, with_kept
from twinfold.llm.graph import components

THRESHOLD = 0.9
LIST = 8
LONGEST = 32
TREES = 6
LEAF = 128
ROUNDS = 6
#: A round that changes a smaller part of all list entries is the last.
SETTLED = 0.01
#: Vectors of the audit: at least so many of all and of those that are likely linked, and so many times the root of the table.
AUDIT = 256
AUDIT_ROOTS = 4
#: A vector whose nearest one is less than this below the threshold is likely linked.
CLOSE = 0.1
RECALL = 0.98
SEEDS = 4
#: Vectors that are compared with the whole table in one pass.
PASS = 4096
BLOCK = 512


def _unit(raw: pa.Array) -> np.ndarray:
    """Rows of equally long binary vectors as a matrix of doubles of length 1."""
    if isinstance(raw, pa.ChunkedArray):
        raw = raw.combine_chunks()
    rows = raw.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.empty((0, 0))


def _usable(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1 in double precision; null where a vector can't be compared."""
    for batch in rows:
        out, dims = [], []
        for v in batch.column("vector").to_pylist():
            x = None if not v or any(c is None for c in v) else np.array(v, np.float64)
            # halved exponents first, so that no square overflows or vanishes
            ok = x is not None and np.isfinite(x).all() and np.abs(x).max() > 0
            if ok:
                x = x / np.abs(x).max()
                x = x / math.sqrt(float(x @ x))
            out.append(x.astype("<f8").tobytes() if ok else None)
            dims.append(len(x) if ok else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc"), pa.array(out, pa.binary()), pa.array(dims, pa.int32())],
            ["row", "doc", "unit", "dims"],
        )


def _leaves(seed: int, bits: int):
    """Codes of each vector in ``TREES`` random projection trees."""

    def leaves(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            dims = batch.column("dims").to_numpy(zero_copy_only=False)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                which = np.nonzero(dims == d)[0]
                x = _unit(batch.column("unit").take(pa.array(which)))
                for tree in range(TREES):
                    planes = np.random.default_rng([seed, tree, d]).standard_normal((d, bits))
                    code = ((x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))).astype(np.uint64)
                    code = mixed(code + np.uint64(tree * 1_000_003 + d * 7919 + seed))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(code.view(np.int64)), pa.array(node[which])], ["leaf", "node"]
                    )

    return leaves


def _joined(ids: np.ndarray, linked: np.ndarray) -> tuple:
    """Pairs that join what the links of a group join: each member with the first of its component."""
    n = len(ids)
    first = np.arange(n)
    while True:
        new = np.minimum(first, np.where(linked, first[None, :], n).min(axis=1))
        new = new[new]
        if (new == first).all():
            break
        first = new
    some = first != np.arange(n)
    return ids[some], ids[first[some]], np.full(int(some.sum()), np.nan)


def _nearest(ids: np.ndarray, cos: np.ndarray, most: np.ndarray, floor: np.ndarray) -> tuple:
    """For each row the ids of its nearest others above its floor: (of, other, cosine)."""
    take = min(int(most.max()), len(ids) - 1)
    order = np.argpartition(-cos, take - 1, axis=1)[:, :take] if take < len(ids) - 1 else np.argsort(-cos, axis=1)[:, :take]
    of = np.repeat(np.arange(len(ids)), order.shape[1])
    other = order.ravel()
    value = cos[of, other]
    keep = value > floor[of]
    return ids[of[keep]], ids[other[keep]], value[keep]


def _join(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the members of each group with each other: candidates (node, near, cos), and pairs in one component
    with null for cos."""
    for batch in rows:
        found = []
        for group in batch.column("members").to_pylist():
            seen = {m["node"]: m for m in group}
            by_dims: dict[int, list[dict]] = {}
            for m in seen.values():
                by_dims.setdefault(len(m["unit"]), []).append(m)
            for some in by_dims.values():
                if len(some) > 1:
                    ids = np.array([m["node"] for m in some])
                    x = np.frombuffer(b"".join(m["unit"] for m in some), "<f8").reshape(len(some), -1)
                    floor, most = np.array([m["floor"] for m in some]), np.array([m["most"] for m in some])
                    cos = x @ x.T
                    np.fill_diagonal(cos, -2.0)
                    found.append(_nearest(ids, cos, most, floor))
                    linked = cos >= THRESHOLD
                    if linked.any():
                        found.append(_joined(ids, linked))
        if found:
            node, near, cos = (np.concatenate(c) for c in zip(*found))
            cos = pa.array(cos, from_pandas=True)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(near), cos], ["node", "near", "cos"])


_PAIR = "node long, near long, cos double"


def _top(pairs: DataFrame, most: DataFrame) -> DataFrame:
    """Lists (node, most, list of (cos, near) with the nearest first) from candidate pairs."""
    pairs = pairs.groupBy("node", "near").agg(F.max("cos").alias("cos"))
    lists = pairs.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("cos", "near")), asc=False).alias("list"))
    return lists.join(most, "node").select("node", "most", F.slice("list", 1, F.col("most")).alias("list"))


def _start(nodes: DataFrame, seed: int, count: int) -> DataFrame:
    """Candidates from the leaves of random projection trees; a full leaf is dealt out by chance."""
    bits = max(1, math.ceil(math.log2(max(2, count / LEAF))))
    codes = stage(nodes.select("node", "unit", "dims").mapInArrow(_leaves(seed, bits), "leaf long, node long"), "leaves")
    sizes = codes.groupBy("leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("split"))
    part = F.xxhash64("leaf", F.expr(f"pmod(xxhash64(node, {seed}), split)"))
    dealt = codes.join(sizes, "leaf").select(part.alias("leaf"), "node")
    member = F.struct("node", "unit", F.lit(-2.0).alias("floor"), F.lit(LIST).alias("most"))
    groups = dealt.join(nodes, "node").groupBy("leaf").agg(F.collect_list(member).alias("members"))
    return groups.select("members").mapInArrow(_join, _PAIR)


def _refine(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates from neighbours of neighbours that are nearer than the last entries of full lists."""
    ahead = lists.select("node", F.explode("list").alias("e")).select("node", F.col("e.near").alias("near"), F.col("e.cos").alias("cos"))
    # who has a node on its list, up to LIST of them: the nearest of each of LIST parts
    part = F.expr(f"pmod(xxhash64(node), {LIST})")
    back = ahead.groupBy("near", part.alias("part")).agg(F.max_by("node", "cos").alias("node"))
    around = ahead.select(F.col("node").alias("at"), F.col("near").alias("node"))
    around = around.union(back.select(F.col("near").alias("at"), "node")).distinct()
    full = F.size("list") >= F.col("most")
    floor = F.when(full, F.element_at("list", -1)["cos"]).otherwise(-2.0).alias("floor")
    state = lists.select("node", "most", floor).join(nodes.select("node", "unit"), "node")
    member = F.struct("node", "unit", "floor", "most")
    groups = around.join(state, "node").groupBy("at").agg(F.collect_list(member).alias("members"))
    return groups.select("members").mapInArrow(_join, _PAIR)


def neighbour_lists(nodes: DataFrame, seed: int, count: int, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nearest neighbours (node, most, list) of ``nodes`` (node, unit, dims) by NN-descent, and pairs (a, b) that join
    the ends of every compared pair at the threshold."""
    most = nodes.select("node", F.lit(LIST).alias("most")) if known is None else known.select("node", "most")
    flat = lambda x: x.select("node", F.explode("list").alias("e")).select("node", "e.near", "e.cos")
    near, joined = F.col("cos").isNotNull(), F.col("cos").isNull()
    found = stage(_start(nodes, seed, count), "leafed")
    edges, found = found.filter(joined), found.filter(near)
    lists = stage(_top(found if known is None else found.union(flat(known)), most), "lists")
    for _ in range(ROUNDS):
        new = stage(_refine(lists, nodes), "nearer")
        edges, new = edges.union(new.filter(joined)), new.filter(near)
        before = lists
        saturated = (F.size("list") >= F.col("most")) & (F.element_at("list", -1)["cos"] >= THRESHOLD)
        grown = F.when(saturated, F.least(F.col("most") * 2, F.lit(LONGEST))).otherwise(F.col("most"))
        most = before.select("node", grown.alias("most"))
        lists = stage(_top(flat(before).union(new), most), "lists")
        entries = flat(lists).join(flat(before), ["node", "near"], "left_anti").count()
        if entries <= SETTLED * LIST * count:
            break
    edges = edges.select(F.least("node", "near").alias("a"), F.greatest("node", "near").alias("b"))
    return lists, edges.distinct()


def _true_links(rows: Iterator[pa.RecordBatch], queries: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """Number of links between each query and the vectors of each component in a batch."""
    for batch in rows:
        dims = batch.column("dims").to_numpy(zero_copy_only=False)
        node = batch.column("node").to_numpy(zero_copy_only=False)
        group = batch.column("component").to_numpy(zero_copy_only=False)
        for d, (ids, own, x) in queries.items():
            same = np.nonzero(dims == d)[0]
            for at in range(0, len(same), BLOCK):
                which = same[at : at + BLOCK]
                q, r = np.nonzero(x @ _unit(batch.column("unit").take(pa.array(which))).T >= THRESHOLD)
                r = which[r]
                other = ids[q] != node[r]
                if other.any():
                    pairs, n = np.unique(np.stack([ids[q], own[q], group[r]])[:, other], axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, pairs), pa.array(n)], ["a", "of_a", "of_b", "n"])


def _against_all(placed: DataFrame, some: DataFrame) -> Iterator[DataFrame]:
    """Links (a, of_a, of_b, n) of the vectors ``some`` with all of ``placed`` (node, unit, dims, component), pass by pass."""
    passes = max(1, math.ceil(some.count() / PASS))
    for k in range(passes):
        mine = some.filter(F.expr(f"pmod(xxhash64(node, 6), {passes}) = {k}")).collect()
        queries = {}
        for d in {r.dims for r in mine}:
            own = [r for r in mine if r.dims == d]
            x = np.frombuffer(b"".join(bytes(r.unit) for r in own), "<f8").reshape(len(own), -1)
            queries[d] = np.array([r.node for r in own]), np.array([r.component for r in own]), x
        compare = lambda it, queries=queries: _true_links(it, queries)
        yield stage(placed.mapInArrow(compare, "a long, of_a long, of_b long, n long"), "compared")


def _placed(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Vectors with their components; one without links is a component of its own."""
    both = nodes.select("node", "unit", "dims").join(groups, "node", "left")
    return both.withColumn("component", F.coalesce("component", "node"))


def audit(nodes: DataFrame, groups: DataFrame, lists: DataFrame, count: int) -> float:
    """Share of the true links of a sample whose ends are in one component.

    The sample is drawn from all vectors and, as few of these may have links, from those that are likely linked; the
    lower share of both counts.
    """
    placed = stage(_placed(nodes, groups), "placed")
    close = lists.filter(F.element_at("list", 1)["cos"] >= THRESHOLD - CLOSE).select("node")
    size = max(AUDIT, math.ceil(AUDIT_ROOTS * math.sqrt(count)))
    recall = 1.0
    for rows, total in ((placed, count), (placed.join(close, "node", "left_semi"), close.count())):
        share = min(1.0, size / max(1, total))
        some = rows.filter(F.expr(f"pmod(xxhash64(node, 5), {1 << 30}) < {math.ceil(share * (1 << 30))}"))
        for links in _against_all(placed, stage(some, "asked")):
            n, good = links.agg(F.sum("n"), F.sum(F.when(F.col("of_a") == F.col("of_b"), F.col("n")).otherwise(0))).first()
            recall = min(recall, good / n if n else 1.0)
    return recall


def all_links(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) that join all components between which there is a link: each vector is compared with each."""
    placed = stage(_placed(nodes, groups), "placed")
    found = nodes.sparkSession.createDataFrame([], "a long, b long")
    for links in _against_all(placed, placed):
        found = found.union(links.filter("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    return found.distinct()


def _angles(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Angle of each vector with its component's centre."""
    for batch in rows:
        angle = []
        for unit, sums in zip(batch.column("unit").to_pylist(), batch.column("sums").to_pylist()):
            c = np.array(sums)
            length = math.sqrt(float(c @ c))
            cos = float(np.frombuffer(unit, "<f8") @ c) / length if length > 0 else -1.0
            angle.append(math.acos(max(-1.0, min(1.0, cos))))
        columns = [batch.column(c) for c in ("component", "dims", "sums")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(angle, pa.float64())], ["component", "dims", "sums", "angle"])


def _near_balls(block: pd.DataFrame) -> pd.DataFrame:
    """Pairs of components of two blocks that are near enough for a link."""
    left, right = block[block["left"]], block[~block["left"]]
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}).astype("int64")
    x, y = np.stack(left["sums"].to_list()), np.stack(right["sums"].to_list())
    x, y = (c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) for c in (x, y))
    angle = np.arccos(np.clip(x @ y.T, -1, 1)) - left["radius"].to_numpy()[:, None] - right["radius"].to_numpy()[None, :]
    a, b = left["component"].to_numpy(), right["component"].to_numpy()
    p, q = np.nonzero((angle <= math.acos(THRESHOLD) + 1e-6) & (a[:, None] != b[None, :]))
    return pd.DataFrame({"a": np.minimum(a[p], b[q]), "b": np.maximum(a[p], b[q])})


def _any_link(block: pd.DataFrame) -> pd.DataFrame:
    """One row if some vectors of the two sides are linked."""
    left, right = block[block["left"]], block[~block["left"]]
    x, y = (np.frombuffer(b"".join(s["unit"]), "<f8").reshape(len(s), -1) if len(s) else None for s in (left, right))
    linked = x is not None and y is not None and bool((x @ y.T >= THRESHOLD).any())
    return block[["a", "b"]].head(1 if linked else 0)


def crowded_links(nodes: DataFrame, groups: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs (a, b) that join all components with a link between two vectors whose first lists were full of links.

    Only the others' lists are sure to have room for a link. All pairs of such vectors are compared, but for those of
    components whose centres are too far apart for any link.
    """
    none = nodes.sparkSession.createDataFrame([], "a long, b long")
    crowded = lists.filter(F.size(F.filter("list", lambda e: e["cos"] >= THRESHOLD)) >= LIST).select("node")
    inside = stage(nodes.select("node", "unit", "dims").join(crowded, "node").join(groups, "node"), "crowded")
    balls = inside.join(_centres(inside), "component").mapInArrow(
        _angles, "component long, dims int, sums array<double>, angle double"
    )
    balls = balls.groupBy("component").agg(
        F.max("dims").alias("dims"), F.first("sums").alias("sums"), F.max("angle").alias("radius"), F.count("*").alias("size")
    )
    balls = stage(balls, "balls")
    count = balls.count()
    if count < 2:
        return none
    blocks = math.ceil(count / BLOCK)
    mine = F.expr(f"cast(pmod(xxhash64(component), {blocks}) as int)")
    columns = ["dims", "i", "j", "component", "sums", "radius", "left"]
    left = balls.withColumn("i", mine).withColumn("j", F.explode(F.sequence("i", F.lit(blocks - 1))))
    right = balls.withColumn("j", mine).withColumn("i", F.explode(F.sequence(F.lit(0), "j")))
    both = left.withColumn("left", F.lit(True)).select(*columns).union(right.withColumn("left", F.lit(False)).select(*columns))
    near = stage(both.groupBy("dims", "i", "j").applyInPandas(_near_balls, "a long, b long").distinct(), "near")
    if near.isEmpty():
        return none
    for side in ("a", "b"):
        part = F.ceil(F.col("size") / BLOCK).cast("int").alias(f"{side}_parts")
        near = near.join(balls.select(F.col("component").alias(side), part), side)
    near = stage(near, "near")
    sides = []
    for side, own, other in (("a", "p", "q"), ("b", "q", "p")):
        rows = inside.withColumnRenamed("component", side).join(near, side)
        rows = rows.withColumn(own, F.expr(f"cast(pmod(xxhash64(node), {side}_parts) as int)"))
        others = "b_parts" if side == "a" else "a_parts"
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        sides.append(rows.withColumn("left", F.lit(side == "a")).select("a", "b", "p", "q", "unit", "left"))
    found = sides[0].union(sides[1]).groupBy("a", "b", "p", "q").applyInPandas(_any_link, "a long, b long")
    return stage(found.distinct(), "between")


def _sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the vectors of each component in a task."""
    total: dict[int, np.ndarray] = {}
    for batch in rows:
        for c, u in zip(batch.column("component").to_pylist(), batch.column("unit").to_pylist()):
            x = np.frombuffer(u, "<f8")
            total[c] = total[c] + x if c in total else x
        if len(total) > 4096:
            yield _sum_rows(total)
            total = {}
    if total:
        yield _sum_rows(total)


def _sum_rows(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total)), pa.array([x.tolist() for x in total.values()], pa.list_(pa.float64()))], ["component", "sums"]
    )


def _core(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each vector lies within half the threshold's angle of its component's centre."""
    near = math.cos(math.acos(THRESHOLD) / 2) + 1e-9
    for batch in rows:
        core = []
        for unit, sums in zip(batch.column("unit").to_pylist(), batch.column("sums").to_pylist()):
            c = np.array(sums)
            length = math.sqrt(float(c @ c))
            core.append(bool(length > 0 and np.frombuffer(unit, "<f8") @ c >= near * length))
        columns = {n: batch.column(n) for n in ("component", "node", "weight", "unit", "size")}
        yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(core, pa.bool_())], [*columns, "core"])


def _count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between a block of vectors outside the core and a block of their component, seen from both."""
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "links": []}).astype("int64")
    x = np.frombuffer(b"".join(left["unit"]), "<f8").reshape(len(left), -1)
    y = np.frombuffer(b"".join(right["unit"]), "<f8").reshape(len(right), -1)
    linked = (x @ y.T >= THRESHOLD) & (left["node"].to_numpy()[:, None] != right["node"].to_numpy()[None, :])
    out = pd.DataFrame({"node": left["node"], "links": linked @ right["weight"].to_numpy()})
    core = right["core"].to_numpy()
    back = pd.DataFrame({"node": right["node"][core], "links": left["weight"].to_numpy() @ linked[:, core]})
    return pd.concat([out, back]).query("links > 0")


def _centres(inside: DataFrame) -> DataFrame:
    """(component, sums): sum of the vectors of each component of ``inside`` (component, unit)."""
    sums = inside.select("component", "unit").mapInArrow(_sums, "component long, sums array<double>")
    at = sums.select("component", F.posexplode("sums").alias("place", "x"))
    at = at.groupBy("component", "place").agg(F.sum("x").alias("x"))
    return at.groupBy("component").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda e: e["x"]).alias("sums")
    )


def count_links(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, links): exact number of vectors that each node (node, weight, unit) of a component is linked with."""
    inside = nodes.select("node", "weight", "unit").join(groups, "node")
    centre = _centres(inside)
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    both = inside.join(centre.join(sizes, "component"), "component")
    kind = "component long, node long, weight long, unit binary, size long, core boolean"
    both = stage(both.mapInArrow(_core, kind), "members")
    cores = both.filter("core").groupBy("component").agg(F.sum("weight").alias("all"))
    known = both.filter("core").select("component", "node", "weight").join(cores, "component")
    known = known.select("node", (F.col("all") - F.col("weight")).alias("links"))
    # vectors outside the core against their whole component, block by block
    outer = both.filter("not core")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.expr(f"pmod(xxhash64(node), cast(ceil(size / {BLOCK}) as int))")
    rest = outer.groupBy("component").agg(F.max(blocks).alias("blocks"))
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["component", "i", "j", "node", "weight", "unit", "core", "left"]
    left = outer.join(rest, "component").withColumn("i", mine).withColumn("j", spread).withColumn("left", F.lit(True))
    right = both.join(rest, "component").withColumn("j", mine).withColumn("i", spread).withColumn("left", F.lit(False))

    def compared(block: pd.DataFrame) -> pd.DataFrame:
        return _count(block[block["left"]], block[~block["left"]])

    pairs = left.select(*columns).union(right.select(*columns))
    more = pairs.groupBy("component", "i", "j").applyInPandas(compared, "node long, links long")
    return known.union(more).groupBy("node").agg(F.sum("links").alias("links"))


def link_vectors(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    """Links of each row of ``rows`` (vec_id, vector column and the columns ``keep``).

    Returns ``keep``, n_links (other rows linked directly), component_id (least vec_id that links lead to; null ids
    are passed over), kept (vec_id is component_id). Vectors that are null, empty or zero, or hold null or non-finite
    components, are linked with nothing, and so are vectors of different lengths. Equal vectors are linked.
    """
    flat = with_kept(rows, ["vec_id", vector], keep)
    doc = F.struct(F.col("vec_id"), kept_struct(keep).alias("kept"))
    flat = flat.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), F.col(vector).alias("vector"))
    flat = flat.withColumn("vector", F.col("vector").cast("array<double>"))
    kind = T.StructType([flat.schema["row"], flat.schema["doc"], *T.StructType.fromDDL("unit binary, dims int").fields])
    flat = stage(flat.mapInArrow(_usable, kind), "vectors")
    # equal vectors are one node, with the least row as its number
    some = flat.filter("unit is not null")
    nodes = some.groupBy("unit").agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.max("dims").alias("dims"))
    nodes = stage(nodes, "nodes")
    count, lists, seed = nodes.count(), None, 1
    links = nodes.sparkSession.createDataFrame([], "a long, b long")
    groups = nodes.sparkSession.createDataFrame([], "node long, component long")
    while count > 1:
        lists, near = neighbour_lists(nodes, seed, count, lists)
        links = stage(links.union(near).distinct(), "links")
        groups = components(links)
        more = crowded_links(nodes, groups, lists)
        if not more.isEmpty():
            links = links.union(more)
            groups = components(links)
        if audit(nodes, groups, lists, count) >= RECALL:
            break
        if seed >= SEEDS:
            groups = components(links.union(all_links(nodes, groups)))
            break
        seed += 1
    counted = count_links(nodes, groups) if count > 1 else groups.select("node", F.lit(0).cast("long").alias("links"))
    of = nodes.select("unit", "node", "weight").join(groups, "node", "left").join(counted, "node", "left")
    of = stage(of.select("unit", "node", "weight", F.coalesce("component", "node").alias("group"), "links"), "groups")
    full = flat.join(of, "unit", "left").select("doc", "row", "group", "links", "weight")
    full = stage(full, "linked")
    least = full.filter("group is not null").groupBy("group").agg(F.min("doc.vec_id").alias("least"))
    full = full.join(least, "group", "left")
    n = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("weight"), F.lit(1)) - 1
    id_ = F.col("doc.vec_id")
    component = F.when(F.col("group").isNull(), id_).otherwise(F.col("least"))
    out = full.select(
        *[F.col("doc.kept")[f"kept{i}"].alias(f"kept{i}") for i in range(len(keep))],
        n.alias("n_links"),
        component.alias("component_id"),
        id_.eqNullSafe(component).alias("kept"),
    )
    return out.toDF(*keep, "n_links", "component_id", "kept")
