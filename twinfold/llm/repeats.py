"""Repeated byte strings across documents, by prefix doubling over sampled positions.

A position p is repeated if the ``LENGTH`` bytes that start at p also start somewhere else, in any text.
Sorting every suffix would move each byte of the corpus many times over. Two steps keep it small without losing any:

* *Sampling.* Each string of ``LENGTH`` bytes chooses one anchor: the start of its ``SEED``-byte substring with the
  least hash (the last of equals). The choice depends on the string alone, so equal strings choose the same place.
  One anchor stands for a run of positions, about 85 on average; the distance from position to anchor is below
  ``SPAN`` = LENGTH - SEED + 1.
* *Growing ranks.* The run of an anchor is cut into cells of distances, ``WIDTHS`` wide. All strings of a cell share a
  core, and all of them lie in its hull. Cells are ranked by their core with Spark's shuffle: if no other has the
  same core, none of the cell's positions is repeated. If another one has the same hull as well, all of them are.
  What is left is cut into narrower cells, whose core is longer: SEED, 159, 194 and at last LENGTH bytes, where core
  and hull are the string itself. So each round ranks only the positions that are neither unique nor settled.

Core and hull have independent 64-bit hashes, and a cell counts as repeated only where both agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.llm.common import Bytes, Rolling, batches, mixed, pick, stage, stage_by

LENGTH = 200
WIDTHS = (168, 42, 7, 1)
SPAN = WIDTHS[0]
SEED = LENGTH - SPAN + 1

_CORE, _HULL = Rolling(11), Rolling(12)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width`` values."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(texts: Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: place of each anchor, first and last position that chose it (in ``texts.data``), its text,
    and the hash of its ``SEED`` bytes."""
    data, found = texts.data, []
    step = Rolling.STEP
    valid_to = texts.ends - LENGTH + 1  # positions from which LENGTH bytes are left
    for first in range(0, max(0, len(data) - LENGTH + 1), step):
        piece = data[first : first + step + LENGTH - 1]
        n = len(piece) - LENGTH + 1
        sums = _CORE.sums(piece)
        m = len(piece) - SEED + 1
        at = np.arange(m)
        seeds = _CORE.between(sums, at, at + SEED)
        keys = (mixed(seeds) & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
        chosen = np.uint64(0xFFFFFFFF) - (_least(keys, SPAN)[:n] & np.uint64(0xFFFFFFFF))
        edge = np.zeros(n + 1, np.int64)
        i, j = np.searchsorted(texts.ends, first, "right"), np.searchsorted(texts.starts, first + n)
        lo, hi = np.clip(texts.starts[i:j] - first, 0, n), np.clip(valid_to[i:j] - first, 0, n)
        some = hi > lo
        np.add.at(edge, lo[some], 1)
        np.add.at(edge, hi[some], -1)
        place = np.nonzero(np.cumsum(edge[:-1]) > 0)[0]
        if len(place):
            anchor = chosen[place].astype(np.int64)
            new = np.nonzero(np.append(True, anchor[1:] != anchor[:-1]))[0]
            last = np.append(new[1:], len(place)) - 1
            found.append((anchor[new] + first, place[new] + first, place[last] + first, seeds[anchor[new]]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    anchor, lo, hi, core = (np.concatenate(x) for x in zip(*found))
    new = np.nonzero(np.append(True, anchor[1:] != anchor[:-1]))[0]  # a run may go on in the next step
    anchor, lo, hi, core = anchor[new], lo[new], hi[np.append(new[1:], len(anchor)) - 1], core[new]
    return anchor, lo, hi, np.searchsorted(texts.starts, anchor, "right") - 1, core


def _find_anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        texts = Bytes(batch.column("text"))
        row = batch.column("row").to_numpy(zero_copy_only=False)
        anchor, lo, hi, of, core = anchors_of(texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(core.view(np.int64)),
                pa.array(row[of]),
                pa.array(anchor - texts.starts[of]),
                pa.array((anchor - hi).astype(np.int16)),
                pa.array((anchor - lo).astype(np.int16)),
            ],
            ["core", "row", "at", "near", "far"],
        )


def _lists(column: pa.Array, field: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of one field of a column of lists of structs, and the row of each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().field(field).to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), size)


def _cut(width: int):
    """Cut the cells of each text into cells of a width, and hash their cores and hulls."""

    def cells(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = Bytes(batch.column("text"))
            row = batch.column("row").to_numpy(zero_copy_only=False)
            at, of = _lists(batch.column("cells"), "at")
            near, _ = _lists(batch.column("cells"), "near")
            far, _ = _lists(batch.column("cells"), "far")
            first, last = near // width, far // width
            many = (last - first + 1).astype(np.int64)
            i = np.repeat(np.arange(len(at)), many)
            number = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            low = (number * width).astype(np.int64)
            high = low + width - 1
            place, start, end = at[i] + texts.starts[of[i]], texts.starts[of[i]], texts.ends[of[i]]
            core = _CORE.windows(texts.data, place - low, np.full(len(i), LENGTH - width + 1))
            core = mixed(core + number.astype(np.uint64))
            inside = (place - high >= start) & (place - low + LENGTH <= end)
            hull = np.zeros(len(i), np.int64)
            full = _HULL.windows(texts.data, (place - high)[inside], np.full(int(inside.sum()), LENGTH + width - 1))
            hull[inside] = full.view(np.int64)
            # a hull that reaches beyond its text is like no other
            own = mixed((row[of[i]].astype(np.uint64) << np.uint64(24)) + place.astype(np.uint64)).view(np.int64)
            hull[~inside] = own[~inside]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)),
                    pa.array(hull),
                    pa.array(inside),
                    pa.array(row[of[i]]),
                    pa.array(at[i]),
                    pa.array(np.maximum(low, near[i]).astype(np.int16)),
                    pa.array(np.minimum(high, far[i]).astype(np.int16)),
                ],
                ["core", "hull", "inside", "row", "at", "near", "far"],
            )

    return cells



_CELL = "row long, at long, near short, far short"


def repeated_runs(texts: DataFrame) -> DataFrame:
    """Runs of repeated positions of the staged ``texts`` (row, text): row, first, last (byte offsets)."""
    cells = stage(texts.mapInArrow(_find_anchors, f"core long, {_CELL}"), "anchors")
    again = cells.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    cells = stage(cells.join(again, "core").drop("core"), "cells")
    settled, one_of = [], F.expr("xxhash64(row, at)")
    for width in WIDTHS[1:]:
        lists = cells.groupBy("row").agg(F.collect_list(F.struct("at", "near", "far")).alias("cells"))
        cut = texts.join(lists.hint("shuffle_hash"), "row").select("row", "text", "cells")
        ranked = stage(cut.mapInArrow(_cut(width), f"core long, hull long, inside boolean, {_CELL}"), "ranked")
        # cores and hulls are counted apart, so that a frequent one is only a number
        classes = (
            ranked.groupBy("core", "hull")
            .agg(F.count("*").alias("n"), F.max("inside").alias("whole"), F.min(one_of).alias("one"))
            .withColumn("done", F.col("whole") & (F.col("n") > 1))
        )
        cores = classes.groupBy("core").agg(F.sum("n").alias("alike"), F.max(~F.col("done")).alias("open"))
        # staged, as a join can only split a frequent core if none of its sides is summed up in the same stage
        cores = stage(cores.filter("alike > 1").drop("alike"), "cores")
        classes = classes.join(cores, "core").select("core", "hull", "done", "open", "one")
        # a settled cell still has to be seen by unsettled ones with its core: one of each class goes on for that
        on = ~F.col("done") | (F.col("open") & (F.col("one") == one_of))
        ranked = ranked.join(classes, ["core", "hull"]).select("row", "at", "near", "far", "done", on.alias("on"))
        ranked = stage(ranked, "settled")
        settled.append(ranked.filter("done"))
        cells = ranked.filter("on").drop("done", "on")
    runs = settled[0]
    for x in settled[1:]:
        runs = runs.union(x)
    return runs.select("row", (F.col("at") - F.col("far")).alias("first"), (F.col("at") - F.col("near")).alias("last"))


def _spans(first: np.ndarray, last: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
    """Maximal removed stretches from runs of repeated positions: text, start, end."""
    order = np.lexsort((first, of))
    of, start, end = of[order], first[order], last[order] + LENGTH
    if not len(of):
        return [of, start, end]
    reach = np.maximum.accumulate(end + of * (1 << 40))  # one number line, a text after another
    new = np.append(True, start[1:] + of[1:] * (1 << 40) > reach[:-1])
    at = np.nonzero(new)[0]
    return [of[at], start[at], reach[np.append(at[1:], len(of)) - 1] - of[at] * (1 << 40)]


_LEFT = "n_bytes long, spans array<struct<first: long, last: long>>, kept_sha256 string"


def _remove(with_text: bool):
    def remove(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = Bytes(batch.column("text"))
            first, of = _lists(batch.column("runs"), "first")
            last, _ = _lists(batch.column("runs"), "last")
            of, start, end = _spans(first, last, of)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1))
            kept = []
            for i in range(len(texts)):
                mine = slice(cuts[i], cuts[i + 1])
                text, at, left = texts.text(i), 0, []
                for a, b in zip(start[mine].tolist(), end[mine].tolist()):
                    left.append(text[at:a])
                    at = b
                left.append(text[at:])
                kept.append(b"".join(left))
            spans = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["first", "last"])
            columns = {
                "doc": batch.column("doc"),
                "n_bytes": pa.array(texts.ends - texts.starts),
                "spans": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            }
            if with_text:
                # a character whose bytes were cut in the middle goes with the rest of it
                columns["text"] = pa.array([x.decode(errors="ignore") for x in kept], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return remove


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """What is left of each ``text`` once all repeated strings of ``LENGTH`` bytes are removed.

    Returns one row for each row of ``docs``: struct ``doc`` (its other columns, in order, as c0, c1, ... by their
    place), ``n_bytes``, ``spans`` (removed stretches: first byte, byte after the last), ``kept_sha256`` and, if
    wanted, ``text`` (the bytes left, without characters of which a part was removed). Null and empty texts and those under ``LENGTH`` bytes lose nothing; equal rows
    remove each other; an empty table gives none. Every copy of a repeated string goes, the first as well.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    flat = docs.toDF(*names)
    rest = F.struct(*[F.col(c) for c in names if c != f"c{at}"] or [F.lit("").alias("none")])
    row = F.monotonically_increasing_id().alias("row")
    texts = stage_by(flat.select(row, F.col(f"c{at}").cast("string").alias("text"), rest.alias("doc")), "row", "texts")
    runs = repeated_runs(texts.select("row", "text"))
    lists = runs.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    both = texts.join(lists.hint("shuffle_hash"), "row", "left").select("text", "doc", "runs")
    left = T.StructType.fromDDL(_LEFT + (", text string" if with_text else "")).fields
    kind = T.StructType([both.schema["doc"], *left])
    return both.mapInArrow(_remove(with_text), kind)
