"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over ``WINDOW`` bytes ends a piece wherever its low bits are all ones, so a boundary depends on the
bytes before it alone and an edit moves only the pieces it touches. Every piece gives one signature character. The
number of bits (block size, a power of two) is the least that leaves at most ``PIECES`` pieces; a fingerprint holds the
signatures at that block size and at twice of it. Two fingerprints are compared by the edit distance of signatures
of the same block size, provided that these share a run of ``RUN`` characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.llm.common import Rolling, batches, mixed, parts, stage, with_kept

WINDOW = 7
PIECES = 64
RUN = 7
_SIGNS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

_ROLL, _PIECE = Rolling(21), Rolling(22)


def _boundaries(data: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of pieces at a block size, with the rolling hash and the sum of the piece hash there; the last is the end
    of the text, whatever its hash. Worked off in steps of bounded size."""
    n, step, mask = len(data), Rolling.STEP, np.uint64(block - 1)
    ends, values, sums = [], [], []
    before, scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)  # arrays, as these wrap around silently
    for first in range(0, n, step):
        low = max(0, first - WINDOW + 1)
        piece = data[low : first + step]
        at = np.arange(first - low + 1, len(piece) + 1)
        value = mixed(_ROLL.between(_ROLL.sums(piece), np.maximum(at - WINDOW, 0), at))
        hit = (value & mask) == mask
        if first + step >= n:
            hit[-1] = True
        local = _PIECE.sums(data[first : first + step])
        hit = np.nonzero(hit)[0]
        ends.append(hit + first + 1)
        values.append(value[hit])
        sums.append(before + local[hit + 1] * scale)
        before = before + local[-1:] * scale
        scale = np.array([pow(_PIECE.base, first + step, 2**64)], np.uint64)
    return np.concatenate(ends), np.concatenate(values), np.concatenate(sums)


def _signature(ends: np.ndarray, sums: np.ndarray) -> str:
    starts, before = np.append(0, ends[:-1]), np.append(np.uint64(0), sums[:-1])
    if len(_PIECE.down) > starts[-1]:
        down = _PIECE.down[starts]
    else:
        back = pow(_PIECE.base, -1, 2**64)
        down = np.array([pow(back, i, 2**64) for i in starts.tolist()], np.uint64)
    return _SIGNS[(mixed((sums - before) * down) & np.uint64(63)).astype(np.int64)].tobytes().decode()


def fingerprint(text: bytes) -> str:
    """``block:signature:signature at twice the block size``; the empty text has ``1::``."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if not n:
        return "1::"
    block = 1
    while n > block * PIECES * 8:  # smaller blocks than this aren't tried
        block *= 2
    ends, values, sums = _boundaries(data, block)

    def at(block: int) -> np.ndarray:
        mask = np.uint64(block - 1)
        keep = (values & mask) == mask
        keep[-1] = True
        return keep

    while at(block).sum() > PIECES + 1:
        block *= 2
    once, twice = at(block), at(block * 2)
    return f"{block}:{_signature(ends[once], sums[once])}:{_signature(ends[twice], sums[twice])}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, all rows of a column at once in the bits of a number."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    ones = (1 << len(a)) - 1
    row = ones
    for c in b:
        both = row & where.get(c, 0)
        row = ((row + both) | (row - both)) & ones
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(RUN, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    # insertions and deletions cost 1, so the distance is what the common subsequence leaves over
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1: 1 - edit distance / length at block sizes that both have."""
    if a == b:
        return 1.0
    (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
    m, n = int(m), int(n)
    if m == n:
        return max(_alike(a1, b1), _alike(a2, b2))
    if m == 2 * n:
        return _alike(a1, b2)
    if n == 2 * m:
        return _alike(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of slices in order: each text with the one after it. Rows with ``extra`` end a slice and only follow."""
    held = None  # row, text and fingerprint that wait for the one after them
    for batch in batches(rows, 1 << 20):
        texts = [t.decode() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        extra, docs = batch.column("extra").to_pylist(), batch.column("doc")
        prints = [fingerprint(t.encode()) for t in texts]
        first = held
        own, before, after = [], [], []
        for i in range(len(texts)):
            if held is not None:
                before.append(held)
                after.append((texts[i], prints[i]))
            held = None if extra[i] else (docs.slice(i, 1), texts[i], prints[i])
            if held is not None and i + 1 < len(texts):
                own.append(i)
        if not after:
            continue
        whose = docs.take(pa.array(own, pa.int64()))
        if first is not None:
            whose = pa.concat_arrays([first[0], whose])
        edits = [edited(b[1], a[0]).encode() for b, a in zip(before, after)]
        edit_prints = [fingerprint(e) for e in edits]
        yield pa.RecordBatch.from_arrays(
            [
                whose,
                pa.array([len(b[1]) for b in before], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edits]),
                pa.array([b[2] for b in before]),
                pa.array(edit_prints),
                pa.array([likeness(b[2], e) for b, e in zip(before, edit_prints)]),
                pa.array([likeness(b[2], a[1]) for b, a in zip(before, after)]),
            ],
            ["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


_OUT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, *ids: str) -> DataFrame:
    """Fingerprints of each text and of its edited text (see ``edited``), and their likeness.

    The following document is the one with the next lower ``doc_id`` (null last; equal ids by a hash of their texts),
    after the last the first one. Returns struct ``doc`` (columns ``ids``), n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next. A null text is empty. The only row of a table follows itself.
    """
    rows = with_kept(docs, ["doc_id", "text"], ids)
    text = F.coalesce("text", F.lit(""))
    rows = rows.select(
        F.struct(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(ids)]).alias("doc"),
        text.alias("text"),
        F.col("doc_id").isNull().alias("none"),
        (~F.col("doc_id").isNull()).alias("some"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).alias("key"),
        F.xxhash64(text).alias("hash"),
    )
    n = parts(docs.sparkSession)
    slices = 4 * n
    cuts = rows.filter("some").agg(F.percentile_approx("key", [i / slices for i in range(1, slices)], max(10_000, 20 * n)))
    cuts = sorted(set(cuts.first()[0] or []))
    slot = F.lit(0)
    if cuts:
        slot = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("key")))
    rows = rows.withColumn("slot", F.when(F.col("none"), len(cuts) + 1).otherwise(slot)).drop("some")
    # The first row of a slice also ends the slice before it, the very first one the last slice. There is one for
    # each slice, so what is broadcast has at most 4 times as many rows as there are shuffle partitions.
    firsts = rows.groupBy("slot").agg(F.min(F.struct("none", "key", "hash")).alias("first")).select("slot", "first.*")
    before = F.coalesce(F.expr("lag(slot) over (order by slot)"), F.expr("max(slot) over ()"))
    firsts = stage(firsts.withColumn("before", before), "slices")
    rows = rows.join(F.broadcast(firsts), ["slot", "none", "key", "hash"], "left")
    here = F.struct(F.col("slot").alias("slot"), F.lit(False).alias("extra"))
    there = F.struct(F.col("before").alias("slot"), F.lit(True).alias("extra"))
    where = F.explode(F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there)))
    rows = rows.select("doc", "text", "none", "key", "hash", where.alias("at"))
    rows = rows.select("at.slot", "at.extra", "doc", "text", "none", "key", "hash").repartition(n, "slot")
    rows = rows.sortWithinPartitions("slot", "extra", "none", "key", "hash").select("doc", "text", "extra")
    kind = T.StructType([rows.schema["doc"], *T.StructType.fromDDL(_OUT).fields])
    return rows.mapInArrow(_compare, kind)
