"""Token-id matrices: documents cut into segments and packed into rows of fixed length.

A document's ids end with an end mark. A document longer than a row is cut into full rows and a rest, which loses
nothing; each segment carries its document and its offset. Segments of a block are packed by best fit decreasing: the
longest first, each into the fullest row that still has room. A segment tree over free capacities finds that row.
Blocks are made from the rows of a task as they come, so nothing is moved between tasks and memory has a bound.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twinfold.llm.common import Bytes, batches, pick

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
ROW = 2048
BLOCK = 1 << 22
# Fixed value: how the byte-level vocabulary splits texts
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


_LETTER, _DIGIT, _SPACE, _OTHER, _WIDE = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[128:] = _WIDE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[*range(9, 14), 32]] = _SPACE
# Fixed value: white space outside ASCII
_WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; all bytes of a white space are one."""
    kinds = _KIND[data]
    for lead in {s[0] for s in _WIDE_SPACES}:
        if len(at := np.nonzero(data == lead)[0]):
            for space in (s for s in _WIDE_SPACES if s[0] == lead):
                found = at[at + len(space) <= len(data)]
                for i, byte in enumerate(space[1:], 1):
                    found = found[data[found + i] == byte]
                for i in range(len(space)):
                    kinds[found + i] = _SPACE
    return kinds


def units(texts: Bytes) -> np.ndarray:
    """Where texts can be cut so that the ids of what lies between two cuts do not depend on the rest, ends included.

    ``SPLIT`` always cuts where white space begins and before the last white space of a run that a text goes on after;
    after that one too unless it is a space, which goes with what follows. Between two bytes of ASCII it cuts where
    letters, digits and others change, but after an apostrophe.
    """
    data, edge = texts.data, np.zeros(len(texts.data) + 1, bool)
    edge[texts.starts], edge[-1] = True, True
    if not len(data):
        return np.nonzero(edge)[0]
    kinds = _kinds(data)
    left, right = kinds[:-1], kinds[1:]
    change = np.nonzero(left != right)[0] + 1
    of, to = kinds[change - 1], kinds[change]
    apart = (of != _WIDE) & (to != _WIDE) & (of != _SPACE) & (data[change - 1] != 39) | (to == _SPACE)
    cuts = np.zeros(len(data) + 1, bool)
    cuts[change[apart]] = True
    ends = np.nonzero((kinds == _SPACE) & np.append(right != _SPACE, False) & ~edge[1:])[0] + 1
    last = np.where(data[ends - 1] < 128, ends - 1, np.where(data[ends - 2] == 0xC2, ends - 2, ends - 3))
    cuts[last] = True
    cuts[ends[data[ends - 1] != 32]] = True
    return np.nonzero(cuts | edge)[0]


def _runs(heads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs that begin at ``heads``, one after another, and where each one ends among these."""
    ends = np.cumsum(sizes)
    return np.repeat(heads - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0), ends


class Tokens:
    """Ids of texts. Texts are cut into units, and those seen lately are looked up: up to ``CACHE`` or, if it has more,
    those of the last call, none above ``LONG`` bytes."""

    CACHE = 200_000
    JOINED = 500
    LONG = 100

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.model = tiktoken.Encoding(
            "packing", pat_str=SPLIT, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
        )
        (self.line,) = self.model.encode_ordinary("\n")
        # units, and the number and the sequence of their ids
        self.seen = pa.array([], pa.large_binary()), np.empty(0, np.int64), np.empty(0, "<u2")

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.model.encode_ordinary(text.decode()), "<u2")

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of distinct units, and these ids."""
        flat = Bytes(new)
        blank = _kinds(flat.data)[flat.ends - 1] == _SPACE  # of white space alone, as no other unit ends with it
        rest = Bytes(new.filter(pa.array(~blank)))
        # a line end after a unit is an id of its own, which no unit but white space has
        stops = rest.ends + np.arange(1, len(rest) + 1)
        lines = np.full(len(rest.data) + len(rest), 10, np.uint8)
        lines[_runs(stops - 1 - (rest.ends - rest.starts), rest.ends - rest.starts)[0]] = rest.data
        edges = [0, *stops[self.JOINED - 1 :: self.JOINED].tolist(), len(lines)]
        ids = np.concatenate([self._whole(lines[i:j].tobytes()) for i, j in zip(edges, edges[1:])])
        apart = [self._whole(flat.text(i)) for i in np.nonzero(blank)[0].tolist()]
        sizes = np.empty(len(new), np.int64)
        sizes[blank] = [len(a) for a in apart]
        sizes[~blank] = np.diff(np.nonzero(ids == self.line)[0], prepend=-1) - 1
        out, heads = np.empty(sizes.sum(), "<u2"), np.cumsum(sizes) - sizes
        for which, values in ((blank, np.concatenate([ids[:0], *apart])), (~blank, ids[ids != self.line])):
            out[_runs(heads[which], sizes[which])[0]] = values
        return sizes, out

    def _known(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct units where their ids begin, how many they are, and the sequence that holds them."""
        seen, sizes, ids = self.seen
        at = pc.index_in(found, value_set=seen)
        new = found.filter(at.is_null())
        where = at.fill_null(0).to_numpy().astype(np.int64)
        where[at.is_null().to_numpy(zero_copy_only=False)] = len(seen) + np.arange(len(new))
        more, new_ids = self._learn(new)
        sizes, ids = np.append(sizes, more), np.append(ids, new_ids)
        heads = np.cumsum(sizes) - sizes
        units = pa.concat_arrays([seen, new])
        keep = np.arange(len(units)) if len(units) <= self.CACHE else where
        keep = keep[pc.binary_length(units).to_numpy()[keep] <= self.LONG]
        self.seen = units.take(pa.array(keep)), sizes[keep], ids[_runs(heads[keep], sizes[keep])[0]]
        return heads[where], sizes[where], ids

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = Bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        cuts = units(texts)
        buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(texts.data)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()
        heads, sizes, ids = self._known(coded.dictionary)
        code = coded.indices.to_numpy()
        at, ends = _runs(heads[code], sizes[code])
        ids, before = ids[at], np.append(0, ends)
        starts, stops = before[np.searchsorted(cuts, texts.starts)], before[np.searchsorted(cuts, texts.ends)]
        return [ids[a:b] for a, b in zip(starts.tolist(), stops.tolist())]

    def decode(self, ids) -> str:
        return self.model.decode([int(i) for i in ids])


@functools.cache
def tokens_of(ranks: bytes) -> Tokens:
    return Tokens(ranks)


class Room:
    """Rows by free capacity. A segment tree holds which capacities have a row."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.some = [False] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        at = free + self.size
        while at and not self.some[at]:
            self.some[at] = True
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Row with the least capacity of at least ``need``, and that capacity."""
        at = need + self.size
        if not self.some[at]:
            while at > 1 and (at & 1 or not self.some[at + 1]):  # up, until there is a branch to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        free = at - self.size
        row = self.rows[free].pop()
        if not self.rows[free]:
            self.some[at] = False
            at >>= 1
            while at:
                self.some[at] = self.some[2 * at] or self.some[2 * at + 1]
                at >>= 1
        return row, free


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Segments of each row: best fit decreasing, equal sizes in their order."""
    room, rows = Room(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = room.take(sizes[i])
        if found is None:
            found = len(rows), length
            rows.append([])
        row, free = found
        rows[row].append(i)
        if free > sizes[i]:
            room.put(row, free - sizes[i])
    return rows


def _rows_of(block: list[tuple], length: int) -> Iterator[tuple]:
    """Packed rows of a block of segments (document, offset, ids)."""
    for row in best_fit([len(ids) for _, _, ids in block], length):
        segments = [block[i] for i in row]
        sizes = [len(ids) for _, _, ids in segments]
        matrix = np.full(length, END, np.uint16)
        matrix[: sum(sizes)] = np.concatenate([ids for _, _, ids in segments])
        places = np.zeros(length, np.uint16)
        places[: sum(sizes)] = np.concatenate([np.arange(n, dtype=np.uint16) for n in sizes])
        yield (
            [d for d, _, _ in segments],
            [o for _, o, _ in segments],
            [0, *itertools.accumulate(sizes)],
            matrix.astype("<u2").tobytes(),
            places.astype("<u2").tobytes(),
        )


_FIELDS = "row long, doc_ids array<long>, offsets array<int>, cu_seqlens array<int>, ids binary, positions binary"


def _pack(ranks: bytes, length: int, limit: int):
    kind = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int32())),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("ids", pa.binary()),
            ("positions", pa.binary()),
        ]
    )

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = tokens_of(ranks), TaskContext.get()
        count = itertools.count(((task.partitionId() if task else 0)) << 33)

        def written(block: list[tuple]) -> Iterator[pa.RecordBatch]:
            packed = _rows_of(block, length)
            while some := list(itertools.islice(packed, 512)):
                columns = [[next(count) for _ in some], *zip(*some)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

        block, held = [], 0
        for batch in batches(rows, 2 << 20):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text"))):
                ids = np.append(ids, np.uint16(END))
                for at in range(0, len(ids), length):
                    block.append((doc, at, ids[at : at + length]))
                held += len(ids)
                if held >= limit:
                    yield from written(block)
                    block, held = [], 0
        if block:
            yield from written(block)

    return pack


def pack_documents(docs: DataFrame, ranks: str = RANKS, length: int = ROW, block: int = BLOCK) -> DataFrame:
    """Packed rows of ``docs`` (doc_id, text).

    Returns row (a number for each packed row), doc_ids and offsets (of its segments: document, first token in the
    document's ids), cu_seqlens (cumulative segment lengths from 0), ids and positions (``length`` little-endian 16-bit
    numbers each; positions start at 0 in every segment, and unused places hold the end mark and 0).
    A null or empty text is its end mark alone; a null doc_id stays null; equal rows are packed each.
    """
    with open(ranks, "rb") as f:
        data = f.read()
    return pick(docs, "doc_id", "text").mapInArrow(_pack(data, length, block), T.StructType.fromDDL(_FIELDS))


def write_packed(packed: DataFrame, path: str) -> DataFrame:
    """Write packed rows as a table of binary matrices, and read it."""
    packed.write.parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)
