"""Phrases whose words stand together more often than their parts would by chance, counted in tiles of a pair table.

Texts are read in chunks of one language. A chunk is a dictionary of items and a sequence of places in it; its items
are first words, then pairs of neighbouring items, again and again. All chunks' items are added up, the frequent ones
get numbers in the order of their frequency, and each chunk is told the numbers of its own items only. Pairs of numbers
address a cell of a table that is cut into square tiles. As small numbers are frequent ones, few tiles get most pairs:
those are counted in a dense array of cells, all others by sorting. A frequent pair is an item of the next round, so
that two overlapping phrases of m words are counted as one of m + 1 words.

Items are dealt into slots by hash. A chunk sends each slot one row with all its items there, moved once: the slot adds
them up, and answers when the frequent ones have numbers. There are as many slots as ``CHUNKS_A_SLOT`` has it, so no
task holds more than a chunk or what a few chunks hold, and no table of words is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import Bytes, Rolling, batches, mixed, numbered, parts, stage, stage_by, with_kept

#: Words of the longest phrase, occurrences of a candidate, phrases returned for a language.
LONGEST = 5
LEAST = 100
TOP = 2000
#: Bytes of text in a chunk, and numbers along the side of a tile.
CHUNK = 4 << 20
SIDE = 512
#: Chunks whose items a slot gets, if there are not more partitions than that makes slots.
CHUNKS_A_SLOT = 8
#: A tile is counted in an array if it has at least one pair for so many cells.
CELLS_A_PAIR = 8
#: Parts of a language that are cut to the ``TOP`` best before these meet.
SPLITS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _words(texts: Bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some texts and the sequence of their places, with -1 between pieces."""
    data = _LOWER[texts.data]
    kind = _KIND[data]
    inside = kind == 0
    cut = kind == 2
    heads = np.zeros(len(data), bool)
    heads[texts.starts[texts.starts < texts.ends]] = True
    before = np.append(False, inside[:-1])[: len(data)]
    begins = np.nonzero(inside & (heads | ~before))[0]
    after = np.append(inside[1:], False)[: len(data)]
    stops = np.nonzero(inside & (np.append(heads[1:], True)[: len(data)] | ~after))[0] + 1
    piece = np.cumsum(cut | heads, dtype=np.int32)[begins]
    offsets = np.append(0, np.cumsum(stops - begins))
    flat = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside]))
    coded = flat.dictionary_encode()
    places = np.arange(len(begins)) + np.append(0, np.cumsum(piece[1:] != piece[:-1]))[: len(begins)]
    sequence = np.full(int(places[-1]) + 1 if len(places) else 0, -1, np.int32)
    sequence[places] = coded.indices.to_numpy()
    return coded.dictionary.cast(pa.string()), sequence


def _reader(size: int):
    """Rows (lang, text) to chunks: the items are words."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[pa.Array]] = {}

        def chunk(lang: str) -> pa.RecordBatch:
            nonlocal number
            words, sequence = _words(Bytes(pa.concat_arrays(held.pop(lang))))
            counts = np.bincount(sequence[sequence >= 0], minlength=len(words))
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([lang], pa.string()),
                    pa.array([sequence.tobytes()], pa.binary()),
                    pa.ListArray.from_arrays([0, len(words)], words),
                    pa.ListArray.from_arrays([0, len(words)], pa.array(counts, pa.int64())),
                ],
                ["chunk", "lang", "sequence", "word", "n"],
            )

        for batch in batches(rows, size):
            langs = batch.column("lang").dictionary_encode()
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                which = np.nonzero(langs.indices.to_numpy() == code)[0]
                held.setdefault(lang, []).append(texts.take(pa.array(which)))
                if sum(a.nbytes for a in held[lang]) >= size:
                    yield chunk(lang)
        for lang in list(held):
            yield chunk(lang)

    return read


def tiled(i: np.ndarray, j: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (i, j), their counts, and for each given pair its place among them."""
    tiles, tile, sizes = np.unique(
        ((i // side) << 32) | (j // side), return_inverse=True, return_counts=True
    )
    cell = (i % side) * side + j % side
    dense = sizes * CELLS_A_PAIR >= side * side
    codes, counts, place = [], [], np.empty(len(i), np.int64)
    made = 0
    by_tile = np.argsort(tile, kind="stable")
    ends = np.cumsum(sizes)
    for t in np.nonzero(dense)[0].tolist():
        own = by_tile[ends[t] - sizes[t] : ends[t]]
        cells = np.bincount(cell[own], minlength=side * side)
        some = np.nonzero(cells)[0]
        at = np.empty(side * side, np.int64)
        at[some] = made + np.arange(len(some))
        place[own] = at[cell[own]]
        codes.append(some + t * side * side)
        counts.append(cells[some])
        made += len(some)
    rest = np.nonzero(~dense[tile])[0]
    code, at, n = np.unique(tile[rest] * (side * side) + cell[rest], return_inverse=True, return_counts=True)
    place[rest] = made + at
    codes, counts = np.concatenate([*codes, code]), np.concatenate([*counts, n])
    of, cell = tiles[codes // (side * side)] if len(codes) else codes, codes % (side * side)
    return (of >> 32) * side + cell // side, (of & 0xFFFFFFFF) * side + cell % side, counts, place


def _packed(numbers: np.ndarray) -> bytes:
    """Steps between numbers by bytes of like weight, compressed."""
    steps = np.diff(numbers.astype("<i8"), prepend=0)
    steps = (steps << 1) ^ (steps >> 63)  # the sign is the last bit
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _opened(column: pa.ChunkedArray, sizes: pa.ChunkedArray) -> list[np.ndarray]:
    """The numbers of each row of ``_packed`` ones."""
    out = []
    for raw, n in zip(column.to_pylist(), sizes.to_pylist()):
        planes = np.frombuffer(pa.decompress(raw, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, -1)
        steps = np.ascontiguousarray(planes.T).view("<u8")[:, 0]
        out.append(np.cumsum((steps >> np.uint64(1)).astype(np.int64) ^ -(steps & np.uint64(1)).astype(np.int64)))
    return out


def _slots(spread: np.ndarray, slots: int, *order: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Slots and the places of their items."""
    slot = (mixed(spread) % np.uint64(slots)).astype(np.int64)
    by_slot = np.lexsort((*order, slot))
    ends = np.cumsum(np.bincount(slot, minlength=slots)).tolist()
    return [(i, by_slot[a:b]) for i, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _word_sender(slots: int):
    """Chunks of words to a row for each slot that has some of them."""

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Rolling(13)
        for batch in rows:
            for row in range(batch.num_rows):
                words, n = batch.column("word")[row].values, batch.column("n")[row].values.to_numpy()
                flat = Bytes(words)
                some = _slots(hashes.between(hashes.sums(flat.data), flat.starts, flat.ends), slots) if len(words) else []
                ends = np.cumsum([0] + [len(at) for _, at in some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([slot for slot, _ in some], pa.int64()),
                        pa.array([batch.column("chunk")[row].as_py()] * len(some), pa.int64()),
                        pa.array([batch.column("lang")[row].as_py()] * len(some), pa.string()),
                        pa.array([len(at) for _, at in some], pa.int64()),
                        pa.ListArray.from_arrays(ends, words.take(pa.array(np.concatenate([ends[:0], *[at for _, at in some]])))),
                        pa.array([_packed(n[at]) for _, at in some], pa.binary()),
                        pa.array([_packed(at) for _, at in some], pa.binary()),
                    ],
                    ["slot", "chunk", "lang", "size", "item", "n", "place"],
                )

    return send


def _items(sent: pa.Table) -> pa.Array:
    """The items that some chunks sent, one after another: words, or pairs as one number each."""
    if pa.types.is_list(sent["item"].type):
        return sent["item"].combine_chunks().flatten()
    return pa.array(np.concatenate(_opened(sent["item"], sent["size"])))


def _langs(sent: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    for lang in sent["lang"].unique().to_pylist():
        yield lang, sent.filter(pc.equal(sent["lang"], lang))


def _summer(least: int):
    """What chunks sent to a slot, added up: items with at least ``least`` occurrences (a)."""

    def add(sent: pa.Table) -> pa.Table:
        out = []
        for lang, own in _langs(sent):
            coded = _items(own).dictionary_encode()
            sums = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(sums, coded.indices.to_numpy(), np.concatenate(_opened(own["n"], own["size"])))
            often = np.nonzero(sums >= least)[0]
            item = coded.dictionary.take(pa.array(often))
            columns = {"slot": [sent["slot"][0].as_py()] * len(often), "lang": [lang] * len(often), "item": item, "a": sums[often]}
            kind = [("slot", pa.int64()), ("lang", pa.string()), ("item", item.type), ("a", pa.int64())]
            out.append(pa.table(columns, schema=pa.schema(kind)))
        return pa.concat_tables(out)

    return add


def _teller(sent: pa.Table, frequent: pa.Table) -> pa.Table:
    """The numbers of the frequent items of a slot for each chunk that sent some."""
    out = {c: [] for c in ("to", "size", "place", "number")}
    if sent.num_rows and frequent.num_rows:
        for lang, own in _langs(sent):
            known = frequent.filter(pc.equal(frequent["lang"], lang))
            at = pc.index_in(_items(own), value_set=known["item"].combine_chunks()).fill_null(-1).to_numpy()
            numbers = np.append(known["number"].to_numpy(), -1)[at]
            begin = 0
            for chunk, place in zip(own["chunk"].to_pylist(), _opened(own["place"], own["size"])):
                number = numbers[begin : begin + len(place)]
                begin += len(place)
                some = number >= 0
                if some.any():
                    row = [chunk, int(some.sum()), _packed(place[some]), _packed(number[some])]
                    for c, value in zip(out, row):
                        out[c].append(value)
    return pa.table(out, schema=pa.schema([("to", pa.int64()), ("size", pa.int64()), ("place", pa.binary()), ("number", pa.binary())]))


def _pairer(side: int, slots: int):
    """A chunk with the numbers of its frequent items becomes one whose items are pairs of neighbours.

    Returns a row without slot that has the sequence, and a row for each slot that has some of the pairs.
    """

    def pair(chunk: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        if chunk.num_rows and told.num_rows:
            number, lang = chunk["chunk"][0].as_py(), chunk["lang"][0].as_py()
            old = np.frombuffer(chunk["sequence"][0].as_py(), np.int32)
            places = np.concatenate(_opened(told["place"], told["size"]))
            of = np.full(int(max(old.max(initial=-1), places.max())) + 2, -1, np.int64)  # the last one is that of -1
            of[places] = np.concatenate(_opened(told["number"], told["size"]))
            ids = of[old]
            at = np.nonzero((ids[:-1] >= 0) & (ids[1:] >= 0))[0]
            left, right, n, place = tiled(ids[at], ids[at + 1], side)
            code = (left << 32) | right
            some = _slots(code.astype(np.uint64), slots, code)
            order = np.concatenate([at[:0], *[which for _, which in some]])
            code, n, rank = code[order], n[order], np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))  # pairs of a slot get neighbouring places
            place = rank[place]
            ends = np.cumsum([0] + [len(which) for _, which in some])
            new = np.full(len(ids) + 1, -1, np.int32)
            new[at + 1] = place
            paired = new >= 0
            paired[1:-1] &= paired[:-2] | paired[2:]  # others have no neighbour to pair with
            new = np.where(paired, new, -1)
            keep = paired | np.append(False, paired[:-1])
            out.append((None, number, lang, new[keep].tobytes(), None, None, None, None))
            for (slot, which), i, j in zip(some, ends, ends[1:]):
                out.append((slot, number, lang, None, len(which), _packed(code[i:j]), _packed(n[i:j]), _packed(np.arange(i, j))))
        return pa.table(list(zip(*out)) or [[] for _ in _PAIRS_ARROW], schema=_PAIRS_ARROW)

    return pair


_SENT = "slot long, chunk long, lang string, size long, item {}, n binary, place binary"
_PAIRS = "slot long, chunk long, lang string, sequence binary, size long, item binary, n binary, place binary"
_PAIRS_ARROW = pa.schema(
    [("slot", pa.int64()), ("chunk", pa.int64()), ("lang", pa.string()), ("sequence", pa.binary()), ("size", pa.int64())]
    + [(c, pa.binary()) for c in ("item", "n", "place")]
)


def _frequent(sent: DataFrame, kind: str, least: int) -> DataFrame:
    """Items with at least ``least`` occurrences (a), numbered by language and frequency; words and pairs by themselves."""
    sums = sent.groupBy("slot").applyInArrow(_summer(least), f"slot long, lang string, item {kind}, a long")
    return numbered(sums, "lang", F.desc("a"), "item")


def _told(sent: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rows for chunks (to) with the places and the numbers of frequent items."""
    asked = sent.groupBy("slot").cogroup(frequent.select("slot", "lang", "item", "number").groupBy("slot"))
    return asked.applyInArrow(_teller, "to long, size long, place binary, number binary")


def _score(words: int) -> Column:
    """The lowest score over all cuts of a phrase, with the counts of both its parts there (score, cut, l, r).

    ``heads`` and ``tails`` are the counts of its first and its last 1, 2, ... words.
    """
    whole = "cast(1000 as decimal(4,0)) * cast(a as decimal(18,0)) * cast(n as decimal(16,0))"
    part = "cast({} as decimal(18,0))"
    cuts = []
    for k in range(1, words):
        left, right = f"heads[{k - 1}]", f"tails[{words - k - 1}]"
        score = F.expr(f"({whole}) div ({part.format(left)} * {part.format(right)})")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("cut"), F.expr(left).alias("l"), F.expr(right).alias("r")))
    return F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]


def _best(phrases: DataFrame, top: int) -> DataFrame:
    """The first phrases of each language. Parts of a language are cut first, so that no task meets all of one."""
    order = "score desc, a desc, phrase"
    split = F.expr(f"row_number() over (partition by lang, pmod(xxhash64(phrase), {SPLITS}) order by {order})")
    some = phrases.withColumn("rank", split).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.expr(f"row_number() over (partition by lang order by {order})").cast("long"))
    return ranked.filter(F.col("rank") <= top)


def mine_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, chunk: int = CHUNK, side: int = SIDE
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language of ``docs`` (lang, text).

    Returns lang (null: und), rank, phrase, a (occurrences), l and r (those of the two parts at the lowest-scoring
    cut), n (words of the language) and score. Phrases lie within a piece of a text; one that only occurs within a
    longer one is left out. Null and empty texts have no words, every row counts as often as it is there, and tables
    without phrases give no rows. Counts may have 16 digits.
    """
    rows = with_kept(docs, ["lang", "text"], ()).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    kind = "chunk long, lang string, sequence binary, word array<string>, n array<long>"
    chunks = stage(rows.mapInArrow(_reader(chunk), kind), "words")
    added = F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y)
    total = stage(chunks.groupBy("lang").agg(F.sum(added).alias("n")), "total")
    slots = max(parts(docs.sparkSession), -(-chunks.count() // CHUNKS_A_SLOT))
    words = chunks.select("chunk", "lang", "word", "n").mapInArrow(_word_sender(slots), _SENT.format("array<string>"))
    sent = stage_by(words, "slot", "sent")
    found = stage(_frequent(sent, "string", least), "frequent")
    known = found.withColumns({"phrase": F.col("item"), "last": F.col("item"), "heads": F.array("a"), "tails": F.array("a")})
    levels: list[DataFrame] = []
    for words in range(2, longest + 1):
        paired = chunks.select("chunk", "lang", "sequence").groupBy("chunk").cogroup(_told(sent, found).groupBy("to"))
        pairs = stage(paired.applyInArrow(_pairer(side, slots), _PAIRS), "pairs")
        chunks = pairs.filter("slot is null")
        sent = stage_by(pairs.filter("slot is not null").drop("sequence"), "slot", "sent")
        found = stage(_frequent(sent, "long", least), "frequent")
        first = known.select(F.col("number").alias("left"), F.col("phrase").alias("begin"), F.col("heads").alias("heads_"))
        second = known.select(F.col("number").alias("right"), "last", F.col("tails").alias("tails_"))
        two = found.withColumns({"left": F.shiftright("item", 32), "right": F.col("item").bitwiseAND(0xFFFFFFFF)})
        known = two.join(first, "left").join(second, "right").select(
            "lang",
            "number",
            "left",
            "right",
            "a",
            F.concat_ws(" ", "begin", "last").alias("phrase"),
            "last",
            F.concat("heads_", F.array("a")).alias("heads"),
            F.concat("tails_", F.array("a")).alias("tails"),
        )
        known = stage(known, "phrases")
        levels.append(known)
    out = None
    for at, level in enumerate(levels):
        scored = level.join(total, "lang").withColumn("cut", _score(at + 2))
        scored = scored.select("lang", "number", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        if at + 1 < len(levels):
            longer = levels[at + 1].select(F.explode(F.array("left", "right")).alias("number"), F.col("a").alias("longer"))
            longer = longer.groupBy("number").agg(F.max("longer").alias("longer"))
            scored = scored.join(longer, "number", "left").filter("longer is null or longer < a").drop("longer")
        scored = scored.drop("number")
        out = scored if out is None else out.union(scored)
    return _best(out, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
