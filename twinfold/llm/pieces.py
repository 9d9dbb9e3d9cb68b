"""SentencePiece models on the tokenizers library.

The model's protobuf is parsed here; its normaliser, white-space marker, pieces with scores (unigram) or merge order
(BPE) and byte fallback are rebuilt as one ``tokenizers.Tokenizer``, which encodes and decodes batches with threads.
No piece crosses the beginning of a word, so texts are cut there and repeated words come out of the model's cache.
The rebuilt tokenizer is compared with the SentencePiece library on part of the rows, or on all if wanted.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from twinfold.llm.common import batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: One row in so many is compared with the SentencePiece library.
COMPARE_ONE_IN = 16
#: Threads of the tokenizer in one task.
THREADS = 2
# Kinds of pieces and of models in the protobuf
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What the tokenizer needs of a SentencePiece model."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    suffix: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                out.kind = trainer.get(3, UNIGRAM)
                out.byte_fallback, out.suffix = bool(trainer.get(35, 0)), bool(trainer.get(24, 0))
            elif number == 3:
                normaliser = dict(_fields(value))
                out.charsmap = normaliser.get(2, b"")
                out.dummy_prefix, out.trim = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
                out.escape = bool(normaliser.get(5, 1))
        if out.kind not in (UNIGRAM, BPE) or out.suffix or not out.escape:
            raise ValueError("only unigram and BPE models that mark white space before words are supported")
        return out

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs in the order in which a BPE model joins them: by the score of the piece that they make."""
        usable = {p: (s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind in (NORMAL, UNUSED, USER)}
        out = []
        for piece, (score, i) in usable.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in usable and right in usable:
                    out.append((-score, i, usable[left][1], usable[right][1], left, right))
        return [(left, right) for *_, left, right in sorted(out)]

    def by_word(self) -> bool:
        """Whether no piece goes on beyond the mark of a next word."""
        return not any(MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind in (NORMAL, USER))

    @functools.cached_property
    def core(self) -> models.Model:
        """The pieces with their merges or scores. All tokenizers share it, and it keeps no words: the codec does."""
        names = [p for p, _, _ in self.pieces]
        if self.kind == BPE:
            vocab = {p: i for i, p in enumerate(names)}
            return models.BPE(
                vocab, self.merges(), unk_token=names[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback,
                cache_capacity=0,
            )
        scores = [(p, s) for p, s, _ in self.pieces]
        return models.Unigram(scores, unk_id=self.unknown, byte_fallback=self.byte_fallback)

    def tokenizer(self) -> Tokenizer:
        out = Tokenizer(self.core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        if self.by_word():
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
        own = [AddedToken(p, special=False, normalized=False) for p, _, kind in self.pieces if kind == USER]
        out.add_tokens(own)
        strip = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        out.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip]
        )
        return out


class Codec:
    """Encoder and decoder of batches. Words seen lately are looked up; two generations of at most ``CACHE`` are kept."""

    CACHE = 200_000
    JOINED = 500

    def __init__(self, data: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        model = Model.parse(data)
        self.tokenizer = model.tokenizer()
        self.normal = self.tokenizer.normalizer
        self.plain = not model.charsmap and not model.trim and model.dummy_prefix
        self.words = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if model.by_word() else None
        self.bare = model.tokenizer()  # for words, which are normalised already
        self.bare.normalizer, self.bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence([])
        self.joined = model.tokenizer()  # for many words in one text
        self.joined.normalizer = normalizers.Sequence([])
        self.joined.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.first = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = []
        for piece, _, kind in model.pieces:
            raw = b"" if kind == CONTROL else bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.encode()
            self.bytes.append(b" \xe2\x81\x87 " if kind == UNKNOWN else raw.replace(MARK.encode(), b" "))
        self.skip = model.dummy_prefix

    def _normal(self, text: str) -> str:
        if self.plain:
            return MARK + text.replace(" ", MARK) if text else ""
        return self.normal.normalize_str(text)

    def _learn(self, words: set[str]) -> None:
        """Have the ids of all these words among those seen."""
        if len(self.seen) > self.CACHE:
            self.seen, self.older = {}, self.seen
        seen, older = self.seen, self.older
        new = []
        for word in words:
            if word not in seen:
                if word in older:
                    seen[word] = older[word]
                else:
                    new.append(word)
        # a piece that begins with the mark begins a word, so many words with one mark can be told apart again
        plain = [w for w in new if w[0] == MARK and w.count(MARK) == 1]
        groups = [plain[i : i + self.JOINED] for i in range(0, len(plain), self.JOINED)]
        for group, e in zip(groups, self.joined.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<i4")
            cuts = [*np.nonzero(self.first[ids])[0].tolist(), len(ids)]
            raw = ids.tobytes()
            for word, a, b in zip(group, cuts, cuts[1:]):
                seen[word] = raw[4 * a : 4 * b]
        odd = [w for w in new if w not in seen]
        for word, e in zip(odd, self.bare.encode_batch_fast(odd, add_special_tokens=False)):
            seen[word] = np.array(e.ids, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.words is None:
            return [np.array(e.ids, "<i4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [self.words.findall(self._normal(t)) for t in texts]
        self._learn(set().union(*split))
        get = self.seen.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), "<i4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """Byte pieces that are no UTF-8 become replacement characters, as in the libraries."""
        get = self.bytes.__getitem__
        text = b"".join(map(get, ids.tolist())).decode(errors="replace")
        return text[1:] if self.skip and text[:1] == " " else text


@functools.cache
def _loaded(data: bytes):
    import sentencepiece

    return Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def _encode(data: bytes, one_in: int, with_text: bool):
    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, library = _loaded(data)
        for batch in batches(rows, 2 << 20):
            texts = [t.decode() for t in batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()]
            ids = codec.encode(texts)
            back = [codec.decode(x) for x in ids]
            compared = []
            for text, own, read in zip(texts, ids, back):
                chosen = hashlib.md5(text.encode()).digest()[0] % one_in == 0
                own = own.tolist() if chosen else None
                compared.append(library.encode(text) == own and library.decode(own) == read if chosen else None)
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            columns = {
                "doc": batch.column("doc"),
                "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                "n_tokens": pa.array(sizes),
                "exact": pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
                "parity": pa.array(compared, pa.bool_()),
            }
            if with_text:
                columns["decoded"] = pa.array(back, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return encode


def encode_documents(docs: DataFrame, model: str = MODEL, one_in: int = COMPARE_ONE_IN, with_text: bool = True) -> DataFrame:
    """Token ids of each ``text`` of ``docs`` (struct ``doc``: anything, text).

    Returns doc, ids, n_tokens, exact (whether the ids read back are the text), parity (whether the SentencePiece
    library gives and reads the same ids; null where the row was not compared) and, if wanted, decoded. The model file
    is read where the job is planned. A null text is empty; an empty text has no ids.
    """
    with open(model, "rb") as f:
        data = f.read()
    rows = docs.select("doc", "text")
    out = "ids array<int>, n_tokens int, exact boolean, parity boolean" + ", decoded string" * with_text
    kind = T.StructType([rows.schema["doc"], *T.StructType.fromDDL(out).fields])
    return rows.mapInArrow(_encode(data, one_in, with_text), kind)
