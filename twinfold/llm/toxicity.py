"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer reads words and writes symbols: insult, threat, target, negation, report or a plain word. The
insult entries carry weights learned from labelled documents, and may be stems, so that forms not seen before match
too. Five machines over these symbols are composed: insults become findings, and so do threat verbs that a target
follows; a target on either side of an insult makes it an attack, a negation shortly before a finding weakens it, and so
does a verb of reported speech on either side in the same clause. Clauses, not words, are scored: a clause's score is its heaviest finding, times what the learned model says
about that kind of finding, and a document's score follows from its clauses.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import batches, pick, stage, with_kept

#: Characters of stems that are tried.
STEMS = (4, 5, 6, 7, 8)
#: A learned entry has to be this much more frequent in toxic documents than by chance, in natural logarithms beyond
#: that of the number of words tried.
SURPRISE = 3.0
#: Share of clean documents among those with an entry, at most.
CLEAN = 0.05
#: Learning is repeated with what the entries so far don't explain, at most so often.
ROUNDS = 4

# Words of the grammar. Insults are only a prior, which labels confirm or refute.
INSULTS = """idiot idiots moron morons stupid dumb trash scum pathetic disgusting loser losers clown worthless imbecile
idiota imbécil estúpido basura crétin connard ordure abruti trottel abschaum dummkopf schwachkopf""".split()
THREATS = """kill murder hurt destroy strangle stab shoot matar tuer töten umbringen""".split()
TARGETS = """you your you're u ur yourself tu te vous ton ta du dich dir dein deine ihr euch tú usted vosotros they them
he she him her""".split()
NEGATIONS = """not no never isn't aren't don't doesn't wasn't without ne pas jamais nicht kein keine nie nunca jamás sin""".split()
REPORTS = """said says say wrote told claimed called quoted dit disait écrit sagt sagte schrieb dijo dice escribió""".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, WORD = "insult", "threat", "target", "negation", "report", "word"
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, WORD)
#: A threat verb at the end of its clause, before it is known whether a target was named.
OPEN = "open"
FLAGS = ("target", "negated", "reported")
#: Kinds of findings that the composed machine writes.
KINDS = tuple("".join(x) for x in itertools.product(("insult", "threat"), ("", "+target"), ("", "+negated"), ("", "+reported")))
#: Words that a negation or a threat verb reaches ahead.
REACH = 3
_WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Machine:
    """A deterministic transducer: from a state and a symbol to the next state and the written symbol."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str]] = field(hash=False)

    def after(self, other: Machine) -> Machine:
        """The machine that reads what ``other`` writes, as one machine."""
        start, arcs, todo = (other.start, self.start), {}, [(other.start, self.start)]
        inputs = {s for _, s in other.arcs}
        seen = {start}
        while todo:
            a, b = todo.pop()
            for symbol in inputs:
                if (a, symbol) in other.arcs:
                    to_a, middle = other.arcs[a, symbol]
                    to_b, out = self.arcs[b, middle]
                    arcs[(a, b), symbol] = ((to_a, to_b), out)
                    if (to_a, to_b) not in seen:
                        seen.add((to_a, to_b))
                        todo.append((to_a, to_b))
        return Machine(start, arcs)


def _marking(alphabet: list[str], states: list, step) -> Machine:
    return Machine(states[0], {(s, x): step(s, x) for s in states for x in alphabet})


def _finding(x: str) -> bool:
    return x.split("+")[0] in (INSULT, THREAT)


def _flagged(x: str, flag: str, when: object) -> str:
    """A finding with one more flag, if it is one and ``when`` holds."""
    if not when or not _finding(x):
        return x
    kind, *flags = x.split("+")
    return "+".join([kind, *(f for f in FLAGS if f in flags or f == flag)])


def _written(machine: Machine) -> list[str]:
    return sorted({out for _, out in machine.arcs.values()})


def grammar() -> tuple[Machine, Machine]:
    """Insult, threat, target, negation and reported speech, composed into two machines over a clause's symbols.

    The first reads a clause from its end, the second reads what the first wrote from its beginning, so that a finding
    knows both sides of it. A threat is a verb with a target among the next ``REACH`` words; a verb that ends its clause
    is one if a target was named before; with any other object it is a plain word.
    """
    insult = _marking(list(SYMBOLS), [0], lambda s, x: (0, x))  # an insult is a finding by itself

    def threaten(s, x: str):
        ahead = REACH if x == TARGET else max(0, s - 1) if s != "end" else 0
        return ahead, x if x != THREAT or s not in (0, "end") else OPEN if s == "end" else WORD

    threat = _marking(_written(insult), ["end", *range(REACH + 1)], threaten)
    named = lambda s, x: (1 if x == TARGET else s, _flagged(x, "target", s))
    told = lambda s, x: (1 if x == REPORT else s, _flagged(x, "reported", s))
    target = _marking(_written(threat), [0, 1], named)
    back = _marking(_written(target), [0, 1], told).after(target.after(threat.after(insult)))

    def close(s: int, x: str):
        return named(s, x) if x != OPEN else (s, THREAT + "+target" if s else WORD)

    target = _marking(_written(back), [0, 1], close)
    negation = _marking(
        _written(target),
        list(range(REACH + 1)),
        lambda s, x: (REACH if x == NEGATION else max(0, s - 1), _flagged(x, "negated", s)),
    )
    return back, _marking(_written(negation), [0, 1], told).after(negation.after(target))


@dataclass
class Lexicon:
    """Weighted entries: whole words and stems of insults, and the words of the other symbols."""

    words: dict[str, float]
    stems: dict[str, float]
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS, 1.0))

    def automaton(self) -> ahocorasick.Automaton:
        """All findings in one machine over characters."""
        out = ahocorasick.Automaton()
        for word, weight in self.words.items():
            out.add_word(word, (word, False, INSULT, weight))
        for word, weight in self.threats.items():
            if word not in self.words:
                out.add_word(word, (word, False, THREAT, weight))
        for stem, weight in self.stems.items():
            if stem not in self.words:
                out.add_word(stem, (stem, True, INSULT, weight))
            else:
                out.add_word(stem, (stem, True, INSULT, max(weight, self.words[stem])))
        out.make_automaton()
        return out


class Reader:
    """Findings of a text's clauses."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, (self.back, self.ahead) = lexicon, grammar()
        self.found = lexicon.automaton() if lexicon.words or lexicon.stems else None
        self.other = {w: s for s, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}

    def _symbol(self, word: str) -> tuple[str, float]:
        weight = self.lexicon.words.get(word)
        if weight is None:
            weight = max((self.lexicon.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n), default=0.0)
        if weight:
            return INSULT, weight
        if word in self.lexicon.threats:
            return THREAT, self.lexicon.threats[word]
        return self.other.get(word, WORD), 0.0

    def read(self, symbols: list[str]) -> list[str]:
        """What the grammar writes for the symbols of one clause."""
        for machine in (self.back, self.ahead):  # the first from the end, so the second from the beginning
            state, wrote = machine.start, []
            for symbol in reversed(symbols):
                state, out = machine.arcs[state, symbol]
                wrote.append(out)
            symbols = wrote
        return symbols

    def findings(self, text: str) -> Iterator[list[tuple[str, str, float]]]:
        """All findings (kind, word, weight) of each clause that holds an entry, one list for each."""
        low = text.lower()
        if self.found is None:
            return
        ends, starts, done = None, None, -1
        for end, (entry, stem, _, _) in self.found.iter(low):
            at = end - len(entry) + 1
            if at < done or (at and low[at - 1].isalnum()) or (not stem and low[end + 1 : end + 2].isalnum()):
                continue
            if ends is None:  # borders of all clauses, once for a text
                cuts = list(_CLAUSE.finditer(low))
                ends, starts = [m.start() for m in cuts] + [len(low)], [0] + [m.end() for m in cuts]
            clause = bisect.bisect_right(starts, at) - 1
            done = ends[clause]
            words = _WORDS.findall(low[starts[clause] : done])
            symbols = [self._symbol(w) for w in words]
            wrote = self.read([s for s, _ in symbols])
            yield [(kind, word, weight) for kind, word, (_, weight) in zip(wrote, words, symbols) if weight and _finding(kind)]

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """The heaviest finding (kind, weight) of each clause that has one."""
        best = [max(found, key=lambda f: f[2]) for found in self.findings(text) if found]
        return [(kind, weight) for kind, _, weight in best]


def features(clauses: list[tuple[str, float]]) -> np.ndarray:
    """Heaviest finding of each kind, and the logarithm of one more than the clauses that have one."""
    out = np.zeros(len(KINDS) + 1)
    for kind, weight in clauses:
        i = KINDS.index(kind)
        out[i] = max(out[i], weight)
    out[-1] = math.log1p(len(clauses))
    return out


@dataclass
class Model:
    lexicon: Lexicon
    kinds: np.ndarray
    bias: float

    def score(self, clauses: list[tuple[str, float]]) -> float:
        return float(1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + features(clauses) @ self.kinds)))))


def _prior_weights() -> np.ndarray:
    """What a finding counts before any label: negated and reported ones count less."""
    weight = [(1.0 if k.startswith("insult") else 0.7) * (1.3 if "target" in k else 1.0) * (0.8 if "negated" in k else 1.0)
              * (0.85 if "reported" in k else 1.0) for k in KINDS]
    return np.array([*weight, 0.5])


def _sums(x: np.ndarray, y: np.ndarray, n: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss over rows that count ``n`` times."""
    p = 1 / (1 + np.exp(-np.clip(x @ weight, -60, 60)))
    return x.T @ ((p - y) * n), (x * ((p * (1 - p) + 1e-9) * n)[:, None]).T @ x


def _logistic(sums: Callable, prior: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, each weight pulled towards its prior. ``sums``: gradient and curvature."""
    weight = prior.copy()
    for _ in range(60):
        slope, hess = sums(weight)
        move = np.linalg.solve(hess + np.diag(pull), slope + (weight - prior) * pull)
        move *= min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
        weight = weight - move
        if np.abs(move).max() < 1e-6:
            break
    return weight


def _design(x: np.ndarray, prior: np.ndarray | None) -> np.ndarray:
    """Rows of the regression: the kinds, or their sum under the prior weights, and a one."""
    return np.hstack([x if prior is None else (x @ prior)[:, None], np.ones((len(x), 1))])


def _added(prior: np.ndarray | None, weight: np.ndarray):
    """Gradient and curvature of a task's rows, as one row."""

    def added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weight) * (len(weight) + 1))
        for batch in rows:
            x = np.array(batch.column("x").to_pylist()).reshape(batch.num_rows, -1)
            if len(x):
                y, n = (np.array(batch.column(c).to_pylist(), float) for c in ("toxic", "n"))
                total += np.concatenate([part.ravel() for part in _sums(_design(x, prior), y, n, weight)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    return added


def fit_kinds(read: DataFrame, strength: float = 4.0) -> tuple[np.ndarray, float]:
    """Weights of the kinds and the bias: first the prior weights are scaled as one, then each is fitted.

    ``read`` (x, toxic, n): features, label and number of training rows. A step adds them up in tasks.
    """
    prior, bias = _prior_weights(), -3.0
    low, high = read.agg(F.min("toxic"), F.max("toxic")).first()
    if low is None or low == high:
        return prior, bias

    def sums(by: np.ndarray | None):
        def of(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            # a row of some hundred numbers for each task
            total = sum(np.array(r.total) for r in read.mapInArrow(_added(by, weight), "total array<double>").collect())
            return total[: len(weight)], total[len(weight) :].reshape(len(weight), len(weight))

        return of

    scale, bias = _logistic(sums(prior), np.array([1.0, bias]), np.array([1.0, 0.01]))
    start = np.append(prior * max(scale, 0.1), bias)
    *weight, bias = _logistic(sums(None), start, np.append(np.full(len(start) - 1, strength), 0.01))
    return np.maximum(weight, 0.0), float(bias)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of all labelled documents that are not held out.

    Null labels and ids are passed over; of several labels of an id, toxic wins, and of several texts the smallest.
    """
    marks = pick(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    marks = marks.filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = pick(docs, "doc_id", "text").join(marks, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))


def held_out(doc_id) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _surprise(toxic, clean, share: float):
    """How far an entry's share of toxic documents is above the usual one: documents times relative entropy."""
    n = toxic + clean
    p = toxic / n
    at = p * F.log(p / share) + F.when(clean > 0, (1 - p) * F.log((1 - p) / (1 - share))).otherwise(0.0)
    return F.when(p > share, n * at).otherwise(0.0)


def _uses(words: set[str], stems: set[str]):
    """Places (words around) in which entries are used."""

    def uses(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            entry, place = [], []
            for text in batch.column("text").to_pylist():
                said = _WORDS.findall(text.lower())
                for i, word in enumerate(said):
                    own = [word] * (word in words) + [word[:n] + "*" for n in STEMS if word[:n] in stems and len(word) >= n]
                    if own:
                        around = " ".join([*said[max(0, i - 1) : i], "_", *said[i + 1 : i + 2]])
                        entry += own
                        place += [around] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(entry, pa.string()), pa.array(place, pa.string())], ["entry", "place"])

    return uses


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Entries from training rows (text, toxic).

    An entry's support is the number of places in which toxic documents use it: copies of one document count once.
    """
    clean, toxic = (rows.agg(F.count(F.when(F.col("toxic") == i, 1))).first()[0] for i in (0, 1))
    if not toxic or not clean:
        return Lexicon({}, {})
    share = toxic / (toxic + clean)
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}']+"), lambda w: w != ""))
    seen = rows.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    seen = stage(seen, "words")
    least = math.log(max(2, seen.count())) + SURPRISE
    stems = seen.select(F.array_distinct(F.array(*[F.left("word", F.lit(n)) for n in STEMS])).alias("all"), "toxic", "clean", "word")
    stems = stems.select(F.explode(F.filter("all", lambda x: F.length(x) >= min(STEMS))).alias("stem"), "toxic", "clean", "word")
    stems = stems.groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count(F.when(F.col("toxic") > 0, 1)).alias("forms")
    )
    good = (_surprise(F.col("toxic"), F.col("clean"), share) > least) & (F.col("clean") <= CLEAN * (F.col("toxic") + F.col("clean")))
    # what is collected has at most as many entries as the training rows have words that stand out
    found = {r.word: (r.toxic, r.clean) for r in seen.filter(good).collect()}
    found |= {r.stem + "*": (r.toxic, r.clean) for r in stems.filter(good & (F.col("forms") >= 3)).collect()}
    plain, ends = {e for e in found if e[-1] != "*"}, {e[:-1] for e in found if e[-1] == "*"}
    places = rows.filter("toxic = 1").select("text").mapInArrow(_uses(plain, ends), "entry string, place string")
    places = dict(places.distinct().groupBy("entry").count().collect())
    weights = {}
    for entry, (t, c) in found.items():
        support = min(t, places.get(entry, 0))
        p = support / (support + c) if support else 0.0
        gain = 0.0
        if p > share:
            gain = (support + c) * (p * math.log(p / share) + (1 - p) * math.log(max(1 - p, 1e-300) / (1 - share)))
        if gain > least:
            weights[entry] = min(8.0, math.log((support + 0.5) / (c + 0.5) * clean / toxic))
    stems = {e[:-1]: w for e, w in weights.items() if e[-1] == "*"}
    return Lexicon({e: w for e, w in weights.items() if e[-1] != "*"}, stems)


def prior_words(rows: DataFrame) -> dict[str, float]:
    """Insults known beforehand, but for those that clean training rows use."""
    words = F.array_intersect(F.split(F.lower("text"), r"[^\p{L}\p{N}']+"), F.array(*map(F.lit, INSULTS)))
    used = rows.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.avg(1 - F.col("toxic")).alias("clean"))
    refuted = {r.word for r in used.collect() if r.clean > CLEAN}
    return {w: 4.0 for w in INSULTS if w not in refuted}


def _threatened(lexicon: Lexicon):
    """The verbs that threaten in a text, each once."""

    def threatened(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches(rows):
            word, toxic = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = {w for found in reader.findings(text) for kind, w, _ in found if kind.startswith(THREAT)}
                word += sorted(own)
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])

    return threatened


def learn_threats(rows: DataFrame, lexicon: Lexicon) -> dict[str, float]:
    """Weights of threat verbs: logarithm of how much likelier toxic training rows threaten with them; 1 without any."""
    clean, toxic = (rows.agg(F.count(F.when(F.col("toxic") == i, 1))).first()[0] for i in (0, 1))
    if not toxic or not clean:
        return lexicon.threats
    used = rows.mapInArrow(_threatened(lexicon), "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    # at most a row for each verb of the list
    weights = {r.word: math.log((r.toxic * clean / toxic + math.e) / (r.clean + 1)) for r in used.collect()}
    return {w: min(8.0, max(0.1, weights.get(w, 1.0))) for w in lexicon.threats}


def _unexplained(lexicon: Lexicon):
    def left(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches(rows):
            yield batch.filter(pa.array([not reader.clauses(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return left


def _read(lexicon: Lexicon):
    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches(rows):
            x = [features(reader.clauses(t)).tolist() for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind), batch.column("toxic")], ["x", "toxic"])

    return read


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights from all labelled documents that are not held out."""
    rows = stage(training_rows(docs, labels), "training")
    lexicon, left = Lexicon(prior_words(rows), {}), rows
    for _ in range(ROUNDS):
        more = learn_lexicon(left)
        if not more.words and not more.stems:
            break
        lexicon = Lexicon(lexicon.words | more.words, more.stems | lexicon.stems)
        left = stage(rows.mapInArrow(_unexplained(lexicon), rows.schema), "unexplained")
    lexicon = replace(lexicon, threats=learn_threats(rows, lexicon))
    read = rows.mapInArrow(_read(lexicon), "x array<double>, toxic int").groupBy("x", "toxic").agg(F.count("*").alias("n"))
    weight, bias = fit_kinds(stage(read, "features"))
    return Model(lexicon, weight, bias)


def score(model: Model, text) -> Column:
    """Toxicity of a text column, 0 to 1; null is as the empty text."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.lexicon)
        for some in texts:
            yield pd.Series([model.score(reader.clauses(t or "")) for t in some], dtype="float64")

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """Score of each row of ``docs`` (doc_id, text and the columns ``keep``): keep, held_out, score, predicted.

    ``labels`` (doc_id, toxic) may be empty; then the prior lexicon and weights hold. A null id is not held out.
    """
    model = learn(docs, labels)
    rows = with_kept(docs, ["doc_id", "text"], keep)
    rows = rows.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("score", score(model, F.col("text")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    rows = rows.select(*[f"kept{i}" for i in range(len(keep))], "held_out", "score", predicted)
    return rows.toDF(*keep, "held_out", "score", "predicted")
