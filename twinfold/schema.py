"""Match schemas: which column is what, how it is compared, and the decision tiers."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from dataclasses import dataclass
from itertools import combinations

KINDS = ("database", "id", "index", "ngram", "dice", "authors", "exact", "regexp", "carried")
COMPARED = ("ngram", "dice", "authors", "exact", "regexp")
EQUALITY = ("exact", "regexp")
DENY_DUP = "DENY_DUP"
MAX_SCORE = "MAX_SCORE"

# Element names of the rule-file format.
ELEMENT_KINDS = {
    "databaseField": "database",
    "idField": "id",
    "idxNGramField": "index",
    "nGramField": "ngram",
    "diceField": "dice",
    "authorsField": "authors",
    "exactField": "exact",
    "regExpField": "regexp",
    "noCompField": "carried",
    "NoCompareField": "carried",
}


@dataclass(frozen=True)
class Field:
    name: str
    pos: int
    kind: str
    min_score: float | None = None
    match: str | None = None
    required: str | None = None
    pattern: str | None = None
    group: int = 1


@dataclass(frozen=True)
class Tier:
    """A pair whose similarity reaches ``min_value`` needs ``min_fields`` matching fields."""

    min_value: float
    min_fields: int


@dataclass(frozen=True)
class MatchSchema:
    name: str
    tiers: tuple[Tier, ...]
    fields: tuple[Field, ...]
    ngram: int = 3
    author_score: float = 0.6

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: field names repeat")
        if len(self.of_kind("index")) != 1:
            raise ValueError(f"{self.name}: exactly one index field is needed")
        for f in self.fields:
            if f.kind not in KINDS:
                raise ValueError(f"{self.name}: unknown kind {f.kind}")
            if f.required and f.required not in names:
                raise ValueError(f"{self.name}: {f.name} requires unknown field {f.required}")

    def of_kind(self, *kinds: str) -> list[Field]:
        return [f for f in self.by_pos if f.kind in kinds]

    @property
    def by_pos(self) -> list[Field]:
        return sorted(self.fields, key=lambda f: f.pos)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.by_pos]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def index_field(self) -> Field:
        return self.of_kind("index")[0]

    @property
    def id_field(self) -> Field:
        return self.of_kind("id")[0]

    @property
    def database_field(self) -> Field:
        return self.of_kind("database")[0]

    @property
    def compared(self) -> list[Field]:
        return self.of_kind(*COMPARED)

    @property
    def equality(self) -> list[Field]:
        return self.of_kind(*EQUALITY)

    @property
    def max_pos(self) -> int:
        return max(f.pos for f in self.fields)

    @property
    def min_fields(self) -> int:
        return min(t.min_fields for t in self.tiers)

    @property
    def floor(self) -> float:
        return min(t.min_value for t in self.tiers)

    @property
    def ordered_tiers(self) -> list[Tier]:
        """File order decides the tier; files list the highest first."""
        return list(self.tiers)

    def checked(self, every_field: bool = False) -> list[Field]:
        """Fields whose position and required field a line is checked for."""
        return list(self.by_pos) if every_field else self.of_kind("index", "ngram", *EQUALITY)

    def equality_subsets(self, tier: Tier) -> list[tuple[Field, ...]]:
        """A duplicate of this tier agrees on at least one of these field sets.

        Of the compared fields, those that are not equality fields can supply at
        most ``c - e`` matches, so ``min_fields - (c - e)`` equality fields must
        match. An empty list means equality alone promises nothing.
        """
        needed = tier.min_fields - (len(self.compared) - len(self.equality))
        if needed < 1:
            return []
        return list(combinations(self.equality, needed))

    def certain_sets(self) -> list[tuple[tuple[Field, ...], bool]]:
        """Equality field sets that make any two records with equal, filled values in
        them duplicates, whatever else they hold; the flag says whether the index field
        has to be equal too.
        """
        deny = [f for f in self.compared if f.match == DENY_DUP]
        if any(f not in self.equality for f in deny):
            return []
        out = []
        reached = [t for t in self.ordered_tiers if t.min_value <= 1.0]
        if reached:
            out += [(s, True) for s in self._sets_with(deny, reached[0].min_fields)]
        if self.floor <= 0:
            strict = [f for f in self.compared if f.match in (DENY_DUP, MAX_SCORE)]
            if all(f in self.equality for f in strict):
                need = max(t.min_fields for t in self.tiers)
                out += [(s, False) for s in self._sets_with(strict, need) if s]
        return out

    def _sets_with(self, must: list[Field], size: int) -> list[tuple[Field, ...]]:
        rest = [f for f in self.equality if f not in must]
        more = max(0, size - len(must))
        return [(*must, *extra) for extra in combinations(rest, more)]


def _field(kind: str, attrs: dict, default_name: str) -> Field:
    return Field(
        name=attrs.get("name") or default_name,
        pos=int(attrs["pos"]),
        kind=kind,
        min_score=float(attrs["minScore"]) if attrs.get("minScore") else None,
        match=attrs.get("match") or None,
        required=attrs.get("requiredField") or None,
        pattern=attrs.get("pattern") or None,
        group=int(attrs.get("groupNum") or 1),
    )


def load_rules(text: str, name: str = "rules", **options) -> MatchSchema:
    """Read a rule file, XML or JSON, into a :class:`MatchSchema` on the driver."""
    if text.lstrip().startswith("{"):
        return _from_json(json.loads(text), name, options)
    tiers, fields = [], []
    for el in ET.fromstring(text.strip()):
        if el.tag == "score":
            if el.get("minFields") is not None:
                tiers.append(Tier(float(el.get("minValue")), int(el.get("minFields"))))
        elif el.tag in ELEMENT_KINDS:
            kind = ELEMENT_KINDS[el.tag]
            fields.append(_field(kind, dict(el.attrib), kind))
    return MatchSchema(name, tuple(tiers), tuple(fields), **options)


def _from_json(doc: dict, name: str, options: dict) -> MatchSchema:
    tiers = tuple(
        Tier(float(s["minValue"]), int(s["minFields"])) for s in doc["score"] if s.get("minFields") is not None
    )
    fields = []
    for p in doc["params"]:
        attrs = {k: str(v).strip() for k, v in p.items() if v is not None}
        label = attrs.get("name", "")
        kind = label if label in ("id", "database") else ELEMENT_KINDS.get(attrs.get("type", ""), "carried")
        fields.append(_field(kind, attrs, label))
    return MatchSchema(doc.get("name", name), tiers, tuple(fields), **options)


# The rule sets in use, one row per record type.
# name: (tiers, index field, compared and carried fields in position order from 3)
# Only the name of the last carried field, a link, is a neutral one.
_PAGE = r"e?(\d+)"
_NEED = "titulo_revista"
_TAIL = [("centro_colaborador",), ("tipo_literatura",), ("nivel_de_tratamento",), ("status",),
         ("endereco_eletronico",), ("link",)]
_PRESETS = {
    "article_eight": (
        [(0.9, 4), (0.7, 5), (0.5, 6), (0.4, 7)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("autores", "authors", {"match": DENY_DUP}),
         ("volume_fasciculo", "exact", {"required": _NEED}),
         ("numero_fasciculo", "exact", {"required": _NEED}),
         ("pagina_inicial", "regexp", {"required": _NEED, "pattern": _PAGE}),
         ("ano_publicacao", "exact", {}),
         ("doi", "exact", {})]),
    "article_five_doi": (
        [(0.9, 3), (0.6, 4)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("autores", "authors", {}),
         ("ano_publicacao", "exact", {"match": MAX_SCORE}),
         ("doi", "exact", {"match": MAX_SCORE})]),
    "abstract_three": (
        [(0.95, 1), (0.75, 2)], "titulo_artigo",
        [("resumo", "dice", {"min_score": 0.65}),
         ("autores", "authors", {})]),
    "article_two": (
        [(0.6, 1)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("autores",), ("ano_publicacao",), ("doi",)]),
    "event_three": (
        [(1.0, 1), (0.7, 2)], "titulo",
        [("data_inicio", "regexp", {"pattern": r"(\d\d\d\d-\d\d-\d\d)"}),
         ("url", "exact", {})]),
    "monograph_four": (
        [(0.95, 2), (0.8, 3)], "titulo_monografico",
        [("ano_publicacao", "exact", {}),
         ("autores", "ngram", {"min_score": 0.6}),
         ("pagina_inicial", "regexp", {"match": MAX_SCORE, "pattern": _PAGE}),
         ("volume",), ("numero",)]),
    "chapter_five": (
        [(0.9, 3), (0.8, 4)], "titulo_analitica",
        [("titulo_monografico", "ngram", {"min_score": 0.6}),
         ("ano_publicacao", "exact", {}),
         ("autores", "ngram", {"min_score": 0.6}),
         ("pagina_inicial", "regexp", {"match": MAX_SCORE, "pattern": _PAGE}),
         ("volume",), ("numero",), _TAIL[0], ("tipo_de_literatura",), *_TAIL[2:]]),
    "article_five": (
        [(0.95, 3), (0.8, 4)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("ano_publicacao", "exact", {"required": _NEED}),
         ("volume_fasciculo", "exact", {"required": _NEED}),
         ("numero_fasciculo", "exact", {"required": _NEED})]),
    "article_seven": (
        [(0.9, 5), (0.7, 6)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("ano_publicacao", "exact", {"required": _NEED, "match": DENY_DUP}),
         ("volume_fasciculo", "exact", {"required": _NEED, "match": DENY_DUP}),
         ("numero_fasciculo", "exact", {"required": _NEED, "match": DENY_DUP}),
         ("autores", "authors", {"match": MAX_SCORE}),
         ("pagina_inicial", "regexp", {"required": _NEED, "match": DENY_DUP, "pattern": _PAGE}),
         *_TAIL]),
    "issue_four": (
        [(0.6, 4)], "titulo_revista",
        [("ISSN", "exact", {"match": MAX_SCORE}),
         ("volume_fasciculo", "exact", {"match": DENY_DUP}),
         ("numero_fasciculo", "exact", {"match": DENY_DUP}),
         ("ano_publicacao", "regexp", {"match": DENY_DUP, "pattern": r"(\d\d\d\d)"})]),
    "issue_two": (
        [(0.75, 2)], "titulo_revista",
        [("volume_fasciculo", "exact", {"match": DENY_DUP}),
         ("numero_fasciculo", "exact", {"match": DENY_DUP})]),
    "article_three": (
        [(1.0, 1), (0.8, 2)], "titulo_artigo",
        [("titulo_revista", "ngram", {"min_score": 0.6}),
         ("ano_publicacao", "exact", {"required": _NEED, "match": DENY_DUP})]),
    "resource_two": (
        [(1.0, 0), (0.0, 1)], "titulo",
        [("url", "exact", {})]),
}


def preset_names() -> list[str]:
    return list(_PRESETS)


def preset(name: str, **options) -> MatchSchema:
    tiers, index, rest = _PRESETS[name]
    fields = [Field("database", 0, "database"), Field("id", 1, "id"), Field(index, 2, "index")]
    for pos, (label, *how) in enumerate(rest, start=3):
        kind, attrs = how if how else ("carried", {})
        fields.append(Field(label, pos, kind, **attrs))
    return MatchSchema(name, tuple(Tier(*t) for t in tiers), tuple(fields), **options)
