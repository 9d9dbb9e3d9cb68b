"""Text cleaning and splitting as column expressions."""

from __future__ import annotations

import html.entities
import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

REPEAT_SEP = "//@//"
PIPE_RE = r" *\| *"
_CONTROL = "".join(chr(c) for c in range(0x21))
_BASE = "abcdefghijklmnopqrstuvwxyz0123456789"


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str]:
    """Code points whose canonical decomposition holds one letter or digit of a-z, 0-9."""
    source, target = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.decomposition(ch):
            base = [c for c in unicodedata.normalize("NFD", ch) if c in _BASE]
            if len(base) == 1:
                source.append(ch)
                target.append(base[0])
    return "".join(source), "".join(target)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_control(s: Column | str) -> Column:
    """Trim every character up to U+0020 on both ends (Spark's ``trim`` takes spaces only)."""
    return F.btrim(_col(s), F.lit(_CONTROL))


def split_pipe(line: Column | str, limit: int = -1) -> Column:
    return F.split(trim_control(line), PIPE_RE, limit)


def fold(s: Column | str) -> Column:
    source, target = fold_table()
    return F.translate(F.lower(_col(s)), source, target)


def normalize_key(s: Column | str) -> Column:
    """Lower-case, fold accents, delete everything but a-z and 0-9."""
    return F.regexp_replace(fold(s), "[^a-z0-9]", "")


def record_key(id_: Column | str, database: Column | str) -> Column:
    """Id up to the first ``^`` (the language suffix) followed by the database, normalised."""
    return normalize_key(F.concat(F.substring_index(_col(id_), "^", 1), _col(database)))


def normalize_text(s: Column | str) -> Column:
    """Lower-case, fold accents, turn each run of other characters into one space."""
    unmarked = F.regexp_replace(fold(s), r"\p{M}+", "")
    return F.trim(F.regexp_replace(unmarked, r"[^\p{L}\p{N}]+", " "))


def cell_text(s: Column | str) -> Column:
    """Null to '', trim, broken encoding to ``????``, line breaks to a space."""
    text = trim_control(F.coalesce(_col(s), F.lit("")))
    valid = F.when(F.is_valid_utf8(text), text).otherwise(F.lit("????"))
    return F.regexp_replace(valid, "\n\r|\r\n|\n", " ")


def clean_cell(s: Column | str) -> Column:
    return F.replace(cell_text(s), F.lit("|"), F.lit(" "))


def valid_utf8(s: Column | str) -> Column:
    return F.is_valid_utf8(_col(s))


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def json_element(
    s: str, tags: tuple[str, ...] = ("text", "_f"), lang_tag: str = "_i", sep: str = REPEAT_SEP
) -> Column:
    """Text held by a JSON object or array of objects in column ``s``; other cells unchanged.

    The first tag with a non-empty string gives the text, prefixed ``(xx)`` when the
    object names its language. A tag holding something other than a string makes the
    object yield nothing.
    """

    def part(tag: str) -> str:
        return f"variant_get(e, {_quote(chr(36) + '[' + chr(34) + tag + chr(34) + ']')}, 'variant')"

    def is_string(tag: str) -> str:
        return f"schema_of_variant({part(tag)}) = 'STRING'"

    lang = f"cast({part(lang_tag)} as string)"
    picked = "cast(null as string)"
    for tag in reversed(tags):
        text = f"cast({part(tag)} as string)"
        tagged = (
            f"CASE WHEN {part(lang_tag)} IS NULL THEN {text} "
            f"WHEN {is_string(lang_tag)} THEN concat('(', lower(trim({lang})), ')', {text}) END"
        )
        picked = (
            f"CASE WHEN {part(tag)} IS NULL THEN {picked} "
            f"WHEN NOT {is_string(tag)} THEN cast(null as string) "
            f"WHEN {text} = '' THEN {picked} ELSE {tagged} END"
        )
    items = f"try_cast(try_parse_json(`{s}`) as array<variant>)"
    one = f"filter(transform(array(try_parse_json(`{s}`)), e -> {picked}), t -> t IS NOT NULL)"
    many = f"filter(transform({items}, e -> {picked}), t -> t IS NOT NULL)"
    joined = f"array_join({many}, {_quote(sep)})"
    return F.expr(
        f"CASE WHEN startswith(`{s}`, '[{{') THEN coalesce({joined}, `{s}`) "
        f"WHEN startswith(`{s}`, '{{') THEN coalesce(get({one}, 0), `{s}`) ELSE `{s}` END"
    )


def suffix_language(cells: Column, id_pos: int) -> Column:
    """Move the language of the first ``(xx)text`` cell to the id: ``id^xx``."""
    tagged = F.transform(cells, lambda c: c.rlike(r"^\([a-z][a-z]\).+$"))
    at = F.array_position(tagged, F.lit(True)) - 1
    lang = F.substring(F.get(cells, at), 2, 2)
    moved = F.transform(
        cells,
        lambda c, i: F.when(i == at, F.substr(c, F.lit(5)))
        .when(i == F.lit(id_pos), F.concat(c, F.lit("^"), lang))
        .otherwise(c),
    )
    return F.when(at < 0, cells).otherwise(moved)


def split_repeated(s: Column | str, sep: str = REPEAT_SEP) -> Column:
    """Values of a repetitive cell, trimmed; trailing empty values go, one value always stays."""
    literal = re.escape(sep)
    kept = F.regexp_replace(_col(s), f"(?:{literal})+$", "")
    return F.transform(F.split(kept, literal, -1), trim_control)


def join_repeated(values: Column | str, sep: str = REPEAT_SEP) -> Column:
    return F.concat_ws(sep, _col(values))


def fill_pattern(cells: Column | str) -> Column:
    return F.array_join(
        F.transform(_col(cells), lambda c: F.when(trim_control(c) == "", "0").otherwise("1")), ""
    )


def used_cells(cells: Column | str) -> Column:
    return F.size(F.filter(_col(cells), lambda c: trim_control(c) != ""))


def regexp_group(s: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(_col(s), pattern, group)


def char_ngrams(s: Column | str, n: int, pad: bool = True) -> Column:
    """Overlapping character n-grams in order, one per character when padded in front."""
    text = F.concat(F.lit("\u0001" * (n - 1)), _col(s)) if pad else _col(s)
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def year4(s: Column | str) -> Column:
    return F.substring(_col(s), 1, 4)


def author_fallback(first: Column | str, second: Column | str) -> Column:
    return F.coalesce(_col(first), _col(second))


def blank_address(s: Column | str) -> Column:
    return F.when(_col(s).isNull() | (_col(s) == "[]"), "").otherwise(_col(s))


def edit_link(base: str, id_: Column | str) -> Column:
    return F.concat(F.lit(base), _col(id_).cast("string"))


def prefixed_id(prefix: str, id_: Column | str) -> Column:
    return F.concat_ws("-", F.lit(prefix), _col(id_).cast("string"))


_ENTITY = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def _unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        name = m.group(1)
        if name[0] != "#":
            cp = html.entities.name2codepoint.get(name)
        else:
            cp = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        return chr(cp) if cp is not None and cp <= 0x10FFFF else m.group(0)

    return _ENTITY.sub(one, text)


def clean_query(s: Column | str) -> Column:
    """Resolve HTML entities, turn ``:`` into a space, trim."""

    @F.pandas_udf("string")
    def unescape(texts: pd.Series) -> pd.Series:
        return texts.map(_unescape, na_action="ignore")

    text = _col(s)
    # a function gets every row, whatever its result is used for: so only texts with an entity are handed to it
    resolved = F.coalesce(unescape(F.when(F.contains(text, F.lit("&")), text)), text)
    return trim_control(F.translate(resolved, ":", " "))


# Tasks get these helpers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
