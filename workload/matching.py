"""Candidate, comparison, verdict and whole-check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.functions import compare as cmp
from twinfold.functions.similarity import SLACK, dice, ngram_similarity_col
from twinfold.functions.text import normalize_key, normalize_text, regexp_group
from twinfold.operators import blocking, dedup
from twinfold.operators.explain import explain_pairs, pair_up, score_pairs
from twinfold.operators.pairs import dedup_pairs
from twinfold.operators.similar import similar_docs_detail, similar_field_topk
from twinfold.plans import jobs
from twinfold.schema import DENY_DUP, MAX_SCORE, Field, MatchSchema, Tier
from twinfold.session import stage
from twinfold.sources.match_index import build_match_index, open_match_index
from twinfold.sources.report import read_dup_report, report_lines, write_dup_report
from workload.fields import LINES, SQL_CHECKED
from workload.registry import query, recursive, scratch, sql_bigrams, sql_key, sql_rec_key, sql_similarity, sql_text
from workload.views import table, view, with_views

_HEAD = (Field("database", 0, "database"), Field("id", 1, "id"), Field("title", 2, "index"))
PAGE = r"e?(\d+)"

# equality and dice fields under equal titles: every outcome can be computed in SQL
EQUAL_TITLES = MatchSchema(
    "equal_titles", (Tier(1.0, 2),),
    (*_HEAD, Field("journal", 3, "exact"),
     Field("year", 4, "exact", required="journal", match=DENY_DUP),
     Field("authors", 5, "carried"),
     Field("page", 6, "regexp", pattern=PAGE, required="journal"),
     Field("abstract", 7, "dice", min_score=0.65)))
# the same fields under similar titles
SIMILAR_TITLES = MatchSchema(
    "similar_titles", (Tier(0.9, 2), Tier(0.7, 4)),
    (*_HEAD, Field("journal", 3, "ngram", min_score=0.6),
     Field("year", 4, "exact", required="journal"),
     Field("authors", 5, "authors"),
     Field("page", 6, "regexp", pattern=PAGE, required="journal", match=MAX_SCORE),
     Field("abstract", 7, "dice", min_score=0.65)))
TITLES = MatchSchema("titles", (Tier(0.9, 0),), _HEAD)
EQUALITIES = MatchSchema(
    "equalities", (Tier(0.9, 2),),
    (*_HEAD, Field("journal", 3, "exact"), Field("year", 4, "exact"), Field("page", 5, "regexp", pattern=PAGE)))


def _sql_prep(name: str) -> str:
    """Comparable values of a view's records under EQUAL_TITLES."""
    return f"""{name}_p AS MATERIALIZED (SELECT *, {sql_bigrams('ab')} AS g FROM (SELECT *, {sql_rec_key()} AS rec_key, {sql_text('title')} AS t, {sql_key('journal')} AS vj,
        CASE WHEN trim(journal) = '' THEN '' ELSE {sql_key('year')} END AS vy,
        CASE WHEN trim(journal) = '' THEN '' ELSE {sql_key("regexp_extract(page, 'e?(\\d+)', 1)")} END AS vp,
        {sql_text('abstract')} AS ab FROM {name}))"""


_DICE = """CASE WHEN a.ab = '' OR b.ab = '' THEN 0.0::DOUBLE WHEN a.ab = b.ab THEN 1.0::DOUBLE
    WHEN len(a.g) + len(b.g) = 0 THEN 0.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g)) END"""


def _sql_status(x: str, miss: str = "NO_MATCH") -> str:
    return f"CASE WHEN a.{x} = '' OR b.{x} = '' THEN 'IGNORED' WHEN a.{x} = b.{x} THEN 'MATCH' ELSE '{miss}' END"


def _sql_scored(a: str, b: str, on: str) -> str:
    """Pairs of prepared rows with statuses, matched fields and verdict."""
    return f"""(SELECT *, (CASE WHEN sj = 'MATCH' THEN 1 ELSE 0 END) + (CASE WHEN sy = 'MATCH' THEN 1 ELSE 0 END)
            + (CASE WHEN sp = 'MATCH' THEN 1 ELSE 0 END) + (CASE WHEN sa = 'MATCH' THEN 1 ELSE 0 END) AS matched
        FROM (SELECT *, CASE WHEN ab_1 = '' OR ab_2 = '' THEN 'IGNORED' WHEN da >= 0.65 - 1e-6 THEN 'MATCH' ELSE 'NO_MATCH' END AS sa
        FROM (SELECT a.rec_key AS rec_key_1, b.rec_key AS rec_key_2, a.title AS title_1, b.title AS title_2,
            a.t AS t_1, b.t AS t_2, a.vj AS vj_1, b.vj AS vj_2, a.vy AS vy_1, b.vy AS vy_2, a.vp AS vp_1, b.vp AS vp_2,
            a.ab AS ab_1, b.ab AS ab_2,
            {_sql_status('vj')} AS sj, {_sql_status('vy', 'DENIED')} AS sy, {_sql_status('vp')} AS sp, {_DICE} AS da
        FROM {a} a JOIN {b} b ON {on})))"""


_DUP = "t_1 <> '' AND t_1 = t_2 AND sy <> 'DENIED' AND matched >= 2"
_SELF = "a.t = b.t AND a.rec_key <> b.rec_key"
_SHOWN = ["rec_key_1", "rec_key_2", "title_1", "title_2", "journal_status", "year_status", "page_status",
          "abstract_score", "abstract_status", "similarity", "matched_fields"]


def _report(df):
    return df.withColumn("abstract_score", F.round("abstract_score", 6)).select(*_SHOWN)


_SHOWN_SQL = """rec_key_1, rec_key_2, title_1, title_2, sj AS journal_status, sy AS year_status, sp AS page_status,
    round(da, 6) AS abstract_score, sa AS abstract_status, 1.0::DOUBLE AS similarity, matched AS matched_fields"""

# contents: one row per comparable content, shown by its smallest key
_CONTENT = """SELECT min(rec_key) AS rec_key, max(rec_key) AS last_key, arg_min(title, rec_key) AS title,
    t, vj, vy, vp, ab, any_value(g) AS g FROM {}_p GROUP BY t, vj, vy, vp, ab"""
# records equal in title, year and one more of journal or page are certain duplicates: each is shown with the first such
# record only
_SAME_JY = "(a.vj = b.vj AND a.vj <> '' AND a.vy = b.vy AND a.vy <> '')"
_SAME_YP = "(a.vp = b.vp AND a.vp <> '' AND a.vy = b.vy AND a.vy <> '')"
_FIRST_JY = "min(rec_key) FILTER (vj <> '' AND vy <> '') OVER (PARTITION BY t, vj, vy)"
_FIRST_YP = "min(rec_key) FILTER (vp <> '' AND vy <> '') OVER (PARTITION BY t, vp, vy)"
_SELF_REPORT = f"""
    SELECT {_SHOWN_SQL} FROM {_sql_scored('rec_c', 'rec_c',
        f"""a.t = b.t AND a.rec_key < b.rec_key AND (NOT ({_SAME_JY} OR {_SAME_YP})
            OR ({_SAME_JY} AND a.rec_key = b.first_jy) OR ({_SAME_YP} AND a.rec_key = b.first_yp))""")} WHERE {_DUP}
    UNION ALL
    SELECT {_SHOWN_SQL} FROM {_sql_scored('rec_c', 'rec_p',
        'a.t = b.t AND a.vj = b.vj AND a.vy = b.vy AND a.vp = b.vp AND a.ab = b.ab AND a.rec_key < b.rec_key')}
    WHERE {_DUP}"""
_REC_PREP = f"""WITH {_sql_prep('rec')}, rec_c AS MATERIALIZED (
    SELECT *, {_FIRST_JY} AS first_jy, {_FIRST_YP} AS first_yp FROM ({_CONTENT.format('rec')}))"""


def _dup_keys_sql(pairs: str) -> str:
    return f"(SELECT rec_key_1 FROM {pairs} WHERE {_DUP} UNION SELECT rec_key_2 FROM {pairs} WHERE {_DUP})"


_SELF_PAIRS = _sql_scored("rec_p", "rec_p", _SELF)
_INDEX_PAIRS = _sql_scored("page_rec_p", "rec_p", _SELF)
_PAGE_PAIRS = _sql_scored("page_rec_p", "page_rec_p", _SELF)
_BOTH_PREP = f"WITH {_sql_prep('rec')}, {_sql_prep('page_rec')}"


def _rec(spark, sf):
    return dedup.with_key(view(spark, sf, "rec"), EQUAL_TITLES)


def _pages(spark, sf):
    return dedup.with_key(view(spark, sf, "page_rec"), EQUAL_TITLES)


# --- candidates -----------------------------------------------------------------------------

_T9 = "floor(length(t) * (3 * (1 - 0.9::DOUBLE)) + 1e-6)"


def _sql_titles(name: str, values: str = "") -> str:
    return f"""{name}_t AS (SELECT min({sql_rec_key()}) AS rec_key, t {values},
        list_distinct([concat(chr(1), chr(1), t)[i:i+2] for i in range(1, length(t) + 1)]) AS g
        FROM (SELECT *, {sql_text('title')} AS t, {sql_key('journal')} AS vj, {sql_key('year')} AS vy,
              {sql_key("regexp_extract(page, 'e?(\\d+)', 1)")} AS vp FROM {name}) WHERE t <> '' GROUP BY t {values})"""


_CLOSE = """least(length(a.t), length(b.t)) >= greatest(length(a.t), length(b.t)) * 0.9::DOUBLE - 1e-6"""
_ENOUGH = """len(a.g) - shared <= floor(length(a.t) * (3 * (1 - 0.9::DOUBLE)) + 1e-6)
    AND len(b.g) - shared <= floor(length(b.t) * (3 * (1 - 0.9::DOUBLE)) + 1e-6)"""


def _sql_candidates(left: str, right: str, extra: str) -> str:
    return f"""SELECT a.rec_key AS rec_key_1, b.rec_key AS rec_key_2, shared FROM (
        SELECT a, b, len(list_intersect(a.g, b.g)) AS shared FROM {left}_t a JOIN {right}_t b ON {_CLOSE} AND {extra})
        WHERE shared > 0 AND {_ENOUGH}"""


def _contents(df, schema):
    return stage(dedup.contents(dedup.comparable_rows(df, schema), schema), "contents")


_INDEXES: dict[tuple, str] = {}


def _stored(spark, sf, schema):
    """The match index of the records, built once in a session, as checks are many and the index is one."""
    at = (spark.sparkContext.applicationId, sf, schema.name)
    if at not in _INDEXES:
        path = scratch(spark, "match_index")
        build_match_index(_rec(spark, sf), schema, path)
        _INDEXES[at] = path
    return open_match_index(spark, _INDEXES[at])


def _shared(left, right, schema, pairs=None):
    if pairs is None:
        return blocking.near_titles(left, None if right is left else right, schema, 0.9).toDF("rec_key_1", "rec_key_2", "shared")
    found = blocking.shared_grams(pairs, left, right, schema, 0.9)
    one = left.select(F.col("content_id").alias("content_1"), F.col("first_key").alias("rec_key_1"))
    two = right.select(F.col("content_id").alias("content_2"), F.col("first_key").alias("rec_key_2"))
    return found.join(one, "content_1").join(two, "content_2").select("rec_key_1", "rec_key_2", "shared")


def _ordered(df):
    return df.select(F.least("rec_key_1", "rec_key_2").alias("rec_key_1"),
                     F.greatest("rec_key_1", "rec_key_2").alias("rec_key_2"), "shared")


_SELF_TITLES = with_views(f"WITH {_sql_titles('rec')} {_sql_candidates('rec', 'rec', 'a.rec_key < b.rec_key')}", "rec")


@query("J04_candidates_self", _SELF_TITLES)
def _(spark, sf):
    left = _contents(_rec(spark, sf), TITLES)
    return _ordered(_shared(left, left, TITLES))


@query("A07_shared_gram_count", with_views(
    f"WITH {_sql_titles('rec')}, found AS ({_sql_candidates('rec', 'rec', 'a.rec_key < b.rec_key')}) "
    "SELECT shared, count(*) AS pairs FROM found GROUP BY shared", "rec"))
def _(spark, sf):
    left = _contents(_rec(spark, sf), TITLES)
    return _shared(left, left, TITLES).groupBy("shared").agg(F.count("*").alias("pairs"))


@query("J05_candidates_index", with_views(
    f"WITH {_sql_titles('rec')}, {_sql_titles('page_rec')} {_sql_candidates('page_rec', 'rec', 'true')}", "rec", "page_rec"))
def _(spark, sf):
    left, index = _contents(_pages(spark, sf), TITLES), _stored(spark, sf, TITLES)
    return _shared(left, index.contents, TITLES, blocking.probe_blocks(left, index.blocks, TITLES, counted=0.9))


def _same(*names: str) -> str:
    return " AND ".join(f"a.{n} = b.{n} AND a.{n} <> ''" for n in names)


def _first_of(*names: str) -> str:
    filled = " AND ".join(f"{n} <> ''" for n in names)
    return f"min(rec_key) FILTER ({filled}) OVER (PARTITION BY t, {', '.join(names)}) AS first_{''.join(names)}"


_TWO = [("vj", "vy"), ("vj", "vp"), ("vy", "vp")]
_TWO_EQUAL = "a.rec_key < b.rec_key AND (" + " OR ".join(
    f"({_same(*two)} AND (a.t <> b.t OR a.rec_key = b.first_{''.join(two)}))" for two in _TWO) + ")"


@query("J06_candidates_equality", with_views(
    f"WITH {_sql_titles('rec', ', vj, vy, vp').replace('rec_t AS', 'all_t AS')}, "
    f"rec_t AS (SELECT *, {', '.join(_first_of(*two) for two in _TWO)} FROM all_t) "
    f"{_sql_candidates('rec', 'rec', _TWO_EQUAL)}", "rec"))
def _(spark, sf):
    left = _contents(_rec(spark, sf), EQUALITIES)
    return _ordered(_shared(left, left, EQUALITIES))


# --- comparators over record pairs ----------------------------------------------------------

_PARTNER = """partner AS (SELECT *, min(rec_key) OVER (PARTITION BY journal, year) AS other FROM rec_p)"""
_PARTNERED = f"WITH {_sql_prep('rec')}, {_PARTNER}"
_STAR = "a.rec_key = b.other AND a.rec_key <> b.rec_key"


def _star(spark, sf, by=("journal", "year")):
    """Each record with the first record that agrees with it on ``by``."""
    rec = _rec(spark, sf)
    names = EQUAL_TITLES.names
    first = rec.groupBy(*by).agg(F.min(F.struct("rec_key", *names)).alias("one"))
    pairs = rec.select(*by, F.struct("rec_key", *names).alias("two")).join(first, list(by))
    pairs = pairs.where("one.rec_key <> two.rec_key").select(
        F.col("one.rec_key").alias("rec_key_1"), F.col("two.rec_key").alias("rec_key_2"),
        *[F.col(f"{s}.{n}").alias(f"{n}_{i}") for n in names for i, s in ((1, "one"), (2, "two"))])
    # a pair costs far more than its bytes: the pairs of a group are dealt to all tasks, which stay as many
    return pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rec_key_2", "rec_key_1")


def _star_similarity(a: str, b: str, columns: str) -> str:
    """Oracle over the star's pairs with the similarity of two of their texts."""
    pairs = f"SELECT a.rec_key AS rec_key_1, b.rec_key AS rec_key_2, {a} AS a, {b} AS b FROM rec_p a JOIN partner b ON {_STAR}"
    return recursive(with_views(
        f"{_PARTNERED}, pairs AS MATERIALIZED ({pairs}), {sql_similarity('SELECT a, b FROM pairs')} "
        f"SELECT rec_key_1, rec_key_2, {columns} FROM pairs JOIN near USING (a, b)", "rec"))


def _status_sql(least: float) -> str:
    return f"CASE WHEN a = '' OR b = '' THEN 'IGNORED' WHEN sim >= {least} - 1e-6 THEN 'MATCH' ELSE 'NO_MATCH' END AS status"


@query("M01_ngram_similarity", _star_similarity("a.t", "b.t", "round(sim, 6) AS similarity"))
def _(spark, sf):
    t1, t2 = normalize_text("title_1"), normalize_text("title_2")
    return _star(spark, sf).select("rec_key_1", "rec_key_2", F.round(ngram_similarity_col(t1, t2), 6).alias("similarity"))


@query("M02_cmp_ngram", _star_similarity("a.t", "b.t", _status_sql(0.6)))
def _(spark, sf):
    t1, t2 = normalize_text("title_1"), normalize_text("title_2")
    sims = _star(spark, sf).select("rec_key_1", "rec_key_2", t1.alias("a"), t2.alias("b"), ngram_similarity_col(t1, t2).alias("s"))
    field = Field("title", 2, "ngram", min_score=0.6)
    status = cmp.status(field, F.col("a"), F.col("b"), F.col("s") >= 0.6 - SLACK)
    return sims.select("rec_key_1", "rec_key_2", status.alias("status"))


def _star_sql(columns: str) -> str:
    return with_views(f"{_PARTNERED} SELECT rec_key_1, rec_key_2, {columns} FROM {_sql_scored('rec_p', 'partner', _STAR)}", "rec")


@query("M03_cmp_dice", _star_sql("round(da, 6) AS score, sa AS status"))
def _(spark, sf):
    a, b = normalize_text("abstract_1"), normalize_text("abstract_2")
    pairs = _star(spark, sf).select("rec_key_1", "rec_key_2", a.alias("a"), b.alias("b"))
    empty = (F.col("a") == "") | (F.col("b") == "")
    scored = pairs.withColumn("score", F.when(empty, F.lit(0.0)).otherwise(dice("a", "b")))
    field = EQUAL_TITLES.field("abstract")
    status = cmp.status(field, F.col("a"), F.col("b"), F.col("score") >= 0.65 - 1e-6)
    return scored.select("rec_key_1", "rec_key_2", F.round("score", 6).alias("score"), status.alias("status"))


@query("M04_cmp_exact", _star_sql("sj AS journal_status, sy AS year_status"))
def _(spark, sf):
    pairs = _star(spark, sf)
    out = []
    for name in ("journal", "year"):
        a, b = normalize_key(f"{name}_1"), normalize_key(f"{name}_2")
        out.append(cmp.status(EQUAL_TITLES.field(name), a, b, a == b).alias(f"{name}_status"))
    return pairs.select("rec_key_1", "rec_key_2", *out)


@query("M05_cmp_regexp", _star_sql("sp AS page_status"))
def _(spark, sf):
    a, b = (normalize_key(regexp_group(f"page_{i}", PAGE)) for i in (1, 2))
    return _star(spark, sf).select(
        "rec_key_1", "rec_key_2", cmp.status(EQUAL_TITLES.field("page"), a, b, a == b).alias("page_status"))


_FIRST_AUTHOR = "split_part({}.authors, '//@//', 1)"


@query("M06_cmp_authors", _star_similarity(
    sql_text(_FIRST_AUTHOR.format("a")), sql_text(_FIRST_AUTHOR.format("b")), f"round(CASE WHEN a = '' OR b = '' THEN 0 ELSE sim END, 6) AS score, {_status_sql(0.6)}"))
def _(spark, sf):
    a, b = (normalize_text(cmp.first_author(F.col(f"authors_{i}"))) for i in (1, 2))
    pairs = _star(spark, sf).select("rec_key_1", "rec_key_2", a.alias("a"), b.alias("b"))
    empty = (F.col("a") == "") | (F.col("b") == "")
    scored = pairs.withColumn("score", F.when(empty, F.lit(0.0)).otherwise(ngram_similarity_col("a", "b")))
    field = SIMILAR_TITLES.field("authors")
    status = cmp.status(field, F.col("a"), F.col("b"), F.col("score") >= 0.6 - 1e-6)
    return scored.select("rec_key_1", "rec_key_2", F.round("score", 6).alias("score"), status.alias("status"))


def _scored_star(spark, sf):
    return score_pairs(_star(spark, sf), EQUAL_TITLES, exact=False)


@query("M07_carry_field", with_views(f"""{_REC_PREP}
    SELECT r.rec_key_1, r.rec_key_2, x.authors AS authors_1, y.authors AS authors_2, NULL::DOUBLE AS authors_score,
        'NOT_COMPARED' AS authors_status
    FROM ({_SELF_REPORT}) r JOIN rec x ON {sql_rec_key('x.id', 'x.database')} = rec_key_1
    JOIN rec y ON {sql_rec_key('y.id', 'y.database')} = rec_key_2""", "rec"))
def _(spark, sf):
    report = jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").report
    return report.select("rec_key_1", "rec_key_2", "authors_1", "authors_2", "authors_score", "authors_status")


_STATUSES = "sj AS journal_status, sy AS year_status, sp AS page_status, sa AS abstract_status"
_STATUS_COLS = [F"status_{n}" for n in ("journal", "year", "page", "abstract")]


@query("M08_match_policy", _star_sql(_STATUSES))
def _(spark, sf):
    return _scored_star(spark, sf).select(
        "rec_key_1", "rec_key_2", *[F.col(c).alias(f"{c[7:]}_status") for c in _STATUS_COLS])


@query("M09_tier_min_fields", """
    SELECT o_orderkey, value, CASE WHEN value >= 0.9 - 1e-6 THEN 2 WHEN value >= 0.7 - 1e-6 THEN 4 END AS min_fields
    FROM (SELECT o_orderkey, round(o_totalprice / 500000, 4) AS value FROM orders)""")
def _(spark, sf):
    values = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.round(F.col("o_totalprice") / 500000, 4).alias("value"))
    return values.withColumn("min_fields", cmp.tier_min_fields(SIMILAR_TITLES, F.col("value")))


@query("M10_verdict", _star_sql(f"matched AS matched_fields, ({_DUP}) AS duplicate"))
def _(spark, sf):
    return _scored_star(spark, sf).select("rec_key_1", "rec_key_2", "matched_fields", "duplicate")


@query("M11_score_pairs", _star_sql(f"{_STATUSES}, round(da, 6) AS abstract_score, matched AS matched_fields, "
                                    f"({_DUP}) AS duplicate, t_1 = t_2 AS same_title"))
def _(spark, sf):
    return _scored_star(spark, sf).select(
        "rec_key_1", "rec_key_2", *[F.col(c).alias(f"{c[7:]}_status") for c in _STATUS_COLS],
        F.round("score_abstract", 6).alias("abstract_score"), "matched_fields", "duplicate",
        (F.col("similarity") >= 1.0).alias("same_title"))


# pairs of records with the same authors under SIMILAR_TITLES
_OTHER = "other AS (SELECT *, min(rec_key) OVER (PARTITION BY authors) AS first_key FROM rec_p)"
_SIMILAR_PAIRS = f"""pairs AS MATERIALIZED (SELECT a.rec_key AS rec_key_1, b.rec_key AS rec_key_2, a.t AS t_1, b.t AS t_2,
        {sql_text('a.journal')} AS j_1, {sql_text('b.journal')} AS j_2,
        {sql_text(_FIRST_AUTHOR.format('a'))} AS a_1, {sql_text(_FIRST_AUTHOR.format('b'))} AS a_2,
        {_sql_status('vy')} AS sy, {_sql_status('vp', 'NEEDS_MAX')} AS sp,
        CASE WHEN a.ab = '' OR b.ab = '' THEN 'IGNORED' WHEN {_DICE} >= 0.65 - 1e-6 THEN 'MATCH' ELSE 'NO_MATCH' END AS sa
    FROM rec_p a JOIN other b ON a.rec_key = b.first_key AND a.rec_key <> b.rec_key)"""
_SIMILAR_TEXTS = "SELECT t_1 AS a, t_2 AS b FROM pairs UNION SELECT j_1, j_2 FROM pairs UNION SELECT a_1, a_2 FROM pairs"


def _near_status(one: str, two: str, sim: str) -> str:
    return f"CASE WHEN {one} = '' OR {two} = '' THEN 'IGNORED' WHEN {sim} >= 0.6 - 1e-6 THEN 'MATCH' ELSE 'NO_MATCH' END"


_SIMILAR_SQL = f"""WITH {_sql_prep('rec')}, {_OTHER}, {_SIMILAR_PAIRS}, {sql_similarity(_SIMILAR_TEXTS)},
    told AS (SELECT *, (sj = 'MATCH')::INT + (sy = 'MATCH')::INT + (su = 'MATCH')::INT + (sp = 'MATCH')::INT + (sa = 'MATCH')::INT AS matched,
            CASE WHEN similarity >= 0.9 - 1e-6 THEN 2 WHEN similarity >= 0.7 - 1e-6 THEN 4 END AS least
        FROM (SELECT pairs.*, n1.sim AS similarity, {_near_status('j_1', 'j_2', 'n2.sim')} AS sj, {_near_status('a_1', 'a_2', 'n3.sim')} AS su
            FROM pairs JOIN near n1 ON n1.a = t_1 AND n1.b = t_2 JOIN near n2 ON n2.a = j_1 AND n2.b = j_2
            JOIN near n3 ON n3.a = a_1 AND n3.b = a_2)),
    judged AS (SELECT *, coalesce(t_1 <> '' AND t_2 <> '' AND matched >= least AND (sp <> 'NEEDS_MAX' OR similarity >= 1), false) AS duplicate FROM told)"""


@query("M11_score_pairs_similar", recursive(with_views(f"""{_SIMILAR_SQL}
    SELECT rec_key_1, rec_key_2, round(similarity, 6) AS similarity, matched AS matched_fields, least AS min_fields, duplicate
    FROM judged""", "rec")))
def _(spark, sf):
    scored = score_pairs(_star(spark, sf, ("authors",)), SIMILAR_TITLES)
    return scored.select("rec_key_1", "rec_key_2", F.round("similarity", 6).alias("similarity"),
                         "matched_fields", "min_fields", "duplicate")


@query("M12_explain_pair", recursive(with_views(f"""{_SIMILAR_SQL}
    SELECT rec_key_1 AS key_1, rec_key_2 AS key_2, duplicate, CASE WHEN duplicate THEN 'duplicate' WHEN least IS NULL THEN 'below_tiers'
        WHEN sp = 'NEEDS_MAX' AND similarity < 1 THEN 'not_identical' ELSE 'too_few_fields' END AS reason,
        concat_ws(' ', sj, sy, su, sp, sa) AS statuses FROM judged""", "rec")))
def _(spark, sf):
    rec = _rec(spark, sf)
    requests = _star(spark, sf, ("authors",)).select(F.col("rec_key_1").alias("key_1"), F.col("rec_key_2").alias("key_2"))
    explained = explain_pairs(pair_up(requests, rec, rec, SIMILAR_TITLES), SIMILAR_TITLES)
    return explained.select("key_1", "key_2", "duplicate", "reason", F.array_join("fields.status", " ").alias("statuses"))


# --- nearest texts --------------------------------------------------------------------------

# the texts to look for are all benchmark items, against all records
_ASKED = "asked AS (SELECT item_id AS query, text FROM benchmark)"
_NEAREST = f"""asked_t AS (SELECT query, {sql_text('text')} AS a FROM asked),
    titles AS (SELECT {sql_rec_key()} AS rec_key, title, {sql_text('title')} AS b FROM rec),
    {sql_similarity('SELECT a, b FROM asked_t CROSS JOIN titles')},
    top AS (SELECT * FROM (SELECT query, rec_key, title, round(sim, 6) AS similarity,
        row_number() OVER (PARTITION BY query ORDER BY round(sim, 9) DESC, rec_key) AS rank
        FROM asked_t CROSS JOIN titles JOIN near USING (a, b)) WHERE rank <= 10)"""


def _nearest(spark, sf):
    table(spark, sf, "benchmark").createOrReplaceTempView("benchmark")
    asked = spark.sql(f"WITH {_ASKED} SELECT * FROM asked")
    return similar_field_topk(_rec(spark, sf), asked, "title")


@query("W04_similar_field_topk", recursive(with_views(f"WITH {_ASKED}, {_NEAREST} SELECT * FROM top", "rec")))
def _(spark, sf):
    return _nearest(spark, sf).withColumn("similarity", F.round("similarity", 6))


@query("W05_similar_docs_detail", recursive(with_views(f"""WITH {_ASKED}, {_NEAREST}
    SELECT query, rank, similarity, rec_key, {', '.join(EQUAL_TITLES.names)}
    FROM top JOIN (SELECT *, {sql_rec_key()} AS rec_key FROM rec) USING (rec_key, title) WHERE rank <= 3""", "rec")))
def _(spark, sf):
    detail = similar_docs_detail(_nearest(spark, sf), _rec(spark, sf), 3)
    return detail.select("query", "rank", F.round("similarity", 6).alias("similarity"), "rec_key", *EQUAL_TITLES.names)


# --- whole checks ---------------------------------------------------------------------------


@query("B01_self_check", with_views(f"{_REC_PREP} {_SELF_REPORT}", "rec"))
def _(spark, sf):
    return _report(jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").report)


@query("B01_self_check_no_dup", with_views(
    f"WITH {_sql_prep('rec')} SELECT rec_key, title FROM rec_p WHERE rec_key NOT IN {_dup_keys_sql(_SELF_PAIRS)}", "rec"))
def _(spark, sf):
    return jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").no_dup.select("rec_key", "title")


@query("B01_self_check_similar")
def _(spark, sf):
    report = jobs.self_check(_rec(spark, sf), SIMILAR_TITLES, "doc_id").report
    return report.select("rec_key_1", "rec_key_2", F.round("similarity", 6).alias("similarity"), "matched_fields")


@query("S10_write_dup_report", with_views(f"""{_REC_PREP}
    SELECT rec_key_1, rec_key_2, title_1, title_2, journal_status, year_status, page_status, abstract_score, abstract_status
    FROM ({_SELF_REPORT})""", "rec"))
def _(spark, sf):
    path = scratch(spark, "report")
    write_dup_report(jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").report, EQUAL_TITLES, path)
    return read_dup_report(spark, EQUAL_TITLES, path).select(
        "rec_key_1", "rec_key_2", "title_1", "title_2", "journal_status", "year_status", "page_status", "abstract_score", "abstract_status")


@query("S10_report_lines", with_views(f"""{_REC_PREP}
    SELECT rec_key_1, count(*) AS lines FROM ({_SELF_REPORT}) GROUP BY rec_key_1""", "rec"))
def _(spark, sf):
    lines = report_lines(jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").report, EQUAL_TITLES)
    return lines.where("value <> ''").groupBy("rec_key_1").agg(F.count("*").alias("lines"))


@query("B02_index_check", with_views(f"""{_BOTH_PREP} SELECT rec_key, title FROM (
    SELECT *, row_number() OVER (PARTITION BY rec_key ORDER BY doc_id) AS n FROM page_rec_p
    WHERE rec_key NOT IN {_dup_keys_sql(_INDEX_PAIRS)}) WHERE n = 1""", "rec", "page_rec"))
def _(spark, sf):
    check = jobs.index_check(_pages(spark, sf), _stored(spark, sf, EQUAL_TITLES), EQUAL_TITLES, "doc_id")
    return check.no_dup.select("rec_key", "title")


@query("B02_index_check_keys", with_views(
    f"{_BOTH_PREP} SELECT rec_key_1 AS rec_key FROM {_dup_keys_sql(_INDEX_PAIRS)}", "rec", "page_rec"))
def _(spark, sf):
    return jobs.index_check(_pages(spark, sf), _stored(spark, sf, EQUAL_TITLES), EQUAL_TITLES, "doc_id").dup_keys


_OWN_SET = f"own AS (SELECT rec_key, title, doc_id FROM page_rec_p WHERE rec_key NOT IN {_dup_keys_sql(_PAGE_PAIRS)})"
_STORED_SET = f"stored AS (SELECT rec_key, title, doc_id FROM page_rec_p WHERE rec_key NOT IN {_dup_keys_sql(_INDEX_PAIRS)})"


@query("B03_double_check", with_views(f"""{_BOTH_PREP}, {_OWN_SET}, {_STORED_SET}
    SELECT 1 AS set_no, rec_key, title FROM stored
    UNION ALL SELECT 2, rec_key, title FROM own WHERE rec_key IN (SELECT rec_key FROM stored)""", "rec", "page_rec"))
def _(spark, sf):
    done = jobs.double_check(_pages(spark, sf), _stored(spark, sf, EQUAL_TITLES), EQUAL_TITLES, "doc_id")
    pick = lambda df, n: df.select(F.lit(n).alias("set_no"), "rec_key", "title")
    return pick(done.no_dup_1, 1).union(pick(done.no_dup_2, 2))


@query("B04_double_check_light", with_views(f"""{_BOTH_PREP}, {_OWN_SET}, {_STORED_SET}
    SELECT 1 AS set_no, rec_key, title FROM (SELECT * FROM own UNION SELECT * FROM stored)
    UNION ALL SELECT 2, rec_key, title FROM own WHERE rec_key IN (SELECT rec_key FROM stored)""", "rec", "page_rec"))
def _(spark, sf):
    done = jobs.double_check(_pages(spark, sf), _stored(spark, sf, EQUAL_TITLES), EQUAL_TITLES, "doc_id", light=True)
    pick = lambda df, n: df.select(F.lit(n).alias("set_no"), "rec_key", "title")
    return pick(done.no_dup_1, 1).union(pick(done.no_dup_2, 2))


@query("W06_lookup_duplicates", with_views(f"""{_BOTH_PREP},
        scored AS (SELECT DISTINCT rec_key_1, rec_key_2 FROM {_INDEX_PAIRS} WHERE {_DUP})
    SELECT * FROM (SELECT rec_key_1, rec_key_2, row_number() OVER (PARTITION BY rec_key_1 ORDER BY rec_key_2) AS rank
        FROM scored) WHERE rank <= 3""", "rec", "page_rec"))
def _(spark, sf):
    found = jobs.lookup_duplicates(_pages(spark, sf), _stored(spark, sf, EQUAL_TITLES), EQUAL_TITLES, 3)
    return found.select("rec_key_1", "rec_key_2", "rank")


@query("W06_lookup_in_batch", with_views(f"""WITH {_sql_prep('rec')},
        scored AS (SELECT DISTINCT rec_key_1, rec_key_2 FROM {_SELF_PAIRS} WHERE {_DUP})
    SELECT * FROM (SELECT rec_key_1, rec_key_2, row_number() OVER (PARTITION BY rec_key_1 ORDER BY rec_key_2) AS rank
        FROM scored) WHERE rank <= 3""", "rec"))
def _(spark, sf):
    found = jobs.lookup_duplicates(_rec(spark, sf), _rec(spark, sf), EQUAL_TITLES, 3)
    return found.select("rec_key_1", "rec_key_2", "rank")


_GROUPS = "SELECT rec_key, t, {0}, vy, min(rec_key) OVER w AS first_key, max(rec_key) OVER w AS last_key FROM rec_p " \
          "WHERE t <> '' AND {0} <> '' AND vy <> '' WINDOW w AS (PARTITION BY t, {0}, vy)"


@query("J06_certain_groups", with_views(f"""WITH {_sql_prep('rec')}
    SELECT first_key, rec_key FROM ({_GROUPS.format('vj')}) WHERE first_key <> last_key
    UNION SELECT first_key, rec_key FROM ({_GROUPS.format('vp')}) WHERE first_key <> last_key""", "rec"))
def _(spark, sf):
    """Members of the groups that plain equality finds, each with the group's first key."""
    held = stage(dedup.group_members(dedup.find_duplicates(_rec(spark, sf), EQUAL_TITLES)), "members")
    ends = held.groupBy("group").agg(F.min("rec_key").alias("first_key"), F.max("rec_key").alias("last_key"))
    return held.join(ends.where("first_key <> last_key"), "group").select("first_key", "rec_key").distinct()


@query("B01_expanded_pairs", with_views(f"""WITH {_sql_prep('rec')}
    SELECT DISTINCT rec_key_1, rec_key_2 FROM {_SELF_PAIRS} WHERE {_DUP} AND rec_key_1 < rec_key_2""", "rec"))
def _(spark, sf):
    """Pairs, copies and groups together are all pairs of plain SQL."""
    return dedup.expand_pairs(dedup.find_duplicates(_rec(spark, sf), EQUAL_TITLES))


@query("W01_dedup_report_pairs", with_views(
    f"""{_REC_PREP}, both_ways AS (SELECT rec_key_1, rec_key_2 FROM ({_SELF_REPORT})
        UNION ALL SELECT rec_key_2, rec_key_1 FROM ({_SELF_REPORT}))
    SELECT DISTINCT least(rec_key_1, rec_key_2) AS rec_key_1, greatest(rec_key_1, rec_key_2) AS rec_key_2 FROM both_ways""", "rec"))
def _(spark, sf):
    pairs = jobs.self_check(_rec(spark, sf), EQUAL_TITLES, "doc_id").report.select("rec_key_1", "rec_key_2")
    mirrored = pairs.select(F.col("rec_key_2").alias("rec_key_1"), F.col("rec_key_1").alias("rec_key_2"))
    return dedup_pairs(pairs.unionByName(mirrored))


@query("B01_lines_self_check", with_views(f"""WITH {SQL_CHECKED},
    good AS (SELECT {', '.join(f"coalesce(c[{f.pos + 1}], '') AS {f.name}" for f in LINES.by_pos)} FROM checked WHERE reason IS NULL),
    k AS (SELECT {sql_rec_key()} AS rec_key, {sql_text('titulo_artigo')} AS t, {sql_text('titulo_revista')} AS r,
          ano_publicacao AS a, volume_fasciculo AS v, numero_fasciculo AS n FROM good)
    SELECT rec_key FROM k WHERE rec_key NOT IN (SELECT x.rec_key FROM k x JOIN k y ON x.t = y.t AND x.rec_key <> y.rec_key
        WHERE {' AND '.join(f"(x.{c} = '' OR y.{c} = '' OR x.{c} = y.{c})" for c in 'ravn')}
        AND {' + '.join(f"(x.{c} <> '' AND x.{c} = y.{c})::INT" for c in 'ravn')} >= 3)""", "pipe_line"))
def _(spark, sf):
    """Good lines without another line of the same title and no differing field."""
    equal = MatchSchema("lines", (Tier(1.0, 3),), tuple(
        f if f.kind != "ngram" else Field(f.name, f.pos, "exact") for f in LINES.fields))
    strict = MatchSchema(equal.name, (Tier(1.0, 3),), tuple(
        Field(f.name, f.pos, f.kind, required=f.required, match=DENY_DUP) if f.kind == "exact" else f for f in equal.fields))
    lines = view(spark, sf, "pipe_line")
    return jobs.self_check(jobs.good_records(lines, strict), strict, "line_no").no_dup.select("rec_key")
