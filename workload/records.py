"""Extraction, set, pair and storage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.operators import pairs as pr
from twinfold.operators.validate import validate
from twinfold.plans import extract as ex
from twinfold.plans import jobs
from twinfold.schema import Field, MatchSchema, Tier, preset
from twinfold.sources import index as ix
from twinfold.sources import postings as ps
from twinfold.sources import jdbc, pipe, xml_docs
from workload.fields import LINES, SQL_CHECKED, TABLES, doc_fields
from workload.registry import in_order, query, scratch, sql_key, sql_rec_key, sql_text
from workload.views import catalogue, table, view, with_views

# --- extraction -----------------------------------------------------------------------------

_YEAR = "substr(a.publication_date_normalized, 1, 4) AS publication_year"
_DETAIL = """a.cooperative_center_code, a.literature_type, a.treatment_level, a.status,
    CASE WHEN a.electronic_address IS NULL OR a.electronic_address = '[]' THEN '' ELSE a.electronic_address END
        AS electronic_address"""
_LINK = "concat('https://example.org/edit-analytic/', b.reference_ptr_id) AS link"
_SAS = """FROM analytic b JOIN source c ON b.source_id = c.reference_ptr_id
    JOIN reference a ON b.source_id = a.id AND a.literature_type LIKE 'S%'"""
_AM = """FROM reference a JOIN analytic b ON a.id = b.reference_ptr_id JOIN source c ON b.source_id = c.reference_ptr_id
    WHERE NOT a.literature_type LIKE 'S%' AND a.treatment_level LIKE 'a%'"""
_OWN = """FROM reference a, analytic b, source c WHERE a.literature_type LIKE 'S%' AND a.id = b.reference_ptr_id
    AND b.source_id = c.reference_ptr_id AND a.treatment_level = 'as'"""
_MNT = """FROM reference a JOIN source b ON a.id = b.reference_ptr_id
    WHERE substr(a.literature_type, 1, 1) IN ('M', 'N', 'T')"""
_ENG = "b.english_translated_title NOT IN ('', 'x')"
_BIB = ("reference", "analytic", "source")


def _sas(title: str) -> str:
    return f"""SELECT 'article' AS dbase, b.reference_ptr_id, b.{title}, c.title_serial, {_YEAR}, c.volume_serial,
        c.issue_number, coalesce(b.individual_author, b.corporate_author) AS author, b.pages, {_DETAIL}, {_LINK}"""


def _am(title: str) -> str:
    return f"""SELECT 'chapter' AS dbase, a.id, b.{title}, c.title_monographic, {_YEAR},
        coalesce(b.individual_author, b.corporate_author) AS author, b.pages, c.volume_monographic, c.issue_number,
        {_DETAIL}, {_LINK}"""


def _own(title: str) -> str:
    return f"""SELECT 'article' AS dbase, a.id, b.{title}, c.title_serial, {_YEAR}, c.volume_serial, c.issue_number,
        coalesce(b.corporate_author, b.individual_author) AS author, b.pages"""


_MONO = f"""SELECT 'monograph' AS dbase, a.id, b.title_monographic, {_YEAR},
    coalesce(b.individual_author_monographic, b.corporate_author_monographic) AS author, b.pages_monographic,
    b.volume_serial, b.issue_number {_MNT}"""

_EXTRACTS = {
    "X01_articles": (ex.articles, f"{_sas('title')} {_SAS}"),
    "X02_articles_translated": (ex.articles_translated, f"{_sas('english_translated_title')} {_SAS} WHERE {_ENG}"),
    "X03_articles_brief": (ex.articles_brief, f"""SELECT 'article' AS dbase, b.reference_ptr_id, b.title, c.title_serial,
        {_YEAR}, c.volume_serial, c.issue_number {_SAS}"""),
    "X04_articles_translated_brief": (ex.articles_translated_brief, f"""SELECT 'article' AS dbase,
        concat('admin-', b.reference_ptr_id) AS reference_ptr_id, b.english_translated_title, c.title_serial,
        {_YEAR}, c.volume_serial, c.issue_number {_SAS} WHERE {_ENG}"""),
    "X05_issues": (ex.issues, f"""SELECT 'issue' AS dbase, concat('admin-', a.id) AS id, c.title_serial, c.issn,
        {_YEAR}, c.volume_serial, c.issue_number FROM source c JOIN reference a ON a.id = c.reference_ptr_id
        AND a.literature_type LIKE 'S%' AND a.treatment_level = ''"""),
    "X06_articles_own_year": (ex.articles_own_year, f"{_own('title')} {_OWN}"),
    "X07_articles_translated_own_year": (
        ex.articles_translated_own_year, f"{_own('english_translated_title')} {_OWN} AND {_ENG}"),
    "X08_monographs": (ex.monographs, _MONO),
    "X09_monographs_again": (ex.monographs, _MONO),
    "X10_chapters": (ex.chapters, f"{_am('title')} {_AM}"),
    "X11_chapters_translated": (ex.chapters_translated, f"{_am('english_translated_title')} {_AM} AND {_ENG}"),
    "X17_articles_detailed": (ex.articles_detailed, f"""SELECT 'article' AS dbase, b.reference_ptr_id, b.title,
        c.title_serial, {_YEAR}, c.volume_serial, c.issue_number,
        coalesce(b.individual_author, b.corporate_author) AS author, b.pages, a.cooperative_center_code,
        a.literature_type, a.treatment_level, a.status, a.electronic_address, {_LINK} {_SAS}"""),
    "X17_monographs_detailed": (ex.monographs_detailed, f"""SELECT 'monograph' AS dbase, a.id, b.title_monographic, {_YEAR},
        coalesce(b.individual_author_monographic, b.corporate_author_monographic) AS author, b.pages_monographic,
        b.volume_monographic, b.issue_number, a.cooperative_center_code, a.literature_type, a.treatment_level,
        a.status, a.electronic_address, concat('https://example.org/edit-source/', b.reference_ptr_id) AS link {_MNT}"""),
}
for _name, (_fn, _sql) in _EXTRACTS.items():
    query(_name, with_views(_sql, *_BIB))(lambda spark, sf, fn=_fn: fn(catalogue(spark, sf)))

_SINGLE = {
    "X12_events": (ex.events, "event", "SELECT 'event' AS dbase, id, title, start_date, link FROM event"),
    "X13_resources": (ex.resources, "resource", "SELECT 'resource' AS dbase, id, title, link FROM resource"),
    "X14_publication_dates": (
        ex.publication_dates, "reference", "SELECT id, publication_date FROM reference WHERE publication_date <> ''"),
    "X15_publication_dates_normalized": (
        ex.publication_dates_normalized, "reference",
        "SELECT id, publication_date, publication_date_normalized FROM reference WHERE publication_date <> ''"),
    "X16_conference_dates": (
        ex.conference_dates, "complement",
        "SELECT id, conference_date, conference_normalized_date FROM complement"),
    "W09_first_references": (
        ex.first_references, "reference",
        "SELECT id, reference_title, publication_date FROM reference WHERE literature_type = 'S' ORDER BY id LIMIT 500"),
}
for _name, (_fn, _view, _sql) in _SINGLE.items():
    query(_name, with_views(_sql, _view))(lambda spark, sf, fn=_fn, v=_view: fn({v: view(spark, sf, v)}))

_SERIALS = """SELECT DISTINCT a.original_id, c.title_serial, c.volume_serial FROM reference a
    JOIN source c ON a.id = c.reference_ptr_id WHERE c.title_serial <> '' AND a.literature_type = 'S'"""
for _name in ("U03_distinct", "X18_distinct_serials"):
    query(_name, with_views(_SERIALS, "reference", "source"))(
        lambda spark, sf: ex.distinct_serials(catalogue(spark, sf)))

query("J01_extract_mnt", with_views(
    f"SELECT a.id, b.reference_ptr_id, b.title_monographic {_MNT}", "reference", "source"))(
    lambda spark, sf: ex.monograph_rows(catalogue(spark, sf)).select(
        F.col("r_id").alias("id"), F.col("s_reference_ptr_id").alias("reference_ptr_id"),
        F.col("s_title_monographic").alias("title_monographic")))
query("J02_extract_sas", with_views(
    f"SELECT b.reference_ptr_id, c.title_serial, a.id AS parent_id {_SAS}", *_BIB))(
    lambda spark, sf: ex.article_rows(catalogue(spark, sf)).select(
        "reference_ptr_id", F.col("s_title_serial").alias("title_serial"), F.col("r_id").alias("parent_id")))
query("J03_extract_mntam", with_views(
    """SELECT a.id, c.reference_ptr_id AS source_id, c.title_monographic FROM reference a
       JOIN analytic b ON a.id = b.reference_ptr_id JOIN source c ON b.source_id = c.reference_ptr_id""", *_BIB))(
    lambda spark, sf: ex.chapter_rows(catalogue(spark, sf)).select(
        F.col("r_id").alias("id"), F.col("s_reference_ptr_id").alias("source_id"),
        F.col("s_title_monographic").alias("title_monographic")))

_SQL_TEXTS = ["SELECT dbase, id, title, link FROM event_rows", "SELECT dbase, id, title, link FROM resource_rows;"]


@query("S03_read_jdbc_queries", with_views("""
    SELECT 'event' AS dbase, id, title, link FROM event UNION ALL SELECT 'resource', id, title, link FROM resource""",
    "event", "resource"))
def _(spark, sf):
    t = catalogue(spark, sf)
    ex.events(t).createOrReplaceTempView("event_rows")
    ex.resources(t).createOrReplaceTempView("resource_rows")
    return jdbc.read_jdbc_queries(spark, [q.rstrip(";") for q in _SQL_TEXTS])


@query("U02_union_queries", with_views(
    f"{_sas('title')} {_SAS} UNION ALL {_sas('english_translated_title')} {_SAS} WHERE {_ENG}", *_BIB))
def _(spark, sf):
    t = catalogue(spark, sf)
    return jdbc.union_positional([ex.articles(t), ex.articles_translated(t)])


# --- pairs and record sets ------------------------------------------------------------------

_BATCH = "batch AS (SELECT cast(o_custkey AS string) AS rec_key, o_orderkey AS line_no, o_orderstatus, o_totalprice FROM orders)"
_REMOTE = """remote AS (SELECT cast(l_suppkey * 10 AS string) AS rec_key, min(l_orderkey) AS line_no, 'R' AS o_orderstatus,
    max(l_extendedprice) AS o_totalprice FROM lineitem GROUP BY l_suppkey)"""
_PAIRS = """pairs AS (SELECT cast(l_suppkey AS string) AS rec_key_1,
    cast(cast(floor(l_extendedprice / 1000) AS bigint) AS string) AS rec_key_2, l_orderkey, l_linenumber, l_quantity FROM lineitem)"""
_KEYS = "keys AS (SELECT rec_key_1 AS rec_key FROM pairs UNION SELECT rec_key_2 FROM pairs)"


def _batch(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("rec_key"), F.col("o_orderkey").alias("line_no"), "o_orderstatus",
        "o_totalprice")


def _remote(spark, sf):
    return table(spark, sf, "lineitem").groupBy((F.col("l_suppkey") * 10).cast("string").alias("rec_key")).agg(
        F.min("l_orderkey").alias("line_no"), F.lit("R").alias("o_orderstatus"),
        F.max("l_extendedprice").alias("o_totalprice"))


def _pairs(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("rec_key_1"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").cast("string").alias("rec_key_2"),
        "l_orderkey", "l_linenumber", "l_quantity")


@query("W01_dedup_pairs", f"""WITH {_PAIRS} SELECT rec_key_1, rec_key_2, l_orderkey, l_linenumber, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY least(rec_key_1, rec_key_2), greatest(rec_key_1, rec_key_2)
        ORDER BY rec_key_1, rec_key_2, l_orderkey, l_linenumber, l_quantity) AS n
    FROM pairs WHERE rec_key_1 <> rec_key_2) WHERE n = 1""")
def _(spark, sf):
    return pr.dedup_pairs(_pairs(spark, sf))


@query("A06_dup_map", f"""WITH {_PAIRS} SELECT DISTINCT least(rec_key_1, rec_key_2) AS rec_key,
    greatest(rec_key_1, rec_key_2) AS dup_key FROM pairs WHERE rec_key_1 <> rec_key_2""")
def _(spark, sf):
    return pr.dup_map(_pairs(spark, sf))


@query("J11_merge_dup_ids", f"WITH {_PAIRS}, {_KEYS} SELECT rec_key FROM keys")
def _(spark, sf):
    return pr.merge_dup_ids(_pairs(spark, sf))


_FIRST = "row_number() OVER (PARTITION BY rec_key ORDER BY line_no) AS n"
_COLS = "rec_key, line_no, o_orderstatus, o_totalprice"


@query("W02_first_per_key", f"WITH {_BATCH} SELECT {_COLS} FROM (SELECT *, {_FIRST} FROM batch) WHERE n = 1")
def _(spark, sf):
    return pr.first_per_key(_batch(spark, sf), "line_no")


@query("W03_take_no_dup_light", f"""WITH {_BATCH}, {_REMOTE} SELECT {_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY rec_key ORDER BY side, line_no) AS n
    FROM (SELECT 0 AS side, {_COLS} FROM remote UNION ALL SELECT 1, {_COLS} FROM batch)) WHERE n = 1""")
def _(spark, sf):
    return pr.take_no_dup_light(_remote(spark, sf), _batch(spark, sf), "line_no")


@query("J07_take_no_duplicated", f"WITH {_BATCH}, {_REMOTE} SELECT {_COLS} FROM batch WHERE rec_key IN (SELECT rec_key FROM remote)")
def _(spark, sf):
    return pr.take_no_duplicated(_batch(spark, sf), _remote(spark, sf))


@query("J08_no_dup", f"""WITH {_BATCH}, {_PAIRS}, {_KEYS} SELECT {_COLS} FROM (
    SELECT *, {_FIRST} FROM batch WHERE rec_key NOT IN (SELECT rec_key FROM keys)) WHERE n = 1""")
def _(spark, sf):
    return pr.no_dup(_batch(spark, sf), pr.merge_dup_ids(_pairs(spark, sf)), "line_no")


_DENIED = """denied AS (SELECT DISTINCT greatest(cast(rec_key_1 AS bigint), cast(rec_key_2 AS bigint)) AS id FROM pairs
    WHERE rec_key_1 <> rec_key_2)"""


@query("J09_drop_higher_id", f"""WITH {_BATCH}, {_PAIRS}, {_DENIED} SELECT {_COLS} FROM batch
    WHERE cast(rec_key AS bigint) NOT IN (SELECT id FROM denied)""")
def _(spark, sf):
    return pr.drop_higher_id(_batch(spark, sf), _pairs(spark, sf), "rec_key", "rec_key_1", "rec_key_2")


@query("U01_intersect_ids", f"WITH {_BATCH}, {_REMOTE} SELECT rec_key FROM batch INTERSECT SELECT rec_key FROM remote")
def _(spark, sf):
    return pr.intersect_ids(_batch(spark, sf), _remote(spark, sf))


@query("U04_except_ids", f"WITH {_BATCH}, {_PAIRS}, {_KEYS} SELECT rec_key FROM batch EXCEPT SELECT rec_key FROM keys")
def _(spark, sf):
    return pr.except_ids(_batch(spark, sf), pr.merge_dup_ids(_pairs(spark, sf)))


@query("W08_report_order", f"""WITH {_PAIRS} SELECT rec_key_1, line, row_number() OVER (PARTITION BY rec_key_1 ORDER BY line DESC) AS place
    FROM (SELECT rec_key_1, concat_ws('|', rec_key_2, l_orderkey, l_linenumber) AS line FROM pairs)""")
def _(spark, sf):
    lines = _pairs(spark, sf).select("rec_key_1", pipe.joined_line(["rec_key_2", "l_orderkey", "l_linenumber"]).alias("line"))
    return in_order(pr.report_order(lines, "rec_key_1", "line"), "rec_key_1")


# --- sources, sinks, index ------------------------------------------------------------------

RECORD = MatchSchema(
    "record", (Tier(0.9, 2),),
    (Field("database", 0, "database"), Field("id", 1, "id"), Field("title", 2, "index"),
     Field("journal", 4, "ngram", min_score=0.6), Field("year", 5, "exact", required="journal"),
     Field("authors", 6, "authors"), Field("page", 8, "regexp", pattern=r"e?(\d+)", required="journal")))
_RECORD_LINE = "concat_ws('|', database, id, title, '', journal, year, authors, '', page)"


@query("S01_read_pipe", with_views(f"""
    SELECT {', '.join(f"coalesce(c[{f.pos + 1}], '') AS {f.name}" for f in LINES.by_pos)}
    FROM (SELECT string_split_regex(trim(value), ' *\\| *') AS c FROM pipe_line)""", "pipe_line"))
def _(spark, sf):
    path = scratch(spark, "lines")
    view(spark, sf, "pipe_line").select("value").write.text(path)
    return pipe.read_pipe(spark, path, LINES).select(*LINES.names)


@query("S02_write_pipe", with_views(f"SELECT {_RECORD_LINE} AS value FROM rec", "rec"))
def _(spark, sf):
    path = scratch(spark, "records")
    pipe.write_pipe(view(spark, sf, "rec"), path, RECORD)
    return pipe.read_lines(spark, path).select("value")


def _xml_folder(spark, sf) -> str:
    """The records as document files, written by Spark."""
    path = scratch(spark, "xml")
    named = F.transform("fields", lambda f: F.struct(f["name"].alias("_name"), f["value"].alias("_VALUE")))
    doc_fields(spark, sf).select(named.alias("field")).write.format("xml").options(rootTag="add", rowTag="doc").save(path)
    return path


@query("S04_read_xml_docs", with_views(
    "SELECT id, concat(trim(title), '//@//', year) AS titles, lower(journal) AS type, 6 AS n_fields FROM rec", "rec"))
def _(spark, sf):
    docs = xml_docs.with_type(xml_docs.read_xml_docs(spark, _xml_folder(spark, sf)))
    return docs.select(
        F.get(xml_docs.values_of("id"), F.lit(0)).alias("id"),
        F.array_join(F.transform(xml_docs.values_of("ti"), lambda v: F.trim(v)), "//@//").alias("titles"), "type", F.size("fields").alias("n_fields"))


@query("F11_file_filter", with_views("SELECT id FROM rec", "rec"))
def _(spark, sf):
    """Files that a pattern includes, and those that it excludes: together every document once."""
    path, some = scratch(spark, "xml-files"), "part-[0-9]*[02468]-.*"
    named = F.transform("fields", lambda f: F.struct(f["name"].alias("_name"), f["value"].alias("_VALUE")))
    docs = doc_fields(spark, sf).select(named.alias("field")).repartition(8)
    docs.write.format("xml").options(rootTag="add", rowTag="doc").save(path)
    kept, others = xml_docs.read_xml_docs(spark, path, some), xml_docs.read_xml_docs(spark, path, exclude=some)
    return kept.union(others).select(F.get(xml_docs.values_of("id"), F.lit(0)).alias("id"))


_TYPED = """SELECT journal AS type, CASE journal
        WHEN 'en' THEN concat(database, '|', id, '||', title, '//@//', year)
        ELSE concat(database, '|', id, '|', title, '//@//', year, '||', page) END AS value
    FROM rec WHERE journal IN ('en', 'fr')"""


@query("S05_write_by_type", with_views(_TYPED, "rec"))
def _(spark, sf):
    path = scratch(spark, "by-type")
    xml_docs.write_by_type(xml_docs.docs_to_lines(doc_fields(spark, sf), TABLES), path)
    return spark.read.schema("value string, type string").text(path)


@query("B06_xml_to_pipe", with_views(_TYPED, "rec"))
def _(spark, sf):
    path = scratch(spark, "xml-pipe")
    xml_docs.xml_to_pipe(spark, _xml_folder(spark, sf), path, TABLES)
    return spark.read.schema("value string, type string").text(path)


@query("S06_write_by_pattern", with_views("""
    SELECT array_to_string([CASE WHEN trim(c) = '' THEN '0' ELSE '1' END for c in string_split(value, '|')], '') AS pattern,
           value FROM pipe_line""", "pipe_line"))
def _(spark, sf):
    path = scratch(spark, "by-pattern")
    pipe.write_by_pattern(view(spark, sf, "pipe_line").select("value"), path)
    return spark.read.schema("value string, pattern string").text(path)


@query("B09_split_by_pattern", with_views(f"""WITH {SQL_CHECKED}
    SELECT line_no, value, reason,
        CASE WHEN len(string_split(value, '|')) > 2 THEN
            array_to_string([CASE WHEN trim(x) = '' THEN '0' ELSE '1' END for x in string_split(value, '|')], '') END AS pattern
    FROM checked""", "pipe_line"))
def _(spark, sf):
    return jobs.split_by_pattern(view(spark, sf, "pipe_line"), LINES)


@query("S09_write_good_bad", with_views(f"""WITH {SQL_CHECKED}
    SELECT 'good' AS kind, value FROM checked WHERE reason IS NULL
    UNION ALL SELECT 'bad', concat(value, ' [', reason, ']') FROM checked WHERE reason IS NOT NULL""", "pipe_line"))
def _(spark, sf):
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    pipe.write_good_bad(validate(view(spark, sf, "pipe_line"), LINES), good, bad)
    one = lambda path, kind: spark.read.text(path).select(F.lit(kind).alias("kind"), "value")
    return one(good, "good").union(one(bad, "bad"))


def _norms(names) -> str:
    return ", ".join(
        f"{sql_key(n) if n in ('id', 'database') else sql_text(n)} AS {n}_norm" for n in names)


_INDEXED = f"SELECT {sql_rec_key()} AS rec_key, {', '.join(RECORD.names)}, {_norms(RECORD.names)} FROM rec"


def _stored(spark, sf):
    path = scratch(spark, "index")
    ix.build_index(view(spark, sf, "rec"), RECORD, path)
    return ix.read_index(spark, path)


@query("S07_build_index", with_views(_INDEXED, "rec"))
def _(spark, sf):
    return _stored(spark, sf)


@query("S07_lines_to_index", with_views(f"""WITH {SQL_CHECKED}, good AS (
        SELECT {', '.join(f"coalesce(c[{f.pos + 1}], '') AS {f.name}" for f in LINES.by_pos)} FROM checked WHERE reason IS NULL)
    SELECT {sql_rec_key()} AS rec_key, {', '.join(LINES.names)}, {_norms(LINES.names)} FROM good""", "pipe_line"))
def _(spark, sf):
    return ix.lines_to_index(view(spark, sf, "pipe_line").select("value"), LINES)


@query("S07_index_grams", with_views(f"""
    SELECT gram, count(*) AS records FROM (
        SELECT DISTINCT id, unnest([s[i:i+2] for i in range(1, length(s) - 1)]) AS gram
        FROM (SELECT id, concat(chr(1), chr(1), {sql_text('title')}) AS s FROM rec)) GROUP BY gram""", "rec"))
def _(spark, sf):
    return ix.index_grams(_stored(spark, sf), RECORD).groupBy("gram").agg(F.count("*").alias("records"))


@query("S08_export_index", with_views(f"SELECT {_RECORD_LINE} AS value FROM rec", "rec"))
def _(spark, sf):
    return ix.export_index(_stored(spark, sf), RECORD)


@query("S11_index_upsert", with_views("""
    SELECT rec_key, coalesce(p.title, r.title) AS title, p.title IS NOT NULL AS replaced FROM
        (SELECT id AS rec_key, title FROM rec) r FULL JOIN (SELECT id AS rec_key, title FROM page_rec) p USING (rec_key)""",
    "rec", "page_rec"))
def _(spark, sf):
    pick = lambda name, new: view(spark, sf, name).select(
        F.col("id").alias("rec_key"), "title", F.lit(new).alias("replaced"))
    return ix.index_upsert(pick("rec", False), pick("page_rec", True), "title")


@query("S12_index_reset", with_views("SELECT count(*) AS before, 0 AS after, 0 AS grams FROM rec", "rec"))
def _(spark, sf):
    path = scratch(spark, "index")
    ix.build_index(view(spark, sf, "rec"), RECORD, path, grams=True)
    before = view(spark, sf, "rec").agg(F.count("*").alias("before"))
    ix.reset_index(spark, RECORD, path)
    rows = spark.read.parquet(f"{path}/records").select(F.lit("after").alias("what"))
    rows = rows.union(spark.read.parquet(f"{path}/grams").select(F.lit("grams")))
    left = rows.agg(F.count_if(F.col("what") == "after").alias("after"), F.count_if(F.col("what") == "grams").alias("grams"))
    return before.withColumn("one", F.lit(1)).join(left.withColumn("one", F.lit(1)), "one").drop("one")


@query("F06_audit_index", with_views("""
    SELECT line_no FROM pipe_line WHERE coalesce(string_split_regex(trim(value), ' *\\| *')[4], '') = ''""", "pipe_line"))
def _(spark, sf):
    return ix.audit_index(pipe.parse_lines(view(spark, sf, "pipe_line"), LINES), LINES).select("line_no")


_HAS = f"contains({sql_text('title')}, 'tion') AND list_contains(string_split({sql_text('journal')}, ' '), 'fr')"


def _condition():
    return ix.term("title", "tion") & ix.term("journal", "fr")


@query("F13_search", with_views(f"""
    SELECT rec_key, title FROM (SELECT {sql_rec_key()} AS rec_key, title FROM rec WHERE {_HAS})""", "rec"))
def _(spark, sf):
    return ix.search(ix.index_records(view(spark, sf, "rec"), RECORD), _condition(), ["title"])


_RANKED = f"""
    WITH h AS (SELECT {sql_rec_key()} AS rec_key, {sql_text('title')} AS t, string_split({sql_text('journal')}, ' ') AS j FROM rec),
    w AS (SELECT ln(1 + count(*) / count(*) FILTER (contains(t, 'tio'))) + ln(1 + count(*) / count(*) FILTER (contains(t, 'ion'))) AS tion,
        ln(1 + count(*) / count(*) FILTER (contains(t, 'que'))) AS que, ln(1 + count(*) / count(*) FILTER (list_contains(j, 'fr'))) AS fr
        FROM h),
    m AS (SELECT rec_key, contains(t, 'tio') AND contains(t, 'ion') AS tion, contains(t, 'que') AS que FROM h
        WHERE list_contains(j, 'fr') AND NOT contains(t, 'aux'))
    SELECT rec_key, round(CASE WHEN m.tion THEN w.tion ELSE 0 END + CASE WHEN m.que THEN w.que ELSE 0 END + w.fr, 6) AS weight
    FROM m, w WHERE m.tion OR m.que"""


@query("F13_search_ranked", with_views(_RANKED, "rec"))
def _(spark, sf):
    path = scratch(spark, "postings")
    ps.build_postings(ix.index_records(view(spark, sf, "rec"), RECORD), ["title", "journal"], path)
    asked = (ps.has("title", "tion") | ps.has("title", "que")) & ps.has("journal", "fr") & ~ps.has("title", "aux")
    return ps.Postings(spark, path).search(asked).select("rec_key", F.round("weight", 6).alias("weight"))


@query("A08_hit_count", with_views(f"SELECT count(*) AS hits FROM rec WHERE {_HAS}", "rec"))
def _(spark, sf):
    return ix.hit_count(ix.index_records(view(spark, sf, "rec"), RECORD), _condition())


@query("F14_index_delete", with_views("SELECT id, title FROM rec WHERE NOT id LIKE '1%'", "rec"))
def _(spark, sf):
    return ix.index_delete(ix.index_records(view(spark, sf, "rec"), RECORD), RECORD, "1*").select("id", "title")


@query("J10_get_by_id", with_views(
    "SELECT id, title FROM rec WHERE id IN (SELECT id FROM page_rec)", "rec", "page_rec"))
def _(spark, sf):
    return ix.get_by_id(ix.index_records(view(spark, sf, "rec"), RECORD), RECORD, view(spark, sf, "page_rec").select("id")).select(
        "id", "title")


@query("B08_rebuild_index_without_dups", f"""WITH {_PAIRS}, {_DENIED}
    SELECT cast(o_orderkey AS string) AS id, {sql_key("concat(cast(o_orderkey AS string), 'db')")} AS rec_key FROM orders
    WHERE o_orderkey NOT IN (SELECT id FROM denied)""")
def _(spark, sf):
    batch = table(spark, sf, "orders").select(
        F.lit("db").alias("database"), F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Part "), F.col("o_orderkey").cast("string")).alias("titulo"), F.lit("").alias("url"))
    kept = jobs.records_without_dups(batch, _pairs(spark, sf), "id", "rec_key_1", "rec_key_2")
    path = scratch(spark, "index")
    ix.build_index(kept, preset("resource_two"), path)
    return ix.read_index(spark, path).select("id", "rec_key")
