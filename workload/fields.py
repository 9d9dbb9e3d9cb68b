"""Scalar, filter, validation and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.functions import text as T
from twinfold.operators import profile as prof
from twinfold.operators import validate as val
from twinfold.plans import extract as ex
from twinfold.schema import MatchSchema, preset
from twinfold.sources import jdbc, pipe, xml_docs
from workload.registry import in_order, SQL_CELLS, query, sql_key, sql_rec_key, sql_text
from workload.views import table, view, with_views

LINES: MatchSchema = preset("article_five")
JOIN = "array_to_string({}, '~')"


@query("P01_split_pipe", with_views(
    f"SELECT line_no, len({SQL_CELLS}) AS cells, array_to_string({SQL_CELLS}, '~') AS joined FROM pipe_line", "pipe_line"))
def _(spark, sf):
    cells = T.split_pipe("value")
    return view(spark, sf, "pipe_line").select(
        "line_no", F.size(cells).alias("cells"), F.array_join(cells, "~").alias("joined"))


@query("P02_normalize_key", f"SELECT doc_id, {sql_key('text')} AS norm FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalize_key("text").alias("norm"))


@query("P03_record_key", with_views(f"SELECT doc_id, {sql_rec_key()} AS rec_key FROM rec", "rec"))
def _(spark, sf):
    return view(spark, sf, "rec").select("doc_id", T.record_key("id", "database").alias("rec_key"))


@query("P04_normalize_text", f"SELECT doc_id, {sql_text('text')} AS norm FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalize_text("text").alias("norm"))


@query("P05_clean_cell", with_views(r"""
    SELECT cell_id, replace(regexp_replace(regexp_replace(raw, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'),
           '\n\r|\r\n|\n', ' ', 'g'), '|', ' ') AS cleaned FROM cell""", "cell"))
def _(spark, sf):
    return view(spark, sf, "cell").select("cell_id", T.clean_cell("raw").alias("cleaned"))


def _sql_tag(e: str) -> str:
    prefix = f"CASE WHEN ({e}->'$._i') IS NULL THEN '' ELSE concat('(', lower(trim({e}->>'$._i')), ')') END"
    return (
        f"CASE WHEN ({e}->>'$.text') <> '' THEN concat({prefix}, {e}->>'$.text') "
        f"WHEN ({e}->>'$._f') <> '' THEN concat({prefix}, {e}->>'$._f') END"
    )


SQL_ELEMENT = f"""CASE WHEN title LIKE '[{{%' THEN array_to_string(
        [x for x in [{_sql_tag('e')} for e in from_json(title, '["JSON"]')] if x IS NOT NULL], '//@//')
    WHEN title LIKE '{{%' THEN coalesce({_sql_tag('title::JSON')}, title) ELSE title END"""


@query("P06_json_element", with_views(f"SELECT reference_ptr_id, {SQL_ELEMENT} AS title FROM analytic", "analytic"))
def _(spark, sf):
    return view(spark, sf, "analytic").select("reference_ptr_id", T.json_element("title").alias("title"))


SQL_SUFFIXED = f"""
    SELECT CASE WHEN regexp_full_match(title, '\\([a-z][a-z]\\).+') THEN concat(id, '^', title[2:3]) ELSE id END AS reference_ptr_id,
           CASE WHEN regexp_full_match(title, '\\([a-z][a-z]\\).+') THEN title[5:] ELSE title END AS title,
           pages
    FROM (SELECT cast(reference_ptr_id AS string) AS id, {SQL_ELEMENT} AS title, pages FROM analytic)"""


@query("P07_suffix_id_with_lang", with_views(SQL_SUFFIXED, "analytic"))
def _(spark, sf):
    cells = view(spark, sf, "analytic").select(
        T.suffix_language(
            F.array(F.col("reference_ptr_id").cast("string"), T.json_element("title"), F.col("pages")), 0).alias("c"))
    return cells.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(["reference_ptr_id", "title", "pages"])])


@query("P08_explode_repetitive", with_views("""
    SELECT doc_id, author, place FROM (
        SELECT doc_id, trim(unnest(string_split(regexp_replace(authors, '(//@//)+$', ''), '//@//'))) AS author, places
        FROM (SELECT doc_id, authors, concat(journal, '//@//', year, '//@//') AS places FROM rec)) x,
        LATERAL (SELECT unnest(string_split(regexp_replace(places, '(//@//)+$', ''), '//@//')) AS place) y""", "rec"))
def _(spark, sf):
    rows = view(spark, sf, "rec").select(
        "doc_id", "authors", F.concat("journal", F.lit("//@//"), "year", F.lit("//@//")).alias("places"))
    return rows.withColumn("author", F.explode(T.split_repeated("authors"))).select(
        "doc_id", "author", F.explode(T.split_repeated("places")).alias("place"))


@query("P09_join_repetitive", with_views(
    "SELECT doc_id, concat_ws('//@//', title, journal, year) AS joined FROM rec", "rec"))
def _(spark, sf):
    return view(spark, sf, "rec").select("doc_id", T.join_repeated(F.array("title", "journal", "year")).alias("joined"))


TABLES = {"en": {"db": 0, "id": 1, "ti": 3}, "fr": {"db": 0, "id": 1, "ti": 2, "ta": 4}}


def doc_fields(spark, sf):
    """Records as ordered (name, value) lists, title given twice."""
    pair = lambda n, c: F.struct(F.lit(n).alias("name"), F.col(c).alias("value"))
    return view(spark, sf, "rec").select(
        "doc_id",
        F.array(pair("type", "journal"), pair("db", "database"), pair("id", "id"), pair("ti", "title"),
                pair("ti", "year"), pair("ta", "page")).alias("fields"))


@query("P10_field_map_project", with_views("""
    SELECT journal AS type, CASE journal
        WHEN 'en' THEN concat(database, '|', id, '||', title, '//@//', year)
        ELSE concat(database, '|', id, '|', title, '//@//', year, '||', page) END AS value
    FROM rec WHERE journal IN ('en', 'fr')""", "rec"))
def _(spark, sf):
    return xml_docs.docs_to_lines(doc_fields(spark, sf), TABLES)


@query("P11_fill_pattern", with_views(f"""
    SELECT line_no, array_to_string([CASE WHEN trim(c) = '' THEN '0' ELSE '1' END for c in {SQL_CELLS}], '') AS pattern
    FROM pipe_line""", "pipe_line"))
def _(spark, sf):
    return view(spark, sf, "pipe_line").select("line_no", T.fill_pattern(T.split_pipe("value")).alias("pattern"))


@query("P12_regexp_group", with_views("SELECT doc_id, regexp_extract(page, 'e?(\\d+)', 1) AS page FROM rec", "rec"))
def _(spark, sf):
    return view(spark, sf, "rec").select("doc_id", T.regexp_group("page", r"e?(\d+)").alias("page"))


@query("P13_clean_query_doc", with_views(
    "SELECT id, trim(replace(replace(title, '&amp;', '&'), ':', ' ')) AS title, trim(replace(link, ':', ' ')) AS link "
    "FROM resource", "resource"))
def _(spark, sf):
    return view(spark, sf, "resource").select("id", T.clean_query("title").alias("title"), T.clean_query("link").alias("link"))


@query("P14_char_ngrams", with_views(f"""
    SELECT gram, count(*) AS n FROM (
        SELECT unnest([s[i:i+2] for i in range(1, length(s) - 1)]) AS gram
        FROM (SELECT concat(chr(1), chr(1), {sql_text('title')}) AS s FROM rec))
    GROUP BY gram""", "rec"))
def _(spark, sf):
    titles = view(spark, sf, "rec").select(T.normalize_text("title").alias("t"))
    return titles.select(F.explode(T.char_ngrams("t", 3)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("P15_source_tag", with_views("SELECT 'article' AS dbase, doc_id FROM rec", "rec"))
def _(spark, sf):
    return view(spark, sf, "rec").select(F.lit("article").alias("dbase"), "doc_id")


@query("P16_year4", with_views(
    "SELECT id, substr(publication_date_normalized, 1, 4) AS publication_year FROM reference", "reference"))
def _(spark, sf):
    return view(spark, sf, "reference").select("id", T.year4("publication_date_normalized").alias("publication_year"))


@query("P17_author_fallback", with_views("""
    SELECT reference_ptr_id, coalesce(individual_author, corporate_author) AS author,
           coalesce(corporate_author, individual_author) AS author_corporate_first FROM analytic""", "analytic"))
def _(spark, sf):
    return view(spark, sf, "analytic").select(
        "reference_ptr_id", T.author_fallback("individual_author", "corporate_author").alias("author"),
        T.author_fallback("corporate_author", "individual_author").alias("author_corporate_first"))


@query("P18_case_blank_address", with_views("""
    SELECT id, CASE WHEN electronic_address IS NULL OR electronic_address = '[]' THEN '' ELSE electronic_address END
        AS electronic_address FROM reference""", "reference"))
def _(spark, sf):
    return view(spark, sf, "reference").select("id", T.blank_address("electronic_address").alias("electronic_address"))


@query("P19_link_and_prefixed_id", with_views("""
    SELECT concat('https://example.org/edit-analytic/', reference_ptr_id) AS link,
           concat('admin-', reference_ptr_id) AS id FROM analytic""", "analytic"))
def _(spark, sf):
    return view(spark, sf, "analytic").select(
        T.edit_link("https://example.org/edit-analytic/", "reference_ptr_id").alias("link"),
        T.prefixed_id("admin", "reference_ptr_id").alias("id"))


@query("P20_utf8_check", """SELECT doc_id, strlen(text) <= k OR list_contains([strlen(text[1:m]) for m in range(0, k + 1)], k) AS valid
    FROM (SELECT doc_id, text, 9 + doc_id % 40 AS k FROM documents)""")
def _(spark, sf):
    """All bytes of a text, with a blank put in at a place that may lie inside a character."""
    raw, at = F.col("text").cast("binary"), (9 + F.col("doc_id") % 40).cast("int")
    broken = F.concat(F.substring(raw, F.lit(1), at), F.lit(b" "), F.substring(raw, at + 1, F.length(raw))).cast("string")
    return table(spark, sf, "documents").select("doc_id", T.valid_utf8(broken).alias("valid"))


# --- validation -----------------------------------------------------------------------------

_CELLS = f"SELECT line_no, value, {SQL_CELLS} AS c FROM pipe_line"


def _at(p: int) -> str:
    return f"coalesce(c[{p + 1}], '')"


_F01 = "CASE WHEN len([x for x in c if trim(x) <> '']) - 2 < 3 THEN 'number of fields are less than 3' END"
_F02 = f"CASE WHEN {_at(1)} = '' THEN 'missing id field' WHEN {_at(0)} = '' THEN 'missing database field' END"
_F03 = "coalesce(" + ", ".join(f"CASE WHEN len(c) <= {p} THEN 'invalid field pos = {p}' END" for p in range(2, 7)) + ")"
_F04 = "coalesce(" + ", ".join(
    f"CASE WHEN {_at(p)} <> '' AND {_at(3)} = '' THEN 'missing required field pos={p}' END" for p in (4, 5, 6)) + ")"
_FIELDS = "coalesce(" + ", ".join(
    f"CASE WHEN len(c) <= {p} THEN 'invalid field pos = {p}'"
    + (f" WHEN {_at(p)} <> '' AND {_at(3)} = '' THEN 'missing required field pos={p}'" if p > 3 else "") + " END"
    for p in range(2, 7)) + ")"
SQL_REASON = f"coalesce({_F01}, {_F02}, {_FIELDS})"
SQL_CHECKED = f"checked AS (SELECT line_no, value, c, {SQL_REASON} AS reason FROM ({_CELLS}))"


def _reasons(rule):
    def run(spark, sf):
        lines = view(spark, sf, "pipe_line").select("line_no", T.split_pipe("value").alias("c"))
        return lines.select("line_no", rule(F.col("c"), LINES).alias("reason"))

    return run


for _name, _rule, _sql in [
    ("F01_check_min_fields", val.check_min_fields, _F01),
    ("F02_check_id_db", val.check_id_db, _F02),
    ("F03_check_position", val.check_position, _F03),
    ("F04_check_required", val.check_required, _F04),
]:
    query(_name, with_views(f"SELECT line_no, {_sql} AS reason FROM ({_CELLS})", "pipe_line"))(_reasons(_rule))


@query("F05_validate", with_views(f"WITH {SQL_CHECKED} SELECT line_no, reason FROM checked", "pipe_line"))
def _(spark, sf):
    return val.validate(view(spark, sf, "pipe_line"), LINES).select("line_no", "reason")


@query("A05_good_bad_counts", with_views(
    f"WITH {SQL_CHECKED} SELECT count(*) FILTER (reason IS NULL) AS good, count(*) FILTER (reason IS NOT NULL) AS bad FROM checked",
    "pipe_line"))
def _(spark, sf):
    return val.good_bad_counts(val.validate(view(spark, sf, "pipe_line"), LINES))


@query("F07_literature_filter", with_views("""
    SELECT id, literature_type FROM reference
    WHERE substr(literature_type, 1, 1) = 'S' OR substr(literature_type, 1, 1) IN ('N', 'T')""", "reference"))
def _(spark, sf):
    return view(spark, sf, "reference").where(ex.literature_is("S") | ex.literature_in("N", "T")).select("id", "literature_type")


@query("F08_treatment_filter", with_views(
    "SELECT id, treatment_level FROM reference WHERE substr(treatment_level, 1, 1) = 'a' AND treatment_level <> 'as'", "reference"))
def _(spark, sf):
    level = F.col("treatment_level")
    return view(spark, sf, "reference").where((F.left(level, F.lit(1)) == "a") & (level != "as")).select("id", "treatment_level")


@query("F09_translated_title_filter", with_views("""
    SELECT reference_ptr_id, english_translated_title FROM analytic
    WHERE english_translated_title <> '' AND english_translated_title <> 'x'""", "analytic"))
def _(spark, sf):
    return view(spark, sf, "analytic").where(ex.translated()).select("reference_ptr_id", "english_translated_title")


@query("F10_non_blank_date", with_views("SELECT id, publication_date FROM reference WHERE publication_date <> ''", "reference"))
def _(spark, sf):
    return view(spark, sf, "reference").where(ex.non_blank("publication_date")).select("id", "publication_date")


@query("F12_known_type_filter", with_views(
    "SELECT doc_id, lower(journal) AS type FROM rec WHERE lower(journal) IN ('en', 'fr')", "rec"))
def _(spark, sf):
    return xml_docs.known_types(doc_fields(spark, sf), TABLES).select("doc_id", "type")


@query("A09_skipped_by_type", with_views("""
    SELECT 'unknown conversion table' AS reason, journal AS type, count(*) AS docs
    FROM rec WHERE journal NOT IN ('en', 'fr') GROUP BY journal""", "rec"))
def _(spark, sf):
    return xml_docs.skipped_by_type(doc_fields(spark, sf), TABLES)


@query("F15_drop_blank_lines", r"""
    SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE trim(line) <> ''""")
def _(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return pipe.drop_blank(lines, "line")


# --- profile --------------------------------------------------------------------------------

SQL_PATTERNS = """pats AS (
    SELECT pattern, length(replace(pattern, '0', '')) AS used, length(pattern) AS columns, count(*) AS lines
    FROM (SELECT array_to_string([CASE WHEN trim(c) = '' THEN '0' ELSE '1' END for c in string_split(trim(value), '|')], '')
              AS pattern FROM pipe_line WHERE trim(value) <> '') GROUP BY pattern)"""
_PRESENCE = """SELECT i AS "column", sum(CASE WHEN pattern[i] = '1' THEN lines ELSE 0 END) AS used_lines,
    round(sum(CASE WHEN pattern[i] = '1' THEN lines ELSE 0 END) * 100.0::DOUBLE / (SELECT sum(lines) FROM pats), 6) AS percent
    FROM (SELECT unnest(range(1, columns + 1)) AS i, pattern, lines FROM pats) GROUP BY i"""
_USED = """SELECT u AS used, coalesce(sum(lines), 0) AS lines,
    round(coalesce(sum(lines), 0) * 100.0::DOUBLE / (SELECT sum(lines) FROM pats), 6) AS percent
    FROM (SELECT unnest(range(0, (SELECT max(columns) FROM pats) + 1)) AS u) LEFT JOIN pats ON used = u GROUP BY u"""
_COUNTS = """SELECT pattern, used, lines,
    round(lines * 100.0::DOUBLE / sum(lines) OVER (PARTITION BY used), 6) AS percent FROM pats"""


def _patterns(spark, sf):
    return prof.patterns(view(spark, sf, "pipe_line"))


@query("A01_column_presence", with_views(f"WITH {SQL_PATTERNS} {_PRESENCE}", "pipe_line"))
def _(spark, sf):
    return prof.column_presence(_patterns(spark, sf))


@query("A02_pattern_counts", with_views(f"WITH {SQL_PATTERNS} {_COUNTS}", "pipe_line"))
def _(spark, sf):
    return prof.pattern_counts(_patterns(spark, sf))


@query("A03_used_columns_hist", with_views(f"WITH {SQL_PATTERNS} {_USED}", "pipe_line"))
def _(spark, sf):
    return prof.used_columns(_patterns(spark, sf))


@query("A04_line_and_column_totals", with_views(
    f"WITH {SQL_PATTERNS} SELECT sum(lines) AS lines, max(columns) AS columns FROM pats", "pipe_line"))
def _(spark, sf):
    return prof.totals(_patterns(spark, sf))


@query("W07_pattern_order", with_views(f"""WITH {SQL_PATTERNS} SELECT *,
    row_number() OVER (PARTITION BY used ORDER BY lines DESC, pattern DESC) AS place FROM ({_COUNTS})""", "pipe_line"))
def _(spark, sf):
    return in_order(prof.pattern_order(prof.pattern_counts(_patterns(spark, sf))), "used")


@query("B07_profile", with_views(f"""WITH {SQL_PATTERNS}
    SELECT 'lines' AS section, '' AS item, sum(lines) AS lines, cast(NULL AS DOUBLE) AS percent FROM pats
    UNION ALL SELECT 'columns', '', max(columns), NULL FROM pats
    UNION ALL SELECT 'column', cast("column" AS string), used_lines, percent FROM ({_PRESENCE})
    UNION ALL SELECT 'used', cast(used AS string), lines, percent FROM ({_USED})
    UNION ALL SELECT 'pattern', pattern, lines, percent FROM ({_COUNTS})""", "pipe_line"))
def _(spark, sf):
    return prof.profile(view(spark, sf, "pipe_line"))


@query("B05_mysql_to_pipe", with_views(f"""
    SELECT CASE WHEN regexp_full_match(t, '\\([a-z][a-z]\\).+') THEN concat(id, '^', t[2:3], '|', t[5:], '|', pages)
                ELSE concat(id, '|', t, '|', pages) END AS value
    FROM (SELECT reference_ptr_id AS id, trim(unnest(string_split(replace({SQL_ELEMENT}, '|', ' '), '//@//'))) AS t, pages
          FROM analytic)""", "analytic"))
def _(spark, sf):
    view(spark, sf, "analytic").createOrReplaceTempView("analytic")
    asked = "SELECT reference_ptr_id, title, pages FROM analytic WHERE reference_ptr_id % 4 {} 1"
    rows = jdbc.queries_to_records(spark, [asked.format("="), asked.format("<>")])
    return rows.select(pipe.joined_line(rows.columns).alias("value"))
