"""Record-shaped views over the given tables, one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = {
    "rec": ["documents"],
    "page_rec": ["pages"],
    "pipe_line": ["orders"],
    "reference": ["customer", "orders"],
    "analytic": ["orders"],
    "source": ["customer"],
    "event": ["events"],
    "resource": ["pages"],
    "complement": ["orders"],
    "cell": ["conversations"],
}

_TITLE = "trim(replace(split_part(text, chr(10), 1), '|', ' '))"
_WORD = "replace(replace(split_part(text, ' ', {n}), chr(10), ' '), '|', ' ')"
# the page without its marks; DuckDB replaces all matches only with an option, Spark does so by itself
_ALL = "/*all*/"
_PBODY = f"trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ' {_ALL}), '[ |\\n\\t]+', ' ' {_ALL}))"
_PTITLE = "trim(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '|', ' '))"

VIEWS = {
    # title is the first line of a text, abstract is the rest of it
    "rec": f"""
        SELECT doc_id,
               source AS database,
               cast(doc_id AS string) AS id,
               {_TITLE} AS title,
               lang AS journal,
               cast(1990 + length(split_part(text, ' ', 1)) AS string) AS year,
               concat({_WORD.format(n=2)}, '//@//', {_WORD.format(n=3)}) AS authors,
               concat('e', cast(length(split_part(text, ' ', 4)) AS string)) AS page,
               trim(replace(replace(substr(text, length(split_part(text, chr(10), 1)) + 2), chr(10), ' '), '|', ' '))
                   AS abstract
        FROM documents""",
    "page_rec": f"""
        SELECT page_id AS doc_id,
               'web' AS database,
               cast(page_id AS string) AS id,
               {_PTITLE} AS title,
               regexp_extract(html, 'lang="([a-z]*)"', 1) AS journal,
               cast(1990 + length(split_part({_PTITLE}, ' ', 1)) AS string) AS year,
               concat(split_part({_PTITLE}, ' ', 2), '//@//', split_part({_PTITLE}, ' ', 3)) AS authors,
               concat('e', cast(length(split_part({_PTITLE}, ' ', 4)) AS string)) AS page,
               {_PBODY} AS abstract
        FROM pages""",
    # positional lines with gaps, blanks and short lines: database|id|title|journal|year|volume|issue
    "pipe_line": """
        SELECT o_orderkey AS line_no,
               CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'
                    THEN concat(' db | ', cast(o_orderkey AS string), ' |Title ', cast(o_custkey AS string), '|Short')
                    ELSE concat_ws('|',
                       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '' ELSE 'db' END,
                       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN ' '
                            ELSE cast(o_orderkey AS string) END,
                       concat('Title ', cast(o_custkey AS string)),
                       CASE WHEN o_orderstatus = 'F' THEN '' ELSE concat('Journal ', cast(o_custkey % 20 AS string)) END,
                       CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE substr(cast(o_orderdate AS string), 1, 4) END,
                       cast(o_custkey % 30 AS string),
                       CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE cast(o_custkey % 12 AS string) END)
               END AS value
        FROM orders""",
    # customers are serials and books, orders are the parts published in them
    "reference": """
        SELECT 2 * c_custkey AS id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'S' WHEN 'BUILDING' THEN 'Sms' WHEN 'FURNITURE' THEN 'M'
                                 WHEN 'HOUSEHOLD' THEN 'N' ELSE 'T' END AS literature_type,
               '' AS treatment_level,
               CASE WHEN c_nationkey < 5 THEN '' ELSE concat('year ', cast(1980 + c_nationkey AS string)) END AS publication_date,
               concat(cast(1980 + c_nationkey AS string), '0000') AS publication_date_normalized,
               concat('C', cast(c_nationkey AS string)) AS cooperative_center_code,
               cast(c_nationkey % 3 - 1 AS string) AS status,
               CASE c_nationkey % 3 WHEN 0 THEN cast(NULL AS string) WHEN 1 THEN '[]'
                    ELSE concat('[{"_u":"http://x/', cast(c_custkey AS string), '"}]') END AS electronic_address,
               c_name AS reference_title,
               concat('orig', cast(c_nationkey AS string)) AS original_id
        FROM customer
        UNION ALL
        SELECT 2 * o_orderkey + 1,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'Sms' WHEN '3-MEDIUM' THEN 'M'
                                    WHEN '4-NOT SPECIFIED' THEN 'N' ELSE 'T' END,
               CASE o_orderstatus WHEN 'O' THEN 'as' WHEN 'F' THEN 'am' ELSE '' END,
               CASE WHEN o_orderstatus = 'P' THEN '' ELSE substr(cast(o_orderdate AS string), 1, 10) END,
               replace(substr(cast(o_orderdate AS string), 1, 10), '-', ''),
               concat('C', cast(o_custkey % 7 AS string)),
               cast(o_custkey % 3 - 1 AS string),
               CASE o_custkey % 3 WHEN 0 THEN cast(NULL AS string) WHEN 1 THEN '[]'
                    ELSE concat('[{"_u":"http://x/', cast(o_orderkey AS string), '"}]') END,
               concat('Part ', cast(o_orderkey AS string)),
               concat('orig', cast(o_custkey % 50 AS string))
        FROM orders""",
    "analytic": """
        SELECT 2 * o_orderkey + 1 AS reference_ptr_id,
               2 * o_custkey AS source_id,
               CASE o_orderstatus
                    WHEN 'O' THEN concat('[{"text":"Title ', cast(o_custkey AS string), '","_i":"PT "}]')
                    WHEN 'F' THEN concat('[{"text":"","_f":"Titulo ', cast(o_custkey AS string),
                                         '","_i":"es"},{"_f":"Title|', cast(o_custkey AS string), '"},{"other":"x"}]')
                    ELSE concat('{"text":"Plain ', cast(o_custkey AS string), '"}') END AS title,
               CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE concat('Eng ', cast(o_custkey AS string)) END
                    AS english_translated_title,
               CASE WHEN o_custkey % 4 = 0 THEN cast(NULL AS string) ELSE concat('Author ', cast(o_custkey AS string)) END
                    AS individual_author,
               CASE WHEN o_custkey % 6 = 0 THEN cast(NULL AS string) ELSE concat('Corp ', cast(o_custkey % 9 AS string)) END
                    AS corporate_author,
               concat('e', cast(o_custkey % 100 AS string), '-', cast(o_custkey % 100 + 5 AS string)) AS pages
        FROM orders""",
    "source": """
        SELECT 2 * c_custkey AS reference_ptr_id,
               CASE WHEN c_nationkey = 0 THEN '' ELSE concat('Journal ', cast(c_nationkey AS string)) END AS title_serial,
               concat('Book ', c_name) AS title_monographic,
               concat('ISSN', cast(c_nationkey AS string)) AS issn,
               cast(c_custkey % 30 AS string) AS volume_serial,
               cast(c_custkey % 30 + 1 AS string) AS volume_monographic,
               cast(c_custkey % 12 AS string) AS issue_number,
               CASE WHEN c_custkey % 4 = 0 THEN cast(NULL AS string) ELSE concat('Author ', c_name) END
                    AS individual_author_monographic,
               concat('Corp ', cast(c_nationkey AS string)) AS corporate_author_monographic,
               cast(c_custkey % 400 AS string) AS pages_monographic
        FROM customer""",
    "event": """
        SELECT event_id AS id,
               concat(event_type, ' ', cast(user_id AS string)) AS title,
               substr(cast(ts AS string), 1, 10) AS start_date,
               concat('http://e/', cast(user_id AS string)) AS link
        FROM events""",
    "resource": f"""
        SELECT page_id AS id, {_PTITLE} AS title, url AS link FROM pages""",
    "complement": """
        SELECT 2 * o_orderkey + 1 AS id,
               substr(cast(o_orderdate AS string), 1, 10) AS conference_date,
               replace(substr(cast(o_orderdate AS string), 1, 10), '-', '') AS conference_normalized_date
        FROM orders""",
    # raw cells with line breaks and bars
    "cell": """
        SELECT concat(cast(conv_id AS string), '-', cast(turn AS string)) AS cell_id, conv_id, turn, role,
               concat('  ', text, chr(10), '|', role, chr(13), chr(10), ' ') AS raw
        FROM conversations""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for base in BASE[name]:
        table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(_first_parts(VIEWS[name]))


def _first_parts(sql: str) -> str:
    """The same parts of whole texts, without splitting the rest of a text."""
    return re.sub(r"split_part\(text, (' '|chr\(10\)), (\d)\)", r"split_part(substring_index(text, \1, \2), \1, \2)", sql)


def catalogue(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ["reference", "analytic", "source", "event", "resource", "complement"]
    return {n: view(spark, sf_dir, n) for n in names}


def with_views(sql: str, *names: str) -> str:
    """An oracle query over views: ``sql`` may itself start with more CTEs."""
    ctes = ", ".join(f"{n} AS ({VIEWS[n].replace(_ALL, ", 'g'")})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
