"""Registry of queries and their reference SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twinfold.session import stage_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def in_order(df: DataFrame, by: str) -> DataFrame:
    """Add ``place``: how the rows of each group follow each other in an ordered frame."""
    rows = df.withColumn("_at", F.monotonically_increasing_id())
    return rows.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy("_at")).cast("long")).drop("_at")


def sql_key(x: str) -> str:
    return f"regexp_replace(strip_accents(lower({x})), '[^a-z0-9]', '', 'g')"


def sql_text(x: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({x})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def sql_rec_key(id_: str = "id", db: str = "database") -> str:
    return sql_key(f"concat(split_part({id_}, '^', 1), {db})")


def sql_bigrams(x: str) -> str:
    return f"list_distinct(list_concat(regexp_extract_all({x}, '(?s)..'), regexp_extract_all(substr({x}, 2), '(?s)..')))"


SQL_CELLS = "string_split_regex(trim(value), ' *\\| *')"


def sql_similarity(texts: str) -> str:
    """CTEs up to ``near`` (a, b, sim): trigram similarity of the distinct text pairs of ``texts`` (a, b).

    The rows of the distance table follow each other by recursion; inside a row, insertions are a running minimum.
    """
    grams = "[unicode(c) for c in string_split(concat(chr(1), chr(1), {}), '')]"
    return f"""kp AS MATERIALIZED (SELECT row_number() OVER () AS id, a, b FROM (SELECT DISTINCT a, b FROM ({texts}))),
    ks AS MATERIALIZED (SELECT id, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS a,
            CASE WHEN length(a) <= length(b) THEN b ELSE a END AS b
        FROM kp WHERE a <> b AND length(a) >= 3 AND length(b) >= 3),
    ka AS MATERIALIZED (SELECT id, i, u[i] AS x0, u[i+1] AS x1, u[i+2] AS x2
        FROM (SELECT id, {grams.format('a')} AS u, unnest(range(1, length(a) + 1)) AS i FROM ks)),
    kb AS MATERIALIZED (SELECT id, j, u[j] AS y0, u[j+1] AS y1, u[j+2] AS y2
        FROM (SELECT id, {grams.format('b')} AS u, unnest(range(0, length(b) + 1)) AS j FROM ks)),
    kr(id, j, i, d, y0, y1, y2) USING KEY (id, j) AS (
        SELECT id, j, 0 AS i, j::DOUBLE AS d, y0, y1, y2 FROM kb
        UNION
        SELECT id, j, i, j + min(m - j) OVER (PARTITION BY id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), y0, y1, y2
        FROM (SELECT kr.id, kr.j, kr.i + 1 AS i, y0, y1, y2, CASE WHEN kr.j = 0 THEN kr.i + 1 ELSE least(d + 1,
                lag(d) OVER (PARTITION BY kr.id ORDER BY kr.j) + ((x0 <> y0)::INT + (x1 <> y1)::INT + (x2 <> y2)::INT)::DOUBLE
                / (3 - (x0 = 1 AND y0 = 1)::INT - (x1 = 1 AND y1 = 1)::INT - (x2 = 1 AND y2 = 1)::INT)) END AS m
            FROM kr JOIN ka ON ka.id = kr.id AND ka.i = kr.i + 1)),
    near AS MATERIALIZED (SELECT kp.a, kp.b, CASE WHEN kp.a = kp.b THEN 1.0 WHEN kp.a = '' OR kp.b = '' THEN 0.0
            WHEN least(length(kp.a), length(kp.b)) < 3 THEN list_sum([(kp.a[i] = kp.b[i])::INT
                for i in range(1, least(length(kp.a), length(kp.b)) + 1)]) / greatest(length(kp.a), length(kp.b))::DOUBLE
            ELSE 1 - d / greatest(length(kp.a), length(kp.b)) END AS sim
        FROM kp LEFT JOIN (SELECT kr.id, d FROM kr JOIN ks ON ks.id = kr.id AND kr.i = length(ks.a) AND kr.j = length(ks.b))
            USING (id))"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)
