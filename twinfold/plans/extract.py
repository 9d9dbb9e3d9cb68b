"""Extraction of match-ready records from the relational catalogue.

``tables`` maps the roles ``reference``, ``analytic``, ``source``, ``event``,
``resource`` and ``complement`` to DataFrames. Joins are inner equi-joins on ids;
Catalyst pushes the filters below them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import author_fallback, blank_address, edit_link, prefixed_id, year4

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Tags:
    """Values an installation chooses: database tags, id prefix, edit-page addresses."""

    article: str = "article"
    issue: str = "issue"
    monograph: str = "monograph"
    chapter: str = "chapter"
    event: str = "event"
    resource: str = "resource"
    id_prefix: str = "admin"
    analytic_url: str = "https://example.org/edit-analytic/"
    source_url: str = "https://example.org/edit-source/"


def literature_is(kind: str, column: str = "literature_type") -> Column:
    return F.left(F.col(column), F.lit(1)) == kind


def literature_in(*kinds: str, column: str = "literature_type") -> Column:
    return F.left(F.col(column), F.lit(1)).isin(*kinds)


def translated(column: str = "english_translated_title") -> Column:
    return ~F.col(column).isin("", "x")


def non_blank(column: str) -> Column:
    return F.col(column) != ""


def _reference(t: Tables, prefix: str = "r_") -> DataFrame:
    return t["reference"].select(*[F.col(c).alias(prefix + c) for c in t["reference"].columns])


def _source(t: Tables, prefix: str = "s_") -> DataFrame:
    return t["source"].select(*[F.col(c).alias(prefix + c) for c in t["source"].columns])


def article_rows(t: Tables) -> DataFrame:
    """Analytic with its source and the source's own reference row, literature S."""
    parent = _reference(t).where(literature_is("S", "r_literature_type"))
    return (
        t["analytic"]
        .join(_source(t), F.col("source_id") == F.col("s_reference_ptr_id"))
        .join(parent, F.col("source_id") == F.col("r_id"))
    )


def chapter_rows(t: Tables) -> DataFrame:
    """Analytic with its own reference row and its source."""
    return (
        _reference(t)
        .join(t["analytic"], F.col("r_id") == F.col("reference_ptr_id"))
        .join(_source(t), F.col("source_id") == F.col("s_reference_ptr_id"))
    )


def monograph_rows(t: Tables) -> DataFrame:
    """Reference with its source, literature M, N or T."""
    return _reference(t).where(literature_in("M", "N", "T", column="r_literature_type")).join(
        _source(t), F.col("r_id") == F.col("s_reference_ptr_id")
    )


def _year() -> Column:
    return year4("r_publication_date_normalized").alias("publication_year")


def _details(tags: Tags, blank: bool = True) -> list[Column]:
    address = blank_address("r_electronic_address") if blank else F.col("r_electronic_address")
    return [
        F.col("r_cooperative_center_code").alias("cooperative_center_code"),
        F.col("r_literature_type").alias("literature_type"),
        F.col("r_treatment_level").alias("treatment_level"),
        F.col("r_status").alias("status"),
        address.alias("electronic_address"),
    ]


def _article_columns(tags: Tags, title: str, full: bool = True, blank: bool = True, prefix: bool = False) -> list[Column]:
    ident = prefixed_id(tags.id_prefix, "reference_ptr_id") if prefix else F.col("reference_ptr_id")
    out = [
        F.lit(tags.article).alias("dbase"),
        ident.alias("reference_ptr_id"),
        F.col(title),
        F.col("s_title_serial").alias("title_serial"),
        _year(),
        F.col("s_volume_serial").alias("volume_serial"),
        F.col("s_issue_number").alias("issue_number"),
    ]
    if full:
        out += [
            author_fallback("individual_author", "corporate_author").alias("author"),
            F.col("pages"),
            *_details(tags, blank),
            edit_link(tags.analytic_url, "reference_ptr_id").alias("link"),
        ]
    return out


def articles(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return article_rows(t).select(*_article_columns(tags, "title"))


def articles_translated(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return article_rows(t).where(translated()).select(*_article_columns(tags, "english_translated_title"))


def articles_brief(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return article_rows(t).select(*_article_columns(tags, "title", full=False))


def articles_translated_brief(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return (
        article_rows(t)
        .where(translated())
        .select(*_article_columns(tags, "english_translated_title", full=False, prefix=True))
    )


def issues(t: Tables, tags: Tags = Tags()) -> DataFrame:
    parent = _reference(t).where(F.col("r_literature_type").startswith("S") & (F.col("r_treatment_level") == ""))
    return _source(t).join(parent, F.col("r_id") == F.col("s_reference_ptr_id")).select(
        F.lit(tags.issue).alias("dbase"),
        prefixed_id(tags.id_prefix, "r_id").alias("id"),
        F.col("s_title_serial").alias("title_serial"),
        F.col("s_issn").alias("issn"),
        F.col("s_volume_serial").alias("volume_serial"),
        F.col("s_issue_number").alias("issue_number"),
        _year(),
    )


def _by_own_year(t: Tables, tags: Tags, title: str, rows: DataFrame) -> DataFrame:
    return rows.select(
        F.lit(tags.article).alias("dbase"),
        F.col("r_id").alias("id"),
        F.col(title),
        F.col("s_title_serial").alias("title_serial"),
        _year(),
        F.col("s_volume_serial").alias("volume_serial"),
        F.col("s_issue_number").alias("issue_number"),
        author_fallback("corporate_author", "individual_author").alias("author"),
        F.col("pages"),
    )


def _own_year_rows(t: Tables) -> DataFrame:
    return chapter_rows(t).where(literature_is("S", "r_literature_type") & (F.col("r_treatment_level") == "as"))


def articles_own_year(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return _by_own_year(t, tags, "title", _own_year_rows(t))


def articles_translated_own_year(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return _by_own_year(t, tags, "english_translated_title", _own_year_rows(t).where(translated()))


def monographs(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return monograph_rows(t).select(
        F.lit(tags.monograph).alias("dbase"),
        F.col("r_id").alias("id"),
        F.col("s_title_monographic").alias("title_monographic"),
        _year(),
        author_fallback("s_individual_author_monographic", "s_corporate_author_monographic").alias("author"),
        F.col("s_pages_monographic").alias("pages_monographic"),
        F.col("s_volume_serial").alias("volume_serial"),
        F.col("s_issue_number").alias("issue_number"),
    )


def monographs_detailed(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return monograph_rows(t).select(
        F.lit(tags.monograph).alias("dbase"),
        F.col("r_id").alias("id"),
        F.col("s_title_monographic").alias("title_monographic"),
        _year(),
        author_fallback("s_individual_author_monographic", "s_corporate_author_monographic").alias("author"),
        F.col("s_pages_monographic").alias("pages_monographic"),
        F.col("s_volume_monographic").alias("volume_monographic"),
        F.col("s_issue_number").alias("issue_number"),
        *_details(tags, blank=False),
        edit_link(tags.source_url, "s_reference_ptr_id").alias("link"),
    )


def articles_detailed(t: Tables, tags: Tags = Tags()) -> DataFrame:
    """As ``articles``, addresses left as stored."""
    return article_rows(t).select(*_article_columns(tags, "title", blank=False))


def _chapter_columns(tags: Tags, title: str) -> list[Column]:
    return [
        F.lit(tags.chapter).alias("dbase"),
        F.col("r_id").alias("id"),
        F.col(title),
        F.col("s_title_monographic").alias("title_monographic"),
        _year(),
        author_fallback("individual_author", "corporate_author").alias("author"),
        F.col("pages"),
        F.col("s_volume_monographic").alias("volume_monographic"),
        F.col("s_issue_number").alias("issue_number"),
        *_details(tags),
        edit_link(tags.analytic_url, "reference_ptr_id").alias("link"),
    ]


def _chapters(t: Tables) -> DataFrame:
    return chapter_rows(t).where(
        (F.left("r_literature_type", F.lit(1)) != "S") & (F.left("r_treatment_level", F.lit(1)) == "a")
    )


def chapters(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return _chapters(t).select(*_chapter_columns(tags, "title"))


def chapters_translated(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return _chapters(t).where(translated()).select(*_chapter_columns(tags, "english_translated_title"))


def events(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return t["event"].select(F.lit(tags.event).alias("dbase"), "id", "title", "start_date", "link")


def resources(t: Tables, tags: Tags = Tags()) -> DataFrame:
    return t["resource"].select(F.lit(tags.resource).alias("dbase"), "id", "title", "link")


def publication_dates(t: Tables) -> DataFrame:
    return t["reference"].where(non_blank("publication_date")).select("id", "publication_date")


def publication_dates_normalized(t: Tables) -> DataFrame:
    return (
        t["reference"]
        .where(non_blank("publication_date"))
        .select("id", "publication_date", "publication_date_normalized")
    )


def conference_dates(t: Tables) -> DataFrame:
    return t["complement"].select("id", "conference_date", "conference_normalized_date")


def first_references(t: Tables, kind: str = "S", count: int = 500) -> DataFrame:
    """The first references of one literature type, by id."""
    return (
        t["reference"]
        .where(F.col("literature_type") == kind)
        .select("id", "reference_title", "publication_date")
        .orderBy("id")
        .limit(count)
    )


def distinct_serials(t: Tables, kind: str = "S") -> DataFrame:
    """Distinct (original id, serial title, volume) of references and their sources.

    The sources are tied to their reference by id.
    """
    refs = _reference(t).where(F.col("r_literature_type") == kind)
    return (
        refs.join(_source(t).where("s_title_serial <> ''"), F.col("r_id") == F.col("s_reference_ptr_id"))
        .select(
            F.col("r_original_id").alias("original_id"),
            F.col("s_title_serial").alias("title_serial"),
            F.col("s_volume_serial").alias("volume_serial"),
        )
        .distinct()
    )
