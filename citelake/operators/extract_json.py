"""JSON documents (one per record) to the 13 table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.documents import (
    TEXT_KEY,
    as_list,
    body_text,
    element_text,
    full_text,
    is_object,
    node,
    text_at,
    truthy,
)
from citelake.functions.numbers import date_text, digits_only, leading_year
from citelake.functions.once import with_computed
from citelake.functions.text import blank_if_missing, join_parts, strip_chars
from citelake.schema import (
    CITATION_TAG,
    DATA_TAG,
    LINEAGE_COLUMN,
    PART_SEPARATOR,
    TABLE_COLUMNS,
)


def extract_json(documents: DataFrame) -> DataFrame:
    """Parse ``(PMID, JSON[, src])`` rows; every input row gives one output row.

    A document that is no JSON, or lacks a part, yields blanks there and keeps its text. Under
    ``spark.sql.variant.allowDuplicateKeys``, which ``build_session`` sets, a key given twice counts
    with its last value; without it such a document counts as no JSON.
    """
    lineage = [LINEAGE_COLUMN] if LINEAGE_COLUMN in documents.columns else []
    parsed = with_computed(
        documents.select(F.col("PMID").cast("string").alias("_id"), "JSON", *lineage),
        _document=F.try_parse_json("JSON"),
    )
    parts = parsed.select(
        "_id",
        "JSON",
        *lineage,
        node(F.col("_document"), CITATION_TAG).alias("_citation"),
        node(F.col("_document"), CITATION_TAG, "Article").alias("_article"),
        node(F.col("_document"), DATA_TAG).alias("_data"),
    )
    return parts.select(
        *_fields(F.col("_id"), F.col("_citation"), F.col("_article"), F.col("_data")),
        "JSON",
        *lineage,
    ).select(*TABLE_COLUMNS, *lineage)


def _fields(identifier: Column, citation: Column, article: Column, data: Column) -> list[Column]:
    own = text_at(citation, "PMID", TEXT_KEY)
    published = node(article, "Journal", "JournalIssue", "PubDate")
    # A year of 0 counts as missing as long as the date text offers another one.
    stated = digits_only(text_at(published, "Year"))
    year = F.coalesce(
        F.nullif(stated, F.lit(0)), leading_year(text_at(published, "MedlineDate")), stated
    )
    return [
        F.coalesce(
            digits_only(F.when(truthy(own), own).otherwise(identifier), "bigint"), F.lit(0)
        ).alias("PMID"),
        full_text(node(article, "ArticleTitle")).alias("Title"),
        _abstract(node(article, "Abstract", "AbstractText")).alias("Abstract"),
        _doi(node(data, "ArticleIdList", "ArticleId")).alias("DOI"),
        year.alias("Year"),
        _authors(node(article, "AuthorList", "Author")).alias("Authors"),
        full_text(node(article, "Journal", "Title")).alias("Journal"),
        _descriptors(node(citation, "MeshHeadingList", "MeshHeading")).alias("MeSH_Terms"),
        _terms(node(citation, "KeywordList", "Keyword"), lone_text=True).alias("Keywords"),
        _terms(node(article, "PublicationTypeList", "PublicationType"), lone_text=False).alias(
            "Pub_Types"
        ),
        _date(node(citation, "DateCreated")).alias("Date_Created"),
        _date(node(citation, "DateRevised")).alias("Date_Revised"),
    ]


def _one_or_many(value: Column) -> Column:
    """A list as it is, anything else as a list of one."""
    return F.coalesce(as_list(value), F.when(value.isNotNull(), F.array(value)))


def _abstract(parts: Column) -> Column:
    def labelled(part: Column) -> Column:
        label = text_at(part, "@Label")
        return F.when(
            truthy(label), F.concat(label, F.lit(": "), body_text(part))
        ).otherwise(body_text(part))

    # Labels are written out only when there are several parts to tell apart.
    many = F.array_join(F.transform(as_list(parts), labelled), PART_SEPARATOR)
    return F.coalesce(many, body_text(parts))


def _doi(identifiers: Column) -> Column:
    dois = F.filter(_one_or_many(identifiers), lambda i: text_at(i, "@IdType") == "doi")
    return blank_if_missing(text_at(F.get(dois, F.lit(0)), TEXT_KEY))


def _authors(authors: Column) -> Column:
    named = F.filter(_one_or_many(authors), lambda author: truthy(text_at(author, "LastName")))
    return join_parts(
        F.transform(
            named,
            lambda author: strip_chars(
                F.concat(
                    text_at(author, "LastName"),
                    F.lit(", "),
                    blank_if_missing(text_at(author, "ForeName")),
                ),
                ", ",
            ),
        )
    )


def _terms(terms: Column, lone_text: bool) -> Column:
    """Term texts; in a list, an object without text leaves an empty place.

    A term standing alone as plain text counts only with ``lone_text``.
    """
    texts = F.transform(as_list(terms), element_text)
    many = F.array_join(F.filter(texts, lambda text: text.isNotNull()), "; ")
    lone = element_text(terms) if lone_text else F.when(is_object(terms), element_text(terms))
    return F.coalesce(many, lone, F.lit(""))


def _descriptors(headings: Column) -> Column:
    def name(heading: Column) -> Column:
        # A heading without a name leaves an empty place; anything but a heading is passed over.
        named = node(heading, "DescriptorName")
        return F.when(
            is_object(heading),
            F.when(named.isNull(), F.lit("")).when(as_list(named).isNull(), element_text(named)),
        )

    texts = F.filter(F.transform(as_list(headings), name), lambda text: text.isNotNull())
    lone = node(headings, "DescriptorName")
    return F.coalesce(
        F.array_join(texts, "; "), F.when(is_object(lone), element_text(lone)), F.lit("")
    )


def _date(date: Column) -> Column:
    return date_text(text_at(date, "Year"), text_at(date, "Month"), text_at(date, "Day"))
