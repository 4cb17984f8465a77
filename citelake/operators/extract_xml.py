"""Record XML to the 13 table columns, with unusable records set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.markup import (
    has_special_sections,
    unescape_xml,
    without_inline_markup,
    without_special_sections,
)
from citelake.functions.numbers import date_text, leading_year, tolerant_int
from citelake.functions.once import with_computed
from citelake.functions.text import blank_if_missing, join_parts, strip_chars
from citelake.schema import (
    CITATION_TAG,
    DATA_TAG,
    LINEAGE_COLUMN,
    PART_SEPARATOR,
    TABLE_COLUMNS,
)

NOT_CLOSED = "record not closed"
MALFORMED = "malformed XML"
NO_CITATION = f"no {CITATION_TAG}"
BAD_IDENTIFIER = "identifier is not a number"

_MALFORMED_COLUMN = "_malformed"
# Filled with whatever child elements a struct of the schema does not name.
_OTHERS = "xs_any"
_DATE = "array<struct<Year: array<string>, Month: array<string>, Day: array<string>>>"
# Everything is a list: of an element that occurs more often than the format allows, the first counts.
_RECORD = f"""
{CITATION_TAG} array<struct<
  PMID: array<string>,
  DateCreated: {_DATE},
  DateRevised: {_DATE},
  Article: array<struct<
    Journal: array<struct<
      JournalIssue: array<struct<
        PubDate: array<struct<Year: array<string>, MedlineDate: array<string>>>>>,
      Title: array<string>>>,
    ArticleTitle: array<string>,
    Abstract: array<struct<AbstractText: array<
      struct<`@Label`: string, `#text`: string, {_OTHERS}: array<string>>>>>,
    AuthorList: array<struct<Author: array<struct<LastName: array<string>, ForeName: array<string>>>>>,
    PublicationTypeList: array<struct<PublicationType: array<string>>>>>,
  MeshHeadingList: array<struct<MeshHeading: array<struct<DescriptorName: array<string>>>>>,
  KeywordList: array<struct<Keyword: array<string>>>>>,
{DATA_TAG} array<struct<
  ArticleIdList: array<struct<ArticleId: array<
    struct<`@IdType`: string, `#text`: string, {_OTHERS}: array<string>>>>>>>,
{_MALFORMED_COLUMN} string
"""
_OPTIONS = {
    "attributePrefix": "@",
    "valueTag": "#text",
    "wildcardColName": _OTHERS,
    "ignoreSurroundingSpaces": "false",
    "columnNameOfCorruptRecord": _MALFORMED_COLUMN,
}
# The first DOI of the data part at any depth; its text is group 1, empty for "<ArticleId .../>".
_ANY_DOI = r"""<ArticleId\s(?:[^>]*?\s)?IdType\s*=\s*["']doi["'][^>/]*(?:/>|>([^<]*)<)"""


def extract_xml(records: DataFrame, doi_scope: str = "own") -> DataFrame:
    """Parse ``(src, raw[, closed])`` rows into table columns plus ``src``, ``raw`` and ``reason``.

    ``reason`` is null for usable records, and ``raw`` is kept only for the others. ``doi_scope``
    is "own" for the record's own identifiers or "any" to fall back on cited ones.
    """
    if doi_scope not in ("own", "any"):
        raise ValueError(f"doi_scope must be 'own' or 'any', not {doi_scope!r}")
    closed = F.col("closed") if "closed" in records.columns else F.lit(True)
    as_given = with_computed(
        records.select(LINEAGE_COLUMN, "raw", closed.alias("_closed")),
        _given=F.from_xml("raw", _RECORD, _OPTIONS),
    )
    # One parse settles most records. The few with inline markup or comments where text is wanted
    # are rewritten without and parsed again.
    given = F.col("_given")
    well_formed = given[_MALFORMED_COLUMN].isNull()
    flat = without_inline_markup(without_special_sections(F.col("raw")))
    rewritten = with_computed(
        as_given,
        _rewritten=F.when(
            well_formed & (has_special_sections(F.col("raw")) | _mixed(given)), flat
        ),
    )
    parsed = with_computed(
        rewritten,
        _flat=F.coalesce("_rewritten", "raw"),
        _record=F.when(F.col("_rewritten").isNull(), given).otherwise(
            F.from_xml("_rewritten", _RECORD, _OPTIONS)
        ),
    )
    fields = parsed.select(
        LINEAGE_COLUMN,
        "raw",
        _reason(F.col("_record"), F.col("_closed"), F.col("_flat")).alias("reason"),
        *_fields(F.col("_record"), F.col("_flat"), doi_scope),
    )
    return fields.select(
        *[c for c in TABLE_COLUMNS if c != "JSON"],
        summary_json().alias("JSON"),
        LINEAGE_COLUMN,
        F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw"),
        "reason",
    )


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("reason").isNull()).select(*TABLE_COLUMNS, LINEAGE_COLUMN)


def rejected(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("reason").isNotNull()).select(LINEAGE_COLUMN, "raw", "reason")


def summary_json() -> Column:
    """The ten extracted fields as JSON; a missing year stays as an explicit null."""
    names = [c for c in TABLE_COLUMNS if c not in ("Date_Created", "Date_Revised", "JSON")]
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def _mixed(record: Column) -> Column:
    """Whether text that is wanted has inline markup.

    The parser hands on such markup in plain text fields, so a "<" there is a sign of it (or of an
    escaped one, which only costs the second parse).
    """
    citation = _first(record[CITATION_TAG])
    article = _first(citation["Article"])
    authors = _members(article["AuthorList"], "Author")
    texts = F.concat_ws(
        "",
        article["ArticleTitle"],
        _members(article["Journal"], "Title"),
        _members(authors, "LastName"),
        _members(authors, "ForeName"),
        _descriptors(citation),
        _members(citation["KeywordList"], "Keyword"),
        _members(article["PublicationTypeList"], "PublicationType"),
    )

    def has_others(parts: Column) -> Column:
        return F.coalesce(
            F.exists(parts, lambda part: part[_OTHERS].isNotNull()), F.lit(False)
        )

    return (
        F.contains(texts, F.lit("<"))
        | has_others(_first(article["Abstract"])["AbstractText"])
        | has_others(_identifiers(record))
    )


def _reason(record: Column, closed: Column, flat: Column) -> Column:
    citation = _first(record[CITATION_TAG])
    identifier = _first(citation["PMID"])
    return (
        F.when(~closed, NOT_CLOSED)
        .when(record[_MALFORMED_COLUMN].isNotNull(), MALFORMED)
        # An empty element also parses to null, but it is there.
        .when(citation.isNull() & ~flat.rlike(rf"<{CITATION_TAG}[\s/>]"), NO_CITATION)
        .when(
            (identifier != "") & tolerant_int(identifier, "bigint").isNull(), BAD_IDENTIFIER
        )
    )


def _fields(record: Column, flat: Column, doi_scope: str) -> list[Column]:
    citation = _first(record[CITATION_TAG])
    article = _first(citation["Article"])
    issues = _members(article["Journal"], "JournalIssue")
    published = _first(_members(issues, "PubDate"))
    year = F.coalesce(
        tolerant_int(_first(published["Year"])), leading_year(_first(published["MedlineDate"]))
    )
    return [
        F.coalesce(tolerant_int(_first(citation["PMID"]), "bigint"), F.lit(0)).alias("PMID"),
        blank_if_missing(_first(article["ArticleTitle"])).alias("Title"),
        _abstract(_first(article["Abstract"])["AbstractText"]).alias("Abstract"),
        (_own_doi(record) if doi_scope == "own" else _any_doi(flat)).alias("DOI"),
        year.alias("Year"),
        _authors(_members(article["AuthorList"], "Author")).alias("Authors"),
        blank_if_missing(_first(_members(article["Journal"], "Title"))).alias("Journal"),
        _terms(_descriptors(citation)).alias("MeSH_Terms"),
        _terms(_members(citation["KeywordList"], "Keyword")).alias("Keywords"),
        _terms(_members(article["PublicationTypeList"], "PublicationType")).alias("Pub_Types"),
        _date(_first(citation["DateCreated"])).alias("Date_Created"),
        _date(_first(citation["DateRevised"])).alias("Date_Revised"),
    ]


def _first(elements: Column) -> Column:
    return F.get(elements, F.lit(0))


def _members(lists: Column, name: str) -> Column:
    """All members of all lists of a kind, in document order."""
    return F.flatten(F.filter(lists[name], lambda members: members.isNotNull()))


def _abstract(parts: Column) -> Column:
    def labelled(part: Column) -> Column:
        text = blank_if_missing(part["#text"])
        return F.when(part["@Label"] != "", F.concat(part["@Label"], F.lit(": "), text)).otherwise(
            text
        )

    return join_parts(F.transform(parts, labelled), PART_SEPARATOR)


def _authors(authors: Column) -> Column:
    named = F.filter(authors, lambda author: _first(author["LastName"]) != "")
    return join_parts(
        F.transform(
            named,
            lambda author: strip_chars(
                F.concat(
                    _first(author["LastName"]), F.lit(", "), blank_if_missing(_first(author["ForeName"]))
                ),
                ", ",
            ),
        )
    )


def _terms(terms: Column) -> Column:
    return join_parts(F.filter(terms, lambda term: term != ""))


def _descriptors(citation: Column) -> Column:
    headings = _members(citation["MeshHeadingList"], "MeshHeading")
    return F.flatten(F.filter(headings["DescriptorName"], lambda names: names.isNotNull()))


def _identifiers(record: Column) -> Column:
    return _members(_first(record[DATA_TAG])["ArticleIdList"], "ArticleId")


def _own_doi(record: Column) -> Column:
    dois = F.filter(_identifiers(record), lambda identifier: identifier["@IdType"] == "doi")
    return blank_if_missing(F.get(dois, F.lit(0))["#text"])


def _any_doi(flat: Column) -> Column:
    data = F.when(
        F.contains(flat, F.lit(f"<{DATA_TAG}")), F.substring_index(flat, f"<{DATA_TAG}", -1)
    )
    return blank_if_missing(unescape_xml(F.regexp_extract(data, _ANY_DOI, 1)))


def _date(date: Column) -> Column:
    # An empty month or day element counts as absent.
    return date_text(
        _first(date["Year"]),
        F.nullif(_first(date["Month"]), F.lit("")),
        F.nullif(_first(date["Day"]), F.lit("")),
    )
