from __future__ import annotations

import json

import pytest

from citelake.operators.extract_json import extract_json
from citelake.schema import TABLE_COLUMNS


def document(article=None, data=None, **citation) -> str:
    citation["Article"] = article or {}
    return json.dumps({"MedlineCitation": citation, "PubmedData": data or {}})


def dated(**date) -> str:
    return document({"Journal": {"JournalIssue": {"PubDate": date}}})


def abstract(parts) -> str:
    return document({"Abstract": {"AbstractText": parts}})


CASES = {
    "lone_labelled_part": (abstract({"@Label": "AIMS", "#text": "a"}), {"Abstract": "a"}),
    "labelled_parts": (
        abstract([{"@Label": "AIMS", "#text": "a"}, {"#text": "b"}, "c", None]),
        {"Abstract": "AIMS: a b c "},
    ),
    "part_without_text": (abstract([{"i": "x"}]), {"Abstract": '{"i":"x"}'}),
    "title_text": (document({"ArticleTitle": "t"}), {"Title": "t"}),
    "title_object": (document({"ArticleTitle": {"i": "x", "#text": "t"}}), {"Title": "t"}),
    "title_list": (document({"ArticleTitle": ["t", {"#text": "u"}]}), {"Title": "t u"}),
    "title_null": (document({"ArticleTitle": None}), {"Title": ""}),
    "doi_list": (
        document(
            data={
                "ArticleIdList": {
                    "ArticleId": [
                        {"@IdType": "pii", "#text": "p"},
                        "loose",
                        {"@IdType": "doi", "#text": "10.1/a"},
                        {"@IdType": "doi", "#text": "10.1/b"},
                    ]
                }
            }
        ),
        {"DOI": "10.1/a"},
    ),
    "doi_lone": (
        document(data={"ArticleIdList": {"ArticleId": {"@IdType": "doi", "#text": "10.1/a"}}}),
        {"DOI": "10.1/a"},
    ),
    "doi_without_text": (
        document(data={"ArticleIdList": {"ArticleId": [{"@IdType": "doi"}]}}),
        {"DOI": ""},
    ),
    "year": (dated(Year="1999"), {"Year": 1999}),
    "year_spaced": (dated(Year=" 1999"), {"Year": None}),
    "year_zero_fallback": (dated(Year="0", MedlineDate="1998 Dec"), {"Year": 1998}),
    "year_zero": (dated(Year="0"), {"Year": 0}),
    "year_bad": (dated(Year="19x9", MedlineDate="199"), {"Year": None}),
    "authors": (
        document(
            {
                "AuthorList": {
                    "Author": [
                        {"LastName": "Doe", "ForeName": "Al"},
                        {"CollectiveName": "C"},
                        {"LastName": "Solo"},
                        {"LastName": "Poe", "ForeName": None},
                        "loose",
                    ]
                }
            }
        ),
        {"Authors": "Doe, Al; Solo; Poe"},
    ),
    "author_lone": (
        document({"AuthorList": {"Author": {"LastName": "Doe", "ForeName": "Al"}}}),
        {"Authors": "Doe, Al"},
    ),
    "journal": (document({"Journal": {"Title": {"#text": "J"}}}), {"Journal": "J"}),
    "subject_gap": (
        document(
            MeshHeadingList={
                "MeshHeading": [
                    {"DescriptorName": {"#text": "a"}},
                    {"DescriptorName": {"@UI": "D"}},
                    {"DescriptorName": "b"},
                ]
            }
        ),
        {"MeSH_Terms": "a; ; b"},
    ),
    "subject_lone_text": (
        document(MeshHeadingList={"MeshHeading": {"DescriptorName": "a"}}),
        {"MeSH_Terms": ""},
    ),
    "keywords": (
        document(KeywordList={"Keyword": ["a", {"#text": "b"}, {"@x": "1"}, None]}),
        {"Keywords": "a; b; "},
    ),
    "keyword_lone_text": (document(KeywordList={"Keyword": "a"}), {"Keywords": "a"}),
    "two_keyword_lists": (
        document(KeywordList=[{"Keyword": "a"}, {"Keyword": "b"}]),
        {"Keywords": ""},
    ),
    "type_lone_text": (
        document({"PublicationTypeList": {"PublicationType": "Review"}}),
        {"Pub_Types": ""},
    ),
    "type_lone": (
        document({"PublicationTypeList": {"PublicationType": {"#text": "Review"}}}),
        {"Pub_Types": "Review"},
    ),
    "dates": (
        document(DateCreated={"Year": "2001", "Day": "3"}, DateRevised={"Month": "1"}),
        {"Date_Created": "2001-01-3", "Date_Revised": ""},
    ),
    "date_empty_month": (
        document(DateCreated={"Year": "2001", "Month": ""}),
        {"Date_Created": "2001--01"},
    ),
    "own_id": (document(PMID={"#text": "7"}), {"PMID": 7}),
    "id_as_text": (document(PMID="7"), {"PMID": 42}),
    "id_bad": (document(PMID={"#text": "7a"}), {"PMID": 0}),
    "no_article": ('{"MedlineCitation": {"Article": null}}', {"Title": "", "PMID": 42}),
    "no_citation": ("{}", {"Title": "", "PMID": 42}),
    "not_an_object": ("[1]", {"Title": "", "PMID": 42}),
    "no_json": ("{bad", {"Title": "", "PMID": 42, "Year": None}),
    "repeated_key": (
        '{"MedlineCitation": {"PMID": {"#text": "7"}, "PMID": {"#text": "8"}}}',
        {"PMID": 8},
    ),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [("42", text, name) for name, (text, _) in CASES.items()]
    frame = extract_json(spark.createDataFrame(rows, "PMID string, JSON string, src string"))
    return {row.src: row for row in frame.collect()}


@pytest.mark.parametrize("case", CASES)
def test_field(extracted, case):
    text, expected = CASES[case]
    for column, value in expected.items():
        assert extracted[case][column] == value
    assert extracted[case].JSON == text


def test_only_year_is_ever_null(extracted):
    for row in extracted.values():
        assert all(row[c] is not None for c in TABLE_COLUMNS if c != "Year")


def test_id_column_that_is_no_number(spark):
    rows = spark.createDataFrame([("x1", "{bad")], "PMID string, JSON string")
    assert extract_json(rows).first().PMID == 0


def test_document_is_parsed_once(spark):
    frame = extract_json(spark.createDataFrame([("1", "{}")], "PMID string, JSON string"))
    for rows in (frame, frame.filter("Title ILIKE '%a%' AND Year > 2000")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson(") == 1
