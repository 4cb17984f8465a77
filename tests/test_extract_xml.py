from __future__ import annotations

import json

import pytest

from citelake.operators.extract_xml import (
    BAD_IDENTIFIER,
    MALFORMED,
    NO_CITATION,
    NOT_CLOSED,
    accepted,
    extract_xml,
    rejected,
)
from citelake.schema import TABLE_COLUMNS, TABLE_SCHEMA
from tests.records import record

CITED = (
    "<ReferenceList><Reference><ArticleIdList><ArticleId IdType='doi'>10.ref/1</ArticleId>"
    "</ArticleIdList></Reference></ReferenceList>"
)

CASES = {
    "title_markup": (
        record(
            title="<ArticleTitle>Effect of <i>E. coli</i> &lt;5 in H<sub>2</sub>O.</ArticleTitle>"
        ),
        {"Title": "Effect of E. coli <5 in H2O."},
    ),
    "title_nested_and_quoted": (
        record(title='<ArticleTitle book="a>b">x <i c=">"><b>y</b></i><br/> z</ArticleTitle>'),
        {"Title": "x y z"},
    ),
    "title_comment_and_cdata": (
        record(title="<ArticleTitle>a<!-- <i>no</i> --><![CDATA[<b>&]]><?pi?> c</ArticleTitle>"),
        {"Title": "a<b>& c"},
    ),
    "title_spaces_kept": (
        record(title="<ArticleTitle> a\n b </ArticleTitle>"),
        {"Title": " a\n b "},
    ),
    "title_formula": (
        record(
            title='<ArticleTitle>f <mml:math xmlns:mml="u"><mml:i>x</mml:i></mml:math></ArticleTitle>'
        ),
        {"Title": "f x"},
    ),
    "abstract_parts": (
        record(
            abstract='<Abstract><AbstractText Label="AIMS">To test <b>x</b> now.</AbstractText>'
            "<AbstractText>Plain.</AbstractText><AbstractText/></Abstract>",
            citation="<OtherAbstract><AbstractText>other</AbstractText></OtherAbstract>",
        ),
        {"Abstract": "AIMS: To test x now. Plain. "},
    ),
    "abstract_labels": (
        record(
            abstract='<Abstract><AbstractText Label="">a</AbstractText>'
            '<AbstractText NlmCategory="X" Label="A &amp; B">b</AbstractText></Abstract>'
        ),
        {"Abstract": "a A & B: b"},
    ),
    "abstract_empty_child": (
        record(abstract="<Abstract><AbstractText>x<br/>y</AbstractText></Abstract>"),
        {"Abstract": "xy"},
    ),
    "other_abstract_only": (
        record(citation="<OtherAbstract><AbstractText>other</AbstractText></OtherAbstract>"),
        {"Abstract": ""},
    ),
    "own_doi": (
        record(
            data='<ArticleIdList><ArticleId IdType="pii">p</ArticleId><ArticleId IdType="doi">'
            f"10.1/a&lt;b</ArticleId></ArticleIdList>{CITED}"
        ),
        {"DOI": "10.1/a<b"},
    ),
    "cited_doi": (record(data=CITED), {"DOI": ""}),
    "year": (record(date="<Year>1999</Year>"), {"Year": 1999}),
    "year_from_text": (
        record(date="<MedlineDate>1998 Dec-1999 Jan</MedlineDate>"),
        {"Year": 1998},
    ),
    "year_not_leading": (record(date="<MedlineDate>Winter 1998</MedlineDate>"), {"Year": None}),
    "no_date": (record(), {"Year": None}),
    "year_fallback": (
        record(date="<Year>19x9</Year><MedlineDate>1999</MedlineDate>"),
        {"Year": 1999},
    ),
    "year_far_away": (record(date="<Year>3115</Year>"), {"Year": 3115}),
    "authors": (
        record(
            article="<AuthorList><Author><LastName>Doe</LastName><ForeName>Al</ForeName></Author>"
            "<Author><CollectiveName>Group</CollectiveName></Author>"
            "<Author><LastName>Solo</LastName></Author></AuthorList>"
        ),
        {"Authors": "Doe, Al; Solo"},
    ),
    "author_name_markup": (
        record(
            article="<AuthorList><Author><LastName>M<sup>c</sup>D</LastName>"
            "<ForeName>, A ,</ForeName></Author></AuthorList>"
        ),
        {"Authors": "M, , A"},
    ),
    "no_authors": (record(), {"Authors": ""}),
    "journal": (record(journal="<Title>J &amp; K</Title>"), {"Journal": "J & K"}),
    "keyword_lists": (
        record(
            citation="<KeywordList><Keyword>k1</Keyword><Keyword/></KeywordList>"
            "<KeywordList><Keyword>k2</Keyword></KeywordList>"
        ),
        {"Keywords": "k1; k2"},
    ),
    "keyword_markup": (
        record(
            citation='<KeywordList><Keyword MajorTopicYN="N">a<i>b</i>c</Keyword>'
            "<Keyword><i>z</i>q</Keyword><Keyword MajorTopicYN='Y'/><Keyword>p &lt; 1</Keyword>"
            "</KeywordList>"
        ),
        {"Keywords": "a; p < 1"},
    ),
    "subjects": (
        record(
            citation='<MeshHeadingList><MeshHeading><DescriptorName UI="D1">a</DescriptorName>'
            "<QualifierName>q</QualifierName></MeshHeading><MeshHeading><DescriptorName>b"
            "</DescriptorName></MeshHeading></MeshHeadingList>"
        ),
        {"MeSH_Terms": "a; b"},
    ),
    "types": (
        record(
            article='<PublicationTypeList><PublicationType UI="D">Review</PublicationType>'
            "<PublicationType/><PublicationType>Letter</PublicationType></PublicationTypeList>"
        ),
        {"Pub_Types": "Review; Letter"},
    ),
    "date_defaults": (
        record(citation="<DateRevised><Year>2020</Year><Day>3</Day></DateRevised>"),
        {"Date_Revised": "2020-01-3", "Date_Created": ""},
    ),
    "date_empty_parts": (
        record(citation="<DateCreated><Year>2020</Year><Month/><Day></Day></DateCreated>"),
        {"Date_Created": "2020-01-01"},
    ),
    "date_without_year": (
        record(citation="<DateRevised><Month>02</Month></DateRevised>"),
        {"Date_Revised": ""},
    ),
    "id_missing": (record(pmid=""), {"PMID": 0}),
    "id_empty": (record(pmid="<PMID/>"), {"PMID": 0}),
    "id_spaced": (record(pmid="<PMID> 12 </PMID>"), {"PMID": 12}),
    "citation_empty": (
        "<PubmedArticle><MedlineCitation/></PubmedArticle>",
        {"PMID": 0, "Title": "", "Year": None},
    ),
}
REJECTS = {
    "no_citation": ("<PubmedArticle><PubmedData/></PubmedArticle>", NO_CITATION),
    "bad_id": (record(pmid="<PMID>abc</PMID>"), BAD_IDENTIFIER),
    "bad_inline": (record(title="<ArticleTitle>a<i>b</u></ArticleTitle>"), MALFORMED),
    "bad_entity": (record(title="<ArticleTitle>a &nbsp; b</ArticleTitle>"), MALFORMED),
    "bad_comment": (record(title="<ArticleTitle>a<!-- b</ArticleTitle>"), MALFORMED),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(name, xml) for name, (xml, _) in {**CASES, **REJECTS}.items()]
    frame = extract_xml(spark.createDataFrame(rows, "src string, raw string"))
    return {row.src: row for row in frame.collect()}


@pytest.mark.parametrize("case", CASES)
def test_field(extracted, case):
    row = extracted[case]
    assert row.reason is None and row.raw is None
    for column, value in CASES[case][1].items():
        assert row[column] == value


@pytest.mark.parametrize("case", REJECTS)
def test_reject(extracted, case):
    xml, reason = REJECTS[case]
    assert extracted[case].reason == reason
    assert extracted[case].raw == xml


def test_only_year_is_ever_null(extracted):
    for row in extracted.values():
        if row.reason is None:
            assert all(row[c] is not None for c in TABLE_COLUMNS if c != "Year")


def test_summary_keeps_null_year(extracted):
    row = extracted["no_date"]
    summary = json.loads(row.JSON)
    assert list(summary) == TABLE_COLUMNS[:10]
    assert summary["Year"] is None and summary["PMID"] == 1


def test_any_doi_scope(spark):
    rows = [("f", CASES[c][0]) for c in ("own_doi", "cited_doi", "no_date")]
    frame = extract_xml(spark.createDataFrame(rows, "src string, raw string"), doi_scope="any")
    assert [r.DOI for r in frame.collect()] == ["10.1/a<b", "10.ref/1", ""]
    with pytest.raises(ValueError):
        extract_xml(frame, doi_scope="all")


def test_schema_and_split(spark):
    rows = [("f", record()), ("f", "<PubmedArticle/>"), ("f", record(pmid="<PMID>x</PMID>"))]
    frame = extract_xml(spark.createDataFrame(rows, "src string, raw string"))
    kept = accepted(frame)
    assert [(f.name, f.dataType) for f in kept.schema][:13] == [
        (f.name, f.dataType) for f in TABLE_SCHEMA
    ]
    assert kept.count() == 1
    assert {r.reason for r in rejected(frame).collect()} == {NO_CITATION, BAD_IDENTIFIER}


def test_unclosed_record_is_rejected(spark):
    rows = [("f", record(), False), ("f", record(), True)]
    frame = extract_xml(spark.createDataFrame(rows, "src string, raw string, closed boolean"))
    assert [r.reason for r in frame.collect()] == [NOT_CLOSED, None]


def test_plan_parses_a_record_at_most_twice(spark):
    frame = extract_xml(spark.createDataFrame([("f", record())], "src string, raw string"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 2
    assert "Python" not in plan and "Exchange" not in plan


def test_filters_do_not_repeat_the_parse(spark):
    frame = extract_xml(spark.createDataFrame([("f", record())], "src string, raw string"))
    for filtered in (accepted(frame), rejected(frame), accepted(frame).filter("Title ILIKE '%a%'")):
        plan = filtered._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") == 2


def test_long_texts_stay_whole(spark):
    words = "lorem &lt;ipsum&gt; <i>dolor</i> " * 60_000
    plain = "lorem &amp; ipsum\n" * 60_000
    rows = [
        ("mixed", record(abstract=f'<Abstract><AbstractText Label="A">{words}</AbstractText></Abstract>')),
        ("plain", record(abstract=f'<Abstract><AbstractText Label="A">{plain}</AbstractText></Abstract>')),
        ("comment", record(title=f"<ArticleTitle>{plain}<!-- x -->{plain}</ArticleTitle>")),
    ]
    found = {r.src: r for r in extract_xml(spark.createDataFrame(rows, "src string, raw string")).collect()}
    assert found["mixed"].Abstract == "A: " + "lorem <ipsum> dolor " * 60_000
    assert found["plain"].Abstract == "A: " + "lorem & ipsum\n" * 60_000
    assert found["comment"].Title == "lorem & ipsum\n" * 120_000


def test_many_lists_and_members(spark):
    authors = "".join(
        f"<Author><LastName>L{i}</LastName><ForeName>F</ForeName></Author>" for i in range(3000)
    )
    rows = [("f", record(article=f"<AuthorList>{authors}</AuthorList>"))]
    row = extract_xml(spark.createDataFrame(rows, "src string, raw string")).first()
    assert row.Authors == "; ".join(f"L{i}, F" for i in range(3000))
