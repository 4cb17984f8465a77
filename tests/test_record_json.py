from __future__ import annotations

import json

from citelake.operators.extract_json import extract_json
from citelake.operators.extract_xml import MALFORMED, extract_xml
from citelake.operators.record_json import to_documents, to_trees
from tests.records import record

FULL = record(
    pmid='<PMID Version="1">12</PMID>',
    title="<ArticleTitle>On <i>it</i> &amp; \"that\"</ArticleTitle>",
    abstract='<Abstract><AbstractText Label="AIMS">a</AbstractText><AbstractText/></Abstract>',
    date="<Year>2001</Year>",
    journal="<Title>J</Title>",
    article='<AuthorList CompleteYN="Y"><Author><LastName>Doe</LastName><ForeName>Al</ForeName>'
    "<AffiliationInfo><Affiliation>U</Affiliation></AffiliationInfo></Author></AuthorList>",
    citation="<MeshHeadingList><MeshHeading><DescriptorName UI='D1'>a</DescriptorName>"
    "<QualifierName>q</QualifierName></MeshHeading></MeshHeadingList>"
    "<KeywordList><Keyword>k1</Keyword><Keyword MajorTopicYN='N'>k2</Keyword></KeywordList>",
    data='<ArticleIdList><ArticleId IdType="doi">10.1/a</ArticleId></ArticleIdList>',
)


def one(frame):
    return frame.collect()[0]


def records(spark, *texts):
    return spark.createDataFrame([("f1", text) for text in texts], "src string, raw string")


def test_document_shape(spark):
    row = one(to_documents(records(spark, FULL)))
    document = json.loads(row.JSON)
    citation = document["MedlineCitation"]
    assert row.PMID == "12" and citation["PMID"] == {"@Version": "1", "#text": "12"}
    assert citation["Article"]["ArticleTitle"] == 'On it & "that"'
    assert citation["Article"]["Abstract"]["AbstractText"] == [
        {"@Label": "AIMS", "#text": "a"},
        None,
    ]
    assert citation["Article"]["AuthorList"] == {
        "@CompleteYN": "Y",
        "Author": {
            "LastName": "Doe",
            "ForeName": "Al",
            "AffiliationInfo": {"Affiliation": "U"},
        },
    }
    assert citation["MeshHeadingList"] == {
        "MeshHeading": {
            "DescriptorName": {"@UI": "D1", "#text": "a"},
            "QualifierName": "q",
        }
    }
    assert citation["KeywordList"] == {
        "Keyword": ["k1", {"@MajorTopicYN": "N", "#text": "k2"}]
    }
    assert document["PubmedData"] == {
        "ArticleIdList": {"ArticleId": {"@IdType": "doi", "#text": "10.1/a"}}
    }


def test_document_gives_the_same_fields(spark):
    raw = records(spark, FULL)
    direct = one(extract_xml(raw)).asDict()
    through = one(extract_json(to_documents(raw))).asDict()
    for column in ("PMID", "Title", "Year", "DOI", "Authors", "Journal", "MeSH_Terms", "Keywords"):
        assert direct[column] == through[column]


def test_tree_shape(spark):
    row = one(to_trees(records(spark, FULL)))
    tree = json.loads(row.json)
    citation = tree["MedlineCitation"]
    assert row.pmid == 12 and row.src == "f1"
    assert citation["PMID"] == "12"
    assert citation["Article"]["AuthorList"] == [
        {"LastName": "Doe", "ForeName": "Al", "AffiliationInfo": [{"Affiliation": "U"}]}
    ]
    assert citation["Article"]["Abstract"]["AbstractText"] == ["a", ""]
    assert citation["MeshHeadingList"] == [{"DescriptorName": "a", "QualifierName": ["q"]}]
    assert tree["PubmedData"]["ArticleIdList"] == ["10.1/a"]


def test_broken_record_is_set_aside(spark):
    broken = FULL.replace("</i>", "</b>")
    for frame in (to_documents(records(spark, broken)), to_trees(records(spark, broken))):
        row = one(frame)
        assert row.reason == MALFORMED and row.raw == broken


def test_filters_do_not_repeat_the_parse(spark):
    for frame in (to_documents(records(spark, FULL)), to_trees(records(spark, FULL))):
        plan = frame.filter("reason IS NULL")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") == 2


DEEP = "<ReferenceList><ReferenceList><ReferenceList><Title>t</Title></ReferenceList></ReferenceList></ReferenceList>"
# Records with something at a path that the format does not have, and where a document holds it.
STRANGE = {
    "element": (record(citation="<Novel>text</Novel>"), ["MedlineCitation", "Novel"], "text"),
    "attribute": (
        record(journal='<Title Novel="x">J</Title>'),
        ["MedlineCitation", "Article", "Journal", "Title"],
        {"@Novel": "x", "#text": "J"},
    ),
    "second attribute": (
        record(pmid='<PMID Version="1" Novel="x">1</PMID>'),
        ["MedlineCitation", "PMID"],
        {"@Version": "1", "@Novel": "x", "#text": "1"},
    ),
    "nesting": (
        record(data=DEEP),
        ["PubmedData", "ReferenceList", "ReferenceList", "ReferenceList", "Title"],
        "t",
    ),
    "data": (record(data="<NewChild/>"), ["PubmedData", "NewChild"], None),
    "known element elsewhere": (
        record(article="<Suffix>Jr</Suffix>"),
        ["MedlineCitation", "Article", "Suffix"],
        "Jr",
    ),
    "known attribute elsewhere": (
        record(title='<ArticleTitle UI="D1">t</ArticleTitle>'),
        ["MedlineCitation", "Article", "ArticleTitle"],
        {"@UI": "D1", "#text": "t"},
    ),
}


def at(document, path):
    for name in path:
        document = document[name]
    return document


def test_what_the_schema_lacks_is_kept(spark):
    raws = [raw for raw, _, _ in STRANGE.values()]
    documents = to_documents(records(spark, *raws)).collect()
    for row, (raw, path, value) in zip(documents, STRANGE.values(), strict=True):
        assert at(json.loads(row.JSON), path) == value, raw
    for row, raw in zip(to_trees(records(spark, *raws)).collect(), raws, strict=True):
        assert json.loads(row.json)["#raw"] == raw
    for spell in (to_documents, to_trees):
        assert "#raw" not in json.loads(one(spell(records(spark, FULL)))[1])
        text = record(title="<ArticleTitle>a = 'b' and x=\"y\" > z</ArticleTitle>")
        assert "#raw" not in json.loads(one(spell(records(spark, text)))[1])


def test_repeated_single_elements_are_all_kept(spark):
    raw = record(
        pmid='<PMID Version="1">5</PMID><PMID>6</PMID>',
        title="<ArticleTitle>A</ArticleTitle><ArticleTitle>B</ArticleTitle>",
        date="<Year>2001</Year><Year>2002</Year>",
        journal="<Title>J</Title><Title>K</Title>",
    )
    row = one(to_documents(records(spark, raw)))
    article = json.loads(row.JSON)["MedlineCitation"]["Article"]
    assert row.PMID == "5" and article["ArticleTitle"] == ["A", "B"]
    assert article["Journal"]["JournalIssue"]["PubDate"]["Year"] == ["2001", "2002"]
    row = one(to_trees(records(spark, raw)))
    tree = json.loads(row.json)
    assert row.pmid == 5 and "#raw" not in tree
    assert tree["MedlineCitation"]["Article"]["ArticleTitle"] == ["A", "B"]
    assert tree["MedlineCitation"]["Article"]["Journal"]["Title"] == ["J", "K"]
    # the table takes the first of each
    found = one(extract_xml(records(spark, raw)))
    assert (found.PMID, found.Title, found.Year, found.Journal) == (5, "A", 2001, "J")


def test_texts_stay_texts(spark):
    """Nothing is taken for a number, a date or a truth value, and no sign is lost."""
    texts = ["007", "1.50", "true", "null", "2001-01-01", "1e5", 'a"b', "\\n", "\ue000x", "\ue001\ue000", "é\U0001f600", "a &lt; b"]
    raw = record(
        citation="".join(f"<N{i} a='{t}'>{t}</N{i}>" for i, t in enumerate(texts) if '"' not in t)
        + f"<Q>{texts[6]}</Q><P>  spaced  out  </P>"
    )
    citation = json.loads(one(to_documents(records(spark, raw))).JSON)["MedlineCitation"]
    for i, text in enumerate(texts):
        text = text.replace("&lt;", "<")
        if '"' in text:
            assert citation["Q"] == text
        else:
            assert citation[f"N{i}"] == {"@a": text, "#text": text}
    assert citation["P"] == "spaced  out"


def test_empty_and_bare_records(spark):
    rows = to_documents(records(spark, "<PubmedArticle/>", "<PubmedArticle a='1'></PubmedArticle>")).collect()
    assert [(r.PMID, json.loads(r.JSON)) for r in rows] == [("", {}), ("", {"@a": "1"})]
    row = one(to_trees(records(spark, "<PubmedArticle/>")))
    assert row.pmid is None and json.loads(row.json) == {}


def test_documents_by_schema(spark):
    """With a schema, what it leaves out is left out."""
    schema = "MedlineCitation struct<PMID: struct<`#text`: string>, KeywordList: struct<Keyword: array<string>>>"
    document = json.loads(one(to_documents(records(spark, FULL), schema)).JSON)
    assert document == {"MedlineCitation": {"PMID": "12", "KeywordList": {"Keyword": ["k1", "k2"]}}}
