"""Random records whose fields are known from how they were made."""

from __future__ import annotations

import json
import random

import pytest

from citelake.operators.extract_xml import extract_xml
from citelake.operators.record_json import to_documents, to_trees
from tests.records import record

WORDS = ["alpha", "β-γ", "É. coli", "x < y", "A & B", '"q"', "p > 1", "line\nbreak", "ü", "]]", "-"]
INLINE = ["i", "b", "sup", "sub", "DispFormula"]


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def mixed(rng: random.Random, depth: int = 0) -> tuple[str, str, str]:
    """Markup, all its text, and its text before the first child."""
    markup, text, leading, child_seen = "", "", "", False
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.25 and depth < 2:
            name = rng.choice(INLINE)
            inner, inner_text, _ = mixed(rng, depth + 1)
            attribute = rng.choice(["", ' a="1>0"', " a='\"'"])
            markup += f"<{name}{attribute}>{inner}</{name}>"
            text += inner_text
            child_seen = True
            continue
        if kind < 0.32:
            markup += "<br/>"
            child_seen = True
            continue
        word = rng.choice(WORDS)
        if kind < 0.38:
            markup += "<!-- <i>none</i> & -->"
            continue
        markup += f"<![CDATA[{word}]]>" if kind < 0.45 and "]]" not in word else escape(word)
        text += word
        leading += "" if child_seen else word
    return markup, text, leading


def make(rng: random.Random, number: int) -> tuple[str, dict]:
    title, title_text, _ = mixed(rng)
    parts, part_texts = "", []
    for _ in range(rng.randint(0, 3)):
        label = rng.choice(["", "AIMS", "A & B"])
        part, part_text, _ = mixed(rng)
        attributes = f' Label="{escape(label)}"' if label or rng.random() < 0.2 else ""
        parts += f"<AbstractText{attributes}>{part}</AbstractText>"
        part_texts.append(f"{label}: {part_text}" if label else part_text)
    expected = {"PMID": number, "Title": title_text, "Abstract": " ".join(part_texts)}

    def terms(name: str) -> tuple[str, list[str]]:
        made = [mixed(rng) for _ in range(rng.randint(0, 3))]
        markup = "".join(f"<{name} UI='u'>{m}</{name}>" for m, _, _ in made)
        return markup, [leading for _, _, leading in made if leading]

    keywords, keyword_texts = terms("Keyword")
    more_keywords, more_texts = terms("Keyword")
    types, type_texts = terms("PublicationType")
    subjects, subject_texts = terms("DescriptorName")
    expected["Keywords"] = "; ".join(keyword_texts + more_texts)
    expected["Pub_Types"] = "; ".join(type_texts)
    expected["MeSH_Terms"] = "; ".join(subject_texts)

    names, authors = "", []
    for _ in range(rng.randint(0, 3)):
        last, _, last_text = mixed(rng)
        names += f"<Author><LastName>{last}</LastName><ForeName>F.</ForeName></Author>"
        if last_text:
            authors.append(f"{last_text}, F.".strip(", "))
    expected["Authors"] = "; ".join(authors)
    text = record(
        pmid=f"<PMID>{number}</PMID>",
        title=f"<ArticleTitle>{title}</ArticleTitle>",
        abstract=f"<Abstract>{parts}</Abstract>",
        article=f"<AuthorList>{names}</AuthorList>"
        f"<PublicationTypeList>{types}</PublicationTypeList>",
        citation="<MeshHeadingList>"
        + subjects.replace("<DescriptorName", "<MeshHeading><DescriptorName").replace(
            "</DescriptorName>", "</DescriptorName></MeshHeading>"
        )
        + f"</MeshHeadingList><KeywordList>{keywords}</KeywordList>"
        f"<KeywordList>{more_keywords}</KeywordList>",
    )
    return text, expected


@pytest.fixture(scope="module")
def made():
    rng = random.Random(20)
    return [make(rng, number) for number in range(1, 1501)]


@pytest.fixture(scope="module")
def frame(spark, made):
    return spark.createDataFrame([("f", text) for text, _ in made], "src string, raw string")


def test_fields(frame, made):
    rows = {row.PMID: row for row in extract_xml(frame).collect()}
    for text, expected in made:
        row = rows[expected["PMID"]]
        assert row.reason is None, text
        assert {name: row[name] for name in expected} == expected, text


def test_one_broken_tag_is_noticed(spark, made):
    rng = random.Random(3)
    broken = []
    for text, _ in made[:300]:
        closing = [i for i in range(len(text) - 20) if text.startswith("</", i)]
        at = rng.choice(closing)
        broken.append(("f", text[: at + 2] + "x" + text[at + 2 :]))
    frame = spark.createDataFrame(broken, "src string, raw string")
    for row in extract_xml(frame).collect():
        comment = row.raw is None or "</x" not in row.raw
        assert row.reason is not None or comment


def test_documents_are_json(frame, made):
    documents = {int(row.PMID): json.loads(row.JSON) for row in to_documents(frame).collect()}
    trees = {row.pmid: json.loads(row.json) for row in to_trees(frame).collect()}
    for _, expected in made:
        number = expected["PMID"]
        title = trees[number]["MedlineCitation"]["Article"].get("ArticleTitle", "")
        assert title == expected["Title"].strip()
        value = documents[number]["MedlineCitation"]["Article"].get("ArticleTitle")
        assert (value or "") == expected["Title"].strip()
