"""Extraction from record XML and from JSON documents made of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.operators import aggregates
from citelake.operators.extract_json import extract_json
from citelake.operators.extract_xml import accepted, extract_xml, rejected
from citelake.operators.record_json import to_documents, to_trees
from citelake.plans.build import build_from_xml, reprocess_documents, resume_from_xml
from citelake.plans.sinks import write_documents, write_rejects, write_table, write_trees
from citelake.schema import CITATION_TAG, DATA_TAG, RECORD_TAG
from citelake.sources.inputs import input_files, pending_inputs
from citelake.sources.manifest import read_manifest
from citelake.sources.tables import read_rejects, read_table, records_path
from citelake.sources.xml_files import RECORD_END, read_xml_records, split_chunks
from citelake.streaming.arrivals import follow
from workload.registry import query
from workload.shapes import (
    by_case,
    citations,
    cut_copy,
    document_records,
    element,
    escaped,
    plain_records,
    pmid_xml,
    quoted,
    record_xml,
    scratch,
    table,
    write_xml_files,
)

FIRST_LINE = "split_part(text, chr(10), 1)"
TABLE_FIELDS = (
    "PMID, Title, Abstract, DOI, Year, Authors, Journal, MeSH_Terms, Keywords, Pub_Types, "
    "Date_Created"
)
# The view without zero padding and with the padded date the XML carries.
AS_VIEW = f"SELECT {TABLE_FIELDS}, '2020-01-' || CAST(1 + PMID % 28 AS STRING) AS Date_Revised"


def xml_fields(records: DataFrame, *fields: str, doi_scope: str = "own") -> DataFrame:
    return accepted(extract_xml(records, doi_scope)).select("PMID", *fields)


# --- record XML ---------------------------------------------------------------


@query(AS_VIEW + " FROM {citations}")
def xml_all_fields(spark, sf_dir):
    rows = accepted(extract_xml(plain_records(spark, sf_dir)))
    return rows.select(*[f.strip() for f in TABLE_FIELDS.split(",")], "Date_Revised")


@query(
    f"SELECT doc_id AS PMID, CASE doc_id % 4 WHEN 1 THEN {FIRST_LINE} || ' <5 in H2O.' "
    f"WHEN 2 THEN {FIRST_LINE} || ' <b> & raw' ELSE {FIRST_LINE} END AS Title FROM documents"
)
def xml_title_mixed(spark, sf_dir):
    title = escaped("first_line")
    nested = element("sup", element("b", title, 'class="a>b"'))
    return xml_fields(
        document_records(
            spark,
            sf_dir,
            title=by_case(
                4,
                {
                    0: title,
                    1: F.concat(element("i", title), F.lit(" &lt;5 in H<sub>2</sub>O.")),
                    2: F.concat(title, F.lit(" <!-- <i> note --><![CDATA[<b> & raw]]>")),
                    3: nested,
                },
            ),
        ),
        "Title",
    )


@query(
    "SELECT conv_id * 1000 + turn AS PMID, role || ': ' || text || ' Plain. ' AS Abstract "
    "FROM conversations"
)
def xml_abstract(spark, sf_dir):
    """One record per turn: a labelled part, an unlabelled and an empty one."""
    labelled = F.concat(
        F.lit('<AbstractText Label="'), "role", F.lit('">'), escaped("text"), F.lit("</AbstractText>")
    )
    parts = F.concat(
        labelled, F.lit("<AbstractText>Pl<b>ai</b>n.</AbstractText><AbstractText/>")
    )
    other = F.lit("<OtherAbstract><AbstractText>elsewhere</AbstractText></OtherAbstract>")
    records = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("src"),
        record_xml(
            pmid=pmid_xml(F.col("conv_id") * 1000 + F.col("turn")), abstract=parts, citation=other
        ).alias("raw"),
    )
    return xml_fields(records, "Abstract")


@query(
    "SELECT doc_id AS PMID, array_to_string(list_transform(string_split(text, chr(10)), "
    "lambda line, i: CASE WHEN i % 2 = 0 THEN 'PART ' || CAST(i AS STRING) || ': ' || line "
    "ELSE line END), ' ') AS Abstract FROM documents"
)
def xml_abstract_parts(spark, sf_dir):
    """Every line of a text as one part, every other part labelled."""
    text = F.split(escaped("text"), "\n", -1)
    parts = F.transform(
        text,
        lambda line, i: F.concat(
            F.when(
                i % 2 == 1, F.concat(F.lit('<AbstractText Label="PART '), i + 1, F.lit('">'))
            ).otherwise("<AbstractText>"),
            line,
            F.lit("</AbstractText>"),
        ),
    )
    return xml_fields(
        document_records(spark, sf_dir, abstract=F.array_join(parts, "")), "Abstract"
    )


@query(
    "SELECT doc_id AS PMID, CASE doc_id % 5 WHEN 1 THEN 'Doe, ' || lang || '; Solo' "
    "WHEN 2 THEN source WHEN 3 THEN lang || ', ' || source || '; ' || source || ', ' || lang "
    "ELSE '' END AS Authors FROM documents"
)
def xml_authors(spark, sf_dir):
    def author(last: Column, fore: Column | None = None) -> Column:
        first = F.lit("") if fore is None else element("ForeName", fore)
        return element("Author", F.concat(element("LastName", last), first))

    group = F.lit("<Author><CollectiveName>Group</CollectiveName></Author>")
    lang, source = F.col("lang"), F.col("source")
    lists = {
        1: F.concat(author(F.lit("Doe"), lang), group, author(F.lit("Solo"))),
        2: author(source, F.lit("")),
        3: F.concat(author(lang, source), author(source, lang)),
        4: group,
    }
    return xml_fields(
        document_records(
            spark,
            sf_dir,
            article=by_case(5, {case: element("AuthorList", xml) for case, xml in lists.items()}),
        ),
        "Authors",
    )


@query(
    "SELECT doc_id AS PMID, CAST(CASE doc_id % 7 WHEN 0 THEN 1950 + doc_id % 76 "
    "WHEN 1 THEN 1950 + doc_id % 76 WHEN 4 THEN 1999 WHEN 5 THEN 3115 WHEN 6 THEN 1950 + "
    "doc_id % 76 END AS INT) AS Year FROM documents"
)
def xml_year_fallback(spark, sf_dir):
    year = (F.lit(1950) + F.col("doc_id") % 76).cast("string")
    dates = {
        0: element("Year", year),
        1: element("MedlineDate", F.concat(year, F.lit(" Dec-"), year, F.lit(" Jan"))),
        2: element("MedlineDate", F.concat(F.lit("Winter "), year)),
        4: "<Year>19x9</Year><MedlineDate>1999 Spring</MedlineDate>",
        5: "<Year>3115</Year><MedlineDate>1999</MedlineDate>",
        6: element("Year", F.concat(F.lit(" "), year, F.lit(" "))),
    }
    return xml_fields(document_records(spark, sf_dir, date=by_case(7, dates)), "Year")


_DOI_DATA = {
    0: "<ArticleIdList><ArticleId IdType='pii'>p</ArticleId>"
    '<ArticleId IdType="doi">10.1/(A)&lt;{0}&gt;2</ArticleId>'
    '<ArticleId IdType="doi">10.1/later</ArticleId></ArticleIdList>',
    1: '<ArticleIdList><ArticleId IdType="pii">p</ArticleId></ArticleIdList>',
    2: "",
    3: '<ArticleIdList><ArticleId IdType="doi"/></ArticleIdList>',
}
_CITED = (
    "<ReferenceList><Reference><ArticleIdList><ArticleId IdType='doi'>10.ref/&amp;{0}"
    "</ArticleId></ArticleIdList></Reference></ReferenceList>"
)


def _doi_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def numbered(template: str) -> Column:
        return F.replace(F.lit(template), F.lit("{0}"), F.col("doc_id").cast("string"))

    cases = {case: numbered(template + _CITED) for case, template in _DOI_DATA.items()}
    return document_records(spark, sf_dir, data=by_case(4, cases))


@query(
    "SELECT doc_id AS PMID, CASE WHEN doc_id % 4 = 0 "
    "THEN '10.1/(A)<' || CAST(doc_id AS STRING) || '>2' ELSE '' END AS DOI FROM documents"
)
def xml_doi_own(spark, sf_dir):
    return xml_fields(_doi_records(spark, sf_dir), "DOI")


@query(
    "SELECT doc_id AS PMID, CASE doc_id % 4 WHEN 0 "
    "THEN '10.1/(A)<' || CAST(doc_id AS STRING) || '>2' WHEN 3 THEN '' "
    "ELSE '10.ref/&' || CAST(doc_id AS STRING) END AS DOI FROM documents"
)
def xml_doi_any(spark, sf_dir):
    return xml_fields(_doi_records(spark, sf_dir), "DOI", doi_scope="any")


@query(
    "SELECT doc_id AS PMID, CASE doc_id % 4 WHEN 0 THEN '2001-02-03' WHEN 1 THEN '2001-01-3' "
    "WHEN 3 THEN '2001-01-01' ELSE '' END AS Date_Created, CASE doc_id % 3 WHEN 0 THEN "
    "'2020-' || CAST(1 + doc_id % 12 AS STRING) || '-01' ELSE '' END AS Date_Revised "
    "FROM documents"
)
def xml_dates(spark, sf_dir):
    created = by_case(
        4,
        {
            0: "<DateCreated><Year>2001</Year><Month>02</Month><Day>03</Day></DateCreated>",
            1: "<DateCreated><Year>2001</Year><Day>3</Day></DateCreated>",
            2: "<DateCreated><Month>02</Month><Day>03</Day></DateCreated>",
            3: "<DateCreated><Year>2001</Year><Month/><Day></Day></DateCreated>",
        },
    )
    month = (F.lit(1) + F.col("doc_id") % 12).cast("string")
    revised = by_case(
        3,
        {
            0: element(
                "DateRevised", F.concat(F.lit("<Year>2020</Year>"), element("Month", month))
            ),
            1: element("DateRevised", F.concat(F.lit("<Year/>"), element("Month", month))),
        },
    )
    return xml_fields(
        document_records(spark, sf_dir, citation=F.concat(created, revised)),
        "Date_Created",
        "Date_Revised",
    )


@query(
    "SELECT doc_id AS PMID, CASE doc_id % 4 WHEN 0 THEN source || '; ' || lang "
    "WHEN 1 THEN 'a; k2' WHEN 2 THEN '' ELSE lang END AS Keywords, "
    "CASE doc_id % 3 WHEN 0 THEN source || '; A & B' WHEN 1 THEN lang ELSE '' END AS MeSH_Terms, "
    "CASE doc_id % 2 WHEN 0 THEN 'Review; ' || lang ELSE '' END AS Pub_Types FROM documents"
)
def xml_terms(spark, sf_dir):
    source, lang = element("Keyword", F.col("source")), element("Keyword", F.col("lang"))
    mixed = "<Keyword MajorTopicYN='N'>a<i>b</i>c</Keyword><Keyword><i>z</i>q</Keyword>"
    keywords = by_case(
        4,
        {
            0: F.concat(
                element("KeywordList", F.concat(source, F.lit("<Keyword/>"))),
                element("KeywordList", lang),
            ),
            1: f"<KeywordList>{mixed}</KeywordList><KeywordList><Keyword>k2</Keyword></KeywordList>",
            2: "<KeywordList/><KeywordList></KeywordList>",
            3: F.concat(F.lit("<KeywordList/>"), element("KeywordList", lang, 'Owner="N"')),
        },
    )
    heading = element("DescriptorName", F.col("source"), 'UI="D1"')
    qualifier = F.lit("<QualifierName>ignored</QualifierName>")
    subjects = by_case(
        3,
        {
            0: element(
                "MeshHeadingList",
                F.concat(
                    element("MeshHeading", F.concat(heading, qualifier)),
                    F.lit("<MeshHeading><DescriptorName>A &amp; B</DescriptorName></MeshHeading>"),
                ),
            ),
            1: element(
                "MeshHeadingList",
                F.concat(
                    F.lit("<MeshHeading><DescriptorName/></MeshHeading>"),
                    element("MeshHeading", element("DescriptorName", F.col("lang"))),
                ),
            ),
        },
    )
    kinds = by_case(
        2,
        {
            0: element(
                "PublicationTypeList",
                F.concat(
                    F.lit("<PublicationType UI='D2'>Review</PublicationType><PublicationType/>"),
                    element("PublicationType", F.col("lang")),
                ),
            )
        },
    )
    return xml_fields(
        document_records(
            spark, sf_dir, citation=F.concat(subjects, keywords), article=kinds
        ),
        "Keywords",
        "MeSH_Terms",
        "Pub_Types",
    )


@query(
    "SELECT CASE WHEN doc_id % 4 < 2 THEN 0 ELSE doc_id END AS PMID, source || ' & co' AS Journal, "
    f"{FIRST_LINE} AS Title FROM documents"
)
def xml_identifiers(spark, sf_dir):
    spaced = pmid_xml(F.concat(F.lit(" "), "doc_id", F.lit("\n")))
    return xml_fields(
        document_records(
            spark,
            sf_dir,
            pmid=by_case(4, {1: "<PMID/>", 2: spaced, 3: pmid_xml(F.col("doc_id"))}),
            journal=F.concat(F.col("source"), F.lit(" &amp; co")),
            title=escaped("first_line"),
        ),
        "Journal",
        "Title",
    )


@query(
    "SELECT doc_id AS PMID, doc_id AS json_pmid, "
    f"{FIRST_LINE} AS json_title, CAST(CASE WHEN doc_id % 97 = 0 THEN NULL "
    "ELSE 1950 + doc_id % 76 END AS INT) AS json_year, source AS json_journal, "
    "true AS year_kept, 10 AS keys FROM documents"
)
def json_summary(spark, sf_dir):
    """The summary document, read back field by field."""
    fields = F.from_json("JSON", "PMID bigint, Title string, Year int, Journal string")
    return xml_fields(plain_records(spark, sf_dir), "JSON").select(
        "PMID",
        fields["PMID"].alias("json_pmid"),
        fields["Title"].alias("json_title"),
        fields["Year"].alias("json_year"),
        fields["Journal"].alias("json_journal"),
        F.array_contains(F.json_object_keys("JSON"), "Year").alias("year_kept"),
        F.size(F.json_object_keys("JSON")).alias("keys"),
    )


# --- broken records -----------------------------------------------------------

_BROKEN = (
    "CASE doc_id % 7 WHEN 0 THEN 'malformed XML' WHEN 1 THEN 'no MedlineCitation' "
    "WHEN 2 THEN 'identifier is not a number' WHEN 3 THEN 'malformed XML' "
    "WHEN 4 THEN 'record not closed' END"
)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of files as the reader sees them: text up to and including one closing tag.

    In case 4 the piece starts with a record that was never closed.
    """
    good = record_xml(pmid=pmid_xml(F.col("doc_id")), title=escaped("text"))
    open_record = F.lit(f"<{RECORD_TAG}><{CITATION_TAG}><PMID>5</PMID>")
    chosen = F.coalesce(
        F.when(F.col("doc_id") % 7 == 0, record_xml(title=F.lit("a <i>b</b> c")))
        .when(F.col("doc_id") % 7 == 1, record_xml(body=F.lit(f"<{DATA_TAG}/>")))
        .when(F.col("doc_id") % 7 == 2, record_xml(pmid=F.lit("<PMID>12a</PMID>")))
        .when(F.col("doc_id") % 7 == 3, record_xml(title=F.lit("fish &chips;")))
        .when(F.col("doc_id") % 7 == 4, F.concat(open_record, good))
        .when(F.col("doc_id") % 7 == 5, F.concat(F.lit(f"<?xml?><{RECORD_TAG}Set>\n"), good)),
        good,
    )
    return table(spark, sf_dir, "documents").select(
        F.regexp_replace(chosen, f"{RECORD_END}$", "").alias("value"),
        F.col("source").alias("src"),
    )


@query(
    "SELECT doc_id AS PMID, text AS Title FROM documents WHERE doc_id % 7 >= 4"
)
def xml_split_records(spark, sf_dir):
    return xml_fields(split_chunks(_chunks(spark, sf_dir)), "Title")


@query(
    f"SELECT reason, count(*) AS records FROM (SELECT {_BROKEN} AS reason FROM documents) "
    "WHERE reason IS NOT NULL GROUP BY reason"
)
def xml_rejects(spark, sf_dir):
    path = scratch(spark, "rejects")
    write_rejects(rejected(extract_xml(split_chunks(_chunks(spark, sf_dir)))), path)
    return spark.read.parquet(path).groupBy("reason").agg(F.count("*").alias("records"))


@query(
    f"SELECT source AS src, {_BROKEN} AS reason, count(*) AS records FROM documents "
    f"WHERE {_BROKEN} IS NOT NULL GROUP BY ALL"
)
def reject_tally(spark, sf_dir):
    """Tallied from the written table, where rejects lie beside the accepted rows."""
    root = scratch(spark, "table")
    write_table(extract_xml(split_chunks(_chunks(spark, sf_dir))), root)
    return aggregates.reject_tally(read_rejects(spark, root))


# --- whole builds -------------------------------------------------------------


@query(AS_VIEW + " FROM {citations}")
def xml_file_build(spark, sf_dir):
    """Gzipped files in, table out, read back."""
    files = scratch(spark, "files")
    write_xml_files(plain_records(spark, sf_dir), files)
    built = build_from_xml(spark, files, scratch(spark, "table"), glob="*.gz")
    return built.select(*[f.strip() for f in TABLE_FIELDS.split(",")], "Date_Revised")


@query("SELECT PMID, Title, DOI, Year FROM {citations}")
def streamed_build(spark, sf_dir):
    """The same files picked up by the standing build."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    follow(spark, files, root, scratch(spark, "seen"), glob="*.gz").awaitTermination()
    return read_table(spark, root).select("PMID", "Title", "DOI", "Year")


@query("SELECT PMID, Title, DOI, Year FROM {citations}")
def resumed_build(spark, sf_dir):
    """One file first, then the whole folder: what is there already is not added again."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    resume_from_xml(spark, files, root, glob="part-00000*.gz")
    resume_from_xml(spark, files, root, glob="*.gz")
    built = resume_from_xml(spark, files, root, glob="*.gz")
    return built.select("PMID", "Title", "DOI", "Year")


@query("SELECT PMID, Title, DOI, Year FROM {citations}")
def resumed_after_partial_commit(spark, sf_dir):
    """The table holds half of each file's records and no manifest; resuming replaces them."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    half = extract_xml(read_xml_records(spark, files, "*.gz")).filter("PMID % 2 = 0")
    write_table(half, root)
    built = resume_from_xml(spark, files, root, glob="*.gz")
    return built.select("PMID", "Title", "DOI", "Year")


@query("SELECT PMID, Title, DOI, Year FROM {citations}")
def followed_after_partial_commit(spark, sf_dir):
    """As above, for the standing build."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    write_table(extract_xml(read_xml_records(spark, files, "*.gz")).filter("PMID % 2 = 0"), root)
    follow(spark, files, root, scratch(spark, "seen"), glob="*.gz").awaitTermination()
    return read_table(spark, root).select("PMID", "Title", "DOI", "Year")


@query("SELECT count(*) AS records, CAST(0 AS BIGINT) AS pending FROM {citations}")
def resumed_with_empty_file(spark, sf_dir):
    """A file without records counts as finished."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    spark.createDataFrame([("<empty/>",)], "value string").coalesce(1).write.mode("append").option(
        "compression", "gzip"
    ).text(files)
    resume_from_xml(spark, files, root, glob="*.gz")
    pending = pending_inputs(input_files(spark, files, "*.gz"), read_manifest(spark, root))
    counted = read_table(spark, root).agg(F.count("*").alias("records"))
    return counted.withColumn("pending", F.lit(pending.count()).cast("bigint"))


@query("SELECT PMID, Title, DOI, Year, CAST(1 AS BIGINT) AS damaged FROM {citations}")
def damaged_build(spark, sf_dir):
    """One file that ends too early costs no other file, and the manifest says so."""
    files, root = scratch(spark, "files"), scratch(spark, "table")
    write_xml_files(plain_records(spark, sf_dir), files)
    whole = input_files(spark, files, "*.gz").orderBy("path").first()
    cut_copy(spark, whole.path, f"{files}/cut.gz", whole.bytes // 2)
    build_from_xml(spark, files, root, glob="*.gz")
    built = resume_from_xml(spark, files, root, glob="*.gz")
    damaged = read_manifest(spark, root).filter("error IS NOT NULL AND name = 'cut.gz'").count()
    return built.select("PMID", "Title", "DOI", "Year", F.lit(damaged).cast("bigint").alias("damaged"))


@query("SELECT count(*) AS records FROM documents WHERE doc_id % 7 >= 4")
def foreign_scan(spark, sf_dir):
    """A recursive scan of the documented folder, as another engine does it, meets records only."""
    root = scratch(spark, "table")
    write_table(extract_xml(split_chunks(_chunks(spark, sf_dir))), root)
    scan = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return scan.parquet(records_path(root)).agg(F.count("*").alias("records"))


@query(
    f"SELECT source AS src, {_BROKEN} AS reason, count(*) AS records FROM documents "
    f"WHERE {_BROKEN} IS NOT NULL GROUP BY ALL"
)
def rejects_of_two_writes(spark, sf_dir):
    """Replacing years with the records of some files leaves the rejects of the others."""
    rows, root = extract_xml(split_chunks(_chunks(spark, sf_dir))), scratch(spark, "table")
    write_table(rows, root)
    write_table(rows.filter("src IN ('src1', 'src2', 'src3')"), root, mode="years")
    return aggregates.reject_tally(read_rejects(spark, root))


@query(AS_VIEW + " FROM {citations}")
def documents_round_trip(spark, sf_dir):
    """Record XML to the older JSON documents, and those to the table."""
    path, root = scratch(spark, "documents"), scratch(spark, "table")
    write_documents(to_documents(plain_records(spark, sf_dir)), path)
    built = reprocess_documents(spark, path, root)
    return built.select(*[f.strip() for f in TABLE_FIELDS.split(",")], "Date_Revised")


@query(
    "SELECT CAST(doc_id AS INT) AS pmid, source AS src, text AS abstract, "
    "'Doe' AS last_name, source || '; ' || lang AS subjects FROM documents"
)
def trees_round_trip(spark, sf_dir):
    """The oldest form: lists as arrays, no attributes."""
    path = scratch(spark, "trees")
    write_trees(to_trees(plain_records(spark, sf_dir)), path)
    tree = F.from_json(
        "json",
        f"{CITATION_TAG} struct<Article: struct<Abstract: struct<AbstractText: array<string>>, "
        "AuthorList: array<struct<LastName: string>>>, "
        "MeshHeadingList: array<struct<DescriptorName: string>>>",
    )[CITATION_TAG]
    return spark.read.parquet(path).select(
        "pmid",
        "src",
        tree["Article"]["Abstract"]["AbstractText"][0].alias("abstract"),
        tree["Article"]["AuthorList"][0]["LastName"].alias("last_name"),
        F.array_join(tree["MeshHeadingList"]["DescriptorName"], "; ").alias("subjects"),
    )


_TWICE = (
    "SELECT doc_id, source, lang, CAST(1950 + doc_id % 76 AS INT) AS Year, 'first ' || source AS Title, "
    "'J ' || lang AS Journal FROM documents"
)


def _repeated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in which elements that the format has once occur twice."""
    year = (F.lit(1950) + F.col("doc_id") % 76).cast("string")
    return document_records(
        spark,
        sf_dir,
        pmid=F.concat(pmid_xml(F.col("doc_id")), F.lit("<PMID>7</PMID>")),
        date=F.concat(element("Year", year), F.lit("<Year>1900</Year>")),
        title=F.concat(
            F.lit("first "), F.col("source"), F.lit("</ArticleTitle><ArticleTitle>second <i>one</i>")
        ),
        journal=F.concat(F.lit("J "), F.col("lang"), F.lit("</Title><Title>K")),
    )


@query(f"SELECT doc_id AS PMID, Title, Year, Journal FROM ({_TWICE})")
def first_of_repeated(spark, sf_dir):
    """The first id, title, year and journal count."""
    return xml_fields(_repeated_records(spark, sf_dir), "Title", "Year", "Journal")


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS PMID, Title, 'second one' AS second_title, "
    f"CAST(Year AS VARCHAR) AS first_year, '1900' AS second_year FROM ({_TWICE})"
)
def kept_repeated_elements(spark, sf_dir):
    """In the document form both of an element that occurs twice are listed."""
    documents = to_documents(_repeated_records(spark, sf_dir))

    def at(path: str) -> Column:
        return F.get_json_object("JSON", f"$.{CITATION_TAG}.Article.{path}")

    year = "Journal.JournalIssue.PubDate.Year"
    return documents.select(
        "PMID",
        at("ArticleTitle[0]").alias("Title"),
        at("ArticleTitle[1]").alias("second_title"),
        at(f"{year}[0]").alias("first_year"),
        at(f"{year}[1]").alias("second_year"),
    )


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS PMID, source AS suffix, '00' || doc_id AS code, lang AS title_ui, "
    "source AS novel FROM documents"
)
def kept_paths(spark, sf_dir):
    """Known names at places of their own, an unknown attribute and an unknown element are all kept."""
    strange = document_records(
        spark,
        sf_dir,
        title=F.lit("t"),
        article=F.concat(
            element("Suffix", F.col("source")),
            F.lit("<ELocationID Novel='00"),
            F.col("doc_id").cast("string"),
            F.lit("'>x</ELocationID>"),
            F.lit("<VernacularTitle UI='"),
            F.col("lang"),
            F.lit("'>v</VernacularTitle>"),
        ),
        citation=element("Novel", element("Deep", F.col("source"))),
    )
    return to_documents(strange).select(
        "PMID",
        F.get_json_object("JSON", f"$.{CITATION_TAG}.Article.Suffix").alias("suffix"),
        F.get_json_object("JSON", f"$.{CITATION_TAG}.Article.ELocationID['@Novel']").alias("code"),
        F.get_json_object("JSON", f"$.{CITATION_TAG}.Article.VernacularTitle['@UI']").alias("title_ui"),
        F.get_json_object("JSON", f"$.{CITATION_TAG}.Novel.Deep").alias("novel"),
    )


# --- JSON documents -----------------------------------------------------------


def _json(**entries: Column | str) -> Column:
    """A JSON object; the values are JSON."""
    parts = [
        F.concat(F.lit(f'"{name.replace("at_", "@").replace("text_", "#text")}":'), value)
        for name, value in (
            (n, F.lit(v) if isinstance(v, str) else v) for n, v in entries.items()
        )
    ]
    return F.concat(F.lit("{"), F.array_join(F.array(*parts), ","), F.lit("}"))


def _list(*items: Column | str) -> Column:
    values = [F.lit(i) if isinstance(i, str) else i for i in items]
    return F.concat(F.lit("["), F.array_join(F.array(*values), ","), F.lit("]"))


def _documents(spark: SparkSession, sf_dir: str, json: Column) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn(
        "first_line", F.split_part("text", F.lit("\n"), F.lit(1))
    )
    return documents.select(
        F.col("doc_id").cast("string").alias("PMID"), json.alias("JSON"), F.col("source").alias("src")
    )


@query(AS_VIEW.replace("Date_Created", "'2001-02-01' AS Date_Created") + " FROM {citations}")
def json_fields(spark, sf_dir):
    year = F.when(F.col("doc_id") % 97 == 0, "{}").otherwise(
        _json(Year=F.concat(F.lit('"'), F.lit(1950) + F.col("doc_id") % 76, F.lit('"')))
    )
    source, lang = quoted(F.col("source")), quoted(F.col("lang"))
    identifiers = F.when(
        F.col("doc_id") % 5 == 0, _json(at_IdType='"pii"', text_='"x"')
    ).otherwise(
        _list(
            _json(at_IdType='"pii"', text_='"x"'),
            _json(
                at_IdType='"doi"', text_=F.concat(F.lit('"10.1/'), F.col("doc_id"), F.lit('"'))
            ),
        )
    )
    revised = F.concat(F.lit('"'), F.lit(1) + F.col("doc_id") % 28, F.lit('"'))
    article = _json(
        ArticleTitle=quoted(F.col("first_line")),
        Abstract=_json(AbstractText=quoted(F.col("text"))),
        Journal=_json(Title=source, JournalIssue=_json(PubDate=year)),
        AuthorList=_json(Author=_json(LastName='"Doe"', ForeName=lang)),
        PublicationTypeList=_json(PublicationType=_json(at_UI='"D1"', text_=lang)),
    )
    citation = _json(
        PMID=_json(at_Version='"1"', text_=F.concat(F.lit('"'), F.col("doc_id"), F.lit('"'))),
        DateCreated=_json(Year='"2001"', Month='"02"'),
        DateRevised=_json(Year='"2020"', Day=revised),
        Article=article,
        MeshHeadingList=_json(
            MeshHeading=_list(
                _json(DescriptorName=_json(text_=source)), _json(DescriptorName=lang)
            )
        ),
    )
    document = _json(**{CITATION_TAG: citation, DATA_TAG: _json(ArticleIdList=_json(ArticleId=identifiers))})
    rows = extract_json(_documents(spark, sf_dir, document))
    return rows.select(*[f.strip() for f in TABLE_FIELDS.split(",")], "Date_Revised")


@query(
    "SELECT doc_id AS PMID, CASE doc_id % 4 WHEN 0 THEN 'AIMS: ' || text || ' Plain.' "
    "WHEN 1 THEN text WHEN 2 THEN text ELSE '' END AS Abstract, "
    "CASE doc_id % 4 WHEN 0 THEN lang || '; ; ' || source WHEN 1 THEN lang WHEN 2 THEN lang "
    "ELSE '' END AS Keywords, "
    "CASE doc_id % 4 WHEN 0 THEN lang || '; ; ; ' || source WHEN 1 THEN lang ELSE '' END "
    "AS MeSH_Terms, "
    "CASE doc_id % 4 WHEN 0 THEN lang || '; ' || source WHEN 1 THEN lang ELSE '' END AS Pub_Types, "
    "CASE doc_id % 4 WHEN 0 THEN 'Doe, ' || lang || '; Solo; Poe' WHEN 1 THEN 'Doe, ' || lang "
    "ELSE '' END AS Authors, "
    "CASE doc_id % 4 WHEN 0 THEN lang || ' ' || source WHEN 1 THEN lang WHEN 2 THEN lang ELSE '' "
    "END AS Title, CASE doc_id % 4 WHEN 0 THEN '10.1/a' WHEN 1 THEN '10.1/b' ELSE '' END AS DOI "
    "FROM documents"
)
def json_one_or_many(spark, sf_dir):
    """Lists with gaps (case 0), an object (1), a plain text (2) and lists of lists or nulls (3)."""
    text, lang, source = (quoted(F.col(c)) for c in ("text", "lang", "source"))
    tagged = _json(at_UI='"u"', text_=lang)

    def case(many, one, plain, odd="null") -> Column:
        return by_case(4, {0: many, 1: one, 2: plain, 3: odd})

    doe = _json(LastName='"Doe"', ForeName=lang)
    article = _json(
        ArticleTitle=case(_list(tagged, source), tagged, lang),
        Abstract=case(
            _json(
                AbstractText=_list(
                    _json(at_Label='"AIMS"', text_=text), '"Plain."'
                )
            ),
            _json(AbstractText=_json(at_Label='"AIMS"', text_=text)),
            _json(AbstractText=text),
        ),
        AuthorList=case(
            _json(
                Author=_list(
                    doe,
                    '{"CollectiveName":"C"}',
                    '{"LastName":"Solo"}',
                    '{"LastName":"Poe","ForeName":null}',
                )
            ),
            _json(Author=doe),
            _json(Author=lang),
        ),
        PublicationTypeList=case(
            _json(PublicationType=_list(tagged, source)),
            _json(PublicationType=tagged),
            _json(PublicationType=lang),
        ),
    )
    citation = _json(
        Article=article,
        KeywordList=case(
            _json(Keyword=_list(tagged, '{"@x":"1"}', "null", source)),
            _json(Keyword=tagged),
            _json(Keyword=lang),
            _list(_json(Keyword=lang), _json(Keyword=source)),
        ),
        MeshHeadingList=case(
            _json(
                MeshHeading=_list(
                    _json(DescriptorName=tagged),
                    '{"DescriptorName":{"@UI":"D"}}',
                    '{"QualifierName":"q"}',
                    '"loose"',
                    '{"DescriptorName":null}',
                    _json(DescriptorName=source),
                )
            ),
            _json(MeshHeading=_json(DescriptorName=tagged)),
            _json(MeshHeading=_json(DescriptorName=lang)),
        ),
    )
    identifiers = case(
        _list('{"@IdType":"pii","#text":"p"}', '{"@IdType":"doi","#text":"10.1/a"}'),
        '{"@IdType":"doi","#text":"10.1/b"}',
        '{"@IdType":"pii","#text":"10.1/c"}',
    )
    document = _json(
        **{CITATION_TAG: citation, DATA_TAG: _json(ArticleIdList=_json(ArticleId=identifiers))}
    )
    return extract_json(_documents(spark, sf_dir, document)).select(
        "PMID", "Abstract", "Keywords", "MeSH_Terms", "Pub_Types", "Authors", "Title", "DOI"
    )


@query(
    "SELECT CASE doc_id % 8 WHEN 4 THEN 0 WHEN 5 THEN 77 ELSE doc_id END AS PMID, "
    "CAST(CASE doc_id % 8 WHEN 3 THEN 1998 WHEN 6 THEN 0 WHEN 7 THEN 1987 END AS INT) AS Year, "
    "'' AS Title, CASE doc_id % 8 WHEN 7 THEN '2003--01' ELSE '' END AS Date_Revised, src, "
    "CASE doc_id % 8 WHEN 0 THEN '{bad' WHEN 1 THEN '[]' ELSE 'kept' END AS JSON "
    "FROM (SELECT *, source AS src FROM documents)"
)
def json_bad(spark, sf_dir):
    """Documents that are no JSON or lack parts keep their row, their text and their id."""
    def with_date(date: str, revised: str = "null") -> str:
        return (
            f'{{"{CITATION_TAG}":{{"DateRevised":{revised},"Article":{{"Journal":'
            f'{{"JournalIssue":{{"PubDate":{date}}}}}}}}}}}'
        )

    document = by_case(
        8,
        {
            0: "{bad",
            1: "[]",
            2: f'{{"{CITATION_TAG}":{{"Article":null}}}}',
            3: with_date('{"Year":"0","MedlineDate":"1998 Dec-1999 Jan"}'),
            4: f'{{"{CITATION_TAG}":{{"PMID":{{"#text":"12a"}}}}}}',
            5: f'{{"{CITATION_TAG}":{{"PMID":{{"#text":"76"}},"PMID":{{"#text":"77"}}}}}}',
            6: with_date('{"Year":"0","MedlineDate":"Winter"}'),
            7: with_date('{"Year":"19x7","MedlineDate":"1987"}', '{"Year":"2003","Month":""}'),
        },
    )
    rows = extract_json(_documents(spark, sf_dir, document))
    return rows.select(
        "PMID",
        "Year",
        "Title",
        "Date_Revised",
        "src",
        F.when(F.col("JSON").startswith(f'{{"{CITATION_TAG}"'), "kept")
        .otherwise(F.col("JSON"))
        .alias("JSON"),
    )
