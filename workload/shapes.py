"""Citation data in the shape of the given tables: a view, record XML and JSON documents.

``doc_id`` decides which edge case a record shows, so the expected value is a plain CASE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.functions.markup import escape_xml
from citelake.schema import CITATION_TAG, DATA_TAG, RECORD_TAG
from citelake.session import scratch_dir

# The same text runs on both engines.
CITATIONS = """
SELECT doc_id AS PMID,
       split_part(text, chr(10), 1) AS Title,
       text AS Abstract,
       CASE WHEN doc_id % 5 = 0 THEN '' ELSE '10.1/' || CAST(doc_id AS STRING) END AS DOI,
       CAST(CASE WHEN doc_id % 97 = 0 THEN NULL ELSE 1950 + doc_id % 76 END AS INT) AS Year,
       'Doe, ' || lang AS Authors,
       source AS Journal,
       source || '; ' || lang AS MeSH_Terms,
       '' AS Keywords,
       lang AS Pub_Types,
       '' AS Date_Created,
       '2020-01-' || CAST(1 + doc_id % 28 AS STRING) AS Date_Revised,
       '' AS JSON,
       source AS src
FROM documents
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        CITATIONS.replace("FROM documents", "FROM {documents}"),
        documents=table(spark, sf_dir, "documents"),
    )


def scratch(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, label)


def element(name: str, content: Column, attributes: str = "") -> Column:
    opening = f"<{name}{' ' + attributes if attributes else ''}>"
    return F.concat(F.lit(opening), content, F.lit(f"</{name}>"))


def record_xml(
    *,
    pmid: Column | None = None,
    title: Column | None = None,
    abstract: Column | None = None,
    date: Column | None = None,
    journal: Column | None = None,
    article: Column | None = None,
    citation: Column | None = None,
    data: Column | None = None,
    body: Column | None = None,
) -> Column:
    """One record; the arguments are XML, and an argument left out leaves its element out."""
    nothing = F.lit("")
    published = element("JournalIssue", element("PubDate", nothing if date is None else date))
    article_xml = F.concat(
        element(
            "Journal",
            F.concat(published, nothing if journal is None else element("Title", journal)),
        ),
        nothing if title is None else element("ArticleTitle", title),
        nothing if abstract is None else element("Abstract", abstract),
        nothing if article is None else article,
    )
    citation_xml = F.concat(
        nothing if pmid is None else pmid,
        element("Article", article_xml),
        nothing if citation is None else citation,
    )
    if body is None:
        body = F.concat(
            element(CITATION_TAG, citation_xml), element(DATA_TAG, nothing if data is None else data)
        )
    return element(RECORD_TAG, body)


def pmid_xml(value: Column) -> Column:
    return element("PMID", value.cast("string"), 'Version="1"')


def by_case(modulus: int, cases: dict[int, Column | str], key: str = "doc_id") -> Column:
    """The XML of a record's case; cases not listed get nothing."""
    chosen = F.lit("")
    for case, value in cases.items():
        value = F.lit(value) if isinstance(value, str) else value
        chosen = F.when(F.col(key) % modulus == case, value).otherwise(chosen)
    return chosen


def escaped(name: str) -> Column:
    return escape_xml(F.col(name))


def document_records(spark: SparkSession, sf_dir: str, **parts: Column) -> DataFrame:
    """``(src, raw)`` of the documents, each a record with the given parts."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "first_line", F.split_part("text", F.lit("\n"), F.lit(1))
    )
    parts.setdefault("pmid", pmid_xml(F.col("doc_id")))
    return documents.select(F.col("source").alias("src"), record_xml(**parts).alias("raw"))


def plain_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that carry the citation view's values."""
    return document_records(
        spark,
        sf_dir,
        title=escaped("first_line"),
        abstract=element("AbstractText", escaped("text")),
        date=F.expr(
            "CASE WHEN doc_id % 97 = 0 THEN '' "
            "ELSE concat('<Year>', 1950 + doc_id % 76, '</Year>') END"
        ),
        journal=escaped("source"),
        article=F.concat(
            element(
                "AuthorList",
                element(
                    "Author",
                    F.concat(F.lit("<LastName>Doe</LastName>"), element("ForeName", F.col("lang"))),
                ),
            ),
            element("PublicationTypeList", element("PublicationType", F.col("lang"), 'UI="D1"')),
        ),
        citation=F.concat(
            F.expr(
                "concat('<DateRevised><Year>2020</Year><Month>01</Month><Day>', "
                "1 + doc_id % 28, '</Day></DateRevised>')"
            ),
            element(
                "MeshHeadingList",
                F.concat(
                    *[
                        element("MeshHeading", element("DescriptorName", F.col(c), 'UI="D2"'))
                        for c in ("source", "lang")
                    ]
                ),
            ),
        ),
        data=element(
            "ArticleIdList",
            F.expr(
                "CASE WHEN doc_id % 5 = 0 THEN '<ArticleId IdType=\"pii\">x</ArticleId>' "
                "ELSE concat('<ArticleId IdType=\"doi\">10.1/', doc_id, '</ArticleId>') END"
            ),
        ),
    )


def write_xml_files(records: DataFrame, path: str, per_file: int = 30_000) -> None:
    """Gzipped XML files of about ``per_file`` records, with header and trailer."""
    count = records.count()
    files = max(4, -(-count // per_file))
    numbered = records.select(F.pmod(F.xxhash64("raw"), F.lit(files)).alias("part"), "raw")
    edges = records.sparkSession.range(files).select(F.col("id").alias("part"))
    head = f'<?xml version="1.0" encoding="utf-8"?>\n<{RECORD_TAG}Set>'
    tail = f"<DeleteCitation><PMID>1</PMID></DeleteCitation></{RECORD_TAG}Set>"
    lines = (
        edges.select("part", F.lit(0).alias("place"), F.lit(head).alias("value"))
        .unionByName(numbered.select("part", F.lit(1).alias("place"), F.col("raw").alias("value")))
        .unionByName(edges.select("part", F.lit(2).alias("place"), F.lit(tail).alias("value")))
    )
    (
        lines.repartitionById(files, F.col("part").cast("int"))
        .sortWithinPartitions("place")
        .select("value")
        .write.option("compression", "gzip")
        .text(path)
    )


def cut_copy(spark: SparkSession, source: str, target: str, size: int) -> None:
    """The first ``size`` bytes of a file as another; they stream through a small buffer."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    source, target = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    whole = source.getFileSystem(conf).open(source)
    out = target.getFileSystem(conf).create(target)
    jvm.org.apache.commons.io.IOUtils.copyLarge(whole, out, 0, size)
    out.close()
    whole.close()


def quoted(text: Column) -> Column:
    """A JSON string literal."""
    as_array = F.to_json(F.array(text))
    return F.substr(as_array, F.lit(2), F.length(as_array) - 2)

