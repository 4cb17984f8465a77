from __future__ import annotations

import bz2
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from citelake.operators.aggregates import build_metadata
from citelake.operators.extract_xml import MALFORMED, accepted, extract_xml
from citelake.operators.search import in_years, search, without_year
from citelake.plans.build import (
    build_documents,
    build_from_xml,
    build_trees,
    publish_metadata,
    reprocess_documents,
    resume_from_xml,
)
from citelake.plans import sinks, swaps
from citelake.plans.sinks import write_table
from citelake.plans.swaps import data_files
from citelake.schema import TABLE_SCHEMA
from citelake.sources import contents, tables
from citelake.sources.contents import read_contents, year_totals
from citelake.sources.damaged import damaged_files
from citelake.sources.id_index import ROWS_SCHEMA, find_ids, index_ids
from citelake.sources.inputs import input_files
from citelake.sources.manifest import read_manifest
from citelake.sources.tables import read_rejects, read_table, read_year_layout, register
from citelake.sources.xml_files import read_xml_records
from citelake.streaming.arrivals import follow
from tests.records import bulk, record


def numbered(pmid: int, year: int | None, title: str = "t") -> str:
    return record(
        pmid=f"<PMID>{pmid}</PMID>",
        title=f"<ArticleTitle>{title}</ArticleTitle>",
        date="" if year is None else f"<Year>{year}</Year>",
    )


@pytest.fixture
def inputs(tmp_path, write_gzip):
    folder = tmp_path / "in"
    folder.mkdir()
    write_gzip(folder / "bulk25n0001.xml.gz", bulk(numbered(1, 1999), numbered(2, None)))
    write_gzip(
        folder / "bulk25n0002.xml.gz",
        bulk(numbered(3, 1999), numbered(4, 2001).replace("</ArticleTitle>", ""), numbered(5, 2001)),
    )
    (folder / "notes.txt").write_text("<PubmedArticle>no input</PubmedArticle>")
    return str(folder)


def files_read(frame) -> list[int]:
    """Number of files each scan of a plan read; the frame must not have run before."""
    frame.collect()

    def visit(plan):
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return visit(plan.executedPlan())
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if not children:
            return [plan.metrics().apply("numFiles").value()]
        return [count for child in children for count in visit(child)]

    return visit(frame._jdf.queryExecution().executedPlan())


def test_reader_isolates_records(spark, inputs):
    rows = read_xml_records(spark, inputs).collect()
    assert len(rows) == 5 and all(r.closed for r in rows)
    assert {r.src for r in rows} == {"bulk25n0001.xml.gz", "bulk25n0002.xml.gz"}


def test_reader_keeps_unclosed_and_truncated_records(spark, tmp_path, write_gzip):
    broken = numbered(1, 1999).replace("</PubmedArticle>", "")
    with_attribute = numbered(2, 1999).replace("<PubmedArticle>", '<PubmedArticle a="1">')
    cut = numbered(3, 1999)[:80]
    write_gzip(tmp_path / "a.xml.gz", bulk(broken, with_attribute) + cut)
    rows = read_xml_records(spark, str(tmp_path)).collect()
    assert [r.closed for r in rows] == [False, True, True]
    table = build_from_xml(spark, str(tmp_path), str(tmp_path / "table"))
    assert [r.PMID for r in table.collect()] == [2]
    assert read_rejects(spark, str(tmp_path / "table")).count() == 2


@pytest.mark.parametrize("suffix", ["", ".bz2"])
def test_large_splittable_file_is_read_by_several_tasks(spark, tmp_path, suffix):
    text = bulk(*[numbered(i, 1999, "t" * (i % 97)) for i in range(3000)])
    opened = bz2.open(f"{tmp_path}/a.xml.bz2", "wt") if suffix else open(tmp_path / "a.xml", "w")
    with opened as out:
        out.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    try:
        records = read_xml_records(spark, str(tmp_path), glob="*.xml*")
        parts = records.rdd.getNumPartitions()
        ids = [r.PMID for r in accepted(extract_xml(records)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert parts > 1
    assert sorted(ids) == list(range(3000))


def test_damaged_gzip_fails_the_job(spark, tmp_path, write_gzip):
    path = write_gzip(tmp_path / "a.xml.gz", bulk(*[numbered(i, 1999) for i in range(500)]))
    content = open(path, "rb").read()
    with open(path, "wb") as out:
        out.write(content[: len(content) // 2])
    with pytest.raises(Exception, match="FAILED_READ_FILE|Unexpected end"):
        read_xml_records(spark, str(tmp_path)).count()


def test_build_keeps_null_years_and_rejects(spark, inputs, tmp_path):
    root = str(tmp_path / "table")
    table = build_from_xml(spark, inputs, root)
    rows = {r.PMID: r for r in table.collect()}
    assert set(rows) == {1, 2, 3, 5}
    assert rows[2].Year is None and rows[2].pub_year == 0
    assert rows[5].Year == 2001 and rows[5].pub_year == 2001
    assert rows[3].src == "bulk25n0002.xml.gz"
    reject = read_rejects(spark, root).collect()
    assert [(r.src, r.reason) for r in reject] == [("bulk25n0002.xml.gz", MALFORMED)]
    assert "<PMID>4</PMID>" in reject[0].raw
    assert sorted(os.listdir(f"{root}/outcome=accepted")) == [
        "pub_year=0",
        "pub_year=1999",
        "pub_year=2001",
    ]


def test_year_filter_prunes_directories(spark, inputs, tmp_path):
    table = build_from_xml(spark, inputs, str(tmp_path / "table"))
    assert files_read(in_years(table, 2001, 2001).select("PMID")) == [1]
    assert files_read(in_years(table, 2000).select("PMID")) == [1]
    assert files_read(without_year(table).select("PMID")) == [1]
    assert [r.PMID for r in search(table, year_from=2000).collect()] == [5]


def test_sql_on_year_alone_prunes(spark, inputs, tmp_path):
    register(build_from_xml(spark, inputs, str(tmp_path / "table")), "pruned")
    in_2001 = "SELECT PMID, Year FROM pruned WHERE Year = 2001"
    assert [tuple(r) for r in spark.sql(in_2001).collect()] == [(5, 2001)]
    # One directory of the three, and the one of rows that may have no year.
    assert files_read(spark.sql(in_2001)) == [1, 1]
    assert [r.PMID for r in spark.sql("SELECT PMID FROM pruned WHERE Year IS NULL").collect()] == [2]
    assert spark.sql("SELECT PMID FROM pruned").count() == 4


def test_scan_reads_only_needed_columns(spark, inputs, tmp_path):
    table = build_from_xml(spark, inputs, str(tmp_path / "table"))
    plan = search(table, title="T", columns=("PMID",))._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<PMID:bigint,Title:string>" in plan.toString()


def test_start_from_opens_later_files_only(spark, inputs):
    records = read_xml_records(spark, inputs, start_from=2)
    assert files_read(records.select("src")) == [1]
    assert {r.src for r in records.collect()} == {"bulk25n0002.xml.gz"}


def test_records_of_a_large_file_are_spread(spark, tmp_path, write_gzip):
    (tmp_path / "in").mkdir()
    write_gzip(tmp_path / "in" / "a.xml.gz", bulk(*[numbered(i, 1999) for i in range(400)]))
    records = read_xml_records(spark, str(tmp_path / "in"), spread=4)
    held = records.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 4 and max(r["count"] for r in held) < 150
    table = build_from_xml(spark, str(tmp_path / "in"), str(tmp_path / "table"), spread=4)
    assert table.select("PMID").distinct().count() == table.count() == 400


def test_resume_adds_only_new_files(spark, inputs, tmp_path, write_gzip):
    root = str(tmp_path / "table")
    assert resume_from_xml(spark, inputs, root).count() == 4
    assert resume_from_xml(spark, inputs, root).count() == 4
    write_gzip(f"{inputs}/bulk25n0003.xml.gz", bulk(numbered(6, 1999)))
    assert sorted(r.PMID for r in resume_from_xml(spark, inputs, root).collect()) == [1, 2, 3, 5, 6]


def test_resume_refuses_repeated_names(spark, tmp_path, write_gzip):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        write_gzip(tmp_path / folder / "n1.xml.gz", bulk(numbered(1, 1999)))
    with pytest.raises(ValueError, match="n1.xml.gz"):
        resume_from_xml(spark, str(tmp_path / "[ab]"), str(tmp_path / "table"))


def test_follow_adds_arrivals_once(spark, inputs, tmp_path, write_gzip):
    root, seen = str(tmp_path / "table"), str(tmp_path / "seen")
    follow(spark, inputs, root, seen).awaitTermination()
    assert read_table(spark, root).count() == 4
    write_gzip(f"{inputs}/bulk25n0003.xml.gz", bulk(numbered(6, 1999)))
    follow(spark, inputs, root, seen).awaitTermination()
    assert read_table(spark, root).count() == 5
    # A lost checkpoint offers everything again; nothing is added twice.
    follow(spark, inputs, root, str(tmp_path / "other")).awaitTermination()
    assert read_table(spark, root).count() == 5


def test_documents_and_trees(spark, inputs, tmp_path):
    documents, trees = str(tmp_path / "documents"), str(tmp_path / "trees")
    build_documents(spark, inputs, documents)
    build_trees(spark, inputs, trees)
    assert spark.read.parquet(documents).dtypes == [("PMID", "string"), ("JSON", "string")]
    assert spark.read.parquet(trees).dtypes == [
        ("pmid", "int"),
        ("json", "string"),
        ("src", "string"),
    ]
    table = reprocess_documents(spark, documents, str(tmp_path / "table"))
    assert sorted((r.PMID, r.Year) for r in table.filter("Year > 0").collect()) == [
        (1, 1999),
        (3, 1999),
        (5, 2001),
    ]


def test_crowded_year_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.col("id").alias("PMID"),
        *[F.sha2(F.col("id").cast("string"), 512).alias(c) for c in ("Title", "Abstract")],
        *[F.lit("").alias(f.name) for f in TABLE_SCHEMA if f.dataType.typeName() == "string"][2:],
        F.when(F.col("id") % 3 == 0, 2024).otherwise((F.col("id") % 70).cast("int")).alias("Year"),
    )
    root = str(tmp_path / "table")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_table(rows.repartition(8), root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    files = read_table(spark, root).select(F.input_file_name().alias("f"), "pub_year", "PMID")
    crowded = files.filter("pub_year = 2024").groupBy("f").count().collect()
    assert len(crowded) > 3
    assert files.count() == 40_000 and files.select("PMID").distinct().count() == 40_000


def test_metadata_document(spark, inputs, tmp_path):
    root = str(tmp_path / "table")
    build_from_xml(spark, inputs, root)
    row = publish_metadata(spark, root, str(tmp_path / "meta"), "test", "2025-01-08").first()
    assert row.total_records == 4
    assert row.year_distribution == {"0": 1, "1999": 2, "2001": 1}
    assert (row.schema_version, row.source, row.baseline_date) == ("2.0", "test", "2025-01-08")


def test_metadata_of_empty_table(spark):
    row = build_metadata(spark.createDataFrame([], TABLE_SCHEMA), "none").first()
    assert row.total_records == 0 and row.year_distribution == {}


def test_year_layout_keeps_nulls_and_prunes(spark, tmp_path):
    schema = pa.schema(
        [
            pa.field(f.name, pa.int64() if f.name == "PMID" else pa.int32() if f.name == "Year" else pa.string())
            for f in TABLE_SCHEMA
        ]
    )
    for bucket, rows in {0: [(1, None), (2, 0)], 1999: [(3, 1999)], 2001: [(4, 2001)]}.items():
        folder = tmp_path / f"year={bucket}"
        folder.mkdir()
        columns = {f.name: [""] * len(rows) for f in TABLE_SCHEMA}
        columns["PMID"], columns["Year"] = [r[0] for r in rows], [r[1] for r in rows]
        pq.write_table(pa.table(columns, schema=schema), folder / "bulk25n0001.parquet")
    table = read_year_layout(spark, str(tmp_path))
    assert {r.PMID: (r.Year, r.pub_year) for r in table.collect()} == {
        1: (None, 0),
        2: (0, 0),
        3: (1999, 1999),
        4: (2001, 2001),
    }
    assert files_read(in_years(table, 2001, 2001).select("PMID")) == [1]
    assert [r.PMID for r in without_year(table).collect()] == [1]


def test_input_listing_reads_no_content(spark, inputs):
    files = input_files(spark, inputs)
    assert [r.name for r in files.orderBy("name").collect()] == [
        "bulk25n0001.xml.gz",
        "bulk25n0002.xml.gz",
    ]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_manifest_lists_what_was_read(spark, inputs, tmp_path, write_gzip):
    root = str(tmp_path / "table")
    write_gzip(f"{inputs}/bulk25n0009.xml.gz", "<empty/>")
    resume_from_xml(spark, inputs, root, exclude=["bulk25n0002.xml.gz"])
    lines = {r.name: (r.accepted, r.rejected) for r in read_manifest(spark, root).collect()}
    assert "bulk25n0002.xml.gz" not in lines and lines["bulk25n0009.xml.gz"] == (0, 0)
    resume_from_xml(spark, inputs, root)
    assert read_manifest(spark, root).count() == 3
    table, rejects = read_table(spark, root), read_rejects(spark, root)
    total = read_manifest(spark, root).agg(F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(total) == (table.count(), rejects.count())


def test_half_a_file_is_done_again(spark, inputs, tmp_path):
    whole = sorted(r.PMID for r in resume_from_xml(spark, inputs, str(tmp_path / "whole")).collect())
    for number, resume in enumerate((resume_from_xml, None)):
        root = str(tmp_path / f"table{number}")
        write_table(extract_xml(read_xml_records(spark, inputs)).limit(1), root)
        if resume:
            resume(spark, inputs, root)
        else:
            follow(spark, inputs, root, str(tmp_path / "seen")).awaitTermination()
        assert sorted(r.PMID for r in read_table(spark, root).collect()) == whole


def test_replacing_years_moves_ids_and_keeps_other_rejects(spark, tmp_path):
    root = str(tmp_path / "table")
    schema = "PMID bigint, Title string, Year int, src string, raw string, reason string"

    def rows(*values):
        frame = spark.createDataFrame(list(values), schema)
        missing = [f for f in TABLE_SCHEMA.fields if f.name not in frame.columns]
        return frame.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

    write_table(
        rows(
            (1, "a", 2000, "f1", None, None),
            (2, "b", 2000, "f1", None, None),
            (3, "c", 1999, "f2", None, None),
            (None, None, None, "f1", "<x", "bad"),
            (None, None, None, "f2", "<y", "bad"),
        ),
        root,
    )
    write_table(rows((3, "c2", 2001, "f2", None, None), (1, "a2", 2002, "f2", None, None)), root, mode="years")
    got = sorted((r.PMID, r.Title, r.Year) for r in read_table(spark, root).collect())
    assert got == [(1, "a2", 2002), (2, "b", 2000), (3, "c2", 2001)]
    assert [r.src for r in read_rejects(spark, root).collect()] == ["f1"]


def test_metadata_of_an_empty_table(spark, tmp_path):
    root = str(tmp_path / "table")
    write_table(spark.createDataFrame([], TABLE_SCHEMA), root)
    row = publish_metadata(spark, root, str(tmp_path / "meta"), "none").first()
    assert (row.total_records, row.year_distribution, row.baseline_date) == (0, {}, None)


# --- batches, contents and swaps -------------------------------------------------


def batches(spark, root) -> set[str]:
    return {r.name.split("-")[0] for r in data_files(spark, root).collect()}


def table_rows(*values):
    """(id, title, year, file) rows of a table."""
    schema = "PMID bigint, Title string, Year int, src string"

    def make(spark):
        frame = spark.createDataFrame(list(values), schema)
        missing = [f for f in TABLE_SCHEMA.fields if f.name not in frame.columns]
        return frame.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

    return make


def held(spark, root):
    return sorted((r.PMID, r.Title, r.Year) for r in read_table(spark, root).collect())


def scanned(spark, work) -> list[str]:
    """Table folders that jobs of ``work`` scanned data files of, by file."""
    found, plain = [], tables.stored_rows

    def noted(session, root, names="*"):
        found.append(names)
        return plain(session, root, names)

    with pytest.MonkeyPatch.context() as patch:
        for module in (contents, sinks, swaps):
            patch.setattr(module, "stored_rows", noted)
        work()
    return found


def test_contents_follow_every_write(spark, inputs, tmp_path, write_gzip):
    root = str(tmp_path / "table")

    def agree():
        rows = read_table(spark, root)
        counted = {r.pub_year: r["count"] for r in rows.groupBy("pub_year").count().collect()}
        assert {r.pub_year: r.records for r in year_totals(spark, root).collect()} == counted
        kept = read_contents(spark, root)
        assert {r[0] for r in kept.select("batch").distinct().collect()} == batches(spark, root)
        by_file = kept.filter("outcome = 'accepted'").groupBy("src").agg(F.sum("records").alias("count"))
        plain = rows.groupBy("src").count()
        assert {tuple(r) for r in by_file.collect()} == {tuple(r) for r in plain.collect()}

    build_from_xml(spark, inputs, root)
    agree()
    write_gzip(f"{inputs}/bulk25n0003.xml.gz", bulk(numbered(6, 1999), numbered(7, 2001)))
    resume_from_xml(spark, inputs, root)
    agree()
    write_table(table_rows((6, "moved", 2003, "f"), (1, "new", 1999, "f"))(spark), root, mode="years")
    assert held(spark, root) == [
        (1, "new", 1999),
        (2, "t", None),
        (5, "t", 2001),
        (6, "moved", 2003),
        (7, "t", 2001),
    ]
    agree()


def test_resume_and_follow_open_no_stored_files(spark, inputs, tmp_path, write_gzip):
    """All that is scanned of the table are the files that the batch itself has written."""
    root, seen = str(tmp_path / "table"), str(tmp_path / "seen")
    follow(spark, inputs, root, seen).awaitTermination()
    for number, work in enumerate(
        (
            lambda: resume_from_xml(spark, inputs, root),
            lambda: follow(spark, inputs, root, seen).awaitTermination(),
        )
    ):
        write_gzip(f"{inputs}/bulk25n000{number + 4}.xml.gz", bulk(numbered(10 + number, 1999)))
        before = batches(spark, root)
        names = scanned(spark, work)
        new = batches(spark, root) - before
        assert len(new) == 1 and names == [f"{new.pop()}-*"]
    assert read_table(spark, root).count() == 6


def test_metadata_reads_no_records(spark, inputs, tmp_path):
    root = str(tmp_path / "table")
    build_from_xml(spark, inputs, root)
    row = []
    assert scanned(spark, lambda: row.append(publish_metadata(spark, root, str(tmp_path / "m"), "t").first())) == []
    assert row[0].year_distribution == {"0": 1, "1999": 2, "2001": 1}


def test_unrecorded_batch_is_undone(spark, tmp_path, monkeypatch):
    """The driver is lost after the rows are in place and before they are recorded."""
    root = str(tmp_path / "table")
    write_table(table_rows((1, "a", 2000, "f1"))(spark), root)
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "record_batch", lost_driver)
        with pytest.raises(DriverLost):
            write_table(table_rows((2, "b", 2000, "f2"))(spark), root, mode="append")
    assert len(held(spark, root)) == 2
    write_table(table_rows((3, "c", 2001, "f3"))(spark), root, mode="append")
    assert [r[0] for r in held(spark, root)] == [1, 3]


class DriverLost(Exception):
    pass


def lost_driver(*_):
    raise DriverLost


@pytest.mark.parametrize("lost", ["_move_in", "delete", "add_lines", "moved half", "after"])
def test_interrupted_replacement_is_carried_through(spark, tmp_path, monkeypatch, lost):
    root = str(tmp_path / "a table")
    write_table(table_rows(*[(i, "old", 2000 + i % 3, "f1") for i in range(30)])(spark).repartition(3), root)
    new = table_rows((3, "new", 2000, "f2"), (4, "new", 2005, "f2"), (5, "new", 2002, "f2"))(spark)
    expected = sorted(
        [(3, "new", 2000), (4, "new", 2005), (5, "new", 2002)]
        + [(i, "old", 2001) for i in range(30) if i % 3 == 1 and i != 4]
    )
    with monkeypatch.context() as patch:
        if lost == "moved half":
            moved, plain = [], swaps._listed

            def half(files, folder):
                found = plain(files, folder)
                if "rows/outcome=" in str(folder) and "pub_year" in str(folder):
                    moved.append(folder)
                    if len(moved) > 1:
                        raise DriverLost
                return found

            patch.setattr(swaps, "_listed", half)
        elif lost == "delete":
            plain_delete = swaps.delete

            def refuse(session, paths):
                if any("outcome=" in p for p in paths):
                    raise DriverLost
                plain_delete(session, paths)

            patch.setattr(swaps, "delete", refuse)
        elif lost == "after":
            patch.setattr(sinks, "apply_swap", lambda *args: (swaps.apply_swap(*args), lost_driver()))
        else:
            patch.setattr(swaps, lost, lost_driver)
        with pytest.raises(DriverLost):
            write_table(new, root, mode="years")
    if lost not in ("add_lines", "after"):  # the old rows of replaced years go just before
        assert {r[0] for r in held(spark, root)} >= set(range(30))
    sinks.mend(spark, root)
    assert held(spark, root) == expected
    assert {r.pub_year: r.records for r in year_totals(spark, root).collect()} == {2000: 1, 2001: 9, 2002: 1, 2005: 1}
    assert sorted(p for p in os.listdir(root) if p.startswith("_")) == ["_SUCCESS", "_contents"]
    sinks.mend(spark, root)
    assert held(spark, root) == expected


def test_lost_before_the_journal_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    write_table(table_rows((1, "old", 2000, "f1"))(spark), root)
    with monkeypatch.context() as patch:
        patch.setattr(swaps.Swap, "begin", lost_driver)
        with pytest.raises(DriverLost):
            write_table(table_rows((1, "new", 2000, "f1"))(spark), root, mode="years")
    sinks.mend(spark, root)
    assert held(spark, root) == [(1, "old", 2000)]
    assert not os.path.exists(f"{root}/_staging")


def test_table_without_batches_is_taken_over(spark, inputs, tmp_path):
    """A table whose files have Spark's own names counts as one batch."""
    root = str(tmp_path / "table")
    rows = table_rows((1, "a", 2000, "bulk25n0001.xml.gz"), (9, "b", 2001, "other"))(spark)
    rows.selectExpr("*", "cast(null as string) AS raw", "cast(null as string) AS reason", "'accepted' as outcome", "Year as pub_year").write.partitionBy(
        "outcome", "pub_year"
    ).parquet(root)
    found = sorted(r.PMID for r in resume_from_xml(spark, inputs, root).collect())
    assert found == [1, 2, 3, 5, 9]  # the rows of a pending file are replaced
    assert {r.pub_year: r.records for r in year_totals(spark, root).collect()} == {0: 1, 1999: 2, 2001: 2}


def test_follow_notes_files_without_records(spark, inputs, tmp_path, write_gzip):
    root = str(tmp_path / "table")
    write_gzip(f"{inputs}/bulk25n0009.xml.gz", "<empty/>")
    follow(spark, inputs, root, str(tmp_path / "seen")).awaitTermination()
    lines = {r.name: r for r in read_manifest(spark, root).collect()}
    assert {n: (r.accepted, r.rejected) for n, r in lines.items()} == {
        "bulk25n0001.xml.gz": (2, 0),
        "bulk25n0002.xml.gz": (2, 1),
        "bulk25n0009.xml.gz": (0, 0),
    }
    listed = {r.name: (r.bytes, r.modified) for r in input_files(spark, inputs).collect()}
    assert {n: (r.bytes, r.modified) for n, r in lines.items()} == listed


# --- the id index -----------------------------------------------------------------


def test_lookup_by_index_opens_few_files(spark, tmp_path):
    root = str(tmp_path / "table")
    rows = table_rows(*[(i, f"t{i}", 1990 + i % 25, "f") for i in range(500)])(spark)
    write_table(rows.repartition(4), root)
    assert index_ids(spark, root) and index_ids(spark, root) == []
    everything = files_read(read_table(spark, root).filter("PMID IN (7, 123)").select("PMID"))
    found = find_ids(spark, root, [7, 123, 99_999, -5])
    assert found.columns == read_table(spark, root).columns
    opened = files_read(found.select("PMID", "Title", "Year"))
    assert everything[0] >= 25 and opened[0] <= 2
    assert sorted(r.Title for r in found.collect()) == ["t123", "t7"]
    # of the index itself, one directory for each id at most is read
    lookup = spark.read.schema(ROWS_SCHEMA).parquet(f"{root}/_ids/rows").filter("bucket = 7 AND PMID = 7")
    assert files_read(lookup)[0] <= 2


def test_index_may_lag_behind_the_table(spark, tmp_path):
    """Rows written, moved or replaced since are found, and removed ones are not."""
    root = str(tmp_path / "table")

    def found(*ids):
        return sorted((r.PMID, r.Title, r.Year) for r in find_ids(spark, root, ids).collect())

    write_table(table_rows((1, "a", 2000, "f"), (2, "b", 2001, "f"), (-3, "n", None, "f"))(spark), root)
    assert found(1, -3) == [(-3, "n", None), (1, "a", 2000)]  # without an index
    index_ids(spark, root)
    write_table(table_rows((3, "c", 2000, "g"), (1, "a too", 1990, "g"))(spark), root, mode="append")
    assert found(1, 2, 3, -3) == [(-3, "n", None), (1, "a", 2000), (1, "a too", 1990), (2, "b", 2001), (3, "c", 2000)]
    write_table(table_rows((1, "moved", 2005, "h"), (4, "d", 2001, "h"))(spark), root, mode="years")
    expected = [(1, "moved", 2005), (3, "c", 2000), (4, "d", 2001)]
    assert found(1, 2, 3, 4) == expected
    index_ids(spark, root)
    assert found(1, 2, 3, 4) == expected and found() == [] and found(77) == []


def test_index_of_a_lost_driver(spark, tmp_path, monkeypatch):
    """Rows that were added without naming their batch are added again; lookups stay right."""
    root = str(tmp_path / "table")
    write_table(table_rows((1, "a", 2000, "f"))(spark), root)
    index_ids(spark, root)
    shutil.rmtree(f"{root}/_ids/batches")
    assert [r.PMID for r in find_ids(spark, root, [1]).collect()] == [1]
    index_ids(spark, root)
    assert [r.PMID for r in find_ids(spark, root, [1]).collect()] == [1]


# --- damaged files ------------------------------------------------------------------


def cut_short(path) -> None:
    content = open(path, "rb").read()
    with open(path, "wb") as out:
        out.write(content[: len(content) // 2])


@pytest.fixture
def partly_damaged(tmp_path, write_gzip):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(7):
        write_gzip(folder / f"bulk25n000{n}.xml.gz", bulk(*[numbered(100 * n + i, 1999) for i in range(30)]))
    for n in (2, 5):
        cut_short(folder / f"bulk25n000{n}.xml.gz")
    (folder / "bulk25n0006.xml.gz").write_bytes(b"no gzip at all")
    return folder


def test_damaged_files_cost_no_others(spark, partly_damaged, tmp_path, write_gzip):
    source, good = str(partly_damaged), [100 * n + i for n in (0, 1, 3, 4) for i in range(30)]
    bad = {f"bulk25n000{n}.xml.gz" for n in (2, 5, 6)}
    for build in (build_from_xml, resume_from_xml):
        root = str(tmp_path / build.__name__)
        assert sorted(r.PMID for r in build(spark, source, root).collect()) == good
        lines = {r.name: r for r in read_manifest(spark, root).collect()}
        assert len(lines) == 7 and {n for n, r in lines.items() if r.error} == bad
        assert all(r.accepted == (0 if r.error else 30) for r in lines.values())
        # nothing is tried again as it stands
        assert scanned(spark, lambda root=root: resume_from_xml(spark, source, root)) == []
    # a file put in a damaged one's place is taken up
    write_gzip(partly_damaged / "bulk25n0005.xml.gz", bulk(numbered(501, 2000)))
    assert sorted(r.PMID for r in resume_from_xml(spark, source, root).collect()) == sorted([*good, 501])


def test_damaged_files_fail_where_that_is_wanted(spark, partly_damaged, tmp_path):
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        build_from_xml(spark, str(partly_damaged), str(tmp_path / "table"), set_aside=False)


def test_other_failures_are_not_taken_for_damage(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        damaged_files(spark, [str(tmp_path / "none.gz")])
    assert damaged_files(spark, []) == {}
