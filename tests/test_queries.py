from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.functions.joins import look_up
from citelake.functions.text import output_stem, strip_tags
from citelake.operators import aggregates, quality, sampling
from citelake.operators.compare import compare_records, compare_sample, match_summary
from citelake.operators.search import has_id, search, title_has
from citelake.schema import TABLE_COLUMNS
from citelake.sources.inputs import from_number, has_suffix, names_in_listing, pending_inputs
from tests.conftest import SF_DIR
from workload import extract_queries
from workload.shapes import cut_copy

ROWS = [
    (1, "Toxicity of É", "about lead", "10.1/1", 2021, "Endocrine Disruptors; Lead"),
    (2, "Other", "TOXICITY here", "", 2022, "Lead"),
    (3, "", "nothing", "10.1/3", None, ""),
    (4, "toxicity again, and longer", "x", "10.1/4", 1990, "endocrine disruptors"),
    (5, "late", "y", "10.1/5", 3115, ""),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        ROWS, "PMID bigint, Title string, Abstract string, DOI string, Year int, MeSH_Terms string"
    )


def ids(frame) -> list[int]:
    return sorted(r.PMID for r in frame.collect())


def test_search(table):
    assert ids(search(table, title="toxicity")) == [1, 4]
    assert ids(search(table, title="é")) == [1]
    assert ids(search(table, text="toxicity")) == [1, 2, 4]
    assert ids(search(table, text="toxicity", year_from=2020)) == [1, 2]
    assert ids(search(table, subject="Endocrine Disruptors", year_from=2020)) == [1]
    assert ids(search(table, year_from=1990, year_to=2021)) == [1, 4]
    assert ids(search(table, ids=[3])) == [3] and ids(search(table, ids=[3, 5, 9])) == [3, 5]
    assert search(table, text="toxicity", limit=2).count() == 2
    assert search(table).columns == ["PMID", "Title", "Year", "DOI"]


def test_pattern_characters(spark):
    texts = spark.createDataFrame([(1, r"a\b"), (2, "ab"), (3, "a-b"), (4, "A\\B")], "PMID int, Title string")
    assert ids(texts.filter(title_has("a\\B"))) == [1, 4]
    assert ids(texts.filter(title_has("a_b"))) == [1, 3, 4]
    assert ids(texts.filter(title_has("a%b"))) == [1, 2, 3, 4]


def test_no_ids_find_nothing(table):
    assert search(table, ids=[]).count() == 0


def test_contains_needs_no_pattern_matching(table):
    plan = table.filter(title_has("Toxicity"))._jdf.queryExecution().executedPlan().toString()
    assert "Contains(lower(" in plan


def test_known_records_survive_a_crowded_id(spark, table):
    crowd = spark.range(2000).select(
        F.lit(2).cast("bigint").alias("PMID"), F.lit("same").alias("Title"), F.lit(2022).alias("Year")
    )
    rows = table.select("PMID", "Title", "Year").unionByName(crowd)
    expected = spark.createDataFrame([(1,), (2,), (3,), (9,)], "PMID bigint")
    found = {r.PMID: r for r in quality.known_records(rows, expected).collect()}
    assert len(found) == 4
    assert found[1].titled and found[2].titled and found[2].found
    assert found[3].found and not found[3].titled
    assert not found[9].found


def test_counts(table):
    counted = {r.Year: r.records for r in aggregates.year_counts(table).collect()}
    assert counted == {None: 1, 1990: 1, 2021: 1, 2022: 1, 3115: 1}
    assert [r.Year for r in aggregates.recent_years(table, 3).collect()] == [2021, 2022, 3115]
    rates = {r.field: r.percent for r in aggregates.fill_rates(table, "Title", "DOI").collect()}
    assert rates == {"Title": 80.0, "DOI": 80.0}
    assert tuple(aggregates.year_coverage(table).first()) == (3, False)
    assert tuple(aggregates.year_coverage(table, needed=(1990, 2022)).first()) == (3, True)
    assert tuple(quality.limited_search(table, "toxicity", 2020, 1).first()) == (1, True)
    assert aggregates.total_records(table).first().total_records == 5


def test_file_year_counts(spark):
    rows = spark.createDataFrame(
        [("a", 1999), ("a", 1999), ("a", None), ("b", 1999)], "src string, Year int"
    )
    counted = {
        (r.src, r.bucket, r.level): r.records
        for r in aggregates.file_year_counts(rows).collect()
    }
    assert counted == {
        ("a", 1999, 0): 2,
        ("a", 0, 0): 1,
        ("b", 1999, 0): 1,
        ("a", None, 1): 3,
        ("b", None, 1): 1,
        (None, None, 3): 4,
    }


def test_out_of_range_years(table):
    assert [(r.Year, r.records) for r in quality.out_of_range_years(table, 2025).collect()] == [
        (3115, 1)
    ]


def test_quality_report(table):
    report = quality.quality_report(
        table,
        min_records=5,
        known_ids=[1, 3],
        term="toxicity",
        min_term_hits=2,
        min_years=3,
        needed_years=(1990, 2024),
    )
    passed = {r.check: r.passed for r in report.collect()}
    assert passed == {
        "columns": False,
        "integer_types": True,
        "records": True,
        "years": True,
        "needed_years": False,
        "title_percent": False,
        "known_ids": False,
        "term_hits": True,
    }
    assert set(quality.missing_columns(table)) == set(TABLE_COLUMNS) - set(table.columns)


def test_samples(table):
    good = sampling.well_described(table, 10)
    assert ids(good) == [1, 4]
    assert ids(sampling.repeatable_sample(table, 2, "a")) == ids(
        sampling.repeatable_sample(table, 2, "a")
    )
    assert sampling.random_sample(table, 3).count() == 3
    plan = sampling.random_sample(table, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_comparison(spark, table):
    authority = spark.createDataFrame(
        [
            (1, " <i>Toxicity</i> of É", "10.1/1"),
            (2, "Other", None),
            (4, "changed", "10.1/4"),
            (5, "late", "other"),
            (0, "none", ""),
        ],
        "PMID bigint, Title string, DOI string",
    )
    compared = {r.PMID: r for r in compare_records(table, authority).collect()}
    assert [compared[i].matched for i in (1, 2, 3, 4, 5)] == [True, True, False, False, False]
    assert not compared[3].found and compared[4].doi_match and compared[5].title_match
    summary = match_summary(compare_records(table, authority)).first()
    assert (summary.compared, summary.matches, summary.passed) == (5, 2, False)
    assert compare_sample(table, authority, 1).count() == 1


def test_comparison_keeps_its_size_with_a_crowded_id(spark):
    crowd = spark.range(3000).select(
        (F.when(F.col("id") % 3 == 0, 0).otherwise(7)).cast("bigint").alias("PMID"),
        F.lit("t").alias("Title"),
        F.lit("").alias("DOI"),
    )
    compared = compare_records(crowd, crowd, crowded_rows=500)
    assert compared.count() == 3000
    assert compared.filter("matched").count() == 2000
    assert compared.filter("found").count() == 2000


def test_look_up_spreads_crowded_keys(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("k"))
    unique = spark.range(0, 1000, 2).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    unique = unique.unionByName(spark.sql("SELECT 7L AS k, 'seven' AS v"))
    joined = look_up(rows, unique, "k", crowded_rows=100)
    plain = rows.join(unique, "k", "left")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )
    assert joined.columns == ["k", "v"]


def test_long_list_of_known_ids(spark, table, monkeypatch):
    monkeypatch.setattr(quality, "few_rows", lambda ids: False)
    expected = spark.createDataFrame([(1,), (3,), (9,)], "PMID bigint")
    found = {r.PMID: r.titled for r in quality.known_records(table, expected).collect()}
    assert found == {1: True, 3: False, 9: False}


def test_inputs(spark):
    listing = spark.createDataFrame(
        [("<a>bulk25n0002.xml.gz</a> bulk25n0001.xml.gz.md5",), ("bulk25n0002.xml.gz",)],
        "value string",
    )
    names = names_in_listing(listing, r"bulk\d+n\d+\.xml\.gz")
    assert [r.name for r in names.collect()] == ["bulk25n0001.xml.gz", "bulk25n0002.xml.gz"]
    assert [r.name for r in from_number(names, 2).collect()] == ["bulk25n0002.xml.gz"]
    done = spark.createDataFrame([("bulk25n0001.parquet",)], "name string")
    assert [r.name for r in pending_inputs(names, done).collect()] == ["bulk25n0002.xml.gz"]
    assert names.filter(has_suffix(F.col("name"))).count() == 2


def test_progress(spark):
    inputs = spark.range(10)
    outputs = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS modified "
        "FROM range(4)"
    )
    row = aggregates.build_progress(
        inputs, outputs, spark.range(1), F.expr("TIMESTAMP '2024-01-01 00:02:00'")
    ).first()
    assert row.asDict() == {
        "elapsed": 120,
        "doc_rem": 6,
        "doc_don": 4,
        "failure": 1,
        "doc_min": 2.0,
        "est_hrs": 0.05,
    }


@pytest.mark.parametrize(
    "name, stem",
    [("x0001.xml.gz", "x0001"), ("x0001.parquet", "x0001"), ("x0001.xml", "x0001"), ("x1", "x1")],
)
def test_output_stem(spark, name, stem):
    assert spark.range(1).select(output_stem(F.lit(name))).first()[0] == stem


def test_strip_tags(spark):
    row = spark.range(1).select(
        strip_tags(F.lit("a<i>b</i> < c")), strip_tags(F.lit(None).cast("string"))
    ).first()
    assert tuple(row) == ("ab < c", "")


def test_damaged_build_sends_no_file_to_the_driver(spark, monkeypatch):
    collected, kind = [], type(spark.range(1))
    collect = kind.collect

    def watched(frame):
        collected.append(frame.schema)
        return collect(frame)

    monkeypatch.setattr(kind, "collect", watched)
    assert extract_queries.damaged_build(spark, SF_DIR).select("damaged").distinct().collect() == [(1,)]
    assert collected and not [f for schema in collected for f in schema if f.dataType == T.BinaryType()]


def test_cut_copy(spark, tmp_path):
    whole = bytes(range(256)) * 100
    (tmp_path / "whole").write_bytes(whole)
    for size in (0, 1, 12_801, len(whole)):
        cut_copy(spark, f"{tmp_path}/whole", f"{tmp_path}/cut{size}", size)
        assert (tmp_path / f"cut{size}").read_bytes() == whole[:size]
