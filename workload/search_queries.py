"""Search, counts, samples and checks on the citation view and on the written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.functions.numbers import date_text, digits_only, leading_year, tolerant_int
from citelake.functions.text import output_stem, present, strip_chars, strip_tags, title_preview
from citelake.operators import aggregates, compare, quality, sampling
from citelake.operators.search import count_rows, in_years, search, title_has, without_year
from citelake.plans.build import publish_metadata
from citelake.plans.sinks import write_metadata, write_table
from citelake.sources.contents import year_totals
from citelake.sources.id_index import find_ids, index_ids
from citelake.sources.inputs import from_number, names_in_listing, pending_inputs
from citelake.sources.tables import read_table, read_year_layout, register
from workload.registry import query
from workload.shapes import citations, scratch, table

TERM = "the"


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The citation view after a write and a read."""
    root = scratch(spark, "table")
    write_table(citations(spark, sf_dir), root)
    return read_table(spark, root)


# --- search -------------------------------------------------------------------


@query("SELECT count(*) AS records FROM {citations} WHERE Title ILIKE '%the%'")
def title_search_count(spark, sf_dir):
    return count_rows(citations(spark, sf_dir).filter(title_has(TERM)))


@query(
    "SELECT PMID, Title, Year, DOI FROM {citations} "
    "WHERE Title ILIKE '%tion%' OR Abstract ILIKE '%tion%' ORDER BY PMID LIMIT 100"
)
def abstract_or_title_search(spark, sf_dir):
    return search(citations(spark, sf_dir), text="tion", order_by="PMID", limit=100)


@query(
    "SELECT PMID, Title, Year FROM {citations} WHERE Year >= 1990 AND MeSH_Terms ILIKE '%SRC1%'"
)
def subject_search(spark, sf_dir):
    return search(
        written(spark, sf_dir), subject="SRC1", year_from=1990, columns=("PMID", "Title", "Year")
    )


@query(
    "SELECT PMID, Title, Year FROM {citations} "
    "WHERE Year >= 2000 AND (Title ILIKE '%THE%' OR Abstract ILIKE '%THE%') "
    "ORDER BY PMID LIMIT 10"
)
def combined_search(spark, sf_dir):
    return search(
        written(spark, sf_dir),
        text="THE",
        year_from=2000,
        columns=("PMID", "Title", "Year"),
        order_by="PMID",
        limit=10,
    )


@query(
    "SELECT least(count(*), 100) AS records, count(*) > 0 AS all_recent FROM {citations} "
    "WHERE Year >= 2000 AND (Title ILIKE '%the%' OR Abstract ILIKE '%the%')"
)
def limited_search(spark, sf_dir):
    """A limit without an order: any rows, so their number and bound are what is compared."""
    return quality.limited_search(citations(spark, sf_dir), TERM, 2000, 100)


@query("SELECT count(*) AS records FROM {citations} WHERE Year = 2003")
def year_eq_count(spark, sf_dir):
    return count_rows(in_years(written(spark, sf_dir), 2003, 2003))


@query("SELECT PMID, Year FROM {citations} WHERE Year BETWEEN 1960 AND 1969")
def year_range(spark, sf_dir):
    return in_years(written(spark, sf_dir), 1960, 1969).select("PMID", "Year")


@query("SELECT PMID, Title FROM {citations} WHERE Year IS NULL")
def unknown_year(spark, sf_dir):
    return without_year(written(spark, sf_dir)).select("PMID", "Title")


@query("SELECT PMID, Title, DOI, Journal FROM {citations} WHERE PMID IN (3, 97, 150)")
def point_lookup(spark, sf_dir):
    return search(
        written(spark, sf_dir), ids=(3, 97, 150), columns=("PMID", "Title", "DOI", "Journal")
    )


@query(
    "SELECT * EXCLUDE (src, JSON) FROM {citations} "
    "WHERE length(Title) > 20 AND DOI IS NOT NULL AND length(DOI) > 0 AND Year IS NOT NULL"
)
def present_fields(spark, sf_dir):
    rows = citations(spark, sf_dir)
    return rows.filter(
        present(F.col("Title"), 20) & present(F.col("DOI")) & F.col("Year").isNotNull()
    ).drop("src", "JSON")


@query("SELECT Journal, count(*) AS records FROM {citations} WHERE Year >= 2000 GROUP BY Journal")
def table_sql(spark, sf_dir):
    """Free SQL over the registered table."""
    register(written(spark, sf_dir))
    return spark.sql(
        "SELECT Journal, count(*) AS records FROM citations "
        "WHERE Year >= 2000 GROUP BY Journal"
    )


@query(
    "SELECT Year, count(*) AS records FROM {citations} "
    "WHERE Year IS NULL OR Year < 1955 OR Year = 0 GROUP BY Year"
)
def table_sql_years(spark, sf_dir):
    """Year conditions in free SQL, the missing year among them."""
    register(written(spark, sf_dir), "dated_citations")
    return spark.sql(
        "SELECT Year, count(*) AS records FROM dated_citations "
        "WHERE Year IS NULL OR Year < 1955 OR Year = 0 GROUP BY Year"
    )


# --- counts -------------------------------------------------------------------


@query("SELECT count(*) AS total_records FROM {citations}")
def total_rows(spark, sf_dir):
    return aggregates.total_records(citations(spark, sf_dir))


@query("SELECT Year, count(*) AS records FROM {citations} GROUP BY Year")
def year_histogram(spark, sf_dir):
    return aggregates.year_counts(written(spark, sf_dir))


@query(
    "SELECT CAST(year(o_orderdate) AS INT) AS Year, count(*) AS records FROM orders "
    "GROUP BY ALL ORDER BY Year DESC LIMIT 3"
)
def recent_years(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("Year"))
    return aggregates.recent_years(orders, 3)


@query(
    "SELECT 'Title' AS field, count(*) AS total, "
    "count(CASE WHEN Title IS NOT NULL AND length(Title) > 0 THEN 1 END) AS filled, "
    "count(CASE WHEN length(Title) > 0 THEN 1 END) / count(*) * 100 AS percent FROM {citations} "
    "UNION ALL SELECT 'DOI', count(*), count(CASE WHEN length(DOI) > 0 THEN 1 END), "
    "count(CASE WHEN length(DOI) > 0 THEN 1 END) / count(*) * 100 FROM {citations}"
)
def title_fill_rate(spark, sf_dir):
    return aggregates.fill_rates(citations(spark, sf_dir), "Title", "DOI")


@query(
    "SELECT CAST(count(DISTINCT Year) AS INT) AS years, bool_or(Year = 1990) AND "
    "bool_or(Year = 2024) AS has_needed FROM {citations} WHERE Year BETWEEN 1950 AND 2025"
)
def year_coverage(spark, sf_dir):
    return aggregates.year_coverage(citations(spark, sf_dir))


@query(
    "SELECT src, CAST(coalesce(Year, 0) AS INT) AS bucket, count(*) AS records, "
    "CAST(grouping(src, coalesce(Year, 0)) AS INT) AS level "
    "FROM {citations} GROUP BY ROLLUP (src, coalesce(Year, 0))"
)
def file_year_stats(spark, sf_dir):
    return aggregates.file_year_counts(written(spark, sf_dir))


@query("SELECT src, count(*) AS records FROM {citations} GROUP BY src")
def file_stats(spark, sf_dir):
    return aggregates.file_counts(citations(spark, sf_dir))


@query(
    "SELECT CAST(coalesce(Year, 0) AS STRING) AS bucket, count(*) AS records, "
    "CAST(sum(count(*)) OVER () AS BIGINT) AS total_records, '2.0' AS schema_version, "
    "'documents' AS source, '2025-01-08' AS baseline_date "
    "FROM {citations} GROUP BY coalesce(Year, 0)"
)
def build_metadata(spark, sf_dir):
    """The metadata document after a write and a read, one row per entry of its year map."""
    rows = citations(spark, sf_dir)
    path = scratch(spark, "metadata")
    write_metadata(aggregates.build_metadata(rows, "documents", "2025-01-08"), path)
    schema = (
        "total_records bigint, year_distribution map<string, bigint>, schema_version string, "
        "source string, baseline_date string"
    )
    return (
        spark.read.schema(schema)
        .json(path)
        .select(
            F.explode("year_distribution").alias("bucket", "records"),
            "total_records",
            "schema_version",
            "source",
            "baseline_date",
        )
    )


# --- samples and checks -------------------------------------------------------


@query(
    "SELECT PMID, Title, DOI FROM {citations} WHERE Year BETWEEN 1990 AND 2024 "
    "AND Title IS NOT NULL AND DOI IS NOT NULL AND length(Title) > 20 "
    "ORDER BY md5(CAST(PMID AS STRING) || '7'), PMID LIMIT 20"
)
def sample_records(spark, sf_dir):
    rows = sampling.well_described(in_years(citations(spark, sf_dir), 1990, 2024))
    return sampling.repeatable_sample(rows, 20, "7").select("PMID", "Title", "DOI")


@query("SELECT least(count(*), 20) AS records FROM {citations} WHERE length(Title) > 20")
def random_sample(spark, sf_dir):
    rows = sampling.well_described(citations(spark, sf_dir))
    return count_rows(sampling.random_sample(rows, 20, seed=7))


@query(
    "SELECT e.PMID, citations.PMID IS NOT NULL AS found, "
    "coalesce(length(citations.Title) > 0, false) AS titled, "
    "substring(citations.Title, 1, 60) AS preview, citations.Year "
    "FROM (SELECT doc_id * 3 AS PMID FROM labels) AS e "
    "LEFT JOIN {citations} ON citations.PMID = e.PMID"
)
def known_ids(spark, sf_dir):
    expected = table(spark, sf_dir, "labels").select((F.col("doc_id") * 3).alias("PMID"))
    return quality.known_records(citations(spark, sf_dir), expected)


@query(
    "SELECT r.check, CAST(r.measured AS DOUBLE) AS measured, CAST(r.required AS DOUBLE) AS "
    "required, r.measured >= r.required AS passed FROM ("
    "SELECT unnest([{'check': 'columns', 'measured': 13, 'required': 13},"
    "{'check': 'integer_types', 'measured': 2, 'required': 2},"
    "{'check': 'records', 'measured': count(*), 'required': 100},"
    "{'check': 'years', 'measured': count(DISTINCT Year), 'required': 50},"
    "{'check': 'needed_years', 'measured': CAST(bool_or(Year = 1990) AS INT) "
    "+ CAST(bool_or(Year = 2024) AS INT), 'required': 2},"
    "{'check': 'title_percent', 'measured': count(CASE WHEN length(Title) > 0 THEN 1 END)"
    " / count(*) * 100, 'required': 95},"
    "{'check': 'known_ids', 'measured': count(CASE WHEN PMID IN (3, 97, -5) THEN 1 END), "
    "'required': 3},"
    "{'check': 'term_hits', 'measured': count(CASE WHEN Title ILIKE '%the%' THEN 1 END), "
    "'required': 10}]) AS r FROM {citations})"
)
def quality_report(spark, sf_dir):
    return quality.quality_report(
        citations(spark, sf_dir).drop("src"),
        min_records=100,
        known_ids=(3, 97, -5),
        term=TERM,
        min_term_hits=10,
    )


@query("SELECT Year, count(*) AS records FROM {citations} WHERE Year > 2020 GROUP BY Year")
def out_of_range_years(spark, sf_dir):
    return quality.out_of_range_years(written(spark, sf_dir), 2020)


@query("SELECT 'bigint' AS pmid_type, 'int' AS year_type")
def column_types(spark, sf_dir):
    return quality.column_types(written(spark, sf_dir))


_ALTERED_TITLE = (
    "CASE PMID % 4 WHEN 0 THEN Title || ' changed' WHEN 1 THEN ' <i>' || Title || '</i> ' "
    "ELSE Title END"
)
_ALTERED_DOI = "CASE WHEN PMID % 3 = 0 THEN NULL ELSE DOI END"
_COMPARED = (
    "SELECT PMID, Pub_Types <> 'de' AND PMID <> 0 AS found, "
    "Pub_Types <> 'de' AND PMID <> 0 AND (trim(Title) = trim(altered) "
    "OR trim(Title) = trim(regexp_replace(altered, '<[^>]+>', '', 'g'))) AS title_match, "
    "Pub_Types <> 'de' AND PMID <> 0 AND DOI = coalesce(altered_doi, '') AS doi_match "
    f"FROM (SELECT *, {_ALTERED_TITLE} AS altered, {_ALTERED_DOI} AS altered_doi "
    "FROM {citations})"
)


def _altered(rows: DataFrame) -> DataFrame:
    return rows.filter("Pub_Types <> 'de'").select(
        "PMID", F.expr(_ALTERED_TITLE).alias("Title"), F.expr(_ALTERED_DOI).alias("DOI")
    )


@query(f"SELECT *, title_match AND doi_match AS matched FROM ({_COMPARED})")
def snapshot_compare(spark, sf_dir):
    rows = citations(spark, sf_dir)
    return compare.compare_records(rows, _altered(rows))


@query(
    "SELECT count(*) AS compared, count(CASE WHEN title_match AND doi_match THEN 1 END) AS "
    "matches, count(CASE WHEN title_match AND doi_match THEN 1 END) / count(*) AS ratio, "
    "count(CASE WHEN title_match AND doi_match THEN 1 END) / count(*) >= 2 / 3 AS passed FROM "
    f"({_COMPARED}) WHERE PMID IN (SELECT PMID FROM {{citations}} WHERE length(Title) > 20 "
    "ORDER BY md5(CAST(PMID AS STRING) || '5'), PMID LIMIT 50)"
)
def snapshot_sample(spark, sf_dir):
    rows = citations(spark, sf_dir)
    return compare.match_summary(compare.compare_sample(rows, _altered(rows), 50, "5"))


# --- helpers ------------------------------------------------------------------


@query(
    "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, "
    "regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages"
)
def strip_page_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        strip_tags(F.col("html")).alias("plain"),
    )


@query(
    "SELECT DISTINCT unnest(regexp_extract_all(html, '[a-z]+\\.example\\.[a-z]+')) AS name "
    "FROM pages"
)
def listing_names(spark, sf_dir):
    return names_in_listing(table(spark, sf_dir, "pages"), r"[a-z]+\.example\.[a-z]+", "html")


@query("SELECT PMID, substring(trim(Title), 1, 60) AS preview FROM {citations}")
def title_previews(spark, sf_dir):
    return citations(spark, sf_dir).select(
        "PMID", title_preview(F.trim("Title")).alias("preview")
    )


@query(
    "SELECT o_orderkey, TRY_CAST(right(o_orderpriority, 3) AS INT) AS tolerant, "
    "CASE WHEN regexp_full_match(left(o_orderpriority, 1), '[0-9]+') "
    "THEN CAST(left(o_orderpriority, 1) AS INT) END AS digits, "
    "CAST(year(o_orderdate) AS INT) AS lead, trim(o_orderpriority, '1-W') AS stripped, "
    "'n' || CAST(o_orderkey AS STRING) AS stem, "
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(year(o_orderdate) AS STRING) || '-' || "
    "CASE WHEN o_orderkey % 2 = 0 THEN CAST(month(o_orderdate) AS STRING) ELSE '01' END "
    "|| '-7' END AS date FROM orders"
)
def scalar_helpers(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        tolerant_int(F.right("o_orderpriority", F.lit(3))).alias("tolerant"),
        digits_only(F.left("o_orderpriority", F.lit(1))).alias("digits"),
        leading_year(F.concat(year, F.lit(" Dec"))).alias("lead"),
        strip_chars(F.col("o_orderpriority"), "1-W").alias("stripped"),
        output_stem(F.concat(F.lit("n"), "o_orderkey", F.lit(".xml.gz"))).alias("stem"),
        date_text(
            F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(year),
            F.when(F.col("o_orderkey") % 2 == 0, F.month("o_orderdate").cast("string")),
            F.lit("7"),
        ).alias("date"),
    )


# --- inputs -------------------------------------------------------------------


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.format_string("bulk25n%04d.xml.gz", F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(name.alias("name"))


@query(
    "SELECT printf('bulk25n%04d.xml.gz', doc_id) AS name FROM documents d "
    "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
)
def pending_files(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select(
        F.format_string("bulk25n%04d.parquet", F.col("doc_id")).alias("name")
    )
    return pending_inputs(_inputs(spark, sf_dir), done)


@query("SELECT printf('bulk25n%04d.xml.gz', doc_id) AS name FROM documents WHERE doc_id >= 120")
def start_from(spark, sf_dir):
    return from_number(_inputs(spark, sf_dir), 120)


@query(
    "WITH o AS (SELECT count(*) AS done, CAST(epoch(TIMESTAMP '2030-01-01 00:00:00') AS BIGINT) "
    "- CAST(floor(epoch(min(o_orderdate))) AS BIGINT) AS elapsed FROM orders), "
    "i AS (SELECT count(*) AS n FROM lineitem), f AS (SELECT count(*) AS n FROM labels) "
    "SELECT elapsed, i.n - done AS doc_rem, done AS doc_don, f.n AS failure, "
    "round(1.0 / (CAST(elapsed AS DOUBLE) / done / 60), 2) AS doc_min, "
    "round((i.n - done) * (CAST(elapsed AS DOUBLE) / done / 60) / 60, 2) AS est_hrs FROM o, i, f"
)
def build_progress(spark, sf_dir):
    return aggregates.build_progress(
        table(spark, sf_dir, "lineitem").select("l_orderkey"),
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("modified")),
        table(spark, sf_dir, "labels").select("doc_id"),
        now=F.expr("TIMESTAMP '2030-01-01 00:00:00'"),
    )


# --- layouts ------------------------------------------------------------------


@query(
    "SELECT PMID, Title, Year, Journal FROM {citations} WHERE PMID % 2 = 0 OR coalesce(Year, 0) < 1980 "
    "UNION ALL SELECT PMID, 'new ' || Title, Year, Journal FROM {citations} "
    "WHERE PMID % 2 = 1 AND Year >= 1980"
)
def replace_years(spark, sf_dir):
    """A second write replaces the years it holds and leaves the others as they are."""
    rows, root = citations(spark, sf_dir), scratch(spark, "table")
    write_table(rows, root)
    changed = rows.filter("Year >= 1980").withColumn(
        "Title", F.expr("CASE WHEN PMID % 2 = 1 THEN 'new ' || Title ELSE Title END")
    )
    write_table(changed, root, mode="years")
    return read_table(spark, root).select("PMID", "Title", "Year", "Journal")


@query("SELECT PMID, Title, CAST(Year + 1 AS INT) AS Year FROM {citations}")
def replace_moved_years(spark, sf_dir):
    """Records whose year has changed are written to their new years and leave the old ones."""
    rows, root = citations(spark, sf_dir), scratch(spark, "table")
    write_table(rows, root)
    write_table(rows.withColumn("Year", F.expr("CAST(Year + 1 AS INT)")), root, mode="years")
    return read_table(spark, root).select("PMID", "Title", "Year")


@query(
    "SELECT CAST(coalesce(Year, 0) AS INT) AS pub_year, "
    "count(*) * CASE WHEN Year >= 1980 THEN 1 ELSE 2 END AS records FROM {citations} GROUP BY Year"
)
def kept_year_totals(spark, sf_dir):
    """Counts by year after a write, an append and a replacement, without reading a record."""
    rows, root = citations(spark, sf_dir), scratch(spark, "table")
    write_table(rows, root)
    write_table(rows.withColumn("PMID", F.col("PMID") + 10**9), root, mode="append")
    write_table(rows.filter("Year >= 1980"), root, mode="years")
    return year_totals(spark, root)


@query("SELECT PMID, Title, Year FROM {citations} WHERE PMID IN (3, 97, 150, 388) OR PMID = 1000000007")
def indexed_lookup(spark, sf_dir):
    """Ids by the index: of an indexed write, a replaced year and a write not indexed yet."""
    rows, root = citations(spark, sf_dir), scratch(spark, "table")
    write_table(rows, root)
    index_ids(spark, root)
    write_table(rows.filter("Year >= 1980"), root, mode="years")
    return find_ids(spark, root, [3, 97, 150, 388, 10**9 + 7]).select("PMID", "Title", "Year")


@query(
    "SELECT doc_id % 5 AS PMID, true AS found, true AS titled, "
    "left(Title, 60) AS preview, Year FROM (SELECT PMID AS doc_id, Title, Year, row_number() OVER (PARTITION BY PMID % 5 "
    "ORDER BY Year DESC NULLS LAST, Title DESC) AS place FROM {citations}) WHERE place = 1"
)
def known_repeated_ids(spark, sf_dir):
    """Ids held many times: title and year come from one and the same record."""
    rows = citations(spark, sf_dir).withColumn("PMID", F.expr("PMID % 5"))
    expected = spark.range(5).select(F.col("id").alias("PMID"))
    return quality.known_records(rows, expected)


@query(
    "SELECT 'all' AS part, count(*) AS total_records, CAST(NULL AS VARCHAR) AS baseline_date, "
    "count(DISTINCT coalesce(Year, 0)) AS years FROM {citations} "
    "UNION ALL SELECT 'none', 0, NULL, 0"
)
def metadata_of_nothing(spark, sf_dir):
    """The metadata documents of the whole table and of an empty one, without a date."""
    found = None
    for part, rows in (("all", citations(spark, sf_dir)), ("none", citations(spark, sf_dir).limit(0))):
        root = scratch(spark, "table")
        write_table(rows, root)
        row = publish_metadata(spark, root, scratch(spark, "metadata"), part).select(
            F.lit(part).alias("part"),
            "total_records",
            "baseline_date",
            F.size("year_distribution").cast("bigint").alias("years"),
        )
        found = row if found is None else found.unionByName(row)
    return found


@query("SELECT PMID, Title, Year, CAST(coalesce(Year, 0) AS INT) AS pub_year FROM {citations}")
def year_layout(spark, sf_dir):
    """A table whose directories are named ``year`` beside a stored ``Year`` with nulls."""
    path = scratch(spark, "years")
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        citations(spark, sf_dir).withColumn("year", F.coalesce("Year", F.lit(0))).hint(
            "rebalance", "year"
        ).write.partitionBy("year").parquet(path)
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)
    return read_year_layout(spark, path).select("PMID", "Title", "Year", "pub_year")
