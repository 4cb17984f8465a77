"""Time the headline queries; prints one JSON line.

Data comes from $BENCH_SF_DIR, cores from $BENCH_CPUS. Inputs in the three older forms and the
citation table are written first; that is not part of the figures, except where building is what is
timed. Each figure is the better of two runs after a first one that warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from citelake.functions.text import contains_term  # noqa: E402
from citelake.operators import aggregates, compare, quality, sampling  # noqa: E402
from citelake.operators.extract_json import extract_json  # noqa: E402
from citelake.operators.extract_xml import extract_xml  # noqa: E402
from citelake.operators.record_json import to_documents  # noqa: E402
from citelake.operators.search import in_years, search, subject_has, title_has  # noqa: E402
from citelake.plans.build import build_from_xml, reprocess_documents  # noqa: E402
from citelake.plans.sinks import write_documents, write_table  # noqa: E402
from citelake.session import build_session  # noqa: E402
from citelake.sources.tables import read_documents, read_table  # noqa: E402
from citelake.sources.xml_files import read_xml_records  # noqa: E402
from workload.shapes import citations, plain_records, write_xml_files  # noqa: E402

RUNS = 3


def discard(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "citelake-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.driver.memory": "8g",
        },
    )
    folder = tempfile.mkdtemp(prefix="citelake-bench-")
    files, documents, root, built = (
        f"{folder}/{name}" for name in ("files", "documents", "table", "built")
    )
    records = plain_records(spark, sf_dir)
    write_xml_files(records, files, per_file=500)
    xml = read_xml_records(spark, files, glob="*.gz")
    write_documents(to_documents(xml), documents)
    write_table(citations(spark, sf_dir), root)
    table, older = read_table(spark, root), read_documents(spark, documents)
    count = table.count()
    altered = table.withColumn("Title", F.concat(F.lit("<i>"), "Title", F.lit("</i>")))

    work = {
        "title_search": lambda: table.filter(title_has("tion")).count(),
        "abstract_search": lambda: table.filter(contains_term(F.col("Abstract"), "xyzzy")).count(),
        "title_or_abstract_search": lambda: search(table, text="tion", limit=100).collect(),
        "year_equals": lambda: in_years(table, 2003, 2003).count(),
        "year_equals_unpruned": lambda: table.filter(F.col("Year") == 2003).count(),
        "subject_since_year": lambda: in_years(table, 2000).filter(subject_has("src1")).count(),
        "title_search_parsing_documents": lambda: extract_json(older)
        .filter(title_has("tion"))
        .count(),
        "point_lookup": lambda: search(table, ids=[97, 150]).collect(),
        "year_histogram": lambda: aggregates.year_counts(table).collect(),
        "file_year_stats": lambda: aggregates.file_year_counts(table).collect(),
        "build_metadata": lambda: aggregates.build_metadata(table, "bench").collect(),
        "quality_report": lambda: quality.quality_report(
            table, min_records=1, known_ids=[3, 97], term="tion", min_term_hits=1
        ).collect(),
        "repeatable_sample": lambda: sampling.repeatable_sample(table, 100).select("PMID").collect(),
        "snapshot_compare": lambda: discard(compare.compare_records(table, altered)),
        "extract_xml": lambda: discard(extract_xml(xml)),
        "extract_json": lambda: discard(extract_json(older)),
        "xml_to_documents": lambda: discard(to_documents(xml)),
        "build_from_xml": lambda: build_from_xml(spark, files, built, glob="*.gz"),
        "reprocess_documents": lambda: reprocess_documents(spark, documents, built),
    }
    seconds = {}
    for name, run in work.items():
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 4)
    rates = {
        name: round(count / seconds[name])
        for name in (
            "extract_xml",
            "extract_json",
            "xml_to_documents",
            "build_from_xml",
            "reprocess_documents",
        )
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "records": count,
                "records_per_second": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
