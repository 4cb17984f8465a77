"""The build jobs: bulk XML or older documents in, citation table and metadata out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.operators.aggregates import metadata_of_totals
from citelake.operators.extract_json import extract_json
from citelake.operators.extract_xml import extract_xml
from citelake.operators.record_json import to_documents, to_trees
from citelake.plans.sinks import (
    mend,
    remove_files,
    write_documents,
    write_metadata,
    write_rejects,
    write_table,
    write_trees,
)
from citelake.schema import XML_SUFFIX
from citelake.sources.contents import year_totals
from citelake.sources.damaged import damaged_files, unreadable
from citelake.sources.inputs import from_number, input_files
from citelake.sources.manifest import (
    read_manifest,
    record_damaged,
    record_finished,
    waiting_inputs,
)
from citelake.sources.tables import read_documents, read_table
from citelake.sources.xml_files import read_xml_records

METADATA_SCHEMA = (
    "total_records bigint, year_distribution map<string, bigint>, schema_version string, "
    "source string, baseline_date string"
)


def build_from_xml(
    spark: SparkSession,
    source: str,
    root: str,
    *,
    glob: str = f"*{XML_SUFFIX}",
    start_from: int | None = None,
    spread: int | None = None,
    doi_scope: str = "own",
    mode: str = "overwrite",
    set_aside: bool = True,
) -> DataFrame:
    """Extract every record of the files under ``source`` and write the table to ``root``.

    A file that cannot be read costs no other: with ``set_aside`` it is left out, and the manifest has a
    line with its error.
    """
    inputs = input_files(spark, source, glob)
    inputs = inputs if start_from is None else from_number(inputs, start_from)
    inputs = spark.createDataFrame(inputs.collect(), inputs.schema)  # as they are before the build

    def write(paths: str | list[str]) -> str:
        records = read_xml_records(spark, paths, glob, start_from, spread)
        return write_table(extract_xml(records, doi_scope), root, mode)

    _write_readable(spark, inputs, source, write, root, set_aside)
    return read_table(spark, root)


def _write_readable(
    spark: SparkSession,
    inputs: DataFrame,
    paths: str | list[str],
    write: Callable[[str | list[str]], str],
    root: str,
    set_aside: bool,
) -> None:
    """Write the inputs; where that fails over a file's content, write those that can be read."""
    schema = "path string, error string"
    damaged: dict[str, str] = {}
    try:
        batch = write(paths)
    except (Py4JJavaError, PySparkException) as error:
        if not set_aside or not unreadable(error):
            raise
        listed = [row.path for row in inputs.select("path").collect()]
        damaged = damaged_files(spark, listed)
        readable = [path for path in listed if path not in damaged]
        if not damaged or not readable:
            raise
        batch = write(readable)
    found = spark.createDataFrame(list(damaged.items()), schema)
    record_finished(inputs.join(F.broadcast(found), "path", "left_anti"), root, batch)
    if damaged:
        record_damaged(inputs.join(F.broadcast(found), "path"), root)


def resume_from_xml(
    spark: SparkSession,
    source: str,
    root: str,
    *,
    glob: str = f"*{XML_SUFFIX}",
    start_from: int | None = None,
    spread: int | None = None,
    exclude: Sequence[str] = (),
    doi_scope: str = "own",
    set_aside: bool = True,
) -> DataFrame:
    """Add the files under ``source`` that the manifest of ``root`` does not list as finished.

    The manifest is written after the rows. A file that was interrupted half-way is therefore done
    again, and what the table held of it is replaced. What the table holds is told by its contents
    (``sources.contents``), not by its records. ``exclude`` names files to leave out; they stay
    unfinished. A damaged file is set aside as in ``build_from_xml`` and is not tried again until another
    stands in its place. Only file names reach the driver, which lists the files in any
    case.
    """
    mend(spark, root)
    inputs = input_files(spark, source, glob)
    if start_from is not None:
        inputs = from_number(inputs, start_from)
    if exclude:
        inputs = inputs.filter(~F.col("name").isin(*exclude))
    repeated = inputs.groupBy("name").count().filter("count > 1").select("name").take(1)
    if repeated:
        # Finished files are known by name, so a second file of a name would be passed over.
        raise ValueError(f"several inputs are named {repeated[0].name}")
    waiting = waiting_inputs(inputs, read_manifest(spark, root))
    waiting = spark.createDataFrame(waiting.collect(), waiting.schema)  # file names, sizes and times
    paths = [row.path for row in waiting.select("path").collect()]
    if paths:
        remove_files(spark, root, waiting)

        def write(some: str | list[str]) -> str:
            records = read_xml_records(spark, some, glob, spread=spread)
            return write_table(extract_xml(records, doi_scope), root, mode="append", mended=True)

        _write_readable(spark, waiting, paths, write, root, set_aside)
    return read_table(spark, root)


def reprocess_documents(
    spark: SparkSession, source: str, root: str, *, mode: str = "overwrite"
) -> DataFrame:
    """Extract the columns of an older ``(PMID, JSON)`` table and write the table to ``root``."""
    write_table(extract_json(read_documents(spark, source)), root, mode)
    return read_table(spark, root)


def build_documents(spark: SparkSession, source: str, path: str, rejects: str | None = None) -> None:
    """Bulk XML to the ``(PMID, JSON)`` form; records that cannot be used go to ``rejects``, by default
    beside ``path``."""
    documents = to_documents(read_xml_records(spark, source))
    write_documents(documents, path)
    write_rejects(documents, rejects or f"{path.rstrip('/')}_rejects")


def build_trees(spark: SparkSession, source: str, path: str, rejects: str | None = None) -> None:
    """Bulk XML to the ``(pmid, json, src)`` form; rejects as in ``build_documents``."""
    trees = to_trees(read_xml_records(spark, source))
    write_trees(trees, path)
    write_rejects(trees, rejects or f"{path.rstrip('/')}_rejects")


def publish_metadata(
    spark: SparkSession, root: str, path: str, source: str, baseline_date: str | None = None
) -> DataFrame:
    """Write the metadata of the table under ``root`` and return it.

    The figures are those kept by its writes (``sources.contents``); no record is read.
    """
    mend(spark, root)
    write_metadata(metadata_of_totals(year_totals(spark, root), source, baseline_date), path)
    return read_metadata(spark, path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The metadata row; parts that the document leaves out are null, but for an empty distribution."""
    found = spark.read.schema(METADATA_SCHEMA).json(path)
    none = F.create_map().cast("map<string, bigint>")
    return found.withColumn("year_distribution", F.coalesce("year_distribution", none))
