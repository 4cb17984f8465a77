"""A standing build: files are added to the table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from citelake.operators.extract_xml import extract_xml
from citelake.plans.sinks import mend, remove_files, write_table
from citelake.schema import LINEAGE_COLUMN, MANIFEST_SCHEMA, XML_SUFFIX
from citelake.sources.inputs import pending_inputs
from citelake.sources.manifest import read_manifest, record_finished
from citelake.sources.xml_files import RECORD_END, split_chunks

_FACTS = T.StructType(MANIFEST_SCHEMA.fields[:3])


def arriving_chunks(
    spark: SparkSession, source: str, glob: str = f"*{XML_SUFFIX}", files_per_batch: int = 1000
) -> DataFrame:
    """Chunks of new files, each with its file's name, size and time."""
    return (
        spark.readStream.option("lineSep", RECORD_END)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(source)
        .select(
            "value",
            F.col("_metadata.file_name").alias(LINEAGE_COLUMN),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def follow(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    *,
    glob: str = f"*{XML_SUFFIX}",
    doi_scope: str = "own",
    files_per_batch: int = 1000,
    until_idle: bool = True,
) -> StreamingQuery:
    """Append each batch of new files to ``root``; ``checkpoint`` remembers which were seen.

    A batch that was written but not recorded before a failure is offered again, and only as the
    first batch after a start. In that one, files that the manifest lists as finished are passed over,
    and what the table holds of others is replaced. The names, sizes and times of a batch's files, at
    most ``files_per_batch``, are noted while their records are written, and reach the driver. Neither
    the folder nor the table is gone through for a batch.
    """
    may_repeat = True

    def add(batch: DataFrame, _: int) -> None:
        nonlocal may_repeat
        session = batch.sparkSession
        if may_repeat:
            mend(session, root)
            done = read_manifest(session, root)
            names = batch.select(F.col(LINEAGE_COLUMN).alias("name")).distinct()
            waiting = pending_inputs(names, done).collect()
            may_repeat = False
            if not waiting:
                return
            waiting = session.createDataFrame(waiting, "name string")
            remove_files(session, root, waiting)
            waiting = waiting.withColumnRenamed("name", LINEAGE_COLUMN)
            batch = batch.join(F.broadcast(waiting), LINEAGE_COLUMN, "left_semi")
        facts = F.struct(F.col(LINEAGE_COLUMN).alias("name"), "bytes", "modified")
        seen = Observation()
        chunks = batch.observe(seen, F.to_json(F.collect_set(facts)).alias("files"))
        written = write_table(
            extract_xml(split_chunks(chunks), doi_scope), root, mode="append", mended=True
        )
        noted = session.createDataFrame([(seen.get["files"],)], "files string")
        inputs = noted.select(F.inline(F.from_json("files", T.ArrayType(_FACTS))))
        record_finished(inputs, root, written)

    writer = (
        arriving_chunks(spark, source, glob, files_per_batch)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
    )
    if until_idle:
        writer = writer.trigger(availableNow=True)
    return writer.start()
