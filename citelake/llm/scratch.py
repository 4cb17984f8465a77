"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, the warehouse, which is shared as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """Write ``rows`` as Parquet to the shared folder and read them back.

    What follows starts from files that outlive any executor, and is not worked out twice. The
    driver's garbage is collected, since that is what frees the shuffle files of finished steps.
    """
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    back = spark.read.schema(rows.schema).parquet(path)
    _paths[back] = path
    return back


def forget(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` from which nothing will be read any more."""
    for rows in tables:
        path = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(_paths.pop(rows))
        path.getFileSystem(rows.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Free the shuffle files of finished steps before a large one begins: a job's plan, and with it its files,
    is held until the listeners have heard of its end."""
    context = spark.sparkContext
    try:
        context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    except Py4JError:  # they are slow: the files stay for another step
        pass
    context._jvm.System.gc()
