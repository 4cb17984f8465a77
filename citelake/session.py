"""Session settings the jobs are written for, and a scratch folder all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits the crowded recent years when the table is written and merges the
# sparse early ones; the advisory size is what one write task should hold.
# The last two save time only: the JDK maps case faster than ICU does, which search is bound by, and
# noting where in Python each of many small columns was made would double the time to plan.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.icu.caseMappings.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, name: str = "citelake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in a folder that all executors share.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/citelake/{label}-{uuid.uuid4().hex}"
