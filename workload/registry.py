"""Each query beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.shapes import CITATIONS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``{citations}`` in the SQL stands for the view."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # As build_session does; the session may be another's.
            spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql.replace("{citations}", f"({CITATIONS}) AS citations")
        return function

    return register
