"""Running a load: one result row with counts, errors recorded, everything published or nothing."""

from __future__ import annotations

import traceback
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..sources.store import Store

RESULT_SCHEMA = "job string, status string, rows_by_table map<string,bigint>, message string"
# number, severity and state are those of a raised user error
ERROR_SCHEMA = (
    "job string, error_type string, error_number int, severity int, state int, message string, location string, line int"
)
USER_ERROR = (50000, 16, 1)


def publish_counted(
    store: Store, *, append: dict[str, DataFrame] | None = None, replace: dict[str, DataFrame] | None = None
) -> dict[str, int]:
    """Publish frames and return their row counts, counted while they are written."""
    watches: dict[str, Observation] = {}

    def watched(frames: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
        out = {}
        for table, frame in (frames or {}).items():
            watches[table] = Observation(f"rows of {table}")
            out[table] = frame.observe(watches[table], F.count(F.lit(1)).alias("n"))
        return out

    store.publish(append=watched(append), replace=watched(replace))
    return {table: int(w.get["n"]) for table, w in watches.items()}


def run_job(spark: SparkSession, store: Store, job: str, body: Callable[[], dict[str, int]], run_ts: Column) -> DataFrame:
    """Run a load. A failure is added to the error table and raised again; nothing else is published."""
    try:
        counts = body()
    except Exception as error:
        last = traceback.extract_tb(error.__traceback__)[-1]
        row = [(job, type(error).__name__, *USER_ERROR, str(error), last.name, last.lineno)]
        record = spark.createDataFrame(row, ERROR_SCHEMA).withColumn("error_time", run_ts)
        store.publish(append={"errors": record})
        raise
    return spark.createDataFrame([(job, "SUCCESS", counts, None)], RESULT_SCHEMA)
