"""The log of pipeline runs, and reports on a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, started_at timestamp, completed_at timestamp, status string, inserted long, updated long, unchanged long, errors long, duration_seconds double, error string"

#: Measures of a report, which the driver holds, at most.
MAX_MEASURES = 1000


def start_run(spark: SparkSession, runs: DataFrame | None, run_id: str, now: Column) -> DataFrame:
    """The log with one more running run."""
    row = spark.createDataFrame([(run_id, None, None, "running", None, None, None, None, None, None)], RUNS).withColumn("started_at", now)
    return row if runs is None else runs.unionByName(row)


def complete_run(runs: DataFrame, run_id: str, stats: DataFrame, now: Column, error: str | None = None) -> DataFrame:
    """The log with one run completed (or failed, with an error); its duration follows from its start."""
    s = stats.select(*[F.col(c).alias("_" + c) for c in ("inserted", "updated", "unchanged", "errors")], F.lit(run_id).alias("_id"))
    mine = F.col("_id").isNotNull()
    out = runs.join(s, F.col("run_id") == F.col("_id"), "left")
    done = {c: F.when(mine, F.col("_" + c)).otherwise(F.col(c)) for c in ("inserted", "updated", "unchanged", "errors")}
    done |= {"completed_at": F.when(mine, now).otherwise(F.col("completed_at")), "status": F.when(mine, F.lit("failed" if error else "completed")).otherwise(F.col("status")), "error": F.when(mine, F.lit(error)).otherwise(F.col("error"))}
    done["duration_seconds"] = F.when(mine, (now.cast("double") - F.col("started_at").cast("double"))).otherwise(F.col("duration_seconds"))
    return out.withColumns(done).select(*runs.columns)


def text_report(measures: DataFrame, title: str) -> str:
    """A report (measure, value) as lines of text; one beyond MAX_MEASURES is refused, not cut."""
    rows = measures.orderBy("measure").limit(MAX_MEASURES + 1).collect()
    if len(rows) > MAX_MEASURES:
        raise ValueError(f"the report has more than {MAX_MEASURES} measures")
    lines = [f"{r['measure']}: {r['value']}" for r in rows]
    return "\n".join([title, "=" * len(title), *lines])
