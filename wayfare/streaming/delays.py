"""Arrivals of a stream against the published baseline: which steps took unusually long."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.arrivals import trip_steps
from ..operators.baseline import MIN_N, RUNG, expected
from ..operators.publish import current_version


class Published:
    """A published table as of now: its version is looked up each time, and the table is read
    anew where the pointer has moved. A batch goes on with the version it began with; swap()
    keeps the one before for that."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.version: str | None = None
        self.table: DataFrame | None = None

    def current(self) -> tuple[str | None, DataFrame | None]:
        version = current_version(self.spark, self.path)
        if version != self.version:
            self.version, self.table = version, self.spark.read.parquet(f"{self.path}/{version}")
        return self.version, self.table


def judged(arrivals: DataFrame, stops: DataFrame, ladder: DataFrame | None, version: str | None, min_n: int = MIN_N) -> DataFrame:
    """arrivals (as arrivals_stream gives them) with what the ladder has for the step, whether
    it was slow, and the version that says so. Without a ladder nothing is known or slow."""
    steps = trip_steps(arrivals, stops)
    if ladder is None:
        unknown = {c: F.lit(None).cast("string" if c == "level" else "long") for c in RUNG}
        return steps.withColumns({**unknown, "slow": F.lit(False), "baseline_version": F.lit(None).cast("string")})
    return expected(steps, ladder, min_n).withColumn("baseline_version", F.lit(version))


def watch(arrivals: DataFrame, stops: DataFrame, ladder_path: str, out: str, checkpoint: str, min_n: int = MIN_N) -> DataStreamWriter:
    """Judge each batch of a stream of arrivals by the ladder (operators.baseline.ladder) that is
    published at ladder_path when the batch begins. A batch that is run again replaces what it
    wrote, so every arrival is judged once. Read the result with read_judged."""
    published = Published(arrivals.sparkSession, ladder_path)

    def judge(batch: DataFrame, batch_id: int) -> None:
        version, table = published.current()
        judged(batch, stops, table, version, min_n).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return arrivals.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)


def read_judged(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")
