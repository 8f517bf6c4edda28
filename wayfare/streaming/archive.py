"""The archiver: messages to partitioned files, and the stream's side of de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from ..functions.columns import local_date
from ..operators.observations import normalize
from ..schemas import ARCHIVED_POSITIONS, RAW_POSITION

# Fixed values of the flush rule: Spark triggers by time and bounds a batch by rows.
FLUSH_SECONDS = 600
FLUSH_ROWS = 50_000
PIPELINE_VERSION = "v1"

MESSAGE = T.StructType([*RAW_POSITION.fields, T.StructField("city", T.StringType()), T.StructField("fetch_time", T.StringType()), T.StructField("produce_time", T.StringType())])


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The topic from its beginning; the checkpoint of the query keeps the place. A batch begins
    when FLUSH_ROWS have come or FLUSH_SECONDS are over, whichever is first, if the query is
    triggered more often than that (archive's every_s)."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    bounds = {"minOffsetsPerTrigger": FLUSH_ROWS, "maxTriggerDelay": f"{FLUSH_SECONDS}s", "maxOffsetsPerTrigger": FLUSH_ROWS}
    return source.options(**bounds).load().select("value", "partition", "offset", "timestamp")


def to_messages(df: DataFrame, key: str = "PlateNumb") -> DataFrame:
    """Rows as messages keyed by plate, so that a vehicle's stay in order. What is not known
    is left out of the JSON."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint, "kafka.linger.ms": "50", "kafka.batch.size": "1048576", "kafka.compression.type": "zstd"}
    return to_messages(df).writeStream.format("kafka").options(**options)


def decode(messages: DataFrame) -> DataFrame:
    """Messages (value, partition, offset, timestamp) with the record in m; a message that is
    no JSON object of the schema has a null m."""
    body = F.col("value").cast("string")
    m = F.from_json(body, MESSAGE, {"mode": "PERMISSIVE"})
    ok = F.try_parse_json(body).isNotNull() & body.rlike(r"^\s*\{")
    return messages.withColumns({"body": body, "m": F.when(ok, m)})


def records(decoded: DataFrame) -> DataFrame:
    """Canonical positions with the message's coordinates and the operating day of its fetch."""
    good = decoded.where("m is not null").select("m.*", F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").cast("long").alias("kafka_offset"), F.col("timestamp").cast("string").alias("consume_time"))
    dated = good.withColumns({"data_date": F.coalesce(local_date(F.try_to_timestamp(F.col("fetch_time"))), F.lit("unknown"))})
    return normalize(dated, {"pipeline_version": PIPELINE_VERSION}, ARCHIVED_POSITIONS).withColumn("dt", F.col("data_date"))


def archive(messages: DataFrame, path: str, dead_letters: str, checkpoint: str, every_s: int = FLUSH_SECONDS) -> DataStreamWriter:
    """Write each batch's records by city and day and its bad messages aside. Batches are
    written whole before their offsets are; a batch written twice is told by its messages'
    coordinates, which compaction removes."""

    def flush(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        try:
            records(decoded).write.mode("append").option("compression", "zstd").partitionBy("city", "dt").parquet(path)
            decoded.where("m is null").select("body", "partition", "offset").withColumn("batch_id", F.lit(batch_id)).write.mode("append").json(dead_letters)
        finally:
            decoded.unpersist()

    return messages.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(processingTime=f"{every_s} seconds")


def dedup_stream(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages once each while copies come within delay of the event time; state is dropped
    after that."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["partition", "offset"])


class ProgressLog(StreamingQueryListener):
    """Counters of running queries: rows and batches so far, and the last batch's rate and
    event. spark.streams.addListener(ProgressLog()) starts it."""

    def __init__(self) -> None:
        self.queries: dict[str, dict[str, object]] = {}

    def _of(self, run_id: object) -> dict[str, object]:
        return self.queries.setdefault(str(run_id), {"rows": 0, "batches": 0, "rate": 0.0, "state": "started", "error": None})

    def onQueryStarted(self, event) -> None:
        self._of(event.runId)

    def onQueryProgress(self, event) -> None:
        counters = self._of(event.progress.runId)
        counters["rows"] += event.progress.numInputRows
        counters["batches"] += 1
        counters["rate"] = event.progress.processedRowsPerSecond
        counters["state"] = "running"

    def onQueryIdle(self, event) -> None:
        self._of(event.runId)["state"] = "idle"

    def onQueryTerminated(self, event) -> None:
        self._of(event.runId).update(state="ended", error=event.exception)
