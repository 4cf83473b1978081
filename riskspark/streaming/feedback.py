"""Feedback events (P23, S7) as a Structured Streaming job.

The reference logs each POSTed feedback with defaults (message ``Message
vide``, dimensions ``{}``, positive ``true``) at INFO, or at ERROR when the
feedback is negative. Here the same rule is a pure DataFrame transform that
runs on a batch or a stream; the stream appends to a file sink with a
checkpoint, so a restart after a lost executor or driver neither loses nor
duplicates records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.sources.fixtures import feedback_from_events

# Defaults of a feedback request and the two log levels.
DEFAULT_MESSAGE = "Message vide"
LEVEL_POSITIVE = "INFO"
LEVEL_NEGATIVE = "ERROR"

#: The columns of the event files that a feedback request is made of.
EVENTS = "event_id long, ts timestamp_ntz, event_type string, props string"


def feedback_records(requests: DataFrame, null_is_missing: bool = True) -> DataFrame:
    """Apply the defaults and derive the level. Streaming-safe (row-local).

    ``null_is_missing``: a null field is one that the request lacks. Parsed bodies have their
    defaults already; there a null message is a message of null.
    """
    default = F.coalesce if null_is_missing else (lambda c, _: c)
    positive = F.coalesce(F.col("is_positive"), F.lit(True))
    keep = [c for c in requests.columns if c not in ("message", "custom_dimensions", "is_positive")]
    return requests.select(
        *keep,
        default(F.col("message"), F.lit(DEFAULT_MESSAGE)).alias("message"),
        default(F.col("custom_dimensions"), F.create_map().cast("map<string,string>")).alias("custom_dimensions"),
        positive.alias("is_positive"),
        F.when(positive, F.lit(LEVEL_POSITIVE)).otherwise(F.lit(LEVEL_NEGATIVE)).alias("level"),
    )


def _field(v: Column, name: str) -> Column:
    """A field of a parsed body as a variant: SQL null if the key is missing."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def _truth(x: Column) -> Column:
    """Whether a JSON value counts as true: not null, false, 0, or empty."""
    kind = F.schema_of_variant(x)
    text = F.try_variant_get(x, "$", "string")
    return (F.when(kind == "VOID", False).when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
            .when(kind == "STRING", text != "").when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~F.to_json(x).isin("[]", "{}"))
            .otherwise(F.try_variant_get(x, "$", "double") != 0))


def _parsed(body: Column) -> Column:
    """The body as a variant; null if it is no JSON object."""
    v = F.try_parse_json(body)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def parse_requests(raw: DataFrame, body: str = "body", extra: str = "") -> DataFrame:
    """JSON request bodies (one per row) -> ``message``, ``custom_dimensions``, ``is_positive``.

    A default takes the place of a missing key only: a null ``is_positive`` is not positive,
    a null message stays null. Bodies that are no JSON object are left out; they are the rows
    of ``rejected_requests``. ``extra`` adds fields carried in the body (DDL, e.g.
    ``"event_id long"``).
    """
    keep = [c for c in raw.columns if c != body]
    v = F.col("_v")
    fields = [_field(v, n) for n in ("message", "custom_dimensions", "is_positive")]
    more = [F.try_variant_get(v, f"$.{n}", t).alias(n) for n, t in (x.strip().split(None, 1) for x in extra.split(",") if x.strip())]
    return (raw.select(*keep, _parsed(F.col(body)).alias("_v")).where("_v is not null").select(
        *keep, *more,
        F.when(fields[0].isNull(), F.lit(DEFAULT_MESSAGE)).otherwise(F.try_variant_get(fields[0], "$", "string")).alias("message"),
        F.when(fields[1].isNull(), F.create_map().cast("map<string,string>"))
        .otherwise(F.try_variant_get(fields[1], "$", "map<string,string>")).alias("custom_dimensions"),
        F.when(fields[2].isNull(), F.lit(True)).otherwise(_truth(fields[2])).alias("is_positive")))


def rejected_requests(raw: DataFrame, body: str = "body") -> DataFrame:
    """The rows whose body is no JSON object."""
    return raw.where(_parsed(F.col(body)).isNull())


def start_feedback_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint_path: str,
                          *, pattern: str = "*.parquet", available_now: bool = True,
                          processing_time: str | None = None, schema: str = EVENTS) -> StreamingQuery:
    """Event files in ``source_dir`` (matching ``pattern``) -> feedback records -> parquet sink.

    Append mode with a checkpoint: the sink commits each micro-batch once.
    ``available_now`` processes what is there and stops (restartable: a new
    run picks up only files it has not seen); otherwise the query keeps
    running with ``processing_time`` triggers.
    """
    base = source_dir.rstrip("/")
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
              .option("maxFilesPerTrigger", 64).parquet(base))
    records = feedback_records(feedback_from_events(stream))
    writer = (records.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start(sink_path)


def run_feedback_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint_path: str,
                        pattern: str = "*.parquet") -> DataFrame:
    """Run S7 until the available input is consumed; return the sink as a batch DataFrame."""
    q = start_feedback_stream(spark, source_dir, sink_path, checkpoint_path, pattern=pattern,
                              available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink_path)


def outcomes(raw: DataFrame, body: str = "body", extra: str = "") -> DataFrame:
    """Every request body as one row, parsed once: ``outcome`` is ``accepted`` (with the fields of ``feedback_records``) or
    ``rejected`` (no JSON object: its ``body``, the fields null)."""
    fields = [x.strip().split(None, 1) for x in extra.split(",") if x.strip()]
    parsed = raw.withColumn("_v", _parsed(F.col(body)))
    good = F.col("_v").isNotNull()
    v = F.col("_v")
    message, dimensions, positive = (_field(v, n) for n in ("message", "custom_dimensions", "is_positive"))
    sure = F.when(positive.isNull(), F.lit(True)).otherwise(_truth(positive))
    values = {
        **{n: F.try_variant_get(v, f"$.{n}", t) for n, t in fields},
        "message": F.when(message.isNull(), F.lit(DEFAULT_MESSAGE)).otherwise(F.try_variant_get(message, "$", "string")),
        "custom_dimensions": F.when(dimensions.isNull(), F.create_map().cast("map<string,string>")).otherwise(F.try_variant_get(dimensions, "$", "map<string,string>")),
        "is_positive": sure,
        "level": F.when(F.coalesce(sure, F.lit(True)), F.lit(LEVEL_POSITIVE)).otherwise(F.lit(LEVEL_NEGATIVE)),
    }
    keep = [c for c in raw.columns if c != body and c not in values]
    return parsed.select(*keep, F.when(good, "accepted").otherwise("rejected").alias("outcome"), F.when(~good, F.col(body)).alias("body"),
                         *(F.when(good, x).alias(n) for n, x in values.items()))


def start_outcome_stream(spark: SparkSession, bodies_dir: str, sink_path: str, checkpoint_path: str,
                         *, extra: str = "", available_now: bool = True, files_per_batch: int = 64) -> StreamingQuery:
    """S7 with both outputs from one stream: accepted records and rejected bodies, each body parsed once.

    A micro-batch writes its own folder, ``sink_path/batch=<id>``, with a folder for each outcome in it, by one job that
    replaces what the folder holds. The checkpoint fixes which files a batch id stands for, so a batch that is run again
    after a failure, whether it had written nothing, a part or all, leaves every row once in exactly one of the outputs.
    """
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(bodies_dir).withColumnRenamed("value", "body")

    def write(batch: DataFrame, batch_id: int) -> None:
        outcomes(batch, extra=extra).write.partitionBy("outcome").mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={batch_id}")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_outcomes(spark: SparkSession, sink_path: str, extra: str = "") -> tuple[DataFrame, DataFrame]:
    """The accepted records and the rejected bodies that ``start_outcome_stream`` has written."""
    more = [x.strip() for x in extra.split(",") if x.strip()]
    fields = [*more, "message string", "custom_dimensions map<string,string>", "is_positive boolean", "level string"]
    rows = spark.read.schema(", ".join(["body string", *fields, "batch long", "outcome string"])).parquet(sink_path)
    names = [f.split()[0] for f in fields]
    return rows.where("outcome = 'accepted'").select(*names), rows.where("outcome = 'rejected'").select("body")


def start_request_stream(spark: SparkSession, bodies_dir: str, sink_path: str, checkpoint_path: str,
                         *, extra: str = "", available_now: bool = True) -> StreamingQuery:
    """S7 from raw request bodies: text files with one JSON body per line.

    A key missing from a body takes its default; bodies that are no JSON object go to
    ``start_rejected_stream``, not here.
    """
    raw = spark.readStream.option("maxFilesPerTrigger", 64).text(bodies_dir).withColumnRenamed("value", "body")
    records = feedback_records(parse_requests(raw, extra=extra), null_is_missing=False)
    writer = (records.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_path)


def start_rejected_stream(spark: SparkSession, bodies_dir: str, sink_path: str, checkpoint_path: str,
                          *, available_now: bool = True) -> StreamingQuery:
    """The bodies that ``start_request_stream`` leaves out, to a sink of their own."""
    raw = spark.readStream.option("maxFilesPerTrigger", 64).text(bodies_dir).withColumnRenamed("value", "body")
    writer = (rejected_requests(raw).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_path)


def request_bodies(requests: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Feedback requests -> one JSON body per row; null fields are left out of the body.

    ``carry`` names extra columns to put in the body (e.g. an event id).
    """
    fields = [*(carry or []), "message", "custom_dimensions", "is_positive"]
    return requests.select(F.to_json(F.struct(*fields)).alias("body"))
