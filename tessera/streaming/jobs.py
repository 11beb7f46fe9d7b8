"""Streaming jobs (an extension of the batch operators, same column logic).

* ``pretrain_rows_stream``: new documents -> training rows with an existing tokenizer. Each
  micro-batch is stateless (narrow encode, no shuffle), so the job scales with the input rate
  and restarts from its checkpoint after a failure.
* ``run_span_stream`` / ``latest_metrics_stream``: run-log summaries as stateful aggregations. With
  ``window`` rows are grouped by event-time windows too: a window's state is dropped, and rows older
  than the watermark with it, once the watermark has passed. Without it the state is one row per run (or run and tag) for
  as long as the query lives, and no late row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bpe import BpeModel
from ..operators.examples import pretrain_examples
from ..operators.runlog import epoch_micros
from ..session import ensure_checkpoint_dir


def read_corpus_stream(spark, path: str, field: str = "text", key: str = "doc_id",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming A1: JSON lines arriving as files; a bad line fails the query, a line without
    ``field`` raises. Lines carry their own ``key`` (a stream has no global line order)."""
    reader = spark.readStream.schema(f"`{key}` long, `{field}` string").option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    return df.withColumn(field, F.when(F.col(field).isNull(), F.raise_error(F.lit(f"line without '{field}'")))
                         .otherwise(F.col(field)))


def pretrain_rows_stream(docs: DataFrame, model: BpeModel, max_len: int = 512, key: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """Streaming E4: the same plan as the batch builder, applied per micro-batch."""
    return pretrain_examples(docs, model, max_len, key, text)


def run_span_stream(events: DataFrame, run: str = "run", wall_time: str = "wall_time",
                    delay: str = "1 hour", window: str | None = None) -> DataFrame:
    """Streaming K1: first/last event time per run (and time window), updated as scalars arrive."""
    ts = F.col(wall_time).cast("timestamp")
    by = [run] if window is None else [F.window("_ts", window).alias("window"), run]
    return (events.withColumn("_ts", ts).withWatermark("_ts", delay)
            .groupBy(*by).agg(F.min("_ts").alias("start_time"), F.max("_ts").alias("end_time"))
            .withColumn("duration_s", (epoch_micros("end_time") - epoch_micros("start_time")) / 1e6))


def latest_metrics_stream(events: DataFrame, run: str = "run", tag: str = "tag", step: str = "step",
                          value: str = "value", wall_time: str = "wall_time", delay: str = "1 hour",
                          window: str | None = None) -> DataFrame:
    """Streaming K3: the value at the highest step of every (run, tag) (and time window)."""
    ts = F.col(wall_time).cast("timestamp")
    by = [run, tag] if window is None else [F.window("_ts", window).alias("window"), run, tag]
    return (events.withColumn("_ts", ts).withWatermark("_ts", delay)
            .groupBy(*by).agg(F.max_by(value, step).alias(value), F.max(step).alias(step)))


def start(df: DataFrame, name: str, sink: str = "memory", path: str | None = None, mode: str = "append",
          available_now: bool = True, checkpoint: str | None = None):
    """Start a query that resumes from ``checkpoint``, a folder that stays the same over restarts.

    By default it is ``streams/<name>`` in the folder that spark.checkpoint.dir names (not in the application's own
    part of it, which a restarted driver would not find)."""
    spark = df.sparkSession
    own = ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or own
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or f"{base.rstrip('/')}/streams/{name}"))
    if available_now:
        w = w.trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").start()
    return w.format(sink).start(path)
