"""Run-log summaries over scalar events ``(run, tag, step, wall_time, value)`` (K1-K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import DEFAULT_SUFFIXES, format_duration


def epoch_micros(ts) -> F.Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (session zone UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def run_span(df: DataFrame, run: str = "run", wall_time: str = "wall_time",
             suffixes=DEFAULT_SUFFIXES) -> DataFrame:
    """K1 (+K2): first and last event time over all scalar tags, duration and its text."""
    span = df.groupBy(run).agg(F.min(wall_time).alias("start_time"), F.max(wall_time).alias("end_time"))
    dur = (epoch_micros("end_time") - epoch_micros("start_time")) / 1e6
    return (span.withColumn("duration_s", dur)
            .withColumn("duration_text", format_duration("duration_s", suffixes)))


def latest_metrics(df: DataFrame, run: str = "run", tag: str = "tag", step: str = "step",
                   value: str = "value") -> DataFrame:
    """K3: the last logged value of every tag of every run (one partial aggregate)."""
    return df.groupBy(run, tag).agg(F.max_by(value, step).alias(value), F.max(step).alias(step))
