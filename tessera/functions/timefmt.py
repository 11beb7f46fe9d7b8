"""K2: human-readable durations, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# The reference's unit suffixes (day, hour, minute, second), in that order.
DEFAULT_SUFFIXES = ("天", "小时", "分钟", "秒")


def format_duration(seconds, suffixes=DEFAULT_SUFFIXES) -> Column:
    """Whole seconds split into days/hours/minutes/seconds; zero parts are left out, seconds
    are shown when everything else is zero. ``suffixes`` = (day, hour, minute, second)."""
    total = col_(seconds).cast("double").cast("long")  # int(): truncation
    days = F.floor(total / 86400).cast("long")
    rem = total - days * 86400
    hours = F.floor(rem / 3600).cast("long")
    rem2 = rem - hours * 3600
    minutes = F.floor(rem2 / 60).cast("long")
    secs = rem2 - minutes * 60
    d, h, m, s = suffixes

    def part(v, suffix):
        return F.when(v != 0, F.concat(v.cast("string"), F.lit(suffix))).otherwise(F.lit(""))

    head = F.concat(part(days, d), part(hours, h), part(minutes, m))
    tail = F.when((secs != 0) | (head == ""), F.concat(secs.cast("string"), F.lit(s))).otherwise(F.lit(""))
    return F.when(total.isNull(), None).otherwise(F.concat(head, tail))
