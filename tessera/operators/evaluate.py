"""Evaluation over prediction tables and metric logs.

A prediction table has one row per predicted position: ``label int`` (``-100`` = ignored) and
``logits array<float|double>``; a metric log has ``(run, step, name/tag, value)``. Reductions are
two-level aggregates (partial aggregation map-side), windows are partitioned by run and tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import IGNORE_INDEX, col_
from .prefix import StopRule, early_stop_scan, running_agg


def _as_double(arr) -> Column:
    return F.transform(col_(arr), lambda v: v.cast("double"))


def argmax(logits) -> Column:
    """H1: index of the largest score; ties go to the lowest index."""
    x = _as_double(logits)
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def logsumexp(logits) -> Column:
    """Log-sum-exp in double, one pass with a running max (numerically stable, O(n))."""
    x = _as_double(logits)
    init = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, v):
        m2 = F.greatest(acc["m"], v)
        return F.struct(m2.alias("m"), (acc["s"] * F.exp(acc["m"] - m2) + F.exp(v - m2)).alias("s"))

    return F.aggregate(x, init, step, lambda acc: acc["m"] + F.log(acc["s"]))


def nll(logits, label, ignore: int = IGNORE_INDEX) -> Column:
    """H2: per-row cross-entropy ``logsumexp(x) - x[label]``; null for ignored rows. A label
    that is no class fails the job."""
    x = _as_double(logits)
    lab = col_(label)
    outside = F.raise_error(F.concat(F.lit("label out of range: "), lab.cast("string"))).cast("double")
    picked = F.when((lab >= 0) & (lab < F.size(x)), F.get(x, lab)).otherwise(outside)
    return F.when(lab != ignore, logsumexp(logits) - picked)


def masked_accuracy(df: DataFrame, logits: str = "logits", label: str = "label",
                    ignore: int = IGNORE_INDEX) -> DataFrame:
    """H3: global (micro) accuracy over non-ignored positions."""
    hit = (argmax(logits) == F.col(label)).cast("double")
    return (df.filter(F.col(label) != ignore)
            .agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_tokens")))


def batch_losses(df: DataFrame, batch: str = "batch_id", logits: str = "logits",
                 label: str = "label", ignore: int = IGNORE_INDEX) -> DataFrame:
    """Per-batch mean cross-entropy (null when a batch has no supervised position)."""
    return df.groupBy(batch).agg(F.avg(nll(logits, label, ignore)).alias("batch_loss"),
                                 F.count(F.when(F.col(label) != ignore, 1)).alias("n_tokens"))


def epoch_loss(df: DataFrame, batch: str = "batch_id", logits: str = "logits", label: str = "label",
               ignore: int = IGNORE_INDEX) -> DataFrame:
    """H4: mean of batch means (unweighted); batches without supervision are skipped, as a
    running mean skips NaN values."""
    per = batch_losses(df, batch, logits, label, ignore)
    return per.agg(F.avg("batch_loss").alias("epoch_loss"),
                   F.count("batch_loss").alias("n_batches"),
                   F.count(F.when(F.col("batch_loss").isNull(), 1)).alias("n_empty_batches"))


def total_loss(ce, aux=None, weight: float = 0.05) -> Column:
    """H5: cross-entropy plus the weighted auxiliary (balance) loss when there is one."""
    if aux is None:
        return col_(ce)
    return col_(ce) + F.coalesce(col_(aux), F.lit(0.0)) * weight


def running_best(df: DataFrame, value: str, order: str, by: list[str], mode: str = "max",
                 out: str = "best_so_far", include=None, keep: list[str] | None = None) -> DataFrame:
    """H6: best value so far per group (``include`` drops e.g. sanity-check rows first). A prefix scan with
    carries, so one hot run is not a single task; ``keep`` names the columns to carry along (default: all)."""
    src = df if include is None else df.filter(include)
    return running_agg(src, value, [order], by, "max" if mode == "max" else "min", out, keep=keep)


def merge_metrics(train: DataFrame, test: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """H7: union of two metric tables; on equal names the second (test) wins, also with a
    null value."""
    t = train.select(F.col(name).alias("_n"), F.col(value).alias("_a"))
    s = test.select(F.col(name).alias("_n"), F.col(value).alias("_b"), F.lit(True).alias("_has"))
    return (t.join(s, "_n", "full")
            .select(F.col("_n").alias(name), F.when(F.col("_has"), F.col("_b")).otherwise(F.col("_a")).alias(value)))


def metric_value(df: DataFrame, metric: str, name: str = "name", value: str = "value") -> DataFrame:
    """H8: one-row lookup; the job fails when the name is missing."""
    hit = df.filter(F.col(name) == metric).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    return hit.select(F.lit(metric).alias(name),
                      F.when(F.col("_n") == 0, F.raise_error(F.lit(f"Metric value not found: {metric}")))
                      .otherwise(F.col("_v")).alias(value))


def non_finite(col) -> Column:
    """NaN or infinite."""
    c = col_(col).cast("double")
    return F.isnan(c) | (F.abs(c) == float("inf"))


GROUP_LIMIT_MAX = 1000  # Spark applies row_number() <= k map-side up to this k


def best_checkpoints(df: DataFrame, k: int, metric: str, order: str, by: list[str],
                     mode: str = "min", out: str = "rank") -> DataFrame:
    """H9: the best ``k`` checks per run (``k=-1`` keeps all, ``k=0`` none); NaN ranks last but for
    nulls, and on equal values the earlier check wins. The order is the same for every ``k``.

    Small ``k``: ``row_number() <= k``, limited map-side. ``k=-1`` or a large ``k``: ranks are a running
    count in ``(run, value, check)`` order (a prefix scan, which splits a hot run)."""
    v = F.col(metric).cast("double")
    worst = float("inf") if mode == "min" else float("-inf")
    key = F.when(v.isNull() | F.isnan(v), F.lit(worst)).otherwise(v)
    missing = v.isNull()
    if 0 <= k <= GROUP_LIMIT_MAX:
        ordered = key.asc() if mode == "min" else key.desc()
        ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(missing, ordered, F.col(order).asc())))
        return ranked.filter(F.col(out) <= k)
    asc_key = key if mode == "min" else -key
    ranked = running_agg(df.withColumn("_key", asc_key).withColumn("_null", missing), F.lit(1), ["_null", "_key", order], by, "sum", out)
    res = ranked.withColumn(out, F.col(out).cast("int")).drop("_key", "_null")
    return res if k < 0 else res.filter(F.col(out) <= k)


def early_stop(df: DataFrame, value: str, order: str, by: list[str], patience: int = 3, min_delta: float = 0.0, mode: str = "min",
               check_finite: bool = True, stopping_threshold=None, divergence_threshold=None, partitions: int | None = None) -> DataFrame:
    """One row per run with ``stop_at`` (the check that stops it, null when it never stops), ``reason`` and ``best`` (the best
    value held when stopping, null when none improved).

    The accepted best depends on earlier decisions when ``min_delta`` is not zero. A block of a run's checks is summed
    up as a map from the state that comes in to the state that goes out (see ``prefix.StopSummary``); the maps are folded along
    the run, so a run holding all rows spreads over tasks. A null value counts as NaN: it stops the run with ``check_finite`` and never
    improves without; infinities stop with ``check_finite`` and are values like others without."""
    rule = StopRule(patience, min_delta, mode, check_finite, stopping_threshold, divergence_threshold)
    return early_stop_scan(df, value, order, by, rule, partitions)


def early_stop_points(df: DataFrame, value: str, order: str, by: list[str], patience: int = 3,
                      mode: str = "min", check_finite: bool = True, stopping_threshold=None,
                      divergence_threshold=None) -> DataFrame:
    """H10 with ``min_delta=0``."""
    return early_stop(df, value, order, by, patience, 0.0, mode, check_finite, stopping_threshold, divergence_threshold)


def early_stop_delta(df: DataFrame, value: str, order: str, by: list[str], patience: int = 3,
                     min_delta: float = 0.0, mode: str = "min", check_finite: bool = True,
                     stopping_threshold=None, divergence_threshold=None) -> DataFrame:
    """H10 for any ``min_delta``."""
    return early_stop(df, value, order, by, patience, min_delta, mode, check_finite, stopping_threshold, divergence_threshold)


def best_trial(df: DataFrame, metric: str, params: list[str], mode: str = "max") -> DataFrame:
    """Parameters of the best trial (``max_by``/``min_by``, one partial aggregate)."""
    pick = F.max_by if mode == "max" else F.min_by
    best = F.max(metric) if mode == "max" else F.min(metric)
    return df.agg(pick(F.struct(*params), F.col(metric)).alias("_p"), best.alias(metric)) \
             .select(*[F.col(f"_p.{p}").alias(p) for p in params], metric)
