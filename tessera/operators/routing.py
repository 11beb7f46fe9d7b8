"""Expert-routing reports over a long gate table ``(token_id, expert_id, gate[, noise_gate])``
(J1-J5). Groups are per token (bounded by the expert count) or per expert (partial aggregation
first, so a hot expert is pre-reduced map-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import hash_uniform

BALANCE_EPS = 1e-8  # fixed value: added to the importance before the log


def noisy_gate(df: DataFrame, std: float = 1.0, seed: int = 0, gate: str = "gate",
               noise_gate: str | None = "noise_gate", token: str = "token_id",
               expert: str = "expert_id", out: str = "logit") -> DataFrame:
    """Gate + std * N(0, 1) + noise gate; the normal draw is hash-seeded Box-Muller."""
    val = F.col(gate).cast("double")
    if noise_gate is not None and noise_gate in df.columns:
        val = val + F.col(noise_gate).cast("double")
    if std:
        u1 = F.greatest(hash_uniform(seed, token, expert, F.lit(1)), F.lit(1e-300))
        u2 = hash_uniform(seed, token, expert, F.lit(2))
        z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)
        val = val + z * float(std)
    return df.withColumn(out, val)


def route(df: DataFrame, k: int = 4, logit: str = "logit", token: str = "token_id",
          expert: str = "expert_id", by: tuple = ()) -> DataFrame:
    """Top-k experts per token (ties: lower expert id) and a softmax over those only."""
    part = [*by, token]
    ranked = df.withColumn("rank", F.row_number().over(
        Window.partitionBy(*part).orderBy(F.col(logit).desc(), F.col(expert).asc())))
    top = ranked.filter(F.col("rank") <= k)
    wt = Window.partitionBy(*part)
    m = F.max(logit).over(wt)
    e = F.exp(F.col(logit) - m)
    return top.withColumn("weight", e / F.sum(e).over(wt))


def dispatch(routed: DataFrame, expert: str = "expert_id", by: tuple = ()) -> DataFrame:
    """Tokens and total weight per expert."""
    return routed.groupBy(*by, expert).agg(F.count(F.lit(1)).alias("n_tokens"),
                                           F.sum("weight").alias("weight_sum"))


def combine(routed: DataFrame, out: str = "expert_out", token: str = "token_id", by: tuple = ()) -> DataFrame:
    """Weighted sum of the chosen experts' outputs per token."""
    return routed.groupBy(*by, token).agg(F.sum(F.col("weight") * F.col(out)).alias("combined"))


def balance_loss(routed: DataFrame, num_experts: int, n_tokens: DataFrame, expert: str = "expert_id",
                 by: tuple = (), layer: str | None = None) -> DataFrame:
    """KL(uniform || importance) with importance = mean routing weight per expert over all
    tokens (zeros included). Experts nobody chose contribute ``u * (ln u - ln eps)`` without
    materialising them. ``n_tokens`` holds ``(*by[, layer], n)``; the result is summed over
    layers when ``layer`` is given."""
    keys = [*by] + ([layer] if layer else [])
    u = 1.0 / num_experts
    per = routed.groupBy(*keys, expert).agg(F.sum("weight").alias("_w"))
    if keys:
        per = per.join(n_tokens, keys)
    else:  # one global count: a scalar subquery, not a join
        per = per.withColumn("n", n_tokens.select("n").scalar())
    term = F.lit(u) * (F.lit(math.log(u)) - F.log(F.col("_w") / F.col("n") + BALANCE_EPS))
    per_layer = per.groupBy(*keys).agg(F.sum(term).alias("_kl"), F.count(F.lit(1)).alias("_present"))
    absent = (F.lit(num_experts) - F.col("_present")) * (u * (math.log(u) - math.log(BALANCE_EPS)))
    per_layer = per_layer.withColumn("balance_loss", F.col("_kl") + absent)
    if layer:
        return per_layer.groupBy(*by).agg(F.sum("balance_loss").alias("balance_loss"))
    return per_layer.select(*by, "balance_loss")
