"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each source has a target rate: how often one of its documents should appear so that the sources'
sizes reach their weights. A document's copies are drawn from a Poisson distribution with that
mean, by inverting its distribution function at a uniform number hashed from (seed, doc_id). Copies
are exploded and shuffled by a hash of (seed, doc_id, copy). No draw depends on partitions or retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

BROADCAST_SOURCES = 20_000  # rates of so many sources at most are broadcast; more are joined by shuffle
MEAN_AT_ONCE = 500  # larger means are sums of equal parts, so that exp(-mean) stays in range


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts (null parts are written as \\N): 52 bits."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def poisson(mean: Column, *parts: Column) -> Column:
    """Poisson count with ``mean`` by inversion of the uniform hashed from ``parts`` and the part's number."""
    chunks = F.greatest(F.lit(1), F.ceil(mean / MEAN_AT_ONCE).cast("int"))

    def one(j: Column) -> Column:
        lam = mean / chunks
        # beyond this many terms the distribution function is 1 in double precision
        terms = F.ceil(lam + 12 * F.sqrt(lam) + 25).cast("int")
        start = F.struct(F.exp(-lam).alias("p"), F.exp(-lam).alias("c"), F.lit(0).alias("n"), uniform(*parts, j).alias("u"))

        def step(s: Column, i: Column) -> Column:
            p = s["p"] * lam / i
            return F.when(s["c"] >= s["u"], s).otherwise(F.struct(p.alias("p"), (s["c"] + p).alias("c"), i.alias("n"), s["u"].alias("u")))

        return F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda s: s["n"])

    return F.aggregate(F.sequence(F.lit(1), chunks), F.lit(0), lambda n, j: n + one(j))


def target_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict | None = None,
                 temperature: float = 0.7, total: float = 1.0) -> DataFrame:
    """(source, rate): mean copies of a document of each source, rounded to six decimals.

    A source's size is its UTF-8 bytes plus one byte a document. ``weights`` gives target shares by
    source (those not named get none); without it a share is in proportion to size ** temperature.
    The mix is expected to have ``total`` times the size of all sources. A null source is a source.
    """
    size = (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("long")
    per = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        per = per.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        listed = [p for s, w in weights.items() for p in (F.lit(s), F.lit(float(w)))]
        per = per.withColumn("weight", F.coalesce(F.create_map(*listed)[F.col("source")], F.lit(0.0)) if listed else F.lit(0.0))
    weight, whole = per.agg(F.sum("weight"), F.sum("size")).first()
    if not weight:
        return per.select("source", F.lit(0.0).alias("rate"))
    return per.select("source", F.round(F.col("weight") / F.lit(float(weight)) * F.lit(whole * total) / F.col("size"), 6).alias("rate"))


def mix(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: dict | None = None, temperature: float = 0.7, total: float = 1.0) -> DataFrame:
    """All columns of ``docs``, repeated by Poisson counts and globally shuffled, with _rate, _copy (from 0) and _mix_key.

    Rows with equal ids draw equal counts (a null id is an id of its own). Null or empty texts count one byte. An empty table gives
    none. Clashing columns named _rate, _copy or _mix_key are replaced.
    """
    rows = docs.drop("_rate", "_copy", "_mix_key")
    rates = target_rates(rows, source_col, text_col, weights, temperature, total)
    source, n = free_names(rows, "_source", "_n")
    rates = rates.select(F.col("source").alias(source), F.col("rate").alias("_rate"))
    few = rows.agg(F.approx_count_distinct(source_col)).first()[0] <= BROADCAST_SOURCES // 2
    named = rows.join(F.broadcast(rates) if few else rates, F.col(source_col).eqNullSafe(F.col(source))).drop(source)
    count = poisson(F.col("_rate"), F.lit(seed), F.col(id_col))
    drawn = named.withColumn(n, count).where(F.col(n) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col(n) - 1))).drop(n)
    key = F.md5(F.concat_ws("|", F.lit("place"), F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("\\N")), F.col("_copy").cast("string")))
    return drawn.withColumn("_mix_key", key).repartition(F.col("_mix_key")).sortWithinPartitions("_mix_key")
