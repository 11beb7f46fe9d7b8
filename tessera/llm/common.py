"""Helpers shared by the operators of this subpackage (no operator logic)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as compressed Parquet in the shared checkpoint folder, read back; and its path, for ``discard``."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ``written`` that no plan reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores where ``df`` has such a column (names differ whatever their case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in global order, written once: column ``_p`` is the piece, ``_i`` the place in it.

    Choosing the ranges reads the rows before they are dealt out, so they are checkpointed first, lest their work be
    done twice. Ties of the whole order key are placed arbitrarily but once: the checkpoint keeps the choice.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    tied = cut(df.select("*", *[c.alias(k) for c, k in zip(order, keys)]).withColumn("_tie", F.rand(17)))
    cols = [F.col(k) for k in keys] + [F.col("_tie")]
    rows = cut(tied.repartitionByRange(*cols).sortWithinPartitions(*cols).drop(*keys, "_tie"))
    return rows.withColumn("_p", F.spark_partition_id()).withColumn(
        "_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))


def _offsets(per_piece: DataFrame, by: list[str], value: str) -> DataFrame:
    """Sum of ``value`` over earlier pieces. One row per piece and group: bounded by the number
    of partitions, never by the rows."""
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(*by, "_p", F.coalesce(F.sum(value).over(before), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based place of each row in the global order, without a one-task window.

    A range partitioning by the order (ties spread at random), one count per partition, and a
    broadcast of those counts (one row per partition, so bounded by the partition count).
    """
    rows = _placed(df, order)
    offsets = _offsets(rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")), [], "_n")
    return rows.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_before") + F.col("_i")).drop("_p", "_i", "_before")


def numbered_within(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based gapless place of each row within ``group`` (few groups, each of
    any size): rows are range-partitioned by (group, order), so a large group spans many tasks."""
    rows = _placed(df, [F.col(group), *order])
    per = rows.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(group).alias("_g"), F.col("_p").alias("_q"), "_first",
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = rows.join(F.broadcast(per), (F.col("_q") == F.col("_p")) & F.col("_g").eqNullSafe(F.col(group)))
    return joined.withColumn(name, F.col("_before") + F.col("_i") - F.col("_first")).drop(
        "_p", "_i", "_q", "_g", "_first", "_before")


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier rows in the global order."""
    rows = _placed(df, order)
    offsets = _offsets(rows.groupBy("_p").agg(F.sum(value).alias("_n")), [], "_n")
    inside = Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(F.broadcast(offsets), "_p")
            .withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_p", "_i", "_before", "_in"))
