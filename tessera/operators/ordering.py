"""Dense 0-based positions in a global order without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one task. Instead:
range-partition on the order key (Spark samples the key to pick bounds), sort inside each
partition, write the result to the reliable checkpoint directory (so both passes, and any
recomputation after an executor loss, see the same partitions), count rows per partition
(one number per partition reaches the driver), and add each partition's prefix-sum offset to the
in-partition row index. Two narrow passes plus one range shuffle; no data-sized state anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


RANGE_BYTES = 128 << 20  # planned size of one range


def _input_bytes(df: DataFrame) -> int:
    """Planned bytes of the tables a plan reads (of those whose size is known)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 56)  # unknown sizes are given as the largest long


def range_count(df: DataFrame) -> int:
    """Ranges for ordering ``df``: from the size of the tables read, at least the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _input_bytes(df) // RANGE_BYTES)


def dense_index(df: DataFrame, order_cols: list, out: str = "pos", partitions: int | None = None):
    """Return ``(df + out long, total_rows)``; ``order_cols`` must form a unique key.

    The number of ranges follows from the size of the tables read (at least the session's
    shuffle partitions); the offsets are a small joined table, one row per range."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or range_count(df)
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    counts = ranged.groupBy(F.spark_partition_id().alias("_di_pid")).count().collect()  # one row per range
    rows, acc = [], 0
    for pid, number in sorted(map(tuple, counts)):
        rows.append((pid, acc))
        acc += number
    offsets = spark.createDataFrame(rows, "_di_pid int, _di_base long")
    local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    placed = ranged.withColumn("_di_pid", F.spark_partition_id()).withColumn("_di_local", local)
    joined = placed.join(F.broadcast(offsets), "_di_pid")
    return joined.withColumn(out, F.col("_di_base") + F.col("_di_local")).drop("_di_pid", "_di_base", "_di_local"), acc


def hash_key(seed, *parts) -> "F.Column":
    """Partition-independent pseudo-random order key: md5 of ``seed:part:...``."""
    pieces = [F.lit(str(seed))]
    for p in parts:
        pieces += [F.lit(":"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    return F.md5(F.concat(*pieces))


def hash_uniform(seed, *parts) -> "F.Column":
    """Uniform double in [0, 1) from the first 52 bits of the md5 key (partition-independent)."""
    h = F.conv(F.substring(hash_key(seed, *parts), 1, 13), 16, 10).cast("double")
    return h / float(1 << 52)

