"""Sharding by jump consistent hashing, with DataFrame functions only.

A key's shard is found by jumping forward through ever larger shard counts with a 64-bit linear
congruential generator seeded by the key. There is no ring table: the key and the shard count decide,
shards are of equal expected size, and one more shard takes keys only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered_within

#: The generator's multiplier in two 32-bit halves (2862933555777941757); its increment is 1.
MULTIPLIER = (0x27BB2EE6, 0x87B0B0FD)


def _jump(key: str, shards: int) -> str:
    """SQL: struct(own, grown) of the shard among ``shards`` and among ``shards + 1``.

    The 64-bit key is kept as two halves and multiplied in 16-bit parts, so nothing overflows
    (products stay under 2^50). A step draws the next key, then the next jump; the last jump below a
    count is the shard for it. Jumps grow by one at least, so ``shards + 1`` steps suffice.
    """
    ah, al = MULTIPLIER
    a0, a1 = al & 0xFFFF, al >> 16
    low = f"(s.lo * {a0}L + shiftleft((s.lo * {a1}L) & 65535L, 16) + 1L)"
    high = (f"(shiftright({low}, 32) + shiftright(s.lo * {a1}L, 16) + s.hi * {a0}L + shiftleft((s.hi * {a1}L) & 65535L, 16)"
            f" + s.lo * {ah & 0xFFFF}L + shiftleft((s.lo * {ah >> 16}L) & 65535L, 16))")
    drawn = f"named_struct('hi', {high} & 4294967295L, 'lo', {low} & 4294967295L)"
    step = (f"transform(array({drawn}), d -> named_struct("
            "'j', cast(floor((s.j + 1) * (2147483648D / cast(shiftright(d.hi, 1) + 1L as double))) as bigint), "
            f"'hi', d.hi, 'lo', d.lo, 'own', if(s.j < {shards}L, s.j, s.own), 'grown', s.j))[0]")
    begin = f"named_struct('j', 0L, 'hi', shiftrightunsigned({key}, 32), 'lo', {key} & 4294967295L, 'own', 0L, 'grown', 0L)"
    return f"aggregate(sequence(0, {shards}), {begin}, (s, i) -> if(s.j > {shards}L, s, {step}), s -> named_struct('own', s.own, 'grown', s.grown))"


def jump_shard(key: str, shards: int) -> Column:
    """struct(own, grown): the shard of the long column ``key`` (null: 0) among ``shards`` and ``shards + 1``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    return F.expr(f"transform(array(coalesce(`{key}`, 0L)), k -> {_jump('k', shards)})[0]")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``shard``, ``grown_shard`` (with one more shard) and ``slot``.

    ``slot`` numbers the rows of a shard gapless from 0 in id order, also when one shard holds
    most rows. A key that isn't an integer is hashed to one; null keys share the shard of key 0. Rows with equal keys go
    to one shard and get slots of their own. An empty table gives no rows. Returned columns: doc_id, size (UTF-8 bytes plus 1, null text: 1),
    text_crc32 (null text: that of no bytes), shard, grown_shard, slot; others are ignored whatever their names.
    """
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    key = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col)))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = rows.withColumn("s", jump_shard("key", shards))
    dealt = dealt.select("doc_id", "size", "text_crc32", F.col("s.own").cast("int").alias("shard"), F.col("s.grown").cast("int").alias("grown_shard"))
    return numbered_within(dealt, "shard", [F.col("doc_id")], "slot")
