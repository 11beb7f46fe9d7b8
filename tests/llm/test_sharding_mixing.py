import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
from tessera.llm import mixing, sharding  # noqa: E402


def jump(key, shards):
    """The published loop, in Python integers."""
    b, j, key = -1, 0, (key or 0) % (1 << 64)
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_published_loop_and_slots_are_gapless(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 12345, *range(100, 160)]
    docs = spark.createDataFrame([(k, "x") for k in keys], "doc_id long, text string")
    for n in (1, 2, 16, 40):
        for r in sharding.shard(docs, n).collect():
            assert (r.shard, r.grown_shard) == (jump(r.doc_id, n), jump(r.doc_id, n + 1))


def test_shard_hard_rows(spark):
    src = X.rows()
    got = sharding.shard(X.table(spark), 4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), jump(r[0], 4)) for r in src)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == want
    for s in range(4):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    assert sharding.shard(X.empty(spark), 4).count() == 0


def test_hot_key_and_string_keys(spark):
    docs = spark.range(900).select(F.when(F.col("id") < 400, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.shard(docs, 3).collect()
    assert len({r.shard for r in got if r.doc_id == "hot"}) == 1
    assert sorted(r.slot for r in got if r.shard == got[0].shard) == list(range(sum(r.shard == got[0].shard for r in got)))


def test_mix_rates_counts_and_edge_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"),
                                    F.when(F.col("id") < 2000, F.lit("big")).when(F.col("id") < 2900, F.lit("mid")).otherwise(F.lit(None)).alias("source"), F.lit(1).alias("_copy"))
    got = mixing.mix(docs, weights={"big": 1.0, "mid": 1.0}).groupBy("source").count().collect()
    counts = {r.source: r["count"] for r in got}
    assert None not in counts  # not named: no weight
    assert abs(counts["big"] - 1500) < 150 and abs(counts["mid"] - 1500) < 150
    again = mixing.mix(docs.repartition(7), weights={"big": 1.0, "mid": 1.0})
    one = mixing.mix(docs, weights={"big": 1.0, "mid": 1.0})
    assert sorted(map(tuple, again.select("doc_id", "_copy").collect())) == sorted(map(tuple, one.select("doc_id", "_copy").collect()))
    hard = mixing.mix(X.table(spark), total=3.0)
    assert set(X.empty(spark).columns) <= set(hard.columns) and hard.count() > 0
    assert mixing.mix(X.empty(spark)).count() == 0
    assert mixing.mix(docs, weights={}).count() == 0


def test_poisson_is_the_inverse_distribution_function(spark):
    means = [0.0, 0.2, 1.0, 7.5, 1234.5]
    for mean in means:
        rows = spark.range(4000).select(mixing.poisson(F.lit(mean), F.lit(3), F.col("id")).alias("n")).agg(F.avg("n"), F.var_pop("n")).first()
        assert abs(rows[0] - mean) <= 4 * (mean / 4000) ** 0.5 + 1e-9
        assert abs(rows[1] - mean) <= 0.12 * mean + 1e-9


def test_mix_is_native(spark):
    for df in (mixing.mix(X.table(spark)), sharding.shard(X.table(spark), 4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
