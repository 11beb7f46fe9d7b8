"""Properties over the driver's tables: lossless pre-tokens, exact splits, shapes, labels,
independence from partitioning, dense ids equal to a global row_number."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tessera.functions.text import pretokens
from tessera.operators import batches as G
from tessera.operators import bpe as C
from tessera.operators import examples as X
from tessera.operators.ordering import dense_index
from tessera.session import table


def test_pretokens_are_lossless(spark):
    docs = table(spark, SF_MID, "documents")
    bad = docs.filter(F.array_join(pretokens("text"), "") != F.col("text")).count()
    assert bad == 0


def test_exact_split_sizes_and_disjoint(spark):
    docs = table(spark, SF_MID, "documents").select("doc_id")
    s = G.exact_split(docs, "doc_id", 0.05, 42)
    counts = dict(s.groupBy("split").count().collect())
    assert counts == {"val": 50, "train": 950}
    s2 = G.exact_split(docs.repartition(7), "doc_id", 0.05, 42)
    assert sorted(r.doc_id for r in s.filter("split = 'val'").collect()) == \
        sorted(r.doc_id for r in s2.filter("split = 'val'").collect())


def test_dense_index_equals_row_number(spark):
    docs = table(spark, SF_MID, "documents").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("k"))
    ranked, n = dense_index(docs, ["k", "doc_id"], "pos", partitions=5)
    want = docs.withColumn("want", F.row_number().over(Window.orderBy("k", "doc_id")) - 1)
    joined = ranked.join(want, ["doc_id"])
    assert n == 1000 and joined.filter(F.col("pos") != F.col("want")).count() == 0


def test_training_rows_shapes_and_labels(spark):
    model = C.BpeModel.base()
    rows = X.pretrain_examples(table(spark, SF_SMALL, "documents"), model, max_len=32).collect()
    for r in rows:
        assert len(r.input_ids) == 31 and len(r.labels) == 31
        for i, lab in enumerate(r.labels):
            assert lab == -100 or (i + 1 < 31 and lab == r.input_ids[i + 1]) or i == 30


def test_sft_rows_repartition_invariant(spark):
    model = C.BpeModel.base()
    conv = table(spark, SF_SMALL, "conversations")
    a = {r.conv_id: (list(r.input_ids), list(r.labels)) for r in X.sft_examples(conv, model, 64).collect()}
    b = {r.conv_id: (list(r.input_ids), list(r.labels)) for r in X.sft_examples(conv.repartition(1), model, 64).collect()}
    c = {r.conv_id: (list(r.input_ids), list(r.labels)) for r in X.sft_examples(conv.repartition(7), model, 64).collect()}
    assert a == b == c


def test_shard_matches_distributed_sampler(spark):
    df = spark.range(10).withColumnRenamed("id", "pos")
    got = sorted((r.rank, r.slot, r.pos) for r in G.shard(df, 4, 10).collect())
    # reference behaviour: pad by wrap-around to 12 slots, shard r takes slots r, r+4, r+8
    idx = list(range(10)) + list(range(10))[:2]
    want = sorted((s % 4, s, idx[s]) for s in range(12))
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_running_agg_equals_window(spark, parts):
    from tessera.operators.prefix import running_agg
    rng = random.Random(2)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1.5, -2.0, 0.25]
    rows = [(i, rng.choice(["a", "b", None]) if i % 3 else "hot", i, rng.choice(odd if i % 2 else odd[4:]), rng.choice([None, 3, -4, 5])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, run string, step long, d double, k int").withColumns({"_value": F.lit(1), "_part": F.lit(2)})
    for how, fn in (("sum", F.sum), ("max", F.max), ("min", F.min)):
        for inclusive in (True, False):
            for value in ("d", "k"):
                if value == "d" and how == "sum":
                    src = df.withColumn("d", F.when(F.abs("d") < 10, F.col("d")))
                else:
                    src = df
                got = running_agg(src.select("id", "run", "step", value), value, ["step"], ["run"], how, "r", inclusive, partitions=parts)
                assert got.columns == ["id", "run", "step", value, "r"]
                w = Window.partitionBy("run").orderBy("step").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
                want = {r.id: r.w for r in src.withColumn("w", fn(value).over(w)).collect()}
                found = {r.id: r.r for r in got.collect()}
                assert found.keys() == want.keys()
                assert all(str(found[i]) == str(want[i]) for i in want), (how, inclusive, value)
    assert running_agg(df.limit(0).select("id", "run", "step", "d"), "d", ["step"], ["run"]).count() == 0


def test_hot_group_running_best_spreads(spark):
    """One run holding every row: exact, one exchange, and the checkpoint holds only wanted columns."""
    from tessera.operators import evaluate as H
    ev = table(spark, SF_SMALL, "events").withColumn("user_id", F.lit(1))
    got = H.running_best(ev, "value", "ts", ["user_id"], "max", keep=["event_id"])
    assert got.columns == ["user_id", "ts", "event_id", "best_so_far"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "props" not in plan  # the one exchange is behind the checkpoint
    assert got.rdd.getNumPartitions() > 1
    want = ev.withColumn("w", F.max("value").over(Window.partitionBy("user_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)))
    j = got.join(want.select("event_id", "w"), "event_id")
    assert j.count() == ev.count() and j.filter(F.col("best_so_far") != F.col("w")).count() == 0


def test_line_ids_across_many_splits(spark):
    """Line numbers follow file order even when files are cut into many splits."""
    import tempfile
    from tessera.sources import io as S
    docs = table(spark, SF_MID, "documents").select("doc_id", "text")
    path = tempfile.mkdtemp(prefix="tessera-jsonl-", dir="/tmp") + "/corpus"
    docs.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").select("text").write.json(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        back = S.read_corpus(spark, path)
        assert back.rdd.getNumPartitions() > 5
        got = [(r.row_id, r.text) for r in back.orderBy("row_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [r.text for r in docs.orderBy("doc_id").collect()]
    assert [i for i, _ in got] == list(range(len(want)))
    assert [t for _, t in got] == want
