"""Physical-plan checks: the properties the design relies on must show up in ``explain``."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tessera.operators import bpe as C
from tessera.operators import examples as X
from tessera.session import table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chat_rows_limit_turns_before_the_shuffle(spark):
    plan = _plan(X.sft_examples(table(spark, SF_SMALL, "conversations"), C.BpeModel.base(), 512))
    # partial group limit below the exchange, final one above it
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pretrain_rows_encode_without_hash_shuffle(spark):
    plan = _plan(X.pretrain_examples(table(spark, SF_SMALL, "documents"), C.BpeModel.base(), 512))
    assert "MapInArrow" in plan
    assert "hashpartitioning" not in plan  # only the round-robin spread of an under-split scan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "[doc_id#" in scan and "lang" not in scan and "n_chars" not in scan


def test_word_counts_aggregate_map_side_and_prune(spark):
    plan = _plan(C.word_counts(table(spark, SF_SMALL, "documents")))
    assert "partial_count" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "[text#" in scan and "doc_id" not in scan


@pytest.mark.parametrize("name", ["word_counts", "exact_split", "epoch_batches", "total_loss", "balance_loss",
                                  "best_checkpoints", "early_stop", "route_topk", "run_span", "sft_rows_bytes"])
def test_no_cartesian_products(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_chat_rows_deal_conversations_once(spark):
    plan = _plan(X.sft_examples(table(spark, SF_SMALL, "conversations"), C.BpeModel.base(), 512))
    assert plan.count("Exchange") == 1 and plan.count("FileScan parquet") == 1
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_huge_conversation_is_cut_before_its_units_are_made(spark):
    from pyspark.sql import functions as F
    n = 50_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                  F.expr("case id % 3 when 0 then 'tool' when 1 then 'user' else 'assistant' end").alias("role"),
                                  F.concat(F.lit("turn number "), F.col("id").cast("string")).alias("text"))
    model = C.BpeModel.base()
    few = X.sft_examples(turns.where("turn < 60"), model, 96).first()
    assert X.sft_examples(turns.repartition(6), model, 96).collect() == [few] and few.n_tokens == 96


def test_bounded_scan_and_lookup_push_down(spark):
    from tessera.sources import io as S
    docs = table(spark, SF_SMALL, "documents")
    head = [l for l in _plan(S.head_lines(docs, 100, "doc_id")).splitlines() if "FileScan parquet" in l][0]
    assert "PushedFilters: [IsNotNull(doc_id), LessThan(doc_id,100)]" in head
    look = [l for l in _plan(S.rows_at(docs, [3, 5, 8], "doc_id")).splitlines() if "FileScan parquet" in l][0]
    assert "In(doc_id, [3,5,8])" in look


def test_tokenizer_training_reads_only_text_and_bounds_lines(spark):
    docs = table(spark, SF_SMALL, "documents").filter("doc_id < 2000000")
    scan = [l for l in _plan(C.word_counts(docs)).splitlines() if "FileScan parquet" in l][0]
    assert "LessThan(doc_id,2000000)" in scan and "n_chars" not in scan


def test_split_and_epoch_layout_exchange_rows_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.operators import batches as G
    from tessera.sources import io as S
    split = G.exact_split(table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id", 0.1, 42)
    assert "Exchange" not in _plan(split)
    S.write_epoch(split, str(tmp_path / "e"), "doc_id", epoch=3, partitions=5)
    back = S.read_epoch(spark, str(tmp_path / "e"), 16)
    assert "SinglePartition" not in _plan(back) and "SortMergeJoin" not in _plan(back)
    rows = back.collect()
    want = {r.doc_id: (r.split, r.text) for r in split.collect()}
    assert {r.doc_id: (r.split, r.text) for r in rows} == want and len(rows) == len(want)
    ranked = G.epoch_order(G.split_view(split, "train"), "doc_id", epoch=3).collect()
    assert {r.doc_id: r.pos for r in rows if r.split == "train"} == {r.doc_id: r.pos for r in ranked}
    val = sorted(r.doc_id for r in rows if r.split == "val")
    assert {r.doc_id: r.pos for r in rows if r.split == "val"} == {d: i for i, d in enumerate(val)}
    assert all(r.batch_id == r.pos // 16 for r in rows)
    # several files a task, numbered after each other
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        S.write_epoch(split, str(tmp_path / "f"), "doc_id", epoch=3, partitions=3)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert {r.doc_id: r.pos for r in S.read_epoch(spark, str(tmp_path / "f"), 16).collect()} == {r.doc_id: r.pos for r in rows}
    assert split.agg(F.count_if(F.col("split") == "val")).first()[0] == int(len(rows) * 0.1)


def test_file_numbers_are_read_beside_any_folder_or_unique_part(spark, tmp_path):
    """Files whose unique part looks like a file number are still ordered by their numbers."""
    from tessera.sources import io as S
    path, names = tmp_path / "x-c5" / "split=train", []
    spark.range(12).selectExpr("id as doc_id").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(path))
    for k, f in enumerate(sorted(path.glob("part-*.parquet"))):
        names.append(f.rename(path / f"part-0000{k // 2}-0a-c{90 - k}-c12345678901.c00{k % 2}.snappy.parquet"))
    back = S.read_epoch(spark, str(tmp_path / "x-c5"), 5).collect()
    assert len(names) == 4 and {r.doc_id: (r.pos, r.batch_id) for r in back} == {i: (i, i // 5) for i in range(12)}


def test_exact_split_of_deep_buckets(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tessera.operators import batches as G
    monkeypatch.setattr(G, "FEW", 3)
    monkeypatch.setattr(G, "DIGITS", 1)
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    for rate in (0.0, 0.0004, 0.05, 0.5, 0.9999, 1.0):
        split = G.exact_split(df, "doc_id", rate, 7)
        order = [r.doc_id for r in df.orderBy(F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string")))).collect()]
        assert {r.doc_id for r in split.collect() if r.split == "val"} == set(order[:int(3000 * rate)])
    assert G.exact_split(df.limit(0), "doc_id", 0.5).count() == 0
