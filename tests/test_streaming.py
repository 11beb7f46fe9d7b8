"""Streaming forms equal the batch operators on the driver's tables (availableNow trigger)."""

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import bpe as C
from tessera.operators import examples as X
from tessera.operators import runlog as K
from tessera.session import table
from tessera.sources import io as S
from tessera.streaming import jobs


def _copy(df, name):
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp"), name)
    df.repartition(3).write.parquet(path)
    return path


def test_pretrain_rows_stream_equals_batch(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    src = _copy(docs, "docs")
    model = C.BpeModel.base()
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    name = "pre_" + uuid.uuid4().hex[:8]
    q = jobs.start(jobs.pretrain_rows_stream(stream, model, 48), name)
    q.awaitTermination(300)
    got = {r.doc_id: list(r.labels) for r in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {r.doc_id: list(r.labels) for r in X.pretrain_examples(docs, model, 48).collect()}
    assert got == want


def test_run_logs_stream_equal_batch(spark):
    scalars = S.scalars_from_events(table(spark, SF_SMALL, "events"))
    src = _copy(scalars, "scalars")
    stream = spark.readStream.schema(scalars.schema).option("maxFilesPerTrigger", 1).parquet(src)
    name = "span_" + uuid.uuid4().hex[:8]
    q = jobs.start(jobs.run_span_stream(stream), name, mode="complete")
    q.awaitTermination(300)
    got = {r.run: round(r.duration_s, 6) for r in spark.sql(f"SELECT * FROM {name}").collect()}
    batch = K.run_span(scalars.withColumn("wall_time", F.col("wall_time").cast("timestamp")), "run", "wall_time")
    want = {r.run: round(r.duration_s, 6) for r in batch.collect()}
    assert got == want
    name2 = "latest_" + uuid.uuid4().hex[:8]
    q = jobs.start(jobs.latest_metrics_stream(stream), name2, mode="complete")
    q.awaitTermination(300)
    got = {(r.run, r.tag): r.value for r in spark.sql(f"SELECT * FROM {name2}").collect()}
    want = {(r.run, r.tag): r.value for r in K.latest_metrics(scalars).collect()}
    assert got == want


def test_jsonl_stream_to_rows(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    src = os.path.join(tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp"), "jsonl")
    docs.repartition(4).write.json(src)
    model = C.BpeModel.base()
    stream = jobs.read_corpus_stream(spark, src, max_files_per_trigger=2)
    name = "jsonl_" + uuid.uuid4().hex[:8]
    q = jobs.start(jobs.pretrain_rows_stream(stream, model, 32), name)
    q.awaitTermination(300)
    got = {r.doc_id: list(r.input_ids) for r in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {r.doc_id: list(r.input_ids) for r in X.pretrain_examples(docs, model, 32).collect()}
    assert got == want


def test_restart_continues_from_its_checkpoint(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    model = C.BpeModel.base()

    def run():
        stream = spark.readStream.schema(docs.schema).parquet(src)
        jobs.start(jobs.pretrain_rows_stream(stream, model, 32), "restart_" + uuid.uuid4().hex[:8], "parquet", out, checkpoint=state).awaitTermination(300)
        return sorted(r.doc_id for r in spark.read.parquet(out).select("doc_id").collect())

    docs.where("doc_id < 50").write.parquet(src)
    first = run()
    docs.where("doc_id >= 50").write.mode("append").parquet(src)
    both = run()  # a new query over the same folder reads only what is new
    assert first == sorted(r.doc_id for r in docs.where("doc_id < 50").collect())
    assert both == sorted(r.doc_id for r in docs.collect())


def test_windowed_state_expires(spark, tmp_path):
    base = "timestamp '2024-01-01 00:00:00'"
    late = spark.range(3).selectExpr("'r' AS run", "'t' AS tag", "id AS step", f"cast(unix_seconds({base}) + id * 60 as double) AS wall_time", "1.0 AS value")
    far = late.withColumn("wall_time", F.col("wall_time") + 86400.0)
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    names = []
    for i, part in enumerate((late, far, late.withColumn("wall_time", F.col("wall_time") + 30.0), far.withColumn("wall_time", F.col("wall_time") + 86400.0))):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(late.schema).parquet(src)
        q = jobs.start(jobs.run_span_stream(stream, window="1 hour"), f"win_{i}_" + uuid.uuid4().hex[:6], "parquet", str(tmp_path / "out"), checkpoint=state)
        q.awaitTermination(300)
        names.append(q)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    # the first day's window was given out once, without the row that came after its watermark
    first = [r for r in rows if r.window.start.day == 1]
    assert len(first) == 1 and first[0].duration_s == 120.0
