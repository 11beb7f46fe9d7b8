"""Cases that the driver's tables lack: changed split layouts, large ids, nulls, repeated keys, long words."""

import json
import math
import random
import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions.text import BYTE_TO_ID, byte_symbols
from tessera.operators import batches as G
from tessera.operators import bpe as C
from tessera.operators import encode as D
from tessera.operators import evaluate as H
from tessera.operators import examples as X
from tessera.session import spread
from tessera.sources import io as S


def test_line_ids_survive_another_split_size(spark, tmp_path):
    path = tmp_path / "corpus.jsonl"
    path.write_text("".join(json.dumps({"text": f"line {i} " + "x" * 50}) + "\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
        df = S.read_corpus(spark, str(path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "70k")
        rows = df.select("row_id", F.regexp_extract("text", r"line (\d+)", 1).cast("long").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 20000 and all(r.row_id == r.n for r in rows)


@pytest.mark.parametrize("bad", ["", "   ", "{\"text\": ", "{\"other\": 1}"])
def test_bad_lines_raise_and_can_be_dropped(spark, tmp_path, bad):
    path = tmp_path / "corpus.jsonl"
    path.write_text("\n".join([json.dumps({"text": "a"}), bad, json.dumps({"text": "", "more": [1]}), json.dumps({"text": "c"})]) + "\n")
    with pytest.raises(Exception, match="blank line|line without|Malformed records"):
        S.read_corpus(spark, str(path)).collect()
    rows = S.read_corpus(spark, str(path), mode="DROPMALFORMED").collect()
    assert sorted((r.row_id, r.text) for r in rows) == [(0, "a"), (1, ""), (2, "c")]


def test_lines_are_counted_without_parsing(spark, tmp_path):
    path = tmp_path / "corpus.jsonl"
    path.write_text(json.dumps({"text": "a b"}, ensure_ascii=False) + "\r\n" + json.dumps({"text": "c"}))  # no line end at the last
    df = S.read_corpus(spark, str(path))
    assert sorted((r.row_id, r.text) for r in df.collect()) == [(0, "a b"), (1, "c")]
    assert df.select("row_id")._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 0


def test_training_reads_large_ids(spark):
    docs = spark.range(5_000_000, 5_000_010).select(F.col("id").alias("doc_id"), F.lit("abab abab").alias("text"))
    assert len(C.train_tokenizer(docs, vocab_size=262).merges) == 3
    assert C.train_tokenizer(docs, vocab_size=262, max_lines=10).merges == []


def test_conversations_of_unknown_roles_keep_their_row(spark):
    turns = spark.createDataFrame([(1, 0, "tool", "x"), (1, 1, "tool", None), (2, 0, "human", "hi"), (2, 1, "assistant", "yo")],
                                  "conv_id long, turn long, role string, text string")
    model = C.BpeModel.base()
    for strategy in ("narrow", "dictionary"):
        rows = {r.conv_id: r for r in X.sft_examples(turns, model, 32, strategy=strategy).collect()}
        assert sorted(rows) == [1, 2]
        assert rows[1].n_tokens == rows[1].n_supervised == 0 and len(rows[1].input_ids) == 31
        assert rows[2].n_supervised > 0
    assert {r.conv_id for r in X.assistant_mask(turns, model, 32).collect()} == {1, 2}


def test_null_texts_fail(spark):
    model = C.BpeModel.base()
    docs = spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")
    turns = spark.createDataFrame([(1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    with pytest.raises(PySparkException):
        X.pretrain_examples(docs, model, 16).collect()
    with pytest.raises(PySparkException):
        X.sft_examples(turns, model, 16).collect()


def test_nested_chat_file_to_rows(spark, tmp_path):
    path = tmp_path / "chat.jsonl"
    chats = [[("human", "hello"), ("assistant", "hi there")], [], [("system", "be kind"), ("human", "q"), ("assistant", "a")]]
    path.write_text("".join(json.dumps({"conversations": [{"from": r, "value": v} for r, v in c]}) + "\n" for c in chats))
    turns = X.flat_turns(S.read_conversations(spark, str(path)))
    flat = spark.createDataFrame([(i, j, r, v) for i, c in enumerate(chats) for j, (r, v) in enumerate(c)] + [(1, 0, "", None)],
                                 "conv_id long, turn long, role string, text string")
    model = C.BpeModel.base()
    got = sorted(map(tuple, X.sft_examples(turns, model, 48).collect()))
    assert got == sorted(map(tuple, X.sft_examples(flat, model, 48).collect())) and len(got) == 3


def test_checkpoint_order_is_the_same_for_every_k(spark):
    values = [(1, 0.5), (2, None), (3, 0.1), (4, float("nan")), (5, 0.1), (6, float("inf"))]
    df = spark.createDataFrame([("r", s, v) for s, v in values], "run string, step long, v double")
    for mode, want in (("min", [3, 5, 1, 4, 6, 2]), ("max", [6, 1, 3, 5, 4, 2])):
        for k in (3, 1001, -1):
            rows = H.best_checkpoints(df, k, "v", "step", ["run"], mode).orderBy("rank").collect()
            assert [r.step for r in rows] == (want[:k] if k > 0 else want), (mode, k)


def test_merged_metrics_follow_presence(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "name string, value double")
    b = spark.createDataFrame([("x", None), ("z", 3.0)], "name string, value double")
    assert {r.name: r.value for r in H.merge_metrics(a, b).collect()} == {"x": None, "y": 2.0, "z": 3.0}


def test_label_out_of_range_fails(spark):
    df = spark.createDataFrame([(7, [0.1, 0.2])], "label int, logits array<double>")
    with pytest.raises(PySparkException):
        df.select(H.nll("logits", "label")).collect()
    ok = spark.createDataFrame([(-100, [0.1, 0.2]), (1, [0.1, 0.2])], "label int, logits array<double>")
    assert [r[0] is None for r in ok.select(H.nll("logits", "label")).collect()] == [True, False]


@pytest.mark.parametrize("check", [True, False])
@pytest.mark.parametrize("mode", ["min", "max"])
def test_both_early_stop_forms_agree(spark, mode, check):
    rng = random.Random(4)
    pool = [None, float("nan"), float("inf"), float("-inf"), 0.1, 0.2, 0.3, 0.4, 0.5, 0.6]
    rows = [(run, step, rng.choice(pool if run % 2 else pool[4:])) for run in range(24) for step in range(12)]
    rows += [(100, s, None) for s in range(6)]
    df = spark.createDataFrame(rows, "run long, step long, v double")
    one = H.early_stop_points(df, "v", "step", ["run"], 3, mode, check, 0.05 if mode == "min" else 0.65).collect()
    two = H.early_stop_delta(df, "v", "step", ["run"], 3, 0.0, mode, check, 0.05 if mode == "min" else 0.65).collect()
    assert sorted((r.run, r.stop_at, r.reason) for r in one) == sorted((r.run, r.stop_at, r.reason) for r in two)


def test_repeated_ids_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id long, text string")
    with pytest.raises(ValueError):
        G.epoch_order(df, "doc_id", 0)
    with pytest.raises(ValueError):
        G.exact_split(df, "doc_id", 0.5)


def test_word_cache_is_bounded_by_memory():
    cache = D.WordCache(limit=1 << 20)
    tracemalloc.start()
    for i in range(20_000):
        for word in (f"word{i}", f"{i}" * 50, f"{i}" + "x" * 100_000 if i % 1000 == 0 else "a"):
            ids = [1000 + i] * len(word)
            cache.put(word, (ids, list(range(len(word)))))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 3 << 20 and cache.size <= 1 << 20
    assert cache.get("a") and cache.get("word19999") and not cache.get("0" + "x" * 100_000)


def test_long_words_are_encoded_quickly():
    rng = random.Random(2)
    ranks = {}
    for k in range(3000):
        ranks.setdefault((rng.randrange(200), rng.randrange(200)), (k, 300 + k))

    def plain(symbols):
        while True:
            hits = [ranks[p] for p in zip(symbols, symbols[1:]) if p in ranks]
            if not hits:
                return symbols
            rank, new = min(hits)
            pair = next(p for p, v in ranks.items() if v[0] == rank)
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i:i + 2]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out

    for n in (0, 1, 2, 5, 60, 300):
        word = [rng.randrange(200) for _ in range(n)]
        assert C.bpe_word(word, ranks) == plain(word)
    assert C.bpe_word([7] * 9, {(7, 7): (0, 8), (8, 8): (1, 9)}) == [9, 9, 7]
    start = time.perf_counter()
    C.bpe_word([rng.randrange(200) for _ in range(200_000)], ranks)
    assert time.perf_counter() - start < 10


def test_session_and_spread_leave_plans_alone(spark):
    import inspect

    from tessera.session import get_session
    assert inspect.signature(get_session).parameters["shuffle_partitions"].default is None
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(count, "id long").groupBy("id").count()
    assert spread(df) is df and seen.value == 0
    assert math.isclose(spread(spark.range(10, numPartitions=1), 4).rdd.getNumPartitions(), 4)


def test_public_tokenizer_file(spark, trained, tmp_path):
    from tokenizers import Tokenizer

    from chat_cases import CHAT_CASES, TEXT_CASES
    model, golden = trained
    S.save_tokenizer(spark, model, str(tmp_path / "tok"))
    line = spark.read.text(str(tmp_path / "tok" / "json")).first()[0]
    loaded = Tokenizer.from_str(line)
    assert loaded.get_vocab() == golden.get_vocab()
    texts = [t for case in [*CHAT_CASES.values(), *TEXT_CASES.values()] for t in ([case] if isinstance(case, str) else map(str, case))]
    for text in [*texts, "plain text 123", "\uff21\uff22 caf\u00e9 \U0001f642"]:
        assert loaded.encode(text).ids == golden.encode(text).ids
    assert S.load_tokenizer(spark, str(tmp_path / "tok")).merges == model.merges


def test_words_are_merged_many_at_a_time(monkeypatch):
    """Every word gets the ids that merging it alone gives, runs of one symbol and merges into older symbols included."""
    rng = random.Random(3)
    for _ in range(60):
        base = top = rng.choice([3, 8, 40])
        ranks = {}
        for k in range(rng.choice([0, 3, 30, 200])):
            old = top > base and rng.random() < .2
            if ranks.setdefault((rng.randrange(top), rng.randrange(top)), (k, rng.randrange(base, top) if old else top)) == (k, top):
                top += 1
        words = [[rng.randrange(base) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 20, C.LONG_WORD, C.LONG_WORD + 1, 80]))] for _ in range(rng.choice([0, 1, 40]))]
        sizes = np.array([len(w) for w in words], np.int64)
        ids, counts = C.bpe_words(np.array([x for w in words for x in w], np.int32), np.cumsum(sizes) - sizes, sizes, C.MergeTable(ranks))
        want = [C.bpe_word(w, ranks) for w in words]
        assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]

    def alone(*_):
        raise AssertionError("a short word was merged by itself")

    monkeypatch.setattr(C, "bpe_word", alone)
    monkeypatch.setattr(D, "bpe_word", alone)
    model = C.BpeModel.base()
    model.merges, model.vocab[259] = [(BYTE_TO_ID[97], BYTE_TO_ID[98], 259)], b"ab"
    shared = [SimpleNamespace(value=x) for x in (model.ranks(), {i: len(b) for i, b in model.vocab.items()})]
    units = pa.array([["abab", "<unk>", "", "ab é"], [], None], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([units], names=["u"])
    (out,) = D._arrow_unit_encoder(*shared, "u", None)([batch])
    assert out.column("ids").to_pylist() == [[259, 259, 2, 259, *(BYTE_TO_ID[b] for b in " é".encode())], [], []]


def test_word_types_are_looked_up_many_at_a_time(spark):
    words = ["ab", "a", "", "é", " the", None, "\U0001f600x", "b" * 300]
    types = C.word_types(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, cnt int"))
    got = sorted((r.cnt, r.symbols) for r in types.collect())
    assert got == [(i, [BYTE_TO_ID[b] for b in w.encode()]) for i, w in enumerate(words) if w and len(w.encode()) > 1]
    assert [r.s for r in spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).select(byte_symbols("word").alias("s")).collect()] == [
        None if w is None else [BYTE_TO_ID[b] for b in w.encode()] for w in words]
    assert types.dtypes == [("symbols", "array<int>"), ("cnt", "bigint")]
    assert "transform" not in types._jdf.queryExecution().executedPlan().toString()  # some 9 microseconds a word
