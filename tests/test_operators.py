"""Operators against brute-force Python on small inputs derived from the driver's tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tessera.functions.timefmt import format_duration
from tessera.operators import evaluate as H
from tessera.operators.prefix import StopRule
from tessera.operators import routing as J
from tessera.operators import sampling as I
from tessera.operators import bpe as C
from tessera.operators import encode as D
from tessera.session import table


def _py_duration(seconds):
    total = int(seconds)
    d, total = divmod(total, 86400)
    h, total = divmod(total, 3600)
    m, s = divmod(total, 60)
    parts = [f"{v}{u}" for v, u in ((d, "天"), (h, "小时"), (m, "分钟")) if v]
    if s or not parts:
        parts.append(f"{s}秒")
    return "".join(parts)


def test_format_duration(spark):
    vals = [0.0, 0.9, 59.0, 60.0, 61.5, 3600.0, 3661.0, 86400.0, 90061.7, 172800.0, 1234567.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r.t for r in df.select(format_duration("s").alias("t")).collect()]
    assert got == [_py_duration(v) for v in vals]


def _py_early_stop(values, patience, min_delta, mode):
    best = math.inf if mode == "min" else -math.inf
    wait = 0
    md = -min_delta if mode == "min" else min_delta
    better = (lambda a, b: a < b) if mode == "min" else (lambda a, b: a > b)
    for i, v in enumerate(values):
        if not math.isfinite(v):
            return i, "non_finite", best
        if better(v - md, best):
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience:
                return i, "patience", best
    return None, None, best


def test_early_stop_both_forms_vs_bruteforce(spark):
    ev = table(spark, SF_SMALL, "events")
    rows = ev.orderBy("user_id", "event_type", "ts").collect()
    series = {}
    for r in rows:
        series.setdefault((r.user_id, r.event_type), []).append((r.ts, r.value))
    for mode in ("min", "max"):
        w = {(r.user_id, r.event_type): r for r in
             H.early_stop_points(ev, "value", "ts", ["user_id", "event_type"], 2, mode).collect()}
        d = {(r.user_id, r.event_type): r for r in
             H.early_stop_delta(ev, "value", "ts", ["user_id", "event_type"], 2, 3.0, mode).collect()}
        for key, pts in series.items():
            vals = [v for _, v in pts]
            i, why, best = _py_early_stop(vals, 2, 0.0, mode)
            assert w[key].reason == why and w[key].stop_at == (pts[i][0] if i is not None else None)
            if math.isfinite(best):
                assert abs(w[key].best - best) < 1e-12
            i, why, best = _py_early_stop(vals, 2, 3.0, mode)
            assert d[key].reason == why and d[key].stop_at == (pts[i][0] if i is not None else None)


@pytest.mark.parametrize("parts", [1, 9])
def test_early_stop_of_hot_and_odd_runs(spark, parts):
    """Runs cut into many pieces, every rule, against one check after the other."""
    rng = random.Random(8)
    pool = [None, math.nan, math.inf, -math.inf] + [round(rng.uniform(0, 3), 2) for _ in range(40)]
    rows = [("hot", s, 5 - s * 0.01 + rng.choice([0, 0.3])) for s in range(400)] + [("late", s, 1.0 if s else 0.5) for s in range(60)]
    rows += [(f"r{k}", s, rng.choice(pool if k % 3 == 0 else pool[4:])) for k in range(40) for s in range(rng.randrange(1, 30))] + [(None, 3, 0.1), (None, 4, 0.2)]
    df = spark.createDataFrame(rows, "run string, step long, v double").repartition(3)
    runs = {}
    for run, step, v in sorted(rows, key=lambda r: r[1]):
        runs.setdefault(run, []).append((step, math.nan if v is None else v))
    for mode, delta, patience, check, threshold, diverge in [("min", 0.0, 3, True, None, None), ("min", 0.2, 4, True, None, 2.9), ("max", 0.1, 1, False, 2.95, None),
                                                             ("min", 0.05, 50, False, None, None), ("max", 0.0, 120, True, None, 0.02), ("min", 0.3, 0, True, 0.02, None)]:
        rule = StopRule(patience, delta, mode, check, threshold, diverge)
        want = {}
        for run, checks in runs.items():
            state = rule.start()
            for at, v in checks:
                state = rule.step(state, at, v)
            want[run] = (state[3], state[4], state[0] if state[2] else None)
        found = H.early_stop(df, "v", "step", ["run"], patience, delta, mode, check, threshold, diverge, partitions=parts).collect()
        assert len(found) == len(runs)
        assert {r.run: (r.stop_at, r.reason, r.best) for r in found} == want


def test_balance_loss_vs_numpy(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    gates = emb.select(F.col("vec_id").alias("token_id"), F.posexplode(F.slice("embedding", 1, 8)).alias("expert_id", "gate"))
    routed = J.route(J.noisy_gate(gates, std=0.0, noise_gate=None), k=4)
    n = emb.agg(F.count(F.lit(1)).alias("n"))
    got = J.balance_loss(routed, 8, n).first().balance_loss
    x = np.array([r.embedding[:8] for r in emb.orderBy("vec_id").collect()], dtype=np.float64)
    scores = np.zeros_like(x)
    for t in range(len(x)):
        top = sorted(range(8), key=lambda e: (-x[t, e], e))[:4]
        z = np.exp(x[t, top] - x[t, top].max())
        scores[t, top] = z / z.sum()
    imp = scores.mean(axis=0)
    u = 1.0 / 8
    want = float(np.sum(u * (np.log(u) - np.log(imp + 1e-8))))
    assert abs(got - want) < 1e-9


def test_noisy_gate_is_partition_independent(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    gates = emb.select(F.col("vec_id").alias("token_id"), F.posexplode(F.slice("embedding", 1, 8)).alias("expert_id", "gate"))
    a = {(r.token_id, r.expert_id): r.logit for r in J.noisy_gate(gates, 1.0, 3, noise_gate=None).collect()}
    b = {(r.token_id, r.expert_id): r.logit for r in J.noisy_gate(gates.repartition(5), 1.0, 3, noise_gate=None).collect()}
    assert a == b
    z = np.array([a[k] - g for k, g in ((k, v) for k, v in
                  {(r.token_id, r.expert_id): r.gate for r in gates.collect()}.items())])
    assert abs(z.mean()) < 0.1 and abs(z.std() - 1.0) < 0.1


def test_text_deltas_vs_bruteforce(spark):
    model = C.BpeModel.base()
    docs = table(spark, SF_SMALL, "documents").limit(20)
    gen = D.encode(docs, model, ["doc_id"], max_len=48)
    steps = gen.select(F.col("doc_id").alias("gen_id"), F.posexplode("ids").alias("step", "token_id"))
    got = {}
    for r in I.text_deltas(steps, D.vocab_map(model)).collect():
        got.setdefault(r.gen_id, []).append((r.step, r.delta))
    for r in gen.collect():
        prev, want = "", []
        for s in range(len(r.ids)):
            if r.ids[s] == 1:
                break
            full = b"".join(model.vocab[t] for t in r.ids[:s + 1] if t >= 3).decode("utf-8", "replace")
            delta = full[len(prev):]
            prev = full
            if delta:
                want.append((s, delta))
        assert sorted(got.get(r.doc_id, [])) == want


def test_text_deltas_of_long_and_malformed_generations(spark):
    model = C.BpeModel.base()
    ids = {b[0]: t for t, b in model.vocab.items() if t >= 3}
    rng = np.random.default_rng(3)
    edges = [0x41, 0x7F, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xDF, 0xE0, 0xE1, 0xEC, 0xED, 0xEF, 0xF0, 0xF1, 0xF3, 0xF4, 0xF5, 0xFF]
    gens = {0: [ids[b] for b in ("añ日😀" * 60).encode()], 1: [0, *[ids[b] for b in "😀é".encode()], 1, ids[0x41]]}
    gens |= {g: [ids[b] for b in rng.choice(edges, 400)] for g in range(2, 12)}
    gens[12] = [t for b in "é日😀".encode() for t in (ids[b], 0, 2)]  # special tokens inside characters
    steps = spark.createDataFrame([(g, s, int(t)) for g, x in gens.items() for s, t in enumerate(x)], "gen_id long, step int, token_id int")
    got = {}
    for r in I.text_deltas(steps.repartition(5), D.vocab_map(model)).collect():
        got.setdefault(r.gen_id, []).append((r.step, r.delta))
    for g, x in gens.items():
        prev, want, data = "", [], b""
        for s, t in enumerate(x):
            if t == 1:
                break
            data += model.vocab[t] if t >= 3 else b""
            full = data.decode("utf-8", "replace")
            if full[len(prev):]:
                want.append((s, full[len(prev):]))
            prev = full
        assert sorted(got.get(g, [])) == want, g


def test_hot_generation_spans_ranges(spark):
    """Carries cross ranges inside characters and an end stops every later range."""
    from tessera.operators import prefix
    data = ("añ日😀" * 300).encode()
    rows = [(0, s, data[s:s + 1]) for s in range(len(data))] + [(1, s, b"ab" if s % 2 else b"") for s in range(40)] + [(2, 5, b"z")]
    df = spark.createDataFrame(rows, "g long, s long, b binary").repartition(4)
    for stop in (10**6, 1234):
        got = prefix.look_back(df, ["g"], "s", F.col("b"), (F.col("g") == 0) & (F.col("s") == stop), 3, "before", 13)
        assert got.select(F.spark_partition_id()).distinct().count() > 3
        got = {(r.g, r.s): (bytes(r.value), bytes(r.before)) for r in got.collect()}
        want = {(0, s): (data[s:s + 1], data[max(0, s - 3):s]) for s in range(min(stop, len(data)))}
        want |= {(1, s): (b"ab", (b"ab" * (s // 2))[-3:]) for s in range(1, 40, 2)} | {(2, 5): (b"z", b"")}
        assert got == want
    assert prefix.look_back(df.limit(0), ["g"], "s", F.col("b"), F.lit(False), 3).count() == 0


def test_text_deltas_query_takes_whole_texts(spark):
    docs = table(spark, SF_SMALL, "documents").selectExpr("doc_id", "octet_length(text) as n")
    steps = entry.queries()["text_deltas"](spark, SF_SMALL).groupBy("gen_id").agg(F.max("step").alias("step"))
    short = docs.join(steps, docs.doc_id == steps.gen_id, "left").where("n > 0 and (step is null or step < n - 4)")
    assert short.count() == 0


def test_metric_value_missing_raises(spark):
    df = spark.createDataFrame([("a", 1.0)], "name string, value double")
    try:
        H.metric_value(df, "b").collect()
    except Exception as e:  # noqa: BLE001
        assert "Metric value not found" in str(e)
    else:
        raise AssertionError("expected a failure")


def test_best_checkpoints_all_ranks_equal_window(spark):
    from pyspark.sql import Window
    ev = table(spark, SF_SMALL, "events")
    for mode in ("min", "max"):
        got = {r.event_id: r.rank for r in H.best_checkpoints(ev, -1, "value", "ts", ["user_id", "event_type"], mode).collect()}
        o = F.col("value").asc() if mode == "min" else F.col("value").desc()
        want = {r.event_id: r.rk for r in ev.withColumn("rk", F.row_number().over(
            Window.partitionBy("user_id", "event_type").orderBy(o, F.col("ts")))).collect()}
        assert got == want
        small = {r.event_id: r.rank for r in H.best_checkpoints(ev, 3, "value", "ts", ["user_id", "event_type"], mode).collect()}
        assert small == {e: r for e, r in want.items() if r <= 3}


def test_encoder_works_in_bounded_slices():
    """A batch of many rows, or of one long row, is not expanded at once."""
    from types import SimpleNamespace

    import pyarrow as pa
    from tessera.functions.text import BYTE_TO_ID
    model = C.BpeModel.base()
    rng = np.random.default_rng(4)
    words = ["w%05x" % x for x in rng.integers(0, 1 << 20, 400)] + ["é", "<|im_end|>", ""]
    rows = [[words[i] for i in rng.integers(0, len(words), 500)] for _ in range(2500)] + [[], None, words * 2500, ["a"]]
    cls = [None if r is None else [i % 3 for i in range(len(r))] for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.string())), pa.array(cls, pa.list_(pa.int32()))], names=["k", "u", "c"])
    shared = [SimpleNamespace(value=x) for x in (model.ranks(), {i: len(b) for i, b in model.vocab.items()})]
    run = D._arrow_unit_encoder(*shared, "u", "c")
    n, most = 0, 0
    for out in run([batch]):
        most = max(most, out.num_rows)
        tail = out.slice(max(out.num_rows - 4, 0))
        for k, ids, mask in zip(*(tail.column(c).to_pylist() for c in ("k", "ids", "mask"))):
            want = [([1], [c > 0]) if u == "<|im_end|>" else ([BYTE_TO_ID[b] for b in u.encode()], [c == 1 or (c == 2 and j > 0) for j in range(len(u.encode()))])
                    for u, c in zip(rows[k] or [], cls[k] or [])]
            assert ids == [t for u, _ in want for t in u]
            assert mask == [int(m) for _, ms in want for m in ms]
        n += out.num_rows
    assert n == len(rows) and most < 1000


def test_text_deltas_write_little_more_than_their_bytes(spark):
    """What is exchanged and checkpointed are packed runs, not one row a step; steps in any order, negative or of any type give the same."""
    import os

    from tessera.operators import prefix
    from tessera.session import ensure_checkpoint_dir

    def kept():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(ensure_checkpoint_dir(spark).removeprefix("file:")) for f in fs)

    n = 200_000
    df = spark.range(n).selectExpr("id div 2000 as g", "id % 2000 - 500 as s")
    before = kept()
    got = prefix.look_back(df, ["g"], "s", F.encode((F.abs("s") % 10).cast("string"), "UTF-8"), F.lit(False), 3)
    assert got.count() == n and 0 < kept() - before < 3 * n
    rng = np.random.default_rng(5)
    rows = [(g, int(s), bytes(rng.integers(65, 91, int(rng.integers(0, 4))))) for g in (None, 0, 1) for s in rng.permutation(np.arange(-700, 700) * 3)]
    steps = spark.createDataFrame(rows, "g int, s int, b binary")
    for order in (F.col("s"), F.format_string("%05d", F.col("s") + 3000), F.col("s").cast("double")):
        found = prefix.look_back(steps.withColumn("o", order), ["g"], "o", F.col("b"), (F.col("g") == 1) & (F.col("s") == 300), 3, partitions=7)
        found = sorted(((r.g is None, r.g or 0, r.o), bytes(r.value), bytes(r.before)) for r in found.collect())
        want = {}
        for g in (0, 1, None):
            text = b""
            for s, b in sorted((s, b) for k, s, b in rows if k == g):
                if g == 1 and s >= 300:
                    break
                if b:
                    want.setdefault(g, []).append((s, b, text[-3:]))
                text += b
        assert [x[1:] for x in found] == [x[1:] for g in (0, 1, None) for x in want[g]]


def test_text_deltas_of_lists_equal_those_of_steps(spark):
    """Lists of tokens give what their exploded steps give, whatever the lists hold; no run of them holds nulls, which Spark is slow with."""
    import pyarrow as pa
    from tessera.operators import prefix
    model = C.BpeModel.base()
    byte = {b[0]: t for t, b in model.vocab.items() if t >= 3}
    rng = np.random.default_rng(8)
    texts = [("añ日😀 plain ASCII " * 90).encode(), b"", "é日".encode()[:4], bytes(rng.integers(0, 256, 1500).astype(np.uint8)), b"x" * 1024]
    rows = [(g, [byte[b] for b in t]) for g, t in enumerate(texts)] + [(None, [byte[65], byte[0xC3], byte[0xA9]]), (9, None), (10, [1, byte[65]]),
            (11, [byte[65], None, -4, 10**6, 2, byte[0xE6], 0, byte[0x97], byte[0xA5], 1, byte[66]]), (12, [byte[66]] * 700 + [1] + [byte[67]] * 900)]
    rows += rows[:1]  # a generation in two rows: both of a step's tokens count
    lists = spark.createDataFrame(rows, "gen_id int, ids array<int>").repartition(3)
    steps = lists.select("gen_id", F.posexplode("ids").alias("step", "token_id"))
    for most in (None, 5):
        a = I.text_deltas(lists, D.vocab_map(model), ids="ids", max_new=most)
        b = I.text_deltas(steps, D.vocab_map(model), max_new=most)
        assert a.columns == b.columns and dict(a.dtypes)["step"] == "bigint"
        found, want = (sorted(((r.gen_id is None, r.gen_id or 0, r.step, r.delta) for r in x.collect())) for x in (a, b))
        assert found == want and len(found) > (6000 if most is None else 20)
    values = [b"" if t < 3 else model.vocab[t] for t in range(max(model.vocab) + 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8], pa.int32()), pa.array([0, 1], pa.int64()), pa.array([[byte[65], 0, byte[66]], [byte[67], 1]], pa.list_(pa.int32()))],
                                       names=["gen_id", "_block", "ids"])
    (packs,) = prefix._list_packer(["gen_id"], "ids", values, 1)([batch])
    assert not any(packs.column(c).null_count for c in ("_places", "_sizes", "_stops", "_bytes"))
    assert prefix._unpack(packs, ["gen_id"], "step").to_pydict() == {
        "gen_id": [7, 7, 8, 8], "step": [0, 2, prefix.SPAN, prefix.SPAN + 1], "value": [b"A", b"B", b"C", b""], "_stop": [False, False, False, True]}


def test_what_makes_the_steps_runs_once(spark):
    from tessera.operators import prefix
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    steps = spark.range(3000).selectExpr("id div 100 as g", "id % 100 as s").repartition(2).mapInArrow(counted, "g long, s long")
    assert prefix.look_back(steps, ["g"], "s", F.lit(b"a"), F.lit(False), 3).count() == 3000
    assert seen.value == 3000
