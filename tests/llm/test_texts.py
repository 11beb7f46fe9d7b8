import hashlib
import random
import sys
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
from tessera.llm import fingerprints, kernels, line_dedup, substring_dedup  # noqa: E402


def brute_repeats(rows, window=20):
    """Rows equal in id and text are one document; equal ids follow each other by Spark's text hash."""
    seen, out = set(), {}
    for key in sorted(rows, key=lambda r: (-2**63 if r[0] is None else r[0], r[2])):
        if key in out:
            continue
        w = X.words(key[1])
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone[s:s + window] = [True] * window
            seen.add(k)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[key] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("seed", [1, 4])
def test_substrings_match_brute_force(spark, seed):
    docs = X.table(spark, seed)
    rows = [(r.doc_id, r.text, r.h) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    want = brute_repeats(rows)
    got = substring_dedup.dedup_substrings(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == Counter((k[0], *want[k]) for k in rows)
    assert all(sum(s["to"] - s["from"] for s in r.spans) == r.n_removed for r in got)
    assert substring_dedup.dedup_substrings(X.empty(spark)).count() == 0


def test_equal_windows_have_equal_keys_in_any_context():
    rng = np.random.default_rng(2)
    for vocabulary in (2, 3, 8, 500):
        body = rng.integers(0, vocabulary, 40)
        keys = []
        for _ in range(20):
            seq = np.concatenate([rng.integers(0, vocabulary, rng.integers(0, 30)), body, rng.integers(0, vocabulary, 20)])
            at = len(seq) - 60
            h = kernels.mix((seq + 1).astype(np.uint64))
            p, key, whole = substring_dedup.anchors(h, np.array([0, len(h)]))
            keys.append((key[at:at + 21].tolist(), whole[at:at + 21].tolist()))
        assert all(k == keys[0] for k in keys)


def test_words_and_windows_equal_plain_python():
    texts = X.texts()
    data, off = kernels.text_bytes(pa.array(texts))
    starts, ends, first = kernels.word_bounds(data, off)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        assert [raw[a:b].decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] == X.words(t)
    values, at = kernels.shingles(data, off)
    assert np.diff(at).tolist() == [len(X.shingles(t)) for t in texts]
    h = kernels.mix(np.arange(1, 60, dtype=np.uint64))
    for k in (1, 2, 5, 7, 20):
        assert np.array_equal(kernels.windows(h, k)[3:4], kernels.windows(h[3:3 + k], k))


def test_fingerprints_hard_rows_and_likeness(spark):
    docs = X.table(spark)
    got = fingerprints.compare_with_edited(docs).collect()
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted(((2**64 if r.doc_id is None else -r.doc_id, r.h), r.doc_id, r.text) for r in src)
    want = Counter()
    for i, (_, doc_id, text) in enumerate(order):
        half = len(text) // 2
        edited = text[:len(text) - half] + order[(i + 1) % len(order)][2][:half]
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.compare_with_edited(X.empty(spark)).count() == 0
    one = fingerprints.compare_with_edited(docs.where("doc_id = 7").limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprint_estimates_and_plan(spark):
    rng = np.random.default_rng(1)
    pairs = []
    for share in (0.1, 0.4, 0.7, 0.95):
        a = [f"v{i}" for i in rng.integers(0, 10**9, 600)]
        b = a[:int(600 * share)] + [f"q{i}" for i in rng.integers(0, 10**9, 600 - int(600 * share))]
        pairs.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("s"),
                     fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("a"))).alias("one")).collect()
    for r in rows:
        x, y = X.shingles(r.a), X.shingles(r.b)
        assert abs(r.s - len(x & y) / len(x | y)) < 0.12 and r.one == 1.0
    plan = fingerprints.compare_with_edited(X.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_patience_alignment():
    assert line_dedup.patience([1, 2, 3], [1, 2, 3]) == [0, 1, 2]
    assert sorted(line_dedup.patience([9, 1, 2, 3, 8], [1, 2, 7, 3])) == [0, 1, 3]
    assert sorted(line_dedup.patience([5, 5, 1, 5], [7, 5, 1, 5, 5])) == [1, 2, 4]
    assert line_dedup.patience([1, 2], [3, 4]) == [] and line_dedup.patience([], [1]) == []
    assert len(line_dedup.patience([1, 2, 3, 4], [4, 3, 2, 1])) == 1


def brute_lines(rows, most):
    """First holders of rare shared lines, aligned pairwise."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    lines = [[x for x in enumerate(r[1].split("\n")) if x[1].strip()] if r[1] is not None else [] for r in docs]
    holders, kinds = {}, {}
    for i, own in enumerate(lines):
        for _, x in own:
            holders.setdefault(x, []).append(i)
            kinds.setdefault(x, set()).add(docs[i][1])
    gone = [set() for _ in docs]
    pairs = {(holders[x][0], i) for i, own in enumerate(lines) for _, x in own if len(kinds[x]) <= most and holders[x][0] != i}
    for a, b in pairs:
        common = {x for _, x in lines[a]} & {x for _, x in lines[b]}
        first, later = [x for x in lines[a] if x[1] in common], [x for x in lines[b] if x[1] in common]
        gone[b] |= {later[j][0] for j in line_dedup.patience([x for _, x in first], [x for _, x in later])}
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in g) if d[1] is not None else None for d, g in zip(docs, gone)}


@pytest.mark.parametrize("least", [10, 3])
def test_lines_match_brute_force(spark, least):
    extra = ["l1\nl2\nl3\n\ncommon", "x\nl1\nl2\ny\ncommon", "l2\nl1\n\ncommon\nx", *[f"p{i}\ncommon\nq{i}" for i in range(12)], "l1\nl2\nl3\n\ncommon"]
    rows = [(r[0], r[1], "s") for r in X.rows()] + [(700 + i, t, "s") for i, t in enumerate(extra)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").repartition(3)
    # equal ids are ordered by the key Spark hashes from id and text
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("\\N")), "text").alias("k")).collect()}
    want = brute_lines([(r[0], r[1], keys[r[0], r[1]]) for r in rows], least)
    got = line_dedup.dedup_lines(docs, rare_share=0.0, rare_least=least).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], want[r[0], r[1], keys[r[0], r[1]]]) for r in rows)
    assert line_dedup.dedup_lines(X.empty(spark)).count() == 0
    assert zlib.crc32(b"") == 0


def test_lines_of_many_texts_are_deleted(spark):
    docs = spark.createDataFrame([(i, f"p{i}\ncommon\nq{i}") for i in range(30)], "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in got} == {i: f"p{i}\nq{i}" if i else "p0\ncommon\nq0" for i in range(30)}


def brute_all_lines(rows):
    """Each document aligned with all earlier ones."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    lines = [[x for x in enumerate(r[1].split("\n")) if x[1].strip()] if r[1] is not None else [] for r in docs]
    out = {}
    for b, doc in enumerate(docs):
        gone = set()
        for a in range(b):
            common = {x for _, x in lines[a]} & {x for _, x in lines[b]}
            first, later = [x for _, x in lines[a] if x in common], [x for x in lines[b] if x[1] in common]
            gone |= {later[j][0] for j in line_dedup.patience(first, [x for _, x in later])}
        out[doc] = "\n".join(x for i, x in enumerate(doc[1].split("\n")) if i not in gone) if doc[1] is not None else None
    return out


def test_lines_of_all_earlier_documents(spark, monkeypatch):
    rng = random.Random(5)
    extra = [*[f"p{i}\ncommon\nq{i}" for i in range(30)],  # a line of many texts
             "r2\nr1", "r1\nr2", "r1\nr2",  # a block whose first line holder has another order
             "s", "c1\ns\nc2", "c1\ns\nc2", "m\nk\nm", "k\nm\nm", "m\nm\nk\nm", "u\nt\nv", "t\nu\nw\nv", "u\nw\nt\nv", "w\nu\nv\nt"]
    extra += ["\n".join(f"z{rng.randrange(9)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    rows = [(r[0], r[1], "s") for r in X.rows()] + [(700 + i, t, "s") for i, t in enumerate(extra)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").repartition(3)
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("\\N")), "text").alias("k")).collect()}
    want = brute_all_lines([(r[0], r[1], keys[r[0], r[1]]) for r in rows])
    monkeypatch.setattr(line_dedup, "HOLDERS", 8)
    got = line_dedup.dedup_lines(docs).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], want[r[0], r[1], keys[r[0], r[1]]]) for r in rows)
    assert {r.text for r in got if r.doc_id in (732, 735)} == {""}


def test_shared_lines_in_random_orders(spark):
    """All documents hold the same lines in other orders: aligned as all pairs would be, and each line stops at its first alignment."""
    import random
    rng = random.Random(6)
    pool = [f"line {i}" for i in range(12)]
    rows = [(i, "\n".join(rng.sample(pool, 12))) for i in range(150)] + [(200 + i, "\n".join(rng.sample(pool, 3) + [f"own {i}"] + rng.sample(pool, 2))) for i in range(60)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for k, (doc, text) in enumerate(rows):
        own, gone = text.split("\n"), set()
        for _, other in rows[:k]:
            common = set(own) & set(other.split("\n"))
            at = [j for j, x in enumerate(own) if x in common]
            gone |= {at[j] for j in line_dedup.patience([x for x in other.split("\n") if x in common], [own[j] for j in at])}
        assert got[doc] == "\n".join(x for j, x in enumerate(own) if j not in gone)


def test_hashing_holds_little_beyond_the_texts():
    """Temporary arrays and the library's encodings follow the slices, not the batch (checked over a batch of 4 MB)."""
    from tessera.llm import quality, tokens

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(5000):x}" for _ in range(400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = kernels.shingles(*kernels.text_bytes(batch.column("text")))[0]
    tracemalloc.start()
    parts = [kernels.shingles(*kernels.text_bytes(x.column("text")))[0] for x in kernels.slices(iter([batch]), "text")]
    held = sum(x.nbytes for x in parts)
    for x in kernels.slices(iter([batch]), "text"):
        quality.features(*kernels.text_bytes(x.column("text")))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(np.concatenate(parts), whole)
    assert peak - held < 12 << 20
    assert tokens.SLICE <= 1 << 17
