import sys
import zlib
from collections import Counter
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
pytest.importorskip("public_tokenizers")
from tessera.llm import kernels, packing, token_files, tokens  # noqa: E402


@lru_cache
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return t


def plain(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


ODD = ["a  b", " a", "a \n b", "a\n\nb", "\nA", " \nA", "é b", "é  b", "x  y", "x  y", "　 y", "y 　", "é ", "a\tb c", "don't we'll", "a\x1c b", "\x85 a",
       "end\n", "\n", " ", "  ", "a   b", "tab\t\tx", "1 2\n3", "中文 文字 abc", "a\r\nb", "'s 's", "é\nB", "B\né"]


def test_chunked_ids_equal_whole_texts():
    texts = [*X.texts(), *ODD, *(a + b for a in ODD for b in ODD)]
    cache = tokens.ChunkCache(tokens.default_path())
    for _ in range(2):  # the second time from the cache
        ids, counts = cache.ids(*kernels.text_bytes(pa.array(texts)))
        at = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == plain(t), repr(t)[:80]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_and_sequences(spark):
    docs = X.table(spark)
    got = packing.pack(docs, capacity=256).collect()
    want = Counter()
    for r in X.rows():
        ids = plain(r[1]) + [0]
        k = -(-len(ids) // 256)
        start = 0
        for piece in range(k):
            size = len(ids) - (k - 1) * 256 if piece == 0 else 256
            want[r[0], piece, start, size, crc(ids[start:start + size])] += 1
            start += size
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    # 22 sequences beside the full pieces cannot hold these: of 41 pieces over 85 two fit at most (180 and 185 with none), and what
    # 20 pairs and they leave free takes six of the eight pieces of 42 to 60, so one more than the bound is the optimum
    assert len(sequences) <= packing.lower_bound(Counter(r.length for r in got), 256) + 1
    assert packing.pack(X.empty(spark)).count() == 0


def optimum(items, capacity):
    """Fewest bins by exhaustive search over a few items."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins) if b + items[i] <= capacity}.values():
            place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_search_reaches_the_optimum_of_small_cases():
    rng = np.random.default_rng(8)
    for _ in range(40):
        items = rng.integers(8, 60, 11).tolist()
        counts = Counter(items)
        plan = packing.fill(counts, 100, nodes=2000)
        assert all(sum(p) <= 100 for p, _ in plan)
        used = Counter()
        for p, times in plan:
            for n in p:
                used[n] += times
        assert used == counts
        best = optimum(items, 100)
        assert packing.lower_bound(counts, 100) <= best == sum(t for _, t in plan)


def test_bound_never_exceeds_the_optimum_and_lists_are_undominated():
    rng = np.random.default_rng(4)
    for _ in range(60):
        items = rng.integers(1, 101, 8).tolist()
        assert packing.lower_bound(Counter(items), 100) <= optimum(items, 100)
        counts = Counter(items)
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums if s + n <= 70}
        found = packing.completions(sorted(counts), counts, 70)
        assert sum(found[0]) == max(sums)
        assert all(not Counter(f) - counts and sum(f) in sums for f in found) and len(set(found)) == len(found)


def test_search_improves_hard_tables_in_seconds():
    rng = np.random.default_rng(2)
    for low, high, n, gap in ((300, 800, 2000, 6), (500, 1000, 300, 12)):
        counts = Counter(rng.integers(low, high + 1, n).tolist())
        plan = packing.fill(counts, nodes=3000)
        used = Counter()
        for p, times in plan:
            assert sum(p) <= 2048
            for x in p:
                used[x] += times
        assert used == counts and sum(t for _, t in plan) <= packing.lower_bound(counts, 2048) + gap


def test_fill_many_and_hard_counts():
    assert packing.fill({}, 10) == []
    assert sum(t for _, t in packing.fill({10: 5}, 10)) == 5
    big = {n: 10**9 + n for n in range(1, 2049)}
    plan = packing.fill(big, 2048)
    assert sum(t for _, t in plan) == packing.lower_bound(big, 2048)


def test_token_files_round_trip(spark, tmp_path):
    docs = X.table(spark)
    target = str(tmp_path / "tokens")
    token_files.write(docs, target, page_rows=5)
    rows = token_files.read(spark, target).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((r[0], tuple([*plain(r[1]), 0])) for r in X.rows())
    assert all(r.n_tokens == len(r.ids) for r in rows)
    ids = [None if v is None else v for f in sorted(Path(target).glob("part-*")) for v in pq.read_table(f)["doc_id"].to_pylist()]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    at = 0
    digests = {}
    for r in token_files.digests(spark, target).collect():
        digests[r.start] = r
    for f in sorted(Path(target).glob("part-*")):
        for x in pq.read_table(f).to_pylist():
            assert (digests[at].doc_id, digests[at].n_tokens, digests[at].ids_crc32) == (x["doc_id"], len(x["ids"]), crc(x["ids"]))
            at += len(x["ids"])
    meta = pq.ParquetFile(next(f for f in Path(target).glob("part-*") if pq.ParquetFile(f).metadata.num_rows)).metadata
    column = meta.row_group(0).column(0)
    assert column.has_offset_index and column.has_column_index
    narrow = token_files.read(spark, target, F.col("doc_id") > 50, ("doc_id", "n_tokens"))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(doc_id,50)" in plan and "ids" not in plan.split("ReadSchema")[1]
    empty = str(tmp_path / "none")
    token_files.write(X.empty(spark), empty)
    assert token_files.digests(spark, empty).count() == 0
