import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
from tessera.llm import embedding_dedup, minhash_dedup  # noqa: E402
from tessera.llm.components import components  # noqa: E402


def brute(rows):
    sets = [X.shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    label = X.components(len(rows), links)
    ids = {}
    for i, c in enumerate(label):
        if rows[i][0] is not None:
            ids[c] = min(ids.get(c, rows[i][0]), rows[i][0])
    return sorted(((r[0], len(s), ids.get(c)) for r, s, c in zip(rows, sets, label)), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_match_brute_force(spark, seed):
    rows = X.rows(seed)
    got = minhash_dedup.near_duplicates(X.table(spark, seed)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_through_members_that_are_no_pivot(spark):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(30):  # each text differs from the one before at five places
        base = base[:]
        base[(i * 6) % 200] = f"n{i}"
        rows.append((100 - i, " ".join(base)))
    rows += [(500 + i, " ".join(base[:150] + [f"u{i}_{k}" for k in range(30)])) for i in range(25)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_one_document_of_each_group_stays(spark):
    docs = X.table(spark)
    kept = minhash_dedup.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    groups = {}
    for r in minhash_dedup.near_duplicates(docs).collect():
        if r.n_shingles:
            groups.setdefault(r.component_id, []).append(r)
    without = [r for r in X.rows() if not X.words(r[1])]
    assert kept.count() == len(groups) + len(without)
    assert minhash_dedup.keep_one_per_group(X.empty(spark)).count() == 0
    assert minhash_dedup.near_duplicates(X.empty(spark)).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200, 202: 200, 300: 300, 301: 300}


def vectors():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 16))
    out = [(i, (centre[i % 6] + rng.normal(size=16) * 0.18).tolist(), i) for i in range(300)]
    out += [(1000 + i, rng.normal(size=16).tolist(), None) for i in range(200)]
    out += [(2000 + i, out[0][1], 1) for i in range(50)] + [(3000, [x * 1e200 for x in out[1][1]], 1)]
    bad = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [], [1.0, 0.0], [2.0, 0.0], [-0.0, 1.0]]
    return out + [(4000 + i, v, 0) for i, v in enumerate(bad)] + [(5, out[7][1], 0), (None, out[8][1], 0)]


def test_embeddings_match_brute_force(spark):
    rows = vectors()
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if u else None for (_, v, _), u in zip(rows, usable)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    label = X.components(len(rows), links)
    counts = np.bincount(np.array(links).ravel(), minlength=len(rows))
    ids = {}
    for i, c in enumerate(label):
        if rows[i][0] is not None:
            ids[c] = min(ids.get(c, rows[i][0]), rows[i][0])
    want = sorted(((r[0], int(n), ids.get(c)) for r, n, c in zip(rows, counts, label)), key=str)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node long").repartition(3)
    got = embedding_dedup.near_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_graph_search_without_exact_fallback():
    from tessera.llm.hnsw import Graph
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x = np.concatenate([x, x[:500] + rng.normal(size=(500, 24)) * 0.15])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    r, c = graph.within(x.astype(np.float32), 48, 0.9, 0.05)
    truth = set(map(tuple, np.argwhere(x @ x.T >= 0.9)))
    assert len(truth & set(zip(r.tolist(), c.tolist()))) >= 0.99 * len(truth)


def test_graphs_travel_in_pieces_and_links_are_not_all_held():
    """A task's memory follows neither the rows of its stream nor the number of links."""
    import tracemalloc

    import pyarrow as pa
    from tessera.llm.hnsw import Graph
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1, 16)) + rng.normal(size=(2500, 16)) * 0.05  # all near each other
    x[:40] = rng.normal(size=(40, 16)) * 1e200  # needs double precision
    unit = embedding_dedup._unit(x)
    blob = embedding_dedup._packed(np.arange(2500), np.full(2500, 2), x, Graph(unit))
    parts = [blob[i:i + 9999] for i in range(0, len(blob), 9999)]
    keys = [(16, 1, 0, -1, i, None, p) for i, p in enumerate(parts)] + [(16, 1, 0, b, i, x[i].tolist(), None) for b in (0, 2) for i in range(b, 2500, 4)]
    keys += [(16, 2, 0, 0, 1, x[1].tolist(), None)]  # a shard without a graph
    names = ["dim", "shard", "turn", "block", "at", "v", "piece"]
    types = [pa.int32()] * 4 + [pa.int64(), pa.list_(pa.float64()), pa.binary()]
    rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*keys), types)], names=names)
    run = embedding_dedup._asked(0.9, 32, 0.05, 16)
    out = pa.Table.from_batches(list(run(rows.slice(i, 700) for i in range(0, rows.num_rows, 700))))
    near = unit @ unit.T >= 0.9
    counts = {n: c for n, c, o in zip(*(out.column(c).to_pylist() for c in ("node", "links", "other"))) if o is None}
    assert counts == {i: int(2 * near[i].sum()) for b in (0, 2) for i in range(b, 2500, 4)}
    links = [(n, o) for n, o in zip(out.column("node").to_pylist(), out.column("other").to_pylist()) if o is not None]
    asked = [i for b in (0, 2) for i in range(b, 2500, 4)]
    label, want = X.components(2500, links), X.components(2500, [(i, j) for i in asked for j in np.flatnonzero(near[i]).tolist() if i != j])
    assert len(links) < 2 * 2500 and len(set(zip(label, want))) == len(set(want)) == len(set(label))
    graph, q = Graph(unit), unit[:2000]
    tracemalloc.start()
    n = sum(len(r) for r, _, _ in embedding_dedup._pairs(graph, unit, q, 0.9, 32, 0.05, 16))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0.9999 * near[:2000].sum() < n <= near[:2000].sum() and peak < 100 << 20


def test_graph_with_a_hub_is_built_in_little_memory():
    """Many new links of a node don't widen the rows of all others."""
    import tracemalloc

    from tessera.llm.hnsw import Graph
    rng = np.random.default_rng(7)
    x = np.concatenate([np.ones((1, 96)) * 0.4, rng.normal(size=(9000, 96)) + 0.8])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tracemalloc.start()
    Graph(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
