"""Near-duplicate embeddings: a small-world graph per shard, every shard queried, cosine verified.

Equal vectors are taken together first, with their number, so copies cost nothing. Distinct vectors are dealt to
shards by hash, and each shard's graph is built in one task. Every vector queries every shard, in blocks of
queries. In each (shard, block) an audit compares sampled queries with brute force over the
shard; while it misses links, the beam is doubled and the margin grows, and after three failures the block scans the shard. Hits are verified with cosine in double
precision. A task gives back counts per query and a spanning forest of its links, never all pairs of a group.

A task holds one graph and one block of queries: the graph comes in pieces of ``PIECE`` bytes and several blocks follow it, so
no row is as large as a shard, a graph is sent once for ``TURN`` queries, and pairs are counted and dropped as they are found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components
from .hnsw import Graph

SHARDS = 6
SHARD_ROWS = 1 << 16  # more shards are made so that none expects more vectors
BLOCK_ROWS = 1 << 13
TURN = 1 << 16  # queries that one copy of a graph answers; fewer where cores would be idle
PIECE = 1 << 20  # bytes of a graph in one row
PAIRS = 1 << 18  # links verified at once
SPREAD = 8  # partitions for each group, so that few groups share one (a set number isn't merged again)
AUDIT = 256
BEAM = 32
WIDER = 4  # beams up to so many times the first are tried, then the shard is scanned
SLACK = 0.05


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a float64 list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, np.float64)
    for i in range(0, len(x), BLOCK_ROWS):
        part = x[i:i + BLOCK_ROWS].astype(np.float64)
        part /= np.abs(part).max(1, keepdims=True)  # keeps squares of very large or small numbers in range
        out[i:i + BLOCK_ROWS] = part / np.sqrt((part * part).sum(1, keepdims=True))
    return out


def _packed(nodes: np.ndarray, copies: np.ndarray, x: np.ndarray, graph: Graph) -> bytes:
    """A shard as bytes; its vectors in single precision if that loses nothing."""
    with np.errstate(over="ignore", under="ignore"):
        narrow = x.astype("<f4")
    kept = narrow if np.array_equal(narrow, x) else x.astype("<f8")
    parts = [np.array([len(x), kept.itemsize], "<i8"), nodes.astype("<i8"), copies.astype("<i8"), kept, *(k.astype("<i4") for k in graph.links)]
    return b"".join(np.ascontiguousarray(a).tobytes() for a in parts)


def _unpacked(blob: bytes, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    """Nodes, copies, unit vectors and graph of ``_packed``."""
    n, width = np.frombuffer(blob, "<i8", 2).tolist()
    nodes, copies = np.frombuffer(blob, "<i8", 2 * n, 16).reshape(2, n)
    x = _unit(np.frombuffer(blob, f"<f{width}", n * dim, 16 + 16 * n).reshape(n, dim))
    return nodes, copies, x, restored(x, np.frombuffer(blob, "<i4", -1, 16 + 16 * n + width * n * dim))


class _Forest:
    """A spanning forest of links that come in parts: of each part the links that join what was apart."""

    def __init__(self, nodes: int):
        self.label = np.arange(nodes)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """For each group the link to its smallest neighbour in rounds, as the groups shrink."""
        while True:
            la, lb = self.label[a], self.label[b]
            open_ = la != lb
            if not open_.any():
                return
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            hi, lo = np.maximum(la, lb), np.minimum(la, lb)
            order = np.lexsort((lo, hi))
            first = np.ones(len(order), bool)
            first[1:] = hi[order][1:] != hi[order][:-1]
            used = order[first]
            self.a.append(a[used])
            self.b.append(b[used])
            parent = np.arange(len(self.label))
            parent[hi[used]] = lo[used]
            while not np.array_equal(parent, parent[parent]):
                parent = parent[parent]
            self.label = parent[self.label]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return np.concatenate(self.a or none), np.concatenate(self.b or none)


def _scanned(queries: np.ndarray, shard: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of all pairs of single precision whose cosine may be ``least`` or more, by brute force, tile by tile."""
    least = np.float32(least - max(1e-5, 2.0 ** -22 * queries.shape[1]))  # more than rounding takes
    for i in range(0, len(queries), 256):
        for j in range(0, len(shard), 2048):
            nodes = shard[j:j + 2048]
            hit = np.flatnonzero((queries[i:i + 256] @ nodes.T >= least).ravel())
            if len(hit):
                r, c = np.divmod(hit, len(nodes))
                yield r + i, c + j


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in parts of ``PAIRS`` or little more."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _verified(found: Iterator[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, shard: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs those with cosine >= ``least`` in double precision."""
    for rows, nodes in _gathered(found):
        sims = np.concatenate([np.einsum("rd,rd->r", queries[rows[i:i + (1 << 13)]], shard[nodes[i:i + (1 << 13)]])
                               for i in range(0, len(rows), 1 << 13)])
        ok = sims >= least
        yield rows[ok], nodes[ok]


def _pairs(graph: Graph, shard: np.ndarray, queries: np.ndarray, least: float, beam: int, slack: float, audit: int) -> Iterator[tuple]:
    """(query, node, beam) in parts: pairs with cosine >= ``least``, the beam widened until the audit misses nothing."""
    if not len(queries):
        return
    q32 = queries.astype(np.float32)
    margin = 1e-5  # of single precision; verified below
    sample = np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(np.int64)
    most = beam * WIDER
    while beam <= most and beam < len(shard):
        missed = np.zeros((len(sample), len(shard)), bool)
        for r, c in _verified(_scanned(q32[sample], graph.x, least), queries[sample], shard, least):
            missed[r, c] = True
        for r, c in graph.within_parts(q32[sample], beam, least - margin, slack):
            missed[r, c] = False
        if not missed.any():
            found = graph.within_parts(q32, beam, least - margin, slack)
            break
        beam, slack = beam * 2, slack + SLACK
    else:  # exact
        found = _scanned(q32, graph.x, least)
    for rows, nodes in _verified(found, queries, shard, least):
        yield rows, nodes, beam


def _answered(ids: np.ndarray, q: np.ndarray, shard: tuple, least: float, beam: int, slack: float, audit: int) -> pa.RecordBatch:
    """What a block of queries finds in a shard: counts of links and a spanning forest of them."""
    nodes, copies, x, graph = shard
    known, place = np.unique(np.concatenate([ids, nodes]), return_inverse=True)
    counts, tree, used = np.zeros(len(ids), np.int64), _Forest(len(known)), beam
    for r, c, used in _pairs(graph, x, q, least, beam, slack, audit):
        counts += np.bincount(r, copies[c], minlength=len(ids)).astype(np.int64)
        other = nodes[c] != ids[r]
        tree.add(place[:len(ids)][r[other]], place[len(ids):][c[other]])
    some = np.flatnonzero(counts)
    a, b = tree.links()
    blank = np.arange(len(some) + len(a)) < len(some)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([ids[some], known[a]])), pa.array(np.concatenate([counts[some], np.zeros(len(a), np.int64)])),
        pa.array(np.concatenate([np.zeros(len(some), np.int64), known[b]]), mask=blank), pa.array(np.full(len(blank), used, np.int64))],
        names=["node", "links", "other", "beam"])


def _asked(least: float, beam: int, slack: float, audit: int):
    """Answers to a stream sorted by (dim, shard, turn, block, at): the pieces of a graph (block -1), then its blocks of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, held, shard = None, [], [], None

        def answers():
            nonlocal pieces, held, shard
            if not held:
                return
            if pieces:
                shard = _unpacked(b"".join(pieces), key[0])
            queries, pieces, held = pa.Table.from_batches(held), [], []
            if shard is not None:
                yield _answered(queries.column("at").to_numpy(), _unit(_vectors(queries.column("v"))), shard, least, beam, slack, audit)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "turn", "block")], 1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                now = tuple(keys[a].tolist())
                if now != key:
                    yield from answers()
                    if key is None or now[:3] != key[:3]:
                        pieces, shard = [], None
                    key = now
                if now[3] < 0:
                    pieces += batch.column("piece").slice(a, b - a).to_pylist()
                else:
                    held.append(batch.select(["at", "v"]).slice(a, b - a))
        yield from answers()
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9,
                 shards: int = SHARDS, beam: int = BEAM, slack: float = SLACK, audit: int = AUDIT) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine is ``least`` or more, whatever other columns say. ``n_links``
    counts the other rows linked directly, copies included. Null or zero vectors and vectors with null or non-finite components link with
    nothing, copies of them neither; vectors of different lengths are not comparable. A repeated id is a row of its own in
    the counts. ``component_id`` is the smallest id reachable (null only if all are null). An empty table gives none.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    inf = float("inf")
    good = (F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
            & F.exists("v", lambda x: x != 0))
    rows = src.withColumn("good", F.coalesce(good, F.lit(False)))
    v = F.transform("v", lambda x: x + 0.0)  # -0.0 and 0.0 are one
    same = rows.where("good").groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    distinct = cut(same.withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("v"))).withColumn("node", F.monotonically_increasing_id())
    n = distinct.count()
    shards = max(shards, math.ceil(n / SHARD_ROWS))
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    cores = distinct.sparkSession.sparkContext.defaultParallelism
    turns = min(blocks, max(math.ceil(n / TURN), math.ceil(4 * cores / shards)))

    def build(table):
        x = _vectors(table.column("v"))
        blob = _packed(table.column("node").to_numpy(), table.column("copies").to_numpy(), x, Graph(_unit(x)))
        pieces = [blob[i:i + PIECE] for i in range(0, len(blob), PIECE)]
        same = np.zeros(len(pieces), np.int64)
        return pa.table({"dim": table.column("dim").take(pa.array(same)), "shard": table.column("shard").take(pa.array(same)),
                         "at": pa.array(np.arange(len(pieces))), "piece": pa.array(pieces, pa.binary())})

    dealt = distinct.withColumn("shard", F.expr(f"cast(pmod(h, {shards}) as int)")).repartition(shards * SPREAD, "dim", "shard")
    graphs = cut(dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, at long, piece binary"))
    asked = graphs.select("dim", "shard", F.explode(F.expr(f"sequence(0, {turns - 1})")).alias("turn"), F.lit(-1).alias("block"), "at",
                          F.array().cast("array<double>").alias("v"), "piece")
    block = F.expr(f"cast(pmod(shiftright(h, 20), {blocks}) as int)")
    queries = distinct.select("dim", "node", "v", block.alias("block"))
    queries = queries.select("dim", F.explode(F.expr(f"sequence(0, {shards - 1})")).alias("shard"), F.expr(f"block % {turns}").alias("turn"), "block",
                             F.col("node").alias("at"), "v", F.lit(bytearray()).alias("piece"))
    order = ["dim", "shard", "turn", "block", "at"]
    stream = asked.unionByName(queries).repartition(shards * turns * 2, "dim", "shard", "turn").sortWithinPartitions(*order)
    # no nulls in the stream: Spark looks through all nulls of a batch again for each row that it adds
    answers = cut(stream.mapInArrow(_asked(least, beam, slack, audit), "node long, links long, other long, beam long"))
    counts = answers.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(answers.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = distinct.join(counts, "node", "left").join(label, "node", "left").withColumn("c", F.coalesce("component", "node"))
    lowest = named.groupBy("c").agg(F.min("first_id").alias("lowest"))
    # a vector always meets itself: its cosine with itself is 1, so its own copies are counted even if no search met them
    per = named.join(lowest, "c").select("v", "lowest", F.greatest(F.coalesce("links", F.lit(0)), F.col("copies")).alias("links"))
    whole = rows.where("good").withColumn("v", v).join(per, "v").select("vec_id", (F.col("links") - 1).alias("n_links"), F.col("lowest").alias("component_id"))
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def restored(vectors: np.ndarray, packed: np.ndarray) -> Graph:
    """A graph from its unit vectors and links (levels and order follow from the seed)."""
    graph = Graph(vectors[:0])
    fresh = Graph.__new__(Graph)
    fresh.__dict__.update(graph.__dict__)
    fresh.x = np.ascontiguousarray(vectors, np.float32)
    n, rng = len(vectors), np.random.default_rng(7)
    fresh.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(fresh.degree)).astype(np.int64), 8)
    fresh.order = np.argsort(-fresh.level, kind="stable")
    fresh.links, at = [], 0
    for layer in range(int(fresh.level[fresh.order[0]]) + 1 if n else 1):
        size = n * fresh._width(layer)
        fresh.links.append(packed[at:at + size].reshape(n, fresh._width(layer)))
        at += size
    return fresh
