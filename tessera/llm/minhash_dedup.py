"""Near-duplicate documents by MinHash: a signature-coordinate inverted join.

Method. Each distinct shingle set gets a signature of ``coordinates`` minima. Every set is posted
under each (coordinate, value) pair. Values held by one set only are dropped; a set left with fewer
than ``matches`` postings cannot reach ``matches`` collisions with any other. The rest is ordered
rarest value first, and only the prefix of ``size - matches + 1`` postings is merged, since two sets with
``matches`` common postings must meet in their prefixes; the longest lists are so skipped. Pairs
that meet have their collisions counted on the whole signatures; those with ``matches`` or more are
confirmed on the full shingle sets.

Whole lists are never expanded into pairs. First each list is merged against one pivot (the set
with most copies), and each set is confirmed with the pivot whose signature is most like its own. Afterwards the sets that met one pivot
form a group, and only groups that still hold several components are compared: sets outside the largest component against
the members of other components, in pieces dealt over tasks. First on signatures alone: each set is confirmed with the member
most like it, until that finds no new link or leaves more than half of the rows that matched before. What then still matches in signature is compared on full sets inside tasks, which give
back confirmed links only. A pair inside one component needs no link, so the components lose none.

Texts are fetched once: those of sets that share a posting value with others are written to one table with their sizes and
signatures, by which all comparisons are served. Rows that match none of another component drop out of the later rounds:
components only grow together, so they can't match one then.

With 48 coordinates and 20 matches a pair at similarity 0.75 is missed with probability 2e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, discard, free_names, is_empty, written
from .components import components

COORDINATES = 48
MATCHES = 20
PIECE = 1 << 19  # shingles of one piece of a group; a task compares two pieces at a time
SEEN = 1 << 16  # (id, text hash) that a task remembers, so as to send a repeated row once
SENT = 1 << 20  # text bytes sent at a time


def _known_id(name: str = "doc_id"):
    """The id by which a set's text is fetched again; a null id stands for the smallest long."""
    return F.coalesce(F.col(name), F.lit(-(1 << 63)).cast("long"))


def _signatures(values: np.ndarray, off: np.ndarray, coordinates: int) -> np.ndarray:
    """Minimum of each seeded hash over each non-empty set, 32 bits a coordinate."""
    rows = np.flatnonzero(np.diff(off) > 0)
    out = np.zeros((len(off) - 1, coordinates), np.uint32)
    if not len(rows):
        return out
    high = (values >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = values.astype(np.uint32)
    for c in range(coordinates):
        # double hashing, then a multiply-xorshift round, all modulo 2^32
        x = low + np.uint32((c * 0x9E3779B1 + 1) & 0xFFFFFFFF) * high
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        out[rows, c] = np.minimum.reduceat(x, off[:-1][rows])
    return out


def _blobs(items: np.ndarray, width: int) -> pa.Array:
    """Rows of a contiguous array as Arrow binary values of ``width`` bytes."""
    flat = np.ascontiguousarray(items).view(np.uint8).reshape(-1)
    off = np.arange(len(flat) // width + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(flat)])


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                 coordinates: int = COORDINATES) -> DataFrame:
    """One narrow row per document: id, text hash, shingle count, 128-bit set key and signature."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            values, off = K.shingles(*K.text_bytes(batch.column("text")), words)
            n = np.diff(off)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
                    for x in (values, K.mix(values ^ np.uint64(0x5851F42D4C957F2D)))]
            key = [K.mix(s[off[1:]] - s[off[:-1]] + n.astype(np.uint64)).view(np.int64) for s in sums]
            sig = _signatures(values, off, coordinates)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n.astype(np.int64)),
                 pa.array(key[0]), pa.array(key[1]), _blobs(sig, 4 * coordinates)],
                names=["doc_id", "text_hash", "n_shingles", "k1", "k2", "sig"])

    return src.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, sig binary")


def _postings(nodes: DataFrame, coordinates: int) -> DataFrame:
    """(key, node) for every coordinate of every set; the key packs coordinate and value."""
    def run(batches):
        for batch in batches:
            sig = np.frombuffer(K.text_bytes_of(batch.column("sig")), np.uint32).reshape(-1, coordinates)
            key = sig.astype(np.int64) | (np.arange(coordinates, dtype=np.int64) << 32)
            node = np.repeat(batch.column("node").to_numpy(), coordinates)
            step = 1 << 16
            flat = key.reshape(-1)
            for i in range(0, len(flat), step):
                yield pa.RecordBatch.from_arrays([pa.array(flat[i:i + step]), pa.array(node[i:i + step])], names=["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def _prefixes(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(key, node): of each set, the rarest ``size - matches + 1`` of its postings that others share."""
    post = _postings(nodes, coordinates)
    shared = post.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    own = (post.join(shared, "key").groupBy("node")
           .agg(F.array_sort(F.collect_list(F.struct("f", "key"))).alias("p"))  # at most `coordinates` entries
           .where(F.size("p") >= matches))
    return own.select("node", F.explode(F.expr(f"slice(p, 1, size(p) - {matches} + 1)")).alias("e")).select("e.key", "node")


def _texts(docs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, n, sig, text) of every set in ``groups``, once each: the only pass over the texts after hashing."""
    wanted = groups.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash", "n", "sig"), "node")
    rows = docs.select(_known_id().alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in K.slices(batches, "text", SENT):
            kept = []
            for i, key in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist())):
                if key not in seen:
                    kept.append(i)
                    seen.add(key)
            if len(seen) > SEEN:
                seen.clear()
            yield batch.take(pa.array(kept, pa.int64()))

    sent = rows.mapInArrow(once, "doc_id long, text string, text_hash long")
    # dealt by the join's keys already, so repeated rows of several tasks go without another exchange
    return sent.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("node", "n", "sig", "text")


def _best_pivots(groups: DataFrame, texts: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(p, node): of the pivots that a set meets, the one whose whole signature agrees most, in ``matches`` coordinates or more."""
    side = lambda x, y: texts.select(F.col("node").alias(x), F.col("n").alias(f"n_{y}"), F.col("sig").alias(f"sig_{y}"))
    both = groups.where("p != node").join(side("p", "a"), "p").join(side("node", "b"), "node")
    both = both.where("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)")

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(K.text_bytes_of(batch.column(c)), np.uint32).reshape(-1, coordinates) for c in ("sig_a", "sig_b"))
            same = (x == y).sum(1)
            hit = np.flatnonzero(same >= matches)
            if len(hit):
                at = pa.array(hit)
                yield pa.RecordBatch.from_arrays([batch.column("p").take(at), batch.column("node").take(at), pa.array(same[hit].astype(np.int32))], names=["p", "node", "hits"])

    found = both.select("p", "node", "sig_a", "sig_b").mapInArrow(run, "p long, node long, hits int")
    return found.groupBy("node").agg(F.max(F.struct("hits", "p")).getField("p").alias("p")).select("p", "node")


def _pieces(n: str) -> str:
    return f"cast(greatest(1, ceil({n} / {PIECE})) as int)"


def _own_piece(n: str):
    return F.expr(f"cast(pmod(xxhash64(node), {n}) as int)")


_DEALT = ["p", "i", "j", "asks", "node", "c", "n", "sig"]


def _in_pieces(rows: DataFrame, run, schema: str) -> DataFrame:
    """Rows dealt by (p, i, j); ``run(table)`` gets the rows of one pair of pieces at a time."""
    def stream(batches):
        held, at = [], None
        for batch in batches:
            keys = [batch.column(x).to_numpy() for x in ("p", "i", "j")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            cuts = [0, *change.tolist(), batch.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                now = tuple(int(k[x]) for k in keys) if y > x else at
                if held and now != at:
                    yield from run(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(x, y - x))
                at = now
        if held:
            yield from run(pa.Table.from_batches(held))

    return rows.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j").mapInArrow(stream, schema)


def _alike(table: pa.Table, coordinates: int, matches: int):
    """(ask, others, hits) by row number: members of other components whose size and signature allow a link."""
    column = lambda x: table.column(x).chunk(0)
    sig = np.frombuffer(K.text_bytes_of(column("sig")), np.uint32).reshape(-1, coordinates)
    c, n = (column(x).to_numpy() for x in ("c", "n"))
    ask = column("asks").to_numpy(zero_copy_only=False)
    others = np.flatnonzero(~ask)
    for i in np.flatnonzero(ask):
        o = others[(c[others] != c[i]) & (100 * np.minimum(n[others], n[i]) >= 75 * np.maximum(n[others], n[i]))]
        hits = (sig[o] == sig[i]).sum(1)
        if len(o := o[kept := hits >= matches]):
            yield i, o, hits[kept]


def _links(rows: DataFrame, words: int, coordinates: int, matches: int) -> DataFrame:
    """(a, b) confirmed on full sets, 100 * intersection >= 75 * union: of each asking row, one link to each component."""
    def run(table):
        table = table.combine_chunks()
        node, c = (table.column(x).chunk(0).to_numpy() for x in ("node", "c"))
        values = off = None
        found = []
        for i, o, _ in _alike(table, coordinates, matches):
            if values is None:
                values, off = K.shingles(*K.text_bytes(table.column("text").chunk(0)), words)
            size = off[o + 1] - off[o]
            at = np.repeat(off[o] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            mine = values[off[i]:off[i + 1]]
            place = np.minimum(np.searchsorted(mine, values[at]), len(mine) - 1)
            inter = np.bincount(np.repeat(np.arange(len(o)), size), mine[place] == values[at], len(o)).astype(np.int64)
            o = o[100 * inter >= 75 * (size + len(mine) - inter)]
            o = o[np.unique(c[o], return_index=True)[1]]
            found += [(int(node[i]), int(x)) for x in node[o]]
        if found:
            a, b = np.array(found, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    return _in_pieces(rows, run, "a long, b long")  # repeated ones go with the components' own


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, coordinates: int, matches: int) -> DataFrame:
    """Links among the pairs (p, node). The sets of one p are dealt in pieces, each with a copy of p."""
    sized = pairs.join(texts.select("node", "n"), "node")
    pieces = sized.groupBy("p").agg(F.expr(_pieces("sum(n)")).alias("mp"))
    members = (pairs.join(pieces, "p").join(texts, "node")
               .withColumns({"i": _own_piece("mp"), "j": F.lit(0), "asks": F.lit(False), "c": F.col("node")}).select(*_DEALT, "text"))
    asks = (pieces.withColumn("node", F.col("p")).join(texts, "node").withColumn("i", F.explode(F.expr("sequence(0, mp - 1)")))
            .withColumns({"j": F.lit(0), "asks": F.lit(True), "c": F.col("node")}).select(*_DEALT, "text"))
    return _links(members.unionByName(asks), words, coordinates, matches)


def _dealt(rows: DataFrame, more: list[str]) -> DataFrame:
    """Rows (p, node, c, n, sig) of groups with several components, as asking rows (outside the group's largest component) and
    members, in pieces of ``PIECE`` shingles: every asking piece meets every member piece."""
    per = rows.groupBy("p", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    open_ = per.groupBy("p").agg(F.count(F.lit(1)).alias("cs"), F.sum("n").alias("all"), F.max(F.struct("k", "c", "n")).alias("top")).where("cs > 1")
    open_ = open_.select("p", F.col("top.c").alias("main"), F.expr(_pieces("all")).alias("mp"), F.expr(_pieces("all - top.n")).alias("ap"))
    piece = lambda n: f"cast(pmod(xxhash64(node), {n}) as int)"
    member = f"transform(sequence(0, ap - 1), x -> named_struct('i', {piece('mp')}, 'j', x, 'asks', false))"
    asking = f"transform(slice(sequence(0, mp - 1), 1, if(c != main, mp, 0)), x -> named_struct('i', x, 'j', {piece('ap')}, 'asks', true))"
    dealt = rows.join(open_, "p").withColumn("d", F.explode(F.expr(f"concat({member}, {asking})")))
    return dealt.withColumns({x: F.col(f"d.{x}") for x in ("i", "j", "asks")}).select(*_DEALT, *more)


def _open_rows(groups: DataFrame, texts: DataFrame, label: DataFrame) -> DataFrame:
    known = groups.join(label, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    return known.join(texts.select("node", "n", "sig"), "node")


def _matches(rows: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(p, node, best, hits): rows that match one of another component in signature; asking rows with the member most like them."""
    def run(table):
        table = table.combine_chunks()
        node, p = table.column("node").chunk(0).to_numpy(), table.column("p").chunk(0)[0].as_py()
        met, found = np.zeros(len(node), bool), []
        for i, o, hits in _alike(table, coordinates, matches):
            met[o] = True
            k = int(np.argmax(hits))
            found.append((int(node[i]), int(node[o[k]]), int(hits[k])))
        found += [(int(x), None, None) for x in node[met]]
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array([p] * len(found), pa.int64()), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32())))],
                                             names=["p", "node", "best", "hits"])

    return _in_pieces(_dealt(rows, []), run, "p long, node long, best long, hits int")


def _components_of(groups: DataFrame, texts: DataFrame, words: int, coordinates: int, matches: int) -> DataFrame:
    """(node, component) of all sets with a link."""
    def joined(label: DataFrame, more: DataFrame) -> DataFrame:
        """Components after ``more`` links; those known stand for the links that made them."""
        return components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    check = lambda pairs: cut(_confirmed(pairs, texts, words, coordinates, matches))
    label = components(check(_best_pivots(groups, texts, coordinates, matches)))
    before = None
    while True:
        rows = _open_rows(groups, texts, label)
        met = cut(_matches(rows, coordinates, matches))
        if not (n := met.count()):
            break
        groups = met.select("p", "node").distinct()
        if before is None or 2 * n <= before:  # so rounds are few whatever the rows
            before = n
            pairs = met.where("best is not null").groupBy("node").agg(F.max(F.struct("hits", "best")).getField("best").alias("p")).select("p", "node")
            more = check(pairs)
            if not is_empty(more):
                label = joined(label, more)
                continue
        left = rows.join(groups, ["p", "node"]).join(texts.select("node", "text"), "node")
        more = cut(_links(_dealt(left, ["text"]), words, coordinates, matches))
        if not is_empty(more):
            label = joined(label, more)
        break
    return cut(label)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component_id, kept.

    Texts are linked when their sets of distinct ``words``-word shingles (A-Z folded) have a
    similarity of 0.75 or more; ``component_id`` is the smallest id reachable, ``kept`` marks it.

    Null or empty texts and texts without words have an empty set, link with nothing and keep their
    own id. A text with fewer words is one shingle. Rows with equal texts share a component; a
    repeated id with equal text is returned as often as it came, each kept if the id is the smallest. A null id can never be the smallest
    unless its whole component has null ids (then component_id is null and kept true). An empty table
    gives an empty result. Other columns are ignored whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = cut(shingle_sets(src, words=words, coordinates=coordinates))
    nodes = cut(sets.where("n_shingles > 0").groupBy("k1", "k2")
                .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"),
                     F.min_by(F.struct(_known_id().alias("doc_id"), "text_hash", "sig"), F.struct(_known_id(), "text_hash")).alias("r"))
                .select("k1", "k2", "first_id", "copies", "n", "r.doc_id", "r.text_hash", "r.sig")
                .withColumn("node", F.monotonically_increasing_id()))
    prefixes = cut(_prefixes(nodes, coordinates, matches))
    # every list is merged against its pivot, the set with most copies
    ranked = prefixes.join(nodes.select("node", "copies"), "node")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("copies", "node")).getField("node").alias("p"))
    groups = cut(prefixes.join(pivots, "key").select("p", "node").distinct())
    texts, path = written(_texts(src, nodes, groups), "texts")
    label = _components_of(groups, texts, words, coordinates, matches)
    discard(docs.sparkSession, path)
    named = nodes.join(label, "node", "left").withColumn("c", F.coalesce("component", "node"))
    lowest = named.groupBy("c").agg(F.min("first_id").alias("lowest"))
    by_set = named.join(lowest, "c").select("k1", "k2", "lowest")
    full = sets.where("n_shingles > 0").join(by_set, ["k1", "k2"], "left")
    alone = sets.where("n_shingles = 0").withColumn("lowest", F.col("doc_id"))
    return full.unionByName(alone).select("doc_id", "text_hash", "n_shingles", F.col("lowest").alias("component_id"),
                                          F.col("doc_id").eqNullSafe(F.col("lowest")).alias("kept"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one row of each near-duplicate group (all columns as they came).

    The row with the group's smallest id stays; of repeated rows with that id one, chosen by the
    smallest text hash, so exactly one row of a group survives. Documents without words all stay. What goes is decided on ids and
    hashes; texts travel once, to be joined with that. Columns may have any names; an empty table gives none.
    """
    found = cut(near_duplicates(docs, id_col, text_col, **options).where("n_shingles > 0"))
    stays = found.groupBy("component_id").agg(F.min(F.when(F.col("kept"), F.struct("doc_id", "text_hash"))).alias("r"))
    each = found.groupBy("doc_id", "text_hash", "component_id").agg(F.count(F.lit(1)).alias("n")).join(
        stays.withColumnRenamed("component_id", "c"), F.col("component_id").eqNullSafe(F.col("c")))
    one = F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("text_hash").eqNullSafe(F.col("r.text_hash"))
    ident, text_hash, i, h = free_names(docs, "_id", "_hash", "_i", "_h")
    # ids and hashes of rows that go, and of rows that stay once though they came several times
    fate = cut(each.where(~one | (F.col("n") > 1)).select(F.col("doc_id").alias(i), F.col("text_hash").alias(h), one.alias("once")))
    rows = docs.withColumns({ident: F.col(f"`{id_col}`").cast("long"), text_hash: F.xxhash64(F.col(f"`{text_col}`").cast("string"))})
    same = F.col(ident).eqNullSafe(F.col(i)) & (F.col(text_hash) == F.col(h))
    kept = rows.join(fate.select(i, h), same, "left_anti").drop(ident, text_hash)
    repeated = fate.where("once").select(i, h)
    if is_empty(repeated):
        return kept
    once = rows.join(repeated, same).drop(i, h).dropDuplicates([ident, text_hash]).drop(ident, text_hash)
    return kept.unionByName(once)
