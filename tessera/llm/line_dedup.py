"""Line de-duplication by pairwise alignment (patience diff).

A line is shared if several documents hold it, and deleted from a document where it is aligned with any earlier one.
A pair's common lines are aligned: lines unique in both are matched by the longest increasing subsequence of their
places, then the gaps between matches in the same way.

First, each document is paired with the first holder of each of its shared lines, of each two neighbours among them and
of all of them in order, so a line gives at most three partners, never all pairs of its holders. Second, lines that are still
left though an earlier document holds them are compared with their earlier holders, in pieces of holders inside tasks, until the line is
aligned with one of them: first with one piece of the holders, what is then still left with all pieces. Holders alike in their
shared lines are compared once. So the result is that of aligning all pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, free_names, is_empty

HOLDERS = 1 << 12  # holders of a line that one task compares with the documents where the line is left
REBUILT = 1 << 20  # text bytes rebuilt at a time


def patience(first: list[int], later: list[int]) -> list[int]:
    """Indices of ``later`` aligned with ``first``; both are line hashes in document order."""
    aligned: list[int] = []
    todo = [(0, len(first), 0, len(later))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and first[a] == later[c]:
            aligned.append(c)
            a, c = a + 1, c + 1
        while a < b and c < d and first[b - 1] == later[d - 1]:
            aligned.append(d - 1)
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        once_a, once_b = Counter(first[a:b]), Counter(later[c:d])
        at = {h: j for j, h in enumerate(later[c:d], c) if once_b[h] == 1}
        pairs = [(i, at[h]) for i, h in enumerate(first[a:b], a) if once_a[h] == 1 and h in at]
        tails: list[int] = []
        ends: list[int] = []
        back: list[int] = []
        for k, (_, j) in enumerate(pairs):
            p = bisect_left(tails, j)
            if p == len(tails):
                tails.append(j)
                ends.append(k)
            else:
                tails[p], ends[p] = j, k
            back.append(ends[p - 1] if p else -1)
        chain = []
        k = ends[-1] if ends else -1
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        if not chain:
            continue
        lo_a, lo_c = a, c
        for i, j in reversed(chain):
            aligned.append(j)
            todo.append((lo_a, i, lo_c, j))
            lo_a, lo_c = i + 1, j + 1
        todo.append((lo_a, b, lo_c, d))
    return aligned


def _key(id_col: str, text_col: str) -> Column:
    """One number for equal id and text."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\\N")), F.col(text_col).cast("string"))


def _most(own: DataFrame, rare_share: float | None, rare_least: int | None) -> int:
    """Texts that may hold a rare line."""
    texts = own.agg(F.approx_count_distinct("_t", 0.01)).first()[0] if rare_share else 0
    return max(rare_least or 0, int((rare_share or 0) * texts))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        later, gone = batch.column("later").to_pylist(), []
        for common in batch.column("common"):
            common = common.as_py()
            a = sorted((p, x["line"]) for x in common for p in x["fp"])
            b = sorted((p, x["line"]) for x in common for p in x["lp"])
            gone.append(sorted(b[j][0] for j in patience([h for _, h in a], [h for _, h in b])))
        yield pa.RecordBatch.from_arrays([pa.array(later, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["_key", "gone"])


def _compare(key: tuple, holders: pa.Table, left: pa.Table) -> pa.Table:
    """Aligns each document of ``left`` with earlier ``holders`` of one line, until that line is aligned."""
    wanted = key[0].as_py()

    def ordered(table):
        for i, key, seq in zip(table["_id"].to_pylist(), table["_key"].to_pylist(), table["seq"].to_pylist()):
            yield (i is not None, i or 0, key), [x["pos"] for x in seq], [x["line"] for x in seq]

    alike: dict[tuple, tuple] = {}  # the earliest of documents that have the same shared lines
    for order, _, lines in ordered(holders):
        lines = tuple(lines)
        alike[lines] = min(order, alike.get(lines, order))
    held = sorted((order, lines, frozenset(lines)) for lines, order in alike.items())
    keys, gone = [], []
    for order, places, lines in ordered(left):
        own, found, seen = frozenset(lines), set(), set()
        open_ = {p for p, x in zip(places, lines) if x == wanted}
        for other, theirs, their_own in held:
            if other >= order or not open_:
                break
            common = own & their_own
            first = tuple(x for x in theirs if x in common)
            if first not in seen:
                seen.add(first)
                at = [j for j, x in enumerate(lines) if x in common]
                now = {places[at[j]] for j in patience(list(first), [lines[j] for j in at])}
                found |= now
                open_ -= now
        keys.append(order[2])
        gone.append(sorted(found))
    return pa.table({"_key": pa.array(keys, pa.int64()), "gone": pa.array(gone, pa.list_(pa.int32()))})


def _aligned_firsts(mine: DataFrame, pairs: DataFrame) -> DataFrame:
    """(_key, gone): places of each later document aligned with one first document."""
    theirs = pairs.join(mine.select(F.col("_key").alias("later"), "line", F.col("pos").alias("lp")), "later")
    both = theirs.join(mine.select(F.col("_key").alias("first"), "line", F.col("pos").alias("fp")), ["first", "line"])
    listed = both.groupBy("first", "later").agg(F.collect_list(F.struct("line", "fp", "lp")).alias("common"))
    return listed.mapInArrow(_align, "_key long, gone array<int>")


def _united(found: DataFrame) -> DataFrame:
    return found.groupBy("_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("lines")).where("size(lines) > 0")


def _sequences(mine: DataFrame) -> DataFrame:
    """(_id, _key, seq): all shared lines of a document in its order."""
    places = F.transform("pos", lambda p: F.struct(p.alias("pos"), F.col("line").alias("line")))
    return mine.groupBy("_id", "_key").agg(F.array_sort(F.flatten(F.collect_list(places))).alias("seq"))


def _left(mine: DataFrame, found: DataFrame) -> DataFrame:
    """(_key, line): lines that ``found`` leaves in a document though an earlier one holds them."""
    rows = mine.where("_key != first").join(found, "_key", "left")
    return rows.where("lines is null or size(array_except(pos, lines)) > 0").select("_key", "line")


def _aligned_left(mine: DataFrame, left: DataFrame, everywhere: bool) -> DataFrame:
    """(_key, gone) for lines that are left: each document meets one piece of a line's holders, or all."""
    parts = mine.join(left.select("line").distinct(), "line").groupBy("line").agg(F.ceil(F.count(F.lit(1)) / HOLDERS).cast("int").alias("parts"))
    held = mine.select("_key", "line").join(parts, "line").select("_key", "line", F.pmod(F.hash("_key"), "parts").alias("part"))
    seqs = cut(_sequences(mine.join(held.select("_key").distinct(), "_key", "left_semi")))
    holders = seqs.join(held, "_key").select("_id", "_key", "seq", "line", "part")
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if everywhere else F.pmod(F.xxhash64("_key"), "parts").cast("int")
    asked = left.join(parts, "line").select("_key", "line", part.alias("part"))
    asked = seqs.join(asked, "_key").select(*[F.col(c).alias(c) for c in holders.columns])
    return holders.groupBy("line", "part").cogroup(asked.groupBy("line", "part")).applyInArrow(_compare, "_key long, gone array<int>")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_share: float | None = None,
                  rare_least: int | None = None) -> DataFrame:
    """(_key, lines): the 0-based line numbers to delete from each document that loses any.

    With ``rare_share`` or ``rare_least``, documents are paired with first holders of rare lines only: those in at most
    that share of all different texts or that many (copies of a text count once).
    """
    body = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("_id"), _key(id_col, text_col).alias("_key"), body.alias("_text"), F.xxhash64(body).alias("_t"))
    lines = src.select("_id", "_key", "_t", F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line"))
    own = cut(lines.where("line rlike '\\\\S'").groupBy("_id", "_key", "_t", F.xxhash64("line").alias("line"))
              .agg(F.array_sort(F.collect_set("pos")).alias("pos")))  # places of one line in one document
    ends = [F.min(F.struct("_id", "_key")).alias("f"), F.max(F.struct("_id", "_key")).alias("l")]
    if rare_share is not None or rare_least is not None:
        # holders and different texts of a line, counted exactly with partial aggregates
        held = own.groupBy("line", "_t").agg(*ends)
        rare = held.groupBy("line").agg(F.min("f").alias("f"), F.max("l").alias("l"), F.count(F.lit(1)).alias("texts"))
        rare = rare.where(f"f != l and texts <= {_most(own, rare_share, rare_least)}").select("line", F.col("f._key").alias("first"))
        pairs = own.join(rare, "line").where("_key != first").select("first", F.col("_key").alias("later")).distinct()
        return _united(_aligned_firsts(own, pairs))
    shared = own.groupBy("line").agg(*ends).where("f != l").select("line", F.col("f._key").alias("first"))
    mine = cut(own.join(shared, "line").select("_id", "_key", "line", "pos", "first"))
    order = F.transform("seq", lambda x: x["line"])
    runs = F.transform(F.sequence(F.lit(1), F.size("order") - 1), lambda i: F.xxhash64(F.get("order", i - 1), F.get("order", i)))
    marks = _sequences(mine).withColumn("order", order).where("size(order) > 1").select(
        "_id", "_key", F.explode(F.array_distinct(F.concat(runs, F.array(F.xxhash64("order"))))).alias("mark"))
    marks = cut(marks)
    firsts = marks.groupBy("mark").agg(*ends).where("f != l").select("mark", F.col("f._key").alias("first"))
    pairs = mine.select("first", F.col("_key").alias("later")).union(marks.join(firsts, "mark").select("first", F.col("_key").alias("later")))
    found = cut(_united(_aligned_firsts(mine.drop("first"), pairs.where("first != later").distinct())))
    for everywhere in (False, True):
        left = cut(_left(mine, found))
        if is_empty(left):
            break
        found = cut(_united(found.withColumnRenamed("lines", "gone").unionByName(_aligned_left(mine, left, everywhere))))
    return found


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_share: float | None = None,
                rare_least: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with aligned lines deleted from ``text_col``, and n_lines, n_removed.

    Each document is compared with all earlier ones, unless ``rare_share`` or ``rare_least`` is given (see ``removed_lines``).
    The earlier document of a pair has the smaller id (a null id is smallest; equal ids by text hash). Rows equal
    in id and text are one document, each returned. Blank lines are never matched or deleted; null texts stay null with no
    lines (n_lines 0), an empty text has one. Existing n_lines and n_removed columns are replaced. An empty table gives none.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    key, body, lines = free_names(rows, "_key", "_text", "_lines")
    gone = removed_lines(docs, id_col, text_col, rare_share, rare_least).select(F.col("_key").alias(key), F.col("lines").alias(lines))
    joined = rows.withColumns({key: _key(id_col, text_col), body: F.col(text_col).cast("string")}).join(gone, key, "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, body, REBUILT):
            texts, counts = batch.column(body).to_pylist(), []
            removed = batch.column(lines)
            sizes = [len(x) if x is not None else 0 for x in removed.to_pylist()] if removed.null_count < len(removed) else [0] * len(removed)
            for i, text in enumerate(texts):
                if text is None:
                    counts.append(0)
                    continue
                counts.append(text.count("\n") + 1)
                if sizes[i]:
                    drop = set(removed[i].as_py())
                    texts[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
            columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=[*kept, "n_lines", "n_removed"])

    types = {f.name: "string" if f.name == text_col else f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", n_lines long, n_removed long"
    wanted = [F.col(f"`{c}`") for c in kept] + [F.col(body), F.col(lines)]
    return joined.select(*wanted).mapInArrow(rebuild, schema)
