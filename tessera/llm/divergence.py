"""Divergence between sources: term prices compared over a K-squared quadtree of the group-term count matrix.

Rows of the matrix are the sources of one language, largest first, columns its kept terms, most widespread first; a cell is a
count. The matrix is divided K by K again and again. Down to squares of ``SIDE`` the tree is a Spark table that holds
nonzero squares only; a square's own tree ends in leaves of ``LEAF``. For two blocks of rows and one block of columns, both
trees are traversed together: where both quadrants are all zero, every group has one price there, so the quadrant costs its width
times the difference of two prices; only nonzero leaves are compared cell by cell. Squares that neither block
has are never built: the final sum prices their columns in the same way.

Prices are integers and differences are summed as integers. Terms are counted with a table per task slice and partial
aggregates, so a hot language, source or term is combined before it is shuffled, and a hot language's squares spread over tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, numbered_within
from .kernels import slices

K = 4
LEAF = 16
SIDE = LEAF * K * K
LEAST_DOCS = 30
SMOOTH, SCALE = 5, 1_000_000_000
TOP = 50
SLICE = 4 << 20  # bytes of text counted in one table

_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def group_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, and one row with a null term
    for each group (docs: its documents). Null lang, source and text count as ''."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, held, rows, size = defaultdict(Counter), defaultdict(Counter), Counter(), 0

        def flush():
            for (lang, source), own in rows.items():
                n, d = count[lang, source], held[lang, source]
                terms = [*n, None]
                columns = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)]
                columns += [pa.array(terms, pa.binary()).cast(pa.string()), pa.array([*n.values(), 0], pa.int64()), pa.array([*(d[t] for t in n), own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch in slices(batches, "text", SLICE):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                raw = text.encode()
                terms = raw.translate(_SPLIT).split()  # all that separates terms is ASCII
                group = lang, source
                rows[group] += 1
                count[group].update(terms)
                held[group].update(set(terms))
                size += len(raw) + 100
                if size >= SLICE:
                    yield from flush()
                    count, held, rows, size = defaultdict(Counter), defaultdict(Counter), Counter(), 0
        yield from flush()

    parts = src.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(n: str, total: str, v: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * v)), exact for counts of any size."""
    return F.expr(f"1L + (cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))) div cast({total} + {SMOOTH} * {v} as decimal(20,0))")


class _Block:
    """Rows of one block in one square: prices, and which nodes of each level hold a nonzero cell."""

    def __init__(self, zero: np.ndarray, row: np.ndarray, col: np.ndarray, price: np.ndarray, width: int, sizes: list[int]):
        self.zero = zero
        self.price = np.repeat(zero[:, None], width, 1)
        self.price[row, col] = price
        self.nodes = [set(zip((row // s).tolist(), (col // s).tolist())) for s in sizes]


def joint_cost(a: _Block, b: _Block, same: bool, width: int, sizes: list[int]) -> np.ndarray:
    """Sum of price differences for each row of ``a`` and row of ``b`` over one square's columns."""
    cost = np.zeros((len(a.zero), len(b.zero)), np.int64)

    def visit(level: int, ra: int, rb: int, c: int) -> None:
        s = sizes[level]
        rows_a, rows_b, cols = slice(ra * s, (ra + 1) * s), slice(rb * s, (rb + 1) * s), slice(c * s, min((c + 1) * s, width))
        if ra * s >= len(a.zero) or rb * s >= len(b.zero) or c * s >= width:
            return
        if (ra, c) not in a.nodes[level] and (rb, c) not in b.nodes[level]:
            cost[rows_a, rows_b] += (cols.stop - cols.start) * np.abs(a.zero[rows_a, None] - b.zero[None, rows_b])
        elif level == len(sizes) - 1:
            cost[rows_a, rows_b] += np.abs(a.price[rows_a, None, cols] - b.price[None, rows_b, cols]).sum(-1)
        else:
            k = s // sizes[level + 1]
            for x in range(ra * k, (ra + 1) * k):
                for y in range(max(rb * k, x) if same else rb * k, (rb + 1) * k):
                    for z in range(c * k, (c + 1) * k):
                        visit(level + 1, x, y, z)

    visit(0, 0, 0, 0)
    return cost


def _square_costs(cells: DataFrame, groups: DataFrame, side: int, leaf: int, k: int) -> DataFrame:
    """(lang, a, b, cost, width): for rows a < b, cost and number of the columns in squares that either's block has."""
    sizes = [side]
    while sizes[-1] > leaf:
        sizes.append(sizes[-1] // k)
    blocks = groups.groupBy("lang").agg(F.max("row").alias("last")).select("lang", F.expr(f"last div {side}").alias("last"))
    square = F.expr(f"col div {side}")
    meets = F.explode(F.expr("sequence(0L, last)"))
    pair = lambda own: {"i": F.least(own, "o"), "j": F.greatest(own, "o")}
    own = cells.select("lang", "row", "col", "p", F.expr(f"row div {side}").alias("own"), square.alias("c"))
    nodes = own.select("lang", "own", "c").distinct()
    dealt = own.join(blocks, "lang").withColumn("o", meets).withColumns(pair("own"))
    wanted = nodes.join(blocks, "lang").withColumn("o", meets).withColumns(pair("own")).select("lang", "i", "j", "c").distinct()
    rows = groups.select("lang", "row", F.col("z").alias("p"), "v", F.expr(f"row div {side}").alias("own"))
    ends = wanted.withColumn("own", F.explode(F.array_distinct(F.array("i", "j"))))
    info = ends.join(rows, ["lang", "own"]).withColumn("col", F.lit(-1).cast("long"))
    to = ["lang", "i", "j", "c", "row", "col", "p", "v"]
    both = dealt.withColumn("v", F.lit(None).cast("long")).select(*to).unionByName(info.select(*to))

    def costs(key: tuple, table: pa.Table) -> pa.Table:
        lang, i, j, c = (x.as_py() for x in key)
        row, col, p = (table.column(x).to_numpy() for x in ("row", "col", "p"))
        is_row = col < 0
        v = table.column("v").drop_null()[0].as_py()
        width = min(side, v - c * side)
        found = []
        for block in dict.fromkeys((i, j)):
            mine = row // side == block
            known = mine & is_row
            zero = p[known][np.argsort(row[known])]
            cell = mine & ~is_row
            found.append(_Block(zero, row[cell] - block * side, col[cell] - c * side, p[cell], width, sizes))
        a, b = found[0], found[-1]
        cost = joint_cost(a, b, i == j, width, sizes)
        x, y = np.triu_indices(len(a.zero), 1) if i == j else (z.reshape(-1) for z in np.indices(cost.shape))
        return pa.table({"lang": pa.array([lang] * len(x), pa.string()), "a": pa.array(x + i * side, pa.int64()), "b": pa.array(y + j * side, pa.int64()),
                         "cost": pa.array(cost[x, y]), "width": pa.array(np.full(len(x), width, np.int64))})

    return both.groupBy("lang", "i", "j", "c").applyInArrow(costs, "lang string, a long, b long, cost long, width long")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS,
               top: int = TOP, side: int = SIDE, leaf: int = LEAF, k: int = K) -> DataFrame:
    """One row per (lang, source) group, part and item: lang, source, part, item, value, rank.

    Part ``pair`` compares a group with each other source of its language: the sum over all kept terms of the differences of their
    prices. Part ``term`` lists up to ``top`` terms that the group uses more than its language does. A kept term is in at least
    ``least_docs`` documents of the language (every row is a document, repeated rows too). Ranks order by value, largest first,
    then by the item's bytes.

    Null text, lang and source are ''. A group without terms is compared as well; a language without kept terms gives pairs of value 0 and no
    terms; a language with one source has no pairs; an empty table gives no rows. Other columns are ignored whatever their names.
    """
    counts = cut(group_terms(docs, lang_col, source_col, text_col))
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("all")).where(F.col("d") >= least_docs)
    kept = numbered_within(kept, "lang", [-F.col("d"), F.col("term")], "col")
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("whole"))
    cells = cut(counts.where("term is not null").join(kept.drop("d"), ["lang", "term"]))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(per_lang, "lang", "left")
              .na.fill(0, ["total", "v", "whole"]))
    groups = cut(numbered_within(groups, "lang", [-F.col("total"), F.col("source")], "row")
                 .withColumn("z", F.when(F.col("v") > 0, _price("0L", "total", "v")).otherwise(F.lit(0).cast("long"))))
    priced = cells.join(groups.drop("z"), ["lang", "source"]).withColumn("p", _price("n", "total", "v"))
    # pairs: squares that were traversed, and all other columns at the prices of zero counts
    square = _square_costs(priced.select("lang", "row", "col", "p"), groups, side, leaf, k).groupBy("lang", "a", "b").agg(
        F.sum("cost").alias("cost"), F.sum("width").alias("width"))
    end = lambda x: groups.select("lang", F.col("row").alias(x), F.col("source").alias(f"s{x}"), F.col("z").alias(f"z{x}"), *["v"] * (x == "a"))
    pairs = end("a").join(end("b"), "lang").where("a < b").join(square, ["lang", "a", "b"], "left").na.fill(0, ["cost", "width"])
    pairs = pairs.withColumn("value", F.expr("cost + (v - width) * abs(za - zb)"))
    sides = F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item")))
    pairs = pairs.select("lang", F.explode(sides).alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    terms = priced.withColumn("q", _price("all", "whole", "v")).where("n > 0 and p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))
