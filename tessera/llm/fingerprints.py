"""Document fingerprints: one-permutation MinHash with optimal densification, DataFrame functions only.

Every 5-word shingle is hashed once. The hash's top bits name a bin, the rest is the value, and each bin keeps
its minimum. An empty bin takes the minimum of the first non-empty bin in a random order of its own (fixed by rule), so each borrows
independently of the others. Of every bin the low 8 bits are kept. Two fingerprints agree in a
bin with probability J + (1 - J) / 256, so the likeness is (share - 1/256) / (1 - 1/256), not below 0.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered

BINS_LOG = 8
BINS = 1 << BINS_LOG
PROBES = 12
VALUE_BITS = 64 - BINS_LOG
BLOCKS = 1 << 13  # at most so many blocks of neighbouring documents
BLOCK_ROWS = 512


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _probe(j: int, t: int) -> int:
    return hashlib.md5(f"bin {j} probe {t}".encode()).digest()[0] % BINS


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """Hashes of all k-word shingles (A-Z folded); fewer words give one; no words an empty array."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.filter(F.split(folded, "[ \\t-\\r]+"), lambda w: w != "")

    def over(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(h) - (words - 1)),
                           lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(words)]))
        return F.when(F.size(h) >= words, each).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(parts, lambda w: F.xxhash64(w)), over)


def _empty_marks() -> list[int]:
    """For each bin in signed order the largest hash it can hold: marks an empty bin."""
    return [((b - BINS // 2) << VALUE_BITS) | ((1 << VALUE_BITS) - 1) for b in range(BINS)]


def fingerprint(text: Column, words: int = 5) -> Column:
    """array<int> of ``BINS`` values of 8 bits; empty array for a text without words."""
    longs = lambda xs: F.expr("array(" + ", ".join(f"{x}L" if x > -(1 << 63) else f"({x + 1}L - 1L)" for x in xs) + ")")
    ints = lambda xs: F.expr("array(" + ", ".join(map(str, xs)) + ")")
    marks = longs(_empty_marks())
    probes = [ints([_probe(j, t) for j in range(BINS)]) for t in range(PROBES)]

    def bins(h: Column) -> Column:
        """The minimum of every bin: with one mark a bin added, each bin's first in sorted order."""
        return let(F.sort_array(F.concat(h, marks)),
                   lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, VALUE_BITS) != F.shiftright(F.get(s, i - 1), VALUE_BITS))))

    def dense(b: Column) -> Column:
        held = F.zip_with(b, marks, lambda x, m: F.when(x != m, x.bitwiseAND((1 << VALUE_BITS) - 1)))
        return let(held, lambda o: F.transform(o, lambda x, j: F.coalesce(x, *[F.get(o, F.get(p, j)) for p in probes], rest(o, j))))

    def rest(o: Column, j: Column) -> Column:
        """The non-empty bin that comes first in the order of bin j (few are tried: most are empty here)."""
        ranked = F.transform(o, lambda x, i: F.when(x.isNotNull(), F.struct(F.xxhash64(j, i).alias("r"), x.alias("x"))))
        return F.array_min(ranked)["x"]

    low = lambda d: F.transform(d, lambda x: x.bitwiseAND(255).cast("int"))
    return let(shingle_hashes(text, words),
               lambda h: F.when(F.size(h) > 0, low(dense(bins(h)))).otherwise(F.array().cast("array<int>")))


def as_hex(fp: Column) -> Column:
    """The packed fingerprint as lowercase hex, two digits a bin (empty string without words)."""
    digits = F.expr("array(" + ", ".join(f"'{i:02x}'" for i in range(256)) + ")")
    return F.array_join(F.transform(fp, lambda x: F.get(digits, x)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, 0 to 1, corrected for chance agreement of 8 bits.

    Two texts without words are alike (1.0); one without words is unlike any other (0.0).
    """
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (same - 1 / 256) / (1 - 1 / 256))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fp) of every row; null text counts as empty, equal texts have equal fingerprints."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("fp", fingerprint(F.col("text")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): each document with the next in descending doc_id (after the last: the first).

    Documents are cut into blocks of neighbours by up to ``BLOCKS`` border keys taken from the
    numbered ids (no texts), so a text is shuffled once; a block also gets the first row of the following block. Rows with
    equal ids follow each other by text hash; a null id is the smallest.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.struct(F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 64)).cast("decimal(20,0)")).alias("d"), F.xxhash64("text").alias("h"))
    keyed = rows.withColumn("k", key)
    order = numbered(keyed.select("k"), [F.col("k")], "rn")
    n = order.count()
    if not n:
        return rows.withColumn("fp", F.array().cast("array<int>")).withColumn("next_text", F.col("text")).withColumn("next_fp", F.col("fp"))
    step = max(BLOCK_ROWS, -(-n // BLOCKS))
    borders = [r["k"] for r in order.where(F.col("rn") % step == 0).orderBy("rn").select("k").collect()]  # at most BLOCKS rows
    borders = list(dict.fromkeys((int(b["d"]), b["h"]) for b in borders))
    listed = F.expr("array(" + ", ".join(f"named_struct('d', cast('{d}' as decimal(20,0)), 'h', {h + 1}L - 1L)" for d, h in borders) + ")")
    # the last border not after the key, by bisection
    steps = max(1, len(borders).bit_length())
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0).alias("lo"), F.lit(len(borders)).alias("hi")),
                        lambda s, _: let(F.floor((s["lo"] + s["hi"]) / 2).cast("int"),
                                         lambda m: F.when(s["hi"] - s["lo"] <= 1, s)
                                         .when(F.get(listed, m) <= F.col("k"), F.struct(m.alias("lo"), s["hi"].alias("hi")))
                                         .otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi")))), lambda s: s["lo"])
    placed = keyed.withColumn("block", found)
    first = F.get(listed, F.col("block")) == F.col("k")
    before = F.pmod(F.col("block") - 1, F.lit(len(borders)))
    spread = placed.select("doc_id", "text", "k", F.explode(
        F.when(first, F.array(F.struct(F.col("block").alias("b"), F.lit(False).alias("after")), F.struct(before.alias("b"), F.lit(True).alias("after"))))
        .otherwise(F.array(F.struct(F.col("block").alias("b"), F.lit(False).alias("after"))))).alias("e"))
    dealt = spread.select("doc_id", "text", "k", F.col("e.b").alias("block"), F.col("e.after").alias("after")).repartition("block")
    dealt = dealt.withColumn("fp", fingerprint(F.col("text")))
    following = Window.partitionBy("block").orderBy("after", "k")
    nexts = F.lead(F.struct("text", "fp")).over(following)
    return (dealt.withColumn("nx", nexts).where("not after")
            .select("doc_id", "text", "fp", F.col("nx.text").alias("next_text"), F.col("nx.fp").alias("next_fp")))


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text has its last half (rounded down) of code points replaced by as many first ones (or all) of
    the next document. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    A single document is its own next. An empty table gives no rows.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited)
    rows = rows.withColumn("efp", fingerprint(F.col("edited")))
    return rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("efp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
