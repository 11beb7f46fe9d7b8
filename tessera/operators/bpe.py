"""Tokenizer training as a distributed job.

Plan: corpus -> NFKC -> byte-level pre-tokens -> word counts (one shuffle, partial aggregation
absorbs hot words) -> word types packed into blocks, partitioned by their size -> all pairs counted once ->
rounds that count differences only.

A round learns several merges at once, exactly as one-at-a-time greedy BPE would: the batch is
the longest prefix of the ranked pairs (count desc, left id asc, right id asc) in which no
pair's left symbol is an earlier pair's right symbol and no pair's right symbol is an earlier
pair's left symbol; the prefix ends after a pair of two equal symbols and before a pair whose
merged string already exists (that pair is applied alone, reusing the existing id). Such merges
do not change each other's counts (occurrences cannot overlap), and every pair they create is
bounded by a pair that ranks after the prefix and loses ties to it (new ids are the largest),
so the greedy order is preserved.

Differences. A block is one row: the symbols of some 2^17 symbols' worth of words one after the other, and their counts. A
round finds the batch's pairs in each block, rewrites the words that hold one, counts their old pairs with the opposite sign and
their new ones with theirs, and sums what changed over all blocks. Once its two symbols exist, a pair's count can
only fall. So the driver keeps the exact counts of the ``heads`` pairs that ranked first when all were counted; whatever
was left out then, or falls behind the last of them, ranks later and stays unknown until the known pairs run out and
all pairs are counted again. Besides these, a round sends the pairs it changed, at most four times the vocabulary for each merge.

Long words. Where types are nearly as many as occurrences (scripts without spaces), the word table is as large as the corpus.
Two neighbours whose pair occurs fewer than ``min_frequency`` times can never be merged, nor can anything across
them, so words may be cut there at any time without changing a merge. ``cut_dead_pairs`` does so and unites equal
pieces; the table shrinks to pieces that repeat.

Blocks stay distributed and are checkpointed to the reliable checkpoint directory every few rounds to cut lineage.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (BASE_VOCAB_SIZE, ID_TO_BYTE, SPECIAL_TOKENS, byte_symbols, col_,
                              nfkc, pretokens)
from ..session import ensure_checkpoint_dir, spread


def word_counts(df: DataFrame, text_col: str = "text", normalize: bool = True) -> DataFrame:
    """C4: pre-token frequencies ``(word string, cnt long)``."""
    text = nfkc(text_col) if normalize else col_(text_col)
    return (spread(df.select(text_col)).select(F.explode(pretokens(text)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def word_types(counts: DataFrame) -> DataFrame:
    """Word counts as base-symbol arrays; words of one symbol can never take part in a merge."""
    return (counts.filter(F.octet_length("word") >= 2)  # a symbol is a byte
            .select(byte_symbols("word").alias("symbols"), F.col("cnt").cast("long").alias("cnt")))


def pair_counts(words: DataFrame, min_frequency: int = 2) -> DataFrame:
    """Weighted adjacent-pair counts ``(left int, right int, n long)`` with a minimum."""
    s = F.col("symbols")
    n = F.size(s) - 1
    # arrays_zip of the array and its shift is a native (code-generated) expression
    pairs = F.arrays_zip(F.slice(s, 1, n).alias("left"), F.slice(s, 2, n).alias("right"))
    return (words.select(F.explode(pairs).alias("p"), "cnt")
            .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
            .agg(F.sum("cnt").alias("n"))
            .filter(F.col("n") >= min_frequency))


@dataclass
class BpeModel:
    """A learned tokenizer: merges in rank order and the id -> bytes vocabulary."""

    merges: list[tuple[int, int, int]] = field(default_factory=list)  # (left, right, new)
    vocab: dict[int, bytes] = field(default_factory=dict)
    rounds: int = 0

    @classmethod
    def base(cls) -> "BpeModel":
        vocab = {i: s.encode() for i, s in enumerate(SPECIAL_TOKENS)}
        vocab.update({i: bytes([b]) for i, b in ID_TO_BYTE.items()})
        return cls(vocab=vocab)

    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(l, r): (k, n) for k, (l, r, n) in enumerate(self.merges)}

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, l, r, n) for k, (l, r, n) in enumerate(self.merges)],
                                     "rank int, left int, right int, new int")

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        """Final vocabulary ``(id, token_bytes, is_special)``."""
        return spark.createDataFrame(
            [(i, bytearray(b), i < len(SPECIAL_TOKENS)) for i, b in sorted(self.vocab.items())],
            "id int, token_bytes binary, is_special boolean")


def _select_batch(heads, model: BpeModel, by_bytes: dict, room: int, min_frequency: int):
    """Longest exact prefix of the ranked heads (see module doc). Returns [(l, r, new, is_new)].

    Merging (a, b) changes the count of another pair (u, v) only when u == b (its left symbol
    may be swallowed from the left) or v == a (its right symbol from the right); pairs that
    share just the left or just the right symbol cannot overlap an (a, b) occurrence."""
    batch, lefts, rights = [], set(), set()
    next_id = max(model.vocab) + 1
    for row in heads:
        left, right, n = int(row[0]), int(row[1]), int(row[2])
        if n < min_frequency or left in rights or right in lefts:
            break
        merged = model.vocab[left] + model.vocab[right]
        existing = by_bytes.get(merged)
        if existing is not None:
            if not batch:
                batch.append((left, right, existing, False))
            break
        if room <= 0:
            break
        batch.append((left, right, next_id, True))
        by_bytes[merged] = next_id
        model.vocab[next_id] = merged
        next_id += 1
        room -= 1
        lefts.add(left)
        rights.add(right)
        if left == right:
            break
    return batch


HEADS = 1 << 16  # pairs whose counts the driver keeps
BLOCK = 1 << 17  # symbols of one block (a longer word stays whole)
PARTITION_SYMBOLS = 1 << 22  # symbols of one partition of blocks
CUT_EVERY = 64  # rounds between cuts at dead pairs, where words hardly repeat
BLOCK_TYPE = "flat binary, cnt binary, pair array<long>, n array<long>"


def _code(left, right):
    """One long for a pair; codes order like (left id, right id)."""
    return (left << 32) | right


def _block_row(flat: np.ndarray, cnt: np.ndarray, pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in (pair, n)]
    return pa.RecordBatch.from_arrays([pa.array([flat.astype(np.int32).tobytes()]), pa.array([cnt.astype(np.int64).tobytes()]), *lists],
                                      names=["flat", "cnt", "pair", "n"])


def _block_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each block row with its symbols (words end with -1) and the counts of its words."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield row, np.frombuffer(row.column("flat")[0].as_buffer(), np.int32), np.frombuffer(row.column("cnt")[0].as_buffer(), np.int64)


_NONE = np.zeros(0, np.int64)


def to_blocks(words: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(symbols array<int>, cnt long)`` as block rows, in partitions of about ``PARTITION_SYMBOLS`` (at least one a core)."""
    known = words.select(F.col("symbols").cast("array<int>").alias("symbols"), F.col("cnt").cast("long").alias("cnt")).checkpoint(eager=True)
    size = known.agg(F.sum(F.size("symbols") + 1)).first()[0] or 0
    n = partitions or max(words.sparkSession.sparkContext.defaultParallelism, -(-size // PARTITION_SYMBOLS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, total = [], [], 0
        for batch in batches:
            lists = batch.column("symbols")
            off = lists.offsets.to_numpy()
            values, cnt = lists.values.to_numpy(), batch.column("cnt").to_numpy()
            piece = (off[1:] - off[0]) // BLOCK
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(cnt)]
            for a, b in zip(cuts, cuts[1:]):
                part = np.insert(values[off[a]:off[b]], off[a + 1:b + 1] - off[a], -1)
                held, counts, total = [*held, part], [*counts, cnt[a:b]], total + len(part)
                if total >= BLOCK:
                    yield _block_row(np.concatenate(held), np.concatenate(counts), _NONE, _NONE)
                    held, counts, total = [], [], 0
        if held:
            yield _block_row(np.concatenate(held), np.concatenate(counts), _NONE, _NONE)

    return known.repartition(n).mapInArrow(pack, BLOCK_TYPE)


def from_blocks(blocks: DataFrame) -> DataFrame:
    """The word types ``(symbols, cnt)`` of block rows."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, cnt in _block_arrays(batches):
            ends = np.flatnonzero(flat == -1)
            off = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(flat[flat >= 0], pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(cnt)], names=["symbols", "cnt"])

    return blocks.select("flat", "cnt").mapInArrow(unpack, "symbols array<int>, cnt long")


def _summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes with the exact sum of their weights and the index of their first use."""
    if not len(codes):
        return _NONE, _NONE, _NONE
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[first], np.add.reduceat(weights[order], first), order[first]


def _word_pairs(flat: np.ndarray, cnt: np.ndarray, ends: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of all pairs of the given words (indices), ``ends`` being all words' ends."""
    begin = np.where(words > 0, ends[words - 1] + 1, 0)
    size = np.maximum(ends[words] - begin - 1, 0)
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return _code(flat[at].astype(np.int64), flat[at + 1]), np.repeat(cnt[words], size)


def merge_block(flat: np.ndarray, cnt: np.ndarray, batch: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Apply a batch of merges to one block: new symbols and counts, and the signed changes of its pair counts.

    Occurrences of different batch pairs cannot overlap (see ``_select_batch``), so all are replaced at once; of a run of one
    symbol every other place is merged, from the left. Words left with one symbol go."""
    pairs = sorted((_code(l, r), n, l == r) for (l, r, n, *_) in batch)
    codes, new, twin = (np.array(x) for x in zip(*pairs))
    lefts = np.zeros(int((codes >> 32).max()) + 2, bool)  # -1 and larger ids read the last entry, which is no left symbol
    lefts[codes >> 32] = True
    at = np.flatnonzero(lefts[np.minimum(flat[:-1], len(lefts) - 1)])
    code = _code(flat[at].astype(np.int64), flat[at + 1])
    k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    hit = codes[k] == code
    at, k = at[hit], k[hit]
    if not len(at):
        return flat, cnt, _NONE, _NONE
    i = np.arange(len(at))
    opens = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(k) != 0)])
    kept = ~twin[k] | ((i - np.maximum.accumulate(np.where(opens, i, 0))) % 2 == 0)
    at, k = at[kept], k[kept]
    ends = np.flatnonzero(flat == -1)
    touched = np.unique(np.searchsorted(ends, at))
    before, lost = _word_pairs(flat, cnt, ends, touched)
    out, stays = flat.copy(), np.ones(len(flat), bool)
    out[at] = new[k]
    stays[at + 1] = False
    out = out[stays]
    ends = np.flatnonzero(out == -1)
    after, gained = _word_pairs(out, cnt, ends, touched)
    pair, n, _ = _summed(np.concatenate([before, after]), np.concatenate([-lost, gained]))
    single = touched[ends[touched] - np.where(touched > 0, ends[touched - 1] + 1, 0) == 1]
    if len(single):
        stays = np.ones(len(out), bool)
        stays[ends[single]] = stays[ends[single] - 1] = False
        out, cnt = out[stays], np.delete(cnt, single)
    return out, cnt, pair[n != 0], n[n != 0]


def merge_blocks(blocks: DataFrame, batch: list[tuple]) -> DataFrame:
    """Block rows after a batch; ``pair`` and ``n`` hold how the block's pair counts changed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, cnt in _block_arrays(batches):
            yield _block_row(*merge_block(flat, cnt, batch))

    return blocks.select("flat", "cnt").mapInArrow(run, BLOCK_TYPE)


def pair_changes(merged: DataFrame) -> DataFrame:
    """``(pair, n)``: signed changes of the pair counts over all blocks."""
    return (merged.select(F.explode(F.arrays_zip("pair", "n")).alias("e")).groupBy(F.col("e.pair").alias("pair"))
            .agg(F.sum("e.n").alias("n")).filter("n != 0"))


@contextmanager
def _short_jobs(spark: SparkSession):
    """A round's sums are a few thousand rows: four reducers, planned once. The settings are put back."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def block_pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, n, uses, block, at)`` of all pairs: ``uses`` counts blocks times 2 where a block has the pair more than once, so
    1 means a single place, which is ``at`` in the block of that id (ids as in ``numbered_blocks``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, flat, cnt in _block_arrays(batches):
            ends = np.flatnonzero(flat == -1)
            codes, weights = _word_pairs(flat, cnt, ends, np.arange(len(ends)))
            inside = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
            pair, n, first = _summed(codes, weights)
            uses = np.minimum(np.diff(np.append(np.sort(np.searchsorted(pair, codes)).searchsorted(np.arange(len(pair))), len(codes))), 2)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n), pa.array(uses.astype(np.int64)), pa.array([row.column("block")[0].as_py()] * len(pair), pa.int64()),
                                              pa.array(inside[first])], names=["pair", "n", "uses", "block", "at"])

    parts = blocks.select("flat", "cnt", "block").mapInArrow(run, "pair long, n long, uses long, block long, at long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"), F.min("block").alias("block"), F.min("at").alias("at"))


class PairRanks:
    """Exact counts of the pairs that rank up to a border; all other pairs rank after it."""

    def __init__(self, top: list[tuple[int, int]], complete: bool):
        self.counts = dict(top)
        self.border = None if complete else (-top[-1][1], top[-1][0])
        self.heap = [(-n, pair) for pair, n in top]
        heapq.heapify(self.heap)

    def ranked(self, seen: list) -> Iterator[tuple[int, int, int]]:
        """(left, right, n) in rank order; what is taken is noted in ``seen``."""
        while self.heap:
            n, pair = entry = heapq.heappop(self.heap)
            if self.counts.get(pair) == -n:
                seen.append(entry)
                yield pair >> 32, pair & 0xFFFFFFFF, -n

    def put_back(self, seen: list) -> None:
        for entry in dict.fromkeys(seen):
            heapq.heappush(self.heap, entry)

    def change(self, changes: list[tuple[int, int]], new_symbols: set[int]) -> None:
        for pair, change in changes:
            before = self.counts.get(pair)
            if before is None and not (pair >> 32 in new_symbols or pair & 0xFFFFFFFF in new_symbols):
                continue  # it ranked after the border, and its count only falls
            n = (before or 0) + change
            if n > 0 and (self.border is None or (-n, pair) <= self.border):
                self.counts[pair] = n
                heapq.heappush(self.heap, (-n, pair))
            else:
                self.counts.pop(pair, None)


def count_pairs(blocks: DataFrame, heads: int, min_frequency: int) -> PairRanks:
    """All pairs counted; the first ``heads`` of them come to the driver."""
    counts = block_pair_counts(blocks.withColumn("block", F.lit(0).cast("long"))).filter(F.col("n") >= min_frequency)
    top = counts.orderBy(F.desc("n"), F.asc("pair")).limit(heads + 1).select("pair", "n").collect()
    return PairRanks([(r.pair, r.n) for r in top[:heads]], len(top) <= heads)


def cut_dead_pairs(blocks: DataFrame, min_frequency: int = 2, partitions: int | None = None) -> DataFrame:
    """Block rows whose words are cut between neighbours that occur fewer than ``min_frequency`` times together, equal pieces united.

    Such a pair's place comes out of the aggregate that counts it (a pair with several places is left), so pair places
    are never joined. Pieces of one symbol can't take part in a merge and go."""
    known = blocks.select("flat", "cnt").checkpoint(eager=True).withColumn("block", F.monotonically_increasing_id())
    dead = block_pair_counts(known).filter((F.col("n") < min_frequency) & (F.col("uses") == 1))
    cuts = dead.groupBy("block").agg(F.sort_array(F.collect_list("at")).alias("cuts"))  # at most a block's symbols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, flat, cnt in _block_arrays(batches):
            at = np.array(row.column("cuts")[0].as_py() or [], np.int64)
            words = np.searchsorted(np.flatnonzero(flat == -1), at)
            flat = np.insert(flat, at + 1, -1)
            cnt = np.repeat(cnt, 1 + np.bincount(words, minlength=len(cnt)))
            ends = np.flatnonzero(flat == -1)
            size = np.diff(ends, prepend=-1) - 1
            stays = np.repeat(size >= 2, size + 1)
            yield _block_row(flat[stays], cnt[size >= 2], _NONE, _NONE)

    pieces = from_blocks(known.join(cuts, "block", "left").select("flat", "cnt", "cuts").mapInArrow(run, BLOCK_TYPE))
    return to_blocks(pieces.groupBy("symbols").agg(F.sum("cnt").alias("cnt")), partitions)


def train_bpe(words: DataFrame, vocab_size: int, min_frequency: int = 2, heads: int = HEADS,
              checkpoint_every: int = 16, partitions: int | None = None, cut_every: int | None = None) -> BpeModel:
    """Learn merges until ``vocab_size`` tokens (specials and bytes included).

    ``words`` is a word-type table ``(symbols array<int>, cnt long)`` from :func:`word_types`.
    Each round is one Spark job: rewrite the words that hold a pair of the batch, and sum how their pairs changed. With
    ``cut_every``, words are cut at dead pairs before the first round and after every so many rounds."""
    spark = words.sparkSession
    ensure_checkpoint_dir(spark)
    model = BpeModel.base()
    by_bytes = {b: i for i, b in model.vocab.items()}
    current = to_blocks(words, partitions)
    current = (cut_dead_pairs(current, min_frequency, partitions) if cut_every else current).checkpoint(eager=True)
    ranks: PairRanks | None = None
    while len(model.vocab) < vocab_size:
        fresh = ranks is None
        ranks = ranks or count_pairs(current, heads, min_frequency)
        seen: list = []
        batch = _select_batch(ranks.ranked(seen), model, by_bytes, vocab_size - len(model.vocab), min_frequency)
        ranks.put_back(seen)
        if not batch:
            if fresh or ranks.border is None:
                break
            ranks = None  # the known pairs have run out
            continue
        model.rounds += 1
        model.merges.extend((l, r, n) for (l, r, n, _) in batch)
        merged = merge_blocks(current, batch).persist()
        with _short_jobs(spark):
            changes = [(r.pair, r.n) for r in pair_changes(merged).collect()]
        ranks.change(changes, {n for (_, _, n, is_new) in batch if is_new})
        if not all(is_new for *_, is_new in batch):
            ranks = None  # an older symbol has gained occurrences
        after = merged
        if cut_every and model.rounds % cut_every == 0:
            after = cut_dead_pairs(merged, min_frequency, partitions).checkpoint(eager=True)
        elif model.rounds % checkpoint_every == 0:
            after = merged.checkpoint(eager=True)
        current.unpersist()
        if after is not merged:
            merged.unpersist()
        current = after
    current.unpersist()
    return model


def train_tokenizer(docs: DataFrame, vocab_size: int = 32000, min_frequency: int = 2,
                    text_col: str = "text", order_col: str | None = "doc_id",
                    max_lines: int | None = None, **kw) -> BpeModel:
    """End-to-end tokenizer training over the whole corpus: word counts (C4), merges.

    ``max_lines`` bounds the scan to the first lines (A3); ``order_col`` must then hold dense line numbers. Where different words
    are over half of all words, they are cut at dead pairs every ``CUT_EVERY`` rounds; the merges are the same either way."""
    if max_lines is not None and order_col is not None:
        docs = docs.filter(F.col(order_col) < max_lines)
    ensure_checkpoint_dir(docs.sparkSession)
    counts = word_counts(docs, text_col).checkpoint(eager=True)
    if "cut_every" not in kw:
        types, uses = counts.agg(F.count(F.lit(1)), F.sum("cnt")).first()
        kw["cut_every"] = CUT_EVERY if uses and 2 * types > uses else None
    return train_bpe(word_types(counts), vocab_size, min_frequency, **kw)


# ------------------------------------------------------------------------------------------
# Applying a learned merge table to words (used by encode, D2): small per-word helper.

def bpe_word(symbols: list[int], ranks: dict) -> list[int]:
    """Apply merges lowest rank first; each merge replaces its occurrences left to right.

    A heap of (rank, place) over a linked list of symbols: every merge touches its two neighbours only, so long
    unbroken words take time in proportion to their length (times its logarithm)."""
    n = len(symbols)
    if n < 2:
        return symbols
    sym = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        hit = ranks.get((sym[i], sym[i + 1]))
        if hit is not None:
            heap.append((hit[0], i, sym[i], sym[i + 1], hit[1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i] if sym[i] == left else n
        if j >= n or sym[j] != right:
            continue  # one of the two has changed since
        sym[i], sym[j] = new, None
        k = after[j]
        after[i] = k
        if k < n:
            before[k] = i
            hit = ranks.get((new, sym[k]))
            if hit is not None:
                heapq.heappush(heap, (hit[0], i, new, sym[k], hit[1]))
        p = before[i]
        if p >= 0:
            hit = ranks.get((sym[p], new))
            if hit is not None:
                heapq.heappush(heap, (hit[0], p, sym[p], new, hit[1]))
    return [x for x in sym if x is not None]


LONG_WORD = 48  # symbols; longer words are merged one by one


class MergeTable:
    """Merges as sorted pair codes, for many words at a time."""

    def __init__(self, ranks: dict):
        self.ranks = ranks
        items = sorted((_code(l, r), k, n) for (l, r), (k, n) in ranks.items())
        self.codes = np.array([x[0] for x in items] or [-1], np.int64)  # no pair has the code -1
        self.rank = np.array([x[1] for x in items] or [0], np.int32)
        self.none = int(self.rank.max()) + 1
        self.new = np.zeros(self.none, np.int32)
        self.new[self.rank] = [x[2] for x in items] or [0]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``none`` where they are not merged."""
        code = _code(left.astype(np.int64), right)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.rank[at], np.int32(self.none))


def bpe_words(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and their numbers; word ``i`` is ``symbols[starts[i]:starts[i] + sizes[i]]``.

    The same merges as :func:`bpe_word`'s: words of one length are rows of a matrix, and each step merges in every row its first place
    of lowest rank, so rows stay equally long until they are done."""
    counts = np.zeros(len(sizes), np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []  # (words, their ids as rows)

    def put(words: np.ndarray, rows: np.ndarray) -> None:
        counts[words] = rows.shape[1]
        done.append((words, rows))

    by_size = np.argsort(sizes, kind="stable")
    ranked = sizes[by_size]
    cuts = [0, *(np.flatnonzero(np.diff(ranked)) + 1).tolist(), len(ranked)]
    for a, b in zip(cuts, cuts[1:]):
        size = int(ranked[a]) if b > a else 0
        if not size:
            continue
        words = by_size[a:b]
        if size > LONG_WORD:
            for i in words:
                ids = bpe_word(symbols[starts[i]:starts[i] + size].tolist(), table.ranks)
                put(np.array([i]), np.array([ids], np.int32))
            continue
        rows = symbols[starts[words][:, None] + np.arange(size)].astype(np.int32)
        ranks = table.lookup(rows[:, :-1], rows[:, 1:])
        while ranks.shape[1]:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(at)), at]
            live = best < table.none
            if not live.all():
                put(words[~live], rows[~live])
                words, rows, ranks, at, best = words[live], rows[live], ranks[live], at[live], best[live]
            if not len(words):
                break
            n, at_ = np.arange(len(words)), at[:, None]
            rows = np.where(np.arange(rows.shape[1] - 1) < at_, rows[:, :-1], rows[:, 1:])
            rows[n, at] = table.new[best]
            ranks = np.where(np.arange(ranks.shape[1] - 1) < at_, ranks[:, :-1], ranks[:, 1:])
            for k in (at - 1, at):
                i = np.flatnonzero((k >= 0) & (k < ranks.shape[1]))
                j = k[i]
                ranks[i, j] = table.lookup(rows[i, j], rows[i, j + 1])
        if len(words):
            put(words, rows)
    begin = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for words, rows in done:
        out[begin[words][:, None] + np.arange(rows.shape[1])] = rows
    return out, counts
