"""Batched merge rounds against a one-merge-at-a-time greedy trainer on random corpora."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import BYTE_TO_ID, ID_TO_BYTE, SPECIAL_TOKENS
from tessera.operators import bpe


def greedy_bpe(words: dict, vocab_size: int, min_frequency: int = 2):
    """Plain greedy BPE: recount all pairs after every merge; ties by (left id, right id)."""
    vocab = {i: s.encode() for i, s in enumerate(SPECIAL_TOKENS)}
    vocab.update({i: bytes([b]) for i, b in ID_TO_BYTE.items()})
    by_bytes = {b: i for i, b in vocab.items()}
    seqs = {w: [BYTE_TO_ID[b] for b in w.encode()] for w in words}
    merges = []
    while len(vocab) < vocab_size:
        counts = {}
        for w, s in seqs.items():
            for a, b in zip(s, s[1:]):
                counts[(a, b)] = counts.get((a, b), 0) + words[w]
        if not counts:
            break
        (a, b), n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        if n < min_frequency:
            break
        merged = vocab[a] + vocab[b]
        new = by_bytes.get(merged)
        if new is None:
            new = max(vocab) + 1
            vocab[new] = merged
            by_bytes[merged] = new
        merges.append((a, b, new))
        for w, s in seqs.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            seqs[w] = out
    return merges


def test_batched_rounds_equal_greedy(spark):
    rng = random.Random(7)
    for trial in range(4):
        alphabet = rng.choice(["ab", "abc", "aab ", "xyzw ", "abé"])
        words = {}
        for _ in range(rng.randint(20, 80)):
            w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
            words[w] = words.get(w, 0) + rng.randint(1, 6)
        df = spark.createDataFrame(list(words.items()), "word string, cnt long")
        target = 259 + rng.randint(5, 20)
        # few known pairs: they run out, and all pairs are counted again
        model = bpe.train_bpe(bpe.word_types(df), vocab_size=target, heads=[1, 3, 64][trial % 3], cut_every=[None, 2][trial % 2], checkpoint_every=3)
        assert model.merges == greedy_bpe(words, target), trial


def clauses(rng, n, phrases):
    """Clause-long words without spaces; nearly every one is unique."""
    return Counter("".join(rng.choice(phrases)[:rng.randint(1, 9)] for _ in range(rng.randint(4, 9))) for _ in range(n))


@pytest.mark.parametrize("cut_every", [None, 3])
def test_words_without_spaces_give_the_same_merges(spark, cut_every):
    rng = random.Random(3)
    phrases = ["".join(chr(rng.randrange(0x4E00, 0x4E60)) for _ in range(8)) for _ in range(12)]
    words = clauses(rng, 150, phrases) + Counter({"好" * 500: 1, phrases[0] * 40: 1})
    assert 2 * len(words) > sum(words.values())
    df = spark.createDataFrame(list(words.items()), "word string, cnt long")
    model = bpe.train_bpe(bpe.word_types(df), vocab_size=259 + 60, cut_every=cut_every)
    assert model.merges == greedy_bpe(words, 259 + 60)
    if cut_every:  # the whole path cuts by itself, since words hardly repeat
        docs = spark.createDataFrame([(i, w) for i, w in enumerate(words.elements())], "doc_id long, text string")
        assert bpe.train_tokenizer(docs, vocab_size=259 + 20).merges == model.merges[:20]


def blocks_of(spark, words):
    return bpe.to_blocks(bpe.word_types(spark.createDataFrame(list(words.items()), "word string, cnt long")), partitions=3)


def pairs_of(blocks, least=1):
    pairs = Counter()
    for r in bpe.from_blocks(blocks).collect():
        for a, b in zip(r.symbols, r.symbols[1:]):
            pairs[a << 32 | b] += r.cnt
    return {p: n for p, n in pairs.items() if n >= least}


def test_cutting_dead_pairs_shrinks_the_table_and_keeps_live_pairs(spark):
    rng = random.Random(5)
    phrases = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6)]
    words = Counter(phrases[rng.randrange(6)] + chr(rng.randrange(0x4E00, 0x9F00)) + phrases[rng.randrange(6)] for _ in range(300))
    blocks = blocks_of(spark, words)
    cut = bpe.cut_dead_pairs(blocks)
    assert pairs_of(cut, 2) == pairs_of(blocks, 2)
    rows = bpe.from_blocks(cut).collect()
    assert sum(len(r.symbols) for r in rows) < 0.9 * sum(len(w.encode()) for w in words)
    assert len({tuple(r.symbols) for r in rows}) == len(rows) and all(len(r.symbols) > 1 for r in rows)
    counted = {r.pair: r.n for r in bpe.block_pair_counts(cut.withColumn("block", F.lit(0).cast("long"))).collect()}
    assert counted == pairs_of(cut)


def test_a_round_counts_only_what_changed(spark):
    words = {"abab": 3, "xaby": 2, "aaa": 5, "zz": 7, "ab": 11, "é" * 9: 2}
    blocks = blocks_of(spark, words)
    a, b, z = (BYTE_TO_ID[ord(c)] for c in "abz")
    twice = BYTE_TO_ID["é".encode()[0]], BYTE_TO_ID["é".encode()[1]]
    merged = bpe.merge_blocks(blocks, [(a, b, 300, True), (*twice, 301, True)])
    before, after = pairs_of(blocks), pairs_of(merged)
    changes = {r.pair: r.n for r in bpe.pair_changes(merged).collect()}
    assert changes == {p: after.get(p, 0) - before.get(p, 0) for p in before | after if after.get(p, 0) != before.get(p, 0)}
    assert z << 32 | z not in changes
    left = {tuple(r.symbols): r.cnt for r in bpe.from_blocks(bpe.merge_blocks(merged, [(301, 301, 302, True), (z, z, 303, True)])).collect()}
    assert left == {(300, 300): 3, (BYTE_TO_ID[120], 300, BYTE_TO_ID[121]): 2, (a, a, a): 5, (302,) * 4 + (301,): 2}
