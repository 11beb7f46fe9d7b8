"""Encode and decode with a learned merge table.

Encoding plan (dictionary encode, Spark-first):

1. per row, JVM-side: split at literal special tokens (raw text), NFKC the other pieces
   (Arrow UDF, non-ASCII only), pre-tokenise them -> ``units array<string>`` where a unit is a
   special-token string or one pre-token;
2. truncation pushdown: every unit yields at least one token, so only the first ``max_len``
   units of a row can survive right truncation -> ``slice(units, 1, max_len)`` *before* any
   shuffle;
3. ``posexplode`` units; the **distinct** words are encoded once each (``mapInPandas`` with the
   merge table broadcast; its size is bounded by the vocabulary size) -> ``(word, ids, ends)``;
4. join back on the word (AQE picks a broadcast when the dictionary is measured small, otherwise
   a sort-merge join whose hot words are split by the skew-join rule);
5. regroup per row in unit order and flatten (groups are bounded by ``max_len`` units).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (BYTE_TO_ID, SPECIAL_TOKENS, col_, is_special, nfkc_pieces,
                              pretokens, special_id, split_specials)
from ..functions.arrays import truncate
from ..session import spread
from .bpe import BpeModel, MergeTable, bpe_word, bpe_words

DICT_SCHEMA = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),  # cumulative byte end of each token
])


def with_pieces(df: DataFrame, text, out: str = "pieces") -> DataFrame:
    """D1 + C1: add ``out array<struct<special boolean, text string>>``: control tokens and the NFKC text between them.

    Pieces and their NFKC form are materialised as columns first: a Python UDF cannot sit
    inside a higher-order function's lambda."""
    pieces = df.withColumn("_raw", split_specials(text))
    normed = pieces.withColumn("_norm", nfkc_pieces("_raw", text))
    each = F.transform("_raw", lambda p, i: F.struct(
        is_special(p).alias("special"), F.when(is_special(p), p).otherwise(F.get(F.col("_norm"), i)).alias("text")))
    return normed.withColumn(out, each).drop("_raw", "_norm")


def piece_units(pieces) -> Column:
    """The units of ``with_pieces``: special tokens and pre-tokens, in order."""
    return F.flatten(F.transform(col_(pieces), lambda p: F.when(p["special"], F.array(p["text"])).otherwise(pretokens(p["text"]))))


def with_text_units(df: DataFrame, text, out: str = "units") -> DataFrame:
    """D1 + C1 + C2: add ``out array<string>``: special tokens and pre-tokens, in order."""
    return with_pieces(df, text, "_pieces").withColumn(out, piece_units("_pieces")).drop("_pieces")


class WordCache:
    """Encoded words of a task, bounded by the memory they take; long words, which seldom come again, are kept out.

    A full cache is emptied: frequent words are back at once."""

    def __init__(self, limit: int = 128 << 20, longest: int = 256):
        self.limit, self.longest, self.size = limit, longest, 0
        self.words: dict[str, tuple] = {}
        self.get = self.words.get

    def put(self, word: str, hit: tuple) -> None:
        if len(word) > self.longest:
            return
        size = 400 + 4 * len(word) + 80 * len(hit[0])  # two lists of numbers, their tuple and the entry
        if self.size + size > self.limit:
            self.words.clear()
            self.size = 0
        self.words[word] = hit
        self.size += size


def _word_encoder(ranks_bc, vocab_len_bc):
    def encode_partition(batches):
        ranks = ranks_bc.value
        lens = vocab_len_bc.value
        cache = WordCache()
        for pdf in batches:
            out_ids, out_ends = [], []
            for w in pdf["word"]:
                hit = cache.get(w)
                if hit is None:
                    ids = bpe_word([BYTE_TO_ID[b] for b in w.encode("utf-8")], ranks)
                    ends, acc = [], 0
                    for t in ids:
                        acc += lens[t]
                        ends.append(acc)
                    hit = (ids, ends)
                    cache.put(w, hit)
                out_ids.append(hit[0])
                out_ends.append(hit[1])
            yield pd.DataFrame({"word": pdf["word"], "ids": out_ids, "ends": out_ends})
    return encode_partition


SLICE_BYTES = 2 << 20  # bytes of units that a task encodes at once


def _pieces(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive places [a, b) of at most ``limit`` by the running sizes ``ends``; a larger place is alone."""
    a, n = 0, len(ends)
    while a < n:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield a, b
        a = b


def _arrow_unit_encoder(ranks_bc, vocab_len_bc, units_col: str, cls_col: str | None):
    """Per-batch encoder over Arrow data. The *distinct* words of a slice are merged together
    (``bpe_words``); gathering every unit's tokens, the
    per-row offsets and the supervision mask is vectorised numpy. Rows go in slices of ``SLICE_BYTES`` bytes of units, and a
    larger row's units in such slices too, so what a task holds follows neither the batch's rows nor a row's length
    (but for that row's ids)."""
    symbol = np.array(BYTE_TO_ID, np.int32)

    def encode_units(flat, cls, table, lens):
        """Number of tokens of each unit, all tokens and, with classes, their mask."""
        enc = pc.dictionary_encode(flat)
        idx = enc.indices.to_numpy(zero_copy_only=False)
        words = enc.dictionary.cast(pa.large_string())
        off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        special = pc.fill_null(pc.index_in(words, pa.array(SPECIAL_TOKENS, pa.large_string())), -1).to_numpy(zero_copy_only=False)
        # a special unit is one symbol, its id, which no merge takes
        symbols = symbol[np.frombuffer(words.buffers()[2] or b"", np.uint8)]
        sizes = np.diff(off)
        named = np.flatnonzero(special >= 0)
        symbols[off[named]] = special[named]
        sizes[named] = 1
        ids, u_len = bpe_words(symbols, off[:-1], sizes, table)
        u_off = np.concatenate([[0], np.cumsum(u_len)])
        tl = u_len[idx]
        unit_tok_off = np.concatenate([[0], np.cumsum(tl)])
        gather = np.repeat(u_off[idx] - unit_tok_off[:-1], tl) + np.arange(unit_tok_off[-1])
        if cls is None:
            return tl, ids[gather], None
        total = np.concatenate([[0], np.cumsum(lens[ids])])
        ends = total[1:] - np.repeat(total[u_off[:-1]], u_len)  # cumulative byte ends inside a unit
        cls_tok = np.repeat(cls, tl)
        return tl, ids[gather], ((cls_tok == 1) | ((cls_tok == 2) & (ends[gather] > 1))).astype(np.int32)

    def encode_batches(batches):
        table = MergeTable(ranks_bc.value)
        lens = np.zeros(max(vocab_len_bc.value) + 1, np.int64)
        lens[list(vocab_len_bc.value)] = list(vocab_len_bc.value.values())
        for rb in batches:
            col = rb.column(rb.schema.get_field_index(units_col))
            row_units = np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            flat = pc.list_flatten(col)
            cls = None if cls_col is None else pc.list_flatten(rb.column(rb.schema.get_field_index(cls_col))).to_numpy(zero_copy_only=False)
            size = np.concatenate([[0], np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False) + 1, dtype=np.int64)])  # of all units before
            names = [f.name for f in rb.schema if f.name not in (units_col, cls_col)]
            for a, b in _pieces(size[row_units] + np.arange(1, len(row_units) + 1), SLICE_BYTES):
                first, last = int(row_units[a - 1]) if a else 0, int(row_units[b - 1])
                done = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
                for x, y in _pieces(size[first + 1:last + 1] - size[first], SLICE_BYTES):
                    x, y = first + x, first + y
                    done.append(encode_units(flat.slice(x, y - x), None if cls is None else cls[x:y], table, lens))
                unit_tok_off = np.concatenate([[0], np.cumsum(np.concatenate([d[0] for d in done]))])
                row_tok_off = pa.array(unit_tok_off[np.concatenate([[0], row_units[a:b] - first])], pa.int32())
                lists = [pa.ListArray.from_arrays(row_tok_off, pa.array(np.concatenate([d[k] for d in done]), pa.int32()))
                         for k in ((1,) if cls is None else (1, 2))]
                yield pa.RecordBatch.from_arrays([*(rb.column(n).slice(a, b - a) for n in names), *lists],
                                                 names=[*names, "ids", *(["mask"] if cls is not None else [])])
    return encode_batches


def encode_units_narrow(df: DataFrame, model: BpeModel, units: str = "units", cls: str | None = None) -> DataFrame:
    """Narrow encode: replace ``units array<string>`` by the flattened token ``ids`` (and a
    token ``mask`` from per-unit classes ``cls``: 0 never, 1 always, 2 tokens ending past the
    first byte) inside each partition with ``mapInArrow``; no shuffle. The merge table is a
    broadcast variable bounded by the vocabulary size."""
    sc = df.sparkSession.sparkContext
    ranks_bc = sc.broadcast(model.ranks())
    lens_bc = sc.broadcast({i: len(b) for i, b in model.vocab.items()})
    fields = [f for f in df.schema.fields if f.name not in (units, cls)]
    fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if cls is not None:
        fields.append(T.StructField("mask", T.ArrayType(T.IntegerType())))
    return df.mapInArrow(_arrow_unit_encoder(ranks_bc, lens_bc, units, cls), T.StructType(fields))


def word_dictionary(words: DataFrame, model: BpeModel, word: str = "word") -> DataFrame:
    """Encode each row of a (distinct) word column once: ``(word, ids, ends)``."""
    sc = words.sparkSession.sparkContext
    ranks_bc = sc.broadcast(model.ranks())
    lens_bc = sc.broadcast({i: len(b) for i, b in model.vocab.items()})
    return words.select(F.col(word).alias("word")).mapInPandas(_word_encoder(ranks_bc, lens_bc), DICT_SCHEMA)


def encode_exploded(units: DataFrame, model: BpeModel, unit: str = "unit") -> DataFrame:
    """Add ``ids``/``ends`` to a table with one unit per row (dictionary encode, steps 3-4)."""
    words = units.filter(~is_special(unit)).select(F.col(unit).alias("word")).distinct()
    dictionary = word_dictionary(words, model)
    joined = units.join(dictionary, units[unit] == dictionary["word"], "left").drop("word")
    sid = special_id(unit)
    return (joined
            .withColumn("ids", F.when(sid.isNotNull(), F.array(sid)).otherwise(F.col("ids")))
            .withColumn("ends", F.when(sid.isNotNull(), F.array(F.length(unit))).otherwise(F.col("ends"))))


def encode(df: DataFrame, model: BpeModel, keys: list[str], text: str = "text",
           max_len: int | None = None, bos: bool = False, out: str = "ids",
           keep: list[str] = (), strategy: str = "narrow") -> DataFrame:
    """D2/D3 (+E1): ``(keys..., keep..., out array<int>)``; ``keys`` must identify a row and
    ``keep`` columns must be functions of the keys. Rows without any unit get ``[]``.

    ``strategy="narrow"``: encode inside each partition (no shuffle, per-task word cache).
    ``strategy="dictionary"``: explode units, encode the distinct words once, join back and
    regroup (two shuffles; worth it only when words repeat across the whole corpus far more
    than inside one task)."""
    units = F.col("_units")
    if bos:
        units = F.concat(F.array(F.lit(SPECIAL_TOKENS[0])), units)
    if max_len is not None:
        units = truncate(units, max_len)
    with_units = with_text_units(spread(df.select(*keys, *keep, text)), text, "_units")
    if strategy == "narrow":
        enc = encode_units_narrow(with_units.select(*keys, *keep, units.alias("_units")), model, "_units")
        ids = F.col("ids")
        if max_len is not None:
            ids = truncate(ids, max_len)
        return enc.select(*keys, *keep, ids.alias(out))
    exploded = with_units.select(*keys, *keep, F.posexplode_outer(units).alias("upos", "unit"))
    enc = encode_exploded(exploded, model)
    piece = F.when(F.col("unit").isNotNull(), F.struct("upos", "ids"))
    seqs = enc.groupBy(*keys, *keep).agg(F.array_sort(F.collect_list(piece)).alias("_u"))
    ids = F.flatten(F.transform("_u", lambda u: u["ids"]))
    if max_len is not None:
        ids = truncate(ids, max_len)
    return seqs.select(*keys, *keep, ids.alias(out))


def vocab_map(model: BpeModel) -> Column:
    """Literal ``array<string>`` of hex-encoded token bytes indexed by id (ids are dense), so a
    lookup is an O(1) array index; its size is bounded by the vocabulary size."""
    n = max(model.vocab) + 1
    items = ",".join("'" + model.vocab.get(i, b"").hex().upper() + "'" for i in range(n))
    return F.expr(f"array({items})")


def decode(ids, vmap: Column, skip_special: bool = True) -> Column:
    """Ids -> text (malformed UTF-8 becomes U+FFFD)."""
    from .sampling import bytes_to_text, decode_bytes
    return bytes_to_text(decode_bytes(ids, vmap, skip_special))
