"""Registered queries: one per operator of the inventory, each over the driver's tables.

Every entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``. Oracle SQL
is DuckDB SQL over the same parquet tables; columns carry the same names, integer columns are
BIGINT on both sides and doubles are rounded to 6 places. Arrays are compared as strings.
Merge training is repeated in SQL step by step (one character per symbol, as many steps as the
registered vocabulary has merges); ids, rows and masks follow from its final strings.
"""

from __future__ import annotations

import functools
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import BYTE_TO_ID, SPECIAL_TOKENS, nfkc, pretokens, split_specials
from ..operators import batches as G
from ..operators import bpe as C
from ..operators import encode as D
from ..operators import evaluate as H
from ..operators import examples as X
from ..operators import routing as J
from ..operators import runlog as K
from ..operators import sampling as I
from ..operators import turns as B
from ..session import ensure_checkpoint_dir, table
from ..sources import io as S

REGISTRY: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _t(spark, sf, name) -> DataFrame:
    return table(spark, sf, name)


def _r(c, places: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def _scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder under the reliable checkpoint directory (shared on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tessera-io", f"{what}-{uuid.uuid4().hex}")


TOKENIZER_VOCAB = 600  # of the registered trained queries; DuckDB binds no more than some 450 merge steps


@functools.lru_cache(maxsize=8)
def _trained(spark_id: int, sf: str, vocab: int) -> C.BpeModel:
    spark = SparkSession.getActiveSession()
    return C.train_tokenizer(_t(spark, sf, "documents"), vocab_size=vocab)


def trained_model(spark: SparkSession, sf: str, vocab: int = TOKENIZER_VOCAB) -> C.BpeModel:
    return _trained(id(spark), sf, vocab)


# ------------------------------------------------------------------------------------------
# DuckDB helpers (oracle side)

def _duck_byte_id(b: str) -> str:
    """SQL CASE mapping a byte value to its base symbol id (same rule as BYTE_TO_ID)."""
    assert BYTE_TO_ID[33] == 3 and BYTE_TO_ID[0] == 191 and BYTE_TO_ID[173] == 258
    return (f"(CASE WHEN {b} BETWEEN 33 AND 126 THEN {b} - 30 WHEN {b} BETWEEN 161 AND 172 THEN {b} - 64 "
            f"WHEN {b} BETWEEN 174 AND 255 THEN {b} - 65 WHEN {b} <= 32 THEN {b} + 191 "
            f"WHEN {b} BETWEEN 127 AND 160 THEN {b} + 97 ELSE 258 END)")


def _duck_byte_ids(s: str) -> str:
    """SQL list of base symbol ids of a string's UTF-8 bytes."""
    h = f"hex(encode({s}))"
    return (f"list_transform(range(0, length({h}) // 2), "
            f"lambda i: {_duck_byte_id(f'(' + chr(39) + '0x' + chr(39) + f' || substr({h}, 2*i+1, 2))::INTEGER')})")


# Pre-token split without look-ahead: a sentinel (chr 1) is put before the last white-space
# character of a run that precedes a non-space, then the look-ahead-free pattern runs.
_DUCK_WORDS = (r"regexp_extract_all(regexp_replace({col}, '(\s+)(\s\S)', '\1' || chr(1) || '\2', 'g'), "
               r"'''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}' || chr(1) || ']+|\s+')")


def _duck_words(col: str) -> str:
    return _DUCK_WORDS.format(col=col)


def _bpe_cte(vocab: int = TOKENIZER_VOCAB) -> str:
    """CTEs that train merges greedily: ``enc`` (word, sym: one character, id + 256, per symbol),
    ``merges`` (rank, left, right, new) and ``voc`` (id, token_hex) with specials, bytes and merges."""
    first = len(BYTE_TO_ID) + 3
    steps = vocab - first
    parts = [f"w0 AS MATERIALIZED (SELECT word, count(*) AS cnt, array_to_string(list_transform({_duck_byte_ids('word')}, lambda b: chr(b + 256)), '') AS sym "
             f"FROM (SELECT unnest({_duck_words('text')}) AS word FROM documents) GROUP BY word)"]
    for k in range(steps):
        parts.append(f"p{k} AS MATERIALIZED (SELECT pair, sum(cnt) AS n FROM (SELECT unnest(list_transform(range(1, length(sym)), "
                     f"lambda i: substr(sym, i, 2))) AS pair, cnt FROM w{k}) GROUP BY pair HAVING sum(cnt) >= 2 ORDER BY n DESC, pair LIMIT 1)")
        parts.append(f"w{k + 1} AS MATERIALIZED (SELECT word, cnt, replace(sym, (SELECT pair FROM p{k}), chr({first + 256 + k})) AS sym FROM w{k})")
    parts.append(f"enc AS MATERIALIZED (SELECT word, sym FROM w{steps})")
    parts.append("merges AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT {k} AS rank, unicode(substr(pair, 1, 1)) - 256 AS l, unicode(substr(pair, 2, 1)) - 256 AS r, {first + k} AS new FROM p{k}" for k in range(steps)) + ")")
    specials = ", ".join(f"'{t.encode().hex().upper()}'" for t in SPECIAL_TOKENS)
    base = ", ".join(f"'{b:02X}'" for b, _ in sorted(enumerate(BYTE_TO_ID), key=lambda x: x[1]))
    parts.append(f"grown AS (SELECT -1 AS k, [{specials}, {base}] AS hexes UNION ALL SELECT rank, list_append(hexes, hexes[l + 1] || hexes[r + 1]) "
                 "FROM grown JOIN merges ON rank = k + 1)")
    parts.append("voc AS MATERIALIZED (SELECT unnest(range(0, len(hexes))) AS id, unnest(hexes) AS token_hex FROM (SELECT hexes FROM grown ORDER BY k DESC LIMIT 1))")
    return "WITH RECURSIVE " + ", ".join(parts)


_IDS_OF_SYM = "list_transform(range(1, length(sym) + 1), lambda i: unicode(substr(sym, i, 1)) - 256)"
_DOC_IDS = (", d AS (SELECT doc_id, unnest(" + _duck_words("text") + ") AS word, generate_subscripts(" + _duck_words("text") + ", 1) AS i FROM documents), "
            "doc_syms AS (SELECT doc_id, string_agg(sym, '' ORDER BY i) AS sym FROM d JOIN enc USING (word) GROUP BY doc_id), "
            "doc_ids AS (SELECT doc_id, CASE WHEN sym IS NULL THEN [] ELSE " + _IDS_OF_SYM + " END AS ids FROM documents LEFT JOIN doc_syms USING (doc_id))")


# ==========================================================================================
# A. sources and sinks

@query("corpus_size", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM documents")
def q_corpus_size(spark, sf):
    return S.corpus_size(_t(spark, sf, "documents"))


@query("head_lines", "SELECT doc_id, n_chars FROM documents WHERE doc_id < (SELECT count(*) // 2 FROM documents)")
def q_head_lines(spark, sf):
    # the limit is the operator: here the first half of the lines (ids are dense line numbers)
    docs = _t(spark, sf, "documents")
    return S.head_lines(docs, docs.count() // 2, "doc_id").select("doc_id", "n_chars")


@query("rows_at", "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_rows_at(spark, sf):
    return S.rows_at(_t(spark, sf, "documents"), _t(spark, sf, "labels").select("doc_id"), "doc_id") \
            .select("doc_id", "n_chars")


@query("read_corpus_jsonl",
       "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, CAST(length(text) AS BIGINT) AS n_chars "
       "FROM documents")
def q_read_corpus(spark, sf):
    docs = _t(spark, sf, "documents")
    path = _scratch(spark, "corpus")
    # write the corpus as JSON lines in doc_id order (range-partitioned, files in part order)
    docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id") \
        .select("text").write.json(path)
    back = S.read_corpus(spark, path)
    return back.select("row_id", F.length("text").cast("long").alias("n_chars"))


@query("read_conversations_jsonl",
       "SELECT row_number() OVER (ORDER BY conv_id) - 1 AS row_id, CAST(count(*) AS BIGINT) AS n_turns, "
       "CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS n_human "
       "FROM conversations GROUP BY conv_id")
def q_read_conversations(spark, sf):
    conv = _t(spark, sf, "conversations")
    raw = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.when(F.col("role") == "user", "human").otherwise(F.col("role")).alias("from"),
        F.col("text").alias("value")))).alias("c"))
    raw = raw.select("conv_id", F.transform("c", lambda x: F.struct(x["from"].alias("from"),
                                                                 x["value"].alias("value"))).alias("conversations"))
    path = _scratch(spark, "sft")
    raw.repartitionByRange("conv_id").sortWithinPartitions("conv_id").select("conversations").write.json(path)
    back = S.read_conversations(spark, path)
    return back.select("row_id", F.size("conversations").cast("long").alias("n_turns"),
                       F.size(F.filter("conversations", lambda m: m["from"] == "human")).cast("long").alias("n_human"))


_LATEST_SQL = ("SELECT user_id, event_type, arg_max(value, ts) AS value, epoch_us(max(ts)) AS step "
               "FROM events GROUP BY user_id, event_type")


@query("metrics_csv_roundtrip", _LATEST_SQL)
def q_metrics_csv(spark, sf):
    ev = _t(spark, sf, "events").withColumn("step", K.epoch_micros("ts"))
    latest = K.latest_metrics(ev, "user_id", "event_type", "step", "value")
    path = _scratch(spark, "metrics")
    S.write_metrics(latest, path)
    return S.read_metrics(spark, path, "user_id long, event_type string, value double, step long")


@query("scalars_roundtrip_span",
       "SELECT CAST(user_id AS VARCHAR) AS run, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_s "
       "FROM events GROUP BY user_id")
def q_scalars(spark, sf):
    path = _scratch(spark, "scalars")
    S.scalars_from_events(_t(spark, sf, "events")).write.parquet(path)
    sc = S.read_scalars(spark, path)
    span = sc.groupBy("run").agg((F.max("wall_time") - F.min("wall_time")).alias("d"))
    return span.select("run", _r("d").alias("duration_s"))


@query("tokenizer_save_load", _bpe_cte() + " SELECT CAST(id AS BIGINT) AS id, token_hex FROM voc")
def q_tokenizer_save_load(spark, sf):
    model = trained_model(spark, sf)
    path = _scratch(spark, "tokenizer")
    S.save_tokenizer(spark, model, path)
    back = S.load_tokenizer(spark, path)
    assert back.vocab == model.vocab and back.merges == model.merges
    return back.vocab_df(spark).select(F.col("id").cast("long").alias("id"), F.hex("token_bytes").alias("token_hex"))


# ==========================================================================================
# B. projections, filters, conversation shaping

@query("extract_text", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def q_extract_text(spark, sf):
    lines = _t(spark, sf, "documents").select("doc_id", F.to_json(F.struct("text")).alias("value"))
    return B.extract_text(lines).select("doc_id", F.length("text").cast("long").alias("n_chars"))


@query("normalize_turns",
       "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx, role, "
       "CAST(length(text) AS BIGINT) AS n_chars FROM conversations")
def q_normalize_turns(spark, sf):
    conv = _t(spark, sf, "conversations")
    nested = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.when(F.col("role") == "user", "human").otherwise(F.col("role")).alias("from"),
        F.col("text").alias("value")))).alias("conversations"))
    norm = B.normalize_turns(nested)
    return norm.select("conv_id", F.posexplode("messages").alias("idx", "m")) \
               .select("conv_id", F.col("idx").cast("long").alias("idx"), F.col("m.role").alias("role"),
                       F.length("m.content").cast("long").alias("n_chars"))


@query("fold_turns",
       "SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, CAST(count(*) AS BIGINT) AS n_msgs, "
       "CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id")
def q_fold_turns(spark, sf):
    f = B.fold_turns(_t(spark, sf, "conversations"))
    return f.select("conv_id", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
                    F.size("messages").cast("long").alias("n_msgs"),
                    F.aggregate("messages", F.lit(0).cast("long"),
                                lambda acc, m: acc + F.length(m["content"])).alias("n_chars"))


@query("known_roles",
       "SELECT role, CAST(count(*) AS BIGINT) AS n FROM conversations "
       "WHERE role IN ('user', 'system', 'assistant') AND (conv_id + turn) % 7 <> 3 GROUP BY role")
def q_known_roles(spark, sf):
    # every seventh turn is given a role that the template does not know
    turns = _t(spark, sf, "conversations").withColumn("role", F.when((F.col("conv_id") + F.col("turn")) % 7 == 3, "tool").otherwise(F.col("role")))
    return B.known_roles(turns).groupBy("role") \
            .agg(F.count(F.lit(1)).alias("n"))


SYSTEM_PROMPT_FIXTURE = "You are a helpful assistant."


@query("with_system_turn",
       "SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n_chars FROM conversations "
       "UNION ALL SELECT conv_id, min(turn) - 1, 'system', 28 FROM conversations GROUP BY conv_id")
def q_with_system_turn(spark, sf):
    out = B.with_system_turn(_t(spark, sf, "conversations"), SYSTEM_PROMPT_FIXTURE)
    return out.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"))


@query("drop_blank_replies",
       "SELECT role, CAST(count(*) AS BIGINT) AS n FROM conversations "
       "WHERE NOT (role = 'assistant' AND (conv_id % 5 = 2 OR trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') = '')) "
       "GROUP BY role")
def q_drop_blank(spark, sf):
    # the turns of every fifth conversation are blanked, so its replies go and its other turns stay
    turns = _t(spark, sf, "conversations").withColumn("text", F.when(F.col("conv_id") % 5 == 2, " \t\n\r\u3000").otherwise(F.col("text")))
    return B.drop_blank_replies(turns).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query("keep_last",
       "SELECT conv_id, turn, array_to_string(string_split(text, ' ')[-8:], ' ') AS tail FROM conversations")
def q_keep_last(spark, sf):
    conv = _t(spark, sf, "conversations")
    words = F.split("text", " ", -1)
    return conv.select("conv_id", "turn", F.array_join(A.keep_last(words, 8), " ").alias("tail"))


# ==========================================================================================
# C. tokenizer training

@query("word_counts", f"SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM "
                      f"(SELECT unnest({_duck_words('text')}) AS word FROM documents) GROUP BY word")
def q_word_counts(spark, sf):
    return C.word_counts(_t(spark, sf, "documents"))


@query("pretoken_counts", f"SELECT doc_id, CAST(len({_duck_words('text')}) AS BIGINT) AS n_pretokens FROM documents")
def q_pretoken_counts(spark, sf):
    docs = _t(spark, sf, "documents")
    return docs.select("doc_id", F.size(pretokens(nfkc("text"))).cast("long").alias("n_pretokens"))


@query("nfkc_lengths", "SELECT doc_id, CAST(length(nfc_normalize(text)) AS BIGINT) AS n_chars, md5(nfc_normalize(text)) AS text_md5 FROM documents")
def q_nfkc(spark, sf):
    # vowels are made full-width first; NFKC turns them back (SQL has NFC only, which the texts are in)
    wide = _t(spark, sf, "documents").withColumn("text", F.translate("text", "aeiouAEIOU", "\uff41\uff45\uff49\uff4f\uff55\uff21\uff25\uff29\uff2f\uff35"))
    back = wide.select("doc_id", nfkc("text").alias("text"))
    return back.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("byte_pair_counts",
       "WITH wc AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(" + _duck_words('text') + ") AS word "
       "FROM documents) GROUP BY word), "
       "s AS (SELECT " + _duck_byte_ids('word') + " AS sym, cnt FROM wc), "
       "p AS (SELECT sym[i] AS l, sym[i + 1] AS r, cnt FROM (SELECT sym, cnt, unnest(range(1, len(sym))) AS i FROM s)) "
       "SELECT l AS \"left\", r AS \"right\", CAST(sum(cnt) AS BIGINT) AS n FROM p GROUP BY l, r HAVING sum(cnt) >= 2")
def q_byte_pairs(spark, sf):
    return C.pair_counts(C.word_types(C.word_counts(_t(spark, sf, "documents"))), 2)


@query("tokenizer_vocab", _bpe_cte() + f" SELECT CAST(id AS BIGINT) AS id, token_hex, id < {len(SPECIAL_TOKENS)} AS is_special FROM voc")
def q_tokenizer_vocab(spark, sf):
    model = trained_model(spark, sf)
    return model.vocab_df(spark).select(F.col("id").cast("long").alias("id"),
                                        F.hex("token_bytes").alias("token_hex"), "is_special")


@query("tokenizer_merges", _bpe_cte() + ' SELECT CAST(rank AS BIGINT) AS rank, CAST(l AS BIGINT) AS "left", CAST(r AS BIGINT) AS "right", '
       "CAST(new AS BIGINT) AS new FROM merges")
def q_tokenizer_merges(spark, sf):
    merges = trained_model(spark, sf).merges_df(spark)
    return merges.select(*[F.col(c).cast("long").alias(c) for c in merges.columns])


# ==========================================================================================
# D. encode / decode

_RENDER_SEG_SQL = ("CASE WHEN role = 'user' THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) "
                   "WHEN role = 'system' THEN '<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10) "
                   "WHEN role = 'assistant' THEN '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' "
                   "ELSE '' END")


@query("split_specials",
       "WITH p AS (SELECT conv_id, string_agg(" + _RENDER_SEG_SQL + ", '' ORDER BY turn) AS prompt "
       "FROM conversations GROUP BY conv_id) "
       "SELECT conv_id, CAST(len(regexp_extract_all(prompt, '<\\|im_start\\|>|<\\|im_end\\|>|<unk>')) "
       "+ len(list_filter(regexp_split_to_array(prompt, '<\\|im_start\\|>|<\\|im_end\\|>|<unk>'), lambda s: s <> '')) "
       "AS BIGINT) AS n_pieces FROM p")
def q_split_specials(spark, sf):
    prompts = B.render_chat(_t(spark, sf, "conversations"))
    return prompts.select("conv_id", F.size(split_specials("prompt")).cast("long").alias("n_pieces"))


@query("encode_lengths", _bpe_cte() + _DOC_IDS + " SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, md5(array_to_string(ids, ' ')) AS ids_md5 FROM doc_ids")
def q_encode_lengths(spark, sf):
    model = trained_model(spark, sf)
    enc = D.encode(_t(spark, sf, "documents"), model, ["doc_id"])
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", " ")).alias("ids_md5"))


@query("decode_roundtrip", "SELECT doc_id, md5(text) AS back_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def q_decode_roundtrip(spark, sf):
    # decode(encode(x)) is NFKC(x) over whole texts, which these texts are
    model = trained_model(spark, sf)
    back = D.encode(_t(spark, sf, "documents"), model, ["doc_id"]).select("doc_id", D.decode("ids", D.vocab_map(model)).alias("back"))
    return back.select("doc_id", F.md5("back").alias("back_md5"), F.length("back").cast("long").alias("n_chars"))


@query("decode_specials",
       "SELECT doc_id, md5(text || text) AS dropped_md5, md5('<|im_start|>' || text || '<|im_end|>' || text || '<unk><|im_end|>') AS kept_md5 FROM documents")
def q_decode_specials(spark, sf):
    # control ids around and between the ids of whole texts, dropped or shown by decode
    model = C.BpeModel.base()
    ids = D.encode(_t(spark, sf, "documents"), model, ["doc_id"]).select("doc_id", F.concat(
        F.array(F.lit(0)), "ids", F.array(F.lit(1)), "ids", F.array(F.lit(2), F.lit(1))).alias("ids"))
    words = D.vocab_map(model)
    return ids.select("doc_id", F.md5(D.decode("ids", words)).alias("dropped_md5"), F.md5(D.decode("ids", words, skip_special=False)).alias("kept_md5"))


# ==========================================================================================
# E. language-model rows (byte-level tokenizer: no merges, so SQL can rebuild the ids)

BYTE_MAX_LEN = 512  # the reference's row length


def _byte_rows_sql(max_len: int) -> str:
    return (f"WITH b AS (SELECT doc_id, ([0] || {_duck_byte_ids('text')})[1:{max_len}] AS ids FROM documents), "
            f"p AS (SELECT doc_id, len(ids) AS n, ids || list_transform(range(0, {max_len} - len(ids)), lambda i: 1) AS padded "
            f"FROM b) ")


@query("pretrain_rows_bytes",
       _byte_rows_sql(BYTE_MAX_LEN) +
       f"SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, array_to_string(padded[1:{BYTE_MAX_LEN - 1}], ' ') AS input_ids, "
       f"array_to_string(list_transform(range(1, {BYTE_MAX_LEN}), lambda i: CASE WHEN i < n THEN padded[i + 1] "
       f"ELSE -100 END), ' ') AS labels FROM p")
def q_pretrain_bytes(spark, sf):
    rows = X.pretrain_examples(_t(spark, sf, "documents"), C.BpeModel.base(), max_len=BYTE_MAX_LEN)
    return rows.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


@query("attention_mask",
       _byte_rows_sql(BYTE_MAX_LEN) +
       f"SELECT doc_id, array_to_string(list_transform(range(0, {BYTE_MAX_LEN}), lambda i: CASE WHEN i < n THEN 1 ELSE 0 END), '') AS mask, "
       "array_to_string(padded, ' ') AS ids FROM p")
def q_attention_mask(spark, sf):
    ids = D.encode(_t(spark, sf, "documents"), C.BpeModel.base(), ["doc_id"], max_len=BYTE_MAX_LEN, bos=True)
    return ids.select("doc_id", F.array_join(A.attention_mask("ids", BYTE_MAX_LEN), "").alias("mask"),
                      F.array_join(A.pad("ids", BYTE_MAX_LEN), " ").alias("ids"))


@query("supervision_stats",
       _byte_rows_sql(BYTE_MAX_LEN) +
       "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_supervised, "
       "CAST(count(CASE WHEN n <= 1 THEN 1 END) AS BIGINT) AS n_unsupervised_rows FROM p")
def q_supervision_stats(spark, sf):
    rows = X.pretrain_examples(_t(spark, sf, "documents"), C.BpeModel.base(), max_len=BYTE_MAX_LEN)
    return X.supervision_stats(rows).select(F.col("n_rows").cast("long").alias("n_rows"), "n_supervised",
                                            F.col("n_unsupervised_rows").cast("long").alias("n_unsupervised_rows"))


@query("pretrain_rows",
       _bpe_cte() + _DOC_IDS + ", b AS (SELECT doc_id, ([0] || ids)[1:512] AS ids FROM doc_ids), "
       "p AS (SELECT doc_id, len(ids) AS n, ids || list_transform(range(0, 512 - len(ids)), lambda i: 1) AS padded FROM b) "
       "SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, CAST(n - 1 AS BIGINT) AS n_supervised, array_to_string(padded[1:511], ' ') AS input_ids, "
       "array_to_string(list_transform(range(1, 512), lambda i: CASE WHEN i < n THEN padded[i + 1] ELSE -100 END), ' ') AS labels FROM p")
def q_pretrain_rows(spark, sf):
    rows = X.pretrain_examples(_t(spark, sf, "documents"), trained_model(spark, sf), max_len=512)
    return rows.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       A.supervised_count("labels").cast("long").alias("n_supervised"),
                       F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


# ==========================================================================================
# F. chat rows

@query("render_chat",
       "SELECT conv_id, string_agg(" + _RENDER_SEG_SQL + ", '' ORDER BY turn) AS prompt FROM conversations GROUP BY conv_id")
def q_render_chat(spark, sf):
    return B.render_chat(_t(spark, sf, "conversations"))


@query("render_chat_generation_prompt",
       "SELECT conv_id, string_agg(" + _RENDER_SEG_SQL + ", '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) "
       "AS prompt FROM conversations GROUP BY conv_id")
def q_render_chat_gen(spark, sf):
    return B.render_chat(_t(spark, sf, "conversations"), add_generation_prompt=True)


@query("assistant_spans",
       "WITH s AS (SELECT conv_id, turn, role, text, COALESCE(sum(length(" + _RENDER_SEG_SQL + ")) OVER "
       "(PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before "
       "FROM conversations) SELECT conv_id, turn, CAST(before + 22 AS BIGINT) AS span_start, "
       "CAST(before + 22 + length(text) + 10 AS BIGINT) AS span_end FROM s WHERE role = 'assistant'")
def q_assistant_spans(spark, sf):
    return B.assistant_spans(_t(spark, sf, "conversations"))


SFT_BYTE_MAX_LEN = 512


def _sft_bytes_sql(max_len: int) -> str:
    ids_turn = ("CASE WHEN role IN ('user', 'system', 'assistant') THEN [0] || " + _duck_byte_ids("role || chr(10) || text")
                + " || [1] || (CASE WHEN role = 'assistant' THEN [] ELSE [201] END) ELSE [] END")
    mask_turn = ("CASE WHEN role = 'assistant' THEN list_transform(range(0, octet_length(encode('assistant' || chr(10))) + 1), lambda i: 0) "
                 "|| list_transform(range(0, octet_length(encode(text)) + 1), lambda i: 1) "
                 "WHEN role IN ('user', 'system') THEN list_transform(range(0, octet_length(encode(role || chr(10) || text)) + 3), "
                 "lambda i: 0) ELSE [] END")
    return (f"WITH t AS (SELECT conv_id, turn, {ids_turn} AS ids, {mask_turn} AS mask FROM conversations), "
            f"c AS (SELECT conv_id, flatten(list(ids ORDER BY turn))[1:{max_len}] AS ids, "
            f"flatten(list(mask ORDER BY turn))[1:{max_len}] AS mask FROM t GROUP BY conv_id), "
            f"p AS (SELECT conv_id, len(ids) AS n, mask, ids || list_transform(range(0, {max_len} - len(ids)), lambda i: 1) AS padded FROM c) "
            f"SELECT conv_id, CAST(n AS BIGINT) AS n_tokens, array_to_string(padded[1:{max_len - 1}], ' ') AS input_ids, "
            f"array_to_string(list_transform(range(1, {max_len}), lambda i: CASE WHEN i < n AND mask[i + 1] = 1 "
            f"THEN padded[i + 1] ELSE -100 END), ' ') AS labels FROM p")


@query("sft_rows_bytes", _sft_bytes_sql(SFT_BYTE_MAX_LEN))
def q_sft_bytes(spark, sf):
    rows = X.sft_examples(_t(spark, sf, "conversations"), C.BpeModel.base(), max_len=SFT_BYTE_MAX_LEN)
    return rows.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


def _chat_ids_sql(max_len: int) -> str:
    """``c`` (conv_id, ids, mask) of the trained tokenizer: turns are cut into words and words into
    tokens; a reply's tokens count from the second word on, of that word those that reach past its first byte."""
    seg = "role || chr(10) || text"
    return (", t AS (SELECT conv_id, turn, role, unnest(" + _duck_words(seg) + ") AS word, generate_subscripts(" + _duck_words(seg) + ", 1) AS i "
            "FROM conversations WHERE role IN ('user', 'system', 'assistant')), "
            "known AS MATERIALIZED (SELECT DISTINCT word FROM t), "
            # chat words that no document holds go through the same merges in rank order
            "fresh AS (SELECT word, -1 AS k, array_to_string(list_transform(" + _duck_byte_ids("word") + ", lambda b: chr(b + 256)), '') AS sym FROM known "
            "UNION ALL SELECT word, rank, replace(sym, chr(CAST(l + 256 AS INTEGER)) || chr(CAST(r + 256 AS INTEGER)), chr(CAST(new + 256 AS INTEGER))) "
            "FROM fresh JOIN merges ON rank = k + 1), "
            "chat AS MATERIALIZED (SELECT word, arg_max(sym, k) AS sym FROM fresh GROUP BY word), "
            "width AS (SELECT list(CAST(length(token_hex) // 2 AS BIGINT) ORDER BY id) AS w FROM voc), "
            "wordy AS MATERIALIZED (SELECT word, " + _IDS_OF_SYM + " AS ids FROM chat), "
            "tok AS MATERIALIZED (SELECT word, ids, list_transform(range(1, len(ids) + 1), lambda j: list_sum(list_transform(ids[1:j], lambda x: w[x + 1]))) AS ends "
            "FROM wordy, width), "
            "turns AS (SELECT conv_id, turn, role, flatten(list(ids ORDER BY i)) AS ids, "
            "flatten(list(list_transform(ends, lambda e: CASE WHEN role <> 'assistant' OR i = 1 THEN 0 WHEN i = 2 AND e <= 1 THEN 0 ELSE 1 END) ORDER BY i)) AS mask "
            "FROM t JOIN tok USING (word) GROUP BY conv_id, turn, role), "
            "closed AS (SELECT conv_id, turn, [0] || ids || [1] || (CASE WHEN role = 'assistant' THEN [] ELSE [201] END) AS ids, "
            "[0] || mask || (CASE WHEN role = 'assistant' THEN [1] ELSE [0, 0] END) AS mask FROM turns), "
            f"c AS (SELECT conv_id, coalesce(flatten(list(ids ORDER BY turn) FILTER (ids IS NOT NULL)), [])[1:{max_len}] AS ids, "
            f"coalesce(flatten(list(mask ORDER BY turn) FILTER (ids IS NOT NULL)), [])[1:{max_len}] AS mask "
            "FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN closed USING (conv_id) GROUP BY conv_id) ")


@query("sft_rows",
       _bpe_cte() + _chat_ids_sql(512) + ", p AS (SELECT conv_id, len(ids) AS n, mask, ids || list_transform(range(0, 512 - len(ids)), lambda i: 1) AS padded FROM c), "
       "q AS (SELECT conv_id, n, padded, list_transform(range(1, 512), lambda i: CASE WHEN i < n AND mask[i + 1] = 1 THEN padded[i + 1] ELSE -100 END) AS labels FROM p) "
       "SELECT conv_id, CAST(n AS BIGINT) AS n_tokens, CAST(len(list_filter(labels, lambda x: x <> -100)) AS BIGINT) AS n_supervised, "
       "array_to_string(padded[1:511], ' ') AS input_ids, array_to_string(labels, ' ') AS labels FROM q")
def q_sft_rows(spark, sf):
    rows = X.sft_examples(_t(spark, sf, "conversations"), trained_model(spark, sf), max_len=512)
    return rows.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.col("n_supervised").cast("long").alias("n_supervised"),
                       F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


@query("assistant_mask", _bpe_cte() + _chat_ids_sql(512) + "SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_tokens, "
       "CAST(coalesce(list_sum(mask), 0) AS BIGINT) AS n_assistant FROM c")
def q_assistant_mask(spark, sf):
    m = X.assistant_mask(_t(spark, sf, "conversations"), trained_model(spark, sf), max_len=512)
    return m.select("conv_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_assistant"))


# ==========================================================================================
# G. split, shuffle, batch (documents; seed 42, validation rate 0.05, batch 64)

_SPLIT_CTE = ("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS k, "
              "count(*) OVER () AS n FROM documents), "
              "s AS (SELECT doc_id, CASE WHEN k < floor(n * 0.05) THEN 'val' ELSE 'train' END AS split FROM r) ")
_EPOCH_CTE = _SPLIT_CTE + (", e AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:1:' || doc_id), doc_id) - 1 AS pos "
                           "FROM s WHERE split = 'train') ")


def _split(spark, sf) -> DataFrame:
    return G.exact_split(_t(spark, sf, "documents").select("doc_id"), "doc_id", 0.05, 42)


def _epoch1(spark, sf) -> DataFrame:
    train = G.split_view(_split(spark, sf), "train")
    return G.epoch_order(train, "doc_id", epoch=1, seed=42)


@query("exact_split", _SPLIT_CTE + "SELECT doc_id, split FROM s")
def q_exact_split(spark, sf):
    return _split(spark, sf)


@query("split_view_test", _SPLIT_CTE + "SELECT doc_id FROM s WHERE split = 'val'")
def q_split_view(spark, sf):
    return G.split_view(_split(spark, sf), "test").select("doc_id")


@query("epoch_batches", _EPOCH_CTE + "SELECT doc_id, pos, CAST(floor(pos / 64) AS BIGINT) AS batch_id FROM e")
def q_epoch_batches(spark, sf):
    return G.assign_batches(_epoch1(spark, sf), 64).select("doc_id", "pos", "batch_id")


@query("collate_batches",
       _EPOCH_CTE + "SELECT CAST(floor(pos / 64) AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows, "
       "string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY pos) AS doc_ids FROM e GROUP BY 1")
def q_collate(spark, sf):
    c = G.collate(G.assign_batches(_epoch1(spark, sf), 64), ["doc_id"])
    return c.select("batch_id", F.col("n_rows").cast("long").alias("n_rows"),
                    F.array_join(F.transform("doc_id", lambda x: x.cast("string")), ",").alias("doc_ids"))


LIMIT_FRACTION = 0.25


@query("limit_batches_fraction",
       _EPOCH_CTE + ", b AS (SELECT doc_id, CAST(floor(pos / 64) AS BIGINT) AS batch_id FROM e) "
       f"SELECT doc_id, batch_id FROM b WHERE batch_id < floor((SELECT max(batch_id) + 1 FROM b) * {LIMIT_FRACTION})")
def q_limit_fraction(spark, sf):
    return G.limit_batches(G.assign_batches(_epoch1(spark, sf), 64), LIMIT_FRACTION).select("doc_id", "batch_id")


@query("limit_batches_first",
       _EPOCH_CTE + "SELECT doc_id, CAST(floor(pos / 64) AS BIGINT) AS batch_id FROM e WHERE floor(pos / 64) < 3")
def q_limit_first(spark, sf):
    # overfit mode: the first 3 batches
    return G.limit_batches(G.assign_batches(_epoch1(spark, sf), 64), 3).select("doc_id", "batch_id")


@query("write_examples_by_split",
       _EPOCH_CTE + ", v AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM s WHERE split = 'val'), "
       "placed AS (SELECT 'train' AS split, doc_id, pos FROM e UNION ALL SELECT 'val', doc_id, pos FROM v), " +
       _byte_rows_sql(BYTE_MAX_LEN).removeprefix("WITH ") +
       "SELECT split, doc_id, CAST(pos AS BIGINT) AS pos, CAST(pos // 64 AS BIGINT) AS batch_id, CAST(n AS BIGINT) AS n_tokens, "
       f"md5(array_to_string(padded[1:{BYTE_MAX_LEN - 1}], ' ')) AS input_md5, md5(array_to_string(list_transform(range(1, {BYTE_MAX_LEN}), "
       "lambda i: CASE WHEN i < n THEN padded[i + 1] ELSE -100 END), ' ')) AS labels_md5 FROM placed JOIN p USING (doc_id)")
def q_write_examples(spark, sf):
    split = G.exact_split(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id", 0.05, 42)
    rows = X.pretrain_examples(split, C.BpeModel.base(), max_len=BYTE_MAX_LEN, keep=["split"])
    path = _scratch(spark, "examples")
    S.write_epoch(rows, path, "doc_id", epoch=1, seed=42)
    back = S.read_epoch(spark, path, 64)
    return back.select("split", "doc_id", "pos", "batch_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.md5(F.array_join("input_ids", " ")).alias("input_md5"), F.md5(F.array_join("labels", " ")).alias("labels_md5"))


@query("epoch_plan",
       _SPLIT_CTE + ", c AS (SELECT count(*) AS n FROM s WHERE split = 'train') "
       "SELECT CAST(n AS BIGINT) AS n_rows, CAST(ceil(n / 16) AS BIGINT) AS batches_per_epoch, "
       "CAST(ceil(ceil(n / 16) / 4) * 2 AS BIGINT) AS total_steps, "
       "CAST(greatest(1, floor(ceil(ceil(n / 16) / 4) * 2 * 0.1)) AS BIGINT) AS warmup_steps FROM c")
def q_epoch_plan(spark, sf):
    # MoE pretraining settings: 16 rows per batch, accumulation 4, 2 epochs, warm-up ratio 0.1
    n = G.split_view(_split(spark, sf), "train").agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(F.col("n_rows").cast("long").alias("n_rows"),
                    *G.epoch_plan("n_rows", 16, accumulate=4, epochs=2, warmup_ratio=0.1))


@query("shard_world3",
       _EPOCH_CTE + ", c AS (SELECT count(*) AS n, CAST(ceil(count(*) / 3) * 3 AS BIGINT) AS total FROM e), "
       "x AS (SELECT doc_id, pos AS slot FROM e UNION ALL "
       "SELECT doc_id, pos + n AS slot FROM e, c WHERE pos + n < total) "
       "SELECT doc_id, slot, CAST(slot % 3 AS INTEGER) AS rank FROM x")
def q_shard(spark, sf):
    e = _epoch1(spark, sf)
    n = e.count()
    return G.shard(e, 3, n).select("doc_id", "slot", "rank")


# ==========================================================================================
# H. evaluation: embeddings as 64-class logits (label 0..9); events as a metric log

_E_DOUBLE = "list_transform(embedding, lambda x: x::DOUBLE)"
_NLL_CTE = ("WITH m AS (SELECT vec_id, CASE WHEN vec_id % 7 = 3 OR vec_id // 64 = 2 THEN -100 ELSE label END AS label, " + _E_DOUBLE + " AS x FROM embeddings), "
            "m2 AS (SELECT vec_id, label, x, list_max(x) AS mx FROM m), "
            "l AS (SELECT vec_id, label, mx + ln(list_sum(list_transform(x, lambda v: exp(v - mx)))) - CASE WHEN label <> -100 THEN x[label + 1] END AS nll, "
            "row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM m2) ")


def _preds(spark, sf, ignoring: bool = True) -> DataFrame:
    # every seventh label, and all of the third batch, are ignored positions
    ignored = (F.col("vec_id") % 7 == 3) | (F.floor(F.col("vec_id") / 64) == 2)
    label = F.when(ignored, F.lit(-100)).otherwise(F.col("label")) if ignoring else F.col("label")
    return _t(spark, sf, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("logits"))


@query("argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS pred FROM embeddings")
def q_argmax(spark, sf):
    return _preds(spark, sf).select("vec_id", H.argmax("logits").cast("long").alias("pred"))


@query("nll", _NLL_CTE + "SELECT vec_id, round(nll, 6) AS nll FROM l")
def q_nll(spark, sf):
    return _preds(spark, sf).select("vec_id", _r(H.nll("logits", "label")).alias("nll"))


@query("masked_accuracy",
       "SELECT round(avg(CASE WHEN list_position(embedding, list_max(embedding)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) "
       "AS accuracy, CAST(count(*) AS BIGINT) AS n_tokens FROM embeddings WHERE vec_id % 7 <> 3 AND vec_id // 64 <> 2")
def q_accuracy(spark, sf):
    a = H.masked_accuracy(_preds(spark, sf))
    return a.select(_r("accuracy").alias("accuracy"), F.col("n_tokens").cast("long").alias("n_tokens"))


def _batched_preds(spark, sf, ignoring: bool = True) -> DataFrame:
    p = G.epoch_order(_preds(spark, sf, ignoring), "vec_id", epoch=0, shuffle=False)
    return G.assign_batches(p, 64)


@query("epoch_loss",
       _NLL_CTE + ", b AS (SELECT floor(pos / 64) AS batch_id, avg(nll) AS bl FROM l GROUP BY 1) "
       "SELECT round(avg(bl), 6) AS epoch_loss, CAST(count(bl) AS BIGINT) AS n_batches, "
       "CAST(count(*) - count(bl) AS BIGINT) AS n_empty_batches FROM b")
def q_epoch_loss(spark, sf):
    e = H.epoch_loss(_batched_preds(spark, sf))
    return e.select(_r("epoch_loss").alias("epoch_loss"), F.col("n_batches").cast("long").alias("n_batches"),
                    F.col("n_empty_batches").cast("long").alias("n_empty_batches"))


_ROUTE_CTE = ("WITH g AS (SELECT vec_id AS token_id, unnest(embedding)::DOUBLE AS logit, "
              "generate_subscripts(embedding, 1) - 1 AS expert_id, embedding FROM embeddings), "
              "r AS (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY logit DESC, expert_id) AS rank FROM g), "
              "k AS (SELECT *, max(logit) OVER (PARTITION BY token_id) AS mx FROM r WHERE rank <= 4), "
              "w AS (SELECT *, exp(logit - mx) / sum(exp(logit - mx)) OVER (PARTITION BY token_id) AS weight FROM k) ")


EXPERTS = 64  # every dimension of an embedding is the gate of one expert


def _gates(spark, sf) -> DataFrame:
    emb = _t(spark, sf, "embeddings")
    return emb.select(F.col("vec_id").alias("token_id"),
                      F.posexplode("embedding").alias("expert_id", "gate"),
                      F.col("embedding"))


def _routed(spark, sf) -> DataFrame:
    return J.route(J.noisy_gate(_gates(spark, sf), std=0.0, noise_gate=None), k=4)


def _balance_sql(group: str) -> str:
    keys = f"{group}, " if group else ""
    return (f"imp AS (SELECT {keys}expert_id, sum(weight) / any_value(nt) AS imp FROM wb GROUP BY {keys}expert_id), "
            f"bl AS (SELECT {keys}sum((ln(1 / 64) - ln(imp + 1e-8)) / 64) + ({EXPERTS} - count(*)) / 64 * (ln(1 / 64) - ln(1e-8)) "
            f"AS balance_loss FROM imp {('GROUP BY ' + group) if group else ''}) ")


@query("total_loss",
       _ROUTE_CTE.replace("WITH ", "WITH ", 1) + ", pos AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS p FROM embeddings), "
       "wb AS (SELECT w.*, floor(pos.p / 64) AS batch_id, count(DISTINCT w.token_id) OVER (PARTITION BY floor(pos.p / 64)) AS nt "
       "FROM w JOIN pos ON w.token_id = pos.vec_id), " + _balance_sql("batch_id") +
       ", m AS (SELECT vec_id, label, " + _E_DOUBLE + " AS x FROM embeddings), "
       "m2 AS (SELECT vec_id, label, x, list_max(x) AS mx FROM m), "
       "l AS (SELECT m2.vec_id, mx + ln(list_sum(list_transform(x, lambda v: exp(v - mx)))) - x[label + 1] AS nll, "
       "floor(pos.p / 64) AS batch_id FROM m2 JOIN pos ON m2.vec_id = pos.vec_id), "
       "ce AS (SELECT batch_id, avg(nll) AS ce FROM l GROUP BY batch_id) "
       "SELECT CAST(ce.batch_id AS BIGINT) AS batch_id, round(ce + 0.05 * balance_loss, 6) AS total_loss "
       "FROM ce JOIN bl ON ce.batch_id = bl.batch_id")
def q_total_loss(spark, sf):
    pos = _batched_preds(spark, sf, ignoring=False).select(F.col("vec_id").alias("token_id"), "batch_id", "logits", "label")
    routed = _routed(spark, sf).join(pos.select("token_id", "batch_id"), "token_id")
    n_tok = pos.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    aux = J.balance_loss(routed, EXPERTS, n_tok, by=("batch_id",))
    ce = H.batch_losses(pos, "batch_id")
    return ce.join(aux, "batch_id").select(
        "batch_id", _r(H.total_loss("batch_loss", "balance_loss", 0.05)).alias("total_loss"))


_METRIC_LOG = "user_id, event_type, ts, value, event_id"


@query("best_so_far",
       "SELECT event_id, max(value) OVER (PARTITION BY user_id, event_type ORDER BY ts "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM events")
def q_best_so_far(spark, sf):
    ev = _t(spark, sf, "events")
    return H.running_best(ev, "value", "ts", ["user_id", "event_type"], "max", keep=["event_id"]).select("event_id", "best_so_far")


_TRAIN_METRICS_SQL = ("SELECT 'm_' || event_type AS name, round(avg(value), 6) AS value FROM events GROUP BY event_type "
                      "UNION ALL SELECT 'least_' || event_type, round(min(value), 6) FROM events GROUP BY event_type")
_TEST_METRICS_SQL = ("SELECT 'm_' || event_type AS name, round(max(value), 6) AS value FROM events GROUP BY event_type "
                     "UNION ALL SELECT 'm_total' AS name, round(max(value), 6) AS value FROM events")
_MERGED_SQL = (f"WITH tr AS ({_TRAIN_METRICS_SQL}), te AS ({_TEST_METRICS_SQL}) "
               "SELECT COALESCE(te.name, tr.name) AS name, CASE WHEN te.name IS NOT NULL THEN te.value ELSE tr.value END "
               "AS value FROM tr FULL OUTER JOIN te ON tr.name = te.name")


def _merged(spark, sf) -> DataFrame:
    # names on both sides (m_...), on the train side only (least_...) and on the test side only (m_total)
    ev = _t(spark, sf, "events")
    per = ev.groupBy("event_type").agg(_r(F.avg("value")).alias("avg"), _r(F.min("value")).alias("min"), _r(F.max("value")).alias("max"))
    named = lambda prefix, value: per.select(F.concat(F.lit(prefix), "event_type").alias("name"), F.col(value).alias("value"))
    train = named("m_", "avg").unionByName(named("least_", "min"))
    test = named("m_", "max").unionByName(ev.agg(_r(F.max("value")).alias("value")).select(F.lit("m_total").alias("name"), "value"))
    return H.merge_metrics(train, test)


@query("merge_metrics", _MERGED_SQL)
def q_merge_metrics(spark, sf):
    return _merged(spark, sf)


@query("metric_value", f"SELECT name, value FROM ({_MERGED_SQL}) WHERE name = 'm_click'")
def q_metric_value(spark, sf):
    return H.metric_value(_merged(spark, sf), "m_click")


@query("best_checkpoints",
       "WITH v AS (SELECT *, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'inf'::DOUBLE ELSE value END AS v FROM events) "
       "SELECT event_id, rank FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type "
       "ORDER BY v IS NULL, v, ts) AS rank FROM v) WHERE rank <= 3")
def q_best_checkpoints(spark, sf):
    # some values are missing (rank last) or NaN (rank like the worst value)
    k = F.col("event_id") % 5
    ev = _t(spark, sf, "events").withColumn("value", F.when(k == 1, float("nan")).when(k != 0, F.col("value")))
    b = H.best_checkpoints(ev, 3, "value", "ts", ["user_id", "event_type"], "min")
    return b.select("event_id", F.col("rank").cast("long").alias("rank"))


@query("early_stop",
       "WITH e AS (SELECT user_id, event_type, ts, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS i, "
       "min(value) OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb "
       "FROM events), f AS (SELECT *, (pb IS NULL OR value < pb) AS imp FROM e), "
       "g AS (SELECT *, i - max(CASE WHEN imp THEN i ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY ts "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wait FROM f), "
       "h AS (SELECT *, min(CASE WHEN wait >= 3 THEN i END) OVER (PARTITION BY user_id, event_type) AS si FROM g) "
       "SELECT user_id, event_type, epoch_us(min(CASE WHEN i = si THEN ts END)) AS stop_at_us, "
       "CASE WHEN max(si) IS NOT NULL THEN 'patience' END AS reason, "
       "min(CASE WHEN si IS NULL OR i < si THEN value END) AS best FROM h GROUP BY user_id, event_type")
def q_early_stop(spark, sf):
    e = H.early_stop_points(_t(spark, sf, "events"), "value", "ts", ["user_id", "event_type"], patience=3, mode="min")
    return e.select("user_id", "event_type", K.epoch_micros("stop_at").alias("stop_at_us"), "reason", "best")


_EARLY_STOP_DELTA_SQL = """
WITH RECURSIVE e AS (
  SELECT user_id, event_type, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS i FROM events),
s(user_id, event_type, i, best, wait, stop_ts, done) AS (
  SELECT DISTINCT user_id, event_type, CAST(0 AS BIGINT), CAST('Infinity' AS DOUBLE), 0,
         CAST(NULL AS TIMESTAMP), false FROM e
  UNION ALL
  SELECT s.user_id, s.event_type, e.i,
         CASE WHEN e.value + 1.0 < s.best THEN e.value ELSE s.best END,
         CASE WHEN e.value + 1.0 < s.best THEN 0 ELSE s.wait + 1 END,
         CASE WHEN NOT (e.value + 1.0 < s.best) AND s.wait + 1 >= 3 THEN e.ts END,
         NOT (e.value + 1.0 < s.best) AND s.wait + 1 >= 3
  FROM s JOIN e ON e.user_id = s.user_id AND e.event_type = s.event_type AND e.i = s.i + 1
  WHERE NOT s.done)
SELECT user_id, event_type, epoch_us(max(stop_ts)) AS stop_at_us,
       CASE WHEN max(stop_ts) IS NOT NULL THEN 'patience' END AS reason,
       CASE WHEN isinf(arg_max(best, i)) THEN NULL ELSE arg_max(best, i) END AS best
FROM s GROUP BY user_id, event_type
"""


@query("early_stop_min_delta", _EARLY_STOP_DELTA_SQL)
def q_early_stop_delta(spark, sf):
    e = H.early_stop_delta(_t(spark, sf, "events"), "value", "ts", ["user_id", "event_type"], patience=3,
                           min_delta=1.0, mode="min")
    return e.select("user_id", "event_type", K.epoch_micros("stop_at").alias("stop_at_us"), "reason", "best")


@query("non_finite",
       "WITH v AS (SELECT CASE event_id % 11 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE "
       "WHEN 3 THEN NULL ELSE value END AS value FROM events) "
       "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(CASE WHEN isnan(value) OR isinf(value) THEN 1 END) AS BIGINT) "
       "AS n_non_finite FROM v")
def q_non_finite(spark, sf):
    k = F.col("event_id") % 11
    odd = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).when(k == 3, F.lit(None)).otherwise(F.col("value"))
    ev = _t(spark, sf, "events").withColumn("value", odd)
    return ev.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(H.non_finite("value"), 1)).alias("n_non_finite"))


@query("best_trial",
       "SELECT arg_max(user_id, m) AS user_id, round(max(m), 6) AS metric FROM "
       "(SELECT user_id, avg(value) AS m FROM events GROUP BY user_id)")
def q_best_trial(spark, sf):
    trials = _t(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("metric"))
    b = H.best_trial(trials, "metric", ["user_id"], "max")
    return b.select("user_id", _r("metric").alias("metric"))


# ==========================================================================================
# I. sampling over score tables

_TOPK_CTE = ("WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE / 0.7::DOUBLE AS s, "
             "generate_subscripts(embedding, 1) - 1 AS class_id FROM embeddings), "
             "r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, class_id) AS rank FROM u), "
             "k AS (SELECT *, max(s) OVER (PARTITION BY vec_id) AS mx FROM r WHERE rank <= 5), "
             "p AS (SELECT vec_id, rank, class_id, exp(s - mx) / sum(exp(s - mx)) OVER (PARTITION BY vec_id) AS p FROM k) ")


def _topk(spark, sf) -> DataFrame:
    emb = _t(spark, sf, "embeddings")
    return emb.select("vec_id", I.softmax_topk(I.top_k(I.temperature("embedding", 0.7), 5)).alias("probs"))


@query("temperature_topk_softmax",
       _TOPK_CTE + "SELECT vec_id, CAST(rank AS BIGINT) AS rank, CAST(class_id AS BIGINT) AS class_id, round(p, 6) AS p FROM p")
def q_topk(spark, sf):
    t = _topk(spark, sf).select("vec_id", F.posexplode("probs").alias("i", "e"))
    return t.select("vec_id", (F.col("i") + 1).cast("long").alias("rank"), F.col("e.id").cast("long").alias("class_id"),
                    _r(F.col("e.p")).alias("p"))


@query("sample_topk",
       _TOPK_CTE + ", c AS (SELECT vec_id, rank, class_id, sum(p) OVER (PARTITION BY vec_id ORDER BY rank "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, "
       "('0x' || substr(md5('7:' || vec_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM p) "
       "SELECT vec_id, CAST(COALESCE(min(CASE WHEN cum > u THEN rank * 1000 + class_id END) % 1000, "
       "arg_max(class_id, rank)) AS BIGINT) AS sampled FROM c GROUP BY vec_id")
def q_sample(spark, sf):
    t = _topk(spark, sf)
    return t.select("vec_id", I.sample_topk("probs", 7, "vec_id").cast("long").alias("sampled"))


_GEN_IDS = "list_transform(embedding, lambda x: CAST(floor(abs(x) * 3) AS INTEGER))"


@query("cut_at_eos",
       "WITH g AS (SELECT vec_id, " + _GEN_IDS + "[1:256] AS ids FROM embeddings) "
       "SELECT vec_id, array_to_string(CASE WHEN list_position(ids, 1) > 0 THEN ids[1:list_position(ids, 1)] "
       "ELSE ids END, ' ') AS kept FROM g")
def q_cut_at_eos(spark, sf):
    emb = _t(spark, sf, "embeddings")
    ids = F.transform("embedding", lambda x: F.floor(F.abs(x) * 3).cast("int"))
    return emb.select("vec_id", F.array_join(A.cut_at_eos(ids, 1, 256), " ").alias("kept"))


# a character shows at the step of its first byte: itself if that is its only one, else U+FFFD, in whose place it stands later
@query("text_deltas",
       "WITH c AS (SELECT doc_id, regexp_extract_all(text, '.', 0, 's') AS chars FROM documents), "
       "o AS (SELECT doc_id, unnest(chars) AS c, generate_subscripts(chars, 1) AS i FROM c) "
       "SELECT doc_id AS gen_id, CAST(sum(strlen(c)) OVER (PARTITION BY doc_id ORDER BY i) - strlen(c) AS BIGINT) AS step, "
       "CASE WHEN strlen(c) = 1 THEN c ELSE chr(65533) END AS delta FROM o")
def q_text_deltas(spark, sf):
    # generated tokens: each document's byte symbols, one per step (base vocabulary)
    model = C.BpeModel.base()
    gen = D.encode(_t(spark, sf, "documents"), model, ["doc_id"])
    steps = gen.select(F.col("doc_id").alias("gen_id"), "ids")
    return I.text_deltas(steps, D.vocab_map(model), ids="ids").withColumn("step", F.col("step").cast("long"))


# ==========================================================================================
# J. expert routing: embedding dimensions as gates of 64 experts, top 4

@query("route_topk",
       _ROUTE_CTE + "SELECT token_id, CAST(expert_id AS BIGINT) AS expert_id, CAST(rank AS BIGINT) AS rank, "
       "round(weight, 6) AS weight FROM w")
def q_route(spark, sf):
    r = _routed(spark, sf)
    return r.select("token_id", F.col("expert_id").cast("long").alias("expert_id"),
                    F.col("rank").cast("long").alias("rank"), _r("weight").alias("weight"))


@query("dispatch",
       _ROUTE_CTE + "SELECT CAST(expert_id AS BIGINT) AS expert_id, CAST(count(*) AS BIGINT) AS n_tokens, "
       "round(sum(weight), 6) AS weight_sum FROM w GROUP BY expert_id")
def q_dispatch(spark, sf):
    d = J.dispatch(_routed(spark, sf))
    return d.select(F.col("expert_id").cast("long").alias("expert_id"), F.col("n_tokens").cast("long").alias("n_tokens"),
                    _r("weight_sum").alias("weight_sum"))


@query("combine",
       _ROUTE_CTE + "SELECT token_id, round(sum(weight * embedding[64 - expert_id]::DOUBLE), 6) AS combined "
       "FROM w GROUP BY token_id")
def q_combine(spark, sf):
    r = _routed(spark, sf).withColumn("expert_out", F.get("embedding", 63 - F.col("expert_id")).cast("double"))
    return J.combine(r).select("token_id", _r("combined").alias("combined"))


@query("balance_loss",
       _ROUTE_CTE + ", wb AS (SELECT *, (SELECT count(*) FROM embeddings) AS nt FROM w), " + _balance_sql("") +
       "SELECT round(balance_loss, 6) AS balance_loss FROM bl")
def q_balance(spark, sf):
    n = _t(spark, sf, "embeddings").agg(F.count(F.lit(1)).alias("n"))
    b = J.balance_loss(_routed(spark, sf), EXPERTS, n)
    return b.select(_r("balance_loss").alias("balance_loss"))


@query("balance_loss_layers",
       _ROUTE_CTE + ", wb AS (SELECT *, token_id % 3 AS layer, count(DISTINCT token_id) OVER (PARTITION BY token_id % 3) AS nt FROM w), " + _balance_sql("layer") +
       "SELECT round(sum(balance_loss), 6) AS balance_loss FROM bl")
def q_balance_layers(spark, sf):
    # the loss summed over layers: here every third token belongs to one layer
    layer = (F.col("token_id") % 3).alias("layer")
    n = _t(spark, sf, "embeddings").groupBy((F.col("vec_id") % 3).alias("layer")).agg(F.count(F.lit(1)).alias("n"))
    b = J.balance_loss(_routed(spark, sf).select("*", layer), EXPERTS, n, layer="layer")
    return b.select(_r("balance_loss").alias("balance_loss"))


# ==========================================================================================
# K. run logs: events as scalar logs (run = user)

_DUR_TEXT = ("(CASE WHEN tot // 86400 <> 0 THEN CAST(tot // 86400 AS VARCHAR) || '天' ELSE '' END) || "
             "(CASE WHEN (tot % 86400) // 3600 <> 0 THEN CAST((tot % 86400) // 3600 AS VARCHAR) || '小时' ELSE '' END) || "
             "(CASE WHEN (tot % 3600) // 60 <> 0 THEN CAST((tot % 3600) // 60 AS VARCHAR) || '分钟' ELSE '' END) || "
             "(CASE WHEN tot % 60 <> 0 OR tot < 60 THEN CAST(tot % 60 AS VARCHAR) || '秒' ELSE '' END)")


@query("run_span",
       "WITH s AS (SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us FROM events GROUP BY user_id), "
       "d AS (SELECT *, CAST(trunc((end_us - start_us) / 1e6) AS BIGINT) AS tot FROM s) "
       "SELECT user_id, start_us, end_us, round((end_us - start_us) / 1e6, 6) AS duration_s, " + _DUR_TEXT +
       " AS duration_text FROM d")
def q_run_span(spark, sf):
    s = K.run_span(_t(spark, sf, "events"), "user_id", "ts")
    return s.select("user_id", K.epoch_micros("start_time").alias("start_us"), K.epoch_micros("end_time").alias("end_us"),
                    _r("duration_s").alias("duration_s"), "duration_text")


@query("latest_metrics", _LATEST_SQL)
def q_latest(spark, sf):
    ev = _t(spark, sf, "events").withColumn("step", K.epoch_micros("ts"))
    return K.latest_metrics(ev, "user_id", "event_type", "step", "value").select("user_id", "event_type", "value", "step")


def queries() -> dict:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
