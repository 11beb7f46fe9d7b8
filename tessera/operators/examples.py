"""Language-model training rows (E1-E5) and chat rows with supervised assistant spans.

Both builders push right truncation below every shuffle: a document keeps its first
``max_len`` units (each unit is at least one token), a conversation keeps its first
``max_len // 2`` rendered turns (each is at least two tokens) -- the turn limit is a
``row_number() <= n`` filter, which Spark applies map-side as a window group limit, so a huge
conversation is cut before it is shuffled -- and every turn keeps its first ``max_len`` units.
Conversations are dealt once: turn limit, running unit count and regrouping share that exchange,
and only the first ``max_len`` units of a conversation are encoded.

Words are encoded in place (``strategy="narrow"``, ``mapInArrow``; no shuffle) by default; the
``"dictionary"`` strategy (distinct words, one encode each, join back) is kept for comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import IGNORE_INDEX, PAD_ID, SPECIAL_TOKENS, col_
from .bpe import BpeModel
from .encode import encode, encode_exploded, encode_units_narrow, piece_units, with_pieces
from .turns import KNOWN_ROLES, RAW_USER_ROLE, normalize_role

IM_START, IM_END = SPECIAL_TOKENS[0], SPECIAL_TOKENS[1]


def shifted_rows(ids, keep, max_len: int, pad_id: int = PAD_ID, ignore: int = IGNORE_INDEX):
    """E2/E3 from truncated ids and a per-token keep flag (``array<int>`` 0/1, same length):
    pad to ``max_len``, ``input_ids = ids[:-1]``, ``labels = ids[1:]`` with -100 where the
    shifted keep flag (times the attention mask) is 0. Returns two columns."""
    padded = A.pad(ids, max_len, pad_id)
    keep_padded = A.pad(keep, max_len, 0)  # padding is never a label (attention mask)
    inputs = F.slice(padded, 1, max_len - 1)
    # zip_with evaluates both arrays once; a lambda that indexes an outer array expression
    # would re-evaluate it for every element
    labels = F.zip_with(F.slice(padded, 2, max_len - 1), F.slice(keep_padded, 2, max_len - 1),
                        lambda x, m: F.when(m == 1, x).otherwise(F.lit(ignore)))
    return inputs.alias("input_ids"), labels.alias("labels")


def pretrain_examples(docs: DataFrame, model: BpeModel, max_len: int = 512, key: str = "doc_id",
                      text: str = "text", keep: list[str] = (), strategy: str = "narrow") -> DataFrame:
    """``bos + text`` -> ids truncated and padded to ``max_len`` -> shifted, padding masked."""
    whole = F.coalesce(F.col(text), F.raise_error(F.lit("document without text")).cast("string"))
    enc = encode(docs.withColumn(text, whole), model, [key], text, max_len=max_len, bos=True, keep=list(keep), strategy=strategy)
    ones = F.transform("ids", lambda x: F.lit(1))
    inputs, labels = shifted_rows(F.col("ids"), ones, max_len)
    return enc.select(key, *keep, F.size("ids").alias("n_tokens"), inputs, labels)


def turn_units(role, units, max_len: int) -> Column:
    """Units of one rendered turn (from the units of ``role\\ntext``) with a supervision class per unit:
    0 = never, 1 = every token, 2 = tokens that reach past the header's newline."""
    is_asst = col_(role) == "assistant"
    body = F.transform(col_(units), lambda u, j: F.struct(
        u.alias("u"),
        F.when(~is_asst | (j == 0), 0).when(j == 1, 2).otherwise(1).alias("cls")))
    head = F.array(F.struct(F.lit(IM_START).alias("u"), F.lit(0).alias("cls")))
    close = F.array(F.struct(F.lit(IM_END).alias("u"), F.when(is_asst, 1).otherwise(0).alias("cls")))
    nl = F.when(is_asst, F.array().cast("array<struct<u:string,cls:int>>")) \
          .otherwise(F.array(F.struct(F.lit("\n").alias("u"), F.lit(0).alias("cls"))))
    return F.slice(F.concat(head, body, close, nl), 1, max_len)


def _encoded_turn_units(turns: DataFrame, model: BpeModel, max_len: int, key: str, order: str,
                        role: str, text: str, strategy: str = "narrow") -> DataFrame:
    # turns of unknown roles render nothing, but their conversation keeps its row: they come last, without their text
    known = F.coalesce(col_(role).isin(*KNOWN_ROLES, RAW_USER_ROLE), F.lit(False))
    body = F.coalesce(col_(text), F.raise_error(F.lit("turn without text")).cast("string"))
    t = turns.select(key, order, (~known).alias("_void"), F.when(known, normalize_role(role)).otherwise("").alias("role"),
                     F.when(known, body).otherwise("").alias("text"))
    # Python (NFKC) runs before the exchange, since Spark forgets the partitioning behind it
    t = with_pieces(t.withColumn("_seg", F.concat("role", F.lit("\n"), "text")), "_seg", "_pieces").select(key, order, "_void", "role", "_pieces")
    turn_order = Window.partitionBy(key).orderBy("_void", order, "role", "_pieces")
    # cut map-side (window group limit); what follows keeps the partitioning by conversation
    t = t.withColumn("_rk", F.row_number().over(turn_order)).filter(F.col("_rk") <= max(max_len // 2, 1))
    # a unit is at least one token: turns behind max_len units can't show
    units = t.withColumn("_seg_units", piece_units("_pieces")).withColumn("_units", turn_units("role", "_seg_units", max_len))
    units = units.withColumn("_units", F.when(F.col("_void"), F.array().cast(units.schema["_units"].dataType)).otherwise(F.col("_units")))
    before = F.sum(F.size("_units")).over(Window.partitionBy(key).orderBy("_rk").rowsBetween(Window.unboundedPreceding, -1))
    units = units.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < max_len)
    if strategy == "narrow":
        chats = units.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_rk", "_units"))).alias("_t"))
        flat = chats.select(key, F.slice(F.flatten(F.transform("_t", lambda t: t["_units"])), 1, max_len).alias("_units"))
        seqs = encode_units_narrow(flat.select(key, F.col("_units.u").alias("_u"), F.col("_units.cls").alias("_c")), model, "_u", "_c")
        return seqs.select(key, F.slice("ids", 1, max_len).alias("ids"), F.slice("mask", 1, max_len).alias("mask"))
    exploded = (units.select(key, "_rk", F.posexplode("_units").alias("upos", "_u"))
                .select(key, "_rk", "upos", F.col("_u.u").alias("unit"), F.col("_u.cls").alias("cls")))
    enc = encode_exploded(exploded, model)
    tok_mask = F.transform("ends", lambda e: F.when(F.col("cls") == 1, 1)
                           .when((F.col("cls") == 2) & (e > 1), 1).otherwise(0))
    seqs = (enc.withColumn("mask", tok_mask).groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("_rk", "upos", "ids", "mask"))).alias("_u")))
    seqs = turns.select(key).distinct().join(seqs, key, "left")
    seqs = seqs.withColumn("_u", F.coalesce("_u", F.array().cast(seqs.schema["_u"].dataType)))
    return seqs.select(key, F.slice(F.flatten(F.transform("_u", lambda u: u["ids"])), 1, max_len).alias("ids"),
                       F.slice(F.flatten(F.transform("_u", lambda u: u["mask"])), 1, max_len).alias("mask"))


def sft_examples(turns: DataFrame, model: BpeModel, max_len: int = 512, key: str = "conv_id",
                 order: str = "turn", role: str = "role", text: str = "text",
                 strategy: str = "narrow") -> DataFrame:
    """F5 (with F4): chat rows where only assistant replies (and their end token) are labels.

    Input is flat turns; ``human`` becomes ``user`` and roles the template does not know
    render nothing. Output: ``(key, n_tokens, n_supervised, input_ids, labels)``.
    """
    rows = _encoded_turn_units(turns, model, max_len, key, order, role, text, strategy)
    inputs, labels = shifted_rows(F.col("ids"), F.col("mask"), max_len)
    out = rows.select(key, F.size("ids").alias("n_tokens"), inputs, labels)
    return out.withColumn("n_supervised", A.supervised_count("labels"))


def flat_turns(conversations: DataFrame, id_col: str = "row_id", col: str = "conversations") -> DataFrame:
    """Nested ``[{from, value}]`` rows (A2) as flat turns ``(conv_id, turn, role, text)`` for the chat rows.

    A conversation without turns keeps one turn of no known role, so it keeps its row."""
    turns = conversations.select(F.col(id_col).alias("conv_id"), F.posexplode_outer(col).alias("turn", "_t"))
    return turns.select("conv_id", F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
                        F.coalesce(F.col("_t.from"), F.lit("")).alias("role"), F.col("_t.value").alias("text"))


def assistant_mask(turns: DataFrame, model: BpeModel, max_len: int = 512, key: str = "conv_id",
                   order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """F4 on its own: ``(key, ids, mask)`` before shifting (mask 1 = assistant token)."""
    return _encoded_turn_units(turns, model, max_len, key, order, role, text)


def supervision_stats(df: DataFrame, labels: str = "labels", ignore: int = IGNORE_INDEX) -> DataFrame:
    """E5: corpus totals of supervised labels; rows with none would make a NaN batch loss."""
    n = A.supervised_count(labels, ignore)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(n).cast("long").alias("n_supervised"),
                  F.count(F.when(n == 0, 1)).alias("n_unsupervised_rows"))
