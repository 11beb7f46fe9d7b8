"""Conversation shaping and chat rendering.

Two layouts are supported: nested rows ``messages array<struct<role, content>>`` (the SFT JSONL
shape) and flat turn rows ``(conv_id, turn, role, text)``. The flat layout never needs a whole
conversation in one row, so the SFT row builder works on it (see ``examples.sft_examples``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PY_SPACE_CLASS, SPECIAL_TOKENS, col_
from .prefix import running_agg

# Chat template pieces (rendering with trimmed blocks, as the reference's
# template engine does). The assistant reply has no newline after its end token.
IM_START, IM_END = SPECIAL_TOKENS[0], SPECIAL_TOKENS[1]
KNOWN_ROLES = ("user", "system", "assistant")
GENERATION_PROMPT = IM_START + "assistant\n"
RAW_USER_ROLE = "human"  # the raw SFT corpus calls the user "human"; nothing else is renamed


def extract_text(df: DataFrame, col: str = "value", field: str = "text") -> DataFrame:
    """B1: pull ``field`` out of a JSON line column; rows where it is missing raise."""
    parsed = F.from_json(F.col(col), f"`{field}` string", {"mode": "FAILFAST"})[field]
    checked = F.when(parsed.isNull(), F.raise_error(F.lit(f"JSON line without '{field}'"))).otherwise(parsed)
    return df.withColumn(field, checked)


def normalize_turns(df: DataFrame, col: str = "conversations", out: str = "messages") -> DataFrame:
    """B2: ``{from, value}`` -> ``{role, content}``; only ``human`` is renamed (to ``user``)."""
    msgs = F.transform(F.col(col), lambda x: F.struct(
        F.when(x["from"] == RAW_USER_ROLE, F.lit("user")).otherwise(x["from"]).alias("role"),
        x["value"].alias("content")))
    return df.withColumn(out, msgs).drop(col) if out != col else df.withColumn(out, msgs)


def normalize_role(role) -> Column:
    """B2 for flat rows."""
    r = col_(role)
    return F.when(r == RAW_USER_ROLE, F.lit("user")).otherwise(r)


def fold_turns(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
               text: str = "text", out: str = "messages") -> DataFrame:
    """Flat turn rows -> one row per conversation with ordered ``messages``.

    Partial aggregation runs map-side; the fold is the nested output itself, so a conversation
    is one row by definition. Builders that can truncate use the flat layout instead.
    """
    folded = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                  normalize_role(role).alias("role"),
                                                  F.col(text).alias("content"))))
    return (df.groupBy(key).agg(folded.alias("_m"))
            .select(key, F.transform("_m", lambda m: F.struct(m["role"].alias("role"),
                                                             m["content"].alias("content"))).alias(out)))


def known_roles(df: DataFrame, role: str = "role") -> DataFrame:
    """B4 (flat): keep turns the chat template renders."""
    return df.filter(F.col(role).isin(*KNOWN_ROLES))


def with_system_turn(df: DataFrame, prompt: str, key: str = "conv_id", order: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """B5 (flat): add one system turn before the first turn of every conversation."""
    first = df.groupBy(key).agg((F.min(order) - 1).alias(order))
    sys_rows = first.select(key, order, F.lit("system").alias(role), F.lit(prompt).alias(text))
    return df.select(key, order, role, text).unionByName(sys_rows)


def is_blank(text) -> Column:
    """True when Python's ``str.strip()`` would leave nothing."""
    return F.regexp_like(F.coalesce(col_(text), F.lit("")), F.lit(f"^{PY_SPACE_CLASS}*$"))


def drop_blank_replies(df: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Drop assistant turns whose text is blank."""
    return df.filter(~((F.col(role) == "assistant") & is_blank(text)))


def turn_segment(role, content) -> Column:
    """F1 per turn: the rendered text of one message (empty for unknown roles)."""
    r, c = col_(role), col_(content)
    return (F.when(r == "user", F.concat(F.lit(IM_START + "user\n"), c, F.lit(IM_END + "\n")))
             .when(r == "system", F.concat(F.lit(IM_START + "system\n"), c, F.lit(IM_END + "\n")))
             .when(r == "assistant", F.concat(F.lit(IM_START + "assistant\n"), c, F.lit(IM_END)))
             .otherwise(F.lit("")))


def render_chat(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                text: str = "text", add_generation_prompt: bool = False) -> DataFrame:
    """F1/F2 (flat): ``(key, prompt)``; segments are rendered per row, then joined in order."""
    seg = df.select(key, order, turn_segment(normalize_role(role), text).alias("seg"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "seg"))),
                                    lambda s: s["seg"]), "")
    prompt = F.concat(body, F.lit(GENERATION_PROMPT)) if add_generation_prompt else body
    return seg.groupBy(key).agg(prompt.alias("prompt"))


def assistant_spans(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """character span ``[span_start, span_end)`` of each supervised reply in the rendered
    prompt: the content plus its end token, after the ``<|im_start|>assistant\\n`` header."""
    r = normalize_role(role)
    seg_len = F.length(turn_segment(r, text)).cast("long")
    # exclusive running sum of segment lengths by a prefix scan, so a huge conversation is spread over tasks;
    # only lengths travel, not the text
    lens = df.select(key, order, r.alias("role"), seg_len.alias("_seg"), F.length(text).cast("long").alias("_len"))
    rows = running_agg(lens, "_seg", [order], [key], "sum", "_before", inclusive=False)
    start = F.coalesce(F.col("_before"), F.lit(0)).cast("long") + len(GENERATION_PROMPT)
    return (rows
            .withColumn("span_start", start)
            .withColumn("span_end", start + F.col("_len") + len(IM_END))
            .filter(F.col("role") == "assistant")
            .select(key, order, "span_start", "span_end"))
