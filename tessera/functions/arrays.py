"""Column functions over token-id arrays (D3, D4, D6, E5, B7, I5). All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import EOS_ID, IGNORE_INDEX, N_SPECIAL, PAD_ID, col_


def truncate(ids, max_len: int) -> Column:
    """D3: right truncation to ``max_len`` ids."""
    return F.slice(col_(ids), 1, max_len)


def pad(ids, max_len: int, pad_id: int = PAD_ID) -> Column:
    """Right padding to ``max_len`` (input must already be truncated)."""
    c = col_(ids)
    return F.concat(c, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(max_len) - F.size(c), F.lit(0))))


def attention_mask(ids, max_len: int) -> Column:
    """1 for each id, 0 for each place that ``pad`` fills, by place and not by id: the pad id is
    also the end token's (input must already be truncated)."""
    n = F.least(F.size(col_(ids)), F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))


def supervised_count(labels, ignore: int = IGNORE_INDEX) -> Column:
    """E5: number of labels that enter the loss."""
    return F.size(F.filter(col_(labels), lambda x: x != ignore))


def keep_last(ids, n: int) -> Column:
    """Keep only the last ``n`` ids (left truncation of a context)."""
    c = col_(ids)
    return F.when(F.size(c) > n, F.slice(c, -n, n)).otherwise(c)


def drop_specials(ids) -> Column:
    """Remove control-token ids (decode with ``skip_special_tokens``)."""
    return F.filter(col_(ids), lambda x: x >= N_SPECIAL)


def cut_at_eos(ids, eos_id: int = EOS_ID, max_new: int = 256) -> Column:
    """Generated ids up to and including the first EOS, and at most ``max_new`` ids."""
    c = F.slice(col_(ids), 1, max_new)
    pos = F.array_position(c, eos_id)
    return F.when(pos > 0, F.slice(c, 1, pos.cast("int"))).otherwise(c)
