"""Column functions for text: special-token split, NFKC, byte-level pre-tokens, byte symbols.

All but NFKC and byte symbols are JVM-side expressions (regex and higher-order functions, whole-stage codegen
friendly). Byte symbols are looked up by Arrow batch, since a lambda a byte takes several times as long. NFKC has no Spark built-in, so it is an Arrow-batched pandas UDF that only receives
non-ASCII values (ASCII text is NFKC-stable and is passed as null, which Arrow ships for free).
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values. They must equal the reference tokenizer's for identical ids and splits.
# Special tokens, in id order 0, 1, 2 (bos, eos/pad, unk):
SPECIAL_TOKENS = ["<|im_start|>", "<|im_end|>", "<unk>"]
BOS_ID = 0
EOS_ID = 1
PAD_ID = 1
UNK_ID = 2
IGNORE_INDEX = -100
# Byte-level pre-tokenizer pattern (the public GPT-2 split rule), as a Java regex; (?U) makes
# \s match Unicode white space like the reference's regex engine does.
PRETOKEN_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes that the byte-level alphabet shows as themselves, in code-point order: '!'..'~', '¡'..'¬', '®'..'ÿ'.
PRINTABLE_BYTE_RANGES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]
# ---------------------------------------------------------------------------------------------


def _byte_order() -> list[int]:
    """Bytes in id order: printable bytes first (their alphabet chars sort lowest), then the
    remaining 68 bytes in byte order (their alphabet chars are 256 + n)."""
    printable = [b for lo, hi in PRINTABLE_BYTE_RANGES for b in range(lo, hi + 1)]
    seen = set(printable)
    return printable + [b for b in range(256) if b not in seen]


BYTE_ORDER = _byte_order()
N_SPECIAL = len(SPECIAL_TOKENS)
BYTE_TO_ID = [0] * 256
for _i, _b in enumerate(BYTE_ORDER):
    BYTE_TO_ID[_b] = N_SPECIAL + _i
ID_TO_BYTE = {N_SPECIAL + i: b for i, b in enumerate(BYTE_ORDER)}
BASE_VOCAB_SIZE = N_SPECIAL + 256


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in s)


SPECIALS_ALT = "|".join(_regex_quote(s) for s in SPECIAL_TOKENS)
# Every special token starts with '<'; the look-ahead only runs at '<' characters.
_SPECIAL_TAILS = "|".join(_regex_quote(s[1:]) for s in SPECIAL_TOKENS)
assert all(s.startswith("<") for s in SPECIAL_TOKENS)
# A piece is a special token, or the longest run of text that does not start one.
# Possessive runs keep Java's regex engine from recursing once per character on long texts.
SPLIT_SPECIALS_PATTERN = f"(?s){SPECIALS_ALT}|(?:[^<]++|<(?!{_SPECIAL_TAILS}))++"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_specials(text) -> Column:
    """Split text at literal special tokens (matched on raw text, before NFKC).

    Returns ``array<string>`` of pieces in order; a piece equal to a special token string is a
    control token (a normal piece can never equal one, since normal pieces never contain one).
    """
    return F.regexp_extract_all(col_(text), F.lit(SPLIT_SPECIALS_PATTERN), 0)


def is_special(piece) -> Column:
    return col_(piece).isin(*SPECIAL_TOKENS)


def special_id(piece) -> Column:
    expr = None
    for i, s in enumerate(SPECIAL_TOKENS):
        expr = (F.when(col_(piece) == s, F.lit(i)) if expr is None
                else expr.when(col_(piece) == s, F.lit(i)))
    return expr


def _nfkc_one(t):
    if t is None or unicodedata.is_normalized("NFKC", t):
        return t
    return unicodedata.normalize("NFKC", t)


@F.pandas_udf(T.StringType())
def _nfkc_udf(s: pd.Series) -> pd.Series:
    return s.map(_nfkc_one)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_array_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda a: None if a is None else [_nfkc_one(x) for x in a])


@functools.lru_cache(maxsize=1)
def nfkc_unstable_pattern() -> str:
    """Java regex matching any character that might change under NFKC.

    Generated by rule from the Unicode database: a character is *stable* when NFKC leaves it
    unchanged, its combining class is 0, it is not the second half of a canonical composition
    and it is not a conjoining Hangul vowel/trailing jamo. A string of stable characters is its
    own NFKC form. Stable runs of at least 32 BMP code points (and every stable Latin-1 code
    point) are kept so that the class stays short; anything else is sent to Python, which is
    exact either way.
    """
    second = set()
    for cp in range(0x80, 0x110000):
        d = unicodedata.decomposition(chr(cp))
        if d and not d.startswith("<"):
            parts = d.split()
            if len(parts) == 2:
                second.add(int(parts[1], 16))

    def stable(cp: int) -> bool:
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or 0x1160 <= cp <= 0x11FF or cp in second:
            return False
        return unicodedata.combining(ch) == 0 and unicodedata.normalize("NFKC", ch) == ch

    runs, start = [(0x00, 0x7F)], None
    for cp in range(0x80, 0x10000):
        if stable(cp):
            start = cp if start is None else start
        elif start is not None:
            runs.append((start, cp - 1))
            start = None
    if start is not None:
        runs.append((start, 0xFFFF))
    kept = [(a, b) for a, b in runs if b - a + 1 >= 32 or b < 0x100]
    body = "".join(f"\\x{{{a:04X}}}-\\x{{{b:04X}}}" for a, b in kept)
    return f"[^{body}]"


def needs_nfkc(text) -> Column:
    """True when the text has a character NFKC might change. ASCII runs are removed first with
    a one-range class, so the long character class only scans the (few) non-ASCII characters."""
    return F.regexp_replace(col_(text), "[\\x00-\\x7F]+", "").rlike(nfkc_unstable_pattern())


def nfkc(text) -> Column:
    """NFKC normalisation. Only values with a possibly unstable character cross into Python."""
    c = col_(text)
    return F.coalesce(_nfkc_udf(F.when(needs_nfkc(c), c)), c)


def nfkc_pieces(pieces, text) -> Column:
    """NFKC of every element of ``pieces`` (split from ``text``); stable texts skip Python."""
    c = col_(pieces)
    return F.coalesce(_nfkc_array_udf(F.when(needs_nfkc(text), c)), c)


def pretokens(text) -> Column:
    """Byte-level pre-tokens (regex split, no prefix space) as ``array<string>``."""
    return F.regexp_extract_all(col_(text), F.lit(PRETOKEN_PATTERN), 0)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_symbols_udf(words: pa.Array) -> pa.Array:
    known = pc.fill_null(words.cast(pa.large_string()), "")
    off = np.frombuffer(known.buffers()[1], np.int64)[known.offset:known.offset + len(known) + 1]
    data = np.frombuffer(known.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    symbols = np.array(BYTE_TO_ID, np.int32)[data]
    return pa.ListArray.from_arrays(pa.array(off - off[0], pa.int32()), pa.array(symbols), mask=words.is_null())


def byte_symbols(word) -> Column:
    """A string's UTF-8 bytes mapped to base symbol ids (``array<int>``), many words at a time."""
    return _byte_symbols_udf(col_(word))


# Characters Python's str.isspace() accepts, generated from the rule (29 code points).
PY_SPACE_CLASS = "[" + "".join(f"\\x{{{c:04X}}}" for c in range(0x110000) if chr(c).isspace()) + "]"
