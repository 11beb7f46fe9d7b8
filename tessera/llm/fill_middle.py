"""Fill-in-middle rearrangement: token cuts found by a piecewise-linear learned rank index.

A text's units are runs of ASCII letters and single other characters. A cut after ``r`` units needs the place of the
``r``-th boundary. ``RankIndex`` learns the map from rank to place: a greedy cone fits straight segments to all boundaries
so that none lies further than ``error`` from its segment, and what remains of each boundary is stored as one signed
byte. A cut is predicted by its segment and corrected by its residual, so it is exact.

Everything is computed inside a row's task: no shuffle, and the index covers one slice of about 1 MB of texts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 126  # residuals fit into a signed byte, the rounding of a prediction included
FORM_RATE, SPM_RATE = 90, 20  # per cent of texts rearranged, and of those with the suffix first

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class RankIndex:
    """Error-bounded segments over ascending places, and the residual of each place."""

    def __init__(self, places: np.ndarray, error: int = ERROR):
        places = np.asarray(places, np.int64)
        starts, slopes = [], []
        at, n = 0, len(places)
        while at < n:
            low, high, end, step = -np.inf, np.inf, at + 1, 1024
            while end < n:  # the cone of slopes that keep every boundary so far within the error
                stop = min(n, end + step)
                x, rise = np.arange(end - at, stop - at), places[end:stop] - places[at]
                highs = np.minimum(np.minimum.accumulate((rise + error) / x), high)
                lows = np.maximum(np.maximum.accumulate((rise - error) / x), low)
                closed = np.flatnonzero(lows > highs)
                fits = int(closed[0]) if len(closed) else stop - end
                if fits:
                    low, high = lows[fits - 1], highs[fits - 1]
                end += fits
                if len(closed):
                    break
                step *= 2
            starts.append(at)
            slopes.append((low + high) / 2 if end > at + 1 else 0.0)
            at = end
        self.starts, self.slopes = np.array(starts, np.int64), np.array(slopes)
        self.bases = places[self.starts]
        self.residuals = np.zeros(n, np.int8)
        if n:
            segment = np.repeat(np.arange(len(starts)), np.diff(np.append(self.starts, n)))
            off = places - self._predict(segment, np.arange(n))
            assert np.abs(off).max() <= 127
            self.residuals[:] = off

    def _predict(self, segment: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return self.bases[segment] + np.rint(self.slopes[segment] * (rank - self.starts[segment])).astype(np.int64)

    def place(self, rank: np.ndarray) -> np.ndarray:
        """Exact places of the given ranks."""
        rank = np.asarray(rank, np.int64)
        return self._predict(np.searchsorted(self.starts, rank, "right") - 1, rank) + self.residuals[rank]


def boundaries(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte places where a unit begins (and the end of all texts), the rank of each text's first
    unit (one more at the end), and the characters before each byte."""
    first = (data & 0xC0) != 0x80  # first byte of a character
    letter = _LETTER[data]
    begins = first.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begins[1:] &= ~(letter[1:] & letter[:-1]) | edge[1:-1]
    places = np.append(np.flatnonzero(begins), len(data))
    return places, np.searchsorted(places[:-1], off), np.concatenate([[0], np.cumsum(first)])


def _draws(doc_id: int | None) -> list[int]:
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", error: int = ERROR) -> DataFrame:
    """One row per input row: doc_id, n (units), form, prefix_chars, middle_chars and output.

    ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: the text as it is, with null character
    counts. Empty and null texts and texts that hold a marker are plain; a null text gives an empty output. All
    draws hash the id, so rows of equal id are cut after the same draws and repeated rows give repeated results; a null id is hashed as
    no digits. A very long text is one row as everywhere in Spark, handled whole. An empty table gives none. Other columns are
    ignored whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            data, off = K.text_bytes(batch.column("text"))
            places, first, chars = boundaries(data, off)
            index = RankIndex(places, error)
            n = np.diff(first)
            ids = batch.column("doc_id").to_pylist()
            draws = np.array([_draws(i) for i in ids], np.int64).reshape(-1, 4)
            cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
            ends = index.place(first[:-1, None] + cuts)
            prefix_chars, middle_chars = chars[ends[:, 0]] - chars[off[:-1]], chars[ends[:, 1]] - chars[ends[:, 0]]
            raw = data.tobytes()
            forms, outputs = [], []
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                text = raw[a:b]
                if not text or draws[i, 2] % 100 >= FORM_RATE or (b"<" in text and any(m in text for m in marks)):
                    forms.append("plain")
                    outputs.append(text)
                    continue
                p, m = int(ends[i, 0]) - a, int(ends[i, 1]) - a
                prefix, middle, suffix = marks[0] + text[:p], marks[2] + text[p:m], marks[1] + text[m:]
                spm = draws[i, 3] % 100 < SPM_RATE
                forms.append("spm" if spm else "psm")
                outputs.append(suffix + prefix + middle if spm else prefix + suffix + middle)
            plain = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(forms, pa.string()), pa.array(prefix_chars, pa.int64(), mask=plain),
                 pa.array(middle_chars, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from the output and its form alone."""
    p, s, m = (f"instr({output}, '{x}')" for x in (PREFIX, SUFFIX, MIDDLE))
    between = lambda a, b: f"substring({output}, {a} + 3, {b} - {a} - 3)"
    middle = f"substring({output}, {m} + 3)"
    return F.expr(f"case {form} when 'psm' then concat({between(p, s)}, {middle}, {between(s, m)}) "
                  f"when 'spm' then concat({between(p, m)}, {middle}, {between(s, p)}) else {output} end")
