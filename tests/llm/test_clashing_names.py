import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessera.llm import line_dedup, minhash_dedup, mixing, quality  # noqa: E402

#: Every name that an operator uses inside, and others that its rows have on the way.
INSIDE = ["_id", "_hash", "_i", "_h", "i", "once", "r", "c", "component_id", "kept", "text_hash", "n_shingles", "_source", "_n", "rate", "size", "weight",
          "_scored", "_score", "score_", "_text", "_lines", "lines", "line", "pos", "first", "_t", "gone", "seq", "mark", "y", "id", "w", "_gone"]


def table(spark):
    return X.table(spark).withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in INSIDE})


def unharmed(docs, rows):
    assert set(docs.columns) <= set(rows.columns)
    for r in rows.collect():
        assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in INSIDE)
        assert (r["_key"], r["node"]) in (("k", "n"), (None, None))


@pytest.mark.parametrize("apply", [
    lambda d: line_dedup.dedup_lines(d), lambda d: minhash_dedup.keep_one_per_group(d), lambda d: mixing.mix(d, total=2.0),
    lambda d: quality.score(d, np.zeros((1 << quality.BITS) + 1, np.float32))], ids=["lines", "near", "mix", "quality"])
def test_columns_of_any_name_are_kept(spark, apply):
    docs = table(spark)
    unharmed(docs, apply(docs))
    assert apply(docs.limit(0)).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    docs = table(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, "/root/testdata/sf0.001")
        assert rows.columns == docs.columns
        unharmed(docs, rows)
    assert corpus_pipeline.pack_sequences(spark, docs, "/root/testdata/sf0.001").count() >= docs.count()
