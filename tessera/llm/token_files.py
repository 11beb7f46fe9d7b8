"""Token-id files: Parquet with a list column of ids, in ascending doc_id order.

Ids are dictionary-encoded (delta-encoded where a dictionary grows too large), row groups and pages have a
set size, and the writer adds column and offset indexes. A reader may so take single columns, or the
pages of an id range, without the rest: ``doc_id`` is sorted over all files, and ``n_tokens`` stands beside the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import running_total

ROW_GROUP = 32 << 20
PAGE = 64 << 10
PAGE_ROWS = 1000


def write(docs: DataFrame, target: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = tokens.END_ID, row_group: int = ROW_GROUP, page: int = PAGE, page_rows: int = PAGE_ROWS) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write doc_id, n_tokens, ids to ``target``.

    Rows are range-partitioned by doc_id (null ids first), each file is sorted, and file names
    ascend with the ids. Rows of equal id follow each other in an order fixed by the files; rows of a hot id spread
    over files by the text's hash. An empty table writes an empty, readable table.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = tokens.encoded(src.repartitionByRange(*order).sortWithinPartitions(*order), path, end_id=end_id)
    (rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids").write
     .option("compression", "zstd").option("parquet.enable.dictionary", "true").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", str(row_group)).option("parquet.page.size", str(page))
     .option("parquet.page.row.count.limit", str(page_rows)).parquet(target))


def read(spark: SparkSession, target: str, where: Column | None = None, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Read selected columns; ``where`` on doc_id or n_tokens reaches the scan and skips row groups and pages."""
    rows = spark.read.parquet(target)
    return (rows if where is None else rows.where(where)).select(*columns)


def digests(spark: SparkSession, target: str) -> DataFrame:
    """From the files: doc_id, start (ids of all rows before it in file order), n_tokens, ids_crc32."""
    rows = spark.read.parquet(target).select("doc_id", "ids", F.col("_metadata.file_name").alias("file"),
                                             F.col("_metadata.row_index").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            off = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False)
            sums = [tokens.crc(flat[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(off).astype(np.int64)), pa.array(sums, pa.int64()), batch.column("file"), batch.column("row")],
                names=["doc_id", "n_tokens", "ids_crc32", "file", "row"])

    narrow = rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, file string, row long")
    # names sort wrongly beyond 99,999 parts: the numbers of the part and of the task's file order them
    numbers = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)(?:\.[a-z0-9]+)*$")]
    return running_total(narrow, [*numbers, F.col("row")], "n_tokens", "start").select("doc_id", "start", "n_tokens", "ids_crc32")
