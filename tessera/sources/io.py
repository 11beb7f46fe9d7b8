"""Sources and sinks (A1-A9): JSONL corpora, bounded scans, lookups, tokenizer files,
training-row and metric sinks, scalar run logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import BOS_ID, EOS_ID, PAD_ID, SPECIAL_TOKENS, UNK_ID
from ..operators.bpe import BpeModel
from ..operators.ordering import hash_key, range_count
from ..operators.turns import KNOWN_ROLES

CONVERSATIONS_SCHEMA = "conversations array<struct<`from`:string,`value`:string>>"
SCALARS_SCHEMA = "run string, tag string, step long, wall_time double, value double"
MAX_VOCAB_ROWS = 10_000_000  # a tokenizer larger than this is not loaded onto the driver


def _line_ids(df: DataFrame, out: str) -> DataFrame:
    """Dense line numbers in file order without moving the text.

    Each file split is read in order by one task, so a line's number is the number of lines in
    earlier splits (ordered by file and split start) plus its row index inside its split. Counts and
    rows belong to one lazy plan, so both scans are split alike whenever it runs, whatever the
    split size or the number of cores is then; a row whose split has no count fails the job instead of
    vanishing. The running sum is over one row per split (metadata-sized)."""
    keyed = (df.withColumn("_f", F.col("_metadata.file_path"))
             .withColumn("_b", F.col("_metadata.file_block_start"))
             .withColumn("_r", F.monotonically_increasing_id()))
    splits = keyed.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_r0"))
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = keyed.join(offsets, ["_f", "_b"], "left")
    number = F.coalesce(F.col("_off") + F.col("_r") - F.col("_r0"), F.raise_error(F.lit("a file split changed while it was read")).cast("long"))
    return joined.withColumn(out, number).drop("_f", "_b", "_r", "_off", "_r0")


def _json_lines(spark: SparkSession, path: str, schema: str, field: str, mode: str, id_col: str | None) -> DataFrame:
    """Column ``field`` of each line's JSON, and its line number.

    Lines are read as text, since Spark's JSON reader skips blank ones, which would shift all later numbers; they
    are counted without being parsed, and parsed once. Blank lines, bad JSON and lines without ``field`` fail the job, unless
    ``mode`` is DROPMALFORMED: then such lines go before the rest is numbered."""
    lines = spark.read.text(path)
    parsed = F.from_json("value", schema, {"mode": "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE"}).getField(field)
    if mode == "DROPMALFORMED":
        lines = lines.where(parsed.isNotNull())
    if id_col is not None:
        lines = _line_ids(lines, id_col)
    why = F.when(F.trim("value") == "", F.lit("blank line")).otherwise(F.lit(f"line without '{field}'"))
    return lines.withColumn(field, F.coalesce(parsed, F.raise_error(why).cast(T.DataType.fromDDL(schema)[field].dataType))).select(
        field, *([id_col] if id_col is not None else []))


def read_corpus(spark: SparkSession, path: str, mode: str = "FAILFAST", field: str = "text",
                with_line_ids: bool = True, id_col: str = "row_id") -> DataFrame:
    """A1: pretraining JSONL, one document per line. Bad JSON, a blank line and a line without ``field`` fail the job."""
    return _json_lines(spark, path, f"`{field}` string", field, mode, id_col if with_line_ids else None)


def read_conversations(spark: SparkSession, path: str, mode: str = "FAILFAST",
                       with_line_ids: bool = True, id_col: str = "row_id") -> DataFrame:
    """A2: SFT JSONL with ``conversations: [{from, value}]``; fails as ``read_corpus`` does."""
    return _json_lines(spark, path, CONVERSATIONS_SCHEMA, "conversations", mode, id_col if with_line_ids else None)


def head_lines(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """A3: the first ``n`` lines; with dense line ids this is a filter that reaches the scan."""
    return df.filter(F.col(order_col) < n)


def corpus_size(df: DataFrame) -> DataFrame:
    """A4: number of rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def rows_at(df: DataFrame, ids, id_col: str = "row_id", broadcast_limit: int = 1_000_000) -> DataFrame:
    """A5: rows by index: a list becomes an ``isin`` filter (pushed to the scan), a DataFrame of
    ids a semi join (broadcast only when its measured row count is under ``broadcast_limit``)."""
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias(id_col)).distinct()
        if keys.count() <= broadcast_limit:
            keys = F.broadcast(keys)
        return df.join(keys, id_col, "left_semi")
    return df.filter(F.col(id_col).isin(list(ids)))


def save_tokenizer(spark: SparkSession, model: BpeModel, path: str, mode: str = "overwrite") -> None:
    """Vocabulary, merges and metadata as parquet tables under ``path``, and the public JSON
    form as the one line of ``path``/json."""
    spark.createDataFrame([(tokenizer_json(model),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/json")
    model.vocab_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    model.merges_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    meta = {"special_tokens": SPECIAL_TOKENS, "bos_id": BOS_ID, "eos_id": EOS_ID, "pad_id": PAD_ID,
            "unk_id": UNK_ID, "padding_side": "right", "truncation_side": "right",
            "normalizer": "NFKC", "pre_tokenizer": "byte_level", "add_prefix_space": False,
            "chat_template": {"roles": list(KNOWN_ROLES), "turn": f"{SPECIAL_TOKENS[0]}role\ncontent{SPECIAL_TOKENS[1]}",
                              "after_turn": {"user": "\n", "system": "\n", "assistant": ""}}}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(mode).parquet(f"{path}/meta")


def _byte_alphabet() -> list[str]:
    """The public byte-level alphabet: visible Latin-1 bytes stand for themselves, the rest for
    the characters from U+0100 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


def tokenizer_json(model: BpeModel) -> str:
    """The tokenizer in the public library's JSON form (vocabulary, merges, special tokens,
    normaliser, pre-tokenizer, decoder), which that library loads and encodes with to equal ids."""
    alphabet = _byte_alphabet()
    n_special = len(SPECIAL_TOKENS)
    word = {i: SPECIAL_TOKENS[i] if i < n_special else "".join(alphabet[b] for b in token) for i, token in model.vocab.items()}
    level = {"add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None,
        "added_tokens": [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
                         for i, t in enumerate(SPECIAL_TOKENS)],
        "normalizer": {"type": "NFKC"}, "pre_tokenizer": {"type": "ByteLevel"} | level, "post_processor": None,
        "decoder": {"type": "ByteLevel"} | level,
        "model": {"type": "BPE", "dropout": None, "unk_token": SPECIAL_TOKENS[UNK_ID], "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": {w: i for i, w in sorted(word.items())},
                  "merges": [[word[a], word[b]] for a, b, _ in model.merges]}}, ensure_ascii=False)


def load_tokenizer(spark: SparkSession, path: str) -> BpeModel:
    """Read a saved tokenizer; the tables are bounded by the vocabulary size (checked)."""
    vocab_df = spark.read.parquet(f"{path}/vocab")
    merges_df = spark.read.parquet(f"{path}/merges")
    n = vocab_df.count()
    if n > MAX_VOCAB_ROWS:
        raise ValueError(f"vocabulary of {n} rows is too large to load")
    model = BpeModel()
    model.vocab = {r.id: bytes(r.token_bytes) for r in vocab_df.collect()}
    model.merges = [(r.left, r.right, r.new) for r in merges_df.orderBy("rank").collect()]
    return model


def write_examples(df: DataFrame, path: str, split: str = "split", batch: str = "batch_id",
                   mode: str = "overwrite") -> None:
    """Training rows as parquet, one folder per split, batches range-clustered."""
    out = df.repartitionByRange(split, batch).sortWithinPartitions(split, batch) if batch in df.columns else df
    writer = out.write.mode(mode)
    if split in df.columns:
        writer = writer.partitionBy(split)
    writer.parquet(path)


def write_epoch(df: DataFrame, path: str, id_col: str, epoch: int, seed: int = 42, split: str = "split", mode: str = "overwrite",
                partitions: int | None = None) -> None:
    """A7 with G3: training rows written once in the epoch's order, one folder per split.

    ``train`` rows follow the epoch's hash order, other splits that of their ids. The rows are exchanged once, by range of (split, order);
    no position is computed or joined, since a row's place is its place in the files (see ``read_epoch``)."""
    key = F.when(F.col(split) == "train", hash_key(seed, F.lit(epoch), id_col))
    rows = df.withColumn("_order", key)
    order = [split, "_order", id_col]
    out = rows.repartitionByRange(partitions or range_count(df), *order).sortWithinPartitions(*order).drop("_order")
    out.write.mode(mode).partitionBy(split).parquet(path)


def read_epoch(spark: SparkSession, path: str, size: int, split: str = "split", pos: str = "pos", batch: str = "batch_id") -> DataFrame:
    """Rows of ``write_epoch`` with their place in their split and their batch.

    File numbers ascend with the order, so a place is the rows of the split's earlier files plus the row's index in its
    file: one count a file, from the footers, joined as a table of one row a file."""
    rows = spark.read.parquet(path)
    rows = rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    number = lambda pattern: F.regexp_extract("_file", pattern, 1).cast("int")
    files = rows.groupBy(split, "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(split).orderBy(number(r"part-(\d+)-[^/]*$"), number(r"[.-]c(\d+)(?:\.(?!c\d)[a-z0-9_]+)?\.parquet$")).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(F.broadcast(starts), "_file").withColumn(pos, F.col("_start") + F.col("_row"))
    return placed.withColumn(batch, F.expr(f"{pos} div {int(size)}")).drop("_file", "_row", "_start")


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_scalars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scalar events ``(run, tag, step, wall_time epoch seconds, value)``."""
    reader = spark.read.schema(SCALARS_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def scalars_from_events(events: DataFrame) -> DataFrame:
    """A9 over the driver's ``events`` table: run = user, tag = event type, wall time = ts;
    the step is ``ts`` in microseconds (unique and increasing within a run)."""
    return events.select(F.col("user_id").cast("string").alias("run"), F.col("event_type").alias("tag"),
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("step"),
                         (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("wall_time"), F.col("value"))
