"""Golden comparison with the public byte-level BPE library (test-only dependency)."""

import json

import pytest
from pyspark.sql import functions as F

from chat_cases import CHAT_CASES, TEXT_CASES, library_pretrain_row, library_sft_row
from conftest import SF_SMALL
from tessera.sources.io import tokenizer_json
from tessera.functions.text import SPECIAL_TOKENS
from tessera.functions.text import BYTE_ORDER
from tessera.operators import encode as D
from tessera.operators import examples as X
from tessera.session import table


def _lib_vocab_bytes(tok):
    """The library's vocabulary as id -> bytes (its byte-level alphabet decoded by rule)."""
    printable = [b for b in BYTE_ORDER[:188]]
    rest = BYTE_ORDER[188:]
    char_to_byte = {chr(b): b for b in printable}
    char_to_byte.update({chr(256 + i): b for i, b in enumerate(sorted(rest))})
    vocab = json.loads(tok.to_str())["model"]["vocab"]
    return {i: (s.encode() if i < 3 else bytes(char_to_byte[c] for c in s)) for s, i in vocab.items()}


def test_trained_vocab_equals_library(trained, small_vocab):
    model, tok = trained
    lib = _lib_vocab_bytes(tok)
    assert len(model.vocab) == small_vocab == len(lib)
    assert model.vocab == lib
    assert model.rounds < len(model.merges)  # several merges per Spark round


def test_pretrain_rows_documents(spark, trained):
    model, tok = trained
    docs = table(spark, SF_SMALL, "documents")
    got = {r.doc_id: r for r in X.pretrain_examples(docs, model, max_len=128).collect()}
    for r in docs.select("doc_id", "text").collect():
        inp, lab = library_pretrain_row(tok, r.text, 128)
        assert list(got[r.doc_id].input_ids) == inp
        assert list(got[r.doc_id].labels) == lab


@pytest.mark.parametrize("max_len", [16, 512])
def test_pretrain_rows_edge_texts(spark, trained, max_len):
    model, tok = trained
    df = spark.createDataFrame([(k, v) for k, v in TEXT_CASES.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in X.pretrain_examples(df, model, max_len=max_len).collect()}
    for k, text in TEXT_CASES.items():
        inp, lab = library_pretrain_row(tok, text, max_len)
        assert list(got[k].input_ids) == inp, k
        assert list(got[k].labels) == lab, k


def _turn_rows(cases):
    return [(cid, t, role, text) for cid, msgs in cases.items() for t, (role, text) in enumerate(msgs)]


@pytest.mark.parametrize("max_len", [24, 128, 512])
def test_sft_rows_edge_cases(spark, trained, max_len):
    model, tok = trained
    df = spark.createDataFrame(_turn_rows(CHAT_CASES), "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in X.sft_examples(df, model, max_len=max_len).collect()}
    for cid, msgs in CHAT_CASES.items():
        inp, lab = library_sft_row(tok, msgs, max_len)
        assert list(got[cid].input_ids) == inp, cid
        assert list(got[cid].labels) == lab, cid


def test_sft_rows_conversations(spark, trained):
    model, tok = trained
    conv = table(spark, SF_SMALL, "conversations")
    got = {r.conv_id: r for r in X.sft_examples(conv, model, max_len=256).collect()}
    turns = {}
    for r in conv.orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    for cid, msgs in turns.items():
        inp, lab = library_sft_row(tok, msgs, 256)
        assert list(got[cid].input_ids) == inp
        assert list(got[cid].labels) == lab


def test_encode_decode_edge_texts(spark, trained):
    model, tok = trained
    df = spark.createDataFrame([(k, v) for k, v in TEXT_CASES.items()], "doc_id long, text string")
    enc = D.encode(df, model, ["doc_id"])
    out = enc.select("doc_id", "ids", D.decode("ids", D.vocab_map(model), skip_special=True).alias("txt"),
                     D.decode("ids", D.vocab_map(model), skip_special=False).alias("raw")).collect()
    for r in out:
        lib = tok.encode(TEXT_CASES[r.doc_id], add_special_tokens=False)
        assert list(r.ids) == lib.ids
        assert r.txt == tok.decode(lib.ids, skip_special_tokens=True)
        assert r.raw == tok.decode(lib.ids, skip_special_tokens=False)


def test_decode_malformed_bytes_like_replace(spark, trained):
    model, _ = trained
    # byte symbols of a truncated 3-byte character followed by ASCII
    from tessera.functions.text import BYTE_TO_ID
    seqs = [[BYTE_TO_ID[b] for b in bytes([0xE4, 0xBD, 0x41])], [BYTE_TO_ID[b] for b in bytes([0xFF, 0x42, 0xC3])]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "k int, ids array<int>")
    got = [r.t for r in df.orderBy("k").select(D.decode("ids", D.vocab_map(model)).alias("t")).collect()]
    assert got == [bytes([0xE4, 0xBD, 0x41]).decode("utf-8", "replace"), bytes([0xFF, 0x42, 0xC3]).decode("utf-8", "replace")]


def test_dictionary_strategy_equals_narrow(spark, trained):
    model, _ = trained
    conv = table(spark, SF_SMALL, "conversations")
    a = {r.conv_id: (list(r.input_ids), list(r.labels)) for r in X.sft_examples(conv, model, 96).collect()}
    b = {r.conv_id: (list(r.input_ids), list(r.labels))
         for r in X.sft_examples(conv, model, 96, strategy="dictionary").collect()}
    assert a == b
    docs = table(spark, SF_SMALL, "documents")
    c = {r.doc_id: list(r.labels) for r in X.pretrain_examples(docs, model, 96).collect()}
    d = {r.doc_id: list(r.labels) for r in X.pretrain_examples(docs, model, 96, strategy="dictionary").collect()}
    assert c == d


def test_vocabulary_of_a_thousand_equals_library(spark, trained):
    from conftest import SF_SMALL
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers

    from tessera.operators import bpe
    from tessera.session import table
    docs = table(spark, SF_SMALL, "documents")
    model = bpe.train_tokenizer(docs, vocab_size=1000)
    tok = Tokenizer(models.BPE(unk_token=SPECIAL_TOKENS[2]))
    tok.pre_tokenizer, tok.normalizer = pre_tokenizers.ByteLevel(add_prefix_space=False), normalizers.NFKC()
    trainer = trainers.BpeTrainer(vocab_size=1000, min_frequency=2, special_tokens=SPECIAL_TOKENS, initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator([r.text for r in docs.orderBy("doc_id").collect()], trainer)
    shown = tokenizer_json(model)
    assert json.loads(shown)["model"]["vocab"] == tok.get_vocab()
