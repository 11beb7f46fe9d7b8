import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-", dir="/tmp")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_vocab():
    return 350


@pytest.fixture(scope="session")
def trained(spark, small_vocab):
    """(our model, library tokenizer) trained on the same documents with the same settings."""
    from tessera.functions.text import SPECIAL_TOKENS
    from tessera.operators import bpe
    from tessera.session import table
    docs = table(spark, SF_SMALL, "documents")
    model = bpe.train_tokenizer(docs, vocab_size=small_vocab)
    lib = pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token=SPECIAL_TOKENS[2]))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.normalizer = normalizers.NFKC()
    tok.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(vocab_size=small_vocab, min_frequency=2,
                                  special_tokens=SPECIAL_TOKENS,
                                  initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
    texts = [r.text for r in docs.orderBy("doc_id").select("text").collect()]
    tok.train_from_iterator(texts, trainer, length=len(texts))
    assert lib is not None
    return model, tok
