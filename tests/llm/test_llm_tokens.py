import hashlib
import random

import numpy as np
import pytest

from clinilake.llm import bpe, token_counts, vocabulary
from clinilake.llm.queries import vocabulary_path
from llm_data import docs, prose


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def _ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


# Token counts.

def test_histogram_answers_match_brute_force(spark, tok, monkeypatch):
    monkeypatch.setattr(token_counts, "RANGE", 16)  # many ranges
    table = docs(spark)
    sizes = [len(_ids(tok, r.text)) for r in table.collect()]
    hist = token_counts.histogram(token_counts.encoded_lengths(table, vocabulary_path()))
    sums = token_counts.suffix_sums(hist)
    for r in sums.collect():
        n = r.n_tokens
        assert (r.docs, r.docs_from, r.tokens_from, r.docs_below, r.tokens_below) == (
            sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n),
            sum(s < n for s in sizes), sum(s for s in sizes if s < n))
    for r in token_counts.at_limits(sums, (0, 1, 50, 700, 10 ** 6)).collect():
        kept = sum(min(s, r.context) for s in sizes)
        assert (r.docs, r.tokens, r.docs_over, r.tokens_kept, r.tokens_lost) == (
            len(sizes), sum(sizes), sum(s > r.context for s in sizes), kept, sum(sizes) - kept)
    ordered = sorted(sizes)
    for r in token_counts.quantiles(sums).collect():
        assert r.n_tokens == ordered[int(np.ceil(r.quantile * len(sizes))) - 1]
    for r in token_counts.report(table, vocabulary_path()).collect():
        assert r.truncated_total == sum(min(s, r.n_tokens) for s in sizes)
        assert r.quantile == sum(s <= r.n_tokens for s in sizes) / len(sizes)


def test_empty_table_counts(spark):
    empty = docs(spark).limit(0)
    sums = token_counts.suffix_sums(token_counts.histogram(token_counts.encoded_lengths(empty, vocabulary_path())))
    assert sums.count() == 0
    assert [(r.docs, r.tokens, r.tokens_lost) for r in token_counts.at_limits(sums, (5,)).collect()] == [(0, 0, 0)]
    assert all(r.n_tokens is None for r in token_counts.quantiles(sums).collect())


# Encoding with chunk reuse.

def test_repair_gives_the_ids_of_the_whole_text(tok):
    vocab = vocabulary.vocabulary(vocabulary_path())
    rng = random.Random(11)
    bits = ["hello world", " ", "  ", "\n", "don't", "'re", "<|endoftext|>", "é", "日本語", "12345", "!!", "\t x", "zz",
            " the quick brown fox", "x" * 40, " ", "😀", " I'll", "  \n  "]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 6)))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        ids = bpe.repaired([np.array(_ids(tok, p), vocab.dtype) for p in parts], vocab)
        assert ids.tolist() == _ids(tok, text), (text, parts)
        assert vocab.decode(ids).decode() == text == tok.decode(ids.tolist(), skip_special_tokens=False)


def test_stretches_of_long_texts(tok, monkeypatch):
    monkeypatch.setattr(vocabulary, "STRETCH", 100)
    vocab = vocabulary.vocabulary(vocabulary_path())
    rng = random.Random(1)
    texts = [prose(rng, 200), "x" * 1000, "", " " * 500 + "end of it", "a b " * 300]
    assert [x.tolist() for x in vocab.encode(texts)] == [_ids(tok, t) for t in texts]


def test_both_ways_of_encoding_agree(tok):
    """Random Latin texts through the faster library equal the reference one."""
    vocab = vocabulary.vocabulary(vocabulary_path())
    assert vocab._fast is not None
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x250)] + list(" \n\t'sdmt") * 20 + ["'ll", "'re", "\u00a0", " the", "\r\n"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert vocab._alike(text) and vocab.encode_one(text).tolist() == _ids(tok, text), repr(text)
    for text in ("日本", "a <|endoftext|> b", "\u0300x", "😀"):
        assert not vocab._alike(text) and vocab.encode_one(text).tolist() == _ids(tok, text)


def test_chunks_cut_equal_passages_alike():
    import pyarrow as pa
    rng = random.Random(3)
    shared = " ".join(prose(rng, 900) for _ in range(2))
    batch = pa.RecordBatch.from_arrays([pa.array([prose(rng, 90) + shared, "é" + shared, shared, None, "日本" * 9000])], ["text"])
    found = dict(bpe._chunked(batch))
    assert all("".join(c.decode() for c in chunks) == (batch.column(0)[k].as_py() or "") for k, chunks in found.items())
    assert all(len(c) <= bpe.MOST for chunks in found.values() for c in chunks)
    assert len(set(found[0]) & set(found[1]) & set(found[2])) >= len(found[2]) - 3


def test_encode_equals_the_library(spark, tok):
    from pyspark.sql import functions as F
    rng = random.Random(21)
    passage = " ".join(prose(rng, 800) for _ in range(2))
    rows = [(r.doc_id, r.text) for r in docs(spark, extra=False).collect()]
    rows += [(100 + i, prose(rng, 30) + passage + prose(rng, 30)) for i in range(20)]
    rows += [(200, "a <|endoftext|> b" * 500), (201, "don't " * 2000), (202, passage), (202, passage), (203, "x" * 30000)]
    rows += [(300 + i, "日本語" * 4000) for i in range(3)] + [(400, "<|endoftext|>")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("h", F.lit(2))
    path = vocabulary_path()
    decoded = bpe.decode(bpe.encode(table, path), path)
    assert sorted(map(repr, bpe.encode_decode(table, path).collect())) == sorted(map(repr, decoded.collect()))
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u2").tolist(), r.decoded, r.n_tokens) for r in decoded.collect()), key=repr)
    assert got == sorted(((i, _ids(tok, t), t or "", len(_ids(tok, t))) for i, t in rows), key=repr)
    for r in bpe.encode_digests(table, path).where("doc_id >= 100").collect():
        ids = _ids(tok, dict(rows)[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(dict(rows)[r.doc_id].encode()).hexdigest()


def test_encode_with_every_bit_set(spark, tok, monkeypatch):
    """A full bitmap sends all chunks the shared way, with the same ids."""
    monkeypatch.setattr(bpe, "_bitmap", lambda shared: b"\xff" * (bpe.BITMAP_BITS // 8))
    table = docs(spark, extra=False)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u2").tolist()) for r in bpe.encode(table, vocabulary_path()).collect()), key=repr)
    assert got == sorted(((r.doc_id, _ids(tok, r.text)) for r in table.collect()), key=repr)


def test_encode_empty_table(spark):
    path = vocabulary_path()
    assert bpe.encode_digests(docs(spark).limit(0), path).count() == 0
