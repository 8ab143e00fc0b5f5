"""Token-ID shards: exact round trips of lists, shards, encodings and the query."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starmart.llm import token_file as T
from starmart.llm.queries import op12_token_ids
from tests.llm.helpers import awkward, documents

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

ODD = ["it's DON'T we'll 'tis a' -'s", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> a<|b",
       "a b \x1cx\x1d é İX ΑΣ σ--'", "12,3 ____ a_b 中文 \U0001f642",
       "Word. word... WORD!? (word)", "x" * 5000, "\x00 \x7f",
       "J\u030c j\u030c E\u0301 x\u0338 <\u0338", "STRASSE ÀÉÎ ×÷ ÿŸ Straße."]


def test_lists_select_what_was_packed():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.choice([0, 1, 2, 5, 255, 256, 257, 700])
        top = rng.choice([0, 1, 10, 10**6, 2**62])
        values = sorted(rng.randint(0, top) for _ in range(n))
        if n and rng.random() < .3:
            values[-1] += 10**6  # one long document
        data = b"xyz" + T.pack_list(np.array(values, np.uint64)) + b"tail"
        got = T.EliasFano(data, 3, n, T.low_bits(n, values[-1] if n else 0))
        assert data[got.end:] == b"tail"
        assert got.select(np.arange(n)).tolist() == values
        at = [rng.randrange(n) for _ in range(20)] if n else []
        assert got.select(at).tolist() == [values[i] for i in at]


def test_lists_stay_near_the_bound():
    """2 + log2(u/n) bits a number, and one place of 32 bits for each 256."""
    rng = random.Random(3)
    n, u = 50_000, 20_000_000
    size = 8 * len(T.pack_list(np.array(sorted(rng.randint(0, u) for _ in range(n)), np.uint64)))
    assert size / n < 2 + np.log2(u / n) + 0.3 < 12


def test_shard_round_trip():
    docs = [None, None, -5, -5, 7, 2**62]
    ids = [np.arange(k, dtype="<u2").tobytes() for k in (0, 3, 0, 5, 1, 100)]
    shard = T.Shard(T.pack_shard(docs, ids, 2, 3, 4) + b"\n")
    assert (shard.partition, shard.number, shard.doc_ids()) == (3, 4, docs)
    assert [shard.ids(i).tobytes() for i in range(6)] == ids
    start, end = shard.bounds([5, 1, 0])
    assert (start.tolist(), end.tolist()) == ([9, 0, 0], [109, 3, 0])
    with pytest.raises(ValueError):
        T.Shard(b"x" * 100)


def plain(path, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path, by_word", [(WORDS, True), (BYTES, False)])
def test_encoder_equals_the_library(spark, path, by_word, monkeypatch):
    texts = [r.text or "" for r in
             spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ODD + ["", " \t\n", "tab\tand\x0bfeeds\x0c"]
    encoder = T._Encoder(path)
    assert encoder.by_word == by_word
    expected = plain(path, texts)
    for most in (T.CACHE_WORDS, 50):  # also when the memory is emptied again and again
        monkeypatch.setattr(T, "CACHE_WORDS", most)
        got = [x for k in range(0, len(texts), 40)
               for x in encoder.encode([t.encode() for t in texts[k:k + 40]])]
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == expected


@pytest.mark.parametrize("shard_ids", [T.SHARD_IDS, 50])
def test_files_hold_all_documents_in_order(spark, tmp_path, shard_ids):
    rows = awkward(6) + [(10_000 + i, t) for i, t in enumerate(ODD)]
    docs = documents(spark, rows).withColumn("first", F.lit("mine")).repartition(4)
    path = T.write_tokens(docs, f"{tmp_path}/ids", WORDS, end_id=2, shard_ids=shard_ids)
    got = T.token_index(T.read_tokens(spark, path, with_ids=True)).orderBy("start").collect()
    texts = [t or "" for _, t in rows]
    ids = dict(zip(texts, plain(WORDS, texts)))
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows),
                                             key=lambda d: (d is not None, d))
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert (sorted((str(r.doc_id), r.ids) for r in got)
            == sorted((str(d), ids[t or ""] + [2]) for d, t in rows))
    order = [(r.partition, r.number, r.place) for r in got]
    assert order == sorted(order)
    # Again, from another layout of the rows: the same places.
    again = T.write_tokens(docs.repartition(7), f"{tmp_path}/again", WORDS, end_id=2)
    both = [T.token_index(T.read_tokens(spark, p)).select("doc_id", "start", "ids_crc32")
            for p in (path, again)]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))


def test_empty_table_and_no_end(spark, tmp_path):
    docs = documents(spark, [(1, None), (2, "a b")])
    got = T.encode_and_index(docs, f"{tmp_path}/a", WORDS)
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in got.collect()) == [(1, 0, 0), (2, 0, 2)]
    assert T.encode_and_index(docs.limit(0), f"{tmp_path}/b", WORDS).count() == 0


def test_query_holds_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = op12_token_ids(spark, sf).orderBy("start").collect()
    expected, start = [], 0
    for r, ids in zip(docs, plain(WORDS, [r.text or "" for r in docs])):
        ids = ids + [2]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r)[:4] for r in got] == expected


def test_a_closing_mark_makes_no_other_word():
    texts = ["one, two. one two, one. two", "é. É, é. e,́ ×. x÷, don't. 's, a.b c., d., (e.) ,. f .g",
             "Ü, Ü, Σ. ς, <|endoftext|>. x<|y, 1. 2, z.\n\ny,\x85", "...", ",", "a."]
    encoder = T._Encoder(WORDS)
    got = encoder.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == plain(WORDS, texts)
    assert {b"one", b"two", b",", b"."} <= set(encoder._known)
    assert not {b"one,", b"two.", b"two,", b"one."} & set(encoder._known)
