"""Language identification: held-out accuracy and defined corner cases."""

import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import langid
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    from starmart.llm.queries import op6_language_id
    return {r.doc_id: r for r in op6_language_id(spark, SF).collect()}


def test_held_out_accuracy(spark, predicted):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(rows) == len(predicted)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(predicted[r.doc_id].held_out for r in held)
    assert sum(p.held_out for p in predicted.values()) == len(held)
    right = sum(predicted[r.doc_id].lang_pred == r.lang for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= p.score <= 1 for p in predicted.values())


def test_corner_cases(spark):
    train = documents(spark, [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"),
                              (3, None, "en"), (4, "sans", None)])
    model = langid.train(train)
    assert model["langs"] == ["en", "fr"]
    docs = documents(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "the dog " * 50000),
                             (None, "le chien"), (4, "the")]).withColumn("score", F.lit("x"))
    got = sorted((str(r.doc_id), r.lang_pred) for r in langid.identify(docs, model).collect())
    assert got == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("4", "en"),
                   ("None", "fr")]
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3


def test_nothing_to_learn_from(spark):
    empty = documents(spark, [])
    model = langid.train(empty)
    assert langid.identify(documents(spark, [(1, "hello")]), model).first().lang_pred == "und"
    assert langid.identify(empty, model).count() == 0


def test_training_sample_is_the_same_again(spark):
    docs = documents(spark, [(i, f"the text {i} of words", "en") for i in range(300)])
    a, b = (langid.train(d, sample_docs=50) for d in (docs, docs.repartition(7)))
    assert (a["logp"] == b["logp"]).all()


def plain_buckets(text, bits=langid.BITS):
    """Buckets of the n-grams, one by one in Python integers."""
    kept = "".join(c if langid._LETTER.match(c) or langid._OTHER.match(c) is None else " "
                   for c in text.lower().replace("ς", "σ"))
    chars = " " + re.sub(" +", " ", kept).strip(" ") + " "
    for n in (1, 2, 3):
        for i in range(len(chars) - n + 1):
            h = 0
            for k, c in enumerate(chars[i:i + n]):
                h = (h + ord(c) + k + 1) * 0x9E3779B1 % 2**32
                h ^= h >> 15
            yield h * 0x9E3779B1 % 2**32 >> 32 - bits


TRAIN = [("the cat and the dog are in the house", "en"), ("a house, a garden and 3 trees!", "en"),
         ("le chat et le chien sont dans la maison", "fr"), ("une maison et un jardin", "fr"),
         ("ο σκύλος και ο γάτος", "el"), ("der Hund und die Katze im Haus", "de")]
TEXTS = ["the dog", "le jardin -- et 12 chats", "ΣΚΎΛΟΣ ΓΆΤΟΣ", "Katze", "x", "  ...  ", "", None,
         "\t une\u00a0maison İstanbul ", "dog" * 40, "the house " * 30]


def test_same_as_plain_naive_bayes(spark):
    model = langid.train(documents(spark, [(i, *r) for i, r in enumerate(TRAIN)]))
    counts = {}
    for text, lang in TRAIN:
        c = counts.setdefault(lang, {})
        for b in plain_buckets(text):
            c[b] = c.get(b, 0) + 1
    got = langid.score_texts(TEXTS, model)
    for text, (lang, score) in zip(TEXTS, got):
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
            continue
        s = {}
        for name, c in counts.items():
            whole = sum(c.values()) + 0.1 * 2**langid.BITS
            s[name] = math.log(sum(x == name for _, x in TRAIN) / len(TRAIN)) + sum(
                math.log((c.get(b, 0) + 0.1) / whole) for b in plain_buckets(text))
        best = max(s, key=s.get)
        assert lang == best
        assert score == pytest.approx(1 / sum(math.exp(v - s[best]) for v in s.values()), rel=1e-9)


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 64])
def test_pieces_lose_no_ngram(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    for group in (1, 7, 1000):
        monkeypatch.setattr(langid, "GROUP", group)
        got = {}
        for text, starts, bucket, n in langid._counted(TEXTS, langid.BITS):
            of = np.repeat(text, np.diff(np.append(starts, len(n))))
            for t, b, c in zip(of.tolist(), bucket.tolist(), n.tolist()):
                got[t, b] = got.get((t, b), 0) + c
        want = {}
        for i, text in enumerate(TEXTS):
            if any(c.isalpha() for c in text or ""):
                for b in plain_buckets(text):
                    want[i, b] = want.get((i, b), 0) + 1
        assert got == want


def test_memory_does_not_follow_the_text():
    langs = [f"l{i:03}" for i in range(100)]
    model = {"langs": langs, "bits": langid.BITS, "prior": np.zeros(100),
             "logp": np.random.default_rng(1).normal(-9, 1, (100, 1 << langid.BITS))}
    peaks = []
    for n in (1 << 18, 1 << 21):
        text = "abcdefghij klmnop qrstuvw xyz " * (n // 30)
        tracemalloc.start()
        langid.score_texts([text], model)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 64 << 20


def test_rare_language_is_learned(spark):
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(400)]
    rows += [(1000 + i, "žluťoučký kůň úpěl", "cs") for i in range(5)]
    rows += [(2000 + i, "le chat et le chien", "fr") for i in range(300)]  # copies of one text
    model = langid.train(documents(spark, rows), sample_docs=50)
    assert model["langs"] == ["cs", "en", "fr"]
    assert [x[0] for x in langid.score_texts(["kůň žluťoučký", "the dog", "le chien"], model)] == [
        "cs", "en", "fr"]
    assert np.allclose(np.exp(model["prior"]), np.array([5, 400, 300]) / 705)
