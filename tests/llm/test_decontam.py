"""Decontamination: verbatim and re-parameterised items, slot consistency."""

import random
import re

import pytest
from pyspark.sql import functions as F

from starmart.llm import decontam
from tests.llm.helpers import awkward, documents

ITEMS = [
    (1, "Alice has 5 apples and buys 5 more apples in the shop. How many apples does Alice hold "
        "when she walks 12 km back to her home?"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (3, "Yes."), (4, None), (5, ""), (6, "one two three four five six"),
]
CLEAN = "Some other words are written here and nobody asks a question about any of them at all. "


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def found(spark, bench, texts, **kw):
    docs = documents(spark, list(enumerate(texts)))
    return {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, **kw).collect()}


def test_verbatim_and_reparameterised(spark, bench):
    bob = ITEMS[0][1].replace("Alice", "Bob").replace("5", "7").replace("12 km", "3 miles")
    texts = [CLEAN + ITEMS[0][1] + " " + CLEAN,  # verbatim
             CLEAN + bob,                        # other name, numbers and unit
             CLEAN + bob.replace("buys 7", "buys 8"),  # numbers that do not map
             ITEMS[0][1].replace("Alice hold", "Carol hold"),
             CLEAN, "", None, ITEMS[1][1].upper(), "Yes. Yes.", CLEAN * 2000 + ITEMS[1][1],
             "one two three four five six", "one two three four five", " ".join(ITEMS[1][1].split()[:9])]
    got = found(spark, bench, texts)
    # Texts 2 and 3 keep a consistent run on one side of the break only.
    assert {(0, 1), (1, 1), (7, 2), (9, 2), (10, 6)} <= got
    assert not {d for d, _ in got} & {4, 5, 6, 8, 11, 12}
    rows = {(r.doc_id, r.item_id): r.n_tokens for r in decontam.contaminated(
        documents(spark, list(enumerate(texts))), bench).collect()}
    assert rows[0, 1] == rows[1, 1] == 27
    assert all(rows.get((d, 1), 0) < rows[0, 1] for d in (2, 3))


def test_against_brute_force_on_the_table(spark):
    """Without digits and with every item whole, a leak is the item's words."""
    sf = "/root/testdata/sf0.01"
    b, d = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("benchmark", "documents"))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(d, b).collect()}
    words = lambda t: " " + " ".join(re.findall(r"[^\W\d_]+", t or "")) + " "
    items = [(r.item_id, words(r.text)) for r in b.collect()]
    want = {(r.doc_id, i) for r in d.collect() for i, w in items if w in words(r.text)}
    assert want and got == want
    kept = {r.doc_id for r in decontam.drop_contaminated(d, b).select("doc_id").collect()}
    assert kept == {r.doc_id for r in d.collect()} - {i for i, _ in want}


def test_partitions_give_the_same(spark):
    rng = random.Random(1)
    vocab = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(5, 40)))) for i in range(60)]
    b = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"{CLEAN} {rng.choice(items)[1]} {CLEAN}" for _ in range(40)]
    assert found(spark, b, texts) == found(spark, b.repartition(5), texts)
    docs = documents(spark, list(enumerate(texts + [CLEAN])))
    assert [r.doc_id for r in decontam.drop_contaminated(docs, b).collect()] == [40]


def test_one_changed_word_anywhere(spark):
    """A word added, dropped or replaced at any place, for items of 8 to 30 tokens;
    what is covered is what a plain longest common subsequence covers."""
    rng = random.Random(2)
    vocab = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    items = [(n, " ".join(rng.sample(vocab, n))) for n in (8, 9, 12, 13, 14, 16, 17, 22, 30)]
    b = spark.createDataFrame(items, "item_id long, text string")
    texts, want = [], {}
    for item, text in items:
        words = text.split()
        for k in range(len(words)):
            for new, left in ((words[:k] + ["extra"] + words[k:], len(words)),
                              (words[:k] + words[k + 1:], len(words) - 1),
                              (words[:k] + ["other"] + words[k + 1:], len(words) - 1)):
                want[len(texts), item] = left
                texts.append(f"{CLEAN} {' '.join(new)} {CLEAN}")
    docs = documents(spark, list(enumerate(texts)))
    got = {(r.doc_id, r.item_id): r.n_tokens for r in decontam.contaminated(docs, b).collect()}
    assert got == want


def test_against_plain_matching(spark):
    """Pieces of items of any length among noise: an uninterrupted piece of 13 tokens,
    or a shorter item nearly whole, is found, and nothing else."""
    rng = random.Random(3)
    vocab = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    items = [(n, " ".join(rng.sample(vocab, n))) for n in (5, 6, 8, 11, 13, 18, 25, 60)]
    b = spark.createDataFrame(items, "item_id long, text string")
    texts, want = [], set()
    for _ in range(150):
        item, text = rng.choice(items)
        size = rng.randint(1, item)
        at = rng.randint(0, item - size)
        if size >= (13 if item > 13 else item if item < 8 else item - item // 8):
            want.add((len(texts), item))
        texts.append(f"{CLEAN} {' '.join(text.split()[at:at + size])} {CLEAN}")
    assert 20 < len(want) < 130 and found(spark, b, texts) == want


def test_shared_preamble(spark):
    """A preamble that many items share identifies none of them; with an item's own
    words behind it, it is that item.  An item that is the preamble is found."""
    words = "please read the whole text below with care and then choose the one best answer from the list"
    own = [f"n{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    items = [(i, f"{words} {' '.join(own[10 * i:10 * i + 10])}") for i in range(40)]
    b = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"{CLEAN} {words}. {CLEAN}", f"{CLEAN} {items[7][1]} {CLEAN}", items[9][1], words]
    assert found(spark, b, texts) == {(1, 7), (2, 9)}
    whole = b.union(spark.createDataFrame([(99, words)], b.schema))
    assert found(spark, whole, texts) == {(0, 99), (1, 7), (1, 99), (2, 9), (2, 99), (3, 99)}
    docs = documents(spark, list(enumerate(texts)))
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, b).collect()) == [0, 3]
    # Repeated items are one template, however many they are.
    many = spark.createDataFrame([(i, items[7][1]) for i in range(30)], b.schema)
    assert found(spark, many, [CLEAN, items[7][1]]) == {(1, i) for i in range(30)}


def test_items_of_frequent_windows_only(spark):
    """No window identifies the items, and the changed copy lacks their first tokens."""
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5)]
    b = spark.createDataFrame([(k, " ".join(words[:16 + k])) for k in range(15)],
                              "item_id long, text string")
    changed = words[:16]
    changed[3] = "other"
    texts = [f"{CLEAN} {' '.join(changed)} {CLEAN}", f"{CLEAN} {' '.join(words[:13])} {CLEAN}",
             f"{CLEAN} {' '.join(changed[:8])} {CLEAN} {' '.join(words[8:16])}"]
    # 15 tokens are nearly all of 16 and 17; 13 of 16 are not.
    assert found(spark, b, texts) == {(0, 0), (0, 1)}
    assert found(spark, b, texts, max_items=100) == {(0, k) for k in range(15)} | {
        (1, k) for k in range(15)}


def test_a_change_in_all_that_identifies_an_item(spark):
    words = "please read the whole text below with care and then choose the one best answer from the list"
    items = [(i, f"{words} na{chr(97 + i)} nb{chr(97 + i)} nc{chr(97 + i)}") for i in range(20)]
    b = spark.createDataFrame(items, "item_id long, text string")
    near = items[7][1].replace("nah", "other")
    two = near.replace("nbh", "other")
    texts = [f"{CLEAN} {near} {CLEAN}", f"{CLEAN} {words} {CLEAN}", two, items[3][1],
             two.replace("nch", "other")]
    # Two of 21 tokens may be missing, not three.
    assert found(spark, b, texts) == {(0, 7), (2, 7), (3, 3)}
    assert found(spark, b.repartition(7), texts) == {(0, 7), (2, 7), (3, 3)}


def test_short_items(spark, bench):
    """Under five tokens: the whole document, in any case and punctuation."""
    assert found(spark, bench, ["yes", "Yes!", "yes yes", "oh yes", "", CLEAN]) == {(0, 3), (1, 3)}


def test_clashing_columns(spark, bench):
    names = ["item_id", "iid", "key", "_decontam_key", "_text", "fid", "n_tokens", "first_token", "_b"]
    docs = documents(spark, [(1, ITEMS[1][1]), (2, CLEAN), (3, None)])
    for n in names:
        docs = docs.withColumn(n, F.lit("x"))
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()] == [(1, 2)]
    kept = decontam.drop_contaminated(docs, bench.withColumn("iid", F.lit(1)))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_items_dense_in_placeholders(spark):
    apples = "John has 3 apples, Mary has 5 apples and Tom has 7 apples."
    numbers = "Add 3 4 8 15 16 23 42 99 107 5 6 1 2 70"
    long = ("we count the birds on every farm near town: Ann 3, Ben 4, Cid 5, Dan 6, Eve 7 "
            "and then all of them fly away again")
    b = spark.createDataFrame([(1, apples), (2, numbers), (3, long), (4, "Ann met 2 men")],
                              "item_id long, text string")
    other = apples.replace("John", "Bob").replace("Mary", "Sue").replace("3", "12").replace("7", "1")
    texts = [apples, other, other.replace("Sue", "Bob"),  # two names become one
             numbers, numbers.replace("42", "43"), "1 2 3 " * 50, CLEAN + long,
             long.replace("Ann 3", "Kim 30"), "Ann met 2 men"]
    docs = documents(spark, list(enumerate(texts)))
    got = {(r.doc_id, r.item_id): r.n_tokens for r in decontam.contaminated(docs, b).collect()}
    n = len(re.findall(r"\w+", long))
    # Text 8 is all of item 4.
    assert got == {(0, 1): 13, (1, 1): 13, (3, 2): 15, (6, 3): n, (7, 3): n, (8, 4): 4}
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, b).collect()) == [2, 4, 5]


def test_case_and_partitions(spark, bench):
    """Names match in any case, and are the same words in every partition."""
    assert found(spark, bench, [ITEMS[0][1].lower(), ITEMS[0][1].upper(), ITEMS[1][1].title()]) == {
        (0, 1), (1, 1), (2, 2)}
    tail = "can we say of the river that runs by this old mill in spring"
    items = [(i, f"{w} {tail.replace('mill', v)}") for i, (w, v) in enumerate(
        [("What", "what"), ("May", "house"), ("Will", "may"), ("Paris", "will")] * 3)]
    b = spark.createDataFrame(items, "item_id long, text string")
    # 'may' is a word of the benchmark: a name in its place is a replaced word.
    texts = [f(t).replace("May", "Rome") for _, t in items for f in (str, str.lower, str.title)]
    docs = documents(spark, list(enumerate(texts)))
    rows = lambda b: sorted(decontam.contaminated(docs, b).collect())
    best: dict = {}
    for r in rows(b):
        best[r.doc_id] = max(best.get(r.doc_id, 0), r.n_tokens)
    assert best == {d: 14 if "Rome" in t else 15 for d, t in enumerate(texts)}
    assert rows(b) == rows(b.repartition(7))


def test_corner_tables(spark, bench):
    docs = documents(spark, awkward()).withColumn("item_id", F.lit("x"))
    assert decontam.contaminated(docs, bench).count() == 0
    assert decontam.drop_contaminated(docs, bench).count() == docs.count()
    assert decontam.drop_contaminated(docs, bench).columns == docs.columns
    assert decontam.contaminated(docs.limit(0), bench).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    none = documents(spark, [(None, ITEMS[1][1]), (7, ITEMS[1][1]), (7, ITEMS[1][1])])
    assert sorted(str(r.doc_id) for r in decontam.contaminated(none, bench).collect()) == [
        "7", "7", "None"]
