import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from litmark.llm import leaks

from .conftest import CLASHING

RNG = random.Random(3)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 7))) for _ in range(400)] + ["the", "of", "and"] * 40
ITEMS = [(i, " ".join(RNG.choices(VOCABULARY, k=RNG.choice([5, 9, 16, 30, 55, 150])))) for i in range(60)]


def prose(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def edited(text, rate):
    words = text.split()
    for _ in range(int(len(words) * rate)):
        at, kind = RNG.randrange(len(words)), RNG.random()
        if kind < 0.34:
            words[at] = RNG.choice(VOCABULARY)
        elif kind < 0.67:
            words.insert(at, RNG.choice(VOCABULARY))
        else:
            del words[at]
    return " ".join(words)


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=9), st.lists(st.integers(1, 4), max_size=14))
def test_edits_as_brute_force(item, text):
    cost, a, b = leaks.edits(np.array(item, np.uint64), np.array(text, np.uint64))
    assert cost == distance(item, text)
    # The stretch it names has that distance too.
    row = list(range(b - a + 1))
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text[a:b], 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    assert row[-1] == cost


def test_recall_and_no_false_hits():
    index = leaks.build([i for i, _ in ITEMS], [t for _, t in ITEMS])
    for rate, least in ((0, 1), (0.1, 0.97), (0.2, 0.9)):
        texts = [prose(80) + ".\n" + edited(t, rate) + ", " + prose(70) for _, t in ITEMS] * 2
        found = leaks.hits(index, pa.array(texts))
        recall = sum(any(h["item"] == i % len(ITEMS) for h in f) for i, f in enumerate(found)) / len(texts)
        assert recall >= least, (rate, recall)
        for text, own in list(zip(texts, found, strict=True))[:40]:
            for h in own:
                item = ITEMS[h["item"]][1].split()
                assert h["edits"] == distance(item, text.replace(".", "").replace(",", "").split()) <= 0.2 * len(item)
    # A batch and each of its texts alone give the same.
    assert [leaks.hits(index, pa.array([t]))[0] for t in texts[:20]] == found[:20]


ROWS = [(1, prose(30)), (2, prose(200) + " " + ITEMS[7][1].upper() + "! " + prose(9000)), (3, None), (4, ""), (5, ITEMS[9][1]), (5, ITEMS[9][1]), (None, "x " + ITEMS[9][1] + " y " + ITEMS[7][1])]


def test_frame(spark, table):
    docs = table(ROWS, (*CLASHING, "_leaks"))
    given_items = [*ITEMS, (None, "six words of an item here"), (98, None), (99, ""), (100, "too few")]
    benchmark = spark.createDataFrame(given_items, "item_id long, text string")
    found = sorted(((r.doc_id, [h.item_id for h in r.leaks]) for r in leaks.with_leaks(docs, benchmark).select("doc_id", "leaks").collect()), key=str)
    assert found == sorted([(1, []), (2, [7]), (3, []), (4, []), (5, [9]), (5, [9]), (None, [7, 9])], key=str)
    kept = leaks.drop_leaks(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_blocks_and_empty_tables(spark, table, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_ITEMS", 17)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = table(ROWS)
    assert sum(len(r.leaks) for r in leaks.with_leaks(docs, benchmark).collect()) == 5
    assert leaks.drop_leaks(docs, benchmark.limit(0)).count() == len(ROWS)
    assert leaks.drop_leaks(table([]), benchmark).count() == 0


def test_short_items_and_scripts_without_spaces():
    given = ["Three little words", "solo", "北京是中华人民共和国的首都和直辖市", "ภาษาไทยไม่มีช่องว่างระหว่างคำ", "four words of it", "日本"]
    index = leaks.build(list(range(6)), given)
    texts = [
        "some three  little\nWORDS, and more", "three little", "words three little", "a solo run", "soloist", "我们知道北京是中华人民共和国的首都和直辖市。", "他说北京是中国的首都",
        "และภาษาไทยไม่มีช่องว่างระหว่างคำครับ", "", "four words", "of it", "in 日本語", "北京是中华人民共和国首都和直辖市吗", "solo solo three little words solo",
    ]
    found = [[h["item"] for h in f] for f in leaks.hits(index, pa.array(texts))]
    assert found == [[0], [], [], [1], [], [2], [], [3], [], [], [], [5], [2], [0, 1]]
    start = leaks.hits(index, pa.array([texts[0], texts[11]]))
    assert (start[0][0]["start"], start[0][0]["words"], start[0][0]["edits"], start[1][0]["start"]) == (1, 3, 0, 1)
    assert leaks.hits(leaks.build([1], ["solo"]), pa.array(["a solo", None])) == [[{"item": 0, "start": 1, "words": 1, "edits": 0}], []]
