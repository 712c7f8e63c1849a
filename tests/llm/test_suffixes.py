import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from litmark.llm import suffixes

from .conftest import CLASHING

RNG = random.Random(8)


def prose(n):
    return "".join(RNG.choices("abcdefg hé", k=n))


PASSAGE, SECOND = prose(500), prose(230)
ROWS = [(i, prose(RNG.randint(0, 900))) for i in range(25)]
ROWS += [(100 + i, prose(RNG.randint(0, 300)) + PASSAGE[RNG.randint(0, 120) :] + prose(RNG.randint(0, 300))) for i in range(25)]
ROWS += [(200, None), (201, ""), (202, "x" * 199), (203, "x" * 1000), (204, "ab" * 150), (205, prose(90) * 4), (206, SECOND + prose(50) + SECOND), (207, "\0" * 300), (208, prose(150) * 2)]
ROWS += [(300, ROWS[3][1] + "tail"), (301, PASSAGE), (301, PASSAGE), (302, "short copy"), (303, "short copy"), (None, PASSAGE[:200]), (304, PASSAGE[:199]), (305, "z" * 700_000 + PASSAGE)]


def plain(rows, least=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(hashlib.md5(t[i : i + least]).digest() for t in texts for i in range(len(t) - least + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        drop = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if seen[hashlib.md5(t[i : i + least]).digest()] > 1:
                drop[i : i + least] = True
        kept = bytes(b for b, d in zip(t, drop, strict=True) if not d)
        out.append((doc, len(t), int(drop.sum()), len(suffixes.runs(drop)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


WANTED = plain(ROWS)


@pytest.mark.parametrize("most", [256, 3])
def test_as_brute_force(table, monkeypatch, most):
    monkeypatch.setattr(suffixes, "SPANS", most)
    found = sorted((tuple(r)[:5] for r in suffixes.remove_repeats(table(ROWS, CLASHING)).collect()), key=str)
    assert found == WANTED


def test_empty_table(table):
    assert suffixes.remove_repeats(table([])).collect() == []


def test_suffix_array_and_prefixes_as_by_sorting():
    for _ in range(30):
        parts = [bytes(RNG.choices(range(1, 4), k=RNG.randint(0, 60))) for _ in range(RNG.randint(1, 6))]
        text = b"".join(p + b"\0" for p in parts)
        zeros = [i for i, b in enumerate(text) if not b]

        def symbols(i, text=text, zeros=zeros):
            return [(0, zeros.index(k)) if not text[k] else (text[k], 0) for k in range(i, len(text))]

        order, rank = suffixes.suffix_array(np.frombuffer(text, np.uint8))
        wanted = sorted(range(len(text)), key=symbols)
        assert order.tolist() == wanted and rank[order].tolist() == list(range(len(text)))
        shared = suffixes.common_prefixes(np.frombuffer(text, np.uint8), order, rank, 20, 7)
        for a, b in zip(wanted[:-1], wanted[1:], strict=True):
            x, y = symbols(a), symbols(b)
            same = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert shared[b] == min(same, 20)


def test_every_window_is_in_one_span():
    texts = [t.encode() for _, t in ROWS[:60] if t]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, count, _, _ = suffixes.spans(data, at)
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count, strict=True)])
    wanted = [i for a, b in zip(at[:-1], at[1:], strict=True) for i in range(a, b - 199)]
    assert covered.tolist() == wanted


def test_long_runs_of_many_lengths_are_dealt_by_bytes(spark, table):
    docs = table([(i, "z" * (230_000 + 400 * i)) for i in range(60)] + [(99, "y" * 150)])
    found = {r.doc_id: tuple(r)[1:4] for r in suffixes.remove_repeats(docs).collect()}
    assert found == {i: (230_000 + 400 * i,) * 2 + (1,) for i in range(60)} | {99: (150, 0, 0)}
    contents = spark.range(60).selectExpr("1L AS hash", "xxhash64(id) AS digest", "repeat('z', 230000) AS content", "true AS inner")
    most = suffixes._dealt(contents).groupBy("shard").sum("distinct").count()
    largest = max(r["b"] for r in suffixes._dealt(contents).selectExpr("shard", "length(content) AS n").groupBy("shard").agg({"n": "sum"}).toDF("shard", "b").collect())
    assert most > 10 and largest <= 4 * suffixes.SPAN_BYTES
