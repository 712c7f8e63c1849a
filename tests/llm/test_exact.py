import hashlib
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from litmark.llm import exact

from .conftest import CLASHING

LONG = "ab \t" * 50_000 + "end"
ROWS = [(5, "a  b"), (3, "a\tb"), (3, "a b"), (None, "a b"), (7, None), (8, ""), (9, " "), (10, "\n\n"), (11, LONG), (12, LONG.replace("\t", "\n ")), (13, LONG + "!"), (14, "é x"), (15, "é x"), (4, "same"), (4, "same")]


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        keep = min(ids, key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0))):
            out.append((i, keep, len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **kw):
    return sorted((tuple(r)[:5] for r in exact.exact_groups(docs, **kw).collect()), key=str)


def test_groups(table):
    assert found(table(ROWS, CLASHING)) == plain(ROWS)


def test_colliding_fingerprints_are_told_apart(table):
    rows = [(i, f"{w}") for i, w in enumerate(["aa", "ab", "ba", "bb", "aa", "ba", "cc", "cd"] * 3)]
    assert found(table(rows), primes=(2, 2), bases=(1, 1)) == plain(rows)


def test_chunks_combine():
    text = bytes(range(256)) * 700
    batch = pa.RecordBatch.from_pydict({"row": [1], "doc_id": [1], "text": [text.decode("latin-1")]})
    rows = next(exact._chunk_rows(exact.PRIMES, exact.BASES)(iter([batch])))
    made = list(exact.normalised(batch["text"]))[0]
    whole = []
    for p, base in zip(exact.PRIMES, exact.BASES):
        h = 0
        for b in made:
            h = (h * base + b) % p
        whole.append(h)
    assert rows.num_rows > 1
    assert [sum(rows["a"].to_pylist()) % exact.PRIMES[0], sum(rows["b"].to_pylist()) % exact.PRIMES[1]] == whole


def test_empty_table(table):
    assert found(table([])) == []
    assert exact.drop_exact(table([])).count() == 0


@pytest.mark.parametrize("extra", [(), CLASHING])
def test_drop(table, extra):
    docs = table(ROWS, extra)
    kept = exact.drop_exact(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
