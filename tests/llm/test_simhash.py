import re

import numpy as np
import pytest
import xxhash
from litmark.llm import simhash
from litmark.llm.common import components

from .conftest import CLASHING

TEXT = " ".join(f"word{i} and more" for i in range(40))
ROWS = [
    (1, TEXT), (2, TEXT.upper()), (3, TEXT + " extra"), (4, "word0 x " + TEXT), (9, None), (8, ""), (7, " \n"), (6, "one two"), (6, "one two"),
    (5, "One\tTwo"), (20, "ein ganz anderer Text mit vielen Wörtern und É"), (None, "no id here at all, none"), (30, "z " * 30_000),
]


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4 and root[i] > root[j]:
                    root[i], changed = root[j], True
    return root


def test_near_duplicates(table):
    found = sorted((tuple(r)[:3] for r in simhash.near_duplicates(table(ROWS, CLASHING)).collect()), key=str)
    prints = [plain_print(t) for _, t in ROWS]
    roots = plain_roots(prints)
    lowest = {}
    for (i, _), r in zip(ROWS, roots, strict=True):
        lowest[r] = min(lowest.get(r, i), i, key=lambda x: (x is not None, x or 0))
    wanted = [(i, f"{p:016x}", lowest[r]) for (i, _), p, r in zip(ROWS, prints, roots, strict=True)]
    assert found == sorted(wanted, key=str)


def test_one_row_of_each_component_stays(table):
    docs = table(ROWS, CLASHING)
    kept = simhash.drop_near(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len(set(plain_roots([plain_print(t) for _, t in ROWS])))


def test_empty_table(table):
    assert simhash.near_duplicates(table([])).collect() == []


@pytest.mark.parametrize(("bands", "block"), [((5, 1), 1000), ((5, 1), 7), ((6, 2), 50), ((7, 3), 1000)])
def test_links_join_what_brute_force_joins(spark, bands, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    prints = set(base.tolist())
    for p in base[:20].tolist():
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            prints.add(p ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    made = components(simhash.links(spark.createDataFrame(signed, "print long"), block, bands)).collect()
    root = {r.node % 2**64: r.root % 2**64 for r in made}
    ours = {}
    for p in prints:
        ours.setdefault(root.get(p, p), set()).add(p)
    theirs = {}
    for p, r in zip(prints, plain_roots(prints), strict=True):
        theirs.setdefault(r, set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_group_sizes_are_not_broadcast(spark, tmp_path):
    # Neighbours are one bit apart. Read from a small file, the groups look small to the planner at any number of prints.
    spark.createDataFrame([((1 << i) - 1,) for i in range(40)], "print long").write.parquet(str(tmp_path / "prints"))
    made = simhash.links(spark.read.parquet(str(tmp_path / "prints")))
    assert len({r.root for r in components(made).collect()}) == 1
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
