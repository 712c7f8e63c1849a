import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from litmark.llm import packing, tokens
from tokenizers import Tokenizer

from .conftest import CLASHING

ROWS = [(1, "hello world"), (2, None), (3, ""), (4, "a  b \n c <|endoftext|> d"), (4, "a  b \n c <|endoftext|> d"), (None, "é ü"), (5, "word " * 5000), (6, "x" * 4000), (7, "中文 text")]


def best(sizes, most):
    @lru_cache(None)
    def bins(left):
        if not left:
            return 0
        found = [99]

        def fill(room, rest, start):
            found.append(1 + bins(tuple(rest)))
            for i in range(start, len(rest)):
                if rest[i] <= room:
                    fill(room - rest[i], rest[:i] + rest[i + 1 :], i)

        fill(most - left[0], list(left[1:]), 0)
        return min(found)

    return bins(tuple(sorted(sizes, reverse=True)))


def test_as_few_bins_as_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        most = rng.choice([10, 20, 30])
        sizes = [rng.randint(1, most - 1) for _ in range(rng.randint(1, 9))]
        counts = np.bincount(sizes, minlength=most + 1).tolist()
        bins = packing.complete(counts, most)
        assert sorted(s for b in bins for s in b) == sorted(sizes)
        assert all(sum(b) <= most for b in bins)
        assert packing.lower_bound(counts, most) <= len(bins) == best(sizes, most)


def test_search_beats_best_fit():
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    counts = np.bincount(sizes, minlength=61).tolist()
    assert len(packing.complete(counts, 60)) == 3 < len(packing.best_fit(counts, 60))


def test_search_reaches_packings_of_more_than_3000_bins():
    # What no bin can share lies beside pieces that best-fit packs into 4 bins, and a search into 3.
    sizes = [60] * 1_500 + [59] * 2_000 + [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    counts = np.bincount(sizes, minlength=61).tolist()
    bins = packing.complete(counts, 60)
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 60 for b in bins)
    assert len(bins) == 3_503 < len(packing.best_fit(counts, 60))


def test_search_improves_a_large_group():
    sizes = np.random.default_rng(3).integers(200, 701, 8_000)
    counts = np.bincount(sizes, minlength=1025).tolist()
    bins = packing.complete(counts, 1024)
    assert sorted(s for b in bins for s in b) == sorted(sizes.tolist()) and all(sum(b) <= 1024 for b in bins)
    assert 3_000 < packing.lower_bound(counts, 1024) <= len(bins) < len(packing.best_fit(counts, 1024))


@pytest.mark.parametrize("group", [50_000, 2])
def test_pack(table, group):
    rows = [tuple(r) for r in packing.pack(table(ROWS, CLASHING), group=group).collect()]
    library = Tokenizer.from_file(tokens.tokenizer_file())
    wanted = []
    for doc, text in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)] if len(ids) > 1024 else [0]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            wanted.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r[:5] for r in rows), key=str) == sorted(wanted, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r[5]].append((r[6], r[3]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    if group > 100:
        total = sum(r[3] for r in rows)
        assert len(sequences) == -(-total // 1024)


def test_empty_table(table):
    assert packing.pack(table([])).collect() == []
