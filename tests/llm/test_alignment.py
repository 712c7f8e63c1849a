import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from litmark.llm import alignment
from tokenizers import Tokenizer

from .conftest import CLASHING

PATHS = alignment._paths(None, None)
CODER = alignment.coder(*PATHS)
SLOW = Tokenizer.from_file(PATHS[0])
SLOW.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def token_bytes(kind):
    if kind == "a":
        visible = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
        hidden = [b for b in range(256) if b not in visible]
        letters = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        return lambda i: bytes(letters[c] for c in SLOW.id_to_token(i))
    return lambda i: bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode()


BYTES = token_bytes("a"), token_bytes("b")


def plain(text):
    """Groups [(A ids, B ids)] of a whole text, each side encoded in one go; none if bytes differ."""
    if not text:
        return []
    ids = SLOW.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    if any(b"".join(map(one, x)) != (" " + text).encode() for one, x in zip(BYTES, ids, strict=True)):
        return []
    ends = [np.cumsum([len(one(i)) for i in x]).tolist() for one, x in zip(BYTES, ids, strict=True)]
    groups, low = [], (0, 0)
    for end in sorted(set(ends[0]) & set(ends[1])):
        high = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((ids[0][low[0] : high[0]], ids[1][low[1] : high[1]]))
        low = high
    return groups


def wanted(rows):
    every = [plain(t) for _, t in rows]
    docs = Counter()
    for groups in every:
        docs.update({(a, b) for x, y in groups for a in x for b in y})
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), groups in zip(rows, every, strict=True):
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(docs[p] == most[p[0]] for p in links),
                    sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


PARTS = [*"aZ9é \n\t'.,!ñß\x85\xa0\x1c 　​中ـ’“—▁\x00", "<|endoftext|>", "<s>", "<0x41>", "'s", " the", "  ", "token", "internationalisation", "ing", "😀", "1234567"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14), max_size=4), st.booleans())
def test_as_whole_texts(lists, short):
    texts = ["".join(x) for x in lists]
    before, alignment.SEGMENT = alignment.SEGMENT, 5 if short else alignment.SEGMENT
    try:
        found = [[] for _ in texts]
        for owners, block in alignment.blocks(CODER, texts):
            a, b = (np.split(x, cuts[1:-1]) for x, cuts in ((block.a, block.cuts_a), (block.b, block.cuts_b)))
            for k, owner in enumerate(owners):
                for g in range(block.at_group[k], block.at_group[k + 1]):
                    found[owner].append((a[g].tolist(), b[g].tolist()))
    finally:
        alignment.SEGMENT = before
    assert found == [plain(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 3000), max_size=400), st.sets(st.integers(0, 3000), max_size=60), st.booleans())
def test_galloping_finds_common_entries(a, b, swap):
    a, b = (np.array(sorted(x | {3001})) for x in (a, b))
    if swap:
        a, b = b, a
    x, y = alignment.common(a, b)
    assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


ROWS = [(1, "The internationalisation of words, words and words"), (1, "The internationalisation of words, words and words"), (2, None), (3, ""), (None, "no id, Größe"), (4, "a▁b c"),
        (5, " "), (6, "中文 and <|endoftext|> <s> 日本語"), (7, "z" * 3_000 + " words " * 900), (8, "word1 word2  word3\nof words")]


@pytest.mark.parametrize(("known", "piece"), [(1_000_000, 1 << 20), (40, 7), (0, 1 << 20)])
def test_counts_over_documents(table, known, piece):
    found = alignment.link_counts(table(ROWS, CLASHING), known=known, piece=piece).drop("row")
    assert sorted((tuple(r) for r in found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str) == wanted(ROWS)


@pytest.mark.parametrize(("expanded", "segment"), [(4096, 1 << 20), (0, 1 << 20), (2, 40)])
def test_pairs_of_a_block(monkeypatch, expanded, segment):
    monkeypatch.setattr(alignment, "EXPANDED", expanded)
    monkeypatch.setattr(alignment, "SEGMENT", segment)
    texts = [t for _, t in ROWS]
    found = [Counter() for _ in texts]
    for owners, block in alignment.blocks(CODER, texts):
        segments, codes, links = block.pairs()
        for s, code, n in zip(segments.tolist(), codes.tolist(), links.tolist(), strict=True):
            found[owners[s]][divmod(code, len(CODER.bytes_b))] += n
    assert found == [Counter((a, b) for x, y in plain(t) for a in x for b in y) for t in texts]


def test_real_groups(table):
    for r in alignment.align(table(ROWS, CLASHING)).collect():
        text = next(t for i, t in ROWS if i == r.doc_id)
        a, b = ([x[i:j] for i, j in zip([0, *ends], ends, strict=False)] for x, ends in ((r.a_ids, r.a_ends), (r.b_ids, r.b_ends)))
        assert list(zip(a, b, strict=True)) == plain(text)


def test_empty_table(table):
    assert alignment.link_counts(table([])).collect() == [] == alignment.align(table([])).collect()


def test_query_over_the_table(spark):
    from litmark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op12_alignment"](spark, folder)
    assert sorted((tuple(r) for r in found.collect()), key=str) == wanted(rows)
