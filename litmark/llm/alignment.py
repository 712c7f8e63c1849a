"""Tokens of two tokenizers aligned by the places where both end.

A text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B). The byte offsets at which tokens end are two rising lists;
the shorter one drives a galloping search into the longer: steps double until they pass the wanted offset, then a binary search
finds it, and the next search starts there. Common offsets cut both token lists into groups, and the differences of the ranks on either
side give each A token the range of B tokens that it shares a group with.

Words are encoded once per worker and remembered: a space between two other characters begins a token of both tokenizers.
How many documents hold a pair of ids linked is counted by an aggregation; the most frequent pairs, a bounded number, are looked up in a
broadcast table, and only the others are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from litmark.llm.common import numbered, saved
from litmark.llm.tokens import fast, tokenizer_file
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a worker remembers, at about 350 bytes each; past that it starts anew.
CACHED = 400_000
#: Texts are taken in segments of about so many characters, cut where a word begins, and blocks of segments of about this size.
SEGMENT = 1 << 20
#: Searches that run side by side each find so many offsets one after another.
LANE = 64
#: Groups of more links than this are linked by distinct ids and their numbers, so that a long group is not expanded.
EXPANDED = 4096
#: Most pairs in the broadcast table, about 20 MB; any number of further pairs is joined.
KNOWN = 1_000_000
#: Pairs of one document in a row of the stored table.
PIECE = 1 << 20

_WHITE = r"[\s\x1c-\x1f\x85᠎​-‏⁠﻿]"
_ODD = re.compile(rf" (?={_WHITE}|\Z)")
_CUT = re.compile(rf"(?<! ) (?!{_WHITE}|\Z)")
# Characters that the two encoders of the byte-level vocabulary split alike.
_PLAIN = re.compile(r"[\x00-\x1b -\x84\x86-\xff]*\Z")


class Coder:
    """Both tokenizers, the bytes of their tokens, and the words already encoded."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(a), fast(a)
        self.slow.encode_special_tokens = True  # their strings in a text are ordinary text
        self.piece = sentencepiece.SentencePieceProcessor(model_file=b)
        self.bytes_a, self.bytes_b = byte_level(a), self._pieces()
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.names_a, self.last_a = _names(len(self.bytes_a), "|")
        self.names_b, self.last_b = _names(len(self.bytes_b), ";")
        # Pieces that go on behind a space would make tokens across words.
        self.cuts = not any(re.search(r"[^▁]▁", self.piece.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.words_a: dict[str, bytes] = {}
        self.words_b: dict[str, bytes] = {}

    def _pieces(self) -> list[bytes]:
        coder = self.piece
        return [
            bytes([int(coder.id_to_piece(i)[3:5], 16)]) if coder.is_byte(i) else coder.id_to_piece(i).replace("▁", " ").encode()
            for i in range(coder.get_piece_size())
        ]

    def encoded(self, words: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of a space and each word; None if the bytes of either side's tokens differ from it."""
        for word, b in zip(words, self.piece.encode(words, num_threads=1), strict=True):
            text = " " + word
            a = self.fast.encode_ordinary(text) if _PLAIN.match(text) else self.slow.encode(text, add_special_tokens=False).ids
            whole = text.encode()
            same = b"".join([self.bytes_a[i] for i in a]) == whole == b"".join([self.bytes_b[i] for i in b])
            yield (a, b) if same else None

    def segments(self, text: str) -> Iterator[list[str]]:
        """Words (what follows the space that begins each) of the text with a space before it, in segments."""
        if self.cuts and len(text) <= SEGMENT and text[0] != " " and not _ODD.search(text):
            yield text.split(" ")
            return
        text = " " + text
        if not self.cuts:
            yield [text[1:]]
            return
        low = 0
        while low < len(text):
            cut = _CUT.search(text, max(low + SEGMENT, 1)) if low + SEGMENT < len(text) else None
            part = text[low : cut.start() if cut else len(text)]
            low += len(part)
            # The segment begins with its space, which never cuts it.
            at = [0, *(m.start() for m in _CUT.finditer(part) if m.start()), len(part)]
            yield [part[i + 1 : j] for i, j in zip(at, at[1:], strict=False)]

    def ids(self, words: list[str]) -> tuple[bytes, bytes] | None:
        """Ids of both sides as 32-bit numbers, or None if some word's bytes differ."""
        a, b = self.words_a, self.words_b
        try:
            return b"".join(map(a.__getitem__, words)), b"".join(map(b.__getitem__, words))
        except KeyError:
            pass
        if len(a) >= CACHED:
            a.clear()
            b.clear()
        missing = [w for w in set(words) if w not in a]
        for word, found in zip(missing, self.encoded(missing), strict=True):
            if found is None:
                return None
            a[word], b[word] = (array("I", x).tobytes() for x in found)
        return b"".join(map(a.__getitem__, words)), b"".join(map(b.__getitem__, words))


def byte_level(path: str) -> list[bytes]:
    """Bytes of every token of a byte-level vocabulary: printable bytes stand for themselves, the others for characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    alphabet = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    special = {t["id"]: t["content"].encode() for t in made["added_tokens"]}
    tokens = {i: bytes(alphabet[c] for c in t) for t, i in made["model"]["vocab"].items() if i not in special} | special
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def _names(count: int, last: str) -> tuple[np.ndarray, np.ndarray]:
    width = len(str(count)) + 1
    return np.array([f"{i}," for i in range(count)], f"S{width}"), np.array([f"{i}{last}" for i in range(count)], f"S{width}")


@lru_cache(2)
def coder(a: str, b: str) -> Coder:
    return Coder(a, b)


def _advance(longer: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each lane the first place from ``at`` on whose entry is not below ``wanted``; the last entry never is."""
    low, high, step = at, at, 1
    below = longer[high] < wanted
    while below.any():
        low = np.where(below, high + 1, low)
        high = np.where(below, np.minimum(high + step, len(longer) - 1), high)
        step *= 2
        below = longer[high] < wanted
    while (low < high).any():
        middle = (low + high) >> 1
        below = longer[middle] < wanted
        low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
    return low


def gallop(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Places in ``longer`` of the first entry not below each entry of ``shorter``; both rise, and end alike.

    The shorter list is dealt to lanes that are searched side by side; in a lane each search starts where the one before ended.
    """
    lanes = -(-len(shorter) // LANE)
    wanted = np.concatenate([shorter, np.repeat(shorter[-1:], lanes * LANE - len(shorter))]).reshape(lanes, LANE)
    out = np.empty((lanes, LANE), np.int64)
    at = np.zeros(lanes, np.int64)
    for k in range(LANE):
        at = _advance(longer, at, wanted[:, k])
        out[:, k] = at
    return out.ravel()[: len(shorter)]


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in either list of the entries that both hold."""
    if len(a) > len(b):
        return common(b, a)[::-1]
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = gallop(a, b)
    same = np.flatnonzero(b[place] == a)
    return same, place[same]


class Block:
    """Alignment of several segments end to end. ``at_a``, ``at_b`` and ``at_group`` are the places where segments begin and end.

    Group g holds the A tokens ``cuts_a[g]`` to ``cuts_a[g + 1]`` and the B tokens ``cuts_b[g]`` to ``cuts_b[g + 1]``. Segments
    have equal bytes on both sides, so their ends are common ends.
    """

    def __init__(self, made: Coder, parts: list[tuple[bytes, bytes]]):
        self.coder = made
        self.a, self.b = (np.frombuffer(b"".join([p[k] for p in parts]), np.uint32).astype(np.int64) for k in (0, 1))
        self.at_a, self.at_b = (np.cumsum([0, *(len(p[k]) // 4 for p in parts)]) for k in (0, 1))
        ends_a, ends_b = common(np.cumsum(made.length_a[self.a]), np.cumsum(made.length_b[self.b]))
        self.cuts_a, self.cuts_b = (np.concatenate([[0], x + 1]) for x in (ends_a, ends_b))
        self.at_group = np.searchsorted(self.cuts_a, self.at_a)
        self.size_a, self.size_b = np.diff(self.cuts_a), np.diff(self.cuts_b)
        self.links = self.size_a * self.size_b

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, id pair (A id times B's vocabulary, plus B id) and number of links, distinct and sorted."""
        count_b = len(self.coder.bytes_b)
        ids = len(self.coder.bytes_a) * count_b
        segment = np.repeat(np.arange(len(self.at_group) - 1), np.diff(self.at_group))
        plain = self.links <= EXPANDED
        group = np.repeat(np.arange(len(self.links)), self.size_a)
        chosen = plain[group]
        group = group[chosen]
        many = self.size_b[group]
        first = np.cumsum(many) - many
        other = np.arange(int(many.sum())) + np.repeat(self.cuts_b[group] - first, many)
        keys = np.repeat(segment[group] * ids + self.a[chosen] * count_b, many) + self.b[other]
        keys.sort()
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, links = keys[new], np.diff(np.append(new, len(keys)))
        if not plain.all():
            more_keys, more_links = [keys], [links]
            for g in np.flatnonzero(~plain):
                a, n_a = np.unique(self.a[self.cuts_a[g] : self.cuts_a[g + 1]], return_counts=True)
                b, n_b = np.unique(self.b[self.cuts_b[g] : self.cuts_b[g + 1]], return_counts=True)
                more_keys.append((segment[g] * ids + a[:, None] * count_b + b).ravel())
                more_links.append((n_a[:, None] * n_b).ravel())
            keys, links = _merged(np.concatenate(more_keys), np.concatenate(more_links))
        return *np.divmod(keys, ids), links

    def written(self) -> Iterator[bytes]:
        """Groups of each segment as ``a1,a2|b1;a3|b2,b3;``."""
        made = self.coder
        out = np.zeros(len(self.a) + len(self.b), max(made.names_a.dtype, made.names_b.dtype))
        place_a = np.arange(len(self.a)) + np.repeat(self.cuts_b[:-1], self.size_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.cuts_a[1:], self.size_b)
        out[place_a], out[place_b] = made.names_a[self.a], made.names_b[self.b]
        last_a, last_b = self.cuts_a[1:] - 1, self.cuts_b[1:] - 1
        out[place_a[last_a]], out[place_b[last_b]] = made.last_a[self.a[last_a]], made.last_b[self.b[last_b]]
        at = self.at_a + self.at_b
        for low, high in zip(at[:-1], at[1:], strict=True):
            yield out[low:high].tobytes().replace(b"\0", b"")


def _merged(keys: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(links, new) if len(new) else links


def blocks(made: Coder, texts: list[str | None]) -> Iterator[tuple[list[int], Block]]:
    """Blocks over the segments of all texts, each with the text that every segment is of; texts without tokens are passed over."""
    owners, parts, held = [], [], 0
    for k, text in enumerate(texts):
        found = [made.ids(words) for words in made.segments(text)] if text else [None]
        if None in found:
            continue
        for part in found:
            owners.append(k)
            parts.append(part)
            held += len(part[0])
            if held >= SEGMENT:
                yield owners, Block(made, parts)
                owners, parts, held = [], [], 0
    if parts:
        yield owners, Block(made, parts)


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``SEGMENT`` bytes of text, or one longer text."""
    for batch in batches:
        sizes = np.cumsum([0, *(len(t or "") for t in batch["text"].to_pylist())])
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + SEGMENT)))
            yield batch.slice(low, high - low)
            low = high


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat).cast(kind))


def _paths(a: str | None, b: str | None) -> tuple[str, str]:
    return a or tokenizer_file("byte_bpe_50k.json"), b or tokenizer_file("piece_bpe_32k.model")


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """``row``, ``doc_id``, ids of both sides (``a_ids``, ``b_ids``) and the ranks at which groups end (``a_ends``, ``b_ends``).

    A reads a space and the text, B the text; special strings are ordinary text. Texts that are null, empty, or whose bytes are not
    those of their tokens have empty lists. Repeated rows have rows of their own; other columns are ignored. ``docs`` is a table that is read.
    """
    paths = _paths(a, b)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _windows(batches):
            out = [[[np.zeros(0, np.int64)] for _ in range(batch.num_rows)] for _ in range(4)]
            ranks = np.zeros((batch.num_rows, 2), np.int64)
            for owners, block in blocks(coder(*paths), batch["text"].to_pylist()):
                for k, owner in enumerate(owners):
                    for side, (ids, at, cuts) in enumerate(((block.a, block.at_a, block.cuts_a), (block.b, block.at_b, block.cuts_b))):
                        out[side][owner].append(ids[at[k] : at[k + 1]])
                        ends = cuts[block.at_group[k] + 1 : block.at_group[k + 1] + 1]
                        out[2 + side][owner].append(ends - at[k] + ranks[owner, side])
                        ranks[owner, side] += at[k + 1] - at[k]
            lists = [_lists([np.concatenate(x) for x in column], pa.int32()) for column in out]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], *lists], ["row", "doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    source = numbered(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends"))
    return source.mapInArrow(apply, f"row long, doc_id {kind}, {lists}")


_DIGESTS = ("n_a", "n_b", "n_groups", "n_links")


def linked(docs: DataFrame, paths: tuple[str, str], pair: str, piece: int) -> DataFrame:
    """Digests of each document's groups, and its distinct id pairs with their numbers of links in rows (``part``) of at most ``piece``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(*paths)
        for batch in _windows(batches):
            n = batch.num_rows
            totals = np.zeros((n, 4), np.int64)
            shas = [hashlib.sha256() for _ in range(n)]
            open_ends = [b""] * n
            found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
            for owners, block in blocks(made, batch["text"].to_pylist()):
                places = np.array(owners)
                links = np.append(np.cumsum(block.links) - block.links, block.links.sum())[block.at_group]
                for column, at in enumerate((block.at_a, block.at_b, block.at_group, links)):
                    np.add.at(totals[:, column], places, np.diff(at))
                for owner, text in zip(owners, block.written(), strict=True):
                    shas[owner].update(open_ends[owner] + text[:-1])
                    open_ends[owner] = b";"
                segment, codes, counts = block.pairs()
                at = np.searchsorted(segment, np.arange(len(owners) + 1))
                for k, owner in enumerate(owners):
                    found[owner].append((codes[at[k] : at[k + 1]], counts[at[k] : at[k + 1]]))
            rows, parts, pairs, counts = [], [], [], []
            for k, own in enumerate(found):
                codes, links = own[0] if len(own) == 1 else _merged(*(np.concatenate([x[i] for x in own] or [np.zeros(0, np.int64)]) for i in (0, 1)))
                for part, low in enumerate(range(0, max(len(codes), 1), piece)):
                    rows.append(k)
                    parts.append(part)
                    pairs.append(codes[low : low + piece])
                    counts.append(links[low : low + piece])
            taken = pa.array(rows)
            digests = [pa.array(totals[rows, c]) for c in range(4)] + [pa.array([shas[k].hexdigest() if totals[k, 0] else "" for k in rows], pa.string())]
            lists = [_lists(pairs, pa.int32() if pair == "int" else pa.int64()), _lists(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch["row"].take(taken), batch["doc_id"].take(taken), pa.array(parts, pa.int32()), *digests, *lists],
                ["row", "doc_id", "part", *_DIGESTS, "groups_sha256", "pairs", "links"],
            )

    source = numbered(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    digests = ", ".join(f"{c} long" for c in _DIGESTS)
    return source.mapInArrow(apply, f"row long, doc_id {kind}, part int, {digests}, groups_sha256 string, pairs array<{pair}>, links array<long>")


def pair_counts(links: DataFrame, count_b: int) -> DataFrame:
    """``pair``, the documents that hold it linked, and whether no other pair of its A id has more."""
    counts = saved(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "counts")
    side = F.floor(F.col("pair") / count_b).cast("int").alias("a")
    most = counts.groupBy(side).agg(F.max("docs").alias("most"))  # no more rows than A has ids
    return counts.withColumn("a", side).join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, known: int) -> int:
    """The lowest power of two such that no more than ``known`` pairs are in so many documents."""
    level = F.floor(F.log2("docs")).cast("int").alias("level")
    total = 0
    for level, n in sorted(counts.groupBy(level).agg(F.count("*")).collect(), reverse=True):
        total += n
        if total > known:
            return 1 << (level + 1)
    return 1


def _looked_up(table) -> object:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = table.value
        for batch in batches:
            pairs, links = batch["pairs"].flatten().to_numpy(), batch["links"].flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), batch["pairs"].value_lengths().to_numpy())
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            place, weight = place[hit], links[hit]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], owner[hit], weight * best[place])
            np.add.at(sums[1], owner[hit], weight * docs[place])
            at = pa.array(np.append(0, np.cumsum(np.bincount(owner[~hit], minlength=batch.num_rows))), pa.int32())
            rest = [pa.ListArray.from_arrays(at, pa.array(x[~hit])) for x in (pairs, links)]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(sums[0]), pa.array(sums[1]), *rest], ["row", "n_best", "count_sum", "pairs", "links"])

    return apply


def link_counts(docs: DataFrame, a: str | None = None, b: str | None = None, known: int = KNOWN, piece: int = PIECE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, row.

    ``n_best`` counts the links whose id pair no other pair of the same A id exceeds in documents, ties included; ``count_sum`` adds up the
    documents of the pairs of all links. Texts without tokens (see ``align``) have zeros and an empty ``groups_sha256``. Repeated rows and
    null ids count as documents of their own; an empty table gives an empty result; other columns are ignored.
    """
    paths = _paths(a, b)
    spark = docs.sparkSession
    made = coder(*paths)
    count_a, count_b = len(made.bytes_a), len(made.bytes_b)
    pair = "int" if count_a * count_b < 1 << 31 else "long"
    links = saved(linked(docs, paths, pair, piece), "links")
    counts = pair_counts(links, count_b)
    least = _frequent(counts, known)
    table = counts.where(F.col("docs") >= least).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "docs", "best")))
    schema = f"row long, n_best long, count_sum long, pairs array<{pair}>, links array<long>"
    first = saved(links.select("row", "pairs", "links").mapInArrow(_looked_up(shared), schema), "looked_up")
    rest = first.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p"))
    rare = counts.where(F.col("docs") < least)
    joined = rest.select("row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")).join(rare, "pair")
    later = joined.select("row", F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("docs")).alias("count_sum"))
    sums = first.select("row", "n_best", "count_sum").union(later).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = links.where("part = 0").select("row", "doc_id", *_DIGESTS, "groups_sha256")
    return own.join(sums, "row").select("doc_id", *_DIGESTS, "n_best", "count_sum", "groups_sha256", "row")
