"""Benchmark items in documents: CGK random-walk embedding, bit-sampling LSH over item-sized windows, exact edit check.

Texts are word sequences. A random walk over a sequence writes the word it stands on at every step and moves on by a random bit
of (step, word); edits become mismatches of the written sequences. One walk from every word of a document serves windows of all
sizes, as an item of n words is compared on its first ``STEPS_PER_WORD`` * n steps. Windows of an item begin at several of its
words. ``REPEATS`` samples of ``SAMPLED`` steps for each size class are looked up in tables of the items' keys. What meets is
compared with the whole item by edit distance, so a reported hit is always within ``MOST_EDITS`` of the item's words. Verbatim
copies are always found; at the threshold of two edits in ten words the tests ask for a recall of 0.9. Items of fewer than
``LEAST_WORDS`` words allow no edit and are looked up whole. In scripts without spaces every character is a word.

Items are a stated query set: they are taken in blocks of ``BLOCK_ITEMS``, and a block is what the tasks get.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import flat

MOST_EDITS = 0.2
# Items of fewer words allow no edit; they are looked up whole, by the hash of all their words.
LEAST_WORDS = 5
# Longer items are looked for in parts of this many words; the check is on the whole item.
PART = 64
# A walker makes at most one word a step, so with no more steps than words it stays inside a verbatim copy.
STEPS_PER_WORD = 1
# Windows of an item begin at these shares of it, as an early edit spoils the walk from its first word.
STARTS = (0, 1 / 6, 1 / 3, 1 / 2)
SAMPLED, REPEATS, WALKS = 3, 8, 1
BLOCK_ITEMS = 5_000
STRETCH = 1 << 18
_GROWTH = 1.7
_WORD = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256))))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


# Code points of scripts written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han with its extensions).
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x3FFFF))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces begin and end."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return lead, lead
    size = np.where(data[lead] >= 0xF0, 4, 3)
    point = np.where(size == 3, data[lead] & 15, data[lead] & 7).astype(np.int64)
    for k in (1, 2, 3):
        follow = data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 63
        point = np.where(k < size, point << 6 | follow, point)
    own = np.zeros(len(lead), bool)
    for low, high in _UNSPACED:
        own |= (low <= point) & (point <= high)
    return lead[own], (lead + size)[own]


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (runs of ASCII letters and digits and of other than ASCII bytes, A-Z lowered; single characters of
    scripts without spaces), and the places in that list where each text begins and ends."""
    inside = _WORD[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = at[:-1][at[:-1] < at[1:]]
    begin[firsts] = inside[firsts]
    single, behind = _unspaced(data)
    begin[single] = True
    behind = behind[behind < len(data)]
    begin[behind] |= inside[behind]
    starts = np.flatnonzero(begin)
    bounds = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    run = np.cumsum(begin) - 1
    place = (np.arange(len(data)) - starts[np.maximum(run, 0)]).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (_LOWER[data] + np.uint64(1)) * (place * np.uint64(2) + np.uint64(1)) * _FACTOR
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed[~inside] = 0
        hashed = np.add.reduceat(mixed, starts)
        hashed ^= hashed >> np.uint64(30)
        hashed *= np.uint64(0x94D049BB133111EB)
        hashed ^= hashed >> np.uint64(31)
    return hashed, bounds


def edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and that stretch (start, end)."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1)
    steps = np.arange(n + 1)
    for i, word in enumerate(item):
        swap = cost[:-1] + (text != word)
        drop = cost + 1
        new, source = drop.copy(), origin.copy()
        better = swap < new[1:]
        new[1:][better] = swap[better]
        source[1:][better] = origin[:-1][better]
        # Insertions: the best of all earlier cells plus their distance, as a running minimum.
        lowest = np.minimum.accumulate(new - steps)
        reach = np.maximum.accumulate(np.where(new - steps == lowest, steps, 0))
        source = np.where(lowest + steps < new, source[reach], source)
        cost, origin = np.minimum(new, lowest + steps), source
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


@dataclass(frozen=True)
class Index:
    """Items as hashed words, and for each walk, size class and repeat the sorted keys of the parts and a bitmap of them.

    ``short`` has the items below ``LEAST_WORDS`` by their number of words: sorted keys of all their words, and the items.
    """

    ids: list
    items: list
    distinct: list[set[int]]
    parts: list[tuple[int, int]]
    classes: list
    steps: int
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def _whole_keys(words: np.ndarray, n: int) -> np.ndarray:
    """A key of every ``n`` neighbouring words."""
    with np.errstate(over="ignore"):
        return sum((words[k : len(words) - n + 1 + k] * (_FACTOR + np.uint64(2 * k)) for k in range(n)), np.zeros(max(len(words) - n + 1, 0), np.uint64))


def _class(n: int) -> int:
    size = LEAST_WORDS
    while size * _GROWTH <= n:
        size = int(size * _GROWTH) if size * _GROWTH >= size + 1 else size + 1
    return size


def _factors(walk: int, steps: int) -> np.ndarray:
    return np.random.default_rng((91, walk)).integers(0, 2**31, steps, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _walk(words: np.ndarray, count: int, walk: int, steps: int):
    """The word (upper half of its hash) under each walker at every step; walkers start on the first ``count`` words.

    ``words`` must hold ``steps`` more words behind them. What is handed out is overwritten by the next step.
    """
    words = (words >> np.uint64(32)).astype(np.uint32)
    place = np.arange(count)
    here, bit = np.empty(count, np.uint32), np.empty(count, np.uint32)
    for factor in _factors(walk, steps):
        np.take(words, place, out=here, mode="clip")
        yield here
        np.multiply(here, factor, out=bit)
        np.right_shift(bit, np.uint32(31), out=bit)
        np.add(place, bit, out=place)


def build(ids: list, texts: list[str | None]) -> Index:
    """Search tables of the items; items without words are in none."""
    items, kept, parts = [], [], []
    whole: dict[int, list[tuple[int, int]]] = {}
    for own, text in zip(ids, texts, strict=True):
        raw = (text or "").encode()
        words, _ = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if not len(words):
            continue
        if len(words) < LEAST_WORDS:
            whole.setdefault(len(words), []).append((int(_whole_keys(words, len(words))[0]), len(items)))
            items.append(words)
            kept.append(own)
            continue
        pieces = -(-len(words) // PART)
        for k in range(pieces):
            a, b = k * len(words) // pieces, (k + 1) * len(words) // pieces
            for start in sorted({a + int((b - a) * share) for share in STARTS}):
                if b - start >= min(LEAST_WORDS, b - a):
                    parts.append((len(items), start, b))
        items.append(words)
        kept.append(own)
    sizes = sorted({_class(b - a) for _, a, b in parts})
    steps = int(max(sizes, default=0) * STEPS_PER_WORD)
    classes = []
    rng = np.random.default_rng(7)
    written = {}
    for walk in range(WALKS):
        for k, (item, a, b) in enumerate(parts):
            padded = np.concatenate([items[item][a:b], np.zeros(steps + 1, np.uint64)])
            written[walk, k] = np.array([h[0] for h in _walk(padded, 1, walk, steps)], np.uint32)
        for size in sizes:
            own = [k for k, (_, a, b) in enumerate(parts) if _class(b - a) == size]
            for _ in range(REPEATS // WALKS):
                # One step from each part of the walk: near ones would often stand on the same word.
                edges = np.linspace(0, size * STEPS_PER_WORD, SAMPLED + 1).astype(int)
                chosen = np.array([rng.integers(x, y) for x, y in zip(edges[:-1], edges[1:], strict=True)])
                factors = rng.integers(0, 2**31, SAMPLED, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
                with np.errstate(over="ignore"):
                    keys = np.array([(written[walk, k][chosen] * factors).sum(dtype=np.uint32) for k in own], np.uint32)
                order = np.argsort(keys, kind="stable")
                bitmap = np.zeros(1 << 16, bool)
                bitmap[keys >> np.uint32(16)] = True
                classes.append((walk, dict(zip(chosen.tolist(), factors, strict=True)), keys[order], np.array(own)[order], bitmap))
    short = {n: (np.array([k for k, _ in sorted(own)], np.uint64), np.array([i for _, i in sorted(own)])) for n, own in whole.items()}
    return Index(kept, items, [set(w.tolist()) for w in items], [(i, a) for i, a, _ in parts], classes, steps, short)


def short_hits(index: Index, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], int]:
    """First place of every short item in every text that holds it, by (text, item)."""
    found: dict[tuple[int, int], int] = {}
    for n, (keys, own) in index.short.items():
        made = _whole_keys(words, n)
        places = np.flatnonzero(np.isin(made, keys))
        text = np.searchsorted(bounds, places, "right") - 1
        inside = places + n <= bounds[text + 1]
        places, text = places[inside], text[inside]
        # Of equal keys in one text only the first place is looked at.
        _, first = np.unique(np.column_stack([text.astype(np.uint64), made[places]]), axis=0, return_index=True)
        for k in first.tolist():
            place = int(places[k])
            for item in own[np.searchsorted(keys, made[place], "left") : np.searchsorted(keys, made[place], "right")].tolist():
                if (index.items[item] == words[place : place + n]).all():
                    found[int(text[k]), item] = place
    return found


def candidates(index: Index, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word place, part) pairs whose keys meet in some table, without repeats."""
    padded = np.concatenate([words, np.zeros(index.steps + 1, np.uint64)])
    places, owners = [], []
    for walk in range(WALKS):
        tables = [t for t in index.classes if t[0] == walk]
        made = [np.zeros(len(words), np.uint32) for _ in tables]
        part = np.empty(len(words), np.uint32)
        sampled: dict[int, list] = {}
        for table, key in zip(tables, made, strict=True):
            for step, factor in table[1].items():
                sampled.setdefault(step, []).append((key, factor))
        for step, here in enumerate(_walk(padded, len(words), walk, index.steps)):
            for key, factor in sampled.get(step, ()):
                np.multiply(here, factor, out=part)
                np.add(key, part, out=key)
        for (_, _, keys, own, bitmap), key in zip(tables, made, strict=True):
            maybe = np.flatnonzero(bitmap[key >> np.uint32(16)])
            low = np.searchsorted(keys, key[maybe], "left")
            high = np.searchsorted(keys, key[maybe], "right")
            count = high - low
            some = count > 0
            if some.any():
                each = count[some]
                places.append(np.repeat(maybe[some], each))
                owners.append(own[np.repeat(low[some] - np.append(0, each.cumsum()[:-1]), each) + np.arange(each.sum())])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.column_stack([np.concatenate(places), np.concatenate(owners)]), axis=0)
    return both[:, 0], both[:, 1]


def hits(index: Index, texts: pa.Array) -> list[list[dict]]:
    """For each text its items: {item, start, words, edits}, the best place of each, ordered by item."""
    data, at = flat(texts)
    out: list[list[dict]] = [[] for _ in range(len(at) - 1)]
    low = 0
    while low < len(out) and index.items:
        high = max(low + 1, int(np.searchsorted(at, at[low] + STRETCH, "right")) - 1)
        words, bounds = word_hashes(data[at[low] : at[high]], at[low : high + 1] - at[low])
        best: dict[tuple[int, int], tuple[int, int, int]] = {
            (doc, own): (0, place - int(bounds[doc]), len(index.items[own])) for (doc, own), place in short_hits(index, words, bounds).items()
        }
        done: dict[tuple[int, int], tuple[int, int]] = {}
        places, parts = candidates(index, words)
        docs, edges = np.searchsorted(bounds, places, "right") - 1, bounds.tolist()
        for place, part, doc in zip(places.tolist(), parts.tolist(), docs.tolist(), strict=True):
            own, offset = index.parts[part]
            item = index.items[own]
            slack = int(len(item) * MOST_EDITS) + 1
            begin = max(edges[doc], place - offset - 2 * slack)
            end = min(edges[doc + 1], place - offset + len(item) + 2 * slack)
            # Neighbouring candidates of an item share one check where it covered the same words.
            before = done.get((doc, own), (0, -1))
            if before[0] <= begin and end <= before[1]:
                continue
            text = words[begin:end]
            # Every edit takes away one distinct word of the item at most.
            distinct = index.distinct[own]
            if len(distinct) - len(distinct.intersection(text.tolist())) > len(item) * MOST_EDITS:
                continue
            done[doc, own] = (begin, end)
            cost, a, b = edits(item, text)
            if cost <= len(item) * MOST_EDITS:
                found = (cost, begin + a - int(bounds[doc]), b - a)
                best[doc, own] = min(best.get((doc, own), found), found)
        for (doc, own), (cost, start, length) in sorted(best.items()):
            out[low + doc].append({"item": own, "start": start, "words": length, "edits": cost})
        low = high
    return out


def _shape(kind: str) -> str:
    return f"array<struct<item_id:{kind},start:long,words:long,edits:long,item_words:long>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, name: str = "leaks") -> DataFrame:
    """``docs`` with all columns and one more, ``name``: an array of the items (item_id, start, words, edits, item_words) it holds.

    ``benchmark`` has item_id and text. Items that repeat are reported each on its own; null and empty texts hold nothing and
    are found nowhere. No row is shuffled.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    ordered = benchmark.select("item_id", "text").orderBy("item_id", "text")
    out = docs.withColumn(name, F.array().cast(_shape(kind)))
    total = benchmark.count()
    for low in range(0, total, BLOCK_ITEMS):
        block = ordered.offset(low).limit(BLOCK_ITEMS).collect()
        index = build([r.item_id for r in block], [r.text for r in block])
        out = out.withColumn(name, F.concat(name, _find(docs.sparkSession, index, kind)(docs["text"])))
    return out


def _find(spark, index: Index, kind: str):
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf(_shape(kind))
    def find(texts: pa.Array) -> pa.Array:
        own = shared.value
        rows = [
            [{"item_id": own.ids[h["item"]], "start": h["start"], "words": h["words"], "edits": h["edits"], "item_words": len(own.items[h["item"]])} for h in found]
            for found in hits(own, texts)
        ]
        number = pa.int64() if kind == "bigint" else None
        first = pa.array([x["item_id"] for r in rows for x in r]).type if any(rows) else None
        item = number or first or pa.string()
        fields = [("item_id", item), *[(n, pa.int64()) for n in ("start", "words", "edits", "item_words")]]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    return find


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    name = "_leaks"
    while name in docs.columns:
        name = "_" + name
    return with_leaks(docs, benchmark, name).where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
