"""Documents packed into sequences of a fixed number of tokens: bin completion with best-fit incumbents.

Pieces of documents are dealt at random into groups of about ``GROUP`` pieces; each group is packed on its own, so no task sees more
than that, and at most a part of one sequence per group is lost against packing all at once. In a group, best-fit decreasing gives
the first incumbent. If it is above the lower bound, a branch-and-bound search fills the bin of the largest open piece with every
filling that no other dominates, drops branches whose waste would reach the incumbent's, and stops at the bound or its budget.
A search spends a node on every bin, so one over all bins of a large group would end before its first packing. It therefore takes
up ``SEARCHED`` bins, those with the most room and those of the most pieces, and keeps the others as best-fit made them.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import saved
from litmark.llm.tokens import ids, tokenizer_file

TOKENS, END = 1024, 2
GROUP = 50_000
# Search budget of a group: nodes visited, and fillings listed for a node. It bounds time; every piece is packed in any case.
NODES, FILLINGS = 3_000, 64
# Bins of a group that one search takes up, then the next; NODES is several times as many, so whole packings of them are reached.
SEARCHED = (300, 600)


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of ``most`` tokens, but the first may be shorter."""
    first = total % most or min(total, most)
    starts = [0, *range(first, total, most)]
    return [(s, first if not s else most) for s in starts]


def _piece_rows(path: str, most: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                made = memoryview(ids(path, text or "") + tail)
                for piece, (start, length) in enumerate(cut(len(made) // 4, most)):
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(made[4 * start : 4 * (start + length)]))
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return rows


def lower_bound(counts: list[int], most: int) -> int:
    """No packing needs fewer bins: total size, or pieces too large to share a bin plus what their bins cannot take."""
    sizes = np.arange(most + 1)
    c = np.array(counts)
    best = -(-int((c * sizes).sum()) // most)
    for k in range(1, most // 2 + 1):
        if not c[k]:
            continue
        large, middle, small = c[most - k + 1 :].sum(), c[most // 2 + 1 : most - k + 1], c[k : most // 2 + 1]
        free = most * middle.sum() - (middle * sizes[most // 2 + 1 : most - k + 1]).sum()
        over = (small * sizes[k : most // 2 + 1]).sum() - free
        best = max(best, int(large + middle.sum() + max(0, -(-over // most))))
    return max(best, int(c[most // 2 + 1 :].sum()))


def best_fit(counts: list[int], most: int) -> list[list[int]]:
    """Bins of sizes by best-fit decreasing. Bit r of ``open_rooms`` says that some bin has room r."""
    bins: list[list[int]] = []
    rooms: list[list[int]] = [[] for _ in range(most + 1)]
    open_rooms = 0
    for size in range(most, 0, -1):
        for _ in range(counts[size]):
            fitting = open_rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                own = rooms[room].pop()
                if not rooms[room]:
                    open_rooms &= ~(1 << room)
                bins[own].append(size)
                left = room - size
            else:
                own, left = len(bins), most - size
                bins.append([size])
            if left:
                rooms[left].append(own)
                open_rooms |= 1 << left
    return bins


def fillings(counts: list[int], room: int, waste: int, limit: int) -> list[tuple[int, array]]:
    """(room left, sizes) of the undominated ways to fill ``room`` with at most ``waste`` left, fullest first.

    A filling is dominated if another piece still fits, or if one of its pieces can be swapped for a larger one that fits: the
    other filling is then at least as good, as the smaller piece fits wherever the larger one would have gone.
    """
    found: list[tuple[int, array]] = []
    present = 0
    for size in range(1, room + 1):
        if counts[size]:
            present |= 1 << size
    steps = 40 * limit
    # A way so far: rest, sizes of which one is left (as bits), last size taken and how often, and all taken as a chain that ways share.
    way: tuple[int, int, int, int, tuple | None] = (room, present, room, 0, None)
    # Ways with the sizes, none above their last, that are still to be tried as the next piece; the largest comes first.
    stack: list[tuple[tuple[int, int, int, int, tuple | None], int]] = []
    while steps and len(found) < limit:
        steps -= 1
        rest, spare, last, _, link = way
        if spare & ((2 << rest) - 1):
            usable = spare & ((2 << min(rest, last)) - 1)
            if usable:
                stack.append((way, usable))
        elif rest <= waste:
            sizes = []
            while link:
                sizes.append(link[0])
                link = link[1]
            if not any((spare >> (size + 1)) & ((1 << rest) - 1) for size in set(sizes)):
                found.append((rest, array("H", sizes)))
        if not stack:
            break
        before, usable = stack.pop()
        rest, spare, last, run, chain = before
        size = usable.bit_length() - 1
        usable ^= 1 << size
        if usable:
            stack.append((before, usable))
        run = run + 1 if size == last else 1
        if counts[size] <= run:
            spare ^= 1 << size
        way = (rest - size, spare, size, run, (size, chain))
    return sorted(found, key=lambda f: f[0])


def complete(counts: list[int], most: int, nodes: int = NODES, limit: int = FILLINGS) -> list[list[int]]:
    """Bins of sizes for ``counts[size]`` pieces of each size: best-fit decreasing, and searches over a part of its bins."""
    best = best_fit(counts, most)
    bound = lower_bound(counts, most)
    for width in SEARCHED:
        if len(best) <= bound:
            break
        # Room to gain is in the emptiest bins, and small pieces to fill it with in those of the most pieces.
        best.sort(key=sum)
        rest = sorted(best[width // 2 :], key=len, reverse=True)
        few = width - width // 2
        best = search(best[: width // 2] + rest[:few], most, nodes, limit) + rest[few:]
        if len(rest) <= few:
            break
    return best


def search(best: list[list[int]], most: int, nodes: int = NODES, limit: int = FILLINGS) -> list[list[int]]:
    """The pieces of the bins ``best`` in fewer bins, if a search of at most ``nodes`` nodes finds such a packing."""
    counts = np.bincount([size for sizes in best for size in sizes], minlength=most + 1).tolist()
    bound = lower_bound(counts, most)
    total = sum(size * n for size, n in enumerate(counts))
    left = list(counts)
    chosen: list[list[int]] = []
    frames: list[tuple[list, int]] = []

    def largest() -> int:
        return next((size for size in range(most, 0, -1) if left[size]), 0)

    def expand(waste: int) -> None:
        size = largest()
        left[size] -= 1
        allowed = (len(best) - 1) * most - total - waste
        ways = fillings(left, most - size, allowed, limit)[::-1] if allowed >= 0 else []
        left[size] += 1
        frames.append(([(rest, array("H", (size, *sizes))) for rest, sizes in ways], waste))

    if len(best) > bound:
        expand(0)
    while frames and nodes and len(best) > bound:
        ways, waste = frames[-1]
        if len(chosen) == len(frames):
            for size in chosen.pop():
                left[size] += 1
        if not ways:
            frames.pop()
            continue
        rest, sizes = ways.pop()
        if (len(best) - 1) * most - total < waste + rest:
            continue
        nodes -= 1
        for size in sizes:
            left[size] -= 1
        chosen.append(list(sizes))
        if not largest():
            if len(chosen) < len(best):
                best = [list(b) for b in chosen]
            for size in chosen.pop():
                left[size] += 1
            continue
        expand(waste + rest)
    return best


def place(lengths: np.ndarray, most: int, **budget) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Whole pieces fill bins of their own; the others go through the search."""
    order = np.argsort(-lengths, kind="stable")
    counts = np.bincount(lengths, minlength=most + 1).tolist()
    full = counts[most]
    counts[most] = 0
    bins = [[most]] * full + complete(counts, most, **budget)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    first = np.searchsorted(-lengths[order], -np.arange(most + 1), "left").tolist()
    for own, sizes in enumerate(bins):
        at = 0
        for size in sizes:
            item = order[first[size]]
            first[size] += 1
            number[item], offset[item] = own, at
            at += size
    return number, offset


def _pack_group(most: int):
    def pack(table: pa.Table) -> pa.Table:
        number, offset = place(table["length"].to_numpy(), most)
        sequence = table["pack"].to_numpy() * (1 << 36) + number
        return table.drop_columns(["pack"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return pack


def pack(docs: DataFrame, most: int = TOKENS, end: int = END, path: str | None = None, group: int = GROUP) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``most`` is below 65,536.

    A document is its token ids and ``end``; null and empty texts are that one token. Repeated rows are packed each on their own.
    Longer documents are cut into pieces of ``most`` tokens, of which the first may be shorter. Other columns are ignored; an
    empty table gives an empty result.
    """
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = saved(source.mapInArrow(_piece_rows(path or tokenizer_file(), most, end), shape), "pieces")
    groups = -(-max(pieces.count(), 1) // group)
    # The place of a row in the written table, hashed: repeated rows spread over the groups like all others.
    dealt = pieces.withColumn("pack", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups).cast("long")))
    return dealt.groupBy("pack").applyInArrow(_pack_group(most), shape + ", sequence_id long, offset long")
