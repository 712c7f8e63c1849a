"""Token counts and ids with a public tokenizer, by pieces that are looked up instead of encoded.

A space that is followed by something other than white space always begins a pre-token of a byte-level tokenizer, so a text can be
cut there and each piece encoded on its own. Lengths of pieces that are one token of the vocabulary come from a broadcast table no larger
than the vocabulary; all others from a bounded cache of the Python worker, which is filled by the tokenizer. Nothing is learned from the
texts, so they are read once and their pieces are not shuffled. Callers may ask for a table of the pieces that are most frequent in all rows.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmark.llm.common import flat

#: Pieces that a worker remembers; past that it starts anew. At about 150 bytes each, well below 100 MB.
CACHED = 400_000
#: Entries of a table of frequent pieces (some 15 MB in a worker).
FREQUENT = 100_000
# Longer pieces are encoded without being remembered.
LONGEST = 64
_SPECIAL = "<|"
# White space, and characters that some Unicode version calls white space.
_WHITE = r"[\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2060\ufeff]"
# A space that ends a text or stands before white space; and the place before any other space.
_ODD = re.compile(rf" (?={_WHITE}|$)")
_CUT = re.compile(rf"(?= (?!{_WHITE}|\Z))")
# Characters that the two encoders split alike.
_PLAIN = re.compile(r"[\x00-\x1b -\x84\x86-\xff]*\Z")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(4)
def fast(path: str):
    """The same vocabulary as ranks, where its file lies beside; it encodes plain Latin text alike and several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    with open(path) as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"] if t["special"]}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> np.ndarray:
    """Ids of a whole text as the tokenizers library gives them, special strings found inside the text included."""
    if not _PLAIN.match(text):
        return np.array(load(path).encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast(path).encode(text, allowed_special="all"), "<u4")


def pieces(text: str) -> list[str] | None:
    """The text cut before every space that begins a pre-token; None if it may hold special strings."""
    if _SPECIAL in text:
        return None
    if _ODD.search(text):
        return [part for part in _CUT.split(text) if part]
    first, *rest = text.split(" ")
    parts = [" " + x for x in rest]
    return [first, *parts] if first else parts


def vocabulary_lengths(path: str) -> dict[str, int]:
    """Pieces that are one token of the vocabulary, with their length 1: a table no larger than the vocabulary."""
    tokenizer = load(path)
    texts = [t for t in tokenizer.decode_batch([[i] for i in range(tokenizer.get_vocab_size())], skip_special_tokens=False)]
    plain = [t for t in set(texts) if t and "�" not in t and " " not in t[1:] and _SPECIAL not in t and not _ODD.search(t) and len(t.strip()) > 0]
    return {t: 1 for t in plain if len(encode(path, t)) == 1}


def frequent_lengths(docs: DataFrame, text: Column, path: str, most: int = FREQUENT) -> dict[str, int]:
    """The most frequent pieces of ``text``, counted over all rows of ``docs``, with their numbers of tokens."""
    # Cut as ``pieces`` does; pieces that it would cut further are in no table.
    cut = docs.select(F.explode(F.split(text, r"(?= \S)")).alias("piece")).where(F.length("piece").between(1, LONGEST))
    top = cut.groupBy("piece").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "piece").limit(most)
    found = [r.piece for r in top.select("piece").collect()]
    return {p: len(encode(path, p)) for p in found if pieces(p) == [p]}


_LENGTHS: dict[str, dict[str, int]] = {}


def count(path: str, table: dict[str, int], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text; null counts as empty."""
    cache = _LENGTHS.setdefault(path, {})
    ordinary = fast(path).encode_ordinary
    _, at = flat(texts)
    tokens = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        parts = pieces(text)
        if parts is None:
            tokens[i] = len(encode(path, text))
            continue
        total = 0
        for part in parts:
            n = table.get(part) or cache.get(part)
            if n is None:
                n = len(ordinary(part) if _PLAIN.match(part) else encode(path, part))
                if len(part) <= LONGEST:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[part] = n
            total += n
        tokens[i] = total
    return np.diff(at), tokens


_IDS: dict[str, dict[str, bytes]] = {}


def ids(path: str, text: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    if _PLAIN.match(text):
        coder = fast(path)
        return array("I", coder.encode(text, allowed_special="all") if _SPECIAL in text else coder.encode_ordinary(text)).tobytes()
    parts = pieces(text)
    if parts is None:
        return encode(path, text).tobytes()
    cache = _IDS.setdefault(path, {})
    out = list(map(cache.get, parts))
    for i, known in enumerate(out):
        if known is None:
            part = parts[i]
            out[i] = encode(path, part).tobytes()
            if len(part) <= LONGEST:
                if len(cache) >= CACHED:
                    cache.clear()
                cache[part] = out[i]
    return b"".join(out)


def token_counts(spark: SparkSession, text: Column, path: str | None = None, docs: DataFrame | None = None) -> Column:
    """Struct (n_bytes, n_tokens) of a text column. Null counts as the empty text: no bytes, no tokens.

    The table of known pieces is the tokenizer's vocabulary. With ``docs``, the table that the column is of, it holds the frequent pieces of
    all its rows instead, which costs a pass over them; the counts are the same.
    """
    path = path or tokenizer_file()
    shared = spark.sparkContext.broadcast(vocabulary_lengths(path) if docs is None else frequent_lengths(docs, text, path))

    @F.arrow_udf("n_bytes long, n_tokens long")
    def apply(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in count(path, shared.value, texts)], ["n_bytes", "n_tokens"])

    return apply(text)
