"""Language of a text: unigram pieces of a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every piece of a public vocabulary. A word's probability is the sum over all ways to cut it
into pieces, by a forward pass for all languages at once; a text is the product of its words. The probabilities are fitted by
expectation and maximisation over word counts of labelled documents: the expected counts come from forward and backward passes in
Spark tasks, and what reaches the driver is one number per piece and language.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from litmark.llm.common import saved

# At most so many labelled documents of a language are fitted on, those with the lowest hash of their id.
LABELLED_ROWS = 1_000
# Languages that are learned, those with the most labelled documents, so that the table of probabilities has a fixed size.
LANGUAGES = 256
DEALT = 64
ROUNDS, ADDED = 2, 0.1
# Longer words are taken in stretches of this many letters, which keeps the sums within a double.
LONGEST = 32
CACHED_NUMBERS = 2_000_000
# Texts whose new words are scored together.
TOGETHER = 64
BEGIN = "▁"
_WORDS, _ASCII_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*"), re.compile("[a-z]+")


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def vocabulary(path: str) -> dict[str, int]:
    """Number of each piece that is letters, with or without the mark of a word's begin, lower-cased; 0 stands for any other letter."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    letters = sorted(p for p in pieces if p == BEGIN or regex.fullmatch(r"[\p{L}\p{M}]+", p.removeprefix(BEGIN)))
    return {p: i for i, p in enumerate(letters, 1)}


@lru_cache(4)
def _beginnings(path: str) -> frozenset[str]:
    """All beginnings of pieces: a search stops where no piece goes on."""
    return frozenset(p[:k] for p in vocabulary(path) for k in range(1, len(p) + 1))


def words(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    lower = text.lower()
    return _ASCII_WORDS.findall(lower) if lower.isascii() else _WORDS.findall(lower)


def arcs(path: str, word: str) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (begin, end, number) of each stretch of a word, ordered by begin. A letter that no piece covers is piece 0."""
    known, beginnings = vocabulary(path), _beginnings(path)
    for low in range(0, len(word), LONGEST):
        part = (BEGIN if low == 0 else "") + word[low : low + LONGEST]
        found = []
        for i in range(len(part)):
            single = False
            for j in range(i + 1, len(part) + 1):
                piece = part[i:j]
                if piece not in beginnings:
                    break
                number = known.get(piece)
                if number is not None:
                    found.append((i, j, number))
                    single |= j == i + 1
            if not single:
                found.append((i, i + 1, 0))
        yield found


def word_scores(path: str, listed: list[str], table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, by one forward pass over all words side by side.

    ``alpha[k, i]`` is the sum over all segmentations of the first i letters of stretch k. ``table`` is (pieces, languages).
    """
    places, sources, pieces, begins, last = [], [], [], [], []
    width = LONGEST + 2
    for k, word in enumerate(listed):
        for found in arcs(path, word):
            base = len(last) * width
            for i, j, number in found:
                places.append(base + j)
                sources.append(base + i)
                pieces.append(number)
                begins.append(i)
            last.append((k, base + found[-1][1]))
    place, source, piece, begin = (np.array(x, np.int64) for x in (places, sources, pieces, begins))
    alpha = np.zeros((len(last) * width, table.shape[1]))
    alpha[np.arange(len(last)) * width] = 1
    order = np.argsort(begin, kind="stable")
    place, source, piece = place[order], source[order], piece[order]
    cuts = np.searchsorted(begin[order], np.arange(width + 1))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low < high:
            # Arcs of one stretch that begin together end apart, so no place occurs twice.
            alpha[place[low:high]] += alpha[source[low:high]] * table[piece[low:high]]
    out = np.zeros((len(listed), table.shape[1]))
    np.add.at(out, [k for k, _ in last], np.log(alpha[[end for _, end in last]]))
    return out


@dataclass(frozen=True)
class Model:
    """``table``: probability of each piece in each language; ``prior``: log share of the labelled documents.

    Workers keep the scores of words under ``name`` from task to task.
    """

    name: str
    path: str
    languages: list[str]
    table: np.ndarray
    prior: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text; ``und`` and 0 for texts without a letter or without a model."""
        rows: dict[str, int] = {}
        scores = np.zeros((0, len(self.languages)))
        most = max(1, CACHED_NUMBERS // max(1, len(self.languages)))
        rows, scores = _SCORES.get(self.name, (rows, scores))
        counted = [Counter(words(text)) if text and self.languages else {} for text in texts.to_pylist()]
        labels, posterior = [], np.zeros(len(texts))
        for low in range(0, len(counted), TOGETHER):
            part = counted[low : low + TOGETHER]
            fresh = list({w: None for own in part for w in own if w not in rows})
            if len(rows) + len(fresh) > most:
                rows, scores = {}, np.zeros((0, len(self.languages)))
                fresh = list({w: None for own in part for w in own})
            if fresh:
                made = word_scores(self.path, fresh, self.table)
                if len(rows) + len(fresh) > len(scores):
                    scores = np.concatenate([scores[: len(rows)], np.zeros((max(len(fresh), len(rows), 1024), len(self.languages)))])
                scores[len(rows) : len(rows) + len(fresh)] = made
                rows.update(zip(fresh, range(len(rows), len(rows) + len(fresh)), strict=True))
            for i, own in enumerate(part, low):
                if not own:
                    labels.append("und")
                    continue
                at = np.fromiter(map(rows.__getitem__, own), np.int64, len(own))
                total = self.prior + np.fromiter(own.values(), np.float64, len(own)) @ scores[at]
                best = int(total.argmax())
                labels.append(self.languages[best])
                posterior[i] = 1 / np.exp(total - total[best]).sum()
        _SCORES.clear()
        _SCORES[self.name] = (rows, scores)
        return labels, posterior


_SCORES: dict[str, tuple[dict[str, int], np.ndarray]] = {}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tally: Counter = Counter()
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            tally.update((lang, w) for w in words(text or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in tally], pa.string()), pa.array([k[1] for k in tally], pa.string()), pa.array(list(tally.values()), pa.int64())],
            ["lang", "word", "n"],
        )


def _expected(path: str, languages: list[str], table: np.ndarray):
    """Expected number of times each piece is used in the counted words of each language."""
    column = {lang: k for k, lang in enumerate(languages)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], float] = {}
        for batch in batches:
            for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n")), strict=True):
                own = table[:, column[lang]]
                for found in arcs(path, word):
                    alpha = [0.0] * (found[-1][1] + 1)
                    beta = list(alpha)
                    alpha[0] = beta[-1] = 1.0
                    for i, j, number in found:
                        alpha[j] += alpha[i] * own[number]
                    for i, j, number in reversed(found):
                        beta[i] += own[number] * beta[j]
                    for i, j, number in found:
                        share = n * alpha[i] * own[number] * beta[j] / alpha[-1]
                        total[lang, number] = total.get((lang, number), 0.0) + share
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()), pa.array(list(total.values()), pa.float64())],
            ["lang", "piece", "n"],
        )

    return rows


def learn(docs: DataFrame, bound: int = LABELLED_ROWS, path: str | None = None, most: int = LANGUAGES) -> Model:
    """A model from ``docs`` (doc_id, text, lang). Rows without id, text or language are left out.

    At most ``bound`` documents of a language give the pieces, so the work of fitting has a fixed size for each language. The first rank
    takes ``bound`` rows of each of ``DEALT`` parts of a language, the second the first of those. The prior counts all documents. Of more than
    ``most`` values of ``lang`` those with the most documents are learned (of equally frequent ones the first by name).
    """
    path = path or vocabulary_file()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(DEALT)).alias("part")
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    tally = usable.select("doc_id", "lang").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    documents = {r.lang: r.n for r in tally.orderBy(F.desc("n"), "lang").limit(most).collect()}
    usable = usable.where(F.col("lang").isin(list(documents)))
    chosen = (
        usable.select("doc_id", "lang", part)
        .withColumn("nth", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
        .where(F.col("nth") <= bound)
        .withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
        .where(F.col("nth") <= bound)
        .select("doc_id", "lang")
        .distinct()
    )
    chosen = saved(chosen, "chosen")
    sample = docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")
    counts = saved(sample.mapInArrow(_count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = sorted({r.lang for r in counts.select("lang").distinct().collect()})
    size = len(vocabulary(path)) + 1
    table = np.full((size, len(languages)), 1 / size)
    for _ in range(ROUNDS if languages else 0):
        made = counts.mapInArrow(_expected(path, languages, table), "lang string, piece int, n double")
        summed = made.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        expected = np.full(table.shape, ADDED)
        column = {lang: k for k, lang in enumerate(languages)}
        expected[summed["piece"].to_numpy(), summed["lang"].map(column).to_numpy()] += summed["n"].to_numpy().round(6)
        table = expected / expected.sum(0)
    weight = np.array([documents[x] for x in languages], float)
    return Model(uuid.uuid4().hex, path, languages, table, np.log(weight / max(weight.sum(), 1)))


def language(model: Model, text: Column) -> Column:
    """Struct (lang, score) of a text column: the likeliest language and its posterior probability."""

    @F.arrow_udf("lang string, score double")
    def apply(texts: pa.Array) -> pa.Array:
        labels, posterior = model.predict(texts)
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(posterior)], ["lang", "score"])

    return apply(text)
