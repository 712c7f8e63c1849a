import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from litmark.llm import tokens
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .conftest import CLASHING
from .test_packing import ROWS

PATH = tokens.tokenizer_file()
LIBRARY = Tokenizer.from_file(PATH)
TABLE = tokens.vocabulary_lengths(PATH)


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aZ9é \n\t'.,!ñß\x85\xa0\x1c 　​中ـ’“—", "<|endoftext|>", "'s", " the", "  ", "<|", "token"]), max_size=14))
def test_as_the_library(parts):
    text = "".join(parts)
    assert tokens.encode(PATH, text).tolist() == plain(text)
    assert tokens.count(PATH, TABLE, pa.array([text]))[1][0] == len(plain(text))
    assert tokens.pieces(text) is None or "".join(tokens.pieces(text)) == text
    assert tokens.ids(PATH, text) == b"".join(i.to_bytes(4, "little") for i in plain(text))


def test_table_is_no_larger_than_the_vocabulary_and_right():
    assert 40_000 < len(TABLE) <= LIBRARY.get_vocab_size()
    assert all(len(plain(t)) == n for t, n in list(TABLE.items())[::50])


def test_column(spark, table):
    docs = table(ROWS, CLASHING)
    made = docs.select("doc_id", "text", tokens.token_counts(spark, F.col("text")).alias("c")).collect()
    assert len(made) == len(ROWS)
    for r in made:
        assert (r.c.n_bytes, r.c.n_tokens) == (len((r.text or "").encode()), len(plain(r.text)))
    assert table([]).select(tokens.token_counts(spark, F.col("text"))).collect() == []


def test_frequent_pieces_with_their_lengths(spark, table):
    rows = [(i, f"internationalisation, of  words and{i} \n tabs <|endoftext|>") for i in range(300)]
    docs = table(rows + ROWS, CLASHING)
    made = tokens.frequent_lengths(docs, F.col("text"), PATH)
    assert made[" of "] == 2 and made[" words"] == 1 and made["internationalisation,"] == len(plain("internationalisation,")) > 1 and " and7" not in made
    assert all(len(plain(t)) == n for t, n in made.items() if "<|" not in t)
    assert len(tokens.frequent_lengths(docs, F.col("text"), PATH, most=2)) <= 2
    assert tokens.frequent_lengths(table([]), F.col("text"), PATH) == {}
    for r in docs.select("text", tokens.token_counts(spark, F.col("text"), docs=docs).alias("c")).collect():
        assert r.c.n_tokens == len(plain(r.text))


def test_frequent_pieces_are_counted_over_all_rows(spark):
    rare = F.when(F.col("id").isin(7, 19_001), " seldom").otherwise("")
    docs = spark.range(20_000).select(F.concat(F.lit("often"), rare).alias("text"))
    assert tokens.frequent_lengths(docs, F.col("text"), PATH) == {"often": len(plain("often")), " seldom": len(plain(" seldom"))}
