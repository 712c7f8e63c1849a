import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from litmark.llm import personal
from pyspark.sql import functions as F

from .conftest import CLASHING

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """Base spans by the patterns as they are stated, and checks written down another way."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                if not 16 <= len(digits) <= 19:
                    continue
                doubled = [d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1], 1)]
                if sum(doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


PARTS = ["a.b", "@", "x-1.org", ".", " ", "1", "255", "256", "0012", "1.2.3.4", "-", "(", ")", "+", "+49 30 ", "4111111111111111", "4111 1111-1111 1111",
    "5500 0000 0000 0004", "é", "\n", "DE89 3704 0044 0532 0130 00", "tel", "card", "378282246310005", "078-05-1120", "ssn", "%", "٣", "😀"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16))
def test_base_spans_are_those_of_the_stated_patterns(parts):
    text = "".join(parts)
    found = personal.spans(text)
    assert [s[:3] for s in found if s.base] == plain(text)
    added = sorted(s[1:3] for s in found if not s.base)
    assert all(a[1] <= b[0] for a, b in zip(added, added[1:], strict=False))
    assert all(x[1] <= s.start or s.end <= x[0] for x in added for s in found if s.base)


def test_parts_of_an_address_of_any_length():
    assert kinds("1.2.3." + "0" * 9_000 + "7") != [] and kinds("1.2.3." + "9" * 9_000) == []


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in personal.spans(text)]


def test_checksums_and_context_add_spans():
    assert kinds("Konto DE89 3704 0044 0532 0130 00 AB") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("DE89370400440532013000") == [("iban", "DE89370400440532013000")]
    assert kinds("Konto DE88 3704 0044 0532 0130 00") == []
    assert kinds("DE89 3704 0044 0532 0130 00 order 12") == []
    assert kinds("credit card 3782 822463 10005") == [("short_card", "3782 822463 10005")]
    assert kinds("number 3782 822463 10005") == []
    assert kinds("my SSN is 078-05-1120") == [("ssn", "078-05-1120")]
    assert kinds("call 030 1234-5678 now") == [("local_phone", "030 1234-5678")]
    assert kinds("call 030 1234-5678 for order 7") == [] == kinds("030 1234-5678")


def test_context_moves_the_score_of_base_spans_which_stay():
    alone, near, order = (personal.spans(t + " 4111111111111111")[0] for t in ("x", "Visa", "order"))
    assert order.score < alone.score < near.score and alone.base and order.base
    assert (personal.luhn("79927398713"), personal.luhn("79927398710")) == (True, False)


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "+1" + " " * 400_000, "a@" * 200_000, "1.2." * 100_000, "a.b@c.de" * 50_000, "AB12" * 100_000, "+1 (2" * 80_000, "4111 1111 1111 1111 tel " * 16_000])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    personal.spans(text)
    assert time.perf_counter() - start < 8


ROWS = [(1, "mail a.b@c.de or 10.0.0.1"), (1, "mail a.b@c.de or 10.0.0.1"), (2, None), (3, ""), (None, "é+49 30 1234567"), (4, "4111111111111111 " + "z " * 30_000 + "x@y.zz")]


def test_columns(table):
    docs = table(ROWS, CLASHING)
    found = docs.select("doc_id", "text", personal.find(F.col("text")).alias("spans"), personal.mask(F.col("text")).alias("masked")).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == plain(r.text)
        assert r.masked == (r.text if not r.spans else personal.masked(r.text))
    assert {r.masked for r in found if r.doc_id == 1} == {"mail [EMAIL] or [IP]"}
    assert table([]).select(personal.find(F.col("text"))).collect() == []


def test_query_over_the_table(spark):
    import hashlib

    from litmark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op11_personal"](spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts) and sum(r.n_email for r in found) > 5
    for r in found:
        wanted = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in wanted) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in wanted).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in wanted} <= set(r.spans.split(","))
