from __future__ import annotations

import random
import re
import time

import pytest

from tests.llm import cases
from tidemark.llm import pii as P

# The patterns as the contract words them, tried as they stand.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return [(k, *m.span()) for k, m in found]


def with_luhn(digits):
    return next(digits + d for d in "0123456789" if luhn(digits + d))


PARTS = [
    "a@b.c", "x.y@z", "@x.y", "@", ".", "..", "a%b+c@d-e.f.g", "é", " ", "\n", "+", "+1", "+49 30 123456", "(", ")", "-", "1.2.3.4", "1.2.3",
    "255.255.255.255", "256.1.1.1", "0001.1.1.1", "1", "12", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "word", "😀", "😀@a.b",
]


def test_fixed_kinds_equal_their_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices(PARTS, k=rng.randrange(1, 9)))
        assert [s[:3] for s in P.spans_of(text) if s[0] in P.BASE] == brute(text), text
    for _ in range(20_000):
        text = "".join(rng.choices("1234567890 .-+@a(", k=rng.randrange(1, 40)))
        assert [s[:3] for s in P.spans_of(text) if s[0] in P.BASE] == brute(text), text
    for size in range(13, 22):
        number = with_luhn("".join(rng.choices("0123456789", k=size - 1)))
        assert [s[:3] for s in P.spans_of(number) if s[0] == "card"] == brute(number) == [("card", 0, size)] * (16 <= size <= 19)


def test_checksums_and_context_decide_on_the_other_kinds():
    kinds = lambda text: [s[0] for s in P.spans_of(text)]
    assert kinds("konto DE89 3704 0044 0532 0130 00 bitte") == ["iban"] and kinds("konto DE88370400440532013000") == []
    assert kinds("GB82WEST12345698765432.") == ["iban"] and kinds("sample GB82WEST12345698765432") == ["iban"]
    amex = with_luhn("37144963539843")
    assert kinds(f"my card {amex}") == ["shortcard"] and kinds(f"number {amex}") == [] and kinds(f"example card {amex}") == []
    assert kinds("call 030 1234 5678 now") == ["localphone"] and kinds("it took 030 1234 5678 steps") == []
    assert kinds("order 030 1234 5678, call") == []
    near, far = P.spans_of("write to a@b.cc"), P.spans_of("version a@b.cc")
    assert near[0][3] == 1.0 and far[0][3] == 0.6
    # A weighed span gives way to a fixed one in the same place.
    assert kinds("call +49 30 1234 5678") == ["phone"]


@pytest.mark.parametrize(
    "text", ["a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "1 " * 1_000_000, "@a" * 1_000_000, "+1" * 1_000_000, "a.b@" * 500_000, "AA11" * 500_000]
)
def test_long_runs_take_linear_time(text):
    start = time.perf_counter()
    P.spans_of(text)
    assert time.perf_counter() - start < 10


def test_query_columns_and_odd_rows(spark):
    texts = [*cases.TEXTS, "é mail a@b.cc and 1.2.3.4", "+1 (555) 010-9999"]
    docs = cases.documents(spark, texts)
    rows = P.digest(P.scan(docs, keep_text=False)).collect()
    assert len(rows) == docs.count()
    got = cases.by_id(P.digest(P.scan(docs)))
    for i, text in enumerate(texts):
        expected = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text or ""))
        assert got[i].spans == expected and got[i].n_weighed == 0
        assert [got[i][f"n_{k}"] for k in P.BASE] == [expected.count(f"{k}:") for k in P.BASE]
    assert got[11].spans == "email:7:13,ip:18:25"
    assert P.scan(docs).columns == [*docs.columns, "pii"]
    assert P.digest(P.scan(cases.empty(spark))).count() == 0


def test_mask(spark):
    text = "é write to a@b.cc or 1.2.3.4 now"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "nothing")], "doc_id long, text string")
    got = {r.doc_id: r.masked for r in P.mask(P.scan(docs)).collect()}
    assert got == {1: "é write to [email] or [ip] now", 2: None, 3: "nothing"}
