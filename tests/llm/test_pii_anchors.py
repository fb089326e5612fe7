import hashlib
import random
import re

import pytest

from gridplume.llm import pii_anchors as pii
from gridplume.llm.common import table
from tests.llm.rows import awkward, none

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def brute(text):
    return {kind: [m.span() for m in re.finditer(p, text) if valid(kind, m.group())] for kind, p in PATTERNS.items()}


def base(text):
    found = pii.spans_of(text)
    return {kind: found[kind] for kind in PATTERNS}


@pytest.mark.parametrize("alphabet, longest", [("0123456789..--  +()@a.Zé_%\n44", 40), ("424242 4-1", 45), ("+12 ().-", 24), ("a@.b-@", 16), ("1.2.255.256.0.", 30)])
def test_base_spans_equal_the_patterns(alphabet, longest):
    rng = random.Random(longest)
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))
        assert base(text) == brute(text), repr(text)


def test_added_kinds():
    text = "IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678, SSN 123-45-6789, ftp://bob:pw@host.example/x; accountant 99999999, DE00 3704"
    found = pii.spans_of(text)
    assert [text[a:b] for a, b in found["account"]] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [text[a:b] for a, b in found["ssn"]] == ["123-45-6789"]
    assert [text[a:b] for a, b in found["login"]] == ["bob:pw"]


def test_long_runs_take_linear_time():
    for run in ("1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000):
        pii.spans_of(run)


def told(text, kinds):
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in kinds[k])


def check(docs, df):
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    rows = df.collect()
    want = sorted((i, hashlib.sha256(told(t, brute(t)).encode()).hexdigest(), *map(len, brute(t).values())) for i, t in texts)
    assert sorted((r["id"] or -1, r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in rows) == want
    for r in rows:
        own = [s for s in r["spans"].split(",") if s.split(":")[0] in pii.BASE]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r["base_sha256"]


def test_awkward_rows(spark):
    check(awkward(spark), pii.scan(awkward(spark)))
    assert pii.scan(none(spark)).count() == 0


def test_tables(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    check(docs, pii.scan(docs))
