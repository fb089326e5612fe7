"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over a text and reports anchors: at-signs, digits that begin or go on a number in a
telling way, plus signs before digits, schemes, and cue words for identifiers. A local parser for each kind of anchor
walks outward from it, character by character, finds where the email, address, number or account begins and ends, and
validates it. Nothing else of the text is looked at, and a place is parsed once.

Kinds in order. Base kinds, as the patterns of the contract have them (leftmost, not overlapping, validated after the
match): email, ip (four parts of at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits). Added kinds:
account (an IBAN that passes mod 97, or a number of 6 to 18 digits right behind a cue such as "account no."), ssn
(3-2-4 digits right behind a cue), login (the ``user:password`` of an address with a scheme).

Defined results: a null text counts as empty and has no spans; offsets are code points, end exclusive; texts of any
length are read whole; rows that repeat are scanned each; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "ssn", "login")

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _LETTERS | _DIGITS | {"-"}
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_USERINFO = _LETTERS | _DIGITS | frozenset("-._~!$&'()*+,;=:%")
#: Words that announce an identifier.
_ACCOUNT_CUES = ("account", "acct", "a/c", "konto", "kontonummer", "compte", "cuenta")
_SSN_CUES = ("ssn", "social security")
_GLUE = frozenset(" \t:=#.-")
#: Characters between a cue and its number, at most.
_REACH = 12

Span = tuple[int, int]


def email_at(text: str, at: int, free: int) -> Span | None:
    """The address around the at-sign; its local part does not reach before ``free``, where the last match ended."""
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end, labels, place = at, 0, at + 1
    while True:
        label = place
        while place < len(text) and text[place] in _LABEL:
            place += 1
        if place == label:
            break
        labels, end = labels + 1, place
        if place >= len(text) or text[place] != ".":
            break
        place += 1
    return (start, end) if labels >= 2 else None


def dotted_at(text: str, at: int) -> tuple[list[Span], int]:
    """The chain of numbers and dots around the digit at ``at``: its groups of four that are addresses, and its end."""
    start = at
    while start and (text[start - 1] in _DIGITS or (text[start - 1] == "." and start > 1 and text[start - 2] in _DIGITS)):
        start -= 1
    parts: list[Span] = []
    place = start
    while place < len(text) and text[place] in _DIGITS:
        first = place
        while place < len(text) and text[place] in _DIGITS:
            place += 1
        parts.append((first, place))
        if place + 1 < len(text) and text[place] == "." and text[place + 1] in _DIGITS:
            place += 1
    found = []
    for k in range(0, len(parts) - 3, 4):
        if all(_byte(text[a:b]) for a, b in parts[k : k + 4]):
            found.append((parts[k][0], parts[k + 3][1]))
    return found, place


def _byte(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 3 or (len(number) == 3 and number <= "255")


def digits_at(text: str, at: int) -> tuple[int, int, str]:
    """The run of digits with single blanks or hyphens between them around the digit at ``at``: start, end, digits."""
    start = at
    while start and (text[start - 1] in _DIGITS or (text[start - 1] in " -" and start > 1 and text[start - 2] in _DIGITS)):
        start -= 1
    place = start
    digits = []
    while place < len(text):
        if text[place] in _DIGITS:
            digits.append(text[place])
        elif not (text[place] in " -" and place + 1 < len(text) and text[place + 1] in _DIGITS):
            break
        place += 1
    return start, place, "".join(digits)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def phone_at(text: str, at: int) -> tuple[Span | None, int]:
    """The number behind the plus sign at ``at``, and where its characters end."""
    place, last = at + 2, -1
    while place < len(text) and text[place] in _PHONE:
        if place > at + 2 and text[place] in _DIGITS:
            last = place
        place += 1
    if last < 0:
        return None, at + 2
    digits = sum(c in _DIGITS for c in text[at : last + 1])
    return ((at, last + 1) if 8 <= digits <= 15 else None), last + 1


def iban_at(text: str, at: int) -> Span | None:
    """An IBAN that starts at ``at``, with single blanks or without."""
    found, place, end = [], at, at
    while place < len(text) and len(found) < 34:
        c = text[place]
        if c.isascii() and (c in _DIGITS or "A" <= c <= "Z"):
            found.append(c)
            end = place + 1
            if len(found) >= 15 and (place + 1 == len(text) or text[place + 1] not in _LABEL) and _mod97("".join(found)):
                return at, end
        elif c != " " or text[place - 1] == " ":
            break
        place += 1
    return None


def _mod97(code: str) -> bool:
    if not (code[:2].isalpha() and code[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def cued_number(text: str, behind: int) -> tuple[int, int, str] | None:
    """The run of digits that begins within reach behind a cue, with nothing but glue and "no", "number" or the like
    between."""
    place = behind
    for word in ("number", "nummer", "num", "no", "nr", "id", "is"):
        skipped = place
        while skipped < len(text) and text[skipped] in _GLUE:
            skipped += 1
        if text[skipped : skipped + len(word)].lower() == word:
            place = skipped + len(word)
            break
    while place < len(text) and text[place] in _GLUE and place - behind < _REACH + 8:
        place += 1
    if place < len(text) and text[place] in _DIGITS and place > behind:
        _, end, digits = digits_at(text, place)
        return place, end, digits
    return None


def login_at(text: str, scheme: int) -> Span | None:
    """The ``user:password`` behind ``://`` at ``scheme``, where an at-sign and a host follow."""
    start = place = scheme + 3
    while place < len(text) and text[place] in _USERINFO:
        place += 1
    inner = text[start:place]
    if ":" not in inner.strip(":") or place + 1 >= len(text) or text[place] != "@" or text[place + 1] not in _LABEL:
        return None
    return start, place


@lru_cache(maxsize=1)
def automaton():
    """The anchors: (kind, characters from the anchor's end back to the place that its parser starts from)."""
    import ahocorasick

    words = ahocorasick.Automaton()
    anchors: dict[str, list] = {"@": [("email", 0)], "://": [("login", 2)]}
    for d in "0123456789":
        anchors.setdefault(f"+{d}", []).append(("phone", 1))
        anchors.setdefault(f"{d}.", []).append(("ip", 1))
        for e in "0123456789":
            for between in ("", " ", "-"):
                anchors.setdefault(f"{d}{between}{e}", []).append(("card", 0))
    for cues, kind in ((_ACCOUNT_CUES, "account"), (_SSN_CUES, "ssn")):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
                anchors.setdefault(form, []).append((kind, -1))
    for form in ("IBAN", "Iban", "iban"):
        anchors.setdefault(form, []).append(("iban", -1))
    for anchor, meaning in anchors.items():
        words.add_word(anchor, meaning)
    words.make_automaton()
    return words


def spans_of(text: str) -> dict[str, list[Span]]:
    """All spans of a text by kind, in order."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    free = {"email": 0, "ip": 0, "card": 0, "phone": 0, "account": 0, "ssn": 0, "login": 0}
    for end, meaning in automaton().iter(text):
        for kind, back in meaning:
            at = end - back
            if kind == "iban":
                kind, at = "account", end + 1
                while at < len(text) and text[at] in _GLUE and at - end <= _REACH:
                    at += 1
                span = iban_at(text, at) if at >= free["account"] else None
            elif at < free[kind]:
                continue
            elif kind == "email":
                span = email_at(text, at, free["email"])
            elif kind == "ip":
                groups, free["ip"] = dotted_at(text, at)
                found["ip"] += groups
                continue
            elif kind == "card":
                start, free["card"], digits = digits_at(text, at)
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((start, free["card"]))
                continue
            elif kind == "phone":
                span, free["phone"] = phone_at(text, at)
            elif kind == "login":
                span = login_at(text, at)
            else:
                number = cued_number(text, at)
                span = None
                if number and kind == "account" and 6 <= len(number[2]) <= 18:
                    span = number[:2]
                elif number and kind == "ssn" and len(number[2]) == 9:
                    span = number[:2]
            if span:
                found[kind].append(span)
                free[kind] = max(free[kind], span[1])
    return found


def _told(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in sorted(found[kind]))


REPORT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch.fillna(""):
            found = spans_of(text)
            base = hashlib.sha256(_told(found, BASE).encode()).hexdigest()
            rows.append((*(len(found[kind]) for kind in BASE), base, _told(found, KINDS)))
        yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans
    (all)."""
    report = F.pandas_udf(_report, REPORT)
    return docs.select(docs[id_col].alias("id"), report(docs[text_col]).alias("r")).select("id", "r.*")
