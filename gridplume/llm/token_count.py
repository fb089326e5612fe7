"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

Offline, every vocabulary string that encodes alone as one token is proven to do so, by encoding it. A text is split
into pre-tokens as the tokenizer splits it; pre-tokens that are proven count one, and only the rest are merged by the
library, each distinct one once while it is remembered. A special string in a text is one token and parts the text, as
the library has it by default.

The library's split and ours may know different versions of Unicode. ``settled`` tries each assigned character beside
letters, digits, signs and blanks; where the two differ, or a character is unassigned or private, the words that hold
it go to the library, between blanks at which both splits part. All other words of the text take the shortcut.

Defined results: a null or empty text has no tokens; there is no truncation, and the length of a text has no bound;
rows that repeat are counted each; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split that byte-level vocabularies of this kind are defined with.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII_SPLIT = _SPLIT.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+")
#: Both splits part a text before a blank that follows something else.
_BEFORE_BLANK = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n])")
#: Merged pre-tokens that a task remembers.
_REMEMBERED = 500_000


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need: the tokenizer's file, its special strings, and the pre-tokens proven to be one token."""

    file: str
    special: tuple[str, ...]
    whole: frozenset[str]
    settled: tuple[tuple[int, int], ...]


@cache
def settled() -> tuple[tuple[int, int], ...]:
    """Ranges (first, last) of the assigned characters that the library splits as we do."""
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def same(characters: Sequence[str]) -> bool:
        text = "".join(f"a{c}1{c}!{c} {c}" for c in characters)
        return [m.span() for m in regex.finditer(_SPLIT, text)] == [place for _, place in library(text)]

    assigned = regex.findall(r"[^\p{Cn}\p{Co}]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
    found: list[tuple[int, int]] = []
    for start in range(0, len(assigned), 100):
        portion = assigned[start : start + 100]
        for c in portion if same(portion) else filter(same, portion):
            if found and found[-1][1] == ord(c) - 1:
                found[-1] = (found[-1][0], ord(c))
            else:
                found.append((ord(c), ord(c)))
    return tuple(found)


def prepare(path: str) -> Vocabulary:
    """Reads a tokenizer file and proves its whole tokens. Raises for tokenizers that don't split as this method
    does."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as source:
        file = source.read()
    told = json.loads(file)
    split = told["pre_tokenizer"] or {}
    added = told["added_tokens"]
    if (
        told["model"]["type"] != "BPE" or told["normalizer"] or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space") or not split.get("use_regex", True)
        or any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added)
    ):
        raise ValueError(f"{path} is not a byte-level BPE vocabulary without normalizer")
    own = Tokenizer.from_str(file)
    special = tuple(a["content"] for a in added)
    ids = [i for s, i in told["model"]["vocab"].items() if s not in special]
    strings = [s for s in own.decode_batch([[i] for i in ids], skip_special_tokens=False) if s and "�" not in s]
    alone = own.encode_batch(strings, add_special_tokens=False)
    return Vocabulary(file, special, frozenset(s for s, e in zip(strings, alone) if len(e.ids) == 1), settled())


class Counter:
    """Counts the tokens of texts; remembers merged pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(vocabulary.file)
        self.merger = Tokenizer.from_str(vocabulary.file)
        self.merger.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None
        self.whole = vocabulary.whole
        self.split = regex.compile(_SPLIT).findall
        self.split_ascii = re.compile(_ASCII_SPLIT, re.A).findall
        ranges = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in vocabulary.settled)
        self.unsettled = re.compile(f"[^{ranges}]").search
        self.merged: dict[str, int] = {}

    def count(self, text: str) -> int:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._part, parts))
        return self._part(text)

    def _part(self, text: str) -> int:
        """Of a text without special strings."""
        if text.isascii() or not self.unsettled(text):
            return self._plain(text)
        words = _BEFORE_BLANK.split(text)
        return sum([self._by_library(w) if self.unsettled(w) else self._plain(w) for w in words])

    def _by_library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def _plain(self, text: str) -> int:
        pieces = self.split_ascii(text) if text.isascii() else self.split(text)
        whole, merged = self.whole, self.merged
        rest = [p for p in pieces if p not in whole]
        try:
            return len(pieces) - len(rest) + sum([merged[p] for p in rest])
        except KeyError:
            if len(merged) > _REMEMBERED:
                merged.clear()
            new = [p for p in dict.fromkeys(rest) if p not in merged]
            for p, e in zip(new, self.merger.encode_batch(new, add_special_tokens=False)):
                merged[p] = len(e.ids)
            return len(pieces) - len(rest) + sum([merged[p] for p in rest])


def token_count(text: Column, vocabulary: Vocabulary, spark) -> Column:
    """The number of tokens of a text, as a column."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(shared.value)
        for batch in batches:
            yield batch.fillna("").map(counter.count)

    return count(text)


def counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)."""
    vocabulary = prepare(path)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, vocabulary, docs.sparkSession).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
