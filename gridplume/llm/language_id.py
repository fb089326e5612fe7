"""Language of web pages by Bayesian fusion of four kinds of evidence.

* Text: likelihood of the character trigrams of a page's main text (or of a plain text), by a model of each language
  learnt from labelled documents.
* Mark-up: the language a page declares. How far each declaration is to be believed is counted over all pages.
* Address: the suffix of the host's name, and
* host: priors of languages per host, smoothed towards those of its domain, these towards those of its suffix, these
  towards all pages'.

The priors are sums of the text's posteriors, grouped by host, domain and suffix; a page's own part is taken out before
its prior is formed, so no page votes for itself. A hot host combines before the shuffle. The logarithms of text
likelihood, declaration and prior add up.

Where host and domain, or domain and suffix, are the same name they are one level.

The trigram model is fitted on a bounded sample of labelled documents (``Sample``), whose texts are read whole; all
counts over pages are of all pages.

Defined results: a null or empty page is judged by address and neighbours alone; a null address has the empty host;
without labelled documents there are no languages and the result is null with probability null; ties go to the language
that comes first; rows that repeat are judged each; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.llm import html_blocks
from gridplume.session import as_written

BUCKETS = 1 << 14
#: Trigrams overlap and are not independent: their logarithms count this much.
TEXT_WEIGHT = 0.1
#: Pages' worth of belief that a level of the hierarchy has in the next.
STRENGTH = 5.0
#: Pages' worth of belief that a declared language is the page's, 9 in 10.
DECLARED_STRENGTH, DECLARED_RIGHT = 20.0, 0.9


@dataclass(frozen=True)
class Sample:
    """Bounds of what the trigram model is fitted on: about so many documents a language, read whole. The model takes
    128 KB a language; ``languages`` is above the number of language codes there are, and labels with more different
    values are refused, as they are no languages."""

    rows: int = 2000
    languages: int = 10_000


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: Logarithms, by language and bucket.
    table: np.ndarray


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of a lower-cased text with single blanks, a blank at either end."""
    text = f" {' '.join(text.lower().split())} "
    if len(text) < 3:
        return np.zeros(0, dtype=np.int64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
    mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0xC2B2AE3D)
    return ((mixed >> np.uint64(13)) % np.uint64(BUCKETS)).astype(np.int64)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: Sample = Sample()) -> TextModel:
    """Counts trigrams of a sample of the labelled documents, chosen by a hash of their identifiers, language by
    language."""
    marked = docs.where(docs[lang_col].isNotNull())
    sizes = {r[0]: r[1] for r in marked.groupBy(docs[lang_col]).agg(F.count(F.lit(1))).limit(sample.languages + 1).collect()}
    if len(sizes) > sample.languages:
        raise ValueError(f"more than {sample.languages} languages")
    languages = tuple(sorted(sizes))
    if not languages:
        return TextModel((), np.zeros((0, BUCKETS)))
    shares = F.from_json(F.lit(json.dumps({code: min(1.0, sample.rows / sizes[code]) for code in languages})), "map<string, double>")
    chance = F.pmod(F.xxhash64(docs[id_col], F.lit("language")), F.lit(1_000_000)) / 1e6
    chosen = marked.where(chance < shares[docs[lang_col]]).select(docs[lang_col].alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": own[at]})

    counted = chosen.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), BUCKETS), 0.5)
    number = {code: k for k, code in enumerate(languages)}
    for lang, bucket, n in counted.collect():
        table[number[lang], bucket] += n
    table /= table.sum(axis=1, keepdims=True)
    return TextModel(languages, np.log(table, out=table))


_DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?([a-z]{2,3})\b", re.I)
_META = re.compile(r"<meta\b(?=[^>]*(?:content-language|og:locale))[^>]*\bcontent\s*=\s*[\"']?([a-z]{2,3})\b", re.I)


def declared(page: str) -> str:
    """The primary language that the mark-up declares, or an empty string."""
    found = _DECLARED.search(page) or _META.search(page)
    return found[1].lower() if found else ""


def host_of(url: Column) -> Column:
    """The host's name of an address, lower-cased, without port and user; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def text_logs(model_table: np.ndarray, text: str) -> np.ndarray:
    """The weighted log-likelihood of a text by language, 0 for the likeliest. Memory is bounded for texts of any
    length."""
    found = trigrams(text)
    if len(found) > BUCKETS // 4:
        logs = model_table @ np.bincount(found, minlength=BUCKETS)
    else:
        logs = model_table[:, found].sum(axis=1)
    return (logs - logs.max()) * TEXT_WEIGHT


def _seen(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """A written row for each of ``rows`` (id, url, host, content): id, url, host, domain, suffix, declared, logs
    (text, by language), own (the text's posteriors). Content is a page if ``markup``, else plain text, which declares
    nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(model.table)
    tree = html_blocks.train(html_blocks.LABELLED)

    @F.pandas_udf("declared string, logs array<double>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.fillna("")
            texts = (html_blocks.main_text(p, tree) for p in batch) if markup else batch
            logs = [text_logs(shared.value, t).tolist() for t in texts]
            yield pd.DataFrame({"declared": [declared(p) if markup else "" for p in batch], "logs": logs})

    labels = F.split("host", r"\.")
    last_two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    total = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x))
    looked = rows.select("id", "url", "host", look("content").alias("seen")).select("id", "url", "host", "seen.*")
    placed = looked.withColumns({"domain": last_two, "suffix": F.element_at(labels, -1), "total": total})
    return as_written(placed.withColumn("own", F.transform("logs", lambda x: F.exp(x) / F.col("total"))).drop("total"), "seen")


def _sums(pages: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Sums of the text's posteriors by language, per key; combined before the shuffle."""
    sums = [F.sum(F.col("own")[k]).alias(f"_{k}") for k in range(n)]
    grouped = pages.groupBy(*keys).agg(*sums) if keys else pages.agg(*sums)
    return grouped.select(*keys, F.array(*[F.col(f"_{k}") for k in range(n)]).alias(name))


def _smoothed(counts: Column, own: Column, prior: Column) -> Column:
    """Priors from counts without the page's own part, with STRENGTH pages' worth of the level above."""
    others = F.zip_with(counts, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    mixed = F.zip_with(others, prior, lambda a, p: a + STRENGTH * p)
    return F.transform(mixed, lambda x: x / (F.aggregate(others, F.lit(0.0), lambda a, y: a + y) + STRENGTH))


def identify(
    pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    model: TextModel | None = None,
) -> DataFrame:
    """One row for each row of ``pages``: id, url, lang, probability, declared, text_lang (by the text alone),
    host_prior (of lang)."""
    url = pages[url_col]
    rows = pages.select(pages[id_col].alias("id"), url.alias("url"), host_of(url).alias("host"), pages[html_col].alias("content"))
    return _fused(rows, model or learn(docs), markup=True)


def identify_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", model: TextModel | None = None
) -> DataFrame:
    """As ``identify``, for plain texts: they declare nothing, and their source stands for the host."""
    host = F.lower(F.coalesce(docs[host_col].cast("string"), F.lit("")))
    rows = docs.select(
        docs[id_col].alias("id"), F.lit(None).cast("string").alias("url"), host.alias("host"), docs[text_col].alias("content")
    )
    return _fused(rows, model or learn(docs), markup=False)


def _fused(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    n = len(model.languages)
    if not n:
        nothing = {"lang": "string", "probability": "double", "declared": "string", "text_lang": "string", "host_prior": "double"}
        return rows.select("id", "url", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    seen = _seen(rows, model, markup)
    codes = F.array(*[F.lit(c) for c in model.languages])
    by_host = _sums(seen, ["host", "domain", "suffix"], n, "of_host")
    # A host has one domain and a domain one suffix, so each level sums up the one below.
    by_domain = _sums(by_host.withColumnRenamed("of_host", "own"), ["domain", "suffix"], n, "of_domain")
    by_suffix = _sums(by_domain.withColumnRenamed("of_domain", "own"), ["suffix"], n, "of_suffix")
    of_all = _sums(by_suffix.withColumnRenamed("of_suffix", "own"), [], n, "of_all").first()
    whole = of_all["of_all"] if of_all and of_all["of_all"][0] is not None else [0.0] * n
    top = F.array(*[F.lit((x + STRENGTH / n) / (sum(whole) + STRENGTH)) for x in whole])
    levels = as_written(by_host.join(by_domain, ["domain", "suffix"]).join(by_suffix, ["suffix"]).drop("domain", "suffix"), "levels")
    # How often each language's pages declare each code: P(declared | language), smoothed towards "right 9 times in 10".
    by_code = _sums(seen.where("declared <> ''"), ["declared"], n, "of_code")
    expected = F.transform(codes, lambda c: F.when(c == F.col("declared"), F.lit(DECLARED_RIGHT)).otherwise((1 - DECLARED_RIGHT) / max(n, 2)))
    all_codes = _sums(by_code.withColumnRenamed("of_code", "own"), [], n, "of_codes")
    told = F.array(*[F.lit(float(x or 0.0)) for x in all_codes.first()["of_codes"]])
    belief = by_code.select(
        F.col("declared").alias("code"),
        F.zip_with(F.zip_with("of_code", expected, lambda a, e: a + DECLARED_STRENGTH * e), told, lambda x, t: F.ln(x / (t + DECLARED_STRENGTH))).alias("belief"),
    )
    placed = seen.join(levels, "host").join(belief, F.col("declared") == F.col("code"), "left")
    silent = F.transform(codes, lambda _: F.lit(0.0))
    prior = placed.withColumn("prior", _smoothed(F.col("of_suffix"), F.col("own"), top))
    for level, above in (("domain", "suffix"), ("host", "domain")):
        own = _smoothed(F.col(f"of_{level}"), F.col("own"), F.col("prior"))
        prior = prior.withColumn("prior", F.when(F.col(level) == F.col(above), F.col("prior")).otherwise(own))
    logs = F.zip_with(
        F.zip_with("logs", "prior", lambda x, p: x + F.ln(p)), F.coalesce("belief", silent), lambda x, b: x + b
    )
    fused = prior.withColumn("fused", logs).withColumn("best", F.array_max("fused"))
    total = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    at = F.array_position("fused", F.col("best")).cast("int")
    return fused.select(
        "id", "url", F.element_at(codes, at).alias("lang"), (1 / total).alias("probability"),
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        F.when(F.array_min("logs") < 0, F.element_at(codes, F.array_position("logs", F.array_max("logs")).cast("int"))).alias("text_lang"),
        F.element_at("prior", at).alias("host_prior"),
    )
