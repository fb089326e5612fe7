"""Secrets in texts: wide candidate search, then a random forest that removes false positives.

A candidate is a long run of key characters with a digit in it, or whatever is assigned to a name such as ``password``, with
or without quotes and up to 16 blanks on either side of the sign.
The forest sees its length, how its characters follow each other (changes of class; likelihood of its letter pairs in
the corpus' own words), how much of it dictionary words cover, the path it was found under, and the words around it. It
is trained from labelled findings: rows of a text with one candidate, its path, and whether it is a secret.

Everything is DataFrame work, the forest is Spark ML's. The dictionary is the ``DICTIONARY`` most frequent words of the
whole corpus.

Defined results: null and empty texts have no candidates; a null path is an empty one; offsets are code points, end
exclusive; equal rows are scanned each; texts of any length are read whole; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridplume.llm.common import located

_KEY = r"[A-Za-z0-9+/_\-]"
_NAMED = r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
#: Between a name and its value: quotes, blanks and = or : (also :=, ==, =>).
_SIGN = r"[\"']?\s{0,16}[=:]{1,2}>?\s{0,16}[\"']?"
#: Runs of 12 or more key characters with a digit; values of 6 or more characters assigned to a telling name. The first
#: two looks behind are for speed: most characters are ruled out by the one before, most words by the lack of a sign.
CANDIDATE = (
    rf"(?<!{_KEY})(?=[A-Za-z+/_\-]*+[0-9]){_KEY}{{12,}}={{0,2}}"
    rf"|(?<=[=:>\s\"'])(?<=[=:]>?\s{{0,16}}[\"']?)(?<=(?i:{_NAMED}){_SIGN})[^\s\"'<>]{{6,}}"
)
#: Characters of a candidate's neighbourhood that are looked at, on either side.
AROUND = 48
DICTIONARY = 1000

FEATURES = [
    "length", "changes", "pair_likelihood", "coverage", "distinct", "digits", "uppers", "symbols", "hex", "sequence",
    "named_before", "assigned", "quoted", "provider", "hash_words", "number_words", "example_words", "test_path", "url_like",
]


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """A row for each candidate: id, place, path, value, start, end, before, after.

    What stands between two candidates gives the offsets and the neighbourhood: lengths add up along the text's own
    candidates.
    """
    docs, place = located(docs)
    path = docs[path_col].cast("string") if path_col else F.lit("")
    read = docs.select(docs[id_col].alias("id"), place.alias("place"), F.coalesce(path, F.lit("")).alias("path"), docs[text_col].alias("text"))
    # Most texts have no candidate; they are searched once and not taken apart.
    found = read.where(F.col("text").rlike(CANDIDATE)).withColumn("values", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    gaps = F.split("text", CANDIDATE, -1)
    beside = F.transform(gaps, lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(AROUND)).alias("tail"), F.left(g, F.lit(AROUND)).alias("head")))
    each = found.select("id", "place", "path", "values", beside.alias("beside")).select(
        "id", "place", "path", "beside", F.posexplode("values").alias("nth", "value")
    )
    each = each.select(
        "id", "place", "path", "nth", "value", F.get("beside", F.col("nth"))["n"].alias("gap"),
        F.get("beside", F.col("nth"))["tail"].alias("before"), F.get("beside", F.col("nth") + 1)["head"].alias("after"),
    )
    along = Window.partitionBy("place").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("value")).over(along)
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("gap", "nth")


def dictionary(docs: DataFrame, text_col: str, most: int = DICTIONARY) -> list[tuple[str, int]]:
    """The ``most`` most frequent words of 4 to 12 letters, with their counts; ties in alphabetical order."""
    words = docs.select(F.explode(F.split(F.lower(docs[text_col]), "[^a-z]+")).alias("word")).where(F.length("word").between(4, 12))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [(r["word"], r["n"]) for r in counted.collect()]


def pair_logs(words: list[tuple[str, int]]) -> dict[str, float]:
    """The logarithm of the chance of the second letter after the first, in the dictionary's running words."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    pairs: Counter = Counter()
    for word, n in words:
        for a, b in zip(word, word[1:]):
            pairs[a + b] += n
    rows = {a: sum(pairs[a + b] for b in letters) for a in letters}
    # Half a word's worth of every pair, so that none is impossible.
    return {a + b: math.log((pairs[a + b] + 0.5) / (rows[a] + 18.0)) for a in letters for b in letters}


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def with_features(found: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """Adds FEATURES, all double, to rows of value, before, after, path."""
    value, low = F.col("value"), F.lower("value")
    before, after, near = F.lower("before"), F.lower("after"), F.lower(F.concat_ws(" ", "before", "after"))
    logs = pair_logs(words)
    table = F.create_map(*[F.lit(x) for pair in logs.items() for x in pair])
    plain = F.regexp_replace(low, "[^a-z0-9]", "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("plain") - 1, F.lit(1))), lambda i: F.coalesce(F.try_element_at("logs", F.substr("plain", i, F.lit(2))), F.lit(-4.0)))
    total = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / F.size(pairs)
    known = "|".join(sorted((w for w, _ in words), key=lambda w: (-len(w), w)))
    covered = 1 - F.length(F.regexp_replace(low, known, "")) / F.length("value") if known else F.lit(0.0)
    steps = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    columns = {
        "length": F.length("value").cast("double"),
        "changes": _share(value, steps),
        "pair_likelihood": total,
        "coverage": covered.cast("double"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "digits": _share(value, "[0-9]"),
        "uppers": _share(value, "[A-Z]"),
        "symbols": _share(value, "[^A-Za-z0-9]"),
        "hex": _flag(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") & value.rlike("[A-Fa-f]")),
        "sequence": _flag(low.rlike(r"(.)\1{3}|0123|1234|abcd|qwert|xyz")),
        "named_before": _flag(before.rlike(rf"{_NAMED}[\s\"'`]*(?:[=:]{{1,2}}>?|is)?[\s\"'`]*$")),
        "assigned": _flag(before.rlike(r"[=:]>?\s*[\"'`]?$")),
        "quoted": _flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "provider": _flag(value.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^sk_live_|^xox[abprs]-|^AIza[0-9A-Za-z_\-]{35}$|^eyJ[\w\-]{10,}")),
        "hash_words": _flag(near.rlike(r"\b(?:sha-?\d*|md5|commit|checksum|digest|etag|uuid|guid|revision|integrity|base64)\b")),
        "number_words": _flag(near.rlike(r"\b(?:order|invoice|card|phone|tel|isbn|serial|version|page|date|iban|account)\b")),
        "example_words": _flag(F.concat_ws(" ", near, low).rlike(r"example|sample|dummy|placeholder|changeme|your[_\- ]|fake|xxxx|redacted|insert|todo")),
        "test_path": _flag(F.lower("path").rlike(r"(?:^|[/_.\-])(?:tests?|spec|fixtures?|examples?|docs?|mocks?|samples?)(?:[/_.\-]|$)")),
        "url_like": _flag(before.rlike(r"(?:https?://|www\.|/)\S*$") | value.rlike(r"/\w+/")),
    }
    return found.withColumns({"plain": plain, "logs": table}).withColumns(columns).drop("plain", "logs")


def labelled_findings() -> list[tuple[str, str, str, int]]:
    """(before, value, after, path, 1 for a secret): findings as reviewers label them, 40 of a kind, with values made
    from digests."""
    rows = []
    for k in range(40):
        digest = hashlib.sha256(f"finding {k}".encode()).hexdigest()
        number = str(int(digest, 16))
        upper = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[int(digest[2 * i : 2 * i + 2], 16) % 32] for i in range(32))
        mixed = "".join(("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")[int(digest[2 * i % 62 : 2 * i % 62 + 2], 16) * 7 % 62] for i in range(40)) + "7"
        code, prose = "src/app/config.py", "notes"
        for before, value, after, path, secret in (
            ("the server uses password=", digest[:18], " for now", prose, 1),
            ('set token = "', digest[:40], '" here', code, 1),
            ("found in the log: ", f"AKIA{upper[:16]}", " and more", prose, 1),
            ("word ", f"AKIA{upper[8:24]}", " word", prose, 1),
            ("api_key: ", mixed[:32], "\n", code, 1),
            ('secret="', mixed[:24], '"', code, 1),
            ("Authorization: token ", f"ghp_{mixed[:36]}", " ", code, 1),
            ("passwd=", digest[20:20 + 10 + k % 9], " word", prose, 1),
            ("fixed in commit ", digest[:40], " last week", prose, 0),
            ("sha256 ", digest, " of the file", prose, 0),
            ("paid by card ", number[:16], " in May", prose, 0),
            ("word ", number[:16], " word", prose, 0),
            ("invoice ", number[20:34], " of the year", prose, 0),
            ("request uuid ", f"{digest[:8]}-{digest[8:12]}-{digest[12:16]}-{digest[16:20]}-{digest[20:32]}", " done", prose, 0),
            ("password=", f"changeme{number[:4]}", " to start", prose, 0),
            ("token = \"", f"your-token-goes-here-{k}", '"', code, 0),
            ("AWS key ", f"AKIA{upper[:9]}EXAMPLE", " as in the manual", "docs/manual", 0),
            ('password = "', f"{digest[:16]}", '"', "tests/fixtures/login.py", 0),
            ("see https://host.example/", f"some-long-article-name-{number[:3]}", " for more", prose, 0),
            ("function ", f"convertInternalValue{k}", "(x)", code, 0),
            ("on ", f"20{10 + k % 15}-0{1 + k % 9}-1{k % 10}T10-00-00", " it ran", prose, 0),
            ("image base64 ", mixed + mixed[:20], "==", prose, 0),
            ("the word ", f"internationalisation{k}", " is long", prose, 0),
        ):
            rows.append((before, value, after, path, secret))
    return rows


def train(spark: SparkSession, words: list[tuple[str, int]], findings: list[tuple] | None = None, trees: int = 40, depth: int = 6, seed: int = 7) -> RandomForestClassificationModel:
    """A random forest over labelled findings (before, value, after, path, secret)."""
    rows = spark.createDataFrame(findings or labelled_findings(), "before string, value string, after string, path string, label int")
    table = with_features(rows, words).withColumn("label", F.col("label").cast("double"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(vectors)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """A row for each candidate: id, start, end, value_sha256 (the value itself is not passed on), probability,
    secret."""
    words = dictionary(docs, text_col)
    model = train(docs.sparkSession, words)
    table = with_features(candidates(docs, id_col, text_col, path_col), words)
    rows = table.select("id", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), *FEATURES)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    chance = vector_to_array("probability")[1]
    return scored.select("id", "start", "end", "value_sha256", chance.alias("chance")).select(
        "id", "start", "end", "value_sha256", F.col("chance").alias("probability"), (F.col("chance") >= threshold).alias("secret")
    )
