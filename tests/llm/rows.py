"""Awkward documents: nulls in any column, empty and very long texts, ties, repeated rows, columns with clashing names."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, place string, digest string, size long, words string, "
    "keys string, root string, score string, hit string, _hits string, _verdict string, key string, lane string, path string, row_id string"
)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
NEAR = BASE.replace("alpha30", "changed")


def awkward(spark):
    extra = (None, "x", "y", 1, "z", "k", "r", "s", "h", "h", "v", "k", "l", "p", "r")
    rows = [
        (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (None, "text without id", "en", "b"), (None, None, None, None),
        (5, "A Repeated Row", "en", "b"), (5, "A Repeated Row", "en", "b"), (6, "a repeated row", "fr", "b"), (7, LONG, "en", "a"),
        (8, BASE, "en", "c"), (9, BASE, "en", "c"), (10, NEAR, "en", "c"), (11, "é É ß", "de", "c"), (12, "É É ß", "de", "c"),
    ]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *extra[:15]) for i, t, lang, s in rows], SCHEMA)


def none(spark):
    return awkward(spark).limit(0)
