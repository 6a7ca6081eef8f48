import re

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s1")), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One"), (4, "One"), (5, "One"), (None, "no id here at all"), (None, None),
    (6, "a b c d"), (7, "A  b\tC D"), (8, "déjà vu … 漢字 😀 <|endoftext|> 'tis"), (9, "word " * 30_000), (10, "x" * 5000), (11, "x" * 5000 + "y"),
]
#: names that operators use inside
CLASHING = ["n", "class", "key", "kind", "spans", "row_key", "sketch", "line", "leaf", "shape", "block", "pos", "gram", "left", "bytes",
            "salt", "rank", "length", "component", "range", "ord", "at", "id", "vec", "query", "words", "ids", "drops"]
