"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, own string, raw string, id bigint, kept string, hits_0 string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß") for _ in range(rng.randint(2, 8))) for _ in range(n))


def texts(seed=5, n=60):
    rng = random.Random(seed)
    passage, line = words(rng, 50), words(rng, 12)
    out = []
    for k in range(n):
        body = words(rng, rng.randint(1, 120))
        if k % 4 == 0:
            body += " " + passage + "\t" + words(rng, 5)
        if k % 5 == 0:
            body += "\n  " + line.upper() + " \n" + words(rng, 3)
        if k % 7 == 0 and out:
            body = out[-1]
        if k % 9 == 0 and out:
            body = out[-1].replace(" ", "  ", 1)
        out.append(body)
    long = words(rng, 30_000)
    return [*out, "", None, " \n\t ", "x" * 50_000, long, long + " end", "a b c", "same line of text\nsame line of text", "same line of text"]


def docs(spark, rows=None):
    rows = list(enumerate(texts())) if rows is None else rows
    rows = rows + [rows[3], rows[3], (None, "a document without an id " * 9), (None, None)] if rows else rows
    full = [(i, t, None, "src0", len(t) if t else None, "own", "raw", 7, "kept", "h") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)
