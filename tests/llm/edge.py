"""Documents that are awkward in every way the operators must bear, and plain versions of what they compute."""

import random
import re

WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew alder beech".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "en", "y"]) for _ in range(n))


def base_rows():
    long = "\n".join(prose(i, 200) for i in range(60))
    near = prose(1, 120).split()
    changed = [*near[:60], "other", *near[61:]]
    return [
        (1, prose(1, 120)),
        (2, prose(1, 120).upper()),  # the same words
        (3, " ".join(changed)),
        (4, prose(2, 90)),
        (5, None),
        (6, ""),
        (7, "   \n\t "),
        (8, long),
        (9, "two words"),
        (10, "two words"),
        (10, "two words"),  # a repeated row
        (11, "Ünï çödé ☃ " * 30),
        (None, prose(3, 50)),
        (None, None),
        (12, "..."),
        (13, prose(4, 40) + "\n" + prose(5, 40)),
        (4, prose(6, 40)),  # an identifier that comes again with another text
    ]


def documents(spark, rows=None, clash=True):
    """With the columns of documents, and others whose names the operators use inside."""
    rows = base_rows() if rows is None else rows
    data = [(i, t, "en", f"src{(i or 0) % 3}" if i != 4 else None, len(t or "")) for i, t in rows]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if clash:
        from pyspark.sql import functions as F

        for name in ("row", "id", "part", "label", "text_key", "class_id", "n", "words", "score", "tree", "__id", "__text", "__row", "uid"):
            df = df.withColumn(name, F.lit("x"))
    return df


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def shingles(text, size=5):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
