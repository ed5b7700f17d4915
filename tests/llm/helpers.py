"""Small tables with the odd cases that every operator must take."""

import random

PATH = "/opt/tokenizers/"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, rank string, score string"


def prose(seed, n=120):
    r = random.Random(seed)
    words = ["river", "stone", "green", "walks", "under", "the", "old", "bridge", "while", "many", "birds", "sing",
             "softly", "near", "water", "and", "children", "play", "games", "until", "evening", "falls", "slowly"]
    out = []
    for i in range(n):
        w = r.choice(words) + (str(r.randrange(40)) if r.random() < .3 else "")
        out.append(w + ("." if i % 11 == 10 else ""))
    return " ".join(out).replace(". ", ".\n", 3)


def odd_rows():
    """NULLs, empty and blank texts, ties, repeated rows and ids, a long text, other scripts."""
    a, b = prose(1), prose(2)
    rows = [(1, a), (2, b), (3, None), (4, ""), (5, " \t\n "), (6, a), (6, a), (7, b + " tail"), (None, a), (None, None),
            (8, "x"), (9, "Ünïcödé 日本語 texts – “quoted” ﬁne ΣΑΣ İ"), (10, prose(3, 6000)), (11, "one two three"),
            (12, prose(4)), (12, prose(5)), (13, "a" * 5000), (14, "\x00 \x1c \x85")]
    return [(i, t, "en", None, None if t is None else len(t), 1, "r", "s") for i, t in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
