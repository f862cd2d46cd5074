"""Small tables with what operators must bear, and texts for brute-force comparisons."""

from __future__ import annotations

import random

#: Column names that operators use themselves stand beside those of documents.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, d string, row string, "
    "label string, place string, u string, bucket string, features string"
)
EXTRA = ("x",) * 8


def row(doc_id, text, source="src0"):
    return (doc_id, text, "en", source, None if text is None else len(text), *EXTRA)


def odd_rows():
    long_text = " ".join(f"word{i} is here." for i in range(60_000))
    clean = "\n".join(" ".join(f"word{i}of{j}" for j in range(11)) + "." for i in range(12))
    return [
        row(None, None, None),
        row(None, clean),
        row(1, None),
        row(2, ""),
        row(3, " \n\t \x0b\x0c\r "),
        row(4, "single"),
        row(5, long_text),
        row(6, clean),
        row(6, clean),
        row(7, clean, None),
        row(8, clean.replace("word3of5", "another")),
        row(9, "Ünïcödé ſ K İ \x00 \x1c \x85   \U0001f600 end." * 3),
    ]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def random_texts(seed: int, n: int, words: int = 60, vocabulary: int = 400) -> list[str]:
    """Texts of invented words, some of them edited copies of earlier ones."""
    rnd = random.Random(seed)
    texts: list[str] = []
    for i in range(n):
        if texts and i % 3 == 0:
            ws = rnd.choice(texts).split()
            for _ in range(rnd.choice((0, 1, 1, 2, 3, 5))):
                if ws:
                    ws[rnd.randrange(len(ws))] = f"new{rnd.randrange(10**6)}"
        else:
            ws = [f"w{int(rnd.paretovariate(0.7)) % vocabulary}" for _ in range(rnd.randrange(1, words))]
        texts.append(" ".join(ws))
    return texts
