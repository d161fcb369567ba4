"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = " ".join(f"word{i % 977} and{i % 31}, then." for i in range(20_000))
EDGE_TEXTS = [
    None, "", " ", "\n", "...", "one", "a b c d", "Æ é ü", "日本 語 テスト", "x" * 5_000, LONG, LONG + " tail",
    "the same text twice over here now", "the same text twice over here now", " leading blank", "trailing blank ",
    "two  blanks   three\tand\n\nlines\n the end", "<|endoftext|> inside <s> </s>", "\u2581mark\u2581 \u2581", "it's don't I'll 've",
    "😀 emoji 😀😀", "nul\x00byte",
]


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def frame(spark, rows=None):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] if rows is None else rows
    rows = [(i, t, "en", "x", 1, "clash", 7) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int, words string, row int").repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
