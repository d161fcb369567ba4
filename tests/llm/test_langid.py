"""Operator 9: held-out accuracy, no leaks, defined cases."""

import zlib

import regex

from ledgerline.llm.langid import Compressors, keep_identified, language_id, learn_dictionaries
from tests.llm.helpers import by_id, empty, frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = by_id(language_id(docs))
    assert len(got) == len(lang)
    held = [r for r in got.values() if r.held_out]
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == r.held_out for i, r in got.items())
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() > 0.99 * len(lang)


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    plain = spark.createDataFrame(docs)
    turned = spark.createDataFrame([(r.doc_id, r.text, "zz" if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.lang) for r in docs],
                                   "doc_id long, text string, lang string")
    assert {i: tuple(r) for i, r in by_id(language_id(plain)).items()} == {i: tuple(r) for i, r in by_id(language_id(turned)).items()}


def test_numbers_are_not_letters(spark):
    rows = [(0, "½ ² Ⅷ 12 ٣"), (4, "ª a"), (8, "x²"), *[(i, f"some words in text {i}") for i in range(100, 140)]]
    got = by_id(language_id(frame(spark, rows)))
    assert got[0].lang_pred == "und" and got[0].score == 0
    assert got[4].lang_pred == got[8].lang_pred == "en"


def test_equals_a_loop_over_the_dictionaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = learn_dictionaries(docs)
    known = Compressors(learned)
    got = by_id(language_id(docs))
    for r in docs.collect():
        words = " ".join(regex.findall(r"\p{L}+", (r.text or "").lower())).encode()
        want = known.sizes(words)[0][1] if words else "und"
        assert got[r.doc_id].lang_pred == want


def test_defined_cases(spark):
    got = by_id(language_id(frame(spark)))
    assert got[0].lang_pred == got[1].lang_pred == got[4].lang_pred == "und"
    assert got[0].score == 0 and got[0].rejected
    assert got[5].lang_pred == "en" and got[5].score == 1 and not got[5].rejected
    unlabelled = spark.createDataFrame([(1, "some text", None), (None, "text", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id(unlabelled).collect()} == {"und"}
    assert language_id(empty(spark)).count() == 0
