"""Operator 11: held-out quality, no leaks, a direct loop over windows, defined cases."""

import zlib

from ledgerline.llm.toxicity import AT, PAD, WINDOW, Distance, calibrated, learn_toxicity, own_segments, score_toxicity, toxicity, words_of
from tests.llm.helpers import EDGE_TEXTS, by_id, empty, frame

SF = "/root/testdata/sf0.01"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_quality(spark):
    docs, labels = tables(spark)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    got = by_id(toxicity(docs, labels))
    assert len(got) == docs.count()
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == r.held_out for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= AT) for r in got.values())
    held = [(toxic[i], r.predicted) for i, r in got.items() if r.held_out and toxic.get(i) is not None]
    caught = sum(t and p for t, p in held)
    assert caught / sum(t for t, _ in held) > 0.6
    assert sum(p and not t for t, p in held) / sum(not t for t, _ in held) < 0.03


def test_only_learning_labels_matter(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    rows = labels.select("doc_id", "toxic").collect()
    turned = spark.createDataFrame([(r.doc_id, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.toxic) for r in rows], "doc_id long, toxic int")
    changed = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source")
    assert {i: tuple(r) for i, r in by_id(toxicity(docs, labels)).items()} == {i: tuple(r) for i, r in by_id(toxicity(changed, turned)).items()}


def test_every_window_counts():
    """The evidence is the largest gain of any window of the whole text."""
    common = [f"{a}{b}{c}" for a in ("th", "onder", "wi", "re") for b in ("ing", "lan", "so", "quel") for c in ("", "ly", "est", "mark", "ou")]
    tail = (" " + " ".join(common) + " ").encode()
    distance = Distance((tail, b" wretch  villain " + tail))
    clean = " ".join(common[i * i % len(common)] + ("s" if i % 3 else "") for i in range(2_000)) + " "
    assert distance.evidence(clean)[0] < 2
    for text in ("wretch " + clean, clean + " villain", clean + "wretch villain " + clean):
        data = " ".join(words_of(text)).encode()
        cuts, at = [], 0
        while at < len(data):
            to = min(len(data), at + WINDOW)
            while to < len(data) and data[to - 1: to] != b" ":
                to -= 1
            cuts.append(b" " + data[at:to] + PAD)
            at = to
        gains = sorted((len(distance.ordinary.compress(w)) - len(distance.toxic.compress(w)) for w in cuts), reverse=True)
        evidence, worst = distance.evidence(text)
        assert evidence == gains[0] + 0.25 * max(0, gains[1]) > 0
        assert "wretch" in worst or "villain" in worst
    assert distance.evidence("y" * 5000)[1] is None


def test_segments_and_threshold():
    assert own_segments([(30.0, "lowe"), (30.0, "lowei"), (20.0, "loweix "), (9.0, "scum "), (3.0, "the ")], 8) == ["scum ", "lowei"]
    from collections import Counter
    f1, threshold = calibrated(Counter({(5.0, 1): 8, (2.0, 1): 1, (0.0, 1): 1, (2.0, 0): 5, (0.0, 0): 85}), {0: 900, 1: 100})
    assert 2.0 < threshold < 5.0 and f1 > 0.85


def test_defined_cases(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    model = learn_toxicity(docs, labels)
    got = by_id(score_toxicity(frame(spark), model))
    assert len(got) == len(EDGE_TEXTS)
    assert got[0].evidence == got[1].evidence == got[4].evidence == 0 and got[0].predicted == 0 and got[0].score == got[1].score
    twice = score_toxicity(frame(spark, [(1, "You moron."), (1, "You moron."), (None, "idiot")]), model).collect()
    assert len(twice) == 3 and len({r.score for r in twice if r.doc_id == 1}) == 1
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity(docs, none).collect()} == {0.0}
    one_class = spark.createDataFrame([(i, 0) for i in range(30)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity(docs, one_class).collect()} == {0}
    assert toxicity(empty(spark), labels).count() == 0
