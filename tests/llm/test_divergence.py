"""Operator 13: direct definition in exact arithmetic, spills, buckets, defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerline.llm.divergence import source_divergence
from tests.llm.helpers import ASCII_LOWER, EDGE_TEXTS, empty

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(ASCII_LOWER))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}

        def p(s, t, lang=lang, kept=kept, total=total):
            return 1 + 10 ** 9 * (counts[lang, s][t] + 1) // (total[s] + len(kept))

        q = {t: 1 + 10 ** 9 * (sum(counts[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        for s in sources:
            parts = {"pair": [(-sum((p(s, t) - p(o, t)) ** 2 // p(o, t) for t in kept), o.encode()) for o in sources if o != s],
                     "term": [(-((p(s, t) - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and p(s, t) > q[t]]}
            for part, items in parts.items():
                ranked = sorted(items)[: top if part == "term" else None]
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(ranked, 1)}
    return out


def frame(spark, rows):
    rows = [(i, *r, "clash", 1, 2) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, term string, n long, bucket int").repartition(3)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in df.dtypes] == ["string", "string", "string", "string", "bigint", "int"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("limit, entries", [(150_000, 200_000), (20, 50)])
def test_equals_definition(spark, limit, entries):
    rng = random.Random(5)
    words = ["the", "The", "Émile", "émile", "日本", "x1y", "it's", "zebra"] + [f"w{chr(97 + i)}{chr(97 + i // 26)}" for i in range(90)]
    rows = [(rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["hot"] * 6 + ["a", "b", "é", None]),
             " ".join(rng.choices(words, k=rng.randint(0, 40)))) for _ in range(120)]
    rows += [("en", "a", t) for t in EDGE_TEXTS] + [("fr", "only", "une deux"), ("es", "a", "uno"), ("es", "b", None)]
    rows += rows[:10]
    assert got(source_divergence(frame(spark, rows), top=7, limit=limit, entries=entries)) == brute(rows, top=7)


def test_large_counts(spark):
    """The shares stay exact where 10^9 times a count leaves 64 bits."""
    import numpy as np

    from ledgerline.llm.divergence import share
    counts = np.array([0, 9, 10 ** 11, 3 * 10 ** 15], np.int64)
    assert share(counts, 8 * 10 ** 15).tolist() == [1 + 10 ** 9 * (int(c) + 1) // (8 * 10 ** 15) for c in counts]


def test_no_rows_no_terms(spark):
    assert source_divergence(empty(spark)).count() == 0
    rows = [("en", "a", None), ("en", "b", "12 34"), ("en", "c", "one")]
    assert got(source_divergence(frame(spark, rows))) == brute(rows)
