"""Operator 3 against a plain definition of rules, Viterbi and naive Bayes."""

import itertools
import math
import random
import re
import time
from collections import Counter

import pytest

from ledgerline.llm.queries import URL_RULES
from ledgerline.llm.url_filter import LETTERS, url_verdicts, viterbi, visible_text

SF = "/root/testdata/sf0.001"
HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(rows):
    counts = Counter(w for _, _, html in rows for w in LETTERS.findall(HIDDEN.sub(" ", html or "").lower()))
    total, judged = sum(counts.values()) + 1, []
    for i, url, _ in rows:
        host, path = parts(url)
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        tokens = ["h:" + w for name in re.findall(r"[^\W\d_]+", host) for w in viterbi(name, counts, total)]
        tokens += ["p:" + ("0" if t.isdigit() else t) for t in re.findall(r"[^\W_]+", path.lower())]
        judged.append((i, host, path, rule, verdict, tokens))
    a = Counter(t for *_, v, ts in judged if v == "allow" for t in ts)
    b = Counter(t for *_, v, ts in judged if v == "block" for t in ts)
    size, na, nb = len(set(a) | set(b)), sum(v == "allow" for *_, v, _ in judged), sum(v == "block" for *_, v, _ in judged)
    out = []
    for i, host, path, rule, verdict, tokens in judged:
        score = 0.0
        if na + nb:
            score = math.log((na + 1) / (nb + 1)) + sum(
                math.log((a[t] + 1) / (b[t] + 1)) + math.log((sum(b.values()) + size + 1) / (sum(a.values()) + size + 1)) for t in tokens)
        out.append((i, host, path, rule, verdict or ("allow" if score >= 0 else "block"), round(score, 6)))
    return sorted(out, key=repr)


def check(df):
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 6)) for r in url_verdicts(df, URL_RULES).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_pages(spark):
    check(spark.read.parquet(f"{SF}/pages.parquet"))


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.org", "x://example.org/es/", "x://notexample.org/es/", "x://a.example.org/en/1?q",
            "x://example.org/en/2", "x://com/fr/x", "x://a.com/de/#f", "x://b.net/a://b", "x://h?u=/de/", "x://com#/de/", "x://é.net/ü",
            "x://" + "ab" * 300 + ".net/" + "p/" * 2000, "x://a.com/de/", "x://a.com/de/"]
    rows = [(i if i else None, u, "<p>Example ab page</p>" if i % 2 else None, "clash") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    check(df)
    check(df.where("url like '%net%'"))
    check(df.limit(0))


def test_viterbi_is_the_best_of_all_splits():
    counts, total = {"red": 50, "car": 40, "cars": 5, "redc": 1, "a": 90, "pet": 8, "carpet": 9}, 204
    for name in ("redcar", "carpet", "redcars", "zzred", "acar", "a"):
        def cost(split):
            return sum(math.log(total / counts[w]) if w in counts else math.log(total) + (len(w) - 1) * math.log(10) for w in split)
        options = []
        for cuts in itertools.product([0, 1], repeat=len(name) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(name)]
            options.append([name[x:y] for x, y in zip(at, at[1:])])
        assert math.isclose(cost(viterbi(name, counts, total)), min(map(cost, options)))


@pytest.mark.parametrize("piece", ["<script ", "<!-- ", "<style>", "<", "</script ", "<script></scrip", "<!--->"])
def test_hostile_html_takes_one_scan(piece):
    html = piece * (1_000_000 // len(piece))
    begun = time.perf_counter()
    visible_text(html)
    assert time.perf_counter() - begun < 3


def test_visible_text_is_what_the_pattern_leaves():
    rng = random.Random(4)
    pieces = ["<script>", "</script >", "<SCRIPT x>", "<style", ">", "</style>", "<!--", "-->", "<b>", "</b>", "word", " ", "<", "<!-->", "--", "scripts", "<scripts>"]
    for _ in range(3000):
        html = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert visible_text(html) == HIDDEN.sub(" ", html), html


def test_long_words(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    rows = [(1, f"http://{word}x.net/", f"<p>{word} {word}</p>"), (2, f"http://my{word}.net/", "<p>my x</p>"), (3, "http://" + "zq" * 40 + ".net/", None)]
    check(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert viterbi(word + "x", {word: 2, "x": 1}, 9) == [word, "x"]
    assert viterbi("zq" * 40, {}, 100) == ["zq" * 40]
    begun = time.perf_counter()
    viterbi("ab" * 100_000, {"ab": 3}, 100)
    assert time.perf_counter() - begun < 5
