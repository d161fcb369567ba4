"""Operator 3, URL filter: rules first, then segmented names and naive Bayes.

The names in a host (runs of letters) are split into words by a unigram Viterbi whose
word counts come from the visible text of all pages.  Only words that occur in a name
are looked up, by a join on the name's substrings, so no vocabulary is shipped whole.
A multinomial naive Bayes over segmented host words and path tokens, trained on every
row that a rule decides, judges the rows that no rule decides.  Names are segmented
once per distinct name, hosts and paths are scored once each.

Tokens: a host's words as ``h:word``, a path's lower-cased runs of letters or digits as
``p:token``, with all-digit runs as one token.

Defined cases: a null url, or one without ``://``, has empty host and path and is
judged by the class prior; repeated rows give one result row each; without any
rule-decided row every score is 0 and the verdict ``allow``; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, stored, tidied

#: Words up to this length are looked up whole, longer ones by their first letters; distinct
#: words counted in a task before they are sent on.
SHORT_WORD, FLUSH_WORDS = 20, 200_000

OPENS = re.compile(r"<(script|style)\b", re.I)
CLOSERS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
LETTERS = re.compile(r"[^\W\d_]+")


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://`` (empty without one)."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule ``(verdict, host, path)`` that fits."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def visible_text(html: str) -> str:
    """The text between tags; scripts, styles and comments go with their content.  One
    that is never closed loses its opening tag only, and a ``<`` that no ``>`` follows is
    text.  Each closer is looked for once: where there is none, none follows later."""
    out, at, missing = [], 0, set()
    while (start := html.find("<", at)) >= 0:
        end = -1
        opened = OPENS.match(html, start)
        if opened and (name := opened[1].lower()) not in missing:
            closer = CLOSERS[name].search(html, opened.end())
            if closer:
                end = closer.end()
            else:
                missing.add(name)
        if end < 0 and "comment" not in missing and html.startswith("<!--", start):
            end = html.find("-->", start + 4) + 3
            if end < 3:
                missing.add("comment")
                end = -1
        if end < 0:
            end = html.find(">", start + 1) + 1
        if end <= 0:
            break
        out += (html[at:start], " ")
        at = end
    out.append(html[at:])
    return "".join(out)


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """``word, n`` over the visible text of all pages."""
    def count(batches):
        def sent(c):
            return pa.record_batch([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

        seen: Counter = Counter()
        for whole in batches:
            for batch in slices(whole, "html"):
                for html in batch.column("html").to_pylist():
                    if html:
                        seen.update(LETTERS.findall(visible_text(html).lower()))
                    if len(seen) > FLUSH_WORDS:
                        yield sent(seen)
                        seen = Counter()
        yield sent(seen)

    raw = pages.select(F.col(html_col).cast("string").alias("html")).mapInArrow(tidied(count), "word string, n long")
    return raw.groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, words: dict[str, int], total: int) -> list[str]:
    """The most probable split of a name; an unknown run of letters costs ten times more
    with each letter.  Ties go to the longer last word."""
    ten, lengths = log(10), sorted({len(w) for w in words}, reverse=True)
    best = [(0.0, 0)]
    # start of the cheapest unknown run, whatever its end
    run = (0.0, 0)
    for end in range(1, len(name) + 1):
        cost, start = best[run[1]][0] + log(total) + (end - run[1] - 1) * ten, run[1]
        for size in lengths:
            n = words.get(name[end - size:end]) if size <= end else None
            if n:
                cost, start = min((cost, start), (best[end - size][0] + log(total / n), end - size))
        best.append((cost, start))
        run = min(run, (cost - end * ten, end))
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segmented(names: DataFrame, unigrams: DataFrame) -> DataFrame:
    """``name, words`` of each distinct name."""
    total = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    starts = names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at"))
    parts = starts.select("name", F.explode(F.sequence(F.lit(1), F.least(F.lit(SHORT_WORD), F.length("name") - F.col("at") + 1))).alias("len"), "at")
    parts = parts.select("name", F.expr("substring(name, at, len)").alias("word")).distinct()
    found = parts.join(unigrams.where(F.length("word") <= SHORT_WORD), "word").select("name", "word", "n")
    # a longer word begins at a place with its first letters
    beginning = SHORT_WORD + 1
    heads = (starts.where(F.length("name") - F.col("at") + 1 >= beginning)
             .select("name", "at", F.col("name").substr(F.col("at"), F.lit(beginning)).alias("head")))
    long = (unigrams.where(F.length("word") >= beginning).select("word", "n", F.substring("word", 1, beginning).alias("head")).join(heads, "head")
            .where(F.col("name").substr(F.col("at"), F.length("word")) == F.col("word")).select("name", "word", "n").distinct())
    known = found.unionByName(long).groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(batches):
        for batch in batches:
            found = [viterbi(name, {k["word"]: k["n"] for k in known or []}, total)
                     for name, known in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("name"), pa.array(found, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(known, "name", "left").mapInArrow(tidied(split), "name string, words array<string>")


def _path_tokens(path: Column) -> Column:
    runs = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.transform(runs, lambda t: F.concat(F.lit("p:"), F.when(t.rlike(r"^\p{N}+$"), F.lit("0")).otherwise(t)))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row; ``score`` is the log odds of
    allow over block that naive Bayes gives the url (the verdict where no rule fits)."""
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    urls = urls.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = urls.withColumn("rule", text).withColumn("ruled", verdict)

    # words of each distinct host
    hosts = judged.groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))
    hosts = stored(hosts, "hosts")
    of_host = hosts.select("host", F.explode(F.filter(F.split("host", r"[^\p{L}]+"), lambda t: t != "")).alias("name"))
    names = segmented(of_host.select("name").distinct(), stored(word_counts(pages, html_col), "unigrams"))
    words = of_host.join(names, "name").select("host", F.explode("words").alias("w")).select("host", F.concat(F.lit("h:"), "w").alias("token"))
    words = stored(words.groupBy("host", "token").agg(F.count(F.lit(1)).alias("n")), "host-words")

    paths = judged.groupBy("path").agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))
    tokens = stored(paths.select("path", "allow", "block", F.explode_outer(_path_tokens(F.col("path"))).alias("token"))
                    .groupBy("path", "allow", "block", "token").agg(F.count("token").alias("n")), "path-tokens")

    # counts of each token in either class, over all rows that a rule decides
    counted = (words.join(hosts, "host").select("token", "n", "allow", "block")
               .unionByName(tokens.where("token is not null").select("token", "n", "allow", "block")))
    model = stored(counted.groupBy("token").agg(F.sum(F.col("n") * F.col("allow")).alias("a"), F.sum(F.col("n") * F.col("block")).alias("b"))
                   .where("a + b > 0"), "url-model")
    size, a, b = model.agg(F.count(F.lit(1)), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    n_allow, n_block = hosts.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    trained = n_allow + n_block > 0
    prior = log((n_allow + 1) / (n_block + 1)) if trained else 0.0
    unseen = log((b + size + 1) / (a + size + 1)) if trained else 0.0
    odds = F.log((F.coalesce("a", F.lit(0)) + 1) / (F.coalesce("b", F.lit(0)) + 1)) + F.lit(unseen)

    def scored(rows: DataFrame, key: str) -> DataFrame:
        part = F.when(F.col("token").isNotNull(), F.col("n") * odds)
        return rows.join(model, "token", "left").groupBy(key).agg(F.coalesce(F.sum(part), F.lit(0.0)).alias(f"{key}_score"))

    out = (judged.join(scored(words, "host"), "host", "left").join(scored(tokens, "path"), "path", "left")
           .withColumn("score", F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))))
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("ruled", F.when(F.col("score") >= 0, "allow").otherwise("block")).alias("verdict"), "score")
