"""Operator 13, audit of how the sources of a language differ, by in-mapper stripes.

Every partition folds whole documents into hash stripes, term -> (documents with it,
occurrences by source) per language; beyond ``STRIPES`` terms the stripes spill into the
shuffle and the fold starts anew.  Stripes are merged by key (language, term), those of
terms in fewer than ``min_docs`` documents go, and every merged stripe directly gives its
share of each divergence between two sources and its own divergence from the language.

With ``V`` kept terms in a language and ``N`` occurrences of kept terms in a group (a
source of the language, or all of it), a term with ``c`` occurrences there has
``p = 1 + floor(10^9 (c + 1) / (N + V))``; the divergence of ``p`` from ``q`` is
``floor((p - q)^2 / q)``.  All of it is integer arithmetic.  A source without a term
differs from the others by a constant there, so a stripe costs its own entries times the
sources of the language, not all pairs of sources.

Merged stripes are dealt by a hash of the term into buckets of about ``ENTRIES`` entries,
so that a language holding most rows is many tasks; sums of buckets are added up by key.

Defined cases: null text, language and source are read as ``''``; a group without any
term is listed with the constants; a language without kept terms has pair values 0 and
no ``term`` rows; repeated documents count each; an empty table gives no rows; other
columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, stored, tidied, tidied_group

#: Maximal runs of ASCII letters and non-ASCII characters, on UTF-8 bytes.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Stripes that a task holds before it spills them.
STRIPES = 150_000
#: (term, source) entries of a bucket of merged stripes, and cells of a block of it.
ENTRIES, CELLS = 200_000, 1 << 21
SCALE_STEPS, SCALE_STEP = 3, 1000       # 10^9 in steps that stay in 64 bits
ROWS = 1 << 16

FLAT = "lang string, term string, source string, n long, docs long"
PARTS = "lang string, source string, part string, item string, value long"


def fold(batches, limit: int):
    """Stripes of a partition as rows (language, term, source, occurrences, documents):
    a stripe's documents stand on its first row.  A row without a term lists a group."""
    held: dict[str, dict[bytes, list]] = {}
    groups: set = set()
    n_held = 0
    for whole in batches:
        for batch in slices(whole):
            found: dict[tuple, tuple[Counter, Counter]] = {}
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                          batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = TERM.findall(text.lower())
                total, docs = found.setdefault((lang, source), (Counter(), Counter()))
                total.update(terms)
                docs.update(set(terms))
            for (lang, source), (total, docs) in found.items():
                groups.add((lang, source))
                stripes = held.setdefault(lang, {})
                before = len(stripes)
                for term, n in total.items():
                    stripe = stripes.get(term)
                    if stripe is None:
                        stripes[term] = [docs[term], {source: n}]
                    else:
                        stripe[0] += docs[term]
                        by = stripe[1]
                        by[source] = by.get(source, 0) + n
                n_held += len(stripes) - before
            if n_held > limit:
                yield from spill(held)
                held, n_held = {}, 0
    yield from spill(held)
    if groups:
        langs, sources = zip(*sorted(groups), strict=True)
        yield flat_batch(langs, [None] * len(langs), sources, [0] * len(langs), [0] * len(langs))


def spill(held):
    columns: tuple = ([], [], [], [], [])
    for lang, stripes in held.items():
        for term, (docs, by) in stripes.items():
            for source, n in by.items():
                for column, value in zip(columns, (lang, term, source, n, docs), strict=True):
                    column.append(value)
                docs = 0
            if len(columns[0]) >= ROWS:
                yield flat_batch(*columns)
                columns = ([], [], [], [], [])
    if columns[0]:
        yield flat_batch(*columns)


def flat_batch(langs, terms, sources, n, docs) -> pa.RecordBatch:
    return pa.record_batch([pa.array(langs, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                            pa.array(sources, pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                           names=["lang", "term", "source", "n", "docs"])


def merged_stripes(df: DataFrame, min_docs: int = 3, lang_col: str = "lang", source_col: str = "source",
                   text_col: str = "text", limit: int = STRIPES) -> DataFrame:
    """``lang, term, docs, counts`` per kept term; the row without a term has the groups
    of its language, with 0 occurrences."""
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                       for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    flat = rows.mapInArrow(tidied(lambda batches: fold(batches, limit)), FLAT)
    # one exchange by (language, term) serves both levels
    by_source = (flat.repartition("lang", "term").groupBy("lang", "term", "source")
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts"))
            .where(F.col("term").isNull() | (F.col("docs") >= min_docs)))


def share(counts: np.ndarray, total) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), exact for totals below 9 * 10^15."""
    rest, out = counts + 1, np.zeros_like(counts)
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        out = out * SCALE_STEP + rest // total
        rest = rest % total
    return out + 1


def divergence(p, q):
    d = p - q
    return d * d // q


def pair_sums(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Divergence of source a (row) from source b (column), summed over the terms (rows
    of ``counts``)."""
    p, has = share(counts, totals), counts > 0
    none = share(np.zeros_like(totals), totals)
    seen = has.astype(np.int64)
    n = seen.sum(0)
    without = len(counts) - (n[:, None] + n[None, :] - seen.T @ seen)
    out = without * divergence(none[:, None], none[None, :])
    for a in np.flatnonzero(n):
        mine = p[has[:, a]]
        own = mine[:, a: a + 1]
        out[a] += divergence(own, mine).sum(0)
        out[:, a] += (divergence(mine, own) * ~has[has[:, a]]).sum(0)
    return out


def emit(stripes: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Shares of a bucket's stripes in the divergences of a language's sources, and the
    bucket's terms that can be among a source's ``top``."""
    order = np.argsort(groups.column("source").to_numpy(zero_copy_only=False))
    names = groups.column("source").take(pa.array(order))
    totals = groups.column("total").to_numpy()[order] + groups.column("terms").to_numpy()[order]
    lang_total = int(groups.column("total").to_numpy().sum() + groups.column("terms")[0].as_py())
    n_sources = len(names)
    pairs = np.zeros((n_sources, n_sources), np.int64)
    out = []
    step = max(1, CELLS // n_sources)
    for at in range(0, stripes.num_rows, step):
        block = stripes.slice(at, step)
        entries = block.column("counts").combine_chunks()
        row = np.repeat(np.arange(len(entries)), np.diff(entries.offsets.to_numpy()))
        flat = entries.flatten()
        column = pc.index_in(flat.field("source"), names.combine_chunks()).to_numpy()
        counts = np.zeros((len(entries), n_sources), np.int64)
        counts[row, column] = flat.field("n").to_numpy()
        pairs += pair_sums(counts, totals)
        p, q = share(counts, totals), share(counts.sum(1), lang_total)[:, None]
        value = np.where((counts > 0) & (p > q), divergence(p, q), -1)
        for a in range(n_sources):
            mine = value[:, a]
            least = max(0, np.partition(mine, len(mine) - top)[len(mine) - top]) if len(mine) > top else 0
            pick = np.flatnonzero(mine >= least)
            out.append(part_table(groups, names[a].as_py(), "term", block.column("term").take(pa.array(pick)), mine[pick]))
    for a in range(n_sources):
        others = np.flatnonzero(np.arange(n_sources) != a)
        out.append(part_table(groups, names[a].as_py(), "pair", names.take(pa.array(others)), pairs[a, others]))
    return pa.concat_tables(out)


def part_table(groups: pa.Table, source: str, part: str, items, values: np.ndarray) -> pa.Table:
    n = len(values)
    return pa.table({"lang": pa.array([groups.column("of")[0].as_py()] * n, pa.string()), "source": pa.array([source] * n, pa.string()),
                     "part": pa.array([part] * n, pa.string()), "item": items, "value": pa.array(values, pa.int64())})


def source_divergence(df: DataFrame, min_docs: int = 3, top: int = 200, lang_col: str = "lang", source_col: str = "source",
                      text_col: str = "text", limit: int = STRIPES, entries: int = ENTRIES) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has the divergence of a
    source from every other source of its language, part ``term`` the ``top`` terms by
    which it exceeds its language."""
    stripes = stored(merged_stripes(df, min_docs, lang_col, source_col, text_col, limit), "stripes")
    flat = stripes.select(F.col("lang").alias("of"), F.explode("counts").alias("c"))
    groups = flat.groupBy("of", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    terms = stripes.groupBy(F.col("lang").alias("of")).agg(F.count("term").alias("terms"))
    n_entries = stripes.where(F.col("term").isNotNull()).agg(F.sum(F.size("counts"))).first()[0] or 0
    n_buckets = max(1, -(-n_entries // entries))
    left = stripes.where(F.col("term").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(n_buckets)))
    right = groups.join(terms, "of").withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1)).cast("array<bigint>")))

    def both(mine: pa.Table, of_lang: pa.Table) -> pa.Table:
        return emit(mine, of_lang, top)

    parts = stored(left.groupBy("lang", "bucket").cogroup(right.groupBy("of", "at")).applyInArrow(tidied_group(both), PARTS), "divergence")
    sums = parts.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = parts.where(F.col("part") == "term").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top)
    return sums.withColumn("rank", F.row_number().over(ranks)).unionByName(best)
