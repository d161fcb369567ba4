"""Operator 11, toxicity by compression distance with zstandard dictionaries.

Two raw-content dictionaries are trained, one on toxic and one on ordinary text.  Each
holds the *segments* (whole words and word beginnings of 4 to 6 letters) that its class
has at least ``LIFT`` times as often as the other by a log-likelihood ratio, and behind
them, at equal distances in both, the words most documents have.  Every whole text is
reduced to its lower-cased words and cut into windows of ``WINDOW`` bytes at blanks; a
window's gain is the bytes the toxic dictionary saves over the ordinary one.  A text's
evidence is its largest gain and a quarter of the second.

Segments are counted over documents, each run of three words only in the first document
that has it, so that copies do not count again.  Calibration is cross-fitted: dictionaries
of either half of the sample measure the other half, and the least ratio (of ``RATIOS``)
and the threshold with the best F1, weighted to the classes' true sizes, are taken.
``score`` is logistic in the evidence and 0.7 at the threshold.

Bounds: at most ``SAMPLE`` labelled documents a class (by a hash of the id), whole;
``SEGMENTS`` segments and ``COMMON`` bytes of common words a dictionary.  All documents are
scored, whole.

Defined cases: null and empty texts have evidence 0; an id with several labels has the
largest; null labels and null ids teach nothing and are not held out; where a class has no
sample every score is 0; repeated rows are scored each; an empty table gives no rows;
other columns take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import AFTER_TASK, id_field, slices, stored, texts, tidied

#: Labelled documents of each class (ordinary, toxic) that are learned from.
SAMPLE = (3000, 1000)
#: Least log-likelihood ratios that calibration chooses from, least lift of a segment.
RATIOS, LIFT = (25.0, 15.0, 8.0), 4.0
SEGMENTS, COMMON, COMMON_WORDS = 500, 1 << 15, 12_000
WINDOW = 128
#: Share of the second largest gain, step of the logistic score, score at the threshold.
SECOND, STEEP, AT = 0.25, 1.0, 0.7
PREFIXES = (4, 5, 6)

#: Behind every window: zstandard starts no match in the last bytes of its input.
PAD = b" " * 9

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def segments_of(word: str) -> list[str]:
    """The whole word, closed by a blank, and its beginnings."""
    return [word + " ", *[word[:n] for n in PREFIXES if len(word) > n]]


def held_out(id_col: str):
    """True where crc32 of the id as text has remainder 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """Stored ``id, text, toxic, half`` of the sampled documents, and the labelled
    documents of each class that are not held out."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("of")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
             .withColumn("h", F.xxhash64(F.col("of").cast("string"))))
    known = stored(known, "toxicity-labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [known.where(F.col("toxic") == c).orderBy("h", "of").limit(SAMPLE[c]) for c in (0, 1)]
    chosen = stored(picked[0].unionByName(picked[1]), "toxicity-sample-ids")
    # at most sum(SAMPLE) ids
    rows = texts(docs, id_col, text_col).where(F.col("text").isNotNull()).join(F.broadcast(chosen), F.col("id") == F.col("of"))
    half = (F.shiftright(F.col("h"), 5) % 2 != 0).cast("int")
    return stored(rows.select("id", "text", "toxic", half.alias("half")), "toxicity-sample"), sizes


def segment_counts(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``segment, ordinary0, ordinary1, toxic0, toxic1`` documents by class and half, and
    ``word, docs``."""
    def split(batches):
        for whole in batches:
            for batch in slices(whole):
                rows: dict[tuple, set] = {}
                for i, (text, toxic, half) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("text", "toxic", "half")], strict=True)):
                    words = words_of(text)
                    rows[i, toxic, half] = set(zip(["", *words[:-1]], words, [*words[1:], ""], strict=True))
                ids = batch.column("id").cast(pa.string()).to_pylist()
                flat = [(ids[i], toxic, half, *run) for (i, toxic, half), runs in rows.items() for run in runs]
                if flat:
                    yield pa.record_batch([pa.array(c) for c in zip(*flat, strict=True)], names=["doc", "toxic", "half", "before", "word", "after"])

    runs = sample.mapInArrow(tidied(split), "doc string, toxic long, half long, before string, word string, after string")
    first = runs.groupBy("toxic", "before", "word", "after").agg(F.min(F.struct("doc", "half")).alias("d"))
    words = stored(first.select("toxic", "word", "d.doc", "d.half").distinct(), "toxicity-words")
    beginnings = [F.when(F.length("word") > n, F.substring("word", 1, n)) for n in PREFIXES]
    each = words.withColumn("segment", F.explode(F.array_compact(F.array(F.concat("word", F.lit(" ")), *beginnings))))
    of = {f"{name}{half}": F.when((F.col("toxic") == c) & (F.col("half") == half), 1) for c, name in ((0, "ordinary"), (1, "toxic")) for half in (0, 1)}
    counts = (each.select("segment", "toxic", "half", "doc").distinct().groupBy("segment")
              .agg(*[F.count(cond).alias(name) for name, cond in of.items()]))
    return counts, words.groupBy("word").agg(F.countDistinct("doc").alias("docs"))


def ratio(a, b, n_a: int, n_b: int):
    """Log-likelihood ratio of ``a`` of ``n_a`` documents against ``b`` of ``n_b``; 0 where the
    lift is too small."""
    share = n_a / (n_a + n_b)

    def term(k, e):
        return F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    g = 2 * (term(a, (a + b) * share) + term(b, (a + b) * (1 - share)))
    return F.when((a + 0.5) / n_a > LIFT * (b + 0.5) / n_b, g).otherwise(0.0)


def own_segments(ranked: list[tuple[float, str]], least: float) -> list[str]:
    """Segments of at least a ratio, best last; of those that extend one another only
    the best (of equals the longest)."""
    taken: list[str] = []
    for g, segment in sorted(ranked, key=lambda r: (-r[0], -len(r[1]), r[1])):
        if g >= least and not any(segment.startswith(t) or t.startswith(segment) for t in taken):
            taken.append(segment)
    return taken[::-1]


def dictionaries(own: dict[int, list[str]], common: list[str]) -> tuple[bytes, bytes]:
    """Contents for ordinary and toxic text: own segments, then shared common words, the
    commonest last."""
    special = set(own[0]) | set(own[1])
    shared, size = [], 0
    for word in common:
        if not special.intersection(segments_of(word)):
            shared.append(word.encode())
            size += len(shared[-1]) + 1
            if size > COMMON:
                break
    tail = b" " + b" ".join(reversed(shared)) + b" "
    return tuple(b"".join(b" " + s.encode() for s in own[c]) + tail for c in (0, 1))


class Distance:
    """Evidence of a text: the bytes a toxic dictionary saves in its windows."""

    def __init__(self, contents: tuple[bytes, bytes]):
        import zstandard as z

        def compressor(content):
            params = z.ZstdCompressionParameters.from_level(6, dict_size=len(content), source_size=WINDOW, min_match=4, write_content_size=False,
                                                            write_checksum=False, write_dict_id=False)
            return z.ZstdCompressor(dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
        self.ordinary, self.toxic = map(compressor, contents)

    def evidence(self, text: str | None) -> tuple[float, str | None]:
        """The evidence and the window of the largest gain (none without a gain)."""
        data = " ".join(words_of(text)).encode()
        ordinary, toxic = self.ordinary.compress, self.toxic.compress
        best, second, where = 0, 0, None
        at, end = 0, len(data)
        while at < end:
            to = min(end, at + WINDOW)
            if to < end:
                to = data.rfind(b" ", at + 1, to) + 1 or (data.find(b" ", to) + 1 or end)
            window = b" " + data[at:to] + PAD
            gain = len(ordinary(window)) - len(toxic(window))
            if gain > best:
                best, second, where = gain, best, window
            elif gain > second:
                second = gain
            at = to
        return best + SECOND * second, where.decode().strip() if where else None


_READY: dict[tuple, Distance] = {}


def _distance(contents: tuple[bytes, bytes]) -> Distance:
    if contents not in _READY:
        _READY[contents] = Distance(contents)
    return _READY[contents]


AFTER_TASK.append(_READY.clear)


def calibrated(counts: Counter, sizes: dict[int, int]) -> tuple[float, float]:
    """Best F1 and its threshold, from (evidence, toxic) counts weighted to the sizes."""
    weight = {c: sizes[c] / max(1, sum(n for (_, k), n in counts.items() if k == c)) for c in (0, 1)}
    hits = {0: 0.0, 1: 0.0}
    found = (0.0, math.inf)
    values = sorted({x for x, _ in counts if x > 0}, reverse=True)
    for x in values:
        for c in (0, 1):
            hits[c] += counts[x, c] * weight[c]
        f1 = 2 * hits[1] / (hits[1] + hits[0] + sizes[1])
        if f1 > found[0]:
            found = (f1, x - SECOND / 2)
    return found


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict | None:
    """Dictionaries and threshold, or None where a class has no sample."""
    sample, sizes = sample_of(docs, labels, id_col, text_col, label_col)
    present = {(r["toxic"], r["half"]): r["n"] for r in sample.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    n = {c: {half: present.get((c, half), 0) for half in (0, 1)} for c in (0, 1)}
    if not sum(n[0].values()) or not sum(n[1].values()):
        return None
    counts, words = segment_counts(sample)
    counts = stored(counts, "toxicity-segments")
    common = [r["word"] for r in words.orderBy(F.desc("docs"), "word").limit(COMMON_WORDS).collect()]

    def ranked(c: int, halves: tuple) -> list[tuple[float, str]]:
        a, b = (sum(F.col(f"{'toxic' if k else 'ordinary'}{h}") for h in halves) for k in (c, 1 - c))
        n_a, n_b = (max(1, sum(n[k][h] for h in halves)) for k in (c, 1 - c))
        rows = counts.select("segment", ratio(a, b, n_a, n_b).alias("g")).where(F.col("g") >= min(RATIOS))
        return [(r["g"], r["segment"]) for r in rows.orderBy(F.desc("g"), "segment").limit(SEGMENTS).collect()]

    found = {halves: [ranked(c, halves) for c in (0, 1)] for halves in ((0,), (1,), (0, 1))}

    def contents(halves: tuple, least: float) -> tuple[bytes, bytes]:
        return dictionaries({c: own_segments(found[halves][c], least) for c in (0, 1)}, common)

    # each half is measured by the dictionaries of the other
    pairs = {(half, k): contents((1 - half,), least) for half in (0, 1) for k, least in enumerate(RATIOS)}
    shared = sample.sparkSession.sparkContext.broadcast(pairs)

    def measure(batches):
        for batch in batches:
            rows = [(toxic, k, _distance(shared.value[half, k]).evidence(text)[0])
                    for text, toxic, half in zip(*[batch.column(c).to_pylist() for c in ("text", "toxic", "half")], strict=True) for k in range(len(RATIOS))]
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["toxic", "k", "x"])

    measured = sample.mapInArrow(tidied(measure), "toxic long, k long, x double").groupBy("toxic", "k", "x").agg(F.count("*").alias("n")).collect()
    tried = []
    for k, least in enumerate(RATIOS):
        of = Counter({(r["x"], r["toxic"]): r["n"] for r in measured if r["k"] == k})
        f1, threshold = calibrated(of, sizes)
        tried.append((f1, -k, threshold, least))
    f1, _, threshold, least = max(tried)
    return {"contents": contents((0, 1), least), "threshold": threshold if f1 > 0 else 3.0 - SECOND / 2}


def score_toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence, worst`` per row; ``worst`` is the window
    with the largest gain."""
    schema = T.StructType([id_field(docs, id_col), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("evidence", T.DoubleType()), T.StructField("worst", T.StringType())])
    # dictionaries of at most COMMON bytes and SEGMENTS segments
    shared = docs.sparkSession.sparkContext.broadcast(model)
    level = math.log(AT / (1 - AT))

    def run(batches):
        known = shared.value
        for whole in batches:
            for batch in slices(whole):
                if known is None:
                    found = [(0.0, None)] * batch.num_rows
                    scores = [0.0] * batch.num_rows
                else:
                    distance = _distance(known["contents"])
                    found = [distance.evidence(text) for text in batch.column("text").to_pylist()]
                    scores = [1 / (1 + math.exp(-max(-500.0, STEEP * (x - known["threshold"]) + level))) for x, _ in found]
                yield pa.record_batch([batch.column("id"), batch.column("held"), pa.array(scores, pa.float64()),
                                       pa.array([int(s >= AT) for s in scores], pa.int32()), pa.array([x for x, _ in found], pa.float64()),
                                       pa.array([w for _, w in found], pa.string())], names=schema.names)

    return texts(docs, id_col, text_col, held_out(id_col).alias("held")).mapInArrow(tidied(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Learn from the labelled rows that are not held out, score every row."""
    return score_toxicity(docs, learn_toxicity(docs, labels, id_col, text_col, label_col), id_col, text_col)
