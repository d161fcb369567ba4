"""Property: the event row hash equals sha256(source_file | canonical JSON)
with the canonical form of Python's json.dumps(sort_keys=True,
separators=(",", ":"), ensure_ascii=False), on random nested records."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators import bronze as B

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=8)
floats = st.one_of(st.floats(allow_nan=False, allow_infinity=False, allow_subnormal=False), st.integers(-10**6, 10**6).map(float),
                   st.integers(-10**7, 10**7).map(lambda k: k / 1000))
scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**12, 10**12), st.integers(-10**40, 10**40), floats, text)
values = st.recursive(scalars, lambda c: st.one_of(st.lists(c, max_size=3),
                                                   st.dictionaries(text, c, max_size=3)), max_leaves=8)
records = st.dictionaries(st.sampled_from(["event_id", "event_ts", "user_id", "props", "x", "é"]),
                          values, max_size=5)


@settings(max_examples=40, deadline=None, derandomize=True)
@given(st.lists(records, min_size=1, max_size=6))
def test_row_hash_matches_canonical_definition(spark, recs):
    lines = [("events/f.jsonl", json.dumps(r)) for r in recs]
    df = spark.createDataFrame(lines, "source_file string, value string")
    got = [r["row_hash"] for r in B.parse_event_lines(df, mode="permissive").select("row_hash").collect()]
    want = [hashlib.sha256(("events/f.jsonl|" + json.dumps(r, sort_keys=True, separators=(",", ":"),
                                                            ensure_ascii=False)).encode()).hexdigest()
            for r in recs]
    assert got == want


def hashes(spark, texts, mode="failfast"):
    df = spark.createDataFrame([("f", t) for t in texts], "source_file string, value string")
    return [r["row_hash"] for r in B.parse_event_lines(df, mode=mode).select("row_hash").collect()]


def wanted(texts):
    return [hashlib.sha256(("f|" + json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"),
                                              ensure_ascii=False)).encode()).hexdigest() for t in texts]


def test_numbers_keep_their_python_form(spark):
    texts = [f'{{"x": {n}}}' for n in (
        "1", "1.0", "1.50", "-0.0", "0.0", "0", "1e20", "1E5", "1e15", "1e16", "123456789012345678.0", "9007199254740993.0", "0.0001", "0.00001",
        "1.5e-5", "2e-3", "1.7976931348623157e308", "2.2250738585072014e-308", "100.0", "1e22", "1e23", "0.1", "1e-7", "12e2",
        "12345678901234567890", "-123456789012345678901234567890123456789012", "1e400", "-1e400")]
    texts += ['{"a": "1.0", "b": ' + json.dumps("x\\") + ', "c": 2.50, "d": ' + json.dumps('say "1.0" 3.50 \\') + ', "e": [1.0, {"f": -2.0e0}]}',
              "{" + json.dumps('k\\"2.0') + ': 2.0, "1.0": 1.0}', '{"props": {"v": 1.0}, "s": ' + json.dumps("\x01\x02x \x1f") + "}",
              '{"s": ' + json.dumps("\x01\x021.5") + ', "t": ' + json.dumps("\x01\x02\x02\x02") + ', "u": ' + json.dumps("\\u0001\x02") + ', "z": 1.0}',
              '{"s": ' + json.dumps("\x01\x021.5") + "}",
              '{"s": "' + "1.5 " * 20_000 + '", "z": 3.10}']
    got = hashes(spark, texts)
    for t, g, w in zip(texts, got, wanted(texts), strict=True):
        assert g == w, t[:80]
    assert len(set(hashes(spark, ['{"x": 1}', '{"x": 1.0}']))) == 2


def test_props_keep_floats_and_zero_is_falsy(spark):
    df = spark.createDataFrame([("f", '{"event_id": "a", "props": {"v": 1.0, "w": 1e20}}'), ("f", '{"event_id": "b", "props": -0.0}')],
                               "source_file string, value string")
    got = {r["event_id"]: r["props"] for r in B.parse_event_lines(df).collect()}
    assert got == {"a": '{"v":1.0,"w":1e+20}', "b": "{}"}


def test_escape_case_fix_leaves_escaped_backslashes_alone(spark):
    recs = [{"a": "\\u000B"}, {"a": "\x0b\x0b\\\x0b\x1f"}, {"a": "\\\\\x0e"}, {"b": ["\x1a", {"c": "\x0f"}]}]
    lines = [("f", json.dumps(r)) for r in recs]
    df = spark.createDataFrame(lines, "source_file string, value string")
    got = [r["row_hash"] for r in B.parse_event_lines(df).select("row_hash").collect()]
    want = [hashlib.sha256(("f|" + json.dumps(r, sort_keys=True, separators=(",", ":"),
                                              ensure_ascii=False)).encode()).hexdigest() for r in recs]
    assert got == want


@settings(max_examples=30, deadline=None, derandomize=True)
@given(st.lists(st.tuples(*[st.text(alphabet=st.sampled_from(["a", "1", " ", "\t", "\n", "\xa0", "　", "\x1c", "-", "é"]),
                                     max_size=4) for _ in range(4)]), min_size=1, max_size=5))
def test_billing_hash_matches_python_strip(spark, rows):
    df = spark.createDataFrame([("billing/f.csv",) + r for r in rows],
                               "source_file string, billing_date string, user_id string, event string, plan_id string")
    got = [r["row_hash"] for r in df.select(B.billing_row_hash().alias("row_hash")).collect()]
    want = [hashlib.sha256(("billing/f.csv|" + "|".join(
        f"{k}={v.strip()}" for k, v in zip(("billing_date", "user_id", "event", "plan_id"), r))).encode()).hexdigest()
        for r in rows]
    assert got == want


@settings(max_examples=30, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.integers(-3_000_000, 30_000_000),
                          st.integers(-5, 40).map(lambda k: k * 500_000)), min_size=1, max_size=10))
def test_lateness_rounds_like_integer_cast_of_epoch_seconds(spark, diffs_us):
    import datetime as dt
    from decimal import ROUND_HALF_UP, Decimal

    from pyspark.sql import functions as F

    from ledgerline.functions.time import lateness_sec
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(base, base + dt.timedelta(microseconds=d)) for d in diffs_us],
                               "event_ts timestamp, received_ts timestamp")
    got = [r[0] for r in df.select(lateness_sec(F.col("received_ts"), F.col("event_ts"))).collect()]
    want = [max(int((Decimal(d) / Decimal(10**6)).quantize(Decimal(1), rounding=ROUND_HALF_UP)), 0)
            for d in diffs_us]
    assert got == want


@settings(max_examples=30, deadline=None, derandomize=True)
@given(st.lists(values, min_size=1, max_size=8))
def test_top_level_key_test_equals_python(spark, docs):
    from pyspark.sql import functions as F

    from ledgerline.functions.json import has_top_key
    texts = [json.dumps(d) for d in docs]
    df = spark.createDataFrame([(t,) for t in texts], "props string")
    got = [r[0] for r in df.select(has_top_key(F.col("props"), "x")).collect()]
    want = [isinstance(d, dict) and "x" in d for d in docs]
    assert got == want


def test_keys_sort_by_code_point(spark):
    # UTF-16 order puts a character beyond U+FFFF before U+E000
    recs = [{"props": {"": None, "\U00010000": 1.5}}, {"￿": {"\U0001f600": 1, "": 2}, "\U0001f600": 0}]
    texts = [json.dumps(r) for r in recs] + [json.dumps(recs[1], ensure_ascii=False)]
    assert hashes(spark, texts) == wanted(texts)
    df = spark.createDataFrame([("f", texts[0])], "source_file string, value string")
    assert B.parse_event_lines(df).first()["props"] == '{"":null,"\U00010000":1.5}'


def test_lines_are_parsed_once(spark):
    """One parse of a line and no pattern is in the plan, whatever is read from it."""
    df = spark.createDataFrame([("f", "{}")], "source_file string, value string")
    plan = B.parse_event_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 1 and plan.count("digests(") == 1 and "regexp_replace" not in plan


def test_repeated_keys_and_odd_constants_are_malformed(spark):
    texts = ['{"a": 1, "a": 2}', '{"a": NaN}', '{"a": [1, {"b": 1, "b": 1}]}']
    assert hashes(spark, texts, "permissive") == [hashlib.sha256(f"f|malformed|{t}".encode()).hexdigest() for t in texts]
    for t in texts:
        try:
            hashes(spark, [t])
        except Exception as e:  # noqa: BLE001
            assert "MALFORMED" in str(e) or "DUPLICATE" in str(e), str(e)[:200]
        else:
            raise AssertionError(t)
