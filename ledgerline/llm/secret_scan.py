"""Operator 7, secret scans: base patterns plus structurally confirmed candidates.

Base kinds, each leftmost and non-overlapping: ``assign`` (a credential's name, ``:``
or ``=``, a value of 8 characters or more), ``access`` (``AKIA`` ids of 16 characters
or more), ``hex`` (32 hex digits or more).

Confirmed kinds are reported only when decoding proves them:

* ``jwt``: three base64url parts whose first is a JSON header with ``alg`` and whose
  second is a JSON object;
* ``pem``: an armoured private or public key whose body decodes to DER with lengths
  that nest exactly, or to the OpenSSH key format with lengths that add up; its line
  breaks may be escapes, as in JSON and env files;
* ``der``: a bare base64 or hex run that decodes to such a key;
* ``wrapped``: a base64 or hex run that decodes to text (printable characters and white
  space) which holds a base ``assign`` or ``access`` match itself.

A ``der`` or ``wrapped`` candidate may go over several lines, broken by line ends or
their escapes.  A key ends where its own lengths say; text takes lines of one width and a
last one of at most that width.  A run inside such a span is not reported again.

Spans are code points, end exclusive.  Defined cases: a null text is an empty one;
repeated rows and ids give one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import id_field, slices, texts, tidied

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are taken whole, so shorter ones fail alike

JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*(?:PRIVATE|PUBLIC) KEY)-----"
                 r"((?:[A-Za-z0-9+/=\s]++|\\++(?:[nrt/]|\r?\n|u00(?:0[AaDd9]|2[BbFf]|3[Dd])))++)-----END \1-----")
#: What PEM takes as an escape: a break, or a symbol of the body by its code or as ``\\/``.
ESCAPE = re.compile(r"\\+(?:u00(..)|(/)|[nrt]|\r?\n)")
#: From the shortest base match on: ``token=`` and 8 characters are 14 bytes, 19 symbols and a pad.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{19,}={0,2}")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{2}){12,}(?![0-9A-Fa-f])|(?<![0-9A-Fa-f])(?:[0-9A-F]{2}){12,}(?![0-9A-Fa-f])")

#: Between the lines of one candidate: a line end, or escapes of line ends.
BREAK = re.compile(r"[ \t]*+(?:(?:\\++[nr])++(?:\\?\r?\n)?|\\?\r?\n)[ \t]*+")


def _lines(symbol: str, pad: str = "") -> re.Pattern:
    """Runs of ``symbol`` on consecutive lines, or on one that follows an escape."""
    more = f"{BREAK.pattern}{symbol}++"
    start = rf"(?:(?<!{symbol})(?<!\\)|(?<=\\)(?![nr]))"
    return re.compile(rf"(?:(?<=\\[nr]){symbol}++(?:{more})*+|{start}{symbol}++(?:{more})++){pad}")


BASE64_LINES, HEX_LINES = _lines("[A-Za-z0-9+/]", "={0,2}"), _lines("[0-9A-Fa-f]")
#: Symbols of the shortest base match in base64; width from which on a line is taken for one of several.
LEAST, WIDE = 19, 60

#: Kinds in the order that ties at one start take.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "wrapped")
_RANK = {k: i for i, k in enumerate(KINDS)}

OPENSSH = b"openssh-key-v1\0"
#: DER: nested at most so deep.
DEPTH = 16


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _json_part(part: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _der_items(raw: bytes, at: int, end: int, depth: int) -> list[int] | None:
    """Tags at one level of DER if every length nests exactly in ``raw[at:end]``."""
    tags = []
    while at < end:
        if end - at < 2 or depth > DEPTH:
            return None
        tag, size = raw[at], raw[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or end - at < n:
                return None
            size = int.from_bytes(raw[at: at + n], "big")
            at += n
        if size > end - at:
            return None
        if tag & 0x20 and _der_items(raw, at, at + size, depth + 1) is None:
            return None
        tags.append(tag)
        at += size
    return tags


def _openssh_size(read: Callable[[int], bytes]) -> int:
    """Bytes of an OpenSSH key by its own lengths; ``read`` gives 4 bytes from an offset on
    (fewer at the end)."""
    at = len(OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        field = read(at)
        if len(field) < 4:
            return 0
        at += 4 + int.from_bytes(field, "big")
    field = read(at)
    if len(field) < 4:
        return 0
    at += 4
    for _ in range(min(int.from_bytes(field, "big"), 16) + 1):  # public keys, then the private part
        field = read(at)
        if len(field) < 4:
            return 0
        at += 4 + int.from_bytes(field, "big")
    return at


def key_size(raw: bytes) -> int:
    """Bytes of the key at the start of ``raw`` by its own lengths; 0 if there is none."""
    if raw.startswith(OPENSSH):
        return _openssh_size(lambda at: raw[at: at + 4])
    if len(raw) < 6 or raw[0] != 0x30:
        return 0
    n = raw[1] & 0x7F if raw[1] & 0x80 else 0
    return 2 + n + (int.from_bytes(raw[2: 2 + n], "big") if n else raw[1]) if n <= 4 else 0


def is_key(raw: bytes) -> bool:
    """A DER key (one sequence over all bytes, with integers, bit or octet strings or an
    algorithm inside) or an OpenSSH key whose fields add up."""
    if raw.startswith(OPENSSH):
        return key_size(raw) == len(raw)
    if len(raw) < 16 or raw[0] != 0x30 or _der_items(raw, 0, len(raw), 0) != [0x30]:
        return False
    head = 2 + (raw[1] & 0x7F if raw[1] & 0x80 else 0)
    inner = _der_items(raw, head, len(raw), 1) or []
    return len(inner) >= 2 and inner[0] in (0x02, 0x30) and any(t in (0x02, 0x03, 0x04) for t in inner[1:])


def _from_base64(run: str) -> bytes | None:
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _holds_secret(raw: bytes) -> bool:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return False
    return "".join(text.split()).isprintable() and any(k != "hex" for *_, k in base_spans(text))


def _from_hex(run: str) -> bytes | None:
    return None if len(run) % 2 else bytes.fromhex(run)


def _pem_body(body: str) -> str:
    return "".join(ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else m[2] or "", body).split())


def line_spans(text: str, pattern: re.Pattern, decode: Callable[[str], bytes | None], symbols: int) -> list[tuple[int, int, str]]:
    """Keys and texts over lines of ``pattern``; 3 bytes are ``symbols`` symbols."""
    out = []
    for m in pattern.finditer(text):
        if m.end() - m.start() < LEAST:
            continue
        breaks = [b.span() for b in BREAK.finditer(text, *m.span())]
        at = list(zip([m.start(), *(b for _, b in breaks)], [*(a for a, _ in breaks), m.end()], strict=True))
        whole = "".join([text[a:b] for a, b in at]).rstrip("=")
        size = [b - a for a, b in at]
        edge = [0, *(min(e, len(whole)) for e in accumulate(size))]
        line = {e: k for k, e in enumerate(edge)}
        i, tried = 0, 0  # lines before ``tried`` are in a block that held no text
        while i < len(at):
            last, kind = _key_end(whole, edge[i], line, decode, symbols), "der"
            if last is None and i >= tried:
                last, tried = _text_end(whole, edge, size, i, decode)
                kind = "wrapped"
            if last is not None:
                out.append((at[i][0], at[last - 1][1], kind))
                i = tried = last
            else:
                i += 1
    return out


def _key_end(whole: str, at: int, line: dict[int, int], decode: Callable[[str], bytes | None], symbols: int) -> int | None:
    """The line after a key that begins at ``at`` and ends with a line."""
    left = (len(whole) - at) // 4 * 4
    head = decode(whole[at: at + min(left, 60)]) or b""

    def read(offset: int) -> bytes:
        # only the groups of 3 bytes that hold the 4 bytes
        group, skip = divmod(offset, 3)
        part = whole[at + group * symbols: at + min(left, (group + 2) * symbols)]
        return (decode(part) or b"")[skip: skip + 4]

    size = _openssh_size(read) if head.startswith(OPENSSH) else key_size(head)
    end = at - (-size * symbols // 3)
    if end == at or end not in line:
        return None
    raw = decode(whole[at:end])
    return line[end] if raw is not None and is_key(raw) else None


def _text_end(whole: str, edge: list[int], size: list[int], i: int, decode: Callable[[str], bytes | None]) -> tuple[int | None, int]:
    """The line after a text that begins with line ``i``, and the line after the lines of
    its width."""
    end = i + 1
    while end < len(size) and size[end] == size[i]:
        end += 1

    def holds(to: int) -> bool:
        raw = decode(whole[edge[i]: edge[to]]) if edge[to] - edge[i] >= LEAST else None
        return raw is not None and _holds_secret(raw)

    ends = [end + 1, end] if end < len(size) and size[end] < size[i] else [end]
    if end == i + 1 and size[i] < WIDE:
        ends.sort()  # a short line that is a text alone does not take the word below it
    return next((to for to in ends if holds(to)), None), end


def _inside(span: tuple, spans: list[tuple[int, int, str]]) -> bool:
    """Whether one of ``spans`` (by start, not overlapping) holds ``span``."""
    k = bisect_right(spans, span[0], key=lambda s: s[0])
    return k > 0 and span[1] <= spans[k - 1][1]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates that decode to what they look like."""
    out = []
    if "eyJ" in text:
        for m in JWT.finditer(text):
            head, body, _ = m[0].split(".")
            if isinstance((_json_part(head) or {}).get("alg"), str) and _json_part(body) is not None:
                out.append((m.start(), m.end(), "jwt"))
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            raw = _from_base64(_pem_body(m[2]))
            if raw is not None and is_key(raw):
                out.append((m.start(), m.end(), "pem"))
    armoured = [s for s in out if s[2] == "pem"]
    for pattern, lines, decode, symbols in ((BASE64, BASE64_LINES, _from_base64, 4), (HEX_ANY, HEX_LINES, _from_hex, 6)):
        joined = [s for s in line_spans(text, lines, decode, symbols) if not _inside(s, armoured)]
        out += joined
        for m in pattern.finditer(text):
            raw = decode(m[0])
            if raw is None:
                continue
            kind = "der" if is_key(raw) else "wrapped" if _holds_secret(raw) else None
            if kind and not _inside(m.span(), joined):
                out.append((m.start(), m.end(), kind))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans of a text, by start, then kind."""
    if not text:
        return [], []
    order = lambda s: (s[0], _RANK[s[2]], s[1])
    base = base_spans(text)
    return sorted(base, key=order), sorted(base + confirmed_spans(text), key=order)


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans`` per row."""
    schema = T.StructType([id_field(df, id_col), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("n_spans", T.LongType())])

    def find(batches):
        for whole in batches:
            for batch in slices(whole):
                rows = [scan(t) for t in batch.column("text").to_pylist()]
                count = lambda kind: pa.array([sum(k == kind for *_, k in base) for base, _ in rows], pa.int64())  # noqa: B023, E731
                yield pa.record_batch([batch.column("id"), *[count(k) for k in KINDS[:3]],
                                       pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                                       pa.array([written(spans) for _, spans in rows], pa.string()),
                                       pa.array([len(spans) for _, spans in rows], pa.int64())], names=schema.names)

    return texts(df, id_col, text_col).mapInArrow(tidied(find), schema)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every maximal run of found spans replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    for a, b, _ in scan(text)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def redacted(text: Column, mark: str = "[SECRET]") -> Column:
    """Column form of :func:`redact` (null stays null)."""
    @F.arrow_udf(T.StringType())
    def run(col: pa.Array) -> pa.Array:
        return pa.array([redact(t, mark) for t in col.to_pylist()], pa.string())
    return run(text)
