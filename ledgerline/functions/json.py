"""JSON column helpers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts that a Python loader treats as "falsy" and replaces by
# an empty object when it stores `props`.
FALSY_JSON = ["null", "{}", "[]", '""', "0", "0.0", "-0.0", "false"]


def canonical_digest(prefix: Column, text: Column) -> Column:
    """``hash, props`` of each JSON text.  ``hash``: the hex SHA-256 of ``prefix``, ``|`` and the
    text in canonical form, which is Python's ``json.dumps(sort_keys=True, separators=(",", ":"),
    ensure_ascii=False)``: keys in code point order, no blanks, floats in their shortest form,
    integers of any length.  ``props``: the canonical text of the top-level key ``props``, null
    without that key.  Null for a text that is not JSON; text after the first value, which
    the platform's parser leaves unread, is left out here too.

    The form is defined by Python's writer, so Python writes it, one Arrow batch at a time.
    The same steps as column expressions (numbers marked before parsing, escapes and digits
    rewritten after it) parsed and printed each line several times."""
    def digests(prefixes: pa.Array, texts: pa.Array) -> pa.Array:
        import json
        from hashlib import sha256

        def record(pairs):
            found = dict(pairs)
            if len(found) < len(pairs):
                raise ValueError("repeated key")
            return found

        def refuse(name):
            raise ValueError(name)

        read = json.JSONDecoder(object_pairs_hook=record, parse_constant=refuse).raw_decode
        write = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode
        hashes, props = [], []
        for prefix, text in zip(prefixes.to_pylist(), texts.to_pylist(), strict=True):
            try:
                value = None if text is None else read(text.lstrip(" \t\r\n"))[0]
            except (ValueError, RecursionError):
                text = None
            own = text is not None and isinstance(value, dict) and "props" in value
            # a lone surrogate becomes a question mark, as on the platform
            hashes.append(None if text is None or prefix is None else sha256(f"{prefix}|{write(value)}".encode(errors="replace")).hexdigest())
            props.append(write(value["props"]).encode(errors="replace").decode() if own else None)
        return pa.StructArray.from_arrays([pa.array(hashes, pa.string()), pa.array(props, pa.string())], ["hash", "props"])

    return F.arrow_udf(digests, "hash string, props string")(prefix, text)


def props_or_empty(props_text: Column) -> Column:
    """Missing, null or falsy props become the empty object ``{}``."""
    return F.when(props_text.isNull() | props_text.isin(FALSY_JSON), F.lit("{}")) \
        .otherwise(props_text)


def has_top_key(json_text: Column, key: str) -> Column:
    """True when the JSON object has top-level ``key`` (even with a null value).

    Nested keys do not count; a non-object gives false.
    """
    return F.coalesce(F.array_contains(F.json_object_keys(json_text), F.lit(key)),
                      F.lit(False))


def top_keys(json_text: Column) -> Column:
    """Array of the top-level keys of a JSON object (empty for a non-object)."""
    return F.coalesce(F.json_object_keys(json_text), F.array().cast("array<string>"))
