"""Operators 2, 5 and 8 against the tokenizers' own libraries."""

import io
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import pieces
from ledgerline.llm.piece_codec import decode_pieces, encode_pieces, piece_digests
from ledgerline.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from ledgerline.llm.token_counts import token_counts
from ledgerline.llm.token_files import EliasFano, TokenFile, file_bytes, read_file, token_file_digests, write_token_files
from tests.llm.helpers import EDGE_TEXTS, by_id, empty, frame


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    return lambda t: lib.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))


def _random_texts(n):
    rng = random.Random(5)
    letters = list("aB é.,'\n\t  ▁1日 s!×")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("run_bytes", [37, 4 << 20])
def test_pieces_encode_exactly_as_the_libraries(monkeypatch, bpe, sp, run_bytes):
    monkeypatch.setattr(pieces, "BATCH_BYTES", run_bytes)
    texts = _random_texts(800) + [t for t in EDGE_TEXTS if run_bytes > 100 or not t or len(t) < 10_000]
    for coder, of in ((pieces.ByteLevelBPE(tokenizer_path(BYTE_BPE)), bpe),
                      (pieces.SentencePieces(tokenizer_path(PIECE_BPE)), lambda t: sp.encode(t or ""))):
        counts, ids = coder.batch(pa.array(texts, pa.string()))
        at = 0
        for text, n in zip(texts, counts.tolist()):
            assert ids[at: at + n].tolist() == of(text), repr(text)[:80]
            at += n


def test_a_small_piece_table_is_emptied_and_refilled(bpe):
    coder = pieces.ByteLevelBPE(tokenizer_path(BYTE_BPE))
    coder.table.limit = 50
    texts = _random_texts(200)
    for lo in range(0, 200, 20):
        counts, ids = coder.batch(pa.array(texts[lo: lo + 20]))
        assert ids.tolist() == [i for t in texts[lo: lo + 20] for i in bpe(t)]
        assert len(coder.table.slots) <= 400


def test_byte_classes_agree_with_the_pre_tokenizer():
    """Every code point that follows a cut blank is no white space to the library."""
    from tokenizers import Tokenizer
    pre = Tokenizer.from_file(tokenizer_path(BYTE_BPE)).pre_tokenizer
    for c in [*range(0x21, 0x7F), *range(0xC0, 0x800)]:
        assert [s for _, s in pre.pre_tokenize_str("a " + chr(c))] in ([(0, 1), (1, 3)],), hex(c)


def test_token_counts(spark, bpe):
    got = by_id(token_counts(frame(spark), tokenizer_path(BYTE_BPE)))
    assert len(got) == len(EDGE_TEXTS)
    for i, text in enumerate(EDGE_TEXTS):
        n = len(bpe(text))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 512)
    assert token_counts(empty(spark), tokenizer_path(BYTE_BPE)).count() == 0


def test_pieces_round_trip(spark, sp):
    docs = frame(spark)
    got = by_id(piece_digests(docs, tokenizer_path(PIECE_BPE)))
    coded = encode_pieces(docs, tokenizer_path(PIECE_BPE))
    ids, back = by_id(coded), by_id(decode_pieces(coded, tokenizer_path(PIECE_BPE)))
    for i, text in enumerate(EDGE_TEXTS):
        want = sp.encode(text or "", add_bos=True, add_eos=True)
        assert ids[i].ids == want and back[i].text == sp.decode(want)
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()
    assert piece_digests(empty(spark), tokenizer_path(PIECE_BPE)).count() == 0


def test_token_files(spark, bpe):
    rows = list(enumerate(EDGE_TEXTS)) + [(None, "no id"), (3, "again"), (-7, "below zero")]
    got = token_file_digests(frame(spark, rows), tokenizer_path(BYTE_BPE)).collect()
    want = sorted((zlib.crc32(np.array([*bpe(t), 0], "<u4").tobytes()), -1 if i is None else i) for i, t in rows)
    assert sorted((r.ids_crc32, -1 if r.doc_id is None else r.doc_id) for r in got) == want
    got.sort(key=lambda r: r.start)
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert token_file_digests(empty(spark), tokenizer_path(BYTE_BPE)).count() == 0


def test_manifest_names_files_that_hold_all_documents(spark):
    docs = frame(spark)
    manifest = write_token_files(docs, tokenizer_path(BYTE_BPE)).collect()
    assert sum(r.docs for r in manifest) == docs.count()
    ids, borders, flat = read_file(open(manifest[0].path, "rb").read())
    assert len(ids) == manifest[0].docs and borders.all()[-1] == flat.size == manifest[0].ids


@pytest.mark.parametrize("n,step", [(0, 1), (1, 1), (5, 0), (700, 3), (3000, 10_000), (1000, 1 << 40)])
def test_elias_fano(n, step):
    rng = np.random.default_rng(n)
    values = np.cumsum(rng.integers(0, step + 1, n))
    ef, rest = EliasFano.read(memoryview(EliasFano.of(values).to_bytes() + b"rest"))
    assert bytes(rest) == b"rest" and ef.all().tolist() == values.tolist()
    for i in range(0, n, 7):
        assert ef.select(i) == values[i]
        assert ef.values(i, min(n, i + 300)).tolist() == values[i: i + 300].tolist()
    with pytest.raises(IndexError):
        ef.values(0, n + 1)
    if n > 500:
        assert len(EliasFano.of(values).to_bytes()) * 8 < n * (2.5 + max(0, np.log2(values[-1] / n)) + 1) + 400


@pytest.mark.parametrize("nulls,n", [(0, 900), (1, 700), (300, 300), (5, 0), (257, 2)])
def test_documents_by_select(nulls, n):
    rng = np.random.default_rng(n)
    docs = [None] * nulls + np.cumsum(rng.integers(0, 3, n)).tolist()
    counts = rng.integers(1, 40, len(docs))
    ids = rng.integers(0, 1 << 16, int(counts.sum()))
    ends = np.cumsum(counts)
    f = TokenFile(io.BytesIO(file_bytes(docs, counts, ids, 2)))
    for i in range(0, len(docs), 13):
        assert f.document(i).tolist() == ids[ends[i] - counts[i]: ends[i]].tolist()
    for size in (1, 7, 256, 300, None):
        runs = list(f.runs(size))
        assert [d for r in runs for d in r[0]] == docs
        assert np.concatenate([r[1] for r in runs]).tolist() == (ends - counts).tolist()
        assert np.concatenate([r[2] for r in runs]).tolist() == ends.tolist()
        assert np.concatenate([r[3] for r in runs]).tolist() == ids.tolist()


def test_file_of_nothing():
    assert list(TokenFile(io.BytesIO(file_bytes([], np.zeros(0, np.int64), np.zeros(0, np.uint32), 2))).runs()) == []
    ids, borders, flat = read_file(file_bytes([], np.zeros(0, np.int64), np.zeros(0, np.uint32), 2))
    assert ids == [] and borders.n == 0 and flat.size == 0
