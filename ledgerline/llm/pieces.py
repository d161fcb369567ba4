"""Distinct-piece tables for tokenizers whose tokens never cross certain blanks.

A text is cut at positions where the tokenizer always starts a new token.  The
pieces of a batch are dictionary-encoded by Arrow, each distinct piece is
encoded once by the tokenizer's own library, and the ids are joined back by
position.  The table lives for a task and is emptied when it would hold more than
``TABLE_ROWS`` pieces, so memory is bounded on any corpus.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.common import AFTER_TASK, BATCH_BYTES, text_buffer

#: Most distinct pieces that a task holds at once.
TABLE_ROWS = 300_000
#: Pieces encoded together in one call.
JOIN_PIECES = 2_000

_SPACE, _LINE = 0x20, 0x0A


def grown(a: np.ndarray, size: int) -> np.ndarray:
    """``a`` or a copy, at least doubled, that holds ``size`` items."""
    return a if a.size >= size else np.concatenate([a, np.zeros(max(a.size, size - a.size), a.dtype)])


class PieceTable:
    """Distinct pieces (bytes) -> ids.  ``encode(list of pieces)`` gives flat ids and the
    start and number of each piece's ids in them."""

    def __init__(self, encode, limit: int = TABLE_ROWS):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.used = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.counts = np.zeros(1 << 12, np.int32)

    def rows(self, pieces: list[bytes]) -> np.ndarray:
        """Row of each piece, encoding those not yet in the table."""
        if len(self.slots) + len(pieces) > self.limit:
            self.clear()
        out = list(map(self.slots.get, pieces))
        if None in out:
            new = [i for i, x in enumerate(out) if x is None]
            words = [pieces[i] for i in new]
            ids, starts, counts = self.encode(words)
            at, to = len(self.slots), len(self.slots) + len(new)
            self.ids = grown(self.ids, self.used + ids.size)
            self.starts, self.counts = grown(self.starts, to), grown(self.counts, to)
            self.ids[self.used: self.used + ids.size] = ids
            self.starts[at:to] = self.used + starts
            self.counts[at:to] = counts
            self.used += ids.size
            self.slots.update(zip(words, range(at, to), strict=True))
            for k, i in enumerate(new, at):
                out[i] = k
        return np.array(out, np.int64)


def join_by_position(table: PieceTable, data: np.ndarray, cuts: np.ndarray,
                     ids_wanted: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Ids of the pieces ``data[cuts[i]:cuts[i + 1]]``: the number of ids of each
    piece and, when wanted, all ids in order."""
    pieces = pa.Array.from_buffers(pa.large_binary(), cuts.size - 1,
                                   [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    rows = table.rows(coded.dictionary.to_pylist())
    at = coded.indices.to_numpy(zero_copy_only=False)
    per_piece = table.counts[rows][at].astype(np.int64)
    if not ids_wanted:
        return per_piece, None
    ends = np.cumsum(per_piece)
    total = int(ends[-1]) if ends.size else 0
    take = np.repeat(table.starts[rows][at] - (ends - per_piece), per_piece)
    take += np.arange(total)
    return per_piece, table.ids[take]


class ByteLevelBPE:
    """A ``tokenizers`` file with a byte-level pre-tokenizer, exact and memoised.

    Its pre-tokenizer always starts a token in three places, and texts are cut there:

    * at a blank that a non-blank character follows (next byte printable ASCII or a
      lead byte of U+00C0..U+07FF, where no white space lies);
    * at an ASCII letter after a line feed that printable ASCII precedes;
    * at ASCII punctuation after an ASCII letter.

    A piece of Latin letters, with or without a leading blank, is one pre-token; many
    of them are encoded in one call of the same model with line feeds between.  Texts
    that hold an added token's string, and tokenizers of any other kind, are encoded
    whole by the library.
    """

    LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = Tokenizer.from_file(path)
        self.words = Tokenizer(self.lib.model)
        self.words.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        spec = json.loads(self.lib.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.cuttable = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
                         and spec.get("truncation") is None)
        self.lib.no_truncation()
        self.lib.no_padding()
        vocab = self.lib.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.table = PieceTable(self._encode_pieces)
        code = np.arange(256)
        self.letter = ((code | 0x20) >= ord("a")) & ((code | 0x20) <= ord("z"))
        self.print = (code > 0x20) & (code < 0x7F)
        self.punct = self.print & ~self.letter & ~((code >= ord("0")) & (code <= ord("9")))
        self.safe = self.print | ((code >= 0xC3) & (code < 0xE0))
        # the printable stand-in of each byte in the vocabulary
        alone = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(alone)]
        self.shown = {b: b for b in alone} | {b: 256 + k for k, b in enumerate(rest)} | {_LINE: _LINE}  # line feeds only part pieces here

    def _one_word(self, piece: bytes) -> bool:
        word = piece[1:] if piece[:1] == b" " else piece
        return word.isalpha() or bool(self.LETTERS.fullmatch(piece.decode()))

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        plain = [i for i, p in enumerate(pieces) if self._one_word(p)]
        one = np.zeros(len(pieces), bool)
        one[plain] = True
        rest = np.flatnonzero(~one).tolist()
        flat, counts = [], []
        for at in range(0, len(plain), JOIN_PIECES):
            group = [pieces[i] for i in plain[at: at + JOIN_PIECES]]
            line = b"\n".join(group).decode("latin-1").translate(self.shown)
            ids = np.array(self.words.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            counts.append(np.diff(np.searchsorted(np.cumsum(self.width[ids]), ends, side="right"), prepend=0))
            flat.append(ids)
        for e in self.lib.encode_batch([pieces[i].decode() for i in rest], add_special_tokens=False):
            flat.append(np.array(e.ids, np.uint32))
            counts.append([flat[-1].size])
        by_turn = np.concatenate(counts).astype(np.int64)
        order = np.array(plain + rest, np.int64)
        starts, per_piece = np.zeros((2, len(pieces)), np.int64)
        starts[order] = np.cumsum(by_turn) - by_turn
        per_piece[order] = by_turn
        return np.concatenate(flat), starts, per_piece

    def batch(self, col: pa.Array, ids_wanted: bool = True):
        """Ids per row and, when wanted, the ids of all rows back to back."""
        n = len(col)
        whole = np.full(n, not self.cuttable)
        for content in self.added:
            whole |= pc.match_substring(col.fill_null(""), content).to_numpy(zero_copy_only=False)
        if whole.any():
            parts, counts = [], np.zeros(n, np.int64)
            for i, to in runs(whole):
                if whole[i]:
                    for k in range(i, to):
                        parts.append(np.array(self.lib.encode(col[k].as_py() or "", add_special_tokens=False).ids, np.uint32))
                        counts[k] = parts[-1].size
                else:
                    counts[i:to], ids = self._rows(col.slice(i, to - i), True)
                    parts.append(ids)
            return counts, np.concatenate(parts) if ids_wanted else None
        return self._rows(col, ids_wanted)

    def cuts(self, data: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Flags of the safe cuts at ``lo <= position < hi``."""
        at = max(0, lo - 2)
        part = data[at: hi + 1]
        letter, shown = self.letter[part], self.print[part]
        cut = np.zeros(part.size, bool)
        cut[:-1] = (part[:-1] == _SPACE) & self.safe[part[1:]]
        cut[1:] |= letter[:-1] & self.punct[part[1:]]
        cut[2:] |= shown[:-2] & (part[1:-1] == _LINE) & letter[2:]
        return cut[lo - at: hi - at]

    def _rows(self, col: pa.Array, ids_wanted: bool):
        data, offsets = text_buffer(col)
        return rows_by_pieces(self, data, offsets, ids_wanted)


def rows_by_pieces(coder, data: np.ndarray, offsets: np.ndarray,
                   ids_wanted: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Ids per row of a text buffer.  The buffer is worked on in runs of about
    ``BATCH_BYTES`` that end at safe cuts, so one very long text costs no more memory
    than many short ones."""
    ends, before, parts, done, lo = [], [], [], 0, 0
    while lo < data.size:
        hi = min(data.size, lo + BATCH_BYTES)
        cut = coder.cuts(data, lo, hi)
        inside = offsets[(offsets >= lo) & (offsets < hi)]
        cut[inside - lo] = True
        cut[0] = True
        at = np.flatnonzero(cut) + lo
        if hi < data.size:  # the last piece may go on: leave it to the next run
            if at.size > 1:
                hi, at = int(at[-1]), at[:-1]
            else:  # one piece longer than a run
                hi = lo + 1
                while hi < data.size and not cut_at(coder, data, offsets, hi):
                    hi = next_cut(coder, data, offsets, hi)
        cuts = np.append(at, hi).astype(np.int64)
        per_piece, ids = join_by_position(coder.table, data, cuts, ids_wanted)
        ends.append(cuts[:-1])
        before.append(done + np.cumsum(per_piece) - per_piece)
        done += int(per_piece.sum())
        if ids_wanted:
            parts.append(ids)
        lo = hi
    if not data.size:
        return np.zeros(offsets.size - 1, np.int64), np.zeros(0, np.uint32) if ids_wanted else None
    starts = np.append(np.concatenate(before), done)
    upto = starts[np.searchsorted(np.concatenate(ends), offsets)]
    return np.diff(upto), np.concatenate(parts) if ids_wanted else None


def cut_at(coder, data: np.ndarray, offsets: np.ndarray, at: int) -> bool:
    i = int(np.searchsorted(offsets, at))
    return bool(coder.cuts(data, at, at + 1)[0]) or (i < offsets.size and int(offsets[i]) == at)


def next_cut(coder, data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """First safe cut or row border after ``at`` (the end of the data at the latest)."""
    while True:
        to = min(data.size, at + 1 + BATCH_BYTES)
        found = np.flatnonzero(coder.cuts(data, at + 1, to))
        i = int(np.searchsorted(offsets, at, side="right"))
        border = int(offsets[i]) if i < offsets.size else data.size
        if found.size:
            return min(border, at + 1 + int(found[0]))
        if border <= to or to >= data.size:
            return min(border, data.size)
        at = to - 1


class SentencePieces:
    """A ``sentencepiece`` model whose pieces hold a blank's marker only at their front.

    Texts are cut at each blank that follows another character; a piece without that
    blank gets the library's own leading marker back, so it is encoded as in place.
    Rows that begin or end with a blank, and models that rewrite the text or have pieces
    across markers, are encoded whole by the library.
    """

    MARK = "\u2581"

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.lib.serialized_model_proto())
        rewrite = model.normalizer_spec
        self.cuttable = (not rewrite.precompiled_charsmap and rewrite.add_dummy_prefix
                         and not rewrite.remove_extra_whitespaces and rewrite.escape_whitespaces
                         and not model.trainer_spec.treat_whitespace_as_suffix
                         and not any(self.MARK in p.piece.lstrip(self.MARK) or p.type == 4 for p in model.pieces))
        self.bos, self.eos = self.lib.bos_id(), self.lib.eos_id()
        self.table = PieceTable(self._encode_pieces)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = self.lib.encode([(p[1:] if p[:1] == b" " else p).decode() for p in pieces], num_threads=1)
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(counts.sum()))
        return flat, np.cumsum(counts) - counts, counts

    def cuts(self, data: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Flags of the safe cuts at ``lo <= position < hi``."""
        cut = np.zeros(hi - lo, bool)
        at = max(1, lo)
        before, here = data[at - 1: hi - 1], data[at:hi]
        # 0x81 may be the last byte of the marker itself, written out in the text
        cut[at - lo:] = (here == _SPACE) & (before != _SPACE) & (before != 0x81)
        return cut

    def batch(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per row, without begin and end, and the ids of all rows back to back."""
        data, offsets = text_buffer(col)
        n = offsets.size - 1
        some = np.diff(offsets) > 0
        whole = np.zeros(n, bool)
        whole[some] = (data[offsets[:-1][some]] == _SPACE) | (data[offsets[1:][some] - 1] == _SPACE)
        if not self.cuttable:
            whole[:] = some
        if not whole.any():
            return rows_by_pieces(self, data, offsets, True)
        counts, parts, i = np.zeros(n, np.int64), [], 0
        for i, to in runs(whole):
            if whole[i]:
                for k in range(i, to):
                    parts.append(np.array(self.lib.encode(data[offsets[k]:offsets[k + 1]].tobytes().decode()), np.uint32))
                    counts[k] = parts[-1].size
            else:
                counts[i:to], ids = rows_by_pieces(self, data[offsets[i]:offsets[to]], offsets[i:to + 1] - offsets[i], True)
                parts.append(ids)
        return counts, np.concatenate(parts)


def runs(flags: np.ndarray):
    """``(start, end)`` of the runs of equal flags."""
    edges = np.flatnonzero(np.diff(flags)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), flags.size], strict=True)


_LOADED: dict[tuple, ByteLevelBPE | SentencePieces] = {}


def byte_level(path: str) -> ByteLevelBPE:
    """One tokenizer per Python worker and file, with one table at a time."""
    if ("bpe", path) not in _LOADED:
        _LOADED["bpe", path] = ByteLevelBPE(path)
    return _LOADED["bpe", path]


def sentence_pieces(path: str) -> SentencePieces:
    if ("sp", path) not in _LOADED:
        _LOADED["sp", path] = SentencePieces(path)
    return _LOADED["sp", path]


def _empty_tables() -> None:
    for coder in _LOADED.values():
        coder.table.clear()


AFTER_TASK.append(_empty_tables)
