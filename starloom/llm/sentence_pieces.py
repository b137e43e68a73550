"""SentencePiece encoding and decoding by streaming Viterbi search.

The lattice of a text has a node at each character boundary and an edge for
each piece.  Going forward, every node keeps one backpointer, that of its
surviving path.  Only nodes within the longest piece's length can still be
reached from, so only those are retained: whenever the paths of all of them
run through one boundary, the ids up to it are committed and the window moves
on.  A boundary that no piece can cross (before white space, at a character
that no piece contains) is such a point by itself; between two of them the
result depends on the characters alone and is remembered.

Unigram models keep the path of the best score.  BPE models rank merges, not
paths: there a path survives at a node only if each two neighbouring pieces of
it are what merging their joined text gives; exactly one does, and it is the
encoding of the text so far.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import islice, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from .common import with_package

SPACE = "▁"
UNIGRAM, BPE = 1, 2
#: Segments and joined pairs remembered per Python worker; segments at once.
CACHE_ROWS, PAIR_ROWS, BLOCK = 600_000, 600_000, 1 << 17
#: Characters that are searched before paths are compared.
WINDOW = 32
#: Instead of a last piece: the start of a text, a character that is no piece.
START, OTHER = -2, -1


class _Remembered(dict):
    """Ids of segments, as bytes, made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, segment: str) -> bytes:
        ids = self.make(segment)
        if len(segment) <= 64:
            if len(self) >= CACHE_ROWS:
                self.clear()
            self[segment] = ids
        return ids


class Pieces:
    """Encoder and decoder for a SentencePiece model file."""

    def __init__(self, path: str):
        model = proto.ModelProto()
        model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm = model.normalizer_spec
        self.kind = model.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE) or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.escape_whitespaces:
            raise ValueError("needs a unigram or BPE model with identity normalization")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        kinds = proto.ModelProto.SentencePiece
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.longest = max(map(len, self.ids), default=1)
        #: every ending of a piece: its id if it is a piece that merges make, else -1
        self.endings = {p[i:]: -1 for p in self.ids for i in range(len(p))} if self.kind == BPE else {}
        self.endings.update((p, i) for p, i in self.ids.items() if p in self.endings and self.merged(p) == [p])
        #: finds the pieces of two characters or more that merges make, longest first at each end
        self.finder = ahocorasick.Automaton()
        for p, i in self.endings.items():
            if i >= 0 and len(p) > 1:
                self.finder.add_word(p, (len(p), i))
        if len(self.finder):
            self.finder.make_automaton()
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        line = any("\n" in p for p in self.ids)
        if inner or line:  # no boundary is known beforehand
            self.segments = re.compile(r".+", re.S)
        else:
            self.segments = re.compile(" +[^ \n]*|[^ \n]+|\n+")
        self.single = {p: i for p, i in self.ids.items() if len(p) == 1}
        self.known = _Remembered(self._segment)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.text_of = ["" if p.type == kinds.CONTROL else chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128
                        else " ⁇ " if i == self.unknown else p.piece for i, p in enumerate(model.pieces)]
        self.high = np.array([self.byte_of.get(i, 0) > 127 for i in range(len(self.text_of))])
        self.halves = functools.cache(self._halves)
        self.orderly = functools.cache(self._orderly)
        self.pairs: dict[int, bool] = {}

    # -- encoding

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for a null or empty one."""
        if not text:
            return np.zeros(0, np.int32)
        # plain spaces for now (the mark itself counts as one): smaller strings to remember
        text = (" " if self.prefix else "") + text.replace(SPACE, " ")
        if len(text) <= BLOCK:
            out = b"".join(map(self.known.__getitem__, self.segments.findall(text)))
        else:
            found = (m.group() for m in self.segments.finditer(text))
            parts = []
            while block := list(islice(found, BLOCK)):
                parts.append(b"".join(map(self.known.__getitem__, block)))
            out = b"".join(parts)
        return np.frombuffer(out, np.int32)

    def _segment(self, segment: str) -> bytes:
        text = segment.replace(" ", SPACE)
        return array("i", self._short(text) if len(text) <= WINDOW else self.viterbi(text)).tobytes()

    def _short(self, text: str) -> list[int]:
        """As ``viterbi``, for a text that one window holds."""
        if self.kind == BPE:
            return self._short_bpe(text)
        back, state = [-1], [0.0]
        for end in range(1, len(text) + 1):
            back.append(self._best_piece(text, end, 0, back, state))
        return self._path(text, back, 0, len(text))

    def _short_bpe(self, text: str) -> list[int]:
        """All edges of the lattice come from one pass of ``finder``."""
        back = list(range(-1, len(text)))  # a single character, unless a piece fits
        last = [START, *map(self.single.get, text, repeat(OTHER))]
        pairs, known, settled = self.pairs, self.pairs.get, 0
        for at, (length, piece) in self.finder.iter(text) if len(self.finder) else ():
            end = at + 1
            if end == settled:  # by a longer piece
                continue
            start = end - length
            left = last[start]
            if left >= 0:
                key = left << 24 | piece
                fits = known(key)
                if fits is None:
                    if len(pairs) >= PAIR_ROWS:
                        pairs.clear()
                    fits = pairs[key] = self._joins(text[back[start]:start], text[start:end])
            else:
                fits = left == START or self._joins(text[back[start]:start], text[start:end])
            if fits:
                back[end], last[end], settled = start, piece, end
        out, end = [], len(text)
        while end:
            piece, before = last[end], back[end]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[before:end].encode()))
            else:
                out.append(self.unknown)
            end = before
        out.reverse()
        return out

    def viterbi(self, text: str) -> Iterator[int]:
        """Ids of the surviving path, given out as soon as they are certain."""
        # of the retained nodes, the first at position done: the backpointer,
        # and what the path carries there (its last piece, or its score)
        back, state = [-1], [START if self.kind == BPE else 0.0]
        done, step = 0, max(WINDOW, 2 * self.longest)
        last_piece = self._last_piece if self.kind == BPE else self._best_piece
        for end in range(1, len(text) + 1):
            back.append(last_piece(text, end, done, back, state))
            if end - done >= step and end % self.longest == 0:
                common = self._converged(back, end, done)
                if common > done:
                    yield from self._path(text, back, done, common)
                    del back[:common - done], state[:common - done]
                    done = common
        yield from self._path(text, back, done, len(text))

    def _converged(self, back: list[int], end: int, done: int) -> int:
        """The boundary on which the paths of all retained nodes meet."""
        paths = set(range(max(done, end - self.longest + 1), end + 1))
        while len(paths) > 1:
            last = max(paths)
            paths.remove(last)
            paths.add(max(back[last - done], done))
        return paths.pop()

    def _path(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        out, done = [], start
        while end > start:
            before = back[end - done]
            piece = text[before:end]
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(piece.encode()))
            else:
                out.append(self.unknown)
            end = before
        return out[::-1]

    def _best_piece(self, text: str, end: int, done: int, back: list[int], best: list[float]) -> int:
        """Unigram: the start of the last piece on the path of the best score."""
        score, start = max((best[s - done] + self.score.get(text[s:end], self.unknown_score), s)
                           for s in range(max(done, end - self.longest), end)
                           if s == end - 1 or text[s:end] in self.score)
        best.append(score)
        return start

    def _last_piece(self, text: str, end: int, done: int, back: list[int], last: list[int]) -> int:
        """BPE: the start of the last piece of the encoding of text[:end]."""
        endings, found, start = self.endings, [], end - 2
        while start >= done:
            piece = endings.get(text[start:end])
            if piece is None:
                break
            if piece >= 0:
                found.append((start, piece))
            start -= 1
        for start, piece in reversed(found):  # the longest first
            left = last[start - done]
            if left == START:
                fits = True
            elif left < 0:
                fits = self._joins(text[back[start - done]:start], text[start:end])
            else:
                fits = self.pairs.get(left << 24 | piece)
                if fits is None:
                    if len(self.pairs) >= PAIR_ROWS:
                        self.pairs.clear()
                    fits = self.pairs[left << 24 | piece] = self._joins(text[back[start - done]:start], text[start:end])
            if fits:
                last.append(piece)
                return start
        last.append(self.ids.get(text[end - 1], OTHER))
        return end - 1

    def _joins(self, left: str, right: str) -> bool:
        """Whether merging left + right gives just these two pieces."""
        if not (self.orderly(left) and self.orderly(right)):
            return self.merged(left + right) == [left, right]
        # undo the merges of both sides, the latest first: no pair that meets
        # at the boundary may score better than the merge that came instead
        score, limit, from_right = self.score, -float("inf"), False
        while True:
            s = score.get(left + right)
            if s is not None and (s > limit or s == limit and from_right):  # of equals the left one merges first
                return False
            s_left = score[left] if len(left) > 1 else float("inf")
            s_right = score[right] if len(right) > 1 else float("inf")
            if s_left == s_right == float("inf"):
                return True
            if s_left < s_right:
                limit, left, from_right = s_left, self.halves(left)[1], False
            else:
                limit, right, from_right = s_right, self.halves(right)[0], True

    def _orderly(self, piece: str) -> bool:
        """Whether each merge inside a piece scores worse than those of its
        parts, so that scores tell which merge came first."""
        if len(piece) == 1:
            return True
        halves = self.halves(piece)
        return all(len(h) == 1 or self.score[h] > self.score[piece] and self.orderly(h) for h in halves)

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge makes a piece."""
        return tuple(self.merged(piece, 2))

    def merged(self, text: str, until: int = 1) -> list[str]:
        """BPE of a short text: the best-scored pair merges first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    # -- decoding

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: byte pieces joined and decoded, the prefix space dropped."""
        if not len(ids):
            return ""
        if self.high[ids].any():  # bytes that are not characters by themselves
            parts, pending = [], bytearray()
            for i in ids.tolist():
                if self.high[i]:
                    pending.append(self.byte_of[i])
                    continue
                if pending:
                    parts.append(pending.decode(errors="replace"))
                    pending.clear()
                parts.append(self.text_of[i])
            parts.append(pending.decode(errors="replace"))
            text = "".join(parts)
        else:
            text = "".join(map(self.text_of.__getitem__, ids.tolist()))
        text = text.replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, ids array<int>).

    ``model`` is the path of a SentencePiece file that every executor has.
    Texts are encoded whole, however long; null and empty ones give no ids.  Row ids are passed on as they are;
    repeated rows each give a row; an empty table an empty result; other
    columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = pieces(model)
        for b in batches:
            encoded = [sp.encode(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(encoded)], ["__id", "ids"])

    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, ids array<int>").withColumnRenamed("__id", id_col)


def decode_ids(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: (id, text).  Null ids give a null text,
    an empty list the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = pieces(model)
        for b in batches:
            texts = [sp.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["__id", "text"])

    slim = encoded.select(F.col(id_col).alias("__id"), F.col(ids_col).alias("ids"))
    return with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, text string").withColumnRenamed("__id", id_col)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, n_ids, ids, decoded_sha256, exact).

    ``exact`` says whether decoding the ids gives the text back (null counts
    as empty): true unless the text holds the white-space mark itself.
    Encoding and decoding share one pass over the texts.  Other cases as in
    ``encode_texts``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = pieces(model)
        for b in batches:
            encoded, sha, exact = [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                ids = sp.encode(text)
                back = sp.decode(ids)
                encoded.append(ids)
                sha.append(hashlib.sha256(back.encode()).hexdigest())
                exact.append(back == text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in encoded], pa.int64()), _lists(encoded),
                 pa.array(sha, pa.string()), pa.array(exact, pa.bool_())],
                ["__id", "n_ids", "ids", "decoded_sha256", "exact"])

    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    out = with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, n_ids long, ids array<int>, decoded_sha256 string, "
                               "exact boolean")
    return out.withColumnRenamed("__id", id_col)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(a) for a in arrays])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
