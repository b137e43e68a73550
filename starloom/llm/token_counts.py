"""Token counts under a byte-level BPE vocabulary by rank-synchronous merging.

Text splits into pre-tokens as the vocabulary's own pattern does.  The
pre-tokens of a batch that were not counted before are held together as one
ragged numpy array of symbols; in each step every sequence merges all
occurrences of its own lowest-rank pair at once, and sequences without a known
pair leave.  What survives is counted.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_package

#: The pre-token pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as that pattern understands it (fixed value).
SPACE = "".join(map(chr, (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))
#: Chunks (a word with the space before it) remembered per Python worker, and
#: chunks handled at once.
CACHE_ROWS, BLOCK = 200_000, 1 << 17
#: Characters of texts whose chunks are looked up together.
HOLD = 1 << 20
NO_PAIR = np.iinfo(np.int64).max


class ByteBPE:
    """Token counter for a ``tokenizers`` file of a byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kind = spec["pre_tokenizer"]
        if model["type"] != "BPE" or kind["type"] != "ByteLevel" or kind.get("add_prefix_space") \
                or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("needs a byte-level BPE without normalizer and prefix space")
        vocab = model["vocab"]
        self.byte_id = np.array([vocab[c] for c in _byte_characters()], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in part], np.int64) for part in
                             zip(*((a, b, a + b) for a, b in merges)))
        self.base = len(vocab) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        # special strings in a text are one token each, as the library has it
        special = [t["content"] for t in spec.get("added_tokens", []) if t["special"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        # a token never spans a change from other characters to white space,
        # so the pattern gives the same within each such chunk
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.tokens = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count_texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text, as the library gives them."""
        out, group, held = [], [], 0
        for text in texts:  # a bounded number of characters at a time
            group.append(text or "")
            held += len(group[-1])
            if held > HOLD:
                out += self._count_group(group)
                group, held = [], 0
        return out + self._count_group(group)

    def _count_group(self, texts: list[str]) -> list[int]:
        totals = np.zeros(len(texts), np.int64)
        held: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            for block in self._blocks(text):
                if len(text) > HOLD:  # a long text is counted block by block
                    totals[i] += self._count_chunks([block])[0]
                else:
                    held.append((i, block))
            if self.special is not None :
                totals[i] += len(self.special.findall(text))
        for (i, _), n in zip(held, self._count_chunks([block for _, block in held])):
            totals[i] += n
        return totals.tolist()

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, special strings left out."""
        for part in self.special.split(text) if self.special is not None else [text]:
            if len(part) <= BLOCK:
                yield self.chunks.findall(part)
            else:
                found = (m.group() for m in self.chunks.finditer(part))
                while block := list(islice(found, BLOCK)):
                    yield block

    def _count_chunks(self, blocks: list[list[str]]) -> list[int]:
        """Tokens of each block of chunks; what is new is merged together."""
        new = set().union(*blocks).difference(self.known)
        if len(self.known) + len(new) > CACHE_ROWS:
            self.known.clear()
            new = set().union(*blocks)
        if new:
            self.learn(list(new))
        known = self.known.__getitem__
        return [sum(map(known, block)) for block in blocks]

    def learn(self, chunks: list[str]) -> None:
        pre = [self.tokens.findall(c) for c in chunks]
        flat = [t.encode() for p in pre for t in p]
        counts = self.merge_counts(flat)
        ends = np.cumsum([len(p) for p in pre])
        total = np.concatenate(([0], np.cumsum(counts)))
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        self.known.update(zip(chunks, (total[ends] - total[starts]).tolist()))

    def merge_counts(self, pretokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        counts = np.zeros(len(pretokens), np.int64)
        size = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        symbols = self.byte_id[np.frombuffer(b"".join(pretokens), np.uint8)]
        owner = np.repeat(np.arange(len(pretokens)), size)
        while len(symbols):
            key = symbols[:-1] * self.base + symbols[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.rank[at], NO_PAIR), NO_PAIR)
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(owner)))
            done = lowest == NO_PAIR
            counts[owner[first[done]]] = length[done]
            low = np.repeat(lowest, length)
            hit = (rank == low) & (low != NO_PAIR)
            # of overlapping occurrences (a run of one symbol) every second merges, from the left
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), place, 0))
            hit &= ((place - run) & 1) == 0
            where = np.flatnonzero(hit)
            symbols = symbols.copy()
            symbols[where] = self.made[at[where]]
            keep = np.repeat(~done, length)
            keep[where + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable
    Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in plain)
    moved = {b: chr(256 + i) for i, b in enumerate(other)}
    return [chr(b) if b in plain else moved[b] for b in range(256)]


@functools.cache
def counter(path: str) -> ByteBPE:
    return ByteBPE(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, n_bytes, n_tokens, over_limit).

    ``vocabulary`` is the path of a byte-level BPE file that every executor
    has.  Texts are counted whole, however long; null and empty ones have 0 bytes and tokens.  Ids are passed on as
    they are; repeated rows each give a row; an empty table an empty result;
    other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = counter(vocabulary)
        for b in batches:
            n = bpe.count_texts(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             ["__id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(id_col).alias("__id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_col).alias("__text"))
    out = with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, n_bytes long, n_tokens long")
    return out.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
