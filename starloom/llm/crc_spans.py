"""CRC-32 of many spans of bytes at once, from a position table.

CRC-32 is linear over XOR: the checksum of a span is a constant of its length
XOR one contribution per byte, which depends on the byte and its distance from
the span's end alone.  So the contributions of all bytes are one table lookup,
and ``bitwise_xor.reduceat`` folds them span by span.

The table reaches ``REACH`` bytes back.  A longer span is cut from its end into
blocks of that size, and neighbouring blocks are folded pairwise: the left one
is advanced over the right one's bytes, which is linear too.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

#: Distances from the end that the table holds; also the size of a block.
REACH = 64
_POLYNOMIAL = 0xEDB88320


@functools.cache
def position_table() -> np.ndarray:
    """[distance, byte]: what a byte adds to a register that starts at 0 when
    ``distance`` bytes follow it."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLYNOMIAL), first >> 1)
    rows = [first]
    for _ in range(REACH - 1):
        rows.append((rows[-1] >> 8) ^ first[rows[-1] & 0xFF])
    return np.array(rows, np.uint32)


@functools.cache
def _advance_table(level: int) -> np.ndarray:
    """[byte of the register, value]: the register after ``REACH << level`` zero bytes."""
    if level == 0:
        return position_table()[REACH - 1:REACH - 5:-1].copy()
    half = _advance_table(level - 1)
    return np.stack([_advance(half[i], half) for i in range(4)])


def _advance(register: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (table[0][register & 0xFF] ^ table[1][(register >> 8) & 0xFF]
            ^ table[2][(register >> 16) & 0xFF] ^ table[3][register >> 24])


@functools.cache
def _short_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The checksum of as many zero bytes, by length."""
    out = _short_constants()[np.minimum(lengths, REACH)]
    for i in np.nonzero(lengths > REACH)[0]:
        out[i] = _long_constant(int(lengths[i]))
    return out


@functools.lru_cache(4096)
def _long_constant(length: int) -> int:
    # a register of ones advanced by the length, by its blocks
    blocks, rest = divmod(length, REACH)
    register, level = np.array([zlib.crc32(bytes(rest)) ^ 0xFFFFFFFF], np.uint32), 0
    while blocks:
        if blocks & 1:
            register = _advance(register, _advance_table(level))
        blocks, level = blocks >> 1, level + 1
    return int(register[0]) ^ 0xFFFFFFFF


def _short(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Registers of spans of 1 to ``REACH`` bytes, ascending and disjoint."""
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    # position in the folded spans, shifted to the position in the data
    at = np.arange(int(size.sum()))
    at += np.repeat(start - first, size)
    distance = np.repeat(end - 1, size) - at
    parts = position_table().ravel()[(distance << 8) | data[at]]
    return np.bitwise_xor.reduceat(parts, first)


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 (unsigned) of ``data[start:end]`` for each span of the uint8
    array; the spans are ascending, disjoint and not empty."""
    if not len(start):
        return np.zeros(0, np.uint32)
    size = end - start
    blocks = -(-size // REACH)
    if blocks.max() == 1:
        return _short(data, start, end) ^ length_constants(size)
    # blocks by distance from their span's end: number 0 is the last
    span = np.repeat(np.arange(len(start)), blocks)
    number = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))
    stop = end[span] - number * REACH
    register = _short(data, np.maximum(stop - REACH, start[span]), stop)
    level = 0
    while len(span) > len(start):
        left = (number & 1).astype(bool)
        register = np.where(left, _advance(register, _advance_table(level)), register)
        number, level = number >> 1, level + 1
        new = np.concatenate(([True], (span[1:] != span[:-1]) | (number[1:] != number[:-1])))
        first = np.nonzero(new)[0]
        register, span, number = np.bitwise_xor.reduceat(register, first), span[first], number[first]
    return register ^ length_constants(size)
