"""Fill-in-middle transformation: a text is cut at two points, and its middle
moves behind prefix and suffix.

The cut points are numbers of units (code points), so a cut has to be found in
UTF-8.  A whole Arrow batch is one buffer of bytes, read as 64-bit words, eight
bytes at a time:

1. mark the bytes that end a unit: those whose next byte is no continuation
   byte (``10xxxxxx``), by shifts and masks on words;
2. count the marks of each word (``bitwise_count``) and sum them up;
3. the word of the k-th mark is where that sum reaches k (``searchsorted``);
4. in that word, a multiplication gives each byte the marks up to it, and
   comparing all eight with what is left of k gives the byte.

Rows whose random draw says so, and rows that could not be told apart
afterwards (empty, or holding a sentinel), stay plain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_package

#: Prefix, suffix and middle sentinel.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 1
#: Share of rows (%) that are transformed, and of those the share (%) in spm form.
FIM_PERCENT, SPM_PERCENT = 90, 20

_LOW = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_SEVEN, _SIX, _EIGHT, _TOP = np.uint64(7), np.uint64(6), np.uint64(8), np.uint64(56)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """For UTF-8 as 64-bit words (little-endian), words with 1 in each byte
    that ends a unit.  The byte after the last one counts as a start."""
    # a byte starts a unit unless its two top bits are 1 and 0
    starts = ((~words >> _SEVEN) | (words >> _SIX)) & _LOW
    following = np.append(starts[1:], _LOW)
    return (starts >> _EIGHT) | (following << _TOP)


class Units:
    """Positions of units in a buffer of UTF-8 bytes."""

    def __init__(self, data: bytes | pa.Buffer):
        size = len(memoryview(data))
        padded = np.zeros(size // 8 + 1, "<u8")  # a zero byte at least, which starts a unit
        padded.view(np.uint8)[:size] = np.frombuffer(data, np.uint8)
        self.ends = unit_ends(padded)
        self.upto = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)

    def before(self, position: np.ndarray) -> np.ndarray:
        """How many units end before each byte position."""
        word, byte = position >> 3, (position & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * _EIGHT)) - np.uint64(1)
        inside = np.bitwise_count(self.ends[word] & below).astype(np.int64)
        return np.where(word > 0, self.upto[word - 1], 0) + inside

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte position just after the k-th unit (0 for the start)."""
        word = np.searchsorted(self.upto, k, "left")
        word = np.minimum(word, len(self.ends) - 1)
        left = (k - np.where(word > 0, self.upto[word - 1], 0)).astype(np.uint64)
        counts = self.ends[word] * _LOW  # byte i: marks in bytes 0 to i
        reached = ((counts | _HIGH) - left * _LOW) & _HIGH
        return np.where(k > 0, word * 8 + 9 - np.bitwise_count(reached).astype(np.int64), 0)


def _draw(id_col: str, seed: int, i: int) -> Column:
    """The i-th (from 0) 32-bit number of a row's draw, from its id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")


def _cut(batch: pa.RecordBatch, sentinels: tuple[str, str, str], fim: int, spm: int) -> pa.RecordBatch:
    """One batch of (id, h1..h4, text) to (id, n, form, prefix, middle, output)."""
    texts = batch.column(5).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    base, data = int(offsets[0]), texts.buffers()[2]
    data = data.slice(base, int(offsets[-1]) - base) if data is not None else pa.py_buffer(b"")
    offsets = offsets - base
    units = Units(data)
    first = units.before(offsets)
    n = np.diff(first)
    h = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5)]
    cuts = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    marked = np.zeros(len(n), bool)
    for s in sentinels:
        marked |= pc.match_substring(batch.column(5), s).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (h[2] % 100 >= fim)
    turned = h[3] % 100 < spm
    # the ends of prefix and middle, as bytes
    one, two = units.select(first[:-1] + cuts[0]), units.select(first[:-1] + cuts[1])
    one, two = np.maximum(one, offsets[:-1]), np.maximum(two, offsets[:-1])
    p, s, m = (x.encode() for x in sentinels)
    raw, out = memoryview(data), []
    for i in range(len(n)):
        a, b, c, d = offsets[i], one[i], two[i], offsets[i + 1]
        if plain[i]:
            out.append(bytes(raw[a:d]))
        elif turned[i]:
            out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
        else:
            out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
    form = np.where(plain, PLAIN, np.where(turned, SPM, PSM))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
         pa.array(cuts[0], pa.int64(), mask=plain), pa.array(cuts[1] - cuts[0], pa.int64(), mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())],
        ["__id", "n", "form", "prefix_chars", "middle_chars", "output"])


def infill(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
           fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
           sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """One row per row of ``docs``: (id, n, form, prefix_chars, middle_chars, output).

    ``n`` counts code points; prefix and middle lengths are null in form plain.
    A null text counts as empty, an empty text is plain.  The draw depends on
    the id alone (a null id draws as the empty string), so repeated rows and
    reruns agree.  Texts are cut whole, however long: a batch takes a few times
    its bytes.  An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("__id"),
                       *[_draw(id_col, seed, i).alias(f"__h{i + 1}") for i in range(4)],
                       F.coalesce(F.col(text_col), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _cut(b, sentinels, fim_percent, spm_percent)

    out = with_package(rows).mapInArrow(
        run, f"__id {rows.dtypes[0][1]}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("__id", id_col)


def restored(output: str = "output", form: str = "form",
             sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from which ``infill`` made an output.  The sentinels of a
    transformed output are the first of each kind in it: a text that holds one
    stays plain, and none begins inside another."""
    pattern = "|".join(rf"\Q{x}\E" for x in sentinels)
    split = F.split(F.col(output), pattern, -1)
    # '' before the first sentinel, then the three parts in the form's order
    one, two, three = (F.get(split, F.lit(i)) for i in (1, 2, 3))
    return (F.when(F.col(form) == PSM, F.concat(one, three, two))
            .when(F.col(form) == SPM, F.concat(two, three, one))
            .otherwise(F.col(output)))


def infill_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``infill`` with the SHA-256 (lower-case hex) of each output and of the
    text rebuilt from it, instead of the output."""
    out = infill(docs, id_col, text_col, **params)
    rebuilt = restored(sentinels=params.get("sentinels", SENTINELS))
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(rebuilt.cast("binary"), 256).alias("restored_sha256"))


def sql(seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
        sentinels: tuple[str, str, str] = SENTINELS) -> str:
    """DuckDB statement for ``infill_digests`` over ``documents``."""
    p, s, m = sentinels
    draws = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    held = " OR ".join(f"contains(t, '{x}')" for x in sentinels)

    def after(x: str, y: str | None) -> str:
        """The part of the output between sentinels x and y."""
        begin = f"(strpos(o, '{x}') + {len(x)})"
        return f"substr(o, {begin})" if y is None else f"substr(o, {begin}, strpos(o, '{y}') - {begin})"

    return f"""
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                   sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents),
        drawn AS (SELECT doc_id, t, n, {draws} FROM hashed),
        cut AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR {held} OR h3 % 100 >= {fim_percent} THEN '{PLAIN}'
                        WHEN h4 % 100 < {spm_percent} THEN '{SPM}' ELSE '{PSM}' END AS form
            FROM drawn),
        parts AS (
            SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM cut),
        made AS (
            SELECT *, CASE form WHEN '{PLAIN}' THEN t
                                WHEN '{SPM}' THEN '{s}' || suf || '{p}' || pre || '{m}' || mid
                                ELSE '{p}' || pre || '{s}' || suf || '{m}' || mid END AS o
            FROM parts)
        SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN a END AS prefix_chars,
               CASE WHEN form <> '{PLAIN}' THEN b - a END AS middle_chars, sha256(o) AS output_sha256,
               sha256(CASE form WHEN '{PLAIN}' THEN o
                                WHEN '{SPM}' THEN {after(p, m)} || {after(m, None)} || {after(s, p)}
                                ELSE {after(p, s)} || {after(m, None)} || {after(s, m)} END) AS restored_sha256
        FROM made"""
