"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spells ordinary words in few tokens and random strings
in many.  A run of ``MIN_CHARS`` key characters or more, letters only or not,
whose characters per token fall below ``max_ratio`` is reported, unless it is a
digest or an identifier of a known form (MD5, SHA-1, SHA-256 and SHA-512 in
hex, UUIDs, numbers, ULIDs) or a pattern reported it already.  Slashes and
equals signs belong to a run; words around it that they set off, as in a path
or an assignment, don't.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_package
from .token_counts import PATTERN

#: The given patterns, in order (fixed values).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

#: Fewest characters of a string that the token test looks at, and runs of key characters.
MIN_CHARS = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
PART = re.compile(r"[^/=]+")
#: Words in regular case, as paths and names hold them.
WORDS = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,2}(?:[_-]+(?:(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,2}|\d+))*[_-]*\Z")
#: Digests in hex and identifiers, which are no secrets.
KNOWN_FORM = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|[0-9+_-]+|[0-7][0-9A-HJKMNP-TV-Z]{25})\Z")
MAX_RATIO = 2.0


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what the patterns find, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, enc: tiktoken.Encoding, taken: list[tuple[int, int, int]],
                 max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of strings that the vocabulary spells badly."""
    def badly_spelled(part: str) -> bool:
        return len(part) >= MIN_CHARS and not KNOWN_FORM.match(part) and len(part) < max_ratio * _tokens(part, enc)

    def harmless(part: str) -> bool:
        return not part or bool(KNOWN_FORM.match(part)) or bool(WORDS.match(part)) and not badly_spelled(part)

    def apart(part: str) -> bool:
        return harmless(part) and len(part) > 3 and (bool(KNOWN_FORM.match(part)) or len(part) >= 3 * _tokens(part, enc))

    def ends(parts: list[tuple[int, int, bool]]) -> int:
        """How many first parts, harmless ones up to a plain word, are not of the string."""
        count = 0
        for i, (a, b, ok) in enumerate(parts):
            if not ok:
                break
            if apart(text[a:b]):
                count = i + 1
        return count

    # the places taken, as ascending intervals apart from each other
    starts, stops = [], []
    for x, _, y in sorted(taken):
        if stops and x <= stops[-1]:
            stops[-1] = max(stops[-1], y)
        else:
            starts.append(x)
            stops.append(y)

    def free(a: int, b: int) -> bool:
        i = bisect.bisect_right(stops, a)
        return i == len(starts) or starts[i] >= b

    out = []
    for m in CANDIDATE.finditer(text):
        parts = [(m.start() + p.start(), m.start() + p.end(), harmless(p[0])) for p in PART.finditer(m[0])]
        if all(ok for _, _, ok in parts):
            continue
        # plain words and identifiers at both ends, set off by / or =, are not of the string
        first, last = ends(parts), len(parts) - ends(parts[::-1])
        start = parts[first][0] if first else m.end() - len(m[0].lstrip("="))
        bare = m.start() + len(m[0].rstrip("="))
        end = parts[last - 1][1] if last < len(parts) else min(m.end(), bare + 2)  # with its padding
        if free(start, end) and badly_spelled(text[start:end]):
            out.append((start, 3, end))
        else:
            out += [(a, 3, b) for a, b, _ in parts[first:last] if free(a, b) and badly_spelled(text[a:b])]
    return out


def _tokens(s: str, enc: tiktoken.Encoding, block: int = 4096) -> int:
    """Tokens of a string; a very long one is counted in blocks."""
    return sum(len(enc.encode_ordinary(s[i:i + block])) for i in range(0, len(s), block))


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, ranks: str, max_ratio: float = MAX_RATIO, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, n_assign, n_access, n_hex, n_random, base_sha256, spans).

    A span is the whole match, in code points, end exclusive.  ``base_sha256``
    is the digest of the patterns' spans, ``spans`` lists these and the random
    strings.  ``ranks`` is the path of a tiktoken rank file that every
    executor has.  A null text is an empty one and has no spans.  Ids are
    passed on as they are; texts are read whole, however long; repeated rows each give a row; an empty table an
    empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        for b in batches:
            counts, shas, spans = [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                extra = random_spans(text, enc, base, max_ratio)
                kinds = [k for _, k, _ in base]
                counts.append((kinds.count(0), kinds.count(1), kinds.count(2), len(extra)))
                shas.append(hashlib.sha256(_join(base).encode()).hexdigest())
                spans.append(_join(sorted(base + extra)))
            n = list(zip(*counts)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in n), pa.array(shas, pa.string()),
                 pa.array(spans, pa.string())],
                ["__id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    out = with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, n_assign long, n_access long, n_hex long, n_random long, "
                               "base_sha256 string, spans string")
    return out.withColumnRenamed("__id", id_col)
