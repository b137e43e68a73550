"""URL filter: host and path rules first, then a weighted vocabulary.

The vocabulary is one Aho-Corasick automaton, so a URL is read once however
many terms there are.  A term counts only where no letter or digit touches it.
One strict term rejects a URL; so do several distinct soft ones.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_package

#: (verdict, host, path) of the given rules (fixed values).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Terms that reject by themselves.
STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "sexcam", "warez", "keygen", "viagra")
#: Terms that reject when several distinct ones occur.
SOFT = ("adult", "bet", "bets", "betting", "bonus", "casino", "cheap", "crack", "dating", "escort", "free", "gambling",
        "jackpot", "loan", "lottery", "nude", "pharmacy", "pills", "poker", "replica", "sex", "sexy", "slots", "torrent",
        "webcam", "win", "xx")
SOFT_HITS = 2
#: Terms of a vocabulary read from a table; weight from which a term is strict.
MAX_TERMS, STRICT_WEIGHT = 100_000, 1.0

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): what stands between the first ``://`` and ``/``, ``?``,
    ``#`` or the end, A-Z lower-cased, and what follows up to ``?`` or ``#``.
    Both are empty without ``://``."""
    found = _URL.search(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def match_rule(host: str, path: str, rules: tuple = RULES) -> tuple[str | None, str | None]:
    """(verdict, rule) of the longest rule that fits the host or a domain above it, and the path."""
    fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return None, None
    rule, verdict = max(fits, key=lambda x: (len(x[0]), x[0]))
    return verdict, rule


def read_vocabulary(table: DataFrame, term_col: str = "term", weight_col: str = "weight",
                    strict_weight: float = STRICT_WEIGHT) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(strict, soft) terms of a table: a term counts with its largest weight,
    as strict from ``strict_weight``, as soft above 0.  A-Z are lower-cased;
    null and empty terms and null weights are left out.  More than
    ``MAX_TERMS`` terms raise, since every task holds the automaton."""
    term = F.translate(F.col(term_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = table.select(term.alias("t"), F.col(weight_col).cast("double").alias("w")).filter(
        "t <> '' AND w > 0").groupBy("t").agg(F.max("w").alias("w"))
    rows = terms.orderBy("t").limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    return (tuple(r.t for r in rows if r.w >= strict_weight), tuple(r.t for r in rows if r.w < strict_weight))


@functools.cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    if not strict and not soft:
        found.add_word("\0", ("\0", False))  # an automaton needs a word; this one is no URL's
    for word in soft:
        found.add_word(word, (word, False))
    for word in strict:
        found.add_word(word, (word, True))
    found.make_automaton()
    return found


def count_terms(url: str | None, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[int, int]:
    """(occurrences of strict terms, distinct soft terms) with a boundary on both sides."""
    text = (url or "").translate(_UPPER)
    n, seen = 0, set()
    for end, (word, is_strict) in _automaton(strict, soft).iter(text):
        start = end - len(word) + 1
        if (start and text[start - 1].isalnum()) or (end + 1 < len(text) and text[end + 1].isalnum()):
            continue
        if is_strict:
            n += 1
        else:
            seen.add(word)
    return n, len(seen)


def judge_urls(pages: DataFrame, rules: tuple = RULES, strict: tuple[str, ...] = STRICT,
               soft: tuple[str, ...] = SOFT, soft_hits: int = SOFT_HITS, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: (id, host, path, rule, verdict, strict_hits, soft_terms).

    The rule's verdict stands where one fits; else the vocabulary decides
    (``block`` on one strict or ``soft_hits`` distinct soft terms, else
    ``allow``).  A null or empty URL, or one without ``://``, has an empty
    host and path, and fits no rule.  A URL of any length is read whole.  Ids are passed on as they are; repeated
    rows each give a row; an empty table an empty result; other columns are
    ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for u in b.column(1).to_pylist():
                host, path = split_url(u)
                verdict, rule = match_rule(host, path, rules)
                hard, distinct = count_terms(u, strict, soft)
                if verdict is None:
                    verdict = "block" if hard or distinct >= soft_hits else "allow"
                rows.append((host, path, rule, verdict, hard, distinct))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in cols[:4]),
                 *(pa.array(c, pa.int32()) for c in cols[4:])],
                ["__id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms"])

    slim = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"))
    out = with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, host string, path string, rule string, verdict string, "
                               "strict_hits int, soft_terms int")
    return out.withColumnRenamed("__id", id_col)


def sql(rules: tuple = RULES, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT,
        soft_hits: int = SOFT_HITS) -> str:
    """DuckDB statement for ``judge_urls`` over ``pages``."""
    def bounded(words):
        return r"'(?:^|[^\p{L}\p{N}])(?:" + "|".join(words) + r")(?:[^\p{L}\p{N}]|$)'"

    ordered = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2]), reverse=True)
    fits = [f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN" for _, h, p in ordered]
    rule = " ".join(f"{f} '{h + p}'" for f, (_, h, p) in zip(fits, ordered))
    verdict = " ".join(f"{f} '{v}'" for f, (v, _, _) in zip(fits, ordered))
    lower = ("translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    distinct = " + ".join(f"regexp_matches(low, {bounded([w])})::INT" for w in soft)
    # occurrences of strict terms; boundaries are doubled so that neighbours can share one
    wide = r"regexp_replace(low, '([^\p{L}\p{N}])', '\1\1', 'g')"
    return rf"""
        WITH parts AS (
            SELECT page_id, {lower} AS low,
                   coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS h,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        hosts AS (
            SELECT *, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
        hits AS (
            SELECT *, len(regexp_extract_all({wide}, {bounded(strict)}))::INT AS strict_hits,
                   ({distinct})::INT AS soft_terms
            FROM hosts)
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {verdict} WHEN strict_hits > 0 OR soft_terms >= {soft_hits} THEN 'block' ELSE 'allow' END AS verdict,
               strict_hits, soft_terms
        FROM hits"""
