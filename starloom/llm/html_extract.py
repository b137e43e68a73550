"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements, each told apart by the path to it (tags, and
classes without what differs from page to page; no ids), and its texts: inside an article whole blocks, so that no sentence is torn, elsewhere
the text of each element.  Over all pages of a host, tokens that occur equally
often on every page have the same occurrence vector; such tokens form an
equivalence class.  A class that is frequent (on ``MIN_PAGES`` pages or more,
and half of the host's) and holds elements is valid if its elements nest: each
has its parent in the class or in a valid class that occurs on all its pages.
Valid classes nest by these paths into the host's template.

What the template holds itself is not content: its texts are boilerplate and
leave every page.  Inside an article only those around its own content leave,
before its first slot or after its last: what stands between slots (the
heading "Method" of every recipe), or is a heading right before one, belongs to
them.  A class whose texts make up more than half of the articles it is in is
kept: its pages are copies of one article, not one frame around several; so is
an article without any slot.  The remaining slots are checked
against the markup: those under the template's article element make the main
text, without the parts that are beside it by element, class or role; a page
without such an element gives all its remaining slots.

Occurrence vectors have as many entries as a host has pages, so only their
fingerprint is kept: the sum of a hash of (page, count), which aggregates in
each task before anything shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_groups, materialise, with_package
from .html_pages import Page, join_blocks, read_page
from .url_filter import split_url

#: Fewest pages of a host that make a template.
MIN_PAGES = 3
#: Share of an article, in thousandths, that is no boilerplate any more.
MAX_SHARE = 500
ELEMENT, CONTAINER, TEXT, BLOCK = 0, 1, 2, 3


def _token(path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}".encode(), 0) - (1 << 63)


def _blocks(texts: list[tuple[int, str, str, bool, bool]]) -> dict[int, tuple[str, str]]:
    """(path, words) of each block of a page's articles."""
    parts: dict[int, tuple[str, list[str]]] = {}
    for n, path, text, inside, aside in texts:
        if inside and not aside and (n in parts or not text.isspace()):
            parts.setdefault(n, (path, []))[1].append(text)
    blocks = ((n, path, " ".join("".join(some).split())) for n, (path, some) in parts.items())
    return {n: (path, words) for n, path, words in blocks if words}


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to rows (host, page, token, parent, kind, n, share), one per token
    of a page; ``share`` is a block's part of the page's articles."""
    for b in batches:
        out: list[tuple] = []
        for number, url, source in zip(*(c.to_pylist() for c in b.columns)):
            page, host = read_page(source), split_url(url)[0]
            for path, n in page.paths.items():
                kind = CONTAINER if path in page.containers else ELEMENT
                out.append((host, number, _token(path), _token(path.rpartition(">")[0]), kind, n, 0))
            seen: dict[int, list] = {}
            for _, path, text, inside, _ in page.texts:
                if not inside and (words := " ".join(text.split())):
                    token = _token(path, words)
                    seen.setdefault(token, [host, number, token, _token(path), TEXT, 0, 0])[5] += 1
            blocks = _blocks(page.texts)
            size = sum(len(words) for _, words in blocks.values())
            for path, words in blocks.values():
                token = _token(path, words)
                row = seen.setdefault(token, [host, number, token, _token(path), BLOCK, 0, 0])
                row[5] += 1
                row[6] = 1000 * len(words) * row[5] // size
            out += map(tuple, seen.values())
        cols = list(zip(*out)) or [()] * 7
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         ["host", "page", "token", "parent", "kind", "n", "share"])


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, pages, containers, static): per host the template's article
    elements and boilerplate texts as token numbers.  ``pages`` has (__page
    long, __url, __html), with a different __page for each row."""
    tokens = with_package(pages).select("__page", "__url", "__html").mapInArrow(
        _tokens_of, "host string, page long, token long, parent long, kind int, n long, share long")
    # occurrence vectors by fingerprint; hot hosts and tokens are summed in each task
    vectors = materialise(tokens.groupBy("host", "token").agg(
        F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("vector"), F.count("*").alias("pages"),
        F.max("kind").alias("kind"), F.max("parent").alias("parent"), F.sum("share").alias("share")
    ).filter(F.col("pages") >= MIN_PAGES), "tokens")
    roots = vectors.groupBy("host").agg(F.max("pages").alias("host_pages"))
    frequent = vectors.join(roots, "host").filter(F.col("pages") * 2 >= F.col("host_pages"))
    # nested: an element's parent is frequent too, on no fewer pages; the outermost has none
    parent = frequent.select("host", F.col("token").alias("parent"), F.col("pages").alias("parent_pages"))
    outermost = F.col("parent") == F.lit(_token(""))
    nested = frequent.join(parent, ["host", "parent"], "left").filter(
        outermost | (F.col("parent_pages") >= F.col("pages")))
    classes = nested.groupBy("host", "vector").agg(
        F.first("host_pages").alias("host_pages"), F.sum((F.col("kind") < TEXT).cast("int")).alias("elements"),
        F.collect_list(F.when(F.col("kind") == CONTAINER, F.col("token"))).alias("containers"),
        F.collect_list(F.when(F.col("kind") == TEXT, F.col("token"))).alias("static"),
        F.collect_list(F.when(F.col("kind") == BLOCK, F.col("token"))).alias("blocks"),
        (F.sum("share") <= F.max("pages") * MAX_SHARE).alias("frame"))
    classes = classes.withColumn("static", F.when(F.col("frame"), F.concat("static", "blocks")).otherwise(F.col("static")))
    return classes.filter("elements > 0").groupBy("host").agg(
        F.first("host_pages").alias("pages"), F.flatten(F.collect_list("containers")).alias("containers"),
        F.flatten(F.collect_list("static")).alias("static"))


_HEADING = re.compile(r">h[1-6](?![^.>])")


def _frame(blocks: dict[int, tuple[str, str]], static: set[int]) -> set[int]:
    """The numbers of an article's blocks that are the template's: those before
    and after its own ones, but for headings that lead up to these."""
    order = sorted(blocks)
    own = [i for i, n in enumerate(order) if _token(*blocks[n]) not in static]
    if not own:
        return set()
    first, last = own[0], own[-1]
    while first and _HEADING.search(blocks[order[first - 1]][0]):
        first -= 1
    return set(order[:first] + order[last + 1:])


def _outer_frame(page: Page, static: set[int]) -> set[int]:
    """The places in ``page.texts`` of the template's texts outside articles;
    a heading right before a text of the page's own is none."""
    out, after_own = set(), False
    for i in range(len(page.texts) - 1, -1, -1):
        _, path, text, inside, aside = page.texts[i]
        words = " ".join(text.split())
        if inside or aside or not words:
            continue
        if _token(path, words) not in static:
            after_own = True
        elif not (after_own and _HEADING.search(path)):
            out.add(i)
            after_own = False
    return out


def main_text(source: str | None, containers: set[int], static: set[int]) -> str:
    """The remaining slots of a page, given its host's template."""
    page = read_page(source)
    inner = _frame(_blocks(page.texts), static) if static else set()
    outer = _outer_frame(page, static) if static else set()
    slots = [(n, p, t, inside) for i, (n, p, t, inside, aside) in enumerate(page.texts) if not aside and (
        n not in inner if inside else i not in outer)]
    if page.containers:
        articles = {p for p in page.containers if _token(p) in containers}
        if articles and articles != page.containers:  # the page has more than the template's
            under = tuple(a + ">" for a in articles)
            kept = [x for x in slots if x[1] in articles or x[1].startswith(under)]
            if _largest(slots, page.containers - articles) <= sum(len(x[2].strip()) for x in kept):
                slots = kept
        slots = [x for x in slots if x[3]]
    return join_blocks([(n, t) for n, _, t, _ in slots])


def _largest(slots: list[tuple[int, str, str, bool]], containers: set[str]) -> int:
    """Characters of the slots under the largest of some containers."""
    return max(sum(len(t.strip()) for _, p, t, _ in slots if p == c or p.startswith(c + ">")) for c in containers)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: (id, url, text, n_chars).

    A null or empty html, or one without text, gives an empty text.  Pages
    with a null URL, or one without a host, count as one host.  Hosts of fewer
    than three pages have no template; their pages are cut by their own
    elements.  Character references are decoded; cut-off markup is read as far
    as it goes; pages of any length are read whole.  Null ids and repeated rows each give a row; an empty table
    an empty result; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
    numbered = rows.withColumn("__page", F.xxhash64("__id", "__url"))
    templates = materialise(host_templates(numbered), "templates")
    total = int(templates.agg(F.sum("pages")).first()[0] or 0)
    host = F.translate(F.regexp_extract(F.coalesce("__url", F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lookup_groups(rows.withColumn("host", host), templates, "host", "pages", total, F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(source.as_py(), set(c.as_py() or ()), set(s.as_py() or ()))
                     for source, c, s in zip(b.column(2), b.column(3), b.column(4))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["__id", "__url", "text", "n_chars"])

    slim = cut.select("__id", "__url", "__html", "containers", "static")
    out = with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, __url string, text string, n_chars long")
    return out.withColumnsRenamed({"__id": id_col, "__url": url_col})
