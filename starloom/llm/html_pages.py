"""A small HTML reader: what the template deduction needs of a page."""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass, field

#: Elements without content, raw-text elements, and elements that start a block (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|xmp"
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
                  "option p pre section select summary table tbody td tfoot th thead title tr ul".split())
#: Open elements that a start tag ends without their end tag.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body div dl footer form header html main nav ol section table td th ul".split())
#: Elements, and words of class, id and role, whose text is not part of an article.
ASIDE_TAGS = frozenset("nav footer aside form button select head menu dialog video audio canvas object".split())
CONTAINERS = frozenset(("article", "main"))
_ASIDE_WORD = re.compile(
    r"(?:ads?|adsbygoogle|adsense|taboola|outbrain|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|sidebar|menu|nav"
    r"|navbar|navigation|breadcrumbs?|footer|masthead|contentinfo|complementary|comments?|replies|respond|disqus"
    r"|shar(?:e|ing)|social|related|newsletter|subscribe|login|signup|search|popup|modal|toolbar|pagination)\Z")
_HEADER_WORD = re.compile(r"(?:header|topbar)\Z")
#: Words that a name made of such words may hold besides (ad-slot, site-footer); has-sidebar is no such name.
_PLACE_WORD = re.compile(
    r"(?:site|page|main|global|primary|secondary|top|bottom|left|right|lists?|links?|box|block|area|section|container"
    r"|wrap|wrapper|inner|widgets?|buttons?|bar|slot|unit|items?|form|posts?|articles?|entry|text|message|icons?"
    r"|google|users?|readers?|visitors?|customers?|body|[\dx]+)\Z")
_REMARK_WORD = re.compile(r"(?:comments?|replies|respond|disqus)\Z")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Parts of class names that differ from page to page.
_NUMBERED = re.compile(r"[^\s_-]*\d[^\s_-]*")
_SUBJECT = re.compile(r"(?:category|cat|tag|tags|topic|subject|author|term|lang|slug|keyword)[_-]", re.I)
#: Elements that are never beside the article by their class or id.
_WHOLE = frozenset(("html", "body"))
#: Why a text is beside the article: a class word, or an element (or that it is hidden).
BY_WORD, BY_ELEMENT = 1, 2
_CONTENT_ROLE = re.compile(r"^(?:main|article)$", re.I)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/])[^>]*/>|<({RAW})(?=[\s/>])[^>]*>(.*?)(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-z][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


@dataclass
class Page:
    """Elements by path with their number, and text by block."""

    paths: dict[str, int] = field(default_factory=dict)
    containers: set[str] = field(default_factory=set)
    #: (block number, path of the element, text, inside a container, beside the article)
    texts: list[tuple[int, str, str, bool, bool]] = field(default_factory=list)


@dataclass(slots=True)
class _Open:
    """An open element.  ``region`` numbers the outermost container around it,
    ``doubt`` the one that class words put beside the article; ``remark`` tells
    whether it is among reader comments by a class word."""

    tag: str = ""
    path: str = ""
    region: int = 0
    doubt: int = 0
    aside: int = 0
    remark: bool = False


def read_page(source: str | None) -> Page:
    """Elements and texts of a page; a null or empty one has none.  Cut-off
    markup ends with the page, missing end tags are implied."""
    page, block, regions = Page(), 0, 0
    stack: list[_Open] = []
    found: list[tuple[int, str, str, _Open]] = []
    containers: list[tuple[str, int]] = []  # path, doubt
    inner: set[int] = set()  # doubted containers that are never the article if there is another text
    for m in _TOKEN.finditer(source or ""):
        raw, _, closing, tag, attributes, text = m.groups()
        if text is not None or tag and tag.lower() == "br":  # a line break is white space
            at = stack[-1] if stack else _Open()
            found.append((block, at.path, html.unescape(text or " "), at))
            continue
        if raw or not tag:
            block += bool(raw and raw.lower() in BLOCK)
            continue
        tag = tag.lower()
        block += tag in BLOCK
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        _imply_ends(stack, tag)
        up = stack[-1] if stack else _Open()
        classes, names, role, hidden = _names(attributes)
        holds = tag in CONTAINERS or bool(_CONTENT_ROLE.match(role))
        general = "" if holds or tag in _WHOLE else _path_names(classes)
        path = f"{up.path}>{tag}" + (f".{general}" if general else "")
        page.paths[path] = page.paths.get(path, 0) + 1
        region, doubt, aside = up.region, up.doubt, up.aside
        header, words, remark = _word_kinds(f"{names} {role}") if tag not in _WHOLE else (False, False, False)
        remark = remark or up.remark
        if tag in ASIDE_TAGS or hidden or not region and tag == "header":
            aside = BY_ELEMENT
        elif words or not region and header:
            aside = max(aside, BY_WORD)
        if aside < BY_ELEMENT and holds:
            regions += 1
            if aside:  # a class word is on it or around it
                if remark or region and not doubt:
                    inner.add(regions)
                doubt, aside = regions, 0
            region = region or regions
            containers.append((path, doubt))
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(_Open(tag, path, region, doubt, aside, remark))
    _settle(page, found, containers, inner)
    return page


def _settle(page: Page, found: list[tuple[int, str, str, _Open]], containers: list[tuple[str, int]],
            inner: set[int]) -> None:
    """Whether containers that class words put beside the article are it: one
    is if it has more text than all that is surely not beside it.  One among
    reader comments, or inside a plain container, is only if there is no such text."""
    plain = {p for p, doubt in containers if not doubt}
    sizes, surely = {}, 0
    if any(doubt for _, doubt in containers):
        for _, _, text, at in found:
            if not at.aside:
                n = len(" ".join(text.split()))
                if at.doubt:
                    sizes[at.doubt] = sizes.get(at.doubt, 0) + n
                elif at.region or not plain:
                    surely += n
    taken = {0} | {doubt for doubt, n in sizes.items() if n > (surely if doubt not in inner or not surely else n)}
    page.containers = {p for p, doubt in containers if doubt in taken}
    page.texts = [(n, path, text, bool(at.region) and (at.doubt in taken), bool(at.aside) or at.doubt not in taken)
                  for n, path, text, at in found]
    if not page.containers and not any(text.strip() for _, _, text, _, aside in page.texts if not aside):
        # no more than the check is left: without it, elements alone decide
        page.texts = [(n, path, text, False, at.aside == BY_ELEMENT) for n, path, text, at in found]


@functools.lru_cache(100_000)
def _word_kinds(names: str) -> tuple[bool, bool, bool]:
    """Whether names hold one of a page header, one of a part beside the
    article, and one of reader comments.  A name counts whole: it is such a
    word, or made of such words and places."""
    header = beside = remark = False
    for name in names.lower().split():
        parts = [x for x in re.split("[_-]+", name) if x]
        if all(_ASIDE_WORD.match(x) or _HEADER_WORD.match(x) or _PLACE_WORD.match(x) for x in parts):
            beside = beside or any(_ASIDE_WORD.match(x) for x in parts)
            header = header or any(_HEADER_WORD.match(x) for x in parts)
            remark = remark or any(_REMARK_WORD.match(x) for x in parts)
    return header, beside, remark


@functools.lru_cache(100_000)
def _path_names(classes: str) -> str:
    """What a path keeps of a class attribute: names that say what an element
    is, in order, without the numbers and subjects of single pages."""
    names = {_NUMBERED.sub("#", x) for x in classes.split() if not _SUBJECT.match(x)}
    return ".".join(sorted(names))


def _names(attributes: str) -> tuple[str, str, str, bool]:
    """(class, class and id, role, whether hidden) of a start tag."""
    if not attributes or attributes.isspace():
        return "", "", "", False
    found = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes)}
    classes = found.get("class", "")
    return (classes, " ".join(x for x in (classes, found.get("id")) if x), found.get("role", ""),
            "hidden" in found or found.get("aria-hidden") == "true" or bool(_UNSEEN.search(found.get("style") or "")))


def _imply_ends(stack: list[_Open], tag: str) -> None:
    ends = ENDS.get(tag, {"p"} if tag in BLOCK else None)
    if not ends:
        return
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].tag in ends:
            del stack[i:]
            return _imply_ends(stack, tag) if len(ends) > 1 else None
        if stack[i].tag in SCOPE:
            return


def join_blocks(texts: list[tuple[int, str]]) -> str:
    """Blocks in page order, white space inside each one space, joined by line breaks."""
    blocks: dict[int, list[str]] = {}
    for number, text in texts:
        blocks.setdefault(number, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)
