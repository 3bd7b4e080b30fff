"""Main text of web pages: markup where it is explicit, nearest-URL page differencing for the rest.

A page is cut into blocks (lines of text between block elements). Blocks inside elements that are
never the article (menus, headers, footers, sidebars, notices, adverts, forms, comments: by element, role, or
the words of class and id) go; blocks of an ``article`` element are candidates that stay. All other blocks are open, and
differencing decides on them, whether or not the page has articles: pages of a host stand
in the order of their URL path, a page is aligned with the neighbour that shares the longer
start of the path (longest common subsequence of the two pages' lines), and open lines that both pages share are
deleted as the host's template. A neighbour that shares most of the page's candidates and open text is a mirror of the page, not
a sibling: the other neighbour is taken, or nothing is deleted.

Where open blocks are left beside articles, the page's text is whichever of the two is longer, and always the open blocks of
its ``main`` element: articles that are shorter than the rest are cards that lead to other pages. Blocks of an article are not
deleted even if a neighbour has them too: articles do repeat passages of others, and those are their text.

Differencing alone cannot give right results on pages whose menus and adverts differ from page to page,
nor on a host with one page; that is why markup decides first.

Only hashes of lines travel between pages. Pages are dealt out by ranges of (host, path), so a
host of any size is split; the page at an end of a range meets its neighbour in the next range
in a second step over the two end pages of each range.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapecheck.llm import batches
from tapecheck.llm.tables import stored

#: A neighbour that shares this part of the candidates' and open text or more has the same text.
MIRROR = 0.6

# Names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
_NEVER = frozenset(
    "nav header footer aside form button select textarea noscript template iframe svg canvas object audio video dialog menu head title search".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class and id that mark what is not the article.
_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer sidebar aside ad ads advert adverts advertisement "
    "adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup "
    "social share sharing sharebar related recommended recommendations comments comment commentlist disqus respond reply replies login search searchform "
    "widget widgets pagination pager pagenav skip skiplink toolbar".split()
)
#: A tag ends at the first > outside quotes if it has at most 256 quoted and unquoted pieces, else at the first one.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'){0,256}+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S
)
_MARK = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_OPEN_COMMENT = re.compile(r"<!--.*", re.S)
_WORD = re.compile(r"[a-zA-Z]+")
_RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style")}


def _marked(name: str, attributes: str) -> bool:
    if name in _NEVER:
        return True
    if not attributes or attributes.isspace() or name in ("html", "body", "article", "main"):
        return False
    for m in _MARK.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.strip() in _ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id") and not _WORDS.isdisjoint(_WORD.findall(value)):
            return True
    return False


#: What a block is: text of an article, text that is never the article, open, or open inside a main element.
ARTICLE, NEVER, OPEN, MAIN = 0, 1, 2, 3


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, kind) of the page's blocks in order; references decoded, white space runs as one space.

    Broken markup takes linear time too: what follows the last ``>`` is text, and an end tag without an open
    element is known by a count. An unclosed comment, script or style reaches to the page's end.
    """
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements and whether they are marked
    count: Counter[str] = Counter()  # open elements by name
    marked = article = main = 0
    at, last = 0, page.rfind(">")

    def end() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, NEVER if marked else ARTICLE if article else MAIN if main else OPEN))

    while at < len(page):
        # beyond the last > only an unclosed comment is no text
        tag = _TAG.search(page, at) if at <= last else _OPEN_COMMENT.search(page, at)
        parts.append(page[at : tag.start()] if tag else page[at:])
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower() if tag.re is _TAG else ""
        if not name:
            continue
        if name in _BLOCK:
            end()
        elif name in ("br", "td", "th"):
            parts.append(" ")
        if tag[1] or tag[4]:
            if count[name]:
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                count.subtract(x for x, _ in stack[depth:])
                if any(x in _BLOCK or m for x, m in stack[depth:]):
                    end()
                marked -= sum(m for _, m in stack[depth:])
                article -= sum(x == "article" for x, _ in stack[depth:])
                main -= sum(x == "main" for x, _ in stack[depth:])
                del stack[depth:]
            continue
        attributes = tag[3] or tag[6] or ""
        if name in _RAW_END:
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        never = _marked(name, attributes)
        if never and name == "header" and article and not marked:
            never = False  # an article's own header holds its headline
        if never:
            end()
        marked += never
        article += name == "article"
        main += name == "main"
        # an element that ends where the next of its kind begins
        if name in ("p", "li", "tr", "dt", "dd") and stack and stack[-1][0] == name:
            marked -= stack.pop()[1]
            count[name] -= 1
        stack.append((name, never))
        count[name] += 1
    end()
    return out


def _main(found: list[tuple[str, int]], gone: set[int]) -> str:
    left = [(text, kind) for k, (text, kind) in enumerate(found) if kind != NEVER and k not in gone]
    articles = sum(len(text) for text, kind in left if kind == ARTICLE)
    wanted = ARTICLE if 2 * articles >= sum(len(text) for text, _ in left) else OPEN
    return "\n\n".join(text for text, kind in left if kind in (wanted, MAIN))


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of two lists of lines (bit-parallel)."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    out = list(range(low)) + list(range(len(a) - high, len(a)))
    known, other = set(a[low : len(a) - high]), set(b[low : len(b) - high])
    rows = [k for k in range(low, len(a) - high) if a[k] in other]
    columns = [x for x in b[low : len(b) - high] if x in known]
    at: dict[int, int] = {}
    for k, x in enumerate(columns):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(columns)) - 1
    state, states = full, []
    for k in rows:
        u = state & at[a[k]]
        state = ((state + u) | (state - u)) & full
        states.append(state)
    k, c = len(rows), len(columns)
    while k and c:
        if states[k - 1] >> (c - 1) & 1:
            c -= 1
        else:
            k -= 1
            if not k or states[k - 1] >> (c - 1) & 1:
                out.append(rows[k])
                c -= 1
    return sorted(out)


def _address(url: str | None) -> tuple[str, str]:
    try:
        u = urlsplit((url or "").strip())
        return (u.hostname or ""), u.path + ("?" + u.query if u.query else "")
    except ValueError:
        return "", url or ""


def _outlines(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        out: list[list] = [[], [], [], [], [], []]
        for url, page in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
            found = blocks(page or "")
            undecided = any(kind in (OPEN, MAIN) for _, kind in found)
            content = [k for k, (_, kind) in enumerate(found) if kind != NEVER] if undecided else []
            texts = pa.array([text for text, _ in found], pa.large_string())
            lines: list[int] = []
            for _, _, data, off in batches.chunks(texts):
                lines += batches.signed(batches.span_hashes(batches.prefix_hashes(data), off[:-1], off[1:])).tolist()
            for x, v in zip(
                out, (*_address(url), lines, content, [len(found[k][0]) for k in content], [found[k][1] != ARTICLE for k in content]), strict=True
            ):
                x.append(v)
        kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays(
            [batch["k1"], batch["k2"], *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))],
            names=["k1", "k2", "host", "path", "lines", "content", "sizes", "open"],
        )


OUTLINE = "k1 bigint, k2 bigint, host string, path string, lines array<bigint>, content array<int>, sizes array<int>, open array<boolean>"


def template_lines(page: dict, before: dict | None, after: dict | None) -> list[int]:
    """Open lines of ``page`` that go: those shared with the nearer neighbour that is no mirror."""
    if not page["content"]:
        return []

    def near(other: dict) -> int:
        k = 0
        while k < min(len(page["path"]), len(other["path"])) and page["path"][k] == other["path"][k]:
            k += 1
        return k

    others = [x for x in (before, after) if x is not None and x["host"] == page["host"]]
    total = sum(page["sizes"])
    for other in sorted(others, key=near, reverse=True):
        shared = set(common_lines(page["lines"], other["lines"]))
        both = [x for x in zip(page["content"], page["sizes"], page["open"], strict=True) if x[0] in shared]
        if sum(n for _, n, _ in both) < MIRROR * total:
            return [k for k, _, undecided in both if undecided]
    return []


PAGE = "struct<host:string,path:string,lines:array<bigint>,content:array<int>,sizes:array<int>,open:array<boolean>>"
STEP = f"k1 bigint, k2 bigint, gone array<int>, end string, page {PAGE}, inner {PAGE}"
_PAGE = pa.struct([("host", pa.string()), ("path", pa.string())] + [(k, pa.list_(t)) for k, t in (("lines", pa.int64()), ("content", pa.int32()), ("sizes", pa.int32()), ("open", pa.bool_()))])
_STEP = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("gone", pa.list_(pa.int32())), ("end", pa.string()), ("page", _PAGE), ("inner", _PAGE)])


def _neighbours(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one range of pages in order: the lines that go from each page. The range's end pages come with the one neighbour they have here."""
    out, before, page = [], None, None
    for after in chain((x for batch in rows for x in batch.to_pylist()), (None,)):
        if page is not None:
            key = {"k1": page["k1"], "k2": page["k2"]}
            if before is None or after is None:
                end = "both" if before is after else "first" if before is None else "last"
                out.append(key | {"gone": [], "end": end, "page": page, "inner": after if before is None else before})
            elif gone := template_lines(page, before, after):
                out.append(key | {"gone": gone})
        before, page = page, after
        if len(out) >= 256:
            yield pa.RecordBatch.from_pylist(out, _STEP)
            out = []
    yield pa.RecordBatch.from_pylist(out, _STEP)


def _ends(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        gone = []
        for x in batch.to_pylist():
            before = x["inner"] if x["end"] == "last" else x["before"]
            after = x["inner"] if x["end"] == "first" else x["after"]
            gone.append(template_lines(x["page"], before, after))
        yield pa.RecordBatch.from_arrays([batch["k1"], batch["k2"], pa.array(gone, pa.list_(pa.int32()))], names=["k1", "k2", "gone"])


def removed_blocks(pages: DataFrame) -> DataFrame:
    """(k1, k2, gone): the numbers of the blocks that differencing deletes from a page, for pages with any."""
    outlines = stored(pages.select("k1", "k2", "url", "html").mapInArrow(_outlines, OUTLINE), "outlines")
    order = ("host", "path", "k1", "k2")
    step = stored(outlines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, STEP), "neighbours")
    # two rows of each range: no more rows than ranges come together here
    along = Window.orderBy("page.host", "page.path", "k1", "k2")
    ends = step.where("end is not null").select(
        "k1", "k2", "end", "page", "inner", F.lag("page").over(along).alias("before"), F.lead("page").over(along).alias("after")
    )
    ends = ends.mapInArrow(_ends, "k1 bigint, k2 bigint, gone array<int>")
    return step.where("end is null").select("k1", "k2", "gone").union(ends).where(F.size("gone") > 0)


def _texts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        gone = batch["gone"].to_pylist()
        texts = [_main(blocks(page or ""), set(g or ())) for page, g in zip(batch["html"].to_pylist(), gone, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; a null html is empty, and so is a page without text.

    Pages whose url is null or cannot be read form one host of their own. Rows that repeat a
    page_id and html get the same text.
    """
    own = pages.select(
        F.coalesce(F.col("page_id").cast("bigint"), F.lit(-(2**63))).alias("k1"),
        F.xxhash64(F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))).alias("k2"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url"),
        F.col("html"),
    )
    gone = stored(removed_blocks(own).dropDuplicates(["k1", "k2"]), "gone")
    both = own.join(gone, ["k1", "k2"], "left").select("page_id", "url", "html", "gone")
    return both.mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint")
