"""Main text of web pages by differencing pages that have near URLs.

Pages of a host are put in order of their URL's path, and each page is paired with
the neighbour whose path shares the longer head with its own. Both are cut into
lines (one per block of text), the lines are aligned by a longest common
subsequence, and shared lines are deleted, as templates repeat from page to
page and articles don't. A check by the page's own structure follows, line by line: a shared
line that stands in what the page marks as its article is put back, and what a page marks as menu, header,
footer, sidebar, notice, advert, form or comment goes, shared or not. All other lines are
left to differencing, on pages with a marked article too. Copies of a page tell nothing about its
template, so they are passed over for the nearest page that is different.
"""

from __future__ import annotations

import html
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.common import text_of
from ledgertag.llm.neighbours import OWN, in_runs

PLAIN, MAIN, CHROME = 0, 1, 2
#: Pages of one host that have this part of their text in common are copies.
COPY = 0.95

# Names of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
    "nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object".split())
CHROME_ELEMENTS = frozenset("nav aside footer form menu dialog button select fieldset search".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Classes and ids that mark what isn't the article, as whole names: "related-work" isn't "related".
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent notice notices popup modal "
    "newsletter subscribe signup login share sharing social comment comments reply replies disqus related widget "
    "pagination pager toolbar cookie-notice cookie-banner cookie-consent site-header site-footer site-nav main-nav "
    "main-menu related-posts related-articles share-buttons social-share comment-list skip-link".split()
)
#: An article may have such parts of its own, as it does the element ``header``.
CHROME_INSIDE = CHROME_WORDS - {"header", "banner", "masthead"}
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 p".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">])*>""",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKED = re.compile(r"""[\s"'/](?:class|id|role|hidden)\b""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def attributes(tag: str) -> dict[str, str]:
    """The attributes of a tag, names in lower case; of repeated ones the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag, _NAME.match(tag).end()):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _kind(name: str, tag: str, outer: int) -> int:
    """What the text inside a tag is, by its name and attributes."""
    if outer == CHROME or name in CHROME_ELEMENTS or (name == "header" and outer != MAIN):
        return CHROME
    found = MAIN if name in ("article", "main") else outer
    if not _MARKED.search(tag):
        return found
    marks = attributes(tag)
    roles = marks.get("role", "").lower().split()
    if "hidden" in marks or not CHROME_ROLES.isdisjoint(roles[:1]):
        return CHROME
    if roles[:1] in (["main"], ["article"]):
        found = MAIN
    words = {*marks.get("class", "").lower().split(), *marks.get("id", "").lower().split()}
    if name in ("article", "main"):
        chrome = words & {"comment", "comments", "reply"}
    elif name in ("html", "body") or (outer == MAIN and name in TEXTS):
        chrome = None
    else:
        chrome = words & (CHROME_INSIDE if outer == MAIN else CHROME_WORDS)
    return CHROME if chrome else found


def lines_of(page: str) -> list[tuple[str, int]]:
    """The lines of a page in order, and what the page's structure says of each.

    A line is the text of one block with references decoded and white space
    folded. Tags may be unclosed: a closing tag ends what was opened inside it, one
    that matches nothing is ignored. What stands in raw elements, comments and
    unfinished tags at the end isn't text.
    """
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at, n = PLAIN, 0, len(page)
    lower = None

    def flush() -> None:
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if line:
                out.append((line, kind))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)  # an unfinished tag
            held.append(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        tag, at = m[0], m.end()
        if tag[1] in "!?":
            if tag.startswith("<![CDATA["):
                held.append(html.escape(tag[9:].removesuffix("]]>")))
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            if name in BLOCKS or name == "p":
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    flush() if stack[i][1] != kind else None
                    del stack[i:]
                    now = stack[-1][1] if stack else PLAIN
                    if now != kind:
                        flush()
                        kind = now
                    break
            continue
        if name in RAW:
            if not tag.endswith("/>"):
                if lower is None:
                    lower = page.lower() if len(page.lower()) == n else page
                end = lower.find("</" + name, at)
                at = n if end < 0 else (page.find(">", end) + 1 or n)
            continue
        if name in BLOCKS:
            flush()
        if name in VOID or tag.endswith("/>"):
            continue
        if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option"):  # closed by the next of their kind
            if stack and stack[-1][0] == name:
                stack.pop()
                kind = stack[-1][1] if stack else PLAIN
        inner = _kind(name, tag, kind)
        if inner != kind:
            flush()
        stack.append((name, inner))
        kind = inner
    flush()
    return out


def shared_lines(a: list[str], b: list[str], most_bits: int = 1 << 26) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence with ``b``.

    Equal heads and tails are in it, lines of one page alone aren't. Of what is left the table of the subsequence is
    kept as one bit string per line of ``a``; where that takes more than ``most_bits`` bits, both pages are
    cut in two at a place where the halves' subsequences are longest together (Hirschberg's way).
    """
    out = [False] * len(a)
    head, most = 0, min(len(a), len(b))
    while head < most and a[head] == b[head]:
        out[head] = True
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        out[-1 - tail] = True
        tail += 1
    both = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    mine = [i for i in range(head, len(a) - tail) if a[i] in both]
    todo = [(mine, [line for line in b[head : len(b) - tail] if line in both])]
    while todo:
        rows, other = todo.pop()
        if not rows or not other:
            continue
        lines = [a[i] for i in rows]
        if len(lines) * len(other) <= most_bits or len(lines) == 1:
            for i, shared in zip(rows, _traced(lines, other), strict=True):
                out[i] = shared
            continue
        half = len(lines) // 2
        first = _lengths(lines[:half], other)
        second = _lengths(lines[half:][::-1], other[::-1])[::-1]
        cut = max(range(len(other) + 1), key=lambda j: first[j] + second[j])
        todo += [(rows[:half], other[:cut]), (rows[half:], other[cut:])]
    return out


def _table(a: list[str], b: list[str]):
    """Per line of ``a`` a bit string: bit j is 0 where line j of ``b`` makes the common subsequence longer."""
    where: dict[str, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for line in a:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of ``a`` and the first 0, 1, ... lines of ``b``."""
    row = (1 << len(b)) - 1
    for row in _table(a, b):
        pass
    bits = bin(row)[2:].zfill(len(b))[::-1] if b else ""
    return list(accumulate((bit == "0" for bit in bits), initial=0))


def _traced(a: list[str], b: list[str]) -> list[bool]:
    rows = list(_table(a, b))
    out, i, j = [False] * len(a), len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                out[i] = True
                j -= 1
    return out


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None) -> str:
    """The lines that are left after differencing and the check by structure.

    Differencing that leaves nothing of a page doesn't count.
    """
    gone = shared_lines([x for x, _ in lines], [x for x, _ in partner or []])
    if not partner or all(out for (_, kind), out in zip(lines, gone, strict=True) if kind == PLAIN):
        # By structure alone, what stands outside a marked article isn't the article.
        gone = [any(kind == MAIN for _, kind in lines)] * len(lines)
    return "\n".join(
        line for (line, kind), out in zip(lines, gone, strict=True) if kind == MAIN or (kind == PLAIN and not out)
    )


def copies(a: list[tuple[str, int]], b: list[tuple[str, int]]) -> bool:
    """Whether two pages have all or nearly all of their text in common, by their distinct lines."""
    if a == b:
        return True
    x, y = {line for line, _ in a}, {line for line, _ in b}
    most = max(sum(map(len, x)), sum(map(len, y)))
    return sum(map(len, x & y)) >= COPY * most


def _common(a: str, b: str) -> int:
    """How many segments two paths share at their heads, and how many characters."""
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n].count("/") * 100_000 + n


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Id, URL, ``text`` (main text, blocks joined by newlines) of every page.

    A null page is empty and gives an empty text; a page without a different neighbour on its host is judged by its
    structure alone, as is any line that the page itself marks. Of copies that follow each other only ids and URLs are held in
    memory until a different page follows, and the lines of those that aren't quite equal. A different page is looked for among the pages of the same run (see ``in_runs``) and
    the ones at its borders, so copies that fill a run to its borders are judged by structure too. Pages without
    a URL count as one host. Equal paths are ordered by id and content; repeated rows stay repeated.
    An empty table gives an empty result; other columns are ignored.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    address = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)"
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        text_of(html_col).alias("_html"),
        F.lower(F.regexp_extract(url, address, 1)).alias("_host"),
        F.regexp_extract(url, address, 2).alias("_path"),
    )
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        before = first = after = None  # pages: (side, id, url, host, path, lines)
        copied: list[pa.Table | list] = []  # the group of the first page's copies: packed ones and the last few
        kind = pa.null()

        def pack(rows):
            ids, urls, paths, lines = zip(*rows, strict=True)
            return pa.table([pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(paths, pa.string())], ["i", "u", "p"]), lines

        def members():
            for part in copied:
                if isinstance(part, list):
                    yield from part
                else:
                    for at in range(0, len(part), 1000):
                        some = part.slice(at, 1000)
                        columns = (some[c].to_pylist() for c in ("i", "u", "p"))
                        yield from ((*x, first[5]) for x in zip(*columns, strict=True))

        def finish():
            """The group's own rows. Copies with the same partner have the same text."""
            near = [x for x in (before, after) if x is not None and x[3] == first[3]]
            texts: dict[int, str] = {}
            out = []
            for key, url_, path, lines in members():
                partner = max(near, key=lambda x: _common(x[4], path), default=None)
                if lines is not first[5]:
                    text = main_text(lines, partner[5] if partner else None)
                else:
                    at = next((k for k, x in enumerate(near) if x is partner), -1)
                    if at not in texts:
                        texts[at] = main_text(lines, partner[5] if partner else None)
                    text = texts[at]
                out.append((key, url_, text))
                if len(out) >= 500:
                    yield emit(out)
                    out = []
            if out:
                yield emit(out)

        def emit(out):
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                ["_id", "_url", "text"],
            )

        for b in batches:
            kind = b.schema.field("_id").type
            for i in range(b.num_rows):
                if first and first[0] > OWN:
                    break
                row = (
                    *(b.column(c)[i].as_py() for c in ("_side", "_id", "_url", "_host", "_path")),
                    lines_of(b.column("_html")[i].as_py()),
                )
                if first is None or first[3] != row[3] or not copies(first[5], row[5]):
                    if first:
                        after = row
                        yield from finish()
                        before = last
                    first, copied = row, [[]]
                elif row[5] == first[5]:
                    row = (*row[:5], first[5])
                last = row
                if row[0] == OWN:
                    copied[-1].append((*row[1:3], row[4], row[5]))
                    # Equal pages are packed; a page that is only nearly equal keeps its own lines.
                    if len(copied[-1]) >= 4096:
                        table, lines = pack(copied[-1])
                        if all(x is first[5] for x in lines):
                            copied[-1] = table
                        copied.append([])
        if first:
            after = None
            yield from finish()

    found = in_runs(
        rows, ["_host", "_path", "_id"], F.xxhash64("_html"), run, f"_id {id_type}, _url string, text string"
    )
    return found.withColumnsRenamed({"_id": id_col, "_url": url_col})
