"""Main text of web pages by tag-path ratios.

A page becomes its text blocks, each with the path of block elements from the
root to it. Blocks of one path share their statistics: characters, characters
inside links, punctuation marks and the number of blocks.

1. Aggregate: the text ratio of a path is its characters per block, the
   punctuation ratio its marks per block; the same is summed for every prefix.
2. Smooth: a path's ratio is mixed with the smoothed ratio of its parent path,
   so a headline or a short list stands by the text beside it.
3. Fuse: the geometric mean of both ratios, times the share of text outside
   links (where no article is marked, links count twice), times the path's prior. The prior is 0 for what a page marks as
   navigation, form, notice, advert, comment and the like, and, on a page that
   marks its article, for all outside it.
4. Threshold: paths whose score reaches a share of the page's mean score (by
   character) are content; their blocks make the text in page order.

On a page that marks its article the share is small, as only link lists are to
go (a header inside the article holds its headline and stays); elsewhere it is
larger.

Defined results: null and empty pages, and pages without content, give an empty
text; null ids and urls stay; repeated rows are answered each; malformed markup
is read leniently (unclosed elements end with their parents, an unclosed tag or
comment ends the page, unknown references stay as they are); a very long page
is read whole in time linear in its length; an empty table gives no rows;
columns other than id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table

INHERIT = 0.5  # weight of the parent path in a path's smoothed ratios
MARKED_SHARE = 0.001
PLAIN_SHARE = 0.5
SOFT = 0.05  # prior of a path that only a class or id name speaks against, on a page without a marked article

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())  # read up to their end tag
DROPPED = frozenset("aside audio button canvas dialog footer form head math menu nav object search select svg template video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOT_CONTENT = frozenset(  # words of class and id names
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination paywall popup promo promoted promotion recommended related respond share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget widgets".split())
SIMPLE_TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*)([^>"']*)>""")
TAG_START = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：؟،]")
CLOSES_P = BLOCKS - frozenset("body caption html tbody td tfoot th thead tr".split())
SCOPE = frozenset("article aside body button caption div html main nav section table td th".split())
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
             "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
             **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr"}, {"table"}))}


def tags(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name or text, attributes)``: kind ``t`` text, ``s`` start tag, ``e`` end tag. Each character is looked at a fixed number of times."""
    at, n = 0, len(page)
    no_more = {'"': n, "'": n}  # where the search for a closing quote last failed
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "t", page[at:], ""
            return
        if lt > at:
            yield "t", page[at:lt], ""
        if page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):  # an empty comment
                end = page.find(">", lt + 4) + 1
            else:
                end = page.find("-->", lt + 4) + 3
            at = end if end > 3 else n
            continue
        tag = SIMPLE_TAG.match(page, lt + 1)
        if tag:
            close, name, attrs, end = tag[1], tag[2], tag[3], tag.end()
        elif start := TAG_START.match(page, lt + 1):
            close, name = start[1], start[2]
            end = _tag_end(page, start.end(), no_more)
            attrs = page[start.end():end - 1]
        elif page.startswith(("<!", "<?", "</"), lt):
            end = page.find(">", lt) + 1 or n
            at = end
            continue
        else:  # a plain less-than sign
            yield "t", "<", ""
            at = lt + 1
            continue
        name, at = name.lower(), end
        if not close and name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, end)
            if not stop:
                return
            at = page.find(">", stop.end()) + 1 or n
            continue
        yield ("e" if close else "s"), name, attrs


def _tag_end(page: str, at: int, no_more: dict[str, int]) -> int:
    """Place after the ``>`` of a tag with quoted values (the end of the page if there is none)."""
    quote = re.compile(r"""[>"']""")
    begin = at
    while found := quote.search(page, at):
        c = found[0]
        if c == ">":
            return found.end()
        after_equals = page[begin:found.start()].rstrip()[-1:] == "=" if found.start() - begin < 4096 else True
        close = page.find(c, found.end()) if after_equals and found.end() < no_more[c] else -1
        if close < 0:  # a stray quote is a character like others
            if after_equals:
                no_more[c] = min(no_more[c], found.end())
            at = found.end()
        else:
            at = begin = close + 1
    return len(page)


class PathTree:
    """Paths of block elements, parents first, with the sums over their own blocks."""

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.parent: list[int] = []
        self.prior: list[tuple[float, bool]] = []  # (prior, inside a marked article)
        self.sums: list[list[int]] = []  # blocks, characters, characters in links, punctuation

    def child(self, parent: int, label: str, prior: float, marked: bool) -> int:
        key = (parent, f"{label}|{prior}|{marked}")
        if key not in self.number:
            self.number[key] = len(self.parent)
            self.parent.append(parent)
            self.prior.append((prior, marked))
            self.sums.append([0, 0, 0, 0])
        return self.number[key]

    def content(self) -> list[bool]:
        """Which paths are content: smooth, fuse, threshold."""
        n = len(self.parent)
        has_article = any(m for _, m in self.prior)
        prior = [(p if m else 0.0) if has_article else p for p, m in self.prior]
        if has_article:
            prior = [0.0 if p < 1 else 1.0 for p in prior]
        total = [[x if p else 0 for x in s] for s, p in zip(self.sums, prior)]
        for i in range(n - 1, 0, -1):
            for k, x in enumerate(total[i]):
                total[self.parent[i]][k] += x
        text, marks, score = [0.0] * n, [0.0] * n, [0.0] * n
        for i in range(n):
            blocks, chars, _, punct = total[i]
            own = (chars / blocks, punct / blocks) if blocks else (0.0, 0.0)
            keep = INHERIT if i else 0.0
            text[i] = (1 - keep) * own[0] + keep * text[self.parent[i]]
            marks[i] = (1 - keep) * own[1] + keep * marks[self.parent[i]]
            _, chars, links, _ = self.sums[i]
            outside = 1 - (1 if has_article else 2) * links / chars if chars else 0.0
            score[i] = prior[i] * max(0.0, outside) * (text[i] * (1 + marks[i])) ** 0.5
        weight = sum(s[1] for s, p in zip(self.sums, prior) if p)
        mean = sum(s[1] * x for s, x in zip(self.sums, score)) / weight if weight else 0.0
        least = (MARKED_SHARE if has_article else PLAIN_SHARE) * mean
        return [x > 0 and x >= least for x in score]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _element(name: str, raw: str, prior: float, marked: bool) -> tuple[float, bool]:
    """Prior and article mark of an element from its parent's."""
    attrs = _attributes(raw) if raw.strip("/ \t\r\n") else {}
    role = attrs.get("role", "").lower()
    if (name in DROPPED or name == "header" and not marked or role in DROPPED_ROLES or "hidden" in attrs
            or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style", ""))):
        return 0.0, marked
    if name not in ("html", "body", "main"):
        words = {w.lower() for k in ("class", "id") for w in NAMES.findall(attrs.get(k, ""))}
        if words & NOT_CONTENT and not (name == "article" and "comment" not in words and "comments" not in words):
            return min(prior, SOFT), marked
    if prior and (name in ("article", "main") or role in ("article", "main") or attrs.get("itemprop") == "articleBody"):
        return (1.0 if name == "main" or role == "main" else prior), True
    return prior, marked


def page_blocks(page: str) -> tuple[PathTree, list[tuple[int, str]]]:
    """The paths of a page and its text blocks ``(path, text)`` in page order."""
    tree = PathTree()
    root = tree.child(-1, "", 1.0, False)
    stack: list[tuple[str, int, float, bool]] = [("", root, 1.0, False)]
    is_open: dict[str, int] = {}
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    links = 0

    def flush():
        nonlocal links
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            _, path, prior, marked = stack[-1]
            chars = len(text) - text.count(" ")
            if links >= chars:  # the leaf of this path is a link
                path = tree.child(path, "a", prior, marked)
            s = tree.sums[path]
            s[0] += 1
            s[1] += chars
            s[2] += links
            s[3] += len(PUNCTUATION.findall(text))
            blocks.append((path, text))
        parts.clear()
        links = 0

    def pop():
        name = stack[-1][0]
        if name in BLOCKS:
            flush()
        stack.pop()
        is_open[name] -= 1

    def close(names: set, stop: frozenset | set):
        """Close the nearest open element of ``names``, unless one of ``stop`` lies in between."""
        if not any(is_open.get(x) for x in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in stop:
                return

    for kind, name, raw in tags(page):
        if kind == "t":
            if stack[-1][2]:
                text = html.unescape(name) if "&" in name else name
                parts.append(text)
                if is_open.get("a"):
                    links += len("".join(text.split()))
        elif kind == "s":
            block = name in BLOCKS
            if block:
                if name in CLOSES_P:
                    close({"p"}, SCOPE)
                if name in CLOSED_BY:
                    close(*CLOSED_BY[name])
                if name[0] == "h" and name[1:].isdigit():
                    close({"h1", "h2", "h3", "h4", "h5", "h6"}, SCOPE)
                flush()
            elif name == "br":
                parts.append(" ")
            if name in VOID:
                continue
            if name == "a":
                close({"a"}, SCOPE)
            _, path, prior, marked = stack[-1]
            own, inside = _element(name, raw, prior, marked)
            if block:
                path = tree.child(path, name, own, inside)
            elif 0 < own < prior:  # a name speaks against a part of a block: it goes where the article is marked
                own = 0.0 if marked else prior
            stack.append((name, path, own, inside))
            is_open[name] = is_open.get(name, 0) + 1
        elif is_open.get(name):
            while stack[-1][0] != name:
                pop()
            pop()
    while len(stack) > 1:
        pop()
    flush()
    return tree, blocks


def main_text(page: str | None) -> str:
    """The content blocks of a page, a line each."""
    if not page:
        return ""
    tree, blocks = page_blocks(page)
    keep = tree.content()
    return "\n".join(text for path, text in blocks if keep[path])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; nothing is shuffled."""
    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h if h is None else h.decode("utf-8", "replace")) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": list(map(len, texts))}

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("binary").alias("html"))
    return arrow_map(rows, run, "page_id long, url string, text string, n_chars long")


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
