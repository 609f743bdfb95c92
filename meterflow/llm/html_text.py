"""Main-text extraction by tree scoring.

Paragraphs pass points for their length and commas to their ancestors; an
element's points are discounted by the share of its text inside links.  The
best container is kept with the siblings that score well or read like
paragraphs.  Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles never count and never come out.  A class or id
alone doesn't drop what holds the page's only article, most of its paragraphs,
or, inside an article, plain paragraphs under a name that may be content's.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_REST = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_TAG_SIGN = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements whose text is never main text.
DROPPED = frozenset("head script style noscript template iframe svg canvas object nav footer aside form button select textarea "
                    "input dialog menu audio video map title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
                  "caption legend".split())
#: Words in a class, id or role that mark what surrounds an article.
MARKED = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar comment comments disqus reply "
                   "replies respond cookie cookies consent notice notices popup modal overlay newsletter subscribe subscription share sharing "
                   "social breadcrumb breadcrumbs menu nav navbar navigation footer masthead related widget toolbar pagination pager login "
                   "signup skip complementary contentinfo search alert disclaimer gdpr paywall".split())
#: Words that make a name tell of a layout, as in with-sidebar and no-banner.
LAYOUT = frozenset("with without no has".split())
#: Marked words that also occur in names of content, as in related-work and search-results.
AMBIGUOUS = frozenset("related search share sharing social notice notices alert disclaimer menu subscription reply replies skip".split())
#: Marked words of what readers write, which may be longer than the article.
READERS = frozenset("comment comments disqus reply replies respond".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = frozenset("ul ol table dl div article section main body html select".split())
PARAGRAPH = frozenset("p pre blockquote td dd li".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "drop", "score", "size", "linked", "own", "mark", "inside", "apart")

    def __init__(self, tag, parent, drop=False, mark=frozenset()):
        self.tag, self.parent, self.drop, self.mark = tag, parent, drop, mark
        self.parts: list = []  # child nodes and decoded strings, in page order
        self.score = 0.0
        self.size = self.linked = 0
        self.own = ""
        self.apart = frozenset()  # of an article: words in its name that mark what is not main text
        #: Whether it is an article or main, or lies in one.
        self.inside = tag in ("article", "main") or parent is not None and parent.inside


class _TagEnds:
    """Where tags end, each found in time that adds up to the length of the page.

    A tag ends at the next ``>`` outside quotes.  Once a tag turns out to have
    no end, the ends from every sign on are worked out together, backwards.
    """

    def __init__(self, page: str):
        self.page, self.signs, self.ends = page, None, None

    def end(self, at: int) -> int:
        """Index of the ``>`` that ends the tag whose name ends at ``at``; -1 if none does."""
        if self.signs is None:
            m = _TAG_REST.match(self.page, at)
            if m:
                return m.end() - 1
            self.signs = [m.start() for m in _TAG_SIGN.finditer(self.page)]
            self.ends = [-1] * len(self.signs)
            out = double = single = -1  # the end, for a reader that is outside quotes or inside them, after this sign
            for k in range(len(self.signs) - 1, -1, -1):
                c = self.page[self.signs[k]]
                out, double, single = (self.signs[k] if c == ">" else double if c == '"' else single,
                                       out if c == '"' else double, out if c == "'" else single)
                self.ends[k] = out
        k = bisect_left(self.signs, at)
        return self.ends[k] if k < len(self.signs) else -1


def _marked(tag: str, attributes: str, inside: bool) -> tuple[bool, frozenset]:
    """Whether an element is hidden, and the words that mark it; names of a layout don't."""
    words: set = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden":
            return True, frozenset()
        v = value.strip("\"'")
        if name == "aria-hidden" and v == "true" or name == "style" and re.search(r"display\s*:\s*none", v):
            return True, frozenset()
        if name in ("class", "id", "role"):
            for token in v.split():
                part = {w.lower() for w in _NAME_PART.findall(token)}
                if part & LAYOUT:
                    continue
                found = part & MARKED
                if "header" in part and not inside and tag not in ("h1", "h2", "h3", "article", "main"):
                    found = found | {"header"}
                # a lone ambiguous word, or one beside other marks, marks for certain
                words |= {f"{w}-" if w in AMBIGUOUS and part - MARKED else w for w in found}
    return False, frozenset(words)


def _spare(nodes: list[Node]) -> None:
    """Undo the drop of elements that are marked by a name only, but hold the page's main text."""
    marked = [x for x in nodes if x.mark]
    if not marked:
        return
    soft, gone, plain, named = set(marked), {}, {}, {}
    for x in nodes:  # parents come first
        up = x.parent
        gone[x] = up is not None and gone[up] or x.drop and x not in soft
        # no marked element around x, itself included
        plain[x] = (up is None or plain[up]) and x not in soft
        named[x] = x.tag in ("article", "main") or up is not None and named[up]
    free = any(x.tag in ("article", "main") and plain[x] and not gone[x] for x in nodes)
    points, holds = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, False)
    linked, size, commas = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for x in reversed(nodes):
        if gone[x]:
            continue
        text = _SPACE.sub(" ", "".join(p for p in x.parts if isinstance(p, str))).strip()
        size[x] += len(text)
        commas[x] += text.count(",")
        if x.tag == "a":
            linked[x] = size[x]
        if text and (x.tag in PARAGRAPH or x.tag in BLOCK):
            p = 1 + commas[x] + size[x] / 100 if x.tag in PARAGRAPH else _points(text)
            points[x] += (p / 10 if x.tag in PARAGRAPH and size[x] < 25 else p) * (1 - linked[x] / size[x])
        holds[x] = holds[x] or x.tag in ("article", "main")
        up = x.parent
        if up is not None:
            points[up] += 0 if x.mark & READERS else points[x]
            commas[up] += commas[x]
            size[up] += size[x]
            linked[up] += linked[x]
            holds[up] = holds[up] or holds[x]
    most = points[nodes[0]] / 2
    for x in marked:
        if gone[x] or x.tag in DROPPED:
            continue
        if named[x]:  # inside an article
            content = all(w.endswith("-") for w in x.mark) and size[x] > 80 and linked[x] < 0.25 * size[x]
        else:
            content = not free and not x.mark & READERS and (holds[x] or points[x] > most)
        if content:
            x.drop = False


def _markup(page: str):
    """The page's text and markup in order: ('text', from, to), ('close', tag, '', end) and ('open', tag, attributes, end).

    The caller may send a position to go on from.  What looks like markup
    but has no end is text.
    """
    at = seek = 0
    ends, last = _TagEnds(page), page.rfind(">")
    while True:
        m = _MARKUP.search(page, seek)
        if not m:
            break
        i, kind = m.start(), m[0][1]
        if m[0] == "<!--":
            stop = page.find("-->", i + 4)
            found, end = None, len(page) if stop < 0 else stop + 3
        elif i > last:
            seek = i + 1
            continue
        elif kind in "!?":
            found, end = None, page.find(">", i) + 1
        else:
            name = _NAME.match(page, i)
            stop = page.find(">", name.end()) if kind == "/" else ends.end(name.end())
            if stop < 0:
                seek = i + 1
                continue
            end = stop + 1
            found = ("close" if kind == "/" else "open", name[1].lower(), page[name.end():stop])
        if i > at:
            yield "text", at, i, 0
        at = seek = end
        if found:
            on = yield *found, end
            if on is not None:
                at = seek = on
                yield  # the answer to send()
    if at < len(page):
        yield "text", at, len(page), 0


def parse(page: str) -> list[Node]:
    """Elements in page order, the root first; open elements are closed as browsers close them."""
    root = Node("html", None)
    nodes, stack, n = [root], [root], len(page)
    opened: dict[str, int] = {}  # open elements by tag: walks over the stack that would find nothing are left out
    endless: set[str] = set()

    def leave(i: int) -> None:
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]

    def close(tags: set[str]) -> None:
        if not any(opened.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return leave(i)
            if stack[i].tag in SCOPE:
                return None

    markup = _markup(page)
    for what, tag, rest, at in markup:
        if what == "text":
            stack[-1].parts.append(html.unescape(page[tag:rest]))
        elif what == "close":
            if opened.get(tag):
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                leave(i)
        elif tag != "html":
            if tag in BLOCK:
                close({"p"})
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag])
            if tag == "body":  # an unclosed head ends here
                close({"head"})
            up = stack[-1]
            inside = up.inside
            hidden, mark = _marked(tag, rest, inside) if rest and tag not in ("html", "body", "article", "main") else (False, frozenset())
            hidden = hidden or tag in DROPPED or tag == "header" and not inside
            node = Node(tag, up, hidden or bool(mark), frozenset() if hidden else mark)
            if tag == "article" and rest:
                node.apart = _marked(tag, rest, inside)[1]
            up.parts.append(node)
            nodes.append(node)
            if tag in VOID or rest.endswith("/") and tag not in BLOCK | RAW:
                continue
            if tag in RAW:
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                if not end:
                    endless.add(tag)
                if end or tag != "noscript":
                    stop = page.find(">", end.end()) if end else n
                    markup.send(n if stop < 0 else stop + 1 if end else n)
                    continue
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1
    return nodes


def _blocks(top: list[Node]) -> list[str]:
    """Text of the elements' blocks in page order, white space folded."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        t = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if t:
            out.append(t)

    todo: list = [*reversed(top)]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif not x.drop:
            if x.tag == "br":
                held.append(" ")
            elif x.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(x.parts))
    flush()
    return out


def _measure(nodes: list[Node]) -> None:
    """Text and linked text of every element, without what is dropped."""
    for x in nodes:
        x.size = x.linked = 0
        if x.parent is not None and x.parent.drop:
            x.drop = True
    for x in reversed(nodes):  # children come after their parents
        if x.drop:
            continue
        own = _SPACE.sub(" ", "".join(p for p in x.parts if isinstance(p, str))).strip()
        x.own = own
        x.size += len(own)
        if x.tag == "a":
            x.linked = x.size
        if x.parent is not None:
            x.parent.size += x.size
            x.parent.linked += x.linked


def _points(text: str) -> float:
    p = 1 + text.count(",") + len(text) / 100
    return p if len(text) >= 25 else p / 10


def _goes_on(x: Node, rank: dict, of: float) -> bool:
    """Whether a sibling of the main article is an article of its own weight, hardly linked: the text goes on there."""
    return x.tag == "article" and not x.drop and not x.apart and x.linked < 0.25 * x.size and rank.get(x, 0) >= max(10, 0.2 * of)


def main_text(page: str | None) -> str:
    """Main text of a page: blocks joined by an empty line; '' where there is none."""
    if not page:
        return ""
    nodes = parse(page)
    _spare(nodes)
    _measure(nodes)
    longest = max((x.size for x in nodes if x.tag == "article" and not x.drop and not x.apart), default=-1)
    for x in nodes:  # readers' articles beside one that is as long
        if x.apart & READERS and x.size <= longest:
            x.drop = True
    for x in nodes:  # lists of links are menus
        if not x.drop and x.tag in ("ul", "ol") and x.size and x.linked > 0.9 * x.size and sum(isinstance(p, Node) for p in x.parts) > 1:
            x.drop = True
    _measure(nodes)
    for x in nodes:
        if x.drop or not x.size:
            continue
        if x.tag in PARAGRAPH and not any(isinstance(p, Node) and p.tag in BLOCK and not p.drop for p in x.parts):
            text = " ".join(_blocks([x]))
        elif x.tag in BLOCK and x.own:
            text = x.own
        else:
            continue
        share, up = _points(text) * (1 - x.linked / x.size), x.parent if x.tag in PARAGRAPH else x
        for part in (1.0, 0.5, 0.25):
            if up is None:
                break
            up.score += share * part
            up = up.parent
    held = [x for x in nodes if not x.drop and x.score > 0]
    if not held:
        named = [x for x in nodes if x.tag in ("article", "main") and not x.drop and x.size]
        return "\n\n".join(_blocks(named[:1]))
    rank = {x: x.score * (1 - x.linked / max(x.size, 1)) * (1.25 if x.tag in ("article", "main") else 1) for x in held}
    best = max(held, key=rank.get)  # ties: the first on the page, the outer one
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        parts = [x for x in up.parent.parts if isinstance(x, Node)] if up.tag == "article" else [up]
        return "\n\n".join(_blocks([x for x in parts if x is up or _goes_on(x, rank, rank.get(up, 0))]))
    if best.parent is None:
        return "\n\n".join(_blocks([best]))
    kept = []
    for x in best.parent.parts:
        if x is best:
            kept.append(x)
        elif isinstance(x, Node) and not x.drop and x.size:
            plain = x.linked < 0.25 * x.size
            # a sibling is judged by its own text: sentences, hardly linked, in blocks that earn points
            sentences = x.size >= 25 and any(t.rstrip("\"')\u201d\u2019").endswith((".", "!", "?", ":", "\u2026")) for t in _blocks([x]))
            earned = x.tag in PARAGRAPH or rank.get(x, 0) >= 0.5 * x.size / 100
            if rank.get(x, 0) >= max(10, 0.2 * rank[best]) or plain and (sentences and earned or x.tag == "p" and x.size > 80
                                                                         or x.tag in ("h1", "h2", "h3") and not kept):
                kept.append(x)
    return "\n\n".join(_blocks(kept))


def _extract(batches):
    for b in batches:
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages``.

    A null or empty html, or one without main text, gives an empty text.
    Null ids and urls stay null, repeated rows stay repeated, other columns
    are ignored, and an empty table gives an empty result.  The time for a
    page grows with its length, whatever the markup: tags without an end are
    text, and unclosed or deeply nested elements are walked once.  Of
    containers with equal scores the first on the page is the best.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
