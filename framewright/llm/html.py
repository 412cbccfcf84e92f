"""Main text of web pages, by a decision tree over flat text blocks.

A page becomes a flat list of text blocks. Regions that by their elements or names are no
article (menus, asides, forms, comments, adverts, headers and footers of the page) are known
from the page itself. Each other block is described by its number of words and its link
density, by those of the blocks before and after it, and by the kind of element it stands in,
and a small decision tree, trained here on the blocks of the hand-labelled pages in
``LABELLED``, tells which of them are main text.

Defined results: a null page is empty and has no text. A page without any block, or
without any block of main text, has an empty text. Unclosed and misnested elements end
with their surroundings; a tag that never ends is text. Any page is read in time in proportion
to its length, however broken. Repeated rows and rows with null ids are extracted like others.
An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
TAG_END = re.compile(r"""=\s*+(["'])|>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
# fixed values: elements of HTML, by what they do to text
SILENT = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "head", "title", "textarea", "select", "option", "button", "datalist"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input", "nobr"}
CONTENT = {"article", "main"}
FRAME = {"nav", "footer", "aside"}
#: These may also stand around an article, which then counts.
AROUND = {"form", "menu", "dialog"}
# names of regions: adverts, comments and the like; what may also name the layout around an article
ADVERT = r"ad|ads|adv|advert\w*|adsense|adbox|sponsor\w*|promo\w*|outbrain|taboola"
STRONG = re.compile(rf"(?:^|[\s_-])(?:{ADVERT}|cookies?\w*|consent|gdpr|comments?\w*|disqus|discussion|replies|reply|respond|reactions?|related\w*|recommend\w*|recirc|newsletter|subscri\w*|popup|modal|hidden)(?:$|[\s_-])", re.I)
WEAK = re.compile(r"(?:^|[\s_-])(?:banner|notice\w*|alert|warning|sidebar\w*|side|rail|menu\w*|nav\w*|footer\w*|header|masthead|topbar|toolbar|breadcrumbs?|share\w*|social\w*|signup|login|widget\w*|overlay|pager|pagination|copyright|legal|disclaimer|tags|taglist|skip\w*|search\w*)(?:$|[\s_-])", re.I)
FOND = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main\w*|post|post-?body|entry\w*|story\w*|body|text|prose)(?:$|[\s_-])", re.I)
INLINE_ADVERT = re.compile(rf"(?:^|[\s_-])(?:{ADVERT})(?:$|[\s_-])", re.I)
INLINE_UNSEEN = re.compile(r"(?:^|\s)(?:hidden|visually-hidden|visuallyhidden|sr-only|screen-reader-text)(?:$|\s)", re.I)
#: Names of states of a layout, which say what it has, not what it is.
STATE = re.compile(r"(?:^|(?<=\s))(?:(?:has|with|without|no|is|js)[-_]\S*|\S*[-_](?:enabled|disabled|open|closed|active|visible))(?=\s|$)", re.I)
TITLE_PART = re.compile(r"\b(?:article|entry|post|story|content|page)[-_]+(?:header|title|heading)", re.I)
HUMP = re.compile(r"([a-z])([A-Z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "in_content", "fond", "heading", "item"]


class Block:
    """A text block. ``outside``: it stands in a region that is no article. ``kinds``: in_content,
    fond, heading, item."""

    __slots__ = ("text", "words", "linked", "kinds", "outside", "label")

    def __init__(self, text, words, linked, kinds, outside, label):
        self.text, self.words, self.linked, self.kinds, self.outside, self.label = text, words, linked, kinds, outside, label


def tokens(page: str):
    """(text, closing, name, attributes): the page as text (name None) and tags. Each place is
    searched through a bounded number of times: what is known to come no more isn't sought again."""
    at, shown, size = 0, 0, len(page)
    quotes = ends = True
    gone: set[str] = set()
    while at < size:
        start = page.find("<", at)
        if start < 0:
            break
        end, name = -1, None
        if page.startswith("<!--", start):
            end = page.find("-->", start + 2)
            end = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", start) and "]]>" not in gone and (close := page.find("]]>", start)) >= 0:
            yield page[shown:start], False, None, ""
            yield page[start + 9 : close].replace("&", "&amp;"), False, None, ""
            at = shown = close + 3
            continue
        elif ends:
            closing = page.startswith("/", start + 1)
            m = NAME.match(page, start + 1 + closing)
            if m:
                i = m.end()
                while quotes:
                    q = TAG_END.search(page, i)
                    if q is None or q[1] and (i := page.find(q[1], q.end()) + 1) == 0:
                        quotes = False  # from here on, quotes would swallow the page
                    elif not q[1]:
                        end = q.end()
                        break
                if not quotes:
                    end = page.find(">", m.end()) + 1 or -1
                name = m[0].lower() if end > 0 else None
                ends = end > 0
            elif closing or page.startswith(("!", "?"), start + 1):
                end = page.find(">", start) + 1 or -1
                ends = end > 0
            if page.startswith("<![CDATA[", start):
                gone.add("]]>")
        if end < 0:  # no tag: text
            at = start + 1
            continue
        if start > shown:
            yield page[shown:start], False, None, ""
        at = shown = end
        if name is None:
            continue
        yield "", closing, name, page[m.end() : end - 1]
        if name in RAW and not closing and name not in gone:
            close = re.compile(rf"</{name}\s*+>", re.I).search(page, at)
            if close:
                at = shown = close.end()
                yield "", True, name, ""
            elif name in ("script", "style"):
                at = shown = size
            else:
                gone.add(name)
    if shown < size:
        yield page[shown:], False, None, ""


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    #: element, what its surroundings are, whether it ends a block
    stack: list[tuple[str, tuple, bool]] = []
    opened: Counter = Counter()
    #: content, frame, averse, fond, heading, item, header, silent, label
    bare = (0, 0, 0, 0, 0, 0, 0, 0, "")
    inside = bare
    parts: list[str] = []
    linked_parts: list[str] = []
    link_at = -1  # how deep the open link stands, if there is one

    def close():
        nonlocal parts, linked_parts
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                linked = len(entities.unescape(" ".join(linked_parts)).split())
                content, frame, averse, fond, heading, item, header = inside[:7]
                out.append(Block(text, text.count(" ") + 1, linked, (content, fond, heading, item), bool(frame or averse or (header and not content)), inside[8]))
            parts, linked_parts = [], []

    def pop():
        nonlocal inside, link_at
        name, before, ends = stack.pop()
        if ends:
            close()
        inside = before
        opened[name] -= 1
        if len(stack) < link_at:
            link_at = -1

    for text, closing, name, attributes in tokens(page):
        if name is None:
            if text and not inside[7]:
                parts.append(text)
                if link_at >= 0:
                    linked_parts.append(text)
            continue
        if closing:
            if name == "a":
                link_at = -1
            if name not in INLINE and name not in VOID and name not in SILENT:
                close()
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in SILENT:  # as if it were not there
            stack.append((name, inside, False))
            opened[name] += 1
            inside = (*inside[:7], 1, inside[8])
            continue
        if name == "a":
            link_at = len(stack)
        if name in VOID:
            if name not in INLINE:
                close()
            continue
        given, hint = {}, ""
        if attributes.strip():
            given = {k.lower(): v or w or x for k, v, w, x in ATTRIBUTE.findall(attributes)}
            hint = TITLE_PART.sub(" ", HUMP.sub(r"\1-\2", STATE.sub(" ", f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}")))
        unseen = UNSEEN.search(given.get("style", "")) or given.get("aria-hidden") == "true" or "hidden" in given
        if name in INLINE:
            advert = INLINE_ADVERT.search(hint) is not None
            unseen = unseen or INLINE_UNSEEN.search(given.get("class", ""))
            if advert or unseen or opened[name]:
                if advert:
                    close()
                stack.append((name, inside, advert))
                opened[name] += 1
                inside = (*inside[:2], 2 if advert else inside[2], *inside[3:7], 1 if unseen else inside[7], inside[8])
            continue
        close()
        if stack and stack[-1][0] == "head":
            pop()
        if name == "body":
            stack, inside, link_at = [], bare, -1
            opened.clear()
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
            pop()  # these end where the next begins
        if name != "p" and stack and stack[-1][0] == "p":
            pop()
        stack.append((name, inside, True))
        opened[name] += 1
        content, frame, averse, fond, heading, item, header, silent, label = inside
        if name in CONTENT:
            if not content:  # what stands around an article is the layout
                frame, averse = frame if frame > 1 else 0, averse if averse > 1 else 0
            content = 1
        elif name in FRAME:
            frame = 2
        elif name in AROUND:
            frame = max(frame, 1)
        elif name == "header":
            header = 1
        heading = int(name in ("h1", "h2", "h3", "h4", "h5", "h6"))
        item = int(name in ("li", "dt", "dd", "td", "th") or (item and name in ("p", "div", "span")))
        if name not in ("html", "body") and hint.strip():
            averse = max(averse, 2 if STRONG.search(hint) else 1 if WEAK.search(hint) else 0)
            fond = int(fond or FOND.search(hint) is not None)
        inside = (content, frame, averse, fond, heading, item, header, int(silent or bool(unseen)), given.get("data-label", label))
    close()
    return out


def described(blocks: list[Block]) -> np.ndarray:
    """The features of each block, in the order of FEATURES."""
    n = len(blocks)
    words = np.array([0] + [b.words for b in blocks] + [0], float)
    links = np.array([0] + [b.linked / b.words for b in blocks] + [0], float)
    kinds = np.array([b.kinds for b in blocks], float).reshape(n, 4)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], kinds])


class Tree:
    """A decision tree grown by Gini impurity. Nodes: (feature, cut, left, right) or a label."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
        self.nodes: list = []
        self._grow(x, y, depth, least)

    def _grow(self, x, y, depth, least) -> int:
        at = len(self.nodes)
        self.nodes.append(bool(y.mean() > 0.5) if len(y) else False)
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return at
        best = (1e-9, None)
        whole = y.mean() * (1 - y.mean()) * len(y)
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, left = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(y) + 1)
            cuts = np.flatnonzero((v[1:] > v[:-1]) & (n[:-1] >= least) & (len(y) - n[:-1] >= least))
            if not len(cuts):
                continue
            p, q = left[cuts] / n[cuts], (left[-1] - left[cuts]) / (len(y) - n[cuts])
            gain = whole - p * (1 - p) * n[cuts] - q * (1 - q) * (len(y) - n[cuts])
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                best = (gain[k], (f, (v[cuts[k]] + v[cuts[k] + 1]) / 2))
        if best[1] is None:
            return at
        f, cut = best[1]
        side = x[:, f] <= cut
        low = self._grow(x[side], y[side], depth - 1, least)
        high = self._grow(x[~side], y[~side], depth - 1, least)
        self.nodes[at] = (f, cut, low, high)
        return at

    def __call__(self, row) -> bool:
        node = self.nodes[0]
        while not isinstance(node, bool):
            node = self.nodes[node[2] if row[node[0]] <= node[1] else node[3]]
        return node


def train(pages: list[str] | None = None) -> Tree:
    """Grow the tree on labelled pages: blocks inside data-label="main" are main text."""
    x, y = [], []
    for page in LABELLED if pages is None else pages:
        found = blocks_of(page)
        known = np.array([not b.outside for b in found], bool)
        if known.any():
            x.append(described(found)[known])
            y += [b.label == "main" for b in found if not b.outside]
    return Tree(np.concatenate(x), np.array(y, float))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks_of(page or "")
    if not found:
        return ""
    return " ".join(b.text for b, row in zip(found, described(found).tolist()) if not b.outside and tree(row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(train())

    def over(batches):
        for batch in batches:
            text = [main_text(h, shared.value) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(over, f"page_id {kind}, url string, text string, n_chars long")


_S = "The harbour town had waited through the whole winter for the ferry to return, and when it came the piers were full of people."
_T = "Nobody could say who had first seen the lights; the baker swore it was his daughter, while the teacher wrote down another name."
_U = "In the years that followed, the line carried timber, salt and letters, until a road was built along the cliffs and the ships stayed away."
_LINKS = '<ul><li><a href="/a">Home</a></li><li><a href="/b">World news</a></li><li><a href="/c">Sport</a></li><li><a href="/d">Arts and books</a></li></ul>'
_MORE = '<ul><li><a href="/1">The ten best walks along the northern coast this year</a></li><li><a href="/2">Why old lamps are back in fashion again</a></li></ul>'


def _labelled_pages() -> list[str]:
    """The labelled table: pages of common layouts. What stands in data-label is main text."""
    m = ' data-label="main"'
    pages = []
    # an article element, with and without a header of its own; short paragraphs in between
    for paragraphs in ([_S, "So it was.", _T], [_T, "Yes.", "Of.", _U, "1 | 2 | 3"], ["Short.", _S], [_U]):
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        pages.append(f'<body><nav>{_LINKS}</nav><div class="ad">{_T}</div><article{m}><h1>The ferry returns</h1>{body}</article><footer>&copy; 2020 Coast Times. {_S}</footer></body>')
        pages.append(f'<body><header><h1><a href="/">Coast Times</a></h1><p>News from the coast since 1901</p></header><nav>{_LINKS}</nav><main{m}><h1>The ferry returns</h1>{body}<ul><li>timber from the north</li><li>salt and letters</li></ul></main><aside><h3>Read next</h3>{_MORE}<p>{_U}</p></aside><footer><p>All rights reserved by the publisher of this page.</p></footer></body>')
        # no helpful elements: only classes
        pages.append(f'<body><div id="header"><a href="/">Coast Times</a></div><div class="menu">{_LINKS}</div><div class="content"{m}><h2>The ferry returns</h2>{body}<blockquote>{_T}</blockquote></div><div class="sidebar"><p>{_S}</p>{_MORE}</div><div class="comments"><h4>3 comments</h4><p>I was there that day and remember the lights well, it was my cousin who saw them.</p><p>Nice.</p></div><div id="footer">Contact | Imprint | {_U}</div></body>')
        # an article with things inside that are not of it
        pages.append(f'<body><article><header><h1{m}>The ferry returns</h1></header><div{m}>{body}</div><div class="ad-box">{_U}</div><aside class="related">{_MORE}</aside><div{m}><p>{_S}</p></div><form action="/s"><p>Subscribe to our letter and never miss the news from the coast again.</p><label>Mail</label></form><section class="comments"><p>{_T}</p><p>First!</p></section><footer><p>Filed under ships and towns by the editors of the weekly edition.</p></footer></article></body>')
        # no hints at all: only the number of words and links
        pages.append(f'<body><div><a href="/">Coast</a> <a href="/n">News</a> <a href="/m">More</a></div><div{m}><h1>The ferry returns</h1>{"".join(f"<p>{p}</p>" for p in paragraphs if len(p) > 40)}<p>{_T}</p></div><div>{_MORE}</div><div><a href="/t">Terms</a> <a href="/i">Imprint</a> 2020</div></body>')
        pages.append(f'<body><table><tr><td>{_LINKS}</td><td{m}><p>{_S} <a href="/x">See the map</a> for the whole line.</p><p>{_T}</p><p>{_U}</p></td></tr></table><div class="cookie-notice"><p>We use cookies to make this page work and to count our readers; by reading on you agree to that.</p></div></body>')
    for end in ("Of.", "So it was, they said.", _T):
        # an article that ends just before links; links in an article; bare frames
        pages.append(f'<body><header><p>{_U}</p><p>Weekly edition</p></header><article{m}><h1><a href="/self">The ferry returns to the harbour</a></h1><p>{_S}</p><p><a href="/map">See the map of the whole line</a></p><p>{end}</p></article>{_MORE}<footer>{end}</footer></body>')
        pages.append(f'<body><header><div>Weekly edition</div></header><main{m}><h2>Lights</h2><p>{end}</p><p>Yes, <a href="/who">the baker</a> said.</p><p>{end}</p></main><div>{_LINKS}</div><div class="notice">{_T}</div><div id="comments"><p>{_S}</p><p>{end}</p></div></body>')
        pages.append(f'<body><div class="top">{_LINKS}</div><div class="post-body"{m}><h2>Lights</h2><p>{end}</p><p>{_U}</p><p>{end}</p></div>{_MORE}<div class="promo"><p>{_T}</p></div><form><p>{_S}</p><p>Your name</p></form></body>')
        pages.append(f'<body><article><h1{m}>The ferry returns</h1><p{m}>{_S}</p><p{m}>{end}</p><ul><li><a href="/1">The ten best walks</a></li><li><a href="/2">Old lamps are back</a></li></ul><nav><a href="/p">Previous</a> or next one here</nav><p{m}>{end}</p></article></body>')
        pages.append(f'<body><header><h1>Coast Times of the northern harbour</h1><p>{_S}</p></header><p{m}>{_T}</p><p{m}>{_U}</p><footer><p>{end}</p></footer></body>')
        # bare blocks that only their neighbours tell apart
        short = end if len(end) < 40 else "It rained."
        pages.append(f'<body><div>{_LINKS}</div><div>Weekly edition</div><div>{_LINKS}</div><div{m}>{_S}</div><div{m}>{short}</div><div{m}>{_T}</div><div{m}>{short}</div><div{m}>{_U}</div><div>{_MORE}</div><div>Printed in the north</div><div>{_LINKS}</div></body>')
    return pages


LABELLED = _labelled_pages()
