"""Main-text extraction by tag-path ratios.

Every piece of text of a page belongs to the path of open tags above it.  For
each path the length of its text and its punctuation are added up over the page
and set against the number of pieces; the two ratios are smoothed between
neighbouring paths, fused by their product, and a threshold on the fused score
selects the paths of the article, wherever they lie in the page; gaps inside their
blocks are closed.  Being inside <article> or <main> doubles a path's score.
Elements that are never running text (nav, footer, form, script, ...) and reader
comments are shut out beforehand.  What a class, id or role says (ad, search, alert,
...) is weighed against the page's text: such an element goes, unless the text
outside all such elements is too little to be the article.

Reading a page takes time in proportion to its length, whatever its markup.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.frames import free_name, without

# Fixed values of HTML: elements without an end tag, raw-text elements, elements inside a line.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_FRAME = frozenset("nav aside footer form script style noscript iframe template head button select option "
                   "textarea input svg canvas object embed audio video menu dialog fieldset".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Words of a class, id or role that mark parts of the frame.
_FRAME_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|footer|header|masthead|"
    r"side(?:bar)?|aside|widget\w*|cookie\w*|consent|notice\w*|alert|popup|modal|overlay|newsletter|subscri\w*|signup|"
    r"login|search|share|sharing|social|related|recommend\w*|comments?|comment\w*|disqus|repl(?:y|ies)|respond|"
    r"pagination|pager|toolbar|copyright|legal|disclaimer|complementary|contentinfo|navigation|hidden)(?:$|[\s_-])",
    re.I)
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)""", re.S)
#: The rest of a tag: up to the first > outside quotes.
_REST = re.compile(r"""((?>(?:[^>"']|"[^"]*"|'[^']*')*+))>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPACES = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")


# An open element of these names in the first column is closed by the elements of the second.
_SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr tbody thead tfoot", "td": "td th tr tbody", "th":
             "td th tr tbody", "option": "option optgroup", "tbody": "tbody tfoot", "thead": "tbody tfoot"}
_SIBLINGS = {k: frozenset(v.split()) for k, v in _SIBLINGS.items()}
# The elements that the start of an element closes.
_CLOSES = {t: tuple(k for k, v in _SIBLINGS.items() if t in v) for t in frozenset().union(*_SIBLINGS.values())}
_SCOPES = frozenset("table ul ol dl article section div body main aside nav".split())
_ROOTS = frozenset(["article", "main"])
_WHOLE = frozenset(["html", "body", "main", "article"])
_PAGE = frozenset(["", "html", "body"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Elements that hold running text, and those that only group them.
_LINES = _HEADINGS | frozenset("p li dt dd blockquote pre figcaption address center".split())
_LISTS = frozenset("ul ol dl figure".split())
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|repl(?:y|ies)|respond)(?:$|[\s_-])", re.I)


# What an element's tag and attributes say about it.
_OPEN, _TITLE, _SHUT, _NAMED = range(4)  # of an article's header only the headings are read
#: A named element is the article if it has this many times the text outside all named elements.
_OUTWEIGHS = 4


def _said(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _FRAME:
        return _SHUT
    values = [v.strip("\"'") for _, v in _ATTRIBUTE.findall(attributes)] if attributes else ()
    if any(_COMMENTS.search(v) for v in values):
        return _SHUT
    if tag == "header":
        return _TITLE if in_article else _NAMED
    return _NAMED if tag not in _WHOLE and any(_FRAME_WORDS.search(v) for v in values) else _OPEN


class _Open:
    """The open elements, with the places of every tag, so that no search walks over them."""

    def __init__(self):
        self.tag: list[str] = []
        self.path: list[int] = []
        self.shut: list[int] = []
        self.frame: list[int] = []  # number of the innermost named element, 0 for none
        self.blocks: list[int] = []  # places of elements that are not inline
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, tag: str, path: int, shut: int, frame: int) -> None:
        self.places[tag].append(len(self.tag))
        if tag not in _INLINE:
            self.blocks.append(len(self.tag))
        self.tag.append(tag)
        self.path.append(path)
        self.shut.append(shut)
        self.frame.append(frame)

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, k: int) -> None:
        """Close the element at place ``k`` and all that are open in it."""
        while len(self.tag) > k:
            tag = self.tag.pop()
            self.places[tag].pop()
            if tag not in _INLINE:
                self.blocks.pop()
        del self.path[k:], self.shut[k:], self.frame[k:]


class _Paths:
    """Root-to-leaf tag paths as a tree: every path has a number, a parent and sums over its text."""

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.parent, self.tag = [-1], [""]

    def below(self, path: int, tag: str, label: str) -> int:
        n = self.number.setdefault((path, label), len(self.parent))
        if n == len(self.parent):
            self.parent.append(path)
            self.tag.append(tag)
        return n


def _without_frame(pieces: list[tuple[int, int, str, int]], outer: list[int], inside: list[bool],
                   links: list[bool], articles: list[bool]) -> list[tuple[int, int, str]]:
    """The pieces outside named elements that are frame.

    ``outer`` has the named element around each named element (0: the page), ``inside``
    whether it lies in an <article> or <main>; ``links`` and ``articles`` say whether a
    piece is a link and whether it lies in such an element.  A named element is judged
    within the element around it, with which it goes.  It stays if it has the most text of
    its neighbours and ``_OUTWEIGHS`` times the unnamed text around it, unless that text
    has an <article> or <main> apart from it.
    """
    if len(outer) == 1:
        return [p[:3] for p in pieces]
    n = len(outer)
    own, apart = [0] * n, [0] * n  # text without links
    for (*_, text, frame), link, article in zip(pieces, links, articles):
        if not link:
            own[frame] += len(text.strip())
            apart[frame] += len(text.strip()) if article else 0
    total, heaviest = own[:], [0] * n
    for e in range(n - 1, 0, -1):  # outer elements have smaller numbers
        total[outer[e]] += total[e]
    for e in range(1, n):
        if not heaviest[outer[e]] or total[e] > total[heaviest[outer[e]]]:
            heaviest[outer[e]] = e
    stays = [True] * n
    for e in range(1, n):
        o = outer[e]
        stays[e] = (stays[o] and heaviest[o] == e and 0 < total[e] >= _OUTWEIGHS * own[o]
                    and (inside[e] or not apart[o]))
    return [p[:3] for p in pieces if stays[p[3]]]


def _pieces(page: str, paths: _Paths) -> list[tuple[int, int, str]]:
    """The page's visible text outside the frame as (path, block, text), in page order."""
    out: list[tuple[int, int, str, int]] = []
    stack = _Open()
    outer, inside, links, articles = [0], [False], [], []
    block = at = 0
    end = page.rfind(">") + 1
    quotes = True  # until a quote is found that nothing closes, a > in quotes ends no tag

    def text(a: int, b: int) -> None:
        if a >= b or stack.shut and stack.shut[-1]:
            return
        top = bool(stack.tag)
        out.append((stack.path[-1] if top else 0, block, html.unescape(page[a:b]), stack.frame[-1] if top else 0))
        links.append(bool(stack.places["a"]))
        articles.append(bool(stack.places["article"] or stack.places["main"]))

    while at < end:
        m = _TOKEN.search(page, at, end)
        if m is None:
            break
        text(at, m.start())
        at = m.end()
        if m[2] is None:  # comment or declaration
            continue
        rest = _REST.match(page, at, end) if quotes else None
        if rest is None:
            quotes = False
        stop = rest.end(1) if rest else page.index(">", at)
        attributes, at = page[at:stop], stop + 1
        tag = m[2].lower()
        if tag not in _INLINE:
            block += 1
        if m[1]:
            k = stack.last([tag])
            if k >= 0 and not (tag in _INLINE and stack.blocks and stack.blocks[-1] > k):
                stack.close(k)  # a stray end tag closes no block
            continue
        if tag in _CLOSES_P or tag in _CLOSES:
            k = stack.last(_CLOSES.get(tag, ()) if tag not in _CLOSES_P else ("p", *_CLOSES.get(tag, ())))
            if k > stack.last(_SCOPES):
                stack.close(k)
        if tag in _VOID:
            continue
        if tag in _RAW:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = page.find(">", found.end()) + 1 if found else 0
            at = at or len(page)
            continue
        if attributes.endswith("/") and tag not in _INLINE and tag not in _CLOSES_P:
            continue
        in_article = bool(stack.places["article"] or stack.places["main"])
        said = _said(tag, attributes, in_article)
        frame = stack.frame[-1] if stack.frame else 0
        if said == _NAMED:
            outer.append(frame)
            inside.append(in_article)
            frame = len(outer) - 1
        shut = max(said if said != _NAMED else _OPEN, stack.shut[-1] if stack.shut else _OPEN)
        if shut == _TITLE and tag in _HEADINGS:
            shut = _OPEN
        label = f"{tag} {attributes.strip()}" if "class" in attributes or "id" in attributes else tag
        stack.push(tag, paths.below(stack.path[-1] if stack.path else 0, tag, label), shut, frame)
    text(at, len(page))
    return _without_frame(out, outer, inside, links, articles)


def _selected(pieces: list[tuple[int, int, str]], paths: _Paths) -> list[bool]:
    """For every piece, whether it belongs to the article.

    The paths whose fused score reaches the threshold select the text, wherever
    they lie.  Content blocks are then found from the top: an element is opened
    if it is the page itself or if one part holds nine tenths of its content; else
    it is a block, in which the gaps are closed.  Every part of an opened element
    that has content is looked at in the same way.
    """
    size: dict[int, int] = defaultdict(int)
    marks: dict[int, int] = defaultdict(int)
    count: dict[int, int] = defaultdict(int)
    for path, _, text in pieces:
        if n := len(text.strip()):
            size[path] += n
            marks[path] += len(_MARKS.findall(text))
            count[path] += 1
    if not size:
        return [False] * len(pieces)
    order = list(size)  # by first appearance
    text_ratio = [size[p] / count[p] for p in order]
    mark_ratio = [marks[p] / count[p] for p in order]
    parent, tag = paths.parent, paths.tag
    n_paths = len(parent)
    # the element that a path's line stands in, and whether its text is a link
    line, link, named = list(range(n_paths)), [False] * n_paths, [False] * n_paths
    for p in range(1, n_paths):  # parents have smaller numbers
        if tag[p] in _INLINE:
            line[p] = line[parent[p]]
            link[p] = tag[p] == "a" or link[parent[p]]
        named[p] = named[parent[p]] or tag[p] in _ROOTS

    def near(p: int, q: int) -> bool:
        """Neighbours in the tree, or lines of running text that follow each other."""
        if parent[p] == parent[q] or p == parent[q] or q == parent[p]:
            return True
        return not (link[p] or link[q]) and tag[line[p]] in _LINES and tag[line[q]] in _LINES

    before = [i - 1 if i and near(order[i], order[i - 1]) else i for i in range(len(order))]
    after = [i + 1 if i + 1 < len(order) and near(order[i], order[i + 1]) else i for i in range(len(order))]

    def smooth(x: list[float]) -> list[float]:
        return [0.5 * v + 0.25 * x[i] + 0.25 * x[j] for v, i, j in zip(x, before, after)]

    fused = [a * (1 + b) * (2 if named[p] else 1) for p, a, b in zip(order, smooth(text_ratio), smooth(mark_ratio))]
    mean = sum(fused) / len(fused)
    content = {p for p, f in zip(order, fused) if f >= 0.5 * mean}
    # all text and content below every path, the content of its lines, of its largest part, and articles in it
    whole, below, own, part = [0] * n_paths, [0] * n_paths, [0] * n_paths, [0] * n_paths
    articles = [False] * n_paths
    for p in range(n_paths - 1, -1, -1):
        whole[p] += size.get(p, 0)
        if p in content:
            below[p] += size[p]
            own[p] += size[p]
        if p:
            q = parent[p]
            whole[q] += whole[p]
            below[q] += below[p]
            if tag[p] in _INLINE or tag[p] in _LINES or tag[p] in _LISTS:
                own[q] += own[p]
            else:
                part[q] = max(part[q], below[p])
            articles[q] = articles[q] or articles[p] or (tag[p] == "article" and below[p] > 0)

    def is_block(p: int) -> bool:
        if tag[p] in _PAGE:
            return 2 * own[p] >= below[p]
        if tag[p] in _INLINE or tag[p] in _LINES:
            return True
        if tag[p] in _ROOTS and 2 * below[p] >= whole[p] and not articles[p]:
            return True
        return 10 * part[p] < 9 * below[p]

    opened, block = [False] * n_paths, [False] * n_paths
    for p in range(n_paths):
        block[p] = p > 0 and block[parent[p]]
        if not block[p] and below[p] and (p == 0 or opened[parent[p]]):
            block[p] = is_block(p)
            opened[p] = not block[p]
    kept = [block[path] or path in content for path, _, _ in pieces]
    # a heading directly above kept text belongs to it
    full = [i for i, (_, _, text) in enumerate(pieces) if text.strip()]
    for i, j in zip(full[-2::-1], full[:0:-1]):
        kept[i] = kept[i] or (kept[j] and tag[line[pieces[i][0]]] in _HEADINGS)
    # gaps between kept texts are closed, if an element below the page holds both sides and there is text beside links
    inner = [False] * n_paths  # below the page
    for p in range(1, n_paths):
        inner[p] = inner[parent[p]] or tag[p] not in _PAGE
    sides = [i for i in full if kept[i]]
    for i, j in zip(sides, sides[1:]):
        gap = [pieces[g] for g in range(i + 1, j) if pieces[g][2].strip()]
        a, b = pieces[i][0], pieces[j][0]
        while a != b:
            a, b = (parent[a], b) if a > b else (a, parent[b])
        linked = sum(len(text.strip()) for path, _, text in gap if link[path])
        if inner[a] and 2 * linked < sum(len(text.strip()) for _, _, text in gap) or not gap and pieces[i][1] == pieces[j][1]:
            kept[i + 1:j] = [True] * (j - i - 1)
    return kept


def extract(page: str | None) -> str:
    """The main text of one page; empty for null, empty or frame-only pages."""
    if not page:
        return ""
    paths = _Paths()
    pieces = _pieces(page, paths)
    blocks: dict[int, list[str]] = {}
    for (_, block, text), kept in zip(pieces, _selected(pieces, paths)):
        if kept:
            blocks.setdefault(block, []).append(text)
    lines = (_SPACES.sub(" ", "".join(b)).strip() for b in blocks.values())
    return " ".join(x for x in lines if x)


def _extract(col: pa.Array) -> pa.Array:
    return pa.array([extract(x) for x in col.to_pylist()], pa.string())


def main_text(html_col: Column) -> Column:
    return F.arrow_udf(_extract, "string")(html_col)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``text``, the main text of every page, and ``n_chars``, its code points.

    The article without menus, headers, footers, sidebars, notices, adverts,
    forms, scripts, styles, markup and reader comments.  Character references are
    decoded; white space inside a block becomes one space; blocks are joined in
    page order by one space.  One map over the rows, without a shuffle.

    * null, empty or frame-only html: empty text
    * plain text without a tag: the text itself
    * broken markup (open elements, stray end tags, unfinished tags) is read on; after a
      quote that nothing closes, a tag ends at its first >
    * repeated rows: each by itself; empty table: empty result
    * columns of ``pages`` named ``text`` or ``n_chars`` are replaced
    """
    name = free_name(pages, "_main_text")
    out = pages.withColumn(name, main_text(pages[f"`{html_col}`"]))
    return out.select(*without(out.drop(name), ["text", "n_chars"]), F.col(name).alias("text"),
                      F.length(name).cast("bigint").alias("n_chars"))
