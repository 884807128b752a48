"""Main text of web pages: site templates are found as element subtrees that recur across a host's pages."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, bounded, carried, cut, slices, table

#: Elements of the HTML standard by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style noscript template iframe object embed svg canvas audio video map head title".split())
DROPPED = UNSEEN | frozenset("nav header footer aside form button select textarea input dialog menu datalist label search".split())
CORE = frozenset(("article", "main"))
BLOCK = frozenset("address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"} | {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
#: Elements that only hold others, down which the story of a page without an article is looked for.
CONTAINERS = frozenset("html body div section center table tbody tr td".split())
#: What tells a story from the controls of a form.
TOLD = frozenset("p h1 h2 h3 article main".split())
#: What an element closes when it begins, up to the nearest element that may hold it.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words that mark what is not the article, where a whole name of class, id or role is made of them and of the words that only tell a place or form.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice gdpr sidebar menu navbar nav navigation breadcrumb breadcrumbs header footer masthead"
    " comment comments commentlist reply replies disqus share sharing social related recommended recommendations newsletter subscribe signup login popup modal skip pagination pager toolbar contentinfo complementary search".split()
)
#: Of these, the words that no part of an article bears, whatever part of itself a name tells.
FOREIGN = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr comment comments commentlist reply replies disqus share sharing related recommended recommendations newsletter".split())
PARTS = frozenset("item items text texts articles stories posts content body title heading".split())
PLACES = frozenset("site page main top bottom left right list box bar area wrapper container section block slot unit form links link widget wrap inner primary secondary global wide user reader side respond to".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)", re.S)
STOP = re.compile(r"""=\s*(["'])|>""")
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DIGITS, PART = re.compile(r"\d+"), re.compile(r"[-_]+")
#: An inline element with less text than this is part of a sentence if its line goes on at both its sides.
PHRASE = 20
#: Groups of counts that are no section or place: the whole host, and shapes on the host.
HOST, SHAPE = 0, 1


@lru_cache(maxsize=1 << 14)
def marked(names: str) -> bool:
    """Whether a name of class, id or role says that an element is not the article: ``cookie-notice`` and ``ad-slot-300`` do, ``market-share``, ``article-header`` and ``with-sidebar`` don't."""
    for name in names.lower().split():
        parts = {x for x in PART.split(name) if x and not x.isdigit()}
        if parts & MARKS and parts <= (MARKS | PLACES | PARTS if parts & FOREIGN else MARKS | PLACES):
            return True
    return False


def decoded(text: str) -> str:
    refs = text.count("&")
    if not refs:
        return text
    return text.replace("&amp;", "&") if refs == text.count("&amp;") else html.unescape(text)


class Node:
    __slots__ = ("core", "gone", "hash", "kids", "linked", "marked", "names", "prose", "seen", "shape", "size", "tag", "told")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.kids, self.marked, self.core, self.gone = tag, names, [], bool(names) and tag not in ("main", "body", "html") and marked(names), False, False
        self.hash = self.shape = self.size = self.linked = self.seen = self.prose = 0
        self.told = tag in TOLD


class _Stack:
    """The open elements, with the places of each tag and of blocks, so that no step looks through all of them."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks = [root], {}, [0]

    def last(self, tags: Iterable[str]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK and node.tag != "p":
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, k: int) -> None:
        while len(self.nodes) > k:
            self.at[self.nodes.pop().tag].pop()
            if self.blocks[-1] == len(self.nodes):
                self.blocks.pop()


def _tag_end(page: str, at: int, astray: set[int]) -> tuple[int, int]:
    """Where the attributes of a tag end, and where the tag does. A quote that is never closed ends with the next ``>``.

    ``astray`` collects opening quotes from which a page was read to its end in vain, so that none is tried twice.
    """
    i, path = at, []
    while m := STOP.search(page, i):
        if not m[1]:
            return m.start(), m.end()
        if m.end() in astray:
            break
        path.append(m.end())
        i = page.find(m[1], m.end()) + 1
        if not i:
            break
    else:
        if not path:
            return len(page), len(page)
    astray.update(path)
    i = page.find(">", at)
    return (i, i + 1) if i >= 0 else (len(page), len(page))


def parse(page: str) -> Node:
    """The tree of a page, however malformed, in time linear in its length: text is str, elements are nodes."""
    root = Node("html")
    stack, at, n, astray = _Stack(root), 0, len(page), set()
    while at < n:
        m = TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            stack.nodes[-1].kids.append(decoded(page[at:end]))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack.nodes[-1].kids.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        stop, at = (at, at + 1) if page.startswith(">", at) else _tag_end(page, at, astray)
        if m[1]:
            if places := stack.at.get(tag):
                stack.close(places[-1])
            continue
        if tag == "html" or tag == "body" and stack.last(("body",)):
            continue
        if tag in CLOSES_P and (places := stack.at.get("p")) and places[-1] > stack.blocks[-1]:
            stack.close(places[-1])
        if tag in SIBLINGS:
            closed, within = SIBLINGS[tag]
            if (k := stack.last(closed)) > stack.last(within):
                stack.close(k)
        written = page[m.end() : stop]
        node = Node(tag, " ".join(x for y in NAMED.findall(written) for x in y if x) if written else "")
        stack.nodes[-1].kids.append(node)
        if tag in VOID or written.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if tag not in DROPPED:
                node.kids.append(page[at : close.start() if close else n])
            at = close.end() if close else n
            continue
        stack.push(node)
    return root


def signed(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def measured(root: Node, hashes: bool) -> list[Node]:
    """All elements, parents first, measured from the leaves up, without recursion since trees may be deep: the length of each element's text, how much of it is in links and how much outside dropped elements, and whether it is or holds an article; no mark holds for what does.

    A form that holds an article, or paragraphs and nine tenths of what the page shows, is around the page: it is taken for a plain element.

    With ``hashes``, two hashes of the subtree too: of its tags, names and text (white space aside), and of its shape, in which
    text, digits in names and repeats of a child's shape do not count.
    """
    order = [root]
    for x in order:
        order.extend(k for k in x.kids if k.__class__ is Node)
    for x in reversed(order):
        parts, shapes = [x.tag, x.names], [x.tag, DIGITS.sub("0", x.names) if x.names else ""]
        core = False
        size = linked = 0
        for k in x.kids:
            if k.__class__ is str:
                text = " ".join(k.split())
                size += len(text)
                parts.append(text)
            else:
                size += k.size
                linked += k.size if k.tag == "a" else k.linked
                core = core or k.core
                if hashes:
                    parts.append(f"\0{k.hash}")
                    if shapes[-1] != (shape := str(k.shape)):
                        shapes.append(shape)
        x.size, x.linked = size, linked
        if x.tag in CORE and not x.marked:
            core = True
        x.core, x.marked = core, x.marked and not core
        if hashes:
            x.hash, x.shape = signed("\1".join(parts)), signed("\2".join(shapes))
    if forms := [x for x in order if x.tag == "form"]:
        if not root.core:
            shown(order)
        for x in forms:
            if x.core or x.told and 10 * x.seen >= 9 * root.seen:
                x.tag = "div"
    return order


def shown(order: list[Node]) -> None:
    """The length of the text that each element shows, links among it, and whether it tells something, on a page without an article."""
    for x in reversed(order):
        x.seen = 0
        for k in x.kids:
            if k.__class__ is str:
                x.seen += len(" ".join(k.split()))
            elif k.tag not in DROPPED or k.tag == "form":
                x.seen += k.seen
                x.told = x.told or k.told


def weighed(order: list[Node]) -> None:
    """The length of each element's plain text: what is in links, or goes by element, mark or template, aside."""
    for x in reversed(order):
        x.prose = sum(len(" ".join(k.split())) if k.__class__ is str else 0 if k.tag == "a" or k.tag in DROPPED or k.marked or k.gone else k.prose for k in x.kids)


def _breaks(x: Node) -> bool:
    return x.tag in BLOCK or x.tag == "br"


def spots(root: Node, places: dict[tuple[int, str, str], int] | None = None) -> Iterator[tuple[Node, int, bool]]:
    """The elements of a measured tree that hold text, menus, footers and adverts among them, with a hash of their place (the tags, classes and ids above and of them; 0 if not asked for by a dictionary of known ones), and whether their shape alone may tell a template.

    A few words in bold amid a sentence are no element of a template, so a short inline element whose line has text at both sides is left out. A
    shape tells nothing of prose: it counts outside the article alone, and on pages without an article where links are half of the text.
    """
    todo = [(root, 0, False, False)]
    while todo:
        x, place, left, right = todo.pop()
        kids = x.kids
        after, ahead = [False] * len(kids), right and not _breaks(x)
        for i in range(len(kids) - 1, -1, -1):
            k = kids[i]
            after[i] = ahead
            ahead = ahead or bool(k.strip()) if k.__class__ is str else not _breaks(k) and (ahead or k.size > 0 and k.tag not in DROPPED and not k.marked)
        behind = left and not _breaks(x)
        for k, ahead in zip(kids, after, strict=True):
            if k.__class__ is str:
                behind = behind or bool(k.strip())
                continue
            if k.size and k.tag not in UNSEEN:
                key = (place, k.tag, k.names)
                if places is not None and key not in places:
                    places[key] = signed(f"{place} {k.tag} {DIGITS.sub('0', k.names)}")
                here = 0 if places is None else places[key]
                if k.tag in BLOCK or k.tag in DROPPED or k.size >= PHRASE or not (behind and ahead):
                    yield k, here, not k.core and (root.core or 2 * k.linked >= k.size)
                todo.append((k, here, behind, ahead))
            behind = not _breaks(k) and (behind or k.size > 0 and k.tag not in DROPPED and not k.marked)


def articles(root: Node) -> list[Node]:
    """The outermost articles, in page order, that are not within something dropped or marked."""
    tops, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag in CORE and not x.marked:
            tops.append(x)
        elif x.tag not in DROPPED and not x.marked:
            todo.extend(k for k in reversed(x.kids) if k.__class__ is Node)
    return tops


def subtrees(page: str, section: int = 0, places: dict | None = None) -> set[tuple[int, int | None]]:
    """(group, hash) of the page's subtrees and (group, None) of the groups that the page is in: the host, its shapes, its section, and the places of the elements."""
    root = parse(page)
    measured(root, True)
    inner = {id(x) for x in within(articles(root))}
    wider = (HOST, section) if section else (HOST,)
    out: set[tuple[int, int | None]] = {(g, None) for g in (*wider, SHAPE)}
    for x, place, shaped in spots(root, {} if places is None else places):
        out.add((place, None))
        out.update((g, x.hash) for g in (*wider, place))
        if shaped and id(x) not in inner:
            out.add((SHAPE, x.shape))
    return out


def within(tops: list[Node]) -> Iterator[Node]:
    todo = list(tops)
    while todo:
        x = todo.pop()
        yield x
        todo.extend(k for k in x.kids if k.__class__ is Node)


def heaviest(root: Node, weight: str, share: float) -> Node:
    """The innermost container that holds a share of the text of each one around it."""
    x = root
    while k := next((k for k in x.kids if k.__class__ is Node and k.tag in CONTAINERS and getattr(x, weight) and getattr(k, weight) >= share * getattr(x, weight)), None):
        x = k
    return x


def delete_template(root: Node, order: list[Node], template: frozenset[int]) -> None:
    """Delete what is in the template, but never an article or what is around one.

    Copies of one article on a host are no template: where less than a quarter of an article's plain text would be left, all of it stays. On
    pages without an article no shape deletes what holds half of the plain text that is left, and within the story only what is nine tenths links.
    """
    tops = articles(root)
    inner = {id(x) for x in within(tops)}
    shapes, cut_in = [], False
    for x, _, shaped in spots(root):
        if x.hash in template and not x.core:
            x.gone = True
            cut_in = cut_in or id(x) in inner
        elif shaped and x.shape in template and id(x) not in inner:
            shapes.append(x)
    if cut_in:
        weighed(order)
        after = [x.prose for x in tops]
        parts = [[x for x in within([top]) if x.gone] for top in tops]
        for part in parts:
            for x in part:
                x.gone = False
        weighed(order)
        for top, n, part in zip(tops, after, parts, strict=True):
            for x in part:
                x.gone = 4 * n >= top.prose
    if shapes and not root.core:
        weighed(order)
        story = {id(x) for x in within([heaviest(root, "prose", 0.9)])}
        shapes = [x for x in shapes if 2 * x.prose < max(root.prose, 1) and (id(x) not in story or 10 * x.linked >= 9 * x.size)]
    for x in shapes:
        x.gone = True


def chosen(root: Node, order: list[Node]) -> list[Node]:
    """Where a page's text is: its articles with a headline before them, the story outside its articles, or the whole page where there is none.

    Beside an article with five times its plain text, one with links is a teaser. Where no article has a headline (h1) but the page has, the story is outside if there is more plain text
    there, in the least element around the headline with half of it, and the articles are teasers; otherwise the headline, and the headings and paragraphs between it and the article, go before it.
    """
    tops = articles(root)
    if not tops:
        return [root]
    if len(tops) == 1 and any(x.tag == "h1" for x in within(tops)):
        return tops
    weighed(order)
    most = max(x.prose for x in tops)
    tops = [x for x in tops if 5 * x.prose >= most or not x.linked]
    if any(x.tag == "h1" for x in within(tops)):
        return tops
    above = {id(k): x for x in order for k in x.kids if k.__class__ is Node}
    hidden: set[int] = set()
    heads: dict[int, Node] = {}
    for x in order:
        if x.marked or x.gone or x.tag in DROPPED or id(above.get(id(x))) in hidden:
            hidden.add(id(x))
    for x in reversed(order):
        if x.tag == "h1" and x.prose and id(x) not in hidden:
            heads[id(x)] = x
        if (h1 := heads.get(id(x))) and (parent := above.get(id(x))):
            heads[id(parent)] = h1
    if id(root) not in heads:
        return tops
    inside = sum(x.prose for x in tops)
    if root.prose - inside > inside:
        for x in tops:
            x.gone = True
        weighed(order)
        x = heads[id(root)]
        while 2 * x.prose < root.prose:
            x = above[id(x)]
        return [x]
    x = tops[0]
    while parent := above.get(id(x)):
        earlier = [k for k in parent.kids[: next(i for i, k in enumerate(parent.kids) if k is x)] if k.__class__ is Node and id(k) not in hidden]
        if first := next((i for i, k in enumerate(earlier, 1) if id(k) in heads), 0):
            return [heads[id(earlier[first - 1])], *(k for k in earlier[first:] if k.tag in ("p", "h2", "h3", "hgroup")), *tops]
        x = parent
    return tops


def rendered(tops: list[Node], inner: bool) -> str:
    """The blocks of elements, joined by newlines; ``inner`` if they are of an article, whose header stays."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    work: list = list(reversed(tops))
    while work:
        x = work.pop()
        if x is None:
            close()
        elif x.__class__ is str:
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif x.tag in DROPPED and not (inner and x.tag == "header") or x.marked or x.gone:
            line.append(" ")
        else:
            if x.tag in BLOCK or x.tag == "header":
                close()
                work.append(None)
            work.extend(reversed(x.kids))
    close()
    return "\n".join(blocks)


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The blocks of the article, or of the page where there is none, without dropped, marked and template elements.

    If nothing is left of a page without an article, the innermost element with most of what it shows stays, whatever template or mark says.
    """
    root = parse(page)
    order = measured(root, bool(template))
    if template:
        delete_template(root, order, template)
    text = rendered(chosen(root, order), root.core)
    if not text and not root.core:
        shown(order)
        story = heaviest(root, "seen", 0.5)
        story.marked = False
        for flag in ("gone", "marked"):
            for x in within([story]):
                setattr(x, flag, False)
            if text := rendered([story], False):
                break
    return text


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def section(url: Column) -> Column:
    """The first folder of a url's path, empty for pages outside any."""
    return F.coalesce(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), "^/+([^/]+)/", 1), F.lit(""))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A combined count for each host, group and subtree of a batch, so that a common host costs little; the copies of a page make up one."""
    for batch in slices(batches, "html"):
        counts: dict[tuple[str, int, int | None], float] = {}
        places: dict[tuple[int, str, str], int] = {}
        for site, part, page, copies in zip(*(batch.column(c).to_pylist() for c in ("_host", "_section", "html", "_copies")), strict=True):
            for group, h in subtrees(page, signed(f"section {part}") if part else 0, places):
                counts[site, group, h] = counts.get((site, group, h), 0.0) + 1 / copies
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int64()), pa.array([k[2] for k in counts], pa.int64()), pa.array(counts.values(), pa.float64())], names=["_host", "_group", "_hash", "_n"])


def _extract(carry: list[str], schema: pa.Schema) -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html"):
            pages, templates = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_html", "_template"))
            known: dict[tuple, frozenset] = {}
            texts = [main_text(p or "", known.setdefault(tuple(t or ()), frozenset(t or ()))) for p, t in zip(pages, templates, strict=True)]
            yield batch_of(schema, {c: batch.column(batch.schema.get_field_index(c)) for c in carry} | {"main_text": texts})

    return extract


def extract_html(pages: DataFrame, url_col: str = "url", html_col: str = "html", carry: list[str] | None = None, least_pages: int = 10, least_share: float = 0.2, place_share: float = 0.5, broadcast_mb: int = 64) -> DataFrame:
    """Add main_text to every page.

    The hashes of a page's element subtrees, of all tags, are counted per host, combined within each batch before the shuffle; copies of a
    page count as one. A subtree belongs to the site's template and is deleted on the whole host if it is on at least ``least_pages`` of its pages
    (on every page of a host with three pages or more, but fewer than that) and on ``least_share`` of the host's pages, or on ``place_share`` of those of a section
    (first folder of the path) or of those with an element at its place (the same tags, classes and ids above it). Menus, adverts and footers whose text
    changes from page to page recur by their shape (tags and names, without text): outside the article, and where there is none among links, a shape on
    ``place_share`` of a host's pages goes too. Only short inline elements amid a
    sentence stay. So few subtrees can reach a share that a host's list is bounded by its pages' size, its sections and places, not their number.
    No template deletes an article or what is around one, nor three quarters of an article's plain text or more (copies of one article are no template), nor by its shape half of the
    plain text of a page without an article. A paragraph that stands in the articles of a fifth of a host's pages does go, as notices do: a part repeated through a
    series can't be told from one.
    What a host's pages cannot tell goes by element, and by names of class, id and role that say nothing but what they mark; neither holds for what is around the article,
    and an article's own header stays. What is left of the article (the
    body, where there is none) becomes text: references decoded, white space in a block made one blank, blocks joined by
    a newline. Null and empty pages give an empty text, and pages without a readable url share one host; hosts of one or two distinct pages have no template. Repeated rows each get a row; an
    empty table gives none. Pages are not shuffled if the hosts' lists and the repeated pages are few enough to broadcast (counted against ``broadcast_mb``).
    """
    carry = carried(pages, carry, html_col, ("main_text",))
    sited = pages.select(host(F.col(url_col)).alias("_host"), section(F.col(url_col)).alias("_section"), F.col(html_col).alias("html")).filter("html <> ''").withColumn("_page", F.xxhash64("html"))
    repeated = cut(sited.groupBy("_host", "_page").agg(F.count("*").alias("_copies")).filter("_copies > 1"), "html-copies")
    weighed = sited.join(bounded(repeated, 64, broadcast_mb), ["_host", "_page"], "left").select("_host", "_section", "html", F.coalesce("_copies", F.lit(1)).alias("_copies"))
    counts = arrow(weighed, _hashes, "_host string, _group bigint, _hash bigint, _n double").groupBy("_host", "_group", "_hash").agg(F.sum("_n").alias("_n"))
    counts = cut(counts.filter(F.col("_n") > min(3, least_pages) - 0.001), "html-counts")
    totals = counts.filter("_hash IS NULL").select("_host", "_group", F.col("_n").alias("_pages"))
    sizes = totals.filter(F.col("_group") == HOST).select("_host", F.least(F.lit(float(least_pages)), F.col("_pages")).alias("_least"))
    found = counts.filter("_hash IS NOT NULL").join(totals, ["_host", "_group"]).join(sizes, "_host")
    share = F.when(F.col("_group") == HOST, least_share).otherwise(place_share)
    found = found.filter((F.col("_n") > F.col("_least") - 0.001) & (F.col("_n") > share * F.col("_pages") - 0.001))
    found = cut(found.select("_host", "_hash").distinct(), "html-templates")
    templates = found.groupBy("_host").agg(F.array_sort(F.collect_set("_hash")).alias("_template"))
    templates = F.broadcast(templates) if found.count() * 64 <= broadcast_mb << 20 else templates
    whole = pages.select(*carry, host(F.col(url_col)).alias("_host"), F.col(html_col).alias("_html")).join(templates, "_host", "left")
    schema = T.StructType([*(pages.schema[c] for c in carry), T.StructField("main_text", T.StringType())])
    return arrow(whole.select(*carry, "_html", "_template"), _extract(carry, arrow_schema(schema)), schema)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_html(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))
