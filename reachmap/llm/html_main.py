"""HTML extraction (operator 2): main text by site template removal.

1. Every page is read as a tree of elements. Elements that are no main text by
   their kind (menus, footers, scripts, ...) go. So do those whose class, id or role
   has a word that says so: the whole word, or one joined to words of place only
   ("site-footer", not "has-sidebar" or "market-share"). Names and forms never take
   an article away: of the elements around the only articles of a page none goes by
   name, nor, on a page without any, one that holds more than half of its paragraphs' text. Inside
   an article only adverts, comments and links to other articles go by name.
2. Every subtree that could be page furniture is hashed: tag, names and text.
   Spark counts for each host the pages on which a hash occurs.
3. Subtrees on TEMPLATE_PAGES different pages of a host or more are deleted; on a
   host of over 16 pages, on as many as its pages' binary logarithm, so that few
   chance repeats count on a very large host but furniture of one section does.
   Inside an article this holds for boxes only, and of a box what goes is its loose
   text and inline elements: paragraphs, headings, tables and lists stay with all
   they hold, since articles may share passages. On a page without an article a
   text block goes with a recurring box around it or if it is a list of links, not
   by itself. Pages with equal html count once.
4. What is left of the `article` or `main` elements, or of the whole page if it
   has none, is text: character references decoded, white space within a
   block one space, blocks joined by a line break in page order.

Counting is an aggregate that combines on the map side; the templates found go
back to their pages by a join on host, hash and slice, so that a host or a
menu on very many pages is spread over tasks.

Defined results: null or empty html gives empty text and n_chars 0. A url
without a host belongs to the host "". Repeated rows each give a row. A page is read in
one pass, with memory and time in proportion to its length.
"""

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import in_small_batches, table

TEMPLATE_PAGES = 4
# Rows of one host and hash go to slices of about this many.
ROWS_PER_SLICE = 100_000

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-hidden|hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
# No main text by kind of element.
DROP_TAGS = frozenset(
    "head script style noscript template iframe nav footer aside form button select option textarea "
    "input label fieldset svg canvas object embed audio video map dialog menu title noembed noframes".split()
)
# No main text by a word of class, id or role, outside of articles.
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar pager pagination skip "
    "header masthead footer foot colophon contentinfo copyright sidebar side aside complementary widget widgets "
    "notice cookie cookies consent gdpr popup modal overlay alert newsletter subscribe subscription signup login "
    "search form share sharing social related recommended recommendations trending "
    "comment comments commentlist disqus respond replies reply discussion".split()
)
MAIN_TAGS = frozenset(("article", "main"))
# Names that say this of an article and inside of one, too; the page as a whole is never dropped by name.
DROP_ARTICLES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo related recommended "
    "comment comments commentlist disqus respond replies reply newsletter sharing".split()
)
# Joined to a name above these say where it is, not what else it is.
PLACE = frozenset(
    "site page main top bottom left right primary secondary inner outer block bar area box wrap wrapper container "
    "section list item global".split()
)
# These may hold a whole page, as an element with such a name may.
SOFT_TAGS = frozenset(("form", "fieldset"))
WHOLE = frozenset(("html", "body", "main"))
# In an article a header holds its title.
HEADERS = frozenset(("header", "masthead"))
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
# In an article these hold its own text and are never taken as template, nor is what they hold.
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre table caption tbody thead tfoot tr td th ul ol li dl dd dt figure figcaption".split()
)
# An open p ends where one of these begins.
ENDS_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# An open element ends where its like begins, up to the element that holds both.
ENDS_SELF = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SPACE = re.compile(r"\s+")


NO_TEMPLATE = frozenset(("#root", "html", "head", "body", "br", "hr", "img", "meta", "link", "title"))


class Node:
    __slots__ = ("tag", "names", "parts", "drop", "soft")

    def __init__(self, tag, names=(), drop=False, soft=False):
        # drop: no main text; soft: said only by its name
        self.tag, self.names, self.drop, self.soft = tag, names, drop, soft
        self.parts = []  # text and child nodes in order


def _names(attributes):
    """(words of class, id and role, whether the element is hidden)."""
    words, hidden = [], False
    for m in NAMED.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name in ("class", "id", "role"):
            words += value.split()
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return tuple(sorted({w for w in words if w})), hidden


def says(names, bad):
    """Whether one of an element's names is a word of `bad`, alone or with words of place."""
    for name in names:
        if name in bad:
            return True
        words = [w for w in re.split(r"[-_]+", name) if w]
        if len(words) > 1 and not bad.isdisjoint(words) and all(w in bad or w in PLACE for w in words):
            return True
    return False


def parse(text):
    """The tree of a page; forgiving, as pages leave elements open."""
    root = Node("#root")
    stack, at, n = [root], 0, len(text)
    while at < n:
        m = TAG.search(text, at)
        if m is None:
            stack[-1].parts.append(text[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(text[at : m.start()])
        at = m.end()
        if m.group(2) is None:  # a comment or declaration
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # An end tag inside does not end a surrounding block it does not belong to.
                if stack[k].tag in ("table", "article", "main", "body") and tag not in ("body", "html", "article", "main", "table"):
                    break
            continue
        names, hidden = _names(m.group(3)) if m.group(3) else ((), False)
        node = Node(tag, names, hidden or tag in DROP_TAGS)
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in ENDS_SELF:
            like, holder = ENDS_SELF[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in like:
                    del stack[k:]
                    break
                if stack[k].tag in holder:
                    break
        inside = any(x.tag in MAIN_TAGS for x in stack)
        if node.drop and tag in SOFT_TAGS and not hidden:
            node.soft = not inside
        elif not node.drop and tag not in WHOLE and (names or tag == "header"):
            bad = DROP_ARTICLES if inside or tag == "article" else DROP_NAMES
            node.drop = node.soft = says(names, bad) or (tag == "header" and not inside)
        stack[-1].parts.append(node)
        if tag in VOID or (m.group(3) or "").endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|$", re.I).search(text, at) if tag != "noscript" else None
            if end is not None:
                node.parts.append(text[at : end.start()])
                at = end.end()
                continue
        stack.append(node)
    return root


def _kept_mains(root, through_soft):
    """(outermost article and main elements that are kept, the soft elements around them)."""
    found, around, todo = [], [], [(root, ())]
    while todo:
        node, above = todo.pop()
        if node.drop:
            if not (through_soft and node.soft):
                continue
            above = (*above, node)
        if node.tag in MAIN_TAGS:
            found.append(node)
            around += above
            continue
        todo += [(x, above) for x in reversed(node.parts) if isinstance(x, Node)]
    return found, around


def _keep_large(root):
    """Keeps soft elements that hold more than half of the page's text in text blocks."""
    size, order, todo = {}, [], [(root, False)]
    while todo:
        x, own = todo.pop()
        own = own or x.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6")
        size[id(x)] = sum(len(c.strip()) for c in x.parts if isinstance(c, str)) if own else 0
        order.append(x)
        todo += [(c, own) for c in x.parts if isinstance(c, Node) and (c.soft or not c.drop)]
    for x in reversed(order):
        size[id(x)] += sum(size.get(id(c), 0) for c in x.parts if isinstance(c, Node))
    for x in order:
        if x.soft and 2 * size[id(x)] > size[id(root)]:
            x.drop = x.soft = False


def mains(root):
    """The outermost article and main elements that are kept; the whole page if there are none.

    Elements that only their name or a form speaks against are kept around a page's
    only articles, and if they hold most of a page without any.
    """
    found, _ = _kept_mains(root, False)
    if not found:
        found, around = _kept_mains(root, True)
        for x in around:
            x.drop = x.soft = False
        if not found:
            _keep_large(root)
    # A main element holds the articles of a page; an article in it is inside and found with it.
    return found or [root]


def link_list(node):
    """Whether more than half of a list's or table's text is in links."""
    text, linked, todo = 0, 0, [(node, False)]
    while todo:
        x, link = todo.pop()
        link = link or x.tag == "a"
        n = sum(len(c.strip()) for c in x.parts if isinstance(c, str))
        text, linked = text + n, linked + (n if link else 0)
        todo += [(c, link) for c in x.parts if isinstance(c, Node)]
    return 2 * linked > text


def hashes(root, roots):
    """(hash, node, whether in an article) of every subtree of a page that could be template; `roots`: its `mains`."""
    articles = roots != [root]
    todo, order, out = [(root, False, False, False)], [], []
    while todo:  # children after parents; read backwards
        x, within, own, gone = todo.pop()
        if not own and x.tag in TEXT_TAGS and (within or not articles):
            own = within or x.tag not in ("ul", "ol", "dl", "table") or not link_list(x)
        order.append((x, within, own, gone))
        within, gone = within or x.tag in MAIN_TAGS, gone or x.drop
        todo += [(c, within, own, gone) for c in x.parts if isinstance(c, Node)]
    value = {}
    for x, within, own, gone in reversed(order):
        h = hashlib.blake2b(f"{x.tag} {' '.join(x.names)}".encode("utf-8", "replace"), digest_size=8)
        for c in x.parts:
            if isinstance(c, Node):
                h.update(value.get(id(c), b""))
            else:
                h.update(SPACE.sub(" ", c).strip().encode("utf-8", "replace"))
        value[id(x)] = d = h.digest()
        # The page itself, and what goes with a part that goes anyway, is not counted.
        if gone or x.tag in NO_TEMPLATE or x.tag in MAIN_TAGS:
            continue
        if not (own or (within and x.tag not in BLOCKS)):
            out.append((int.from_bytes(d, "big", signed=True), x, within))
    return out


def delete(node, within):
    """Deletes a template; of one in an article the loose text, down to the boxes and text blocks in it.

    A box in a box recurs as often as that and is deleted by itself.
    """
    if not within:
        node.drop = True
        return
    todo = [node]
    while todo:
        x = todo.pop()
        x.parts = [c for c in x.parts if isinstance(c, Node)]
        todo += [c for c in x.parts if c.tag not in BLOCKS]


def main_text(roots):
    """Text of the kept parts: blocks joined by line breaks."""
    blocks, line = [], []

    def end():
        block = SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if block:
            blocks.append(block)
        line.clear()

    for root in roots:
        end()
        todo = [root]
        while todo:
            x = todo.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                line.append(x)
            elif x.tag in ("br", "wbr"):
                line.append(" " if x.tag == "br" else "")
            elif not x.drop:
                if x.tag in BLOCKS:
                    end()
                    todo.append(None)
                todo += reversed(x.parts)
    end()
    return "\n".join(blocks)


def candidates(text):
    """(tree of a page, [(hash, node, whether in an article)] that could be template)."""
    root = parse(text)
    return root, hashes(root, mains(root))


def page_text(text, templates=()):
    """Main text of a page without the subtrees of the given hashes."""
    if not templates:
        return main_text(mains(parse(text)))
    root = parse(text)
    roots = mains(root)  # before the deletions, which must not make a part of the page its main one
    for h, node, within in hashes(root, roots):
        if h in templates:
            delete(node, within)
    return main_text(roots)


def _subtrees(batches):
    for batch in batches:
        page, found = [], []
        for k, text in zip(batch.column("page_key").to_pylist(), batch.column("html").to_pylist(), strict=True):
            own = {h for h, *_ in candidates(text)[1]} if text else ()
            page += [k] * len(own)
            found += own
        host = dict(zip(batch.column("page_key").to_pylist(), batch.column("host").to_pylist(), strict=True))
        yield pa.RecordBatch.from_pydict(
            {
                "page_key": pa.array(page, pa.int64()),
                "host": pa.array([host[k] for k in page], pa.string()),
                "subtree": pa.array(found, pa.int64()),
            }
        )


def _extract(names):
    def run(batches):
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True):
                texts.append(page_text(text, set(cuts or ())) if text else "")
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in names}
                | {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            )

    return run


def templates(pages: DataFrame, least_pages: int = TEMPLATE_PAGES) -> DataFrame:
    """page_key and the template subtrees on that page, for pages that have any.

    `pages` has page_key, host and html, one row for each different page of a host.
    """
    rows = cut(
        pages.mapInArrow(_subtrees, "page_key long, host string, subtree long"),
        "subtrees",
    )
    size = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = rows.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    found = cut(
        counts.join(size, "host").filter(F.col("n") >= F.ceil(F.log2("host_pages"))).select("host", "subtree", "n"),
        "templates",
    )
    most = found.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    slices = 1 + most // ROWS_PER_SLICE
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("page_key"), F.lit(slices)))
    found = found.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).drop("n")
    hits = sliced.join(found.withColumn("slice", F.col("slice").cast("long")), ["host", "subtree", "slice"])
    # As many as a page has subtrees at most.
    return hits.groupBy("page_key").agg(F.collect_set("subtree").alias("templates"))


def extract(pages: DataFrame, least_pages: int = TEMPLATE_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    in_small_batches(pages)
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("page_key", F.xxhash64("host", "html"))
    # Equal pages of a host count once: any row of theirs will do, as key and html are equal.
    once = rows.groupBy("host", "page_key").agg(F.count("*").alias("n"))
    repeated = cut(once.filter("n > 1").select("page_key"), "repeated-pages")
    single = rows.select("page_key", "host", "html")
    if not repeated.isEmpty():
        again = single.join(repeated, "page_key", "left_semi").groupBy("page_key", "host").agg(F.first("html").alias("html"))
        single = single.join(repeated, "page_key", "left_anti").select("page_key", "host", "html").union(again)
    cuts = cut(templates(single, least_pages), "page-templates")
    joined = rows.join(cuts, "page_key", "left").select("page_id", "url", "html", "templates")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name in ("page_id", "url"))
    return joined.mapInArrow(_extract(["page_id", "url"]), kind + ", text string, n_chars long")


def op2_html_main(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
