"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree.  A node is the path of block
elements with their presentation (tag, class and id names, and what they mark)
and the kinds of its children, known by a 64-bit hash that its path is chained
to, so a node costs the same at any depth.  Over the distinct pages that have it
a node shows

* layout entropy, of the child sequences it is laid out with,
* content entropy, of the texts it holds, their digits masked,
* a share, of the words of its parent that stand in it or below.

A node that looks and reads the same everywhere has importance 0, one that
differs on every page 1; a branch is cut if all its nodes on the page are of low
importance.  Where one branch holds nearly all words, slight branches beside it
(menus, adverts, footers whose words change from page to page) are cut as well.
Marks are evidence of the same table: elements and whole names that mark
boilerplate, and all beside an article or main element, have importance 0; a
name that only holds such a word counts if the node's share is small.  Nodes that few
pages of a host show borrow from pages of the same layout on other hosts: a branch that is
slight beside a main one there goes.  What no host tells has marks alone.

The tree is a table of one row a host and node; pages are not grouped, so a host
of any size is spread evenly.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Importance below which a node is cut, and the fewest pages that can show it.
LOW = 0.2
PAGES = 4
#: Share of its parent's words that a branch must have to be the main one, and that others must stay under.
MAIN_SHARE = 0.75
SLIGHT = 0.1
#: Share under which a name that holds a word for noise is believed.
DOUBTED = 0.25
#: Rows of the table of cut nodes up to which tasks hold it whole, and the parts a host has beyond.
BROADCAST_ROWS = 100_000
SALTS = 64
#: What a node marks: nothing, the main text, perhaps noise, noise, a place beside the main text.
PLAIN, MAINLY, DOUBT, NOISY, BESIDE = range(5)

# HTML's elements by kind, and names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
DROPPED = frozenset("nav footer aside form button select textarea menu dialog".split())
MAIN = frozenset("article main".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login sidebar widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc comment comments reply replies respond discussion disqus share sharing social related recommended footer masthead topbar toolbar skip copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
#: Elements that a start tag closes if they are open, up to the given bounds.
CLOSES = {
    "p": ({"p"}, {"div", "article", "main", "section", "body", "td", "li", "blockquote"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
for _tag in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split():
    CLOSES[_tag] = CLOSES["p"]

_names = re.compile(r"[a-z]+")


def host_of(url: str | None) -> str:
    """The host of a URL in lower case; empty where there is none."""
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].partition(":")[0].lower() if m else ""


def _named(given: dict) -> int:
    """NOISY if a class or id is made of words for noise alone, DOUBT if it holds one, else PLAIN."""
    found = PLAIN
    for token in " ".join(given.get(a) or "" for a in ("class", "id")).lower().split():
        words = _names.findall(token)
        if words and NOISE.issuperset(words):
            return NOISY
        if not NOISE.isdisjoint(words):
            found = DOUBT
    return found


class Node:
    __slots__ = ("children", "head", "id", "label", "main", "mark", "parent", "parts", "path", "soft", "unseen", "words")

    def __init__(self, tag: str, label: str, parent: Node | None, mark: int = PLAIN, soft: bool = False, unseen: bool = False):
        self.label, self.parent, self.mark = label, parent, mark
        self.soft = soft  # noise by its names, its role or as a form only
        self.unseen = unseen
        self.head = tag == "h1"
        self.children: list[Node] = []
        self.parts: list = []  # texts, and nodes at their places
        self.id = self.path = self.words = self.main = 0


class _Builder(HTMLParser):
    """A tree of block elements; inline elements leave their text to the block around.

    The places of every tag on the stack are kept, so no tag searches it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", None)
        self.open: list[tuple[str, Node]] = [("", self.root)]  # a tag and the block its text goes to
        self.places: dict[str, list[int]] = {}

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _close(self, k: int):
        for tag, _ in self.open[k:]:
            self.places[tag].pop()
        del self.open[k:]

    def _push(self, tag: str, node: Node):
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, node))

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            k = self._last(ends)
            if k and k > self._last(bounds):
                self._close(k)
        at = self.open[-1][1]
        if tag == "br" or tag == "hr":
            at.parts.append(" ")
        if tag in VOID:
            return
        given = dict(attrs)
        names = sorted({w for a in ("class", "id") for w in _names.findall((given.get(a) or "").lower())})
        named = _named(given) if tag not in ("html", "body") else PLAIN
        unseen = tag in UNSEEN or "hidden" in given
        hard = unseen or (tag in DROPPED and tag != "form") or (tag == "header" and not self._last(MAIN))
        noise = hard or tag == "form" or (given.get("role") or "").lower() in ROLES or (named == NOISY and tag not in MAIN)
        mark = NOISY if noise else MAINLY if tag in MAIN and named == PLAIN else DOUBT if named else PLAIN
        if mark == MAINLY:
            above = at  # what holds the main text is no noise, whatever its names
            while above is not None and above.mark != MAINLY:
                above.mark = PLAIN if above.soft or above.mark == DOUBT else above.mark
                above = above.parent
        if tag in INLINE and not noise:
            self._push(tag, at)
            return
        node = Node(tag, ".".join([tag, *names]), at, mark, noise and not hard, unseen)
        at.children.append(node)
        at.parts.append(node)
        self._push(tag, node)

    def handle_endtag(self, tag):
        k = self._last((tag,))
        if k and not (tag in INLINE and self._last(MAIN) > k):
            self._close(k)

    def handle_data(self, data):
        self.open[-1][1].parts.append(data)


def _below(root: Node, enter=lambda n: True) -> list[Node]:
    """Nodes below ``root`` that are entered, each before its children, in page order."""
    found, todo = [], list(reversed(root.children))
    while todo:
        n = todo.pop()
        if not n.unseen and enter(n):
            found.append(n)
            todo += reversed(n.children)
    return found


def parse(html: str | None) -> Node:
    """The page's tree with marks, ids and words: all that the tree of its site is made of."""
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except (AssertionError, ValueError):  # a declaration the parser gives up on; what was read stands
        pass
    root = b.root
    nodes = _below(root)
    for n in reversed(nodes):
        own = "".join(p if isinstance(p, str) else " " for p in n.parts)
        n.words += len(own.split())
        n.parent.words += n.words
        n.parent.head |= n.head
    quiet = _below(root, lambda n: n.mark != NOISY)
    outer = _outermost(quiet)
    if any(blocks(n, _marked) for n in outer):
        around, inside = set(), {id(n) for n in outer}
        for n in outer:
            while n.parent is not None and id(n.parent) not in around:
                n = n.parent
                around.add(id(n))
        for n in quiet:  # in page order, parents first
            if id(n) not in around and id(n) not in inside:
                if id(n.parent) in inside:
                    inside.add(id(n))
                else:
                    n.mark = BESIDE
    for n in nodes:
        if n.children and not _marked(n):
            n.parent.main = max(n.parent.main, n.words)
        n.path = _hash(f"{n.parent.path} {n.mark} {n.label}")
        n.id = _hash(" ".join([str(n.path), *sorted({c.label for c in n.children})]))
    return root


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _outermost(nodes: list[Node]) -> list[Node]:
    """Main nodes among ``nodes`` (parents first) that lie in no other one."""
    inside, found = set(), []
    for n in nodes:
        if id(n.parent) in inside:
            inside.add(id(n))
        elif n.mark == MAINLY:
            inside.add(id(n))
            found.append(n)
    return found


def _marked(node: Node) -> bool:
    return node.mark in (NOISY, BESIDE)


def blocks(node: Node, gone=_marked, mute=lambda n: False) -> list[str]:
    """Texts of the blocks below ``node`` in page order, without ``gone`` branches and ``mute`` nodes' own texts."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    stack = [(iter(node.parts), not mute(node))]
    while stack:
        parts, heard = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if heard:
                    held.append(part)
            elif not part.unseen and not gone(part):
                flush()
                stack.append((iter(part.parts), not mute(part)))
                break
        else:
            flush()
            stack.pop()
    return out


def main_text(html: str | None, cuts=frozenset(), lows=frozenset()) -> str:
    """The page's text without the ``cuts`` branches and those made of ``lows`` nodes alone.

    Neither empties a page: low nodes stay where nothing else is left, and where
    the cuts leave nothing the marks of the page itself decide.  Without ``cuts``
    and ``lows`` they do so at once.
    """
    root = parse(html)
    if cuts or lows:
        kept: set[int] = set()
        for n in reversed(_below(root, lambda n: n.id not in cuts)):
            if n.id not in lows or id(n) in kept:
                kept.add(id(n))
                kept.add(id(n.parent))
        text = " ".join(blocks(root, lambda n: id(n) not in kept, lambda n: n.id in lows)) or " ".join(blocks(root, lambda n: n.id in cuts))
        if text:
            return text
    return " ".join(blocks(root))


NODE = "node long, mark int, head boolean, words long, held long, main long, layout long, content long"
_digits = re.compile(r"\d")


def observe(html: str | None) -> list[tuple]:
    """Rows of ``NODE`` for every node of a page, the places of one node taken together.

    ``held`` are the words of its parents, ``main`` those of the largest branch
    with blocks below each of them.
    """
    seen: dict[int, list] = {}
    for n in _below(parse(html)):
        row = seen.setdefault(n.id, [n.mark, False, 0, 0, 0, [], [], None])
        row[1] |= n.head
        row[2] += n.words
        if row[7] is not n.parent:
            row[7] = n.parent
            row[3] += n.parent.words
            row[4] += n.parent.main
        row[5].append(",".join(c.label for c in n.children))
        row[6] += [p for p in n.parts if isinstance(p, str)]
    return [(k, *r[:5], _hash(";".join(r[5])), _hash(_digits.sub("0", " ".join(" ".join(r[6]).split())))) for k, r in seen.items()]


def _observed(pages: DataFrame, html: str, url: str) -> DataFrame:
    """How often each node of a host shows each layout and content, over its distinct pages; as a checkpoint."""

    def rows(it):
        names = ["host", "page", *(f.split()[0] for f in NODE.split(", "))]
        for pdf in it:
            out = []
            for u, page, same in zip(pdf["u"], pdf["h"], pdf["page"]):
                host = host_of(u)
                out += [(host, same, *x) for x in observe(page)]
            yield pd.DataFrame(out, columns=names)

    seen = pages.select(F.col(url).alias("u"), F.col(html).alias("h"), F.xxhash64(F.col(html)).alias("page"))
    seen = seen.mapInPandas(rows, f"host string, page long, {NODE}").distinct()
    sums = [F.sum(c).alias(c) for c in _SUMS]
    # one pass over the pages: all counts come from the same grouped rows
    return cut(seen.groupBy("host", "node", "layout", "content").agg(F.count("*").alias("n"), F.min("mark").alias("mark"), F.bool_or("head").alias("head"), *sums))


_SUMS = ("words", "held", "main")


def _shares() -> list:
    return [F.coalesce(F.try_divide(c, "held"), F.lit(0.0)).alias(a) for c, a in (("words", "share"), ("main", "main"))]


def style_tree(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The merged trees' nodes: ``host``, ``node``, ``mark``, ``head``, ``pages``, ``importance``, ``share``, ``main``.

    Copies of a page count once a host.  With m pages and shares p of the values a
    node takes, its entropy is - sum p log_m p; a node's importance is the larger
    of its two, 1 on a single page.  ``share`` is that of its parents' words,
    ``main`` that of the largest branches there.
    """
    return _merged(_observed(pages, html, url))


def _merged(pairs: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _SUMS]

    def of(value: str, *more) -> DataFrame:
        n = pairs.groupBy("host", "node", value).agg(F.sum("n").alias("n"), *more)
        again = [F.min("mark").alias("mark"), F.bool_or("head").alias("head"), *sums] if more else []
        total = n.groupBy("host", "node").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.ln("n")).alias("s"), *again)
        return total.withColumn(value, F.when(F.col("m") < 2, 1.0).otherwise(1 - F.col("s") / F.col("m") / F.ln("m"))).drop("s")

    both = of("layout").join(of("content", F.min("mark").alias("mark"), F.bool_or("head").alias("head"), *sums).drop("m"), ["host", "node"])
    return both.select("host", "node", "mark", "head", F.col("m").alias("pages"), F.greatest("layout", "content").alias("importance"), *_shares())


def _slight(main: str = "main", share: str = "share", head: str = "head"):
    return (F.col(main) >= MAIN_SHARE) & (F.col(share) < SLIGHT) & ~F.col(head)


def decisions(tree: DataFrame, low: float = LOW) -> DataFrame:
    """``host, node, whole``: the nodes that go, with their whole branches or only in branches of such nodes."""
    many = F.col("pages") >= PAGES
    whole = F.when(F.col("mark").isin(NOISY, BESIDE), True).when(F.col("mark") == DOUBT, many & (F.col("share") < DOUBTED)).when(F.col("mark") == PLAIN, many & _slight()).otherwise(False)
    lows = many & (F.col("importance") < low) & F.col("mark").isin(PLAIN, DOUBT)
    return tree.withColumn("whole", whole).filter(F.col("whole") | lows).select("host", "node", "whole")


def borrowed(tree: DataFrame, pairs: DataFrame) -> DataFrame:
    """``host, node, whole`` for nodes that too few pages of their host show: those of one layout on other hosts tell.

    A node's hash is that of its path, looks and children, so sites of one make share it.  A
    branch goes if it is slight beside a main one over all pages that have it, and has a larger one beside it on
    its own host's pages too.  Texts are no evidence here: copies of an article on many hosts would read as boilerplate.
    """
    few = tree.filter((F.col("pages") < PAGES) & (F.col("mark") == PLAIN) & ~F.col("head") & (F.col("share") < F.col("main"))).select("host", "node")
    wide = pairs.groupBy("node").agg(F.sum("n").alias("pages"), F.bool_or("head").alias("head"), *[F.sum(c).alias(c) for c in _SUMS])
    wide = wide.select("node", "pages", "head", *_shares()).filter((F.col("pages") >= PAGES) & _slight()).select("node")
    return few.join(wide, "node").select("host", "node", F.lit(True).alias("whole"))


def extract(
    pages: DataFrame, html: str = "html", url: str = "url", id_col: str = "page_id", low: float = LOW, broadcast_rows: int = BROADCAST_ROWS, salts: int = SALTS
) -> DataFrame:
    """``page_id, url, text, n_chars``: one row per row of ``pages``, repeated rows alike.

    Null html is an empty page with an empty text.  Pages of a null url, or one
    without a host, form one site.  Other columns are not read.  A page of any length or
    depth is read whole; of equal shares at a bound the branch stays; an empty table gives no row.

    Up to ``broadcast_rows`` nodes that go are held by every task.  Beyond, pages
    and nodes meet by host and salt, nodes first, and a task holds one host's.
    """
    pairs = _observed(pages, html, url)
    tree = _merged(pairs)
    gone = cut(decisions(tree, low).unionByName(borrowed(tree, pairs)))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("h"))
    out = "page_id long, url string, text string, n_chars long"
    none = (frozenset(), frozenset())

    def texts(pdf, sets):
        found = [main_text(h, *s) for h, s in zip(pdf["h"], sets)]
        return pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": found, "n_chars": [len(t) for t in found]})

    if gone.count() <= broadcast_rows:
        by: dict[str, tuple[set, set]] = {}
        for r in gone.collect():
            by.setdefault(r["host"], (set(), set()))[not r["whole"]].add(r["node"])
        shared = pages.sparkSession.sparkContext.broadcast(by)

        def held(it):
            for pdf in it:
                yield texts(pdf, [shared.value.get(host_of(u), none) for u in pdf["url"]])

        return rows.mapInPandas(held, out)

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#]*@)?([^/?#:@]*)", 1))
    keyed = rows.withColumn("host", host).withColumn("salt", F.pmod(F.xxhash64("page_id", "h"), F.lit(salts)).cast("int"))
    keyed = keyed.withColumn("node", F.lit(None).cast("long")).withColumn("whole", F.lit(None).cast("boolean"))
    laid = gone.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = keyed.unionByName(laid, allowMissingColumns=True).repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("node").isNull())

    def merged(it):
        at, sets = None, none
        for pdf in it:
            here = []
            for place, node, whole in zip(zip(pdf["host"], pdf["salt"]), pdf["node"], pdf["whole"]):
                if place != at:
                    at, sets = place, (set(), set())
                if not pd.isna(node):
                    sets[not whole].add(int(node))
                here.append(sets)
            pages_here = pdf["node"].isna().to_numpy()
            yield texts(pdf[pages_here], [s for s, k in zip(here, pages_here) if k])

    text = F.col("node").cast("string")  # a long column with nulls would come as floats
    return met.withColumn("node", text).mapInPandas(merged, out)


#: What the tree must find in pages that hold one article each, in the few elements and references these use; no
#: statement of the method, which SQL has no parser for.
SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS h FROM a),
t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(h, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""
