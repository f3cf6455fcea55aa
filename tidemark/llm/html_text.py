"""Main text of web pages: site template removal.

Every page is parsed to a tree. Of the whole tree, before anything goes, the block subtrees are hashed in two ways: by tags and text, and,
where half the words or more stand in links, by tags, names and roles alone, since menus often differ in text from page to page. Spark counts on
how many different pages of a host each hash stands; subtrees on at least MIN_PAGES and SHARE of them are the site's template and are
deleted. Copies of one page count once, so an article is no template because its page was fetched often; and what holds an article or main
element, or is a paragraph, heading or other prose inside one, stays, since articles quote each other.

Counts need several pages of a host. As a fallback, on every page, subtrees whose element says what they are go too (menus, headers outside the
article, footers, asides, forms, scripts, styles, adverts, notices, comments; by tag, role, class or id); inside an article or main element, only names
that no part of an article has. All other text stays, in page order, inside an article element or not. `removed` tells how many words counts and names remove.

Template hashes of a host are few (at most mean subtrees a page / SHARE): hosts whose list is short are broadcast together
if all lists hold MOST_SHARED hashes at most, else pages are dealt by host and a hash of the page, so that a large host is many tasks.

Defined results: a null or empty page has empty text; a null or odd url is a host of its own
value; unclosed and stray tags follow the usual rules (a block ends an open paragraph, a stray end
tag is ignored); pages of any depth and length are taken, in time in proportion to their tags; repeated rows give equal rows; further columns are ignored. A line
break is white space inside its block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

MIN_PAGES, SHARE = 5, 0.1
#: Template hashes of all hosts that may be broadcast, 8 bytes each; and tasks that share a host where there are more.
MOST_SHARED, SALTS = 1_000_000, 64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt figcaption".split())
#: Open elements that a start tag ends, and the elements beyond which it ends none.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
DROPPED = frozenset("head nav footer aside form script style noscript template iframe object embed svg canvas button select input textarea dialog menu audio video map title xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words that mark a part as no article text where they are a class or id, or make one up with others of them and with plain ones.
MARKS = frozenset(
    "ad ads adsense adslot adbox banner cookie cookies consent gdpr notice notices newsletter signup paywall popup modal overlay sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead comment comments disqus replies reply respond share sharing social related widget toolbar pagination pager skip login search".split()
)
#: The same by their beginnings.
STEMS = ("advert", "sponsor", "promo", "subscri", "recommend")
#: Marks that parts of articles have as well: inside an article or main element they mark nothing.
PARTS_OF_ARTICLES = frozenset("banner notice notices overlay side menu footer header masthead widget toolbar search".split())
#: Words of layout, which say nothing about a part: site-header is a header, header-story is none.
PLAIN = frozenset(
    "site page global main primary secondary top bottom left right upper lower inner outer sticky fixed wrapper wrap container holder box bar strip list area zone section block "
    "region row col column group panel slot unit link links item items button buttons btn icon icons form field post posts article articles story stories widget widgets text".split()
) - {"story", "stories", "article", "text"}
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Node:
    __slots__ = ("tag", "attrs", "inner")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.inner = tag, attrs, []


def parse(page: str) -> Node:
    """The tree of a page; `inner` holds nodes and decoded texts in order."""
    root = Node("#root", "")
    stack, opened, at = [root], Counter(), 0

    def say(text: str) -> None:
        if text:
            stack[-1].inner.append(html.unescape(text) if "&" in text else text)

    def close(k: int) -> None:
        opened.subtract(n.tag for n in stack[k:])
        del stack[k:]

    def innermost(tags, fences) -> int | None:
        """The outermost open element of `tags` above the innermost fence."""
        low = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in fences:
                break
            if stack[k].tag in tags:
                low = k
        return low

    while True:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            return root
        say(page[at : m.start()])
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            continue
        if m[1]:
            if opened[tag] > 0:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            elif tag == "p":
                stack[-1].inner.append(Node("p", ""))
            continue
        if tag in BLOCKS and opened["p"] > 0:  # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in ENDS and any(opened[t] > 0 for t in ENDS[tag]):
            low = innermost(ENDS[tag], FENCES.get(tag, {"table"}))
            if low is not None:
                close(low)
        node = Node(tag, m[3])
        stack[-1].inner.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.inner.append(page[at:stop])
            at = page.find(">", stop) + 1 if end else len(page)
            at = at or len(page)
            continue
        stack.append(node)
        opened[tag] += 1


def _attributes(node: Node) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(node.attrs)} if node.attrs.strip() else {}


def marked(value: str, inside: bool) -> bool:
    """Whether a class or id names a part that is no article text: one of its words, cut at hyphens and underscores, is a mark and the others are marks, plain words or numbers.

    A mark beside any other word is part of a name of its own: related-work, share-price, notice-of-award.
    """
    is_mark = lambda w: (w in MARKS or w.startswith(STEMS)) and not (inside and w in PARTS_OF_ARTICLES)
    for token in value.lower().split():
        words = [w for w in re.split(r"[-_]+", token) if w]
        if any(map(is_mark, words)) and all(is_mark(w) or w in PLAIN or w in MARKS or w.isdigit() for w in words):
            return True
    return False


def _dropped(node: Node, inside: bool) -> bool:
    """Whether a node says that it is no article text; inside: within an article or main element."""
    if node.tag in DROPPED or node.tag == "header" and not inside:
        return True
    if not node.attrs.strip() or node.tag in ("html", "body"):
        return False
    attrs = _attributes(node)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in (ROLES - {"search", "banner", "form"} if inside else ROLES):
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    names = (attrs.get("class", ""), attrs.get("id", ""))
    if node.tag in ("article", "main"):
        return any(re.search(r"(?:^|[\s_-])(?:comments?|reply|replies)(?=$|[\s_-])", x, re.I) for x in names)
    return any(marked(x, inside) for x in names)


def hashed(root: Node) -> tuple[list[tuple[Node, int, int | None]], int]:
    """The block subtrees that a template may hold, each with its hash by text and, where half its words stand in links, by shape; and a digest of the page."""
    out: list[tuple[Node, int, int | None]] = []
    state = lambda n: [n, 0, blake2b(n.tag.encode(), digest_size=8), blake2b(n.tag.encode(), digest_size=8), 0, 0, False]  # noqa: E731  node, next child, text and shape hashes, words, words in links, holds an article
    stack, inside, links = [state(root)], 0, 0
    digest = b""
    while stack:
        top = stack[-1]
        node = top[0]
        if top[1] < len(node.inner):
            x = node.inner[top[1]]
            top[1] += 1
            if isinstance(x, str):
                words = x.split()
                if words and node.tag not in RAW:
                    top[2].update(b"t" + " ".join(words).encode("utf-8", "surrogatepass"))
                    top[4] += len(words)
                    top[5] += len(words) if links else 0
            else:
                inside += x.tag in ("article", "main")
                links += x.tag == "a"
                stack.append(state(x))
            continue
        stack.pop()
        inside -= node.tag in ("article", "main")
        links -= node.tag == "a"
        attrs = _attributes(node)
        top[3].update("|".join((attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", ""))).encode("utf-8", "surrogatepass"))
        digest = top[2].digest()
        holds = top[6] or node.tag in ("article", "main")
        if node.tag in BLOCKS and not holds and top[4] and not (inside and node.tag in PROSE):
            number = lambda d: int.from_bytes(d, "little", signed=True)
            menu = 2 * top[5] >= top[4] and node.tag not in PROSE
            out.append((node, number(digest), number(blake2b(b"s" + top[3].digest(), digest_size=8).digest()) if menu else None))
        if stack:
            up = stack[-1]
            up[2].update(b"n" + digest)
            up[3].update(b"n" + top[3].digest())
            up[4] += top[4]
            up[5] += top[5]
            up[6] = up[6] or holds
    return out, int.from_bytes(digest, "little", signed=True)


def blocks(root: Node, gone: set[int], named: bool = True) -> list[str]:
    """Texts of the blocks below in page order, without the nodes of these ids and, if named, those that say what they are."""
    out, run = [], []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [(root, False)]
    while stack:
        n, inside = stack.pop()
        if isinstance(n, str):
            run.append(n)
        elif n is None:
            flush()
        elif id(n) in gone or named and _dropped(n, inside) or n.tag in ("script", "style"):
            if n.tag in BLOCKS or id(n) in gone:
                flush()
        else:
            inside = inside or n.tag in ("article", "main")
            if n.tag in BLOCKS:
                flush()
                stack.append((None, inside))
            if n.tag == "br":
                run.append(" ")
            stack += [(x, inside) for x in reversed(n.inner)]
    flush()
    return out


def _tree_without(page: str, template: set[int]) -> tuple[Node, set[int]]:
    tree = parse(page)
    return tree, {id(n) for n, h, shape in hashed(tree)[0] if h in template or shape in template} if template else set()


def extract(page: str | None, template: set[int]) -> str:
    return "\n".join(blocks(*_tree_without(page, template))) if page else ""


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _subtrees(batches):
    for b in batches:
        hosts, digests, hashes = [], [], []
        for at, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found, digest = hashed(parse(page or ""))
            own = {h for _, text, shape in found for h in (text, shape) if h is not None}
            hosts += [at] * (len(own) + 1)
            digests += [digest] * (len(own) + 1)
            hashes += [None, *own]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(hashes, pa.int64())], names=["host", "page", "h"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): hashes of the subtrees on at least MIN_PAGES and SHARE of the different pages of a host. pages(host, html)."""
    seen = pages.mapInArrow(_subtrees, "host string, page long, h long").distinct()
    counts = seen.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    size = counts.where("h is null").select("host", F.col("n").alias("pages"))
    often = counts.where(f"h is not null and n >= {MIN_PAGES}").join(size, "host").where(F.col("n") >= SHARE * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("h").alias("template"))  # at most mean subtrees a page / SHARE


def _with_template(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) with the template of their host."""
    keyed = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    found = stored(templates(keyed.select("host", "html")), "templates")
    if (found.agg(F.sum(F.size("template"))).first()[0] or 0) <= MOST_SHARED:
        return keyed.join(F.broadcast(found), "host", "left")  # MOST_SHARED hashes at most
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64("html", "page_id"), F.lit(SALTS)).cast("int"))
    copies = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["host", "_salt"], "left").drop("_salt")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of pages(page_id, url, html)."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            sets: dict[tuple, set[int]] = {}
            out = []
            for page, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                t = tuple(t or ())
                out.append(extract(page, sets.setdefault(t, set(t))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    return _with_template(pages).select("page_id", "url", "html", "template").mapInArrow(run, f"page_id {id_type}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def removed(pages: DataFrame) -> DataFrame:
    """One row: words of all pages without scripts and styles, words that the counts remove, and words that names remove of the rest."""

    def run(batches):
        words = lambda *a: sum(len(x.split()) for x in blocks(*a))
        for b in batches:
            rows = []
            for page, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tree, gone = _tree_without(page or "", set(t or ()))
                rows.append((words(tree, set(), False), words(tree, gone, False), words(tree, gone)))
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["n_words", "n_left", "n_kept"])

    each = _with_template(pages).select("html", "template").mapInArrow(run, "n_words long, n_left long, n_kept long")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return each.agg(total("n_words").alias("n_words"), (total("n_words") - total("n_left")).alias("by_counts"), (total("n_left") - total("n_kept")).alias("by_names"))
