"""Main texts of web pages by union-free wrappers of hosts.

A page's token stream becomes a tree of block elements. Adjacent siblings of the
same form are folded into repeated groups. The trees of a host's pages are
aligned one after another: what only some have becomes optional, groups merge,
and texts that differ become slots, so that each host has one union-free regular
expression (its wrapper). Tasks fold the pages that they read, then the partial
wrappers of a host are folded; a host that has a third of all pages gives one
partial wrapper a task.

A page is then read again with its host's wrapper. Elements that are never part
of an article by their name, role or whole class name go, unless they hold the main
element or most of the text in slots. Of the rest, the wrapper's element
that holds most of the text in slots is the article. Elements that say that they are
it (<article>, <main>, a class) are a hint: they bound the article where the wrapper
has slot text in them, on the way to that element or below it, and are passed over
where it does not. Of several such elements all stay, unless the wrapper has them as
a repeated group in which each has a line that links to another page, beside
others that are none: teasers. Texts that stand at one place on nearly every page of the host are
the template's and go, inside the article too.

Defined results: a null html gives the empty text; a null or odd url belongs to
the host ""; a host with one page, or with equal pages only, has no template texts, and
there the hint alone decides; damaged markup is read
as far as it goes; repeated rows count each time; an empty table gives an
empty table.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Elements whose content is no markup, or never text of an article.
RAW = "script|style|textarea|title|noscript|template|iframe|svg|math|object|canvas|select|xmp|noembed|noframes"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # svg and math may close themselves; a slash that ends a value without quotes belongs to the value
    r"|<(?:svg|math)(?=[\s/])(?:[^>\"'=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]++))*/>"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?P<rawattr>[^>]*)>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
EXCLUDED = frozenset("head nav header footer aside form button dialog menu fieldset audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
#: Whole names of a class or id, without regard to case and to - and _.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot banner sponsor sponsored sponsors promo promos promotion promotions "
    "menu menus submenu nav navbar navigation navigator breadcrumb breadcrumbs crumbs sidebar sidebars side aside widget widgets footer foot header masthead topbar toolbar "
    "cookie cookies consent gdpr privacy notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup signin login "
    "social share sharing shares sharebar related recommended recommendations trending outbrain taboola comment comments commentlist respond discussion disqus reply replies "
    "pager pagination paging copyright disclaimer legal skip search searchbox form "
    "adcontainer adwrapper adunit adbanner topnav mainnav sitenav subnav mainmenu topmenu navmenu leftsidebar rightsidebar sidebarleft sidebarright siteheader pageheader sitefooter pagefooter "
    "cookienotice cookiebanner cookiebar cookieconsent consentbanner gdprbanner newslettersignup socialshare socialmedia socialicons sharebuttons sharebar sociallinks relatedposts relatedarticles relatedcontent "
    "commentlist commentsection commentssection commentform commentsarea skiplink searchform".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies teaser related promo ad advert sponsored".split())
MAIN_WORDS = frozenset("article content post entry story articlebody postbody maincontent".split())
#: End tags that HTML leaves out: a start tag in the first closes an open one in the second.
CLOSES = {
    **{t: ("p",) for t in "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
#: Elements within each other that are told apart.
DEPTH = 200
SCOPE = frozenset("html body article section div main nav aside header footer table ul ol dl form blockquote td th".split())
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: An address that is not a place in the same page.
LINK = re.compile(r"(?:^|\s)href\s*=\s*[\"']?\s*[^\s\"'#]", re.I)
CLASS_WORD = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: key (tag and classes), whether it is out (1, or 2 if for good), main or a wrapper's optional or repeated part; texts between children are nodes with key #, linked if all of the text is a link to another page."""

    __slots__ = ("key", "tag", "out", "main", "children", "text", "linked")

    def __init__(self, key: str, tag: str, out: int = 0, main: int = 0) -> None:
        self.key, self.tag, self.out, self.main = key, tag, out, main
        self.children: list[Node] = []
        self.text, self.linked = "", False


def _classify(tag: str, attributes: str) -> tuple[str, int, int]:
    """Key, whether the element is out (1, or 2 for a hidden one), and how strongly it says that it is the article (0 to 3)."""
    if not attributes.strip(" /\n\t"):
        return tag, int(tag in EXCLUDED), 3 if tag == "article" else 2 if tag == "main" else 0
    found = {k.lower(): (v[1:-1] if v[:1] in "\"'" else v) for k, v in ATTRIBUTE.findall(attributes)}
    name, role = found.get("class", "") + " " + found.get("id", ""), found.get("role", "").lower()
    words = {w.lower() for w in CLASS_WORD.split(name) if w}
    names = {w.lower().replace("-", "").replace("_", "") for w in name.split()}
    style = found.get("style", "").replace(" ", "").lower()
    out = tag in EXCLUDED or role in ROLES
    if tag == "article":
        out = out or bool(names & COMMENT_WORDS)
    elif tag not in ("html", "body", "main"):
        out = out or bool(names & WORDS)
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    main = 3 if tag == "article" or found.get("itemprop") == "articleBody" else 2 if tag == "main" or role == "main" else 1 if words & MAIN_WORDS else 0
    return f"{tag}.{'.'.join(sorted(words))}" if words else tag, 2 if hidden else int(out), main


def parse(markup: str) -> Node:
    """The tree of block elements; inline elements leave their text to the block."""
    root = Node("root", "root")
    stack, text = [root], []
    link, plain = False, False  # within a link to another page; whether text holds words outside of one

    def flush() -> None:
        nonlocal plain
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                leaf = Node("#", "#")
                leaf.text, leaf.linked = joined, not plain
                stack[-1].children.append(leaf)
        plain = False

    inline_out: list[str] = []  # open inline elements that are out: their text is dropped
    for m in TOKEN.finditer(markup):
        if (t := m["text"]) is not None:
            if not inline_out:
                text.append(entities.unescape(t) if "&" in t else t)
                plain = plain or not (link or t.isspace())
            continue
        tag = m["tag"]
        if tag is None:
            if m[0].startswith("<![CDATA[") and not inline_out:
                text.append(m[0][9:].removesuffix("]]>"))
                plain = plain or not link
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr":
            flush()
        elif tag in INLINE:
            if tag == "a":
                link = not m["close"] and bool(LINK.search(m["attr"]))
            if m["close"]:
                if tag in inline_out:
                    del inline_out[len(inline_out) - 1 - inline_out[::-1].index(tag) :]
            elif inline_out or (m["attr"].strip() and tag not in VOID and _classify(tag, m["attr"])[1]):
                if tag not in VOID and not m["attr"].endswith("/"):
                    inline_out.append(tag)
        elif m["close"]:
            flush()
            inline_out.clear()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            flush()
            inline_out.clear()
            for closed in CLOSES.get(tag, ()):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == closed:
                        del stack[k:]
                        break
                    if stack[k].tag in SCOPE:
                        break
            key, out, main = _classify(tag, m["attr"])
            if out and len(stack) >= DEPTH:
                out = 2
            node = Node(key, tag, out, main)
            stack[-1].children.append(node)
            if len(stack) < DEPTH or out or any(x.out for x in stack[DEPTH - 1 :]):
                stack.append(node)  # deeper elements are left empty, and their texts go to the last that holds any
    flush()
    return root


# A wrapper's node: [key, pages, optional, repeated, text, chars, children, main, out]; text is a
# checksum while all pages agree on it and -1 for a slot; chars adds up slot text;
# main and out are Node's, or main for a text whether it is linked on all pages.


def wrapper_of(node: Node) -> list:
    """One page as a wrapper: equal neighbours folded into repeated groups."""
    own = [node.key, 1, False, False, 0, 0, [], node.main, node.out]
    for child in node.children:
        if child.out == 2:
            continue
        made = ["#", 1, False, False, zlib.crc32(child.text.encode()), len(child.text), [], int(child.linked), 0] if child.key == "#" else wrapper_of(child)
        own[6].append(made)
    own[6] = fold(own[6])
    return own


def fold(children: list) -> list:
    """Adjacent groups of one to three siblings with the same keys become one repeated group."""
    done: list = []
    for child in children:
        done.append(child)
        for size in (1, 2, 3):
            if len(done) >= 2 * size and [c[0] for c in done[-size:]] == [c[0] for c in done[-2 * size : -size]]:
                for a, b in zip(done[-2 * size : -size], done[-size:]):
                    a[5], a[3] = a[5] + b[5], True
                    a[4] = _joined(a[4], b[4])
                    a[6] = align(a[6], b[6], _joined)
                    a[2], a[7], a[8] = a[2] or b[2], _hint(a, b), max(a[8], b[8])
                del done[-size:]
                break
    return done


def _agreed(a: int, b: int) -> int:
    """Texts of two pages."""
    return a if a == b else -1


def _joined(a: int, b: int) -> int:
    """Texts of one page's group: those that differ are no slot yet, as other pages may have the same ones."""
    return zlib.crc32(b"%d %d" % (a, b)) if a != b else a


def align(a: list, b: list, texts: Callable[[int, int], int] = _agreed) -> list:
    """Two sequences of siblings as one: longest common subsequence of keys; the rest is optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [merge(x, y, texts) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j], texts))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            a[i][2] = True
            out.append(a[i])
            i += 1
        else:
            b[j][2] = True
            out.append(b[j])
            j += 1
    return out


def merge(a: list, b: list, texts: Callable[[int, int], int] = _agreed) -> list:
    """The wrapper that both a and b match; both have the same key."""
    return [a[0], a[1] + b[1], a[2] or b[2], a[3] or b[3], texts(a[4], b[4]), a[5] + b[5], align(a[6], b[6], texts), _hint(a, b), max(a[8], b[8])]


def _hint(a: list, b: list) -> int:
    return min(a[7], b[7]) if a[0] == "#" else max(a[7], b[7])


def expression(w: list) -> str:
    """The wrapper as a union-free regular expression."""
    inner = "".join(map(expression, w[6])) if w[0] != "#" else ("#text" if w[4] == -1 else f"'{w[4]:08x}'")
    own = inner if w[0] == "#" else f"<{w[0]}>{inner}</>"
    return own if not (w[2] or w[3]) else f"({own}){'*' if w[2] and w[3] else '?' if w[2] else '+'}"


def _slots(w: list, outs: bool = False) -> int:
    """Characters in slots; with outs, also those of elements that are out."""
    return w[5] if w[0] == "#" and (w[4] == -1) else sum(_slots(c, outs) for c in w[6] if outs or not c[8])


def opened(w: list) -> set[str]:
    """Paths of elements that are out by name, role or class but hold the article; they are let in, here and in w.

    Such are those with most slot text of the host, and those that hold main
    elements and no less slot text than all that is not out; none while main
    elements that are not out bear slot text.
    """
    found: set[str] = set()
    total = _slots(w, True)

    def holds(c: list) -> bool:
        return any(x[7] > 0 or holds(x) for x in c[6] if x[0] != "#")

    def let_in(c: list, path: str) -> None:
        for x in c[6]:
            if x[0] != "#":
                at = f"{path}/{x[0]}"
                if x[8]:
                    n = _slots(x, True)
                    if 2 * n > total or n and (x[7] or holds(x)) and n >= rest:
                        found.add(at)
                        x[8] = 0
                if not x[8]:
                    let_in(x, at)

    rest = _slots(w)
    if total and not any(_marked(w, k) for k in (3, 2, 1)):
        let_in(w, "")
    return found


def open_up(node: Node, paths: frozenset[str] | set[str], path: str = "") -> None:
    """Lets in the elements at these paths."""
    for c in node.children:
        if c.key != "#":
            at = f"{path}/{c.key}"
            if c.out == 1 and at in paths:
                c.out = 0
            if not c.out:
                open_up(c, paths, at)


def open_mains(node: Node) -> bool:
    """Lets in the elements that hold main elements which are not out themselves; whether there are any."""
    any_main = False
    for c in node.children:
        if c.key != "#" and c.out < 2:
            inside = open_mains(c)
            if inside or c.main and not c.out:
                any_main, c.out = True, 0
    return any_main


def content_path(w: list, most: float = 0.6) -> list[list]:
    """Wrapper's nodes from the root to the deepest element with most of the text in slots."""
    path, total = [w], _slots(w)
    while total:
        inner = max((c for c in w[6] if c[0] != "#" and not c[3] and not c[8]), key=_slots, default=None)
        if inner is None or _slots(inner) < most * total:
            break
        path.append(inner)
        w = inner
    return path


def _marked(w: list, level: int) -> bool:
    """Whether slot text stands in an element below w that is main to this level."""
    return any(c[7] == level and _slots(c) > 0 or _marked(c, level) for c in w[6] if c[0] != "#" and not c[8])


def _headed(w: list) -> bool:
    """Whether an element has a line on all pages that is a link to another page."""
    return any((c[7] == 1 if c[0] == "#" else _headed(c)) for c in w[6] if not c[2])


def _teasers(w: list, level: int, path: str = "", repeated: bool = False) -> tuple[set[str], set[str]]:
    """Paths of main elements of the level: those in repeated groups of which each is headed by a link to another page, and the others."""
    teasers: set[str] = set()
    others: set[str] = set()
    for c in w[6]:
        if c[0] != "#" and not c[8]:
            at, again = f"{path}/{c[0]}", repeated or c[3]
            if c[7] == level:
                (teasers if again and _headed(c) else others).add(at)
            else:
                x, y = _teasers(c, level, at, again)
                teasers, others = teasers | x, others | y
    return teasers, others


class Known:
    """What a host's wrapper says of its pages: the path of the article, the strongest level of main elements that it bears out, paths of teasers by level, of elements to let in, and the template's texts."""

    def __init__(self, w: list | None = None, template: frozenset[int] = frozenset()) -> None:
        self.opened = opened(w) if w else set()
        nodes = content_path(w) if w else []
        self.path, self.template = [x[0] for x in nodes], template
        # without slots nothing is known against the hint
        self.level, self.teasers = 3, {}
        for k in (3, 2, 1) if w else ():
            teasers, others = _teasers(w, k)
            self.teasers[k] = frozenset(teasers - others if others else ())
        self.slots = bool(w and _slots(w))
        if self.slots:
            self.level = next((k for k in (3, 2, 1) if any(x[7] == k for x in nodes) or _marked(nodes[-1], k)), 0)


def identity(path: str, text: str) -> int:
    """A text at its place in the page, as 64 bits."""
    return int.from_bytes(blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _texts(node: Node, path: str, out: list[tuple[str, str]], least: int = 1) -> None:
    """Path and text of each block below node that is not out from `least` on."""
    for c in node.children:
        if c.key == "#":
            out.append((path, c.text))
        elif c.out < least:
            _texts(c, f"{path}/{c.key}", out, least)


def _mains(node: Node, path: str, found: list[tuple[Node, str]], level: int) -> None:
    for c in node.children:
        if not c.out and c.key != "#":
            if c.main == level:
                found.append((c, f"{path}/{c.key}"))
            else:
                _mains(c, f"{path}/{c.key}", found, level)


def _found(root: Node, level: int) -> list[tuple[Node, str]]:
    found: list[tuple[Node, str]] = []
    _mains(root, "", found, level)
    return found


def _blocks(root: Node, known: Known) -> list[tuple[str, str]]:
    """Path and text of the article's blocks, those of the template among them."""
    open_up(root, known.opened)
    if not known.slots and not any(_found(root, k) for k in (3, 2, 1)):
        open_mains(root)
    for level in range(known.level, 0, -1):
        found = _found(root, level)
        blocks: list[tuple[str, str]] = []
        left = [x for x in found if x[1] not in known.teasers.get(level, ())]
        for c, at in left or found:
            _texts(c, at, blocks)
        if blocks:
            return blocks
    node, at = root, ""
    for key in known.path[1:]:
        inner = [c for c in node.children if c.key == key and not c.out]
        if len(inner) != 1:
            break
        node, at = inner[0], f"{at}/{key}"
    blocks = []
    _texts(node, at, blocks)
    return blocks


def main_text(markup: str, known: Known | None = None) -> str:
    """The article's blocks, joined by line feeds. known: of the page's host."""
    known = known or Known()
    return "\n".join(t for p, t in _blocks(parse(markup), known) if not known.template or identity(p, t) not in known.template)


PARTIAL = "host string, part int, pages long, wrapper string, texts long, text long, n long"
WRAPPER = "host string, pages long, texts long, wrapper string"
#: A text is the template's from this share of a host's pages on, and from so many pages.
SHARE, LEAST = 0.9, 3


def _partials(pages: DataFrame) -> DataFrame:
    """Of each task: a row with the wrapper of each host, and a row for each text at its place with the number of pages that have it."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, found, counts = TaskContext.get().partitionId(), {}, {}
        for whole in batches:
            for at in range(0, whole.num_rows, common.SLICE):
                b = whole.slice(at, common.SLICE)
                for host, markup in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                    if markup:
                        root, blocks = parse(markup), []
                        _texts(root, "", blocks, 2)
                        counts.setdefault(host, Counter()).update({identity(p, t) for p, t in blocks})
                        _fold(found, host, 1, wrapper_of(root))
        for host in sorted(found):
            yield made([host], [part], [found[host][0]], [json.dumps(found[host][1])], [counts[host].total()], [None], [None])
            texts, ns = list(counts[host].keys()), list(counts[host].values())
            for at in range(0, len(texts), 10000):
                some = texts[at : at + 10000]
                none = [None] * len(some)
                yield made([host] * len(some), [part] * len(some), none, none, none, some, ns[at : at + 10000])

    def made(*columns: list) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        fields = [x.split() for x in PARTIAL.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])

    return common.arrow_map(pages.select("host", "html"), first, PARTIAL)


def _fold(found: dict[str, tuple[int, list]], host: str, n: int, w: list) -> None:
    if host in found:
        m, have = found[host]
        found[host] = (n + m, merge(have, w))
    else:
        found[host] = (n, w)


def _whole(partials: DataFrame) -> DataFrame:
    """host, pages (how many), texts (of all pages, each once a page), wrapper (JSON)."""

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r["host"], r["part"], r["pages"], r["texts"], r["wrapper"]) for b in batches for r in b.to_pylist())
        found: dict[str, tuple[int, list]] = {}
        texts: Counter = Counter()
        for host, _, n, k, w in got:
            _fold(found, host, n, json.loads(w))
            texts[host] += k
        hosts = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array([found[h][0] for h in hosts], pa.int64()), pa.array([texts[h] for h in hosts], pa.int64()), pa.array([json.dumps(found[h][1]) for h in hosts], pa.string())],
            names=["host", "pages", "texts", "wrapper"],
        )

    return common.arrow_map(partials.where("wrapper IS NOT NULL").select("host", "part", "pages", "texts", "wrapper").repartition("host"), second, WRAPPER)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, pages (how many), texts, wrapper (JSON). pages: host, html."""
    return _whole(_partials(pages))


def known_hosts(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON), template (identities of its texts). pages: host, html."""
    partials = common.staged(_partials(pages), "partials")
    whole = common.staged(_whole(partials), "wrappers")
    counts = partials.where("text IS NOT NULL").groupBy("host", "text").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    fixed = counts.join(whole.select("host", "pages", "texts"), "host").where(F.col("n") >= SHARE * F.col("pages"))
    # where all texts are the template's, the pages are equal and tell nothing
    template = fixed.groupBy("host", "texts").agg(F.sum("n").alias("n"), F.collect_list("text").alias("template")).where("n < texts").select("host", "template")
    return common.staged(whole.select("host", "wrapper").join(template, "host", "left"), "hosts")


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


TEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep's columns (default: all but html), text and n_chars. The wrappers are joined by host without a hint."""
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")] if keep is None else keep
    read = pages.select(*[F.col(f"`{c}`") for c in keep], F.col("html").cast("string").alias("_html"), host_of().alias("_host"))
    hosts = known_hosts(read.select(F.col("_host").alias("host"), F.col("_html").alias("html")))
    joined = read.join(hosts.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"), F.col("template").alias("_template")), "_host", "left")

    def compute():
        hosts: dict[str, Known] = {}

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            texts = []
            wrappers, templates = b.column("_wrapper"), b.column("_template")
            for k, (markup, host) in enumerate(zip(b.column("_html").to_pylist(), b.column("_host").to_pylist())):
                if host not in hosts:
                    if len(hosts) > 1000:
                        hosts.clear()
                    w = wrappers[k].as_py()
                    hosts[host] = Known(json.loads(w) if w else None, frozenset(templates[k].as_py() or ()))
                texts.append(main_text(markup or "", hosts[host]))
            return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]

        return f

    return common.with_results(joined, TEXT, compute, keep)


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), ["page_id", "url"])
