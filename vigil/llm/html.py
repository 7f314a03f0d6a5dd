"""Main text of web pages by a site style tree.

The DOMs of one host merge: an element's place is its path of presentation
(tag with class and id) from the root.  The tree counts, for every place, how its
child sequences (presentation styles) vary and on how many pages each single
content feature (word, link, image) of its own stands.  m is the number of pages
that have a place; every page counts a style or feature of a place once.

* content importance of a place: 1 - mean over its features of log_m(pages of the
  feature): 0 if all pages say the same, near 1 if each says something else;
* style importance: entropy of its child sequences to the base m;
* composite importance, from the leaves up: a leaf has its content importance; else,
  with l child sequences, (1 - GAMMA^l) * style importance + GAMMA^l * mean importance
  of its children and own texts, weighted by their share of the sequences.

A branch is noise, and cut from each page, if it and all below it stay under
``LOW_IMPORTANCE``, wherever it stands; all other text of the body is kept, inside
``<article>`` and ``<main>`` or not.  These tags only keep headlines below them, and a
noisy-named frame that holds all of a page's articles.  Elements that by their
name carry no article (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, comments) go as well, which also serves hosts with few pages
and templates whose words change from page to page.  A page of which the tree would
leave no words but headlines is judged by names alone.

Pages of a host with the same main text count once, so that copies do not make
an article look like a template.  The counts are summed in each task before they
are dealt out, so a host with a third of all pages sends one row per place,
style and feature from each task.  Places on less than ``MIN_SHARE`` of a host's
pages, or on under ``MIN_PAGES`` of them, count as important, as do rare features;
a host therefore keeps at most (elements of a page / MIN_SHARE) places, however many
pages it has, and these are combined in one task.

Defined cases: null or empty html gives an empty text; a null url or one
without a host belongs to the host ''; hosts of under ``MIN_PAGES`` different
main texts are judged by element names alone; repeated rows each give their row, an
empty table none; columns beyond the three asked for stay out, whatever their names.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.frames import freeze, same, small_batches
from vigil.llm.tokens import CHUNK_BYTES

MIN_PAGES, MIN_SHARE, LOW_IMPORTANCE, GAMMA = 5, 0.1, 0.4, 0.9
PAGES, STYLE, TEXTS, ABOVE, BELOW, OWN, WORDS, REGISTER = range(8)     # kinds, see features
REGISTERS = 64             # of the sketch that bounds a place's different content features
SUMMED_AT_ONCE = 1 << 19   # content features that a task sums in one table
UNIT = 1 << 20             # a whole share of a child sequence, as an integer
SMALL_TABLE = 8 << 20      # bytes of cut places up to which they are broadcast

# fixed values of HTML
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl "
                   "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li "
                   "main nav ol option p pre section summary table tbody td tfoot th thead title "
                   "tr ul".split())
_NO_TEXT = frozenset("script style noscript template head title iframe object svg math canvas select "
                     "button textarea form input nav footer aside dialog menu".split())
# raw or invisible content, no part of the tree
_UNSEEN = frozenset("script style noscript template head title iframe object svg math canvas "
                    "select textarea".split())
_ARTICLE = frozenset("article main".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_FRAME = frozenset("div section ul ol dl table figure details span".split())   # cut by the tree
# an opening tag of the first kind closes an open element of the second kind
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSE_P = _BLOCK - {"br", "p", "html", "body", "title", "option", "caption"}
# names of elements that hold no article text
_NOISE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs "
                   "comment comments consent cookie cookies disqus footer gdpr header menu modal nav "
                   "navbar navigation newsletter notice notices pagination pager paywall popup promo "
                   "promoted related replies reply respond share sharing sidebar skip social sponsor "
                   "sponsored subscribe toolbar widget widgets".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert "
                         "menu menubar".split())
# attributes: quoted values may hold any sign; failing that, all up to the next bracket
_ATTRS = r"""(?:(?:[^<>"']++|"[^"]*+"|'[^']*+')*+(?=>)|[^<>]*+)"""
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>?"
                    rf"|<(script|style|textarea|noscript|template)\b{_ATTRS}>.*?(?:</\1\s*>|\Z)"
                    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({_ATTRS})>", re.S | re.I)
# one attribute after the other: whole name, value
_ATTR = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_ASKED = frozenset("class id role aria-hidden hidden href src".split())
_WORD = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "parent", "label", "place", "noise", "link", "items")

    def __init__(self, tag, parent, label="", noise=False, link=""):
        self.tag, self.parent, self.label, self.noise, self.link = tag, parent, label, noise, link
        # the hash of the labels from the root; never 0, which stands for the page
        self.place = _key(label, parent.place) or 1 if parent else 0
        self.items: list = []           # texts and elements in page order


def parse(page: str) -> Element:
    """A tolerant DOM: unclosed and stray tags never lose text."""
    root = at = Element("", None)
    opened: Counter = Counter()     # open elements by tag
    pos = 0
    for m in _TOKEN.finditer(page):
        if m.start() > pos:
            at.items.append(page[pos:m.start()])
        pos = m.end()
        if m.group(0).startswith("<![CDATA["):
            at.items.append(_html.escape(m.group(0)[9:].removesuffix("]]>")))
        if not m.group(3):
            continue
        tag = m.group(3).lower()
        if m.group(2):
            while opened[tag]:
                opened[at.tag] -= 1
                at, closed = at.parent, at.tag
                if closed == tag:
                    break
            continue
        closes = _CLOSES.get(tag) or ({"p"} if tag in _CLOSE_P else ())
        if any(opened[x] for x in closes):
            node = at
            while node.parent and node.tag not in closes and node.tag not in _BLOCK:
                node = node.parent
            while node.tag in closes and at is not node.parent:
                opened[at.tag] -= 1
                at = at.parent
        child = Element(tag, at, *_present(tag, m.group(4)))
        at.items.append(child)
        if tag not in _VOID and not m.group(4).rstrip().endswith("/"):
            opened[tag] += 1
            at = child
    if pos < len(page):
        at.items.append(page[pos:])
    return root


def _present(tag: str, attrs: str) -> tuple[str, bool, str]:
    """The presentation label of an element, whether its names speak of noise, its link."""
    noise = tag in _NO_TEXT
    if not attrs.strip():
        return tag, noise, ""
    found = {}
    for k, v in _ATTR.findall(attrs):
        if k.lower() in _ASKED:
            found.setdefault(k.lower(), v.strip("\"'").lower())
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    label = tag + "".join(f".{x}" for x in sorted(set(names.split())))
    if tag not in _ARTICLE and tag not in ("html", "body") and tag not in _HEADING:
        noise = noise or bool(_NOISE.intersection(_WORD.findall(names))) \
            or found.get("role") in _NOISE_ROLES
    return label, noise or "hidden" in found or found.get("aria-hidden") == "true", \
        found.get("href") or found.get("src") or ""


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


def _elements(node: Element) -> Iterator[Element]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(x for x in node.items if isinstance(x, Element))


def features(root: Element) -> tuple[Counter, dict[int, set]]:
    """The counts of a page by (place, kind, feature), and the content features of its places.

    PAGES: the place is on the page (place 0 is the whole page); STYLE: one of its child
    sequences; TEXTS: it has content features of its own; ABOVE: its shares of the child
    sequences of the place above, named by the feature; BELOW: all shares of its own
    child sequences; OWN: those of its own content among them; WORDS: its content features.
    """
    counts: Counter = Counter({(0, PAGES, 0): 1})
    words: dict[int, set] = {}
    stack = [root]
    while stack:
        e = stack.pop()
        children = [x for x in e.items if isinstance(x, Element) and x.tag not in _UNSEEN]
        stack.extend(children)
        own = {w for x in e.items if isinstance(x, str) for w in x.split()}
        if e.link:
            own.add(e.link)
        if own:
            words.setdefault(e.place, set()).update(own)
            counts[e.place, TEXTS, 0] = 1
        counts[e.place, PAGES, 0] = 1
        # what holds nothing, like a break, is no part of a sequence
        children = [x for x in children if x.items or x.link]
        counts[e.place, STYLE, _key("|".join(x.label for x in children))] = 1
        n = len(children) + bool(own)
        if not n:
            continue
        for x in children:
            counts[x.place, ABOVE, e.place] += UNIT // n
        counts[e.place, BELOW, 0] += n * (UNIT // n)
        if own:
            counts[e.place, OWN, 0] += UNIT // n
    counts.update({(place, WORDS, 0): len(own) for place, own in words.items()})
    return counts, words


_ROW = 7       # place, place above, style, ABOVE, BELOW, OWN, WORDS; -1 words: one more style


def _packed(counts: Counter) -> list[int]:
    """The counts of a page, one row for each place and style, after one another."""
    places: dict[int, list] = {}
    for (place, kind, feature), n in sorted(counts.items()):
        row = places.setdefault(place, [0, [], 0, 0, 0, 0])
        if kind == STYLE:
            row[1].append(feature)
        elif kind == ABOVE:
            row[0], row[2] = feature, n
        elif kind >= BELOW:
            row[kind - 1] = n
    flat = []
    for place, (parent, styles, above, below, own, words) in places.items():
        flat += [place, parent, styles[0], above, below, own, words]
        for style in styles[1:]:
            flat += [place, 0, style, 0, 0, 0, -1]
    return flat


def page_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, text, page, seen, words): hashes of the main text and of the page; its counts,
    packed; 32-bit hashes of the content features of its places, in their order, as many for
    each as its WORDS count says."""
    word = xxhash.xxh32_intdigest
    for b in tokens.chunks(batches, "html", 4 * CHUNK_BYTES):
        rows: list[list] = [[], [], [], [], []]
        for url, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            root = parse(page or "")
            counts, words = features(root)
            own = np.array([word(w) for place in sorted(words) for w in words[place]], np.uint32)
            for column, x in zip(rows, (host_of(url), _key(text_of(root)), _key(page or ""),
                                        _packed(counts), own.view(np.int32))):
                column.append(x)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(
            rows, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())))],
            names=["host", "text", "page", "seen", "words"])


def _groups(b: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Some pages of a batch at once: (row, packed counts, words, places asked for)."""
    pages, size = [], 0
    asked = b.column(3) if b.num_columns > 3 else [None] * b.num_rows
    for i, (seen, words, places) in enumerate(zip(b.column(1), b.column(2), asked)):
        w = words.values.to_numpy().view(np.uint32).astype(np.int64)
        pages.append((i, seen.values.to_numpy().reshape(-1, _ROW), w, places))
        size += len(w)
        if size > SUMMED_AT_ONCE:
            yield pages
            pages, size = [], 0
    if pages:
        yield pages


def _summed(hosts: pa.Array, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """One row for each kind and feature of a place from (row of the host, place, kind,
    feature, n) columns: sums, and maxima of sketch registers."""
    columns = [np.concatenate([np.broadcast_to(p[k], p[0].shape) for p in parts]) for k in range(5)]
    keys = ["host", "place", "kind", "feature"]
    t = pa.table([hosts.take(pa.array(columns[0])), *[pa.array(c) for c in columns[1:]]], names=[*keys, "n"])
    g = t.group_by(keys).aggregate([("n", "sum"), ("n", "max")])
    n = pc.if_else(pc.equal(g["kind"], REGISTER), g["n_max"], g["n_sum"])
    yield from g.select(keys).append_column("n", n).combine_chunks().to_batches(max_chunksize=1 << 16)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, kind, feature, n): the counts of the pages, summed for some pages at once,
    and REGISTER rows, the register and its rank, of a sketch of each place's features."""
    for b in batches:
        for pages in _groups(b):
            at = np.repeat([i for i, *_ in pages], [len(x) for _, x, *_ in pages])
            x = np.concatenate([x for _, x, *_ in pages])
            word = np.concatenate([w for _, _, w, _ in pages])
            first, own = x[:, 6] >= 0, x[:, 6] > 0
            rank = 33 - REGISTERS.bit_length() + 1 - np.frexp((word // REGISTERS).astype(np.float64))[1]
            parts = [(at, x[:, 0], STYLE, x[:, 2], 1), (at[first], x[first, 0], PAGES, 0, 1),
                     (at[own], x[own, 0], TEXTS, 0, 1)]
            for kind, k in ((ABOVE, 3), (BELOW, 4), (OWN, 5), (WORDS, 6)):
                some = x[:, k] > 0
                parts.append((at[some], x[some, 0], kind, x[some, 1] if kind == ABOVE else 0, x[some, k]))
            n = x[own, 6]
            parts.append((np.repeat(at[own], n), np.repeat(x[own, 0], n), REGISTER, word % REGISTERS,
                          rank.astype(np.int64)))
            yield from _summed(b.column(0), parts)


def _asked_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, kind, feature, n): pages by content feature, at the places asked for."""
    for b in batches:
        for pages in _groups(b):
            parts = []
            for i, x, word, places in pages:
                x = x[x[:, 6] > 0]
                of = np.repeat(x[:, 0], x[:, 6])
                hit = np.repeat(np.isin(x[:, 0], places.values.to_numpy()), x[:, 6])
                parts.append((np.full(int(hit.sum()), i), of[hit], WORDS, word[hit], 1))
            yield from _summed(b.column(0), parts)


def _key(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text, seed & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def _noise_places(low: float):
    """The places of a host whose branches are noise: importances from the leaves up."""
    def run(site: pd.DataFrame) -> pd.DataFrame:
        rows = {r.place: r for r in site.itertuples(index=False)}
        children: dict[int, list] = {}
        for r in rows.values():
            children.setdefault(r.parent, []).append(r)
        order, stack = [], [0]
        while stack:
            at = stack.pop()
            order.append(at)
            stack.extend(r.place for r in children.get(at, ()))
        importance: dict[int, float] = {}
        noise: dict[int, bool] = {}
        for at in reversed(order):
            r, kids = rows.get(at), children.get(at, [])
            if r is None or not r.below:
                importance[at], noise[at] = 0.0, r is not None
                continue
            known = sum(k.above for k in kids) + r.own
            inner = sum(k.above * importance[k.place] for k in kids) + r.own * r.content \
                + (r.below - known)               # rare children are important
            if r.own == r.below:
                importance[at] = r.content
            else:
                deep = GAMMA ** r.styles
                importance[at] = (1 - deep) * r.style + deep * inner / r.below
            noise[at] = round(importance[at], 6) < low and r.below == known \
                and (not r.own or round(r.content, 6) < low) and all(noise[k.place] for k in kids)
        found = sorted(p for p in order if p and noise[p] and rows[p].below)
        return pd.DataFrame({"host": [site["host"].iloc[0]], "places": [found]})
    return run


def low_importance(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
                   low: float = LOW_IMPORTANCE) -> DataFrame:
    """(host, places): the places of each host whose branches are noise.

    As the logarithm is concave, the content importance of a place is at least
    1 - log_m(T / D), T its content features on all pages, D the different ones.  D comes
    from a sketch, halved to be safe (an error of 13 % on average); places that are
    important by this bound, like most articles, need no counts of their words, and
    neither they nor a place above them is noise.  The others' words are counted.
    """
    rows = "host string, place long, kind long, feature long, n long"
    src = pages.select(F.lit(0).alias("page_id"), F.col("url").cast("string"),
                       F.col("html").cast("string"))
    # one page for each main text of a host; read twice below: parse the pages once
    different = freeze(
        src.mapInArrow(page_features, "host string, text long, page long, seen array<long>, words array<int>")
        .groupBy("host", "text").agg(F.min(F.struct("page", "seen", "words")).alias("one"))
        .select("host", "one.seen", "one.words"), "different")
    counted = different.mapInArrow(_sums, rows).groupBy("host", "place", "kind", "feature").agg(
        F.when(F.col("kind") == REGISTER, F.max("n")).otherwise(F.sum("n")).alias("n"))
    kind = lambda k: F.when(F.col("kind") == k, F.col("n"))
    total = lambda k: F.coalesce(F.sum(kind(k)), F.lit(0))
    per_place = freeze(counted.groupBy("host", "place").agg(
        total(PAGES).alias("pages"), total(TEXTS).alias("texts"), total(WORDS).alias("words"),
        F.count(kind(STYLE)).alias("styles"), total(STYLE).alias("seqs"),
        F.sum(kind(STYLE) * F.log("n")).alias("nlogn"),
        F.count(kind(REGISTER)).alias("full"), F.sum(F.pow(F.lit(2.0), -kind(REGISTER))).alias("ranks"),
        F.max(F.when(F.col("kind") == ABOVE, F.col("feature"))).alias("parent"),
        total(ABOVE).alias("above"), total(BELOW).alias("below"), total(OWN).alias("own")), "places")
    hosts = per_place.where("place = 0").select("host", F.col("pages").alias("host_pages")) \
        .where(F.col("host_pages") >= min_pages)
    empty = REGISTERS - F.col("full")
    many = 0.709 * REGISTERS * REGISTERS / (F.col("ranks") + empty)
    few = F.when(empty > 0, REGISTERS * F.log(REGISTERS / empty))
    entropy = F.least(F.lit(1.0), (F.log("seqs") - F.col("nlogn") / F.col("seqs")) / F.log("pages"))
    kept = per_place.where((F.col("place") != 0) & (F.col("pages") >= min_pages)) \
        .join(hosts, "host").where(F.col("pages") >= min_share * F.col("host_pages")) \
        .withColumn("content", F.when(F.col("texts") < min_pages, 1.0).otherwise(
            1 - F.log(2 * F.col("words") / F.least(many, few)) / F.log("texts")))
    open_ = kept.where((F.col("content") < low) & (F.col("own") > 0))
    asked = _small(freeze(open_.groupBy("host").agg(F.collect_list("place").alias("places")), "asked"))
    words = different.join(asked, "host").select("host", "seen", "words", "places") \
        .mapInArrow(_asked_words, rows).groupBy("host", "place", "feature").agg(F.sum("n").alias("n")) \
        .groupBy("host", "place").agg(F.avg(F.log("n")).alias("mean"))
    site = kept.join(words, ["host", "place"], "left").select(
        "host", "place", F.coalesce("parent", F.lit(0)).alias("parent"), "above", "below", "own", "styles",
        entropy.alias("style"), F.coalesce(1 - F.col("mean") / F.log("texts"), "content").alias("content"))
    return site.groupBy("host").applyInPandas(_noise_places(low), "host string, places array<long>")


def _small(places: DataFrame) -> DataFrame:
    """A table (host, places), marked for broadcast if its counted places are few."""
    n = places.agg(F.sum(F.size("places"))).first()[0] or 0
    return F.broadcast(places) if 8 * n <= SMALL_TABLE else places


def _entered(root: Element) -> set[int]:
    """Elements of noisy names on the way to the page's articles (or mains), if all of
    these stand in such elements: a frame may be named after what it lacks."""
    stack, found = [(root, False)], []
    while stack:
        node, noisy = stack.pop()
        if node.tag in _ARTICLE:
            if not noisy:
                return set()
            found.append(node)
            continue
        stack.extend((x, noisy or x.noise) for x in node.items
                     if isinstance(x, Element) and x.tag not in _NO_TEXT)
    out: set[int] = set()
    for node in found:
        while node and id(node) not in out:
            out.add(id(node))
            node = node.parent
    return out


def main_text(page: str | None, cut: frozenset = frozenset(), names: bool = True) -> str:
    """The article text of a page; ``cut`` holds keys of places to leave out."""
    return text_of(parse(page), cut, names) if page else ""


def text_of(root: Element, cut: frozenset = frozenset(), names: bool = True) -> str:
    """The text of all branches but the noisy ones; ``names`` says whether names count."""
    parts: list[str] = []
    words = False                       # beside headlines
    entered = _entered(root)
    worded: dict[int, bool] = {}        # elements with words of their own
    stack: list = [(root, False, False)]
    while stack:
        node, in_article, closing = stack.pop()
        if isinstance(node, str):
            parts.append(_html.unescape(node) if "&" in node else node)
            continue
        if closing:
            parts.append(" ")
            continue
        if node.tag in _UNSEEN or names and id(node) not in entered and _named_noise(node, in_article):
            continue
        if node.place in cut and _branch(node, in_article, worded):
            parts.append(" ")
            continue
        if node.tag in _BLOCK:
            parts.append(" ")
            stack.append((node, in_article, True))
        if node.tag not in _HEADING:
            words = words or any(isinstance(x, str) and not x.isspace() for x in node.items)
        in_article = in_article or node.tag in _ARTICLE
        stack.extend((x, in_article, False) for x in reversed(node.items))
    if cut and not words:
        return text_of(root, names=names)
    return _SPACE.sub(" ", "".join(parts)).strip()


def _named_noise(e: Element, in_article: bool) -> bool:
    # a header with the article's own headline stays
    return (e.tag == "header" or e.noise) and not (
        in_article and "header" in e.label and any(x.tag in _HEADING for x in _elements(e)))


def _branch(e: Element, in_article: bool, worded: dict[int, bool]) -> bool:
    """Whether the style tree may cut an element: not a break, not an article's headline,
    and not words inside a sentence."""
    if e.tag in _VOID or not e.parent or (in_article and e.tag in _HEADING):
        return False
    if e.tag in _BLOCK or e.tag in _FRAME:
        return True
    k = id(e.parent)
    if k not in worded:
        worded[k] = any(isinstance(x, str) and x.strip() for x in e.parent.items)
    return not worded[k]


def extract(pages: DataFrame, names: bool = True, **options) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html); without
    ``names`` the style tree alone decides."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"),
                       F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    small_batches(pages.sparkSession)
    noise = _small(freeze(low_importance(pages, **options).where("size(places) > 0"), "style-tree"))
    host = F.lower(F.regexp_extract("url", _HOST.pattern, 1))
    keyed = src.withColumn("host", F.coalesce(host, F.lit("")))
    joined = keyed.join(noise.withColumnRenamed("host", "_host"),
                        same(F.col("host"), F.col("_host")), "left") \
        .select("page_id", "url", "html", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple, frozenset] = {}
        for b in tokens.chunks(batches, "html", 4 * CHUNK_BYTES):
            texts = []
            for page, places in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                k = tuple(places or ())
                if k not in sets:
                    if len(sets) > 256:
                        sets.clear()
                    sets[k] = frozenset(k)
                texts.append(main_text(page, sets[k], names))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")

