import math
import random

import numpy as np
import pytest

from vigil.llm import embedding_dedup, html
from vigil.llm.graph import components

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li>menu</li></ul></nav><div id="sidebar">side</div>
<main><div class="cookie-notice">cookies</div><article><header><h2>Head &eacute;</h2></header>
<p>One <i>two</i>
  three<br>four<p>five &lt;x&gt; &amp;amp;<ul><li>a<li>b</ul><form><input>f</form><script>var t="</p>";</script>
<div class="ad">buy</div><!-- gone --></article><section class="comments"><p>reader</p></section></main>
<footer>f</footer></body></html>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE) == "Head é One two three four five <x> &amp; a b"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("a < b & c <b>d", "a < b & c d"),
    ('<p title="a>b">q</p>', "q"), ("<div>x<script>var a='</p>'</script>y</div>", "x y".replace(" ", "")),
    ("<p>x</p><p>y", "x y"), ("<p>a&nbsp;b</p>", "a b"), ("<p class=x\">q</p>r", "q r"),
    ("<div class='wrap no-sidebar'><article><div class='post-header'><h1>H</h1></div><p>x</article></div>",
     "H x"), ("<article><header class='ad'>no</header><p>x</article>", "x"),
    ("<aside>no</aside><div role=navigation>no</div>yes", "yes"), ("<p>un<b>closed<p>next", "unclosed next")])
def test_small_pages(page, text):
    assert html.main_text(page) == text


def test_odd_pages_stay_linear():
    import time
    t = time.time()
    for page in ("<" * 200_000, "<a " * 100_000, "<div>" * 30_000 + "x", "<p>" * 20_000 + "</b>" * 20_000,
                 "<b>" * 20_000 + "<p>x" * 20_000, '<a "' * 50_000 + ">", "<!--" * 50_000):
        html.main_text(page)
    assert time.time() - t < 30


def site(n, frame="<div class='x17'>{}</div>"):
    rnd = random.Random(1)
    pages = []
    for i in range(n):
        body = " ".join(f"w{rnd.randrange(9999)}" for _ in range(30))
        pages.append((i, f"https://U@Site.org:80/p{i}", "<body>" + frame.format("All pages say this")
                      + f"<div class='main'><p>{body}</p></div></body>", body))
    return pages


def test_branch_that_all_pages_share_is_cut(spark):
    pages = site(12)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    got = {r.page_id: r for r in html.extract(df.repartition(3)).collect()}
    assert all(got[i].text == body and got[i].n_chars == len(body) for i, _, _, body in pages)
    # too few pages of a host: the tree says nothing
    few = {r.text for r in html.extract(df.limit(2)).collect()}
    assert all(t.startswith("All pages say this ") for t in few)


def test_copies_do_not_cut_their_own_article(spark):
    p = site(1)[0]
    df = spark.createDataFrame([(i, p[1], f"<body><article><p>{p[3]}</p></article></body>") for i in range(30)],
                               "page_id long, url string, html string")
    assert {r.text for r in html.extract(df).collect()} == {p[3]}


@pytest.mark.parametrize("page, text", [
    ("<main><h1>H</h1><p>body</p><article>teaser</article></main><article>other</article>", "H body teaser other"),
    ("<div><h1>H</h1><p>body</p></div><article>t1</article><article>t2</article>", "H body t1 t2"),
    ("<main><p>a</p></main><article><p>b</p></article><div class='comments'><article>c</article></div>", "a b"),
    ("<div class='sidebar'><article>a</article></div><p>b", "a b")])
def test_text_beside_articles_is_kept(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("attrs, kept", [
    ('style="overflow:hidden"', True), ('href="/hidden-gems"', True), ("title='the hidden truth'", True),
    ('data-id="ad-12"', True), ('href="/p?id=related"', True), ('href=/p?id=related', True),
    ('data-hidden="x" x-class=ad', True), ('title="class=ad id=ad"', True), ('data-x="a" hidden', False),
    ("HIDDEN=''", False), ("title='a'hidden", False), ('id = "ad"', False), ("aria-hidden=true", False),
    ("class=x class=ad", True), ("a= hidden", True), ('title="it\'s" id=ad', False)])
def test_attributes_are_read_whole(attrs, kept):
    assert html.main_text(f"<article><p>a</p><p {attrs}>b</p></article>") == ("a b" if kept else "a")


def test_tree_judges_the_whole_body(spark):
    frame = "<div class='x17'>{}</div><article><p class='c'>Read our offers</p>"
    pages = [(i, u, h.replace("</body>", "<p>see<br>more <b>not</b> here</p></article></body>"), t)
             for i, u, h, t in site(12, frame)]
    pages = [(i, u, h.replace("see", f"see{i}"), f"{t} see{i} more not here") for i, u, h, t in pages]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == {p[0]: p[3] for p in pages}


def test_copies_do_not_save_a_template(spark):
    pages = site(12)
    pages += [(100 + i, *pages[0][1:]) for i in range(30)]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == {p[0]: p[3] for p in pages}


def plain_noise(roots, low=html.LOW_IMPORTANCE):
    """The noisy paths of one host, by the formulas, on one machine."""
    def elements(e, path):
        kids = [x for x in e.items if isinstance(x, html.Element) and x.tag not in html._UNSEEN]
        yield path, e, kids
        for k in kids:
            yield from elements(k, (*path, k.label))
    on, styles, words, shares = {}, {}, {}, {}
    for i, root in enumerate(roots):
        for path, e, kids in elements(root, ()):
            on.setdefault(path, set()).add(i)
            kids = [k for k in kids if k.items or k.link]
            styles.setdefault(path, {}).setdefault(tuple(k.label for k in kids), set()).add(i)
            own = {w for x in e.items if isinstance(x, str) for w in x.split()} | ({e.link} - {""})
            for w in own:
                words.setdefault(path, {}).setdefault(w, set()).add(i)
            for name in [*[k.label for k in kids], *([None] if own else [])]:
                part = shares.setdefault(path, {})
                part[name] = part.get(name, 0) + 1 / (len(kids) + bool(own))
    kept = {p for p, s in on.items() if len(s) >= html.MIN_PAGES and len(s) >= html.MIN_SHARE * len(roots)}

    def content(p):
        m = len(set().union(*words[p].values()))
        return 1.0 if m < html.MIN_PAGES else 1 - sum(math.log(len(x)) / math.log(m)
                                                     for x in words[p].values()) / len(words[p])

    def judge(p):
        """(importance, noise) of a place."""
        if p not in kept:
            return 1.0, False
        if p not in shares:
            return 0.0, True
        parts = {k: (content(p), content(p) < low) if k is None else judge((*p, k)) for k in shares[p]}
        if set(parts) == {None}:
            return parts[None]
        n = [len(x) for x in styles[p].values()]
        h = -sum(x / sum(n) * math.log(x / sum(n)) for x in n) / math.log(len(on[p]))
        deep = html.GAMMA ** len(n)
        whole = sum(shares[p].values())
        imp = (1 - deep) * min(h, 1.0) + deep * sum(shares[p][k] / whole * parts[k][0] for k in parts)
        return imp, imp < low and all(x[1] for x in parts.values())
    return {p for p in kept if p and p in shares and judge(p)[1]}


def nameless_sites():
    """Ten hosts whose menus, notices and footers have no telling names and vary by page."""
    rnd = random.Random(5)
    for h in range(10):
        menu = [f"m{h}x{k}" for k in range(8)]
        notes = [f"note{h} {k} of this house" for k in range(3)]
        for i in range(12 + 4 * h):
            items = "".join(f"<li><a href='/{m}'>{m}</a></li>" for m in rnd.sample(menu, 5))
            body = [" ".join(f"w{rnd.randrange(99999)}" for _ in range(20)) for _ in range(rnd.randrange(1, 5))]
            yield (h * 100 + i, f"http://h{h}/{i}",
                   f"<body><div class='k1'><ul>{items}</ul></div><div class='k2'>{rnd.choice(notes)}</div>"
                   f"<div class='k3'>{''.join(f'<p>{b}</p>' for b in body)}</div>"
                   f"<div class='k4'>(c) h{h} all rights {2000 + i % 3}</div></body>", " ".join(body))


def test_nameless_templates_are_cut_by_their_importance(spark):
    pages = list(nameless_sites())
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    for names in (True, False):
        got = {r.page_id: r.text for r in html.extract(df.repartition(5), names=names).collect()}
        assert got == {p[0]: p[3] for p in pages}


def test_noisy_places_equal_a_plain_version(spark):
    rnd = random.Random(9)
    pages = [p[:3] for p in nameless_sites()]
    for i in range(60):                 # hosts with rare, shared and changing parts in all mixtures
        rows = "".join(f"<tr><td class=c{rnd.randrange(3)}>a{rnd.randrange(4)} b{rnd.randrange(60)}<td><img "
                       f"src=/i{rnd.randrange(2)}></tr>" for _ in range(rnd.randrange(4)))
        odd = f"<section>r{rnd.randrange(9)}<br></section>" if rnd.random() < .12 else "<hr><i></i>"
        pages.append((5000 + i, f"http://mixed{i % 2}/", f"<main>{i} <table>{rows}</table>{odd}</main>"
                                f"<p>s{rnd.randrange(2)} t{rnd.randrange(9)}</p>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for low in (0.2, html.LOW_IMPORTANCE, 0.7):
        want = {}
        for host in {html.host_of(p[1]) for p in pages}:
            roots = {html.text_of(r): r for r in (html.parse(p[2]) for p in pages if html.host_of(p[1]) == host)}
            keys = set()
            for path in plain_noise(list(roots.values()), low):
                at = html.Element("", None)
                for label in path:
                    at = html.Element("", at, label)
                keys.add(at.place)
            want[host] = sorted(keys)
        assert any(want.values())
        got = {r.host: r.places for r in html.low_importance(df, low=low).collect()}
        assert {h: got.get(h, []) for h in want} == want


def test_a_page_of_nothing_but_template_keeps_its_text(spark):
    rows = [(i, "http://h/", f"<body><h1>T{i}</h1><div>the same words on each page of the host</div></body>")
            for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == {
        i: f"T{i} the same words on each page of the host" for i in range(20)}


def test_odd_rows_of_pages(spark):
    rows = [(1, None, None), (2, "nonsense", ""), (None, "http://h/", "<p>x</p>"), (3, "http://h/", "<p>x</p>"),
            (3, "http://h/", "<p>x</p>")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows],
                               "page_id long, url string, html string, places string, host long")
    got = sorted(map(tuple, html.extract(df).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "nonsense", "", 0), (None, "http://h/", "x", 1),
                          (3, "http://h/", "x", 1), (3, "http://h/", "x", 1)], key=repr)
    assert html.extract(df.limit(0)).count() == 0


# -------------------------------------------------------------------- vectors
def plain_links(rows, threshold):
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        u = np.array(v, float)
        return u / np.linalg.norm(u)
    u = [None if r[2] is None else unit(r[1]) for r in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and u[i] is not None and u[j] is not None
             and rows[i][2] == rows[j][2] and len(u[i]) == len(u[j]) and u[i] @ u[j] >= threshold]
            for i in range(n)]
    comp = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([comp[i], *[comp[j] for j in link[i]]])
            changed |= low != comp[i]
            comp[i] = low
    return sorted((rows[i][0], len(link[i]), comp[i], comp[i] == rows[i][0]) for i in range(n))


def vectors():
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(25):
            c = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 6))):
                rows.append((k, (c + rng.normal(size=8) * 0.12).tolist(), label))
                k += 1
    same = [1.0, 2.0] + [0.0] * 6
    rows += [(k + i, same, 1) for i in range(40)] + [(k + 40, [2 * x for x in same], 1)]
    k += 41
    rows += [(k, None, 1), (k + 1, [0.0] * 8, 1), (k + 2, [1.0, float("nan")] + [0.0] * 6, 1),
             (k + 3, [1.0, None] + [0.0] * 6, 1), (k + 4, same, None), (k + 5, [], 1), (k + 6, [1.0, 2.0], 1),
             (k + 7, [1.0, 2.0], 1), (k + 8, [float("inf")] * 8, 1)]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_like_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, n long, key string")
    got = sorted(map(tuple, embedding_dedup.embedding_links(df.repartition(4)).collect()))
    assert got == plain_links(rows, 0.98)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.embedding_links(df).count() == 0
    df = spark.createDataFrame([(1, None, 1), (2, [1.0], None)], df.schema)
    assert sorted(map(tuple, embedding_dedup.embedding_links(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


# ---------------------------------------------------------------------- graph
@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)],
    [(50 - i, 49 - i) for i in range(40)] + [(100, 99), (99, 98), (7, 7)]])
def test_components(spark, edges):
    at = {}
    for a, b in edges:
        if a != b:
            at.setdefault(a, a)
            at.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and at[a] != at[b]:
                at[a] = at[b] = min(at[a], at[b])
                changed = True
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == at and len(got) == len(at)
