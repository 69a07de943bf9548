import pytest

from streamlab.llm import html_text as H


def text(html):
    return "\n".join(t for _, t in H.Page(html).main_blocks())


@pytest.mark.parametrize(
    "html,want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><h1>T</h1><p><b>one<br>two<br><p>three</article><footer>f</footer>", "T\none two\nthree"),
        ("<nav>m</nav><div>a <span class='ad'>x</span>b<button>k</button> c</div><aside>s</aside>", "a b c"),
        ("<body><header>site</header><main><header><h1>T</h1></header>x</main></body>", "T\nx"),
        ("<article>x<section id='comments'><p>bad</p></section><form>f</form></article>", "x"),
        ("<script>var t='</p>';</script><style>p{}</style><p>ok &copy; &#233;&nbsp;z</p>", "ok © é z"),
        ("<div class='cookie-notice'>c</div><div class='has-ads'>kept</div><div class='top-menu'>m</div>", "kept"),
        ("<ul><li>a<li>b</ul>t<table><tr><td>1<td>2</table>", "a\nb\nt\n1\n2"),
        ("<p>unclosed <i>tags", "unclosed tags"),
        ("<article class='social-science'><p>Social science is a field</p></article>", "Social science is a field"),
        ("<p>intro</p><div class='related-work'>Related work is long</div>", "intro\nRelated work is long"),
        ("<p>Hello <svg/> world</p><p>x<svg><path d='m'/><g>no</g></svg>y</p>", "Hello world\nxy"),
        ("<article class='teaser'>Read this</article><p>The text itself is much longer than a teaser</p>", "Read this\nThe text itself is much longer than a teaser"),
        ("<p>a</p><div class='widget'><p>all of the text stands in here</p><p class='share-buttons'>s</p></div>", "a\nall of the text stands in here"),
        ("<p>some text of the page</p><ul class='commentList'><li>c</ul><div id='sideBar-2'>s</div><i class='js-ad'>x</i>", "some text of the page"),
        ("<div class='ad'>An advert that is longer than the article</div><article><p>Short</p></article>", "Short"),
        ("<!-- c --><p hidden>h</p><div role='navigation'>n</div><p>x</p></div></p>", "x"),
    ],
)
def test_blocks(html, want):
    assert text(html) == want


def pages(spark):
    rows = []
    for k in range(30):
        rows.append((k, f"http://a.example/{k}", f"<div class='lead'>Read us daily</div><p>Article {k} tells of {k * k}</p><div class='legal'>All rights reserved</div>"))
    rows += [(100, "http://b.example/1", "<p>Read us daily</p>"), (101, None, "<p>no url</p>"), (102, "http://a.example/x", None), (103, "http://a.example/y", "")]
    rows += [(0, rows[0][1], rows[0][2])] * 3
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string"), rows


@pytest.mark.parametrize("small", [H.SMALL_SET, -1])
def test_template_branches_go(spark, small):
    df, rows = pages(spark)
    got = [(r.page_id, r.text) for r in H.extract(df, small_set=small).collect()]
    assert len(got) == len(rows)
    by_id = dict(got)
    assert all(by_id[k] == f"Article {k} tells of {k * k}" for k in range(30))
    assert by_id[100] == "Read us daily" and by_id[101] == "no url" and by_id[102] == "" == by_id[103]
    assert H.extract(df.limit(0)).count() == 0


def test_equal_pages_are_no_template(spark):
    rows = [(k, "http://c.example/", "<p>one article</p><p>on many pages</p>") for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in H.extract(df).collect()} == {"one article\non many pages"}


def test_host():
    assert [H.host(u) for u in ("HTTP://U@Www.X.org:80/a?b", "x", None, "https://y.com#z")] == ["www.x.org", "", "", "y.com"]


def test_long_and_deep_pages():
    deep = "<div>" * 800 + "x" + "</div>" * 800
    assert text(deep) == "x" and text("<p>" + "word " * 100_000) == ("word " * 100_000).strip()


@pytest.mark.parametrize("small", [H.SMALL_SET, -1])
def test_near_copies_and_unique_texts_stay(spark, small):
    article = "<p>" + "A report of some length on the harbour and its ships. " * 4 + "</p>"
    legal = "<div class='legal'>All rights reserved</div>"
    said = (article[3:-4]).strip()
    rows = []
    # few pages, one article: a date, or an entry of the menu, differs
    rows += [(k, f"http://few.example/{k}", f"<div class='date'>{k} May</div>{article}") for k in range(6)]
    rows += [(k, f"http://menu.example/{k}", f"<nav>entry {k}</nav>{article}{legal}") for k in range(10, 16)]
    # 90 near copies of one article beside 10 other pages
    rows += [(k, f"http://many.example/{k}", f"<div class='date'>day {k}</div>{article}{legal}") for k in range(100, 190)]
    rows += [(k, f"http://many.example/{k}", f"<p>Page {k} tells of something else, {k * k} times over</p>{legal}") for k in range(190, 200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df, small_set=small).collect()}
    assert all(got[k] == f"{k} May\n{said}" for k in range(6))
    assert all(said in got[k] for k in range(10, 16))
    assert all(got[k] == f"day {k}\n{said}" for k in range(100, 190))
    assert all(got[k] == f"Page {k} tells of something else, {k * k} times over" for k in range(190, 200))


def test_few_pages_and_much_boilerplate(spark):
    """A host of three pages loses its menu; boilerplate over four fifths of the pages goes as well."""
    menu, rows = "<ul class='top'><li>Home</li><li>About us</li><li>Contact</li></ul>", []
    rows += [(k, f"http://three.example/{k}", f"{menu}<p>Page {k} has some eight or nine words of its own, {k}</p>") for k in range(3)]
    legal = "<div class='legal'>" + "The small print of this site goes on and on, as it does on every page. " * 12 + "</div>"
    rows += [(k, f"http://legal.example/{k}", f"<p>Number {k} is a short note of ten words or so, {k * k}</p>{legal}") for k in range(100, 140)]
    rows += [(k, f"http://two.example/{k}", f"{menu}<p>Two pages of {k} are too few to tell a menu from text</p>") for k in (200, 201)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, _items int, __page int")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(got[k] == f"Page {k} has some eight or nine words of its own, {k}" for k in range(3))
    assert all(got[k] == f"Number {k} is a short note of ten words or so, {k * k}" for k in range(100, 140))
    assert got[200] == "Home\nAbout us\nContact\nTwo pages of 200 are too few to tell a menu from text"


def brute_template(pages):
    """The rule of the tree with dictionaries, one page after the other."""
    import math
    from collections import Counter, defaultdict

    sites = defaultdict(dict)
    for url, html in pages:
        parsed = H.Page(html)
        blocks = parsed.main_blocks()
        sites[H.host(url)].setdefault(tuple(blocks), []).append(parsed.children)
    gone = set()
    for site, found in sites.items():
        contents, styles, holds = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set)), defaultdict(set)
        for k, (blocks, children) in enumerate(found.items()):
            for path, text in blocks:
                contents[path][text].add(k)
                holds[path].add(k)
            for n, tree in enumerate({str(c): c for c in children}.values()):
                for path, style in tree.items():
                    styles[path][tuple(style)].add((k, str(sorted(tree.items()))))
        low = {}
        for path, texts in contents.items():
            n = len(holds[path])
            if n >= H.LEAST_PAGES:
                ks = [len(v) for v in texts.values()]
                content = 1 - sum(k * math.log(k) for k in ks) / sum(ks) / math.log(n)
                style = [len(v) for v in styles[path.rpartition("/")[0]].values()]
                m = sum(style)
                shown = (math.log(m) - sum(k * math.log(k) for k in style) / m) / math.log(m) if m > 1 else (1.0 if m else 0.0)
                if H.CONTENT_SHARE * content + (1 - H.CONTENT_SHARE) * shown < H.LOW:
                    low[path] = {t: v for t, v in texts.items() if len(v) >= H.LEAST_PAGES}
        size, total = Counter(), {k: sum(len(t.split()) for _, t in set(blocks)) for k, blocks in enumerate(found)}
        for path, texts in low.items():
            for t, ks in texts.items():
                for k in ks:
                    size[k] += len(t.split())
        for path, texts in low.items():
            for t, ks in texts.items():
                own = [total[k] - size[k] for k in ks]
                if sum(w >= H.OWN_WORDS or w >= H.OWN_SHARE * total[k] for w, k in zip(own, ks)) >= H.LEAST_PAGES:
                    gone.add((site, path, t))
    return gone


def test_tree_equals_the_rule_page_by_page(spark):
    import random

    rnd, rows = random.Random(4), []
    for k in range(160):
        site = rnd.choice(["a.example", "b.example", "c.example", "d.example"])
        parts = [f"<div class='lead'>{'Read us' if rnd.random() < 0.97 else 'Join us'}</div>"] * (rnd.random() < 0.8)
        parts += [f"<section><p>{' '.join(rnd.choice('abcdefgh') * 3 for _ in range(rnd.randrange(14)))}</p></section>" for _ in range(rnd.randrange(4))]
        parts += [f"<div class='legal'>All rights {'reserved' if rnd.random() < 0.95 else 'kept'}</div>"]
        rows.append((k, f"http://{site}/{k}", "".join(parts)))
    gone = brute_template([r[1:] for r in rows])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    for k, url, html in rows:
        assert got[k] == "\n".join(t for p, t in H.Page(html).main_blocks() if (H.host(url), p, t) not in gone)
    assert len(gone) > 3
