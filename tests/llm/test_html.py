import random

import pytest

from amity.llm.html import extract, main_blocks, parse, style_tree


def text(page):
    return "\n".join(main_blocks(parse(page)[0]))


@pytest.mark.parametrize(("page", "want"), [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a\n b&nbsp;c<p>d<br>e</p>f", "a b c\nd e\nf"),
    ('<nav><a href=x>m</a></nav><article><h1>T</h1><p><b>one.<br><p>two &lt;3</article><footer>f</footer>', "T\none.\ntwo <3"),
    ('<body><script>var t="</p>";</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></body>', "yes"),
    ('<article><p>x</p><div class="ad">buy</div><section id="reader-comments"><article>c</article></section><p>y</article>', "x\ny"),
    ('<header>h</header><main><header><h2>t</h2></header><p>m</p><aside>s</aside><form>f<input></form></main>', "t\nm"),
    ('<div id="content"><ul><li>one<li>two</ul></div><div class="side-bar sidebar">s</div>', "one\ntwo"),
    ('<article><table><tr><td>a<td>b<tr><td>c</table><p hidden>h</p><p style="display: none">h</article>', "a\nb\nc"),
    ("<article>1 < 2 and 3 > 2 &copy; &#233; &#x1F600; &am</article><p", "1 < 2 and 3 > 2 © é \U0001f600 &am"),
    ('<article><a title="x > y">t</a> <i>i</i><img alt="no">z</article>', "t iz"),
    ('<article><p class="unclosed>a</p><p>b</p></article>', "a\nb"),
    ('<div class="layout has-sidebar"><article><p>a</p></article><div class="sidebar">s</div></div>', "a"),
    ('<div class="page-sidebar"><article><p>a</p></article></div>', "a"),
    ('<form id="aspnetForm"><nav>n</nav><article><p>a</p><form>f</form></article></form>', "a"),
    ('<article class="post no-comments"><p>a</p></article>', "a"),
    ('<main><p>The long main text.</p></main><article class="card">teaser</article>', "The long main text."),
    ('<main><p>in</p><article>the article is longer</article></main>', "the article is longer"),
    ('<article>a</article><section class="comments"><article>a longer comment</article></section>', "a"),
    ("<p>p</p><form><p>f</p></form>", "p"),
    ("<article><p>a</p></div></span><p>b</article></article>tail", "a\nb"),
])
def test_pages(page, want):
    assert text(page) == want


def test_style_tree_drops_what_a_site_repeats(spark):
    rows = []
    for host in ("a.org", "b.org"):
        for i in range(12):
            shared = "The same box on all pages." if host == "a.org" else f"Box {i} of its own."
            body = "".join(f"<p>text {host} {i} {j}</p>" for j in range(1 + i % 3)) + "<p>A line that all have.</p>"
            rows.append((i, f"http://{host}/{i}", f'<article>{body}<div class="x1">{shared}</div></article>', "z"))
    rows += [(99, None, None, "z"), (98, "::bad", "<p>x</p>", "z"), (97, "http://a.org/n", "", "z"), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_blocks string")
    got = {r.page_id: r.main_blocks for r in extract(df).collect()}
    assert extract(df).count() == len(rows)
    assert got[99] == got[97] == [] and got[98] == ["x"]
    for i in range(12):
        assert "A line that all have." in got[i]
        assert "The same box on all pages." not in got[i]
    b = extract(df.where("url like '%b.org%'")).collect()
    assert all(any(t.startswith("Box") for t in r.main_blocks) for r in b)
    assert extract(df.limit(0)).count() == 0


def test_copies_of_one_page_are_no_template(spark):
    page = '<div class="body"><p>one</p><p>two</p></div>'
    df = spark.createDataFrame([(i, "http://c.org/x", page) for i in range(40)], "page_id long, url string, html string")
    assert all(r.main_blocks == ["one", "two"] for r in extract(df).collect())


def plain_importance(pages):
    """The style tree of one host by its definition: node -> importance, from different pages."""
    from math import log

    from amity.llm.html import GAMMA, PRIOR

    shown, told, children = {}, {}, {}
    for page in set(pages):
        for key, node in parse(page)[1].items():
            if node.texts:
                shown.setdefault(key, []).append(" ".join(node.children))
                children.setdefault(key, []).append(len(node.children))
                for x in set(node.texts):
                    told.setdefault(key, []).append(x)
    out = {}
    for key, forms in shown.items():
        m = len(forms)
        if m == 1:
            out[key] = 1.0
            continue
        presentation = -sum(forms.count(f) / m * log(forms.count(f) / m, m) for f in set(forms))
        contents = sum(1 - log(told[key].count(x)) / log(m) for x in told[key]) / len(told[key])
        share = GAMMA ** (sum(children[key]) / m)
        out[key] = (m * ((1 - share) * presentation + share * contents) + PRIOR) / (m + PRIOR)
    return out


def test_style_tree_against_its_definition(spark):
    rng = random.Random(3)
    pages = []
    for i in range(60):
        host = f"{'abcd'[min(3, i // 19)]}.org"
        body = "".join(f"<p>own {rng.randint(0, 99)}</p>" for _ in range(rng.randint(0, 3)))
        box = rng.choice(["", '<div class="x">all the same</div>', f'<div class="x"><h2>t</h2>box {rng.randint(0, 3)}</div>'])
        pages.append((host, f"<div class=m>{body}{box}<ul><li>one<li>{rng.choice('xyz')}</ul></div>"))
    pages += pages[:7]
    got = {(r.host, r.node): r for r in style_tree(spark.createDataFrame(pages, "host string, html string")).collect()}
    want = {(h, k): v for h in {h for h, _ in pages} for k, v in plain_importance([p for x, p in pages if x == h]).items()}
    assert got.keys() == want.keys()
    assert all(got[k].importance == pytest.approx(v) for k, v in want.items())


def test_hosts_of_few_pages_have_a_tree_too(spark):
    page = '<article><p>text {0}</p><div class="x1">The same box.</div></article>'
    rows = [(i, f"http://{h}.org/{i}", page.format(f"{h}{i}")) for h, n in (("a", 1), ("b", 2), ("c", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.url: len(r.main_blocks) for r in extract(df).collect()}
    assert got["http://a.org/0"] == 2 and {got[f"http://c.org/{i}"] for i in range(3)} == {1}


def test_deep_pages_take_linear_space():
    depth = 50_000
    blocks, nodes = parse("<div>" * depth + "deep")
    assert [b.text for b in blocks] == ["deep"] and len(nodes) == depth + 1
