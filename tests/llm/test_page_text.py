"""Page text: markup cases, longest common subsequences, template hosts."""

import random

import pytest

from tidewater.llm import page_text as P

CASES = [
    ("<html><body><nav><p>menu</p></nav><article><h1>T &amp; t</h1><p>one<br>two\n three<p>four <b>five</b>six"
     "</article><footer>&copy; x</footer></body></html>", ["T & t", "one two three", "four fivesix"]),
    ('<body><div class="ad">buy</div><article><p>a</p><div class="x ad-box"><div>in</div>buy</div><p>b</p>'
     '<section id="comments"><article class="comment"><p>hi</p></article></section></article>', ["a", "b"]),
    ('<script>var t="</p><article>no</article>";</script><article><!-- <p>no</p> --><p>x &lt;b&gt; 1 < 2</p></article>',
     ["x <b> 1 < 2"]),
    ("<article><header><h1>own header</h1></header><p>a&nbsp;b</p><aside>side</aside><form><p>q</p></form></article>"
     "<header>page header</header>", ["own header", "a b"]),
    ('<article><p>unclosed <i>tags<p>go on<ul><li>x<li>y</ul><table><tr><td>1</td><td>2</td></tr></table>',
     ["unclosed tags", "go on", "x", "y", "1 2"]),
    ('<div role="navigation">n</div><main><div hidden>h</div><p title="a > b">t</p></main>', ["t"]),
    ("plain text only", ["plain text only"]),
    ("<div class='content has-sidebar'><article><p>a</p></article></div>", ["a"]),
    ("<article class='post comments-open'><p>a</p></article>", ["a"]),
    ("<article><p>a</p><div class='ad-hoc-report'><p>b</p></div></article>", ["a", "b"]),
    ("<article><p>a</p><section class='share-prices'>b</section><div class='related-work'>c</div></article>", ["a", "b", "c"]),
    ("<article><p>long enough a text</p><div class='relatedPosts'>r</div><div class='cookie-notice'>c</div>"
     "<div id='site-footer'>f</div></article>", ["long enough a text"]),
    ("<form id='aspnet'><nav>n</nav><main><p>a</p><form>f</form></main></form>", ["a"]),
    ("<div class='widget'><p>all of the text is in here</p></div>", ["all of the text is in here"]),
    ("<main><p>the article</p><aside class='related'><article>teaser</article></aside></main>", ["the article"]),
    ("<article><p>hi</p><div class='comments'><article class='comment'><p>much longer than the article</p></article>"
     "</div></article>", ["hi"]),
    ("<nav>never closed <p>text</p>", ["never closed", "text"]),
    ("", []),
    ("<p></p><p> \n </p>", []),
]


@pytest.mark.parametrize("page, want", CASES)
def test_blocks(page, want):
    assert P.blocks(page)[0] == want


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(rng.choice([2, 5, 30])) for _ in range(rng.randint(0, 25))] for _ in range(2))
    at = P.shared_lines(a, b)
    assert at == sorted(set(at)) and len(at) == lcs(a, b)
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in at)


def test_template_lines_go_and_copies_stay(spark):
    rows, want = [], {}
    for i in range(30):  # no article element: only neighbours tell the template from the text
        body = f"<p>story {i} line one</p><p>story {i} line two and more words</p>"
        rows.append((i, f"http://Big.example.com:80/{i % 3}/{i:03d}?q={i}", f"<div>Our site</div>{body}<div>Contact us</div>"))
        want[i] = f"story {i} line one\n\nstory {i} line two and more words"
    rows += [(100, "http://a.org/x", "<p>same</p><p>page</p>"), (101, "http://a.org/y", "<p>same</p><p>page</p>"),
             (102, "http://alone.org/", "<p>alone</p>"), (103, None, "<p>no url</p>"), (104, "http://b.org/", None),
             (None, "http://b.org/2", ""), (105, "http://c.org/1", "<article><p>Our site</p></article>"),
             (106, "http://c.org/2", "<article><p>Our site</p></article>")]
    want |= {100: "same\n\npage", 101: "same\n\npage", 102: "alone", 103: "no url", 104: "", None: "",
             105: "Our site", 106: "Our site"}
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "page_id bigint, url string, html string, text string, row int").repartition(5)
    got = P.main_text(df).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)


def test_differencing_decides_on_marked_pages(spark):
    rows, want = [], {}
    for i in range(12):
        page = (f"<p>Site menu</p><article><h1>Title {i}</h1><div class='body-x'><p>own {i} text</p><p>A passage they share</p>"
                f"</div><p>Plain passage</p><div class='zz-9'><p>Tell your friends</p><ul><li>Now</li></ul></div>"
                f"<p class='k'>Kind {i}</p><p class='k'>Kind</p></article>")
        rows.append((i, f"http://h.org/a/{i:02d}", page))
        want[i] = f"Title {i}\n\nown {i} text\n\nA passage they share\n\nPlain passage\n\nKind {i}\n\nKind"
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in P.main_text(df).collect()} == want


def test_short_articles_lose_a_long_template_and_unmarked_pages_meet(spark):
    template = "".join(f"<p>a long line number {j} of the template of this site</p>" for j in range(20))
    rows = [(i, f"http://s.org/{i}", f"{template}<p>short {i}</p>") for i in range(4)]
    for i in range(6):  # marked and unmarked pages by turns
        rows += [(100 + i, f"http://t.org/{i}a", f"<p>Top</p><p>words {i}</p><p>End</p>"),
                 (200 + i, f"http://t.org/{i}b", f"<article><p>marked {i}</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in P.main_text(df).collect()}
    want = {i: f"short {i}" for i in range(4)}
    want |= {100 + i: f"words {i}" for i in range(6)} | {200 + i: f"marked {i}" for i in range(6)}
    assert got == want


def test_copies_in_a_row_ask_pages_farther_off(spark):
    prose = lambda k, n=40: " ".join(f"{k}{j}" for j in range(n))
    page = lambda text: f"<p>Top of site</p><p>{text}</p><p>End of site</p>"
    rows, want = [], {}
    for i in range(4):  # exact copies, then near ones that differ in a word, then others
        rows.append((i, f"http://c.org/a{i}", page(prose("copy"))))
        want[i] = prose("copy")
    for i in range(7):
        text = prose("near") + f" end{i}"
        rows.append((10 + i, f"http://c.org/b{i}", page(text)))
        want[10 + i] = text
    for i in range(2):  # near copies and nothing else on the host
        rows.append((20 + i, f"http://d.org/{i}", page(prose("only") + f" end{i}")))
        want[20 + i] = f"Top of site\n\n{prose('only')} end{i}\n\nEnd of site"
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in P.main_text(df).collect()} == want


def test_shared_passages_stay_and_templates_go(spark):
    """Neighbours that share a passage of their articles keep it, in plain and in named elements; templates go."""
    rows, want = [], {}
    for i in range(12):
        own = [f"own line {i} of words", "a passage of two articles" if i in (4, 5) else f"other {i}", f"last words {i}"]
        rows.append((i, f"http://u.org/{i:02d}", "<p>Top</p>" + "".join(f"<p>{t}</p>" for t in own) + "<p>End</p>"))
        want[i] = "\n\n".join(own)
        quoted = f"<blockquote class='q'>{own[1]}</blockquote>"
        rows.append((100 + i, f"http://v.org/{i:02d}", f"<article><p>{own[0]}</p>{quoted}<p>{own[2]}</p></article>"))
        want[100 + i] = "\n\n".join(own)
    for i in range(2):  # two pages: only lines at the ends are template
        rows.append((200 + i, f"http://w.org/{i}", f"<p>Top</p><p>mine {i}</p><p>shared</p><p>yours {i}</p><p>End</p>"))
        want[200 + i] = f"mine {i}\n\nshared\n\nyours {i}"
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in P.main_text(df).collect()} == want


def test_very_long_page(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(i, f"http://l.org/{i}", f"<p>Top</p><p>{long} {i}</p>" + "".join(f"<p>{i} {j}</p>" for j in range(3000)))
            for i in range(3)] + [(9, "http://l.org/9", "<p>Top</p><p>short</p>")]
    got = {r.page_id: r.text for r in P.main_text(spark.createDataFrame(
        rows, "page_id bigint, url string, html string")).collect()}
    assert got[9] == "short" and all(got[i].startswith(long + f" {i}\n\n{i} 0") for i in range(3))


def test_empty_table(spark):
    assert P.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
