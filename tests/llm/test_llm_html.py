import time

from calipers.llm import html_text
from calipers.llm.html_text import ARTICLE, LOOSE, MARKED, blocks


def article(page):
    return [t for k, t in blocks(page) if k == ARTICLE]


def test_an_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p><article>no";</script></head>
    <body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <article>no</article> --><div class="ad">buy</div>
    <article><h1>Title</h1><p><b>Bold<br>next<p>caf&eacute; &#x41;&amp;b &am; x
      y<div class="ad-slot promo">advert</div><aside>side</aside><form>field <input value="v"></form><ul><li>one<li>two</ul>
    <p hidden>no</p><table><tr><td>c1<td>c2</table><section class="comments"><article class="comment">a reader</article></section></article>
    <footer>&copy; x</footer></body></html>"""
    assert article(page) == ["Title", "Bold next", "café A&b &am; x y", "one", "two", "c1", "c2"]


def test_inline_marks_and_unclosed_markup():
    assert article("<article><p>a <span class='ad'>no</span> b <i>c</i>d</p></article>") == ["a", "b cd"]
    assert article("<article><p>1 < 2 and <b>open") == ["1 < 2 and open"]
    assert article("<main><p>kept</p></main><script>never closed <p>x") == ["kept"]
    assert article("<article><header><h1>Own title</h1><p>by line</p></header><p>x</p></article>") == ["Own title", "x"]
    assert list(blocks("")) == [] and list(blocks("plain  text")) == [(LOOSE, "plain text")]
    assert (MARKED, "menu") in list(blocks("<nav>menu</nav>"))


def test_repeated_substrings_of_a_host_go_and_unique_runs_stay(spark):
    same = "subscribe to our weekly letter and never miss a single story again today"
    pages = [(i, f"https://h.example/{i}", f"<div>{same} {w} {w} tail{i}</div><div>body of page {w}</div>") for i, w in enumerate(["red", "green", "blue"])]
    pages += [(9, "https://other.example/", f"<div>{same}</div>"), (10, None, None), (11, "x", ""), (0, *pages[0][1:])]
    pages += [(12, "https://h.example/a", "<nav>m</nav><article><p>art</p></article>")]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, row string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html_text.extract(df).collect())
    assert got == [
        (0, "red red tail0\n\nbody of page red"), (0, "red red tail0\n\nbody of page red"), (1, "green green tail1\n\nbody of page green"),
        (2, "blue blue tail2\n\nbody of page blue"), (9, same), (10, ""), (11, ""), (12, "art"),
    ]
    assert html_text.extract(df.filter("false")).count() == 0


def test_coverage_equals_a_brute_force_search(spark):
    import random

    random.seed(4)
    words = ["a", "b", "c"]
    streams = [[random.choice(words) for _ in range(random.randint(0, 40))] for _ in range(12)]
    df = spark.createDataFrame([(k, "http://h/", f"<div>{' '.join(s)}</div><!-- {k} -->") for k, s in enumerate(streams)], "page_id long, url string, html string")
    found = html_text.outside(df)
    got = {(r["id"], r["place"]) for r in html_text.repeated(found, 5).join(found.select("row", "id"), "row").collect()}
    grams = {(k, i): tuple(s[i : i + 5]) for k, s in enumerate(streams) for i in range(len(s) - 4)}
    assert got == {x for x, g in grams.items() if any(h == g and y[0] != x[0] for y, h in grams.items())}


def unlike(seed, n=60):
    import random

    draw = random.Random(seed)
    return [f"w{draw.randrange(10**9)}" for _ in range(n)]


NOTICE = "write to our desk for a printed copy of this story"


def texts_of(spark, pages):
    df = spark.createDataFrame([(k, f"https://h.example/{k}", page) for k, page in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_text.extract(df).orderBy("page_id").collect()]


def test_a_notice_that_nothing_marks_goes_from_articles(spark):
    own = [" ".join(unlike(k)) for k in range(6)]
    got = texts_of(spark, [f"<article><p>{t}</p><p>{NOTICE}</p></article>" for t in own])
    assert got == own


def test_a_long_passage_within_blocks_of_articles_goes(spark):
    passage = " ".join(unlike(99, 20))
    got = texts_of(spark, [f"<article><p>a{k} {' '.join(unlike(k))} {passage} z{k}</p></article>" for k in range(5)])
    assert got == [f"a{k} {' '.join(unlike(k))} z{k}" for k in range(5)]


def test_near_copies_keep_what_they_share(spark):
    for element in ("article", "div"):
        same = " ".join(unlike(1, 80))
        copies = [f"<{element}><p>{same}</p><p>{NOTICE}</p><p>at {k} o'clock</p></{element}>" for k in range(12)]
        own = [" ".join(unlike(k)) for k in range(50, 53)]
        others = [f"<{element}><p>{t}</p><p>{NOTICE}</p></{element}>" for t in own]
        got = texts_of(spark, copies + others)
        assert got == [f"{same}\n\nat {k} o'clock" for k in range(12)] + own
        assert texts_of(spark, copies) == [f"{same}\n\n{NOTICE}\n\nat {k} o'clock" for k in range(12)]


def test_a_phrase_of_two_pages_stays(spark):
    phrase = "to be or not to be that is the question"
    pages = [f"<div>{' '.join(unlike(k))} {phrase} {' '.join(unlike(k + 9))}</div>" for k in range(2)]
    assert texts_of(spark, pages) == [p[5:-6] for p in pages]


def test_a_class_counts_as_a_whole_and_never_takes_most_of_an_article():
    story = "the whole story of a long day " * 5
    for page in (
        f'<article><div class="content with-sidebar"><p>{story}</p></div></article>',
        f'<article><section class="search-engines"><p>{story}</p></section></article>',
        f'<article><div class="form"><p>{story}</p></div><p>end</p></article>',
    ):
        assert story.strip() in article(page)
    page = f'<article><div class="widget"><p>{story}</p><div class="site-nav">menu</div><nav>list</nav></div><p class="ad-slot ad-300x250">buy</p><p>end</p></article>'
    assert article(page) == [story.strip(), "end"]
    assert article(f'<article><p>short</p><div class="comments-list"><p>{story}</p></div></article>') == ["short"]


def test_quotes_hide_the_end_of_a_tag_unless_they_stay_open():
    assert article('<article><p title="a > b">one</p><p title=\'x"\'>two</p></article>') == ["one", "two"]
    assert article('<article><p title="open>one</p><p>two</p></article>') == ["one", "two"]
    assert article("<article><p>a < b and <3 <!-- cut > here --> c</p></article><a tail") == ["a < b and <3 c"]
    assert blocks("x <a tail <!-- gone") == [(LOOSE, "x <a tail")]


def test_broken_and_deep_pages_take_time_in_proportion():
    n = 100_000
    pages = ["<a " * n, "<a " * n + ">", "<div>" * n, "<div>" * n + "</div>" * n, "<i>" * n + "</b>" * n, "<b>" + "<div>" + "<i>" * n + "</b>" * n, "<i>" * n + "<hr>" * n,
             '<a ">' * n + '"', "<a '>\"" * n, "<script " * n, "<script></script " * n, "</ " * n, "<!" * n, "<p>" * n, "<article><div class=ad>" * n + "x"]
    for page in pages:
        started = time.monotonic()
        blocks(page)
        assert time.monotonic() - started < 10, page[:40]
