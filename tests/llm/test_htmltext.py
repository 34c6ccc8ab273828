import pytest

from ticketlake.llm import htmltext

P = "A paragraph, with some commas, that is long enough to count for the article."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain < text &amp; more", "plain < text & more"),
    (f"<article><h1>T</h1><p>{P}<br>two\n\t three</article>", f"T\n\n{P} two three"),
    (f"<body><nav><ul><li><a href=x>Home</a></ul></nav><div class='post'><p>{P}<p>Short one.</div><footer>F</footer>", f"{P}\n\nShort one."),
    (f"<main><p>{P}</p><div class='comments'><p>{P} {P}</p></div><aside>{P}</aside><form>{P}</form></main>", P),
    (f"<article><header><h1>Head</h1></header><p>{P}</p><div class=\"ad\">{P}</div><!-- {P} --></article>", f"Head\n\n{P}"),
    (f"<body><div id='cookie-notice'><p>{P} {P}</p></div><div><p>{P}</p><script>if (a < b) x('</p>');</script><style>p{{}}</style></div>", P),
    (f"<div><p>{P} &lt;b&gt; &copy; &#233;</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></div>", f"{P} <b> © é\n\none\n\ntwo\n\nc1\n\nc2"),
    (f"<article><p>{P}</p></article></body", P), (f"<article><p>{P}</p><p>cut &am", f"{P}\n\ncut &am"),
    (f"<div><p>{P}</p></div><div class='sidebar'><a href=a>{P}</a></div><p style='display:none'>{P}</p>", P),
])
def test_pages(page, want):
    assert htmltext.main_text(page) == want


@pytest.mark.parametrize("tag", ["article", "main"])
def test_prose_one_element_below_the_article(tag):
    body = (f"<header><h1>T</h1></header><div>{f'<p>{P}</p>' * 20}</div><h2>More</h2><ul><li>one</li><li>two</li></ul>"
            "<blockquote><p>Short quote.</p></blockquote><section><p>A second, short section</p></section>")
    want = ["T", *[P] * 20, "More", "one", "two", "Short quote.", "A second, short section"]
    page = f"<body><nav>Home</nav><{tag}>{body}<div class='comments'>{P}</div></{tag}><div>Beside</div></body>"
    assert htmltext.main_blocks(page) == want
    assert htmltext.main_blocks(f"<main><div>Beside</div><article>{body}</article></main>") == want


@pytest.mark.parametrize("inside, kept", [
    ('<h2 id="sharing-data">Data</h2>', ["Data"]), ('<section id="discussion"><p>We discuss.</p></section>', ["We discuss."]),
    ('<p>We <span class="share">share</span> it.</p>', ["We share it."]), ('<div id="sharing-data"><p>In full.</p></div>', ["In full."]),
    ('<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>', ["One", "Two", "Three"]),
    ('<header><h2>Title</h2></header>', ["Title"]), ('<p class="notice">A notice given in the text.</p>', ["A notice given in the text."]),
    (f'<article class="comment"><p>{P}</p></article>', []), (f'<article hidden><p>{P}</p></article>', []),
    (f'<article class="comment-7 odd"><p>{P}</p></article>', []), (f'<div id="comments"><p>{P}</p></div>', []),
    (f'<div id="related-links"><p>{P}</p></div>', []), (f'<div class="share-box"><p>{P}</p></div>', []), (f'<form><p>{P}</p></form>', []),
])
def test_inside_an_article(inside, kept):
    page = f"<body><nav>Home</nav><article class='post comments-open'><p>{P}</p>{inside}<p>{P} End.</p></article><footer>F</footer>"
    assert htmltext.main_blocks(page) == [P, *kept, f"{P} End."]


def test_an_article_without_the_element():
    body = f"<h1>T</h1><div>{f'<p>{P}</p>' * 20}</div><h2>More</h2><ul><li>one</li><li>two</li></ul><blockquote>Quote.</blockquote><div>Last section</div>"
    want = ["T", *[P] * 20, "More", "one", "two", "Quote."]
    side = f"<div class='sidebar'><p>{P}</p></div><ul><li><a href=a>Home</a><li><a href=b>About</a><li><a href=c>More</a></ul>"
    assert htmltext.main_blocks(f"<body>{side}<div>{body}</div><footer>F</footer></body>") == [*want, "Last section"]
    assert htmltext.main_blocks(f"<body>{side}{body}<footer>F</footer></body>") == want        # straight in the body: a bare div is beside it


def test_very_deep_nesting():
    deep = "<div>" * 5000 + f"<p>{P}</p>" + "</div>" * 5000
    assert htmltext.main_text(deep) == P
    assert P in htmltext.main_text("<b>" * 5000 + f"<article><p>{P}</p></article>")


def test_query_edges(spark):
    long_ = "<article>" + f"<p>{P}</p>" * 3000 + "</article>"
    rows = [(1, "u", None, "e"), (2, None, "", "e"), (None, "u", f"<article><p>{P}</p></article>", "e"), (4, "u", long_, "e"), (4, "u", long_, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract_pages(pages).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert [r.text for r in got] == [htmltext.main_text(r[2]) for r in rows]
    assert all(r.n_chars == len(r.text) for r in got) and got[3].n_blocks == 3000
    assert htmltext.extract_pages(pages.where("false")).count() == 0
