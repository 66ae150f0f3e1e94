from clicklake.llm import html

PAGE = "<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class='cookie-notice'>ok</div><article><header><h1>A &amp; B</h1></header><p><b>one\n two<br>three<p>four</article><section id=comments><p>me too</section><footer>f</footer>"


def test_the_article_alone():
    assert html.main_text(PAGE) == "A & B\n\none two three\n\nfour"


def test_pages_without_an_article_and_broken_markup():
    assert html.main_text("<body><aside>x</aside><div>a<div>b</div>c</div><form>f</form><script>'</p>'") == "a\n\nb\n\nc"
    assert html.main_text("1 < 2 &lt; 3 <p title='a>b'>x</p> <!-- no") == "1 < 2 < 3\n\nx"
    assert html.main_text("<div>" * 5000 + "deep") == "deep" and html.main_text(None) == html.main_text("") == ""


def test_a_name_is_a_hint():
    for tag, name in (("div", "layout has-sidebar"), ("article", "post comments-open"), ("div", "search-results"), ("div", "widget"), ("form", "")):
        page = f"<body><nav>menu</nav><{tag} class='{name}'><h1>Title</h1><p>A text that is the main part of it.</p><div class=ads>buy</div></{tag}></body>"
        assert html.main_text(page) == "Title\n\nA text that is the main part of it."
    assert html.main_text("<nav>a very long row of links</nav><form>" + "<p>x</p>" * 9 + "<article>own</article></form>") == "own"
    assert html.main_text("<article>own text</article><aside><article>more</article></aside>") == "own text"


def test_deep_pages():
    for inner, end in (("<div>", "</div>"), ("<b>", "")):
        deep = f"<p>first</p>{inner * 3000}<p>second</p><aside>no</aside>{end * 3000}<p>third</p>"
        assert html.main_text(f"<div><article>{deep}</article>outside</div>") == "first\n\nsecond\n\nthird"


def test_branches_that_all_pages_of_a_host_share_go(spark):
    page = "<body><div class='q7'>Same words everywhere</div><div class='z'><p>Story %d of its own, and long enough to be the main part</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page % i) for i in range(12)] + [(50, None, None), (51, "x", ""), (52, "http://other.example/", page % 1), (52, "http://other.example/", page % 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [(r["page_id"], r["text"]) for r in html.extract(frame).collect()]
    assert len(found) == len(rows)
    texts = dict(found)
    assert texts[3] == "Story 3 of its own, and long enough to be the main part" and texts[50] == texts[51] == ""
    assert texts[52].startswith("Same words everywhere\n\nStory 1")
    assert html.extract(frame.limit(0)).count() == 0


def test_lines_that_all_pages_of_a_small_host_share_go(spark):
    page = "<body><p>Read our notice</p><h2>Same heading</h2><div class='q7'>Same words</div><p>Story %d of its own, and long enough to be the main part</p></body>"
    frame = spark.createDataFrame([(i, "http://h.example/", page % i) for i in range(4)], "page_id long, url string, html string")
    assert {r["text"] for r in html.extract(frame).collect()} == {f"Story {i} of its own, and long enough to be the main part" for i in range(4)}


NAMES = ("comment-list", "user-comments", "site-header", "main-nav", "related-posts", "sidebar-left", "cookie-bar", "ad-slot", "ads", "newsletter-box")


def test_compound_names_say_what_a_part_is():
    for name in NAMES:
        page = f"<article><h1>Title</h1><p>A text that is the main part of it.</p><div class='{name}'><p>something else</p></div><p>End.</p></article>"
        assert html.main_text(page) == "Title\n\nA text that is the main part of it.\n\nEnd.", name
    for name in ("has-sidebar", "comments-open", "no-ads", "article-header", "post-title", "download", "broadcast"):
        page = f"<article><p class='{name}'>First</p><p>A text that is the main part of it.</p></article>"
        assert html.main_text(page) == "First\n\nA text that is the main part of it.", name


def test_what_articles_of_a_host_share_is_article_text(spark):
    page = "<body><p>Read our notice</p><article><h1>Same title</h1><p>Story %d of its own, long enough to be the main part</p><p>Thanks for reading.</p></article></body>"
    rows = [(i, f"http://h.example/{i}", page % i) for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = {i: f"Same title\n\nStory {i} of its own, long enough to be the main part\n\nThanks for reading." for i in range(8)}
    assert {r["page_id"]: r["text"] for r in html.extract(frame).collect()} == expected


def plain_article(page):
    """The first article's blocks, by the standard library's parser; for pages whose markup is whole."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        inside, skipped, blocks = 0, 0, [""]

        def handle_starttag(self, tag, attrs):
            names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).split()
            if tag == "article":
                self.inside += 1
            if tag not in html.VOID and (self.skipped or tag in html.RAW or tag in ("nav", "aside", "footer", "form") or set(names) & html.ASIDE_NAMES):
                self.skipped += 1
            if tag in html.BLOCK:
                self.blocks = [*self.blocks, ""]

        def handle_endtag(self, tag):
            if self.skipped and tag not in html.VOID:
                self.skipped -= 1
            if tag == "article":
                self.inside -= 1
            if tag in html.BLOCK:
                self.blocks = [*self.blocks, ""]

        def handle_data(self, data):
            if self.inside and not self.skipped:
                self.blocks[-1] += data

    reader = Reader()
    reader.feed(page)
    return "\n\n".join(" ".join(b.split()) for b in reader.blocks if b.strip())


def test_the_query_equals_the_plain_articles_of_all_pages(spark):
    from clicklake.llm.queries import op8_main_text

    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = {r["page_id"]: r["text"] for r in op8_main_text(spark, folder).collect()}
    assert found.keys() == pages.keys()
    differ = [i for i, page in pages.items() if "<article" in (page or "") and found[i] != plain_article(page)]
    assert not differ, differ[:3]


def test_clashing_columns_and_a_long_page(spark):
    rows = [(1, "http://h/1", "<article>" + "<p>word word</p>" * 50_000 + "</article>"), (2, "http://h/2", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as host", "'c' as text", "'c' as nodes", "'c' as low_host")
    found = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert found[1] == "\n\n".join(["word word"] * 50_000) and found[2] == ""
