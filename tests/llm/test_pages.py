import random

from pyspark.sql import functions as F

from kinfold.llm import pagediff

FRAME = '<html><body class="single no-sidebar"><div>Site of all</div>{}<div class="site-footer">rights {}</div></body></html>'


def texts(spark, htmls, host="http://x.example/a/"):
    pages = spark.createDataFrame([(i, f"{host}{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return {r.page_id: r for r in pagediff.extract(pages).collect()}


def test_names_that_tell_in_part_are_decided_by_the_alignment(spark):
    bodies = [
        f'<article class="comments-open"><div class="entry-header"><h1>Title {i}</h1></div><p class="related-work">Own work {i}</p><p class="related-work">Work of all</p><p>Quoted by all</p><p>Text {i}</p>'
        '<p><a href="/s">Share this</a></p><p><a href="/r">Read more</a></p></article>'
        for i in range(4)
    ]
    got = texts(spark, [FRAME.format(b, i) for i, b in enumerate(bodies)])
    for i in range(4):
        # shared: the site's line, the doubtful line, the links at the end; the footer differs, and its name says enough beside an article
        assert got[i].text == f"Title {i}\nOwn work {i}\nQuoted by all\nText {i}" and got[i].n_shared >= 5
    alone = texts(spark, [FRAME.format(bodies[0], 0)])[0]
    assert alone.text == "Site of all\nTitle 0\nOwn work 0\nWork of all\nQuoted by all\nText 0\nShare this\nRead more" and alone.n_shared == 0


def test_links_within_an_article_stay(spark):
    bodies = [f"<article><h1>T{i}</h1><p><a>See also</a></p><p>Text {i} of some length</p><p><a>Home</a></p></article>" for i in range(3)]
    got = texts(spark, bodies)
    assert [got[i].text for i in range(3)] == [f"T{i}\nSee also\nText {i} of some length" for i in range(3)]


def test_pages_without_an_article_are_decided_by_the_alignment(spark):
    pages = [f'<body><div>Menu of all</div><div class="side-links">Links of all</div><div class="post-header">Head {i}</div><p>Text {i} {"word " * 9}</p><div class="ad">Buy {i}</div><div>Imprint</div></body>' for i in range(5)]
    got = texts(spark, pages)
    for i in range(5):
        assert got[i].text == f"Head {i}\nText {i} " + ("word " * 9).strip() and got[i].n_shared == 3


def test_copies_say_nothing_about_a_page(spark):
    page = lambda i: f"<div>Site name</div><p>Article {i} with a text that is long enough</p><div>All rights</div>"
    # a run of equal pages under neighbouring paths: pages on either side of it decide
    got = texts(spark, [page(0), page(7), page(7), page(7), page(7), page(9)])
    assert [got[i].text for i in range(6)] == [f"Article {n} with a text that is long enough" for n in (0, 7, 7, 7, 7, 9)]
    articles = [f"<article><p>{t}</p></article><div>Site</div>" for t in ("Same", "Same", "Same", "Other")]
    got = texts(spark, articles)
    assert [got[i].text for i in range(4)] == ["Same", "Same", "Same", "Other"]


def brute_nearest(rows):
    """rows: row, page_id, host, path, digest."""
    order = sorted(rows, key=lambda r: (r[2], r[3], r[1] is not None, r[1] or 0, r[0]))
    out = {}
    for at, (row, _, host, path, digest) in enumerate(order):
        near = []
        for side, others in ((0, order[:at][::-1]), (1, order[at + 1 :])):
            other = next((o for o in others if o[4] != digest), None)
            if other and other[2] == host:
                common = next((k for k, (x, y) in enumerate(zip(path, other[3])) if x != y), min(len(path), len(other[3])))
                near.append((-common, side, other[0]))
        out[row] = [r for _, _, r in sorted(near)]
    return out


def test_nearest_over_several_ranges_equals_brute_force(spark):
    rng = random.Random(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for hosts, digests in ((3, 40), (1, 2), (12, 3)):
            rows = []
            for row in range(150):
                path = "/" + "".join(rng.choices("ab/", k=rng.randint(0, 4)))
                rows.append((row, rng.choice([None, *range(30)]), f"h{rng.randrange(hosts)}", path, rng.randrange(digests)))
            rows += [(200 + k, 5, "one", "/same", 1) for k in range(60)] + [(300, 5, "one", "/same", 2)]
            places = spark.createDataFrame(rows, "row long, page_id long, host string, path string, digest long").repartition(3)
            got = {r.row: r.near for r in pagediff.nearest(places).collect()}
            assert got == brute_nearest(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_every_row_is_a_page(spark):
    rows = [(1, "http://a.example/1", "<p>one</p>"), (1, "http://a.example/1", "<p>one</p>"), (1, "http://a.example/2", "<p>two</p><p>x</p>"), (None, "http://a.example/3", "<p>three</p><p>x</p>"), (None, None, None), (2, None, "")]
    pages = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, row int")
    got = sorted((r.page_id or 0, r.url or "", r.text) for r in pagediff.extract(pages).collect())
    assert got == [(0, "", ""), (0, "http://a.example/3", "three"), (1, "http://a.example/1", "one"), (1, "http://a.example/1", "one"), (1, "http://a.example/2", "two\nx"), (2, "", "")]  # of equally near pages the one before decides
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(60_000)) + "</article>"
    only = pagediff.extract(spark.createDataFrame([(1, "u", long), (2, "v", long)], "page_id long, url string, html string")).first()
    assert only.text.count("\n") == 59_999


def test_addresses(spark):
    urls = ["https://A.example:80/x/y?z=/q#f", "http://a.example", "a/b?c", "mailto:x@y", "http://[bad", None, ""]
    df = spark.createDataFrame([(i, u, "<p>x</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path) for r in pagediff.parse(df).collect()}
    assert [got[i] for i in range(7)] == [("a.example:80", "/x/y"), ("a.example", ""), ("", "a/b"), ("", "mailto:x@y"), ("[bad", ""), ("", ""), ("", "")]
    assert pagediff.parse(df).where(F.size("hashes") == 1).count() == 7
