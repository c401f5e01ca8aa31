from __future__ import annotations

import json

from pyspark.sql import functions as F

from quirelake.functions import markup
from quirelake.operators import pages, payloads
from quirelake.plans.catalogue import extraction

RUN = "2026-05-01T10:00:00+00:00"

PRODUCT = """<!DOCTYPE html><html><body>
<ul class="breadcrumb"><li><a href="../../index.html">Home</a></li><li><a href="../b">Books</a></li>
<li><a href="../c">Sequential Art</a></li><li class="active">It&#39;s</li></ul>
<article class="product_page"><div class="row"><div class="col-sm-6"><div id="g"><div><img></div></div></div>
<div class="col-sm-6 product_main"><h1> It&#39;s &amp; More </h1><p class="price_color">&pound;51.77</p>
<p class="instock availability"><i class="icon-ok"></i>
   In stock (22 available)
</p><p class="star-rating Three"><i></i></p><hr/><p>inner</p></div></div>
<div id="product_description" class="sub-header"><h2>Product Description</h2></div>
<p>A &quot;long&quot; story.</p>
<table class="table table-striped"><tr><th>UPC</th><td>a897</td></tr><tr><th>Price</th><td>x</td></tr>
<tr><th>Number of reviews</th><td>7</td></tr><tr><th>UPC</th><td>last</td></tr></table></article></body></html>"""

LISTING = """<ul class="nav nav-list"><li><a href="catalogue/all.html">Books</a><ul>
<li><a href="catalogue/travel_2/index.html">Travel</a></li><li><a href="catalogue/art_3/index.html">Art</a></li>
</ul></li></ul><article class="product_pod"><h3><a href="../../light_1/index.html" title="t">t</a></h3></article>
<article class="product_pod"><h3><a title="u" href="../../dark_2/index.html">u</a></h3></article>
<ul class="pager"><li class="next"><a href="page-2.html">next</a></li></ul>"""


def one_page(spark, html, url="https://shop.example/catalogue/category/x/index.html"):
    return spark.createDataFrame([(url, html)], "url string, html string")


def test_product_page(spark):
    row = pages.product_records(one_page(spark, PRODUCT), RUN).first().asDict()
    assert row == {
        "titre": "It's & More", "auteur": "Unknown", "prix": "£51.77", "note_etoiles": 3,
        "disponibilite": "In stock (22 available)", "categorie": "Sequential Art", "description": 'A "long" story.',
        "isbn": "last", "nb_avis": 7, "langue": "en", "annee_publication": None,
        "url": "https://shop.example/catalogue/category/x/index.html", "source": "books.toscrape.com",
        "date_scraping": RUN,
    }


def record(spark, inner):
    html = PRODUCT.replace('<div class="row">', f'<div class="row">{inner}', 1)
    return pages.product_records(one_page(spark, html), RUN).first()


def test_text_nodes(spark):
    def with_heading(h1):
        return pages.product_records(one_page(spark, PRODUCT.replace("<h1> It&#39;s &amp; More </h1>", h1)), RUN).first().titre

    assert with_heading("<h1><span>x</span> Title</h1>") == "Title"
    assert with_heading("<h1><!-- c -->Title<br>more</h1>") == "Title"
    assert with_heading("<h1>a < b</h1>") == "a < b"

    def stock(p):
        html = f'<p class="instock">{p}</p>'
        return pages.product_records(one_page(spark, html), RUN).first().disponibilite

    assert stock("In stock<i></i>") == "In stock" and stock("In stock <b>now</b>") == "In stock"
    assert stock("<i>x</i>") == ""


def test_direct_paragraphs_at_any_depth(spark):
    for depth in (1, 7, 8, 9, 12, 40):
        assert record(spark, "<div>" * depth + "<p>deep</p>" + "</div>" * depth).description == 'A "long" story.'
    html = '<article class="product_page"><section><p>no</p></section><hr><p><b>x</b>first<p>second</article>'
    assert pages.product_records(one_page(spark, html), RUN).first().description == "first"


def test_nested_nodes(spark):
    inner = '<article class="promo"><h2>x</h2><p>no</p><article><p>no</p></article></article>'
    assert record(spark, inner).description == 'A "long" story.'
    html = f'<article class="product_page x">{inner}<div><article><p>no</p></article></div><p>yes</p></article>'
    assert pages.product_records(one_page(spark, html), RUN).first().description == "yes"
    html = '<article><article class="product_page"><p>inside</p></article><p>outside</p></article>'
    assert pages.product_records(one_page(spark, html), RUN).first().description == "inside"


def test_what_a_page_hides_is_no_field(spark):
    hidden = '<!-- <h1>no</h1> --><script>"<h1>no</h1><p class=price_color>1</p>"</script><style><h1>no</h1></style>'
    row = pages.product_records(one_page(spark, f"{hidden}<h1>yes</h1><!-- <p class='instock'>no</p>"), RUN).first()
    assert (row.titre, row.prix, row.disponibilite) == ("yes", "", "Out of stock")
    html = f'<a href="/a">x</a><!-- <a href="/dead">x</a> --><script>"<a href=/s>"</script><style><a href=/t></style><a href="/b">'
    assert [r.link for r in pages.page_links(one_page(spark, html)).collect()] == ["/a", "/b"]
    assert pages.page_links(one_page(spark, '<a href="/a">x</a><!-- <a href="/dead">')).count() == 1
    assert pages.page_links(one_page(spark, None)).count() == 0
    assert pages.product_records(one_page(spark, None), RUN).first().titre == ""


def test_only_the_tables_of_the_class_count(spark):
    other = '<table class="x"><tr><th>UPC</th><td>wrong</td></tr></table><table><tr><th>Number of reviews</th><td>9</td></tr></table>'
    row = pages.product_records(one_page(spark, PRODUCT + other), RUN).first()
    assert (row.isbn, row.nb_avis) == ("last", 7)


def test_hrefs_of_any_syntax(spark):
    html = """<a href=/x>1</a><a class='b' HREF = '/y?a=1&amp;b=2'>2</a><a data-href="/no" href="/z">3</a><a
      title="a > b" href=/w?q=1>4</a><a name=x>5</a><abbr href="/no">6</abbr>"""
    found = pages.page_links(one_page(spark, html)).orderBy("position").collect()
    assert [r.link for r in found] == ["/x", "/y?a=1&b=2", "/z", "/w?q=1"]


def test_page_without_any_node_is_kept(spark):
    row = pages.product_records(one_page(spark, "<html></html>"), RUN).first()
    assert (row.titre, row.prix, row.note_etoiles, row.disponibilite, row.categorie, row.description) == (
        "", "", 0, "Out of stock", "", "",
    )
    assert (row.isbn, row.nb_avis) == ("", 0)


def test_long_page_does_not_exhaust_the_stack(spark):
    body = "<div>" + "x <b>y</b> " * 200_000 + "</div>"
    html = PRODUCT.replace('<div class="row">', '<div class="row">' + body)
    assert pages.product_records(one_page(spark, html), RUN).first().description == 'A "long" story.'


def test_navigation(spark):
    page = one_page(spark, LISTING)

    def targets(found):
        links = pages.resolved_links(pages.page_links(page, targets=found))
        return [r.target for r in links.orderBy("position").collect()]

    html, root = F.col("html"), "https://shop.example/catalogue/category/x"
    assert targets(markup.category_links(html)) == [
        f"{root}/catalogue/travel_2/index.html", f"{root}/catalogue/art_3/index.html",
    ]
    assert targets(markup.links(html, markup.PRODUCT_LINK)) == [
        "https://shop.example/catalogue/light_1/index.html", "https://shop.example/catalogue/dark_2/index.html",
    ]
    assert targets(markup.links(html, markup.NEXT_LINK)) == [f"{root}/page-2.html"]
    assert pages.page_links(page).count() == 6


def work(spark, work, detail, subject="science fiction"):
    payload = json.dumps({"works": [work]})
    df = spark.createDataFrame([(subject, payload, json.dumps(detail))], "subject string, payload string, detail string")
    return payloads.work_records(payloads.works(df, keep=["subject", "detail"]), RUN).first()


def test_work_records(spark):
    full = work(
        spark,
        {"key": "/works/OL1W", "title": " Red Door ", "authors": [{"name": "Ann"}, {"name": "Bob"}], "edition_count": 12,
         "first_publish_year": 1954},
        {"description": {"type": "/type/text", "value": "d" * 600}, "isbn_13": [], "isbn_10": ["10a", "10b"]},
    )
    assert (full.titre, full.auteur, full.categorie, full.isbn, full.nb_avis) == ("Red Door", "Ann", "Science fiction", "10a", 12)
    assert (len(full.description), full.annee_publication, full.langue) == (500, 1954, "eng")
    assert (full.url, full.prix, full.note_etoiles) == ("https://openlibrary.org/works/OL1W", None, None)
    empty = work(spark, {"authors": []}, {})
    assert (empty.titre, empty.auteur, empty.description, empty.isbn, empty.nb_avis) == ("", "Unknown", "", "", 0)
    assert empty.url == "https://openlibrary.org"


def test_work_descriptions(spark):
    def description(value):
        return work(spark, {"key": "k"}, {"description": value}).description

    assert description("plain") == "plain"
    assert description("{odd text}") == "{odd text}"
    assert description({"value": "nested"}) == "nested"
    assert description({"type": "x"}) == ""
    assert description(None) == ""


def test_answers_without_lists_give_no_rows(spark):
    df = spark.createDataFrame([("s", "{}"), ("s", '{"works": []}'), ("s", "broken"), ("s", '{"items": [{"id": "v1"}, {}]}')], "subject string, payload string")
    assert payloads.works(df).count() == 0
    found = payloads.volume_urls(df, "https://api.example/", keep=["subject"]).collect()
    assert [(r.volume_id, r.detail_url) for r in found] == [("v1", "https://api.example/v1"), ("", "https://api.example/")]


def volume(spark, answer):
    df = spark.createDataFrame([("https://self.example", json.dumps(answer))], "url string, payload string")
    return payloads.volume_records(df, RUN).first()


def test_volume_records(spark):
    full = volume(spark, {
        "volumeInfo": {
            "title": " Grey Hill ", "authors": ["A B", "C D"], "averageRating": 4.5, "categories": ["Science", "x"],
            "description": "d" * 501, "ratingsCount": 7, "language": "fr", "publishedDate": "2004-03", "infoLink": "https://i",
            "industryIdentifiers": [{"type": "ISBN_10", "identifier": "1"}, {"type": "ISBN_13", "identifier": "2"}],
        },
        "saleInfo": {"saleability": "FOR_SALE", "listPrice": {"amount": 12.5, "currencyCode": "EUR"}},
    })
    assert (full.titre, full.auteur, full.prix, full.note_etoiles, full.isbn) == ("Grey Hill", "A B, C D", "12.5 EUR", 4.5, "2")
    assert (full.categorie, len(full.description), full.nb_avis, full.langue) == ("Science", 500, 7, "fr")
    assert (full.annee_publication, full.url, full.disponibilite) == (2004, "https://i", "FOR_SALE")
    for price, expected in (({}, None), (None, None), ({"x": 1}, " "), ({"amount": 3}, "3 ")):
        assert volume(spark, {"volumeInfo": {}, "saleInfo": {"listPrice": price}}).prix == expected
    assert volume(spark, {"volumeInfo": {"publishedDate": "9e99"}}).annee_publication is None
    empty = volume(spark, {"volumeInfo": {"categories": [], "publishedDate": "0000"}})
    assert (empty.titre, empty.auteur, empty.prix, empty.categorie, empty.langue) == ("", "Unknown", None, "Unknown", "en")
    assert (empty.annee_publication, empty.url, empty.disponibilite, empty.nb_avis) == (None, "https://self.example", "N/A", 0)


def test_pages_of_one_row_group_are_read_by_many_tasks(spark, tmp_path):
    kinds = ["SMALL", "PROMO", "LARGE", None]
    rows = [(i, f"part {i}", f"B{i}", kinds[i % 4], i % 50, i + 0.5) for i in [0, *range(200)]]
    parts = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    records = extraction.page_record(spark, str(tmp_path))
    with_work = records.groupBy(F.spark_partition_id().alias("task")).agg(F.count("url").alias("n")).collect()
    assert len(with_work) >= spark.sparkContext.defaultParallelism
    assert sum(r["n"] for r in with_work) == len(rows)
