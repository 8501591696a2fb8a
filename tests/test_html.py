import pytest
from pyspark.sql import functions as F

from newsloom.functions.html import PageLayout, decode_entities, decode_utf8, extract_page

CONTAINER = "ok18-single-post-content-wrap"


def page(spark, html, **layout):
    df = spark.createDataFrame([(html,)], "h string")
    row = df.select(extract_page(F.col("h"), PageLayout(**layout)).alias("p")).first().p
    return row.title, row.published_raw, row.content


H1 = '<h1 class="entry-title">A Title</h1>'
DATE = '<div class="ok-news-post-hour"><i></i><span> 2024-06-01 </span><span>x</span></div>'
BODY = f'<div class="{CONTAINER}"><p class="rich-para">One</p>\n<p class="rich-para">Two</p></div>'


@pytest.mark.parametrize(
    "html, expected",
    [
        (H1 + DATE + BODY, ("A Title", "2024-06-01", "One\nTwo")),
        (DATE + BODY, ("", "2024-06-01", "One\nTwo")),
        (H1 + BODY, ("A Title", "", "One\nTwo")),
        (H1 + DATE + "<p>Far</p><p>Near</p>", ("A Title", "2024-06-01", "Far\nNear")),
        ("", ("", "", "")),
        (None, ("", "", "")),
        (f'{H1}<div class="{CONTAINER}"></div><p>outside</p>', ("A Title", "", "")),
        (f'<div class="{CONTAINER}x"><p>a</p></div><div class="w {CONTAINER} z"><div><p>b</p></div><p>c</p></div><p>d</p>', ("", "", "b\nc")),
        (f"<DIV data-x='a>b' CLASS='{CONTAINER}'><P>a<p>b</DIV><p>c", ("", "", "a\nb")),
        (f'<div class="{CONTAINER}"><p>one <b> two </b> three</p><p></p><p>a <!-- <p>no</p> --> b</p></div>', ("", "", "onetwothree\n\nab")),
        (f"<div class={CONTAINER}><p>x<script>'</p>'</script><style>p{{}}</style>y<div>not</div></p></div>", ("", "", "xy")),
        ("<p>a &lt; b &amp;lt; &#2344;&#x928;&copy;&bogus; &nbsp;</p>", ("", "", "a < b &lt; नन©&bogus;")),
        ("<p>1 < 2 and 3 > 2</p><pre>no</pre><param>no</param>", ("", "", "1 < 2 and 3 > 2")),
        ('<h1>no</h1><h1 class="other">no</h1><h1 id=t class="big entry-title">Yes<br> no gap</h1>', ("Yesno gap", "", "")),
    ],
)
def test_pages(spark, html, expected):
    assert page(spark, html) == expected


def test_other_layout(spark):
    html = "<h1>T</h1><article><p>a</p><article><p>b</p></article><p>c</p></article><p>d</p>"
    assert page(spark, html, title_class=None, content_tag="article", content_class=None) == ("T", "", "a\nb\nc")


def test_long_page_is_read_whole(spark):
    html = f'<div class="{CONTAINER}">' + "<div><p>word </p></div>" * 5000 + "</div><p>after</p>"
    assert page(spark, html)[2] == "\n".join(["word"] * 5000)


def test_decode(spark):
    df = spark.createDataFrame([(bytearray("नेपाल".encode() + b"\xff"),)], "b binary")
    assert df.select(decode_utf8(F.col("b"))).first()[0] == "नेपाल�"
    df = spark.createDataFrame([("&amp;amp; &#38;lt; &#xD800; &#1114112;",)], "s string")
    assert df.select(decode_entities(F.col("s"))).first()[0] == "&amp; &lt; &#xD800; &#1114112;"


def test_huge_tags_do_not_end_the_executor(spark):
    long = 'data-x="' + "y" * 1_000_000 + '"'
    bare = "z" * 1_000_000
    assert page(spark, f'<h1 {long} class="entry-title">A</h1>{DATE}') == ("A", "2024-06-01", "")
    assert page(spark, f"<h1 {bare}>no</h1>{H1}{BODY}") == ("A Title", "", "One\nTwo")
    assert page(spark, f'<div class="unclosed {bare}{H1}')[0] == "A Title"
    many = " ".join(f"a{i}=b" for i in range(50_000))
    assert page(spark, f'<h1 {many} class="x entry-title">B</h1>')[0] == "B"


def test_class_is_read_from_its_own_attribute(spark):
    html = "<h1 title=' class=\"entry-title\"'>no</h1><h1 data-class='entry-title'>no</h1><h1 class = 'a entry-title'>yes</h1>"
    assert page(spark, html)[0] == "yes"
