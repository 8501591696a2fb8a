"""Title, date line and paragraphs out of HTML, with column expressions only.

Tag and class names are parameters; the defaults are the page layout of the news site the pipeline was made for.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.patterns import let, rewrite_matches, strip

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"<[a-zA-Z/!?](?:{_ATTRIBUTES}>|[^>]*>)"
# Comments and the elements whose text is not page text. A tag in their place keeps the text before and after apart.
_NOISE = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_SEPARATOR = "<x>"

# Start tags and end tags that end an open paragraph.
_PARAGRAPH_ENDING_STARTS = (
    "address blockquote caption center col colgroup dd dir div dl dt fieldset form h1 h2 h3 h4 h5 h6 hr li"
    " menu ol pre table tbody td tfoot th thead tr ul"
).split()
_PARAGRAPH_ENDING_ENDS = (
    "p address article aside blockquote body center dd dir div dl dt fieldset footer form header html li main"
    " menu nav ol section table tbody td tfoot th thead tr ul"
).split()
_PARAGRAPH_END = (
    rf"(?i)<(?:{'|'.join(_PARAGRAPH_ENDING_STARTS)})(?=[\s/>])|</(?:{'|'.join(_PARAGRAPH_ENDING_ENDS)})(?=[\s>])"
)
_PARAGRAPH_START = rf"(?i)<p(?=[\s/>]){_ATTRIBUTES}>"


@dataclass(frozen=True)
class PageLayout:
    # Tags and classes of the news pages.
    title_tag: str = "h1"
    title_class: str | None = "entry-title"
    date_tag: str = "div"
    date_class: str | None = "ok-news-post-hour"
    date_inner_tag: str = "span"
    content_tag: str = "div"
    content_class: str | None = "ok18-single-post-content-wrap"


LAYOUT = PageLayout()


def decode_utf8(raw: Column) -> Column:
    """Bytes to text; bad bytes become U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))


def decode_entities(col: Column) -> Column:
    """Character references to characters, in one pass, so that ``&amp;lt;`` becomes ``&lt;``."""
    named = {**name2codepoint, "apos": 39}
    table = F.create_map(*[F.lit(x) for name, code in named.items() for x in (name, chr(code))])

    def character(code: Column) -> Column:
        return F.when(
            code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
            F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
        )

    def value(reference: Column) -> Column:
        body = F.regexp_extract(reference, r"&#?[xX]?(\w+)", 1)
        return (
            F.when(reference.rlike("^&#[xX]"), character(F.conv(body, 16, 10).try_cast("bigint")))
            .when(reference.startswith("&#"), character(body.try_cast("bigint")))
            .otherwise(F.try_element_at(table, body))
        )

    pattern = r"&#[xX][0-9a-fA-F]{1,8};?|&#[0-9]{1,10};?|&[a-zA-Z][a-zA-Z0-9]*;"
    # Most pages hold `&amp;` and nothing else, which is one plain replacement.
    return let(
        col,
        lambda text: F.when(text.rlike("&(?!amp;)"), rewrite_matches(text, pattern, value)).otherwise(
            F.replace(text, F.lit("&amp;"), F.lit("&"))
        ),
    )


def strip_join(fragment: Column) -> Column:
    """Text nodes trimmed and joined with nothing between them."""
    nodes = F.split(fragment, _TAG, -1)
    return F.array_join(F.transform(nodes, lambda node: strip(decode_entities(node))), "")


def drop_noise(html: Column) -> Column:
    return F.regexp_replace(html, _NOISE, _SEPARATOR)


# One attribute of a start tag: a name, and a value in either quotes or none. Possessive throughout, so its time is linear.
_ATTRIBUTE = r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?"""


def _has_class(start_tag: Column, token: str) -> Column:
    attributes = F.regexp_extract_all(start_tag, F.lit(_ATTRIBUTE), F.lit(0))
    value = lambda a: F.regexp_replace(a, r"""(?i)^class\s*+=\s*+["']?|["']$""", "")
    return F.exists(attributes, lambda a: a.rlike(r"(?i)^class\s*+=") & F.array_contains(F.split(value(a), r"\s+", -1), token))


def _after_start(html: Column, tag: str, class_token: str | None) -> Column:
    """What follows the first start tag of that name, and of that class if one is named; null when there is none.

    The page is cut before each start tag of the name; a tag is taken as a whole first, then its class is looked up.
    """
    pieces = F.split(html, rf"(?i)(?=<{tag}[\s/>])", -1)
    start = rf"(?i)^<{tag}(?=[\s/>]){_ATTRIBUTES}>"

    def rest(all_pieces: Column) -> Column:
        def fits(piece: Column) -> Column:
            found = F.regexp_extract(piece, start, 0)
            return (found != "") & (F.lit(True) if class_token is None else let(found, lambda t: _has_class(t, class_token)))

        first = F.array_min(F.transform(all_pieces, lambda piece, i: F.when(fits(piece), i)))
        return let(
            first,
            lambda i: F.when(
                i.isNotNull(),
                F.concat(
                    F.regexp_replace(F.get(all_pieces, i), start, ""),
                    F.array_join(F.slice(all_pieces, i + 2, F.size(all_pieces)), ""),
                ),
            ),
        )

    return let(pieces, rest)


def inner_html(html: Column, tag: str, class_token: str | None = None) -> Column:
    """Everything inside the first matching element, or null when there is none.

    The end is found by counting: the rest of the page is cut before each start or end tag of the same name,
    and the element ends where the running depth comes to zero. Without an end tag it runs to the end.
    """
    after = _after_start(html, tag, class_token)

    def close(rest: Column) -> Column:
        pieces = F.split(rest, rf"(?i)(?=</?{tag}[\s/>])", -1)
        state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("size"))

        def step(acc: Column, piece: Column) -> Column:
            move = F.when(piece.rlike(rf"(?i)^</{tag}[\s/>]"), -1).when(piece.rlike(rf"(?i)^<{tag}[\s/>]"), 1)
            depth = acc["depth"] + F.coalesce(move, F.lit(0))
            return F.struct(
                depth.alias("depth"),
                (acc["seen"] + 1).alias("seen"),
                F.coalesce(acc["size"], F.when(depth == 0, acc["seen"])).alias("size"),
            )

        return let(
            pieces,
            lambda all_pieces: let(
                F.aggregate(all_pieces, state, step),
                lambda end: F.array_join(
                    F.slice(all_pieces, F.lit(1), F.coalesce(end["size"], F.size(all_pieces))), ""
                ),
            ),
        )

    return let(after, lambda rest: F.when(rest.isNotNull(), close(rest)))


def paragraphs(region: Column) -> Column:
    """Text of every paragraph of a region, in order; empty paragraphs stay."""
    chunks = F.split(region, _PARAGRAPH_START, -1)
    inside = F.slice(chunks, F.lit(2), F.size(chunks))
    return F.transform(inside, lambda c: strip_join(F.try_element_at(F.split(c, _PARAGRAPH_END, 2), F.lit(1))))


def extract_title(clean: Column, layout: PageLayout = LAYOUT) -> Column:
    return F.coalesce(strip_join(inner_html(clean, layout.title_tag, layout.title_class)), F.lit(""))


def extract_published(clean: Column, layout: PageLayout = LAYOUT) -> Column:
    block = inner_html(clean, layout.date_tag, layout.date_class)
    return F.coalesce(strip_join(inner_html(block, layout.date_inner_tag)), F.lit(""))


def extract_content(clean: Column, layout: PageLayout = LAYOUT) -> Column:
    """Paragraphs of the container joined by line ends; of the whole page when there is no container."""
    region = F.coalesce(inner_html(clean, layout.content_tag, layout.content_class), clean)
    return F.array_join(let(region, paragraphs), "\n")


def extract_page(html: Column, layout: PageLayout = LAYOUT) -> Column:
    """``struct(title, published_raw, content)``; an empty or missing page gives three empty strings."""
    return let(
        drop_noise(F.coalesce(html, F.lit(""))),
        lambda clean: F.struct(
            extract_title(clean, layout).alias("title"),
            extract_published(clean, layout).alias("published_raw"),
            extract_content(clean, layout).alias("content"),
        ),
    )
