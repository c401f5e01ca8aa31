"""Fields of stored HTML pages, read with regular expressions inside the JVM.

Loops in the patterns are possessive where they can run over a whole page, so
that a long page cannot exhaust the thread's stack.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.functions.text import bind, literal_map, trim_ws

# Word ratings, as the last class of the rating node.
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# Named character references, without '&' and ';'.
NAMED_REFERENCES = {**{name: chr(point) for name, point in name2codepoint.items()}, "apos": "'"}

# Link patterns; their group is the attribute's value as written, with its quotes if it has any.
_HREF = r"""<a(?=\s)(?:"[^"]*+"|'[^']*+'|[^>"'\s]++|\s(?!\s*href\s*=))*+\s\s*href\s*=\s*("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
LINK = f"(?is){_HREF}"
PRODUCT_LINK = rf"(?is)<h3\b[^>]*>\s*{_HREF}"


def _with_class(tag: str, name: str) -> str:
    return rf"""<{tag}\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'][^>]*>"""


NEXT_LINK = rf"(?is){_with_class('li', 'next')}\s*{_HREF}"
CATEGORY_MENU = rf"(?is){_with_class('ul', 'nav-list')}.*?<ul\b[^>]*>(.*?)</ul>"

# Pieces of markup: comments and scripts as a whole, tags, text.
_HIDDEN = r"<!--.*?(?:-->|\z)|<script\b[^>]*+>.*?(?:</script\s*+>|\z)|<style\b[^>]*+>.*?(?:</style\s*+>|\z)"
_PIECE = rf"(?is){_HIDDEN}|<[/!?a-z][^>]*+>|(?:[^<]|<(?![/!?a-z]))++"
# Pieces that neither open nor close a node with content.
_NO_CONTENT = (
    r"(?i)^<(?:[!?]|script\b|style\b|/?(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)\b)"
)
_TAG = "(?i)^<[/!?a-z]"


def _pieces(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0))


def direct_texts(body: Column) -> Column:
    """The text nodes of a node's content that don't lie in further nodes, as they are written."""

    def step(state: Column, piece: Column) -> Column:
        depth, texts = state["depth"], state["texts"]

        def to(d: Column, t: Column = texts) -> Column:
            return F.struct(d.alias("depth"), t.alias("texts"))

        return (
            F.when(~piece.rlike(_TAG), to(depth, F.when(depth == 0, F.concat(texts, F.array(piece))).otherwise(texts)))
            .when(piece.rlike(_NO_CONTENT), to(depth))
            .when(piece.startswith("</"), to(F.greatest(depth - 1, F.lit(0))))
            .otherwise(to(depth + 1))
        )

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("texts"))
    walked = F.aggregate(_pieces(body), start, step, lambda state: state["texts"])
    plain = F.when(body == "", F.array().cast("array<string>")).otherwise(F.array(body))
    return F.when(F.contains(body, F.lit("<")), walked).otherwise(plain)


def _child_text(rest: Column) -> Column:
    """First text of the paragraphs right below a node, of which `rest` is the content and all that follows it.

    Nodes in it may nest, also in nodes of its own kind; the walk is over when more nodes are closed than were opened.
    """

    def step(state: Column, piece: Column) -> Column:
        depth, inside, found = state["depth"], state["inside"], state["found"]
        paragraph = piece.rlike(r"(?i)^<p[\s/>]")

        def to(d: Column, i: Column = inside, f: Column = found) -> Column:
            return F.struct(d.alias("depth"), i.alias("inside"), f.alias("found"))

        here = inside & (depth == 1)
        return (
            F.when(found.isNotNull() | (depth < 0), state)
            .when(~piece.rlike(_TAG), to(depth, f=F.when(here, piece)))
            .when(piece.rlike(_NO_CONTENT), to(depth))
            .when(piece.startswith("</"), to(depth - 1, inside & (depth > 1)))
            .when(here & paragraph, state)  # a paragraph that begins ends the one before
            .otherwise(to(depth + 1, F.when(depth == 0, paragraph).otherwise(inside)))
        )

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("inside"), F.lit(None).cast("string").alias("found")
    )
    return F.aggregate(_pieces(rest), start, step, lambda state: state["found"])


def _reference(token: Column) -> Column:
    """One token: a character reference becomes its character, anything else stays."""
    decimal = F.regexp_extract(token, "^&#0*([0-9]{1,7});$", 1)
    hexadecimal = F.regexp_extract(token, "^&#[xX]0*([0-9A-Fa-f]{1,6});$", 1)
    digits = F.upper(F.when(hexadecimal != "", hexadecimal).otherwise(F.hex(decimal.try_cast("bigint"))))
    padded = F.lpad(digits, 8, "0")
    known = (padded <= "0010FFFF") & (padded > "00000000") & ~padded.between("0000D800", "0000DFFF")
    char = F.when(known, F.decode(F.unhex(F.when(known, padded)), "UTF-32")).otherwise("\ufffd")
    named = F.try_element_at(literal_map(NAMED_REFERENCES), F.regexp_extract(token, "^&(.*);$", 1))
    return (
        F.when(token.rlike("^&#(?:[0-9]+|[xX][0-9A-Fa-f]+);$"), char)
        .when(token.startswith("&"), F.coalesce(named, token))
        .otherwise(token)
    )


def decode_references(c: Column) -> Column:
    """Named and numeric character references to the characters they stand for."""

    def decoded(raw: Column) -> Column:
        pattern = "(?s)&(?:#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+);|[^&]++|&"
        tokens = F.regexp_extract_all(raw, F.lit(pattern), F.lit(0))
        text = F.array_join(F.transform(tokens, _reference), "")
        return F.when(F.contains(raw, F.lit("&")), text).otherwise(raw)

    return bind(c, decoded)


def visible(html: Column) -> Column:
    """The markup without comments, scripts and styles: what selectors see. An unclosed one goes on to the end."""
    bare = F.regexp_replace(html, f"(?is){_HIDDEN}", "<wbr>")
    return F.when(html.rlike(r"(?i)<(?:!--|script\b|style\b)"), bare).otherwise(html)


def links(html: Column, pattern: str = LINK) -> Column:
    """All link targets that match `pattern`, in page order; none from comments, scripts and styles."""
    written = F.regexp_extract_all(visible(html), F.lit(pattern), F.lit(1))
    return F.transform(written, lambda w: decode_references(F.regexp_replace(w, "^[\"']|[\"']$", "")))


def category_links(html: Column) -> Column:
    return links(F.regexp_extract(visible(html), CATEGORY_MENU, 1))


def _bodies(html: Column, opening: str, tag: str) -> Column:
    """Contents of all nodes that match `opening`, in `visible` markup."""
    return F.regexp_extract_all(html, F.lit(f"(?is){opening}(.*?)</{tag}\\s*>"), F.lit(1))


def _texts(html: Column, opening: str, tag: str) -> Column:
    return F.flatten(F.transform(_bodies(html, opening, tag), direct_texts))


def _written(text: Column, default: str = "") -> Column:
    return F.coalesce(trim_ws(decode_references(text)), F.lit(default))


def first_text(html: Column, opening: str, tag: str) -> Column:
    """First text right below the nodes that match `opening`; '' when there is none."""
    return _written(F.get(_texts(html, opening, tag), F.lit(0)))


def heading(html: Column) -> Column:
    return first_text(html, r"<h1\b[^>]*>", "h1")


def text_of_class(html: Column, tag: str, name: str) -> Column:
    return first_text(html, _with_class(tag, name), tag)


def last_text_of_class(html: Column, tag: str, name: str, default: str) -> Column:
    """Last text right below such nodes, '' when they have none; `default` when no node exists."""
    opening = _with_class(tag, name)
    last = F.try_element_at(_texts(html, opening, tag), F.lit(-1))
    return F.when(html.rlike(f"(?is){opening}"), _written(last)).otherwise(F.lit(default))


def breadcrumb(html: Column, position: int) -> Column:
    """Link text of the n-th breadcrumb."""
    trail = F.regexp_extract(html, rf"(?is){_with_class('ul', 'breadcrumb')}(.*?)</ul>", 1)
    items = F.regexp_extract_all(trail, F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    return first_text(F.coalesce(F.get(items, F.lit(position - 1)), F.lit("")), r"<a\b[^>]*>", "a")


def direct_paragraph(html: Column, tag: str, name: str) -> Column:
    """First text of a <p> right below the node, whatever lies in its other nodes."""
    return _written(_child_text(F.regexp_extract(html, f"(?is){_with_class(tag, name)}(.*)", 1)))


def table_map(html: Column, name: str = "table") -> Column:
    """Rows with a <th> key and a <td> value of tables of a class, as a map; the last of equal keys wins."""
    tables = F.array_join(_bodies(html, _with_class("table", name), "table"), "<tr>")
    rows = F.regexp_extract_all(tables, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr\b|<tr\b|$)"), F.lit(1))

    def cell(row: Column, tag: str) -> Column:
        body = F.regexp_extract(row, rf"(?is)<{tag}\b[^>]*>(.*?)(?=</{tag}\b|<t[hd]\b|$)", 1)
        return decode_references(F.get(direct_texts(body), F.lit(0)))

    cells = F.filter(
        F.transform(rows, lambda r: F.struct(cell(r, "th").alias("k"), F.coalesce(cell(r, "td"), F.lit("")).alias("v"))),
        lambda c: c["k"].isNotNull(),
    )

    def last_of_each(found: Column) -> Column:
        keys, values = F.reverse(found["k"]), F.reverse(found["v"])
        unique = F.array_distinct(keys)
        return F.map_from_arrays(
            unique, F.transform(unique, lambda k: F.get(values, (F.array_position(keys, k) - 1).cast("int")))
        )

    return bind(cells, last_of_each)


def word_rating(classes: Column) -> Column:
    """Rating from a class attribute such as 'star-rating Two'; 0 when unknown."""
    word = F.element_at(F.split(trim_ws(classes), r"\s+"), -1)
    return F.coalesce(F.try_element_at(literal_map(RATING_WORDS), word), F.lit(0))


def rating_classes(html: Column, tag: str = "p", name: str = "star-rating") -> Column:
    pattern = rf"""(?is)<{tag}\b[^>]*\bclass\s*=\s*["']((?:[^"']*\s)?{name}(?:\s[^"']*)?)["']"""
    return F.regexp_extract(html, pattern, 1)
