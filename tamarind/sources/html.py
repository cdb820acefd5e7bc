"""Rows of cells out of page text, by expression only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.text import strip
from tamarind.functions.vectors import once, running_sums

# Character entities that are decoded; the ampersand has to come last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"),
    ("&reg;", "®"), ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"), ("&hellip;", "…"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&laquo;", "«"),
    ("&raquo;", "»"), ("&euro;", "€"), ("&pound;", "£"), ("&deg;", "°"), ("&times;", "×"), ("&amp;", "&"),
)
# Blocks whose content is no text of the page.
_SILENT = r"(?is)<!--.*?-->|<(script|style)(?:\s[^>]*)?>.*?</\1\s*>"


def _inner(tag: str) -> Column:
    return F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>")


def _numeric(text: Column) -> Column:
    """Numeric entities, decimal or hexadecimal, as characters; numbers that name none stay as they are."""

    def decoded(piece: Column, i: Column) -> Column:
        digits = F.regexp_extract(piece, r"^(?:#([0-9]{1,7})|#[xX]([0-9A-Fa-f]{1,6}));", 1)
        hexed = F.regexp_extract(piece, r"^(?:#([0-9]{1,7})|#[xX]([0-9A-Fa-f]{1,6}));", 2)
        code = F.when(digits != "", digits.cast("bigint")).when(hexed != "", F.conv(hexed, 16, 10).cast("bigint"))
        known = code.between(32, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        # The code point as four big-endian bytes is its UTF-32 form.
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.substring(piece, F.instr(piece, ";") + 1, F.length(piece))
        return F.when(i == 0, piece).when(known, F.concat(sign, rest)).otherwise(F.concat(F.lit("&"), piece))

    return F.when(
        F.contains(text, F.lit("&#")), F.array_join(F.transform(F.split(text, "&"), decoded), "")
    ).otherwise(text)


def plain_text(html: Column) -> Column:
    """Scripts, styles, comments and markup removed, entities decoded, outer blanks trimmed."""
    text = F.regexp_replace(F.regexp_replace(html, _SILENT, ""), r"(?s)<[^>]*>", "")
    text = _numeric(text)
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return strip(text)


def element_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element, null when the page has none."""
    return plain_text(F.get(F.regexp_extract_all(html, _inner(tag), F.lit(1)), F.lit(0)))


def elements(html: Column, tag: str) -> Column:
    """Content of every ``tag`` element of a text, nested ones too, in the order in which they begin.

    The text is cut before each opening and closing tag. A tag's level is the number of elements open around it; at one
    level openings and closings take turns, so sorting by (level, place) puts every opening next to its closing. An
    element that is never closed runs to the end of the text; a closing tag without an opening is ignored. Null gives
    null, a text without the tag an empty array.
    """
    pieces = F.split(html, rf"(?i)(?=<{tag}(?:\s[^>]*)?>)|(?=</{tag}\s*>)")
    opening, closing = rf"(?is)^<{tag}(?:\s[^>]*)?>", rf"(?is)^</{tag}\s*>"

    def contents(parts: Column) -> Column:
        steps = F.transform(
            parts, lambda p: F.when(p.rlike(opening), 1).when(p.rlike(closing), -1).otherwise(0)
        )

        def pairs(step: Column) -> Column:
            def tags(depth: Column) -> Column:
                # An opening stands at the depth after it, a closing at the depth before it.
                placed = F.zip_with(
                    step, F.transform(depth, lambda d, i: F.struct(d.alias("d"), i.alias("i"))),
                    lambda s, x: F.struct(
                        F.when(s == 1, x["d"]).otherwise(x["d"] + 1).alias("level"), x["i"].alias("at"), s.alias("step")
                    ),
                )
                return F.array_sort(F.filter(placed, lambda t: t["step"] != 0))

            return once(
                once(running_sums(step), tags),
                lambda ts: F.array_sort(
                    F.filter(
                        F.transform(
                            ts,
                            lambda t, j: F.struct(
                                t["at"].alias("at"),
                                F.when(
                                    (F.get(ts, j + 1)["level"] == t["level"]) & (F.get(ts, j + 1)["step"] == -1),
                                    F.get(ts, j + 1)["at"],
                                ).otherwise(F.size(parts)).alias("to"),
                                t["step"].alias("step"),
                            ),
                        ),
                        lambda e: e["step"] == 1,
                    )
                ),
            )

        return F.transform(
            once(steps, pairs),
            lambda e: F.regexp_replace(
                F.array_join(F.slice(parts, e["at"] + 1, e["to"] - e["at"]), ""), F.lit(opening), F.lit("")
            ),
        )

    return F.when(html.isNotNull(), once(pieces, contents))


def table_rows(
    pages: DataFrame,
    html: str = "html",
    container: str = "tbody",
    row: str = "tr",
    cell: str = "td",
    position: int = 1,
    cells: tuple[str, ...] = ("date_text", "revenue_text"),
) -> DataFrame:
    """Rows of the container at zero-based ``position`` of every page, one output column per named cell.

    Containers, rows and cells are counted in the order in which they begin, nested ones too, and each goes on to its own
    closing tag: a table inside a cell is part of that cell, and its rows are rows as well. Scripts, styles and comments
    hold no elements. A page with fewer containers gives no rows. ``row_no`` keeps the order inside a page.
    """
    body = F.get(elements(F.regexp_replace(F.col(html), _SILENT, ""), container), F.lit(position))
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.posexplode(elements(body, row)).alias("row_no", "row_html"))
    found = rows.select(*keep, "row_no", elements(F.col("row_html"), cell).alias("_cells"))
    return found.select(
        *keep, "row_no", *[plain_text(F.get("_cells", F.lit(i))).alias(name) for i, name in enumerate(cells)]
    )
