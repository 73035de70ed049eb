"""Field access on stored HTML by column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from vacantia.functions import text as tx

# What ``html.unescape`` replaces (its pattern; the classes are the same in Java).
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _characters(cells: pd.Series) -> pd.Series:
    return cells.map(lambda refs: None if refs is None else {r: html.unescape(r) for r in refs})


# Declared non-deterministic so that a filter on a decoded field is not moved below the
# decoding, which would decode every page twice.
_characters = _characters.asNondeterministic()


def _references(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(REFERENCE), 0)


def _replaced(c: Column, known: Column) -> Column:
    """``c`` with every reference replaced by its characters in the map ``known``."""
    whole = F.zip_with(
        F.split(c, REFERENCE), _references(c), lambda text, ref: F.concat(text, F.coalesce(known[ref], F.lit("")))
    )
    return F.when(c.contains("&"), F.array_join(whole, "")).otherwise(c)


def decode_entities(c: Column) -> Column:
    """Character references to characters; the full table is in the standard library.

    Only the distinct references of a text go to Python, so its memory does not follow the size of the texts.
    """
    known = _characters(F.array_distinct(_references(c)))
    return tx.let(F.struct(c.alias("text"), known.alias("known")), lambda both: _replaced(both["text"], both["known"]))


def decode_each(c: Column) -> Column:
    """The same for an array of strings."""
    known = _characters(F.array_distinct(F.flatten(F.transform(F.filter(c, lambda cell: cell.isNotNull()), _references))))
    return tx.let(
        F.struct(c.alias("cells"), known.alias("known")),
        lambda both: F.transform(both["cells"], lambda cell: _replaced(cell, both["known"])))


def _attr(name: str) -> str:
    return rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute inside one opening tag, null if it is absent."""
    pattern = _attr(name)
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(pattern), value)


def elements(page: Column, tag: str) -> Column:
    """All ``<tag ...>inner</tag>`` texts, in order; the tag must not nest in itself."""
    return F.regexp_extract_all(page, F.lit(rf"(?is)(<{tag}(?:\s[^>]*)?>.*?)(?:</{tag}\s*>|$)"), 1)


def opening(element: Column) -> Column:
    return F.regexp_extract(element, r"(?s)^(<[^>]*>)", 1)


def inner(element: Column) -> Column:
    return F.regexp_replace(element, r"(?s)^<[^>]*>", "")


def without_hidden(page: Column) -> Column:
    """Drop comments, doctype, scripts, styles and templates: they are not page text."""
    visible = F.regexp_replace(page, r"(?s)<!--.*?(?:-->|$)|(?i)<!doctype[^>]*>", "")
    hidden = r"(?is)<(script|style|template)(?:\s[^>]*)?>.*?(?:</\1\s*>|$)"
    return F.regexp_replace(visible, hidden, "")


def bare_text(fragment: Column) -> Column:
    """Text of a fragment: tags removed, references decoded."""
    return decode_entities(F.regexp_replace(fragment, "<[^>]+>", ""))


def page_text(page: Column) -> Column:
    """Text of a whole visible page; line breaks of the source are kept."""
    return bare_text(page)


def element_text(element: Column) -> Column:
    """Cleaned text of one element."""
    return tx.strip_markup(bare_text(inner(element)))


def has_class(element: Column, *names: str) -> Column:
    classes = F.split(tx.collapse(F.coalesce(attribute(opening(element), "class"), F.lit(""))), " ")
    hit = F.lit(True)
    for name in names:
        hit = hit & F.array_contains(classes, name)
    return hit


def first_match(page: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null if the pattern is not found."""
    return F.when(page.rlike(pattern), F.regexp_extract(page, pattern, group))


def marked_texts(page: Column, markers: list[str]) -> Column:
    """Per marker the text of the first element whose opening tag matches it, or null.

    The matching end tag is found by counting nested openings of the same tag: what follows the opening is cut
    before each tag of that name, and the pieces up to the one that closes the element are kept.
    """
    def content(marker: str) -> Column:
        start = rf"(?iu)<([a-z][a-z0-9]*)(?:\s[^>]*)?\s{marker}[^>]*>".replace(r"\s", f"[{tx.SPACE}]")
        tag = F.concat(F.lit("(?iu)(?=</?"), F.regexp_extract(page, start, 1), F.lit(f"[{tx.SPACE}>/])"))
        # The dot keeps a tag at the very start from being lost: nothing is cut before the first character.
        return tx.let(F.split(F.concat(F.lit("."), F.get(F.split(page, start, 2), F.lit(1))), tag), lambda pieces: F.when(
            pieces.isNotNull(), F.substring(F.array_join(F.slice(pieces, 1, kept(pieces)), ""), 2, 1 << 30)))

    def kept(pieces: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            depth = state["depth"] + F.when(piece.startswith("</"), -1).otherwise(1)
            return F.when(state["depth"] == 0, state).otherwise(F.struct(
                depth.alias("depth"), (state["kept"] + F.when(depth == 0, 0).otherwise(1)).alias("kept")))

        first = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("kept"))
        return F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, step, lambda state: state["kept"])

    bare = F.transform(F.array(*[content(m) for m in markers]), lambda c: F.regexp_replace(c, "<[^>]+>", ""))
    return F.when(page.isNotNull(), F.transform(decode_each(bare), tx.strip))
