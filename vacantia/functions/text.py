"""Text column expressions shared by the cleaners and extractors.

Python's ``\\w`` and ``\\s`` are Unicode classes, Java's are ASCII.  The classes below are
written out so that a Java pattern accepts the same characters.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Members of the two character classes (fixed values).
WORD = r"a-zA-Z0-9_\p{L}\p{N}"
SPACE = (
    r"\t\n\x0B\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# A word boundary in terms of WORD.
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_bounded(body: str, right: bool = True) -> str:
    """``\\b body \\b`` as a Java pattern, ``\\b`` and ``\\s`` being Unicode-aware.

    Where the body starts with plain letters they are put first and the look-behind after
    them: a literal start lets the matcher skip through a text, a look-behind does not.
    """
    while body.startswith(r"\b"):
        body = body[2:]
    while right and body.endswith(r"\b"):
        body = body[:-2]
    left, rest = EDGE, body
    start = re.match(r"\w+(?![\w*+?{])", body)
    if start and "|" not in body:
        word = start.group(0)
        left, rest = f"{word}(?<![{WORD}]{word})", body[len(word):]
    plain_end = re.search(r"(?:^|[^\\])\w$", body) and "|" not in body
    end = "" if not right else f"(?![{WORD}])" if plain_end else EDGE
    return left + rest.replace(r"\b", EDGE).replace(r"\s", f"[{SPACE}]") + end


def any_word(bodies: list[str]) -> str:
    """One pattern for several bodies, each of which starts and ends with a word character.

    The look-behind comes first here: it rules out most places before any body is tried.
    """
    spaced = "|".join(bodies).replace(r"\s", f"[{SPACE}]")
    return f"(?<![{WORD}])(?:{spaced})(?![{WORD}])"


def collapse(c: Column) -> Column:
    """Runs of whitespace become one space; ends are trimmed."""
    # Single spaces, by far the most, need no replacement.
    return F.trim(F.regexp_replace(c, f"[{SPACE}]{{2,}}|[{SPACE}&&[^ ]]", " "))


def strip(c: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def clean_text(c: Column) -> Column:
    """Null gives "", whitespace is collapsed, then control characters are dropped."""
    return F.coalesce(F.regexp_replace(collapse(c), r"[\x00-\x1f]", ""), F.lit(""))


def truncate_text(c: Column, limit: int = 5000) -> Column:
    return F.substring(c, 1, limit)


def strip_markup(c: Column) -> Column:
    """Remove tags, delete (not decode) ``&name;`` references, collapse whitespace."""
    bare = F.when(
        c.rlike("[<&]"), F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), "&[a-z]+;", "")
    ).otherwise(c)
    return F.coalesce(collapse(bare), F.lit(""))


def scrub_text(c: Column) -> Column:
    """Keep word characters, whitespace, ``-`` and ``.`` only."""
    kept = F.regexp_replace(collapse(c), rf"[^{WORD}{SPACE}\-.]+", "")
    return F.coalesce(F.trim(kept), F.lit(""))


def capitalize_words(c: Column) -> Column:
    return F.initcap(F.regexp_replace(collapse(c), "(^| )ß", "$1Ss"))


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def contains_any(c: Column, words: list[str]) -> Column:
    """True if any of the literal words occurs in ``c``."""
    return c.rlike("|".join(rf"\Q{word}\E" for word in words))
