"""SQL fragments for text rules (the classes are those of functions/text.py)."""

from __future__ import annotations

from vacantia.functions.text import SPACE as _SPACE
from vacantia.functions.text import WORD

SPACE = _SPACE


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'), ' ')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def clean_text(x: str) -> str:
    return f"coalesce(regexp_replace({collapse(x)}, '[\\x00-\\x1f]', '', 'g'), '')"


def scrub(x: str) -> str:
    kept = f"regexp_replace({collapse(x)}, '[^{WORD}{SPACE}\\-.]', '', 'g')"
    return f"coalesce({strip(kept)}, '')"


def strip_markup(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '&[a-z]+;', '', 'g')"
    return f"coalesce({collapse(bare)}, '')"


def capitalized(x: str) -> str:
    words = f"string_split({collapse(x)}, ' ')"
    cap = "CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END"
    return f"array_to_string(list_transform({words}, lambda w: {cap} || lower(w[2:])), ' ')"


def has_word(x: str, pattern: str) -> str:
    """``pattern`` stands in ``x`` between word boundaries."""
    return f"regexp_matches({x}, '(?:^|[^{WORD}])(?:{spaced(pattern)})(?:[^{WORD}]|$)')"


def word_position(x: str, pattern: str) -> str:
    """Characters before the first such place."""
    return (
        f"length(regexp_extract({x}, '(?s)^((?:.*?[^{WORD}])??)(?:{spaced(pattern)})(?:[^{WORD}]|$)', 1))"
    )


def replace_word(x: str, pattern: str, name: str) -> str:
    return (
        f"regexp_replace({x}, '(?i)(^|[^{WORD}])(?:{spaced(pattern)})([^{WORD}]|$)', '\\1{name}\\2', 'g')"
    )


def spaced(pattern: str) -> str:
    return pattern.replace("\\s", f"[{SPACE}]")


def unescape(x: str) -> str:
    """The character references that occur in the stored pages."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
                       ("&middot;", "·"), ("&nbsp;", " "), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x
