"""Text columns: tokens, escapes, caps, clean-ups, composite keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from supportlens import values

# (?i) ignore case, (?U) Unicode classes: \w, \d, \s and \b as wide as the source data needs them.
_FLAGS = "(?iU)"
# Runs that no later sign can ask a character back from are made possessive, and a hashtag starts at its first '#' only.
# Matches stay the same; long runs no longer cost the JVM a stack frame a repeat, nor a second pass at each start.
_SHARPENED = {")+": ")++", "[^>]+": "[^>]++", r"\#+": r"(?<!\#)\#++"}


def _token_pattern() -> str:
    pattern = "|".join(values.TOKEN_ALTERNATIVES)
    for plain, sharp in _SHARPENED.items():
        pattern = pattern.replace(plain, sharp)
    return _FLAGS + "(" + pattern + ")"


TOKEN_PATTERN = _token_pattern()
_EMOTICON_ONLY = _FLAGS + "^" + values.EMOTICON + "$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column | str, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is made once a row: written into a function of array items, an expression is made again for every item."""
    return F.element_at(F.transform(F.array(col(value)), use), 1)


def tokens(text: Column | str) -> Column:
    """Social-text tokens in order: emoticon, tag, mention, hashtag, URL, number, word, any other sign."""
    return F.regexp_extract_all(col(text), F.lit(TOKEN_PATTERN), F.lit(1))


def lower_token(token: Column | str) -> Column:
    """Lower case, but an emoticon keeps its shape (':D' stays ':D')."""
    token = col(token)
    return F.when(token.rlike(_EMOTICON_ONLY), token).otherwise(F.lower(token))


def lower_tokens(text: Column | str) -> Column:
    return F.transform(tokens(text), lower_token)


def escape_newlines(text: Column | str, carriage_returns: bool = False) -> Column:
    r"""LF becomes a literal ``\n``; with carriage_returns CR does too, so CRLF yields two."""
    escaped = F.replace(col(text), F.lit("\n"), F.lit("\\n"))
    return F.replace(escaped, F.lit("\r"), F.lit("\\n")) if carriage_returns else escaped


def cap_text(text: Column | str, limit: int) -> Column:
    """First `limit` characters once the UTF-8 form is longer than `limit` bytes."""
    text = col(text)
    return F.when(F.octet_length(text) > limit, F.substring(text, 1, limit)).otherwise(text)


def strip_tags(text: Column | str) -> Column:
    return F.regexp_replace(col(text), values.HTML_TAG, "")


def strip_prefix(url: Column | str, prefix: str) -> Column:
    url = col(url)
    return F.when(url.startswith(prefix), F.substr(url, F.lit(len(prefix) + 1))).otherwise(url)


def commas_to_blanks(text: Column | str) -> Column:
    return F.translate(col(text), ",、，", "   ")


def title_and_body(title: Column | str, body: Column | str) -> Column:
    """Null if either is null, as with string addition."""
    return F.concat(col(title), F.lit(" "), col(body))


def composite_key(*parts: Column | str) -> Column:
    """Parts joined by '#'; an empty part keeps its place, a null part makes the key null."""
    joined: list[Column] = []
    for part in parts:
        joined += [F.lit("#"), col(part).cast("string")]
    return F.concat(*joined[1:])


def load_name(prefix: str, start: str, end: str) -> str:
    """Range-stamped folder of one load."""
    return f"{prefix}/start={start}/end={end}"
