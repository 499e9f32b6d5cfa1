"""Text expressions: prefixes, payloads, token splitting, truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import config

PREFIXES = {
    "query": config.QUERY_PREFIX,
    "document": config.DOCUMENT_PREFIX,
    "encode": config.ENCODE_PREFIX,
}

# Scripts whose characters are no part of a word: Han and Hiragana characters
# are tokens of their own, Katakana runs stay together. Latin-1 letters come
# first in the word class, the cheap test for most text; combining marks stay with
# their letters.
_SINGLE = r"\p{IsHan}\p{IsHiragana}"
_RUN = r"\p{IsKatakana}ー"
TOKEN_PATTERN = rf"[a-z0-9ß-öø-ÿ[\p{{L}}\p{{N}}\p{{M}}&&[^{_SINGLE}{_RUN}]]]+|[{_RUN}]+|[{_SINGLE}]"


def with_prefix(text: Column, prefix: str | None = None, mode: str = "query") -> Column:
    """Prefixed text. ``prefix=None`` takes the prefix of ``mode``; an empty
    string is a real override."""
    chosen = PREFIXES[mode] if prefix is None else prefix
    return F.concat(F.lit(chosen), text)


def as_text(column: Column, null_text: str | None = None) -> Column:
    """Any column as text; ``null_text`` replaces nulls, else they stay null."""
    text = column.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def payload_of(key: str, text: Column) -> Column:
    """Payload map with one entry."""
    return F.create_map(F.lit(key), text)


def payload_value(payload: Column, key: str, default: str = "") -> Column:
    """Value under ``key``; ``default`` only where the key is missing."""
    return F.when(F.map_contains_key(payload, key), F.element_at(payload, key)).otherwise(F.lit(default))


def tokens(text: Column) -> Column:
    """Lower-cased words; Han and Hiragana characters one by one, Katakana runs
    in one piece."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def truncate_tokens(token_array: Column, max_tokens: int) -> Column:
    """The part of a token list a model with ``max_tokens`` inputs would see."""
    return F.slice(token_array, 1, max_tokens)
