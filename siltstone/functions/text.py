"""Text cleansing as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Letters and digits form a word; everything else separates words and is kept.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def blank_to_null(c: Column) -> Column:
    """Strip U+0020 on both sides; an empty result becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def upper_code(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def lower_text(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def title_text(c: Column) -> Column:
    """Capitalise the first character after every non-alphanumeric one.

    ``F.initcap`` starts words at spaces only (``Sci-fi``); warehouse labels
    need ``Sci-Fi`` and ``O'Neil``.
    """
    pieces = F.regexp_extract_all(F.lower(blank_to_null(c)), F.lit(_WORD_OR_GAP), F.lit(1))
    capitalised = F.transform(
        pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))
    )
    return F.array_join(capitalised, "")
