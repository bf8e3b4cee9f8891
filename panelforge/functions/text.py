"""Text clean-up as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing text, as does the empty one; compared in any case
# and without the spaces around them.
NULL_TOKENS = ("nan", "none", "null")
_NULL_TOKEN = rf"(?i)\A *(?:{'|'.join(NULL_TOKENS)})? *\z"

# The only six accented letters that comparison keys fold.
ACCENTED = "áéíóúñ"
PLAIN = "aeioun"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup_key(c: str | Column) -> Column:
    """Trimmed (spaces only, as Spark trims) and lower case."""
    return F.lower(F.trim(col_of(c)))


def is_null_token(c: str | Column) -> Column:
    return col_of(c).rlike(_NULL_TOKEN)


def null_if_token(c: str | Column) -> Column:
    return F.when(~is_null_token(c), col_of(c))


def normalise_text(c: str | Column) -> Column:
    """Null tokens become NULL; line breaks and tabs become spaces; then trim.

    The token test comes first, so a lone line break ends as '' and not as NULL.
    """
    return F.when(~is_null_token(c), F.trim(F.regexp_replace(col_of(c), r"[\n\r\t]", " ")))


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def map_category(c: str | Column, mapping: Mapping[str, str], unmatched: str = "keep") -> Column:
    """Case-insensitive dictionary map.

    ``unmatched="keep"`` cleans the text first and keeps unknown values trimmed;
    ``unmatched="upper"`` skips the cleaning and upper-cases unknown values.
    """
    if unmatched not in ("keep", "upper"):
        raise ValueError(f"unmatched must be 'keep' or 'upper', not {unmatched!r}")
    value = normalise_text(c) if unmatched == "keep" else col_of(c)
    rest = F.trim(value) if unmatched == "keep" else F.upper(F.trim(value))
    return F.coalesce(F.try_element_at(literal_map(mapping), lookup_key(value)), rest)


def clean_code(c: str | Column) -> Column:
    """Identifier stored as a float text: '1234.0' becomes '1234'."""
    return F.regexp_replace(F.trim(col_of(c)), r"\.0$", "")


def fold(c: str | Column) -> Column:
    """Lower case, trimmed, without the six accents."""
    return F.translate(lookup_key(c), ACCENTED, PLAIN)


def fold_text(text: str) -> str:
    """The same folding for a Python string."""
    return text.strip().lower().translate(str.maketrans(ACCENTED, PLAIN))


def keyword_pattern(keywords: Iterable[str]) -> str:
    """Alternation of the folded keywords."""
    return "|".join(re.escape(k) for k in dict.fromkeys(map(fold_text, keywords)))


def mentions_any(c: str | Column, keywords: Iterable[str], whole: Iterable[str] = ()) -> Column:
    """True when the folded cell contains a keyword, or equals one of the ``whole`` words."""
    hit = fold(c).rlike(keyword_pattern(keywords))
    whole = [fold_text(w) for w in whole]
    if whole:
        hit = hit | fold(c).isin(*whole)
    return F.coalesce(hit, F.lit(False))


def is_blank(c: str | Column) -> Column:
    return F.coalesce(~col_of(c).rlike(r"\S"), F.lit(True))


def short_label(c: str | Column, width: int, ellipsis: bool = False) -> Column:
    c = col_of(c)
    cut = F.substring(c, 1, width)
    if not ellipsis:
        return cut
    return F.when(F.length(c) > width, F.concat(cut, F.lit("..."))).otherwise(c)
