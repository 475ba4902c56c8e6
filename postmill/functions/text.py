"""Text and flag expressions. All are built-in functions, so they stay in generated code."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill import settings

# Fixed value: the ASCII control characters. They are deleted, not turned into spaces.
CONTROL_CHARACTERS = r"[\x00-\x1f\x7f]"


def tidy(text: str | Column) -> Column:
    """Delete control characters, then trim spaces (only U+0020)."""
    return F.trim(F.regexp_replace(text, CONTROL_CHARACTERS, ""))


def null_if_in(text: Column, placeholders: Sequence[str]) -> Column:
    return F.when(~text.isin(*placeholders), text)


def flair(text: str | Column) -> Column:
    """Lower-case label; only a null becomes the placeholder, an empty label stays empty."""
    return F.coalesce(F.lower(F.trim(text)), F.lit(settings.MISSING_FLAIR))


def flag(text: str) -> Column:
    """'True'/'False' text as boolean, null for anything else, also under ANSI mode."""
    return F.col(text).try_cast("boolean")


def joined(head: Column, tail: Column) -> Column:
    """Both parts with a space between, or whichever of the two is there."""
    return F.coalesce(F.concat(head, F.lit(" "), tail), head, tail)


def first_chars(text: str | Column, count: int | None) -> Column:
    """The first ``count`` code points, or the whole text for ``None``."""
    column = F.col(text) if isinstance(text, str) else text
    return column if count is None else F.substring(column, 1, count)
