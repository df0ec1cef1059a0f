"""Column functions on event text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: words end at Unicode white space (no-break space included) or at ASCII
# punctuation.
WORD_BREAK = r"[\p{IsWhite_Space}!-/:-@\[-`{-~]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(content) -> Column:
    """Lower-case words of a text, none of them empty."""
    return F.filter(F.split(F.lower(_col(content)), WORD_BREAK), lambda w: w != "")


def unique_word_ratio(content) -> Column:
    """Distinct words / words; 1.0 for a text without words."""
    words = tokens(F.coalesce(_col(content), F.lit("")))
    # One lambda pass over the text: the word array is bound once, then measured.
    sizes = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_distinct(w)).cast("double") / F.size(w).cast("double")
        ),
    )
    return F.element_at(sizes, 1)


def parse_tags(text) -> Column:
    """``"[7001, 1667]"`` to an array of numbers; missing or empty lists become ``[]``."""
    digits = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(r"\d+"), F.lit(0))
    return F.filter(F.transform(digits, lambda d: d.try_cast("bigint")), lambda t: t.isNotNull())
