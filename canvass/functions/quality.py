"""Text-quality test for short free-text answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column, let
from canvass.functions.rules import mentions
from canvass.functions.text import fold_latin, trim_all

# Neighbouring keys that betray a hand run over the keyboard.
KEYBOARD_RUNS = "qwer|asdf|sdfg|dfgh|ghjk|zxcv|cvbn|vbnm|wert|tyui|uio"
CONSONANT_RUN = "[bcdfghjklmnpqrstvwxyz]{4,}"
VOWELS = "[aeiou]"


def is_garbage(
    value: ColumnLike,
    *,
    exempt_words: int = 3,
    min_unique_ratio: float = 0.35,
    longer_than: int = 5,
    no_vowel_length: int = 4,
) -> Column:
    """1 for a short text that looks like random typing, else 0.

    Texts of ``exempt_words`` or more words are accepted, as are empty and NULL ones. That
    test stops at the deciding word, so long texts are neither folded nor counted.
    """
    raw = as_column(value)
    exempt = rf"(?:[^\s\p{{Z}}]+[\s\p{{Z}}]+){{{exempt_words - 1}}}[^\s\p{{Z}}]"

    def short_text(text: Column) -> Column:
        length = F.length(text)
        unique = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?s)."), F.lit(0))))
        return (
            F.when(text == "", 0)
            .when(mentions(text, KEYBOARD_RUNS), 1)
            .when((length > longer_than) & (unique / length < min_unique_ratio), 1)
            .when((length >= no_vowel_length) & ~F.rlike(text, F.lit(VOWELS)), 1)
            .when((length > longer_than) & F.rlike(text, F.lit(CONSONANT_RUN)), 1)
            .otherwise(0)
        )

    judged = let(let(F.lower(trim_all(raw)), fold_latin), short_text)
    return F.when(raw.isNull() | F.rlike(raw, F.lit(exempt)), 0).otherwise(judged)
