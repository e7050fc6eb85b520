"""Text helpers as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column, let

# The characters with the Unicode property White_Space, as regex ranges.
WHITE_BUT_BLANK = r"\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F)

# Capital letters folded when two identities are compared.
CAPITAL_FOLDS = {"Á": "A", "É": "E", "Í": "I", "Ó": "O", "Ú": "U", "Ñ": "N"}

# Latin letters that do not decompose into a letter plus marks.
LETTER_FOLDS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L",
    "ħ": "h", "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T",
}


# The blocks of Latin letters beyond ASCII.
LATIN_BLOCKS = ((0xC0, 0x250), (0x1E00, 0x1F00), (0x2C60, 0x2C80), (0xA720, 0xA800), (0xAB30, 0xAB70), (0xFB00, 0xFB07), (0xFF21, 0xFF5B))


@cache
def latin_folds() -> dict[str, str]:
    """Every Latin letter that Unicode decomposes into ASCII letters and marks, and the few others of the list above.

    Ligatures and letter pairs are written out, wide letters become plain ones.
    """
    folds = {}
    for first, end in LATIN_BLOCKS:
        for letter in map(chr, range(first, end)):
            plain = "".join(ch for ch in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(ch))
            if plain != letter and plain.isascii() and plain.isalpha():
                folds[letter] = plain
    return folds | LETTER_FOLDS


def _single_letter_folds() -> tuple[str, str]:
    """Letters that become one letter, and these, for ``translate``."""
    single = {letter: plain for letter, plain in latin_folds().items() if len(plain) == 1}
    return "".join(single), "".join(single.values())


def trim_all(value: ColumnLike) -> Column:
    """Strip every kind of white space at both ends."""
    return F.trim(as_column(value), F.lit(WHITE_CHARS))


def squish(value: ColumnLike) -> Column:
    """Strip the ends and reduce inner white space to one blank.

    Single blanks, by far the most frequent case, are not matched at all.
    """
    runs = f"[{WHITE_BUT_BLANK}][ {WHITE_BUT_BLANK}]*| [ {WHITE_BUT_BLANK}]+"
    return F.trim(F.regexp_replace(as_column(value), runs, " "))


def fold_latin(value: ColumnLike) -> Column:
    """Latin letters without accents; two-letter ligatures are written out."""
    text = as_column(value)
    source, target = _single_letter_folds()
    out = F.translate(text, source, target)
    pairs = {letter: plain for letter, plain in latin_folds().items() if len(plain) > 1}

    def written_out(t: Column) -> Column:
        for letter, plain in pairs.items():
            t = F.replace(t, F.lit(letter), F.lit(plain))
        return t

    # few texts have them, and one look tells which
    out = let(out, lambda t: F.when(F.rlike(t, F.lit(f"[{''.join(pairs)}]")), written_out(t)).otherwise(t))

    def without_loose_marks(t: Column) -> Column:
        # few texts hold loose marks, and only these pay for looking behind each character
        return F.when(
            F.rlike(t, F.lit(r"\p{Mn}")), F.regexp_replace(t, r"(?<=[\p{IsLatin}0-9])\p{Mn}+", "")
        ).otherwise(t)

    folded = let(out, without_loose_marks)
    return F.when(F.rlike(text, F.lit(r"[^\x00-\x7f]")), folded).otherwise(text)


def fold_capitals(value: ColumnLike) -> Column:
    """Upper case, then the fixed capital folds only."""
    out = F.upper(as_column(value))
    for letter, plain in CAPITAL_FOLDS.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def strip_html(value: ColumnLike) -> Column:
    return F.regexp_replace(as_column(value), r"<[^>]*>", "")


def truncate(value: ColumnLike, width: int = 45, ellipsis: str = "...") -> Column:
    """Cut to ``width`` characters, the ellipsis included."""
    text = as_column(value)
    cut = F.concat(F.substring(text, 1, width - len(ellipsis)), F.lit(ellipsis))
    return F.when(F.length(text) > width, cut).otherwise(text)


def strip_prefix(value: ColumnLike, pattern: str) -> Column:
    return F.regexp_replace(as_column(value), f"^(?:{pattern})", "")


def extract(value: ColumnLike, pattern: str, group: int = 0) -> Column:
    """First match, NULL where there is none."""
    return F.nullif(F.regexp_extract(as_column(value), pattern, group), F.lit(""))


def paste(*values: ColumnLike, sep: str = " ", missing: str = "NA") -> Column:
    """Concatenate with a separator; a NULL part is written as ``missing``."""
    parts = [F.coalesce(as_column(v).cast("string"), F.lit(missing)) for v in values]
    return F.concat_ws(sep, *parts)


def blank_safe(value: ColumnLike) -> Column:
    """NULL, empty and the text ``NA`` become an empty text."""
    text = as_column(value).cast("string")
    return F.when(text.isNull() | text.isin("", "NA"), "").otherwise(text)


def address_text(
    parts: Sequence[tuple[str, ColumnLike]], only_if_any_part: bool = False
) -> Column:
    """One address line from ``(fixed words, column)`` parts.

    The fixed words are always written, so the result is never NULL unless
    ``only_if_any_part`` is set and every column is blank.
    """
    pieces: list[Column] = []
    for words, value in parts:
        if words:
            pieces.append(F.lit(words))
        pieces.append(blank_safe(value))
    line = squish(F.concat_ws(" ", *pieces))
    if not only_if_any_part:
        return line
    filled = F.concat(*[blank_safe(v) for _, v in parts]) != ""
    return F.when(filled, line)


def block_label(value: ColumnLike, word: str = "Manzana") -> Column:
    """``"Manzana 12"`` from any text holding the number 12; ``"Manzana NA"`` without one."""
    return paste(F.lit(word), extract(as_column(value).cast("string"), r"\d+"))


def number_text(value: ColumnLike, digits: int) -> Column:
    """A rounded number as text without a trailing ``.0``."""
    text = F.round(as_column(value), digits).cast("decimal(38,6)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", r"$1"), r"\.$", "")


def label_text(
    label: ColumnLike,
    name: ColumnLike,
    overrides: Mapping[str, str] | None = None,
    width: int = 45,
) -> Column:
    """Question label for reports: HTML out, fixed overrides by name, trimmed, cut."""
    text = strip_html(label)
    for key, fixed in (overrides or {}).items():
        text = F.when(as_column(name) == key, fixed).otherwise(text)
    return truncate(trim_all(text), width)
