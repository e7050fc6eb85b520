"""Ordered rules, code lists and labels as data, turned into ``CASE WHEN`` expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, any_of, as_column


def _value(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule that holds; an unknown condition does not hold."""
    out = None
    for condition, value in rules:
        out = (
            F.when(condition, _value(value))
            if out is None
            else out.when(condition, _value(value))
        )
    return _value(default) if out is None else out.otherwise(_value(default))


def mentions(text: ColumnLike, pattern: str) -> Column:
    """Whether the pattern is found; plain alternatives are looked up without a regex."""
    column = as_column(text)
    if re.search(r"[\\^$.*+?()\[\]{}]", pattern):
        return F.rlike(column, F.lit(pattern))
    return any_of([F.contains(column, F.lit(word)) for word in pattern.split("|")])


def text_rules(
    text: ColumnLike, rules: Sequence[tuple[str, object]], default: object = None
) -> Column:
    """Value of the first ``(pattern, value)`` whose pattern is found in the text."""
    return first_match([(mentions(text, p), v) for p, v in rules], default)


def recode(value: ColumnLike, labels: Mapping[object, str], keep_unknown: bool = True) -> Column:
    """Code to label through a literal map; codes are compared as text."""
    text = as_column(value).cast("string")
    pairs = [F.lit(x) for x in chain.from_iterable((str(k), v) for k, v in labels.items())]
    label = F.try_element_at(F.create_map(*pairs), text)
    return F.coalesce(label, text) if keep_unknown else label


def category(
    code: ColumnLike, categories: Mapping[str, Sequence[int]], default: str
) -> Column:
    """Category of a numeric status code from ``{category: codes}``."""
    number = as_column(code)
    return first_match([(number.isin(*codes), name) for name, codes in categories.items()], default)


def flag_labels(labels: Mapping[str, tuple[str, str, str]]) -> dict[str, Column]:
    """``{label column: (flag column, text for 1, text for 0)}`` as expressions."""
    return {
        out: F.when(F.col(name).isNull(), None).when(F.col(name) == 1, yes).otherwise(no)
        for out, (name, yes, no) in labels.items()
    }


def keep_for_codes(
    value: ColumnLike, code: ColumnLike, codes: Sequence[object]
) -> Column:
    """The value where the code is in the list, NULL elsewhere."""
    return F.when(as_column(code).isin(*codes), as_column(value))
