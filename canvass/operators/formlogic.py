"""Missing and skipped answers, judged by the form's own rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import as_column, by_regex, row_sum
from canvass.functions.numbers import flag
from canvass.functions.text import strip_prefix


@dataclass(frozen=True)
class FormRule:
    """One question: whether it must be answered, and when it is asked (a SQL predicate)."""

    variable: str
    required: bool = False
    relevant: str | None = None
    label: str | None = None

    def applies(self) -> Column:
        return F.lit(True) if not self.relevant else F.coalesce(F.expr(self.relevant), F.lit(False))


def usable_rules(df: DataFrame, rules: Sequence[FormRule]) -> list[FormRule]:
    """Rules whose question exists in the table."""
    return [r for r in rules if r.variable in df.columns]


def flag_missing(
    df: DataFrame, rules: Sequence[FormRule], *, prefix: str = "m_", total: str = "total_missing"
) -> DataFrame:
    """``m_*``: required and asked, but empty. One projection for all questions."""
    flags = {
        f"{prefix}{r.variable}": flag(r.applies() & as_column(r.variable).isNull())
        for r in usable_rules(df, rules)
        if r.required
    }
    return df.withColumns({**flags, total: row_sum(list(flags.values()))})


def flag_skips(
    df: DataFrame,
    rules: Sequence[FormRule],
    *,
    prefix: str = "s_",
    total: str = "total_skips",
    ignore: Sequence[str] = (),
    ignore_before_total: bool = False,
) -> DataFrame:
    """``s_*``: answered although not asked.

    Variables in ``ignore`` get the flag 0. They still count in the total unless
    ``ignore_before_total`` is set.
    """
    raw = {
        r.variable: flag(~r.applies() & as_column(r.variable).isNotNull())
        for r in usable_rules(df, rules)
    }
    flags = {
        f"{prefix}{v}": F.lit(0) if v in ignore else condition for v, condition in raw.items()
    }
    for name in ignore:
        flags.setdefault(f"{prefix}{name}", F.lit(0))
    counted = [c for v, c in raw.items() if not (ignore_before_total and v in ignore)]
    return df.withColumns({**flags, total: row_sum(counted)})


def findings(df: DataFrame, ids: Sequence[str], pattern: str = "^[ms]_") -> DataFrame:
    """One row per flagged question of each row, typed ``Missing`` or ``Salto``.

    The flagged names are gathered inside the row and only these are exploded, so rows
    without findings produce nothing.
    """
    names = by_regex(df, pattern)
    hits = F.array_compact(F.array(*[F.when(as_column(n) == 1, F.lit(n)) for n in names]))
    return (
        df.select(*ids, F.explode(hits).alias("finding"))
        .withColumn(
            "kind", F.when(F.startswith("finding", F.lit("m_")), "Missing").otherwise("Salto")
        )
        .withColumn("variable", strip_prefix("finding", "[ms]_"))
    )


def with_finding(df: DataFrame, variable: str, prefix: str = "m_") -> DataFrame:
    """Rows flagged for one question."""
    return df.filter(as_column(f"{prefix}{variable}") == 1)
