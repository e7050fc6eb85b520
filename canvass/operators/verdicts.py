"""Flags to verdicts, labels, detail texts and the alert table.

Everything here is local to a row: the detail texts are assembled from the row's own
columns, so no reshape, join or shuffle is needed to explain an alert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import all_of, any_of, as_column, by_prefix, merge_text, present
from canvass.functions.numbers import flag, is_sentinel_text, number_text_value
from canvass.functions.rules import first_match, flag_labels

# Texts of the alert table.
CRITICAL, WARNING, REVIEW = "🔴 CRÍTICO", "🟡 ADVERTENCIA", "🔵 REVISIÓN"
SEVERITY = [
    (("flag_duplicated", "flag_garbage_text"), CRITICAL),
    (("flag_geofencing", "flag_extreme_values"), WARNING),
]
ACTIONS = [
    ("flag_duplicated", "Revisar registro"),
    ("flag_garbage_text", "Revisar texto"),
    ("flag_geofencing", "Verificar ubicación"),
    ("flag_extreme_values", "Confirmar dato numérico"),
    ("flag_missing", "Revisar datos faltantes"),
    ("flag_nsnr", "Revisar cantidad atipica de NSNR"),
    ("flag_duration_outlier", "Duración atipica"),
]
DEFAULT_ACTION = "Revisión general"
LABELS = {
    "refusal_lbl": ("flag_refusal", "Sí", "No"),
    "abnormal_time_lbl": ("flag_duration_outlier", "Anómalo", "Normal"),
    "repeated_id_lbl": ("flag_duplicated", "Duplicado", "Único"),
    "out_of_range_lbl": ("flag_geofencing", "Fuera de Padrones", "OK"),
    "nsnr_excess_lbl": ("flag_nsnr", "Sí", "No"),
    "has_missing_lbl": ("flag_missing", "Sí", "No"),
    "has_skips_lbl": ("flag_skips", "Sí", "No"),
    "garbage_text_lbl": ("flag_garbage_text", "Sí", "No"),
}

# The flags that decide a verdict. Skips and refusals never do.
VERDICT_FLAGS = (
    "flag_duration_outlier",
    "flag_extreme_values",
    "flag_duplicated",
    "flag_geofencing",
    "flag_missing",
    "flag_nsnr",
    "flag_garbage_text",
)


def binary_flags(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """0/1 columns from conditions; unknown is 0."""
    return df.withColumns({name: flag(c) for name, c in conditions.items()})


def presence_flag(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.withColumn(out, as_column(column).isNotNull().cast("int"))


def verdicts(
    df: DataFrame,
    category: str,
    *,
    flags: Sequence[str] = VERDICT_FLAGS,
    always_pass: Sequence[str],
    can_alert: Sequence[str],
    passed: str = "audit_pass",
    alert: str = "audit_alert",
) -> DataFrame:
    """Pass and alert verdicts from category and flags.

    Pass: a category that always passes, or no flag raised. Alert: a category that can
    alert, with any flag raised. The two are never both 1, and may both be 0.
    """
    kind = as_column(category)
    clean = all_of([as_column(f) == 0 for f in flags])
    raised = any_of([as_column(f) == 1 for f in flags])
    return df.withColumns(
        {
            passed: (kind.isin(*always_pass) | clean).cast("int"),
            alert: (kind.isin(*can_alert) & raised).cast("int"),
        }
    )


def add_flag_labels(df: DataFrame, labels: Mapping[str, tuple[str, str, str]] = LABELS) -> DataFrame:
    return df.withColumns(flag_labels(labels))


def audit_table(df: DataFrame, ids: Sequence[str], verdict_columns: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Identifiers, all ``flag_*`` columns, verdicts, and optional totals if present."""
    names = [*ids, *by_prefix(df, "flag_"), *verdict_columns, *present(df, optional)]
    return df.select(*dict.fromkeys(names))


@dataclass(frozen=True)
class Item:
    """One possible entry of a detail text: shown when ``hit`` holds."""

    hit: Column
    text: Column


def detail_text(items: Sequence[Item], sep: str = " | ") -> Column:
    """The shown entries in order; NULL when there is none."""
    entries = F.array_compact(F.array(*[F.when(i.hit, i.text) for i in items]))
    return F.when(F.size(entries) > 0, F.array_join(entries, sep))


def garbage_detail(names: Sequence[str], prefix: str = "trash") -> Column:
    """``question: 'text'`` for each garbage answer."""
    return detail_text(
        [
            Item(
                as_column(f"{prefix}_{n}") == 1,
                F.concat(F.lit(f"{n}: '"), F.coalesce(as_column(n), F.lit("NA")), F.lit("'")),
            )
            for n in names
        ]
    )


def nsnr_detail(names: Sequence[str], trim: bool = True) -> Column:
    """Names of the questions answered with a sentinel code."""
    return detail_text([Item(is_sentinel_text(n, trim=trim), F.lit(n)) for n in names], ", ")


def outlier_detail(names: Sequence[str], labels: Mapping[str, str] | None = None) -> Column:
    """``label: [value]`` for each extreme value."""
    labels = labels or {}
    return detail_text(
        [
            Item(
                as_column(f"ex_{n}") == 1,
                F.concat(
                    F.lit(f"{labels.get(n, n)}: ["), number_text_value(n), F.lit("]")
                ),
            )
            for n in names
        ]
    )


def missing_detail(names: Sequence[str], labels: Mapping[str, str] | None = None, prefix: str = "m_") -> Column:
    """``🚫 Faltante: label`` for each missing answer."""
    labels = labels or {}
    return detail_text(
        [
            Item(as_column(f"{prefix}{n}") == 1, F.lit(f"🚫 Faltante: {labels.get(n, n)}"))
            for n in names
        ]
    )


def alert_pieces(pieces: Mapping[str, Sequence[Column]]) -> Column:
    """One message from ``{flag column: parts}``: the flagged pieces joined by bars.

    A missing part of a shown piece is written ``NA``.
    """
    shown = []
    for name, parts in pieces.items():
        text = F.concat(*[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])
        shown.append(F.when(as_column(name) == 1, text))
    return merge_text(shown)


def severity(rules=SEVERITY, default: str = REVIEW) -> Column:
    return first_match(
        [(any_of([as_column(f) == 1 for f in flags]), text) for flags, text in rules], default
    )


def recommended_action(rules=ACTIONS, default: str = DEFAULT_ACTION) -> Column:
    return first_match([(as_column(f) == 1, text) for f, text in rules], default)
