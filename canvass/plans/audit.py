"""From raw submissions to audited final visits."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import (
    as_column,
    cast_by_prefix,
    drop_by_prefix,
    move_before,
    present,
    select_mapping,
)
from canvass.functions.dates import on_or_after, submission_time
from canvass.functions.numbers import flag, minutes, number
from canvass.functions.rules import category, keep_for_codes, recode
from canvass.operators import (
    corrections,
    duplicates,
    formlogic,
    geofence,
    outliers,
    textquality,
    verdicts,
    visits,
)
from canvass.operators.grouping import attach_small
from canvass.plans import survey as sv
from canvass.plans.survey import ManualInputs, Survey
from canvass.session import cut_lineage


@dataclass(frozen=True)
class Audit:
    """Tables of one run. ``submissions`` and ``audited`` are written tables."""

    raw: DataFrame
    submissions: DataFrame
    audited: DataFrame
    clear: DataFrame
    survey: Survey

    def marked(self) -> DataFrame:
        """All submissions with the flag of each unit's final visit."""
        s = self.survey
        return visits.mark_latest(self.submissions, s.unit, s.submitted, s.key)

    def superseded(self) -> DataFrame:
        """Effective visits that are not the final one of their unit."""
        return visits.effective_not_final(self.marked(), "is_final", "category", sv.EFFECTIVE)


    def discrepancies(self) -> DataFrame:
        """Submissions whose comment speaks of another status than declared."""
        s = self.survey
        read = textquality.comment_discrepancy(self.submissions, s.status)
        columns = [s.key, s.comment, s.status, "comment_code", "comment_label", "comment_alert"]
        return textquality.discrepancy_review(read, columns)


def correct(raw: DataFrame, s: Survey, manual: ManualInputs) -> DataFrame:
    """Blacklist, test days, corrections of unit and status."""
    df = move_before(raw, s.key, s.unit)
    df = corrections.drop_keys(df, s.key, manual.blacklist)
    for day in s.test_days:
        df = df.filter(as_column(s.day) != day)
    df = corrections.correct_by_key(df, s.key, manual.unit_corrections, [s.case_id, s.unit])
    return corrections.correct_status(
        df, s.key, manual.status_corrections, s.labels,
        code=s.status, label_columns=present(df, [s.published_status, s.status_label]),
    )


def normalise(df: DataFrame, s: Survey) -> DataFrame:
    """Typed scales and times, date floor, filled answers, treatment only where it applies."""
    df = cast_by_prefix(df, sv.SCALE_PREFIXES)
    df = df.withColumns({t: submission_time(t, s.hours_behind) for t in (s.submitted, s.started)})
    df = df.filter(on_or_after(s.submitted, s.date_floor) & on_or_after(s.started, s.date_floor))
    fills = {"p1_06": "p1_08a", "p1_08_resp": "p1_08_sel_resp"}
    new = {
        a: F.coalesce(as_column(a), as_column(b))
        for a, b in fills.items()
        if a in df.columns and b in df.columns
    }
    new[s.treatment] = keep_for_codes(s.treatment, s.status, s.treatment_codes)
    return df.withColumns(new)


def one_hots(code: Column) -> dict[str, Column]:
    """Category indicators: unknown status is unknown for single codes, 0 for code sets."""
    return {
        "is_effective": (code == 1).cast("int"),
        "is_refusal": (code == 5).cast("int"),
        "is_not_eligible": flag(code.isin(*sv.CATEGORIES[sv.NOT_ELIGIBLE])),
        "is_scheduled": flag(code.isin(*sv.CATEGORIES[sv.SCHEDULED])),
    }


def classify(df: DataFrame, s: Survey) -> DataFrame:
    """Status number, category and its indicators."""
    code = number(s.status)
    return df.withColumn("status_num", code).withColumns(
        {
            **one_hots(F.col("status_num")),
            "category": category("status_num", sv.CATEGORIES, sv.OTHER),
        }
    )


def read_comments(df: DataFrame, s: Survey) -> DataFrame:
    """The status the comment speaks of, as code and label, where the form has comments."""
    if s.comment not in df.columns:
        return df
    return textquality.classify_comments(df, s.comment, sv.COMMENT_RULES, s.labels, sv.NO_COMMENT_LABEL)


def prepare(raw: DataFrame, s: Survey, manual: ManualInputs) -> DataFrame:
    """All submissions, cleaned and classified."""
    return classify(read_comments(normalise(correct(raw, s, manual), s), s), s)


def question_labels(rules: Sequence[formlogic.FormRule], width: int = 45) -> dict[str, str]:
    """A short label for each question of the form: no markup, the first of several, the fixed ones as given."""
    out: dict[str, str] = {}
    for rule in rules:
        text = sv.LABEL_OVERRIDES.get(rule.variable, re.sub("<[^>]*>", "", rule.label or "")).strip()
        if text and rule.variable not in out:
            out[rule.variable] = text if len(text) <= width else text[: width - 3] + "..."
    return out


def identities(s: Survey, with_phone: bool) -> Column:
    """Identity of a visit for the duplicate test, by declared status."""
    status = as_column(s.status)
    person = ["p11_02_nombre", "p11_02_apellido"] + (["p11_03a"] if with_phone else [])
    contact = [s.case_id, "nombre_contacto"] + (["telefono"] if with_phone else [])
    return duplicates.identity(
        [
            (status == "1", person),
            (status == "4", contact),
            (status.isNotNull(), [s.unit, s.status_label]),
        ]
    )


def raise_flags(
    final: DataFrame,
    s: Survey,
    rules: Sequence[formlogic.FormRule],
    polygons: DataFrame,
    accepted_duplicates: corrections.Keys,
) -> DataFrame:
    """All quality modules over the final visits; rows without a position drop out."""
    numeric = present(final, s.numeric_questions)
    df = verdicts.presence_flag(final, s.audio, "has_audio")
    df = df.withColumn("duration_min", minutes(s.duration))
    df = outliers.nsnr_counts(df, s.nsnr_questions)

    # the figures of all three modules come from one pass and few categories
    placed = number(s.longitude).isNotNull() & number(s.latitude).isNotNull()
    nsnr = F.when(placed, F.col("total_nsnr"))
    figures = {
        **outliers.duration_figures("duration_min"),
        **outliers.outlier_figures(numeric),
        "__mu_nsnr": F.avg(nsnr),
        "__sd_nsnr": F.stddev_samp(nsnr),
    }
    df = attach_small(df, ["category"], figures, spread_by=[s.key])
    df = outliers.duration_flags(df, "duration_min", k_low=s.k_short, k_high=s.k_long)
    df = outliers.outlier_flags(df, numeric, k=s.k_numeric)
    df = outliers.nsnr_flags(df, min_count=s.min_nsnr)

    df = formlogic.flag_missing(df, rules)
    df = formlogic.flag_skips(df, rules, ignore=s.ignored_skips)

    df = df.withColumns(
        {"identity": identities(s, True), "identity_name": identities(s, False)}
    )
    df = duplicates.flag_duplicates(df, "identity", s.key, out="total_dup")
    df = duplicates.flag_duplicates(df, "identity_name", s.key, out="total_dup_name")
    df = duplicates.lift_duplicates(df, s.key, accepted_duplicates, ["total_dup", "total_dup_name"])

    df = geofence.project_points(df, s.longitude, s.latitude, zone=s.utm_zone)
    df = geofence.geofence(df, polygons, s.unit, max_metres=s.max_metres)
    return textquality.flag_garbage(df, s.text_questions)


def consolidate(df: DataFrame, s: Survey) -> DataFrame:
    """Binary flags, verdicts and label texts."""
    df = verdicts.binary_flags(
        df,
        {
            "flag_refusal": F.col("status_num") == 5,
            "flag_skips": F.col("total_skips") > 0,
            "flag_missing": F.col("total_missing") > 0,
            "flag_duration_outlier": (F.col("alert_short") == 1) | (F.col("alert_long") == 1),
            "flag_duplicated": F.col("total_dup") == 1,
            "flag_geofencing": F.col("distance_m") > s.max_metres,
            "flag_nsnr": F.col("alert_nsnr") == 1,
        },
    )
    df = verdicts.verdicts(
        df, "category", always_pass=(sv.REFUSAL, sv.NOT_ELIGIBLE), can_alert=(sv.EFFECTIVE,)
    )
    return verdicts.add_flag_labels(df)


def add_details(df: DataFrame, s: Survey, labels: Mapping[str, str]) -> DataFrame:
    """Texts naming what triggered each flag, on the row itself."""
    missing = [c.removeprefix("m_") for c in df.columns if c.startswith("m_")]
    texts, nsnr, numeric = (
        present(df, names) for names in (s.text_questions, s.nsnr_questions, s.numeric_questions)
    )
    return df.withColumns(
        {
            "garbage_detail": F.when(
                F.col("flag_garbage_text") == 1, verdicts.garbage_detail(texts)
            ),
            "outlier_detail": F.when(
                F.col("flag_extreme_values") == 1, verdicts.outlier_detail(numeric, labels)
            ),
            "nsnr_detail": F.when(F.col("flag_nsnr") == 1, verdicts.nsnr_detail(nsnr)),
            "missing_detail": F.when(
                F.col("total_missing") > 0, verdicts.missing_detail(missing, labels)
            ),
        }
    )


def clear_table(audited: DataFrame) -> DataFrame:
    """Audited rows without the per-question flags and projected places, codes turned into labels."""
    df = drop_by_prefix(audited, "m_", "s_", "trash_").drop("utm_x", "utm_y")
    new = {}
    if "asistencia" in df.columns:
        new["p10_05a_label"] = recode("asistencia", sv.ATTENDANCE_LABELS)
    for name in present(df, [f"p3_07{c}" for c in "abcdefghij"]):
        new[name] = recode(name, sv.YES_NO_LABELS)
    return df.withColumns(new) if new else df


def household_table(
    clear: DataFrame, mapping: Sequence[tuple[str, str]], order: Sequence[str] = ()
) -> DataFrame:
    """The clean table: passing rows only, answers under their final names.

    It is sorted by ``order`` (start time, then key) before that column is projected away.
    """
    passing = clear.filter(F.col("audit_pass") == 1)
    if order:
        passing = passing.orderBy(*[as_column(o).asc_nulls_last() for o in order])
    return select_mapping(passing, mapping)


def run_audit(
    raw: DataFrame,
    polygons: DataFrame,
    rules: Sequence[formlogic.FormRule],
    *,
    survey: Survey | None = None,
    manual: ManualInputs | None = None,
    labels: Mapping[str, str] | None = None,
    polygon_unit: str = "padron",
    polygon_wkt: str = "wkt_geom",
    folder: str | None = None,
) -> Audit:
    """The whole audit.

    ``labels`` names the questions in texts; by default the form's own labels do.

    Three tables are written on the way, because several later steps read a few columns of
    each: the classified submissions, the final visits, and the audited final visits.
    """
    s, manual = survey or Survey(), manual or ManualInputs()
    forced = {k: v for k, v in manual.forced_values.items() if k in raw.columns}
    raw = corrections.override_for_keys(raw, s.key, manual.forced_keys, forced)
    submissions = cut_lineage(prepare(raw, s, manual), "submissions", folder)
    final = visits.latest_only(submissions, s.unit, s.submitted, s.key)
    final = cut_lineage(final.withColumn("is_final", F.lit(1)), "final", folder)
    usable = formlogic.usable_rules(final, rules)
    edges = geofence.polygon_edges(polygons, polygon_unit, polygon_wkt)
    flagged = raise_flags(final, s, usable, edges, manual.accepted_duplicates)
    names = question_labels(rules) if labels is None else labels
    detailed = add_details(consolidate(flagged, s), s, names)
    audited = cut_lineage(detailed, "audited", folder)
    return Audit(raw, submissions, audited, clear_table(audited), s)
