"""All tables of one run under their published names, ready for the sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import present, select_mapping
from canvass.operators import duplicates, formlogic, outliers, verdicts
from canvass.operators.geofence import OUTSIDE
from canvass.operators.summaries import describe_number
from canvass.plans import published
from canvass.plans import reports as rp
from canvass.plans import survey as sv
from canvass.plans.audit import Audit, household_table
from canvass.session import cut_lineage
from canvass.sources import sinks


def audited_sheet(clear: DataFrame) -> DataFrame:
    """The audited table with the published column names."""
    return clear.withColumnsRenamed(published.AUDITED)


def exports(
    audit: Audit,
    progress: DataFrame,
    visits: DataFrame,
    *,
    households: Sequence[tuple[str, str]] | None = None,
    days: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The published tables: raw, audited, clean households, cases, days, blocks."""
    s = audit.survey
    daily = rp.daily_progress(
        rp.daily_detail(audit.audited, s), rp.daily_status(audit.submissions, s), days
    )
    mapping = published.household_mapping() if households is None else households
    return {
        "raw": audit.raw,
        "audited": audited_sheet(audit.clear),
        "households": household_table(audit.clear, mapping, [s.started, s.key]),
        "cases": select_mapping(visits, published.CASES),
        "daily_progress": daily,
        "block_progress": select_mapping(progress, published.BLOCK_PROGRESS),
    }


def sheets(
    audit: Audit,
    cases: DataFrame,
    enumerators: DataFrame,
    names: DataFrame,
    run_date: date,
    as_of: datetime,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """The monitoring sheets by name, and the block progress and visits they share.

    Those two are written once and read again, for the sheets and for the exports.
    """
    s, audited = audit.survey, audit.audited
    assignment = rp.block_assignment(enumerators, names)
    progress = rp.block_progress(
        rp.block_targets(cases, assignment), rp.block_work(audited, s), run_date
    )
    progress = cut_lineage(progress, "block_progress")
    visits = cut_lineage(rp.cases_table(audit.submissions, s), "cases")
    targets = rp.agent_targets(rp.agent_block_targets(cases, enumerators))
    out = {
        "alerts": select_mapping(rp.alert_table(audited, s), published.ALERT_TABLE),
        "block_scorecard": select_mapping(rp.block_scorecard(audited, s), published.BLOCK_SCORECARD),
        "agent_consolidated": select_mapping(
            rp.agent_consolidated(audited, targets, s), published.AGENT_CONSOLIDATED
        ),
        "agent_productivity": select_mapping(
            rp.agent_productivity(audited, s), published.AGENT_PRODUCTIVITY
        ),
        "agent_report": select_mapping(
            rp.agent_report(progress, visits, audit.clear, s), published.AGENT_REPORT
        ),
        "appointments": select_mapping(
            rp.appointments(cases, audit.clear, as_of, s), published.APPOINTMENTS
        ),
    }
    wanted = [*published.SCHEME_REVIEW.values(), *published.SCHEME_REVIEW_FLAGS, s.day]
    lacking = {c: F.lit(None).cast("string") for c in wanted if c not in audited.columns}
    review = audited.withColumns(lacking) if lacking else audited  # questions nobody answered yet
    out["scheme_review"] = rp.scheme_review(
        review, published.SCHEME_REVIEW_FLAGS, published.SCHEME_REVIEW, published.SCHEME_REVIEW_BLANKS
    )
    return out, progress, visits


def quality_reviews(audit: Audit) -> dict[str, DataFrame]:
    """What each quality module found: answers, questions, duplicates, positions, and the table of all verdicts.

    The summaries by question are about effective interviews. Columns that the form does not have are left out.
    """
    s, audited = audit.survey, audit.audited
    effective = audited.filter(F.col("category") == sv.EFFECTIVE)
    ids = present(audited, [s.unit, s.day, "formdef_version"])
    out = {
        "findings": formlogic.findings(audited, ids),
        "distance_summary": describe_number(audited, "distance_m"),
        "geofence_alerts": audited.filter(F.col("alert_geo") == OUTSIDE).select(
            *present(audited, ["alert_geo", "distance_m", s.status_label, "gps_precision", s.key])
        ),
        "duplicate_review": duplicates.duplicate_review(
            audited, "total_dup", present(audited, [s.unit, s.agent, s.day, "identity", s.status_label, "p11_02_nombre", s.comment, s.key])
        ),
        "audit_table": verdicts.audit_table(
            audited,
            present(audited, [s.key, s.unit, s.agent, "category", "p4_01", "p4_02", "p4_03"]),
            ["audit_pass", "audit_alert"],
            ["total_missing", "total_skips"],
        ),
    }
    if present(audited, s.numeric_questions):
        out["question_outliers"] = outliers.question_outlier_summary(effective, s.numeric_questions, s.agent, k=s.k_numeric)
    if present(audited, s.nsnr_questions):
        out["question_nsnr"] = outliers.question_nsnr_summary(effective, s.nsnr_questions, s.agent)
    return out


def reviews(audit: Audit) -> dict[str, DataFrame]:
    """The review tables of a run: histories, superseded visits, comments, treatments, recordings, and what each module found."""
    s = audit.survey
    closures, partial = rp.closure_review(audit.submissions, s), rp.partial_review(audit.submissions, s)
    found = {"comment_discrepancies": audit.discrepancies()} if s.comment in audit.submissions.columns else {}
    found |= quality_reviews(audit)
    return found | {
        "closure_review": closures,
        "partial_review": partial,
        "superseded": audit.superseded(),
        "intervention_by_agent": rp.intervention_by_agent(audit.clear, s),
        "audio_coverage": rp.audio_coverage(audit.audited, s),
    }


def publish_run(
    audit: Audit,
    cases: DataFrame,
    enumerators: DataFrame,
    names: DataFrame,
    root: str,
    run_date: date,
    as_of: datetime,
    *,
    households: Sequence[tuple[str, str]] | None = None,
    second_cases: str | None = None,
    fmt: str = "parquet",
    as_set: bool = False,
) -> list[str]:
    """Write every sheet and export below ``root``; the cases may go to a second place.

    With ``as_set`` the tables become visible together or not at all: see :func:`sinks.publish_set`.
    """
    tables, progress, visits = sheets(audit, cases, enumerators, names, run_date, as_of)
    tables |= exports(audit, progress, visits, households=households)
    tables |= reviews(audit)
    also = {"cases": second_cases} if second_cases else None
    if as_set:
        written = sinks.publish_set(tables, root, fmt=fmt, orders=published.ORDERS)
        if second_cases:
            sinks.publish(sinks.read_set(audit.raw.sparkSession, root, "cases"), [second_cases], label="cases", fmt=fmt)
    else:
        written = sinks.publish_all(tables, root, fmt=fmt, also=also, orders=published.ORDERS)
    sinks.write_dated_csv(tables["households"], f"{root}/clean", run_date)
    return written
