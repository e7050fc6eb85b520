"""Free-text checks: comment rules against the declared status, garbage answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import across, as_column, compute_once, present, row_sum
from canvass.functions.numbers import flag
from canvass.functions.quality import is_garbage
from canvass.functions.rules import recode, text_rules
from canvass.functions.text import paste, trim_all


def classify_comments(
    df: DataFrame,
    comment: str,
    rules: Sequence[tuple[str, int]],
    labels: Mapping[int, str],
    default_label: str,
) -> DataFrame:
    """Status code and label read from a comment by ordered patterns."""
    code = text_rules(F.col("comment_clean"), rules).cast("int")
    label = recode("comment_code", labels, keep_unknown=False)
    read = compute_once(
        df.withColumn("comment_clean", F.lower(trim_all(comment))), {"comment_code": code}
    )
    return read.withColumn("comment_label", F.coalesce(label, F.lit(default_label)))


def comment_discrepancy(df: DataFrame, declared: str) -> DataFrame:
    """Flag and message where the comment speaks of another status than declared.

    Codes are compared as text. No code read from the comment means no discrepancy; a
    missing declared status leaves flag and message unknown.
    """
    code = F.col("comment_code").cast("string")
    declared_text = as_column(declared).cast("string")
    differs = code.isNotNull() & (declared_text != code)
    message = paste(
        F.lit("⚠️ DISCREPANCIA: Marcó "), declared_text, F.lit(" pero escribió '"),
        F.col("comment_label"), F.lit("'"), sep="",
    )
    return df.withColumns(
        {
            "comment_mismatch": differs.cast("int"),
            "comment_alert": F.when(differs.isNull(), None).when(differs, message).otherwise("OK"),
        }
    )


def discrepancy_review(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col("comment_mismatch") == 1).select(*columns)


def flag_garbage(df: DataFrame, names: Sequence[str], *, prefix: str = "trash") -> DataFrame:
    """``trash_*`` per text column, their total and the row's flag."""
    have = present(df, names)
    out = across(df, have, {prefix: is_garbage})
    total = row_sum([f"{prefix}_{n}" for n in have])
    return out.withColumns({"total_garbage_text": total, "flag_garbage_text": flag(total > 0)})
