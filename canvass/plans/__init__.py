"""The audit from submissions to verdicts, and the reports built on it."""
