"""Fixtures of the operator tests."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)
