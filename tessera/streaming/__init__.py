"""Streaming use of the text functions.

The reference has no streaming operators (no watermark, window or state).
Its text preprocessing is row-local, so the same Column expressions apply
unchanged to a Structured Streaming DataFrame: new texts can be normalized
(and masked for display) as they arrive, then scored by a batch job or a
``foreachBatch`` sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.functions.text import clean_text, normalize_text, sanitize_text


def normalize_stream(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``text_norm`` (model input) and ``sanitized_text`` (display) to a
    streaming (or batch) DataFrame; stateless, so any output mode works."""
    t = clean_text(text_col)
    return stream.withColumn("text_norm", normalize_text(t)).withColumn("sanitized_text", sanitize_text(t))


__all__ = ["normalize_stream"]
