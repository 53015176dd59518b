"""Small literal rows appended to the driver's documents for the text queries.

The driver's texts contain no URLs or hashtags and few mentions, so the text
queries run on all documents PLUS these rows (negative ids), in Spark and in
the DuckDB oracle alike.  They never run alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: edge-case strings (tab and U+00A0 in row -4) -------------
EDGE_TEXTS = (
    (-1, "Hi @Bob_1!!!! see HTTP://x.y #Tag??? ok"),
    (-2, "WWW.a.b,,,, . . ...x #é1 @ñ#b"),
    (-3, "a http b www. c"),
    (-4, "  Mixed\tCase text  "),
    (-5, "email me a@b.com, or @x,"),
    (-6, "@Bob @bob, https://t.co/x ftp://y httpfoo Www.z"),
    (-7, "Two BITCHES @Al HTTP://q http://z whoever"),
    (-8, "Illegals  are illegal"),
    (-9, ""),
    (-10, "single"),
)
# ----------------------------------------------------------------------------


# Rows that text files lose easily: quotes, commas, newlines of all kinds, outer
# spaces, nothing at all, a row and its copy.
SINK_EDGES = (
    ('say "hi", he said', 1, "train"),
    ("line one\nline two\r\nline three\rend", 0, "test"),
    ("  outer spaces\t", 1, "test"),
    ("", 0, "validation"),
    ("back\\slash \\\" and # and ; and 'x'", 0, "validation"),
    ('""', 1, "test"),
    ("copied row", 0, "test"),
    ("copied row", 0, "test"),
    ("copied row", 0, "train"),
    ("NULL", 1, "train"),
)


def sink_edge_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SINK_EDGES), "text string, label int, split string")


def sink_edge_values_sql() -> str:
    def lit(t: str) -> str:
        text = t.replace("'", "''")
        for c in ("\n", "\r", "\t"):
            text = text.replace(c, f"' || chr({ord(c)}) || '")
        return f"'{text}'"

    rows = ", ".join(f"({lit(t)}, {y}::INTEGER, '{s}')" for t, y, s in SINK_EDGES)
    return f"(VALUES {rows}) AS e(text, label, split)"


def edge_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EDGE_TEXTS), "doc_id long, text string")


def edge_values_sql() -> str:
    """The same rows as a DuckDB VALUES list."""
    rows = ", ".join(f"({i}::BIGINT, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in EDGE_TEXTS)
    return f"(VALUES {rows}) AS e(doc_id, text)"
