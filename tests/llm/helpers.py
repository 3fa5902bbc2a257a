"""Small tables with every odd case, and plain-Python versions to compare with."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def table(spark, rows, extra=None):
    """documents from (doc_id, text[, source]); extra: a column of a clashing name."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        frame = frame.withColumns({c: F.lit("kept") for c in extra})
    return frame


def rows_of(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)
