"""Removal of repeated three-line windows.

Every run of three consecutive non-blank lines of a document is hashed (128 bits); windows that occur more than once
anywhere are found by one grouping; all but the first occurrence (smallest document id, then position) are
removed, by merging the lines that such windows cover.

Defined cases: lines are compared without surrounding white space and blank lines are skipped (and kept); a document
with fewer than three such lines, a null or an empty text stays as it is; rows equal in id and text are one document,
so each copy gets the same result; a null id sorts first; other columns are untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import fresh, row_key

WINDOW = 3
BLANK = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANK)))
    return F.filter(trimmed, lambda x: x != "")


def line_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key_id, key_mark, id, at, h1, h2: the hash of each window; `at` counts non-blank lines from 0."""
    base = docs.select(
        *row_key(F.col(id_col), F.col(text_col)), F.col(id_col).cast("long").alias("id"), _lines(F.col(text_col)).alias("lines")
    ).where(F.size("lines") >= WINDOW)
    lines = F.col("lines")
    starts = F.sequence(F.lit(1), F.size(lines) - (WINDOW - 1))

    def window(i):
        parts = [F.element_at(lines, i + k) for k in range(WINDOW)]
        return F.struct(
            (i - 1).alias("at"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2")
        )

    return base.select("key_id", "key_mark", "id", F.inline(F.transform(starts, window)))


def _without(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
    rows = []
    for t, at in zip(text, starts):
        lines = (t or "").split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(BLANK)]
        n = len(solid)
        if at is None or not len(at):
            rows.append((t, n, 0, 0))
            continue
        edge = np.zeros(n + 1, dtype=np.int32)
        at = np.asarray(at, dtype=np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        gone = np.cumsum(edge)[:n] > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        drop = {solid[i] for i in np.flatnonzero(gone)}
        rows.append(("\n".join(x for i, x in enumerate(lines) if i not in drop), n, int(gone.sum()), spans))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed", "n_spans"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: bool = False) -> DataFrame:
    """`docs` with repeated windows removed from its texts; with `report`, also n_lines, n_removed, n_spans."""
    windows = line_windows(docs, id_col, text_col)
    place = F.struct("id", "key_mark", "at")
    first = (
        windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    )
    later = windows.join(first, ["h1", "h2"]).where(place != F.col("first"))
    # A window of one document is listed once however often the row is repeated.
    covered = later.groupBy("key_id", "key_mark").agg(F.collect_set("at").alias("starts"))
    a, b, starts, out = (fresh(x, docs) for x in ("key_id", "key_mark", "starts", "deduped"))
    keys = row_key(F.col(id_col), F.col(text_col))
    keyed = docs.withColumns({a: keys[0], b: keys[1]})
    covered = covered.select(F.col("key_id").alias(a), F.col("key_mark").alias(b), F.col("starts").alias(starts))
    without = F.pandas_udf(_without, "text string, n_lines long, n_removed long, n_spans long")
    joined = keyed.join(covered, [a, b], "left").withColumn(out, without(F.col(text_col), F.col(starts)))
    text = F.col(out)["text"]
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    extra = [F.col(out)[c].alias(c) for c in ("n_lines", "n_removed", "n_spans")] if report else []
    return joined.select(*columns, *extra)
