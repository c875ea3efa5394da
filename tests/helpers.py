"""Small helpers shared by the tests."""

import contextlib
import io


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*(columns or df.columns)).collect()}


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
