"""Plain Python versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NASTY = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d"), (None, "null id text here"),
    (6, "A tie of rows\nA tie of rows\n" * 3), (6, "A tie of rows\nA tie of rows\n" * 3),
    (7, "<|endoftext|> x<|endoftext|>y café café İstanbul Å  nbsp \x1cfs  ls don't 3rd"),
    (8, "very long " * 30000), (9, "한국어 \U0001f600\U0001f600 क़, a̸,b"),
]


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def nasty(spark):
    """Nulls, empties, ties, repeats, a long text, and extra columns with clashing names."""
    rows = [(i, t, "k", 1, "h" if (i or 0) % 2 else None) for i, t in NASTY]
    return spark.createDataFrame(rows, "doc_id long, text string, key_id string, id int, source string")
