"""Secrets in documents, told apart by who holds them: corpus-wide ownership frequency.

1. Every text is scanned once for candidates: the base kinds `assign`, `access` and `hex`, and `bare`, long runs that look drawn at
   random but stand in no telling context.
2. Candidate values travel as 128-bit hashes. They are counted over the whole corpus by distinct repository and distinct owner, in
   three groupings (value, owner, repository), (value, owner), (value), each combined before its shuffle. A repository belongs to its owner.
3. A value of `WIDE_OWNERS` owners or more is a widely copied example; one that a single owner holds and that looks random is live;
   anything else stays open.
4. The verdicts go back to the documents. A bare run with a live value becomes a span of kind `live`; base spans always stay.

Documents without candidates leave after the scan and are never shuffled. Values that a thousandth of all occurrences share are
joined by broadcast (there can be at most 1,000), so a value in a third of all documents lands in no single task.

Null text is empty and has no spans; null owners or repositories count as one owner or repository of their own. Repeated rows are
documents of their own and give a row each. Ties cannot occur. Texts are scanned whole, however long. Empty tables give no rows. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import attach
from affinis.session import pin

# The base patterns and the least lengths of what they must catch, in the order in which kinds sort.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ["assign", "access", "hex", "live"]

BARE = r"[A-Za-z0-9+/_-]{20,}"
WIDE_OWNERS = 3  # a value of so many owners is a copied example
LIVE_CHARACTERS = 8  # least number of different characters of a live-looking value

_FOUND = "repo binary, owner binary, doc_id long, spans array<struct<kind:int,start:int,end:int,value:binary,random:boolean>>"

_SPANS = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary()), ("random", pa.bool_())])
)


def _scanner():
    # ASCII rules: "either case" means A-Z and a-z only, not letters that fold to them.
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    # A run is found from its start, so a least length in the pattern drops exactly the short runs.
    access = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4))
    hexes = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
    bare = re.compile(BARE)

    def scan(text: str) -> list[tuple[int, int, int, str]]:
        """(kind, start, end, value) of every candidate; a kind's own matches do not overlap."""
        out = [(0, m.start(), m.end(), m[2]) for m in assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
        out += [(1, m.start(), m.end(), m[0]) for m in access.finditer(text)]
        out += [(2, m.start(), m.end(), m[0]) for m in hexes.finditer(text)]
        runs = [m for m in bare.finditer(text) if looks_random(m[0])]
        if runs:
            starts = sorted((s, -e) for _, s, e, _ in out)
            reach = [0, *accumulate((-e for _, e in starts), max)]  # the furthest end among the first base spans
            out += [
                (3, m.start(), m.end(), m[0]) for m in runs if reach[bisect_right(starts, (m.start(), 0))] < m.end()
            ]  # runs inside a base span are that span's value
        return out

    return scan


def looks_random(value: str) -> bool:
    """Letters and digits mixed, of `LIVE_CHARACTERS` different characters or more."""
    return (
        len(set(value)) >= LIVE_CHARACTERS
        and any("0" <= c <= "9" for c in value)
        and any("a" <= c <= "z" or "A" <= c <= "Z" for c in value)
    )


def candidates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", repository: str | None = None
) -> DataFrame:
    """One row per document: `uid`, the id, owner and repository as hashes, and its candidate spans.

    Without a `repository` column every document is a repository of its own. The table is written once: `uid` and spans are
    the same for every later use.
    """
    repo = F.col(repository or doc_id).cast("string")
    slim = docs.select(
        F.md5(F.to_json(F.struct(F.col(owner).cast("string").alias("o"), repo.alias("r")))).alias("repo"),
        F.md5(F.to_json(F.struct(F.col(owner).cast("string").alias("o")))).alias("owner"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
    )

    def found(batches):
        scan = _scanner()
        for batch in batches:
            spans = [
                [
                    {"kind": k, "start": s, "end": e, "value": hashlib.md5(v.encode()).digest(), "random": looks_random(v)}
                    for k, s, e, v in scan(t or "")
                ]
                for t in batch.column(3).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bytes.fromhex(x) for x in batch.column(i).to_pylist()], pa.binary()) for i in (0, 1)
                ]
                + [batch.column(2), pa.array(spans, _SPANS)],
                names=["repo", "owner", "doc_id", "spans"],
            )

    return pin(slim.mapInArrow(found, _FOUND).withColumn("uid", F.monotonically_increasing_id()))


def occurrences(found: DataFrame) -> DataFrame:
    """One row per candidate span."""
    return found.filter(F.size("spans") > 0).select("uid", "doc_id", "repo", "owner", F.explode("spans").alias("s")).select(
        "uid", "doc_id", "repo", "owner", "s.*"
    )


def ownership(spans: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """value, n (occurrences), n_repos, n_owners, verdict ('live', 'copied', 'open') of every candidate value."""
    by_repo = spans.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("random").alias("random"))
    by_owner = by_repo.groupBy("value", "owner").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repos"), F.max("random").alias("random")
    )
    by_value = by_owner.groupBy("value").agg(
        F.sum("n").alias("n"), F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.max("random").alias("random")
    )
    verdict = (
        F.when(F.col("n_owners") >= wide_owners, "copied")
        .when((F.col("n_owners") == 1) & F.col("random"), "live")
        .otherwise("open")
    )
    return by_value.select("value", "n", "n_repos", "n_owners", verdict.alias("verdict"))


def _joined(spans, live: bool):
    kept = F.array_sort(F.filter(spans, lambda s: s["kind"] < 3) if not live else spans)
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan_documents(docs: DataFrame, wide_owners: int = WIDE_OWNERS, **columns: str | None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_open.

    The last three count the document's spans (bare runs without a verdict of live excluded) by the verdict on their value.
    """
    found = candidates(docs, **columns)
    spans = occurrences(found)
    judged = attach(spans, pin(ownership(spans, wide_owners)), "value", "n")
    # What leaves: base spans, and bare runs with a live value. A document's spans come together; they fit beside its text.
    kept = judged.filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
    marked = kept.groupBy("uid").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("all"),
        *[F.count_if(F.col("kind") == i).alias(f"n_{KINDS[i]}") for i in range(3)],
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}_values") for v in ("live", "copied", "open")],
    )
    some = found.filter(F.size("spans") > 0).select("uid", "doc_id")
    none = found.filter(F.size("spans") == 0).select("doc_id", F.lit(None).cast("long").alias("uid"))
    rows = some.join(marked, "uid", "left").unionByName(none, allowMissingColumns=True)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = rows.withColumn("all", F.coalesce("all", empty))
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("all"), False), 256).alias("base_sha256"),
        _joined(F.col("all"), True).alias("spans"),
        *[F.coalesce(f"n_{v}_values", F.lit(0)).cast("long").alias(f"n_{v}") for v in ("live", "copied", "open")],
    )
