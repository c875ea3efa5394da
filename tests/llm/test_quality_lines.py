from collections import Counter

from affinis.llm import line_dedup, quality_rules
from tests.llm.brute import NASTY, nasty, words


def stats(text):
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_stats_match_plain_python(spark):
    extra = [(20, "x y z v w " * 2 + "end # $ | <b>"), (21, "a b c d e f a b c d e g\na b\na b")]
    docs = nasty(spark).select("doc_id", "text", "source").union(
        spark.createDataFrame([(i, t, "h") for i, t in extra], "doc_id long, text string, source string")
    )
    found = quality_rules.assess(docs).collect()
    assert len(found) == len(NASTY) + len(extra)
    expected = Counter((i, *stats(t)) for i, t in NASTY + extra)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *[r[c] for c in names]) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bad_hosts_take_their_documents_and_small_ones_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [(i, good, f"h{i % 20}") for i in range(400)]
    rows += [(1000 + i, bad if i < 180 else good, "farm") for i in range(200)]
    rows += [(2000, bad, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality_rules.assess(docs).collect()}
    assert all(found[i].kept for i in range(400))
    assert not any(found[1000 + i].kept for i in range(200)) and found[1199].host_rejected
    assert found[2000].host_rate < 1
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert kept == {i for i, r in found.items() if r.kept}


def test_keep_good_on_odd_rows(spark):
    docs = nasty(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality_rules.assess(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    assert quality_rules.keep_good(docs.limit(0)).collect() == []
    assert quality_rules.assess(docs.limit(0)).collect() == []


def dedup(rows):
    """rows: distinct (id, text)."""
    strip = " \t\n\x0b\f\r"
    solid = {r: [x.strip(strip) for x in (r[1] or "").split("\n") if x.strip(strip)] for r in rows}
    first = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for j in range(len(solid[r]) - 2):
            first.setdefault(tuple(solid[r][j : j + 3]), (r, j))
    out = {}
    for r in rows:
        gone = set()
        for j in range(len(solid[r]) - 2):
            if first[tuple(solid[r][j : j + 3])] != (r, j):
                gone.update(range(j, j + 3))
        left, k = [], -1
        for x in (r[1] or "").split("\n"):
            k += bool(x.strip(strip))
            if not (x.strip(strip) and k in gone):
                left.append(x)
        out[r] = ("\n".join(left) if gone else r[1], len(gone))
    return out


def test_later_windows_go(spark):
    rows = [
        (1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\n\n d \ny"), (3, "a\nb\nc\nd"), (4, "b\nc"), (5, None), (6, ""),
        (7, "q\nq\nq\nq\nq"), (8, "n\n" * 5000), (None, "c\nd\ne"),
    ]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, starts int")
    expected = dedup(rows)
    found = line_dedup.dedup_lines(docs, report=True).collect()
    assert Counter((r.doc_id, r.text, r.n_removed) for r in found) == Counter((i, *expected[i, t]) for i, t in rows)
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_copies_of_a_row_get_the_same_result(spark):
    docs = nasty(spark)
    found = [r.text for r in line_dedup.dedup_lines(docs).where("doc_id = 6").collect()]
    assert len(found) == 2 and found[0] == found[1]
