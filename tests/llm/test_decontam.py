import random
import tracemalloc
from collections import Counter

from affinis.llm import cgk_decontam
from affinis.llm.common import table
from tests.llm.brute import NASTY, nasty


def distance(item, text):
    """Plain dynamic programming, free ends in the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(text, n, draw):
    out = list(text)
    for _ in range(n):
        k, kind = draw.randrange(len(out)), draw.randrange(3)
        if kind == 0:
            out[k] = draw.choice("abcdefg ")
        elif kind == 1:
            out.insert(k, draw.choice("abcdefg"))
        else:
            del out[k]
    return "".join(out)


def make(n, share):
    draw = random.Random(4)
    words = ["".join(draw.choices("thandeorisblg", k=draw.randint(2, 9))) for _ in range(200)]
    text = lambda k: " ".join(draw.choices(words, k=k))
    items = [(i, text(draw.randint(14, 45))) for i in range(30)]
    docs, planted = [], set()
    for d in range(n):
        i, item = items[d % 30]
        part = edited(item, int(len(item) * share), draw)
        docs.append((d, text(30) + " " + part + " " + text(20)))
        planted.add((d, i))
    docs += [(n + d, text(60)) for d in range(n)]
    return items, docs, planted


def test_edit_distance_is_exact():
    draw = random.Random(1)
    for _ in range(60):
        item = "".join(draw.choices("ab ", k=draw.randint(1, 30)))
        text = "".join(draw.choices("ab ", k=draw.randint(0, 50)))
        assert cgk_decontam.edit_distance_within(item.encode(), text.encode()) == distance(item, text)


def test_recall_against_brute_force():
    for share in (0.0, 0.03, 0.06, 0.09):
        items, docs, planted = make(150, share)
        block = cgk_decontam.Items([(i, cgk_decontam.normal(t.encode())) for i, t in items])
        found = {(d, i) for d, i, _ in cgk_decontam.matches(block, [t.encode() for _, t in docs])}
        true = {(d, i) for d, i in planted if distance(cgk_decontam.normal(items[i][1].encode()), cgk_decontam.normal(docs[d][1].encode())) <= len(items[i][1]) // 10}
        assert len(true) > 140 and len(found & true) >= cgk_decontam.RECALL * len(true)
        assert all(distance(block.texts[i], cgk_decontam.normal(docs[d][1].encode())) <= block.edits[i] for d, i in list(found - true)[:20])
        assert not found - planted


def test_long_items_are_all_found():
    draw = random.Random(9)
    words = ["".join(draw.choices("thandeorisblg", k=draw.randint(2, 9))) for _ in range(2000)]
    text = lambda n: " ".join(draw.choices(words, k=n))[:n].strip()

    def inserted(item, n):
        k = draw.randrange(len(item))
        return item[:k] + text(n) + item[k:]

    def removed(item, n):
        k = draw.randrange(len(item) - n)
        return item[:k] + item[k + n :]

    for size in (cgk_decontam.WALKED + 2, 500, 1000, 3000):
        items = [(i, cgk_decontam.normal(text(size).encode())) for i in range(12)]
        block = cgk_decontam.Items(items)
        docs = []
        for change in (edited, inserted, removed):
            for k, (_, item) in enumerate(items):
                args = (item.decode(), len(item) // 11)
                part = change(*args, draw) if change is edited else change(*args)
                docs.append((text(150) + " ") * (k % 3 > 0) + part + (" " + text(150)) * (k % 3 < 2))
        found = {(d, i): x for d, i, x in cgk_decontam.matches(block, [t.encode() for t in docs])}
        plain = [cgk_decontam.normal(t.encode()) for t in docs]
        true = {(d, d % 12): cgk_decontam.edit_distance_within(block.texts[d % 12], t) for d, t in enumerate(plain)}
        true = {(d, i): x for (d, i), x in true.items() if x <= block.edits[i]}
        assert len(true) >= 34 and found == true


def test_recall_around_the_length_of_a_walk():
    draw = random.Random(21)
    words = ["".join(draw.choices("thandeorisblg", k=draw.randint(2, 9))) for _ in range(2000)]
    text = lambda n: " ".join(draw.choices(words, k=n))[:n].strip()
    for size in (cgk_decontam.WALKED - 2, cgk_decontam.WALKED + 2, 250, 2 * cgk_decontam.WALKED + 2):
        block = cgk_decontam.Items([(i, text(size).encode()) for i in range(60)])
        docs = [f"{text(90)} {edited(t.decode(), int(block.edits[i]), draw)} {text(90)}".encode() for i, t in enumerate(block.texts)]
        found = {(d, i) for d, i, _ in cgk_decontam.matches(block, docs)}
        true = {(d, d) for d, t in enumerate(docs) if cgk_decontam.edit_distance_within(block.texts[d], cgk_decontam.normal(t)) <= block.edits[d]}
        assert len(true) > 50 and found <= true and len(found) >= cgk_decontam.RECALL * len(true)


def test_parts_cover_items_and_a_surviving_piece_is_enough():
    block = cgk_decontam.Items([(1, b"x"), (2, b"a" * cgk_decontam.WALKED), (3, b"ab" * 400)])
    assert [int((block.owner == k).sum()) for k in range(3)] == [1, 1, 5]
    assert all(block.part_lengths[block.owner == k].sum() == n for k, n in enumerate(block.lengths))
    assert block.part_lengths.max() <= cgk_decontam.WALKED and block.least.min() >= 1


def test_memory_does_not_grow_with_the_item(monkeypatch):
    draw = random.Random(2)
    text = lambda n: " ".join("".join(draw.choices("thandeorisblg", k=6)) for _ in range(n // 7))
    items = [(1, text(50000)), (2, "-" * 2000)]
    docs = [text(300) + edited(items[0][1], 400, draw), "x" + "-" * 1900 + "y", text(3000)]
    tracemalloc.start()
    block = cgk_decontam.Items([(i, t.encode()) for i, t in items])
    found = list(cgk_decontam.matches(block, [t.encode() for t in docs]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(d, i) for d, i, _ in found] == [(0, 0), (1, 1)] and found[1][2] == 100 and peak < 100e6
    monkeypatch.setattr(cgk_decontam, "HITS", 1000)
    assert list(cgk_decontam.matches(block, [t.encode() for t in docs])) == found


def test_exact_copies_in_any_surroundings(spark):
    item = "The exact words of one fine question that has some forty letters and more"
    rows = [(1, f'x"{item}"y'), (2, item.upper().replace(" ", "\n ")), (3, f"zz{item}"), (4, item[:40]), (5, f"a {item}"), (5, f"a {item}")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "qqqq")], "item_id long, text string")
    found = Counter((r.doc_id, r.item_id, r.distance) for r in cgk_decontam.contaminated(docs, bench).collect())
    assert found == {(d, i, 0): (2 if d == 5 else 1) for d in (1, 2, 3, 5) for i in (1, 2)}
    left = cgk_decontam.without_contaminated(docs, bench)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(4, item[:40], 7)]


def test_odd_documents_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cgk_decontam, "BLOCK_BYTES", 50)
    docs = nasty(spark)
    bench = spark.createDataFrame([(1, "null id text here"), (2, "a tie of rows"), (3, "no such text in them")], "item_id long, text string")
    found = Counter((r.doc_id, r.item_id) for r in cgk_decontam.contaminated(docs, bench).collect())
    assert found == {(None, 1): 1, (6, 2): 2}
    assert cgk_decontam.without_contaminated(docs, bench).count() == len(NASTY) - 3
    assert cgk_decontam.contaminated(docs.limit(0), bench).collect() == []
    assert cgk_decontam.contaminated(docs, bench.limit(0)).collect() == []
    assert cgk_decontam.without_contaminated(docs, bench.limit(0)).count() == len(NASTY)


def test_given_passages_are_found(spark, sf):
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    found = {(r.doc_id, r.item_id) for r in cgk_decontam.contaminated(docs, bench).collect()}
    plain = {r.doc_id: cgk_decontam.normal((r.text or "").encode()) for r in docs.collect()}
    items = {r.item_id: cgk_decontam.normal(r.text.encode()) for r in bench.collect()}
    exact = {(d, i) for d, t in plain.items() for i, x in items.items() if x in t}
    assert exact and exact <= found
    assert all(cgk_decontam.edit_distance_within(items[i], plain[d]) <= len(items[i]) // 10 for d, i in found)
