import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from affinis.llm import packing, token_files, tokens
from affinis.llm.common import table
from affinis.llm.tokens import Encoder
from tests.llm.brute import NASTY, nasty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts(spark, sf, plain):
    texts = [t or "" for _, t in NASTY] + [r.text or "" for r in table(spark, sf, "documents").limit(60).collect()]
    found = Encoder(PATH).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain(t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    coder = Encoder(path)
    assert not coder.by_chunk
    assert np.frombuffer(coder.encode(["a  b, c"])[0], "<u4").tolist() == t.encode("a  b, c", add_special_tokens=False).ids


def test_tokenizers_that_keep_letter_case(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        model = json.load(file)
    model["normalizer"]["normalizers"] = [n for n in model["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(model), encoding="utf-8")
    coder, whole = Encoder(str(path)), Tokenizer.from_file(str(path))
    assert not coder.by_word and Encoder(PATH).by_word
    for text in ("Hello World hello", "Émile émile, ÉMILE."):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_files_round_trip(spark, plain):
    docs = nasty(spark)
    rows = token_files.token_round_trip(docs, PATH, 1, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    start, left = 0, defaultdict(list)
    for i, t in NASTY:
        left[i].append(plain(t) + [1])
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(r.ids)
        left[r.doc_id].remove(ids)
        start += r.n_tokens
    assert not any(left.values())
    assert token_files.token_round_trip(docs.limit(0), PATH, 1).collect() == []


def test_cut_covers_every_length():
    for n in range(1, 9000):
        parts = packing.cut(n)
        assert sum(p for p, _ in parts) == n
        assert all((k == 0 and p <= 64) or p * k <= packing.CAPACITY and p > 0 for p, k in parts)


@pytest.mark.parametrize("which", ["nasty", "documents"])
def test_packing_places_each_token_once(spark, sf, plain, which):
    docs = nasty(spark) if which == "nasty" else table(spark, sf, "documents")
    rows = packing.pack(packing.pieces(docs, PATH, 2, with_ids=True)).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    expected = defaultdict(list)
    for d in docs.select("doc_id", "text").collect():
        expected[d.doc_id].append(plain(d.text) + [2])
    for i, wanted in expected.items():
        found = sorted((x for r in by_doc[i] for x in [(r.start, r.length)]))
        assert sum(n for _, n in found) == sum(map(len, wanted))
        if len(wanted) == 1:
            ids = b"".join(r.ids for r in sorted(by_doc[i], key=lambda r: r.start))
            assert np.frombuffer(ids, "<u4").tolist() == wanted[0]
    used = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        used += at
    if which == "documents":
        assert used / (len(by_seq) * packing.CAPACITY) > 0.97
    assert packing.pack(packing.pieces(docs.limit(0), PATH, 2)).collect() == []


def test_assembled_sequences(spark, sf):
    packed = packing.pack(packing.pieces(table(spark, sf, "documents").limit(50), PATH, 2, with_ids=True))
    for r in packing.assemble(packed).collect():
        size = len(r.ids) // 4
        assert size == packing.CAPACITY or size == r.n_tokens and size & (size - 1) == 0


def test_full_caches_keep_what_is_used(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 40)
    monkeypatch.setattr(tokens, "MAX_WORDS", 40)
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, learned = tokens.Encoder(path), []
    ids = coder._ids
    monkeypatch.setattr(coder, "_ids", lambda texts: (learned.extend(" ".join(texts).split()), ids(texts))[1])
    texts = [f"Often, often 3.5 {' '.join(f'w{chr(97 + k % 26)}{chr(97 + k // 26)} x{k}{j}' for j in range(15))}" for k in range(60)]
    found = [coder.encode([t])[0] for t in texts]
    assert found == ids(texts)
    assert learned.count("often") == 1 and learned.count("3.5") == 1
    assert len(coder.chunks) <= 40 + 40 and len(coder.old_chunks) <= 40 + 40


def test_chunks_of_many_kinds_give_the_ids_of_whole_texts(plain, monkeypatch):
    odd = [
        "It's IT'S don't DON'T", "word,word.Word!!Éa...b a-'s É'S ÀÉß÷×x ÿ.Ÿ", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>",
        "e\u0301. E\u0301! =\u0338 a=\u0338", "(583) 3.5, x3.y _a_ a_b\\c", "\u00a0a\u2003b\x1cc\x85d", "İstanbul ſs K Å ﬁ", "😀a 😀, a😀.", "", " \t\n",
    ]
    texts = odd + ["long " * 400 + " ".join(odd), "y" * 3000, *odd]
    for block in (1, 50, 1 << 20):
        monkeypatch.setattr(tokens, "BLOCK", block)
        assert [np.frombuffer(f, "<u4").tolist() for f in Encoder(PATH).encode(texts)] == [plain(t) for t in texts]
    # Equal hashes of different chunks are found out.
    monkeypatch.setattr(tokens, "mix", lambda x: x % np.uint64(3))
    assert [np.frombuffer(f, "<u4").tolist() for f in Encoder(PATH).encode(texts)] == [plain(t) for t in texts]


def test_words_are_learned_once_whatever_their_case_and_marks(monkeypatch):
    coder, learned = Encoder(PATH), []
    ids = coder._ids
    monkeypatch.setattr(coder, "_ids", lambda texts: (learned.extend(" ".join(texts).split()), ids(texts))[1])
    coder.encode(["Élan élan, ÉLAN&&& élan### Élan.$$$", "élan"])
    assert learned.count("élan") == 1 and len(learned) == 5
