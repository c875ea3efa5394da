"""Token ids of whole texts, encoded inside tasks with a public tokenizer file.

A tokenizer that drops white space gives a text the ids of its white-space separated chunks, one after another. Where
a probe shows this, each different chunk is encoded once per worker and looked up afterwards; other tokenizers
encode whole texts. Where probes show that letter case does not matter to it and that it cuts marks from the word before them,
chunks are lower-cased and cut there, so fewer differ. Ids are the same either way.

Chunks of a block of texts are told apart by hashes in numpy and then compared byte by byte, so only different ones are Python objects.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from affinis.llm.textscan import BYTE_VALUES, LOWERED, SPACES, mix, powers

# Letters that no normalisation changes and that form one word of the tokenizer; marks that are cut from the word before them.
LETTERS = "".join(chr(c) for c in range(0x100) if re.fullmatch("[A-Za-zÀ-ÖØ-öø-ÿ]", chr(c)))
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
NORMAL = re.compile("[a-zà-öø-ÿ ]+")
WORD = re.compile(rb"(?:[a-z]|\xC3[\xA0-\xB6\xB8-\xBF])+")
# What a byte of lower-cased text is: no white space, a mark, a letter, the second byte of an accented letter or capital.
SOLID, MARK, LETTER, ACCENTED, CAPITAL = 1, 2, 4, 8, 16
KINDS = bytes(
    SOLID * (not SPACES[c]) | MARK * (c in MARKS.encode()) | LETTER * (97 <= c <= 122)
    | ACCENTED * (0xA0 <= c <= 0xBF and c != 0xB7) | CAPITAL * (0x80 <= c <= 0x9E and c != 0x97) for c in range(256)
)
SPACE = re.compile(rb"[\x20\x09-\x0D]")
MAX_CHUNKS, MAX_WORDS = 300_000, 50_000  # of each of two generations; of one text of words to learn
BLOCK = 1 << 20


class Encoder:
    """Encodes UTF-8 texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = None  # the tokenizer without its normalizer, where texts of small letters do not need that
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        ends = np.zeros(self.vocab_size, dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            ends[i] = token.endswith("</w>")
        self.ends = ends
        # Added tokens are matched in the text as it is, before anything else.
        self.added = [t.content.encode("utf-8").translate(LOWERED) for t in self.tokenizer.get_added_tokens_decoder().values()]
        parts = ["word", "b,c", "É."]
        self.by_chunk = all(t.split() == [t] for t in self.added) and all(
            self._ids([space.join(parts)])[0] == b"".join(self._ids(parts)) for space in (" ", "\n", " \t ", "\r\n\n")
        )
        self.by_word = self.by_chunk and bool(ends.any()) and self._plain_words()
        if self.by_word and self._already_normal():
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = None
        # Chunks, and words without their marks. What is looked up moves to the young generation; when that is full it
        # becomes the old one.
        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}

    def _plain_words(self) -> bool:
        """Whether every letter has the ids of its lower case, also inside words, and marks are cut from the word before them."""
        cased = " ".join(2 * c for c in LETTERS) + " Aa aA It'S IT'S Don't DON'T"
        if self._ids([cased]) != self._ids([cased.lower()]):
            return False
        marks = [*MARKS, *(2 * m for m in MARKS), ".&&&", ",###", "-'s", ".b", ",É", "-3"]
        whole = self._ids([w + m for m in marks for w in ("a", "word", "é")])
        words, alone = self._ids(["a", "word", "é"]), self._ids(marks)
        return whole == [w + m for m in alone for w in words]

    def _already_normal(self) -> bool:
        """Whether normalisation leaves lower-case words as they are, shown by all pairs of letters."""
        small = sorted(set(LETTERS.lower()))
        pairs = " ".join(a + b for a in small for b in small)
        return self.tokenizer.normalizer is None or self.tokenizer.normalizer.normalize_str(pairs) == pairs

    def _ids(self, texts: list[str]) -> list[bytes]:
        normal = self.bare is not None and all(NORMAL.fullmatch(t) for t in texts)
        found = (self.bare if normal else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn_words(self, missing: list[bytes]) -> None:
        """Encode many words as one text; each ends with a token that is marked as an end."""
        for lo in range(0, len(missing), MAX_WORDS):
            own = missing[lo : lo + MAX_WORDS]
            raw, begin = self._ids([b" ".join(own).decode("utf-8")])[0], 0
            stops = 4 * (np.flatnonzero(self.ends[np.frombuffer(raw, dtype="<u4")]) + 1)
            if len(stops) == len(own):
                for word, stop in zip(own, stops.tolist()):
                    self.chunks[word] = raw[begin:stop]
                    begin = stop
            else:
                self.chunks.update(zip(own, self._ids([w.decode("utf-8") for w in own])))

    def _learn(self, missing: list[bytes]) -> None:
        words = [c for c in missing if WORD.fullmatch(c)] if self.by_word else []
        self._learn_words(words)
        other = [c for c in missing if c not in self.chunks] if words else missing
        self.chunks.update(zip(other, self._ids([c.decode("utf-8") for c in other])))

    def _known(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of different chunks; what is not known is learned."""
        found = list(map(self.chunks.get, wanted))
        missing = {k: wanted[k] for k, ids in enumerate(found) if ids is None}
        if missing and self.old_chunks:
            self.chunks.update((c, ids) for c in missing.values() if (ids := self.old_chunks.get(c)) is not None)
        new = [c for c in missing.values() if c not in self.chunks]
        if new:
            self._learn(new)
        for k, c in missing.items():
            found[k] = self.chunks[c]
        return found

    def _spans(self, joined: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text in which chunks are looked up, and where they begin and end."""
        lowered = joined.translate(LOWERED)
        by_word = self.by_word and not any(t in lowered for t in self.added)
        if by_word and b"\xC3" in lowered:
            data = np.frombuffer(bytearray(lowered), dtype=np.uint8)
            accents = np.flatnonzero(data[:-1] == 0xC3) + 1
            kind = np.frombuffer(KINDS, dtype=np.uint8)[data[accents]]
            data[accents[kind & CAPITAL > 0]] += 32
            accents = accents[kind & (CAPITAL | ACCENTED) > 0]
            joined = data.tobytes()
        else:
            joined, accents = lowered if by_word else joined, None
        kind = np.frombuffer(bytearray(joined.translate(KINDS)), dtype=np.uint8)
        solid = (kind & SOLID).view(bool)
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        if by_word:
            kind &= MARK | LETTER
            if accents is not None:
                kind[accents] = LETTER
            cut = (kind[:-1] == LETTER) & (kind[1:] == MARK)
            begins[1:] |= cut
            ends[:-1] |= cut
        return joined, np.flatnonzero(begins), np.flatnonzero(ends) + 1

    def _encoded(self, texts: list[bytes]) -> list[bytes]:
        joined, begin, end = self._spans(b"\n".join(texts))
        if not len(begin):
            return [b""] * len(texts)
        data, size = np.frombuffer(joined, dtype=np.uint8), end - begin
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[:-1], out=total[1:])
        hashes = mix((total[end] - total[begin]) * down[begin])
        order = np.argsort(hashes)
        fresh = np.concatenate([[True], np.diff(hashes[order]) > 0])
        first, which = order[fresh], np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(fresh) - 1
        # Chunks of one hash are compared with the first of them.
        same = first[which]
        equal = bool((size == size[same]).all())
        if equal:
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            equal = bool((data[at] == data[at + np.repeat(begin[same] - begin, size)]).all())
        if not equal:
            first = which = np.arange(len(begin))
        wanted = [joined[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
        if not equal:
            number = {c: k for k, c in enumerate(dict.fromkeys(wanted))}
            wanted, which = list(number), np.array([number[c] for c in wanted])
        known = self._known(wanted)
        lengths = np.array([len(x) for x in known]) // 4
        starts, n = np.cumsum(lengths) - lengths, lengths[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(known), dtype="<u4")[np.repeat(starts[which] - upto[:-1], n) + np.arange(upto[-1])]
        stops = upto[np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))]
        return [own.tobytes() for own in np.split(ids, stops[:-1])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunk:
            return self._ids(texts)
        if len(self.chunks) > MAX_CHUNKS:
            self.old_chunks, self.chunks = self.chunks, {}
        # Long texts are cut at white space.
        parts, counts = [], []
        for text in texts:
            data, lo = text.encode("utf-8"), 0
            counts.append(len(parts))
            while len(data) - lo > BLOCK and (space := SPACE.search(data, lo + BLOCK)):
                parts.append(data[lo : space.start()])
                lo = space.start()
            parts.append(data[lo:])
        out, held, size = [], [], 0
        for k, part in enumerate(parts):
            held.append(part)
            size += len(part)
            if size >= BLOCK or k == len(parts) - 1:
                out += self._encoded(held)
                held, size = [], 0
        return [b"".join(out[a:b]) for a, b in zip(counts, [*counts[1:], len(parts)])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def encoded(batch, text_at: int, path: str, end_id: int, block: int = BLOCK):
    """(row, ids) for each row of an Arrow batch: the ids of its text and `end_id`; null texts are empty."""
    coder, end = encoder(path), np.uint32(end_id).astype("<u4").tobytes()
    column = batch.column(text_at)
    begin, held, texts = 0, 0, []
    for row in range(batch.num_rows):
        texts.append(column[row].as_py() or "")
        held += len(texts[-1])
        if held >= block or row == batch.num_rows - 1:
            for k, ids in enumerate(coder.encode(texts)):
                yield begin + k, ids + end
            begin, held, texts = row + 1, 0, []
