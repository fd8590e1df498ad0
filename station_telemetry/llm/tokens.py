"""Token ids by a public tokenizer, with what it makes of a word remembered.

The tokenizer's own rules never look across white space, so a text's ids are those of its
words, one after the other. Words repeat, and remembering them saves most of the work. Bytes that
are not UTF-8 count as U+FFFD, the replacement character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered in a Python worker; beyond, those not seen since the last turn are forgotten.
MEMORY_WORDS = 600_000
_LONG_WORD = 64
_TOGETHER = 400

_MEMORIES: dict[str, "WordTokens"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """Ids of texts as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory_words = memory_words
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}
        self.older_stems: dict[bytes, bytes] = {}
        self.lowers = self._one("A") == self._one("a")
        self.marks = {m: self._one(m.decode()) for m in (b",", b".")} if self._parts() else {}

    @classmethod
    def of(cls, path: str, memory_words: int = MEMORY_WORDS) -> "WordTokens":
        """One for each Python worker, which keeps what it has learned over tasks."""
        if path not in _MEMORIES:
            _MEMORIES[path] = cls(path)
        _MEMORIES[path].memory_words = memory_words
        return _MEMORIES[path]

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _parts(self) -> bool:
        """Whether letters and a mark after them are separate pieces to this tokenizer."""
        return self.tokenizer.encode("ab,", add_special_tokens=False).word_ids[-1] == 1

    def _learn_letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters only, many in one text; each must come back as one piece."""
        out = {}
        for k in range(0, len(words), _TOGETHER):
            own = words[k : k + _TOGETHER]
            found = self.tokenizer.encode(b" ".join(own).decode(), add_special_tokens=False)
            piece = np.array(found.word_ids, np.int64)
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(np.diff(piece, prepend=-1))
            if len(cuts) != len(own) or (len(piece) and piece[-1] != len(own) - 1):
                out.update(self._learn_any(own))
                continue
            data, stops = ids.tobytes(), np.append(cuts[1:], len(ids)) * 4
            out.update((w, data[a:b]) for w, a, b in zip(own, (cuts * 4).tolist(), stops.tolist()))
        return out

    def _learn_any(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(words, found)}

    def _stem(self, word: bytes) -> tuple[bytes, bytes]:
        """A word without capitals and a last mark, where these make no difference, and the mark."""
        mark = b""
        if word[-1:] in self.marks and word[-2:-1].isalnum():
            word, mark = word[:-1], word[-1:]
        return (word.lower() if self.lowers and b"<|" not in word else word), mark

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        stems = {w: self._stem(w) for w in words}
        found = {}
        for stem, _ in stems.values():
            ids = self.known.get(stem) or self.older.get(stem)
            if ids is not None:
                found[stem] = ids
        fresh = {stem for stem, _ in stems.values()} - found.keys()
        letters = [s for s in fresh if len(s) <= _LONG_WORD and s.decode("utf-8", "replace").isalpha()] if self.marks else []
        found.update(self._learn_letters(letters))
        rest = list(fresh.difference(letters))
        found.update(self._learn_any(rest) if rest else {})
        out = {w: found[stem] + self.marks.get(mark, b"") for w, (stem, mark) in stems.items()}
        return out

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        split = [t.split() if t else [] for t in texts]
        if len(self.known) > self.memory_words:
            self.older, self.known = self.known, {}
        known = self.known
        missing = set().union(*split).difference(known)
        again = {w: self.older[w] for w in missing if w in self.older}
        known.update(again)
        known.update(self._learn(missing.difference(again)))
        return [b"".join([known[w] for w in words]) for words in split]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin; null counts as empty.

        Arrow splits and numbers the words, then cuts the distinct ones to stems and numbers these, so
        only the distinct stems of a batch are looked up.
        """
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        numbered = words.flatten().dictionary_encode()
        stems, mark = self._cut_marks(numbered.dictionary.cast(pa.binary()))
        stems = stems.dictionary_encode()
        parts = self._of_stems(stems.dictionary.to_pylist())
        of_mark = len(parts) + mark
        parts += [b"", *self.marks.values()]
        pool = np.frombuffer(b"".join(parts), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        begin = np.cumsum(size) - size
        word = numbered.indices.to_numpy()
        # Every word is two pieces, its stem and its mark or nothing.
        at = np.empty(2 * len(word), np.int64)
        at[0::2], at[1::2] = stems.indices.to_numpy()[word], of_mark[word]
        count = size[at]
        stop = np.concatenate(([0], np.cumsum(count)))
        ids = pool[np.arange(stop[-1]) + np.repeat(begin[at] - stop[:-1], count)]
        return ids, stop[2 * (words.offsets.to_numpy() - words.offsets[0].as_py())]

    def _cut_marks(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """What `_stem` makes of each word: stems, and the number of the mark, 0 for none."""
        mark = np.zeros(len(words), np.int64)
        for k, m in enumerate(self.marks):
            ends = pc.match_substring_regex(words, f"[0-9A-Za-z]\\{m.decode()}$")
            mark[ends.to_numpy(zero_copy_only=False)] = k + 1
        stems = pc.if_else(pa.array(mark > 0), pc.binary_slice(words, 0, -1), words)
        if self.lowers:
            lower = pc.ascii_lower(stems.view(pa.string())).view(pa.binary())
            stems = pc.if_else(pc.match_substring(stems, "<|"), stems, lower)
        return stems, mark

    def _of_stems(self, stems: list[bytes]) -> list[bytes]:
        """Ids of each stem; those not met before are learned, many at once."""
        if len(self.stems) > self.memory_words:
            self.older_stems, self.stems = self.stems, {}
        known, older = self.stems, self.older_stems
        known[b""] = b""
        parts = [known.get(s) for s in stems]
        missing = [k for k, ids in enumerate(parts) if ids is None]
        fresh = []
        for k in missing:
            parts[k] = older.get(stems[k])
            if parts[k] is None:
                fresh.append(stems[k])
        letters = [s for s in fresh if len(s) <= _LONG_WORD and s.decode("utf-8", "replace").isalpha()] if self.marks else []
        learned = self._learn_letters(letters)
        rest = [s for s in fresh if s not in learned]
        learned.update(self._learn_any(rest) if rest else {})
        for k in missing:
            if parts[k] is None:
                parts[k] = learned[stems[k]]
            known[stems[k]] = parts[k]
        return parts


def texts_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()
