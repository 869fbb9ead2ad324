"""Texts to token ids with the tokenizers library, inside a task."""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quern.llm.words import split_words

#: Words one encoder remembers, in two generations of half as many each; bounds a worker's memory.
REMEMBERED_WORDS = 600_000

END_PUNCTUATION = ".,;:!?"


class TextEncoder:
    """Token ids of whole texts.

    A vocabulary that drops white space encodes each word apart from its neighbours, so the
    library is asked once per new word and the answers are joined. Other vocabularies get whole
    texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_word = _drops_white_space(json.loads(self.tokenizer.to_str()))
        self.remembered = remembered
        self.model = self.tokenizer.model
        self.letters = Letters(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
        self.words: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another (unsigned 32 bits), and how many each text has."""
        if not self.by_word:
            found = [self.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            return np.array([i for f in found for i in f], "<u4"), np.array([len(f) for f in found], np.int64)
        distinct, codes, words = split_words(texts)
        if len(self.words) > self.remembered // 2:
            # A word in use moves on to the next generation, so frequent ones are never forgotten.
            self.older, self.words = self.words, {"": b""}
        known, older = self.words, self.older
        new = []
        for word in distinct:
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    known[word] = ids
        self._learn(new)
        held = [known[w] for w in distinct]
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(held), "<u4")
        own = sizes[codes]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(starts[codes] - ends + own, own) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])]
        return ids, np.diff(bounds)

    def _learn(self, words: list[str]) -> None:
        """Remembers the ids of new words."""
        if not words:
            return
        stems = pc.utf8_rtrim(pa.array(words, pa.string()), characters=END_PUNCTUATION)
        simple = pc.and_(pc.string_is_ascii(stems), pc.ascii_is_alpha(stems)).to_pylist()
        rest = []
        for word, stem, ascii_letters in zip(words, pc.ascii_lower(stems).to_pylist(), simple):
            if not ascii_letters:
                given = word[: len(stem)]
                if not _plain(given):
                    rest.append(word)
                    continue
                stem = given.lower()
            self._remember(word, stem, len(word) - len(stem) if ascii_letters else len(word) - len(given))
        if rest:
            found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
            self.words.update((w, array("I", e.ids).tobytes()) for w, e in zip(rest, found))

    def _remember(self, word: str, stem: str, ending: int) -> None:
        """A word whose stem and ``ending`` last characters are encoded apart."""
        known = self.words
        ids = known.get(stem)
        if ids is None:
            ids = known[stem] = self._piece(stem)
        if ending:
            end = word[-ending:]
            if end not in self.ends:
                self.ends[end] = self._piece(end)
            ids += self.ends[end]
        known[word] = ids

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece that the vocabulary's own splitting would not cut further."""
        shown = piece if piece.isascii() else piece.translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()


class Letters(dict):
    """What byte-level vocabularies write for a character, by code point; filled as asked for."""

    def __init__(self, byte_level):
        super().__init__()
        self.byte_level = byte_level

    def __missing__(self, code: int) -> str:
        self[code] = shown = self.byte_level.pre_tokenize_str(chr(code))[0][0]
        return shown


def _plain(stem: str) -> bool:
    """A run of Latin letters that stays one run of letters in normal form and lower case."""
    return (
        stem != ""
        and (stem.isascii() or (max(stem) < "ɐ" and unicodedata.is_normalized("NFC", stem)))
        and stem.isalpha()
        and stem.lower().isalpha()
    )


def _drops_white_space(spec: dict) -> bool:
    """Whether the vocabulary cuts at white space and forgets it, then sees lower-cased bytes."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    kinds = [s.get("type") for s in ((spec.get("normalizer") or {}).get("normalizers") or [])]
    return (
        len(steps) == 2
        and steps[0].get("type") == "Split"
        and steps[0].get("behavior") == "Removed"
        and bool(steps[0].get("invert"))
        and steps[1].get("type") == "ByteLevel"
        and kinds == ["NFC", "Replace", "Lowercase"]
        and spec.get("post_processor") is None
    )


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and vocabulary file."""
    return TextEncoder(path)
