"""Token ids of whole texts with a public tokenizer, as bytes.

The tokenizer works on words on their own (it drops white space and splits at
every change between letters, digits and marks), so a text's ids are its words'
ids put together. Words repeat: their ids are kept in a bounded cache per Python
worker, and a new word goes through the tokenizers library's model. Chunks with
characters outside the plain set below go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

# The split pattern of the vocabulary file, for the plain
# characters, where it needs no Unicode tables.
NOT_PLAIN = re.compile("[^\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]")
PLAIN_WORDS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes for themselves, the others for 256 and up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Words(dict):
    """Word -> ids as bytes; a missing word is encoded and kept."""

    def __init__(self, model, most: int, longest: int = 64):
        super().__init__()
        self.model, self.most, self.longest = model, most, longest
        self.alphabet = byte_alphabet()

    def __missing__(self, word: str) -> bytes:
        known = word if word.isascii() else "".join([self.alphabet[b] for b in word.encode()])
        ids = array("I", [t.id for t in self.model.tokenize(known)]).tobytes()
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class _Chunks(dict):
    """Chunk with other characters -> ids by the whole tokenizer."""

    def __init__(self, tokenizer, most: int, longest: int = 64):
        super().__init__()
        self.tokenizer, self.most, self.longest = tokenizer, most, longest

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(chunk) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit, as bytes), no special tokens added."""

    def __init__(self, path: str, most_cached: int = 150_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # words are kept below, once
        self.words = _Words(self.tokenizer.model, most_cached)
        self.chunks = _Chunks(self.tokenizer, most_cached // 5)
        # the text of an added token, where it occurs, is that token
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, marks)) or "(?!)")

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, PLAIN_WORDS.findall(text.lower())))

    def _is_plain(self, text: str) -> bool:
        return not NOT_PLAIN.search(text) and not self.added.search(text)

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._is_plain(text):
            return self._plain(text)
        # spaces and line breaks end every word, so chunks can be encoded apart
        return b"".join([self._plain(c) if self._is_plain(c) else self.chunks[c]
                         for c in text.replace("\n", " ").split(" ") if c])

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [self.one(t) for t in texts]


def text_slices(batch, most_chars: int = 1 << 21):
    """Row ranges of an Arrow batch (text column) of bounded total length."""
    import pyarrow.compute as pc
    length = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(length)
    begin, n = 0, len(length)
    while begin < n:
        done = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, done + most_chars, side="right")), begin + 1)
        yield begin, min(end, n)
        begin = end
