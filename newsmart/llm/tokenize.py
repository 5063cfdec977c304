"""Token ids and counts with the public tokenizers.

Words are what ASCII white space separates. The word tokenizer drops it and has no pattern
that reaches across it, so a text's ids are the ids of its words in turn, and each worker
keeps the words it has met. That memory is bounded by two generations of words; forgetting
changes no result."""

from __future__ import annotations

import os
import struct
from collections.abc import Callable

WORDS_KEPT = 200_000
WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_LOADED: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a file, once a process, on one thread."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


class WordIds(dict):
    """Word (UTF-8) -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.stops = {mark: self._whole(mark.decode()) for mark in (b".", b",")}

    def _whole(self, word: str) -> bytes:
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        out = self.older.get(word)
        if out is None:
            if word.isalpha():  # ASCII letters: one pre-token, and its bytes stand for themselves
                out = _packed([t.id for t in self.model.tokenize(word.decode().lower())])
            elif word[-1:] in self.stops and word[:-1].isalpha():  # and a stop: two pre-tokens
                return self[word[:-1]] + self.stops[word[-1:]]
            else:
                out = self._other(word.decode(errors="replace"))
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out

    def _other(self, word: str) -> bytes:
        low = word.lower()
        stop = b""
        if low[-1:] in (".", ",") and low[:-1].isalpha():
            low, stop = low[:-1], self.stops[low[-1:].encode()]
        if low.isalpha() and max(low) < "\u0250":  # composed Latin letters: one pre-token too
            stand_in = "".join([_BYTE_CHARS[b] for b in low.encode()])
            return _packed([t.id for t in self.model.tokenize(stand_in)]) + stop
        return self._whole(word)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others take
#: the characters from 256 on, in order.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = iter(range(256, 512))
_BYTE_CHARS = [chr(b if b in _PRINTED else next(_OTHERS)) for b in range(256)]


_WORDS: dict[str, WordIds] = {}


def ids_as_bytes(name: str = WORD_BPE) -> Callable[[bytes | None], bytes]:
    """A function from a text (UTF-8) to its ids, for the lower-casing word tokenizer. Letters
    are lowered before the lookup only to meet more words again; not where the text might hold
    the string of a special token, which is matched as written."""
    path = tokenizer_path(name)
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    get = _WORDS[path].__getitem__

    def ids(text: bytes | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(get, (text if b"<|" in text else text.lower()).split()))

    return ids
