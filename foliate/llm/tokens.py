"""Token ids of whole texts by a public vocabulary, each distinct word encoded once per worker."""

from __future__ import annotations

import re
from functools import lru_cache

#: Id that ends each document.
END_ID = 2

#: Distinct words that a worker remembers (some 200 bytes each).
CACHE_WORDS = 250_000

#: Characters of texts whose words the short way below splits as the tokenizer would: no combining marks, no character whose
#: lower case depends on its neighbours, and only white space that both sides know.
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\u012f\\u0131-\\u0148\\u014a-\\u017e]*")

#: The words of the vocabulary's own pattern, in lower-case plain texts.
_LETTERS, _NUMBERS = "a-z\\xaa\\xb5\\xba\\xdf-\\xf6\\xf8-\\u017e", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


def vocabulary(path: str | None = None) -> str:
    """The vocabulary file: path, or the public one of this environment."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self.make(word)
        return ids


class Encoder:
    """encode(text) gives a text's ids as little-endian 32-bit integers, equal to the tokenizers library's for the whole text.

    No token spans white space, so words are encoded one by one and remembered. In plain texts (see _PLAIN) words are
    the pattern's own matches and go to the library's BPE model; words of other texts go through all of the library's steps.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(vocabulary(path))
        model, letters = self.whole.model, {}
        for code in range(256):  # the byte alphabet, as the library writes it
            for piece, _ in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code)):
                raw = chr(code).encode()
                letters.update(zip(raw, piece, strict=True))
        table = {i: letters.get(i, chr(i)) for i in range(256)}

        def word(w: str) -> bytes:
            return b"".join(t.id.to_bytes(4, "little") for t in model.tokenize(w.encode().decode("latin1").translate(table)))

        def other(w: str) -> bytes:
            return b"".join(i.to_bytes(4, "little") for i in self.whole.encode(w, add_special_tokens=False).ids)

        self.word, self.other = _Cache(word), _Cache(other)

    def encode(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.word.__getitem__, _WORDS.findall(text.lower())))
        return b"".join(map(self.other.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)


def with_end(text: str | None, path: str | None = None) -> bytes:
    """The ids of a text (null: empty) and END_ID, 4 bytes each."""
    return (encoder(path).encode(text) if text else b"") + END_ID.to_bytes(4, "little")
