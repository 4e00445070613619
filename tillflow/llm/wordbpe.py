"""Token ids of a word-level BPE tokenizer file, by word parts, with a bounded cache.

No token of such a tokenizer spans white space, and its normaliser treats
characters one by one. A text is lower-cased and cut into parts by the
tokenizer's own split pattern, in one pass each; the ids of a part come from a
cache or, if it is not there, from the library's BPE model alone. Only words
with characters outside basic Latin letters, or holding a special token's text,
are encoded whole by the library, as is a text with the separators 0x1C-0x1F,
on which Python and the library disagree.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

MAX_PARTS, MAX_CACHED = 300_000, 40

_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|[^\sA-Za-z0-9ª²³µ¹º¼-¾À-ÖØ-öø-ʯⱥⱦ]+")  # small letters of capitals up to U+024F, too
# one code point that str.lower and the library treat alike, composed or not: up to U+024F, without the
# superscripts, fractions and ordinals whose class differs between the two pattern languages
_PLAIN = re.compile(r"[\x21-\x7e¡-©«-±´¶-¸»¿-įı-ɏ \t-\r]*")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_TOKENIZERS: dict[str, WordBpe] = {}


class WordBpe:
    """``ids(text)`` gives the little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.parts: dict[str, bytes] = {}
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]

    def _encode(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        # the model reads printable ASCII as it is, other bytes in the pre-tokenizer's letters
        cut = [part] if part.isascii() and part.isprintable() else [x for x, _ in self.lib.pre_tokenizer.pre_tokenize_str(part)]
        got = np.array([t.id for x in cut for t in self.model.tokenize(x)], "<u4").tobytes()
        if len(self.parts) < MAX_PARTS and len(part) <= MAX_CACHED:
            self.parts[part] = got
        return got

    def _plain(self, text: str) -> bytes:
        cut = _PARTS.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())
        get = self.parts.get
        found = list(map(get, cut))
        if None in found:
            found = [x if x is not None else get(part) or self._part(part) for x, part in zip(found, cut)]
        return b"".join(found)

    def _is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def ids(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self._encode(text)
        if self._is_plain(text):
            return self._plain(text)
        return b"".join([self._plain(w) if self._is_plain(w) else self._encode(w) for w in text.split()])


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, one per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordBpe(path)
    return _TOKENIZERS[path]
