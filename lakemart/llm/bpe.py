"""Byte-level byte-pair vocabularies: tables, splitting of texts, word caches.

Shared by the encoder (``bpe_codec``) and the counter (``token_counts``). A
text is first cut at the special strings of the file, then into coarse chunks
at white space, then a chunk into words by the splitting pattern. A word's
tokens do not depend on what stands around it, so each worker remembers the
chunks that it has seen, within a bound.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import regex

# White space as Unicode defines it, and the public splitting
# pattern of byte-level vocabularies with that class written out.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

_CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_WORD = regex.compile(WORDS)
#: Characters whose classes are the same in every Unicode version in use; a
#: text with others is split by the library's own splitter.
_UNCOMMON = re.compile("[^\\x00-\\u036f\\u2000-\\u2064\\u20ac]")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in chars:
            chars[b], extra = chr(256 + extra), extra + 1
    return [chars[b] for b in range(256)]


class ByteVocabulary:
    """Tables of a byte-level BPE file and the splitting of texts into words."""

    def __init__(self, text: str):
        spec = json.loads(text)
        ids = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.byte_id = [ids[c] for c in alphabet]
        self.token_bytes: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        self.token_bytes.update({i: t.encode() for t, i in self.specials.items()})
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        #: (left id, right id, merged id) by rank
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._text, self._library = text, None

    def segments(self, text: str) -> Iterable[tuple[str, bool]]:
        """(part, is special) in order; empty parts are left out."""
        if self._special is None or not text:
            return [(text, False)] if text else []
        return [(p, p in self.specials) for p in self._special.split(text) if p]

    def chunks(self, part: str) -> list[str]:
        """Coarse chunks whose words do not depend on their neighbours."""
        if _UNCOMMON.search(part):
            if self._library is None:
                from tokenizers import Tokenizer
                self._library = Tokenizer.from_str(self._text).pre_tokenizer
            return [part[i:j] for _, (i, j) in self._library.pre_tokenize_str(part)]
        return _CHUNK.findall(part)

    @staticmethod
    def words(chunk: str) -> list[str]:
        return [chunk] if _UNCOMMON.search(chunk) else _WORD.findall(chunk)


class ChunkCache:
    """Chunk -> value, bounded: emptied between slices once it is full."""

    def __init__(self, limit: int):
        self.limit, self.values = limit, {}

    def room(self) -> None:
        if len(self.values) > self.limit:
            self.values.clear()
