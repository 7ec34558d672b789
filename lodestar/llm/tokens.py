"""Token ids of the public byte-level vocabulary, by words and a bounded memo.

The ids of a text are the ids of its pre-tokens in order, so each distinct
pre-token is encoded once per task and its ids are kept as little-endian
unsigned 32-bit bytes: a text's ids are one join of byte strings."""

from __future__ import annotations

import array
import re
import sys

END_OF_TEXT = "<|endoftext|>"

# Letters, digits and white space of the first 256 code points, for texts that
# hold no others; all other texts take the general pattern.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class ByteBpe:
    """Encodes whole texts like the library does for ``byte_bpe_50k.json``
    (no added tokens; the special string inside a text is its own id)."""

    def __init__(self, vocabulary: str = "byte_bpe_50k.tiktoken", end_id: int = 50256, memo: int = 600_000):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoder = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._general = None
        self._pattern_text = public_tokenizers.PATTERN
        self._end = packed([end_id])
        self._words = _Memo(self._encoder.encode_ordinary, memo)

    def packed(self, text: str) -> bytes:
        """The ids of the text as little-endian unsigned 32-bit bytes."""
        if END_OF_TEXT in text:
            return self._end.join(map(self.packed, text.split(END_OF_TEXT)))
        try:
            text.encode("latin-1")
            pieces = _LATIN.findall(text)
        except UnicodeEncodeError:
            if self._general is None:
                import regex

                self._general = regex.compile(self._pattern_text)
            pieces = self._general.findall(text)
        return b"".join(map(self._words.__getitem__, pieces))


class _Memo(dict):
    """Pre-token -> packed ids; emptied when full, so memory stays bounded."""

    def __init__(self, encode, most: int):
        super().__init__()
        self._encode, self._most = encode, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self._most:
            self.clear()
        out = packed(self._encode(word))
        if len(word) <= 64:
            self[word] = out
        return out


def packed(ids: list[int]) -> bytes:
    a = array.array("I", ids)
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()
