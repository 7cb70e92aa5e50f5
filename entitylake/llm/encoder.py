"""Token ids of whole texts by a public tokenizer, as bytes of little-endian 32-bit numbers.

The vocabulary's byte-level pattern never lets a token reach over the edge before a space that
follows a character other than white space. So a text falls into pieces that are encoded apart
with the same result, and a worker encodes each different piece once, as long as its bounded memo
holds it. A new piece of letters, digits, ASCII signs (no apostrophe) and single line breaks falls
apart once more, at the edges between those: the pattern never joins them either, and most of the
parts are known. Any other piece, and any whole text with the string of an added token such as
``<|endoftext|>``, is given to the library as it is.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Sequence
from functools import cache

import public_tokenizers

VOCABULARY = "byte_bpe_50k.json"

#: Pieces kept by one worker, and the longest piece that is kept.
MEMO_PIECES = 600_000
MEMO_CHARS = 48

_UNSAFE = re.compile(r"\s ")
_EDGE = re.compile(r"(?<=\S) ")

#: Letters up to here are one token pattern run in every version of Unicode.
_LAST_LETTER = "ɏ"
_LETTERS, _DIGITS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", "0-9", r"!-&(-/:-@\[-`{-~"
_SIMPLE = re.compile(f"[{_LETTERS}{_DIGITS}{_SIGNS}]+(?:\n[{_LETTERS}{_DIGITS}{_SIGNS}]+)*")
_PART = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]+|[{_SIGNS}]+|\n")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


class _Parts(dict):
    """Maps what the pattern takes as one stretch, with the space before it, to its ids."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, part: str) -> bytes:
        word = part.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.model.tokenize(word)]
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[part] = found
        return found


class PieceEncoder(dict):
    """Encodes texts. As a dictionary it maps a piece (the text after an edge's space) to its ids."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = _Parts(self.tokenizer.model)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _apart(self, piece: str, space: str) -> bytes:
        """The ids of a piece with the space before it, part by part where that is the same."""
        if piece.isalpha() and max(piece) <= _LAST_LETTER:
            return self.parts[space + piece]
        if not _SIMPLE.fullmatch(piece):
            return self.whole(space + piece)
        parts = _PART.findall(piece)
        parts[0] = space + parts[0]
        return b"".join(map(self.parts.__getitem__, parts))

    def __missing__(self, piece: str) -> bytes:
        found = self._apart(piece, " ")
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = found
        return found

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; none for a null text."""
        found = []
        for text in texts:
            text = text or ""
            if any(string in text for string in self.added):
                found.append(self.whole(text))
                continue
            pieces = _EDGE.split(text) if _UNSAFE.search(text) else text.split(" ")
            found.append(self._apart(pieces[0], "") + b"".join(map(self.__getitem__, pieces[1:])))
        return found


@cache
def encoder(vocabulary: str = VOCABULARY) -> PieceEncoder:
    """One encoder per worker and vocabulary."""
    return PieceEncoder(public_tokenizers.path(vocabulary))
