"""Token ids of whole texts under a vocabulary that splits words at white space.

The vocabulary's pre-tokeniser never joins what ASCII white space divides, so a text's ids are
those of its pieces between white space, one after the other. Pieces repeat; each task worker
keeps the ids of those seen, in a dictionary of bounded size that is emptied when full. Literals of the
vocabulary's special tokens, which hold no white space, are read as the library does by default: as one id.
"""

from __future__ import annotations

from array import array

# The bytes that stand for themselves in byte-level vocabularies; the others
# follow from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
_LETTER = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(_HIDDEN)}
_SIGNS = ".,;:!?|"  # ASCII signs that the vocabulary's pattern never joins to letters

MOST_PIECES = 400_000


class Words(dict):
    """The ids of each piece, as little-endian unsigned 32-bit numbers; learned on first use."""

    def __init__(self, path: str, most: int = MOST_PIECES):
        super().__init__()
        from tokenizers import Tokenizer

        self._all = Tokenizer.from_file(path)
        self._norm, self._model = self._all.normalizer, self._all.model
        self._letters: dict[str, bytes] = {}
        self._most = most

    def _slow(self, piece: str) -> bytes:
        return array("I", self._all.encode(piece, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        found = self._letters.get(word)
        if found is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTER)
            found = self._letters[word] = array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()
        return found

    def __missing__(self, raw: bytes) -> bytes:
        piece = raw.decode("utf-8", "replace")
        plain = piece.lower() if piece.isascii() else self._norm.normalize_str(piece)
        word = plain.rstrip(_SIGNS)
        if word.isalpha() and len(piece) < 200:
            found = self._word(word)
            if len(word) < len(plain):
                signs = plain[len(word) :]
                end = self._letters.get(signs)
                if end is None:
                    end = self._letters[signs] = self._slow(signs)
                found += end
        else:
            found = self._slow(piece)
        if len(raw) < 200:
            self[raw] = found
        return found

    def ids(self, text: bytes) -> bytes:
        """All ids of a UTF-8 text, four bytes each."""
        if len(self) > self._most:
            self.clear()
            self._letters.clear()
        return b"".join(map(self.__getitem__, text.split()))


_KEPT: dict[str, Words] = {}


def words(path: str) -> Words:
    """The dictionary of this worker for a vocabulary file."""
    if path not in _KEPT:
        _KEPT[path] = Words(path)
    return _KEPT[path]
