"""Token ids of the ``tokenizers`` library, with a cache for the pieces of a text.

Both public vocabularies handle a text piece by piece, so a text can be cut at
white space, each distinct piece encoded once by the library and the ids
joined. ``Encoder`` does that for the two shapes it knows (word-end BPE that
drops white space; byte-level BPE whose tokens carry their leading space) and
gives every other text or tokenizer to the library whole. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
from array import array

import numpy as np

# Marks that no pre-token mixes with letters (no apostrophe: contractions are tokens of their own).
_MARKS = ".,!?;:$%&*#"
# Fixed rule of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others for 256, 257, ...
_ODD_BYTES = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(_ODD_BYTES)}


class _OddSpace(Exception):
    """White space that can't be cut at."""


def _is_run(piece: str) -> bool:
    """Latin-1 letters only: one pre-token, lower-cased letter by letter, never recomposed."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= "\xff")


class _Cache(dict):
    """piece -> ids as little-endian uint32 bytes; emptied when it holds ``limit`` pieces."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[piece] = self.encode(piece)
        return ids


class Encoder:
    """text -> ids as little-endian uint32 bytes. ``cache`` bounds the pieces held."""

    def __init__(self, path: str, cache: int = 500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.runs = _Cache(self._run, cache)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not model.get("byte_fallback") and not model.get("dropout")
        if plain and model.get("end_of_word_suffix") == "</w>" and spec.get("normalizer"):
            self.pieces = _Cache(self._word, cache)
            self.encode = self._by_word
        elif plain and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer"):
            self.first = _Cache(lambda piece: self._spaced("", piece), cache)
            self.pieces = _Cache(lambda piece: self._spaced(" ", piece), cache)
            self.newline = self._whole("\n")
            self.encode = self._by_space
        else:
            self.encode = self._whole

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        """A run of letters (with a leading space, perhaps): one pre-token, straight to the BPE model."""
        text = run.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return array("I", [token.id for token in self.model.tokenize(text)]).tobytes()

    def _word(self, piece: str) -> bytes:
        letters = piece.rstrip(_MARKS)
        if not _is_run(letters):
            return self._whole(piece)
        ids = self.runs[letters.lower()]
        return ids + self.pieces[piece[len(letters):]] if len(letters) < len(piece) else ids

    def _by_word(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))

    def _spaced(self, space: str, piece: str) -> bytes:
        letters = piece.rstrip(_MARKS)
        if _is_run(letters):
            ids = self.runs[space + letters]
            return ids + self.first[piece[len(letters):]] if len(letters) < len(piece) else ids
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _OddSpace
        return self._whole(space + piece)

    def _by_space(self, text: str) -> bytes:
        """Cuts at spaces and newlines that stand alone between other characters."""
        piece, first, newline = self.pieces.__getitem__, self.first, self.newline
        out: list[bytes] = []
        try:
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                if head or out or not rest:  # only the text's first piece may be empty, before a space
                    out.append(first[head])
                out += map(piece, rest)
                out.append(newline)
        except _OddSpace:
            return self._whole(text)
        out.pop()
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one in each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
