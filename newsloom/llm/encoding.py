"""Token ids of whole texts by a public vocabulary file, word by word through a memo."""

from __future__ import annotations

import string
import unicodedata
from functools import lru_cache

import numpy as np

END = 1
WORDS = 900_000
#: Pieces that are encoded as one text.
GROUP = 500
_END_BYTES = np.array([END], dtype="<u4").tobytes()
#: Stands between the pieces of such a text.
_MARK = b"\x01"
_SYMBOLS = string.punctuation.encode()
#: The start of a special token, and of accents that some letters are composed with in lower case only (U+0300 on, U+0344).
_CASED = (b"<|", b"\xcc", b"\xcd\x84")


@lru_cache(4096)
def _letter(ending: bytes) -> bool:
    """Whether a text of this ending has a letter as its last character, composed and in lower case too."""
    return unicodedata.normalize("NFC", ending.decode("utf-8", "replace")[-1]).lower().isalpha()


class Encoder:
    """Ids of a text as the ``tokenizers`` library gives them, for vocabularies that drop white space.

    Such a vocabulary never joins what stands on two sides of a blank, nor a letter and the ASCII symbols behind it, so
    a text is cut there and each distinct piece is encoded once. New pieces are encoded together, as texts in which a
    mark stands between them, and told apart by its id. Ids are kept as little-endian 32-bit numbers, so a text is the
    joined bytes of its pieces. ``path`` names the vocabulary file; it must be readable on every executor.
    At most ``words`` pieces are remembered.
    """

    def __init__(self, path: str, words: int = WORDS):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._words = words
        self._ids: dict[bytes, bytes] = {}
        mark = self._encoded(_MARK)
        self._mark = int(mark[0]) if len(mark) == 1 else -1

    def _encoded(self, text: bytes) -> np.ndarray:
        found = self._tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(found[0].ids, dtype="<u4")

    def _encode(self, pieces: list[bytes]) -> None:
        for start in range(0, len(pieces), GROUP):
            group = pieces[start : start + GROUP]
            ids = self._encoded((b" " + _MARK + b" ").join(group))
            marks = np.flatnonzero(ids == self._mark) * 4
            if len(marks) == len(group) - 1:
                data = ids.tobytes()
                places = map(slice, [0, *(marks + 4).tolist()], [*marks.tolist(), len(data)])
                self._ids.update(zip(group, map(data.__getitem__, places)))
            else:  # A piece has the mark itself.
                for x in group:
                    self._ids[x] = self._encoded(x).tobytes()

    def _learn(self, pieces: set[bytes]) -> None:
        whole, cut = [], []
        for piece in pieces:
            stem = piece.rstrip(_SYMBOLS)
            if len(stem) == len(piece) or not stem or b"<|" in piece:
                whole.append(piece)
            elif stem[-1:].isalpha() or stem[-1] > 127 and _letter(stem[-4:]):
                cut.append((piece, stem, piece[len(stem) :]))
            else:
                whole.append(piece)
        self._encode(whole)
        self._encode(list({x for _, *parts in cut for x in parts if x not in self._ids}))
        for piece, stem, symbols in cut:
            self._ids[piece] = self._ids[stem] + self._ids[symbols]

    def many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as bytes, closed by ``END``."""
        if len(self._ids) > self._words:
            self._ids = {}
        # Marks of special tokens are told apart by case, and so are letters before a combining accent; others are not.
        words = [(x if any(map(x.__contains__, _CASED)) else x.lower()).split() for x in texts]
        found = [list(map(self._ids.get, x)) for x in words]
        gaps = [(x, ids, [i for i, known in enumerate(ids) if known is None]) for x, ids in zip(words, found) if None in ids]
        if gaps:
            self._learn({x[i] for x, _, places in gaps for i in places})
            for x, ids, places in gaps:
                for i in places:
                    ids[i] = self._ids[x[i]]
        return [b"".join(x) + _END_BYTES for x in found]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        import os

        # The tasks already use every core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
