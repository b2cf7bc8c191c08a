"""Whole-text encoding by the ``tokenizers`` library, remembering what was encoded before.

Both kinds of tokenizer supported here cut a text by a fixed pattern and encode every piece alone.  On a text of ASCII and Latin
letters only, that pattern needs no tables of Unicode: it is applied here (``plain_pieces``), every distinct piece goes to the library's
model once and its ids are remembered.  Pieces are bare words and marks, so a memory of them is small and soon complete.

Any other text is cut at places that the pattern always cuts: with ``spaces=True`` (byte-level, a word carries the one space before
it) between a non-space character and a single white-space character that is followed by a non-space one; with ``spaces=False``
(white space dropped) at every ASCII white space.  Chunks of plain characters go the way above, each other one is normalised, cut and
encoded by the library itself, once, then remembered.  The result equals encoding the whole text in one call (tested), at several
times the speed.

Memory is bounded: two generations of at most ``keep`` pieces each; when the younger is full it becomes the older.  Pieces of more
than ``LONG`` characters are not remembered, so the bound holds in bytes too.
"""

from __future__ import annotations

import re
from array import array

from tokenizers import Tokenizer

_RUNS = re.compile(r"\s\s")
# Characters that Python and the tokenizer's pattern might class differently as white space.
_DOUBTFUL = re.compile("[\x1c-\x1f\x85\u180e]")
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
LONG = 64

# Letters up to U+017F but one that grows when lower-cased: letters in any version of Unicode, in composed form, and so are
# their lower-case forms.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f"
_WHITE = r"\x20\x09-\x0D"
_PLAIN = re.compile(f"[\x00-\x7f{_LETTERS}]*")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_BARE_PIECES = re.compile(f"{_ENDINGS}|[{_LETTERS}]+|[0-9]|[^{_WHITE}{_LETTERS}0-9]+")
_SPACED_PIECES = re.compile(
    f"{_ENDINGS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_WHITE}{_LETTERS}0-9]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None


def plain_pieces(text: str, spaces: bool) -> list[str]:
    """The pieces of a plain text; with ``spaces=False`` lower-cased."""
    return _SPACED_PIECES.findall(text) if spaces else _BARE_PIECES.findall(text.lower())


def _byte_letters() -> dict[int, str]:
    """Byte-level models see each byte as a printable character: itself where it has one, else from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_letters()


def byte_letters(piece: str) -> str:
    """A piece as byte-level models see it."""
    return piece.encode().decode("latin-1").translate(_BYTES)


class Memory(dict):
    """dict from key to value that computes what is missing; bounded by two generations, long keys are not kept."""

    def __init__(self, compute, keep: int):
        super().__init__()
        self.compute, self.keep, self.old = compute, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONG:
                return value
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    def __init__(self, path: str, spaces: bool, keep: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text when they occur in a document.
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        self._normalizer, self._cutter, self._model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        self._plain = Memory(lambda piece: self._ids(byte_letters(piece)), keep)
        self._chunks = Memory(self._chunk, keep)

    def _ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if is_plain(chunk):
            return self._plain_text(chunk)
        if self._normalizer is not None:
            chunk = self._normalizer.normalize_str(chunk)
        return b"".join([self._ids(piece) for piece, _ in self._cutter.pre_tokenize_str(chunk)])

    def _plain_text(self, text: str) -> bytes:
        return b"".join(map(self._plain.__getitem__, plain_pieces(text, self.spaces)))

    def whole(self, text: str) -> bytes:
        """The plain way, for comparison: the library's own call on the whole text."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers, one after the other; a missing text has none."""
        if not text:
            return b""
        if is_plain(text):
            return self._plain_text(text)
        if not self.spaces:
            return b"".join([self._chunks[word.decode()] for word in text.encode().split()])
        if _DOUBTFUL.search(text):
            return self.whole(text)
        if _RUNS.search(text):
            return b"".join(map(self._chunks.__getitem__, _CHUNK.findall(text)))
        out = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self._chunks["\n"])
            first, *rest = line.split(" ")
            if first:
                out.append(self._chunks[first])
            out.extend([self._chunks[" " + word] for word in rest])
        return b"".join(out)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, spaces: bool) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]


END = b"\0\0\0\0"  # id 0, which ends every document
