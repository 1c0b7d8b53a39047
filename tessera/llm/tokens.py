"""Token ids of whole texts through the tokenizers library, each distinct piece encoded once by a worker."""

from __future__ import annotations

import os
import re
from array import array

#: Pieces that a worker remembers in each of two generations, and the longest of them in characters.
CACHE, LONGEST = 400_000, 48
END = 2
_AFTER_TEXT = re.compile(r"(?<!\s) ")
#: A word of ASCII and Latin-1 letters with marks behind it. Both pre-tokenizers cut between the two, and never within the first;
#: the letters are their own composed forms.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:*#$%&]*)")
_encoders: dict[tuple[str, str], Encoder] = {}


def _visible_bytes() -> dict[int, str]:
    """Byte-level BPE writes bytes as characters: printable ones of Latin-1 as themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_VISIBLE = _visible_bytes()


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids, as the tokenizer does with add_special_tokens=False.

    glue " ": byte-level BPE whose pre-tokenizer takes one space with the word after it. No token reaches from a character that isn't
    white space over the space or line feed behind it, so texts are cut there if no white space follows, and pieces encoded with what
    stood before them. Texts with white space in a row are cut before single spaces only.
    glue "": lower-casing BPE that drops white space; texts are cut at spaces and line feeds.
    """

    def __init__(self, path: str, glue: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t, self.glue = Tokenizer.from_file(path), glue
        self.model = self.t.model
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.heads: tuple[dict, dict] = ({}, {})
        self.tails: dict[str, bytes] = {"": b""}
        self.line = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("I", self.t.encode(text, add_special_tokens=False).ids).tobytes() if text else b""

    def _letters(self, head: str, space: bool) -> bytes:
        """Ids of a word of letters with or without a space before it."""
        if not self.glue:
            head = head.lower()
        ids = self.heads[space].get(head)
        if ids is None:
            raw = f" {head}" if space else head
            shown = "".join(map(_VISIBLE.__getitem__, raw.encode()))
            ids = self.heads[space][head] = array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()
            if len(self.heads[space]) > CACHE:
                self.heads[space].clear()
        return ids

    def _piece(self, p: str, space: bool) -> bytes:
        m = _WORD.fullmatch(p)
        if m is None:
            return self._whole(f" {p}" if space else p)
        head, tail = m.groups()
        return self._letters(head, space) + (self.tails[tail] if tail in self.tails else self._tail(tail))

    def _tail(self, tail: str) -> bytes:
        ids = self._whole(tail)
        if len(self.tails) < 10_000:
            self.tails[tail] = ids
        return ids

    def _missing(self, p: str) -> bytes | None:
        """Ids of a piece that isn't among the new ones; None if white space stands at its ends."""
        ids = self.old.get(p)
        if ids is None:
            line = self.glue and p[:1] == "\n"
            body = p[1:] if line else p
            if self.glue and (not body or body[0].isspace() or body[-1].isspace()):
                return None
            ids = self.line + self._piece(body, False) if line else self._piece(body, bool(self.glue))
        if len(p) <= LONGEST:
            self.new[p] = ids
            if len(self.new) > CACHE:
                self.old, self.new = self.new, {}
        return ids

    def _cut(self, t: str) -> bytes:
        """A text with white space in a row."""
        first, *rest = _AFTER_TEXT.split(t)
        return b"".join([self._whole(first), *(self._whole(f" {p}") for p in rest)])

    def encode(self, t: str | None) -> bytes:
        if not t:
            return b""
        if self.glue:
            first, *pieces = t.replace("\n", " \n").split(" ")
            if first and first[-1].isspace():
                return self._cut(t)
            ids = [self._piece(first, False)] if first else []
        else:
            pieces, ids = (t.lower() if t.isascii() else t).replace("\n", " ").split(" "), []
        found = [*map(self.new.get, pieces)]
        if None in found:
            for i, v in enumerate(found):
                if v is None:
                    found[i] = v = self._missing(pieces[i])
                    if v is None:
                        return self._cut(t)
        return b"".join(ids + found)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [*map(self.encode, texts)]


def encoder(path: str, glue: str) -> Encoder:
    """The worker's encoder of this file, loaded once."""
    if (path, glue) not in _encoders:
        _encoders[path, glue] = Encoder(path, glue)
    return _encoders[path, glue]
