"""Texts cut where no token can reach across, and what was found for each distinct piece.

For a byte-level tokenizer with the usual pattern, and for a piece tokenizer whose
pieces hold a blank only at their head, the ids of a text are those of its parts cut
before single blanks (and line ends) between two other characters.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import types
from contextlib import contextmanager
from itertools import chain

#: A blank or line end that is the last character or has white space behind it.
RUN = re.compile(r"[ \n](?!\S)")
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def spaced(text: str) -> list[str]:
    """The keys of a text's pieces, in order; see ``name``."""
    if "\0" in text or RUN.search(text):
        return [name(p) for p in CUT.split(text)]
    parts = text.replace("\n", " \n").split(" ")
    if parts[0]:
        parts[0] = name(parts[0])
    else:
        del parts[0]
    return parts


def name(piece: str) -> str:
    """The key of a piece: led by a blank without the blank, led by a line end as it is, others behind a mark."""
    if piece[:1] == " " and piece[1:2] not in ("", "\n", "\0"):
        return piece[1:]
    if piece[:1] == "\n":
        return piece
    return "\0=" + piece


def literal(key: str) -> str:
    """The piece that a key stands for."""
    if key[:1] == "\n":
        return key
    return key[2:] if key[:2] == "\0=" else " " + key


def long_parts(text: str, most: int):
    """A long text in parts of about `most` characters, cut as pieces are (whole if it has no such place)."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + most) if len(text) - at > most else None
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


MARKS = ".,;:!?#%*&$"  # ASCII and no apostrophe, which begins contractions


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def marked(word: str) -> tuple[str, str]:
    """A word without the marks at its end, and these: after a letter they are tokens of their own."""
    stem = word.rstrip(MARKS)
    return (stem, word[len(stem):]) if stem[-1:].isalpha() else (word, "")


class Letters:
    """Ids of words of letters, from the tokenizer's model alone: it is half of the work of the whole tokenizer.

    Only for letters below U+0250, which every normal form leaves as they are, and only if some
    such words have the ids that the whole tokenizer gives them.
    """

    PROBES = ("word", "The", "Zürich", "ÉCOLE", "straße", "ñandú", "øre", "unbelievable", "x", "ż", "ǆ")

    def __init__(self, tokenizer, head: str = "", lower: bool = False):
        self.model, self.lower = tokenizer.model, lower
        self.letters = {b: c for c, b in byte_alphabet().items()}
        self.head = head.translate(self.letters)
        probes = [w for w in self.PROBES if self.fits(w)]
        whole = tokenizer.encode_batch_fast([head + w for w in probes], add_special_tokens=False)
        self.right = all(self(w) == e.ids for w, e in zip(probes, whole))

    def fits(self, word: str) -> bool:
        if self.lower:
            word = word.lower()
        return word.isalpha() and max(word) < "\u0250"

    def __call__(self, word: str) -> list[int]:
        if self.lower:
            word = word.lower()
        if not word.isascii():  # ASCII letters stand for themselves
            word = word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(self.head + word)]


class Known:
    """Values of keys; those not known yet are learned together.

    Values come in two generations: once the newer holds `most` keys (or their characters are too many) it
    becomes the older one, whose keys move back when they are met again and go with it otherwise.
    """

    def __init__(self, learn, most: int = 250_000, most_chars: int = 8 << 20):
        self.learn, self.most, self.most_chars = learn, most, most_chars
        self.forget()

    def forget(self) -> None:
        self.values, self.older, self.chars = {}, {}, 0

    def meet(self, keys: list[list[str]]):
        """The values of all these keys: a function of a key."""
        if len(self.values) > self.most or self.chars > self.most_chars:
            self.values, self.older, self.chars = {}, self.values, 0
        new = set(chain.from_iterable(keys)).difference(self.values)
        if new:
            self.chars += sum(map(len, new))
            known = new.intersection(self.older)
            self.values.update(zip(known, map(self.older.__getitem__, known)))
            new = list(new.difference(known))
            with no_gc():
                self.values.update(zip(new, self.learn(new)))
        return self.values.__getitem__


@contextmanager
def no_gc():
    """Without the cycle collector, which would go through all new objects again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


KEPT = "endpulse_kept_in_worker"


def in_worker(name: str, make):
    """An object that lives as long as the Python worker, over all its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    kept = vars(sys.modules.setdefault(KEPT, types.ModuleType(KEPT)))
    if name not in kept:
        kept[name] = make()
    return kept[name]


def forget_in_worker() -> None:
    """Free what the worker keeps; other stages use the worker too."""
    vars(sys.modules.get(KEPT, types.ModuleType(""))).clear()
