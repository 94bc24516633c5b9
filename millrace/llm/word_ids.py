"""Token ids of whole texts from a public tokenizer file, each distinct piece of text encoded once.

The tokenizers library encodes a long text at about 1 MB a second. A text is therefore cut where the
tokenizer's own pattern always cuts, and the library is asked only for pieces that the worker's bounded
cache lacks; the ids are those of the whole text. A text that contains a special token goes to the library
whole.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable

import numpy as np

CACHED = 700_000  # pieces kept by a worker at each of two levels, about 130 MB a level

#: The Latin-1 part of the Unicode letter and number classes of the tokenizers' patterns.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

_CONTROL_SPACE = re.compile("[\x1c-\x1f]")  # white space for Python, not for the tokenizers
_LOOSE_SPACE = re.compile(r" (?=\s|$)")
_INNER_SPACE = re.compile(r".\s", re.DOTALL)
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s")
_DROPPING = re.compile(rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
_KEEPING = re.compile(
    rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)


def spaced_chunks(text: str) -> list[str]:
    """Parts of ``text`` between which a pattern that joins one leading space to a word always cuts."""
    if _CONTROL_SPACE.search(text):
        return [text]
    if _LOOSE_SPACE.search(text):
        return _SPACED.findall(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not _CONTROL_SPACE.search(text)


class TextEncoder:
    """Ids as little-endian unsigned bytes of ``dtype``. ``drops_space`` says whether the tokenizer lower-cases
    and ignores white space, with a mark on each word's last token, or keeps spaces as parts of words. ``special``:
    special tokens in a text get their own ids, as by the file as loaded; else they are text like any other."""

    def __init__(self, path: str, cached: int = CACHED, special: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # but for whole texts with such tokens, see encode
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.special]
        # more texts than needed do no harm: some tokens are looked for in lower case
        self.special = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if special and added else None
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 2**16 else "<u4")
        self.drops_space = not self.library.encode(" ", add_special_tokens=False).ids
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        if self.drops_space:
            self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True
        else:
            (newline,) = self.library.encode("\n", add_special_tokens=False).ids
            self.ends[newline] = True
        self.cached = cached
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}  # with a space before them
        self.parts: dict[str, bytes] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _joined(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, many to a call: the tokens that end a part show where to cut."""
        out: list[bytes] = []
        width, glue, keep = self.dtype.itemsize, " " if self.drops_space else "\n", bool(self.drops_space)
        groups = [parts[i : i + 200] for i in range(0, len(parts), 200)]
        joined = self.library.encode_batch_fast([glue.join(g) + glue for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined):
            ids = np.array(found.ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids])
            if len(stops) != len(group):
                out.extend(self._direct(group))
                continue
            held = ids.tobytes()
            cuts = (np.concatenate(([-1], stops)) + 1).tolist()
            out.extend(held[a * width : (b - (not keep)) * width] for a, b in zip(cuts, cuts[1:]))
        return out

    def _learn(self, unknown: list[str]) -> list[bytes]:
        """Ids of new chunks, by way of their parts."""
        find = _DROPPING.findall if self.drops_space else _KEEPING.findall
        plain = [latin(chunk) for chunk in unknown]
        split = [find(c.lower() if self.drops_space else c) if p else () for c, p in zip(unknown, plain)]
        fresh = set().union(*split).difference(self.parts)
        alone = [p for p in fresh if p.isspace() or (not self.drops_space and _INNER_SPACE.search(p))]
        joined = list(fresh.difference(alone))
        self.parts.update(zip(joined, self._joined(joined)))
        self.parts.update(zip(alone, self._direct(alone)))
        get = self.parts.__getitem__
        out = [b"".join(map(get, parts)) for parts in split]
        odd = [i for i, p in enumerate(plain) if not p]
        for start in range(0, len(odd), 1000):
            some = odd[start : start + 1000]
            for i, ids in zip(some, self._direct([unknown[k] for k in some])):
                out[i] = ids
        return out

    def _known(self, cache: dict[str, bytes], wanted: set[str], space: str) -> dict[str, bytes]:
        """``cache`` with the ids of ``wanted``, each with ``space`` before it."""
        if len(cache) > self.cached:
            cache.clear()
        unknown = list(wanted.difference(cache))
        if unknown:
            if len(self.parts) > self.cached:
                self.parts.clear()
            cache.update(zip(unknown, self._learn([space + c for c in unknown])))
        return cache

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text."""
        texts = list(texts)
        whole = [i for i, t in enumerate(texts) if self.special and self.special.search(t)]
        if not whole:
            return self._encode(texts)
        self.library.encode_special_tokens = False
        try:
            direct = dict(zip(whole, self._direct([texts[i] for i in whole])))
        finally:
            self.library.encode_special_tokens = True
        cut = iter(self._encode([t for i, t in enumerate(texts) if i not in direct]))
        return [np.frombuffer(direct[i], self.dtype) if i in direct else next(cut) for i in range(len(texts))]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        # Words are looked up without the space before them where each of them has exactly that.
        keeps = not self.drops_space
        each: list[list[str]] = []
        odd: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if not _CONTROL_SPACE.search(text) and not (keeps and _LOOSE_SPACE.search(text)):
                each.append(text.split() if self.drops_space else text.split(" "))
            else:
                odd[i] = [text] if _CONTROL_SPACE.search(text) else spaced_chunks(text)
                each.append([])
        if self.drops_space:
            words = self._known(self.chunks, set().union(*each, *odd.values()), "")
            for i, chunks in odd.items():
                each[i] = chunks
            get = words.__getitem__
            return [np.frombuffer(b"".join(map(get, chunks)), self.dtype) for chunks in each]
        firsts = {chunks[0] for chunks in each if chunks}
        bare = self._known(self.chunks, firsts.union(*odd.values()), "")
        words = self._known(self.words, set().union(*(chunks[1:] for chunks in each)), " ")
        get = words.__getitem__
        out = []
        for i, chunks in enumerate(each):
            found = map(bare.__getitem__, odd[i]) if i in odd else (bare[chunks[0]], *map(get, chunks[1:]))
            out.append(np.frombuffer(b"".join(found), self.dtype))
        return out


@functools.cache
def encoder(path: str) -> TextEncoder:
    """One encoder for all tasks of a worker; its ids are those of the file as loaded."""
    return TextEncoder(path, special=True)
