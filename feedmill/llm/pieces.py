"""Cutting texts where no token can reach across, and caching what the parts encode to.

Byte-level BPE vocabularies split text before merging: every blank that is followed
by something other than white space starts a new word. So a text may be cut before
each such blank and every part encoded alone. Natural text repeats its parts, so a
bounded cache answers for most of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

# A part that begins with one of these, or an empty part, shows that a blank stood before
# white space (in anyone's definition) or at the end.
_ODD_FIRST = frozenset(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010),
                     *range(0x2028, 0x2030), *range(0x205F, 0x2065), 0x3000, 0xFEFF))
_SAFE_CUT = re.compile(r"(?= [^\W_])")

# Blanks behind anything but a letter, a digit or another visible ASCII character, or at an
# end of a text, are no cuts of ``cut_parts``; few texts have them.
_PART = re.compile(r"(?<=[\w!-~]) (?=[\s\S])")
VISIBLE = re.compile(r"[\w!-~]")

# Parts longer than this are encoded each time, so that the cache stays small in bytes.
LONGEST_CACHED = 48


def cut_odd(text: str) -> list[str]:
    """Parts of a text that has blanks before white space: it is cut only before blanks
    that a letter or digit follows. The first part stands as it is, the later ones lose
    their leading blank."""
    head, *rest = _SAFE_CUT.split(text)
    return [head, *(part[1:] for part in rest)]


def cut_parts(text: str) -> list[str]:
    """Parts of a text, cut before each blank that follows a visible character: no token of
    the vocabularies here reaches across. All but the first stand for a blank and themselves."""
    parts = text.split(" ")
    if parts[-1] and all(map(VISIBLE.match, {part[-1:] for part in parts[:-1]})):
        return parts
    return _PART.split(text)


def is_closed(part: str) -> bool:
    """Whether the blank of another part may follow without a token that reaches into it."""
    return bool(part) and ("!" <= part[-1] <= "~" or part[-1].isalpha())


class PieceEncoder:
    """Encodes texts part by part through ``encode_parts``, which takes a list of parts
    and returns the ids of each as packed bytes.

    ``encode_parts`` may ask ``known`` and use ``remember`` for parts of its own.
    The cache has two generations of at most ``generation`` parts each; when the young
    one is full, the old one is dropped.
    """

    def __init__(self, encode_parts: Callable[[list[str]], list[bytes]], specials: dict[str, bytes],
                 generation: int = 350_000):
        self._encode_parts = encode_parts
        self._specials = specials
        self._special_cut = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self._generation = generation
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop all cached parts, as at the end of a task."""
        self._young, self._old = {}, {}

    def known(self, part: str) -> bytes | None:
        """The ids of a blank and ``part``, if they are cached."""
        ids = self._young.get(part)
        if ids is None and (ids := self._old.get(part)) is not None:
            self._young[part] = ids
        return ids

    def remember(self, part: str, ids: bytes) -> None:
        """Cache the ids of a blank and ``part``."""
        if len(part) <= LONGEST_CACHED:
            self._young[part] = ids

    def _parts(self, segment: str, rows: list[list[bytes | None]], heads: list, gaps: list) -> None:
        """Look up the parts of a segment; what is not cached is noted in ``gaps``."""
        young, old = self._young, self._old
        rest = segment.split(" ")
        row: list[bytes | None] = list(map(young.get, rest))
        row[0] = None
        holes = [k for k, ids in enumerate(row) if ids is None]
        if any(not rest[k] or rest[k][0] in _ODD_FIRST for k in holes[1:]):
            rest = cut_odd(segment)
            row = [None] * len(rest)
            holes = range(len(rest))
        for k in holes:
            part = rest[k]
            if k == 0:
                heads.append((len(rows), part))
            elif (ids := old.get(part)) is not None:
                row[k] = young[part] = ids
            else:
                gaps.append((len(rows), k, part))
        rows.append(row)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The packed ids of every text."""
        rows: list[list[bytes | None]] = []
        owner: list[int] = []
        heads: list[tuple[int, str]] = []
        gaps: list[tuple[int, int, str]] = []
        count = 0
        for number, text in enumerate(texts):
            count += 1
            if self._special_cut is not None and any(special in text for special in self._specials):
                for segment in self._special_cut.split(text):
                    if segment in self._specials:
                        rows.append([self._specials[segment]])
                    elif segment:
                        self._parts(segment, rows, heads, gaps)
            elif text:
                self._parts(text, rows, heads, gaps)
            owner += [number] * (len(rows) - len(owner))
        first = list({head for _, head in heads})
        found = dict(zip(first, self._encode_parts(first), strict=True))
        for r, head in heads:
            rows[r][0] = found[head]
        keys = list({part: None for _, _, part in gaps})
        new = dict(zip(keys, self._encode_parts([" " + key for key in keys]), strict=True))
        for r, k, part in gaps:
            rows[r][k] = new[part]
        self._young.update((key, ids) for key, ids in new.items() if len(key) <= LONGEST_CACHED)
        out = [b""] * count
        for number, row in zip(owner, rows, strict=True):
            packed = b"".join(row)
            out[number] = out[number] + packed if out[number] else packed
        if len(self._young) > self._generation:
            self._old, self._young = self._young, {}
        return out


def in_slices(texts: list[str], characters: int = 2_000_000) -> Iterable[list[str]]:
    """Consecutive runs of texts of about ``characters`` each, so that the parts of one
    Arrow batch are never all in memory; a longer text is a run of its own."""
    run: list[str] = []
    held = 0
    for text in texts:
        if run and held + len(text) > characters:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def id_type(vocabulary: int) -> np.dtype:
    """The smallest little-endian type that holds every id."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")
