"""Texts cut where byte-level pre-tokenisers always cut, and a bounded memory of what the pieces gave.

The patterns of the byte-level tokenisers here let a token hold a space only as its first
character or inside a run of white space. So a token always begins at a space whose
predecessor is no white space, and what stands on either side of it is encoded alone. Texts are
cut there into units; repeated units are encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

BOUNDARY = re.compile(r"(?<=\S) ")
AFTER_SPACE = re.compile(r"\s ")
LINE_FEED = re.compile(r"(?<=\S)(\n)(?=\S)")
STOPS = (".", ",")
SEGMENT = 1 << 20  # characters of a text whose units are held at once


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """``text`` in runs of about ``size`` characters that end at unit boundaries."""
    at = 0
    while at < len(text):
        found = BOUNDARY.search(text, at + size) if at + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def units(segment: str) -> list[str]:
    """The first unit as it is; each later one without the space that it begins with."""
    return BOUNDARY.split(segment) if AFTER_SPACE.search(segment) else segment.split(" ")


def parts(unit: str) -> list[str]:
    """A unit cut further, at a lone line feed and before a last full stop or comma after a Latin letter: the patterns
    always cut there too."""
    out = []
    for part in LINE_FEED.split(unit) if "\n" in unit else (unit,):
        if part[-1:] in STOPS and part[-2:-1].isalpha() and part[-2] < "\u0250":
            out += [part[:-1], part[-1]]
        else:
            out.append(part)
    return out


class Memory:
    """What ``encode`` gave for units, as bytes, kept up to ``most`` entries: a matter of speed alone."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 500_000):
        self.encode, self.most = encode, most
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def known(self, text: str) -> bytes | None:
        """What was kept for ``text`` under any name, so that nothing is encoded again where it comes as another kind of unit; else nothing."""
        value = self.later.get(text[1:]) if text[:1] == " " else self.first.get(text)
        return self.parts.get(text) if value is None else value

    def _learn(self, known: dict[str, bytes], names: list[str], texts: list[str]) -> None:
        cut = [parts(t) for t in texts]
        # what is cut shares its parts with others; what is not is kept under its name alone
        new = set()
        for p in {p for ps in cut if len(ps) > 1 for p in ps}.difference(self.parts):
            value = self.known(p)
            if value is None:
                new.add(p)
            else:
                self.parts[p] = value
        whole = [ps[0] for ps in cut if len(ps) == 1 and ps[0] not in self.parts and ps[0] not in new]
        new = list(new)
        got = self.encode(new + whole)
        self.parts.update(zip(new, got))
        alone = dict(zip(whole, got[len(new):]))
        known.update((n, b"".join([self.parts[p] for p in ps]) if len(ps) > 1 else alone[ps[0]] if ps[0] in alone else self.parts[ps[0]])
                     for n, ps in zip(names, cut))

    def values(self, texts: Iterable[str]) -> list[list[bytes]]:
        """For each of some segments, what its units gave, in order."""
        if len(self.first) + len(self.later) + len(self.parts) > self.most:
            for known in (self.first, self.later, self.parts):
                known.clear()
        cut = [units(t) for t in texts]
        heads = list({u[0] for u in cut}.difference(self.first))
        # most units are known: those are looked up once, and only where one is missing again
        out = [list(map(self.later.get, u)) for u in cut]
        rest = list({unit for u, values in zip(cut, out) if None in values
                     for unit, value in zip(u[1:], values[1:]) if value is None})
        self._learn(self.first, heads, heads)
        self._learn(self.later, rest, [" " + u for u in rest])
        for u, values in zip(cut, out):
            values[0] = self.first[u[0]]
            if None in values:
                values[:] = [values[0], *map(self.later.__getitem__, u[1:])]
        return out


def grouped(texts: list[str], most: int = 1 << 18) -> Iterator[list[tuple[int, str]]]:
    """(index of the text, segment) in groups of about ``most`` characters."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for part in segments(text):
            held.append((i, part))
            size += len(part)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held
