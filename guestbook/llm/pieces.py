"""Cutting texts into chunks that a tokenizer encodes one by one, and a bounded memory of the encodings.

A chunk is a run of white space and the word after it. No pre-token reaches from a word over white space into
the next, so the encoding of a text is that of its chunks in a row. Most texts part their words by single
spaces and line breaks; these are split without a regular expression, and the space before a word is implied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import regex

CHUNK = regex.compile(r"\s*\S+|\s+")
BEFORE_SPACE = regex.compile(r"(?<=\S)\s")
GROUP_CHARS = 1 << 18


def groups(texts: Iterable[str], most: int | None = None) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer text is alone."""
    most = most or GROUP_CHARS
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def segments(text: str, most: int | None = None) -> Iterator[str]:
    """A very long text in parts, cut where white space begins."""
    most, at = most or GROUP_CHARS, 0
    while len(text) - at > most:
        cut = BEFORE_SPACE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def chunks(text: str) -> tuple[list[str], list[str]]:
    """Chunks as they stand, then words that imply a space before them, in the order of the text.

    A word after a line break keeps the break: only the first word stands without white space.
    """
    if text and " ".join(text.split()) == text.replace("\n", " "):
        words = text.replace("\n", " \n").split(" ")
        return words[:1], words[1:]
    return CHUNK.findall(text), []


class Memory:
    """Key -> value for the keys seen last: two generations of about ``most`` keys each.

    When the young generation is full it becomes the old one; what is used again moves back. Keys longer than
    ``longest`` are not kept.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int, longest: int = 64):
        self.make, self.most, self.longest = make, most, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def look_up(self, lists: list[list[str]]) -> list[list]:
        """The values of each list's keys, after all that are missing have been made together."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        found = [list(map(self.young.get, keys)) for keys in lists]
        open_at = [(keys, values, i) for keys, values in zip(lists, found) for i in gaps(values)]
        missing = {keys[i] for keys, _, i in open_at}
        known = {key: self.old[key] for key in self.old.keys() & missing}
        new = list(missing - known.keys())
        known.update(zip(new, self.make(new)))
        for keys, values, i in open_at:
            values[i] = known[keys[i]]
        self.young.update((key, value) for key, value in known.items() if len(key) <= self.longest)
        return found


def gaps(values: list) -> Iterator[int]:
    """Places of None."""
    at = -1
    try:
        while True:
            at = values.index(None, at + 1)
            yield at
    except ValueError:
        return


class ChunkMemory:
    """Encodings of texts by way of their chunks. ``make`` encodes a list of texts, ``below`` is its own memory."""

    def __init__(self, make: Callable[[list[str]], list], most: int, below: Memory | None = None):
        self.below = below
        self.plain = Memory(make, most)
        self.spaced = Memory(lambda words: make([word if word[:1] == "\n" else " " + word for word in words]), most)

    def clear(self) -> None:
        for memory in (self.plain, self.spaced, self.below):
            if memory is not None:
                memory.clear()

    def look_up(self, texts: Iterable[str]) -> Iterator[list]:
        """For every text the encodings of its chunks in a row."""
        for some in groups(texts):
            if len(some) == 1 and len(some[0]) > GROUP_CHARS:
                out: list = []
                for part in segments(some[0]):
                    out += self._of([part])[0]
                yield out
            else:
                yield from self._of(some)

    def _of(self, texts: list[str]) -> list[list]:
        cut = [chunks(text) for text in texts]
        first, rest = self.plain.look_up([c[0] for c in cut]), self.spaced.look_up([c[1] for c in cut])
        return [a + b for a, b in zip(first, rest)]
