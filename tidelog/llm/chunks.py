"""Splits text at places where no token of the split pattern can cross, so that encodings can be remembered."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import regex

# A space before anything but white space starts a token of the pattern, and nothing that follows
# it decides how the text before it is split. So texts may be cut there.
CUT = regex.compile(r" (?=\P{White_Space})")
# Closing marks after a letter form a token of their own, unless other marks or a letter follow.
MARKS = frozenset(",.;:!?")
# Characters of texts whose chunks are looked for at once, and remembered chunks; bounds on memory only.
TOGETHER = 1 << 20
REMEMBERED = 1_600_000


def groups(items: Iterable, most: int) -> Iterator[list]:
    """``items`` in lists of a length of ``most`` in all; a longer item is a list of its own."""
    group, total = [], 0
    for item in items:
        if group and total + len(item) > most:
            yield group
            group, total = [], 0
        group.append(item)
        total += len(item)
    if group:
        yield group


class Recent:
    """Remembers in two generations: when the newer one is full it becomes the older one, whose entries move up when asked for again."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def make_room(self, n: int) -> bool:
        """Whether a new generation begins, so that ``n`` more entries fit."""
        if full := len(self.new) + n > self.limit // 2:
            self.new, self.old = {}, self.new
        return full

    def get(self, key: str) -> bytes | None:
        if (found := self.new.get(key)) is None and (found := self.old.get(key)) is not None:
            self.new[key] = found
        return found


class ChunkMemory:
    """Encodes texts by chunks; ``encode(list of chunk strings) -> list of id bytes`` is asked for unknown ones only."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = REMEMBERED):
        self.encode, self.known = encode, Recent(limit)
        self.marks = dict(zip(MARKS, encode(list(MARKS))))

    def _learn(self, parts: Iterable[str]) -> None:
        """Remember every chunk of ``parts``; a chunk stands for itself with a space before it."""
        get, known, marks = self.known.get, self.known.new, self.marks
        new = {p for p in parts if get(p) is None}
        ended = {p for p in new if len(p) > 1 and p[-1] in marks and p[-2].isalpha()}
        ask = list({p[:-1] for p in ended if get(p[:-1]) is None} | (new - ended))
        known.update(zip(ask, self.encode([" " + p for p in ask])))
        for p in ended:
            known[p] = known[p[:-1]] + marks[p[-1]]

    def _group(self, texts: list[str]) -> list[bytes]:
        known, cut, unknown = self.known.new, [], set()
        for text in texts:
            head, *parts = text.split(" ")
            new = [p for p in parts if p not in known]
            if any(not p or p[0].isspace() for p in new):  # white space after a space: cut with care
                head, *parts = CUT.split(text)
                new = parts
            cut.append((head, parts))
            unknown.update(new)
        if self.known.make_room(len(unknown)):
            unknown.update(p for _, parts in cut for p in parts)
        self._learn(unknown)
        heads = list({head for head, _ in cut if head})
        first = {"": b"", **dict(zip(heads, self.encode(heads)))}
        known = self.known.new
        return [first[head] + b"".join(map(known.__getitem__, parts)) for head, parts in cut]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit; unknown chunks of neighbouring texts are encoded together."""
        return [ids for group in groups(texts, TOGETHER) for ids in self._group(group)]

    def ids(self, text: str) -> bytes:
        """The ids of ``text``, little-endian unsigned 32-bit."""
        return self._group([text])[0]
