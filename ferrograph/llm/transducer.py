"""Minimal acyclic transducer: words to lists of ids, with shared prefixes and suffixes, in one flat file.

The states of an acyclic automaton over UTF-8 bytes are merged as soon as no later word can change them, so equal
suffixes are stored once. Each arc carries how many words come before it; their sum along a path is the word's number,
and the number leads to its ids. The file is memory-mapped, and so is shared by the processes of a machine.
"""

from __future__ import annotations

import mmap
from array import array
from collections.abc import Iterable
from pathlib import Path

MAGIC = 0x54524431


def build(words: Iterable[tuple[bytes, list[int]]], to: Path) -> int:
    """Writes the transducer of (word, ids), sorted by word and without repeats; returns the number of states."""
    arcs: list[dict[int, int]] = [{}]  # states on the path of the last word have open places here
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte) of the last word
    last = b""
    offsets, ids = array("I", [0]), array("I")
    free: list[int] = []

    def close(down: int) -> None:
        while len(path) > down:
            state, byte = path.pop()
            child = arcs[state][byte]
            key = (final[child], tuple(arcs[child].items()))
            if (same := known.setdefault(key, child)) != child:
                arcs[state][byte] = same
                arcs[child] = {}
                free.append(child)

    for word, out in words:
        if word <= last and len(offsets) > 1:
            raise ValueError("words must be sorted and different")
        common = 0
        while common < len(path) and common < len(word) and last[common] == word[common]:
            common += 1
        close(common)
        state = 0 if not path else arcs[path[-1][0]][path[-1][1]]
        for byte in word[common:]:
            if free:
                new = free.pop()
                final[new] = False
            else:
                new = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[state][byte] = new
            path.append((state, byte))
            state = new
        final[state] = True
        last = word
        ids.extend(out)
        offsets.append(len(ids))
    close(0)
    # states in an order where children come first, to count the words below each
    order, seen, stack = [], set(), [(0, iter(arcs[0].values()))]
    seen.add(0)
    while stack:
        state, rest = stack[-1]
        for child in rest:
            if child not in seen:
                seen.add(child)
                stack.append((child, iter(arcs[child].values())))
                break
        else:
            order.append(state)
            stack.pop()
    count: dict[int, int] = {}
    for state in order:
        count[state] = final[state] + sum(count[x] for x in arcs[state].values())
    place = {state: i for i, state in enumerate(reversed(order))}
    first, label, target, before, ends = array("I"), array("I"), array("I"), array("I"), array("I")
    for state in reversed(order):
        first.append(len(label))
        ends.append(final[state])
        n = int(final[state])
        for byte in sorted(arcs[state]):
            child = arcs[state][byte]
            label.append(byte)
            target.append(place[child])
            before.append(n)
            n += count[child]
    first.append(len(label))
    head = array("I", [MAGIC, len(place), len(label), len(offsets) - 1, len(ids)])
    with Path(to).open("wb") as f:
        for part in (head, first, ends, label, target, before, offsets, ids):
            part.tofile(f)
    return len(place)


class Transducer:
    """A file of ``build``, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        all_ = memoryview(self._map).cast("I")
        magic, states, arcs, words, ids = all_[:5]
        if magic != MAGIC:
            raise ValueError(f"{path} is no transducer")
        at = 5
        parts = []
        for n in (states + 1, states, arcs, arcs, arcs, words + 1, ids):
            parts.append(all_[at : at + n])
            at += n
        self.first, self.ends, self.label, self.target, self.before, self.offsets, self.ids = parts
        self.words = words

    def get(self, word: bytes) -> list[int] | None:
        """The ids of a word, or None if it isn't in the lexicon."""
        first, label, target, before = self.first, self.label, self.target, self.before
        state = number = 0
        for byte in word:
            lo, hi = first[state], first[state + 1]
            while lo < hi:
                mid = (lo + hi) >> 1
                if label[mid] < byte:
                    lo = mid + 1
                else:
                    hi = mid
            if lo == first[state + 1] or label[lo] != byte:
                return None
            number += before[lo]
            state = target[lo]
        if not self.ends[state]:
            return None
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()
