"""Minimal acyclic transducer from words to id sequences, in one flat file.

Words that end alike share states. Every arc carries the number of words that
lie before it, so the sum along a path is the word's rank, and one array of ids
with offsets by rank holds the outputs. All numbers are little-endian.
"""

from __future__ import annotations

import mmap
from array import array
from collections.abc import Iterable

MAGIC = 0x4C584531
HEAD = 6


def compile_words(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file for (word, ids) in ascending order of words, each once.

    States are made minimal while words arrive: what leaves the common prefix with
    the word before is frozen, and equal frozen states are one.
    """
    frozen: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    below: list[int] = []  # words that a frozen state accepts
    path: list[list] = [[False, []]]  # [final, arcs] of the word before
    labels: list[int] = []
    offsets, outputs, previous = array("I", [0]), array("I"), None

    def freeze(down_to: int) -> None:
        while len(labels) > down_to:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in frozen:
                frozen[key] = len(states)
                states.append(key)
                below.append(final + sum(below[target] for _, target in arcs))
            path[-1][1].append((labels.pop(), frozen[key]))

    for word, ids in entries:
        if previous is not None and word <= previous:
            raise ValueError("words must ascend")
        common = 0
        while common < min(len(word), len(labels)) and labels[common] == word[common]:
            common += 1
        freeze(common)
        for letter in word[common:]:
            labels.append(letter)
            path.append([False, []])
        path[-1][0] = True
        outputs.extend(ids)
        offsets.append(len(outputs))
        previous = word
    freeze(0)
    states.append((path[0][0], tuple(path[0][1])))
    starts, arc_labels, targets, skips, finals = array("I", [0]), bytearray(), array("I"), array("I"), bytearray()
    for final, arcs in states:
        passed = int(final)
        for letter, target in arcs:
            arc_labels.append(letter)
            targets.append(target)
            skips.append(passed)
            passed += below[target]
        starts.append(len(targets))
        finals.append(final)
    head = array("I", [MAGIC, len(states), len(targets), len(offsets) - 1, len(outputs), 0])
    numbers = b"".join(x.tobytes() for x in (head, starts, targets, skips, offsets, outputs))
    return numbers + bytes(finals) + bytes(arc_labels)


class Lexicon:
    """A compiled file, read in place."""

    def __init__(self, data: mmap.mmap | bytes) -> None:
        view = memoryview(data)
        magic, n_states, n_arcs, self.n_words, n_ids, _ = view[: 4 * HEAD].cast("I")
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        self.root = n_states - 1
        at, parts = 4 * HEAD, []
        for n in (n_states + 1, n_arcs, n_arcs, self.n_words + 1, n_ids):
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self.starts, self.targets, self.skips, self.offsets, self.ids = parts
        self.finals, self.data, self.labels_at = view[at : at + n_states], data, at + n_states

    @classmethod
    def from_file(cls, path: str) -> Lexicon:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def rank(self, word: bytes) -> int:
        """Place of a word in ascending order, or -1."""
        state, passed, base, find, starts = self.root, 0, self.labels_at, self.data.find, self.starts
        for i in range(len(word)):
            arc = find(word[i : i + 1], base + starts[state], base + starts[state + 1]) - base
            if arc < 0:
                return -1
            passed += self.skips[arc]
            state = self.targets[arc]
        return passed if self.finals[state] else -1

    def get(self, word: bytes) -> memoryview | None:
        at = self.rank(word)
        return None if at < 0 else self.ids[self.offsets[at] : self.offsets[at + 1]]
