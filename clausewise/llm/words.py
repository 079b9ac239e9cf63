"""Pre-tokenisation and word-wise encoding for a BPE vocabulary with word ends.

The tokenizer file drops white space and never merges across it, so a text is
split at white space first and every distinct piece between is encoded once per
worker. Only pieces not seen before reach the regular expression and the merges.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterable
from heapq import heapify, heappop, heappush

import regex

#: What the tokenizer's own white space class has; str.split also splits at the four below.
SPACE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_SPACE = "\x1c\x1d\x1e\x1f"
WORD_END = "</w>"
#: The split pattern of the tokenizer file.
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
SPACES = re.compile(f"[{SPACE}]+")
#: Pieces and words that one worker keeps, twice; when full, what was not used of late goes.
KEPT = 400_000
#: Signs that end most pieces which are not letters alone.
ENDINGS = frozenset(".,;:!?)")
#: Bits of an id in the merge table.
ID_BITS = 24
NO_MERGE = 1 << 62


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


LETTERS = byte_letters()


def lower(piece: str) -> str:
    """NFC, then lower case letter by letter (no final sigma)."""
    if piece.isascii():
        return piece.lower()
    return unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()


def words_of(piece: str) -> list[str]:
    """Matches of WORD in a piece; letters alone, or with one sign after them, need no search."""
    low = lower(piece)
    if low.isalpha():
        return [low]
    if low[-1] in ENDINGS and low[:-1].isalpha():
        return [low[:-1], low[-1]]
    return WORD.findall(low)


class Vocabulary:
    """Ids, strings and merges of a tokenizer file (its JSON text)."""

    def __init__(self, text: str) -> None:
        data = json.loads(text)
        vocab = data["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, at in [*vocab.items(), *self.special.items()]:
            self.tokens[at] = token
        self.inner = [vocab[x] for x in LETTERS]
        self.last = [vocab[x + WORD_END] for x in LETTERS]
        #: Pair of ids in one number to rank and new id in one number.
        self.merges = {
            vocab[a] << ID_BITS | vocab[b]: rank << ID_BITS | vocab[a + b]
            for rank, (a, b) in enumerate(data["model"]["merges"])
        }
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merge(self, word: str) -> list[int]:
        """Ids of one word by its merges: lowest rank first, leftmost first."""
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        return self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, new_id = self.merges.get, (1 << ID_BITS) - 1
        found = [get(a << ID_BITS | b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != NO_MERGE:
            at = found.index(best)  # the leftmost
            ids[at] = best & new_id
            del ids[at + 1], found[at]
            if at < len(found):
                found[at] = get(ids[at] << ID_BITS | ids[at + 1], NO_MERGE)
            if at:
                found[at - 1] = get(ids[at - 1] << ID_BITS | ids[at], NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        merges, n, new_id = self.merges, len(ids), (1 << ID_BITS) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [a << ID_BITS | b for a, b in zip(ids, ids[1:])]
        heap = [(merges[pair], at, pair) for at, pair in enumerate(pairs) if pair in merges]
        heapify(heap)
        while heap:
            found, at, pair = heappop(heap)
            right = after[at]
            if right >= n or ids[at] < 0 or ids[at] << ID_BITS | ids[right] != pair:
                continue
            ids[at], ids[right] = found & new_id, -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    near = ids[left] << ID_BITS | ids[after[left]]
                    if near in merges:
                        heappush(heap, (merges[near], left, near))
        return [x for x in ids if x >= 0]


class _Memory(dict):
    """Values by key, made on first use; two generations, of which the older is dropped."""

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= KEPT:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, word_ids: Callable[[str], Iterable[int]]) -> None:
        self.vocabulary = vocabulary
        self.by_word = _Memory(lambda word: array("I", word_ids(word)).tobytes())
        self.by_piece = _Memory(self._piece_ids)

    def _piece_ids(self, piece: str) -> bytes:
        words = words_of(piece)
        return self.by_word[words[0]] if len(words) == 1 else b"".join(map(self.by_word.__getitem__, words))

    def pieces(self, text: str) -> list[str]:
        if any(x in text for x in NOT_SPACE):
            return [x for x in SPACES.split(text) if x]
        return text.split()

    def encode(self, text: str) -> bytes:
        special = self.vocabulary.special
        if any(x in text for x in special):
            return b"".join(
                array("I", [special[part]]).tobytes() if part in special else self._plain(part)
                for part in self.vocabulary.split.split(text)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.by_piece.__getitem__, self.pieces(text)))

    def count_pieces(self, texts: Iterable[str], counts: Counter) -> None:
        """Add the pieces of texts, without special tokens, to counts."""
        for text in texts:
            if any(x in text for x in self.vocabulary.special):
                for part in self.vocabulary.split.split(text):
                    if part not in self.vocabulary.special:
                        counts.update(self.pieces(part))
            else:
                counts.update(self.pieces(text))

    @staticmethod
    def count_words(pieces: Counter) -> Counter:
        counts: Counter = Counter()
        for piece, n in pieces.items():
            for word in words_of(piece):
                counts[word] += n
        return counts

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.vocabulary.tokens.__getitem__, memoryview(ids).cast("I")))
