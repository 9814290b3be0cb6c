"""Token counts: pairs are merged on a linked list in the order of a heap; no ids are made.

The symbols of a piece start as its bytes. A heap holds the adjacent pairs that
have a merge, by rank and then from the left; popping the lowest and linking
its neighbours anew is one merge. The count is the number of symbols at the
start less the number of merges, summed over the pieces, and one for each added
token found in the text. Nothing but counts leaves the worker.

Defined cases: a null or empty text has no tokens; repeated ids and rows each
give a row; a null id stays null; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from matchlens.llm.bpe import Vocabulary, default_path, parts_of, vocabulary
from matchlens.llm.rowwise import map_texts

#: Entries that each of a worker's memories may hold before it starts anew, and characters of a part or piece
#: that is remembered: a text without spaces is one part.
REMEMBERED, SHORT = 700_000, 64


def merged_length(raw: bytes, known: Vocabulary) -> int:
    """Symbols that are left of a piece when no pair has a merge."""
    merges = known.merges
    symbols = [known.byte_ids[b] for b in raw]
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m[0], i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
    heapify(heap)
    done = 0
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two was merged since
        symbols[i], symbols[j] = merges[left, right][1], -1
        done += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if m := merges.get((symbols[i], symbols[k])):
                heappush(heap, (m[0], i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (m := merges.get((symbols[h], symbols[i]))):
            heappush(heap, (m[0], h, symbols[h], symbols[i]))
    return n - done


class Counter:
    """Counts tokens of texts; remembers the counts of recent parts."""

    def __init__(self, path: str) -> None:
        self.known = vocabulary(path)
        self.memory: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def _piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            n = merged_length(piece.encode(), self.known)
            if len(piece) <= SHORT:
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                self.pieces[piece] = n
        return n

    def _part(self, part: str) -> int:
        n = sum(map(self._piece, self.known.pieces(part)))
        if len(part) <= SHORT:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[part] = n
        return n

    def count(self, text: str | None) -> int:
        total, memory = 0, self.memory
        for special, stretch in self.known.split(text or ""):
            if special:
                total += 1
                continue
            counts = list(map(memory.get, parts := parts_of(stretch)))
            if None in counts:
                counts = [self._part(p) if n is None else n for p, n in zip(parts, counts)]
            total += sum(counts)
        return total


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One counter per file and worker, so that tasks share what it remembers."""
    return Counter(path)


FIELDS = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])


def _maker(path: str, limit: int) -> Callable:
    own = counter(path)

    def row(text: str | None) -> tuple[int, int, bool]:
        n = own.count(text)
        return len((text or "").encode()), n, n > limit

    return row


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = 512) -> DataFrame:
    """``key``, bytes, tokens, and whether there are more than ``limit``, for every row."""
    return map_texts(df, key, text, FIELDS, partial(_maker, path or default_path(), limit))
