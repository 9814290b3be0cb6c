"""Byte-level byte-pair encoding: encoding and decoding by a prefix-sharing trie.

A text is cut into pieces that are encoded on their own. The distinct pieces
of a batch form a trie, walked depth first: for each prefix that is asked for
the walk keeps the last token of that prefix's encoding. The last token of a
longer prefix is the one token that ends it and may follow the last token of
what precedes it, so only prefixes at which a token may begin are asked for, and
one that many pieces share is encoded once. Following the last tokens back from
the end gives a piece's encoding.

The files are those of the public ``tokenizers`` library: merges in order, a
byte alphabet, and added tokens that are found in the text before everything
else. Results equal those of ``encode(text, add_special_tokens=False)`` and
``decode(ids, skip_special_tokens=False)``.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; repeated ids and rows each give a row; a null id stays null; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from matchlens.llm.rowwise import STEP, bound_batches

assert sys.byteorder == "little" and array("I").itemsize == 4

#: Fixed value: how the byte-level files cut text into pieces.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: The same cuts of text that is ASCII only.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: A space before other text always starts a piece, so these parts can be cut on their own.
PARTS = re.compile(r" (?=\S)")
#: Without these, every space of a text starts a part.
UNEVEN = re.compile(r"\A\s|\A\Z| \s| \Z")
#: Up to here the library and this module's pattern agree on what is a letter or a number.
AGREED = re.compile("[^\x00-՗ՙ-֊֍-ࢎ࢐-౛ౝ-೛ೝ-₎ₐ-ₜ₠-ꟍ]")
#: Entries, and characters and bytes of ids in them, that each of a worker's memories may hold before it starts anew.
REMEMBERED, REMEMBERED_SIZE = 250_000, 16_000_000
#: Pairs of tokens that a worker knows to fit, or not to.
PAIRS = 300_000
#: Prefixes of longer pieces are all encoded, from the shortest on; those of others when they are asked for.
DEEP = 256
#: Bytes at the end of a text that tell which tokens up to that length end it, and which lengths longer ones can have.
TAIL = 4
#: Ends whose tokens are kept at hand.
ENDS = 50_000
#: Tokens whose ends are kept at hand.
SPINES = 4096
#: Parts and pieces of more characters are not remembered: a text without spaces is one part.
SHORT = 64
#: Texts that are encoded together, and bytes of them: more of them share more prefixes, and take more memory.
TOGETHER, TOGETHER_SIZE = 1024, 1 << 20


def default_path() -> str:
    """The public file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Vocabulary:
    """Merges, byte alphabet and added tokens of one file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], _alphabet()
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.path = path
        self.byte_ids = [ids[letters[b]] for b in range(256)]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.parts = {ids[a + b]: (rank, ids[a], ids[b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        added = {t["content"]: t["id"] for t in content.get("added_tokens") or []}
        self.added = added
        self.finder = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        back = {letter: bytes([b]) for b, letter in enumerate(letters)}
        self.spelled = {i: b"".join(back[c] for c in token) for token, i in ids.items() if token not in added}
        self.spelled |= {i: token.encode() for token, i in added.items()}
        self._exact = None

    def exact(self):
        """The library's own cutter, for texts with characters that newer tables class differently."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.path).pre_tokenizer
        return self._exact

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without added tokens."""
        if text.isascii():
            # A word of letters after at most one space is one piece.
            return [text] if (text[1:] if text[0] == " " else text).isalpha() else ASCII_PIECES.findall(text)
        if AGREED.search(text):
            return [text[a:b] for _, (a, b) in self.exact().pre_tokenize_str(text)]
        return PIECES.findall(text)

    def split(self, text: str) -> Iterator[tuple[bool, str]]:
        """Stretches of a text: whether an added token, and the stretch."""
        at = 0
        for found in self.finder.finditer(text) if self.finder else ():
            if found.start() > at:
                yield False, text[at : found.start()]
            yield True, found[0]
            at = found.end()
        if at < len(text):
            yield False, text[at:]


def _alphabet() -> list[str]:
    """The printable letter of each byte in byte-level files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per file and worker."""
    return Vocabulary(path)


def parts_of(text: str) -> list[str]:
    """Parts of a stretch that are cut into pieces on their own."""
    if UNEVEN.search(text):
        starts = [0, *(m.start() for m in PARTS.finditer(text))]
        return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)]) if b > a]
    first, *rest = text.split(" ")
    return [first, *[" " + p for p in rest]]


class Trie:
    """Last-token states along the path of a depth-first walk over sorted pieces."""

    def __init__(self, known: Vocabulary) -> None:
        self.known = known
        self.fits: dict[int, bool] = {}  # by a << 32 | b
        self.spines: tuple[dict[int, list], dict[int, list]] = {}, {}  # by side, as far as asked for
        whole: set[int] = set(known.byte_ids)
        for token, (rank, a, b) in sorted(known.parts.items(), key=lambda x: x[1][0]):
            if a in whole and b in whole and self._undisturbed(a, b, rank):
                whole.add(token)
        self.by_spelling = {known.spelled[t]: t for t in whole}
        # By the last bytes of longer spellings, the lengths that spellings with that end have, the longest first.
        lengths: dict[bytes, set[int]] = {}
        for spelling in self.by_spelling:
            if len(spelling) > TAIL:
                lengths.setdefault(spelling[-TAIL:], set()).add(len(spelling))
        self.lengths = {tail: sorted(some, reverse=True) for tail, some in lengths.items()}
        self.ends: dict[bytes, tuple[tuple[int, int | None], ...]] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one end of a token, outermost first, each with the rank of the merge that takes it up."""
        known = self.spines[side - 1].get(token)
        if known is None:
            known, inner = [(token, float("inf"))], token
            while (made := self.known.parts.get(inner)) is not None:
                inner = made[side]
                known.append((inner, made[0]))
            if len(self.spines[side - 1]) >= SPINES:
                self.spines[side - 1].clear()
            self.spines[side - 1][token] = known
        return known

    def _undisturbed(self, a: int, b: int, before: float) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before their own ends are taken up.

        Of equal ranks the left one is merged first: a merge across the border
        loses to the one that takes up its left part, and wins over its right part's.
        """
        merges, rights = self.known.merges, self._spine(b, 1)
        for left, left_until in self._spine(a, 2):
            for right, right_until in rights:
                across = merges.get((left, right))
                if across and across[0] < before and across[0] < left_until and across[0] <= right_until:
                    return False
        return True

    def may_follow(self, a: int, b: int) -> bool:
        """Whether ``b`` can stand after ``a`` in an encoding."""
        answer = self.fits.get(a << 32 | b)
        if answer is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            answer = self.fits[a << 32 | b] = self._undisturbed(a, b, float("inf"))
        return answer

    def encode_all(self, pieces: set[str]) -> dict[str, bytes]:
        """The encoding of each distinct piece, as little-endian unsigned 32-bit integers."""
        out = {}
        spelling, fits, known, spelled = self.by_spelling.get, self.fits.get, self.ends.get, self.known.spelled
        path, lasts = b"", [None]  # lasts[i]: the last token of path[:i], if it was asked for

        def last(end: int) -> int:
            for length, token in known(raw[end - TAIL if end > TAIL else 0 : end]) or self.candidates(raw, end):
                if token is None and (length > end or (token := spelling(raw[end - length : end])) is None):
                    continue
                if length == end:
                    break
                before = lasts[end - length]
                if before is None:
                    before = last(end - length)
                answer = fits(before << 32 | token)
                if answer or answer is None and self.may_follow(before, token):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            lasts[end] = token
            return token

        # The order of texts is that of their UTF-8.
        for piece in sorted(pieces):
            raw = piece.encode()
            token = spelling(raw)
            if token is not None:
                out[piece] = token.to_bytes(4, "little")
                continue
            depth, end = 0, len(raw)
            most = min(end, len(path))
            while depth < most and raw[depth] == path[depth]:
                depth += 1
            lasts[depth + 1 :] = [None] * (end - depth)
            if end > DEEP:
                for at in range(1, end):
                    if lasts[at] is None:
                        last(at)
            path = raw
            tokens = []
            while end:
                token = lasts[end]
                if token is None:
                    token = last(end)
                tokens.append(token)
                end -= len(spelled[token])
            out[piece] = array("I", tokens[::-1]).tobytes()
        return out

    def candidates(self, raw: bytes, end: int) -> tuple[tuple[int, int | None], ...]:
        """Lengths that the last token of ``raw[:end]`` can have, the longest first, with the token where ``TAIL`` bytes tell it."""
        tail = raw[end - TAIL if end > TAIL else 0 : end]
        found = self.ends.get(tail)
        if found is None:
            if len(self.ends) >= ENDS:
                self.ends.clear()
            short = [(len(tail) - at, token) for at in range(len(tail)) if (token := self.by_spelling.get(tail[at:])) is not None]
            found = self.ends[tail] = (*((length, None) for length in self.lengths.get(tail, ())), *short)
        return found


@lru_cache(maxsize=4)
def trie(path: str) -> Trie:
    """One trie walker per file and worker."""
    return Trie(vocabulary(path))


class Encoder:
    """Encodes batches of texts; keeps the ids of recent parts as little-endian bytes."""

    def __init__(self, path: str) -> None:
        self.known, self.trie = vocabulary(path), trie(path)
        self.memory: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.sizes = [0, 0]
        top = max(self.known.spelled) + 1
        spelled = [self.known.spelled.get(i, b"") for i in range(top)]
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)

    def _forget(self, which: int, asked: Callable[[], set[str]]) -> None:
        """Keep of a memory that is full only what is asked for now, so that frequent words stay."""
        kept = (self.memory, self.pieces)[which]
        if len(kept) >= REMEMBERED or self.sizes[which] >= REMEMBERED_SIZE:
            stay = {key: kept[key] for key in asked() if key in kept}
            kept.clear()
            kept.update(stay)
            self.sizes[which] = sum(len(key) + len(ids) for key, ids in kept.items())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        memory, known_pieces, added = self.memory, self.pieces, self.known.added
        cut = [[(special, [s] if special else parts_of(s)) for special, s in self.known.split(text or "")] for text in texts]
        self._forget(0, lambda: {p for stretches in cut for special, parts in stretches if not special for p in parts})
        # Per stretch the ids of its parts, None where they are not known yet.
        ids = [[[int(added[parts[0]]).to_bytes(4, "little")] if special else list(map(memory.get, parts)) for special, parts in stretches] for stretches in cut]
        new = {p for stretches, found in zip(cut, ids) for (_, parts), some in zip(stretches, found) if None in some for p, known in zip(parts, some) if known is None}
        cuts = {part: some for part in new if len(some := self.known.pieces(part)) != 1}
        asked = set(chain.from_iterable(cuts.values()))
        self._forget(1, lambda: asked)
        unknown = asked.difference(known_pieces, memory, new - cuts.keys())
        # A piece that is a part is remembered once, as a part.
        for piece, packed in self.trie.encode_all(unknown | (new - cuts.keys())).items():
            (known_pieces if piece in unknown else memory)[piece] = packed
        for part, some in cuts.items():
            memory[part] = b"".join([known_pieces[p] if p in known_pieces else memory[p] for p in some])
        out = []
        for stretches, found in zip(cut, ids):
            raw = [b"".join(map(memory.__getitem__, parts) if None in some else some) for (_, parts), some in zip(stretches, found)]
            out.append(b"".join(raw))
        for which, (kept, keys) in enumerate(((memory, new), (known_pieces, unknown))):
            for key in keys:
                if len(key) > SHORT:
                    del kept[key]
                else:
                    self.sizes[which] += len(key) + len(kept[key])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of an array of ids."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ids) else 0)
        return self.letters[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and worker, so that tasks share what it remembers."""
    return Encoder(path)


def together(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of rows (key, text) that are encoded together: at most ``TOGETHER`` rows, and of several no more than ``TOGETHER_SIZE`` bytes."""
    at = size = 0
    for end, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
        if end > at and (end - at >= TOGETHER or size + n > TOGETHER_SIZE):
            yield batch.slice(at, end - at)
            at, size = end, 0
        size += n
    if at < batch.num_rows:
        yield batch.slice(at)


def _encode_rows(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for batch in batches:
        for part in together(batch):
            raw = own.encode(part.column(1).to_pylist())
            offsets = np.cumsum([0, *(len(r) // 4 for r in raw)])
            values = pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["key", "ids"])


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int) for every row."""
    bound_batches(df.sparkSession)
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([StructField("key", df.schema[key].dataType), StructField("ids", ArrayType(IntegerType()))])
    return source.mapInArrow(partial(_encode_rows, path or default_path()), schema).withColumnRenamed("key", key)


def _decode_rows(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            texts = [own.decode(np.array(ids if ids is not None else [], dtype=np.int64)) for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["key", "text"])


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``key`` and ``text`` for every row; null ids decode to the empty text."""
    bound_batches(df.sparkSession)
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    schema = StructType([StructField("key", df.schema[key].dataType), StructField("text", StringType())])
    return source.mapInArrow(partial(_decode_rows, path or default_path()), schema).withColumnRenamed("key", key)


ROUND_TRIP = StructType(
    [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
)


def _round_trip_rows(path: str, with_ids: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for batch in batches:
        for part in together(batch):
            raw = own.encode(part.column(1).to_pylist())
            arrays = [np.frombuffer(r, "<u4") for r in raw]
            columns = [
                part.column(0),
                pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                pa.array([hashlib.sha256(own.decode(a).encode()).hexdigest() for a in arrays], pa.string()),
            ]
            names = ["key", *ROUND_TRIP.names]
            if with_ids:
                columns.append(pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``key``, the number of tokens, digests of the ids and of what they decode to, and the ids if asked for.

    Encoding and decoding happen in one pass, so that ids need not be moved.
    """
    bound_batches(df.sparkSession)
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    more = [StructField("ids", ArrayType(IntegerType()))] if with_ids else []
    schema = StructType([StructField("key", df.schema[key].dataType), *ROUND_TRIP.fields, *more])
    return source.mapInArrow(partial(_round_trip_rows, path or default_path(), with_ids), schema).withColumnRenamed("key", key)
