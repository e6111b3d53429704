"""Byte-level BPE by dynamic programming over prefixes, and decoding.

Every prefix of a piece has exactly one encoding, hence exactly one last token. For all
prefixes in order, a suffix automaton (Aho-Corasick) over the vocabulary gives the tokens
that end there; such a token is the last one if it is compatible with the last token of
the prefix before it, that is, if no merge would reach over the border of the two. The
tokens kept per prefix are followed back from the end: linear in the length of the piece,
whatever its merges, with ids equal to those of merging in rank order.

Two neighbours are compatible if at no rank the token that then stands left of the border
merges with the one right of it. These tokens are the right flank of the left token's merge
tree and the left flank of the right one's; each stands there from the rank of the merge
that made it to the rank of the merge that takes it away.

The vocabulary is the JSON file of a tokenizer, whose path is a parameter; the driver reads
it and sends it to the executors (a few MB, its size is checked).

Defined cases: null text encodes as empty; strings of added tokens inside a text become
these tokens; ids that are no tokens are decoded as nothing; bytes that are no UTF-8 after
decoding become U+FFFD; other columns stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskloom.llm import worker

# Fixed value: the published split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_VOCABULARY_BYTES = 64 << 20
# Pieces remembered per generation and Python worker, and pieces of a text handled at once.
REMEMBERED = 1 << 17
PIECES = 1 << 16
_NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file for every byte: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {chr(b): b for b in printable}
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class _Remembered(dict):
    """Encodings of short pieces, of two generations: what is used again outlives a change."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.before: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.encode(piece.encode("utf-8"))
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class SuffixAutomaton:
    """Aho-Corasick automaton over byte strings: which of them end at a place.

    ``ends[state]`` holds the strings that are suffixes of what was read, longest first,
    as (number, length). Moves are looked up in one dictionary, which learns those that
    go over failure links.
    """

    def __init__(self, strings: dict[bytes, int]):
        self.moves: dict[int, int] = {}
        own: list[tuple[int, int] | None] = [None]
        for value, number in strings.items():
            state = 0
            for byte in value:
                key = state << 8 | byte
                state = self.moves.get(key, 0)
                if not state:
                    state = self.moves[key] = len(own)
                    own.append(None)
            own[state] = (number, len(value))
        # Children come after their parents, so one pass in order of depth will do.
        self.failure = [0] * len(own)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        depth = [0] * len(own)
        edges = list(self.moves.items())
        for key, state in edges:
            depth[state] = depth[key >> 8] + 1
        for key, state in sorted(edges, key=lambda edge: depth[edge[1]]):
            parent, byte = key >> 8, key & 255
            if parent:
                self.failure[state] = self.move(self.failure[parent], byte)
            shorter = self.ends[self.failure[state]]
            self.ends[state] = shorter if own[state] is None else (own[state], *shorter)

    def move(self, state: int, byte: int) -> int:
        """The state after one more byte; the move is known from then on."""
        path = []
        while True:
            key = state << 8 | byte
            to = self.moves.get(key)
            if to is not None or not state:
                break
            path.append(key)
            state = self.failure[state]
        to = to or 0
        for key in path:
            self.moves[key] = to
        return to


class Vocabulary:
    """Tokens and merges of a byte-level BPE vocabulary."""

    def __init__(self, content: str):
        data = json.loads(content)
        letters = _byte_letters()
        self.bytes_of: dict[int, bytes] = {}
        ids: dict[str, int] = data["model"]["vocab"]
        for token, i in ids.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.merges: dict[tuple[int, int], int] = {}
        # Per token the merge that makes it: its rank and both parts.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.merges.setdefault((a, b), rank)
            self.made.setdefault(whole, (rank, a, b))
        self._right_of: dict[int, dict[int, int]] = {}
        for (a, b), rank in self.merges.items():
            self._right_of.setdefault(a, {})[b] = rank
        self._flanks: tuple[dict, dict] = ({}, {})
        self._compatible: dict[int, bool] = {}
        self.whole = {value: i for i, value in self.bytes_of.items() if self._stands(i)}
        self.automaton = SuffixAutomaton(self.whole)
        self.added = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode("utf-8")
        longest_first = sorted(self.added, key=len, reverse=True)
        self._added = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self._split = regex.compile(SPLIT)
        self._pieces = _Remembered(self.encode_piece)

    def _flank(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Tokens at the left (0) or right (1) end of a token: id, made at, taken at."""
        known = self._flanks[side].get(token)
        if known is None:
            known, at, taken = [], token, _NEVER
            while True:
                made = self.made.get(at)
                known.append((at, made[0] if made else -1, taken))
                if made is None:
                    break
                taken, at = made[0], made[1 + side]
            self._flanks[side][token] = known
        return known

    def _crossing(self, a: int, b: int, below: int = _NEVER) -> bool:
        """Whether a merge of a rank under ``below`` reaches over the border of a and b."""
        for x, x_made, x_taken in self._flank(a, 1):
            ranks = self._right_of.get(x)
            if ranks is None:
                continue
            for y, y_made, y_taken in self._flank(b, 0):
                rank = ranks.get(y)
                # Of equal merges the left one comes first: x is gone, y still there.
                if (
                    rank is not None
                    and x_made < rank < x_taken
                    and y_made < rank <= y_taken
                    and rank < below
                ):
                    return True
        return False

    def _stands(self, token: int) -> bool:
        """Whether merging the bytes of a token gives the token."""
        made = self.made.get(token)
        if made is None:
            return len(self.bytes_of[token]) == 1
        rank, a, b = made
        return not self._crossing(a, b, rank)

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge reaches over the border of two neighbouring tokens."""
        key = a << 32 | b
        known = self._compatible.get(key)
        if known is None:
            known = not self._crossing(a, b)
            if len(self._compatible) >= 4 * REMEMBERED:
                self._compatible.clear()
            self._compatible[key] = known
        return known

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece, from the last token of each of its prefixes."""
        if piece in self.whole:
            return (self.whole[piece],)
        moves, ends, known = self.automaton.moves, self.automaton.ends, self._compatible
        last, size = [-1], [0]
        state = end = 0
        for byte in piece:
            end += 1
            to = moves.get(state << 8 | byte)
            state = self.automaton.move(state, byte) if to is None else to
            for token, length in ends[state]:
                if length != end:
                    pair = last[end - length] << 32 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = self.compatible(pair >> 32, token)
                    if not fits:
                        continue
                last.append(token)
                size.append(length)
                break
        ids = []
        while end:
            ids.append(last[end])
            end -= size[end]
        ids.reverse()
        return tuple(ids)

    def _plain(self, text: str, at: int, to: int) -> Iterator[list[int]]:
        matches = self._split.finditer(text, at, to)
        if to < len(text):  # an added token ends the text for the pattern
            matches = self._split.finditer(text[at:to])
        while pieces := [m.group() for m in islice(matches, PIECES)]:
            yield chain.from_iterable(map(self._pieces.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        if len(text) < PIECES and not self._added.search(text):
            ids.extend(
                chain.from_iterable(map(self._pieces.__getitem__, self._split.findall(text)))
            )
            return ids
        at = 0
        for added in self._added.finditer(text):
            for part in self._plain(text, at, added.start()):
                ids.extend(part)
            ids.append(self.added[added.group()])
            at = added.end()
        for part in self._plain(text, at, len(text)):
            ids.extend(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


def _loaded(sent) -> Vocabulary:
    """The vocabulary of a broadcast, built once per Python worker."""
    content = sent.value
    return worker.kept(("vocabulary", hash(content)), lambda: Vocabulary(content))


def _send(frame: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary {path} is too large to be sent to executors")
    return frame.sparkSession.sparkContext.broadcast(content)


_IDS = pa.list_(pa.int32())


def _mapped(frame: DataFrame, column: str, new: list[StructField], path: str, work) -> DataFrame:
    """``frame`` with new columns that ``work(vocabulary, values)`` gives for a column."""
    names = [f.name for f in new]
    taken = {c.lower() for c in frame.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the frame already has {sorted(taken)}; name other outputs")
    sent, at = _send(frame, path), frame.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(sent)
        for batch in batches:
            columns = [*batch.columns, *work(vocabulary, batch.column(at))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return frame.mapInArrow(run, StructType([*frame.schema.fields, *new]))


def _encoded(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    return pa.array([vocabulary.encode(t.as_py() or "") for t in texts], _IDS)


def encode(frame: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with the token ids of a text column."""
    new = [StructField(ids, ArrayType(IntegerType()))]
    return _mapped(frame, column, new, path, lambda v, texts: [_encoded(v, texts)])


def decode(frame: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with the texts of token ids, special tokens included; null ids: empty."""
    new = [StructField(decoded, StringType())]
    return _mapped(
        frame,
        ids,
        new,
        path,
        lambda v, lists: [pa.array([v.decode(x.as_py() or []) for x in lists], pa.string())],
    )


def round_trip(
    frame: DataFrame,
    path: str,
    column: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts."""
    new = [StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())]

    def work(vocabulary: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        lists, back = [], []
        for text in texts:
            own = vocabulary.encode(text.as_py() or "")
            back.append(vocabulary.decode(own))
            lists.append(pa.array(own, pa.int32()))
        offsets = [0, *_running(map(len, lists))]
        values = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
        return [
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
            pa.array(back, pa.string()),
        ]

    return _mapped(frame, column, new, path, work)


def _running(sizes) -> Iterator[int]:
    total = 0
    for size in sizes:
        total += size
        yield total
