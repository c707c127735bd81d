"""Operator 10: token counts by a compiled finite-state tokenizer.

The merges of a byte-level tokenizer are compiled into a deterministic
transducer over bytes. A state holds, for the longest suffix that some token
starts with, the last token of the encoding at each of its positions and how
many tokens lie between there and here; that is all that the future depends on,
because a sequence of tokens is an encoding just when each adjacent pair is. A
transition is annotated with the tokens it emits, net. States are determinised
when text first reaches them and kept in bounded memory.

A long text is cut into chunks. A chunk's state map is constant but for the
bytes before its first position where a pre-token surely starts, so it is held
as (head, count, tail); maps compose associatively, and a balanced prefix scan
composes the maps of a text's chunks.

For sentencepiece files the library's own counts are used. A null text counts
as empty: 0 bytes, 0 tokens. Rows are independent: repeated rows, null ids and
extra columns don't matter; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, common, words

NEVER = 1 << 60


class Transducer:
    """Bytes of one pre-token -> number of its tokens."""

    def __init__(self, pairs: bpe.BytePairs, most_states: int = 300_000):
        self.pairs, self.most_states = pairs, most_states
        special = set(pairs.split.special.values())
        self.token = {b: i for i, b in pairs.bytes_of.items() if i not in special}
        self.starts = {b[:n] for b in self.token for n in range(len(b) + 1)}
        #: token -> (rank of the merge that makes it, left part, right part)
        self.made = {new: (rank, pair >> 32, pair & 0xFFFFFFFF) for pair, (rank, new) in pairs.merges.items()}
        self._edge = functools.lru_cache(maxsize=200_000)(self._edge_of)
        self._fits = functools.lru_cache(maxsize=400_000)(self._fit)
        self._fresh()

    def _fresh(self) -> None:
        #: state -> (suffix, last token at each of its positions, count there less the count here)
        self.states: list[tuple[bytes, tuple, tuple]] = [(b"", (None,), (0,))]
        self.number = {self.states[0]: 0}
        self.arcs: dict[int, int] = {}

    def _edge_of(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The parts that stand at one edge of a token while it is merged, and the rank at which each is merged away."""
        out, gone = [(token, NEVER)], token
        while gone in self.made:
            rank, a, b = self.made[gone]
            gone = b if right else a
            out.append((gone, rank))
        return out

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens apart when they stand side by side."""
        get = self.pairs.merges.get
        for x, x_gone in self._edge(left, True):
            for y, y_gone in self._edge(right, False):
                # of equal ranks the leftmost pair is merged first
                if (found := get(x << 32 | y)) and found[0] < x_gone and found[0] <= y_gone:
                    return False
        return True

    def _compile(self, state: int, byte: int) -> int:
        """Adds the transition for ``byte``: next state << 16 | emitted + 32768."""
        suffix, last, less = self.states[state]
        longer = suffix + bytes([byte])
        for at in range(len(longer)):
            token = self.token.get(longer[at:])
            if token is not None and (last[at] is None or self._fits(last[at], token)):
                break
        emitted = less[at] + 1
        skip = 0
        while longer[skip:] not in self.starts:
            skip += 1
        # positions at which no longer token can start don't matter any more
        live = [longer[at:] in self.starts for at in range(skip, len(longer) + 1)]
        last = tuple(t if use else -1 for t, use in zip((*last, token)[skip:], live, strict=True))
        less = tuple(n - emitted if use else 0 for n, use in zip((*less, emitted)[skip:], live, strict=True))
        key = (longer[skip:], last, less)
        if (goal := self.number.get(key)) is None:
            goal = self.number[key] = len(self.states)
            self.states.append(key)
        arc = self.arcs[state << 8 | byte] = goal << 16 | emitted + 32768
        return arc

    def count(self, word: str) -> int:
        if len(self.states) > self.most_states:
            self._fresh()
        state = total = 0
        get = self.arcs.get
        for byte in word.encode():
            arc = get(state << 8 | byte) or self._compile(state, byte)
            state = arc >> 16
            total += (arc & 0xFFFF) - 32768
        return total


class ChunkMap(NamedTuple):
    """What a chunk does. Without a sure start: head is the whole chunk and tail is None."""

    head: str
    count: int
    tail: str | None


_SURE = re.compile(r"(?<=[^\s\x1c-\x1f])[ \t\n]")


class Counter:
    """Token counts of whole texts."""

    def __init__(self, path: str, chunk: int = 65_536):
        pairs = bpe.pairs(path)
        self.machine, self.split, self.chunk = Transducer(pairs), pairs.split, chunk
        #: tokens of a text that starts and ends where pre-tokens do
        self.piece = words.TextMap(self.split, lambda w: 1 if w in self.split.special else self.machine.count(w), sum)

    def map(self, chunk: str) -> ChunkMap:
        if (first := _SURE.search(chunk)) is None:
            return ChunkMap(chunk, 0, None)
        end = first.start()
        for m in _SURE.finditer(chunk, max(end, len(chunk) - 2000)):
            end = m.start()
        return ChunkMap(chunk[: first.start()], self.piece(chunk[first.start() : end]), chunk[end:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.piece(a.tail + b.head) + b.count, b.tail)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """The maps of all prefixes, by a balanced scan: pairs first, then the scan of the pairs, then the rest."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return self.piece(text)
        whole = self.scan([self.map(text[i : i + self.chunk]) for i in range(0, len(text), self.chunk)])[-1]
        return self.piece(whole.head) + (0 if whole.tail is None else whole.count + self.piece(whole.tail))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Callable[[str], int]:
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text))
    return Counter(path).count


def count_tokens(docs: DataFrame, limit: int = 512, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    path = vocabulary or words.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in common.lean(batches, "token_count", counter.cache_clear):
            tokens = [count(x.as_py() or "") for x in batch.column(1)]
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).cast(pa.int64())
            over = pa.array([n > limit for n in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens, pa.int64()), over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(common.table(spark, sf_dir, "documents"))
