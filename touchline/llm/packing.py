"""Packing: documents, as token ids, are laid end to end and cut into sequences.

Cuts lie at ends of documents or sentences, or every ``stride`` tokens where a sentence is long.
Dynamic programming chooses them so that padding plus a penalty per truncated document is
smallest. A sequence from cut a to cut b costs ``room - (b - a)``, so the best a for b is the
smallest ``cost(a) + a`` within reach, which a monotone queue holds; sequences whose length is
a power of two need no padding and are looked up beside it.

Order is preserved: each input partition is a stream of its own, packed in the order of its rows
and in blocks of about ``block`` tokens, whose last sequence goes on in the next block. Nothing
is shuffled. Only the last sequence of a partition cannot be filled from what follows.

Defined results: a NULL or empty text has the end mark alone; NULL ids are kept; rows that repeat
an id are packed one by one. An added token of the vocabulary that stands in a text, such as
``<|endoftext|>``, becomes its one id, as in the tokenizer's own call without special tokens added.
Other columns are not carried.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from touchline.llm.bpe import Encoder, parts_of, text_sizes

ROW = "doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """The vocabulary's ids of a text as little-endian 32-bit numbers, and an end mark.

    With ``added``, an added token in a text is one id; otherwise it is spelled out like any word."""

    def __init__(self, path: str, end: int = 1, remembered: int = 300_000, added: bool = False):
        self.encoder = Encoder(path, remembered, added)
        self.mark = np.array([end], "<u4").tobytes()
        texts = self.encoder.vocabulary.texts
        self.stops = np.array([text[:1] in (".", "!", "?") for text in texts])

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, and the end mark."""
        return [ids + self.mark for ids in self.encoder.encode(texts)]


@lru_cache(maxsize=1)
def word_tokenizer(path: str, end: int) -> WordTokenizer:
    """One memory per Python worker, which later tasks find filled."""
    return WordTokenizer(path, end, added=True)


def choose_cuts(places: np.ndarray, penalties: np.ndarray, room: int, opening: float = 0.0) -> list[int]:
    """The cuts, from the first to the last of ``places``, that minimise padding and penalties.

    ``places`` ascend with gaps of at most ``room``; ``penalties`` are those of a cut there, to
    which the cost of ``opening`` a sequence comes.
    """
    n = len(places)
    at, penalty = places.tolist(), penalties.tolist()
    exact: list[list[int]] = [[] for _ in range(n)]
    size = 1
    while size <= room:
        sources = np.searchsorted(places, places - size)
        for i in np.flatnonzero(places[np.minimum(sources, n - 1)] == places - size).tolist():
            exact[i].append(int(sources[i]))
        size *= 2
    cost, back = [0.0] * n, [0] * n
    queue = deque([0])  # cuts within reach, cost + place ascending
    for i in range(1, n):
        here = at[i]
        while at[queue[0]] < here - room:
            queue.popleft()
        best = queue[0]
        value = cost[best] + at[best] + room - here
        for j in exact[i]:
            if cost[j] < value:
                best, value = j, cost[j]
        cost[i], back[i] = value + penalty[i] + opening, best
        rank = cost[i] + here
        while queue and cost[queue[-1]] + at[queue[-1]] >= rank:
            queue.pop()
        queue.append(i)
    chosen, i = [n - 1], n - 1
    while i:
        i = back[i]
        chosen.append(i)
    return [at[i] for i in reversed(chosen)]


class Packer:
    """Packs one stream of documents, a block at a time."""

    def __init__(self, stops: np.ndarray, first_id: int, room: int, block: int, stride: int, sentence: float, inside: float, opening: float):
        self.stops, self.sequence = stops, first_id
        self.room, self.block, self.stride, self.sentence, self.inside, self.opening = room, block, min(stride, room), sentence, inside, opening
        self.held: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.tokens = 0

    def add(self, doc_id, ids: bytes) -> None:
        self.held.append((doc_id, 0, ids, len(ids) // 4))
        self.tokens += len(ids) // 4

    def _cut_places(self, stream: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        penalty = np.full(len(stream) + 1, np.inf)
        penalty[np.flatnonzero(self.stops[stream]) + 1] = self.sentence
        penalty[0] = 0
        penalty[ends] = 0
        known = np.flatnonzero(np.isfinite(penalty))
        for a, b in zip(known[:-1], known[1:]):
            if b - a > self.stride:
                penalty[a + self.stride : b : self.stride] = self.inside
        places = np.flatnonzero(np.isfinite(penalty))
        return places, penalty[places]

    def rows(self, last: bool) -> Iterator[tuple]:
        """The pieces of the sequences that are complete, or of all."""
        if not self.held:
            return
        stream = np.frombuffer(b"".join([ids for _, _, ids, _ in self.held]), "<u4")
        ends = np.cumsum([len(ids) // 4 for _, _, ids, _ in self.held])
        cuts = choose_cuts(*self._cut_places(stream, ends), self.room, self.opening)
        if not last:
            cuts.pop()
        piece, begin = 0, 0
        edges = ends.tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = a
            while at < b:
                while edges[piece] <= at:
                    begin, piece = edges[piece], piece + 1
                doc_id, start, ids, doc_tokens = self.held[piece]
                until = min(b, edges[piece])
                yield doc_id, start + at - begin, until - at, ids[(at - begin) * 4 : (until - begin) * 4], doc_tokens, self.sequence, at - a
                at = until
            self.sequence += 1
        rest, done = [], cuts[-1]
        begin = 0
        for (doc_id, start, ids, doc_tokens), end in zip(self.held, edges):
            if end > done:
                skip = max(0, done - begin)
                rest.append((doc_id, start + skip, ids[skip * 4 :], doc_tokens))
            begin = end
        self.held, self.tokens = rest, len(stream) - done


def pack(
    docs: DataFrame,
    tokenizer: str,
    room: int = 2048,
    end: int = 1,
    block: int = 1 << 19,
    stride: int = 128,
    sentence: float = 2.0,
    inside: float = 32.0,
    opening: float = 6.0,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids`` (little-endian unsigned
    32-bit numbers), ``doc_tokens, sequence_id, offset``.

    ``sentence`` and ``inside`` are the penalties, in tokens of padding, of a cut after a
    sentence and within one; each sequence costs ``opening``, which holds back short ones.
    """
    kind = docs.schema["doc_id"].dataType
    schema = docs.sparkSession.createDataFrame([], ROW.format(kind=kind.simpleString())).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, end)
        packer = Packer(words.stops, TaskContext.get().partitionId() << 40, room, block, stride, sentence, inside, opening)
        id_type = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for part in parts_of(batch, text_sizes(batch.column("text")), 1 << 22):
                ids = words.batch([t or "" for t in part.column("text").to_pylist()])
                for doc_id, tokens in zip(part.column("doc_id").to_pylist(), ids):
                    packer.add(doc_id, tokens)
                    if packer.tokens >= block + room:
                        if rows := list(packer.rows(last=False)):
                            yield table(rows)
        if rows := list(packer.rows(last=True)):
            yield table(rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
