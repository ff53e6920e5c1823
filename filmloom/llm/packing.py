"""Order-preserving packing of documents into sequences of a fixed length.

Documents follow each other by ascending doc_id as one stream of ids; a sequence is a window of it. Windows may be cut
at the end of a document (free), at the end of a sentence (a small penalty) or at every GRID-th id (a larger one). The
cuts minimise padding plus penalties. With best(j) the least cost of cutting the stream before place j, and cost
window - (j - i) + penalty(j) for a window from i to j, best(j) + j is the least best(i) + i within reach plus
window + penalty(j): a monotone queue holds the least, so each place costs constant time.

The stream is dealt to tasks by ranges of doc_id, as many as shuffle partitions; each range is packed by itself, and its
last stretch is cut to sequences of a power of two, which aren't padded, where that costs less. Within a range the
program is solved for CHUNK_TOKENS ids or a little more at a time; the window that is then open goes to the next chunk.
So cuts, though not what they minimise, change with the number of partitions, and by each chunk's end a few ids of
padding may be lost against one solution for the whole stream.

Defined cases: a null or empty text is its end id alone; documents without doc_id come first; repeated doc_ids stay
apart, in the order of a hash of their text; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import partitions, table, tied
from filmloom.llm.tokens import default_path, encoder, text_batches

WINDOW = 2048
END_ID = 1
CHUNK_TOKENS = 1 << 18
SENTENCE_PENALTY = 4.0
HARD_PENALTY = 32.0
GRID = 128
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " sequence_length long, padding long"
)


def padding(length: int, window: int = WINDOW) -> int:
    """Ids that fill a sequence up: none where its length is a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def best_cuts(places: list[int], penalties: list[float], window: int) -> list[int]:
    """Cuts from 0 to the last place, by least padding plus penalties. Neighbouring places are at most window apart."""
    value = [0.0] * (len(places) + 1)
    at = [0, *places]
    before = [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        here = at[j] - window
        while at[queue[0]] < here:
            queue.popleft()
        before[j] = i = queue[0]
        value[j] = v = value[i] + window + penalties[j - 1]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = before[j]
    return cuts[::-1]


def tail_cuts(length: int, window: int) -> list[int]:
    """Cuts of a last stretch of at most one window, its end included: a power of two needs no padding but costs a cut."""
    best = [(0.0, 0)]
    for n in range(1, length + 1):
        powers = [1 << k for k in range((n - 1).bit_length())]
        best.append(min([(float(padding(n, window)), n), *((HARD_PENALTY + best[n - x][0], x) for x in powers)]))
    cuts = [0]
    while cuts[-1] < length:
        cuts.append(cuts[-1] + best[length - cuts[-1]][1])
    return cuts[1:]


@lru_cache(4)
def sentence_ends(tokenizer: str) -> np.ndarray:
    """For each id, whether a sentence may end after it."""
    vocabulary = encoder(tokenizer).vocabulary()
    ends = np.zeros(max([0, *vocabulary.values()]) + 1, bool)
    for token, at in vocabulary.items():
        # fixed values: sentence marks, and how the file writes a line break
        ends[at] = token.endswith((".", "!", "?", "Ċ"))
    return ends


class _Stream:
    """The ids of a range that aren't placed yet: of each document its name, ids left, ids placed and all ids."""

    def __init__(self) -> None:
        self.ids = np.zeros(0, "<u4")
        self.names, self.left, self.placed, self.total = (np.zeros(0, np.int64) for _ in range(4))
        self.unnamed = np.zeros(0, bool)

    def add(self, names: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.names = np.concatenate([self.names, names.fill_null(0).to_numpy()])
        self.unnamed = np.concatenate([self.unnamed, names.is_null().to_numpy(zero_copy_only=False)])
        self.left, self.total = np.concatenate([self.left, sizes]), np.concatenate([self.total, sizes])
        self.placed = np.concatenate([self.placed, np.zeros(len(sizes), np.int64)])

    def stops(self) -> np.ndarray:
        return np.cumsum(self.left)

    def drop(self, upto: int) -> None:
        """Forget the ids before a place."""
        stops = self.stops()
        first = int(np.searchsorted(stops, upto, "right"))
        used = upto - (int(stops[first - 1]) if first else 0)
        self.ids, self.names, self.unnamed, self.total = self.ids[upto:], self.names[first:], self.unnamed[first:], self.total[first:]
        self.left, self.placed = self.left[first:].copy(), self.placed[first:].copy()
        if len(self.left):
            self.left[0] -= used
            self.placed[0] += used


def _cuts(stream: _Stream, ends: np.ndarray, window: int, last: bool) -> np.ndarray:
    """Ends of sequences. Only the last stretch of a range may be shorter than a window needs."""
    ids = stream.ids
    penalty = np.full(len(ids) + 1, np.inf)
    penalty[GRID::GRID] = HARD_PENALTY
    penalty[1:][ends[np.minimum(ids, len(ends) - 1)] & (ids < len(ends))] = SENTENCE_PENALTY
    penalty[stream.stops()] = 0.0
    spots = np.flatnonzero(penalty[1:] < np.inf) + 1
    cuts = best_cuts(spots.tolist(), penalty[spots].tolist(), window)
    end = cuts.pop()
    if last:
        begin = cuts[-1] if cuts else 0
        cuts += [begin + x for x in tail_cuts(end - begin, window)]
    return np.array(cuts, np.int64)


def _pieces(stream: _Stream, cuts: np.ndarray, first_sequence: int, window: int) -> pa.RecordBatch:
    """The pieces of the sequences that end at cuts."""
    stops = stream.stops()
    edges = np.unique(np.concatenate([[0], cuts, stops[stops < cuts[-1]]]))
    begin, end = edges[:-1], edges[1:]
    document, sequence = np.searchsorted(stops, begin, "right"), np.searchsorted(cuts, begin, "right")
    opens = np.concatenate([[0], cuts[:-1]])
    lengths = cuts - opens
    fills = np.where(lengths & (lengths - 1), window - lengths, 0)
    raw = memoryview(stream.ids.tobytes())
    crc = [zlib.crc32(raw[i:j]) for i, j in zip((4 * begin).tolist(), (4 * end).tolist(), strict=True)]
    start = begin - (stops - stream.left)[document] + stream.placed[document]
    columns = [start, end - begin, np.array(crc, np.int64), stream.total[document], first_sequence + sequence, begin - opens[sequence]]
    columns += [lengths[sequence], fills[sequence]]
    names = pa.array(stream.names[document], mask=stream.unnamed[document])
    return pa.RecordBatch.from_arrays([names, *map(pa.array, columns)], names=[x.split()[0] for x in PIECES.split(", ")])


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a sequence."""
    n = partitions(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, ends = encoder(tokenizer), sentence_ends(tokenizer)
        stream, sequence = _Stream(), 0

        def place(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            cuts = _cuts(stream, ends, window, last)
            if len(cuts):
                yield _pieces(stream, cuts, sequence, window)
                sequence += len(cuts)
                stream.drop(int(cuts[-1]))

        for batch in text_batches(batches):
            # a range has its own numbers
            sequence = sequence or batch.column("part")[0].as_py() << 32
            ids, sizes = coder.ended(batch.column("text"), end_id)
            at = 0
            for i, j in chunks(sizes):
                stream.add(batch.column("doc_id").slice(i, j - i), ids[at : (at := at + int(sizes[i:j].sum()))], sizes[i:j])
                if len(stream.ids) >= CHUNK_TOKENS:
                    yield from place(False)
        if len(stream.ids):
            yield from place(True)

    return (
        tied(docs)
        .repartitionByRange(n, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(run, PIECES)
    )


def chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of documents with CHUNK_TOKENS ids or a little more each."""
    i = 0
    while i < len(sizes):
        j = i + 1 + int(np.searchsorted(np.cumsum(sizes[i:]), CHUNK_TOKENS, "left"))
        yield i, min(j, len(sizes))
        i = j


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_path())
