"""Periodic runs of words: frequency splitting leaves the stretches that may hold runs, a lag scan finds the runs in them.

A run has at least four periods, so each of its words occurs at least four times in it. Words that occur less often in
the current segment split it; the parts are counted again until nothing changes. The segments that remain are scanned
by lag, for all documents of a chunk at once. Lags q from w to 2w - 1 (w a power of two) are looked at together: a run
of period q covers a multiple of w such that the window of w words there comes again q words on, so each word takes
part in one comparison of window hashes per power of two, whatever the number of lags. Matches at neighbouring
multiples are extended to maximal stretches on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import extended, prepare
from tallyforge.llm.text import Chunk, chunks, find_words, mix, span_hashes

#: A run of period q has at least max(LEAST_WORDS, LEAST_TIMES * q) words.
LEAST_TIMES, LEAST_WORDS = 4, 6
#: Rounds of splitting. Stretches that still change after so many (each round then takes off a few words) are scanned as they are.
ROUNDS = 64
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def surviving_segments(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches in which every word occurs often enough to be part of a run.

    ``codes`` numbers the distinct words, ``bounds[i] : bounds[i + 1]`` are the words of document i.
    """
    long = np.diff(bounds) >= LEAST_WORDS
    starts, ends = bounds[:-1][long].astype(np.int64), bounds[1:][long].astype(np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    kinds = int(codes.max()) + 1 if len(codes) else 1
    for _ in range(ROUNDS):
        if not len(starts):
            break
        sizes = ends - starts
        segment = np.repeat(np.arange(len(starts)), sizes)
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        _, which, times = np.unique(segment * kinds + codes[at], return_inverse=True, return_counts=True)
        often = times[which] >= LEAST_TIMES
        stable = np.bincount(segment[~often], minlength=len(starts)) == 0
        done.append((starts[stable], ends[stable]))
        left = often & ~stable[segment]
        at, segment = at[left], segment[left]
        if not len(at):
            starts = ends = at
            break
        first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0))
        starts, ends = at[first], at[np.append(first[1:], len(at)) - 1] + 1
        enough = ends - starts >= LEAST_WORDS
        starts, ends = starts[enough], ends[enough]
    done.append((starts, ends))
    starts, ends = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


class _Line:
    """Segments one after the other, the longest first, with a word of its own behind each."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        order = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[order], ends[order]
        self.sizes = ends - starts
        places = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.shift = starts - places
        self.places = places
        total = int((self.sizes + 1).sum())
        at = np.repeat(self.shift, self.sizes + 1) + np.arange(total)
        self.words = codes[np.minimum(at, len(codes) - 1)].astype(np.int64)
        self.words[places + self.sizes] = int(codes.max()) + 1 + np.arange(len(starts))

    def reach(self, least: int) -> int:
        """Words of the segments that have at least ``least`` words."""
        count = int(np.searchsorted(-self.sizes, -least, "right"))
        return int((self.sizes[:count] + 1).sum())

    def position(self, place: np.ndarray) -> np.ndarray:
        """Word number in the chunk."""
        return place + self.shift[np.searchsorted(self.places, place, "right") - 1]


def _known_ends(runs: list[tuple[int, int, int]], width: int, count: int) -> np.ndarray:
    """For each multiple of ``width`` the furthest end of a run that starts at or before it."""
    ends = np.zeros(count, dtype=np.int64)
    for start, end, _ in runs:
        first = -(-start // width)
        if first < count:
            ends[first] = max(ends[first], end)
    return np.maximum.accumulate(ends)


def _matching(words: np.ndarray, at: int, lag: int, width: int, step: int) -> int:
    """Words from ``at`` on, in the direction of ``step`` and less than ``width``, that come again ``lag`` words later."""
    if step > 0:
        end = min(at + width - 1, len(words) - lag)
        same = words[at:end] == words[at + lag : end + lag]
    else:
        start = max(0, at - width + 2)
        same = (words[start : at + 1] == words[start + lag : at + 1 + lag])[::-1]
    return len(same) if same.all() else int(np.argmin(same))


def lag_scan(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows ``start, length, period`` (start as word number of the chunk) of all runs in the segments, each with its least period."""
    if not len(starts):
        return np.zeros((0, 3), dtype=np.int64)
    line = _Line(codes, starts, ends)
    hashes, width, runs = mix(line.words.view(np.uint64)), 1, []
    while (size := line.reach(max(LEAST_WORDS, LEAST_TIMES * width))) > 0:
        words = line.words[:size]
        count = (size - 1) // width + 1
        # Windows that would reach behind the end never match.
        padded = np.concatenate([hashes[: size - width + 1], mix(np.arange(3 * width, dtype=np.uint64) ^ np.uint64(1 << 63))])
        later = sliding_window_view(padded[width:], width)[::width][:count]
        anchor, lag = np.divmod(np.flatnonzero(padded[: count * width : width][: len(later), None] == later), width)
        lag += width
        if len(anchor) and runs:
            # Inside a run of a shorter period a longer lag only finds a multiple of it.
            fresh = anchor * width + width + lag > _known_ends(runs, width, count)[anchor]
            anchor, lag = anchor[fresh], lag[fresh]
        if len(anchor):
            order = np.lexsort((anchor, lag))
            anchor, lag = anchor[order], lag[order]
            first = np.flatnonzero((np.diff(lag, prepend=-1) != 0) | (np.diff(anchor, prepend=-2) != 1))
            times = np.diff(np.append(first, len(anchor)))
            least = np.maximum(LEAST_WORDS, LEAST_TIMES * lag[first]) - lag[first]
            likely = (times + 2) * width - 2 >= least
            for a, q, n, need in zip((anchor[first] * width)[likely].tolist(), lag[first][likely].tolist(), times[likely].tolist(), least[likely].tolist()):
                start = a - _matching(words, a - 1, q, width, -1)
                stop = a + n * width
                stop += _matching(words, stop, q, width, 1)
                if stop - start >= need:
                    runs.append((start, stop + q, q))
        hashes = mix(hashes[: size - 2 * width + 1] * _ODD + hashes[width : size - width + 1])
        width *= 2
    if not runs:
        return np.zeros((0, 3), dtype=np.int64)
    found = np.array(runs, dtype=np.int64)
    return np.column_stack([line.position(found[:, 0]), found[:, 1] - found[:, 0], found[:, 2]])


def chunk_runs(chunk: Chunk):
    """Words of a chunk, all runs of its documents as rows ``start, length, period`` sorted by start and period, and which words stay."""
    words = find_words(chunk)
    codes = np.unique(span_hashes(chunk.data, words.starts, words.ends), return_inverse=True)[1].astype(np.int64)
    runs = lag_scan(codes, *surviving_segments(codes, words.bounds))
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    steps = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return words, runs, np.cumsum(steps)[:-1] == 0


_FIELDS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _outputs(chunk: Chunk) -> list[pa.Array]:
    words, runs, stay = chunk_runs(chunk)
    edges = np.searchsorted(runs[:, 0], words.bounds)
    inside = runs[:, 0] - words.bounds[np.searchsorted(words.bounds, runs[:, 0], "right") - 1]
    items = pa.StructArray.from_arrays([pa.array(inside, pa.int64()), pa.array(runs[:, 1], pa.int64()), pa.array(runs[:, 2], pa.int64())], ["start", "length", "period"])
    raw, texts = chunk.data.tobytes(), []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        left = a + np.flatnonzero(stay[a:b])
        texts.append(b" ".join([raw[s:e] for s, e in zip(words.starts[left].tolist(), words.ends[left].tolist())]))
    return [
        pa.array(np.diff(words.bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), items).cast(_FIELDS),
        pa.array(texts, pa.binary()).cast(pa.string()),
    ]


def find_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (``start``, ``length``, ``period``, in words, by start and period) and ``collapsed``.

    A run is a stretch of words with least period q and at least max(6, 4q) words that no neighbour extends. ``collapsed``
    has the words, joined by one blank, that no run holds after its first period. NULL and empty texts have no words, no
    runs and an empty ``collapsed``. Each row is judged by itself, so repeated rows get equal results, and no row needs
    another one: there is no shuffle. Other columns stay; those with the name of an output are replaced. Words are
    compared by 64-bit hashes of the whole word.
    """
    prepare(docs.sparkSession)
    names = ["n_words", "runs", "collapsed"]
    rows = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names or c == text_column))
    if text_column in names:
        raise ValueError(f"The text column may not be called {text_column}.")
    place = rows.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(place)):
                own = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([*own.columns, *_outputs(chunk)], [*own.schema.names, *names])

    return rows.mapInArrow(run, extended(rows.schema, n_words="bigint", runs=RUNS, collapsed="string"))
