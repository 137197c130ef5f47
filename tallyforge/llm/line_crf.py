"""Quality rules: a linear-chain conditional random field labels the lines of a text, the share of content decides.

The field has two labels, boilerplate (0) and content (1), a weight per line feature and one per pair of neighbouring
labels. Training documents have a verdict each, their lines have none: line labels are latent, and each line says its
document's verdict with chance TRUTH only. Expectation-maximisation alternates between the expected labels of lines and
neighbours (forward-backward, with the verdicts) and gradient ascent on the field's exact likelihood given these. So a good document may
hold lines of boilerplate, and neighbours of different labels are seen. Viterbi decoding then labels all lines of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import extended, prepare
from tallyforge.llm.text import _SPACE, Chunk, chunks, covered, find_words, span_hashes, window_hashes, window_starts

#: Labelled documents per class that the field is fitted on, at most about this many.
SAMPLE = 600
REPEAT = 8
#: Share of words in content lines that a document needs.
LEAST_CONTENT = 0.5
#: Chance that a line has the label of its document's verdict, before the line is looked at.
TRUTH = 0.8
#: Weight of the quadratic penalty on steps.
STEP_PENALTY = 0.2

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[[ord(c) for c in ".!?:;"]] = True
FEATURES = [
    "bias", "log_words", "word_length", "symbols", "digits", "upper", "exclamations", "bars", "closed", "commas", "stutter", "repeated", "short_words", "few_words",
]


@dataclass
class Lines:
    """Lines of a chunk: word counts, features, and ``bounds[i] : bounds[i + 1]`` as the lines of document i."""

    words: np.ndarray
    features: np.ndarray
    bounds: np.ndarray


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


def _again(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether an item of the same owner with the same hash came earlier."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(hashes), dtype=bool)
    same[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    return same


def statistics(chunk: Chunk) -> tuple[dict[str, np.ndarray], Lines]:
    """Counts per document, and its lines with their features."""
    data, offsets = chunk.data, chunk.offsets
    words = find_words(chunk)
    hashes = span_hashes(data, words.starts, words.ends)
    owner = words.document()
    per_doc = lambda flags: np.diff(_sums(flags)[offsets])

    # Lines end before each \n and at the end of the text; a text of n line feeds has n + 1 lines.
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    counts = np.diff(_sums(data == 0x0A)[offsets]) + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    line_owner = np.repeat(np.arange(len(chunk)), counts)
    at = np.searchsorted(words.starts, np.stack([starts, ends]))
    n_words = at[1] - at[0]
    line_hashes = span_hashes(data, starts, ends)
    repeated = np.zeros(len(starts), dtype=bool)
    full = np.flatnonzero(n_words > 0)
    repeated[full] = _again(line_owner[full], line_hashes[full])

    where, windows = window_starts(words.bounds, REPEAT), window_hashes(hashes, REPEAT)
    places = np.flatnonzero(where)
    twice = np.zeros(len(hashes), dtype=bool)
    if len(places):
        order = np.lexsort((windows[places], owner[places]))
        a, b = places[order[:-1]], places[order[1:]]
        equal = (windows[a] == windows[b]) & (owner[a] == owner[b])
        twice[a[equal]] = twice[b[equal]] = True
    counts_of = {
        "n_words": np.diff(words.bounds),
        "word_chars": per_doc(_LEAD[data] & ~_SPACE[data]),
        "n_symbols": per_doc(_SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_owner[repeated], minlength=len(chunk)),
        "n_repeat_words": np.diff(_sums(covered(twice, REPEAT))[words.bounds]),
    }
    per_line = lambda flags: (lambda s: s[ends] - s[starts])(_sums(flags))
    of_words = lambda flags: (lambda s: s[at[1]] - s[at[0]])(_sums(flags))
    some = np.maximum(n_words, 1)
    letters = np.maximum(per_line(_LETTER[data]), 1)
    stutter = np.zeros(len(hashes), dtype=bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    lengths = words.ends - words.starts
    last = np.zeros(len(starts), dtype=bool)
    last[full] = _CLOSING[data[words.ends[at[1][full] - 1] - 1]]
    columns = [
        n_words > 0, np.log1p(n_words) / 3, of_words(lengths) / some / 10, per_line(_SYMBOLS[data]) / some, per_line(_DIGIT[data]) / some,
        per_line(_UPPER[data]) / letters, per_line(data == 0x21) / some, per_line(data == 0x7C) / some, last, per_line(data == 0x2C) / some,
        of_words(stutter) / some, repeated, of_words(lengths <= 3) / some, (n_words > 0) & (n_words < 4),
    ]
    features = np.minimum(np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1), 3.0)
    return counts_of, Lines(n_words, features, bounds)


@dataclass
class Field:
    """``weights`` favour content; ``steps[a, b]`` scores label b after label a."""

    weights: np.ndarray
    steps: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 2))
        out[:, 1] = features @ self.weights
        return out

    def decode(self, lines: Lines) -> np.ndarray:
        """Labels of the likeliest path of each document (ties go to content), all documents side by side."""
        scores = self.scores(lines.features)
        back = np.zeros((len(scores), 2), dtype=np.int8)
        best = np.zeros((len(lines.bounds) - 1, 2))
        for active, at in _walk(lines.bounds):
            first = at == lines.bounds[active]
            ways = best[active][:, :, None] + np.where(first[:, None, None], 0.0, self.steps[None])
            back[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
            best[active] = np.where(first[:, None], 0.0, ways.max(axis=1)) + scores[at]
        labels = np.zeros(len(scores), dtype=np.int8)
        state = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for active, at in reversed(list(_walk(lines.bounds))):
            labels[at] = state[active]
            state[active] = back[at, state[active]]
        return labels


def _walk(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each line number: the documents that have it, and where it is."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    for t in range(int(sizes.max()) if len(sizes) else 0):
        active = order[: np.searchsorted(-sizes[order], -t, "left")]
        yield active, bounds[active] + t


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class _Lattice:
    """Forward-backward sums over the lines of all documents side by side."""

    def __init__(self, bounds: np.ndarray):
        self.walk = list(_walk(bounds))
        self.size = int(bounds[-1])
        self.head, self.final = np.zeros(self.size, dtype=bool), np.zeros(self.size, dtype=bool)
        self.head[bounds[:-1]] = self.final[bounds[1:] - 1] = True
        self.follows = np.flatnonzero(~self.head)

    def expected(self, scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of content per line, and expected number of each pair of neighbouring labels."""
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        for _, at in self.walk:
            before = ahead[np.maximum(at - 1, 0)][:, :, None] + steps[None]
            ahead[at] = scores[at] + np.where(self.head[at][:, None], 0.0, _log_add(before, 1))
        for _, at in reversed(self.walk):
            after = np.minimum(at + 1, self.size - 1)
            further = steps[None] + (scores[after] + behind[after])[:, None, :]
            behind[at] = np.where(self.final[at][:, None], 0.0, _log_add(further, 2))
        total = _log_add(ahead + behind, 1)
        follows = self.follows
        pair = np.exp(ahead[follows - 1][:, :, None] + steps[None] + (scores[follows] + behind[follows])[:, None, :] - total[follows][:, None, None])
        return np.exp(ahead[:, 1] + behind[:, 1] - total), pair.sum(axis=0)


def fit_field(
    features: np.ndarray, lattice: _Lattice, content: np.ndarray, pairs: np.ndarray, start: Field | None = None, rounds: int = 150, penalty: float = 1e-3,
    step_penalty: float = STEP_PENALTY,
) -> Field:
    """Maximise the mean expected log-likelihood for chances of content and expected pairs of neighbouring labels, less a quadratic penalty.

    The penalty on steps is the larger one: a verdict that all lines of a document share must not pass for persistence of their labels.
    """
    field = start or Field(np.zeros(features.shape[1]), np.zeros((2, 2)))
    moment, square = np.zeros(features.shape[1] + 4), np.zeros(features.shape[1] + 4)
    for k in range(1, rounds + 1):
        found, seen = lattice.expected(field.scores(features), field.steps)
        slope = np.concatenate([features.T @ (content - found), (pairs - seen).ravel()]) / len(content)
        slope -= np.concatenate([penalty * field.weights, step_penalty * field.steps.ravel()])
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.15 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        field = Field(field.weights + move[:-4], field.steps + move[-4:].reshape(2, 2))
    return field


def learn(features: np.ndarray, bounds: np.ndarray, good: np.ndarray, truth: float = TRUTH, turns: int = 8) -> Field:
    """Field from documents with a verdict each and latent line labels.

    The first turn takes lines as independent, each content with chance ``truth`` in a good document and ``1 - truth`` in another;
    later turns take what the last field and the verdicts say together.
    """
    lattice = _Lattice(bounds)
    verdict = np.repeat(good, np.diff(bounds))
    content = np.where(verdict, truth, 1 - truth)
    both = np.stack([1 - content, content], axis=1)
    pairs = np.einsum("ia,ib->ab", both[lattice.follows - 1], both[lattice.follows])
    evidence = np.zeros((len(verdict), 2))
    evidence[:, 1] = np.where(verdict, 1, -1) * np.log(truth / (1 - truth))
    field = fit_field(features, lattice, content, pairs)
    for _ in range(turns):
        content, pairs = lattice.expected(field.scores(features) + evidence, field.steps)
        field = fit_field(features, lattice, content, pairs, field, 40)
    return field


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, goods, cells = [], [], []
        for chunk in chunks(batch.column(2)):
            _, lines = statistics(chunk)
            for i, (a, b) in enumerate(zip(lines.bounds[:-1], lines.bounds[1:])):
                places.append(batch.column(0)[chunk.first + i].as_py())
                goods.append(batch.column(1)[chunk.first + i].as_py())
                cells.append(lines.features[a:b].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(goods, pa.bool_()), pa.array(cells, pa.binary())], ["place", "good", "features"])


def fit(docs: DataFrame, labels: DataFrame, good: Column, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> Field:
    """Fit on about ``sample`` documents that ``good`` (over ``labels``) holds for and as many others, chosen by a hash of the id.

    The sample is the bound on what reaches the driver. Without labels all weights stay zero, and every line counts as content.
    """
    prepare(docs.sparkSession)
    named = labels.select(F.col(id_column).alias("id"), good.alias("good")).dropna().distinct()
    sizes = {row["good"]: row["n"] for row in named.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.when(F.col("good"), sample / max(1, sizes.get(True, 0))).otherwise(sample / max(1, sizes.get(False, 0)))
    chosen = named.withColumn("place", F.xxhash64("id")).where(F.pmod("place", F.lit(1 << 30)) < part * (1 << 30)).limit(4 * sample)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "id").select("place", "good", "text")
    rows = texts.mapInArrow(_line_batches, "place long, good boolean, features binary").toPandas().sort_values(["place", "features"])
    width = len(FEATURES)
    if rows.empty:
        return Field(np.zeros(width), np.zeros((2, 2)))
    cells = [np.frombuffer(x, dtype=np.float32).reshape(-1, width) for x in rows["features"]]
    sizes_of = np.array([len(c) for c in cells])
    return learn(np.concatenate(cells).astype(np.float64), np.concatenate([[0], np.cumsum(sizes_of)]), rows["good"].to_numpy().astype(bool))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``n_lines``, ``content_lines``, ``content_share`` (of words) and ``kept``.

    A text fails the base rules with fewer than 20 words or when more than 30 % of its words lie in windows of 8 words that
    it repeats. Else it is kept when at least half of its words stand in lines labelled content. NULL counts as empty.
    Columns of ``docs`` with the names of outputs are replaced.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    docs = docs.drop(*_COUNTS, "base_failed", "n_lines", "content_lines", "content_share", "kept")
    names = docs.columns
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            found: list[list[np.ndarray]] = []
            for chunk in chunks(batch.column(at)):
                counts, lines = statistics(chunk)
                labels = field.decode(lines)
                per_doc = lambda x: np.diff(_sums(x)[lines.bounds])  # noqa: B023, E731
                words = counts["n_words"]
                share = per_doc(lines.words * labels) / np.maximum(words, 1)
                failed = (words < 20) | (100 * counts["n_repeat_words"] > 30 * words)
                found.append([*(counts[c] for c in _COUNTS), failed, np.diff(lines.bounds), per_doc((labels == 1) & (lines.words > 0)), share, ~failed & (share >= LEAST_CONTENT)])
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            more = [pa.array(np.concatenate([f[i] for f in found]) if found else [], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

    outputs = {c: "long" for c in _COUNTS} | {"base_failed": "boolean", "n_lines": "long", "content_lines": "long", "content_share": "double", "kept": "boolean"}
    schema = extended(docs.schema, **outputs)
    return docs.mapInArrow(run, schema)
