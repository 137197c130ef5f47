"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Pre-tokenisation uses no regular expression. Each code point becomes a symbol (letter, number, other,
apostrophe that may start a contraction, kinds of white space, end of text). A symbol is a function over
the few states of an automaton; composing functions is associative, so that a scan over blocks of text
gives the state before every block, and one pass over all blocks side by side marks where pieces start.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.storage import extended, prepare
from tallyforge.llm.text import Chunk, chunks, span_hashes, trim

_END = 0x110000
_LETTER, _NUMBER, _OTHER, _BLANK, _WHITE, _STOP = range(6)
# Symbols: the first three classes, then contractions of two and three characters, the last white space of
# a run before something else (blank or not), other white space, the end of a text.
_SHORT, _LONG, _LAST_BLANK, _LAST_WHITE, _MORE_WHITE, _ENDED = range(3, 9)
# States: what the piece that is open consists of.
_NEW, _LETTERS, _NUMBERS, _OTHERS, _AFTER_BLANK, _WHITES, _ONE_LEFT, _TWO_LEFT = range(8)
_OPENED = {
    _LETTER: _LETTERS, _NUMBER: _NUMBERS, _OTHER: _OTHERS, _SHORT: _ONE_LEFT, _LONG: _TWO_LEFT,
    _LAST_BLANK: _AFTER_BLANK, _LAST_WHITE: _NEW, _MORE_WHITE: _WHITES, _ENDED: _NEW,
}
_GOES_ON = {_LETTERS: {_LETTER: _LETTERS}, _NUMBERS: {_NUMBER: _NUMBERS}, _WHITES: {_MORE_WHITE: _WHITES}}
_GOES_ON[_OTHERS] = {s: _OTHERS for s in (_OTHER, _SHORT, _LONG)}
_GOES_ON[_AFTER_BLANK] = {_LETTER: _LETTERS, _NUMBER: _NUMBERS} | _GOES_ON[_OTHERS]
_GOES_ON[_ONE_LEFT] = {s: _NEW for s in range(8)}
_GOES_ON[_TWO_LEFT] = {s: _ONE_LEFT for s in range(8)}
_NEXT = np.array([[_GOES_ON.get(q, {}).get(s, _OPENED[s]) for q in range(8)] for s in range(9)], dtype=np.uint8)
_STARTS = np.array([[s != _ENDED and s not in _GOES_ON.get(q, {}) for q in range(8)] for s in range(9)], dtype=bool)
#: Characters of one block of the scan.
BLOCK = 128
_NO_PAIR = 1 << 30
#: Bytes of text that are encoded at once.
CHUNK = 2 << 20
#: Pieces that a worker's cache may hold before it starts anew.
CACHE = 300_000


def code_point_classes() -> np.ndarray:
    """Class of each code point; the tokenizer library is asked once for its letters, numbers and white space."""
    import tiktoken

    points = [c for c in range(_END) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(_END + 1, _OTHER, dtype=np.uint8)
    for kind, name in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
        library = tiktoken.Encoding(kind, pat_str=name, mergeable_ranks=single, special_tokens={})
        table[[ord(c) for c in bytes(library.encode_ordinary(every)).decode()]] = kind
    table[0x20], table[_END] = _BLANK, _STOP
    return table


def symbols(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of each code point; texts end with the code point ``_END``."""
    kind = classes[points]
    following = np.append(kind[1:], np.uint8(_STOP))
    out = kind.copy()
    white = (kind == _BLANK) | (kind == _WHITE)
    out[white] = np.where(following[white] >= _BLANK, _MORE_WHITE, np.where(kind[white] == _BLANK, _LAST_BLANK, _LAST_WHITE))
    out[kind == _STOP] = _ENDED
    at = np.flatnonzero(points == 0x27)
    if len(at):
        one = points[np.minimum(at + 1, len(points) - 1)]
        two = points[np.minimum(at + 2, len(points) - 1)]
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = _SHORT
        long = np.zeros(len(at), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        out[at[long]] = _LONG
    return out


def piece_flags(symbol: np.ndarray) -> np.ndarray:
    """Where pieces start, by a scan of transition functions over blocks."""
    count = len(symbol)
    blocks = -(-count // BLOCK)
    padded = np.full(blocks * BLOCK, _ENDED, dtype=np.uint8)
    padded[:count] = symbol
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.intp) * 8
    flat, starts = _NEXT.ravel().astype(np.intp), _STARTS.ravel()
    whole = np.tile(np.arange(8), (blocks, 1))
    for column in columns:
        whole = flat[column[:, None] + whole]
    distance = 1
    while distance < blocks:
        whole[distance:] = np.take_along_axis(whole[distance:], whole[:-distance].copy(), axis=1)
        distance *= 2
    state = np.zeros(blocks, dtype=np.intp)
    state[1:] = whole[:-1, _NEW]
    flags = np.empty((BLOCK, blocks), dtype=bool)
    for row, column in enumerate(columns):
        cell = column + state
        flags[row] = starts[cell]
        state = flat[cell]
    return flags.T.ravel()[:count]


class Tokenizer:
    """Rank table, code-point classes and a bounded cache of merged pieces."""

    def __init__(self, ranks_file: bytes, classes: np.ndarray):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.classes = classes
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(size)]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        known = [
            (self.ranks[token[:k]] << 32 | self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        order = np.array(sorted(known), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.pair_ranks = np.ascontiguousarray(order[:, 0]), np.ascontiguousarray(order[:, 1])
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def piece_starts(self, chunk: Chunk) -> np.ndarray:
        """Byte offsets at which the pieces of a chunk start."""
        lead = np.flatnonzero((chunk.data & 0xC0) != 0x80)
        points = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        points = np.insert(points, np.searchsorted(lead, chunk.offsets[1:]), np.uint32(_END))
        flags = piece_flags(symbols(points, self.classes))
        return lead[flags[points != _END]]

    def merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece. In every round each piece joins its pair of least rank, the leftmost of equals."""
        out: list = [None] * len(pieces)
        open_ = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = (rank,)
            elif len(piece) > 64:
                out[i] = self._merge_long(piece)
            else:
                open_.append(i)
        if not open_:
            return out
        owner = np.array(open_)
        sizes = np.array([len(pieces[i]) for i in open_])
        parts = self.single[np.frombuffer(b"".join([pieces[i] for i in open_]), dtype=np.uint8)]
        rank = self._pair_ranks(parts, np.append(parts[1:], -1))
        rank[np.cumsum(sizes) - 1] = _NO_PAIR
        while len(owner):
            ends = np.cumsum(sizes)
            begins = ends - sizes
            least = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), begins)
            done = least >= _NO_PAIR << 32
            if done.any():
                flat = parts.tolist()
                for i, a, b in zip(owner[done].tolist(), begins[done].tolist(), ends[done].tolist()):
                    out[i] = tuple(flat[a:b])
                keep = np.repeat(~done, sizes)
                parts, rank, owner, sizes = parts[keep], rank[keep], owner[~done], sizes[~done]
                if not len(owner):
                    break
                begins = np.cumsum(sizes) - sizes
                at = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), begins) & 0xFFFFFFFF
            else:
                at = least & 0xFFFFFFFF
            parts[at] = rank[at]
            keep = np.ones(len(parts), dtype=bool)
            keep[at + 1] = False
            border = at + 1 == np.cumsum(sizes) - 1
            at = at - np.arange(len(at))
            parts, rank = parts[keep], rank[keep]
            sizes = sizes - 1
            begins = np.cumsum(sizes) - sizes
            following = parts[np.minimum(at + 1, len(parts) - 1)]
            rank[at] = np.where(border, _NO_PAIR, self._pair_ranks(parts[at], following))
            inner = at[at > begins]
            rank[inner - 1] = self._pair_ranks(parts[inner - 1], parts[inner])
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours form, or ``_NO_PAIR``."""
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], _NO_PAIR)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap and a linked list, for pieces of any length."""
        import heapq

        ranks, size = self.ranks, len(piece)
        ends = list(range(1, size + 1))  # end of the part that starts here; 0 when it was joined to the left
        before = list(range(-1, size - 1))
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= size or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < size:
                before[end] = i
                if (r := ranks.get(piece[i : ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if i:
                j = before[i]
                if (r := ranks.get(piece[j:end])) is not None:
                    heapq.heappush(heap, (r, j, end))
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return tuple(out)

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and the number of ids of each text; equal pieces are looked up once."""
        starts = self.piece_starts(chunk)
        raw = chunk.data.tobytes()
        ends = np.append(starts[1:], len(raw))
        _, sample, which = np.unique(span_hashes(chunk.data, starts, ends), return_index=True, return_inverse=True)
        pieces = [raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist())]
        found = list(map(self.cache.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        merged = self.merge_many([pieces[i] for i in missing])
        if len(self.cache) + len(missing) > CACHE:
            self.cache.clear()
        for i, ids in zip(missing, merged):
            found[i] = ids
            if len(pieces[i]) <= 64:
                self.cache[pieces[i]] = ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        counts = sizes[which]
        totals = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(sizes) - sizes)[which] - totals[:-1]
        ids = flat[np.repeat(shift, counts) + np.arange(totals[-1])]
        return ids, np.diff(totals[np.searchsorted(starts, chunk.offsets)])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a run of ids, gathered from one blob of all tokens."""
        lengths = self.lengths[ids]
        shift = self.begins[ids] - (np.cumsum(lengths) - lengths)
        return self.blob[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


@contextmanager
def _tokenizer(shared) -> Iterator[Tokenizer]:
    """The tokenizer of a task. Its tables and the pieces that it has merged go with the task, as later stages use the worker again."""
    ranks_file, classes = shared.value
    tokenizer = Tokenizer(ranks_file, np.frombuffer(classes, dtype=np.uint8))
    try:
        yield tokenizer
    finally:
        del tokenizer
        gc.collect()
        trim()


def share_tokenizer(spark: SparkSession, ranks_path: str):
    """Broadcast the rank file (bounded by the vocabulary) and the class of each code point."""
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), code_point_classes().tobytes()))


def _encoded(column: pa.Array, tokenizer: Tokenizer) -> pa.ListArray:
    parts = [tokenizer.encode(chunk) for chunk in chunks(column, CHUNK)]
    ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
    counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))


def _token_ends(ids: pa.ListArray, tokenizer: Tokenizer) -> pa.ListArray:
    """End of each token in the bytes of its text."""
    edges, values = ids.offsets.to_numpy(), ids.values.to_numpy()
    sums = np.concatenate([[0], np.cumsum(tokenizer.lengths[values])])
    ends = sums[1:] - np.repeat(sums[edges[:-1]], np.diff(edges))
    return pa.ListArray.from_arrays(ids.offsets, pa.array(ends.astype(np.int32), pa.int32()))


def _decoded_digests(ids: pa.ListArray, tokenizer: Tokenizer) -> pa.Array:
    """SHA-256 of what each list of ids decodes to."""
    edges, values = ids.offsets.to_numpy(), ids.values.to_numpy()
    return pa.array([hashlib.sha256(tokenizer.decode(values[a:b])).hexdigest() for a, b in zip(edges[:-1], edges[1:])], pa.string())


def encode(
    docs: DataFrame, ranks_path: str, text_column: str = "text", ids: str = "token_ids", ends: str | None = "token_ends", digest: str | None = None,
) -> DataFrame:
    """Add the token ids of ``text_column``, the end of each token in the text's bytes, and on demand a digest of the decoded ids.

    Every match of the published pattern is merged separately, without special tokens; NULL counts as
    empty and gives no ids. Columns of ``docs`` are kept; one with the name of an output is replaced.
    ``ends=None`` leaves the offsets out; ``digest`` names a column for the SHA-256 of the bytes that the ids decode to,
    which costs no second Python process. Texts are worked on whole, in chunks of about a megabyte.
    """
    prepare(docs.sparkSession)
    shared = share_tokenizer(docs.sparkSession, ranks_path)
    docs = docs.drop(*[c for c in (ids, ends, digest) if c is not None and c != text_column])
    names = docs.columns
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _tokenizer(shared) as tokenizer:
            for batch in batches:
                found = _encoded(batch.column(at), tokenizer)
                made = {ids: lambda: found, ends: lambda: _token_ends(found, tokenizer), digest: lambda: _decoded_digests(found, tokenizer)}  # noqa: B023
                more = {name: make() for name, make in made.items() if name is not None}
                yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*names, *more])

    return docs.mapInArrow(run, extended(docs.schema, **{name: kind for name, kind in ((ids, "array<int>"), (ends, "array<int>"), (digest, "string")) if name is not None}))


def decode(encoded: DataFrame, ranks_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; NULL gives NULL."""
    prepare(encoded.sparkSession)
    shared = share_tokenizer(encoded.sparkSession, ranks_path)
    encoded = encoded.drop(out)
    names = encoded.columns
    at = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _tokenizer(shared) as tokenizer:
            for batch in batches:
                cells = [None if cell is None else tokenizer.decode(np.array(cell, dtype=np.int64)).tobytes() for cell in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], [*names, out])

    return encoded.mapInArrow(run, extended(encoded.schema, **{out: "binary"}))


def digests(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_bytes, ids_sha256, decoded_sha256`` of each text, encoded and decoded in one task."""
    prepare(docs.sparkSession)
    shared = share_tokenizer(docs.sparkSession, ranks_path)
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _tokenizer(shared) as tokenizer:
            for batch in batches:
                counts, sizes, of_ids, of_bytes = [], [], [], []
                for chunk in chunks(batch.column(1), CHUNK):
                    ids, found = tokenizer.encode(chunk)
                    edges = np.concatenate([[0], np.cumsum(found)])
                    for a, b in zip(edges[:-1], edges[1:]):
                        decoded = tokenizer.decode(ids[a:b])
                        counts.append(b - a)
                        sizes.append(len(decoded))
                        of_ids.append(sha(" ".join(map(tokenizer.names.__getitem__, ids[a:b].tolist())).encode()))
                        of_bytes.append(sha(decoded))
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_bytes", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_bytes long, ids_sha256 string, decoded_sha256 string")
