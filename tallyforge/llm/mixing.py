"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources that they belong to. Each pattern offers its words once at low cost and
again at a rising cost, each source asks for its target; a min-cost flow over these few nodes says how many words
every pattern gives to which source. Whole passes go to every document of a pattern, the rest to the first ones in a
seeded order. Where that order is cut is found by narrowing hash digits with counts per bin: no row is sorted or moved.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import Scratch
from tallyforge.llm.text import WORD

#: Weights by rank of the source, share of all words to take, and how often a document may be taken.
WEIGHTS, SHARE, REPEATS, SEED = (3, 1, 2), 1.5, 2, "mix"
_DIGIT_BITS, _DIGITS = 12, 5


def targets(sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> dict[str | None, float]:
    """Words asked of each source: ``share`` of all words by weight, none above ``repeats`` times its size.

    Weights repeat over the sources in code-point order, NULL last. What a full source leaves goes to the others by weight.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    rest, left = share * sum(sizes.values()), set(order)
    while left:
        total = sum(weight[s] for s in left)
        full = {s for s in left if rest * weight[s] / total > repeats * sizes[s]}
        if not full:
            return out | {s: rest * weight[s] / total for s in left}
        for s in full:
            out[s] = float(repeats * sizes[s])
        rest -= sum(repeats * sizes[s] for s in full)
        left -= full
    return out


class _Network:
    """Min-cost flow by successive shortest paths with potentials."""

    def __init__(self):
        self.arcs: list[list] = []  # to, capacity left, cost
        self.of: dict = defaultdict(list)

    def add(self, a, b, capacity: int, cost: int) -> int:
        self.of[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.of[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, source, sink) -> None:
        height: dict = defaultdict(int)
        while True:
            reach, via, done, heap = {source: 0}, {}, set(), [(0, 0, source)]
            tick = 1
            while heap:
                far, _, node = heapq.heappop(heap)
                if node in done:
                    continue
                done.add(node)
                for k in self.of[node]:
                    to, room, cost = self.arcs[k]
                    step = far + cost + height[node] - height[to]
                    if room > 0 and step < reach.get(to, step + 1):
                        reach[to], via[to] = step, k
                        heapq.heappush(heap, (step, tick, to))
                        tick += 1
            if sink not in reach:
                return
            for node, far in reach.items():
                height[node] += far
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = self.arcs[via[node] ^ 1][0]
            flow = min(self.arcs[k][1] for k in path)
            for k in path:
                self.arcs[k][1] -= flow
                self.arcs[k ^ 1][1] += flow


def route(patterns: dict[tuple, int], quotas: dict, repeats: int = REPEATS) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources.

    The k-th use of a word costs 2k - 1, so that first uses go before repeats wherever sources overlap. Patterns that
    share no source are solved apart.
    """
    group = {s: s for s in quotas}

    def root(s):
        while group[s] != s:
            group[s] = group[group[s]]
            s = group[s]
        return s

    for pattern in patterns:
        for s in pattern[1:]:
            group[root(s)] = root(pattern[0])
    networks: dict = defaultdict(_Network)
    arcs: dict[tuple, dict] = {}
    for s, quota in quotas.items():
        networks[root(s)].add(("source", s), "out", quota, 0)
    for pattern, size in patterns.items():
        network = networks[root(pattern[0])]
        for k in range(repeats):
            network.add("in", ("pattern", pattern), size, 2 * k + 1)
        arcs[pattern] = {s: network.add(("pattern", pattern), ("source", s), repeats * size, 0) for s in pattern}
    for network in networks.values():
        network.run("in", "out")
    return {p: {s: networks[root(s)].arcs[k ^ 1][1] for s, k in found.items()} for p, found in arcs.items()}


@dataclass
class _Cut:
    """Where the seeded order of a pattern is cut: rows below ``low`` get one more copy, rows below ``high`` share ``left`` words."""

    passes: int
    left: int
    low: int = 0
    high: int = 1 << (_DIGIT_BITS * _DIGITS)
    rows: int = 0
    shift: int = _DIGIT_BITS * _DIGITS


def _place(id_column: str, text_column: str, seed: str) -> Column:
    """Sixty hash bits that give the seeded order."""
    parts = [F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame, sources: Column, id_column: str = "doc_id", text_column: str = "text",
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size`` and ``target`` of its source, ``taken`` (words, repeats counted) and ``copies``.

    ``sources`` is an array of the names that a row belongs to; a NULL in it is a source of its own, an empty or NULL
    array counts as that source too. ``source_size`` and ``target`` are NULL for rows of several sources. ``taken`` is a
    multiple of the size but for the one row per pattern at which the order is cut. Rows that agree in id and text
    there share what is left equally. Columns of ``docs`` with these names are replaced, all others stay, whatever they are called; an
    empty table gives an empty one.
    The driver sees one row per pattern and per hash bin at a cut, never rows of documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    names = F.when(F.coalesce(F.size(sources), F.lit(0)) > 0, F.array_sort(F.array_distinct(sources))).otherwise(F.array(F.lit(None).cast("string")))
    own = _free_names(docs.columns, ("pattern", "place", "passes", "low", "high", "left"))
    made = {
        "size": F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long"),
        own["pattern"]: F.to_json(names, {"ignoreNullFields": "false"}), own["place"]: _place(id_column, text_column, seed),
    }
    docs = docs.drop("size", "source_size", "target", "taken", "copies").withColumns(made)
    narrow = scratch.save(docs.select(F.col(own["pattern"]).alias("_pattern"), F.col(own["place"]).alias("_place"), "size"))
    found = {row["_pattern"]: row["n"] for row in narrow.groupBy("_pattern").agg(F.sum("size").alias("n")).collect()}
    key = {pattern: tuple(json.loads(pattern)) for pattern in found}
    sizes: dict[str | None, int] = defaultdict(int)
    for pattern, n in found.items():
        for s in key[pattern]:
            sizes[s] += n
    asked = targets(sizes, weights, share, repeats)
    flows = route({key[p]: n for p, n in found.items()}, {s: int(t) for s, t in asked.items()}, repeats)
    given = {p: sum(flows[key[p]].values()) for p in found}
    cuts = {p: _Cut(*divmod(given[p], n)) if n else _Cut(0, 0) for p, n in found.items()}
    _narrow(narrow, cuts)
    single = lambda p, of: of[key[p][0]] if len(key[p]) == 1 else None
    rows = [(p, single(p, sizes), single(p, asked), c.passes, c.low, c.high, c.left // max(1, c.rows)) for p, c in cuts.items()]
    plan = spark.createDataFrame(rows, "_pattern string, source_size long, target double, _passes long, _low long, _high long, _left long")
    plan = plan.withColumnsRenamed({f"_{name}": to for name, to in own.items()})
    place, size = F.col(own["place"]), F.col("size")
    more = F.when(place < F.col(own["low"]), size).when(place < F.col(own["high"]), F.least(own["left"], "size")).otherwise(F.lit(0))
    out = docs.join(plan, own["pattern"]).withColumn("taken", F.col(own["passes"]) * size + more)
    out = out.withColumn("copies", F.when(size > 0, F.ceil(F.col("taken") / size)).otherwise(F.lit(0)).cast("long"))
    return out.drop(*own.values())


def _free_names(taken: Sequence[str], names: Sequence[str]) -> dict[str, str]:
    """A column name that no given column has, for each name."""
    lower, out = {c.lower() for c in taken}, {}
    for name in names:
        free = f"_{name}"
        while free in lower:
            free = f"_{free}"
        out[name] = free
    return out


def _narrow(rows: DataFrame, cuts: dict[str, _Cut]) -> None:
    """Narrow every cut digit by digit until its bin holds one row, or rows that agree in all digits."""
    for cut in cuts.values():
        if not cut.left:
            cut.high = 0
    while waiting := {p: c for p, c in cuts.items() if c.left and c.shift and c.rows != 1}:
        shift = max(c.shift for c in waiting.values()) - _DIGIT_BITS
        open_ = rows.sparkSession.createDataFrame([(p, c.low, c.high) for p, c in waiting.items()], "_pattern string, _low long, _high long")
        inside = rows.join(open_, "_pattern").where("_place >= _low and _place < _high and size > 0")
        digit = F.shiftright("_place", shift).bitwiseAND((1 << _DIGIT_BITS) - 1)
        bins = defaultdict(list)
        for row in inside.groupBy("_pattern", digit.alias("digit")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).toLocalIterator():
            bins[row["_pattern"]].append((row["digit"], row["n"], row["rows"]))
        for p, cut in waiting.items():
            base, cut.shift = cut.low, shift
            for at, n, count in sorted(bins[p]):
                cut.low, cut.high, cut.rows = base + (at << shift), base + ((at + 1) << shift), count
                if cut.left < n:
                    break
                cut.left -= n
                cut.low = cut.high
            if not cut.left:
                cut.high = cut.low


def materialise(mixed: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """One row per copy that the mix takes, with ``copy`` from 1; texts stay whole.

    The document at which a source reaches its target, which the mix takes in part, comes once more if at least half of it is asked for
    and else not, so a source misses its target by half a document at most; no document comes more than ``repeats`` times.
    """
    whole = F.when(F.col("size") > 0, F.least(F.lit(repeats), F.floor(F.col("taken") / F.col("size") + 0.5))).otherwise(F.lit(0)).cast("long")
    return mixed.withColumn("copies", whole).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
