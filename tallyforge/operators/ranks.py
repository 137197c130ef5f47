"""Cut a table at exact ranks of a hash order, without sorting or moving its rows.

Rows are ordered by ``md5(seed|key)`` inside each group. The hashes are written once, next to their group and nothing else.
One pass counts them by their first three digits; running counts show which digits hold the wanted ranks. A second pass takes
the hashes with those digits, one in 4096 per cut, and counts on by six digits and then by whole hashes. So only counts and
a few hashes are shuffled, never rows, and a group that holds most of the table is no slower than a small one.

The result is a ``CutPlan``: one boundary text per group and cut. A row finds its segment by comparing its hash with the
boundaries of its group, in this table or in any other that has the same key and group columns.

Rows with equal keys are told apart by a second hash over all columns. What is still equal then
is a set of identical rows, which is split by count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.ordering import order_hash, row_text
from tallyforge.session import settle, spread

ORDER, PREFIX = "_order", "_prefix"
STEP = 3
# Sorts after every hex digit, so ``prefix + AFTER`` lies behind all hashes with that prefix.
AFTER = "g"
COPIES_PER_CHUNK = 100_000

Sizer = Callable[[DataFrame], DataFrame]


def holding(bins: DataFrame, within: Sequence[str], order: str, wanted: DataFrame) -> DataFrame:
    """For each wanted rank the bin that holds it, and ``rank`` as the rank inside that bin of ``n``."""
    rows = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = bins.withColumn("_upto", F.sum("n").over(rows)).withColumn("_before", F.col("_upto") - F.col("n"))
    both = spans.join(wanted, list(within)) if within else spans.join(F.broadcast(wanted))
    inside = (F.col("_before") < F.col("rank")) & (F.col("rank") <= F.col("_upto"))
    return both.filter(inside).withColumn("rank", F.col("rank") - F.col("_before")).drop("_upto", "_before")


def _locate(hashes: DataFrame, groups: Sequence[str], sizer: Sizer) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of the groups, the wanted ranks, and per wanted rank its hash with ``rank`` among the ``n`` rows that have this hash."""
    groups = list(groups)
    start = F.substring(ORDER, 1, STEP)
    first = settle(hashes.groupBy(*groups, start.alias(PREFIX)).agg(F.count(F.lit(1)).alias("n")))
    sizes = first.groupBy(*groups).agg(F.sum("n").alias("n"))
    # One row per group and cut.
    wanted = sizer(sizes).select(*groups, F.col("cut").cast("int"), F.col("rank").cast("bigint"))
    hits = settle(holding(first, groups, PREFIX, wanted.filter("rank > 0")).drop("n"))
    near = hashes.withColumn(PREFIX, start).join(hits.select(*groups, PREFIX).distinct(), [*groups, PREFIX], "left_semi")
    few = settle(near.groupBy(*groups, PREFIX, ORDER).agg(F.count(F.lit(1)).alias("n")))
    keys, deeper = [*groups, PREFIX], F.substring(ORDER, 1, 2 * STEP).alias("_deep")
    middle = holding(few.groupBy(*keys, deeper).agg(F.sum("n").alias("n")), keys, "_deep", hits).drop("n")
    found = holding(few.select(*keys, deeper, ORDER, "n"), [*keys, "_deep"], ORDER, middle)
    return sizes, wanted, found.select(*groups, "cut", ORDER, "rank", "n")


def _segment(cuts: Sequence[Column]) -> Column:
    """Number of boundaries that lie before the row."""
    return reduce(lambda a, b: a + b, [(c < F.col(ORDER)).cast("int") for c in cuts], F.lit(0))


def _copies(rows: DataFrame, ties: DataFrame, groups: Sequence[str], columns: list[str], into: str) -> DataFrame:
    """Identical rows at a cut, handed out to the segments by count."""
    w = Window.partitionBy(*groups, ORDER).orderBy("cut")
    steps = ties.withColumns({"from": F.coalesce(F.lag("rank").over(w), F.lit(0)), "last": F.lead("cut").over(w).isNull()})
    shares = steps.select(
        *groups,
        ORDER,
        F.inline(
            F.array(
                F.struct(F.col("cut").alias(into), (F.col("rank") - F.col("from")).alias("copies")),
                F.struct((F.col("cut") + 1).alias(into), F.when(F.col("last"), F.col("n") - F.col("rank")).otherwise(0).alias("copies")),
            )
        ),
    ).filter(F.col("copies") > 0)
    keys = [*groups, ORDER]
    sample = rows.groupBy(*keys).agg(F.first(F.struct(*columns)).alias("row"))
    # Two steps, so that no task writes more than one chunk of a large set of copies.
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES_PER_CHUNK}"))
    return (
        sample.join(shares, keys)
        .withColumn("chunk", F.explode(chunks))
        .repartition(*keys, into, "chunk")
        .withColumn("size", F.least(F.lit(COPIES_PER_CHUNK), F.col("copies") - F.col("chunk") * COPIES_PER_CHUNK))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("size").cast("bigint"))))
        .select("row.*", into)
    )


@dataclass(frozen=True)
class CutPlan:
    """Boundaries of the segments of each group; ``cuts`` has one row per group.

    ``by_row`` says that rows with equal keys lie at a cut, so that whole rows decide and no other table can be marked.
    """

    groups: tuple[str, ...]
    key: tuple[str, ...] | None
    seed: int
    n_cuts: int
    cuts: DataFrame
    by_row: bool = False
    copies: DataFrame | None = None

    def order(self, df: DataFrame) -> Column:
        own = order_hash(df, self.key, self.seed)
        return F.concat(own, F.md5(row_text(df))) if self.by_row else own

    def mark(self, df: DataFrame, into: str = "segment") -> DataFrame:
        """``df`` with the number of the segment of each row; rows of an unknown or NULL group are left out."""
        columns, groups = df.columns, list(self.groups)
        ordered = df.withColumn(ORDER, self.order(df))
        if groups:
            placed, marks = ordered.join(self.cuts, groups), [F.col(f"_cut_{j}") for j in range(self.n_cuts)]
        else:
            row = self.cuts.first()
            placed, marks = ordered, [F.lit(row[f"_cut_{j}"]) for j in range(self.n_cuts)]
        if self.copies is None:
            return placed.select(*columns, _segment(marks).alias(into))
        keys = [*groups, ORDER]
        tied = settle(self.copies.select(*keys).distinct())
        whole = placed.join(tied, keys, "left_anti").select(*columns, _segment(marks).alias(into))
        return whole.unionByName(_copies(ordered.join(tied, keys, "left_semi"), self.copies, groups, columns, into))

    def mark_other(self, df: DataFrame, into: str = "segment") -> DataFrame:
        """Segments of the rows of a second table with the same rows by key and group."""
        if self.by_row:
            raise ValueError("Rows with equal keys lie at a cut; only the table that was cut can be marked.")
        return self.mark(df, into)


def plan_cuts(df: DataFrame, groups: Sequence[str], sizer: Sizer, n_cuts: int, *, key: Sequence[str] | None = None, seed: int) -> CutPlan:
    """Boundaries that cut each group of a table at given ranks.

    ``sizer`` maps the group sizes ``(groups, n)`` to ``(groups, cut, rank)``: rows of rank up to
    ``rank`` lie before cut number ``cut`` (0 to ``n_cuts - 1``, ranks ascending). ``key`` names
    the columns that identify a row, all columns by default. Rows with a NULL group are left out.
    """
    groups = list(groups)
    if groups:
        df = df.dropna(subset=groups)
    hashes = settle(df.select(*groups, order_hash(df, key, seed).alias(ORDER)))
    sizes, wanted, found = _locate(hashes, groups, sizer)

    def ends(located: DataFrame) -> DataFrame:
        """One row per group: its boundaries, and whether a cut falls between rows of one hash."""
        bounds = located.select(*groups, "cut", F.concat(ORDER, F.lit(AFTER)).alias("bound"), (F.col("rank") < F.col("n")).alias("_tie"))
        bounds = bounds.unionByName(wanted.filter("rank <= 0").select(*groups, "cut", F.lit("").alias("bound"), F.lit(False).alias("_tie")))
        each = [F.coalesce(F.max(F.when(F.col("cut") == j, F.col("bound"))), F.lit(AFTER)).alias(f"_cut_{j}") for j in range(n_cuts)]
        each.append(F.coalesce(F.max("_tie"), F.lit(False)).alias("_tie"))
        return settle(sizes.select(*groups).join(bounds, groups, "left").groupBy(*groups).agg(*each) if groups else bounds.agg(*each))

    cuts = ends(found)
    if cuts.filter("_tie").isEmpty():
        return CutPlan(tuple(groups), tuple(key) if key else None, seed, n_cuts, cuts.drop("_tie"))
    own = [*groups, "_first"]
    located = settle(found)
    tied = settle(located.filter("rank < n").select(*groups, F.col(ORDER).alias("_first"), "cut", "rank"))
    rows = df.select(*groups, order_hash(df, key, seed).alias("_first"), F.md5(row_text(df)).alias(ORDER))
    rows = settle(rows.join(tied.select(*own).distinct(), own, "left_semi"))
    whole = settle(_locate(rows, own, lambda _: tied)[2].select(*groups, "cut", F.concat("_first", ORDER).alias(ORDER), "rank", "n"))
    cuts = ends(located.filter("rank = n").unionByName(whole))
    copies = None if cuts.filter("_tie").isEmpty() else settle(whole.filter("rank < n"))
    return CutPlan(tuple(groups), tuple(key) if key else None, seed, n_cuts, cuts.drop("_tie"), True, copies)


def assign_segments(
    df: DataFrame,
    groups: Sequence[str],
    sizer: Sizer,
    n_cuts: int,
    *,
    key: Sequence[str] | None = None,
    seed: int,
    into: str = "segment",
) -> DataFrame:
    """``plan_cuts`` and its segments on the table itself."""
    df = spread(df)
    return plan_cuts(df, groups, sizer, n_cuts, key=key, seed=seed).mark(df, into)
