"""Boosted regression trees on histograms, one ensemble per series, all series at once.

Values are cut into bins at quantiles of their series. A level of a tree is one aggregation:
tasks count their rows by (series, node, feature, bin), Spark adds the counts up, and the best
cut of each node is the largest gain over them. Trees are rows of a table. What varies from
fit to fit (hyper-parameters, and the fold that is left out) is a `Task`; the tasks of a search
share bins and rows and grow side by side, their state an array with a place for each.

Predictions and gradients are whole numbers of 1/UNIT, so their sums do not depend on the
order of rows, partitions or retries, and neither do the trees. Rows stay where their series
is, in bucketed tables, from one level to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.operators.folds import FOLDS, TEST_ROWS
from shelfcast.schema import SERIES, TARGET
from shelfcast.session import stage, stage_by_series

BINS = 16
UNIT = 1 << 20
LEAST_GAIN = 1e-6

# The hyper-parameters that a search draws from.
GRID = {
    "learning_rate": [0.01, 0.025, 0.05, 0.1],
    "rounds": [50, 100, 200],
    "depth": [5, 10, 20, 50],
    "l2": [0.0, 0.25, 0.5, 0.75, 1.0],
}
DEEPEST = 12
"""Levels at most: a deeper tree needs more rows than a series of this many days has."""


@dataclass(frozen=True)
class Boost:
    """Hyper-parameters of an ensemble."""

    learning_rate: float = 0.1
    rounds: int = 100
    depth: int = 5
    l2: float = 0.0
    least_rows: int = 20

    @property
    def levels(self) -> int:
        return min(self.depth, DEEPEST)


@dataclass(frozen=True)
class Task:
    """One fit: its hyper-parameters, and the fold whose rows and all newer ones are left out."""

    boost: Boost
    fold: int | None = None

    def learns(self, test_rows: int = TEST_ROWS) -> Column:
        return F.lit(True) if self.fold is None else F.col("recency") > (self.fold + 1) * test_rows

    def tests(self, test_rows: int = TEST_ROWS) -> Column:
        recent = F.col("recency")
        return (recent > self.fold * test_rows) & (recent <= (self.fold + 1) * test_rows)


def bin_rows(rows: DataFrame, features: list[str], bins: int = BINS, keys: list[str] = SERIES) -> DataFrame:
    """keys, date, recency, y (the target) and `bins`: how many edges of a feature are below
    its value. Edges are the different quantiles of the series, values of the data; the newest
    row of a series carries them in `edges`. A series has a row per day at most."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in keys}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    schema += ", date date, recency int, y long, bins array<tinyint>, edges array<array<double>>"

    def cut(table: pa.Table) -> pa.Table:
        n = table.num_rows
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, len(features))
        ends = [-(-i * n // bins) - 1 for i in range(1, bins)]
        edges = [np.unique(column[ends]) for column in np.sort(x, axis=0).T]
        placed = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)], axis=1)
        newest = np.argsort(-table.column("date").cast(pa.int32()).to_numpy(), kind="stable")
        recency = np.empty(n, np.int32)
        recency[newest] = np.arange(1, n + 1)
        held: list = [None] * n
        held[newest[0]] = edges
        starts = np.arange(0, n * len(features) + 1, len(features), dtype=np.int32)
        return pa.table(
            {
                **{c: table.column(c) for c in keys}, "date": table.column("date"), "recency": recency, "y": table.column("y"),
                "bins": pa.ListArray.from_arrays(starts, pa.array(placed.astype(np.int8).ravel())),
                "edges": pa.array(held, pa.list_(pa.list_(pa.float64()))),
            }
        )

    values = F.array(*[F.col(f).cast("double") for f in features])
    narrow = rows.select(*keys, "date", F.col(TARGET).cast("long").alias("y"), values.alias("x"))
    return narrow.groupBy(*keys).applyInArrow(cut, schema)


def _histogram(rows: DataFrame, tasks: list[int], features: int, bins: int, keys: list[str]) -> DataFrame:
    """Sums of gradients and rows by bin of each feature: a row per series, task and node of
    a batch. Rows have `nodes`, the node of each task or -1, and `gradients`."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in keys}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", task int, node int, g array<long>, n array<long>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = np.arange(features) * bins
        for batch in batches:
            if not batch.num_rows:
                continue
            series = np.zeros(batch.num_rows, np.int64)
            for c in keys:
                codes = batch.column(c).dictionary_encode()
                series = series * (len(codes.dictionary) + 1) + codes.indices.fill_null(len(codes.dictionary)).to_numpy()
            _, first, series = np.unique(series, return_index=True, return_inverse=True)
            flat = lambda c, width: batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            places, nodes, gradients = flat("bins", features), flat("nodes", len(tasks)), flat("gradients", len(tasks))
            for at, task in enumerate(tasks):
                mine = np.flatnonzero(nodes[:, at] >= 0)
                if not len(mine):
                    continue
                most = int(nodes[:, at].max()) + 1
                groups, group = np.unique(series[mine] * most + nodes[mine, at], return_inverse=True)
                cells = (group[:, None] * (features * bins) + columns + places[mine]).ravel()
                size = len(groups) * features * bins
                # Two halves, so that the sums stay whole in floating point.
                high, low = gradients[mine, at] >> 20, gradients[mine, at] & (UNIT - 1)
                sums = [np.bincount(cells, np.repeat(half, features), size).astype(np.int64) for half in (high, low)]
                rows_in = np.bincount(cells, minlength=size)
                cut = np.arange(0, size + 1, features * bins, dtype=np.int32)
                where = pa.array(first[groups // most])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(where) for c in keys]
                    + [
                        pa.array(np.full(len(groups), task, np.int32)),
                        pa.array((groups % most).astype(np.int32)),
                        pa.ListArray.from_arrays(cut, pa.array(sums[0] * UNIT + sums[1])),
                        pa.ListArray.from_arrays(cut, pa.array(rows_in)),
                    ],
                    names=[*keys, "task", "node", "g", "n"],
                )

    return rows.select(*keys, "bins", "nodes", "gradients").mapInArrow(count, schema)


def _per_task(values: list[float]) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("task"))


def _best_cuts(histogram: DataFrame, tasks: list[Task], bins: int, keys: list[str]) -> DataFrame:
    """g and n of each (series, task, node), and its best cut: of equal gains the first."""
    group = [*keys, "task", "node"]
    cells = (
        histogram.select(*group, F.posexplode(F.arrays_zip("g", "n")).alias("place", "cell"))
        .groupBy(*group, "place")
        .agg(F.sum("cell.g").alias("g"), F.sum("cell.n").alias("n"))
        .withColumn("feature", F.floor(F.col("place") / bins).cast("int"))
    )
    whole = W.partitionBy(*group, "feature")
    up_to = whole.orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.select(
        *group, "place", F.sum("g").over(up_to).alias("gl"), F.sum("n").over(up_to).alias("nl"),
        F.sum("g").over(whole).alias("g"), F.sum("n").over(whole).alias("n"),
    )
    penalty, least = _per_task([t.boost.l2 for t in tasks]), _per_task([t.boost.least_rows for t in tasks])

    def score(g: Column, n: Column) -> Column:
        sum_ = g.cast("double") / UNIT
        return sum_ * sum_ / (n + penalty)

    gl, nl, g, n = (F.col(c) for c in ("gl", "nl", "g", "n"))
    enough = (nl >= least) & (n - nl >= least)
    cells = cells.withColumn("gain", F.when(enough, score(gl, nl) + score(g - gl, n - nl) - score(g, n)))
    cut = F.struct(F.col("gain"), (-F.col("place")).alias("order"), "gl", "nl")
    best = F.max(F.when(F.col("gain") > LEAST_GAIN, cut)).alias("best")
    return cells.groupBy(*group).agg(F.max("g").alias("g"), F.max("n").alias("n"), best)


def _as_arrays(nodes: DataFrame, value: Column, name: str, width: int, count: int, keys: list[str]) -> DataFrame:
    """One row per series: `value` of each task and node at task * width + node, else null."""
    pairs = nodes.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("task") * width + F.col("node"), value))).alias("held")
    )
    places = F.sequence(F.lit(0), F.lit(count * width - 1))
    return pairs.select(*keys, F.transform(places, lambda i: F.try_element_at("held", i)).alias(name))


def _walked(task: int, levels: int, width: int, bins: int) -> Column:
    """The node a row comes to by the cuts so far."""

    def step(node: Column, _: Column) -> Column:
        code = F.get("codes", task * width + node)
        right = F.get("bins", F.floor(code / bins).cast("int")) > code % bins
        return F.when(code.isNull(), node).otherwise(2 * node + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step) if levels else F.lit(1)


@dataclass
class Grown:
    """The trees of all tasks (a row per node) and the rows with their last predictions."""

    nodes: DataFrame
    bases: DataFrame
    rows: DataFrame


def grow(
    binned: DataFrame, tasks: list[Task], features: int, bins: int = BINS, test_rows: int = TEST_ROWS, keys: list[str] = SERIES
) -> Grown:
    """Grow the trees of all tasks, a level of all series and tasks in one pass.

    `nodes`: keys, task, tree, node (1 is the root, 2n and 2n + 1 below n), place (feature
    and bin of its cut) and gain, or value in units; `rows` carry `margins`, what each task
    predicts."""
    means = [F.avg(F.when(t.learns(test_rows), F.col("y"))) for t in tasks]
    margins = F.array(*[F.coalesce(F.round(m * UNIT).cast("long"), F.lit(0)) for m in means])
    bases = stage(binned.groupBy(*keys).agg(margins.alias("margins")), "boost-bases")
    rows = stage_by_series(binned.drop("edges").join(bases, keys), "boost-rows", keys)
    nodes: DataFrame | None = None
    for tree in range(max(t.boost.rounds for t in tasks)):
        active = [i for i, t in enumerate(tasks) if t.boost.rounds > tree]
        deepest = max(tasks[i].boost.levels for i in active)
        width = 2 ** (deepest + 1)
        cuts: DataFrame | None = None
        roots: DataFrame | None = None
        for level in range(deepest):
            live = [i for i in active if tasks[i].boost.levels > level]
            placed = rows if cuts is None else rows.join(_codes(cuts, width, len(tasks), keys), keys, "left")
            here = [
                F.when(tasks[i].learns(test_rows) & (w >= 2**level), w).otherwise(-1)
                for i, w in ((i, _walked(i, level if cuts is not None else 0, width, bins)) for i in live)
            ]
            gradients = [F.get("margins", F.lit(i)) - F.col("y") * UNIT for i in live]
            placed = placed.select(*keys, "bins", F.array(*here).alias("nodes"), F.array(*gradients).alias("gradients"))
            found = stage(_best_cuts(_histogram(placed, live, features, bins, keys), tasks, bins, keys), "boost-cuts")
            roots = found if roots is None else roots
            fresh = found.filter("best IS NOT NULL")
            cuts = fresh if cuts is None else cuts.unionByName(fresh)
        made = stage(_tree_nodes(roots, cuts, tasks, keys).withColumn("tree", F.lit(tree)), "boost-tree")
        nodes = made if nodes is None else nodes.unionByName(made)
        leaves = _as_arrays(made.filter("value IS NOT NULL"), F.col("value"), "leaves", width, len(tasks), keys)
        placed = rows.join(_codes(cuts, width, len(tasks), keys), keys, "left").join(leaves, keys, "left")
        moved = [
            F.get("margins", F.lit(i)) + F.coalesce(F.get("leaves", i * width + _walked(i, deepest, width, bins)), F.lit(0))
            for i in range(len(tasks))
        ]
        rows = stage_by_series(placed.withColumn("margins", F.array(*moved)).select(*rows.columns), "boost-rows", keys)
    each = bases.select(*keys, F.posexplode("margins").alias("task", "base"))
    return Grown(nodes, each, rows)


def _codes(cuts: DataFrame, width: int, count: int, keys: list[str]) -> DataFrame:
    return _as_arrays(cuts, (-F.col("best.order")).cast("int"), "codes", width, count, keys)


def _tree_nodes(roots: DataFrame, cuts: DataFrame, tasks: list[Task], keys: list[str]) -> DataFrame:
    """Every node of a tree: cut, or with the value it adds to a prediction."""
    group = [*keys, "task", "node"]
    left = F.struct((2 * F.col("node")).alias("node"), F.col("best.gl").alias("g"), F.col("best.nl").alias("n"))
    right = F.struct(
        (2 * F.col("node") + 1).alias("node"), (F.col("g") - F.col("best.gl")).alias("g"), (F.col("n") - F.col("best.nl")).alias("n")
    )
    children = cuts.select(*keys, "task", F.explode(F.array(left, right)).alias("child")).select(*keys, "task", "child.*")
    every = roots.select(*group, "g", "n").unionByName(children)
    cut = cuts.select(*group, (-F.col("best.order")).cast("int").alias("place"), F.col("best.gain").alias("gain"))
    rate, penalty = _per_task([t.boost.learning_rate for t in tasks]), _per_task([t.boost.l2 for t in tasks])
    value = F.round(rate * (-F.col("g")).cast("double") / (F.col("n") + penalty)).cast("long")
    joined = every.join(cut, group, "left")
    return joined.select(*group, "place", "gain", F.col("n").alias("rows"), F.when(F.col("place").isNull(), value).alias("value"))


def _named(grown: Grown, binned: DataFrame, features: list[str], bins: int, keys: list[str]) -> DataFrame:
    """The nodes with feature and cut (a value at or below goes left) in place of bins."""
    at = F.floor(F.col("place") / bins).cast("int")
    names = F.array(*[F.lit(f) for f in features])
    edges = binned.filter("edges IS NOT NULL").select(*keys, "edges")
    return grown.nodes.join(edges, keys).select(
        *keys, "task", "tree", "node", F.get(names, at).alias("feature"),
        F.get(F.get("edges", at), F.col("place") % bins).alias("cut"), "gain", "rows",
        (F.col("value").cast("double") / UNIT).alias("value"),
    )


def train_boosted(
    encoded: DataFrame, features: list[str], boost: Boost = Boost(), bins: int = BINS, keys: list[str] = SERIES
) -> tuple[DataFrame, DataFrame]:
    """Trees of every series (keys, tree, node, feature, cut, gain, rows, value) and their
    models: one row per series, its base and its trees as arrays of nodes."""
    binned = stage_by_series(bin_rows(encoded, features, bins, keys), "boost-binned", keys)
    grown = grow(binned, [Task(boost)], len(features), bins, keys=keys)
    trees = _named(grown, binned, features, bins, keys).drop("task")
    return trees, tree_models(trees, grown.bases.drop("task"), boost, keys)


def tree_models(trees: DataFrame, bases: DataFrame, boost: Boost, keys: list[str] = SERIES) -> DataFrame:
    """keys, base and trees: in each, node n stands at place n."""
    held = F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "cut", "value"))))
    places = F.sequence(F.lit(0), F.lit(2 ** (boost.levels + 1) - 1))
    as_array = F.transform(places, lambda i: F.try_element_at("held", i))
    each = trees.groupBy(*keys, "tree").agg(held.alias("held")).select(*keys, F.struct("tree", as_array.alias("nodes")).alias("one"))
    # A series has as many trees as rounds.
    listed = each.groupBy(*keys).agg(F.sort_array(F.collect_list("one")).alias("all"))
    base = bases.select(*keys, (F.col("base").cast("double") / UNIT).alias("base"))
    return base.join(listed, keys).select(*keys, "base", F.transform("all", lambda t: t["nodes"]).alias("trees"))


def aligned_trees(models: DataFrame, features: list[str], keys: list[str] = SERIES) -> DataFrame:
    """Models whose nodes name features by their place among `features`."""
    names = F.array(*[F.lit(f) for f in features])

    def placed(node: Column) -> Column:
        at = (F.array_position(names, node["feature"]) - 1).cast("int").alias("feature")
        return F.when(node.isNotNull(), F.struct(at, node["cut"].alias("cut"), node["value"].alias("value")))

    trees = F.transform("trees", lambda tree: F.transform(tree, placed))
    return models.select(*keys, F.col("base").alias("_base"), trees.alias("_trees"))


def tree_score(values: Column) -> Column:
    """What the aligned model of a row predicts from the array of its features' values."""

    def leaf(tree: Column, x: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            here = F.get(tree, node)
            right = F.coalesce(F.get(x, here["feature"]), F.lit(0.0)) > here["cut"]
            return F.when(here["feature"].isNull(), node).otherwise(2 * node + right.cast("int"))

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(DEEPEST)), F.lit(1), step))["value"]

    # The values are bound once: every tree reads them several times.
    bound = F.transform(F.array(values), lambda x: F.aggregate("_trees", F.col("_base"), lambda sum_, tree: sum_ + leaf(tree, x)))
    return F.get(bound, F.lit(0))


def search_boosted(
    encoded: DataFrame,
    features: list[str],
    candidates: list[Boost],
    folds: int = FOLDS,
    test_rows: int = TEST_ROWS,
    bins: int = BINS,
    keys: list[str] = SERIES,
) -> DataFrame:
    """Every candidate of every series on every fold, newest fold first: its parameters,
    `errors` (mean absolute error by fold; null where a fold has nothing to learn from),
    `mean_mae` and `rank` (1 is best; of equal errors the first given)."""
    binned = stage_by_series(bin_rows(encoded, features, bins, keys), "boost-binned", keys)
    tasks = [Task(c, fold) for c in candidates for fold in range(folds)]
    rows = grow(binned, tasks, len(features), bins, test_rows, keys).rows
    off = [F.abs(F.col("y") - F.get("margins", F.lit(i)).cast("double") / UNIT) for i in range(len(tasks))]
    errors = [F.avg(F.when(t.tests(test_rows), e)) for t, e in zip(tasks, off)]
    known = [F.max("recency") > (t.fold + 1) * test_rows for t in tasks]
    some = [F.when(k, e) for k, e in zip(known, errors)]
    by_candidate = [F.array(*some[i * folds : (i + 1) * folds]) for i in range(len(candidates))]
    wide = rows.groupBy(*keys).agg(F.array(*by_candidate).alias("all")).select(*keys, F.posexplode("all").alias("candidate", "errors"))
    told = F.filter("errors", lambda e: e.isNotNull())
    mean = F.aggregate(told, F.lit(0.0), lambda a, e: a + e) / F.nullif(F.size(told), F.lit(0))
    best = W.partitionBy(*keys).orderBy(F.col("mean_mae").asc_nulls_last(), "candidate")
    said = {
        name: F.get(F.array(*[F.lit(getattr(c, name)) for c in candidates]), F.col("candidate"))
        for name in ("learning_rate", "rounds", "depth", "l2")
    }
    scored = wide.select(*keys, "candidate", *[c.alias(n) for n, c in said.items()], "errors", F.round(mean, 9).alias("mean_mae"))
    return scored.withColumn("rank", F.row_number().over(best))
