"""Categories to numbers: frequency index, smoothed target mean, and the mean
over the other folds.

All build a table with one row per label by a partially aggregated groupBy, so
a label that holds a third of all rows is folded up before the shuffle. Bounded
label sets become Spark ML indexer stages; any larger set goes through
:func:`frequency_index` and :func:`attach`, which give the same numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions import is_number
from priceloom.operators.ranking import global_rank
from priceloom.sources.scratch import checkpointed, written

# Most labels a nominal column may have unless the caller says otherwise: its
# label array lives on the driver and its arity sets the trees' bin count.
MAX_NOMINAL_LABELS = 1000
NOMINAL, RANK, TARGET_MEAN, FOLD_MEAN = "nominal", "rank", "target_mean", "fold_mean"
ENCODINGS = (NOMINAL, RANK, TARGET_MEAN, FOLD_MEAN)
# Largest label table that is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A label is hot when it holds at least 1/HOT_SHARE of the rows, so there are
# never more than HOT_SHARE hot labels.
HOT_SHARE = 1000


def indexed_name(column: str) -> str:
    return f"{column}_indexed"


def output_name(column: str, encoding: str) -> str:
    """The model input that an encoded column becomes."""
    return f"{column}_mean" if encoding in (TARGET_MEAN, FOLD_MEAN) else indexed_name(column)


def label_counts(df: DataFrame, column: str) -> DataFrame:
    """(label, n) for the non-null labels."""
    label = F.col(column).alias("label")
    return df.filter(F.col(column).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def pair_counts(df: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """(by..., at, label, n) for the non-null labels of all columns in one pass:
    every row turns into its (column number, label) pairs, which are counted
    map-side, so a task sends one row per distinct label."""
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).alias("label")) for i, c in enumerate(columns)])
    rows = df.select(*by, F.inline(pairs)).filter(F.col("label").isNotNull())
    return rows.groupBy(*by, "at", "label").agg(F.count("*").alias("n"))


def check_label_counts(counts: DataFrame, columns: Sequence[str], limit: int) -> None:
    """Raise when a column has more than ``limit`` labels; nothing is cut."""
    for row in counts.groupBy("at").agg(F.countDistinct("label").alias("labels")).orderBy("at").collect():
        if row["labels"] > limit:
            raise ValueError(
                f"column {columns[row['at']]!r} has {row['labels']} labels in the training rows, more than the "
                f"{limit} a nominal column may have: raise max_labels, or encode it as {RANK!r} or {TARGET_MEAN!r}"
            )


def stage_labels(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_NOMINAL_LABELS
) -> dict[str, list[str]]:
    """Labels per column, most frequent first, equal counts in label order.

    Counted in one pass and stored, so that the number of labels is checked
    against ``limit`` before any of them comes to the driver."""
    counts = checkpointed(pair_counts(df, columns))
    check_label_counts(counts, columns, limit)
    return _sorted_labels(counts, columns)


def _sorted_labels(counts: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in counts.orderBy("at", F.desc("n"), "label").collect():
        labels[columns[row["at"]]].append(row["label"])
    return labels


def fold_labels(
    df: DataFrame, columns: Sequence[str], fold: str, limit: int = MAX_NOMINAL_LABELS
) -> dict[int, dict[str, list[str]]]:
    """For each fold the labels of the rows outside it, from one pass: counts
    per (fold, column, label), and a fold's own taken from the total."""
    counts = checkpointed(pair_counts(df, columns, fold).withColumnRenamed(fold, "part"))
    check_label_counts(counts, columns, limit)
    folds = [r["part"] for r in counts.select("part").distinct().collect()]
    total = counts.groupBy("at", "label").agg(F.sum("n").alias("n"))
    out = {}
    for k in folds:
        own = counts.filter(F.col("part") == k).select("at", "label", F.col("n").alias("own"))
        rest = total.join(own, ["at", "label"], "left").withColumn("n", F.col("n") - F.coalesce("own", F.lit(0)))
        out[k] = _sorted_labels(rest.filter("n > 0"), columns)
    return out


def indexers(labels: dict[str, list[str]]) -> list[StringIndexerModel]:
    """Indexer stages from label lists; null and unseen labels share the index
    after the last."""
    return [
        StringIndexerModel.from_labels(found, column, indexed_name(column), handleInvalid="keep")
        for column, found in labels.items()
    ]


def fit_indexers(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_NOMINAL_LABELS
) -> list[StringIndexerModel]:
    """One fitted indexer stage per column. The same models as fitting
    StringIndexer, whose fit sends every task's label table to a single task."""
    return indexers(stage_labels(df, columns, limit)) if columns else []


def index_categories(df: DataFrame, indexers: Sequence[StringIndexerModel]) -> DataFrame:
    for indexer in indexers:
        df = indexer.transform(df)
    return df


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(label, n, index): the StringIndexer numbering for any label count."""
    ranked = global_rank(label_counts(df, column), F.desc("n"), F.asc("label"), rank="index")
    return ranked.withColumn("index", F.col("index").cast("double"))


def attach(df: DataFrame, labels: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join a label table onto ``df``; null and unknown labels get nulls.

    ``labels`` has one row per ``label`` and should be cheap to read again. Up
    to ``limit`` bytes it is broadcast. A larger one is shuffled, but not for
    the hot labels of ``df``: those number at most HOT_SHARE by definition, so
    their part of the table is broadcast and their rows stay where they are.
    What is shuffled has no key above 1/HOT_SHARE of the rows."""
    added = [c for c in labels.columns if c != "label"]
    columns = [*df.columns, *added]
    lookup = labels.withColumnRenamed("label", column)
    width = F.octet_length("label") + F.lit(16 * len(labels.columns))
    size = labels.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    if size <= limit:
        return df.join(F.broadcast(lookup), column, "left").select(*columns)

    counts = checkpointed(label_counts(df, column).withColumnRenamed("label", column))
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.filter(F.col("n") * F.lit(HOT_SHARE) >= total).select(column)
    hot_lookup = hot.join(lookup, column, "left")

    frequent = df.join(F.broadcast(hot_lookup), column, "inner").select(*columns)
    others = df.join(F.broadcast(hot), column, "left_anti")
    rare = others.filter(F.col(column).isNotNull()).join(lookup, column, "left").select(*columns)
    blank = [F.lit(None).cast(labels.schema[c].dataType).alias(c) for c in added]
    unknown = df.filter(F.col(column).isNull()).select(*df.columns, *blank)
    return frequent.unionByName(rare).unionByName(unknown)


def apply_index(df: DataFrame, index: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``<column>_indexed`` from a :func:`frequency_index` table."""
    spare = index.agg(F.count("*").cast("double").alias("spare")).scalar()
    output = indexed_name(column)
    joined = attach(df, index.select("label", F.col("index").alias(output)), column, limit)
    return joined.withColumn(output, F.coalesce(F.col(output), spare))


@dataclass(frozen=True)
class TargetMeans:
    """A fitted target encoding. ``sums`` holds (label, n, total), one row per
    label and one for null, stored when it was fitted."""

    sums: DataFrame
    smoothing: float

    @property
    def overall(self) -> Column:
        """Mean target of all fitted rows, folded from the label sums."""
        return self.sums.agg(F.try_divide(F.sum("total"), F.sum("n"))).scalar()

    @property
    def table(self) -> DataFrame:
        """(label, n, encoded) for the non-null labels."""
        weight = F.lit(float(self.smoothing))
        pulled = F.col("total") + weight * self.overall
        labels = self.sums.filter(F.col("label").isNotNull())
        return labels.select("label", "n", F.try_divide(pulled, F.col("n") + weight).alias("encoded"))


def target_means(df: DataFrame, column: str, label: str, smoothing: float = 10.0) -> TargetMeans:
    """Mean target per category, pulled towards the overall mean by
    ``smoothing`` pseudo-rows. Fit it on training rows."""
    sums = (
        df.filter(is_number(label))
        .groupBy(F.col(column).alias("label"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("total"))
    )
    return TargetMeans(checkpointed(sums), smoothing)


def apply_target_means(
    df: DataFrame, means: TargetMeans, column: str, output: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``output``; null and unseen categories get the overall mean."""
    joined = attach(df, means.table.select("label", F.col("encoded").alias(output)), column, limit)
    return joined.withColumn(output, F.coalesce(F.col(output), means.overall))


@dataclass(frozen=True)
class FoldMeans:
    """A fitted target encoding that a training row's own fold has no part in.
    ``sums`` holds (label, part, n, total), one row per label and fold, stored
    when it was fitted: a fold's own sums are taken from a label's, so no fold
    is read again."""

    sums: DataFrame
    smoothing: float

    @cached_property
    def parts(self) -> list[tuple[int, int, float]]:
        """(fold, n, total) over all labels, one row per fold."""
        totals = self.sums.groupBy("part").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        return [tuple(r) for r in totals.orderBy("part").collect()]

    @property
    def table(self) -> DataFrame:
        """(label, value) for the non-null labels: n and total over all folds,
        then those of each fold."""
        own = [
            F.coalesce(F.sum(F.when(F.col("part") == part, F.col(c))), F.lit(0)).cast("double")
            for part, _, _ in self.parts
            for c in ("n", "total")
        ]
        every = [F.sum(c).cast("double") for c in ("n", "total")]
        labels = self.sums.filter(F.col("label").isNotNull())
        return labels.groupBy("label").agg(F.array(*every, *own).alias("value"))

    def encoded(self, value: Column, fold: str | None = None) -> Column:
        """The mean that ``value`` of the table stands for; with ``fold``, the
        column of a row's fold, over the rows outside it. Labels that do not
        occur there get the mean of those rows."""
        n, total = sum(p[1] for p in self.parts), sum(p[2] for p in self.parts)
        place = F.array_position(F.lit([p[0] for p in self.parts]), F.col(fold)) if fold else F.lit(0)

        def rest(i: int, whole: float, own: list) -> tuple[Column, Column]:
            """Of the label and of all rows, without the own fold's."""
            at_own = F.coalesce(F.get(value, (place * 2 + i).cast("int")), F.lit(0.0))
            of_label = F.coalesce(F.get(value, F.lit(i)), F.lit(0.0)) - (F.when(place > 0, at_own).otherwise(0.0))
            outside = F.array(*[F.lit(float(whole - x)) for x in [0, *own]])
            return of_label, F.get(outside, place.cast("int"))

        label_n, all_n = rest(0, n, [p[1] for p in self.parts])
        label_total, all_total = rest(1, total, [p[2] for p in self.parts])
        overall, weight = F.try_divide(all_total, all_n), F.lit(float(self.smoothing))
        return F.when(label_n > 0.5, (label_total + weight * overall) / (label_n + weight)).otherwise(overall)


def fold_means(df: DataFrame, column: str, label: str, fold: str, smoothing: float = 10.0) -> FoldMeans:
    """Sums of ``label`` per (category, fold) in one pass over training rows."""
    sums = (
        df.filter(is_number(label))
        .groupBy(F.col(column).alias("label"), F.col(fold).alias("part"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("total"))
    )
    return FoldMeans(checkpointed(sums), smoothing)


@dataclass(frozen=True)
class Lookup:
    """One encoded column: ``table`` has (label, value), an array of double, and
    ``finish`` makes the output of a row's value, null if it has none."""

    column: str
    table: DataFrame
    output: str
    finish: Callable[[Column], Column]


def index_lookup(index: DataFrame, column: str) -> Lookup:
    spare = index.agg(F.count("*").cast("double").alias("spare")).scalar()
    table = index.select("label", F.array(F.col("index").cast("double")).alias("value"))
    return Lookup(column, table, output_name(column, RANK), lambda v: F.coalesce(F.get(v, F.lit(0)), spare))


def mean_lookup(means: TargetMeans, column: str) -> Lookup:
    table = means.table.select("label", F.array("encoded").alias("value"))
    return Lookup(column, table, output_name(column, TARGET_MEAN), lambda v: F.coalesce(F.get(v, F.lit(0)), means.overall))


def fold_mean_lookup(means: FoldMeans, column: str, fold: str | None) -> Lookup:
    return Lookup(column, means.table, output_name(column, FOLD_MEAN), lambda v: means.encoded(v, fold))


def attach_many(
    df: DataFrame, lookups: Sequence[Lookup], limit: int = BROADCAST_BYTES, owned: list[str] | None = None
) -> DataFrame:
    """Add the outputs of all lookups.

    Tables up to ``limit`` bytes together are broadcast. If two or more are left,
    the rows are stored once under a number, and turned into narrow (row, column
    number, label) rows that meet all tables in one shuffle: hot ones, at most
    HOT_SHARE of them, by broadcast where they are, and no other holds more than
    1/HOT_SHARE. The values go back by row number. So the rows themselves move
    once, however many columns are looked up. ``owned`` takes what is stored."""
    if not lookups:
        return df
    every = None
    for i, lookup in enumerate(lookups):
        part = lookup.table.select(F.lit(i).alias("at"), "label", "value")
        every = part if every is None else every.unionByName(part)
    width = F.octet_length("label") + F.lit(8) * F.size("value") + F.lit(32)
    sizes = {r["at"]: r["bytes"] for r in every.groupBy("at").agg(F.sum(width).alias("bytes")).collect()}
    values, wide, room = {}, [], limit
    for i in sorted(range(len(lookups)), key=lambda i: sizes.get(i, 0)):
        room -= sizes.get(i, 0)
        if room < 0:
            wide.append(i)
    out = df
    taken = {c.lower() for c in df.columns}
    names = {i: _unused(taken, f"value_{i}") for i in range(len(lookups))}
    for i, lookup in enumerate(lookups):
        named = lookup.table.select("label", F.col("value").alias(names[i]))
        if i not in wide:
            out = attach(out, named, lookup.column, limit)
        elif len(wide) == 1:
            out = attach(out, named, lookup.column, 0)
    if len(wide) > 1:
        out = _attach_wide(out, {i: lookups[i] for i in wide}, every.filter(F.col("at").isin(wide)), names, owned)
    for i, lookup in enumerate(lookups):
        values[lookup.output] = lookup.finish(F.col(names[i]))
    return out.select(*df.columns, *[v.alias(c) for c, v in values.items()])


def _unused(taken: set[str], stem: str) -> str:
    while stem.lower() in taken:
        stem += "_"
    taken.add(stem.lower())
    return stem


def _attach_wide(df: DataFrame, lookups: dict[int, Lookup], tables: DataFrame, names: dict[int, str], owned: list[str] | None) -> DataFrame:
    row = _unused({c.lower() for c in df.columns}, "row_number")
    stored = written(df.withColumn(row, F.monotonically_increasing_id()), "numbered", owned)
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(k.column).alias("label")) for i, k in lookups.items()])
    asked = stored.select(F.col(row).alias("row"), F.inline(pairs)).filter(F.col("label").isNotNull())
    counts = checkpointed(asked.groupBy("at", "label").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.filter(F.col("n") * F.lit(HOT_SHARE) >= total).select("at", "label")
    frequent = asked.join(F.broadcast(tables.join(F.broadcast(hot), ["at", "label"])), ["at", "label"])
    rare = asked.join(F.broadcast(hot), ["at", "label"], "left_anti").join(tables, ["at", "label"], "left")
    columns = ("row", "at", "value")
    found = frequent.select(*columns).unionByName(rare.select(*columns))
    back = found.groupBy("row").agg(*[F.max(F.when(F.col("at") == i, F.col("value"))).alias(names[i]) for i in lookups])
    return stored.join(back.withColumnRenamed("row", row), row, "left").drop(row)
