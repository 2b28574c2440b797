"""End-to-end training: prepare -> fit -> score -> evaluate.

A :class:`Recipe` says which optional steps run. Preparation makes one pass for
the statistics and one for the prepared rows, which are stored once and shared
by every later pass (indexing, tree building, scoring)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.functions import is_number
from priceloom.operators import clean, encode, features, metrics, permutation, split
from priceloom.operators.schema import LOG_TARGET, TARGET, ColumnPlan, plan_columns
from priceloom.plans.boosting import BASIC, FEATURES, OPTIMIZED, Booster, assembler, feature_importances
from priceloom.plans.phases import Watch, unwatched
from priceloom.sources.scratch import discard, ensure_checkpoint_dir, written

# Columns the program adds under fixed names; an input may not bring its own.
RESERVED = {split.SPLIT, split.FOLD, FEATURES, metrics.PREDICTION, metrics.EXP_PREDICTION}
#: Most rows in a partition of prepared rows that no recipe lays out.
ROWS_PER_PARTITION = 250_000

@dataclass(frozen=True)
class Recipe:
    """Which steps a training program runs.

    ``outlier_stats`` is where the outlier bounds come from: ``all`` rows, only
    the ``train`` rows, or None for no filter. ``folds`` is how many parts the
    training rows fall into for cross-validation. ``storage`` is how the prepared
    rows are kept between passes: ``persist`` (executor memory and disk) or
    ``table`` (Parquet in the shared folder, for more rows than executors hold
    and for jobs that must not recompute after losing one).

    ``encodings`` says how string columns enter the model, as (column, encoding)
    pairs: ``nominal`` (the default for columns not named), ``rank`` (an ordered
    number, any label count), ``target_mean`` (smoothed mean of the log
    target) or ``fold_mean`` (the same, for a training row over the training rows
    of the other folds, so that no row sees its own label). A nominal column with
    more than ``max_labels`` labels raises.

    ``train_partitions`` fixes the layout of the prepared rows: so many
    partitions by hash of the row key, sorted by it. Boosting draws its row
    subsample per partition, so with a subsampling rate below 1 the model
    depends on the layout; None keeps that of the scan, without a shuffle, for
    such a booster, and spreads the rows by key over partitions of bounded
    size for one that takes every row."""

    name: str
    booster: Booster
    fill_nulls: bool
    outlier_stats: str | None
    derive_features: bool
    train_percent: int = split.TRAIN_PERCENT
    folds: int = split.FOLDS
    max_labels: int = encode.MAX_NOMINAL_LABELS
    encodings: tuple[tuple[str, str], ...] = ()
    train_partitions: int | None = None
    storage: str = "persist"

    def with_(self, **changes) -> Recipe:
        return replace(self, **changes)


# The three programs: plain, cleaned and enriched, and tuned by grid search.
BASIC_RECIPE = Recipe("basic", BASIC, fill_nulls=False, outlier_stats=None, derive_features=False)
OPTIMIZED_RECIPE = Recipe("optimized", OPTIMIZED, fill_nulls=True, outlier_stats="all", derive_features=True)
TUNED_RECIPE = Recipe("tuned", BASIC, fill_nulls=True, outlier_stats=None, derive_features=False)
RECIPES = {r.name: r for r in (BASIC_RECIPE, OPTIMIZED_RECIPE, TUNED_RECIPE)}


@dataclass(frozen=True)
class Prepared:
    """Stored rows with split and fold columns, ready for any number of fits."""

    frame: DataFrame
    plan: ColumnPlan
    recipe: Recipe
    numeric: tuple[str, ...]
    encodings: tuple[tuple[str, str], ...]
    n_rows: int
    n_columns: int
    n_unlabelled: int
    owned: list[str] = field(default_factory=list, compare=False)

    def encoded_as(self, kind: str) -> list[str]:
        return [c for c, encoding in self.encodings if encoding == kind]

    @property
    def train(self) -> DataFrame:
        return self.frame.filter(F.col(split.SPLIT) == "train")

    @property
    def test(self) -> DataFrame:
        return self.frame.filter(F.col(split.SPLIT) == "test")

    @property
    def inputs(self) -> list[str]:
        """Model inputs: numeric features, then the encoded categories in
        schema order."""
        return [*self.numeric, *[encode.output_name(c, kind) for c, kind in self.encodings]]

    def fit_columns(self, df: DataFrame) -> DataFrame:
        """Only what a fit reads, before rows are stored for it."""
        folded = [split.FOLD] if self.encoded_as(encode.FOLD_MEAN) else []
        return df.select(*self.numeric, *self.plan.categorical, LOG_TARGET, *folded)

    def fold_columns(self, df: DataFrame) -> DataFrame:
        """The same and each row's fold: what a search reads."""
        return df.select(*self.numeric, *self.plan.categorical, LOG_TARGET, split.FOLD)

    def release(self) -> None:
        """Give up the stored rows and everything written for fits on them."""
        if self.recipe.storage == "persist":
            self.frame.unpersist()
        discard(self.frame.sparkSession, self.owned)


def _profile(df: DataFrame, plan: ColumnPlan, recipe: Recipe):
    """One row of statistics in one pass: row counts, label mean and standard
    deviation."""
    label = F.when(is_number(LOG_TARGET), F.col(LOG_TARGET))
    fitted = F.when(F.col(split.SPLIT) == "train", label) if recipe.outlier_stats == "train" else label
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(label).alias("n_labelled"),
        F.mean(fitted).alias("mean"),
        F.stddev_samp(fitted).alias("stddev"),
    ).first()


def _laid_out(df: DataFrame, partitions: int | None, key: Sequence[str]) -> DataFrame:
    """The rows in the recipe's layout. It depends on the rows and on
    ``partitions`` alone, and a partition that is computed again after a lost
    executor comes back in the same order, as boosting needs. Rows of one key
    are ordered by all their values."""
    if partitions is None:
        return df
    return df.repartition(partitions, *key).sortWithinPartitions(*key, F.xxhash64(*df.columns))


def _partitions(recipe: Recipe, n_rows: int) -> int | None:
    """The recipe's layout. Without one, a booster that takes every row grows
    the same trees in any layout, so the rows are spread by key over partitions
    of at most ROWS_PER_PARTITION: every pass of a fit reads a whole partition."""
    if recipe.train_partitions is not None or recipe.booster.subsampling_rate < 1:
        return recipe.train_partitions
    return max(1, -(-n_rows // ROWS_PER_PARTITION))


def _encodings(plan: ColumnPlan, recipe: Recipe) -> tuple[tuple[str, str], ...]:
    """(column, encoding) of every categorical column, in schema order."""
    chosen = dict(recipe.encodings)
    unknown = sorted(set(chosen) - set(plan.categorical)) + sorted(set(chosen.values()) - set(encode.ENCODINGS))
    if unknown:
        raise ValueError(f"encodings name no categorical column or no encoding: {unknown}")
    return tuple((c, chosen.get(c, encode.NOMINAL)) for c in plan.categorical)


def _check_names(df: DataFrame, used: Sequence[str], plan: ColumnPlan, numeric: Sequence[str], encodings) -> None:
    """Columns that the program adds may not meet an input of that name."""
    encoded = {encode.output_name(c, kind) for c, kind in encodings}
    taken = (RESERVED | encoded) & set(used)
    taken |= {c for c in numeric if c in plan.categorical or c in plan.row_key or c == plan.target}
    if taken:
        raise ValueError(f"rename these input columns, the program adds columns of that name: {sorted(taken)}")


def featurize(df: DataFrame, plan: ColumnPlan, recipe: Recipe) -> tuple[DataFrame, list[str]]:
    """The row-wise steps: booleans to numbers, null fill, derived features.
    Returns the rows and the numeric feature names."""
    df = clean.booleans_as_numbers(df, plan)
    if recipe.fill_nulls:
        df = clean.fill_nulls(df, plan.numeric)
    if not recipe.derive_features:
        return df, list(plan.numeric)
    return features.derive(df, plan.numeric)


def prepare(
    df: DataFrame,
    recipe: Recipe,
    target: str = TARGET,
    row_key: Sequence[str] = (),
) -> Prepared:
    """Plan the columns, clean, derive, split, and store the result.

    ``row_key`` names integer or string columns that identify a row; they drive
    the split and the folds and are no features. Without one the whole row is
    hashed, so only exact copies are sure to stay on one side."""
    plan = plan_columns(df.schema, target, row_key)
    used = list(dict.fromkeys([*row_key, plan.target, *plan.numeric, *plan.categorical]))
    encodings = _encodings(plan, recipe)
    made = features.derive(df, plan.numeric)[1] if recipe.derive_features else plan.numeric
    _check_names(df, used, plan, made, encodings)
    key = list(row_key) or used
    rows = (
        df.select(*used)
        .transform(split.with_split, key, recipe.train_percent)
        .transform(split.with_fold, key, recipe.folds)
        .transform(clean.with_log_target, plan.target)
    )
    stats = _profile(rows, plan, recipe)

    rows = clean.drop_unlabelled(rows)
    if recipe.outlier_stats and stats["stddev"] is not None:
        width = clean.SIGMAS * stats["stddev"]
        lower, upper = stats["mean"] - width, stats["mean"] + width
        rows = rows.filter(clean.inside(LOG_TARGET, F.lit(lower), F.lit(upper)))
    rows = _laid_out(rows, _partitions(recipe, stats["n_rows"]), key)
    rows, numeric = featurize(rows, plan, recipe)

    owned: list[str] = []
    if recipe.storage == "table":
        rows = written(rows, "prepared", owned)
    else:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(
        frame=rows,
        plan=plan,
        recipe=recipe,
        numeric=tuple(numeric),
        encodings=encodings,
        n_rows=stats["n_rows"],
        n_columns=len(df.columns),
        n_unlabelled=stats["n_rows"] - stats["n_labelled"],
        owned=owned,
    )


@dataclass(frozen=True)
class Encoders:
    """Category encoders fitted on one set of training rows: model stages for
    nominal columns, tables for ranks and target means."""

    stages: tuple
    ranks: dict[str, DataFrame]
    means: dict[str, encode.TargetMeans]
    max_arity: int
    fold_means: dict[str, encode.FoldMeans] = field(default_factory=dict)

    def widen(self, df: DataFrame, owned: list[str] | None = None, training: bool = False) -> DataFrame:
        """Add the columns that come from tables. With ``owned`` the rows are
        written to the shared folder, as a fit reads them several times, always
        in the same order; whoever owns the list discards them. ``training``
        says that these are rows the encoders were fitted on."""
        lookups = [encode.index_lookup(table, c) for c, table in self.ranks.items()]
        lookups += [encode.mean_lookup(means, c) for c, means in self.means.items()]
        fold = split.FOLD if training else None
        lookups += [encode.fold_mean_lookup(means, c, fold) for c, means in self.fold_means.items()]
        if not lookups:
            return df
        df = encode.attach_many(df, lookups, owned=owned)
        return written(df, "widened", owned) if owned is not None else df


def fit_encoders(prepared: Prepared, train: DataFrame, labels: dict[str, list[str]] | None = None) -> Encoders:
    """Fit all encoders on ``train``. Nominal columns are counted in one pass,
    unless their ``labels`` are known."""
    nominal = prepared.encoded_as(encode.NOMINAL)
    if labels is None:
        stages = tuple(encode.fit_indexers(train, nominal, prepared.recipe.max_labels))
    else:
        stages = tuple(encode.indexers(labels))
    arity = max((1 + len(stage.labels) for stage in stages), default=0)
    ranks = {c: encode.frequency_index(train, c) for c in prepared.encoded_as(encode.RANK)}
    means = {c: encode.target_means(train, c, LOG_TARGET) for c in prepared.encoded_as(encode.TARGET_MEAN)}
    folded = {c: encode.fold_means(train, c, LOG_TARGET, split.FOLD) for c in prepared.encoded_as(encode.FOLD_MEAN)}
    return Encoders(stages, ranks, means, arity, folded)


@dataclass(frozen=True)
class Program:
    """A trained program without the rows it was trained on: what scoring
    needs, and what ``bundle`` saves."""

    plan: ColumnPlan
    recipe: Recipe
    numeric: tuple[str, ...]
    encodings: tuple[tuple[str, str], ...]
    encoders: Encoders
    model: PipelineModel

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[encode.output_name(c, kind) for c, kind in self.encodings]]

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (log scale) and ``exp_prediction`` (price)."""
        scored = self.model.transform(self.encoders.widen(df))
        return metrics.with_exp_prediction(scored)

    def estimate(self, listings: DataFrame) -> DataFrame:
        """Score listings as they come, with or without a known price: the
        row-wise preparation is applied first, and no row counts as outlier."""
        prepared, _ = featurize(listings, self.plan, self.recipe)
        return self.score(prepared)

    def importances(self, spark: SparkSession) -> DataFrame:
        return feature_importances(spark, self.model, self.inputs)


@dataclass(frozen=True)
class Fitted:
    """A trained program with its prepared rows."""

    prepared: Prepared
    encoders: Encoders
    model: PipelineModel

    @property
    def program(self) -> Program:
        p = self.prepared
        return Program(p.plan, p.recipe, p.numeric, p.encodings, self.encoders, self.model)

    def score(self, df: DataFrame) -> DataFrame:
        return self.program.score(df)

    def estimate(self, listings: DataFrame) -> DataFrame:
        return self.program.estimate(listings)

    def importances(self) -> DataFrame:
        return self.program.importances(self.prepared.frame.sparkSession)

    def permutation_importances(self, df: DataFrame, block_rows: int = permutation.BLOCK_ROWS) -> DataFrame:
        """How much the error on ``df`` grows when a column's values are dealt
        to other rows, for every numeric and categorical column."""
        prepared = self.prepared
        columns = [*prepared.numeric, *prepared.plan.categorical]
        key = list(prepared.plan.row_key) or [prepared.plan.target, *columns]
        return permutation.permutation_importance(df, key, columns, LOG_TARGET, self.score, block_rows)

    def evaluate(self, df: DataFrame) -> DataFrame:
        """All scores over ``df`` from a single scoring pass."""
        count = len(self.prepared.numeric) + len(self.prepared.plan.categorical)
        return metrics.all_metrics(self.score(df), self.prepared.plan.target, count)


def fit(prepared: Prepared, booster: Booster | None = None, watch: Watch = unwatched) -> Fitted:
    """Fit encoders, assembler and boosted trees on the training rows."""
    ensure_checkpoint_dir(prepared.frame.sparkSession)
    with watch("encode"):
        encoders = fit_encoders(prepared, prepared.train)
        train = encoders.widen(prepared.fit_columns(prepared.train), prepared.owned, training=True)
    trees = (booster or prepared.recipe.booster).estimator(max_arity=encoders.max_arity)
    pipeline = Pipeline(stages=[*encoders.stages, assembler(prepared.inputs), trees])
    with watch("fit"):
        return Fitted(prepared, encoders, pipeline.fit(train))


def vectors(
    prepared: Prepared, encoders: Encoders, df: DataFrame, owned: list[str] | None = None, training: bool = False
) -> DataFrame:
    """``df`` with its ``features`` vector, before any model is fitted.
    ``training`` says that the encoders were fitted on these rows."""
    encoded = encode.index_categories(encoders.widen(df, owned, training), encoders.stages)
    return assembler(prepared.inputs).transform(encoded)


__all__ = [
    "BASIC_RECIPE",
    "FEATURES",
    "OPTIMIZED_RECIPE",
    "RECIPES",
    "TUNED_RECIPE",
    "Encoders",
    "Fitted",
    "Prepared",
    "Program",
    "Recipe",
    "featurize",
    "fit",
    "fit_encoders",
    "prepare",
    "vectors",
]
