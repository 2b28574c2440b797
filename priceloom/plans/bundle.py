"""A trained program as one versioned folder, to score with in other sessions.

``<path>/v000001`` holds the program as JSON (column plan, recipe, inputs), the
fitted pipeline, and the tables of its encoders as Parquet. The version's commit
marker is written last; a version without it does not exist for readers. Saving
again makes the next version, and readers keep what they have loaded."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from priceloom.operators.encode import FoldMeans, TargetMeans
from priceloom.operators.schema import ColumnPlan
from priceloom.plans.boosting import Booster
from priceloom.plans.recipes import Encoders, Fitted, Program, Recipe
from priceloom.sources import folders
from priceloom.sources.writers import load_model, save_model

FORMAT = 1
MARKER = "_COMMITTED"


class NoBundle(RuntimeError):
    """There is no committed version to load."""


def _name(version: int) -> str:
    return f"v{version:06d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, oldest first."""
    found = [n for n in folders.names_in(spark, path) if n[:1] == "v" and n[1:].isdigit()]
    return [int(n[1:]) for n in found if folders.exists(spark, f"{path}/{n}/{MARKER}")]


def _claim(spark: SparkSession, path: str) -> int:
    """The next version, which no other writer has."""
    taken = [int(n[1:]) for n in folders.names_in(spark, path) if n[:1] == "v" and n[1:].isdigit()]
    version = max(taken, default=0) + 1
    while not folders.create_text(spark, f"{path}/{_name(version)}/_CLAIMED", ""):
        version += 1
    return version


def save(fitted: Fitted | Program, path: str) -> int:
    """Write the program under ``path`` and return its version."""
    program = fitted.program if isinstance(fitted, Fitted) else fitted
    spark = SparkSession.active()
    path = path.rstrip("/")
    version = _claim(spark, path)
    place = f"{path}/{_name(version)}"
    encoders = program.encoders
    tables = {f"ranks/{i}": t for i, t in enumerate(encoders.ranks.values())}
    tables |= {f"means/{i}": m.sums for i, m in enumerate(encoders.means.values())}
    tables |= {f"fold_means/{i}": m.sums for i, m in enumerate(encoders.fold_means.values())}
    for name, table in tables.items():
        table.write.parquet(f"{place}/{name}")
    save_model(program.model, f"{place}/model")
    text = {
        "format": FORMAT,
        "plan": asdict(program.plan),
        "recipe": asdict(program.recipe),
        "numeric": program.numeric,
        "encodings": program.encodings,
        "max_arity": encoders.max_arity,
        "ranks": list(encoders.ranks),
        "means": [(c, m.smoothing) for c, m in encoders.means.items()],
        "fold_means": [(c, m.smoothing) for c, m in encoders.fold_means.items()],
    }
    folders.create_text(spark, f"{place}/program.json", json.dumps(text, indent=1))
    folders.create_text(spark, f"{place}/{MARKER}", "")
    return version


def _tuples(value):
    return tuple(_tuples(v) for v in value) if isinstance(value, list) else value


def load(spark: SparkSession, path: str, version: int | None = None) -> Program:
    """The latest committed version under ``path``, or the one asked for."""
    path = path.rstrip("/")
    there = versions(spark, path)
    if not there or (version is not None and version not in there):
        raise NoBundle(f"no committed version {version or ''} under {path}; there are {there}")
    place = f"{path}/{_name(version or there[-1])}"
    text = json.loads(folders.read_text(spark, f"{place}/program.json"))
    if text["format"] > FORMAT:
        raise NoBundle(f"{place} has format {text['format']}, newer than {FORMAT}")
    read = spark.read.parquet
    model = load_model(f"{place}/model")
    encoders = Encoders(
        stages=tuple(model.stages[: -2]),
        ranks={c: read(f"{place}/ranks/{i}") for i, c in enumerate(text["ranks"])},
        means={c: TargetMeans(read(f"{place}/means/{i}"), s) for i, (c, s) in enumerate(text["means"])},
        fold_means={c: FoldMeans(read(f"{place}/fold_means/{i}"), s) for i, (c, s) in enumerate(text["fold_means"])},
        max_arity=text["max_arity"],
    )
    recipe = {k: _tuples(v) for k, v in text["recipe"].items() if k != "booster"}
    return Program(
        plan=ColumnPlan(**{k: _tuples(v) for k, v in text["plan"].items()}),
        recipe=Recipe(booster=Booster(**text["recipe"]["booster"]), **recipe),
        numeric=_tuples(text["numeric"]),
        encodings=_tuples(text["encodings"]),
        encoders=encoders,
        model=model,
    )
