"""Run a training program from spark-submit or ``python -m priceloom``.

    python -m priceloom --recipe optimized --input hdfs://nn/data.csv --input /data/data.csv
"""

from __future__ import annotations

import argparse

from priceloom import session
from priceloom.operators.schema import TARGET
from priceloom.plans import report
from priceloom.plans.ledger import Ledger
from priceloom.plans.recipes import RECIPES
from priceloom.plans.tuning import GRID
from priceloom.sources import read_first, read_quarantined, write_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="priceloom", description=__doc__.splitlines()[0])
    parser.add_argument("--recipe", choices=sorted(RECIPES), default="optimized")
    parser.add_argument("--input", action="append", required=True, help="candidate path; repeat for fallbacks")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--schema", help="DDL schema; without it CSV types are inferred")
    parser.add_argument("--target", default=TARGET)
    parser.add_argument("--row-key", action="append", default=[], help="column that identifies a row; repeatable")
    parser.add_argument("--max-iter", type=int, help="override the recipe's number of boosting rounds")
    parser.add_argument("--storage", choices=("persist", "table"), default="persist")
    parser.add_argument("--train-partitions", type=int, help="fixed layout of the training rows")
    parser.add_argument("--quarantine", help="folder for damaged rows of a CSV or JSON input; needs --schema")
    parser.add_argument("--ledger", help="folder on a shared store where a search writes its fits and goes on from")
    parser.add_argument("--output", help="also write the report as Parquet to this path")
    args = parser.parse_args(argv)

    spark = session.build("Property price regression")
    recipe = RECIPES[args.recipe].with_(storage=args.storage, train_partitions=args.train_partitions)
    if args.max_iter:
        recipe = recipe.with_(booster=recipe.booster.with_(max_iter=args.max_iter))
    damaged = None
    if args.quarantine:
        if not args.schema:
            parser.error("--quarantine needs --schema")
        kept = read_quarantined(spark, args.input, args.schema, args.quarantine, args.format)
        table, damaged = kept.rows, kept.n_damaged
    else:
        table = read_first(spark, args.input, args.format, args.schema)
    grid = GRID if recipe.name == "tuned" else None
    ledger = Ledger(spark, args.ledger) if grid and args.ledger else None
    result = report.run(table, recipe, args.target, args.row_key, grid, ledger, damaged)
    print(report.as_text(result))
    if args.output:
        write_table(result, args.output)


if __name__ == "__main__":
    main()
