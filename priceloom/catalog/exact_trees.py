"""Boosted trees over the optimized program's preparation, stated in SQL.

With a bin for every value and all rows in every tree, what Spark ML grows can be
written down: thresholds half way between neighbouring values of the training
rows; labels of a nominal column in the order of their means, split at a prefix;
of all splits the one that removes most squared error, the first feature and the
lowest threshold on ties. A second level does the same within each side, with the
thresholds of the whole. Gains are compared without their last digits, as sums
of doubles come in any order."""

from __future__ import annotations

from priceloom.catalog.base import FOLD_BUCKET, KEYS, SIGNAL_CTE, SPLIT_CASE
from priceloom.plans.boosting import Booster

NUMERIC = {
    "living_area": "living_area",
    "bedrooms": "bedrooms",
    "bathrooms": "bathrooms",
    "land_area": "land_area",
    "living_area_squared": "living_area * living_area",
    "bedrooms_squared": "bedrooms * bedrooms",
    "bathrooms_squared": "cast(bathrooms as double) * bathrooms",
    "land_area_squared": "cast(land_area as double) * land_area",
    "living_land_ratio": "case when land_area > 0 then living_area / land_area else 0 end",
    "bed_bath_ratio": "case when bathrooms > 0 then bedrooms / bathrooms else 0 end",
    "area_per_bedroom": "case when bedrooms > 0 then living_area / bedrooms else 0 end",
    "living_area_x_bathrooms": "living_area * bathrooms",
    "bedrooms_x_bathrooms": "bedrooms * bathrooms",
    "living_area_x_land_area": "living_area * land_area",
}
NOMINAL = ("property_type", "city")
FEATURES = (*NUMERIC, *[f"{c}_indexed" for c in NOMINAL])
STEP = 0.03
#: More bins than any feature has values, so that every value is one.
BINS = 2048


def booster(depth: int) -> Booster:
    return Booster(max_iter=2, max_depth=depth, step_size=STEP, subsampling_rate=1.0, feature_subset="all", max_bins=BINS)


def _unpivoted(rows: str, value: str) -> str:
    """(node, f, v, cat, t) of the rows that are not held out."""
    parts = [f"select node, {i} as f, cast({c} as double) as v, null as cat, {value} as t from {rows} where not held" for i, c in enumerate(NUMERIC)]
    parts += [
        f"select node, {i} as f, null as v, {c} as cat, {value} as t from {rows} where not held"
        for i, c in enumerate(NOMINAL, start=len(NUMERIC))
    ]
    return " union all ".join(parts)


def _level(name: str, rows: str, label: str) -> str:
    """CTE ``name``: for every node of ``rows`` its best split, with f, thr or
    left_set, the means lo and hi, and gain; and ``name``_rows, where the rows
    have moved to its sides (2 * node, 2 * node + 1) with p, the side's mean."""
    go_left = " ".join(f"when {i} then {c} <= thr" for i, c in enumerate(NUMERIC))
    go_left += " " + " ".join(f"when {i} then list_contains(left_set, {c})" for i, c in enumerate(NOMINAL, start=len(NUMERIC)))
    sums = "sum(n) over w as nl, sum(s) over w as sl, sum(n) over (partition by node, f) as nt, sum(s) over (partition by node, f) as st"
    return (
        f"{name}_mid as (select avg({label}) as mid from {rows} where not held), "
        f"{name}_bins as (select node, f, v, cat, count(*) as n, sum(t) as s from "
        f"({_unpivoted(f'{rows}, {name}_mid', f'{label} - mid')}) group by node, f, v, cat), "
        f"{name}_cuts as (select f, v, lead(v) over (partition by f order by v) as nv from "
        f"(select distinct f, v from {name}_bins where v is not null)), "
        f"{name}_grid as (select k.node, c.f, c.v, c.nv, coalesce(n, 0) as n, coalesce(s, 0) as s from {name}_cuts c "
        f"cross join (select distinct node from {name}_bins) k left join {name}_bins b on b.node = k.node and b.f = c.f and b.v = c.v), "
        f"{name}_num as (select node, f, v as pos, (v + nv) / 2 as thr, cast(null as varchar[]) as left_set, {sums} from {name}_grid "
        "window w as (partition by node, f order by v)), "
        f"{name}_cat as (select node, f, cast(row_number() over w as double) as pos, cast(null as double) as thr, "
        f"list(cat) over (w rows between unbounded preceding and current row) as left_set, {sums} from {name}_bins where v is null "
        "window w as (partition by node, f order by s / n, cat)), "
        f"{name} as (select *, sl / nl + mid as lo, (st - sl) / (nt - nl) + mid as hi, "
        "sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt as gain "
        f"from (select * from {name}_num union all select * from {name}_cat), {name}_mid where nl > 0 and nl < nt "
        "qualify row_number() over (partition by node order by round(gain, 6) desc, f, pos) = 1), "
        f"{name}_rows as (select r.* replace (2 * r.node + case when case b.f {go_left} end then 0 else 1 end as node), "
        f"case when case b.f {go_left} end then lo else hi end as {name}_p from {rows} r join {name} b using (node))"
    )


def ctes(depth: int) -> str:
    """Two boosting rounds of trees of ``depth`` levels, down to ``boosted``: the
    prepared rows with held, y, p, and ``removed``: (f, gain) of every split."""
    derived = ", ".join(f"cast({sql} as double) as {name}" for name, sql in NUMERIC.items())
    out = [
        SIGNAL_CTE,
        f"logged as (select {KEYS}, price, coalesce(living_area, 0) as living_area, bedrooms, bathrooms, land_area, "
        f"property_type, city, ln(1 + price) as y, {SPLIT_CASE} = 'test' as held, {FOLD_BUCKET} as fold from prop)",
        "bounds as (select avg(y) - 3 * stddev_samp(y) as lower, avg(y) + 3 * stddev_samp(y) as upper from logged)",
        f"start as (select {KEYS}, price, y, held, 1 as node, property_type, city, {derived} from logged, bounds "
        "where y >= lower and y <= upper)",
    ]
    rows, splits, predictions = "start", [], []
    for tree, label in ((1, "y"), (2, "2 * (y - p)")):
        for level in range(1, depth + 1):
            name = f"t{tree}{level}"
            out.append(_level(name, rows, label))
            rows = f"{name}_rows"
            splits.append(name)
        predictions.append(f"{name}_p")
        if tree == 1:
            out.append(f"round1 as (select * replace (1 as node), {name}_p as p from {rows})")
            rows = "round1"
    out.append(f"boosted as (select *, p + {STEP} * {predictions[1]} as prediction from {rows})")
    out.append("removed as (" + " union all ".join(f"select f, gain from {s}" for s in splits) + ")")
    return "with " + ", ".join(out)


def importance_sql(depth: int, k: int) -> str:
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(FEATURES))
    return (
        ctes(depth) + f", names as (select * from (values {names}) v(f, feature)), "
        "weights as (select f, feature, coalesce(sum(gain), 0) / (select sum(gain) from removed) as importance "
        "from names left join removed using (f) group by f, feature) "
        "select cast(row_number() over (order by importance desc, f) as int) as rank, feature, "
        f"round(importance, 6) as importance from weights qualify rank <= {k}"
    )
