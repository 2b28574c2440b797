"""Source and sink round trips."""

from pyspark.sql import functions as F

from priceloom.catalog.base import query, table
from priceloom.operators.schema import table_shape
from priceloom.sources import flat, json_to_csv, read_first, read_quarantined, read_shapes, read_table, scratch_path, write_table

_CSV_SQL = (
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate from lineitem"
)


def _lineitem_csv(spark, sf_dir):
    path = scratch_path(spark, "lineitem-csv")
    lineitem = table(spark, sf_dir, "lineitem")
    write_table(lineitem, path, "csv")
    return path, lineitem.schema


def _with_date_text(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(_CSV_SQL)
def src_csv_roundtrip(spark, sf_dir):
    """Written as CSV with a header, read back with an explicit schema."""
    path, schema = _lineitem_csv(spark, sf_dir)
    return _with_date_text(read_table(spark, path, "csv", schema))


@query(_CSV_SQL)
def src_csv_inferred(spark, sf_dir):
    """The same with inferred types; integers come back as int."""
    path, schema = _lineitem_csv(spark, sf_dir)
    inferred = _with_date_text(read_table(spark, path, "csv"))
    keys = {f.name: F.col(f.name).cast(f.dataType) for f in schema.fields if f.dataType.typeName() == "long"}
    return inferred.withColumns(keys)


@query("select count(*) as n_rows, cast(11 as bigint) as n_columns from lineitem")
def src_fallback(spark, sf_dir):
    """The first two candidates do not exist."""
    paths = [f"{sf_dir}/data.parquet", f"{sf_dir}/absent/lineitem.parquet", f"{sf_dir}/lineitem.parquet"]
    return table_shape(read_first(spark, paths, "parquet"))


@query(
    "select event_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k from events"
)
def doc_json_to_table(spark, sf_dir):
    """Nested JSON records flattened to CSV, then read as a table."""
    fields = "event_id bigint, event_type string, value double, props struct<k: bigint>"
    records, flat = scratch_path(spark, "events-json"), scratch_path(spark, "events-csv")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    write_table(events.withColumn("props", F.from_json("props", "k bigint")), records, "json")
    json_to_csv(spark, records, fields, ["event_id", "event_type", "value", "props.k as k"], flat)
    return read_table(spark, flat, "csv", "event_id bigint, event_type string, value double, k bigint")


# Lines of a CSV file, every 50th order with a quantity that is no number and the
# one after it cut short.
_LINE = (
    "case l_orderkey % 50 when 0 then concat_ws(',', l_orderkey, l_linenumber, l_partkey, 'n/a', l_returnflag) "
    "when 1 then concat_ws(',', l_orderkey, l_linenumber) "
    "else concat_ws(',', l_orderkey, l_linenumber, l_partkey, cast(l_quantity as int), l_returnflag) end"
)


@query(
    "select 'damaged' as side, cast(null as bigint) as l_orderkey, cast(null as bigint) as l_linenumber, "
    f"cast(null as bigint) as l_partkey, cast(null as bigint) as quantity, cast(null as varchar) as l_returnflag, {_LINE} as record "
    "from lineitem where l_orderkey % 50 < 2 union all select 'kept', l_orderkey, l_linenumber, l_partkey, "
    "cast(l_quantity as bigint), l_returnflag, null from lineitem where l_orderkey % 50 >= 2"
)
def src_quarantine(spark, sf_dir):
    """A CSV source with planted damage: rows that fit, and those put aside."""
    path = scratch_path(spark, "damaged-csv")
    table(spark, sf_dir, "lineitem").selectExpr(f"{_LINE} as value").write.text(path)
    schema = "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, quantity bigint, l_returnflag string"
    found = read_quarantined(spark, path, schema, scratch_path(spark, "quarantine"), header="false")
    kept = found.rows.withColumns({"side": F.lit("kept"), "record": F.lit(None).cast("string")})
    damaged = found.damaged.select(F.lit("damaged").alias("side"), "record")
    return kept.unionByName(damaged, allowMissingColumns=True)


_CENTS = "cast(round(value * 100) as bigint)"


@query(
    "select event_id, user_id, case when event_id % 2 = 1 then event_type end as user_kind, "
    f"case when event_id % 2 = 1 then 'v' else '' end || {_CENTS} as value, "
    "case when event_id % 2 = 1 then '{\"n\":' || json_extract_string(props, '$.k') || '}' else json_extract_string(props, '$.k') end as props_k, "
    "case when event_id % 2 = 1 then 'b' end as props_shape from events"
)
def doc_json_shapes(spark, sf_dir):
    """Two crawls of JSON records of different shape under one schema: fields
    united, a number and a text widened to text, a nested value kept as JSON."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    shapes = (
        f"struct(event_id, struct(user_id as id) as user, {_CENTS} as value, struct(k) as props)",
        f"struct(event_id, struct(user_id as id, event_type as kind) as user, concat('v', {_CENTS}) as value, "
        "struct(struct(k as n) as k, 'b' as shape) as props)",
    )
    paths = [scratch_path(spark, f"events-{i}") for i in range(2)]
    for i, (path, shape) in enumerate(zip(paths, shapes)):
        events.filter(F.col("event_id") % 2 == i).selectExpr(f"to_json({shape})").write.text(path)
    return flat(read_shapes(spark, paths))
