"""Virtual tables: integer geometry, scenes and pixels derived from the driver's tables.

All rectangles lie on a lattice of 100 m cells, 50 in a row. Each table is a DataFrame here and, for the
oracles, a common table expression of the same rows in ``CTE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ROW = "cast(floor(k / 50) as bigint) * 100"

#: name: (columns, source, columns of the source). Both engines read the same expressions.
_TABLES = {
    "v_buildings": ("k as building_id, (k % 50) * 100 as x1, {r} as y1, (k % 50) * 100 + 20 + s as x2, {r} + 20 + (k % 7) * 5 as y2", "part", "p_partkey as k, cast(p_size as bigint) as s"),
    "v_solar": ("osm_id, (k % 50) * 100 + (osm_id * 37) % 140 as x1, {r} + (osm_id * 91) % 120 as y1, (k % 50) * 100 + (osm_id * 37) % 140 + 5 + n as x2, {r} + (osm_id * 91) % 120 + 5 + osm_id % 23 as y2", "customer", "c_custkey as osm_id, cast(c_nationkey as bigint) as n, cast(floor(c_custkey * 4 / 3) as bigint) as k"),
    "v_solar_dense": ("osm_id, (k % 50) * 100 + (osm_id * 61) % 80 as x1, {r} + (osm_id * 83) % 60 as y1, (k % 50) * 100 + (osm_id * 61) % 80 + 20 + u % 40 as x2, {r} + (osm_id * 83) % 60 + 20 + osm_id % 37 as y2", "orders", "o_orderkey as osm_id, o_custkey as u, cast(floor(o_orderkey * 2 / 3) as bigint) as k"),
    "v_pred": ("osm_id as comp_id, (k % 50) * 100 + (osm_id - cast(ceil(k * 15 / 2) as bigint)) * 12 as x1, {r} + (osm_id % 5) * 8 as y1, (k % 50) * 100 + (osm_id - cast(ceil(k * 15 / 2) as bigint)) * 12 + 10 as x2, {r} + (osm_id % 5) * 8 + 10 as y2, cast((osm_id * 7919) % 1000 as double) / 1000 as prob", "orders", "o_orderkey as osm_id, cast(floor(o_orderkey * 2 / 15) as bigint) as k"),
    "v_pixels": ("id, cast(floor(id / 125) as bigint) as r, id % 125 as c, cast(cents % 1000 as double) / 1000 as p", "orders", "o_orderkey as id, cast(round(o_totalprice * 100) as bigint) as cents"),
    "v_obs": ("pixel, cast(ts as date) as day, scl, value", "lineitem", "l_partkey as pixel, l_shipdate as ts, l_linenumber as scl, l_quantity * 100 as value"),
    "v_scenes": ("event_id as item_id, user_id % 16 as tile, ts, value as cloud, event_type as collection, props", "events", "*"),
    "v_emb": ("vec_id, embedding, label = 0 as is_pos", "embeddings", "*"),
}


def _select(name: str) -> str:
    columns, source, inner = _TABLES[name]
    return f"select {columns.format(r=_ROW)} from (select {inner} from {source}) q"


#: Oracle prefix for a set of virtual tables.
def cte(*names: str) -> str:
    return "with recursive " + ", ".join(f"{n} as ({_select(n)})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    columns, source, inner = _TABLES[name]
    own = spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*_items(inner))
    return own.selectExpr(*_items(columns.format(r=_ROW)))


def _items(text: str) -> list[str]:
    """Splits a select list at its outer commas."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[last:i].strip())
            last = i + 1
    return [*out, text[last:].strip()]
