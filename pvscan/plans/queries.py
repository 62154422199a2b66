"""Registered queries of the engine over the virtual tables, each with the DuckDB SQL of the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvscan.functions import geo, kernels
from pvscan.operators import curation, labels, polygons, postprocess, raster, spatial
from pvscan.sources import vectors
from pvscan.testbed import cte, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Thresholds of the product query: probability of a predicted part, and coverage of a building.
PROB, COVERAGE = 0.35, 0.10
BOUNDS = (6.0, 51.0, 7.3, 52.2)
PATCH = 64


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_DEGREES = "6 + x1 * 1e-5 as west, 51 + y1 * 1e-5 as south, 6 + x2 * 1e-5 as east, 51 + y2 * 1e-5 as north"
_Q = f"(1 - {geo.E2!r}) * (sin(radians(L)) / (1 - {geo.E2!r} * sin(radians(L)) * sin(radians(L))) - ln((1 - {geo._E!r} * sin(radians(L))) / (1 + {geo._E!r} * sin(radians(L)))) / (2 * {geo._E!r})) * {geo.A / (2 * geo._K0)!r}"
_AREA = f"radians(east - west) * {geo.A * geo._K0!r} * (({_Q.replace('L', 'north')}) - ({_Q.replace('L', 'south')}))"


@query(f"""select ix, iy, round(6e0 + ix * 5e-1, 9) as west, round(51e0 + iy * 5e-1, 9) as south, round(least(6e0 + (ix + 1) * 5e-1, 73e-1), 9) as east, round(least(51e0 + (iy + 1) * 5e-1, 522e-1), 9) as north
from (select cast(unnest(generate_series(0, 2)) as integer) as ix) a, (select cast(unnest(generate_series(0, 2)) as integer) as iy) b""")
def aoi_bbox_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = geo.bbox_grid(spark, BOUNDS, 0.5)
    return cells.select("ix", "iy", *[F.round(c, 9).alias(c) for c in ("west", "south", "east", "north")])


@query(f"{cte('v_buildings')}, d as (select building_id, {_DEGREES} from v_buildings) select building_id, round({_AREA}, 3) as area_m2 from d where round({_AREA}, 3) >= 1000")
def equal_area_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_buildings").selectExpr("building_id", *[f"cast({e} as double) as {n}" for e, n in (x.strip().split(" as ") for x in _DEGREES.split(","))])
    shape = geo.box(*[F.col(c) for c in ("west", "south", "east", "north")])
    return own.select("building_id", F.round(geo.area_m2(shape), 3).alias("area_m2")).where("area_m2 >= 1000")


@query(f"""{cte('v_buildings')} select building_id, cast(case when lat >= 0 then 32600 else 32700 end + floor((lon + 180) / 6) + 1 as bigint) as epsg,
cast(floor(x1 / 500.0) as bigint) * 1000003 + cast(floor(y1 / 500.0) as bigint) as block from (select *, x1 / 20.0 - 120 as lon, y1 / 1000.0 - 1 as lat from v_buildings) q""")
def utm_epsg_and_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_buildings")
    lon, lat = F.col("x1") / 20.0 - 120, F.col("y1") / 1000.0 - 1
    return own.select("building_id", geo.utm_epsg(lon, lat).alias("epsg"), geo.block_id(F.col("x1"), F.col("y1"), 0.5).alias("block"))


_TOUCH = "a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2"


@query(f"{cte('v_buildings', 'v_solar')} select a.* from v_buildings a where exists (select 1 from v_solar b where {_TOUCH})")
def buildings_intersecting_solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.semi(table(spark, sf_dir, "v_buildings"), table(spark, sf_dir, "v_solar"), "building_id")


_GAP = "greatest(a.{0}1 - b.{0}2, b.{0}1 - a.{0}2, 0)"
_FAR = f"{_GAP.format('x')} * {_GAP.format('x')} + {_GAP.format('y')} * {_GAP.format('y')}"


@query(f"{cte('v_buildings', 'v_solar')} select a.* from v_buildings a where not exists (select 1 from v_solar b where {_FAR} <= 2500)")
def solar_free_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.solar_free(table(spark, sf_dir, "v_buildings"), table(spark, sf_dir, "v_solar"), 50.0)


@query(f"""{cte('v_buildings', 'v_solar')}, a as (select 'a' as source, building_id as id, x1, y1, x2, y2 from v_buildings), b as (select 'b' as source, osm_id as id, x1, y1, x2, y2 from v_solar),
k as (select * from a union all select * from b where not exists (select 1 from a where (b.x1 + b.x2) / 2.0 > a.x1 and (b.x1 + b.x2) / 2.0 < a.x2 and (b.y1 + b.y2) / 2.0 > a.y1 and (b.y1 + b.y2) / 2.0 < a.y2))
select source, id, cast(row_number() over (order by source, id) - 1 as bigint) as building_id from k""")
def dedupe_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = list(spatial.BOX)
    a = table(spark, sf_dir, "v_buildings").select(F.lit("a").alias("source"), F.col("building_id").alias("id"), *box)
    b = table(spark, sf_dir, "v_solar").select(F.lit("b").alias("source"), F.col("osm_id").alias("id"), *box)
    return labels.with_building_id(labels.dedupe_sources([a, b]), ["source", "id"]).select("source", "id", "building_id")


@query("""with e as (select event_id, substr(event_type, 1, 1) || user_id || '@' || event_id as record, json_extract_string(props, '$.k') as k from events),
p as (select event_id, case substr(record, 1, 1) when 'w' then 'way' when 'n' then 'node' when 'r' then 'relation' end as osm_type, try_cast(substr(split_part(record, '@', 1), 2) as bigint) as osm_id, nullif(k, '') as location_tag from e)
select osm_type, osm_id, location_tag, event_id from (select *, row_number() over (partition by osm_type, osm_id order by event_id) as n from p) q where n = 1""")
def osm_element_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    record = F.concat(F.substring("event_type", 1, 1), F.col("user_id"), F.lit("@"), F.col("event_id"))
    kind, ident = labels.parse_record_id(record)
    tags = F.create_map(F.lit("location"), F.get_json_object("props", "$.k"))
    own = events.select(kind.alias("osm_type"), ident.alias("osm_id"), labels.first_filled_tag(tags).alias("location_tag"), "event_id")
    return labels.dedupe_keyed(own, ["osm_type", "osm_id"], ["event_id"])


_SHARE = "((least(a.x2, b.x2) > greatest(a.x1, b.x1) and least(a.y2, b.y2) >= greatest(a.y1, b.y1)) or (least(a.x2, b.x2) >= greatest(a.x1, b.x1) and least(a.y2, b.y2) > greatest(a.y1, b.y1)))"
_GROUPS = f"""{cte('v_buildings', 'v_solar_dense')},
f as (select s.osm_id, min(b.building_id) as building from v_solar_dense s join v_buildings b on s.x1 <= b.x2 and b.x1 <= s.x2 and s.y1 <= b.y2 and b.y1 <= s.y2 group by s.osm_id),
o as (select s.*, f.building from v_solar_dense s left join f using (osm_id)),
l as (select a.osm_id as p, b.osm_id as q from o a join o b on a.osm_id <> b.osm_id and {_SHARE} where a.building is null and b.building is null),
w(p, q) as (select osm_id, osm_id from o where building is null union select w.p, l.q from w join l on l.p = w.q),
r as (select p as osm_id, min(q) as root from w group by p),
g as (select o.*, case when building is not null then 'b' || building else 'c' || root end as grp from o left join r using (osm_id))"""


@query(f'{_GROUPS} select osm_id, building, grp as "group" from g')
def label_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = labels.label_groups(table(spark, sf_dir, "v_solar_dense"), table(spark, sf_dir, "v_buildings"))
    return own.select("osm_id", "building", "group")


@query(f"""{_GROUPS},
xs as (select distinct grp, x1 as x from g union select grp, x2 from g), ys as (select distinct grp, y1 as y from g union select grp, y2 from g),
xi as (select grp, x, lead(x) over (partition by grp order by x) as nx from xs), yi as (select grp, y, lead(y) over (partition by grp order by y) as ny from ys),
u as (select xi.grp, sum((nx - x) * (ny - y)) as area from xi join yi on xi.grp = yi.grp where nx is not null and ny is not null and exists (select 1 from g where g.grp = xi.grp and g.x1 <= x and g.x2 >= nx and g.y1 <= y and g.y2 >= ny) group by xi.grp),
m as (select grp, min(osm_id) as osm_id, bool_or(osm_id % 7 = 0) as has_roof_tag, min(building) is not null as on_building, count(*) as n from g group by grp)
select grp as "group", osm_id, has_roof_tag, on_building, n, cast(area as double) as area_m2 from m join u using (grp) where area >= 1000 and (on_building or has_roof_tag)""")
def build_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    solar = table(spark, sf_dir, "v_solar_dense").withColumn("roof", F.col("osm_id") % 7 == 0)
    return labels.build_labels(solar, table(spark, sf_dir, "v_buildings"), 1000.0)


@query(f"""{cte('v_scenes')}, d as (select *, row_number() over (partition by tile, cast(ts as date) order by cloud, ts, item_id) as k from v_scenes where cloud < 60 and collection = 'view')
select tile, item_id, cloud, cast(rank as integer) as rank from (select *, row_number() over (partition by tile order by cloud, ts, item_id) as rank from d where k = 1) q where rank <= 15""")
def stac_search_clearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.clearest_scenes(table(spark, sf_dir, "v_scenes"), "view", 60.0).select("tile", "item_id", "cloud", "rank")


_VALID = "case when value > 0 and scl in (4, 5, 6, 7) then value end"


@query(f"{cte('v_obs')} select pixel, cast(round_even(coalesce(median({_VALID}), 0), 0) as integer) as value from v_obs group by pixel")
def composite_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.composite(table(spark, sf_dir, "v_obs"), ["pixel"], "median")


@query(f"{cte('v_obs')} select pixel, cast(round_even(coalesce(avg({_VALID}), 0), 0) as integer) as value from v_obs group by pixel")
def composite_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.composite(table(spark, sf_dir, "v_obs"), ["pixel"], "mean")


@query(f"""{cte('v_obs')}, d as (select pixel, day, arg_min(value, (scl, value)) as value from v_obs where value > 0 group by pixel, day)
select pixel, cast(round_even(coalesce(median(value), 0), 0) as integer) as value from d group by pixel""")
def composite_daily_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = raster.daily_mosaic(table(spark, sf_dir, "v_obs"), ["pixel"], ["scl", "value"])
    return raster.composite(daily, ["pixel"], "median", clear=None)


def _windows_sql(source: str, buffer: int) -> str:
    span = "generate_series(greatest(cast(ceil(({0}1 - {b}) / 64.0) as bigint) - 1, 0), cast(floor(({0}2 + {b}) / 64.0) as bigint))"
    return f"select distinct i * 64 as row, j * 64 as col from (select i, unnest({span.format('x', b=buffer)}) as j from (select x1, x2, unnest({span.format('y', b=buffer)}) as i from ({source}) s) t) u"


@query(f"{cte('v_buildings')} {_windows_sql('select * from v_buildings where (x2 - x1) * (y2 - y1) >= 1000', 10)}")
def roi_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_buildings").where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= 1000)
    return raster.roi_windows(own, PATCH, buffer=10.0)


@query(f"{cte('v_buildings', 'v_solar')} {_windows_sql('select x1, y1, x2, y2 from v_buildings where (x2 - x1) * (y2 - y1) >= 1000 union all select x1, y1, x2, y2 from v_solar', 0)}")
def roi_windows_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_buildings").where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= 1000).select(*spatial.BOX)
    return raster.roi_windows(own.unionByName(table(spark, sf_dir, "v_solar").select(*spatial.BOX)), PATCH)


@query(f"""{cte('v_pixels')} select cast(floor(r / 16) * 16 as bigint) as row, cast(floor(c / 16) * 16 as bigint) as col, round(1 - cast(count(*) filter (where p >= 0.5) as double) / 256, 9) as nodata
from v_pixels group by 1, 2 having 1 - cast(count(*) filter (where p >= 0.5) as double) / 256 <= 0.5""")
def chip_nodata_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = table(spark, sf_dir, "v_pixels").withColumn("value", F.when(F.col("p") >= 0.5, 1).otherwise(0))
    kept = raster.nodata_share(pixels, [], 16).where("nodata <= 0.5")
    return kept.select(F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), F.round("nodata", 9).alias("nodata"))


@query(f"""{cte('v_solar')}, p as (select distinct r, c from (select r, unnest(generate_series(cast(ceil(x1 - 0.5) as bigint), cast(ceil(x2 - 0.5) as bigint) - 1)) as c from (select x1, x2, unnest(generate_series(cast(ceil(y1 - 0.5) as bigint), cast(ceil(y2 - 0.5) as bigint) - 1)) as r from v_solar) q) q)
select cast(floor(r / 64) * 64 as bigint) as row, cast(floor(c / 64) * 64 as bigint) as col, count(*) as label_pixels from p group by 1, 2""")
def chip_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.mask_counts(table(spark, sf_dir, "v_solar"), "osm_id", PATCH)


@query(f"""{cte('v_buildings')}, o as (select *, cast(floor(x1 / 500.0) as bigint) * 1000003 + cast(floor(y1 / 500.0) as bigint) as block from v_buildings),
k as (select block, row_number() over (order by (block * 48271 + 42 * 104729) % 2147483647, block) - 1 as k, count(*) over () as n from (select distinct block from o) q),
z as (select block, k, case when n <= 2 then least(1, n) else greatest(1, round_even(n * cast(0.7 as double), 0)) end as a, case when n <= 2 then greatest(0, n - 1) else greatest(1, round_even(n * cast(0.15 as double), 0)) end as b from k)
select building_id, block, case when k < a then 'train' when k < a + b then 'val' else 'test' end as split from o join z using (block)""")
def spatial_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = curation.assign_splits(table(spark, sf_dir, "v_buildings"), F.col("x1"), F.col("y1"), 0.5)
    return own.select("building_id", "block", "split")


@query(f"""{cte('v_buildings', 'v_solar')}, f as (select a.* from v_buildings a where not exists (select 1 from v_solar b where {_FAR} <= 2500)), t as (select count(*) // 2 as n from f)
select building_id, x1, y1, x2, y2 from (select f.*, row_number() over (order by (building_id * 7919 + 42 * 104729) % 1000003, building_id) as k from f) q, t where k <= n""")
def negative_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = labels.solar_free(table(spark, sf_dir, "v_buildings"), table(spark, sf_dir, "v_solar"), 50.0).select("building_id", *spatial.BOX)
    return curation.sample_negatives(free, free.count() // 2, "building_id", 42)


_HOT = f"""{cte('v_pixels')}, h as (select * from v_pixels where p >= 0.6),
l as (select a.id as a, b.id as b from h a join h b on b.r = a.r and b.c = a.c + 1 union all select a.id, b.id from h a join h b on b.r = a.r + 1 and b.c = a.c), s as (select a, b from l union select b, a from l),
w(a, b) as (select id, id from h union select w.a, s.b from w join s on s.a = w.b), k as (select a as id, min(b) as comp from w group by a)"""


@query(f"{_HOT} select id, comp from k")
def hot_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = table(spark, sf_dir, "v_pixels").where("p >= 0.6")
    return raster.pixel_components(hot, 32).select("id", "comp")


@query(f"{_HOT} select comp, count(*) as n_pixels, round(avg(p), 9) as mean_prob, min(c) as x1, min(r) as y1, max(c) + 1 as x2, max(r) + 1 as y2 from k join h using (id) group by comp having count(*) >= 4")
def predicted_solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.predicted_solar(table(spark, sf_dir, "v_pixels"), 0.6, 4, 32).withColumn("mean_prob", F.round("mean_prob", 9))


_STATS = f"""{cte('v_buildings', 'v_pred', 'v_solar')}, i as (select a.building_id, cast((least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) as double) as part, b.prob
  from v_buildings a join v_pred b on b.prob >= {PROB} and a.x1 < b.x2 and b.x1 < a.x2 and a.y1 < b.y2 and b.y1 < a.y2),
g as (select building_id, sum(part) as pred_solar_m2, avg(prob) as mean_prob from i group by building_id),
s as (select a.building_id, cast((x2 - x1) * (y2 - y1) as double) as area_m2, coalesce(pred_solar_m2, 0) as pred_solar_m2, coalesce(mean_prob, 0) as mean_prob, exists (select 1 from v_solar b where {_TOUCH}) as osm_has_solar from v_buildings a left join g using (building_id)),
t as (select *, pred_solar_m2 / area_m2 as coverage, pred_solar_m2 / area_m2 >= {COVERAGE} as has_solar from s)"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = table(spark, sf_dir, "v_pred").where(F.col("prob") >= PROB)
    return postprocess.building_solar_stats(table(spark, sf_dir, "v_buildings"), predicted, table(spark, sf_dir, "v_solar"), COVERAGE)


@query(f"{_STATS} select building_id, area_m2, pred_solar_m2, round(mean_prob, 9) as mean_prob, round(coverage, 9) as coverage, has_solar, osm_has_solar from t")
def building_solar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _stats(spark, sf_dir)
    return own.select("building_id", "area_m2", "pred_solar_m2", F.round("mean_prob", 9).alias("mean_prob"), F.round("coverage", 9).alias("coverage"), "has_solar", "osm_has_solar")


@query(f"{_STATS} select building_id, pred_solar_m2, round(least(coverage, 1) * mean_prob, 9) as confidence from t where has_solar and not osm_has_solar")
def missing_in_osm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.missing_in_osm(_stats(spark, sf_dir)).select("building_id", "pred_solar_m2", F.round("confidence", 9).alias("confidence"))


@query(f"""{_STATS}, c as (select count(*) filter (where has_solar and osm_has_solar) as tp, count(*) filter (where has_solar and not osm_has_solar) as fp, count(*) filter (where not has_solar and osm_has_solar) as fn from t)
select tp, fp, fn, round(tp / nullif(cast(tp + fp as double), 0), 3) as precision, round(tp / nullif(cast(tp + fn as double), 0), 3) as recall from c""")
def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.confusion(_stats(spark, sf_dir))


_DIMS = "select generate_subscripts(embedding, 1) - 1 as dim, unnest(embedding) as v from v_emb"


@query(f"{cte('v_emb')} select cast(dim as integer) as dim, round(avg(cast(v as double)), 6) as mean, round(stddev_pop(cast(v as double)) + 1e-6, 6) as std from ({_DIMS}) q group by dim")
def embedding_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = curation.standardisation(table(spark, sf_dir, "v_emb"))
    return own.select("dim", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


#: A fixed head over 64 dimensions for the scoring queries: alternating weights, means 0, deviations 1/8.
_WEIGHTS = [math.sin(i + 1) for i in range(64)]
_HEAD = ([0.0] * 64, [0.125] * 64, _WEIGHTS, -0.25)
_SCORE = f"1 / (1 + exp(-(list_sum(list_transform(generate_series(1, 64), lambda i: cast(embedding[i] as double) / 0.125 * ([{', '.join(map(repr, _WEIGHTS))}])[i])) - 0.25)))"


@query(f"{cte('v_emb')} select vec_id, round({_SCORE}, 6) as screen_prob from v_emb")
def screen_head_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "v_emb").select("vec_id", F.round(curation.head_score(F.col("embedding"), *_HEAD), 6).alias("screen_prob"))


@query(f"{cte('v_emb')} select * from (select vec_id, (vec_id % 32) * 32 as x1, (vec_id // 32) * 32 as y1, (vec_id % 32) * 32 + 64 as x2, (vec_id // 32) * 32 + 64 as y2, round({_SCORE}, 6) as screen_prob from v_emb) q where screen_prob >= 0.5")
def screen_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = screen_head_score(spark, sf_dir)
    at = curation.stride(PATCH, 0.5)
    x, y = F.col("vec_id") % 32 * at, F.floor(F.col("vec_id") / 32) * at
    return own.select("vec_id", x.alias("x1"), y.alias("y1"), (x + PATCH).alias("x2"), (y + PATCH).alias("y2"), "screen_prob").where("screen_prob >= 0.5")


@query(f"{cte('v_emb')} select count(*) filter (where is_pos) as n_pos, count(*) filter (where not is_pos) as n_neg, round(greatest(1, cast(count(*) filter (where not is_pos) as double) / greatest(1, count(*) filter (where is_pos))), 9) as weight from v_emb")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.class_weight(table(spark, sf_dir, "v_emb"), "is_pos").withColumn("weight", F.round("weight", 9))


@query()
def screen_head_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    own = table(spark, sf_dir, "v_emb")
    model = curation.fit_head(own, "is_pos")
    scored = model.transform(own.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))))
    return scored.select("vec_id", F.round(vector_to_array("probability")[1], 3).alias("screen_prob"))


_CHIPS = "select r * 8 + c // 16 as chip, case when (r * 8 + c // 16) % 3 = 0 then 'pos' else 'neg' end as kind, p from v_pixels"
_CLEAN = f"{cte('v_pixels')}, q as ({_CHIPS}), s as (select chip, kind, avg(case when p >= 0.5 then 1.0 else 0.0 end) as share from q group by chip, kind), m as (select *, kind = 'neg' and share >= 0.5 as cleaned_out from s)"


def _chips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pixels = table(spark, sf_dir, "v_pixels").withColumn("chip", F.col("r") * 8 + F.floor(F.col("c") / 16))
    index = pixels.select("chip").distinct().withColumn("kind", F.when(F.col("chip") % 3 == 0, "pos").otherwise("neg"))
    return index, curation.prediction_share(pixels, ["chip"], 0.5)


@query(f"{_CLEAN} select chip, kind, round(cast(share as double), 9) as share, cleaned_out from m")
def clean_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = curation.clean_negatives(*_chips(spark, sf_dir), "chip", 0.5)
    return own.select("chip", "kind", F.round("share", 9).alias("share"), "cleaned_out")


@query(f"{_CLEAN} select chip, kind from m where not cleaned_out")
def drop_cleaned_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.drop_cleaned_out(curation.clean_negatives(*_chips(spark, sf_dir), "chip", 0.5)).select("chip", "kind")


@query(f"""{_CLEAN} select region, kind, count(*) as n from (select 'nl' as region, kind from m where not cleaned_out union all select 'de', kind from s) q group by region, kind""")
def chip_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, shares = _chips(spark, sf_dir)
    pool = curation.chip_pool({"nl": curation.clean_negatives(index, shares, "chip", 0.5), "de": index})
    return pool.groupBy("region", "kind").agg(F.count("*").alias("n"))


@query(f"""{cte('v_pixels', 'v_buildings')}, w as ({_windows_sql('select * from v_buildings where (x2 - x1) * (y2 - y1) >= 1000', 0)})
select id, round(1 / (1 + exp(-(8 * least(greatest(p * 10000 / 10000, 0), 1) - 4))), 6) as prob from v_pixels q where exists (select 1 from w where w.row = q.r // 64 * 64 and w.col = q.c // 64 * 64)""")
def windowed_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_buildings").where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= 1000)
    chosen = raster.roi_windows(own, PATCH)
    pixels = table(spark, sf_dir, "v_pixels").withColumn("band", F.col("p") * 10_000)
    scored = raster.score_windows(pixels, chosen, PATCH, _head, ["band"])
    return scored.join(pixels, ["r", "c"]).select("id", F.round("prob", 6).alias("prob"))


def _head(x):
    import numpy as np

    return 1 / (1 + np.exp(-(8 * x[:, 0] - 4)))


# Shapes that are not boxes: boxes without their upper right corner. In SQL such a shape is its box less the corner, or its lower and its left part.
_L = "select *, x2 - (x2 - x1) // 2 as cx, y2 - (y2 - y1) // 3 as cy from {0}"


def _cornered(df: DataFrame) -> DataFrame:
    cx, cy = F.expr("x2 - (x2 - x1) div 2"), F.expr("y2 - (y2 - y1) div 3")
    c = {n: F.col(n) for n in spatial.BOX}
    points = [(c["x1"], c["y1"]), (c["x2"], c["y1"]), (c["x2"], cy), (cx, cy), (cx, c["y2"]), (c["x1"], c["y2"]), (c["x1"], c["y1"])]
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points])
    return df.withColumn("shape", F.array(F.array(ring)))


def _boxed(df: DataFrame) -> DataFrame:
    return df.withColumn("shape", geo.box(*[F.col(c) for c in spatial.BOX]))


_COMMON = "greatest(least(a.x2, b.x2) - greatest({0}, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest({1}, b.y1), 0)"
_MEETS = "(a.x1 <= b.x2 and b.x1 <= {0} and a.y1 <= b.y2 and b.y1 <= {1})"


@query(f"""{cte('v_buildings', 'v_pred', 'v_solar')}, a as ({_L.format('v_buildings')}), b as (select comp_id // 2 as comp, cast((comp_id // 2 * 7919) % 1000 as double) / 1000 as prob, x1, y1, x2, y2 from v_pred),
i as (select a.building_id, b.comp, b.prob, cast({_COMMON.format('a.x1', 'a.y1')} - {_COMMON.format('a.cx', 'a.cy')} as double) as part from a join b on b.prob >= {PROB} and {_MEETS.format('a.x2', 'a.y2')}),
g as (select building_id, sum(part) as pred, avg(prob) as p from (select building_id, comp, any_value(prob) as prob, sum(part) as part from i where part > 0 group by building_id, comp) q group by building_id),
t as (select a.building_id, cast((x2 - x1) * (y2 - y1) - (x2 - cx) * (y2 - cy) as double) as area, coalesce(pred, 0) as pred, coalesce(p, 0) as p,
  exists (select 1 from v_solar b where {_MEETS.format('a.x2', 'a.cy')} or {_MEETS.format('a.cx', 'a.y2')}) as osm_has_solar from a left join g using (building_id))
select building_id, area as area_m2, round(pred, 6) as pred_solar_m2, round(p, 9) as mean_prob, round(pred / area, 9) as coverage, pred / area >= {COVERAGE} as has_solar, osm_has_solar from t""")
def shape_solar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    comp = F.expr("comp_id div 2")
    predicted = table(spark, sf_dir, "v_pred").withColumn("comp", comp).withColumn("prob", (comp * 7919 % 1000).cast("double") / 1000).where(F.col("prob") >= PROB)
    own = postprocess.shape_solar_stats(_cornered(table(spark, sf_dir, "v_buildings")), predicted, _boxed(table(spark, sf_dir, "v_solar")), COVERAGE)
    return own.select("building_id", "area_m2", F.round("pred_solar_m2", 6).alias("pred_solar_m2"), F.round("mean_prob", 9).alias("mean_prob"), F.round("coverage", 9).alias("coverage"), "has_solar", "osm_has_solar")


_PARTS = "select osm_id, x1, y1, x2, cy as y2 from {0} union all select osm_id, x1, y1, cx, y2 from {0}"


@query(f"""{cte('v_solar')}, s as ({_L.format('v_solar')}), p as ({_PARTS.format('s')}), l as (select distinct a.osm_id as p, b.osm_id as q from p a join p b on a.osm_id <> b.osm_id and {_SHARE}),
w(p, q) as (select osm_id, osm_id from s union select w.p, l.q from w join l on l.p = w.q) select p as osm_id, min(q) as root from w group by p""")
def shape_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.clusters(_cornered(table(spark, sf_dir, "v_solar")), "osm_id")


@query(f"""{cte('v_buildings')}, a as ({_L.format('v_buildings')}), m as (select building_id, cast((x2 - x1) * (y2 - y1) as double) as whole, cast((x2 - cx) * (y2 - cy) as double) as gone, x1, y1, x2, y2, cx, cy from a)
select building_id, whole - gone as area, round((whole * (x1 + x2) / 2 - gone * (cx + x2) / 2) / (whole - gone), 3) as x, round((whole * (y1 + y2) / 2 - gone * (cy + y2) / 2) / (whole - gone), 3) as y,
case when substr('CDEFGHJKLMNPQRSTUVWX', cast(1 + building_id % 20 as integer), 1) >= 'N' then 32600 else 32700 end + 1 + building_id % 60 as epsg from m""")
def shape_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _cornered(table(spark, sf_dir, "v_buildings")).withColumn("c", geo.centroid(F.col("shape")))
    band = F.substring(F.lit(kernels.BANDS), (1 + F.col("building_id") % 20).cast("int"), F.lit(1))
    tile = F.concat(F.lpad((1 + F.col("building_id") % 60).cast("string"), 2, "0"), band, F.lit("AB"))
    return own.select("building_id", geo.planar_area(F.col("shape")).alias("area"), F.round("c.x", 3).alias("x"), F.round("c.y", 3).alias("y"), geo.tile_epsg(tile).alias("epsg"))


def _degrees(df: DataFrame) -> DataFrame:
    own = {n: F.lit(o) + F.col(n) * F.lit(1e-5) for n, o in (("x1", 6.0), ("y1", 51.0), ("x2", 6.0), ("y2", 51.0))}
    box = F.struct(own["x1"].alias("xmin"), own["x2"].alias("xmax"), own["y1"].alias("ymin"), own["y2"].alias("ymax"))
    return df.withColumn("bbox", box).withColumn("geom", geo.box(*[own[n] for n in spatial.BOX]))


#: Bounds between lattice lines, in degrees and in lattice units, and the corner of a region in them.
_SCAN = (6.001505, 51.000505, 6.030005, 51.020005)
_INSIDE = "x1 <= 3000.5 and x2 >= 150.5 and y1 <= 2000.5 and y2 >= 50.5"
_REGION = "((x1 <= 3000.5 and x2 >= 150.5 and y1 <= 900.5 and y2 >= 50.5) or (x1 <= 1200.5 and x2 >= 150.5 and y1 <= 2000.5 and y2 >= 50.5))"


def _region(spark: SparkSession) -> DataFrame:
    w, s, e, n = _SCAN
    ring = [(w, s), (e, s), (e, 51.009005), (6.012005, 51.009005), (6.012005, n), (w, n), (w, s)]
    return spark.createDataFrame([([[[{"x": x, "y": y} for x, y in ring]]],)], f"geom {geo.GEOMETRY}")


@query(f"""{cte('v_solar')}, i as (select 's' || osm_id as id, osm_id // 2 as osm_id, case when osm_id % 5 = 0 then 'roof' when osm_id % 5 = 1 then '' end as location_tag, x1, osm_id as n from v_solar where osm_id % 4 <> 0 and osm_id % 3 <> 2 and osm_id % 11 <> 0 and {_INSIDE})
select 'way' as osm_type, osm_id, location_tag, x1 from (select *, row_number() over (partition by osm_id order by id) as k from i) q where k = 1""")
def solar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _degrees(table(spark, sf_dir, "v_solar"))
    n = F.col("osm_id")
    source = F.when(n % 3 == 0, F.create_map(F.lit("generator:source"), F.lit("solar"))).when(n % 3 == 1, F.create_map(F.lit("plant:source"), F.lit("solar"))).otherwise(F.create_map(F.lit("generator:source"), F.lit("wind")))
    place = F.when(n % 5 == 0, F.create_map(F.lit("location"), F.lit("roof"))).when(n % 5 == 1, F.create_map(F.lit("location"), F.lit(""))).otherwise(F.create_map().cast("map<string,string>"))
    rows = own.select(F.concat(F.lit("s"), n).alias("id"), "bbox", F.when(n % 4 == 0, "other").otherwise("power").alias("subtype"), F.array(F.struct(F.concat(F.lit("w"), F.expr("osm_id div 2"), F.lit("@1")).alias("record_id"))).alias("sources"), F.map_concat(source, place).alias("source_tags"), F.when(n % 11 == 0, F.array().cast(geo.GEOMETRY)).otherwise(F.col("geom")).alias("geom"))
    found = vectors.solar_generators(rows, _SCAN)
    return found.select("osm_type", "osm_id", "location_tag", F.round((geo.bbox(F.col("geom"))["x1"] - 6) * 1e5).cast("bigint").alias("x1"))


@query(f"{cte('v_buildings')}, d as (select *, {_DEGREES} from v_buildings where {_INSIDE}) select cast(building_id as varchar) as id, 'overture' as source, round({_AREA}, 3) as area_m2 from d where round({_AREA}, 3) >= 1000")
def building_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _degrees(table(spark, sf_dir, "v_buildings")).select(F.col("building_id").alias("id"), "bbox", "geom")
    return vectors.buildings_in_bbox(own, _SCAN, 1000.0).select("id", "source", F.round("area_m2", 3).alias("area_m2"))


@query(f"{cte('v_buildings')} select building_id from v_buildings where {_REGION}")
def clip_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.clip_to_boundary(_degrees(table(spark, sf_dir, "v_buildings")), _region(spark)).select("building_id")


@query("""select ix, iy from (select cast(unnest(generate_series(0, 5)) as integer) as ix) a, (select cast(unnest(generate_series(0, 3)) as integer) as iy) b
where ix * 500 + 150.5 <= 1200.5 or iy * 500 + 50.5 <= 900.5""")
def region_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cells_of(_region(spark), _SCAN, 0.005).select("ix", "iy")


# Chips of 16 pixels over the pixel table, one at each solar box's corner.
_CUT = f"""{cte('v_pixels', 'v_solar')}, m as (select distinct r, c from (select r, unnest(generate_series(x1, x2 - 1)) as c from (select x1, x2, unnest(generate_series(y1, y2 - 1)) as r from v_solar) q) q),
w as (select cast(osm_id as varchar) as name, y1 - 4 as row, x1 - 4 as col from v_solar),
k as (select name, cast((v.r - row) * 16 + v.c - col as integer) as spot, p, case when m.r is null then 0 else 1 end as label from w join v_pixels v on v.r >= row and v.r < row + 16 and v.c >= col and v.c < col + 16 left join m on m.r = v.r and m.c = v.c)"""


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    solar = table(spark, sf_dir, "v_solar")
    down = solar.select("x1", (-F.col("y2")).alias("y1"), "x2", (-F.col("y1")).alias("y2"))
    pixels = raster.labelled(table(spark, sf_dir, "v_pixels"), _boxed(down), [], 1.0)
    corners = solar.select(F.col("osm_id").cast("string").alias("name"), (F.col("y1") - 4).alias("row"), (F.col("x1") - 4).alias("col"))
    return raster.cut_windows(corners, pixels, [], 16).select("name", F.col("k").alias("at"), "p", "label")


@query(f"{_CUT} select name, count(*) as n, cast(sum(label) as bigint) as label_pixels, round(1 - cast(count(*) as double) / 256, 9) as nodata, cast(sum(spot) as bigint) as places from k group by name having count(*) >= 64 and sum(label) > 0")
def chip_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _cut(spark, sf_dir).groupBy("name").agg(F.count("*").alias("n"), F.sum("label").alias("label_pixels"), F.sum("at").alias("places"))
    own = own.withColumn("nodata", F.round(1 - F.col("n") / 256.0, 9))
    return own.where("nodata <= 0.75 and label_pixels > 0")


@query(f"{_CUT}, h as (select name, row_number() over (order by name) - 1 as h5_row from (select distinct name from k) q) select h5_row, name, spot, cast(round(p * 1000) as integer) as band, label from k join h using (name) where h5_row in (0, 3, 7)")
def chip_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pvscan.plans import stages

    own = _cut(spark, sf_dir).withColumn("band", F.round(F.col("p") * 1000))
    return stages.unpacked(stages.payload(own.select("name").distinct(), own, ["band"]), [0, 3, 7], ["band"]).withColumnRenamed("at", "spot")


@query(f"""{cte('v_pixels')}, v as (select *, cast(round(p * 1000) as bigint) as m from v_pixels), h as (select 1 as part, id, r, c, p from v where m >= 800 union all select 2, id, r, c, cast(m * 7 % 1000 as double) / 1000 from v where m * 7 % 1000 >= 800),
l as (select a.part, a.id as a, b.id as b from h a join h b on b.part = a.part and ((b.r = a.r and abs(b.c - a.c) = 1) or (b.c = a.c and abs(b.r - a.r) = 1))), w(part, a, b) as (select part, id, id from h union select w.part, w.a, l.b from w join l on l.part = w.part and l.a = w.b),
o as (select part, a as id, min(b) as own from w group by part, a), u as (select distinct id, r, c from h), lu as (select a.id as a, b.id as b from u a join u b on (b.r = a.r and abs(b.c - a.c) = 1) or (b.c = a.c and abs(b.r - a.r) = 1)),
wu(a, b) as (select id, id from u union select wu.a, lu.b from wu join lu on lu.a = wu.b), ou as (select a as id, min(b) as root from wu group by a),
t as (select root, part, own, avg(p) as mean from h join o using (part, id) join ou using (id) group by root, part, own),
z as (select root, min(c) as x1, min(r) as y1, max(c) + 1 as x2, max(r) + 1 as y2, count(*) as n_pixels from u join ou using (id) group by root)
select n_pixels, round(avg(mean), 9) as mean_prob, x1, y1, x2, y2, n_pixels as area from t join z using (root) where n_pixels >= 3 group by root, n_pixels, x1, y1, x2, y2""")
def merged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "v_pixels").withColumn("m", F.round(F.col("p") * 1000).cast("bigint"))
    first = own.where("m >= 800").select(F.lit(1).alias("part"), "r", "c", "p")
    second = own.where("m * 7 % 1000 >= 800").select(F.lit(2).alias("part"), "r", "c", ((F.col("m") * 7 % 1000).cast("double") / 1000).alias("p"))
    found, runs = raster.merged_predictions(first.unionByName(second), "part", 3, 16)
    area = F.sum((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area")
    boxes = runs.groupBy("comp").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), area)
    return found.join(boxes, "comp").select("n_pixels", F.round("mean_prob", 9).alias("mean_prob"), *spatial.BOX, "area")


@query(f"""{cte('v_pixels')}, s as (select p, j * 8 as row, unnest(generate_series(greatest(cast(ceil((c - 15) / 8.0) as bigint), 0), c // 8)) * 8 as col from (select *, unnest(generate_series(greatest(cast(ceil((r - 15) / 8.0) as bigint), 0), r // 8)) as j from v_pixels) q)
select row, col, round(avg(p), 9) as p, round(avg(1 - p), 9) as q from s group by row, col having count(*) >= 128""")
def pooled_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = curation.sliding(table(spark, sf_dir, "v_pixels").withColumn("q", 1 - F.col("p")), [], 16, curation.stride(16, 0.5))
    full = seen.groupBy("row", "col").agg(F.count("*").alias("n")).where("n >= 128").drop("n")
    own = curation.pooled(seen, ["row", "col"], ["p", "q"]).join(full, ["row", "col"])
    return own.select("row", "col", *[F.round(F.col("embedding")[k], 9).alias(n) for k, n in enumerate(("p", "q"))])


@query(f"""{cte('v_pixels')}, w as (select r // 16 as i, c // 16 as j from v_pixels where p >= 0.5 group by 1, 2 having 1 - count(*) / 256e0 <= 0.5)
select r, c, round(1 / (1 + exp(-(8 * (case when p >= 0.5 then p else 0 end) - 4))), 6) as prob from v_pixels join w on i = r // 16 and j = c // 16""")
def inference_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = table(spark, sf_dir, "v_pixels").withColumn("band", F.when(F.col("p") >= 0.5, F.col("p") * 10_000).otherwise(0.0))
    chosen = pixels.select((F.floor(F.col("r") / 16) * 16).alias("row"), (F.floor(F.col("c") / 16) * 16).alias("col")).distinct()
    return raster.score_windows(pixels, chosen, 16, _head, ["band"], most_nodata=0.5).select("r", "c", F.round("prob", 6).alias("prob"))


@query(f"{cte('v_buildings')} select x2 - x1 as width, count(*) as n from v_buildings group by 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.value_counts(table(spark, sf_dir, "v_buildings").withColumn("width", F.col("x2") - F.col("x1")), "width")


@query(f"""{cte('v_buildings')}, o as (select building_id % 50 as tile, building_id, 0 as version from v_buildings where building_id % 50 < 20), n as (select building_id % 50 as tile, building_id, 1 as version from v_buildings where building_id % 3 = 0 and building_id % 50 < 15)
select * from o where tile not in (select tile from n) union all select * from n""")
def replace_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pvscan.artifacts import replace_tiles

    own = table(spark, sf_dir, "v_buildings").select((F.col("building_id") % 50).alias("tile"), "building_id")
    new = own.where("building_id % 3 = 0 and tile < 15").withColumn("version", F.lit(1))
    return replace_tiles(own.where("tile < 20").withColumn("version", F.lit(0)), new)
