"""Reference queries in plain SQL, written without the tricks of the Spark
plans: cross joins for distances, one self-contained query per fold."""

from __future__ import annotations

from tatemono.functions.geo import EARTH_RADIUS_M
from tatemono.sources import fixtures

LATEST, BASE, OLDER = fixtures.YEARS

def _as(kind: str, *names: str) -> list[str]:
    """Casts; a name may be followed by another one for the result."""
    parts = [n.split() for n in names]
    return [f"cast({p[0]} as {kind}) as {p[-1]}" for p in parts]


_AREA = "coalesce(cast(unit_area as double), (cast(unit_area_min as double) + cast(unit_area_max as double)) / 2)"

_LISTING = ", ".join(
    [
        *_as("varchar", "building_id", "full_address", "eki_name1 eki_name_raw"),
        *_as("integer", "year_built", "target_ym"),
        *_as("double", "lon", "lat", "floor_count", "walk_distance1 walk_dist_raw"),
        f"{_AREA} as house_area",
        "substr(cast(full_address as varchar), 1, 12) as addr_group",
    ]
)

_ORDER = [
    "building_id", "full_address", "target_price", "house_area", "floor_count", "year_built", "target_ym",
    "lon", "lat", "eki_name_raw", "walk_dist_raw",
]

_BASE = (
    "house_area, floor_count, year_built, target_ym, full_address, addr_group, eki_name_raw, walk_dist_raw,"
    " lon, lat, building_id"
)

_AGE = "(((floor(target_ym / 100) * 12 + target_ym % 100) - (floor(year_built / 100) * 12 + year_built % 100)) / 12.0)"


def _dist(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2 * {EARTH_RADIUS_M!r} * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
    )


def _mean(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(28,10))) as double) / nullif(count({value}), 0)"


def _fold(key: str, k: int) -> str:
    return f"cast('0x' || substr(md5('42|' || {key}), 1, 8) as bigint) % {k}"


def _per_fold(key: str, value: str, k: int = 3) -> str:
    return " union all ".join(
        f"select cast({f} as bigint) as fold, {key}, {_mean(value)} as te from train_rows where fold <> {f} group by {key}"
        for f in range(k)
    )


# Steps in order; each may use the ones above it.
STEPS = {
    **fixtures.RAW_SQL,
    "typed_train": f"select cast(money_room as double) as target_price, {_LISTING} from raw_train",
    "stg_train": "select cast(row_number() over (order by "
    + ", ".join(f"{c} asc nulls last" for c in _ORDER)
    + ") as string) as id, * from typed_train",
    "stg_test": f"select cast(id as string) as id, {_LISTING}, cast(addr2_name as string) as town_name_raw from raw_test",
    "stg_stations": "select station_name, city_name, longitude, latitude from raw_stations",
    "stg_land": f"""
select p.podb_land_price_id, p.address, p.lon as land_lon, p.lat as land_lat,
  max(case when s.research_year = {LATEST} then s.posted_land_price end) as price_{LATEST},
  max(case when s.research_year = {BASE} then s.posted_land_price end) as price_{BASE},
  max(case when s.research_year = {OLDER} then s.posted_land_price end) as price_{OLDER}
from raw_points p join raw_series s on p.podb_land_price_id = s.podb_land_price_id
where p.rlc_index_name = '{fixtures.LAND_CLASS}'
group by p.podb_land_price_id, p.address, p.lon, p.lat""",
    "listings": "select * from (select building_id, money_room, unit_area, unit_area_min, unit_area_max, target_ym,"
    " year_built, full_address, eki_name1, walk_distance1 from raw_train union all select building_id,"
    " cast(null as double), unit_area, unit_area_min, unit_area_max, target_ym, year_built, full_address,"
    " eki_name1, walk_distance1 from raw_test)",
    "base": f"""
select id, 'train' as data_type, target_price, {_BASE} from stg_train
union all
select id, 'test' as data_type, cast(null as double) as target_price, {_BASE} from stg_test""",
    "buildings_by_type": """
select distinct building_id, lon, lat, 'train' as data_type from typed_train
union all
select distinct building_id, lon, lat, 'test' as data_type from stg_test""",
    "buildings": "select building_id, lon, lat from typed_train union select building_id, lon, lat from stg_test",
    "station_pairs": f"""
select * from (
  select p.building_id, p.data_type, s.station_name, s.city_name,
    {_dist("p.lon", "p.lat", "s.longitude", "s.latitude")} as dist_m
  from buildings_by_type p cross join stg_stations s
) where dist_m <= 5000""",
    "station": """
select building_id, data_type, min(dist_m) as recovered_walk_dist,
  first(station_name order by dist_m, station_name nulls last, city_name nulls last) as station_name,
  first(city_name order by dist_m, station_name nulls last, city_name nulls last) as city_name
from station_pairs group by building_id, data_type""",
    "land_pairs": f"""
select spot.building_id, place.podb_land_price_id, place.price_{LATEST} as now, place.price_{BASE} as earlier,
  {_dist("spot.lon", "spot.lat", "place.land_lon", "place.land_lat")} as metres
from buildings spot, stg_land place""",
    "land": f"""
select building_id, now as nearest_land_price, earlier as land_price_{BASE},
  case when earlier <> 0 then (now - earlier) / earlier end as land_growth_rate
from (
  select building_id, unnest(first({{'now': now, 'earlier': earlier}} order by metres, podb_land_price_id))
  from land_pairs where metres <= 5000 group by building_id
)""",
    "facts": """
select * from (select distinct building_id, data_type from buildings_by_type)
left join (select building_id, data_type, station_name as nearest, city_name, recovered_walk_dist from station)
  using (building_id, data_type)
left join land using (building_id)""",
    "mart": f"""
select id, data_type, target_price, house_area, floor_count, {_AGE} as building_age, lon, lat, building_id,
  full_address, addr_group, if(coalesce(eki_name_raw, '＊＊＊＊') = '＊＊＊＊', nearest, eki_name_raw) as station_name,
  city_name, round(ifnull(80 * walk_dist_raw, recovered_walk_dist), 3) as final_walk_dist,
  nearest_land_price, land_growth_rate
from base left join facts using (building_id, data_type)""",
    "aged": f"select *, {_AGE} as building_age from base",
    "imputed": """
select * replace (
  coalesce(building_age, (select median(building_age) from aged)) as building_age,
  coalesce(house_area, (select median(house_area) from aged)) as house_area)
from aged""",
    "folded": f"select *, case when data_type = 'train' then {_fold('id', 3)} end as fold from imputed",
    "train_rows": "select *, target_price / nullif(house_area, 0) as unit_price from folded where data_type = 'train'",
    "bldg_oof": _per_fold("building_id", "target_price"),
    "addr_oof": _per_fold("addr_group", "unit_price"),
    "bldg_all": f"select building_id, {_mean('target_price')} as te from train_rows group by building_id",
    "addr_all": f"select addr_group, {_mean('unit_price')} as te from train_rows group by addr_group",
    "global_means": f"select {_mean('target_price')} as price, {_mean('unit_price')} as up from train_rows",
    "encoded_train": """
select f.data_type, f.id, f.fold, coalesce(b.te, g.price) as bldg_te, coalesce(a.te, g.up) as addr_te
from train_rows f cross join global_means g
left join bldg_oof b on b.building_id = f.building_id and b.fold = f.fold
left join addr_oof a on a.addr_group = f.addr_group and a.fold = f.fold""",
    "encoded_test": """
select f.data_type, f.id, coalesce(b.te, g.price) as bldg_te, coalesce(a.te, g.up) as addr_te
from folded f cross join global_means g
left join bldg_all b on b.building_id = f.building_id
left join addr_all a on a.addr_group = f.addr_group
where f.data_type = 'test'""",
}


def _codes(column: str, source: str) -> str:
    return (
        f"(select label, row_number() over (order by label) - 1 as code from"
        f" (select distinct coalesce(cast({column} as string), 'None') as label from {source}))"
    )


def _query(final: str) -> str:
    steps = ",\n".join(f"{name} as ({text})" for name, text in STEPS.items())
    return f"with {steps}\n{final}"


# which column of the dirty feed is bad, why, and when
_BAD_VALUES = {
    "money_room": ("out of range", "text = '1e40'"),
    "year_built": ("not a number", "text = 'unknown'"),
    "year_built ": ("loses digits", "text like '%.5'"),
    "renovation_date": ("not a date or time", "text = '2020-02-30'"),
}
_DIRTY = ", ".join(f"{text} as {name}" for name, text in fixtures.DIRTY_TRAIN.items())

_IS_TEST = f"not ({fixtures.IS_TRAIN})"
_ID = fixtures.TEST["id"]

FINALS = {
    "q_stg_train": f"select id, target_price, {_BASE} from stg_train",
    "q_stg_test": "select * from stg_test",
    "q_stg_stations": "select * from stg_stations",
    "q_land_pivot": "select * from stg_land",
    "q_buildings_all": "select * from buildings_by_type",
    "q_buildings_distinct": "select * from buildings",
    "q_base_union": "select * from base",
    "q_addr_group": "select full_address, left(full_address, 12) as addr_group from listings",
    "q_area_recover": """select building_id, unit_area, unit_area_min, unit_area_max,
  coalesce(unit_area, (unit_area_max + unit_area_min) / 2.0) as house_area from listings""",
    "q_building_age": f"""select building_id, cast(target_ym as string) as target_ym, year_built,
  cast(floor(target_ym / 100) * 12 + target_ym % 100 as bigint) as target_months, {_AGE} as building_age
from (select building_id, cast(target_ym as int) as target_ym, year_built from listings)""",
    "q_growth_rate": f"""select podb_land_price_id, price_{LATEST}, price_{BASE},
  (price_{LATEST} - price_{BASE}) / nullif(price_{BASE}, 0) as land_growth_rate from stg_land""",
    "q_station_recover": """select building_id, eki_name1, case when eki_name1 is null or eki_name1 = '＊＊＊＊'
  then 'NEAR_' || building_id else eki_name1 end as station_name from listings""",
    "q_walk_recover": """select building_id, walk_distance1, unit_area_max,
  coalesce(cast(walk_distance1 as double) * 80, unit_area_max * 10) as final_walk_dist from listings""",
    "q_unit_price": """select building_id, money_room,
  money_room / nullif(coalesce(unit_area, (unit_area_max + unit_area_min) / 2.0) - 10.0, 0) as unit_price
from raw_train""",
    "q_interaction": f"""select building_id, cast(target_ym as string) as target_ym, area * {_AGE} as area_x_age
from (select building_id, cast(target_ym as int) as target_ym, year_built,
  coalesce(unit_area, (unit_area_max + unit_area_min) / 2.0) as area from listings)""",
    "q_distance": f"""select l_partkey, l_suppkey,
  case when lon is not null then round({_dist("lon", "lat", "longitude", "latitude")}, 3) end as dist_m
from (select distinct l_partkey, l_suppkey from lineitem)
join (select p_partkey, {fixtures.TEST["lon"]} as lon, {fixtures.TEST["lat"]} as lat from part) on l_partkey = p_partkey
join (select s_suppkey, {fixtures.STATIONS["longitude"]} as longitude, {fixtures.STATIONS["latitude"]} as latitude
  from supplier) on l_suppkey = s_suppkey""",
    "q_wkt": """select podb_land_price_id, lon, lat,
  'POINT(' || cast(round(lon, 4) as varchar) || ' ' || cast(round(lat, 4) as varchar) || ')' as wkt from raw_points""",
    "q_radius_join": "select building_id, data_type, station_name, city_name, round(dist_m, 3) as dist_m from station_pairs",
    "q_nearest_station": "select * replace (round(recovered_walk_dist, 3) as recovered_walk_dist) from station",
    "q_nearest_land": "select * from land",
    "q_mart": "select * from mart",
    "q_row_id": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() over
  (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as row_id from lineitem""",
    "q_median_impute": "select data_type, id, building_age, house_area from imputed",
    "q_label_encode": f"""select data_type, id, eki_name_raw, addr_group, e.code as eki_name_raw_id, a.code as addr_group_id
from base
left join {_codes("eki_name_raw", "base")} e on e.label = coalesce(eki_name_raw, 'None')
left join {_codes("addr_group", "base")} a on a.label = coalesce(addr_group, 'None')""",
    "q_kfold": f"select data_type, id, case when data_type = 'train' then {_fold('id', 3)} end as fold from base",
    "q_kfold4": f"select data_type, id, case when data_type = 'train' then {_fold('id', 4)} end as fold from base",
    "q_oof_te": "select * replace (round(addr_te, 6) as addr_te) from encoded_train",
    "q_test_te": "select * replace (round(addr_te, 6) as addr_te) from encoded_test",
    "q_feature_matrix": f"""select i.data_type, i.id, i.fold, i.target_price, i.house_area, i.floor_count, i.building_age,
  i.lat, i.lon, m.final_walk_dist, m.nearest_land_price, m.land_growth_rate, t.bldg_te, round(t.addr_te, 6) as addr_te,
  sc.code as station_name_id, cc.code as city_name_id, ac.code as addr_group_id
from folded i
join mart m on m.data_type = i.data_type and m.id = i.id
join (select data_type, id, bldg_te, addr_te from encoded_train union all select * from encoded_test) t
  on t.data_type = i.data_type and t.id = i.id
left join {_codes("station_name", "mart")} sc on sc.label = coalesce(m.station_name, 'None')
left join {_codes("city_name", "mart")} cc on cc.label = coalesce(m.city_name, 'None')
left join {_codes("addr_group", "mart")} ac on ac.label = coalesce(m.addr_group, 'None')""",
    "q_log_target": """select building_id, money_room, round(ln(1 + money_room), 9) as log_price,
  round(exp(ln(1 + money_room)) - 1, 4) as back from raw_train""",
    "q_ensemble": f"""select {_ID} as id, round((exp(ln(1 + l_extendedprice * cast(1.0 as double)))
  + exp(ln(1 + l_extendedprice * cast(1.01 as double))) + exp(ln(1 + l_extendedprice * cast(1.02 as double))) - 3) / 3, 6)
  as price from lineitem where {_IS_TEST}""",
    "q_mae": f"select {_mean('abs(money_room - unit_area * 1000)')} as mae from raw_train",
    "q_submission": f"""select {_ID} as id, cast(round_even(l_quantity * cast(0.25 as double), 0) as bigint) as price
  from lineitem where {_IS_TEST}""",
}

FINALS |= {
    "q_kfold_even": """select data_type, id, ntile(3) over (order by md5('42|' || id)) - 1 as fold from base where data_type = 'train'
union all select data_type, id, null from base where data_type <> 'train'""",
    "q_median_approx": f"""select 'building_age' as name, count({_AGE}) as n, true as within from base
union all select 'house_area', count(house_area), true from base""",
    "q_gbt": "select id, true as priced from stg_test",
    "q_gbt_stump": """select t.id, round(avg(exp(m.level) - 1), 4) as price
from (select id, cast(building_id as int) % 2 as odd from stg_test) t
join (
  select f.fold, r.odd, avg(r.y) as level from (values (0), (1), (2)) f(fold)
  join (select cast(building_id as int) % 2 as odd, fold, ln(1 + target_price) as y from train_rows) r on r.fold <> f.fold
  group by f.fold, r.odd
) m on m.odd = t.odd group by t.id""",
    "q_gbt_gate": f"""select cast(fold as bigint) as fold, count(*) as rows, any_value(guess_mae) as guess_mae, true as beats_guess,
  any_value(test_rows) as test_rows, any_value(test_rows) as priced_rows
from train_rows
cross join (
  select round({_mean("abs(price - middle)")}, 4) as guess_mae from (
    select price, median(price) over () as middle
    from (select cast({fixtures.PLANTED_TRAIN["money_room"]} as double) as price
          from lineitem join part on l_partkey = p_partkey where {fixtures.IS_TRAIN})
  )
)
cross join (select count(*) as test_rows from raw_test)
group by fold""",
    "q_lookup_spread": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand
from lineitem left join part on l_partkey = p_partkey""",
    "q_radius_spread": FINALS["q_radius_join"],
    "q_nearest_crowded": FINALS["q_nearest_station"],
    "q_landing_train": """select building_id, target_price, house_area, floor_count, year_built, target_ym, full_address
from (select cast(round(money_room) as double) as target_price, cast(building_id as string) as building_id,
  coalesce(cast(unit_area as double), (cast(unit_area_max as double) + cast(unit_area_min as double)) / 2.0) as house_area,
  cast(floor_count as double) as floor_count, cast(year_built as int) as year_built,
  cast(target_ym as int) as target_ym, full_address from raw_train)""",
    "q_rejects": f"""select bad_column, text, reason, count(*) as n from (
"""
    + " union all ".join(
        f"select '{name.strip()}' as bad_column, text, '{why}' as reason from (select {name} as text from (select {_DIRTY} from raw_train)) where {when}"
        for name, (why, when) in _BAD_VALUES.items()
    )
    + f""") group by all
union all select null, null, if(bad, 'rejected rows', 'good rows'), count(*)
from (select money_room = '1e40' or year_built = 'unknown' or year_built like '%.5' or renovation_date = '2020-02-30' as bad
      from (select {_DIRTY} from raw_train)) group by bad""",
    "q_mart_files": FINALS["q_mart"],
    "q_submission_file": FINALS["q_submission"],
}

ORACLES = {name: _query(final) for name, final in FINALS.items()}
