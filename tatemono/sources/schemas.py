"""Declared schemas of the raw tables; every column is nullable.

Schemas are DDL text, as ``spark.read.schema`` takes it. The two listing tables
share all columns but one each, and six shared columns differ in type. Whole
numbers are decimals without a fraction, as the landing files hold them.
"""

from __future__ import annotations

import re

# The columns of the raw listing tables, in declared order, with
# the types of the test table.
_SHARED = """
target_ym STRING, building_id STRING, building_status STRING, building_create_date TIMESTAMP_NTZ,
building_modify_date TIMESTAMP_NTZ, building_type DECIMAL(38,0), building_name STRING, building_name_ruby STRING,
homes_building_name STRING, homes_building_name_ruby STRING, unit_count DECIMAL(38,0), full_address STRING,
lon DECIMAL(38,7), lat DECIMAL(38,7), building_structure DECIMAL(38,0), total_floor_area DECIMAL(38,7),
building_area DECIMAL(38,7), floor_count DECIMAL(38,0), basement_floor_count DECIMAL(38,0), year_built DECIMAL(38,0),
building_land_area DECIMAL(38,7), land_area_all DECIMAL(38,7), unit_area_min DECIMAL(38,7),
unit_area_max DECIMAL(38,7), building_land_chimoku DECIMAL(38,0), land_youto DECIMAL(38,0), land_toshi DECIMAL(38,0),
land_chisei DECIMAL(38,0), land_area_kind DECIMAL(38,0), land_setback_flg DECIMAL(38,0), land_setback STRING,
land_kenpei DECIMAL(38,1), land_youseki DECIMAL(38,1), land_road_cond DECIMAL(38,1), land_seigen STRING,
building_area_kind DECIMAL(38,0), management_form DECIMAL(38,0), management_association_flg DECIMAL(38,0), reform_exterior STRING,
reform_exterior_other STRING, reform_exterior_date DECIMAL(38,0), reform_common_area STRING,
reform_common_area_date DECIMAL(38,0), building_tag_id STRING, unit_id DECIMAL(38,0), unit_name STRING, name_ruby STRING,
room_floor DECIMAL(38,0), balcony_area DECIMAL(38,9), dwelling_unit_window_angle DECIMAL(38,0), room_count DECIMAL(38,0),
unit_area DECIMAL(38,8), floor_plan_code DECIMAL(38,0), reform_date DECIMAL(38,0), reform_place STRING,
reform_place_other STRING, reform_wet_area STRING, reform_wet_area_other STRING, reform_wet_area_date DECIMAL(38,0),
reform_interior STRING, reform_interior_other STRING, reform_interior_date DECIMAL(38,0), reform_etc STRING,
renovation_date DATE, renovation_etc STRING, unit_tag_id STRING, bukken_id DECIMAL(38,0),
snapshot_create_date TIMESTAMP_NTZ, new_date TIMESTAMP_NTZ, snapshot_modify_date TIMESTAMP_NTZ,
timelimit_date TIMESTAMP_NTZ, bukken_type DECIMAL(38,0), flg_investment DECIMAL(38,0), empty_number DECIMAL(38,0),
empty_contents STRING, post1 DECIMAL(38,0), post2 DECIMAL(38,0), addr1_1 DECIMAL(38,0), addr1_2 DECIMAL(38,0), addr2_name STRING,
addr3_name STRING, nl DECIMAL(38,0), el DECIMAL(38,0), rosen_name1 STRING, eki_name1 STRING, bus_stop1 STRING,
bus_time1 DECIMAL(38,0), walk_distance1 DECIMAL(38,0), rosen_name2 STRING, eki_name2 STRING, bus_stop2 STRING,
bus_time2 DECIMAL(38,0), walk_distance2 DECIMAL(38,0), traffic_other STRING, traffic_car STRING, snapshot_land_area DECIMAL(38,0),
snapshot_land_shidou DECIMAL(38,0), land_shidou_a DECIMAL(38,0), land_shidou_b DECIMAL(38,0), land_mochibun_a DECIMAL(38,0),
land_mochibun_b DECIMAL(38,0), house_area DECIMAL(38,0), flg_new DECIMAL(38,0), house_kanrinin DECIMAL(38,0), room_kaisuu DECIMAL(38,0),
snapshot_window_angle DECIMAL(38,0), madori_number_all DECIMAL(38,0), madori_kind_all DECIMAL(38,0), money_kyoueki DECIMAL(38,0),
money_kyoueki_tax DECIMAL(38,0), money_rimawari_now DECIMAL(38,0), money_shuuzen DECIMAL(38,0), money_shuuzenkikin DECIMAL(38,0),
money_sonota_str1 STRING, money_sonota1 DECIMAL(38,0), money_sonota_str2 STRING, money_sonota2 DECIMAL(38,0),
money_sonota_str3 STRING, money_sonota3 DECIMAL(38,0), parking_money DECIMAL(38,0), parking_money_tax DECIMAL(38,0),
parking_kubun DECIMAL(38,0), parking_distance DECIMAL(38,0), parking_number DECIMAL(38,0), parking_memo STRING, genkyo_code DECIMAL(38,0),
usable_status DECIMAL(38,0), usable_date DECIMAL(38,0), school_ele_name STRING, school_ele_distance DECIMAL(38,0),
school_ele_code STRING, school_jun_name STRING, school_jun_distance DECIMAL(38,0), school_jun_code STRING,
convenience_distance DECIMAL(38,0), super_distance DECIMAL(38,0), hospital_distance DECIMAL(38,0), park_distance DECIMAL(38,0),
drugstore_distance DECIMAL(38,0), bank_distance DECIMAL(38,0), shopping_street_distance DECIMAL(38,0), est_other_name STRING,
est_other_distance DECIMAL(38,0), statuses STRING, parking_keiyaku DECIMAL(38,0), money_hoshou_company STRING,
free_rent_duration STRING, free_rent_gen_timing STRING
"""

# What only one of the tables has, and where the types differ.
_TEST_ONLY = "id STRING"
_TRAIN_ONLY = "money_room DECIMAL(38,0)"
_TRAIN_TYPES = {
    "land_setback": "DECIMAL(38,2)",
    "land_road_cond": "DECIMAL(38,0)",
    "snapshot_land_area": "DECIMAL(38,2)",
    "snapshot_land_shidou": "DECIMAL(38,2)",
    "house_area": "DECIMAL(38,2)",
    "money_rimawari_now": "DECIMAL(38,2)",
}

_shared = [column.split() for column in re.split(r",\s+", _SHARED.strip())]
_train = [f"{name} {_TRAIN_TYPES.get(name, kind)}" for name, kind in _shared]

TEST = ", ".join([_TEST_ONLY, *(f"{name} {kind}" for name, kind in _shared)])
TRAIN = ", ".join([_train[0], _TRAIN_ONLY, *_train[1:]])
STATIONS = "station_name STRING, city_name STRING, longitude DOUBLE, latitude DOUBLE"
LAND_POINTS = "podb_land_price_id BIGINT, address STRING, rlc_index_name STRING, point_land_price STRING"
LAND_SERIES = "podb_land_price_id BIGINT, research_year INT, posted_land_price DOUBLE"
