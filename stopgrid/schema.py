"""Canonical table schemas, input column names and domain constants."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Domain constants
# ---------------------------------------------------------------------------
SEATS = 33.0
CROWDED_LOAD = 49.5
UNIFORM_WEIGHT = 1.0 / 24.0
DEFAULT_LINK_M = 300.0
PEAK_HOURS = ((7, 9), (17, 19))
PEAK_KMH = 15
OFF_PEAK_KMH = 22
HEADWAY_MIN, HEADWAY_MAX = 2.0, 60.0
SEQUENCE_LENGTH = 24
PROTECTED_HOURS = 3
FORECAST_DAYS = 7
DATE_OFFSET_DAYS = 1
SUCCESS_CODE = "INFO-000"

US_PER_HOUR = 3_600_000_000
US_PER_DAY = 24 * US_PER_HOUR

# ---------------------------------------------------------------------------
# Column names of the input files
# ---------------------------------------------------------------------------
HOUR_TAG_PREFIX = "버스운행횟수_"
HOUR_TAG_SUFFIX = "시"

OPS_WIDE_NAMES = {
    "date": "기준_날짜",
    "route_key": "노선_ID",
    "stop_id": "정류장_ID",
    "stop_seq": "정류장_순서",
    "route_no": "노선번호",
    "ops_day": "버스운행횟수_일",
}

ROUTE_MAP_NAMES = {"route_key": "노선_ID", "rte_id": "RTE_ID", "route_no": "RTE_NO"}

LINK_NAMES = {
    "route_key": "노선_ID",
    "stop_id": "정류장_ID",
    "link_distance_m": "링크_구간거리(m)",
    "stop_seq": "정류장_순서",
}

FACT_NAMES = {
    "date": "기준_날짜",
    "route_id": "노선ID",
    "stop_id": "정류장_ID",
    "hour": "시간",
    "board": "승차인원",
    "alight": "하차인원",
    "route_no": "노선번호",
    "stop_name": "역명",
    "stop_seq": "정류장_순서",
    "ops": "운행횟수",
    "link_distance_m": "링크_구간거리(m)",
}

# Accepted spellings per canonical column, first present wins.
STOP_MASTER_ALIASES = {
    "route_key": ["노선_ID", "ROUTE_KEY", "ROUTE_ID"],
    "rte_id": ["RTE_ID", "노선아이디"],
    "route_no": ["RTE_NO", "노선번호", "ROUTE_NO"],
    "stop_id": ["정류장_ID", "STOPS_ID", "STOP_ID"],
    "stop_seq": ["정류장_순서", "STOPS_SEQ", "STOP_SEQ"],
    "link_distance_m": ["링크_구간거리(m)", "LINK_DISTANCE_M", "링크거리", "LINK_DIST_M"],
    "date": ["CRTR_DD", "기준_날짜", "DATE"],
}

PREDICTION_ALIASES = {
    "date": ["기준_날짜", "기준날짜", "date", "DATE"],
    "hour": ["시간", "hour", "HOUR"],
    "stop_id": ["정류장_ID", "정류장ID", "stop_id", "STOP_ID"],
    "stop_seq": ["정류장_순서", "정류장순서", "stop_seq", "STOP_SEQ"],
    "stop_name": ["역명", "정류장명", "stop_name", "STOP_NAME"],
    "pass_buses": ["통과버스수", "운행횟수", "departures", "통과대수"],
    "pred_board": ["예측_승차_총", "예측_승차인원", "pred_board_total", "yhat_board_total"],
    "pred_alight": ["예측_하차_총", "예측_하차인원", "pred_alight_total", "yhat_alight_total"],
    "board_per_bus": ["버스당_승차", "예측_버스당_승차", "per_bus_board"],
    "alight_per_bus": ["버스당_하차", "예측_버스당_하차", "per_bus_alight"],
    "onboard_per_bus": ["버스당_onboard_추정", "버스당_onboard", "per_bus_onboard"],
}

PREDICTION_NAMES = {name: accepted[0] for name, accepted in PREDICTION_ALIASES.items()}
SCHEDULE_NAMES = {
    "bus_id": "bus_id",
    "date": "기준_날짜",
    "stop_seq": "정류장_순서",
    "arrival_ts": "도착시각",
    "arrival_hour": "도착_시간",
    "stop_id": "정류장_ID",
    "stop_name": "역명",
}
ALLOCATION_NAMES = {
    **SCHEDULE_NAMES,
    "buses_in_hour": "그_시간_버스대수",
    "board_total": "총승차",
    "alight_total": "총하차",
    "board_per_bus": "버스당_할당승차",
    "alight_per_bus": "버스당_할당하차",
    "onboard_before": "onboard_before",
    "onboard_after": "onboard_after",
    "crowding": "혼잡도",
    "approx_demand": "총수요(근사)",
    "link_source": "링크거리_소스",
}
LINK_SOURCE = "LINK_CSV"
DEFAULT_LINK_SOURCE = "default(300m)"

BOARD_TOTAL_CANDIDATES = ["예측_승차_총", "예측_승차인원", "승차인원", "승차", "총승차"]
ALIGHT_TOTAL_CANDIDATES = ["예측_하차_총", "예측_하차인원", "하차인원", "하차", "총하차"]
BOARD_PER_BUS_CANDIDATES = ["버스당_승차", "예측_버스당_승차", "버스당_탑승예측", "개선후_버스당"]
ALIGHT_PER_BUS_CANDIDATES = ["버스당_하차", "예측_버스당_하차"]
LINK_COLUMN_PARTS = ("링크", "거리")

# ---------------------------------------------------------------------------
# Sentences about moves and departure slots
MOVE_SENTENCE = "%d시 → %d시로 1대 이동 (bus_id=%s)"
SLOT_SENTENCE = "%d시 슬롯 %d — 균등 출발 %s"

# Tags of the open-data XML pages
# ---------------------------------------------------------------------------
OPS_SERVICE = "tpssStationRouteTurn"
DAILY_SERVICE = "CardBusStatisticsServiceNew"
MONTHLY_SERVICE = "CardBusTimeNew"

OPS_TAGS = {
    "date": "CRTR_DD",
    "rte_id": "RTE_ID",
    "stop_id": "STOPS_ID",
    "stop_seq": "STOPS_SEQ",
    "ops_day": "BUS_OPR",
}
DAILY_TAGS = {
    "date": "USE_YMD",
    "rte_id": "RTE_ID",
    "route_no": "RTE_NO",
    "stop_id": "STOPS_ID",
    "stop_name": "SBWY_STNS_NM",
    "board_total": "GTON_TNOPE",
    "alight_total": "GTOFF_TNOPE",
    "reg_ymd": "REG_YMD",
}
MONTHLY_TAGS = {
    "use_ym": "USE_YM",
    "route_no": "RTE_NO",
    "stop_id": "STOPS_ID",
    "stop_name": "SBWY_STNS_NM",
    "reg_ymd": "REG_YMD",
}


def ops_tag(hour: int) -> str:
    return f"BUS_OPR_{hour:02d}"


def board_tags(hour: int) -> tuple[str, str]:
    return f"HR_{hour}_GET_ON_TNOPE", f"HR_{hour}_GET_ON_NOPE"


def alight_tags(hour: int) -> tuple[str, str]:
    return f"HR_{hour}_GET_OFF_TNOPE", f"HR_{hour}_GET_OFF_NOPE"


def hour_tag(hour: int) -> str:
    """Hourly count column of the wide operations CSV."""
    return f"{HOUR_TAG_PREFIX}{hour:02d}{HOUR_TAG_SUFFIX}"


# ---------------------------------------------------------------------------
# Canonical tables
# ---------------------------------------------------------------------------
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """'name type [not null], ...' as a schema, without a running session."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=rest != ["not", "null"]))
    return T.StructType(fields)


OPS_HOURLY = struct(
    "date date not null, route_no string not null, rte_id string, stop_id string not null, "
    "stop_seq int, hour int not null, ops bigint"
)
BRONZE = T.StructType(
    struct("route_key string, stop_id string, route_no string, stop_seq int").fields
    + [T.StructField(OPS_WIDE_NAMES["ops_day"], T.StringType())]
    + [T.StructField(hour_tag(h), T.StringType()) for h in range(24)]
    + struct("use_ym string, date string").fields
)
SILVER = struct(
    "route_key string, stop_id string, stop_seq int, hour int, ops bigint, "
    "use_ym string, route_no string, date string"
)
DIM_ROUTE_MAP = struct("route_key string not null, rte_id string not null, route_no string not null")
DIM_STOP_LINK = struct(
    "route_key string not null, stop_id string not null, stop_seq int not null, link_distance_m double"
)
DEMAND_DAILY_STOP = struct(
    "date date not null, rte_id string, route_no string not null, stop_id string not null, "
    "stop_name string, board_total bigint, alight_total bigint, reg_ymd date"
)
DEMAND_MONTHLY_HOURLY = struct(
    "use_ym string not null, route_no string not null, stop_id string not null, hour int not null, "
    "stop_name string, board_total bigint, alight_total bigint, reg_ymd date"
)
DAILY_STOP_HOUR = struct(
    "date date not null, route_id string, route_no string not null, stop_id string not null, "
    "hour int not null, board double, alight double, stop_name string, stop_seq int, ops bigint, "
    "link_distance_m double"
)
PREDICTIONS = struct(
    "route_no string not null, date date not null, hour int not null, stop_id string not null, "
    "stop_seq int, stop_name string, pass_buses double, pred_board double, pred_alight double, "
    "board_per_bus double, alight_per_bus double, onboard_per_bus double"
)
FINAL_SCHEDULE = struct(
    "route_no string not null, bus_id string not null, date date not null, stop_seq int not null, "
    "stop_id string, stop_name string, arrival_ts timestamp_ntz, arrival_hour int"
)
FINAL_ALLOCATION = struct(
    "route_no string not null, bus_id string not null, date date not null, stop_seq int not null, "
    "stop_id string, stop_name string, arrival_ts timestamp_ntz, arrival_hour int, "
    "board_total double, alight_total double, board_per_bus double, alight_per_bus double, "
    "onboard_before double, onboard_after double, crowding string"
)
RUN_LEDGER = struct(
    "id bigint not null, job_name string not null, target_date date not null, "
    "status string not null, message string, created_at timestamp_ntz, run_id string"
)

#: The name of the fact table's job in the ledger.
FACT_JOB = "build_daily_stop_hour"

KEYS = {
    "ops_hourly": ["date", "route_no", "stop_id", "hour"],
    "dim_route_map": ["route_key"],
    "dim_stop_link": ["route_key", "stop_id", "stop_seq"],
    "demand_daily_stop": ["date", "route_no", "stop_id"],
    "demand_monthly_hourly": ["use_ym", "route_no", "stop_id", "hour"],
    "daily_stop_hour": ["date", "route_no", "stop_id", "hour"],
    "predictions": ["route_no", "date", "hour", "stop_id"],
    "final_schedule": ["route_no", "bus_id", "stop_seq"],
    "final_allocation": ["route_no", "bus_id", "stop_seq"],
}
