"""DuckDB oracle SQL for the registered queries (tables are pre-registered
views).  Written in the style of the pipeline being rebuilt: each feature is
"filter -> group by -> left join"; it does not share code with the Spark
implementation except the adapter text."""

from __future__ import annotations

from promo_engine.sources.coupons import COUPON_RAW_SQL

_RATE = ("case when discount_rate_raw like '%:%' then "
         "(cast(split_part(discount_rate_raw, ':', 1) as double) - cast(split_part(discount_rate_raw, ':', 2) as double))"
         " / cast(split_part(discount_rate_raw, ':', 1) as double) "
         "else cast(discount_rate_raw as double) end")

BASE = f"""coupon_raw as ({COUPON_RAW_SQL}),
cleaned as (
  select user_id, merchant_id, coupon_id, discount_rate_raw,
         cast(coalesce(distance_raw, -1) as integer) as distance,
         case when discount_rate_raw like '%:%' then 1 else 0 end as is_manjian,
         {_RATE} as discount_rate,
         case when discount_rate_raw like '%:%' then cast(split_part(discount_rate_raw, ':', 1) as integer) else -1 end as min_cost_of_manjian,
         case when coalesce(distance_raw, -1) = -1 then 1 else 0 end as null_distance,
         date_received, date_used
  from coupon_raw),
labelled as (
  select *, case when date_diff('day', date_received, date_used) <= 15 then 1 else 0 end as label
  from cleaned),
rep as (
  select user_id, merchant_id, coupon_id,
         round_even({_RATE}, 5) as discount_rate,
         cast(coalesce(distance_raw, -1) as integer) as distance,
         date_received,
         case when discount_rate_raw like '%:%' then 1 else 0 end as is_manjian,
         case when round_even({_RATE}, 5) <= 0.8 then 1 else 0 end as cheap_label,
         cast(isodow(date_received) as integer) as weekday_receive,
         cast(month(date_received) as integer) as received_month
  from coupon_raw)"""


def _fields(h0, h1, l0, l1, keep_outcome=True):
    lab = "select * from labelled" if keep_outcome else \
        "select * exclude (date_used, label), cast(null as date) as date_used from labelled"
    return f"""H as (select * from labelled where date_received >= date '{h0}' and date_received < date '{h1}'),
L0 as ({lab} where date_received >= date '{l0}' and date_received < date '{l1}'),
L as (select * replace (coalesce(coupon_id, 0) as coupon_id) from L0)"""


TRAIN_FIELDS = _fields("1998-01-01", "1998-12-27", "1999-01-10", "1999-07-09")
VALIDATE_FIELDS = _fields("1997-01-01", "1997-12-27", "1998-01-10", "1998-07-09")


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def _mean(x: str) -> str:
    return f"round(avg(cast({x} as double)), 9)"


def _cnt(cond: str) -> str:
    return f"cast(nullif(count_if({cond}), 0) as bigint)"


UR = "date_used is not null and date_received is not null"
UC = "date_used is not null and coupon_id is not null"
USE_GAP = "cast(date_diff('day', date_used, date_received) as integer)"
GAP = "cast(date_diff('day', date_received, date_used) as integer)"
D0 = "case when distance = -1 then 0 else distance end"

# ---- feature tables (one per key set) ----------------------------------------
LU = f"""select user_id,
  cast(count(*) as bigint) as consume,
  min(date_received) as first_received,
  max(date_received) as last_received,
  {_cnt('coupon_id is not null')} as Coupon_amount,
  {_cnt('date_received is not null')} as User_received_total_coupon,
  {_cnt('date_received is not null and is_manjian = 1')} as manjian_coupon,
  min(case when distance <> -1 then distance end) as min_distance_y,
  cast(nullif(count(distinct case when distance <> -1 then merchant_id end), 0) as bigint) as different_merchant_receive_consume,
  cast(count(distinct merchant_id) as bigint) as different_merchant_receive
from L group by user_id"""

LUD = f"""select user_id, date_received,
  {_cnt('date_received is not null')} as User_Date_received_x,
  cast(count(*) as bigint) as User_Date_received_y
from L group by user_id, date_received"""

LUCD = """select user_id, coupon_id, date_received,
  cast(count(*) as bigint) as User_Date_received_special_Coupon,
  case when count(*) > 1 then 1 else 0 end as User_if_same_Date_received_special_Coupon,
  cast(count(*) as bigint) as User_Date_received_coupon
from L group by user_id, coupon_id, date_received"""

LUM = f"""select user_id, merchant_id,
  {_cnt('coupon_id is not null')} as receive_coupon_in_different_merchant,
  {_cnt('date_received is not null and is_manjian = 1')} as User_Merchant_manjian_coupon,
  cast(count(*) as bigint) as User_Merchant_per_consume
from L group by user_id, merchant_id"""

LUMC = """select user_id, merchant_id, coupon_id,
  cast(count(*) as bigint) as User_Merchant_Coupon_per_consume
from L group by user_id, merchant_id, coupon_id"""

LUDIST = """select user_id, distance, cast(count(*) as bigint) as User_received_Distance
from L group by user_id, distance"""

LM = """select merchant_id, cast(count(*) as bigint) as Merchant_Coupon_amount
from L group by merchant_id"""

LMC = f"""select merchant_id, coupon_id,
  {_cnt('date_received is not null')} as Merchant_received_special_coupon
from L group by merchant_id, coupon_id having count_if(date_received is not null) > 0"""

LRATE = """select discount_rate, cast(count(*) as bigint) as different_rate_coupon_amount
from L where discount_rate_raw is not null and discount_rate is not null group by discount_rate"""

HU = f"""select user_id,
  min(case when {UR} then distance end) as min_distance_x,
  max(case when {UR} then distance end) as max_distance_x,
  {_mean(f'case when {UR} then distance end')} as mean_distance,
  median(case when {UC} then distance end) as receive_buy_median_distance,
  {_mean(f'case when {UC} then discount_rate end')} as receive_buy_mean_rate,
  {_cnt(UC)} as get_consume,
  {_mean(f'case when {UC} then {USE_GAP} end')} as receive_use_mean,
  median(case when {UC} then {USE_GAP} end) as receive_use_median,
  max(case when {UC} then {USE_GAP} end) as receive_use_max,
  min(case when {UC} then {USE_GAP} end) as receive_use_min,
  {_cnt('date_received is not null')} as receive_cnt_y,
  cast(nullif(count(distinct case when date_received is not null then coupon_id end), 0) as bigint) as differ_coupon_cnt,
  min(case when {UR} then discount_rate end) as min_discount_rate,
  max(case when {UR} then discount_rate end) as max_discount_rate,
  max(case when {UR} then {D0} end) as max_distance_y
from H where user_id is not null group by user_id"""

HM = f"""select merchant_id,
  {_cnt('date_used is not null')} as cunsume_cnt_x,
  cast(count(*) as bigint) as Merchant_use_coupon_amount,
  {_cnt(UR)} as receive_consume_cnt,
  {_cnt('date_received is not null')} as receive_cnt_x,
  min(distance) as Coupon_Merchant_min_distance,
  max(case when label = 1 then {D0} end) as "15_max_consume_distance",
  {_mean(f'case when label = 1 then {D0} end')} as "15_mean_consume_distance",
  {_cnt('date_received is not null')} as receive_cnt
from H where merchant_id is not null group by merchant_id"""

HC = f"""select coupon_id, {_cnt('date_used is not null')} as cunsume_cnt_y
from H where coupon_id is not null group by coupon_id having count_if(date_used is not null) > 0"""

HUM = f"""select user_id, merchant_id,
  {_cnt(UC)} as receive_use__coupon_in_different_merchant,
  {_cnt('date_received is not null')} as receive1_cnt,
  max(case when label = 1 then {GAP} end) as "15_max_consume_gap",
  cast(count(*) as bigint) as User_different_Merchant
from H where user_id is not null and merchant_id is not null group by user_id, merchant_id"""

BLOCK_SQL = {
    "feat_L_user": LU, "feat_L_user_date": LUD, "feat_L_user_coupon_date": LUCD,
    "feat_L_user_merchant": LUM, "feat_L_user_merchant_coupon": LUMC,
    "feat_L_user_distance": LUDIST, "feat_L_merchant": LM, "feat_L_merchant_coupon": LMC,
    "feat_L_rate": LRATE, "feat_H_user": HU, "feat_H_merchant": HM, "feat_H_coupon": HC,
    "feat_H_user_merchant": HUM,
}


def _guarded(x, y):
    return (f"case when {x} is null or {y} is null then null when {y} = 0 then 0.0 "
            f"else cast({x} as double) / cast({y} as double) end")


def _plain(x, y):
    return f"case when {y} = 0 then null else cast({x} as double) / cast({y} as double) end"


CUT = ("case when discount_rate_raw like '%:%' then cast(split_part(discount_rate_raw, ':', 2) as double) "
       "else 0.0 end")

RATIOS = {
    "User_manjian_rate": _guarded("lu.manjian_coupon", "lu.User_received_total_coupon"),
    "cut_price": CUT,
    "receive_rate": _plain("hu.get_consume", "lu.Coupon_amount"),
    "User_Merchant_manjian_rate": _guarded("lum.User_Merchant_manjian_coupon", "hum.receive1_cnt"),
    "consume_rate": _plain('hum."15_max_consume_gap"', "lum.receive_coupon_in_different_merchant"),
    "merchant_consume_rate": _plain("lu.different_merchant_receive_consume", "lu.different_merchant_receive"),
}

JOINED = """joined as (
  select L.*, lu.*, lud.*, lucd.*, lum.*, lumc.*, ludist.*, lm.*, lmc.*, lrate.*, hu.*, hm.*, hc.*, hum.*,
""" + ",\n".join(f"    {v} as {k}" for k, v in RATIOS.items()) + """
  from L
  left join lu on L.user_id = lu.user_id
  left join lud on L.user_id = lud.user_id and L.date_received is not distinct from lud.date_received
  left join lucd on L.user_id = lucd.user_id and L.coupon_id is not distinct from lucd.coupon_id
                and L.date_received is not distinct from lucd.date_received
  left join lum on L.user_id = lum.user_id and L.merchant_id = lum.merchant_id
  left join lumc on L.user_id = lumc.user_id and L.merchant_id = lumc.merchant_id
                and L.coupon_id is not distinct from lumc.coupon_id
  left join ludist on L.user_id = ludist.user_id and L.distance = ludist.distance
  left join lm on L.merchant_id = lm.merchant_id
  left join lmc on L.merchant_id = lmc.merchant_id and L.coupon_id is not distinct from lmc.coupon_id
  left join lrate on L.discount_rate is not distinct from lrate.discount_rate
  left join hu on L.user_id = hu.user_id
  left join hm on L.merchant_id = hm.merchant_id
  left join hc on L.coupon_id = hc.coupon_id
  left join hum on L.user_id = hum.user_id and L.merchant_id = hum.merchant_id
)"""

FEATURE_TABLES = ",\n".join([
    f"lu as (select user_id as lu_user_id, * exclude (user_id) from ({LU}))",
    f"lud as (select user_id as lud_u, date_received as lud_d, * exclude (user_id, date_received) from ({LUD}))",
    f"lucd as (select user_id as lucd_u, coupon_id as lucd_c, date_received as lucd_d, * exclude (user_id, coupon_id, date_received) from ({LUCD}))",
    f"lum as (select user_id as lum_u, merchant_id as lum_m, * exclude (user_id, merchant_id) from ({LUM}))",
    f"lumc as (select user_id as lumc_u, merchant_id as lumc_m, coupon_id as lumc_c, * exclude (user_id, merchant_id, coupon_id) from ({LUMC}))",
    f"ludist as (select user_id as ludist_u, distance as ludist_d, * exclude (user_id, distance) from ({LUDIST}))",
    f"lm as (select merchant_id as lm_m, * exclude (merchant_id) from ({LM}))",
    f"lmc as (select merchant_id as lmc_m, coupon_id as lmc_c, * exclude (merchant_id, coupon_id) from ({LMC}))",
    f"lrate as (select discount_rate as lrate_r, * exclude (discount_rate) from ({LRATE}))",
    f"hu as (select user_id as hu_u, * exclude (user_id) from ({HU}))",
    f"hm as (select merchant_id as hm_m, * exclude (merchant_id) from ({HM}))",
    f"hc as (select coupon_id as hc_c, * exclude (coupon_id) from ({HC}))",
    f"hum as (select user_id as hum_u, merchant_id as hum_m, * exclude (user_id, merchant_id) from ({HUM}))",
])

JOINED = (JOINED.replace("lu.user_id", "lu.lu_user_id")
          .replace("lud.user_id", "lud.lud_u").replace("lud.date_received", "lud.lud_d")
          .replace("lucd.user_id", "lucd.lucd_u").replace("lucd.coupon_id", "lucd.lucd_c")
          .replace("lucd.date_received", "lucd.lucd_d")
          .replace("lum.user_id", "lum.lum_u").replace("lum.merchant_id", "lum.lum_m")
          .replace("lumc.user_id", "lumc.lumc_u").replace("lumc.merchant_id", "lumc.lumc_m")
          .replace("lumc.coupon_id", "lumc.lumc_c")
          .replace("ludist.user_id", "ludist.ludist_u").replace("ludist.distance", "ludist.ludist_d")
          .replace("lm.merchant_id", "lm.lm_m").replace("lmc.merchant_id", "lmc.lmc_m")
          .replace("lmc.coupon_id", "lmc.lmc_c").replace("lrate.discount_rate", "lrate.lrate_r")
          .replace("hu.user_id", "hu.hu_u").replace("hm.merchant_id", "hm.hm_m")
          .replace("hc.coupon_id", "hc.hc_c").replace("hum.user_id", "hum.hum_u")
          .replace("hum.merchant_id", "hum.hum_m"))

MAIN_FEATURES = [
    "consume", "if_first_time", "if_last_time", "min_distance_x", "max_distance_x",
    "mean_distance", "receive_buy_median_distance", "receive_buy_mean_rate", "Coupon_amount",
    "User_received_total_coupon", "manjian_coupon", "User_Date_received_x", "User_manjian_rate",
    "User_Date_received_special_Coupon", "User_if_same_Date_received_special_Coupon",
    "get_consume", "receive_use_mean", "receive_use_median", "receive_use_max", "receive_use_min",
    "cunsume_cnt_x", "Merchant_use_coupon_amount", "receive_consume_cnt", "receive_cnt_x",
    "Coupon_Merchant_min_distance", "15_max_consume_distance", "15_mean_consume_distance",
    "cut_price", "cunsume_cnt_y", "receive_rate", "receive_coupon_in_different_merchant",
    "receive_use__coupon_in_different_merchant", "receive1_cnt", "User_Merchant_manjian_coupon",
    "User_Merchant_manjian_rate", "15_max_consume_gap", "consume_rate", "User_different_Merchant",
    "User_Merchant_per_consume", "User_Merchant_Coupon_per_consume", "User_received_Distance",
    "receive_cnt_y", "differ_coupon_cnt", "User_Date_received_y", "User_Date_received_coupon",
    "min_discount_rate", "max_discount_rate", "min_distance_y", "max_distance_y", "receive_cnt",
    "Merchant_received_special_coupon", "different_rate_coupon_amount",
    "different_merchant_receive_consume", "different_merchant_receive", "merchant_consume_rate",
    "Merchant_Coupon_amount",
]


def _feature_col(n: str) -> str:
    if n == "if_first_time":
        return "case when date_received = first_received then 1 else 0 end as if_first_time"
    if n == "if_last_time":
        return "case when date_received = last_received then 1 else 0 end as if_last_time"
    return f'"{n}"'


MAIN_DATASET_SELECT = ",\n  ".join(
    ["user_id", "coupon_id", "date_received", "distance", "is_manjian", "discount_rate",
     "min_cost_of_manjian", "null_distance",
     "cast(isodow(date_received) - 1 as integer) as week",
     "case when isodow(date_received) - 1 in (5, 6) then 1 else 0 end as is_weekend"]
    + [f"case when isodow(date_received) - 1 = {i} then 1 else 0 end as week_{i}" for i in range(7)]
    + [_feature_col(n) for n in MAIN_FEATURES]
    + ["case when isodow(date_received) = 7 then 1 else 0 end as week_7",
       "case when distance = -1 then 1 else 0 end as isnull_Distance"])


def _dataset(fields_sql: str, with_label: bool = True) -> str:
    lab = ",\n  label" if with_label else ""
    return (_with(BASE, fields_sql, FEATURE_TABLES, JOINED)
            + f"select distinct\n  {MAIN_DATASET_SELECT}{lab}\nfrom joined")


def _adapter_split_counts() -> str:
    sets = [("train", "1998-01-01", "1998-12-27", "1999-01-10", "1999-07-09"),
            ("validate", "1997-01-01", "1997-12-27", "1998-01-10", "1998-07-09"),
            ("test", "1999-07-01", "2000-06-25", "2000-07-09", "2001-01-05")]
    parts = []
    for name, h0, h1, l0, l1 in sets:
        for field, col, a, b in (("history", "date_received", h0, h1), ("middle", "date_used", h1, l0),
                                 ("label", "date_received", l0, l1)):
            parts.append(
                f"select '{name}' as split_set, '{field}' as field, cast(count(*) as bigint) as n_rows, "
                f"cast(count(distinct user_id) as bigint) as n_users, cast(count(date_used) as bigint) as n_used, "
                f"cast(count_if(label = 1) as bigint) as n_label1 from labelled "
                f"where {col} >= date '{a}' and {col} < date '{b}' having count(*) > 0")
    return _with(BASE) + "\nunion all\n".join(parts)


def _share(where: str, col: str) -> str:
    return (_with(BASE) + f"select {col}, cast(count(*) as bigint) as n, "
            f"cast(count(*) as double) / cast(sum(count(*)) over () as double) as share "
            f"from rep {where} group by {col}")


RAW_COLS = ["user_id", "merchant_id", "coupon_id", "discount_rate_raw", "distance_raw",
            "date_received", "date_used"]

ORACLES = {
    "clean_offline": _with(BASE) + "select * from cleaned",
    "label_15d": _with(BASE) + ("select user_id, merchant_id, coupon_id, date_received, date_used, "
                                "cast(date_diff('day', date_received, date_used) as integer) as gap_days, label "
                                "from labelled"),
    "report_clean": _with(BASE) + "select * from rep",
    "null_profile": _with(BASE) + "\nunion all\n".join(
        f"select '{c}' as column_name, cast(count_if({c} is null) as bigint) as n_null, "
        f"case when count_if({c} is null) > 0 then 1 else 0 end as has_null, "
        f"cast(count_if({c} is null) as double) / cast(count(*) as double) as null_ratio from coupon_raw"
        for c in RAW_COLS),
    "daily_received": _with(BASE) + (
        "select date_received, cast(count(coupon_id) as bigint) as n_received, "
        "case when count(coupon_id) = max(count(coupon_id)) over () then 1 else 0 end as is_max_day "
        "from rep where date_received is not null group by date_received"),
    "distance_counts": _with(BASE) + ("select distance, cast(count(*) as bigint) as n_rows from rep "
                                      "where distance <> -1 group by distance"),
    "label_rate_by_distance": _with(BASE) + (
        "select d.distance, cast(coalesce(a.n_rows, 0) as bigint) as n_rows, "
        "cast(a.n_positive as double) / cast(a.n_rows as double) as positive_rate "
        "from (select cast(range as integer) as distance from range(0, 11)) d left join "
        "(select distance, count(*) as n_rows, count_if(cheap_label = 1) as n_positive from rep "
        "where distance between 0 and 10 group by distance) a on d.distance = a.distance"),
    "received_vs_label_by_rate": _with(BASE) + (
        "select discount_rate, cast(count(*) as bigint) as n_received, "
        "cast(count_if(cheap_label = 1) as bigint) as n_positive, "
        "cast(printf('%.4f', discount_rate) as double) as rate_4dp from rep "
        "where discount_rate is not null group by discount_rate"),
    "weekday_counts": _with(BASE) + (
        "select d.weekday_receive, cast(coalesce(a.n_received, 0) as bigint) as n_received, "
        "cast(coalesce(a.n_positive, 0) as bigint) as n_positive "
        "from (select cast(range as integer) as weekday_receive from range(1, 8)) d left join "
        "(select weekday_receive, count(*) as n_received, count_if(cheap_label = 1) as n_positive "
        "from rep where weekday_receive is not null group by weekday_receive) a "
        "on d.weekday_receive = a.weekday_receive"),
    "coupon_type_share": _share("where date_received is not null", "is_manjian"),
    "coupon_type_share_positive": _share("where cheap_label = 1", "is_manjian"),
    "label_share": _share("", "cheap_label"),
    "split_windows": _adapter_split_counts(),
    **{k: _with(BASE, TRAIN_FIELDS) + v for k, v in BLOCK_SQL.items()},
    "dataset_assembled": _dataset(TRAIN_FIELDS),
    "train_union": ("select * from (" + _dataset(TRAIN_FIELDS) + ") union all select * from ("
                    + _dataset(VALIDATE_FIELDS) + ")"),
}


# ---- row-level features, calendar, user-block variant, other datasets ---------------
def _iso(col="date_received"):
    return f"cast(isodow({col}) as integer)"


CALENDAR_SQL = (
    "select user_id, coupon_id, date_received, distance, "
    f"{_iso()} as week_iso, case when {_iso()} in (5, 6) then 1 else 0 end as is_weekend_iso, "
    + ", ".join(f"case when {_iso()} = {i} then 1 else 0 end as week_{i}" for i in range(1, 8))
    + f", cast({_iso()} - 1 as integer) as week0, case when {_iso()} - 1 in (5, 6) then 1 else 0 end as is_weekend0, "
    + ", ".join(f"case when {_iso()} - 1 = {i} then 1 else 0 end as wd0_{i}" for i in range(7))
    + ", case when distance = -1 then 1 else 0 end as isnull_Distance from L0")

SIMPLE_COLS = {
    "simple_User_id_receive_cnt": "user_id",
    "simple_User_id_Coupon_id_receive_cnt": "user_id, coupon_id",
    "simple_User_id_Date_received_receive_cnt": "user_id, date_received",
    "simple_User_id_Coupon_id_Date_received_receive_cnt": "user_id, coupon_id, date_received",
}
# receipt counts as window functions over the label rows (a second formulation).
SIMPLE_SELECT = ", ".join(
    [f"cast(count(*) over (partition by {k}) as bigint) as {n}" for n, k in SIMPLE_COLS.items()]
    + ["case when count(*) over (partition by user_id, coupon_id, date_received) > 1 then 1 else 0 end "
       "as simple_User_id_Coupon_id_Date_received_repeat_receive"])

P = "history_field_User_id_"
USER_BLOCK_CTE = f"""ub as (
  select user_id,
    count(*) as rc, count(distinct merchant_id) as dm,
    count_if(date_used is not null) as cc, count_if(date_used is null) as nc,
    {_mean('case when date_used is not null then discount_rate end')} as mr,
    {_mean('case when date_used is not null and distance <> -1 then distance end')} as md,
    count(distinct case when date_used is not null then merchant_id end) as cdm
  from L0 group by user_id)"""
USER_BLOCK_SELECT = ", ".join([
    f'cast(coalesce(ub.rc, 0) as bigint) as "{P}receive_cnt"',
    f'cast(coalesce(ub.dm, 0) as bigint) as "{P}receive_differ_Merchant_cnt"',
    f'cast(coalesce(ub.cc, 0) as bigint) as "{P}receive_and_consume_cnt"',
    f'cast(coalesce(ub.nc, 0) as bigint) as "{P}receive_not_consume_cnt"',
    f'case when coalesce(ub.rc, 0) = 0 then 0.0 else cast(coalesce(ub.cc, 0) as double) / cast(ub.rc as double) end as "{P}receive_and rate"',
    f'coalesce(ub.mr, 0.0) as "{P}receive_and_consume_mean_discount_rate"',
    f'coalesce(ub.md, 0.0) as "{P}receive_and_consume_mean_distance"',
    f'cast(coalesce(ub.cdm, 0) as bigint) as "{P}receive_and_consume_differ_Merchant_cnt"',
    f'case when coalesce(ub.dm, 0) = 0 then 0.0 else cast(coalesce(ub.cdm, 0) as double) / cast(ub.dm as double) end as "{P}receive_differ_Merchant_consume_rate"',
])

COMPACT_FEATURES = [
    "consume", "min_distance_x", "max_distance_x", "mean_distance", "receive_buy_mean_rate",
    "Coupon_amount", "User_received_total_coupon", "manjian_coupon", "User_Date_received_x",
    "User_manjian_rate", "User_Date_received_special_Coupon",
    "User_if_same_Date_received_special_Coupon", "get_consume", "receive_use_mean",
    "receive_use_max", "receive_use_min", "cunsume_cnt_x", "Merchant_use_coupon_amount",
    "receive_consume_cnt", "receive_cnt_x", "cut_price", "cunsume_cnt_y", "receive_rate",
    "receive_coupon_in_different_merchant", "receive_use__coupon_in_different_merchant",
    "receive1_cnt", "User_Merchant_manjian_coupon", "User_Merchant_manjian_rate",
    "User_received_Distance", "receive_cnt_y", "User_Date_received_y", "min_discount_rate",
    "max_discount_rate", "min_distance_y", "max_distance_y", "receive_cnt",
    "Merchant_received_special_coupon", "different_rate_coupon_amount",
]

_BASE_COLS = ["user_id", "coupon_id", "date_received", "distance", "is_manjian", "discount_rate",
              "min_cost_of_manjian", "null_distance"]

COMPACT_SELECT = ",\n  ".join(
    _BASE_COLS + [f'"{n}"' for n in COMPACT_FEATURES]
    + [f"{_iso()} as week", f"case when {_iso()} in (5, 6) then 1 else 0 end as is_weekend"]
    + [f"case when {_iso()} = {i} then 1 else 0 end as week_{i}" for i in range(1, 8)]
    + ["case when distance = -1 then 1 else 0 end as isnull_Distance", "label"])

_UB_DATASET_COLS = (_BASE_COLS + list(SIMPLE_COLS) + ["simple_User_id_Coupon_id_Date_received_repeat_receive"]
                    + [P + c for c in ["receive_cnt", "receive_differ_Merchant_cnt", "receive_and_consume_cnt",
                                       "receive_not_consume_cnt", "receive_and rate",
                                       "receive_and_consume_mean_discount_rate",
                                       "receive_and_consume_mean_distance",
                                       "receive_and_consume_differ_Merchant_cnt",
                                       "receive_differ_Merchant_consume_rate"]]
                    + ["week", "is_weekend"] + [f"week_{i}" for i in range(7)] + ["label"])

USER_BLOCK_DATASET = (
    _with(BASE, TRAIN_FIELDS, USER_BLOCK_CTE)
    + "select distinct * from (select L.user_id, L.coupon_id, L.date_received, L.distance, L.is_manjian, "
    "L.discount_rate, L.min_cost_of_manjian, L.null_distance, "
    + SIMPLE_SELECT.replace("partition by user_id", "partition by L.user_id") + ", " + USER_BLOCK_SELECT
    + f", cast({_iso('L.date_received')} - 1 as integer) as week, "
    f"case when {_iso('L.date_received')} - 1 in (5, 6) then 1 else 0 end as is_weekend, "
    + ", ".join(f"case when {_iso('L.date_received')} - 1 = {i} then 1 else 0 end as week_{i}" for i in range(7))
    + ", L.label from L left join ub on L.user_id = ub.user_id) t where "
    + " and ".join(f'"{c}" is not null' for c in _UB_DATASET_COLS))

ORACLES.update({
    "feat_ratios": (_with(BASE, TRAIN_FIELDS, FEATURE_TABLES, JOINED)
                    + "select user_id, merchant_id, coupon_id, date_received, distance, "
                    + ", ".join(RATIOS) + " from joined"),
    "feat_calendar": _with(BASE, TRAIN_FIELDS) + CALENDAR_SQL,
    "receipt_counts": _with(BASE, TRAIN_FIELDS) + (
        "select user_id, merchant_id, coupon_id, date_received, " + SIMPLE_SELECT + " from L"),
    "user_block_features": (_with(BASE, TRAIN_FIELDS, USER_BLOCK_CTE)
                         + "select L0.user_id, merchant_id, coupon_id, date_received, " + USER_BLOCK_SELECT
                         + " from L0 left join ub on L0.user_id = ub.user_id"),
    "dataset_compact": (_with(BASE, TRAIN_FIELDS, FEATURE_TABLES, JOINED)
                        + f"select distinct\n  {COMPACT_SELECT}\nfrom joined"),
    "dataset_user_block": USER_BLOCK_DATASET,
})


# ---- clustering -----------------------------------------------------------------------
_FOLD_SQ = "list_reduce(list_transform(list_zip({a}, {b}), lambda s: (s[1] - s[2]) * (s[1] - s[2])), lambda u, v: u + v)"
_FOLD_ABS = "list_reduce(list_transform(list_zip({a}, {b}), lambda s: abs(s[1] - s[2])), lambda u, v: u + v)"
_FOLD_DOT = "list_reduce(list_transform(list_zip({a}, {b}), lambda s: s[1] * s[2]), lambda u, v: u + v)"

PTS = """pts as (select vec_id as id, label, cast(embedding as double[]) as p from embeddings),
ex as (select id, label, unnest(p) as x, unnest(range(len(p))) as pos from pts),
cent as (select label, list(m order by pos) as centre from (
  select label, pos, avg(x) as m
  from ex group by label, pos) group by label)"""

LLOYD = f"""d as (select pts.id, pts.p, cent.label as cluster,
   sqrt({_FOLD_SQ.format(a='pts.p', b='cent.centre')}) as dist from pts cross join cent),
asg as (select id, p, cluster from (select *, row_number() over (partition by id order by dist, cluster) as rn from d) where rn = 1),
aex as (select cluster, unnest(p) as x, unnest(range(len(p))) as pos from asg),
newc as (select cluster, max(n) as n_points, list(m order by pos) as centre from (
   select cluster, pos, count(*) as n, avg(x) as m
   from aex group by cluster, pos) group by cluster)"""

SIL = f"""xx as (select id, label as cluster, p, {_FOLD_DOT.format(a='p', b='p')} as xx from pts),
st as (select cluster, count(*) as n, sum(xx) as q from xx group by cluster),
ss as (select cluster, list(s order by pos) as sp from (
   select label as cluster, pos, sum(x) as s from ex group by label, pos)
   group by cluster),
tot as (select xx.id, xx.cluster as own, st.cluster as c, st.n,
   (cast(st.n as double) * xx.xx - 2.0 * {_FOLD_DOT.format(a='xx.p', b='ss.sp')}) + st.q as t
   from xx cross join st join ss on st.cluster = ss.cluster),
ab as (select id, own,
   max(case when c = own then n end) as own_n,
   max(case when c = own and n > 1 then t / cast(n - 1 as double) end) as a,
   min(case when c <> own then t / cast(n as double) end) as b
   from tot group by id, own),
sv as (select id, own as cluster,
   case when own_n <= 1 or b is null then 0.0
        else coalesce(case when greatest(a, b) = 0 then null else (b - a) / greatest(a, b) end, 0.0) end as s
   from ab)"""

ORACLES.update({
    "centroid_distance": _with(PTS) + (
        f"select pts.id, pts.label, sqrt({_FOLD_SQ.format(a='pts.p', b='cent.centre')}) as euclidean, "
        f"{_FOLD_ABS.format(a='pts.p', b='cent.centre')} as manhattan from pts join cent on pts.label = cent.label"),
    "lloyd_step": _with(PTS, LLOYD) + (
        "select cent.label as cluster, cast(coalesce(newc.n_points, 0) as bigint) as n_points, "
        "coalesce(newc.centre, cent.centre) as centre, "
        f"sqrt({_FOLD_SQ.format(a='cent.centre', b='coalesce(newc.centre, cent.centre)')}) as shift "
        "from cent left join newc on cent.label = newc.cluster"),
    "silhouette_labels": _with(PTS, SIL) + (
        "select cluster, cast(count(*) as bigint) as n_points, "
        f"{_mean('s')} as mean_silhouette from sv group by cluster"),
})


# ---- table reports on lineitem ----------------------------------------------------------
_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LONG = "long as (" + " union all ".join(
    f"select l_orderkey, l_linenumber, '{c}' as column_name, cast({c} as double) as value from lineitem"
    for c in _LINE) + ")"

ORACLES.update({
    "column_sums": _with("s as (" + " union all ".join(
        f"select '{c}' as column_name, sum(cast({c} as decimal(18,9))) as total from lineitem" for c in _LINE)
        + ")") + ("select column_name, cast(total as double) as total, "
                  "cast(total as double) / cast(sum(total) over () as double) as share from s"),
    "box_stats": _with(_LONG, """q as (select column_name, quantile_cont(value, 0.25) as q1,
        quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3 from long group by column_name),
      f as (select *, q1 - 1.5 * (q3 - q1) as lo_fence, q3 + 1.5 * (q3 - q1) as hi_fence from q)""")
    + """select long.column_name, q1, median, q3,
        min(case when value >= lo_fence and value <= hi_fence then value end) as whisker_low,
        max(case when value >= lo_fence and value <= hi_fence then value end) as whisker_high,
        cast(count_if(value is not null and not (value >= lo_fence and value <= hi_fence)) as bigint) as n_outliers
      from long join f on long.column_name = f.column_name group by long.column_name, q1, median, q3""",
    "long_series": _with(_LONG) + "select * from long",
})


ORACLES["user_block_history"] = (
    _with(BASE, TRAIN_FIELDS, USER_BLOCK_CTE.replace("from L0 group by user_id", "from H group by user_id"))
    + "select L0.user_id, merchant_id, coupon_id, date_received, " + USER_BLOCK_SELECT
    + " from L0 left join ub on L0.user_id = ub.user_id")

# last bits of double sums vary with their order: compared to 9 decimals
ORACLES["centroid_distance"] = ("select id, label, round(euclidean, 9) as euclidean, round(manhattan, 9) as manhattan from ("
                                + ORACLES["centroid_distance"] + ")")
ORACLES["lloyd_step"] = ("select cluster, n_points, list_transform(centre, lambda x: round(x, 9)) as centre, "
                         "round(shift, 9) as shift from (" + ORACLES["lloyd_step"] + ")")


# area under the ROC curve by ranks: a positive row beats the negative rows below it and half of those beside it
ORACLES["rank_auc"] = _with(BASE, TRAIN_FIELDS, "s as (" + " union all ".join(
    f"select '{c}' as feature, cast(month(date_received) as integer) as received_month, cast({c} as double) as score, label from L0"
    for c in ("distance", "discount_rate", "min_cost_of_manjian", "is_manjian")) + ")", """c as (
  select feature, received_month, score, count_if(label = 1) as pos, count_if(label = 0) as neg from s
  where score is not null group by all),
b as (select *, coalesce(sum(neg) over (partition by feature, received_month order by score
        rows between unbounded preceding and 1 preceding), 0) as below from c)""") + """
select feature, received_month, cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg,
  case when sum(pos) * sum(neg) > 0 then (cast(sum(pos * (2 * below + neg)) as double) / 2.0)
    / (cast(sum(pos) as double) * cast(sum(neg) as double)) end as auc
from b group by feature, received_month"""


# ---- files --------------------------------------------------------------------------------
ORACLES["csv_round_trip"] = _with(f"coupon_raw as ({COUPON_RAW_SQL})") + """select user_id, merchant_id, coupon_id, discount_rate_raw,
  cast(case when user_id % 97 <> 0 then distance_raw end as bigint) as distance_raw, date_received,
  case when merchant_id % 13 <> 0 then date_used end as date_used,
  nullif(concat_ws('; ', case when user_id % 97 = 0 then 'Distance: far' end,
                   case when merchant_id % 13 = 0 and date_used is not null then 'Date: 20161345' end), '') as reason
from coupon_raw"""
ORACLES["whitespace_round_trip"] = """select cast(l_orderkey as double) as _c0, cast(l_linenumber as double) as _c1,
  cast(l_quantity as double) as _c2, cast(l_extendedprice as double) as _c3, cast(l_discount as double) as _c4,
  case when l_linenumber <> 7 then cast(l_tax as double) end as _c5 from lineitem"""
ORACLES["registry_round_trip"] = """with v as (select l_returnflag as f, cast(l_quantity as double) as q, cast(l_discount as double) as d
  from lineitem)
select 'abalone' as dataset, [case f when 'A' then 0.0::double when 'N' then 1.0::double when 'R' then 2.0::double end, q, d] as p from v
union all select 'iris', [q, d] from v union all select 'wholesale', [q, d] from v"""


# ---- principal axes and Lloyd passes -----------------------------------------------------------
def _axis(name: str, matrix: str) -> str:
    """The dominant axis of a symmetric matrix by squaring it 20 times, largest part positive."""
    return f"""{name}_pow(n, m) as (select 0, m from {matrix}
  union all
  select n + 1, list_transform(sq, lambda r: list_transform(r, lambda x: x / t)) from (
    select n, sq, list_sum(list_transform(range(1, len(sq) + 1), lambda i: sq[i][i])) as t from (
      select n, list_transform(m, lambda r: list_transform(m, lambda s: list_dot_product(r, s))) as sq
      from {name}_pow where n < 20))),
{name}_row as (select list_reduce(m, lambda a, b: case when list_dot_product(a, a) >= list_dot_product(b, b) then a else b end) as r
  from {name}_pow where n = 20),
{name} as (select list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))
    * case when r[list_position(list_transform(r, lambda y: abs(y)), list_max(list_transform(r, lambda y: abs(y))))] < 0 then -1 else 1 end) as v
  from {name}_row)"""


PCA = f"""pts as (select vec_id as id, cast(embedding as double[]) as p from embeddings),
ex0 as (select id, unnest(p) as x, unnest(range(len(p))) as pos from pts),
mean as (select list(m order by pos) as m from (select pos, avg(x) as m from ex0 group by pos)),
cen as (select id, list_transform(list_zip(p, m), lambda s: s[1] - s[2]) as p from pts cross join mean),
ex as (select id, unnest(p) as x, unnest(range(len(p))) as pos from cen),
cov as (select list(r order by i) as m from (select i, list(c order by j) as r from (
   select a.pos as i, b.pos as j, sum(a.x * b.x) as c from ex a join ex b on a.id = b.id group by a.pos, b.pos) group by i)),
cov1 as (select list_transform(m, lambda r: list_transform(r, lambda x: x / t)) as m
  from (select m, list_sum(list_transform(range(1, len(m) + 1), lambda i: m[i][i])) as t from cov)),
{_axis('a1', 'cov1')},
cov2 as (select list_transform(range(1, len(v) + 1), lambda i: list_transform(range(1, len(v) + 1), lambda j: m[i][j] - l * v[i] * v[j])) as m
  from (select m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) as l from cov1 cross join a1)),
{_axis('a2', 'cov2')},
flat as (select id, round(list_dot_product(p, a1.v), 6) + 0.0 as x, round(list_dot_product(p, a2.v), 6) + 0.0 as y
  from cen cross join a1 cross join a2)"""


def _lloyd(ks: str) -> str:
    """Every Lloyd pass of every k: centres by md5 order, sums as whole numbers of 2**-40, 21 passes at most."""
    grid = "cast(sum(cast(floor({0} * 1099511627776.0 + 0.5) as hugeint)) as double) / (cast(count(*) as double) * 1099511627776.0)"
    return f"""ks as (select unnest({ks}) as k),
drawn as (select x, y, row_number() over (order by md5(concat(id, '-7')), id) as r from flat),
start as (select k, list([x, y] order by r) as c from ks join drawn on r <= k group by k),
loop(k, pass, c, used, stop) as (select k, 0, c, c, false from start
  union all
  select k, pass + 1, case when shift > 0.0001 then new else c end, c, shift <= 0.0001 from (
    select k, pass, c, new, list_sum(list_transform(list_zip(c, new), lambda s:
        sqrt((s[1][1] - s[2][1]) * (s[1][1] - s[2][1]) + (s[1][2] - s[2][2]) * (s[1][2] - s[2][2])))) as shift from (
      select k, pass, c, list_transform(range(1, len(c) + 1), lambda i: coalesce(map_extract(means, i)[1], c[i])) as new from (
        select k, pass, c, map(list(i), list([mx, my])) as means from (
          select k, pass, c, i, {grid.format('x')} as mx, {grid.format('y')} as my from (
            select k, pass, c, x, y, list_position(d, list_min(d)) as i from (
              select k, pass, c, x, y, list_transform(c, lambda q: sqrt((x - q[1]) * (x - q[1]) + (y - q[2]) * (y - q[2]))) as d
              from loop cross join flat where not stop and pass < 21))
          group by k, pass, c, i)
        group by k, pass, c)))),
done as (select k, c, used from loop qualify row_number() over (partition by k order by pass desc) = 1),
asg as (select k, id, x, y, list_position(d, list_min(d)) - 1 as cluster from (
  select k, id, x, y, list_transform(used, lambda q: sqrt((x - q[1]) * (x - q[1]) + (y - q[2]) * (y - q[2]))) as d from done cross join flat)),
st as (select k, cluster, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x + y * y) as q from asg group by k, cluster),
tot as (select a.k, a.id, a.cluster as own, st.cluster as c, st.n,
  greatest(st.n * (a.x * a.x + a.y * a.y) - 2 * (a.x * st.sx + a.y * st.sy) + st.q, 0) as t from asg a join st using (k)),
ab as (select k, id, own, max(case when c = own then n end) as own_n, max(case when c = own and n > 1 then t / (n - 1) end) as a,
  min(case when c <> own then t / n end) as b from tot group by k, id, own),
sv as (select k, id, own as cluster, case when own_n <= 1 or b is null then 0.0
  else coalesce(case when greatest(a, b) = 0 then null else (b - a) / greatest(a, b) end, 0.0) end as s from ab)"""


_RECURSIVE = "with recursive "
ORACLES["pca_2d"] = _RECURSIVE + PCA + "\nselect id, x, y from flat"
ORACLES["lloyd_kmeans"] = (_RECURSIVE + PCA + ",\n" + _lloyd("[3]")
                           + "\nselect id, cast(cluster as integer) as cluster, x, y from asg")
ORACLES["choose_k"] = (_RECURSIVE + PCA + ",\n" + _lloyd("range(2, 11)") + """,
score as (select cast(k as integer) as k, avg(s) as s from sv group by k)
select k, round(s, 9) as silhouette, case when row_number() over (order by s desc, k) = 1 then 1 else 0 end as chosen from score""")
ORACLES["cluster_report"] = (_RECURSIVE + PCA + ",\n" + _lloyd("[3]") + """,
part as (select cluster, cast(count(*) as bigint) as n_points, round(avg(x), 9) as x, round(avg(y), 9) as y from asg group by cluster)
select cast(cluster as integer) as cluster, n_points, x, y, round(avg(s), 9) as mean_silhouette
from part join sv using (cluster) group by all""")
ORACLES["silhouette_euclidean"] = _with(PTS, f"""pair as (select a.id, a.label as own, b.label as c, sum(sqrt({_FOLD_SQ.format(a='a.p', b='b.p')})) as s,
  count(*) as n from pts a cross join pts b group by a.id, a.label, b.label),
ab as (select id, own, max(case when c = own and n > 1 then s / (n - 1) end) as a, min(case when c <> own then s / n end) as b
  from pair group by id, own),
sv as (select own as cluster, case when a is null or b is null or greatest(a, b) = 0 then 0.0 else (b - a) / greatest(a, b) end as s from ab)
""") + "select cluster, cast(count(*) as bigint) as n_points, round(avg(s), 9) as mean_silhouette from sv group by cluster"
