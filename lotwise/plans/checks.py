"""The registered queries again, as SQL over the same tables.

Written from the definitions, with window functions in place of the library's
aggregate-and-join, so that each query is checked by another way of computing it.
"""

from __future__ import annotations

from lotwise.sources.standin import LISTINGS_SQL, TABLES

LISTINGS = f"listings as ({LISTINGS_SQL.format(**{name: name for name in TABLES})})"

STANDARD = """standard as (
  select id, region, state, price, year, upper(manufacturer) as manufacturer,
    upper(model) as model, odometer, upper(vin) as vin, lower(title_status) as title_status,
    lat, long, event_time
  from listings)"""

_INT_YEAR = "cast(trunc(try_cast(year as double)) as int)"

CLEAN_BATCH = f"""clean_batch as (
  select id, region, price, {_INT_YEAR} as year, manufacturer, model,
    coalesce(odometer, -1.0) as odometer, vin, coalesce(title_status, 'clean') as title_status,
    lat, long
  from standard
  where manufacturer is not null and model is not null and year is not null
    and price > 500 and price < 200000)"""

CLEAN_LIVE = f"""clean_live as (
  select id, price, case when {_INT_YEAR} is null or {_INT_YEAR} = 0 then 1900
    else {_INT_YEAR} end as year, manufacturer, model, coalesce(odometer, -1.0) as odometer, vin
  from standard where price > 500 and price < 200000)"""


def _placed(name: str, source: str) -> str:
    return f"""{name}_placed as (
  select *, round(avg(price) over segment, 2) as market_avg_price,
    round(stddev_samp(price) over segment, 2) as market_std_dev_price,
    round(avg(odometer) over segment, 0) as market_avg_odometer,
    round(stddev_samp(odometer) over segment, 0) as market_std_dev_odometer,
    count(id) over segment as group_count
  from {source} window segment as (partition by manufacturer, model, year))"""


BATCH_SCORES = """batch_scores as (
  select *, (price - market_avg_price)
    / case when market_std_dev_price = 0 then 1 else market_std_dev_price end as price_z_score
  from batch_placed)"""

LIVE_SCORES = """live_scores as (
  select *, (price - market_avg_price) / case when market_std_dev_price > 0
      then market_std_dev_price else 1 end as price_z_score,
    (odometer - market_avg_odometer) / case when market_std_dev_odometer > 0
      then market_std_dev_odometer else 1 end as odometer_z_score
  from live_placed)"""

_LETTERS = ", ".join(f"'{letter}'" for letter in "ABCDEFGHJKLMNP")


def _trusted(name: str, source: str) -> str:
    return f"""{name}_decoded as (
  select *, substr(vin, 10, 1) as vin_year_code,
    cast(coalesce(2009 + list_position([{_LETTERS}], substr(vin, 10, 1)), 0) as int)
      as decoded_vin_year
  from {source}),
{name}_flagged as (
  select *,
    coalesce(decoded_vin_year > 0 and (decoded_vin_year > year + 1 or decoded_vin_year < year - 1),
      false) as is_year_mismatch,
    coalesce(year < 2020 and odometer > 0 and odometer < 2000, false) as is_suspicious_mileage
  from {name}_decoded),
{name}_trusted as (
  select *, case when is_year_mismatch and is_suspicious_mileage then 20
    when is_year_mismatch then 50 when is_suspicious_mileage then 70 else 100 end as trust_score
  from {name}_flagged)"""


BATCH_FINAL = """batch_final as (
  select *, market_avg_price as national_avg_price,
    market_avg_price - price as arbitrage_opportunity,
    market_avg_price - price > 2000 as is_sourcing_hub,
    case when trust_score in (20, 50) then 'RISKY_BUY'
      when group_count <= 4 then 'INSUFFICIENT_DATA'
      when price_z_score < -1.5 then 'GREAT_DEAL'
      when price_z_score <= -0.5 then 'GOOD_PRICE'
      when price_z_score <= 0.5 then 'FAIR_MARKET'
      else 'OVERPRICED' end as deal_rating
  from batch_trusted)"""

LIVE_FINAL = """live_final as (
  select *, market_avg_price - price as arbitrage_opportunity,
    case when trust_score in (20, 50) then 'RISKY_BUY'
      when group_count <= 4 then 'INSUFFICIENT_DATA'
      when market_std_dev_price / market_avg_price > 0.20e0 then 'VOLATILE_MARKET'
      when price_z_score < -1.5 then
        case when odometer_z_score > 1.5 then 'GOOD_PRICE' else 'GREAT_DEAL' end
      when price_z_score <= -0.5 then 'GOOD_PRICE'
      when price_z_score <= 0.5 then 'FAIR_MARKET'
      when price_z_score < 3 then 'OVERPRICED'
      else 'EXTREME_OVERPRICE' end as deal_rating
  from live_trusted)"""

BATCH_PLACED = [LISTINGS, STANDARD, CLEAN_BATCH, _placed("batch", "clean_batch"), BATCH_SCORES]
BATCH = [*BATCH_PLACED, _trusted("batch", "batch_scores"), BATCH_FINAL]
BATCH_TRUST = [LISTINGS, STANDARD, CLEAN_BATCH, _trusted("batch", "clean_batch")]
LIVE_PLACED = [LISTINGS, STANDARD, CLEAN_LIVE, _placed("live", "clean_live"), LIVE_SCORES]
LIVE = [*LIVE_PLACED, _trusted("live", "live_scores"), LIVE_FINAL]


def _with(parts: list[str], select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


LISTING = "id, region, state, price, year, manufacturer, model, odometer, title_status, lat, long"

GREAT_DEALS = """select id, manufacturer, model, price, round(price_z_score, 2) as "Price_Z_Score",
  round(odometer_z_score, 2) as "Odometer_Z_Score",
  round(arbitrage_opportunity, 2) as "Arbitrage_Value", deal_rating
from live_final where deal_rating in ('GREAT_DEAL', 'GOOD_PRICE') and price_z_score < -1.5"""

RISKY = """select id, manufacturer, model, price, trust_score,
  case when is_year_mismatch then 'Year Mismatch' else '' end as "Fraud_Flag"
from live_final where deal_rating = 'RISKY_BUY'"""

VOLATILE = """select distinct manufacturer, model, year, market_avg_price as "Avg_Price",
  market_std_dev_price as "Std_Dev_Price",
  round(market_std_dev_price / market_avg_price * 100, 1) as "StdDev_as_Pct_of_Avg"
from live_final where deal_rating = 'VOLATILE_MARKET'"""

OVERPRICE = """select id, manufacturer, model, price, round(price_z_score, 2) as "Price_Z_Score",
  market_avg_price as "Avg_Price"
from live_final where deal_rating = 'EXTREME_OVERPRICE'"""

SUMMARY = """select manufacturer, model, round(avg(price), 2) as avg_price,
  round(stddev_samp(price), 2) as price_std_dev, count(*) as listings_count,
  max(event_time) as last_data_received
from standard group by manufacturer, model"""

FINAL_ROWS = """select id, manufacturer, model, price, trust_score, arbitrage_opportunity,
  deal_rating from batch_final"""

PUBLISHED = """select id, manufacturer, model, year, price, odometer, region, lat, long, vin,
  trust_score, is_year_mismatch, national_avg_price, arbitrage_opportunity, is_sourcing_hub,
  deal_rating from batch_final"""

BASIC = """select id, manufacturer, model, price, market_avg_price,
  case when group_count <= 4 then 'INSUFFICIENT_DATA'
    when price_z_score < -1.5 then 'GREAT DEAL'
    when price_z_score <= -0.5 then 'GOOD PRICE'
    when price_z_score <= 0.5 then 'FAIR MARKET'
    when price_z_score <= 1.5 then 'SLIGHTLY HIGH'
    else 'OVERPRICED' end as deal_rating
from batch_scores"""

HUBS = """select id, region, manufacturer, model, price, market_avg_price as national_avg_price,
  market_avg_price - price as arbitrage_opportunity
from batch_scores where market_avg_price - price > 2000"""

LOW_TRUST = """select id, vin, year, decoded_vin_year, odometer, trust_score
from batch_trusted where trust_score < 100"""

# The four alert lists under one another, with the columns of all of them.
ALL_ALERTS = f"""select 'great_deals' as alert, id, manufacturer, model, null::int as year, price,
  "Price_Z_Score", "Odometer_Z_Score", "Arbitrage_Value", deal_rating, null::int as trust_score,
  null::varchar as "Fraud_Flag", null::double as "Avg_Price", null::double as "Std_Dev_Price",
  null::double as "StdDev_as_Pct_of_Avg"
from ({GREAT_DEALS})
union all select 'risky_buys', id, manufacturer, model, null, price, null, null, null, null,
  trust_score, "Fraud_Flag", null, null, null from ({RISKY})
union all select 'volatile_segments', null, manufacturer, model, year, null, null, null, null,
  null, null, null, "Avg_Price", "Std_Dev_Price", "StdDev_as_Pct_of_Avg" from ({VOLATILE})
union all select 'extreme_overprices', id, manufacturer, model, null, price, "Price_Z_Score",
  null, null, null, null, null, "Avg_Price", null, null from ({OVERPRICE})"""

METRICS = f"""select 'received_rows' as metric, count(*) as value, 0 as batch_id from standard
union all select 'segments', count(*), 0 from (select distinct manufacturer, model from standard)
union all select 'great_deals', count(*), 0 from ({GREAT_DEALS})
union all select 'risky_buys', count(*), 0 from ({RISKY})
union all select 'extreme_overprices', count(*), 0 from ({OVERPRICE})
union all select 'volatile_segments', count(*), 0 from ({VOLATILE})"""

_ROWS_ONLY = f'select {LISTING}, vin as "VIN"'

ORACLES: dict[str, str] = {
    "src_csv_roundtrip": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
    "src_csv_breaks": _with(
        [LISTINGS],
        """select id, price, state,
  region || chr(10) || '"' || model || '", sold' || chr(10) as description from listings""",
    ),
    "src_json_encode": _with(
        [LISTINGS],
        """select id, cast(json_merge_patch('{}', json_object('id', id, 'region', region,
  'state', state, 'price', price, 'year', year, 'manufacturer', manufacturer, 'model', model,
  'odometer', odometer, 'VIN', vin, 'title_status', title_status, 'lat', lat, 'long', long))
  as varchar) as message from listings""",
    ),
    "src_json_decode": _with(
        [LISTINGS], f"{_ROWS_ONLY}, null::varchar as condition, event_time from listings"
    ),
    "src_first_n_small": _with([LISTINGS], f"select {LISTING} from listings order by id limit 100"),
    "src_first_n": _with([LISTINGS], f"select {LISTING} from listings order by id limit 10000"),
    "prj_standardize": _with(
        [LISTINGS, STANDARD], "select id, manufacturer, model, vin, title_status from standard"
    ),
    "prj_cast": _with([LISTINGS], f"select id, {_INT_YEAR} as year, odometer from listings"),
    "flt_required": _with(
        [LISTINGS],
        f"""select {LISTING} from listings where manufacturer is not null and model is not null
  and year is not null and price is not null""",
    ),
    "flt_price_range": _with(
        [LISTINGS], f"select {LISTING} from listings where price > 500 and price < 200000"
    ),
    "imp_constants": _with(
        [LISTINGS],
        """select id, coalesce(odometer, -1.0) as odometer,
  coalesce(title_status, 'clean') as title_status from listings""",
    ),
    "imp_year": _with(
        [LISTINGS],
        f"select id, coalesce(nullif({_INT_YEAR}, 0), 1900) as year from listings",
    ),
    "imp_nan_null": _with([LISTINGS], "select id, odometer, lat, long from listings"),
    "win_price_stats": _with(
        BATCH_PLACED,
        """select id, manufacturer, model, year, market_avg_price, market_std_dev_price, group_count
from batch_placed""",
    ),
    "win_price_stats_sliced": _with(
        BATCH_PLACED,
        """select id, manufacturer, model, year, market_avg_price, market_std_dev_price, group_count
from batch_placed""",
    ),
    "win_odometer_stats": _with(
        LIVE_PLACED,
        """select id, manufacturer, model, year, market_avg_odometer, market_std_dev_odometer,
  group_count from live_placed""",
    ),
    "scr_price_z": _with(BATCH_PLACED, "select id, price, price_z_score from batch_scores"),
    "scr_price_z_stream": _with(LIVE_PLACED, "select id, price, price_z_score from live_scores"),
    "scr_odometer_z": _with(
        LIVE_PLACED, "select id, odometer, odometer_z_score from live_scores"
    ),
    "vin_decode": _with(
        [LISTINGS, STANDARD, _trusted("vin", "(select *, null::int as year from (select id, vin, "
         "odometer from standard))")],
        "select id, vin, vin_year_code, decoded_vin_year from vin_decoded",
    ),
    "frd_flags": _with(
        BATCH_TRUST, "select id, year, is_year_mismatch, is_suspicious_mileage from batch_trusted"
    ),
    "frd_trust": _with(BATCH_TRUST, "select id, trust_score from batch_trusted"),
    "flt_low_trust": _with(BATCH_TRUST, LOW_TRUST),
    "geo_arbitrage": _with(
        BATCH,
        """select id, region, price, national_avg_price, arbitrage_opportunity, is_sourcing_hub
from batch_final""",
    ),
    "flt_sourcing_hub": _with(BATCH_PLACED, HUBS),
    "rate_basic": _with(BATCH_PLACED, BASIC),
    "rate_batch": _with(BATCH, FINAL_ROWS),
    "rate_stream": _with(
        LIVE,
        """select id, manufacturer, model, year, price, group_count, trust_score, price_z_score,
  odometer_z_score, deal_rating from live_final""",
    ),
    "agg_rating_counts": _with(
        LIVE, "select deal_rating, count(*) as listings from live_final group by deal_rating"
    ),
    "agg_clean_counts": _with(
        [LISTINGS, STANDARD, CLEAN_BATCH, CLEAN_LIVE],
        """select (select count(*) from listings) as raw_rows,
  (select count(*) from listings where manufacturer is not null and model is not null
    and year is not null and price is not null) as complete_rows,
  (select count(*) from clean_live) as priced_rows,
  (select count(*) from clean_batch) as clean_rows""",
    ),
    "agg_segment_summary": _with([LISTINGS, STANDARD], SUMMARY),
    "top_segments": _with(
        [LISTINGS, STANDARD],
        f"""select * from ({SUMMARY}) order by listings_count desc, manufacturer nulls first,
  model nulls first limit 20""",
    ),
    "alr_great_deals": _with(LIVE, GREAT_DEALS),
    "alr_risky": _with(LIVE, RISKY),
    "alr_volatile": _with(LIVE, VOLATILE),
    "alr_overprice": _with(LIVE, OVERPRICE),
    "preview_clean": _with(
        [LISTINGS, STANDARD, CLEAN_BATCH],
        """select id, manufacturer, model, year, price, odometer, title_status from clean_batch
order by id limit 5""",
    ),
    "preview_basic_rating": _with(BATCH_PLACED, f"{BASIC} order by id limit 10"),
    "preview_low_trust": _with(BATCH_TRUST, f"{LOW_TRUST} order by id limit 5"),
    "preview_sourcing_hubs": _with(BATCH_PLACED, f"{HUBS} order by id limit 5"),
    "preview_final": _with(BATCH, f"{FINAL_ROWS} order by id limit 5"),
    "batch_publish": _with(
        BATCH, f"select *, timestamp '2001-08-02 00:00:00' as processed_at from ({PUBLISHED})"
    ),
    "snk_overwrite": _with(BATCH, PUBLISHED),
    "snk_publish_version": _with(BATCH, PUBLISHED),
    "snk_append_once": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
    "str_dead_letters": _with(
        [LISTINGS],
        """select id as "offset", case when bad then reason end as reason, case when not bad then id end as id,
  case when not bad then price end as price, case when not bad then model end as model
from (select *, id % 7 = 0 or id % 11 = 0 or id % 13 = 0 as bad,
  case when id % 7 = 0 or id % 11 = 0 then 'broken or ill-typed JSON' else 'empty' end as reason from listings)""",
    ),
    "str_score_alerts": _with(LIVE, ALL_ALERTS),
    "str_segment_summary": _with(
        [LISTINGS, STANDARD], f"select *, 0 as batch_id from ({SUMMARY})"
    ),
    "str_batch_metrics": _with(LIVE, METRICS),
    "snk_stream_append": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
    "snk_batches_by_bytes": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
    "str_latency": _with(
        [LISTINGS],
        """select count(*) as loaded_rows, max(event_time) as newest_message,
  epoch(timestamp '2001-08-02 00:00:00' - max(event_time)) as latency_seconds, 0 as batch_id
from listings""",
    ),
    "str_restart": _with(
        [LISTINGS],
        f"""{_ROWS_ONLY}, case when event_time < timestamp '1998-01-01 00:00:00' then 0 else 1 end
  as batch_id from listings""",
    ),
    "snk_new_checkpoint": _with([LISTINGS], f"{_ROWS_ONLY}, 0 as batch_id from listings"),
    "str_empty_batch": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
    "str_idle_stop": _with([LISTINGS], f"{_ROWS_ONLY} from listings"),
}
