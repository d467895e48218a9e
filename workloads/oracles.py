"""The same questions as ``queries``, asked in plain SQL for DuckDB.

Written from the definitions, not from the Spark plans: unions, self joins,
count(distinct ...) and one CASE per metric are kept where the marts avoid them.
"""

from __future__ import annotations

from workloads.standins import with_standins

_SQL: dict[str, str] = {}

# --- sources and sinks ------------------------------------------------------

_SQL["scan_parquet"] = """
select l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate from lineitem"""
_SQL["scan_dated"] = "select event_id, ts, user_id, event_type, value from events"
_SQL["scan_snapshot"] = """
select event_id, ts, user_id, event_type, value, cast(ts as date) as dt from events
where cast(ts as date) = date '2024-01-17'"""
_SQL["scan_csv_dim"] = """
select business_service_key, business_service_type_key, revenue_stream from dim_bls_content_list"""
_SQL["sink_roundtrip"] = "select * from fmc_order_data"
_EVENTS = "select event_id, ts, user_id, event_type, value, cast(ts as date) as dt from events"
_SQL["sink_overwrite_date"] = """
select event_id, ts, user_id, event_type,
  case when cast(ts as date) = date '2024-01-15' then value * 2 else value end as value,
  cast(ts as date) as dt from events where cast(ts as date) <> date '2024-01-16'"""
_SQL["table_partitioned_parquet"] = _EVENTS
_SQL["table_partitioned_orc"] = _EVENTS
_SQL["table_partition_swap"] = f"""
select * from ({_EVENTS}) e where dt not in (date '2024-01-10', date '2024-01-11', date '2024-01-15')
union all select event_id, ts, user_id, event_type, value + 1, dt from ({_EVENTS}) e where dt = date '2024-01-15'
union all select event_id, ts, user_id, event_type, value + 1, date '2024-02-15' from ({_EVENTS}) e
  where dt = date '2024-01-15'"""
_SQL["balances_snapshot"] = "select * from balance_archive where dt = date '2024-03-15'"

# --- filters, windows of days, classifications ---------------------------------

_SQL["filter_predicates"] = """
select id, order_status_id, fmc_type_id, login_fttb from fmc_order_data
where order_status_id in (414, 14, 4) and fmc_type_id not in ('3') and pre_order_status_id is null
  and login_fttb is not null and user_id <> sl_dealer_cd
  and (mon_dealer_cd >= 3 and user_id > 5 or sl_dealer_cd < 4)"""
_SQL["filter_time_range"] = """
select * from csm_transactions where sys_creation_date >= timestamp '2024-01-10 08:00:00'
  and sys_creation_date < timestamp '2024-01-12 14:30:00'"""
_SQL["trailing_window"] = """
select subs_key,
  count(*) filter (where d >= date '2024-04-01' - 7 and d < date '2024-04-01') as before_7,
  count(*) filter (where d >= date '2024-04-01' - 30 and d < date '2024-04-01') as before_30,
  count(*) filter (where d >= date '2024-04-01' - 90 and d < date '2024-04-01') as before_90,
  count(*) filter (where d >= date '2024-03-31' - 6 and d <= date '2024-03-31') as upto_7,
  count(*) filter (where d >= date '2024-03-31' - 29 and d <= date '2024-03-31') as upto_30,
  count(*) filter (where d >= date '2024-03-31' - 89 and d <= date '2024-03-31') as upto_90
from (select subs_key, cast(call_start_time as date) as d from det_layer) u group by subs_key"""
_SEGMENT = """case when account_type in ('13', '113', '37', '39') then 'B2C'
  when account_type = '41' then 'B2B' end"""
_LANGUAGE = "case soc when 'ICLM_RUS' then 'RUS' when 'ICLM_KAZ' then 'KAZ' end"
_SQL["segment_case"] = f"""
select {_SEGMENT} as segment_type, {_LANGUAGE} as language, count(*) as rows,
  cast(sum(o.ban) as bigint) as ban_sum
from service_option o left join billing_account b on o.ban = b.ban group by 1, 2"""
_SQL["effective_dated_lookup"] = """
select 'number' as kind, fmc_order_id as id from fmc_gsm
  where expiration_date is null or expiration_date > date '2024-04-01'
union all select 'operator', cast(id as bigint) from operators where td >= date '2000-01-01'"""

# --- the cell dimension, hourly usage and what builds on them --------------------

_PLACES = """dir_sites s join dir_city c on s.addr_id_city = c.id_city
  join dir_city_type ct on c.id_city_type = ct.id_city_type join dir_area a on c.id_area = a.id_area
  join dir_region g on a.id_region = g.id_region join dir_bts b on s.site_id = b.site_id
  join dir_btsstatus bs on b.id_btsstatus = bs.id_btsstatus join dir_btstype bt on b.id_btstype = bt.id_btstype
  join dir_sector r on b.id_bts = r.id_bts and r.cell_status in ('test', 'active')"""


def _sectors(nets: str, cell: str) -> str:
    return f"""select g.name_region as region, a.area_name as district, c.city_name as city,
  ct.city_type_name as city_type, r.lac_tac as lac, {cell} as cell_id, r.cell_nettype,
  b.inservice_date, b.id_bts from {_PLACES} and r.cell_nettype in ({nets})"""


_CELLS = f"""cells as (
  select region, district, city, city_type, lac, cell_id, cell_nettype from (
    select *, row_number() over (partition by lac, cell_id order by inservice_date desc nulls last,
      id_bts desc nulls last, cell_nettype desc nulls last) as rn
    from ({_sectors("'2G', '3G'", "r.cell_id")} union all {_sectors("'4G'", "b.enodeb_id")}) u) v
  where rn = 1)"""
_HOURLY = """hourly as (
  select cast(call_start_time as date) as period, strftime(call_start_time, '%H') as hhour_id,
    subs_key, ban_key, cast(trim(lac) as bigint) as lac, cast(trim(cell_id) as bigint) as cell_id,
    count(*) filter (where call_type_code = 'V' and call_direction_ind = '2') as call_out_amt,
    count(*) filter (where call_type_code = 'V' and call_direction_ind = '1') as call_in_amt,
    cast(coalesce(sum(actual_call_duration_sec)
      filter (where call_type_code = 'V' and call_direction_ind = '2'), 0) as decimal(28,1)) as out_sec,
    cast(coalesce(sum(actual_call_duration_sec)
      filter (where call_type_code = 'V' and call_direction_ind = '1'), 0) as decimal(28,1)) as in_sec,
    cast(coalesce(sum(rounded_data_volume) filter (where call_type_code = 'G'), 0) as bigint) as bytes
  from det_layer
  where (counted_cdr_ind = '1' or charge_amt <> 0) and call_forward_ind <> 1 and call_type_code in ('V', 'G')
    and (roaming_ind = '0' and roaming_type_key in ('H', 'X') or roaming_ind = '1' and roaming_type_key = 'R')
  group by 1, 2, 3, 4, 5, 6)"""
_SQL["cell_site_actual"] = f"with {_CELLS} select * from cells"
_SQL["usage_hourly"] = f"""
with {_HOURLY} select period, hhour_id, subs_key, ban_key, lac, cell_id, call_out_amt, call_in_amt,
  cast(out_sec as double) / 60 as call_out_duration_min, cast(in_sec as double) / 60 as call_in_duration_min,
  bytes / 1048576 as data_vlm_mb, out_sec as call_out_sec, in_sec as call_in_sec, bytes as data_bytes
from hourly"""
_SQL["voice_data_equivalent"] = f"""
with {_CELLS}, {_HOURLY}
select period, hhour_id, subs_key, ban_key, h.lac, h.cell_id, cell_nettype,
  (cast(in_sec as double) / 60 + cast(out_sec as double) / 60) * 60 * case when cell_nettype = '3G' then cast(21.4 as double)
    when cell_nettype = '4G' then cast(0 as double)
    when cell_nettype = '2G' or cell_nettype is null then cast(20 as double) end / 8192
  + bytes / 1048576 as eq_mb
from hourly h left join cells c on h.lac = c.lac and h.cell_id = c.cell_id"""


def _region_usage(days: int) -> str:
    return f"""{_CELLS}, {_HOURLY}, region_usage as (
  select date '2024-04-01' as calc_date, subs_key, ban_key, region,
    count(distinct period) as uniq_days_amt,
    cast(sum(call_out_amt) as bigint) as call_out_amt, cast(sum(call_in_amt) as bigint) as call_in_amt,
    cast(cast(sum(in_sec) as decimal(28,1)) as double) / 60 as call_in_duration_min,
    cast(cast(sum(out_sec) as decimal(28,1)) as double) / 60 as call_out_duration_min,
    cast(sum(bytes) as bigint) / 1048576 as data_vlm_mb,
    case when count(*) filter (where cell_nettype is null or cell_nettype in ('2G', '3G', '4G')) > 0 then
      (cast(coalesce(sum(in_sec + out_sec) filter (where cell_nettype is null or cell_nettype = '2G'), 0) as double)
        * cast(20 as double)
      + cast(coalesce(sum(in_sec + out_sec) filter (where cell_nettype = '3G'), 0) as double)
        * cast(21.4 as double)) / 8192
      + cast(coalesce(sum(bytes) filter
          (where cell_nettype is null or cell_nettype in ('2G', '3G', '4G')), 0) as bigint) / 1048576
    end as voice_gprs_mrg_mb
  from hourly h left join cells c on h.lac = c.lac and h.cell_id = c.cell_id
  where period >= date '2024-04-01' - {days} and period < date '2024-04-01'
  group by subs_key, ban_key, region)"""


def _region_rank(days: int) -> str:
    return f"""{_region_usage(days)}, region_rank as (
  select calc_date, subs_key, ban_key, region, cast(row_number() over (
    partition by subs_key, ban_key order by uniq_days_amt desc nulls last, voice_gprs_mrg_mb desc nulls last,
      call_out_amt desc nulls last, call_in_amt desc nulls last, region) as integer) as rn
  from region_usage where region is not null)"""


def _primary(days: int) -> str:
    return f"""with {_region_rank(days)}
select calc_date as period, subs_key, ban_key, region from region_rank where rn = 1"""


def _recharge(days: int) -> str:
    return f"""select subs_key, ban_key, rech_src_desc, cast(total as decimal(28,2)) as total_rech_amt, rech_count,
  cast(row_number() over (partition by subs_key, ban_key
    order by total desc nulls last, rech_count desc, rech_src_desc) as integer) as rn
from (select subs_key, ban_key, description as rech_src_desc, sum(recharge_amt) as total, count(*) as rech_count
  from det_layer d join dim_mtr_classification m on d.mtr_classification_key = m.mtr_classification_key
    and d.parent_mtr_key = m.parent_mtr_key and m.target_table_name = 'FCT_PREPAID_RECHARGES'
  where src = 'RHA' and recharge_amt > 0 and recharge_source in ('E', 'S', 'B')
    and call_start_time >= date '2024-03-31' - {days - 1} and call_start_time < date '2024-04-01'
  group by 1, 2, 3) t"""


for _suffix, _days in {"weekly": 7, "monthly": 30, "3month": 90}.items():
    _SQL[f"region_usage_{_suffix}"] = f"with {_region_usage(_days)} select * from region_usage"
    _SQL[f"region_rank_{_suffix}"] = f"with {_region_rank(_days)} select * from region_rank"
    _SQL[f"primary_region_{_suffix}"] = _primary(_days)
    _SQL[f"recharge_source_{_suffix}"] = _recharge(_days)
_SQL["location_pipeline"] = _primary(30)
_SQL["primary_region_horizons"] = " union all ".join(
    f"select cast({d} as integer) as horizon, * from ({_primary(d)}) p{d}" for d in (7, 30, 90)
)
_SQL["recharge_source_horizons"] = " union all ".join(
    f"select cast({d} as integer) as horizon, * from ({_recharge(d)}) r{d}" for d in (7, 30, 90)
)

# --- joins -----------------------------------------------------------------

_SQL["join_composite"] = """
select d.mtr_classification_key, d.parent_mtr_key, description, count(*) as rows,
  cast(sum(recharge_amt) as decimal(28,2)) as amount
from det_layer d join dim_mtr_classification m
  on d.mtr_classification_key = m.mtr_classification_key and d.parent_mtr_key = m.parent_mtr_key
group by 1, 2, 3"""
_SQL["left_join_on_filter"] = """
select o.id, fmc_type_id, gsm_number, sign_main_gsm, expiration_date
from fmc_order_data o left join fmc_gsm g on o.id = g.fmc_order_id and g.sign_main_gsm = '1'"""
_SQL["join_clean_key"] = """
select 'plan' as kind, a.soc as code, soc_description, count(*) as rows
from service_agreement a left join soc s on trim(a.soc) = trim(s.soc) group by 1, 2, 3
union all
select 'lac', cast(lac_tac as varchar), cast(sectors as varchar), count(*) from det_layer
join (select lac_tac, count(*) as sectors from dir_sector group by 1) s
  on cast(regexp_replace(lac, '[^0-9]+', '', 'g') as bigint) = lac_tac group by lac_tac, sectors"""

_LO, _HI = "timestamp '1998-01-01 00:00:00'", "timestamp '2000-01-01 00:00:00'"


def _reached(types: str, statuses: str) -> str:
    """Every moment an order came to one of the statuses, and the login's order before it."""
    return f"""moments as (
  select order_key, moment, max(state) as state from (
    select id as order_key, order_status_id as state, order_status_date as moment from fmc_order_data
      where pre_order_status_id is null
    union all select fmc_order_id, pre_order_status_id, pre_order_status_date from fmc_change_status_log) every_state
  where state in ({statuses}) and moment >= {_LO} and moment < {_HI} group by all),
eligible as (
  select * exclude (order_status_id, order_status_date, pre_order_status_id) from fmc_order_data
  where fmc_type_id in ({types}) and login_fttb is not null),
earlier as (
  select e.id as order_key, max(f.id) as before_key from eligible e join fmc_order_data f
    on f.login_fttb = e.login_fttb and f.id < e.id group by all),
prior as (
  select e.*, m.state as order_status_id, m.moment as order_status_date, before_key as prev_req_id,
    f.order_status_id as prev_req_status, f.fmc_type_id as prev_fmc_req_type
  from moments m join eligible e on e.id = m.order_key left join earlier x on x.order_key = e.id
    left join fmc_order_data f on f.id = x.before_key)"""


_BUNDLE = _reached("'2', '4'", "414, 14")
_TV = _reached("'3'", "408, 9")


def _sale(new: str, upgrade: str, before: str) -> str:
    return f"""(fmc_type_id in ({new}) and prev_fmc_req_type is null
  or fmc_type_id = '{upgrade}' and (prev_fmc_req_type is null or prev_fmc_req_type = '{before}')
  or fmc_type_id = prev_fmc_req_type and prev_req_status = 4)"""


_SQL["prior_order_fmc"] = f"with {_BUNDLE} select * from prior"
_SQL["asof_prior_record"] = """
select id, prev_req_id, prev_req_status, prev_req_date from (
  select t.id, b.id as prev_req_id, b.order_status_id as prev_req_status, b.order_status_date as prev_req_date,
    row_number() over (partition by t.id order by b.id desc nulls last) as rn
  from fmc_order_data t left join fmc_order_data b on t.login_fttb = b.login_fttb and t.id > b.id
  where t.login_fttb is not null) x where rn = 1"""
_SQL["bundle_sales"] = f"""
with {_BUNDLE}
select p.*, gsm_number, sign_main_gsm from prior p left join fmc_gsm g on p.id = g.fmc_order_id
  and g.sign_main_gsm = '1' and (g.expiration_date is null or g.expiration_date > date '2024-04-01')
where {_sale("'2'", "4", "3")}"""
_SQL["tv_sales"] = f"""with {_TV} select * from prior where {_sale("'3'", "4", "2")}"""
_SQL["self_join_status"] = """
select a.*, u.usr as user_id from mnp_process a left join mnp_process u on a.id = u.id and u.status = 101
where a.status = 1"""
_SQL["role_playing_dim"] = """
select p.id, p.status, p.donor_id, p.recipient_id, d.code as donor_name, r.code as recipient_name
from mnp_process p left join operators d on p.donor_id = d.id left join operators r on p.recipient_id = r.id"""
_CONNECTED = """select id from suz_order_data where order_status_id = 1
    and order_status_date >= timestamp '1998-01-01 00:00:00' and order_status_date < timestamp '1999-01-01 00:00:00'
  union all
  select suz_order_data_id from change_order_status_log where pre_order_status_id = 1
    and pre_order_status_date >= timestamp '1998-01-01 00:00:00'
    and pre_order_status_date < timestamp '1999-01-01 00:00:00'"""
_SQL["semi_join_status"] = f"select id, login, ban from suz_order_data where id in ({_CONNECTED})"
_SQL["scalar_lookup"] = "select objid, " + ", ".join(
    f"(select x_title from table_x_int_reason r where r.objid = i.x_interact2reason{n}) as reason{n}"
    for n in range(1, 5)
) + " from table_interact i"
_KNOWN = """numbers as (select distinct trim(subscriber_no) as number from subscriber),
tries as (select id, unnest([phone, phone2, phone3]) as try, unnest([1, 2, 3]) as place from suz_order_data),
chosen as (select id, arg_min(number, place) as number from tries join numbers on number = trim(try) group by id)"""
_SQL["first_match_lookup"] = f"""
with {_KNOWN} select o.id, phone, phone2, phone3, number as known_phone
from suz_order_data o left join chosen on chosen.id = o.id"""
_SQL["fixed_line_sales"] = f"""
with {_KNOWN}, wanted as ({_CONNECTED})
select o.id, login, ban, number as phone, connection_type, sl_dealer_cd, sl_dealer_name, user_id, order_status_id,
  pre_order_status_id, left(o.phone, 10) as subs_contact_num
from suz_order_data o left join chosen on chosen.id = o.id where exists (from wanted w where w.id = o.id)"""
_SQL["porting_feed"] = """
with clock as (select timestamp '1998-06-26 08:30:00' as now),
live as (select operators.id, code from operators, clock where td >= cast(now as date)),
finished as (
  select m.* from mnp_process_mb m, clock
  where m.status = 6 and exists (from dict_data where up = 21 and code = m.status)
    and fd >= now - interval 25 day and fd < now - interval 20 day + interval 10 minute),
own as (
  select p.*, s.status_name, t.uniq from mnp_process p
  join mnp_process_statuses s using (status, process_type_id) join mnp_process_type t on t.id = p.process_type_id
  where p.recipient_id = 1 and p.status = 1 and p.process_type_id in (2, 5) and s.is_final = 1 and s.status_type = 1),
entered as (select id, usr from mnp_process where status = 101)
select fd, own.id, giver.code as donor_name, taker.code as recipient_name, uniq, status_name, mob_num, ban, market_id,
  account_type_id, tmp_mob_num,
  case when donor_id = 1 then 'PORT OUT' when recipient_id = 1 then 'PORT IN' end as portation_type, dealer_point_id,
  entered.usr as user_id
from own join finished on finished.process_id = own.id join live giver on giver.id = donor_id
  join live taker on taker.id = recipient_id left join entered on entered.id = own.id"""
# Visit codes that count with these reasons, and those that count with any.
_VISIT_PAIRS = """('MCN', 'ATNO'), ('RPS', 'RPSW'), ('CPP', 'CPPR'), ('CCN', 'CCNW'), ('RSP', 'RSBO'), ('RSP', 'RSB')"""
_VISIT_CODES = "'C16', 'C17', 'B05', 'B02', 'B60', 'B00', 'B08', 'UAE'"
_SQL["service_visits"] = f"""
with languages as (
  select ban, {_LANGUAGE} as language from service_option
  where service_type = 'O' and soc in ('ICLM_RUS', 'ICLM_KAZ') group by all),
accounts as (select ban, {_SEGMENT} as segment_type from billing_account where account_type in ('13', '113', '37', '39', '41')),
visits as (
  select * from csm_transactions
  where ((actv_code, actv_rsn_code) in ({_VISIT_PAIRS}) or actv_code in ({_VISIT_CODES}))
    and not starts_with(operator_id, '999')
    and sys_creation_date >= timestamp '2024-01-10 00:00:00' and sys_creation_date < timestamp '2024-01-20 00:00:00')
select actv_code, actv_rsn_code, v.ban, subscriber_no, segment_type, sys_creation_date, operator_id,
  concat_ws('_', 'ENS', trx_seq_no, actv_code) as visit_id, language
from visits v join accounts using (ban) join subscriber n on n.customer_id = v.ban and n.sub_status = 'A'
  left join languages using (ban)"""

_SQL["crm_contacts"] = f"""
with reasons as (select objid as reason_key, any_value(x_title) as title from table_x_int_reason group by objid),
owners as (
  select p.objid as owner_key, serial_no, account_type
  from table_site_part p join table_site s on s.objid = site_part2site
    join table_bus_org b on b.objid = primary2bus_org join table_x_ref_account_type on account_type_desc = b.type
  where part_status = 'Active' and account_type in ('13', '113', '37', '39', '41')),
letters as (
  select i.*, case when inserted_by <> 'robot' and direction = 'OUT' then 'agent'
    when inserted_by = 'robot' and direction = 'IN' then 'robot' end as author
  from table_interact i where type = 'Email' and create_date > timestamp '2024-01-20 00:00:00'),
dealt as (
  select l.*, split_part(ltrim(notes, '*'), '*', 1) as dealer from letters l
    join table_interact_txt on interact_txt2interact = objid where author = 'agent'
  union all select *, split_part(ltrim(title, ';'), ';', 1) from letters where author = 'robot')
select d.objid, serial_no as ctn, account_type, {_SEGMENT} as segment_type, end_date as interactionendtime, inserted_by,
  a.title as interactionreasons1, b.title as interactionreasons2, c.title as interactionreasons3,
  e.title as interactionreasons4, interact_id as interactionid, dealer as posdealercode, date '2024-01-30' as creationdate
from dealt d join owners on owner_key = interact2site_part
  left join reasons a on a.reason_key = x_interact2reason1 left join reasons b on b.reason_key = x_interact2reason2
  left join reasons c on c.reason_key = x_interact2reason3 left join reasons e on e.reason_key = x_interact2reason4"""

# --- aggregates, rankings, set operations -------------------------------------

_SQL["conditional_kpi"] = """
select subs_key, ban_key,
  cast(coalesce(sum(charge_amt + vat_amt) filter (where src in ('CHA', 'PSA', 'ROAM', 'GPRS')), 0)
    as decimal(28,4)) as usage_charge,
  count(*) filter (where v) as voice_out_calls, max(call_start_time) filter (where v) as last_voice_out,
  cast(coalesce(max(recharge_amt) filter
    (where src = 'RHA' and recharge_source in ('E', 'S', 'B') and recharge_amt > 0), 0) as decimal(18,2)) as max_topup
from (select *, src in ('CHA', 'PSA', 'ROAM', 'GPRS') and call_type_code = 'V' and call_direction_ind = '2' as v
  from det_layer) d group by 1, 2"""
_SQL["distinct_pairs"] = """
select distinct ban, soc from service_option where service_type = 'O' and soc in ('ICLM_RUS', 'ICLM_KAZ')"""
_SQL["latest_per_key"] = """
select * exclude (rn) from (select *, row_number() over (partition by o_custkey
  order by o_orderdate desc nulls last, o_orderkey desc) as rn from orders) o where rn = 1"""
_SQL["top_k_per_group"] = """
select subscriber_no, ban, agreement_id, soc, rn from (
  select *, cast(row_number() over (partition by subscriber_no, ban order by effective_date desc nulls last,
    sys_creation_date desc nulls last, agreement_id desc) as integer) as rn from service_agreement) a where rn <= 2"""
_SQL["status_transitions"] = """
select id, order_status_id as status, order_status_date as status_date from fmc_order_data
where order_status_id in (414, 14) and pre_order_status_id is null
union all select fmc_order_id, pre_order_status_id, pre_order_status_date from fmc_change_status_log
where pre_order_status_id in (414, 14)"""


def _price_plan(as_of: str, code: str) -> str:
    """``code`` makes a plan code comparable."""
    return f"""
with named as (select {code.format("soc")} as plan, any_value(pp_group) as pp_group
  from soc left join dim_price_plan on trim(price_plan_key) = trim(soc) group by all),
history as (
  select subscriber_no, ban, list(struct_pack(soc, effective_date)
    order by effective_date desc nulls last, sys_creation_date desc nulls last, agreement_id desc) as plans
  from service_agreement where service_type = 'P' and effective_date < date '{as_of}' + interval 1 day group by all)
select subscriber_no as subs_key, ban as ban_key, cast(0 as integer) as arch_pp_ind, plans[1].soc as curr_price_plan_code,
  pp_group, plans[1].effective_date as price_plan_change_date, plans[2].soc as prev_price_plan_code
from history left join named on plan = {code.format("plans[1].soc")}"""


_SQL["price_plan_current_prev"] = _price_plan("2024-04-01", "{}")
_SQL["price_plan_padded_codes"] = _price_plan("2000-06-30", "trim({})")

# --- scalar functions -----------------------------------------------------

_SQL["fn_strings"] = """
select id, trim(phone) as trimmed, length(phone) as len,
  case when length(sl_dealer_name) > 3 then substr(sl_dealer_name, 1, 3) else sl_dealer_name end as cut3,
  substr(cast(order_status_date as varchar), 1, 10) as day_text, substr(login, 3) as tail,
  'ENS_' || cast(id as varchar) || '_' || sl_dealer_name as visit_id,
  'pre_' || cast(pre_order_status_id as varchar) as null_part from suz_order_data"""
_SQL["fn_regex"] = """
select objid, regexp_extract(title, '([^;]+)', 1) as title_part, regexp_extract(notes, '([^*]+)', 1) as note_part,
  regexp_replace(notes, '[^0-9]+', '', 'g') as note_digits
from table_interact join table_interact_txt on objid = interact_txt2interact"""
_SQL["fn_casts"] = """
select subs_key, try_cast(regexp_replace(lac, '[^0-9]+', '', 'g') as bigint) as lac_id,
  try_cast(regexp_replace(src, '[^0-9]+', '', 'g') as bigint) as src_id,
  cast(try_cast(regexp_replace(cell_id, '[^0-9]+', '', 'g') as bigint) as decimal(30,0)) as cell_dec,
  cast(call_start_time as date) as day, cast(substr(cast(call_start_time as varchar), 1, 10) as date) as day_from_text,
  try_cast(src as bigint) as bad_cast from det_layer"""
_SQL["fn_math"] = """
select subs_key, cast(abs(charge_amt) as decimal(18,4)) as abs_charge,
  cast(charge_amt + vat_amt as decimal(20,4)) as gross, cast(charge_amt - vat_amt as decimal(20,4)) as net,
  cast(actual_call_duration_sec as double) / 60 as minutes, rounded_data_volume / 1024 / 1024 as megabytes,
  cast(actual_call_duration_sec * 1024 as decimal(28,1)) as scaled from det_layer"""
_SQL["fn_dates"] = """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%H') as hour_text,
  strftime(o_orderdate, '%d%m%Y') as day_folder, strftime(o_orderdate, '%m-%Y') as month_folder,
  d + 30 as plus_30, d - 10 as minus_10, cast(d + interval 1 month as date) as next_month,
  cast(date_trunc('month', d) as date) as month_start, d as unchanged,
  strftime(date_trunc('month', d), '%d%m%Y') as month_start_folder, last_day(d) as month_end,
  cast(date_trunc('month', d) - interval 1 month as date) as sysmonth, cast(d as timestamp) as day_start,
  cast(d as timestamp) + interval 86399 second as day_end,
  o_orderdate - interval 20 day + interval 10 minute as shifted, abs(date_diff('day', d, date '2024-03-31')) as day_gap
from (select *, cast(o_orderdate as date) as d from orders) o"""

# --- subscriber profile ---------------------------------------------------------

# One line per metric: output column, aggregate, value, condition in the atoms below.
_REV, _CHG = "src in ('CHA','PSA','ROAM','GPRS')", "(src = 'CHR' and charge_type in ('O','R'))"
_ATOMS = {
    "REV": _REV,
    "CHG": _CHG,
    "ANY": f"({_REV} or {_CHG})",
    "USE": "src in ('CHA','PSA','ROAM','GPRS','POST')",
    "CONTENT": "content_key is not null",
    "PLAIN": "content_key is null",
    "HOME": "(roaming_ind = '0' and roaming_type_key in ('H','X') or roaming_ind = '1' and roaming_type_key = 'R')",
    "ROAM": "(roaming_ind > '0' and roaming_type_key not in ('R','X'))",
    "OUT": "call_direction_ind = '2'",
    "IN": "call_direction_ind = '1'",
    "MOB": "connection_type_key = '3'",
    "FIX": "connection_type_key in ('1','2')",
    "LOCAL": "location_type_key in ('1','2')",
    "INTL": "location_type_key = '3'",
    "STD": "special_number_ind = '0'",
    "CNT": "counted_cdr_ind = '1'",
    "ONNET": "orig_parent_operator_code = term_parent_operator_code and term_parent_operator_code = '130'",
    "OFFNET": "orig_parent_operator_code <> term_parent_operator_code",
    "V": "call_type_code = 'V'",
    "S": "call_type_code = 'S'",
    "SM": "call_type_code in ('S','M')",
    "G": "call_type_code = 'G'",
    "MFSOUT": "src = 'CHR' and service_key in (1, 2, 3) and charge_type = 'N' and charge_amt > 0",
    "MFSIN": "src = 'CHR' and service_key in (1, 2, 3) and charge_type = 'N' and charge_amt < 0",
    "TOPUP": "src = 'RHA' and recharge_source in ('E','S','B') and recharge_amt > 0",
    "NET2": "network_type <> 'L' and cell_nettype not in ('3G','4G')",
    "NET3": "network_type <> 'L' and cell_nettype = '3G'",
    "NET4": "(network_type = 'L' or cell_nettype = '4G')",
    **{f"STREAM{n}": f"revenue_stream = {n}" for n in (1, 3, 4, 9, 42)},
    **{f"TO{n}": f"code_to = '{n}'" for n in (7, 998, 996)},
    **{f"FROM{n}": f"code_from = '{n}'" for n in (7, 998, 996)},
}
_SPEC = """
arpu subs_arpu_daily money ANY
arpu subs_bundle_arpu_daily money ANY PLAIN STREAM42
arpu subs_voice_arpu_daily money REV STREAM1 PLAIN
arpu subs_data_arpu_daily money REV STREAM4 PLAIN
arpu subs_sms_arpu_daily money REV STREAM3 PLAIN
arpu subs_content_arpu_daily money ANY CONTENT
arpu subs_roam_arpu_daily money ANY PLAIN STREAM9
arpu subs_roam_voice_arpu_daily money REV PLAIN STREAM9 V
arpu subs_roam_smsmms_arpu_daily money REV PLAIN STREAM9 SM
arpu subs_roam_gprs_arpu_daily money REV PLAIN STREAM9 G
arpu subs_roam_content_arpu_daily money CHG PLAIN STREAM9
voice v_out_onnet_loc_min min USE V OUT MOB LOCAL STD HOME CNT ONNET
voice v_out_onnet_loc_call_amt count USE V OUT MOB LOCAL STD HOME CNT ONNET
voice last_out_v_onnet_loc_call last USE V OUT MOB LOCAL STD HOME CNT ONNET
voice v_in_onnet_loc_min min USE V IN MOB LOCAL STD HOME CNT ONNET
voice v_in_onnet_loc_call_amt count USE V IN MOB LOCAL STD HOME CNT ONNET
voice last_in_v_onnet_loc_call last USE V IN MOB LOCAL STD HOME CNT ONNET
voice v_out_offnet_loc_min min USE V OUT MOB LOCAL STD HOME CNT OFFNET
voice v_out_offnet_loc_call_amt count USE V OUT MOB LOCAL STD HOME CNT OFFNET
voice last_out_v_offnet_loc_call last USE V OUT MOB LOCAL STD HOME CNT OFFNET
voice v_in_offnet_loc_min min USE V IN MOB LOCAL STD HOME CNT OFFNET
voice v_in_offnet_loc_call_amt count USE V IN MOB LOCAL STD HOME CNT OFFNET
voice last_in_v_offnet_loc_call last USE V IN MOB LOCAL STD HOME CNT OFFNET
voice v_out_fix_loc_min min USE V OUT FIX LOCAL HOME CNT
voice v_out_fix_loc_call_amt count USE V OUT FIX LOCAL HOME CNT
voice last_out_v_fix_loc_call last USE V OUT FIX LOCAL HOME CNT
voice v_in_fix_loc_min min USE V IN FIX LOCAL HOME CNT
voice v_in_fix_loc_call_amt count USE V IN FIX LOCAL HOME CNT
voice last_in_v_fix_loc_call last USE V IN FIX LOCAL HOME CNT
voice v_out_inter_min min USE V OUT INTL HOME CNT
voice v_out_inter_call_amt count USE V OUT INTL HOME CNT
voice last_out_v_inter_call last USE V OUT INTL HOME CNT
voice v_in_inter_min min USE V IN INTL HOME CNT
voice v_in_inter_call_amt count USE V IN INTL HOME CNT
voice last_in_v_inter_call last USE V IN INTL HOME CNT
voice v_out_inter_rus_min min USE V OUT INTL TO7 HOME CNT
voice v_out_inter_uzb_min min USE V OUT INTL TO998 HOME CNT
voice v_out_inter_krgz_min min USE V OUT INTL TO996 HOME CNT
voice v_in_inter_rus_min min USE V IN INTL FROM7 HOME CNT
voice v_in_inter_uzb_min min USE V IN INTL FROM998 HOME CNT
voice v_in_inter_krgz_min min USE V IN INTL FROM996 HOME CNT
voice v_out_roam_min min USE V OUT ROAM CNT
voice v_out_roam_call_amt count USE V OUT ROAM CNT
voice v_in_roam_min min USE V IN ROAM CNT
voice v_in_roam_call_amt count USE V IN ROAM CNT
voice v_out_onnet_roam_min min USE V OUT MOB LOCAL STD ROAM CNT ONNET
voice v_out_offnet_roam_min min USE V OUT MOB LOCAL STD ROAM CNT OFFNET
voice v_out_fix_roam_min min USE V OUT FIX LOCAL STD ROAM CNT
voice v_out_inter_roam_min min USE V OUT INTL STD ROAM CNT
voice v_in_onnet_roam_min min USE V IN MOB LOCAL STD ROAM CNT ONNET
voice v_in_offnet_roam_min min USE V IN MOB LOCAL STD ROAM CNT OFFNET
voice v_in_fix_roam_min min USE V IN FIX LOCAL STD ROAM CNT
voice v_in_inter_roam_min min USE V IN INTL STD ROAM CNT
data gprs_data_mb_vlm_2g mb USE G HOME CNT NET2
data gprs_data_mb_vlm_3g mb USE G HOME CNT NET3
data gprs_data_mb_vlm_4g mb USE G HOME CNT NET4
data gprs_data_mb_vlm_roam mb USE G ROAM CNT
sms s_out_onnet_loc_sms_amt count USE S OUT MOB LOCAL STD HOME CNT ONNET
sms s_out_offnet_loc_sms_amt count USE S OUT MOB LOCAL STD HOME CNT OFFNET
sms s_out_inter_sms_amt count USE S OUT MOB INTL STD HOME CNT
sms s_out_roam_sms_amt count USE S OUT ROAM CNT
sms s_in_onnet_loc_sms_amt count USE S IN MOB LOCAL STD HOME CNT ONNET
sms s_in_offnet_loc_sms_amt count USE S IN MOB LOCAL STD HOME CNT OFFNET
sms s_in_inter_sms_amt count USE S IN MOB INTL STD HOME CNT
sms s_in_roam_sms_amt count USE S IN ROAM CNT
mfs total_mfs_write_off_amt money MFSOUT
mfs max_mfs_write_off_amt maxmoney MFSOUT
mfs max_mfs_write_off_count count MFSOUT
mfs total_mfs_recharge_amt absmoney MFSIN
mfs max_mfs_recharge_amt maxabsmoney MFSIN
mfs max_mfs_recharge_count count MFSIN
topup total_topup_amt topup TOPUP
topup max_topup_amt maxtopup TOPUP
topup topup_count count TOPUP
"""
_FORMS = {
    "money": "cast(coalesce(sum(charge_amt + vat_amt) filter (where {}), 0) as decimal(28,4))",
    "absmoney": "cast(coalesce(sum(abs(charge_amt + vat_amt)) filter (where {}), 0) as decimal(28,4))",
    "maxabsmoney": "cast(coalesce(max(abs(charge_amt + vat_amt)) filter (where {}), 0) as decimal(28,4))",
    "topup": "cast(coalesce(sum(recharge_amt) filter (where {}), 0) as decimal(28,2))",
    "maxtopup": "cast(coalesce(max(recharge_amt) filter (where {}), 0) as decimal(28,2))",
    "count": "count(*) filter (where {})",
    "min": "cast(cast(coalesce(sum(actual_call_duration_sec) filter (where {}), 0) as decimal(28,1)) as double) / 60",
    "mb": "cast(coalesce(sum(rounded_data_volume) filter (where {}), 0) as bigint) / 1048576",
    "last": "max(call_start_time) filter (where {})",
}
_FORMS["maxmoney"] = "cast(max(case when {} then charge_amt + vat_amt else 0 end) as decimal(28,4))"
PROFILE_FAMILIES = ("arpu", "voice", "data", "sms", "mfs", "topup")


def _profile(families, first: str = "2024-01-01") -> str:
    columns = []
    for line in _SPEC.strip().splitlines():
        family, name, form, *atoms = line.split()
        if family in families:
            columns.append(f"{_FORMS[form].format(' and '.join(_ATOMS[a] for a in atoms))} as {name}")
    return f"""with {_CELLS}, facts as (
  select d.*, s.business_service_key as service_key, y.revenue_stream, t.business_service_key as content_key,
    g1.country_code as code_from, g2.country_code as code_to, c.cell_nettype
  from det_layer d left join dim_business_service s on d.business_service_key = s.business_service_key
    left join dim_business_service_type y on s.business_service_type_key = y.business_service_type_key
    left join dim_bls_content_list t on cast(s.business_service_key as varchar) = t.business_service_key
      and cast(y.business_service_type_key as varchar) = t.business_service_type_key
      and cast(y.revenue_stream as varchar) = t.revenue_stream
    left join dim_global_digit g1 on d.dial_digit_key_from = g1.dial_digit_key
    left join dim_global_digit g2 on d.dial_digit_key_to = g2.dial_digit_key
    left join cells c on regexp_replace(d.lac, '[^0-9]+', '', 'g') = cast(c.lac as varchar)
      and regexp_replace(d.cell_id, '[^0-9]+', '', 'g') = cast(c.cell_id as varchar)
  where call_start_time >= date '{first}' and call_start_time < date '2024-04-01')
select subs_key, ban_key, cast(call_start_time as date) as period, date '2024-03-31' as calc_date,
  {", ".join(columns)}
from facts group by subs_key, ban_key, cast(call_start_time as date)"""


_SQL["subscriber_profile"] = _profile(PROFILE_FAMILIES)
_SQL["subscriber_profile_daily"] = _profile(PROFILE_FAMILIES, "2024-03-28")
for _family in PROFILE_FAMILIES:
    _SQL[f"profile_{_family}"] = _profile((_family,))

ORACLES: dict[str, str] = {name: with_standins(sql) for name, sql in _SQL.items()}
