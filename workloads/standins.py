"""Stand-ins for the marts' input tables, as projections of the driver's tables.

The SQL is the text of FIXTURES.md; it runs on Spark and on DuckDB alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

STANDINS: dict[str, str] = {
    "det_layer": """
        select o_custkey as subs_key, o_custkey % 50 as ban_key, timestamp '2024-01-01 00:00:00' +
        ((h % 97) % 91) * interval '1' day + (h % 23) * interval '1' hour as call_start_time, case
        (h % 13) when 0 then 'CHA' when 1 then 'PSA' when 2 then 'ROAM' when 3 then 'GPRS' when 4
        then 'POST' when 5 then 'CHR' when 6 then 'CHR' when 7 then 'RHA' when 8 then 'RHA' when 9
        then 'CHA' when 10 then 'GPRS' when 11 then 'POST' else 'PSA' end as src, case (h % 7) % 3
        when 0 then 'O' when 1 then 'R' else 'N' end as charge_type, cast(cast(case when h % 11 < 2
        then -floor(l_extendedprice) else floor(l_extendedprice) end as decimal(18,4)) +
        cast((l_partkey % 97) * 0.0013 as decimal(18,4)) as decimal(18,4)) as charge_amt,
        cast(floor(l_extendedprice * l_tax) as decimal(18,2)) as vat_amt, l_partkey % 100 + 1 as
        business_service_key, case (h % 17) % 4 when 0 then 'V' when 1 then 'G' when 2 then 'S' else
        'M' end as call_type_code, case when (h % 19) % 2 = 0 then '1' else '2' end as
        call_direction_ind, case when (h % 29) % 4 = 0 then '1' when (h % 29) % 4 = 1 then '2' else
        '3' end as connection_type_key, case when (h % 31) % 4 = 0 then '3' when (h % 31) % 4 = 1
        then '2' else '1' end as location_type_key, case when h % 37 < 4 then '1' else '0' end as
        special_number_ind, case when (h % 41) % 3 = 0 then '1' else '0' end as roaming_ind, case
        when (h % 43) % 3 = 0 then 'R' when (h % 43) % 3 = 1 then 'H' else 'X' end as
        roaming_type_key, case when h % 47 < 5 then '0' else '1' end as counted_cdr_ind, case when h
        % 53 < 3 then 1 else 0 end as call_forward_ind, case when (h % 59) % 2 = 0 then '130' else
        '140' end as orig_parent_operator_code, case when (h % 61) % 2 = 0 then '130' else '150' end
        as term_parent_operator_code, cast(cast(l_quantity * 30 as decimal(18,1)) + cast((l_partkey
        % 10) * 0.1 as decimal(18,1)) as decimal(18,1)) as actual_call_duration_sec,
        cast(floor(l_extendedprice) as bigint) * 1024 as rounded_data_volume, case when (h % 67) % 4
        = 0 then 'L' else 'G' end as network_type, concat(' ', cast(l_partkey % 20 as string)) as
        lac, concat(' ', cast(l_partkey % 47 as string)) as cell_id, l_suppkey % 7 as
        dial_digit_key_from, l_partkey % 7 as dial_digit_key_to, case (h % 71) % 4 when 0 then 'E'
        when 1 then 'S' when 2 then 'B' else 'X' end as recharge_source, cast(l_quantity as
        decimal(18,2)) as recharge_amt, l_suppkey % 6 as mtr_classification_key, l_suppkey % 3 as
        parent_mtr_key from (select l.*, o.o_custkey, l_orderkey * 31 + l_partkey * 17 + l_suppkey *
        7 + l_linenumber * 3 as h from lineitem l join orders o on l_orderkey = o_orderkey) x
    """,
    "dim_business_service": """
        select p_partkey as business_service_key, p_size as business_service_type_key from part
    """,
    "dim_business_service_type": """
        select distinct p_size as business_service_type_key, case p_size % 6 when 0 then 1 when 1
        then 3 when 2 then 4 when 3 then 9 when 4 then 42 else 7 end as revenue_stream from part
    """,
    "dim_bls_content_list": """
        select cast(p_partkey as string) as business_service_key, cast(p_size as string) as
        business_service_type_key, cast(case p_size % 6 when 0 then 1 when 1 then 3 when 2 then 4
        when 3 then 9 when 4 then 42 else 7 end as string) as revenue_stream from part where
        p_partkey % 10 = 0
    """,
    "dim_global_digit": """
        select n_nationkey as dial_digit_key, case n_nationkey % 4 when 0 then '7' when 1 then '998'
        when 2 then '996' else '49' end as country_code from nation
    """,
    "dim_mtr_classification": """
        select n_nationkey as mtr_classification_key, n_nationkey % 3 as parent_mtr_key, case when
        n_nationkey % 5 = 4 then 'OTHER' else 'FCT_PREPAID_RECHARGES' end as target_table_name,
        n_name as description from nation
    """,
    "dir_sites": """
        select s_suppkey as site_id, s_nationkey as addr_id_city, s_name as site_addr, s_suppkey %
        90 as longitude, s_suppkey % 45 as latitude from supplier
    """,
    "dir_city": """
        select n_nationkey as id_city, n_nationkey % 2 as id_city_type, n_nationkey as id_area,
        n_name as city_name from nation
    """,
    "dir_area": """
        select n_nationkey as id_area, n_regionkey as id_region, n_name as area_name from nation
    """,
    "dir_region": """
        select r_regionkey as id_region, r_name as name_region from region
    """,
    "dir_bts": """
        select p_partkey as id_bts, p_partkey % 10 + 1 as site_id, (p_partkey * 7 + 3) % 47 as
        enodeb_id, p_size % 3 as id_btsstatus, p_size % 4 as id_btstype, cast(date '2015-01-01' +
        p_size * interval '1' day as date) as inservice_date from part
    """,
    "dir_sector": """
        select p_partkey as id_bts, p_partkey % 20 as lac_tac, p_partkey % 47 as cell_id, case
        p_size % 3 when 0 then '2G' when 1 then '3G' else '4G' end as cell_nettype, case p_partkey %
        5 when 0 then 'test' when 1 then 'closed' else 'active' end as cell_status from part
    """,
    "service_agreement": """
        select o_custkey as subscriber_no, o_custkey % 50 as ban, p_brand as soc, 'P' as
        service_type, o_orderdate as effective_date, cast(o_orderdate + (o_orderkey % 5) * interval
        '1' day as timestamp) as sys_creation_date, o_orderkey as agreement_id from orders join part
        on o_orderkey % 200 + 1 = p_partkey where o_orderpriority <> '5-LOW'
    """,
    "fmc_order_data": """
        select o_orderkey as id, case o_orderkey % 6 when 0 then 414 when 1 then 14 when 2 then 408
        when 3 then 9 else 4 end as order_status_id, case when o_orderkey % 5 = 0 then 4 end as
        pre_order_status_id, o_orderdate as order_status_date, case when o_custkey % 20 > 0 then
        concat('login', cast(o_custkey as string)) end as login_fttb, o_custkey % 50 as ban,
        cast(o_orderkey % 3 + 2 as string) as fmc_type_id, o_orderkey % 2 as fttb_subscriber_type,
        cast(o_custkey as string) as phone1, cast(o_custkey + 1 as string) as phone2, cast(o_custkey
        + 2 as string) as phone3, o_orderkey % 17 as user_id, o_orderkey % 13 as sl_dealer_cd,
        o_orderpriority as sl_dealer_name, o_orderkey % 11 as mon_dealer_cd from orders
    """,
    "fmc_change_status_log": """
        select l_orderkey as fmc_order_id, case l_linenumber % 5 when 0 then 414 when 1 then 14 when
        2 then 408 when 3 then 9 else 4 end as pre_order_status_id, l_shipdate as
        pre_order_status_date from lineitem
    """,
    "billing_account": """
        select c_custkey as ban, case c_mktsegment when 'BUILDING' then '13' when 'AUTOMOBILE' then
        '113' when 'MACHINERY' then '37' when 'HOUSEHOLD' then '41' else '99' end as account_type
        from customer
    """,
    "subscriber": """
        select concat(cast(c_custkey as string),' ') as subscriber_no, c_custkey as customer_id,
        case when c_custkey % 4 = 0 then 'C' else 'A' end as sub_status from customer
    """,
    "service_option": """
        select o_custkey as ban, 'O' as service_type, case o_custkey % 3 when 0 then 'ICLM_RUS' when
        1 then 'ICLM_KAZ' else 'OTHER' end as soc from orders
    """,
    "csm_transactions": """
        select event_id as trx_seq_no, user_id as ban, ts as sys_creation_date, case event_type when
        'click' then 'MCN' when 'error' then 'RPS' when 'purchase' then 'RSP' when 'signup' then
        'C16' else 'ZZZ' end as actv_code, case event_id % 3 when 0 then 'ATNO' when 1 then 'RPSW'
        else 'RSB' end as actv_rsn_code, case when event_id % 8 = 0 then '999001' else cast(event_id
        % 500 as string) end as operator_id from events
    """,
    "mnp_process": """
        select distinct l_orderkey as id, case l_linenumber % 3 when 0 then 1 when 1 then 101 else 7
        end as status, l_orderkey % 3 + 1 as recipient_id, l_orderkey % 5 + 1 as donor_id, case
        l_orderkey % 4 when 0 then 2 when 1 then 5 else 9 end as process_type_id,
        concat('u',cast(l_orderkey % 9 as string)) as usr, l_orderkey % 21 as dealer_point_id from
        lineitem
    """,
    "mnp_process_mb": """
        select o_orderkey as process_id, case o_orderkey % 50 when 0 then timestamp '1998-06-01
        08:30:00' when 4 then timestamp '1998-06-06 08:40:00' when 2 then timestamp '1998-06-06
        08:39:59' when 6 then timestamp '1998-06-01 08:29:59' when 8 then timestamp '1998-06-03
        12:00:00' else o_orderdate end as fd, case when o_orderkey % 2 = 0 then 6 else 3 end as
        status, o_custkey as ban, concat('77',cast(o_custkey as string)) as mob_num, o_custkey % 4
        as market_id, o_custkey % 6 as account_type_id, concat('70',cast(o_orderkey as string)) as
        tmp_mob_num from orders
    """,
    "operators": """
        select n_nationkey as id, n_name as code, case when n_nationkey % 10 in (4, 9) then date
        '1998-06-01' else date '2999-12-31' end as td from nation
    """,
    "mnp_process_statuses": """
        select 1 as status, 'DONE' as status_name, 1 as is_final, 1 as status_type, r_regionkey + 1
        as process_type_id from region
    """,
    "mnp_process_type": """
        select p_size as id, min(p_type) as uniq from part where p_size < 10 group by p_size
    """,
    "dict_data": """
        select r_regionkey + 3 as code, case when r_regionkey < 4 then 21 else 22 end as up from
        region
    """,
    "suz_order_data": """
        select o_orderkey as id, concat('login',cast(o_custkey as string)) as login, o_custkey as
        ban, case when o_orderkey % 7 = 0 then concat('8 (701) ',cast(o_custkey as string),'-00')
        else concat(' ',cast(o_custkey * 4 as string)) end as phone, cast(o_custkey * 2 as string)
        as phone2, case when o_custkey % 3 > 0 then cast(o_custkey as string) end as phone3, case
        o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as order_status_id, o_orderdate as
        order_status_date, case when o_orderkey % 5 = 0 then 2 end as pre_order_status_id,
        o_orderkey % 3 as connection_type, o_orderkey % 13 as sl_dealer_cd, o_orderpriority as
        sl_dealer_name, o_orderkey % 17 as user_id from orders
    """,
    "change_order_status_log": """
        select l_orderkey as suz_order_data_id, l_linenumber as pre_order_status_id, l_shipdate as
        pre_order_status_date from lineitem
    """,
    "table_interact": """
        select event_id as objid, event_id % 997 as interact_id, user_id as interact2site_part,
        event_id % 25 as x_interact2reason1, event_id % 31 as x_interact2reason2, case when event_id
        % 4 = 0 then 'robot' else concat('op',cast(event_id % 7 as string)) end as inserted_by, case
        when event_id % 4 = 0 then 'IN' else 'OUT' end as direction, case when event_type in
        ('click','view') then 'Email' else 'Call' end as type, concat(event_type,';',cast(event_id
        as string)) as title, event_id % 37 as x_interact2reason3, event_id % 41 as
        x_interact2reason4, ts as create_date, ts + interval '5' minute as end_date from events
    """,
    "table_interact_txt": """
        select event_id as interact_txt2interact, concat('D',cast(user_id as string),'*',props) as
        notes from events
    """,
    "table_x_int_reason": """
        select n_nationkey as objid, n_name as x_title from nation
    """,
    "table_site": """
        select c_custkey as objid, c_nationkey as primary2bus_org from customer
    """,
    "table_site_part": """
        select c_custkey as objid, c_custkey as site_part2site, c_name as serial_no, case when
        c_custkey % 5 = 0 then 'Closed' else 'Active' end as part_status from customer
    """,
    "table_bus_org": """
        select n_nationkey as objid, n_regionkey as type from nation
    """,
    "table_x_ref_account_type": """
        select r_regionkey as account_type_desc, case r_regionkey when 0 then '13' when 1 then '113'
        when 2 then '37' when 3 then '41' else '99' end as account_type from region
    """,
    "dir_city_type": """
        select r_regionkey as id_city_type, concat('type',cast(r_regionkey as string)) as
        city_type_name from region where r_regionkey < 2
    """,
    "dir_btsstatus": """
        select r_regionkey as id_btsstatus, r_name as status_name from region
    """,
    "dir_btstype": """
        select r_regionkey as id_btstype, r_name as type_name from region
    """,
    "soc": """
        select distinct case when substr(p_brand,7,1) in ('1','2') then concat(p_brand,' ') else
        p_brand end as soc, concat('plan ',p_brand) as soc_description from part where p_brand <>
        'Brand#11'
    """,
    "dim_price_plan": """
        select distinct p_brand as price_plan_key, substr(p_brand,1,7) as pp_group from part
    """,
    "balance_archive": """
        select c_custkey as subs_key, cast(floor(c_acctbal) as bigint) as balance, cast(date
        '2024-03-01' + (c_custkey % 30) * interval '1' day as date) as dt from customer
    """,
    "fmc_gsm": """
        select o_orderkey as fmc_order_id, concat('77',cast(o_custkey as string)) as gsm_number,
        case when o_orderkey % 3 = 0 then '0' else '1' end as sign_main_gsm, case when o_orderkey %
        4 = 0 then date '1999-01-01' when o_orderkey % 4 = 1 then date '2999-12-31' end as
        expiration_date from orders
    """,
}


def spark_text(sql: str) -> str:
    """Zone-free timestamps: plain timestamp literals are zoned in Spark."""
    sql = " ".join(sql.split())
    return sql.replace("timestamp '", "timestamp_ntz '").replace("as timestamp)", "as timestamp_ntz)")


def _mentions(sql: str, names) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [n for n in names if n in words]


class Tables:
    """The driver's tables of one folder and the stand-ins over them, read on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in STANDINS:
                text = spark_text(STANDINS[name])
                for table in _mentions(text, DRIVER_TABLES):
                    text = re.sub(rf"\b(from|join) {table}\b", rf"\1 {{{table}}}", text)
                used = {t: self[t] for t in DRIVER_TABLES if f"{{{t}}}" in text}
                self._frames[name] = self.spark.sql(text, **used)
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def has(self, name: str) -> bool:
        return name in self._frames

    def __setitem__(self, name: str, frame: DataFrame) -> None:
        self._frames[name] = frame

    def pick(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


def with_standins(sql: str) -> str:
    """DuckDB text: the stand-ins a query mentions as common table expressions in front."""
    used = _mentions(sql, STANDINS)
    tables = [f"{n} as ({' '.join(STANDINS[n].split())})" for n in used]
    body = sql.strip()
    if not tables:
        return body
    if body.lower().startswith("with "):
        return f"with {', '.join(tables)}, {body[5:]}"
    return f"with {', '.join(tables)} {body}"
