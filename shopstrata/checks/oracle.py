"""SQL over the sample tables that gives the rows of each query."""

from __future__ import annotations

from . import queries

ORACLE: dict[str, str] = {}

_TIME = "'%Y-%m-%d %H:%M:%S'"

# Views shared by the statements: name, and its query.
_VIEWS = {
    "log": """
        select event_id as log_id, epoch_us(ts) // 1000 as ts, event_type, 'mid_' || user_id as mid,
               'v' || (event_id % 3) as vc, 'ch' || (event_id % 5) as ch, 'ar' || (user_id % 7) as ar,
               case when event_id % 2 = 0 then '1' else '0' end as is_new,
               cast(floor(value * 1000) as bigint) as during_time,
               event_id % (select count(*) from part) as sku,
               cast(json_extract_string(props, '$.k') as integer) % 4 as n_shown,
               case when event_type = 'click' then 'good_detail' else event_type end as page_id
        from events""",
    "fixed": """
        select * replace (case when is_new = '1' and row_number() over (partition by mid, is_new order by ts, log_id) > 1
                               then '0' else is_new end as is_new)
        from log""",
    "raw_pages": "select * from log where event_type <> 'signup'",
    "pages": "select * from fixed where event_type <> 'signup'",
    "shown": """
        select log_id, ts, 'good_detail' as page_id, (log_id + i) % (select count(*) from part) as item
        from log, unnest(range(n_shown)) as u(i) where event_type = 'click'""",
    "order_info": f"""
        select o_orderkey as id, cast(c_nationkey as bigint) as province_id, o_custkey as user_id,
               o_orderstatus as order_status, cast(o_totalprice as decimal(16,2)) as total_amount,
               o_orderdate as made, strftime(o_orderdate, {_TIME}) as create_time
        from orders left join customer on c_custkey = o_custkey""",
    "priced": """
        select *, cast(l_extendedprice as decimal(16,2)) as price,
               cast(cast(l_extendedprice as decimal(16,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(16,2)) as share
        from lineitem""",
    "order_detail": f"""
        select l_orderkey * 8 + l_linenumber as id, l_orderkey as order_id, l_partkey as sku_id,
               cast(l_quantity as bigint) as sku_num, 'line ' || l_linenumber as sku_name, price, share,
               cast(price - share as decimal(16,2)) as off, l_shipdate as made, strftime(l_shipdate, {_TIME}) as create_time
        from priced""",
    "bare": """
        select d.id as detail_id, o.id as order_id, d.sku_id, d.sku_name, d.sku_num, o.province_id, o.user_id,
               o.order_status, o.total_amount, o.made, o.create_time, d.create_time as detail_time, d.price, d.share, d.off
        from order_info o join order_detail d on d.order_id = o.id
        where d.made between o.made - interval 30 day and o.made + interval 90 day""",
    "payment": f"""
        select o_orderkey + 1000000000 as id, o_orderkey as order_id, o_custkey as user_id,
               cast(o_totalprice as decimal(16,2)) as total_amount, 'order ' || o_orderkey as subject,
               case o_orderstatus when 'F' then '1101' else '1102' end as payment_type,
               o_orderdate + (o_orderkey % 30) * interval 1 minute as made,
               strftime(o_orderdate + (o_orderkey % 30) * interval 1 minute, {_TIME}) as create_time
        from orders where o_orderstatus in ('F', 'P')""",
    "users": """
        select cast(c_custkey as varchar) as id, c_custkey as key,
               date '1960-01-01' + cast(c_custkey % 15000 as integer) as birthday,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as gender
        from customer""",
    "provinces": """
        select n_nationkey as id, n_name as province_name, cast(n_regionkey as varchar) as province_area_code,
               'CN-' || n_nationkey as province_iso_code, 'ISO-' || n_nationkey as province_3166_2_code
        from nation""",
    "skus": """
        select p_partkey as id, p_name as sku_name, cast(p_retailprice as decimal(16,2)) as sku_price,
               cast(p_size as bigint) as spu_id, cast(regexp_extract(p_brand, '\\d+') as bigint) as tm_id, p_brand as tm_name,
               cast('0x' || substr(md5(p_type), 1, 8) as bigint) as category3_id, p_type as category3_name,
               s_name as spu_name
        from part left join supplier on s_suppkey = p_size""",
    "wide": """
        select b.*, p.province_name, p.province_area_code, p.province_iso_code, p.province_3166_2_code,
               cast(trunc(date_diff('day', u.birthday, date '2024-01-01') / 365) as integer) as user_age,
               u.gender as user_gender, coalesce(s.sku_name, b.sku_name) as name, s.spu_id, s.tm_id, s.category3_id,
               s.spu_name, s.tm_name, s.category3_name
        from bare b left join provinces p on p.id = b.province_id left join users u on u.key = b.user_id
             left join skus s on s.id = b.sku_id""",
    "paid": """
        select p.*, p.id as payment_id, w.detail_id, w.sku_id, w.name, w.create_time as order_create_time, w.share,
               w.province_name, w.user_age, w.tm_name
        from payment p join wide w on w.order_id = p.order_id
        where w.made between p.made - interval 15 minute and p.made + interval 5 second""",
    "uv": """
        select * from raw_pages where event_type = 'view'
        qualify row_number() over (partition by mid, ts // 86400000 order by ts, log_id) = 1""",
    "jumps": """
        select * from raw_pages e where event_type = 'view' and not exists (
            select 1 from raw_pages f where f.mid = e.mid and f.event_type <> 'view' and f.ts < e.ts + 21600000
               and (f.ts > e.ts or (f.ts = e.ts and f.log_id > e.log_id)))""",
    "fixed_uv": """
        select * from pages where event_type = 'view'
        qualify row_number() over (partition by mid, ts // 86400000 order by ts, log_id) = 1""",
    "fixed_jumps": "select p.* from pages p semi join jumps j on j.log_id = p.log_id",
    "cdc": """
        select 'order_info' as "table",
               case o_orderstatus when 'O' then 'insert' when 'P' then 'bootstrap-insert' else 'update' end as type,
               o_orderkey as xid, 'id,user_id,order_status,priority' as keys, true as filled, o_orderkey as id,
               o_custkey as user_id, o_orderstatus as order_status, o_orderpriority as priority, null as name
        from orders union all
        select 'user_info', case c_mktsegment when 'BUILDING' then 'delete' else 'insert' end, c_custkey + 2000000000,
               'id,name,segment', c_acctbal >= 0, c_custkey, null, null, null, c_name
        from customer""",
    "typed": """select * replace (case type when 'bootstrap-insert' then 'insert' else type end as type) from cdc""",
    "config": """
        select * from (values
            ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,user_id,order_status'),
            ('order_info', 'update', 'kafka', 'dwd_order_info_update', 'id,order_status'),
            ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name')
        ) as t(source_table, operate_type, sink_type, sink_table, kept)""",
    "fresh_config": """
        select * from (values
            ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,user_id,order_status'),
            ('order_info', 'update', 'kafka', 'dwd_order_status', 'id,priority'),
            ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name'),
            ('user_info', 'delete', 'hbase', 'dim_user_gone', 'id')
        ) as t(source_table, operate_type, sink_type, sink_table, kept)""",
    "routed": """select * from typed join config on source_table = "table" and operate_type = type where filled""",
    "order_stats": """
        select strftime(made, '%Y-%m-%d') as day, tm_name, share from wide""",
    "day_tops": """
        select tm_name, sum(share) as order_amount from order_stats where day = '1995-09-06'
        group by tm_name having sum(share) > 0 order by order_amount desc, tm_name limit 5""",
}

_USES = {
    "fixed": ["log"],
    "raw_pages": ["log"],
    "pages": ["fixed"],
    "shown": ["log"],
    "order_detail": ["priced"],
    "bare": ["order_info", "order_detail"],
    "wide": ["bare", "provinces", "users", "skus"],
    "paid": ["payment", "wide"],
    "uv": ["raw_pages"],
    "jumps": ["raw_pages"],
    "fixed_uv": ["pages"],
    "fixed_jumps": ["pages", "jumps"],
    "typed": ["cdc"],
    "routed": ["typed", "config"],
    "order_stats": ["wide"],
    "day_tops": ["order_stats"],
}


def _needed(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for n in [*_needed(_USES.get(name, [])), name]:
            if n not in out:
                out.append(n)
    return out


def _add(name: str, uses: str, sql: str) -> None:
    views = _needed(uses.split())
    head = "with " + ",\n".join(f"{v} as ({_VIEWS[v]})" for v in views) + "\n" if views else ""
    ORACLE[name] = head + sql.strip()


def _window(ts: str, seconds: int) -> str:
    start = f"({ts} // {seconds * 1000}) * {seconds * 1000}"
    text = lambda ms: f"strftime(make_timestamp(({ms}) * 1000), {_TIME})"
    return f"{text(start)} as stt, {text(f'{start} + {seconds * 1000}')} as edt"


_PAGE = "log_id, mid, is_new, ts"

_add("src_page_view", "log", f"""
    select mid, case when event_type <> 'signup' then page_id end as page_id,
           case when event_type <> 'signup' then cast(during_time as varchar) end as during_time, ts,
           strftime(make_timestamp(ts // 1000 * 1000000), {_TIME}) as rowtime from log""")
_add("src_order_wide", "bare", """
    select order_id, sku_id, province_id, cast(share as double) as split_total_amount, create_time as rowtime from bare""")
_add("src_jdbc_query", "", """
    select c_custkey as "cCustkey", c_name as "cName", c_nationkey as "cNationkey", c_acctbal as "cAcctbal",
           c_mktsegment as "cMktsegment" from customer""")
_add("src_dim_lookup", "order_info users", """
    select o.id, cast(o.user_id as varchar) as user_id, 'F' as wanted, cast(u.birthday as varchar) as dim_birthday
    from order_info o left join users u on u.key = o.user_id and u.gender = 'F'""")
_add("src_cdc_rowchange", "", """
    select 'order_info' as "table", event_type, o_orderkey as execute_time, cast(i as integer) as row_no, image,
           cast(o_orderkey as varchar) as id, cast(o_orderkey + i + case image when 'after' then 1 else 0 end as varchar) as amount
    from (select *, case o_orderstatus when 'F' then 'DELETE' when 'P' then 'UPDATE' else 'INSERT' end as event_type
          from orders where o_orderpriority <> '1-URGENT'),
         unnest(range(o_orderkey % 3 + 1)) as u(i), (values ('before'), ('after')) as v(image)
    where event_type = 'UPDATE' or (event_type = 'DELETE') = (image = 'before')""")

_add("sink_kafka", "payment", """
    select '{"id":' || id || ',"order_id":' || order_id || ',"user_id":' || user_id || ',"total_amount":'
           || cast(total_amount as varchar) || ',"subject":"' || subject || '","payment_type":"' || payment_type
           || '","create_time":"' || create_time || '","callback_time":"' || create_time || '"}' as value
    from payment""")
_add("sink_kafka_dynamic", "routed", """
    select sink_table as topic,
           '{"id":"' || id || '"' || case type when 'insert' then ',"user_id":"' || user_id || '"' else '' end
           || ',"order_status":"' || order_status || '"}' as value
    from routed where sink_type = 'kafka'""")
for _name in ("sink_dim_upsert", "sink_dim_fold"):
    _add(_name, "", """
    select cast(c_custkey as varchar) as id, c_name as name, coalesce(o.segment, c_mktsegment) as segment
    from customer left join (select o_custkey, arg_max(o_orderpriority, o_orderkey) as segment from orders group by 1) o
         on o_custkey = c_custkey
    union all
    select cast(o_custkey as varchar), null, arg_max(o_orderpriority, o_orderkey) from orders
    where o_custkey not in (select c_custkey from customer) group by 1""")
_add("dim_table_create", "routed", """
    select cast(id as varchar) as id, name from routed where sink_type = 'hbase'""")
_PROVINCE = "province_id, province_name, province_area_code, province_iso_code, province_3166_2_code"
_add("sink_jdbc_positional", "wide", f"""
    select {_window("epoch_us(made) // 1000", 2)}, {_PROVINCE}, cast(sum(share) as double) as order_amount,
           count(*) as order_count
    from wide group by all""")

_add("parse_json", "log", """
    select log_id, mid, case when event_type = 'signup' then 'icon' end as entry,
           case when event_type <> 'signup' then page_id end as page_id,
           case when event_type = 'click' then n_shown else 0 end as n_displays, ts from log""")
_add("parse_json_dirty", "log", """
    select log_id, ts, null as raw from log union all
    select -1 - doc_id, null, text from documents""")
_add("parse_bean", "order_info", """
    select id, user_id, order_status, cast(total_amount as double) as total_amount, create_time from order_info""")
_add("filter_nonempty_data", "cdc", """select xid, "table", type from cdc where filled""")
_add("project_sink_columns", "cdc", """
    select xid, case when filled then case "table" when 'order_info' then 'id,priority' else 'id,name' end end as kept from cdc""")
_add("filter_entry_page", "raw_pages", f"select {_PAGE} from raw_pages where event_type = 'view'")
_add("filter_keyword", "raw_pages", """
    select p_name as full_word, ts from raw_pages join part on p_partkey = sku where event_type = 'view'""")
_add("derive_order_time", "order_info", """
    select id, strftime(made, '%Y-%m-%d') as create_date, strftime(made, '%H:%M:%S') as create_hour,
           epoch_us(made) // 1000 - 8 * 3600000 as create_ts from order_info""")
_add("derive_age", "users", """
    select id, cast(trunc(date_diff('day', birthday, date '2024-01-01') / 365) as integer) as age from users""")
_add("merge_order_wide", "bare", """
    select detail_id, order_id, sku_id, sku_name, sku_num, province_id, user_id, order_status, create_time,
           strftime(made, '%Y-%m-%d') as create_date, strftime(made, '%H:%M:%S') as create_hour,
           cast(price as double) as order_price, cast(total_amount as double) as total_amount,
           cast(share as double) as split_total_amount, cast(off as double) as split_activity_amount,
           cast(null as double) as split_feight_fee
    from bare""")
_add("coalesce_order_wide", "order_info order_detail", """
    select d.id as detail_id, d.order_id, d.sku_id, d.sku_name, o.user_id, o.order_status, o.create_time,
           cast(null as bigint) as province_id, cast(o.total_amount as double) as total_amount,
           cast(d.share as double) as split_total_amount
    from order_detail d left join order_info o on o.id = d.order_id""")
_add("merge_payment_wide", "payment bare", """
    select p.id as payment_id, p.order_id, b.detail_id, b.sku_id, p.user_id, p.subject, p.payment_type,
           p.create_time as payment_create_time, b.create_time as order_create_time, p.create_time as callback_time,
           cast(p.total_amount as double) as total_amount, cast(b.share as double) as split_total_amount
    from payment p join bare b on b.order_id = p.order_id
    where b.made between p.made - interval 15 minute and p.made + interval 5 second""")
_add("province_from_order", "wide", f"""
    select {_PROVINCE}, cast(share as double) as order_amount, cast(1 as bigint) as order_count from wide""")

_SPLIT = """
    select 'start' as kind, log_id, ts, null as page_id, null as item from log where event_type = 'signup' union all
    select 'display', log_id, ts, page_id, cast(item as varchar) from shown union all
    select 'page', log_id, ts, page_id, coalesce(p_name, cast(sku as varchar))
    from raw_pages left join part on p_partkey = sku and event_type = 'view'"""
_add("dwd_log_split", "log shown raw_pages", _SPLIT)
_add("dwd_log_split_exclusive", "log shown raw_pages", _SPLIT + " where event_type <> 'click' or n_shown = 0")
_add("dwd_log_topics", "fixed shown pages", """
    select 'dwd_start_log' as topic, log_id, is_new, null as page_id, null as item from fixed where event_type = 'signup' union all
    select 'dwd_display_log', s.log_id, f.is_new, s.page_id, cast(item as varchar) from shown s join fixed f on f.log_id = s.log_id union all
    select 'dwd_page_log', log_id, is_new, page_id, coalesce(p_name, cast(sku as varchar))
    from pages left join part on p_partkey = sku and event_type = 'view'""")
_add("dwd_db_route", "routed", """
    select xid, "table", type, sink_type, sink_table, 'id' as sink_pk, kept from routed""")
_add("dwd_db_unrouted", "typed config", """
    select xid, "table", type from typed anti join config on source_table = "table" and operate_type = type where filled""")
_add("cdc_type_normalise", "typed", 'select xid, "table", type from typed')
_add("config_refresh", "typed fresh_config", """
    select xid, "table", type, sink_type, sink_table, 'id' as sink_pk, kept
    from typed join fresh_config on source_table = "table" and operate_type = type where filled""")

_add("join_interval_order_detail", "bare", """
    select order_id, detail_id, sku_id, create_time as order_time, detail_time from bare""")
_add("join_interval_payment_order", "payment order_info", """
    select p.id as payment_id, o.id as order_id, p.create_time as payment_time, o.create_time as order_time
    from payment p join order_info o on o.id = p.order_id
    where o.made between p.made - interval 15 minute and p.made + interval 5 second""")
_add("join_dim", "", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name as spu_name
    from lineitem left join supplier on s_suppkey = l_suppkey""")
_add("join_dim_user", "order_info users", """
    select o.id, o.user_id, cast(trunc(date_diff('day', birthday, date '2024-01-01') / 365) as integer) as user_age,
           gender as user_gender
    from order_info o left join users u on u.key = o.user_id""")
_add("join_dim_province", "order_info provinces", """
    select o.id, o.province_id, province_name, province_area_code, province_iso_code, province_3166_2_code
    from order_info o left join provinces p on p.id = o.province_id""")
_add("join_dim_sku", "order_detail skus", """
    select d.id, d.sku_id, coalesce(s.sku_name, d.sku_name) as sku_name, spu_id, tm_id, category3_id,
           cast(sku_price as double) as sku_price
    from order_detail d left join skus s on s.id = d.sku_id""")
for _name, _columns in {
    "spu": "spu_id, spu_name", "trademark": "tm_id, tm_name", "category3": "category3_id, category3_name",
}.items():
    _add(f"join_dim_{_name}", "order_detail skus", f"""
        select d.id, d.sku_id, {_columns} from order_detail d left join skus s on s.id = d.sku_id""")
_add("dwm_order_wide", "wide", f"""
    select detail_id, order_id, sku_id, name as sku_name, sku_num, user_id, create_time, {_PROVINCE}, user_age, user_gender,
           spu_id, tm_id, category3_id, spu_name, tm_name, category3_name, cast(share as double) as split_total_amount
    from wide""")
_add("dwm_payment_wide", "paid", """
    select payment_id, order_id, detail_id, sku_id, name as sku_name, create_time as payment_create_time, province_name,
           user_age, tm_name, cast(share as double) as split_total_amount from paid""")

_SEGMENT = "vc, ch, ar, is_new"


def _visitor(view: str, uv: str = "0", pv: str = "0", sv: str = "0", uj: str = "0", dur: str = "0") -> str:
    measures = {"uv_ct": uv, "pv_ct": pv, "sv_ct": sv, "uj_ct": uj, "dur_sum": dur}
    return f"select ts, {_SEGMENT}, " + ", ".join(f"cast({v} as bigint) as {m}" for m, v in measures.items()) + f" from {view}"


def _visitor_union(pages: str, uv: str, jumps: str) -> str:
    views = _visitor(pages, pv="1", sv="event_type = 'view'", dur="during_time")
    return " union all ".join([views, _visitor(uv, uv="1"), _visitor(jumps, uj="1")])


_add("vis_pv", "raw_pages", _visitor("raw_pages", pv="1", dur="during_time"))
_add("vis_sv", "raw_pages", _visitor("raw_pages", sv="1") + " where event_type = 'view'")
_add("vis_uv", "uv", _visitor("uv", uv="1"))
_add("vis_uj", "jumps", _visitor("jumps", uj="1"))
_add("union_visitor", "raw_pages uv jumps", _visitor_union("raw_pages", "uv", "jumps"))
_add("dws_visitor", "pages fixed_uv fixed_jumps", f"""
    select {_window("ts", 10)}, {_SEGMENT}, cast(sum(uv_ct) as bigint) as uv_ct, cast(sum(pv_ct) as bigint) as pv_ct,
           cast(sum(sv_ct) as bigint) as sv_ct, cast(sum(uj_ct) as bigint) as uj_ct, cast(sum(dur_sum) as bigint) as dur_sum
    from ({_visitor_union("pages", "fixed_uv", "fixed_jumps")}) group by all""")

_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"]
_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
_ORDERS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id", "refund_order_ct": "refund_order_id"}


def _product(view: str, ts: str, sku: str, where: str = "", money: str = "double", **given: str) -> str:
    columns = [f"cast({ts} as bigint) as ts", f"cast({sku} as bigint) as sku_id"]
    columns += [f"cast({given.get(m, '0')} as bigint) as {m}" for m in _COUNTS]
    columns += [f"cast({given.get(m, '0')} as {money}) as {m}" for m in _AMOUNTS]
    columns += [f"cast({given.get(c, 'null')} as bigint) as {c}" for c in _ORDERS.values()]
    return f"select {', '.join(columns)} from {view} {where}"


def _product_parts(money: str = "double") -> dict[str, str]:
    seconds = "epoch_us(ts) // 1000 // 1000 * 1000"
    return {
        "prod_click": _product("raw_pages", "ts", "sku", "where event_type = 'click'", money, click_ct="1"),
        "prod_display": _product("shown", "ts", "item", "", money, display_ct="1"),
        "prod_favor": _product(
            "events", seconds, "event_id % (select count(*) from part)", "where event_type = 'signup'", money, favor_ct="1"
        ),
        "prod_cart": _product(
            "events", seconds, "event_id % (select count(*) from part)", "where event_type = 'purchase'", money, cart_ct="1"
        ),
        "prod_order": _product(
            "bare", "epoch_us(made) // 1000", "sku_id", "", money, order_amount="share", order_sku_num="sku_num", order_id="order_id"
        ),
        "prod_payment": _product(
            "paid", "epoch_us(made) // 1000", "sku_id", "", money, payment_amount="share", paid_order_id="order_id"
        ),
        "prod_refund": _product(
            "priced", "epoch_us(l_shipdate) // 1000", "l_partkey", "where l_returnflag = 'R'", money,
            refund_amount="share", refund_order_id="l_orderkey",
        ),
        "prod_comment": _product(
            "lineitem", "epoch_us(l_shipdate) // 1000", "l_partkey", "where l_returnflag = 'N'", money,
            comment_ct="1", good_comment_ct="l_discount < 0.05",
        ),
    }


for _name, _sql in _product_parts().items():
    _add(_name, "raw_pages shown bare paid priced", _sql)
_add("union_product", "raw_pages shown bare paid priced", " union all ".join(_product_parts().values()))
_add("dws_product", "raw_pages shown bare paid priced skus", f"""
    select g.*, sku_name, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name, cast(sku_price as double) as sku_price
    from (select {_window("ts", 2)}, sku_id, {", ".join(f"cast(sum({m}) as bigint) as {m}" for m in _COUNTS)},
                 {", ".join(f"cast(sum({m}) as double) as {m}" for m in _AMOUNTS)},
                 {", ".join(f"count(distinct {c}) as {m}" for m, c in _ORDERS.items())}
          from ({" union all ".join(_product_parts("decimal(16,2)").values())}) group by all) g
         left join skus s on s.id = g.sku_id""")
_add("agg_distinct_orders", "", """
    select l_partkey as sku_id, count(distinct l_orderkey) as order_ct,
           count(distinct case when l_linestatus = 'F' then l_orderkey end) as paid_order_ct,
           count(distinct case when l_returnflag = 'R' then l_orderkey end) as refund_order_ct
    from lineitem group by 1""")
_add("dws_province", "wide", f"""
    select {_window("epoch_us(made) // 1000", 2)}, {_PROVINCE}, cast(sum(share) as double) as order_amount, count(*) as order_count,
           count(distinct order_id) as order_dcount from wide group by all""")
_add("dws_keyword", "raw_pages", f"""
    select keyword, count(*) as ct, 'SEARCH' as source, {_window("ts", 2)}
    from (select ts, unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) as keyword
          from raw_pages join part on p_partkey = sku where event_type = 'view')
    group by all""")

_add("ads_gmv_day", "order_stats", """
    select cast(sum(share) as double) as order_amount from order_stats where day = '1995-09-06'""")
_add("ads_gmv_trademark", "day_tops", "select tm_name, cast(order_amount as double) as order_amount from day_tops")
_add("ads_chart_series", "day_tops", """
    select '{"status":0,"data":{"categories":[' || coalesce(string_agg('"' || tm_name || '"', ',' order by order_amount desc, tm_name), '')
           || '],"series":[{"data":[' || coalesce(string_agg(cast(order_amount as varchar), ',' order by order_amount desc, tm_name), '')
           || ']}]}}' as reply
    from day_tops""")
_add("ads_gmv_json", "order_stats", """
    select '{"status":0,"msg":"","data":' || coalesce(cast(sum(share) as varchar), 'null') || '}' as reply
    from order_stats where day = '1995-09-06'""")

_add("win_tumbling", "", f"""
    select {_window("epoch_us(ts) // 1000", 10)}, event_type, count(*) as ct from events group by all""")
ORACLE["wm_monotonic"] = ORACLE["join_interval_payment_order"]
ORACLE["wm_bounded"] = ORACLE["win_tumbling"]
ORACLE |= {f"{n}_shuffled": ORACLE[n] for n in ("dwm_order_wide", "dwm_payment_wide", "join_dim_user", "join_dim_sku")}
ORACLE |= {"stream_visitor": ORACLE["dws_visitor"], "stream_product": ORACLE["dws_product"]}
_add("state_new_visitor", "fixed", f"select {_PAGE} from fixed")
_add("state_unique_visit", "uv", f"select {_PAGE} from uv")
_add("state_unique_visit_zone", "raw_pages", f"""
    select {_PAGE} from raw_pages where event_type = 'view'
    qualify row_number() over (partition by mid, (ts + 28800000) // 86400000 order by ts, log_id) = 1""")
_add("state_unique_visit_first_day", "raw_pages", f"""
    select {_PAGE} from raw_pages where event_type = 'view'
    qualify ts // 86400000 = min(ts // 86400000) over (partition by mid)""")
_add("state_user_jump", "jumps", f"select {_PAGE} from jumps")
_add("stream_user_jump", "jumps", f"select {_PAGE} from jumps")
_add("stream_unique_visit_first_day", "raw_pages", f"""
    select {_PAGE} from raw_pages where event_type = 'view'
    qualify ts // 86400000 = min(ts // 86400000) over (partition by mid)""")
_add("state_user_jump_10s", "raw_pages", f"""
    select {_PAGE} from raw_pages e where event_type = 'view' and not exists (
        select 1 from raw_pages f where f.mid = e.mid and f.event_type <> 'view' and f.ts < e.ts + 10000
           and (f.ts > e.ts or (f.ts = e.ts and f.log_id > e.log_id)))""")

_add("fn_time", "", f"""
    select event_id, strftime(ts + interval 8 hour, '%Y-%m-%d') as day, strftime(ts + interval 8 hour, {_TIME}) as shop_time,
           cast(strftime(ts, '%Y%m%d') as integer) as day_number, epoch_us(ts) // 1000 // 1000 * 1000 as shop_millis
    from events""")
_add("udtf_tokenize", "", r"""
    select keyword, count(*) as ct, min(doc_id) as first_doc
    from (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as keyword from documents) group by 1""")
_add("udtf_tokenize_phrase", "", r"""
    select p_partkey, unnest(regexp_extract_all(lower(p_name), '[\p{L}\p{N}]+')) as keyword from part""")


_HAN_LIST = ", ".join(f"'{w}'" for w in queries.HAN_WORDS)
_add("udtf_tokenize_word_list", "", rf"""
    with recursive runs as (
        select p_partkey, unnest(regexp_extract_all(translate(lower(p_name), '{queries.LETTERS}', '{queries.HAN}'), '\p{{Han}}+|[0-9qxz]+')) as run
        from part),
    cuts(run, pos, sizes) as (
        select distinct run, 0, cast([] as bigint[]) from runs where regexp_matches(run, '\p{{Han}}')
        union all
        select run, pos + n, list_append(sizes, n) from cuts, range(1, 12) t(n)
        where pos + n <= length(run) and (n = 1 or substr(run, pos + 1, n) in ({_HAN_LIST}))),
    best as (
        select run, min({{'n': len(sizes), 's': list_transform(sizes, lambda x: -x)}}).s as less from cuts where pos = length(run) group by run),
    pieces as (
        select run, substr(run, cast(1 - coalesce(list_sum(less[1 : i - 1]), 0) as bigint), -less[i]) as keyword
        from (select run, less, unnest(range(1, len(less) + 1)) as i from best))
    select p_partkey, coalesce(keyword, run) as keyword from runs left join pieces using (run)""")
