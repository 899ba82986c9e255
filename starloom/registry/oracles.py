"""For each registered query, plain SQL over the same tables that must give the same rows."""

from __future__ import annotations

# -- building blocks, each a list of common table expressions -----------------------

_PERSON = """
person as (
  select c_custkey id, c_mktsegment title, c_name first_name, concat('of ', c_mktsegment) last_name,
         lower(c_mktsegment) middle_name, cast(c_nationkey as varchar) suffix, s.ts person_ts
  from customer join (select user_id, max(ts) ts from events where event_type = 'signup' group by user_id) s
    on c_custkey = s.user_id),
email as (
  select user_id id, concat('user', cast(user_id as varchar)) address, max(ts) email_ts
  from events where event_type = 'click' and value > 130 group by user_id)"""

# Money as exact integers: price and totals in 1/10000, so that a share of tax or
# freight is a quotient of integers, rounded half up to 6 digits like a decimal.
_HEADER = """
totals as (
  select l_orderkey, sum(cast(round(l_extendedprice * 10000) as hugeint)) sub_total,
         sum(cast(round(l_extendedprice * 100) as hugeint) * cast(round(l_tax * 100) as hugeint)) tax,
         min(l_shipdate) due, max(l_shipdate) shipped, min(l_suppkey) seller, max(l_suppkey) ship_to
  from lineitem group by l_orderkey)"""


def _share(amount: str) -> str:
    price, whole = "cast(round(l_extendedprice * 10000) as hugeint)", "cast(sub_total as hugeint)"
    millionths = f"(2 * {amount} * {price} * 100 + {whole}) // (2 * {whole})"
    return f"cast(cast({millionths} as decimal(20,0)) * cast(0.000001 as decimal(7,6)) as decimal(38,6))"


_STAGED = (
    _HEADER
    + """,
lines as (
  select *, row_number() over (partition by l_orderkey
              order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) rn from lineitem),
staged as (
  select concat('SO', cast(o_orderkey as varchar)) "SalesOrderNumber", cast(rn as int) "SalesOrderLineNumber",
         1 "RevisionNumber", l_partkey "ProductAK", o_custkey "CustomerAK", seller "EmployeeAK",
         cast(round(l_discount * 100) as int) "PromotionAK", c_nationkey "SalesTerritoryAK",
         o_custkey "BillToAddressAK", ship_to "ShipToAddressAK",
         cast(strftime(o_orderdate, '%Y%m%d') as int) "OrderDateKey",
         cast(strftime(shipped, '%Y%m%d') as int) "ShipDateKey",
         cast(strftime(due, '%Y%m%d') as int) "DueDateKey",
         cast(l_quantity as smallint) "OrderQuantity", cast(l_extendedprice as decimal(19,4)) "UnitPrice",
         cast(l_discount as decimal(19,4)) "DiscountAmount", cast(p_retailprice as decimal(19,4)) "ProductStandardCost",
         cast(cast(p_retailprice as decimal(19,4)) * cast(l_quantity as smallint) as decimal(25,4)) "TotalProductCost",
         cast(l_extendedprice as decimal(19,4)) "SalesAmount",
         """
    + _share("cast(tax as hugeint)")
    + """ "TaxAmount",
         """
    + _share("cast(round(o_totalprice * 10000) as hugeint)")
    + """ "FreightAmount"
  from orders join lines on o_orderkey = lines.l_orderkey
    join totals on o_orderkey = totals.l_orderkey
    join part on l_partkey = p_partkey
    left join customer on o_custkey = c_custkey)"""
)

_KNOWN_CUSTOMERS = """
known as (
  select distinct o_custkey + 1 k, o_custkey ak from orders where o_orderdate < timestamp '1996-01-01 00:00:00')"""

_KNOWN_PRODUCTS = """
products as (
  select distinct l_partkey + 1 k, l_partkey ak from lineitem where l_shipdate < timestamp '1995-04-01 00:00:00')"""

_LOADED = """
loaded as (
  select distinct l_orderkey, l_linenumber from lineitem where l_shipdate < timestamp '1998-01-01 00:00:00')"""

_SPAN = "(select min(cast(o_orderdate as date)) lo, max(cast(o_orderdate as date)) hi from orders)"

_CALENDAR = f"""
calendar as (
  select cast(strftime(d, '%Y%m%d') as int) date_key, d date_date, cast(year(d) as int) "year",
         cast(month(d) as int) "month", cast(day(d) as int) "day", cast(weekofyear(d) as int) week_of_year,
         cast(dayofweek(d) + 1 as int) day_of_week
  from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) d from {_SPAN}))"""


def _status(name: str, condition: str) -> str:
    return f"""
{name} as (
  select ak, status from (
    select o_custkey ak, case when o_orderpriority <> '5-LOW' then o_orderpriority end status,
           row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn
    from orders where {condition}) where rn = 1)"""


_HISTORY = (
    _status("v1", "o_orderdate < timestamp '1996-01-01 00:00:00'")
    + ","
    + _status("v2", "o_orderdate < timestamp '1998-01-01 00:00:00'")
    + ","
    + _status("stg", "true")
    + """,
dest as (
  select v1.ak * 2 + 1 k, v1.ak, v1.status, timestamp '1996-01-01 00:00:00' loaded,
         case when v1.status is distinct from v2.status then timestamp '1998-01-01 00:00:00' end expired
  from v1 join v2 on v1.ak = v2.ak
  union all
  select v2.ak * 2 + 2, v2.ak, v2.status, timestamp '1998-01-01 00:00:00', null
  from v2 left join v1 on v1.ak = v2.ak where v1.ak is null or v1.status is distinct from v2.status),
chg as (
  select dest.k, dest.ak, dest.status was, stg.status now from dest join stg on dest.ak = stg.ak
  where dest.expired is null and dest.status is distinct from stg.status)"""
)

_INFERRED = (
    _KNOWN_CUSTOMERS
    + """,
unheard as (
  select ak, row_number() over (order by ak) + (select max(k) from known) k
  from (select distinct o_custkey ak from orders) where ak not in (select ak from known))"""
)


def _window(strict: bool) -> str:
    low, high = "timestamp '2024-01-28 00:00:00'", "timestamp '2024-01-30 00:00:00'"
    loose_rule = (
        f"(email_ts > {low} or person_ts > {low}) and (email_ts <= {high} or person_ts <= {high})"
    )
    strict_rule = f"greatest(email_ts, person_ts) > {low} and greatest(email_ts, person_ts) <= {high}"
    return f"""
with {_PERSON}
select c_custkey "CustomerAK", title "Title", first_name "FirstName", last_name "LastName",
       middle_name "MiddleName", suffix "Suffix", address "EmailAddress",
       timestamp '2024-02-01 00:00:00' "LoadDate", 0 "Inferred"
from customer join person on c_custkey = person.id left join email on person.id = email.id
where {strict_rule if strict else loose_rule}"""


_MONEY_COLUMNS = ["UnitPrice", "ProductStandardCost", "TotalProductCost", "SalesAmount", "TaxAmount", "FreightAmount"]

_STAR = f"""
with {_STAGED}, {_PERSON},
cust as (
  select id ak, row_number() over (order by id) k from person
  where person_ts <= timestamp '2024-02-01 00:00:00'),
buyers as (
  select ak, k from cust union all
  select ak, row_number() over (order by ak) + (select count(*) from cust)
  from (select distinct "CustomerAK" ak from staged) where ak not in (select ak from cust)),
prod as (select p_partkey ak, row_number() over (order by p_partkey) k from part),
promo as (
  select ak, row_number() over (order by ak) k
  from (select distinct cast(round(l_discount * 100) as int) ak from lineitem)),
addr as (select c_custkey ak, row_number() over (order by c_custkey) k from customer),
terr as (select n_nationkey ak, row_number() over (order by n_nationkey) k from nation),
emp as (select s_suppkey ak, row_number() over (order by s_suppkey) k from supplier)
select "SalesOrderNumber", "SalesOrderLineNumber", "RevisionNumber", prod.k "ProductKey", emp.k "SalesPersonKey",
       buyers.k "CustomerKey", bill.k "BillToAddressKey", ship.k "ShipToAddressKey", promo.k "PromotionKey",
       terr.k "SalesTerritoryKey", "OrderDateKey", "DueDateKey", "ShipDateKey", "OrderQuantity",
       cast("DiscountAmount" as float) "DiscountAmount",
       {", ".join(f'cast("{c}" as decimal(10,2)) "{c}"' for c in _MONEY_COLUMNS)}
from staged
  left join buyers on "CustomerAK" = buyers.ak left join emp on "EmployeeAK" = emp.ak
  left join promo on "PromotionAK" = promo.ak left join prod on "ProductAK" = prod.ak
  left join addr bill on "BillToAddressAK" = bill.ak left join addr ship on "ShipToAddressAK" = ship.ak
  left join terr on "SalesTerritoryAK" = terr.ak"""

_STAR_COUNTS = """
select 'DimCustomer' table_name, count(*) "rows" from (
  select user_id from events where event_type = 'signup' union
  select o_custkey from orders where o_orderkey in (select l_orderkey from lineitem))
union all select 'DimProduct', count(*) from part
union all select 'DimPromotion', count(distinct round(l_discount * 100)) from lineitem
union all select 'DimSalesTerritory', count(*) from nation
union all select 'DimGeography', count(*) from customer
union all select 'DimEmployee', count(*) from supplier
union all select 'DimDate', date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 from orders
union all select 'FactSales', count(*) from lineitem"""

_INCREMENTAL = f"""
with {_PERSON},
people as (
  select person.id, first_name, address, person_ts, email_ts from person left join email on person.id = email.id),
first_window as (
  select * from people
  where person_ts <= timestamp '2024-01-20 00:00:00' or email_ts <= timestamp '2024-01-20 00:00:00'),
second_window as (
  select * from people
  where (person_ts > timestamp '2024-01-20 00:00:00' or email_ts > timestamp '2024-01-20 00:00:00')
    and (person_ts <= timestamp '2024-02-01 00:00:00' or email_ts <= timestamp '2024-02-01 00:00:00')),
sold as (
  select o_custkey ak, min(o_orderdate) < timestamp '1996-01-01 00:00:00' early
  from orders where o_orderkey in (select l_orderkey from lineitem) group by o_custkey),
a as (select id ak, row_number() over (order by id) k from first_window),
b as (
  select ak, row_number() over (order by ak) + (select count(*) from a) k from sold
  where early and ak not in (select ak from a)),
ab as (select ak, k from a union all select ak, k from b),
c as (
  select id ak, row_number() over (order by id) + (select count(*) from ab) k from second_window
  where id not in (select ak from ab)),
abc as (select ak, k from ab union all select ak, k from c),
d as (
  select ak, row_number() over (order by ak) + (select count(*) from abc) k from sold
  where ak not in (select ak from abc)),
members as (select ak, k from abc union all select ak, k from d)
select members.k "CustomerKey", members.ak "CustomerAK", p.first_name "FirstName", p.address "EmailAddress",
       case when p.id is null then 1 else 0 end "Inferred"
from members left join (select * from first_window union select * from second_window) p on members.ak = p.id"""


ORACLES: dict[str, str] = {
    "scan_tsv": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
    "scan_parquet": "select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem",
    "sink_roundtrip": "select * from orders",
    "sink_append": "select c_custkey ak, c_name name, c_mktsegment segment from customer",
    "sink_rewrite": "select c_custkey ak, lower(c_mktsegment) segment from customer",
    "scan_rejects": """
select c_custkey, case when c_nationkey not in (3, 5) and c_acctbal >= 0 then round(c_acctbal)::bigint end balance,
       case when c_nationkey = 3 then 'short' when c_nationkey = 5 then 'long' when c_acctbal < 0 then 'mistyped' else 'kept' end outcome
from customer""",
    "describe_table": """
select column_name col_name, case column_type when 'INTEGER' then 'int' when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz'
       else lower(column_type) end data_type
from (describe orders) union all select 'Provider', 'parquet' union all select 'Statistics', count(*)::varchar from orders""",
    "landed_files": """
select o_orderkey, round(o_totalprice * 100)::bigint + case when o_orderpriority like '1%' then 1 else 0 end cents,
       case when o_orderpriority like '1%' then 2 else 1 end run
from orders where o_orderpriority not like '5%'""",
    "sink_batches": """
select l_orderkey, l_linenumber, l_partkey, (year(l_shipdate) * 100 + month(l_shipdate))::int "month",
       (case when l_shipdate < timestamp '1997-01-01 00:00:00' then 1 else 2 end)::bigint batch
from lineitem""",
    "anti_new_months": """
select o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d')::int "day" from orders
where o_orderdate >= timestamp '1998-01-01 00:00:00'""",
    "changed_sources": """
select 'customer' staging, false rebuild, count(*) n_rows from customer union all select 'orders', true, count(*) from orders""",
    "dim_geography": """
select c_custkey "GeographyAK", c_name "AddressLine1", concat('Unit ', cast(c_custkey as varchar)) "AddressLine2",
       c_mktsegment "City", cast(n_nationkey as varchar) "StateProvinceCode", n_name "StateProvinceName",
       cast(c_nationkey as varchar) "PostalCode", cast(r_regionkey as varchar) "CountryRegionCode",
       r_name "CountryRegionName"
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "dim_territory": """
select n_nationkey "SalesTerritoryAK", n_name "SalesTerritoryName",
       cast(n_regionkey as varchar) "SalesCountryRegionCode", r_name "SalesCountryRegionName"
from nation join region on n_regionkey = r_regionkey""",
    "dim_product": """
with sub as (select p_brand id, concat('Sub ', p_brand) name, min(p_type) cat from part where p_size < 3 group by p_brand),
cat as (select distinct p_type id, concat('Cat ', p_type) name from part where p_type <> 'ECONOMY'),
model as (
  select distinct p_size id, case when p_size < 10 then 'NULL' else concat('Model ', cast(p_size as varchar)) end name
  from part where p_size <= 40)
select p_partkey "ProductAK", p_brand "ProductNumber", p_name "ProductName", sub.name "ProductSubCategoryName",
       cat.name "ProductCategoryName", p_size > 25 "FinishedGoodsFlag", split_part(p_name, ' ', 1) "Color",
       cast(p_retailprice as decimal(19,4)) "StandardCost", cast(p_retailprice as decimal(19,4)) "ListPrice", cast(p_size as varchar) "Size",
       lower(p_type) "ProductLine", lower(p_brand) "Class", p_type "Style",
       case when model.name is null or model.name = 'NULL' then '' else model.name end "ProductModelName"
from part left join sub on p_brand = sub.id left join cat on sub.cat = cat.id left join model on p_size = model.id""",
    "dim_promotion": """
select distinct cast(round(l_discount * 100) as int) "PromotionAK",
       concat('Discount ', cast(cast(round(l_discount * 100) as int) as varchar)) "PromotionName",
       cast(l_discount as decimal(19,4)) "DiscountPercentage", l_returnflag "PromotionType"
from lineitem""",
    "dim_employee": f"""
with {_PERSON}
select s_suppkey "EmployeeAK", title "Title", first_name "FirstName", last_name "LastName",
       middle_name "MiddleName", suffix "Suffix", address "EmailAddress", s_name "JobTitle",
       s_acctbal > 0 "CurrentFlag", timestamp '2024-02-01 00:00:00' "LoadDate"
from supplier left join person on s_suppkey = person.id left join email on s_suppkey = email.id""",
    "dim_customer_window": _window(strict=False),
    "dim_customer_window_strict": _window(strict=True),
    "null_token_clean": """
select c_custkey, case when c_acctbal < 0 or c_mktsegment in ('FURNITURE', 'MACHINERY') then '' else c_mktsegment end segment
from customer""",
    "dim_date": f"with {_CALENDAR} select * from calendar",
    "dim_date_append": f"""
with {_CALENDAR}
select * from calendar
where date_date not in (select cast(o_orderdate as date) from orders where o_orderpriority = '1-URGENT')""",
    "calendar_gap": f"""
select date_diff('day', s.lo, s.hi) + 1 expected_days,
       (select count(distinct cast(o_orderdate as date)) from orders where o_orderpriority = '1-URGENT') present_days
from {_SPAN} s""",
    "stg_sales": f"with {_STAGED} select * from staged",
    "line_numbers_in_large_groups": """
select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
       cast(row_number() over (partition by l_returnflag
              order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as int) n
from lineitem""",
    "max_key": "select max(c_custkey) max_key, cast(0 as bigint) empty_max from customer",
    "insert_new_keys": f"""
with {_KNOWN_CUSTOMERS}
select row_number() over (order by c_custkey) + (select max(k) from known) "CustomerKey", c_custkey "CustomerAK"
from customer where c_custkey not in (select ak from known)""",
    "insert_new_text_keys": f"""
with {_KNOWN_CUSTOMERS}
select row_number() over (order by c_name) + (select max(k) from known) "CustomerKey", c_name "NameAK"
from (select distinct c_name from customer join orders on c_custkey = o_custkey
      where c_custkey not in (select ak from known))""",
    "insert_new_together": """
select count(*) n_rows, count(distinct c_custkey) n_keys, 1::bigint least, count(*) greatest, count(distinct c_nationkey < 12) dense_loads
from customer""",
    "load_stats": f"""
with {_KNOWN_CUSTOMERS}
select count(*) staged, count(*) - count(ak) new_rows, count(ak) existing_rows
from orders left join known on o_custkey = ak""",
    "profile_distinct": "select distinct p_brand from part",
    "preview_limit": "select p_partkey, p_name from part order by p_partkey limit 10",
    "except_distinct": """
select l_returnflag, l_linestatus from lineitem
except select l_returnflag, l_linestatus from lineitem where l_returnflag = 'R'""",
    "anti_new_rows": f"""
with {_LOADED}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate from lineitem
where l_orderkey not in (select l_orderkey from loaded)""",
    "anti_new_lines": f"""
with {_LOADED}
select l.l_orderkey, l.l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
from lineitem l left join loaded on l.l_orderkey = loaded.l_orderkey and l.l_linenumber = loaded.l_linenumber
where loaded.l_orderkey is null""",
    "lookup_key": f"""
with {_KNOWN_PRODUCTS}
select l_orderkey, l_linenumber, l_suppkey, k "ProductKey" from lineitem left join products on l_partkey = ak""",
    "lookup_mixed_type_keys": f"""
with {_KNOWN_PRODUCTS},
buyers as (select distinct o_custkey ck from orders where o_orderdate < timestamp '1996-01-01 00:00:00')
select l_orderkey, l_linenumber, k "ProductKey", ck + 1 "CustomerKey"
from lineitem left join products on l_partkey = ak left join buyers on l_suppkey = ck and l_linenumber % 2 = 0""",
    "lookup_unknown_key": f"""
with {_KNOWN_PRODUCTS}
select l_orderkey, l_linenumber, l_suppkey, coalesce(k, -1) "ProductKey"
from lineitem left join products on l_partkey = ak""",
    "lookup_missing": f"""
with {_KNOWN_PRODUCTS}
select distinct l_partkey "ProductAK" from lineitem where l_partkey not in (select ak from products)""",
    "lookup_current_version": f"""
with {_HISTORY}
select o_orderkey, k status_key from orders left join (select * from dest where expired is null) d on o_custkey = d.ak""",
    "lookup_role_playing": f"""
with {_KNOWN_CUSTOMERS}
select o_orderkey, l_linenumber, l_partkey, b.k "BillToKey", s.k "ShipToKey"
from orders join lineitem on o_orderkey = l_orderkey
  left join known b on o_custkey = b.ak left join known s on l_suppkey = s.ak""",
    "inferred_members": f"""
with {_INFERRED}
select k "CustomerKey", ak "CustomerAK", cast(null as varchar) "Name",
       timestamp '2024-02-01 00:00:00' "LoadDate", 1 "Inferred" from unheard""",
    "fact_with_inferred": f"""
with {_INFERRED}
select o_orderkey, m.k "CustomerKey" from orders
join (select ak, k from known union all select ak, k from unheard) m on o_custkey = m.ak""",
    "inferred_resolve": f"""
with {_KNOWN_CUSTOMERS},
arrived as (select distinct o_custkey ak from orders where o_orderdate < timestamp '1998-01-01 00:00:00')
select c_custkey + 1 k, c_custkey ak, case when known.ak is not null or arrived.ak is not null then c_name end name,
       case when known.ak is not null or arrived.ak is not null then 0 else 1 end inferred
from customer left join known on c_custkey = known.ak left join arrived on c_custkey = arrived.ak""",
    "scd2_changed": f"with {_HISTORY} select k, ak, was old_status, now new_status from chg",
    "scd2_apply": f"""
with {_HISTORY}
select dest.k, dest.ak, dest.status, loaded,
       case when chg.k is not null then timestamp '2024-02-01 00:00:00' else expired end expired
from dest left join chg on dest.k = chg.k
union all
select row_number() over (order by ak) + (select max(k) from dest), ak, now, timestamp '2024-02-01 00:00:00', null
from chg""",
    "fact_load": f"""
with {_KNOWN_CUSTOMERS}, {_KNOWN_PRODUCTS}, {_LOADED}
select l_orderkey, l_linenumber, cast(strftime(o_orderdate, '%Y%m%d') as int) "OrderDateKey", b.k "CustomerKey",
       products.k "ProductKey", b.k "BillToKey", s.k "ShipToKey", l_extendedprice "SalesAmount"
from orders join lineitem on o_orderkey = l_orderkey
  left join known b on o_custkey = b.ak left join known s on l_suppkey = s.ak
  left join products on l_partkey = products.ak
where l_orderkey not in (select l_orderkey from loaded)""",
    "watermark_read": """
with ctl as (select event_type, case when event_type <> 'error' then max(ts) end ts from events group by event_type)
select flow "DataFlowName", coalesce(ts, timestamp '1900-01-01 00:00:00') "LastSuccessfulModifiedDate",
       '2024-02-01 00:00:00' "CurrentDate"
from (select unnest(['click', 'error', 'absent']) flow) left join ctl on flow = event_type""",
    "watermark_zone": """
select 'click' "DataFlowName", max(ts) "LastSuccessfulModifiedDate", '2024-02-01 00:00:00' "CurrentDate",
       regexp_replace(current_setting('TimeZone'), '^Etc/', '') "CurrentTimezone"
from events where event_type = 'click'""",
    "watermark_upsert": """
select event_type "DataFlowName",
       case event_type when 'click' then timestamp '2024-02-01 00:00:00' when 'error' then null else max(ts) end
         "LastSuccessfulModifiedDate"
from events group by event_type""",
    "watermark_seed": """
select event_type "DataFlowName", case when event_type <> 'error' then max(ts) end "LastSuccessfulModifiedDate"
from events group by event_type
union all select 'view_daily', null""",
    "star_load": _STAR,
    "star_reload": _STAR_COUNTS,
    "star_incremental": _INCREMENTAL,
    "star_from_files": _INCREMENTAL,
    "star_optional_source": f'select * replace (null::bigint as "PromotionKey") from ({_STAR})',
}
ORACLES["footer_bounds"] = """
select 'orders' table_name, count(*) n_rows, min(o_orderkey) min_0, max(o_orderkey) max_0, min(o_custkey) min_1, max(o_custkey) max_1 from orders
union all select 'lineitem', count(*), min(l_orderkey), max(l_orderkey), min(l_partkey), max(l_partkey) from lineitem"""
ORACLES["lookup_bucketed"] = ORACLES["lookup_role_playing"]
ORACLES["history_partitions"] = ORACLES["scd2_apply"]
