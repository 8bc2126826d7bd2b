"""The same queries in plain SQL for an independent engine, one text per query.

Written over the raw tables; a common table expression is added to a query if its text names it.
"""

from __future__ import annotations

import re

BASES = ["before_stock", "before_onroad_stock", "before_sub_stock", "before_include_stock"]
SOURCED = [
    "before_stock", "before_onroad_stock", "before_sub_stock", "before_include_stock", "after_model_stock",
    "after_sub_stock", "after_model_include_stock", "after_wh_sub_stock", "onroad_stock", "onorder_in_stock",
    "onorder_out_stock", "forecast_stock",
]
SALES = ["q7", "q14", "qt"]
FIGURES = [*SALES, *SOURCED, "committed_out", "after_model_onroad_stock"]
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

CTE: dict[str, str] = {}


def cat(items, sep=", ") -> str:
    return sep.join(items)


def sums(columns, prefix="") -> str:
    return cat(f"cast(sum({prefix}{c}) as bigint) as {c}" for c in columns)


def json(metric: str, size: str = "size") -> str:
    """One bundle: an array of key/value objects sorted by key."""
    item = f"""'{{"key":"' || {size} || '","value":' || coalesce(cast({metric} as varchar), 'null') || '}}'"""
    return f"'[' || string_agg({item}, ',' order by {size}) || ']'"


def bundles(metrics, names=None) -> str:
    return cat(f"{json(m)} as {n}" for m, n in zip(metrics, names or metrics))


def totals(source: str, keys, metrics, where: str = "") -> str:
    """Sums per size and in total."""
    k = cat(keys)
    return f"""select {k}, case when grouping(size) = 1 then 'total' else size end as size, {sums(metrics)},
      cast(grouping(size) as integer) as grouping_id
    from {source} {where} group by grouping sets (({k}, size), ({k}))"""


# --- tables ------------------------------------------------------------------------------------------

CTE["doc_lines"] = """
  select l_orderkey || '-' || p_brand || '-' || s_nationkey as doc,
    cast(s_nationkey as varchar) as out_org, cast(c_nationkey as varchar) as in_org,
    cast(s_nationkey as varchar) as model_out_org,
    case when l_linestatus <> 'F' then cast(c_nationkey as varchar) end as model_in_org,
    p_brand as skc, p_type as size, p_brand || '|' || p_type as sku,
    cast(l_quantity as bigint) as model_qty,
    case when l_returnflag = 'R' then 0 else cast(l_quantity as bigint) end as human_qty,
    o_orderpriority as template, cast(year(o_orderdate) as integer) as batch,
    case o_orderstatus when 'F' then '0' when 'O' then '1' else '2' end as source, c_mktsegment as scene,
    case when o_orderdate < timestamp '2001-07-29' then '0'
      when l_returnflag = 'N' then '1' when l_returnflag = 'A' then '2' else '3' end as status,
    cast(o_orderdate as date) as day, greatest(cast(o_orderdate as date), date '2001-08-01') as run_day,
    case when l_tax = 0 and l_discount = 0 then '1' else '0' end as is_deleted,
    case l_returnflag when 'R' then '' when 'A' then 'None' else 'P' || l_orderkey end as plan_id,
    case when l_linestatus = 'O' then 'C' || o_custkey end as collection_id,
    case when l_quantity >= 34 then '1' when l_quantity >= 17 then '2' when l_quantity >= 5 then '3' else '9' end
      as level_code
  from lineitem, orders, customer, supplier, part
  where l_orderkey = o_orderkey and o_custkey = c_custkey and l_suppkey = s_suppkey and l_partkey = p_partkey"""
CTE["moves"] = "select * from doc_lines where is_deleted = '0'"
CTE["changed_docs"] = "select distinct doc from moves where status <> '0'"
CTE["changed_pairs"] = """
  select out_org as org, skc from moves where status in ('1', '2', '3')
  union select in_org, skc from moves where status in ('1', '2', '3')"""
CTE["part_classes"] = """
  select *, case depth when 1 then c1 when 2 then c1 || ':' || c2 when 3 then c1 || ':' || c2 || ':' || c3
      when 4 then c1 || ':' || c2 || ':' || c3 || ':' || c4
      else c1 || ':' || c2 || ':' || c3 || ':' || c4 || ':' || c5 end as class_codes,
    case depth when 1 then 'TYPE' when 2 then 'TYPE:BRAND' when 3 then 'TYPE:BRAND:SIZE'
      when 4 then 'TYPE:BRAND:SIZE:NAME' else 'TYPE:BRAND:SIZE:NAME:PART' end as class_types
  from (select *, p_type as c1, p_brand as c2, cast(p_size as varchar) as c3, p_name as c4,
      cast(p_partkey as varchar) as c5,
      case when p_size <= 1 then 1 when p_size <= 16 then 2 when p_size <= 33 then 3 when p_size <= 48 then 4 else 5
      end as depth from part)"""
CTE["class_labels"] = """
  select p_partkey, p_brand, depth,
    case depth when 2 then split_part(class_codes, ':', 1) when 3 then split_part(class_codes, ':', 2)
      when 4 then split_part(class_codes, ':', 3) end as level_code,
    case when depth between 2 and 4 then
      split_part(class_types, ':', 1) || '#' || split_part(class_codes, ':', 1)
      || case when depth >= 3 then '&' || split_part(class_types, ':', 2) || '#' || split_part(class_codes, ':', 2)
         else '' end
      || case when depth >= 4 then '&' || split_part(class_types, ':', 3) || '#' || split_part(class_codes, ':', 3)
         else '' end end as class_label
  from part_classes"""
CTE["dim_skc"] = """
  select p.p_brand as skc, cast(p.p_size as varchar) as suit, p.p_name as spu, p.p_type as color,
    l.level_code as class_level_code, l.class_label
  from part p join (select p_brand, min(p_partkey) as k from part group by 1) f on p.p_partkey = f.k
  join class_labels l on l.p_partkey = p.p_partkey"""
CTE["dim_sku"] = """
  select distinct p_brand || '|' || p_type as sku, p_brand as skc, p_type as size, suit, spu
  from part join dim_skc on p_brand = skc"""
CTE["dim_org"] = """
  select cast(n_nationkey as varchar) as org, 'R' || r_regionkey as parent, n_name as org_code,
    'Store ' || n_name as org_name, 2 as org_type,
    case when r_name = 'MIDDLE EAST' then '2' else '1' end as org_flag,
    case when n_name = 'NATION_24' then 'closed' else 'open' end as status, 'Manager ' || n_nationkey as store_manager,
    r_name as region, case when r_name in ('EUROPE', 'MIDDLE EAST') then 'V' else 'U' end as unit
  from nation join region on n_regionkey = r_regionkey
  union all
  select 'R' || r_regionkey, case when r_name in ('EUROPE', 'MIDDLE EAST') then 'V' else 'U' end, r_name,
    'Region ' || r_name, 1, null, 'open', null, r_name, case when r_name in ('EUROPE', 'MIDDLE EAST') then 'V' else 'U' end
  from region"""
CTE["templates"] = "select distinct o_orderpriority as template from orders"
CTE["levels"] = """
  select template, case template when '1-URGENT' then 'region' when '2-HIGH' then 'store' when '3-MEDIUM' then 'region'
    else 'operating_unit' end as level from templates"""
CTE["managers"] = """
  select o.org, l.template, l.level, o.org_code, o.org_name, o.org_flag,
    case when o.org_flag = '2' or l.level = 'region' then p.org when l.level = 'store' then o.org else o.unit end
      as manager_org,
    case when o.org_flag = '2' or l.level = 'region' then p.org_code when l.level = 'store' then o.org_code
      when o.unit = 'U' then 'WORLD' else 'WORLD-V' end as manager_code,
    case when o.org_flag = '2' or l.level = 'region' then p.org_name when l.level = 'store' then o.org_name
      when o.unit = 'U' then 'World' else 'World V' end as manager_name,
    case when o.org_flag <> '2' then o.store_manager end as store_manager
  from dim_org o join dim_org p on o.parent = p.org, levels l where o.org_type = 2 and o.status = 'open'"""
CTE["org_infos"] = """
  select o.org, o.org_code, o.org_name, p.org_code as manager_code, p.org_name as manager_name, o.org_flag,
    o.store_manager, b.p_brand as brand
  from dim_org o join dim_org p on o.parent = p.org
  join (select p_brand, max(p_size) as largest from part group by 1) b on o.unit = 'U' or b.largest >= 48 where o.org_type = 2 and o.status = 'open'"""
CTE["updated_orgs"] = "select org from dim_org where org_type = 2 and region in ('AMERICA', 'ASIA', 'EUROPE')"
CTE["ledger"] = """
  select cast(s_nationkey as varchar) as org, p_brand || '|' || p_type as sku, p_brand as skc, p_type as size,
    cast(l_quantity as bigint) as qty, cast(l_shipdate as date) as ship_day, l_returnflag, l_linestatus, l_discount,
    l_tax from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey"""


def _stock(source: str) -> str:
    return f"""
  select org, sku, skc, size, q7, q14, qt, first_day, opening as before_stock, opening + onroad as before_onroad_stock,
    opening - oout as before_sub_stock, opening + onroad + oin - oout as before_include_stock,
    opening - returned as after_model_stock, opening - returned - oout as after_sub_stock,
    opening - returned + onroad + oin - oout as after_model_include_stock,
    opening - returned - committed as after_wh_sub_stock, onroad as onroad_stock, oin as onorder_in_stock,
    oout as onorder_out_stock, committed as committed_out, opening + onroad - committed as forecast_stock,
    case when qt >= 300 then '1' when qt >= 100 then '2' else '3' end as level_code
  from (select org, sku, skc, size, min(ship_day) as first_day,
      cast(coalesce(sum(qty) filter (where ship_day < date '1997-01-01'), 0) as bigint) as opening,
      cast(coalesce(sum(qty) filter (where ship_day < date '1997-01-01' and l_returnflag = 'R'), 0) as bigint)
        as returned,
      cast(coalesce(sum(qty) filter (where year(ship_day) = 1997), 0) as bigint) as onroad,
      cast(coalesce(sum(qty) filter (where year(ship_day) = 1998 and l_returnflag = 'N'), 0) as bigint) as oin,
      cast(coalesce(sum(qty) filter (where year(ship_day) = 1998 and l_returnflag <> 'N'), 0) as bigint) as oout,
      cast(coalesce(sum(qty) filter (where year(ship_day) = 1998 and l_returnflag = 'A'), 0) as bigint) as committed,
      cast(coalesce(sum(qty) filter (where ship_day between date '1998-06-24' and date '1998-06-30'), 0) as bigint)
        as q7,
      cast(coalesce(sum(qty) filter (where ship_day between date '1998-06-17' and date '1998-06-23'), 0) as bigint)
        as q14,
      cast(coalesce(sum(qty) filter (where ship_day < date '1998-07-01'), 0) as bigint) as qt
    from {source} group by 1, 2, 3, 4)"""


CTE["sku_org"] = _stock("ledger")
CTE["live_ledger"] = """
  select * from ledger where l_linestatus = 'O'
    and org in (select org from dim_org where region in ('AFRICA', 'ASIA', 'EUROPE'))"""
CTE["sku_org_live"] = _stock("live_ledger")
CTE["sold"] = "select s.*, d.suit, d.spu from sku_org s join dim_sku d using (sku) where qt > 0"
CTE["sold_region"] = """
  select s.*, m.template, m.manager_code as region from sold s join managers m on s.org = m.org"""
CTE["targets"] = """
  select org, sku, skc, size, cast(year(ship_day) as integer) as batch,
    cast(2 * sum(case when l_returnflag = 'R' then 0 else qty end) as bigint) as target
  from ledger group by 1, 2, 3, 4, 5"""
CTE["scores"] = """
  select cast(year(ship_day) as integer) as batch, skc, org,
    sum(cast(l_discount as decimal(4,2)) * cast(qty as decimal(9,0))) * cast(0.137 as decimal(4,3)) as send_score,
    sum(cast(l_tax as decimal(4,2)) * cast(qty as decimal(9,0))) * cast(0.137 as decimal(4,3)) as receive_score
  from ledger group by 1, 2, 3"""
CTE["rounded_scores"] = """
  select batch, skc, org, cast(cast(send_score as decimal(16,2)) as double) as send_score,
    cast(cast(receive_score as decimal(16,2)) as double) as receive_score from scores"""
CTE["earlier_sizes"] = """
  select out_org as org, skc, size, template, batch, cast(sum(model_qty) as bigint) as before_qty,
    cast(sum(human_qty) as bigint) as after_qty from moves group by 1, 2, 3, 4, 5"""
CTE["earlier_totals"] = totals("earlier_sizes", ["org", "skc", "template", "batch"], ["before_qty", "after_qty"])
CTE["earlier"] = f"""
  select org, skc, template, batch, {bundles(["before_qty", "after_qty"])} from earlier_totals group by 1, 2, 3, 4"""
CTE["stored_batches"] = """
  select org, skc, batch, min(before_qty) as before_qty, min(after_qty) as after_qty from earlier group by 1, 2, 3"""
CTE["skc_tags"] = "select p_brand as skc, cast(max(p_size) as varchar) as max_size from part group by 1"
CTE["org_tags"] = "select org, region from dim_org where org_type = 2"
CTE["pair_tags"] = "select org, skc, max(l_returnflag) as return_flag from ledger group by 1, 2"
CTE["tag_keys"] = "select distinct out_org as org, skc from moves"
CTE["all_tags"] = """
  select org, skc, 'max_size' as tag_code, max_size as tag_value from tag_keys join skc_tags using (skc)
  union all select org, skc, 'region', region from tag_keys join org_tags using (org)
  union all select org, skc, 'return_flag', return_flag from tag_keys join pair_tags using (org, skc)"""
CTE["wide_tags"] = """
  select org, skc, max(tag_value) filter (where tag_code = 'max_size') as max_size_tag_value,
    max(tag_value) filter (where tag_code = 'region') as region_tag_value,
    max(tag_value) filter (where tag_code = 'return_flag') as return_flag_tag_value from all_tags group by 1, 2"""
CTE["labels_spu"] = "select p_name as spu, max(p_type) as label_value from part group by 1"
CTE["life_cycle"] = """
  select org, skc, cast(year(min(ship_day)) as varchar) || 'Q' || cast(quarter(min(ship_day)) as varchar) as band
  from ledger group by 1, 2"""

# --- KPI ---------------------------------------------------------------------------------------------

CTE["star"] = """
  select a.org, a.sku, a.skc, a.step, e.level, g.size, g.suit, g.spu, f.org_name, f.region, f.org_flag, a.model_qty,
    a.human_qty, a.line_count, b.send_package, r.receive_package, c.target_qty, d.q7, d.q14, d.qt, h.tag_price
  from (select out_org as org, sku, skc, template as step, cast(sum(model_qty) as bigint) as model_qty,
      cast(sum(human_qty) as bigint) as human_qty, count(*) as line_count from moves group by 1, 2, 3, 4) a
  join (select out_org as org, template as step, cast(sum(model_qty) as bigint) as send_package from moves group by 1, 2)
    b on a.org = b.org and a.step = b.step
  join (select in_org as org, template as step, cast(sum(human_qty) as bigint) as receive_package from moves
    group by 1, 2) r on a.org = r.org and a.step = r.step
  join (select org, sku, cast(sum(target) as bigint) as target_qty from targets group by 1, 2) c
    on a.org = c.org and a.sku = c.sku
  join sku_org d on a.org = d.org and a.sku = d.sku
  join levels e on a.step = e.template
  join dim_org f on a.org = f.org
  join dim_sku g on a.sku = g.sku
  join (select p_brand || '|' || p_type as sku, max(p_retailprice) as tag_price from part group by 1) h on a.sku = h.sku
  join updated_orgs u on a.org = u.org"""
CTE["kpi"] = "select s.*, t.* exclude (org, skc) from star s left join wide_tags t on s.org = t.org and s.skc = t.skc"

# --- affected documents ------------------------------------------------------------------------------

CTE["affected"] = """
  select * from moves a where exists (select 1 from changed_pairs b where a.skc = b.skc
    and (a.out_org = b.org or a.in_org = b.org or a.model_out_org = b.org or a.model_in_org = b.org))"""
CTE["store_c"] = """
  select org, skc from (select out_org as org, skc from affected union select in_org, skc from affected
    union select model_out_org, skc from affected union select model_in_org, skc from affected) x
  where org is not null and (org, skc) not in (select (org, skc) from changed_pairs)"""


def header_cte(source: str) -> str:
    columns = (
        "run_day", "template", "batch", "source", "scene", "skc", "out_org", "in_org", "model_out_org", "model_in_org",
        "plan_id", "collection_id",
    )
    return f"select doc, min(day) as day, {cat(f'max({c}) as {c}' for c in columns)} from {source} group by doc"


CTE["headers"] = header_cte("moves")
CTE["affected_headers"] = header_cte("affected")


def quantity_cte(source: str) -> str:
    return f"""
  select d.doc, d.out_org, d.in_org, d.skc, s.size, q.model_qty, q.human_qty
  from (select distinct doc, out_org, in_org, skc from {source}) d join dim_sku s on d.skc = s.skc
  left join (select doc, size, sum(model_qty) as model_qty, sum(human_qty) as human_qty from {source} group by 1, 2) q
    on d.doc = q.doc and s.size = q.size"""


DOC_KEYS = ["doc", "out_org", "in_org", "skc"]
CTE["doc_sizes"] = quantity_cte("moves")
CTE["affected_sizes"] = quantity_cte("affected")
CTE["doc_quantities"] = totals("doc_sizes", DOC_KEYS, ["model_qty", "human_qty"])
CTE["affected_quantities"] = totals("affected_sizes", DOC_KEYS, ["model_qty", "human_qty"])


# --- stock by source ---------------------------------------------------------------------------------


def matrix_cte(source: str) -> str:
    chosen = cat(
        f"""case when k.source = '0' then b.{c} when k.source = '1' and k.scene = 'FURNITURE' then coalesce(l.{c}, 0)
      when k.source = '1' then b.{c} else coalesce(l.{c}, b.{c}) end as {c}"""
        for c in SOURCED
    )
    return f"""
  select k.org, k.skc, k.scene, k.source, k.size, b.q7, b.q14, b.qt, {chosen},
    case when k.source = '0' then coalesce(b.committed_out, 0)
      when k.source = '1' and k.scene = 'FURNITURE' then coalesce(l.committed_out, 0)
      when k.source = '1' then coalesce(b.committed_out, 0)
      when k.source in ('2', '3') and p.org is not null then coalesce(l.committed_out, 0)
      else coalesce(b.committed_out, 0) end as committed_out,
    coalesce(b.after_model_stock, 0) + coalesce(b.onroad_stock, 0) as after_model_onroad_stock, b.first_day,
    b.level_code
  from (select x.org, x.skc, x.scene, x.source, s.size from
      (select out_org as org, skc, scene, source from {source} union select in_org, skc, scene, source from {source}) x
      join dim_sku s on x.skc = s.skc) k
  left join sku_org b on k.org = b.org and k.skc = b.skc and k.size = b.size
  left join sku_org_live l on k.org = l.org and k.skc = l.skc and k.size = l.size
  left join (select distinct org, skc from sku_org_live) p on k.org = p.org and k.skc = p.skc"""


STOCK_KEYS = ["org", "skc", "scene", "source"]
CTE["matrix"] = matrix_cte("moves")
CTE["affected_matrix"] = matrix_cte("affected")
CTE["metrics"] = totals("matrix", STOCK_KEYS, FIGURES)
CTE["affected_metrics"] = totals("affected_matrix", STOCK_KEYS, FIGURES)


def stock_bundle_cte(metrics: str, matrix: str) -> str:
    return f"""
  select m.*, a.first_day, a.level_code from
    (select org, skc, scene, source, {bundles(FIGURES)} from {metrics} group by 1, 2, 3, 4) m
  join (select org, skc, scene, source, min(first_day) as first_day, max(level_code) as level_code from {matrix}
    group by 1, 2, 3, 4) a using (org, skc, scene, source)"""


CTE["stock_json"] = stock_bundle_cte("metrics", "matrix")
CTE["affected_stock"] = stock_bundle_cte("affected_metrics", "affected_matrix")

# --- runs --------------------------------------------------------------------------------------------


def run_ctes(prefix: str, source: str) -> None:
    signed, runs, step, after = f"{prefix}signed", f"{prefix}runs", f"{prefix}steps", f"{prefix}before_after"
    CTE[signed] = f"""
  select run_day as day, org, skc, sku, template, batch, cast(sum(qty) as bigint) as qty from
    (select run_day, out_org as org, skc, sku, template, batch, -human_qty as qty from {source}
     union all select run_day, in_org, skc, sku, template, batch, human_qty from {source})
  where org is not null group by all"""
    CTE[runs] = f"""
  select day, template, batch, row_number() over (partition by day order by batch, template) as row_num
  from (select distinct run_day as day, template, batch from {source} where batch is not null)"""
    CTE[step] = f"""
  select k.day, k.org, k.skc, k.sku, r.template, r.batch, cast(r.row_num as integer) as row_num, s.qty as move_qty,
    cast(sum(s.qty) over (partition by k.day, k.org, k.sku order by r.row_num) as bigint) as cum_qty
  from (select distinct day, org, skc, sku from {signed}) k join {runs} r on k.day = r.day
  left join {signed} s on s.day = k.day and s.org = k.org and s.sku = k.sku and s.template = r.template
    and s.batch = r.batch"""
    before = cat(f"coalesce(b.{c}, 0) + x.prior as before_run_{c}" for c in BASES)
    later = cat(f"coalesce(b.{c}, 0) + x.cum as after_run_{c}" for c in BASES)
    CTE[after] = f"""
  select x.day, x.org, x.skc, x.sku, x.size, x.template, x.batch, x.row_num, {before}, {later} from
   (select g.*, lag(cum, 1, 0) over (partition by day, org, sku order by row_num) as prior from
    (select p.day, p.org, p.skc, d.sku, d.size, r.template, r.batch, cast(r.row_num as integer) as row_num,
       coalesce(s.cum_qty, 0) as cum
     from (select distinct day, org, skc from {signed}) p join dim_sku d on p.skc = d.skc join {runs} r on p.day = r.day
     left join {step} s on s.day = p.day and s.org = p.org and s.sku = d.sku and s.template = r.template
       and s.batch = r.batch) g) x
  left join sku_org b on x.org = b.org and x.sku = b.sku"""
    CTE[f"{prefix}run_totals"] = totals(after, ["day", "org", "skc", "template", "batch"], RUN_COLUMNS)
    CTE[f"{prefix}run_json"] = f"""
  select day, org, skc, template, batch, {bundles(RUN_COLUMNS)} from {prefix}run_totals group by 1, 2, 3, 4, 5"""
    CTE[f"{prefix}net"] = f"""
  select p.day, p.org, p.skc, d.size, {cat(f"coalesce(b.{c}, 0) + coalesce(n.net, 0) as after_{c}" for c in BASES)}
  from (select distinct day, org, skc from {signed}) p join dim_sku d on p.skc = d.skc
  left join (select day, org, sku, sum(qty) as net from {signed} group by 1, 2, 3) n
    on n.day = p.day and n.org = p.org and n.sku = d.sku
  left join sku_org b on b.org = p.org and b.sku = d.sku"""
    CTE[f"{prefix}net_totals"] = totals(f"{prefix}net", ["day", "org", "skc"], NET_COLUMNS)


RUN_COLUMNS = [f"before_run_{b}" for b in BASES] + [f"after_run_{b}" for b in BASES]
NET_COLUMNS = [f"after_{b}" for b in BASES]
CTE["run_lines"] = "select * replace (day as run_day) from moves where day >= date '2001-07-29'"
run_ctes("all_", "run_lines")
run_ctes("aff_", "affected")
CTE["net_kept"] = f"""
  select n.org, n.skc, {cat(f"case when c.org is not null then e.after_qty else n.{m} end as {m}" for m in NET_COLUMNS)}
  from (select org, skc, {bundles(NET_COLUMNS)} from aff_net_totals group by 1, 2) n
  left join store_c c on n.org = c.org and n.skc = c.skc
  left join (select org, skc, min(after_qty) as after_qty from earlier group by 1, 2) e
    on n.org = e.org and n.skc = e.skc"""


def _stored_side(column: str) -> str:
    return "before_qty" if column.startswith("before") else "after_qty"


CTE["run_kept"] = f"""
  select r.org, r.skc, r.template, r.batch,
    {cat(f"case when c.org is not null then e.{_stored_side(m)} else r.{m} end as {m}" for m in RUN_COLUMNS)}
  from aff_run_json r left join store_c c on r.org = c.org and r.skc = c.skc
  left join earlier e on r.org = e.org and r.skc = e.skc and r.template = e.template and r.batch = e.batch"""

# --- scores, targets ---------------------------------------------------------------------------------

CTE["target_totals"] = totals("targets", ["org", "skc", "batch"], ["target"])
CTE["after_model"] = """
  select org, skc, cast(sum(after_model_include_stock) as bigint) as after_stock from sku_org
  where after_model_include_stock > 0 group by 1, 2"""


def fill(side: str) -> str:
    """Half-up rounding to two decimals in whole numbers."""
    n, d = f"coalesce({side}a.after_stock, 0)", f"{side}t.target"
    return f"case when {d} = 0 then 0.0 else cast((200 * {n} + {d}) // (2 * {d}) as double) / 100 end"


FILL_JOINS = """
  left join target_totals outt on outt.grouping_id = 1 and outt.org = h.out_org and outt.skc = h.skc
    and outt.batch = h.batch
  left join target_totals int on int.grouping_id = 1 and int.org = h.in_org and int.skc = h.skc and int.batch = h.batch
  left join after_model outa on outa.org = h.out_org and outa.skc = h.skc
  left join after_model ina on ina.org = h.in_org and ina.skc = h.skc""".replace(" int ", " intt ").replace(
    " int.", " intt."
)
FILL_COLUMNS = f"""outt.target as out_target, intt.target as in_target, {fill("out")} as out_fill,
  {fill("in").replace("int.", "intt.")} as in_fill"""

# --- documents with everything -----------------------------------------------------------------------

W = SALES


def _side_columns(alias: str, side: str, prefix: str, json_text: bool = False) -> str:
    return cat(f"{alias}.{w} as {side}{prefix}_{w}" for w in W)


CTE["national_skc"] = totals("sold", ["skc"], W)
CTE["national_skc_json"] = f"select skc, {bundles(W)} from national_skc group by 1"
CTE["region_skc"] = totals("sold_region", ["region", "template", "skc"], W)
CTE["region_skc_json"] = f"select region, template, skc, {bundles(W)} from region_skc group by 1, 2, 3"
CTE["suit_sales"] = f"select suit, {sums(W)} from sold group by 1"
CTE["region_suit"] = f"select region, template, suit, {sums(W)} from sold_region group by 1, 2, 3"
CTE["org_suit"] = f"select org, suit, {sums(W)} from sold group by 1, 2"
CTE["org_all"] = f"select org, {sums(W)} from sold group by 1"
CTE["org_spu"] = f"select org, spu, {sums(W)} from sold group by 1, 2"
CTE["enriched"] = f"""
  select h.*, k.suit, k.spu, k.color, k.class_level_code, k.class_label, ro.manager_code as out_region,
    ri.manager_code as in_region, q.model_qty, q.human_qty,
    {_side_columns("ns", "", "national_skc")}, {_side_columns("su", "", "national_suit")},
    {_side_columns("rko", "out_", "region_skc")}, {_side_columns("rki", "in_", "region_skc")},
    {_side_columns("rso", "out_", "region_suit")}, {_side_columns("rsi", "in_", "region_suit")},
    {_side_columns("oso", "out_", "org_suit")}, {_side_columns("osi", "in_", "org_suit")},
    {_side_columns("oao", "out_", "org_all")}, {_side_columns("oai", "in_", "org_all")},
    {_side_columns("opo", "out_", "org_spu")}, {_side_columns("opi", "in_", "org_spu")}
  from affected_headers h
  join (select doc, {bundles(["model_qty", "human_qty"])} from affected_quantities group by 1) q on h.doc = q.doc
  left join dim_skc k on h.skc = k.skc
  left join managers ro on ro.org = h.out_org and ro.template = h.template
  left join managers ri on ri.org = h.in_org and ri.template = h.template
  left join national_skc_json ns on ns.skc = h.skc
  left join suit_sales su on su.suit = k.suit
  left join region_skc_json rko on rko.region = ro.manager_code and rko.template = h.template and rko.skc = h.skc
  left join region_skc_json rki on rki.region = ri.manager_code and rki.template = h.template and rki.skc = h.skc
  left join region_suit rso on rso.region = ro.manager_code and rso.template = h.template and rso.suit = k.suit
  left join region_suit rsi on rsi.region = ri.manager_code and rsi.template = h.template and rsi.suit = k.suit
  left join org_suit oso on oso.org = h.out_org and oso.suit = k.suit
  left join org_suit osi on osi.org = h.in_org and osi.suit = k.suit
  left join org_all oao on oao.org = h.out_org
  left join org_all oai on oai.org = h.in_org
  left join org_spu opo on opo.org = h.out_org and opo.spu = k.spu
  left join org_spu opi on opi.org = h.in_org and opi.spu = k.spu"""
ENRICHED = [
    "doc", "skc", "template", "batch", "suit", "spu", "out_region", "in_region", "model_qty", "human_qty",
    *[f"national_skc_{w}" for w in W], *[f"national_suit_{w}" for w in W],
    *[f"{s}_{g}_{w}" for g in ("region_skc", "region_suit", "org_suit", "org_all", "org_spu") for s in ("out", "in")
      for w in W],
]

MODEL_FIGURES = ["after_model_stock", "after_model_onroad_stock", "after_sub_stock", "after_model_include_stock"]
ROLE_ORGS = {"human_out": "out_org", "human_in": "in_org", "model_out": "model_out_org", "model_in": "model_in_org"}


def label(code: str) -> str:
    return f"case {code} when '1' then '畅' when '2' then '平' when '3' then '滞' end"


def blank(column: str) -> str:
    return f"case when {column} not in ('', 'None') then {column} end"


def detail_sql() -> str:
    columns = [f"h.{c}" for c in ENRICHED]
    columns += [
        "cast(h.day as varchar) as day", "h.source", "h.scene", "h.out_org", "h.in_org", "h.model_out_org",
        "h.model_in_org", "h.color", "h.class_level_code", "h.class_label",
        f"coalesce({blank('h.plan_id')}, {blank('h.collection_id')}) as plan",
        f"case when {blank('h.plan_id')} is not null then 'plan_id' when {blank('h.collection_id')} is not null"
        " then 'collection_id' end as plan_kind",
        "lb.label_value",
    ]
    joins = ["left join labels_spu lb on lb.spu = h.spu"]
    for side in ("out", "in"):
        s, o = f"s_{side}", f"{side}_org"
        joins += [
            f"left join affected_stock {s} on {s}.org = h.{o} and {s}.skc = h.skc and {s}.scene = h.scene "
            f"and {s}.source = h.source",
            f"left join life_cycle lc_{side} on lc_{side}.org = h.{o} and lc_{side}.skc = h.skc",
            f"left join run_kept r_{side} on r_{side}.org = h.{o} and r_{side}.skc = h.skc "
            f"and r_{side}.template = h.template and r_{side}.batch = h.batch",
            f"left join net_kept n_{side} on n_{side}.org = h.{o} and n_{side}.skc = h.skc",
            f"left join rounded_scores sc_{side} on sc_{side}.org = h.{o} and sc_{side}.skc = h.skc "
            f"and sc_{side}.batch = h.batch",
            f"left join (select org, skc, batch, {bundles(['target'])} from target_totals group by 1, 2, 3) tb_{side} "
            f"on tb_{side}.org = h.{o} and tb_{side}.skc = h.skc and tb_{side}.batch = h.batch",
        ]
        columns += [f"{s}.{f} as {side}_{f}" for f in FIGURES]
        columns += [
            f"cast({s}.first_day as varchar) as {side}_first_day", f"{s}.level_code as {side}_level_code",
            f"{label(s + '.level_code')} as {side}_level_name", f"lc_{side}.band as {side}_band",
            f"sc_{side}.send_score as {side}_send_score", f"sc_{side}.receive_score as {side}_receive_score",
            f"tb_{side}.target as {side}_target_bundle",
        ]
        columns += [f"r_{side}.{c} as {side}_{c}" for c in RUN_COLUMNS]
        columns += [f"n_{side}.after_{b} as {side}_net_after_{b}" for b in BASES]
    for role, org in ROLE_ORGS.items():
        m, u = f"m_{role}", f"u_{role}"
        joins += [
            f"left join managers {m} on {m}.org = h.{org} and {m}.template = h.template",
            f"left join org_infos {u} on {u}.org = h.{org} and {u}.brand = h.skc",
        ]
        columns += [f"{m}.{c} as {role}_{c}" for c in ("org_code", "org_name", "manager_code", "manager_name")]
        columns += [
            f"case when {m}.org_flag = '1' then {m}.store_manager end as {role}_store_manager",
            f"{u}.manager_code as {role}_up_code",
        ]
        if role.startswith("human"):
            columns.append(f"{m}.org_flag as {role}_org_flag")
        else:
            joins += [
                f"left join affected_stock s_{role} on s_{role}.org = h.{org} and s_{role}.skc = h.skc "
                f"and s_{role}.scene = h.scene and s_{role}.source = h.source",
                f"left join stored_batches b_{role} on b_{role}.org = h.{org} and b_{role}.skc = h.skc "
                f"and b_{role}.batch = h.batch",
            ]
            columns += [f"s_{role}.{f} as {role}_{f}" for f in MODEL_FIGURES]
            columns += [
                f"b_{role}.before_qty as {role}_batch_before",
                f"b_{role}.after_qty as {role}_batch_after",
            ]
    return f"select {cat(columns)}, {FILL_COLUMNS} from enriched h {' '.join(joins)} {FILL_JOINS}"


# --- stored results ----------------------------------------------------------------------------------

CTE["stored_docs"] = """
  select doc || '#' || c.copy as id, doc, qty, batch from
    (select doc, batch, cast(sum(human_qty) as bigint) as qty, max(case when plan_id = '' then 2 else 1 end) as copies
     from moves group by 1, 2) d, (select 1 as copy union all select 2) c where c.copy <= d.copies"""
CTE["fresh_docs"] = """
  select doc || '#new' as id, doc, cast(sum(model_qty) as bigint) as qty, batch from moves
  where doc in (select doc from changed_docs) group by doc, batch"""

# --- change data capture -----------------------------------------------------------------------------

CTE["evt"] = """
  select event_id as seq, cast(user_id as varchar) as key,
    case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op,
    cast(cast(value as decimal(12,2)) as varchar) as value, event_type,
    cast(json_extract_string(props, '$.k') as varchar) as k,
    event_type in ('view', 'click') as has_old, value < 5 as small from events"""
CTE["chg"] = """
  select seq, key, op, value, event_type, k,
    op = 'UPDATE' and not has_old as c_id,
    op = 'UPDATE' and (not has_old or (not small and value <> '0.00')) as c_value,
    op = 'UPDATE' and event_type <> 'view' as c_event_type,
    op = 'UPDATE' and not has_old as c_k from evt"""
CTE["accounts"] = """
  select cast(s_suppkey as varchar) as key, s_acctbal as value, s_name as event_type, 0 as k from supplier"""
CTE["resets"] = "select key, max(seq) as r_seq, arg_max(op, seq) as r_op from chg where op <> 'UPDATE' group by key"
CTE["starts"] = """
  select c.key, arg_min(c.seq, c.seq) as f_seq from chg c left join resets r using (key)
  where c.op = 'UPDATE' and (r.r_seq is null or c.seq > r.r_seq) group by c.key"""


def _cdc_value(column: str, kind: str) -> str:
    patch = f"""(select arg_max(p.{column}, p.seq) from chg p where p.key = x.key and p.c_{column}
      and (x.r_seq is null or p.seq > x.r_seq))"""
    base = f"case when x.r_op = 'INSERT' then i.{column} else f.{column} end"
    replaced = f"coalesce(cast({patch} as {kind}), cast({base} as {kind}))"
    patched = f"coalesce(cast({patch} as {kind}), a.{column})"
    return f"case when a.key is not null and x.r_op is null then {patched} else {replaced} end as {column}"


CTE["cdc_result"] = f"""
  select cast(key as bigint) as id, value, event_type, cast(k as bigint) as k from accounts
  where key not in (select key from chg)
  union all
  select cast(x.key as bigint), {_cdc_value("value", "double")}, {_cdc_value("event_type", "varchar")},
    {_cdc_value("k", "bigint")}
  from (select e.key, r.r_seq, r.r_op, s.f_seq from (select distinct key from chg) e
    left join resets r using (key) left join starts s using (key)) x
  left join accounts a on a.key = x.key
  left join chg i on i.key = x.key and i.seq = x.r_seq
  left join chg f on f.key = x.key and f.seq = x.f_seq
  where x.r_op = 'INSERT' or (x.r_op = 'DELETE' and x.f_seq is not null)
    or (x.r_op is null and (a.key is not null or x.f_seq is not null))"""

LINE = "doc, out_org, in_org, sku, model_qty, human_qty, template, batch, source, status"


def _day(columns: str) -> str:
    return f"cast(day as varchar) as day, {columns}"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_day_slice"] = f"select {LINE} from doc_lines where day = date '1998-07-01' and is_deleted = '0'"
    q["scan_parquet_view"] = q["csv_roundtrip"] = "select * from part"
    q["parquet_roundtrip"] = """select o_orderkey, c_name, c_mktsegment, o_totalprice as total
      from orders join customer on o_custkey = c_custkey"""
    q["append_by_name"] = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
      cast(o_orderdate as varchar) as o_orderdate from orders"""
    q["sync_full"] = "select o_orderkey, o_orderstatus, o_totalprice as total from orders"
    q["sync_batches"] = """select o_orderkey, o_orderstatus, cast(year(o_orderdate) as integer) as batch_id,
      case when year(o_orderdate) in (1996, 1998) then o_totalprice else 0 end as total from orders"""
    q["sync_day"] = """select o_orderkey, o_orderstatus, cast(cast(date_trunc('month', o_orderdate) as date) as varchar)
      as day_date, case when date_trunc('month', o_orderdate) = date '1998-07-01' then o_totalprice else 0 end as total
      from orders"""
    q["sync_changed"] = """select o_orderkey, o_orderstatus, o_totalprice as total, cast(year(o_orderdate) as integer) as batch_id,
      case year(o_orderdate) when 1999 then 'new' when 1996 then 'changed' when 1997 then 'changed' when 1998 then 'changed'
        end as kind from orders
      union all select null, null, null, 1900, 'gone'"""
    q["sync_keys"] = """select o_orderkey, o_orderstatus, o_totalprice as total,
      case when o_orderkey % 101 = 0 then 'new' when o_orderkey % 103 = 0 then 'changed' end as kind from orders
      union all select -o_orderkey, null, null, 'gone' from orders where o_orderkey % 107 = 0 and o_orderkey <> 0"""
    q["sync_catalog_plan"] = " union all ".join(
        f"""select '{t}' as "table", {str(t == "lineitem").lower()} as has_batch,
        '{"batches" if t == "lineitem" else "full"}' as mode, count(*) as n_rows from {t}"""
        for t in TABLES
        if t not in ("benchmark", "labels")
    )
    q["sync_tables"] = " union all ".join(
        f"""select '{t}' as "table", (select count(*) from {t}{" where l_linenumber in (1, 2)" if t == "lineitem" else ""}) as n_rows,
        (select cast(count(*) as integer) from (describe {t})) as n_columns"""
        for t in TABLES
        if t not in ("benchmark", "labels")
    )
    q["sink_distributed"] = q["kpi_wide"] = q["ctas_kpi_wide"] = "select * from kpi"
    q["filter_changed_docs"] = f"select {LINE} from moves where status in ('1', '2', '3')"
    q["drop_null_orgs"] = "select doc, sku, model_in_org, model_qty from moves where model_in_org is not null"
    q["filter_with_sales"] = "select org, sku, skc, size, q7, q14, qt from sku_org where qt > 0"
    q["decode_sales_level"] = f"select doc, sku, level_code, {label('level_code')} as level_name from moves"
    q["conditional_expose"] = """select m.doc, case when o.org_flag = '1' then o.store_manager end as manager
      from moves m left join dim_org o on m.out_org = o.org"""
    q["prefer_first_nonblank"] = f"""select doc, sku, coalesce({blank("plan_id")}, {blank("collection_id")}) as origin_id,
      case when {blank("plan_id")} is not null then 'plan_id' when {blank("collection_id")} is not null
      then 'collection_id' end as origin_kind from moves"""
    q["null_org_sentinel"] = "select doc, sku, coalesce(model_in_org, '111') as model_in_org from moves"
    q["gate_has_changes"] = "select count(*) > 0 as has_changes from moves where status in ('1', '2', '3')"
    q["distinct_keys"] = "select out_org as org, skc from moves group by 1, 2"
    q["org_skc_union"] = "select out_org as org, skc from moves union select in_org, skc from moves"
    q["top_rows"] = """select doc, cast(sum(model_qty) as bigint) as qty from moves group by 1
      order by qty desc, doc limit 10"""
    q["semi_skc"] = """select p_partkey, p_brand as skc, p_type from part
      where p_brand in (select skc from moves where status <> '0')"""
    q["in_subquery"] = f"select {LINE} from moves where doc in (select doc from changed_docs)"
    q["filter_by_key_set"] = """select s.org, s.skc, s.sku, s.before_stock, c.changed_lines from sku_org s
      join (select out_org as org, skc, count(*) as changed_lines from moves where status <> '0' group by 1, 2) c
      on s.org = c.org and s.skc = c.skc"""
    q["affected_docs"] = f"select {LINE}, skc, model_in_org from affected"
    q["store_c_anti"] = "select org, skc from store_c"
    q["org_by_template"] = """select o.org, l.template, l.level, case l.level when 'region' then 'REGION'
      when 'store' then 'STORE' else 'UNIT' end as level_name from dim_org o, levels l
      where o.org_type = 2 and o.status = 'open'"""
    q["org_parent"] = """select a.org, a.parent, b.org_code as parent_code, b.org_name as parent_name
      from dim_org a left join dim_org b on a.parent = b.org"""
    q["org_info"] = "select * from org_infos"
    q["org_manager_path"] = "select * from managers"
    q["resolve_params"] = "select template, unit, level from levels, (select 'U' as unit union all select 'V')"
    q["class_level"] = "select p_partkey, depth, level_code, class_label from class_labels"
    q["complete_sizes"] = "select doc, skc, size from doc_sizes"
    q["complete_sizes_moves"] = """select k.org, k.skc, d.sku from (select out_org as org, skc from moves
      union select in_org, skc from moves) k join dim_sku d on k.skc = d.skc"""
    q["expand_templates"] = f"select {_day('org, sku, template, batch')} from all_steps"
    q["two_sided_lookup"] = """select h.doc, h.skc, h.out_org, h.in_org, o.stock as out_stock, i.stock as in_stock
      from headers h
      left join (select org, skc, cast(sum(before_stock) as bigint) as stock from sku_org group by 1, 2) o
        on o.org = h.out_org and o.skc = h.skc
      left join (select org, skc, cast(sum(before_stock) as bigint) as stock from sku_org group by 1, 2) i
        on i.org = h.in_org and i.skc = h.skc"""
    roles = cat(f"{r}.org_code as {r}_org_code, {r}.region as {r}_region" for r in ROLE_ORGS)
    role_joins = " ".join(f"left join dim_org {r} on {r}.org = h.{o}" for r, o in ROLE_ORGS.items())
    q["roleplay_orgs"] = f"""select h.doc, h.out_org, h.in_org, h.model_out_org, h.model_in_org, {roles}
      from headers h {role_joins}"""
    q["join_filtered_right"] = """select p_partkey, p_name as spu, label_value from part
      left join labels_spu on spu = p_name"""
    q["kpi_star_join"] = "select * from star"
    q["union_tags"] = "select org, skc, tag_code, tag_value from all_tags"
    q["pivot_tags"] = "select * from wide_tags"
    q["unpivot_months"] = """select o_orderpriority as priority, cast(year(o_orderdate) as integer) as year,
      'm' || strftime(o_orderdate, '%m') as month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as sales
      from orders group by 1, 2, 3"""
    q["doc_header"] = """select * replace (cast(day as varchar) as day, cast(run_day as varchar) as run_day) from headers"""
    q["gs_doc_qty"] = "select * from doc_quantities"
    q["doc_qty_json"] = f"""select doc, out_org, in_org, skc, {bundles(["model_qty", "human_qty"])}
      from doc_quantities group by 1, 2, 3, 4"""
    q["min_json_bundle"] = "select * from stored_batches"
    q["latest_batch"] = "select template, max(batch) as batch from moves group by 1"
    q["batch_stock_lookup"] = """select h.doc, h.skc, h.batch, h.model_out_org, h.model_in_org,
      o.before_qty as out_before_qty, o.after_qty as out_after_qty, i.before_qty as in_before_qty,
      i.after_qty as in_after_qty from headers h
      left join stored_batches o on o.org = h.model_out_org and o.skc = h.skc and o.batch = h.batch
      left join stored_batches i on i.org = h.model_in_org and i.skc = h.skc and i.batch = h.batch"""
    q["score_round"] = "select * from rounded_scores"
    q["priority_scores"] = """select h.doc, h.skc, h.batch, h.out_org, h.in_org, o.send_score as out_send_score,
      o.receive_score as out_receive_score, i.send_score as in_send_score, i.receive_score as in_receive_score
      from headers h left join rounded_scores o on o.org = h.out_org and o.skc = h.skc and o.batch = h.batch
      left join rounded_scores i on i.org = h.in_org and i.skc = h.skc and i.batch = h.batch"""
    q["gs_target_stock"] = "select * from target_totals"
    q["target_stock_json"] = f"select org, skc, batch, {bundles(['target'])} from target_totals group by 1, 2, 3"
    q["fill_rate"] = f"""select h.doc, h.skc, h.batch, h.out_org, h.in_org, {FILL_COLUMNS} from headers h {FILL_JOINS}"""
    q["gs_national_skc"] = "select * from national_skc"
    q["json_bundle"] = "select * from national_skc_json"
    q["gs_region_skc"] = "select * from region_skc"
    q["sales_by_org"] = "select * from org_all"
    q["sales_by_org_suit"] = "select * from org_suit"
    q["sales_by_org_spu"] = "select * from org_spu"
    q["sales_by_suit"] = "select * from suit_sales"
    q["sales_by_region_suit"] = "select * from region_suit"
    grains = {
        "skc_size": "skc, size", "skc": "skc", "org_suit": "org, suit", "suit": "suit", "org": "org",
        "org_spu": "org, spu", "region_skc_size": "region, template, skc, size", "region_skc": "region, template, skc",
        "region_suit": "region, template, suit",
    }
    q["sales_rollups_long"] = " union all ".join(
        f"""select '{g}' as grain, concat_ws('|', {k}) as key, {sums(W)}
        from {"sold_region" if g.startswith("region") else "sold"} group by {k}"""
        for g, k in grains.items()
    )
    q["stock_source_matrix"] = f"select {cat(STOCK_KEYS)}, size, {cat(FIGURES)} from matrix"
    q["stock_metrics"] = "select * from metrics"
    q["stock_metrics_json"] = "select * replace (cast(first_day as varchar) as first_day) from stock_json"
    q["template_order"] = f"select {_day('template, batch, cast(row_num as integer) as row_num')} from all_runs"
    q["running_moves"] = f"select {_day('org, skc, sku, template, batch, row_num, move_qty, cum_qty')} from all_steps"
    q["stock_before_after"] = (
        f"select {_day('org, skc, sku, size, template, batch, row_num, ' + cat(RUN_COLUMNS))} from all_before_after"
    )
    q["stock_before_after_json"] = f"select {_day('org, skc, template, batch, ' + cat(RUN_COLUMNS))} from all_run_json"
    q["net_stock_after"] = f"select {_day('org, skc, size, grouping_id, ' + cat(NET_COLUMNS))} from all_net_totals"
    q["carry_over_store_c"] = "select * from net_kept"
    q["doc_enrich"] = f"select {cat(ENRICHED)} from enriched"
    q["doc_detail"] = detail_sql()
    q["dup_docs"] = "select doc, count(*) as n from stored_docs group by 1 having count(*) > 1"
    q["dedupe_orders"] = """select id, doc, qty, batch from
      (select *, row_number() over (partition by doc order by id) as rn from stored_docs) where rn = 1"""
    q["replace_by_key"] = """select * from stored_docs where doc not in (select doc from fresh_docs)
      union all select * from fresh_docs"""
    q["reset_status"] = """select doc, sku, case when doc in (select doc from changed_docs) then '0' else status end
      as status, model_qty from moves"""
    q["listagg_roundtrip"] = "select distinct out_org, doc from moves where status <> '0'"
    q["publish_incremental"] = """select id, doc, qty, batch from
      (select *, row_number() over (partition by doc order by id) as rn from stored_docs) s
      where doc not in (select doc from fresh_docs) and (rn = 1 or batch not in (select batch from fresh_docs))
      union all select * from fresh_docs"""
    kept = ("doc", "batch", "skc", "out_org", "in_org")
    q["run_day"] = f"""select h.doc || case when a.doc is not null then '#new' else '#1' end as id, {cat(f"h.{c}" for c in kept)},
      a.* exclude ({cat(kept)}), cast(0 as bigint) as changed_lines
      from headers h left join ({q["doc_detail"]}) a on h.doc = a.doc"""
    parts = {
        "qty": "true", "qty_r": "l_returnflag = 'R'", "qty_n": "l_returnflag = 'N'", "qty_not_n": "l_returnflag <> 'N'",
        "qty_a": "l_returnflag = 'A'", "kept": "l_returnflag <> 'R'", "qt": "ship_day < date '1998-07-01'",
        "q7": "ship_day < date '1998-07-01' and ship_day >= date '1998-06-24'",
        "q14": "ship_day < date '1998-06-24' and ship_day >= date '1998-06-17'",
    }
    weights = {"discounted": "l_discount", "taxed": "l_tax"}
    q["cells_maintained"] = f"""select org, sku, skc, size, cast(year(ship_day) as integer) as year, l_linestatus,
      {cat(f"cast(sum(case when {c} then qty else 0 end) as bigint) as {n}" for n, c in parts.items())},
      {cat(f"cast(sum(cast({c} as decimal(4,2)) * cast(qty as decimal(9,0))) as double) as {n}" for n, c in weights.items())},
      cast(min(ship_day) as varchar) as first_day, max(l_returnflag) as last_flag from ledger group by 1, 2, 3, 4, 5, 6"""
    q["cdc_parse"] = """select seq as "offset", key, op, 5 as n_fields, value from evt"""
    q["cdc_normalise"] = """select seq as "offset", key, op,
      'event_type=' || event_type || ';id=' || key || ';k=' || k || ';value=' || value as data from evt"""
    q["cdc_changed_fields"] = """select seq as "offset", key, op, concat_ws(';',
      case when c_event_type then 'event_type=' || event_type end, case when c_id then 'id=' || key end,
      case when c_k then 'k=' || k end, case when c_value then 'value=' || value end) as changed from chg"""
    q["cdc_apply"] = q["cdc_stream"] = "select * from cdc_result"
    q["cdc_rejects"] = """select event_id as "offset", case event_type when 'purchase' then 'message' when 'signup' then 'value'
      else 'key' end as reason from events where (event_type = 'purchase' and value > 30)
      or (event_type = 'signup' and value < 5) or (event_type = 'error' and value > 20)"""
    q["cdc_emit_json"] = """select cast(id as varchar) as key, '{"id":' || cast(id as varchar) || ',"value":'
      || coalesce(cast(value as varchar), 'null') || ',"event_type":' || coalesce('"' || event_type || '"', 'null')
      || ',"k":' || coalesce(cast(k as varchar), 'null') || '}' as value from cdc_result"""
    return {name: complete(text) for name, text in q.items()}


def complete(text: str) -> str:
    """Put the common table expressions a text needs in front of it."""
    needed: set[str] = set()

    def visit(part: str) -> None:
        for name in set(re.findall(r"\b[a-z_]+\b", part)) & CTE.keys():
            if name not in needed:
                needed.add(name)
                visit(CTE[name])

    visit(text)
    if not needed:
        return text
    return "with " + ",\n".join(f"{n} as ({CTE[n]})" for n in _ordered(needed)) + "\n" + text


def _ordered(names: set[str]) -> list[str]:
    """Definitions before their uses."""
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for other in set(re.findall(r"\b[a-z_]+\b", CTE[name])) & names - {name}:
            place(other)
        done.append(name)

    for name in CTE:
        if name in names:
            place(name)
    return done
