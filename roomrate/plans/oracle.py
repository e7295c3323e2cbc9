"""DuckDB SQL stating the exact result of each full-oracle query in
``catalog`` (tables are views named after the parquet files). For queries that
fit models (K-means, GBT) it states, for every row, facts that hold for any
right result; the query computes them from the model's output.
"""

from __future__ import annotations

# md5 bucket of "<seed>-<key>", first 32 bits, mod 100 (see functions.hashing)
_BUCKET = "(cast(('0x' || substr(md5('123-' || cast(o_orderkey as varchar)), 1, 8)) as bigint) % 100)"
_FLAGGED = f"(select *, case when {_BUCKET} < 70 then 1 else 0 end as is_train from orders)"
_EVENT_COLS = "event_id, user_id, event_type, value"


def _z(table: str, col: str, k: str, select: str) -> str:
    return (f"select {select} from {table} t, (select avg({col}) as m, stddev_pop({col}) as sd "
            f"from {table}) z where abs((t.{col} - z.m) / nullif(z.sd, 0)) < {k}")


_GROUP_MEAN_PREDS = f"""(
  with f as {_FLAGGED},
  m as (select o_orderpriority, avg(o_totalprice) as prediction from f where is_train = 1
        group by o_orderpriority)
  select f.o_orderkey, f.o_orderstatus, f.o_totalprice as label, m.prediction
  from f left join m on f.o_orderpriority = m.o_orderpriority where f.is_train = 0)"""

_METRICS = f"""(select o_orderstatus, count(*) as n,
   avg(abs((label - prediction) / nullif(prediction, 0))) as mape,
   sqrt(avg((label - prediction) * (label - prediction))) as rmse
 from {_GROUP_MEAN_PREDS} p group by o_orderstatus)"""

_CUST = """(select c_custkey, c_nationkey, c_mktsegment, c_acctbal as price,
   cast(40.5 as double) + cast(c_custkey % 997 as double) * cast(0.0004 as double) as latitude,
   cast(-74.1 as double) + cast(c_custkey % 499 as double) * cast(0.0008 as double) as longitude
 from customer)"""

_COMPARABLES = f"""(select c.* from {_CUST} c,
   (select avg(price) as m, stddev_pop(price) as sd from {_CUST}) z
 where abs((c.price - z.m) / nullif(z.sd, 0)) < 3
   and c.c_mktsegment = 'HOUSEHOLD' and c.price > 0)"""


def _dist(rows: str) -> str:
    a = f"(select latitude as lat0, longitude as lon0 from {_CUST} where c_custkey = 0)"
    return f"""(select r.*, 2 * cast(6371 as double) * asin(sqrt(least(cast(1 as double),
      pow(sin((radians(a.lat0) - radians(r.latitude)) / 2), 2)
      + cos(radians(r.latitude)) * cos(radians(a.lat0))
        * pow(sin((radians(a.lon0) - radians(r.longitude)) / 2), 2)))) as distance_km
    from {rows} r, {a} a)"""


_NEAREST = """(
  with x as (select vec_id, label, unnest(embedding) as e, unnest(range(len(embedding))) as i
             from embeddings),
  c as (select label as cid, i, avg(cast(e as double)) as m from x group by label, i),
  d as (select x.vec_id, c.cid,
          round(sum((cast(x.e as double) - c.m) * (cast(x.e as double) - c.m)), 9) as dd
        from x join c on x.i = c.i group by x.vec_id, c.cid)
  select vec_id, cid as cluster from
    (select vec_id, cid, row_number() over (partition by vec_id order by dd, cid) as rn from d)
  where rn = 1)"""


def _ind(col: str, val: str, name: str) -> str:
    return f"case when {col} = '{val}' then 1 else 0 end as {name}"


_PRIORITY_DUMMIES = ", ".join(
    _ind("o_orderpriority", v, n) for v, n in [
        ("1-URGENT", "o_orderpriority_1_URGENT"), ("2-HIGH", "o_orderpriority_2_HIGH"),
        ("3-MEDIUM", "o_orderpriority_3_MEDIUM"),
        ("4-NOT SPECIFIED", "o_orderpriority_4_NOT_SPECIFIED"),
        ("5-LOW", "o_orderpriority_5_LOW")])


def _cat_row(pos: int, name: str, expr: str) -> str:
    return (f"select '{name}' as feature, {pos} as position, "
            f"case when count(distinct {expr}) <= 5 then cast(count(distinct {expr}) as integer) "
            f"end as n_categories, count(distinct {expr}) <= 5 as is_categorical from lineitem")


_INDEX_CATEGORICAL = " union all ".join(
    _cat_row(i, n, e) for i, (n, e) in enumerate([
        ("l_linenumber", "l_linenumber"), ("l_quantity", "l_quantity"),
        ("l_discount", "l_discount"), ("l_tax", "l_tax"),
        ("l_returnflag_A", "case when l_returnflag = 'A' then 1 else 0 end"),
        ("l_returnflag_N", "case when l_returnflag = 'N' then 1 else 0 end"),
        ("l_returnflag_R", "case when l_returnflag = 'R' then 1 else 0 end"),
        ("l_linestatus_F", "case when l_linestatus = 'F' then 1 else 0 end"),
        ("l_linestatus_O", "case when l_linestatus = 'O' then 1 else 0 end")]))

_DAMAGED = """(select event_id,
   case event_id % 5 when 0 then cast(user_id as varchar)
     when 1 then ' ' || cast(user_id as varchar) || ' ' when 2 then cast(value as varchar)
     when 3 then '$' || cast(user_id as varchar) else '' end as a_int,
   case event_id % 5 when 0 then cast(value as varchar)
     when 1 then ' ' || cast(value as varchar) || ' ' when 2 then cast(user_id as varchar)
     when 3 then '$' || cast(value as varchar) else 'n/a' end as b_dbl
 from events)"""

_FREQUENT = """(select * from events where user_id in
   (select user_id from events group by user_id
    having count(*) * 200 > (select count(*) from events)))"""

_DAYS = ("Fri", "Mon", "Sat", "Sun", "Thu", "Tue", "Wed")

_OVER_MEAN = """(select * from events where user_id in
   (select user_id from events group by user_id
    having count(*) * greatest(2, (select count(distinct user_id) from events)) > (select count(*) from events)))"""

_NULLED = """(select event_id, case when event_id % 4 != 0 then user_id end as user_id,
   case when event_id % 3 != 0 then event_type end as event_type, value from events)"""

_PRICE = """(100 + 3 * (o_custkey % 50) + case when o_orderpriority = '1-URGENT' then 20 else 0 end
   + case when o_orderstatus = 'F' then 40 else 0 end + o_orderkey % 7)"""

ORACLE: dict[str, str] = {
    "zscore_filter_k25": _z("events", "value", "2.5", _EVENT_COLS),
    "zscore_filter_k3": _z("events", "value", "3", _EVENT_COLS),
    "zscore_filter_by_group": f"""select {_EVENT_COLS} from events e join
        (select event_type as g, avg(value) as m, stddev_pop(value) as sd from events
         group by event_type) s on e.event_type = s.g
        where abs((e.value - s.m) / nullif(s.sd, 0)) < 2.5""",
    "frequency_filter": f"select {_EVENT_COLS} from {_FREQUENT} f",
    "filter_in_set": """select o_orderkey, o_orderpriority, o_totalprice from orders
        where o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "trainable_groups": f"""select o_orderpriority, count(*) as n_rows,
        cast(count_if(is_train = 1) as bigint) as n_train,
        cast(count_if(is_train = 0) as bigint) as n_test
        from {_FLAGGED} f group by o_orderpriority
        having count_if(is_train = 1) > 0 and count_if(is_train = 0) > 0""",
    "price_moments": """select event_type, count(value) as n, round(avg(value), 6) as mean,
        round(stddev_pop(value), 6) as std_pop from events group by event_type""",
    "count_by": "select user_id, count(*) as n from events group by user_id",
    "annotate_count": """select event_id, user_id, count(*) over (partition by user_id) as n
        from events""",
    "group_sizes": "select o_orderstatus, count(*) as size from orders group by o_orderstatus",
    "distinct_values": "select distinct o_orderpriority from orders order by o_orderpriority",
    "semi_join_keys": """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
        from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')""",
    "join_attach_flag": f"""select o.o_orderkey, o.o_totalprice, f.is_train from orders o
        join (select cast(o_orderkey as varchar) as listId, is_train from {_FLAGGED} x) f
        on o.o_orderkey = try_cast(f.listId as bigint)""",
    "assign_nearest": f"select vec_id, cluster from {_NEAREST} n",
    "join_attach_cluster": f"""select e.vec_id, e.label, n.cluster from embeddings e
        join {_NEAREST} n on e.vec_id = n.vec_id""",
    "project_subset": "select o_orderkey, o_custkey, o_totalprice from orders",
    "rename_columns": """select o_orderkey as order_id, o_orderstatus, o_totalprice as price
        from orders""",
    "drop_columns": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
    "move_last": """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
        o_totalprice as price from orders""",
    "bulk_cast": f"""select event_id,
        try_cast(trunc(try_cast(a_int as double)) as integer) as a_int,
        try_cast(b_dbl as double) as b_dbl from {_DAMAGED} t""",
    "one_hot_single": f"select o_orderkey, {_PRIORITY_DUMMIES} from orders",
    "one_hot_multi": f"""select l_orderkey, l_linenumber,
        {_ind('l_returnflag', 'A', 'l_returnflag_A')}, {_ind('l_returnflag', 'N', 'l_returnflag_N')},
        {_ind('l_returnflag', 'R', 'l_returnflag_R')}, {_ind('l_linestatus', 'F', 'l_linestatus_F')},
        {_ind('l_linestatus', 'O', 'l_linestatus_O')} from lineitem""",
    "index_categorical": _INDEX_CATEGORICAL,
    "assemble_features": """select o_orderkey, cast(o_custkey as double) as f0,
        o_totalprice as f1,
        case when o_orderpriority = '1-URGENT' then cast(1 as double) else cast(0 as double) end as f2
        from orders""",
    "split_train": f"select o_orderkey, o_totalprice from orders where {_BUCKET} < 70",
    "split_test": f"select o_orderkey, o_totalprice from orders where {_BUCKET} >= 70",
    "split_counts": f"select is_train, count(*) as n from {_FLAGGED} f group by is_train",
    "split_union": f"select o_orderkey, is_train from {_FLAGGED} f",
    "overlay_prediction": f"""with f as {_FLAGGED},
        m as (select o_orderpriority, avg(o_totalprice) as p from f where is_train = 1
              group by o_orderpriority)
        select f.o_orderkey, f.is_train,
          round(case when f.is_train = 0 then m.p else f.o_totalprice end, 6) as price
        from f left join m on f.o_orderpriority = m.o_orderpriority""",
    "overlay_prediction_nulls": f"""with o as (
          select o_orderkey, case when o_orderkey % 7 < 5 then o_orderkey % 1000 end as k, is_train, o_totalprice
          from {_FLAGGED} f),
        p as (select k, o_totalprice as prediction from o where is_train = 0
              union all
              select k, case when o_orderkey % 9 <> 0 then o_totalprice + 100 end
              from o where is_train = 0 and o_orderkey % 3 = 0),
        m as (select k, avg(prediction) as prediction from p group by k)
        select o.o_orderkey, o.k, o.is_train,
          round(case when o.is_train = 0 then m.prediction else o.o_totalprice end, 4) as price
        from o left join m on o.k is not distinct from m.k""",
    "mape": f"""select count(*) as n,
        round(avg(abs((label - prediction) / nullif(prediction, 0))), 6) as mape
        from {_GROUP_MEAN_PREDS} p""",
    "rmse": f"""select count(*) as n,
        round(sqrt(avg((label - prediction) * (label - prediction))), 6) as rmse
        from {_GROUP_MEAN_PREDS} p""",
    "mape_by_group": f"""select o_orderstatus, n, round(mape, 6) as mape from {_METRICS} m""",
    "rmse_by_group": f"""select o_orderstatus, n, round(rmse, 6) as rmse from {_METRICS} m""",
    "best_group": f"""select o_orderstatus, n, round(mape, 6) as mape, round(rmse, 6) as rmse
        from {_METRICS} m order by mape, o_orderstatus limit 1""",
    "metric_summary": f"""select count(*) as n_groups, cast(sum(n) as bigint) as total_size,
        round(min(rmse), 6) as best_rmse, round(avg(rmse), 6) as mean_rmse,
        round(min(mape), 6) as best_mape, round(avg(mape), 6) as mean_mape,
        round(sqrt(sum(n * rmse * rmse) / sum(n)), 6) as pooled_rmse,
        round(sum(n * mape) / sum(n), 6) as weighted_mape from {_METRICS} m""",
    "preview_predictions": f"""select o_orderkey, label, round(prediction, 6) as prediction
        from {_GROUP_MEAN_PREDS} p order by o_orderkey limit 20""",
    "comparables_filter": f"select c_custkey, c_nationkey, price from {_COMPARABLES} c",
    "distance_from_anchor": f"""select c_custkey, round(distance_km, 6) as distance_km
        from {_dist(_CUST)} d""",
    "comparables_ranked": f"""select c_custkey, price, round(distance_km, 6) as distance_km
        from {_dist(_COMPARABLES)} d order by price desc, c_custkey""",
    "comparables_summary": f"""select count(*) as n, round(stddev_samp(price), 6) as std_samp,
        round(max(price) - min(price), 6) as range from {_COMPARABLES} c""",
    "comparables_report": f"""select d.c_custkey, d.price, round(d.distance_km, 6) as distance_km,
        s.n as n_comparables, round(s.sd, 6) as price_std, round(s.rg, 6) as price_range
        from {_dist(_COMPARABLES)} d,
          (select count(*) as n, stddev_samp(price) as sd, max(price) - min(price) as rg
           from {_COMPARABLES} c) s
        order by d.price desc, d.c_custkey""",
    "prepare_listings": f"""select f.event_id, f.user_id, cast(f.user_id as integer) as user_text,
        f.value as value_text, f.value,
        {_ind('f.event_type', 'click', 'event_type_click')},
        {_ind('f.event_type', 'error', 'event_type_error')},
        {_ind('f.event_type', 'purchase', 'event_type_purchase')},
        {_ind('f.event_type', 'signup', 'event_type_signup')},
        {_ind('f.event_type', 'view', 'event_type_view')},
        {', '.join(_ind("strftime(f.ts, '%a')", x, f'day_{x}') for x in _DAYS)}
        from {_OVER_MEAN} f, (select avg(value) as m, stddev_pop(value) as sd from {_OVER_MEAN} g) z
        where abs((f.value - z.m) / nullif(z.sd, 0)) < 2.5""",
    "frequency_filter_mean": f"select {_EVENT_COLS} from {_OVER_MEAN} f",
    "annotate_count_nulls": f"""select event_id, user_id, count(*) over (partition by user_id) as n
        from {_NULLED} e""",
    "frequency_filter_nulls": f"""select {_EVENT_COLS} from
        (select *, count(*) over (partition by user_id) as c from {_NULLED} e) w
        where c * greatest(2, (select count(distinct user_id) from {_NULLED} e)) > (select count(*) from events)""",
    "zscore_by_group_nulls": f"""select {_EVENT_COLS} from
        (select *, avg(value) over (partition by event_type) as m,
         stddev_pop(value) over (partition by event_type) as sd from {_NULLED} e) w
        where abs((value - m) / nullif(sd, 0)) < 2.5""",
    "drop_empty_groups_nulls": f"""select o_orderkey, o_custkey, is_train from
        (select *, min(is_train) over (partition by o_custkey) as lo,
         max(is_train) over (partition by o_custkey) as hi from
         (select o_orderkey, case when o_orderkey % 3 != 0 then o_custkey end as o_custkey, is_train
          from {_FLAGGED} f) x) w where lo = 0 and hi = 1""",
    "assign_all_rows": "select o_orderkey, true as has_cluster, true as is_nearest from orders",
    "missing_counts": """select count(*) as n_rows, cast(count_if(o_orderkey % 5 = 0) as bigint) as n_incomplete,
        cast(count_if(o_orderkey % 5 = 0) as bigint) as cust_band, cast(0 as bigint) as o_totalprice
        from orders""",
    "stage_values": """select o_orderkey, case o_orderkey % 4 when 0 then '007' when 1 then ''
        when 2 then o_orderstatus end as code from orders""",
    "corrupt_rows": """select o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',x' as line
        from orders where o_orderkey % 7 = 0""",
    "read_without_corrupt": """select o_orderkey, o_orderstatus, o_orderpriority from orders
        where o_orderkey % 7 != 0""",
    "read_inferred": "select o_orderkey, o_orderstatus, o_totalprice from orders",
    "comparables_by_nation": f"""select c_nationkey, count(*) as n, round(stddev_samp(price), 6) as std_samp,
        round(max(price) - min(price), 6) as range from {_COMPARABLES} c where c_nationkey > 4
        group by c_nationkey""",
    "comparables_place": f"""select c_custkey, c_nationkey, price from {_COMPARABLES} c
        where c_nationkey = 3 order by price desc, c_custkey""",
    "pipeline_overlay": f"""with f as {_FLAGGED},
        m as (select o_orderpriority, avg(o_totalprice) as p from f where is_train = 1 group by o_orderpriority),
        x as (select f.*, round(case when is_train = 0 then m.p else o_totalprice end, 6) as seen
              from f left join m on f.o_orderpriority = m.o_orderpriority),
        c as (select ascii(o_orderstatus) as cid, round(avg(seen), 6) as centre from x group by 1),
        a as (select * from (select x.*, c.cid as cluster, row_number() over (partition by o_orderkey
              order by round((seen - centre) * (seen - centre), 9), c.cid) as rn from x, c) where rn = 1),
        g as (select cluster, o_orderpriority, avg(o_totalprice) as prediction from a where is_train = 1
              group by cluster, o_orderpriority)
        select a.cluster, count(*) as n,
          round(avg(abs((o_totalprice - prediction) / nullif(prediction, 0))), 6) as mape,
          round(sqrt(avg((o_totalprice - prediction) * (o_totalprice - prediction))), 6) as rmse
        from a left join g on a.cluster = g.cluster and a.o_orderpriority = g.o_orderpriority
        where is_train = 0 group by a.cluster""",
    "kmeans_sizes": """select vec_id, true as is_nearest,
        (select count(*) from embeddings) as total_size from embeddings""",
    "gbt_predict": f"""select o_orderkey, cast({_PRICE} as double) as price, true as is_scored, true as is_close
        from orders where {_BUCKET} >= 70""",
    "global_price_model": f"""select count(*) as n, true as metrics_agree, true as explains_price
        from orders where {_BUCKET} >= 70""",
    "per_group_metrics": f"""select o_orderstatus, cast(count_if(is_train = 0) as bigint) as n,
        true as metrics_agree, true as explains_price from {_FLAGGED} f group by o_orderstatus
        having count_if(is_train = 1) > 0 and count_if(is_train = 0) > 0""",
    "clustered_price_model": f"""select o_orderkey, is_train, true as has_cluster, true as kept_as_stated,
        true as scored_as_stated, true as real_label from {_FLAGGED} f""",
    "clustered_price_summary": """select true as rmse_of_the_union, true as mape_of_the_union,
        true as best_is_lowest, true as sizes_add_up""",
    "leak_free_cluster_model": f"""select o_orderkey, is_train, true as has_cluster, true as kept_as_stated,
        true as scored_as_stated, true as real_label from {_FLAGGED} f""",
    "delimited_roundtrip": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        o_orderpriority from orders""",
    "one_hot_vector": "select o_orderkey, " + ", ".join(
        f"case when o_orderpriority = '{v}' then cast(1 as double) else cast(0 as double) end "
        f"as o_orderpriority_vec_{i}"
        for i, v in enumerate(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]))
        + " from orders",
    "select_group": """select o_orderkey, o_orderstatus, o_totalprice from orders
        where o_orderstatus = 'F'""",
    "drop_empty_groups": f"""select o_orderkey, o_custkey, is_train from {_FLAGGED} f
        where o_custkey in (select o_custkey from {_FLAGGED} g group by o_custkey
                            having count_if(is_train = 1) > 0 and count_if(is_train = 0) > 0)""",
    "row_count": "select count(*) as n_rows from events",
    "flag_when": """select o_orderkey,
        case when o_orderpriority = '1-URGENT' then 1 else 0 end as is_urgent from orders""",
    "stage_roundtrip": "select o_orderkey, o_orderstatus, o_totalprice from orders",
}
