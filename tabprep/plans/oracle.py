"""DuckDB SQL oracles, one per registered query that SQL can express.

Written independently of the Spark code: plain SQL over the driver tables,
with the derived views inlined as CTEs.  Doubles are rounded to 6 decimals
as on the Spark side.
"""

from __future__ import annotations

from ..functions.text import DEFAULT_MISSING_VALUES
from ..sources.fixtures import with_views as wv


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOKENS = "(" + ", ".join(_sq(t) for t in DEFAULT_MISSING_VALUES) + ")"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def SPACES(x: str) -> str:
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def TITLE(x: str) -> str:
    return (f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: case when i = 1 or not "
            f"regexp_matches(substr({x}, i - 1, 1), '\\p{{L}}') then upper(substr({x}, i, 1)) "
            f"else lower(substr({x}, i, 1)) end), '')")


def CLEANED(x: str, replacement: str = "null") -> str:
    """strip, then placeholder (or NULL) -> replacement"""
    return f"(case when {x} is null or {STRIP(x)} in {TOKENS} then {replacement} else {STRIP(x)} end)"


def R(x: str, d: int = 6) -> str:
    """Round like Spark: half-up on the shortest decimal form of the double
    (DuckDB's own round multiplies first and can tip near-ties the other way)."""
    return (f"(case when isfinite(({x})::double) then cast(round(cast(cast(({x})::double as varchar) "
            f"as decimal(38, 18)), {d}) as double) else ({x})::double end)")


def _fill_sql(stat_a: str, stat_b: str) -> str:
    return wv(f"""
select event_id, {R(f"coalesce(value, ({stat_a}))")} as value,
       {R(f"coalesce(bucket, ({stat_b}))")} as bucket
from dirty_events""", "dirty_events")


def _mode(col: str) -> str:
    return (f"select {col} from dirty_events where {col} is not null group by {col} "
            f"order by count(*) desc, {col} asc limit 1")


def _group_stats_sql(table: str, key: str, val: str, where: str = "") -> str:
    return f"""
select {key}, count({val}) as count, {R(f"coalesce(sum({val}), 0)", 2)} as sum,
       {R(f"avg({val})", 2)} as mean, {R(f"stddev_samp({val})", 2)} as std,
       {R(f"var_samp({val})", 2)} as var, {R(f"min({val})", 2)} as min, {R(f"max({val})", 2)} as max,
       {R(f"median({val})", 2)} as median
from {table} where {key} is not null {where} group by {key}"""


ORACLE = {
    "flagship_clean_group_stats": wv(
        "with cleaned as (select " + SPACES("lower(" + CLEANED("label") + ")") + " as label, value from dirty_events)"
        + _group_stats_sql("cleaned", "label", "value"), "dirty_events"),
    "clean_object_columns": wv(f"select event_id, {CLEANED('label')} as label from dirty_events",
                               "dirty_events"),
    "clean_replace_upper_spaces": wv(
        f"select event_id, {SPACES('upper(' + CLEANED('label', _sq('missing')) + ')')} as label "
        "from dirty_events", "dirty_events"),
    "clean_no_strip_lower": wv(
        f"select event_id, lower(case when label in {TOKENS} then 'n/a' else label end) as label "
        "from dirty_events", "dirty_events"),
    "case_title": wv(f"select event_id, {SPACES(TITLE(CLEANED('label')))} as label from dirty_events",
                     "dirty_events"),
    "fill_mean": _fill_sql("select avg(value) from dirty_events", "select avg(bucket) from dirty_events"),
    "fill_median": _fill_sql("select median(value) from dirty_events",
                             "select median(bucket) from dirty_events"),
    "fill_mode": _fill_sql(_mode("value"), _mode("bucket")),
    "fill_zero": _fill_sql("select 0.0::double", "select 0.0::double"),
    "fill_value": _fill_sql("select -1.0::double", "select -1.0::double"),
    "drop_na_rows": wv(f"select event_id, {R('value')} as value, {R('bucket')} as bucket from dirty_events "
                       "where value is not null and bucket is not null", "dirty_events"),
    "clean_dataframe": wv(f"""
select event_id, user_id, {SPACES('lower(' + CLEANED('label') + ')')} as label,
       {R("coalesce(value, (select median(value) from dirty_events))")} as value,
       {R("coalesce(bucket, (select median(bucket) from dirty_events))")} as bucket
from dirty_events""", "dirty_events"),
    "null_counts": wv("""
select 'event_id' as "column", cast(count(*) - count(event_id) as bigint) as null_count from dirty_events
union all select 'user_id', cast(count(*) - count(user_id) as bigint) from dirty_events
union all select 'label', cast(count(*) - count(label) as bigint) from dirty_events
union all select 'value', cast(count(*) - count(value) as bigint) from dirty_events
union all select 'bucket', cast(count(*) - count(bucket) as bigint) from dirty_events""", "dirty_events"),
    "bad_value_counts": wv(f"""
select 'label' as "column", cast(count(*) filter (where {STRIP('label')} in {TOKENS}) as bigint) as bad_count
from dirty_events""", "dirty_events"),
    "whitespace_only_counts": wv(f"""
with d as (select label, case when event_id % 11 = 0 then ' ' || chr(9) || ' ' else label end as note
           from dirty_events)
select 'label' as "column", cast(count(*) filter (where {STRIP('label')} = '') as bigint) as blank_count from d
union all
select 'note', cast(count(*) filter (where {STRIP('note')} = '') as bigint) from d""", "dirty_events"),
    "unique_values": """
with long as (select 'event_type' as col, event_type as value from events
              union all select 'props', props from events),
per as (select col, value, count(*) as n from long group by col, value),
cnt as (select col, cast(count(*) as bigint) as n_unique from per group by col),
top as (select col, value as top_value, cast(n as bigint) as top_count from (
          select *, row_number() over (partition by col order by n desc, value asc) as rn
          from per where value is not null) where rn = 1)
select cnt.col as "column", n_unique, top_value, top_count from cnt left join top on cnt.col = top.col""",
    "unique_values_first_seen": """
with long as (select 'event_type' as col, event_type as value, event_id from events
              union all select 'props', props, event_id from events),
per as (select col, value, min(event_id) as f from long group by col, value),
ranked as (select col, value, row_number() over (partition by col order by f) as rn from per)
select col as "column", cast(rn as integer) as position, value from ranked where rn <= 50""",
    "min_max_profile": """
select 'l_orderkey' as "column", cast(min(l_orderkey) as bigint) as min, cast(max(l_orderkey) as bigint) as max from lineitem
union all select 'l_partkey', min(l_partkey), max(l_partkey) from lineitem
union all select 'l_suppkey', min(l_suppkey), max(l_suppkey) from lineitem
union all select 'l_linenumber', min(l_linenumber), max(l_linenumber) from lineitem""",
    "add_commas": "select o_orderkey, format('{:,.2f}', o_totalprice) as totalprice_fmt from orders",
    "group_mean_count_sum": """
with g as (select cast(l_returnflag as varchar) as l_returnflag, avg(l_extendedprice) as mean,
                  count(l_extendedprice) as count, cast(coalesce(sum(l_extendedprice), 0) as double) as sum
           from lineitem where l_returnflag is not null group by 1)
select l_returnflag, round(mean, 2) as mean, count, round(sum, 2) as sum from g
union all select 'Total', round(sum(mean), 2), cast(sum(count) as bigint), round(sum(sum), 2) from g""",
    "group_mean_count_sum_rollup": """
with g as (select cast(l_returnflag as varchar) as l_returnflag, avg(l_extendedprice) as mean,
                  count(l_extendedprice) as count, cast(coalesce(sum(l_extendedprice), 0) as double) as sum
           from lineitem where l_returnflag is not null group by 1)
select l_returnflag, round(mean, 2) as mean, count, round(sum, 2) as sum from g
union all select 'Total', round(avg(l_extendedprice), 2), count(l_extendedprice),
                 round(coalesce(sum(l_extendedprice), 0), 2) from lineitem where l_returnflag is not null""",
    "group_agg_multi": """
with g as (select cast(l_linestatus as varchar) as l_linestatus,
                  round(cast(sum(l_quantity) as double), 2) as l_quantity_sum,
                  round(avg(l_quantity), 2) as l_quantity_mean,
                  round(cast(count(l_quantity) as double), 2) as l_quantity_count,
                  round(min(l_discount), 2) as l_discount_min, round(max(l_discount), 2) as l_discount_max,
                  round(avg(l_discount), 2) as l_discount_mean, round(stddev_samp(l_tax), 2) as l_tax_std
           from lineitem where l_linestatus is not null group by 1)
select * from g
union all select 'Total', round(sum(l_quantity_sum), 2), round(sum(l_quantity_mean), 2),
                 round(sum(l_quantity_count), 2), round(sum(l_discount_min), 2), round(sum(l_discount_max), 2),
                 round(sum(l_discount_mean), 2), round(sum(l_tax_std), 2) from g""",
    "group_stats": _group_stats_sql("lineitem", "l_returnflag", "l_quantity"),
    "coefficient_of_variation": "with s as (" + _group_stats_sql("lineitem", "l_returnflag", "l_extendedprice")
    + ") select *, round(std / nullif(mean, 0) * 100.0, 6) as cv from s",
    "anova_f": """
with per as (select event_type, count(value) as n, avg(value) as m, var_samp(value) as v, sum(value) as s
             from events where event_type is not null and value is not null group by event_type),
g as (select sum(s) / sum(n) as mm from per),
t as (select count(*) as n_groups, sum(n) as n_total, sum(n * (m - mm) * (m - mm)) as ss_between,
             sum(coalesce((n - 1) * v, 0)) as ss_within from per, g)
select cast(n_groups as bigint) as n_groups, cast(n_total as bigint) as n_total,
       round(ss_between, 6) as ss_between, round(ss_within, 6) as ss_within,
       cast(n_groups - 1 as double) as df_between, cast(n_total - n_groups as double) as df_within,
       round((ss_between / (n_groups - 1)) / (ss_within / (n_total - n_groups)), 6) as f_stat from t""",
    "group_range": """
select l_returnflag, round(min(l_extendedprice), 6) as min, round(max(l_extendedprice), 6) as max,
       round(max(l_extendedprice) - min(l_extendedprice), 6) as range
from lineitem where l_returnflag is not null group by l_returnflag""",
    "group_std": """
select event_type, round(stddev_samp(value), 6) as std from events where event_type is not null
group by event_type""",
    "group_percentiles": """
select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) as p25,
       round(quantile_cont(l_extendedprice, 0.5), 6) as p50, round(quantile_cont(l_extendedprice, 0.75), 6) as p75,
       round(quantile_cont(l_extendedprice, 0.9), 6) as p90, round(quantile_cont(l_extendedprice, 0.95), 6) as p95
from lineitem where l_returnflag is not null and l_extendedprice is not null group by l_returnflag""",
    "group_percentiles_events": """
select event_type, round(quantile_cont(value, 0.25), 6) as p25, round(quantile_cont(value, 0.5), 6) as p50,
       round(quantile_cont(value, 0.75), 6) as p75, round(quantile_cont(value, 0.9), 6) as p90,
       round(quantile_cont(value, 0.95), 6) as p95
from events where event_type is not null and value is not null group by event_type""",
}


def _vd(k: str) -> str:
    return f"""
with per as (select event_type, count(*) as rows_, var_samp(value) as v from events
             where event_type is not null group by event_type),
t as (select var_samp(value) as total_var from events),
w as (select sum(coalesce((rows_ - 1) * v, 0)) / (sum(rows_) - {k}) as within_var from per)
select round(total_var, 6) as total_var, round(within_var, 6) as within_var,
       round(total_var - within_var, 6) as between_var,
       round((total_var - within_var) / within_var, 6) as ratio
from t, w"""


ORACLE["variance_decomposition"] = _vd("count(*)")
ORACLE["variance_decomposition_k3"] = _vd("3")


# ---------------------------------------------------------------- outliers
def _outliers_sql(table: str, cols: list[str], m: float) -> str:
    parts = []
    for col in cols:
        parts.append(f"""
select '{col}' as "column", q1, q3, lo, hi, mn, mx, n,
       (select count(*) from {table} where {col} < lo or {col} > hi) as total_outliers
from (select quantile_cont({col}, 0.25) as q1, quantile_cont({col}, 0.75) as q3,
             min({col})::double as mn, max({col})::double as mx, count(*) as n from {table}) s,
     lateral (select q1 - {m} * (q3 - q1) as lo, q3 + {m} * (q3 - q1) as hi) b""")
    return "\nunion all".join(parts)


def _analyze_outliers(table, cols, m):
    return f"""
with o as ({_outliers_sql(table, cols, m)})
select "column", cast(total_outliers as bigint) as total_outliers,
       round(total_outliers / n * 100.0, 6) as outlier_pct,
       printf('%.1f%%', round(total_outliers / n * 100.0, 1)) as percentage,
       round(q1, 6) as q1, round(q3, 6) as q3, round(lo, 6) as lower_bound, round(hi, 6) as upper_bound,
       round(mn, 6) as actual_min, round(mx, 6) as actual_max
from o"""


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax"]
ORACLE["analyze_outliers"] = _analyze_outliers("lineitem", _LI_NUM, 1.5)
ORACLE["analyze_outliers_selected"] = _analyze_outliers("lineitem", ["l_quantity", "l_extendedprice", "l_tax"], 0.5)
ORACLE["detect_outliers"] = f"""
with o as ({_outliers_sql("events", ["value"], 1.5)})
select "column", cast(total_outliers as bigint) as total_outliers,
       printf('%.1f%%', round(total_outliers / n * 100.0, 1)) as percentage,
       round(lo, 6) as lower_bound, round(hi, 6) as upper_bound from o"""
ORACLE["outlier_rows"] = """
with b as (select 'value' as col, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events
           union all
           select 'user_id', quantile_cont(user_id, 0.25), quantile_cont(user_id, 0.75) from events),
f as (select col, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from b),
long as (select event_id, 'value' as col, value as v from events
         union all select event_id, 'user_id', cast(user_id as double) from events)
select event_id, long.col as "column", round(v, 6) as value from long join f on long.col = f.col
where v < lo or v > hi"""
ORACLE["boxplot_stats"] = """
with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
                  quantile_cont(value, 0.75) as q3 from events
           where event_type is not null and value is not null group by event_type),
f as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
select e.event_type, round(any_value(q1), 6) as q1, round(any_value(median), 6) as median,
       round(any_value(q3), 6) as q3,
       round(min(value) filter (where value >= lo and value <= hi), 6) as whisker_low,
       round(max(value) filter (where value >= lo and value <= hi), 6) as whisker_high,
       cast(count(*) filter (where not (value >= lo and value <= hi)) as bigint) as n_fliers
from events e join f on e.event_type = f.event_type where value is not null group by e.event_type"""


# ---------------------------------------------------------------- correlation
def _r(a: str, b: str) -> str:
    both = f"{a} is not null and {b} is not null"
    xa, xb = f"case when {both} then {a} end", f"case when {both} then {b} end"
    return (f"covar_samp({xa}, {xb}) / nullif(stddev_samp({xa}) * stddev_samp({xb}), 0)")


_LC_ALL = ["loan_id", "revol_util", "installment", "dti", "not_fully_paid", "revol_dup",
           "installment_near", "constant_col"]
_LC_FEAT = ["revol_util", "installment", "dti", "revol_dup", "installment_near", "constant_col"]


def _corr_long(cols: list[str]) -> str:
    parts = []
    for j, b in enumerate(cols):
        for i, a in enumerate(cols):
            parts.append(f"select '{a}' as col_a, '{b}' as col_b, {i} as idx_a, {j} as idx_b, "
                         f"{_r(a, b)} as r from loans_corr")
    return "\nunion all ".join(parts)


ORACLE["corr_matrix"] = wv(f"""
select col_a, col_b, cast(idx_a as integer) as idx_a, cast(idx_b as integer) as idx_b, round(r, 6) as r
from ({_corr_long(_LC_ALL)})""", "loans_corr")
ORACLE["corr_matrix_wide"] = """
with long as (select vec_id, i, cast(embedding[i + 1] as double) as v from embeddings, range(64) t(i) where (vec_id + i) % 7 <> 0)
select 'e' || a.i as col_a, 'e' || b.i as col_b, cast(a.i as integer) as idx_a, cast(b.i as integer) as idx_b, round(corr(a.v, b.v), 6) as r
from long a join long b using (vec_id) group by a.i, b.i"""
ORACLE["target_correlation"] = wv("\nunion all ".join(
    f"select '{a}' as feature, round({_r(a, 'not_fully_paid')}, 6) as corr from loans_corr" for a in _LC_ALL),
    "loans_corr")
ORACLE["high_corr_pairs"] = wv(f"""
select col_a as feature_1, col_b as feature_2, round(abs(r), 6) as abs_corr,
       cast(idx_a as integer) as idx_1, cast(idx_b as integer) as idx_2
from ({_corr_long(_LC_FEAT)}) where idx_a < idx_b and abs(r) > 0.7""", "loans_corr")
_DROP_FEAT = [x for x in _LC_ALL if x not in ("loan_id", "not_fully_paid")]
ORACLE["drop_high_corr"] = wv(f"""
with pairs as (select col_a as f1, col_b as f2, idx_a, idx_b from ({_corr_long(_DROP_FEAT)})
               where idx_a < idx_b and abs(r) > 0.7),
tc as ({' union all '.join(f"select '{a}' as feature, round(abs({_r(a, 'not_fully_paid')}), 12) as tc from loans_corr"
                            for a in _DROP_FEAT)}),
d as (select case when t1.tc < t2.tc then f1 else f2 end as feature, idx_b, idx_a
      from pairs left join tc t1 on t1.feature = f1 left join tc t2 on t2.feature = f2),
firsts as (select feature, min(idx_b * 100000 + idx_a) as pos from d group by feature)
select feature, cast(row_number() over (order by pos) as integer) as drop_order from firsts""", "loans_corr")


# ---------------------------------------------------------------- histograms
def _hist_sql(long_sql: str, keys: list[str], bins: int = 30) -> str:
    k = ", ".join(keys)
    on = " and ".join(f"l.{x} = r.{x}" for x in keys)
    return f"""
with long as ({long_sql}),
rng as (select {k}, min(value) as mn, max(value) as mx from long where value is not null group by {k}),
r2 as (select {k}, case when mx > mn then mn else mn - 0.5 end as lo,
              ((case when mx > mn then mx else mx + 0.5 end) - (case when mx > mn then mn else mn - 0.5 end))
              / {float(bins)} as w from rng),
cnt as (select {', '.join('l.' + x for x in keys)},
               least({bins - 1}, cast(floor((value - lo) / w) as integer)) as bin, count(*) as n
        from long l join r2 r on {on} where value is not null group by all),
grid as (select {k}, lo, w, cast(unnest(range(0, {bins})) as integer) as bin from r2)
select {', '.join('g.' + x for x in keys)}, g.bin, round(lo + g.bin * w, 6) as bin_start,
       round(lo + (g.bin + 1) * w, 6) as bin_end, cast(coalesce(n, 0) as bigint) as count
from grid g left join cnt c on {' and '.join(f'g.{x} = c.{x}' for x in keys)} and g.bin = c.bin"""


ORACLE["class_histogram"] = wv(_hist_sql(" union all ".join(
    f"select '{f}' as feature, not_fully_paid as class, cast({f} as double) as value from loans"
    for f in ["revol_util", "dti", "inq_last_6mths", "installment"]), ["feature", "class"]), "loans")
ORACLE["group_histogram"] = _hist_sql(
    "select event_type, value from events where event_type is not null", ["event_type"])
ORACLE["category_by_target"] = wv("""
with per as (select purpose, not_fully_paid, count(*) as count from loans
             where purpose is not null and not_fully_paid is not null group by all),
tot as (select purpose, count(*) as category_total from loans
        where purpose is not null and not_fully_paid is not null group by purpose)
select per.purpose, not_fully_paid, cast(count as bigint) as count, cast(category_total as bigint) as category_total
from per join tot on per.purpose = tot.purpose""", "loans")


# ---------------------------------------------------------------- crosstab / value counts
ORACLE["value_counts_pct"] = wv("""
select purpose, cast(count(*) as bigint) as count,
       round(count(*) * 100.0 / (select count(*) from loans), 6) as percent
from loans where purpose is not null group by purpose""", "loans")
ORACLE["crosstab"] = wv("""
with k1 as (select distinct purpose from loans where purpose is not null and inq_last_6mths is not null),
k2 as (select distinct inq_last_6mths from loans where purpose is not null and inq_last_6mths is not null),
n as (select purpose, inq_last_6mths, count(*) as c from loans
      where purpose is not null and inq_last_6mths is not null group by all)
select k1.purpose, k2.inq_last_6mths, cast(coalesce(n.c, 0) as bigint) as count
from k1, k2 left join n on n.purpose = k1.purpose and n.inq_last_6mths = k2.inq_last_6mths""", "loans")
ORACLE["crosstab_range"] = wv("""
with f as (select * from loans where inq_last_6mths > 2 and inq_last_6mths <= 6
           and purpose is not null and inq_last_6mths is not null),
k1 as (select distinct inq_last_6mths from f), k2 as (select distinct purpose from f),
n as (select inq_last_6mths, purpose, count(*) as c from f group by all)
select k1.inq_last_6mths, k2.purpose, cast(coalesce(n.c, 0) as bigint) as count
from k1, k2 left join n on n.inq_last_6mths = k1.inq_last_6mths and n.purpose = k2.purpose""", "loans")
ORACLE["crosstab_total"] = wv("""
select purpose, cast(count(*) as bigint) as total from loans
where inq_last_6mths > 2 and inq_last_6mths <= 6 and purpose is not null group by purpose""", "loans")


# ---------------------------------------------------------------- imbalance
def _sev(r: str) -> str:
    return (f"case when {r} < 1.5 then 'Balanced ✅' when {r} < 3 then 'Slight Imbalance ⚠️' "
            f"when {r} < 9 then 'Moderate Imbalance 🟡' when {r} < 99 then 'Severe Imbalance 🟠' "
            f"else 'Extreme Imbalance 🔴' end")


def _act(r: str) -> str:
    return (f"case when {r} < 1.5 then 'No special handling needed' when {r} < 3 then 'Monitor metrics closely' "
            f"when {r} < 9 then 'Use class weights or resampling' "
            f"when {r} < 99 then 'Special techniques required (SMOTE, heavy class weights)' "
            f"else 'Consider anomaly detection approaches' end")


def _label(x: str, labels: dict | None) -> str:
    base = f"'Class ' || cast({x} as varchar)"
    if not labels:
        return base
    cases = " ".join(f"when {k} then ' ({v})'" for k, v in labels.items())
    return f"{base} || coalesce(case {x} {cases} end, '')"


def _counts(view: str, col: str) -> str:
    return f"select {col} as class, count(*) as count from {view} where {col} is not null group by {col}"


def _check_sql(view: str, col: str, labels: dict | None) -> str:
    return wv(f"""
with cnt as ({_counts(view, col)}),
e as (select sum(count) as total, count(*) as n_classes, max(count) as majority_count,
             min(count) as minority_count,
             (select class from cnt order by count desc, class asc limit 1) as majority_class,
             (select class from cnt order by count asc, class asc limit 1) as minority_class from cnt),
r as (select *, majority_count / minority_count as ratio from e)
select '{col}' as target_column, cast(n_classes as bigint) as n_classes, cast(total as bigint) as total_samples,
       majority_class, cast(majority_count as bigint) as majority_count, minority_class,
       cast(minority_count as bigint) as minority_count,
       {_label('majority_class', labels)} as majority_label, {_label('minority_class', labels)} as minority_label,
       printf('%.2f%%', round(minority_count * 100.0 / total, 2)) as minority_percentage,
       round(ratio, 6) as ratio, printf('%.2f:1', round(ratio, 2)) as imbalance_ratio,
       {_sev('ratio')} as severity, {_act('ratio')} as recommended_action from r""", view)


_LL = {0: "Paid", 1: "Default"}
ORACLE["imbalance_classes"] = wv(f"""
with cnt as ({_counts('loans', 'not_fully_paid')})
select class, {_label('class', _LL)} as class_label_display, cast(count as bigint) as count,
       round(count * 100.0 / sum(count) over (), 6) as percentage,
       round(max(count) over () / count, 6) as ratio_to_majority,
       round(count / min(count) over (), 6) as ratio_to_minority from cnt""", "loans")
ORACLE["check_imbalance"] = _check_sql("loans", "not_fully_paid", _LL)
ORACLE["check_imbalance_toxic"] = _check_sql("doc_labels", "toxic", None)


def _weights_sql(view, col):
    return wv(f"""
with cnt as ({_counts(view, col)}),
w as (select class, count, sum(count) over () / (count(*) over () * count) as weight from cnt)
select class, cast(count as bigint) as count, round(weight, 6) as weight,
       round(case when (select count(*) from cnt) = 2 then
             (select weight from w order by class desc limit 1) / (select weight from w order by class limit 1)
             end, 6) as weight_ratio from w""", view)


ORACLE["class_weights"] = _weights_sql("loans", "not_fully_paid")
ORACLE["class_weights_quality"] = _weights_sql("doc_labels", "quality")
ORACLE["scale_pos_weight"] = wv("""
select round(count(*) filter (where not_fully_paid = 0) / count(*) filter (where not_fully_paid = 1), 6)
       as scale_pos_weight from loans""", "loans")


# ---------------------------------------------------------------- metrics
_PRED = "(select *, cast(score >= {t} as integer) as prediction from scored)"


def _counts_sql(t: float) -> str:
    return f"""
select count(*) filter (where label = 0 and prediction = 0) as tn,
       count(*) filter (where label = 0 and prediction = 1) as fp,
       count(*) filter (where label = 1 and prediction = 0) as fn,
       count(*) filter (where label = 1 and prediction = 1) as tp
from {_PRED.format(t=t)}"""


def _rates_sql(tn="tn", fp="fp", fn="fn", tp="tp") -> str:
    return (f"round(coalesce(({tp} + {tn}) / nullif({tp} + {tn} + {fp} + {fn}, 0), 0), 6) as accuracy, "
            f"round(coalesce({tp} / nullif({tp} + {fp}, 0), 0), 6) as precision, "
            f"round(coalesce({tp} / nullif({tp} + {fn}, 0), 0), 6) as recall, "
            f"round(coalesce(2.0 * {tp} / nullif(2.0 * {tp} + {fp} + {fn}, 0), 0), 6) as f1")


_CM = f"""
with p as {_PRED.format(t=0.5)},
cls as (select label as v from p union select prediction from p),
n as (select label as actual, prediction as predicted, count(*) as c from p group by all)
select a.v as actual, b.v as predicted, cast(coalesce(n.c, 0) as bigint) as count
from cls a, cls b left join n on n.actual = a.v and n.predicted = b.v"""
ORACLE["confusion_matrix"] = wv(_CM, "scored")
ORACLE["confusion_matrix_norm"] = wv(f"""
with cm as ({_CM})
select actual, predicted, count, round(count / sum(count) over (partition by actual), 6) as share from cm""",
                                     "scored")
ORACLE["confusion_rates"] = wv(f"""
with k as ({_counts_sql(0.5)})
select cast(tn as bigint) as tn, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tp as bigint) as tp,
       round(tn / (tn + fp) * 100, 6) as tn_pct, round(fp / (tn + fp) * 100, 6) as fp_pct,
       round(fn / (fn + tp) * 100, 6) as fn_pct, round(tp / (fn + tp) * 100, 6) as tp_pct from k""", "scored")
ORACLE["basic_metrics"] = wv(f"with k as ({_counts_sql(0.4)}) select {_rates_sql()} from k", "scored")
ORACLE["classification_report"] = wv(f"""
with cm as ({_CM}),
per as (select actual as cls, sum(case when actual = predicted then count else 0 end) as tp,
               sum(count) as support from cm group by actual),
pred as (select predicted as cls, sum(count) as pred_total from cm group by predicted),
t as (select per.cls, tp, support, coalesce(tp / nullif(pred_total, 0), 0) as precision,
             coalesce(tp / nullif(support, 0), 0) as recall from per join pred on per.cls = pred.cls),
t2 as (select *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0) as f1_score from t)
select cast(cls as varchar) as class, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1_score, 6) as f1_score, cast(support as bigint) as support from t2
union all select 'accuracy', null, null, round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from t2
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
                 cast(sum(support) as bigint) from t2
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1_score * support) / sum(support), 6),
                 cast(sum(support) as bigint) from t2""", "scored")
_CUM = """
with st as (select cast(score as double) as score, count(*) filter (where label = 1) as pos,
                   count(*) filter (where label <> 1) as neg
            from scored where score is not null and label is not null group by score),
cum as (select score, pos, neg,
               sum(pos) over (order by score desc rows between unbounded preceding and current row) as cum_pos,
               sum(neg) over (order by score desc rows between unbounded preceding and current row) as cum_neg,
               sum(pos) over () as tot_pos, sum(neg) over () as tot_neg from st)"""
ORACLE["roc_curve"] = wv(_CUM + """
select 'inf'::double as threshold, 0.0::double as fpr, 0.0::double as tpr
union all select score, round(cum_neg / tot_neg, 6), round(cum_pos / tot_pos, 6) from cum""", "scored")
ORACLE["roc_auc"] = wv(_CUM + """,
a as (select sum(pos * ((tot_neg - cum_neg) + neg / 2.0)) / (max(tot_pos) * max(tot_neg)) as roc_auc from cum)
select round(roc_auc, 6) as roc_auc,
       case when roc_auc >= 0.9 then 'Excellent discrimination ability'
            when roc_auc >= 0.8 then 'Good discrimination ability'
            when roc_auc >= 0.7 then 'Fair discrimination ability' else 'Poor discrimination ability' end as grade
from a""", "scored")
ORACLE["pr_curve"] = wv(_CUM + """
select score as threshold, round(coalesce(cum_pos / nullif(cum_pos + cum_neg, 0), 0), 6) as precision,
       round(coalesce(cum_pos / nullif(tot_pos, 0), 1), 6) as recall from cum
union all select null, 1.0, 0.0""", "scored")
ORACLE["pr_baseline"] = wv("select round(avg(case when label = 1 then 1.0 else 0.0 end), 6) as positive_rate "
                           "from scored", "scored")


def _sweep_sql(ts, metric_expr: str) -> str:
    rows = " union all ".join(f"select {i} as seq, {t}::double as threshold" for i, t in enumerate(ts))
    return f"""
with th as ({rows}),
k as (select seq, threshold,
             count(*) filter (where score >= threshold and label = 1) as tp,
             count(*) filter (where score >= threshold and label <> 1) as fp,
             count(*) filter (where label = 1) - count(*) filter (where score >= threshold and label = 1) as fn,
             count(*) filter (where label <> 1) - count(*) filter (where score >= threshold and label <> 1) as tn
      from th, scored group by seq, threshold),
r as (select *, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0) as accuracy,
             coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
             coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) as f1 from k)
select cast(seq as integer) as seq, threshold, cast(tn as bigint) as tn, cast(fp as bigint) as fp,
       cast(fn as bigint) as fn, cast(tp as bigint) as tp, round(accuracy, 6) as accuracy,
       round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       round({metric_expr}, 6) as metric_value from r"""


ORACLE["threshold_sweep"] = wv(_sweep_sql([0.3, 0.4, 0.5, 0.6, 0.7], "f1"), "scored")
ORACLE["threshold_sweep_recall_weighted"] = wv(_CUM.replace("with st as", "with st as") + ",\n" + """
auc as (select sum(pos * ((tot_neg - cum_neg) + neg / 2.0)) / (max(tot_pos) * max(tot_neg)) as roc_auc from cum),
""" + _sweep_sql([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
                 "0.3 * (select roc_auc from auc) + 0.6 * recall + 0.1 * f1").lstrip()[5:], "scored")
ORACLE["best_threshold"] = wv(_sweep_sql([0.3, 0.4, 0.5, 0.6, 0.7], "f1")
                              + " order by metric_value desc, seq asc limit 1", "scored")


# ---------------------------------------------------------------- features, encoding, split, scaling
_LOAN_COLS = ["loan_id", "purpose", "revol_util", "inq_last_6mths", "installment", "log_annual_inc",
              "days_with_cr_line", "dti", "not_fully_paid"]
_DBL = {"revol_util", "installment", "log_annual_inc", "days_with_cr_line", "dti"}


def _loan_col(x: str) -> str:
    return f"round({x}, 6) as {x}" if x in _DBL else x


ORACLE["loan_features"] = wv(f"""
select {', '.join(_loan_col(x) for x in _LOAN_COLS)},
       round(revol_util / 100.0, 6) as credit_util_ratio, inq_last_6mths * 2 as annual_inquiry_rate,
       round(installment / exp(log_annual_inc), 6) as debt_burden,
       round(days_with_cr_line / 365.25, 6) as credit_history_years,
       cast(coalesce(dti > 20, false) or coalesce(revol_util > 80, false) as integer) as high_debt,
       round(revol_util / 100.0 * 0.3 + (inq_last_6mths / 10.0) * 0.2 + (dti / 30.0) * 0.3
             + (1.0 - least(greatest(days_with_cr_line / 365.25 / 20.0, 0.0), 1.0)) * 0.2, 6) as risk_score
from loans""", "loans")

# The five order priorities of the orders table, sorted.
_PURPOSES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummies(x: str = "purpose") -> str:
    return ", ".join(f"cast(coalesce({x} = '{v}', false) as integer) as \"{x}_{v}\"" for v in _PURPOSES[1:])


ORACLE["one_hot_wide"] = """
with parts as (select part, cast(row_number() over (order by part) as integer) - 2 as dummy
               from (select distinct cast(l_partkey as varchar) as part from lineitem where l_partkey is not null))
select l_orderkey, l_linenumber, cast(l.l_partkey as varchar) as part, case when dummy >= 0 then dummy end as dummy
from lineitem l left join parts on parts.part = cast(l.l_partkey as varchar)"""
ORACLE["one_hot"] = wv(f"""
select {', '.join(_loan_col(x) for x in _LOAN_COLS if x != 'purpose')}, {_dummies()} from loans""", "loans")


def _split_sql(view: str, key: str, label: str | None, test: float, val: float, seed: int) -> str:
    """split per key; quotas by largest remainder in integer arithmetic"""
    cls = label if label else "'__all__'"
    return f"""
split_base as (select {key} as k, {cls} as cls,
                      row_number() over (partition by {cls} order by md5(cast({key} as varchar) || ':{seed}')) - 1 as rk
               from {view}),
cnt as (select cls, count(*) as n_c from split_base group by cls),
tot as (select sum(n_c) as n, cast(ceil(cast({test} as double) * sum(n_c)) as bigint) as n_test from cnt),
q1 as (select cls, n_c, (n_test * n_c) // n as base, (n_test * n_c) % n as rem, n, n_test from cnt, tot),
q1r as (select *, row_number() over (order by rem desc, cls asc) as r1,
               n_test - sum(base) over () as left1 from q1),
q1f as (select cls, n_c, n, n_test, base + case when r1 <= left1 then 1 else 0 end as qt from q1r),
q2 as (select *, n_c - qt as rest, n - n_test as n_rest,
              cast(ceil(cast({val} as double) * (n - n_test)) as bigint) as n_val from q1f),
q2b as (select *, case when n_rest = 0 then 0 else (n_val * rest) // n_rest end as base2,
               case when n_rest = 0 then 0 else (n_val * rest) % n_rest end as rem2 from q2),
q2r as (select *, row_number() over (order by rem2 desc, cls asc) as r2, n_val - sum(base2) over () as left2
        from q2b),
quota as (select cls, qt, base2 + case when r2 <= left2 then 1 else 0 end as qv from q2r),
splits as (select k, case when rk < qt then 'test' when rk < qt + qv then 'val' else 'train' end as split
           from split_base join quota using (cls))"""


ORACLE["stratified_split"] = wv("with " + _split_sql("loans", "loan_id", "not_fully_paid", 0.3, 0.2, 42)
                                + "\nselect k as loan_id, split from splits", "loans")
ORACLE["stratified_split_many"] = ("with " + _split_sql("orders", "o_orderkey", "o_custkey", 0.3, 0.2, 42)
                                   + "\nselect k as o_orderkey, split from splits")
ORACLE["random_split"] = wv("with " + _split_sql("loans", "loan_id", None, 0.25, 0.1, 7)
                            + "\nselect k as loan_id, split from splits", "loans")
ORACLE["split_class_distribution"] = wv("with " + _split_sql("loans", "loan_id", "not_fully_paid", 0.3, 0.2, 42) + """,
per as (select split, not_fully_paid as class, count(*) as count from loans join splits on loan_id = k
        group by all)
select split, class, cast(count as bigint) as count,
       round(count * 100.0 / sum(count) over (partition by split), 6) as percent from per""", "loans")
_SC = ["revol_util", "inq_last_6mths", "installment", "log_annual_inc", "days_with_cr_line", "dti"]


def _scaled(cols: list[str]) -> tuple[str, str]:
    stats = ", ".join(f'avg("{x}") as m_{i}, coalesce(nullif(stddev_pop("{x}"), 0), 1) as s_{i}'
                      for i, x in enumerate(cols))
    exprs = ", ".join(f'round(("{x}" - m_{i}) / s_{i}, 6) as "{x}"' for i, x in enumerate(cols))
    return stats, exprs


_st, _ex = _scaled(_SC)
ORACLE["standard_scale"] = wv("with " + _split_sql("loans", "loan_id", "not_fully_paid", 0.3, 0.2, 42) + f""",
d as (select loans.*, split from loans join splits on loan_id = k),
st as (select {_st} from d where split = 'train')
select loan_id, split, {_ex} from d, st""", "loans")
_PREP_FEATS = _SC + [f"purpose_{v}" for v in _PURPOSES[1:]]
_st2, _ex2 = _scaled(_PREP_FEATS)
ORACLE["prepare_data"] = wv("with " + _split_sql("loans", "loan_id", "not_fully_paid", 0.3, 0.2, 42) + f""",
enc as (select loan_id, {', '.join(_SC)}, {_dummies()}, not_fully_paid from loans),
d as (select enc.*, split from enc join splits on loan_id = k),
st as (select {_st2} from d where split = 'train')
select loan_id, {_ex2}, not_fully_paid, split from d, st""", "loans")


# ---------------------------------------------------------------- neighbours and SMOTE
_KF = ["revol_util", "inq_last_6mths", "installment", "dti"]


def _d2(a: str, b: str) -> str:
    s = "0.0"
    for f in _KF:
        s = f"({s} + ({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f}))"
    return f"sqrt({s})"


ORACLE["knn_self_join"] = wv(f"""
with m as (select loan_id, {', '.join(f'cast({f} as double) as {f}' for f in _KF)} from loans
           where not_fully_paid = 1),
p as (select a.loan_id as id, b.loan_id as nbr_id, {_d2('a', 'b')} as dist from m a join m b on a.loan_id <> b.loan_id),
r as (select *, row_number() over (partition by id order by dist, nbr_id) as nbr_rank from p)
select id, nbr_id, cast(nbr_rank as integer) as nbr_rank, round(dist, 6) as dist from r where nbr_rank <= 5""",
                            "loans")
ORACLE["smote_class_counts"] = wv("""
with cnt as (select not_fully_paid as class, count(*) as n from loans group by 1),
mx as (select max(n) as n_maj from cnt)
select class, cast(case when n = n_maj then n else greatest(n, cast(floor(0.5 * n_maj) as bigint)) end as bigint)
       as count from cnt, mx""", "loans")


ORACLE["group_density"] = """
with v as (select event_type, value from events where event_type is not null and value is not null),
st as (select event_type, count(*) as n, min(value) as mn, max(value) as mx,
              coalesce(nullif(stddev_samp(value), 0), 1.0) * pow(cast(count(*) as double), -0.2) as h
       from v group by event_type),
g as (select event_type, n, mn, mx, h, cast(unnest(range(0, 64)) as integer) as point from st),
p as (select event_type, n, h, point, mn + point * ((mx - mn) / 63.0) as x from g)
select p.event_type, p.point, round(any_value(p.x), 6) as x,
       round(sum(exp(-0.5 * ((v.value - p.x) / p.h) * ((v.value - p.x) / p.h)) / (p.h * p.n * sqrt(2 * pi()))), 6)
       as density
from p join v on p.event_type = v.event_type group by p.event_type, p.point"""


# ---------------------------------------------------------------- streaming
ORACLE["streaming_confusion_counts"] = wv(f"with k as ({_counts_sql(0.5)}) select cast(tn as bigint) as tn, "
                                          f"cast(fp as bigint) as fp, cast(fn as bigint) as fn, "
                                          f"cast(tp as bigint) as tp, {_rates_sql()} from k", "scored")
ORACLE["streaming_clean"] = ORACLE["clean_dataframe"]


# ---------------------------------------------------------------- composites and recipes
ORACLE["anova_for_column"] = f"""
with s as ({_group_stats_sql("events", "event_type", "value")}),
r as (select event_type, max(value) - min(value) as range from events where event_type is not null
      group by event_type),
q as (select event_type, quantile_cont(value, 0.25) as p25, quantile_cont(value, 0.5) as p50,
             quantile_cont(value, 0.75) as p75, quantile_cont(value, 0.9) as p90, quantile_cont(value, 0.95) as p95,
             quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) as lo,
             quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) as hi
      from events where event_type is not null and value is not null group by event_type),
b as (select e.event_type, min(value) filter (where value >= lo and value <= hi) as whisker_low,
             max(value) filter (where value >= lo and value <= hi) as whisker_high,
             count(*) filter (where not (value >= lo and value <= hi)) as n_fliers
      from events e join q on e.event_type = q.event_type where value is not null group by e.event_type)
select s.*, round(std / nullif(mean, 0) * 100.0, 6) as cv, round(r.range, 6) as range,
       round(p25, 6) as p25, round(p50, 6) as p50, round(p75, 6) as p75, round(p90, 6) as p90,
       round(p95, 6) as p95, round(whisker_low, 6) as whisker_low, round(whisker_high, 6) as whisker_high,
       cast(n_fliers as bigint) as n_fliers
from s left join r on s.event_type = r.event_type left join q on s.event_type = q.event_type
left join b on s.event_type = b.event_type"""
ORACLE["convert_recipes"] = """
select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as double) as priority_num,
       try_cast(o_orderpriority as double) as priority_bad,
       strftime(try_cast(cast(o_orderdate as varchar) as timestamp), '%Y-%m-%d %H:%M:%S') as order_ts,
       cast(case when (o_custkey % 10) in (0, 9) then null else o_custkey % 10 end as double) as cust_digit
from orders"""
ORACLE["threshold_cost"] = wv("with sw as (" + _sweep_sql([0.3, 0.4, 0.5, 0.6, 0.7], "f1")
                              + ") select *, fn * 500 + fp * 50 as cost from sw", "scored")
ORACLE["corr_mask_upper"] = wv(f"""
select col_a, col_b, cast(idx_a as integer) as idx_a, cast(idx_b as integer) as idx_b, round(r, 6) as r
from ({_corr_long(_LC_ALL)}) where idx_a > idx_b""", "loans_corr")
_LC_LONG = " union all ".join(f"select loan_id, '{x}' as feature, cast({x} as double) as value from loans_corr"
                             for x in _LC_ALL if x != "loan_id")
ORACLE["drop_highly_correlated_features"] = ORACLE["drop_high_corr"].replace(
    "select feature, cast(row_number() over (order by pos) as integer) as drop_order from firsts",
    f""", long as ({_LC_LONG})
select loan_id, feature, round(value, 6) as value from long
where feature not in (select feature from firsts)""")
ORACLE["unique_values_all"] = """
with long as (select 'event_type' as col, event_type as value, event_id from events
              union all select 'props', props, event_id from events),
per as (select col, value, min(event_id) as f from long group by col, value)
select col as "column", cast(row_number() over (partition by col order by f) as bigint) as position, value
from per"""


# ---------------------------------------------------------------- missing values, wide fills, histories
_GAPS = """gaps as (select o_orderkey, o_orderpriority,
  case when o_orderkey % 3 = 1 then 9007199254740993 when o_orderkey % 3 = 2 then o_custkey end as big,
  case when o_orderkey % 4 <> 0 then cast(o_orderkey % 7 as int) end as small,
  case when o_orderkey % 5 <> 0 and o_orderpriority <> '5-LOW' then o_totalprice end as price from orders)"""
ORACLE["fill_mode_bigint"] = f"""
with {_GAPS}, m as (select big from gaps where big is not null group by big order by count(*) desc, big limit 1)
select o_orderkey, coalesce(gaps.big, m.big) as big from gaps, m"""
ORACLE["fill_value_widen"] = f"with {_GAPS} select o_orderkey, coalesce(cast(small as double), 0.5) as small from gaps"
ORACLE["fill_mean_nan"] = f"""
with {_GAPS}, m as (select avg(price) as a from gaps) select o_orderkey, round(coalesce(price, a), 4) as price from gaps, m"""
ORACLE["group_agg_multi_null_group"] = f"""
with {_GAPS}, g as (select o_orderpriority, case when o_orderpriority <> '1-URGENT' then price end as price from gaps)
select o_orderpriority, round(coalesce(sum(price), 0.0), 2) as price_sum, cast(count(price) as double) as price_count, round(max(price), 2) as price_max
from g where o_orderpriority is not null group by o_orderpriority"""
ORACLE["metric_history"] = wv("""
with r as (select id % 6 + 1 as round, id % 5 < 2 as v, score as s, label as y from scored),
k as (select round, v, cast(count(*) filter (where y = 1 and s >= 0.5) as double) as tp, cast(count(*) filter (where y = 0 and s >= 0.5) as double) as fp,
             cast(count(*) filter (where y = 1) as double) as p, cast(count(*) filter (where y = 0) as double) as n from r group by all),
a as (select x.round, x.v, sum(case when x.s > z.s then 1.0 when x.s = z.s then 0.5 else 0 end * x.c * z.c) as below
      from (select round, v, s, count(*) as c from r where y = 1 group by all) x join (select round, v, s, count(*) as c from r where y = 0 group by all) z
        on x.round = z.round and x.v = z.v group by all),
m as (select k.round, k.v, (tp + n - fp) / nullif(p + n, 0) as accuracy, tp / nullif(tp + fp, 0) as precision, tp / nullif(p, 0) as recall,
             2 * tp / nullif(tp + fp + p, 0) as f1, below / nullif(p * n, 0) as auc from k left join a on a.round = k.round and a.v = k.v),
u as (unpivot m on accuracy, precision, recall, f1, auc into name metric value value)
select round, case when v then 'val_' || metric else metric end as metric, round(value, 6) as value from u where value is not null""", "scored")
ORACLE["early_stop_rounds"] = """
with h as (select event_type as run, event_id % 60 + 1 as round, round(avg(value), 6) as v from events group by all),
b as (select *, max(v) over (partition by run order by round rows between unbounded preceding and 1 preceding) as before, row_number() over (partition by run order by round) as k from h),
u as (select *, v is not null and (before is null or v > before) as up from b),
l as (select *, coalesce(max(case when up then k end) over (partition by run order by round rows between unbounded preceding and current row), 0) as last from u),
o as (select *, k - last >= 5 as over from l),
s as (select *, coalesce(max(cast(over as int)) over (partition by run order by round rows between unbounded preceding and 1 preceding), 0) as gone from o)
select run, max(case when up then round end) as best_round, max(case when up then v end) as best_value, max(round) as stop_round, bool_or(over) as stopped
from s where gone = 0 group by run"""
ORACLE["anova_oneway"] = """
with per as (select event_type, count(value) as n, avg(value) as m, var_samp(value) as v, sum(value) as s
             from events where event_type is not null and value is not null group by event_type),
g as (select sum(s) / sum(n) as mm from per),
t as (select count(*) as n_groups, sum(n) as n_total, sum(n * (m - mm) * (m - mm)) as ss_between, sum(coalesce((n - 1) * v, 0)) as ss_within from per, g),
f as (select *, (ss_between / (n_groups - 1)) / (ss_within / (n_total - n_groups)) as f, (n_total - n_groups) / 2.0 as a from t),
x as (select *, (2 * a) / (2 * a + 4 * f) as x from f),
p as (select *, pow(x, a) * (1 + a * (1 - x)) as p from x)
select cast(n_groups as bigint) as n_groups, cast(n_total as bigint) as n_total, round(ss_between, 6) as ss_between, round(ss_within, 6) as ss_within,
       cast(n_groups - 1 as double) as df_between, cast(n_total - n_groups as double) as df_within, round(f, 6) as f_stat, round(p, 6) as p_value, p < 0.05 as significant from p"""


# ---------------------------------------------------------------- all results of a composite, long form
def _long_sql(result: str, sql: str, metrics: list[str], label: str = "null", at: str = "null") -> str:
    return "\nunion all ".join(
        f"select '{result}' as result, cast({label} as varchar) as label, cast({at} as double) as at, '{m}' as metric, cast({m} as double) as value from ({sql})"
        for m in metrics)


_SWEEP_COLS = ["tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1", "metric_value"]
ORACLE["evaluate_scored"] = "\nunion all ".join([
    _long_sql("confusion_matrix", ORACLE["confusion_matrix"], ["count"], "actual || ':' || predicted"),
    _long_sql("classification_report", ORACLE["classification_report"], ["precision", "recall", "f1_score", "support"], "class"),
    _long_sql("roc_curve", ORACLE["roc_curve"], ["fpr", "tpr"], at="threshold"),
    _long_sql("roc_auc", ORACLE["roc_auc"], ["roc_auc"], "grade"),
    _long_sql("pr_curve", ORACLE["pr_curve"], ["precision", "recall"], at="threshold"),
    _long_sql("threshold_sweep", ORACLE["threshold_sweep"], _SWEEP_COLS, at="threshold"),
    _long_sql("best_threshold", ORACLE["best_threshold"], _SWEEP_COLS, at="threshold")])
ORACLE["anova_for_column"] = "\nunion all ".join([
    _long_sql("per_group", ORACLE["anova_for_column"],
              ["count", "sum", "mean", "std", "var", "min", "max", "median", "cv", "range", "p25", "p50", "p75", "p90", "p95", "whisker_low", "whisker_high", "n_fliers"], "event_type"),
    _long_sql("anova", ORACLE["anova_oneway"], ["n_groups", "n_total", "ss_between", "ss_within", "df_between", "df_within", "f_stat", "p_value", "significant"]),
    _long_sql("variance", ORACLE["variance_decomposition"], ["total_var", "within_var", "between_var", "ratio"]),
    _long_sql("histogram", ORACLE["group_histogram"], ["bin_start", "bin_end", "count"], "event_type", "bin")])
ORACLE["column_info"] = wv("""
select t.*, (select count(*) from dirty_events) as n_rows, cast(5 as integer) as n_columns,
       case when t."column" = 'label' then (select string_agg(coalesce(label, 'NULL'), '|' order by event_id)
                                            from (select * from dirty_events order by event_id limit 3)) end as sample
from (values ('event_id', cast(0 as integer), 'bigint'), ('user_id', 1, 'bigint'), ('label', 2, 'string'), ('value', 3, 'double'),
             ('bucket', 4, 'double')) t("column", position, type)""", "dirty_events")



def _smote_sql(view: str, key: str, label: str, feats: list[str], ratio: float, k: int = 5, seed: int = 42) -> str:
    """CTEs up to ``synth``: (k, nk, copy, y, the features) of each synthetic
    row, from all pairs of minority rows."""
    dist = " + ".join(f"(a.f[{i + 1}] - b.f[{i + 1}]) * (a.f[{i + 1}] - b.f[{i + 1}])" for i in range(len(feats)))
    draw = lambda stream, digits: f"('0x' || substr(md5(k || ':' || copy || ':{seed}:{stream}'), 1, {digits}))::bigint"
    return f"""
with cnt as (select {label} as y, count(*) as n from {view} group by 1),
least_ as (select y, n from cnt order by n, y limit 1),
size_ as (select y, n as n_min, cast(floor({ratio} * (select max(n) from cnt)) as bigint) - n as n_new from least_),
m as (select {key} as k, [{', '.join(f'cast({f} as double)' for f in feats)}] as f,
             row_number() over (order by md5(cast({key} as varchar) || ':{seed}')) as rk
      from {view} where {label} = (select y from size_)),
copies as (select k, f, unnest(range(1, cast(n_new // n_min + case when rk <= n_new % n_min then 1 else 0 end as bigint) + 1)) as copy from m, size_),
near as (select a.k, b.k as nk, b.f as g, row_number() over (partition by a.k order by sqrt({dist}), b.k) as nr from m a join m b on a.k <> b.k),
drawn as (select k, f, copy, {draw(1, 8)} % {k} + 1 as pick, {draw(2, 13)} / cast(4503599627370496 as double) as u from copies),
synth as (select d.k, nk, cast(copy as integer) as copy, (select y from size_) as y,
                 {', '.join(f'f[{i + 1}] + u * (g[{i + 1}] - f[{i + 1}]) as {x}' for i, x in enumerate(feats))}
          from drawn d join near n on n.k = d.k and n.nr = d.pick)"""


ORACLE["smote"] = wv(_smote_sql("loans", "loan_id", "not_fully_paid", _KF, 0.5) + f"""
select loan_id, not_fully_paid, {', '.join(f'round(cast({f} as double), 6) as {f}' for f in _KF)}, false as synthetic,
       cast(null as bigint) as source_key, cast(null as bigint) as neighbor_key, cast(null as integer) as copy from loans
union all
select null, y, {', '.join(f'round({f}, 6)' for f in _KF)}, true, k, nk, copy from synth""", "loans")
ORACLE["smote_doc_labels"] = wv(_smote_sql("doc_labels", "doc_id", "quality", ["n_chars", "toxic"], 1.0) + """,
every as (select quality, false as synthetic, cast(n_chars as double) as n_chars from doc_labels union all select y, true, n_chars from synth)
select quality, synthetic, count(*) as count, round(min(n_chars), 6) as min_n_chars, round(max(n_chars), 6) as max_n_chars
from every group by quality, synthetic""", "doc_labels")
ORACLE["csv_scan"] = wv(f"""
select event_id, user_id, case when trim(label) not in {TOKENS} then label end as label, round(value, 6) as value, round(bucket, 6) as bucket,
       cast(null as varchar) as malformed_row from dirty_events""", "dirty_events")
ORACLE["group_density_binned"] = """
with v as (select event_type as g, value from events where event_type is not null and value is not null),
st as (select g, count(*) as n, min(value) as mn, max(value) as mx,
              coalesce(nullif(stddev_samp(value), 0), 1.0) * pow(cast(count(*) as double), -0.2) as h,
              case when max(value) > min(value) then (max(value) - min(value)) / cast(511 as double) else 1.0 end as w from v group by g),
placed as (select v.g, (value - mn) / w as place from v join st on v.g = st.g),
cut as (select g, place, least(cast(floor(place) as integer), 510) as b from placed),
shared as (select g, b, 1 - (place - b) as share from cut union all select g, b + 1, place - b from cut),
grid as (select g, b, sum(share) as share from shared group by g, b),
p as (select g, n, h, mn, w, cast(unnest(range(0, 64)) as integer) as point, (mx - mn) / 63.0 as s from st)
select p.g as event_type, point, round(any_value(mn + point * s), 6) as x,
       round(sum(share * exp(-0.5 * ((mn + b * w - (mn + point * s)) / h) * ((mn + b * w - (mn + point * s)) / h)) / (h * n * sqrt(2 * pi()))), 6) as density
from p join grid on grid.g = p.g group by p.g, point"""
