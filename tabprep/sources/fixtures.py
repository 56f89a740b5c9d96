"""Derived views over the driver tables (see FIXTURES.md).

Each view is built twice: as DataFrame code for the Spark side, and as SQL
text that the DuckDB oracle inlines as a CTE.  Every view is a projection
(or a key join) of a driver table, so its size grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _d(x) -> F.Column:
    return F.lit(x).cast("double")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with placeholder text, padding, case noise and NULLs injected."""
    return dirty_events_of(read_table(spark, sf_dir, "events"))


def dirty_events_of(ev: DataFrame) -> DataFrame:
    """The dirty_events projection of an events DataFrame (batch or stream)."""
    k9 = F.col("event_id") % 9
    label = (F.when(k9 == 0, F.lit("N/A"))
             .when(k9 == 1, F.concat(F.lit("  "), F.col("event_type"), F.lit("  ")))
             .when(k9 == 2, F.lit("unknown"))
             .when(k9 == 3, F.upper("event_type"))
             .when(k9 == 4, F.lit(None).cast("string"))
             .when(k9 == 5, F.concat(F.col("event_type"), F.lit("   mc-x")))
             .when(k9 == 6, F.lit("?"))
             .otherwise(F.col("event_type")))
    return ev.select(
        "event_id", "user_id", label.alias("label"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 != 0, (F.col("user_id") % 10).cast("double")).alias("bucket"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_orderpriority").alias("purpose"),
        ((F.col("o_orderkey") % 101) * _d(1)).alias("revol_util"),
        (F.col("o_custkey") % 9).cast("int").alias("inq_last_6mths"),
        (F.col("o_totalprice") / _d(500)).alias("installment"),
        F.round(F.ln("o_totalprice"), 6).alias("log_annual_inc"),
        (365 + F.col("o_orderkey") % 7000).cast("double").alias("days_with_cr_line"),
        ((F.col("o_custkey") % 300) / _d(10)).alias("dti"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0), 1)
        .otherwise(0).alias("not_fully_paid"))


def loans_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = loans(spark, sf_dir)
    return lo.select(
        "loan_id", "revol_util", "installment", "dti", "not_fully_paid",
        (F.col("revol_util") * _d(2)).alias("revol_dup"),
        (F.col("installment") + (F.col("loan_id") % 50).cast("double")).alias("installment_near"),
        _d(5).alias("constant_col"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(read_table(spark, sf_dir, "events"))


def scored_of(ev: DataFrame) -> DataFrame:
    """The scored projection of an events DataFrame (batch or stream)."""
    hot = F.col("event_type").isin("purchase", "signup")
    return ev.select(
        F.col("event_id").alias("id"),
        F.when(hot & (F.col("event_id") % 3 != 0), 1).otherwise(0).alias("label"),
        F.round(F.least(_d(1), F.col("value") / _d(200) + F.when(hot, _d(0.25)).otherwise(_d(0))), 6)
        .alias("score"))


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        "quality", "toxic")


# SQL text of the same views, for the oracle (DuckDB) side.
SQL = {
    "dirty_events": """
select event_id, user_id,
       case event_id % 9 when 0 then 'N/A' when 1 then concat('  ', event_type, '  ') when 2 then 'unknown'
                         when 3 then upper(event_type) when 4 then null when 5 then concat(event_type, '   mc-x')
                         when 6 then '?' else event_type end as label,
       case when event_id % 5 = 0 then null else value end as value,
       case when event_id % 7 = 0 then null else cast(user_id % 10 as double) end as bucket
from events""",
    "loans": """
select o_orderkey as loan_id, o_orderpriority as purpose,
       (o_orderkey % 101) * cast(1 as double) as revol_util,
       cast(o_custkey % 9 as int) as inq_last_6mths,
       o_totalprice / cast(500 as double) as installment,
       round(ln(o_totalprice), 6) as log_annual_inc,
       cast(365 + (o_orderkey % 7000) as double) as days_with_cr_line,
       (o_custkey % 300) / cast(10 as double) as dti,
       case when o_orderstatus = 'F' and o_orderkey % 2 = 0 then 1 else 0 end as not_fully_paid
from orders""",
    "loans_corr": """
select loan_id, revol_util, installment, dti, not_fully_paid,
       revol_util * cast(2 as double) as revol_dup,
       installment + cast(loan_id % 50 as double) as installment_near,
       cast(5 as double) as constant_col
from loans""",
    "scored": """
select event_id as id,
       case when event_type in ('purchase', 'signup') and event_id % 3 <> 0 then 1 else 0 end as label,
       round(least(cast(1 as double), value / cast(200 as double)
             + case when event_type in ('purchase', 'signup') then cast(0.25 as double) else cast(0 as double) end), 6) as score
from events""",
    "doc_labels": """
select d.doc_id, d.lang, d.source, cast(d.n_chars as double) as n_chars, l.quality, l.toxic
from documents d join labels l on d.doc_id = l.doc_id""",
}

# views a view depends on, in dependency order
_DEPS = {"loans_corr": ["loans"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with CTEs defining ``views`` (and their dependencies)."""
    order: list[str] = []
    for v in views:
        for dep in _DEPS.get(v, []) + [v]:
            if dep not in order:
                order.append(dep)
    ctes = ",\n".join(f"{v} as ({SQL[v]}\n)" for v in order)
    body = sql.lstrip()
    if body[:5].lower() == "with ":
        # the query has CTEs of its own: append them after the views
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
