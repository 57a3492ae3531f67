"""Responses, maps and lists made from the test tables, in Spark and in SQL.

A line of an order stands for a response, the order for an activity, the customer
for a student, the part for an item and the order priority for a template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.functions.parts import dealt, parts_of

# With the schema at hand no file has to be opened before the plan is made.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def response_parts(spark: SparkSession, sf_dir: str) -> int | None:
    """The number of parts for the responses, from the row counts in the footers."""
    return parts_of(table(spark, sf_dir, "lineitem").count())


def responses(spark: SparkSession, sf_dir: str, n_parts: int | None = None, **changed: Column) -> DataFrame:
    """The response table, in ``n_parts`` parts if that is given; ``changed`` replaces columns."""
    lines = dealt(table(spark, sf_dir, "lineitem"), n_parts, "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    of_order, of_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    if n_parts is None:
        # orders last: the narrow lines are dealt for parts, and rows end up dealt by activity
        joined = lines.join(parts, of_part).join(orders, of_order)
    else:
        joined = lines.join(orders, of_order).join(parts, of_part)
    order, supplier, part = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey")
    status = F.col("o_orderstatus")
    no_answer = supplier % 17 == 0
    right = F.col("p_size") % 4 + 1
    frame = joined.select(
        F.concat_ws(
            "-",
            _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        ).alias("response_id"),
        _text("o_custkey").alias("student_id"),
        order.alias("activity_id"),
        order.alias("activity_id_hist"),
        F.when(F.col("o_custkey") % 97 != 0, F.col("o_custkey")).alias("enrollment_id"),
        F.when(status == "F", "completed")
        .when(status == "O", "Complete")
        .when(order % 4 == 0, "reset")
        .otherwise("4")
        .alias("activity_status"),
        F.when(order % 11 == 0, "True").when(order % 13 != 0, "False").alias("tutor_mode"),
        F.col("o_orderpriority").alias("template_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("template_id"),
        F.when(F.col("l_returnflag") == "A", "Reading")
        .when(F.col("l_returnflag") == "N", "Writing")
        .otherwise("Math")
        .alias("section_name"),
        F.col("l_linenumber").alias("item_section_position"),
        F.when(part % 211 == 0, F.lit(-1).cast("bigint")).otherwise(part).alias("content_item_id"),
        F.concat(F.lit("item_"), F.lpad(_text("l_partkey"), 6, "0")).alias("content_item_name"),
        F.col("o_orderdate").alias("timestamp_created"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(order % 1500).cast("int"))).alias(
            "timestamp_completed"
        ),
        F.when(order % 501 == 0, F.lit(-1).cast("bigint"))
        .otherwise((F.col("l_quantity") * 1000 + (supplier % 10) * 100).cast("bigint"))
        .alias("milliseconds_used"),
        F.when(~no_answer, supplier % 5).alias("raw_response"),
        F.when(no_answer, F.when((supplier % 34 == 0) & (order % 5 == 0), 1).otherwise(0))
        .when(supplier % 5 == right, 1)
        .otherwise(0)
        .alias("scored_response"),
        F.when((F.col("l_linestatus") == "F") | (F.col("l_linenumber") < 6), 1).otherwise(0).alias("is_scored"),
        right.alias("correct_answer"),
    )
    return frame.withColumns(changed) if changed else frame


RESPONSES_SQL = """
select concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                 cast(round(l.l_extendedprice * 100) as bigint)) as response_id,
  cast(o.o_custkey as varchar) as student_id,
  l.l_orderkey as activity_id, l.l_orderkey as activity_id_hist,
  case when o.o_custkey % 97 = 0 then null else o.o_custkey end as enrollment_id,
  case when o.o_orderstatus = 'F' then 'completed' when o.o_orderstatus = 'O' then 'Complete'
       when l.l_orderkey % 4 = 0 then 'reset' else '4' end as activity_status,
  case when l.l_orderkey % 11 = 0 then 'True' when l.l_orderkey % 13 = 0 then null else 'False' end as tutor_mode,
  o.o_orderpriority as template_name, cast(substr(o.o_orderpriority, 1, 1) as int) as template_id,
  case l.l_returnflag when 'A' then 'Reading' when 'N' then 'Writing' else 'Math' end as section_name,
  l.l_linenumber as item_section_position,
  case when l.l_partkey % 211 = 0 then -1 else l.l_partkey end as content_item_id,
  concat('item_', lpad(cast(l.l_partkey as varchar), 6, '0')) as content_item_name,
  o.o_orderdate as timestamp_created,
  o.o_orderdate + to_minutes(cast(l.l_orderkey % 1500 as int)) as timestamp_completed,
  cast(case when l.l_orderkey % 501 = 0 then -1
       else l.l_quantity * 1000 + (l.l_suppkey % 10) * 100 end as bigint) as milliseconds_used,
  case when l.l_suppkey % 17 = 0 then null else l.l_suppkey % 5 end as raw_response,
  case when l.l_suppkey % 17 = 0
       then case when l.l_suppkey % 34 = 0 and l.l_orderkey % 5 = 0 then 1 else 0 end
       when l.l_suppkey % 5 = p.p_size % 4 + 1 then 1 else 0 end as scored_response,
  case when l.l_linestatus = 'F' or l.l_linenumber < 6 then 1 else 0 end as is_scored,
  p.p_size % 4 + 1 as correct_answer
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey
"""


def with_responses(body: str, **changed: str) -> str:
    """SQL that reads ``responses``; ``changed`` replaces columns of it."""
    source = RESPONSES_SQL
    if changed:
        replaced = ", ".join(f"{sql} as {column}" for column, sql in changed.items())
        kept = ", ".join(changed)
        source = f"select * exclude ({kept}), {replaced} from ({RESPONSES_SQL}) base"
    joint = ", " if body.lstrip().startswith("with ") else " "
    rest = body.lstrip()[len("with ") :] if joint == ", " else body
    return f"with responses as ({source}){joint}{rest}"


# Maps -------------------------------------------------------------------------


def test_map(
    spark: SparkSession, sf_dir: str, num_ques: int | None = 8, minutes: float = 1440.0
) -> DataFrame:
    """One row per template; without a number, templates expect 4 to 8 questions."""
    templates = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("template_name")).distinct()
    by_template = F.substring("template_name", 1, 1).cast("int") + 3
    return templates.select(
        "template_name",
        (by_template if num_ques is None else F.lit(num_ques)).alias("num_ques"),
        F.lit(0.25).alias("response_threshold"),
        F.lit(minutes).alias("minutes_allowed"),
    )


def test_map_sql(num_ques: int | None = 8) -> str:
    number = "cast(substr(o_orderpriority, 1, 1) as int) + 3" if num_ques is None else str(num_ques)
    return (
        f"(select distinct o_orderpriority as template_name, {number} as num_ques, "
        "0.25::double as response_threshold, 1440.0::double as minutes_allowed from orders)"
    )


def bank_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row of a question bank: as many questions as the largest template."""
    return test_map(spark, sf_dir, None).agg(
        F.max("num_ques").alias("num_ques"),
        F.max("response_threshold").alias("response_threshold"),
        F.max("minutes_allowed").alias("minutes_allowed"),
    )


SECTIONS_SQL = """(select distinct case l_returnflag when 'A' then 'Reading' when 'N' then 'Writing'
  else 'Math' end as section_name,
  case l_returnflag when 'A' then 4 when 'N' then 5 else 3 end as section_num_ques,
  0.25::double as section_response_threshold, 1 as min_items_per_seq,
  3.0::double as minutes_allowed, 0.3::double as response_threshold from lineitem)"""


def section_map(spark: SparkSession, sf_dir: str, min_items: bool = True) -> DataFrame:
    flag = F.col("l_returnflag")
    sections = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct().select(
        F.when(flag == "A", "Reading").when(flag == "N", "Writing").otherwise("Math").alias("section_name"),
        F.when(flag == "A", 4).when(flag == "N", 5).otherwise(3).alias("section_num_ques"),
        F.lit(0.25).alias("section_response_threshold"),
        F.lit(1).alias("min_items_per_seq"),
        F.lit(3.0).alias("minutes_allowed"),
        F.lit(0.3).alias("response_threshold"),
    )
    return sections if min_items else sections.drop("min_items_per_seq")


def content_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(key % 211 == 0, F.lit(-1).cast("bigint")).otherwise(key).alias("content_item_id"),
        F.concat(F.lit("item_"), F.lpad(key.cast("string"), 6, "0")).alias("content_item_name"),
        (F.col("p_size") % 5 + 1).alias("template_id"),
        F.col("p_brand").alias("brand"),
        (F.col("p_size") % 12).alias("interaction_type_id"),
    )


CONTENT_SQL = """(select case when p_partkey % 211 = 0 then -1 else p_partkey end as content_item_id,
  concat('item_', lpad(cast(p_partkey as varchar), 6, '0')) as content_item_name,
  p_size % 5 + 1 as template_id, p_brand as brand, p_size % 12 as interaction_type_id from part)"""
