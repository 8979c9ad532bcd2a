"""Component lead reconciliation over the project's components."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmill.operators.components import reconcile_components
from histmill.plans.registry import query
from histmill.sources.files import component_leads, project_components as components_of
from histmill.sources.tables import read_table

# a component -> lead list as it arrives in the two-column text file (invented names)
LEAD_LINES = ["ECONOMY,alice", "SMALL,", "MEDIUM,bob", "MEDIUM,carol", "PROMO,0", "GIANT,dave",
              "just text without a comma", "A,B,C", ",erin"]


def lead_lines(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(LEAD_LINES)], "line_no long, value string")


def _values(rows):
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


@query("component_reconcile", oracle=f"""
with lines(line_no, value) as (values {_values(list(enumerate(LEAD_LINES)))}),
leads as (
  select regexp_extract(value, '^([^,]*),([^,\\n]*)$', 1) as name,
    arg_max(regexp_extract(value, '^([^,]*),([^,\\n]*)$', 2), line_no) as lead
  from lines where regexp_matches(value, '^([^,]*),([^,\\n]*)$') group by 1),
comps as (select cast(min(p_partkey) as varchar) as id, p_type as name from part group by p_type)
select c.id as ComponentId, coalesce(c.name, l.name) as ComponentName,
  case when c.id is null then '' when l.name is not null then l.lead else 'not specified' end as Assignee,
  case when c.id is null then 'Not Found' when l.name is not null and l.lead is not null and l.lead not in ('', '0')
       then 'to_update' else 'no change' end as Result,
  case when c.id is not null and l.name is not null and l.lead is not null and l.lead not in ('', '0')
       then '{{"leadUserName":"' || l.lead || '","assigneeType":"COMPONENT_LEAD"}}' end as payload
from comps c full outer join leads l on l.name = c.name""")
def component_reconcile(spark, sf):
    """JN12 + SRC2 + SRC3 + SC25 + SNK7: project components (one per part type, id = lowest
    part key, in id order) reconciled with a component -> lead list."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_type"])
    comps = part.groupBy(F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("_k")).select(
        F.col("_k").cast("string").alias("id"), "name", F.col("_k").alias("pos"))
    return reconcile_components(comps, component_leads(lead_lines(spark)))


def project_documents(spark, sf):
    """One project document per brand, as text, with members that vary: an id that is a number, a
    text or missing, a lead that only some components have, and brands without components."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_size", "p_brand"])
    kind = F.col("p_size") % 4
    number = F.when(kind == 0, F.concat(F.lit('"id":'), F.col("p_partkey"), F.lit(","))).when(
        kind == 1, F.concat(F.lit('"id":"c'), F.col("p_partkey"), F.lit('",'))).otherwise("")
    lead = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(',"lead":{"name":"lead'), F.col("p_size"), F.lit('"}'))).otherwise("")
    body = F.concat(F.lit("{"), number, F.lit('"name":"'), F.col("p_type"), F.lit('"'), lead, F.lit("}"))
    text = part.select("p_brand", "p_partkey", body.alias("body")).groupBy("p_brand").agg(
        F.expr("listagg(body, ',') within group (order by p_partkey)").alias("all"))
    last = F.right("p_brand", F.lit(1))
    return text.select(F.when(last == "7", F.concat(F.lit('{"key":"'), F.col("p_brand"), F.lit('","lead":[]}')))
                       .otherwise(F.concat(F.lit('{"components":['), F.col("all"), F.lit('],"key":"'), F.col("p_brand"),
                                           F.lit('"}'))).alias("value"))


@query("project_components", oracle="""
select p_brand as key, cast(row_number() over (partition by p_brand order by p_partkey) - 1 as integer) as pos,
  case p_size % 4 when 0 then cast(p_partkey as varchar) when 1 then 'c' || cast(p_partkey as varchar) end as id,
  p_type as name, case when p_size % 3 = 0 then 'lead' || cast(p_size as varchar) end as lead
from part where right(p_brand, 1) <> '7'""")
def project_components(spark, sf):
    """SRC3: components of JSON documents whose members vary, through VARIANT."""
    return components_of(project_documents(spark, sf), members={"id": "string", "name": "string", "lead.name": "string"}) \
        .withColumnRenamed("lead.name", "lead")
