"""Component lead reconciliation (JN12, SC25, SNK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.functions.text import truthy

# ---- fixed values: report texts and update payload --------------------------
NOT_SPECIFIED = "not specified"
TO_UPDATE = "to_update"   # the original sent the update here and reported "success"
NO_CHANGE = "no change"
NOT_FOUND = "Not Found"
ASSIGNEE_TYPE = "COMPONENT_LEAD"
# ------------------------------------------------------------------------------


def reconcile_components(components: DataFrame, leads: DataFrame) -> DataFrame:
    """Project components (id, name, pos) against leads (name, lead).

    A lead is consumed by the first project component with its name (in project
    order); unconsumed leads are reported as not found. Returns the report
    columns plus the JSON update payload of components to update.
    """
    firsts = components.groupBy(F.col("name").alias("_fname")).agg(F.min("pos").alias("_first_pos"))
    comps = (components.join(firsts, F.col("name") == F.col("_fname"))
             .withColumn("_occ", F.when(F.col("pos") == F.col("_first_pos"), 1).otherwise(2))
             .drop("_fname", "_first_pos"))
    l = leads.select(F.col("name").alias("_lname"), "lead", F.lit(1).alias("_occ_l"))
    j = comps.join(l, (F.col("name") == F.col("_lname")) & (F.col("_occ") == F.col("_occ_l")), "full_outer")
    in_project, matched = F.col("id").isNotNull(), F.col("_lname").isNotNull()
    result = (F.when(~in_project, F.lit(NOT_FOUND))
              .when(matched & truthy(F.col("lead")), F.lit(TO_UPDATE))
              .otherwise(F.lit(NO_CHANGE)))
    assignee = (F.when(~in_project, F.lit(""))
                .when(matched, F.col("lead")).otherwise(F.lit(NOT_SPECIFIED)))
    payload = F.when(result == TO_UPDATE, F.to_json(F.struct(F.col("lead").alias("leadUserName"),
                                                             F.lit(ASSIGNEE_TYPE).alias("assigneeType"))))
    return j.select(F.col("id").alias("ComponentId"), F.coalesce("name", "_lname").alias("ComponentName"),
                    assignee.alias("Assignee"), result.alias("Result"), payload.alias("payload"))
