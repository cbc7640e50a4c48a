"""The managed tables: their columns and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..operators.state import conform


@dataclass(frozen=True)
class ManagedTable:
    columns: str
    keys: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)


# Columns, types and keys of the five managed tables; a time of day is text.
MANAGED = {
    "dashboard_history": ManagedTable(
        "dataset string, runId timestamp_ntz, runDate timestamp, rows bigint, passFail int, passFailLimit int, peak int, "
        "dayOfWeek string, timeZone string, avgRows bigint, cols int, activeRules int, activeAlerts int, runTime string, "
        "shapeScore int, dupeScore int, patternScore int, outlierScore int, schemaScore int, recordScore int, ruleScore int, "
        "sourceScore int, behaviorScore int, DQScore int, jobSchedule boolean, business_unit string, Comment string, "
        "`Data Domain` string, CDE string, Project string, Market string, report_time string",
        ("dataset", "runId"),
    ),
    "global_position": ManagedTable(
        "sector string, dq_capability_material_product decimal(10,2), dq_rules_score_dashboard_material_product decimal(10,2), "
        "dq_capability_hcp decimal(10,2), dq_rules_score_dashboard_hcp decimal(10,2), dq_capability_customer_account decimal(10,2), "
        "dq_rules_score_dashboard_customer_account decimal(10,2), dq_capability decimal(10,2), dq_rules_score_dashboard decimal(10,2)",
        ("sector",),
    ),
    "business_unit_mapping": ManagedTable(
        "dataset string, region string, business_unit string, Market string, Project string, CDE string, jobSchedule boolean, "
        "`Data Domain` string, subDomain string, connectionName string, db_nm string, table_nm string, scheduleTime string, timeZone string",
        ("dataset",),
    ),
    "dataset_definitions": ManagedTable(
        "dataset string, region string, `Run Id` timestamp, `Link Id` string, `Date Filter` boolean, `Date Filter Key` string, "
        "Scheduler boolean, `Scheduled Freq` string, `Scheduled Time` string, col_name string, `Data Type` string, `Row Count` boolean, "
        "`Execution Time` boolean, `Data Type Check` boolean, `Schema Change` boolean, Dupes boolean, `Custom Rules` boolean, "
        "`Null Values` boolean, `Empty Fields` boolean, Uniqueness boolean, Min boolean, Max boolean, Mean boolean, Outliers boolean, "
        "Shapes boolean, Patterns string, `Current Null Pct` decimal(18,6), db_nm string, table_nm string, business_unit string, "
        "Market string, Project string, CDE boolean",
        ("dataset", "col_name"),
    ),
    "custom_rule_details": ManagedTable(
        "dataset string, runId timestamp, ruleNm string, ruleType string, score decimal(18,6), perc decimal(18,6), exception string, "
        "owlId bigint, breakMsg string, assignmentId string, dimId decimal(18,6), dimName string, stale boolean, business_unit string, "
        "Market string, Project string, CDE boolean, jobSchedule boolean, `Data Domain` string, subDomain string, connectionName string, "
        "db_nm string, table_nm string, scheduleTime string, timeZone string, created_ts timestamp_ntz",
        ("dataset", "runId", "ruleNm"),
    ),
}


def managed(df: DataFrame, name: str) -> DataFrame:
    """The frame with exactly the columns of a managed table; evaluating it raises on a null or repeated key."""
    table = MANAGED[name]
    return conform(df, table.schema, table.keys)
