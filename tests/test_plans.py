"""Plan shape of every query of the relational part: no window over
a hot key, no all-pairs join, no Python evaluation in any plan that it runs."""

import json
import re
from pathlib import Path

from panelrisk.plans import catalog as C
from panelrisk.plans.catalog import QUERIES
from panelrisk.session import shared_path
from panelrisk.sources import lake

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def _hits(plan: str) -> list[str]:
    return [op for op in FORBIDDEN if re.search(rf"(^|[\s+\-:(]){op}\b", plan, re.M)]


def _executed_plans(spark):
    """Physical plans of all SQL executions so far, by their description: eager
    writes, statistics and fits as well as the frame that a query returns.
    Read from the event log in one pass, adaptive re-plans included."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    folder = Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://"))
    log = next(p for p in folder.iterdir() if p.name.startswith(spark.sparkContext.applicationId))
    plans, owner = {}, {}
    with open(log, encoding="utf-8") as lines:
        for line in lines:
            if "org.apache.spark.sql.execution.ui.SparkListenerSQL" not in line[:120] or "physicalPlanD" not in line:
                continue
            e = json.loads(line)
            name = owner.setdefault(e["executionId"], e.get("description"))
            plans.setdefault(name, []).append(e["physicalPlanDescription"])
    return plans


def _run_described(spark, name, run):
    spark.sparkContext.setJobDescription(name)
    try:
        run().write.format("noop").mode("overwrite").save()
    finally:
        spark.sparkContext.setJobDescription(None)


def test_no_forbidden_operators_in_any_plan(spark):
    bad = {}
    for name, q in sorted(QUERIES.items()):
        _run_described(spark, f"plan of {name}", lambda: q(spark, SF))
    seen = _executed_plans(spark)
    for name in sorted(QUERIES):
        plans = seen[f"plan of {name}"]
        if hits := sorted({h for p in plans for h in _hits(p)}):
            bad[name] = hits
    assert not bad, bad


def test_planted_cross_join_in_a_staging_step_is_seen(spark):
    def planted():
        a, b = spark.range(3), spark.range(4).withColumnRenamed("id", "other")
        return lake.roundtrip(a.crossJoin(b), shared_path(spark, "t", "planted"))

    _run_described(spark, "planted", planted)
    assert any(_hits(p) for p in _executed_plans(spark)["planted"])


def test_small_covariates_leave_the_panel_where_it_is(spark):
    """Landed covariates are broadcast when planned: no exchange on (entity, year)."""
    plan = C.joined_panel(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(translated_location", plan), plan


def test_panel_scan_prunes_columns(spark):
    df = C.joined_panel(spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    blocks = [b for b in text.split("\n\n") if "Scan parquet" in b and "orders.parquet" in b]
    assert blocks
    for b in blocks:
        schema = re.search(r"ReadSchema: struct<([^>]*)>", b).group(1)
        # orders has 9 columns; the panel reads 6 (never comment, clerk,
        # ship priority)
        assert "o_comment" not in schema and "o_clerk" not in schema, schema
        assert "IsNotNull(o_custkey)" in b.split("PushedFilters:")[1], b
