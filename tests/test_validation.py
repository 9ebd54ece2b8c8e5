"""Statistics computed by a database stand for a scan of its rows."""

from dataclasses import replace

from pyspark.sql import functions as F

from haulage.operators import masking, validation
from haulage.operators.validation import Sides
from haulage.plans.copies import RdbmsCopy
from haulage.sources import jdbc, rdbms
from tests import standin
from tests.test_runs import asked  # noqa: F401


def test_pushed_statistics_give_the_same_verdicts(spark, asked):  # noqa: F811
    orders = spark.table("s_orders")
    hidden = masking.masked_projection(orders, ["o_orderstatus"], "s")
    for landed, masked in (
        (orders, hidden),
        (orders.withColumn("o_totalprice", F.least("o_totalprice", F.lit(9.0))), hidden),
        (orders.limit(99), hidden),
        (orders, hidden.filter("o_custkey > 20")),
    ):
        landed.createOrReplaceTempView("t_landed")
        masked.createOrReplaceTempView("t_masked")
        stats = lambda name, df: jdbc.table_statistics(spark, standin.SOURCE, f"`{name}`", df.schema, orders.columns)  # noqa: E731, B023
        scanned = Sides("t", orders, landed, masked, ["o_orderstatus"])
        pushed = Sides(
            "t", orders, landed, masked, ["o_orderstatus"], stats("s_orders", orders), stats("t_landed", landed), stats("t_masked", masked)
        )
        for check in (
            validation.validate_counts, validation.validate_columns, validation.validate_minmax,
            validation.masked_minmax, validation.validation_status,
        ):
            assert check([pushed]).collect() == check([scanned]).collect(), check.__name__


def test_staged_chunks_are_read_by_a_task_each(spark, asked, monkeypatch):  # noqa: F811
    spark.range(90).selectExpr("id", "CAST(id % 3 AS INT) AS ITERATION").createOrReplaceTempView("T_STAGE")
    for name in ("range_frame", "table_frame"):
        monkeypatch.setattr(rdbms, name, getattr(jdbc, name))
    target = rdbms.RdbmsTarget(spark, standin.SOURCE, "T")
    some = target.staged([0, 2])
    assert some.rdd.getNumPartitions() == 2 and some.columns == ["id", "iteration"]
    assert {r["iteration"]: r["count"] for r in some.groupBy("iteration").count().collect()} == {0: 30, 2: 30}
    assert target.staged().count() == 90
    asked.clear()
    assert target.statistics(some.schema, ["id"]).first()["n_rows"] == 90 and len(asked) == 1


def test_text_kept_as_large_objects_is_scanned(spark, asked):  # noqa: F811
    schema = spark.table("s_orders").schema
    for vendor, pushed in (("mysql", True), ("derby", False), ("ibm", False)):
        copy = RdbmsCopy(spark, replace(standin.SOURCE, vendor=vendor), "s_orders", schema)
        copy.target.stage = "`s_orders`"
        assert (copy.statistics(["o_orderkey"]) is not None) == pushed
        numbers = RdbmsCopy(spark, replace(standin.SOURCE, vendor="mysql"), "s_orders", schema[:1])
        numbers.target.stage = "`s_orders`"
        assert numbers.statistics(["o_orderkey"]).first()["n_rows"] == 1500
