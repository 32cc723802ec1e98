"""How payloads are built and opened: each in one step, with the values that their text reads as."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from devtide.functions.payload import opened
from devtide.plans.raw_binding import _payload


def plan_of(df) -> str:
    told = io.StringIO()
    with redirect_stdout(told):
        df.explain("simple")
    return told.getvalue()


def test_a_payload_is_what_its_text_reads_as(spark):
    rows = spark.sql(
        "SELECT 1 AS n, 'a\"b\\n' AS t, CAST(NULL AS STRING) AS none, true AS yes, '' AS blank "
        "UNION ALL SELECT 5000000000, NULL, 'x', false, 'null'"
    )
    fields = F.struct("n", "t", "none", "yes", F.struct("blank", "none").alias("inner"))
    text = F.parse_json(F.to_json(fields, {"ignoreNullFields": "false"}))
    built = rows.select(_payload(fields).alias("built"), text.alias("text"))
    for row in built.select(
        *[F.to_json(c).alias(c) for c in ("built", "text")],
        *[F.schema_of_variant(c).alias(f"{c}_type") for c in ("built", "text")],
    ).collect():
        assert row["built"] == row["text"]
        assert row["built_type"] == row["text_type"]


def test_a_payload_is_built_without_writing_its_text(spark, tmp_path):
    from devtide.plans.raw_binding import raw_reviews

    lines = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    )
    layouts = {
        "lineitem": lines,
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
        "customer": "c_custkey bigint, c_nationkey int",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
    }
    for name, layout in layouts.items():
        spark.createDataFrame([], layout).write.parquet(str(tmp_path / f"{name}.parquet"))
    data = raw_reviews(spark, str(tmp_path)).select("data")
    assert "to_variant_object" in plan_of(data)
    assert "parseJson" not in plan_of(data)


def test_an_object_below_is_looked_at_once(spark):
    rows = spark.sql(
        """SELECT parse_json('{"a": {"b": {"c": 1, "d": "x", "e": null}, "f": "y"}, "g": 2}') AS data
        UNION ALL SELECT parse_json('{"a": {"b": 3}}') UNION ALL SELECT parse_json('[1]')"""
    ).localCheckpoint()
    wanted = {"a.b.c": "bigint", "a.b.d": "string", "a.b.e": "string", "a.f": "string", "g": "bigint"}
    found = rows.select(opened(F.col("data"), wanted).alias("o"))
    apart = rows.select(
        *[F.try_variant_get("data", f"$.{p}", k).alias(p.replace(".", "_")) for p, k in wanted.items()]
    )
    values = found.select(*[F.col(f"o.{p}").alias(p.replace(".", "_")) for p in wanted])
    assert values.collect() == apart.collect()
    # Not by the path of each value.
    assert "$.a.b" in plan_of(found) and "$.a.b.c" not in plan_of(found)


def test_commits_are_dealt_out_before_their_payloads_are_built(spark, tmp_path):
    from devtide.plans.raw_binding import raw_commits

    layouts = {
        "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
    }
    for name, layout in layouts.items():
        spark.createDataFrame([], layout).write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = plan_of(raw_commits(spark, str(tmp_path)))
    built, dealt = plan.index("to_variant_object"), plan.index("Exchange hashpartitioning(seq")
    assert built < dealt < plan.index("FileScan")
