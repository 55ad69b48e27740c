"""Model graph: any order, errors that name models, independent models at once, the whole suite."""

import threading
import time

import pytest

from candlewick.plans import layers
from candlewick.plans.layers import Model
from candlewick.sources import fixtures as fx
from tests.conftest import SF_SMALL


def model(name, *deps, build=None, **kw):
    return Model(name, build or (lambda m: m[deps[0]]), deps, **kw)


def test_generations_and_errors():
    a, b, c, d = model("a", "raw"), model("b", "a"), model("c", "a"), model("d", "c", "b")
    assert [[m.name for m in g] for g in layers.dependency_order([d, b, c, a], ["raw"])] == [["a"], ["b", "c"], ["d"]]
    with pytest.raises(KeyError, match="d needs .'c'"):
        layers.dependency_order([a, b, d], ["raw"])
    with pytest.raises(ValueError, match="cycle: x, y, z, x|cycle: y, z, x, y|cycle: z, x, y, z"):
        layers.dependency_order([a, model("x", "y"), model("y", "z"), model("z", "x"), model("w", "x")], ["raw"])
    with pytest.raises(ValueError, match="twice"):
        layers.dependency_order([a, a], ["raw"])
    with pytest.raises(ValueError, match="cycle: s, s"):
        layers.dependency_order([model("s", "s")], [])


def test_models_in_any_order_give_the_same_marts(spark, tmp_root):
    sources = {"raw.trades": fx.raw_trades(spark, SF_SMALL), "raw.market_meta": fx.market_meta(spark, SF_SMALL)}
    models = layers.reference_models(fx.AS_OF_DATE)
    one = layers.build(spark, sources, models, f"{tmp_root}/one", threads=1)
    two = layers.build(spark, sources, models[::-1], f"{tmp_root}/two")
    for m in models:
        if m.materialized == "table":
            assert sorted(map(str, one[m.name].collect())) == sorted(map(str, two[m.name].collect()))


def test_independent_models_overlap_in_pools_of_their_own(spark, tmp_root):
    """Both builders wait for each other: one after the other they would not end."""
    meet, pools = threading.Barrier(2, timeout=60), {}

    def build(name):
        def f(m):
            meet.wait()
            pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            return m["raw"]
        return f

    models = [model("last", "left", "right", build=lambda m: m["left"].unionByName(m["right"]), materialized="table"),
              model("left", "raw", build=build("left"), materialized="table"),
              model("right", "raw", build=build("right"), materialized="table")]
    built = layers.build(spark, {"raw": spark.range(5)}, models, tmp_root)
    assert built["last"].count() == 10 and pools == {"left": "model-left", "right": "model-right"}


def test_a_failed_model_ends_the_build(spark, tmp_root):
    begun = []

    def slow(m):
        time.sleep(1)
        return m["raw"]

    def bad(m):
        raise RuntimeError("model bad is broken")

    def after(m):
        begun.append("after")
        return m["bad"]

    models = [model("after", "bad", build=after), model("bad", "raw", build=bad), model("slow", "raw", build=slow)]
    with pytest.raises(RuntimeError, match="model bad"):
        layers.build(spark, {"raw": spark.range(1)}, models, tmp_root)
    assert begun == []


def test_the_whole_suite_is_reported(spark, tmp_root):
    got = layers.pipeline_run(spark, fx.raw_trades(spark, SF_SMALL), fx.market_meta(spark, SF_SMALL), fx.AS_OF_DATE,
                              tmp_root, on_failure="report")["test_results"].collect()
    assert len(got) == 16 and {r.run_status for r in got} == {"failed"}
    assert [(r.model, r.column_name) for r in got if r.status == "fail"] == [("int_hourly_aggregates", "vwap")]
