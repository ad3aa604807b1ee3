"""Sources, sinks, views and the catalogue run."""
import pytest

from lotwise.plans import registry
from lotwise.sources import io

SF = "/root/testdata/sf0.001"


def test_csv_and_json_reports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'say "x"'), (3, None)], "id int, note string")
    io.write_csv_report(df, str(tmp_path / "r.csv"))
    assert sorted(tuple(r) for r in io.read_table(spark, str(tmp_path / "r.csv"))
                  .selectExpr("cast(id as int)", "note").collect())[:2] == [(1, "a,b"), (2, 'say "x"')]
    io.write_json_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 3


def test_views_are_registered_in_order(spark):
    tables = {"v_one": spark.range(3), "v_two": spark.range(5)}
    assert io.register_views(spark, tables) == ["v_one", "v_two"]
    assert spark.sql("select count(*) from v_one join v_two using (id)").first()[0] == 3


def test_catalogue_run_writes_counts_and_fails_on_violations(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(registry.REGISTRY, "bad_rows", lambda s, d: s.range(2))
    names = ["K13_position_bias", "bad_rows"]
    out = {r["query"]: r for r in registry.run_all(spark, SF, str(tmp_path), names).collect()}
    assert out["bad_rows"]["rows"] == 2 and out["K13_position_bias"]["columns"] == 5
    written = spark.read.option("header", True).csv(str(tmp_path / "K13_position_bias"))
    assert written.count() == out["K13_position_bias"]["rows"]
    with pytest.raises(RuntimeError, match="bad_rows"):
        registry.run_all(spark, SF, names=names, checks=("bad_rows",))


def test_named_query_with_limit(spark):
    assert registry.run_query(spark, SF, "K13_position_bias", 2).count() == 2
    with pytest.raises(KeyError):
        registry.run_query(spark, SF, "drop_table")


def test_missing_baseline_fails_its_gate(spark):
    from lotwise.plans.drift import quality_gates
    metrics = spark.createDataFrame([("ranking", "ndcg_at_10", 0.9)],
                                    "model string, metric_name string, metric_value double")
    gates = {r["gate"]: r["passed"] for r in quality_gates(metrics).collect()}
    assert gates["ranking_ndcg_at_10"] is True
    assert gates["ranking_session_baseline_degradation"] is False
