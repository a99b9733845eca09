"""Hot keys, plan shapes and the rules the library keeps for large clusters."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from punctua import session
from punctua.operators import history, joins, keyed, metrics, quality
from punctua.operators.history import with_history
from punctua.operators.medians import exact_medians
from punctua.operators.slices import temporal_slices
from punctua.streaming.congestion import Windows, congestion

PACKAGE = Path(contract.__file__).parent / "punctua"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all flights on one route, carrier and day."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(3000).select(
        i.alias("n"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("O"), i % 7)).alias("origin"),
        F.when(hot, "HUB").otherwise(F.concat(F.lit("D"), i % 5)).alias("dest"),
        F.when(hot, "C0").otherwise(F.concat(F.lit("C"), i % 4)).alias("carrier"),
        F.date_add(F.to_date(F.lit("2024-01-01")), F.when(hot, 10).otherwise(i % 40).cast("int")).alias("flight_date"),
        (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("dep_del15"),
    )


def test_history_with_a_hot_key_equals_brute_force(hot):
    rows = [r.asDict() for r in hot.collect()]
    prior = sum(r["dep_del15"] for r in rows) / len(rows)
    got = {r.n: r for r in with_history(hot).collect()}
    assert len(got) == len(rows)
    for out, keys in (("route_hist_delay_rate", ("origin", "dest")), ("origin_hist_delay_rate", ("origin",)),
                      ("carrier_hist_delay_rate", ("carrier",))):
        days = defaultdict(lambda: defaultdict(list))
        for r in rows:
            days[tuple(r[k] for k in keys)][r["flight_date"]].append(r["dep_del15"])
        for r in rows[::7]:
            before = [y for d, ys in days[tuple(r[k] for k in keys)].items() if d < r["flight_date"] for y in ys]
            assert got[r["n"]][out] == pytest.approx(sum(before) / len(before) if before else prior)


def test_history_aggregates_the_facts_once(spark, hot, tmp_path, monkeypatch):
    """One scan and one Expand give the totals of every entity; the join back scans the facts once."""
    hot.write.parquet(str(tmp_path / "t"))
    written = []
    keep = history.stored
    monkeypatch.setattr(history, "stored", lambda df: written.append(df) or keep(df))
    plan = final_plan(with_history(spark.read.parquet(str(tmp_path / "t"))))
    (totals,) = written
    made = final_plan(totals)
    assert made.count("FileScan") == 1 and made.count("Expand") == 1 and made.count("Exchange") == 1
    assert made.count("partial_sum") == 1
    main = plan.split("Subquery", 1)[0] + plan
    assert plan.count(f"{tmp_path.name}/t]") <= 2 and "Expand" not in main
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rates_as_of_see_only_earlier_days(spark, hot):
    totals = history.entity_days(hot)
    rows = [r.asDict() for r in hot.collect()]
    day0 = min(r["flight_date"] for r in rows)
    asked = spark.createDataFrame(
        [(k, o, d, c, day0 + timedelta(days=n)) for k, (o, d, c, n) in enumerate(
            [("HOT", "HUB", "C0", 10), ("HOT", "HUB", "C0", 11), ("HOT", "HUB", "C0", 400), ("O1", "D1", "C1", 0), ("O1", "D3", "C2", 25),
             ("nowhere", "D1", "C1", 30), ("O1", "D3", "C2", 25)])] + [(90, None, "D1", None, day0 + timedelta(days=30)), (91, "HOT", "HUB", "C0", None)],
        "n int, origin string, dest string, carrier string, flight_date date")
    got = {r["n"]: r for r in history.rates_as_of(asked, totals).collect()}
    assert len(got) == 9
    for q in asked.collect():
        for out, keys in (("route_hist_delay_rate", ("origin", "dest")), ("origin_hist_delay_rate", ("origin",)), ("carrier_hist_delay_rate", ("carrier",))):
            seen = [r["dep_del15"] for r in rows if q["flight_date"] and r["flight_date"] < q["flight_date"] and all(r[k] == q[k] for k in keys)]
            want = sum(seen) / len(seen) if seen else None
            assert got[q["n"]][out] == (want if want is None else pytest.approx(want)), (q, out)
    plan = final_plan(history.rates_as_of(asked, totals))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert history.rates_as_of(asked.limit(0), totals).count() == 0
    assert all(r["origin_hist_delay_rate"] is None for r in history.rates_as_of(asked, history.entity_days(hot.limit(0))).collect())


def test_history_of_flights_equals_their_rates_as_of(hot):
    """A flight served later by its own day has the rate it was trained with."""
    trained = {r["n"]: r for r in with_history(hot).collect()}
    totals = history.entity_days(hot)
    prior = hot.agg(F.avg("dep_del15")).first()[0]
    for r in history.rates_as_of(hot, totals).collect():
        for out in ("route_hist_delay_rate", "origin_hist_delay_rate", "carrier_hist_delay_rate"):
            assert trained[r["n"]][out] == pytest.approx(prior if r[out] is None else r[out])


def test_windows_never_see_raw_rows_without_a_bound(spark, hot):
    """Dedup, metrics and checks of a hot key reduce rows before the shuffle."""
    plans = {
        "first": final_plan(keyed.first_by_key(hot, ["origin"], ["flight_date"])),
        "unique": final_plan(quality.unique(hot, "origin")),
        "rank": final_plan(metrics.ranked_scores(hot.select(
            F.lit("m").alias("name"), (F.col("n") % 10 / 10).alias("p"), F.col("dep_del15").alias("y")))),
    }
    assert all("partial_" in p for p in plans.values())


def test_results_do_not_depend_on_partitioning(spark, hot):
    other = hot.repartition(13, "n")
    for op in (
        lambda d: with_history(d),
        lambda d: exact_medians(d, ["origin"], ["n"]),
        lambda d: temporal_slices(d.select("n", "flight_date"), ["n"]),
        lambda d: keyed.latest_by_key(d, ["carrier"], ["flight_date"]),
        lambda d: joins.key_volume(d, ["origin", "dest"]),
    ):
        a, b = op(hot), op(other)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_slices_sort_no_rows(spark, hot):
    plan = final_plan(temporal_slices(hot.select("n", "flight_date"), ["n"]))
    top = plan.split("Subquery")[0]
    assert "Exchange" not in top and "Sort" not in top


def test_copies_are_dealt_out_where_a_cut_falls_between_them(spark):
    rows = [("2024-01-01", k) for k in range(6000)] + [("2024-01-02", 7)] * 4000
    df = spark.createDataFrame(rows, "d string, k int").select(F.to_date("d").alias("flight_date"), "k")
    counts = {r.slice: r["count"] for r in temporal_slices(df, ["k"]).groupBy("slice").count().collect()}
    assert sum(counts.values()) == 10000
    assert counts["fit"] == pytest.approx(7000, abs=150)
    assert counts["valid"] == pytest.approx(1500, abs=150)


def test_hot_cell(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("icao24"), F.lit(40.0).alias("lat"), F.lit(-100.0).alias("lon"),
        F.lit(10.0).alias("altitude"), F.lit(False).alias("on_ground"),
        F.timestamp_seconds(F.lit(1700000000)).alias("event_time"))
    row = congestion(df, Windows(exact=True)).first()
    assert (row.aircraft_count, row.avg_altitude_m) == (3000, 10.0)


def test_stored_tables_and_checkpoints_use_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.checkpoint_dir(spark) == folder
    table = session.stored(spark.range(5))
    assert table.count() == 5 and all(f.split(":", 1)[1].lstrip("/").startswith(folder.lstrip("/")) for f in table.inputFiles())
    assert session.cut(spark.range(3)).count() == 3


def test_library_rules():
    banned = re.compile(r"localCheckpoint|crossJoin|\.toPandas\(|\.cache\(|\.persist\(|\.rdd\b|F\.udf|pandas_udf")
    actions = re.compile(r"\.collect\(|\.count\(\)|\.first\(|\.take\(|toLocalIterator")
    for path in PACKAGE.rglob("*.py"):
        text = path.read_text()
        assert not banned.search(text), path
        if path.parent.name in ("operators", "functions"):
            assert not actions.search(text), path


def test_every_query_is_known_to_both_sides():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    own = {q for q in queries if not re.match(r"op\d", q) and q != "pipeline"}
    assert own - set(sql) == {"train_and_evaluate", "batch_score"}


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "flight_number_reporting_airline" and df.count() == 6000
