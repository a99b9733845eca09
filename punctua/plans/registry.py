"""Named queries over the test tables, one or more per operator.

Each callable takes (spark, folder) and reads whole tables.  Nested results are
flattened here, and only here, so that another engine can compute the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.contract import (
    CATEGORICAL,
    GOLD_COLUMNS,
    LABEL,
    SILVER_FLIGHT_COLUMNS,
    WEATHER_FILL,
)
from punctua.functions import geo, holidays, scores, timeparts
from punctua.operators import history, joins, keyed, medians, metrics, quality, slices
from punctua.plans import driver_tables as t, gold, learn, marts, serving
from punctua.plans.silver import staged_flights
from punctua.session import checkpoint_dir, stored
from punctua.sources import airports as airport_source, documents, maintain, tables
from punctua.streaming import latest
from punctua.streaming.congestion import Windows, as_messages, congestion, parse_messages, positions_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# End of the month the events cover, in epoch seconds.
NOW = 1706659200
FLIGHT = "flight_number_reporting_airline"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _millionths(rate: Column) -> Column:
    return F.round(rate * 1000000, 0).cast("bigint")


def _plain(ts: str) -> Column:
    return F.col(ts).cast("timestamp_ntz").alias(ts)


# --- silver and staging -----------------------------------------------------------


@query
def silver_flights(spark, d):
    return t.flights(spark, d).withColumn("flight_ts", _plain("flight_ts"))


@query
def stg_flights(spark, d):
    return t.staged(spark, d)


@query
def dim_airports(spark, d):
    return marts.dim_airports(t.airports(spark, d))


@query
def dedup_weather(spark, d):
    return t.weather(spark, d).withColumn("weather_ts", _plain("weather_ts"))


@query
def valid_airports_semi(spark, d):
    """Requests between known airports; every twenty-seventh origin has none."""
    asked = t.requests(spark, d).withColumns({c: F.upper(c) for c in ("origin", "dest")})
    kept = joins.keep_known(asked, t.airports(spark, d), ["origin", "dest"], "iata")
    return kept.select("request_id", "origin", "dest")


@query
def enforce_schema(spark, d):
    raw = t.table(spark, d, "lineitem").select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.when(F.col("l_linenumber") == 1, "n/a")
        .otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")))
        .alias("distance"),
        F.col("l_discount").cast("string").alias("carrier_delay"),
        F.when(F.col("l_tax") > 0.05, "late").otherwise(F.col("l_linenumber").cast("string")).alias(
            "dep_del15"
        ),
    )
    types = {"distance": "bigint", "carrier_delay": "double", "dep_del15": "bigint"}
    return tables.enforce_types(raw, types)


@query
def union_by_name_missing(spark, d):
    s = t.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal")
    )
    c = t.table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("id"),
    )
    return tables.union_by_name([s, c])


@query
def pending_partitions(spark, d):
    """Days on which a nation ordered but shipped nothing."""
    nation = t.bronze_airports(spark, d).select("iata")
    orders = t.requests(spark, d).select(F.upper("dest").alias("iata"), "flight_date")
    stored = t.flights(spark, d).select(F.col("origin").alias("iata"), "flight_date")
    wanted = joins.keep_known(orders, nation, ["iata"], "iata")
    return maintain.pending_partitions(wanted, stored, ["iata", "flight_date"])


@query
def dim_patch(spark, d):
    """A patch of known codes, which change nothing, and of as many new ones."""
    dim = t.airports(spark, d).select("iata", "name", "lat", "lon")
    codes = F.explode(F.array("iata", F.concat(F.lit("X "), "iata"))).alias("iata")
    patch = dim.select(codes, "lat", "lon").select("iata", F.concat(F.lit("Patched "), "iata").alias("name"), "lat", "lon")
    return airport_source.append_absent(dim, patch)


# --- scalar functions ----------------------------------------------------------------


@query
def holiday_window(spark, d):
    days = t.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return days.withColumn("is_holiday_window", holidays.holiday_flag("day", *t.HOLIDAYS))


@query
def calendar_parts(spark, d):
    ts = F.col("ts").cast("timestamp")
    day = F.to_date(ts)
    return t.table(spark, d, "events").select(
        "event_id",
        timeparts.iso_weekday(day).alias("day_of_week"),
        F.month(day).alias("month"),
        timeparts.day_part(F.hour(ts)).alias("time_of_day_bucket"),
        timeparts.hour_key_of(ts).alias("hour_key"),
        timeparts.epoch_day(day).alias("day_num"),
        timeparts.stale_seconds(F.unix_seconds(ts), F.lit(NOW)).alias("stale_seconds"),
    )


@query
def weather_hour_utc(spark, d):
    """Hour keys of local departures, shifted by the zone of the airport."""
    zone = F.when(F.col("n_nationkey") % 2 == 0, "America/Denver").otherwise("Asia/Tokyo")
    places = t.table(spark, d, "nation").select(F.col("n_name").alias("origin"), zone.alias("zone"))
    rows = t.flights(spark, d).join(places, "origin")
    key = timeparts.hour_key_utc(F.col("flight_date"), F.col("dep_hour"), F.col("zone"))
    return rows.groupBy("origin", key.alias("hour_key")).agg(F.count("*").alias("flights"))


@query
def risk_band(spark, d):
    p = F.col("p")
    return (
        t.scores(spark, d)
        .select(
            scores.round6(p).alias("p"),
            scores.risk_band(p).alias("band"),
            scores.bin_index(p, 10).alias("bin"),
        )
        .groupBy("p", "band", "bin")
        .agg(F.count("*").alias("n"))
    )


@query
def haversine(spark, d):
    routes = marts.route_reliability(t.staged(spark, d)).select("origin", "dest")
    dim = t.airports(spark, d)
    o = dim.select(F.col("iata").alias("origin"), F.col("lat").alias("a"), F.col("lon").alias("b"))
    e = dim.select(F.col("iata").alias("dest"), F.col("lat").alias("x"), F.col("lon").alias("y"))
    miles = geo.haversine_miles(*[F.col(c) for c in "abxy"])
    return (
        routes.join(o, "origin")
        .join(e, "dest")
        .select(
            "origin",
            "dest",
            F.round(miles, 3).alias("miles"),
            scores.elapsed_estimate(F.round(miles, 0)).alias("minutes"),
        )
    )


@query
def bbox_filter(spark, d):
    rows = t.positions(spark, d)
    return rows.where(geo.in_box(F.col("lat"), F.col("lon"))).select("event_id", "lat", "lon")


@query
def geo_cell(spark, d):
    return (
        t.positions(spark, d)
        .groupBy(
            geo.cell(F.col("lat"), 0.5).alias("cell_lat"),
            geo.cell(F.col("lon"), 0.5).alias("cell_lon"),
        )
        .agg(F.count("*").alias("n"))
    )


@query
def top_factors(spark, d):
    entries = [
        ("discount", F.col("l_discount"), (F.col("l_discount") - 0.05) * 50),
        ("tax", F.col("l_tax"), (F.col("l_tax") - 0.04) * 50),
        ("quantity", F.col("l_quantity"), (F.col("l_quantity") - 25) / 10),
        ("price", F.col("l_extendedprice"), (F.lit(50000.0) - F.col("l_extendedprice")) / 10000),
    ]
    rows = t.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.posexplode(scores.top_factors(entries, 3)).alias("rank", "f"),
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "rank",
        F.col("f.feature").alias("feature"),
        F.col("f.contribution").alias("contribution"),
        F.col("f.direction").alias("direction"),
    )


# --- documents and messages --------------------------------------------------------------


@query
def json_hourly_explode(spark, d):
    """A three-hour document per event, with one short and two missing series."""
    ts = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    stamps = F.array(
        *[F.date_format(ts + F.expr(f"interval {h} hours"), "yyyy-MM-dd'T'HH:mm") for h in range(3)]
    )
    hourly = F.struct(
        stamps.alias("time"),
        F.array("value", F.col("value") + 1, F.lit(None).cast("double")).alias("temperature_2m"),
        F.array(F.col("value") / 2).alias("precipitation"),
        F.array(*[F.lit(float(k)) for k in range(3)]).alias("snowfall"),
    )
    docs = t.table(spark, d, "events").select(
        "event_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("doc")
    )
    rows = documents.parse_hourly_weather(docs, keys=("event_id",))
    return rows.withColumn("time", _plain("time"))


@query
def state_vector_parse(spark, d):
    """A snapshot document per event: one aircraft, one without position, one short."""
    p = t.positions(spark, d)
    lead = F.concat(F.lit('["'), "icao24", F.lit('", "'), "callsign", F.lit('", "US", 1, 2, '))
    where = F.concat_ws(", ", F.col("lon").cast("string"), F.col("lat").cast("string"))
    ground = F.col("on_ground").cast("string")
    full = F.concat(
        lead,
        where,
        F.lit(", 100.5, "),
        ground,
        F.lit(", 7.5, 90.0, null, null, "),
        F.when(F.col("on_ground"), "null").otherwise(F.col("altitude").cast("string")),
        F.lit(", null, false, 0]"),
    )
    lost = F.concat(lead, F.lit("null, null, 1.0, false]"))
    short = F.concat(F.lit('["x", "  ", "US", 1, 2, '), where, F.lit("]"))
    doc = F.concat(
        F.lit('{"time": '),
        F.col("event_ts").cast("string"),
        F.lit(', "states": ['),
        F.concat_ws(", ", full, lost, short),
        F.lit("]}"),
    )
    return documents.parse_state_vectors(
        p.select("event_id", doc.alias("doc")), keys=("event_id",)
    )


@query
def snapshot_payload(spark, d):
    p = t.positions(spark, d)
    entry = F.struct(*documents.AIRCRAFT_FIELDS, F.lit("internal").alias("squawk"))
    snaps = p.select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("event_ts")).alias("as_of"),
        F.when(F.col("on_ground"), F.array(entry)).otherwise(F.array(entry, entry)).alias(
            "aircraft"
        ),
    )
    out = documents.snapshot_payload(snaps, F.lit(NOW))
    first = F.col("aircraft")[0]
    return out.select(
        "event_id",
        "as_of",
        "stale_seconds",
        "source",
        "count",
        F.size(F.json_object_keys(F.to_json(first, {"ignoreNullFields": "false"}))).alias("fields"),
        first["lat"].alias("lat"),
        first["on_ground"].alias("on_ground"),
    )


@query
def event_messages(spark, d):
    """Messages out, and back in through the stream parser; keys may be missing."""
    p = t.positions(spark, d).withColumn(
        "icao24", F.when(F.col("event_id") % 11 != 0, F.col("icao24"))
    )
    sent = documents.event_messages(p)
    back = positions_of(parse_messages(sent))
    return back.select(
        F.col("message_key"),
        "icao24",
        "callsign",
        "lat",
        "lon",
        "altitude",
        "on_ground",
        "event_ts",
    )


def _windowed(spark, d, windows: Windows) -> DataFrame:
    rows = t.positions(spark, d).withColumn("event_time", timeparts.event_time(F.col("event_ts")))
    out = congestion(rows, windows)
    return out.select(
        _plain("window_start"), _plain("window_end"), *[c for c in out.columns if "window" not in c]
    )


@query
def congestion_windows(spark, d):
    return _windowed(spark, d, Windows("2 minutes", exact=True))


@query
def congestion_sliding(spark, d):
    return _windowed(spark, d, Windows("6 hours", "3 hours", cell_degrees=10.0, min_count=3, exact=True))


@query
def keyed_json(spark, d):
    rows = t.positions(spark, d).where(~F.col("on_ground")).withColumn(
        "event_time", timeparts.event_time(F.col("event_ts"))
    )
    grouped = congestion(rows, Windows("1 day", cell_degrees=2.0, exact=True))
    return as_messages(
        grouped.withColumns(
            {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
        )
    )


@query
def latest_per_key(spark, d):
    rows = t.positions(spark, d).drop("callsign")
    return keyed.latest_by_key(rows, ["icao24"], ["event_ts", "event_id"])


@query
def latest_with_ttls(spark, d):
    """Positions committed in four batches of two runs, with a compaction in between, then told by age."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/latest/{uuid.uuid4().hex}"
    rows = t.positions(spark, d).drop("callsign")
    order = ["event_ts", "event_id"]
    for n in range(4):
        part = rows.where(F.pmod(F.col("event_id"), F.lit(4)) == n)
        latest.store_batch(part, n % 2, path, "icao24", order, run=f"run{n // 2}")
        if n == 2:
            latest.compact(spark, path, "icao24", order)
    now = rows.agg(F.max("event_ts")).scalar()
    return latest.with_ttls(latest.read_latest(spark, path, "icao24", order), now)


@query
def positions_fallback(spark, d):
    """Snapshots of each sender in three tiers with their times to live."""
    p = t.positions(spark, d).withColumn("inside", geo.in_box(F.col("lat"), F.col("lon")))
    seen = p.groupBy(F.col("icao24").alias("feed")).agg(
        F.max("event_ts").alias("newest"),
        F.min("event_ts").alias("oldest"),
        F.count_if(F.col("inside") & ~F.col("on_ground")).alias("n"),
        F.count_if(F.col("inside") & (F.col("event_ts") >= NOW - 86400)).alias("recent"),
        F.count_if(F.col("inside") & (F.col("event_ts") >= NOW - 3600)).alias("now"),
    )
    tiers = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(tier).alias("tier"), F.col(at).alias("as_of"), F.col(n).alias("count")
                )
                for tier, at, n in ((1, "newest", "now"), (2, "newest", "recent"), (3, "oldest", "n"))
            ]
        )
    )
    return serving.choose_snapshot(seen.select("feed", tiers), F.lit(NOW))


# --- marts ----------------------------------------------------------------------------


@query
def agg_route_reliability(spark, d):
    return marts.route_reliability(t.staged(spark, d))


@query
def agg_route_carrier_reliability(spark, d):
    return marts.route_carrier_reliability(t.staged(spark, d))


@query
def agg_airport_reliability(spark, d):
    return marts.airport_reliability(t.staged(spark, d))


@query
def agg_airport_hourly(spark, d):
    return marts.airport_hourly(t.staged(spark, d))


@query
def agg_carrier_reliability(spark, d):
    return marts.carrier_reliability(t.staged(spark, d))


@query
def agg_hourly_patterns(spark, d):
    return marts.hourly_patterns(t.staged(spark, d))


@query
def hourly_rollup(spark, d):
    rolled = marts.hourly_rollup(marts.hourly_patterns(t.staged(spark, d)))
    return rolled.withColumn("delay_rate", F.round("delay_rate", 9))


@query
def agg_airport_worst_routes(spark, d):
    return marts.airport_worst_routes(t.staged(spark, d))


@query
def top_delayed_routes(spark, d):
    return marts.top_delayed_routes(marts.route_reliability(t.staged(spark, d)))


# --- serving -------------------------------------------------------------------------------


def _carrier_names(spark, d) -> DataFrame:
    """A display name for the carrier of every order."""
    codes = t.table(spark, d, "orders").select(F.col("o_orderpriority").alias("code")).distinct()
    return codes.withColumn("name", F.initcap("code"))


@query
def carrier_options(spark, d):
    carriers = marts.carrier_reliability(t.staged(spark, d))
    return serving.carrier_options(carriers, _carrier_names(spark, d))


@query
def example_presets(spark, d):
    totals = stored(marts.mart_totals(t.staged(spark, d), ["origin", "dest", "carrier"]))
    return serving.example_presets(
        marts.route_reliability(totals), marts.route_carrier_reliability(totals)
    )


def _pairs(items: str, code: str) -> Column:
    return F.array_join(
        F.transform(
            items,
            lambda x: F.concat_ws(
                ":", x[code].cast("string"), _millionths(x["delay_rate"]).cast("string")
            ),
        ),
        ";",
    )


@query
def route_lookup(spark, d):
    totals = stored(marts.mart_totals(t.staged(spark, d), ["origin", "dest", "carrier"]))
    docs = serving.route_documents(
        marts.route_reliability(totals), marts.route_carrier_reliability(totals)
    )
    return serving.lookup(docs, origin="nation_3").withColumn(
        "by_carrier", _pairs("by_carrier", "carrier")
    )


@query
def airport_bridge(spark, d):
    totals = stored(marts.mart_totals(t.staged(spark, d), ["origin", "dest", "dep_hour"]))
    dim = marts.dim_airports(t.airports(spark, d))
    docs = serving.airport_documents(
        dim,
        marts.airport_reliability(totals),
        marts.airport_hourly(totals),
        marts.airport_worst_routes(totals),
        joins.nearby_counts(dim, t.positions(spark, d)),
    )
    return docs.select(
        "iata",
        "name",
        "lat",
        "lon",
        F.col("historical.overall_delay_rate").alias("overall_delay_rate"),
        _pairs("historical.by_hour", "hour").alias("by_hour"),
        _pairs("historical.worst_routes", "dest").alias("worst_routes"),
        F.col("live_congestion.aircraft_nearby").alias("aircraft_nearby"),
        F.col("live_congestion.level").alias("level"),
    )


@query
def airport_congestion(spark, d):
    dim = t.airports(spark, d).select("iata", "lat", "lon")
    return joins.nearby_counts(dim, t.positions(spark, d))


@query
def airports_in_use(spark, d):
    dim = t.airports(spark, d).select("iata", "name")
    return joins.airports_in_use(t.flights(spark, d), dim, 12)


@query
def route_medians(spark, d):
    out = medians.exact_medians(
        t.flights(spark, d), ["origin", "dest"], ["distance", "crs_elapsed_time"]
    )
    return out.withColumns({c: scores.round6(F.col(c)) for c in out.columns if "median" in c})


# What of the flights the marts and the served features read.
COUNTED = ("origin", "dest", "carrier", LABEL, "dep_delay_minutes")
SERVED = (*COUNTED, "year", "flight_date", "distance", "crs_elapsed_time", "cancelled")


def _served(spark, d, as_of: bool = False, weather: bool = True) -> DataFrame:
    flights = t.stored_flights(spark, d, *SERVED)
    train, _ = slices.temporal_split(flights, t.TRAIN, t.TEST)
    made = (None, None, None)
    if not as_of:
        totals = stored(marts.mart_totals(staged_flights(flights, *COUNTED), ["origin", "dest", "carrier"]))
        made = (marts.route_reliability(totals), marts.airport_reliability(totals), marts.carrier_reliability(totals))
    return serving.request_features(
        t.requests(spark, d),
        t.airports(spark, d),
        medians.exact_medians(flights, ["origin", "dest"], ["distance", "crs_elapsed_time"]),
        *made,
        history.fit_base_rates(train),
        history.mean_label(train),
        t.weather(spark, d) if weather else None,
        t.HOLIDAYS,
        hour=t.weather_hour(),
        as_of=history.entity_days(flights) if as_of else None,
    )


@query
def serve_features_as_of(spark, d):
    """Requests by the rates known before their own dates, which lie among the flights'."""
    return _served(spark, d, as_of=True)


@query
def serve_features_horizon(spark, d):
    """Requests of folded days against forecasts made on one day, a document per airport."""
    hour = F.col("weather_ts")
    series = F.struct(F.date_format(hour, "yyyy-MM-dd'T'HH:mm").alias("time"), *documents.WEATHER_VARS)
    hours = F.array_sort(F.collect_list(series))
    docs = t.weather(spark, d).groupBy("iata").agg(hours.alias("h")).select(
        "iata",
        F.to_json(F.struct(F.struct(*[F.col(f"h.{c}").alias(c) for c in ("time", *documents.WEATHER_VARS)]).alias("hourly"))).alias("doc"))
    rows = serving.forecast_features(
        _served(spark, d, weather=False), documents.forecast_of(docs), F.to_date(F.lit(t.FORECAST_DAY)), day=t.folded_day())
    return rows.select("request_id", "weather_ok", *[f"{end}_{n}" for end in ("origin", "dest") for n in WEATHER_FILL])


@query
def serve_features(spark, d):
    rows = serving.weather_summary(_served(spark, d))
    return rows.select(
        "*",
        F.col("weather_summary.origin.temp_c").alias("temp_c"),
        F.col("weather_summary.dest.precip_mm").alias("precip_mm"),
    ).drop("weather_summary")


# --- history, enrichment, features --------------------------------------------------------


HISTORY_INPUT = (FLIGHT, "flight_date", "origin", "dest", "carrier", LABEL)


@query
def hist_features(spark, d):
    rows = t.stored_flights(spark, d, *HISTORY_INPUT)
    return history.with_history(rows).select(FLIGHT, *gold.HISTORY_COLUMNS)


@query
def hist_features_train_prior(spark, d):
    rows = t.stored_flights(spark, d, *HISTORY_INPUT)
    rows = history.with_history(rows, prior_years=t.TRAIN)
    return rows.select(FLIGHT, *gold.HISTORY_COLUMNS)


@query
def prior_rate_route(spark, d):
    route = {"prior_rate": ("origin", "dest")}
    totals = history.entity_days(t.flights(spark, d), route)
    own = history.of_entity(totals, route, route["prior_rate"])
    return history.prior_rate(own, route["prior_rate"], "prior_rate", history.prior_of(totals, route))


@query
def weather_join(spark, d):
    rows = t.flights(spark, d).withColumn("weather_hour_key", t.weather_hour())
    rows = joins.readings_at_ends(rows, t.weather(spark, d))
    return rows.select(
        FLIGHT, *[f"{side}_{s}" for side in ("origin", "dest") for s in WEATHER_FILL]
    )


@query
def gold_features(spark, d):
    known = [c for c in SILVER_FLIGHT_COLUMNS if c in GOLD_COLUMNS]
    rows = t.stored_flights(spark, d, *known)
    return gold.gold_features(rows, t.weather(spark, d), hour=t.weather_hour())


# --- learning and evaluation --------------------------------------------------------------


@query
def temporal_split(spark, d):
    train, test = slices.temporal_split(t.flights(spark, d), t.TRAIN, t.TEST)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "year").agg(
        F.count("*").alias("n"), F.sum(LABEL).alias("positives")
    )


@query
def temporal_slices(spark, d):
    rows = t.stored_flights(spark, d, "year", "flight_date", FLIGHT)
    train, _ = slices.temporal_split(rows, t.TRAIN, t.TEST)
    return slices.temporal_slices(train.drop("year"), [FLIGHT])


@query
def base_rate_fit(spark, d):
    train, _ = slices.temporal_split(t.flights(spark, d), t.TRAIN, t.TEST)
    return history.fit_base_rates(train, min_count=60)


@query
def base_rate_score(spark, d):
    rows = t.stored_flights(spark, d, "year", "origin", "dest", FLIGHT, LABEL)
    train, test = slices.temporal_split(rows, t.TRAIN, t.TEST)
    rates = history.fit_base_rates(train, min_count=60)
    scored = history.score_base_rate(test, rates, history.mean_label(train))
    return scored.select(FLIGHT, "baseline_probability")


@query
def class_weight(spark, d):
    train, _ = slices.temporal_split(t.flights(spark, d), t.TRAIN, t.TEST)
    return metrics.class_weight(train, LABEL)


@query
def category_levels(spark, d):
    return keyed.level_codes(t.flights(spark, d), CATEGORICAL)


@query
def reliability_curve(spark, d):
    curve = metrics.reliability_curve(t.scores(spark, d), "p", LABEL)
    return curve.withColumns(
        {c: F.round(c, 9) for c in ("mean_predicted", "fraction_positive")}
    )


def _by_year(spark, d) -> DataFrame:
    return t.scores(spark, d).select(F.col("year").cast("string").alias("name"), "p", F.col(LABEL).alias("y"))


@query
def eval_brier(spark, d):
    out = metrics.brier_scores(_by_year(spark, d))
    return out.withColumns({c: F.round(c, 9) for c in ("positive_rate", "brier")})


@query
def roc_auc(spark, d):
    out = metrics.rank_metrics(_by_year(spark, d))
    return out.select("name", F.round("roc_auc", 9).alias("roc_auc"))


@query
def average_precision(spark, d):
    out = metrics.rank_metrics(_by_year(spark, d))
    return out.select("name", F.round("average_precision", 9).alias("average_precision"))


@query
def evaluation(spark, d):
    """The price share as a model, its square as the raw model, route rates as baseline."""
    rows = t.stored_flights(spark, d, "year", "origin", "dest", "crs_elapsed_time", LABEL)
    train, test = slices.temporal_split(rows, t.TRAIN, t.TEST)
    p = F.least(F.lit(1.0), F.col("crs_elapsed_time") / 260)
    scored = history.score_base_rate(
        test, history.fit_base_rates(train), history.mean_label(train)
    ).withColumns({"delay_probability": p, "raw_probability": p * p})
    table = metrics.evaluation_table(scored, LABEL)
    return table.select(
        "n_test",
        "beats_baseline",
        *[F.round(c, 9).alias(c) for c in table.columns if c not in ("n_test", "beats_baseline")],
    )


_MODELS: dict[tuple[str, str], tuple] = {}


def _trained(spark, d) -> tuple[learn.Bundle, DataFrame, DataFrame]:
    """The default model on the stored feature table, trained once per application and folder."""
    at = spark.sparkContext.applicationId, d
    if at not in _MODELS:
        table = stored(gold_features(spark, d))
        _MODELS[at] = *learn.train_bundle(table, t.TRAIN, t.TEST), table
    return _MODELS[at]


@query
def training_facts(spark, d):
    """What of a training does not depend on the learner, and that calibration did no harm."""
    told = _trained(spark, d)[1]
    fixed = ("test_positive_rate", "baseline_roc_auc", "baseline_pr_auc", "baseline_brier")
    return told.select(
        "n_test",
        *[F.round(c, 9).alias(c) for c in fixed],
        (F.col("calib_brier_after") <= F.col("calib_brier_before")).alias("calibrated_not_worse"),
        (F.col("rounds_used") > 0).alias("has_rounds"),
    )


@query
def train_and_evaluate(spark, d):
    return _trained(spark, d)[1]


@query
def batch_score(spark, d):
    """Scores and factors of the test years by a model of the training years."""
    bundle, _, table = _trained(spark, d)
    _, test = slices.temporal_split(table, t.TRAIN, t.TEST)
    scored = learn.batch_score(bundle, test)
    return scored.select(
        "flight_date",
        "origin",
        "dest",
        "carrier",
        "dep_hour",
        "delay_probability",
        "risk_band",
        "baseline_probability",
        "beats_baseline",
        *[F.col("top_factors")[i]["feature"].alias(f"factor_{i + 1}") for i in range(3)],
    )


@query
def gate(spark, d):
    """Yearly AUC as a history of models; which of them would have been published."""
    runs = metrics.rank_metrics(_by_year(spark, d)).select(
        F.col("name").alias("run"), F.round("roc_auc", 9).alias("roc_auc")
    )
    return learn.quality_gate(runs, floor=0.5)


# --- data quality ---------------------------------------------------------------------------


def _checked(spark, d) -> DataFrame:
    """Flights with gaps in two columns and codes that no airport has."""
    return t.flights(spark, d).withColumns(
        {
            "carrier": F.when(F.col("dep_hour") != 3, F.col("carrier")),
            "dest": F.when(F.col("dep_hour") == 9, F.concat(F.lit("X "), "dest")).when(F.col("dep_hour") != 5, F.col("dest")),
        }
    )


@query
def dq_not_null(spark, d):
    return quality.not_null(_checked(spark, d), "carrier").select(FLIGHT, "dep_hour")


@query
def dq_unique(spark, d):
    return quality.unique(t.table(spark, d, "lineitem"), "l_orderkey")


@query
def dq_unique_combination(spark, d):
    return quality.unique_combination(t.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_accepted_values(spark, d):
    return quality.accepted_values(t.table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@query
def dq_accepted_range(spark, d):
    return quality.accepted_range(t.table(spark, d, "lineitem"), "l_quantity", 5, 45)


@query
def dq_relationships(spark, d):
    known = t.airports(spark, d)
    return quality.relationships(_checked(spark, d), "dest", known, "iata")


@query
def dq_report(spark, d):
    known = t.airports(spark, d)
    suite = quality.Suite(
        name="flights",
        not_null=["carrier", "dest", "origin"],
        unique=[FLIGHT],
        unique_combinations=[["origin", "dest", "crs_dep_time"]],
        accepted_values={LABEL: [0, 1], "day_of_week": [1, 2, 3, 4, 5]},
        accepted_range={"dep_hour": (0, 20), "distance": (2000, 90000)},
        relationships={"origin": (known, "iata"), "dest": (known, "iata")},
    )
    return quality.run_suite(stored(_checked(spark, d)), suite)
