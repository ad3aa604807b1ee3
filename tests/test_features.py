import datetime as dt

from pyspark.sql import functions as F

from lotwise.contracts import CARS, EVENTS, IMPRESSIONS, SESSIONS, USERS
from lotwise.plans import features as O


def _ts(h, m=0, d=2):
    return dt.datetime(2024, 1, d, h, m)


def _fixture(spark, extra_events=()):
    """Two cars, one user, two sessions; impressions in session s2."""
    def car(cid, city, body, entry, exit_, sold):
        r = {f.name: None for f in CARS.fields}
        r.update(car_id=cid, make="M", model="X", body_type=body, city=city, fuel_type="Petrol",
                 transmission="Manual", manufacturing_year=2018, kilometres_driven=30000.0,
                 listed_price=500000.0, acquisition_price=400000.0, inventory_entry_date=entry,
                 inventory_exit_date=exit_, sold_flag=sold, transaction_price=480000.0 if sold else None,
                 days_in_inventory=20, owner_count=1, inspection_score=80.0)
        return r
    cars = spark.createDataFrame([
        car("c1", "A", "SUV", dt.date(2024, 1, 1), None, False),
        car("c2", "A", "Sedan", dt.date(2023, 12, 20), dt.date(2024, 1, 2), True)], CARS)
    u = {f.name: None for f in USERS.fields}
    u.update(user_id="u1", home_city="A", maximum_budget=600000.0, maximum_emi=12000.0,
             vehicle_age_tolerance=5.0, kilometre_tolerance=50000.0, preferred_makes="M")
    users = spark.createDataFrame([u], USERS)
    sessions = spark.createDataFrame([
        ("s1", "u1", _ts(9, d=1), _ts(10, d=1), "k", "g", "cpc", "mobile", "A", False, 1),
        ("s2", "u1", _ts(9), _ts(11), "k", "g", "cpc", "mobile", "A", True, 2)], SESSIONS)

    def ev(eid, ts, sid, name, car=None):
        r = {f.name: None for f in EVENTS.fields}
        r.update(event_id=eid, event_timestamp=ts, event_date=ts.date(), user_id="u1", session_id=sid,
                 event_name=name, car_id=car, city="A")
        return r
    rows = [ev("e1", _ts(9, d=1), "s1", "view_item", "c1"), ev("e2", _ts(9, 30, d=1), "s1", "booking_complete", "c1"),
            ev("e3", _ts(9), "s2", "search"), ev("e4", _ts(9, 5), "s2", "apply_filter"),
            ev("e5", _ts(9, 10), "s2", "view_item", "c2"), ev("e6", _ts(10, 30), "s2", "view_item", "c1")]
    rows += [ev(*x) for x in extra_events]
    events = spark.createDataFrame(rows, EVENTS)
    imp = {f.name: None for f in IMPRESSIONS.fields}
    imps = []
    for cid, pos in (("c1", 1), ("c2", 2)):
        r = dict(imp)
        r.update(session_id="s2", user_id="u1", car_id=cid, list_position=pos, examined=True,
                 clicked=False, booked=False, purchased=False, event_timestamp=_ts(10), campaign_id="k")
        imps.append(r)
    impressions = spark.createDataFrame(imps, IMPRESSIONS)
    return cars, users, sessions, events, impressions


LEAK_SENSITIVE = ["session_duration_s", "session_searches", "session_filters", "session_events",
                  "market_demand_index", "local_supply_index", "prior_sessions", "prior_booking_rate"]


def _booking_rows(spark, extra=()):
    cars, users, sessions, events, impressions = _fixture(spark, extra)
    ds = O.build_booking_dataset(impressions, sessions, users, cars, events)
    return {r.car_id: r.asDict() for r in ds.collect()}


def test_booking_dataset_values(spark):
    rows = _booking_rows(spark)
    r = rows["c1"]
    assert r["prior_sessions"] == 0 and r["session_searches"] == 1 and r["session_filters"] == 1
    assert r["session_events"] == 3  # events up to the 10:00 decision time
    assert r["session_duration_s"] == 3600.0
    # one view of an SUV before t, two views in total, two segments with cars
    assert abs(r["market_demand_index"] - 1 / (2 / 2)) < 1e-12
    # at 2024-01-02 10:00 the sedan has exited (midnight < t): only the SUV is live
    assert r["local_supply_index"] == 1.0
    assert r["label_booked"] == 0 and r["brand_match"] == 1


def test_booking_dataset_has_no_future_leak(spark):
    """Metamorphic: booking events after the decision time change nothing."""
    base = _booking_rows(spark)
    later = _booking_rows(spark, extra=[("x1", _ts(11), "s2", "booking_complete", "c1"),
                                        ("x2", _ts(11), "s2", "view_item", "c1"),
                                        ("x3", _ts(23, d=3), "s2", "search")])
    for car in base:
        for col in LEAK_SENSITIVE:
            assert base[car][col] == later[car][col], (car, col)


def test_price_dataset_observes_at_listing(spark, mp):
    ds = O.build_price_dataset(mp.cars, mp.events)
    bad = ds.join(mp.cars.select("car_id", "inventory_entry_date"), "car_id") \
        .filter(F.col("observation_date") != F.col("inventory_entry_date").cast("timestamp_ntz")).count()
    assert bad == 0 and ds.count() == mp.cars.filter("sold_flag").count()


def test_day0_snapshots_have_no_views(spark, mp):
    ds = O.build_sellthrough_dataset(mp.cars, mp.events).filter(F.col("snapshot_age") == 0)
    med = ds.agg(F.median("views")).first()[0]
    assert med == 0


def test_market_context_matches_brute_force(spark, mp):
    """Running-sum context equals direct counting on a sample of observations."""
    from lotwise.operators.pit import market_context
    obs = mp.cars.select("city", "body_type", F.col("inventory_entry_date").cast("timestamp_ntz").alias("t"))
    ctx = {(r.city, r.body_type, r.t): r for r in market_context(obs, mp.cars, mp.events, "t").collect()}
    cars = mp.cars.select("car_id", "city", "body_type", "inventory_entry_date", "inventory_exit_date").collect()
    seg = {r.car_id: (r.city, r.body_type) for r in cars}
    views = [(r.event_timestamp, seg.get(r.car_id)) for r in
             mp.events.filter("event_name = 'view_item' AND car_id IS NOT NULL").collect() if r.car_id in seg]
    n_seg = len({(c.city, c.body_type) for c in cars})
    for key in list(ctx)[:40]:
        city, body, t = key
        d = sum(1 for ts, s in views if s == (city, body) and ts <= t)
        tot = sum(1 for ts, _ in views if ts <= t)
        exp_d = d / (tot / n_seg) if tot else 0.5

        def live(match):
            ent = sum(1 for c in cars if match(c) and dt.datetime.combine(c.inventory_entry_date, dt.time()) <= t)
            ext = sum(1 for c in cars if match(c) and c.inventory_exit_date is not None
                      and dt.datetime.combine(c.inventory_exit_date, dt.time()) < t)
            return ent - ext
        city_live = live(lambda c: c.city == city)
        seg_live = live(lambda c: c.city == city and c.body_type == body)
        exp_s = seg_live / city_live if city_live > 0 else 0.0
        assert abs(ctx[key].market_demand_index - exp_d) < 1e-12
        assert abs(ctx[key].local_supply_index - exp_s) < 1e-12


def test_datasets_store_no_row_that_carries_all_joined_columns(spark, mp, monkeypatch):
    from lotwise.plans import features as O
    stored, checkpoint = [], type(mp.cars).checkpoint

    def spy(df, *args, **kwargs):
        stored.append(df.columns)
        return checkpoint(df, *args, **kwargs)

    sessions = mp.sessions
    monkeypatch.setattr(type(mp.cars), "checkpoint", spy)
    O.build_booking_dataset(mp.impressions, sessions, mp.users, mp.cars, mp.events)
    assert max(map(len, stored)) <= 12 and not any("list_position" in c for c in stored)
    stored.clear()
    O.build_sellthrough_dataset(mp.cars, mp.events)
    assert all(set(c) <= {*O.SELL_FEATURES, "car_id", "snapshot_date", "label_sold_30d"} for c in stored if len(c) > 12)


def test_sessions_and_users_that_come_twice_multiply_their_rows(spark, mp):
    from lotwise.plans import features as O
    imp = mp.impressions.limit(40)
    key = imp.orderBy("session_id").first()
    session = spark.createDataFrame(
        [(key.session_id, key.user_id, "a"), (key.session_id, key.user_id, "b")], "session_id string, user_id string, "
        "device_category string")
    sessions = session.join(mp.sessions.limit(1).drop("session_id", "user_id", "device_category"))
    odd = imp.unionByName(imp.limit(1).withColumn("session_id", F.lit(None).cast("string")))
    out = O.build_booking_dataset(odd, sessions, mp.users, mp.cars, mp.events)
    of_key = imp.where((F.col("session_id") == key.session_id) & (F.col("user_id") == key.user_id)).count()
    assert out.count() == 41 + of_key
    assert out.where("session_id is null").count() == 1
