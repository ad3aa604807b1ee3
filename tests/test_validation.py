"""Fault injection per contract (M1-M5) and clean warehouse checks."""
import datetime as dt

from pyspark.sql import functions as F

from lotwise.contracts import CARS
from lotwise.plans import quality as Q


def _violations(df):
    return {r.check_name: r.violations for r in df.collect()}


def _car(**kw):
    r = {f.name: None for f in CARS.fields}
    r.update(car_id="c1", make="M", model="X", body_type="SUV", manufacturing_year=2018, registration_year=2019,
             kilometres_driven=1.0, owner_count=1, inspection_score=80.0, listed_price=1.0, acquisition_price=1.0,
             sold_flag=False, inventory_entry_date=dt.date(2024, 1, 1))
    r.update(kw)
    return r


def test_bad_cars_are_found(spark):
    cars = spark.createDataFrame([
        _car(car_id="a", listed_price=-5.0), _car(car_id="b", registration_year=1990),
        _car(car_id="c", inspection_score=250.0), _car(car_id="d", transaction_price=100000.0),
        _car(car_id="e")], CARS)
    v = _violations(Q.validate_cars(cars))
    assert v["non-positive listed_price"] == 1
    assert v["registration_year before manufacturing_year"] == 1
    assert v["inspection_score out of [0,100]"] == 1
    assert v["unsold car has transaction_price"] == 1
    assert v["car_id not unique"] == 0


def test_leak_guard():
    assert Q.validate_feature_list(["make", "transaction_price"])
    assert not Q.validate_feature_list(["make", "kilometres_driven"])


def test_event_user_mismatch_and_impression_funnel(spark, mp):
    ev = mp.events
    first = ev.orderBy("event_id").first().event_id
    bad = ev.withColumn("user_id", F.when(F.col("event_id") == first, F.lit("nobody")).otherwise(F.col("user_id")))
    v = {r.check_name: r.violations for r in
         Q.validate_sessions_events(mp.sessions, bad, mp.users, mp.cars, mp.campaigns).collect()}
    assert v["event user does not match session user"] == 1
    imp = mp.impressions.limit(1).withColumn("examined", F.lit(False)).withColumn("clicked", F.lit(True)) \
        .withColumn("booked", F.lit(True))
    v = _violations(Q.validate_impressions(imp, mp.sessions, mp.events, mp.cars))
    assert v["clicked impression was not examined"] == 1


def test_validate_all_raises_and_reports(spark, mp):
    import pytest
    errors = Q.validate_all(mp.as_dict(), raise_on_error=False)
    assert isinstance(errors, list)
    if errors:
        with pytest.raises(Q.ValidationError):
            Q.validate_all(mp.as_dict())


def test_warehouse_checks_on_mapped_data(spark, mp):
    v = _violations(Q.data_quality_checks(mp.users, mp.sessions, mp.events, mp.cars, mp.impressions))
    assert len(v) == 8
    # sessions are derived from events, so these contracts hold by construction
    for name in ("orphan_session_user", "orphan_event_session", "orphan_event_car",
                 "event_before_session_start", "event_after_session_end",
                 "sold_car_missing_transaction_price", "purchase_without_booking"):
        assert v[name] == 0, name
