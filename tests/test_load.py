"""Load invariants over one or more batches."""

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmart.domain import Domain
from eventmart.mart import ConflictError, Mart
from eventmart.operators.constraints import check_tables
from eventmart.plans import load as load_module
from eventmart.plans import reports
from eventmart.plans.load import ConstraintError, LoadOptions, load_batch, with_retries
from tests.conftest import payload

ONCE = LoadOptions(attempts=1)


def rows(mart, table, *columns):
    return sorted((tuple(r) for r in mart.table(table).select(*columns).collect()), key=str)


def assert_sound(mart):
    at = mart.commit_record()
    tables = {name: mart.table(name, at) for name in at.snapshots}
    broken = check_tables(tables, lengths=True).filter("violations > 0").collect()
    assert broken == []


def test_first_batch(events, mart):
    batch = events(
        payload(), payload(), payload(event_id="E2", event_type="return", customer_id="C2"),
        payload(event_id="E3", price=0), payload(event_id="E3", price=0), "junk",
    )
    result = load_batch(mart, batch, 7, options=ONCE)
    assert (result.valid, result.rejected, result.inserted, result.skipped, result.missing_key) == (3, 3, 2, 0, 0)
    assert rows(mart, "fact_sales", "event_id", "sales_key") in ([("E1", 1), ("E2", 2)], [("E1", 2), ("E2", 1)])
    assert rows(mart, "dim_customer", "customer_key", "customer_id") == [(1, "C1"), (2, "C2")]
    assert rows(mart, "dim_date", "date_key", "year", "month") == [(20250308, 2025, 3)]
    dead = mart.table("dead_letter_events")
    assert sorted(r["dead_letter_key"] for r in dead.collect()) == [1, 2, 3]
    assert {r["batch_id"] for r in dead.collect()} == {7}
    assert dead.filter("raw_payload = 'junk'").count() == 1
    assert dead.filter("event_id = 'E3'").count() == 2
    assert_sound(mart)
    assert mart.commit_record().counts["inserted"] == 2


def test_overlap_and_attribute_change(events, mart):
    load_batch(mart, events(payload(), payload(event_id="E2", customer_id="C2")), 0, options=ONCE)
    before = {r["customer_id"]: r for r in mart.table("dim_customer").collect()}
    second = events(
        payload(quantity=9), payload(event_id="E3", customer_id="C2", customer_name="Bea", customer_gender=None),
        payload(event_id="E4", customer_id="C0"),
    )
    result = load_batch(mart, second, 1, options=ONCE)
    assert (result.inserted, result.skipped) == (2, 1)
    assert rows(mart, "fact_sales", "event_id", "quantity") == [("E1", 3), ("E2", 3), ("E3", 3), ("E4", 3)]
    after = {r["customer_id"]: r for r in mart.table("dim_customer").collect()}
    assert {k: r["customer_key"] for k, r in after.items()} == {"C1": 1, "C2": 2, "C0": 3}
    assert after["C1"] == before["C1"]
    assert (after["C2"]["customer_name"], after["C2"]["customer_gender"]) == ("Bea", None)
    assert after["C2"]["created_at"] == before["C2"]["created_at"] < after["C2"]["updated_at"]
    assert_sound(mart)


def test_same_events_under_a_new_batch_id(events, mart):
    texts = (payload(), payload(event_id="E9", price=0))
    load_batch(mart, events(*texts), 0, options=ONCE)
    before = mart.commit_record()
    result = load_batch(mart, events(*texts), 1, options=ONCE)
    assert (result.inserted, result.skipped, result.rejected) == (0, 1, 1)
    after = mart.commit_record()
    changed = {t for t in after.snapshots if after.snapshots[t] != before.snapshots[t]}
    assert changed == {"dead_letter_events"}
    assert rows(mart, "dead_letter_events", "dead_letter_key", "batch_id") == [(1, 0), (2, 1)]


def test_replay_changes_nothing(events, mart):
    texts = (payload(), payload(event_id="E9", price=0))
    load_batch(mart, events(*texts), 3, source="a", options=ONCE)
    before = mart.commit_record()
    for batch_id in (3, 2):
        assert load_batch(mart, events(*texts), batch_id, source="a", options=ONCE).replayed
    assert mart.commit_record() == before
    # Another source counts its own batches.
    assert not load_batch(mart, events(*texts), 0, source="b", options=ONCE).replayed
    assert mart.commit_record().applied == {"a": 3, "b": 0}


def test_empty_batch_commits_nothing(events, mart):
    mart.bootstrap()
    assert load_batch(mart, events(payload()).limit(0), 0, options=ONCE).load is None
    assert mart.commit_record().load == 0


def test_rejects_only(events, mart):
    result = load_batch(mart, events("x", "y"), 0, options=ONCE)
    assert (result.valid, result.rejected) == (0, 2)
    assert mart.table("dead_letter_events").count() == 2
    assert mart.table("fact_sales").count() == 0 and mart.table("dim_customer").count() == 0


POISON = [
    payload(event_id="P1", marketing_channel=None), payload(event_id="P2", marketing_channel="fax"),
    payload(event_id="P3", store_name=None), payload(event_id="P4", rating=9),
]


@pytest.mark.parametrize("poison", POISON)
def test_poison_fails_the_batch(events, mart, poison):
    load_batch(mart, events(payload()), 0, options=ONCE)
    before = mart.commit_record()
    with pytest.raises(ConstraintError):
        load_batch(mart, events(payload(event_id="E2"), poison), 1, options=ONCE)
    assert mart.commit_record() == before
    assert mart.table("fact_sales").count() == 1


def test_poison_can_be_quarantined(events, mart):
    options = LoadOptions(on_violation="quarantine", attempts=1)
    result = load_batch(mart, events(payload(), *POISON), 0, options=options)
    assert (result.inserted, result.rejected) == (1, len(POISON))
    assert {r[1] for r in rows(mart, "dead_letter_events", "event_id", "reject_reason")} == {
        "marketing_channel not null", "marketing_channel allowed", "store_name not null", "rating between 1 and 5",
    }
    assert_sound(mart)


def test_prices_of_any_size_load(events, mart):
    prices = {"A": 1e10, "B": 1e12, "C": 1e-7, "D": 9e9, "E": 1.5e15}
    batch = events(*[payload(event_id=k, price=p, discount=0, quantity=2_000_000_000 if k == "D" else 1) for k, p in prices.items()])
    assert load_batch(mart, batch, 0, options=ONCE).inserted == 5
    stored = {r.event_id: r for r in mart.table("fact_sales").collect()}
    assert {k: float(r.price) for k, r in stored.items()} == prices
    assert float(stored["D"].revenue) == 1.8e19
    total = reports.total_revenue_exact(mart).first()[0]
    assert total == Decimal("10000000000") + Decimal(10**12) + 18 * Decimal(10**18) + 15 * Decimal(10**14)
    nan = events(payload(event_id="N").replace("19.99", "NaN"))
    assert load_batch(mart, nan, 1, options=ONCE).rejected == 1


def test_a_domain_of_ones_own_holds_for_rules_and_constraints(events, mart):
    own = Domain(years=(2031,), categories=("Garden",), channels=("fax",))
    batch = events(
        payload(product_category="Garden", marketing_channel="fax", event_timestamp="2031-05-01T00:00:00+00:00"),
        payload(event_id="E2", product_category="Garden", marketing_channel="fax"), payload(event_id="E3"),
    )
    result = load_batch(mart, batch, 0, options=LoadOptions(domain=own, attempts=1))
    assert (result.inserted, result.rejected) == (1, 2)
    tables = {name: mart.table(name) for name in mart.commit_record().snapshots}
    assert check_tables(tables, domain=own).filter("violations > 0").count() == 0
    assert {r.rule for r in check_tables(tables).filter("violations > 0").collect()} == {
        "product_category allowed", "marketing_channel allowed", "date_key between 20230101 and 20261231",
        "year between 2023 and 2026",
    }


def test_text_lengths_are_checked_on_request(events, mart):
    long_name = payload(customer_name="x" * 200)
    careful = LoadOptions(on_violation="quarantine", check_lengths=True, attempts=1)
    kept = load_batch(mart, events(payload(event_id="OK"), payload(event_id="L", customer_name="x" * 151)), 0, options=careful)
    assert (kept.inserted, kept.rejected) == (1, 1)
    assert rows(mart, "dead_letter_events", "reject_reason") == [("customer_name at most 150 long",)]
    mart = Mart(mart.spark, mart.root + "2")
    with pytest.raises(ConstraintError, match="customer_name at most 150 long"):
        load_batch(mart, events(long_name), 0, options=LoadOptions(check_lengths=True, attempts=1))
    assert load_batch(mart, events(long_name), 0, options=ONCE).inserted == 1


def test_crash_leaves_the_last_commit_and_retry_succeeds(events, mart, monkeypatch):
    load_batch(mart, events(payload()), 0, options=ONCE)
    before = mart.commit_record()
    batch = events(payload(event_id="E2", customer_name="New"), payload(event_id="E3", price=0))

    def crash(self, commit):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Mart, "publish", crash)
        with pytest.raises(OSError):
            load_batch(mart, batch, 1, options=ONCE)
    assert mart.commit_record() == before
    assert rows(mart, "fact_sales", "event_id") == [("E1",)]
    assert rows(mart, "dim_customer", "customer_name") == [("Ann",)]
    assert mart.table("dead_letter_events").count() == 0

    # The files of the dead attempt do not show up in a later load without facts either.
    load_batch(mart, events("junk"), 1, options=ONCE)
    load_batch(mart, batch, 2, options=ONCE)
    assert rows(mart, "fact_sales", "event_id") == [("E1",), ("E2",)]
    assert mart.table("dead_letter_events").count() == 2
    assert_sound(mart)


def test_retries_wait_longer_each_time(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(load_module.time, "sleep", waits.append)

    def fail_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert with_retries(fail_twice) == "done"
    assert waits == [5.0, 10.0]
    with pytest.raises(OSError):
        with_retries(lambda: (_ for _ in ()).throw(OSError()), attempts=2, wait_seconds=0)


def test_defaults_replace_known_names_unless_told_otherwise(events, spark, tmp_path):
    for keep, name in ((False, "Unknown Customer"), (True, "Ann")):
        mart, options = Mart(spark, str(tmp_path / str(keep))), LoadOptions(keep_known=keep, attempts=1)
        load_batch(mart, events(payload()), 0, options=options)
        later = payload(event_id="E2", customer_name=None, event_timestamp="2026-01-01T00:00:00+00:00")
        load_batch(mart, events(later), 1, options=options)
        assert rows(mart, "dim_customer", "customer_name") == [(name,)]


def test_row_order_does_not_matter(events, spark, tmp_path):
    texts = [
        payload(event_id=f"E{i % 20}", customer_id=f"C{i % 7}", customer_name=f"N{i}", product_id=f"P{i % 5}",
                event_timestamp=f"2025-03-{1 + i % 20:02d}T00:00:00+00:00", quantity=1 + i % 6)
        for i in range(60)
    ]
    results = []
    for n, parts in ((0, 1), (1, 5)):
        mart = Mart(spark, str(tmp_path / str(n)))
        batch = events(*texts).repartition(parts, F.rand(n)).sortWithinPartitions(F.rand(n))
        load_batch(mart, batch, 0, options=ONCE)
        results.append((
            rows(mart, "fact_sales", "event_id", "customer_key", "product_key", "quantity", "revenue"),
            rows(mart, "dim_customer", "customer_key", "customer_id", "customer_name"),
            rows(mart, "dim_product", "product_key", "product_id"),
        ))
    assert results[0] == results[1]


def test_large_batch_path_gives_the_same_mart(events, spark, tmp_path, monkeypatch):
    """Without the small-batch shortcuts."""
    first = [payload(event_id=f"E{i}", customer_id=f"C{i % 9}") for i in range(40)]
    second = [payload(event_id=f"E{i}", customer_id=f"C{i % 13}", customer_name=f"N{i % 13}") for i in range(30, 70)]
    results = []
    for limit in (load_module.SMALL_ROWS, 0):
        monkeypatch.setattr(load_module, "SMALL_ROWS", limit)
        mart = Mart(spark, str(tmp_path / str(limit)))
        load_batch(mart, events(*first), 0, options=ONCE)
        result = load_batch(mart, events(*second), 1, options=ONCE)
        assert (result.inserted, result.skipped) == (30, 10)
        again = load_batch(mart, events(*second), 2, options=ONCE)
        assert (again.inserted, again.skipped) == (0, 40)
        results.append((
            rows(mart, "fact_sales", "event_id", "customer_key"),
            rows(mart, "dim_customer", "customer_key", "customer_id", "customer_name"),
        ))
        assert_sound(mart)
    assert results[0] == results[1]


def test_hot_customer_and_hot_event(events, mart):
    """A third of all rows are copies of one event, another third belong to one customer."""
    copies = [payload(event_id="HOT")] * 100
    one_customer = [payload(event_id=f"H{i}", customer_id="HOT") for i in range(100)]
    others = [payload(event_id=f"O{i}", customer_id=f"C{i}") for i in range(100)]
    result = load_batch(mart, events(*copies, *one_customer, *others), 0, options=ONCE)
    assert (result.valid, result.inserted) == (300, 201)
    assert_sound(mart)


def test_tables_views_and_listing(events, mart, spark):
    assert not mart.table_exists("fact_sales")
    assert mart.list_tables().count() == 0
    with pytest.raises(LookupError):
        mart.table("fact_sales")
    mart.bootstrap()
    assert mart.table_exists("fact_sales") and not mart.table_exists("other")
    assert [r[0] for r in mart.list_tables().collect()] == sorted(load_module.TABLE_DDL)
    assert mart.table("fact_sales").count() == 0
    load_batch(mart, events(payload()), 0, options=ONCE)
    mart.create_views()
    answer = spark.sql("""
        SELECT p.product_category, round(sum(f.revenue), 2) AS revenue FROM fact_sales f
        JOIN dim_product p ON f.product_key = p.product_key
        WHERE f.event_type IN ('purchase', 'return') GROUP BY p.product_category
    """).first()
    assert (answer[0], float(answer[1])) == ("Books", 50.97)


def test_snapshots_of_the_past(events, mart):
    for i in range(3):
        load_batch(mart, events(payload(event_id=f"E{i}", customer_name=f"N{i}")), i, options=ONCE)
    assert [mart.table("dim_customer", mart.commit_record(n)).first()["customer_name"] for n in (1, 2, 3)] == ["N0", "N1", "N2"]
    assert mart.table("fact_sales", mart.commit_record(2)).count() == 2


class Killed(BaseException):
    """A process that ends without cleaning up."""


@pytest.fixture
def killed(monkeypatch):
    """Run a load up to its commit and leave everything as it is then."""

    def run(mart, batch, batch_id, source="batch"):
        def stop(self, *args):
            raise Killed

        with monkeypatch.context() as patch:
            patch.setattr(Mart, "publish", stop)
            patch.setattr(Mart, "clear_load", lambda self, load: None)
            with pytest.raises(Killed):
                load_batch(mart, batch, batch_id, source, ONCE)

    return run


def test_what_a_dead_attempt_wrote_never_shows(events, mart, killed):
    load_batch(mart, events(payload()), 0, options=ONCE)
    second = events(payload(event_id="E2"), payload(event_id="R", price=0))
    killed(mart, second, 1)
    load_batch(mart, events(payload(event_id="E3"), "junk"), 0, "other", ONCE)
    load_batch(mart, second, 1, options=ONCE)
    assert rows(mart, "fact_sales", "event_id") == [("E1",), ("E2",), ("E3",)]
    assert mart.table("dead_letter_events").count() == 2
    assert mart.commit_record().dead == [2]
    assert_sound(mart)


def test_two_sources_do_not_touch_each_others_files(events, spark, mart, monkeypatch):
    """Source a has written and not committed; b starts, writes and dies; a commits; b tries again."""
    load_batch(mart, events(payload()), 0, options=ONCE)
    other = Mart(spark, mart.root)
    publish, clear = Mart.publish, Mart.clear_load

    def stop(self, commit):
        raise Killed

    def b_comes_in_between(self, commit):
        with monkeypatch.context() as patch:
            patch.setattr(Mart, "publish", stop)
            patch.setattr(Mart, "clear_load", lambda self, load: None)
            with pytest.raises(Killed):
                load_batch(other, events(payload(event_id="B1")), 0, "b", ONCE)
        publish(self, commit)

    with monkeypatch.context() as patch:
        patch.setattr(Mart, "publish", b_comes_in_between)
        assert load_batch(mart, events(payload(event_id="A1"), payload(event_id="A2")), 0, "a", ONCE).inserted == 2
    assert Mart.clear_load is clear
    assert load_batch(other, events(payload(event_id="B1")), 0, "b", ONCE).inserted == 1
    assert rows(mart, "fact_sales", "event_id") == [("A1",), ("A2",), ("B1",), ("E1",)]
    assert_sound(mart)


def test_a_commit_that_comes_too_late_is_tried_again(events, spark, mart, monkeypatch):
    """Without the lock, as between processes: b commits while a is about to."""
    mart.bootstrap()
    other, publish, done = Mart(spark, mart.root), Mart.publish, []

    def overtaken(self, commit):
        if not done:
            done.append(1)
            load_batch(other, events(payload(event_id="B1")), 0, "b", ONCE)
        publish(self, commit)

    monkeypatch.setattr(Mart, "publish", overtaken)
    result = load_batch(mart, events(payload(event_id="A1")), 0, "a", LoadOptions(attempts=2, wait_seconds=0))
    assert result.inserted == 1
    assert rows(mart, "fact_sales", "event_id") == [("A1",), ("B1",)]
    assert mart.commit_record().applied == {"a": 0, "b": 0}
    with pytest.raises(ConflictError):
        mart.publish(mart.commit_record())
    assert_sound(mart)


def test_loads_at_the_same_time(events, spark, mart):
    def load(k):
        return load_batch(Mart(spark, mart.root), events(payload(event_id=f"E{k}"), payload(event_id="SAME")), 0, f"s{k}", ONCE)

    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(load, range(3)))
    assert sum(r.inserted for r in results) == 4
    assert mart.table("fact_sales").count() == 4
    assert_sound(mart)
