import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators import scd2
from shelfwatch.operators.asof import as_of, valid_on
from shelfwatch.operators.quality import fail_above, history_violations
from shelfwatch.sources.schemas import PRICE, SCD
from tests.conftest import day, rows, stamp

KEY = "itemcode long, num_reshet long, num_snif int"
RAW = "itemcode string, num_reshet string, num_snif string, itemname string, itemprice string, file_name string, file_date timestamp"
DAILY = T.StructType(
    [
        T.StructField("itemcode", T.LongType()),
        T.StructField("num_reshet", T.LongType()),
        T.StructField("num_snif", T.IntegerType()),
        T.StructField("itemname", T.StringType()),
        T.StructField("itemprice", PRICE),
        T.StructField("file_date", T.DateType()),
        T.StructField("observed_at", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
    ]
)


def observed(spark, given):
    """(item, day number, price) or (item, day number, price, name) to daily observations."""
    made = []
    for item, n, price, *name in given:
        made.append((item, 7, 1, name[0] if name else f"i{item}-{n}", Decimal(price), day(n), stamp(n), "f"))
    return spark.createDataFrame(made, DAILY).repartition(3)


def brute_force(given):
    """Day-by-day replay: the first name stays, a changed price closes and opens."""
    history = []
    for item, n, price, *name in sorted(given, key=lambda g: (g[0], g[1])):
        label = name[0] if name else f"i{item}-{n}"
        active = next((v for v in history if v[0] == item and v[4] is None), None)
        if active is None:
            history.append([item, label, Decimal(price), day(n), None])
        elif active[2] != Decimal(price):
            active[4] = day(n)
            history.append([item, active[1], Decimal(price), day(n), None])
    return sorted(
        ((i, name, p, s, e, int(e is None), 7, 1) for i, name, p, s, e in history), key=repr
    )


def random_history(seed, items=6, days=25, size=80):
    rng = random.Random(seed)
    seen = {}
    for _ in range(size):
        item = 1 if rng.random() < 0.34 else rng.randrange(items)
        seen[(item, rng.randrange(days))] = rng.choice(["1", "2", "2.5"])
    return [(item, n, price) for (item, n), price in seen.items()]


@pytest.mark.parametrize("seed", range(4))
def test_one_pass_build_equals_daily_replay(spark, seed):
    given = random_history(seed)
    history = scd2.build_versions(observed(spark, given))
    assert rows(history, *SCD) == brute_force(given)
    assert rows(history_violations(history))[0][2:] == (0, 0, 0, 0)


def test_applying_day_by_day_gives_the_same_history(spark):
    given = random_history(11, days=4, size=40)
    history = spark.createDataFrame([], scd2.build_versions(observed(spark, given)).schema)
    for n in range(4):
        batch = observed(spark, [g for g in given if g[1] == n])
        labelled = scd2.apply_batch(history, batch)
        history = spark.createDataFrame(labelled.select(*SCD).collect(), history.schema)
    assert rows(history, *SCD) == brute_force(given)


def test_actions(spark):
    before = scd2.build_versions(
        observed(spark, [(1, 0, "5"), (1, 1, "6"), (2, 0, "5"), (3, 0, "5"), (4, 0, "5", "first")])
    )
    batch = observed(spark, [(1, 2, "6"), (2, 2, "7"), (4, 2, "9", "second"), (5, 2, "1")])
    got = rows(scd2.apply_batch(before, batch), "itemcode", "itemname", "itemprice", "StartDate", "EndDate", "IsActive", "Action")
    d = Decimal
    assert got == sorted(
        [
            (1, "i1-0", d("5.0000"), day(0), day(1), 0, "close"),
            (1, "i1-0", d("6.0000"), day(1), None, 1, "NO_CHANGE"),
            (2, "i2-0", d("5.0000"), day(0), day(2), 0, "UPDATE"),
            (2, "i2-0", d("7.0000"), day(2), None, 1, "UPDATE-open"),
            (3, "i3-0", d("5.0000"), day(0), None, 1, "OLD"),
            (4, "first", d("5.0000"), day(0), day(2), 0, "UPDATE"),
            (4, "first", d("9.0000"), day(2), None, 1, "UPDATE-open"),
            (5, "i5-2", d("1.0000"), day(2), None, 1, "NEW"),
        ],
        key=repr,
    )


def test_an_unreadable_price_leaves_the_active_version_alone(spark):
    before = scd2.build_versions(observed(spark, [(1, 0, "5")]))
    batch = observed(spark, [(1, 1, "6"), (2, 1, "6")]).withColumn("itemprice", F.lit(None).cast(PRICE))
    assert rows(scd2.apply_batch(before, batch), "itemcode", "EndDate", "Action") == [(1, None, "OLD")]


def test_apply_refuses_several_days_of_one_entity(spark):
    before = scd2.build_versions(observed(spark, [(1, 0, "5")]))
    with pytest.raises(Exception, match="several rows for one entity"):
        scd2.apply_batch(before, observed(spark, [(1, 1, "6"), (1, 2, "7"), (1, 3, "8")])).collect()


@pytest.mark.parametrize("seed", range(2))
def test_merging_batches_of_several_days(spark, seed):
    given = random_history(seed)
    before = scd2.build_versions(observed(spark, [g for g in given if g[1] < 12]))
    batch = observed(spark, [g for g in given if g[1] >= 12])
    merged = scd2.merge_batch(before, batch)
    assert rows(merged, *SCD) == brute_force(given)
    again = scd2.merge_batch(spark.createDataFrame(merged.collect(), merged.schema), observed(spark, []))
    assert rows(again, *SCD) == brute_force(given)


def test_late_observations_are_refused_where_they_cannot_be_placed(spark):
    before = scd2.build_versions(observed(spark, [(1, 0, "5"), (1, 5, "6"), (2, 0, "5")]))
    for late in ((1, 3, "7"), (1, 5, "7")):
        for step in (scd2.apply_batch, scd2.merge_batch):
            with pytest.raises(Exception, match="not newer than the active version"):
                step(before, observed(spark, [late])).collect()
    same = observed(spark, [(1, 5, "6", "renamed")])
    assert rows(scd2.merge_batch(before, same), *SCD) == rows(before, *SCD)
    assert rows(scd2.apply_batch(before, same), *SCD) == rows(before, *SCD)


@pytest.mark.parametrize("seed", range(2))
def test_late_observations_rebuild_only_their_entities(spark, seed):
    given = random_history(seed)
    late = [g for g in given if g[0] in (1, 2) and g[1] % 4 == 0]
    on_time = [g for g in given if g not in late]
    log = observed(spark, on_time)
    history = scd2.build_versions(log)
    assert rows(scd2.rebuild_entities(history, log, observed(spark, late)), *SCD) == brute_force(given)


def test_late_day_before_the_active_start(spark):
    log = observed(spark, [(1, 5, "6")])
    got = scd2.rebuild_entities(scd2.build_versions(log), log, observed(spark, [(1, 2, "5", "early")]))
    assert rows(got, "itemname", "StartDate", "EndDate") == [("early", day(2), day(5)), ("early", day(5), None)]


def test_raw_rows_without_key_or_price_do_not_enter(spark):
    given = [
        ("1", "7", "01", "a", "5.9", "PriceFull7-1-x", stamp(0, 3)),
        ("1", "07", "1", "b", "5.90", "PriceFull7-1-y", stamp(0, 9)),  # the same store, later
        ("1", "7", "1", "c", "abc", "PriceFull7-1-z", stamp(1)),  # no price that day
        (None, "7", "1", "d", "5", "PriceFull7-1-z", stamp(1)),
        ("1", "07x", "1", "e", "5", "PriceFull7-1-z", stamp(1)),
        ("1", "7", "1", "f", "5", "PriceFull7-1-z", None),
        ("1", "7", "1", "g", "6", "Price7-1-z", stamp(2)),  # not a full file
    ]
    prices = spark.createDataFrame(given, RAW)
    chosen = scd2.full_files(prices)
    daily = scd2.daily_observations(chosen)
    assert rows(daily, "itemname", "itemprice", "file_date") == [("b", Decimal("5.9000"), day(0))]
    assert rows(scd2.rejected_observations(chosen), "itemname") == [("d",), ("e",), ("f",)]
    assert rows(scd2.full_files(prices, chain="07"), "itemname") == [("b",)]


def test_equal_prices_in_different_spelling_are_no_change(spark):
    given = [("1", "7", "1", "a", p, "PriceFull", stamp(i)) for i, p in enumerate(["5.9", "5.90", "05.9"])]
    history = scd2.build_versions(scd2.daily_observations(spark.createDataFrame(given, RAW)))
    assert rows(history, "StartDate", "EndDate") == [(day(0), None)]


def test_as_of_equals_brute_force(spark):
    given = random_history(3)
    history = scd2.build_versions(observed(spark, given))
    wanted = [(i, 7, 1, day(n)) for i in range(7) for n in range(-2, 28, 3)] + [(1, 7, 1, day(9))] * 50
    probes = spark.createDataFrame(wanted, KEY + ", as_of date")
    versions = brute_force(given)

    def price(item, d):
        return next((v[2] for v in versions if v[0] == item and v[3] <= d and (v[4] is None or d < v[4])), None)

    assert rows(as_of(probes, history), "itemcode", "as_of", "itemprice") == sorted(
        ((i, d, price(i, d)) for i, _, _, d in wanted), key=repr
    )
    on_day = {v[0]: v[2] for v in versions if v[3] <= day(9) and (v[4] is None or day(9) < v[4])}
    assert rows(valid_on(history, F.lit(day(9))), "itemcode", "itemprice") == sorted(on_day.items(), key=repr)


def test_violations_are_found(spark):
    good = scd2.build_versions(observed(spark, [(1, 0, "5"), (1, 3, "6"), (2, 0, "5")]))
    bad = good.unionByName(good.filter("IsActive = 1 AND itemcode = 1").withColumn("StartDate", F.lit(day(1))))
    got = history_violations(bad).first()
    assert got.n_not_one_active == 1 and got.n_overlaps >= 1
    with pytest.raises(ValueError, match="n_overlaps"):
        fail_above(history_violations(bad), "n_overlaps", 0)
    fail_above(history_violations(good), "n_overlaps", 0)
