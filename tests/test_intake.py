import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwatch.operators import bloom
from shelfwatch.sinks.tables import delete_path, finished_versions
from shelfwatch.streaming import intake
from tests.conftest import rows

LISTING = "path string, length long"


def listing(spark, names, length=10):
    return spark.createDataFrame([(n, length) for n in names], LISTING)


def names(*numbers):
    return [f"in/Price{n}.gz" for n in numbers]


# ---- filter -------------------------------------------------------------------------------------


def test_filter_rules_out_most_others_and_nothing_that_is_in(spark):
    inside, outside = (spark.range(a, b).select(F.concat(F.lit("f"), "id").alias("path")) for a, b in ((0, 20_000), (20_000, 60_000)))
    blocks = bloom.blocks_for(20_000)
    made = bloom.filter_of(inside, "path", blocks)
    assert bloom.split(inside, "path", made, blocks).filter("maybe").count() == 20_000
    assert bloom.split(outside, "path", made, blocks).filter("maybe").count() < 0.02 * 40_000
    parts = bloom.filter_of(inside.filter("path < 'f4'"), "path", blocks).union(bloom.filter_of(inside.filter("path >= 'f4'"), "path", blocks))
    assert rows(bloom.merged(parts)) == rows(made)


def test_filter_of_nothing_and_null_names(spark):
    blocks = bloom.blocks_for(0)
    made = bloom.filter_of(listing(spark, [None]), "path", blocks)
    assert made.count() == 0
    assert not bloom.split(listing(spark, ["a", None]), "path", made, blocks).filter("maybe").count()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9))
def test_filter_size_follows_the_number_of_names(n):
    blocks = bloom.blocks_for(n)
    assert blocks & (blocks - 1) == 0
    assert blocks * bloom.BLOCK_BITS >= n * bloom.BITS_PER_NAME and (blocks == 1 or blocks * bloom.BLOCK_BITS < 2 * n * bloom.BITS_PER_NAME + 512)


# ---- batches ------------------------------------------------------------------------------------


def test_plans_hold_every_file_once(spark, folder):
    rng = random.Random(1)
    known, day = set(), 0
    for size in (0, 30, 5, 200, 3):
        listed = set(names(*(rng.randrange(400) for _ in range(size)))) | {n for n in known if rng.random() < 0.7}
        before = intake.planned(spark, folder)
        assert rows(intake.unseen(listing(spark, listed), folder), "path") == sorted((n,) for n in listed - known)
        backlog = intake.plan(listing(spark, [*listed, *list(listed)[:3]]), folder)
        assert backlog == {"files": len(listed - known), "bytes": 10 * len(listed - known)}
        new = [b for b in intake.planned(spark, folder) if b not in before]
        assert len(new) == bool(listed - known)
        if new:
            assert rows(intake.names(spark, folder, new), "path") == sorted((n,) for n in listed - known)
        known |= listed
        day += 1
    assert intake.names(spark, folder).count() == len(known)
    assert len(finished_versions(spark, f"{folder}/filter")) <= 2


def test_filter_is_made_anew_when_it_gets_too_small(spark, folder):
    sizes = []
    for n in range(4):
        intake.plan(listing(spark, names(*range(100 * 4**n))), folder)
        assert intake.unseen(listing(spark, names(*range(100 * 4**n), "x")), folder).count() == 1
        sizes.append(intake._refresh(spark, folder)[1])
    assert sizes == [bloom.blocks_for(100 * 4**n) for n in range(4)]


@pytest.mark.parametrize("part", [100_000, 7])
def test_batches_are_bounded(spark, folder, monkeypatch, part):
    monkeypatch.setattr(intake, "NAMES_PER_PART", part)
    sizes = [(f"f{n:03}", (n * 37) % 50 + 1) for n in range(100)] + [("huge", 1000), ("none", 0)]
    backlog = intake.plan(spark.createDataFrame(sizes, LISTING), folder, max_bytes=200, max_files=20)
    assert backlog == {"files": 102, "bytes": sum(n for _, n in sizes)}
    got = intake.names(spark, folder).groupBy("batch").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.max("length").alias("last"))
    got = sorted(tuple(r) for r in got.collect())
    assert [b for b, *_ in got] == list(range(len(got))) and len(got) >= 12
    assert all(n <= 20 and size <= 200 + last for _, n, size, last in got)
    assert rows(intake.names(spark, folder), "path", "length") == sorted(sizes)


def test_what_was_planned_and_lost_is_done_again(spark, folder):
    intake.plan(listing(spark, names(1, 2)), folder)
    intake.plan(listing(spark, names(1, 2, 3)), folder)
    assert intake.pending(spark, folder, []) == [0, 1]
    assert intake.pending(spark, folder, [0]) == [1]
    assert intake.plan(listing(spark, names(1, 2, 3)), folder) == {"files": 0, "bytes": 0}
    assert rows(intake.names(spark, folder, [1]), "path") == [("in/Price3.gz",)]
    # A filter that was lost, or never written, is made from the names.
    delete_path(spark, f"{folder}/filter")
    assert intake.unseen(listing(spark, names(1, 2, 3, 4)), folder).count() == 1


def test_asking_a_filter_hashes_a_name_once_per_purpose(spark):
    """The condition held the name's words, each with six hashes, twice."""
    inside = spark.range(1000).select(F.concat(F.lit("f"), "id").alias("path"))
    blocks = bloom.blocks_for(1000)
    asked = bloom.split(inside, "path", bloom.filter_of(inside, "path", blocks), blocks).filter("maybe")
    assert asked.count() == 1000
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Aggregate")]  # what is asked, not how the filter is made
    assert above.count("xxhash64") <= 6, above[:3000]
