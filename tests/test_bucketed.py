"""Bucketed volumes and what a write measures across block faces."""

import random

import pytest
from pyspark.sql import functions as F

from voxelflow.operators import affinity, stitch
from voxelflow.plans import stages
from voxelflow.plans.stages import Stage
from voxelflow.sources import bucketed
from voxelflow.sources import ledger as led

LABELS = "x bigint, y bigint, z bigint, label bigint"


def volume_of(spark, n, top, seed=1):
    rng = random.Random(seed)
    at = [(x, y, z) for x in range(n) for y in range(n) for z in range(n) if rng.random() < 0.8]
    return spark.createDataFrame([(*p, rng.randrange(top)) for p in at], LABELS)


def got(df):
    return sorted(map(tuple, df.collect()))


def violations(rows, b):
    vol, n = {tuple(r[:3]): r[3] for r in rows}, 0
    for p, lab in vol.items():
        for d in range(3):
            q = tuple(v + (i == d) for i, v in enumerate(p))
            n += lab != 0 and p[d] % b == b - 1 and vol.get(q) == lab
    return n


@pytest.mark.parametrize("b", [1, 2, 3])
def test_same_neighbours_count_the_violations(spark, b):
    v = volume_of(spark, 6, 3)
    per = stitch.with_same_neighbours(v, b)
    assert got(per.drop("same")) == got(v)
    n = per.agg(F.sum("same")).first()[0]
    assert n == violations(got(v), b) == stitch.same_label_violations(v, b).first()[0] > 0


def test_a_write_refuses_ids_that_touch_themselves(spark, tmp_path):
    path = str(tmp_path / "s")
    ledger, v = led.Ledger(spark, path), volume_of(spark, 6, 3)
    assert led.write_volume(ledger, v, path, "counted", 0, 2, unique_ids="count")["attrs"]["violations"] == str(violations(got(v), 2))
    assert got(led.open_volume(spark, path, "counted")) == got(v)
    with pytest.raises(ValueError, match="same id"):
        led.write_volume(ledger, v, path, "refused", 0, 2, unique_ids=True)
    with pytest.raises(RuntimeError, match="not marked complete"):
        led.open_volume(spark, path, "refused")
    dense = stitch.relabel_dense(v, 2, (6, 6, 6))
    assert led.write_volume(ledger, dense, path, "dense", 0, 2, unique_ids=True)["attrs"]["violations"] == "0"
    empty = v.filter("x < 0")
    assert led.write_volume(ledger, empty, path, "empty", 0, 2, unique_ids=True)["attrs"]["violations"] == "0"
    with pytest.raises(ValueError, match="whole"):
        led.write_volume(ledger, dense, path, "dense", 0, 2, whole=False, unique_ids=True)


def test_a_stage_with_violations_is_not_complete(spark, tmp_path):
    path, v = str(tmp_path / "s"), volume_of(spark, 4, 2)
    with pytest.raises(ValueError, match="same id"):
        stages.run(spark, path, [Stage("raw", ("v",), lambda a: a, unique_ids=True)], {"v": v}, 2)
    assert led.Ledger(spark, path).row("raw")["status"] == "running"
    out = stages.run(spark, path, [Stage("raw", ("v",), lambda a: stitch.relabel_dense(a, 2, (4, 4, 4)), unique_ids=True)], {"v": v}, 2)
    assert out["raw"].count() == v.count()


def test_bucketed_round_trip_versions_and_sessions(spark, tmp_path):
    path = str(tmp_path / "s")
    ledger, v = led.Ledger(spark, path), volume_of(spark, 6, 9)
    for top in (9, 5):
        v = volume_of(spark, 6, top)
        row = bucketed.write_bucketed(ledger, v, path, "labels", 2, 3)
        assert (row["status"], row["rows"], list(row["dims"])) == ("complete", v.count(), [6, 6, 6])
        stored = bucketed.open_bucketed(spark, path, "labels")
        assert got(stored.select("x", "y", "z", "label")) == got(v)
        assert stored.filter("bx <> x div 2 OR by_ <> y div 2 OR bz <> z div 2").isEmpty()
        assert len(stored.inputFiles()) <= 3
    folder = tmp_path / "s-buckets" / "labels" / "level=0"
    assert [p.name for p in folder.iterdir()] == ["version=2"]
    # another session finds the table by the ledger
    other = spark.newSession()
    spark.sql(f"DROP TABLE {bucketed._table(bucketed._location(path, 'labels', 0, 2))}")
    assert got(bucketed.open_bucketed(other, path, "labels").select("x", "y", "z", "label")) == got(v)
    ledger.claim("labels", 0, 2, "struct")
    with pytest.raises(RuntimeError, match="not marked complete"):
        bucketed.open_bucketed(spark, path, "labels")
    led.write_volume(ledger, v, path, "plain", 0, 2)
    with pytest.raises(ValueError, match="not bucketed"):
        bucketed.open_bucketed(spark, path, "plain")
    bucketed.write_bucketed(ledger, v.filter("x < 0"), path, "none", 2, 3)
    assert bucketed.open_bucketed(spark, path, "none").isEmpty()


def test_bucketed_operators_equal_the_plain_ones(spark, tmp_path):
    path, rng = str(tmp_path / "s"), random.Random(4)
    offsets = [(-1, 0, 0), (0, -3, 0), (2, 0, -1)]
    ledger, v = led.Ledger(spark, path), volume_of(spark, 7, 5)
    bucketed.write_bucketed(ledger, v, path, "labels", 2, 3)
    assert got(stitch.relabel_dense(bucketed.open_bucketed(spark, path, "labels"), 2, (7, 7, 7))) == got(
        stitch.relabel_dense(v, 2, (7, 7, 7)))
    at = [(x, y, z) for x in range(7) for y in range(7) for z in range(7)]
    aff = spark.createDataFrame([(*p, c, rng.random()) for p in at for c in range(3)], "x bigint, y bigint, z bigint, c bigint, a double")
    mask = spark.createDataFrame([(*p, int(rng.random() < 0.8)) for p in at if rng.random() < 0.9], "x bigint, y bigint, z bigint, m int")
    glia = spark.createDataFrame([(*p, 1.2 * rng.random()) for p in at if rng.random() < 0.9], "x bigint, y bigint, z bigint, g double")
    bucketed.write_bucketed(ledger, aff, path, "edges", 2, 3)
    bucketed.write_bucketed(ledger, affinity.voxel_weights(mask, glia), path, "weights", 2, 3, reach=affinity.reach(offsets))
    by_block = affinity.weight_edges_by_block(bucketed.open_bucketed(spark, path, "edges"), offsets,
                                              bucketed.open_bucketed(spark, path, "weights"))
    key = F.when(F.isnan("a"), F.lit(-1.0)).otherwise(F.col("a")).alias("a")
    assert got(by_block.select("x", "y", "z", "c", key)) == got(affinity.weight_edges(aff, offsets, mask, glia).select(
        "x", "y", "z", "c", key))
