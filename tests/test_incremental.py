"""Arrivals one by one against the batch run over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import match
from recordloom.operators.dedupe import first_by_key
from recordloom.sources import store
from recordloom.streaming import incremental
from recordloom.streaming.incremental import Standing

LEFT = "_ord long, ingredient_code string, std_name_en string, cas_no string"
RIGHT = "_ord long, inci_name string, cas_no string, substance_id string"
PAYLOAD = ("inci_name", "cas_no", "substance_id")


def registries(seed, n=90):
    """Names that match by every stage, by likeness or not; keys that null names shadow; codes that come twice."""
    rng = random.Random(seed)
    words = ["sodium", "zinc", "oxide", "chloride", "extract", "oil", "acid", "leaf", "root", "water"]
    name = lambda: " ".join(rng.choices(words, k=rng.randint(3, 6)))
    right = [(k, rng.choice([name(), name(), None]), rng.choice(["-", f"{rng.randint(1, 9)}-1", None]), f"S{k}") for k in range(n)]

    def turned(t):
        how = rng.randrange(7)
        t = t or "none"
        return [t, t.upper(), t.replace(" ", "-"), " ".join(reversed(t.split())), t[:3] + t[4:], t[:2] + t[5:], "x" + t + " unlike"][how]

    left = [(k, f"c{rng.randint(0, n)}", turned(rng.choice(right)[1]), rng.choice(["-", f"CAS No. {rng.randint(1, 14)}-1"])) for k in range(n)]
    return left, right


def view(rows):
    return sorted(((r.ingredient_code, r.std_name_en, r.status, r.match_type, r.match_score, r.candidate_score, r.hit and r.hit.substance_id) for r in rows.collect()), key=str)


def whole(spark, left, right):
    keyed = match.with_keys(first_by_key(spark.createDataFrame(left, LEFT), "ingredient_code"), "std_name_en", "cas_no")
    return view(match.routed(keyed, match.with_keys(spark.createDataFrame(right, RIGHT), "inci_name", "cas_no"), "inci_name", PAYLOAD))


@pytest.mark.parametrize("seed", [1, 2])
def test_three_arrivals_equal_the_full_run(spark, tmp_path, seed):
    left, right = registries(seed)
    standing, cuts = Standing(spark, f"file://{tmp_path}/s"), [0, 20, 55, 90]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        standing.arrive(k, spark.createDataFrame(left[a:b], LEFT), spark.createDataFrame(right[a:b], RIGHT))
        assert view(standing.routed(PAYLOAD)) == whole(spark, left[:b], right[:b])
    got = view(standing.routed(PAYLOAD))
    assert {r[2] for r in got} >= {"matched", "unmatched"} and {r[3] for r in got} >= {"fuzzy_auto", "exact_cas"} and len({r[3] for r in got}) > 4
    standing.arrive(2, spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT))  # taken in already
    assert view(standing.routed(PAYLOAD)) == got
    with pytest.raises(ValueError, match="comes after"):
        Standing(spark, standing.path).arrive(-1, spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT))


def test_an_arrival_that_breaks_is_repeated(spark, tmp_path, monkeypatch):
    left, right = registries(3)
    standing = Standing(spark, f"file://{tmp_path}/s")
    standing.arrive(0, spark.createDataFrame(left[:40], LEFT), spark.createDataFrame(right[:40], RIGHT))
    real = store.landed

    def breaks(rows, path=None):
        out = real(rows, path)
        if path and "/hits/" in path:
            raise OSError("gone")
        return out

    monkeypatch.setattr(incremental.store, "landed", breaks)
    with pytest.raises(OSError):
        standing.arrive(1, spark.createDataFrame(left[40:], LEFT), spark.createDataFrame(right[40:], RIGHT))
    monkeypatch.setattr(incremental.store, "landed", real)
    assert view(standing.routed(PAYLOAD)) == whole(spark, left[:40], right[:40])
    standing.arrive(1, spark.createDataFrame(left[40:], LEFT), spark.createDataFrame(right[40:], RIGHT))
    assert view(standing.routed(PAYLOAD)) == whole(spark, left, right)


def test_only_what_can_change_is_matched_again(spark, tmp_path, monkeypatch):
    left, right = registries(4)
    standing, seen = Standing(spark, f"file://{tmp_path}/s"), []
    standing.arrive(0, spark.createDataFrame(left, LEFT), spark.createDataFrame(right[:80], RIGHT))
    real = match.best_fuzzy
    monkeypatch.setattr(match, "best_fuzzy", lambda keys, texts, *rest: seen.append((keys.count(), texts.count())) or real(keys, texts, *rest))
    standing.arrive(1, spark.createDataFrame([], LEFT), spark.createDataFrame(right[80:], RIGHT))
    (_, new), (fresh, _) = seen
    assert new <= 10 and fresh == 0
    standing.arrive(2, spark.createDataFrame([(0, "new", left[0][2] + "zz", "-")], LEFT), spark.createDataFrame([], RIGHT))
    assert seen[2][1] == 0 and seen[3][0] <= 1


def test_following_two_folders(spark, tmp_path):
    left, right = registries(5)
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    standing = Standing(spark, f"file://{tmp_path}/s")

    def go(side):
        standing.follow(side, f"{tmp_path}/{side}", a.schema, b.schema, f"{tmp_path}/cp-{side}").awaitTermination()

    for lo, hi in ((0, 50), (50, 90)):
        a.where(F.col("_ord").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/left")
        b.where(F.col("_ord").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/right")
        go("right")
        go("left")
    go("left")  # nothing new
    assert view(standing.routed(PAYLOAD)) == whole(spark, left, right)
    assert standing.arrivals() == [0, 1, 2, 3]
