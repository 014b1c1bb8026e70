import math
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import similarity as sim
from recordloom.functions.similarity import common_length, common_lengths, indel_similarity, places, similarity, similarity_of
from recordloom.operators import fuzzy, match, project
from recordloom.queries import left_registry, right_registry


def lcs_table(a: str, b: str) -> int:
    line = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(line[j] + 1 if x == y else max(line[j + 1], new[-1]))
        line = new
    return line[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", max_size=12), st.text("abcé", max_size=12))
def test_lcs_equals_table(a, b):
    assert common_lengths([a, b], [b, "a"])[0] == lcs_table(a, b)


def test_lcs_of_blocks_of_pairs(monkeypatch):
    """Texts of very unlike lengths, in blocks of a few pairs each."""
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdé😀", k=rng.choice([0, 1, 3, 30, 90]))) for _ in range(160)]
    a, b = texts[:80], texts[80:]
    want = [lcs_table(x, y) for x, y in zip(a, b)]
    assert common_lengths(a, b).tolist() == want
    monkeypatch.setattr(sim, "CELLS", 200)
    assert common_lengths(a, b).tolist() == want


def test_score_of_known_pairs():
    assert indel_similarity("a" * 9 + "b", "a" * 9) == (1 - 1 / 19) * 100
    assert indel_similarity("a" * 19 + "b", "a" * 19 + "c") == 95.0
    assert indel_similarity("a" * 9 + "b", "a" * 9 + "c") == 90.0


def test_scores_of_the_jvm_equal_those_in_arrow(spark):
    """Texts within a word of bits, at its edges, and of several words."""
    rng = random.Random(5)
    text = lambda: "".join(rng.choices("abcd é😀", k=rng.choice([0, 1, 2, 9, 30, 61, 62, 63, 64, 123, 124, 125, 186, 200])))
    pairs = [(text(), text()) for _ in range(250)] + [("a" * 62, "a" * 62), ("a" * 124, "a" * 125), ("ab" * 90, "ba" * 90), (None, "a"), ("a", None)]
    pairs += [(a, a[: k // 2] + "x" + a[k // 2 + 1 :]) for a, _ in pairs[:80] if (k := len(a)) > 2]
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("p", places(F.col("b")))
    got = rows.select("a", "b", common_length(F.col("a"), F.col("b"), F.col("p")).alias("n"), similarity("a", "b").alias("x"), similarity_of(F.col("a"), F.col("b"), F.col("p")).alias("y")).collect()
    for r in got:
        assert r.x == r.y, (r.a, r.b)
        assert r.a is None or r.b is None or r.n == lcs_table(r.a, r.b)


@pytest.mark.parametrize("cutoff", [80, 90, 95])
def test_blocking_loses_no_pair(spark, cutoff):
    rng = random.Random(cutoff)
    base = ["".join(rng.choices("abcdef ", k=rng.randint(1, 26))).strip() or "x" for _ in range(60)]

    def edit(t: str) -> str:
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(t))
            t = t[:k] + rng.choice("abcdef") + t[k + rng.randint(0, 1) :]
        return t

    left, right = sorted({edit(t) for t in base} | {edit(t) for t in base}), sorted(set(base))
    got = {(r.a, r.b) for r in fuzzy.candidate_pairs(spark.createDataFrame([(x,) for x in left], "a string"), spark.createDataFrame([(x,) for x in right], "b string"), cutoff).collect()}
    want = {(a, b) for a in left for b in right if indel_similarity(a, b) >= cutoff}
    assert want and want <= got


@pytest.mark.parametrize("cutoff", [85, 90])
def test_blocking_of_long_and_odd_texts(spark, cutoff):
    """Texts of many edits, of characters that only one side has, and of characters beyond 16 bits; by projections and by pieces."""
    rng = random.Random(cutoff)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789 -\\]^[é가나😀😁"
    base = ["".join(rng.choices(letters, k=rng.choice([1, 2, 9, 40, 90, 180]))) for _ in range(50)] + ["😀" * 20, "😀" * 19 + "😁", "a" * 30]

    def edit(t: str) -> str:
        for _ in range(rng.randint(0, max(1, len(t) // 9))):
            k = rng.randint(0, len(t))
            t = t[:k] + rng.choice(letters + "Ω漢") + t[k + rng.randint(0, 1) :]
        return t

    left, right = sorted({edit(t) for t in base for _ in range(3)}), sorted(set(base))
    sides = spark.createDataFrame([(x,) for x in left], "a string"), spark.createDataFrame([(x,) for x in right], "b string")
    got = {(r.a, r.b) for r in fuzzy.candidate_pairs(*sides, cutoff).collect()}
    want = {(a, b) for a in left for b in right if indel_similarity(a, b) >= cutoff}
    assert len(want) > 60 and want <= got
    assert fuzzy.candidate_pairs(sides[0].where("false"), sides[1], cutoff).count() == 0
    assert fuzzy.candidate_pairs(sides[0], sides[1].where("false"), cutoff).count() == 0


def test_characters_are_dealt_by_what_they_tell(spark):
    rows = spark.createDataFrame([("xa1",), ("xb1",), ("xc2",), ("xaa2",)], "b string")
    letters, longest = fuzzy.survey(rows, "b")
    assert longest == 4 and [c for c, _ in letters] == ["a", "1", "2", "b", "c"]  # x tells nothing
    assert letters[0][1] == pytest.approx(1.5 * math.log(2)) and letters[1][1] == pytest.approx(math.log(2))
    assert fuzzy.deal(letters, 2) == ["ab", "12c"]


def registries(spark, sf_dir):
    key = "key_full"
    left = match.with_keys(left_registry(spark, sf_dir), "std_name_en", "cas_no").select(F.col(key).alias("a")).distinct()
    right = match.with_keys(right_registry(spark, sf_dir), "inci_name", "cas_no").select(F.col(key).alias("b")).distinct()
    return left, right


def test_few_pairs_are_compared(spark):
    """Names of a small vocabulary: what is compared inside the join stays below 2 % of all pairs, and no key has 1 % of it."""
    shares = []
    for sf in os.environ.get("TEST_SIZES", "0.01").split(","):
        left, right = registries(spark, f"/root/testdata/sf{sf}")
        total, hottest = fuzzy.comparisons(left, right, 90).agg(F.sum("pairs"), F.max("pairs")).first()
        shares.append(total / (left.count() * right.count()))
        print(sf, "compared", total, f"{shares[-1]:.3%}", "hottest key", hottest)
        assert shares[-1] < 0.02 and hottest < 0.01 * total
    assert shares == sorted(shares, reverse=True)


def test_blocking_keeps_few_pairs(spark, sf_dir):
    """Hardly any pair that only shares a key becomes a row."""
    left, right = registries(spark, sf_dir)
    assert 100 * fuzzy.candidate_pairs(left, right, 90).count() <= 2 * left.count() * right.count()


def test_fuzzy_ties_go_to_the_first_candidate(spark):
    left = spark.createDataFrame([("abcdefghijklmnopqrst",)], "key string")
    right = spark.createDataFrame([("abcdefghijklmnopqrsx", 9), ("abcdefghijklmnopqrsy", 3)], "key string, _ord long")
    assert match.best_fuzzy(left, right, 90).first().candidate.endswith("y")


def test_best_matches_with_and_without_python(spark, sf_dir):
    left, right = registries(spark, sf_dir)
    left, right = left.withColumnRenamed("a", "key"), right.select(F.col("b").alias("key"), F.xxhash64("b").alias("_ord"))
    a, b = (sorted(tuple(r) for r in match.best_fuzzy(left, right, 90, python).collect()) for python in (True, False))
    assert a == b and len(a) > 20
    assert "similarity(" not in match.best_fuzzy(left, right, 90, False)._jdf.queryExecution().executedPlan().toString()


def test_every_row_has_one_route(spark, sf_dir):
    left, right = match.with_keys(left_registry(spark, sf_dir), "std_name_en", "cas_no"), match.with_keys(right_registry(spark, sf_dir), "inci_name", "cas_no")
    rows = match.routed(left, right, "inci_name", project.PAYLOAD)
    assert rows.count() == left.count() == rows.select("_ord").distinct().count()
    assert rows.where("(status = 'matched') <> (match_type IS NOT NULL)").isEmpty()


def test_auto_below_review_leaves_nothing_to_review(spark, sf_dir):
    left, right = match.with_keys(left_registry(spark, sf_dir), "std_name_en", "cas_no"), match.with_keys(right_registry(spark, sf_dir), "inci_name", "cas_no")
    assert match.routed(left, right, "inci_name", project.PAYLOAD, match.Thresholds(90, 95)).where("status = 'review'").isEmpty()


def test_a_nameless_first_row_shadows_later_ones(spark):
    left = match.with_keys(spark.createDataFrame([(1, None, "1-1")], "_ord long, n string, c string"), "n", "c")
    right = match.with_keys(spark.createDataFrame([(1, None, "1-1"), (2, "later", "1-1")], "_ord long, n string, c string"), "n", "c")
    assert match.cascade(left, right, "n", ("c",)).first().hit is None


def test_empty_sides(spark):
    shape = "_ord long, n string, c string"
    some = match.with_keys(spark.createDataFrame([(1, "some name", "1-1")], shape), "n", "c")
    none = match.with_keys(spark.createDataFrame([], shape), "n", "c")
    assert match.routed(some, none, "n", ("c",)).first().status == "unmatched"
    assert match.routed(none, some, "n", ("c",)).count() == 0


def test_only_texts_without_a_nearer_partner_reach_the_last_cutoff(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "FEW", 0)
    rng = random.Random(5)
    right = ["".join(rng.choices("abcdefgh 0123", k=30)) for _ in range(60)]
    near, far = [t[:7] + t[8:] for t in right[:20]], [t[:5] + t[9:] for t in right[20:40]]  # one and four characters less
    a, b = (spark.createDataFrame([(t,) for t in texts], f"{c} string") for c, texts in (("a", near + far + ["zzz"]), ("b", right)))
    met = {}

    def best(pairs, at):
        met[at] = {r.a for r in pairs.collect()}
        return pairs.withColumn("score", similarity("a", "b")).where(F.col("score") >= at).groupBy("a").agg(F.max("score").alias("score"))

    got = {r.a: r.score for r in fuzzy.best_of_rounds(a, b, 90, best).collect()}
    assert fuzzy.rounds(90) == [97, 94, 90] and set(near) <= met[97] and not set(near) & met[90] and set(far) <= met[90]
    assert got == {x: s for x in near + far if (s := max(indel_similarity(x, y) for y in right)) >= 90} and len(got) == 40


def test_common_lengths_at_the_edges_of_a_word():
    rng = random.Random(6)
    for letters in ("ab", "abcdefgh 0123", "aé漢😀�\xfd\xfe\xff"):
        pairs = [["".join(rng.choices(letters, k=rng.choice([0, 1, 30, 63, 64, 65, 100]))) for _ in range(2)] for _ in range(150)]
        assert common_lengths(*map(list, zip(*pairs))).tolist() == [lcs_table(a, b) for a, b in pairs]
