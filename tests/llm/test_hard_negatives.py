"""Hard negatives against SQL on the given table and plain Python on odd rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from changeflow.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<double>, label int"


def plain(rows, positives=5, k=10, low=30, high=90):
    good = [
        (v, [math.floor(256 * x) for x in e], l)
        for v, e, l in rows
        if v is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, (a, e, l) in enumerate(good):
        if a % 100:
            continue
        scores = [(sum(x * y for x, y in zip(e, f)), v, m, j) for j, (v, f, m) in enumerate(good) if j != i and len(f) == len(e)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, *_ in [s for s in scores if s[2] == l][:positives]:
            found = [s for s in scores if s[2] != l and low * p <= 100 * s[0] <= high * p][:k]
            out += [(a, pid, r, s[1], p, s[0]) for r, s in enumerate(found, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, duck, sf):
    columns, want = duck(hn.SQL, f"/root/testdata/{sf}")
    got = hn.query(spark, f"/root/testdata/{sf}")
    assert got.columns == columns
    assert rows_of(got) == sorted(want) and want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_odd_vectors(spark, seed):
    random.seed(seed)
    rows = [(i * 10, [random.choice([-1.0, 0.0, 0.25, 0.5, 1.0, 2.0]) for _ in range(4)], random.choice([0, 0, 0, 1, 2, None])) for i in range(160)]
    rows += rows[:12] * 3  # repeated rows
    rows += [(0, [0.0] * 4, 0), (100, [1.0, 1.0], 0), (101, [0.5, 0.5], 1), (105, [0.7, 0.9], 0), (200, [], 0), (300, None, 1)]
    rows += [(None, [1.0] * 4, 0), (400, [None, 1.0, 1.0, 1.0], 0), (500, [math.inf, 1.0, 1.0, 1.0], 0), (600, [math.nan] * 4, 0)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(5)
    clash = vectors.withColumn("row", F.lit("x")).withColumn("limits", F.lit(1)).withColumn("score", F.lit(None).cast("string"))
    got = rows_of(hn.mined(clash, "vec_id % 100 = 0"))
    assert got == plain(rows) and got


def test_no_rows(spark):
    assert hn.mined(spark.createDataFrame([], VECTORS), "vec_id % 100 = 0").count() == 0


def test_large_components_are_exact(spark):
    rows = [(i, [1e13 + i, 3.0], i % 2) for i in range(0, 300, 20)]
    assert rows_of(hn.mined(spark.createDataFrame(rows, VECTORS).selectExpr("vec_id", "transform(embedding, x -> x / 1e6) AS embedding", "label"), "vec_id % 100 = 0")) == plain(
        [(v, [x / 1e6 for x in e], l) for v, e, l in rows]
    )


def test_slots_and_their_merges():
    """Overlapping and equal windows answered from disjoint slots, against filtering all scores."""
    random.seed(4)
    for _ in range(200):
        uppers = sorted((random.randint(0, 20) for _ in range(random.randint(1, 5))), reverse=True)
        windows = [{"upper": u, "lower": u - random.randint(0, 12), "n": i} for i, u in enumerate(uppers)]
        scores = [(random.randint(-5, 25), i) for i in range(random.randint(0, 40))]
        slots = hn.slots_of(hn.np.array([[s for s, _ in scores]]), hn.np.array([uppers + [hn.LOWEST] * (5 - len(uppers))]))[0]
        held = {}
        for (s, i), slot in sorted(zip(scores, slots.tolist()), key=lambda x: (-x[0][0], x[0][1])):
            if slot >= 0 and len(held.setdefault(slot, [])) < 3:
                held[slot].append({"slot": slot, "score": s, "vec_id": i, "row": i})
        got = {w["n"]: [(-x[0], x[1]) for x in best] for w, best in hn.suffix_merged(windows, sum(held.values(), []), 5, 3)}
        for w in windows:
            want = sorted(((s, i) for s, i in scores if w["lower"] <= s <= w["upper"]), key=lambda x: (-x[0], x[1]))[:3]
            assert got[w["n"]] == want
