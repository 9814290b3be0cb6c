import random

import numpy as np
import pytest

from matchlens.operators import calibrate
from matchlens.operators import rows as rows_module
from matchlens.operators.rows import element_means, mask_rows, rank_first, top_rows


def text_of(rows):
    lines = []
    for i, (name, score, win, pick, ban) in enumerate(rows, 1):
        lines += [str(i), "0", name, "탑", str(score), "1.5", f"{win}%", f"{pick}%", f"{ban}%", "1,234"]
    return "\n".join(lines) + "\n"


def sample(n, seed):
    rng = random.Random(seed)
    return [
        (f"c{i}", round(rng.uniform(40, 60), 2), round(rng.uniform(45, 55), 2), round(rng.uniform(0.5, 15), 2), round(rng.uniform(0, 30), 2))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def records(spark):
    texts = [("TOP", text_of(sample(40, 1))), ("MID", text_of(sample(25, 2)) + "1\n0\ncut off")]
    frame = spark.createDataFrame(texts, "position string, value string")
    return calibrate.parse_records(frame, by=["position"]).cache()


def test_records(records):
    rows = records.where("position = 'MID'").orderBy("ordinal").collect()
    assert len(rows) == 25
    first = sample(25, 2)[0]
    assert (rows[0].name, rows[0].score, rows[0].win_rate, rows[0].pick_rate, rows[0].ban_rate) == first


def test_text_without_a_whole_record(spark):
    frame = spark.createDataFrame([("1\n2",), ("",), (None,)], "value string")
    assert calibrate.parse_records(frame).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_fit_equals_least_squares(records, version):
    made = calibrate.features(records, ["position"], version)
    fitted = {r.position: r for r in calibrate.fit(made, ["position"]).collect()}
    for position in ("TOP", "MID"):
        rows = made.where(made.position == position).collect()
        n = len(rows)
        scale = np.log(200 / n) if version == 1 else np.sqrt(200 / n)
        x2 = [np.log(r.pick_rate / (1 - r.ban_rate / 100) / (200 / n)) / scale for r in rows]
        assert np.allclose([r.x2 for r in rows], x2)
        design = np.array([[1, r.win_rate - 50, x] for r, x in zip(rows, x2, strict=True)])
        best = np.linalg.lstsq(design, np.array([r.score for r in rows]), rcond=None)[0]
        got = fitted[position]
        assert np.allclose([got.intercept, got.b1, got.b2], best)


def test_dependent_features_get_the_smallest_coefficients(spark):
    rows = [("a", float(x), 2.0 * x, 3.0 + 5 * x) for x in range(6)] + [("b", 1.0, 1.0, 7.0)] * 3
    fitted = calibrate.fit(spark.createDataFrame(rows, "k string, x1 double, x2 double, score double"), ["k"])
    found = {r.k: (r.intercept, r.b1, r.b2) for r in fitted.collect()}
    assert np.allclose(found["a"], (3, 1, 2)) and np.allclose(found["b"], (7, 0, 0))


def test_ranks_side_by_side(records):
    rows = calibrate.compare_ranks(records, ["position"]).where("position = 'TOP'").collect()
    assert [r.predict_rank for r in rows] == list(range(1, 41))
    by_score = sorted(rows, key=lambda r: r.score_rank)
    assert [r.score for r in by_score] == sorted((r.score for r in rows), reverse=True)


@pytest.mark.parametrize("part_rows", [50, 1_000_000])
def test_rank_first_with_ties_and_nulls(spark, monkeypatch, part_rows):
    monkeypatch.setattr(rows_module, "PART_ROWS", part_rows)
    rng = random.Random(5)
    rows = [
        (rng.choice("ab"), None if rng.random() < 0.05 else float(rng.choice([1, 1, 1, rng.randrange(50)])), i)
        for i in range(600)
    ]
    frame = spark.createDataFrame(rows, "g string, v double, i bigint")
    found = {r.i: r.place for r in rank_first(frame, "v", "i", "place", ["g"]).collect()}
    for group in "ab":
        ordered = sorted(
            (r for r in rows if r[0] == group), key=lambda r: (r[1] is None, -(r[1] or 0), r[2])
        )
        assert [found[r[2]] for r in ordered] == list(range(1, len(ordered) + 1))


def test_rank_of_a_whole_frame(spark):
    frame = spark.range(100).selectExpr("id", "id % 7 AS v")
    rows = rank_first(frame, "v", "id", "place").orderBy("place").collect()
    assert [(r.v, r.id) for r in rows] == sorted(((i % 7, i) for i in range(100)), key=lambda p: (-p[0], p[1]))


def test_rank_of_text_values_without_a_nested_loop(spark):
    frame = spark.createDataFrame([("a", "x", "2"), ("a", "y", "1"), (None, "x", "3"), ("a", "x", "1"), (None, None, "1")], "g string, v string, o string")
    ranked = rank_first(frame, "v", "o", "place", ["g"])
    assert {(r.g, r.v, r.o): r.place for r in ranked.collect()} == {
        ("a", "y", "1"): 1, ("a", "x", "1"): 2, ("a", "x", "2"): 3, (None, "x", "3"): 1, (None, None, "1"): 2,
    }
    plan = rank_first(frame, "v", "o", "place")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_mask_and_top(spark):
    frame = spark.createDataFrame([("x", 1), ("y", 5), ("x", 3)], "k string, v int")
    masked = sorted(map(tuple, mask_rows(frame, frame.k == "x").collect()), key=str)
    assert masked == [("x", 1), ("x", 3), (None, None)]
    assert [tuple(r) for r in top_rows(frame, "v", 2).collect()] == [("y", 5), ("x", 3)]


def test_element_means(spark):
    frame = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],)], "vec array<double>")
    assert sorted((r.idx, r.mean) for r in element_means(frame, "vec").collect()) == [(0, 2.0), (1, 4.0)]
