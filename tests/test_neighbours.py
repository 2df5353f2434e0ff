import numpy as np
import pytest

from tableloom.operators import neighbours
from tableloom.operators.neighbours import NeighbourFill, fill_from_neighbours


def brute_force(rows: np.ndarray, k: int) -> np.ndarray:
    filled = rows.copy()
    n, d = rows.shape
    for i in range(n):
        for c in np.flatnonzero(np.isnan(rows[i])):
            found = []
            for j in range(n):
                if np.isnan(rows[j, c]):
                    continue
                both = ~np.isnan(rows[i]) & ~np.isnan(rows[j])
                if both.any():
                    total = 0.0
                    for gap in (rows[i] - rows[j])[both]:
                        total += gap * gap
                    found.append((total * (d / both.sum()), rows[j, c]))
            found.sort()
            filled[i, c] = np.mean([v for _, v in found[:k]]) if found else np.nanmean(rows[:, c])
    return filled


def check(spark, rows: np.ndarray, k: int = 5):
    names = [f"c{j}" for j in range(rows.shape[1])]
    data = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(["id int", *[f"{c} double" for c in names]])).repartition(3)
    got = {r["id"]: [r[c] for c in names] for r in fill_from_neighbours(df, names, k).collect()}
    expected = brute_force(rows, k)
    assert len(got) == len(rows)
    for i in range(len(rows)):
        assert got[i] == pytest.approx(expected[i].tolist(), rel=1e-9), i


def gappy(n: int, d: int, share: float, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    rows = draw.normal(size=(n, d)) * [10.0 ** (j % 2) for j in range(d)]
    rows[draw.random((n, d)) < share] = np.nan
    return rows


def test_one_cell(spark):
    check(spark, gappy(80, 3, 0.15, 1))


def test_many_cells_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_DONORS", 10)
    monkeypatch.setattr(neighbours, "DONOR_CHUNK", 7)
    monkeypatch.setattr(neighbours, "ITEM_CHUNK", 5)
    check(spark, gappy(300, 3, 0.2, 2))


def test_cells_that_mix_missing_columns(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_DONORS", 10)
    monkeypatch.setattr(neighbours, "MAX_CELLS", 3)
    check(spark, gappy(120, 4, 0.3, 3))


def clustered(n: int, d: int, share: float, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(25, d)) * 10
    rows = centers[draw.integers(0, 25, n)] + draw.normal(size=(n, d))
    rows[draw.random((n, d)) < share] = np.nan
    return rows


def test_thirty_columns_with_gaps_meet_few_donors(spark, monkeypatch):
    """Nearly every row has its own pattern of gaps: cells around chosen donors, and under a tenth of all pairs."""
    monkeypatch.setattr(neighbours, "MAX_CELLS", 100)
    monkeypatch.setattr(neighbours, "PIVOT_DONORS", 10)
    rows = clustered(900, 30, 0.1, 8)
    check(spark, rows)
    names = [f"c{j}" for j in range(30)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in rows], ", ".join(f"{c} double" for c in names))
    fill = NeighbourFill(df, tuple(names))
    receivers = df.select(neighbours._row_id(names).alias("rid"), neighbours._vector(names).alias("x")).where("exists(x, v -> isnan(v))")
    _, first, rest = fill._rounds(receivers)
    _, cells = fill.indexed
    size = dict(zip(cells.names, cells.distinct))
    compared = sum(size[r["_cell"]] * r["count"] for part in (first, rest) for r in part.groupBy("_cell").count().collect())
    assert len(cells.names) > 50 and 0 < compared < 0.1 * np.isnan(rows).sum() * len(rows)


def test_unclustered_columns_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MAX_CELLS", 20)
    monkeypatch.setattr(neighbours, "PIVOT_DONORS", 10)
    check(spark, gappy(150, 12, 0.3, 9))


def test_hot_copies_count_as_many_donors(spark):
    rows = gappy(90, 2, 0.0, 4)
    rows[:40] = [1.0, 2.0]
    rows[40:70] = [1.0, np.nan]
    check(spark, rows, k=7)


def test_hot_rows_with_gaps_are_salted(spark, monkeypatch):
    from tableloom.operators import levels

    monkeypatch.setattr(levels, "BROADCAST_LEVELS", 1)
    monkeypatch.setattr(neighbours, "BROADCAST_LEVELS", 1)
    rows = gappy(90, 3, 0.2, 5)
    rows[:40] = [1.0, np.nan, 3.0]
    check(spark, rows)


def test_too_few_donors_and_no_shared_column(spark):
    nan = np.nan
    check(spark, np.array([[1.0, nan], [2.0, nan], [nan, 4.0], [nan, 6.0], [3.0, 5.0], [nan, nan]]), k=5)


def test_plan_fills_another_table(spark):
    fitted = NeighbourFill(spark.createDataFrame([(1.0, 1.0), (2.0, 10.0)], "a double, b double"), ("a", "b"), 1)
    new = spark.createDataFrame([(1.9, None)], "a double, b double")
    assert fitted.transform(new).first()["b"] == 10.0
