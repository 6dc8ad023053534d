import numpy as np
import pytest

from viewtide.llm import whitening

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"
WIDE = np.longdouble


@pytest.fixture
def vectors(spark):
    def make(*rows):
        return spark.createDataFrame([(i, None if v is None else list(v), 0) for i, v in rows], SCHEMA)
    return make


def plain(rows, components=8):
    """Whitening by a plain float64 solver; signs are free."""
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float)).astype(int) + 100000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return ((n * x - sums) ** 2).sum(1), centred @ basis / np.sqrt(values), values


def random_rows(n=300, d=12, seed=1):
    rng = np.random.default_rng(seed)
    data = (rng.normal(size=(n, d)) * np.linspace(0.05, 0.4, d)).astype(np.float32)
    return [(i, row.tolist()) for i, row in enumerate(data)]


def test_equals_a_plain_solver(vectors):
    rows = random_rows()
    found = whitening.whiten(vectors(*rows).repartition(7)).toPandas()
    deviation, whitened, values = plain(rows)
    assert len(found) == len(rows) * 8 and (found["n"] == len(rows)).all()
    table = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(table) - np.abs(whitened)).max() < 1e-9
    signs = np.sign(table / whitened)
    assert (signs == signs[0]).all()
    assert found.drop_duplicates("vec_id").sort_values("vec_id")["deviation"].tolist() \
        == deviation.tolist()
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-10
    shares = found.drop_duplicates("component").sort_values("component")["explained"].to_numpy()
    assert (np.diff(shares) <= 0).all() and shares[0] == pytest.approx(
        values[0] / whitening_trace(rows), rel=1e-12)


def whitening_trace(rows):
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float))
    return x.var(0).sum()


@pytest.mark.parametrize("gap", [0, 1e-14, 1e-10, 1e-7, 1e-3])
def test_clustered_eigenvalues(gap):
    """Groups of nearly equal eigenvalues, to the precision of the matrix."""
    rng = np.random.default_rng(4)
    turn, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = np.concatenate([1 + gap * np.arange(8), 4 + gap * np.arange(5), np.arange(10, 27)])
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenvectors(matrix)
    wide = matrix.astype(WIDE)
    assert np.abs(wide @ vectors - vectors * found).max() < 1e-16
    assert np.abs(vectors.T @ vectors - np.eye(30)).max() < 1e-17
    assert np.abs(found.astype(float) - np.linalg.eigvalsh(matrix)[::-1]).max() < 1e-12


def test_refinement_beats_float32():
    rng = np.random.default_rng(5)
    data = rng.normal(size=(400, 40))
    matrix = data.T @ data / 400
    _, rough = np.linalg.eigh(matrix.astype(np.float32))
    _, fine = whitening.eigenvectors(matrix)
    def error(basis):
        turned = basis.T @ matrix @ basis
        return np.abs(turned - np.diag(np.diag(turned))).max()
    assert error(rough.astype(float)) > 1e-8 and error(fine) < 1e-15


def test_degenerate_matrices():
    for matrix in (np.zeros((3, 3)), np.eye(4), np.ones((5, 5)), np.diag([2.0, 0, 0, 1])):
        values, vectors = whitening.eigenvectors(matrix)
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-17
        assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-17


def test_awkward_rows(vectors, clashing):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [-1.0, 2.0]), (2, [0.0, 1.0])]
    rows = [*good, (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
            (8, [1.0, 2.0, 3.0])]
    found = whitening.whiten(clashing(vectors(*rows))).toPandas()
    assert len(found) == 4 * 2 and (found["n"] == 4).all()
    assert sorted(found["vec_id"].fillna(-1)) == [-1, -1, 1, 1, 1, 1, 2, 2]
    assert found["identity_error"][0] < 1e-12
    same = whitening.whiten(vectors((1, [1.0, 2.0]), (2, [1.0, 2.0]))).toPandas()
    assert same["whitened"].isna().all() and (same["deviation"] == 0).all()
    huge = whitening.whiten(vectors((1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5]))).toPandas()
    assert len(huge) == 6 and huge["deviation"].isna().any()
    assert whitening.whiten(vectors((1, None))).count() == 0
    assert whitening.whiten(vectors().filter("false")).count() == 0
