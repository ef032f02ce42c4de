import math

import numpy as np
import pytest

from tallyframe.llm import whitening
from tallyframe.llm.whitening import Centre, clusters, corrected, eigenvectors, op11_embedding_whitening, packed, unpacked, whitened

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def plain(rows, components=4):
    """Brute force with whole-number sums and NumPy's own double-precision solver."""
    d = next(len(v) for _, v in rows)
    x = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in enumerate(v for _, v in rows)}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(v[i] for v in fit) for i in range(d)]
    away = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    cov = away.T @ away / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = []
    for i, (key, _) in enumerate(rows):
        w = np.array([(n * a - s) / n for a, s in zip(x[i], sums)]) @ q / np.sqrt(e)
        dev = sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
        out += [(key, c + 1, n, dev, w[c], e[c] / np.trace(cov)) for c in range(len(e))]
    return out


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = {(k, c): rest for k, c, *rest in plain(rows)}
    got = {(r.vec_id, r.component): r for r in op11_embedding_whitening(spark, folder).collect()}
    assert set(got) == set(want)
    sign = {c: np.sign(sum(got[k].whitened * want[k][2] for k in want if k[1] == c)) for c in range(1, 5)}
    for k, (n, dev, w, share) in want.items():
        assert (got[k].n, got[k].deviation) == (n, dev)
        assert got[k].whitened * sign[k[1]] == pytest.approx(w, abs=1e-9)
        assert got[k].explained == pytest.approx(share, rel=1e-10) and got[k].identity_error < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i * i % 11), 1.5 * i]) for i in range(40)]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 1.0]), (93, [1.0, inf, 0.0]), (94, []), (95, [1.0, 2.0]), (96, [-inf, 0.0, 0.0])]
    kept = good + good[:5] + [(None, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in kept + bad], SCHEMA)
    got = whitened(df).collect()
    want = plain(kept)
    assert len(got) == len(want) == 3 * len(kept)
    assert sorted((r.vec_id or -1, r.component, r.n, r.deviation) for r in got) == sorted((k or -1, c, n, dev) for k, c, n, dev, *_ in want)
    assert whitened(df.limit(0)).count() == 0 and whitened(df.where("vec_id >= 90 and vec_id < 95")).count() == 0


def test_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25], "", ""), (2, [0.5, 0.25], "", "")], SCHEMA)
    got = whitened(one).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got, key=lambda r: (r.vec_id, r.component))] == [
        (1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)] * 2
    line = spark.createDataFrame([(i, [float(i), 2.0], "", "") for i in range(9)], SCHEMA)
    got = whitened(line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got) and max(r.identity_error for r in got) < 1e-9


def test_huge_values_are_exact_or_null(spark):
    rows = [(0, [3e9, 1.0]), (1, [-3e9, 2.0]), (2, [1.0, 5.0]), (3, [1e30, 0.0]), (4, [2.0, 5.0])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = {r.vec_id: r for r in whitened(df).collect()}
    assert len(got) == 5 and all(r.deviation is None for r in got.values())  # the sums alone pass a long
    small = {r.vec_id: r.deviation for r in whitened(df.where("vec_id in (0, 2, 4)")).collect()}
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows}
    sums = [sum(x[i][j] for i in (0, 2, 4)) for j in range(2)]
    for i in (0, 2, 4):
        true = sum((3 * a - s) ** 2 for a, s in zip(x[i], sums))
        assert small[i] == (true if true < 2**63 else None)


def test_deviation_at_the_edge():
    centre = Centre.of(3, [0, 0])
    root = math.isqrt((2**63 - 1) // 9)
    x = np.array([[root, 0], [root + 1, 0], [-root, 1]], np.int64)
    assert [v.as_py() for v in centre.deviation(x)] == [9 * root * root if 9 * root * root < 2**63 else None, None, 9 * (root * root + 1) if 9 * (root * root + 1) < 2**63 else None]


def test_packing_is_exact_and_unique():
    import pyarrow as pa
    x = np.array([[0, 127, -128], [128, 0, 0], [-129, 1, 2], [1 << 15, 0, -1], [-(1 << 31), 0, 0], [1 << 31, 5, 5], [-(1 << 63), (1 << 63) - 1, 0]])
    rows = packed(x)
    assert [len(r) // 3 for r in rows] == [1, 2, 2, 4, 4, 8, 8]
    assert (unpacked(pa.array(rows, pa.binary()), 3) == x).all()


def orthogonal(d, seed):
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


@pytest.mark.parametrize("values", [
    np.linspace(10, 1, 40), 10.0 ** -np.arange(12), np.repeat([5.0, 2.0, 1.0], 7), [3, 3 - 1e-9, 3 - 2e-9, 1, 1 - 1e-8, 0.5, 0, 0, 0], np.zeros(5), [1e30, 1e29, 1.0]])
def test_refined_vectors(values):
    values = np.array(sorted(values, reverse=True), float)
    q = orthogonal(len(values), 3)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = eigenvectors(a)
    scale = np.abs(a).max() or 1
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-15 * 4 * len(a)
    assert np.abs(a @ x - x * e).max() < 4e-15 * len(a) * scale
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 4e-15 * len(a) * scale
    assert (np.diff(e) <= 1e-14 * scale).all()


def test_close_values_need_the_inner_solve(monkeypatch):
    """Vectors of values 1e-9 apart are mixed in single precision; the inner solve parts them."""
    q = orthogonal(12, 5)
    values = np.array([4, 4 - 1e-9, 4 - 2e-9, *np.linspace(2, 1, 9)])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert any(len(run) > 1 for run in clusters(*corrected(a, start)[1:3]))
    agree = lambda x: np.abs(np.abs(q.T @ x) - np.eye(12))[:3, :3].max()
    assert agree(eigenvectors(a)[1]) < 1e-5  # rounding of the matrix itself, 1e-15, over a gap of 1e-9
    # The refinement is what brings single precision to double.
    assert np.abs(a @ start - start * np.diag(start.T @ a @ start)).max() > 1e-8
    monkeypatch.setattr(whitening, "parted", lambda a, x, run: x)
    monkeypatch.setattr(whitening, "ROUNDS", 2)
    assert agree(eigenvectors(a)[1]) > 1e-5
