"""Fill-in-middle, whitening and near duplicates of embeddings against plain versions."""

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from llm import cases
from pyspark.sql import functions as F

from tierwise.llm import vector_dedup
from tierwise.llm.fim import BLOCK, BlockTrees, fill_in_middle, restored
from tierwise.llm.spectrum import Slicer, factorize, leading
from tierwise.llm.text import chunks
from tierwise.llm.vector_dedup import near_vectors, open_pairs, plan_coding, rotations, unit
from tierwise.llm.whitening import fit_whitening, whiten

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# fill-in-middle

def fim(ident, text, seed=42, percent=50, spm=80):
    """(n, form, prefix code points, middle code points, output)."""
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [(200, "<P"), (201, "a <M> b"), (202, "x<S"), (203, "<<P <S <M < P>"), (None, "no id here at all"),
       (None, None), (204, "é漢字 \U0001F600 " * 200 + "\n"), (205, "   x　"), (206, " " * 700),
       (207, "w" * (3 * BLOCK)), (208, ("ab " * 100)[:BLOCK]), (209, "y" * (BLOCK - 1) + " z"), (1, "copy"), (1, "copy")]


@pytest.mark.parametrize("percent,spm", [(50, 80), (100, 50)])
def test_fill_in_middle(spark, percent, spm):
    rows = cases.documents() + ODD + [(300, cases.prose(__import__("random").Random(3), 40000) + "  ")]
    got = fill_in_middle(cases.frame(spark, rows), 42, percent, spm).withColumn("back", restored()).collect()
    assert sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in got) \
        == sorted((str(i), *(str(x) if k in (2, 3) else x for k, x in enumerate(fim(i, t, 42, percent, spm))))
                  for i, t in rows)
    texts = sorted(t or "" for _, t in rows)
    assert sorted(r.back for r in got) == texts


def test_fill_in_middle_empty_table(spark):
    assert fill_in_middle(cases.frame(spark, [])).collect() == []


def test_every_cut_of_the_block_trees():
    import pyarrow as pa
    texts = [t or "" for _, t in ODD] + ["a b  c\n", "", " x", "é " * 400]
    for _, data, offs in chunks(pa.record_batch([pa.array(texts)], names=["text"]), "text"):
        trees = BlockTrees(data, offs)
        units = [UNIT.findall(t) for t in texts]
        assert trees.units.tolist() == [len(u) for u in units]
        for k in range(max(trees.units) + 1):
            want = [u[:k] for u in units]
            byte, points = trees.cut(np.minimum(k, trees.units))
            assert byte.tolist() == [len("".join(w).encode()) for w in want]
            assert points.tolist() == [len("".join(w)) for w in want]


# spectrum

def test_counts_and_eigenpairs():
    rng = np.random.default_rng(5)
    for t in range(60):
        d = int(rng.integers(1, 30))
        x = rng.standard_normal((int(rng.integers(1, 60)), d)) * rng.choice([1, 1e-4, 1e4])
        v = np.eye(d) * 3.0 if t % 7 == 0 else np.cov(x.T, bias=True).reshape(d, d)
        w = np.linalg.eigvalsh(v)[::-1]
        shift = float(rng.uniform(0, w[0] + 1e-300))
        f = factorize(v, shift)
        assert f.above() == (w > shift).sum()
        b = rng.standard_normal(d)
        assert np.allclose((v - shift * np.eye(d)) @ f.solve(b), b, atol=1e-5)
        pairs = leading(v, 4)
        assert len(pairs) == min(4, (w > 1e-10 * w[0]).sum() if w[0] > 0 else 0)
        q = np.array([p.vector for p in pairs]).reshape(len(pairs), d)
        assert np.allclose([p.value for p in pairs], w[:len(pairs)], rtol=1e-10, atol=1e-13 * max(w[0], 0))
        assert np.allclose(q @ q.T, np.eye(len(pairs)), atol=1e-8)
        assert np.allclose(v @ q.T, q.T * w[:len(pairs)], atol=1e-11 * max(w[0], 1e-300) * d)


def test_isolation_uses_counts_only_as_needed():
    v = np.diag([5.0, 4.0, 3.0, 1.0])
    s = Slicer(v)
    low, high = s.isolate(2, 1e-9)
    assert s.above(low) == 2 and s.above(high) == 1 and low < 4.0 <= high


# whitening

VECTORS = "vec_id long, embedding array<float>"


def vectors(spark, rows, parts=3, schema=VECTORS):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return df.selectExpr("*", "1 as id", "'x' as v", "2 as x", "3 as node", "4 as part", "5 as list", "6 as ok",
                         "0 as label")


def bad_rows(d):
    return [(900, None), (901, [None] + [1.0] * (d - 1)), (902, [math.nan] + [0.0] * (d - 1)),
            (903, [math.inf] * d), (904, []), (905, [1.0] * (d + 1))]


def brute_whitening(rows, d):
    good = [(i, v) for i, v in rows if v is not None and len(v) == d
            and all(x is not None and math.isfinite(x) for x in v)]
    x = {k: tuple(math.floor(256 * float(np.float32(c))) for c in v) for k, (_, v) in enumerate(good)}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums)] for r in fit])
    w, q = np.linalg.eigh(y.T @ y / n)
    w, q = w[::-1], q[:, ::-1]
    out = []
    for k, (i, _) in enumerate(good):
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x[k], sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x[k], sums))
        out += [(i, m + 1, n, deviation, abs(float(centred @ q[:, m])) / w[m] ** 0.5, w[m] / w.sum())
                for m in range(min(4, (w > 1e-10 * w[0]).sum()))]
    return out


def test_whitening(spark):
    rng = np.random.default_rng(4)
    d = 7
    rows = [(k, (rng.standard_normal(d) * np.arange(1, d + 1)).tolist()) for k in range(80)]
    rows += [(100 + k, rows[k % 2][1]) for k in range(40)] + [(None, rows[5][1]), (3, rows[7][1])] + bad_rows(d)
    df = vectors(spark, rows)
    fitted = fit_whitening(spark, df)
    got = whiten(df, fitted).collect()
    want = brute_whitening(rows, d)
    assert fitted.identity_error < 1e-10 and {r.identity_error for r in got} == {fitted.identity_error}
    key = lambda r: (str(r[0]), r[1], r[3])
    mine = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-10)
    signs = {(r.component, np.sign(r.whitened)) for r in got if r.vec_id in (0, 100, 102)}
    assert len({c for c, _ in signs}) == len(signs)  # copies of one vector: one sign a component


def test_whitening_without_variance(spark):
    for rows in ([], bad_rows(3), [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = vectors(spark, rows)
        assert whiten(df, fit_whitening(spark, df)).collect() == []
    few = vectors(spark, [(1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0, 0.0]), (3, [0.0, 0.0, 0.0])])
    assert {r.component for r in whiten(few, fit_whitening(spark, few)).collect()} == {1}


def test_whitening_of_large_entries(spark):
    rows = [(k, [float(2 ** (30 + k)), float(k), 1e300 if k == 3 else 0.0]) for k in range(6)]
    df = vectors(spark, rows, schema="vec_id long, embedding array<double>")
    got = whiten(df, fit_whitening(spark, df)).collect()
    assert len(got) >= 6 and all(r.deviation is None or r.deviation >= 0 for r in got)


# near duplicates of vectors

def brute_near(rows, threshold=0.9):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    main = max((len(v) for i, v in rows if i is not None and good(v)), default=0,
               key=lambda k: (sum(good(v) and len(v) == k for _, v in rows), k))
    links = {k: set() for k in range(len(rows))}
    usable = [k for k, (i, v) in enumerate(rows) if i is not None and good(v) and len(v) == main]
    if usable:
        x = np.array([np.float32(rows[k][1]).astype(np.float64) for k in usable])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[usable[a]].add(usable[b])
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        first = None if i is None else min(rows[s][0] for s in seen)
        out.append((str(i), len(links[k]), str(first), i is None or i == first))
    return sorted(out)


def near_rows(rng, d, groups, loose):
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(d)
        for _ in range(int(rng.integers(1, 6))):
            noise = rng.standard_normal(d) * rng.uniform(0.05, loose)
            rows.append((len(rows), (centre + noise).astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("bucket,block", [(1024, 2048), (8, 16)])
def test_near_vectors(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(vector_dedup, "BUCKET", bucket)
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(8)
    d = 24
    rows = near_rows(rng, d, 60, 0.5)
    hot = rng.standard_normal(d)  # a large group of near copies, and one of equal vectors
    rows += [(1000 + k, (hot + 0.02 * rng.standard_normal(d)).tolist()) for k in range(60)]
    rows += [(2000 + k, rows[0][1]) for k in range(50)] + [(2100, [2 * x for x in rows[0][1]])]
    rows += [(3000, [0.0] * d), (None, rows[0][1]), (5, rows[0][1]), *bad_rows(d)]
    found = near_vectors(spark, vectors(spark, rows), miss=1e-6)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found.vectors.collect())
    assert got == brute_near(rows)


def test_near_vectors_of_small_tables(spark):
    for rows in ([], bad_rows(3), [(1, [1.0]), (2, [2.0]), (3, [-1.0])], [(4, [0.0, 0.0])]):
        got = near_vectors(spark, vectors(spark, rows)).vectors.collect()
        assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute_near(rows)


def test_recall_right_at_the_threshold():
    """Bands meet pairs of exactly the threshold as often as planned; open pairs hold nearly all of them."""
    rng = np.random.default_rng(2)
    d, t, m = 64, 0.9, 3000
    a = unit(rng.standard_normal((m, d)))
    o = rng.standard_normal((m, d))
    o = unit(o - (o * a).sum(axis=1)[:, None] * a)
    b = t * a + math.sqrt(1 - t * t) * o
    coding = plan_coding(200_000, d, t, 1e-2)
    assert coding.bits == 8 and coding.rotations > 1
    turned = rotations(coding, 3)
    y, z = a @ turned.T, b @ turned.T
    met = (coding.keys(y > 0) == coding.keys(z > 0)).any(axis=1)
    assert met.mean() > 0.975
    factors = np.abs(y).reshape(m, coding.rotations, -1).sum(axis=2) / coding.width ** 0.5
    estimate = (np.where(y > 0, z, -z).reshape(m, coding.rotations, -1).sum(axis=2)
                / coding.width ** 0.5 / factors).mean(axis=1)
    spread = coding.spread(factors)
    assert abs(estimate.mean() - t) < 4 * spread.mean() / m ** 0.5
    assert abs((estimate - t).std() / spread.mean() - 1) < 0.1
    assert (estimate >= t - vector_dedup.SPREADS * spread).all()


def test_first_common_band_only():
    rng = np.random.default_rng(6)
    coding = plan_coding(5000, 16, 0.9, 1e-3)
    u = unit(np.repeat(rng.standard_normal((1, 16)), 40, axis=0) + 0.05 * rng.standard_normal((40, 16)))
    y = u @ rotations(coding, 1).T
    factors = np.abs(y).reshape(40, coding.rotations, -1).sum(axis=2) / coding.width ** 0.5
    seen = []
    for band in range(coding.bands):
        key = coding.keys(y > 0)[:, band]
        for k in np.unique(key):
            rows = np.flatnonzero(key == k)
            for i, j in open_pairs(coding, y > 0, factors, y, rows, rows, band):
                seen += list(zip(i.tolist(), j.tolist()))
    assert len(seen) == len(set(seen)) == 40 * 39 // 2


def test_queries_on_the_given_vectors(spark):
    from tierwise.llm import queries as q
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = q.op13_embedding_near_dedup(spark, sf).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute_near(rows)
    mine = {(r.vec_id, r.component): r for r in q.op11_embedding_whitening(spark, sf).collect()}
    want = brute_whitening(rows, 64)
    assert len(mine) == len(want)
    for i, c, n, deviation, size, explained in want:
        r = mine[i, c]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.whitened) == pytest.approx(size, abs=1e-9)
        assert r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-9
    assert q.op12_fill_in_middle(spark, sf).where(
        F.col("restored_sha256").isNull()).count() == 0
