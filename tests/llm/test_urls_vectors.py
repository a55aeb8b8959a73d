"""URL filter, whitening and hard negatives against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsieve.llm import hard_negatives, urls, whitening
from rowsieve.llm.catalog import URL_RULES

CLASHING = ["host", "path", "rule", "verdict", "address", "listed", "shard", "__shard", "__w0", "here", "id", "v", "part", "key", "label2", "n", "i", "j", "s", "anchor", "found", "rank"]


def clash(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


# -- URL filter --------------------------------------------------------------

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://Example.ORG/es/x", "http://example.org/es", "http://a.b.example.org/es/?q=/es/",
    "http://notexample.org/es/1", "http://example.org/en/1", "http://example.org/en/12?x#y", "http://example.org/en/2", "http://org/",
    "http://org", "http://x.org?/a", "http://x.org#/a", "https://shop.com/fr/a", "https://shop.com/de/a", "https://shop.com/FR/a",
    "https://com/de/", "https://casino.net/x", "https://CASINO.net/x?y", "https://casino.net/x", "ftp://u@h:80/p://q", "http://ÉX.org/é", "x://y\n.org/\n/z",
    "http://" + "a" * 70_000 + ".com/de/" + "b" * 70_000,
]


def judged(url, listed):
    """(host, path, rule, verdict) in plain Python."""
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    verdict = best[0] if best else "block" if host + path in listed else "allow"
    return host, path, best and best[1] + best[2], verdict


def pages(spark, found):
    return spark.createDataFrame(list(enumerate(found)), "page_id long, url string")


def test_every_odd_url(spark):
    listed = ["casino.net/x", "shop.com/fr/a", "nowhere.com/", None, "casino.net/x"]
    given = spark.createDataFrame([(x,) for x in listed], "address string")
    rows = urls.judge(clash(pages(spark, URLS)), URL_RULES, given).collect()
    assert {tuple(r) for r in rows} == {(i, *judged(u, set(listed))) for i, u in enumerate(URLS)}
    assert len(rows) == len(URLS)


@pytest.mark.parametrize("literal", [1 << 24, 0])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, literal):
    """3,000 of 40,000 listed, in several shards, as values and joined by shard."""
    monkeypatch.setattr(urls, "SHARD_KEYS", 15_000)
    monkeypatch.setattr(urls, "LITERAL_BYTES", literal)
    keys = spark.range(40_000).select(F.concat(F.lit("h"), "id").alias("address"), (F.col("id") % 13 == 5).alias("listed"))
    cascade = urls.build(spark, keys)
    assert cascade.shards == 3 and len(cascade.levels) >= 2
    marked = cascade.mark(keys, "address", "found")
    assert marked.columns == ["address", "listed", "found"]
    assert marked.where("listed <> found OR found IS NULL").isEmpty()
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (literal == 0)


def test_filters_alternate_until_nothing_is_held_wrongly(spark):
    """The first level alone holds unlisted keys: later levels are needed."""
    keys = spark.range(30_000).select(F.col("id").cast("string").alias("address"), (F.col("id") % 2 == 0).alias("listed"))
    cascade = urls.build(spark, keys)
    alone = urls.Cascade(cascade.levels[:1], cascade.shards).mark(keys, "address", "found")
    assert alone.where("found AND NOT listed").count() > 100
    assert cascade.mark(keys, "address", "found").where("listed <> found").isEmpty()


def test_nothing_or_everything_listed_and_empty_tables(spark):
    some = pages(spark, ["http://a.net/1", "http://a.net/2", "http://a.net/2"])
    given = spark.createDataFrame([("a.net/1",), ("a.net/2",)], "address string")
    assert [r.verdict for r in urls.judge(some, [], given).collect()] == ["block"] * 3
    assert [r.verdict for r in urls.judge(some, [], given.limit(0)).collect()] == ["allow"] * 3
    assert [r.verdict for r in urls.judge(some, []).collect()] == ["allow"] * 3
    assert urls.judge(some.limit(0), URL_RULES, given).collect() == []
    found = urls.judge(some, [("allow", "a.net", "/1"), ("block", "a.net", "/1")], given).collect()
    assert sorted((r.path, r.rule, r.verdict) for r in found)[0] == ("/1", "a.net/1", "allow")  # first given among equals


def test_main_path_has_no_python_worker_and_reads_urls_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = urls.judge(df, URL_RULES, urls.addresses_on(df, ["casino"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


# -- whitening ---------------------------------------------------------------


@pytest.mark.parametrize("kind", ["random", "repeated", "identity", "graded", "rank1", "diagonal"])
def test_components_against_numpy(kind):
    rng = np.random.default_rng(3)
    d, k = 40, 12
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    values = {"random": rng.random(d) * 5, "repeated": np.repeat([7.0, 3.0, 3.0, 1.0], 10), "identity": np.ones(d), "graded": 10.0 ** -np.arange(d), "rank1": np.eye(1, d)[0], "diagonal": np.arange(d, 0, -1.0)}[kind]
    if kind in ("identity", "diagonal"):
        q = np.eye(d)
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    got, z = whitening.leading_components(v, k)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    assert np.allclose(got, want[:k], rtol=0, atol=1e-13 * max(want[0], 1))
    assert np.abs(z.T @ z - np.eye(k)).max() < 1e-13
    assert np.abs(v @ z - z * got).max() < 1e-12 * max(want[0], 1)


def test_sturm_counts_count_eigenvalues():
    diag, off = np.array([2.0, -1.0, 3.0, 0.5]), np.array([0.5, 0.0, 1.5])
    t = np.diag(diag) + np.diag(off, 1) + np.diag(off, -1)
    want = np.linalg.eigvalsh(t)
    at = np.concatenate([want - 1e-9, want + 1e-9])
    assert whitening.sturm_counts(diag, off, at).tolist() == [(want < a).sum() for a in at]


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def whole_numbers(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def test_whitened_rows_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((400, 6)) @ rng.standard_normal((6, 6)) + 300).astype(np.float32)
    bad = [(9001, None, 1), (9002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (9003, [float("nan")] * 6, 1), (9004, [float("inf")] + [0.0] * 5, 1), (9005, [1.0, 2.0], 1), (9006, [], 1)]
    rows = [(i, v.tolist(), None) for i, v in enumerate(base)] + [(7, base[7].tolist(), 2), (None, base[8].tolist(), 2)]
    got = whitening.whiten(clash(embeddings(spark, rows + bad)).repartition(5), 4).toPandas()
    x = whole_numbers([r[1] for r in rows])
    n, s = len(x), x.sum(0)
    c = x - s / n
    v = c.T @ c / n
    e, z = np.linalg.eigh(v)
    e, z = e[::-1][:4], z[:, ::-1][:, :4]
    assert len(got) == 4 * n and set(got.n) == {n} and got.vec_id.isna().sum() == 4
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12
    want = c @ z / np.sqrt(e)
    for j in range(4):
        mine = got[got.component == j + 1]
        by_id = mine[mine.vec_id < 400].drop_duplicates("vec_id").sort_values("vec_id")
        sign = np.sign(by_id.whitened.values @ want[:400, j])
        assert np.allclose(by_id.whitened.values * sign, want[:400, j], atol=1e-10)
        assert np.allclose(mine.explained, e[j] / np.trace(v), rtol=1e-12)
        assert (by_id.deviation.values == ((n * x[:400] - s) ** 2).sum(1)).all()


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)], [(1, [], 0)]):
        df = whitening.whiten(embeddings(spark, rows), 2)
        assert df.collect() == [] and df.columns[:2] == ["vec_id", "component"]


def test_dependent_dimensions_leave_fewer_components(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0], 0) for i in range(50)]
    found = whitening.whiten(embeddings(spark, rows), 32).toPandas()
    assert set(found.component) == {1} and found.explained[0] == pytest.approx(1)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**30 + i), float(i * i % 7)], 0) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 2).toPandas()
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    want = [sum((40 * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    assert found[found.component == 1].sort_values("vec_id").deviation.tolist() == want
    assert found.identity_error[0] < 1e-9


# -- hard negatives ----------------------------------------------------------


def mined(rows, every=5):
    """All rows against all anchors in plain Python."""
    dims = 4
    take = [(i, y, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, y in rows if y is not None and v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, y, q in take:
        if i is None or i % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(q, v)), j, z) for j, z, v in take if j != i), key=lambda t: (-t[0], t[1] is None, t[1] or 0))
        for s, j, z in [t for t in scored if t[2] == y][:5]:
            window = [t for t in scored if t[2] != y and 50 * s <= 100 * t[0] <= 95 * s][:3]
            out += [(i, j, r + 1, t[1], s, t[0]) for r, t in enumerate(window)]
    return sorted(out, key=str)


def vectors(n, seed, ties=False):
    rng = np.random.default_rng(seed)
    v = rng.integers(-2, 3, (n, 4)) / 2 if ties else rng.standard_normal((n, 4))
    return [(int(i), [float(c) for c in row], int(y)) for i, row, y in zip(rng.permutation(n), v, rng.integers(0, 3, n))]


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("boxes", [1 << 20, 0])
def test_mined_against_brute_force(spark, monkeypatch, ties, boxes):
    """Many parts, leaves and blocks; with and without boxes to route by."""
    for name, value in (("LEAF", 16), ("FAN", 3), ("PART_ROWS", 150), ("LEAST_ROWS", 100), ("BLOCK", 50), ("BOX_BYTES", boxes)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(700, 1, ties)
    rows += [(None, [1.0, 1.0, 0.5, 0.0], 1), (5000, None, 1), (5005, [1.0, 0.0, 0.0, 0.0], None), (5010, [1.0, None, 0.0, 0.0], 1), (5015, [float("nan")] * 4, 1), (5020, [1.0, 1.0], 1), (5025, [], 0)]
    rows += [rows[3], rows[4], (rows[5][0], rows[6][1], 2)]  # repeated rows and ids
    got = hard_negatives.mine(clash(embeddings(spark, rows)).repartition(4), F.col("id") % 5 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == mined(rows)


def test_a_third_of_all_vectors_equal(spark, monkeypatch):
    for name, value in (("LEAF", 16), ("PART_ROWS", 100), ("LEAST_ROWS", 50)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = [(i, [1.0, 0.5, 0.25, 0.0], 0) if i % 3 == 0 else r for i, r in enumerate(sorted(vectors(300, 2)))]
    rows = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    got = hard_negatives.mine(embeddings(spark, rows), F.col("id") % 5 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == mined(rows)


def test_boxes_prune_clustered_vectors():
    """Of 64 far clusters a search scores few leaves, and misses nothing."""
    rng = np.random.default_rng(4)
    v = np.floor(256 * (np.repeat(rng.standard_normal((64, 8)) * 9, 32, 0) + rng.standard_normal((2048, 8)) * 0.01))
    tiles = hard_negatives.str_tiles(v[:, hard_negatives.widest(v)], 32)
    assert sorted(np.concatenate(tiles).tolist()) == list(range(2048)) and max(map(len, tiles)) <= 32
    labels = np.arange(2048) % 2
    tree = hard_negatives.Tree([t for t in tiles], [labels[t] for t in tiles], [v[t].min(0) for t in tiles], [v[t].max(0) for t in tiles], [v[t] for t in tiles])
    scored = 0
    real = hard_negatives.exact_products

    def counted(a, b):
        nonlocal scored
        scored += 1
        return real(a, b)

    hard_negatives.exact_products = counted
    try:
        (found,) = tree.search(5, int(labels[5]), v[5], [(-np.inf, np.inf)], 5, True)
    finally:
        hard_negatives.exact_products = real
    best = sorted(((int(v[j] @ v[5]), j) for j in range(2048) if labels[j] == labels[5] and j != 5), key=lambda t: (-t[0], t[1]))[:5]
    assert found == best and scored <= 16  # of 64 or more


def test_mine_without_partners(spark):
    assert hard_negatives.mine(embeddings(spark, []), F.col("id") % 5 == 0).collect() == []
    assert hard_negatives.mine(embeddings(spark, [(5, [1.0, 0.0, 0.0, 0.0], 1)]), F.col("id") % 5 == 0).collect() == []
    assert hard_negatives.mine(embeddings(spark, [(1, None, 1)]), F.col("id") % 5 == 0).collect() == []


def test_huge_entries_are_exact():
    a = np.array([[2.0**40, 3.0], [1.0, -(2.0**41)]])
    q = np.array([2.0**40 + 2, 7.0])
    tree = hard_negatives.Tree([np.array([1, 2])], [np.array([0, 0])], [a.min(0)], [a.max(0)], [a])
    (found,) = tree.search(9, 0, q, [(-np.inf, np.inf)], 2, True)
    assert found == [(2**40 * (2**40 + 2) + 21, 1), (2**40 + 2 - 7 * 2**41, 2)]
