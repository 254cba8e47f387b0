"""Merkle manifest, source mix and whitening against brute-force versions, on tables with odd rows."""

import hashlib
import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import merkle, mixing, queries, whitening

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree int, position string, path string"
ODD = (
    [(i, "big", "en", i % 5, f"line {i}\nand more\n") for i in range(83)]
    + [(7, "big", "en", 2, "line 7\nand more\n")] * 5  # repeated rows, and another text of the same key
    + [(7, "big", "de", 2, "other"), (None, "big", None, None, None), (None, "big", None, None, "")]
    + [(200 + i, None, "en", 1, "no source\n") for i in range(4)]
    + [(300, "", "en", 0, ""), (301, "é\U0001f600", "xx", 3, "漢字 " * 40_000 + "\n"), (302, "￮", "xx", 3, " \t\n ")]
    + [(400 + i, f"s{i}", "en", 1, "one two three " * (i + 1)) for i in range(11)]
)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in ODD], DOCS).repartition(3)


# ------------------------------------------------------------------ manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], row[4])))


def brute_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_path(levels, at):
    path = []
    for level in levels[:-1]:
        first = at // 3 * 3
        path.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        at //= 3
    return path


def brute_manifest(rows):
    """`rows`: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, brute_leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for members in groups.values():
        members.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {name: brute_tree([leaf for _, leaf in groups[name]]) for name in names}
    top = brute_tree([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for i, (row, leaf) in enumerate(groups[name]):
            path = brute_path(trees[name], i) + brute_path(top, place)
            now = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                now = (*row[:4], row[4].replace("\n", ""))
            folded = brute_leaf(now)
            for left, right in path:
                folded = digest(left, folded, right)
            found.append((row[0], leaf, trees[name][-1][0], top[-1][0], digest(*(x for step in path for x in step)), folded, folded == top[-1][0]))
    return found


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_rows(docs, **more):
    return [tuple(r) for r in merkle.manifest(docs, tampered=merkle.without_line_breaks(), **more).select(*COLUMNS).collect()]


@pytest.mark.parametrize("levels", [2, 5])
def test_manifest_equals_brute_force(odd, levels):
    wanted = brute_manifest(ODD)
    assert sorted(map(str, manifest_rows(odd, levels=levels))) == sorted(map(str, wanted))
    assert {x[-1] for x in wanted} == {True, False}


@pytest.mark.parametrize("many", [1, 3, 10])
def test_small_trees(spark, many):
    rows = [(i, "one", None, None, f"t{i}") for i in range(many)]
    got = manifest_rows(spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS))
    assert sorted(got) == sorted(brute_manifest(rows))


def test_manifest_of_an_empty_table_and_without_changes(odd):
    assert manifest_rows(odd.limit(0)) == []
    plain = merkle.manifest(odd.filter("source = 'big'"))
    assert {r["verified"] for r in plain.collect()} == {True}


def test_height_counts_levels(spark):
    nodes = [1, 2, 3, 4, 9, 10, 27, 28, 3**20, 3**20 + 1]
    got = spark.createDataFrame([(n,) for n in nodes], "n long").select(merkle.height(F.col("n"))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 2, 3, 3, 4, 20, 21]


# ------------------------------------------------------------------ mix


def brute_mix(rows, weights=(5, 2, 1)):
    """`rows`: (doc_id, source, text). Targets by sharing the excess again and again, words by walking along each source."""
    sized = [(k, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, s, t in rows]
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    found = []
    for name in names:
        own = sorted((r for r in sized if r[1] == name), key=lambda r: (r[0] is not None, hashlib.sha256(str(r[0]).encode()).hexdigest(), r[0] or 0, r[2]))
        line = [(i, n) for _ in range(3) for i, (_, _, n) in enumerate(own)]
        taken, left = [0] * len(own), math.floor(target[name] + 1e-9)
        for i, n in line:
            taken[i] += min(n, left)
            left -= min(n, left)
        found += [(r[0], r[2], sizes[name], target[name], t) for r, t in zip(own, taken, strict=True)]
    return found, target


def plain(rows):
    return sorted((str(k), n, s, round(t, 4), taken) for k, n, s, t, taken in rows)


def test_mix_equals_brute_force(odd):
    wanted, target = brute_mix([(r[0], r[1], r[4]) for r in ODD])
    placements = mixing.place_documents(odd)
    got = mixing.taken_words(placements)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert plain(got.collect()) == plain(wanted)
    assert any(t == 3 * s for _, _, s, t, _ in wanted if s)  # a source stops at three times its size
    assert sorted(map(str, mixing.taken_words(mixing.place_documents(odd.repartition(5))).collect())) == sorted(map(str, got.collect()))
    rows = [r for r in placements.collect() if r["position"] is not None]
    positions = [r["position"] for r in rows]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    for r in rows:  # the words a source was asked for until then are those of its documents before this one
        assert 0 < r["taken"] <= r["size"]


def test_positions_invert_the_demand(spark):
    rows = [(i, s, "w " * (50 + i % 7)) for i in range(300) for s in ("a", "b", "c")]
    placements = mixing.place_documents(spark.createDataFrame([(i, s, t) for i, s, t in rows], "doc_id long, source string, text string")).collect()
    target = {r["source"]: r["target"] for r in placements}
    for place, name in enumerate("abc"):
        own = sorted((r for r in placements if r["source"] == name and r["position"] is not None), key=lambda r: r["position"])
        before = 0
        for r in own:
            assert abs(demand_until(mixing.SCHEDULES[place % 3], r["position"]) * target[name] - before) < 1e-6 * target[name] + 1e-6
            before += r["taken"]
        assert before == math.floor(target[name])
        early = sum(r["taken"] for r in own if r["position"] < 0.5) / before
        assert abs(early - demand_until(mixing.SCHEDULES[place % 3], 0.5)) < 0.02


def demand_until(schedule, time):
    points = np.linspace(0, 1, 200_001)
    heights = np.interp(points, np.linspace(0, 1, len(schedule)), schedule)
    areas = np.concatenate([[0], np.cumsum((heights[1:] + heights[:-1]) / 2)])
    return float(np.interp(time, points, areas / areas[-1]))


def test_mix_of_empty_tables_and_of_texts_without_words(spark, odd):
    assert mixing.taken_words(mixing.place_documents(odd.limit(0))).collect() == []
    none = spark.createDataFrame([(1, "a", None), (2, "a", " \n"), (3, None, "")], "doc_id long, source string, text string")
    assert sorted(map(tuple, mixing.taken_words(mixing.place_documents(none)).collect())) == [(i, 0, 0, 0.0, 0) for i in (1, 2, 3)]
    with pytest.raises(ValueError):
        mixing.demand([(0.0, 0.0)], F.lit(0))


def test_schedules_may_begin_or_end_at_zero(spark):
    table = spark.createDataFrame([(i, "a", "w " * 10) for i in range(100)], "doc_id long, source string, text string")
    for schedule in ((0.0, 1.0), (1.0, 0.0), (0.0, 0.0, 1.0), (1.0, 0.0, 0.0, 1.0)):
        rows = sorted(mixing.place_documents(table, schedules=[schedule]).collect(), key=lambda r: r["position"])
        for i, r in enumerate(rows):
            assert abs(demand_until(schedule, r["position"]) - i / 100) < 1e-6


# ------------------------------------------------------------------ whitening


MATRICES = {
    "one": np.ones((5, 1)),
    "random": np.random.default_rng(1).standard_normal((300, 48)),
    "clustered": np.linalg.qr(np.random.default_rng(2).standard_normal((300, 40)))[0] + 1e-9 * np.random.default_rng(3).standard_normal((300, 40)),
    "equal": np.eye(20),
    "few rows": np.random.default_rng(4).standard_normal((12, 30)),
    "graded": np.random.default_rng(5).standard_normal((200, 16)) * 10.0 ** -np.arange(16),
    "with zeros": np.random.default_rng(6).standard_normal((200, 24)) * (np.arange(24) % 3 > 0),
    "zero": np.zeros((4, 6)),
}


@pytest.mark.parametrize("name", list(MATRICES))
def test_small_solver(name):
    matrix = MATRICES[name]
    size = matrix.shape[1]
    triangle = whitening.triangle_of(matrix, size)
    diagonal, above, right = whitening.bidiagonal(triangle)
    exact = np.append(np.linalg.svd(matrix, compute_uv=False), np.zeros(size))[:size]
    scale = max(exact[0], 1e-300)
    assert np.abs(right.T @ right - np.eye(size)).max() < 1e-13
    assert np.abs(whitening.singular_values(diagonal, above) - exact).max() <= 1e-13 * scale
    values, vectors = whitening.solve(triangle)
    rank = int((values > 0).sum())
    assert rank == min(16, int((exact > 8 * size * whitening.EPS * scale).sum()))
    kept = vectors[:, :rank]
    assert np.abs(kept.T @ kept - np.eye(rank)).max(initial=0) < 1e-13, name
    assert np.abs(matrix.T @ (matrix @ kept) - kept * values[:rank] ** 2).max(initial=0) <= 1e-13 * scale**2


def test_tiny_singular_values_keep_their_digits():
    diagonal, above = 10.0 ** -np.arange(0, 30, 2.0), 0.3 * 10.0 ** -np.arange(1, 29, 2.0)
    found = whitening.singular_values(diagonal, above)
    # the product of all singular values is that of the diagonal
    assert abs(np.log(found).sum() - np.log(diagonal).sum()) < 1e-12
    assert found[-1] < 1e-27


def expected(rows):
    x = np.floor(64 * np.array(rows, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    shifted = x - sums // n - (sums % n) / n
    centred = fit - sums // n - (sums % n) / n
    variances, directions = np.linalg.eigh(centred.T @ centred / n)
    variances, directions = variances[::-1][:16], directions[:, ::-1][:, :16]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, shifted @ directions / np.sqrt(variances), variances / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("size, many", [(24, 400), (5, 60)])
def test_whitening_equals_eigenvectors(spark, size, many):
    random = np.random.default_rng(size)
    good = (random.normal(0, 0.4, (many, size)) * np.linspace(2, 0.5, size)).astype(np.float32).astype(float)
    good[50:] = np.where(np.arange(many - 50)[:, None] % 10 == 0, good[0], good[50:])  # copies
    rows = [(i, v.tolist(), 1, "x", i) for i, v in enumerate(good)]
    odd = [(-1, None), (-2, [None] * size), (-3, [float("nan")] * size), (-4, [math.inf] * size), (-5, [1.0, 2.0]), (-6, [1e300] * size), (-7, [])]
    table = spark.createDataFrame([*rows, *((i, v, 1, "x", i) for i, v in odd)], "vec_id long, embedding array<double>, component int, x string, n long")
    got = whitening.whiten(table.repartition(4)).toPandas()
    n, deviation, white, explained = expected(good)
    k = min(16, size)
    assert len(got) == many * k and list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert (got["n"] == n).all() and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-12
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(wide * np.sign((wide * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(got[got["vec_id"] == 0].sort_values("component")["explained"].to_numpy() - explained).max() < 1e-12
    assert got[got["component"] == 1].sort_values("vec_id")["deviation"].tolist() == deviation


def test_rows_without_variance_and_empty_tables(spark):
    table = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(table).collect()
    assert len(rows) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in rows} == {(1, 0, None, 0.0)}
    two = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    found = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whiten(two).collect()}
    assert abs(found[1, 1]) == 1 and found[1, 1] == -found[2, 1] and found[1, 2] is None
    assert whitening.whiten(table.limit(0)).collect() == [] and whitening.whiten(table.selectExpr("vec_id", "CAST(NULL AS array<double>) AS embedding")).collect() == []


def test_large_entries_are_exact():
    x = np.array([[2**45, 5], [2**45 + 3, -7]], dtype=np.int64)
    sums = np.array([int(a) for a in x.sum(axis=0)])
    assert whitening.deviations(x, 2, sums) == [9 + 144, 9 + 144]
    far = np.array([[2**52, 0], [0, 0]], dtype=np.int64)
    assert whitening.deviations(far, 2, far.sum(axis=0)) == [None, None]


# ------------------------------------------------------------------ the tables


@needs_tables
def test_queries_on_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    wanted = brute_manifest([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs])
    assert sorted(map(str, (tuple(r) for r in queries.op12_merkle_manifest(spark, FOLDER).collect()))) == sorted(map(str, wanted))
    assert plain(queries.op13_curriculum_mix(spark, FOLDER).collect()) == plain(brute_mix([(r["doc_id"], r["source"], r["text"]) for r in docs])[0])
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    got = queries.op11_whitening(spark, FOLDER).toPandas()
    n, deviation, white, _ = expected([r["embedding"] for r in vectors])
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(wide * np.sign((wide * white).sum(axis=0)) - white).max() < 1e-8 and (got["n"] == n).all()
    assert got[got["component"] == 1].sort_values("vec_id")["deviation"].tolist() == deviation
