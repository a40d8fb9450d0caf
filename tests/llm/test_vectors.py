"""Clustering, SimHash and whitening against brute force, and on odd rows."""

import hashlib
from collections import defaultdict
from fractions import Fraction
from itertools import combinations
from math import floor

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sluicework.llm import centroid_clustering, embedding_whitening, simhash, vectors
from sluicework.llm.common import table

LONG_MAX = (1 << 63) - 1


def embeddings(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster string, id string, vector string")


def odd_vectors(spark, kind="float", dims=64):
    """Nulls, non-finite entries, other lengths, repeated rows and ids, and columns that clash."""
    rng = np.random.default_rng(11)
    ok = [[float(v) for v in np.float32(x)] for x in rng.normal(size=(60, dims))]
    rows = [(i, x) for i, x in enumerate(ok)] + [(3, ok[3]), (3, ok[7]), (None, ok[9]), (None, ok[8])]
    bad = [(100, None), (101, [None, *ok[0][1:]]), (102, [float("nan"), *ok[0][1:]]), (103, [float("inf"), *ok[0][1:]])]
    return embeddings(spark, [(*r, "x", "y", "z") for r in rows + bad], kind), rows


# --- 11 ------------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, scale, dims, seed="2"):
    """All distances to all centroids, in Python integers."""
    kept = [(i, tuple(floor(Fraction(v) * scale) for v in x)) for i, x in rows if len(x) == dims]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [x for _, x in first]
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids)) for _, x in kept]
        if step == rounds:
            break
        mine = defaultdict(list)
        for (_, x), (_, j) in zip(kept, near, strict=True):
            mine[j].append(x)
        for j, xs in mine.items():
            centroids[j] = tuple(sum(v) // len(xs) for v in zip(*xs, strict=True))
    inertia = defaultdict(int)
    for d, j in near:
        inertia[j] += d
    cut = lambda v: min(v, LONG_MAX)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, cut(d), cut(inertia[j]), cut(sum(inertia.values())), shas[j]) for (i, _), (d, j) in zip(kept, near, strict=True)), key=str)


def as_rows(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_clusters(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    if folder == "sf0.1":  # the odd table has another size of block and fewer clusters
        got = centroid_clustering.cluster(table(spark, sf, "embeddings"), k=7, rounds=2)
        assert as_rows(got.rows) == brute_clusters(rows, 7, 2, 256, 64)
    else:
        assert as_rows(centroid_clustering.op11_centroid_clustering(spark, sf)) == brute_clusters(rows, 40, 5, 256, 64)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters_odd(spark, kind):
    df, rows = odd_vectors(spark, kind)
    extra = [(200, [1.0] * 63, "x", "y", "z"), (201, [], "x", "y", "z")]
    got = centroid_clustering.cluster(df.unionByName(embeddings(spark, extra, kind)), k=12, rounds=3)
    want = brute_clusters(rows, 12, 3, 256, 64)
    assert as_rows(got.rows) == want and len(want) == len(rows)
    assert centroid_clustering.cluster(df.where("false")).rows.collect() == []
    few = centroid_clustering.cluster(df.where("vec_id in (1, 2)"))
    assert len(few.centroids) == 2 and {r.distance for r in few.rows.collect()} == {0}


def test_clusters_equal_vectors(spark):
    rows = [(i, [1.0, -1.0 * (i % 2)]) for i in range(50)]
    df = embeddings(spark, [(*r, "x", "y", "z") for r in rows])
    got = centroid_clustering.cluster(df, k=9, rounds=4, dims=2)
    assert as_rows(got.rows) == brute_clusters(rows, 9, 4, 256, 2)


@pytest.mark.parametrize("huge", [1e6, 3e38])
def test_clusters_huge_components(spark, huge):
    """Components whose squares no 64 bits hold."""
    df, rows = odd_vectors(spark, "double", 8)
    rows = rows + [(300 + i, [huge * (i + 1) / 7] + [0.25 * i] * 7) for i in range(5)]
    df = df.unionByName(embeddings(spark, [(*r, "x", "y", "z") for r in rows[-5:]], "double"))
    got = centroid_clustering.cluster(df, k=6, rounds=3, dims=8)
    assert as_rows(got.rows) == brute_clusters(rows, 6, 3, 256, 8)


def test_scan_stops_strictly_beyond_twice():
    """A centroid at exactly twice the distance may tie; one beyond is not looked at."""
    tables = centroid_clustering._tables([[4], [0], [9]], np.int64)
    at, d, looked = centroid_clustering.assign(np.array([[2], [4]]), np.zeros(2, np.int64), tables)
    assert at.tolist() == [0, 0] and d.tolist() == [4, 0] and looked == 3
    tables = centroid_clustering._tables([[0], [4], [9]], np.int64)
    assert centroid_clustering.assign(np.array([[2]]), np.ones(1, np.int64), tables)[0].tolist() == [0]


def test_scan_looks_at_few_of_far_centroids():
    rng = np.random.default_rng(5)
    centres = (rng.normal(size=(40, 16)) * 4000).astype(int).tolist()
    before = rng.integers(0, 40, 4000)
    x = np.array(centres)[before] + rng.integers(-200, 200, (4000, 16))
    at, _, looked = centroid_clustering.assign(x, before, centroid_clustering._tables(centres, np.int64))
    assert (at == before).all() and looked < 2 * len(x)


def test_exact_sums(spark):
    numbers = [0, 1, -1, 1 << 32, -(1 << 100) + 5, (1 << 64) - 1]
    rows = pa.Table.from_batches([vectors.digits(enumerate(numbers)), vectors.digits(enumerate(numbers))]).to_pandas()
    got = vectors.add_up(spark.createDataFrame(rows, vectors.SUM_SCHEMA))
    assert [got.get(i, 0) for i in range(len(numbers))] == [2 * n for n in numbers]


# --- 12 ------------------------------------------------------------------------------------


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = {d: brute_fingerprint(t) for d, t in rows}
    names = list(fps)
    root = {d: d for d in names}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(names):
        for b in names[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (f"{fps[d]:016x}", find(d)) for d in names}


def test_simhash(spark, sf):
    want = brute_components([(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op12_simhash(spark, sf).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got)


def planted(n, seed):
    """Random fingerprints, and chains of near ones."""
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    near = [fps[:n]]
    for _ in range(3):
        moved = near[-1][: n // 3].copy()
        for _ in range(int(rng.integers(1, 5))):
            moved ^= np.uint64(1) << rng.integers(0, 64, len(moved), dtype=np.uint64)
        near.append(moved)
    return np.unique(np.concatenate([*near, np.array([0, 1, 7, (1 << 64) - 1], np.uint64)]))


def brute_labels(fps):
    label = np.arange(len(fps))
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        if (label == before).all():
            return label


@pytest.mark.parametrize("tile", [simhash.TILE, 40])
def test_units_find_all_links(spark, tile):
    """Whatever the tiles, the components are those of all pairs."""
    from sluicework.operators.components import components

    fps = planted(600, 3)
    classes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    dealt = simhash.units(classes, tile=tile).repartition("unit").sortWithinPartitions("unit")
    got = {r.node: r.component for r in components(dealt.mapInArrow(simhash._compare(3), "u long, v long")).collect()}
    groups = lambda names: sorted(sorted(g) for g in names.values() if len(g) > 1)
    mine, want = defaultdict(list), defaultdict(list)
    for f, c in got.items():
        mine[c].append(f)
    for f, c in zip(fps.view(np.int64).tolist(), brute_labels(fps).tolist(), strict=True):
        want[c].append(f)
    assert groups(mine) == groups(want) and groups(want)


def test_linked_between_and_within():
    fps = planted(300, 8)
    hit, label = simhash.linked(fps, None)
    assert (label == brute_labels(fps)).all()
    assert (hit == ((np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3).sum(axis=1) > 1)).all()
    left, right = fps[::2], fps[1::2]
    hit, _ = simhash.linked(left, right)
    far = np.bitwise_count(left[:, None] ^ right[None, :]) > 3
    assert hit.tolist() == [*(~far.all(axis=1)).tolist(), *(~far.all(axis=0)).tolist()]


def test_units_hold_few_rows(spark):
    """One population count with many classes is cut; no unit holds more than about two tiles, and no class is sent more often than tiles are near."""
    fps = [int(f) for f in np.random.default_rng(1).permutation([sum(1 << b for b in c) for c in combinations(range(30), 3)])]
    dealt = simhash.units(spark.createDataFrame([(f,) for f in fps], "fp long"), tile=200)
    most = max(r["count"] for r in dealt.groupBy("unit").count().collect())
    assert len(fps) == 4060 and most < 2 * 200 * 1.4 and dealt.count() == len(fps) * 21


def test_simhash_odd(spark, odd_docs, no_docs):
    got = simhash.near_copies(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fp, r.component_id))
    assert by[3] == by[4] == by[5] == {(0, 3)} and (0, 3) in by[None]  # without words: the fingerprint zero, and the least id of them
    assert {c for _, c in by[1]} == {1} and len(by[2]) == 2
    assert simhash.near_copies(no_docs).count() == 0
    assert simhash.fingerprint("A\x0bB\tc d".encode()) == brute_fingerprint("a b c d")
    long = " ".join(f"w{i % 977}" for i in range(30000))
    assert simhash.fingerprint(long.encode()) == brute_fingerprint(long)
    assert simhash.fingerprint("Ünïcode İ one".encode()) == brute_fingerprint("Ünïcode İ one")


# --- 13 ------------------------------------------------------------------------------------


def exact_covariance(rows, scale, offset, dims):
    x = [[floor(Fraction(v) * scale) + offset for v in r] + [offset] * (dims - len(r)) for r in rows]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    return x, s, np.array([[(n * sum(r[i] * r[j] for r in x) - s[i] * s[j]) / (n * n) for j in range(dims)] for i in range(dims)])


def check_whitening(rows, got, components=8, scale=1024, offset=100_000, most_error=1e-9):
    """Whatever the eigenvectors' signs: deviations exactly, variances and directions to double precision."""
    dims = max(len(x) for _, x in rows)
    x, s, v = exact_covariance([r for _, r in rows], scale, offset, dims)
    n, e = len(x), np.linalg.eigvalsh(v)[::-1]
    by = defaultdict(list)
    for r in got:
        by[r.vec_id, r.component].append(r)
    assert {c for _, c in by} == set(range(1, components + 1)) and len(got) == n * components
    assert {r.n for r in got} == {n}
    want = sorted((str(i), min(sum((n * a - b) ** 2 for a, b in zip(y, s, strict=True)), LONG_MAX)) for (i, _), y in zip(rows, x, strict=True))
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == want
    for c in range(components):
        assert [*{r.explained for r in got if r.component == c + 1}] == [pytest.approx(e[c] / np.trace(v), rel=1e-6)]
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= most_error
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(y, s, strict=True)] for y in x])
    w, vectors_ = np.linalg.eigh(v)
    for c in range(components):
        direction = vectors_[:, dims - 1 - c]
        mine = np.sort(np.array([r.whitened for r in got if r.component == c + 1]))
        theirs = centred @ direction / np.sqrt(w[dims - 1 - c])
        assert min(np.abs(mine - np.sort(theirs)).max(), np.abs(mine - np.sort(-theirs)).max()) < 1e-6


def test_whitening(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    check_whitening(rows, embedding_whitening.op13_embedding_whitening(spark, sf).collect())


def whitened(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return embedding_whitening.op13_embedding_whitening(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_odd(spark, tmp_path, kind):
    df, rows = odd_vectors(spark, kind, 10)
    more = [(400, [0.5] * 4), (401, [])]  # shorter vectors: what they lack is 0
    df = df.unionByName(embeddings(spark, [(*r, "x", "y", "z") for r in more], kind))
    check_whitening([*rows, *more], whitened(spark, tmp_path, df))


@pytest.mark.parametrize("huge", [5e3, 1e9])
def test_whitening_huge_entries(spark, tmp_path, huge):
    """Far beyond what float sums of squares would keep."""
    df, rows = odd_vectors(spark, "double", 9)
    more = [(500 + i, [huge + i] * 3 + [1.0 * i] * 6) for i in range(4)]
    df = df.unionByName(embeddings(spark, [(*r, "x", "y", "z") for r in more], "double")).where("true")
    n = len(rows) + 4
    dims, got = 9, whitened(spark, tmp_path, df)
    x, s, v = exact_covariance([r for _, r in rows + more], 1024, 100_000, dims)
    want = sorted(min(sum((n * a - b) ** 2 for a, b in zip(y, s, strict=True)), LONG_MAX) for y in x)
    assert sorted(r.deviation for r in got if r.component == 1) == want
    assert got[0].identity_error <= 1e-4


def test_whitening_without_variance(spark, tmp_path):
    one = embeddings(spark, [(i, [0.5, 0.25], "x", "y", "z") for i in range(5)])
    assert whitened(spark, tmp_path / "a", one) == [] and whitened(spark, tmp_path / "b", one.where("false")) == []
    two = embeddings(spark, [(i, [0.5 * i, 0.25, 1.0 * i], "x", "y", "z") for i in range(5)])
    got = whitened(spark, tmp_path / "c", two)
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)


def test_scatter_is_exact_whatever_the_shift(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(np.float32(rng.normal(size=(300, 5)) + 1000))]
    df = spark.createDataFrame(rows, "id long, vector array<float>").repartition(3)
    fits = [embedding_whitening.fit(df, 5, shift=shift) for shift in (0, 100_000, 1_124_000, 1 << 70)]
    assert all((f.eigenvalues == fits[0].eigenvalues).all() and (f.vectors == fits[0].vectors).all() for f in fits)
    assert (np.linalg.eigh(exact_covariance([x for _, x in rows], 1024, 0, 5)[2])[0][::-1] == fits[0].eigenvalues).all()


def test_cross_products():
    rng = np.random.default_rng(4)
    y = rng.integers(-(1 << 20), 1 << 20, (9000, 6))
    assert (embedding_whitening.cross_products(y) == y.astype(object).T.dot(y.astype(object))).all()
