import math
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk, vector_dedup
from tidemark.llm.topk import top_products, usable
from tidemark.llm.vector_dedup import near_duplicates


def _rows(n=400, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    vectors = []
    for i in range(n):
        v = base[rng.integers(len(base))] * rng.uniform(0.5, 2)
        kind = rng.random()
        if kind < 0.6:
            v = v + rng.normal(size=dim) * 0.05 * rng.random()
        vectors.append([float(np.float32(x)) for x in v])
    for i in range(60):
        vectors[i] = vectors[0]
    rows = [(i, v, int(i % 3) if i >= 60 else 1) for i, v in enumerate(vectors)]
    odd = [None, [0.0] * dim, [math.nan] + [1.0] * (dim - 1), [math.inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [], [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(n + 50, vectors[0], None), (n + 51, [-0.0 + x for x in vectors[0]], 1)]
    return rows


def _bad(v):
    return not v or any(x is None or not math.isfinite(x) for x in v)


def test_vector_links_match_brute_force(spark, monkeypatch):
    rows = _rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    good = {i: (np.array(v, np.float32).astype(float), c) for i, v, c in rows if not _bad(v) and c is not None and any(v)}
    linked = {i: set() for i, _, _ in rows}
    for i, (x, c) in good.items():
        for j, (y, d) in good.items():
            if i != j and c == d and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                linked[i].add(j)
    component = {}
    for i in sorted(linked):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in component:
                component[j] = i
                todo += linked[j]
    for block in (2048, 8):
        monkeypatch.setattr(vector_dedup, "BLOCK", block)
        monkeypatch.setattr(vector_dedup, "LIST", 50)
        got = {r["vec_id"]: r for r in near_duplicates(frame).collect()}
        assert len(got) == len(rows)
        for i in linked:
            assert got[i]["n_links"] == len(linked[i]), i
            assert got[i]["component_id"] == component[i]
            assert got[i]["kept"] == (component[i] == i)


def test_probes_and_pruning_lose_no_neighbour():
    rng = np.random.default_rng(2)
    x = vector_dedup._unit(rng.normal(size=(3000, 12)))
    model = vector_dedup.Quantiser(x[:1000], 20)
    cell, codes, errors, to_centres = model.encode(x)
    probed = model.probes(cell, to_centres, 0.2)
    close = np.argwhere(x @ x.T >= 0.98)
    assert all(probed[q, cell[y]] for q, y in close)
    assert 0 < probed.mean() < 1
    pairs = set()
    for c in range(len(model.centres)):
        q, y = np.nonzero(probed[:, c])[0], np.nonzero(cell == c)[0]
        a, b = vector_dedup._match(model, c, x[q], x[y], codes[y], errors[y], 0.2, 0.98)
        pairs.update(zip(q[a].tolist(), y[b].tolist()))
    assert pairs == set(map(tuple, close.tolist()))


def test_no_usable_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    got = near_duplicates(spark.createDataFrame([(1, None, 1), (2, [1.0], None)], schema)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


def _floor(v):
    return [math.floor(1024 * x) for x in v]


def test_top_products_match_brute_force(spark, monkeypatch):
    rows = _rows(700, 8, 9)
    rng = np.random.default_rng(1)
    rows += [(2000 + i, [float(x) for x in rng.normal(size=8) * 10 ** rng.uniform(-2, 2)], 0) for i in range(300)]
    rows += [(i, r[1], r[2]) for i, r in zip(range(5000, 5100), rows)] + [(9000, [1e12] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vector = F.when(usable(F.col("embedding")), F.transform("embedding", lambda x: F.floor(x * 1024)))
    ready = frame.select("vec_id", vector.alias("vector"), F.lit("clash").alias("norm"))
    good = [(i, _floor(v)) for i, v, _ in rows if not _bad(v) and max(map(abs, v)) < 1e11]
    expected = set()
    for i, q in good:
        if i % 100 == 0:
            scored = sorted((-sum(map(int.__mul__, q, p)), j) for j, p in good if j != i and len(p) == len(q))[:10]
            expected.update((i, n + 1, j, -s) for n, (s, j) in enumerate(scored))
    usual = ready.filter("vec_id <> 9000")
    for bucket, queries in ((2048, 512), (32, 4)):
        monkeypatch.setattr(topk, "BUCKET", bucket)
        monkeypatch.setattr(topk, "QUERIES", queries)
        got = top_products(usual, F.col("vec_id") % 100 == 0, id="vec_id").collect()
        assert set(map(tuple, got)) == expected and len(got) == len(expected)


def test_few_or_no_candidates(spark):
    schema = "vec_id long, vector array<bigint>"
    assert top_products(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0, id="vec_id").collect() == []
    three = spark.createDataFrame([(0, [1, 2]), (1, [0, 0]), (2, [-3, 1]), (100, None)], schema)
    got = top_products(three, F.col("vec_id") % 100 == 0, id="vec_id").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 0), (0, 2, 2, -1)]


def test_pruning_keeps_vectors_along_a_coordinate():
    rng = np.random.default_rng(4)
    for noise in (0.0, 0.03, 0.3):
        vectors = np.eye(64)[rng.integers(8, size=2000)] + rng.normal(size=(2000, 64)) * noise
        vectors = np.floor(vectors * rng.uniform(0.5, 2, size=(2000, 1)) * 1024).astype(np.int64)
        vectors = vectors[np.argsort(-(vectors**2).sum(axis=1), kind="stable")]
        ids, asked = np.arange(2000), np.arange(0, 2000, 100)
        least = topk.bounds(asked, vectors[asked], ids, vectors, 10)
        found = {q: (i.tolist(), s.tolist()) for q, i, s in topk.search(asked, vectors[asked], least, ids, vectors, 10)}
        for q in asked:
            scores = vectors @ vectors[q]
            best = [i for i in np.lexsort((ids, -scores)).tolist() if i != q][:10]
            assert found[q] == (best, scores[best].tolist())


def test_top_products_of_one_hot_like_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = np.eye(16)[rng.integers(4, size=600)] * rng.uniform(0.5, 2, size=(600, 1))
    vectors = (vectors + rng.normal(size=(600, 16)) * 0.01) * rng.choice([-1, 1], size=(600, 1))
    whole = np.floor(vectors * 1024).astype(np.int64)
    expected = set()
    for q in range(0, 600, 100):
        scores = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(600), -scores)).tolist() if i != q][:10]
        expected.update((q, n + 1, i, int(scores[i])) for n, i in enumerate(best))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(whole.tolist())], "vec_id long, vector array<bigint>")
    for bucket in (2048, 32):
        monkeypatch.setattr(topk, "BUCKET", bucket)
        got = top_products(frame, F.col("vec_id") % 100 == 0, id="vec_id").collect()
        assert set(map(tuple, got)) == expected and len(got) == len(expected)


def test_vectors_link_in_every_dimension(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(900, [1.0, 2.0], 1), (901, [2.0, 4.0], 1), (902, [2.0, 4.0], 2), (903, [3.0], 1), (904, [5.0], 1), (905, [-5.0], 1)]
    for i, dim in enumerate([16] * 200 + [8] * 120 + [5] * 30):
        kind = np.zeros(dim)
        kind[rng.integers(4)] = 1
        rows.append((i, (kind * rng.uniform(0.5, 2) + rng.normal(size=dim) * 0.04).tolist(), int(rng.integers(2))))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = {i: set() for i, _, _ in rows}
    for i, v, c in rows:
        for j, w, d in rows:
            if i != j and c == d and len(v) == len(w) and np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98:
                linked[i].add(j)
    assert linked[900] == {901} and linked[903] == {904} and all(any(linked[i] for i in r) for r in (range(200), range(200, 320), range(320, 350)))
    least = {}
    for i in sorted(linked):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in least:
                least[j] = i
                todo += linked[j]
    for block in (2048, 8):
        monkeypatch.setattr(vector_dedup, "BLOCK", block)
        monkeypatch.setattr(vector_dedup, "LIST", 50)
        got = {tuple(r) for r in near_duplicates(frame).collect()}
        assert got == {(i, len(linked[i]), least[i], least[i] == i) for i in linked}


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().endswith(".data")}


def test_vectors_cross_the_network_once_whatever_the_probes(spark, monkeypatch):
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(4000, 32)).astype(np.float32)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    frame = frame.withColumn("label", F.lit(1))
    monkeypatch.setattr(vector_dedup, "LIST", 50)
    before = set(_shuffle_files(spark))
    assert near_duplicates(frame).filter("n_links > 0").count() == 0
    moved = sum(n for name, n in _shuffle_files(spark).items() if name not in before)
    assert moved < 8 * vectors.nbytes


def test_links_of_many_regions_and_equal_hashes(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(60, 12))
    vectors = [(base[rng.integers(60)] * rng.uniform(0.5, 2) + rng.normal(size=12) * 0.06 * rng.random()).tolist() for _ in range(600)]
    vectors += [vectors[0]] * 20 + [[0.0, 3.0], [-0.0, 3.0], [0.0, 4.0]]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(i + 1000, v, 2) for i, v in enumerate(vectors[:30])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = {i: set() for i, _, _ in rows}
    for i, v, c in rows:
        for j, w, d in rows:
            if i != j and c == d and len(v) == len(w) and np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98:
                links[i].add(j)
    least = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in least:
                least[j] = i
                todo += links[j]
    expected = {(i, len(links[i]), least[i], least[i] == i) for i in links}
    monkeypatch.setattr(vector_dedup, "LIST", 50)
    monkeypatch.setattr(vector_dedup, "BLOCK", 8)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert {tuple(r) for r in near_duplicates(frame).collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    monkeypatch.setattr(vector_dedup, "BLOCK", 2048)
    monkeypatch.setattr(vector_dedup, "_hash", lambda: F.pmod(F.xxhash64("label", "vector"), F.lit(5)))
    assert {tuple(r) for r in near_duplicates(frame).collect()} == expected


def test_blocks_of_alike_vectors_are_not_broadcast(spark):
    shares = [3, -1, 4, 1, -5, 9, -2, 6]
    rows = spark.range(20_000).select("id", F.array(*((F.col("id") % 4 + 1) * x for x in shares)).alias("vector"))
    found = top_products(rows, F.col("id") % 50 == 0)
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert not [x for x in re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*?)\]", plan) if re.search("vectors|ids", x)]
    square = sum(x * x for x in shares)
    expected = {(q, n + 1, 3 + 4 * n, square * 4 * (q % 4 + 1)) for q in range(0, 20_000, 50) for n in range(10)}
    assert {tuple(r) for r in found.collect()} == expected


def test_products_of_all_widths_are_exact():
    rng = np.random.default_rng(12)
    for size in (100, 3000, 10**6, 10**8):
        vectors = rng.integers(-size, size, size=(400, 24))
        vectors = vectors[np.argsort(-(vectors.astype(float) ** 2).sum(axis=1), kind="stable")]
        ids, asked, held = np.arange(400), np.arange(0, 400, 40), topk._narrow(vectors)
        least = topk.bounds(asked, held[asked], ids, held, 10)
        found = {q: (i.tolist(), s.tolist()) for q, i, s in topk.search(asked, held[asked], least, ids, held, 10)}
        for q in asked.tolist():
            scores = [sum(map(int.__mul__, vectors[q].tolist(), v)) for v in vectors.tolist()]
            best = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:10]
            assert found[q] == (best, [scores[i] for i in best])
