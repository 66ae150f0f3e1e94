import numpy as np
import pytest

from clicklake.llm import neighbours, topk
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [1.0, None] * 4, 1), (904, [float("nan")] * 8, 1), (905, [1.0] * 8, None), (None, [1.0] * 8, 1), (950, [1.0] * 3, 1)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((260, 8)).astype(np.float32)
    near = base[:1] + 0.05 * rng.standard_normal((90, 8)).astype(np.float32)
    rows = np.vstack([base, near, base[5:9], base[5:6]])
    return [(i, [float(x) for x in v], i % 2 if i < 260 else 0) for i, v in enumerate(rows)]


def test_links_equal_brute_force(spark, vectors):
    found, recall = neighbours.near_duplicate_vectors(spark.createDataFrame(vectors + ODD, SCHEMA).withColumn("node", F.lit("clash")))
    x = np.array([v for _, v, _ in vectors], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([y for *_, y in vectors])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(x)).min(1))
        if (new == root).all():
            break
        root = new
    rows = {r["vec_id"]: r for r in found.collect()}
    assert recall >= 0.99 and len(rows) == len(vectors) + len(ODD)
    for i in range(len(x)):
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (linked[i].sum(), root[i], root[i] == i)
    assert all(rows[i]["n_links"] == 0 and rows[i]["component_id"] == i and rows[i]["kept"] for i, *_ in ODD if i) and not rows[None]["kept"]


def _nodes(spark, x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return spark.createDataFrame([("g", [float(c) for c in v], i, 1) for i, v in enumerate(x)], "grp string, v array<double>, node long, n long")


def test_every_node_has_neighbours_whatever_their_cosines(spark):
    found = neighbours.first_edges(_nodes(spark, np.eye(40)), range(1))
    assert {e for r in found.collect() for e in (r["a"], r["b"])} == set(range(40))


def test_the_descent_goes_on_while_rounds_find_links(spark):
    angle = np.linspace(0, 0.37, 100)
    nodes = _nodes(spark, np.stack([np.cos(angle), np.sin(angle)], 1))
    path = spark.createDataFrame([(i, i + 1, float(np.cos(angle[1]))) for i in range(99)], "a long, b long, sim double")
    found = {(r["a"], r["b"]): r["sim"] for r in neighbours.descend(path, nodes, 0.93).collect()}
    assert max(b - a for a, b in found) > 16
    assert all(abs(sim - np.cos(angle[b] - angle[a])) < 1e-9 for (a, b), sim in found.items())


def test_a_crowd_does_not_hide_lost_pairs(spark):
    rng = np.random.default_rng(5)
    pairs = np.repeat(rng.standard_normal((60, 64)), 2, axis=0) + 0.1 * rng.standard_normal((120, 64))
    nodes = _nodes(spark, np.vstack([rng.standard_normal(64) + 0.1 * rng.standard_normal((300, 64)), pairs]))
    sizes = spark.createDataFrame([(i, 300) for i in range(300)], "node long, size long")
    crowd, pair = [(i, 299) for i in range(300)], [(i, 1) for i in range(300, 420)]
    audit = lambda counts: neighbours._audit(nodes, sizes, spark.createDataFrame(counts, "node long, links long"), 0.93)
    assert audit(crowd) == (0.0, True) and audit(crowd + pair) == (1.0, True) and audit(crowd + pair[:60]) == (0.5, True)


def test_no_link_seen_is_no_evidence(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "AUDITED", 10)
    monkeypatch.setattr(neighbours, "MOST_AUDITED", 20)
    none = spark.createDataFrame([], "node long, links long")
    assert neighbours._audit(_nodes(spark, np.eye(64)), none.withColumnRenamed("links", "size"), none, 0.93) == (None, False)


def test_a_recall_that_stays_low_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MOST_TABLES", 8)
    monkeypatch.setattr(neighbours, "tables_for", lambda *_: 4)
    monkeypatch.setattr(neighbours, "descend", lambda edges, *_: edges.limit(0))
    with pytest.raises(RuntimeError, match="less than"):
        neighbours.near_duplicate_vectors(spark.createDataFrame([(i, [1.0, i / 100], 0) for i in range(6)], SCHEMA))


def test_tables_grow_with_the_label():
    assert neighbours.tables_for(0, 0.93) == neighbours.tables_for(200, 0.93) == 8 < neighbours.tables_for(20_000, 0.93) < neighbours.tables_for(10**8, 0.93)


@pytest.mark.parametrize("block_rows", [40, 10_000])
def test_top_k_equals_brute_force(spark, vectors, block_rows):
    rows = vectors + ODD
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, block_rows=block_rows).collect()
    usable = {i: [int(np.floor(float(np.float32(x)) * 256)) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:5]
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.lit(True)).count() == 0
    assert neighbours.near_duplicate_vectors(empty)[0].count() == 0
