import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import clusters, similar

SCHEMA = "chunk_id string, modality string, embedding array<float>, vec_key string, list string"


def made(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(25):
        centre = rng.normal(size=64)
        for k in range(rng.integers(2, 14)):
            v = centre + rng.normal(size=64) * rng.choice([0.1, 0.3, 0.45])
            rows.append((f"g{g:02}_{k:02}", ["text", "image"][g % 2], (v * rng.choice([1.0, 0.001, 50.0])).astype("f4").tolist()))
    same = rng.normal(size=64).astype("f4").tolist()
    rows += [(f"same{k:02}", "text", same) for k in range(15)]
    rows += [(f"noise{k}", "text", rng.normal(size=64).astype("f4").tolist()) for k in range(200)]
    bad = [[0.0] * 64, [1.0] * 63, [], None, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63]
    rows += [rows[0], *((f"bad{k}", "text", b) for k, b in enumerate(bad)), (None, "text", same), ("nomod", None, same), ("huge", "code", [3e38] * 64), ("tiny", "code", [1e-44] + [0.0] * 63), ("hole", "text", [None] + [1.0] * 63)]
    return [(*r, "x", "x") for r in rows]


def usable(rows):
    out = {}
    for c, m, e, *_ in rows:
        if c and e is not None and len(e) == 64 and None not in e and np.isfinite(e).all() and np.any(np.array(e) != 0):
            v = np.array(e, "f4").astype("f8")
            v /= np.abs(v).max()
            out[c] = (m, v / np.linalg.norm(v))
    return out


def test_most_similar(spark):
    rows = made()
    u = usable(rows)
    ids = sorted(u)
    x = np.stack([u[i][1] for i in ids])
    s = np.round(x @ x.T, 6)
    want = set()
    for a in range(len(ids)):
        near = sorted((b for b in range(len(ids)) if b != a and x[a] @ x[b] >= 0.85), key=lambda b: (-s[a, b], ids[b]))[:10]
        want |= {(ids[a], ids[b], k + 1) for k, b in enumerate(near)}
    got = {(r.chunk_id, r.other_id, r["rank"]) for r in similar.most_similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got & want) >= 0.98 * len(want)
    assert len(got - want) <= 0.02 * len(want)
    assert [b for a, b, r in sorted(got, key=lambda x: x[2]) if a == "same12"] == ["nomod", *(f"same{k:02}" for k in range(9))]


def recall(spark, x, names):
    """Share of the true neighbours that are found, and of what is found that are true."""
    u = x.astype("f8") / np.linalg.norm(x.astype("f8"), axis=1, keepdims=True)
    n = len(x)
    want = set()
    for at in range(0, n, 1000):
        s = np.round(u[at : at + 1000] @ u.T, 6)
        s[np.arange(len(s)), at + np.arange(len(s))] = -2
        order = np.lexsort((np.broadcast_to(np.arange(n), s.shape), -s), axis=1)[:, :10]
        want |= {(names[at + a], names[b]) for a, row in enumerate(order) for b in row if s[a, b] >= 0.85}
    rows = [(c, "text", v.tolist(), "x", "x") for c, v in zip(names, x)]
    got = {(r.chunk_id, r.other_id) for r in similar.most_similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    return len(got & want) / len(want), len(got & want) / len(got), len(want)


@pytest.mark.parametrize(("block", "asked"), [(8_192, 65_536), (300, 150)])
def test_a_third_in_one_dense_group(spark, monkeypatch, block, asked):
    """Many lists in one group, blocks that are copied since many ask them."""
    monkeypatch.setattr(similar, "PER_LIST", 20)
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "MOST_ASKED", asked)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    x = np.concatenate([centre + rng.normal(size=(1000, 64)) * np.linalg.norm(centre) / 24, rng.normal(size=(2000, 64))]).astype("f4")
    found, right, n = recall(spark, x, [f"v{k:04}" for k in range(len(x))])
    assert n > 9900 and found >= 0.99 and right >= 0.99


def shuffled(spark):
    """Bytes that each stage so far wrote for a shuffle."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return {(s := stages.apply(k)).stageId(): s.shuffleWriteBytes() for k in range(stages.size())}


def test_queries_travel_short_and_nothing_is_lost(spark, monkeypatch):
    """Every vector visits all blocks: the visits are far below whole vectors, and neighbours closer to each other than the steps of a short vector come out in order."""

    def all_lists(self, *_):
        self.slack = 2.0
        return 3.0

    monkeypatch.setattr(similar, "PER_LIST", 20)
    monkeypatch.setattr(similar, "BLOCK", 150)
    monkeypatch.setattr(similar.Index, "measured", all_lists)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 64))
    x = np.concatenate([centres[k % 4] + rng.normal(size=(1, 64)) * [0.2, 0.02][k % 2] for k in range(600)] + [rng.normal(size=(900, 64))]).astype("f4")
    names = [f"v{k * 7 % 1500:04}" for k in range(len(x))]
    u = x.astype("f8") / np.linalg.norm(x.astype("f8"), axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -2)
    order = np.lexsort((np.broadcast_to(np.array(names), s.shape), -s), axis=1)[:, :10]
    want = {(names[a], names[b], r + 1): s[a, b] for a, row in enumerate(order) for r, b in enumerate(row) if s[a, b] >= 0.85}
    before = shuffled(spark).keys()
    rows = spark.createDataFrame([(c, "text", v.tolist(), "x", "x") for c, v in zip(names, x)], SCHEMA)
    got = {(r.chunk_id, r.other_id, r["rank"]): r.cosine for r in similar.most_similar(rows).collect()}
    assert len(want) == 6000 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1.5e-6 for k in want)
    most = max(size for stage, size in shuffled(spark).items() if stage not in before)
    assert 1500 * 300 < most < 10 * 1500 * 150


def test_copies_of_one_vector_do_not_fill_the_sample(spark):
    """40,000 copies of the vector of least key: the sample holds distinct vectors, so the others' neighbours are found."""
    import xxhash

    rng = np.random.default_rng(9)
    centres = rng.normal(size=(200, 64))
    x = np.concatenate([centres[k % 200] + rng.normal(size=64) * 0.3 for k in range(2400)]).reshape(-1, 64).astype("f4")
    hot = min((rng.normal(size=64).astype("f4") for _ in range(20_000)), key=lambda v: np.uint64(xxhash.xxh3_64_intdigest(v.tobytes())).astype(np.int64))
    names = [f"v{k:04}" for k in range(len(x))]
    copies = spark.range(40_000).selectExpr("concat('z', id) as chunk_id", "'text' as modality").crossJoin(spark.createDataFrame([(hot.tolist(),)], "embedding array<float>")).selectExpr("*", "'x' as vec_key", "'x' as list")
    rows = spark.createDataFrame([(c, "text", v.tolist(), "x", "x") for c, v in zip(names, x)], SCHEMA)
    got = similar.most_similar(rows.unionByName(copies)).where("chunk_id < 'w'").select("chunk_id", "other_id").collect()
    u = x.astype("f8") / np.linalg.norm(x.astype("f8"), axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -2)
    order = np.argsort(-s, axis=1, kind="stable")[:, :10]
    want = {(names[a], names[b]) for a in range(len(x)) for b in order[a] if s[a, b] >= 0.85}
    assert len(want) > 20_000 and len(want & set(map(tuple, got))) >= 0.99 * len(want)


def test_the_tables_decide_what_is_reranked(spark, monkeypatch):
    """Without the products from the tables nothing is found: the rows come through the codes."""
    real = similar.Codes.products
    monkeypatch.setattr(similar.Codes, "products", lambda self, q, c: real(self, q, c) - 2)
    index = similar.Index(np.stack([usable(made())[k][1] for k in sorted(usable(made()))]), 400, 10, 0.85)
    x = np.stack([v for _, v in usable(made()).values()]).astype("f4")
    near, own, codes, _ = index.placed(x)
    t = pa.table({"list": near.astype("i4"), "vec": [v.tobytes() for v in x], "code": [c.tobytes() for c in codes], "own": own, "vec_key": np.arange(len(x)), "chunk_id": [str(k) for k in range(len(x))]})
    base = similar.Base(index, t)
    assert not list(base.near(x, own, np.arange(len(x)), 10, 0.85))
    monkeypatch.setattr(similar.Codes, "products", real)
    assert sum(len(q) for q, _, _ in base.near(x, own, np.arange(len(x)), 10, 0.85)) > 300


@pytest.mark.parametrize(("together", "hot"), [(8192, 16_384), (3, 16_384), (8192, 60)])
def test_clusters(spark, monkeypatch, together, hot):
    monkeypatch.setattr(clusters, "MOST_TOGETHER", together)
    monkeypatch.setattr(clusters, "HOT_CELL", hot)
    rows = made(1)
    u = {k: v for k, v in usable(rows).items() if v[0] is not None}
    ids = sorted(u)
    near = {a: frozenset(b for b in ids if u[a][0] == u[b][0] and (a == b or u[a][1] @ u[b][1] >= 0.85)) for a in ids}
    want = {(a, min(n)) for a, n in near.items() if len(n) >= 5 and all(near[b] == n for b in n)}
    got = {(r.chunk_id, r.cluster_id) for r in clusters.similarity_clusters(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want and len(want) > 20


def test_medoids_and_empty(spark):
    d = spark.createDataFrame(made(1), SCHEMA)
    got = {r.cluster_id: r for r in clusters.described(d).collect()}
    assert got["same00"].size == 15 and got["same00"].medoids == ["same00", "same01", "same02"]
    none = spark.createDataFrame([], SCHEMA)
    assert clusters.similarity_clusters(none).count() == 0 and similar.most_similar(none).count() == 0
