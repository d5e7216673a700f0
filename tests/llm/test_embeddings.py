import duckdb
import numpy as np

from finseries.llm import embeddings, registry

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    ok = []
    for r in rows:
        v = r[1]
        fine = r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.float32(v).astype(float) if fine else None)
    links = {i: set() for i in range(len(rows))}
    for i, x in enumerate(ok):
        for j, y in enumerate(ok):
            if i != j and x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[i].add(j)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len({rows[j][0] for j in links[i]} - {r[0]}), c, r[0] == c))
    return sorted(out, key=str)


def vectors(n=150, dim=32, seed=3):
    rng = np.random.default_rng(seed)
    rows, v = [], None
    for i in range(n):
        if i % 5 and v is not None:
            w = v + rng.normal(0, 0.02 * (i % 4 + 1), dim)
        else:
            v = w = rng.normal(size=dim)
        rows.append((i, [float(x) for x in np.float32(w)], i % 3))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(30)]  # a hot vector
    rows += [(2000, [2 * x for x in rows[7][1]], rows[7][2]), (2001, rows[7][1], None), (2002, None, 1), (2003, [], 1), (2004, [0.0] * dim, 1),
             (2005, [float("nan")] * dim, 1), (2006, [float("inf")] + [1.0] * (dim - 1), 1), (2007, [None] * dim, 1), (2008, [1.0, 2.0], 1), (2009, [1.0, 2.0], 1),
             (None, rows[7][1], rows[7][2])]
    rows += [rows[7], rows[7], rows[12], rows[n], (2010, [float(i) for i in range(dim)], 1), (2010, [float(i) for i in range(dim)], 1)]  # repeated rows
    return rows


def test_equals_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS a", "'x' AS code")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_repeated_rows_agree_with_the_sql_twin(spark, tmp_path):
    rows = [r for r in vectors(40) if r[0] is not None and not 2002 <= r[0] < 2010]  # vectors the twin can compare
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = registry.op5_embedding_near_dups(spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept").collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = db.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({registry.ORACLE['op5_embedding_near_dups']})").fetchall()
    assert {tuple(r) for r in got} == set(want) and len(got) == len(rows)


def test_recall_near_the_threshold():
    """Pairs at a cosine of just 0.98 share a table with at most one bit apart."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.98 * base + np.sqrt(1 - 0.98 ** 2) * side
    mean, projection = embeddings.learn_rotation(base)
    a, b = (embeddings.codes(x, mean, projection) for x in (base, near))
    apart = np.array([[bin(x ^ y).count("1") for x, y in zip(r, s)] for r, s in zip(a.tolist(), b.tolist())])
    met = (apart.min(axis=1) <= 1) & (apart.sum(axis=1) <= embeddings.RADIUS)
    assert met.mean() >= 0.995
    assert abs(np.unpackbits(a.astype("<u2").view(np.uint8)).mean() - 0.5) < 0.05  # balanced bits


def test_recall_with_a_large_common_component():
    """Unit vectors of mean pair cosine 0.9; other pairs at 0.98 than those planted to choose the tables."""
    rng = np.random.default_rng(13)
    base = rng.normal(size=(3000, 64))
    base = np.sqrt(0.1) * base / np.linalg.norm(base, axis=1, keepdims=True) + np.sqrt(0.9) * np.eye(64)[0]
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = embeddings.planted(base, 0.98, seed=17)
    assert np.allclose((base * near).sum(axis=1) / np.linalg.norm(near, axis=1), 0.98)
    mean, projection, radius = embeddings.choose_tables(base, 0.98)
    apart = np.bitwise_count(embeddings.codes(base, mean, projection) ^ embeddings.codes(near, mean, projection))
    assert ((apart.min(axis=1) <= 1) & (apart.sum(axis=1) <= radius)).mean() >= 0.98


def test_vectors_without_a_common_component_keep_six_tables():
    base = np.random.default_rng(9).normal(size=(3000, 64))
    _, projection, radius = embeddings.choose_tables(base, 0.98)
    assert projection.shape[1] == embeddings.BITS and radius == embeddings.RADIUS


def test_shared_direction_equals_brute_force(spark):
    rows = [(r[0], [x + 12.0 * (j == 0) for j, x in enumerate(r[1])], r[2]) for r in vectors()[:150]]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want) > 0


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
