import numpy as np

from tallyloom.llm import vectors


def brute(rows, threshold=0.93):
    ok = [(k, np.array(v, float), y) for k, v, y in rows if k is not None and v and y is not None and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links = {}
    for i, (a, v, y) in enumerate(ok):
        for j, (b, w, z) in enumerate(ok):
            if i != j and y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links.setdefault(a, []).append(b)
    out = {}
    for k, _, _ in rows:
        if k is None:
            continue
        seen, todo = {k}, [k]
        while todo:
            for b in links.get(todo.pop(), []):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out[k] = (len(links.get(k, [])), min(seen), min(seen) == k)
    return out


def test_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 24))
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(base)]
    for i in range(0, 300, 6):
        for k, noise in enumerate((0.0, 0.05, 0.25, 0.4)):
            v = base[i] + noise * rng.normal(size=24)
            rows.append((1000 + 4 * i + k, (v * (k + 1)).astype(np.float32).tolist(), int((i + (k == 3)) % 3)))
    # A crowd in one cell, larger than a block.
    rows += [(5000 + i, (base[1] + 0.08 * rng.normal(size=24)).astype(np.float32).tolist(), 1) for i in range(vectors.BLOCK + 60)]
    rows += [(9000, None, 1), (9001, [0.0] * 24, 1), (9002, [float("nan")] * 24, 1), (9003, [None] * 24, 1), (9004, rows[0][1], None), (9005, [1.0, 2.0], 0),
             (9006, [2.0, 4.0], 0), (9007, [], 0), (9008, [float("inf")] + [0.0] * 23, 0), (None, rows[0][1], 0)]
    frame = spark.createDataFrame([r + ("x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, rep string, h1 string").repartition(5)
    got = vectors.near_vectors(frame).collect()
    assert len(got) == len(rows)
    want = brute([(k, None if v is None else [None if x is None else np.float32(x) for x in v], y) for k, v, y in rows])
    wrong = [r for r in got if r.vec_id is not None and (r.n_links, r.component_id, r.kept) != want[r.vec_id]]
    links = sum(w[0] for w in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in got if r.vec_id is not None), "no link below the threshold"
    assert sum(r.n_links for r in got) >= 0.99 * links and len(wrong) < 0.02 * len(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]


def test_traversal_visits_the_nearest_cells():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.MultiIndex(x, 9, 0.93, 0.99)
    cells = index.traverse(x[:50])
    a, b = index._distances(x[:50])
    for r in range(50):
        total = (a[r][:, None] + b[r][None]).ravel()
        assert np.allclose(np.sort(total[cells[r]]), np.sort(total)[:len(cells[r])]) and total[cells[r][0]] == total.min()


def test_repeated_rows_and_empty(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1)], "vec_id bigint, embedding array<double>, label int")
    assert sorted(tuple(r) for r in vectors.near_vectors(frame).collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert vectors.near_vectors(frame.limit(0)).collect() == []
