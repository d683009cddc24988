"""Spelling groups, n-gram joins and whitening against brute force on small fixtures."""

import random
import re
import zlib

import numpy as np
import pytest

from touchline.llm import bidiagonal, jaccard, linking, spelling, tries, whitening

from .test_queries import shingles


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- spelling (op 11) ----------------------------------------------------------------------


def spelling_by_force(rows, damage):
    n = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            check = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if check % damage == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if c >= 2}

    def close(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    near = {w: [v for v in n if close(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(
        ((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=repr
    )


@pytest.mark.parametrize("damage", [31, 2])
def test_spelling(spark, documents, damage):
    rng = random.Random(damage)
    words = ["aaaaaaa", "aaaaaaaa", "abababab", "Zeppelin", "straßenbahn", "Élèvement", "quartz×es"]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    rows = [
        (k, " ".join(rng.choice(words[: rng.choice([2, 7, 67])]) for _ in range(rng.randint(0, 60))))
        for k in range(120)
    ]
    rows += [(None, "zeppelin zeppelim zeppelim"), (None, None), (7, ""), (8, " 12 \n"), (8, "Zeppelin-zeppelin")]
    rows += [(9, "y" * 3000), (10, "y" * 3000), (11, "y" * 2999 + " " + "y" * 2999)]
    found = spelling.spelling_groups(documents(rows), damage=damage)
    want = spelling_by_force(rows, damage)
    assert result(found, "word", "form", "root", "n", "n_near", "form_n") == want
    assert any(r[1] for r in want)


def test_spelling_chains(spark):
    words = spark.createDataFrame([(k, k + 1) for k in range(1, 12)], "id long, form long")
    ends = spelling.last_forms(words)
    assert result(ends, "id", "root") == sorted(((k, 12) for k in range(1, 12)), key=repr)


def test_spelling_without_words(documents):
    assert spelling.spelling_groups(documents([(1, None), (2, "short words")])).collect() == []
    assert spelling.spelling_groups(documents([(1, "x")]).limit(0)).collect() == []


def test_trie_nodes_are_prefixes(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, tag long").repartition(7)
    rows = tries.trie_nodes(df, "test").collect()
    nodes = {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) and r["tag"] == 5
        for k, node in enumerate(r["nodes"], 1):
            assert nodes.setdefault(r["word"][:k], node) == node
    assert len(set(nodes.values())) == len(nodes)
    assert [r["word"] for r in sorted(rows, key=lambda r: r["rank"])] == words
    assert sorted(r["rank"] for r in rows) == list(range(len(words)))


# --- n-gram join (op 12) ---------------------------------------------------------------------


def jaccard_by_force(rows, percent=80):
    sets = [frozenset(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(
        ((i, len(sets[k]), least.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)),
        key=repr,
    )


def edited(rng, words, vocabulary):
    out = list(words)
    for _ in range(rng.choice([0, 1, 1, 2, 4])):
        at = rng.randrange(len(out) + 1)
        if rng.random() < 0.5:
            out.insert(at, rng.choice(vocabulary))
        else:
            del out[at : at + 1]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_documents(documents, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(f"P{k}" for k in range(60))
    rows = []
    for k in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 8, 9, 10, 12, 20, 45, 120, 400]))]
        rows += [(3 * k, " ".join(base)), (3 * k + 1, " ".join(edited(rng, base, vocabulary)))]
    for k in range(80):
        own = " ".join(f"{rng.choice(vocabulary)}-{k}" for _ in range(rng.choice([4, 7, 9, 12, 20])))
        rows.append((500 + k, f"{passage} {own}"))
    edges = [(None, ""), (900, None), (901, " \t"), (902, "one two"), (903, "One\ttwo"), (904, "x " * 30_000)]
    copies = [(None, "a b c d e f g h i j")] * 2 + [(None, "only null ids here")] * 2
    twice = [(5, "the same id"), (5, "an unlike text of some more words than that one")] + [(950, rows[3][1])] * 2
    rows += [*edges, *copies, *twice]
    found = jaccard.similar_documents(documents(rows))
    assert result(found, "doc_id", "n_shingles", "component_id") == jaccard_by_force(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_similar_documents_under_any_allocation(documents, monkeypatch, seed):
    """Few exact segments or only neighbourhoods: the links are the same."""
    rng = random.Random(seed)

    def drawn(edges, counts, percent):
        bands = []
        for low, after in zip(edges, edges[1:]):
            high = after - 1
            weight = linking.difference_bound(high, 100 * high // percent, percent) + 1 + rng.randint(0, 3)
            wide = rng.randint(0, weight // 2)
            bands.append(jaccard.Band(low, high, weight - wide, wide))
        return bands

    monkeypatch.setattr(jaccard, "allocation", drawn)
    vocabulary = [f"w{k}" for k in range(40)]
    rows = []
    for k in range(80):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 9, 10, 14, 30, 60]))]
        rows += [(3 * k + j, " ".join(edited(rng, base, vocabulary))) for j in range(3)]
    found = jaccard.similar_documents(documents(rows))
    assert result(found, "doc_id", "n_shingles", "component_id") == jaccard_by_force(rows)


def test_texts_of_one_passage_do_not_meet(spark):
    """Texts that share most of their words, but too few, give no candidates at all."""
    rng = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"{rng.random()}" for _ in range(12))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = linking.set_table(docs, "text", 4, 0).cache()
    posted = spark.createDataFrame(
        [(1, r["node"], r["n"]) for r in sets.collect()], "token long, node long, n long"
    )
    assert linking.prefix_pairs(posted, None, sets, 80).count() == 0


def test_similar_documents_without_rows(documents):
    assert jaccard.similar_documents(documents([(1, "a")]).limit(0)).collect() == []
    found = jaccard.similar_documents(documents([(1, None), (2, "a b")]))
    assert result(found, "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (2, 1, 2)]


def test_colliding_numbers_are_drawn_again(documents, monkeypatch):
    real = linking.node_of
    for module in (jaccard, linking):
        monkeypatch.setattr(module, "node_of", lambda d: 1 if d in first else real(d))
    texts = [f"text number {k} with its own words" for k in range(4)]
    first = {linking.digest_of(jaccard.shingle_set(t.encode()), 0) for t in texts[:2]}
    seen = []
    plain = jaccard.described
    monkeypatch.setattr(jaccard, "described", lambda d, t, i, salt, *more: seen.append(salt) or plain(d, t, i, salt, *more))
    found = jaccard.similar_documents(documents(list(enumerate(texts))))
    assert result(found, "doc_id", "component_id") == [(k, k) for k in range(4)]
    assert seen == [0, 1]


# --- whitening (op 13) -------------------------------------------------------------------------


def whitened_by_force(rows, components):
    good = [
        (i, [int(np.floor(64 * c)) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and np.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]

    def centred(x):
        return np.array([(n * a - s) / n for a, s in zip(x, sums)])

    c = np.array([centred(x) for x in fit])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d)
    rows = [
        (i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), centred(x) @ vectors[:, :k] / np.sqrt(values[:k]))
        for i, x in good
    ]
    return n, rows, values / values.sum()


def test_whitening(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.standard_normal(20) * np.arange(1, 21) / 5).astype("f4").tolist()) for k in range(400)]
    rows += [(k + 400, rows[7][1]) for k in range(150)]  # a hot vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (1000, None), (1001, []), (1002, [None] + [1.0] * 19)]
    rows += [(1003, [float("nan")] * 20), (1004, [float("inf")] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "'a' AS n", "'b' AS x", "'c' AS task", "'d' AS component").repartition(50)
    found = whitening.whitened(df).collect()
    n, want, explained = whitened_by_force(rows, 16)
    assert {r["n"] for r in found} == {n} and max(r["identity_error"] for r in found) < 1e-9
    by_row = {}
    for r in found:
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    assert sum(len(c[1]) for c in by_row.values()) == len(want) == len(found) / 16
    expected = {(i, deviation): w for i, deviation, w in want}
    assert set(by_row) == set(expected)
    got = np.array([[by_row[k][c][0] for c in range(1, 17)] for k in expected])
    plain = np.array(list(expected.values()))
    signs = np.sign((got * plain).sum(axis=0))
    assert np.abs(got - plain * signs).max() < 1e-9


def test_whitening_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(3).tolist()) for k in range(200)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.count() == 600 and found.agg({"identity_error": "max"}).first()[0] < 1e-9


def test_whitening_without_variance(spark):
    layout = "vec_id long, embedding array<double>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whitened(spark.createDataFrame(rows, layout)).collect() == []
    flat = [(1, [1.0, 5.0, 2.0]), (2, [3.0, 5.0, 4.0]), (3, [2.0, 5.0, 2.0])]
    found = whitening.whitened(spark.createDataFrame([*flat, (4, [9.0])], layout)).collect()
    assert sorted(r["component"] for r in found) == [1, 1, 1, 2, 2, 2]


def test_deviations_beyond_a_long():
    x = np.array([[10**15, 0], [10**9, 5]])
    assert whitening._deviations(x, 10**6, (0, 0)) == [None, None]
    assert whitening._deviations(x, 2, (3, 4)) == [None, (2 * 10**9 - 3) ** 2 + 36]


@pytest.mark.parametrize("shape", [(500, 64), (40, 40), (3, 10), (30, 1)])
def test_singular_values(shape):
    a = np.random.default_rng(5).standard_normal(shape)
    a[:, -1] *= 1e-7
    r = whitening._triangle(a, shape[1])
    squares, vectors = bidiagonal.right_singular(r, shape[1])
    want = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(np.sqrt(squares[: len(want)]), want, rtol=1e-10, atol=1e-14)
    images = a @ vectors
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-11
    assert np.allclose(np.linalg.norm(images, axis=0), want[: vectors.shape[1]], rtol=1e-9)


def test_equal_singular_values():
    rng = np.random.default_rng(6)
    u, _ = np.linalg.qr(rng.standard_normal((50, 9)))
    v, _ = np.linalg.qr(rng.standard_normal((9, 9)))
    a = u @ np.diag([5, 5, 5, 4, 4 - 1e-9, 1, 1e-3, 1e-5, 0]) @ v
    squares, vectors = bidiagonal.right_singular(whitening._triangle(a, 9), 9)
    assert vectors.shape[1] == 8
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-11
    cross = (a @ vectors).T @ (a @ vectors)
    assert np.abs(cross - np.diag(squares[:8])).max() < 1e-12
