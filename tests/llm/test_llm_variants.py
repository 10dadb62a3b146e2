"""Spelling variants, pivot index and periodic runs against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import edge_rows, empty, frame
from pyspark.sql import functions as F

from ledgerlens.llm import periodic, pivot_index, spelling
from ledgerlens.llm.queries import planted_period


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_vocabulary(rows, min_length, min_count, slips):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slips and h % slips == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            seen[w] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}


def brute_groups(counted, ratio):
    form, near = {}, {}
    for w, n in counted.items():
        others = [o for o in counted if one_edit(w, o)]
        best = min(others, key=lambda o: (-counted[o], o), default=None)
        near[w] = len(others)
        form[w] = best if best is not None and counted[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, near[w], counted.get(form[w])) for w, n in counted.items()}


def misspelt_rows(seed=2, n=150):
    r = random.Random(seed)
    letters = "abcdeéÿ×"
    base = ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(60)]
    words = []
    for k, w in enumerate(base):
        words += [w] * (1 + 3 * (k % 20))
        for _ in range(4):
            i = r.randrange(len(w))
            words += [r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i + 1 :], w[:i] + r.choice(letters) + w[i:]])] * r.randint(1, 5)
    r.shuffle(words)
    texts = [" ".join(words[k::n]) for k in range(n)] + ["x" * 60_000, "x" * 60_001, "x" * 60_001, "É" + "x" * 59_999]
    return edge_rows() + [(1000 + i, t if i % 3 else t.upper().replace("É", "é").replace("×", ";"), "en", "a", 1) for i, t in enumerate(texts)]


def test_variants_equal_brute_force(spark):
    rows = misspelt_rows()
    for symbols, slips in ((8, 7), (2, 0), (1, 3)):
        counted = spelling.vocabulary(frame(spark, rows), min_length=4, min_count=1, slips=slips)
        want = brute_vocabulary(rows, 4, 1, slips)
        assert {x["word"]: x["n"] for x in counted.collect()} == want
        got = spelling.group_variants(counted, ratio=3, symbols=symbols).collect()
        assert {x["word"]: tuple(x)[1:] for x in got} == brute_groups(want, 3)
        assert len(got) == len(want)
    counted = spelling.vocabulary(frame(spark, rows), slips=5)
    assert {x["word"]: x["n"] for x in counted.collect()} == brute_vocabulary(rows, 6, 5, 5)


def test_long_chains_and_no_words(spark):
    counted = {"aaaaa" + "b" * k: 5**k for k in range(14)}
    df = spark.createDataFrame(list(counted.items()), "word STRING, n BIGINT")
    got = spelling.group_variants(df).collect()
    assert {x["word"]: tuple(x)[1:] for x in got} == brute_groups(counted, 5)
    assert {x["root"] for x in got} == {"aaaaa" + "b" * 13}
    assert spelling.group_variants(df.limit(0)).count() == 0
    assert spelling.group_variants(spelling.vocabulary(empty(spark))).count() == 0


def test_neighbourhoods_are_full():
    r = random.Random(1)
    for length in (1, 2, 5, 9):
        for block in (1, 1_000_000):
            rows = np.array([[r.randint(1, 3) for _ in range(length)] for _ in range(4)], np.uint64)
            got = {(w, k) for who, key in spelling.neighbours(rows, 3, block) for w, k in zip(who.tolist(), key.tolist())}
            want = set()
            for i, row in enumerate(rows.tolist()):
                near = {tuple(row)} | {tuple(row[:p] + row[p + 1 :]) for p in range(length) if length > 1}
                near |= {tuple(row[:p] + [c] + row[p + 1 :]) for p in range(length) for c in (1, 2, 3)}
                near |= {tuple(row[:p] + [c] + row[p:]) for p in range(length + 1) for c in (1, 2, 3)}
                want |= {(i, int(spelling.reduced(np.array([x], np.uint64))[0])) for x in near}
            assert got == want


def brute_links(rows, cosine):
    good = [k for k, (_, v) in enumerate(rows) if v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(rows[k][1]) for k in good)
    m = np.array([list(rows[k][1]) + [0.0] * (width - len(rows[k][1])) for k in good])
    m /= np.abs(m).max(axis=1, keepdims=True)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    near = m @ m.T >= cosine
    n, comp = [0] * len(rows), list(range(len(rows)))
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        n[good[a]] += 1
        n[good[b]] += 1
    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        x, y = find(good[a]), find(good[b])
        comp[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), n[k], str(least.get(find(k)))) for k, (i, _) in enumerate(rows))


def clustered(seed, n, width):
    g = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = g.normal(size=width)
        rows.append(v)
        for _ in range(g.integers(0, 3)):
            w = g.normal(size=width)
            w -= (w @ v) / (v @ v) * v
            c = g.uniform(0.9, 1.0)
            rows.append(g.uniform(0.1, 9) * (c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * w / np.linalg.norm(w)))
    dense = g.normal(size=width)
    rows += [dense + 0.05 * g.normal(size=width) for _ in range(n // 3)]
    rows += [dense] * (n // 3)
    return [(int(i), [float(x) for x in v]) for i, v in zip(g.permutation(len(rows)) * 2, rows)]


def test_links_and_recall_equal_brute_force(spark, monkeypatch):
    """All links of these are found; the second pass has short lists in many parts, named by several pivots."""
    odd = [(901, None), (903, [0.0] * 32), (905, [1.0, None]), (907, [float("nan")] * 32), (909, []), (911, [float("inf"), 1.0]), (913, [1e300, 1e300]), (915, [1e-300, 1e-300, 0.0]), (None, [2.0, 2.0]), (None, [-0.0, 0.0]), (None, None), (4, [3.0, 3.0, -0.0]), (4, [0.5] * 32)]
    rows = clustered(3, 150, 32) + odd
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, m INT, cid STRING").repartition(5)
    want = brute_links(rows, 0.95)
    for length in (2048, 9):
        monkeypatch.setattr(pivot_index, "LIST_ROWS", length)
        got, described = pivot_index.near_vectors(df)
        assert sorted((str(x["vec_id"]), x["n_links"], str(x["component_id"])) for x in got.collect()) == want
        assert all(len(set(x["pivots"])) == pivot_index.NEAREST for x in described.collect())


def test_recall_in_few_dimensions(spark):
    for width, seed in ((2, 5), (6, 6)):
        rows = clustered(seed, 80, width)
        df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
        single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
        got = sum(x["n_links"] for x in pivot_index.near_vectors(df)[0].collect())
        want = sum(n for _, n, _ in brute_links(single, 0.95))
        assert 0.9 * want <= got <= want


def test_vector_edges(spark):
    none = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert pivot_index.near_vectors(none)[0].count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.1])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(tuple(x) for x in pivot_index.near_vectors(few)[0].collect()) == [(1, 1, 1), (2, 0, 2), (3, 1, 1)]
    blank = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(tuple(x) for x in pivot_index.near_vectors(blank)[0].collect()) == [(1, 0, 1), (2, 0, 2)]


def brute_runs(w, min_length=6, times=4):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, times * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((a, n, q) for (a, n), q in out.items())


def repeated_words(r, n):
    w = [r.randrange(r.choice([1, 2, 2, 3, 9])) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        if n > 8:
            a = r.randrange(n - 4)
            p = r.randint(1, max(1, (n - a) // 3))
            for i in range(a, r.randint(a + 1, n)):
                w[i] = w[a + (i - a) % p]
    if r.random() < 0.2:
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        w = (y[:n] * 4)[: 4 * n]
    return w


def test_runs_equal_brute_force():
    r = random.Random(8)
    found = 0
    for _ in range(400):
        docs = [repeated_words(r, r.choice([0, 1, 5, 6, 7, 20, 60, 150])) for _ in range(r.randint(1, 4))]
        got = periodic.find_runs(np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs], np.int64))
        for i, d in enumerate(docs):
            assert [tuple(x) for x in got[got[:, 0] == i][:, 1:].tolist()] == brute_runs(d), d
        found += len(got)
    assert found > 300
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(4, np.int64), np.array([4]), times=2)


def test_range_successor():
    r = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 100):
        values = r.permutation(n)
        tree = periodic.WaveletTree(values)
        a, b = np.sort(r.integers(0, n + 1, (2, 300)), axis=0)
        x = r.integers(0, n + 1, 300)
        want = [min((v for v in values[i:j].tolist() if v >= y), default=-1) for i, j, y in zip(a, b, x)]
        assert tree.successor(a, b, x).tolist() == want


def test_runs_and_collapsed_texts(spark):
    r = random.Random(5)
    texts = [" ".join(f"w{x}" for x in repeated_words(r, r.choice([3, 30, 90]))) for _ in range(80)]
    texts += ["a " * 3_000, "a  b\t" * 900, "é x\x0by\x0cz \x1c \x85 " * 9]
    rows = edge_rows() + [(1000 + i, t, "en", "a", 1) for i, t in enumerate(texts)]
    for order in (planted_period, lambda doc_id, n: None):
        got = periodic.periodic_runs(frame(spark, rows), order).collect()
        want = []
        for i, t, *_ in rows:
            w = re.findall("[^\x20\x09-\x0d]+", t or "")
            at = order(i, len(w))
            w = w if at is None else [w[k] for k in at.tolist()]
            runs = brute_runs(w)
            gone = {k for a, n, q in runs for k in range(a + q, a + n)}
            want.append((str(i), len(w), runs, hashlib.md5(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
        assert sorted((str(x["doc_id"]), x["n_words"], [tuple(y) for y in x["runs"]], hashlib.md5(x["collapsed"].encode()).hexdigest()) for x in got) == sorted(want)
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_planted_order_is_the_contracts():
    for i in range(200):
        h = zlib.crc32(str(i).encode())
        at = planted_period(i, 50)
        assert (at is None) == (h % 10 != 0) and planted_period(i, 0) is None
        if at is not None:
            a = h // 10 % 50
            p = 1 + (50 - a) // (3 + h // 10 % 8)
            assert at.tolist() == [k if k < a else a + (k - a) % p for k in range(50)]
    assert planted_period(None, 5).tolist() == [0, 1, 0, 1, 0]  # the crc32 of no text is 0


def test_queries_run_whole_and_kept_is_never_null(spark):
    from ledgerlens.llm.queries import QUERIES

    got = QUERIES["op12_pivot_index"](spark, "/root/testdata/sf0.001")
    assert got.filter(F.col("kept").isNull()).count() == 0
