"""URL filter, n-gram model and toxicity against brute force."""
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_cases import edge_rows, empty, frame
from pyspark.sql import functions as F

from ledgerlens.llm import kneser_ney, toxicity, url_filter
from ledgerlens.llm.common import crc_mod
from ledgerlens.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com", "https://a.example.com/en/", "http://notexample.com/en/1", "ftp://x.NET/es/1", "http://net/fr/", "http://é.net/es/\nq", "http://h?p://x", "http://x.org/fr/", "http://X#y", "a://b://c/d", "http://a.com/\u0130"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id BIGINT, url STRING, rule STRING")
    got = {r["page_id"]: r for r in url_filter.judge(df, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(v, t) for v, t in URL_RULES if (host == (n := t.split("/", 1)[0]) or host.endswith("." + n)) and path.startswith(t[len(n) :])]
        best = max(fits, key=lambda r: len(r[1]), default=(None, None))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best[1]), u
        assert got[i]["verdict"] == best[0] or best[0] is None and got[i]["verdict"] in ("allow", "block")


def test_ratio_separates_unruled_urls(spark):
    rows = []
    for i in range(600):
        rows.append((3 * i, f"http://docs{i % 7}.example.com/fr/guide/{i}"))
        rows.append((3 * i + 1, f"http://casino{i % 7}.example.net/es/win-{i}"))
    rows += [(10_000 + i, f"http://docs{i}.example.org/guide/{i}") for i in range(20)]
    rows += [(20_000 + i, f"http://casino{i}.example.org/win-{i}") for i in range(20)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id BIGINT, url STRING"), URL_RULES).collect()}
    assert sum(got[10_000 + i] == "allow" for i in range(20)) >= 19
    assert sum(got[20_000 + i] == "block" for i in range(20)) >= 19


def test_markov_model_by_hand():
    urls = ["ab/1", "ab", "", "xy.z"]
    index, n = url_filter.symbols(urls)
    assert n.tolist() == [5, 3, 1, 5] and len(index) == 14
    counts = np.bincount(index, minlength=url_filter.SYMBOLS ** 4)
    log_p = url_filter.log_probabilities(counts)
    assert np.allclose(np.exp(log_p).reshape(-1, url_filter.SYMBOLS).sum(axis=1), 1)
    code = {"a": 4, "b": 5}

    def p(context, c):  # Witten-Bell, straight from the definition
        grams = Counter()
        for u in urls:
            s = [0] * 3 + [int(url_filter._OF_BYTE[b]) for b in u.encode()] + [1]
            for i in range(3, len(s)):
                for k in range(4):
                    grams[tuple(s[i - k : i + 1])] += 1
        value = 1 / url_filter.SYMBOLS
        for k in range(len(context) + 1):
            h = tuple(context[len(context) - k :])
            seen = {g: x for g, x in grams.items() if len(g) == k + 1 and g[:-1] == h}
            total, kinds = sum(seen.values()), len(seen)
            value = (seen.get((*h, c), 0) + kinds * value) / (total + kinds) if total else value
        return value

    at = ((0 * url_filter.SYMBOLS + 0) * url_filter.SYMBOLS + code["a"]) * url_filter.SYMBOLS + code["b"]
    assert math.isclose(log_p[at], math.log(p((0, 0, code["a"]), code["b"])))


def test_url_edges(spark):
    none = spark.createDataFrame([], "page_id BIGINT, url STRING")
    assert url_filter.judge(none, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/a")], "page_id BIGINT, url STRING")
    assert url_filter.judge(one, URL_RULES).first()["verdict"] == "allow"
    assert math.isclose(url_filter.best_cut([("allow", 5, 10), ("block", -5, 10), ("block", 5, 1)]), 0.005)


def brute_model(documents, order):
    """Straight from the formulas, on word tuples."""
    grams = {order: Counter()}
    for words in documents:
        s = [" b"] * (order - 1) + words + [" e"]
        for i in range(order - 1, len(s)):
            grams[order][tuple(s[i - order + 1 : i + 1])] += 1
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    tables = {}
    for n, c in grams.items():
        of = Counter(c.values())
        d = [0, *kneser_ney._discounts([of[k] for k in (1, 2, 3, 4)])]
        contexts = defaultdict(lambda: [0, 0.0])
        for g, x in c.items():
            contexts[g[:-1]][0] += x
            contexts[g[:-1]][1] += d[min(x, 3)]
        tables[n] = c, d, contexts
    types = len({g[-1] for g in grams[order]})

    def p(gram):
        if not gram:
            return 1 / (types + 1)
        c, d, contexts = tables[len(gram)]
        x = c.get(gram, 0)
        total, left = contexts.get(gram[:-1], (0, 0))
        return max(x - d[min(x, 3)], 0) / total + left / total * p(gram[1:]) if total else p(gram[1:])

    return lambda words: sum(math.log10(p(tuple(s[i - order + 1 : i + 1]))) for s in [[" b"] * (order - 1) + words + [" e"]] for i in range(order - 1, len(s)))


def test_kneser_ney_equals_brute_force(spark, monkeypatch):
    words = lambda t: [w.decode("utf-8") for w in (t or "").encode().lower().split()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    rows = edge_rows()
    for order, spread in ((1, False), (2, False), (2, True), (3, True)):
        if spread:  # frequent contexts are spread over shards by their last word
            hashes = {n: np.sort(np.array([int(kneser_ney.hash_of([np.array([kneser_ney.WORDS[w]], np.uint64) for w in g])[0]) for g in found], np.uint64)) for n, found in ((2, [(b"the",), (b"x",), (kneser_ney.BEGIN,)]), (3, [(b"x", b"x"), (kneser_ney.BEGIN, kneser_ney.BEGIN)]))}
            monkeypatch.setattr(kneser_ney, "_frequent", lambda *a, h=hashes: h)
        docs = frame(spark, rows)
        model = kneser_ney.train(docs, crc_mod("doc_id", 5) != 1, order)
        got = kneser_ney.score(docs, model, crc_mod("doc_id", 5) == 1).collect()
        training = [words(r[1]) for r in rows if not held(r[0])]
        brute = brute_model(training, order)
        uni = Counter(w for d in training for w in [*d, " e"])
        total, kinds = sum(uni.values()), len(uni)
        want = []
        for r in rows:
            t = [*words(r[1]), " e"]
            base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
            want.append((str(r[0]), held(r[0]), len(t), sum(w in uni for w in t), total, round(base, 6), round(brute(words(r[1])), 6)))
        assert sorted((str(r["doc_id"]), *(round(x, 6) if isinstance(x, float) else x for x in tuple(r)[1:])) for r in got) == sorted(want), (order, spread)


def test_counts_beyond_four_bytes(tmp_path):
    """What a shard's file holds is not clipped."""
    from ledgerlens.llm.common import write_file

    model = kneser_ney.Model(str(tmp_path), 2, 0, {2: np.zeros(0, np.uint64)}, {1: {}, 2: {}}, {1: (0.5, 0.5, 0.5), 2: (0.5, 0.5, 0.5)}, 10, 2)
    parts = [np.array([1], "<u8"), np.array([7], "<u8"), np.array([2**40], "<u8")]
    write_file(model.folder, "grams-2-00000000", [x.tobytes() for x in parts])
    write_file(model.folder, "contexts-2-00000000", [x.tobytes() for x in [*parts, np.array([1, 2, 2**35], "<u8")]])
    reader = kneser_ney.Reader(model)
    assert reader.counts(2, 0)[1].tolist() == [2**40]
    assert reader.contexts(2, 0)[1].tolist() == [2**40] and reader.contexts(2, 0)[2][:, 0].tolist() == [1, 2, 2**35]


def test_kneser_ney_edges(spark):
    docs = frame(spark, edge_rows())
    untrained = kneser_ney.train(docs, F.lit(False), 2)
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in kneser_ney.score(docs, untrained, F.lit(True)).collect())
    assert kneser_ney.score(empty(spark), kneser_ney.train(empty(spark), F.lit(True), 2), F.lit(True)).count() == 0


TOXIC = ["You are a stupid loser.", "What worthless trash!", "Idiot clown"]
CLEAN = ["The tide was low today.", "Bread needs water and salt.", "She reads in the garden", "Trains leave at noon!"]


def toxic_rows(n=400):
    rnd = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        s = [CLEAN[k] for k in rnd.integers(0, 4, rnd.integers(1, 9))]
        if bad:
            s.insert(int(rnd.integers(0, len(s) + 1)), TOXIC[int(rnd.integers(0, 3))])
        rows.append((i, " ".join(s), "en", "a", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_learns_sentences_from_document_labels(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows)
    given_ = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, None)], "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.train(docs, given_, crc_mod("doc_id", 4) != 2)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model, 0.3, ["doc_id"]).collect()}
    text = {r[0]: r[1] for r in rows}
    for i, _, toxic in labels:
        assert got[i]["predicted"] == toxic, (text[i], got[i])
        found = [text[i][s["start"] : s["end"]].strip() for s in got[i]["sentences"]]
        assert bool(found) == bool(toxic) and all(any(t[:8] in f for t in TOXIC) for f in found)


def test_noisy_or_by_hand():
    model = toxicity.Model(-2.0, {"bad": 3.0, "bad*": 0.0, "awfu*": 1.5})
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    want = 1 - (1 - sigmoid(-2)) * (1 - sigmoid(1.0)) * (1 - sigmoid(-0.5))
    assert math.isclose(toxicity.score_texts(model, ["fine day. Bad bad! awfully"])[0], want)
    assert math.isclose(toxicity.score_texts(model, [""])[0], sigmoid(-2))


def test_fit_by_parts_changes_nothing_and_takes_less_memory(monkeypatch):
    rnd = np.random.default_rng(5)
    texts = [" ".join(". " if x > 0.95 else f"w{int(x * 4000)}" for x in rnd.random(1000)) for _ in range(400)]
    data = bags([(t + (" awful." if i % 3 == 0 else ""), int(i % 3 == 0)) for i, t in enumerate(texts)])
    whole = toxicity.fit(data, steps=20)
    tracemalloc.start()
    monkeypatch.setattr(toxicity, "FIT_WORDS", 5_000)
    assert toxicity.fit(data, steps=20) == whole
    assert tracemalloc.get_traced_memory()[1] < 20 * len(data.sentence_words)
    tracemalloc.stop()
    assert toxicity._parts(np.array([2, 2, 9, 10]), 3) == [(0, 2, 0, 2), (2, 3, 2, 9), (3, 4, 9, 10)]


def test_kept_text_goes_to_the_workers_once(spark):
    docs = frame(spark, edge_rows())
    scored = toxicity.score(docs, toxicity.Model(-2.0, {"bad": 3.0}), 0.3, ["doc_id", "text"])
    assert "_scored_text" not in scored._jdf.queryExecution().analyzed().toString()
    alone = toxicity.score(docs, toxicity.Model(-2.0, {"bad": 3.0}), 0.3, ["doc_id"])
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["score"])
    assert sorted(alone.collect(), key=key) == sorted(scored.drop("text").collect(), key=key)


def test_toxicity_edges(spark):
    docs = frame(spark, edge_rows())
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.train(docs, none, F.lit(True))
    scored = toxicity.score(docs, model, 0.3, ["doc_id"]).collect()
    assert len(scored) == len(edge_rows()) and all(r["predicted"] == 0 for r in scored)
    assert toxicity.score(empty(spark), model, 0.3, ["doc_id"]).count() == 0
    assert toxicity.fit(bags([("a b", 1)])).base > 0


def bags(rows):
    out = toxicity.Bags()
    for text, label in rows:
        out.add(text, label)
    return out


def test_fit_equals_the_formulas():
    """Against gradient steps on dense matrices of every feature."""
    rows, labels = toxic_rows(40)
    rows = [(r[1], x[2]) for r, x in zip(rows, labels)]
    sentences = [[set(s.replace("\x01", "").split()) for s in " ".join(toxicity.words(t)).split("\x01")] for t, _ in rows]
    counts = Counter(f for d in sentences for f in {f for s in d for w in s for f in toxicity.features(w)})
    kept = sorted(f for f, n in counts.items() if n >= 4)
    x = np.array([[sum(f in toxicity.features(w) for w in s) for f in kept] for d in sentences for s in d], float)
    doc = np.repeat(np.arange(len(rows)), [len(d) for d in sentences])
    y = np.array([label for _, label in rows])
    w, base, m, v = np.zeros(len(kept)), -5.0, 0.0, 0.0
    for step in range(1, 61):
        p = 1 / (1 + np.exp(-base - x @ w))
        keep = np.array([np.prod(1 - p[doc == d]) for d in range(len(rows))])
        slope = np.where(y > 0, -keep / (1 - keep), 1.0)[doc] * p / len(rows)
        grad = np.append(x.T @ slope + toxicity.DECAY / 10 * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = toxicity.RATE * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, base = w - move[:-1], base - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - toxicity.RATE * toxicity.SPARSE / (np.sqrt(v[:-1] / (1 - 0.99**step)) + 1e-6), 0)
    got = toxicity.fit(bags(rows), steps=60)
    assert abs(got.base - base) < 1e-6
    assert set(got.weights) == {f for f, k in zip(kept, w) if k}
    assert all(abs(got.weights[f] - k) < 1e-6 for f, k in zip(kept, w) if k)


def test_every_flagged_text_names_sentences():
    model = toxicity.Model(-2.2, {"b": 0.3, "bad": 3.0})
    weak = "a. b. c. d"
    assert toxicity.score_texts(model, [weak])[0] > 0.3
    found = toxicity.worst_sentences(model, weak, 0.6)
    assert len(found) >= 2 and any(weak[a:b].strip() == "b" for a, b, _ in found)
    strong = "Calm. \u201cBad\u201d (bad) ΒΑΣ.Β day! Calm"
    [(a, b, p)] = toxicity.worst_sentences(model, "Calm. (bad) day! Calm")
    assert "Calm. (bad) day! Calm"[a:b] == " (bad) day" and p > 0.6
    alone = [toxicity.score_texts(model, [strong[a:b]])[0] for a, b, _ in toxicity.worst_sentences(model, strong, 1.0)]
    assert np.isclose(1 - np.prod(1 - np.array(alone)), toxicity.score_texts(model, [strong])[0])
    assert toxicity.worst_sentences(model, "") == []
