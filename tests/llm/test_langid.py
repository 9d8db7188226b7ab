import zlib

import numpy as np

from ledgerline.llm import langid as L

MEDIUM = "/root/testdata/sf0.01"


def plain(text):
    symbols = [max(2, (ord(c.lower()[0]) ^ ord(c.lower()[0]) >> 16) & 0xFFFF) if c.isalpha() else L.BOUNDARY for c in text]
    out = [L.BOUNDARY] * 3
    for s in symbols + [L.BOUNDARY]:
        if s != L.BOUNDARY or out[-1] != L.BOUNDARY:
            out.append(s)
    return [sum(out[i - k] << 16 * k for k in range(4)) for i in range(3, len(out))]


def test_four_grams_match_a_plain_loop():
    texts = ["ab c", "", "  ,x", "É a1b ", "..", ".", "zz\n\n", "a\0b", "\U00010400x 日本", "ſİ"]
    grams, ends = L.four_grams(texts)
    begin = 0
    for t, e in zip(texts, ends.tolist()):
        assert grams[begin:e].tolist() == plain(t), t
        begin = e


def test_probabilities_of_every_context_sum_to_one():
    grams, counts = np.unique(L.four_grams(["the cat sat on the mat with the hat", "a cat and a bat"])[0], return_counts=True)
    t = L.build({"x": (grams, counts)})
    alphabet = np.unique(grams & np.uint64(0xFFFF))
    for context in np.unique(grams >> np.uint64(16))[:20]:
        both = np.concatenate([(np.uint64(context) << np.uint64(16)) | alphabet])
        at = np.minimum(np.searchsorted(t.keys[0], both), len(t.keys[0]) - 1)
        known = t.keys[0][at] == both
        p = np.where(known, t.values[0][at, 0], (L._at(t, 1, both & np.uint64((1 << 48) - 1)) + L._rows(t.contexts[0], t.weights[0], both >> np.uint64(16)))[:, 0])
        assert 0.9 < (2.0 ** p).sum() <= 1 + 1e-9  # the rest is left for symbols never seen


def test_held_out_accuracy_and_invariance(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = docs.collect()
    held = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    from ledgerline.llm.common import id_remainder

    t = L.fit(docs.where(id_remainder("doc_id", 4) != 2))
    got = {r["doc_id"]: r for r in L.predict(docs, t, ["doc_id"]).collect()}
    truth = {r["doc_id"]: r["lang"] for r in rows}
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.99 * len(held)
    assert np.mean([got[i]["rejected"] for i in held]) < 0.05
    again = L.fit(docs.where(id_remainder("doc_id", 4) != 2).repartition(7))
    assert all(np.array_equal(a, b) for a, b in zip(t.values, again.values))


def test_edge_rows(spark, edge_docs, no_docs):
    t = L.fit(edge_docs)
    out = L.predict(edge_docs, t, ["doc_id", "text"]).collect()
    assert len(out) == edge_docs.count() and set(t.langs) == {"en", "fr"}
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    assert L.fit(no_docs) is None
    assert {r["lang_pred"] for r in L.predict(edge_docs, None, ["doc_id"]).collect()} == {"und"}
    assert L.predict(no_docs, t, ["doc_id"]).collect() == []
    one = L.fit(edge_docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in L.predict(edge_docs, one, ["doc_id"]).collect()} == {"en", "und"}


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("lang in ('en', 'fr')")
    t = L.fit(docs)
    odd = spark.createDataFrame([(1, "зима пришла рано и снег лежал на полях до самой весны")], "doc_id long, text string")
    assert L.predict(odd, t, ["doc_id"]).head()["rejected"]


def test_no_four_gram_is_folded_into_another(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, "".join(map(chr, rng.integers(0x4E00, 0x9F00, 40_000)))) for lang in ("aa", "bb")]
    docs = spark.createDataFrame([(i, s, lang) for i, (lang, s) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {(r["lang"], r["gram"]): r["n"] for r in L.gram_counts(docs).collect()}
    per_lang = {lang: np.unique(L.four_grams([s])[0], return_counts=True) for lang, s in rows}
    assert got == {(lang, g): n for lang, (grams, n) in per_lang.items() for g, n in zip(grams.view(np.int64).tolist(), n.tolist())}
    t = L.build(per_lang)
    for j, (lang, text) in enumerate(rows):  # every gram of a language has that language's own probability
        own, p = L.estimate(*per_lang[lang])[0][0]
        assert np.array_equal(L._at(t, 0, own)[:, j], p)
        h, _ = L.entropies([text], t)
        assert np.isclose(h[0, j], -p[np.searchsorted(own, L.four_grams([text])[0])].mean())
    new = L.four_grams(["".join(map(chr, rng.integers(0x4E00, 0x9F00, 40_000)))])[0]
    new = new[~np.isin(new, t.keys[0])]
    backed_off = L._at(t, 1, new & np.uint64((1 << 48) - 1)) + L._rows(t.contexts[0], t.weights[0], new >> np.uint64(16))
    assert len(new) > 30_000 and np.array_equal(L._at(t, 0, new), backed_off)


def slow_model(text):
    """Interpolated Kneser-Ney by dictionaries of tuples: a function (context of three, symbol) -> probability."""
    from collections import Counter, defaultdict

    grams = [tuple(g >> 16 * k & 0xFFFF for k in (3, 2, 1, 0)) for g in plain(text)]
    levels = [Counter(grams)]
    for _ in range(3):  # continuation counts: distinct longer grams by their end
        levels.append(Counter(g[1:] for g in levels[-1]))
    alphabet = len(levels[-1]) + 1
    tables = []
    for c in levels:
        n1, n2 = (sum(v == k for v in c.values()) for k in (1, 2))
        total, kinds = defaultdict(int), defaultdict(int)
        for g, v in c.items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        tables.append((c, n1 / (n1 + 2 * n2) if n1 and n2 else 0.5, total, kinds))

    def p(context, symbol, level=0):
        if level == 4:
            return 1 / alphabet
        c, d, total, kinds = tables[level]
        below = p(context[1:], symbol, level + 1)
        if context not in total:
            return below
        return max(c[context + (symbol,)] - d, 0) / total[context] + d * kinds[context] / total[context] * below

    return p


def test_estimates_equal_a_plain_model_with_dictionaries():
    texts = {"x": "the cat sat on the mat with the hat, a cat and a bat sat", "y": "zima prishla rano i sneg lezhal na polyah do samoy vesny"}
    t = L.build({k: np.unique(L.four_grams([s])[0], return_counts=True) for k, s in texts.items()})
    models = [slow_model(texts[k]) for k in t.langs]
    probes = list(texts.values()) + ["the sneg cat", "a q z", "hat zima", "日本 the", "", "b"]
    h, letters = L.entropies(probes, t)
    for i, s in enumerate(probes):
        grams = [tuple(g >> 16 * k & 0xFFFF for k in (3, 2, 1, 0)) for g in plain(s)]
        for j, p in enumerate(models):
            want = -sum(np.log2(p(g[:3], g[3])) for g in grams) / len(grams) if grams else 0.0
            assert np.isclose(h[i, j], want, rtol=1e-9), (s, t.langs[j])
        assert letters[i] == sum(c.isalpha() for c in s)


def test_decisions_equal_a_loop():
    rng = np.random.default_rng(3)
    t = L.Tables(["a", "b", "c"], [], [], [], [], np.zeros(3), limit=np.array([2.0, 3.0, np.inf]), lead=np.array([0.2, 1.7]))
    h = np.round(rng.uniform(0, 4, (200, 3)), 1)  # with ties
    letters = rng.integers(0, 900, 200)
    best, score, rejected = L.decide(h, letters, t)
    for i in range(200):
        if not letters[i]:
            assert (best[i], score[i], rejected[i]) == (-1, 0.0, False)
            continue
        low, at = min((v, k) for k, v in enumerate(h[i]))
        gap = min(v for k, v in enumerate(h[i]) if k != at) - low
        assert best[i] == at and rejected[i] == (low > t.limit[at])
        assert np.isclose(score[i], 1 / (1 + np.exp(-(0.2 + 1.7 * gap * np.sqrt(min(letters[i], 400)) / 4))))


def test_groups_of_languages_give_the_same_rows(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = L.fit(docs)
    assert isinstance(whole, L.Tables)
    counts = {r["lang"]: r["count"] for r in L.gram_counts(docs).groupBy("lang").count().collect()}
    parts = L.fit(docs, model_bytes=2 * 2 * max(counts.values()) * 16)
    assert isinstance(parts, L.Grouped) and len(parts.groups) >= 3 and sum(parts.groups, []) == whole.langs
    assert np.allclose(parts.limit, whole.limit) and np.allclose(parts.lead, whole.lead)
    for frame in (docs, edge_docs):
        a, b = (sorted((tuple(r) for r in L.predict(frame, m, ["doc_id", "n_chars"]).collect()), key=repr) for m in (whole, parts))
        assert [x[:3] + x[5:] for x in a] == [x[:3] + x[5:] for x in b]
        assert np.allclose([x[3] for x in a], [x[3] for x in b])
        assert [x[4] is None for x in a] == [x[4] is None for x in b] and np.allclose([x[4] or 0 for x in a], [x[4] or 0 for x in b])
    import pytest

    with pytest.raises(ValueError, match="model_bytes"):
        L.fit(docs, model_bytes=1000)


def test_calibration_takes_every_training_row(spark):
    rng = np.random.default_rng(6)
    words = {"aa": ["kato", "lumi", "sanka", "oro", "vile", "the"], "bb": ["grot", "klimp", "strad", "wurz", "oro", "the"], "cc": ["xiu"]}
    rows = [(None if i % 7 == 0 else i // 2, " ".join(rng.choice(words[x], rng.integers(1, 6))), x) for i in range(2500) for x in ("aa", "bb")]
    rows += [(i, "".join(map(chr, rng.integers(97, 123, 30))), "aa") for i in range(9000, 9040)]  # rare and far from the others
    rows += [(9100, "xiu xiu", "cc"), (9101, "", "aa"), (9102, "12 ..", "bb"), (9103, None, "aa"), (9104, "oro the", None), (9105, " ", "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    t = L.fit(docs)
    known = [(x, s) for _, s, x in rows if x and any(c.isalpha() for c in s or "")]
    y = np.array([t.langs.index(x) for x, _ in known])
    h, letters = L.entropies([s for _, s in known], t)
    assert t.langs == ["aa", "bb", "cc"] and t.limit[2] == np.inf  # one row
    for j in (0, 1):
        assert np.isclose(t.limit[j], np.quantile(h[y == j, j], 0.995) + 0.25, rtol=1e-12)
    low = np.sort(h, axis=1)
    x = np.stack((np.ones(len(y)), np.minimum((low[:, 1] - low[:, 0]) * np.sqrt(np.minimum(letters, 400)) / 4, 30)), axis=1)
    right, w = (h.argmin(axis=1) == y).astype(float), np.array([0.0, 1.0])
    assert 0 < right.mean() < 1
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (right - p) - (w - [0.0, 1.0])), -2, 2)
    assert np.allclose(t.lead, w, rtol=1e-9)
    again = L.fit(docs.repartition(7))
    assert np.array_equal(t.limit, again.limit) and np.array_equal(t.lead, again.lead)
    parts = L.fit(docs, model_bytes=90_000)
    assert isinstance(parts, L.Grouped) and len(parts.groups) > 1
    assert np.allclose(parts.limit, t.limit, rtol=1e-12) and np.allclose(parts.lead, t.lead)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(8)
    groups = [rng.normal(size=1000), np.round(rng.uniform(0, 3, 777), 1), rng.uniform(size=19), np.zeros(20), np.array([]),
              np.repeat([-1.5, 2.5], 100), rng.lognormal(0, 60, 333), np.array([-0.0] * 30 + [0.0] * 30)]
    rows = [(j, int(k)) for j, v in enumerate(groups) for k in L.sortable(v)]
    frame = spark.createDataFrame(rows, "y int, key long").repartition(5)
    for q in (0.0, 0.5, 0.995, 1.0):
        want = [np.quantile(v, q) if len(v) >= 20 else np.inf for v in groups]
        assert np.array_equal(L.quantiles(frame, len(groups), q), want), q
    assert np.array_equal(L.unsorted(L.sortable(groups[0])), groups[0])


def test_texts_without_letters_change_no_other_text():
    t = L.build({"x": np.unique(L.four_grams(["the cat sat on the mat"])[0], return_counts=True)})
    alone = L.entropies(["the hat"], t)[0][0, 0]
    for texts in (["the hat", ""], ["", "the hat"], ["a", "the hat", "", " .", ""], ["the hat", "", "a"]):
        h, letters = L.entropies(texts, t)
        assert h[texts.index("the hat"), 0] == alone and all(h[i, 0] == 0 for i, s in enumerate(texts) if not s.strip(" ."))
