"""Operators 1, 2, 3, 4, 8 and 9: brute force, held-out accuracy and odd inputs."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorline.llm import langid, mixing, neighbours, quality, toxicity, urlfilter

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# 1 ---------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    """sizes: source -> words, in order; caps are found one round at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = dict(zip(names, [(5, 2, 1)[i % 3] for i in range(len(names))]))
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        rate = (total - sum(capped.values())) / max(1e-12, sum(w[s] for s in left))
        over = [s for s in left if rate * w[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **{s: rate * w[s] for s in left}}
        capped.update({s: 2.0 * sizes[s] for s in over})


def test_mixing(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        s = r.choice(["a", "b", "b", "b", "é", "zz", None])
        rows.append((i, " ".join("w" for _ in range(r.randint(0, 30) * (40 if i == 7 else 1))), s))
    rows += [(9, None, "a"), (9, None, "a"), (10, "x y", "only"), (None, "p q r", "a"), (11, "t t", "a"), (11, "t t", "a")]
    df = spark.createDataFrame([(i, t, s, 1, "k") for i, t, s in rows], "doc_id long, text string, source string, size int, target string")
    out, draws = mixing.mix(df)
    got = out.collect()
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(map(repr, mixing.mix(df)[0].collect()))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source], rel=1e-9)
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    d = draws.collect()
    assert sum(x.words for x in d) == sum(taken.values()) and {x.shard for x in d} <= set(range(64))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    words = {}
    for x in mixed.collect():
        words[x.source] = words.get(x.source, 0) + len(x.text.split())
    assert words == {s: n for s, n in taken.items() if n}
    assert mixing.mix(df.limit(0))[0].count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


def test_splitting_tree_keeps_quotas(spark):
    """Each node halves its units, leaves add up to the quotas, and sources spread as draws without replacement do."""
    what = lambda *v: F.struct(*[F.lit(x).alias(n) for x, n in zip(v, ("source", "pass", "drawn"))])
    quotas = spark.range(2).select(F.when(F.col("id") == 0, what("a", 0, 1)).otherwise(what("b", 0, 1)).alias("what"), F.when(F.col("id") == 0, 256).otherwise(768).cast("long").alias("quota"))
    rows = mixing.split(quotas, 3, 5).collect()
    total, of_a = {}, {}
    for x in rows:
        total[x.shard] = total.get(x.shard, 0) + x.quota
        if x.what.source == "a":
            of_a[x.shard] = x.quota
    assert total == dict.fromkeys(range(8), 128) and sum(of_a.values()) == 256
    assert all(10 < n < 56 for n in of_a.values()) and len(set(of_a.values())) > 1


def test_leaves_draw_disjoint_blocks(spark):
    """Every block is in one shard a pass; leaves draw as many as the quota says; another tree draws other blocks."""
    blocks = spark.range(600).select(F.when(F.col("id") % 3 == 0, "a").alias("source"), F.col("id").alias("block"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).cast("long").alias("_passes"), F.lit(0.4).alias("_part"))
    draws = {}
    for levels in (1, 4):
        rows = mixing.drawn_blocks(blocks, levels, 3).collect()
        assert len(rows) == len({(x.source, x.block, x["pass"]) for x in rows}) == 800
        part = [x for x in rows if x["pass"] == (1 if x.source == "a" else 0)]
        assert sum(x.drawn for x in part if x.source == "a") == 80 and sum(x.drawn for x in part if x.source is None) == 160
        assert all(x.drawn for x in rows if x.source == "a" and x["pass"] == 0)
        sizes = [sum(x.shard == i for x in rows) for i in range(1 << levels)]
        assert max(sizes) - min(sizes) <= levels
        draws[levels] = {(x.source, x.block) for x in part if x.drawn}
    assert draws[1] != draws[4]


def test_mix_depends_on_the_tree(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"), F.lit(1.5).alias("_row"))
    a, b = ({r.doc_id: (r.taken, r.source) for r in mixing.mix(df, shards=n)[0].collect()} for n in (2, 32))
    assert a != b
    for s in range(5):
        assert len({sum(t for t, x in y.values() if x == f"s{s}") for y in (a, b)}) == 1
    mixed = mixing.mixed_documents(df, shards=8)
    assert mixed.columns == df.columns
    _, draws = mixing.mix(df, shards=8)
    shard = {}
    for x in draws.collect():
        shard.setdefault(x.doc_id, set()).add(x.shard)
    place = [(i, [r.doc_id for r in p]) for i, p in enumerate(mixed.rdd.glom().collect()) if p]
    assert sum(len(p) for _, p in place) == draws.count()
    for _, ids in place:  # shard by shard, each of them whole and shuffled
        if len(ids) > 100:
            assert ids != sorted(ids)
    assert mixed.count() == draws.count()


def test_equal_and_null_ids(spark):
    rows = [(None, f"{'w ' * (i % 9)}{i}", "a") for i in range(300)] + [(7, "same text here", "a")] * 50 + [(7, "other", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out, _ = mixing.mix(df)
    got = out.collect()
    assert len(got) == len(rows) and sum(x.taken for x in got) == round(1.5 * sum(len(t.split()) for _, t, _ in rows))
    one, two = (sorted(map(str, mixing.mixed_documents(df).collect())) for _ in range(2))
    assert one == two and sum(len(x.text.split()) for x in mixing.mixed_documents(df).collect()) == sum(x.taken for x in got)


# 2 ---------------------------------------------------------------------------------------------------------


def brute_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fit = [(len(h + p), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("many", [False, True])
def test_urls(spark, many):
    urls = ["http://com/", "https://a.COM/x?q", "http://xcom/", "http://example.com/en/1", "http://www.example.com/en", "http://www.example.com/en/#f", "https://b.www.example.com/en/x/y", "http://a.net/es/", "http://a.net/fr/x", "http://a.net/frx", "x", None, "", "://", "http://", "http://com", "http://com?/a", "http://a..com/", "ftp://u@h.com:80/p", "a://b://c/d", "http://.com/", "HTTP://É.com/é", "http://a\n.com/x\ny"]
    rules = urlfilter.RULES
    if many:
        r = random.Random(2)
        rules = rules + [(".".join(r.choice("abcd") * 2 for _ in range(r.randint(1, 3))), "/" + "/".join(r.choice("xyz") for _ in range(r.randint(0, 2))), r.choice(["allow", "block"])) for _ in range(3000)]
        seen = {}
        for h, p, a in rules:
            seen[h + p] = max(seen.get(h + p, ("",))[-1:], (a,)) and (h, p, max(a, seen.get(h + p, ("", "", ""))[2]))
        rules = list(seen.values())
        urls += [f"http://{'.'.join(r.choice('abcd') * 2 for _ in range(4))}/{r.choice('xyz')}/{r.choice('xyz')}" for _ in range(500)]
    urls += [f"http://{'a.' * 30_000}net/es/", "http://net" + ".net" * 30_000 + "/" + "x" * 100_000]
    rows = [(i % 400, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[1], "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    rf = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, action string")
    got = [tuple(x) for x in urlfilter.filter_urls(df, rf).collect()]
    assert sorted(got, key=repr) == sorted([(i, *brute_url(u, rules)) for i, u, _ in rows], key=repr)
    assert urlfilter.filter_urls(df.limit(0), rf).count() == 0
    assert {x.verdict for x in urlfilter.filter_urls(df, rf.limit(0)).collect()} == {"allow"}


def test_bloom_only_prunes(spark):
    """The filter passes every listed key and few others."""
    rules = urlfilter.canonical(spark.range(5000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"), F.lit("block").alias("action")))
    words, blocks = urlfilter.bloom(rules)
    asked = spark.range(20000).select("id", F.concat(F.lit("h"), "id", F.lit("/")).alias("k"))
    block, probes = urlfilter._probes(F.col("k"), blocks)
    hit = F.lit(True)
    for w, b in probes:
        hit &= F.get("_words", w).bitwiseAND(urlfilter._bit(b)) != 0
    out = asked.withColumn("_block", block).join(words, "_block").where(hit).select("id").collect()
    assert sum(x.id < 5000 for x in out) == 5000 and sum(x.id >= 5000 for x in out) < 600


# 3 ---------------------------------------------------------------------------------------------------------


def test_languages_held_out(spark):
    out = langid.query(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(docs, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert out.where("held_out").select("doc_id").first()[0] is not None
    for x in out.select("doc_id", "held_out").limit(50).collect():
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2)


def test_languages_odd_inputs(spark):
    train = [(i, t, l) for i, (t, l) in enumerate([("the quick brown fox " * 9, "en"), ("der schnelle braune fuchs " * 9, "de"), ("la volpe veloce bruna " * 9, "it")] * 4)]
    f = langid.train(spark.createDataFrame([*train, (90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string"))
    rows = [(1, "THE quick fox", "q"), (2, None, None), (3, "12 _ !", None), (4, "", None), (5, "schnelle " * 300000, None), (5, "volpe\0veloce", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = langid.identify(df, f)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "coverage"]
    assert [x.lang_pred for x in got.collect()] == ["en", "und", "und", "und", "de", "it"]
    assert all(0 <= x.score <= 1 for x in got.collect())
    none = langid.train(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {x.lang_pred for x in langid.identify(df, none).collect()} == {"und"} and langid.identify(df.limit(0), f).count() == 0


def test_language_of_a_tiny_corpus_by_hand(spark):
    """Scores from n-gram shares counted one by one: an n-gram belongs to a language if its frequency there is near its greatest."""
    train = [(1, "abab abab abab", "x"), (2, "cdcd cdcd cdcd", "y"), (3, "abab cdcd", None)]
    f = langid.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))

    def grams(t):
        return [t[i : i + n] for n in (2, 3, 4) for i in range(len(t) - n + 1)]

    held = {}
    for _, t, lang in train[:2]:
        n = {g: grams(t).count(g) for g in grams(t)}
        held[lang] = {g for g, c in n.items() if c >= langid.LEAST}
    for text, want in (("abab", "x"), ("cdcd abab cdcd", "y"), ("cd", "y")):
        share = {k: sum(g in v for g in grams(text)) / len(grams(text)) for k, v in held.items()}
        names, score, top = f.decide([text])
        assert names == [want] and top[0] == pytest.approx(share[want], abs=1e-3) and score[0] == pytest.approx(share[want] / sum(share.values()), abs=1e-3)


def test_many_languages_and_exact_filters():
    """With more languages than bits in a byte, the counts are never below the exact ones and exceed them by the expected share."""
    r = np.random.default_rng(0)
    names = [f"l{i:02}" for i in range(20)]
    texts = ["".join(chr(97 + c) for c in r.integers(0, 26, 400)) for _ in names]
    of = {n: np.unique(langid.grams([t])[0]) for n, t in zip(names, texts)}
    f = langid.Filters(names, of, 1 << 16)
    total, hits, _ = f.counts(texts)
    h, doc, _ = langid.grams(texts)
    for d in range(20):
        exact = np.array([np.isin(h[doc == d], of[n]).sum() for n in names])
        assert (hits[d] >= exact).all() and total[d] == (doc == d).sum() and (hits[d] - exact).sum() < 0.05 * 20 * total[d]
    assert f.decide(texts)[0] == names


# 4 ---------------------------------------------------------------------------------------------------------


def brute_near(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % 20 == 0:
            s = sorted(((-float((q * v).sum()), j) for m, (j, v) in enumerate(ok) if j != i))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return out


@pytest.mark.parametrize("share", [4, 16_384])
def test_neighbours_exact_when_all_is_probed(spark, monkeypatch, share):
    monkeypatch.setattr(neighbours, "CHUNK", 64)
    monkeypatch.setattr(neighbours, "SHARE", share)
    r = np.random.default_rng(3)
    rows = [(i, r.integers(-3, 4, 8).astype(float).tolist()) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(100)] + [(1000, None), (1020, [0.0] * 8), (1040, [1.0] * 7), (1041, [float("nan")] + [1.0] * 7), (1042, [None] + [1.0] * 7), (1043, [float("inf")] + [1.0] * 7)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(map(tuple, neighbours.search(df, F.col("vec_id") % 20 == 0, probe=1.0, rerank=500, lists=8).collect()))
    assert got == sorted(brute_near(rows))
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("part", [64, 16_384])
def test_all_pairs_in_shares_and_shards(spark, monkeypatch, part):
    """Ties, copies and unusable rows where every share of the queries meets every shard; nothing of the index is fitted."""
    monkeypatch.setattr(neighbours, "CHUNK", part)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "Index", None)
    r = np.random.default_rng(5)
    rows = [(i, r.integers(-3, 4, 8).astype(float).tolist()) for i in range(2600)]
    rows += [(4000 + i, rows[5][1]) for i in range(100)] + [(5000, None), (5020, [0.0] * 8), (5040, [1.0] * 7), (5042, [None] + [1.0] * 7), (5043, [float("inf")] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, neighbours.exact(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == sorted(brute_near(rows))
    assert neighbours.exact(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.exact(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.exact(df, F.lit(False)).count() == 0


def test_neighbours_recall(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x, ids = np.array(e.embedding.tolist(), float), e.vec_id.to_numpy()
    got = {k: set(v) for k, v in neighbours.query(spark, SF).toPandas().groupby("query_id").vec_id}
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        recall.append(len(set(ids[np.argsort(-s, kind="stable")[:20]]) & got[ids[q]]) / 20)
    assert len(got) == len(recall) and np.mean(recall) >= 0.9


def test_repeated_query_rows_list_each_neighbour_once(spark):
    r = np.random.default_rng(4)
    x = [(i, r.normal(size=8).tolist()) for i in range(200)]
    once = neighbours.search(spark.createDataFrame(x, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, probe=1.0)
    x += [x[20], x[20], (40, [9.0] * 8), (None, [1.0] * 8)]
    twice = neighbours.search(spark.createDataFrame(x, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, probe=1.0)
    a, b = ({q: [t.vec_id for t in sorted(d.collect(), key=lambda t: t["rank"]) if t.query_id == q] for q in (20, 60)} for d in (once, twice))
    assert a[20] == [i for i in b[20] if i != 40] + a[20][len([i for i in b[20] if i != 40]):] and len(b[20]) == 20
    ids = [t.query_id for t in twice.collect()]
    assert all(ids.count(q) == 20 for q in range(0, 200, 20))


def test_short_list_decides_and_not_all_lists_are_visited(spark):
    """Recall on a table where the search is not exhaustive; fewer codes on the short list find less."""
    r = np.random.default_rng(12)
    centres = r.normal(size=(60, 32))
    x = centres[r.integers(0, 60, 6000)] + r.normal(size=(6000, 32)) * 0.7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    s = x[::20] @ x.T
    s[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    best = {20 * i: set(np.argsort(-s[i], kind="stable")[:20].tolist()) for i in range(300)}
    index = neighbours.Index(x, 128)
    assert index.visits(x, 20, 0.95) < 64

    def recall(**kw):
        got = neighbours.search(df, F.col("vec_id") % 20 == 0, **kw).toPandas().groupby("query_id").vec_id
        return np.mean([len(best[q] & set(v)) / 20 for q, v in got])

    assert recall() >= 0.93 > recall(rerank=20) and recall(probe=0.02) < 0.9


def test_queries_unlike_the_vectors_and_codes_of_long_vectors(spark):
    """Lists and short lists are measured on the queries themselves, whatever the vectors around them are like."""
    r = np.random.default_rng(21)
    apart = r.normal(size=(80, 32))[r.integers(0, 80, 6000)] + r.normal(size=(6000, 32)) * 0.2
    apart[::20] = r.normal(size=(300, 32))
    for x in (apart, r.normal(size=(4000, 300))):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        s = x[::20] @ x.T
        s[np.arange(len(s)), np.arange(0, len(x), 20)] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :20]
        got = neighbours.search(df, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id").vec_id
        assert np.mean([len(set(best[q // 20]) & set(v)) / 20 for q, v in got]) >= 0.93 and len(got) == len(s)


def test_every_query_gets_k_rows_where_lists_are_small(spark):
    """A query's own code is no part of its short list, and lists are visited until they hold k others."""
    r = np.random.default_rng(22)
    x = np.repeat(r.normal(size=(300, 8)), 12, axis=0) + r.normal(size=(3600, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, probe=0.001, lists=256).groupBy("query_id").count().toPandas()
    assert len(got) == 180 and set(got["count"]) == {20}
    near, ids, which = np.ones((2, 3)), np.array([5, 5, 6, 7]), np.array([0, 1, 1, 2])
    assert neighbours.hide_own(near, np.array([5, 7]), ids, which).tolist() == [[-np.inf, 1, 1], [1, 1, -np.inf]]


def test_neighbours_of_a_hot_group_of_near_copies(spark):
    r = np.random.default_rng(11)
    x = r.normal(size=(8000, 64)) / 8
    x[:4800] = x[np.arange(4800) % 12] + r.normal(size=(4800, 64)) * 0.00003
    x[4800:4840] = x[4800]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = neighbours.search(df, F.col("vec_id") % 40 == 0, probe=1.0, lists=16).toPandas()
    got = {k: v.sort_values("rank") for k, v in out.groupby("query_id")}
    assert len(got) == 200
    for q in range(0, 8000, 40):
        s = np.einsum("nd,d->n", x, x[q])
        s[q] = -np.inf
        want = np.argsort(-s, kind="stable")[:20]
        assert got[q].vec_id.tolist() == want.tolist() and np.allclose(got[q].score, s[want])


# 8 ---------------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    out = toxicity.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    x = out.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("hit"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong")).first()
    assert x.hit >= 0.85 and x.wrong <= 0.01


def test_toxicity_odd_inputs(spark):
    rows = [(i, ("you idiot " if i % 3 == 0 else "you friend ") + "word" * (i % 5), int(i % 3 == 0)) for i in range(90)]
    m = toxicity.train(spark.createDataFrame([*rows, (91, None, 0), (92, "x", None)], "doc_id long, text string, label int"))
    df = spark.createDataFrame([(1, "An IDIOT", 3.0), (2, None, None), (3, "", None), (4, "friend " * 100000, None), (4, "friend", None)], "doc_id long, text string, score double")
    got = {x.doc_id: x for x in toxicity.score(df, m).collect()}
    assert got[1].predicted == 1 and got[2].score == got[3].score < 0.5 and got[4].predicted == 0
    one = toxicity.train(spark.createDataFrame([(1, "x", 0)], "doc_id long, text string, label int"))
    assert toxicity.score(df, one).where("predicted = 1").count() == 0 and toxicity.score(df.limit(0), m).count() == 0


def planted_votes(n=6000, seed=1):
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.3).astype(float)
    cast = lambda right: np.where(r.random(n) < right, y, 1 - y)
    poor = cast(0.6)
    return y, np.stack([cast(0.95), cast(0.85), cast(0.8), poor, poor, poor], 1) * 2 - 1


def test_label_model_finds_accuracies_without_labels():
    """Three copies of one poor voter hang on one another and do not outvote the good ones."""
    y, votes = planted_votes()
    post, model = toxicity.label_model(votes, y)
    assert ((post > 0.5) == y).mean() > 0.95 and model.accuracy[0] > 0.9 > model.accuracy[1] > model.accuracy[3]
    assert model.correlation[3, 4] > 0.8 > model.correlation[0, 1]
    assert sum(model.parents[3:] >= 3) == 2 and (model.parents[:3] == -1).all()
    wrong = 1 - y  # labels orient the classes and give their size, whatever they say of single rows
    r = np.random.default_rng(2)
    shuffled = y.copy()
    flip = r.random(len(y)) < 0.2
    shuffled[flip] = r.permutation(y[flip])
    assert ((toxicity.label_model(votes, shuffled)[0] > 0.5) == (post > 0.5)).mean() > 0.999
    assert ((toxicity.label_model(votes, wrong)[0] > 0.5) == wrong).mean() > 0.9


def test_label_model_is_expectation_maximisation():
    """Without dependence, the fit is that of EM written out row by row."""
    y, votes = planted_votes(400, 3)
    votes = votes[:, :3]
    model = toxicity.LabelModel(votes, toxicity.majority(votes), prior=0.3, rounds=15, again=99)
    post = [float(p) for p in toxicity.majority(votes)]
    for _ in range(15):
        tables = []
        for w in ([1 - p for p in post], post):
            t = []
            for j in range(3):
                c = [sum(x for x, v in zip(w, votes[:, j]) if v == s) for s in (-1, 0, 1)]
                every = [x + 0.1 for x in c]
                c = [x + e / sum(every) for x, e in zip(c, every)]
                t.append([x / sum(c) for x in c])
            tables.append(t)
        new = []
        for row in votes:
            odds = 0.3 / 0.7
            for j, v in enumerate(row):
                odds *= tables[1][j][int(v) + 1] / tables[0][j][int(v) + 1]
            new.append(odds / (1 + odds))
        post = new
    assert np.abs(np.array(post) - model.fitted).max() < 0.02


def test_label_model_decides(spark, monkeypatch):
    """Another label model gives other scores: the classifier learns from posteriors, not from labels."""
    rows = [(i, ("idiot moron clown " if i % 3 == 0 else "friend ") + ("idiot " if i % 7 == 0 else "") + "x" * (i % 5), int(i % 3 == 0)) for i in range(210)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    ask = spark.createDataFrame([(1, "idiot"), (2, "idiot moron clown"), (3, "friend")], "doc_id long, text string")
    a = {x.doc_id: x.score for x in toxicity.score(ask, toxicity.train(df)).collect()}
    monkeypatch.setattr(toxicity, "label_model", lambda votes, labels: (np.full(len(votes), 0.5), toxicity.LabelModel(votes, toxicity.majority(votes), rounds=1)))
    b = {x.doc_id: x.score for x in toxicity.score(ask, toxicity.train(df)).collect()}
    assert a[2] > 0.9 > 0.5 > a[3] and all(abs(x - 0.5) < 0.1 for x in b.values())


# 9 ---------------------------------------------------------------------------------------------------------


def brute_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    m = [False] * len(w)
    for i, x in enumerate(win):
        if win.count(x) > 1:
            m[i : i + 8] = [True] * 8
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": sum(m), "n_distinct_words": len(set(w)), "n_lines": len(lines)}


def test_statistics(spark, monkeypatch):
    r = random.Random(4)
    texts = ["", " \n ", "a b c d e f g h a b c d e f g h", "x " * 50, "é# ß*\n\né# ß*\né# ß*\u00a0|", "\u0085a\u2028b\x0bc\x1fd"]
    texts += ["".join(r.choice("ab \n#é\t") for _ in range(r.randint(0, 300))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None), (None, "a"), (1, texts[1])]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_words int")
    got = quality.with_statistics(df).collect()
    for x, (i, t) in zip(got, rows):
        assert x.doc_id == i and {k: x[k] for k in brute_stats(t)} == brute_stats(t)
    monkeypatch.setattr(quality, "PIECE", 50)
    for t in texts:
        assert {k: v[0] for k, v in quality.statistics([t.encode()]).items() if k in brute_stats(t)} == brute_stats(t)
    assert quality.with_statistics(df.limit(0)).count() == 0


def test_words_of_equal_polynomial_hash_are_not_repeats():
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    y = x.translate(str.maketrans("ab", "ba"))
    w = list("cdefghi")
    text = " ".join([*w[:4], x, *w[4:6], "j", "k", "l", "m", *w[:4], y, *w[4:6], "n"])
    got = quality.statistics([text.encode()])
    assert got["n_words"][0] == 19 and got["n_repeat_words"][0] == 0 and got["n_distinct_words"][0] == 13


def test_quality_held_out(spark):
    out = quality.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    held = out.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    x = held.agg(F.avg(F.when((F.col("quality") == 1) & ~F.col("base_failed"), F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")).first()
    assert x.good >= 0.99 and x.bad <= 0.1


def test_rules_without_labels(spark):
    df = spark.createDataFrame([(1, "a " * 30), (2, "few words"), (3, " ".join(map(str, range(40))))], "doc_id long, text string")
    stats = quality.with_statistics(df)
    rules = quality.train(stats, spark.createDataFrame([], "doc_id long, quality int"))
    assert rules == [] and {x.doc_id: x.kept for x in quality.judge(stats, rules).collect()} == {1: False, 2: False, 3: True}
