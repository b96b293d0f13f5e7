"""Operator 7: fingerprints, the index and components against brute force."""

import random

import numpy as np
import xxhash

from anchorline.llm.simhash import GrayIndex, components, fingerprint, gray_rank, links, near_duplicates

U = np.uint64


def brute_fp(t):
    w = t.encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_comp(rows):
    fps = [brute_fp(t or "") for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return sorted((rows[i][0], f"{fps[i]:016x}", min(groups[root(i)])) for i in range(len(rows)))


def test_gray_rank():
    n = np.arange(1 << 12, dtype=U)
    assert (gray_rank(n ^ (n >> U(1))) == n).all()


def test_index_matches_brute_force():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 30, dtype=np.uint64)
    codes = np.unique(np.concatenate([base[r.integers(0, 30, 2000)] ^ sum(U(1) << r.integers(0, 30, 2000).astype(U) for _ in range(3)), r.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    codes = codes[np.argsort(gray_rank(codes))]
    comp = GrayIndex(codes).components(3, 0)
    d = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    want = np.arange(len(codes))
    while True:
        new = np.where(d, want[None, :], len(codes)).min(1)
        if (new == want).all():
            break
        want = new
    assert (comp == want).all()


def test_links_and_components_lose_none(spark):
    r = random.Random(3)
    fps = set()
    for _ in range(40):
        f = r.getrandbits(64)
        for _ in range(20):
            fps.add(f)
            for _ in range(r.randint(0, 4)):
                f ^= 1 << r.randrange(64)
    fps = sorted(fps)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {a: b for a, b in components(links(df)).collect()}
    comp = {x: x for x in fps}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                comp[root(x)] = root(y)
    ours = {x: got.get(signed(x), signed(x)) for x in fps}
    pairs = {}
    for x in fps:
        pairs.setdefault(root(x), set()).add(ours[x])
    assert all(len(v) == 1 for v in pairs.values()) and len(pairs) == len(set(ours.values()))


def test_documents(spark):
    r = random.Random(5)
    base = [" ".join(r.choice("the Of and a b c d é ß".split()) + str(r.randint(0, 99)) for _ in range(r.randint(3, 400))) for _ in range(25)]
    rows = [(1000, ""), (3, None), (4, " \n"), (9, "One"), (10, "one  TWO"), (11, "one two"), (12, "x " * 5000)]
    for i in range(120):
        t = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 3])):
            t[r.randrange(len(t))] = "zz"
        rows.append((20 + (i * 7) % 120, r.choice([" ", "\t", "\n "]).join(t)))
    rows += [rows[-1]]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    assert sorted(map(tuple, near_duplicates(df).collect())) == brute_comp(rows)
    assert near_duplicates(df.limit(0)).count() == 0
    assert fingerprint(b"a b c d") == brute_fp("A B c\nd")
