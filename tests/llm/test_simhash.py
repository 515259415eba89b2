import random

import numpy as np

from orderflow.llm import simhash
from orderflow.llm.components import components


def brute(rows, bits=2):
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, fps[i], least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def found(frame):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in frame.collect()), key=str)


def texts(seed, n=80):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "é", "gamma\t", "d", "E2", "of", "THE"]
    base = [[rng.choice(words) for _ in range(rng.randint(0, 40))] for _ in range(12)]
    rows = []
    for i in range(n):
        own = list(rng.choice(base))
        if own and rng.random() < 0.6:
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    return rows + [(None, ""), (None, rows[0][1]), (500, None), (501, " \n\t"), (502, "one two"), (3, rows[3][1]), (3, rows[5][1])]


def test_equals_brute_force(docs):
    rows = texts(1)
    frame = docs(rows, fp="clash", component_id="clash")
    assert found(simhash.near_duplicates(frame)) == brute(rows)


def test_every_close_pair_meets_at_the_home_anchor():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        assert simhash.anchors(a, 2)[0] in simhash.anchors(b, 2)
        assert simhash.anchors(b, 2)[0] in simhash.anchors(a, 2)


def test_code_is_perfect():
    # every syndrome has exactly one pattern within the covering radius
    assert all(len(x[0]) == 1 for x in simhash._offsets(2))


def test_fingerprint_by_definition():
    from xxhash import xxh64_intdigest

    def plain(text):
        w = text.split()
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in ("", "a", "a b", "a b c", "a b c a b c a", "x  y\tz\nw é"):
        assert simhash.fingerprint(text.encode()) == plain(text)
    long = " ".join(random.Random(0).choice("abcdef") for _ in range(70000))
    assert simhash.fingerprint(long.encode()) == plain(long)


def test_empty_table(docs):
    assert found(simhash.near_duplicates(docs([]))) == []


def test_one_first_per_component(docs):
    rows = texts(4)[:-2]  # without ids that two texts share
    near = simhash.near_duplicates(docs(rows)).collect()
    groups = {}
    for r in near:
        groups.setdefault(r.component_id, set()).update([(r.doc_id, r.text_hash)] if r.first else [])
    assert all(len(x) == 1 for c, x in groups.items() if c is not None)


def test_components_of_paths_stars_and_cycles(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (7, 7)]
    edges += [tuple(map(int, rng.integers(1000, 1100, 2))) for _ in range(70)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
