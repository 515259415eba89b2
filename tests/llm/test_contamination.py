import random

from orderflow.llm import contamination as c

ITEMS = "item_id long, text string"


def brute(docs, items, k=5, t=0.8):
    """An item of fewer than k words is one shingle of its own length."""
    out = []
    for d, text in docs:
        by_length = {n: c.shingles((text or "").encode(), n) for n in range(1, k + 1)}
        for i, item in items:
            of = c.shingles((item or "").encode(), k)
            own = by_length[min(k, len((item or "").split()) or 1)]
            if of and 10 * len(own & of) >= 8 * len(of):
                out.append((d, i, len(own & of), len(of), len(own & of) / len(of)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(rng.randint(1, 60)))) for i in range(30)] + [(3, "W1 w2"), (90, None), (91, ""), (None, "a b c d e f")]
    docs = []
    for i in range(80):
        text = say(rng.choice([0, 3, 30, 300, 3000]))
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").split()
            if own and rng.random() < 0.5:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = own
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    return docs + [(None, "a b c d e f g"), (200, None), (5, docs[5][1]), (201, "w1 W2")], items


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_brute_force_in_one_block_and_in_many(spark, docs):
    rows, items = corpus(1)
    frame = spark.createDataFrame(items, ITEMS)
    own = docs(rows, n_shared="clash")
    want = brute(rows, items)
    assert len(want) > 40
    assert found(c.matches(own, frame)) == want
    assert found(c.matches(own, frame, block_bytes=500)) == want


def test_short_items_inside_documents(spark, docs):
    rows = [(1, "aa bb cc dd the Answer is\nforty two ee ff gg"), (2, "forty three two"), (3, "two"), (4, "answer is forty two")]
    items = [(10, "the answer is forty two"), (11, "answer is forty two"), (12, "forty two"), (13, "two"), (13, "two"), (14, "forty  TWO ee")]
    got = found(c.matches(docs(rows), spark.createDataFrame(items, ITEMS)))
    assert got == brute(rows, items)
    assert sorted(i for d, i, *_ in got if d == 1) == [10, 11, 12, 13, 13, 14] and sorted(i for d, i, *_ in got if d == 4) == [11, 12, 13, 13]


def test_repeated_items_are_one_in_a_block(spark):
    items = spark.createDataFrame([(1, "a b c d e f")] * 500 + [(2, "g h i j k l")], ITEMS)
    blocks = list(c._blocks(items, 1000))
    assert len(blocks) == 1 and sorted(zip(blocks[0][0], blocks[0][2])) == [(1, 500), (2, 1)]


def test_clean_rows_stay_whole(spark, docs):
    rows, items = corpus(2)
    frame = spark.createDataFrame(items, ITEMS)
    bad = {(d, t) for d, t in rows if brute([(d, t)], items)}
    kept = c.decontaminated(docs(rows, item_id="clash"), frame, block_bytes=500)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in rows if x not in bad), key=str)
    assert kept.columns == docs(rows, item_id="clash").columns


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    assert found(c.matches(docs([(1, "a b c d e f")]), none)) == []
    assert found(c.matches(docs([]), spark.createDataFrame([(1, "a b c d e f")], ITEMS))) == []
    assert c.decontaminated(docs([(1, "a")]), none).count() == 1


def test_bins_grow_for_short_items():
    extra = [c.extra_bits(n, 0.8, 1e-9) for n in (1, 2, 5, 10, 20, 50, 100)]
    assert extra == sorted(extra, reverse=True) and extra[0] >= 30 and extra[-1] <= 1
