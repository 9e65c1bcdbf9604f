"""Near copies of texts of every length, by brute force: none of the pairs at the limit is lost."""

import random

import numpy as np

from soukwise.llm import neardup
from tests.llm.test_operators import brute_components


def _kept(spark, docs):
    frame = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    return {r["doc_id"] for r in neardup.without_near_copies(frame.repartition(5)).collect()}


def _expected(docs):
    sets = [set(neardup.shingle_set(" ".join(d)).tolist()) for d in docs]
    held = {}
    for k, s in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in held.values() for a in ks for b in ks if a < b}
    links = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return set(brute_components(range(len(docs)), links).values())


def test_long_texts_at_the_limit(spark):
    rnd = random.Random(3)
    words, docs = [f"w{k}" for k in range(20000)], []
    for _ in range(400):
        base = [rnd.choice(words) for _ in range(rnd.randrange(55, 400))]
        # Words put before and after, so that the sets are 0.79 to 0.82 alike.
        more = round((len(base) - 4) * rnd.uniform(0.22, 0.265))
        front = rnd.randrange(more + 1)
        docs += [base, [rnd.choice(words) for _ in range(front)] + base + [rnd.choice(words) for _ in range(more - front)]]
    expected = _expected(docs)
    assert 400 < len(expected) < 800
    assert _kept(spark, docs) == expected


def test_many_copies_around_one_original_and_a_common_passage(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(20000)]
    base = [rnd.choice(words) for _ in range(120)]
    docs = [base]
    for _ in range(200):
        copy = list(base)
        at = rnd.randrange(5, 105)
        copy[at:at + 6] = [rnd.choice(words) for _ in range(6)]
        docs.append(copy)
    passage = [rnd.choice(words) for _ in range(60)]
    docs += [[rnd.choice(words) for _ in range(rnd.randrange(20, 200))] + passage for _ in range(200)]
    rnd.shuffle(docs)
    assert _kept(spark, docs) == _expected(docs)


def test_pairs_are_made_between_components_only(spark):
    rows = [(c, n, 100, 0, 0 if n < 50 else n) for c in (1, 2) for n in range(53)] + [(3, n, 100, 0, 7) for n in range(40)]
    cells = spark.createDataFrame(rows, "cell bigint, node bigint, n int, place int, label bigint")
    pairs = neardup._across(cells).collect()
    found = {tuple(sorted(p)) for p in pairs}
    assert found == {(a, b) for a in range(53) for b in range(max(a + 1, 50), 53)}
    assert len(pairs) == 2 * len(found)


def test_counts_cover_all_shingles(spark):
    texts = ["a b c d e f", "a b c d e f", "", "one two", "a b c d e"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    counts = neardup.shingle_counts(frame)
    assert counts.sum() == sum(len(neardup.shingle_set(t)) for t in texts)
    at = neardup._counters(neardup.shingle_set("a b c d e"))
    assert counts[at] >= 3 and counts.dtype == np.int64
