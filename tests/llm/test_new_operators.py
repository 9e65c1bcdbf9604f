"""Quality, hard negatives and alignment against brute force and held-out accuracy on small tables."""

import hashlib
import math
import random
import sys
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from soukwise.llm import alignment, negatives, quality
from soukwise.llm.queries import QUERIES
from soukwise.llm.tables import read
from tests.llm import odd

WORDS = ["the", "cat,", "Sat", "on", "mat.", "dog", "ran", "far", "éé", "x_1", "--"]


def test_context_sums_are_those_of_a_plain_count(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randrange(0, 40))) for _ in range(60)] + [None, "", "one"]
    found = {r["row"]: r for r in quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)).collect()}
    places, signs = quality.index_vectors()
    times, sums = Counter(), {}
    for text in texts:
        rows = [zlib.crc32(w.encode()) % quality.ROWS for w in quality.TOKENS.findall((text or "").lower())]
        for i, row in enumerate(rows):
            times[row] += 1
            own = sums.setdefault(row, [0] * quality.WIDTH)
            for j in range(max(0, i - quality.WINDOW), min(len(rows), i + quality.WINDOW + 1)):
                for place, sign in zip(places[rows[j]], signs[rows[j]]):
                    own[place] += int(sign) * (i != j)
    assert {r: f["n"] for r, f in found.items()} == dict(times)
    assert all([found[r][f"c{i}"] for i in range(quality.WIDTH)] == sums[r] for r in times)


def test_description_and_network_are_those_of_plain_loops():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(quality.ROWS, quality.WIDTH)).astype(np.float32)
    rows = rng.integers(0, quality.ROWS, quality.CHUNK + 77)
    mean = sum(vectors[r].astype(float) for r in rows) / len(rows)
    pairs = sum(vectors[a].astype(float) * vectors[b] for a, b in zip(rows, rows[1:])) / (len(rows) - 1)
    assert np.allclose(quality.pooled(rows, vectors), np.concatenate([mean, pairs]), atol=1e-5)
    x = rng.normal(size=(200, 2 * quality.WIDTH))
    model = quality.fit(x, (x[:, 0] > 0).astype(int), vectors, 0.8)
    one = [(v - m) / s for v, m, s in zip(x[0], model.middle, model.scale)]
    hidden = [math.tanh(sum(o * w for o, w in zip(one, model.first[:, h])) + model.first_bias[h]) for h in range(quality.HIDDEN)]
    odds = (sum(h * w for h, w in zip(hidden, model.second)) + model.second_bias) / model.temperature + math.log(0.8 / 0.2)
    assert model.probability(x[0]) == pytest.approx(1 / (1 + math.exp(-odds)))


def test_temperature_is_the_likeliest():
    rng = np.random.default_rng(5)
    logits = rng.normal(size=4000) * 2
    target = (rng.random(4000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert quality.temperature(3 * logits, target) == pytest.approx(3, rel=0.15)


def test_quality_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in QUERIES["op11_quality"](spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in read(spark, folder, "labels", "doc_id", "quality").collect()}
    assert len(found) == read(spark, folder, "documents", "doc_id").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    held = [(found[d]["predicted"], q) for d, q in labels.items() if d in found and found[d]["held_out"]]
    assert sum(p == q for p, q in held) / len(held) >= 0.9


def test_quality_labels_of_held_out_rows_are_not_read(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "labels", "doc_id", "quality")
    turned = labels.selectExpr("doc_id", "if(crc32(binary(string(doc_id))) % 3 = 1, 1 - quality, quality) as quality")
    a, b = ({r["id"]: r["score"] for r in quality.score(docs, quality.learn(docs, x)).collect()} for x in (labels, turned))
    assert a == b


def brute_negatives(rows):
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, kind, vector in {(i, k, tuple(v)) for i, k, v in moved if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, k) for i, k, v in moved if i != anchor)
        for score, positive, _ in [s for s in scored if s[2] == kind][:5]:
            fits = [s for s in scored if s[2] != kind and 50 * -score <= 100 * -s[0] <= 95 * -score][:3]
            out += [(anchor, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, q string, anchor string"


def mined(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "x", "x", "x") for i, label, v in rows], SCHEMA)
    return sorted(map(tuple, negatives.hard_negatives(frame.repartition(3)).collect()))


@pytest.mark.parametrize("width", [3, 8, 21])
def test_hard_negatives_are_those_of_brute_force(spark, width):
    rnd = random.Random(width)
    rows = [(i, rnd.randrange(3), [rnd.uniform(-2, 2) for _ in range(width)]) for i in range(-100, 400)]
    # Ties: coarse components, and one very common vector.
    rows += [(i, rnd.randrange(2), [float(rnd.randrange(-1, 2)) for _ in range(width)]) for i in range(400, 700)]
    rows += [(i, i % 3, [1.0] * width) for i in range(700, 1000)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (50, 1, [1.0]), (1, 1, [0.9, 0.5]), (2, 2, [0.7, 0.4]), (3, 2, [0.7, 0.4]), (4, None, [1.0, 1.0]),
            (5, 2, None), (6, 2, [None, 1.0]), (8, 2, [float("nan"), 1.0]), (9, 2, [float("inf"), 1.0]), (None, 2, [1.0, 1.0]),
            (100, 2, []), (7, 0, [0.8, 0.8]), (10, 2, [0.8, 0.4, 9.0])]
    assert mined(spark, rows) == brute_negatives(rows) != []
    assert mined(spark, []) == []
    repeated = rows + [(0, 1, [1.0, 0.5])] * 2 + [(2, 2, [0.7, 0.4])]
    assert mined(spark, repeated) == brute_negatives(repeated)
    # Sums beyond a long wrap, single components end at its range.
    assert all(len(r) == 6 for r in mined(spark, [(0, 1, [1e30]), (1, 1, [-1e30]), (2, 2, [3e38]), (3, 1, [1.0])]))


def test_scores_by_lookup_are_inner_products():
    rng = np.random.default_rng(1)
    for reach in (2, 300, 1 << 33):
        a, b = rng.integers(-reach, reach, (5, 19)), rng.integers(-reach, reach, (40, 19))
        with np.errstate(over="ignore"):
            assert (negatives.inner_products(negatives.planes_of(b), negatives.subset_sums(a)) == b @ a.T).all()


def brute_alignment(texts):
    """What the libraries and loops over tokens give, for {id: text}."""
    a_lib, b_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_lib.encode_special_tokens = True
    level = alignment.byte_of_character()

    def ranges(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    out, links, holders = {}, {}, Counter()
    for key, text in texts.items():
        out[key], links[key] = (0, 0, 0, 0, ""), []
        if not text:
            continue
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        a_bytes = [bytes(level[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        a_at, b_at, groups, u, v = ranges(a_bytes), ranges(b_bytes), [], 0, 0
        for end in sorted({e for _, e in a_at} & {e for _, e in b_at}):
            first = u, v
            while u < len(a) and a_at[u][1] <= end:
                u += 1
            while v < len(b) and b_at[v][1] <= end:
                v += 1
            groups.append(",".join(map(str, a[first[0]:u])) + "|" + ",".join(map(str, b[first[1]:v])))
            links[key] += [(a[x], b[y]) for x in range(first[0], u) for y in range(first[1], v)
                           if a_at[x][0] < b_at[y][1] and b_at[y][0] < a_at[x][1]]
        holders.update(set(links[key]))
        out[key] = len(a), len(b), len(groups), len(links[key]), hashlib.sha256(";".join(groups).encode()).hexdigest()
    best = {}
    for (a, _), n in holders.items():
        best[a] = max(n, best.get(a, 0))
    return {k: (*out[k][:4], sum(holders[p] == best[p[0]] for p in links[k]), sum(holders[p] for p in links[k]), out[k][4]) for k in texts}


def test_alignment_query(spark, data):
    texts = {r["doc_id"]: r["text"] for r in read(spark, data, "documents", "doc_id", "text").collect()}
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op13_alignment"](spark, data).collect()}
    assert found == brute_alignment(texts)


def test_alignment_of_random_texts(spark):
    rnd = random.Random(8)
    letters = [*"abcdeé ß \n\t  .,'s1234", "\U0001F600", "日", "▁", "́", "<s>", "<|endoftext|>", "<0x41>", "\u0000", "‍"]
    texts = {i: "".join(rnd.choices(letters, k=rnd.randrange(0, 80))) for i in range(1500)} | {
        1500: None, 1501: "x" * 30_000, 1502: "ab " * 9000, 1503: " " * 500, 1504: "<unk>"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    assert {r[0]: tuple(r)[1:] for r in alignment.alignments(frame, odd.tokenizers()).collect()} == brute_alignment(texts)


def test_chunks_of_any_size_give_the_same(spark, data, monkeypatch):
    docs = read(spark, data, "documents", "doc_id", "text")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    loaded = odd.tokenizers().load()
    whole = alignment.aligned(loaded.encode([t for _, t in rows]), loaded)
    monkeypatch.setattr(alignment, "TOGETHER", 3)
    again = alignment.aligned(loaded.encode([t for _, t in rows]), loaded)
    assert whole.texts == again.texts and (whole.links == again.links).all() and (whole.b == again.b).all()


def test_the_byte_level_ids_are_those_of_the_library():
    lib, loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), odd.tokenizers().load()
    lib.encode_special_tokens = True
    points = [chr(p) for p in range(sys.maxunicode + 1) if not 0xD800 <= p < 0xE000 and unicodedata.category(chr(p)) != "Cn"]
    for at in range(0, len(points), 5000):
        text = " ".join(f"a{c}1{c} {c}" for c in points[at:at + 5000] if c not in "")
        assert lib.encode(" " + text, add_special_tokens=False).ids == loaded.byte_level.encode_ordinary(" " + text)


def test_crossings_divide_the_merge():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(1, 40))) for _ in range(2))
        order = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        d = np.arange(len(order) + 1)
        assert alignment.crossings(a, b, d).tolist() == [sum(side == 0 for _, side in order[:k]) for k in d]
