import random
import re
from math import ceil

import numpy as np

from fleetlake.llm.decontaminate import MASKS, contaminated
from fleetlake.llm.language_id import UNKNOWN, calibrate, fit, ftrl, grams, predict, softmax
from fleetlake.llm.prefix_forest import Forest, neighbours

from .conftest import WORDS, prose


def test_masks_hit_every_window_with_two_substitutions():
    from itertools import combinations

    for bad in combinations(range(13), 2):
        assert any(all(o + x not in bad for x in m) for m in MASKS for o in range(13 - m[-1]))


def tokens(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def brute_matches(docs, items, window=13):
    found = {}
    for d, text in docs:
        w = tokens(text or "")
        for i, item in items:
            b = tokens(item or "")
            size = min(window, len(b))
            if not b:
                continue
            need = size if size < 7 else ceil(0.8 * size)
            for start in range(-len(b), len(w)):
                same = [0 <= start + k < len(w) and w[start + k] == t for k, t in enumerate(b)]
                best = max(sum(same[o:o + size]) for o in range(len(b) - size + 1))
                if best >= need:
                    found[d, i] = max(found.get((d, i), (0, 0)), (best, sum(same)))
    return found


def test_contaminated_equals_brute_force(spark, clashing):
    rng = random.Random(5)
    items = [(k, prose(rng, "en", rng.randrange(15, 40)) + ".") for k in range(8)]
    items += [(8, "too short to tell"), (9, None), (10, ""), (11, "one two three four five six seven eight nine"), (None, "x y z")]
    docs = []
    for k in range(40):
        body = prose(rng, "en", 60).split()
        if k % 2:
            leak = items[k % 8][1].upper().replace(" ", "\n" if k % 3 else ", ").split() if k % 4 == 1 else items[k % 8][1].split()
            for _ in range(k % 5):
                leak[rng.randrange(len(leak))] = "changed"
            if k % 7 == 0:
                leak = leak[:14]
            at = rng.choice([0, 30, 60])
            body[at:at] = leak
        docs.append((k, " ".join(body)))
    docs += [(100, None), (101, ""), (102, "one two three four five six seven eight nine"),
             (103, "zero. one two 3 four five six seven eight nine ten"), (104, items[2][1] + " " + items[2][1]), (None, items[1][1])]
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(4)
    test = clashing(spark.createDataFrame(items, "item_id long, text string"))
    want = brute_matches([d for d in docs if d[0] is not None], [i for i in items if i[0] is not None])
    for rows in (2_000_000, 0):  # broadcast seeds, and the shuffled way beyond the bound
        got = {(r["doc_id"], r["item_id"]): (r["best_window"], r["n_equal"]) for r in
               contaminated(frame, test, broadcast_rows=rows).collect()}
        # at most two substitutions in 13 tokens, as many of a shorter item's as leave four fifths, none of one under seven
        assert set(got) == set(want)
        assert all(got[k][0] == want[k][0] for k in got)
    assert len(want) > 15
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert contaminated(empty, test).count() == 0
    assert contaminated(frame, test.limit(0)).count() == 0


def test_short_items_equal_brute_force(spark):
    """Items of 1 to 13 tokens with every pattern of substitutions, whole and cut by the document's ends."""
    from itertools import combinations

    items = [(n, " ".join(f"q{n}x{k}" for k in range(n))) for n in range(1, 14)]
    docs = []
    for n, item in items:
        w = item.split()
        for r in range(n - ceil(0.8 * n) + 2):
            for bad in combinations(range(n), r):
                body = ["other" if k in bad else t for k, t in enumerate(w)]
                docs.append((len(docs), " ".join(["before", *body, "after"])))
        docs += [(len(docs) + k, " ".join(w[lo:n - hi])) for k, (lo, hi) in enumerate([(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2)])]
    docs.append((len(docs), " ".join([items[0][1]] * 50 + [items[2][1]] * 2)))
    # brute_matches leaves items of under 7 tokens out: these count where all their tokens follow each other
    want = {k: v[0] for k, v in brute_matches(docs, items).items()}
    want |= {(d, i): i for d, text in docs for i, item in items if i < 7 and f" {item} " in f" {text} "}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    test = spark.createDataFrame(items, "item_id long, text string")
    for rows in (2_000_000, 0):
        got = {(r["doc_id"], r["item_id"]): r["best_window"] for r in contaminated(frame, test, broadcast_rows=rows).collect()}
        assert got == want
    assert {i for _, i in want} == set(range(1, 14))


def test_native_plan(spark, docs):
    from pyspark.sql import functions as F

    items = docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id < 5")
    plan = contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_language_id_on_held_out_rows(spark, docs, corpus, clashing):
    rng = random.Random(9)
    rows = [(k, prose(rng, lang, rng.randrange(5, 60)), lang) for k, lang in enumerate(list(WORDS) * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = fit(frame.where("doc_id % 4 <> 2"), per_class=40)
    assert model.classes == ["de", "en", "fr"] and 0 < model.info["nonzero"] < 0.7
    got = {r["doc_id"]: r for r in predict(frame, model).collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert np.mean([got[d]["lang_pred"] == lang for d, _, lang in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (4, "\n"), (5, "the " * 300_000), (5, "the " * 300_000), (6, "漢")]
    kept = {}
    for r in predict(clashing(spark.createDataFrame(odd, "doc_id long, text string")), model, keep=("place", "key")).collect():
        kept.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"], r["place"]))
    assert [kept[k][0][0] for k in (1, 2, 3, 4)] == [UNKNOWN] * 4 and kept[1][0][1] == 0
    assert kept[5][0][0] == "en" and kept[5][0] == kept[5][1] and kept[6][0][0] in model.classes


def test_language_id_without_enough_classes(spark):
    rows = spark.createDataFrame([(1, "abc", "en"), (2, None, "en"), (3, "x", None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in predict(rows, fit(rows)).collect()} == {"en", UNKNOWN}
    none = rows.limit(0)
    assert {r["lang_pred"] for r in predict(rows, fit(none)).collect()} == {UNKNOWN}
    assert predict(none, fit(none)).count() == 0


def test_ftrl_l1_keeps_useless_columns_at_zero():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(400):
        c = int(rng.integers(2))
        noise = rng.choice(np.arange(2, 50), 3, replace=False)
        rows.append((np.array([c, *noise]), np.array([1.0, .3, .3, .3]), c))
    w, _ = ftrl(rows, 50, 2, 0.5, 1.0, 1.0, 0.01, 3)
    assert (w[:2] != 0).any() and (w[2:] == 0).mean() > 0.5
    assert w[0, 0] > 0 > w[0, 1]


def test_calibration_lowers_the_log_loss():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(2000, 3))
    labels = np.array([rng.choice(3, p=softmax(row)) for row in z])
    assert abs(calibrate(z * 4, labels) - 4) < 0.6


def test_grams_do_not_depend_on_the_cut():
    columns, counts = grams("ab" * 10, 14, 3)
    assert counts.sum() == 22 + 21 + 20 and len(columns) <= 7 + 6
    assert len(grams("", 14, 3)[0]) == len(grams("1 2", 14, 3)[0]) == 0


def test_forest_finds_longest_prefixes_first():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 16))
    forest = Forest(x, 8, 16)
    for i, found in enumerate(forest.search(x[:20], 1)):
        assert i in found  # a row shares the whole string with itself
    assert all(len(f) == 500 for f in forest.search(x[:3], 10_000))
    sizes = [np.mean([len(f) for f in forest.search(x[:20], n)]) for n in (1, 50, 200)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_neighbours_recall_and_order(spark, clashing):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[700:1200] = x[700]  # a third of all rows repeat one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1500, None), (1550, [0.0] * 24), (1600, [None] + [1.0] * 23), (1650, [float("nan")] * 24), (1700, [float("inf")] * 24),
             (1750, [1.0, 2.0]), (None, [1.0] * 24), (50, x[50].tolist())]
    frame = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(4)
    got = {}
    for r in neighbours(frame, frame["vec_id"] % 50 == 0, k=5, shard_rows=400).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(float)
    norm = np.sqrt((y * y).sum(axis=1))
    hits = 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        score = (y * y[q]).sum(axis=1) / (norm * norm[q])
        assert all(abs(score[i] - s) < 1e-12 for _, i, s in found) and q not in [i for _, i, _ in found]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        score[q] = -9
        hits += len({i for _, i, _ in found} & set(np.lexsort((np.arange(1500), -score))[:5]))
    assert hits / (5 * len(got)) >= 0.9
    assert [i for _, i, _ in got[800]] == [700, 701, 702, 703, 704]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in neighbours(few, few["vec_id"] % 50 == 0).collect()] == [(0, 1)]
    assert neighbours(few.limit(0), few["vec_id"] % 50 == 0).count() == 0
