"""Quality rules, whitening and periodic runs against brute force and SQL, with odd rows."""

import hashlib
import math
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import quality_rules, runs, whitening
from fleetlake.llm.queries import QUERIES
from .test_sql import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- quality rules
def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(5))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in quality_rules.SYMBOLS for c in text),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
        "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_bullet_lines": sum(x.lstrip(" \t\n\x0b\f\r")[0] in quality_rules.BULLETS for x in lines),
        "n_ellipsis_lines": sum(x.rstrip(" \t\n\x0b\f\r").endswith(("...", "…")) for x in lines)}


def brute_broken(m, rules):
    out = []
    for r in rules:
        value, scale = (m[r.measure], 1) if r.per is None else (100 * m[r.measure], m[r.per])
        low, high = r.least is not None and value < r.least * scale, r.greatest is not None and value > r.greatest * scale
        if (low or high) and m["n_words"] >= r.over:
            out.append(r.name)
    return out


ODD = [None, "", " \t\n\x0b ", "a b c d e", "a b c d e a b c d e", "x " * 40, "## ** && one two three four five six seven eight",
       "- a\n- b\n* c\n" * 30, "wait...\nagain…\r\nso ...\n" * 30, "12 34 56 78 90 11 22 33 44 55 66 77", "w" * 300_000 + " z",
       " ".join(str(i % 977) for i in range(60_000)), "é à ö ü the über\x1cxx", "🙂 🙂🙂 & the", "..,,;; 1a -b c- " * 5]


def test_measures_and_verdicts_equal_brute_force(spark, corpus, clashing):
    texts = [r[1] for r in corpus] + ODD + ODD[:5]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the of and " * 9), (3, "same id")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).withColumns({"q": F.lit(1), "k0": F.lit(2)}).repartition(4)
    rules = quality_rules.BASE + quality_rules.RATIOS
    got = sorted((tuple(r) for r in quality_rules.judged(docs).select(
        "doc_id", *quality_rules.MEASURES, "failed", "base_failed", "kept").collect()), key=repr)
    want = []
    for doc_id, text in rows:
        m = brute_measures(text)
        broken = brute_broken(m, rules)
        want.append((doc_id, *(m[k] for k in quality_rules.MEASURES), broken, bool(brute_broken(m, quality_rules.BASE)), not broken))
    assert got == sorted(want, key=repr)
    # the table is what decides: without rules all is kept, and a rule of one's own is obeyed
    assert quality_rules.judged(docs, rules=()).where("not kept").isEmpty()
    own = (quality_rules.Rule("long", "n_words", greatest=5),)
    assert quality_rules.judged(docs, rules=own, base=()).where("kept <> (n_words <= 5) or base_failed").isEmpty()


def test_rules_are_one_projection(spark, docs):
    plan = quality_rules.judged(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Join" not in plan and "Aggregate " not in plan
    # the text is split once into words and once into lines
    assert plan.count("split(") == 2


def test_rules_of_odd_rows_match_sql(spark, tmp_path):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD)] + [(None, None, None, None, None), (1, "x y z " * 20, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    compare(spark, str(tmp_path), "op11_quality_rules")


def test_no_documents(spark, docs):
    none = docs.where("doc_id < 0")
    assert quality_rules.judged(none).isEmpty() and runs.periodic_runs(none).isEmpty()


# ---------------------------------------------------------------- whitening
def brute_whitening(vectors, components=8):
    import numpy as np

    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    cov = np.array([[sum((n * r[j] - s[j]) * (n * r[k] - s[k]) for r in x) / n**3 for k in range(d)] for j in range(d)])
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    centred = np.array([[(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    return ([sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x], centred @ vector / np.sqrt(value), value / np.trace(cov))


def test_whitening_equals_brute_force(spark, clashing, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 12))
    vectors = np.float32(rng.normal(size=(300, 12)) @ base * 0.2 + 0.3).tolist()
    vectors += [vectors[0]] * 100  # a third of the rows or more may be copies
    rows = list(enumerate(vectors)) + [(7, vectors[9]), (None, vectors[1])]
    odd = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [1.0] * 11), (904, [None] + [0.5] * 11), (905, [float("inf")] + [0.0] * 11),
           (906, [1e30] * 12)]
    table = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")).repartition(5)
    monkeypatch.setattr(whitening, "ROWS", 64)
    got = whitening.whitened(table, "vec_id", "embedding").collect()
    deviation, white, explained = brute_whitening([v for _, v in rows])
    assert len(got) == 8 * len(rows) and {r["n"] for r in got} == {len(rows)}
    assert {r["component"] for r in got} == set(range(1, 9)) and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    for c in range(8):
        own = sorted((r["deviation"], r["id"] is None, r["id"] or 0, r["whitened"]) for r in got if r["component"] == c + 1)
        want = sorted((deviation[i], rows[i][0] is None, rows[i][0] or 0, white[i, c]) for i in range(len(rows)))
        assert [t[:3] for t in own] == [t[:3] for t in want]
        a, b = np.array([t[3] for t in own]), np.array([t[3] for t in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        share = {r["explained"] for r in got if r["component"] == c + 1}
        assert len(share) == 1 and abs(share.pop() / explained[c] - 1) < 1e-9


@pytest.mark.parametrize("wide", [0, 1, 9, 24, 25, 31, 45, 52])
def test_scatter_is_exact(wide):
    import numpy as np

    rng = np.random.default_rng(wide)
    x = rng.integers(-(1 << wide), (1 << wide), size=(137, 5), endpoint=True)
    got, want = whitening.scatter(x), x.T.astype(object) @ x.astype(object)
    assert (got == want).all()


def test_vectors_without_spread(spark):
    schema = "vec_id long, embedding array<double>"
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.25])], schema), "vec_id", "embedding").collect()
    assert [(r["id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == \
        [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    line = spark.createDataFrame([(i, [0.01 * i, 0.02 * i, 0.0]) for i in range(40)], schema)
    got = whitening.whitened(line, "vec_id", "embedding").collect()
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in got) and got[0]["identity_error"] < 1e-6
    far = whitening.whitened(spark.createDataFrame([(1, [4e12]), (2, [-4e12])], schema), "vec_id", "embedding").collect()
    assert all(r["deviation"] is None and abs(abs(r["whitened"]) - 1) < 1e-12 for r in far)
    for none in ([], [(1, None)], [(1, [])], [(1, [float("nan")])]):
        assert whitening.whitened(spark.createDataFrame(none, schema), "vec_id", "embedding").isEmpty()


# ---------------------------------------------------------------- periodic runs
def brute_runs(words, least=12):
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            own = words[i:j + q]
            if len(own) >= max(least, 2 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    dropped = {k for s, n, q in out for k in range(s + q, s + n)}
    return len(words), sorted(out, key=lambda r: (r[0], r[2])), " ".join(w for i, w in enumerate(words) if i not in dropped).encode()


def odd_words(rng):
    kinds, n = rng.choice([1, 2, 2, 3, 6, 40]), rng.randrange(0, 120)
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randrange(1, n + 1)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(runs, "JUMPS", rng.choice([0, 1, 24]))
    monkeypatch.setattr(runs, "STEPS", rng.choice([0, 1, 16]))
    monkeypatch.setattr(runs, "CHECKS", rng.choice([1, 50, 1 << 21]))
    for _ in range(60):
        texts, least = [odd_words(rng) for _ in range(rng.randrange(1, 9))], rng.choice([1, 2, 12])
        assert runs.of_texts([" ".join(t).encode() for t in texts], least) == [brute_runs(t, least) for t in texts]


def test_runs_of_special_words():
    fib, before = list("ab"), list("a")
    while len(fib) < 300:
        fib, before = fib + before, fib
    thue = ["ab"[bin(i).count("1") % 2] for i in range(256)]
    for words in (fib[:300], thue, list("a" * 200), list("ab" * 90) + list("abc" * 50), list("aab" * 40 + "aabaab" * 20)):
        assert runs.of_texts([" ".join(words).encode()], 2) == [brute_runs(words, 2)]
    # one word 200,000 times, and a passage of 60,000 words three times over
    assert runs.of_texts([b"w " * 200_000], 12)[0][1:] == ([(0, 200_000, 1)], b"w")
    rng = random.Random(2)
    long = " ".join(str(rng.randrange(500)) for _ in range(60_000))
    assert runs.of_texts([" ".join([long] * 3).encode()], 12)[0][1] == [(0, 180_000, 60_000)]


def test_rows_with_runs(spark, clashing):
    rng = random.Random(11)
    texts = [" ".join(odd_words(rng)) for _ in range(60)] + [None, "", " \n", "é è " * 20, "the end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x y " * 10), (4, "again"), (4, "again")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("k0", F.lit(1)).repartition(3)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                 for r in runs.periodic_runs(docs).collect())
    want = []
    for doc_id, text in rows:
        n, found, left = brute_runs(WORD.findall(text or ""))
        want.append((doc_id is None, doc_id or 0, n, found, left.decode()))
    assert got == sorted(want)


def test_query_of_runs_equals_brute_force(spark, corpus, tmp_path):
    rows = [(r[0], " ".join(WORD.findall(r[1] or "")[:400]) if r[1] else r[1]) for r in corpus] + [(None, "a b " * 20)]
    rows += [(i, " ".join(odd_words(random.Random(i)))) for i in range(1000, 1060)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sha, want, planted = lambda t: hashlib.sha256(t).hexdigest(), {}, 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)], planted + 1
        _, found, left = brute_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want[doc_id] = (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                        sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(left))
    names = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert got == want and planted > 5


def test_query_of_whitening(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver tables")
    got = QUERIES["op12_whitening"](spark, sf).collect()
    vectors = [r["embedding"] for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    deviation, white, explained = brute_whitening(vectors)
    assert got[0]["identity_error"] <= 1e-4 and [r["deviation"] for r in sorted(got, key=lambda r: (r["vec_id"], r["component"]))][::8] == deviation
    for r in got:
        assert abs(abs(r["whitened"]) - abs(white[r["vec_id"], r["component"] - 1])) < 1e-6
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
