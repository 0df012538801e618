from hashlib import sha256

from xxhash import xxh64_intdigest

from fleetlake.llm.components import components
from fleetlake.llm.simhash import BKTree, near_components, near_links
from fleetlake.llm.substring import cleaned, remove_repeats


def brute_repeats(rows, length):
    """{doc_id: (n_words, n_removed, sha, kept words)} by the rule itself."""
    words = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d in sorted(words):
        for p in range(len(words[d]) - length + 1):
            first.setdefault(tuple(words[d][p:p + length]), d)
    out = {}
    for d, w in words.items():
        keep = [True] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < d:
                keep[p:p + length] = [False] * length
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out[d] = (len(w), len(w) - len(kept), sha256(b" ".join(kept)).hexdigest(), kept)
    return out


def brute_longest(rows, length):
    words = {d: (t or "").split() for d, t in rows}
    out, size = {}, length
    while True:
        seen = {}
        for d, w in words.items():
            for p in range(len(w) - size + 1):
                seen.setdefault(tuple(w[p:p + size]), set()).add(d)
        hit = set().union(*[s for s in seen.values() if len(s) > 1] or [set()])
        if not hit:
            return out
        out.update(dict.fromkeys(hit, size))
        size *= 2


def test_repeats_equal_brute_force(docs, corpus, clashing):
    want = brute_repeats([(r[0], r[1]) for r in corpus], 13)
    got = {r["doc_id"]: r for r in remove_repeats(clashing(docs)).collect()}
    assert {d: tuple(r[c] for c in ("n_words", "n_removed", "kept_sha256")) for d, r in got.items()} == {
        d: w[:3] for d, w in want.items()}
    assert any(w[1] for w in want.values())
    # doubled lengths: never more than the truth, and exact where a passage is long enough for the winnowing
    longest = brute_longest([(r[0], r[1]) for r in corpus], 13)
    for d, r in got.items():
        assert r["longest_repeat"] <= longest.get(d, 0)
        assert r["longest_repeat"] * 2 >= longest.get(d, 0) - 32


def test_longest_repeat_is_exact(spark, docs, corpus):
    """Passages hardly longer than a doubled length, and documents that only lend their passage, count too."""
    import random

    rng = random.Random(12)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    rows = [(r[0], r[1]) for r in corpus]
    for k, n in enumerate([12, 13, 14, 25, 26, 27, 30, 40, 51, 52, 53, 60] * 4):
        passage = fresh(n)
        for d in (0, 1):
            rows.append((10_000 + 2 * k + d, " ".join(fresh(rng.randrange(20)) + passage + fresh(rng.randrange(20)))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    longest = brute_longest(rows, 13)
    assert {r["doc_id"]: r["longest_repeat"] for r in remove_repeats(frame).collect()} == {
        d: longest.get(d, 0) for d, _ in rows}


def test_pipeline_stage_removes_what_the_doubled_level_finds(docs, monkeypatch):
    from fleetlake.llm import substring

    levels = []
    for name in ("_first_level", "_next_level"):
        def spy(frame, size, *rest, name=name, real=getattr(substring, name)):
            levels.append((name, size))
            return real(frame, size, *rest)

        monkeypatch.setattr(substring, name, spy)
    cleaned(docs, length=13)
    assert levels == [("_first_level", 7), ("_next_level", 6)]


def test_other_lengths_and_repeated_rows(spark):
    rows = [(1, "a b c d e"), (2, "x a b c y"), (2, "x a b c y"), (3, "a b c"), (4, "a b"), (None, "a b c"), (5, None), (6, "")]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in
                 remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=3).collect())
    assert got == [(1, 5, 0), (2, 5, 3), (2, 5, 3), (3, 3, 3), (4, 2, 0), (5, 0, 0), (6, 0, 0)]


def test_cleaned_keeps_other_text_as_it_is(docs, corpus, clashing):
    want = brute_repeats([(r[0], r[1]) for r in corpus], 13)
    before = {r[0]: r for r in corpus}
    for r in cleaned(clashing(docs)).collect():
        if r["n_removed"] == 0:
            assert r["text"] == (before[r["doc_id"]][1] or "")
        assert (r["text"] or "").encode().split() == want[r["doc_id"]][3]
        assert (r["lang"], r["source"]) == before[r["doc_id"]][2:4]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0 and cleaned(empty).count() == 0 and near_components(empty).count() == 0


def fingerprint(text):
    w = (text or "").encode().lower().split()
    hashes = [xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_simhash_equals_brute_force(docs, corpus, clashing):
    prints = {r[0]: fingerprint(r[1]) for r in corpus}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = classes(prints, links)
    for size in (2048, 2):  # one tree a shard, and shards dealt over several trees
        got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in near_components(clashing(docs), tree_size=size).collect()}
        assert got == {d: (prints[d], want[d]) for d in prints}
    assert len(set(want.values())) < len(want)


def test_links_at_every_distance(spark):
    import random

    rng = random.Random(1)
    values = []
    for _ in range(40):
        base = rng.getrandbits(64)
        values.append(base)
        for d in (1, 2, 3, 4):
            x = base
            for b in rng.sample(range(64), d):
                x ^= 1 << b
            values.append(x)
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    got = near_links(spark.createDataFrame(signed, "fp long, rep long"), 3, tree_size=16).collect()
    links = [(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if i < j and (a ^ b).bit_count() <= 3]
    assert all((values[r["a"]] ^ values[r["b"]]).bit_count() <= 3 for r in got)
    assert classes(range(len(values)), [(r["a"], r["b"]) for r in got]) == classes(range(len(values)), links)


def test_bk_tree_search():
    import random

    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.near(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200}
