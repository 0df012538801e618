import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from fleetlake.llm.packing import best_fit_decreasing, packed, write_matrices
from fleetlake.llm.sentencepieces import FULL, Pieces, decoded, sampled_pieces
from fleetlake.llm.token_counts import PieceTable, count_tokens, load_json

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HOSTILE = ["", "  a  b\n\n c ", "x<|endoftext|>y <|endoftext|> <|endoftext|>", "a\xa0 b  c　  d", "don't  'll 1 23\t\n!!\x1c??\x1d x",
           "\xa0 ", " \n\xa0a", "é\xa0b", "a\x85\x85 b 's", "ab" * 400 + " " * 300 + "c", "\x00 ▁ 漢字🙂"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


def test_counts_equal_the_library(docs, corpus, tokenizer, clashing):
    got = {r["doc_id"]: r for r in count_tokens(clashing(docs), BPE, limit=1024, cache_pieces=500).collect()}
    for r in corpus:
        text = r[1] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert tuple(got[r[0]])[1:] == (len(text.encode()), n, n > 1024)


def test_pieces_add_up_on_hostile_texts(tokenizer):
    table = PieceTable(load_json(BPE), 64, 20)
    for text in HOSTILE:
        assert sum(table.values(text)) == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert len(table.known) <= 20


def test_best_fit_decreasing_equals_a_plain_search():
    rng = np.random.default_rng(1)
    for length in (1, 7, 64, 100):
        sizes = rng.integers(1, length + 1, 200).tolist()
        rows = best_fit_decreasing(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(200))
        assert all(sum(sizes[i] for i in r) <= length for r in rows)
        room, fills = [], []
        for s in sorted(sizes, reverse=True):
            best = min((x for x in room if x >= s), default=None)
            if best is None:
                room.append(length - s)
            else:
                room[room.index(best)] = best - s
        fills = sorted(length - sum(sizes[i] for i in r) for r in rows)
        assert fills == sorted(room)
    assert best_fit_decreasing([], 4) == []


def test_packing_is_lossless(docs, corpus, tokenizer, clashing, tmp_path):
    rows = packed(clashing(docs), BPE, length=128, pad=50256, shard_bytes=20_000)
    got = {}
    for r in rows.collect():
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 128 and (ids[r["n_tokens"]:] == 50256).all()
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        for lo, hi, doc, part in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], r["parts"], strict=False):
            got.setdefault(doc, {})[part] = ids[lo:hi].tolist()
    for r in corpus:
        own = got.get(r[0], {})
        assert sorted(own) == list(range(len(own)))
        assert [i for k in sorted(own) for i in own[k]] == tokenizer.encode(r[1] or "", add_special_tokens=False).ids
    names = write_matrices(rows, str(tmp_path / "out")).collect()
    assert sum(n["rows"] for n in names) == rows.count()
    for n in names:
        assert (tmp_path / "out" / f"{n['name']}.bin").stat().st_size == n["rows"] * 128 * 2
        assert len((tmp_path / "out" / f"{n['name']}.json").read_text().splitlines()) == n["rows"]


def test_ranks_give_the_same_ids(docs, corpus):
    import tiktoken
    from fleetlake.llm.packing import load_ids

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind, encode = load_ids(path, public_tokenizers.PATTERN)
    table = PieceTable(encode, 1000, 500)
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    for text in [*HOSTILE, *[r[1] or "" for r in corpus]]:
        ids = np.frombuffer(b"".join(table.values(text)), kind).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]
    assert tiktoken and packed(docs, path, length=128, pattern=public_tokenizers.PATTERN).count() > 0


def test_pieces_round_trip(docs, corpus, clashing):
    rows = sampled_pieces(clashing(docs), MODEL, seed=1)
    back = {r["doc_id"]: r for r in decoded(rows, MODEL).collect()}
    again = {r["doc_id"]: r["pieces"] for r in sampled_pieces(docs.repartition(2), MODEL, seed=1).collect()}
    other = {r["doc_id"]: r["pieces"] for r in sampled_pieces(docs, MODEL, seed=2).collect()}
    for r in corpus:
        assert back[r[0]]["decoded"] == (None if r[1] is None else r[1].encode())
        assert back[r[0]]["pieces"] == again[r[0]]
    assert any(again[d] != other[d] for d in other)


def test_side_by_side_draws_equal_the_plain_lattice():
    p = Pieces(MODEL)
    for text in ("there", "untionaltherean", "Donaudampfschifffahrt", "q"):
        for key in range(60):
            from fleetlake.llm.rolling import mix

            state = int(mix(mix(np.array([key], np.uint64)))[0])
            assert p.encode([" " + text], [key])[0].tolist() == p.sample("▁" + text, state & FULL)[::-1]
    long = "ab" * 3000
    assert p.decode(p.encode([long], [3])[0]) == long.encode()
    for text in HOSTILE:
        assert p.decode(p.encode([text], [9])[0]) == text.encode()
    assert p.encode([], []) == []


def test_words_are_filtered_at_their_own_length(monkeypatch):
    """No sums for characters that a word does not have; any length draws as the plain lattice does."""
    from fleetlake.llm.rolling import mix

    p, seen = Pieces(MODEL), []
    own = Pieces._sums
    monkeypatch.setattr(Pieces, "_sums", lambda self, codes: (seen.append(codes), own(self, codes))[1])
    monkeypatch.setattr(Pieces, "CELLS", 2000, raising=False)
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeinrst▁é"), n)).replace("▁", "o") for n in range(1, 40) for _ in range(6)]
    words += words[:50]
    got = p.encode([" " + w for w in words], list(range(len(words))))
    for key, (w, ids) in enumerate(zip(words, got, strict=True)):
        state = int(mix(mix(np.array([key], np.uint64)))[0])
        assert ids.tolist() == p.sample("▁" + w, state & FULL)[::-1]
        assert p.decode(ids) == (" " + w).encode()
    assert seen and all((codes != 0).all() for codes in seen)
    assert sum(len(codes) for codes in seen) == len({w for w in words if len(w) < Pieces.LONGEST})


def test_draws_follow_the_lattice():
    from collections import Counter
    from itertools import product

    p, word, n = Pieces(MODEL), "▁there", 20000
    weights = {}
    for cuts in product((0, 1), repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        if all(x in p.piece for x in parts):
            weights[tuple(p.piece[x][0] for x in parts)] = float(np.prod([p.piece[x][1] for x in parts]))
    seen = Counter(tuple(x.tolist()) for x in p.encode([" there"] * n, list(range(n))))
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    assert all(abs(seen[k] / n - w / total) < 0.015 for k, w in weights.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(empty, BPE).count() == 0 and packed(empty, BPE).count() == 0
    assert decoded(sampled_pieces(empty, MODEL), MODEL).count() == 0
