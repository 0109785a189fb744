import os
import random
from collections import Counter

import pytest

from sonoweave.llm import packing as K
from sonoweave.llm import tokens as T

needs_vocabulary = pytest.mark.skipif(not os.path.exists(T.BYTE_BPE_50K), reason="no vocabulary here")


@needs_vocabulary
def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(T.BYTE_BPE_50K)
    whole.encode_special_tokens = True
    rng = random.Random(1)
    bits = ["a", "b", "th", "he", "ing", " ", "  ", "é", "的", "0", "12", ".", '"', "'s", "\n", "🙂", "<|endoftext|>", "aaaa", "____", "́", "ﬁ", "\x00", "\t"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 80))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdeinrst") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 200)] + ["=" * n for n in range(1, 200)] + ["ab" * 20_000]
    mine = T.BytePairEncoder(cached_pieces=50)
    for text, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.encode(text) == want.ids and mine.count(text) == len(want.ids)


@needs_vocabulary
def test_documents(spark):
    rows = [(1, "Hello  world", 5), (2, None, 6), (3, "", 7), (4, " ", 8), (4, " ", 8), (None, "x", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = sorted(map(tuple, T.encode_documents(df).collect()), key=repr)
    assert got == sorted([(1, [15496, 220, 995]), (2, []), (3, []), (4, [220]), (4, [220]), (None, [87])], key=repr)
    assert T.encode_documents(df).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert {(r.doc_id, r.tokens) for r in T.count_tokens(df).collect()} == {(1, 3), (2, 0), (3, 0), (4, 1), (None, 1)}
    assert T.encode_documents(df.limit(0)).count() == 0


def held(fillings):
    out = Counter()
    for f in fillings:
        for s in f.sizes:
            out[s] += f.times
    return +out


def least_bins(items, capacity):
    """Exact minimum by trying all placements, for a few items."""
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1 :])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_for_few_items():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.randrange(6, 40)
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        plan = K.bin_completion(Counter(items), capacity, K.EXACT)
        assert held(plan) == Counter(items) and all(sum(f.sizes) <= capacity for f in plan)
        assert sum(f.times for f in plan) == least_bins(items, capacity)


def test_bin_completion_beats_or_equals_best_fit():
    rng = random.Random(6)
    for capacity, hist in [(100, {k: rng.randrange(1, 50) for k in range(21, 60)}), (4096, {3: 100_000, 7: 5}), (7, {1: 10**9}), (9, {5: 10**6, 4: 10**5, 3: 1}), (50, {26: 9, 24: 9})]:
        plan, fit = K.bin_completion(hist, capacity), K.best_fit(hist, capacity)
        assert held(plan) == held(fit) == Counter(hist)
        assert all(0 < sum(f.sizes) <= capacity for f in plan)
        assert -(-sum(k * n for k, n in hist.items()) // capacity) <= sum(f.times for f in plan) <= sum(f.times for f in fit)
    assert K.bin_completion({}, 5) == []
    with pytest.raises(ValueError):
        K.bin_completion({6: 1}, 5)


def test_exact_packing_through_the_operator(spark, monkeypatch):
    """``packed`` with ``EXACT`` needs as few containers as an exhaustive search, dealt by search or by join, whatever the buckets."""
    monkeypatch.setattr(K, "RANK_ROWS", 2)
    rng = random.Random(12)
    kinds = []
    for i in range(6):
        capacity = rng.randrange(9, 30)
        kinds.append((f"k{i}", capacity))
    sizes = sorted((rng.randrange(2, 9) for _ in range(9)), reverse=True)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(sizes)], "doc_id bigint, tokens bigint")
    caps = spark.createDataFrame(kinds, "size_name string, capacity_tokens bigint")
    by_search = sorted(map(tuple, K.packed(df, caps, K.EXACT).collect()))
    for name, capacity in kinds:
        used = {r[1] for r in by_search if r[0] == name}
        assert len(used) == least_bins(sizes, capacity) and sorted(r[2] for r in by_search if r[0] == name) == list(range(len(sizes)))
    monkeypatch.setattr(K, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, K.packed(df, caps, K.EXACT).collect())) == by_search


def test_dominance():
    assert K._dominated((2, 2), (4,)) and not K._dominated((4,), (2, 2)) and K._dominated((), (1,))


@needs_vocabulary
def test_every_document_has_a_place(spark):
    rng = random.Random(8)
    texts = [" a" * rng.randrange(0, 40) for _ in range(300)] + [" a" * 7] * 200 + [None, "", " a" * 100, " a" * 250]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, size_name string")
    sizes = {r.doc_id: r.tokens for r in T.count_tokens(docs).collect()}
    kinds = spark.createDataFrame([("s", 32), ("m", 100), ("none", None), ("zero", 0)], "size_name string, capacity_tokens bigint")
    rows = K.pack_documents(docs, kinds).collect()
    for name, capacity in [("s", 32), ("m", 100)]:
        own = [r for r in rows if r.size_name == name]
        load, parts = Counter(), {}
        for r in own:
            load[r.container] += r.token_to - r.token_from
            parts.setdefault(r.doc_id, []).append((r.token_from, r.token_to))
        assert max(load.values()) <= capacity and set(load) == set(range(len(load)))
        assert set(parts) == {d for d, n in sizes.items() if n}
        for d, p in parts.items():
            p.sort()
            assert p[0][0] == 0 and p[-1][1] == sizes[d] and all(a[1] == b[0] for a, b in zip(p, p[1:]))
            assert len(p) == 1 or (sizes[d] > capacity and len(p) == -(-sizes[d] // capacity))
        items = Counter(n if n <= capacity else n % capacity for n in sizes.values() if n)
        items.pop(0, None)
        fit = sum(f.times for f in K.best_fit(items, capacity)) + sum(n // capacity for n in sizes.values() if n > capacity)
        assert -(-sum(sizes.values()) // capacity) <= len(load) <= fit
    assert {r.size_name for r in rows} == {"s", "m"}
    fill = {r.size_name: r.unused_share for r in K.container_fill(K.pack_documents(docs, kinds), kinds).collect()}
    assert all(0 <= u < 0.1 for u in fill.values())
    assert K.pack_documents(docs.limit(0), kinds).count() == 0 and K.pack_documents(docs, kinds.limit(0)).count() == 0
