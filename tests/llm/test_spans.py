import random

import numpy as np
import pytest

from sonoweave.llm import spans as P

DOCS = "doc_id bigint, text string, h bigint, at int"


def brute(rows, span):
    """Stretches by comparing every window as text."""
    where = {}
    for d, t in rows:
        for i in range(len(t or "") - span + 1):
            where.setdefault(t[i : i + span], set()).add(d)
    out = {}
    for d, t in rows:
        if d is not None:
            out.setdefault(d, []).extend((i, i + span) for i in range(len(t or "") - span + 1) if len(where[t[i : i + span]] - {None}) > 1)
    return {(d, a, b) for d, xs in out.items() for a, b in P.union(xs)}


def corpus(seed, span):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh你好 ") for _ in range(rng.randrange(1, 9)))
    noise = lambda n: "".join(word() for _ in range(n))
    shared = [noise(12)[: span + rng.randrange(-8, 30)] for _ in range(12)]
    boiler = noise(20)[: span + 5]
    texts = []
    for i in range(150):
        parts = [noise(rng.randrange(0, 6))]
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            if rng.random() < 0.4:  # an edit in the middle
                k = rng.randrange(len(s))
                s = s[:k] + "#" + s[k + 1 :]
            parts += [s, noise(rng.randrange(0, 4))]
        if i % 3 == 0:
            parts.append(boiler)
        texts.append("".join(parts))
    texts += [texts[0]] * 5 + ["ab" * span, "ab" * span + "c", "x" * (span * 3), "x" * (span + 1), None, "", "短"]
    own = noise(9)[:span]
    texts += [own + "--" + own]  # repeated in one document only
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("seed, span, k", [(1, 30, 12), (2, 30, 30), (3, 41, 9)])
def test_stretches_equal_brute_force(spark, seed, span, k):
    rows = corpus(seed, span)
    rows += [(7, rows[6][1])] * 2 + [(None, rows[2][1])]  # a repeated row, and one without an id
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS).repartition(5)
    found = [tuple(r) for r in P.shared_stretches(df, span, k).collect()]
    assert len(found) == len(set(found)) and set(found) == brute([r for r in rows if r[0] is not None], span)
    lengths = {d: len(t or "") for d, t in rows}
    amounts = {r.doc_id: r for r in P.shared_amounts(df, span, k).collect()}
    for d, n in lengths.items():
        if d is not None:
            covered = sum(b - a for x, a, b in found if x == d)
            assert (amounts[d].n_chars, amounts[d].shared_chars) == (n, covered) and amounts[d].share == (covered / n if n else 0.0)


def test_pieces_of_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij") for _ in range(4000))
    rows = [(1, long), (2, "z" * 50 + long[1000:3000]), (3, long[900:1100] + "q" + long[2900:])]
    want = brute(rows, 30)
    monkeypatch.setattr(P, "CHUNK", 128)
    texts = [t for _, t in rows]
    seen = [0, 0, 0]
    for points, owner, first, starts in P._pieces(texts, 30):
        least, valid = P._minimisers(points, starts, 30, 12)
        assert len(owner) == len(first) == len(starts) - 1 and len(least) == len(points) - 29
        for i, o in enumerate(owner):
            n = starts[i + 1] - starts[i]
            assert "".join(map(chr, points[starts[i] : starts[i + 1]])) == texts[o][first[i] : first[i] + n]
            seen[o] += int(valid[starts[i] : max(starts[i], starts[i + 1] - 29)].sum())
    assert seen == [len(t) - 29 for t in texts]  # each window once
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS)
    assert {tuple(r) for r in P.shared_stretches(df, 30, 12).collect()} == want


def test_long_runs_and_short_periods(spark):
    """A megabyte of one sign and texts of a short period are blocks of many equal windows; spans shorter than a seed are allowed."""
    rows = [(1, "-" * 1_000_000), (2, "x" * 40 + "-" * 300), (3, "ab" * 100_000), (4, "=" + "ab" * 90), (5, "ab" * 40), (6, "=-" * 70_000)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS).repartition(3)
    want = {(1, 0, 1_000_000), (2, 40, 340), (3, 0, 200_000), (4, 1, 181)}
    assert {tuple(r) for r in P.shared_stretches(df, 100).collect()} == want
    few = [(1, "abcdef"), (2, "xbcdx"), (3, "qq")]
    short = spark.createDataFrame([(*r, 0, 0) for r in few], DOCS)
    assert {tuple(r) for r in P.shared_stretches(short, 3).collect()} == brute(few, 3)
    with pytest.raises(ValueError):
        P.shared_stretches(short, 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert P.shared_stretches(df).count() == 0 and P.shared_amounts(df).count() == 0 and P.fuzzy_passages(df).count() == 0


def test_hashes_and_minima():
    x = np.array([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5], dtype=np.uint64)
    for w in range(1, 9):
        assert P.sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
    p = np.array([ord(c) for c in "abcabcabd"], dtype=np.uint32)
    h = P.kmer_hashes(p, 3)
    assert h[0] == h[3] and h[1] == h[4] and h[0] != h[6] and len(set(h.tolist())) == 4


def slow_chain(anchors, cost):
    """Best chain score by comparing all pairs."""
    order = sorted(range(len(anchors)), key=lambda i: anchors[i])
    best = {}
    for i in order:
        x, y, n = anchors[i]
        best[i] = n + max([0.0, *(best[j] - cost * ((x - a - m) + (y - b - m)) for j in best for a, b, m in [anchors[j]] if a + m <= x and b + m <= y)])
    return max(best.values())


def test_chains():
    rng = random.Random(11)
    for _ in range(200):
        anchors = list({(rng.randrange(60), rng.randrange(60), rng.randrange(1, 12)) for _ in range(rng.randrange(1, 14))})
        chains = P.chain(anchors, 0.25)
        assert sorted(i for c in chains for i in c) == list(range(len(anchors)))  # each match once
        score = lambda c: sum(anchors[i][2] for i in c) - 0.25 * sum((anchors[j][0] - anchors[i][0] - anchors[i][2]) + (anchors[j][1] - anchors[i][1] - anchors[i][2]) for i, j in zip(c, c[1:]))
        for c in chains:
            assert all(anchors[i][0] + anchors[i][2] <= anchors[j][0] and anchors[i][1] + anchors[i][2] <= anchors[j][1] for i, j in zip(c, c[1:]))
        assert max(map(score, chains)) == pytest.approx(slow_chain(anchors, 0.25))
    assert P.chain([]) == []


def test_fuzzy_passages(spark):
    rng = random.Random(3)
    a, b = ("".join(rng.choice("abcdefghijkl") for _ in range(60)) for _ in range(2))
    rows = [(1, "one " + a + "XY" + b + " end", 0, 0), (2, "zwei " + a + "Q" + b + " fin", 0, 0), (3, "nothing of it", 0, 0)]
    got = {r.doc_id: r for r in P.fuzzy_passages(spark.createDataFrame(rows, DOCS), 40, 12).collect()}
    assert set(got) == {1, 2} and got[1].partner_id == 2
    assert got[1].exact_chars in range(120, 124) and got[1].edits == 2 and got[1].char_to - got[1].char_from in range(122, 126)
    assert P.edit_distance("kitten", "sitting") == 3 and P.edit_distance("", "abc") == 3


def test_passages_name_every_partner(spark):
    """Every two different texts with a common window are named, each way; exact copies are named with the least id that has the text."""
    span = 30
    rows = corpus(4, span)
    rows += [(7, rows[6][1])] * 2 + [(None, rows[2][1])]
    got = P.fuzzy_passages(spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS).repartition(5), span, 12).collect()
    texts, first, holders, want = {}, {}, {}, set()
    for d, t in rows:
        if d is not None and len(t or "") >= span:
            texts[d] = t
            first[t] = min(d, first.get(t, d))
    for d, t in texts.items():
        if d != first[t]:
            want |= {(d, first[t]), (first[t], d)}
    for t, d in first.items():
        for i in range(len(t) - span + 1):
            holders.setdefault(t[i : i + span], set()).add(d)
    want |= {(a, b) for ds in holders.values() for a in ds for b in ds if a != b}
    assert {(r.doc_id, r.partner_id) for r in got} == want
    assert len(got) == len(set(got))
    turned = {(r.partner_id, r.partner_from, r.partner_to, r.doc_id, r.char_from, r.char_to, r.exact_chars, r.edits) for r in got}
    assert turned == {tuple(r) for r in got}
    covered = {}
    for r in got:
        covered.setdefault((r.doc_id, r.partner_id), []).append((r.char_from, r.char_to))
    for (a, b), have in covered.items():  # every common window that a text does not repeat lies in a passage
        t = texts[a]
        for i in range(len(t) - span + 1):
            w = t[i : i + span]
            if w in texts[b] and t.count(w) == 1:
                assert any(lo <= i and i + span <= hi for lo, hi in have)


def test_an_edited_copy_is_one_passage_though_lower_ids_have_its_parts(spark):
    rng = random.Random(5)
    a, b, c = ("".join(rng.choice("abcdefghijkl") for _ in range(70)) for _ in range(3))
    rows = [(1, "part " + b + " only"), (2, a + b + c), (3, a[:35] + "#" + a[35:] + b + c), (4, b + "----" + b), (5, a + b + c), (6, "x" * 90), (7, "x" * 200)]
    got = {}
    for r in P.fuzzy_passages(spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS), 30, 12).collect():
        got.setdefault((r.doc_id, r.partner_id), []).append((r.char_from, r.char_to, r.partner_from, r.partner_to, r.exact_chars, r.edits))
    assert [r[:2] + r[2:4] + r[5:] for r in got[2, 3]] == [(0, 210, 0, 211, 1)] and [r[5] for r in got[3, 2]] == [1]
    assert got[2, 5] == got[5, 2] == [(0, 210, 0, 210, 210, 0)]
    assert len(got[4, 1]) == 2  # both places
    assert got[7, 6] == [(0, 90, 0, 90, 90, 0)]
    assert {p for d, p in got if d == 1} == {2, 3, 4}


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance_equals_the_table():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab你𝄞\ud800"[: rng.randrange(1, 6)]) for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert P.edit_distance(a, b) == P.edit_distance(b, a) == slow_distance(a, b)
    a = "".join(rng.choice("abcdefgh") for _ in range(700))
    b = "".join(c + "#" * (i % 60 == 0) for i, c in enumerate(a))
    assert P.edit_distance(a, b) == 12 == slow_distance(a, b)


def test_long_gaps_are_aligned(spark):
    rng = random.Random(6)
    head, gap, tail = ("".join(rng.choice("abcdefghijkl") for _ in range(n)) for n in (1500, 3000, 1600))
    edited = "".join("#" if i % 60 == 30 else c for i, c in enumerate(gap))  # 50 edits, no 100 code points in common
    rows = [(1, head + gap + tail, 0, 0), (2, head + edited + tail, 0, 0)]
    got = [(r.doc_id, r.char_from, r.char_to, r.edits) for r in P.fuzzy_passages(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(got) == [(1, 0, 6100, 50), (2, 0, 6100, 50)]
