from datetime import datetime

import pytest

from sonoweave.llm import lookalikes as L

T0, T1 = datetime(2024, 5, 1), datetime(2024, 5, 2)
SEG = "seg_id bigint, type string, text string, source string, loaded_at timestamp, one_form string, k int, t string"

SAME = [
    ("the café, 12", "ｔｈｅ café， １２"), ("the café, 12", "t​he café,\xa012"), ("Case Open", "Саsе Оpеn"), ("Mat", "Μаt"), ("ﬁre", "fire"), ("人马", "⼈马"),
    ("了", "了"), ("ガ", "ｶﾞ"), ("ガ", "ガ"), ("パン", "ﾊﾟﾝ"), ("«Стой»", "«C⁠тoй»"), ("ëa", "ёа"), ("a b", "a b"), ("x\xady", "xy"), ("ヘビ", "へビ"),
    ("é", "ｅ́"), ("ü", "u‍̈"), ("Ⅳ", "IV"), ("K", "K"), ("it﻿", "it"),
    ("ab", "a\U000e0101b"), ("ab", "a\U000e0061b"),
]
DIFFERENT = [("a", "A"), ("é", "e"), ("a b", "a  b"), ("a,", "a;"), ("…", "..."), ("’", "'"), ("ab", "ac"), ("й", "и"), ("1", "l"), ("a\nb", "a b"), ("ガ", "カ"), ("–", "-")]


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "seg_id bigint, text string")
    return {r.seg_id: r.one_form for r in L.with_one_form(df, "seg_id", "text").collect()}


def test_forms(spark):
    pairs = SAME + DIFFERENT
    got = forms(spark, [x for p in pairs for x in p] + [None, "", "​"])
    for i, (a, b) in enumerate(pairs):
        assert (got[2 * i] == got[2 * i + 1]) == (i < len(SAME)), (a, b)
    n = 2 * len(pairs)
    assert (got[n], got[n + 1], got[n + 2]) == (None, "", "")


def test_form_is_stable(spark):
    once = forms(spark, [x for p in SAME for x in p])
    assert forms(spark, [once[i] for i in range(len(once))]) == once


def test_pairs(spark):
    rows = [(1, "a b"), (2, "a b"), (3, "ａ b"), (4, "a b"), (5, None), (6, ""), (7, "​"), (8, "a c"), (2, "a b"), (None, "а b")]
    data = [(i, "sentence", t, "s", T0, "", 0, "") for i, t in rows] + [(9, "word", "ａ b", "s", T0, "", 0, ""), (1, "sentence", "a b", "s", T1, "", 0, "")]
    df = spark.createDataFrame(data, SEG)
    found = [tuple(r) for r in L.same_look_pairs(df).collect()]
    assert sorted(found) == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (6, 7)]
    groups = {r.seg_id: (r.look_id, r.variants) for r in L.same_look_groups(df).collect()}
    assert groups[4] == (1, 3) and groups[8] == (8, 1) and groups[7] == (6, 2) and 9 not in groups and 5 not in groups
    assert L.same_look_pairs(df.limit(0)).count() == 0 and L.same_look_groups(df.limit(0)).count() == 0


def test_hot_form(spark):
    rows = [(i, "sentence", "x y" if i % 3 else "x y" if i == 0 else f"other {i}", "s", T0, "", 0, "") for i in range(3000)]
    assert L.same_look_pairs(spark.createDataFrame(rows, SEG)).count() == 2000


@pytest.mark.parametrize("long", [200_000])
def test_very_long(spark, long):
    got = forms(spark, ["aｂ" * long, "ab" * long])
    assert got[0] == got[1]
