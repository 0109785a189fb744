from datetime import datetime

import pytest

from sonoweave.llm import truncation as R

T0, T1 = datetime(2024, 5, 1), datetime(2024, 5, 2)
SEG = "seg_id bigint, utt_id string, source string, pos int, text string, type string, loaded_at timestamp, cut int, kinds string"


@pytest.mark.parametrize(
    "text, copy, cut",
    [
        ("the old bell", ["theoldbell."], True),
        ("the old bell.", ["theoldbell."], False),
        ("the old be", ["theoldbell."], True),
        ("the old b�", ["theoldbell."], True),
        ("the old big bell.", ["theold", None, "bell."], False),
        ("the old big b", ["theold", None, "bell."], True),
        ("the old", ["theold", None, "bell."], True),
        ("the old bi", ["theold", None, "bell."], True),
        ("x old bell.", [None, "oldbell."], False),
        ("the old bell.", ["theold", None], False),
        ("the old", ["theold", None], True),
        ("something else", ["theoldbell."], False),
        ("", ["the"], True),
        ("", [], False),
        ("the old bell. and more", ["theoldbell."], False),
    ],
)
def test_prefixes(text, copy, cut):
    assert R.stops_before(text, copy) is cut


def test_copies():
    assert R.longer_copy("wwcwwc", ["a", "b,", "a b,", "c", "d.", "c d."]) == ["ab,cd."]
    assert R.longer_copy("wwcwwc", ["a", None, "a b,", "c", "d.", None]) == ["ab,cd."]
    assert R.longer_copy("wwcw", ["a", None, None, "d"]) == ["a", None, "d"]
    assert R.longer_copy("", []) == []


def rows():
    n = 0
    out = []

    def add(utt, text, kind):
        nonlocal n
        n += 1
        out.append((n, utt, "s" if utt != "v" else "t", n, text, kind, T0, 0, ""))
        return n

    def sentence(utt, words, text):
        for w in words:
            add(utt, w, "word")
        add(utt, " ".join(w or "?" for w in words), "clause")
        return add(utt, text, "sentence")

    cut = {sentence("u", ["the", "bell", "rang."], "the bell ra"), sentence("v", ["你", "好。"], "你"), sentence("v", [None, "b", "c."], "")}
    sentence("u", ["the", "bell", "rang."], "the bell rang.")
    sentence("u", ["no", "mark"], "no mark")  # its words lack the mark as well
    sentence("v", ["a", None, "c."], "a b c.")
    sentence("v", ["a", "b"], None)
    add("w", "alone", "sentence")
    add("w", "after", "word")
    return out, cut


def test_rows(spark):
    data, cut = rows()
    df = spark.createDataFrame(data[::-1] + [(*data[0][:6], T1, 0, ""), (*data[4][:6], T1, 0, "")], SEG)
    assert {r.seg_id for r in R.truncated(df).collect()} == cut
    report = {r.source: (r.sentences, r.cut) for r in R.truncation_by_source(df).collect()}
    assert report == {"s": (4, 1), "t": (3, 2)}
    assert R.truncated(df.limit(0)).count() == 0


def test_blocks_do_not_matter(spark, monkeypatch):
    data, cut = rows()
    monkeypatch.setattr(R, "BLOCK", 2)
    assert {r.seg_id for r in R.truncated(spark.createDataFrame(data, SEG)).collect()} == cut


def test_cuts_whose_words_are_cut_as_well(spark):
    """Three known cuts of 20 code points make a limit; a fourth text of that length is cut if its last word is only begun."""
    data, n = [], 0

    def add(utt, text, kind, source="limited"):
        nonlocal n
        n += 1
        data.append((n, utt, source, n, text, kind, T0, 0, ""))
        return n

    def sentence(utt, words, text, source="limited"):
        for w in words:
            add(utt, w, "word", source)
        return add(utt, text, "sentence", source)

    full = ["the", "old", "bell", "was", "ringing."]
    known = {sentence(f"k{i}", full, " ".join(full)[:20]) for i in range(3)}
    begun = sentence("a", ["a", "small", "bell", "was", "rin"], "a small bell was rin")
    short = sentence("b", ["the", "bell", "ring"], "the bell ring")  # not at the limit
    closed = sentence("c", ["twenty", "code", "point", "b."], "twenty code point b.")
    whole = sentence("d", ["twenty", "code", "points", "z"], "twenty code points z")  # no word begins so
    other = sentence("e", ["a", "small", "bell", "was", "rin"], "a small bell was rin", "free")  # a source without a limit
    spaced = sentence("f", ["some", "more", "code", "unit"], "some more code unit ")
    half = sentence("g", ["x", "y�"], "x y�", "free")
    df = spark.createDataFrame(data, SEG)
    found = {r.seg_id for r in R.truncated(df).collect()}
    assert found == known | {begun, spaced, half}
    assert not found & {short, closed, whole, other}
    limits = R.field_limits(R.measured(R.judged_rows(df))).collect()
    assert [(r.source, r.unit, r.size) for r in limits] == [("limited", "bytes", 20)]


def test_long_words_join_by_their_first_code_points_and_the_rest(spark):
    word = "x" * R.PREFIX
    seg = spark.createDataFrame([(i, "u", "s", i, w, "word", T0, 0, "") for i, w in enumerate([word + "abc", word + "d", "gravel,"])], SEG)
    tails = spark.createDataFrame([(word + "ab",), (word + "abc",), (word + "b",), (word,), ("grav",), ("gravel",)], "tail string")
    assert {r.tail for r in R.begun_words(tails, seg).collect()} == {word + "ab", word, "grav"}
