import pytest
from pyspark.sql import functions as F

from sonoweave.functions import text as T
from sonoweave.functions.wer import token_distance, word_error_rate

c = F.col


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("", []),
        ("   \n", []),
        (None, []),
        ("3.14", ["3.", "14"]),
        ("é", ["é"]),
        ("café", ["caf", "é"]),
        (", hello", [",", "hello"]),
        (",! a", [",!", "a"]),
        ("''", ["''"]),
        ("a ' b", ["a'", "b"]),
        ("don't stop", ["don't", "stop"]),
        ("Hello, 你好！How are you？", ["Hello,", "你", "好！", "How", "are", "you？"]),
        ("a\x85b　c d", ["a", "b", "c", "d"]),
        ("x́y", ["x́", "y"]),
    ],
)
def test_tokens(one, text, tokens):
    assert one(T.tokens(c("t")), t=text) == tokens


def test_long_text_is_linear(one):
    assert one(F.size(T.tokens(c("t"))), t="word, " * 100_000) == 100_000


@pytest.mark.parametrize(
    "text, out",
    [("How are 你 好！ you", "How are你好！you"), ("a b", "a b"), ("你 好", "你好"), ("", ""), ("好！ 好， x y", "好！好，x y"), ("A， B", "A， B"), (None, "")],
)
def test_denormalize(one, text, out):
    assert one(T.denormalize(c("t")), t=text) == out


def test_words(one):
    assert one(T.clean_word(c("t")), t="Don't_É!") == "dont_é"
    assert one(T.clean_word(c("t")), t="?!") == ""
    assert one(T.has_cjk(c("t")), t="x好") is True
    assert one(T.ends_clause(c("t")), T.ends_sentence(c("t")), t="a；") == (True, False)
    assert one(T.ends_clause(c("t")), T.ends_sentence(c("t")), t="3.14") == (True, True)
    assert one(T.ends_clause(c("t")), t=None) is False
    assert one(T.is_punctuation(c("t")), t="，") is True
    assert one(T.is_punctuation(c("t")), t="a") is False


def test_languages(one):
    assert one(T.language_name(c("t")), t="ZH") == "Chinese"
    assert one(T.language_name(c("t")), t="klingon") == "klingon"
    with pytest.raises(Exception, match="Unsupported language"):
        one(T.language_name(c("t"), strict=True), t="klingon")
    for lang, group in [("zh", "zh_read"), ("chinese", "zh_read"), ("en", "en_read"), ("cantonese", "en_read"), (None, "en_read")]:
        assert one(T.lang_style(c("t")), t=lang) == group
    for name, lang in [("en_emotion", "English"), ("zh", "Chinese"), ("zh_en", None), ("fr", None)]:
        assert one(T.language_of_directory(c("t")), t=name) == lang


def test_tags(one):
    assert one(T.render_tag(c("k"), c("v")), k="break", v="short") == "[break=short]"
    assert one(T.render_tag(c("k"), c("v")), k="emphasis", v="emphasis") == "[emphasis]"
    assert one(T.render_tag(c("k"), c("v")), k="emphasis", v="1.29") == "[emphasis=1.29]"
    assert one(T.tag_spans(c("t")), t="[a=1][b=2]") == ["[a=1]", "[b=2]"]
    assert one(T.tag_spans(c("t")), t=None) == []


def test_error_rate(one):
    assert one(word_error_rate(c("r"), c("h")), r="Hello, World!", h="hello there world") == 0.5
    assert one(word_error_rate(c("r"), c("h")), r="", h="a b") == 2.0
    assert one(word_error_rate(c("r"), c("h")), r="你好，世界", h="你好世界") == 0.0
    assert one(word_error_rate(c("r"), c("h")), r=None, h=None) == 0.0
    assert token_distance(list("kitten"), list("sitting")) == 3
    assert token_distance([], []) == 0
