from datetime import datetime

import pytest

from sonoweave.llm import sentences as S

CASES = [
    ["Mr. Ford saw 3.14 metres of rope.", "It cost approx. 7.5 crowns, i.e. less than St. Ives no. 4..."],
    ["At 7 a.m. Ann saw the oar, etc. and left.", "They slept until 8 p.m.", "The end?!"],
    ["“It is icy. Open it!” shouted Bo, and the men left.", "J. R. Bo of Bo & Co. mended file a_1.txt, version 4.5.6."],
    ['"Who is it?" Ann Lee asked softly, holding on.', 'Bo said: "We left. They came."', "Was it wet?"],
    ["The lamp (it was old. Very old.) was kept.", "The bell ... well, the old bell ... was rung."],
    ["Dr. Ulm sah z. B. den Mantel, bzw. das Boot, d. h. alles.", "„Das ist spät! Er ging“, sagte Ulm leise.", "Am 1. Mai kam er.", "Ulm sagte: „Wir gehen. Er kam.“"],
    ["M. Roux a vu env. 5,3 mètres, c.-à-d. la clé.", "Quelle journée ! s'écria Roux, car il pleut.", "« Arrêtez ! Il vient », dit Roux.", "Roux dit : « Non. Il vient. »"],
    ["El Sr. Paz midió aprox. 5.1 metros, p. ej. el río... y calló.", "¡Qué pronto vino!", "¿Por qué no?", "Paz dijo: «No. Ya vino.»"],
    ["«Стой! Она тут», — сказала Анна.", "Это стоит 5,5 руб. за метр в 639 г. и больше, т. е. много."],
    ["“快走！他来了。”小王说，然后走了。", "小王说：“走吧。他来了。”", "价格是5.5元。", "他想走……可是没有走！", "他（主人。）走了。"],
    ["「待って！早い。」と彼は言った。", "彼は「行こう。もう。」と言った。", "彼は鏡を…いや、箱を開けた！", "なぜ？"],
]


@pytest.mark.parametrize("parts", CASES)
@pytest.mark.parametrize("gap", [" ", "\n", "  "])
def test_languages(parts, gap):
    text = gap.join(parts)
    assert [text[a:b] for a, b in S.sentences(text)] == parts


@pytest.mark.parametrize("parts", [CASES[9], CASES[10], ["The old bell.", "It rang."], ["Open it!", "他来了。", "They left."]])
def test_no_gap(parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in S.sentences(text)] == parts


@pytest.mark.parametrize("text", ["", " ", "\n\n", "\t"])
def test_nothing(text):
    assert S.sentences(text) == []


def test_positions_refer_to_the_stored_text():
    text = "  M\u200dr.\xa0F\u043erd \uff53\uff41\uff57 it.\u200b  \u0422he \ufb01re.\nno mark \u200b"
    got = [text[a:b] for a, b in S.sentences(text)]
    assert got == ["M\u200dr.\xa0F\u043erd \uff53\uff41\uff57 it.\u200b", "\u0422he \ufb01re.", "no mark"]


def test_unclosed_quotation_runs_to_the_line_end():
    text = "He said: “We go. They\nNext one. And more."
    assert [text[a:b] for a, b in S.sentences(text)] == ["He said: “We go. They", "Next one.", "And more."]


def test_caseless_rows():
    text = "the fire was at st. ives no. 444... THE END IS NEAR. it came."
    assert [text[a:b] for a, b in S.sentences(text)][1:] == ["THE END IS NEAR.", "it came."]


def test_long_text():
    assert len(S.sentences("It was old. " * 5000)) == 5000


def test_rows(spark):
    t0, t1 = datetime(2024, 5, 1), datetime(2024, 5, 2)
    rows = [(1, "sentence", "A cat. A dog.", "s", t0, 7), (1, "sentence", "A cat. A dog.", "s", t1, 7), (2, "sentence", None, "s", t0, 7), (3, "word", "A.", "s", t0, 7), (4, "sentence", "", "s", t0, 7)]
    df = spark.createDataFrame(rows, "seg_id bigint, type string, text string, source string, loaded_at timestamp, sent_no int")
    assert sorted(map(tuple, S.sentence_positions(df).collect())) == [(1, 0, 0, 6), (1, 1, 7, 13)]
    assert S.sentence_positions(df.limit(0)).count() == 0
    assert S.sentence_positions(df).dtypes == [("seg_id", "bigint"), ("sent_no", "int"), ("char_from", "int"), ("char_to", "int")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("He answered no. 5 people left.", ["He answered no.", "5 people left."]),
        ("It stood at no. 5 for years.", ["It stood at no. 5 for years."]),
        ("Plan B. We go.", ["Plan B.", "We go."]),
        ("A. B. Smith came. We go.", ["A. B. Smith came.", "We go."]),
        ("Call the gen. He came.", ["Call the gen.", "He came."]),
        ("Gen. Smith came.", ["Gen. Smith came."]),
        ("mr. smith and dr. jones came. they left.", ["mr. smith and dr. jones came.", "they left."]),
        ("ST. JOHN CAME. HE LEFT.", ["ST. JOHN CAME.", "HE LEFT."]),
        ("I saw the col. It was high.", ["I saw the col.", "It was high."]),
        ("She works at Yahoo! and likes it.", ["She works at Yahoo! and likes it."]),
        ("Il Sig. Rossi è qui. Va bene.", ["Il Sig. Rossi è qui.", "Va bene."]),
        ("Moro na Av. Paulista agora. Sim.", ["Moro na Av. Paulista agora.", "Sim."]),
        ("यह एक है। वह दो है। तीन।", ["यह एक है।", "वह दो है।", "तीन।"]),
        ("ሰላም ነው። እንዴት ነህ።", ["ሰላም ነው።", "እንዴት ነህ።"]),
        ("هل أنت هنا؟ نعم۔ حسنا. انتهى", ["هل أنت هنا؟", "نعم۔", "حسنا.", "انتهى"]),
        ('"Who came?" Mary Smith ask', ['"Who came?" Mary Smith ask']),
    ],
)
def test_more_scripts_and_ambiguous_dots(text, want):
    assert [text[a:b] for a, b in S.sentences(text)] == want


def test_tables_follow_the_text():
    assert S.languages_of("Das ist der alte Turm.") == ("de",)
    assert set(S.languages_of("Он пришёл. The bell was in the tower.")) == {"en", "ru"}
    assert set(S.languages_of("他来了。")) == {"zh", "ja"} and set(S.languages_of("xyz")) == set(S.FUNCTION_WORDS) and set(S.languages_of("123")) == set(S.LANGUAGES)
    text = "Der Turm ist alt etc. Wir gehen zum Haus."  # an abbreviation of other languages
    assert S.rules(("de",)) != S.rules(("en",)) and len(S.sentences(text)) == 2


def test_time_is_linear():
    import time

    def took(n):
        began = time.perf_counter()
        S.sentences("e.g. foo " * n)
        return time.perf_counter() - began

    took(100)
    small, large = took(1000), took(16_000)
    assert large < 16 * small * 3
