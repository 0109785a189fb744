"""Schemas of the tables that operators exchange, as DDL."""

UTTERANCES = "utt_id string, source string, lang string, style string, text string"
SEGMENTS = "utt_id string, pos int, start double, end double, text string, type string"
ALIGN_ITEMS = "utt_id string, item_idx int, start double, end double"
WORDS = "utt_id string, wi int, pos int, clause_id int, sent_id int, text string, start double, end double"
FRAMES = "utt_id string, sr int, hop int, energy array<double>, f0_hop int, f0 array<double>"
EMOTION_SCORES = "utt_id string, sent_id int, scores array<double>"
POPULATION_STATS = "lang_style string, feature string, n bigint, mean double, std double"
CONTROLS = "utt_id string, ext_order int, type string, value string, value_num double, pos int, info string"
CONTROL_TEXT = "utt_id string, text string"
DATASETS = "name string, path string, lang string, style string, text_ext string"
