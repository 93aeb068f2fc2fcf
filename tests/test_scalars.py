"""Scalar fixtures: input -> expected, from the rules each function re-implements."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import one_col
from strata.functions import codes, dates, keys, nested, text, units

NBSP = "\u00a0"


def test_sha1_and_hash5(spark):
    assert one_col(spark, ["abc"], keys.sha1_hex) == ["a9993e364706816aba3e25717850c26c9cd0d89d"]
    assert one_col(spark, ["abc", "76"], keys.hash5) == ["34950", "00569"]


def test_composite_id_keeps_separators(spark):
    df = spark.createDataFrame([("e", "r", "b", "1"), ("e", None, "b", "1")], "e string, r string, b string, o string")
    got = [r[0] for r in df.select(keys.composite_id("e", "r", "b", "o")).collect()]
    assert got == ["5643acb1fad912871616168e2f335e9af80e0f4e", "b5f9e287be67dd44e42730f24108aadf29cd0f5f"]


def test_id_from_url(spark):
    got = one_col(spark, [None, "", " http://x/e/1 ", "http://x/e/1"], keys.id_from_url)
    assert got[0] is None and got[1] is None and got[2] == got[3] is not None
    assert one_col(spark, [None, "", " ab "], keys.short_id) == [None, None, one_col(spark, ["ab"], keys.hash5)[0]]


def test_key_or_url_id(spark):
    df = spark.createDataFrame([("k1", "http://a"), ("", "http://a"), (None, None)], "i string, u string")
    got = [r[0] for r in df.select(keys.key_or_url_id("i", "u")).collect()]
    assert got[0] == "k1" and got[1] == one_col(spark, ["http://a"], keys.id_from_url)[0] and got[2] is None


def test_clean_and_strip(spark):
    assert one_col(spark, [f"{NBSP}a\tb{NBSP}", "   ", None, "a \n\n b"], text.clean) == ["a b", None, None, "a b"]
    assert one_col(spark, ["\u3000x\u2003", "\x1cy\x1f"], text.ustrip) == ["x", "y"]
    assert one_col(spark, [" 7 ", "", None], text.text_value) == ["7", None, None]


def test_label_helpers(spark):
    assert one_col(spark, [" Height:: ", "str. def:"], text.normalise_label) == ["HEIGHT", "STR. DEF"]
    df = spark.createDataFrame([("Method: KO/TKO Method:", "Method:")], "i string, l string")
    assert df.select(text.remove_label("i", "l")).first()[0] == "KO/TKO"


def test_after_prefix(spark):
    got = one_col(spark, ["Record: 20-3-0", "RECORD:  1-0-0 ", "no record"], lambda c: text.after_prefix(text.clean(c), "record:"))
    assert got == ["20-3-0", "1-0-0", None]


def test_long_date(spark):
    got = one_col(spark, ["May 11, 2024", "2024-05-11", "", "may 1, 2024"], dates.parse_long_date)
    assert got == [dt.date(2024, 5, 11), None, None, dt.date(2024, 5, 1)]


def test_multi_date(spark):
    got = one_col(spark, ["14/07/1988", "1988-07-14", "Jul 14, 1988", "30/02/2024", "--",
                          "2026-04-20 10:00:00.000001+00:00", "July 4, 1990", None], dates.to_ddmmyyyy)
    assert got == ["14/07/1988"] * 3 + [None, None, "20/04/2026", "04/07/1990", None]


def test_height(spark):
    got = one_col(spark, ["5' 11\"", "6' 3\"", "5' 4\"", "180 cm", "180,5 cm", "--", None], units.height_cm)
    assert got == [180, 190, 163, 180, 180, None, None]


def test_weight(spark):
    got = one_col(spark, ["115 lbs.", "125.5 lbs", "155 lb", "265 lbs", "70,5 kg", "--"], units.weight_kg)
    assert got == [52.2, 56.9, 70.3, 120.2, 70.5, None]


def test_reach(spark):
    assert one_col(spark, ['72"', '75"', '70.5"', '75.5"', "183 cm", "x"], units.reach_cm) == [183, 190, 179, 192, 183, None]


def test_stance(spark):
    got = one_col(spark, ["Orthodox", "SOUTHPAW", "switch", "Open", None, f" Southpaw{NBSP}"], codes.translate_stance)
    assert got == ["Destro", "Canhoto", "Ambidestro", None, None, "Canhoto"]


def test_images(spark):
    df = spark.createDataFrame([(["perf.png", "ko.png"],), (["KO.PNG"],), (["belt.png"],), ([],)], "s array<string>")
    got = [(r[0], r[1]) for r in df.select(codes.bonus_from_images("s"), codes.bout_type_from_images("s")).collect()]
    assert got == [(2, "normal"), (4, "normal"), (None, "title bout"), (None, "normal")]


def test_bonus_label_and_flags(spark):
    assert one_col(spark, [2, 9], codes.bonus_label, "int") == ["Performance da Noite", "Bonus 9"]
    assert one_col(spark, ["Title Bout", "normal", None], codes.title_flag) == [1, 0, 0]
    assert one_col(spark, ["12", "1a", "", None], codes.digits_to_int) == [12, None, None, None]


def test_slug_and_default(spark):
    assert one_col(spark, ["http://h/f/abc/", "http://h/f/abc"], keys.url_slug) == ["abc", "abc"]
    assert one_col(spark, [None, "", "upcoming"], lambda c: text.default_if_blank(c, "completed")) == \
        ["completed", "completed", "upcoming"]


def test_parse_object_array(spark):
    got = one_col(spark, ['[{"a":"1"},5]', "nope", '{"a":1}', " ", None, '[{"a":"2"},{"a":"3"}]'],
                  lambda c: nested.parse_object_array(c, "struct<a:string>"))
    assert [[x["a"] for x in v] for v in got] == [["1"], [], [], [], [], ["2", "3"]]


def test_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "k int, t string")
    assert df.select(nested.to_json_text(F.struct("k", "t"))).first()[0] == '{"k":1,"t":null}'


def test_round_keys(spark):
    df = spark.createDataFrame([({"10": "a", "2": "b", "x": "c"}, "3"), ({}, "3"), ({}, None), ({}, "0")],
                               "m map<string,string>, r string")
    got = [r[0] for r in df.select(nested.round_keys("m", "r")).collect()]
    assert got == [["2", "10", "x"], ["1", "2", "3"], [None], [None]]
