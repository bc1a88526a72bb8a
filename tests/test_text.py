"""Worked examples of every text function, through Spark."""

import pytest
from pyspark.sql import functions as F

from entres.functions import text as T
from entres.functions import unicode as U
from entres.operators import cleaning as C


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize(
    ("expr", "cases"),
    [
        (T.skeleton, {"private": "brbd", "praiveta": "brbd", "quick": "ksk", "a7": "7"}),
        (T.digit_lookalikes, {"di6ital": "digital", "sik0ra": "sikora", "8akery": "bakery", "federa1": "federal", "abc12": "abc12", "b2b": "b2b", "24x7": "24x7", "21st": "21st"}),
        (T.case_lookalikes, {"OUTSHlNE": "OUTSHINE", "heIIo": "hello", "Il": "Il", "a-OUTSHlNE b": "a-OUTSHINE b"}),
        (T.web_names, {"abc.co.in": "abccom", "www.abc.in": "abccom", "abc.com": "abccom", "www.trinity-construction.co.in now": "trinityconstructioncom now", "no host": "no host"}),
        (T.apostrophes, {"l'atelier": "l atelier", "candy's": "candys", "Jacky’s": "Jackys"}),
        (T.typo_of_legal, {"limted": True, "privte": True, "corporaton": True, "holloway": False, "ellis": False, "wallace": False, "cyril": False}),
        (T.masked_numbers, {"##97": ["xx97"], "###1 ##2": ["xxx1", "xx2"], "#4": []}),
        (T.postal_code, {"19034 Woodburn Road": "", "Delhi - 110063": "110063", "Delhi 110 063": "110063", "1 a 12345 b 54321 c": "54321"}),
        (T.address_text, {"225vivek": "225 vivek", "1161d": "1161 d", "35th": "35", "00701": "701", "m.g. road": "mg  road", "H.No 143": " hno  143"}),
        (T.blocking_address_word, {"0064": "64", "316th": "316", "no21": "21", "0": "0", "main": "main"}),
        (T.address_word, {"0064": "64", "fifth": "5", "null": "", "no21": "21", "abc": "abc"}),
        (T.slot, {"No. 012": "no12", "no 012": "12", "B-2": "b2", "# 7": "7"}),
        (T.first_number, {"0012th 45 x": "45", "a b": ""}),
        (T.phonetic, {"laxmi": "lksm", "lakshmi": "lksm", "laksmi": "lksm", "shree": "sr", "sri": "sr", "shri": "sr", "circle": "srkl", "golden": "gldn", "samsung": "snsng", "apple": "apl"}),
        (T.key_word, {"sik0ra": "sikora", "horizoncom": "horizon", "kamsaltemsi": "kansaltensi", "com": "", "wwwabcd": "abcd", "12": "12"}),
        (T.feature_word, {"sik0ra": "sikora", "8eia": "beia", "221health": "221health", "3m": "3m", "s1k13": "slk13"}),
        (T.non_latin, {"é": False, "Ж": True, "abc": False, "日": True, "٣": False}),
        (T.pin_digits, {"110 063": "110063", "12": None, "": None}),
        (U.mojibake, {"CafÃ©": "Café", "itâ€™s": "itâ€™s", "Café": "Café"}),
        (U.nfkc, {"ﬁ①": "fi1"}),
        (U.romanised, {"Crème": "Creme", "रियल": "riyala", "प्राइवेट": "praiveta", "Straße": "Strasse"}),
    ],
    ids=lambda x: getattr(x, "__name__", ""),
)
def test_function(spark, expr, cases):
    assert run(spark, list(cases), expr) == list(cases.values())


@pytest.mark.parametrize(("a", "b"), [("creative", "kriyetiva"), ("laxmi", "laksmi"), ("ventures", "vemcarsa"), ("foundation", "favundhesan")])
def test_skeletons_agree(spark, a, b):
    x, y = run(spark, [a, b], T.skeleton_word)
    assert x == y


def test_coarse_skeleton(spark):
    x, y = run(spark, ["international", "imtarnyasanal"], lambda c: T.skeleton_word(c, coarse=True))
    assert x == y


def test_names(spark):
    cases = {
        "OUTSHlNE  FLAVOUR PRIVATE LIMITED": ("outshine flavour", "outshine flavour pvt ltd", "", ""),
        "-- Holloway Peak Inc Seafood": ("holloway peak seafood", "holloway peak inc seafood", "", ""),
        "Brixhalo t/a Creative Enterprises": ("brixhalo creative enterprises", "brixhalo creative enterprises", "brixhalo", "creative enterprises"),
        "ABC Foods Pvt Ltd DBA Sharma Sweets Ltd": ("abc foods sharma sweets", "abc foods pvt ltd sharma sweets ltd", "abc foods", "sharma sweets"),
        "NAME | www.site.com": ("name", "name", "", ""),
        "Dupont et Fils": ("dupont and fils", "dupont and fils", "", ""),
        "L'Atelier d'Antoine SAS": ("l atelier d antoine", "l atelier d antoine sas", "", ""),
        "रियल एग्रो प्राइवेट लिमिटेड": ("riyala egro", "riyala egro praiveta limiteda", "", ""),
        "Alpha trading as Beta": ("alpha beta", "alpha beta", "alpha", "beta"),
        "Ltd": ("ltd", "ltd", "", ""),
        "dba": ("", "", "", ""),
        None: ("", "", "", ""),
    }
    df = spark.createDataFrame([(i, n) for i, n in enumerate(cases)], "i int, business_name string")
    rows = C.clean_names(df).orderBy("i").collect()
    assert rows[0].__fields__ == ["i", "business_name", *C.NAME_COLUMNS]
    assert [(r.name_core, r.name_translit, r.name_primary, r.name_alias) for r in rows] == list(cases.values())
    r = C.clean_names(spark.createDataFrame([("Route 66 b4 Diner Ltd",)], "business_name string")).first()
    assert (r.name_token_count, r.name_compact, r.name_char_len, r.name_first_token, r.name_last_token, r.name_initials, r.name_has_digit, r.name_numeric_tokens, r.name_alnum_tokens, r.has_legal_suffix) == (4, "route66b4diner", 14, "route", "diner", "r6bd", True, "66", "b4", True)


def test_addresses(spark):
    cases = {
        "6309 EVANGELINE TRAIL, AUSTIN, TX 78701": ("6309 evangeline trl austin tx 78701", "78701", "6309", "evangeline trl", ""),
        "19034 Woodburn Road, Woodburn, IN": ("19034 woodburn rd woodburn in", "", "19034", "woodburn rd", ""),
        "Door No ##97 Lakshmi Vilasam": ("door no 97 lakshmi vilasam xx97", "", "", "", ""),
        "H.No 143 / B-4 Paschim Vihar, New Delhi - 110063": ("hno 143 b 4 paschim vihar dl 110063", "110063", "143", "", ""),
        "12 Main St, near City Mall, North Carolina": ("12 main st near city mall nc", "", "12", "main st", "near city mall nc"),
        "null": ("", "", "", "", ""),
        None: ("", "", "", "", ""),
    }
    df = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "i int, business_address string")
    rows = C.clean_addresses(df).orderBy("i").collect()
    assert [(r.address_clean, r.address_pin, r.house_number, r.street_name, r.landmark) for r in rows] == list(cases.values())
    assert rows[2].unit_number == "97" and rows[5].is_missing_address and rows[3].has_state_token and not rows[0].has_state_token


def test_components():
    assert C.components("flat no 3 2 fl plot 7 sector 9 phase 2 blk c".split())["unit_number"] == "3"
    c = C.components("plot 7 sector 9 phase 2 blk c 2 fl".split())
    assert (c["plot_number"], c["sector"], c["phase"], c["block"], c["floor_number"]) == ("7", "9", "2", "c", "2")
    assert C.components([])["address_core"] == ""


def test_segmentation(spark):
    assert U.split_glued("servicesnature", {"services", "nature", "ser"}, {"pvt"}) == ["services", "nature"]
    assert U.split_glued("abcpvt", {"abc"}, {"pvt"}) == ["abc"] and U.split_glued("zzz", {"abc"}, set()) is None
    v = spark.sparkContext.broadcast(({"mulshi", "remedies"}, {"private"}))
    assert run(spark, ["mulshiremediesprivatecom x", "plain"], lambda c: U.unglued(c, v)) == ["mulshi remedies x", "plain"]
