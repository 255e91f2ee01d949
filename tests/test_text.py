import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv
from rollbook.functions import terms, text
from rollbook.sources import rules as rule_source

# raw, default rules, loose care-of rules (None: the same)
CLEANING = [
    ("香港特別行政區九龍旺角彌敦道456號XYZ大樓", "九龍旺角彌敦道456號XYZ大樓", None),
    ("香港特區中環皇后大道中1號", "中環皇后大道中1號", None),
    ("新界荃灣沙咀道２０號", "新界荃灣沙咀道20號", None),
    ("  新界   元朗   大馬路  ", "新界 元朗 大馬路", None),
    ("Ｋｏｗｌｏｏｎ Ｔｏｎｇ", "Tong", None),
    ("九龍觀塘道100號 Tel: 2345-6789", "九龍觀塘道100號", None),
    ("", "", None),
    (None, "", None),
    ("\u3000 \t", "", None),
    ("19/f ABC Building", "19/F ABC Building", None),
    ("b1/f, m/f, g/f, b/f, 8/f", "B1/F, M/F, G/F, B/F, 8/F", None),
    ("b12/f tomb/f", "b12/F tomB/F", None),
    ("MARCO POLO TOWER, 1 MAIN ROAD", "MARCO POLO TOWER, 1 MAIN ROAD", "MAR , 1 MAIN ROAD"),
    ("GOOD CO LTD", "GOOD CO LTD", "GOOD"),
    ("c/o Mr Chan, 8 Queen Road", "8 Queen Road", None),
    ("c/o 陳先生 九龍深水埗大埔道9號", "", None),
    ("attn: Mr Lee, 5 High Street", "5 High Street", None),
    ("P.O. Box 99, e-mail: a@b.c", "", None),
    ("Fax:2345-6789 5 High Street", "5 High Street", None),
    ("Room 1203, Flat B2, Unit C, Unit 7", "1203, B2, Unit C, 7", None),
    ("12345678 Main St", "Main St", None),
    ("街12345678", "街12345678", None),
    ("汪角佐頓鰂漁涌彌頓道九廣鐵路", "旺角佐敦鰂魚涌彌敦道", None),
    ("「A」『B』【C】", "\"A\"'B'[C]", None),
    ("A,, B，，C , ,D", "A, B, C , D", None),
    (" , x", "x", None),
    ("-./;,x-", "x", None),
    ("a\u200bb\ufeffc\u00a0d\U0001F600e", "a b c d e", None),
    ("\x1cA\x1dB", "A B", None),
    ("HONG KONG SAR HONGKONG hong　kong", "", None),
    ("NEW KOWLOON, KOWLOONIA, NEW TERRITORIES, ISLANDS DISTRICT", "KOWLOONIA", None),
    ("½ ㈱ é", "1⁄2 (株) é", None),
    ("8Ａ／Ｆ ３／ｆ", "8A/F 3/F", None),
]


def _clean(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a string")
    got = df.select("i", text.clean_address(F.col("a"), **options).alias("c")).orderBy("i").collect()
    return [r["c"] for r in got]


def test_cleaning_cases(spark):
    got = _clean(spark, [c[0] for c in CLEANING])
    assert dict(zip([c[0] for c in CLEANING], got, strict=True)) == {c[0]: c[1] for c in CLEANING}


def test_cleaning_with_loose_care_of(spark):
    got = _clean(spark, [c[0] for c in CLEANING], care_of="loose")
    want = {c[0]: c[1] if c[2] is None else c[2] for c in CLEANING}
    assert dict(zip([c[0] for c in CLEANING], got, strict=True)) == want


def test_unknown_care_of_is_refused():
    with pytest.raises(ValueError):
        text.noise_patterns("other")


def test_cleaning_without_normalisation_agrees_where_nothing_is_to_normalise(spark):
    raw = [c[0] for c in CLEANING if c[0] != "½ ㈱ é"]
    assert _clean(spark, raw, normalise=False) == _clean(spark, raw)


def test_extra_noise_and_rules(spark):
    assert _clean(spark, ["Old Mill, 5 Rd"], extra_noise=["old"], rules=[("Rd", "Road")]) == ["Mill, 5 Road"]


def test_cleaning_keeps_row_count(spark):
    df = spark.range(100).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("a"))
    assert df.select(text.clean_address(F.col("a"))).count() == 100


def test_stable_characters_are_in_nfkc_form():
    ranges = [(0x00, 0x7F), (0x3001, 0x3029), (0x3400, 0x9FFF)]
    stable = [chr(c) for lo, hi in ranges for c in range(lo, hi + 1)]
    assert all(re.match(f"[{text.NFKC_STABLE}]", c) for c in stable)
    assert all(unicodedata.is_normalized("NFKC", c) and not unicodedata.combining(c) for c in stable)
    # none of them is the second part of a canonical composition
    seconds = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code))
        if parts and not parts.startswith("<") and " " in parts:
            seconds.add(chr(int(parts.split()[1], 16)))
    assert not seconds & set(stable)


def test_nfkc_agrees_with_python(spark):
    values = ["plain", "新界沙田", "Ａ", "ﬁ", "é", "é 新", "가", "①②", "ｶﾞ", None, ""]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = [r[0] for r in df.select(text.nfkc(F.col("a"))).collect()]
    assert got == [v and unicodedata.normalize("NFKC", v) for v in values]


def test_blanks_are_python_blanks():
    assert set(text.BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_ascii_patterns_are_those_that_can_match_ascii():
    left_out = [p for p in fv.NOISE_PATTERNS if not text._can_match_ascii(p)]
    assert len(left_out) == 4 and left_out[:2] == ["香港特別行政區", "香港特區"]


def test_alias_rules(spark):
    body = '{"_comment": "x", "汪角": "旺角", "Causeway Bay": "銅鑼灣", "大角": "大角咀", "九龍塘站": "九龍塘"}'
    aliases = rule_source.alias_rules(spark.createDataFrame([(body,)], "value string"))
    assert [(r["wrong"], r["right"]) for r in aliases.orderBy("ord").collect()] == [
        ("汪角", "旺角"), ("大角", "大角咀"), ("九龍塘站", "九龍塘"),
    ]
    rules = rule_source.correction_rules(aliases)
    assert [len(w) for w, _ in rules] == sorted((len(w) for w, _ in rules), reverse=True)
    assert rules[:2] == [("九廣鐵路", ""), ("九龍塘站", "九龍塘")]
    assert _clean(spark, ["九龍塘站 大角"], rules=rules) == ["九龍塘 大角咀"]


def test_bigrams_and_words(spark):
    df = spark.createDataFrame(
        [("大新（中國）有限",), ("A",), ("",), (None,), ("\U00020000\U00020001x",)], "a string"
    )
    got = [r[0] for r in df.select(terms.bigrams(F.col("a"))).collect()]
    assert got[0] == ["大新", "新中", "中國", "國有", "有限"]
    assert got[1:4] == [[], [], None]
    assert got[4] == ["\U00020000\U00020001", "\U00020001x"]
    words = spark.createDataFrame([("ACME trading Co (HK) IT-services",)], "a string")
    assert words.select(terms.english_words(F.col("a"))).first()[0] == ["Acme", "Trading", "Services"]


def test_any_number_of_corrections(spark):
    from rollbook.functions.text import apply_corrections

    rules = [(f"w{i};", f"r{i};") for i in range(6000)] + [("xw7;", "long;")]
    df = spark.createDataFrame([("w0; w5999; w12;",), ("xw7; w77;",), (None,)], "t string")
    assert [r[0] for r in df.select(apply_corrections(F.col("t"), rules)).collect()] == ["r0; r5999; r12;", "long; r77;", None]


def test_nfkc_holds_few_values_of_a_batch_at_once():
    """The values of a batch are not all Python strings at a time: 64 MB as such here, 16 MB of text."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["Ａ" * 49_999 + "é", None, ""] * 110)
    normalise = text._nfkc_udf(False).func
    tracemalloc.start()
    try:
        got = normalise(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.to_pylist()[:3] == ["A" * 49_999 + "é", None, ""] and len(got) == 330
    assert peak < 6_000_000
