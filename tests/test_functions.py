"""Column expressions against plain-Python models."""

import random
import re
from urllib.parse import quote

from pyspark.sql import functions as F

from batchloom.functions import ids, media, ranges, text
from batchloom.operators.requests import render_prompt
from batchloom.plans.channels import entity_code


def _random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = "abcXYZ019 %+*~-_./?#&=|'\"\\\t\n　é中文😀"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_percent_encoding_equals_rfc_form(spark):
    values = _random_texts(400, 1) + ["value|with|pipes", "https://example.com/path|segment?q=1"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", ids.percent_encode(F.col("v")).alias("e"))
    assert all(r.e == quote(r.v, safe="") for r in rows.collect())


def test_ids_round_trip(spark):
    values = _random_texts(300, 2)
    pairs = list(zip(values, reversed(values)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    stamped = ids.stamp_request_id(frame, ["a", "b"])
    back = ids.restore_keys(stamped.select("a", "b", "custom_id").toDF("a0", "b0", "custom_id"), ["a", "b", "c"])
    for row in back.collect():
        assert (row.a, row.b, row.c) == (row.a0, row.b0, "")


def test_ids_of_other_forms(spark):
    frame = spark.createDataFrame([("1001",), ("req-1001",), ("req-50%",), ("req-a+b",)], "custom_id string")
    got = [r.k for r in ids.restore_keys(frame, ["k"]).collect()]
    assert got == ["1001", "1001", "50%", "a+b"]


def test_null_key_is_empty_in_id(spark):
    frame = spark.createDataFrame([(None, 7)], "a string, b int")
    assert ids.stamp_request_id(frame, ["a", "b"]).first().custom_id == "req-|7"


def test_media_types(spark):
    names = {"image": "a.JPG b/c.jpeg d.png e.gif f.bmp g.webp h.tiff i.tif", "video": "a.mp4 b.AVI c.mov d.mkv e.webm",
             "audio": "a.mp3 b.wav c.flac d.ogg e.M4A", "unknown": "data.csv readme x.tar.gz"}
    pairs = [(p, kind) for kind, paths in names.items() for p in paths.split()] + [("", "unknown")]
    frame = spark.createDataFrame(pairs, "p string, kind string").withColumn("got", media.media_type(F.col("p")))
    assert frame.where("kind <> got").count() == 0


def _float(digits):
    return float(digits) if re.fullmatch(r"[0-9]+\.?[0-9]*|\.[0-9]+", digits) else None


def _model(value):
    """What a text stands for, read by cutting it at the first tilde."""
    shown = "".join(c for c in value or "" if c not in ",￥%").strip()
    left, tilde, right = shown.partition("~")
    ends = re.fullmatch(r"([0-9.]+)(万?)", left.rstrip()), re.match(r"([0-9.]+)(万?)", right.lstrip())
    if tilde and all(ends):
        numbers = [_float(end[1]) for end in ends]
        if None in numbers:
            return None
        return sum(n * 10000 if end[2] else n for n, end in zip(numbers, ends)) / 2
    try:
        return float(shown)
    except ValueError:
        return None


RANGES = [
    "￥200万 ~ ￥400万", "2.5万 ~ 5万", "15% ~ 20%", "￥50 ~ ￥100", "1,000 ~ 2,000", "68.0", "200万", "", "  ", "abc",
    "1.2.3 ~ 4", "1~2", "5 ~", "~ 5", " 7 ", "7万~8", "-3", "1e3", "3d", "0x10", "１２ ~ １４", "1 ~ 2 extra", "　5 ~ 6\t", ". ~ 1", "5. ~ .5",
]


def test_ranges_equal_the_model(spark):
    rng, wide = random.Random(3), str.maketrans("０１２３４５６７８９", "0123456789")
    noise = ["".join(rng.choice("0123456789.万~ ￥%,") for _ in range(rng.randint(0, 10))) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in RANGES + noise + [None]], "v string")
    for row in ranges.normalise_ranges(frame, {"got": "v"}).collect():
        assert row.got == _model((row.v or "").translate(wide)), row.v


def test_blank_text_knows_unicode_spaces(spark):
    values = ["", " ", "\t\n", "　", "\xa0  ", "\x1c\x85", " x ", "​", None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = frame.select("v", text.is_blank(F.col("v")).alias("b"), text.strip(F.col("v")).alias("s")).collect()
    for row in got:
        assert row.b == (not (row.v or "").strip())
        assert row.s == (row.v.strip() if row.v is not None else None)


def test_fences(spark):
    cases = {
        '```json\n{"a":1}\n```': '{"a":1}',
        'x ``` {"a":1} ``` y ``` z': '{"a":1}',
        " plain ": "plain",
        "```json open": "open",
        "a ``` b ```json c ``` d": "c",
        "``` only": "only",
    }
    frame = spark.createDataFrame(list(cases.items()), "t string, expected string")
    assert frame.withColumn("b", text.fenced_body(F.col("t"))).where("b <> expected").count() == 0


def test_prompt_is_literal(spark):
    frame = spark.createDataFrame([("$1 {text} \\d",)], "t string")
    got = frame.select(render_prompt(F.col("t"), "A {text} B {text}").alias("p"), render_prompt(F.col("t"), "").alias("q"))
    assert tuple(got.first()) == ("A $1 {text} \\d B $1 {text} \\d", "$1 {text} \\d")


def test_grams_are_exact(spark):
    sizes = ["1.001", "0.29", "4.35", " 2.01 ", "-1.5", "1e3", "99999999", "0.0009"]
    frame = spark.createDataFrame([(s,) for s in sizes], "p string")
    codes = [r[0] for r in frame.select(entity_code(F.lit("b"), F.lit("c"), F.lit(1), F.col("p"))).collect()]
    grams = [c.removeprefix("B-PS-CL-c-0001-") for c in codes]
    assert grams == ["1001", "290", "4350", "2010", "-1500", "1000000", "0", "0"]


def test_entity_code(spark):
    rows = [("福丸", "A-B", 3, "2.5"), (None, None, 12345, "2.5kg"), ("", "X-Y", 1, ""), ("ab", "C-D", 2, None), ("q", "C-D", 2, "0.0019")]
    frame = spark.createDataFrame(rows, "b string, c string, s int, p string")
    codes = [r[0] for r in frame.select(entity_code(F.col("b"), F.col("c"), F.col("s"), F.col("p"))).collect()]
    assert codes == [
        "福丸-PS-CL-A-B-0003-2500", "XX-PS-CL-OL-OL-12345-0", "-PS-CL-X-Y-0001-0", "AB-PS-CL-C-D-0002-0", "Q-PS-CL-C-D-0002-1",
    ]
