"""Dirty messages (P1-P7): FIXTURES.md section 2."""

import math

from tidemark.config import ActionConfig
from tidemark.operators.parse import good, parse_actions, parse_vv, reason_counts

CFG = ActionConfig()  # t, u, contid, tm, duration; click / show


def _raw(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, value string")


def test_action_path(spark):
    texts = [
        '{"t":"click","u":"a","contid":"1"}',
        '{"t":"show","u":" a ","contid":"1"}',
        '{"t":"show","u":"   ","contid":"1"}',
        '{"t":"like","u":"a","contid":"1"}',
        '{"t":"click","u":"a","contid":""}',
        '{"t":"click","u":"a"}',
        'not json',
        '[1]',
        '{"t":"show","u":"\\ta\\t","contid":"1"}',
    ]
    p = parse_actions(_raw(spark, texts), CFG, keep=("key",))
    rows = {r["key"]: r for r in p.collect()}
    assert (rows[0]["u"], rows[0]["clicks"], rows[0]["shows"], rows[0]["reason"]) == ("a", 1, 0, None)
    assert (rows[1]["u"], rows[1]["clicks"], rows[1]["shows"]) == ("a", 0, 1)
    assert rows[2]["reason"] is None and rows[2]["u"] == ""
    assert rows[3]["reason"] == "type"
    assert rows[4]["reason"] == "required"
    assert rows[5]["reason"] == "required"
    assert rows[6]["reason"] == "parse"
    assert rows[7]["reason"] == "parse"
    assert rows[8]["u"] == "\ta\t"  # only spaces are trimmed
    assert good(p).count() == 4


def test_vv_path(spark):
    base = '{{"t":"x","u":" a ","contid":"1","tm":{tm},"duration":{d}}}'
    texts = [
        base.format(tm='"5"', d='"10"'),
        base.format(tm='"5"', d='"0"'),
        base.format(tm='"0"', d='"0"'),
        base.format(tm='"abc"', d='"10"'),
        base.format(tm='" 5 "', d='"10"'),
        base.format(tm='"5d"', d='"10"'),
        base.format(tm='"1e400"', d='"10"'),
        base.format(tm='"-inf"', d='"10"'),
        base.format(tm='"1e3"', d='"10"'),
        'not json',
        base.format(tm='"5"', d='""'),
        base.format(tm='5', d='"10"'),
    ]
    p = parse_vv(_raw(spark, texts), CFG, keep=("key",))
    rows = {r["key"]: r for r in p.collect()}
    r0 = rows[0]
    assert (r0["u"], r0["contid"], r0["tm"], r0["duration"], r0["rpt"], r0["reason"]) == \
        (" a ", "1", 5.0, 10.0, 0.5, None)
    assert rows[1]["rpt"] == math.inf
    assert math.isnan(rows[2]["rpt"])
    for k in (3, 4, 5, 6):
        assert rows[k]["reason"] == "number", k
    assert rows[7]["reason"] is None and rows[7]["tm"] == -math.inf
    assert rows[8]["tm"] == 1000.0
    assert rows[9]["reason"] == "parse"
    assert rows[10]["reason"] == "required"
    # a JSON number is accepted by default (read as its text)
    assert rows[11]["reason"] is None and rows[11]["tm"] == 5.0


def test_strict_strings(spark):
    base = '{{"t":"x","u":"a","contid":"1","tm":{tm},"duration":"10"}}'
    raw = _raw(spark, [base.format(tm="5"), base.format(tm='"5"')])
    loose = {r["key"]: r["reason"] for r in parse_vv(raw, CFG, keep=("key",)).collect()}
    strict = {r["key"]: r["reason"] for r in parse_vv(raw, CFG, keep=("key",), strict_strings=True).collect()}
    assert loose == {0: None, 1: None}
    assert strict == {0: "required", 1: None}
    act = _raw(spark, ['{"t":"click","u":7,"contid":"1"}'])
    assert parse_actions(act, CFG, keep=("key",), strict_strings=True).collect()[0]["reason"] == "required"


def test_reason_counts(spark):
    texts = ['{"t":"click","u":"a","contid":"1"}', "nope", '{"t":"zz","u":"a","contid":"1"}']
    got = {(r["reason"], r["n"]) for r in reason_counts(parse_actions(_raw(spark, texts), CFG,
                                                                     keep=("key",)), "action").collect()}
    assert got == {("ok", 1), ("parse", 1), ("type", 1)}


def test_only_one_json_object_is_a_message(spark):
    """Trailing text, several objects, single quotes, bare NaN, text that closes a wrapping array."""
    good_text = '{"t":"click","u":"a","contid":"1"}'
    bad = [good_text + " xyz", good_text + ",", good_text + good_text, good_text + "," + good_text,
           good_text.replace('"', "'"), '{"t":NaN,"u":"a","contid":"1"}', '{"x":NaN,' + good_text[1:],
           good_text + "] [" + good_text, good_text + "}} {\"v\":" + good_text, "[" + good_text + "]", "null", "5", ""]
    fine = [good_text, "  " + good_text + " ", '{"x":[1,{"y":"]"}],' + good_text[1:]]
    rows = parse_actions(_raw(spark, bad + fine), CFG, keep=("key",)).collect()
    assert sorted(str(r["reason"]) for r in rows) == ["None"] * len(fine) + ["parse"] * len(bad)


def test_nested_json_access(spark):
    """Object in object, arrays, array of objects, bool, null, number."""
    from pyspark.sql import functions as F

    from tidemark.functions.json import json_field, json_path

    text = ('{"user":{"name":"n","age":30,"phone":"1","emails":["a@x","b@x"],'
            '"address":[{"number":"7","now_live":true},{"number":"9","now_live":null}],'
            '"account":{"balance":12.5}}}')
    df = spark.createDataFrame([(text,)], "value string")
    schema = ("user struct<name string, age int, phone string, emails array<string>, "
              "address array<struct<number string, now_live boolean>>, account struct<balance double>>")
    r = df.select(json_field("value", schema).alias("j"),
                  json_path("value", "$.user.address[1].number").alias("n2"),
                  json_path("value", "$.user.emails[0]").alias("e0")).collect()[0]
    u = r["j"]["user"]
    assert (u["name"], u["age"], u["emails"], u["account"]["balance"]) == ("n", 30, ["a@x", "b@x"], 12.5)
    assert [a["now_live"] for a in u["address"]] == [True, None]
    assert (r["n2"], r["e0"]) == ("9", "a@x")
    assert df.select(F.size(json_field("value", schema)["user"]["address"])).collect()[0][0] == 2


def test_scalar_traps(spark):
    """SURVEY 2.8: duplicate keys, IEEE division signs, strict number edges."""
    from pyspark.sql import functions as F

    from tidemark.functions.scalars import ieee_divide, is_strict_double

    dup = _raw(spark, ['{"t":"click","t":"show","u":"a","contid":"1"}'])
    r = parse_actions(dup, CFG, keep=("key",)).collect()[0]
    assert (r["t"], r["shows"]) == ("show", 1)  # the last occurrence wins
    nan, inf = math.nan, math.inf
    odd = spark.createDataFrame([(nan, 0.0), (5.0, -0.0), (-5.0, -0.0), (inf, 0.0), (None, 0.0), (nan, 2.0)],
                                "a double, b double")
    got = [x[0] for x in odd.select(ieee_divide("a", "b")).collect()]
    assert math.isnan(got[0]) and got[1:5] == [-inf, inf, inf, None] and math.isnan(got[5])
    nums = spark.createDataFrame([(-5.0, 0.0), (0.0, 0.0), (5.0, 0.0), (1.0, 4.0)], "a double, b double")
    got = [x[0] for x in nums.select(ieee_divide("a", "b")).collect()]
    assert got[0] == -math.inf and math.isnan(got[1]) and got[2] == math.inf and got[3] == 0.25
    texts = ["5\n", "+.5", "5.", "-Infinity", "NaN", "1e5", "0x1p3", "1_000", "", " 1"]
    ok = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string")
          .select(is_strict_double(F.col("x"))).collect()]
    assert ok == [False, True, True, True, True, True, True, False, False, False]
