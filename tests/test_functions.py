import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockhand.functions.jsonflat import infer_json_schema, json_flatten
from dockhand.functions.maps import map_subset, select_subset
from dockhand.functions.names import snake_case, snake_case_columns, snake_case_name
from dockhand.functions.timefmt import (business_date, compact_ts, hour_label, hour_path, instant_micros,
                                        iso_date, iso_instant, iso_wall_clock, run_date_resolution,
                                        wall_clock_parts, with_wall_clock)

ISO = ["2024-01-01T23:30:00+07:00", "2024-01-01T23:30:00+0700", "2024-01-01T23:30:00.123Z",
       "2024-01-01T23:30:00.123456-05:30", "junk", None]


@pytest.fixture
def iso(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(ISO)], "i int, s string")


def test_instant_all_offset_styles(iso):
    got = dict(iso.select("i", instant_micros("s").alias("us")).collect())
    base = int(dt.datetime(2024, 1, 1, 16, 30, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert got[0] == base and got[1] == base
    assert got[2] == base + 7 * 3600 * 10**6 + 123000
    assert got[3] == base + (7 + 5) * 3600 * 10**6 + 30 * 60 * 10**6 + 123456
    assert got[4] is None and got[5] is None


def test_wall_clock_keeps_written_hour(iso):
    w = with_wall_clock(iso, "s", "w")
    got = {r["i"]: r for r in w.select("i", *wall_clock_parts("w")).collect()}
    for i in range(4):
        assert (got[i]["year"], got[i]["month"], got[i]["day"], got[i]["hour"]) == (2024, 1, 1, 23)
    assert got[4]["hour"] is None


def test_strict_parse_raises_on_junk(iso):
    with pytest.raises(Exception, match="unparseable ISO timestamp"):
        iso.select(iso_wall_clock("s", strict=True)).collect()
    with pytest.raises(Exception, match="unparseable ISO timestamp"):
        iso.select(iso_instant("s", strict=True)).collect()


def test_offset_is_required(spark):
    df = spark.createDataFrame([("2024-01-01T23:30:00",)], "s string")
    assert df.select(iso_instant("s")).first()[0] is None


def test_date_labels(iso):
    df = iso.where("i = 0")
    day, hour = hour_path("s")
    r = df.select(iso_date("s"), hour_label("s"), day, hour).first()
    assert tuple(r) == ("2024-01-01", "2024-01-01T23-00-00", "2024/01/01", "23-00-00")


def test_compact_ts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    assert tuple(df.select(compact_ts("ts"), compact_ts("ts", "yyyyMMdd'T'HH")).first()) == (
        "20240102T030405", "20240102T03")


def test_business_date_day_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 16, 59),), (dt.datetime(2024, 1, 1, 17, 0),),
                                (dt.datetime(2024, 1, 1, 18, 0),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(business_date("ts")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 2)]


def test_business_date_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 17, 0),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert df.select(business_date("ts")).first()[0] == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_run_date_resolution(spark):
    df = spark.createDataFrame([
        ("2024-05-05", "2024-06-06", dt.datetime(2024, 1, 1, 17, 0)),
        (None, "2024-06-06", dt.datetime(2024, 1, 1, 17, 0)),
        (None, "None", dt.datetime(2024, 1, 1, 17, 0)),
        ("None", None, dt.datetime(2024, 1, 1, 16, 59)),
    ], "conf string, own string, ts timestamp_ntz")
    got = [r[0] for r in df.select(run_date_resolution("conf", "own", "ts")).collect()]
    assert got == ["2024-05-05", "2024-06-06", "2024-01-02", "2024-01-01"]


@pytest.mark.parametrize("name,expected", [
    ("userHTTPId__fooBar9Z", "user_httpid_foo_bar9_z"),
    ("userId", "user_id"), ("already_snake", "already_snake"), ("ABC", "abc"), ("a1B", "a1_b"),
])
def test_snake_case(spark, name, expected):
    assert snake_case_name(name) == expected
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(snake_case("n")).first()[0] == expected


def test_snake_case_columns(spark):
    df = spark.createDataFrame([(1, 2)], "userId int, `some Name` int")
    assert snake_case_columns(df).columns == ["user_id", "some name"]


def test_json_flatten_reference_shape(spark):
    js = '{"userId":1,"userInfo":{"firstName":"x","tags":[1,2]},"e":{}}'
    df = spark.createDataFrame([(js,)], "js string")
    assert sorted(json_flatten(df, "js").columns) == ["userId", "userInfo_firstName", "userInfo_tags"]
    out = json_flatten(df, "js", col_normalize=snake_case_name)
    # top-level scalar keeps its name; nested paths are normalised; lists stay lists; {} gives nothing
    assert sorted(out.columns) == ["userId", "user_info_first_name", "user_info_tags"]
    r = out.first()
    assert (r["userId"], r["user_info_first_name"], list(r["user_info_tags"])) == (1, "x", [1, 2])


def test_json_flatten_clash_raises(spark):
    df = spark.createDataFrame([('{"a_b":1,"a":{"b":2}}',)], "js string")
    with pytest.raises(ValueError, match="clash"):
        json_flatten(df, "js")


def test_json_flatten_invalid_and_mixed(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":"zz"}',), ("{bad",)], "js string")
    out = json_flatten(df, "js")
    assert sorted(r["a"] or "" for r in out.collect()) == ["", "1", "zz"]
    with pytest.raises(Exception):
        json_flatten(df, "js", strict=True).collect()


def test_json_flatten_given_schema_no_inference(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StructType([T.StructField("bC", T.LongType())]))])
    df = spark.createDataFrame([('{"a":{"bC":5}}',)], "js string")
    out = json_flatten(df, "js", schema=schema, col_normalize=snake_case_name)
    assert out.columns == ["a_b_c"] and out.first()[0] == 5


def test_infer_schema_is_merged_across_rows(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"b":{"c":"x"}}',)], "js string")
    s = infer_json_schema(df, "js")
    assert s.fieldNames() == ["a", "b"]


def test_map_subset(spark):
    df = spark.range(1).select(F.create_map(F.lit("x"), F.lit(1), F.lit("y"), F.lit(2), F.lit("z"), F.lit(3)).alias("m"))
    assert df.select(map_subset("m", ["z", "x", "nope"])).first()[0] == {"x": 1, "z": 3}
    assert df.select(map_subset("m", [])).first()[0] == {}


def test_select_subset(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select_subset(df, ["c", "a", "zz"]).columns == ["a", "c"]
    assert select_subset(df, []).columns == []


def plain_flatten(data, sep="_", name=None, out=None):
    from dockhand.functions.names import snake_case_name
    out = {} if out is None else out
    for key, value in data.items():
        path = key if name is None else snake_case_name(name) + sep + snake_case_name(key)
        if isinstance(value, dict):
            plain_flatten(value, sep, path, out)
        else:
            out[path] = value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))
    return out


def test_json_flatten_map_equals_a_plain_walk(spark):
    from dockhand.functions.jsonflat import json_flatten_map
    from dockhand.functions.names import snake_case
    docs = [{"userId": 1, "userInfo": {"firstName": "x", "tags": [1, {"a": 2}]}, "e": {}}, {}, {"a_b": 1, "a": {"b": 2}}, {"a": {"b": 2}, "a_b": 1},
            {"a": {"bC": {"dE": {"f": True}}}, "s": '{"not": "an object"}', "n": None, "é'\"k": {"ü.ü": "v"}}, {"z": {"y": {}}, "aB": {"aB": "1"}}]
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)] + [(90, "5"), (91, "{"), (92, None), (93, "[{}]")],
                               "i int, js string")
    got = {r["i"]: r["flat"] for r in json_flatten_map(df, "js", snake_case, keep=["i"]).collect()}
    assert {i: got[i] for i in range(len(docs))} == {i: plain_flatten(d) for i, d in enumerate(docs)}
    assert all(got[i] is None for i in (90, 91, 92, 93))
    deep = spark.createDataFrame([('{"a":{"b":{"c":1}}}',)], "js string")
    assert json_flatten_map(deep, "js", max_depth=3).first()["flat"] == {"a_b_c": "1"}
    for call in (lambda: json_flatten_map(deep, "js", max_depth=2).collect(), lambda: json_flatten_map(df, "js", strict=True).collect()):
        with pytest.raises(Exception, match="deeper than 2|not a JSON object"):
            call()
    plan = json_flatten_map(df, "js")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
