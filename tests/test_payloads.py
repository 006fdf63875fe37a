import json

from pyspark.sql import functions as F

from tidemill.operators.nested import array_levels, document, exploded, flat_tables, merged_schema, values
from tidemill.plans.payloads import children

SCHEMA = "payload_id long, endpoint string, body string, entity string, _up int"


def run(spark, rows):
    return sorted(tuple(r) for r in children(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)).collect())


BINGX = {"code": 0, "data": {"activityCenterInfoVos": [{"activityId": 7, "tags": [{"id": "1"}, {"id": 2}, {"id": 2}, {"name": "none"}]}, {"title": "no id"}], "tagInfoVos": [{"id": 9}]}}
LBANK = {
    "code": 200,
    "data": {
        "activityId": "5", "timeInfo": {"startTime": 1779904800000}, "attributionTagList": {"id": 11, "tags": [{"id": 12, "tags": {"id": 13, "tags": None}}]},
        "taskInfoList": {"taskId": 21, "attributionTagList": [{"id": 14, "tags": []}], "taskGroupList": [{"groupId": 31, "conditionList": {"conditionId": 41}}, {"conditionList": [{"conditionId": 42}]}]},
    },
}
ZOOMEX = {"result": [{"menu": {"id": 3}, "titles": [{"lang": "en-US", "menuTitle": "News"}, {"lang": "fr-FR", "menuTitle": ""}, {"lang": "vi-VN", "menuTitle": None}]}], "ret_code": 0}


def test_all_entities(spark):
    rows = [(1, "bingx_events_api", json.dumps(BINGX)), (2, "lbank_events_loadingpage", json.dumps(LBANK)), (3, "zoomex_menu", json.dumps(ZOOMEX))]
    assert run(spark, rows) == [
        (1, "activity", "", "7"), (1, "activity_tag", "7", "1"), (1, "activity_tag", "7", "2"),
        (2, "condition", "31", "41"), (2, "event", "", "5"), (2, "event_start", "5", "1779904800000"), (2, "event_tag", "5", "11"),
        (2, "sub_tag", "11", "12"), (2, "sub_tag", "12", "13"), (2, "task", "5", "21"), (2, "task_group", "21", "31"), (2, "task_tag", "21", "14"),
        (3, "menu", "", "3"), (3, "menu_title", "3", "en-US"),
    ]


def test_wrapped_broken_and_odd_bodies(spark):
    body = json.dumps(BINGX)
    rows = [(1, "bingx_events_api", "﻿" + body), (2, "bingx_events_api", json.dumps(body)), (3, "bingx_events_api", body[:60])]
    rows += [(4, "bingx_events_api", b) for b in (None, "", "<html>", "[]", "1", "null", '"text"', '{"code": 500, "data": {"activityCenterInfoVos": [{"activityId": 1}]}}')]
    rows += [(None, "bingx_events_api", body), (5, "other", body), (6, "bingx_events_api", '{"data": {"activityCenterInfoVos": ["a", null, 5, [1]]}}'), (1, "bingx_events_api", "﻿" + body)]
    found = run(spark, rows)
    assert {r[0] for r in found} == {1, 2} and len(found) == 6


def test_empty(spark):
    assert run(spark, []) == []


def test_merged_schema_and_flat_tables(spark):
    bodies = ['{"a": {"list": [{"x": 1, "sub": [1, 2]}, {"x": "two"}]}, "y": true}', '{"a": {"list": {"x": null, "sub": []}}}']
    records = spark.createDataFrame(list(enumerate(bodies)), "id long, body string").select("id", document(F.col("body")).alias("doc"))
    schema = {(r.path, r.kind): r.n for r in merged_schema(records, "doc").collect()}
    assert schema[("a.list", "array")] == 1 and schema[("a.list", "object")] == 3 and schema[("a.list.x", "string")] == 1
    assert sorted((r.level, r._above, r._inner, r.depth) for r in array_levels(merged_schema(records, "doc")).collect()) == [("a.list", "", "$.a.list", 1), ("a.list.sub", "a.list", "$.sub", 2)]
    tables = flat_tables(records, "id", "doc")
    assert sorted((r.id, r._ordinal, r.x) for r in tables["a.list"].collect()) == [(0, 0, "1"), (0, 1, "two"), (1, 0, None)]
    subs = tables["a.list.sub"].collect()
    assert [(r._parent_sk, r._ordinal, r.value) for r in sorted(subs, key=lambda r: r._ordinal)] == [("$.a.list[0]", 0, "1"), ("$.a.list[0]", 1, "2")]


def test_wrapped_any_number_of_times_and_lists_as_text(spark):
    body = json.dumps(BINGX)
    for _ in range(7):
        body = json.dumps(body)
    text = json.dumps({"data": {"activityCenterInfoVos": json.dumps(json.dumps([{"activityId": 8}]))}})
    assert run(spark, [(1, "bingx_events_api", body)]) == [(1, "activity", "", "7"), (1, "activity_tag", "7", "1"), (1, "activity_tag", "7", "2")]
    assert (2, "activity", "", "8") in run(spark, [(1, "bingx_events_api", json.dumps(BINGX)), (2, "bingx_events_api", text)])


def test_levels_of_one_endpoint_are_not_those_of_another(spark):
    rows = [(1, "bingx_events_api", json.dumps(BINGX)), (2, "lbank_events_loadingpage", json.dumps({"data": {"activityId": 1, "activityCenterInfoVos": [{"activityId": 9}]}}))]
    assert [r for r in run(spark, rows) if r[0] == 2] == [(2, "event", "", "1")]


def test_new_levels_and_odd_names_need_no_code(spark):
    bodies = ['{"x.y": [{"a\'b": [1, 2]}], "new": [[1], {"deep": [{"v": 5}]}]}', "[]", "7"]
    records = spark.createDataFrame(list(enumerate(bodies)), "id long, body string").select("id", document(F.col("body")).alias("doc"))
    schema = merged_schema(records, "doc")
    got = {(r.id, r.level, r._parent_sk, r._sk, r.name, r.value) for r in values(exploded(records, "id", "doc"), "id", schema).collect()}
    assert (0, "new.deep", "$.new[1]", "$.new[1].deep[0]", "v", "5") in got
    assert {(r[1], r[5]) for r in got if "x.y" in r[1]} == {("['x.y'][\"a'b\"]", "1"), ("['x.y'][\"a'b\"]", "2")}
    assert (2, "", None, "$", "", "7") in got
