"""The flat rows of the event, activity and menu payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.nested import document, exploded, homes, merged_schema, relative, rows_levels, text_at, values
from tidemill.session import at_hand, saved

ENDPOINTS = ("bingx_events_api", "lbank_events_loadingpage", "zoomex_menu")
#: Which scalar is the id of which entity, and which is its parent's; '' is the payload itself. The levels are the inferred ones.
ENTITIES = [
    ("bingx_events_api", "data.activityCenterInfoVos.activityId", "activity", ""),
    ("bingx_events_api", "data.activityCenterInfoVos.tags.id", "activity_tag", "data.activityCenterInfoVos.activityId"),
    ("lbank_events_loadingpage", "data.activityId", "event", ""),
    ("lbank_events_loadingpage", "data.timeInfo.startTime", "event_start", "data.activityId"),
    ("lbank_events_loadingpage", "data.attributionTagList.id", "event_tag", "data.activityId"),
    ("lbank_events_loadingpage", "data.taskInfoList.taskId", "task", "data.activityId"),
    ("lbank_events_loadingpage", "data.taskInfoList.attributionTagList.id", "task_tag", "data.taskInfoList.taskId"),
    ("lbank_events_loadingpage", "data.taskInfoList.taskGroupList.groupId", "task_group", "data.taskInfoList.taskId"),
    ("lbank_events_loadingpage", "data.taskInfoList.taskGroupList.conditionList.conditionId", "condition", "data.taskInfoList.taskGroupList.groupId"),
    ("zoomex_menu", "result.menu.id", "menu", ""),
    ("zoomex_menu", "result.titles.lang", "menu_title", "result.menu.id"),
]
#: A tag below a tag, at any depth.
SUB_TAG = r"attributionTagList(\.tags)+\.id$"
TITLE = "result.titles.menuTitle"
#: Answers that are no errors.
GOOD_CODES = ("0", "200")


def number(found: Column) -> Column:
    """An id as decimal text; null where it is none."""
    return F.when(found.rlike("^[0-9]+$"), found)


def readable(payloads: DataFrame) -> DataFrame:
    """(_record, payload_id, endpoint, doc): payloads that are valid JSON and no error answers, redelivered ones once; parsed once and written."""
    opened = payloads.where("payload_id is not null and body is not null").where(F.col("endpoint").isin(*ENDPOINTS)).dropDuplicates(["payload_id", "endpoint", "body"])
    opened = opened.select("payload_id", "endpoint", document(F.col("body")).alias("doc"))
    code = F.coalesce(text_at(F.col("doc"), "code"), text_at(F.col("doc"), "ret_code"), F.lit("0"))
    return saved(opened.where(F.col("doc").isNotNull() & code.isin(*GOOD_CODES)).withColumn("_record", F.monotonically_increasing_id()), "payloads")


def _named(schema: DataFrame) -> DataFrame:
    """(_group, path, entity, parent_path, home, up, rel, parent_rel, title_rel): the ids that the records have, with the levels they and their parents' ids lie in."""
    spark = schema.sparkSession
    paths = schema.where("kind in ('string', 'number')").select("_group", "path").distinct()
    given = F.broadcast(spark.createDataFrame(ENTITIES, "_group string, path string, entity string, parent_path string"))
    deep = paths.where((F.col("_group") == ENDPOINTS[1]) & F.col("path").rlike(SUB_TAG)).select("_group", "path", F.lit("sub_tag").alias("entity"), F.regexp_replace("path", r"\.tags\.id$", ".id").alias("parent_path"))
    levels = rows_levels(schema)
    both = homes(homes(paths.join(given, ["_group", "path"]).unionByName(deep), levels, "path"), levels, "parent_path", "up", "home")
    title = F.when(F.col("entity") == "menu_title", relative(F.lit(TITLE), F.col("home")))
    return both.withColumns({"rel": relative(F.col("path"), F.col("home")), "parent_rel": relative(F.col("parent_path"), F.col("up")), "title_rel": title})


def children(payloads: DataFrame) -> DataFrame:
    """(payload_id, entity, parent_id, child_id), distinct: every child with an id under a parent with one.

    Rows are those of `exploded`; a child is joined to its parent's row by record and surrogate key. Nulls, empty lists, unreadable bodies
    and error answers give no rows; payloads of other endpoints are not read; other columns may have any names. An empty table gives no rows.
    """
    docs = readable(payloads)
    schema = saved(merged_schema(docs, "doc", "endpoint"), "schema")
    rows = exploded(docs.withColumn("_id", F.struct("_record", "payload_id")), "_id", "doc", "endpoint", schema)
    named, n = saved(_named(schema), "entities"), schema.count()
    own = at_hand(named.withColumnRenamed("home", "level").withColumnRenamed("path", "_path"), n)
    wanted = F.col("title_rel").isNull() | text_at(F.col("_node"), F.col("title_rel")).isNotNull()
    found = rows.join(own, ["_group", "level"]).where(wanted).select(
        "_id", "entity", "_group", "parent_path", F.get(F.filter("_up", lambda u: u["level"] == F.col("up")), F.lit(0))["sk"].alias("_sk"), text_at(F.col("_node"), F.col("rel")).alias("child_id")
    ).where(F.col("child_id").isNotNull() & ((F.col("entity") == "menu_title") | F.col("child_id").rlike("^[0-9]+$")))
    above = at_hand(named.where("parent_path <> ''").select("_group", F.col("up").alias("level"), "parent_path", "parent_rel").distinct(), n)
    parents = rows.join(above, ["_group", "level"]).select("_id", "_group", "parent_path", "_sk", number(text_at(F.col("_node"), F.col("parent_rel"))).alias("parent_id")).where("parent_id is not null")
    below = found.where("parent_path <> ''").join(parents, ["_id", "_group", "parent_path", "_sk"])
    first = found.where("parent_path = ''").withColumn("parent_id", F.lit(""))
    columns = [F.col("_id.payload_id").alias("payload_id"), "entity", "parent_id", "child_id"]
    return below.select(*columns).unionByName(first.select(*columns)).distinct()


def flat_values(payloads: DataFrame) -> DataFrame:
    """(payload_id, record, level, sk, parent_sk, ordinal, name, value): every scalar of every payload as a flat row with its parent link."""
    docs = readable(payloads)
    schema = saved(merged_schema(docs, "doc", "endpoint"), "schema")
    own = values(exploded(docs.withColumn("_id", F.struct("_record", "payload_id")), "_id", "doc", "endpoint", schema), "_id", schema)
    return own.select("_id.payload_id", F.col("_id._record").alias("record"), "level", F.col("_sk").alias("sk"), F.col("_parent_sk").alias("parent_sk"), F.col("_ordinal").alias("ordinal"), "name", "value")
