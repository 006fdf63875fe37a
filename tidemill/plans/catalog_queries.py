"""More registered queries of the reference's operators: scans, filters, counterparts, rollups, marks, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import keys
from tidemill.operators import filters, ingest, ranges
from tidemill.operators.history import iso, whole_seconds
from tidemill.plans import reference_queries as R
from tidemill.plans.clocks import with_instants
from tidemill.session import at_hand
from tidemill.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
_ONE, _DAY = R._ONE, R._DAY


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- scans and filters ----------------------------------------------------------------------------


@query(
    f"{_ONE} select distinct uid, source from a where source in (select source from source_clocks where date_order = 'dmy') "
    "and lower(trim(status)) in ('new', 'changed') and duplicate_of is null"
)
def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    a = R._announcements(spark, folder, "source", "status", "duplicate_of").where(F.lower(F.trim("status")).isin("new", "changed") & F.col("duplicate_of").isNull())
    return filters.among(a, "source", table(spark, folder, "source_clocks").where("date_order = 'dmy'").select("source")).select("uid", "source").distinct()


@query(
    f"{_ONE}, m as (select max(try_cast({_DAY} as date)) d from a) select distinct uid, try_cast({_DAY} as date) = d is_last, try_cast({_DAY} as date) as event_day from a, m "
    f"where try_cast({_DAY} as date) >= d - 30"
)
def recent_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last 30 event days; those of the very last are the batch."""
    a = R._announcements(spark, folder, "fetched_at").withColumn("event_day", F.try_to_date(R._day()))
    last = a.agg(F.max("event_day").alias("_d"))  # one row
    return a.join(F.broadcast(last)).where(F.col("event_day") >= F.date_sub("_d", 30)).select("uid", (F.col("event_day") == F.col("_d")).alias("is_last"), "event_day").distinct()


@query()
def fresh_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Which rows of each batch day are fresh: changed, without time of posting, or posted two days before at the earliest, by the instants of problem 4."""
    own = with_instants(table(spark, folder, "announcements"), table(spark, folder, "source_clocks")).where("uid is not null")
    return filters.fresh(own, "status", "post_time_utc", "fetched_at").select("uid", R._day().alias("batch_day"), "fresh").distinct()


_SEED = "2026-05-01"


@query(
    f"{_ONE}, m as (select source, locale, max(fetched_at) hwm from a where fetched_at < '2026-06-01' and category = 'product' group by all) "
    f"select distinct uid from a left join m on a.source is not distinct from m.source and a.locale is not distinct from m.locale where fetched_at > coalesce(hwm, '{_SEED}')"
)
def watermark_scan(spark: SparkSession, folder: str) -> DataFrame:
    """What is later than the watermark of its source and locale, or than the seed where there is none."""
    a = R._announcements(spark, folder, "source", "locale", "category", "fetched_at")
    marks = ingest.watermarks(a.where("fetched_at < '2026-06-01' and category = 'product'"), ["source", "locale"], "fetched_at")
    return filters.newer(a, ["source", "locale"], "fetched_at", marks, _SEED).select("uid").distinct()


_AT = "strftime(date_trunc('second', try_cast(captured_at as timestamptz)) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ')"


def _captured():
    return iso(whole_seconds(F.col("captured_at")))


@query(f"select distinct uid from content_history where uid is not null and {_AT} between '2026-02-01T00:00:00Z' and '2026-03-01T00:00:00Z'")
def captured_between(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "content_history").where(F.col("uid").isNotNull() & _captured().between("2026-02-01T00:00:00Z", "2026-03-01T00:00:00Z")).select("uid").distinct()


@query(
    f"{_ONE} select distinct a.uid, a.source, a.locale, a.article_id from a where uid in (select uid from content_history group by uid having count(*) > 3)"
)
def keyed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Point lookups by key as one semi-join."""
    wanted = table(spark, folder, "content_history").where("uid is not null").groupBy("uid").agg(F.count("*").alias("n")).where("n > 3").select("uid")
    return filters.among(R._announcements(spark, folder, "source", "locale", "article_id"), "uid", wanted)


@query(
    "select uid, source, 'now' as store, fetched_at, '2026-07-01' || substr(fetched_at, 11) shown_at from (select distinct uid, source, fetched_at from announcements) union all "
    "select uid, source, 'snapshots' as store, strftime(delivered_at, '%Y-%m-%dT%H:%M:%SZ') fetched_at, '2026-07-01' || substr(strftime(delivered_at, '%Y-%m-%dT%H:%M:%SZ'), 11) shown_at from (select distinct uid, source, delivered_at from announcement_snapshots)"
)
def combined_stores(spark: SparkSession, folder: str) -> DataFrame:
    """Several stores as one, the date part of their times replaced."""
    now = table(spark, folder, "announcements").select("uid", "source", "fetched_at").distinct().withColumn("store", F.lit("now"))
    old = table(spark, folder, "announcement_snapshots").select("uid", "source", "delivered_at").distinct()
    old = old.select("uid", "source", F.date_format("delivered_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"), F.lit("snapshots").alias("store"))
    return now.unionByName(old).select("uid", "source", "store", "fetched_at", F.concat(F.lit("2026-07-01"), F.expr("substr(fetched_at, 11)")).alias("shown_at"))


# ---- counterparts ---------------------------------------------------------------------------------


@query(
    f"{_ONE}, e as (select distinct group_id, category, uid, locale from a where locale in ('EN', 'EN-Asia') and group_id is not null and category is not null) "
    "select group_id, category, uid, locale from e qualify row_number() over (partition by group_id, category order by case locale when 'EN' then 0 else 1 end, uid) = 1"
)
def group_counterparts(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stands for a group and category: in EN before EN-Asia."""
    a = R._announcements(spark, folder, "group_id", "category", "locale").where("locale in ('EN', 'EN-Asia') and group_id is not null and category is not null")
    best = a.groupBy("group_id", "category").agg(F.min(F.struct((F.col("locale") != "EN").alias("_p"), "uid", "locale")).alias("_b"))
    return best.select("group_id", "category", "_b.uid", "_b.locale")


@query(
    f"{_ONE}, e as (select distinct uid, source, group_id from a where locale = 'EN' and group_id is not null), v as (select source, group_id, max(uid) v from a where locale = 'VN' and group_id is not null group by all) "
    "select e.uid, v.v counterpart from e join v on e.source = v.source and e.group_id = v.group_id"
)
def locale_counterparts(spark: SparkSession, folder: str) -> DataFrame:
    """The VN article of each EN article of the same source and group, the last by uid; without one, no row."""
    a = R._announcements(spark, folder, "source", "group_id", "locale").where("group_id is not null")
    there = a.where("locale = 'VN'").groupBy("source", "group_id").agg(F.max("uid").alias("counterpart"))
    return a.where("locale = 'EN'").join(at_hand(there), ["source", "group_id"]).select("uid", "counterpart")


@query(
    f"{_ONE}, h as (select uid, content_hash, row_number() over (partition by uid order by id desc, coalesce(content_hash, '') desc) r from (select distinct uid, id, content_hash from content_history where uid is not null and id is not null)), "
    "o as (select uid, content_hash old_hash from h where r = 1), p as (select uid, content_hash older_hash from h where r = 2) "
    "select distinct a.uid, content_hash, old_hash, older_hash from a left join o on a.uid = o.uid left join p on a.uid = p.uid where lower(trim(status)) = 'changed'"
)
def changed_with_previous(spark: SparkSession, folder: str) -> DataFrame:
    """A changed row with the last version in its archive and the one before: the two last of each key, without ordering all of a key's versions."""
    a = R._announcements(spark, folder, "status", "content_hash").where(F.lower(F.trim("status")) == "changed").select("uid", "content_hash").distinct()
    h = table(spark, folder, "content_history").where("uid is not null and id is not null").select("uid", "id", "content_hash").distinct()
    two = filters.first_rows(h, ["uid"], [F.desc("id"), F.desc_nulls_last("content_hash")], 2).groupBy("uid").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("content_hash")))["content_hash"].alias("old_hash"), F.max(F.when(F.col("rank") == 2, F.struct("content_hash")))["content_hash"].alias("older_hash")
    )
    return a.join(two, "uid", "left")


# ---- orders, samples, rollups -----------------------------------------------------------------------


@query(
    f"{_ONE}, k as (select distinct source, category, locale from a where source is not null and category is not null and locale is not null) "
    "select *, row_number() over (order by source, category, case locale when 'EN' then 0 else 1 end, locale) - 1 position from k"
)
def ordered_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The batches in the order in which they are worked on: EN first."""
    k = R._announcements(spark, folder, "source", "category", "locale").drop("uid").where("source is not null and category is not null and locale is not null").distinct()
    return ranges.numbered(k.withColumn("_p", (F.col("locale") != "EN").cast("int")), ["source", "category", "_p", "locale"], "position").drop("_p")


@query(
    f"{_ONE}, d as (select distinct uid, source, raw_category, fetched_at from a where fetched_at is not null) "
    "select uid, source, raw_category, fetched_at, row_number() over (partition by source, raw_category order by fetched_at, uid) = 1 is_first from d"
)
def first_of_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a row is the first of its source and section."""
    return filters.first_of(R._announcements(spark, folder, "source", "raw_category", "fetched_at").where("fetched_at is not null"), ["source", "raw_category"], ["fetched_at", "uid"])


@query(
    f"{_ONE}, d as (select distinct uid, coalesce(category, '(none)') category, fetched_at from a where fetched_at is not null) "
    "select uid, category, row_number() over (partition by category order by fetched_at desc, uid) rank from d qualify rank <= 5"
)
def category_samples(spark: SparkSession, folder: str) -> DataFrame:
    a = R._announcements(spark, folder, "category", "fetched_at").where("fetched_at is not null")
    own = a.select("uid", F.coalesce("category", F.lit("(none)")).alias("category"), "fetched_at").distinct()
    return filters.first_rows(own, ["category"], [F.desc("fetched_at"), F.asc("uid")], 5).drop("fetched_at")


@query(
    f"{_ONE}, g as (select group_id, count(distinct locale) n_locales, coalesce(min(fetched_at), '') first_seen from a where group_id is not null group by group_id) "
    "select *, row_number() over (order by n_locales desc, first_seen, group_id) - 1 position from g"
)
def market_order(spark: SparkSession, folder: str) -> DataFrame:
    g = R._announcements(spark, folder, "group_id", "locale", "fetched_at").where("group_id is not null").groupBy("group_id").agg(F.count_distinct("locale").alias("n_locales"), F.coalesce(F.min("fetched_at"), F.lit("")).alias("first_seen"))
    return ranges.numbered(g.withColumn("_d", -F.col("n_locales")), ["_d", "first_seen", "group_id"], "position").drop("_d")


@query(
    f"{_ONE}, k as (select s.source, c.category from (select distinct source from source_clocks) s, (select unnest(['campaign', 'product', 'listing', 'delisting', 'other']) category) c), "
    "d as (select distinct uid, source, category, fetched_at from a where fetched_at is not null), r as (select *, row_number() over (partition by source, category order by fetched_at desc, uid) r from d), "
    "n as (select source, category, string_agg(uid, ',' order by r) newest from r where r <= 3 group by all), "
    "t as (select source, category, count(distinct uid) n_rows, first(title order by fetched_at, uid, title) filter (where title is not null) first_text from a where fetched_at is not null group by all) "
    "select k.source, k.category, coalesce(t.n_rows, 0) n_rows, coalesce(n.newest, '') newest, first_text from k left join t using (source, category) left join n using (source, category)"
)
def section_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Every source and category, also those without rows: count, the three newest, the first title."""
    categories = F.explode(F.array(*[F.lit(c) for c in ("campaign", "product", "listing", "delisting", "other")]))
    wanted = table(spark, folder, "source_clocks").select("source").distinct().select("source", categories.alias("category"))
    a = R._announcements(spark, folder, "source", "category", "fetched_at", "title").where("fetched_at is not null")
    return filters.rolled_up(wanted, a, ["source", "category"], "uid", "fetched_at", "title")


@query(
    f"{_ONE}, d as (select distinct uid, source, lower(trim(status)) s, duplicate_of from a) select source, count(*) total, count(*) filter (where s = 'new') n_new, count(*) filter (where s = 'changed') n_changed, "
    "count(*) filter (where duplicate_of is not null) n_duplicates from d group by source"
)
def chips(spark: SparkSession, folder: str) -> DataFrame:
    d = R._announcements(spark, folder, "source", "status", "duplicate_of").select("uid", "source", F.lower(F.trim("status")).alias("s"), "duplicate_of").distinct()
    return d.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("s") == "new").alias("n_new"), F.count_if(F.col("s") == "changed").alias("n_changed"), F.count_if(F.col("duplicate_of").isNotNull()).alias("n_duplicates"))


@query(f"{_ONE} select coalesce(max({_DAY}), strftime(current_date, '%Y-%m-%d')) as as_of, count(distinct uid) n from a where source <> 'Zoomex'")
def as_of_day(spark: SparkSession, folder: str) -> DataFrame:
    """The last day of any source but the baseline; today where there is none."""
    a = R._announcements(spark, folder, "source", "fetched_at").where("source <> 'Zoomex'")
    return a.agg(F.coalesce(F.max(R._day()), F.date_format(F.current_date(), "yyyy-MM-dd")).alias("as_of"), F.count_distinct("uid").alias("n"))


# ---- state ------------------------------------------------------------------------------------------

_STATES = (
    "with s as (select uid, snapshot_date d, coalesce(content_hash, '') h, coalesce(raw_category, '') r, coalesce(category, '') c from announcement_snapshots where uid is not null "
    "qualify row_number() over (partition by uid, snapshot_date order by delivered_at desc, coalesce(content_hash, '') desc, coalesce(raw_category, '') desc, coalesce(category, '') desc) = 1), "
    "n as (select * from s where d = (select max(d) from s)), o as (select * from s where d = (select min(d) from s)), "
    "x as (select coalesce(o.uid, n.uid) uid, case when o.uid is null then 'new' when n.uid is null then 'absent' when o.h <> n.h then 'changed' when o.r <> n.r then 'moved' else 'unchanged' end as action, "
    "coalesce(n.r, o.r) raw_category, coalesce(o.c, n.c) category, case when o.uid is null or o.h <> n.h then 'pending' else 'pushed' end push_status from n full join o on n.uid = o.uid) "
)


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "announcement_snapshots").where("uid is not null")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    best = F.max(F.struct("delivered_at", text("content_hash"), text("raw_category"), text("category"))).alias("_b")
    states = s.groupBy("uid", "snapshot_date").agg(best).select("uid", "snapshot_date", "_b.*").withColumn("fetched_at", F.col("delivered_at").cast("string"))
    first, last = s.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    current = states.where(F.col("snapshot_date") == first).withColumns({"status": F.lit("new"), "update_time": F.lit(None).cast("string"), "push_status": F.lit("pushed")})
    return ingest.merged(current, states.where(F.col("snapshot_date") == last), "uid", "content_hash", ["raw_category"], [], ["category"], "fetched_at")


@query(_STATES + "select uid, action, raw_category, category, push_status from x")
def merged_state(spark: SparkSession, folder: str) -> DataFrame:
    """The last delivery merged into the state of the first: sections move, the category stays, changes are pending."""
    return _merged(spark, folder).select("uid", "action", "raw_category", "category", "push_status")


@query(_STATES + "select action, count(*) n from x group by action")
def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.run_counts(_merged(spark, folder))


_SAME = ["source", "locale", "title", "content_hash"]
_CLUSTER = "first_value(uid) over (partition by source, locale, title, content_hash order by o, uid)"


@query(
    f"{_ONE}, f as (select distinct uid, source, locale, title, content_hash, coalesce(fetched_at, '') o from a where title <> '' and content_hash <> '' and source <> '' and locale <> ''), "
    f"m as (select distinct uid, c duplicate_of from (select uid, {_CLUSTER} c from f where o < '2026-06-01') where uid <> c), "
    f"u as (select uid, {_CLUSTER} c from f where uid not in (select uid from m)) "
    "select uid, duplicate_of from m union all select distinct uid, c from u where uid <> c"
)
def marks_again(spark: SparkSession, folder: str) -> DataFrame:
    """Marks of the rows before June, then those of the rows that had none, late ones among them."""
    from tidemill.operators.groups import duplicates

    a = R._announcements(spark, folder, *_SAME, "fetched_at")
    order = F.coalesce("fetched_at", F.lit(""))
    marks = duplicates(a.where(order < "2026-06-01"), "uid", _SAME, order)
    return ingest.marked_again(a, "uid", _SAME, order, marks)


@query(
    f"{_ONE}, c as (select *, {_AT} t from content_history where uid is not null), s as (select distinct uid from c where t between '2026-02-01T00:00:00Z' and '2026-03-01T00:00:00Z'), "
    "l as (select uid, count(*) n from c where not coalesce(t between '2026-02-01T00:00:00Z' and '2026-03-01T00:00:00Z', false) group by uid) "
    "select distinct a.uid, case when s.uid is not null and lower(trim(status)) = 'changed' then 'new' else status end status, coalesce(l.n, 0) n_left from a left join s on a.uid = s.uid left join l on a.uid = l.uid"
)
def cleaned_up(spark: SparkSession, folder: str) -> DataFrame:
    """What a clean-up of February's captures leaves."""
    h = table(spark, folder, "content_history").where("uid is not null")
    rows, left = ingest.cleaned(R._announcements(spark, folder, "status"), h, "uid", _captured(), "2026-02-01T00:00:00Z", "2026-03-01T00:00:00Z")
    return rows.join(left.groupBy("uid").agg(F.count("*").alias("n_left")), "uid", "left").select("uid", "status", F.coalesce("n_left", F.lit(0)).alias("n_left")).distinct()


# ---- functions and search ---------------------------------------------------------------------------


@query(
    f"{_ONE}, k as (select distinct source, category, locale, {_DAY} d from a where source is not null and category is not null and locale is not null and fetched_at is not null) "
    "select *, sha256(source || '_' || category || '_' || locale || '_' || d) batch_id, sha256(category) entry_id from k"
)
def batch_ids(spark: SparkSession, folder: str) -> DataFrame:
    k = R._announcements(spark, folder, "source", "category", "locale", "fetched_at").select("source", "category", "locale", R._day().alias("d")).where("source is not null and category is not null and locale is not null and d is not null").distinct()
    return k.withColumns({"batch_id": keys.joined_hash(*[F.col(c) for c in ("source", "category", "locale", "d")]), "entry_id": F.sha2("category", 256)})


_PERIOD = "'活动周期: ' || coalesce(nullif(activity_start_time, ''), '?') || ' ~ ' || coalesce(nullif(activity_end_time, ''), '?')"


@query(
    f"{_ONE}, p as (select distinct uid, {_PERIOD} period from a where activity_start_time <> '' or activity_end_time <> ''), "
    "w as (select *, nullif(nullif(trim(regexp_extract(period, '活动周期: (.*) ~ (.*)$', 1)), '?'), '') s, nullif(nullif(trim(regexp_extract(period, '活动周期: (.*) ~ (.*)$', 2)), '?'), '') e from p) "
    "select uid, period, s starts, e ends, s is not null and e is not null as whole from w"
)
def periods(spark: SparkSession, folder: str) -> DataFrame:
    """Activity times as one text, and that text read again."""
    a = R._announcements(spark, folder, "activity_start_time", "activity_end_time").where("activity_start_time <> '' or activity_end_time <> ''")
    shown = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("?"))
    text = a.select("uid", F.concat(F.lit("活动周期: "), shown("activity_start_time"), F.lit(" ~ "), shown("activity_end_time")).alias("period")).distinct()
    part = lambda n: F.nullif(F.nullif(F.trim(F.regexp_extract("period", "活动周期: (.*) ~ (.*)$", n)), F.lit("?")), F.lit(""))
    return text.select("uid", "period", part(1).alias("starts"), part(2).alias("ends"), (part(1).isNotNull() & part(2).isNotNull()).alias("whole"))


@query(
    f"{_ONE} select distinct uid, try_cast({_DAY} as date) as day, try_cast({_DAY} as date) - 2 as two_before, epoch_ms(try_cast(fetched_at as timestamptz)) ms, "
    "coalesce(try_cast(substr(activity_end_time, 1, 10) as date) < try_cast('2026-06-29' as date) - 30, false) stale, case when length(content) > 200 then substr(content, 1, 199) || '…' else content end short_text from a"
)
def field_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Days, milliseconds, stale entries and shortened texts of rows; what can't be read is null."""
    a = R._announcements(spark, folder, "fetched_at", "activity_end_time", "content")
    day = F.try_to_date(R._day())
    stale = F.coalesce(F.try_to_date(F.substring("activity_end_time", 1, 10)) < F.date_sub(F.lit("2026-06-29").cast("date"), 30), F.lit(False))
    short = F.when(F.length("content") > 200, F.concat(F.substring("content", 1, 199), F.lit("…"))).otherwise(F.col("content"))
    return a.select("uid", day.alias("day"), F.date_sub(day, 2).alias("two_before"), F.unix_millis(F.try_to_timestamp("fetched_at")).alias("ms"), stale.alias("stale"), short.alias("short_text")).distinct()


@query(
    "select event_id, coalesce(least(greatest(try_cast(json_extract_string(props, '$.k') as int), 0), 3), 0) clamped, nullif(json_extract_string(props, '$.name'), '') as name, "
    "len(coalesce(try_cast(json_extract(props, '$.tags') as varchar[]), [])) n_tags from events"
)
def coerced_props(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of JSON text by the type they should have: a bounded number, a text or null, a list or an empty one."""
    own = table(spark, folder, "events").select("event_id", F.try_parse_json("props").alias("v"))
    number = F.least(F.greatest(F.try_variant_get("v", "$.k", "int"), F.lit(0)), F.lit(3))
    tags = F.coalesce(F.try_variant_get("v", "$.tags", "array<string>"), F.array().cast("array<string>"))
    return own.select("event_id", F.coalesce(number, F.lit(0)).alias("clamped"), F.nullif(F.try_variant_get("v", "$.name", "string"), F.lit("")).alias("name"), F.size(tags).cast("long").alias("n_tags"))


@query(
    "with t as (select uid, unnest(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{3,}|[一-鿿]{2,}'))) term from (select distinct uid, title from announcements where title is not null and uid is not null)) "
    "select term, count(*) n from t group by term"
)
def catalog_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Terms by the catalog's own rule: three ASCII letters or digits, or two Chinese characters."""
    a = R._announcements(spark, folder, "title").where("title is not null").distinct()
    found = F.array_distinct(F.regexp_extract_all(F.lower("title"), F.lit("[a-z0-9]{3,}|[一-鿿]{2,}"), F.lit(0)))
    return a.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


_FACETS = "source in ('Weex', 'BingX') and locale in ('VN', 'ID') and lower(title) like '%usdt%'"


@query(
    f"{_ONE}, m as (select max(try_cast({_DAY} as date)) d from a), h as (select distinct uid, source, locale, title, fetched_at from a, m where {_FACETS} and try_cast({_DAY} as date) between d - 90 and d) "
    "select uid, source, locale, (row_number() over (order by fetched_at desc, uid) - 1) // 20 page from h"
)
def faceted_search(spark: SparkSession, folder: str) -> DataFrame:
    """Any of the sources and any of the markets, with a word, of the last 90 days, in pages of 20."""
    a = R._announcements(spark, folder, "source", "locale", "title", "fetched_at").withColumn("_d", F.try_to_date(R._day()))
    last = a.agg(F.max("_d").alias("_last"))  # one row
    hits = a.join(F.broadcast(last)).where(F.col("source").isin("Weex", "BingX") & F.col("locale").isin("VN", "ID") & F.lower("title").contains("usdt") & F.col("_d").between(F.date_sub("_last", 90), F.col("_last")))
    return ranges.chunked(hits.select("uid", "source", "locale", "fetched_at", (-F.unix_seconds(F.try_to_timestamp("fetched_at"))).alias("_o")), ["_o", "uid"], 20).select("uid", "source", "locale", F.col("chunk").alias("page"))


@query(
    f"{_ONE} select group_id, string_agg(distinct locale, ',' order by locale) locales, count(distinct uid) n from a where group_id is not null and locale in ('VN', 'ID') and source in ('Weex', 'BingX') group by group_id"
)
def filtered_markets(spark: SparkSession, folder: str) -> DataFrame:
    """The table of markets under the active filters; a market is a union of locales."""
    a = R._announcements(spark, folder, "group_id", "locale", "source").where("group_id is not null and locale in ('VN', 'ID') and source in ('Weex', 'BingX')")
    return a.groupBy("group_id").agg(F.array_join(F.sort_array(F.collect_set("locale")), ",").alias("locales"), F.count_distinct("uid").alias("n"))  # of a fixed list of locales
