"""Registered queries of the reference's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import keys, texts
from tidemill.operators import classify, groups, ingest, ranges, retrieval
from tidemill.plans.clocks import with_instants
from tidemill.session import at_hand
from tidemill.sources.landing import since
from tidemill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
LOCALES = ["EN", "FR", "VN", "ID", "EN-Asia"]

#: The current announcements, redelivered rows once; the batch day of a row.
_ONE = "with a as (select distinct * from announcements where uid is not null)"
_DAY = "substr(fetched_at, 1, 10)"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _announcements(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "announcements").where("uid is not null").select("uid", *columns).distinct()


def _day(column: str = "fetched_at"):
    return F.substring(column, 1, 10)


# ---- keys and texts -----------------------------------------------------------------------------


@query(f"{_ONE} select uid, sha256(source || '_' || locale || '_' || article_id) = uid uid_ok, sha256(coalesce(content, '')) = content_hash hash_ok from a")
def key_check(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "locale", "article_id", "content", "content_hash")
    uid = keys.joined_hash(F.col("source"), F.col("locale"), F.col("article_id"))
    return a.select("uid", (uid == F.col("uid")).alias("uid_ok"), (keys.content_hash(F.col("content")) == F.col("content_hash")).alias("hash_ok"))


_HALF = "('0x' || substr(md5(content_hash), {}, 15))::bigint"


@query(
    f"{_ONE}, h as (select {_DAY} batch_day, source, locale, uid, {_HALF.format(1)} a, {_HALF.format(16)} b from a where content_hash is not null and fetched_at is not null) "
    "select batch_day, source, locale, count(distinct uid) n, bit_xor(a) fingerprint_a, bit_xor(b) fingerprint_b from h group by all"
)
def batch_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """A fingerprint of the set of hashes of each batch that needs no order: nothing is collected."""
    a = _announcements(spark, folder, "source", "locale", "content_hash", "fetched_at").where("content_hash is not null and fetched_at is not null")
    halves = [F.bit_xor(F.conv(F.substring(F.md5("content_hash"), at, 15), 16, 10).cast("long")).alias(f"fingerprint_{n}") for n, at in (("a", 1), ("b", 16))]
    return a.groupBy(_day().alias("batch_day"), "source", "locale").agg(F.count_distinct("uid").alias("n"), *halves)


@query(
    f"{_ONE} select uid, case when t = '' then '(无标题)' else t end title, lower(trim(regexp_replace(coalesce(title, ''), '[ \\t\\r\\n]+', ' ', 'g'))) same_as "
    "from (select *, regexp_replace(regexp_replace(coalesce(title, ''), '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') t from a)"
)
def titles(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "title")
    return a.select("uid", texts.clean_title(F.col("title")).alias("title"), texts.same_title(F.col("title")).alias("same_as"))


@query()
def shown_titles(spark: SparkSession, folder: str) -> DataFrame:
    """As titles, with entities decoded, all blanks and folded case."""
    a = _announcements(spark, folder, "title")
    return a.select("uid", texts.shown_title("title").alias("title"), texts.folded_title("title").alias("same_as"))


@query(f"{_ONE} select uid, nullif(regexp_replace(regexp_extract(url, '/announcements/([^?#]+)', 1), '^/+|/+$', '', 'g'), '') slug from a where url is not null")
def slugs(spark: SparkSession, folder: str) -> DataFrame:
    return _announcements(spark, folder, "url").where("url is not null").select("uid", texts.slug(F.col("url")).alias("slug"))


@query(
    "with m as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '\\$[0-9][0-9,]*(?:\\.[0-9]+)?|[0-9][0-9,]*(?:\\.[0-9]+)? USDT'))) amount from documents) "
    "select amount, count(*) n_docs from m group by all"
)
def money_mentions(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select(F.explode(texts.money(F.col("text"))).alias("amount"))
    return found.groupBy("amount").agg(F.count("*").alias("n_docs"))


@query()
def amount_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """As money_mentions, with all signs and tokens of the reference."""
    found = table(spark, folder, "documents").select(F.explode(texts.amounts(F.col("text"))).alias("amount"))
    return found.groupBy("amount").agg(F.count("*").alias("n_docs"))


@query(
    "select doc_id, len(list_filter(regexp_split_to_array(regexp_replace(text, '([.!?。！？])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), '\\n+'), lambda x: trim(x, ' ') <> '')) n_sentences "
    "from documents where text is not null"
)
def sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.size(texts.sentences(F.col("text"))).cast("long").alias("n_sentences"))


@query("select event_type, cast(json_extract(props, '$.k') as bigint) k, count(*) n, count(distinct user_id) n_users from events group by all")
def event_props(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "events").select("event_type", "user_id", F.from_json("props", "k long")["k"].alias("k"))
    return own.groupBy("event_type", "k").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


# ---- copies and groups --------------------------------------------------------------------------

_SAME = ["source", "locale", "title", "content_hash"]
_DUP = (
    f"{_ONE}, f as (select uid, source, locale, title, content_hash, coalesce(post_time, fetched_at, '') o from a "
    "where title <> '' and content <> '' and content_hash <> '' and source <> '' and locale <> ''), "
    "w as (select uid, first_value(uid) over (partition by source, locale, title, content_hash order by o, uid) f from f) select distinct uid, f duplicate_of from w where uid <> f"
)


@query(_DUP)
def exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, *_SAME, "post_time", "fetched_at", "content").where("content <> ''")
    return groups.duplicates(a, "uid", _SAME, F.coalesce("post_time", "fetched_at", F.lit("")))


@query()
def exact_duplicates_by_instant(spark: SparkSession, folder: str) -> DataFrame:
    """Every uid, with duplicate_of where exact_duplicates has one, but the first of the copies is found by the instant of post_time; one that names none counts as missing."""
    a = with_instants(table(spark, folder, "announcements"), table(spark, folder, "source_clocks")).where("uid is not null")
    found = groups.duplicates(a.where("content <> ''"), "uid", _SAME, F.coalesce("post_time_utc", "fetched_at", F.lit("")))
    return table(spark, folder, "announcements").where("uid is not null").select("uid").distinct().join(found, "uid", "left")


@query(
    f"{_ONE}, p as (select distinct source, raw_category, group_id from a where group_id is not null) "
    "select source, raw_category, group_id, count(*) over (partition by source, raw_category) n from p qualify n > 1"
)
def groups_by_section(spark: SparkSession, folder: str) -> DataFrame:
    return groups.conflicting(_announcements(spark, folder, "source", "raw_category", "group_id"), ["source", "raw_category"], "group_id")


@query(
    f"{_ONE}, g as (select source, group_id, count(distinct locale) n from a where group_id is not null group by all), c as (select source, count(distinct locale) n from source_clocks group by all) "
    "select g.source, group_id, g.n n_locales, c.n n_configured from g join c on g.source = c.source where g.n > 1 and g.n <= c.n"
)
def group_locales(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "group_id", "locale").where("group_id is not null")
    own = a.groupBy("source", "group_id").agg(F.count_distinct("locale").alias("n_locales"))
    configured = table(spark, folder, "source_clocks").groupBy("source").agg(F.count_distinct("locale").alias("n_configured"))
    return own.join(configured, "source").where("n_locales > 1 and n_locales <= n_configured")


@query(
    f"{_ONE}, g as (select group_id, count(distinct locale) = 1 and min(locale) <> 'EN' x from a where group_id is not null group by all) "
    "select distinct uid, coalesce(x, false) exclusive from a left join g on a.group_id = g.group_id"
)
def region_exclusive_rows(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "group_id", "locale")
    flags = groups.region_exclusive(a, "group_id", "locale").where("exclusive")  # the others are false
    return a.join(at_hand(flags), "group_id", "left").select("uid", F.coalesce("exclusive", F.lit(False)).alias("exclusive")).distinct()


@query(
    f"{_ONE}, r as (select *, coalesce(nullif(list_position(['EN', 'FR', 'VN', 'ID', 'EN-Asia'], locale), 0), 6) p from a where group_id is not null) "
    "select source, group_id, count(distinct uid) n_rows, string_agg(distinct locale, ',' order by locale) locales, "
    "first(uid order by p, length(coalesce(content, '')) desc, uid) representative from r group by all"
)
def locale_variants(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "group_id", "locale", "content").where("group_id is not null")
    return groups.variants(a, ["source", "group_id"], "uid", "locale", "content", LOCALES)


@query(
    f"{_ONE}, o as (select uid, coalesce(group_id, uid) g, source, locale, lower(trim(regexp_replace(coalesce(title, ''), '[ \\t\\r\\n]+', ' ', 'g'))) t, coalesce(fetched_at, '') o from a), "
    "f as (select * from o qualify row_number() over (partition by g order by o, uid, source, locale, t) = 1), "
    "l as (select *, first_value(uid) over w lu, first_value(locale) over w ll from f window w as (partition by source, t order by o, uid, locale)) "
    "select uid from l where uid = lu or locale = ll"
)
def counted_once(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "group_id", "source", "locale", "title", "fetched_at")
    return groups.counted_once(a, "uid", "group_id", "source", "locale", texts.same_title(F.col("title")), F.coalesce("fetched_at", F.lit("")))


# ---- batches and views --------------------------------------------------------------------------


@query(
    f"{_ONE} select {_DAY} batch_day, source, category, locale, count(distinct uid) n from a where category is not null and category <> 'other' and fetched_at is not null group by all"
)
def batch_keys(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "category", "locale", "fetched_at").where("category <> 'other' and fetched_at is not null")
    return a.groupBy(_day().alias("batch_day"), "source", "category", "locale").agg(F.count_distinct("uid").alias("n"))


@query(
    f"{_ONE}, s as (select source, category, locale, count(distinct group_id) n, list_sort(list(distinct group_id)) g, {_DAY} batch_day from a where group_id is not null and fetched_at is not null and category is not null and source is not null group by all) "
    "select o.batch_day, o.source, o.category, o.locale, o.n from s o join s e on (o.batch_day, o.source, o.category, o.g) = (e.batch_day, e.source, e.category, e.g) where o.locale <> 'EN' and e.locale = 'EN'"
)
def reusable_batches(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "category", "locale", "group_id", "fetched_at").where("fetched_at is not null and category is not null and source is not null")
    return groups.reusable(a.withColumn("batch_day", _day()), ["batch_day", "source", "category"], "locale", "group_id")


@query(
    f"{_ONE}, n as (select {_DAY} batch_day, category, count(distinct coalesce(group_id, uid)) n from a where category is not null and fetched_at is not null group by all), "
    "d as (select distinct batch_day from n), c as (select distinct category from n) "
    "select d.batch_day, c.category, coalesce(n.n, 0) n from d cross join c left join n on n.batch_day = d.batch_day and n.category = c.category"
)
def daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "category", "group_id", "fetched_at").withColumn("batch_day", _day())
    return groups.daily_trend(a, "batch_day", "category", F.coalesce("group_id", "uid"))


@query(
    f"{_ONE} select group_id, count(distinct locale) n_locales, string_agg(distinct locale, ',' order by locale) locales, bool_or(coalesce(is_region_exclusive, false)) any_exclusive, "
    "first(title order by fetched_at desc, uid desc) title from a where group_id is not null and title is not null and fetched_at is not null group by all"
)
def market_matrix(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "group_id", "locale", "is_region_exclusive", "title", "fetched_at").where("group_id is not null and title is not null and fetched_at is not null")
    return a.groupBy("group_id").agg(
        F.count_distinct("locale").alias("n_locales"),
        F.array_join(F.sort_array(F.collect_set("locale")), ",").alias("locales"),
        F.bool_or(F.coalesce("is_region_exclusive", F.lit(False))).alias("any_exclusive"),
        F.max(F.struct("fetched_at", "uid", "title"))["title"].alias("title"),
    )


@query(
    f"{_ONE}, m as (select max({_DAY}) d from a) select c.source, count(distinct a.uid) total, count(distinct case when {_DAY} = d then a.uid end) today, count(distinct a.uid) > 0 active "
    "from (select distinct source from source_clocks) c left join a on a.source = c.source cross join m group by all"
)
def source_coverage(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "fetched_at").withColumn("_d", _day())
    last = a.agg(F.max("_d").alias("_last"))  # one row
    counts = a.join(F.broadcast(last)).groupBy("source").agg(F.count_distinct("uid").alias("total"), F.count_distinct(F.when(F.col("_d") == F.col("_last"), F.col("uid"))).alias("today"))
    known = table(spark, folder, "source_clocks").select("source").distinct()
    none = F.lit(0)
    return known.join(counts, "source", "left").select("source", F.coalesce("total", none).alias("total"), F.coalesce("today", none).alias("today"), (F.coalesce("total", none) > 0).alias("active"))


@query(
    f"{_ONE}, c as (select category, source, count(distinct uid) n from a where category is not null and source is not null group by all) "
    "select category, n, source leader from c qualify row_number() over (partition by category order by n desc, source desc) = 1"
)
def category_leaders(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "category", "source").where("category is not null and source is not null")
    counts = a.groupBy("category", "source").agg(F.count_distinct("uid").alias("n"))
    best = counts.groupBy("category").agg(F.max(F.struct("n", "source")).alias("_b"))
    return best.select("category", "_b.n", F.col("_b.source").alias("leader"))


@query(
    f"{_ONE}, c as (select coalesce(category, '(none)') category, count(distinct uid) n from a group by all) select category, n, round(100.0 * n / sum(n) over (), 6) percent from c"
)
def category_shares(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "category")
    counts = a.groupBy(F.coalesce("category", F.lit("(none)")).alias("category")).agg(F.count_distinct("uid").alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"))  # one row
    return counts.join(F.broadcast(whole)).select("category", "n", F.round(F.lit(100.0) * F.col("n") / F.col("_all"), 6).alias("percent"))


@query(
    f"{_ONE} select raw_category, count(distinct source) n_sources, count(distinct uid) n_rows, min(fetched_at) first_seen, max(fetched_at) last_seen from a where raw_category is not null group by all"
)
def section_adoption(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "raw_category", "source", "fetched_at").where("raw_category is not null")
    return a.groupBy("raw_category").agg(F.count_distinct("source").alias("n_sources"), F.count_distinct("uid").alias("n_rows"), F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"))


@query(
    f"{_ONE} select uid, source, category, locale, coalesce(nullif(title, ''), '—') title, coalesce(substr(fetched_at, 1, 10), '—') as day, duplicate_of is null as original from a where source is not null and source <> 'Zoomex'"
)
def search_projection(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "category", "locale", "title", "fetched_at", "duplicate_of").where("source <> 'Zoomex'")
    dash = F.lit("—")
    return a.select("uid", "source", "category", "locale", F.coalesce(F.nullif("title", F.lit("")), dash).alias("title"), F.coalesce(_day(), dash).alias("day"), F.col("duplicate_of").isNull().alias("original"))


@query(
    f"{_ONE}, r as (select uid, source, fetched_at, row_number() over (partition by source order by fetched_at desc, uid) r from (select distinct uid, source, fetched_at from a where fetched_at is not null)) "
    "select uid, source, fetched_at from r where r <= 2 order by fetched_at desc, uid limit 5"
)
def highlights(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "fetched_at").where("fetched_at is not null")
    return groups.top_capped(a, [F.desc("fetched_at"), F.asc("uid")], "source", 2, 5)


@query(
    f"{_ONE}, k as (select distinct uid, source, locale, category, sha256('7' || uid) h from a) "
    "select uid, source, locale, category, row_number() over (partition by source, locale, category order by h, uid) - 1 depth from k qualify depth < 2"
)
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "locale", "category")
    return groups.round_robin(a, ["source", "locale", "category"], [F.sha2(F.concat(F.lit("7"), "uid"), 256), F.col("uid")], 2).withColumn("depth", F.col("depth").cast("long"))


@query(f"{_ONE} select uid, cast(floor((row_number() over (order by uid) - 1) / 500) as bigint) chunk from (select distinct uid from a)")
def write_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return ranges.chunked(_announcements(spark, folder), ["uid"], 500)


@query(
    "with t as (select distinct item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]{2,}')) w from eval_items where text is not null), "
    "r as (select distinct uid, unnest(regexp_extract_all(lower(title), '[a-z0-9]{2,}')) w from announcements where title is not null and uid is not null), "
    "s as (select item_id, uid, count(*) score from t join r on t.w = r.w group by all) "
    "select item_id, uid, score, row_number() over (partition by item_id order by score desc, uid) rank from s qualify rank <= 4"
)
def term_recall(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "eval_items").where("text is not null")
    return retrieval.recall(items, "item_id", "text", _announcements(spark, folder, "title"), "uid", "title", 4)


@query()
def telling_term_recall(spark: SparkSession, folder: str) -> DataFrame:
    """As term_recall, with the reference's terms: Chinese ones too, and no stop words."""
    items = table(spark, folder, "eval_items").where("text is not null")
    return retrieval.recall(items, "item_id", "text", _announcements(spark, folder, "title"), "uid", "title", 4, texts.telling_terms)


# ---- deliveries and state -----------------------------------------------------------------------

_CAPTURES = (
    "with c as (select uid, content, id, strftime(date_trunc('second', try_cast(captured_at as timestamptz)) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') t from content_history where uid is not null), "
    "k as (select * from c where t is not null), "
    "f as (select uid, content, t from k qualify row_number() over (partition by uid order by t, id, coalesce(content, '')) = 1), "
    "l as (select uid, content, t from k qualify row_number() over (partition by uid order by t desc, id desc, coalesce(content, '') desc) = 1)"
)


def _first_and_last(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The first captures as current state, the last as a delivery."""
    from tidemill.operators.history import iso, whole_seconds

    own = table(spark, folder, "content_history").where("uid is not null").select("uid", "content", "id", iso(whole_seconds(F.col("captured_at"))).alias("fetched_at")).where("fetched_at is not null")
    row = F.struct("fetched_at", "id", F.coalesce("content", F.lit("")).alias("c"), "content")
    ends = own.groupBy("uid").agg(F.min(row).alias("f"), F.max(row).alias("l"))
    empty = F.lit(None).cast("string")
    current = ends.select(
        "uid", F.col("f.content").alias("content"), keys.content_hash(F.col("f.content")).alias("content_hash"), F.lit("new").alias("status"),
        F.col("f.fetched_at").alias("fetched_at"), empty.alias("update_time"), F.lit("pushed").alias("push_status"),
    )
    return current, ends.select("uid", F.col("l.content").alias("content"), F.col("l.fetched_at").alias("fetched_at"))


@query(
    _CAPTURES + " select f.uid, sha256(coalesce(l.content, '')) content_hash, case when coalesce(f.content, '') <> coalesce(l.content, '') then 'changed' else 'new' end status, f.t fetched_at, "
    "case when coalesce(f.content, '') <> coalesce(l.content, '') then l.t end update_time, case when coalesce(f.content, '') <> coalesce(l.content, '') then 'pending' else 'pushed' end push_status from f join l using (uid)"
)
def upsert_state(spark: SparkSession, folder: str) -> DataFrame:
    current, incoming = _first_and_last(spark, folder)
    return ingest.upsert(current, incoming)[0].drop("content")


@query(_CAPTURES + " select f.uid, sha256(coalesce(f.content, '')) content_hash, f.t captured_at from f join l using (uid) where coalesce(f.content, '') <> coalesce(l.content, '')")
def upsert_archive(spark: SparkSession, folder: str) -> DataFrame:
    current, incoming = _first_and_last(spark, folder)
    return ingest.upsert(current, incoming)[1].drop("content")


@query("select source, locale, max(fetched_at) high_watermark from announcements group by all")
def source_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.watermarks(table(spark, folder, "announcements"), ["source", "locale"], "fetched_at")


@query(
    f"{_ONE}, h as (select uid, max_by(content_hash, id) v from content_history where uid is not null and content_hash is not null group by uid) "
    "select distinct a.uid, h.v is null as unseen from a left join h on h.uid = a.uid where a.content_hash is distinct from h.v"
)
def pending_rows(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "content_hash").withColumnRenamed("content_hash", "version")
    seen = table(spark, folder, "content_history").where("uid is not null and content_hash is not null").groupBy("uid").agg(F.max_by("content_hash", "id").alias("version"))
    pending = ingest.changed_versions(a, seen, "uid", "version").select("uid").distinct()
    return pending.join(seen.select("uid", F.lit(False).alias("_s")), "uid", "left").select("uid", F.col("_s").isNull().alias("unseen"))


_ENDS = (
    "with s as (select uid, snapshot_date d, category, push_status from announcement_snapshots where uid is not null "
    "qualify row_number() over (partition by uid, snapshot_date order by delivered_at desc, coalesce(category, '') desc, coalesce(push_status, '') desc) = 1), "
    "n as (select * from s where d = (select max(d) from s)), o as (select * from s where d = (select min(d) from s)) "
)


@query(
    _ENDS + "select coalesce(n.uid, o.uid) uid, case when o.uid is null then 'create' when n.uid is null then 'delete' "
    "when nullif(n.category, '') is not distinct from nullif(o.category, '') and nullif(n.push_status, '') is not distinct from nullif(o.push_status, '') then 'skip' else 'update' end as action from n full join o on n.uid = o.uid"
)
def sync_actions(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "announcement_snapshots").where("uid is not null")
    best = F.max(F.struct("delivered_at", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("push_status", F.lit("")).alias("push_status")))
    states = s.groupBy("uid", "snapshot_date").agg(best.alias("_b")).select("uid", "snapshot_date", "_b.category", "_b.push_status")
    first, last = s.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    return ingest.sync_actions(states.where(F.col("snapshot_date") == last), states.where(F.col("snapshot_date") == first), "uid", ["category", "push_status"])


@query("select n_versions, count(*) n_keys from (select uid, count(*) n_versions from content_history where uid is not null group by uid) group by all")
def version_histogram(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "content_history").where("uid is not null").groupBy("uid").agg(F.count("*").alias("n_versions"))
    return own.groupBy("n_versions").agg(F.count("*").alias("n_keys"))


@query(
    "select 'status' as rule, count(*) filter (where not (lower(trim(status)) in ('new', 'changed', 'unchanged'))) n from announcements union all "
    "select 'category', count(*) filter (where not (category in ('campaign', 'product', 'listing', 'delisting', 'other'))) from announcements union all "
    "select 'push_status', count(*) filter (where not (push_status in ('pending', 'pushed', 'skipped'))) from announcements union all "
    "select 'uid', count(*) filter (where uid is null or length(uid) <> 64) from announcements"
)
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    rules = {
        "status": ~F.lower(F.trim("status")).isin("new", "changed", "unchanged"),
        "category": ~F.col("category").isin("campaign", "product", "listing", "delisting", "other"),
        "push_status": ~F.col("push_status").isin("pending", "pushed", "skipped"),
        "uid": F.col("uid").isNull() | (F.length("uid") != 64),
    }
    counts = table(spark, folder, "announcements").agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])).alias("_x")).select("_x.rule", "_x.n")


@query("select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) n, count(distinct user_id) n_users, round(sum(value), 4) total from events group by all")
def event_days(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return own.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), F.round(F.sum("value"), 4).alias("total"))


# ---- rules --------------------------------------------------------------------------------------

#: Words of titles by category, in order of precedence.
RULES = {"delisting": ["delist", "delisting", "removed", "removal", "下架"], "listing": ["listing", "listed", "list", "lists", "arrives"], "campaign": ["race", "win", "share"]}
_WORDS = "' ' || regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g') || ' '"
_RULED = (
    f"{_ONE}, d as (select distinct uid, source, raw_category, category, title from a), "
    "n as (select source, raw_category, category, count(*) n from d where source is not null and raw_category is not null and category is not null group by all), "
    "m as (select source, raw_category, category as mapped from n qualify row_number() over (partition by source, raw_category order by n desc, category) = 1), "
    f"w as (select d.*, mapped, {_WORDS} t, lower(coalesce(title, '')) low from d left join m on m.source = d.source and m.raw_category = d.raw_category), "
    "k as (select *, case when t like '% delist %' or t like '% delisting %' or t like '% removed %' or t like '% removal %' or low like '%下架%' then 'delisting' "
    "when t like '% listing %' or t like '% listed %' or t like '% list %' or t like '% lists %' or t like '% arrives %' then 'listing' "
    "when t like '% race %' or t like '% win %' or t like '% share %' then 'campaign' end word from w), "
    "r as (select uid, case when mapped <> 'other' then 'native' when word is not null then 'keyword' when mapped = 'other' then 'native_other' else 'unmapped' end layer, "
    "case when mapped <> 'other' then mapped else coalesce(word, mapped) end found_category from k) "
)


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "source", "raw_category", "category", "title")
    return classify.classified(a, ["source", "raw_category"], "title", classify.usual_mapping(a, ["source", "raw_category"], "category"), RULES)


@query(_RULED + "select uid, layer, found_category from r")
def classified_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder).select("uid", "layer", "found_category")


@query(_RULED + "select layer, count(*) n, round(100.0 * count(*) / sum(count(*)) over (), 6) percent from r group by layer")
def layer_shares(spark: SparkSession, folder: str) -> DataFrame:
    counts = _classified(spark, folder).groupBy("layer").agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"))  # one row
    return counts.join(F.broadcast(whole)).select("layer", "n", F.round(F.lit(100.0) * F.col("n") / F.col("_all"), 6).alias("percent"))


@query(
    "select source, count(*) filter (where coalesce(t >= '2026-01-01', false)) kept, count(*) filter (where not coalesce(t >= '2026-01-01', false)) skipped "
    "from (select source, coalesce(nullif(update_time, ''), nullif(post_time, '')) t from announcements) group by source"
)
def lookback_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = since(table(spark, folder, "announcements"), "update_time", "post_time", "2026-01-01")
    return rows.groupBy("source").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped"))


@query()
def lookback_counts_by_instant(spark: SparkSession, folder: str) -> DataFrame:
    """As lookback_counts, but of the instants that update_time and post_time name; one that names none counts as missing."""
    own = with_instants(table(spark, folder, "announcements"), table(spark, folder, "source_clocks"))
    rows = since(own, "update_time_utc", "post_time_utc", "2026-01-01T00:00:00Z")
    return rows.groupBy("source").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped"))


_SOURCES = ["Bitunix", "Weex", "BingX", "Phemex", "Lbank", "Zoomex"]


@query(f"{_ONE} select category, " + ", ".join(f"count(distinct case when source = '{s}' then uid end) as {s.lower()}" for s in _SOURCES) + " from a where category is not null group by category")
def category_by_source(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "category", "source").where("category is not null")
    wide = a.groupBy("category").pivot("source", _SOURCES).agg(F.count_distinct("uid"))
    return wide.select("category", *[F.coalesce(s, F.lit(0)).alias(s.lower()) for s in _SOURCES])


@query(
    f"{_ONE}, l as (select uid, max(id) last_id, count(*) n_captures from content_history where uid is not null and id is not null group by uid) "
    "select distinct a.uid, last_id, coalesce(n_captures, 0) n_captures from a left join l on l.uid = a.uid where lower(trim(status)) = 'changed'"
)
def changed_with_archive(spark: SparkSession, folder: str) -> DataFrame:
    a = _announcements(spark, folder, "status").where(F.lower(F.trim("status")) == "changed").select("uid").distinct()
    last = table(spark, folder, "content_history").where("id is not null").groupBy("uid").agg(F.max("id").alias("last_id"), F.count("*").alias("n_captures"))
    return a.join(last, "uid", "left").select("uid", "last_id", F.coalesce("n_captures", F.lit(0)).alias("n_captures"))
