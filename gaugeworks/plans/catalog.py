"""Registry of the engine's queries over the driver tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.config import STOPWORDS
from gaugeworks.functions import html
from gaugeworks.functions import text as t
from gaugeworks.operators import constraints as k
from gaugeworks.operators import layouts as lay
from gaugeworks.operators import matching as m
from gaugeworks.operators import relational as r
from gaugeworks.operators import sequence as q
from gaugeworks.operators import variants as v
from gaugeworks.operators.scoring import cosmo, weakest

QUERIES = {}
ORACLES = {}

STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)
URL_PATTERNS = (("french", (r"/fr/", r"\.org/fr"), True), ("paged", (r"page=\d+", r"ref=x"), True), ("mobile", (r"//m\.",), True))
#: A slug typed by hand in the classification query.
URL_OVERRIDES = {"https://thther.example.org/en/685": ("paged", True)}
#: First words of the part table's names.
PART_FINISHES = ("blue", "cold", "hot", "large", "new", "old", "red", "small")


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokens(stop: bool = True):
    return t.words(F.coalesce("text", F.lit("")), STOPWORDS if stop else ())


def _densities(spark, d, stop: bool = True) -> DataFrame:
    df = _t(spark, d, "documents").select("doc_id", _tokens(stop).alias("w"))
    return df.select("doc_id", F.size("w").cast("long").alias("n_tokens"), t.density(F.col("w")).alias("share"))


_DENSITY = f"""
    with w as (select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z'']+')) as w from documents),
    c as (select doc_id, w, count(*) as n from w where w not in ({STOP_SQL}) group by all),
    d as (select doc_id, sum(n)::bigint as n_tokens, max(n) / sum(n) as share from c group by doc_id),
    a as (select documents.doc_id, coalesce(n_tokens, 0)::bigint as n_tokens, share from documents left join d using (doc_id))
"""


@query(
    """
    with p as (select page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') as t from pages)
    select page_id, length(t)::bigint as chars, len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> ''))::bigint as words,
      len(regexp_extract_all(t, '[0-9]+(?:\\.[0-9]+)?%?'))::bigint as numbers from p
    """
)
def page_text_stats(spark, d):
    """Characters, words and numbers of tag-free pages."""
    p = _t(spark, d, "pages").select("page_id", F.regexp_replace("html", "<[^>]+>", " ").alias("t"))
    words = F.size(F.filter(F.split("t", r"\s+"), lambda x: x != ""))
    return p.select("page_id", F.char_length("t").cast("long").alias("chars"), words.cast("long").alias("words"), t.stat_count(F.col("t"), r"[0-9]+(?:\.[0-9]+)?%?").cast("long").alias("numbers"))


@query(
    """
    select page_id, len(regexp_extract_all(html, '<a[ >]'))::bigint as links, len(regexp_extract_all(html, '<p[ >]'))::bigint as paragraphs,
      len(regexp_extract_all(html, '<li[ >]'))::bigint as items, len(regexp_extract_all(html, '<h1[ >]'))::bigint as h1s,
      regexp_extract(html, '<html lang="([^"]*)"', 1) as lang from pages
    """
)
def page_nodes(spark, d):
    """Element counts and an attribute from the node table."""
    p = _t(spark, d, "pages").select("page_id", html.nodes(F.col("html")).alias("n"))
    count = lambda tag: F.size(html.elements(F.col("n"), tag)).cast("long")
    lang = F.try_element_at(F.get(html.elements(F.col("n"), "html"), F.lit(0))["attrs"], F.lit("lang"))
    return p.select("page_id", count("a").alias("links"), count("p").alias("paragraphs"), count("li").alias("items"), count("h1").alias("h1s"), lang.alias("lang"))


@query(_DENSITY + "select doc_id, n_tokens, round(share, 9) as share from a")
def keyword_density(spark, d):
    """Share of the commonest word, within the row."""
    return _densities(spark, d).select("doc_id", "n_tokens", F.round("share", 9).alias("share"))


@query(_DENSITY + "select doc_id, round(case when share > 0.02 then -15 * least((share - 0.02) / (0.06::double - 0.02::double), 1) else 0 end, 6) as penalty from a")
def stuffing_penalty(spark, d):
    return _densities(spark, d).select("doc_id", F.round(t.stuffing_penalty(F.col("share")), 6).alias("penalty"))


@query("select doc_id, least(len(regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\\.[0-9]+)?')), 5) / 5.0::double * 10 as stats_count from documents")
def stats_score(spark, d):
    n = t.stat_count(F.coalesce("text", F.lit("")), r"[0-9]+(?:\.[0-9]+)?")
    return _t(spark, d, "documents").select("doc_id", t.capped(n, 5, 10.0).alias("stats_count"))


@query("select regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) as host, count(*)::bigint as n from pages group by 1")
def url_netloc(spark, d):
    return _t(spark, d, "pages").groupBy(t.netloc(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query("select page_id, regexp_replace(lower(trim(case when page_id % 2 = 0 then upper(url) else url || '/ ' end)), '/+$', '') as slug from pages")
def slug_normalise(spark, d):
    raw = F.when(F.col("page_id") % 2 == 0, F.upper("url")).otherwise(F.concat("url", F.lit("/ ")))
    return _t(spark, d, "pages").select("page_id", t.normalize_slug(raw).alias("slug"))


@query(
    """
    select p_partkey, trim(regexp_replace(lower(replace(p_name || ' + ' || p_type, '+', ' plus ')), '[^a-z0-9]+', '-', 'g'), '-') as slug,
      left(trim(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-'), 12) as short,
      printf('%02d_%s', p_size, p_name) as file_name, upper(p_name) as heading,
      case when p_size = 1 then '' when p_size % 3 = 0 then ' x' || p_size else ' x' || (p_size - 1) || '-' || p_size end as label
    from part
    """
)
def text_functions(spark, d):
    """Slugs, file names, heading keys and repeat labels."""
    p = _t(spark, d, "part")
    low = F.when((F.col("p_size") % 3 == 0) | (F.col("p_size") == 1), F.col("p_size")).otherwise(F.col("p_size") - 1)
    return p.select(
        "p_partkey",
        t.slug(F.concat_ws(" + ", "p_name", "p_type")).alias("slug"),
        t.section_slug(F.concat_ws(" / ", "p_name", "p_brand"), 12).alias("short"),
        t.file_stem(F.col("p_size"), F.col("p_name")).alias("file_name"),
        t.heading_key(F.col("p_name")).alias("heading"),
        t.repeat_label(low, F.col("p_size")).alias("label"),
    )


@query(
    """
    select page_id,
      case when url = 'https://thther.example.org/en/685' then 'paged' when regexp_matches(lower(url), '/fr/|\\.org/fr') then 'french' when regexp_matches(lower(url), 'page=\\d+|ref=x') then 'paged' when regexp_matches(lower(url), '//m\\.') then 'mobile' else 'informational' end as content_type,
      url = 'https://thther.example.org/en/685' or regexp_matches(lower(url), '/fr/|\\.org/fr|page=\\d+|ref=x|//m\\.') as decision_content,
      case when url = 'https://thther.example.org/en/685' then 'override' when regexp_matches(lower(url), '/fr/') then '/fr/' when regexp_matches(lower(url), '\\.org/fr') then '.org/fr'
        when regexp_matches(lower(url), 'page=\\d+') then regexp_extract(lower(url), '(page=\\d+)', 1) when regexp_matches(lower(url), 'ref=x') then 'ref=x' when regexp_matches(lower(url), '//m\\.') then '//m.' else '' end as matched_on
    from pages
    """
)
def classify_first_match(spark, d):
    """First pattern in list order, an override before all."""
    p = _t(spark, d, "pages").select("page_id", F.col("url").alias("slug"))
    return r.classify(p, patterns=URL_PATTERNS, overrides=URL_OVERRIDES).drop("slug")


@query("select documents.doc_id, quality, case when labels.doc_id is null then 'left_only' else 'both' end as _merge from documents left join labels on documents.doc_id = labels.doc_id")
def left_join_indicator(spark, d):
    labels = _t(spark, d, "labels")
    return r.left_join_indicator(_t(spark, d, "documents").select("doc_id"), labels, "doc_id", ["quality"])


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def unmatched_keys(spark, d):
    return r.unmatched(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id")


@query("select l_orderkey, count(*)::bigint as n from lineitem group by 1 having count(*) > 1")
def duplicate_keys(spark, d):
    return r.duplicate_keys(_t(spark, d, "lineitem"), "l_orderkey")


@query(
    """
    with o as (select o_custkey, arg_max(o_orderstatus, o_orderkey) as status, arg_max(o_totalprice, o_orderkey) as price from orders group by 1)
    select c_custkey, status, price from customer left join o on c_custkey = o_custkey
    """
)
def lookup_last(spark, d):
    """Each customer's last order."""
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return r.lookup_last(_t(spark, d, "customer").select("c_custkey"), o, "c_custkey", "o_orderkey")


@query(
    """
    with n as (select c_custkey, c_mktsegment as g from customer where c_custkey % 3 <> 0),
    o as (select c_custkey, case when c_custkey % 2 = 0 then c_mktsegment else 'moved' end as g, c_name as note, case when c_custkey % 5 = 0 then '' else 'scored' end as status from customer where c_custkey % 4 <> 0)
    select n.c_custkey, n.g, case when n.g = o.g then note else '' end as note, case when n.g = o.g and o.status <> '' then o.status else 'indexed' end as status from n left join o using (c_custkey)
    """
)
def upsert_index(spark, d):
    """Old values stay while the group does."""
    c, key = _t(spark, d, "customer"), F.col("c_custkey")
    new = c.where(key % 3 != 0).select("c_custkey", F.col("c_mktsegment").alias("g"))
    old = c.where(key % 4 != 0).select("c_custkey", F.when(key % 2 == 0, F.col("c_mktsegment")).otherwise("moved").alias("g"), F.col("c_name").alias("note"), F.when(key % 5 == 0, "").otherwise("scored").alias("status"))
    return r.upsert(new, old, "c_custkey", "g", ["note", "status"]).select("c_custkey", "g", F.coalesce("note", F.lit("")).alias("note"), "status")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 40) order by try_cast(left(o_orderpriority, 1) as int), o_orderkey limit 25")
def next_batch(spark, d):
    """The next 25 by priority that aren't done."""
    o = _t(spark, d, "orders").withColumn("p", F.left("o_orderpriority", F.lit(1)))
    done = _t(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return r.next_batch(o, done, "o_orderkey", "p", 25).select("o_orderkey")


_PARTS = """
    with p as (select p_partkey, split_part(p_name, ' ', 2) as base, split_part(p_name, ' ', 1) as colour, p_type, p_size % 3 as size, p_name from part),
    g as (select p_type, base, size, arg_min(colour, p_partkey) as first, count(*)::bigint as members, list_sort(list(p_partkey))[1] as representative from p group by all),
    s as (select *, count(*) over (partition by p_type, base) > 1 as split from g)
"""


def _variants(spark, d) -> DataFrame:
    p = _t(spark, d, "part")
    colour, base = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    name = F.concat(base, F.lit(", "), colour).alias("product_name")
    specs = F.create_map(F.lit("size"), (F.col("p_size") % 3).cast("string")).alias("specs")
    rows = p.select(F.col("p_type").alias("category"), name, "p_partkey", F.lit(0).alias("file_no"), F.col("p_partkey").alias("row_no"), specs)
    return v.variant_groups(rows, colours=PART_FINISHES)


@query(
    _PARTS
    + """
    select p_type as category, base, cast(size as varchar) as size, members, representative,
      base || case when split then '-' || first else '' end as variant_group from s
    """
)
def variant_groups(spark, d):
    """Groups of one category, base name and specs; a base of several specs is told apart by its first member."""
    g = _variants(spark, d)
    return g.groupBy("category", "base", F.col("specs")["size"].alias("size"), "variant_group").agg(F.count(F.lit(1)).alias("members"), F.min("p_partkey").alias("representative"))


@query(_PARTS + ", v as (select p_type, base, size, base || case when split then '-' || first else '' end as variant_group from s) select variant_group, count(*)::bigint as n from v group by 1 having count(*) > 1")
def group_collisions(spark, d):
    return v.collisions(_variants(spark, d))


@query(_DENSITY + "select row_number() over (order by share nulls last, doc_id)::bigint as priority_rank, doc_id, round(round_even(share * 100, 1), 6) as score from a")
def worklist_rank(spark, d):
    """All documents ranked by keyword density: the flagship query."""
    ranked = r.global_rank(_densities(spark, d), F.col("share").asc_nulls_last(), F.col("doc_id"), name="priority_rank")
    return ranked.select("priority_rank", "doc_id", F.round(F.bround(F.col("share") * 100, 1), 6).alias("score"))


@query(
    """
    select s_suppkey, row_number() over (order by n_name not in ('NATION_1', 'NATION_2', 'NATION_3'), s_acctbal::int % 7, s_suppkey % 11 desc, s_name)::bigint as priority
    from supplier join nation on s_nationkey = n_nationkey
    """
)
def priority_rank4(spark, d):
    """Priority names first, then score up, missing down, name."""
    s = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    score = F.expr("cast(rint(s_acctbal) as int) % 7")
    ranked = r.global_rank(s, (~F.col("n_name").isin("NATION_1", "NATION_2", "NATION_3")).asc(), score.asc(), (F.col("s_suppkey") % 11).desc(), F.col("s_name").asc(), name="priority")
    return ranked.select("s_suppkey", "priority")


@query(
    """
    with a as (select p_partkey, p_type, p_size, lag(p_partkey) over w as k, lag(p_type) over w as c, lag(p_size) over w as s from part window w as (order by p_partkey))
    select p_partkey from a where p_type = c and p_partkey - k = 1 and p_size - s = 1
    """
)
def drag_fill(spark, d):
    """Rows one over the row above in two columns."""
    p = _t(spark, d, "part").select("p_partkey", "p_type", "p_size", F.lit(0).alias("file"))
    return q.drag_fill(p, "file", "p_partkey", "p_type", ["p_partkey", "p_size"]).select("p_partkey")


_EVENT_ORDER = "partition by user_id order by ts, event_id"


@query(
    f"""
    with a as (select *, (event_type is distinct from lag(event_type) over ({_EVENT_ORDER}))::int as new from events),
    b as (select *, sum(new) over ({_EVENT_ORDER} rows unbounded preceding) - 1 as run from a)
    select user_id, run::bigint as run, any_value(event_type) as event_type, count(*)::bigint as n, count(*) filter (value > 5)::bigint as high from b group by user_id, run
    """
)
def rle_runs(spark, d):
    e = _t(spark, d, "events").withColumn("high", F.col("value") > 5)
    runs = q.rle(e, ["user_id"], ["ts", "event_id"], "event_type", "high")
    return runs.select("user_id", "run", "event_type", "n", F.size(F.filter("flags", lambda x: x)).cast("long").alias("high"))


_SKELETON = """
    with s as (select conv_id, conv_id % 3 as category, list(role order by turn) as skeleton from conversations group by 1),
    g as (select category, skeleton, count(*)::bigint as n, min(conv_id) as first from s group by all),
    t as (select *, row_number() over (partition by category order by n desc, first) as number from g)
"""


def _templates(spark, d):
    c = _t(spark, d, "conversations").select(F.col("conv_id").alias("variant_group"), F.col("turn").alias("index"), F.col("role").alias("token"), F.lit(True).alias("visible"))
    shapes = lay.skeletons(c).withColumn("category", (F.col("variant_group") % 3).cast("string"))
    return shapes, lay.templates(shapes)


@query(_SKELETON + "select category::varchar as category, array_to_string(skeleton, '>') as skeleton, n, number::int as number, 'T-' || category || '-' || number as template from t")
def template_rank(spark, d):
    """Skeletons of each category, numbered by size."""
    _, named = _templates(spark, d)
    return named.select("category", F.array_join("skeleton", ">").alias("skeleton"), "n", "number", "template")


@query(
    _SKELETON
    + """
    , d as (select 'T-' || b.category || '-' || b.number as template, list_filter(a.skeleton, lambda x: not list_contains(b.skeleton, x)) as miss, list_filter(b.skeleton, lambda x: not list_contains(a.skeleton, x)) as extra
      from t a join t b on a.category = b.category where a.number = 1 and b.number > 1)
    select template, case when len(miss) = 0 and len(extra) = 0 then 'same sections, different order' else concat_ws('; ', case when len(miss) > 0 then 'missing ' || array_to_string(miss, ', ') end, case when len(extra) > 0 then 'extra ' || array_to_string(extra, ', ') end) end as difference from d
    """
)
def skeleton_diff(spark, d):
    _, named = _templates(spark, d)
    return lay.differences(named)


@query(
    _SKELETON
    + """
    , u as (select s.conv_id, 'T-' || s.category || '-' || t.number as template from s join t on s.category = t.category and s.skeleton = t.skeleton),
    r as (select conv_id, turn, role, (role is distinct from lag(role) over (partition by conv_id order by turn))::int as new from conversations),
    x as (select conv_id, role, sum(new) over (partition by conv_id order by turn rows unbounded preceding) as step from r),
    y as (select conv_id, step, any_value(role) as token, count(*) as n from x group by all)
    select template, step::bigint as step, any_value(token) as token, min(n)::bigint as low, max(n)::bigint as high from y join u using (conv_id) group by template, step
    """
)
def template_steps(spark, d):
    shapes, named = _templates(spark, d)
    return lay.template_steps(shapes, named).select("template", "step", "token", "low", "high")


@query(
    """
    with s as (select *, sum((role = 'user')::int) over (partition by conv_id order by turn rows unbounded preceding) as section from conversations)
    select conv_id, section::bigint as section, count(*)::bigint as n, min(turn) as first_turn, max(turn) as last_turn, string_agg(left(text, 10), chr(10) order by turn) as text from s group by conv_id, section
    """
)
def section_rollup(spark, d):
    """A user's turn opens a section; each is rolled up in order."""
    c = q.sectionise(_t(spark, d, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.left("text", F.lit(10)).alias("t")))), lambda x: x.t), "\n")
    return c.groupBy("conv_id", "section").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), text.alias("text"))


@query(
    f"""
    with a as (select event_id, user_id, ts, event_type, case event_type when 'signup' then 1 when 'error' then 0 end as mark from events),
    b as (select *, last_value(mark ignore nulls) over ({_EVENT_ORDER} rows unbounded preceding) as here, last_value(mark ignore nulls) over ({_EVENT_ORDER} rows between unbounded preceding and 1 preceding) as before from a)
    select event_id, coalesce(here, 0) = 1 as inside, coalesce(before, 0) = 1 and event_type = 'view' as faq_q from b
    """
)
def region_state(spark, d):
    """Regions between markers, and the state before a row."""
    e, by, order = _t(spark, d, "events"), ["user_id"], ["ts", "event_id"]
    start, end = F.col("event_type") == "signup", F.col("event_type") == "error"
    df = q.region(q.region(e, by, order, start, end), by, order, start, end, "before", before=True)
    return df.select("event_id", "inside", (F.col("before") & (F.col("event_type") == "view")).alias("faq_q"))


@query(f"select user_id, event_type, arg_min(event_id, ts) as event_id from events group by 1, 2")
def first_occurrence(spark, d):
    return q.first_occurrence(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "event_type", "event_id")


@query("with f as (select user_id, event_type, min(ts) as ts from events group by 1, 2) select user_id, string_agg(event_type, '>' order by ts) as types from f group by 1")
def ordered_distinct(spark, d):
    return q.ordered_distinct(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("user_id", F.array_join("tokens", ">").alias("types"))


_RUNS = f"""
    with a as (select *, (event_type = 'error') as bad, (event_type = 'error') is distinct from lag(event_type = 'error') over ({_EVENT_ORDER}) as new from events),
    b as (select *, sum(new::int) over ({_EVENT_ORDER} rows unbounded preceding) - 1 as run from a)
"""


@query(_RUNS + "select user_id, run::bigint as run, count(*)::bigint as n from b where bad group by user_id, run having count(*) >= 2")
def fail_streaks(spark, d):
    return q.streaks(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").select("user_id", "run", "n")


@query(
    f"""
    with a as (select *, lag(event_type, 1) over ({_EVENT_ORDER}) = 'error' and lag(event_type, 2) over ({_EVENT_ORDER}) = 'error' as trip from events),
    b as (select *, max(coalesce(trip, false)::int) over ({_EVENT_ORDER} rows unbounded preceding) as stopped from a)
    select user_id, count(*)::bigint as n from b where stopped = 0 group by 1
    """
)
def two_strikes(spark, d):
    """What runs before a breaker that two failures in a row trip."""
    ran = q.two_strikes(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return ran.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    with l as (select distinct doc_id, trim(l, chr(32) || chr(9) || chr(13)) as key from (select doc_id, unnest(string_split(text, chr(10))) as l from documents) where l is not null),
    n as (select count(distinct doc_id) as n from documents)
    select key, count(*)::bigint as groups from l, n where key <> '' group by key, n.n having count(*) >= 0.02 * n.n
    """
)
def doc_frequency_fixed(spark, d):
    """Lines that 2 % of all documents have."""
    docs = _t(spark, d, "documents")
    lines = docs.select("doc_id", F.explode_outer(F.split("text", "\n")).alias("l")).select("doc_id", F.nullif(F.btrim("l", F.lit(" \t\r")), F.lit("")).alias("key"))
    return r.share_above(lines, "key", "doc_id", 0.02)


@query("select count(*)::bigint as count, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, min(x) as min, round(quantile_cont(x, 0.25), 6) as p25, round(quantile_cont(x, 0.5), 6) as p50, round(quantile_cont(x, 0.75), 6) as p75, max(x) as max from (select o_totalprice as x from orders)")
def describe_scores(spark, d):
    got = r.describe(_t(spark, d, "orders"), "o_totalprice")
    return got.select("count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


@query("select event_type, count(*)::bigint as n from events group by 1")
def value_counts(spark, d):
    return r.value_counts(_t(spark, d, "events"), "event_type")


@query("with w as (select unnest(['view', 'refund', 'signup', 'share']) as event_type) select w.event_type, count(events.event_type)::bigint as n from w left join events using (event_type) group by 1 having count(events.event_type) < 1")
def gap_types(spark, d):
    return r.gaps(_t(spark, d, "events"), "event_type", ["view", "refund", "signup", "share"])


@query(
    """
    with l as (select doc_id, unnest(string_split(text, chr(10))) as content, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line from documents),
    t as (select unnest([['license', 'license'], ['@', '@'], ['$', '\\$'], ['the', '(?:^|[^a-z0-9_])the(?:$|[^a-z0-9_])'], ['absentterm', 'absentterm']]) as t)
    select t[1] as term, count(*)::bigint as hits, count(distinct doc_id)::bigint as docs from l, t where regexp_matches(lower(content), t[2]) group by 1
    """
)
def regex_scan(spark, d):
    """Deny terms over numbered lines; short ones match whole words."""
    terms = spark.createDataFrame([("license", False), ("@", False), ("$", False), ("the", True), ("absentterm", False)], "term string, whole boolean")
    found = m.term_hits(_t(spark, d, "documents").select("doc_id", "text"), "text", terms)
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("row.doc_id").alias("docs"))


@query("with n as (select distinct p_name as a from part) select x.a as a, y.a as b from n x join n y on x.a <> y.a and (starts_with(x.a, left(y.a, 3)) or starts_with(y.a, left(x.a, 3)))")
def prefix_match(spark, d):
    """Names that share a prefix either way, by equi-joins."""
    n = _t(spark, d, "part").select(F.col("p_name").alias("a")).distinct()
    return m.prefix_pairs(n, n.withColumnRenamed("a", "b"), "a", "b", 3).where("a <> b")


@query("select item_id, doc_id from benchmark join documents on contains(documents.text, benchmark.text)")
def quote_audit(spark, d):
    """Benchmark passages that stand in documents: places by their rarest three words, then the whole passage."""
    return m.contained(_t(spark, d, "benchmark"), _t(spark, d, "documents"), "text", "text", "item_id")


@query("select conv_id, turn, contains(regexp_replace(a.text, '\\s+', ' ', 'g'), trim(regexp_replace(substring(b.text, 3, 20), '\\s+', ' ', 'g'))) as found from conversations b left join (select conv_id, text from conversations where turn = 0) a using (conv_id)")
def quote_of_page(spark, d):
    """Squeezed quotes looked for in their own page."""
    c = _t(spark, d, "conversations")
    pages = c.where("turn = 0").select("conv_id", F.col("text").alias("page"))
    quotes = c.select("conv_id", "turn", F.substring("text", 3, 20).alias("quote"))
    return m.audit_quotes(quotes, pages, "conv_id", "quote", "page").select("conv_id", "turn", "found")


@query("select o_orderkey, case when d <= 365 then 5.0::double when d <= 730 then 2.5 else 0 end as freshness from (select o_orderkey, floor((epoch_us(timestamp '2001-08-02') - epoch_us(o_orderdate)) / 86400000000) as d from orders)")
def freshness_tier(spark, d):
    ts = t.iso_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return _t(spark, d, "orders").select("o_orderkey", t.freshness(t.age_days(ts, F.lit("2001-08-02"))).alias("freshness"))


@query(
    """
    with s as (select p_partkey, unnest([{'r': (p_size % 7) / 7.0::double, 'i': 0, 'n': 'a'}, {'r': (p_partkey % 5) / 4.0::double, 'i': 1, 'n': 'b'}, {'r': (p_size % 3) / 2.0::double, 'i': 2, 'n': 'c'}, {'r': (p_partkey % 9) / 8.0::double, 'i': 3, 'n': 'd'}]) as s from part),
    k as (select p_partkey, s, row_number() over (partition by p_partkey order by s.r, s.i) as k, count(*) filter (s.r < 0.5) over (partition by p_partkey) as low from s)
    select p_partkey, string_agg(s.n, '; ' order by k) as weakest from k where k <= greatest(1, least(3, low)) group by 1
    """
)
def weakest_topk(spark, d):
    p = _t(spark, d, "part")
    scores = {"a": (F.col("p_size") % 7) / 7, "b": (F.col("p_partkey") % 5) / 4, "c": (F.col("p_size") % 3) / 2, "d": (F.col("p_partkey") % 9) / 8}
    return p.select("p_partkey", weakest(scores, dict.fromkeys(scores, 1.0)).alias("weakest"))


@query("select c_custkey, round((c_custkey % 4 + c_custkey // 4 % 4 + c_custkey // 16 % 4 + c_nationkey % 4 + c_nationkey // 4 % 4 + c_custkey // 64 % 4) / 18.0 * 100)::int as score from customer")
def score18(spark, d):
    six = F.expr("array(int(c_custkey % 4), int(c_custkey div 4 % 4), int(c_custkey div 16 % 4), int(c_nationkey % 4), int(c_nationkey div 4 % 4), int(c_custkey div 64 % 4))")
    return _t(spark, d, "customer").select("c_custkey", cosmo(six).alias("score"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props(spark, d):
    """A key of JSON texts by VARIANT functions."""
    return _t(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(
    """
    with p as (select l_partkey, avg(l_quantity) as pos, count(*) as imp, avg(l_discount) as ctr from lineitem group by 1), m as (select median(imp) as i, median(ctr) as c from p)
    select l_partkey, pos between 5 and 20 as striking_distance, imp > i and round(ctr, 9) < round(c, 9) as low_ctr_high_impr from p, m
    """
)
def gsc_signals(spark, d):
    p = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.avg("l_quantity").alias("pos"), F.count(F.lit(1)).alias("imp"), F.round(F.avg("l_discount"), 9).alias("ctr"))
    return r.gsc_signals(p, "pos", "imp", "ctr").select("l_partkey", "striking_distance", "low_ctr_high_impr")


@query(
    """
    with e as (select o_orderkey, unnest([case when o_totalprice > 450000 then 'V1' end, case when o_orderstatus not in ('O', 'F') then 'V2' end, case when extract(year from o_orderdate) = 1995 then 'V3' end]) as rule, o_orderstatus as s from orders)
    select o_orderkey, rule, case rule when 'V1' then 'price' when 'V2' then s else 'year' end as detail from e where rule is not null
    """
)
def constraint_report(spark, d):
    """A row for each rule that fails."""
    o = _t(spark, d, "orders")
    found = k.messages(("V1", F.col("o_totalprice") > 450000, "price"), ("V2", ~F.col("o_orderstatus").isin("O", "F"), F.col("o_orderstatus")), ("V3", F.year("o_orderdate") == 1995, "year"))
    return k.report(o, "o_orderkey", found)


@query(
    """
    with w as (select doc_id, lang as category, lower(left(text, 60)) as h, lower(text) as b from documents)
    select doc_id, 'header' as rule, case category when 'en' then 'the' else 'de' end as detail from w where (category = 'en' and not contains(h, 'the')) or (category = 'fr' and not contains(h, 'de'))
    union all select doc_id, 'body', case category when 'en' then 'the' else 'de' end from w where (category = 'en' and not (contains(b, 'the') or contains(b, 'and'))) or (category = 'fr' and not (contains(b, 'de') or contains(b, 'la')))
    union all select doc_id, 'banned', 'license' from w where contains(b, 'license')
    """
)
def vocab_audit(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.col("lang").alias("category"), F.left("text", F.lit(60)).alias("h"), F.col("text").alias("b"))
    return k.vocabulary_audit(docs, "doc_id", "h", "b", [("en", "the", ["and"]), ("fr", "de", ["la"])], ["license"])


@query(
    """
    with h as (select user_id, list_sort(list(distinct event_type)) as have from events where value > 150 group by 1),
    n as (select user_id, case when user_id % 2 = 0 then ['view', 'purchase'] else ['click', 'error', 'signup'] end as want, have from h)
    select user_id, array_to_string(list_filter(want, lambda x: not list_contains(have, x)), '; ') as missing from n where len(list_filter(want, lambda x: not list_contains(have, x))) > 0
    """
)
def attribute_audit(spark, d):
    e = _t(spark, d, "events").where("value > 150").groupBy("user_id").agg(F.collect_set("event_type").alias("have"))
    rows = e.withColumn("category", F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"))
    got = k.attribute_audit(rows, "user_id", "category", "have", {"even": ["view", "purchase"], "odd": ["click", "error", "signup"]})
    return got.select("user_id", F.array_join("missing", "; ").alias("missing"))


@query(
    """
    with s as (select o_orderkey, ['indexed', 'captured', 'scored', 'brief', ''][(o_orderkey % 5 + 1)::int] as old, o_orderstatus = 'F' as scored, o_orderkey % 7 = 0 as briefed, o_orderkey % 3 as n from orders)
    select o_orderkey, case when briefed then case when n > 0 then 'brief-draft' else 'brief' end when scored and old in ('', 'indexed', 'captured') then 'scored' when not scored and old = 'scored' then 'captured' else old end as status from s
    """
)
def status_lifecycle(spark, d):
    o = _t(spark, d, "orders")
    old = F.get(F.array(*map(F.lit, ("indexed", "captured", "scored", "brief", ""))), (F.col("o_orderkey") % 5).cast("int"))
    return o.select("o_orderkey", r.status_after(old, F.col("o_orderstatus") == "F", F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") % 3).alias("status"))


@query("select l_returnflag, count(*) filter (l_discount > 0.05)::bigint as n, count(distinct l_suppkey)::bigint as suppliers, bool_or(l_tax > 0.07) as any_high, min(l_quantity) as low, max(l_quantity) as high from lineitem group by 1")
def conditional_counts(spark, d):
    li = _t(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") > 0.05).alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.bool_or(F.col("l_tax") > 0.07).alias("any_high"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query(
    """
    with l as (select 'part' as category, p_partkey as id, {'size': p_size::varchar, 'brand': p_brand} as s from part where p_partkey < 1000)
    select 'part' as category, p_partkey as id, 'p_size' as spec, p_size::double as number from part
    union all select 'supplier', s_suppkey, 's_acctbal', s_acctbal from supplier
    union all select 'part', p_partkey, 'p_brand', try_cast(regexp_extract(p_brand, '-?[0-9]+', 0) as double) from part
    """
)
def spec_numbers(spark, d):
    """Tables of different columns as one in long form, and the numbers in them."""
    p = _t(spark, d, "part").select(F.lit("part").alias("category"), F.lit("").alias("product_name"), F.lit("").alias("sku"), F.lit("").alias("url"), F.lit("").alias("source"), F.lit("").alias("last_verified"), F.col("p_partkey").alias("row_no"), F.col("p_size").cast("string"), "p_brand")
    s = _t(spark, d, "supplier").select(F.lit("supplier").alias("category"), F.lit("").alias("product_name"), F.lit("").alias("sku"), F.lit("").alias("url"), F.lit("").alias("source"), F.lit("").alias("last_verified"), F.col("s_suppkey").alias("row_no"), F.col("s_acctbal").cast("string"))
    return v.spec_numbers(v.long_specs([p, s])).select("category", F.col("row_no").alias("id"), "spec", "number")


@query("with c as (select n_regionkey, count(*) as n from nation group by 1) select r_name, n::bigint as n from region join c on r_regionkey = n_regionkey where n >= 5")
def group_members(spark, d):
    """Groups of several members, joined to their names."""
    n = _t(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    return _t(spark, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey")).select("r_name", "n")


@query("select user_id, row_number() over (partition by user_id order by ts, event_id)::bigint - 1 as idx, event_id from events where event_type in ('view', 'click')")
def reindex_rows(spark, d):
    e = _t(spark, d, "events").where(F.col("event_type").isin("view", "click"))
    return q.reindex(e, ["user_id"], ["ts", "event_id"], "idx").select("user_id", "idx", "event_id")


@query("select p_partkey, lower(text) as reply, n from (select p_partkey, p_name as text, length(p_name)::bigint as n from part)")
def strip_fence(spark, d):
    """Replies without their fences."""
    p = _t(spark, d, "part")
    fenced = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("```json\n"), "p_name", F.lit("\n```"))).otherwise(F.concat(F.lit("  "), "p_name", F.lit("\n")))
    return p.select("p_partkey", t.strip_fence(fenced).alias("reply"), F.char_length(t.strip_fence(fenced)).cast("long").alias("n"))
