"""Queries over pages, score files, briefs and files that are made from the part and customer tables, with their SQL twins.

The driver's pages have no headings below h1, tables or JSON-LD, so pages are built from `part` rows by an expression
that Spark and the twin share; what is read out of them is computed apart on either side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.config import BLOCK_WORDS, EXPECTED_SCHEMA, QUESTION_KEYS, QUESTION_WORDS, STOPWORDS, WEIGHTS
from gaugeworks.functions import html, jsonld
from gaugeworks.functions import text as t
from gaugeworks.operators import capture as cap
from gaugeworks.operators import constraints as k
from gaugeworks.operators import layouts as lay
from gaugeworks.operators import matching as m
from gaugeworks.operators import relational as r
from gaugeworks.operators.scoring import score_pages
from gaugeworks.plans import blog, pdp
from gaugeworks.session import shared_dir
from gaugeworks.sources import fetching, incremental, ordered, readers, sinks, state

QUERIES = {}
ORACLES = {}
AS_OF = "2026-10-15"


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


def _case(of: str, *values: str) -> str:
    return f"case {of} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1])) + f" else '{values[-1]}' end"


_QUESTIONS = _case("p_partkey % 5", "What is it?", "Story so far", "how much does it weigh", "Frequently asked things", "Why not?")
_NOTES = _case("p_partkey % 3", "Is it good", "Notes", "Details?")
_JSON_LD = _case(
    "p_partkey % 6",
    '{"@type": "Article", "dateModified": "2026-09-10T00:00:00Z"}',
    '{"@graph": [{"@type": ["FAQPage", "BreadcrumbList"], "datePublished": "2025-01-15"}, {"@type": "Thing", "dateModified": "2026-10-01"}]}',
    '[{"@type": "Article", "datePublished": "2020-02-02"}, {"@type": "BreadcrumbList"}]',
    "{oops",
    '{"@type": "FAQPage", "dateModified": ""}',
    "",
)
#: A page of a part; every eleventh is missing.  An expression of both engines.
PAGE = f"""
    case when p_partkey % 11 = 0 then null else concat(
      '<!DOCTYPE html><html><head><title>Part ', cast(p_partkey as string), '</title><meta name="description" content="About ', p_name, '"><link rel="canonical" href="https://www.own.example/p/', cast(p_partkey as string), '">',
      case when p_partkey % 6 = 5 then '' else concat('<script type="application/ld+json">', {_JSON_LD}, '</script>') end,
      '</head><body><nav><p>menu</p></nav><h1>Part ', p_name, '</h1><h2>', {_QUESTIONS}, '</h2><p>', trim(repeat(concat(p_name, ' '), cast(p_partkey % 50 as int))), '</p><h3>', {_NOTES}, '</h3>',
      case when p_partkey % 3 = 0 then concat('<table><tr><td>', cast(p_partkey as string), '</td><td>2.5 kg</td></tr></table>') else '' end,
      repeat('<a href="https://x.example/a">x</a>', cast(p_partkey % 5 as int)), '<a href="https://shop.own.example/p">own</a><a href="/rel">r</a>',
      case when p_partkey % 4 = 0 then '<div itemtype="https://schema.org/Product">box 7%</div>' else '' end,
      case when p_partkey % 7 = 0 then '<p>a gift for her</p>' else '' end,
      '<footer>end 2026</footer></body></html>') end"""
_TWIN_PAGE = PAGE.replace("as string", "as varchar")
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_WORDS = ", ".join(f"'{w}'" for w in QUESTION_WORDS)

#: Of each page: its parts, full text and JSON-LD facts.
_PARTS_SQL = f"""
    with page as (select p_partkey as k, p_name, {_TWIN_PAGE} as html, {_QUESTIONS} as q, {_NOTES} as h, nullif(trim(repeat(p_name || ' ', (p_partkey % 50)::int)), '') as para from part),
    txt as (select *, concat_ws(' ', 'Part ' || k, 'menu', 'Part ' || p_name, q, para, h, case when k % 3 = 0 then k || ' 2.5 kg' end, nullif(trim(repeat('x ', (k % 5)::int)), ''), 'own r', case when k % 4 = 0 then 'box 7%' end, case when k % 7 = 0 then 'a gift for her' end, 'end 2026') as txt from page),
    ld as (select *, case k % 6 when 0 then ['Article'] when 1 then ['FAQPage', 'BreadcrumbList', 'Thing'] when 2 then ['Article', 'BreadcrumbList'] when 4 then ['FAQPage'] else [] end as types,
      case k % 6 when 0 then date '2026-09-10' when 1 then date '2025-01-15' when 2 then date '2020-02-02' end as dated,
      list_filter([q, h], lambda x: ends_with(x, '?') or list_contains([{_WORDS}], split_part(lower(x), ' ', 1))) as asked from txt)
"""


def _pages(spark, d) -> DataFrame:
    return _t(spark, d, "part").select("p_partkey", "p_name", F.expr(PAGE).alias("html"))


@query(
    _PARTS_SQL
    + f"""
    , w as (select k, unnest(regexp_extract_all(lower(txt), '[a-z'']+')) as w from txt),
    c as (select k, w, count(*) as n from w where w not in ({_STOP}) group by all),
    d as (select k, max(n) / sum(n) as share from c group by k),
    s as (
      select k, html is not null as ok, q, h,
        case when list_contains(asked, q) and len(string_split(coalesce(para, ''), ' ')) between 15 and 80 then 20.0::double else 0 end as answer_first,
        least(len(asked), 3) / 3.0::double * 10 as question_headings,
        case when k % 3 = 0 then 15.0::double else 0 end as comparison_table,
        case when list_contains(types, 'FAQPage') or contains(lower(q), 'frequently asked') then 15.0::double else 0 end as qa_faq_block,
        least(len(regexp_extract_all(txt, '\\b\\d+(?:\\.\\d+)?%?\\b')), 5) / 5.0::double * 10 as stats_count,
        least(k % 5, 3) / 3.0::double * 5 as citations_count,
        len(list_intersect(types, ['Article', 'FAQPage', 'BreadcrumbList'])) / 3.0::double * 10 as schema_completeness,
        case when date '{AS_OF}' - dated <= 365 then 5.0::double when date '{AS_OF}' - dated <= 730 then 2.5 else 0 end as freshness,
        case when k % 7 = 0 then 10.0::double else 0 end as gifting_persona_language,
        case when share > 0.02 then -15 * least((share - 0.02) / (0.06::double - 0.02::double), 1) else 0 end as keyword_stuffing_penalty
      from ld join d using (k)),
    l as (select *, list_sort([{', '.join(f"{{'r': {n} / {w}::double, 'i': {i}, 'n': '{n}'}}" for i, (n, w) in enumerate(WEIGHTS.items()))}]) as ratios from s),
    x as (select *, list_filter(ratios, lambda x: x.r < 0.5)[1:3] as low from l)
    select k as p_partkey, ok as fetch_ok, {', '.join(f"case when ok then round({n}, 6) end as {n}" for n in WEIGHTS)},
      case when ok then round(keyword_stuffing_penalty, 6) end as keyword_stuffing_penalty,
      case when ok then round(greatest(0, least(100, {' + '.join(WEIGHTS)} + keyword_stuffing_penalty)), 6) end as geo_score,
      case when ok then array_to_string(list_transform(case when len(low) > 0 then low else ratios[1:1] end, lambda x: x.n), '; ') else 'fetch_failed' end as weakest_criteria
    from x
    """
)
def page_scores(spark, d):
    """Ten sub-scores, their sum and the weakest criteria of each page; a missing page has none."""
    scored = score_pages(_pages(spark, d), AS_OF).drop("html", "p_name")
    return scored.select("p_partkey", "fetch_ok", "weakest_criteria", *[F.round(c, 6).alias(c) for c in scored.columns if c not in ("p_partkey", "fetch_ok", "weakest_criteria")])


@query(
    _PARTS_SQL
    + """
    select k as p_partkey, 'Part ' || k as title, 'About ' || p_name as description, 'https://www.own.example/p/' || k as canonical, 'Part ' || p_name as h1,
      array_to_string(list_sort(types), '|') as jsonld_types, case when k % 4 = 0 then 'Product' else '' end as microdata_types,
      left(concat_ws(' ', 'Part ' || k, 'Part ' || p_name, q, para, h, case when k % 3 = 0 then k || ' 2.5 kg' end, nullif(trim(repeat('x ', (k % 5)::int)), ''), 'own r', case when k % 4 = 0 then 'box 7%' end, case when k % 7 = 0 then 'a gift for her' end), 400) as shown,
      (k % 5 + 2)::bigint as links, len(asked)::bigint as questions, case k % 6 when 0 then '2026-09-10T00:00:00Z' when 1 then '2025-01-15' when 2 then '2020-02-02' end as dated
    from ld where html is not null
    """
)
def page_facts(spark, d):
    """Title, description, canonical, H1, types, visible text and the first date of each page."""
    p = _pages(spark, d).where("html is not null").select("p_partkey", html.nodes(F.col("html")).alias("n"))
    n = F.col("n")
    p = p.withColumn("ld", jsonld.entries(html.json_ld(n)))
    return p.select(
        "p_partkey",
        html.first_text(n, "title").alias("title"),
        html.meta(n, "description").alias("description"),
        html.canonical(n).alias("canonical"),
        html.first_text(n, "h1").alias("h1"),
        F.array_join(F.sort_array(jsonld.types(F.col("ld"))), "|").alias("jsonld_types"),
        F.array_join(html.microdata_types(n), "|").alias("microdata_types"),
        html.visible_text(n, limit=400).alias("shown"),
        F.size(html.hrefs(n)).cast("long").alias("links"),
        F.size(html.question_headings(n)).cast("long").alias("questions"),
        jsonld.first_date(F.col("ld")).alias("dated"),
    )


@query(
    _PARTS_SQL
    + """
    , b as (select k, list_filter(list_concat([{'g': 'h1', 'x': 'Part ' || p_name}, {'g': 'h2', 'x': q}, {'g': 'p', 'x': para}, {'g': 'h3', 'x': h}],
      case when k % 3 = 0 then [{'g': 'td', 'x': k::varchar}, {'g': 'td', 'x': '2.5 kg'}] else [] end,
      case when k % 4 = 0 then [{'g': 'div', 'x': 'box 7%'}] else [] end, case when k % 7 = 0 then [{'g': 'p', 'x': 'a gift for her'}] else [] end), lambda x: x.x is not null) as b from page where html is not null)
    select k as p_partkey, i::bigint as seq, b[i + 1].g as tag, starts_with(b[i + 1].g, 'h') as heading, b[i + 1].x as text from (select k, b, unnest(range(0, len(b))) as i from b)
    """
)
def page_blocks(spark, d):
    """Block rows of each page in document order, navigation and footer left out."""
    p = _pages(spark, d).where("html is not null").select("p_partkey", F.posexplode(html.blocks(F.col("html"))).alias("seq", "b"))
    return p.select("p_partkey", F.col("seq").cast("long").alias("seq"), "b.tag", "b.heading", "b.text")


_SIX = [f'"{q}"' for q in QUESTION_KEYS]
_ANSWER = '{"score": 2, "evidence": [{"quote": "quiet  motor"}], "gap": "more", "missing_attributes": ["a", "b"]}'


def _score_json(**other: str) -> str:
    return "{" + ", ".join(f'"{q}": {other.get(q, _ANSWER)}' for q in QUESTION_KEYS if other.get(q, "") is not None) + "}"


#: Questions of score files by c_custkey % 18; their rules are in _SCORE_RULES.
_SCORE_FILES = (
    _score_json(isA=_ANSWER.replace("2,", "3,", 1)),
    _score_json(),
    _score_json(),
    _score_json(),
    _score_json(),
    _score_json(cause_benefit=None),
    _score_json(isA=_ANSWER.replace("2,", "7,", 1)),
    _score_json(used_for_audience='{"score": 2, "evidence": "quiet motor", "gap": ""}'),
    _score_json(used_for_event='{"score": 1, "evidence": [], "gap": "g"}'),
    _score_json(used_for_event='{"score": 1, "evidence": [{"quote": "  "}], "gap": "g"}'),
    _score_json(used_for_function='{"score": 0, "evidence": [{"quote": "not there"}], "gap": "g"}'),
    _score_json(cause_benefit='{"score": 2, "evidence": [{"quote": "motor"}], "gap": " "}'),
    _score_json(capable_of='{"score": 3, "evidence": [{"quote": "quiet motor"}]}'),
    _score_json(isA='{"score": 0, "gap": "g"}'),
    _score_json(used_for_event='{"score": 1, "gap": "g"}'),
    _score_json(isA='{"score": true, "evidence": [{"quote": "says"}], "gap": "g"}'),
    _score_json(),
)
_SCORE_RULES = ("", "V1", "V2,V3", "V3", "V4", "V5,V6", "V6", "V7", "V8", "V9", "V10", "V11", "V12", "", "V8", "", "V2")
_SCORE_TOTALS = {0: 13, 13: 10, 15: 11}


def _groups(spark, d) -> tuple[DataFrame, DataFrame]:
    """Groups (3 mod 17 is unknown) and pages (4 mod 17 isn't captured) of customers."""
    c = _t(spark, d, "customer").withColumn("variant_group", F.concat(F.lit("g"), F.col("c_custkey")))
    sections = c.where("c_custkey % 17 <> 4").select("variant_group", F.col("c_name").alias("h1"), F.explode(F.array(*[F.struct(F.lit(i).alias("index"), F.lit(h).alias("heading"), F.lit(x).alias("text")) for i, h, x in ((0, "Top", "it says "), (1, "Care", "quiet\n motor"))])).alias("s")).select("variant_group", "h1", "s.*")
    return c.where("c_custkey % 17 <> 3").select("variant_group", F.col("c_mktsegment").alias("category"), F.col("c_custkey").cast("string").alias("priority")), pdp.page_texts(sections)


def _score_rows(spark, d) -> DataFrame:
    """Checked score files, one for each customer: faults by the key modulo 17."""
    c = _t(spark, d, "customer").withColumn("f", (F.col("c_custkey") % 17).cast("int"))
    own = F.concat(F.lit("g"), F.col("c_custkey"))
    named = F.when(F.col("f") == 2, F.concat(F.lit("x"), F.col("c_custkey"))).when(F.col("f") == 16, F.concat(F.lit("g"), F.col("c_custkey") - 1)).otherwise(own)
    body = F.get(F.array(*map(F.lit, _SCORE_FILES)), F.col("f"))
    raw = F.when(F.col("f") == 1, F.lit('{"variant_group": "g')).otherwise(F.concat(F.lit('{"variant_group": "'), named, F.lit('", "questions": '), body, F.lit("}")))
    files = readers.parse_json(c.select("c_custkey", own.alias("file"), raw.alias("raw")), "raw", k.SCORE_SCHEMA)
    groups, pages = _groups(spark, d)
    return pdp.check_scores(files, groups, pages)


@query(
    f"""
    with c as (select c_custkey, (c_custkey % 17)::int as f from customer)
    select c_custkey, [{', '.join(f"'{x}'" for x in _SCORE_RULES)}][f + 1] as rules,
      case f {' '.join(f"when {f} then round({n} / 18.0 * 100)::int" for f, n in _SCORE_TOTALS.items())} end as cosmo_score,
      case f {' '.join(f"when {f} then 2" for f in _SCORE_TOTALS)} end::bigint as missing from c
    """
)
def score_file_rules(spark, d):
    """Rules that each score file breaks, and the scores of those that break none."""
    rules = F.array_join(F.sort_array(F.array_distinct(F.transform("errors", lambda e: e.rule))), ",")
    return _score_rows(spark, d).select("c_custkey", rules.alias("rules"), "cosmo_score", F.col("missing").cast("long").alias("missing"))


@query("with c as (select c_custkey % 17 as f from customer) select count(*) filter (f in (0, 13, 15))::bigint as valid, count(*) filter (f not in (0, 13, 15))::bigint as invalid, (count(*) filter (f <> 3) - count(*))::bigint as not_scored from c")
def score_run_counts(spark, d):
    """Valid and invalid score files, and groups without one."""
    return pdp.score_counts(_score_rows(spark, d), _groups(spark, d)[0])


@query(
    """
    with s as (select c_custkey, c_mktsegment as category, case c_custkey % 17 when 0 then 72 when 13 then 56 else 61 end as score from customer where c_custkey % 17 in (0, 13, 15)),
    p as (select c_custkey, score, row_number() over (order by category <> 'BUILDING', score, 'g' || c_custkey) as priority from s)
    select c_custkey, coalesce(score::varchar, '') as cosmo_score, coalesce(priority::varchar, '') as priority,
      case when score is not null then case when c_custkey % 3 = 2 then 'brief' else 'scored' end when c_custkey % 3 = 0 then 'captured' when c_custkey % 3 = 1 then 'captured' else 'brief' end as status
    from customer left join p using (c_custkey) where c_custkey % 17 <> 3
    """
)
def score_ranks(spark, d):
    """Scores, ranks and statuses on the index; a group without a score loses its own."""
    index = _groups(spark, d)[0].withColumns({"c_custkey": F.expr("cast(substring(variant_group, 2) as bigint)"), "status": F.expr("case cast(substring(variant_group, 2) as bigint) % 3 when 0 then 'captured' when 1 then 'scored' else 'brief' end")})
    ranked = pdp.rank_scores(_score_rows(spark, d).where("cosmo_score is not null").select(F.col("file").alias("variant_group"), "category", "cosmo_score", "missing"), ["BUILDING"])
    return pdp.apply_scores(index.drop("priority"), ranked).select("c_custkey", "cosmo_score", "priority", "status")


_BRIEF = {
    "variant_group": '"@"',
    "product_name": '"P @"',
    "for_client_editor": '[{"ask": "a", "if_confirmed": "b", "if_not": "c"}]',
    "for_owner": '["x"]',
    "edits": '[{"where": "top", "action": "replace", "current": "quiet motor", "new": "silent motor", "why": "w", "questions": ["isA"]}]',
    "gifting_bullet": '{"where": "w", "text": "t"}',
    "target_scores": "{" + ", ".join(f"{q}: 3" for q in _SIX) + "}",
}


def _brief(edit: tuple[str, str] | None = None, **other: str | None) -> str:
    parts = _BRIEF | other
    if edit:
        assert edit[0] in parts["edits"]
        parts["edits"] = parts["edits"].replace(*edit)
    return "{" + ", ".join(f'"{n}": {v}' for n, v in parts.items() if v is not None) + "}"


#: Briefs and the rules that they break, by c_custkey % 20; 17 isn't in the index, 18 not captured, 19 not scored.
_BRIEFS = (
    (_brief(), ""),
    (_brief(variant_group='"other"'), "B1"),
    (_brief(edits="[]"), "B2"),
    (_brief(("replace", "move")), "B3"),
    (_brief(('"top"', '" "')), "B4"),
    (_brief(('"quiet motor"', '""')), "B5"),
    (_brief(('"quiet motor"', '"loud motor"')), "B6"),
    (_brief(('"silent motor"', '" "')), "B7"),
    (_brief(('"w"', '""')), "B8"),
    (_brief(('["isA"]', '["isA", "other"]')), "B9"),
    (_brief(warnings='["w"]'), "B10"),
    (_brief(for_client_editor='[{"ask": "a", "if_confirmed": "", "if_not": "c"}, {"ask": " "}]'), "B11,B11,B11,B11"),
    (_brief(for_owner='{"a": 1}'), "B12"),
    (_brief(gifting_bullet='{"where": "w", "text": ""}'), "B13"),
    (_brief(target_scores='{"isA": 3}'), "B14"),
    (_brief(('["isA"]', "[]")), ""),
    (_brief(for_owner=None), ""),
    (_brief(), "B0"),
    (_brief(), "B0,B6"),
    (_brief(), "B0"),
)
_CARD = "".join(f"\n| {q} | 2 | 3 |" for q in QUESTION_KEYS)


def _checked_briefs(spark, d) -> DataFrame:
    c = _t(spark, d, "customer").withColumns({"f": (F.col("c_custkey") % 20).cast("int"), "file": F.concat(F.lit("c"), F.col("c_custkey"))})
    raw = F.replace(F.get(F.array(*[F.lit(b) for b, _ in _BRIEFS]), F.col("f")), F.lit("@"), F.col("file"))
    files = readers.parse_json(c.select("c_custkey", "file", raw.alias("raw")), "raw", k.BRIEF_SCHEMA)
    groups = c.where("f <> 17").select(F.col("file").alias("variant_group"), F.col("c_mktsegment").alias("category"), F.col("c_custkey").cast("string").alias("priority"))
    pages = c.where("f <> 18").select(F.col("file").alias("variant_group"), F.lit("a  quiet\nmotor").alias("page"))
    scores = readers.parse_json(c.where("f <> 19").select("file", F.lit(67).alias("cosmo_score"), F.lit('{"questions": ' + _score_json() + "}").alias("raw")), "raw", k.SCORE_SCHEMA).select("file", "cosmo_score", "questions")
    return pdp.check_briefs(files, groups, pages, scores)


@query(f"select c_custkey, [{', '.join(f"'{x}'" for _, x in _BRIEFS)}][(c_custkey % 20 + 1)::int] as rules from customer")
def brief_file_rules(spark, d):
    """Rules that each brief breaks, with its index row, page and score."""
    rules = F.array_join(F.sort_array(F.transform("errors", lambda e: e.rule)), ",")
    return _checked_briefs(spark, d).select("c_custkey", rules.alias("rules"))


@query(
    f"""
    select c_custkey, printf('%02d_c%d', c_custkey, c_custkey) as file_name, case when c_custkey % 20 = 16 then null else 'brief-draft' end as status,
      '# P c' || c_custkey || '\n\nScore: 67 -> 100\n\n| question | now | target |\n|---|---|---|{_CARD}\n\n## For the editor\n- a\n  - if so: b\n  - if not: c\n\n## For the owner\n- x\n\n## Edits\n### 1. Replace: top\nNow: quiet motor\nNew: silent motor\nWhy: w\n\n## Gifting\nw: t' as brief
    from customer where c_custkey % 20 in (0, 15)
    """
)
def brief_texts(spark, d):
    """Valid briefs as Markdown, their file names and the status that they give."""
    good = _checked_briefs(spark, d).where("size(errors) = 0 and for_owner is not null")
    index = good.select("c_custkey", "priority", F.col("file").alias("variant_group"), F.lit("scored").alias("status"))
    status = pdp.brief_status(index, good).select("c_custkey", "status")
    named = pdp.file_names(good.select("c_custkey", "priority", F.col("file").alias("variant_group"), pdp.brief_markdown().alias("brief")))
    return named.join(status, "c_custkey").select("c_custkey", "file_name", "status", "brief")


_REPLY = """
    concat('{"warnings": [', case when p_partkey % 5 = 0 then '"own"' else '' end, '], "proposed_meta_title": "', repeat('t', cast(50 + p_partkey % 20 as int)), '", "proposed_meta_description": "', repeat('d', cast(150 + p_partkey % 10 as int)),
      '", "comparison_table": {"caption": "c", "headers": ["a", "b", "c", "d"', repeat(', "e"', cast(p_partkey % 3 as int)), '], "rows": [["1"]', repeat(', ["2"]', cast(3 + p_partkey % 4 as int)), ']}, "fanout_answers": [{"fan_out": "f"}', repeat(', {"fan_out": "g"}', cast(p_partkey % 6 as int)), ']}')
"""


def _replies(spark, d) -> DataFrame:
    p = _t(spark, d, "part")
    text = F.when(F.col("p_partkey") % 13 == 0, F.lit("no JSON")).when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("```json\n"), F.expr(_REPLY), F.lit("\n```"))).otherwise(F.expr(_REPLY))
    intent = F.expr("case p_partkey % 3 when 0 then 'Informational ' when 1 then 'commercial' end")
    return blog.payloads(p.select("p_partkey", text.alias("reply"), F.when(F.col("p_partkey") % 2 == 0, F.lit("YES")).alias("refocus"), intent.alias("focus_intent")))


@query(
    """
    select k as p_partkey, k % 13 <> 0 as parsed, array_to_string(list_filter([
      case when parsed and k % 5 = 0 then 'own' end,
      case when parsed and k % 20 > 10 then 'Meta title is ' || (50 + k % 20) || ' characters (max 60); shorten before publishing.' end,
      case when parsed and k % 10 > 5 then 'Meta description is ' || (150 + k % 10) || ' characters (max 155); shorten before publishing.' end,
      case when parsed and k % 3 = 2 then 'Comparison table has 6 columns (max 5).' end,
      case when parsed and k % 4 > 1 then 'Comparison table has ' || (4 + k % 4) || ' rows (max 5).' end,
      case when k % 2 = 0 and k % 3 > 0 then 'Refocus intent is not informational.' end,
      case when k % 2 = 0 and (not parsed or k % 6 < 3) then 'Refocus has ' || case when parsed then k % 6 + 1 else 0 end || ' fan-out answers (min 4).' end], lambda x: x is not null), '|') as warnings
    from (select p_partkey as k, p_partkey % 13 <> 0 as parsed from part)
    """
)
def reply_rules(spark, d):
    """Warnings of model replies: their own, lengths, table sizes, and those of refocused pages."""
    return _replies(spark, d).select("p_partkey", "parsed", F.array_join("warnings", "|").alias("warnings"))


@query("select count(*)::bigint as kept, (select count(*) from part where p_partkey % 13 = 0)::bigint as set_apart from part where p_partkey % 13 <> 0")
def reply_quarantine(spark, d):
    """Replies that can't be read are written apart."""
    folder = _folder(spark)
    kept = sinks.quarantine(_replies(spark, d).select("p_partkey", "reply", "parsed"), F.col("parsed"), folder)
    return kept.agg(F.count(F.lit(1)).alias("kept")).crossJoin(spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("set_apart")))


def _bank(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bank, inventory and search rows of customers, with slugs spelt in several ways."""
    c = _t(spark, d, "customer").withColumn("slug", F.concat(F.lit("post-"), F.col("c_custkey")))
    bank = c.select(F.when(F.col("c_custkey") % 2 == 0, F.upper("slug")).otherwise(F.concat("slug", F.lit("/ "))).alias("slug"), F.concat(F.lit("https://www.own.example/"), "slug").alias("url"), F.col("c_mktsegment").alias("category"))
    inventory = c.select(F.concat(F.lit(" "), "slug").alias("Slug"), F.col("c_nationkey").cast("long").alias("Unique Inlinks"), F.concat(F.lit("Best of "), F.col("c_name")).alias("Title 1"))
    gsc = c.where("c_custkey % 4 = 0").select(F.upper(F.concat(F.lit("https://www.own.example/"), "slug", F.lit("/"))).alias("Top pages"), (F.col("c_custkey") % 97).cast("long").alias("Impressions"), F.concat((F.col("c_custkey") % 7).cast("string"), F.lit("%")).alias("CTR"), (F.col("c_custkey") % 30).cast("double").alias("Position"))
    return bank, inventory, gsc


@query(
    """
    with g as (select c_custkey, c_custkey % 97 as i, c_custkey % 7 as c, c_custkey % 30 as p from customer where c_custkey % 4 = 0), m as (select median(i) as mi, median(c) as mc from g)
    select case when c_custkey % 2 = 0 then 'POST-' || c_custkey else 'post-' || c_custkey || '/ ' end as slug, c_mktsegment as category, c_nationkey::bigint as unique_inlinks, g.i is not null as gsc_joined,
      p between 5 and 20 as striking_distance, i > mi and c < mc as low_ctr_high_impr
    from customer left join g using (c_custkey), m
    """
)
def post_ingest(spark, d):
    """Bank and inventory joined on the normalised slug behind its gate, with search signals."""
    bank, inventory, gsc = _bank(spark, d)
    return blog.ingest(bank, inventory, gsc).select("slug", "category", "unique_inlinks", "gsc_joined", "striking_distance", "low_ctr_high_impr")


_SLUGS = ("x-vs-y", "how-we-compare", "best-fan", "multi-purpose-fabric-steamer-guide", "Ecommerce-Beginners-Guide-How-to-use-a-steamer", "compact-fabric-steamer-for-trips", "gift-box", "fans-under-$50", "cheap-fans", "bestow-it", "story", "choosing-a-gift")
_KINDS = (("comparison_vs", True, "vs"), ("comparison_vs", True, "compare"), ("buying_guide", True, "best"), ("buying_guide", True, "override"), ("informational", False, "override"), ("buying_guide", True, "override"), ("gift_guide", True, "gift"), ("price_bracket", True, "under-$50"), ("price_bracket", True, "cheap"), ("informational", False, ""), ("informational", False, ""), ("buying_guide", True, "choosing"))


@query(
    f"""
    with s as (select c_custkey, [{', '.join(f"'{x}'" for x in _SLUGS)}][(c_custkey % {len(_SLUGS)} + 1)::int] as slug, (c_custkey % {len(_SLUGS)} + 1)::int as i from customer)
    select c_custkey, slug, [{', '.join(f"'{x}'" for x, _, _ in _KINDS)}][i] as content_type, [{', '.join(str(y).lower() for _, y, _ in _KINDS)}][i] as decision_content, [{', '.join(f"'{z}'" for _, _, z in _KINDS)}][i] as matched_on from s
    """
)
def post_types(spark, d):
    """Content types by the default patterns and the slugs typed by hand."""
    slug = F.get(F.array(*map(F.lit, _SLUGS)), (F.col("c_custkey") % len(_SLUGS)).cast("int"))
    return blog.classify(_t(spark, d, "customer").select("c_custkey", slug.alias("slug")))


_POSTS = "select p_partkey, 'post-' || p_partkey as slug, p_brand as category, p_type as content_type, case p_partkey % 4 when 0 then 'True' when 1 then ' yes ' when 2 then '1' else 'no' end as decision_content, case when p_partkey % 9 = 0 then null else (p_partkey * 37 % 1000) / 16.0 end::double as geo_score from part"


def _posts(spark, d) -> DataFrame:
    key = F.col("p_partkey")
    return _t(spark, d, "part").select("p_partkey", F.concat(F.lit("post-"), key).alias("slug"), F.col("p_brand").alias("category"), F.col("p_type").alias("content_type"), F.expr("case p_partkey % 4 when 0 then 'True' when 1 then ' yes ' when 2 then '1' else 'no' end").alias("decision_content"), F.when(key % 9 != 0, (key * 37 % 1000) / 16.0).alias("geo_score"), F.lit("stats_count").alias("weakest_criteria"), (key % 3 == 0).alias("striking_distance"), (key % 5 == 0).alias("low_ctr_high_impr"))


@query(f"with p as ({_POSTS}) select row_number() over (order by geo_score nulls last, slug)::bigint as priority_rank, slug, category, content_type, round_even(geo_score, 1) as geo_score, 'geo_consideration' as strategy_bucket, 'none' as gsc_signal from p where decision_content <> 'no'")
def post_worklist(spark, d):
    """Decision pages, worst first, missing scores last."""
    return blog.prioritise(_posts(spark, d).drop("p_partkey", "striking_distance", "low_ctr_high_impr")).drop("weakest_criteria")


@query(
    f"""
    with p as ({_POSTS}), r as (select slug, avg(p_partkey % 50) as rival_score from p, range(2) where p_partkey % 2 = 0 group by 1)
    select slug, case when p_partkey % 3 = 0 and p_partkey % 5 = 0 then 'quick_win' when p_partkey % 3 = 0 then 'striking_distance' when p_partkey % 5 = 0 then 'ctr_fix' else 'geo_consideration' end as strategy_bucket,
      100 - coalesce(geo_score, 0) + case when p_partkey % 3 = 0 then 20 else 0 end + case when p_partkey % 5 = 0 then 10 else 0 end as priority_score, geo_score - rival_score as relative_score
    from p left join r using (slug)
    """
)
def post_strategy(spark, d):
    """Documented extras: buckets by search signals, a score of gain, and the distance to competitors."""
    posts = _posts(spark, d)
    rivals = posts.where("p_partkey % 2 = 0").select("slug", (F.col("p_partkey") % 50).cast("double").alias("geo_score"))
    return blog.against_competitors(blog.strategy(posts), rivals.unionAll(rivals)).select("slug", "strategy_bucket", "priority_score", "relative_score")


@query(
    _PARTS_SQL
    + """
    select k as p_partkey, 'https://www.own.example/blog/post-' || k as url, concat_ws(chr(10) || chr(10), 'Page: post-' || k || chr(10) || 'Score: 12.5' || chr(10) || 'Weakest: stats_count',
      'Title: Part ' || k || chr(10) || 'Description: About ' || p_name || chr(10) || 'H1: Part ' || p_name,
      case when k % 3 = 0 then concat_ws(chr(10), 'Focus keyword: kw ' || k, 'Intent: informational', case when k % 2 = 0 then 'Prompt: ask' end, 'Questions:' || chr(10) || '- f1' || chr(10) || '- f3', case when k % 4 = 0 then 'Entities: e1; e2' end) end,
      'Text: ' || concat_ws(' ', 'Part ' || k, 'Part ' || p_name, q, para, h, case when k % 3 = 0 then k || ' 2.5 kg' end, nullif(trim(repeat('x ', (k % 5)::int)), ''), 'own r', case when k % 4 = 0 then 'box 7%' end, case when k % 7 = 0 then 'a gift for her' end),
      'Specs', 'Reply with one JSON object.') as prompt
    from ld where html is not null
    """
)
def post_prompts(spark, d):
    """Prompts of worklist rows: page facts, the focus row of refocused ones, visible text, specs; default urls."""
    pages = _pages(spark, d).where("html is not null").withColumn("slug", F.concat(F.lit("post-"), F.col("p_partkey")))
    work = pages.select("p_partkey", "slug", F.lit(1).alias("priority_rank"), F.lit(12.5).alias("geo_score"), F.lit("stats_count").alias("weakest_criteria"))
    key = F.col("p_partkey")
    focus = pages.select(
        F.upper("slug").alias("slug"), F.concat(F.lit("kw "), key).alias("focus_keyword"), F.lit("informational").alias("focus_intent"), F.when(key % 3 == 0, " yes").otherwise("no").alias("refocus"),
        F.when(key % 2 == 0, "ask").alias("focus_prompt"), F.lit("f1").alias("fan_out_1"), F.lit(" ").alias("fan_out_2"), F.lit("f3").alias("fan_out_3"), F.lit(None).cast("string").alias("fan_out_4"), F.when(key % 4 == 0, "e1; e2").alias("connected_entities"),
    )
    return blog.prompts(work, pages.select("slug", "html"), focus, spec_text="Specs", url_prefix="https://www.own.example/blog/").select("p_partkey", "url", "prompt")


_HEADINGS = ("(top of page)", "Product @", "Specs ", "What is in it?", "FAQ", "Customer words", "specs", "How?")
_LAYOUT = f"""
    with s as (select c_custkey as g, i, replace([{', '.join(f"'{x}'" for x in _HEADINGS)}][((c_custkey * 5 + i * i) % 8 + 1)::int], '@', (c_custkey % 3)::varchar) as h, (c_custkey + i) % 5 > 0 as visible, case when (c_custkey + i) % 4 = 0 then '' else 't' end as txt from customer, range(9) t(i)),
    y as (select *, upper(trim(h)) as u from s),
    n as (select count(distinct g) as n from y),
    f as (select u from y, n where u <> 'FAQ' group by u, n.n having count(distinct g) >= 0.5 * n.n),
    z as (select y.*, f.u is not null as fixed, h = '(top of page)' as top, u = 'PRODUCT ' || (g % 3) as box, u = 'FAQ' as faq, ends_with(trim(h), '?') or txt = '' or not visible as quiet from y left join f using (u)),
    m as (select *, case when not top and not box and faq then 1 when not top and not box and not quiet then 0 end as mark from z),
    w as (select *, coalesce(last_value(mark ignore nulls) over (partition by g order by i rows between unbounded preceding and 1 preceding), 0) = 1 and quiet as inside from m),
    k as (select g, i, visible, case when top then 'top' when box then 'buy_box' when faq then 'FAQ' when inside and txt <> '' then 'faq_q' when inside then null when fixed then u when visible then 'banner' end as token from w),
    a as (select *, row_number() over (partition by g, token order by i) as again from k where token is not null)
"""


def _sections(spark, d) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("i"))
    h = F.get(F.array(*map(F.lit, _HEADINGS)), ((F.col("c_custkey") * 5 + F.col("i") * F.col("i")) % 8).cast("int"))
    kind = (F.col("c_custkey") % 3).cast("string")
    return c.select(F.col("c_custkey").alias("variant_group"), F.col("i").alias("index"), F.replace(h, F.lit("@"), kind).alias("heading"), F.concat(F.lit("product "), kind).alias("h1"), ((F.col("c_custkey") + F.col("i")) % 5 > 0).alias("visible"), F.when((F.col("c_custkey") + F.col("i")) % 4 == 0, "").otherwise("t").alias("text"))


@query(_LAYOUT + "select g as variant_group, i::int as index, token, visible from a where token <> 'buy_box' or again = 1")
def layout_tokens(spark, d):
    """Tokens of captured sections, with the FAQ region and the headings that half of the pages have."""
    s = _sections(spark, d)
    return lay.tokens(s, lay.fixed_headings(s))


@query(_LAYOUT + ", first as (select u, arg_min(trim(h), g * 100 + i) as label from y group by u) select f.u as key, label from f join first using (u)")
def layout_labels(spark, d):
    """Fixed headings in their first spelling."""
    return lay.fixed_headings(_sections(spark, d))


@query(
    """
    with b as (select conv_id, turn, role = 'user' as heading, turn % 3 <> 1 as visible, 100 * turn as y, text from conversations),
    s as (select *, sum(heading::int) over (partition by conv_id order by turn rows unbounded preceding) as n from b),
    a as (select conv_id, n, max(text) filter (heading) as title, count(*) filter (not heading) as c, min(y) filter (heading and visible) as hy, min(y) filter (not heading and visible) as top, max(y + 10) filter (not heading and visible) as bottom, coalesce(string_agg(left(text, 8), chr(10) order by turn) filter (not heading), '') as t from s group by all)
    select conv_id as page, row_number() over (partition by conv_id order by n)::bigint - 1 as index, left(coalesce(title, '(top of page)'), 20) as heading, top is not null as visible, case when top is not null then least(top, hy) end::bigint as y_top, bottom::bigint as y_bottom, t as text from a where n > 0 or c > 0
    """
)
def captured_sections(spark, d):
    """Block rows rolled up to sections: place, visibility and text."""
    c = _t(spark, d, "conversations")
    heading = F.col("role") == "user"
    blocks = c.select(F.col("conv_id").alias("page"), F.col("turn").alias("seq"), F.when(heading, "h2").otherwise("p").alias("tag"), heading.alias("heading"), F.when(heading, F.col("text")).otherwise(F.left("text", F.lit(8))).alias("text"), (F.col("turn") % 3 != 1).alias("visible"), (F.col("turn") * 100).alias("y"), F.lit(10).alias("h"))
    return cap.build_sections(blocks).select("page", "index", F.left("heading", F.lit(20)).alias("heading"), "visible", "y_top", "y_bottom", "text")


_ROLE_HEADINGS = ("Care", "Customer Reviews", "Reviews of others", "FAQs", "Related Products", "Acme Steam Iron", "Main Product", "Price", "Frequently asked questions")


@query(
    f"""
    with s as (select c_custkey as page, i, [{', '.join(f"'{x}'" for x in _ROLE_HEADINGS)}][((c_custkey * 7 + i * 4 + i * i) % {len(_ROLE_HEADINGS)} + 1)::int] as h, case when (c_custkey + i) % 3 = 0 then 'only $9' when (c_custkey + i) % 3 = 1 then repeat('long ', 20) || '$9' else 'words' end as txt from customer, range(6) t(i)),
    m as (select *, lower(h) as n, case when lower(h) = 'customer reviews' or starts_with(lower(h), 'reviews') then 1 when lower(h) in ('faqs', 'frequently asked questions') then 0 end as mark from s),
    r as (select *, coalesce(last_value(mark ignore nulls) over (partition by page order by i rows unbounded preceding), 0) = 1 as review from m)
    select page, i::int as index, case when review then 'review' when n = 'related products' then 'related' when n <> 'main product' and (n = 'acme steam iron' or (length(txt) <= 60 and contains(txt, '$'))) then 'card' else 'kept' end as role from r
    """
)
def section_roles(spark, d):
    """Sections that are reviews, the related block, product cards or the page's own copy."""
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("page"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("index"))
    h = F.get(F.array(*map(F.lit, _ROLE_HEADINGS)), ((F.col("page") * 7 + F.col("index") * 4 + F.col("index") * F.col("index")) % len(_ROLE_HEADINGS)).cast("int"))
    text = F.expr("case (page + index) % 3 when 0 then 'only $9' when 1 then concat(repeat('long ', 20), '$9') else 'words' end")
    s = c.select("page", "index", h.alias("heading"), text.alias("text"))
    known = F.array(F.lit("Acme Steam Iron 3000 with a very long name indeed"), F.lit("Fan"))
    return cap.label_sections(s, F.lit("MAIN product"), known, brand=None).select("page", "index", "role")


@query("select p_type as variant_group, arg_min('u' || p_partkey, lpad(p_partkey::varchar, 9, '0')) as url, count(*)::bigint as urls, left(string_agg('u' || p_partkey, ' ' order by lpad(p_partkey::varchar, 9, '0')), 60) as first_urls from part group by 1")
def representatives(spark, d):
    """The page to capture of each group, and all of its pages by product name."""
    p = _t(spark, d, "part").select(F.col("p_type").alias("variant_group"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("product_name"), F.concat(F.lit("u"), F.col("p_partkey")).alias("url"))
    return pdp.representatives(p).select("variant_group", "url", F.size("variant_urls").cast("long").alias("urls"), F.left(F.array_join("variant_urls", " "), F.lit(60)).alias("first_urls"))


_BLOCKED = " or ".join(f"contains(probe, '{w}')" for w in BLOCK_WORDS)


@query(
    f"""
    with p as (select page_id, case when page_id % 6 = 0 then 403 else 200 end as status, case when page_id % 5 = 0 then 'Just a  moment' when page_id % 7 = 0 then 'Are you a Robot?' else 'Shop' end as title, case when page_id % 4 = 0 then ' ' when page_id % 9 = 0 then 'CAPTCHA here' else 'Head' end as h1 from pages),
    q as (select *, lower(title || ' ' || h1) as probe from p)
    select page_id, status >= 400 or {_BLOCKED} or trim(h1) = '' as blocked from q
    """
)
def blocked_pages(spark, d):
    """Pages that say no: an error status, a blocking word or no H1."""
    p = _t(spark, d, "pages").select("page_id", F.expr("case when page_id % 6 = 0 then 403 else 200 end").alias("status"), F.expr("case when page_id % 5 = 0 then 'Just a  moment' when page_id % 7 = 0 then 'Are you a Robot?' else 'Shop' end").alias("title"), F.expr("case when page_id % 4 = 0 then ' ' when page_id % 9 = 0 then 'CAPTCHA here' else 'Head' end").alias("h1"))
    return p.select("page_id", t.is_blocked(F.col("status"), F.col("title"), F.col("h1"), BLOCK_WORDS).alias("blocked"))


@query(f"with l as (select doc_id, trim(unnest(string_split(text, chr(10))), chr(32) || chr(9) || chr(13)) as l from documents) select doc_id, count(*)::bigint as questions from l where ends_with(l, '?') or list_contains([{_WORDS}], regexp_extract(lower(l), '^([^\\s]*)', 1)) group by 1")
def question_lines(spark, d):
    """Lines of each text that are questions."""
    lines = _t(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("l")).withColumn("l", F.btrim("l", F.lit(" \t\r")))
    return lines.where(t.is_question(F.col("l"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("questions"))


@query(
    """
    with p as (select p_partkey as k, 'ACME  ' || p_name || ', ' || p_brand || '! x' as name, case p_partkey % 3 when 0 then ' 12 ' when 1 then '' else 'x1' end as n, p_name || chr(10) || p_type || chr(13) || chr(10) || case when p_partkey % 2 = 0 then '' else 'last' end as txt, p_partkey / 7.0::double - 20 as v from part)
    select k as p_partkey, trim(regexp_replace(replace(regexp_replace(lower(name), '[^a-z0-9 ]+', ' ', 'g'), 'acme ', ' '), '\\s+', ' ', 'g')) as norm, coalesce(try_cast(trim(n) as int), 0) as whole, (3 - (k % 2 = 0)::int)::bigint as lines, greatest(0, least(100, v)) as clamped, round_even(v, 1) as short,
      regexp_matches(lower(name), '\\b(?:gift|for him|for her|present)\\b') as gift from p
    """
)
def text_functions_2(spark, d):
    """Normalised names, whole numbers, lines, clamped and rounded values."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("ACME  "), "p_name", F.lit(", "), "p_brand", F.lit("! x"))
    n = F.expr("case p_partkey % 3 when 0 then ' 12 ' when 1 then '' else 'x1' end")
    text = F.concat(F.col("p_name"), F.lit("\n"), F.col("p_type"), F.lit("\r\n"), F.when(key % 2 == 0, "").otherwise("last"))
    v = key / F.lit(7.0) - 20
    return _t(spark, d, "part").select("p_partkey", t.norm(name, "ACME").alias("norm"), t.int_or_zero(n).alias("whole"), F.size(t.lines(text)).cast("long").alias("lines"), t.clamp(v).alias("clamped"), F.bround(v, 1).alias("short"), t.has_gift_phrase(name).alias("gift"))


_CUSTOMERS = "select c_custkey, c_name || ', \"x\"' as c_name, c_acctbal, c_nationkey % 2 = 0 as even, case when c_custkey % 5 = 0 then null else c_mktsegment end as segment from customer"


def _customers(spark, d) -> DataFrame:
    return _t(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(', "x"')).alias("c_name"), "c_acctbal", (F.col("c_nationkey") % 2 == 0).alias("even"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"))


@query(f"select *, c_acctbal::varchar <> '' as as_text from ({_CUSTOMERS})")
def csv_round_trip(spark, d):
    """A stage's CSV, counted when read back, and read by a schema and as strings."""
    folder, rows = _folder(spark), _customers(spark, d)
    sinks.stage_csv(rows, folder)
    sinks.read_back(rows, spark, folder)
    typed = readers.csv(spark, folder, "c_custkey long, c_name string, c_acctbal double, even boolean, segment string")
    strings = readers.csv(spark, folder).select(F.col("c_custkey").cast("long").alias("c_custkey"), (F.col("c_acctbal") != "").alias("as_text"))
    return typed.join(strings, "c_custkey")


@query(f"select * from ({_CUSTOMERS})")
def workbook_round_trip(spark, d):
    """All rows in spreadsheets of a key range each, made on the executors and read back by their header."""
    folder = _folder(spark)
    sinks.workbooks(_customers(spark, d), "c_custkey", per_book=2000).write.parquet(folder)
    return readers.workbook(spark.read.parquet(folder), "c_custkey long, c_name string, c_acctbal double, even boolean, segment string").drop("row_no")


@query("select conv_id, count(*)::bigint as sections, md5(string_agg(text, chr(10) order by turn, role, text)) as texts, bool_or(turn = 2) as any_shown from conversations group by 1")
def json_round_trip(spark, d):
    """Nested page captures as JSON documents, one in a line, read back by their schema."""
    folder = _folder(spark)
    c = _t(spark, d, "conversations")
    pages = c.groupBy(F.concat(F.lit("g"), "conv_id").alias("variant_group")).agg(F.sort_array(F.collect_list(F.struct(F.col("turn").cast("int").alias("index"), F.col("role").alias("heading"), "text", (F.col("turn") == 2).alias("visible")))).alias("sections"))
    sinks.json_lines(pages, folder)
    got = readers.parse_json(spark.read.text(folder), "value", readers.SECTIONS).where("parsed")
    texts = F.md5(F.array_join(F.transform("sections", lambda s: s.text), "\n"))
    return got.select(F.expr("cast(substring(variant_group, 2) as bigint)").alias("conv_id"), F.size("sections").cast("long").alias("sections"), texts.alias("texts"), F.exists("sections", lambda s: s.visible).alias("any_shown"))


@query("select conv_id, count(*)::bigint as turns, arg_max(turn, turn)::bigint as turn, md5(arg_max(text, turn)) as text from conversations group by 1")
def state_merge(spark, d):
    """The last turn of every conversation, kept in a state table that batches of turns are merged into."""
    base, c = _folder(spark), _t(spark, d, "conversations")
    for k in range(2):
        state.merge(c.where(F.col("turn") % 2 == k).groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text")), base, "conv_id", "turn", writer="turns", batch_id=k, range_rows=20_000)
    turns = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return state.read(spark, base).join(turns, "conv_id").select("conv_id", "turns", "turn", F.md5("text").alias("text"))


@query("select p_partkey, p_name, p_type, row_number() over (order by p_partkey) as position from part")
def ordered_files(spark, d):
    """Parts in CSV files whose names follow their keys, read back in the order of files and rows."""
    folder = _folder(spark)
    p = _t(spark, d, "part").select("p_partkey", "p_name", "p_type").repartitionByRange(8, "p_partkey").sortWithinPartitions("p_partkey")
    p.write.option("header", True).option("escape", '"').csv(folder)
    rows = ordered.columns(ordered.csv_files(spark, folder), ["p_partkey", "p_name", "p_type"])
    return rows.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_type", "position")


@query(
    """
    with o as (select o_custkey, o_orderstatus <> 'P' as stays, o_orderpriority = '1-URGENT' as urgent, cast(round(o_totalprice * 100) as bigint) as cents from orders where o_custkey is not null)
    select o_custkey, case when not bool_or(stays) then 'gone' when bool_or(urgent or not stays) then 'changed' else 'same' end as change,
        count(*) filter (stays) as orders, coalesce(sum(cents + case when urgent then 100 else 0 end) filter (stays), 0)::bigint as cents
    from o group by 1
    """
)
def refresh_groups(spark, d):
    """Totals by customer, made again only for customers whose orders changed since the first run."""
    base, o = _folder(spark), _t(spark, d, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    old = o.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", cents.alias("cents"))
    total = lambda rows: rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("cents"))
    incremental.refresh(old, base, "o_custkey", total)
    new = old.where("o_orderstatus <> 'P'").withColumn("cents", F.col("cents") + F.when(F.col("o_orderpriority") == "1-URGENT", 100).otherwise(0))
    run = incremental.refresh(new, base, "o_custkey", total)
    both = incremental.results(spark, base).join(run.touched.drop("done"), "o_custkey", "full")
    return both.select("o_custkey", F.coalesce("change", F.lit("same")).alias("change"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "cents")])


@query("select c_custkey, case when c_custkey % 3 = 0 then 'new' else c_mktsegment end as segment from customer where c_custkey % 7 <> 0")
def version_round_trip(spark, d):
    """A state table in two versions: the second is read."""
    base, c = _folder(spark), _t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    sinks.write_version(c, base)
    again = sinks.read_version(spark, base).where("c_custkey % 7 <> 0").withColumn("segment", F.when(F.col("c_custkey") % 3 == 0, "new").otherwise(F.col("segment")))
    sinks.write_version(again, base)
    return sinks.read_version(spark, base)


@query(
    """
    with l as (select doc_id, lang, unnest(string_split(text, chr(10))) as content from documents),
    t as (select unnest([['license', 'license'], ['the', '(?:^|[^a-z0-9_])the(?:$|[^a-z0-9_])'], ['e.t', 'e\\.t'], ['sh in th', 'sh in th']]) as t)
    select t[1] as term, lang as folder, count(*)::bigint as hits from l, t where regexp_matches(lower(content), t[2]) group by all
    """
)
def leak_scan(spark, d):
    """A tree of text files, a folder for each language, scanned for the terms of a deny list: hits by term and folder."""
    folder = _folder(spark)
    _t(spark, d, "documents").where("text is not null").select("lang", "text").write.option("maxRecordsPerFile", 500).partitionBy("lang").text(f"{folder}/tree")
    spark.createDataFrame([("# terms",), ("license",), (" the ",), ("",), ("e.t",), ("Sh in Th",)], "value string").coalesce(1).write.text(f"{folder}/deny")
    files = readers.text_tree(spark, f"{folder}/tree")
    found, _, _ = m.scan_report(files, readers.deny_list(spark, f"{folder}/deny"))
    return found.where("line > 0").groupBy(F.lower("term").alias("term"), F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("hits"))


@query("select page_id, case when page_id % 2 = 0 then html when page_id % 10 = 5 then null else 'fetched ' || url end as html from pages where url is not null")
def fetch_pages(spark, d):
    """Pages that a cache lacks are fetched, host by host, and added to it; a second run fetches nothing that came."""
    p = _t(spark, d, "pages").where("url is not null").select(F.col("page_id").cast("string").alias("slug"), F.concat("url", F.when(F.col("page_id") % 10 == 5, "#gone").otherwise("")).alias("url"), "html")
    cache, folder = p.where("cast(slug as int) % 2 = 0").select("slug", "html"), _folder(spark)

    def fetch(url: str) -> str:
        if url.endswith("#gone"):
            raise OSError(url)
        return f"fetched {url}"

    readers.fetch_missing(p, cache, fetch, pause=0, pacing=0, write_to=folder)
    both = cache.unionByName(readers.cached_pages(spark, folder))
    again = readers.fetch_missing(p, both, None)
    return both.unionByName(again).select(F.col("slug").cast("long").alias("page_id"), "html")


assert set(EXPECTED_SCHEMA) == {"Article", "FAQPage", "BreadcrumbList"}


@query("select distinct url, case when length(url) % 7 <> 0 then 'page of ' || url end as html from pages")
def fetch_laps(spark, d):
    """All urls of the pages, fetched in laps by host; a seventh of them never answers."""

    def fetch(url):
        if len(url) % 7 == 0:
            raise OSError(url)
        return f"page of {url}"

    return fetching.fetch_all(_t(spark, d, "pages"), _folder(spark), fetch, pacing=0)
