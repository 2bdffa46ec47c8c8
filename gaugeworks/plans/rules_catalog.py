"""Queries over score and brief files whose SQL twins read the same JSON and apply the rules themselves.

The files are made from the customer table by expressions that Spark and the twin share: each question, edit and ask is faulty or
not by a remainder of its own, so that faults meet in many combinations.  Nothing of what a file breaks is written down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.config import EDIT_ACTIONS, QUESTION_KEYS
from gaugeworks.operators import constraints as k
from gaugeworks.plans import pdp
from gaugeworks.session import materialise
from gaugeworks.sources import readers

QUERIES = {}
ORACLES = {}

_KEY = "cast(c_custkey as string)"
#: A question's faults are told by the key's remainder by its own divisor.
_DIVISORS = (41, 43, 47, 53, 59, 61)


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def _pick(of: str, cases: list[str], other: str) -> str:
    return f"case {of} " + " ".join(f"when {i} then {x}" for i, x in enumerate(cases)) + f" else {other} end"


def _answer(i: int) -> str:
    """SQL text of `, "question": {...}`."""
    on_page = _pick(f"(c_custkey + {i}) % 4", ["'quiet  motor of'", "concat(c_name, ' Top')", "concat('says ', c_mktsegment)"], "concat('Care quiet motor of nation ', cast(c_nationkey as string))")
    quote = f"""concat('[{{"quote": "', {on_page}, '"}}]')"""
    two = f"""concat('[{{"quote": "', {on_page}, '"}}, {{"quote": "nowhere ', {_KEY}, '"}}, {{"gap": "no quote"}}]')"""
    far = "concat('[{\"quote\": \"', repeat(concat(c_mktsegment, ' '), 20), '\"}]')"
    usual = f"cast((c_custkey + {i}) % 3 + 1 as string)"
    body = lambda score, evidence, gap="g": f"""concat('"score": ', {score}, ', "evidence": ', {evidence}, ', "gap": "{gap}"')"""
    cases = [
        "''",
        body("'7'", quote),
        body("""'"2"'""", quote),
        body("'2'", "'\"quiet motor\"'"),
        body("'1'", "'[]'"),
        body("'1'", """'[{"quote": "  "}]'"""),
        body("'0'", two),
        body("'2'", quote, "  "),
        body("'true'", two),
        body("'null'", quote),
        body("'1.5'", two),
        """'"score": 1, "gap": "g"'""",
        """'"score": 3, "evidence": [], "gap": ""'""",
        body("'0'", "'[]'", ""),
        body("'2'", far),
    ]
    lacking = _pick(f"(c_custkey + {i}) % 9", ["''", "', \"missing_attributes\": \"none\"'"], "concat(', \"missing_attributes\": [', substring(repeat(', \"a\"', cast(c_custkey % 4 as int)), 3), ']')")
    return f"""case when c_custkey % {_DIVISORS[i]} = 0 then '' else concat(', "{QUESTION_KEYS[i]}": {{', {_pick(f'c_custkey % {_DIVISORS[i]}', cases, body(usual, quote))}, {lacking}, '}}') end"""


_SCORE_FILE = f"""
    case when c_custkey % 67 = 0 then '{{"variant_group": "g' else concat('{{"variant_group": "', case c_custkey % 67 when 1 then concat('x', {_KEY}) when 2 then concat('g', cast(c_custkey - 1 as string)) else concat('g', {_KEY}) end,
      '", "questions": {{', substring(concat({', '.join(_answer(i) for i in range(len(QUESTION_KEYS)))}, case when c_custkey % 71 = 0 then ', "other": {{"score": 1}}' else '' end), 3), '}}}}') end
"""
_SIX = "[" + ", ".join(f"'{q}'" for q in QUESTION_KEYS) + "]"
_SQUASH = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


def _scores(spark, d) -> DataFrame:
    """Checked score files; 3 mod 29 isn't in the index, 4 mod 31 isn't captured."""
    c = spark.read.parquet(f"{d}/customer.parquet").withColumn("file", F.concat(F.lit("g"), F.col("c_custkey")))
    files = readers.parse_json(materialise(c.select("c_custkey", "file", F.expr(_SCORE_FILE).alias("raw"))), "raw", k.SCORE_SCHEMA)
    groups = c.where("c_custkey % 29 <> 3").select(F.col("file").alias("variant_group"), F.col("c_mktsegment").alias("category"))
    parts = F.array(F.struct(F.lit(0).alias("index"), F.lit("Top").alias("heading"), F.expr("concat('it says  ', c_mktsegment)").alias("text")), F.struct(F.lit(1).alias("index"), F.lit("Care").alias("heading"), F.expr("concat('quiet', chr(10), ' motor of nation ', c_nationkey)").alias("text")))
    sections = c.where("c_custkey % 31 <> 4").select(F.col("file").alias("variant_group"), F.col("c_name").alias("h1"), F.explode(parts).alias("s")).select("variant_group", "h1", "s.*")
    return pdp.check_scores(files, groups, pdp.page_texts(sections))


@query(
    f"""
    with f as (select c_custkey, 'g' || c_custkey as file, {_SCORE_FILE} as raw from customer),
    j as (select c_custkey, file, case when json_valid(raw) then raw::json end as j from f),
    n as (select *, json_extract_string(j, '$.variant_group') as named from j),
    pages as (select 'g' || c_custkey as named, {_SQUASH.format("concat_ws(chr(10), c_name, 'Top', 'it says  ' || c_mktsegment, 'Care', 'quiet' || chr(10) || ' motor of nation ' || c_nationkey)")} as page from customer where c_custkey % 31 <> 4),
    groups as (select 'g' || c_custkey as named, true as known from customer where c_custkey % 29 <> 3),
    h as (select n.*, coalesce(known, false) as known, page from n left join groups using (named) left join pages using (named)),
    open as (select * from h where j is not null and known and page is not null),
    q as (select c_custkey, page, q, json_extract(j, '$.questions.' || q) as x from open, (select unnest({_SIX}) as q)),
    s as (select *, lower(trim(json_extract_string(x, '$.score'))) as score, json_extract(x, '$.evidence') as ev from q),
    w as (select *, case when score in ('0', '1', '2', '3') then score::int when score = 'true' then 1 when score = 'false' then 0 end as whole, ev is null or json_type(ev) = 'ARRAY' as listed from s),
    e as (select c_custkey, page, q, json_extract_string(unnest(json_extract(ev, '$[*]')), '$.quote') as quote from w where whole is not null and listed and ev is not null),
    m as (
      select c_custkey, 'V1' as rule, 'not valid JSON' as detail from h where j is null
      union all select c_custkey, 'V2', 'group differs from the file''s name' from h where j is not null and named is distinct from file
      union all select c_custkey, 'V3', 'unknown group' from h where j is not null and not known
      union all select c_custkey, 'V4', 'page not captured' from h where j is not null and known and page is null
      union all select c_custkey, 'V5', 'questions are not the six' from open where list_sort(json_keys(j, '$.questions')) <> list_sort({_SIX})
      union all select c_custkey, 'V6', q || ': score ' || coalesce(json_extract_string(x, '$.score'), 'null') from w where whole is null
      union all select c_custkey, 'V7', q || ': evidence is no list' from w where whole is not null and not listed
      union all select c_custkey, 'V8', q || ': a score without a quote' from w where whole > 0 and listed and coalesce(json_array_length(ev), 0) = 0
      union all select c_custkey, 'V9', q || ': empty quote' from e where trim(coalesce(quote, '')) = ''
      union all select c_custkey, 'V10', q || ': not on the page: ' || left(quote, 80) from e where trim(quote) <> '' and not contains(page, {_SQUASH.format("quote")})
      union all select c_custkey, 'V11', q || ': no gap' from w where whole < 3 and listed and trim(coalesce(json_extract_string(x, '$.gap'), '')) = ''
      union all select c_custkey, 'V12', 'capable_of: missing_attributes is no list' from open where coalesce(json_type(j, '$.questions.capable_of.missing_attributes'), '') <> 'ARRAY'),
    r as (select c_custkey, array_to_string(list_sort(list(rule || ' ' || detail)), '|') as errors from m group by 1),
    t as (select c_custkey, sum(whole) as total from w group by 1)
    select c_custkey, coalesce(errors, '') as errors, case when errors is null then round(total / 18.0 * 100)::int end as cosmo_score,
      case when errors is null then json_array_length(j, '$.questions.capable_of.missing_attributes')::bigint end as missing
    from h left join r using (c_custkey) left join t using (c_custkey)
    """
)
def score_rule_messages(spark, d):
    """Every message of every score file, and the score and missing attributes of those without one."""
    told = F.array_join(F.sort_array(F.transform("errors", lambda e: F.concat_ws(" ", e.rule, e.detail))), "|")
    return _scores(spark, d).select("c_custkey", told.alias("errors"), "cosmo_score", F.col("missing").cast("long").alias("missing"))


def _edit(i: int) -> str:
    """SQL text of `, {...}`, the brief's edit of that number."""
    where = f"case when c_custkey % 17 = {i} then ' ' else 'top' end"
    action = _pick(f"(c_custkey + {i}) % 5", ["', \"action\": \"replace\"'", "', \"action\": \"add\"'", "', \"action\": \"remove\"'", "case when c_custkey % 2 = 0 then ', \"action\": \"move\"' else ', \"action\": \"replace\"' end"], "case when c_custkey % 3 = 0 then '' else ', \"action\": \"add\"' end")
    current = _pick(f"(c_custkey + {2 * i}) % 7", ["''", "'  '", "'loud motor'", "concat('motor  of   ', c_name)", "concat('motor of ', c_name, '0')"], "'a quiet  motor'")
    new = f"case when (c_custkey + {i}) % 11 = 0 then ' ' else 'silent' end"
    why = f"case when c_custkey % 13 = {i} then '' else 'w' end"
    questions = _pick(f"(c_custkey + {i}) % 12", ["''", "', \"questions\": []'", "', \"questions\": [\"isA\", \"other\"]'"], "', \"questions\": [\"isA\", \"cause_benefit\"]'")
    return f"""concat(', {{"where": "', {where}, '"', {action}, ', "current": "', {current}, '", "new": "', {new}, '", "why": "', {why}, '"', {questions}, '}}')"""


def _ask(i: int) -> str:
    return f"""concat(', {{"ask": "', case when c_custkey % 7 = {i} then '' else 'a' end, '", "if_confirmed": "', case when c_custkey % 11 = {i} then ' ' else 'b' end, '"', case when c_custkey % 13 = {i} then '' else ', "if_not": "c"' end, '}}')"""


def _up_to(n: str, parts: list[str]) -> str:
    """SQL text of a JSON list of the first n parts."""
    return "concat('[', substring(concat(" + ", ".join(f"case when {n} > {i} then {x} else '' end" for i, x in enumerate(parts)) + "), 3), ']')"


_TARGETS = ", ".join(f'"{q}": 3' for q in QUESTION_KEYS)
_BRIEF_FILE = f"""
    concat('{{"product_name": "P"', case c_custkey % 37 when 0 then ', "variant_group": "other"' when 1 then '' else concat(', "variant_group": "c', {_KEY}, '"') end,
      case when c_custkey % 41 = 0 then '' else concat(', "for_client_editor": ', {_up_to('c_custkey % 3', [_ask(i) for i in range(2)])}) end,
      {_pick('c_custkey % 19', ["', \"for_owner\": {\"a\": 1}'", "''", "', \"for_owner\": \"x\"'"], "', \"for_owner\": [\"x\"]'")},
      case when c_custkey % 47 = 0 then '' else concat(', "edits": ', {_up_to('c_custkey % 4', [_edit(i) for i in range(3)])}) end,
      {_pick('c_custkey % 9', ["''", "', \"gifting_bullet\": {\"where\": \"w\", \"text\": \" \"}'", "', \"gifting_bullet\": {\"text\": \"t\"}'"], "', \"gifting_bullet\": {\"where\": \"w\", \"text\": \"t\"}'")},
      {_pick('c_custkey % 10', ["''", "', \"target_scores\": {\"isA\": 3}'", f"', \"target_scores\": {{{_TARGETS}, \"other\": 1}}'"], f"', \"target_scores\": {{{_TARGETS}}}'")},
      {_pick('c_custkey % 43', ["', \"warnings\": [\"w\"]'", "', \"warnings\": []'"], "''")}, '}}')
"""
_BLANK = "trim(coalesce({}, '')) = ''"


def _briefs(spark, d) -> DataFrame:
    """Checked briefs; 5 mod 23 isn't in the index, 7 mod 29 not captured, 9 mod 31 not scored."""
    c = spark.read.parquet(f"{d}/customer.parquet").withColumn("file", F.concat(F.lit("c"), F.col("c_custkey")))
    files = readers.parse_json(materialise(c.select("c_custkey", "file", F.expr(_BRIEF_FILE).alias("raw"))), "raw", k.BRIEF_SCHEMA)
    groups = c.where("c_custkey % 23 <> 5").select(F.col("file").alias("variant_group"), F.col("c_mktsegment").alias("category"), F.col("c_custkey").cast("string").alias("priority"))
    pages = c.where("c_custkey % 29 <> 7").select(F.col("file").alias("variant_group"), F.expr("concat('a  quiet', chr(10), 'motor of ', c_name)").alias("page"))
    scores = readers.parse_json(c.where("c_custkey % 31 <> 9").select("file", F.lit(67).alias("cosmo_score"), F.lit('{"questions": {}}').alias("raw")), "raw", k.SCORE_SCHEMA).select("file", "cosmo_score", "questions")
    return pdp.check_briefs(files, groups, pages, scores)


@query(
    f"""
    with f as (select c_custkey as k, c_name, 'c' || c_custkey as file, {_BRIEF_FILE} as raw from customer),
    j as (select k, file, raw::json as j, case when k % 29 <> 7 then {_SQUASH.format("'a  quiet' || chr(10) || 'motor of ' || c_name")} else '' end as page from f),
    e as (select k, page, i, json_extract(j, '$.edits[' || (i - 1) || ']') as x from (select k, page, j, unnest(range(1, json_array_length(j, '$.edits')::bigint + 1)) as i from j)),
    v as (select k, page, 'edit ' || i as place, x, json_extract_string(x, '$.action') as action, json_extract_string(x, '$.current') as cur from e),
    a as (select k, i, p, json_extract_string(j, '$.for_client_editor[' || (i - 1) || '].' || p) as x from (select k, j, unnest(range(1, json_array_length(j, '$.for_client_editor')::bigint + 1)) as i from j), (select unnest(['ask', 'if_confirmed', 'if_not']) as p)),
    m as (
      select k, 'B0' as rule, 'not in the index' as detail from j where k % 23 = 5
      union all select k, 'B0', 'page not captured' from j where k % 29 = 7
      union all select k, 'B0', 'no valid score' from j where k % 31 = 9
      union all select k, 'B1', 'group differs from the file''s name' from j where json_extract_string(j, '$.variant_group') is distinct from file
      union all select k, 'B2', 'no edit' from j where coalesce(json_array_length(j, '$.edits'), 0) = 0
      union all select k, 'B3', place from v where coalesce(action, '') not in ({', '.join(f"'{x}'" for x in EDIT_ACTIONS)})
      union all select k, 'B4', place from v where {_BLANK.format("json_extract_string(x, '$.where')")}
      union all select k, 'B5', place from v where action in ('replace', 'remove') and {_BLANK.format('cur')}
      union all select k, 'B6', place from v where action in ('replace', 'remove') and not {_BLANK.format('cur')} and not contains(page, {_SQUASH.format('cur')})
      union all select k, 'B7', place from v where action in ('replace', 'add') and {_BLANK.format("json_extract_string(x, '$.new')")}
      union all select k, 'B8', place from v where {_BLANK.format("json_extract_string(x, '$.why')")}
      union all select k, 'B9', place from v where json_extract(x, '$.questions') is null or len(list_filter(json_extract_string(x, '$.questions[*]'), lambda y: not list_contains({_SIX}, y))) > 0
      union all select k, 'B10', 'warnings is a key of old' from j where json_exists(j, '$.warnings')
      union all select k, 'B11', 'ask ' || i || ': ' || p from a where {_BLANK.format('x')}
      union all select k, 'B12', 'for_owner is no list' from j where json_type(j, '$.for_owner') <> 'ARRAY'
      union all select k, 'B13', 'no gifting bullet' from j where {_BLANK.format("json_extract_string(j, '$.gifting_bullet.where')")} or {_BLANK.format("json_extract_string(j, '$.gifting_bullet.text')")}
      union all select k, 'B14', 'targets are not the six' from j where not json_exists(j, '$.target_scores') or list_sort(json_keys(j, '$.target_scores')) <> list_sort({_SIX})),
    r as (select k, array_to_string(list_sort(list(rule || ' ' || detail)), '|') as errors from m group by 1)
    select j.k as c_custkey, coalesce(errors, '') as errors from j left join r using (k)
    """
)
def brief_rule_messages(spark, d):
    """Every message of every brief."""
    told = F.array_join(F.sort_array(F.transform("errors", lambda e: F.concat_ws(" ", e.rule, e.detail))), "|")
    return _briefs(spark, d).select("c_custkey", told.alias("errors"))
