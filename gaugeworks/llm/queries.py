"""The thin queries over the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import fold, table

#: Target weights of the mix; sources that aren't named weigh 1.
MIX = {"src0": 6.0, "src1": 2.5, "src2": 1.25, "src3": 0.4, "src4": 0.003}
QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query(
    "op10_quality_rules",
    r"""
    with t as (select doc_id, coalesce(text, '') as t from documents),
    a as (
      select doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x09-\x0D ]+'), lambda x: x <> '') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D ]')) as l
      from t),
    k as (
      select row_number() over () as r, doc_id, t, w, l from a),
    p as (
      select r, i, row(w[i], w[i + 1], w[i + 2]) as g
      from (select r, w, unnest(range(1, len(w) - 1)) as i from k)),
    d as (select r, unnest([i, i + 1, i + 2]) as c from (select r, i, count(*) over (partition by r, g) as n from p) where n > 1),
    c as (select r, count(distinct c) as n from d group by r),
    m as (
      select k.r, doc_id,
        len(w)::bigint as n_words,
        length(array_to_string(w, ''))::bigint as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
        coalesce(c.n, 0)::bigint as n_repeat_words,
        len(l)::bigint as n_lines,
        len(regexp_extract_all(t, '\p{Lu}'))::bigint as n_upper,
        len(regexp_extract_all(t, '\p{L}'))::bigint as n_letters
      from k left join c on k.r = c.r),
    f as (
      select * exclude (r),
        ((n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (10 * n_symbols > n_words)::int
          + 8 * (100 * n_dup_lines > 30 * n_lines)::int + 16 * (word_chars < 2 * n_words or word_chars > 15 * n_words)::int
          + 32 * (100 * n_upper > 40 * n_letters)::int + 64 * (n_words < 2 * n_lines)::int)::bigint as failure_bits
      from m)
    select *, (failure_bits & 3) <> 0 as base_failed, failure_bits = 0 as kept, 'v2' as policy from f
    """,
)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document under policy v2."""
    from gaugeworks.llm.quality_rules import apply_policy, build_ledger

    return apply_policy(build_ledger(table(spark, sf_dir, "documents")), "v2")


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of 3-word shingles and component of every document."""
    from gaugeworks.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


@query("op2_media_gif")
def op2_media_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as GIF frames, read back and digested."""
    from gaugeworks.llm.gif import media_digests

    return media_digests(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows of fold 0 teach nothing."""
    from gaugeworks.llm.language_id import fit, identify

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 5) != 0))
    return identify(docs, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows of fold 2 teach nothing."""
    from gaugeworks.llm.quality_classifier import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 4) != 2), table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document; rows of fold 2 teach nothing."""
    from gaugeworks.llm.language_model import score

    found = score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return found.select("doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    from gaugeworks.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and place of every document in a mix of unequal target weights."""
    from gaugeworks.llm.mixing import interleave

    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.xxhash64("text").alias("text_hash"))
    return interleave(rows, MIX, id_cols=("doc_id", "text_hash")).drop("text_hash")


@query(
    "op9_suffix_dedup",
    """
    with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    b as (select r, doc_id, b, substring(h, 2 * b + 1, 1198) as t from (select r, doc_id, h, unnest(range(0, length(h) // 2 - 99, 500)) as b from d)),
    w as (select r, doc_id, b + i as s, md5(substring(t, 2 * i + 1, 200)) as k from (select r, doc_id, b, t, unnest(range(0, least(500, length(t) // 2 - 99))) as i from b)),
    k as (select r, s, row_number() over (partition by k order by doc_id, s) as nth from w),
    g as (select r, s, s - lag(s, 1, -101) over (partition by r order by s) > 100 as new from k where nth > 1),
    n as (select r, s, sum(new::int) over (partition by r order by s rows unbounded preceding) as span from g),
    p as (select r, span, min(s) as a, max(s) + 100 as z from n group by r, span),
    q as (select r, a, z, lag(z, 1, 0) over (partition by r order by a) as before from p),
    x as (select q.r, sum(z - a)::bigint as n_removed, count(*)::bigint as n_spans, max(z) as past, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept from q join d on q.r = d.r group by q.r)
    select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
      sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(past, 0) + 1))) as kept_sha256
    from d left join x on d.r = x.r
    """,
)
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier."""
    from gaugeworks.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    from gaugeworks.llm.line_dedup import dedup_lines

    left = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.col("dedup_lines").alias("n_lines"), F.col("dedup_removed").alias("n_removed"), F.col("dedup_copy").alias("is_copy"), F.sha2("text", 256).alias("kept_sha256"))


#: crc32 in DuckDB: of a list `b` of byte numbers, by the eight steps of each byte.
_CRC_BYTE = "list_reduce(list_prepend(xor(c, v), [0, 1, 2, 3, 4, 5, 6, 7]), lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)"


def _crc32(b: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {b}), lambda c, v: {_CRC_BYTE}), 4294967295)"


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op11_lexical_search",
    f"""
    with d as (select row_number() over () as r, doc_id, {_TERMS} as t from documents),
    q as (select row_number() over () as q, item_id, {_TERMS} as t from benchmark),
    e as (select q, item_id, term, count(*) as times from (select q, item_id, unnest(t) as term from q) group by q, item_id, term),
    p as (select r, term, count(*) as tf from (select r, unnest(t) as term from d) where term in (select term from e) group by r, term),
    c as (select count(*) filter (len(t) > 0) as n, sum(len(t))::bigint as l from d),
    w as (select term, floor(1000 * ln((2 * n + 2)::double / (2 * df + 1)::double))::bigint as w from (select term, count(*) as df from p group by term), c),
    m as (select r, doc_id, 75 + (25 * len(t) * n) // l as m from d, c where l > 0),
    s as (
      select q, item_id, m.r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
      from e join w on e.term = w.term join p on e.term = p.term join m on p.r = m.r
      group by q, item_id, m.r, doc_id),
    k as (select item_id, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank, doc_id, score from s where score > 0)
    select item_id, rank, doc_id, score from k where rank <= 20
    """,
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every item."""
    from gaugeworks.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query(
    "op12_periodic_runs",
    rf"""
    with t as (
      select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D ]+'), lambda x: x <> '') as w,
        {_crc32("list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)")} as h
      from documents),
    g as (select r, doc_id, w, len(w)::bigint as n, h, h // 10 as g from t),
    a as (select *, if(h % 10 = 0 and n > 0, g % n, n) as a from g),
    b as (select *, 1 + (n - a) // (3 + g % 8) as p from a),
    v as (select r, i, w[if(i < a, i, a + (i - a) % p) + 1] as x from (select *, unnest(range(n)) as i from b)),
    k as (select r, i, row(x, lead(x) over o, lead(x, 2) over o) as k, lead(x, 2) over o is not null as whole from v window o as (partition by r order by i)),
    e as (
      select x.r, x.i, y.i - x.i as q
      from k x join k y on x.r = y.r and x.k = y.k and y.i > x.i join b on b.r = x.r
      where x.whole and y.whole and 4 * (y.i - x.i) <= n),
    s as (select r, q, min(i) as start, max(i) - min(i) + 3 + q as length from (select *, i - row_number() over (partition by r, q order by i) as z from e) group by r, q, z),
    u as (select r, start, length, min(q) as period from s where length >= greatest(6, 4 * q) group by r, start, length),
    gone as (select distinct r, unnest(range(start + period, start + length)) as i from u),
    kept as (select v.r, string_agg(x, ' ' order by v.i) as t from v left join gone on v.r = gone.r and v.i = gone.i where gone.r is null group by v.r),
    runs as (
      select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as t,
        max(row(length, -start, -period)) as best
      from u group by r)
    select doc_id, coalesce(n_runs, 0)::bigint as n_runs, (-best[2])::bigint as start, best[1]::bigint as length, (-best[3])::bigint as period,
      (1000 * best[1] // -best[3])::bigint as exponent_milli, sha256(coalesce(runs.t, '')) as runs_sha256, sha256(coalesce(kept.t, '')) as collapsed_sha256
    from b left join runs on b.r = runs.r left join kept on b.r = kept.r
    """,
)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; in one of ten, words repeat from some place on."""
    from gaugeworks.llm.periodic_runs import digests, periodic_runs, with_planted_runs

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = with_planted_runs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return digests(periodic_runs(planted, carried=["doc_id"]), "doc_id")


def _feistel(x: str) -> str:
    """Select list of one pass of the permutation of `x` over the grid a x b, by the rounds of `sharding`; the last column is `y`."""
    from gaugeworks.llm.sharding import PRIME, SEED, round_keys

    cells, l, r = [f"{x} // b as l", f"{x} % b as r"], "l", "r"  # noqa: E741
    for i, (k, c) in enumerate(round_keys(SEED)):
        own, other, size = (l, r, "a") if i % 2 == 0 else (r, l, "b")
        cells += [f"({other} % {PRIME} * {k} + {c}) % {PRIME} as h{i}", f"({own} + (h{i} * h{i} + {c}) % {PRIME}) % {size} as x{i}"]
        l, r = (f"x{i}", r) if i % 2 == 0 else (l, f"x{i}")  # noqa: E741
    return ", ".join([*cells, f"{l} * b + {r} as y"])


@query(
    "op13_sharding",
    f"""
    with recursive crc as materialized (select list_transform(range(256), lambda v: {_CRC_BYTE.replace("xor(c, v)", "v")}) as crc),
    t as materialized (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    p as (select r, k, substring(h, 1024 * k + 1, 1024) as s from (select r, h, unnest(range(0, (length(h) // 2 + 511) // 512)) as k from t)),
    b as (select r, flatten(list(list_transform(range(0, length(s) // 2), lambda i: ('0x' || s[2 * i + 1:2 * i + 2])::bigint) order by k)) as b from p group by r),
    c as (select r, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, v: xor(c // 256, crc[xor(c % 256, v) + 1])), 4294967295)::bigint as crc from b, crc),
    d as materialized (
      select doc_id, (length(h) // 2 + 16)::bigint as size, coalesce(crc, 0)::bigint as text_crc32,
        row_number() over (order by doc_id nulls last, coalesce(crc, 0), length(h)) - 1 as row_number
      from t left join c on t.r = c.r),
    g as (select n, a, (n + a - 1) // a as b from (select n, floor(sqrt(n - 1))::bigint + 1 as a from (select count(*) as n from documents))),
    walk as (
      select row_number, y, n from (select row_number, n, a, b, {_feistel("row_number")} from d, g)
      union all
      select row_number, y, n from (select row_number, n, a, b, {_feistel("z")} from (select row_number, w.y as z, g.n, a, b from walk w, g where w.y >= w.n)))
    select doc_id, size, text_crc32, 'rows' as law, (y % 40)::int as shard, (y // 40)::bigint as slot, null::int as grown_shard, row_number::bigint as row_number
    from d join walk using (row_number) where y < n
    """,
)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: counts at most one apart.  Equal texts aren't kept together, as no such counts could be."""
    from gaugeworks.llm.sharding import shard_documents

    found = shard_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to packed sequences."""
    from gaugeworks.llm import pipeline as stages

    return stages.run(spark, sf_dir)
