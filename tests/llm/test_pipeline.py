from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq

from gaugeworks.llm import language_id, mixing, packing, simhash
from gaugeworks.llm import pipeline as cp
from tests.llm.cases import frame, rows
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_packing import brute_pieces, check
from tests.llm.test_simhash import closure, shingle_set, similarities

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def text_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_each_stage(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in cp.STAGES:
        before = text_of(docs)
        out = stage(spark, docs, DIR)
        if name == "packing":
            check(out.collect(), brute_pieces(before), 2)
            break
        assert out.columns == COLUMNS
        after = text_of(out)
        if name == "language_id":
            found = {r.doc_id: r for r in language_id.identify(docs, language_id.fit(docs)).collect()}
            assert after == [x for x in before if found[x[0]].lang_pred != "und" and found[x[0]].score >= 0.05]
            assert len(after) >= 0.98 * len(before)
        elif name == "line_dedup":
            had = dict(before)
            assert after == sorted((x for x in brute_lines(before) if x[1] == had[x[0]] or (x[1] or "").strip()), key=str)
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "simhash":
            assert after == brute_near(before)
        else:
            assert after == before
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_mix_is_the_order_of_the_rows(spark):
    """Files hold the rows in the order of the schedule: each block of 64 rows is of the source that brute force puts there."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = Counter(r.source for r in docs.collect())
    planned = mixing.phases({s: -(-n // mixing.BLOCK_DOCS) for s, n in sizes.items()}, cp.WEIGHTS)
    left, want = Counter(sizes), []
    for _, (s, _) in sorted(brute_mix(planned).items()):
        n = min(mixing.BLOCK_DOCS, left[s])
        want += [s] * n
        left[s] -= n
    assert [r.source for r in cp.mix(spark, docs, DIR).collect()] == want


def test_packing_follows_the_mix(spark, tmp_path):
    """Sequences are numbered along the mixed files; each stretch holds consecutive rows, so both sources in the mix's shares."""
    data = [(k, " ".join(f"w{(k * 7 + i) % 50}" for i in range(20 + k * 37 % 300)), "en", "a" if k < 1300 else "b", 0) for k in range(2600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    cp.mix(spark, docs, DIR).write.parquet(f"{tmp_path}/mix")
    ids = [x for f in sorted(tmp_path.glob("mix/part-*")) for x in pq.read_table(f)["doc_id"].to_pylist()]
    place = {x: k for k, x in enumerate(ids)}
    got = cp.pack(spark, spark.read.parquet(f"{tmp_path}/mix"), DIR).collect()
    check(got, brute_pieces([r[:2] for r in data]), 2)
    first = {}
    for r in got:
        first[r.sequence_id] = min(place[r.doc_id], first.get(r.sequence_id, len(ids)))
    assert len(first) > 50 and [first[x] for x in sorted(first)] == sorted(first.values())
    held = {}
    for r in packing.pack_in_order(spark.read.parquet(f"{tmp_path}/mix"), cp.TOKENIZER, stretch=1 << 16).collect():
        held.setdefault(r.sequence_id >> 32, set()).add(place[r.doc_id])
    assert len(held) > 5 and sum((sorted(held[k]) for k in sorted(held)), []) == list(range(len(ids)))
    for rows_ in held.values():
        n = Counter("a" if ids[k] < 1300 else "b" for k in rows_)
        assert abs(n["a"] - n["b"]) <= 2 * mixing.BLOCK_DOCS


def brute_near(rows_):
    """One text of each component of the pairs of similarity 0.8, that of the smallest id."""
    data = sorted(rows_)
    groups = closure(len(data), [p for p, v in similarities([shingle_set(t) for _, t in data]).items() if v >= 0.8])
    return sorted((r for k, r in enumerate(data) if groups[k] == k), key=str)


def test_edge_cases(spark, tmp_path):
    odd = frame(spark).select(*COLUMNS, "key")
    for data, least in ((odd, 1), (odd.limit(0), 0)):
        docs = data
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, DIR)
            assert docs.columns == [*COLUMNS, "key"]
        assert cp.STAGES[-1][1](spark, docs, DIR).count() >= least
    one = simhash.keep_one(frame(spark))
    assert one.where("doc_id = 5").count() == 1 and one.count() < len(rows())


def test_run(spark):
    """All stages together against brute force: which texts are left, and their pieces."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    found = {r.doc_id: r for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    left = [x for x in text_of(docs) if found[x[0]].lang_pred != "und" and found[x[0]].score >= 0.05]
    had = dict(left)
    left = brute_near([x for x in brute_lines(left) if x[1] == had[x[0]] or (x[1] or "").strip()])
    check(cp.run(spark, DIR).collect(), brute_pieces(left), 2)
    assert len(left) > 100 and public_tokenizers.path("word_bpe_49k.json") == cp.TOKENIZER
