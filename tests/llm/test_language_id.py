import numpy as np

from gaugeworks.llm import language_id as li
from gaugeworks.llm.common import fold
from tests.llm.cases import frame, rows


def brute_grams(t):
    raw = bytearray((t or "").encode())
    out = bytearray(raw)
    for i, b in enumerate(raw):
        if b < 128:
            out[i] = ord(chr(b).lower()) if chr(b).isalpha() else 32
        elif i and raw[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97:
            out[i] = b + 32
    return [int.from_bytes(out[i : i + li.GRAM], "little") for i in range(len(out) - li.GRAM + 1)]


def test_grams():
    texts = ["", "a", "abc", "abcd", "ÉÀ x×", "one two", "", "xyz", "Zz9 q!"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    g, n = li.grams(np.frombuffer(b"".join(raw), np.uint8), offs)
    assert g.tolist() == sum(map(brute_grams, texts), []) and n.tolist() == [len(brute_grams(t)) for t in texts]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = fold("doc_id", 5) == 0
    model = li.fit(docs.where(~held))
    got = li.identify(docs, model).join(docs.where(held), "doc_id").select("lang", "lang_pred", "score").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_filter_returns_all_languages(spark):
    data = [(i, t, lang) for i, (t, lang) in enumerate([("shared words alpha", "aa"), ("shared words beta", "bb")] * 3)]
    model = li.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    g, _ = li.grams(np.frombuffer(b"shared", np.uint8), np.array([0, 6]))
    a, b = li.places(g)
    assert ((model.slots[0][a] & model.slots[0][b]) == 3).all()


def test_edge_cases(spark):
    docs = frame(spark)
    model = li.fit(docs)
    got = {}
    for r in li.identify(docs, model).collect():
        got.setdefault(r.doc_id, r)
    assert len(got) == len({r[0] for r in rows()})
    for i, t, *_ in rows():
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1
    none = li.fit(frame(spark, []))
    assert none.languages == [] and {r.lang_pred for r in li.identify(docs, none).collect()} == {"und"}
    assert li.identify(frame(spark, []), model).count() == 0


def brute_decision(model, text):
    """Counts by plain loops: all slots of an n-gram must hold the language's bit."""
    found = []
    grams = brute_grams(text)
    for b in range(len(model.languages)):
        slots = model.slots[b // li.MASK]
        fill = sum(int(x) >> (b % li.MASK) & 1 for x in slots.tolist()) / len(slots)
        rate = fill ** len(li._MIX)
        hits = sum(all(int(slots[(g * int(m) & (1 << 64) - 1) >> (64 - li.SLOT_BITS)]) >> (b % li.MASK) & 1 for m in li._MIX) for g in grams)
        found.append(max(0, hits - len(grams) * rate) / (1 - rate))
    best = max(range(len(found)), key=lambda b: (found[b], -b))
    return (model.languages[best] if found[best] > 0 else model.default), min(1, found[best] / max(1, len(grams)))


def test_decisions(spark, monkeypatch):
    monkeypatch.setattr(li, "SLOT_BITS", 15)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = li.fit(docs)
    assert 0.001 < model.rates.max() < 0.99
    for r in docs.limit(40).collect():
        raw = (r.text or "").encode()
        best, score = li.decide(model, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        lang, want = brute_decision(model, r.text)
        assert (model.languages[best[0]] if best[0] >= 0 else model.default) == lang and abs(score[0] - want) < 1e-9


def test_more_languages_than_a_mask_holds(spark):
    """150 languages of own words, one of them rare; sampling is by language."""
    data = [(k, f"{'abcdefghij'[k % 150 // 15] * 3}{'klmnopqrstuvwxy'[k % 15] * 2}z word{k % 150}x", f"l{k % 150:03}") for k in range(600)]
    data += [(1000, "unlike any other speech", "rare")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = li.fit(docs, sample=3)
    assert len(model.languages) == 151 and len(model.slots) == 3
    got = {r.doc_id: r.lang_pred for r in li.identify(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in data) >= 590 and got[1000] == "rare"


def test_sample_is_bounded_by_language_and_not_by_id(spark):
    """One id of many texts and a hot language don't lift the bound."""
    rows_ = [(1, f"hot text {i}", "aa") for i in range(3000)] + [(i, f"own text {i}", "bb") for i in range(50)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string").selectExpr("*", "xxhash64(doc_id, text) as h")
    from gaugeworks.llm.common import bounded_sample

    got = bounded_sample(docs, 100, "h", "lang").collect()
    want = sorted(r.h for r in docs.where("lang = 'aa'").collect())[:100]
    assert sorted(r.h for r in got if r.lang == "aa") == want and sum(r.lang == "bb" for r in got) == 50


def test_without_labels_nothing_is_rejected(spark):
    docs = frame(spark)
    assert li.accepted(docs, li.fit(docs.limit(0))).count() == len(rows())
