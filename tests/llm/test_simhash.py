import numpy as np
import pytest
import xxhash

from gaugeworks.llm import simhash
from gaugeworks.llm.components import connected_components
from tests.llm.cases import frame, lower, rows, words


def brute_print(text, width):
    w = words(lower(text))
    s = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    p = np.array(prints, np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p ^ p[i]) <= 2):
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("width", [3, 5])
def test_edge_cases(spark, width):
    data = rows()
    got = simhash.near_duplicates(frame(spark), width).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    prints = [brute_print(r[1], width) for r in data]
    want = list(zip([r[0] for r in data], [f"{p:016x}" for p in prints], brute_components([r[0] for r in data], prints)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(frame(spark, []), width).count() == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.f, r.component_id) for r in simhash.near_duplicates(docs, 3).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()}
    data = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text, 3) for r in data]
    assert got == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(data, prints, brute_components([r.doc_id for r in data], prints))}


@pytest.mark.parametrize("pairwise", [1, 64])
def test_links_of_dense_clusters(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 2**63, 20)}
    for c in list(prints)[:4]:
        for _ in range(60):
            prints.add(c ^ int(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 63, rng.integers(1, 5)).astype(np.uint64))))
    prints = sorted(prints)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(fps)).collect()}
    mine = {}
    for p in prints:
        mine.setdefault(roots.get(p, p), []).append(p)
    least = brute_components(prints, prints)
    want = {}
    for p, c in zip(prints, least):
        want.setdefault(c, []).append(p)
    assert sorted(mine.values()) == sorted(want.values())


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 300), (7, 6)], "a long, b long")
    got = connected_components(edges)
    assert got.count() == 201 and got.select("root").distinct().count() == 1


def shingle_set(text, width=5):
    w = words(lower(text))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def similarities(sets):
    """Jaccard similarity of all pairs that share a shingle."""
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = {}
    for h in holders.values():
        for k, i in enumerate(h):
            for j in h[k + 1 :]:
                shared[i, j] = shared.get((i, j), 0) + 1
    return {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in shared.items()}


def closure(count, pairs):
    root = list(range(count))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(count)]


def test_similar_documents(spark):
    """The components are those of the exact Jaccard similarities of all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    data = docs.select("doc_id", "text").orderBy("doc_id").collect()
    sim = similarities([shingle_set(r.text) for r in data])
    near = [p for p, v in sim.items() if v >= 0.8]
    want = {r.doc_id: data[k].doc_id for r, k in zip(data, closure(len(data), near))}
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    assert len(near) > 50 and got == want


def test_blocks_of_similar_sets_meet():
    """Pairs of each size whose sets differ as much as the similarity lets them share a block."""
    rng = np.random.default_rng(5)
    missed = 0
    for size in [*range(5, 60), 90, 150, 400, 1500]:
        for _ in range(4):
            differ = int(2 * size * 0.2 / 1.8)
            own = differ // 2
            common = rng.integers(0, 2**64, size - own, dtype=np.uint64)
            x = np.concatenate([common, rng.integers(0, 2**64, own, dtype=np.uint64)])
            y = np.concatenate([common, rng.integers(0, 2**64, min(own, differ - own), dtype=np.uint64)])
            assert len(common) / (len(x) + len(y) - len(common)) >= 0.8
            n = np.array([len(x), len(y)])
            keys, k = simhash.block_keys(np.concatenate([x, y]), n, 0.8)
            missed += not set(keys[: k[0]].tolist()) & set(keys[k[0] :].tolist())
            assert k.max() <= 4 * simhash.KEYS
    assert missed == 0


def test_short_texts_and_unrelated_ones_under_one_key(spark, monkeypatch):
    """Distinct six-word texts share no block; a large key of unrelated sets ends in a bounded number of jobs."""
    data = [(k, " ".join(f"a{k}_{i}" for i in range(6))) for k in range(5000)]
    data += [(9000 + k, "one two three four five six seven eight nine ten " + " ".join(f"b{k}_{i}" for i in range(30))) for k in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    monkeypatch.setattr(simhash, "PAIRWISE", 4)
    spark.sparkContext.setJobGroup("simhash-bound", "")
    try:
        got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    finally:
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("simhash-bound"))
        spark.sparkContext._jsc.clearJobGroup()
    assert all(k == c for k, c in got.items()) and jobs < 150


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    texts = [" ".join(f"t{k}_{i}" for i in range(30)) for k in range(5)]
    data = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[4]), (2, texts[0]), (1, texts[0]), (None, texts[4])]
    kept = simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[4])], key=str)


def test_dense_group_of_near_copies(spark):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(300)]
    data = [(0, " ".join(base))]
    for i in range(1, 150):
        t = list(base)
        for k in rng.integers(0, 300, 5):
            t[k] = f"x{i}_{k}"
        data.append((i, " ".join(t)))
    data += [(1000 + i, " ".join(f"u{i}_{k}" for k in range(80))) for i in range(30)]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert sum(got[i] == 0 for i in range(150)) == 150 and all(got[1000 + i] == 1000 + i for i in range(30))


def test_pairs_near_the_limit(spark):
    """400 shingles of which 43 or 47 differ: 0.806 or 0.790; and texts dominated by one repeated phrase."""
    data, k = [], 0
    for changed in (43, 47):
        for _ in range(40):
            base = [f"w{k}_{i}" for i in range(404)]
            data += [(k, " ".join(base)), (k + 1, " ".join(base[:-changed] + [f"x{k}_{i}" for i in range(changed)]))]
            k += 2
    data += [(k + j, "one two three four five " * 400 + " ".join(f"p{j}_{i}" for i in range(60))) for j in range(2)]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    joined = [got[i] == got[i + 1] for i in range(0, k, 2)]
    assert all(joined[:40]) and not any(joined[40:])
    assert got[k] != got[k + 1]


def test_copies_of_variants_in_a_large_group(spark):
    """Each copy is close to a variant (0.84), but not to the original, to which all variants are close."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(404)]

    def change(text, at, mark):
        return text[:at] + [f"{mark}_{i}" for i in range(31)] + text[at + 31 :]

    variants = [change(base, int(rng.integers(0, 170)), f"v{k}") for k in range(600)]
    copies = [change(variants[k], int(rng.integers(210, 370)), f"c{k}") for k in range(80)]
    data = [(k, " ".join(t)) for k, t in enumerate([base, *variants, *copies])]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert all(got[601 + k] == got[1 + k] == 0 for k in range(80))


def test_rare_prefixes(spark):
    """Similar sets share a prefix hash; sets that share a common passage alone don't, so pairs stay linear in the texts."""
    rng = np.random.default_rng(2)
    new = lambda n: rng.integers(-(2**63), 2**63 - 1, n).tolist()
    passage, sets = new(20), []
    for k in range(400):
        sets.append((k, sorted({*passage, *new(40)})))
    for k in range(1000, 1200, 2):  # 0.8 and a little more, of which 20 of 60 or more are the passage
        core, own = new(40 + k % 30), int((60 + k % 30) / 8)
        for j in range(2):
            sets.append((k + j, sorted({*passage, *core, *new(own)})))
    df = spark.createDataFrame(sets, "sid long, hashes array<long>").repartition(5)
    prefixes = {}
    for r in simhash.rare_prefixes(df, 0.8).collect():
        prefixes.setdefault(r.sid, set()).add(r.key)
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    by = dict(sets)
    similar = [k for k in range(1000, 1200, 2) if jaccard(by[k], by[k + 1]) >= 0.8]
    assert len(similar) > 50 and all(prefixes[k] & prefixes[k + 1] for k in similar)
    found = spark.createDataFrame([], "node long, root long")
    pairs = {tuple(r) for r in simhash.prefix_pairs(df, found, 0.8).collect()}
    assert {(k, k + 1) for k in similar} <= pairs and len(pairs) <= 110


def test_licence_line_in_many_texts(spark, monkeypatch):
    """Texts that share a licence line are dealt by rare shingles; the copies among them are found."""
    monkeypatch.setattr(simhash, "PAIRWISE", 8)
    line = " ".join(f"lic{i}" for i in range(24))
    texts = [f"{line} " + " ".join(f"w{k}_{i}" for i in range(40)) for k in range(600)]
    texts += [t.rsplit(" ", 3)[0] + f" changed{k}" for k, t in enumerate(texts[:40])]
    dealt = []
    real = simhash.prefix_pairs
    monkeypatch.setattr(simhash, "prefix_pairs", lambda *a: dealt.append(real(*a).count()) or real(*a))
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert dealt and dealt[0] < 1000
    assert got == {k: k - 600 if k >= 600 else k for k in range(640)}


def test_copies_that_differ_too_much_do_not_meet(spark):
    """Of copies of one set that each changed 15 % only the similar ones are paired, of whatever size; pairs stay linear in the copies."""
    rng = np.random.default_rng(8)
    new = lambda n: rng.integers(-(2**63), 2**63 - 1, n).tolist()
    base = new(120)
    sets = [(k, {*rng.permutation(base)[:85].tolist(), *new(15)}) for k in range(300)]
    for k in range(1000, 1200, 2):  # near each other, from 0.8 by size or by change
        x = [*rng.permutation(base)[:60].tolist(), *new(20 + k % 37)]
        y = x[: len(x) - k // 2 % 9] + new(k // 3 % 5)
        sets += [(k, set(x)), (k + 1, set(y))]
    df = spark.createDataFrame([(k, sorted(x)) for k, x in sets], "sid long, hashes array<long>").repartition(5)
    found = spark.createDataFrame([], "node long, root long")
    pairs = {tuple(r) for r in simhash.prefix_pairs(df, found, 0.8).collect()}
    similar = {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if len(x & y) >= 0.8 * len(x | y)}
    assert len(similar) >= 100 and similar <= pairs and len(pairs) < 1000


def test_members_of_many_keys_are_judged_once(spark, monkeypatch):
    """Near copies share most of their keys, mostly with one first: a row for each pair, not for each key."""
    seen = []
    real = simhash.still_apart
    monkeypatch.setattr(simhash, "still_apart", lambda met, found: seen.append((met.count(), met.select("sid", "first").distinct().count())) or real(met, found))
    rng = np.random.default_rng(6)
    data = []
    for k in range(120):
        t = [f"w{i}" for i in range(150)]
        for i in rng.integers(0, 150, 1 + k % 9):
            t[i] = f"x{k}_{i}"
        data.append((k, " ".join(t)))
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    near = [p for p, v in similarities([shingle_set(t) for _, t in data]).items() if v >= 0.8]
    assert got == dict(enumerate(closure(120, near)))
    assert sum(n for n, _ in seen) > 100 and all(n == pairs for n, pairs in seen)
