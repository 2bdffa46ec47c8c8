import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import line_dedup as ld
from tests.llm.cases import frame, rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = ld.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_increasing():
    assert ld._increasing([(0, 3), (1, 1), (2, 2), (3, 9), (4, 4), (5, 5)]) == [(1, 1), (2, 2), (4, 4), (5, 5)]


def least_runs(sizes, least):
    """Least runs (from, past) of lines of `least` bytes from each line on and up to each line."""
    out = set()
    for i in range(len(sizes)):
        for step in (1, -1):
            j, total = i, 0
            while 0 <= j < len(sizes):
                total += sizes[j]
                if total >= least:
                    out.add((min(i, j), max(i, j) + 1))
                    break
                j += step
    return out


def distinct_texts(data):
    """Distinct texts in order of their least id, as (text, stripped lines, line sizes)."""
    key = lambda i: ld._LAST if i is None else i
    first = {}
    for i, t in data:
        if t is not None:
            first[t] = min(first.get(t, ld._LAST), key(i))
    made = [(t, [x.strip(" \t\n\x0b\x0c\r") for x in t.split("\n")]) for t in sorted(first, key=lambda t: first[t])]
    return [(t, lines, [len(x.encode()) for x in lines]) for t, lines in made]


def brute(data, rare=ld.RARE, least=ld.MIN_BYTES, windows=True):
    """The same rules over all texts in plain loops; strings for hashes."""
    key = lambda i: ld._LAST if i is None else i
    first = {}
    for i, t in data:
        if t is not None:
            first[t] = min(first.get(t, ld._LAST), key(i))
    texts = sorted(first, key=lambda t: first[t])
    lines = {t: [x.strip(" \t\n\x0b\x0c\r") for x in t.split("\n")] for t in texts}
    holders = {}
    for t in texts:
        for x in set(lines[t]) - {""}:
            holders.setdefault(x, []).append(t)
    gone, seen = {}, {}
    runs = {t: least_runs([len(x.encode()) for x in lines[t]], least) for t in texts}
    made = {t: {tuple(lines[t][a:z]) for a, z in runs[t]} for t in texts}

    def common(t, e):
        """Aligned blocks, and each least run of the one that the other has anywhere."""
        aligned = ld.blocks(ld.align(lines[t], lines[e]), [len(x.encode()) for x in lines[t]], least)
        return aligned + [(a, z) for a, z in runs[t] if tuple(lines[t][a:z]) in made[e]]

    for t in texts if windows else ():
        for e in {seen[w] for w in made[t] if w in seen}:
            gone.setdefault(t, []).extend(common(t, e))
        for w in made[t]:
            seen.setdefault(w, t)
    for t in texts:
        mine = [(len(holders[x]), holders[x][0], len(x.encode())) for x in set(lines[t]) - {""} if len(holders[x]) > 1 and holders[x][0] != t]
        if sum(b for *_, b in mine) < least:
            continue
        cut = max(rare, min(df for df, *_ in mine))
        for e in {f for df, f, _ in mine if df <= cut}:
            gone.setdefault(t, []).extend(common(t, e))
    out = []
    for i, t in data:
        if t is None:
            out.append((i, None))
        elif key(i) > first[t] and t:
            out.append((i, ""))
        else:
            parts = t.split("\n")
            out.append((i, "\n".join(x for k, x in enumerate(parts) if not any(a <= k < z for a, z in gone.get(t, ())))))
    return out


def result(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_planted(spark):
    rng = random.Random(4)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(8))
    shared, boiler = [line() for _ in range(6)], "short boilerplate line"
    data = []
    for i in range(60):
        own = [line() for _ in range(rng.randint(1, 8))]
        if i % 3 == 0:
            own[rng.randint(0, len(own)) : 0] = shared[rng.randint(0, 3) :]
        own.insert(rng.randint(0, len(own)), boiler)
        data.append((i, "\n".join(own)))
    data += [(100 + i, data[7][1]) for i in range(5)] + [(200 + i, data[8][1] + "\n" + line()) for i in range(20)]
    rng.shuffle(data)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = result(ld.dedup_lines(docs))
    assert got == sorted(brute(data), key=str)
    texts = dict(got)
    assert not any(texts[100 + i] for i in range(5)) and all(boiler in texts[i] for i in (1, 2, 4)) and sum(shared[5] in t for t in texts.values()) < 8


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(ld.dedup_lines(docs)) == sorted(brute(data), key=str)


def test_recall_against_all_pairs(spark):
    """Lines in a run of MIN_BYTES that any earlier text has too: all of them go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    left = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    seen, common, gone, kept = set(), 0, 0, {}
    for i, t in sorted(data, key=lambda r: r[0]):
        kept.setdefault(t, left[i])
    for t, lines, sizes in distinct_texts(data):
        found = least_runs(sizes, ld.MIN_BYTES)
        covered = {k for a, z in found if tuple(lines[a:z]) in seen for k in range(a, z) if sizes[k]}
        seen |= {tuple(lines[a:z]) for a, z in found}
        common += len(covered)
        if covered:
            gone += min(len(covered), sum(n > 0 for n in sizes) - sum(x.strip(" \t\n\x0b\x0c\r") != "" for x in kept[t].split("\n")))
    assert common > 100 and gone == common


@pytest.mark.parametrize("windows", [False, True])
def test_block_whose_lines_occurred_apart_before(spark, windows):
    a, b, c = (f"line {k} of a block that has one hundred and forty bytes" for k in "abc")
    data = [(1, a + "\nx"), (2, b + "\ny"), (3, c + "\nz"), (4, "\n".join(["own 4", a, b, c])), (5, "\n".join([a, b, c, "own 5"]))]
    texts = dict(result(ld.dedup_lines(spark.createDataFrame(data, "doc_id long, text string"), windows=windows)))
    assert texts[4] == data[3][1] and texts[5] == ("own 5" if windows else data[4][1])


def test_edge_cases(spark):
    docs = frame(spark)
    got = ld.dedup_lines(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert result(got) == sorted(brute([(r[0], r[1]) for r in rows()]), key=str)
    assert ld.dedup_lines(frame(spark, [])).count() == 0


def test_common_passage_beside_a_rare_line(spark):
    """A passage of 40 texts goes from later ones that also share a short line with one other text; so does a block whose lines occurred apart before."""
    line = lambda k: f"line {k} of a passage that is long enough to be kept apart from others"
    passage = [line(0), line(1), line(2)]
    data = [(i, "\n".join([f"own {i}", *passage, f"end {i}"])) for i in range(40)]
    data += [(100 + i, "\n".join([f"own {100 + i}", f"rare {i // 2}", *passage])) for i in range(10)]
    data += [(200, line("x") + "\na"), (201, line("y") + "\nb"), (202, line("x") + "\n" + line("y") + "\nc"), (203, line("x") + "\n" + line("y") + "\nd")]
    texts = dict(result(ld.dedup_lines(spark.createDataFrame(data, "doc_id long, text string"), windows=True)))
    assert line(1) in texts[0] and not any(line(1) in texts[i] for i in [*range(1, 40), *range(100, 110)])
    assert line("y") in texts[202] and texts[203] == "d"


def test_blocks_without_a_unique_line(spark):
    """Lines that repeat, swapped blocks and a block that comes twice: nothing that stands in the first text is kept."""
    x = [f"line {k} of forty bytes or a little more.." for k in range(10)]
    cases = [
        ([9, 1, 2, 1, 2, 8], [7, 1, 2, 1, 2, 6], [9, 8]),
        ([5, 3, 3, 3, 3, 6], [4, 3, 3, 3, 3, 7], [5, 6]),
        ([4, 5, 6, 7, 0, 1, 2, 3], [0, 1, 2, 3, 4, 5, 6, 7], []),
        ([1, 2, 3, 8, 1, 2, 3, 9], [0, 1, 2, 3, 7], [8, 9]),
        ([1, 2, 8, 3, 4], [1, 2, 9, 3, 4], [1, 2, 8, 3, 4]),
    ]
    for later, first, left in cases:
        data = [(1, "\n".join(x[k] for k in first)), (2, "\n".join(x[k] for k in later))]
        texts = dict(result(ld.dedup_lines(spark.createDataFrame(data, "doc_id long, text string"))))
        assert texts[1] == data[0][1] and texts[2] == "\n".join(x[k] for k in left)
