import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeworks.llm import packing
from tests.llm.cases import frame, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(data):
    t = Tokenizer.from_file(PATH)
    out = []
    for key, text in data:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            out.append((key, k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def check(got, want, slack):
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 4096
    least = -(-sum(w[3] for w in want) // 4096)
    assert len(seqs) <= least + slack


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(packing.pack(docs, PATH).collect(), brute_pieces(data), 2)


def test_edge_cases(spark):
    odd = [(100, "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>. x<|endoftext|>,", *rows()[0][2:]), (101, "é ́x İSTANBUL ΣΑΣ x\x85y a​b don't I'LL", *rows()[0][2:])]
    data = rows() + odd
    check(packing.pack(frame(spark, data), PATH).collect(), brute_pieces([(r[0], r[1]) for r in data]), 1)
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_units_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_UNITS", 3)
    e = packing.Encoder(PATH)
    raw = "one two three four five one two Six, seven!".encode()
    for _ in range(3):
        ids, n = e.encode(np.frombuffer(raw, np.uint8), np.array([0, 20, len(raw)]))
        want = [[*e.tokenizer.encode(x.decode(), add_special_tokens=False).ids, 1] for x in (raw[:20], raw[20:])]
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(x) for x in want]
        assert len(e.known) <= 12


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZ9é'st.,!#$ <|endoftx>\n\x01\u0301\u0130\u03a3")), max_size=40), min_size=1, max_size=4))
def test_units_give_the_same_ids(texts):
    e = packing.encoder(PATH)
    raw = [t.encode() for t in texts]
    ids, n = e.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    want = [[*e.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == sum(want, []) and n.tolist() == [len(x) for x in want]


def lower_bound(histogram, capacity=4096):
    """Martello and Toth's L2: for each limit, large pieces need a sequence each, the rest what room they leave."""
    best = -(-sum(k * v for k, v in histogram.items()) // capacity)
    for limit in {0, *(k for k in histogram if 2 * k <= capacity)}:
        alone = sum(v for k, v in histogram.items() if k > capacity - limit)
        half = [(k, v) for k, v in histogram.items() if capacity - limit >= k > capacity / 2]
        n = sum(v for _, v in half)
        rest = sum(k * v for k, v in histogram.items() if capacity / 2 >= k >= limit)
        best = max(best, alone + n + max(0, -(-(rest - (n * capacity - sum(k * v for k, v in half))) // capacity)))
    return best


def best_fit(histogram, capacity=4096):
    """Plain best fit, longest first, by counts."""
    rooms = Counter()
    for k in sorted(histogram, reverse=True):
        n = histogram[k]
        while n:
            room = min((r for r in rooms if r >= k), default=None)
            if room is None:
                each = capacity // k
                whole, rest = divmod(n, each)
                rooms[capacity - each * k] += whole
                if rest:
                    rooms[capacity - rest * k] += 1
                n = 0
                continue
            have, fit = rooms.pop(room), room // k
            full, rest = min(have, n // fit), n % fit if n // fit < have else 0
            used = full + (rest > 0)
            if have > used:
                rooms[room] += have - used
            if full:
                rooms[room - fit * k] += full
            if rest:
                rooms[room - rest * k] += 1
            n -= full * fit + rest
    return sum(rooms.values())


def test_never_worse_than_best_fit():
    rng = np.random.default_rng(11)
    worse, gaps = 0, []
    for _ in range(200):
        kinds = rng.integers(2, 60)
        most = rng.choice([600, 2000, 4096])
        histogram = dict(zip(rng.integers(1, most + 1, kinds).tolist(), rng.integers(1, 400, kinds).tolist()))
        n = sum(n for n, _ in packing.plan(histogram))
        worse += n > best_fit(histogram)
        gaps.append(n / lower_bound(histogram))
    assert worse == 0 and np.mean(gaps) < 1.02


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 4096), st.integers(1, 5000), min_size=1, max_size=60))
def test_plan_uses_every_piece_once(histogram):
    planned = packing.plan(histogram)
    used, sequences = Counter(), 0
    for n, lengths in planned:
        total = 0
        sequences += n
        while lengths is not None:
            k, lengths = lengths
            used[k] += n
            total += k
        assert 0 < total <= 4096
    assert used == Counter(histogram)
    assert sequences <= best_fit(histogram)
    assert sum(n for n, _ in packing._plan(histogram, 4096, [])) == best_fit(histogram)


def test_patterns_of_short_pieces():
    """Deeper patterns than DEPTH are fitted where pieces are short, and their classes fill a sequence."""
    size = np.zeros(64)
    size[[2, 4, 6]] = 5000, 700, 900
    fitted = packing.fit_patterns(size, 64)
    assert any(len(p) > packing.DEPTH for p, _ in fitted) and all(63 <= sum(p) <= 64 for p, _ in fitted)
    used = sum(c * np.bincount(np.array(p) - 1, minlength=64) for p, c in fitted)
    assert np.abs(used - size).max() < 0.02 * size.max()


def test_plan_is_tight():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6, 1.2, 100_000).astype(int), 1, 4096)
    planned = packing.plan(dict(Counter(lengths.tolist())))
    assert sum(n for n, _ in planned) <= 1.001 * lengths.sum() / 4096 + 1
    assert len(packing.slots(planned)["length"]) < 500_000


@pytest.mark.parametrize("seed", range(4))
def test_nnls(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.random((8, 30)), rng.random(8) * 5
    x = packing.nnls(a, b)
    g = a.T @ (a @ x - b)
    assert (x >= 0).all() and (g >= -1e-6).all() and np.abs(g[x > 1e-9]).max(initial=0) < 1e-6


def test_pack_in_order(spark, tmp_path):
    """Files of unequal sizes, which Spark reads largest first, count in the order of their names; frames in their own."""
    data = [(k, "w " * 9000 if k == 700 else None if k % 97 == 0 else "a b c " * (k % 60)) for k in range(1500)]
    part = lambda a, b: spark.createDataFrame(data[a:b], "doc_id long, text string").coalesce(1)
    docs = part(0, 20).union(part(20, 1200)).union(part(1200, 1500))
    docs.write.parquet(f"{tmp_path}/docs")
    found = []
    for df in (spark.read.parquet(f"{tmp_path}/docs"), docs, spark.createDataFrame(data, "doc_id long, text string")):
        got = packing.pack_in_order(df, PATH, stretch=1 << 15).collect()
        check(got, brute_pieces(data), 10)
        found.append(sorted((r.doc_id, r.piece, r.sequence_id, r.offset) for r in got))
        held = {}
        for r in got:
            held.setdefault(r.sequence_id >> 32, []).append((r.doc_id, r.piece))
        assert len(held) > 3 and sum((sorted(held[k]) for k in sorted(held)), []) == [x[:2] for x in found[0]]
    assert found[0] == found[1] == found[2]
    assert packing.pack_in_order(frame(spark, []), PATH).count() == 0
    check(packing.pack_in_order(frame(spark), PATH).collect(), brute_pieces([r[:2] for r in rows()]), 1)
