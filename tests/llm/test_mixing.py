from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import mixing
from tests.llm.cases import frame, rows


def follow(planned, chosen):
    """Holds a schedule (slot -> source, block) against the windows and shares of its phases; returns blocks by source."""
    used, slot = Counter(), 0
    for p in planned:
        assert p["base"] == slot and p["first"] == [used[s] for s in p["names"]]
        total, done = sum(p["w"]), Counter()
        for t in range(p["slots"]):
            s, block = chosen[slot]
            w = p["w"][p["names"].index(s)]
            assert block == used[s]
            assert done[s] * total // w <= t < -(-(done[s] + 1) * total // w)
            done[s] += 1
            used[s] += 1
            slot += 1
            for x, y in zip(p["names"], p["w"]):
                assert abs(done[x] * total - y * (t + 1)) < total
    assert slot == len(chosen)
    return used


def brute(planned):
    """Earliest deadline first, slot by slot."""
    chosen = {}
    for p in planned:
        total, n = sum(p["w"]), [0] * len(p["w"])
        for t in range(p["slots"]):
            _, k = min((-(-(n[k] + 1) * total // x), k) for k, x in enumerate(p["w"]) if n[k] < p["cap"][k] and n[k] * total // x <= t)
            chosen[p["base"] + t] = (p["names"][k], p["first"][k] + n[k])
            n[k] += 1
    return chosen


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(1, 300), min_size=1), st.lists(st.one_of(st.floats(0.001, 100), st.integers(1, 4)), min_size=8, max_size=8), st.sampled_from([1, 7, 1024]))
def test_every_block_in_its_window_and_less_than_one_from_the_share(blocks, weights, run):
    planned = mixing.phases(blocks, dict(zip("abcdefgh", weights)), run)
    chosen = brute(planned)
    assert follow(planned, chosen) == Counter(blocks) and len(planned) <= len(blocks)
    for p in planned:
        for r in p["runs"]:
            done = Counter(chosen[p["base"] + t][0] for t in range(r["begin"]))
            assert r["n"] == [done[s] for s in p["names"]]


def test_a_thousand_sources_of_very_unequal_weights():
    """Weights from 1e-5 to 1, exact shares, over runs of several lengths."""
    weights = {f"s{k:04}": 10 ** (-5 * k / 999) for k in range(1000)}
    planned = mixing.phases({s: 2 + k % 5 for k, s in enumerate(weights)}, weights, 64)
    total = sum(planned[0]["w"])
    assert all(abs(w / total - weights[s] / sum(weights.values())) < 1e-12 for s, w in zip(planned[0]["names"], planned[0]["w"]))
    p = planned[0] | {"slots": min(planned[0]["slots"], 64)}
    chosen = brute([p])
    done = Counter()
    for t in range(p["slots"]):
        done[chosen[t][0]] += 1
        assert all(abs(done[s] - w * (t + 1) / total) < 1 for s, w in zip(p["names"], p["w"]))
    assert sum(x["slots"] for x in planned) == sum(2 + k % 5 for k in range(1000))


@pytest.mark.parametrize("run, weights", [(16, (0.3141592, 0.2718281, 1.7320508, 0.00071)), (1024, (0.5, 0.25, 1, 0.01)), (4, (5, 3, 2, 1))])
def test_schedule_is_that_of_brute_force(spark, run, weights):
    blocks = {"a": 200, "b": 90, "c": 40, "d": 7, "e": 30}
    planned = mixing.phases(blocks, dict(zip("abcd", weights)) | {"e": 0}, run)
    got = {r.slot: r for r in mixing.schedule(spark, planned).collect()}
    assert {t: (r.mix_source, r.mix_block) for t, r in got.items()} == brute(planned)
    assert follow(planned, {t: (r.mix_source, r.mix_block) for t, r in got.items()}) == Counter(blocks)
    assert all(r.release <= t < r.deadline for t, r in got.items())


@pytest.mark.parametrize("weights", [None, {"s0": 5.0, "s1": 1.0, "s2": 0.0}])
def test_interleave(spark, weights):
    data = [(i, f"t{i}", f"s{0 if i % 3 else i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.interleave(docs, weights, block_docs=8).orderBy("mix_position").collect()
    assert sorted((r.doc_id, r.text, r.source) for r in got) == sorted(data)
    assert len({r.mix_position for r in got}) == 3000
    slots = {}
    for r in got:
        slots.setdefault(r.mix_slot, set()).add((r.mix_source, r.mix_block))
        assert r.mix_release <= r.mix_slot < r.mix_deadline
    assert all(len(x) == 1 for x in slots.values())
    planned = mixing.phases({s: -(-n // 8) for s, n in Counter(s for *_, s in data).items()}, weights or {})
    assert {t: next(iter(x)) for t, x in slots.items()} == brute(planned)


def test_edge_cases(spark):
    docs = frame(spark)
    got = mixing.interleave(docs, {None: 3.0})
    assert got.columns[: len(docs.columns)] == docs.columns and sorted(map(str, got.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert mixing.interleave(frame(spark, [])).count() == 0
    assert mixing.in_order(mixing.interleave(docs), 3).count() == len(rows())
