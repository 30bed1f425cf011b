import random
from collections import Counter

import pytest

from clinilake.llm import mixing
from llm_data import docs


def _simulated(blocks, weights, cycle):
    """Slots of each source's blocks, one slot at a time."""
    left, done, t = {s: n for s, n in blocks.items() if n}, Counter(), 0
    out = []
    while left:
        shares = mixing.rounded({s: weights[s] for s in left}, cycle)
        start, ran = t, Counter()
        while True:
            ready = [(-(-(ran[s] + 1) * cycle // shares[s]), shares[s], s) for s in left
                     if ran[s] * cycle // shares[s] <= t - start]
            source = min(ready, key=lambda x: (x[0], x[1], x[2]))[2]
            out.append((source, done[source], t))
            ran[source] += 1
            done[source] += 1
            left[source] -= 1
            t += 1
            if not left[source]:
                del left[source]
                break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_phases_equal_earliest_deadline_first_slot_by_slot(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.randint(1, 60) for i in range(5)}
    weights = {s: rng.random() + 0.05 for s in blocks}
    cycle = 20
    got = []
    for p in mixing.phases(blocks, weights, cycle):
        places = {s: [t for t, x in enumerate(p["slots"]) if x == s] for s in p["shares"]}
        for s, n in p["ran"].items():
            for j in range(n):
                a = p["shares"][s]
                got.append((s, p["first"][s] + j, p["start"] + j // a * cycle + places[s][j % a]))
    # Releases and deadlines repeat by the cycle, where ties may fall either way.
    assert sorted(t for _, _, t in got) == list(range(sum(blocks.values())))
    expected = _simulated(blocks, weights, cycle)
    assert sorted((s, j) for s, j, _ in got) == sorted((s, j) for s, j, _ in expected)
    assert sorted(got) == sorted(expected)


def test_every_source_stays_within_one_block():
    shares = mixing.rounded({"a": 0.5, "b": 0.3, "c": 0.19, "d": 0.01})
    assert sum(shares.values()) == mixing.CYCLE
    slots, seen = mixing.one_cycle(shares), Counter()
    for t, s in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[x] - t * a / mixing.CYCLE) < 1 for x, a in shares.items())


def test_rounding():
    assert mixing.rounded({"a": 1e-9, "b": 1.0}, 10) == {"a": 1, "b": 9}
    assert sum(mixing.rounded({str(i): 1 / 7 for i in range(7)}, 1000).values()) == 1000
    with pytest.raises(ValueError):
        mixing.rounded({str(i): 1 for i in range(11)}, 10)


@pytest.mark.parametrize("sources", [20, 300, 1200])
def test_dealt_stays_within_one_block_of_the_target_itself(sources):
    """One source at a fifth, the rest uneven, until the first one ends."""
    rng = random.Random(sources)
    counts = {"big": 4000} | {f"s{i}": rng.randint(20, 400) for i in range(sources - 1)}
    want = mixing.targets(counts, {"big": 0.2})
    seen, slots, heaviest = Counter(), 0, sorted(want, key=want.get)[-20:]
    for t, (phase, s, block) in enumerate(mixing.dealt(counts, want), 1):
        if phase:
            break
        assert block == seen[s]
        seen[s] += 1
        slots = t
        if t % 7 == 0:
            assert all(abs(seen[x] - t * want[x]) < 1 + 1e-6 for x in (s, *heaviest))
    assert all(abs(seen[x] - slots * want[x]) < 1 + 1e-6 for x in want)
    assert sorted(s for _, s, _ in mixing.dealt(counts, want)) == sorted(s for s, n in counts.items() for _ in range(n))


def test_rounding_by_plain_largest_remainders():
    want = {"big": 0.2} | {f"s{i}": 0.8 / 299 for i in range(299)}
    assert mixing.rounded(want, 1000)["big"] == 200


def test_schedule_by_exact_weights_and_more_sources_than_a_cycle(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_BLOCKS", 4)  # sources of several parts
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 1501}") for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.schedule(table, {"hot": 0.2}, block_rows=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(6000))
    by_slot = sorted(got, key=lambda r: r.slot)
    assert [r.slot for r in by_slot] == [r.position for r in by_slot] == list(range(6000))
    counts = Counter(s for _, s in rows)
    assert [(r.phase, r.source, r.block) for r in by_slot] == list(mixing.dealt(
        {s: counts[s] for s in counts}, mixing.targets(counts, {"hot": 0.2})))
    first = [r for r in by_slot if r.phase == 0]
    assert abs(sum(r.source == "hot" for r in first) - 0.2 * len(first)) < 1


def test_schedule_places_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)  # many buckets in a small table
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.schedule(table, {"hot": 0.1}, block_rows=4, cycle=100).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    assert len({r.position for r in got}) == 3000
    sizes = Counter(s for _, s in rows)
    for s, n in sizes.items():
        assert sorted(r.number for r in got if r.source == s) == list(range(n))
    assert all(r.block == r.number // 4 and r.position == r.slot * 4 + r.number % 4 for r in got)
    slots = {r.slot for r in got}
    assert slots == set(range(len(slots)))
    # The hot source is held to a tenth while the others last.
    first = [r for r in got if r.phase == 0]
    assert sum(r.source == "hot" for r in first) / len(first) == pytest.approx(0.1, abs=0.02)


def test_mix_keeps_rows_and_columns(spark):
    table = docs(spark)
    out = mixing.mix(table, {"s0": 0.5, "unknown": 0.2})
    assert out.columns == table.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, table.collect()))
    assert mixing.schedule(table).count() == table.count()


def test_empty_table(spark):
    table = docs(spark).limit(0)
    assert mixing.schedule(table).count() == 0 and mixing.mix(table).count() == 0
