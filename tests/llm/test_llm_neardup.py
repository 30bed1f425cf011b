import random

import numpy as np
import pyarrow as pa
import pytest

from clinilake.llm import neardup, shingles
from llm_data import docs, prose


def _sets(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    words = [w for part in words for w in part.replace("\t", "\n").split("\n") if w]
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def _brute(rows, width, percent):
    """component of each doc_id by all pairs."""
    sets = [(i, _sets(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in parent}


def test_groups_match_all_pairs(spark):
    table = docs(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    for width, percent in ((5, 80), (3, 85)):
        got = neardup.groups(table, width, percent).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == _brute(rows, width, percent)
        sizes = {i: len(_sets(t, width)) for i, t in rows}
        assert all(r.n_shingles == sizes[r.doc_id] for r in got)
        assert [r.kept for r in got if r.doc_id is None] == [True]


def test_chains_across_many_near_copies(spark):
    """Each copy changes one word more: neighbours link, ends do not."""
    rng = random.Random(9)
    words = prose(rng, 120).split()
    rows = []
    for i in range(60):
        words = list(words)
        words[(i * 37) % len(words)] = f"new{i}"
        rows.append((100 - i, " ".join(words)))
    rows += [(1000 + i, prose(rng, 120)) for i in range(60)] + [(2000 + i, rows[0][1]) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.groups(table, 3, 85).collect()}
    assert got == _brute(rows, 3, 85)


def test_one_id_with_two_texts_is_one_node(spark):
    rng = random.Random(2)
    a, b, c = prose(rng, 50), prose(rng, 50), prose(rng, 50)
    table = spark.createDataFrame([(5, a), (5, b), (3, a), (4, b), (9, c)], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in neardup.groups(table).collect())
    assert got == [(3, 3), (4, 3), (5, 3), (5, 3), (9, 9)]


def test_drop_copies_keeps_columns_and_the_smallest(spark):
    table = docs(spark)
    out = neardup.drop_copies(table)
    assert out.columns == table.columns
    kept = _brute([(r.doc_id, r.text) for r in table.collect()], 5, 80)
    assert sorted(r.doc_id or -1 for r in out.collect()) == sorted([-1, *{c for i, c in kept.items()}])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert neardup.groups(empty).count() == 0
    assert neardup.drop_copies(empty).columns == ["doc_id", "text", "extra"]


def test_odd_sketches_estimate_and_never_miss():
    """Sketches of pairs just at the threshold stay under the bound."""
    rng = np.random.default_rng(3)
    bound = neardup.most_bits(85)
    assert 40 < bound < neardup.SKETCH_BITS // 2
    over = []
    for _ in range(300):
        shared = rng.integers(0, 1 << 63, 850, dtype=np.uint64)
        one = np.concatenate([shared, rng.integers(0, 1 << 63, 75, dtype=np.uint64)])
        two = np.concatenate([shared, rng.integers(0, 1 << 63, 75, dtype=np.uint64)])
        marks = neardup._sketches(neardup._samples(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)])))
        apart = int(np.bitwise_count((marks[0] ^ marks[1]).view(np.uint64)).sum())
        over.append(apart)
    assert max(over) <= bound
    # The estimate from the XOR's population count is close to the true similarity.
    k, n = neardup.SAMPLES, neardup.SKETCH_BITS
    estimate = 1 + n / (4 * k) * np.log(1 - 2 * np.mean(over) / n)
    assert estimate == pytest.approx(0.85, abs=0.01)


def test_shingle_hashes_do_not_depend_on_the_block():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(0, 9)) for _ in range(50)] + [None, "", " a ", "A b", "a B", "w" * 3000 + " x y"]

    def sets(rows):
        out = []
        for _, data, at in shingles.text_blocks(pa.array(rows, pa.string())):
            hashes, starts = shingles.shingle_hashes(*shingles.word_hashes(data, at), 3)
            out += [frozenset(hashes[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:])]
        return out

    together, alone = sets(texts), [sets([t])[0] for t in texts]
    assert together == alone
    assert len(set(map(len, together))) > 3 and sets(["A b"]) == sets([" a\tB "])
    for t, s in zip(texts, together):
        assert len(s) == len(_sets(t, 3))


def test_bands_keep_the_miss_bound_at_every_threshold():
    for percent in range(4, 101):
        bands, rows = neardup.banding(percent)
        assert bands * rows <= neardup.SAMPLES and (1 - (percent / 100) ** rows) ** bands <= 1e-7
    assert neardup.banding(85) == (22, 4)


def test_signatures_hold_the_bands_of_their_threshold():
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two three four five six seven"])], names=["doc_id", "text"])
    for percent in (50, 80, 85):
        out = next(iter(neardup._signatures(5, percent)(iter([batch]))))
        assert len(out.column("bands")[0]) == neardup.banding(percent)[0]


def test_rows_of_one_doc_id_with_other_texts_stay(spark):
    a, b, c = ("one text that has quite a few words in it", "another text with words of its own to tell", "a third one")
    rows = [(7, a, "x"), (7, a, "x"), (7, b, "y"), (8, c, "x"), (8, c, "z"), (None, a, "x"), (None, a, "x"), (9, None, "q"), (9, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or 0, r.text or "", r.source) for r in neardup.drop_copies(docs).collect())
    assert got == sorted([(0, a, "x"), (0, a, "x"), (7, a, "x"), (7, b, "y"), (8, c, "x"), (9, "", "q")])


def _loose_copies(rng, n, words=120, changed=4):
    """Copies of one text that share buckets but seldom reach 85 %."""
    base = prose(rng, words).split()
    out = []
    for i in range(n):
        own = list(base)
        for k in rng.sample(range(len(own)), changed):
            own[k] = f"other{i}x{k}"
        out.append(" ".join(own))
    return out


def test_later_rounds_work_on_ties_between_components_alone(spark, monkeypatch):
    """A crowd of loose copies: only the first round sees the links of the copies."""
    rng = random.Random(12)
    loose = _loose_copies(rng, 40)
    rows = [(i, t) for i, t in enumerate(loose)] + [(100 + i, f"{t} one more") for i, t in enumerate(loose)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    seen, components = [], neardup.components

    def counted(edges):
        seen.append(edges.where("a <> b").distinct().count())
        return components(edges)

    monkeypatch.setattr(neardup, "components", counted)
    got = {r.doc_id: r.component_id for r in neardup.groups(table, 3, 85).collect()}
    want = _brute(rows, 3, 85)
    assert got == want and len(set(want.values())) > 20
    assert seen[0] >= 20 and all(n < seen[0] / 2 for n in seen[1:])


def test_more_links_join_whole_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    found = neardup.components(frame(links[:30]))
    got = neardup.joined_components(found, frame(links[30:])).collect()
    want = neardup.components(frame(links)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 20


def test_a_pair_is_compared_by_lean_code(spark):
    """One intersection a pair, and marks whose code needs no tests for nulls."""
    pair = spark.createDataFrame([([1, 2, 3], [2, 3, 4])], "a array<long>, b array<long>")
    plan = pair.select(neardup._linked("a", "b", 50).alias("x"), neardup._linked("a", "b", 51).alias("y"))
    assert plan.first() == (True, False)
    assert str(neardup._linked("a", "b", 50)).count("array_intersect") == 1
    marks = spark.createDataFrame([(1, [0] * 16)], "n long, sketch array<long>").select(neardup._marks().alias("s"))
    assert not any(f.nullable for f in marks.schema["s"].dataType.fields)


def test_ids_with_two_loose_copies(spark):
    """Rows of one doc_id in different buckets of one crowd."""
    rng = random.Random(21)
    rows = [(i % 30, t) for i, t in enumerate(_loose_copies(rng, 60))]
    got = {r.doc_id: r.component_id for r in neardup.groups(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == _brute(rows, 3, 85)
