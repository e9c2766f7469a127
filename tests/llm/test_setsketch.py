"""MinHash near-dedup against brute force over planted texts, and on made cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from loglattice.llm import setsketch


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    """(id, text) rows to (id, set size, smallest id reachable)."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((d, len(sets[i]), rows[find(i)][0]) for i, (d, _) in enumerate(rows))


def run(spark, rows, parts=4):
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got)


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(rng, base, n):
    out = base[:]
    for at in rng.sample(range(5, len(base) - 5), n):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def test_planted_near_copies(spark):
    """A changed word spoils five of 116 shingles: one leaves 0.92 and two 0.84, so links are between copies of one change, or by way of the base."""
    rng, texts = random.Random(1), []
    for _ in range(25):
        base = words(rng, 120)
        texts += [base, *(changed(rng, base, rng.choice((1, 2, 3, 6))) for _ in range(3))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute(rows)
    assert 25 < len({c for *_, c in want}) < 90
    assert run(spark, rows) == want


def test_texts_full_of_boilerplate(spark):
    """Sixty pairs share one block of 352 words; each pair is at about 0.87, texts of different pairs at about 0.77 and in the same cells."""
    rng, rows = random.Random(2), []
    block = words(rng, 352)
    for i in range(60):
        own = words(rng, 48)
        rows += [(2 * i, " ".join(block + own)), (2 * i + 1, " ".join(block + own[:24] + words(rng, 24)))]
    want = brute(rows)
    assert len({c for *_, c in want}) == 60
    assert run(spark, rows) == want


def test_large_group_around_its_base(spark):
    """Copies at 0.92 of the base and 0.84 of each other are connected by the base alone, which is not the smallest node."""
    rng = random.Random(3)
    base = words(rng, 120)
    rows = [(i, " ".join(changed(rng, base, 1))) for i in range(150)] + [(900, " ".join(base))] + [(1000 + i, " ".join(words(rng, 60))) for i in range(20)]
    assert run(spark, rows) == brute(rows)


def test_long_chains_and_large_cells(spark):
    """Each text changes one more word of the one before, so only neighbours are similar while hundreds share a cell."""
    rng, rows = random.Random(5), []
    text = words(rng, 200)
    for i in range(80):
        rows.append((i, " ".join(text)))
        text = changed(rng, text, 3)
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    text = "One small boat leaves the harbour every morning before the sun is up"
    rows = [
        (7, text), (3, text.upper().replace(" ", "\n")), (3, text), (None, text), (1, None), (2, ""), (4, " \t\v "), (5, "just three words"), (6, "JUST three\fwords"),
        (8, "just three"), (9, " ".join(f"w{i % 9999}" for i in range(60_000))), (None, None),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string").selectExpr("*", "1 as n", "'c' as component_id", "0 as key")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(table).collect()), key=str)
    want = [(7, 9, 3, False), (3, 9, 3, True), (3, 9, 3, True), (None, 9, 3, False), (1, 0, 1, True), (2, 0, 2, True), (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False),
            (8, 1, 8, True), (9, 9999, 9, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert setsketch.near_duplicates(table.where("false")).count() == 0


def test_registers_merge_and_estimate():
    rng = random.Random(9)
    sets = {}
    pool = words(rng, 3000)
    for k, (a, b) in {"left": (0, 2000), "right": (400, 2600), "all": (0, 2600)}.items():
        sets[k] = np.unique(np.array([hash(("s", w)) & (2**64 - 1) for w in pool[a:b]], np.uint64))
    number = 1200
    one = {k: setsketch.registers(setsketch.mix(v), np.array([len(v)]), number) for k, v in sets.items()}
    assert (setsketch.merged(one["left"], one["right"]) == one["all"]).all()
    x, y = one["left"], one["right"]
    similarity = len(np.intersect1d(sets["left"], sets["right"])) / len(sets["all"])
    got = setsketch.likely_similarity((x > y).sum(axis=1), (x < y).sum(axis=1), number, np.array([2000.0]), np.array([2200.0]))[0]
    assert got == pytest.approx(similarity, abs=0.06)


def test_a_pair_at_the_bound_is_hardly_missed():
    """Measured share of pairs at 0.85 that share a band, over pairs of random sets."""
    rng, found, pairs = np.random.default_rng(4), 0, 400
    bands = setsketch.bands_for(85)
    assert bands == 24 and (1 - 0.85**setsketch.ROWS) ** bands <= setsketch.MISS
    for _ in range(pairs):
        h = rng.integers(0, 2**63, 215, dtype=np.uint64) * np.uint64(2)
        both = np.concatenate([h[:200], np.delete(h, slice(170, 200))[:185]])
        keys = setsketch.band_keys(setsketch.registers(both, np.array([200, 185]), bands * setsketch.ROWS), bands)
        found += bool((keys[0] == keys[1]).any())
    assert found == pairs


def test_shingles_are_counted_once():
    texts = pa.array(["a b c d e f a b c d e f", "A B C D E", None, "a b", ""], pa.large_string())
    hashes, counts = setsketch.shingle_sets(texts)
    assert counts.tolist() == [6, 1, 0, 1, 0] and hashes[6] in hashes[:6]
