"""Operators that SQL cannot express, against brute force; and methods on made cases."""

import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from loglattice.llm import components, cotrain, decontam, langid, linespread, mixing, quality, queries, simhash, urltree, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, bits=2):
    """(doc_id, fingerprint) rows to the smallest id of each component."""
    root = {p: p for _, p in rows}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    prints = list(root)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for doc_id, p in rows:
        least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return {doc_id: least[find(p)] for doc_id, p in rows}


def test_simhash_equals_brute_force(spark, docs):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    got = {r["doc_id"]: r for r in queries.simhash_popcount(spark, SF).collect()}
    assert {k: r["fingerprint"] for k, r in got.items()} == {k: f"{p:016x}" for k, p in rows}
    assert {k: r["component_id"] for k, r in got.items()} == brute_classes(rows)


def test_links_of_close_fingerprints_are_complete(spark):
    rng = random.Random(4)
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints |= {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(12)}
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    want = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)


def test_components_of_chain_star_and_pair(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}


def test_leaks_equal_containment_and_find_templates(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = docs.collect()
    want = {(d["doc_id"], b["item_id"]) for b in bench.collect() for d in texts if b["text"].lower() in (d["text"] or "").lower()}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}
    assert want and got == want
    item = "Last year Marta bought 12 kg of apples for 30 euros and later Marta sold 5 kg to Peter at the market."
    cases = {
        "exact": (item, True), "template": (item.replace("Marta", "Anna").replace("12", "48").replace("Peter", "Olaf"), True),
        "inconsistent": (item.replace("Marta", "Anna", 1).replace("12", "7"), False), "other": ("The weather stays calm " * 8, False),
    }
    block = decontam.block_of([9], [item])
    for name, (text, leak) in cases.items():
        hits = list(decontam.leaks(pa.array([f"Before it came this: {text} And more came after it."], pa.large_string()), block))
        assert bool(hits) == leak, name
        if name == "template":
            assert hits[0][4] > 0
    assert list(decontam.leaks(pa.array([f"so {cases['exact'][0]}"], pa.large_string()), block))[0][4] == 0


def found(item, text):
    texts = pa.array([f"Something else stood there first. {text} Then the page went on as before."], pa.large_string())
    return [hit[4] for hit in decontam.leaks(texts, decontam.block_of([1], [item]))]


def test_leaks_through_slots_of_other_length_and_short_items():
    words = [f"{a}{b}" for a in ("ba", "ko", "lu", "mi", "ne") for b in ("rt", "sk", "nd", "lm", "fe", "gg")]
    named = " ".join([*words[:15], "Mary", *words[15:]])
    assert found(named, named.replace("Mary", "Anna")) == [1] and found(named, named.replace("Mary", "Mary Ann")) == [1]
    measured = " ".join([*words[:12], "3 km", *words[12:24]])
    assert found(measured, measured.replace("3 km", "3km")) == [0] and found(measured, measured.replace("3 km", "17 km")) == [1]
    for n in (14, 22, 23, 30):
        item = " ".join(words[:n])
        for at in range(n):  # one plain word changed, lost or added anywhere
            for new in (["other"], [], [words[at], "other"]):
                assert found(item, " ".join([*words[:at], *new, *words[at + 1 : n]])) == [0], (n, at, new)
    assert found(" ".join(words[:14]), " ".join(words[:7])) == [] and found(" ".join(words[:6]), " ".join(words[:6])) == [0]
    assert found(" ".join(words[:6]), " ".join(words[:5])) == [] and found(" ".join(words[:3]), " ".join(words[:3])) == []
    # the name stands twice: the same value must do so in the document, also across a word that shifts the second half
    twice = " ".join([*words[:10], "Mary", *words[10:20], "Mary", *words[20:]])
    moved = twice.replace(words[9], "two words").replace(words[18], "two words")  # no part alone covers half
    assert found(twice, moved.replace("Mary", "Anna")) == [2] and found(twice, moved.replace("Mary", "Anna", 1)) == []
    assert found(twice, f"{twice.replace('Mary', 'Olga', 1)} {twice}") == [0]


def test_chains_equal_full_search():
    rng = random.Random(3)
    for _ in range(300):
        parts = sorted({(rng.randrange(30), rng.randrange(12), rng.randrange(1, 6)) for _ in range(rng.randrange(1, 7))})

        def value(rest, last):
            best = 0
            for i, (p, q, n) in enumerate(rest):
                both = max(last[1] + last[2] - q, last[0] + last[2] - p, 0) if last else 0
                if not last or (last[0] < p and last[1] < q and both < n and abs(p - q - last[0] + last[1]) <= 3):
                    best = max(best, n - both + value(rest[i + 1 :], (p, q, n)))
            return best

        assert max(sum(n for _, _, n in c) for c in decontam.chains(parts, 3, 100)) == value(parts, None)


def test_benchmark_blocks_lose_no_item(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontam.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1500)
    assert len(list(decontam.benchmark_blocks(bench))) > 1
    assert sorted(map(tuple, decontam.find_leaks(docs, bench).collect())) == whole
    clean = docs.count() - len({r[0] for r in whole})
    assert decontam.drop_leaks(docs, bench).count() == clean


def test_rule_order_does_not_change_the_verdict(docs):
    names = list(quality.RULES)
    kept = [sorted(r["doc_id"] for r in quality.quality_filter(docs, order=o).collect()) for o in (names, names[::-1], quality.rule_order(docs))]
    assert kept[0] == kept[1] == kept[2] and sorted(quality.rule_order(docs)) == sorted(names)


def test_best_order_counts_only_what_is_left():
    names = list(quality.RULES)
    bit = {name: 1 << i for i, name in enumerate(names)}
    costs = dict.fromkeys(names, 1.0)
    # "symbols" rejects nothing that "too_short" leaves, so "shouting" goes before it although it rejects fewer rows in all.
    rows = {bit["too_short"] | bit["symbols"]: 50, bit["shouting"]: 10, 0: 40}
    order = quality.best_order(rows, costs, 0.0)
    assert order[:2] == ["too_short", "shouting"] and sorted(order) == sorted(names)
    # A rule that needs no words goes first while splitting is dear; afterwards splitting costs nothing more.
    assert quality.best_order({bit["duplicate_lines"]: 10, bit["too_short"]: 10, 0: 80}, costs, 100.0)[0] == "duplicate_lines"
    assert quality.best_order({bit["duplicate_lines"]: 10, bit["too_short"]: 30, 0: 60}, costs, 0.0)[0] == "too_short"
    assert quality.best_order({}, {}, 0.0) == quality.best_order({}, {}, 0.0)


def test_viterbi_equals_full_search():
    rng = np.random.default_rng(8)
    scores, sizes = rng.normal(0, 3, (9, 3)), np.array([1, 6, 0, 4])
    codes = rng.integers(0, 9, sizes.sum())
    got, at = langid.viterbi(scores, codes, sizes, 2.5), 0
    for n in sizes:
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else np.zeros((1, 0), int)
        value = lambda p: sum(scores[c, s] for c, s in zip(codes[at : at + n], p)) - 2.5 * sum(p[1:] != p[:-1])  # noqa: B023, E731
        assert value(got[at : at + n]) == pytest.approx(max(map(value, paths)))
        at += n


def test_language_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.mixed_language(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) > 0.97 * len(got) > 100
    made = spark.createDataFrame(
        [(i, t * 5, lang) for i in range(40) for t, lang in (("the house and the garden with water ", "en"), ("дом и сад с водой ", "ru"), ("le chat et la maison des voisins ", "fr"))],
        "doc_id long, text string, lang string")
    mixed = spark.createDataFrame([(1, "the house and the garden with water le chat et la maison des voisins дом и сад")], "doc_id long, text string")
    spans = langid.identify(mixed, langid.train(made)).first()["spans"]
    assert [(s["lang"], s["start"], s["stop"]) for s in spans] == [("en", 0, 7), ("fr", 7, 14), ("ru", 14, 17)]


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(100 * n + i, f"own {n} {i}\nshared by {n}", f"s{i}") for n in range(1, 14) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spread = linespread.boilerplate(docs, min_sites=8).collect()
    assert len(spread) == 6 and {r["first_id"] for r in spread} == {100 * n for n in range(8, 14)}
    cut = {r["doc_id"]: r["text"] for r in linespread.remove_boilerplate(docs, min_sites=8).collect()}
    assert cut[800] == "own 8 0\nshared by 8" and cut[801] == "own 8 1" and cut[701] == "own 7 1\nshared by 7"


def test_shortage_goes_to_siblings_first(spark):
    tiny = [("web", "en", "src0", 10), ("web", "en", "src1", 1000), ("web", "de", "src2", 1000), ("books", "en", "src4", 5)]
    leaves = spark.createDataFrame(tiny, "domain string, language string, origin string, tokens long")
    got = {r["origin"]: r["budget"] for r in mixing.leaf_budgets(leaves, 600, 1).collect()}
    # books can take 5 of its 3/7, web gets 595; en gets two thirds, src0 is short and its sibling src1 takes the rest.
    assert got == {"src4": 5, "src0": 10, "src1": 595 * 4 // 6 - 10, "src2": 595 * 2 // 6}


def _filled(children, given):
    """Water filling by one sort: (capacity, weight) per child to its budget."""
    spare, weight_left, out = given, sum(w for _, w in children.values()), {}
    order = sorted(children, key=lambda k: (children[k][0] / children[k][1], k))
    for at, k in enumerate(order):
        capacity, weight = children[k]
        if capacity * weight_left > weight * spare:
            return out | {j: spare * children[j][1] // weight_left for j in order[at:]}
        out[k] = capacity
        spare, weight_left = spare - capacity, weight_left - weight
    return out


def test_water_level_equals_one_sort_for_many_children_ties_and_large_numbers(spark):
    rng = random.Random(5)
    cases = {
        "many": ({f"c{i}": (int(rng.paretovariate(0.8) * 50), rng.randint(1, 9)) for i in range(400)}, 60_000),
        "ties": ({f"c{i}": (100 * (1 + i % 3), 1 + i % 3) for i in range(60)}, 7_000),
        "large": ({f"c{i}": (10**13 + 10**12 * i, 10**6 + i) for i in range(40)}, 4 * 10**14),
        "all full": ({"a": (5, 1), "b": (7, 3)}, 100), "nothing to share": ({"a": (5, 1), "b": (7, 3)}, 0), "no capacity": ({"a": (0, 1), "b": (7, 3)}, 5),
    }
    rows = [(case, k, w, c, given) for case, (children, given) in cases.items() for k, (c, w) in children.items()]
    table = spark.createDataFrame(rows, "parent string, child string, weight long, capacity long, given long")
    got = {(r["parent"], r["child"]): r["budget"] for r in mixing.pour(table, ["parent"], "child").collect()}
    assert got == {(case, k): v for case, (children, given) in cases.items() for k, v in _filled(children, given).items()}


def test_mixing_prefix_equals_a_full_sort(spark, docs):
    got = mixing.mix(docs, seed=3, slim=True).collect()
    again = mixing.mix(docs.repartition(5), seed=3, slim=True).collect()
    other = mixing.mix(docs, seed=4, slim=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) != sorted(map(str, other))
    total = sum(len(WORD.findall(r["text"] or "")) for r in docs.collect())
    used = sum(r["n_tokens"] * r["copies"] for r in got)
    assert 0.3 * total < used <= total * mixing.BUDGET_PERCENT / 100


def test_archives_have_a_dictionary_and_survive_a_round_trip(spark, tmp_path):
    rng = random.Random(1)
    body = lambda i: "<html><head><title>Common head of all pages</title></head>" + "".join(rng.choices(string.ascii_letters + "é漢", k=900 + 10 * i))
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(60)]
    path = warc.write_archives(spark.createDataFrame(rows + [(99, "http://h.example/copy", rows[5][2])], "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    (file,) = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    data = file.read_bytes()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY
    records = list(warc.records_of(data))
    stored = {int(re.search(rb"x-page:(\d+)", r)[1]): r.split(b"\r\n\r\n", 2)[2][:-4].decode() for r in records if b"WARC-Type: response" in r}
    assert stored == {i: h for i, _, h in rows if i != 5} | {99: rows[5][2]}
    assert [r["refers_to"] for r in warc.read_archives(spark, path).where("page_id = 5").collect()] == [99]


def test_templates_reject_by_purity(spark):
    rules = (urltree.Rule("block", "bad.example", "/x/"), urltree.Rule("allow", "good.example", "/"))
    urls = [f"http://a.bad.example/x/{i}" for i in range(30)] + [f"http://good.example/p/{i}" for i in range(30)] + ["http://q.example/z/1", "http://a.bad.example/y"]
    got = urltree.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    assert Counter((r["rule"], r["verdict"]) for r in got) == {("bad.example/x/", "block"): 30, ("good.example/", "allow"): 30, (None, "allow"): 1, (None, "block"): 1}
    assert {r["page_id"]: r["verdict"] for r in got if r["rule"] is None} == {60: "allow", 61: "block"}
    many = [f"http://v.example/u/name{chr(97 + i)}x/{'p' if i % 2 else 'q'}" for i in range(12)]
    shown = {r["template"] for r in urltree.judge(spark.createDataFrame(list(enumerate(many)), "page_id long, url string")).collect()}
    assert shown == {"/u/*/p", "/u/*/q"}


def test_co_training_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    even, odd = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = cotrain.score(docs, cotrain.train(docs, even)).join(odd, "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in got) > 0.97 * len(got) > 1000
    assert cotrain.train(docs, labels.withColumn("quality", F.lit(1))) is None


def test_pipeline_equals_its_stages_by_brute_force(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    verdict = {r["doc_id"] for r in quality.quality_measures(docs, ["doc_id"]).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == verdict

    cut = stages["line_dedup"](spark, kept, SF)
    before = kept.collect()
    holders = {}
    bare = lambda line: line.strip(" \t\n\v\f\r")
    for r in before:
        for line in {bare(x) for x in r["text"].split("\n")} - {""}:
            holders.setdefault(line, []).append((r["source"], r["doc_id"]))
    first = {k: min(d for _, d in v) for k, v in holders.items() if len({s for s, _ in v if s is not None}) >= linespread.MIN_SITES}
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if first.get(bare(x), r["doc_id"]) == r["doc_id"]) for r in before}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want

    single = stages["near_dedup"](spark, cut, SF)
    classes = brute_classes([(k, brute_print(v)) for k, v in want.items()])
    assert {r["doc_id"] for r in single.collect()} == set(classes.values())

    clean = stages["decontamination"](spark, single, SF)
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {k for k in classes.values() if not any(i in want[k].lower() for i in items)}
    assert {r["doc_id"] for r in clean.collect()} == left

    mixed = {r["doc_id"]: r["copies"] for r in stages["source_mixing"](spark, clean, SF).collect()}
    assert mixed == {r["doc_id"]: r["copies"] for r in mixing.mix(clean, slim=True).collect()} and set(mixed) <= left
    assert {r["doc_id"]: r["copies"] for r in corpus_pipeline.run(spark, SF).collect()} == mixed


@pytest.mark.parametrize("name", [k for k, v in queries.CATALOG.items() if v[1]])
def test_query_equals_its_sql(spark, name):
    import pathlib
    import sys

    import duckdb

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))
    from check_queries import TABLES, rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.CATALOG[name][0](spark, SF)
    cur = con.execute(queries.CATALOG[name][1])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cur.fetchall())
