"""What the url tree, the ownership counts and the co-training rounds learn, against plain loops and made cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglattice.llm import cotrain, credentials, quality, urltree

RULES = (urltree.Rule("block", "bad.example", "/x/"), urltree.Rule("allow", "good.example", "/"))


def judged(spark, urls, rules=RULES):
    rows = urltree.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    return {urls[r["page_id"]]: r for r in rows}


def test_an_unruled_url_takes_after_its_nearest_labelled_ancestor(spark):
    urls = [f"http://a.bad.example/x/{i}" for i in range(30)] + [f"http://good.example/p/{i}" for i in range(30)]
    urls += ["http://a.bad.example/y/1/deep/er/than/four/a", "http://a.bad.example/y/1/deep/er/than/four/b", "http://new.example/z", "http://a.bad.example/"]
    got = judged(spark, urls)
    assert {got[u]["verdict"] for u in urls[60:62]} == {"block"} and got[urls[62]]["verdict"] == "allow" and got[urls[63]]["verdict"] == "block"
    host = (30 + 4 * 0.5) / (30 + 4)
    assert got[urls[62]]["purity"] == 0.5 and got[urls[63]]["purity"] == pytest.approx((0 + 4 * host) / 4, abs=1e-6)
    assert got[urls[60]]["template"] == "/y/{n}/deep/er/than/four/a"


def test_branches_below_the_fourth_segment_are_told_apart(spark):
    rules = (urltree.Rule("block", "h.example", "/a/b/c/d/bad/"), urltree.Rule("allow", "h.example", "/a/b/c/d/fine/"))
    urls = [f"http://h.example/a/b/c/d/bad/n{i}" for i in range(20)] + [f"http://h.example/a/b/c/d/fine/n{i}" for i in range(20)]
    got = judged(spark, urls, rules)
    assert all(got[u]["purity"] > 0.8 for u in urls[:20]) and all(got[u]["purity"] < 0.3 for u in urls[20:])
    assert {got[u]["template"] for u in urls} == {"/a/b/c/d/bad/n{n}", "/a/b/c/d/fine/n{n}"}


def test_unlabelled_siblings_of_one_shape_and_count_are_merged(spark):
    urls = [f"http://s.example/t{w}/{k}" for w in ("one", "two", "six", "ten") for k in ("p", "q", "r")] + [f"http://s.example/a-b/{chr(97 + i)}" for i in range(3)]
    assert {r["template"].split("/")[1] for r in judged(spark, urls).values()} == {"~a", "a-b"}


def test_a_value_in_many_repositories_of_one_owner_is_no_live_secret(spark):
    secret = {k: f"Zq81KdPw73Mm{k}Xc02LbTe" for k in "abcd"}
    rows = [(1, f"x {secret['a']} y", "o1", "r1")] + [(10 + i, f"x {secret['b']} y", "o1", f"r{i}") for i in range(5)]
    rows += [(20 + i, f"x {secret['c']} y", f"o{i}", "r") for i in range(3)] + [(30 + i, f"x {secret['d']} y", "o9", f"r{i}") for i in range(2)] + [(40, f"x {secret['d']}z", None, None)]
    got = {r["doc_id"]: r for r in credentials.scan(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    live = {k for k, r in got.items() if "live:" in r["spans"]}
    assert live == {1, 30, 31, 40} and {k for k, r in got.items() if r["n_copied"]} == {10, 11, 12, 13, 14, 20, 21, 22}


def test_thresholds_take_the_most_confident_rows_of_each_group():
    rng = random.Random(1)
    rows = [(g, rng.choice([-1, 1]) * rng.randrange(0, 9)) for g in (0, 1, 5) for _ in range((200, 30, 4)[(0, 1, 5).index(g)])]
    held = {}
    for g, b in rows:
        if b:
            held[g, b] = held.get((g, b), 0) + 1
    sizes = {g: sum(x == g for x, _ in rows) for g in (0, 1, 5)}
    got = cotrain.thresholds(held, sizes, 0.1, 0.7)
    edge, weight = np.full((6, 2), 10**9), np.zeros((6, 2))
    for (g, sign), (b, w) in got.items():
        edge[g, 0 if sign > 0 else 1], weight[g, 0 if sign > 0 else 1] = b, w
    label, rated = cotrain.chosen(np.array([b for _, b in rows]), np.array([g for g, _ in rows]), edge, weight)
    for g, size in sizes.items():
        for sign, part in ((1, 0.7), (-1, 0.3)):
            mine = [(b * sign, r) for (x, b), r in zip(rows, rated, strict=True) if x == g and b * sign > 0]
            assert sum(r for _, r in mine) == pytest.approx(min(0.1 * size * part, len(mine)))
            for b, r in mine:  # nobody less confident counts more
                assert all(r2 <= r for b2, r2 in mine if b2 < b)
    assert all(y == (b > 0) for (_, b), y, r in zip(rows, label, rated, strict=True) if r)


def test_a_round_over_tasks_equals_one_over_all_rows(spark):
    rng = np.random.default_rng(3)
    n = 900
    text = rng.normal(size=(n, 14)).astype(np.float32)
    places = np.column_stack([rng.integers(0, 30, n), rng.integers(30, 64, n), rng.integers(64, 80, n)])
    meta = np.zeros((n, cotrain.META_BUCKETS + 24))
    for k in range(3):
        meta[np.arange(n), places[:, k]] = 1
    truth = (text[:, 0] + 0.3 * rng.normal(size=n) > 0).astype(float)
    labelled = [(text[:300].astype(float), truth[:300]), (meta[:300], truth[:300])]
    models = [cotrain.fit(*x) for x in labelled]
    groups = rng.integers(0, 5, n)
    rows = [(int(g), [float(v) for v in a], [int(v) for v in m]) for g, a, m in zip(groups[300:], text[300:], places[300:], strict=True)]
    pool = spark.createDataFrame(rows, "grp int, a array<float>, m array<smallint>").repartition(5)
    got = cotrain.exchange(models, labelled, pool, 0.25, 0.2)

    views = text[300:].astype(float), meta[300:]
    bins = [cotrain.confidence_bins(m.logit(v)) for m, v in zip(models, views, strict=True)]
    want, picked = list(models), []
    for k in (0, 1):
        held = {}
        for g, b in zip(groups[300:], bins[k], strict=True):
            if b:
                held[int(g), int(b)] = held.get((int(g), int(b)), 0) + 1
        found = cotrain.thresholds(held, {int(g): int((groups[300:] == g).sum()) for g in set(groups[300:])}, 0.2, float(truth[:300].mean()))
        rated = np.zeros(n - 300)
        for i, (g, b) in enumerate(zip(groups[300:], bins[k], strict=True)):
            edge = found.get((int(g), int(np.sign(b))))
            rated[i] = 0 if not b or edge is None or abs(b) < edge[0] else edge[1] if abs(b) == edge[0] else 1
        picked.append(((bins[k] > 0).astype(float), rated))
    for _ in range(cotrain.STEPS):
        want = [cotrain.stepped(want[k], cotrain.sums_of(want[k], *labelled[k]), cotrain.sums_of(want[k], views[k], *picked[1 - k]), 0.25) for k in (0, 1)]
    for a, b in zip(got, want, strict=True):
        assert np.abs(a.weights - b.weights).max() < 1e-6
    assert np.abs(got[0].weights - models[0].weights).max() > 1e-3


def test_training_takes_nulls_contradictions_and_empty_tables(spark):
    rows = [(i, f"some words about thing {i} and more of them" if i % 2 else "#### $$$ %%%", "en", f"s{i % 3}", i) for i in range(80)]
    rows += [(None, "no id", "en", "s1", 3), (200, None, None, None, None), (201, "", "", "", 0), (1, rows[1][1], "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("label", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (7, 0), (300, 1)], "doc_id long, quality int")
    model = cotrain.train(docs, labels)
    got = cotrain.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["kept"] == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] is not None and r["doc_id"] < 80) >= 78
    assert cotrain.train(docs.where("false"), labels) is None and cotrain.train(docs, labels.where("false")) is None
    assert {r["score"] for r in cotrain.score(docs, None).collect()} == {0.5}


def test_checking_sql_states_the_rules_for_all_scripts(spark):
    import duckdb

    from loglattice.llm.oracles import QUALITY

    texts = ["Вчера представители NATO сообщили журналистам что переговоры в столице продолжатся до конца этой недели", "ВЧЕРА ПРЕДСТАВИТЕЛИ СООБЩИЛИ ЖУРНАЛИСТАМ ЧТО ПЕРЕГОВОРЫ В СТОЛИЦЕ ИДУТ ДОЛГО",
             "、 ".join("東京の天気は明日から少しずつ良くなると言われ" + chr(0x4E00 + i) for i in range(12)), " ".join("abcdefghijklmnopqrstuvwx" + chr(97 + i) for i in range(12)), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    cur = con.execute(QUALITY)
    names = [d[0] for d in cur.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r, strict=True)) for r in cur.fetchall()}
    got = {r["doc_id"]: r.asDict() for r in quality.quality_measures(docs, ["doc_id"]).collect()}
    assert got == want and [got[i]["kept"] for i in range(4)] == [True, False, True, False]
