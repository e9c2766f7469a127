"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loglattice.llm import cotrain, credentials, decontam, langid, linespread, mixing, quality, simhash, urltree, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))
PLAIN = "Every morning the small boat leaves the harbour and returns before the evening storm reaches the coast again."
ROWS = [
    (1, PLAIN, "en", "src1", 100), (1, PLAIN, "en", "src1", 100), (2, PLAIN.upper(), None, "src2", None), (3, None, "en", None, 0), (4, "", "de", "src1", 0),
    (5, " \n\t\n ", None, None, None), (None, PLAIN, "en", "src3", 100), (None, None, None, None, None), (6, LONG, "en", "src1", len(LONG)), (7, "a\n\nb\n" + PLAIN, "fr", "src2", 5),
    (8, "token = 'Zq81KdPw73MmXc02LbTe' " + PLAIN, "en", "src9", 9),
]
#: Names that the operators use inside, beside the table's own.
EXTRA = ["row_key", "Cut_Lines", "fp", "key", "component_id", "mix_domain", "copies", "line", "site", "n_tokens"]


@pytest.fixture(scope="module")
def tables(spark):
    base = spark.createDataFrame(ROWS, DOCS).coalesce(2)
    clash = base.withColumns({c: F.lit(None).cast("string") if i % 2 else F.lit(7) for i, c in enumerate(EXTRA)})
    return base, clash, base.where("false")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, PLAIN), (2, None), (None, "short")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[s[0] for s in corpus_pipeline.STAGES])
def test_stages_take_any_rows(spark, tables, sf_dir, stage):
    for docs in tables:
        out = stage[1](spark, docs, sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() <= docs.count()
        if stage[0] != "source_mixing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_queries_keep_every_row(spark, tables):
    model = langid.train(tables[0])
    for docs in tables:
        n = docs.count()
        for out in (
            quality.quality_measures(docs, ["doc_id"]), langid.identify(docs, model), simhash.near_duplicates(docs), linespread.remove_boilerplate(docs),
            credentials.scan(docs), cotrain.score(docs, None),
        ):
            assert len(out.collect()) == n


def test_quality_of_edges(tables):
    rows = {r["doc_id"]: r for r in quality.quality_measures(tables[0], ["doc_id"]).collect()}
    assert rows[3]["n_words"] == rows[4]["n_words"] == rows[5]["n_words"] == 0 and rows[3]["base_failed"] and not rows[5]["kept"]
    assert rows[1]["n_words"] == 18 and rows[1]["kept"] and rows[6]["n_words"] == 60_000


def test_quality_of_other_scripts(spark):
    russian = "Вчера представители NATO сообщили журналистам что переговоры в столице продолжатся до конца этой недели"
    japanese = "\u3001 ".join("\u6771\u4eac\u306e\u5929\u6c17\u306f\u660e\u65e5\u304b\u3089\u5c11\u3057\u305a\u3064\u826f\u304f\u306a\u308b\u3068\u8a00\u308f\u308c" + chr(0x4E00 + i) for i in range(12))
    glued = " ".join("abcdefghijklmnopqrstuvwx" + chr(97 + i) for i in range(12))
    texts = [russian, japanese, russian.upper().replace("NATO", "nato"), glued]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in quality.quality_filter(docs).collect()) == [0, 1]


def test_untrained_language_is_unknown(spark, tables):
    model = langid.train(tables[2])
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(tables[0], model).collect()} == {("und", 0.0)}
    trained = langid.identify(tables[0], langid.train(spark.createDataFrame(ROWS, DOCS).withColumn("doc_id", F.lit(1))))
    assert {r["lang_pred"] for r in trained.where("doc_id in (3, 4, 5)").collect()} == {"und"}


def test_empty_texts_are_one_component(tables):
    rows = simhash.near_duplicates(tables[0]).collect()
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {3}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    kept = simhash.drop_near_duplicates(tables[0]).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in rows})


def test_pages_edges(spark):
    pages = spark.createDataFrame(
        [(1, "HTTP://A.Example.COM/en/5?x", "x" * 2000), (2, None, "x" * 2000), (None, "no scheme", "x" * 2000), (2, None, "x" * 2000), (3, "https://h.net/es/\r\nQ#f", None),
         (4, "a://b://c/d", "<p>" * 40000), (None, "z://", "only here" * 200), (5, "s://x/1/2/3/4/5/6", "y" * 999), (6, "s://x/", "y" * 999)],
        "page_id long, url string, html string").withColumns({"digest": F.lit(1), "payload": F.lit("p"), "host": F.lit("h"), "template": F.lit("t")})
    got = warc.read_archives(spark, warc.write_archives(pages)).collect()
    assert len(got) == 9 and sum(r["record_type"] == "revisit" for r in got) == 2
    assert {(r["page_id"], r["refers_to"]) for r in got if r["refers_to"]} == {(1, 2), (None, 2)}
    assert {r["payload_bytes"] for r in got} == {0, 999, 1800, 2000, 120_000}
    urls = {(r["page_id"], r["host"], r["path"], r["rule"]) for r in urltree.judge(pages).collect()}
    assert {(1, "a.example.com", "/en/5", "example.com/en/"), (2, "", "", None), (None, "", "", None), (3, "h.net", "/es/\r\nQ", "net/es/"), (4, "b:", "//c/d", None)} <= urls
    assert urltree.judge(pages.where("false")).count() == 0
    empty = warc.read_archives(spark, warc.write_archives(pages.where("false")))
    assert empty.count() == 0


def test_mixing_edges(tables):
    picked = mixing.mix(tables[0], budget_percent=100, max_epochs=1, slim=True).collect()
    assert all(r["n_tokens"] > 0 for r in picked) and {r["doc_id"] for r in picked} == {1, 2, None, 6, 7, 8}
    assert mixing.mix(tables[2], slim=True).count() == 0


def test_decontamination_edges(spark, tables, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find_leaks(tables[1], benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found) == [(0, 1), (1, 1), (1, 1), (2, 1), (7, 1), (8, 1)]
    assert decontam.find_leaks(tables[0], benchmark.where("false")).count() == 0


def test_credentials_edges(tables):
    rows = {r["doc_id"]: r for r in credentials.scan(tables[0]).collect()}
    assert rows[3]["spans"] == rows[4]["base_spans"] == "" and rows[8]["n_assign"] == 1 and rows[8]["base_spans"] == "assign:0:29"
