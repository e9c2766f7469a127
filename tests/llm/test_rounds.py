"""Rounds of the near-duplicate search and of the components take few shuffles while one side of a join is small, and give the same without that."""

import random

import pytest
from conftest import plan_text
from loglattice.llm import common, components, setsketch
from test_setsketch import brute, changed, run, words


def written(monkeypatch, *modules):
    """The shuffles of everything that the modules write, by purpose."""
    shuffles = {}

    def noted(df, purpose, inner=common.materialise):
        shuffles.setdefault(purpose, []).append(plan_text(df).count("Exchange hashpartitioning"))
        return inner(df, purpose)

    for module in modules:
        monkeypatch.setattr(module, "materialise", noted)
    return shuffles


def grouped():
    """Pairs around one block, whose cells hold many components, a group around its base, copies and others."""
    rng, texts = random.Random(7), []
    block = words(rng, 352)
    for _ in range(30):
        own = words(rng, 48)
        texts += [block + own, block + own[:24] + words(rng, 24)]
    base = words(rng, 120)
    texts += [*(changed(rng, base, 1) for _ in range(40)), base, base, *(words(rng, 60) for _ in range(10))]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.fixture
def joined_by_size(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_sides_save_the_shuffles(joined_by_size, monkeypatch):
    shuffles = written(monkeypatch, setsketch, components)
    rows = grouped()
    assert run(joined_by_size, rows) == brute(rows)
    for purpose in ("members", "crowded", "roots", "open-members", "next-heads", "links", "large-star"):
        assert not any(shuffles[purpose]), purpose


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_same_whatever_the_sizes(joined_by_size, monkeypatch, few):
    for module in (common, components, setsketch):
        monkeypatch.setattr(module, "fits_broadcast", lambda df, limit=0: few > 0)
    rows = grouped()
    assert run(joined_by_size, rows) == brute(rows)


def test_stars_take_no_round(spark, monkeypatch):
    shuffles = written(monkeypatch, components)
    edges = [(0, i) for i in range(1, 30)] + [(i, 50) for i in range(51, 60)] + [(51, 50), (7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(30)}, **{i: 50 for i in range(50, 60)}}
    assert list(shuffles) == ["links", "neighbours"]
