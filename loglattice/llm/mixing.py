"""Mixing sources to target weights by hierarchical budgeting, with DataFrame operations only.

The tree is domain, language, source. A token budget is poured down level by level: every child gets its weight's part of what its parent
got, but no more than its documents yield in ``max_epochs`` epochs; what a child cannot take goes to its siblings by weight, and only what
the whole family cannot take was never given to it, so it went to the family's own siblings. A leaf spends its budget on whole epochs of
its documents and then on a token-prefix of one more epoch, in an order seeded by seed, epoch and document id.

The prefix is found without sorting a leaf: tokens are summed per leaf and hash range, the ranges' running sum names the one range in
which the budget ends, and only that range's documents are ordered. All arithmetic is on whole numbers.

A document without a word (null and empty texts too) is never selected. A null language or source is a leaf of its own. Rows with one id
and one leaf share their place and are taken together. Columns with clashing names and empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglattice.llm.common import SPACE_CHARS, SPACES, column, free_name, materialise
from loglattice.session import fits_broadcast

#: Target weights. A language or source that is not listed weighs 1.
DOMAIN_WEIGHTS = {"web": 40, "books": 30, "news": 20, "other": 10}
LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 1}
#: Domain of a source by the last digit of its name.
DOMAIN_DIGITS = {"web": "0123", "books": "456", "news": "78"}
BUDGET_PERCENT, MAX_EPOCHS, SEED = 60, 2, 17
#: Hex digits of the seeded hash that make a range.
RANGE_DIGITS = 3
#: Fineness of the grid on which the water level is sought.
BUCKETS_PER_OCTAVE = 32


def domain_of(source: Column) -> Column:
    out = F.lit("other")
    for name, digits in DOMAIN_DIGITS.items():
        out = F.when(source.rlike(f"[{digits}]$"), name).otherwise(out)
    return out


def token_count(text: Column) -> Column:
    """Words of the text; 0 for null."""
    body = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.coalesce(body, F.lit("")) == "", 0).otherwise(F.size(F.split(body, rf"[{SPACES}]+"))).cast("long")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, value in weights.items():
        out = F.when(name == key, value).otherwise(out)
    return out.cast("long")


def _takes_all(capacity: Column, weight: Column, spare: Column, weight_left: Column) -> Column:
    """Whether a child's part of ``spare`` covers its capacity; products of two longs need decimals."""
    whole = lambda c: c.cast("decimal(19,0)")
    return whole(capacity) * whole(weight_left) <= whole(weight) * whole(F.greatest(F.lit(0), spare))


def water_level(children: DataFrame, parent: list[str]) -> DataFrame:
    """Per parent whose children cannot all be full: the least ratio of capacity to weight that stays open, and what its children share.

    A parent may have any number of children. They are summed per ratio and ratios per bucket of a logarithmic grid; running sums over the
    buckets, a few thousand at most, name the one in which filling ends, and only that bucket's ratios are put in order.
    """
    parts = children.groupBy(*parent, _ratio().alias("ratio")).agg(
        F.sum("capacity").alias("capacity"), F.sum("weight").alias("weight"), F.max("given").alias("given")
    )
    parts = parts.withColumn("bucket", F.when(F.col("ratio") > 0, F.floor(F.log2("ratio") * BUCKETS_PER_OCTAVE)))
    parts = materialise(parts.withColumn("bucket", F.coalesce("bucket", F.lit(-(1 << 40)))), "ratios")
    grid = parts.groupBy(*parent, "bucket").agg(
        F.sum("capacity").alias("capacity"), F.sum("weight").alias("weight"), F.max("given").alias("given"),
        F.max_by(F.struct("capacity", "weight"), "ratio").alias("top"),
    )
    up = Window.partitionBy(*parent).orderBy("bucket")
    earlier, later = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    grid = grid.withColumns({
        "before": F.coalesce(F.sum("capacity").over(earlier), F.lit(0)), "weight_left": F.sum("weight").over(later),
    })
    lower = F.col("capacity") - F.col("top.capacity")
    full = _takes_all(
        F.col("top.capacity"), F.col("top.weight"), F.col("given") - F.col("before") - lower,
        F.col("weight_left") - F.col("weight") + F.col("top.weight"),
    )
    edge = grid.where(~full).groupBy(*parent).agg(F.min(F.struct("bucket", "before", "weight_left")).alias("edge"))
    edge = edge.select(*parent, "edge.*")
    within = Window.partitionBy(*parent).orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    done = lambda c: F.coalesce(F.sum(c).over(within), F.lit(0))
    inside = parts.join(edge, [*parent, "bucket"]).withColumns({
        "spare": F.col("given") - F.col("before") - done("capacity"), "left": F.col("weight_left") - done("weight"),
    })
    still_open = inside.where(~_takes_all(F.col("capacity"), F.col("weight"), F.col("spare"), F.col("left")))
    level = still_open.groupBy(*parent).agg(F.min(F.struct("ratio", "spare", "left")).alias("level"))
    return level.select(*parent, F.col("level.ratio").alias("open_from"), "level.spare", F.col("level.left").alias("weight_left"))


def _ratio() -> Column:
    return F.col("capacity").cast("double") / F.col("weight")


def pour(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children(parent.., name, weight, capacity, given)`` with ``budget``: ``given`` shared by weight under the capacities."""
    level = materialise(water_level(children, parent), "water-level")
    part = F.expr("cast(spare as decimal(19,0)) * cast(weight as decimal(19,0)) div cast(weight_left as decimal(19,0))")
    full = F.col("open_from").isNull() | (_ratio() < F.col("open_from"))
    budget = F.when(full, F.col("capacity")).otherwise(part)
    return children.join(level, parent, "left").withColumn("budget", budget).select(*parent, name, "weight", "capacity", "budget")


def leaf_budgets(leaves: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """``leaves(domain, language, origin, tokens)`` with their parts of ``budget``, in tokens."""
    sized = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    languages = sized.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity"))
    domains = languages.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    top = domains.withColumn("given", F.lit(budget).cast("long")).withColumn("root", F.lit(1))
    top = pour(top.withColumn("weight", _weight(F.col("domain"), DOMAIN_WEIGHTS)), ["root"], "domain")
    middle = languages.withColumn("weight", _weight(F.col("language"), LANGUAGE_WEIGHTS)).join(top.select("domain", F.col("budget").alias("given")), "domain")
    middle = pour(middle, ["domain"], "language")
    low = sized.withColumn("weight", F.lit(1).cast("long")).join(middle.select("domain", "language", F.col("budget").alias("given")), ["domain", "language"])
    return pour(low, ["domain", "language"], "origin").join(leaves, ["domain", "language", "origin"])


def _order(epoch: Column, doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(doc_id.cast("string"), F.lit(""))))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if measured small enough; else left to a shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df


def mixing_plan(slim: DataFrame, budget_percent: int, max_epochs: int, seed: int) -> DataFrame:
    """``slim(domain, language, origin, doc_id, n_tokens)`` to, per leaf, the whole epochs and the last hash of the partial one."""
    leaf = ["domain", "language", "origin"]
    leaves = materialise(slim.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, total * budget_percent // 100, max_epochs).selectExpr(*leaf, "budget div tokens AS epochs", "budget % tokens AS rest")
    plan = materialise(plan, "epochs")
    placed = slim.join(_small(plan.where("rest > 0")), leaf).withColumn("place", _order(F.col("epochs"), F.col("doc_id"), seed))
    placed = placed.withColumn("range", F.substring("place", 1, RANGE_DIGITS))
    ranges = placed.groupBy(*leaf, "range", "rest").agg(F.sum("n_tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("range"))
    edge = ranges.withColumn("upto", running).where("upto > rest and upto - tokens <= rest")
    edge = materialise(edge.select(*leaf, "range", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room")), "edge-ranges")
    inside = placed.join(_small(edge), [*leaf, "range"])
    upto = F.sum("n_tokens").over(Window.partitionBy(*leaf, "range").orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("upto", upto).where("upto <= room").groupBy(*leaf).agg(F.max("place").alias("last"))
    out = plan.join(edge.select(*leaf, "range"), leaf, "left").join(last, leaf, "left")
    # No document of the edge range fits: everything before the range is taken, and nothing inside it.
    return materialise(out.withColumn("last", F.coalesce("last", "range")).drop("range"), "mixing-plan")


def _leaf(docs: DataFrame, doc_id: str, text: str, lang: str, source: str) -> dict[str, Column]:
    return {
        "domain": domain_of(F.coalesce(column(source), F.lit(""))), "language": F.coalesce(column(lang), F.lit("")),
        "origin": F.coalesce(column(source), F.lit("")), "doc_id": column(doc_id), "n_tokens": token_count(column(text)),
    }


def mix(
    docs: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, doc_id: str = "doc_id",
    text: str = "text", lang: str = "lang", source: str = "source", slim: bool = False, copies: str = "copies",
) -> DataFrame:
    """The selected rows with all their columns and the number of epochs they appear in (``copies``).

    ``slim``: only ``doc_id, domain, lang, source, n_tokens, copies``.
    """
    parts = _leaf(docs, doc_id, text, lang, source)
    rows = docs.select(*[v.alias(k) for k, v in parts.items()], column(lang).alias("lang"), column(source).alias("source")).where("n_tokens > 0")
    rows = materialise(rows, "token-counts")
    plan = mixing_plan(rows.drop("lang", "source"), budget_percent, max_epochs, seed)
    leaf = ["domain", "language", "origin"]
    taken = F.col("epochs") + F.when((F.col("rest") > 0) & (F.col("place") <= F.col("last")), 1).otherwise(0)
    if slim:
        chosen = rows.join(_small(plan), leaf).withColumn("place", _order(F.col("epochs"), F.col("doc_id"), seed)).withColumn("copies", taken)
        return chosen.where("copies > 0").select("doc_id", "domain", "lang", "source", "n_tokens", "copies")
    renamed = {c: free_name(docs, f"mix_{c}") for c in (*leaf, "epochs", "rest", "last", "place", "copies")}
    named = plan.select(*[F.col(c).alias(renamed[c]) for c in plan.columns])
    keyed = docs.withColumns({renamed[c]: parts[c] for c in leaf}).where(~F.coalesce(column(text), F.lit("")).rlike(rf"^[{SPACES}]*$"))
    joined = keyed.join(_small(named), [renamed[c] for c in leaf])
    joined = joined.withColumn(renamed["place"], _order(column(renamed["epochs"]), column(doc_id), seed))
    more = F.when((column(renamed["rest"]) > 0) & (column(renamed["place"]) <= column(renamed["last"])), 1).otherwise(0)
    joined = joined.withColumn(renamed["copies"], column(renamed["epochs"]) + more).where(column(renamed["copies"]) > 0)
    return joined.select(*[column(c) for c in docs.columns], column(renamed["copies"]).alias(free_name(docs, copies)))
