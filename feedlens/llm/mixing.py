"""Mixing sources to target weights by hierarchical budgets.

Weights sit on the nodes of a domain - language - source tree.  The budget of
tokens flows from the root down; a node that cannot use its share, even by
repeating its documents ``max_epochs`` times, passes the shortage to its
siblings first, and only what all of them cannot take goes to the level
above.  Each leaf then takes a prefix of its tokens over seeded epochs: every
epoch orders the leaf's documents anew, whole epochs are taken whole, and the
last one up to the budget.

Only DataFrame functions are used.  No row moves for the order: documents
fall into buckets by the first digits of their draw, tokens are added up per
bucket, and only the one bucket of each leaf in which the budget ends is
sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.llm.tables import materialize

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the draw that name a bucket: 4096 for each leaf.
BUCKET_DIGITS = 3
#: Leaves that may be broadcast as a plan; more are joined by shuffle.
BROADCAST_LEAVES = 100_000


def token_count(column: str = "text") -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    words = F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def draw(seed: int, epoch: Column) -> Column:
    """A document's draw in an epoch: 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Split each parent's ``budget`` over its children in proportion to
    ``weight``, none above its ``capacity`` (water filling).

    In order of capacity per weight, a child is full if the budget suffices to
    raise all children after it, too, to its level; what is left goes to the
    others by weight.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(*parent)
    full = (F.col("filled") + F.col("capacity") / F.col("weight") * F.col("open_weight")) <= F.col("budget")
    return (nodes
            .withColumn("filled", F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
            .withColumn("open_weight", F.sum("weight").over(rest))
            .withColumn("full", full)
            .withColumn("used", F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0.0)).over(every))
            .withColumn("others", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every))
            .withColumn("given", F.when(F.col("full"), F.col("capacity"))
                        .otherwise((F.col("budget") - F.col("used")) * F.col("weight") / F.col("others")))
            .drop("filled", "open_weight", "full", "used", "others"))


def leaf_budgets(leaves: DataFrame, weights: DataFrame, budget: float | Column, max_epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` with ``budget`` in tokens.

    ``weights(domain, lang, source, weight)`` gives the weight of a node among
    its siblings; lower levels are null for the nodes above.  A node without a
    weight has weight 1; a weight of 0 or less, or leaves without tokens, get
    nothing.  The tree has one row per leaf, far fewer than documents.
    """
    nodes = leaves.select(*LEVELS, "tokens", (F.col("tokens") * F.lit(float(max_epochs))).alias("capacity"))
    for depth in range(len(LEVELS), 0, -1):
        own = weights.select(*(F.col(c).alias(f"w_{c}") for c in LEVELS), F.col("weight").cast("double").alias(f"weight_{depth}"))
        same = F.lit(True)
        for i, c in enumerate(LEVELS):
            same &= nodes[c].eqNullSafe(own[f"w_{c}"]) if i < depth else own[f"w_{c}"].isNull()
        own = own.groupBy(*(f"w_{c}" for c in LEVELS)).agg(F.max(f"weight_{depth}").alias(f"weight_{depth}"))
        nodes = nodes.join(own, same, "left").drop(*(f"w_{c}" for c in LEVELS))
        nodes = nodes.withColumn(f"weight_{depth}", F.coalesce(F.col(f"weight_{depth}"), F.lit(1.0)))
    for depth in range(1, len(LEVELS) + 1):
        nodes = nodes.where(F.col(f"weight_{depth}") > 0)
    nodes = materialize(nodes.where("capacity > 0"), "mix-tree")
    total = budget if isinstance(budget, Column) else F.lit(float(budget))
    given = None
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        level = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.first(f"weight_{depth}").alias("weight"))
        level = level.withColumn("node", F.col(LEVELS[depth - 1]))
        if given is None:
            level = level.withColumn("root", F.lit(0)).withColumn("budget", total)
            parent = ["root"]
        else:
            parent = keys[:-1]
            above = given.select(*(F.col(c).alias(f"p_{c}") for c in parent), F.col("given").alias("budget"))
            same = F.lit(True)
            for c in parent:
                same &= level[c].eqNullSafe(above[f"p_{c}"])
            level = level.join(above, same).drop(*(f"p_{c}" for c in parent))
        given = _share(level, parent).drop("node", "budget", "capacity", "weight", "root")
    same = F.lit(True)
    given = given.select(*(F.col(c).alias(f"g_{c}") for c in LEVELS), "given")
    for c in LEVELS:
        same &= nodes[c].eqNullSafe(given[f"g_{c}"])
    return nodes.join(given, same).select(*LEVELS, "tokens", F.floor(F.col("given") + F.lit(1e-6)).alias("budget"))


def _with_plan(rows: DataFrame, plan: DataFrame, leaves: int) -> DataFrame:
    plan = plan.select(*(F.col(c).alias(f"p_{c}") for c in LEVELS), "budget", "epochs", "left")
    same = F.lit(True)
    for c in LEVELS:
        same &= rows[c].eqNullSafe(plan[f"p_{c}"])
    plan = F.broadcast(plan) if leaves <= BROADCAST_LEAVES else plan
    return rows.join(plan, same).drop(*(f"p_{c}" for c in LEVELS))


def mix(docs: DataFrame, weights: DataFrame, budget: float | None, max_epochs: int, seed: int) -> DataFrame:
    """``docs(doc_id, domain, lang, source, tokens)`` -> the chosen documents:
    ``doc_id, domain, lang, source, tokens, epoch, taken``, one row for each
    epoch in which a document is chosen; ``taken`` is less than ``tokens``
    only where a leaf's budget ends inside the document.

    * ``budget`` None: as many tokens as the documents have.
    * Documents without tokens are never chosen (they add nothing).
    * Null domain, language or source are branches of their own.
    * Repeated rows count as often as they occur; a tie of the draw is broken
      by id and tokens.  An empty table gives no rows.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *LEVELS, "tokens").where("tokens > 0"), "mix-rows")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    if budget is None:
        budget = float(leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    plan = materialize(
        leaf_budgets(leaves, weights, budget, max_epochs)
        .withColumn("epochs", F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(max_epochs)))
        .withColumn("left", F.col("budget") - F.col("epochs") * F.col("tokens")), "mix-plan")
    leaves = plan.count()
    rows = _with_plan(rows, plan, leaves)

    whole = rows.where("epochs > 0").select(
        "doc_id", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), (F.col("epochs") - 1).cast("int"))).alias("epoch"),
        F.col("tokens").alias("taken"))

    last = rows.where("left > 0").withColumn("draw", draw(seed, F.col("epochs")))
    last = last.withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    buckets = last.groupBy(*LEVELS, "bucket", "left").agg(F.sum("tokens").alias("in_bucket"))
    before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # The bucket in which the budget ends, and what it may still take.
    ends = materialize(buckets.withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
                       .where("before < left and before + in_bucket >= left")
                       .select(*(F.col(c).alias(f"e_{c}") for c in LEVELS), F.col("bucket").alias("end_bucket"),
                               (F.col("left") - F.col("before")).alias("end_left")), "mix-ends")
    same = F.lit(True)
    for c in LEVELS:
        same &= last[c].eqNullSafe(ends[f"e_{c}"])
    last = last.join(F.broadcast(ends) if leaves <= BROADCAST_LEAVES else ends, same)
    full = last.where("bucket < end_bucket").select(
        "doc_id", *LEVELS, "tokens", F.col("epochs").cast("int").alias("epoch"), F.col("tokens").alias("taken"))
    inside = Window.partitionBy(*LEVELS).orderBy("draw", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    ending = (last.where("bucket = end_bucket")
              .withColumn("at", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
              .where("at < end_left")
              .select("doc_id", *LEVELS, "tokens", F.col("epochs").cast("int").alias("epoch"),
                      F.least(F.col("tokens"), F.col("end_left") - F.col("at")).alias("taken")))
    return whole.unionByName(full).unionByName(ending)


def times_chosen(docs: DataFrame, chosen: DataFrame, seed: int) -> DataFrame:
    """``docs(doc_id, domain, lang, source, tokens, ...)`` with ``times``: in how
    many epochs ``chosen``, the mix of the same documents, takes each row, the
    last one as a whole.

    A leaf takes all its rows in every epoch but its last, and in that one
    those up to a row, in the order of draw, id and tokens.  That row, one for each leaf, is all
    that the documents are compared with, so they stay where they are.  Rows that agree
    in id, leaf and tokens are taken equally often.  Rows without tokens, and leaves without
    a budget, are taken 0 times."""
    rank = F.struct(F.col("epoch").alias("epoch"), draw(seed, F.col("epoch")).alias("draw"),
                    F.col("doc_id").cast("long").alias("id"), F.col("tokens").alias("tokens"))
    cut = materialize(chosen.groupBy(*(F.col(c).alias(f"c_{c}") for c in LEVELS)).agg(F.max(rank).alias("cut")), "mix-cuts")
    same = F.lit(True)
    for c in LEVELS:
        same &= docs[c].eqNullSafe(cut[f"c_{c}"])
    joined = docs.join(F.broadcast(cut) if cut.count() <= BROADCAST_LEAVES else cut, same, "left")
    epoch = F.col("cut.epoch")
    own = F.struct(epoch.alias("epoch"), draw(seed, epoch).alias("draw"), F.col("doc_id").cast("long").alias("id"),
                   F.col("tokens").alias("tokens"))
    times = F.when((F.col("tokens") > 0) & F.col("cut").isNotNull(), epoch + (own <= F.col("cut")).cast("int"))
    return joined.withColumn("times", F.coalesce(times, F.lit(0)).cast("int")).drop("cut", *(f"c_{c}" for c in LEVELS))
