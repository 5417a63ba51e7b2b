"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree of domain, language and source.  At each node
it is split among the children by weight; a child that can't use its share
(all its documents, MAX_EPOCHS times) leaves the shortage to its siblings, and
only what no sibling can use is missing one level up, where the share of the
whole node was bounded by the same rule.  Each leaf then takes a prefix of its
tokens from seeded epochs.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, keyed_documents, store, with_row_key

#: Words are the tokens that are budgeted.
WORD = r"[^\x20\x09-\x0D]+"
#: Times that a document may be used at most.
MAX_EPOCHS = 4
SEED = 20240601
#: Share of the documents' tokens that is asked for, as a fraction.
TARGET = (1, 2)
DEFAULT_WEIGHT = 10
#: Weights of nodes by path; others have DEFAULT_WEIGHT.  A weight of 0 leaves a node out.
WEIGHTS = {
    ("web",): 40,
    ("books",): 30,
    ("code",): 20,
    ("news",): 10,
    ("web", "en"): 50,
    ("web", "de"): 20,
    ("books", "en"): 40,
}
_WORDS = re.compile(WORD)
NONE = "(none)"
LEVELS = ("domain", "lang", "source")
#: Hex digits of the order that one refinement looks at.
DIGITS = 3


def domain_of(source: Column) -> Column:
    """Domain of a source by the number at the end of its name; sources without one are ``web``."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    turn = F.pmod(F.coalesce(number.try_cast("int"), F.lit(0)), F.lit(4))
    return F.element_at(F.array(*map(F.lit, ("web", "books", "code", "news"))), turn + 1)


def weights_frame(spark, weights: dict[tuple, int] = WEIGHTS) -> DataFrame:
    rows = [(len(p), *p, *[None] * (3 - len(p)), w) for p, w in weights.items()]
    return spark.createDataFrame(rows, "depth INT, domain STRING, lang STRING, source STRING, weight LONG")


def _split(nodes: DataFrame, parent: tuple[str, ...], name: str) -> DataFrame:
    """``nodes`` (parent.., name, budget, weight, cap) with ``share``: whole tokens of the parent's budget.

    In the order of cap / weight, a child is filled when its cap is within its
    part of what the children before it have left; the others divide the rest
    by weight, rounded so that the parts add up.
    """
    big = "DECIMAL(38,0)"
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.col("cap") / F.col("weight")
    order = group.orderBy(ratio, name)
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = nodes.withColumns({
        "caps_ahead": F.coalesce(F.sum("cap").over(ahead), F.lit(0)),
        "weight_left": F.sum("weight").over(onward),
    })
    dec = lambda c: F.col(c).cast("DECIMAL(19,0)")
    left = F.col("budget") - F.col("caps_ahead")
    n = n.withColumn("full", (dec("cap") * dec("weight_left")) <= (dec("weight") * left.cast("DECIMAL(19,0)")))
    n = n.withColumns({
        "rest": F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group),
        "open_weight": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group),
        "weight_to": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    upto = lambda w: F.expr(f"CAST({w} AS {big}) * CAST(rest AS DECIMAL(19,0)) div open_weight")
    n = n.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(upto("CAST(weight_to AS DECIMAL(19,0))") - upto("CAST(weight_to - weight AS DECIMAL(19,0))")))
    return n.drop("caps_ahead", "weight_left", "full", "rest", "open_weight", "weight_to")


def leaf_budgets(leaves: DataFrame, weights: DataFrame, budget: Column | int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``domain, lang, source, tokens, share`` from leaves ``domain, lang, source, tokens``.

    ``budget`` counts tokens.  What even MAX_EPOCHS uses of everything can't
    fill stays unused.  Nodes of weight zero or below get nothing.
    """
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for depth in (3, 2, 1):
        names = list(LEVELS[:depth])
        mine = weights.where(F.col("depth") == depth).select(*names, F.col("weight").alias(f"w{depth}"))
        caps = caps.join(mine, names, "left").withColumn(f"w{depth}", F.coalesce(f"w{depth}", F.lit(DEFAULT_WEIGHT).cast("long")))
    usable = (F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0) & (F.col("tokens") > 0)
    caps = store(caps.where(usable), "mix-leaves")
    above = None
    for depth in (1, 2, 3):
        names, parent = list(LEVELS[:depth]), LEVELS[: depth - 1]
        nodes = caps.groupBy(*names).agg(F.sum("cap").cast("long").alias("cap"), F.max(f"w{depth}").alias("weight"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if above is None else nodes.join(above, list(parent))
        above = _split(nodes, parent, names[-1]).select(*names, "tokens", F.col("share").cast("long").alias("budget"))
        if depth < 3:
            above = above.drop("tokens")
    return above.withColumnRenamed("budget", "share")


def _prefix(rows: DataFrame, level: int = 0) -> DataFrame:
    """Rows (leaf.., due, h, n_tokens, doc_id, row_key) of the first ``due`` tokens in the order of h, with ``take``.

    Sums by leaf and leading digits of h find the digits in which the budget
    runs out; only rows with these digits are looked at again.  The last
    refinement orders the few rows left, so no leaf is sorted in one task.
    """
    names = list(LEVELS)
    if level == 2:
        order = Window.partitionBy(*names).orderBy("h", F.col("doc_id").isNull(), "doc_id", ROW_KEY)
        before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return rows.withColumn("before", before).where("before < due").select(
            *names, "doc_id", ROW_KEY, "n_tokens", "epoch", F.least(F.col("n_tokens"), F.col("due") - F.col("before")).alias("take_tokens")
        )
    rows = rows.withColumn("digit", F.substring("h", level * DIGITS + 1, DIGITS))
    sums = rows.groupBy(*names, "digit").agg(F.sum("n_tokens").alias("tokens"), F.max("due").alias("all_due"))
    order = Window.partitionBy(*names).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    marks = sums.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).where("before < all_due")
    marks = store(marks.select(*names, "digit", "before", "tokens"), "mix-marks")
    met = rows.join(marks, [*names, "digit"])
    inside = F.col("before") + F.col("tokens") <= F.col("due")
    taken = met.where(inside).select(*names, "doc_id", ROW_KEY, "n_tokens", "epoch", F.col("n_tokens").alias("take_tokens"))
    cut = met.where(~inside).withColumn("due", F.col("due") - F.col("before")).drop("before", "tokens", "digit")
    return taken.unionByName(_prefix(store(cut, "mix-cut"), level + 1))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    target: tuple[int, int] = TARGET,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain=domain_of,
) -> DataFrame:
    """One row per document and epoch used: ``row_key, doc_id, domain, lang, source, n_tokens, epoch, take_tokens``.

    The budget is ``target`` (numerator, denominator) of all tokens, rounded
    down.  A leaf with budget b and t tokens uses each document in epochs 1 to
    b div t whole, and in the next epoch the documents that come first by
    md5(seed:epoch:doc_id) until the rest is used; of the last one only the
    first ``take_tokens`` words.  A null language or source is the node
    ``(none)``; rows without doc_id are ordered by a hash of their row key,
    repeated rows are used one by one.  Documents without words (null, empty, blank) have no
    tokens and are never used; an empty table gives no rows; other columns of
    ``docs`` are not used.
    """
    spark = docs.sparkSession
    keyed = with_row_key(docs, id_col, text_col, "lang", "source")
    sized = keyed.select(
        F.col(id_col).cast("long").alias("doc_id"), ROW_KEY,
        domain(F.coalesce("source", F.lit(""))).alias("domain"),
        F.coalesce("lang", F.lit(NONE)).alias("lang"), F.coalesce("source", F.lit(NONE)).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    sized = store(sized.where("n_tokens > 0"), "mix-sizes")
    leaves = store(sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-tokens")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    weights = weights_frame(spark) if weights is None else weights
    shares = leaf_budgets(leaves, weights, total * target[0] // target[1], max_epochs)
    shares = store(
        shares.where("share > 0").select(
            *LEVELS, F.expr("share div tokens").alias("whole"), F.expr("share % tokens").alias("due")
        ),
        "mix-shares",
    )
    used = sized.join(shares, list(LEVELS))
    whole = used.where("whole > 0").select(
        *LEVELS, "doc_id", ROW_KEY, "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), "whole")).alias("epoch"),
        F.col("n_tokens").alias("take_tokens"),
    )
    part = used.where("due > 0").withColumn("epoch", F.col("whole") + 1).drop("whole")
    # Rows without doc_id go by their row key, so that they are spread over the digits like others.
    keyed_by = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws("/", F.lit("row"), f"{ROW_KEY}.file", f"{ROW_KEY}.row"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), keyed_by).cast("binary"))
    part = _prefix(part.withColumn("h", order))
    columns = [ROW_KEY, "doc_id", *LEVELS, "n_tokens", "epoch", "take_tokens"]
    return whole.select(columns).unionByName(part.select(columns))


def _cut_words(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The text up to the end of its n-th word; null stays null."""
    for text, n in texts:
        out = []
        for t, k in zip(text.to_pylist(), n.to_pylist()):
            ends = None if t is None else next(itertools.islice(_WORDS.finditer(t), max(k - 1, 0), None), None)
            out.append(t if ends is None else t[: ends.end()])
        yield pa.array(out, pa.string())


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of :func:`mix`, one row per use, with the columns of ``docs``.

    A document that is used in part has its text cut after its last used word;
    a column ``n_chars`` is counted anew for it.
    """
    keyed = keyed_documents(docs)
    mine = mix(docs, id_col=id_col, text_col=text_col, **options)
    used = mine.select(ROW_KEY, F.col("take_tokens").alias("take"), (F.col("take_tokens") < F.col("n_tokens")).alias("part"))
    used = store(used, "mix-used")
    rows = keyed.join(used.hint("merge"), ROW_KEY)
    cut = F.arrow_udf(_cut_words, "string")
    whole = F.col("document")[text_col]
    text = F.when(F.col("part"), cut(F.when(F.col("part"), whole), "take")).otherwise(whole)
    rows = rows.select("document", "part", text.alias("cut_text"))
    made = {c: F.col("document")[c] for c in docs.columns} | {text_col: F.col("cut_text")}
    if "n_chars" in made:
        size = F.length("cut_text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("part"), size).otherwise(made["n_chars"])
    return rows.select(*(column.alias(c) for c, column in made.items()))
