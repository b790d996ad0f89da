"""Mixtures of sources with target weights (problem 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainmill.llm.labels import clean_label
from grainmill.runtime import slots

#: Documents of one source between two stored prefix sums; the window over one such block is a task's unit of work.
DOCS_PER_BLOCK = 50_000


def mixture(docs: DataFrame, targets: DataFrame, n_docs: int, key: str = "doc_id", source: str = "source", size: str = "n_tokens", seed: int = 42) -> DataFrame:
    """``plan_id, source, key, copy, n_tokens, finish``: the records of each plan by weighted fair queueing.

    The documents of a source are shuffled by a seeded hash. A document's virtual finish time is the number of tokens of
    its source up to its own last one, divided by the source's target share; copy ``c`` of a document finishes ``c`` times
    the source's total later. Serving in the order of finish times keeps every share on target, up to one document, so
    the queue is cut at the largest budget that all sources can serve within their caps. ``copy`` counts from 0.

    Sources without documents can serve nothing: the others keep their proportions. Documents without tokens, without a
    source, or of a source that no plan names take no part. Targets with a null or non-positive share or no permitted
    copy are left out. The running sum of a source is cut into hashed blocks of even size, whose totals are summed in a
    small table, so a source with most of the rows needs no single task. Ties in the shuffle go to the lower key.
    """
    plan = targets.select("plan_id", clean_label("source").alias("_src"), F.col("target_share").alias("_w"), F.col("max_repeats").alias("_cap")).filter("_w > 0 and _cap > 0")
    plan = plan.groupBy("plan_id", "_src").agg(F.sum("_w").alias("_w"), F.max("_cap").alias("_cap"))
    n_blocks = slots(n_docs, DOCS_PER_BLOCK)
    d = docs.select(F.col(key).alias("_k"), clean_label(source).alias("_src"), F.col(size).cast("bigint").alias("_n")).filter("_n > 0 and _src != 'unknown'")
    d = d.withColumn("_h", F.xxhash64(F.lit(seed), F.col("_k").cast("string")))
    d = d.withColumn("_block", F.pmod(F.col("_h"), F.lit(n_blocks)))
    own = W.partitionBy("_src", "_block").orderBy("_h", "_k").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_cum", F.sum("_n").over(own))
    block = d.groupBy("_src", "_block").agg(F.sum("_n").alias("_sum"))
    before = W.partitionBy("_src").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    block = block.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    block = block.withColumn("_total", F.sum("_sum").over(W.partitionBy("_src")))
    d = d.join(block.select("_src", "_block", "_before", "_total"), ["_src", "_block"])
    totals = block.groupBy("_src").agg(F.max("_total").alias("_total"))
    budget = plan.join(totals, "_src").groupBy("plan_id").agg(F.min(F.col("_cap") * F.col("_total") / F.col("_w")).alias("_budget"))
    plan = F.broadcast(plan.join(budget, "plan_id"))  # one row per plan and source, as given
    d = d.join(plan, "_src")
    place = (F.col("_before") + F.col("_cum")).cast("double")
    last = F.floor((F.col("_budget") * F.col("_w") * (1 + 1e-12) - place) / F.col("_total"))  # the last copy within the budget
    d = d.withColumn("_last", F.least(last, (F.col("_cap") - 1).cast("bigint"))).filter("_last >= 0")
    d = d.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))))
    return d.select("plan_id", F.col("_src").alias("source"), F.col("_k").alias(key), F.col("copy").cast("int").alias("copy"), F.col("_n").alias("n_tokens"), ((place + F.col("copy") * F.col("_total")) / F.col("_w")).alias("finish"))


def in_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mixture range-sorted over all tasks in the order of service."""
    order = ["plan_id", "finish", "source", key, "copy"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``plan_id, source, target_share, n_records, n_tokens, actual_share, most_repeats``; 0 for a source that served nothing."""
    got = mixed.groupBy("plan_id", "source").agg(F.count("*").alias("n_records"), F.sum("n_tokens").alias("n_tokens"), (F.max("copy") + 1).alias("most_repeats"))
    t = targets.select("plan_id", clean_label("source").alias("source"), "target_share").groupBy("plan_id", "source").agg(F.sum("target_share").alias("target_share"))
    out = t.join(got, ["plan_id", "source"], "left").fillna(0, ["n_records", "n_tokens", "most_repeats"])
    return out.withColumn("actual_share", F.coalesce(F.try_divide(F.col("n_tokens"), F.sum("n_tokens").over(W.partitionBy("plan_id"))), F.lit(0.0))).select("plan_id", "source", "target_share", "n_records", "n_tokens", "actual_share", "most_repeats")


def kept_rules(mixed: DataFrame, targets: DataFrame, source: str = "source") -> DataFrame:
    """``plan_id, source, due_share, on_target, within_cap`` of the sources that served anything: the share due among them, whether
    the tokens served are at most one document of each source off it, and whether no document came too often."""
    got = mixed.groupBy("plan_id", "source").agg(F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("longest"), F.max("copy").alias("copy"))
    t = targets.filter("target_share > 0 and max_repeats > 0").groupBy("plan_id", clean_label(source).alias("source")).agg(F.sum("target_share").alias("w"), F.max("max_repeats").alias("cap"))
    plan = W.partitionBy("plan_id")  # a row per source
    rows = got.join(t, ["plan_id", "source"]).withColumns({"due": F.col("w") / F.sum("w").over(plan), "all": F.sum("n").over(plan), "slack": F.sum("longest").over(plan)})
    return rows.select("plan_id", "source", F.round("due", 6).alias("due_share"), (F.abs(F.col("n") - F.col("due") * F.col("all")) <= F.col("slack")).alias("on_target"), (F.col("copy") < F.col("cap")).alias("within_cap"))
