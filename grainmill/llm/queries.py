"""The queries of this subpackage, by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Defective question-answer pairs, one defect each."""
    from grainmill.llm.pairs import defects, one_defect

    return one_defect(defects(table(spark, d, "sft_qa_llm"), table(spark, d, "lang_samples")))


def p1_labels(spark: SparkSession, d: str) -> DataFrame:
    """All labels of defective pairs, with posteriors."""
    from grainmill.llm.pairs import defects

    return defects(table(spark, d, "sft_qa_llm"), table(spark, d, "lang_samples"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of corpus rows with a similarity of 0.7 or more."""
    from grainmill.llm.neardup import NearDuplicates

    return NearDuplicates(table(spark, d, "corpus")).row_pairs()


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every corpus row with text, its group and its number of links."""
    from grainmill.llm.neardup import NearDuplicates

    return NearDuplicates(table(spark, d, "corpus")).groups()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines of scanned files that are furniture or hold divided or misread words."""
    from grainmill.llm.scans import line_noise

    return line_noise(table(spark, d, "pdfs")).withColumn("line_no", F.col("line_no").cast("int"))


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The readable paragraphs of scanned files."""
    from grainmill.llm.scans import paragraphs

    return paragraphs(table(spark, d, "pdfs"))


def p4_token_budget(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of the corpus by source, language and topic."""
    from grainmill.llm.tokens import token_budget

    return token_budget(table(spark, d, "corpus"))


def p4_document_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of each corpus row, with its clean labels."""
    from grainmill.llm.labels import clean_label, clean_lang
    from grainmill.llm.tokens import token_count

    c = table(spark, d, "corpus")
    return c.select("ord", clean_label("source").alias("source"), clean_lang("lang").alias("lang"), clean_label("topic").alias("topic"), token_count(F.col("text"), spark).alias("n_tokens"))


def _pack_input(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, tuple[str, list[int]]], int]:
    """Lengths of all corpus texts, and one plan per row of pack_specs besides a joint one per unit."""
    from grainmill.llm.tokens import token_count

    c = table(spark, d, "corpus")
    specs = table(spark, d, "pack_specs").filter("unit is not null and max_size > 0").orderBy("spec_id").collect()  # a fixed handful of sizes
    plans = {f"spec {s['spec_id']}": (s["unit"], [s["max_size"]]) for s in specs}
    for unit in sorted({s["unit"] for s in specs}):
        plans[f"joint {unit}"] = (unit, sorted({s["max_size"] for s in specs if s["unit"] == unit}))
    items = c.select("ord", F.length("text").cast("bigint").alias("chars"), token_count(F.col("text"), spark).alias("tokens"))
    return items, plans, c.count()


def p5_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The container of each corpus text, for every size of pack_specs and for the sizes of a unit jointly."""
    from grainmill.llm.binpack import pack_items

    items, plans, n = _pack_input(spark, d)
    return pack_items(items, plans, "ord", n)


def p5_containers(spark: SparkSession, d: str) -> DataFrame:
    """The space left unused by each packing."""
    from grainmill.llm.binpack import containers

    return containers(p5_assignment(spark, d))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    from grainmill.llm.langid import languages, train

    c = table(spark, d, "corpus")
    return languages(c, train(table(spark, d, "lang_samples"), c))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Missing and wrong language labels of the corpus, and lines in another language."""
    from grainmill.llm.langid import label_errors

    return label_errors(_labelled(spark, d))


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    """The language and confidence of every corpus row and of every line."""
    return _labelled(spark, d).select("ord", "seg_no", "lang", "confidence", "n_chars")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of each document under byte_bpe_50k."""
    from grainmill.llm.tokens import encode_documents

    return encode_documents(table(spark, d, "documents"))


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from grainmill.llm.mixing import mixture
    from grainmill.llm.tokens import token_count

    docs, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    sized = docs.select("doc_id", "source", token_count(F.col("text"), spark).alias("n_tokens"))
    from grainmill.runtime import materialize

    return mixture(materialize(sized), targets, docs.count()), targets


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The records of each plan, in the order of service."""
    from grainmill.llm.mixing import in_order

    return in_order(_mixture(spark, d)[0])


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that each plan reaches."""
    from grainmill.llm.mixing import shares

    return shares(*_mixture(spark, d))


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    """What each packing keeps: parts, total length, containers above their capacity, and items cut though they fit."""
    from grainmill.llm.binpack import kept_rules

    return kept_rules(p5_assignment(spark, d))


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """Whether each source of a plan reaches its share of the tokens, up to one document, without too many repeats."""
    from grainmill.llm.mixing import kept_rules

    return kept_rules(*_mixture(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that look alike and differ."""
    from grainmill.llm.lookalikes import look_alike_pairs

    return look_alike_pairs(table(spark, d, "documents"))


def p9_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every document in its consistent form."""
    from grainmill.llm.lookalikes import normal_forms

    return normal_forms(table(spark, d, "documents")).select("doc_id", F.col("form").alias("text"))


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document with text, the class of its form, and how many rows and different texts are in it."""
    from grainmill.llm.lookalikes import form_classes

    return form_classes(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [p1_found, p1_labels, p2_found, p2_groups, p3_found, p3_paragraphs, p4_token_budget, p4_document_tokens, p5_assignment, p5_containers, p5_kept, p6_found, p6_languages, p7_ids, p8_mixture, p8_shares, p8_kept, p9_found, p9_forms, p9_classes]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from grainmill.llm.oracle import SQL

    return dict(SQL)
