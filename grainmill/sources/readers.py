"""Readers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.text import clean_pdf_text, file_stem, markdown_to_text, py_strip, stem_to_title, universal_newlines, wiki_to_text
from grainmill.operators.filters import min_length, with_errors
from grainmill.operators.split import path_parts, union_sources

SHARD = "id string, title string, url string, text string"
CORPUS = "id string, title string, url string, text string, source string, lang string, file string"
TEXT_FILES = "*.{[mM][dD],[mM][aA][rR][kK][dD][oO][wW][nN],[tT][xX][tT],[rR][sS][tT]}"


def read_jsonl(spark: SparkSession, path: str, schema: str = CORPUS) -> DataFrame:
    """One document per line; blank lines are skipped, a bad one fails the job (S1). Files are read in parallel."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_compat(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Like ``read_jsonl``, but a field that is present and null reads ``None`` and a missing one is empty."""
    raw = spark.read.option("singleVariantColumn", "v").json(path)

    def field(name: str):
        v = F.variant_get("v", f"$.{name}", "variant")
        return F.when(v.isNull(), "").when(F.is_variant_null(v), "None").otherwise(F.variant_get("v", f"$.{name}", "string")).alias(name)

    return raw.select(*map(field, columns))


def _place() -> Column:
    """A row's place in its file: where its split begins, then its number within the task, which reads a split in order."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(10**10).cast("decimal(11,0)") + row).cast("decimal(38,0)")


def read_ordered(spark: SparkSession, paths: list[str], schema: str = CORPUS) -> DataFrame:
    """Several files as one collection with ``ord``: earlier files first, then the place in the file.

    ``ord`` is a decimal, 10^26 for each file and 10^10 for each byte of a split's start, so that it rises with the lines
    of files of any size.
    """
    frames = []
    for p in paths:
        lines = spark.read.text(p).select("value", _place().alias("_at")).filter(py_strip("value") != "")
        doc = F.from_json("value", schema, {"mode": "FAILFAST"})
        frames.append(lines.select(doc.alias("_d"), "_at").select("_d.*", "_at"))
    both = union_sources(frames)
    return both.withColumn("ord", (F.col("source_rank").cast("decimal(11,0)") * F.lit("1" + "0" * 26).cast("decimal(27,0)") + F.col("_at")).cast("decimal(38,0)")).drop("_at", "source_rank")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """The text column alone (S3), in one pass; a line without it fails the job. The first line is looked at beforehand."""
    rows = spark.read.option("singleVariantColumn", "v").json(path)
    field = F.variant_get("v", "$.text", "variant")
    if (first := rows.select(field.isNull().alias("none")).first()) and first["none"]:
        raise KeyError("text")
    return rows.select(F.when(field.isNull(), F.raise_error(F.lit("a line has no text"))).otherwise(F.variant_get("v", "$.text", "string")).alias("text"))


def read_wiki_shards(spark: SparkSession, folder: str, lang: str) -> DataFrame:
    """Extractor shards below ``folder`` as documents (S4, F1, P1); ordered by ``shard_dir, shard, place``."""
    rows = spark.read.schema(SHARD).option("mode", "FAILFAST").option("recursiveFileLookup", True).option("pathGlobFilter", "wiki_*").json(folder)
    parts = F.split(F.col("_metadata.file_path"), "/")
    rows = rows.select("*", F.element_at(parts, -2).alias("shard_dir"), F.element_at(parts, -1).alias("shard"), _place().alias("place"))
    return min_length(rows, 200, store_stripped=True).withColumns({"source": F.lit("wikipedia"), "lang": F.lit(lang)})


def read_wiki_pages(spark: SparkSession, path: str, plain: bool = False) -> DataFrame:
    """Pages of a dump, bz2 or plain (S5); with ``plain`` without markup and without redirects and pages of other kinds."""
    schema = "id string, title string, ns string, redirect struct<_title: string>, revision struct<text: struct<_VALUE: string>>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    text = F.col("revision.text._VALUE")
    if not plain:
        return rows.select("id", "title", "ns", text.alias("text"))
    return rows.filter("ns = '0' and redirect is null").select("id", "title", "ns", wiki_to_text(text).alias("text"))


def _files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``file`` (relative path), ``content``, for files whose name matches, read recursively; others are not opened."""
    base = folder.rstrip("/") + "/"
    full = F.url_decode(F.regexp_replace(F.regexp_replace("path", r"\+", "%2B"), r"^file:/*", "/"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select(F.substring(full, len(base) + 1, 1 << 20).alias("file"), "content")


def pdf_pages() -> Callable[[bytes], list[str]]:
    """A reader of PDF pages, if one of two public libraries is installed."""
    try:
        import fitz

        return lambda content: [page.get_text() for page in fitz.open(stream=content, filetype="pdf")]
    except ImportError:
        pass
    try:
        import pypdf
    except ImportError as e:
        raise RuntimeError("no PDF library is installed; give read_pdfs a function of your own") from e
    import io

    return lambda content: [page.extract_text() or "" for page in pypdf.PdfReader(io.BytesIO(content)).pages]


def read_pdfs(spark: SparkSession, folder: str, pages: Callable[[bytes], list[str]] | None = None, least: int = 500) -> tuple[DataFrame, DataFrame]:
    """Documents of PDF files, and the files that could not be read with their errors.

    ``pages`` turns a file's bytes into page texts (default: a public library if there is one); blank pages are dropped,
    the others joined with an empty line.
    """
    pages = pages or pdf_pages()

    def extract(frames):
        for pdf in frames:
            rows = []
            for f, content in zip(pdf["file"], pdf["content"]):
                try:
                    rows.append((f, "\n\n".join(p for p in pages(bytes(content)) if p and p.strip()), None))
                except Exception as e:  # one bad file is reported and skipped
                    rows.append((f, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["file", "text", "error"])

    rows = _files(spark, folder, "*.pdf").mapInPandas(extract, "file string, text string, error string")
    good = rows.filter("error is null").withColumn("text", clean_pdf_text("text"))
    stem = file_stem("file")
    docs = good.select(stem.alias("id"), stem_to_title(stem).alias("title"), "text", F.lit("pdf").alias("source"), "file")
    return docs.filter(F.length("text") >= least), rows.filter("error is not null").select("file", "error")


def join_pages(pages: DataFrame, path: str = "path", page: str = "page", text: str = "page_text") -> DataFrame:
    """``path, text``: the pages of each file in order, joined with an empty line, blank ones left out.

    Repeated pages count once. A file is one text and so a bounded group.
    """
    p = pages.filter(py_strip(text) != "").select(F.col(path).alias("path"), F.struct(F.col(page).alias("n"), F.col(text).alias("t")).alias("p")).distinct()
    return p.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["t"]), "\n\n").alias("text"))


def scan_text_files(spark: SparkSession, folder: str, least: int = 200) -> tuple[DataFrame, DataFrame]:
    """Documents of Markdown and text files (S7, F3, P3), and the files that could not be read with their errors (F8): UTF-8
    with replacement, universal newlines, plain text."""

    def decode(frames):
        for pdf in frames:
            rows = []
            for f, content in zip(pdf["file"], pdf["content"]):
                try:
                    rows.append((f, bytes(content).decode("utf-8", "replace"), None))
                except Exception as e:  # one bad file is reported and skipped
                    rows.append((f, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["file", "text", "error"])

    rows, errors = with_errors(_files(spark, folder, TEXT_FILES).mapInPandas(decode, "file string, text string, error string"), "text")
    text = markdown_to_text(universal_newlines("text"))
    docs = rows.select(F.col("file").alias("id"), stem_to_title(file_stem("file")).alias("title"), text.alias("text"), F.lit("markdown").alias("source"), "file")
    return docs.filter(F.length("text") >= least), errors.select("file", "error")


def read_text_files(spark: SparkSession, folder: str, least: int = 200) -> DataFrame:
    """The documents of ``scan_text_files``."""
    return scan_text_files(spark, folder, least)[0]


def in_path_order(df: DataFrame, path: str = "file") -> DataFrame:
    return df.orderBy(path_parts(path))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``md5, filename, place`` of lines with exactly two words."""
    words = F.split(py_strip("value"), r"\s+")
    rows = spark.read.text(path).select(words.alias("w"), F.monotonically_increasing_id().alias("place"))
    return rows.filter(F.size("w") == 2).select(F.col("w")[0].alias("md5"), F.col("w")[1].alias("filename"), "place")


def checksum_of(checksums: DataFrame, order: str | None = None) -> DataFrame:
    """``filename, md5``: the first checksum of each file; without an order the least one."""
    known = checksums.filter("md5 is not null and filename is not null")
    first = F.min_by(F.lower("md5"), order) if order else F.min(F.lower("md5"))
    return known.groupBy("filename").agg(first.alias("md5"))


def file_digests(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``file, md5`` of the files below a folder."""
    return _files(spark, folder, glob).select("file", F.md5("content").alias("md5"))


def packed_rows(spark: SparkSession, path: str) -> int:
    """The number of packed sequences, from the files' footers."""
    return spark.read.parquet(path).count()
