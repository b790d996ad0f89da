"""Files in and out."""

import json

import pytest

from grainmill.runtime import ensure_checkpoint_dir
from grainmill.sources import readers, sinks
from grainmill.streaming import ingest


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_jsonl(spark, tmp_path):
    p = lines(tmp_path / "a.jsonl", [{"id": "1", "text": "ä"}, "", "   ", {"id": "2", "lang": None}])
    assert {r["id"] for r in readers.read_jsonl(spark, p).collect()} == {"1", "2"}
    bad = lines(tmp_path / "b.jsonl", [{"id": "1"}, "{broken"])
    with pytest.raises(Exception):
        readers.read_jsonl(spark, bad).collect()
    compat = {r["id"]: r["lang"] for r in readers.read_jsonl_compat(spark, p, ["id", "lang"]).collect()}
    assert compat == {"1": "", "2": "None"}
    with pytest.raises(KeyError):
        readers.read_texts(spark, lines(tmp_path / "c.jsonl", [{"id": "1"}]))


def test_ordered(spark, tmp_path):
    a = lines(tmp_path / "z.jsonl", [{"id": "1"}, "", {"id": "2"}])
    b = lines(tmp_path / "a.jsonl", [{"id": "3"}])
    assert [r["id"] for r in readers.read_ordered(spark, [a, b]).orderBy("ord").collect()] == ["1", "2", "3"]


def test_wiki_shards(spark, tmp_path):
    doc = {"id": "1", "title": "t", "url": "u", "text": "  " + "x" * 200}
    lines(tmp_path / "AA" / "wiki_00", [doc, {**doc, "id": "2", "text": "x" * 199 + "   "}])
    lines(tmp_path / "AB" / "other", [doc])
    rows = readers.read_wiki_shards(spark, str(tmp_path), "de").collect()
    assert [(r["id"], len(r["text"]), r["source"], r["lang"], r["shard"]) for r in rows] == [("1", 200, "wikipedia", "de", "wiki_00")]


def test_wiki_pages(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>T</title><ns>0</ns><id>7</id><revision><id>1</id><text bytes='3'>abc</text></revision></page></mediawiki>")
    r = readers.read_wiki_pages(spark, str(tmp_path / "d.xml")).first()
    assert (r["id"], r["title"], r["text"]) == ("7", "T", "abc")


def test_text_files(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "sub dir" / "C_x-y.MD").write_bytes(b"a\r\n---\r\nb\xff" + b"z" * 300)
    (tmp_path / "n.html").write_text("z" * 400)
    rows = readers.read_text_files(spark, str(tmp_path)).collect()
    assert [(r["id"], r["title"], r["source"]) for r in rows] == [("sub dir/C_x-y.MD", "C x y", "markdown")]
    assert rows[0]["text"].startswith("a\n\nb�z")


def test_pdfs(spark, tmp_path):
    (tmp_path / "A.PDF").write_bytes(b"x")
    (tmp_path / "b_c.pdf").write_bytes(b"one|  |two")
    (tmp_path / "bad.pdf").write_bytes(b"!")

    def pages(content):
        if content == b"!":
            raise ValueError("no pages")
        return [p * 300 if p.strip() else p for p in content.decode().split("|")]

    docs, errors = readers.read_pdfs(spark, str(tmp_path), pages)
    assert [(r["id"], r["title"], r["file"]) for r in docs.collect()] == [("b_c", "b c", "b_c.pdf")]
    assert [(r["file"], r["error"]) for r in errors.collect()] == [("bad.pdf", "no pages")]


def test_pages_and_checksums(spark, tmp_path):
    p = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a"), ("f", 1, "a"), ("f", 3, "  "), ("f", 4, None)], "path string, page int, page_text string")
    assert [(r["path"], r["text"]) for r in readers.join_pages(p).collect()] == [("f", "a\n\nb")]
    (tmp_path / "sums.txt").write_text("AB x\ncd x\nthree words here\nef y\n")
    got = {r["filename"]: r["md5"] for r in readers.checksum_of(readers.read_checksums(spark, str(tmp_path / "sums.txt")), "place").collect()}
    assert got == {"x": "ab", "y": "ef"}
    assert readers.file_digests(spark, str(tmp_path)).first()["file"] == "sums.txt"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", None, "ä")], "id string, lang string, text string")
    out = tmp_path / "o.jsonl"
    sinks.export_one_file(df, str(out))
    assert out.read_text(encoding="utf-8") == '{"id":"1","text":"ä"}\n'
    sinks.export_one_file(df, str(out), keep_nulls=True)
    assert json.loads(out.read_text(encoding="utf-8")) == {"id": "1", "lang": None, "text": "ä"}
    assert sinks.write_once(df, str(tmp_path / "w")) and not sinks.write_once(df, str(tmp_path / "w"))
    assert readers.packed_rows(spark, str(tmp_path / "w")) == 1
    sinks.write_splits({"template": df, "llm_qa": None}, str(tmp_path / "s"))
    assert [r["split"] for r in spark.read.json(str(tmp_path / "s")).collect()] == ["template"]


def test_stream(spark, tmp_path):
    lines(tmp_path / "in" / "a.jsonl", [{"id": "1", "text": "x" * 200}, {"id": "2", "text": "x"}])
    ingest.land(ingest.keyed(ingest.read_jsonl_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["1"]


def test_checkpoint_dir_is_kept(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)
