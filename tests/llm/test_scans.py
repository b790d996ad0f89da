"""Scanned text: kinds of lines and paragraphs on a small file."""

import pytest

from grainmill.llm import scans
from grainmill.llm.scans import Reader, _value, line_noise, paragraphs, skeleton, words_of

PLAIN = "Die Verwaltung wurde im Frühjahr erweitert und die Bibliothek liegt nördlich von Kaloleck. Der Bericht nannte eine Summe für das Kraftwerk der kleinen Gemeinde und die Landstraße blieb lange gesperrt."
SCAN = "\n".join(["Mitteilungen aus Kaloleck, Heft 12", "Die Verwa1tung wurde im Frühjahr erweitert und die Biblio-", "thek liegt nördlich von Kaloleck. Der Be richt nannte eine", "Summe für das Kraftwerk der kleinen Ge¬", "3", "", "4  Mitteilungen aus Kaloleck, Heft 12", "meinde und die Land^straße blieb lange gesperrt. Die Haupt-", "und Nebenstraße auch.", "4"])


@pytest.fixture(scope="module")
def table(spark):
    wrap = "\n".join(" ".join(PLAIN.split()[i : i + 9]) for i in range(0, len(PLAIN.split()), 9))
    rows = [(i, wrap, f"Bericht {i}", "bericht", "clash") for i in range(12)]
    rows += [(100, SCAN, "kraftwerk kaloleck", "kraftwerk-kaloleck", "clash"), (101, None, None, None, None), (102, "", None, None, None), (103, "x" * 50_000, None, None, None), (100, SCAN, "kraftwerk kaloleck", "kraftwerk-kaloleck", "again")]
    return spark.createDataFrame(rows, "pdf_no bigint, text string, title string, id string, kinds string").repartition(3)


def test_kinds(table):
    got = sorted((r["line_no"], r["kind"]) for r in line_noise(table).filter("pdf_no = 100").collect())
    want = [(1, "header"), (2, "hyphen"), (2, "ocr"), (3, "ocr"), (4, "hyphen"), (5, "page_number"), (7, "header"), (8, "ocr"), (10, "page_number")]
    assert got == sorted(want * 2)
    assert line_noise(table).filter("pdf_no != 100").count() == 0
    assert line_noise(table.limit(0)).count() == 0


def test_paragraphs(table):
    one = table.filter("kinds is null or kinds != 'again'")
    rows = {}
    for r in paragraphs(one).collect():
        rows.setdefault(r["pdf_no"], []).append((r["par_no"], r["text"]))
    assert [t for _, t in sorted(rows[100])] == ["Die Verwaltung wurde im Frühjahr erweitert und die Bibliothek liegt nördlich von Kaloleck. Der Bericht nannte eine Summe für das Kraftwerk der kleinen Gemeinde und die Landstraße blieb lange gesperrt. Die Haupt- und Nebenstraße auch."]
    assert [t for _, t in rows[0]] == [PLAIN] and 101 not in rows and 102 not in rows and len(rows[103][0][1]) == 50_000


def test_parts():
    assert skeleton("Verwa1tung") == skeleton("Verwaltung") and skeleton("rnit") == skeleton("mit") and skeleton("kiirzer") == skeleton("kürzer")
    assert words_of("„Ein- und Auslauf“, (West-Ost-Leitung).") == ["Ein-", "und", "Auslauf", "West", "Ost", "Leitung"]
    assert [_value(x) for x in ("12", "iv", "xl", "l2", "abc")] == [12, 4, 40, 12, None]
    r = Reader({"Meter": 90, "Mefer": 2, "kennt": 50}, {})
    assert r.repaired("Mefer") == "Meter" and r.repaired("Meter") is None and r._misread("Kalofeck", "") is None


def kinds_of(df):
    return sorted((r["pdf_no"], r["line_no"], r["kind"]) for r in line_noise(df).collect())


def test_rarer_forms_are_joined_without_loss(table, monkeypatch):
    """Whatever share of the forms is broadcast, the result is the same."""
    want = kinds_of(table)
    monkeypatch.setattr(scans, "BROADCAST_SHARE", 0.9)
    assert kinds_of(table) == want
    monkeypatch.setattr(scans, "BROADCAST_HINTS", 2)
    assert kinds_of(table) == want


def test_a_form_of_three_files_repairs_a_word(spark, monkeypatch):
    rows = [(i, f"Die Gemeinde {x} liegt hier.", None, None) for i, x in enumerate(["Moorleitung"] * 3 + ["Moor1eitung", "Moorleifung", "Kalomond"] + ["Talweg"] * 40)]
    df = spark.createDataFrame(rows, "pdf_no bigint, text string, title string, id string")
    for share in (0.002, 0.5):
        monkeypatch.setattr(scans, "BROADCAST_SHARE", share)
        assert {r[0] for r in kinds_of(df) if r[2] == "ocr"} == {3, 4}, share


def test_series_titles_are_found_by_their_pattern(spark):
    """The title of a series differs in place and number from file to file, and each file shows it once."""
    names = ["Kaloleck", "Ostimond", "Garerf", "Hulemin", "Torawyn", "Zelurk", "Pasonar"]
    body = "die Verwaltung liegt im Tal und wurde erweitert,\nso sagt es der Bericht der Gemeinde."
    rows = [(i, f"Blätter aus {x}, Heft {i + 3}\n{body}\n\nAuch {body}", None, None) for i, x in enumerate(names)]
    rows += [(20 + i, f"Heute sagt man: {body}\n\nDort {body}", None, None) for i in range(7)]
    df = spark.createDataFrame(rows, "pdf_no bigint, text string, title string, id string")
    assert [r for r in kinds_of(df) if r[2] == "header"] == [(i, 1, "header") for i in range(7)]


def test_the_share_that_is_broadcast_changes_nothing(spark, monkeypatch):
    """Rarer words, pairs of words and words with a hyphen count as frequent ones do, at any number of files."""
    texts = ["Das Moor ist nass und der Weg durch das Tal ist lang."] * 30
    texts += ["Die Moorleitung liegt hier."] * 3 + ["Die Moor leitung liegt hier."]  # a gap behind a frequent word
    texts += ["Sie kam sehr tief zum Rand."] * 4 + ["Sie kam sehr fief zum Rand."] * 3 + ["Sie kam sehr t1ef zum Rand."]  # the word before decides
    texts += ["Man fuhr in Nord-Süd oft."] * 3 + ["Man fuhr in Nord-\nSüd oft."]  # no divided word
    texts += ["Die Hofstraße ruht."] * 3 + ["Die Hofstras^se ruht."]  # known by another spelling
    texts += ["Ein Protokoll ruht."] * 3 + ["Ein Pr6fokoll ruht."]
    texts += ["wie die berichte sagen"] * 3 + [f"BERICHTE AUS {x}, HEFT {i + 3}\ndas Tal ist lang und nass, so sagt man dort." for i, x in enumerate(("KALOLECK", "OSTIMOND", "GARERF", "HULEMIN", "TORAWYN"))]
    df = spark.createDataFrame(list(enumerate(texts)), "pdf_no bigint, text string").selectExpr("*", "string(null) as title", "string(null) as id")
    seen = {}
    for share in (0.002, 0.1, 0.5):
        monkeypatch.setattr(scans, "BROADCAST_SHARE", share)
        seen[share] = sorted((r["pdf_no"], r["line_no"], tuple(r["kinds"]), r["repaired"]) for r in scans.read_lines(df).collect())
    assert (33, 1, ("ocr",), "Die Moorleitung liegt hier.") in seen[0.002]
    assert (41, 1, ("ocr",), "Sie kam sehr tief zum Rand.") in seen[0.002]
    assert (45, 1, (), "Man fuhr in Nord-") in seen[0.002]
    assert (49, 1, ("ocr",), "Die Hofstrasse ruht.") in seen[0.002] and (53, 1, ("ocr",), "Ein Protokoll ruht.") in seen[0.002]
    assert seen[0.1] == seen[0.002] and seen[0.5] == seen[0.002]
