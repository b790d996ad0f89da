"""Languages of documents and lines on held-out sentences."""

import random

import numpy as np
import pytest

from grainmill.llm.langid import LANGS, Network, _columns, label_errors, languages, train, windows_of

WORDS = {
    "de": "der die das und von wurde nach eine mit dem zur seit gehört zählte Gebäude Verwaltung zwischen liegt Wasserversorgung kleine bekannte",
    "en": "the of and was with which near from between known water supply building while although their council without being asked early",
    "es": "el la los una con para según entre conocida del pueblo durante sequía fábrica papel aunque mientras hasta nueva antigua",
    "fr": "le la les une avec pour selon entre connue du pendant sécheresse papeterie bien que jusqu nouvelle ancienne construite près",
    "nl": "het een van met voor volgens tussen bekende tijdens droogte papierfabriek hoewel terwijl tot nieuwe oude gebouwd niet ver",
}


def sentence(lang, r):
    return " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randrange(10, 18))) + "."


@pytest.fixture(scope="module")
def net(spark):
    r = random.Random(0)
    rows = [(lang, sentence(lang, r)) for lang in LANGS for _ in range(25)] + [(None, "x"), ("xx", "y"), ("de", None)]
    return train(spark.createDataFrame(rows, "lang string, text string"), hidden=10, steps=220)


def test_gradient_is_right():
    net = Network(3)
    windows, y = [b"abcd", b"ba", b"c"], np.array([0, 1, 2])
    x, live, order = _columns(windows)
    grad = net._gradient(x, live, y[order])

    def loss():
        logs, _ = net.pooled(windows)
        return -sum(logs[i, y[i]] for i in range(3)) / 7

    for name in ("Ef", "Eb", "Uf", "Ub", "Vf", "b"):
        w = net.w[name].reshape(-1)
        for k in np.argsort(-np.abs(grad[name].reshape(-1)))[:3]:
            old = w[k]
            w[k] = old + 1e-2
            up = loss()
            w[k] = old - 1e-2
            down = loss()
            w[k] = old
            assert abs((up - down) / 2e-2 - grad[name].reshape(-1)[k]) < 2e-3, name


def test_windows_keep_every_byte():
    raw = b"word " * 100 + b"x" * 500
    assert b"".join(windows_of(raw)) == raw and max(map(len, windows_of(raw))) <= 96


def test_held_out_accuracy(net):
    r = random.Random(99)
    own = [(lang, sentence(lang, r)) for lang in LANGS for _ in range(40)]
    logs, _ = net.pooled([t.lower().encode()[:96] for _, t in own])
    assert np.mean([LANGS[k] == lang for k, (lang, _) in zip(logs.argmax(1), own)]) > 0.97


def test_documents_and_lines(spark, net):
    r = random.Random(5)
    de, fr = ["\n".join(sentence(x, r) for _ in range(4)) for x in ("de", "fr")]
    rows = [(1, "de", de), (2, "DE-at", de), (3, "en", de), (4, None, de), (5, " ", fr.upper()), (6, "fr", fr + "\n\n  \n" + sentence("de", r)), (7, "de", None), (8, "None", ""), (9, "n/a", " \n "), (10, "de", de + "\nNotes"), (11, "de", de * 40), (3, "en", de)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "ord bigint, lang string, text string, seg_no string").repartition(3)
    out = languages(df, net)
    got = sorted((x["ord"], x["seg_no"], x["lang"]) for x in label_errors(out).collect())
    assert got == [(3, 0, "de"), (3, 0, "de"), (4, 0, "de"), (5, 0, "fr"), (6, 5, "de")]
    doc = {x["ord"]: x for x in out.filter("seg_no = 0").collect()}
    assert len(doc) == 11 and doc[7]["lang"] is None and doc[9]["confidence"] == 0 and 0.5 < doc[1]["confidence"] <= 1
    assert languages(df.limit(0), net).count() == 0


def test_languages_come_from_the_samples(spark):
    r = random.Random(3)
    rows = [(lang, sentence(lang, r)) for lang in ("de", "fr") for _ in range(12)] + [("en", "too few samples")]
    own = train(spark.createDataFrame(rows, "lang string, text string"), hidden=6, steps=90)
    assert own.langs == ("de", "fr") and own.pooled([b"der die das"])[0].shape == (1, 2)
    df = spark.createDataFrame([(1, None, sentence("fr", r)), (2, "de", sentence("de", r))], "ord bigint, lang string, text string")
    assert [(x["ord"], x["lang"]) for x in label_errors(languages(df, own)).collect()] == [(1, "fr")]
