"""Defective pairs: labelled cases, and the label model on known votes."""

import numpy as np
import pytest

from grainmill.llm import pairs

SAMPLES = {
    "de": "Die Verwaltung, die man im Tal kennt, ersetzte die kleine Bibliothek und wurde im Jahr 1850 von der Gemeinde gegründet.",
    "en": "The administration, known in the valley, replaced the small library and was founded in the year 1850 by the parish.",
    "es": "La administración, conocida en el valle, sustituyó la biblioteca pequeña y fue fundada en el año 1850 por el municipio.",
    "fr": "L'administration, connue dans la vallée, remplaça la petite bibliothèque et fut fondée en 1850 par la commune.",
    "nl": "Het bestuur, dat men in het dal kent, verving de kleine bibliotheek en werd in het jaar 1850 door de gemeente opgericht.",
}
Q = "Wann wurde Ziegelei Kaloleck gegründet?"
SOUND = "Ziegelei Kaloleck wurde im Jahr 1850 von der Gemeinde Kaloleck gegründet. Die kleine Bibliothek liegt im Tal von Kaloleck."
CASES = [
    (Q, None, "empty"), (Q, "", "empty"), (Q, " ​\n", "empty"), (Q, "N/A", "empty"), (Q, "None", "empty"), (Q, "A1:", "empty"), (Q, "[...]", "empty"), (Q, "?", "empty"),
    (Q, Q, "copy"), (Q, Q.upper(), "copy"), (Q, "Antwort: " + Q, "copy"), (Q, Q[:-1] + ".", "copy"), (Q, Q + " " + Q, "copy"), ("Q2: " + Q, Q, "copy"),
    (Q, "Dazu kann ich leider keine Auskunft geben.", "refusal"), (Q, "I'm sorry, but I can't help with that request.", "refusal"), (Q, "Ziegelei Kaloleck: Das weiß ich nicht.", "refusal"), (Q, "Als Sprachmodell bin ich nicht in der Lage, diese Frage zu beantworten. Bitte wenden Sie sich an eine Fachstelle.", "refusal"),
    (Q, "Ziegelei Kaloleck wurde im Jahr 1850 von der Gemeinde", "truncated"), (Q, SOUND + " Gemeint sind die Gebäude, d. h.", "truncated"), (Q, SOUND + " Die Ziegelei (die kleine", "truncated"), (Q, SOUND[:-1] + ",", "truncated"),
    (Q, "The brickworks were founded in the year 1850 by the parish and replaced the small library in the valley.", "wrong_language"),
    (Q, SOUND, None), (Q, SOUND[:-1], None), (Q, SOUND + " (Ziegelei Kaloleck)", None), (Q, "im Jahr 1850", None), (Q, Q + " " + SOUND, None), (Q, "Der Rat schrieb 1850: „Dazu kann ich keine Auskunft geben“, und lehnte 12 Anträge ab.", None), ("Übersetze ins Englische: Die Ziegelei wurde im Jahr 1850 von der Gemeinde gegründet.", "The brickworks were founded in the year 1850 by the parish and it replaced the small library.", None), (None, SOUND, None), (Q, SOUND * 300, None), (Q, SOUND, None),
]


@pytest.fixture(scope="module")
def labelled(spark):
    filler = [(1000 + i, Q.replace("Kaloleck", f"Ort{chr(65 + i % 26)}tal"), SOUND.replace("Kaloleck", f"Ort{chr(65 + i % 26)}tal").replace("1850", str(1500 + i)), "x") for i in range(300)]
    filler += [(2000 + i, Q, f"im Jahr {1600 + i}", "x") for i in range(12)]
    rows = [(i, q, a, "clash") for i, (q, a, _) in enumerate(CASES)] + filler
    df = spark.createDataFrame(rows, "pair_id bigint, instruction string, output string, defect string").repartition(3)
    return df, spark.createDataFrame(list(SAMPLES.items()) + [("xx", None)], "lang string, text string")


def found(df, samples, **more):
    return {r["pair_id"]: r["defect"] for r in pairs.one_defect(pairs.defects(df, samples, **more)).collect()}


def test_cases(labelled):
    got = found(*labelled)
    assert {i: got.get(i) for i in range(len(CASES))} == {i: d for i, (_, _, d) in enumerate(CASES)}
    assert not {k for k in got if k >= 1000}


@pytest.mark.parametrize("cutoff", [0.3, 0.7])
def test_cutoffs_hold_over_a_range(labelled, cutoff):
    got = found(*labelled, cutoffs=dict.fromkeys(pairs.DEFECTS, cutoff))
    assert {i: got.get(i) for i in range(len(CASES))} == {i: d for i, (_, _, d) in enumerate(CASES)}


def test_empty_table(labelled):
    df, samples = labelled
    assert pairs.defects(df.limit(0), samples).count() == 0


def test_label_model_finds_the_share():
    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.1
    votes = np.stack([np.where(r.random(20_000) < skip, 0, np.where(r.random(20_000) < good, truth, ~truth) * 2 - 1) for good, skip in ((0.95, 0.1), (0.9, 0.0), (0.85, 0.5))], axis=1)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = pairs.LabelModel(patterns, n.astype(float))
    assert abs(model.prior - 0.1) < 0.03
    assert np.mean((model.posterior(patterns)[at.ravel()] > 0.5) == truth) > 0.95
    assert len(pairs.LabelModel(np.empty((0, 0), dtype=int), np.empty(0)).posterior(np.empty((0, 0), dtype=int))) == 0


#: Refusals whose telling words are stems or stand before a hyphen.
STEMS = ["Mir liegen dazu keinerlei Angaben vor.", "Dazu kann ich keinerlei Auskunft geben.", "Je suis désolée, cette question dépasse mes compétences.", "Als KI-Modell muss ich die Antwort offen lassen."]


@pytest.mark.parametrize("answer", STEMS)
def test_refusals_by_stem(answer):
    assert sum(pairs.votes_of(pairs.Languages(list(SAMPLES.items())), Q, answer)["refusal"]) > 0


def examples(parts):
    """Texts built from a parsed pattern, with each of its branches."""
    out = [""]
    for op, arg in parts:
        name = str(op)
        if name == "LITERAL":
            new = [chr(arg)]
        elif name in ("SUBPATTERN", "ASSERT"):
            new = examples(arg[-1])
        elif name == "IN":
            new = [chr(x) for kind, x in arg if str(kind) == "LITERAL"] or [""]
        elif name == "BRANCH":
            new = [x for b in arg[1] for x in examples(b)]
        elif name == "MAX_REPEAT":
            new = [x * arg[0] for x in examples(arg[2])] if arg[0] else ["", *examples(arg[2])] if arg[1] == 1 else [" ", "x "]
        else:
            new = [""]
        out = [a + b for a in out for b in dict.fromkeys(new)]
    return out


@pytest.mark.parametrize("i", range(len(pairs.REFUSALS)))
def test_no_phrase_is_skipped(i):
    texts = [x for x in examples(pairs._parser.parse(pairs.REFUSALS[i])) if pairs.REFUSAL[i].search(x)]
    assert texts and all(any(n in x for n in pairs.required(pairs.REFUSALS[i])) or i in pairs.ALWAYS for x in texts)
    assert all(pairs.declines(x) for x in texts)


def test_required_literals():
    assert pairs.required(r"\bab(?:cde|fgh)?\b") == {"ab"} and pairs.required(r"x\b yz.(?:cdefg|hijkl)") == {"cdefg", "hijkl"}
    assert not pairs.required(r"(?:ab|[cd])\w*") and pairs.required(r"(?:ab)+c*") == {"ab"}


def test_cutoffs_are_validated(labelled):
    """No other cutoff tells the labelled pairs better, defect by defect; a copy's or refusal's second label is not judged."""
    post = {}
    for r in pairs.defects(*labelled, cutoffs=dict.fromkeys(pairs.DEFECTS, 0.001)).collect():
        post[r["pair_id"], r["defect"]] = r["posterior"]
    for d in pairs.DEFECTS:
        truth = {i: c == d for i, (_, _, c) in enumerate(CASES) if c in (d, None)}

        def f1(cutoff):
            got = {i for i in truth if post.get((i, d), 0) >= cutoff}
            return 2 * sum(truth[i] for i in got) / (len(got) + sum(truth.values()))

        assert f1(pairs.CUTOFFS[d]) == max(f1(x / 100) for x in range(1, 100)) == 1, d


def test_several_labels(labelled):
    df, samples = labelled
    more = [(5001, Q, "I'm sorry, but I cannot answer this question about the place, because"), (5002, Q, "The old library and the small administration of the valley were founded in the year 1850 by the")]
    df = df.unionByName(df.sparkSession.createDataFrame([(i, q, a, "x") for i, q, a in more], df.schema))
    got = {}
    for r in pairs.defects(df, samples).collect():
        got.setdefault(r["pair_id"], set()).add(r["defect"])
    assert got[5001] == {"refusal", "truncated", "wrong_language"} and got[5002] == {"truncated", "wrong_language"}
    assert {r["pair_id"]: r["defect"] for r in pairs.one_defect(pairs.defects(df, samples)).collect()}[5001] == "refusal"


def test_functions_do_not_know_other_defects():
    votes = pairs.votes_of(pairs.Languages(list(SAMPLES.items())), Q, "Dazu kann ich leider keine Auskunft geben, weil")
    assert votes["refusal"][0] == 1 and votes["truncated"][1] == 1 and max(votes["wrong_language"]) <= 0
    assert {d: len(v) for d, v in votes.items()} == {d: n - 2 * (d == "truncated") for d, n in pairs.FUNCTIONS.items()}
    assert [pairs._decode(pairs._encode(v), len(v)) for v in votes.values()] == list(votes.values())


def test_runs_at_the_end_are_among_all_runs():
    """What is looked up for an answer's end is what the count of another answer holds."""
    w = pairs.Words(frozenset({"die", "alte", "liegt", "im", "Tal"}), pairs.Languages(list(SAMPLES.items())))
    whole = w.codes(["Die alte Ziegelei liegt im Tal von Kalo Leck. Mehr 12.", "- die alte\n- die neue\n"])
    met = {}
    for h, done in pairs.Runs(w, *whole).all():
        for x, d in zip(h.astype("int64").tolist(), done.tolist()):
            met.setdefault(x, []).append(d)
    got = [{}, {}]
    for i, r, h in zip(*(x.tolist() for x in pairs.Runs(w, *w.codes(["liegt im Tal von Ost Wyn", "- die alte"])).last())):
        got[i][r] = met.get(h)
    assert [got[0][r] for r in (2, 3, 4)] == [[True]] * 3 and got[0][13] is None and got[1][1] == [True]
    assert not len(pairs.Runs(w, *w.codes(["", ""])).last()[0]) and not len(pairs.Runs(w, *w.codes([])).last()[0])


def test_every_phrase_is_searched_where_a_word_stands_for_it():
    w = pairs.Words(frozenset(), pairs.Languages([]))
    for i in range(len(pairs.REFUSALS)):
        for x in examples(pairs._parser.parse(pairs.REFUSALS[i])):
            if pairs.REFUSAL[i].search(x):
                codes, _ = w.codes([x])
                assert i in pairs.BARE or any(i in w.phrases[c] for c in codes.tolist()), (i, x)
