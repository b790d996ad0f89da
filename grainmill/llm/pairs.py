"""Defective question-answer pairs (problem 1).

Labelling functions vote on every pair and defect: 1 for, -1 against, 0 undecided. They look at different things and know
nothing of each other or of other defects. Per defect, a label model fitted by expectation maximization learns how far
each function can be trusted and turns patterns of votes into posteriors; a pair gets every label above its cutoff.
"""

from __future__ import annotations

import re
from collections import Counter
from re import _constants, _parser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The defects in the order in which one is chosen where several apply: what is blank or copied says nothing further.
DEFECTS = ("empty", "copy", "refusal", "truncated", "wrong_language")
#: The posterior from which a label is given. The tests validate each on labelled pairs that the fit does not see as such.
CUTOFFS = {"empty": 0.5, "copy": 0.5, "refusal": 0.5, "truncated": 0.5, "wrong_language": 0.5}
#: The prior share of a defect at the start, and how many made-up votes hold a function near its first accuracy.
PRIOR, STRENGTH = 0.03, 50.0

#: Answers that only hold a place.
PLACEHOLDERS = {"none", "null", "nan", "n/a", "na", "n.a", "nil", "undefined", "unknown", "tbd", "todo", "xxx", "...", "[...]", "k. a", "k.a"}
LEAD_IN = re.compile(r"\A\W*(?:(?:[qafb]|frage|antwort|answer|question|réponse|respuesta|pregunta|antwoord|vraag|output|response)\s*\d*\s*[:.)]\s*)+", re.I)
#: Stock phrases of declining, per language, without accents and in lower case.
REFUSALS = [
    # German
    r"\bich weiss (?:es|das|dies|hierzu|dazu)?\s?(?:leider )?nicht", r"\bweiss ich (?:leider )?nicht", r"\b(?:kann|darf|moechte|mochte|will|werde)\b[^.]{0,60}\bich\b[^.]{0,60}\b(?:nicht|nichts|kein\w*)\b", r"\bich\b[^.]{0,70}\b(?:nicht|nichts|keine?n?)\b[^.]{0,50}\b(?:beantworten|helfen|sagen|antworten|beantworte|aeussern|auskunft|weiterhelfen|unterstuetzen|geben|lage)", r"\b(?:nicht|keine?)\b[^.]{0,40}\b(?:helfen|beantworten|auskunft geben)\.?\Z", r"\bliegen mir\b[^.]{0,30}\bkeine", r"\bmir (?:fehlt|fehlen|liegen|ist)\b[^.]{0,60}\b(?:zugriff|informationen|angaben|daten|passen|nicht|keine)", r"\blaesst sich (?:das|die|diese|dies|hierzu)?[^.]{0,40}\bnicht (?:beantworten|sagen|entnehmen)", r"\bals (?:sprachmodell|ki|assistent)", r"\bmuss ich (?:leider )?(?:passen|ablehnen)\b", r"\bnichts\b[^.]{0,40}\b(?:erlaubt|gestattet) (?:es )?mir\b", r"\bbeantworte ich\b[^.]{0,30}\bnicht", r"\bueberfordert\b", r"\b(?:richtlinien|vorgaben|regeln|bestimmungen)\b[^.]{0,40}\b(?:untersagen|verbieten|erlauben|gestatten|nicht)\b", r"\bantwort\b[^.]{0,30}\b(?:nicht moeglich|unmoeglich|schuldig)", r"\btext\b[^.]{0,20}\b(?:steht|findet sich|gibt|sagt|enthaelt)\b[^.]{0,20}\b(?:nichts|keine?n?)\b", r"\b(?:text|angaben|kontext|passage|abschnitt|auszug)\b[^.]{0,60}\b(?:nicht|keine|nichts)\b[^.]{0,40}\b(?:hervor|antwort|beantworten|entnehmen|auskunft|enthalten|genug|ausreich\w*)",
    # English
    r"\bi (?:do not|don't|dont|cannot|can't|cant|can not|am not|am unable|am sorry|won't|will not|would rather not|would prefer not)\b", r"\bi'm (?:sorry|afraid|not able|unable|only an|just an|not allowed|not in a position|not comfortable)\b", r"\bi'd (?:rather|prefer) not\b", r"\bas an? (?:ai|language model|artificial|assistant)\b", r"\b(?:guidelines|policy|policies|instructions|rules)\b[^.]{0,30}\b(?:not|forbid|prevent|prohibit)", r"\b(?:not enough|no|insufficient)\b[^.]{0,40}\b(?:context|information|details?)\b[^.]{0,40}\b(?:answer|say|me|reply|respond)", r"\b(?:text|passage|context)\b[^.]{0,60}\b(?:does not|doesn't|nothing|not)\b[^.]{0,40}\b(?:answer|say|mention|reply|contain|state|provide)", r"\bnothing in the\b[^.]{0,40}\blets me\b", r"\bno comment\b", r"\b(?:must|have to|need to) (?:decline|refuse|pass)\b", r"\binappropriate for me\b", r"\boutside (?:of )?what i\b", r"\b(?:not|isn't) (?:able|allowed|permitted|in a position) to\b", r"\b(?:answer|reply)\b[^.]{0,30}\b(?:impossible|not possible)\b", r"\bbeyond (?:me|my)\b",
    # French
    r"\bje (?:ne|n')\b[^.]{0,50}\b(?:pas|rien|aucun\w*)\b", r"\bje n'[^.]{0,50}\b(?:pas|rien|aucun\w*)\b", r"\bje prefere ne pas\b", r"\brien\b[^.]{0,40}\bne me permet\b", r"\bje (?:dois|prefere) (?:decliner|refuser|m'abstenir)", r"\bil m'est impossible\b", r"\bje suis (?:desole|incapable|dans l'impossibilite)", r"\ben tant (?:que|qu')\s?(?:modele|ia|intelligence|assistant)", r"\ble (?:texte|passage|contexte)\b[^.]{0,40}\b(?:ne|n')[^.]{0,50}\b(?:pas|rien|aucun\w*)\b", r"\bne (?:me )?permet(?:tent)? pas de\b[^.]{0,30}\b(?:repondre|dire)", r"\bimpossible de (?:repondre|vous)", r"\b(?:regles|consignes|directives)\b[^.]{0,40}\b(?:interdisent|permettent pas|empechent)", r"\breponse\b[^.]{0,40}\b(?:impossible|pas possible)",
    # Spanish
    r"\bno (?:puedo|se(?= responder| que| nada|[.,]|\Z)|tengo|dispongo|estoy|debo|quiero|me es posible|me permite\w*|sabria|soy capaz|cuento)\b", r"\blo siento\b", r"\bprefiero no\b", r"\bnada\b[^.]{0,40}\bme (?:permite|deja)\b", r"\b(?:debo|tengo que) (?:declinar|rechazar|abstenerme)", r"\bcomo (?:modelo|ia|asistente|inteligencia)\b", r"\bel (?:texto|pasaje|contexto|fragmento)\b[^.]{0,30}\bno\b", r"\bme (?:es|resulta) imposible\b", r"\b(?:normas|reglas|directrices|politicas)\b[^.]{0,40}\b(?:no|prohiben|impiden)\b", r"\brespuesta\b[^.]{0,40}\b(?:imposible|no es posible)", r"\bno (?:hay|existe\w*)\b[^.]{0,40}\b(?:suficiente\w*|informacion|datos|contexto)\b",
    # Dutch
    r"\b(?:kan|mag|wil|weet|zal|durf|ga|laat|heb)\b[^.]{0,30}\bik\b[^.]{0,60}\b(?:niet|niets|geen|liever)\b", r"\bik\b[^.]{0,60}\b(?:niet|niets|geen)\b[^.]{0,50}", r"\bhet spijt me\b", r"\bniets\b[^.]{0,40}\blaat me\b", r"\bmoet ik (?:helaas )?(?:weigeren|passen|afzien)", r"\bals (?:taalmodel|ai|assistent)\b", r"\b(?:tekst|passage|context|fragment)\b[^.]{0,50}\b(?:geen|niet|niets)\b", r"\bvalt\b[^.]{0,30}\bgeen antwoord\b", r"\blaat ik me liever niet\b", r"\b(?:richtlijnen|regels|voorschriften)\b[^.]{0,40}\b(?:verbieden|niet|geen)\b", r"\bantwoord\b[^.]{0,40}\b(?:schuldig|niet mogelijk|onmogelijk)",
]
REFUSAL = [re.compile(x) for x in REFUSALS]


def required(pattern: str) -> frozenset[str]:
    """Literals of which every match of a case-sensitive pattern holds at least one, read off the parsed pattern; empty
    if it guarantees none."""
    rank = lambda x: (min(map(len, x), default=0), -len(x))

    def of(parts) -> frozenset[str]:
        best, run = frozenset(), ""
        for op, arg in [*parts, (None, None)]:
            if op is _constants.LITERAL:
                run += chr(arg)
                continue
            if op is _constants.AT:  # takes no character, so that a literal goes on behind it
                continue
            own = frozenset()
            if op is _constants.SUBPATTERN:
                own = of(arg[-1])
            elif op is _constants.BRANCH:
                each = [of(x) for x in arg[1]]
                own = frozenset().union(*each) if all(each) else own
            elif op in (_constants.MAX_REPEAT, _constants.MIN_REPEAT) and arg[0] > 0:
                own = of(arg[2])
            best, run = max(best, own, frozenset([run] if run else []), key=rank), ""
        return best

    return of(_parser.parse(pattern))


#: Per literal, the phrases of which each match holds that literal or another one of theirs; and the phrases without any.
#: A phrase none of whose literals is in an answer cannot match it and is not searched.
LITERALS: dict[str, list[int]] = {}
for _i, _x in enumerate(REFUSALS):
    for _literal in sorted(required(_x)):
        LITERALS.setdefault(_literal, []).append(_i)
ALWAYS = [i for i, x in enumerate(REFUSALS) if not required(x)]


def declines(text: str) -> bool:
    """Whether any phrase of ``REFUSALS`` is in a text without accents and in lower case."""
    likely = {i for literal, at in LITERALS.items() if literal in text for i in at}
    return any(REFUSAL[i].search(text) for i in (*ALWAYS, *sorted(likely)))


FIRST_PERSON = re.compile(r"\b(?:ich|mir|mich|meine?r?|i|i'm|i'd|me|my|mes|mis|je|j'|m'|moi|mi|ik|mij|mijn|sprachmodell|taalmodel|language model|ai model|modele de langue|modelo de lenguaje)\b")
FIRST_VERB = re.compile(r"\b(?:puedo|tengo|dispongo|prefiero|lamento|siento)\b")
NEGATION = re.compile(r"\b(?:untersagen|verbieten|interdisent|prohiben|verbieden|forbid|nicht|nichts|kein\w*|passen|ueberfordert|not|no|nothing|cannot|can't|don't|won't|rather|unable|pas|rien|aucun\w*|impossible|imposible|niet|niets|geen|prefiero|lieber|liever|grundsaetzlich)\b")
QUOTED = re.compile(r"[„“”\"«»‚‘].{3,}?[“”\"»«’]|(?<!\w)['’][^'’]{8,}['’](?!\w)")
#: Words that end no sentence, and abbreviations whose point is not a full stop.
OPEN_WORDS = {
    "der", "die", "das", "den", "dem", "des", "ein", "eine", "einer", "einem", "eines", "und", "oder", "von", "im", "in", "mit", "bei", "zu", "zum", "zur", "für", "aus", "nach", "seit", "ab", "bis", "zwischen", "nördlich", "durch", "über", "wie", "dass", "weil", "obwohl", "wobei", "sodass", "rund", "sehr", "davon", "kurz", "während", "man",
    "the", "a", "an", "of", "and", "or", "to", "with", "by", "at", "for", "from", "into", "near", "between", "because", "although", "while", "whereas", "so", "that", "which", "whose", "about", "shortly",
    "le", "la", "les", "un", "une", "du", "de", "et", "ou", "à", "au", "aux", "avec", "pour", "par", "dans", "sur", "entre", "environ", "dont", "que", "qui", "parce", "bien",
    "el", "los", "las", "una", "del", "y", "o", "al", "con", "por", "para", "entre", "cerca", "unos", "según", "aunque", "mientras", "hasta", "desde", "se",
    "het", "een", "van", "en", "of", "met", "door", "voor", "naar", "uit", "aan", "tussen", "ongeveer", "omdat", "zodat", "hoewel", "terwijl", "om", "te", "sinds", "vanaf",
}
OPEN_ABBREVIATION = re.compile(r"(?:\b(?:z\.\s?B|u\.\s?a|d\.\s?h|i\.\s?d\.\s?R|v\.\s?a|bzw|ca|vgl|sog|ggf|inkl|insb|e\.\s?g|i\.\s?e|approx|incl|p\.\s?ex|c\.-à-d|c\.\s?à\s?d|env|p\.\s?ej|es decir|aprox|d\.\s?w\.\s?z|d\.\s?i|bijv|bv|o\.\s?a|n\.\s?l|Nr|No|núm|St|Dr|Prof|Hr|Fr|Mr|Mrs|M|vs|Bd|Jh|Abs|Art|S|p|pp))\.\Z", re.I)
STOPS = tuple(".!?…")
CLOSERS = "\"“”»«’‘')]*_ "

#: Names of the languages in the five languages, as stems.
ASKED = {"de": r"deutsch|german|allemand|alem[aá]n|duits", "en": r"englisch|english|anglais|ingl[eé]s|engels", "fr": r"franz[öo]e?sisch|french|fran[çc]ais|franc[eé]s|frans", "es": r"spanisch|spanish|espagnol|espa[ñn]ol|castellano|spaans", "nl": r"niederl[äa]e?ndisch|dutch|n[eé]erlandais|neerland[eé]s|holand[eé]s|nederlands"}
ASKED = {k: re.compile(rf"\b(?:{v})", re.I) for k, v in ASKED.items()}
STOPWORDS = {
    "de": "der die das und von im wurde wurden nach rund eine einer mit dem den zum zur seit ab bis bei auf am ist nicht dass wer wie für aus zwischen liegt gehört insgesamt vor wegen neuen welche welcher welchem welches wann wo wozu warum viele groß hat dient ein heute hoch wird werden jahr",
    "en": "the of and in was were near with by which from after for as that this is to between on before while although there about what where when how why who does did are because an at it many much year area",
    "fr": "le la les du des et de dans une sur à au aux près par entre avec fut furent été qui après selon pour en est quel quelle où quand combien pourquoi comment un il elle dont que l' d' se ce a-t-il est-il année",
    "es": "el la los las del y de en una con por al que fue para entre cerca según se desde hasta unos un es qué cuál cuándo dónde cuántas cómo quién su lo no año",
    "nl": "de het en van in een werd op met bij tussen wie voor na volgens sinds tot ten ongeveer tijdens uit dat wat waar wanneer hoe waarom hoeveel welke welk heeft dient is wordt door aan naar wegens jaar vandaag",
}
STOPWORDS = {k: set(v.split()) for k, v in STOPWORDS.items()}
WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*|\d+|\n|[^\w\s]")


class Languages:
    """Log-probabilities of character trigrams per language, from clean samples; and function words."""

    SIZE = 1 << 14

    def __init__(self, samples: list[tuple[str, str]]):
        self.langs = sorted(STOPWORDS)
        counts = np.full((len(self.langs), self.SIZE), 0.2)
        for lang, text in samples:
            if lang in self.langs:
                np.add.at(counts[self.langs.index(lang)], self._grams(text), 1)
        for i, lang in enumerate(self.langs):
            for w in STOPWORDS[lang]:
                np.add.at(counts[i], self._grams(w), 2)
        self.table = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)

    def _grams(self, text: str) -> np.ndarray:
        x = np.frombuffer(f" {re.sub(r'[\W\d_]+', ' ', text.lower())} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        if len(x) < 3:
            return np.empty(0, np.int64)
        return ((x[:-2] * 7919 + x[1:-1] * 104729 + x[2:] * 1299709) >> 1) % self.SIZE

    def of_words(self, words: list[str]) -> np.ndarray:
        """Per word and language, the log-probability of the word's trigrams, then how many function words it holds."""
        padded = [f" {LETTERLESS.sub(' ', w.lower())} " if w[0].isalpha() else "" for w in words]
        x = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        x = np.concatenate([x, [0, 0]])
        grams = ((x[:-2] * 7919 + x[1:-1] * 104729 + x[2:] * 1299709) >> 1) % self.SIZE
        size = np.array([len(p) for p in padded], dtype=np.int64)
        ends = np.cumsum(size)
        score = self.table.T[grams].astype(np.float64)
        for last in (1, 2):  # what begins in a word's last two places goes on in the next word
            score[ends[size > 0] - last] = 0
        out = np.zeros((len(words), 2 * len(self.langs)), dtype=np.float32)
        out[:, : len(self.langs)] = _sums(score, ends)
        for i, w in enumerate(words):
            for p in PART.findall(w.lower()):
                for k in LANGS_OF.get(p, ()):
                    out[i, len(self.langs) + self.langs.index(k)] += 1
        return out


LETTERLESS = re.compile(r"[\W\d_]+")
LANGS_OF: dict[str, list[str]] = {}
for _k in STOPWORDS:
    for _w in STOPWORDS[_k]:
        LANGS_OF.setdefault(_w, []).append(_k)
PART = re.compile(r"[^\W\d_]+(?:-t-il|-il)?['’]?")
_PLAIN = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "’": "'", "é": "e", "è": "e", "ê": "e", "á": "a", "à": "a", "í": "i", "ó": "o", "ú": "u", "ñ": "n", "ç": "c"})
UNSEEN = re.compile("[\u00ad\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufeff]+")


def _plain(text: str) -> str:
    return " ".join(text.lower().translate(_PLAIN).split())


def _only_letters(text: str) -> str:
    return re.sub(r"[\W_]+", "", text.lower())


def _without_lead(text: str) -> str:
    return LEAD_IN.sub("", text, count=1)


def _without_note(text: str) -> str:
    """The text before a closing remark in brackets."""
    s = text.rstrip()
    return re.sub(r"(?<=[.!?…])\s+\([^()]*\)\Z", "", s) if s.endswith(")") else s


def _opened(s: str) -> bool:
    """Whether a bracket or quotation is not closed."""
    return s.count("(") > s.count(")") or s.count("[") > s.count("]") or s.count("„") > s.count("“") + s.count("”") or s.count("«") > s.count("»") or (s.count("“") > s.count("”") and "„" not in s) or s.count('"') % 2 == 1


def _common_run(a: list[str], b: list[str]) -> float:
    """The share of ``a``'s words that ``b`` repeats in order, at one place."""
    n = len(a)
    if not n or len(b) < n:
        return 0.0
    return max(sum(x == y for x, y in zip(a, b[i : i + n])) for i in range(len(b) - n + 1)) / n


#: Properties of a word, as bits.
PERSON, NEGATION_WORD, PHRASE, DIGIT, QUOTE, BRACKET, LOWER, LETTER = (1 << i for i in range(8))
#: Kinds of tokens.
PUNCT, PLAIN, NEWLINE, DASH, STOP, START = range(6)
#: The longest word of a phrase's literal stands for the phrase: in a text that matches, a word begins with it, or is it
#: where the literal goes on behind it. A text without any such word is not searched.
STEMS: dict[tuple[str, bool], set[int]] = {}
for _literal, _at in LITERALS.items():
    _stem = max(re.findall(r"[^\W\d_]+", _literal), key=len, default="")
    STEMS.setdefault((_stem, re.search(rf"{_stem}\W", _literal) is not None), set()).update(_at)
BARE = sorted(set(ALWAYS).union(*(x for (stem, _), x in STEMS.items() if not stem)))
EXACT, BEGUN = ({stem: x for (stem, whole), x in STEMS.items() if whole == kind and stem} for kind in (True, False))
BEGUN_SIZES = sorted({len(x) for x in BEGUN})


def _phrases(plain: str) -> frozenset[int]:
    """The phrases that a word may stand for."""
    out: set[int] = set()
    for part in re.findall(r"[^\W\d_]+", plain):
        if part in EXACT:
            out |= EXACT[part]
        for n in BEGUN_SIZES:
            if n > len(part):
                break
            if part[:n] in BEGUN:
                out |= BEGUN[part[:n]]
    return frozenset(out)


#: Letters that one of the languages writes and the others hardly do.
CLUES = {"de": "äöüß", "es": "ñ¿¡áíóú", "fr": "çœèêàùûî"}


class Words:
    """Properties of all words seen so far, looked up by code; a text becomes an array of codes.

    ``known`` are the words that stay themselves when names and rare words are masked.
    """

    def __init__(self, known: frozenset[str], lang: Languages):
        self.known, self.lang = known, lang
        self._clear()

    def __getstate__(self):
        return {"known": self.known, "lang": self.lang}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.word: list[str] = []
        self.long: list[bool] = []
        self.rows: list[tuple] = []
        self.phrases: list[frozenset[int]] = []
        self.arrays: list[np.ndarray] = []
        self._add("\x00")
        self._add("0")

    def _add(self, w: str) -> int:
        if w[0].isdigit() and "0" in self.code:
            c = self.code[w] = self.code["0"]  # all numbers are one
            return c
        c = self.code[w] = len(self.rows)
        p = _plain(w)
        first, word = w[0], w[0].isalpha()
        flags = (PERSON if FIRST_PERSON.search(p) or FIRST_VERB.search(p) else 0) | (NEGATION_WORD if NEGATION.search(p) else 0)
        flags |= (DIGIT if first.isdigit() else 0) | (QUOTE if first in "„“”\"«»‚‘'’" else 0) | (BRACKET if first in "()[]„“”\"«»" else 0) | (LOWER if word and first.islower() else 0) | (LETTER if word or first.isdigit() else 0)
        at = _phrases(p)
        name = word and first.isupper() and w not in self.known and w.lower() not in self.known
        seen = "#" if first.isdigit() else w
        masked = seen if not word or w in self.known or w.lower() in self.known else "N" if name else "u"
        kind = START if w == "\x00" else PLAIN if flags & LETTER else NEWLINE if w == "\n" else DASH if w == "-" else STOP if w in ".!?" else PUNCT
        h = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) for x in (seen, masked)]
        self.rows.append((*h, flags | (PHRASE if at else 0), kind, name))
        self.phrases.append(at)
        self.word.append(w)
        self.long.append(word and first.isupper() and len(w) > 4)
        return c

    def codes(self, texts: list[str], start: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all texts' tokens, and where each text ends; a mark opens each text unless ``start`` is false."""
        if len(self.rows) > 400_000:
            self._clear()
        find, code, add = WORD.findall, self.code, self._add
        flat: list[int] = []
        ends = []
        for t in texts:
            if start:
                flat.append(0)
            flat += [code[w] if w in code else add(w) for w in find(t)]
            ends.append(len(flat))
        done = len(self.arrays[0]) if self.arrays else 0
        if done < len(self.rows):
            cols = list(zip(*self.rows[done:]))
            new = [np.array(cols[0], np.uint64), np.array(cols[1], np.uint64), np.array(cols[2], np.int32), np.array(cols[3], np.int8), np.array(cols[4], bool), self.lang.of_words(self.word[done:])]
            self.arrays = [np.concatenate(x) for x in zip(self.arrays, new)] if done else new
        return np.array(flat, dtype=np.int64), np.array(ends, dtype=np.int64)

    raw = property(lambda self: self.arrays[0])
    masked = property(lambda self: self.arrays[1])
    flags = property(lambda self: self.arrays[2])
    kind = property(lambda self: self.arrays[3])
    name = property(lambda self: self.arrays[4])
    score = property(lambda self: self.arrays[5])


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]]).astype(np.int64)


def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over each text's rows."""
    total = np.concatenate([np.zeros((1, *x.shape[1:]), np.float64), np.cumsum(x, axis=0, dtype=np.float64)])
    return total[ends] - total[_starts(ends)]


def _add_word(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


#: Lengths of the runs of last words that are looked up: with names masked, in list lines, and as they are.
RUNS, ITEM_RUNS, RAW_RUNS = (5, 4, 3, 2), (3, 2, 1), (3, 2, 1)
#: How often a run must be met to count, and up to how many words an answer is looked up as a whole.
LEAST_MET, WHOLE = 5, 9
#: What the rate of an answer's ending says: it ends no sentence elsewhere, it does, or neither.
LOW, HIGH = 0.04, 0.12
#: Families of runs.
OF_TEXT, OF_ITEM, OF_RAW, OF_WHOLE = 1, 2, 3, 4


class Runs:
    """Runs of words in texts, as hashes: at every place, or at the end of each text."""

    def __init__(self, words: Words, codes: np.ndarray, ends: np.ndarray):
        self.words = words
        name = words.name[codes]
        starts = _starts(ends)
        again = np.zeros(len(codes), dtype=bool)
        again[1:] = name[1:] & name[:-1]
        again[starts[starts < len(codes)]] = False
        kept = np.concatenate([[0], np.cumsum(~again)])
        self.raw, self.raw_ends, self.raw_kind = words.raw[codes], ends, words.kind[codes]
        self.codes = codes[~again]  # neighbouring names are one
        self.ends = kept[ends]
        self.kind = words.kind[self.codes]
        self.h = words.masked[self.codes]

    @staticmethod
    def _hashes(h: np.ndarray, k: int, family: int) -> np.ndarray:
        """The hash of the run of ``k`` words that ends at each place; nonsense at places before the k-th."""
        out = np.full(len(h), family * 1000 + k, dtype=np.uint64)
        for i in range(k - 1, -1, -1):
            out = _add_word(out, np.roll(h, i))
        return out

    @staticmethod
    def _depth(n: int, ends: np.ndarray) -> np.ndarray:
        """The number of places of the same text up to each place."""
        at = np.arange(n)
        return at - np.repeat(_starts(ends), np.diff(np.concatenate([[0], ends]))) + 1

    def _items(self, kind: np.ndarray) -> np.ndarray:
        """Whether each place is in a line that begins with a dash."""
        n = len(kind)
        opens = np.zeros(n, dtype=bool)
        opens[1:] = (kind[:-1] == NEWLINE) | (kind[:-1] == START)
        line = np.cumsum(opens)
        dash = np.zeros(int(line[-1]) + 1 if n else 1, dtype=bool)
        dash[line[opens & (kind == DASH)]] = True
        return dash[line] if n else np.zeros(0, dtype=bool)

    def all(self):
        """(hashes, whether a sentence, list line or answer ends there), family by family."""
        for h, kind, ends, families in ((self.h, self.kind, self.ends, ((OF_TEXT, RUNS, False), (OF_ITEM, ITEM_RUNS, True))), (self.raw, self.raw_kind, self.raw_ends, ((OF_RAW, RAW_RUNS, None),))):
            n = len(h)
            if not n:
                continue
            item = self._items(kind)
            depth = self._depth(n, ends)
            follows = np.zeros(n, dtype=np.int8)
            follows[:-1] = kind[1:]
            inner = np.ones(n, dtype=bool)
            inner[ends[ends > 0] - 1] = False  # the last word of an answer is not counted: what follows it is not known
            inner &= kind == PLAIN
            done = np.where(item, follows == NEWLINE, follows == STOP)
            for family, lengths, wanted in families:
                here = inner if wanted is None else inner & (item == wanted)
                for k in lengths:
                    at = np.flatnonzero(here & (depth >= k))
                    yield self._hashes(h, k, family)[at], done[at]
        for _, h, last in self._prefixes():
            yield h, last

    def _prefixes(self):
        """Hashes of the first 2 to ``WHOLE`` places of each text, and whether that is the whole text."""
        starts = _starts(self.ends)
        size = self.ends - starts
        own = np.flatnonzero(size >= 1)
        h = np.full(len(self.ends), OF_WHOLE, dtype=np.uint64)
        for k in range(1, WHOLE + 1):
            own = own[size[own] >= k]
            h[own] = _add_word(h[own], self.h[starts[own] + k - 1])
            if k > 1:
                yield own, h[own], size[own] == k

    def last(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, rank, hash) of the runs at the end of texts that end in a word: ranks 1 to 9 for masked ones from the longest
        on, 11 to 19 for raw ones, 0 for the whole text."""
        out = []
        for h, kind, ends, raw in ((self.h, self.kind, self.ends, False), (self.raw, self.raw_kind, self.raw_ends, True)):
            if not len(h):
                continue
            item, size, at = self._items(kind), np.diff(np.concatenate([[0], ends])), ends - 1
            for family, lengths, wanted in ((OF_RAW, RAW_RUNS, None),) if raw else ((OF_TEXT, RUNS, False), (OF_ITEM, ITEM_RUNS, True)):
                for rank, k in enumerate(lengths, 11 if raw else 1):
                    own = np.flatnonzero((size >= k) & (kind[at] == PLAIN) & (True if wanted is None else item[at] == wanted))
                    run = np.full(len(own), family * 1000 + k, dtype=np.uint64)
                    for i in range(k - 1, -1, -1):
                        run = _add_word(run, h[at[own] - i])
                    out.append((own, np.full(len(own), rank), run))
        for own, h, last in self._prefixes():
            out.append((own[last], np.zeros(int(last.sum()), np.int64), h[last]))
        own, rank, run = (np.concatenate(x) if out else np.empty(0, np.int64) for x in (list(zip(*out)) or [[], [], []]))
        return own, rank, run.astype(np.uint64).view(np.int64)


def _unstopped(text: str) -> bool:
    s = _without_note(text)
    return bool(re.search(r"[^\W_]", s)) and not s.rstrip(CLOSERS).endswith(STOPS)


def _encode(votes: list[int]) -> int:
    n = 0
    for v in reversed(votes):
        n = 3 * n + v + 1
    return n


def _decode(code: int, n: int) -> list[int]:
    return [code // 3**j % 3 - 1 for j in range(n)]


#: Where the model starts: for each function on a defect, the share of votes for it on sound and on defective pairs. A strong
#: sign, one that few defective pairs show, and a weak one that most of them show and many sound ones too.
STRONG, RARE, WEAK, USUAL = (0.02, 0.90), (0.01, 0.35), (0.30, 0.85), (0.95, 0.99)
#: The functions in the order of their votes; the last two on ``truncated`` vote by the rates of endings.
STARTS = {"empty": (STRONG,) * 3, "copy": (STRONG,) * 5, "refusal": (STRONG, STRONG, WEAK, WEAK, WEAK), "truncated": (RARE, RARE, (0.10, 0.95), USUAL, (0.03, 0.85), RARE), "wrong_language": (STRONG,) * 3}
FUNCTIONS = {d: len(x) for d, x in STARTS.items()}


class Voter:
    """The labelling functions, on many pairs at once."""

    def __init__(self, words: Words):
        self.words, self.lang = words, words.lang

    def votes(self, questions: list[str | None], answers: list[str | None], answer_codes=None) -> list[dict[str, list[int]]]:
        """The votes on each pair; on ``truncated`` those that need no counts over all answers."""
        w = self.words
        qs = [_without_lead(q or "") for q in questions]
        raws = [a or "" for a in answers]
        bare = [(UNSEEN.sub(" ", a) if not a.isascii() else a).strip() for a in raws]
        contents = [_without_lead(b).strip() for b in bare]
        qc, qe = w.codes(qs)
        ac, ae = w.codes(raws) if answer_codes is None else answer_codes
        told_q, told_a = self._languages(qc, qe, qs), self._languages(ac, ae, contents)
        fa = w.flags[ac]
        has = {f: (_sums((fa & f > 0).astype(np.int32), ae) > 0).tolist() for f in (PERSON, NEGATION_WORD, PHRASE, DIGIT, QUOTE, BRACKET)}
        n_words = _sums((fa & LETTER > 0).astype(np.int32), ae).astype(np.int64).tolist()
        q_words = _sums((w.flags[qc] & LETTER > 0).astype(np.int32), qe).astype(np.int64).tolist()
        starts, q_starts, q_ends, a_ends = _starts(ae).tolist(), _starts(qe).tolist(), qe.tolist(), ae.tolist()
        word, long = w.word, w.long
        q_codes = qc.tolist()
        out = []
        for i, (q, a, b, s) in enumerate(zip(qs, raws, bare, contents)):
            v = {"empty": self._empty(b, s, n_words[i])}
            near = len(s) <= 2 * len(q) + 60 or s.endswith("?")  # else no copy: far longer, and asks nothing
            ql, al = (_only_letters(q), _only_letters(s)) if near else ("", "")
            v["copy"] = self._copy(q, s, ql, al, n_words[i] - q_words[i]) if near and ql and al else [-1] * 5
            own = ac[starts[i] : a_ends[i]]
            names = [word[c] for c in q_codes[q_starts[i] : q_ends[i]] if long[c]]
            v["refusal"] = self._refusal(names, s, own, i, has, n_words[i])
            v["truncated"] = self._truncated(a, word[own[-1]] if len(own) else "", has[BRACKET][i], v["copy"][3] > 0 or s.endswith("?")) if n_words[i] > 1 and max(v["empty"][:2]) < 1 else [0] * 4
            v["wrong_language"] = self._wrong_language(questions[i] or "", s, told_q[i], told_a[i])
            out.append(v)
        return out

    def _empty(self, bare: str, content: str, n_words: int) -> list[int]:
        letters = re.search(r"[^\W_]", content) is not None
        held = any(x.lower().strip(" .!-\"'()") in PLACEHOLDERS for x in (bare, content)) if len(bare) < 24 else False
        return [1 if not letters else -1 if n_words > 2 else 0, 1 if held else -1 if letters else 0, 1 if len(content) <= 5 else -1 if len(content) >= 12 else 0]

    def _copy(self, q: str, s: str, ql: str, al: str, extra: int) -> list[int]:
        """Equal letters; shared words; asks; ends with the question or repeats it; the question's words in order."""
        qw, aw = re.findall(r"\w+", q.lower()), re.findall(r"\w+", s.lower())
        shared = sum(x in qw for x in aw) / max(1, len(aw))
        asks = s.rstrip(CLOSERS + ".").endswith("?")
        times = al.count(ql)
        tail = al.endswith(ql) and len(al) - len(ql) <= 40 or times > 1 and len(al) - times * len(ql) <= 20
        run = _common_run(qw, aw) if len(aw) - len(qw) <= 6 or asks else 0.0
        return [1 if al == ql else -1, 1 if shared >= 0.85 else -1 if shared <= 0.6 else 0, 1 if asks else -1 if extra > 6 else 0, 1 if tail else -1, 1 if run > 0.8 else -1 if run < 0.6 else 0]

    def _refusal(self, names: list[str], s: str, own: np.ndarray, i: int, has: dict, n_words: int) -> list[int]:
        """A stock phrase; first person and negation; no figures or quotations; none of the question's names; brevity."""
        bare = not (has[DIGIT][i] or has[QUOTE][i])
        person, negation, phrase = has[PERSON][i], has[NEGATION_WORD][i], False
        if has[PHRASE][i] or BARE:
            w = self.words
            likely = set(BARE).union(*(w.phrases[c] for c in own[w.flags[own] & PHRASE > 0].tolist()))
            if likely:
                unquoted = QUOTED.sub(" ", s) if has[QUOTE][i] else s
                subject = {_plain(x) for x in names}
                p = " ".join(x for x in _plain(unquoted).split(" ") if x.strip(",.:;?!") not in subject or x[-1:] in ".?!")
                phrase = any(REFUSAL[x].search(p) for x in likely)
                if has[QUOTE][i]:
                    person, negation = bool(FIRST_PERSON.search(p) or FIRST_VERB.search(p)), bool(NEGATION.search(p))
        low = s.lower()
        if person and "i.e" in low:  # no person
            person = bool(FIRST_PERSON.search(low.replace("i.e", "")) or FIRST_VERB.search(low))
        shares = any(x in s for x in names[1:] or names) or any(x.lower() in low for x in names if len(x) > 6)
        return [1 if phrase else -1, 1 if person and negation else 0 if person or negation else -1, 1 if bare else -1, -1 if shares else 1, 1 if 3 <= n_words <= 22 else -1]

    def _truncated(self, a: str, last: str, bracket: bool, asks: bool) -> list[int]:
        """An open bracket or quotation; an ending that calls for more; no final stop; not the end of a question."""
        s = _without_note(a)
        opened = bracket and _opened(s)
        stopped = s.rstrip(CLOSERS).endswith(STOPS)
        end = s[-24:]
        item = s[s.rfind("\n") + 1 :].strip() if s[-1:] in ".)-•*" else ""
        item = bool(item) and re.fullmatch(r"(?:[-•*]|\d+[.)])", item) is not None
        mark = item or s[-1:] in (",", ";", "-", "–", "(", "/", "„", "«", ":") or last.lower() in OPEN_WORDS
        short = s.endswith(".") and bool(OPEN_ABBREVIATION.search(end)) and not re.search(r"(?i)\b(?:etc|usw|u\.\s?s\.\s?w)\.\Z", end)
        return [1 if opened else -1, 1 if mark or short else -1, -1 if stopped and not short and not item else 1, -1 if asks else 1]

    def _languages(self, codes: np.ndarray, ends: np.ndarray, texts: list[str]) -> list[tuple]:
        """Per text, language and lead by function words and by trigrams of words in lower case, or of all words in a text without
        any."""
        w, n = self.words, len(self.lang.langs)
        score = w.score[codes]
        low = w.flags[codes] & LOWER > 0
        grams = _sums(np.where(low[:, None], score[:, :n], 0), ends)
        none = _sums(low.astype(np.int32), ends) < 2
        if none.any():
            grams[none] = _sums(score[:, :n], ends)[none]
        tops = []
        for s in (_sums(score[:, n:], ends), grams):
            order = np.argsort(-s, axis=1, kind="stable")
            rows = np.arange(len(s))
            tops.append((order[:, 0].tolist(), (s[rows, order[:, 0]] - s[rows, order[:, 1]]).tolist()))
        (lw, mw), (lg, mg) = tops
        names = self.lang.langs
        return [(names[a], b, names[c], d if not x else d / 4) for a, b, c, d, x in zip(lw, mw, lg, mg, none.tolist())]

    def _wrong_language(self, question: str, s: str, told_q: tuple, told_a: tuple) -> list[int]:
        """Function words, trigrams, and letters, each against the language that is expected."""
        (lq, mq, tq, nq), (la, ma, ta, na) = told_q, told_a
        asked = [k for k, x in ASKED.items() if x.search(question)] if ANY_ASKED.search(question) else []
        if asked and (la in asked or ta in asked):  # in the language that was asked for
            return [-1, -1, -1]
        by_words = 0 if mq < 1 or ma < 1 else -1 if lq == la else 1 if mq + ma >= 3 else 0
        by_grams = 0 if nq < 2 or na < 3 else -1 if tq == ta else 1 if nq >= 4 and na > 8 else 0
        clue = {k for k, x in CLUES.items() if any(c in s for c in x)} if not s.isascii() else set()
        by_letters = 0 if len(clue) != 1 or (lq != tq and mq >= 1) else -1 if lq in clue else 1
        return [by_words, by_grams, by_letters]


ANY_ASKED = re.compile("|".join(x.pattern for x in ASKED.values()), re.I)


def votes_of(lang: Languages, question: str | None, answer: str | None) -> dict[str, list[int]]:
    """The votes on one pair that need no counts over all answers."""
    return Voter(Words(frozenset(), lang)).votes([question], [answer])[0]


class LabelModel:
    """A mixture of defective and sound pairs in which functions vote independently, fitted by EM on vote patterns.

    ``p[k, j]`` is the share of votes for the defect among the votes that function ``j`` casts on sound (0) and on
    defective (1) pairs; an undecided function says nothing.
    """

    START = (0.03, 0.90)

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, prior: float = PRIOR, strength: float = STRENGTH, steps: int = 60, starts: tuple[tuple[float, float], ...] = ()):
        m = patterns.shape[1] if patterns.size else 0
        first = np.array(starts[:m] if starts else [self.START] * m, dtype=float).reshape(m, 2).T
        self.p = first.copy()
        self.prior = prior
        total = counts.sum()
        for _ in range(steps if total else 0):
            r = self.posterior(patterns)
            self.prior = float(np.clip(((r * counts).sum() + prior * strength) / (total + strength), 1e-4, 0.5))
            for k, w in enumerate(((1 - r) * counts, r * counts)):
                for j in range(m):
                    yes, no = w[patterns[:, j] == 1].sum(), w[patterns[:, j] == -1].sum()
                    self.p[k, j] = np.clip((yes + strength * first[k, j]) / (yes + no + strength), 1e-4, 1 - 1e-4)
            # a function stays on the side that it was written for
            self.p[1] = np.maximum(self.p[1], np.minimum(self.p[0] + 0.05, 0.999))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        if not len(patterns):
            return np.empty(0)
        yes, no = patterns == 1, patterns == -1
        both = [yes @ np.log(self.p[k]) + no @ np.log(1 - self.p[k]) + np.log((1 - self.prior, self.prior)[k]) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(both[0] - both[1], -50, 50)))


def common_words(df: DataFrame, text: str = "output", share: float = 1 / 2000, name_share: float = 1 / 400) -> frozenset[str]:
    """Words that surely occur more often than once in 2,000 answers, capitalised ones once in 400, as names recur within a
    document: a count above the share and three deviations of it, at any size. At most 2,000 times the words of an average
    answer. Others are masked in runs of words, which are also counted as they are."""

    def count(batches):
        for batch in batches:
            c: Counter = Counter()
            for t in batch.column(0).to_pylist():
                if t:
                    c.update(WORD.findall(t))
            c = {w: n for w, n in c.items() if w[0].isalpha()}
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["w", "n"])

    n = df.count()
    surely = [x * n + 3 * (x * n) ** 0.5 for x in (name_share, share)]
    least = F.when(F.col("w").rlike(r"^\p{Lu}"), surely[0]).otherwise(surely[1])
    rows = df.select(F.col(text).cast("string")).mapInArrow(count, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()
    return frozenset(r["w"] for r in rows)


def _ends(df: DataFrame, words, key: str, text: str) -> DataFrame:
    """``_k, rank, h, last_lower``: the runs at the end of answers without a final stop."""
    schema = df.select(F.col(key).alias("_k")).schema.add("rank", "integer").add("h", "long").add("item", "boolean").add("lower", "boolean")

    def runs(batches):
        w = words.value
        for batch in batches:
            rows = [(k, _without_note(t).rstrip(CLOSERS)) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t and _unstopped(t)]
            rows = [(k, t) for k, t in rows if t[-1:].isalnum() and not _opened(t)]  # other endings are no end of a sentence by their words
            at, rank, h = Runs(w, *w.codes([t for _, t in rows])).last()
            keys = pa.array([k for k, _ in rows], batch.column(0).type).take(pa.array(at))
            item = np.array([t[t.rfind("\n") + 1 :].lstrip().startswith("-") for _, t in rows], dtype=bool)
            lower = np.array([t.split()[-1][:1].islower() for _, t in rows], dtype=bool)
            yield pa.RecordBatch.from_arrays([keys, pa.array(rank.astype(np.int32)), pa.array(h), pa.array(item[at]), pa.array(lower[at])], names=schema.names)

    return df.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t")).filter(~F.col("_t").rlike(r"[.!?…]\s*\z")).mapInArrow(runs, schema)


#: Into so many parts the counts of a run are copied, so that an ending which a third of all answers share is no single task.
SALT = 16


def pair_votes(df: DataFrame, samples: DataFrame, key: str = "pair_id", question: str = "instruction", answer: str = "output") -> DataFrame:
    """``key, empty, copy, refusal, truncated, wrong_language``: the votes on each pair, as a number with a digit per function.

    The runs of words at the end of answers without a final stop are looked up: how often each is met in all answers, and
    how often it ends a sentence, a list line or (from the first word on) the answer there. One pass over the pairs votes
    and counts, and counts leave a task only for runs that a filter of fixed size takes for wanted.
    """
    from grainmill.llm.keys import key_filter
    from grainmill.runtime import materialize

    spark = df.sparkSession
    lang = Languages([(r[0], r[1]) for r in samples.filter("text is not null").select("lang", "text").collect()])  # a fixed table
    words = spark.sparkContext.broadcast(Words(common_words(df, answer), lang))
    own = materialize(_ends(df, words, key, answer))
    wanted = spark.sparkContext.broadcast(key_filter(own.select("h")))
    schema = df.select(F.col(key).alias("_k")).schema
    for d in DEFECTS:
        schema = schema.add(d, "integer")
    schema = schema.add("unstopped", "boolean").add("h", "long").add("met", "long").add("ended", "long")

    def read(batches):
        w, keep = words.value, wanted.value
        voter = Voter(w)
        for big in batches:
            for a in range(0, big.num_rows, 5000):
                batch = big.slice(a, 5000)
                qs, ts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                codes, ends = w.codes([t or "" for t in ts])
                got = voter.votes(qs, ts, (codes, ends))
                votes = [pa.array([_encode(g[d]) for g in got], pa.int32()) for d in DEFECTS]
                n = len(got)
                yield pa.RecordBatch.from_arrays([batch.column(0), *votes, pa.array([bool(t) and _unstopped(t) for t in ts], pa.bool_()), *[pa.nulls(n, pa.int64())] * 3], names=schema.names)
                met, ended = [np.empty(0, np.uint64)], [np.empty(0, bool)]
                for h, done in Runs(w, codes, ends).all():
                    near = keep(h)
                    met.append(h[near])
                    ended.append(done[near])
                h, at = np.unique(np.concatenate(met), return_inverse=True)
                m, e = np.bincount(at, minlength=len(h)), np.bincount(at, weights=np.concatenate(ended), minlength=len(h))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(h), batch.column(0).type), *[pa.nulls(len(h), pa.int32())] * len(DEFECTS), pa.nulls(len(h), pa.bool_()), pa.array(h.view(np.int64)), pa.array(m.astype(np.int64)), pa.array(e.astype(np.int64))], names=schema.names)

    rows = materialize(df.select(F.col(key).alias("_k"), F.col(question).cast("string"), F.col(answer).cast("string")).mapInArrow(read, schema))
    stats = rows.filter("h is not null").groupBy("h").agg(F.sum("met").alias("met"), F.sum("ended").alias("ended"))
    stats = stats.select("h", "met", "ended", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    met = own.withColumn("salt", F.pmod(F.xxhash64(F.col("_k").cast("string")), F.lit(SALT)).cast("int")).join(stats, ["h", "salt"], "left")
    met = met.select("_k", "rank", "item", "lower", F.coalesce("met", F.lit(0)).alias("met"), F.coalesce("ended", F.lit(0)).alias("ended"))
    rate, often, rank = F.col("ended") / F.greatest("met", F.lit(1)), F.col("met") >= LEAST_MET, F.col("rank")
    met = met.groupBy("_k").agg(
        F.max(F.when((rank == 0) & (F.col("ended") >= 3), rate)).alias("whole"), F.min_by(rate, F.when(rank.between(1, 9) & often, rank)).alias("masked"), F.min_by(rate, F.when((rank > 10) & often, rank)).alias("raw"),
        F.max(F.when(rank == 10 + len(RAW_RUNS), F.col("met"))).alias("last"), F.bool_or("item").alias("item"), F.bool_or("lower").alias("lower"),
    )
    r = F.when(F.col("whole") > 0.3, 1.0).otherwise(F.coalesce("masked", F.when(F.col("item"), (LOW + HIGH) / 2).otherwise(0.0)))
    whole = F.coalesce(F.col("whole") > 0.3, F.lit(False))
    cut = (F.col("last") == 0) & F.col("lower") & ~whole  # a word that no answer holds elsewhere: its masked runs say nothing
    told = F.when(cut, 0).when(r < LOW, 1).when(r > HIGH, -1).otherwise(0)
    word = F.when(cut, 1).when(whole | (F.col("raw") > 0.5), -1).otherwise(0)
    met = met.select(F.col("_k").alias("_k2"), told.alias("told"), word.alias("word"))
    judged = F.col("truncated") != _encode([0] * (FUNCTIONS["truncated"] - 2))  # too little text says nothing about its end
    votes = rows.filter("h is null").select("_k", *DEFECTS, "unstopped")
    joined = votes.filter("unstopped").join(met, F.col("_k") == F.col("_k2"), "left").drop("_k2")
    rest = votes.filter("not unstopped").withColumns({"told": F.lit(0), "word": F.lit(0)})
    n = FUNCTIONS["truncated"]
    told, word = (F.when(judged, F.coalesce(c, F.lit(0))).otherwise(0) for c in ("told", "word"))
    more = F.col("truncated") + (told + 1) * 3 ** (n - 2) + (word + 1) * 3 ** (n - 1)
    return joined.unionByName(rest).select(F.col("_k").alias(key), *(more.alias(d) if d == "truncated" else F.col(d) for d in DEFECTS))


def defects(df: DataFrame, samples: DataFrame, key: str = "pair_id", cutoffs: dict[str, float] = CUTOFFS, **columns: str) -> DataFrame:
    """``key, defect, posterior``: every label of a pair whose posterior reaches its cutoff; a pair may have several.

    The driver gets one count per distinct pattern of votes (729 per defect at most), fits the label models, and sends the
    posteriors back as a small table. A null question has no words; a null answer is ``empty``. Repeated pairs are
    labelled each; pairs with a null key keep it.
    """
    from grainmill.runtime import materialize

    spark = df.sparkSession
    votes = materialize(pair_votes(df, samples, key, **columns))
    long = votes.select(key, F.explode(F.array(*(F.struct(F.lit(i).alias("d"), F.col(d).alias("votes")) for i, d in enumerate(DEFECTS)))).alias("x")).select(key, "x.d", "x.votes")
    counted = long.groupBy("d", "votes").count().collect()
    rows = []
    for i, d in enumerate(DEFECTS):
        own = sorted((r["votes"], r["count"]) for r in counted if r["d"] == i)
        if own:
            patterns = np.array([_decode(v, FUNCTIONS[d]) for v, _ in own])
            post = LabelModel(patterns, np.array([n for _, n in own], dtype=float), starts=STARTS[d]).posterior(patterns)
            rows += [(i, v, d, float(p)) for (v, _), p in zip(own, post) if p >= cutoffs[d]]
    table = spark.createDataFrame(rows, "d int, votes int, defect string, posterior double")
    return long.join(F.broadcast(table), ["d", "votes"]).select(key, "defect", "posterior")  # 729 rows per defect at most


def one_defect(labels: DataFrame, key: str = "pair_id") -> DataFrame:
    """``key, defect``: the first of ``DEFECTS`` among a pair's labels."""
    rank = F.coalesce(*(F.when(F.col("defect") == d, i) for i, d in enumerate(DEFECTS)))
    return labels.groupBy(key).agg(F.min_by("defect", rank).alias("defect"))
