"""Text of scanned pages: furniture, divided words, misread words, and readable paragraphs (problem 3)."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.keys import key_filter
from grainmill.runtime import join_checked, join_salted, materialize

#: A form counts as established if it occurs in so many files, at any number of files.
LEAST_FILES = 3
#: Forms of this share of the files are broadcast: at most the words of an average file divided by it. What a file can look up of
#: the rarer ones is joined to it, so that the result is the same for any share.
BROADCAST_SHARE = 0.002
#: A short line at the top of a page is a running title if its pattern, figures and names masked, is met there in so many
#: files, at so many tops for each time that it is met elsewhere, and if it is what most tops with its first two words are:
#: sentences go on in many ways.
LEAST_TITLES, TOPS, MOST = 5, 3, 0.5
#: How many times as frequent as a form its established twin must be before the form counts as misread.
RATIO = 8

#: Characters that scans confuse, spelled in the strokes they share.
STROKES = {"1": "i", "l": "i", "|": "i", "!": "i", "0": "o", "@": "a", "$": "s", "5": "s", "9": "g", "6": "b", "8": "b", "ß": "b", "2": "z", "e": "c", "t": "f", "7": "f", "m": "rri", "n": "ri", "h": "ii", "u": "ii", "ü": "ii", "ö": "o", "d": "ci", "w": "vv", "ı": "i"}
_FOLD = str.maketrans(STROKES)
MARKS = re.compile(r"[\^~·'|`´¨°*]")
TOKEN = re.compile(r"\S+")
TRIM = ".,;:()[]{}„“”\"«»‹›?…–—‚‘’"
DASHES = "-\u00ad\u2010\u00ac="
#: Words after a hyphen that stands for a left-out part.
JOINING = {"und", "oder", "bzw.", "bis", "and", "or", "to", "y", "o", "e", "et", "ou", "en", "of", "tot"}

NUMBER = r"[\divxlcIVXLCDM1lO]+"
#: A page number before or behind a title.
EDGE_NUMBER = rf"\A{NUMBER}\s*[|–-]?\s+|\s+[|–-]?\s*{NUMBER}\Z"
PAGE_NUMBER = re.compile(
    rf"(?:[\[(<–—\-|.~]{{0,2}}\s*(?:(?:Seite|Sei[ft]e|[S5$]|[Pp]|[Pp][áa]g|[Pp]agin[ae]|[Pp]ágina|[Pp]age|[Bb]l?z|[Bb][l1I]z|[B8]latt|[Ff]olio)\b\.?\s*)?)"
    rf"({NUMBER})(?:\s*(?:/|von|v[o0]n|of|[o0]f|sur|de|d[ec]|van|v[a@]n)\s*({NUMBER}))?\s*[\])>–—\-|.~]{{0,2}}",
)
#: A line that a page number can be: ends with a figure or a Roman numeral, marks aside.
NUMBERED = re.compile(r"(?<!\w)[\divxlcIVXLCDM1lO]+\W*\Z")
SECTION = re.compile(r"\d{1,2}(?:\.\d+)*\.?\s+\S+(?:\s[a-zà-ÿ]\S*)?\Z")
LABELLED = re.compile(rf"(\S+?)\.?\s+({NUMBER})(?:\s+\S+\s+({NUMBER}))?")
PAGE_WORDS = ("seite", "page", "página", "pagina", "pág", "blz", "blatt", "folio", "pag")
ROMAN_FIRST = re.compile(r"[ivxlcdm]+\s")
FIGURES = re.compile(r"[\dlIO]+")
TABLE = re.compile(r"\S.*\s\d+\s+\d+\s*\Z")
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def skeleton(word: str) -> str:
    s = MARKS.sub("", word.lower()).translate(_FOLD)
    return s.replace("riri", "rrri")


def words_of(line: str) -> list[str]:
    out = []
    for t in TOKEN.findall(line):
        t = t.strip(TRIM)
        if t:
            out += [p for p in t.split("-") if p] if "-" in t.strip("-") else [t]
    return out


def _value(s: str) -> int | None:
    """The number meant by arabic or Roman figures."""
    if re.fullmatch(r"\d+", s):
        return int(s)
    a = s.replace("l", "1").replace("I", "1").replace("O", "0")
    if re.fullmatch(r"\d+", a) and any(c.isdigit() for c in s):
        return int(a)
    r = s.lower().replace("1", "i")
    if not re.fullmatch(r"[ivxlcdm]+", r):
        return None
    total, last = 0, 0
    for ch in reversed(r):
        v = ROMAN[ch]
        total += v if v >= last else -v
        last = max(last, v)
    return total


class _Tokens(dict):
    """The words of a token between blanks; remembered."""

    def __missing__(self, t: str) -> tuple[str, ...]:
        if len(self) > 300_000:
            self.clear()
        self[t] = out = tuple(words_of(t))
        return out


class _Over(dict):
    """Entries before those of another dictionary, which is not copied."""

    def __init__(self, own: dict, base: dict):
        super().__init__(own)
        self.base = base

    def __missing__(self, k):
        return self.base[k]

    def __contains__(self, k) -> bool:
        return dict.__contains__(self, k) or k in self.base

    def get(self, k, default=None):
        return self[k] if dict.__contains__(self, k) else self.base.get(k, default)


class Reader:
    """Classifies the lines of a file, under the established word forms of all files."""

    def __init__(self, forms: dict[str, int], pairs: dict[str, int]):
        self.forms, self.pairs = forms, pairs
        self._group()

    def _group(self) -> None:
        self.groups: dict[str, list[str]] = {}
        for w in self.forms:
            if len(w) > 1 and not any(c.isdigit() for c in w):
                self.groups.setdefault(skeleton(w), []).append(w)
        #: strokes of several words that differ in more than case: which one is meant depends on the word before
        self.several = {k for k, ws in self.groups.items() if len({w.lower() for w in ws}) > 1}
        self.known = {x for w in self.forms for x in (w.lower(), w.lower().replace("ß", "ss"))}
        self.page_words = {skeleton(w) for w in PAGE_WORDS}
        self.begun = {x[:i] for w in self.forms for x in (w, w[:1].upper() + w[1:]) for i in range(1, len(w))}
        self.sound: dict[str, tuple[bool, frozenset[str]]] = {}
        self.strokes: dict[str, str] = {}
        self.parts = _Tokens()
        self.touched: dict[str, str] = {}
        self.more_known: set[str] = set()
        self.more_begun: set[str] = set()
        self.base = self

    def _sound(self, token: str) -> tuple[bool, frozenset[str], str, tuple[tuple[str, str], ...]]:
        """Whether a token between blanks is surely read right, whatever word is before it; the strokes by which further forms would
        change that; the token, if it may be the first part of a word with a gap in it; and the strokes with the words they are of."""
        core = token.strip(TRIM)
        parts = core.split("-") if "-" in core.strip("-") else (core,)
        strokes = [self.stroke(part) for part in parts]
        sound = not any(k in self.several and not self._settled(part, k) or self._misread(part, "") for part, k in zip(parts, strokes))
        of = [*zip(strokes, (part.lower() for part in parts)), *((k, "") for part in parts for k in self.keys(part)[1:])]
        return sound, frozenset(k for k, _ in of), core if core == token and core.isalpha() else "", tuple(of)

    def _settled(self, word: str, stroke: str) -> bool:
        """Whether no other word of these strokes is so much more frequent that this one could be its misreading."""
        own = self.forms.get(word, 0)
        return own > 0 and all(self.forms[x] < RATIO * own for x in self.groups[stroke] if x.lower() != word.lower())

    def _token(self, t: str) -> tuple[bool, str]:
        """Whether a token is surely read right under all forms, and the first part of a word that it may be."""
        known = self.sound.get(t)
        if known is None:
            if len(self.sound) > 300_000:
                self.sound.clear()
            known = self.sound[t] = self.base._sound(t)
        touched = self.touched
        if known[0] and touched and not known[1].isdisjoint(touched):
            return all(touched.get(k, low) == low for k, low in known[3]), known[2]
        return known[0], known[2]

    def _all_sound(self, line: str) -> bool:
        begun, more = self.begun, self.more_begun
        tokens = line.split()
        for i, t in enumerate(tokens, 1):
            sound, first = self._token(t)
            if not sound:
                return False
            if first and i < len(tokens) and (first in begun or first in more):
                whole = first + tokens[i].strip(TRIM)
                if whole in self.forms or whole[:1].lower() + whole[1:] in self.forms:
                    return False
        return True

    def with_forms(self, more: list[tuple[str, int]]) -> Reader:
        """A reader that knows further forms, and further pairs of words."""
        out = Reader.__new__(Reader)
        out.__dict__.update(self.__dict__)
        new = {w: n for w, n in more if " " not in w}
        out.forms, out.groups = _Over(new, self.forms), _Over({}, self.groups)
        out.pairs = _Over({w: n for w, n in more if " " in w or "-" in w}, self.pairs)
        out.more_known = {x for w in new for x in (w.lower(), w.lower().replace("ß", "ss"))}
        for w in new:
            if len(w) > 1 and not any(c.isdigit() for c in w):
                k = self.stroke(w)
                out.groups[k] = [*out.groups.get(k, ()), w]
        #: strokes of further forms, with the word if there is but one: that one itself stays as it is
        out.touched = {k: next(iter(ws)) if len(ws := {x.lower() for x in out.groups.get(k, ())}) == 1 else "" for k in map(self.stroke, new)}
        out.touched.update({self.stroke(w.lower().replace("ß", "ss")): "" for w in new if "ß" in w})
        out.more_begun = {x[:i] for w in new for x in (w, w[:1].upper() + w[1:]) for i in range(1, len(w))}
        return out

    def __getstate__(self):
        return {"forms": self.forms, "pairs": self.pairs}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._group()

    def repaired(self, word: str, before: str = "") -> str | None:
        """The form that a misread word stands for, or None. Among several, the one seen most often after ``before``,
        then the most frequent."""
        own = self.forms.get(word, 0)
        group = self.groups.get(self.stroke(word), ())
        twins = [w for w in group if w != word and w.lower() != word.lower()]
        if not twins:
            lower = word[:1].lower() + word[1:]
            if any(w != word for w in group) and not word.isalpha() and own == 0:
                return max(group, key=lambda w: (self.forms[w], w))
            return None if lower == word or not any(not c.isalpha() for c in word) else self.repaired(lower, before)
        best = max(twins, key=lambda w: (self.pairs.get(f"{before} {w}", 0), self.forms[w], w))
        if self.forms[best] >= RATIO * max(own, 1) or (own == 0 and self.forms[best] >= LEAST_FILES):
            return best
        top = max(twins, key=lambda w: (self.forms[w], w))
        return top if self.forms[top] >= RATIO * max(own, 1) else None

    def established(self, word: str) -> bool:
        return word in self.forms or word.lower() in self.known or word.lower() in self.more_known

    def lines(self, text: str, title: str | None, stem: str | None, titles: frozenset[int] = frozenset()) -> list[tuple[int, set[str], str]]:
        """(line number, kinds, repaired line) of every line; ``titles``: lines whose pattern is that of running titles."""
        rows = text.split("\n")
        kinds: list[set[str]] = [set() for _ in rows]
        furniture = self._furniture(rows, title, stem, titles)
        for i, k in furniture.items():
            kinds[i].add(k)
        proper = [i for i, r in enumerate(rows) if r.strip() and i not in furniture]
        fixed = list(rows)
        divided_from: dict[int, str] = {}  # line: the first part of the word it goes on with
        for a, i in enumerate(proper):
            nxt = proper[a + 1] if a + 1 < len(proper) else None
            tail = self._tail(rows[i], rows[nxt]) if nxt is not None else None
            if tail:
                kinds[i].add("hyphen")
            fixed[i] = self._words(i, rows, kinds, divided_from, tail, rows[nxt] if tail else "", nxt, fixed)
        return [(i + 1, kinds[i], fixed[i]) for i in range(len(rows))]

    def _tail(self, line: str, after: str) -> str | None:
        """The first part of a word that is divided at the end of a line."""
        s = line.rstrip()
        mark = s[-1:]
        if mark not in DASHES or not mark:
            return None
        part = re.split(r"[\s\-\u00ad\u2010\u00ac=]", s[:-1])[-1]
        if not part or not part[-1].isalpha():
            return None
        nxt = after.split()
        if not nxt:
            return None
        first = part.lstrip(TRIM)
        rest = re.split(r"[\-\u00ad\u2010\u00ac=]", nxt[0])[0].strip(TRIM)
        if nxt[0].strip(TRIM).lower() in JOINING and mark in "-\u2010":
            return None
        if not rest or not (rest[0].isalpha() or not rest[0].isdigit()):
            return None
        whole = first + rest
        if self.established(whole):
            return first
        if mark in "-\u2010":
            if rest[:1].isupper() and not rest.isupper() and not self.repaired(whole):
                return None
            if self.forms.get(f"{first}-{rest}", 0) or self.established(f"{first}-{rest}"):
                return None
            if self.established(first) and self.established(rest) and len(rest) > 3 and len(first) > 3:
                pair = f"{first}-{rest}"
                if self.pairs.get(pair, 0):
                    return None
        return first

    def _words(self, i: int, rows: list[str], kinds: list[set[str]], divided_from: dict[int, str], tail: str | None, after: str, nxt: int | None, fixed: list[str]) -> str:
        line = fixed[i]
        if not tail and i not in divided_from and self._all_sound(line):
            return line
        tokens = TOKEN.findall(line)
        out, before = list(tokens), ""
        last = len(tokens) - 1
        k = 0
        while k <= last:
            raw = tokens[k]
            core = raw.strip(TRIM)
            if k == 0 and i in divided_from:
                before = ""
                k += 1
                continue  # judged with its first part
            if k == last and tail:
                self._divided(i, nxt, raw, after, kinds, divided_from)
                k += 1
                continue
            sound = self._token(raw)[0]
            for part in core.split("-") if "-" in core.strip("-") else [core]:
                new = None if sound else self._misread(part, before)
                if new:
                    kinds[i].add("ocr")
                    out[k] = out[k].replace(part, new, 1)
                before = new or part
            if k < last and not (k + 1 == last and tail) and core and core == raw and core.isalpha():
                b = tokens[k + 1].strip(TRIM)
                whole = core + b
                if b and b.isalpha() and RATIO * min(self.forms.get(core, 0), self.forms.get(b, 0)) < max(self.forms.get(whole, 0), self.forms.get(whole[:1].lower() + whole[1:], 0)):
                    kinds[i].add("ocr")
                    out[k], out[k + 1] = "", core + tokens[k + 1]
                    before = whole
                    k += 2
                    continue
            k += 1
        if "ocr" not in kinds[i]:
            return line
        return " ".join(t for t in out if t)

    def _divided(self, i: int, nxt: int, raw: str, after: str, kinds: list[set[str]], divided_from: dict[int, str]) -> None:
        first = raw.rstrip(DASHES).lstrip(TRIM)
        token = after.split()[0]
        rest = token.strip(TRIM)
        divided_from[nxt] = first
        head = first.split("-")[-1]
        if self.established(head + rest):
            return
        whole = head + rest
        new = self._misread(whole, "")
        if not new:
            return
        if new.endswith(rest) and not MARKS.search(rest):
            kinds[i].add("ocr")
        elif new.lower().startswith(head.lower()) and not MARKS.search(head):
            kinds[nxt].add("ocr")
        else:
            a, b = skeleton(head), skeleton(rest)
            kinds[i if _odd(head) >= _odd(rest) else nxt].add("ocr")
            if _odd(head) and _odd(rest) and a and b:
                kinds[i].add("ocr")
                kinds[nxt].add("ocr")

    def _misread(self, word: str, before: str) -> str | None:
        if len(word) < 2 or not any(c.isalpha() for c in word):
            return None
        if re.fullmatch(r"[\d.,:/%]+", word):
            return None
        if MARKS.search(word):
            bare = MARKS.sub("", word)
            if len(bare) > 1 and "'" not in word.replace(bare, "") and self.established(bare):
                return bare
            if "'" in word or "|" in word:
                return bare if self.established(bare) and not self.established(word) else self._by_skeleton(word, bare, before)
            return bare if self.established(bare) else self._by_skeleton(word, bare, before)
        if word in self.forms and self.forms[word] >= 1 and self.stroke(word) not in self.groups:
            return None
        return self._by_skeleton(word, word, before)

    def _by_skeleton(self, word: str, bare: str, before: str) -> str | None:
        if bare in self.forms or len(bare) < 3:
            own = self.forms.get(bare, 0)
            if own and len(bare) < 4:
                return None
        new = self.repaired(bare, before) or ("6" in bare and self.repaired(bare.replace("6", "o"), before)) or None
        if new and len(bare) < 3 and bare.isalpha():
            return None
        return new

    def _furniture(self, rows: list[str], title: str | None, stem: str | None, titles: frozenset[int]) -> dict[int, str]:
        """Lines at page edges that are page numbers or running titles."""
        n = len(rows)
        blank = [not r.strip() for r in rows]
        out: dict[int, str] = {}
        edge = {i for i in range(n) if not blank[i] and (i == 0 or i == n - 1 or blank[i - 1] or blank[i + 1])}
        # page numbers: one style per file, values that rise with the pages
        found: list[tuple[int, str, int]] = []
        for i in range(n):
            s = rows[i].strip()
            if blank[i] or not NUMBERED.search(s):
                continue
            m = PAGE_NUMBER.fullmatch(s)
            if not m and (x := LABELLED.fullmatch(s)) and skeleton(x.group(1)) in self.page_words:
                out[i] = "page_number"
                continue
            if not m:
                continue
            v = _value(m.group(1))
            if v is None:
                continue
            near = i in edge or (i >= 1 and (i - 1) in edge and i - 1 not in out) or (i + 1 < n and (i + 1) in edge)
            if near:
                found.append((i, re.sub(NUMBER, "#", s) if m.group(2) is None else "#/#", v))
        values = sorted((i, v) for i, _, v in found)
        for i, style, v in found:
            s = rows[i].strip()
            plain = re.fullmatch(rf"{NUMBER}\.?", s) is not None
            if not plain:
                out[i] = "page_number"
                continue
            others = [(j, w) for j, w in values if j != i and ((j > i) == (w > v)) and abs(w - v) <= 1 + abs(j - i) // 5 and w != v]
            alone = rows[i] != s or (i in edge and v < 1000 and not (s.endswith(".") and i and rows[i - 1].strip() and not rows[i - 1].rstrip().endswith((".", "!", "?"))))
            if i and rows[i - 1].strip() and v >= 1000 and not rows[i - 1].rstrip().endswith((".", "!", "?")):
                others = [1 for j, w in values if j != i and w != v and abs(w - v) <= 2]  # else a year that ends a sentence
            if others or alone:
                out[i] = "page_number"
        # running titles: the first line of a page
        own = [x for x in (title, stem) if x and len(_letters(x)) >= 8]
        own = [_bare(x) for x in own]
        width = max((len(r.strip()) for r in rows), default=0)
        tops: dict[int, str] = {}
        for i in range(n):
            if blank[i] or i in out or not (i == 0 or blank[i - 1] or i - 1 in out):
                continue
            j = i - 1
            while j >= 0 and j in out and not blank[j]:
                j -= 1
            if not (j < 0 or blank[j]):
                continue
            s = rows[i].strip()
            if s.startswith(("- ", "• ", "* ")) or SECTION.fullmatch(s) or TABLE.fullmatch(s) and i not in titles:
                continue
            tops[i] = _mask(s)
        seen = Counter(skeleton(m) for m in tops.values())
        for i, m in tops.items():
            s = rows[i].strip()
            if len(s) < 4 or s.endswith((";", ",", *DASHES)):
                continue
            titled = any(o in _bare(s) and len(_bare(s)) <= len(o) + 45 for o in own)
            nxt = next((rows[j].split()[0] for j in range(i + 1, n) if not blank[j]), "")
            short = len(_unspaced(s)) + 1 + len(nxt) <= width - 2
            running = i in titles and (short or i + 1 < n and blank[i + 1] or s != re.sub(EDGE_NUMBER, "", s))
            stops = s.endswith(".") and not re.search(r"\d\.\Z", s)
            if running or _unspaced(s) != s or (titled and not stops) or (seen[skeleton(m)] > 1 and not stops and short and self._like_title(s)) or (not stops and short and self._single_title(s)):
                out[i] = "header"
        # a page number beside a title, found only now to stand at an edge
        for i, style, v in found:
            if i not in out and ((i - 1) in out or (i + 1) in out) and not re.fullmatch(rf"{NUMBER}\.?", rows[i].strip()):
                out[i] = "page_number"
        return out

    def stroke(self, word: str) -> str:
        """``skeleton``, remembered."""
        out = self.strokes.get(word)
        if out is None:
            if len(self.strokes) > 300_000:
                self.strokes.clear()
            out = self.strokes[word] = skeleton(word)
        return out

    def keys(self, word: str) -> tuple[str, ...]:
        """The strokes under which a word is looked up: its own, and those with a 6 read as an o."""
        return (self.stroke(word), self.stroke(word.replace("6", "o"))) if "6" in word else (self.stroke(word),)

    def patterns(self, line: str, also: frozenset[str] = frozenset(), unknown: set[str] | None = None) -> list[str]:
        """A line with figures, numbers of pages and capitalised words but the first masked; none if nothing was, or if it is no
        title by its marks. Words are given in strokes, so that misread titles agree. A line in capitals has two patterns, as
        its short words may be capitalised elsewhere or not; ``also`` holds rarer forms for it, and ``unknown`` receives the words
        that were looked up in vain."""
        t = line.strip()
        if t[:1].islower() and not ROMAN_FIRST.match(t) or len(t) < 4 or t.endswith((".", ";", ",", *DASHES)) or t.startswith(("- ", "• ", "* ")):
            return []
        t = re.sub(EDGE_NUMBER, "", _unspaced(t))
        if t[:1].islower():
            return []
        capitals = t.isupper()
        found = []

        def name(w: str) -> bool:
            if w in self.forms or w in also:
                return False
            if unknown is not None:
                unknown.add(w)
            return True

        for keep in (True, False) if capitals else (True,):
            out = []
            for w in t.split():
                core = w.strip(TRIM)
                if core.isdigit() or FIGURES.fullmatch(core):
                    out.append(w.replace(core, "#"))
                elif out and core and ((name(core.lower()) or len(out) > 1 and not keep) if capitals else core[0].isupper() or core[0].isdigit()):
                    out.append(w.replace(core, "N"))
                else:
                    out.append(self.stroke(w))
            while out and out[-1].strip(TRIM) == "#":
                out.pop()
            if len(out) > 1 and out[0].strip(TRIM) not in "#N" and any("#" in x or "N" in x for x in out):
                found.append(" ".join(out))
        return found

    def tops(self, rows: list[str]) -> set[int]:
        """Lines that may be at the top of a page: the first, those behind an empty line, and those behind such a short one."""
        out = set()
        for i, r in enumerate(rows):
            if r.strip() and (i == 0 or not rows[i - 1].strip() or (i - 1 in out and len(rows[i - 1].strip()) < 8)):
                out.add(i)
        return out

    def wanted(self, text: str) -> set[str]:
        """Strokes of every word, and of every two neighbouring words, that ``lines`` may look up and that the broadcast forms do
        not settle: words that are not among them, those that a gap or a line's end divides, and spaced-out ones. A form among them
        is read as it stands, and so needs no rarer one."""
        words: set[str] = set()
        pairs: set[tuple[str, str]] = set()
        parts, forms = self.parts, self.forms
        rows = text.split("\n")
        for i, line in enumerate(rows):
            tokens = line.split()
            before, first, joined, single = "", "", "", False  # the last word, the last token if it may be half a word, the last two as one
            for t in tokens:
                whole, core = "", t.strip(TRIM)
                single = single or len(t) == 1
                if first and core.isalpha():
                    whole = first + core
                    if first not in forms or core not in forms:
                        words.add(whole)
                for w in parts[t]:
                    if w not in forms and not w.isdigit():
                        words.add(w)
                        pairs.add((before, w))
                        pairs.add((joined, w))
                    before, joined = w, ""
                first, joined = core if core == t and core.isalpha() else "", whole
            if tokens and tokens[-1][-1] in DASHES:
                self._halves(rows, i, words)
            if (single or "    " in line) and (s := _unspaced(line.strip())) != line.strip():
                words.update(words_of(s))
        out = {k for w in words if w not in forms for k in self.keys(w)}
        out.update([f"{a} {b}" for x, y in pairs if x and len(y) > 1 for a in self.keys(x) for b in self.keys(y)])
        return out

    def _halves(self, rows: list[str], i: int, words: set[str]) -> None:
        """Adds what is looked up of a word that is divided at the end of a line, for each line that it may go on in: those up to
        the first one that cannot be furniture."""
        s = rows[i].rstrip()
        first = re.split(r"[\s\-\u00ad\u2010\u00ac=]", s[:-1])[-1].lstrip(TRIM)
        head = s.split()[-1].rstrip(DASHES).lstrip(TRIM).split("-")[-1]
        for j in range(i + 1, len(rows)):
            after = rows[j].split()
            if not after:
                continue
            rest = re.split(r"[\-\u00ad\u2010\u00ac=]", after[0])[0].strip(TRIM)
            words.update((first, rest, first + rest, f"{first}-{rest}", head + after[0].strip(TRIM)))
            if rows[j - 1].strip() and not NUMBERED.search(rows[j].strip()) and not NUMBERED.search(rows[j - 1].strip()):
                return

    def _named(self, s: str) -> bool:
        """Holds a capitalised word that is not an established form, as a proper name is."""
        return any(w[:1].isupper() and len(w) > 3 and not self.established(w) and not self._misread(w, "") for w in words_of(_unspaced(s)))

    def _single_title(self, s: str) -> bool:
        """A title that is met once: up to three words (a figure aside), of which the last alone is a name."""
        ws = [w for w in words_of(_unspaced(s)) if not re.fullmatch(NUMBER, w)]
        return 2 <= len(ws) <= 3 and self._like_title(s) and self._named(ws[-1]) and not any(self._named(w) for w in ws[:-1])

    def _like_title(self, s: str) -> bool:
        ws = words_of(_unspaced(s))
        real = [w for w in ws if not re.fullmatch(NUMBER, w)]
        return 1 <= len(real) <= 7 and real[0][:1].isupper() and (real[-1][:1].isupper() or any(c.isdigit() for c in s)) and ";" not in s and "." not in s.rstrip(".").replace("no.", "").replace("No.", "").replace("nr.", "").replace("Nr.", "")


def _odd(w: str) -> int:
    return sum(not c.isalpha() for c in w)


def _letters(s: str) -> str:
    return "".join(c for c in s.lower() if c.isalnum())


_UMLAUTS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "é": "e", "è": "e", "ê": "e", "á": "a", "à": "a", "â": "a", "í": "i", "î": "i", "ï": "i", "ó": "o", "ô": "o", "ú": "u", "ñ": "n", "ç": "c", "ë": "e", "û": "u", "ù": "u"})


def _bare(s: str) -> str:
    """Letters only, in strokes, without accents, so that misread titles agree with the file's title."""
    s = _unspaced(s).lower().translate(_UMLAUTS)
    return skeleton("".join(c for c in s if c.isalnum() or c in "@$|!"))


def _unspaced(s: str) -> str:
    """Spaced-out letters joined: single characters with single blanks, words with several."""
    ws = s.split(" ")
    if len(ws) > 5 and sum(len(w) <= 1 for w in ws) > 0.8 * len(ws):
        return " ".join(x.replace(" ", "") for x in re.split(r"\s{2,}", s))
    return s


def _mask(s: str) -> str:
    return re.sub(r"\d+", "#", re.sub(rf"\A\s*{NUMBER}\s+[|–-]?\s*|\s+[|–-]?\s*{NUMBER}\s*\Z", "", _unspaced(s))).lower()


def _forms_of(text: str, parts: _Tokens) -> set[str]:
    """A file's words, pairs of neighbouring words, and words with a hyphen."""
    own: set[str] = set()
    for line in text.split("\n"):
        ws = [w for t in line.split() for w in parts[t]]
        if line.rstrip()[-1:] in DASHES and ws:
            ws.pop()
        if "-" in line:
            own.update(f"{a}-{b}" for a, b in re.findall(r"(?<![^\W\d_])([^\W\d_]+)-([^\W\d_]+)", line))
        plain = [w if w.isalpha() else "" for w in ws]
        own.update(plain)
        own.update([f"{a} {b}" for a, b in zip(plain, plain[1:]) if a and b])
    own.discard("")
    return own


def form_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``w, n``: words and pairs of neighbouring words, with the number of files that hold them, if that is ``LEAST_FILES`` or
    more. A task counts forms per file and sends partial counts. Forms with figures or stray marks, and words divided at a
    line's end, are not counted."""

    def count(batches):
        total: Counter = Counter()
        parts = _Tokens()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total.update(_forms_of(t or "", parts))
            if len(total) > 300_000:
                yield _counts(total)
                total = Counter()
        yield _counts(total)

    return df.select(F.col(text).cast("string")).mapInArrow(count, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_FILES)


def _counts(c: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["w", "n"])


def settled_forms(counts: DataFrame) -> DataFrame:
    """``stroke, w, n``: the words of ``form_counts``, but for those that another word of the same strokes, ``RATIO`` times as
    frequent, makes misreadings."""

    def strokes(batches):
        for batch in batches:
            ws = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([skeleton(w) for w in ws], pa.string()), pa.array([w.lower() for w in ws], pa.string()), *batch.columns], names=["stroke", "low", "w", "n"])

    words = counts.filter(~F.col("w").contains(" ")).select("w", "n").mapInArrow(strokes, "stroke string, low string, w string, n bigint")
    alike = words.groupBy("stroke").agg(F.collect_list(F.struct("w", "n", "low")).alias("ws"))  # the forms of equal strokes, a handful

    def stronger(x: Column, y: Column) -> Column:
        return (y["low"] != x["low"]) & (y["n"] >= RATIO * x["n"]) & (F.length(x["w"]) > 1) & (F.length(y["w"]) > 1)

    return alike.select("stroke", F.explode(F.filter("ws", lambda x: ~F.exists("ws", lambda y: stronger(x, y)))).alias("x")).select("stroke", "x.w", "x.n")


def _keyed(rare: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """``stroke, w, n, hash``: rarer forms and pairs by the strokes under which they are looked up."""

    def strokes(batches):
        for batch in batches:
            rows = []
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append((" ".join(map(skeleton, w.split(" "))), w, n))
                if "ß" in w and " " not in w:  # known by its other spelling too
                    rows.append((skeleton(w.lower().replace("ß", "ss")), w, n))
            c = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.string()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int64()), pa.array(_hashes(c[0]))], names=["stroke", "w", "n", "hash"])

    pairs = counts.filter((F.col("n") < least) & F.col("w").contains(" ")).select("w", "n")
    return rare.unionByName(pairs).mapInArrow(strokes, "stroke string, w string, n bigint, hash bigint")


def _hashes(keys: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(k.encode()) for k in keys], dtype=np.int64)


def _hints(df: DataFrame, reader, counts: DataFrame, settled: DataFrame, least: int, text: str) -> DataFrame:
    """``_h, forms, titles``, a row per text by its 128-bit digest: rarer forms and pairs with the strokes of words in it, and lines
    whose pattern is that of running titles.

    Strokes and patterns are joined with counts over all files; no form, pair or title is cut off by a share of the files.
    """
    schema = "_h binary, stroke string, word string, line int, top boolean, words array<string>"
    rarer = least > LEAST_FILES
    rare = settled.filter(F.col("n") < least).select("w", "n")
    if rarer:
        keyed = materialize(_keyed(rare, counts, least))
        wanted = df.sparkSession.sparkContext.broadcast(key_filter(keyed.select("hash")))  # 2 MB

    def ask(batches):
        r = reader.value
        for batch in batches:
            rows = []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = t.split("\n")
                tops = r.tops(lines)
                for i, line in enumerate(lines):
                    if i in tops or len(line) < 60:
                        unknown: set[str] = set()
                        found = r.patterns(line, unknown=unknown)
                        if rarer and unknown:
                            rows.append((h, None, line, i, i in tops, list(unknown)))
                        else:
                            rows += [(h, p, None, i, i in tops, None) for p in found]
                if rarer and (keys := list(r.wanted(t))):
                    rows += [(h, keys[i], None, -1, False, None) for i in np.flatnonzero(wanted.value(_hashes(keys)))]
            c = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.binary()), pa.array(c[1], pa.string()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.bool_()), pa.array(c[5], pa.list_(pa.string()))], names=["_h", "stroke", "word", "line", "top", "words"])

    asked = materialize(df.select(_digest(text), F.col(text).cast("string")).filter(F.length(text) > 0).mapInArrow(ask, schema))
    lines = asked.filter("line >= 0 and words is null").select("_h", "stroke", "line", "top")
    if rarer:
        lines = lines.unionByName(_in_capitals(asked.filter("words is not null"), rare, reader))
    title = lines.groupBy("stroke").agg(F.count_distinct(F.when(F.col("top"), F.col("_h"))).alias("files"), F.count_if("top").alias("tops"), F.count_if(~F.col("top")).alias("others"))
    title = title.withColumn("begin", F.substring_index("stroke", " ", 2))
    alike = title.groupBy("begin").agg(F.sum("tops").alias("all_tops"))
    title = title.filter((F.col("files") >= LEAST_TITLES) & (F.col("tops") >= TOPS * F.col("others"))).join(alike, "begin").filter(F.col("tops") >= MOST * F.col("all_tops")).select("stroke")
    titles = join_salted(lines.filter("top"), title, "stroke", "_h").groupBy("_h").agg(F.array_sort(F.collect_set("line")).alias("titles"))
    if not rarer:
        return titles.withColumn("forms", F.lit(None).cast("array<struct<w:string,n:bigint>>"))

    alike = keyed.groupBy("stroke").agg(F.collect_list(F.struct("w", "n")).alias("ws"))  # the forms of equal strokes, a handful
    asked = join_salted(asked.filter("line < 0").select("_h", "stroke"), alike, "stroke", "_h")
    forms = asked.groupBy("_h").agg(F.array_distinct(F.flatten(F.collect_set("ws"))).alias("forms"))
    return forms.join(titles, "_h", "full")


def _in_capitals(asked: DataFrame, rare: DataFrame, reader) -> DataFrame:
    """``_h, stroke, line, top``: patterns of lines in capitals, whose words are masked unless they are a form, a rarer one too."""

    def read(batches):
        r = reader.value
        for batch in batches:
            rows = [(h, p, i, top) for h, line, i, top, also in zip(*(c.to_pylist() for c in batch.columns)) for p in r.patterns(line, frozenset(also))]
            c = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.binary()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.bool_())], names=["_h", "stroke", "line", "top"])

    rows = asked.select("_h", "word", "line", "top", "words", F.monotonically_increasing_id().alias("_id"))  # repeated files count each
    rows = rows.select("_h", "word", "line", "top", "_id", F.explode("words").alias("w"))
    rows = join_salted(rows, rare.select("w", F.lit(True).alias("met")), "w", "_id", "left")
    rows = rows.groupBy("_id").agg(*(F.any_value(c).alias(c) for c in ("_h", "word", "line", "top")), F.collect_set(F.when(F.col("met"), F.col("w"))).alias("also"))
    return rows.select("_h", "word", "line", "top", "also").mapInArrow(read, "_h binary, stroke string, line int, top boolean")


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("string"))).alias("_h")


#: Up to so many texts with hints these are broadcast; more are joined by a shuffle.
BROADCAST_HINTS = 20_000


def read_lines(df: DataFrame, key: str = "pdf_no", text: str = "text", title: str = "title", stem: str = "id") -> DataFrame:
    """``key, line_no, kinds, line, repaired``: every line of every text, with its kinds (``header``, ``page_number``,
    ``hyphen``, ``ocr``) and with misread words repaired.

    Passes over the texts count forms, ask for rarer forms and patterns of titles, and read each file by itself. How many forms
    are broadcast depends on the number of files; the result does not, as a file is given all others that it can look up. A null
    text has no lines; an empty one has one empty line. Repeated files are read each. Null titles and stems are no evidence.
    """
    n = df.filter(F.length(text) > 0).count()
    least = max(LEAST_FILES, int(BROADCAST_SHARE * n))
    counts = materialize(form_counts(df, text))
    settled = materialize(settled_forms(counts))
    forms = {r["w"]: r["n"] for r in settled.filter(F.col("n") >= least).collect()}  # bounded by the share
    pairs = {r["w"]: r["n"] for r in counts.filter((F.col("n") >= least) & F.col("w").contains(" ")).collect()}
    reader = Reader(forms, pairs | {w: n for w, n in forms.items() if "-" in w})
    shared = df.sparkSession.sparkContext.broadcast(reader)
    hints = materialize(_hints(df, shared, counts, settled, least, text))
    schema = df.select(key).schema.add("line_no", "integer").add("kinds", T.ArrayType(T.StringType())).add("line", "string").add("repaired", "string")

    def read(batches):
        reader = shared.value
        for batch in batches:
            keys, texts, titles, stems, forms, tops = (batch.column(i).to_pylist() for i in range(6))
            rows = []
            for k, t, ti, st, more, at in zip(keys, texts, titles, stems, forms, tops):
                if t is not None:
                    raw = t.split("\n")
                    own = reader.with_forms([(x["w"], x["n"]) for x in more]) if more else reader
                    rows += [(k, no, sorted(ks), raw[no - 1], fixed) for no, ks, fixed in own.lines(t, ti, st, frozenset(at or ()))]
            cols = list(zip(*rows)) if rows else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], names=schema.names)

    files = df.select(F.col(key).alias("_key"), *(F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate((text, title, stem))), _digest(text))
    files = join_checked(files, hints.select("_h", "forms", "titles"), "_h", "left", BROADCAST_HINTS)
    return files.select("_key", "_0", "_1", "_2", "forms", "titles").mapInArrow(read, schema)


def line_noise(df: DataFrame, key: str = "pdf_no", **columns: str) -> DataFrame:
    """``key, line_no, kind``: one row per line and kind of noise."""
    return read_lines(df, key, **columns).select(key, "line_no", F.explode("kinds").alias("kind"))


def paragraphs(df: DataFrame, key: str = "pdf_no", **columns: str) -> DataFrame:
    """``key, par_no, text``: continuous paragraphs, in SQL windows over the lines of a file.

    Furniture goes; divided words are joined; lines are joined with a blank. An empty line ends a paragraph unless the
    line before it stops inside a sentence and the next one goes on in lower case (a page break). List lines and section
    titles are paragraphs of their own. The lines of one file are a window's unit; a file is one text and so bounded.
    """
    rows = read_lines(df, key, **columns)
    rows = rows.filter(~F.array_contains("kinds", "header") & ~F.array_contains("kinds", "page_number"))
    trimmed = F.regexp_replace("repaired", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
    rows = rows.select(key, "line_no", trimmed.alias("s"), F.array_contains("kinds", "hyphen").alias("divided"))
    by = W.partitionBy(key).orderBy("line_no")
    rows = rows.filter("s != ''").withColumn("gap", F.col("line_no") - F.lag("line_no").over(by) > 1)
    rows = rows.withColumn("before", F.lag("s").over(by)).withColumn("open", F.lag("divided").over(by))
    goes_on = F.col("open") | (~F.col("before").rlike(r"[.!?:]['\"“”»]?$") & F.col("s").rlike(r"^\p{Ll}"))
    item = F.col("s").rlike(r"^[-•*] ") | F.col("before").rlike(r"^[-•*] ") & ~F.col("open")
    section = F.col("s").rlike(r"^\d{1,2} \p{Lu}\p{L}+$") | F.col("before").rlike(r"^\d{1,2} \p{Lu}\p{L}+$")
    start = F.col("before").isNull() | item | section | (F.col("gap") & ~goes_on)
    rows = rows.withColumn("par_no", F.sum(start.cast("int")).over(by))
    piece = F.when(F.col("divided"), F.regexp_replace("s", "[-­‐¬=]$", "")).otherwise(F.concat("s", F.lit(" ")))
    out = rows.groupBy(key, "par_no").agg(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("piece")))).alias("x"))
    return out.select(key, F.col("par_no").cast("int").alias("par_no"), F.rtrim(F.array_join(F.transform("x", lambda r: r["piece"]), "")).alias("text"))
