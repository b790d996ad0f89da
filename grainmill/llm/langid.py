"""Languages of documents and of their lines (problem 6).

A bidirectional gated recurrent network reads bytes and labels every position; a line's probabilities are pooled over
its positions, a document's over its lines. It is trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.labels import clean_lang

#: The languages that a network has if none are given; ``train`` takes them from the samples.
LANGS = ("de", "en", "es", "fr", "nl")
#: Samples from which on a language of the samples is told.
LEAST_SAMPLES = 5
HIDDEN = 12
#: Bytes of a window: longer lines are cut, at a blank if there is one, and all windows are read.
WINDOW = 96
#: Labelled rows of the corpus used for training besides the language samples: the first so many per language in the
#: order of a hash of their key, each cut to so many characters. The bound of the training sample; everything else reads all
#: rows, whole.
SAMPLE_PER_LANG = 150
SAMPLE_CHARS = 2000
STEPS = 700
BATCH = 96
#: By how much the pooled score of another language must beat the document's language before a line is labelled with
#: it, in nats per line.
LINE_MARGIN = 6.0
#: Letters of a line below which it keeps the document's language: headings, names and a few quoted words.
LINE_LETTERS = 20


def prepared(text: str) -> bytes:
    """Lower-case UTF-8 in which all digits are one."""
    return text.lower().translate(_DIGITS).encode("utf-8", "replace")


_DIGITS = {ord(c): "0" for c in "123456789"}


def _gate(x):
    return np.clip(0.25 * x + 0.5, 0, 1)


class Network:
    """Weights: ``E`` byte to gate inputs, ``U`` state to gates, per direction; ``V`` states to languages."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 7, langs: tuple[str, ...] = LANGS):
        r = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.langs = langs
        self.w = {}
        for d in "fb":
            self.w["E" + d] = (r.standard_normal((256, 3 * h)) * 0.3).astype(np.float32)
            self.w["U" + d] = (r.standard_normal((h, 3 * h)) / np.sqrt(h)).astype(np.float32)
            self.w["V" + d] = (r.standard_normal((h, len(langs))) * 0.1).astype(np.float32)
        for d in "fb":
            self.w["E" + d][:, :h] -= 1.0  # slow updates at first
        self.w["b"] = np.zeros(len(langs), dtype=np.float32)

    def _run(self, x: np.ndarray, live: np.ndarray, d: str):
        """States and gates over time for columns sorted by falling length; ``live[t]`` columns are read at step t."""
        h2 = 2 * self.hidden
        E, U = self.w["E" + d], self.w["U" + d]
        Uzr, Un = np.ascontiguousarray(U[:, :h2]), np.ascontiguousarray(U[:, h2:])
        T, B = x.shape
        out = np.zeros((T + 1, B, self.hidden), dtype=np.float32)
        saved = []
        for t in range(T):
            k = live[t]
            h = out[t, :k]
            g = E[x[t, :k]]
            zr = g[:, :h2] + h @ Uzr
            zr *= 0.25
            zr += 0.5
            np.clip(zr, 0, 1, out=zr)
            z, r = zr[:, : self.hidden], zr[:, self.hidden :]
            rh = r * h
            n = np.tanh(g[:, h2:] + rh @ Un)
            o = out[t + 1, :k]
            np.subtract(n, h, out=o)
            o *= z
            o += h
            saved.append((z, r, rh, n))
        return out, saved

    def _states(self, x: np.ndarray, live: np.ndarray, d: str) -> np.ndarray:
        """The states of ``_run`` with the gate's slope and offset folded into the weights, in buffers that are kept."""
        H, h2 = self.hidden, 2 * self.hidden
        E, U = self.w["E" + d].copy(), self.w["U" + d].copy()
        E[:, :h2] = 0.25 * E[:, :h2] + 0.5
        U[:, :h2] *= 0.25
        Uzr, Un = np.ascontiguousarray(U[:, :h2]), np.ascontiguousarray(U[:, h2:])
        Ezr, En = np.ascontiguousarray(E[:, :h2]), np.ascontiguousarray(E[:, h2:])
        T, B = x.shape
        out = np.zeros((T + 1, B, H), dtype=np.float32)
        g, m = np.empty((B, h2), np.float32), np.empty((B, h2), np.float32)
        n, rh = np.empty((B, H), np.float32), np.empty((B, H), np.float32)
        for t in range(T):
            k = live[t]
            h, o, gk, mk, nk, rk = out[t, :k], out[t + 1, :k], g[:k], m[:k], n[:k], rh[:k]
            np.take(Ezr, x[t, :k], axis=0, out=gk, mode="clip")
            np.dot(h, Uzr, out=mk)
            gk += mk
            np.clip(gk, 0, 1, out=gk)
            np.multiply(gk[:, H:], h, out=rk)
            np.take(En, x[t, :k], axis=0, out=nk, mode="clip")
            np.dot(rk, Un, out=o)
            nk += o
            np.tanh(nk, out=nk)
            np.subtract(nk, h, out=o)
            o *= gk[:, :H]
            o += h
        return out

    def train(self, windows: list[bytes], labels: np.ndarray, weight: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> None:
        """Adam on the mean cross-entropy of all positions; backpropagation through the whole window."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        p = weight / weight.sum()
        for step in range(1, steps + 1):
            pick = rng.choice(len(windows), size=batch, p=p)
            x, live, order = _columns([windows[i] for i in pick])
            grad = self._gradient(x, live, labels[pick][order])
            rate = 0.02 * (1 - step / (steps + 1))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            scale = min(1.0, 1.0 / (norm + 1e-9))
            for k, g in grad.items():
                g = g * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                self.w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)

    def _gradient(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        T, B = x.shape
        H, h2 = self.hidden, 2 * self.hidden
        back = _reversed(x, live)
        out, saved = {}, {}
        for d, xs in (("f", x), ("b", back)):
            out[d], saved[d] = self._run(xs, live, d)
        lengths = (np.arange(T)[:, None] < np.array([(live > c).sum() for c in range(B)])[None, :]).sum(0)
        mask = np.arange(T)[:, None] < lengths[None, :]
        place = np.where(mask, lengths[None, :] - 1 - np.arange(T)[:, None], 0)
        hb = out["b"][1:][place, np.arange(B)[None, :]]
        hf = out["f"][1:]
        logits = hf @ self.w["Vf"] + hb @ self.w["Vb"] + self.w["b"]
        q = _softmax(logits)
        q[np.arange(T)[:, None], np.arange(B)[None, :], y[None, :]] -= 1
        q *= mask[:, :, None] / max(1, mask.sum())
        grad = {"b": q.sum((0, 1)), "Vf": np.einsum("tbh,tbl->hl", hf, q), "Vb": np.einsum("tbh,tbl->hl", hb, q)}
        dhf = q @ self.w["Vf"].T
        dhb = np.zeros_like(dhf)
        tt, bb = np.nonzero(mask)
        dhb[place[tt, bb], bb] = (q @ self.w["Vb"].T)[tt, bb]
        for d, xs, dout in (("f", x, dhf), ("b", back, dhb)):
            U = self.w["U" + d]
            gE, gU = np.zeros_like(self.w["E" + d]), np.zeros_like(U)
            carry = np.zeros((B, H), dtype=np.float32)
            for t in range(T - 1, -1, -1):
                k = live[t]
                z, r, rh, n = saved[d][t]
                h = out[d][t, :k]
                dh = dout[t, :k] + carry[:k]
                dn = dh * z * (1 - n * n)
                dz = dh * (n - h) * 0.25 * ((z > 0) & (z < 1))
                drh = dn @ U[:, h2:].T
                dr = drh * h * 0.25 * ((r > 0) & (r < 1))
                dzr = np.concatenate([dz, dr], axis=1)
                carry[:k] = dh * (1 - z) + drh * r + dzr @ U[:, :h2].T
                gU[:, :h2] += h.T @ dzr
                gU[:, h2:] += rh.T @ dn
                np.add.at(gE, xs[t, :k], np.concatenate([dzr, dn], axis=1))
            grad["E" + d], grad["U" + d] = gE, gU
        return grad

    def pooled(self, windows: list[bytes], at_once: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Sums over each window's positions of the log-probabilities and of the probabilities of the languages."""
        n = len(windows)
        logs, probs = np.zeros((n, len(self.langs)), np.float32), np.zeros((n, len(self.langs)), np.float32)
        order = np.argsort([-len(w) for w in windows], kind="stable")
        for a in range(0, n, at_once):
            own = order[a : a + at_once]
            x, live, sub = _columns([windows[i] for i in own])
            own = own[sub]
            if not len(x):
                continue
            hf = self._states(x, live, "f")
            hb = self._states(_reversed(x, live), live, "b")
            T, B = x.shape
            # one row per language, as reductions over a short last axis are slow
            lengths = _lengths(live, B)
            place = lengths[None, :] - 1 - np.arange(T)[:, None]
            mask = (place >= 0).astype(np.float32).ravel()
            back = np.where(place >= 0, place * B + np.arange(B)[None, :], 0).ravel()
            y = self.w["Vf"].T @ hf[1:].reshape(-1, self.hidden).T
            y += np.take(self.w["Vb"].T @ hb[1:].reshape(-1, self.hidden).T, back, axis=1)
            y += self.w["b"][:, None]
            y -= y.max(0)
            e = np.exp(y)
            total = e.sum(0)
            y -= np.log(total)
            e *= mask / total
            y *= mask
            logs[own], probs[own] = y.reshape(-1, T, B).sum(1).T, e.reshape(-1, T, B).sum(1).T
        return logs, probs


def _lengths(live: np.ndarray, B: int) -> np.ndarray:
    return np.searchsorted(-live, -np.arange(B), side="left")


def _columns(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes by time and window, longest window first; how many windows reach each time; the order taken."""
    size = np.array([len(w) for w in windows], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    size = size[order]
    T = int(size[0]) if len(size) else 0
    flat = np.frombuffer(b"".join(windows[i] for i in order), dtype=np.uint8)
    x = np.zeros((T, len(windows)), dtype=np.intp)
    col = np.repeat(np.arange(len(size)), size)
    row = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    x[row, col] = flat
    live = np.searchsorted(-size, -np.arange(T), side="left")
    return x, live, order


def _reversed(x: np.ndarray, live: np.ndarray) -> np.ndarray:
    T, B = x.shape
    lengths = _lengths(live, B)
    place = lengths[None, :] - 1 - np.arange(T)[:, None]
    return np.where(place >= 0, x[np.maximum(place, 0), np.arange(B)[None, :]], 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def windows_of(raw: bytes, size: int = WINDOW) -> list[bytes]:
    out = []
    while len(raw) > size:
        cut = raw.rfind(b" ", size // 2, size) + 1 or size
        out.append(raw[:cut])
        raw = raw[cut:]
    if raw:
        out.append(raw)
    return out


def _variants(text: str) -> list[str]:
    plain = text.translate(str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"}))
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return [text, plain, bare]


@lru_cache(maxsize=4)
def _trained(rows: tuple[tuple[str, str, bool], ...], langs: tuple[str, ...], hidden: int, steps: int) -> Network:
    windows, labels, weight, trusted, row_of = [], [], [], [], []
    for at, (lang, text, clean) in enumerate(rows):
        for i, t in enumerate(_variants(text)):
            for line in t.split("\n"):
                raw = prepared(line.strip())
                for size in (WINDOW, 40):
                    for w in windows_of(raw, size):
                        windows.append(w)
                        labels.append(langs.index(lang))
                        weight.append((1.0 if i == 0 else 0.3) * (1.0 if size == WINDOW else 0.5))
                        trusted.append(clean)
                        row_of.append(at)
    labels, trusted = np.array(labels), np.array(trusted)
    weight = np.array(weight)
    for i in range(len(langs)):
        own = labels == i
        if own.any():
            weight[own] /= weight[own].sum()
    # the first network learns from the clean samples only; labelled rows that it disagrees with as a whole are left out
    first = Network(hidden, langs=langs)
    first.train(windows, labels, np.where(trusted, weight, 0), steps // 3)
    logs, _ = first.pooled(windows)
    by_row = np.zeros((len(rows), len(langs)))
    np.add.at(by_row, row_of, logs)
    doubted = (by_row.argmax(1)[row_of] != labels) & ~trusted
    net = Network(hidden, langs=langs)
    net.train(windows, labels, np.where(doubted, 0, weight), steps)
    return net


def train(samples: DataFrame, labelled: DataFrame | None = None, key: str = "ord", lang: str = "lang", text: str = "text", per_lang: int = SAMPLE_PER_LANG, hidden: int = HIDDEN, steps: int = STEPS, chars: int = SAMPLE_CHARS, least_samples: int = LEAST_SAMPLES) -> Network:
    """A network from clean samples and, if given, a bounded sample of labelled rows.

    The languages are those with ``least_samples`` clean samples; one of labelled rows alone cannot be checked and is not
    told. The sample takes the first ``per_lang`` rows of each language in the order of a hash of the key, whose labels may
    be wrong now and then; it is bounded by ``per_lang``, the number of languages, and ``chars`` characters a row.
    """
    rows = [(r["lang"], r["text"], True) for r in samples.filter("lang is not null and text is not null").select("lang", "text").collect()]  # a fixed table
    n_of = Counter(r[0] for r in rows)
    langs = tuple(sorted(k for k, n in n_of.items() if n >= least_samples))
    rows = [r for r in rows if r[0] in langs]
    if labelled is not None and per_lang and langs:
        c = labelled.select(clean_lang(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string")).alias("h")).filter(F.col("lang").isin(*langs) & (F.length("text") > 40))
        counts = {r["lang"]: r["count"] for r in c.groupBy("lang").count().collect()}  # one row per language
        # hashes are even, so four times the wanted share holds the first rows of every language; a bounded top-n in any case
        near = F.lit(False)
        for one, n in counts.items():
            limit = min(int(min(1.0, 4 * per_lang / n) * 2**64) - 2**63, 2**63 - 1)
            near = near | ((F.col("lang") == one) & (F.col("h") <= limit))
        first = c.filter(near).groupBy("lang", "h").agg(F.min(F.substring("text", 1, chars)).alias("text"))  # a repeated key is one row
        first = first.orderBy("h", "lang").limit(16 * per_lang * len(langs)).collect()
        for one in langs:
            rows += [(r["lang"], r["text"], False) for r in first if r["lang"] == one][:per_lang]
    return _trained(tuple(sorted(rows)), langs, hidden, steps)


def languages(df: DataFrame, net: Network, key: str = "ord", label: str = "lang", text: str = "text", margin: float = LINE_MARGIN, least_letters: int = LINE_LETTERS) -> DataFrame:
    """``key, label, seg_no, lang, confidence, n_chars, main``: a row with ``seg_no = 0`` for each text, and one for each of its
    non-blank lines, counted from 1.

    A line's language has the largest pooled log-probability; the document's the most characters of lines, weighted with
    their confidence. A line keeps the document's language unless another leads by ``margin`` over ``least_letters``
    letters or more. The confidence is the language's share of the pooled position probabilities.
    Null and blank texts give one row without language and with confidence 0. Whole texts are read, in windows; there is
    no shuffle. Ties go to the language first in the alphabet. Repeated rows are labelled each.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)
    schema = df.select(F.col(key), F.col(label).cast("string").alias("label")).schema.add("seg_no", "integer").add("lang", "string").add("confidence", "double").add("n_chars", "long").add("main", "string")

    def label_all(batches):
        net = shared.value
        for big in batches:
            for a in range(0, big.num_rows, 4000):
                yield one(net, big.slice(a, 4000))

    def one(net, batch):
        texts = batch.column(2).to_pylist()
        windows, owner, lines, sizes, letters = [], [], [], [], []  # line: its document
        for i, t in enumerate(texts):
            for line in (t or "").split("\n"):
                if line.strip():
                    ws = windows_of(prepared(line.strip()))
                    windows += ws
                    owner += [len(lines)] * len(ws)
                    lines.append(i)
                    sizes.append(len(line))
                    letters.append(sum(map(str.isalpha, line)) if len(line) < 4 * least_letters else len(line))
        n, letters = len(lines), np.array(letters)
        logs, probs = np.zeros((n, len(net.langs))), np.zeros((n, len(net.langs)))
        if windows:
            lw, pw = net.pooled(windows)
            np.add.at(logs, owner, lw)
            np.add.at(probs, owner, pw)
        lines, sizes, at = np.array(lines, dtype=np.int64), np.array(sizes, dtype=np.int64), np.arange(n)
        best = logs.argmax(1)
        doc, votes = np.zeros((len(texts), len(net.langs))), np.zeros((len(texts), len(net.langs)))
        np.add.at(doc, lines, probs)
        np.add.at(votes, (lines, best), sizes * probs[at, best] / np.maximum(probs.sum(1), 1e-9))
        main = (votes + 1e-6 * doc).argmax(1)
        share = doc[np.arange(len(texts)), main] / np.maximum(doc.sum(1), 1e-9)
        no_line = doc.sum(1) == 0
        own = main[lines]
        lead = logs[at, best] - logs[at, own] if n else np.zeros(0)
        best = np.where((lead > margin) & (letters >= least_letters), best, own)
        first = np.searchsorted(lines, lines, side="left")
        seg = at - first + 1
        conf = probs[at, best] / np.maximum(probs.sum(1), 1e-9)
        names = np.array(net.langs, dtype=object)
        row = np.concatenate([np.arange(len(texts)), lines])
        order = np.argsort(row, kind="stable")
        lang = np.concatenate([np.where(no_line, None, names[main]), names[best]])
        cols = [
            batch.column(0).take(pa.array(row[order])), batch.column(1).take(pa.array(row[order])),
            pa.array(np.concatenate([np.zeros(len(texts), np.int32), seg.astype(np.int32)])[order]), pa.array(lang[order], pa.string()),
            pa.array(np.concatenate([np.where(no_line, 0.0, share), conf])[order]), pa.array(np.concatenate([np.array([len(t or "") for t in texts], np.int64), np.array(sizes, np.int64)])[order]),
            pa.array(np.concatenate([lang[: len(texts)], names[own]])[order], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.select(F.col(key), F.col(label).cast("string").alias("label"), F.col(text).cast("string")).mapInArrow(label_all, schema)


def label_errors(labelled: DataFrame, key: str = "ord") -> DataFrame:
    """``key, seg_no, lang`` of ``languages``: missing or wrong labels (0) and lines in another language than the main one."""
    wrong = (F.col("seg_no") == 0) & (clean_lang("label") != F.col("lang"))
    return labelled.filter("lang is not null").filter(wrong | (F.col("lang") != F.col("main"))).select(key, "seg_no", "lang")
