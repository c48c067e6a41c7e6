"""Language of documents and of their segments: averaged hashed subword embeddings, linear softmax."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Language codes, their three-letter codes and names.
LABELS = {
    "en": "eng english inglés", "es": "spa spanish español espanol castellano", "fr": "fra fre french français francais",
    "de": "deu ger german deutsch", "pt": "por portuguese português portugues", "vi": "vie vietnamese tiếngviệt",
    "it": "ita italian", "nl": "nld dut dutch", "zh": "zho chi chinese", "ja": "jpn japanese", "ko": "kor korean", "ru": "rus russian", "ar": "ara arabic", "pl": "pol polish",
}
LABEL_CODE = {form: code for code, others in LABELS.items() for form in (code, *others.split())}

#: Documents with a label that the model is fitted on, at most; which ones is decided by a hash of the id.
SAMPLE_DOCS = 2_000
BUCKETS, DIMENSIONS, EPOCHS, RATE, BATCH = 1 << 15, 8, 4, 0.3, 128
#: A sentence with fewer known words, or a lower confidence, decides nothing.
KNOWN_WORDS, LEAST_CONFIDENCE = 4, 0.6
#: Weight of words that the sample holds fewer than three times: mostly names.
RARE_WEIGHT = 0.2

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r".*?(?:[.!?]+[\"'»”)]*(?=\s+[^\sa-z])|\n[ \t]*\n\s*|\Z)", re.DOTALL)
_CODE = re.compile(r"\b[A-Z]{2,}\b")


def label_language(label: str | None) -> str | None:
    """The two-letter code that a label names in any notation, or None."""
    if label is None:
        return None
    text = unicodedata.normalize("NFC", label).strip().lower().replace(" ", "")
    return LABEL_CODE.get(text) or LABEL_CODE.get(re.split(r"[-_]", text)[0])


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences: ended by a blank line, or by a full stop before something that is no small letter."""
    return [m.span() for m in _SENTENCE.finditer(text) if m.end() > m.start() and not m[0].isspace()]


def words(sentence: str) -> list[str]:
    """Lower-cased words; words in capitals (codes) only where a longer sentence is all in capitals."""
    if sentence.isupper():
        found = _WORD.findall(sentence.lower())
        return found if len(found) > 6 else []
    return _WORD.findall(_CODE.sub(" ", sentence).lower())


def _hash(text: str) -> int:
    h = 2166136261
    for c in text.encode():
        h = ((h ^ c) * 16777619) & 0xFFFFFFFF
    return (h ^ h >> 15) % BUCKETS


def subwords(word: str) -> list[int]:
    """Buckets of a word and its trigrams."""
    w = f"<{word}>"
    return [_hash(w), *(_hash(w[i:i + 3]) for i in range(len(w) - 2))]


@dataclass
class Model:
    """Scores per bucket (embedding times softmax weights), bias, temperature, known words."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    known: frozenset[str]


def _features(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    cache: dict[str, list[int]] = {}
    flat: list[int] = []
    sizes = []
    for ws in texts:
        before = len(flat)
        for w in ws:
            got = cache.get(w)
            if got is None:
                got = cache[w] = subwords(w)
            flat += got
        sizes.append(len(flat) - before)
    return np.array(flat, np.int64), np.array(sizes, np.int64)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[list[str]], labels: list[str], seed: int = 7) -> Model:
    """Fit by stochastic gradient descent; refit without sentences whose label the first fit denies.

    Classes weigh alike whatever their share. The temperature is the one of
    least loss on every tenth sentence, which the fit does not see.
    """
    languages = sorted(set(labels))
    known_count: dict[str, int] = {}
    for ws in texts:
        for w in set(ws):
            known_count[w] = known_count.get(w, 0) + 1
    known = frozenset(w for w, n in known_count.items() if n >= 3)
    if not languages:
        return Model(["und"], np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), 1.0, known)
    flat, sizes = _features(texts)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    y = np.array([languages.index(x) for x in labels])
    keep = sizes > 0
    held = np.arange(len(y)) % 10 == 9
    rng = np.random.default_rng(seed)
    k = len(languages)
    for _ in range(2):
        train = np.flatnonzero(keep & ~held)
        weight = 1.0 / np.sqrt(np.maximum(1, np.bincount(y[train], minlength=k)))
        weight *= len(train) / max(1e-9, weight[y[train]].sum())
        # Small start: buckets that the sample never met stay near nothing.
        emb = rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
        w = rng.normal(0, 0.5, (DIMENSIONS, k)).astype(np.float32)
        b = np.zeros(k, np.float32)
        seen, seen_w = np.full(BUCKETS, 1e-6, np.float32), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(train)
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                n = sizes[rows]
                ends = np.cumsum(n)
                idx = flat[np.arange(ends[-1]) + np.repeat(starts[rows] - ends + n, n)]
                x = np.add.reduceat(emb[idx], ends - n) / n[:, None]
                p = _softmax(x @ w + b)
                p[np.arange(len(rows)), y[rows]] -= 1
                g = (p * weight[y[rows], None] / len(rows)).astype(np.float32)
                dx, dw = (g @ w.T / n[:, None]).astype(np.float32), x.T @ g
                by = np.argsort(idx, kind="stable")
                cuts = np.flatnonzero(np.diff(idx[by], prepend=-1))
                hit = idx[by[cuts]]
                de = np.add.reduceat(np.repeat(dx, n, 0)[by], cuts)
                seen[hit] += (de * de).mean(1)
                emb[hit] -= RATE * de / np.sqrt(seen[hit])[:, None]
                seen_w += float((dw * dw).mean())
                w -= RATE * dw / np.sqrt(seen_w)
                b -= RATE * g.sum(0)
        logits = _logits(flat, sizes, starts, emb @ w, b)
        p = _softmax(logits)
        keep = keep & ~((p.argmax(1) != y) & (p.max(1) > 0.5))
    test = np.flatnonzero(held & keep)
    temperature = 1.0
    if len(test):
        loss = {t: -np.log(_softmax(logits[test] / t)[np.arange(len(test)), y[test]] + 1e-9).mean() for t in (0.2, 0.35, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0)}
        temperature = min(loss, key=loss.get)
    return Model(languages, (emb @ w).astype(np.float32), b, float(temperature), known)


def _logits(flat: np.ndarray, sizes: np.ndarray, starts: np.ndarray, scores: np.ndarray, bias: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), scores.shape[1]), np.float32)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(scores[flat], starts[some]) / sizes[some, None]
    return out + bias


class Tagger:
    """Tags sentences; the sums of the words' subword scores are kept per word."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.ids: dict[str, int] = {}
        self.sums = np.zeros((1 << 12, len(model.languages) + 2), np.float32)

    def _id(self, word: str) -> int:
        k = len(self.ids)
        if k == len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        sub, known = subwords(word), word in self.model.known
        weight = 1.0 if known else RARE_WEIGHT
        self.sums[k, :-2] = weight * self.model.scores[sub].sum(0)
        self.sums[k, -2:] = weight * len(sub), known
        self.ids[word] = k
        return k

    def tag(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: undecided) and confidence of each list of words."""
        if len(self.ids) > 500_000:
            self.ids.clear()
        ids, get = self.ids, self.ids.get
        flat: list[int] = []
        for ws in parts:
            flat += [i if (i := get(w)) is not None else self._id(w) for w in ws]
        sizes = np.array([len(ws) for ws in parts], np.int64)
        lang, conf = np.full(len(parts), -1), np.zeros(len(parts))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            sums = np.add.reduceat(self.sums[np.array(flat, np.int64)], starts[some])
            p = _softmax((sums[:, :-2] / sums[:, -2:-1] + self.model.bias) / self.model.temperature)
            conf[some] = p.max(1)
            decided = (sums[:, -1] >= KNOWN_WORDS) & (conf[some] >= LEAST_CONFIDENCE)
            lang[some] = np.where(decided, p.argmax(1), -1)
        return lang, conf


def segments(langs: list[int], confs: list[float], spans: list[tuple[int, int]]) -> list[tuple[int, float, int, int, int]]:
    """Longest runs of one language: (language, confidence, sentences, start, end).

    Undecided sentences go with the run before them, at the start with the first run.
    """
    out: list[list] = []
    first = spans[0][0] if spans else 0
    for lang, conf, (a, b) in zip(langs, confs, spans):
        if lang < 0:
            if out:
                out[-1][2] += 1
                out[-1][4] = b
        elif out and out[-1][0] == lang:
            run = out[-1]
            run[1].append(conf)
            run[2] += 1
            run[4] = b
        else:
            out.append([lang, [conf], 1, a, b])
    if out:
        out[0][3] = first
    return [(lang, float(np.mean(c)), n, a, b) for lang, c, n, a, b in out]


def training_sentences(documents: DataFrame, doc: str, text: str, label: str, most: int = SAMPLE_DOCS) -> tuple[list[list[str]], list[str]]:
    """Sentences of a bounded sample of labelled documents, on the driver.

    The sample is the `most` documents with the smallest hash of their id
    among those whose label, in any notation, names a language.
    """
    forms = list(LABEL_CODE)
    named = F.lower(F.regexp_extract(F.trim(F.col(label)), r"^([\p{L}]+)", 1)).isin(*forms)
    ids = documents.filter(named & F.col(text).isNotNull()).select(F.col(doc).alias("id__")).orderBy(F.xxhash64("id__"), "id__").limit(most)
    rows = documents.join(F.broadcast(ids), documents[doc] == ids["id__"], "left_semi").select(text, label, doc).collect()
    texts, labels = [], []
    for body, name, _ in sorted(rows, key=lambda r: r[2]):
        code = label_language(name)
        if code:
            body = unicodedata.normalize("NFC", body)
            for a, b in sentences(body):
                ws = words(body[a:b])
                if len(ws) >= KNOWN_WORDS:
                    texts.append(ws)
                    labels.append(code)
    return texts, labels


def tag_documents(documents: DataFrame, doc: str, text: str, label: str, *, sample: int = SAMPLE_DOCS) -> DataFrame:
    """One row per language segment of each document.

    Columns `doc`, `label_lang` (null if the label is absent or names no
    language), `n_segments`, `seg_no`, `lang`, `confidence`, `n_sentences`,
    `start`, `end` (in the text in composed form). A null or empty text, or one without any
    sentence that can be told, gives no row. Texts are read whole, in one pass
    without a shuffle; the fitted model has a fixed size.
    """
    model = fit(*training_sentences(documents, doc, text, label, sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        for batch in batches:
            spans, parts = [], []
            for body in batch["text"]:
                body = body if body.isascii() else unicodedata.normalize("NFC", body)
                own = sentences(body)
                spans.append(own)
                parts += [words(body[a:b]) for a, b in own]
            langs, confs = tagger.tag(parts)
            langs, confs = langs.tolist(), confs.tolist()
            rows, at = [], 0
            for doc_id, name, own in zip(batch["doc"], batch["label"], spans):
                found = segments(langs[at:at + len(own)], confs[at:at + len(own)], own)
                at += len(own)
                code = label_language(name)
                rows += [(doc_id, code, len(found), k, model.languages[s[0]], s[1], s[2], s[3], s[4]) for k, s in enumerate(found)]
            yield pd.DataFrame(rows, columns=["doc", "label_lang", "n_segments", "seg_no", "lang", "confidence", "n_sentences", "start", "end"])

    doc_type = documents.schema[doc].dataType.simpleString()
    rows = documents.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.col(label).alias("label"))
    return rows.mapInPandas(run, f"doc {doc_type}, label_lang string, n_segments int, seg_no int, lang string, confidence double, n_sentences int, start int, `end` int")
