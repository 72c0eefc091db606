"""Toxicity by a support vector machine on a subsequence string kernel, with Nystrom landmarks.

Kernel of two words: the gap-weighted subsequence kernel of length ``P`` with decay
``DECAY``, normalised, so gapped and letter-inserted spellings stay similar to a word. Words
are letters only, lower-cased (signs and digits inside a word vanish), and a run of three or
more single letters is one word. A text's kernel with a landmark word is log(1 + sum of the
word kernel over the text's words); values under ``FLOOR`` count as none. Nystrom map of a
text: its kernels with the landmarks times the inverse square root of the landmarks' own
kernel matrix, so no pair of texts is ever compared.

Training: labelled rows outside fold 0, at most ``MAX_TRAIN`` of each class by id hash (a
bound on the classifier's training rows only). Candidate words for landmarks are those whose
document frequency speaks most for label 1 (G-test), thinned so that no landmark resembles an
earlier one too much; frequent words of label 0 are added. A linear SVM (squared hinge loss,
Newton steps) on the maps, the landmarks' shares of the words and the length, then a logistic
fit of its margin (Platt) gives the score.

Scoring is row-wise: no shuffle; every text is read whole. Null and empty texts score like a
text without words. No labelled row of some class: every score is the base rate (0 without
any). Repeated rows and ids are kept; labels, lang, source and ids are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.text import LOWER, of_text

P, DECAY, FLOOR = 3, 0.6, 0.4
FOLDS = 5
MAX_TRAIN = 4000
LANDMARKS, PLAIN = 56, 2
ALIKE = 0.75
LONGEST = 24
_DROP = bytes(b for b in range(128) if not chr(b).isalpha() and not chr(b).isspace())
_SINGLES = re.compile(rb"(?<!\S)[a-z](?:[ \t]+[a-z]){2,}(?!\S)")
_CACHE = 400_000


def words_of(raw: bytes | None) -> Counter:
    low = (raw or b"").translate(LOWER, _DROP)
    words = Counter(low.split())
    for run in _SINGLES.findall(low):
        words[b"".join(run.split())] += 1
    return words


def _pieces(word: bytes) -> list[str]:
    """A word as text; a very long one as overlapping pieces of LONGEST letters."""
    s = word.decode("utf-8", "replace").lower()
    return [s] if len(s) <= LONGEST else [s[i:i + LONGEST] for i in range(0, len(s) - LONGEST // 2, LONGEST // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """Letters as numbers, padded with -1."""
    size = np.array([len(w) for w in words] or [0])
    out = np.full((len(words), max(int(size.max()), 1)), -1, np.int32)
    out[np.arange(out.shape[1]) < size[:len(words), None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def subsequence_kernel(s: np.ndarray, t: np.ndarray, decay: float = DECAY, p: int = P) -> np.ndarray:
    """Gap-weighted kernel of rows of ``s`` (n, len) with rows of ``t`` (n or 1, len):
    the sum over common subsequences of length p of decay^(spans in both)."""
    n = max(len(s), len(t))
    la, lb = s.shape[1], t.shape[1]
    # near[i][j]: weighted common subsequences of length k in s[:i], t[:j], their gaps counted to the ends i and j
    near = np.ones((la + 1, lb + 1, n), np.float32)
    total = np.zeros(n, np.float32)
    same = [[((s[:, i] == t[:, j]) & (s[:, i] >= 0)).astype(np.float32) for j in range(lb)] for i in range(la)]
    for k in range(1, p + 1):
        if k == p:
            for i in range(la):
                for j in range(lb):
                    total += same[i][j] * near[i, j] * decay * decay
            break
        nxt = np.zeros_like(near)
        for i in range(la):
            ends = np.zeros(n, np.float32)
            for j in range(lb):
                ends = decay * ends + decay * decay * same[i][j] * near[i, j]
                nxt[i + 1, j + 1] = decay * nxt[i, j + 1] + ends
        near = nxt
    return total


def _pairs(words: list[str], apart: int) -> np.ndarray:
    """128-bit sketches (n, 2) of the letter pairs up to ``apart`` places apart."""
    out = np.zeros((len(words), 2), np.uint64)
    codes = _codes(words).astype(np.int64)
    rows = np.arange(len(words))
    for gap in range(1, apart + 1):
        for i in range(codes.shape[1] - gap):
            a, b = codes[:, i], codes[:, i + gap]
            at = (a * 1_000_003 + b * 7919) * 0x9E3779B97F4A7C1 >> 20 & 127
            bit = np.where((a >= 0) & (b >= 0), np.uint64(1) << (at & 63).astype(np.uint64), np.uint64(0))
            out[rows, at >> 6] |= bit
    return out


class Landmarks:
    """Normalised word kernels with fixed landmark words."""

    def __init__(self, words: list[str]):
        self.words, self.codes = words, _codes(words)
        self.size = np.array([len(w) for w in words])
        self.own = np.array([subsequence_kernel(c[None, :n], c[None, :n])[0] for c, n in zip(self.codes, self.size)])
        self.mask = _pairs(words, 1)
        self.need = np.ceil(0.6 * np.bitwise_count(self.mask).sum(1))

    def against(self, words: list[str]) -> np.ndarray:
        """(len(words), landmarks) kernels; a word without 60 % of a landmark's letter pairs
        (adjacent or one apart) counts as 0, as do values under FLOOR."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        mask, size, codes = _pairs(words, 2), np.array([len(w) for w in words]), _codes(words)
        hits = []
        for j, m in enumerate(self.mask):
            common = np.bitwise_count(mask[:, 0] & m[0]) + np.bitwise_count(mask[:, 1] & m[1])
            i = np.flatnonzero((common >= self.need[j]) & (size >= P))
            hits.append(np.stack([i, np.full_like(i, j)]))
        word, mark = np.concatenate(hits, axis=1)
        own = np.ones(len(words), np.float32)
        used = np.unique(word)
        for at in _alike(size[used], size[used]):
            part = used[at]
            c = codes[part, :size[part].max()]
            own[part] = subsequence_kernel(c, c)
        for at in _alike(size[word], self.size[mark]):
            i, j = word[at], mark[at]
            k = subsequence_kernel(codes[i, :size[i].max()], self.codes[j, :self.size[j].max()])
            out[i, j] = k / np.sqrt(np.maximum(own[i] * self.own[j], 1e-20))
        out[out < FLOOR] = 0
        return out


def _alike(a: np.ndarray, b: np.ndarray, most: int = 5_000):
    """Indices in groups of like lengths (a, b), of bounded size."""
    group = (a // 3) * 64 + b // 3
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, cuts):
        for at in range(0, len(part), most):
            yield part[at:at + most]


class TextKernel:
    """Kernels of texts with landmarks; kernels of words are kept between texts."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks, self.kept = landmarks, {}

    def __call__(self, texts: list[Counter]) -> np.ndarray:
        if len(self.kept) > _CACHE:
            self.kept = {}
        new = list({w for t in texts for w in t if w not in self.kept})
        pieces = [(w, p) for w in new for p in _pieces(w)]
        for w in new:
            self.kept[w] = None
        for at in range(0, len(pieces), 100_000):
            part = pieces[at:at + 100_000]
            k = self.landmarks.against([p for _, p in part])
            for i in np.flatnonzero(k.any(1)):
                w, old = part[i][0], self.kept[part[i][0]]
                self.kept[w] = k[i].astype(np.float32) if old is None else np.maximum(old, k[i])
        out = np.zeros((len(texts), len(self.landmarks.words) + 1), np.float32)
        for i, t in enumerate(texts):
            for w, n in t.items():
                row = self.kept[w]
                if row is not None:
                    out[i, :-1] += n * row
            out[i, -1] = sum(t.values())
        return out


class Model:
    """A trained scorer of texts; ``base`` is the score where there was nothing to learn."""

    def __init__(self, base: float):
        self.base, self.words, self.parts, self.kernel = base, [], None, None

    def features(self, k: np.ndarray) -> np.ndarray:
        sums, n = k[:, :-1].astype(np.float64), k[:, -1:].astype(np.float64)
        return np.hstack([np.log1p(sums) @ self.nystrom, np.log1p(1000 * sums / np.maximum(n, 1)), np.log1p(n)])

    def margin(self, k: np.ndarray) -> np.ndarray:
        mean, scale, weight = self.parts
        z = (self.features(k) - mean) / scale
        return z @ weight[:-1] + weight[-1]

    def prepare(self) -> None:
        marks = Landmarks(self.words)
        values, vectors = np.linalg.eigh(np.maximum(marks.against(self.words), 0).astype(np.float64) + 0.1 * np.eye(len(self.words)))
        self.nystrom = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        self.kernel = TextKernel(marks)

    def scores(self, raws: list[bytes | None]) -> np.ndarray:
        if not self.words:
            return np.full(len(raws), self.base)
        if self.kernel is None:
            self.prepare()
        m = self.margin(self.kernel([words_of(r) for r in raws]))
        return 1 / (1 + np.exp(-np.clip(self.platt[0] * m + self.platt[1], -50, 50)))

    def __getstate__(self):
        return self.__dict__ | {"kernel": None}


def _gain(in1: int, in0: int, n1: int, n0: int) -> float:
    """G-test of a word's document frequencies; 0 where it does not speak for label 1."""
    if in1 * n0 <= in0 * n1:
        return 0.0
    total, k = n1 + n0, in1 + in0
    cells = ((in1, k * n1), (in0, k * n0), (n1 - in1, (total - k) * n1), (n0 - in0, (total - k) * n0))
    return sum(o * np.log(o * total / e) for o, e in cells if o)


def _svm(z: np.ndarray, sign: np.ndarray, cost: float) -> np.ndarray:
    """Weights (last: intercept) of a linear SVM with squared hinge loss."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(40):
        loss = 1 - sign * (x @ w)
        a = loss > 0
        step = np.linalg.solve(ridge + 2 * cost * x[a].T @ x[a], ridge @ w - 2 * cost * x[a].T @ (sign[a] * loss[a]))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin * margin).sum(), (v * margin).sum()], [(v * margin).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(texts: list[Counter], labels: list[int], cost: float = 0.1) -> Model:
    y = np.array(labels, np.int64)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    model = Model(n1 / max(n1 + n0, 1))
    if not n1 or not n0:
        return model
    inside = (Counter(), Counter())
    for t, label in zip(texts, labels):
        inside[label].update({q for w in t for p in _pieces(w) for q in (p, p[:5], p[:7]) if len(q) >= 4 and len(set(q)) > 2})
    ranked = sorted(((-_gain(a, inside[0][w], n1, n0), w) for w, a in inside[1].items() if a >= 3))[:1200]
    for g, w in ranked:
        if g < -10 and len(model.words) < LANDMARKS and not (
                model.words and Landmarks(model.words).against([w]).max() > ALIKE):
            model.words.append(w)
    if not model.words:
        return model
    plain = sorted((-a, w) for w, a in inside[0].items() if a * n1 >= inside[1][w] * n0)[:PLAIN]
    model.words += [w for _, w in plain]
    model.prepare()
    k = model.kernel(texts)
    f = model.features(k)
    model.parts = (f.mean(0), f.std(0) + 1e-6, None)
    z = (f - model.parts[0]) / model.parts[1]
    model.parts = (*model.parts[:2], _svm(z, 2 * y - 1.0, cost))
    # Margins for the logistic fit come from other folds, or it would trust the training margins.
    fold, margin = np.arange(len(y)) % 3, np.zeros(len(y))
    for i in range(3):
        w = _svm(z[fold != i], 2 * y[fold != i] - 1.0, cost)
        margin[fold == i] = z[fold == i] @ w[:-1] + w[-1]
    model.platt = _platt(margin, y.astype(np.float64))
    return model


def fold(doc_id: Column | str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Model:
    """A model from labelled rows outside fold 0; at most ``most`` ids of either label reach
    the driver, as words and counts."""
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(fold() != 0).withColumn("at", F.xxhash64("doc_id")))
    picked = known.where("toxic = 1").orderBy("at").limit(most).union(known.where("toxic = 0").orderBy("at").limit(most))
    # A text reaches the driver as two compact values; the driver keeps each different word once.
    packed = of_text(lambda raw: _packed(words_of(raw)), "words binary, counts array<int>")
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")  # 2 * most rows at most
            .withColumn("packed", packed).select("doc_id", "toxic", "packed.words", "packed.counts").collect())
    rows.sort(key=lambda r: (r.doc_id, r.words))
    seen: dict[bytes, bytes] = {}
    texts = [Counter({seen.setdefault(w, w): n for w, n in zip(bytes(r.words).split(b" "), r.counts)}) for r in rows]
    labels_of = [int(r.toxic) for r in rows]
    del rows, seen
    return fit(texts, labels_of)


def _packed(words: Counter) -> tuple[bytes, list[int]]:
    return b" ".join(words), list(words.values())


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    return score_with(train(docs, labels, most), docs)


def score_with(model: Model, docs: DataFrame) -> DataFrame:
    @F.arrow_udf(returnType="double")
    def score(raw: pa.Array) -> pa.Array:
        out = [model.scores([v.as_py() for v in raw.slice(at, 2000)]) for at in range(0, len(raw), 2000)]
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    s = docs.select("doc_id", (fold() == 0).alias("held_out"), score(F.col("text").cast("binary")).alias("score"))
    return s.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
