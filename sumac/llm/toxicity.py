"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sumac.llm.texts import id_and_text, map_texts

#: Feature space of hashed letter triples, and the gaps a triple may have with their decay per skipped letter.
SPACE, DECAY = 1 << 16, 0.6
GAPS = [(1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1)]
#: Longer words are judged by overlapping pieces of this many letters.
PIECE = 40
FLOOR = -2.0
REMEMBERED = 300_000
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»„“”‘’…–—"
#: Letters written one by one, as in "i d i o t".
_SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")


def tokens(text: str) -> list[str]:
    """Lower-case words as written, and words spelled with spaced letters put together."""
    lower = text.lower()
    return lower.split() + ["".join(m.group().split()) for m in _SPACED.finditer(lower)]


def _matrix(words: list[str], width: int) -> np.ndarray:
    joined = "".join(("^" + w).ljust(width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)


def _triples(codes: np.ndarray):
    """(features, weights) of every gapped letter triple; padding weighs nothing."""
    for d1, d2 in GAPS:
        n = codes.shape[1] - d1 - d2
        if n > 0:
            a, b, c = codes[:, :n], codes[:, d1 : d1 + n], codes[:, d1 + d2 : d1 + d2 + n]
            mixed = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield (mixed >> np.uint32(16)).astype(np.int64) % SPACE, (c != 0) * np.float32(DECAY ** (d1 + d2 - 2))


def _pieces(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Stripped words in pieces of at most PIECE letters, and the word of each piece."""
    out, owner = [], []
    for k, word in enumerate(words):
        word = word.strip(_EDGES).replace("\0", "")
        for at in range(0, max(1, len(word) - PIECE // 2), PIECE // 2) if len(word) > PIECE else (0,):
            out.append(word[at : at + PIECE])
            owner.append(k)
    return out, np.array(owner, np.int64)


def _by_width(words: list[str]):
    widths = np.array([(len(w) + 1 + 7) // 8 * 8 for w in words], np.int64)
    for width in np.unique(widths):
        members = np.flatnonzero(widths == width)
        for at in range(0, len(members), 1 << 14):
            part = members[at : at + (1 << 14)]
            yield part, _matrix([words[k] for k in part.tolist()], int(width))


def kernel_vectors(words: list[str]) -> np.ndarray:
    """The unit vectors whose inner products are the subsequence kernel."""
    pieces = [w.strip(_EDGES)[:PIECE] for w in words]
    out = np.zeros((len(words), SPACE), np.float32)
    for members, codes in _by_width(pieces):
        for features, weights in _triples(codes):
            np.add.at(out, (np.repeat(members, features.shape[1]), features.ravel()), weights.ravel())
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-6)


@dataclass
class WordScorer:
    """Margins of words: the machine's expansion over its landmarks, summed into one vector."""

    weights: np.ndarray
    bias: float

    def __call__(self, words: list[str]) -> np.ndarray:
        pieces, owner = _pieces(words)
        found = np.zeros(len(pieces), np.float32)
        for members, codes in _by_width(pieces):
            raw, norm = np.zeros(len(members), np.float32), np.zeros(len(members), np.float32)
            for features, weights in _triples(codes):
                raw += (self.weights[features] * weights).sum(axis=1)
                norm += (weights * weights).sum(axis=1)
            found[members] = raw / np.maximum(np.sqrt(norm), 1e-6)
        out = np.full(len(words), -np.inf, np.float32)
        np.maximum.at(out, owner, found + np.float32(self.bias))
        return out


def _squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of a linear machine (last one the bias) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(20):
        open_ = y * (x @ w) < 1
        a, c = x[open_], cost[open_][:, None]
        new = np.linalg.solve(ridge + a.T @ (a * c), a.T @ (y[open_] * cost[open_]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit_words(toxic: list[list[str]], clean: list[list[str]], landmarks: int = 160, rounds: int = 3, seed: int = 7) -> WordScorer | None:
    """A scorer of words from labelled token lists, None without a word that tells them apart.

    Landmarks are the words that most significantly mark toxic texts and some of the clean
    ones. Each round the words of highest margin in toxic texts join the positive examples and those in
    clean texts the negative ones.
    """
    bare = {w: sys.intern(w.strip(_EDGES)) for t in (*toxic, *clean) for w in t}
    sets1, sets0 = ([{bare[w] for w in t} - {""} for t in texts] for texts in (toxic, clean))
    in1, in0 = Counter(w for s in sets1 for w in s), Counter(w for s in sets0 for w in s)
    n1, n0 = len(sets1), len(sets0)
    if not n1 or not n0:
        return None

    def z(word: str) -> float:
        a, b = in1[word], in0[word]
        p = (a + b + 1) / (n1 + n0 + 2)
        return (a / n1 - b / n0) / (p * (1 - p) * (1 / n1 + 1 / n0)) ** 0.5

    seeds = sorted(((z(w), w) for w, n in in1.items() if n >= 2 and len(w) > 2), reverse=True)
    seeds = [w for s, w in seeds[: landmarks * 5 // 8] if s > 3.3]
    if not seeds:
        return None
    rng = np.random.default_rng(seed)
    plain = sorted(w for w in in0 if len(w) > 2)
    some = [plain[k] for k in rng.permutation(len(plain))[:6000]]
    base = kernel_vectors([*seeds, *some[: landmarks - len(seeds)]])
    values, vectors = np.linalg.eigh(base @ base.T)
    good = values > 1e-4
    root = vectors[:, good] / np.sqrt(values[good])  # landmarks -> Nystroem coordinates

    def fit(good_words: list[str], bad_words: list[str]) -> WordScorer:
        words = [*good_words, *bad_words]
        x = np.concatenate([kernel_vectors(words[k : k + 64]) @ base.T for k in range(0, len(words), 64)]) @ root
        y = np.array([1.0] * len(good_words) + [-1.0] * len(bad_words))
        cost = np.where(y > 0, 20.0 * max(1, len(bad_words) / len(good_words)) ** 0.5, 20.0)
        w = _squared_hinge(x, y, cost)
        return WordScorer((base.T @ (root @ w[:-1])).astype(np.float32), float(w[-1]))

    scorer = fit(seeds, some[:3000])
    all1, all0 = sorted(w for w in in1 if w not in in0), sorted(in0)
    for _ in range(rounds):
        margins = dict(zip(all1, scorer(all1).tolist()))
        witnesses: Counter = Counter()
        for s in sets1:
            ranked = sorted(((margins[w], w) for w in s if w in margins), reverse=True)[:3]
            witnesses.update(w for m, w in ranked if m > 0)
        good_words = sorted(set(seeds) | {w for w, _ in witnesses.most_common(1500)})
        hard = scorer(all0)
        worst = [all0[k] for k in np.argsort(-hard, kind="stable")[:2000]]
        scorer = fit(good_words, [*worst, *some[:2000]])
    return scorer


def features(margins: np.ndarray) -> np.ndarray:
    """What a text's word margins come to: the largest, the mean of the largest three, and how many are positive."""
    top = np.full(3, FLOOR)
    if len(margins):
        best = np.sort(np.partition(margins, len(margins) - min(3, len(margins)))[-3:])[::-1]
        top[: len(best)] = np.maximum(best, FLOOR)
    return np.array([top[0], top.mean(), np.log1p((margins > 0).sum())])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ ((y - p) * weight) - 0.05 * w
        curve = (x * (p * (1 - p) * weight)[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    """A fitted scorer; without a word scorer every text gets the share of toxic labels."""

    words: WordScorer | None
    outer: np.ndarray
    share: float

    def scores(self, texts: list[str], cache: dict[str, float]) -> np.ndarray:
        if self.words is None:
            return np.full(len(texts), self.share)
        if len(cache) > REMEMBERED:
            cache.clear()
        lists = [tokens(t) for t in texts]
        fresh = list(set().union(*lists).difference(cache)) if lists else []
        cache.update(zip(fresh, self.words(fresh).tolist()))
        look = cache.__getitem__
        x = np.array([features(np.fromiter(map(look, t), np.float64, len(t))) for t in lists]).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ self.outer, -30, 30)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = 2000,
    longest: int = 32_768,
) -> ToxicityModel:
    """Learns from at most ``per_class`` labelled texts of each class, of at most ``longest`` bytes each.

    The sample is the least by a hash of the id among labelled documents for which ``train`` (an
    expression over doc_id) holds. Of an id labelled twice the larger label counts, of one with
    several texts the least; null labels, ids and texts are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("bad"))
    if train is not None:
        known = known.filter(train)
    counts = {r["bad"]: r["n"] for r in known.groupBy("bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = docs.filter(F.col(text_col).isNotNull() & (F.octet_length(text_col) <= longest)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    usable = known.join(sizes.select("doc_id"), "doc_id", "left_semi")
    picked = [usable.filter(F.col("bad") == bad).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for bad in (True, False)]
    # At most 2 * per_class rows of two columns.
    chosen = sizes.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    rows = chosen.groupBy("doc_id", "bad").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    shared: dict[str, str] = {}  # one object per distinct word
    lists = [([shared.setdefault(w, w) for w in tokens(r["text"])], r["bad"]) for r in rows]
    total = max(1, sum(counts.values()))
    share = (counts.get(True, 0) + 0.5) / (total + 1)
    words = fit_words([t for t, bad in lists if bad], [t for t, bad in lists if not bad])
    if words is None:
        return ToxicityModel(None, np.zeros(4), share)
    cache: dict[str, float] = {}
    x = []
    for t, _ in lists:
        fresh = list(set(t).difference(cache))
        cache.update(zip(fresh, words(fresh).tolist()))
        x.append(features(np.array([cache[w] for w in t])))
    y = np.array([float(bad) for _, bad in lists])
    sampled = {True: y.sum(), False: len(y) - y.sum()}
    weight = np.array([counts[bool(v)] / sampled[bool(v)] for v in y])
    return ToxicityModel(words, _logistic(np.array(x), y, weight / weight.mean()), share)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) with a score from 0 to 1 for every document.

    Null and empty texts count as texts without words; rows without an id are left
    out; repeated rows are scored each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        cache: dict[str, float] = {}

        def work(batch):
            texts = [t.as_py().decode("utf-8", "replace") for t in batch.column("text")]
            return {"doc_id": batch.column("doc_id"), "score": pa.array(shared.value.scores(texts, cache), pa.float64())}

        return work

    return map_texts(id_and_text(docs, id_col, text_col), "doc_id long, score double", make)


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col: str = "text", below: float = 0.5) -> DataFrame:
    """The rows, all columns as they are, whose text scores below ``below``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for texts in batches:
            parts = [shared.value.scores(texts[at : at + 1000].fillna("").tolist(), cache) for at in range(0, len(texts), 1000)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.filter(scores(F.col(text_col)) < below)
