"""Toxicity by a support vector machine over gapped-subsequence kernels to landmark words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import text_of, written

#: Stands before each word, so that kernels tell its beginning from its middle.
START = "^"
NOT_LETTERS = re.compile(r"[\W_]+")
LOOSE = re.compile(r"(?:(?<=\s)|^)(?:\w(?:[^\w\s]|_)*+\s++){2,}\w(?=(?:[^\w\s]|_)*+(?:\s|$))")
#: A word repeated in a passage counts this many times at most, so that junk of one word adds up to nothing.
REPEATS = 2
#: Words are read in windows of this many characters, STRIDE apart.
WINDOW, STRIDE = 8, 3
#: More characters than any word has.
FAR = 1 << 30


def letters(token: str) -> str:
    """START and a token without what is no letter or digit."""
    return START + (token if token.isalnum() else NOT_LETTERS.sub("", token))


def windows_of(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW + STRIDE, STRIDE)]


def pieces_of(word: str) -> set[str]:
    """What may become a landmark: the word's windows and shorter parts."""
    return {word[i : i + n] for n in (5, 6, 7) for i in range(len(word) - n + 1)} | set(windows_of(word))


def codes(words: list[str]) -> np.ndarray:
    """Code points, a row per word, 0 past its end."""
    width = max(map(len, words), default=1)
    text = "".join(w.ljust(width, "\0") for w in words)
    return np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(words), width)


def pair_slots(chars: np.ndarray, slots: int = 4096) -> np.ndarray:
    """Hashed pairs of characters at most two apart, a row per word; 0 where there is none."""
    columns = []
    for gap in (1, 2):
        a, b = chars[:, :-gap].astype(np.int64), chars[:, gap:].astype(np.int64)
        columns.append(np.where(b > 0, (a * 2654435761 + b * 40503) % (slots - 1) + 1, 0))
    return np.concatenate(columns, axis=1)


def subsequence_kernel(s: np.ndarray, t: np.ndarray, order: int = 3, decay: float = 0.6) -> np.ndarray:
    """Gap-weighted subsequence kernel of rows of s and t: common subsequences of `order`
    characters, each weighted by decay to the number of characters they span in both."""
    n, length_s, length_t = len(s), s.shape[1], t.shape[1]
    same = (s[:, :, None] == t[:, None, :]) & (s[:, :, None] > 0)
    prefix = np.ones((length_s + 1, length_t + 1, n))
    for _ in range(order - 1):
        new = np.zeros_like(prefix)
        for j in range(1, length_s + 1):
            row = np.zeros(n)
            for k in range(1, length_t + 1):
                row = decay * row + decay * decay * np.where(same[:, j - 1, k - 1], prefix[j - 1, k - 1], 0.0)
                new[j, k] = decay * new[j - 1, k] + row
        prefix = new
    total = np.zeros(n)
    for j in range(length_s):
        for k in range(length_t):
            total += decay * decay * np.where(same[:, j, k], prefix[j, k], 0.0)
    return total


def similarity(s: np.ndarray, t: np.ndarray, own_s: np.ndarray, own_t: np.ndarray, power: int = 2) -> np.ndarray:
    """The kernel, 1 for equal words, to a power: again a kernel, and one that sets near words farther apart."""
    return np.minimum(subsequence_kernel(s, t) / np.sqrt(np.maximum(own_s * own_t, 1e-300)), 1.0) ** power


def inserted(chars: np.ndarray, mark: str) -> np.ndarray:
    """Per row the fewest characters between those of `mark`, found in order anywhere in the word; FAR if they are not.

    A START the word does not begin with counts as one character.
    """
    n, width = chars.shape
    place = np.arange(width, dtype=np.int32)
    cost = np.where(chars == ord(mark[0]), 0, FAR).astype(np.int32)
    for k, letter in enumerate(mark[1:]):
        before = np.minimum.accumulate(cost - place, axis=1)
        fewest = np.full((n, width), FAR, np.int32)
        fewest[:, 1:] = before[:, :-1] + place[1:] - 1
        if k == 0 and mark[0] == START:
            fewest = np.minimum(fewest, 1)
        cost = np.where(chars == ord(letter), np.minimum(fewest, FAR), FAR)
    return cost.min(axis=1)


@dataclass
class Landmarks:
    """Pieces of words others are compared with.

    Kernel values of windows below `least` count as 0. A word with all of a
    landmark's characters in order also has `stretch` to the number of
    characters inserted per gap, however long the stretch; below `faint` that
    counts as 0. Chance puts any characters in order in a word that is long
    enough, at more places and with fewer between them the longer it is; beyond
    `long` characters the value falls with the fifth power of the length.
    """

    words: list[str]
    least: float = 0.35
    chunk: int = 8000
    stretch: float = 0.8
    faint: float = 0.1
    long: int = 33

    def __post_init__(self) -> None:
        self.chars = codes(self.words)
        self.own = subsequence_kernel(self.chars, self.chars)
        slots = pair_slots(self.chars)
        self.has = np.zeros((4096, len(self.words)), np.uint8)
        for mark, row in enumerate(slots):
            self.has[row, mark] = 1
        self.has[0] = 0
        self.needed = np.ceil(0.5 * self.has.sum(axis=0)).astype(np.uint8)

    def kernels(self, words: list[str]) -> dict[int, list[tuple[int, float]]]:
        """For positions of words near some landmark: (landmark, largest kernel of a window or of the word stretched).

        A window with less than half of a landmark's pairs of near characters
        has few of its subsequences of three; its kernel counts as 0.
        """
        near: dict[int, dict[int, float]] = {}
        owners, pieces = [], []
        for i, word in enumerate(words):
            for piece in windows_of(word):
                owners.append(i)
                pieces.append(piece)
        for at in range(0, len(pieces), self.chunk):
            chars = codes(pieces[at : at + self.chunk])
            if chars.shape[1] < 3:
                continue
            shared = np.zeros((len(chars), len(self.words)), np.uint8)
            for column in pair_slots(chars).T:
                shared += self.has[column]
            i, m = np.nonzero(shared >= self.needed)
            for a in range(0, len(i), 4000):
                rows, marks = i[a : a + 4000], m[a : a + 4000]
                s = chars[rows]
                values = similarity(s, self.chars[marks], subsequence_kernel(s, s), self.own[marks])
                for k in np.flatnonzero(values >= self.least):
                    best = near.setdefault(owners[at + rows[k]], {})
                    mark = int(marks[k])
                    best[mark] = max(best.get(mark, 0.0), float(min(values[k], 1.0)))
        for i, mark, value in self.stretched(words):
            best = near.setdefault(i, {})
            best[mark] = max(best.get(mark, 0.0), value)
        return {i: list(best.items()) for i, best in near.items()}


    def stretched(self, words: list[str]) -> Iterator[tuple[int, int, float]]:
        """(position, landmark, value) of words with all characters of a landmark in order."""
        order = sorted((i for i, word in enumerate(words) if len(word) > 3), key=lambda i: len(words[i]))
        needs = [sum({1 << (ord(c) & 63) for c in mark if c != START}) for mark in self.words]
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at) * len(words[order[end]]) < self.chunk * 16:
                end += 1
            own = np.array(order[at:end])
            chars = codes([words[i] for i in own])
            held = np.bitwise_or.reduce(np.left_shift(np.uint64(1), (chars & 63).astype(np.uint64)), axis=1)
            for m, (mark, need) in enumerate(zip(self.words, needs)):
                rows = np.flatnonzero((held & np.uint64(need)) == need)
                if rows.size == 0:
                    continue
                gaps = inserted(chars[rows], mark)
                lengths = (chars[rows] > 0).sum(axis=1)
                values = self.stretch ** (gaps / (len(mark) - 1)) * np.minimum(1, self.long / lengths) ** 5
                for k in np.flatnonzero((gaps < FAR) & (values >= self.faint)):
                    yield int(own[rows[k]]), m, float(values[k])
            at = end


@dataclass
class ToxicityModel:
    """Kernel to landmarks, Nystrom map and hyperplane in one vector, logistic calibration."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    span: int
    slope: float
    shift: float

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


class WordCache:
    """Kernels of the tokens seen so far in this worker, for at most `room` tokens."""

    def __init__(self, landmarks: Landmarks, room: int = 200_000) -> None:
        self.landmarks, self.room = landmarks, room
        self.seen: set[str] = set()
        self.near: dict[str, list[tuple[int, float]]] = {}

    def learn(self, tokens: set[str]) -> None:
        if len(self.seen) + len(tokens) > self.room:
            self.seen, self.near = set(), {}
        new = list(tokens - self.seen)
        self.seen.update(new)
        for i, kernels in self.landmarks.kernels([letters(t) for t in new]).items():
            self.near[new[i]] = kernels


def passages(texts: list[str], cache: WordCache, together: int = 256) -> Iterator[list[tuple[int, str]]]:
    """Per text its tokens near a landmark, as (number of the token, token).

    Letters set apart by blanks are read as one token.
    """
    for at in range(0, len(texts), together):
        split = [LOOSE.sub(lambda m: NOT_LETTERS.sub("", m[0]), text.lower()).split() for text in texts[at : at + together]]
        own = [set(tokens) for tokens in split]
        cache.learn(set().union(*own))
        near = cache.near
        for tokens, distinct in zip(split, own):
            hits = near.keys() & distinct
            yield [(i, token) for i, token in enumerate(tokens) if token in hits] if hits else []


def best_passage(hits: list[tuple[int, str]], worth: dict[str, float], span: int) -> tuple[float, int, int]:
    """Largest sum of the worth of hits[i:j] within `span` tokens, with i and j; a token counts REPEATS times at most."""
    best, total, first = (0.0, 0, 0), 0.0, 0
    held: Counter[str] = Counter()
    for j, (at, token) in enumerate(hits):
        held[token] += 1
        if held[token] <= REPEATS:
            total += worth[token]
        while hits[first][0] <= at - span:
            gone = hits[first][1]
            held[gone] -= 1
            if held[gone] < REPEATS:
                total -= worth[gone]
            first += 1
        if total > best[0]:
            best = (total, first, j + 1)
    return best


def fit_svm(x: np.ndarray, y: np.ndarray, landmarks: Landmarks, span: int, prior: float = 0.5, ridge: float = 1e-2, penalty: float = 1e-3, rounds: int = 300) -> ToxicityModel:
    """Linear machine, squared hinge loss and both classes weighted alike, on Nystrom features.

    Scores are calibrated for classes as frequent as `prior`, the share of toxic documents, says.
    """
    m = len(landmarks.words)
    a, b = np.repeat(np.arange(m), m), np.tile(np.arange(m), m)
    gram = similarity(landmarks.chars[a], landmarks.chars[b], landmarks.own[a], landmarks.own[b]).reshape(m, m)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    nystrom = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0) + ridge)) @ vectors.T
    features = x @ nystrom
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    w, bias = np.zeros(m), 0.0
    # the loss is convex with a Lipschitz gradient: accelerated descent with a fixed step
    step = 1 / (2 * (share[:, None] * features * features).sum() + 2 + penalty)
    look, look_bias = w.copy(), bias
    for k in range(rounds * 10):
        slack = np.maximum(0, 1 - sign * (features @ look + look_bias)) * share * sign
        new = look - step * (penalty * look - 2 * features.T @ slack)
        new_bias = look_bias + step * 2 * slack.sum()
        momentum = k / (k + 3)
        look, look_bias = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias = new, new_bias
    margins = features @ w + bias
    if not (0 < (y > 0).sum() < len(y)):
        return ToxicityModel(landmarks, np.zeros(m), 0.0, span, 0.0, float(np.log(prior / (1 - prior))))
    slope, shift = 1.0, 0.0
    share = share * np.where(y > 0, prior, 1 - prior) * 2
    for _ in range(4000):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        error = (p - (y > 0)) * share
        slope, shift = slope - (error * margins).sum(), shift - error.sum()
    return ToxicityModel(landmarks, nystrom @ w, float(bias), span, float(slope), float(shift))


def held_out_fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 3000,
    n_landmarks: int = 64,
    candidates: int = 2000,
    least_lift: float = 0.01,
    span: int = 100,
) -> ToxicityModel:
    """A model from at most `sample_rows` labelled documents of each class, taken by hash of the id, none of the held-out fold.

    Landmarks are the pieces of words that most tell the classes apart by the
    share of documents with them (toxic less 4 times the others', at least
    `least_lift`), no two with four characters in common. A passage is `span` words; its kernel to a
    landmark is the sum over its words, each twice at most. Each document gives the passage nearest
    the landmarks; only vectors over the landmarks and `candidates` pieces reach
    the driver. Unlabelled rows and null ids are not
    learned from. Without labelled documents of both classes every score is the
    share of toxic ones among them, 0.001 at least and without any.
    """
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out_fold("doc_id")).dropDuplicates(["doc_id"])
    frequency = ids.agg(F.avg((F.col("y") > 0).cast("double"))).first()[0]
    prior = min(max(frequency or 0.0, 1e-3), 0.999)
    order = F.xxhash64(F.lit(8), "doc_id")
    chosen = ids.where("y > 0").orderBy(order).limit(sample_rows).unionByName(ids.where("y <= 0").orderBy(order).limit(sample_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sample = written(texts.join(F.broadcast(chosen), "doc_id"), "sample")  # at most 2 * sample_rows ids

    def vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad: Counter[str] = Counter()
            good: Counter[str] = Counter()
            for y, text in zip(batch["y"], batch["text"]):
                words = {letters(token) for token in text.lower().split()}
                (bad if y > 0 else good).update(set().union(*map(pieces_of, words)))
            rows = [(piece, bad[piece], good[piece]) for piece in bad.keys() | good.keys() if len(piece) > 4]
            yield pd.DataFrame(rows, columns=["piece", "bad", "good"])

    n = {r["bad"]: r["count"] for r in sample.groupBy((F.col("y") > 0).alias("bad")).count().collect()}
    n_bad, n_good = max(1, n.get(True, 0)), max(1, n.get(False, 0))
    lift = F.col("bad") / n_bad - 4 * F.col("good") / n_good
    best = (
        sample.mapInPandas(vocabulary, "piece string, bad long, good long")
        .groupBy("piece")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where((F.col("bad") >= 2) & (lift >= least_lift))
        .orderBy(lift.desc(), F.length("piece").desc(), "piece")
        .limit(candidates)
        .collect()
    )
    picked: list[str] = []
    covered: set[str] = set()
    for row in best:
        if len(picked) == n_landmarks:
            break
        parts = {row["piece"][i : i + 4] for i in range(len(row["piece"]) - 3)}
        if parts.isdisjoint(covered):
            picked.append(row["piece"])
            covered |= parts
    landmarks = Landmarks(picked or ["\1\1\1"])
    m = len(landmarks.words)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordCache(landmarks)
        for batch in batches:
            out = []
            for doc_id, y, hits in zip(batch["doc_id"], batch["y"], passages(list(batch["text"]), cache)):
                worth = {token: max(value for _, value in cache.near[token]) for _, token in hits}
                _, i, j = best_passage(hits, worth, span)
                x = np.zeros(m)
                for token, times in Counter(token for _, token in hits[i:j]).items():
                    for mark, value in cache.near[token]:
                        x[mark] += value * min(times, REPEATS)
                out.append((doc_id, int(y > 0), x))
            yield pd.DataFrame(out, columns=["doc_id", "y", "x"])

    rows = sample.mapInPandas(vectors, "doc_id long, y int, x array<double>").orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), m)
    return fit_svm(x, np.array([r["y"] for r in rows]), landmarks, span, prior)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (score >= 0.5): the score of the document's worst passage.

    Every passage of the whole text is scored; a text without a word near a
    landmark has the score of no evidence, as null and empty texts have. Rows
    are scored each by itself; other columns pass through, ones named score or
    predicted are replaced. No shuffle.
    """

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = WordCache(model.landmarks)
        for batch in batches:
            margins = np.full(len(batch), model.bias)
            for i, hits in enumerate(passages(list(batch), cache)):
                worth = {token: sum(model.weights[k] * v for k, v in cache.near[token]) for _, token in hits}
                margins[i] += best_passage(hits, worth, model.span)[0]
            yield pd.Series(model.probability(margins))

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*rest, scores(text_of(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    model = train_toxicity(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return score_toxicity(rows, model).where("predicted = 0").select("row.*")
