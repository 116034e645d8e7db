"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Two words are compared by their common subsequences of three characters: each occurrence
weighs ``DECAY`` to the power of the characters it spans, so letters may be apart, by gaps
or inserted characters, and count less the wider they are. The kernel is normalised and
squared. Landmark words, chosen from the training sample, give each word a finite feature
vector (Nystroem); a sentence is the sum of its different words', so a linear SVM on sentences is a
weight per word. Labels are those of whole documents: a toxic document has at least one toxic sentence,
and training alternates between fitting and picking the sentence that the current
weights find most toxic in each toxic document. A document scores as its most toxic
sentence, mapped to 0..1 by a logistic curve fitted on the sample.

Words are runs of bytes without blanks, ASCII letters lower-cased; words of more than
``WINDOW`` bytes are read in overlapping windows, of which the most toxic counts. Runs of three or more
single characters are also read as one word. Sentences end at ``.``, ``!``, ``?``, line ends
and after ``PIECE`` words.

Fitting takes a bounded sample: ``SAMPLE`` labelled rows at most, half of each label where there
are enough, in order of a hash of the key, none with more than ``SAMPLE_BYTES`` bytes. Scoring reads every row and every whole text.
"""

import pickle
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import mapped, unused, without
from .words import Words, slices, words_of

SAMPLE, SAMPLE_BYTES = 2000, 1 << 14
LANDMARKS, CLEAN_LANDMARKS = 128, 32
#: Toxic landmarks are less alike than this.
ALIKE = 0.4
DECAY, WINDOW, PIECE = 0.75, 16, 24
ROUNDS, COST, RIDGE = 4, 1.0, 1e-3
CACHE = 1 << 20
SLICE = 1 << 20

# Classes of bytes: letters, one for digits, one per low bits of a character's following bytes; others are gaps.
CLASSES = 59
_CLASS = np.full(256, -1, np.int64)
_CLASS[ord("a"):ord("z") + 1] = np.arange(26)
_CLASS[ord("0"):ord("9") + 1] = 26
_CLASS[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 31)
_ENDS = np.zeros(256, bool)
_ENDS[[ord("."), ord("!"), ord("?")]] = True
_TRIPLES = {n: np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3) for n in range(WINDOW + 1)}


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of at most ``WINDOW`` bytes of each word: begin, length, number of the word."""
    sizes = ends - starts
    count = np.maximum(1, -(-(sizes - WINDOW) // (WINDOW // 2)) + 1)
    word = np.repeat(np.arange(len(starts)), count)
    number = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    begin = starts[word] + number * (WINDOW // 2)
    return begin, np.minimum(WINDOW, ends[word] - begin), word


def subsequences(data: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Number (-1: none) and weight of each subsequence of three of some windows of one size."""
    classes = _CLASS[data[begin[:, None] + np.arange(size)]]
    a, b, c = (classes[:, _TRIPLES[size][:, i]] for i in range(3))
    found = (a * CLASSES + b) * CLASSES + c
    found[(a < 0) | (b < 0) | (c < 0)] = -1
    span = _TRIPLES[size][:, 2] - _TRIPLES[size][:, 0] + 1
    return found, (DECAY ** span).astype(np.float32)


def norms(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Length of each window's feature vector; subsequences that repeat add up."""
    order = np.argsort(found, axis=1)
    number = np.take_along_axis(found, order, 1)
    value = np.where(number < 0, 0, weight[order])
    edge = np.ones(found.shape, bool)
    edge[:, 1:] = number[:, 1:] != number[:, :-1]
    at = np.flatnonzero(edge)
    sums = np.add.reduceat(value.ravel(), at) if len(at) else np.zeros(0)
    return np.sqrt(np.bincount(at // found.shape[1], sums.astype(np.float64) ** 2, len(found)))


class Landmarks:
    """Landmark words and their subsequences."""

    def of(self, words: list[bytes]) -> np.ndarray:
        """Kernel of some words with each landmark."""
        ends = np.cumsum([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        return self.kernel(data, np.append(0, ends[:-1]), ends)

    def __init__(self, words: list[bytes]):
        self.words = words
        vectors: list[dict[int, float]] = []
        for word in words:
            data = np.frombuffer(word[:WINDOW], np.uint8)
            found, weight = subsequences(data, np.zeros(1, np.int64), len(data))
            one: dict[int, float] = {}
            for number, value in zip(found[0].tolist(), weight.tolist()):
                if number >= 0:
                    one[number] = one.get(number, 0.0) + value
            length = sum(v * v for v in one.values()) ** 0.5
            vectors.append({n: v / length for n, v in one.items()} if length else {})
        numbers = sorted({n for one in vectors for n in one})
        self.slot = np.zeros(CLASSES ** 3 + 1, np.int32)  # the last entry stands for "none"
        self.slot[numbers] = np.arange(1, len(numbers) + 1)
        self.table = np.zeros((len(numbers) + 1, len(words)), np.float32)
        for j, one in enumerate(vectors):
            for number, value in one.items():
                self.table[self.slot[number], j] = value

    def kernel(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray | None = None):
        """Kernel of each word with each landmark; with ``weights``, their weighted sum per word (best window)."""
        begin, size, word = windows(data, starts, ends)
        width = len(self.words)
        out = np.zeros((len(begin), width), np.float32) if weights is None else np.zeros(len(begin), np.float32)
        for n in range(3, WINDOW + 1):
            rows = np.flatnonzero(size == n)
            step = max(1, (1 << 21) // (len(_TRIPLES[n]) * 8 + width * 4))
            for low in range(0, len(rows), step):
                at = rows[low:low + step]
                found, weight = subsequences(data, begin[at], n)
                slot = self.slot[found]
                hit = np.flatnonzero(slot.any(axis=1))
                if not len(hit):
                    continue
                length = norms(found[hit], weight)
                value = np.zeros((len(hit), width), np.float32)
                for c in np.flatnonzero(slot[hit].any(axis=0)):
                    value += self.table[slot[hit, c]] * weight[c]
                value /= np.maximum(length, 1e-9)[:, None].astype(np.float32)
                value *= value
                out[at[hit]] = value if weights is None else value @ weights
        edge = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
        return np.maximum.reduceat(out, edge, axis=0) if len(edge) else out


def pieces(words: Words) -> np.ndarray:
    """Number of each word's sentence; sentences never cross texts and have at most ``PIECE`` words."""
    n = len(words.hashes)
    opens = np.zeros(n, bool)
    if n:
        opens[words.first[:-1][words.counts > 0]] = True
        breaks = np.cumsum(words.lowered == 0x0A)[words.starts]
        opens[1:] |= (breaks[1:] != breaks[:-1]) | _ENDS[words.lowered[words.ends[:-1] - 1]]
        heads = np.flatnonzero(opens)
        place = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
        opens |= place % PIECE == 0
    return np.cumsum(opens) - 1


def once(piece: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which words are the first of their kind in their sentence: a word counts once, however often it is repeated."""
    first = np.zeros(len(hashes), bool)
    order = np.lexsort([hashes, piece])
    edge = np.ones(len(order), bool)
    edge[1:] = (hashes[order][1:] != hashes[order][:-1]) | (piece[order][1:] != piece[order][:-1])
    first[order[edge]] = True
    return first


def spelled_out(words: Words) -> list[tuple[int, bytes]]:
    """Runs of three or more words of one byte, as (first word, the run without blanks)."""
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    short = (words.ends - words.starts == 1) & (_CLASS[words.lowered[words.starts]] >= 0) if len(text) else np.zeros(0, bool)
    at = np.flatnonzero(short)
    if not len(at):
        return []
    groups = np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(text[at]) > 0)) + 1)
    return [(int(g[0]), words.lowered[words.starts[g]].tobytes()) for g in groups if len(g) >= 3]


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray
    slope: float
    shift: float
    prior: float
    name: str = ""
    cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def of_words(self, words: Words) -> np.ndarray:
        """The weight of each word; distinct words are weighed once, and those of earlier texts are remembered."""
        keys, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        known, values = self.cache.get("known", (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        place = np.searchsorted(known, keys)
        place[place == len(known)] = 0
        old = known[place] == keys if len(known) else np.zeros(len(keys), bool)
        found = np.zeros(len(keys), np.float32)
        found[old] = values[place[old]]
        new = np.flatnonzero(~old)
        if len(new):
            found[new] = self.landmarks.kernel(words.lowered, words.starts[at[new]], words.ends[at[new]], self.weights)
            if len(known) + len(new) > CACHE:
                known, values = known[:0], values[:0]
            known, values = np.concatenate([known, keys[new]]), np.concatenate([values, found[new]])
            order = np.argsort(known)
            self.cache["known"] = known[order], values[order]
        return found[back]

    def decided(self, words: Words) -> np.ndarray:
        """The most toxic sentence of each text; minus infinity without words."""
        n = len(words.counts)
        best = np.full(n, -np.inf)
        if len(words.hashes):
            weight = self.of_words(words)
            piece = pieces(words)
            weight[~once(piece, words.hashes)] = 0
            for first, run in spelled_out(words):
                data = np.frombuffer(run, np.uint8)
                weight[first] += self.landmarks.kernel(data, np.zeros(1, np.int64), np.array([len(data)]), self.weights)[0]
            heads = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            sums = np.add.reduceat(weight, heads)
            np.maximum.at(best, np.searchsorted(words.first, heads, "right") - 1, sums)
        return best

    def score(self, words: Words) -> np.ndarray:
        best = self.decided(words)
        value = self.slope * np.where(np.isfinite(best), best, 0.0) + self.shift
        return np.where(self.slope != 0, 1 / (1 + np.exp(-np.clip(value, -30, 30))), self.prior)


def support_vectors(x: np.ndarray, rows: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear SVM with squared hinge loss on some rows of ``x``, whose last column is the bias: Newton steps.

    Each step solves for the rows inside the margin; rows are read a block at a time.
    """
    n = x.shape[1]
    ridge = np.eye(n)
    ridge[-1, -1] = 1e-6
    active = np.ones(len(rows), bool)
    w = np.zeros(n)
    for _ in range(25):
        left, right = ridge.copy(), np.zeros(n)
        at = np.flatnonzero(active)
        for low in range(0, len(at), 8192):
            some = at[low:low + 8192]
            block = x[rows[some]].astype(np.float64)
            left += block.T @ (block * cost[some, None])
            right += block.T @ (cost[some] * y[some])
        w = np.linalg.solve(left, right)
        now = y * (x @ w.astype(np.float32))[rows] < 1
        if (now == active).all():
            break
        active = now
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through scores, with smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    middle, spread = x.mean(), x.std() or 1.0
    z, w = np.stack([(x - middle) / spread, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (p - target))
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)


def chosen_landmarks(lexicon: list[bytes], positive: np.ndarray, negative: np.ndarray, n_positive: int, n_negative: int,
                     toxic: int = LANDMARKS, clean: int = CLEAN_LANDMARKS) -> list[bytes]:
    """Words with the largest gain in toxic against clean documents, and the most common others."""
    total, share = positive + negative, n_positive / (n_positive + n_negative)
    expected = total * share
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(positive > 0, positive * np.log(positive / expected), 0) + np.where(
            negative > 0, negative * np.log(negative / (total - expected)), 0)
    gain = np.where(positive > expected, gain, -1)
    long_enough = np.array([(_CLASS[np.frombuffer(w[:WINDOW], np.uint8)] >= 0).sum() >= 3 for w in lexicon])
    order = sorted(np.flatnonzero((gain > 0) & long_enough).tolist(), key=lambda i: (-gain[i], lexicon[i]))
    # words much like one that is taken already add little
    taken, few = [], [lexicon[i] for i in order[:8 * toxic]]
    alike = Landmarks(few).of(few) > ALIKE if few else np.zeros((0, 0), bool)
    open_words = np.ones(len(few), bool)
    for i, word in enumerate(few):
        if open_words[i] and len(taken) < toxic:
            taken.append(word)
            open_words &= ~alike[i]
    rest = sorted(np.flatnonzero((gain <= 0) & long_enough).tolist(), key=lambda i: (-total[i], lexicon[i]))
    return taken + [lexicon[i] for i in rest[:clean]]


def fitted(texts: list[str], labels: list[int], name: str = "") -> Model:
    """Fit on a bounded sample of texts and their labels (1: toxic)."""
    y = np.array(labels)
    rows, word_hashes, spans, piece_of, lowered, at = [], [], [], [], [], 0
    for top, _, data, offsets in slices(pa.array(texts, pa.string())):
        words = words_of(data, offsets)
        rows.append(np.repeat(np.arange(len(words.counts)), words.counts) + top)
        word_hashes.append(words.hashes)
        spans.append(np.stack([words.starts, words.ends], 1) + sum(len(x) for x in lowered))
        piece_of.append(pieces(words) + at)
        at += int(piece_of[-1][-1]) + 1 if len(piece_of[-1]) else 0
        lowered.append(words.lowered)
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    hashes = np.concatenate(word_hashes) if word_hashes else np.zeros(0, np.uint64)
    if not n1 or not n0 or not len(hashes):
        return Model(Landmarks([]), np.zeros(0, np.float32), 0.0, 0.0, 1.0 if n1 > n0 else 0.0, name)
    data, row, piece = np.concatenate(lowered), np.concatenate(rows), np.concatenate(piece_of)
    span = np.concatenate(spans)
    first = once(piece, hashes)
    hashes, row, piece, span = hashes[first], row[first], piece[first], span[first]
    keys, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    lexicon = [data[a:b].tobytes() for a, b in span[first]]
    pairs = np.unique(row * len(keys) + word)
    positive = np.bincount(pairs % len(keys), y[pairs // len(keys)] == 1, len(keys))
    negative = np.bincount(pairs % len(keys), y[pairs // len(keys)] == 0, len(keys))
    landmarks = Landmarks(chosen_landmarks(lexicon, positive, negative, n1, n0))
    among = landmarks.of([w[:WINDOW] for w in landmarks.words]).astype(np.float64)
    value, vector = np.linalg.eigh((among + among.T) / 2 + RIDGE * np.eye(len(among)))
    root = (vector / np.sqrt(np.maximum(value, RIDGE))) @ vector.T
    heads = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    of_piece = row[heads]
    sentence, n = np.cumsum(np.append(True, piece[1:] != piece[:-1])) - 1, len(heads)
    x = np.zeros((n, len(root) + 1), np.float32)
    x[:, -1] = 1
    by_word = np.argsort(word, kind="stable")
    for low in range(0, len(keys), 1 << 14):
        some = by_word[slice(*np.searchsorted(word[by_word], (low, low + (1 << 14))))]
        at = first[low:low + (1 << 14)]
        kernel = landmarks.kernel(data, span[at, 0], span[at, 1])
        for j in range(len(root)):
            x[:, j] += np.bincount(sentence[some], kernel[word[some] - low, j], n)
    for low in range(0, n, 8192):
        x[low:low + 8192, :-1] = x[low:low + 8192, :-1] @ root
    odds = np.log((positive + 0.5) / (n1 + 1)) - np.log((negative + 0.5) / (n0 + 1))
    current = np.add.reduceat(np.maximum(odds, 0)[word], heads)
    clean = np.flatnonzero(y[of_piece] == 0)
    for _ in range(ROUNDS):
        order = np.lexsort([current, of_piece])
        last = order[np.append(of_piece[order][1:] != of_piece[order][:-1], True)]
        toxic = last[y[of_piece[last]] == 1]
        used = np.concatenate([toxic, clean])
        sign = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
        cost = COST * np.where(sign > 0, max(1.0, len(clean) / max(1, len(toxic)) / 4), 1.0)
        w = support_vectors(x, used, sign, cost)
        current = x @ w - w[-1]
    weights = (root @ w[:-1]).astype(np.float32)
    best = np.full(len(y), -np.inf)
    np.maximum.at(best, of_piece, current)
    some = np.isfinite(best)
    slope, shift = logistic(best[some], y[some])
    return Model(landmarks, weights, max(slope, 1e-6), shift, n1 / (n1 + n0), name)


def sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, size: int = SAMPLE) -> DataFrame:
    """The bounded training sample ``(_text, _label)``."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    parts = [known.where(F.col("_label") == v).orderBy(F.xxhash64(key), key).limit(size // 2) for v in (0, 1)]
    ids = parts[0].unionAll(parts[1])
    return (docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
            .where(F.octet_length("_text") <= SAMPLE_BYTES).join(F.broadcast(ids), key)
            .orderBy(key, "_text").select("_text", F.col("_label").cast("int")).limit(2 * size))


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
            size: int = SAMPLE) -> Model:
    """Fit on labelled rows; several labels of a key count as the largest, labels other than 0 and 1 are left out.

    Without rows of both labels every text scores 1 if only toxic ones are known, else 0. The sample is bounded, so one
    task of an executor fits it, and the driver sees the model alone.
    """
    def run(batches):
        texts, given = [], []
        for batch in batches:
            texts.extend(batch.column(0).to_pylist())
            given.extend(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted(texts, given))], pa.binary())], names=["model"])

    found = sample(docs, labels, text, key, label, size).coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else fitted([], [])


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, in place of a column of that name.

    Null, empty and wordless texts score as a sentence without weight.
    """
    docs = without(docs, score)
    held = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select("*", F.col(text).cast("string").alias("_scored"))
    schema = docs.select("*", F.lit(0.0).alias(score)).schema

    def run(batches):
        for batch in batches:
            found = [held.value.score(words_of(data, offsets))
                     for _, _, data, offsets in slices(batch.column(batch.num_columns - 1), SLICE)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(found) if found else np.zeros(0))], names=schema.names)

    return mapped(given, run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``; all columns stay."""
    model = trained(docs, labels, text, key)
    found = scored(docs.select("*", F.lit(0).alias(free := unused(docs))), model, text, free)
    return found.where(F.col(free) < limit).drop(free)
