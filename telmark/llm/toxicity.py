"""Operator 5: toxicity by weak supervision.

Voters look at a whole text and vote toxic, clean or nothing: a fixed lexicon of insults,
lexicons of words and of word beginnings mined from the labelled training rows, patterns of their hits (a vote each for
share, variety and repetition), and patterns that know no lexicon: shouting, runs of exclamation, masked
letters, and address of the reader. A generative label model is
fitted by expectation maximisation to the histogram of vote patterns over all documents: each
voter's accuracies by class, the class balance, and the voters' correlations given the class, by which the
evidence of voters that agree beyond what the classes explain is divided among them. A linear (logistic) classifier over the rates of
mined features is then trained on the model's posterior labels of the training sample, and
scores every text.

The training sample is bounded by ``SAMPLE_ROWS`` labelled documents, and with it what is mined from it; the vote
histogram has at most 3 ** voters rows and counts all documents.

Defined results: null and empty texts and texts without words have no features and score by
the intercept. Without labelled training rows of both classes the fixed lexicon alone is used. Repeated rows are
scored each; of rows that repeat a labelled doc_id one, with the smallest hash of its text, is trained on, and a
document labelled both ways counts as toxic. Very long texts are scored whole, in chunks of rows. An empty table gives an empty
result. Labels, lang, source and doc_id are no inputs of a score. ``score`` keeps all columns but one that has the name of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import durable
from telmark.llm.text_hash import chunks, span_hash, string_buffers, word_spans

SAMPLE_ROWS = 30_000
MIN_SUPPORT = 4
# Common insults and abuse, by language.
INSULTS = (
    "arsehole asshole bastard bitch clown crap cretin cunt degenerate despicable dickhead disgusting dumbass filth fool "
    "fucker fucking garbage hate idiot imbecile kill losers loser lowlife maggot moron motherfucker pathetic pig pigs prick rat scum "
    "scumbag shit shithead shut slut stupid subhuman trash ugly useless vermin whore worthless "
    "abschaum arschloch blödmann dreckig dumm hurensohn idiotin missgeburt schlampe trottel wichser "
    "abruti connard connasse débile ordure pourriture salaud salope "
    "asqueroso basura cabrón escoria estúpido gilipollas imbécil inútil mierda pendejo"
).split()
#: Kinds of features: bytes of a word's beginning, 0 for the whole word.
KINDS = (0, 4, 5, 6, 8)
VOTERS = ("insults", "words", "begin_4", "begin_5", "begin_6", "begin_8", "variety", "share", "repeats", "shouting", "exclaiming", "masking", "addressing")
# Words that address the reader, by language.
ADDRESS = "you your yours yourself you're du dich dir dein deine tu toi ton ta vous votre te ti tú tus usted ustedes".split()
MASK = np.zeros(256, bool)
MASK[[33, 35, 36, 42, 64]] = True
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = False


def _word_hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return _tagged(span_hash(data, np.r_[0, ends[:-1]], ends), 0)


def _tagged(h: np.ndarray, kind: int) -> np.ndarray:
    return h ^ np.uint64((KINDS.index(kind) + 1) * 0x9E3779B97F4A7C15 % 2**64)


def _features(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Row ranges with each word's row and feature hashes by kind, words per row, and signs of style per row.

    Signs: letters in upper case, all letters, exclamation marks that follow one, letters masked by a sign, words of address.
    """
    address = np.sort(_word_hash(ADDRESS))
    offsets, raw = string_buffers(batch.column("text"))
    for i, j in chunks(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        data, rows = raw[lo:hi], offsets[i : j + 1] - lo
        s, e, r = word_spans(data, rows, BREAK)
        kinds = []
        for k in KINDS:
            h = span_hash(data, s, e if k == 0 else np.minimum(s + k, e))
            # A word no longer than the beginning is the whole-word feature already.
            kinds.append(_tagged(h, k) if k == 0 else np.where(e - s > k, _tagged(h, k), np.uint64(0)))
        upper = (data >= 65) & (data <= 90)
        letter = upper | ((data >= 97) & (data <= 122))
        count = lambda m: np.diff(np.r_[0, np.cumsum(m)][rows])
        runs, masked = np.zeros(len(data), bool), np.zeros(len(data), bool)
        runs[1:] = (data[1:] == 33) & (data[:-1] == 33)
        masked[1:-1] = MASK[data[1:-1]] & letter[:-2] & (letter[2:] | MASK[data[2:]])
        to = np.minimum(np.searchsorted(address, kinds[0]), len(address) - 1)
        named = np.bincount(r[address[to] == kinds[0]], minlength=j - i)
        yield i, j, r, kinds, np.bincount(r, minlength=j - i), np.stack([count(upper), count(letter), count(runs), count(masked), named], 1)


@dataclass
class Model:
    """Mined features with their kinds, the voters' weights, and the classifier."""

    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    kinds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    def prepare(self) -> None:
        order = np.argsort(self.features)
        self.features, self.kinds = self.features[order], self.kinds[order]
        if len(self.weights):
            self.weights = self.weights[order]
        self.gate = np.zeros(1 << 18, bool)
        self.gate[(self.features & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def hits(self, r: np.ndarray, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and feature numbers of all hits."""
        rows, found = [], []
        for h in kinds:
            some = np.flatnonzero(self.gate[(h & np.uint64((1 << 18) - 1)).astype(np.int64)])
            at = np.searchsorted(self.features, h[some])
            at[at == len(self.features)] = 0
            ok = self.features[at] == h[some] if len(self.features) else np.zeros(0, bool)
            rows.append(r[some[ok]])
            found.append(at[ok])
        return np.concatenate(rows), np.concatenate(found)


def _rate(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return 50.0 * counts / np.maximum(words, 25)


def votes(model: Model, n: int, rows: np.ndarray, found: np.ndarray, words: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Votes of each of n rows: 1 toxic, -1 clean, 0 none."""
    kind = model.kinds[found]
    out = np.zeros((n, len(VOTERS)), np.int8)
    enough = words >= 20
    per_kind = [np.bincount(rows[kind == k], minlength=n) for k in range(-1, len(KINDS))]
    for v, c in enumerate(per_kind):
        rate = _rate(c, words)
        out[:, v] = np.where((rate >= 0.15) & (c > 0), 1, np.where((c == 0) & enough, -1, 0))
    pair = np.unique(rows.astype(np.int64) * (len(model.features) + 1) + found)
    distinct = np.bincount(pair // (len(model.features) + 1), minlength=n)
    total = np.bincount(rows, minlength=n)
    rate = _rate(total, words)
    out[:, 6] = np.where((distinct >= 2) & (rate >= 0.2), 1, np.where(distinct == 0, -1, 0))
    out[:, 7] = np.where(rate >= 0.4, 1, np.where(rate < 0.05, -1, 0))
    out[:, 8] = np.where((total >= 3) & (rate >= 0.2), 1, 0)
    out[:, 9] = np.where((signs[:, 1] >= 40) & (signs[:, 0] > 0.6 * signs[:, 1]), 1, 0)
    out[:, 10] = np.where((signs[:, 2] >= 2) & (_rate(signs[:, 2], words) >= 0.2), 1, 0)
    out[:, 11] = np.where((signs[:, 3] >= 1) & (_rate(signs[:, 3], words) >= 0.2), 1, 0)
    out[:, 12] = np.where((signs[:, 4] >= 2) & (_rate(signs[:, 4], words) >= 1.0), 1, np.where((signs[:, 4] == 0) & enough, -1, 0))
    return out


def _mine(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features far more frequent in toxic than in clean training rows, and their kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for i, j, r, kinds, _, _ in _features(batch):
                for k, h in enumerate(kinds):
                    ok = h != 0
                    row, value = r[ok], h[ok]
                    order = np.lexsort((row, value))
                    row, value = row[order], value[order]
                    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])] if len(row) else np.zeros(0, bool)
                    row, value = row[new], value[new]
                    start = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(row) else np.zeros(0, np.int64)
                    if not len(start):
                        continue
                    hot = toxic[i + row].astype(np.int64)
                    a = np.add.reduceat(hot, start)
                    n = np.diff(np.r_[start, len(row)])
                    yield pa.RecordBatch.from_arrays([pa.array(value[start].view(np.int64)), pa.array(np.full(len(start), k, np.int32)), pa.array(a), pa.array(n - a)], names=["feature", "kind", "toxic", "clean"])

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    counted = sample.select("text", "toxic").mapInArrow(run, "feature long, kind int, toxic long, clean long").groupBy("feature", "kind").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    lift = F.log((F.col("a") + 0.5) / (pos + 1)) - F.log((F.col("b") + 0.5) / (neg + 1))
    # What a bounded sample holds is bounded; all that passes is taken.
    top = counted.filter(F.col("a") >= MIN_SUPPORT).withColumn("lift", lift).filter("lift >= 2.0").orderBy("feature").select("feature", "kind").collect()
    return np.array([r["feature"] for r in top], np.int64).view(np.uint64), np.array([r["kind"] for r in top], np.int64)


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.1) -> tuple[np.ndarray, float, np.ndarray]:
    """Accuracies ``P(vote | class)`` (voter, class, vote), the class balance and the voters' weights.

    EM on the histogram. Each maximisation step also estimates the voters' correlations given the class, what
    agreement the two classes leave unexplained; a voter's evidence counts 1 / (1 + sum of |correlation|), so
    that copies of one voter count about once. The first rounds, while classes settle, take voters as independent.
    """
    m = patterns.shape[1]
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
    w = counts / counts.sum()
    weight = np.ones(m)
    voted = (patterns > 0).sum(1)
    q = np.clip(voted / max(1, m / 2), 0.001, 0.95)
    acc, balance = np.zeros((m, 2, 3)), prior
    for step in range(rounds):
        for c, p in enumerate((1 - q, q)):
            mass = (w * p)[:, None, None] * onehot
            acc[:, c] = (mass.sum(0) + 1e-4) / (mass.sum((0, 2))[:, None] + 3e-4)
        balance = float(np.clip((w * q).sum(), 1e-4, 0.5))
        if step >= 5:
            expect = lambda c: acc[:, c, 2] - acc[:, c, 0]
            x = patterns - (q[:, None] * expect(1) + (1 - q)[:, None] * expect(0))
            cov = (x * w[:, None]).T @ x
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.abs(cov / np.outer(sd, sd))
            np.fill_diagonal(corr, 0)
            weight = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(1))
        q_new = posterior(patterns, acc, balance, weight)
        if np.abs(q_new - q).max() < 1e-6 and step > 20:
            q = q_new
            break
        q = q_new
    return acc, balance, weight


def posterior(patterns: np.ndarray, acc: np.ndarray, balance: float, weight: np.ndarray) -> np.ndarray:
    ratio = np.log(acc[:, 1]) - np.log(acc[:, 0])
    s = np.log(balance / (1 - balance)) + (np.take_along_axis(ratio, (patterns.T + 1).astype(np.int64), 1).T * weight).sum(1)
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def _vote_table(docs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns and how many documents have each; the driver gets at most 3 ** voters rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [votes(model, j - i, *model.hits(r, kinds), words, signs) for i, j, r, kinds, words, signs in _features(batch)]
            if codes:
                code = (np.concatenate(codes).astype(np.int64) + 1) @ (3 ** np.arange(len(VOTERS)))
                c, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n.astype(np.int64))], names=["code", "n"])

    got = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    code = np.array([r["code"] for r in got], np.int64)
    return (code[:, None] // (3 ** np.arange(len(VOTERS))) % 3 - 1).astype(np.int8), np.array([r["n"] for r in got], float)


def _logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray, width: int, ridge: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights (none negative) and intercept by accelerated projected gradient, both classes weighing alike."""
    n = len(target)
    weight = np.where(target > 0.5, 0.5 / max(1.0, (target > 0.5).sum()), 0.5 / max(1.0, (target <= 0.5).sum()))
    wt, b = np.zeros(width), -1.0
    y, yb, t = wt.copy(), b, 1.0
    size = np.bincount(rows, values**2, minlength=n).max(initial=1.0) + 1
    rate = 4 / max(size * 0.25, 1.0)
    for _ in range(800):
        z = np.bincount(rows, y[cols] * values, minlength=n) + yb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        new = np.maximum(y - rate * (np.bincount(cols, g[rows] * values, minlength=width) + ridge * y), 0)
        new_b = yb - rate * g.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, yb = new + (t - 1) / t2 * (new - wt), new_b + (t - 1) / t2 * (new_b - b)
        wt, b, t = new, new_b, t2
    return wt, float(b)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from all documents' votes and a bounded sample of labelled training rows.

    Training rows have ``crc32(doc_id as text) mod 5`` other than 0.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    gold = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    # Bounded before the join with texts: the documents with the smallest hashes. So it may be broadcast.
    gold = gold.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).join(F.broadcast(gold), "doc_id")
    sample = durable(rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic"))
    mined, kinds = _mine(sample)
    seeds = _word_hash(INSULTS)
    fresh = ~np.isin(mined, seeds)
    model = Model(np.concatenate([seeds, mined[fresh]]), np.concatenate([np.zeros(len(seeds), np.int64), kinds[fresh] + 1]))
    model.prepare()
    patterns, counts = _vote_table(docs.select(text), model)
    if not len(counts):
        model.weights, model.intercept = np.where(model.kinds == 0, 4.0, 0.0), -2.0
        return model
    acc, balance, weight = label_model(patterns, counts)
    rows, cols, values, target = _training_rows(sample, model, acc, balance, weight)
    if not len(target) or target.max() < 0.5:
        model.weights, model.intercept = np.where(model.kinds == 0, 4.0, 0.0), -2.0
        return model
    model.weights, model.intercept = _logistic(rows, cols, values, target, len(model.features))
    return model


def _training_rows(sample: DataFrame, model: Model, acc: np.ndarray, balance: float, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sparse features and posterior labels of the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, r, kinds, words, signs in _features(batch):
                rows, found = model.hits(r, kinds)
                target = posterior(votes(model, j - i, rows, found, words, signs), acc, balance, weight)
                code, n = np.unique(rows.astype(np.int64) * len(model.features) + found, return_counts=True)
                row, col = code // len(model.features), code % len(model.features)
                value = _rate(n, words[row])
                cut = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([pa.array(target), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(col)), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(value))], names=["target", "cols", "vals"])

    got = sample.select("text").mapInArrow(run, "target double, cols array<long>, vals array<double>").toArrow()
    lens = got.column("cols").combine_chunks()
    lens = np.array([len(x) for x in lens], np.int64)
    flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in got.column(c).chunks] or [np.zeros(0)])
    return np.repeat(np.arange(len(lens)), lens), flat("cols").astype(np.int64), flat("vals"), got.column("target").to_numpy()


def score(docs: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """The documents, all columns, with the score (double) under ``name``; a column of theirs with that name gives way."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    own = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i, j, r, kinds, words, _ in _features(batch):
                rows, found = model.hits(r, kinds)
                z = _rate(np.bincount(rows, model.weights[found], minlength=j - i), words) + model.intercept
                parts.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(np.concatenate([*parts, np.zeros(0)]))], names=[*own, name])

    return docs.select(own).mapInArrow(run, StructType([*docs.select(own).schema.fields, StructField(name, DoubleType())]))
