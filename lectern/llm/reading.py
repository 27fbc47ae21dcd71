"""Reading level of documents by regularised ordinal regression.

Features of a text, each taken per language: length of words and sentences, lexical diversity, word
rarity from counts over the whole corpus, the grades of the texts a word is found in, connectives,
and commas and subordinators a sentence as a stand-in for clause depth. A proportional-odds model
with an L2 penalty is calibrated on a bounded sample of graded texts and broadcast; so is the
fixed-size table of hashed word counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import USABLE_WORDS, LanguageModel
from .samples import Sample
from .subjects import term
from .words import WordTable, slices, sums

#: At most so many graded rows are fitted on.
FIT_ROWS = 10_000
#: Texts of the sample worked on at once, so that the driver's memory follows these and the vocabulary.
PART_ROWS = 500
LEVELS = (1, 2, 3, 4)
#: Buckets of the corpus counts; the table has this size whatever the corpus.
COUNT_BUCKETS = 1 << 16
PENALTY = 1e-3

#: Connectives of everyday speech, then of formal prose (single words, by language).
EVERYDAY = {
    "en": "because if although when while before after so but and then or since until",
    "de": "weil wenn obwohl als während bevor nachdem damit aber und dann oder falls bis",
    "fr": "parce si quoique quand pendant avant après pour mais et puis ou depuis même",
    "es": "porque si aunque cuando mientras antes después para pero y entonces o siempre hasta",
    "pt": "porque se embora quando enquanto antes depois para mas e então ou sempre até",
    "ru": "потому если хотя когда пока прежде после чтобы но и потом или поскольку до",
}
FORMAL = {
    "en": "whereby insofar provided irrespective notwithstanding whereas hence thus wherein albeit lest corollary",
    "de": "sofern wodurch insofern ungeachtet gleichwohl mithin wonach hinsichtlich demgemäß wiewohl indem",
    "fr": "moyennant pourvu nonobstant indépendamment lequel auquel laquelle dont corollaire mesure toutefois",
    "es": "conque siempre salvo obstante independencia cual cuanto medida corolario merced sino",
    "pt": "contanto salvo obstante independentemente qual medida corolário conquanto porquanto senão",
    "ru": "вследствие безотносительно сообразно вопреки надлежит поскольку посредством ввиду дабы коль",
}


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % COUNT_BUCKETS


def corpus_counts(df: DataFrame, text: str) -> np.ndarray:
    """Hashed counts of the words of every text. Each task sends the entries of one fixed-size
    vector, so what is shuffled and what the driver gets is bounded by ``COUNT_BUCKETS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words without letters share the bucket after the last
        words = WordTable(lambda new: np.array([bucket(t) if (t := term(w)) else COUNT_BUCKETS for w in new], np.int64))
        total = np.zeros(COUNT_BUCKETS + 1, np.int64)
        for batch in slices(batches):
            rows = words.rows([w for t in batch.column(0).to_pylist() for w in t.split()])
            total += np.bincount(words.features[rows], minlength=COUNT_BUCKETS + 1)
        at = np.flatnonzero(total[:COUNT_BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    held = df.select(text).where(F.col(text).isNotNull()).mapInArrow(count, "bucket int, n long")
    out = np.zeros(COUNT_BUCKETS, np.int64)
    for row in held.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


class Reader:
    """Turns texts into features. ``grades``: (term number x language) -> mean grade, nan if unknown."""

    def __init__(self, languages: LanguageModel, counts: np.ndarray):
        self.languages, self.terms, self.grades = languages, {}, np.zeros((0, len(languages.codes)), np.float32)
        self.rarity = (np.log(counts.sum() + 1.0) - np.log(counts + 1.0)).astype(np.float32)
        self.connective = {}
        for kind, lists in enumerate((EVERYDAY, FORMAL)):
            for code, words in lists.items():
                if code in languages.codes:
                    for w in words.split():
                        self.connective.setdefault(w, np.zeros((2, len(languages.codes)), np.float32))[kind, languages.codes.index(code)] = 1

    def featurize(self, words: list[str]) -> np.ndarray:
        """Of each word: language scores; ends a sentence; has a comma; letters; rarity; term number;
        everyday and formal connective by language."""
        n = len(self.languages.codes)
        out = np.zeros((len(words), 3 * n + 5), np.float32)
        if not words:
            return out
        out[:, :n] = self.languages.featurize(words)
        blank = np.zeros((2, n), np.float32)
        for k, word in enumerate(words):
            t = term(word)
            out[k, n:] = (
                word.rstrip("\"'»”)").endswith((".", "?", "!", "…")), "," in word or ";" in word or ":" in word, len(t),
                self.rarity[bucket(t)] if t else 0, self.terms.get(t, -1), *self.connective.get(t, blank).ravel(),
            )
        return out

    def split(self, words: WordTable, texts: list[str]):
        """Per word: text, line's language, feature row."""
        lines, per_text = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            own = [s for x in text.split("\n") if (s := x.split())]
            lines += own
            per_text[k] = len(own)
        sizes = np.array([len(x) for x in lines], np.int64)
        rows = words.rows([w for x in lines for w in x])
        n = len(self.languages.codes)
        spoken = sums(words.features[rows, :n], sizes).argmax(1) if lines else np.zeros(0, np.int64)
        return np.repeat(np.repeat(np.arange(len(texts)), per_text), sizes), np.repeat(spoken, sizes), rows

    def features(self, words: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts x features, and the main language of each text."""
        n_text, n = len(texts), len(self.languages.codes)
        text, spoken, rows = self.split(words, texts)
        size = np.maximum(np.bincount(text, minlength=n_text), 1).astype(float)
        main = np.zeros((n_text, n))
        np.add.at(main, (text, spoken), 1)
        f = words.features
        mean = lambda x: np.bincount(text, x, n_text) / size
        length, rarity = f[rows, n + 2], f[rows, n + 3]
        ends, commas = np.bincount(text, f[rows, n], n_text), np.bincount(text, f[rows, n + 1], n_text)
        number = f[rows, n + 4].astype(np.int64)
        grade = np.where(number >= 0, self.grades[np.maximum(number, 0), spoken], np.nan) if len(self.grades) else np.full(len(rows), np.nan)
        known = ~np.isnan(grade)
        graded = np.maximum(np.bincount(text, known, n_text), 1)
        grade = np.where(known, grade, 0)
        of_grade = lambda x: np.bincount(text, x, n_text) / graded
        mid = of_grade(grade)
        distinct = np.array([len(set(t.lower().split())) for t in texts], float)
        punctuated = ends >= size / 60
        per_end = size / np.maximum(ends, 1)
        return np.column_stack([
            mean(length), mean(length >= 9), mean(length >= 13), mean(rarity), mean(rarity > 9), distinct / np.sqrt(size),
            mean(f[rows, n + 5 + spoken]), mean(f[rows, 2 * n + 5 + spoken]),
            np.where(punctuated, np.log(np.minimum(per_end, 60)), 0), np.where(punctuated, np.minimum(commas / np.maximum(ends, 1), 6), 0),
            ~punctuated, np.log(size), mid, mid**2, of_grade((grade > 3.3) & known), of_grade((grade < 1.8) & known), of_grade((grade > 2.6) & known),
        ]).astype(float), main.argmax(1)

    def grade_terms(self, texts: list[str], levels: np.ndarray, smoothing: float = 1.5) -> None:
        """Learn the mean grade of the texts that have a term, per language, drawn to the middle."""
        words = WordTable(self.languages.featurize, kept=1 << 60)
        n = len(self.languages.codes)
        terms: dict[str, int] = {}
        code, seen, total = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        for start in range(0, len(texts), PART_ROWS):
            part = texts[start : start + PART_ROWS]
            text, spoken, rows = self.split(words, part)
            new = [terms.setdefault(t, len(terms)) if (t := term(w)) else -1 for w in islice(words.numbers, len(code), None)]
            code = np.concatenate([code, np.array(new, np.int64)])
            own = code[rows]
            ok = own >= 0
            key = np.unique((own[ok] * n + spoken[ok]) * len(part) + text[ok])
            at, which = key // len(part), key % len(part)
            size = len(terms) * n
            seen = np.pad(seen, (0, size - len(seen))) + np.bincount(at, minlength=size)
            total = np.pad(total, (0, size - len(total))) + np.bincount(at, levels[start + which], size)
        middle = np.mean(levels) if len(levels) else 2.5
        grade = (total + smoothing * middle) / (seen + smoothing)
        self.terms, self.grades = terms, np.where(seen > 0, grade, np.nan).reshape(-1, n).astype(np.float32)


class ReadingModel:
    """A reader, the means and spreads of its features by language, weights and thresholds."""

    def __init__(self, reader: Reader, means: np.ndarray, spreads: np.ndarray, weights: np.ndarray, edges: np.ndarray):
        self.reader, self.means, self.spreads, self.weights, self.edges = reader, means, spreads, weights, edges

    def levels(self, words: WordTable, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0, np.int32)
        x, main = self.reader.features(words, texts)
        z = np.clip((x - self.means[main]) / self.spreads[main], -4, 4)
        return (1 + ((z @ self.weights)[:, None] > self.edges).sum(1)).astype(np.int32)


def ordinal(z: np.ndarray, level: np.ndarray, penalty: float = PENALTY, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of a proportional-odds model on all rows; ``level`` from 1. Damped Newton steps
    on the mean log-likelihood less the L2 penalty of the weights."""
    k, p = len(LEVELS), z.shape[1]
    hot = np.eye(k)[level - 1]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def slope(x: np.ndarray) -> tuple[float, np.ndarray]:
        """The loss and its gradient at weights, first threshold and logarithms of the gaps between thresholds."""
        w, first, gaps = x[:p], x[p], np.exp(np.clip(x[p + 1 :], -20, 20))
        below = sigmoid(np.concatenate([[first], first + np.cumsum(gaps)])[None, :] - (z @ w)[:, None])
        odds = np.diff(np.concatenate([np.zeros((len(z), 1)), below, np.ones((len(z), 1))], 1), axis=1)
        own = np.maximum((odds * hot).sum(1), 1e-12)
        pull = hot / own[:, None] / len(z)
        by_edge = below * (1 - below) * (pull[:, :-1] - pull[:, 1:])  # rise of the likelihood with each threshold
        edge = by_edge.sum(0)
        later = np.array([edge[j + 1 :].sum() for j in range(k - 2)])
        return -np.log(own).mean() + penalty / 2 * w @ w, np.concatenate([z.T @ by_edge.sum(1) + penalty * w, [-edge.sum()], -later * gaps])

    x, damping = np.concatenate([np.zeros(p), [-1.0], np.zeros(k - 2)]), 1e-3
    loss, g = slope(x)
    for _ in range(steps):
        curve = np.stack([(slope(x + 1e-5 * unit)[1] - g) / 1e-5 for unit in np.eye(len(x))])
        curve = (curve + curve.T) / 2
        while damping < 1e6:
            values, vectors = np.linalg.eigh(curve)
            step = vectors @ ((vectors.T @ g) / (np.abs(values) + damping))
            lower, there = slope(x - step)
            if lower <= loss:
                break
            damping *= 4
        else:
            break
        done = loss - lower < 1e-10
        x, loss, g, damping = x - step, lower, there, max(damping / 5, 1e-9)
        if done:
            break
    return x[:p], np.concatenate([[x[p]], x[p] + np.cumsum(np.exp(x[p + 1 :]))])


def fit_levels(texts: list[str], levels: np.ndarray, languages: LanguageModel, counts: np.ndarray) -> ReadingModel:
    """Calibrate on graded texts, then once more without those graded two levels or more off what
    the others make of them, as a few grades are wrong."""
    model, order, guess = _fit_once(texts, levels, languages, counts)
    keep = np.sort(order[np.abs(guess - levels[order]) < 2])
    if len(keep) in (0, len(texts)):
        return model
    return _fit_once([texts[i] for i in keep], levels[keep], languages, counts)[0]


def _fit_once(texts: list[str], levels: np.ndarray, languages: LanguageModel, counts: np.ndarray) -> tuple[ReadingModel, np.ndarray, np.ndarray]:
    """The model, and the order and levels of the texts by the grades of the other half. Grades of terms are learnt crosswise: each half of the sample gets
    its features with the grades of the other half, so that they are as informative as on new texts."""
    half = np.arange(len(texts)) % 2
    parts, mains, order = [], [], []
    for k in (0, 1):
        reader = Reader(languages, counts)
        there, here = np.flatnonzero(half != k), np.flatnonzero(half == k)
        reader.grade_terms([texts[i] for i in there], levels[there])
        words = WordTable(reader.featurize)
        for start in range(0, len(here), PART_ROWS):
            own = here[start : start + PART_ROWS]
            x, main = reader.features(words, [texts[i] for i in own])
            parts.append(x)
            mains.append(main)
            order.append(own)
    n = len(languages.codes)
    reader = Reader(languages, counts)
    reader.grade_terms(texts, levels)
    if not parts:
        none = np.zeros(0, np.int64)
        return ReadingModel(reader, np.zeros((n, 17)), np.ones((n, 17)), np.zeros(17), np.array([-1.0, 0.0, 1.0])), none, none
    x, main, order = np.concatenate(parts), np.concatenate(mains), np.concatenate(order)
    y = levels[order]
    means, spreads = np.tile(x.mean(0), (n, 1)), np.tile(x.std(0) + 1e-6, (n, 1))
    # Level shares differ between the languages of a small sample, so a language's mean is drawn to
    # that of all, and taken over its levels alike.
    for k in range(n):
        own = [x[(main == k) & (y == level)] for level in LEVELS]
        if min(len(o) for o in own) >= 5:
            means[k] = np.mean([o.mean(0) for o in own], 0)
            spreads[k] = np.sqrt(np.mean([o.var(0) for o in own], 0) + np.var([o.mean(0) for o in own], 0)) + 1e-3
    z = np.clip((x - means[main]) / spreads[main], -4, 4)
    w, edges = ordinal(z, y)
    return ReadingModel(reader, means, spreads, w, edges), order, 1 + ((z @ w)[:, None] > edges).sum(1)


def fit_graded(sample: Sample, videos: DataFrame, languages: LanguageModel, limit: int = FIT_ROWS) -> ReadingModel:
    """The model from at most ``limit`` graded videos of the sample with a usable transcript, by hash of
    ``video_id``, and word counts over all transcripts. Of several grades the median counts."""
    graded = sample.reviews.where(F.col("aspect") == "reading_level").select("video_id", F.col("label_value").try_cast("int").alias("level"))
    graded = graded.where(F.col("level").isin(*LEVELS) & F.col("video_id").isNotNull()).groupBy("video_id").agg(F.expr("percentile_disc(0.5) within group (order by level)").cast("int").alias("level"))
    rows = sample.take(graded, limit, "nullif(transcript, '')")
    rows = rows[[len(t.split()) >= USABLE_WORDS for t in rows["text"]]]
    return fit_levels(rows["text"].tolist(), rows["level"].to_numpy(np.int64), languages, corpus_counts(videos, "transcript"))


def reading_levels(videos: DataFrame, model: ReadingModel) -> DataFrame:
    """``video_id, reading_level`` (1 to 4) of every video with a transcript of at least 50 words, once.

    Null, empty and shorter transcripts have no level. If rows of one video differ, the higher level
    counts. Rows are only mapped; the shuffle that removes repeats carries (video, level).
    """
    shared = videos.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = WordTable(model.reader.featurize)
        for batch in slices(batches):
            ids, texts = [], []
            for video, text in zip(batch.column("video_id").to_pylist(), batch.column("transcript").to_pylist()):
                if text and len(text.split()) >= USABLE_WORDS:
                    ids.append(video)
                    texts.append(text)
            levels = model.levels(words, texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(levels, pa.int32())], ["video_id", "reading_level"])

    found = videos.select("video_id", "transcript").mapInArrow(grade, "video_id string, reading_level int")
    return found.groupBy("video_id").agg(F.max("reading_level").alias("reading_level"))
