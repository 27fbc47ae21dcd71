"""Subject areas of documents by seeded non-negative factorisation.

For each language the matrix of labelled documents by terms is factored into one anchored component
a subject and a background component. A subject's component starts at the terms that mark it and
are typical of its labelled documents, memberships start at the labels and the background, and
multiplicative updates of both factors in turn leave at zero what starts there, so each anchored
component stays the subject it was seeded with. The factor of terms is broadcast. Every sentence
of every transcript, and every title that stands for a missing one, is folded in: its own
memberships are found by the same multiplicative update with the factor of terms held fixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import USABLE_WORDS, LanguageModel
from .samples import Sample
from .words import WordTable, slices, sums

#: At most so many reviewed rows are fitted on.
FIT_ROWS = 6000
UPDATES = 40
#: A subject starts at terms that are so many times as frequent in its documents as in all.
MARKED = 1.5
#: So much of the labelled documents that have a term must be of its subject, where that many further
#: documents count as having the term and no subject.
TYPICAL, UNSEEN = 0.45, 1
#: So much of the labelled documents of a subject must have a term, as a few labels are wrong, and what stands
#: in no other document than a wrongly labelled one says nothing of the subject.
HELD = 0.05
#: Updates of the memberships of a sentence or title against the fixed factor of terms.
FOLDS = 8
#: Counts added to the background of every term, so that a term seen once says nothing.
RARE = 0.7
#: A sentence is about its foremost subject if that holds so much of its terms.
ABOUT = 0.5
#: The share of sentences from which on a document is about a subject.
SHARE = 0.25
#: With more words to a sentence than this, punctuation is missing or sentences are run together.
RUN_ON = 30
#: A title names a thing of a subject if its terms give the subject so much.
TITLE_MASS = 0.6

#: Languages of a title whose scores, by root of its words, differ by less are both likely.
UNSURE = 2.5

_WORD = re.compile(r"[^\W\d_]+")


def term(word: str) -> str:
    """The letters of a word, in lower case, of its longest run; empty for a word without letters."""
    runs = _WORD.findall(word.lower())
    return max(runs, key=len) if runs else ""


class SubjectModel:
    """``factor``: for each term and language its weight in each component, the background last. Its
    size is bounded by the vocabulary of the sample."""

    def __init__(self, subjects: list[str], languages: LanguageModel, terms: dict[str, int], factor: np.ndarray):
        self.subjects, self.languages, self.terms, self.factor = subjects, languages, terms, factor
        #: terms of the background alone, whose part of a membership needs no update
        self.topical = factor[:, :-1].any(1)

    def fold_in(self, unit: np.ndarray, number: np.ndarray, spoken: np.ndarray, units: int) -> np.ndarray:
        """For each unit (sentence or title) how many of its words each subject accounts for. ``unit,
        number, spoken``: of every word, in order of units; number -1 is of the background.

        Memberships start even; an update shares every word out by membership times weight, and the
        shares of its words are the unit's next membership."""
        size = np.bincount(unit, minlength=units).astype(float)
        at = np.maximum(number, 0) * len(self.languages.codes) + spoken
        own = np.flatnonzero((number >= 0) & self.topical[at])
        mass = np.zeros((units, len(self.subjects)))
        if not len(own):
            return mass
        held, back, count = np.unique(unit[own], return_inverse=True, return_counts=True)
        weight = self.factor[at[own]]
        starts = np.cumsum(count) - count
        words = size[held]
        member = np.full((len(held), weight.shape[1]), 1.0 / weight.shape[1])
        for _ in range(FOLDS):
            part = member[back] * weight
            part /= part.sum(1, keepdims=True)
            total = np.add.reduceat(part, starts, axis=0)
            total[:, -1] += words - count
            member = total / words[:, None]
        mass[held] = total[:, :-1]
        return mass

    def featurize(self, words: list[str]) -> np.ndarray:
        """Language scores, an end-of-sentence mark, the number of the term (or -1)."""
        ends = np.array([w.rstrip("\"'»”)").endswith((".", "?", "!", "…")) for w in words], np.float32)
        number = np.array([self.terms.get(term(w), -1) for w in words], np.float32)
        return np.column_stack([self.languages.featurize(words), ends, number]).astype(np.float32)


def factor(
    doc: np.ndarray, word: np.ndarray, count: np.ndarray, membership: np.ndarray, typical: np.ndarray, updates: int = UPDATES
) -> np.ndarray:
    """The counts of the matrix as the factors divide them: components x terms. ``doc, word,
    count``: the matrix as triples, by document; ``membership``: documents x components as seeded;
    ``typical``: subjects x terms, the terms a subject may be seeded at.

    The last component is the background and starts at the frequencies of all documents. The others
    start at their typical terms that are markedly more frequent with them; all others are zero
    there, and multiplicative updates leave them so."""
    terms = typical.shape[1]
    w = membership / np.maximum(membership.sum(1, keepdims=True), 1e-12)
    start = np.zeros((w.shape[1], terms))
    for k in range(w.shape[1]):
        start[k] = np.bincount(word, count * w[doc, k], terms)
    h = start / np.maximum(start.sum(1, keepdims=True), 1e-12)
    common = np.bincount(word, count, terms) / max(count.sum(), 1e-12)
    h[:-1] *= np.clip(h[:-1] / np.maximum(common, 1e-12) - MARKED, 0, 1) * typical
    h[-1] = common + 1e-9
    h /= np.maximum(h.sum(1, keepdims=True), 1e-12)
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    present = doc[starts] if len(doc) else np.zeros(0, np.int64)
    held = start
    for _ in range(updates):
        part = w[doc] * h[:, word].T
        part *= (count / np.maximum(part.sum(1), 1e-12))[:, None]
        for k in range(w.shape[1]):
            held[k] = np.bincount(word, part[:, k], terms)
        h = held / np.maximum(held.sum(1, keepdims=True), 1e-12)
        new = np.zeros_like(w)
        if len(doc):
            new[present] = np.add.reduceat(part, starts, axis=0)
        w = new / np.maximum(new.sum(1, keepdims=True), 1e-12)
    return held


def fit_subjects(texts: list[str], labels: list[set[str]], subjects: list[str], languages: LanguageModel) -> SubjectModel:
    """``labels``: the subjects of a text; an empty set leaves all of them open."""
    n_lang, n_sub = len(languages.codes), len(subjects)
    words = WordTable(languages.featurize, kept=1 << 60)
    units, owner = [], []
    for k, text in enumerate(texts):
        for line in text.split("\n"):
            if split := line.split():
                units.append(split)
                owner.append(k)
    counts = np.array([len(u) for u in units], np.int64)
    rows = words.rows([w for u in units for w in u])
    spoken = sums(words.features[rows], counts).argmax(1) if len(units) else np.zeros(0, np.int64)
    distinct = [term(w) for w in words.numbers]
    terms: dict[str, int] = {}
    code = np.array([terms.setdefault(t, len(terms)) if t else -1 for t in distinct], np.int64)
    unit = np.repeat(np.arange(len(units)), counts)
    own = code[rows] if len(rows) else np.zeros(0, np.int64)
    ok = own >= 0
    width = len(terms)
    doc, lang = np.array(owner, np.int64)[unit[ok]], spoken[unit[ok]]
    key = (doc * n_lang + lang) * width + own[ok]
    pairs, count = np.unique(key, return_counts=True)
    doc, rest = pairs // (n_lang * width), pairs % (n_lang * width)
    lang = rest // width
    seeded = np.zeros((len(texts), n_sub + 1))
    seeded[:, n_sub] = 1
    truth = np.zeros((len(texts), n_sub))
    for k, label in enumerate(labels):
        at = [subjects.index(s) for s in label if s in subjects]
        seeded[k, :n_sub] = 0.01 if at else 1 / n_sub
        seeded[k, at] = 1 / max(1, len(at))
        truth[k, at] = 1
    known = truth.any(1)
    weights = np.zeros((max(width, 1) * n_lang, n_sub + 1), np.float32)
    for k in range(n_lang):
        here = lang == k
        # of the documents that have the term, the part that is of each subject
        labelled = here & known[doc]
        holders = np.bincount((rest % width)[labelled], minlength=width)
        of = np.stack([np.bincount((rest % width)[labelled], truth[doc[labelled], j], width) for j in range(n_sub)])
        of_subject = truth[np.unique(doc[labelled])].sum(0)[:, None]
        typical = (of > 0) & (of >= TYPICAL * (holders + UNSEEN)) & (of >= HELD * of_subject)
        held = factor(doc[here], (rest % width)[here], count[here].astype(float), seeded, typical)
        held[n_sub] += RARE
        each = held / np.maximum(held.sum(1, keepdims=True), 1e-12)
        weights[np.arange(width) * n_lang + k] = each.T
    return SubjectModel(subjects, languages, terms, weights)


def sentences(model: SubjectModel, words: WordTable, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the words of lines: the line and the sentence each belongs to, and whether it ends a
    sentence by its punctuation; for each sentence the words its subjects account for."""
    counts = np.array([len(x) for x in lines], np.int64)
    rows = words.rows([w for x in lines for w in x])
    n_lang = len(model.languages.codes)
    features = words.features[rows]
    spoken = sums(features[:, :n_lang], counts).argmax(1) if len(lines) else np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(lines)), counts)
    ends = features[:, n_lang] > 0
    begins = np.ones(len(rows), bool)
    if len(rows) > 1:
        begins[1:] = ends[:-1] | (line[1:] != line[:-1])
    sentence = np.cumsum(begins) - 1
    mass = model.fold_in(sentence, features[:, n_lang + 1].astype(np.int64), spoken[line], int(begins.sum()))
    return line, sentence, ends, mass


def document_shares(model: SubjectModel, words: WordTable, texts: list[str]) -> np.ndarray:
    """For each text the share of its sentences about each subject.

    Where punctuation is missing or sentences are run together, what stands between two ends is
    several sentences, so it counts by its words and divides over subjects as its terms do.
    """
    lines, per_text = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = [x.split() for x in text.split("\n")]
        own = [x for x in own if x]
        lines += own
        per_text[k] = len(own)
    n_sub = len(model.subjects)
    if not lines:
        return np.zeros((len(texts), n_sub))
    line, sentence, ends, mass = sentences(model, words, lines)
    of_line = np.repeat(np.arange(len(texts)), per_text)
    sizes = np.bincount(sentence)
    text = of_line[line[np.cumsum(sizes) - sizes]]
    total, top = mass.sum(1), mass.max(1)
    single = np.zeros((len(sizes), n_sub))
    single[np.arange(len(sizes)), mass.argmax(1)] = top >= ABOUT
    words_in = np.bincount(of_line[line], minlength=len(texts))
    ended = np.bincount(of_line[line], ends, minlength=len(texts))
    run_on = (words_in > RUN_ON * ended)[text]
    spread = mass / np.maximum(total, 1e-9)[:, None] * (top >= ABOUT)[:, None]
    weight = np.where(run_on, sizes, 1.0)
    about = np.where(run_on[:, None], spread, single) * weight[:, None]
    out = np.zeros((len(texts), n_sub))
    for k in range(n_sub):
        out[:, k] = np.bincount(text, about[:, k], len(texts))
    return out / np.maximum(np.bincount(text, weight, len(texts)), 1e-9)[:, None]


def title_subjects(model: SubjectModel, words: WordTable, titles: list[str]) -> np.ndarray:
    """Whether the part of a title up to the first ``|``, folded in whole, has a term of each subject. A
    title too short to tell its language, without a term in the likeliest, is read in the next likely one."""
    heads = [t.split("|", 1)[0].split() for t in titles]
    sizes = np.array([len(h) for h in heads], np.int64)
    out, n_lang = np.zeros((len(titles), len(model.subjects)), bool), len(model.languages.codes)
    if not sizes.sum():
        return out
    rows = words.rows([w for h in heads for w in h])
    features, title = words.features[rows], np.repeat(np.arange(len(heads)), sizes)
    score = sums(features[:, :n_lang], sizes) / np.sqrt(np.maximum(sizes, 1))[:, None]
    order = np.argsort(-score, axis=1, kind="stable")
    number = features[:, n_lang + 1].astype(np.int64)
    for place in range(min(2, n_lang)):
        spoken = order[:, place]
        at = np.arange(len(heads))
        near = ~out.any(1) & (score[at, order[:, 0]] - score[at, spoken] < UNSURE)
        mass = model.fold_in(title, number, spoken[title], len(heads))
        out |= (mass >= TITLE_MASS) & near[:, None]
    return out


def fit_reviewed(sample: Sample, subjects: DataFrame, languages: LanguageModel, limit: int = FIT_ROWS) -> SubjectModel:
    """The model from at most ``limit`` reviewed videos of the sample, by hash of ``video_id``: the title up
    to the first ``|`` and the transcript. A video keeps every subject that a review gives it."""
    codes = sorted(r["subject_code"] for r in subjects.select("subject_code").collect())  # a fixed table of eight rows
    said = sample.reviews.where((F.col("aspect") == "subject") & F.col("video_id").isNotNull()).groupBy("video_id").agg(F.collect_set("label_value").alias("labels"))
    rows = sample.take(said, limit, "nullif(concat_ws('\n', substring_index(title, '|', 1), transcript), '')")
    return fit_subjects(rows["text"].tolist(), [set(x) for x in rows["labels"]], codes, languages)


def video_subjects(videos: DataFrame, model: SubjectModel) -> DataFrame:
    """``video_id, subject_code, share`` of every video.

    With a transcript of at least 50 words: the subjects that a quarter of its sentences are about.
    Otherwise the subjects that the title names, with a null share. Null and empty titles give
    nothing. Rows that repeat a video give each pair once, with the largest share. Rows are only
    mapped; the shuffle that removes repeats carries found pairs.
    """
    shared = videos.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = WordTable(model.featurize)
        names = np.array(model.subjects, object)
        for batch in slices(batches):
            ids = np.array(batch.column("video_id").to_pylist(), object)
            titles = batch.column("title").to_pylist()
            texts = [t or "" for t in batch.column("transcript").to_pylist()]
            usable = np.array([len(t.split()) >= USABLE_WORDS for t in texts], bool)
            at = np.flatnonzero(usable)
            shares = document_shares(model, words, [texts[k] for k in at])
            r1, c1 = np.nonzero(shares >= SHARE)
            rest = np.flatnonzero(~usable)
            r2, c2 = np.nonzero(title_subjects(model, words, [titles[k] or "" for k in rest]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*ids[at[r1]], *ids[rest[r2]]], pa.string()),
                    pa.array([*names[c1], *names[c2]], pa.string()),
                    pa.array([*shares[r1, c1].tolist(), *[None] * len(r2)], pa.float64()),
                ],
                ["video_id", "subject_code", "share"],
            )

    found = videos.select("video_id", "title", "transcript").mapInArrow(find, "video_id string, subject_code string, share double")
    return found.groupBy("video_id", "subject_code").agg(F.max("share").alias("share"))
