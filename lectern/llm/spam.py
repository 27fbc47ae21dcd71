"""Keyword-stuffed pages and link lists by robust Mahalanobis distance.

A text is cut into blocks: long lines, and runs of short lines of one kind. Each block is described
by densities (links, hash tags and mark-up, bare separators, digits), the entropy of its words, how
much of it repeats within the text, and its share of function words. Centre and scatter of ordinary
blocks are estimated per language over all blocks of the corpus, starting from a bounded reviewed
sample and concentrating step by step on the inner ones. Blocks far out are held against the
directions in which the outlying blocks of reviewed texts lie; a text is found if more than half of
its words are in outlying blocks of spam-directed directions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .words import WordTable, slices, sums

LANGUAGES = ("en", "de", "fr", "es")
#: The number of any other language: its function words are those of all four, its centre that of all blocks
#: unless it has enough of its own.
OTHER = len(LANGUAGES)
FEATURES = ("links", "marks", "separators", "digits", "repeated_pairs", "repeated_words", "entropy", "function_words", "commas")
#: At most so many reviewed documents, and blocks of theirs, set the start and the directions.
FIT_ROWS, FIT_BLOCKS = 4000, 400_000
#: Words from which on a line is a block of its own; shorter lines of one kind are joined up to so many words.
LONG_LINE, JOINED = 12, 40
#: Squared distance from which on a block is an outlier.
OUTLIER = 28.0
#: Squared distances of which the one that agrees best with the reviews is the flagging limit.
LIMITS = (28.0, 40.0, 55.0, 70.0, 90.0, 115.0, 140.0)
#: Added to the scatter of every feature, as shares are often all zero.
FLOOR = 0.03
DIRECTIONS = 64
#: A direction is spam's if so much of the words that lie in it are in pages marked as spam.
SPAM_SIDE = 0.5
STEPS = 2
#: Share of the words of a document that must be spam.
SHARE = 0.5

#: Function words by language.
FUNCTION_WORDS = {
    "en": "the of to and a in is that for on by with was be not as at it from this or which we has had have are an if no before been were may can into than so such his her their they i you he she but any all would will under does do did its there",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man kann gegen vom wenn ob was wer keine kein wurde dieser diese seit",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son lui nous mais comme on été dont cette sans aux ces sa si elle même être n'a d'un d'une l'on ses leur entre après avant contre selon ainsi peut encore tout toute",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está porque contra cabe ante bajo cada fueron nunca una vez",
}

_LINK = re.compile(r"(?:https?:|www\.|href|//)|[a-z0-9][a-z0-9-]*\.[a-z]{2,}(?:[/?)\]\"'>]|$)", re.IGNORECASE)
_MARK = re.compile(r"^#\w|</?[a-z]+[ >]?|^\[.*\]\(", re.IGNORECASE)
_EDGE = re.compile(r"^\W+|\W+$")
_SETS = [frozenset(FUNCTION_WORDS[c].split()) for c in LANGUAGES]


def featurize(words: list[str]) -> np.ndarray:
    """Of each word as it stands: link, mark, separator, digits, comma, function word by language."""
    out = np.zeros((len(words), 5 + len(LANGUAGES)), np.float32)
    for k, word in enumerate(words):
        bare = _EDGE.sub("", word.lower())
        link = bool(_LINK.search(word)) and not word.endswith("...")
        out[k] = (
            link, bool(_MARK.search(word)), not bare and word.strip(".,:;*§_") != "", not link and any(c.isdigit() for c in bare),
            word.endswith((",", "|", "•", ";", "/")), *(bare in s for s in _SETS),
        )
    return out


class Blocks:
    """Blocks of texts and their features."""

    def __init__(self):
        self.words = WordTable(featurize)
        self.bare: dict[int, int] = {}

    def of(self, texts: list[str], labels: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, language number and words of each block, and its features."""
        lines, text_of, again = [], [], []
        for k, text in enumerate(texts):
            seen = set()
            for line in text.split("\n"):
                if own := line.split():
                    lines.append(own)
                    text_of.append(k)
                    # a paragraph that recurs whole is not repetition of words
                    again.append(len(own) >= LONG_LINE and line in seen)
                    seen.add(line)
        if not lines:
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros((0, len(FEATURES)))
        sizes, text_of = np.array([len(x) for x in lines], np.int64), np.array(text_of, np.int64)
        rows = self.words.rows([w for x in lines for w in x])
        f = self.words.features[rows]
        line_links = sums(f[:, :2], sizes).sum(1) > 0
        block_of = self._cut(sizes, text_of, line_links)
        block, text = np.repeat(block_of, sizes), np.repeat(text_of, sizes)
        n_block, n_text = int(block_of[-1]) + 1, len(texts)
        size = np.bincount(block, minlength=n_block).astype(float)
        total = np.bincount(text, minlength=n_text).astype(float)
        owner = np.zeros(n_block, np.int64)
        owner[block_of] = text_of

        hits = np.stack([np.bincount(text, f[:, 5 + k], n_text) for k in range(len(LANGUAGES))], 1)
        said = np.array([LANGUAGES.index(c) if (c := (x or "").strip().lower()[:2]) in LANGUAGES else OTHER for x in labels])
        language = np.where(hits.max(1) >= 3, hits.argmax(1), said)
        speech = np.column_stack([f[:, 5:], f[:, 5:].max(1)])
        common = speech[np.arange(len(f)), language[text]] > 0

        word, fresh = rows, ~np.repeat(np.array(again, bool), sizes)
        key, inverse, count = np.unique((block << 32) | word, return_inverse=True, return_counts=True)
        n = size[key >> 32]
        entropy = np.bincount(key >> 32, -(count / n) * np.log(count / n), n_block) / np.log(np.maximum(size, 3))
        in_text, back = np.unique((owner[key >> 32] << 32) | (key & 0xFFFFFFFF), return_inverse=True)
        often = np.bincount(back[inverse], fresh, len(in_text))[back][inverse]
        repeated = (often >= np.maximum(4, 0.015 * total[text])) & ~common
        pair = np.full(len(word), -1, np.int64)
        same = text[1:] == text[:-1]
        pair[:-1][same] = (word[:-1][same] << 31) | word[1:][same]
        # pairs of different texts of one batch may share a slot of the table by chance, one in a billion
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(30)
        _, where = np.unique(text.astype(np.uint64) << np.uint64(40) ^ slot, return_inverse=True)
        pairs = (np.bincount(where, fresh)[where] >= 4) & (pair >= 0)

        share = lambda x: np.bincount(block, x, n_block) / size
        x = np.column_stack([share(f[:, 0]), share(f[:, 1]), share(f[:, 2]), share(f[:, 3]), share(pairs), share(repeated), entropy, share(common), share(f[:, 4])])
        return owner, language[owner], size.astype(np.int64), x

    @staticmethod
    def _cut(sizes: np.ndarray, text_of: np.ndarray, links: np.ndarray) -> np.ndarray:
        """The block of each line."""
        out, block, held = np.zeros(len(sizes), np.int64), -1, 0
        before = (-1, False, False)
        for k, (n, text, link) in enumerate(zip(sizes.tolist(), text_of.tolist(), links.tolist())):
            now = (text, n < LONG_LINE, link)
            if now != before or not now[1] or held + n > JOINED:
                block, held = block + 1, 0
            held += n
            before = now
            out[k] = block
        return out


BLOCK = "doc_id long, language int, words int, x array<float>"


def blocks(documents: DataFrame) -> DataFrame:
    """``doc_id, language, words, x`` of every block of every text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Blocks()
        for batch in slices(batches, 500):
            owner, language, size, x = own.of(batch.column("text").to_pylist(), batch.column("lang").to_pylist())
            ids = batch.column("doc_id").take(pa.array(owner, pa.int64()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1) * len(FEATURES), pa.int32()), pa.array(x.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(language, pa.int32()), pa.array(size, pa.int32()), lists], ["doc_id", "language", "words", "x"])

    source = documents.where("text is not null and text <> '' and doc_id is not null").select("doc_id", "text", "lang")
    return source.mapInArrow(describe, BLOCK)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)


class SpamModel:
    """Centre and inverse scatter by language; unit directions in whitened space and whose they are."""

    def __init__(self, centre: np.ndarray, root: np.ndarray, directions: np.ndarray, spam: np.ndarray, limit: float = OUTLIER):
        self.centre, self.root, self.directions, self.spam, self.limit = centre, root, directions, spam, limit

    def whiten(self, language: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.einsum("nij,nj->ni", self.root[language], x - self.centre[language]) if len(x) else x

    def flagged(self, language: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for k in np.unique(language):
            at = np.flatnonzero(language == k)
            z = (x[at] - self.centre[k]) @ self.root[k].T
            far = np.einsum("ij,ij->i", z, z) > self.limit
            if len(self.directions):
                out[at] = far & self.spam[(z @ self.directions.T).argmax(1)]
        return out


def _root(moments: np.ndarray, n: float, mean: np.ndarray) -> np.ndarray:
    scatter = moments / max(n, 1) - np.outer(mean, mean) + np.eye(len(mean)) * FLOOR**2
    values, vectors = np.linalg.eigh(scatter)
    return (vectors / np.sqrt(np.maximum(values, FLOOR**2 / 4))).T


def _concentrate(parts: list[tuple[int, float, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Centres and roots from sums per language; a language with few blocks takes those of all."""
    p = len(FEATURES)
    n, total, moments = np.zeros(OTHER + 1), np.zeros((OTHER + 1, p)), np.zeros((OTHER + 1, p, p))
    for k, count, s, m in parts:
        n[k] += count
        total[k] += s
        moments[k] += m
    centre, root = np.zeros((OTHER + 1, p)), np.zeros((OTHER + 1, p, p))
    for k in range(OTHER + 1):
        own = n[k] >= 50
        c, s, m = (n[k], total[k], moments[k]) if own else (n.sum(), total.sum(0), moments.sum(0))
        centre[k] = s / max(c, 1)
        root[k] = _root(m, c, centre[k])
    return centre, root


def _sums(language: np.ndarray, x: np.ndarray, keep: np.ndarray) -> list[tuple[int, float, np.ndarray, np.ndarray]]:
    out = []
    for k in range(OTHER + 1):
        own = x[keep & (language == k)]
        out.append((k, float(len(own)), own.sum(0), own.T @ own))
    return out


def _inner(model: tuple[np.ndarray, np.ndarray], language: np.ndarray, x: np.ndarray) -> np.ndarray:
    centre, root = model
    d = np.zeros(len(x))
    for k in np.unique(language):
        at = language == k
        z = (x[at] - centre[k]) @ root[k].T
        d[at] = np.einsum("ij,ij->i", z, z)
    return d <= OUTLIER


def _over_corpus(described: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One concentration step over all blocks: sums of the inner ones by language, a few hundred
    numbers a task, added up by Spark."""
    p = len(FEATURES)
    shared = described.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((OTHER + 1, 1 + p + p * p))
        for batch in batches:
            x, language = _matrix(batch), batch.column("language").to_numpy()
            for k, n, s, m in _sums(language, x, _inner(shared.value, language, x)):
                total[k] += np.concatenate([[n], s, m.ravel()])
        k, i = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(total.ravel())], ["language", "i", "v"])

    held = np.zeros((OTHER + 1, 1 + p + p * p))
    added = described.select("language", "x").mapInArrow(add, "language int, i int, v double").groupBy("language", "i").agg(F.sum("v").alias("v"))
    for row in added.collect():
        held[row["language"], row["i"]] = row["v"]
    return _concentrate([(k, h[0], h[1 : 1 + p], h[1 + p :].reshape(p, p)) for k, h in enumerate(held)])


def _directions(z: np.ndarray, weight: np.ndarray, spam: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of the outlying blocks of reviewed texts, and which directions are spam's."""
    if not len(z):
        return np.zeros((0, len(FEATURES))), np.zeros(0, bool)
    unit = z / np.linalg.norm(z, axis=1, keepdims=True)
    chance, centres = np.random.default_rng(11), unit[[0]]
    while len(centres) < min(DIRECTIONS, 1 + len(unit) // 25):  # starts are likelier where the others cover badly
        gap = np.maximum(1 - (unit @ centres.T).max(1), 0) * weight
        if gap.sum() < 1e-9:
            break
        centres = np.concatenate([centres, unit[[chance.choice(len(unit), p=gap / gap.sum())]]])
    for _ in range(20):
        own = (unit @ centres.T).argmax(1)
        moved = np.stack([np.bincount(own, weight * unit[:, j], len(centres)) for j in range(unit.shape[1])], 1)
        length = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, moved / np.maximum(length, 1e-9), centres)
    own = (unit @ centres.T).argmax(1)
    side = np.bincount(own, weight * spam, len(centres)) / np.maximum(np.bincount(own, weight, len(centres)), 1e-12)
    return centres, side >= SPAM_SIDE


def fit_spam(described: DataFrame, reviews: DataFrame, limit: int = FIT_ROWS) -> SpamModel:
    """``described``: all blocks, materialised. ``reviews``: ``doc_id, verdict``; of several verdicts
    the most frequent counts, 'ok' in a tie. At most ``limit`` reviewed documents, by hash of
    ``doc_id``, set the start and the directions; centre and scatter are those of all blocks."""
    verdict = reviews.groupBy("doc_id").agg((F.count_if(F.col("verdict") == "spam") * 2 > F.count("verdict")).alias("spam"))
    chosen = verdict.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    reviewed = described.join(F.broadcast(chosen), "doc_id")
    sizes = reviewed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # ``limit`` rows
    kept = [(r["doc_id"],) for r, n in zip(sizes, accumulate(r["n"] for r in sizes)) if n <= FIT_BLOCKS]
    chosen = described.sparkSession.createDataFrame(kept, "doc_id long")
    pdf = reviewed.join(F.broadcast(chosen), "doc_id").select("doc_id", "language", "words", "x", "spam").toPandas()
    x = np.array(pdf["x"].tolist(), float).reshape(-1, len(FEATURES))
    language, words = pdf["language"].to_numpy(np.int64), pdf["words"].to_numpy(float)
    spam = pdf["spam"].to_numpy(bool)
    model = _concentrate(_sums(language, x, ~spam))
    for _ in range(STEPS):
        model = _over_corpus(described, model)
    centre, root = model
    bare = SpamModel(centre, root, np.zeros((0, len(FEATURES))), np.zeros(0, bool))
    z = bare.whiten(language, x)
    far = np.einsum("ij,ij->i", z, z) > OUTLIER if len(z) else np.zeros(0, bool)
    # texts count alike, however long
    whole = pdf.groupby("doc_id")["words"].transform("sum").to_numpy(float) if len(pdf) else words
    weight = words / whole
    directions, side = _directions(z[far], weight[far], spam[far])
    return calibrate(SpamModel(centre, root, directions, side), pdf["doc_id"].to_numpy(), language, x, weight, spam)


def calibrate(model: SpamModel, doc: np.ndarray, language: np.ndarray, x: np.ndarray, weight: np.ndarray, spam: np.ndarray) -> SpamModel:
    """Take the limit of the distance that agrees with most verdicts; the middle one of equals."""
    if len(doc):
        _, own = np.unique(doc, return_inverse=True)
        said = np.bincount(own, spam) > 0
        right = []
        for limit in LIMITS:
            model.limit = limit
            share = np.bincount(own, weight * model.flagged(language, x))
            right.append(int(((share > SHARE) == said).sum()))
        best = [limit for limit, r in zip(LIMITS, right) if r == max(right)]
        model.limit = best[len(best) // 2]
    return model


def spam_shares(described: DataFrame, model: SpamModel) -> DataFrame:
    """``doc_id, spam_share``: the share of each document's words in spam-directed outlying blocks.
    Only counts of words are shuffled, summed on the map side first."""
    shared = described.sparkSession.sparkContext.broadcast(model)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = shared.value.flagged(batch.column("language").to_numpy(), _matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("words"), pa.array(hit)], ["doc_id", "words", "hit"])

    each = described.mapInArrow(flag, "doc_id long, words int, hit boolean").groupBy("doc_id")
    return each.agg((F.sum(F.expr("if(hit, words, 0)")) / F.sum("words")).alias("spam_share"))


def score_documents(documents: DataFrame, reviews: DataFrame) -> DataFrame:
    """The spam share of every document with a word in its text. Null, empty and blank texts have no
    row; of a repeated ``doc_id`` all rows count together. Other columns are pruned."""
    described = cut(blocks(documents))
    return spam_shares(described, fit_spam(described, reviews))
