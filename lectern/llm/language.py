"""The language of texts and of their segments, with a confidence.

Multinomial naive Bayes over hashed character n-grams. The matrix of log-probabilities (buckets x
languages, fixed size) is broadcast; a worker scores each distinct word once in numpy and a segment
is the sum of the rows of its words. The model is fitted on a bounded sample of labelled rows and
refined by a few rounds in which every line of the sample takes the language the model gives it, so
that wrong labels and mixed texts do little harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import Sample
from .words import WordTable, slices, sums

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
#: At most so many labelled rows are fitted on.
FIT_ROWS = 4000
ROUNDS = 3
#: A text of fewer words is not usable; shorter segments and titles are not counted.
USABLE_WORDS, SEGMENT_WORDS, TITLE_WORDS = 50, 8, 6
#: The ISO code of no known language.
UNDETERMINED = "und"

#: Names that the table of languages does not list (own names, bibliographic codes).
OTHER_NAMES = {
    "deutsch": "de", "ger": "de", "français": "fr", "francais": "fr", "fre": "fr", "español": "es", "espanol": "es",
    "castellano": "es", "português": "pt", "portugues": "pt", "русский": "ru", "englisch": "en", "anglais": "en", "inglés": "en",
}

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_QUOTED = re.compile(r'"[^"\n]*"|«[^»\n]*»|“[^”\n]*”|„[^“”\n]*[“”]')


def grams(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word between blanks, and how many a word has. A word without
    letters has none."""
    clean = [_NOT_LETTERS.sub("", w.lower()) for w in words]
    framed = "".join(f" {w} " if w else "" for w in clean)
    sizes = np.array([len(w) + 2 if w else 0 for w in clean], np.int64)
    code = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))  # characters up to the word's end
    hashed, owners, rolling = [], [], np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(code) < n:
            break
        rolling = rolling[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + (code[n - 1 :] + np.uint64(1))
        if n in ORDERS:
            at = left[: len(rolling)] >= n
            if n == 1:
                at &= code[: len(rolling)] != 32
            mixed = rolling[at] * np.uint64(0xD6E8FEB86659FD93)
            hashed.append(((mixed ^ (mixed >> np.uint64(32))) * np.uint64(n * 2 + 1) >> np.uint64(7)) % np.uint64(buckets))
            owners.append(owner[: len(rolling)][at])
    if not hashed:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    owners, hashed = np.concatenate(owners), np.concatenate(hashed).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    return hashed[order], np.bincount(owners, minlength=len(words))


class LanguageModel:
    """Log-probabilities of buckets under each language; ``codes`` are the languages in order."""

    def __init__(self, codes: list[str], table: np.ndarray):
        self.codes, self.table = codes, table

    @staticmethod
    def fit(lines: list[str], labels: np.ndarray, codes: list[str], rounds: int = ROUNDS, smoothing: float = 0.2) -> LanguageModel:
        """``labels`` are numbers of ``codes``. Without lines every language is as likely."""
        words = WordTable(lambda new: np.zeros((len(new), 1), np.float32), kept=1 << 60)
        split = [line.split() for line in lines]
        counts = np.array([len(s) for s in split], np.int64)
        flat = words.rows([w for s in split for w in s])
        distinct = list(words.numbers)
        bucket, sizes = grams(distinct)
        of_word = np.repeat(np.arange(len(distinct)), sizes)
        of_line = np.repeat(np.arange(len(lines)), counts)
        labels = np.asarray(labels, np.int64).copy()
        model = LanguageModel(codes, np.zeros((BUCKETS, len(codes)), np.float32))
        for k in range(rounds):
            seen = np.zeros((len(distinct), len(codes)))
            np.add.at(seen, (flat, labels[of_line]), 1)
            counted = np.stack([np.bincount(bucket, seen[of_word, c], BUCKETS) for c in range(len(codes))], 1) + smoothing
            model = LanguageModel(codes, np.log(counted / counted.sum(0)).astype(np.float32))
            if k + 1 < rounds:
                score = sums(sums(model.table[bucket], sizes)[flat], counts)
                labels = np.where(counts > 0, score.argmax(1), labels)
        return model

    def featurize(self, words: list[str]) -> np.ndarray:
        bucket, sizes = grams(words)
        return sums(self.table[bucket], sizes).astype(np.float32)

    def score(self, words: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language numbers and confidences. A text without letters gets number -1 and confidence 0."""
        split = [plain(t).split() for t in texts]
        counts = np.array([len(s) for s in split], np.int64)
        rows = words.rows([w for s in split for w in s])
        total = sums(words.features[rows], counts)
        spread = total / np.sqrt(np.maximum(counts, 1))[:, None]
        spread = np.exp(spread - spread.max(1, keepdims=True))
        confidence = spread.max(1) / spread.sum(1)
        blank = ~total.any(1)
        return np.where(blank, -1, total.argmax(1)), np.where(blank, 0.0, confidence)


def plain(text: str) -> str:
    """The text without its quotations, if at least four words are left."""
    if '"' in text or "«" in text or "“" in text or "„" in text:
        rest = _QUOTED.sub(" ", text)
        if len(rest.split()) >= 4:
            return rest
    return text


def label_names(languages: pd.DataFrame) -> dict[str, str]:
    """Names and codes of the table of languages, in lower case, and those of ``OTHER_NAMES``."""
    names = dict(OTHER_NAMES)
    for row in languages.itertuples():
        names |= {str(x).strip().lower(): row.lang_code for x in (row.lang_code, row.iso3, row.english_name) if x}
    return {k: v for k, v in names.items() if v in set(languages["lang_code"])}


def stated(label: str | None, names: dict[str, str]) -> str | None:
    """The language a label states, in whatever notation, or none."""
    if not label:
        return None
    return names.get(re.split(r"[-_(,;/ ]", label.strip().lower(), maxsplit=1)[0])


def fit_languages(sample: Sample, languages: DataFrame, limit: int = FIT_ROWS) -> LanguageModel:
    """A model from at most ``limit`` transcripts of the sample whose language is stated: by a review of
    the aspect ``main_language``, or else by the label as it arrived."""
    table = languages.toPandas()  # a fixed table of six rows
    codes, names = sorted(set(table["lang_code"])), label_names(table)
    said = sample.rows.select("video_id", "lang", "hashed").join(sample.labels("main_language"), "video_id", "left").where("label is not null or hashed and lang is not null")
    rows = sample.take(said.select("video_id", F.coalesce("label", "lang").alias("said")), limit, "if(length(transcript) > 100, transcript, null)")
    lines, labels = [], []
    for text, label in zip(rows["text"], rows["said"]):
        if code := stated(label, names):
            own = [line for line in text.split("\n") if line.strip()]
            lines += own
            labels += [codes.index(code)] * len(own)
    return LanguageModel.fit(lines, np.array(labels, np.int64), codes)


def segments(videos: DataFrame, model: LanguageModel, names: dict[str, str], every: bool = False) -> DataFrame:
    """``video_id, seg_no, lang_code, confidence, stated, counted`` of every counted segment, or with
    ``every`` of every title and line that is not blank.

    Segment 0 is the title up to the first ``|`` (the whole title if nothing stands before it),
    counted from six words on; segments 1, 2, ... are the lines of a transcript, counted from eight
    words on if the transcript has at least 50. ``stated`` is the language the row's label states, or
    null. Null and blank titles and lines have no segment; a segment without letters has a null
    language and confidence 0. Repeated rows of one video give each segment again. Rows are only
    mapped.
    """
    shared = videos.sparkSession.sparkContext.broadcast((model, names))
    schema = "video_id string, seg_no int, lang_code string, confidence double, stated string, counted boolean"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, names = shared.value
        words = WordTable(model.featurize)
        code = np.array([*model.codes, None], object)
        for batch in slices(batches):
            ids, numbers, texts, says, counts = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("video_id", "title", "transcript", "lang"))
            for video, title, transcript, lang in zip(*columns):
                own = []
                if title:
                    head = title.split("|", 1)[0]
                    own.append((0, head if head.strip() else title, len(head.split()) >= TITLE_WORDS))
                if transcript:
                    lines = transcript.split("\n")
                    sizes = [len(line.split()) for line in lines]
                    usable = sum(sizes) >= USABLE_WORDS
                    own += [(k, line, usable and n >= SEGMENT_WORDS) for k, (line, n) in enumerate(zip(lines, sizes), 1)]
                own = [x for x in own if x[2] or every and x[1].strip()]
                if own:
                    ids += [video] * len(own)
                    says += [stated(lang, names)] * len(own)
                    for number, text, counted in own:
                        numbers.append(number)
                        texts.append(text)
                        counts.append(counted)
            found, confidence = model.score(words, texts) if texts else (np.zeros(0, np.int64), np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.string()),
                    pa.array(numbers, pa.int32()),
                    pa.array(code[found].tolist(), pa.string()),
                    pa.array(confidence, pa.float64()),
                    pa.array(says, pa.string()),
                    pa.array(counts, pa.bool_()),
                ],
                ["video_id", "seg_no", "lang_code", "confidence", "stated", "counted"],
            )

    return videos.select("video_id", "title", "transcript", "lang").mapInArrow(label, schema)


def wrong_labels(videos: DataFrame, model: LanguageModel, languages: DataFrame) -> DataFrame:
    """``video_id, seg_no, lang_code`` of the counted segments in a language other than the stated one, or
    of all segments where none is stated; each segment once."""
    names = label_names(languages.toPandas())
    found = segments(videos, model, names).where("lang_code is not null and (stated is null or stated <> lang_code)")
    return found.groupBy("video_id", "seg_no").agg(F.min("lang_code").alias("lang_code"))


def labelled_segments(videos: DataFrame, model: LanguageModel, languages: DataFrame) -> DataFrame:
    """Every title and line that is not blank once, with its language and confidence, and whether it
    is counted. One without letters has the language ``und`` (undetermined) and confidence 0."""
    found = segments(videos, model, label_names(languages.toPandas()), every=True)
    best = F.max_by(F.struct("lang_code", "confidence", "stated", "counted"), F.struct("confidence", "lang_code"))
    return found.groupBy("video_id", "seg_no").agg(best.alias("b")).select("video_id", "seg_no", "b.*").fillna(UNDETERMINED, ["lang_code"])
