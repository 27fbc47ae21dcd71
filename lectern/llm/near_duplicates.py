"""Near-duplicate records by a chosen-path set similarity join.

A record is the set of its runs of five words. Records of equal sets are one class. Each class gets
a fixed number of minwise tokens; independent trees branch the classes by selected ones of them: two
at the root, then one at a time, on several branches, for as long as a node is large and still
falls apart. Small nodes are compared exhaustively by a 128-bin one-permutation sketch, and what
may reach the likeness is checked exactly on the sets. A large node that keeps half of its parent
is dense: its records agree on most tokens, so they are mostly partners and branching it further
is no use; dense nodes are compared exhaustively too, in blocks spread over tasks. As every other
node has less than half of its parent's records, the depth follows from the size, and no node,
bucket or number of partners is capped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .language import USABLE_WORDS
from .words import WordTable, slices

WORDS = 5
TREES = 20
#: Each tree has two root tokens of its own, so trees fail independently.
COORDINATES = 2 * TREES
#: Of a minwise token 16 bits are kept: two make a root, and chance meetings in one stay rare.
BRANCHES = 3
#: Nodes of at most so many classes are compared in one task; larger ones branch.
LEAF = 64
#: A large node with so much of its parent is dense.
DENSE = 0.5
#: Dense nodes, and texts to be checked, are worked on in blocks of about so many.
BLOCK = 512
#: At most so many rows stand for the bits of the ids that are to be checked: 4 MB, broadcast.
BIT_WORDS = 1 << 18
#: Standard deviations by which the sketch may fall short of the likeness.
SLACK = 4.0

_RUN = re.compile(r"[^\W_]+")
_M = 0xFFFFFFFFFFFFFFFF
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def shingles(table: WordTable, texts: list[str], whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Flat distinct shingle hashes of each text, sorted within a text, and how many each has. A text
    of fewer words than a shingle has none, or with ``whole`` one of all its words."""
    split = [_RUN.findall(t.lower()) for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    rows = table.rows([w for s in split for w in s])
    word = table.features[rows]
    total = max(0, len(word) - WORDS + 1)
    rolling = np.zeros(total, np.uint64)
    for k in range(WORDS if total else 0):
        rolling = rolling * _A + word[k : k + total]
    each = np.maximum(sizes - WORDS + 1, 0)
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts - (np.cumsum(each) - each), each) + np.arange(each.sum())
    flat = _mix(rolling[at])
    edges = np.concatenate([[0], np.cumsum(each)])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        flat[a:b].sort()
    owner = np.repeat(np.arange(len(texts)), each)
    first = np.ones(len(flat), bool)
    first[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    flat, each = flat[first], np.bincount(owner[first], minlength=len(texts))
    if whole and len(bare := np.flatnonzero(each == 0)):
        own = word_hashes([" ".join(split[k]) or " ".join(texts[k].split()) for k in bare])
        flat = np.insert(flat, (np.cumsum(each) - each)[bare], _mix(own))
        each[bare] = 1
    return flat, each


def signatures(flat: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """For texts with one shingle at least: hashes of the set, minwise tokens, sketch bits and bins."""
    starts = np.cumsum(sizes) - sizes
    tokens = np.empty((len(sizes), COORDINATES), np.uint16)
    for k in range(COORDINATES):
        seeded = (flat ^ np.uint64((k + 1) * 0xD6E8FEB86659FD93 & _M)) * (_B + np.uint64(2 * k))
        tokens[:, k] = np.minimum.reduceat(seeded ^ (seeded >> np.uint64(29)), starts) & np.uint64(0xFFFF)
    bins = flat >> np.uint64(57)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    lead = np.ones(len(flat), bool)
    lead[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
    place = np.uint64(1) << (bins & np.uint64(63))
    out = {"tokens": tokens, "c0": np.bitwise_xor.reduceat(_mix(flat ^ _A), starts), "c1": np.add.reduceat(_mix(flat ^ _B), starts)}
    for half in (0, 1):
        here = lead & ((bins >> np.uint64(6)) == half)
        out[f"m{half}"] = np.bitwise_or.reduceat(np.where(here, place, np.uint64(0)), starts)
        out[f"s{half}"] = np.bitwise_or.reduceat(np.where(here & ((flat >> np.uint64(20)) & np.uint64(1) == 1), place, np.uint64(0)), starts)
    return out


def _usable(batch: pa.RecordBatch, words: int) -> tuple[list[str], list[int], list[str]]:
    ids, picks, texts = [], [], []
    for video, pick, title, text in zip(*(batch.column(c).to_pylist() for c in ("video_id", "pick", "title", "transcript"))):
        if video is not None and text and len(text.split()) >= words:
            ids.append(video)
            picks.append(pick)
            texts.append(f"{title or ''}\n{text}")
    return ids, picks, texts


SIGNED = "video_id string, pick long, c0 long, c1 long, n int, tokens array<smallint>, s0 long, s1 long, m0 long, m1 long"


def _sign(batches: Iterator[pa.RecordBatch], least: int, whole: bool) -> Iterator[pa.RecordBatch]:
    table = WordTable(word_hashes)
    for batch in slices(batches):
        ids, picks, texts = _usable(batch, least)
        flat, sizes = shingles(table, texts, whole) if texts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        some = np.flatnonzero(sizes)
        if not len(some):
            continue
        s = signatures(flat, sizes[some])
        tokens = pa.ListArray.from_arrays(
            pa.array(np.arange(len(some) + 1) * COORDINATES, pa.int32()), pa.array(s["tokens"].ravel().view(np.int16))
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[k] for k in some], pa.string()), pa.array([picks[k] for k in some], pa.int64()), *(pa.array(s[c].view(np.int64)) for c in ("c0", "c1")),
                pa.array(sizes[some], pa.int32()), tokens, *(pa.array(s[c].view(np.int64)) for c in ("s0", "s1", "m0", "m1")),
            ],
            ["video_id", "pick", "c0", "c1", "n", "tokens", "s0", "s1", "m0", "m1"],
        )


def _check(batches: Iterator[pa.RecordBatch], likeness: float, whole: bool) -> Iterator[pa.RecordBatch]:
    """Pairs that have the likeness. Rows come by tile, the texts of a tile (``b`` null) before its pairs."""
    table = WordTable(word_hashes)
    sets: dict[int, np.ndarray] = {}
    last = None
    for batch in slices(batches):
        tile, a, other = (batch.column(c).to_pylist() for c in ("tile", "a", "b"))
        at = [k for k, b in enumerate(other) if b is None]
        texts = batch.take(pa.array(at, pa.int64()))
        words = [f"{x or ''}\n{y}" for x, y in zip(texts.column("title").to_pylist(), texts.column("transcript").to_pylist())]
        flat, sizes = shingles(table, words, whole) if at else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        ends = np.cumsum(sizes)
        found, n = [], 0
        for k, b in enumerate(other):
            if tile[k] != last:
                last, sets = tile[k], {}
            if b is None:
                sets[a[k]] = flat[ends[n] - sizes[n] : ends[n]]
                n += 1
            else:
                x, y = sets[a[k]], sets[b]
                both = np.sort(np.concatenate([x, y]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if common >= likeness * (len(both) - common):
                    found.append((a[k], b, common / (len(both) - common)))
        yield pa.RecordBatch.from_pylist(
            [{"a": x, "b": y, "likeness": v} for x, y, v in found], pa.schema([("a", pa.int64()), ("b", pa.int64()), ("likeness", pa.float64())])
        )


class Duplicates:
    """The join over one table of ``video_id, title, transcript``.

    Only rows with an id and a transcript of at least 50 words and one shingle take part, or with
    ``every`` those with an id and a transcript that is not blank, where a text too short for a
    shingle is like exact copies only; a null title counts as empty. If rows of one video differ in
    text, the one of the smallest hash of title and transcript counts. An empty table gives no pairs.
    Other columns are pruned.
    """

    def __init__(self, videos: DataFrame, likeness: float, every: bool = False):
        texts = videos.select("video_id", "title", "transcript").where("length(transcript) > 0")
        self.texts, self.likeness, self.every = texts.withColumn("pick", F.xxhash64("title", "transcript")), likeness, every
        least = 1 if every else USABLE_WORDS
        signed = self.texts.mapInArrow(lambda batches: _sign(batches, least, every), SIGNED)
        rest = [c for c in signed.columns if c != "video_id"]
        one = signed.groupBy("video_id").agg(F.min(F.struct(*rest)).alias("s")).select("video_id", "s.*")
        each = cut(one)
        first = F.min(F.struct("video_id", "pick", *rest[3:])).alias("s")
        heads = each.groupBy("c0", "c1").agg(first, F.count(F.lit(1)).alias("copies")).select("c0", "c1", "copies", "s.*")
        self.classes = cut(heads.withColumn("doc", F.monotonically_increasing_id()))
        #: doc (number of the class), head (its first video), copies (its videos), video_id
        named = self.classes.select("c0", "c1", "doc", F.col("video_id").alias("head"), "copies")
        self.members = each.select("c0", "c1", "video_id").join(named, ["c0", "c1"]).drop("c0", "c1")

    def _may(self, a: str, b: str) -> Column:
        """Whether sketch and sizes of two rows allow the likeness."""
        agree, bins = F.lit(0), F.lit(0)
        for half in ("0", "1"):
            held = F.col(f"{a}.m{half}").bitwiseOR(F.col(f"{b}.m{half}"))
            same = F.bitwise_not(F.col(f"{a}.s{half}").bitwiseXOR(F.col(f"{b}.s{half}")))
            agree = agree + F.bit_count(same.bitwiseAND(held))
            bins = bins + F.bit_count(held)
        p = (1 + self.likeness) / 2
        near = agree >= p * bins - SLACK * (p * (1 - p)) ** 0.5 * F.sqrt(bins)
        small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
        return near & (small >= self.likeness * large)

    def _compare(self, rows: DataFrame, keys: list[str], once: Callable[[str, str], Column] | None = None) -> DataFrame:
        """Pairs of classes within equal ``keys`` that may reach the likeness."""
        sketched = rows.join(self.classes.select("doc", "n", "s0", "s1", "m0", "m1"), "doc")
        on = F.col("a.doc") < F.col("b.doc")
        for key in keys:
            on = on & (F.col(f"a.{key}") == F.col(f"b.{key}"))
        if once is not None:
            on = on & once("a", "b")
        pairs = sketched.alias("a").join(sketched.alias("b"), on & self._may("a", "b"))
        return pairs.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b"))

    def candidates(self) -> DataFrame:
        """Distinct pairs of classes, ``a < b``, from all trees."""
        spark = self.texts.sparkSession
        roots = [F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.col("tokens")[2 * t], F.col("tokens")[2 * t + 1]).alias("node")) for t in range(TREES)]
        rows = self.classes.select("doc", F.explode(F.array(*roots)).alias("r")).select("doc", "r.tree", "r.node", F.lit(None).cast("long").alias("parent"))
        found, dense, level = spark.createDataFrame([], "a long, b long"), None, 0
        while True:
            sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            kept = cut(rows.join(sizes, "node"))
            found = found.unionByName(self._compare(kept.where(F.col("size") <= LEAF).select("node", "doc"), ["node"]))
            large = kept.where(F.col("size") > LEAF)
            # a tree reads a token once, so what is large when all are used stays as it is
            spent = COORDINATES - 2 < BRANCHES * (level + 1)
            whole = F.coalesce(F.col("size") >= DENSE * F.col("parent"), F.lit(False)) | F.lit(spent)
            ended = large.where(whole).select("node", "doc")
            dense = ended if dense is None else dense.unionByName(ended)
            large = large.where(~whole)
            if large.isEmpty():
                break
            at = [(F.col("tree") * 2 + 2 + BRANCHES * level + k) % COORDINATES for k in range(BRANCHES)]
            tokens = self.classes.select("doc", "tokens")
            branches = F.array(*(F.xxhash64("node", F.lit(k), F.get("tokens", c)) for k, c in enumerate(at)))
            rows = large.join(tokens, "doc").select("doc", "tree", F.explode(branches).alias("node"), F.col("size").alias("parent"))
            level += 1
        return found.unionByName(self._in_blocks(dense)).distinct()

    def _in_blocks(self, dense: DataFrame) -> DataFrame:
        """Pairs within dense nodes. The trees find much the same dense nodes again and again, so those
        that share their member of the smallest hash are compared as one, which holds all of them."""
        order = F.struct(F.xxhash64("doc"), "doc")
        first = dense.groupBy("node").agg(F.min_by("doc", order).alias("group"))
        joined = dense.join(first, "node").select("group", "doc").distinct()
        sizes = joined.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        placed = joined.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("blocks")).cast("int"))
        spread = placed.select("group", "doc", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        spread = spread.select("group", "doc", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        # two rows of one block meet in each of its pairings; they are compared where it meets itself
        once = lambda a, b: (F.col(f"{a}.low") == F.col(f"{a}.high")) | (F.col(f"{a}.own") != F.col(f"{b}.own"))
        return self._compare(spread, ["group", "low", "high"], once)

    def _texts_of(self, docs: DataFrame) -> DataFrame:
        """``doc, title, transcript`` of classes ``docs``. The scan is held against a table of bits of their
        hashes first, of bounded size, so that hardly any other text is shuffled."""
        named = self.classes.select("doc", "video_id", "pick").join(docs, "doc", "left_semi")
        slot = F.pmod(F.xxhash64("video_id", "pick"), F.lit(BIT_WORDS << 6))
        bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
        marks = named.withColumn("slot", slot).select(F.shiftright("slot", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        slotted = self.texts.withColumn("slot", slot).withColumn("word", F.shiftright("slot", 6))
        near = slotted.join(F.broadcast(marks), "word").where(F.col("bits").bitwiseAND(bit) != 0)
        # repeated rows of a video are one before the shuffle
        texts = near.groupBy("video_id", "pick").agg(F.first("title").alias("title"), F.first("transcript").alias("transcript"))
        return texts.join(named, ["video_id", "pick"]).select("doc", "title", "transcript")

    def class_pairs(self) -> DataFrame:
        """``a, b, likeness`` of every pair of different classes found that has the likeness exactly.

        Pairs are checked in tiles, so that a text is shuffled and cut into shingles once a tile and not
        once a pair: a tile holds the pairs whose first class has one least partner, split into blocks
        where those are many."""
        pairs = cut(self.candidates())
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lead = both.groupBy(F.col("a").alias("doc")).agg(F.least(F.min("b"), F.col("a")).alias("lead"))
        blocks = lead.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        led = pairs.join(lead.join(blocks, "lead").withColumnRenamed("doc", "a"), "a")
        block = lambda c: F.pmod(F.xxhash64(c), F.col("blocks"))
        tiled = cut(led.select(F.xxhash64("lead", block("a"), block("b")).alias("tile"), "a", "b"))
        needed = tiled.select("tile", F.col("a").alias("doc")).union(tiled.select("tile", "b")).distinct()
        texts = needed.join(self._texts_of(needed.select("doc").distinct()), "doc")
        rows = texts.select("tile", F.col("doc").alias("a"), F.lit(None).cast("long").alias("b"), "title", "transcript")
        rows = rows.unionByName(tiled.withColumn("title", F.lit(None).cast("string")).withColumn("transcript", F.lit(None).cast("string")))
        ordered = rows.repartition(F.col("tile")).sortWithinPartitions("tile", F.asc_nulls_first("b"))
        likeness, whole = self.likeness, self.every
        return ordered.mapInArrow(lambda batches: _check(batches, likeness, whole), "a long, b long, likeness double")

    def pairs(self, expand: int | None) -> DataFrame:
        """``video_id_a, video_id_b`` (a < b by code point) of all videos, copies among them.

        ``expand`` says what becomes of classes of exact copies. None: every pair of every two videos,
        whose number grows with the square of a class. 1: a copy is paired with the first video of its
        class only, and links to other texts stand for that video, so the result stays in proportion; with
        ``groups`` all pairs follow from it. Any other number: all pairs in classes of at most so
        many videos, the short form in larger ones. No link between different texts is lost.
        """
        full = F.lit(True) if expand is None else F.col("copies") <= expand
        shown = self.members.where(full | (F.col("video_id") == F.col("head"))).select("doc", "video_id")
        a, b = shown.toDF("a", "va"), shown.toDF("b", "vb")
        across = self.class_pairs().join(a, "a").join(b, "b")
        across = across.select(F.least("va", "vb").alias("video_id_a"), F.greatest("va", "vb").alias("video_id_b"))
        several = self.members.where(full & (F.col("copies") > 1)).select("doc", "video_id")
        a, b = several.toDF("a", "va"), several.toDF("b", "vb")
        within = a.join(b, (F.col("a") == F.col("b")) & (F.col("va") < F.col("vb"))).select(F.col("va").alias("video_id_a"), F.col("vb").alias("video_id_b"))
        many = self.members.where(~full & (F.col("video_id") != F.col("head")))
        return across.unionByName(within).unionByName(many.select(F.col("head").alias("video_id_a"), F.col("video_id").alias("video_id_b")))

    def groups(self) -> DataFrame:
        """One row a video that takes part: ``video_id``, ``class_id`` (the first video of its exact copies),
        ``n_links`` (other classes like it) and ``group_id`` (the first video that links reach)."""
        links = self.class_pairs().select("a", "b")
        both = cut(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        degree = both.groupBy(F.col("a").alias("doc")).agg(F.count(F.lit(1)).alias("n_links"))
        label = cut(self.classes.select("doc", F.col("video_id").alias("class_id"), F.col("video_id").alias("group_id")))
        while True:
            heard = both.join(label.select(F.col("doc").alias("b"), F.col("group_id").alias("heard")), "b").groupBy(F.col("a").alias("doc")).agg(F.min("heard").alias("heard"))
            merged = label.join(heard, "doc", "left").select("doc", "class_id", "group_id", F.least("group_id", "heard").alias("lower"))
            # what the group's own head has heard is passed on at once
            heads = merged.where("class_id <> lower or class_id <> group_id").select(F.col("class_id").alias("lower"), F.col("lower").alias("jump"))
            jumped = cut(merged.join(heads, "lower", "left").select("doc", "class_id", F.least("lower", "jump").alias("next"), "group_id"))
            moved = not jumped.where("next <> group_id").isEmpty()
            label = jumped.select("doc", "class_id", F.col("next").alias("group_id"))
            if not moved:
                break
        rows = self.members.select("doc", "video_id").join(label, "doc").join(degree, "doc", "left")
        return rows.select("video_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id")
