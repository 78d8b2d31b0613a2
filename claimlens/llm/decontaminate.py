"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Every benchmark item is a weighted set of word shingles (five words, weight: how often) with a SimHash of 255 bits.
A document is read through windows as long as the items are; a window's SimHash comes from running sums of
the signs of its shingles. Fingerprints are cut into 17 blocks of 15 bits. Two that differ in RADIUS = 63 bits at most
differ by four or more in 15 blocks at most, so two blocks at least differ by NEAR = 3 bits at most: items are kept in a
sorted array under all values one bit from their own, windows look up all values two bits from theirs, and items met in
two blocks (one in 24 of random ones) are candidates. These are compared exactly: sum of the lesser weights over sum of
the greater ones, at least 0.8.

Of a window's shingles at least 0.8 / 1.8 of both totals have to be some item's; windows with fewer are passed over, as no
item can be so similar to them. Items of fewer words than a shingle are one shingle, and so is a window of their length.
The benchmark is split into blocks of bounded size; each is broadcast by itself and meets all documents in one pass.

The radius is met with all but 1e-5 by sets of shingles that are alike by 0.8. One shingle that makes up much of a window
weighs more in a fingerprint than in the similarity, so there a window just above 0.8 can be missed.

Defined results: null or empty texts and items match nothing; texts of fewer words than a shingle are one
shingle; repeated rows of a document give repeated rows; items that repeat are reported each; an empty table
gives an empty result; A-Z count as a-z; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm import hashing
from claimlens.llm.common import table

SHINGLE = 5
SIMILARITY = 0.8
#: Blocks of a fingerprint and bits of each.
BLOCKS, BITS = 17, 15
#: Of 255 bits. A window of similarity 0.8 differs in more with a chance of 1e-5 (binomial tail at acos(8 / 9) / pi).
RADIUS = 63
#: By so many bits two blocks may differ that agree: items give one of them, windows the rest.
NEAR = 3
#: In so many blocks any two fingerprints within the radius agree.
AGREE = BLOCKS - RADIUS // (NEAR + 1)
#: A broadcast block of the benchmark holds about so many bytes of text.
BLOCK_BYTES = 8 << 20
#: Window starts of one text that are looked at together.
PIECE = 1 << 14
#: Block values that are looked up together.
PROBES = 1 << 20

_WORD = np.arange(64, dtype=np.uint64)
_SALTS = np.random.default_rng(20240229).integers(1, 1 << 63, 4, np.uint64)


def signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 256 bits that each hash stands for."""
    wide = hashing.mixed(h[:, None] ^ _SALTS)
    return ((wide[:, :, None] >> _WORD) & np.uint64(1)).astype(np.int32).reshape(len(h), 256) * 2 - 1


def fingerprints(votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(four words, blocks) of each row of summed signs; of 256 bits the last isn't used."""
    bits = votes > 0
    bits[:, -1] = False
    blocks = bits[:, :-1].reshape(-1, BLOCKS, BITS) @ (1 << np.arange(BITS))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), (blocks + (np.arange(BLOCKS) << BITS)).astype(np.uint32)


def flips(most: int) -> np.ndarray:
    """Block values with `most` bits at most."""
    v = np.arange(1 << BITS, dtype=np.uint32)
    return v[np.bitwise_count(v) <= most]


class Blocks:
    """The multi-index of items of one length: their block values, and those one bit from them, in a sorted array."""

    def __init__(self, prints: np.ndarray, blocks: np.ndarray) -> None:
        self.prints = prints
        keys = (blocks[:, :, None] ^ flips(1)).reshape(-1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], order // (BLOCKS * (BITS + 1))
        # most values that windows ask for are no item's: one bit for each value tells before the array is searched
        marks = np.zeros(BLOCKS << BITS, bool)
        marks[self.keys] = True
        self.marks = np.packbits(marks, bitorder="little")
        self.probes = flips(NEAR - 1)

    def candidates(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of those that agree in AGREE blocks at least."""
        n = len(self.prints)
        step = max(1, min(PROBES // (BLOCKS * len(self.probes)), PROBES // n))
        out = []
        for first in range(0, len(blocks), step):
            asked = (blocks[first : first + step, :, None] ^ self.probes).reshape(-1)
            at = np.flatnonzero(self.marks[asked >> 3] >> (asked & 7).astype(np.uint8) & 1)
            low = np.searchsorted(self.keys, asked[at])
            many = np.searchsorted(self.keys, asked[at], side="right") - low
            place = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            # a block counts once, by however many ways it was met
            met = np.unique(np.repeat(at // len(self.probes), many) * n + self.items[place])
            pair, blocks_met = np.unique(met // (BLOCKS * n) * n + met % n, return_counts=True)
            out.append(pair[blocks_met >= AGREE] + first * n)
        pairs = np.concatenate(out) if out else np.zeros(0, np.int64)
        return pairs // n, pairs % n

    def near(self, prints: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of those within the radius."""
        window, item = self.candidates(blocks)
        close = np.bitwise_count(prints[window] ^ self.prints[item]).sum(1) <= RADIUS
        return window[close], item[close]


class Index:
    """One block of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], size: int = SHINGLE) -> None:
        self.size, self.ids, self.weights, self.lengths, votes = size, [], [], [], []
        #: of items shorter than a shingle, by length: which item a run of so many words is
        self.short: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for w in hashing.words([t for _, t in items], fold=True):
            own, h = hashing.shingles(w, size)
            for k in range(w.last - w.first):
                mine, n_words = h[own == k], int(w.offsets[k + 1] - w.offsets[k])
                if 0 < n_words < size:
                    self.short[n_words][int(mine[0])].append(items[w.first + k][0])
                elif len(mine):
                    self.ids.append(items[w.first + k][0])
                    self.weights.append(Counter(mine.tolist()))
                    self.lengths.append(n_words)
                    votes.append(signs(mine).sum(0))
        self.vocabulary = np.array(sorted({h for c in self.weights for h in c}), np.uint64)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.vocabulary & np.uint64((1 << 22) - 1)] = True
        by: dict[int, list[int]] = defaultdict(list)
        for i, n in enumerate(self.lengths):
            by[n].append(i)
        self.by_length = {n: (np.array(own), Blocks(*fingerprints(np.stack([votes[i] for i in own])))) for n, own in by.items()}

    def known(self, h: np.ndarray) -> np.ndarray:
        """Which hashes are shingles of any item."""
        out = self.seen[h & np.uint64((1 << 22) - 1)]
        at = np.flatnonzero(out)
        place = np.searchsorted(self.vocabulary, h[at])
        out[at] = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == h[at]
        return out

    def short_matches(self, w: hashing.Words) -> list[tuple]:
        """(text, item, similarity, first word, end) of items shorter than a shingle, at their first place in each text."""
        run, of, found = hashing.Runs(w.hashes), w.text_of(), {}
        for n, known in self.short.items():
            start = np.arange(max(0, len(w.hashes) - n + 1))
            start = start[of[start] == of[start + n - 1]]
            h = run.between(start, start + n)
            for j in np.flatnonzero(np.isin(h, np.array(list(known), np.uint64))).tolist():
                text = int(of[start[j]])
                for item in known[int(h[j])]:
                    at = int(start[j] - w.offsets[text])
                    found.setdefault((text, item), (w.first + text, item, 1.0, at, at + n))
        return sorted(found.values(), key=lambda r: (r[0], r[3]))

    def matches(self, h: np.ndarray, hit: np.ndarray, n_words: int, least: float = SIMILARITY) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word, end) of its best window in a text with shingles h."""
        best: dict[int, tuple[float, int, int]] = {}
        for at in range(0, len(h), PIECE):  # windows that start in this piece of a long text
            reach = at + PIECE + max(self.lengths)
            if hit[at:reach].any():
                for i, (similar, s, e) in self._piece(h[at:reach], hit[at:reach], min(PIECE, len(h) - at), n_words, least).items():
                    if i not in best or similar > best[i][0]:
                        best[i] = (similar, s + at, e + at)
        return best

    def _piece(self, h: np.ndarray, hit: np.ndarray, n_starts: int, n_words: int, least: float) -> dict[int, tuple[float, int, int]]:
        best: dict[int, tuple[float, int, int]] = {}
        hits = np.concatenate([[0], np.cumsum(hit)])
        open_: list[tuple[int, int, np.ndarray]] = []
        for length in self.by_length:
            span = max(1, min(length, n_words) - self.size + 1)  # shingles in a window
            shared = hits[span:] - hits[: len(hits) - span]  # no more can be shared with an item
            starts = np.flatnonzero(shared * (1 + least) >= least * (span + length - self.size + 1) - 1e-9)
            starts = starts[starts < n_starts]
            if len(starts):
                open_.append((length, span, starts))
        if not open_:
            return best
        begin = min(int(s[0]) for *_, s in open_)
        end = max(int(s[-1]) + span for _, span, s in open_)
        votes = np.zeros((end - begin + 1, 256), np.int32)
        np.cumsum(signs(h[begin:end]), axis=0, out=votes[1:])
        for length, span, starts in open_:
            items, table_of = self.by_length[length]
            for some in np.split(starts, range(1024, len(starts), 1024)):
                at, which = table_of.near(*fingerprints(votes[some + span - begin] - votes[some - begin]))
                for i, s in zip(items[which].tolist(), some[at].tolist(), strict=True):
                    own, item = Counter(h[s : s + span].tolist()), self.weights[i]
                    both = sum(min(c, item[x]) for x, c in own.items() if x in item)
                    similar = both / (own.total() + item.total() - both)
                    if similar >= least and (i not in best or similar > best[i][0]):
                        best[i] = (similar, s, s + min(length, n_words))
        return best


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, similarity and the best window (start_word, end_word) of each document and item whose
    similarity is at least `least` (0.8 or more: the radius is made for that)."""
    if least < SIMILARITY:
        raise ValueError(f"fingerprints find similarities of {SIMILARITY} or more, not {least}")
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, start_word bigint, end_word bigint"
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kinds[1]]
    out = []
    for b in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast([tuple(r) for r in part])

        def work(batches, shared=shared):
            index = Index(shared.value)
            for batch in batches:
                rows: list[tuple] = []
                if index.ids or index.short:
                    for w in hashing.words(batch.column(1).to_pylist(), fold=True):
                        rows += index.short_matches(w)
                        if not index.ids:
                            continue
                        own, h = hashing.shingles(w, index.size)
                        hit = index.known(h)
                        n = np.diff(w.offsets)
                        for k in np.unique(own[hit]).tolist():
                            mine = slice(*np.searchsorted(own, [k, k + 1]))
                            for i, (similar, s, e) in sorted(index.matches(h[mine], hit[mine], int(n[k]), least).items()):
                                rows.append((w.first + k, index.ids[i], similar, s, e))
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([r[1] for r in rows], id_type), *(pa.array([r[j] for r in rows], t) for j, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64())))], names=["doc_id", "item_id", "similarity", "start_word", "end_word"])

        out.append(docs.select("doc_id", "text").mapInArrow(work, schema))
    if not out:
        return spark.createDataFrame([], schema)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def op5(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
