"""Language-model scoring by deleted interpolation.

An n-gram model of orders 0 to 2 over words: the probability of a word after another is a mix of the
bigram's and the word's maximum-likelihood estimates and of the smoothed base model (add 0.1). The mixing
weights depend on how often the context was seen: contexts are put in buckets of frequency (powers of two),
and each bucket's weights are learned by expectation-maximisation on held-out counts: a fold of the training
documents, each counted against the training corpus without itself (its own n-grams are deleted from the
counts). Documents outside the training rows take no part in any of this.

How it is spread: documents are dealt into blocks by a hash of their id. A block sends the distinct n-gram
hashes of its training documents with their counts, and those of its other documents to ask for, to shards
of the n-gram space; a shard adds the counts up and answers each block in the order it asked. No shard sees
an n-gram more than once from one block, however frequent it is, and neither blocks nor shards grow: their
number does, with the corpus. Where more than FAN of them are needed, n-grams take several hops: a relay gets
those of one coarse range from some blocks, adds them up and sends them on by finer ranges, and the answers
come back the same way. So a task sends FAN rows at most, and rows grow in proportion to the corpus (times hops).

Hashes are 64 bits; two n-grams that share one share their count.

Defined results: a null or empty text is one end token; a null doc_id has remainder 0 and is held out;
repeated rows each count; without training documents N = V = 0 and every base probability is 1; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm import hashing
from claimlens.llm.common import saved, table
from claimlens.llm.repeats import unzipped

#: Least and most text of a block, and of what a shard's n-grams stem from, in bytes: both grow with the corpus
#: up to what a task holds easily, so that blocks times shards don't grow with its square any sooner.
BLOCK_BYTES = 6 << 20, 32 << 20
SHARD_BYTES = 12 << 20, 32 << 20
#: A block or relay sends to so many receivers at most.
FAN = 1024
#: Of training documents, those with this remainder are held out to learn the weights.
EM_FOLD = 1
#: Context frequencies 0, 1, 2-3, 4-7, ... have a bucket each; the last takes the rest.
BUCKETS = 24
ROUNDS = 40
#: Held-out tokens are counted by bucket and by both estimates, the logarithms (base 2) in steps of 1 / GRAIN.
GRAIN = 8

END = np.uint64(0x2545F4914F6CDD1D)


def fold_of(doc_id: Column, folds: int = 10) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds).cast("int")


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the words' hashes with an end after each text, the hashes of each token with the one
    before it (an end before the first), and where each text begins."""
    parts, sizes = [], []
    for w in hashing.words(texts, fold=True):
        n = np.diff(w.offsets)
        out = np.full(int(n.sum()) + len(n), END, np.uint64)
        at = np.arange(len(w.hashes)) + np.repeat(np.arange(len(n)), n)
        out[at] = w.hashes
        parts.append(out)
        sizes.append(n + 1)
    word = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
    before = np.concatenate([[END], word[:-1]])
    return word, hashing.mixed(before * np.uint64(0x9E3779B97F4A7C15) ^ word), offsets.astype(np.int64)


def packed(h: np.ndarray, counts: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Sorted hashes as differences, and counts, in columns of bytes that compress."""
    gaps = np.diff(h, prepend=np.uint64(0))
    return pack.compress(planes(gaps) + planes(counts))


def planes(values: np.ndarray) -> bytes:
    """First the lowest bytes of all 64-bit values, then the next, ..."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplaned(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(8, -1).T).view(np.int64).reshape(-1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    half = len(body) // 2
    return np.cumsum(unplaned(body[:half]).view(np.uint64), dtype=np.uint64), unplaned(body[half:])


class Grams:
    """Distinct n-grams of a block, sorted, for one order, with their counts in training documents."""

    def __init__(self, h: np.ndarray, train: np.ndarray) -> None:
        self.all = np.unique(h)
        known, counts = np.unique(h[train], return_counts=True)
        self.counts = np.zeros(len(self.all), np.int64)
        self.counts[np.searchsorted(self.all, known)] = counts


def packets(grams: list[tuple[np.ndarray, np.ndarray]], first: int, n: int, ranges: int) -> tuple[np.ndarray, list[pa.Array]]:
    """The n-grams (hashes, sorted, and counts; one pair for each order) packed by equal ranges of the hash space, of
    which there are `ranges`; those from `first` on, n of them, hold all. Numbers of the ranges that have any."""
    pack = zstandard.ZstdCompressor(level=1)
    edges = np.array([((first + s) << 64) // ranges for s in range(1, n)], np.uint64)
    cols, sizes = [], np.zeros(n, np.int64)
    for h, counts in grams:
        cut = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
        sizes += np.diff(cut)
        cols.append([packed(h[a:b], counts[a:b], pack) for a, b in zip(cut[:-1], cut[1:], strict=True)])
    some = np.flatnonzero(sizes)
    return some + first, [pa.array(c, pa.binary()).take(pa.array(some)) for c in cols]


def merged(packets_of: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of several packets, the sums of their counts, and where each packet's hashes stand among them."""
    got = [unpacked(x) for x in packets_of]
    known, back = np.unique(np.concatenate([h for h, _ in got]), return_inverse=True)
    total = np.bincount(back, np.concatenate([c for _, c in got]), len(known)).astype(np.int64)
    return known, total, np.split(back, np.cumsum([len(h) for h, _ in got])[:-1])


def _blocked(docs: DataFrame, n_blocks: int) -> DataFrame:
    ids = F.col("doc_id")
    block = F.pmod(F.xxhash64(F.lit(5), ids, F.coalesce(F.octet_length("text"), F.lit(0))), F.lit(n_blocks)).cast("int")
    rows = docs.select(block.alias("_block"), ids.alias("_id"), fold_of(ids).alias("_fold"), "text")
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = pa.array([pack.compress(b"" if t is None else t.encode("utf-8", "surrogatepass")) for t in b.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), z], names=["_block", "_id", "_fold", "_z"])

    return rows.mapInArrow(work, f"_block int, _id {kind}, _fold int, _z binary")


def _ordered(one: pa.Table) -> pa.Table:
    return one.sort_by([("_id", "ascending"), ("_z", "ascending")])


def trained(one: pa.Table) -> np.ndarray:
    return one.column("_fold").to_numpy() != 0


SENT = "_shard long, _batch long, _from long, _words binary, _pairs binary"
ANSWERED = "_to_shard long, _to long, _shard long, _words binary, _pairs binary, _n long, _v long"


def _requests(blocked: DataFrame, n_shards: int, group: int) -> DataFrame:
    """The unigrams and bigrams of each block, packed by range (_shard) for the relay or shard that serves `group` blocks."""

    def work(one: pa.Table) -> pa.Table:
        one = _ordered(one)
        word, pair, offsets = tokens(unzipped(one.column("_z").to_pylist()))
        train = np.repeat(trained(one), np.diff(offsets))
        grams = [Grams(h, train) for h in (word, pair)]
        some, cols = packets([(g.all, g.counts) for g in grams], 0, n_shards, n_shards)
        block = one.column("_block")[0].as_py()
        return pa.table({"_shard": pa.array(some), "_batch": pa.array([block // group] * len(some), pa.int64()), "_from": pa.array([block] * len(some), pa.int64()), "_words": cols[0], "_pairs": cols[1]})

    return blocked.groupBy("_block").applyInArrow(work, SENT)


def _by_sender(one: pa.Table, shard: int, fan: int, columns: list, seen: tuple[int, int]) -> pa.Table:
    n = one.num_rows
    return pa.table({"_to_shard": pa.array([shard // fan] * n, pa.int64()), "_to": one.column("_from"), "_shard": pa.array([shard] * n, pa.int64()), "_words": pa.array(columns[0], pa.binary()), "_pairs": pa.array(columns[1], pa.binary()), "_n": pa.array([seen[0]] * n, pa.int64()), "_v": pa.array([seen[1]] * n, pa.int64())})


def answered(requests: DataFrame, hops: int, fan: int, group: int, ranges: int) -> tuple[DataFrame, int, int]:
    """For each sender and range, in the order of its request, the corpus counts; and the corpus's tokens and words.

    hops: how many are left; fan: into how many ranges a relay splits its own; group: how many senders it serves."""

    def shard(key: tuple, one: pa.Table) -> pa.Table:
        pack = zstandard.ZstdCompressor(level=1)
        cols, seen = [], (0, 0)
        for name in ("_words", "_pairs"):
            _, total, places = merged(one.column(name).to_pylist())
            seen = (int(total.sum()), int((total > 0).sum())) if name == "_words" else seen
            cols.append([pack.compress(planes(total[at])) for at in places])
        return _by_sender(one, key[0].as_py(), fan, cols, seen)

    if hops == 1:
        out = saved(requests.groupBy("_shard", "_batch").applyInArrow(shard, ANSWERED))
        sums = out.groupBy("_shard").agg(F.first("_n").alias("_n"), F.first("_v").alias("_v")).agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_v"), F.lit(0))).first()
        return out, sums[0], sums[1]

    requests = saved(requests)

    def forward(key: tuple, one: pa.Table) -> pa.Table:
        own, batch = key[0].as_py(), key[1].as_py()
        some, cols = packets([merged(one.column(name).to_pylist())[:2] for name in ("_words", "_pairs")], own * fan, fan, ranges * fan)
        return pa.table({"_shard": pa.array(some), "_batch": pa.array([batch // group] * len(some), pa.int64()), "_from": pa.array([batch] * len(some), pa.int64()), "_words": cols[0], "_pairs": cols[1]})

    back, n, v = answered(requests.groupBy("_shard", "_batch").applyInArrow(forward, SENT), hops - 1, fan, group, ranges * fan)

    def backward(key: tuple, one: pa.Table, answers: pa.Table) -> pa.Table:
        pack = zstandard.ZstdCompressor(level=1)
        answers, cols = answers.sort_by("_shard"), []
        for name in ("_words", "_pairs"):
            _, _, places = merged(one.column(name).to_pylist())
            total = np.concatenate([unplaned(np.frombuffer(x, np.uint8)) for x in unzipped(answers.column(name).to_pylist())])
            cols.append([pack.compress(planes(total[at])) for at in places])
        return _by_sender(one, key[0].as_py(), fan, cols, (0, 0))

    both = requests.groupBy("_shard", "_batch").cogroup(back.groupBy("_to_shard", "_to"))
    return saved(both.applyInArrow(backward, ANSWERED)), n, v


def split(n: int, hops: int) -> int:
    """The least number of which the power to `hops` is n at least."""
    out = max(1, round(n ** (1 / hops)))
    return next(k for k in range(max(1, out - 1), out + 3) if k**hops >= n)


def _counted(docs: pa.Table, answers: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's rows in order, offsets, and of each token the counts of the word, of the context, of both."""
    docs = _ordered(docs)
    word, pair, offsets = tokens(unzipped(docs.column("_z").to_pylist()))
    answers = answers.sort_by("_shard")
    found = []
    for h, name in ((word, "_words"), (pair, "_pairs")):
        known, back = np.unique(h, return_inverse=True)
        counts = np.concatenate([unplaned(np.frombuffer(x, np.uint8)) for x in unzipped(answers.column(name).to_pylist())])
        found.append((known, counts, counts[back]))
    c_word, c_pair = found[0][2], found[1][2]
    ends = found[0][1][np.searchsorted(found[0][0], END)]
    before = np.concatenate([[ends], c_word[:-1]])  # the end of a text comes before the next
    return docs, offsets, c_word, before, c_pair


def base(c: np.ndarray, n: int, v: int) -> np.ndarray:
    return np.log10((c + 0.1) / (n + 0.1 * (v + 1)))


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(context, 0.5))).astype(np.int64) + 1, BUCKETS - 1)


def estimates(c_word, before, c_pair, n, v: int) -> np.ndarray:
    """Of each token: bigram, word and base probabilities."""
    return np.stack([c_pair / np.maximum(before, 1), c_word / np.maximum(n, 1), (c_word + 0.1) / (n + 0.1 * (v + 1))])


def learn(cells: pd.DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bucket x 3) by expectation-maximisation on counted held-out tokens (bucket, p2, p1, p0, n)."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    for b, own in cells.groupby("bucket"):
        p, n = own[["p2", "p1", "p0"]].to_numpy().T, own["n"].to_numpy()
        w = weights[int(b)]
        for _ in range(rounds):
            part = w[:, None] * p
            w = (part / part.sum(0) * n).sum(1) / n.sum()
        # a weight of every part stays, so that no text is impossible
        weights[int(b)] = (w + 1e-6) / (1 + 3e-6)
    return weights


def without_own(offsets, word, pair, c_word, before, c_pair) -> tuple:
    """The counts of each token's word, context and bigram in the corpus without the document it stands in."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    context = np.concatenate([[END], word[:-1]])

    def own(h: np.ndarray, of: np.ndarray) -> np.ndarray:
        """How often each of `of` occurs among h in the same document."""
        known, at = np.unique(np.concatenate([h, of]), return_inverse=True)
        key = np.concatenate([doc, doc]) * len(known) + at
        kinds, back = np.unique(key, return_inverse=True)
        return np.bincount(back[: len(h)], minlength=len(kinds))[back[len(h) :]]

    return c_word - own(word, word), before - own(word, context), c_pair - own(pair, pair)


def model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks, n_shards = (max(1, -(-size // min(most, max(least, size // 1000)))) for least, most in (BLOCK_BYTES, SHARD_BYTES))
    hops = 1
    while FAN**hops < max(n_blocks, n_shards):
        hops += 1
    fan, group = split(n_shards, hops), split(n_blocks, hops)
    blocked = _blocked(docs, n_blocks)
    answers, n, v = answered(_requests(blocked, fan, group), hops, fan, group, fan)
    answers = answers.select(F.col("_to").cast("int").alias("_block"), "_shard", "_words", "_pairs")

    def count(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        names = ["bucket", "k2", "k1", "p2", "p1", "p0", "n"]
        if not docs_of.num_rows or EM_FOLD not in docs_of.column("_fold").to_pylist():
            return pa.table({k: pa.array([], pa.int64() if k in ("bucket", "k2", "k1") else pa.float64()) for k in names})
        docs_of, offsets, c_word, before, c_pair = _counted(docs_of, answers_of)
        chosen = docs_of.column("_fold").to_numpy() == EM_FOLD
        sizes = np.diff(offsets)
        own = np.repeat(chosen, sizes)
        word, pair, at = tokens(unzipped(docs_of.filter(pa.array(chosen)).column("_z").to_pylist()))
        c_word, before, c_pair = without_own(at, word, pair, c_word[own], before[own], c_pair[own])
        p = estimates(c_word, before, c_pair, n - np.repeat(sizes[chosen], sizes[chosen]), v)
        grid = [np.where(x > 0, np.floor(np.log2(np.maximum(x, 1e-300)) * GRAIN), 1).astype(np.int64) for x in p[:2]]
        frame = pd.DataFrame({"bucket": bucket(before), "k2": grid[0], "k1": grid[1], "p2": p[0], "p1": p[1], "p0": p[2], "n": 1.0})
        return pa.Table.from_pandas(frame.groupby(names[:3], as_index=False).sum()[names], preserve_index=False)

    pairs = lambda f, schema: blocked.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(f, schema)
    cells = pairs(count, "bucket bigint, k2 bigint, k1 bigint, p2 double, p1 double, p0 double, n double")
    cells = cells.groupBy("bucket", "k2", "k1").agg(*[F.sum(c).alias(c) for c in ("p2", "p1", "p0", "n")])
    # bounded by buckets and steps, not by the corpus; summed in order, so reruns agree to the last rounding
    cells = cells.orderBy("bucket", "k2", "k1").toPandas()
    for c in ("p2", "p1", "p0"):
        cells[c] /= cells["n"]
    weights = learn(cells)
    kind = dict(docs.dtypes)["doc_id"]

    def rate(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        if not docs_of.num_rows:
            return pa.table({"doc_id": docs_of.column("_id"), "held_out": pa.array([], pa.bool_()), **{k: pa.array([], t) for k, t in (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))}})
        docs_of, offsets, c_word, before, c_pair = _counted(docs_of, answers_of)
        p = estimates(c_word, before, c_pair, n, v)
        mixed = np.log10(np.einsum("it,ti->t", p, weights[bucket(before)]))
        add = lambda x: np.add.reduceat(x, offsets[:-1])  # noqa: E731  every text has a token
        return pa.table({"doc_id": docs_of.column("_id"), "held_out": pa.array(~trained(docs_of)), "n_tokens": pa.array(np.diff(offsets)), "n_known": pa.array(add((c_word > 0).astype(np.int64))), "base_score": pa.array(add(base(c_word, n, v)) if n else np.zeros(len(offsets) - 1)), "score": pa.array(add(mixed))})

    out = pairs(rate, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op9(spark, sf_dir: str) -> DataFrame:
    return model_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
