"""Suffix-array dedup: Burrows-Wheeler transforms of shards merged by interleave refinement.

A byte goes if a string of 100 bytes that covers it also starts earlier. Which strings can repeat at all is
narrowed down first (repeats.py: content-chosen anchors, equal contexts folded). The contexts that are left
are byte strings; of a batch of them

- each shard gets its suffix array and transform by prefix doubling; the alphabet is blocks of STEP bytes, numbered
  in their order, so a suffix is a string of blocks and its transform holds the block before it,
- the transforms are merged: an interleave (which shard the next suffix comes from) sorted by h blocks is
  refined to h + 1 blocks by one stable sort of the blocks before the suffixes; no suffix is compared
  again and no text is looked at,
- where the block or the run above changes, a new run begins: its suffix shares just h blocks with the one
  before it, which gives the common prefixes, and after 100 / STEP rounds the runs are the repeated intervals.

Of an interval of windows all but the earliest are repeats.

Defined results: a null text has no bytes; rows of one doc_id are one document of several texts, in the order
of the texts' hashes, and rows alike in doc_id and text don't count against each other; a null doc_id comes
before all others; an empty table gives an empty result; other columns of the input are ignored. Cuts are by
bytes, so what is kept is binary and may split a character.
"""

from __future__ import annotations


from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table
from claimlens.llm.repeats import Windows, covered, spans_of, unzipped

BYTES = Windows("byte", 100, 24)
#: Bytes of a letter of the transforms; divides the length of a window.
STEP = 10
#: Into how many shards a batch of contexts is dealt.
SHARDS = 8
#: Contexts are merged if they agree on all but 1 / STEPS of what a window reaches beyond its seed.
STEPS = 8


Shard = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def letters(strings: list[bytes], step: int = STEP) -> list[np.ndarray]:
    """For each string and start of a suffix (its end, too) the number of the block of `step` bytes there, from 1 on in the
    order of the blocks; 0 where the string ends before."""
    lengths = np.array([len(s) for s in strings])
    data = np.frombuffer(b"".join(strings) + bytes(step), np.uint8).astype(np.int64)
    rank, width = data, 1
    while width < step:  # numbers of blocks of twice the width, or of what is left, by the numbers of both halves
        more = min(width, step - width)
        ahead = np.zeros(len(rank), np.int64)
        ahead[: len(rank) - more] = rank[more:]
        rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)[1]
        width += more
    out = []
    for begin, n in zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist(), strict=True):
        own = np.zeros(n + 1, np.int64)
        whole = max(0, n - step + 1)
        own[:whole] = rank[begin : begin + whole] + 1
        out.append(own)
    return out


def transform(own_letters: list[np.ndarray], step: int = STEP) -> Shard:
    """Of a shard's strings, by the order of their suffixes: the letter before each (0: none), its string, where it starts; and
    how many suffixes are shorter than a letter. Those sort first, in the strings' order."""
    lengths = np.array([len(x) for x in own_letters])
    own = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    letter = np.concatenate(own_letters)
    place = np.arange(len(own)) - begin[own]
    end = np.flatnonzero(letter == 0)
    rank = letter + len(end)
    rank[end] = np.arange(len(end))
    size, hop = len(rank), step
    while True:
        after = np.zeros(size, np.int64)
        on = np.flatnonzero(lengths[own] - place > hop)
        after[on] = rank[on + hop] + 1
        kinds, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
        if len(kinds) == size:
            break
        hop *= 2
    order = np.argsort(rank)
    before = np.zeros(size, np.int64)
    has = np.flatnonzero(place >= step)
    before[has] = letter[has - step]
    return before[order], own[order], place[order], len(end)


def stable_order(values: np.ndarray) -> np.ndarray:
    """Like a stable argsort, by one sort of value and position together."""
    n = len(values)
    return np.sort(values * n + np.arange(n)) % n


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of all shards sorted by their first `depth` letters: shard-wise number of the string (counted
    through all shards), start, and the letters shared with the suffix before (depth where it is that or more)."""
    ends = np.array([e for *_, e in shards])
    counts = np.array([int(s.max()) + 1 for _, s, _, _ in shards])
    sizes = [len(b) for b, *_ in shards]
    transforms = np.concatenate([b for b, *_ in shards])
    strings = np.concatenate([s + n for (_, s, _, _), n in zip(shards, np.cumsum(counts) - counts, strict=True)])
    places = np.concatenate([p for _, _, p, _ in shards])
    n, n_ends = len(transforms), int(ends.sum())
    # what has no letter before it starts in the first letter of its string and is nobody's successor
    loose = int((transforms == 0).sum())
    end_order = np.repeat(np.arange(len(shards), dtype=np.uint8), ends)
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    fresh = np.zeros(n, bool)
    fresh[0] = True
    shared = np.full(n, depth, np.int16)
    shared[0] = 0
    taken = np.empty(n, np.int64)
    for h in range(depth):
        taken[np.argsort(interleave, kind="stable")] = transforms
        order = stable_order(taken)[loose:]
        interleave = np.concatenate([end_order, interleave[order]])
        letter, block = taken[order], np.cumsum(fresh)[order]
        now = np.ones(n, bool)
        now[n_ends + 1 :] = (letter[1:] != letter[:-1]) | (block[1:] != block[:-1])
        shared[now & ~fresh] = h
        fresh = now
        if fresh.all():
            break
    at = np.argsort(interleave, kind="stable")
    string, place = np.empty(n, np.int64), np.empty(n, np.int64)
    string[at], place[at] = strings, places
    return string, place, shared


def may_share(rows: list[tuple], spec: Windows = BYTES) -> list[int]:
    """Numbers of the contexts that can share a window with another of their seed. A window reaches some way to the
    left of the seed and the rest of length - seed to the right; by STEPS ranges of that way, contexts that share
    one agree on the least way of a range to the left and on what is left over to the right."""
    reach = spec.length - spec.seed
    cuts = [reach * j // STEPS for j in range(STEPS + 1)]
    sides, seen = [], Counter()
    for r in rows:
        back, part = r[3] >> 8 & 255, r[4]
        own = []
        for j in range(STEPS):
            left, end = back - cuts[j], back + spec.seed + reach - cuts[j + 1]
            if left >= 0 and end <= len(part):
                own.append((r[0], j, part[left:end]))
        seen.update(own)
        sides.append(own)
    return [i for i, own in enumerate(sides) if any(seen[k] > 1 for k in own)]


def resolve(rows: list[tuple], spec: Windows = BYTES) -> list[list[tuple[int, int]]]:
    """For contexts (seed, id, part, place, bytes): which of their windows stand in an earlier one too."""
    out: list[list[tuple[int, int]]] = [[] for _ in rows]
    order = sorted(may_share(rows, spec), key=lambda i: rows[i][1:4])  # strings are numbered from the earliest on
    if len(order) < 2:
        return out
    n_shards = min(SHARDS, len(order))
    cuts = np.linspace(0, len(order), n_shards + 1).astype(int)
    own = letters([rows[i][4] for i in order])
    depth = spec.length // STEP
    string, place, shared = merge([transform(own[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], depth)
    block = np.cumsum(shared < depth)
    more = np.array([rows[i][3] & 255 for i in order])
    window = np.flatnonzero(place <= more[string])
    window = window[np.lexsort((string[window], block[window]))]
    again = window[1:][block[window][1:] == block[window][:-1]]
    again = again[np.lexsort((place[again], string[again]))]
    for s, p in zip(string[again].tolist(), place[again].tolist(), strict=True):
        spans = out[order[s]]
        if spans and spans[-1][1] == p - 1:
            spans[-1] = (spans[-1][0], p)
        else:
            spans.append((p, p))
    return out


def deduplicated(docs: DataFrame, spec: Windows = BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (start, end in bytes) of the repeats to remove, and the bytes that are kept."""

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, spans, kept = [], [], []
                for raw, marks in zip(unzipped(batch.column(2).to_pylist()), batch.column(3).to_pylist(), strict=True):
                    own = spans_of([(x["first"], x["more"]) for x in marks or ()], spec.length)
                    edges = [0, *(p for span in own for p in span), len(raw)]
                    n.append(len(raw))
                    spans.append([{"start": s, "end": e} for s, e in own])
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["_id", "n_bytes", "spans", "kept"])

    out = covered(docs, spec, resolve).mapInArrow(work, "_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.select(F.nullif("_id", F.lit(-(1 << 63))).alias("doc_id"), "n_bytes", "spans", "kept")


def op2(spark, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
