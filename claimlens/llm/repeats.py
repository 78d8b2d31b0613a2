"""Windows of `length` units (bytes or words) whose content also starts earlier in the corpus.

Earlier: in a smaller doc_id, or in the same document at an earlier start. Every window picks the leftmost
least hash among the runs of `seed` units within it: its anchor. What a window picks depends on its content
alone, so equal windows have equal anchors at equal places, and

1. anchors are counted by seed hash; a seed that occurs once owns no repeated window,
2. a seed whose anchors all stand in the same context (everything the windows of the anchor reach) repeats
   as a whole: all but its first occurrence are repeats,
3. in a seed with several contexts equal contexts are folded to their first occurrence (the others are
   repeats as a whole), and the contexts left, each there once, are compared by the caller's `resolve`,
   which gets the contexts of one seed together,
4. a seed with more than CONTEXTS anchors is dealt into parts, each of which is compared by itself; what is first
   in its part meets the other parts' firsts by window hash, with partial sums.

Nothing lists pairs, and no group is gathered but parts of about CONTEXTS contexts.

Rows of one doc_id are one document of several texts, in the order of the texts' hashes; equal texts of one
doc_id count once. A null doc_id comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm import hashing
from claimlens.llm.common import saved

#: A seed's contexts are dealt into parts of about so many at most.
CONTEXTS = 4096
#: Units hashed at once; longer texts are cut into pieces that overlap.
PIECE = 1 << 20


@dataclass(frozen=True)
class Windows:
    unit: str  # "byte" or "word"
    length: int
    seed: int

    def __post_init__(self) -> None:
        if not 0 < self.seed <= self.length < 256:
            raise ValueError("seed <= length < 256 is asked for")


def unit_chunks(texts: list, unit: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, hashes of units, offsets of the texts in them) chunk by chunk."""
    if unit == "word":
        for w in hashing.words(texts):
            yield w.first, w.hashes, w.offsets
    else:
        for first, _, raws in hashing.chunks(texts):
            yield first, hashing.byte_units(np.frombuffer(b"".join(raws), np.uint8)), np.cumsum([0, *map(len, raws)])


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values: from the left within blocks, from the right within blocks."""
    n = len(h) - width + 1
    padded = np.full(-(-len(h) // width) * width, np.iinfo(h.dtype).max, h.dtype)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


@dataclass
class Anchors:
    """text: number within the chunk; start: of the first window owned, within the text; back: from there to
    the anchor; more: windows owned besides the first."""

    text: np.ndarray
    start: np.ndarray
    back: np.ndarray
    more: np.ndarray
    seed: np.ndarray
    context: np.ndarray


def anchors(units: np.ndarray, offsets: np.ndarray, spec: Windows) -> Anchors:
    parts = []
    size = spec.length
    for at in range(0, max(1, len(units) - size + 1), PIECE):
        own = units[at : at + PIECE + size - 1]
        if len(own) >= size:
            parts.append(_anchors(own, at, offsets, spec))
    if not parts:
        return Anchors(*[np.zeros(0, np.int64)] * 6)
    return Anchors(*[np.concatenate(c) for c in zip(*parts, strict=True)])


def _anchors(units: np.ndarray, at: int, offsets: np.ndarray, spec: Windows) -> tuple:
    size, width = spec.length, spec.length - spec.seed + 1
    run = hashing.Runs(units)
    h = run.of_length(spec.seed)
    least = sliding_least(h, width)
    n = len(least)
    text = np.searchsorted(offsets, np.arange(at, at + len(units)), side="right") - 1
    whole = text[:n] == text[size - 1 :]
    edge = np.flatnonzero((least[1:] != least[:-1]) | (whole[1:] != whole[:-1])) + 1
    first = np.concatenate([[0], edge])
    last = np.concatenate([edge, [n]]) - 1
    keep = whole[first]
    first, last = first[keep], last[keep]
    if not len(first):
        return tuple([np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2)
    place = first + np.argmax(h[first[:, None] + np.arange(width)] == least[first][:, None], axis=1)
    tied = np.flatnonzero(place < last)
    if len(tied):  # the least hash comes again within the run: the windows after it have another anchor
        extra = []
        for t in tied.tolist():
            f, e = int(first[t]), int(last[t])
            again = f + np.flatnonzero(h[f : e + width] == least[f])
            again = again[: int(np.searchsorted(again, e)) + 1]
            begin = np.concatenate([[f], again[:-1] + 1])
            extra.append((begin, np.minimum(again, e), again))
        solo = np.delete(np.arange(len(first)), tied)
        first, last, place = (np.concatenate([x[solo], *more]) for x, more in zip((first, last, place), zip(*extra, strict=True), strict=True))
    back = place - first
    context = hashing.mixed(run.between(first, last + size) + back.astype(np.uint64))
    own = text[first]
    return own, first + at - offsets[own], back, last - first, h[place], context


def keyed(docs: DataFrame) -> DataFrame:
    """_id, _part and text of each row; _part tells apart the texts of one doc_id, 0 where ids don't repeat."""
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    repeated = not docs.select(ids.alias("_id")).groupBy("_id").count().where("count > 1").isEmpty()
    part = F.xxhash64(F.lit(3), F.coalesce(F.col("text"), F.lit(""))) if repeated else F.lit(0).cast("long")
    return docs.select(ids.alias("_id"), part.alias("_part"), "text")


def zipped(rows: DataFrame) -> DataFrame:
    """_id, _part and the text compressed, as texts are shuffled."""

    def work(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [pack.compress(b"" if t is None else t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())], names=["_id", "_part", "_z"])

    return rows.mapInArrow(work, "_id bigint, _part bigint, _z binary")


def unzipped(z: list[bytes]) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x) for x in z]


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def anchor_rows(rows: DataFrame, spec: Windows, placed: bool) -> DataFrame:
    """seed and context of every anchor and, if placed, _id, _part and place (start, back and more packed)."""

    def work(batches):
        for batch in batches:
            for first, units, offsets in unit_chunks(batch.column(2).to_pylist(), spec.unit):
                a = anchors(units, offsets, spec)
                cols = [_signed(a.seed), _signed(a.context)]
                if placed:
                    of = pa.array(a.text + first)
                    cols += [batch.column(0).take(of), batch.column(1).take(of), pa.array(a.start << 16 | a.back << 8 | a.more)]
                yield pa.RecordBatch.from_arrays(cols, names=["seed", "context", "_id", "_part", "place"][: len(cols)])

    return rows.mapInArrow(work, "seed bigint, context bigint" + ", _id bigint, _part bigint, place bigint" * placed)


def repeated(rows: DataFrame, spec: Windows, resolve_batch) -> DataFrame:
    """_id, _part, first, more: windows of a document, from start first on, that are repeats."""
    seeds = anchor_rows(rows, spec, False).groupBy("seed").agg(F.count("*").alias("_n"), F.min("context").alias("_x"), F.max("context").alias("_y"))
    # written, so that the join below stands alone and large partitions of it can be split
    seeds = saved(seeds.where("_n > 1").select("seed", F.when(F.col("_x") < F.col("_y"), F.ceil(F.col("_n") / CONTEXTS)).otherwise(0).cast("int").alias("_parts")))
    hits = saved(anchor_rows(rows, spec, True).join(seeds, "seed"))
    at = F.struct("_id", "_part", "place")
    firsts = hits.groupBy("seed", "context", "_parts").agg(F.min(at).alias("_at"))
    firsts = saved(firsts.select("seed", "context", "_parts", "_at.*").withColumnsRenamed({"_id": "_fid", "_part": "_fpart", "place": "_fplace"}))
    later = hits.join(firsts.drop("_parts"), ["seed", "context"])
    later = later.where(~(F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_part") == F.col("_fpart")) & (F.col("place") == F.col("_fplace"))))
    # rows alike in id and text share their place, which is not earlier than itself
    whole = later.select("_id", "_part", F.shiftright("place", 16).alias("first"), F.col("place").bitwiseAND(F.lit(255)).alias("more"))

    several = firsts.where("_parts > 0").select(F.col("_fid").alias("_id"), F.col("_fpart").alias("_part"), F.col("_fplace").alias("place"), "seed", "_parts")
    asked = several.groupBy("_id", "_part").agg(F.collect_list(F.struct("seed", "place", "_parts")).alias("_asked"))
    texts = zipped(rows.select("_id", "_part", "text")).join(asked, ["_id", "_part"])
    pieces = _segments(texts, spec).withColumn("_salt", F.pmod(F.xxhash64("_id", "_part"), F.col("_parts")).cast("int"))
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(n, "seed", "_salt").sortWithinPartitions("seed", "_salt", "_id", "_part", "place")
    dealt = dealt.select("seed", "_id", "_part", "place", "segment", "_salt", "_parts")
    compared = saved(dealt.mapInArrow(_resolver(spec, resolve_batch), "_id bigint, _part bigint, first bigint, more bigint, w1 bigint, w2 bigint"))

    # windows that are first in their part of a seed with several
    open_ = compared.where("w1 is not null").drop("more")
    begin = open_.groupBy("w1", "w2").agg(F.min(F.struct("_id", "_part", "first")).alias("_b"), F.count("*").alias("_n")).where("_n > 1")
    across = open_.join(begin.select("w1", "w2", "_b"), ["w1", "w2"]).where(F.struct("_id", "_part", "first") > F.col("_b"))
    across = across.select("_id", "_part", "first", F.lit(0).cast("long").alias("more"))
    return whole.unionByName(compared.where("w1 is null").drop("w1", "w2")).unionByName(across)


def _segments(texts: DataFrame, spec: Windows) -> DataFrame:
    """The units (bytes, or hashes of words) of each asked context."""
    size = spec.length

    def work(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                raws = unzipped(batch.column(2).to_pylist())
                asked = batch.column(3).to_pylist()
                out: list[tuple] = []
                for first, units, offsets in unit_chunks(raws, spec.unit):
                    for t in range(len(offsets) - 1):
                        i, b = first + t, int(offsets[t])
                        for x in asked[i]:
                            start, more = x["place"] >> 16, x["place"] & 255
                            part = raws[i][start : start + more + size] if spec.unit == "byte" else units[b + start : b + start + more + size].tobytes()
                            out.append((x["seed"], i, x["place"], part, x["_parts"]))
                of = pa.array([r[1] for r in out], pa.int64())
                col = {j: pa.array([r[j] for r in out], kind) for j, kind in {0: pa.int64(), 2: pa.int64(), 3: pa.binary(), 4: pa.int32()}.items()}
                yield pa.RecordBatch.from_arrays([col[0], batch.column(0).take(of), batch.column(1).take(of), col[2], col[3], col[4]], names=["seed", "_id", "_part", "place", "segment", "_parts"])

    return texts.mapInArrow(work, "seed bigint, _id bigint, _part bigint, place bigint, segment binary, _parts int")


def _hashed(segment: bytes, unit: str, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each of the windows that start there."""
    units = byte_hashes(segment) if unit == "byte" else np.frombuffer(segment, np.uint64)
    return tuple(hashing.Runs(u).between(starts, starts + size).view(np.int64) for u in (units, hashing.mixed(units)))


def byte_hashes(data: bytes) -> np.ndarray:
    return hashing.byte_units(np.frombuffer(data, np.uint8))


def _resolver(spec: Windows, resolve_batch):
    """Rows sorted by seed and part -> repeats; resolve_batch gets whole parts, many at once: (seed, id, part, place,
    segment) rows -> for each row its list of (first, last) windows that are repeats. Of seeds with several parts
    the other windows are returned, too, with their hashes."""

    def flush(rows: list[tuple]):
        found = resolve_batch([((r[0], r[5]), *r[1:5]) for r in rows])
        out = []
        for r, spans in zip(rows, found, strict=True):
            start, more = r[3] >> 16, r[3] & 255
            out += [(r[1], r[2], start + f, e - f, None, None) for f, e in spans]
            if r[6] > 1:
                left = np.ones(more + 1, bool)
                for f, e in spans:
                    left[f : e + 1] = False
                left = np.flatnonzero(left)
                w1, w2 = _hashed(r[4], spec.unit, left, spec.length)
                out += [(r[1], r[2], start + f, 0, p, q) for f, p, q in zip(left.tolist(), w1.tolist(), w2.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.int64()) for j in range(6)], names=["_id", "_part", "first", "more", "w1", "w2"])

    def work(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = held and r[0] == held[-1][0] and r[5] == held[-1][5]
                if same and r[1:4] == held[-1][1:4]:
                    continue  # rows alike in id and text
                if size > FLUSH and not same:
                    yield flush(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield flush(held)

    return work


#: Bytes of segments that are compared at once; a part of a seed is not cut.
FLUSH = 1 << 19


def spans_of(windows: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of units covered by the windows (first, more)."""
    out: list[tuple[int, int]] = []
    for first, more in sorted(windows):
        end = first + more + length
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def covered(docs: DataFrame, spec: Windows, resolve_batch) -> DataFrame:
    """_id, _part, _z (the text, compressed) and spans: the maximal runs of units that repeats cover, or null."""
    rows = keyed(docs)
    marks = repeated(rows, spec, resolve_batch)
    marks = marks.groupBy("_id", "_part").agg(F.collect_list(F.struct("first", "more")).alias("_marks"))
    return zipped(rows).join(marks, ["_id", "_part"], "left")
