"""MinHash near-dedup with tensored banding.

A document's set is its distinct five-word shingles, hashed to 64 bits. Instead of one group of minhashes for
each table, two collections of groups are computed, and the table (i, j) takes the i-th group of the first
with the j-th of the second: side**2 tables for 2 * side groups of minhashes. Both numbers follow from the
similarity asked for: a pair just at it meets in no table with a chance of MISS at most (shape).

Equal sets are one class. In each bucket of a table the smallest class leads and is compared exactly with the
others; links that hold are joined to components. What a leader leaves apart is searched through differences:
x and y link only if their symmetric difference is small, |x ^ y| <= c * (|x| + |y|) with c = (100 - p) / (100 + p).
Let dx = x ^ leader. As |x ^ y| = |dx| + |dy| - 2 * |dx & dy|, and as one of the two at least isn't linked with the
leader, dx and dy share about half of their elements or more, and then, in any fixed order of elements, a part of
their prefixes (needs()). So the classes of a leader meet on prefix elements of their differences, ordered by how few
classes have them. Pairs that positions and sizes leave possible are compared
exactly. No link in a bucket is given up, and near copies of one text that don't link with
each other (each with its own changes) share no prefix element, so they cost no comparison of pairs.

Defined results: null or blank texts have an empty set and stay alone; texts of fewer than five words are one
shingle; A-Z count as a-z; rows of one doc_id are one document, linked by any of its texts (n_shingles is of
the row); rows without doc_id are one document of id null, linked with nothing; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm import hashing
from claimlens.llm.common import saved, table
from claimlens.llm.components import components, joined

SHINGLE = 5
#: Chance at most that a pair just at the percent asked for meets in no table.
MISS = 7e-5
#: Minhashes of a group, and groups of a collection, at most; the latter gives way where single minhashes need more.
GROUP = 2
SIDE = 16
#: Percent of the union that the intersection is at least.
PERCENT = 85
#: Classes that share an element are matched in blocks of about so many.
CROWD = 1024
#: Into how many parts the classes of one bucket are dealt when they get their leader.
SALTS = 8


def miss(percent: float, side: int, group: int) -> float:
    """Chance that a pair of this similarity meets in none of the side**2 tables."""
    none = (1 - (percent / 100) ** group) ** side
    return none * (2 - none)


def shape(percent: float) -> tuple[int, int]:
    """side and group: the largest groups, and the fewest of them, that keep to MISS."""
    none = 1 - math.sqrt(1 - MISS)  # of one collection
    for group in range(GROUP, 0, -1):
        s = (percent / 100) ** group
        side = 1 if s >= 1 else math.ceil(math.log(none) / math.log1p(-s))
        if side <= SIDE or group == 1:
            break
    return side, group


def signatures(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """_id, n (distinct shingles), two sums that name the set, and the two collections of minhash groups."""
    side, group = shape(percent)
    multipliers = np.random.default_rng(97).integers(1, 1 << 62, 2 * side * group, np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batches):
        for batch in hashing.slices(batches):
            n_rows = batch.num_rows
            count, sums = np.zeros(n_rows, np.int64), np.zeros((2, n_rows), np.uint64)
            groups = np.zeros((2 * side, n_rows), np.uint64)
            for w in hashing.words(batch.column(1).to_pylist(), fold=True):
                own, h = hashing.shingles(w, size)
                if not len(h):
                    continue
                texts, begin = np.unique(own, return_index=True)
                at = texts + w.first
                for k in range(2 * side):
                    for m in multipliers[k * group : (k + 1) * group]:
                        least = np.minimum.reduceat(h * m, begin)
                        groups[k, at] = hashing.mixed(groups[k, at] ^ least)
                ends = [*begin[1:].tolist(), len(h)]
                for t, b, e in zip(at.tolist(), begin.tolist(), ends, strict=True):
                    one = np.unique(h[b:e])
                    count[t], sums[0, t], sums[1, t] = len(one), one.sum(), hashing.mixed(one ^ np.uint64(0x5BD1E995)).sum()
            cols = [pa.array(count), *(pa.array(s.view(np.int64)) for s in sums)]
            for half in (groups[:side], groups[side:]):
                flat = pa.array(np.ascontiguousarray(half.T).reshape(-1).view(np.int64))
                cols.append(pa.ListArray.from_arrays(pa.array(np.arange(n_rows + 1, dtype=np.int32) * side), flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["_id", "n", "s1", "s2", "first", "second"])

    return docs.select(F.col("doc_id").cast("long").alias("_id"), "text").mapInArrow(work, "_id bigint, n bigint, s1 bigint, s2 bigint, first array<bigint>, second array<bigint>")


def needs(d: int, n: int, led: int, linked: bool, c: float) -> tuple[int, int]:
    """How many elements of the difference d of a class of n shingles from its leader (of led shingles) stand in the
    prefix that meets classes not linked with the leader, and in the one that meets linked ones (0: can't link).

    Shared elements at least: (dx + dy - c * (nx + ny)) / 2. A y that isn't linked has dy - c * ny > c * led,
    any other at least -c * led, as dy >= |ny - led|."""
    far, near = (max(1, math.ceil((d - c * n + side * c * led) / 2 - 1e-9)) for side in (1, -1))
    return max(0, d - far + 1), 0 if linked else max(0, d - near + 1)


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, led: bool = False) -> DataFrame:
    """pairs (a, b) compared exactly on their full sets: linked; and, if a leads, the size n of b's set, its difference
    from a's (elements, d of them) and both prefix lengths (short, long)."""
    x, y = (texts.select(F.col("cls").alias(k), F.col("text").alias(f"_t{k}")) for k in "ab")
    # the same plan at every size: pairs are shuffled to the texts
    both = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "_ta", "_tb")
    c = (100 - percent) / (100 + percent)

    def sets(column) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for w in hashing.words(column.to_pylist(), fold=True):
            own, h = hashing.shingles(w, SHINGLE)
            cut = np.searchsorted(own, np.arange(w.last - w.first + 1))
            out += [np.unique(h[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
        return out

    def work(batches):
        for batch in hashing.slices(batches, 256):
            rows = []
            for p, q in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True):
                lost = np.isin(p, q, assume_unique=True, invert=True)
                shared = len(p) - int(lost.sum())
                linked = shared > 0 and 100 * shared >= percent * (len(p) + len(q) - shared)
                d = len(p) + len(q) - 2 * shared
                short, long, elements = 0, 0, []
                if led:
                    short, long = needs(d, len(q), len(p), linked, c)
                    elements = np.concatenate([q[np.isin(q, p, assume_unique=True, invert=True)], p[lost]]).view(np.int64)
                version = int((p.sum() ^ q.sum()).view(np.int64)) if len(p) and len(q) else 0  # a doc_id may have several texts
                rows.append((linked, version, len(q), d, short, long, elements))
            cols = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.bool_(), *[pa.int64()] * 5, pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["a", "b", "linked", "version", "n", "d", "short", "long", "elements"])

    return both.mapInArrow(work, "a bigint, b bigint, linked boolean, version bigint, n bigint, d bigint, short bigint, long bigint, elements array<bigint>")


def bucketed(classes: DataFrame) -> DataFrame:
    """grp and cls of all classes that share a bucket with another, and its leader, the smallest."""
    keys = F.flatten(F.transform("first", lambda p, i: F.transform("second", lambda q, j: F.xxhash64(p, q, i, j))))
    entries = classes.select("cls", F.explode(keys).alias("grp"))
    full = entries.groupBy("grp").agg(F.min("cls").alias("lead"), F.max("cls").alias("_high")).where("lead < _high")
    full = full.select("grp", "lead", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    dealt = entries.withColumn("_salt", F.pmod(F.xxhash64("cls", F.lit(29)), F.lit(SALTS)).cast("int"))
    return dealt.join(full, ["grp", "_salt"]).select("grp", "cls", "lead")


def apart(members: DataFrame) -> DataFrame:
    """Members of groups in which a pair could still join two components, with the number of members."""
    open_ = members.groupBy("grp").agg(F.count("*").alias("crowd"), F.min("comp").alias("_x"), F.max("comp").alias("_y"), F.min("home").alias("_v"), F.max("home").alias("_w"), F.max(F.col("home") == F.col("a")).alias("_h"))
    return members.join(open_.where("_x < _y and (_h or _v < _w)").select("grp", "crowd"), "grp")


def shared_elements(members: DataFrame) -> DataFrame:
    """A row for each prefix element of a member's difference that another member has, with its place i. Elements that
    few have come first; what nobody shares gives no row, but has its place."""
    # the classes of a leader of many are dealt out before each gives its elements
    each = members.repartition("a", "b").select("a", "b", "home", "comp", "linked", "version", "n", "d", "short", F.greatest("short", "long").alias("_upto"), F.explode("elements").alias("_e"))
    each = saved(each.withColumn("grp", F.xxhash64("a", "_e")).drop("_e"))
    often = each.groupBy("grp").agg(F.count("*").alias("_f"))
    place = F.row_number().over(Window.partitionBy("a", "b", "version").orderBy("_f", "grp")) - 1
    return each.join(often, "grp").withColumn("i", place).where("_f > 1 and i < _upto").drop("_f", "_upto", "version")


def useful(meet: DataFrame, percent: int) -> DataFrame:
    """Rows that could pass possible() with the best partner of their group: by what linked and other members have.

    With e = d - c * n and f = d - 2 * i + c * n, elements left suffice for a pair if e of each is at most f of the other."""
    c = (100 - percent) / (100 + percent)
    e, f = F.col("d") - c * F.col("n"), F.col("d") - 2 * F.col("i") + c * F.col("n")
    of = {"k": F.col("linked"), "u": ~F.col("linked")}
    best = meet.groupBy("grp").agg(*[F.min(F.when(is_, e)).alias(f"_e{k}") for k, is_ in of.items()], *[F.max(F.when(is_, f)).alias(f"_f{k}") for k, is_ in of.items()])
    fits = {k: F.coalesce((F.col(f"_e{k}") <= f + 1e-9) & (F.col(f"_f{k}") >= e - 1e-9), F.lit(False)) for k in of}
    return meet.join(best, "grp").where(fits["u"] | (~F.col("linked") & fits["k"])).select(*meet.columns)


def possible(meet: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that share a prefix element of their differences and can link by positions and sizes."""
    c = (100 - percent) / (100 + percent)
    # a crowded group is dealt into blocks, which meet each other in cells
    blocks = F.ceil(F.col("crowd") / CROWD).cast("int")
    own, other = F.pmod(F.xxhash64("b", F.lit(31)), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    cols = ["grp", "a", "b", "home", "comp", "linked", "n", "d", "short", "i"]
    one = meet.select(*[F.col(k).alias(f"{k}_x") for k in cols], own.alias("_p"), other.alias("_q"))
    two = meet.select(*[F.col(k).alias(f"{k}_y") for k in cols], own.alias("_r"), other.alias("_s"))
    cell = (F.col("grp_x") == F.col("grp_y")) & (F.col("_p") == F.col("_s")) & (F.col("_q") == F.col("_r"))
    new = (F.col("b_x") < F.col("b_y")) & (F.col("comp_x") != F.col("comp_y")) & ((F.col("home_x") != F.col("home_y")) | (F.col("home_x") == F.col("a_x")))
    reach = (F.col("linked_x") != F.col("linked_y")) | (~F.col("linked_x") & (F.col("i_x") < F.col("short_x")) & (F.col("i_y") < F.col("short_y")))
    # elements left from here on, against those that are to be shared at least
    enough = 2 * F.least(F.col("d_x") - F.col("i_x"), F.col("d_y") - F.col("i_y")) >= F.col("d_x") + F.col("d_y") - c * (F.col("n_x") + F.col("n_y")) - 1e-9
    return one.join(two, cell & new & reach & enough).select(F.col("b_x").alias("a"), F.col("b_y").alias("b")).distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (columns doc_id, text)."""
    rows = saved(signatures(docs, percent))
    named = rows.where("n > 0 and _id is not null").groupBy("n", "s1", "s2").agg(F.min("_id").alias("cls"), F.first("first").alias("first"), F.first("second").alias("second"))
    classes = saved(named)
    # (leader, class) for each bucket; equal for many buckets
    led = saved(bucketed(classes).where("cls > lead").select(F.col("lead").alias("a"), F.col("cls").alias("b")).distinct())
    some = led.select(F.col("a").alias("cls")).union(led.select("b")).distinct()
    texts = docs.select(F.col("doc_id").alias("cls"), "text").join(some.hint("merge"), "cls")
    if not classes.groupBy("cls").count().where("count > 1").isEmpty() or not docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty():
        texts = texts.distinct()  # rows that repeat would multiply pairs
    texts = saved(texts)

    # a pair is searched under one leader: that with the most classes, if it is the same for both
    most = led.groupBy("a").agg(F.count("*").alias("_m"))
    home = led.join(most, "a").groupBy("b").agg(F.min_by("a", F.struct(-F.col("_m"), "a")).alias("home"))
    compared = saved(verified(led, texts, percent, led=True))
    comp = components(compared.where("linked").select("a", "b"))
    at = comp.select(F.col("node").alias("b"), "comp")
    members = compared.join(home, "b").join(at, "b", "left").withColumn("comp", F.coalesce("comp", "b")).withColumn("grp", F.xxhash64("a"))
    meet = saved(shared_elements(apart(members)))
    pairs = possible(apart(useful(meet, percent)), percent).join(led, ["a", "b"], "left_anti")
    found = saved(verified(pairs, texts, percent).select("a", "b", "linked"))
    comp = joined(comp, found.where("linked").select("a", "b"))

    placed = rows.where("n > 0 and _id is not null").join(classes.select("n", "s1", "s2", "cls"), ["n", "s1", "s2"]).select("_id", "cls")
    placed = placed.distinct()
    # rows of one document may be of several classes: they are linked
    several = placed.groupBy("_id").agg(F.min("cls").alias("_x"), F.max("cls").alias("_y")).where("_x < _y").select("_id", "_x")
    more = saved(placed.join(several, "_id").where("cls > _x").select(F.col("cls").alias("a"), F.col("_x").alias("b")))
    if not more.isEmpty():
        comp = joined(comp, more)
    placed = placed.join(comp.withColumnRenamed("node", "cls"), "cls", "left").groupBy("_id").agg(F.min(F.coalesce("comp", "cls")).alias("component_id"))
    out = rows.select("_id", "n").join(placed, "_id", "left")
    return out.select(F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"))


def op4(spark, sf_dir: str) -> DataFrame:
    out = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
