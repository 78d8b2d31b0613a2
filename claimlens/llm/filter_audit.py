"""Filter interaction audit: what each filter of a chain removes, alone and after others, for every order of the chain.

A document's failures are a mask, one bit per filter; documents are counted once by part and mask (at most 2**k cells
a part), and all orders are judged on these cells. A recursive CTE extends filter prefixes with the letters they don't
hold yet: its rows are prefixes joined with mask cells, carry the bits applied so far, and each level of the recursion
emits what that step does to the cell. Steps depend on the prefix alone, so 325 prefixes of five filters serve the
120 orders; the recursion reads masks and letters only and has the same size for any corpus.

Equal texts are found by the SHA-256 of their bytes. Copies are first counted by text, part and labels, with the least
doc_id of each such group, so a text that is repeated without end is never gathered.

Defined results: a null text counts as empty, a null source is the part '', rows without doc_id are never copies of
others nor originals, of labels that repeat a doc_id the largest counts, repeated rows (same doc_id) are counted each and
aren't copies of each other, an empty table has no parts and so no rows. Columns that aren't asked for are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import WORD, saved, table

#: The failure conditions of texts, by letter; the copy test comes after them.
LETTERS = "ABCD"
COPY = "E"

_WALK = """
WITH RECURSIVE walk(prefix, step, applied, mask, letter, removed, redundant, alone, kept) AS (
  SELECT CAST('' AS STRING), 0, 0, mask, CAST('' AS STRING), 0, 0, 0, 1 FROM {masks}
  UNION ALL
  SELECT concat(w.prefix, l.name), w.step + 1, w.applied | l.bit, w.mask, l.name,
         CASE WHEN (w.mask & l.bit) <> 0 AND (w.mask & w.applied) = 0 THEN 1 ELSE 0 END,
         CASE WHEN (w.mask & l.bit) <> 0 AND (w.mask & w.applied) <> 0 THEN 1 ELSE 0 END,
         CASE WHEN w.mask = l.bit THEN 1 ELSE 0 END,
         CASE WHEN (w.mask & (w.applied | l.bit)) = 0 THEN 1 ELSE 0 END
  FROM walk w JOIN {unused} l ON w.applied = l.applied
)
SELECT prefix, step, letter, mask, removed, redundant, alone, kept FROM walk WHERE step > 0
"""


def text_failures(text: Column) -> dict[str, Column]:
    """What each of the filters A to D rejects: short, repetitive, shouting, and marked-up texts."""
    return {
        "A": F.size("_words") < 50,
        "B": 100 * F.size(F.array_distinct("_words")) < 65 * F.size("_words"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, mask of A to D, digest of the text, good and toxic of each document; texts go no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    fails = text_failures(F.col("_text"))
    mask = reduce(lambda a, b: a + b, [F.when(fails[k], 1 << i).otherwise(0) for i, k in enumerate(LETTERS)])
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("_text", 256)).alias("digest"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, rows["doc_id"] == marks["_id"], "left").drop("_id")
    return rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def cells(rows: DataFrame) -> DataFrame:
    """Counts n, good and toxic by part and mask, the copy test's bit (16) included."""
    own = rows.groupBy("doc_id", "digest", "part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    # the least doc_id of a group and how many rows have it: all that a group of copies needs to be told apart
    group = own.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    group = group.withColumn("_kept", F.col("no_id") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    both = F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.col("_kept").alias("n")), F.struct(F.lit(1 << len(LETTERS)).alias("bit"), (F.col("n") - F.col("_kept")).alias("n")))).alias("_x")
    out = group.select("part", "mask", "good", "toxic", both)
    n = F.col("_x.n")
    return out.groupBy("part", (F.col("mask") + F.col("_x.bit")).alias("mask")).agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def walk(spark, letters: str) -> DataFrame:
    """For every prefix of distinct letters and every mask what the prefix's last filter does to documents of that mask."""
    masks = spark.range(1 << len(letters)).select(F.col("id").cast("int").alias("mask"))
    unused = [(a, k, 1 << i) for a in range(1 << len(letters)) for i, k in enumerate(letters) if not a >> i & 1]
    return spark.sql(_WALK, masks=masks, unused=spark.createDataFrame(unused, "applied int, name string, bit int"))


def orders(spark, letters: str) -> DataFrame:
    """filter_order, step and prefix of every order of the letters."""
    names = ["".join(p) for p in permutations(letters)]
    rows = spark.createDataFrame([(x,) for x in names], "filter_order string")
    steps = rows.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    return steps.select("filter_order", "step", F.expr("substring(filter_order, 1, step)").alias("prefix"))


def interactions(counted: DataFrame, letters: str = LETTERS + COPY) -> DataFrame:
    """counted (part, mask, n, good, toxic) -> the metrics of each part, order and step."""
    spark = counted.sparkSession
    seen = walk(spark, letters)
    # as many rows as prefixes and masks, whatever the corpus holds
    each = counted.withColumnRenamed("mask", "_m").join(F.broadcast(seen), F.col("_m") == F.col("mask"))
    sums = {name: F.sum(F.col(of) * F.col(flag)).cast("long").alias(name) for name, of, flag in (
        ("kept", "n", "kept"), ("removed", "n", "removed"), ("redundant", "n", "redundant"), ("unique_fails", "n", "alone"), ("good_lost", "good", "removed"), ("toxic_lost", "toxic", "removed"))}
    steps = each.groupBy("part", F.col("prefix").alias("_p"), "letter").agg(*sums.values())
    wide = steps.join(F.broadcast(orders(spark, letters)), F.col("_p") == F.col("prefix"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return wide.select("part", "filter_order", "step", *sums, shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    return interactions(saved(cells(judged(docs, labels))))


def op12(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lb AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
f AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
 CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
 + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
 + CASE WHEN coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), FALSE) THEN 16 ELSE 0 END AS mask FROM d LEFT JOIN lb ON lb.doc_id = d.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(name, bit)),
o AS (SELECT a.name || b.name || x.name || y.name || z.name AS filter_order FROM l a, l b, l x, l y, l z WHERE a.bit + b.bit + x.bit + y.bit + z.bit = 31 AND a.bit | b.bit | x.bit | y.bit | z.bit = 31),
s AS (SELECT filter_order, k AS step, (SELECT bit FROM l WHERE name = substr(filter_order, k, 1)) AS bit, (SELECT coalesce(sum(bit), 0) FROM l WHERE strpos(substr(filter_order, 1, k - 1), name) > 0) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
m AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
 sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
 sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
 FROM c, (SELECT filter_order, step, CAST(bit AS INT) AS bit, CAST(before AS INT) AS before FROM s) GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM m
"""
