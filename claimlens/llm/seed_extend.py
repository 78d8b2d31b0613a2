"""Substring dedup of words by seed and extend.

Documents meet on winnowed anchors: five-word seeds, of which every window of 20 words holds one. All contexts
of a seed are extended from it together, word by word to the left and to the right: those that agree so far stay in
one class, which the next word splits. Contexts of one class a words to the left and of one class 15 - a words to
the right share a window, and overlapping windows join to maximal repeats of at least 20 words. So a seed of m
contexts costs 30 steps over m, not pairs. Equal contexts and hot seeds are dealt with as repeats.py says.

Defined results: a null text has no words; rows of one doc_id are one document of several texts, in the order
of the texts' hashes, and rows alike in doc_id and text don't count against each other; a null doc_id comes
before all others; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table
from claimlens.llm.repeats import Windows, covered, spans_of, unzipped

WORDS = Windows("word", 20, 5)


def classes(*columns: np.ndarray) -> np.ndarray:
    """Numbers (from 0 on) of the distinct combinations of the columns' values."""
    out = np.unique(columns[0], return_inverse=True)[1]
    for c in columns[1:]:
        kinds, at = np.unique(c, return_inverse=True)
        out = np.unique(out * len(kinds) + at, return_inverse=True)[1]
    return out


def resolve(rows: list[tuple], spec: Windows = WORDS) -> list[list[tuple[int, int]]]:
    """For contexts of whole seeds, the earliest of a seed first: which of their windows stand in an earlier one too."""
    reach, k, m = spec.length - spec.seed, spec.seed, len(rows)
    out: list[list[tuple[int, int]]] = [[] for _ in rows]
    if m < 2:
        return out
    # beyond a context's end stand numbers that equal nothing
    left = np.arange(m * reach, dtype=np.uint64).reshape(m, reach)
    right = left + np.uint64(m * reach)
    core = np.zeros((m, k), np.uint64)
    seeds: dict = {}
    seed = np.array([seeds.setdefault(r[0], len(seeds)) for r in rows])
    back, more = (np.array([r[3] >> bits & 255 for r in rows]) for bits in (8, 0))
    for i, r in enumerate(rows):
        words, b = np.frombuffer(r[4], np.uint64), int(back[i])
        before, after = words[:b][::-1][:reach], words[b + k :][:reach]
        left[i, : len(before)], right[i, : len(after)], core[i] = before, after, words[b : b + k]
    to_left, to_right = [classes(seed, *core.T)], [classes(seed, *core.T)]
    for a in range(reach):
        to_left.append(classes(to_left[-1], left[:, a]))
        to_right.append(classes(to_right[-1], right[:, a]))
    found_row, found_start = [], []
    for a in range(reach + 1):
        start = back - a
        at = np.flatnonzero((start >= 0) & (start <= more))
        if len(at):
            shared = classes(to_left[a][at], to_right[reach - a][at])
            again = np.ones(len(at), bool)
            again[np.unique(shared, return_index=True)[1]] = False
            found_row.append(at[again])
            found_start.append(start[at[again]])
    row, start = np.concatenate(found_row), np.concatenate(found_start)
    order = np.lexsort((start, row))
    for i, p in zip(row[order].tolist(), start[order].tolist(), strict=True):
        if out[i] and out[i][-1][1] == p - 1:
            out[i][-1] = (out[i][-1][0], p)
        else:
            out[i].append((p, p))
    return out


def maximal_repeats(docs: DataFrame, spec: Windows = WORDS) -> DataFrame:
    """doc_id, n_words, spans (start, end in words) of the repeats to remove, and the text that is kept."""

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, spans, kept = [], [], []
                for raw, marks in zip(unzipped(batch.column(2).to_pylist()), batch.column(3).to_pylist(), strict=True):
                    words = raw.split()
                    own = spans_of([(x["first"], x["more"]) for x in marks or ()], spec.length)
                    left, upto = [], 0
                    for s, e in own:
                        left += words[upto:s]
                        upto = e
                    n.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in own])
                    kept.append(b" ".join(left + words[upto:]))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["_id", "n_words", "spans", "kept"])

    out = covered(docs, spec, resolve).mapInArrow(work, "_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.select(F.nullif("_id", F.lit(-(1 << 63))).alias("doc_id"), "n_words", "spans", "kept")


def op7(spark, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = maximal_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same by plain SQL: every window of 20 words, grouped by its content.
SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM words WHERE len(w) >= 20),
windows AS (SELECT doc_id, s, sha256(array_to_string(list_slice(w, s, s + 19), ' ')) AS h FROM starts),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM windows),
gone AS (SELECT doc_id, list(s) AS ss FROM ranked WHERE r > 1 GROUP BY doc_id),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM (SELECT doc_id, unnest(ss) AS s FROM gone)),
hits AS (SELECT doc_id, list(i) AS d, count(*) AS n FROM hit GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
left_words AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.i) AS kept FROM each_word e
               LEFT JOIN hit h ON h.doc_id = e.doc_id AND h.i = e.i WHERE h.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(l.kept, '')) AS kept_sha256
FROM words w LEFT JOIN hits h ON h.doc_id = w.doc_id LEFT JOIN left_words l ON l.doc_id = w.doc_id
"""
