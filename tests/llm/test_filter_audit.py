"""The audit of filter interactions against a walk of every document through every order."""

import random
import re
from collections import defaultdict
from itertools import permutations

from claimlens.llm import filter_audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, mask int, part string, n int, digest string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    first = {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    mark = defaultdict(lambda: [0, 0])
    for i, q, x in labels:
        if i is not None:
            mark[i] = [max(mark[i][0], int(q == 1)), max(mark[i][1], int(x == 1))]
    rows = []
    for i, t, s, *_ in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = set()
        fails |= {"A"} if len(w) < 50 else set()
        fails |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if i is not None and i > first[t] else set()
        rows.append((s or "", fails, *(mark[i] if i is not None else (0, 0))))
    out = {}
    for part in {r[0] for r in rows}:
        own, shapley = [r for r in rows if r[0] == part], defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            for k in range(5):
                f, before = order[k], set(order[:k])
                gone = [r for r in own if f in r[1] and not r[1] & before]
                out[part, order, k + 1] = [sum(not r[1] & (before | {f}) for r in own), len(gone), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[f] += len(gone)
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return out


def told(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): list(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def sample():
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta\u00a0x", "#tag", "50%", "ümlaut", "LOUD"] + [f"w{i}" for i in range(80)]
    texts = [None, "", " \t\n", "A", "a|b", " ".join(f"w{i}" for i in range(60)), "x " * 30000, " ".join(f"w{i}" for i in range(60))]
    texts += [" ".join(rng.choice(words[: rng.choice([5, 12, 88])]) for _ in range(rng.choice([3, 49, 50, 51, 120]))) for _ in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""]), 1, "other", 9, "z") for i in range(200)]
    docs += [docs[3], docs[3], docs[40], (None, texts[5], "a", 1, "", 9, "z"), (None, texts[5], "a", 1, "", 9, "z"), (-4, texts[5], "c", 1, "", 9, "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    return docs, labels


def test_every_order_against_brute_force(spark, tmp_path):
    docs, labels = sample()
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    assert told(queries.queries()["op12_filter_audit"](spark, str(tmp_path))) == brute(docs, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert filter_audit.audit(none, spark.createDataFrame([], LABELS)).collect() == []
    one = told(filter_audit.audit(spark.createDataFrame([(1, "a", "s", 0, "", 0, "")], DOCS), spark.createDataFrame([], LABELS)))
    assert len(one) == 600 and one["s", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_the_walk_is_as_large_as_its_letters_make_it(spark):
    """5 + 20 + 60 + 120 + 120 prefixes with 32 masks each, and other sets of letters."""
    assert filter_audit.walk(spark, "ABCDE").count() == 325 * 32
    assert filter_audit.walk(spark, "XYZ").count() == 15 * 8
