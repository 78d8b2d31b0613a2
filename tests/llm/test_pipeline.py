"""The pipeline's stages take effect, each on its predecessor's rows."""

import corpus_pipeline
from claimlens.llm.common import table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        out = stage(spark, docs, sf)
        assert out.columns == before, name
        docs = corpus_pipeline.saved(out)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    rows = last.groupBy("shard").count().collect()
    assert sum(r["count"] for r in rows) == sizes[4] and max(r["count"] for r in rows) - min(r["count"] for r in rows) <= 1


HARD = "doc_id long, text string, lang string, source string, n_chars long, _score double, _size long, _u long, _mix string, _copy int, _places int, _at int, _pid long, _key long, _nth int, row string, shard string"


def hard_rows():
    """Nulls in any column, empty and very long texts, repeated rows and ids, ties, and names that stages use."""
    filler = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    tail = lambda i: (1, 0.5, i, i, "m", 1, 2, 3, 4, 5, 6, "r", "s")
    rows = [(i, filler(i % 25), ["en", None][i % 2], ["a", None, "b"][i % 3], *tail(i)) for i in range(40)]
    rows += [(50, None, None, None, *[None] * 13), (51, "", "en", "a", *tail(1)), (52, " \t\n", "en", "a", *tail(1)), (53, "x " * 60_000, "en", "b", *tail(1)), (None, "no id here", "en", "a", *tail(2))]
    return rows + rows[:5] + [(*rows[0][:4], *tail(77)), (3, "another text of the same id", "en", "a", *tail(3))]


def test_stages_on_hard_rows(spark, sf):
    rows = hard_rows()
    frames = [spark.createDataFrame(r, HARD).repartition(3) for r in (rows, [])]
    for name, stage in corpus_pipeline.STAGES:
        outs = [corpus_pipeline.saved(stage(spark, f, sf)) for f in frames]
        assert outs[1].count() == 0, name
        got = [tuple(r) for r in outs[0].select(*[c for c in HARD.replace(" long", "").replace(" string", "").replace(" double", "").replace(" int", "").split(", ") if name != "hilbert_sharding" or c != "shard"]).collect()]
        cut = 16 if name == "hilbert_sharding" else 17
        assert set(got) <= {r[:cut] for r in rows}, name
        ids = [g[0] for g in got]
        if name == "minhash_near_dedup":
            real = [i for i in ids if i is not None]
            # of 25 texts one document each, and those that are in no group
            assert sorted(real) == sorted(set(real)) and set(range(25)) <= set(real) and not set(range(25, 40)) & set(real) and {50, 51, 52, 53} <= set(real) and None in ids
        if name == "benchmark_decontamination":
            assert len(got) == len(rows)
        if name == "hilbert_sharding":
            places = outs[0].select("shard", "slot").collect()
            assert len(got) == len(rows) and len(set(places)) == len(rows)
            again = stage(spark, frames[0].repartition(5), sf)
            assert sorted(map(str, again.collect())) == sorted(map(str, outs[0].collect()))
