"""Cross-tokenizer alignment: where two tokenizers cut a text alike, and how often their tokens end together.

Tokens get byte ranges from the tokenizers' own spans: character offsets of `tokenizers` (A) and the spans of
sentencepiece's proto (B; the release at hand gives them as return_type='proto', its immutable form is gone). A span whose
width is the number of bytes the token decodes to is an exact cut; between such cuts, where a character is spread over
several tokens or falls back to bytes, ends are counted on by decoded bytes. Ends that both have cut the text into groups;
a link is the A and the B token that end at such a place.

A text is encoded in chunks: a run of blanks and the run of other characters after it. Neither tokenizer joins what lies
on both sides of such a cut (A splits there before merging; no piece of B has a blank after another character, which is
checked when the vocabulary is loaded), so a chunk that occurs often is encoded once by each worker, many chunks at a time.
A run whose decoded bytes or cuts aren't those of its text is encoded again chunk by chunk, and a text with such a chunk
has no tokens.

Counts over the corpus: documents are taken in slices of bounded size; each slice lists its distinct id pairs once,
Spark sums them, finds each B id's largest, and sends a slice back what its pairs came to. So rows shuffled are pairs
by slice, not links, and a pair found everywhere has one row a slice.

Defined results: null and empty texts, and texts that hold U+2581 (B writes it as a space), have no tokens: zeros and ''.
A null doc_id stays; repeated rows count as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import saved, table
from claimlens.llm.hashing import slices

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: B's sign for a space.
SPACE = "▁"
#: Documents and characters that are one slice (a longer text is one alone); characters encoded at once; chunks a worker keeps.
ROWS, CHARS, RUN, KEPT = 512, 4 << 20, 1 << 16, 400_000

_CHUNK = re.compile(r"[ \t\n]*[^ \t\n]+|[ \t\n]+")
#: Blanks of other kinds, which tokenizers don't agree on or join: only a space after a character that is no blank cuts there.
_ODD = re.compile(r"[^\S \t\n]")
_ODD_CUT = re.compile(r"(?<=\S)(?= )")
_LEAD = " a"

ROW = pa.schema([("slice", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())), *[(c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups", "pairs", "times")], *[(c, pa.list_(pa.int32())) for c in ("n_pairs", "pair", "often")]])
ROW_DDL = "slice long, doc_id array<long>, groups array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, pairs array<long>, times array<long>, n_pairs array<int>, pair array<int>, often array<int>"
OUT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups", pa.string())])
OUT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones are themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ends_of(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: a span as wide as its token's bytes stands, from it on decoded bytes are counted."""
    upto = np.cumsum(size)
    last = np.maximum.accumulate(np.where(end - begin == size, np.arange(len(size)), -1))
    return upto + np.where(last >= 0, end[last] - upto[last], 0)


class Aligner:
    """Both tokenizers and what they made of the chunks seen."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_of_letter()
        own = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [bytes(byte[c] for c in own[i]) if all(c in byte for c in own.get(i, "")) and i in own else b"" for i in range(max(own) + 1)]
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            p = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode())
            if re.search(rf"[^ \t\n{SPACE}][ \t\n{SPACE}]", p):
                raise ValueError(f"piece {i} of {b_path} joins a blank to a character before it")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        n = len(self.a_bytes)
        # texts of tokens inside and at the end of a group's part, for A at 2 * id, for B after those
        self.says = [f"{i}{sep}" for i in range(n) for sep in ",|"] + [f"{i}{sep}" for i in range(len(self.b_bytes)) for sep in ",;"]
        self.shift = 2 * n
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.text: list[str] = []
        self.pair_code: dict[int, int] = {}
        self.pairs = np.zeros(0, np.int64)
        self.n = np.zeros((0, 3), np.int64)  # A tokens, B tokens, groups of each chunk; -1: it can't be aligned
        self.links, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def chunks(self, text: str | None) -> list[str]:
        if not text or SPACE in text:
            return []
        text = " " + text
        return _ODD_CUT.split(text) if _ODD.search(text) else _CHUNK.findall(text)

    def encoded(self, run: str) -> tuple | None:
        """(A ids, A ends, B ids, B ends) of a text that begins with a space; None if either doesn't give its bytes."""
        raw = run.encode()
        enc = self.a.encode(run, add_special_tokens=False)
        spans = np.fromiter(chain.from_iterable(enc.offsets), np.int64).reshape(-1, 2)
        if len(raw) != len(run):
            letters = np.frombuffer(run.encode("utf-32-le"), np.uint32)
            at = np.concatenate([[0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))])
            spans = at[spans]
        a = np.array(enc.ids, np.int64)
        pieces = self.b.encode(run[1:], return_type="proto").pieces
        b = np.array([p.id for p in pieces], np.int64)
        begin, end = np.array([p.begin for p in pieces], np.int64) + 1, np.array([p.end for p in pieces], np.int64) + 1
        if b"".join([self.a_bytes[i] for i in enc.ids]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None
        return a, ends_of(spans[:, 0], spans[:, 1], self.a_size[a]), b, ends_of(begin, end, self.b_size[b])

    def run(self, own: list[str]) -> bool:
        """Learn chunks from one encoding of them all; False if it doesn't cut where they do."""
        sizes = np.cumsum([len(_LEAD), *[len(c.encode()) for c in own]])
        got = self.encoded(_LEAD + "".join(own))
        if got is None:
            return False
        a, a_ends, b, b_ends = got
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if a_ends[-1] != sizes[-1] or b_ends[-1] != sizes[-1] or not np.isin(sizes, common, assume_unique=True).all():
            return False
        ia, ib = np.searchsorted(a_ends, common), np.searchsorted(b_ends, common)
        code = a[ia] * len(self.b_bytes) + b[ib]
        for c in np.unique(code).tolist():
            self.pair_code.setdefault(c, len(self.pair_code))
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[ia], b_last[ib] = 1, 1
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        said = np.concatenate([2 * a + a_last, self.shift + 2 * b + b_last])[order]
        says = [self.says[i] for i in said.tolist()]
        n = np.stack([np.bincount(np.searchsorted(sizes, x), minlength=len(sizes)) for x in (a_ends, b_ends, common)], axis=1)
        upto = np.cumsum(n[:, 0] + n[:, 1]).tolist()
        for i, c in enumerate(own):
            self.code[c] = len(self.text)
            self.text.append("".join(says[upto[i] : upto[i + 1]]))
        links = np.array([self.pair_code[c] for c in code[n[0, 2] :].tolist()], np.int32)
        self.links = np.concatenate([self.links, links])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n[1:, 2])])
        self.n = np.concatenate([self.n, n[1:]])
        return True

    def learn(self, new: list[str]) -> None:
        # a chunk that ends in a blank could join the next one's
        alone = [c for c in new if c[-1].isspace()]
        runs, size = [[c] for c in alone], RUN
        for c in new:
            if not c[-1].isspace():
                if size + len(c) > RUN:
                    runs.append([])
                    size = 0
                runs[-1].append(c)
                size += len(c)
        for own in runs:
            if own and not self.run(own):
                for c in own:
                    if len(own) == 1 or not self.run([c]):
                        self.code[c] = len(self.text)
                        self.text.append("")
                        self.n = np.concatenate([self.n, [[-1, -1, -1]]])
                        self.first = np.append(self.first, self.first[-1])
        self.pairs = np.fromiter(self.pair_code, np.int64, len(self.pair_code))

    def slice(self, texts: list) -> tuple:
        """Of each text the groups' text, its counts (A, B, groups), and its distinct pairs with how often each is linked:
        (groups, counts, pairs of the slice, their totals, pairs by text, index and multiplicity of each)."""
        if len(self.code) > KEPT:
            self.forget()
        own = [self.chunks(t) for t in texts]
        every = list(chain.from_iterable(own))
        new = set(every).difference(self.code)
        if new:
            self.learn(sorted(new))
        codes = np.fromiter(map(self.code.__getitem__, every), np.int64, len(every))
        doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
        bad = np.zeros(len(own), bool)
        bad[doc[self.n[codes, 0] < 0]] = True
        codes, doc = codes[~bad[doc]], doc[~bad[doc]]
        counts = np.stack([np.bincount(doc, self.n[codes, k], len(own)).astype(np.int64) for k in range(3)], axis=1)
        said = ["" if bad[i] else "".join([self.text[self.code[c]] for c in x])[:-1] for i, x in enumerate(own)]
        long = self.first[codes + 1] - self.first[codes]
        at = np.repeat(self.first[codes] - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(long.sum()) if len(codes) else np.zeros(0, np.int64)
        width = max(1, len(self.pairs))
        both, often = np.unique(np.repeat(doc, long) * width + self.links[at], return_counts=True)
        by, pair = both // width, both % width
        there, index = np.unique(pair, return_inverse=True)
        times = np.bincount(index, often, len(there)).astype(np.int64)
        return said, counts, self.pairs[there], times, np.bincount(by, minlength=len(own)), index, often


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """A worker's own, kept between its tasks."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _parts(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Rows that are a slice: ROWS at most, CHARS at most but for a single text."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t or "") > CHARS:
            yield ids[first:i], texts[first:i]
            first, size = i, 0
        size += len(t or "")
    if texts:
        yield ids[first:], texts[first:]


def sliced(docs: DataFrame, a_path: str, b_path: str, digest: bool) -> DataFrame:
    """One row per slice of documents, as Aligner.slice gives it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in slices(batches, ROWS):
            for ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                said, counts, pairs, times, n_pairs, pair, often = own.slice(texts)
                if digest:
                    said = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
                row = [number, ids, said, *counts.T, pairs, times, n_pairs, pair, often]
                yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, ROW, strict=True)], schema=ROW)
                number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, ROW_DDL)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices with what their pairs came to in the corpus -> one row per document."""
    for batch in slices(batches, 1):
        row = dict(zip(batch.schema.names, (c[0].values for c in batch.columns), strict=True))
        pairs, n_pairs, pair, often = (row[c].to_numpy() for c in ("pairs", "n_pairs", "pair", "often"))
        often, upto = often.astype(np.int64), np.cumsum(n_pairs)
        total = top = often
        if len(pair):
            came, n, best = (row["reply"].field(k).to_numpy() for k in ("pair", "n", "top"))
            order = np.argsort(came)
            at = order[np.searchsorted(came[order], pairs)][pair]
            total, top = n[at] * often, best[at] * often

        def by_doc(values: np.ndarray, upto: np.ndarray = upto, n: np.ndarray = n_pairs) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(values)])
            return pa.array(sums[upto] - sums[upto - n], pa.int64())

        yield pa.record_batch([row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], by_doc(often), by_doc(top), by_doc(total), row["groups"]], schema=OUT)


def aligned(docs: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (`a1,a2|b1;a3|b2,b3`, token
    ids of each group; with `digest` only their SHA-256)."""
    n_b = len_b(b_path)
    rows = saved(sliced(docs, a_path, b_path, digest))
    asked = rows.select("slice", F.explode(F.arrays_zip("pairs", "times")).alias("_x")).select("slice", F.col("_x.pairs").alias("pair"), F.col("_x.times").alias("times"))
    counts = saved(asked.groupBy("pair").agg(F.sum("times").alias("n")))
    most = counts.groupBy((F.col("pair") % n_b).alias("_b")).agg(F.max("n").alias("_most"))
    known = counts.join(most, F.col("pair") % n_b == F.col("_b")).select(F.col("pair").alias("_pair"), "n", (F.col("n") == F.col("_most")).cast("long").alias("top"))
    told = asked.select("slice", "pair").join(known, F.col("pair") == F.col("_pair"))
    # as many as the slice has distinct pairs
    reply = told.groupBy(F.col("slice").alias("_slice")).agg(F.collect_list(F.struct("pair", "n", "top")).alias("reply"))
    return rows.drop("times").join(reply, F.col("slice") == F.col("_slice"), "left").drop("slice", "_slice").mapInArrow(_told, OUT_DDL)


def len_b(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()


def op13(spark, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    out = aligned(table(spark, sf_dir, "documents"), f"{tokenizers}/{A_FILE}", f"{tokenizers}/{B_FILE}", digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")
