"""Alignment of two tokenizers against whole texts encoded at once and byte offsets by decoded bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from claimlens.llm import queries, token_align

DOCS = "doc_id long, text string, source string, slice int, pair string, n long"
A, B = (f"{token_align.TOKENIZERS}/{f}" for f in (token_align.A_FILE, token_align.B_FILE))


def letters():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.sp, self.of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), letters()
        self.a.encode_special_tokens = True

    def tokens(self, text):
        """[(id, end)] of A and of B, or none."""
        want = (" " + (text or "")).encode()
        if not text:
            return [], []
        out = []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.sp.encode(text)
        for own, part in ((ids, lambda i: bytes(self.of[c] for c in self.a.id_to_token(i))), (b, self.piece)):
            raw, tokens = b"", []
            for i in own:
                raw += part(i)
                tokens.append((i, len(raw)))
            if raw != want:
                return [], []
            out.append(tokens)
        return out

    def piece(self, i):
        p = self.sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("\u2581", " ").encode()


def brute(docs):
    plain, cut, count = Plain(), {}, Counter()
    for t in {d[1] for d in docs}:
        a, b = plain.tokens(t)
        both = sorted({e for _, e in a} & {e for _, e in b})
        ends_a, ends_b = {e: i for i, e in a}, {e: i for i, e in b}
        last, said = 0, []
        for e in both:
            said.append(",".join(str(i) for i, x in a if last < x <= e) + "|" + ",".join(str(i) for i, x in b if last < x <= e))
            last = e
        cut[t] = len(a), len(b), len(both), [(ends_a[e], ends_b[e]) for e in both], ";".join(said)
    for d in docs:
        count.update(cut[d[1]][3])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for d in docs:
        n_a, n_b, n_groups, links, said = cut[d[1]]
        out.append((d[0], n_a, n_b, n_groups, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), said))
    return out


HARD = [
    None, "", " ", "  ", "\n", "a", " a", "  two  spaces   here ", "tabs\tand\r\nlines\n\n\nend\n", "trail \n", "\u2581 marker", "in\u2581side", "<|endoftext|> <s> </s> <unk> <0x41> plain", "don't we'll 'S x's'", "na\u00efve caf\u00e9 \u00fcber stra\u00dfe", "\u65e5\u672c\u8a9e \u306e \u6587", "\U0001f389\U0001f389 party\U0001f468\u200d\U0001f469\u200d\U0001f467",
    "nb\u00a0sp \u00a0 x \u00a0\u00a0\n\n y\u2003em \u3000wide", "ctl\x1c\x1d \x1e!\x1c x\x0b y\x0c z\x00 w\x85q", "mixed \u0416\u0443\u043a \u05d0\u05d1 \u0e44\u0e17\u0e22 \u0d15 \U00010348 \ufffd \ue000", "numbers 12345 3.14159 1e-9 0x1F", "!!!??? ... --- ((( ))) {}[]<>", "x" * 5000, "ab " * 3000, "\u00e9" * 700, "\U0001f600" * 300, "e\u0301 combining", "\ufeffbom", "UPPER lower MiXeD", " " * 40 + "deep",
]


def same(got, docs):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs), key=key)


def made(n=120, seed=3):
    rng = random.Random(seed)
    alphabet = ["the", "of", "tion", "ing", " ", " ", "  ", "\n", "\t", "\u00a0", ".", ",", "'s", "\u00e9", "\u4e2d", "\U0001f680", "Z", "9", "\x1c", "\u0301", "-", "#"]
    docs = [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 5, 40, 300]))), "s", 1, "p", 2) for i in range(n)]
    return docs + [(1000 + i, t, "s", 1, "p", 2) for i, t in enumerate(HARD)] + [docs[5], docs[5], (None, "the end", "s", 1, "p", 2), (None, None, "s", 1, "p", 2)]


def test_aligned_against_whole_texts(spark):
    docs = made()
    for parts in (1, 5):
        same(token_align.aligned(spark.createDataFrame(docs, DOCS).repartition(parts), A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect(), docs)


def test_query(spark, tmp_path):
    own = [(r.doc_id, r.text, r.source, 1, "", 2) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = own + made(20, 9)
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()["op13_token_align"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((*r[:7], digest(r[7])) for r in brute(docs)), key=key)


def test_empty_table(spark):
    assert token_align.aligned(spark.createDataFrame([], DOCS), A, B).collect() == []


def test_a_worker_that_forgets_gives_the_same(monkeypatch):
    texts = [d[1] for d in made(120, 4)]
    whole = token_align.Aligner(A, B)
    small = token_align.Aligner(A, B)
    want = whole.slice(texts)
    monkeypatch.setattr(token_align, "KEPT", 3)
    for i in range(0, len(texts), 10):
        part = small.slice(texts[i : i + 10])
        assert part[0] == want[0][i : i + 10] and (part[1] == want[1][i : i + 10]).all()


def test_spans_are_refined_where_characters_are_split():
    """Every end by spans and decoded bytes is the end by decoded bytes alone, and spans alone would miss some."""
    own, missed = token_align.Aligner(A, B), 0
    for t in HARD:
        if t and "\u2581" not in t:
            a, a_ends, b, b_ends = own.encoded(" " + t)
            assert a_ends.tolist() == own.a_size[a].cumsum().tolist() and b_ends.tolist() == own.b_size[b].cumsum().tolist()
            chars = [e for _, e in own.a.encode(" " + t, add_special_tokens=False).offsets]
            missed += len(chars) - len(set(chars))
    assert missed > 100


def test_a_vocabulary_that_joins_blanks_is_refused(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a\u2581b")
    with pytest.raises(ValueError, match="joins a blank"):
        token_align.Aligner(A, B)
