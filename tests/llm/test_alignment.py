"""Alignment of two tokenizers against sets of bytes."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.alignment import Csr, align, alignment_scores, alignments, product, shared_degrees, shared_links, transposed

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    (1, "the quick brown fox's jumps over 12345 lazy dogs"),
    (2, "the quick brown fox's jumps over 12345 lazy dogs"),
    (2, "the quick brown fox's jumps over 12345 lazy dogs"),  # a repeated row
    (3, ""),
    (4, None),
    (5, "<|endoftext|> <s> </s> <unk> <0x41> plain"),
    (6, "a piece mark ▁ is not given back"),
    (None, "Straße ÀÉ 日本語 😀\x00 é́ K ﬁ"),
    (7, " two  spaces\t\n\n\r\n "),
    (8, "x" * 4000 + " " * 3000 + "ab" * 3000),
    (9, "▁"),
    (10, "Étion dans çouelle un éonierç le ch trement. " * 200),
]


def truth():
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups) by sets of bytes."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    back = {c: b for b, c in enumerate(alignment.byte_letters())}
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append(range(at, at + len(p)))
            at += len(p)
        return out

    docs = []
    for key, text in TEXTS:
        a = b = []
        if text:
            ids = first.encode(" " + text, add_special_tokens=False).ids
            raw_a = [bytes(back[c] for c in first.id_to_token(i)) for i in ids]
            ids_b = second.encode(text)
            raw_b = [bytes_b(i) for i in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                a, b = list(zip(ids, spans(raw_a))), list(zip(ids_b, spans(raw_b)))
        ends = sorted({s.stop for _, s in a} & {s.stop for _, s in b})
        groups, low = [], 0
        for e in ends:
            groups.append(([i for i, s in a if low < s.stop <= e], [i for i, s in b if low < s.stop <= e]))
            low = e
        links = []
        for i, s in a:
            for j, t in b:
                if t.start >= s.stop:
                    break
                if t.stop > s.start:
                    links.append((i, j))
        docs.append((key, a, b, groups, links))
    count = Counter(p for d in docs for p in d[4])
    high = {}
    for (_, j), n in count.items():
        high[j] = max(high.get(j, 0), n)
    for key, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        shared = sum(len(x) * len(y) for x, y in groups)
        yield key, len(a), len(b), len(groups), len(links), shared, sum(count[p] == high[p[1]] for p in links), sum(count[p] for p in links), digest


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that clash with names inside the operator stand beside the texts."""
    rows = [(i, t, 1, 2, 3, "g", 4) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, a int, b int, n int, groups string, row int").repartition(3)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 50, 1])
def test_against_sets_of_bytes(docs, rows, monkeypatch, frequent):
    """Whether pairs are broadcast or shuffled."""
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    assert rows(alignment_scores(docs, A, B)) == sorted(truth(), key=repr)


def test_long_text_in_blocks():
    rng = np.random.default_rng(0)
    a, b = (np.append(np.sort(rng.choice(9999, n, replace=False)) + 1, 10_000) for n in (3000, 2500))
    whole, parts = align(a, b, 1 << 30), align(a, b, 64)
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))
    assert len(whole.link_a) == len(a) + len(b) - len(whole.cuts)  # one per stretch that no end divides


def test_row_products():
    rng = np.random.default_rng(1)
    left, right = rng.random((13, 7)) < 0.3, rng.random((7, 11)) < 0.3

    def sparse(m):
        return Csr(np.concatenate(([0], np.cumsum(m.sum(1)))), np.nonzero(m)[1], m.shape[1])

    got, value = product(sparse(left), sparse(right))
    dense = np.zeros((13, 11), int)
    dense[np.repeat(np.arange(13), np.diff(got.ptr)), got.idx] = value
    assert (dense == left.astype(int) @ right.astype(int)).all()
    turned = transposed(sparse(left))
    assert (turned.idx == np.nonzero(left.T)[1]).all() and turned.cols == 13


def test_shared_group_links():
    group_a, group_b = np.array([0, 0, 1, 2]), np.array([0, 1, 1, 1, 2, 2])
    links = shared_links(group_a, group_b, 3)
    assert np.diff(links.ptr).tolist() == shared_degrees(group_a, group_b, 3).tolist() == [1, 1, 3, 2]
    assert links.idx.tolist() == [0, 0, 1, 2, 3, 4, 5]


def test_nothing(docs):
    assert alignment_scores(docs.limit(0), A, B).isEmpty()
    assert alignments(docs.where("doc_id in (3, 4)"), A, B).where("n_a + n_b + n_links + size(links) = 0 and groups = ''").count() == 2
