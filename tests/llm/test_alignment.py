"""Alignment against both libraries on whole texts, with links found by comparing byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stoploom.llm import alignment
from stoploom.llm.queries import ALIGNED, QUERIES

PATHS = [public_tokenizers.path(p) for p in ALIGNED]
SPEC = alignment.load(*PATHS)
A = tokenizers.Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
TOK = alignment.Tokenizers(*SPEC)


def ranges(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True)) if tokens else []


def plain(texts):
    """Every row's figures from whole texts; links by comparing all byte ranges."""
    letters = {v: k for k, v in alignment._byte_letters().items()}
    made, held = [], Counter()
    for text in texts:
        line = (" " + (text or "")).encode()
        a = A.encode(" " + text, add_special_tokens=False) if text else None
        ids_a, ids_b = (a.ids, B.encode(text)) if text else ([], [])
        back = {c: b for b, c in letters.items()}
        bytes_a = [bytes(back[c] for c in A.id_to_token(i)) for i in ids_a]
        pieces = [B.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
        if not text or b"".join(bytes_a) != line or b"".join(bytes_b) != line:
            made.append((0, 0, [], [], ""))
            continue
        ra, rb = ranges(bytes_a), ranges(bytes_b)
        links, first = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[first][1] <= s:
                first += 1
            j = first
            while j < len(rb) and rb[j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, begin = [], 0
        for cut in cuts:
            own = [",".join(str(i) for i, (s, e) in zip(ids, r, strict=True) if begin <= s and e <= cut) for ids, r in ((ids_a, ra), (ids_b, rb))]
            groups.append("|".join(own))
            begin = cut
        made.append((len(ids_a), len(ids_b), groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(na, nb, len(g), len(x), sum(held[p] == most[p[0]] for p in x), sum(held[p] for p in x), h) for na, nb, g, x, h in made]


def texts(seed=3):
    rng = random.Random(seed)
    marks = ["<|endoftext|>", "</s>", "<unk>", "<0x41>", "▁", "a▁b", "don't", "naïve", "ß", "한글", "日本語。", "😀👍🏽", "\xa0", " ", "　", "\x1c", "\x00", "\t", "١٢", "é", "12,345.67", "ﬁ", "​", "Ω"]
    out = [None, "", " ", "\n", "  two blanks  inside and behind  ", " one before", "x" * 2_000, "ab " * 2_000, "é" * 700, "日本" * 300, "a ́b", "a \n b"]
    for _ in range(60):
        parts = [rng.choice(marks) if rng.random() < 0.25 else "".join(rng.choices("abcdeABC123.,-'éÉ", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 40))]
        out.append("".join(p + rng.choice([" ", " ", "", "  ", "\n"]) for p in parts))
    return out + out[-3:]


def test_query_equals_whole_texts(spark, docs, tables):
    sample = texts()
    found = QUERIES["op12_tokenizer_alignment"](spark, tables(documents=docs(sample).repartition(3)))
    got = {r["doc_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == dict(enumerate(plain(sample)))


@pytest.mark.parametrize("chars", [1, 500, 1 << 20])
def test_blocks_of_any_size_give_the_same(docs, chars):
    sample = texts(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs(sample).repartition(2), SPEC, chars=chars).collect()}
    assert got == dict(enumerate(plain(sample)))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab .'1é▁ \n\t　\x1c日<0x41>s/"), max_size=40))
def test_words_side_by_side_are_the_text(text):
    words = alignment.Words(TOK, TOK.words(text))
    na, nb, groups, links, _, _, digest = plain([text])[0]
    if not text or not words.good.all():
        assert na == nb == 0
    else:
        assert words.a.tolist() == A.encode(" " + text, add_special_tokens=False).ids and words.b.tolist() == B.encode(text)
        assert (len(words.a_groups.transposed().starts) - 1, len(words.links.columns)) == (groups, links)
        assert hashlib.sha256(";".join(words.texts(TOK)).encode()).hexdigest() == digest


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_products_equal_dense_ones(seed):
    rng = np.random.default_rng(seed)
    left, right = rng.integers(0, 3, (rng.integers(1, 9), 7)), rng.integers(0, 3, (7, rng.integers(1, 9)))

    def sparse(m):
        rows, columns = np.nonzero(m)
        return alignment.Csr(np.concatenate(([0], np.cumsum((m > 0).sum(axis=1)))), columns, m[rows, columns], m.shape[1])

    def dense(x):
        out = np.zeros((len(x.starts) - 1, x.width), dtype=np.int64)
        out[x.rows(), x.columns] = x.values
        return out

    alignment._ENTRIES, before = int(rng.integers(1, 20)), alignment._ENTRIES
    try:
        assert (dense(sparse(left).times(sparse(right))) == left @ right).all()
        assert (dense(sparse(left).transposed()) == left.T).all()
    finally:
        alignment._ENTRIES = before


def test_links_and_groups_with_places(docs):
    text = "naïve 日本語 cafés"
    words = alignment.Words(TOK, TOK.words(text))
    ra, rb = (ranges([t[i] for i in ids.tolist()]) for t, ids in ((TOK.a_bytes, words.a), (TOK.b_bytes, words.b)))
    want = sorted((i, j, min(e, f) - max(s, g)) for i, (s, e) in enumerate(ra) for j, (g, f) in enumerate(rb) if s < f and g < e)
    rows = alignment.links(docs([text, None, "a▁b"]), SPEC).collect()
    assert sorted((r["a_at"], r["b_at"], r["n_bytes"]) for r in rows) == want and {r["doc_id"] for r in rows} == {0}
    cuts = sorted({e for _, e in ra} & {e for _, e in rb})
    group = lambda e: next(k for k, c in enumerate(cuts) if e <= c)
    shared = alignment.links(docs([text]), SPEC, shared=True).collect()
    assert sorted((r["a_at"], r["b_at"]) for r in shared) == [(i, j) for i, (_, e) in enumerate(ra) for j, (_, f) in enumerate(rb) if group(e) == group(f)]


def test_repeated_rows_null_ids_and_clashing_columns(docs):
    rows = [(4, "zebra quilt", "a"), (4, "zebra quilt", "a"), (None, "quilt of zebras", "b"), (None, None, "d")]
    df = docs(rows)
    for name in ("block", "words", "pairs", "n", "best", "at", "of", "digest", "pair"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in alignment.align(df, SPEC).collect())
    assert got == sorted((str(i), *p) for (i, _, _), p in zip(rows, plain([t for _, t, _ in rows]), strict=True))


def test_empty_table(docs):
    assert alignment.align(docs([]), SPEC).collect() == []
