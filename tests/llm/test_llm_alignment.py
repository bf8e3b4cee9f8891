"""Alignment against a plain comparison of every pair of tokens, with the libraries named in the vocabularies' description."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"

from panelforge.llm import alignment as L
from panelforge.llm import bpe
from panelforge.llm.queries import QUERIES


def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(L.VOCABULARY_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=L.VOCABULARY_B), bpe.byte_of_character()


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """Every row of the result, by looking at all A tokens for each B token."""
    a, b, to_byte = sides()
    rows, links_of, counts = [], [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            rows.append((0, 0, 0, 0, ""))
            links_of.append([])
            continue
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        links = [(j, i) for (s, e), i in zip(at_a, ids_a) for (u, v), j in zip(at_b, ids_b) if s < v and u < e]
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = [",".join(str(i) for (s, e), i in zip(at_a, ids_a) if lo <= s < hi) + "|"
                  + ",".join(str(i) for (s, e), i in zip(at_b, ids_b) if lo <= s < hi) for lo, hi in zip([0, *cuts], cuts)]
        rows.append((len(ids_a), len(ids_b), len(cuts), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links_of.append(links)
        counts.update(links)
    best = {}
    for (j, _), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    full = [(n_a, n_b, g, k, sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), sha)
            for (n_a, n_b, g, k, sha), links in zip(rows, links_of)]
    return full, counts, best


def some_texts():
    rng = random.Random(2)
    words = ["the", "hello", "Straße", "naïve", "日本語", "x" * 30, "don't", "12345", "1 000", "😀", "<s>", "</s>", "<unk>", "<|endoftext|>",
             "<0x41>", "▁", "a▁b", "\t", "\n\n", "  ", "\x00", "ﬁ", "é", "क्षि", "!!!", "http://a.b/c?d=1", "\r\n"]
    texts = [None, "", " ", "a", " a", "a ", "▁", "the the the", "<|endoftext|>"]
    return texts + [rng.choice([" ", "", "\n"]).join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(250)]


@pytest.mark.parametrize("chunk_chars,radixes", [(700, 3), (6_000_000, 32)])
def test_rows_and_pairs_against_all_pairs_of_tokens(spark, chunk_chars, radixes):
    texts = some_texts()
    texts += texts[20:40]  # copies
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_a int").repartition(5)
    found = L.align(df, chunk_chars=chunk_chars, radixes=radixes)
    want, counts, best = plain(texts)
    got = {r.doc_id: tuple(r)[1:] for r in found.documents.collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] > 0 for w in want) > 100 and sum(w[0] == 0 and bool(t) for w, t in zip(want, texts)) > 50  # both kinds
    pairs = {(r.b, r.a): (r.n, r.best) for r in found.pairs.collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in counts.items()}


def test_repeated_and_missing_ids_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    rows = [(1, "one text"), (1, "one text"), (1, "another"), (None, "another"), (None, None)]
    want, _, _ = plain([t for _, t in rows])
    got = L.align(spark.createDataFrame(rows, schema)).documents.collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted((str(i), *w) for (i, _), w in zip(rows, want))
    empty = L.align(spark.createDataFrame([], schema))
    assert empty.documents.count() == 0 and empty.pairs.count() == 0
    blank = L.align(spark.createDataFrame([(1, ""), (2, None)], schema))
    assert sorted(tuple(r) for r in blank.documents.collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_merge_of_runs_with_small_blocks(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 3)
    rng = np.random.default_rng(0)
    runs, total = [], Counter()
    for _ in range(9):
        keys = sorted({(int(p), int(d)) for p, d in zip(rng.integers(0, 12, 40), rng.integers(0, 9, 40))})
        n = rng.integers(1, 5, len(keys))
        runs.append(L.run_blocks(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), n))
        for (p, _), m in zip(keys, n.tolist()):
            total[p] += m
    out = list(L.merged([*runs, []]))
    pairs = np.concatenate([p for p, _ in out]).tolist()
    assert pairs == sorted(total) and np.concatenate([c for _, c in out]).tolist() == [total[p] for p in pairs]


def test_long_texts_take_the_same_ids(monkeypatch):
    with open(L.VOCABULARY_B, "rb") as f:
        t = L.tokenizers(bpe.read(L.VOCABULARY_A), f.read())
    texts = [x for x in some_texts() if x]
    fast = [t.ids_a(" " + x).tolist() for x in texts]
    monkeypatch.setattr(L, "LONG_TEXT", 0)
    assert [t.ids_a(" " + x).tolist() for x in texts] == fast
    monkeypatch.undo()
    one = L.aligned(t, ["ab" * 150_000 + " end", "x"])
    assert one.n_links[0] >= max(one.n_a[0], one.n_b[0]) > 0 and one.n_links[1] == 1


def test_query(spark, small_dir):
    out = QUERIES["op13_tokenizer_alignment"](spark, small_dir)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    n = spark.read.parquet(f"{small_dir}/documents.parquet").count()
    rows = out.collect()
    assert len(rows) == n
    assert all(r.n_groups <= min(r.n_a, r.n_b) <= max(r.n_a, r.n_b) <= r.n_links and r.n_best <= r.n_links <= r.count_sum for r in rows)
