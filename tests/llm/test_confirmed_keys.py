"""Keys only find; texts that agree in their keys are told apart all the same."""

from __future__ import annotations

from collections import defaultdict

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from tablewharf.llm import minhash, packing, pretokens, suffix_index, token_count
from tablewharf.llm.queries import tokenizer_path


def thue_morse(length, a, b):
    """Two words whose polynomial keys modulo 2**64 agree, whatever the base."""
    bits = [bin(n).count("1") & 1 for n in range(length)]
    return "".join(b if bit else a for bit in bits), "".join(a if bit else b for bit in bits)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture
def twins(spark):
    words = [*thue_morse(1024, "x", "q"), *thue_morse(2048, "e", "z")]
    return words, spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1)


def test_counts_and_ids_of_words_with_equal_polynomials(twins, tokenizer):
    words, frame = twins
    ids = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    found = {r.doc_id: r.n_tokens for r in token_count.count_tokens(frame, tokenizer_path()).collect()}
    assert found == {i: len(x) for i, x in enumerate(ids)}
    pieces = defaultdict(list)
    for r in packing.pack(frame, tokenizer_path()).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for i, x in enumerate(ids):
        whole = [*x, 1]
        assert sum(n for _, n, _ in pieces[i]) == len(whole)
        assert all(brute.crc(whole[at : at + n]) == crc for at, n, crc in pieces[i])


@pytest.mark.parametrize("clash", [lambda keys: keys * np.uint64(0), lambda keys: keys % np.uint64(7)])
def test_pre_tokens_whose_keys_clash(tokenizer, monkeypatch, clash):
    texts = ["The cat sat", "on the mat, the mat", "zebra zebra zyx", "aa ab ba bb", *thue_morse(64, "p", "k")] * 3
    keys = pretokens.PreTokens._keys
    monkeypatch.setattr(pretokens.PreTokens, "_keys", staticmethod(lambda *a: clash(keys(*a))))
    encoder, found = pretokens.PreTokens(tokenizer_path()), defaultdict(list)
    for index, _, ids in encoder.encode(texts, want_ids=True):
        found[index] += ids.tolist()
    assert [found[i] for i in range(len(texts))] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents_with_equal_polynomials_do_not_link(spark, twins):
    words, frame = twins
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame, shingle=2).collect()}
    assert found == brute.near_duplicates(list(enumerate(words)), 2, 80)
    # Equal sets in another order are different classes and still link; case and white space do not matter.
    texts = ["a b a b", "A  B\ta b", "b a b a b", "tick tick", "tick " * 900, "other words here"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(rows, shingle=2).collect()}
    assert found == brute.near_duplicates(list(enumerate(texts)), 2, 80)


def test_passages_with_equal_polynomials_stay(spark):
    # Exactly one string of 256 bytes in each text.
    texts = [*thue_morse(256, "u", "v"), "short"]
    for length in (200, 256):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.row.doc_id: (r.n_bytes, r.n_removed, len(r.spans)) for r in suffix_index.repeated_passages(rows, length).collect()}
        assert found == {i: e[:3] for i, e in enumerate(brute.repeated_passages(texts, length))}


def test_passages_of_rows_without_or_with_one_id(spark, monkeypatch):
    """Null and repeated ids with many texts, and one row many times."""
    texts = [f"{i} " + "abcdefghij" * (i % 4) + " tail" for i in range(30)] + ["the same row, and it is long enough"] * 20
    rows = [(None if i % 2 else 7, t) for i, t in enumerate(texts)]
    for crowd in (2000, 1):
        monkeypatch.setattr(suffix_index, "CROWD", crowd)
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        found = sorted((r.row.text, r.n_bytes, r.n_removed, len(r.spans)) for r in suffix_index.repeated_passages(frame, 20, 8).collect())
        assert found == sorted((t, *e[:3]) for t, e in zip(texts, brute.repeated_passages(texts, 20)))


def test_odd_column_names(spark):
    frame = spark.createDataFrame([(1, "text of a document", 2)], ["doc_id", "text", "a-b c"])
    assert suffix_index.repeated_passages(frame).select("row.`a-b c`").first()[0] == 2
