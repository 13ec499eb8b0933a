"""The registered queries over a whole small folder, against plain versions."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from test_llm_operators import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tablewharf.llm import language, minhash, queries
from tablewharf.llm.common import store
from tablewharf.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def rows(small):
    def read(table, *columns):
        return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{small}/{table}.parquet'").fetchall()

    return read


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_op1(spark, small, rows, tokenizer):
    found = {tuple(r) for r in queries.op1_token_counts(spark, small).collect()}
    expected = set()
    for doc_id, text in rows("documents", "doc_id", "text"):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.add((doc_id, len((text or "").encode()), n, n > 1024))
    assert found == expected


def test_op2(spark, small, rows):
    found = {r.doc_id: r for r in queries.op2_language(spark, small).collect()}
    docs = rows("documents", "doc_id", "text", "lang")
    assert len(found) == len(docs)
    held = [(found[i].lang_pred == lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in docs)
    assert np.mean(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_op3(spark, small, rows):
    found = sorted(tuple(r) for r in queries.op3_kd_trees(spark, small).collect())
    vectors = {i: np.floor(np.array(v, float) * 256) for i, v in rows("embeddings", "vec_id", "embedding")}
    expected = []
    for q in (i for i in vectors if i % 50 == 0):
        scored = sorted((-int(v @ vectors[q]), i) for i, v in vectors.items() if i != q)
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert found == sorted(expected)


def test_op4(spark, small, rows):
    found = {r.page_id: r for r in queries.op4_main_text(spark, small).collect()}
    pages = rows("pages", "page_id", "html")
    assert len(found) == len(pages)
    for page_id, page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(b for b in blocks if b)
        assert (found[page_id].text, found[page_id].n_chars) == (text, len(text))


def test_op5(spark, small, rows):
    found = {r[0]: tuple(r[1:]) for r in queries.op5_small_worlds(spark, small).collect()}
    assert found == brute.cosine_groups(rows("embeddings", "vec_id", "embedding"), 0.95)


def test_op6(spark, small, rows):
    found = {r[0]: tuple(r[1:]) for r in queries.op6_superminhash(spark, small).collect()}
    assert found == brute.near_duplicates(rows("documents", "doc_id", "text"), 2, 80)


def test_op6_in_blocks(spark, monkeypatch):
    """A bucket of loose copies whose centre does not reach all of them."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"w{rng.integers(400)}" for _ in range(150)]
    docs = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.integers(15)):
            words[rng.integers(150)] = f"x{rng.integers(10**6)}"
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(frame, shingle=2).collect()}
    assert found == brute.near_duplicates(docs, 2, 80)


def test_op7(spark, small, rows, tokenizer):
    found = queries.op7_packing(spark, small).collect()
    sequences = check_packing(found, rows("documents", "doc_id", "text"), tokenizer, 2048)
    sizes = [sum(length for _, length in parts) for parts in sequences.values()]
    padding = sum(2048 - s for s in sizes if s & (s - 1))
    assert padding <= 0.05 * sum(sizes)


def test_op8(spark, small, rows):
    found = queries.op8_entropy_mix(spark, small).collect()
    size = {i: len(brute.WORDS.findall(t or "")) for i, t in rows("documents", "doc_id", "text")}
    assert {r.doc_id: r["size"] for r in found} == size
    taken, target, largest = Counter(), {}, Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    # Whole copies: a source of some ten documents misses by half of its largest one at most.
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 30) for s in target)
    assert sum(abs(taken[s] - target[s]) for s in target) <= 0.02 * sum(target.values())


def test_op9(spark, small, rows):
    found = queries.op9_byte_shards(spark, small).collect()
    texts = dict(rows("documents", "doc_id", "text"))
    assert Counter(r.doc_id for r in found) == Counter(list(texts))
    total, slots = Counter(), defaultdict(list)
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(total) == set(range(8))
    assert max(total.values()) - min(total.values()) <= 2 * max(r["size"] for r in found)


def test_op10(spark, small, rows):
    found = {r[0]: tuple(r[1:]) for r in queries.op10_suffix_levels(spark, small).collect()}
    docs = rows("documents", "doc_id", "text")
    assert found == dict(zip((i for i, _ in docs), brute.repeated_passages([t for _, t in docs], 200)))


def test_pipeline(spark, small, tokenizer):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "42 !", None, "src1", 4)], docs.schema)
    docs = store(docs.union(odd), "pipeline-test")
    given = {r.doc_id: r for r in docs.collect()}
    for (name, stage), columns in zip(corpus_pipeline.STAGES[:-1], [docs.columns] * 4):
        after = store(stage(spark, docs, small), "pipeline-test")
        assert after.columns == columns, name
        kept = after.collect()
        if name == "language_id":
            assert {r.doc_id for r in kept} == set(given) - {9001, 9002}
        elif name == "minhash_near_dedup":
            groups = brute.near_duplicates([(i, r.text) for i, r in given.items()], minhash.SHINGLE, 80)
            assert {r.doc_id for r in kept} == {i for i, (_, _, first) in groups.items() if first}
        elif name == "suffix_array_dedup":
            expected = dict(zip(given, brute.repeated_passages([r.text for r in given.values()], 200)))
            assert {r.doc_id for r in kept} == {i for i, (n, gone, _, _) in expected.items() if gone < n}
            for r in kept:
                assert len(r.text) == r.n_chars
                size, gone = expected[r.doc_id][:2]
                assert 0 <= len(r.text.encode()) - (size - gone) <= 6 * expected[r.doc_id][2]
        else:
            sizes = Counter()
            for r in given.values():
                sizes[r.source] += len(brute.WORDS.findall(r.text))
            copies = Counter(r.doc_id for r in kept)
            assert max(copies.values()) <= 3 and set(copies) <= set(given)
            words = sum(len(brute.WORDS.findall(r.text)) for r in kept)
            assert words == pytest.approx(sum(sizes.values()), rel=0.05)
            assert all(r == given[r.doc_id] for r in kept)
        docs, given = after, {r.doc_id: r for r in kept}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    check_packing(final, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 2048)


def test_pipeline_keeps_one_row_of_each_text(spark, small):
    """Repeated rows and copies with null ids leave one row, whose text the next stage keeps; other texts of an id stay."""
    text = {k: " ".join(f"{k}{i}" for i in range(80)) for k in "abcd"}
    rows = [(1, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "d"), (None, "c")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = store(spark.createDataFrame([(i, text[k], "en", "s", len(text[k])) for i, k in rows], schema), "pipeline-test")
    stages = dict(corpus_pipeline.STAGES)
    kept = store(stages["minhash_near_dedup"](spark, docs, small), "pipeline-test")
    expected = Counter([(1, text["a"]), (None, text["b"]), (2, text["c"]), (2, text["d"])])
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == expected
    left = stages["suffix_array_dedup"](spark, kept, small).collect()
    assert Counter((r.doc_id, r.text) for r in left) == expected


def test_pipeline_mixes_row_by_row(spark, small):
    """Null ids, and an id with several texts and sources, do not share the lowest number of copies."""
    rng = np.random.default_rng(2)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "w " * int(rng.integers(5, 60)), "abc"[i // 100]) for i in range(300)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = store(spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], schema), "pipeline-test")
    mixed = dict(corpus_pipeline.STAGES)["source_mixing"](spark, docs, small)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    total = sum(len(t.split()) for _, t, _ in rows)
    assert sum(words.values()) == pytest.approx(total, rel=0.01)
    assert words["a"] > words["b"] > words["c"] > 0


def test_language_threshold_spares_short_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    predicted = language.identify(docs, language.learn(docs)).where("lang_pred <> 'und'")
    assert predicted.where(predicted["score"] < corpus_pipeline.LEAST_SCORE).isEmpty()


def test_pipeline_keeps_documents_that_nothing_was_learned_about(spark, small):
    """Without labels no document is rejected; columns of any name pass through."""
    rows = [(i, f"words of document {i}", None, "s", 10, i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a-b c` int")
    kept = corpus_pipeline.known_language(spark, docs, small)
    assert kept.columns == docs.columns and kept.count() == 20
    labelled = docs.union(spark.createDataFrame([(30 + i, "der die das und ist nicht ein haus", "de", "s", 9, 0) for i in range(8)], docs.schema))
    kept = corpus_pipeline.known_language(spark, labelled.union(spark.createDataFrame([(50, "12 34", None, "s", 5, 1)], docs.schema)), small)
    assert kept.columns == docs.columns and kept.where("doc_id = 50").isEmpty() and kept.where("doc_id >= 30").count() == 8
