"""Every operator on odd rows and on an empty table, against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from tablewharf.llm import html_text, language, minhash, mixing, near_vectors, packing, pretokens, sharding
from tablewharf.llm import suffix_index, token_count, vector_search
from tablewharf.llm.common import components, with_prefix
from tablewharf.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def as_rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_token_counts(odd, odd_rows, none, tokenizer):
    def plain(text):
        return len(tokenizer.encode(text or "", add_special_tokens=False).ids)

    expected = Counter((r[0], len((r[1] or "").encode()), plain(r[1]), plain(r[1]) > 1024) for r in odd_rows)
    assert as_rows(token_count.count_tokens(odd, tokenizer_path())) == expected
    assert token_count.count_tokens(none, tokenizer_path()).isEmpty()


def test_pre_tokens_on_random_text(tokenizer, monkeypatch):
    random.seed(5)
    signs = [*"ab1 \n\t  '''sdtmrevl.!é9\xa0　中́"] + ["'s", "'re", "'ll", "<|endoftext|>", "Ᲊ", "\U0001f600"]
    texts = ["".join(random.choices(signs, k=random.randint(0, 60))) for _ in range(3000)]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for window, remembered in ((1 << 20, 1_500_000), (40, 1_500_000), (1 << 20, 50)):
        monkeypatch.setattr(pretokens, "WINDOW", window)
        monkeypatch.setattr(pretokens, "REMEMBERED", remembered)
        encoder, found = pretokens.PreTokens(tokenizer_path()), defaultdict(list)
        for index, count, ids in encoder.encode(texts, want_ids=True):
            assert count == len(ids)
            found[index] += ids.tolist()
        assert [found[i] for i in range(len(texts))] == expected


def test_language(spark, odd, none):
    known = [(f"der die das und ist nicht ein haus {i}", "de") for i in range(40)]
    known += [(f"the a and is not of house with {i}", "en") for i in range(40)]
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(known)], "doc_id long, text string, lang string")
    prototypes = language.learn(docs)
    assert [lang for lang, _ in prototypes] == ["de", "en"]
    found = {r.doc_id: r for r in language.identify(docs, prototypes).collect()}
    assert all(found[i].lang_pred == lang for i, (_, lang) in enumerate(known))
    odd_found = language.language_of_documents(odd).collect()
    assert len(odd_found) == odd.count()
    assert all((r.lang_pred == "und" and r.score == 0) or r.lang_pred == "xx" for r in odd_found)
    assert {r.doc_id for r in odd_found if r.lang_pred == "und"} >= {0, 1, 2}
    assert language.language_of_documents(none).isEmpty()


def test_language_windows_do_not_matter(monkeypatch):
    text = "Ein langer Text, der über Fenster läuft; " * 20
    whole = language.Grams(256).document(text)
    assert language.Grams(256).document("1234 ...") is None
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    codes, counts = language.gram_codes(points)
    grams = language.Grams(256)
    assert np.array_equal(whole, counts @ grams.build(codes))


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(odd, odd_rows, none, shingle):
    found = minhash.near_duplicates(odd, shingle=shingle).collect()
    expected = brute.near_duplicates([(r[0], r[1]) for r in odd_rows if r[0] is not None], shingle, 80)
    assert len(found) == len(odd_rows)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id, row.kept) == expected[row.doc_id]
    assert minhash.near_duplicates(none).isEmpty()


def test_chain_of_near_duplicates(spark):
    """Neighbours link, ends do not: one component, whatever centre a bucket has."""
    base = [f"w{i}" for i in range(100)]
    docs = [(k, " ".join(base[: 100 - 6 * k] + [f"x{k}{j}" for j in range(6 * k)][: 6 * k])) for k in range(4)]
    chain = [(k, " ".join(f"w{i}" for i in range(8 * k, 8 * k + 100))) for k in range(12)]
    for rows in (docs, chain):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r[0]: (r[1], r[2], r[3]) for r in minhash.near_duplicates(frame, shingle=1).collect()}
        assert found == brute.near_duplicates(rows, 1, 80)


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 7, 120, 4000):
        pool = rng.integers(0, 1 << 62, 2 * n, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 10 : n + n // 10])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        one, two, again = minhash.signatures([a, b, a], 240)
        assert np.array_equal(one, again) and abs((one == two).mean() - true) < 0.15


def test_packing(odd, odd_rows, none, tokenizer):
    length = 64
    found = packing.pack(odd, tokenizer_path(), length=length).collect()
    check_packing(found, [(r[0], r[1]) for r in odd_rows], tokenizer, length)
    assert packing.pack(none, tokenizer_path()).isEmpty()


def check_packing(found, docs, tokenizer, length):
    pieces = Counter()
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), length):
            part = ids[at : at + length]
            pieces[doc_id, at, len(part), brute.crc(part), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == pieces
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sequences


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(1, 128, 5000).tolist())
    plan = packing.plan_patterns(counts, 128)
    used = Counter()
    for pattern, times in plan:
        assert sum(size * n for size, n in pattern) <= 128
        for size, n in pattern:
            used[size] += n * times
    assert used == counts
    assert sum(t for _, t in plan) <= 1.03 * sum(s * n for s, n in counts.items()) / 128
    assert packing.plan_patterns({}, 128) == []


def test_mixing(odd, odd_rows, none):
    found = mixing.mix(odd).collect()
    assert len(found) == len(odd_rows)
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(brute.WORDS.findall(r[1] or ""))
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets, open_sources, rest = {}, set(order), float(total)
    while True:
        share = {s: rest * weights[s] / sum(weights[o] for o in open_sources) for s in open_sources}
        above = [s for s in open_sources if share[s] > 3 * sizes[s]]
        if not above:
            targets |= share
            break
        for s in above:
            targets[s] = 3.0 * sizes[s]
            rest -= targets[s]
            open_sources.discard(s)
        if not open_sources:
            break
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
    assert as_rows(mixing.mix(odd)) == Counter(tuple(r) for r in found)
    assert mixing.mix(none).isEmpty()


def test_mixing_comes_near_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * int(rng.lognormvariate(4, 1)), rng.choice("aaaabc")) for i in range(600)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)


def test_mixing_mends_a_long_document(spark):
    """What rounding leaves of one long document is made up by many copies of short ones, evenly."""
    docs = [(0, 100_000, "a"), *[(i, 300 + i % 7, "a") for i in range(1, 101)], (200, 31_000, "b"), (201, 31_000, "b")]
    docs += [(300, 5000, "c"), *[(300 + i, 40, "c") for i in range(1, 20)], (400, 90_000, "d")]
    frame = spark.createDataFrame([(i, "w " * n, s) for i, n, s in docs], "doc_id long, text string, source string")
    found = mixing.mix(frame).collect()
    taken, target = Counter(), {}
    for r in found:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.taken
        target[r.source] = r.target
    least = {"a": 300, "b": 31_000, "c": 40, "d": 90_000}
    assert all(abs(taken[s] - target[s]) <= least[s] / 2 for s in target)


def test_shards(odd, odd_rows, none):
    found = sharding.byte_shards(odd, shards=3).collect()
    sizes = Counter((r[0], len((r[1] or "").encode()) + 1) for r in odd_rows)
    assert Counter((r.doc_id, r["size"]) for r in found) == sizes
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.byte_shards(none).isEmpty()


def test_shards_are_even(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(2000)]
    found = sharding.byte_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    total = Counter()
    for r in found:
        total[r.shard] += r["size"]
    assert set(total) == set(range(8)) and max(total.values()) - min(total.values()) <= 2 * 301


def test_repeated_passages(odd, odd_rows, none, monkeypatch):
    for crowd in (2000, 1):
        monkeypatch.setattr(suffix_index, "CROWD", crowd)
        found = suffix_index.repeated_passages(odd, length=60, gram=16).collect()
        expected = brute.repeated_passages([r[1] for r in odd_rows], 60)
        texts = Counter((r[0], *e) for r, e in zip(odd_rows, expected))
        import hashlib

        ours = Counter(
            (r.row.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found
        )
        assert ours == texts
    assert suffix_index.repeated_passages(none).isEmpty()


def test_passages_at_every_cut(spark):
    rng = random.Random(4)
    shared = "".join(rng.choices("abc ", k=300))
    rows = []
    for i in range(40):
        noise = "".join(rng.choices("defg ", k=rng.randint(0, 80)))
        low = rng.randint(0, 150)
        rows.append((i, noise + shared[low : low + rng.randint(40, 150)] + noise[::-1] + "ü"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.row.doc_id: (r.n_bytes, r.n_removed, len(r.spans)) for r in suffix_index.repeated_passages(frame, 50, 12).collect()}
    assert found == {i: e[:3] for i, e in enumerate(brute.repeated_passages([t for _, t in rows], 50))}
    whole = suffix_index.repeated_passages(frame, 50, 12, whole_characters=True)
    assert all(bytes(r.kept).decode() is not None for r in whole.collect())


VECTORS = "vec_id long, embedding array<float>, shard int, links int, label int"


def odd_vectors():
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 1, 1, 1) for i in range(300)]
    for i in range(300, 360):
        base = np.array(rows[i % 7][1])
        rows.append((i, (base + rng.normal(scale=0.05, size=8)).astype(np.float32).tolist(), None, None, None))
    rows += [(400, None, 1, 1, 1), (401, [], 1, 1, 1), (402, [0.0] * 8, 1, 1, 1), (403, [None] + [1.0] * 7, 1, 1, 1)]
    rows += [(404, [float("nan")] + [1.0] * 7, 1, 1, 1), (405, [1.0, 2.0], 1, 1, 1), (450, rows[0][1], 1, 1, 1), (500, rows[0][1], 1, 1, 1)]
    return rows


def test_top_k(spark, monkeypatch):
    rows = odd_vectors()
    for shard_rows in (16_384, 50):
        monkeypatch.setattr(vector_search, "SHARD_ROWS", shard_rows)
        frame = spark.createDataFrame(rows, VECTORS)
        found = sorted(tuple(r) for r in vector_search.top_k(frame, frame["vec_id"] % 50 == 0).collect())
        ok = {i: np.floor(np.array(v, float) * 256) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all()}
        expected = []
        for q in (i for i in ok if i % 50 == 0):
            scored = sorted((-int(v @ ok[q]), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
        assert found == sorted(expected)
    none = spark.createDataFrame([], VECTORS)
    assert vector_search.top_k(none, none["vec_id"] % 50 == 0).isEmpty()


def test_near_vectors(spark):
    rows = odd_vectors()
    frame = spark.createDataFrame([*rows, (None, None, None, None, None)], VECTORS)
    found = near_vectors.near_vectors(frame).collect()
    expected = brute.cosine_groups([(i, v) for i, v, *_ in rows], 0.95)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id is not None} == expected
    assert len(found) == len(rows) + 1
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).isEmpty()


@pytest.mark.parametrize("dense", [0, 1000])
@pytest.mark.parametrize("blind", [256, 1 << 30])
def test_audit_judges_each_query(dense, blind):
    """Narrow beams that see a dense group, but no isolated pair, do not pass."""
    rng = np.random.default_rng(8)
    points = near_vectors.units(rng.normal(size=(3000, 32)))
    points[:dense] = near_vectors.units(points[0] + rng.normal(scale=0.01, size=(dense, 32)))
    queries = near_vectors.units(rng.normal(size=(3000, 32)))
    queries[:dense] = points[:dense][::-1]
    pairs = np.arange(2001, 3000, 58)
    queries[pairs] = near_vectors.units(points[pairs - 500] + rng.normal(scale=0.01, size=(len(pairs), 32)))

    class Blind:
        def __init__(self):
            self.points = points.astype(np.float32)

        def within(self, asked, cosine, width):
            row, node = np.nonzero(asked @ self.points.T >= cosine)
            seen = (node < dense) | (width >= blind)
            return row[seen], node[seen]

    found = set(zip(*(x.tolist() for x in near_vectors._audited(Blind(), queries, points, 0.95))))
    assert {(i, i - 500) for i in pairs.tolist()} <= found


PAGES = "page_id long, url string, html string, text string, n_chars int"


def test_main_text(spark):
    pages = [
        (1, "u", "<nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>one  two\n three<br>four<p><b>five</p></article><footer>f</footer>"),
        (2, "u", None),
        (3, None, ""),
        (4, "u", "just text"),
        (5, "u", "<p>a"),
        (6, "u", "<div class='ad'>buy now today</div><main><p>real words here to read</p><div id=comments><p>nice one</p></div></main>"),
        (7, "u", "<script>var x = '</p>'</script><style>p{}</style><p>words after the script</p><!-- <p>no</p> -->"),
        (None, None, "<p>unclosed <b>bold <i>both</p><p>next &lt;tag&gt; &am"),
        (7, "u", "<p>" + "long " * 50_000),
    ]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], PAGES)
    found = html_text.extract(frame).collect()
    text = {(r.page_id, r.url, len(r.text) > 1000): r.text for r in found}
    assert text[1, "u", False] == "T & U\none two three four\nfive"
    assert text[2, "u", False] == text[3, None, False] == ""
    assert text[4, "u", False] == "just text" and text[5, "u", False] == "a"
    assert text[6, "u", False] == "real words here to read"
    assert text[7, "u", False] == "words after the script"
    assert text[None, None, False] == "unclosed bold both\nnext <tag> &am"
    assert text[7, "u", True] == ("long " * 50_000).strip()
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(spark.createDataFrame([], PAGES)).isEmpty()


def test_components_and_prefix(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000, i) for i in range(400, 600)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    expected = brute.groups({x for e in edges for x in e if e[0] != e[1]}, edges[:-1])
    assert found == expected
    frame = spark.createDataFrame([(i % 3, 5) for i in range(100)], "k int, m long")
    rows = sorted((r.row_index, r.k, r.before_m, r.total_m) for r in with_prefix(frame, ["k"], ["m"], "test").collect())
    assert rows == [(i, 0 if i < 34 else 1 if i < 67 else 2, 5 * i, 500) for i in range(100)]
