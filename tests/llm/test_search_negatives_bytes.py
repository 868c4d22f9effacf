"""Ranked search, hard negatives and byte-level BPE against brute force and the tokenizer library."""

from __future__ import annotations

import base64
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import blocks, byte_bpe, hard_negatives, lexical

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CLASHING = {"rank": 1, "score": 2, "block": 3, "text x": 4, "a.b": 5, "term": 6}


def with_clashes(frame):
    return frame.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items()])


# --- ranked search

def searched(docs, items, k=10):
    find = lambda text: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    terms = [(i, find(t)) for i, t in docs]
    counts = [Counter(w) for _, w in terms]
    frequency = Counter(term for c in counts for term in c)
    total, length = sum(1 for _, w in terms if w), sum(len(w) for _, w in terms)
    out = []
    for item, text in items:
        asked, scores = find(text), []
        for (doc, words), count in zip(terms, counts, strict=True):
            score = 0
            for term in asked:
                tf, df = count[term], frequency[term]
                if tf:
                    m = 100 - 75 + (75 * len(words) * total) // length
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, math.inf if doc is None else doc))
        out += [(item, n + 1, None if d == math.inf else d, -s) for n, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def library():
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "été", "ÉTÉ", "x\x7fy", "a_b", "9", "\U0001f600z"]
    docs = [(i, " ".join(pick.choices(vocabulary, weights=[1 / (n + 1) for n in range(len(vocabulary))], k=pick.randrange(1, 60)))) for i in range(250)]
    docs += [(300 + i, docs[3][1]) for i in range(30)] + [(7, "w7 w7"), (7, "w7 w7"), (None, "w39 w39 w38"), (None, docs[3][1]), (400, None), (401, ""), (402, " -- ")]
    docs += [(403, "w1 " * 30000)]
    items = [(i, " ".join(pick.choices(vocabulary, k=9))) for i in range(12)] + [(50, "W7 w7"), (50, "W7 w7"), (51, None), (52, ""), (53, "absent"), (54, docs[3][1]), (None, "w5")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, 700])
def test_search_is_exact_in_any_number_of_blocks(spark, library, limit) -> None:
    docs, items = library
    frame = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    asked = with_clashes(spark.createDataFrame(items, "item_id int, text string"))
    got = [tuple(r) for r in lexical.ranked(frame, asked, limit=limit).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == searched(docs, items)


def test_search_of_empty_tables(spark, library) -> None:
    docs = spark.createDataFrame(library[0], "doc_id long, text string")
    items = spark.createDataFrame(library[1], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs.limit(0), items.limit(0)).count() == 0


def test_heaps_keep_the_smaller_ids_of_equal_scores() -> None:
    heaps = lexical.Heaps(1, 3)
    for ids in ([9, 8, None], [1, 7, 2], [3, None, 0]):
        heaps.offer(np.full((3, 1), 5), ids)
    assert sorted(heaps.heaps[0], reverse=True) == [(5, 0), (5, -1), (5, -2)]


# --- hard negatives

def brute_negatives(rows):
    able = []
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        able.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = set()
    for i, label, v in able:
        if i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), j, other) for j, other, w in able if j != i and len(w) == len(v))
        for ps, positive in [(-s, j) for s, j, other in scored if other == label][:5]:
            window = [(-s, j) for s, j, other in scored if other != label and 80 * ps <= -100 * s <= 100 * ps][:5]
            out |= {(i, positive, n + 1, j, ps, s) for n, (s, j) in enumerate(window)}
    return out


@pytest.fixture(scope="module")
def mixed_vectors():
    pick = np.random.default_rng(2)
    centres = pick.standard_normal((4, 70))
    rows = [(i, (centres[i % 4] + 0.6 * pick.standard_normal(70)).astype(np.float32).tolist(), int(pick.integers(0, 3))) for i in range(0, 900)]
    rows += [(1000 + i, rows[100][1], i % 3) for i in range(20)]  # ties
    rows += [(2000, [0.0] * 70, 1), (2001, None, 1), (2100, [], 1), (2101, [], 1), (2102, [], 2), (2200, [1.0, 2.0], 0), (2201, [1.0, 2.0], 0), (2203, [0.9, 2.0], 2),
             (2300, [float("nan")] * 70, 1), (2301, [float("inf")] + [1.0] * 69, 1), (2302, [None] + [1.0] * 69, 1), (2400, rows[100][1], None), (None, rows[100][1], 1),
             (-100, rows[200][1], 1), (-7, rows[200][1], 9)]
    return rows


@pytest.mark.parametrize("limit", [1 << 22, 3000])
def test_negatives_match_brute_force(spark, mixed_vectors, limit) -> None:
    frame = with_clashes(spark.createDataFrame(mixed_vectors, "vec_id long, embedding array<float>, label int").repartition(6))
    got = [tuple(r) for r in hard_negatives.mined(frame, limit).collect()]
    want = brute_negatives(mixed_vectors)
    assert len(got) == len(want) > 50 and set(got) == want


def test_negatives_of_an_empty_table_and_of_huge_components(spark, mixed_vectors) -> None:
    frame = spark.createDataFrame(mixed_vectors, "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mined(frame.limit(0)).count() == 0
    assert hard_negatives.mined(frame.filter("vec_id = 2001")).count() == 0
    big = spark.createDataFrame([(100, [1e9], 0), (101, [1.0], 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="exact"):
        hard_negatives.mined(big)


@pytest.mark.parametrize("largest", [3, 1000, 1 << 24])
def test_scores_are_exact(largest) -> None:
    pick = np.random.default_rng(largest)
    x, y = pick.integers(-largest, largest + 1, (40, 90)), pick.integers(-largest, largest + 1, (30, 90))
    x[0], y[0], y[1] = largest, largest, -largest
    primes = hard_negatives.moduli(90 * largest * largest)
    got = hard_negatives.exact_scores(x, [hard_negatives.residues(y, p) for p in primes], primes)
    assert got.tolist() == [[sum(a * b for a, b in zip(u, v, strict=True)) for v in y.tolist()] for u in x.tolist()]


def test_best_keeps_smaller_ids_of_equal_scores() -> None:
    best = blocks.Best(2, 2)
    for i in (5, 3, 9, 1):
        best.add(np.array([0, 1]), np.array([7, i]), np.array([i, i]))
        best.settle()
    assert list(zip(best.group.tolist(), best.score.tolist(), best.id.tolist(), strict=True)) == [(0, 7, 1), (0, 7, 3), (1, 9, 9), (1, 5, 5)]
    assert best.bar.tolist() == [7, 5]


# --- byte-level BPE

@pytest.fixture(scope="module")
def coders():
    with open(RANKS, "rb") as handle:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, handle)}
    return byte_bpe.Coder(RANKS, public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(coders, text) -> bool:
    code, library = coders
    ids = code.encode(text)
    return np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and code.decode(np.frombuffer(ids, "<u4")) == text.encode()


@settings(max_examples=600, deadline=None)
@given(text=st.one_of(st.text(), st.text(alphabet="ab aA'strelm\n\t  1é漢ぁ՘　", max_size=80), st.text(alphabet="ab", max_size=200)))
def test_bytes_encode_as_the_library_does(coders, text) -> None:
    assert same(coders, text)


def test_bytes_of_long_runs_and_newer_letters(coders) -> None:
    newer = "".join(byte_bpe.newer_characters()[:50])
    for text in ("a" * 70000, "ab" * 40000, "漢字" * 20000, " " * 50000, "\xa0" * 30000, f"a{newer}b {newer} 1{newer}", "word " * 300000, "<|endoftext|>", "I'll we've'S 'tis ''s"):
        assert same(coders, text)


def test_pairs_agree_with_merging(coders) -> None:
    code, pick = coders[0], random.Random(4)
    assert code.ordered
    for _ in range(4000):
        a, b = pick.randrange(50000), pick.randrange(50000)
        assert code._stays_cut(a, b) == (code.merged(code.token[a] + code.token[b]) == [code.token[a], code.token[b]])


def test_vocabulary_whose_merges_are_out_of_order(tmp_path) -> None:
    # "abc" ranks before the pair it is made from, and "xyz" is never reached by merging.
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab", b"xyz", b"bc", b"cab"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    code, pick = byte_bpe.Coder(str(path), public_tokenizers.PATTERN), random.Random(1)
    assert not code.ordered
    for _ in range(2000):
        assert same((code, library), "".join(pick.choices("abcxyz ", k=pick.randrange(12))))
    assert same((code, library), "xyz xyz")


def test_bytes_of_a_table(spark, coders) -> None:
    texts = [(1, "Hello wörld\n\n x"), (1, "Hello wörld\n\n x"), (None, "n"), (2, None), (3, ""), (4, "é " * 50000), (5, "<|endoftext|>")]
    frame = with_clashes(spark.createDataFrame(texts, "doc_id int, text string").withColumn("ids", F.lit("clash")).repartition(3))
    got = byte_bpe.decoded(byte_bpe.encoded(frame, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted(((i, len(coders[1].encode_ordinary(t or "")), (t or "").encode()) for i, t in texts), key=str)
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.data)) for r in got), key=str) == want
    assert byte_bpe.encoded(frame.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
