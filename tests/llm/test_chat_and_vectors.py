"""Chat round trips, vector links against brute force, and the stages of the pipeline."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import chat, jaccard, near_vectors, packing, queries, quality, substrings, toxicity
from pulsegrid.llm.shared import components

PARTS = ["<|im_end|>", "<|im_start|>", "\n", "<\\|", "<|", "|>", "x", "<\\\\|", " ", "<", "<|lf|>", "\\"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXT), TEXT), max_size=4))
def test_round_trip(turns) -> None:
    whole, spans = chat.formatted(turns)
    assert chat.parse(whole) == turns
    assert [chat.unescape(whole[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_only_conflicts_are_escaped() -> None:
    whole, _ = chat.formatted([("user", "plain | text <b>"), ("assistant", "<|im_end|>")])
    assert whole == "<|im_start|>user\nplain | text <b><|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"
    assert chat.parse("<|im_start|>user\nopen") is None


def test_conversations(spark) -> None:
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", "c<|im_end|>"), (2, 0, None, ""), (None, 0, "user", "n"),
            (3, 0, "user", "same"), (3, 0, "user", "same"), (3, None, "system", "first"), (4, 0, "assistant", "é" * 50000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(0)).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.rendered_conversations(frame)).collect()}
    turns = {1: [("user", ""), ("assistant", "b"), ("assistant", "c<|im_end|>")], 2: [("", "")], None: [("user", "n")],
             3: [("system", "first"), ("user", "same"), ("user", "same")], 4: [("assistant", "é" * 50000)]}
    assert set(got) == set(turns)
    for conv, said in turns.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(said), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].formatted_chars == len(chat.formatted(said)[0])
    assert chat.read_back(chat.rendered_conversations(frame.limit(0))).count() == 0


def test_components(spark) -> None:
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.fixture(scope="module")
def vectors(spark):
    generator = np.random.default_rng(3)
    rows = []
    for i in range(60):
        base = generator.standard_normal(32)
        rows.append((10 * i, base.tolist(), i % 3))
        for k in range(i % 4):
            rows.append((10 * i + k + 1, (base + generator.standard_normal(32) * 0.12).tolist(), i % 3))
    crowd = generator.standard_normal(32)
    rows += [(2000 + i, (crowd + generator.standard_normal(32) * 0.08).tolist(), 1) for i in range(700)]
    rows += [(5000, rows[0][1], 0), (5001, rows[0][1], 2), (5002, rows[0][1], None), (5003, None, 1), (5004, [], 1), (5005, [0.0] * 32, 1), (5006, [0.0] * 32, 1),
             (5007, [float("nan")] * 32, 1), (5008, [None] + [1.0] * 31, 1), (5009, rows[0][1][:31], 0), (None, rows[0][1], 0), (0, rows[0][1], 0),
             (6001, crowd.tolist(), 0), (6001, crowd.tolist(), 1)]
    return rows


def test_vector_links(spark, vectors) -> None:
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1)).repartition(4)
    got = near_vectors.near_duplicates(frame).collect()
    assert len(got) == len(vectors)
    links, reach = {}, {}
    able = [(n, i, np.array(v, float), lab) for n, (i, v, lab) in enumerate(vectors) if v and None not in v and lab is not None and np.isfinite(v).all() and any(v)]
    for n, _, v, lab in able:
        near = [m for m, _, w, lab2 in able if m != n and lab == lab2 and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98]
        links[n], reach[n] = len(near), near
    want = sum(links.values())
    found = sum(r.n_links for r in got)
    assert 0.98 * want <= found <= want
    ones = {r.vec_id: r for r in got}
    for i in (5001, 5002, 5003, 5004, 5005, 5006, 5007, 5008, 5009):
        assert (ones[i].n_links, ones[i].component_id, ones[i].kept) == (0, i, True)
    assert ones[5000].component_id == 0 and not ones[5000].kept and ones[None].component_id is None
    assert {ones[2000 + i].component_id for i in range(700)} == {2000}
    # One vec_id under two labels: each row has the links of its own label.
    twice = sorted(r.n_links for r in got if r.vec_id == 6001)
    near = sum(len(reach[n]) for n, i, _, lab in able if i == 6001 and lab == 1)
    assert twice[0] == 0 and 0.98 * near <= twice[1] <= near
    assert near_vectors.near_duplicates(frame.limit(0)).count() == 0


def test_collisions_count_windows_of_every_group() -> None:
    pick = np.random.default_rng(8)
    group = np.sort(pick.integers(0, 6, 90))
    sketch = pick.integers(-4000, 4001, (90, 7)).astype(np.int64)
    sketch[:5], sketch[-5:] = 32767, -32767
    left, right = pick.random(90) < 0.6, pick.random(90) < 0.6
    reach = int(np.ceil(near_vectors.WINDOW * near_vectors.SIGMA * near_vectors.STEPS)) + 1
    for least in (1, 3, 7):
        x, y = near_vectors.collisions(sketch, group, left, right, least)
        want = {(a, b) for a in np.flatnonzero(left) for b in np.flatnonzero(right)
                if group[a] == group[b] and (abs(sketch[a] - sketch[b]) <= reach).sum() >= least}
        assert len(x) == len(want) and set(zip(x.tolist(), y.tolist(), strict=True)) == want


def test_roots_are_the_smallest_connected_nodes() -> None:
    pick = np.random.default_rng(9)
    for n, m in ((1, 0), (50, 20), (300, 260), (400, 399)):
        x, y = pick.integers(0, n, (2, m)) if m != 399 else (np.arange(399), np.arange(1, 400))
        got = near_vectors._roots(x, y, n)
        root = list(range(n))
        for _ in range(n):
            for a, b in zip(x, y, strict=True):
                root[a] = root[b] = min(root[a], root[b])
        assert got.tolist() == root


def test_table_layout_grows_slowly() -> None:
    assert near_vectors.layout(2)[0] == 1
    g, tables = near_vectors.layout(10**9)
    assert g < 20 and tables < 100


def test_pipeline_stages_follow_their_operators(spark, small) -> None:
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "near duplicates", "substring dedup", "packing"]
    a = corpus_pipeline.kept(corpus_pipeline.quality_rules(spark, docs, small), "a")
    assert ids(a) == ids(quality.quality_rules(docs, labels).filter("kept"))
    b = corpus_pipeline.kept(corpus_pipeline.toxicity_filter(spark, a, small), "b")
    assert ids(b) == ids(toxicity.scored(a, labels).filter("predicted = 0"))
    c = corpus_pipeline.kept(corpus_pipeline.near_duplicates(spark, b, small), "c")
    assert ids(c) == ids(jaccard.jaccard_components(b).filter("doc_id = component_id"))
    d = corpus_pipeline.kept(corpus_pipeline.substring_dedup(spark, c, small), "d")
    want = {r.doc_id: r.kept_text for r in substrings.without_repeats(c).select("row.doc_id", "kept_text").collect()}
    # What stays keeps its white space, so the words are compared; a text that loses nothing stays as it is.
    assert {r.doc_id: r.text.split() for r in d.collect()} == {i: text.split() for i, text in want.items()}
    source = {r.doc_id: r.text for r in c.collect()}
    assert all(r.text == source[r.doc_id] for r in d.collect() if len(r.text.split()) == len(source[r.doc_id].split()))
    assert {tuple(x.columns) for x in (a, b, c, d)} == {tuple(docs.columns)}
    row = lambda r: tuple(r)
    last = corpus_pipeline.pack(spark, d, small).collect()
    assert sorted(map(row, last)) == sorted(map(row, packing.digests(packing.packed_pieces(d, queries.tokenizer_path("word_bpe_49k.json"))).collect()))
    assert sorted(map(row, corpus_pipeline.run(spark, small).drop("sequence_id", "offset", "start", "length", "ids_crc32").distinct().collect())) == sorted(
        {(r.doc_id, r.doc_tokens) for r in last})
