"""The operators on whole texts against brute force, with nulls, empty and long texts, ties and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, jaccard, licenses, packing, quality, sharding, substrings, toxicity
from pulsegrid.llm.queries import tokenizer_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, k1 long, token string, slot int, stratum string, weights int"
random.seed(11)
LEXICON = ["".join(random.choices("abcdefgh", k=random.randint(2, 6))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(random.choice(LEXICON) for _ in range(n))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    base, passage = prose(300), prose(70)
    near = base.split()
    near[5:8] = ["x", "y", "z"]
    far = base.split()
    for i in range(0, 300, 20):
        far[i] = "q"
    rows = [
        (0, base), (1, " ".join(near)), (2, " ".join(far)), (3, base), (4, base.upper()), (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "ONE two"),
        (10, prose(40) + " " + passage + " " + prose(30)), (11, passage), (12, "Ünï " + passage + "\n" + prose(5)), (13, prose(9000)), (14, "a" * 40000),
        (15, "same same same same " * 60), (15, "same same same same " * 60), (None, base), (None, None), (16, prose(200)), (16, prose(80)),
        (17, "word <|endoftext|> <|startoftext|> end x"), (18, passage.replace(" ", "\n")), (19, " ".join([passage] * 3)),
    ]
    return rows + [(100 + i, prose(120)) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    clash = ("r", 1, 2, "t", 3, "s", 4)
    rows = [(i, t, random.choice(["en", "de", None]), "src", None if t is None else len(t), *clash) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None) -> frozenset:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    w = WORDS.findall((text or "").translate(lower))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("hot", [jaccard.HOT, 1])
def test_jaccard_components(docs, texts, none, monkeypatch, hot) -> None:
    monkeypatch.setattr(jaccard, "HOT", hot)
    points = [(i, shingles(t)) for i, t in texts]
    root = {i: i for i, _ in points if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in points:
        for j, b in points:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    want = sorted(((i, len(s), None if i is None else find(i)) for i, s in points), key=str)
    assert sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=str) == want
    assert jaccard.jaccard_components(none).count() == 0
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, *(i for i in root if find(i) == i)}


def test_jaccard_tree_keeps_every_pair_above_the_bound() -> None:
    import numpy as np
    points = np.random.default_rng(1).integers(0, 4, (300, jaccard.GROUPS)).astype(np.int32)
    points[1::3] = points[::3][:len(points[1::3])]
    points[1::3, :9] += 1
    sizes = points.sum(axis=1)
    tree = jaccard.Tree(points, sizes)
    for q in range(0, 300, 7):
        bound = 180 * np.minimum(points, points[q]).sum(axis=1) >= 80 * (sizes + sizes[q])
        assert set(np.flatnonzero(bound)) == set(tree.search(points[q], sizes[q]))


def without(texts) -> list[tuple]:
    first: dict = {}
    words = [WORDS.findall(t or "") for _, t in texts]
    for (i, _), w in zip(texts, words, strict=True):
        if i is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k:k + 50])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(texts, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = [True] * 50
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_substring_dedup(docs, texts, none) -> None:
    got = substrings.without_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(without(texts), key=str)
    short = substrings.shortened(docs)
    assert short.columns == docs.columns
    assert {(r.text, r.n_chars) for r in short.filter("doc_id = 11").collect()} == {("", 0)}
    assert short.filter("doc_id = 5").first().text is None
    assert substrings.without_repeats(none).count() == 0


def test_hot_keys_join_like_others(spark) -> None:
    from pulsegrid.llm.shared import split_join
    rows = spark.range(6000).select((F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 90)).alias("key"), F.col("id").alias("row"))
    single = spark.range(0, 80, 3).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value")).unionByName(spark.createDataFrame([(7, 14)], "key long, value long"))
    want = sorted(map(tuple, rows.join(single, "key").select("key", "row", "value").collect()))
    for hot in ([7], [], [7, 9, 1000]):
        keys = spark.createDataFrame([(k,) for k in hot], "key long")
        for bits in (64, 1 << 22):
            got = split_join(rows, single, "key", keys, F.col("row"), 8, bits)
            assert sorted(map(tuple, got.select("key", "row", "value").collect())) == want


def test_substring_dedup_with_hot_windows(spark, monkeypatch) -> None:
    monkeypatch.setattr(substrings, "HOT", 2)
    common, other = prose(55), prose(60)
    rows = [(i, f"{prose(i % 7)} {common} {prose(3)} {common if i % 3 else other}") for i in range(40)]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.select("row.doc_id", "n_words", "n_removed", "kept_text").collect())) == sorted(without(rows))


def test_shortened_texts_keep_their_white_space_and_odd_columns(spark) -> None:
    passage = prose(70)
    rows = [(1, "a\n\nb  c"), (2, passage), (3, f" one\n\ntwo  {passage}\n\nthree\tfour\n"), (4, f"{passage}  end\n"), (5, f"x\n{passage} \n"), (6, None), (None, "n\nm")]
    odd = {"my col": 1, "a.b": "2", "x`y": 3.0, "row": 4, "spans": 5, "maybe": True}
    frame = spark.createDataFrame(rows, "doc_id int, text string").select("*", *[F.lit(v).alias(k) for k, v in odd.items()])
    got = substrings.shortened(frame)
    assert got.columns == frame.columns
    assert {(r.doc_id, r.text) for r in got.collect()} == {
        (1, "a\n\nb  c"), (2, passage), (3, " one\n\ntwo  three\tfour\n"), (4, "end\n"), (5, "x \n"), (6, None), (None, "n\nm")}
    assert {tuple(r)[2:] for r in got.collect()} == {tuple(odd.values())}
    assert {(r.row["my col"], r.row["x`y"]) for r in substrings.without_repeats(frame).collect()} == {(1, 3.0)}


def test_quality_counts_match_a_plain_count(docs, texts, spark) -> None:
    def plain(text):
        w = WORDS.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
        seen = defaultdict(list)
        for i in range(len(w) - 2):
            seen[tuple(w[i:i + 3])].append(i)
        hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)
    more = [(200, "a\na\nb # $\n\n \na"), (201, "x y z x y z x"), (202, "one two three")]
    frame = docs.select("doc_id", "lang", "text").unionByName(spark.createDataFrame([(i, "en", t) for i, t in more], "doc_id long, lang string, text string"))
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (999, 1), (1, None)], "doc_id long, quality int")
    got = quality.quality_rules(frame, labels).collect()
    want = [(i, *(p := plain(t)), p[0] < 50 or 100 * p[4] > 50 * p[0]) for i, t in [*texts, *more]]
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted(want, key=str)
    assert all(r.kept != r.base_failed for r in got)
    assert quality.quality_rules(frame.limit(0), labels).count() == 0


def settings_by_brute_force(rates, labels):
    """Certified settings per stratum: rates are (doc_id, stratum, base_failed, rate per rule) rows."""
    from math import comb
    tail = lambda n, k: sum(comb(n, i) * quality.RISK ** i * (1 - quality.RISK) ** (n - i) for i in range(k + 1))
    every = [dict(zip(list(quality.RULES)[:i + 1], [min(quality.CUTOFFS)] * i + [c], strict=True)) for i in range(len(quality.RULES)) for c in quality.CUTOFFS]
    good = {i for i, q in labels if q == 1} - {i for i, q in labels if q == 0}
    held = defaultdict(list)
    for doc_id, stratum, failed, own in rates:
        if doc_id in good and not failed:
            held[stratum].append(own)
    strata = len(held) + 1
    places = {s: s if len(own) >= quality.least_holdout(strata) else quality.POOL for s, own in held.items()}
    strata = len(set(places.values()))
    found = {}
    for place in set(places.values()):
        own = [r for s, rows in held.items() if places[s] == place for r in rows]
        found[place] = {}
        for setting in every:
            k = sum(any(r[rule] > c for rule, c in setting.items()) for r in own)
            if k >= quality.RISK * len(own) or tail(len(own), k) > quality.ERROR / strata:
                break
            found[place] = setting
    return {s: found[p] for s, p in places.items()}


def test_quality_settings_hold_the_risk_of_each_stratum(spark) -> None:
    pick = random.Random(6)
    rows = []
    for lang, count, odd in (("en", 1500, 300), ("de", 700, 90), ("xx", 250, 200), ("yy", 300, 200), (None, 260, 10**6)):
        for n in range(count):
            text = prose(100) + (" ###" * 8 if n % odd == 7 else "") + (" A" * 40 if n % 11 == 3 else "")
            if n % 90 == 5:
                text += " same three words" * pick.randrange(2, 9)
            rows.append((len(rows), lang, text))
    bad = [(5000 + i, pick.choice(["en", "xx", "zz"]), "##$$ " * 30 + prose(60)) for i in range(40)]
    frame = spark.createDataFrame(rows + bad, "doc_id long, lang string, text string").repartition(6)
    labels = [(i, int(i < 5000)) for i, _, _ in rows + bad] + [(5, 0), (None, 1), (6, None)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    # Not landed before: the counting must not be done twice, or this takes minutes.
    counts = quality.base_counts(frame)
    measured = [(r.doc_id, r.stratum, r.base_failed, {rule: r[f"rate_{rule}"] for rule in quality.RULES}) for r in counts.collect()]
    want = settings_by_brute_force(measured, labels)
    got = {r.stratum: {rule: r[f"cut_{rule}"] for rule in quality.RULES if r[f"cut_{rule}"] is not None} for r in quality.cutoffs(counts, labelled).collect()}
    assert got == want and len({str(w) for w in want.values()}) > 1
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(frame, labelled).collect()}
    stratum = {i: s for i, s, _, _ in measured}
    for i, s, failed, own in measured:
        assert verdict[i] == (not failed and not any(own[rule] > c for rule, c in want.get(s, {}).items()))
    assert not any(verdict[i] for i, lang, _ in bad if lang != "zz") and all(verdict[i] for i, lang, _ in bad if lang == "zz")
    assert len(stratum) == len(rows + bad)
    odd = frame.select("*", F.lit(1).alias("row"), F.lit(2).alias("my col"), F.lit(3).alias("q_key"))
    stay = quality.good_documents(odd.unionByName(odd.filter("doc_id in (3, 5001)")), labelled)
    assert stay.columns == odd.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted([i for i, ok in verdict.items() if ok] + [3])


def test_quality_needs_labels(spark, docs) -> None:
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.cutoffs(quality.base_counts(docs), none).count() == 0
    assert quality.least_holdout(1) == 299 and quality.least_holdout(5) == 459


def test_toxicity_on_held_out_rows(spark) -> None:
    bad = ["vexor", "vexing", "vexly", "grobnik"]
    rows = [(i, prose(60) + (" " + " ".join(random.choices(bad, k=3)) + " " + prose(20) if i % 5 == 0 else "")) for i in range(600)]
    frame = spark.createDataFrame([*rows, (None, None), (700, "")], "doc_id long, text string").withColumn("score", F.lit("x")).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(3, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    got = toxicity.scored(frame, labels).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.98 * len(held)
    clean = toxicity.clean_documents(frame, labels)
    assert clean.columns == frame.columns
    gone = {r.doc_id for r in got if r.predicted and r.doc_id is not None}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in got if r.doc_id not in gone)
    assert toxicity.scored(frame, labels.limit(0)).agg(F.max("score")).first()[0] == 0
    assert toxicity.scored(frame.limit(0), labels).count() == 0


def test_votes_match_a_plain_reading_of_the_text() -> None:
    import pyarrow as pa
    words = ["grob", "vex", "ünik", "mud", "zek"]
    lexicon = [int(toxicity.signed(toxicity._terms(*toxicity._runs(pa.scalar(w)))[:1])[0]) for w in words]
    letter = rb"[A-Za-z\x80-\xff]"

    def votes(text: str | None) -> int:
        data = (text or "").encode()
        own = {w.lower() for w in re.findall(letter + rb"+", data)}
        bits = sum(1 << i % toxicity.LEXICONS for i, w in enumerate(words) if w.encode() in own)
        shouted = [w for w in re.findall(letter + rb"+", data) if re.fullmatch(rb"[A-Z]{4,}", w)]
        found = (re.search(rb"([a-z])\1\1", data.lower()), len(shouted) >= 2, re.search(rb"[!?]{2,}", data),
                 re.search(letter + rb"[*@#$%]+" + letter, data))
        return bits | sum(bool(x) << toxicity.LEXICONS + j for j, x in enumerate(found))

    pick = random.Random(7)
    parts = [*words, "GROB", "SHOUT", "LOUD", "LOUDé", "sooo", "AaA", "AAB", "f**l", "a*", "*b", "1*b", "x@y", "!", "?!", "!!", "! !", "\n", "é", "aa", "", "漢字漢"]
    texts = [None, "", "!", "a", "aaa", "éé", "grob", "f*k", *["".join(pick.choice(parts) + pick.choice(["", " ", " ", "\n"]) for _ in range(pick.randint(1, 9))) for _ in range(1500)]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), pa.array(texts, pa.string())], names=["doc_id", "held_out", "text"])
    got = [v for b in toxicity._votes(lexicon)([batch]) for v in b.column("votes").to_pylist()]
    want = [votes(t) for t in texts]
    assert got == want
    assert all(0.02 < sum(v >> j & 1 for v in want) / len(want) < 0.9 for j in (*range(len(words)), *range(toxicity.LEXICONS, toxicity.VOTERS)))


def test_label_model_follows_plain_expectation_maximization(monkeypatch) -> None:
    """The posterior of each pattern against sums over single documents and the best of all spanning trees."""
    import itertools
    import math

    import numpy as np
    k, rounds = 4, 6
    monkeypatch.setattr(toxicity, "VOTERS", k)
    monkeypatch.setattr(toxicity, "ROUNDS", rounds)
    pick = random.Random(9)
    docs = []
    for i in range(500):
        y = pick.random() < 0.35
        v = [int(pick.random() < (0.75 if y else 0.1 + 0.08 * j)) for j in range(k)]
        v[2] = v[0] if pick.random() < 0.8 else v[2]
        docs.append((tuple(v), int(y) if i < 90 else None))

    def normal(a: float, b: float) -> tuple[float, float]:
        return a / (a + b), b / (a + b)

    n = [sum(label == y for _, label in docs) for y in (0, 1)]
    ones = [[(sum(v[j] for v, label in docs if label == y) + 0.5) / (n[y] + 1) for j in range(k)] for y in (0, 1)]
    prior = [(n[y] + 1) / (sum(n) + 2) for y in (0, 1)]
    belief = {v: normal(*(prior[y] * math.prod(p if b else 1 - p for p, b in zip(ones[y], v, strict=True)) for y in (0, 1))) for v, _ in docs}
    for _ in range(rounds):
        weight = [(v, (1 - label, label) if label is not None else belief[v]) for v, label in docs]
        mass = [sum(w[y] for _, w in weight) for y in (0, 1)]
        prior = [(mass[y] + 1) / (sum(mass) + 2) for y in (0, 1)]
        pair = {(y, i, j, a, b): (sum(w[y] for v, w in weight if v[i] == a and v[j] == b) + 0.25) / (mass[y] + 1)
                for y in (0, 1) for i in range(k) for j in range(k) for a in (0, 1) for b in (0, 1)}
        one = {(y, j, a): pair[y, j, j, a, 0] + pair[y, j, j, a, 1] for y in (0, 1) for j in range(k) for a in (0, 1)}

        def shared(i: int, j: int) -> float:
            return sum(prior[y] * pair[y, i, j, a, b] * math.log(pair[y, i, j, a, b] / one[y, i, a] / one[y, j, b])
                       for y in (0, 1) for a in (0, 1) for b in (0, 1))

        # Every way to hang voters 1, 2, ... below others: parents without a cycle, voter 0 as the root.
        def reaches_root(parents: tuple[int, ...], j: int) -> bool:
            for _ in range(k):
                j = parents[j - 1] if j else 0
            return j == 0

        best = max((p for p in itertools.product(range(k), repeat=k - 1) if all(reaches_root(p, j) for j in range(1, k))),
                   key=lambda p: sum(shared(q, j + 1) for j, q in enumerate(p)))
        for v in belief:
            chance = []
            for y in (0, 1):
                x = prior[y] * one[y, 0, v[0]]
                for j, q in enumerate(best, 1):
                    x *= pair[y, q, j, v[q], v[j]] / (pair[y, q, j, v[q], 0] + pair[y, q, j, v[q], 1])
                chance.append(x)
            belief[v] = normal(*chance)

    seen = sorted(belief)
    patterns = np.array([sum(b << j for j, b in enumerate(v)) for v in seen])
    clamped = np.array([[sum(d == (v, y) for d in docs) for v in seen] for y in (0, 1)], float)
    counts = np.array([sum(d == (v, None) for d in docs) for v in seen], float)
    assert np.allclose(toxicity.label_model(patterns, counts, clamped), [belief[v][1] for v in seen], atol=1e-9)


def test_label_model_weighs_correlated_voters_once() -> None:
    import numpy as np
    generator = np.random.default_rng(5)
    y = generator.random(20000) < 0.3
    votes = np.where(y[:, None], generator.random((20000, toxicity.VOTERS)) < 0.7, generator.random((20000, toxicity.VOTERS)) < 0.1)
    votes[:, 1] = votes[:, 0]
    packed = (votes << np.arange(toxicity.VOTERS)).sum(axis=1)
    patterns, back, counts = np.unique(packed, return_inverse=True, return_counts=True)
    clamped = np.stack([np.bincount(back[:500][~y[:500]], minlength=len(patterns)), np.bincount(back[:500][y[:500]], minlength=len(patterns))]).astype(float)
    share = toxicity.label_model(patterns, counts - clamped.sum(axis=0), clamped)
    assert ((share[back] > 0.5) == y).mean() > 0.99


def test_packing_places_every_token_once(docs, texts, none, spark) -> None:
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(i), *tokenizer.encode(t or "", add_special_tokens=False).ids, 2) for i, t in texts)
    parts = packing.packed_pieces(docs, path, 256)
    line = defaultdict(dict)
    for r in parts.collect():
        ids = struct.unpack(f"<{r.length}I", r.ids)
        assert 0 <= r.offset and r.offset + r.length <= 256
        line[r.sequence_id][r.offset] = (r.doc_id, r.start, r.doc_tokens, ids)
    got, open_doc = [], None
    for s in range(len(line)):
        at = 0
        for offset in sorted(line[s]):
            doc, start, total, ids = line[s][offset]
            assert offset == at
            at += len(ids)
            open_doc = (str(doc), *ids) if start == 0 else (*open_doc, *ids)
            if len(open_doc) - 1 == total:
                got.append(open_doc)
        assert at == 256 or s == len(line) - 1
    assert sorted(got) == want
    whole = packing.sequences(parts, 256).collect()
    assert {len(r.ids) for r in whole if r.sequence_id < len(line) - 1} == {256}
    assert all(len(r.ids) == 256 or r.n_tokens & (r.n_tokens - 1) == 0 for r in whole)
    assert packing.packed_pieces(none, path).count() == 0


def test_packing_encodes_marks_behind_letters_as_the_tokenizer_does() -> None:
    tokenizer, ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    words = [w + mark for c in letters for w in (c, "foo" + c, c + "foo", "fo" + c + "o") for mark in ",."]
    packing._learn(tokenizer, ids, [w.encode() for w in words])
    want = {w: tokenizer.encode(w, add_special_tokens=False).ids for w in words}
    assert not [w for w, x in want.items() if ids[w.encode()] != struct.pack(f"<{len(x)}I", *x)]


def test_packing_of_many_distinct_words_follows_the_tokenizer(spark) -> None:
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    pick = random.Random(3)
    words = ["".join(pick.choices(letters if n % 3 else "abcdeéÀßÿ\u00d7", k=pick.randrange(1, 9))) + pick.choice(["", ",", ".", ",.", "!", "\x00", "9"]) for n in range(4000)]
    texts = [(i, " ".join(words[40 * i:40 * i + 40])) for i in range(100)] + [(200, "<|endoftext|>"), (201, "A <|startoftext|>B, Ç."), (202, ",")]
    got = packing.packed_pieces(spark.createDataFrame(texts, "doc_id long, text string"), path, 1 << 20).collect()
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts}
    assert {r.doc_id: list(struct.unpack(f"<{r.length}I", r.ids)) for r in got} == want


def test_bpe_round_trip(docs, texts, none) -> None:
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want = sorted(((str(i), struct.pack(f"<{len(ids)}I", *ids), t or "") for i, t in texts for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids]))
    got = bpe.decoded(bpe.encoded(docs, path, piece=500), path).collect()
    assert sorted((str(r.doc_id), bytes(r.ids), r.text) for r in got) == want
    assert bpe.encoded(none, path).count() == 0


def test_bpe_joins_any_cut() -> None:
    code = bpe.coder(tokenizer_path("byte_bpe_50k.json"))
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "1", "!", "<|endoftext|>", "'s", "漢", "😀", "aaaa", "        ", "ing", "\t", " "]
    for _ in range(400):
        some = random.sample(parts, random.randint(1, 6))
        text = "".join(random.choice(some) for _ in range(random.randint(1, 300)))
        size = random.randint(1, 150)
        cuts = [text[i:i + size] for i in range(0, len(text), size)]
        assert bpe.tree(code, text, [(len(c), code.encode(c)) for c in cuts]) == code.slow.encode(text, add_special_tokens=False).ids


def test_sharding(docs, texts, none) -> None:
    got = sharding.shards_of(docs, 4).collect()
    by_text, slots, sizes = defaultdict(set), defaultdict(list), defaultdict(int)
    sizes_of = defaultdict(list)
    for i, t in texts:
        sizes_of[i].append((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    for r in got:
        assert (r.size, r.text_crc32) in sizes_of[r.doc_id]
        by_text[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert len(got) == len(texts) and all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shards_of(none).count() == 0


def test_shards_of_a_table_are_near_equal(spark) -> None:
    rows = [(i, f"{i} " + "x" * random.randrange(1, 400)) for i in range(1500)] + [(2000 + i, "y" * 90) for i in range(100)]
    got = sharding.shards_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 16)
    sizes = [r["sum(size)"] for r in got.groupBy("shard").sum("size").collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 16


def test_classes_are_packed_as_single_groups_are() -> None:
    pick = random.Random(8)
    for _ in range(60):
        sizes = [pick.randrange(1, 12) for _ in range(pick.randrange(1, 60))]
        capacity, left, where = pick.randrange(6, 40), [], []
        for size in sorted(sizes, reverse=True):
            fit = [(room, n) for n, room in enumerate(left) if room >= size]
            if fit:
                n = min(fit)[1]
            else:
                n = len(left)
                left.append(max(capacity, size))
            left[n] -= size
            where.append((size, n))
        found, opened = sharding.runs({s: sizes.count(s) for s in sizes}, capacity)
        assert opened == len(left)
        assert sorted((s, n) for s, a, b, n in found for _ in range(b - a)) == sorted(where)


def test_best_fit_decreasing() -> None:
    sizes = [(s, n) for n, s in enumerate([7, 5, 4, 3, 2, 2, 1])]
    where = sharding.packed(sizes, 8)
    assert len(set(where.values())) == 3
    assert where[0] == where[6] and where[1] == where[3] and where[2] == where[4] == where[5]
    assert sharding.capacity_for(sizes, 3) == 8


def test_license_scan(spark, none) -> None:
    header = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/b/c.txt", "nothing"), (2, "a/LICENSE", "Released under the MIT License."), (3, "a/b/d.txt", f"code\n{header}\nmore"),
        (4, "a/b/e/COPYING", "This work is licensed under the GNU General Public License, version 3."), (5, "a/b/e/f/g.txt", None), (6, "z/q.txt", ""),
        (7, None, "text"), (8, "z/w.txt", "a licence to nothing in particular is given by nobody at all here"), (1, "a/b/c.txt", "nothing"), (9, "z", "x"),
    ]
    frame = spark.createDataFrame(rows, "id long, path string, text string").withColumn("key", F.lit(1)).withColumn("licence", F.lit(2))
    got = {(r.id, r.licence, r.via) for r in licenses.scanned(frame).collect()}
    assert got == {(1, "MIT", "inherited"), (2, "MIT", "own"), (3, "Apache-2.0", "own"), (4, "GPL-3.0", "own"), (5, "GPL-3.0", "inherited"),
                   (6, None, None), (7, None, None), (8, None, None), (9, None, None)}
    assert licenses.scanned(licenses.document_files(none)).count() == 0


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2021, 2024 Some Long Company Name and its many contributors

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""


def test_license_scan_knows_full_texts_and_spdx(spark) -> None:
    body = MIT_TEXT.split("\n", 4)[4]
    gpl = licenses.full_texts()["GPL-3.0"]
    rows = [
        (1, "m/LICENSE", MIT_TEXT), (2, "m/src/a.c", "int x;"), (3, "g/COPYING", "Copyright 2020 A Person\n" + gpl), (4, "g/a/b.c", None),
        (5, "docs/terms.txt", body), (6, "docs/other.txt", "x"), (7, "s/a.c", "// SPDX-License-Identifier: GPL-2.0-or-later\nint y;"), (8, "s/b.c", "int z;"),
        (9, "t/LICENSE.md", "MIT License"), (10, "t/c.c", ""), (11, "c/LICENSE", "Attribution-NonCommercial 4.0 International\n\nterms follow"), (12, "c/d", "d"),
        (13, "n/LICENSE", "Terms of use of this product: it may be looked at, and nothing else, without our permission."), (14, "n/e", "e"),
        (15, "o/f.c", "SPDX-License-Identifier: LicenseRef-own"), (16, "p/g.txt", MIT_TEXT + prose(600)),
    ]
    frame = spark.createDataFrame(rows, "id long, path string, text string")
    got = {(r.id, r.licence, r.via) for r in licenses.scanned(frame).collect()}
    assert got == {(1, "MIT", "own"), (2, "MIT", "inherited"), (3, "GPL-3.0", "own"), (4, "GPL-3.0", "inherited"), (5, "MIT", "own"), (6, "MIT", "inherited"),
                   (7, "GPL-2.0", "own"), (8, None, None), (9, "MIT", "own"), (10, "MIT", "inherited"), (11, "CC-BY-NC-4.0", "own"), (12, "CC-BY-NC-4.0", "inherited"),
                   (13, None, None), (14, None, None), (15, None, None), (16, None, None)}


def test_int_ids_find_equal_long_ids(spark) -> None:
    from pulsegrid.llm.shared import near_members, without_keys
    rows = spark.createDataFrame([(i, "x") for i in range(200)] + [(None, "y")], "doc_id int, text string")
    gone = spark.range(0, 200, 2).select(F.col("id").alias("doc_id"))
    assert sorted(str(r.doc_id) for r in without_keys(rows, "doc_id", gone).collect()) == sorted(["None", *map(str, range(1, 200, 2))])
    assert {r.doc_id for r in near_members(rows, "doc_id", gone).collect()} >= set(range(0, 200, 2))
    passage = prose(70)
    texts = spark.createDataFrame([(1, passage), (2, "one two " + passage)], "doc_id int, text string")
    assert {r.doc_id: r.text for r in substrings.shortened(texts).collect()} == {1: passage, 2: "one two"}


def test_bitmap_join_is_there_when_no_key_is_wanted(spark):
    from pulsegrid.llm.shared import _maybe

    rows = spark.range(100).select(F.col("id").alias("key"))
    for wanted, hits in ((rows.filter("key < 0"), 0), (rows.filter("key < 10"), 10)):
        marked = _maybe(rows, "key", wanted, 1 << 22)
        found = marked.collect()
        assert len(found) == 100 and hits <= sum(r.maybe for r in found) < 30
        marked = marked.select("maybe")
        marked.collect()
        assert "Join" in marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
