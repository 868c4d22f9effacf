"""Toxicity by weak supervision: voters, a generative label model over their votes, a linear classifier on its labels.

1. Terms. A bounded sample of labelled rows (``FIT_ROWS``, by digest of doc_id) tells which words and word beginnings go
   with toxic texts; the ``TERMS`` strongest are dealt to lexicons by rank.
2. Votes. ``LEXICONS`` lexicon voters and four pattern voters look at every whole text; a document's votes are 16 bits, so
   all documents together have at most 65,536 different patterns. The pattern voters read the text, not the lexicons: a
   letter three times in a row; two or more words of four capitals or more; two or more ``!`` or ``?`` in a row; letters
   joined by marks that stand for others, as in ``a**b``.
3. Label model. The patterns' counts over all documents fit P(y), P(vote | parent vote, y) along the tree of largest
   conditional mutual information, by expectation maximization: the accuracies of the voters and the correlations between
   them. Labelled rows of the sample start it and stay clamped.
4. Classifier. Logistic regression over the terms of the sample rows, fitted to the posterior labels; it scores all rows.

Labels teach only through rows whose crc32(doc_id as text) mod 4 is not 2; lang, source and doc_id are no inputs of a score.

Defined cases: null and empty texts have no terms and get the score of the intercept; rows without doc_id are scored and
not held out; labels that are null, repeated (the highest counts) or without a document do no harm; without labels of
both classes, or texts for them, there are no terms and the score is the share of toxic labels, or 0; repeated rows are scored alike; empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import kept, ship, without_keys
from pulsegrid.llm.words import BASE, mix, pieces, powers, signed

FIT_ROWS = 20_000
TERMS, LEXICONS, LEAST_TOXIC = 256, 12, 4
THRESHOLD = 0.3
#: Bytes of word beginnings; a beginning of two words of a text is a term of its own.
BEGINNINGS = (4, 6, 8)
VOTERS = LEXICONS + 4
ROUNDS = 15

_SALTS = {k: np.uint64((int(BASE) * (k + 1)) % (1 << 64)) for k in (0, *BEGINNINGS)}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A"):ord("Z") + 1] += np.uint64(32)
_CAPITAL, _PLAIN, _MASK = (np.isin(np.arange(256), list(kind)) for kind in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"*@#$%"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _runs(text: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text and the bounds of its runs of letters."""
    data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and len(text.as_buffer()) else np.zeros(0, np.uint8)
    letter = np.concatenate(([False], _LETTER[data], [False]))
    return data, np.flatnonzero(letter[1:] & ~letter[:-1]), np.flatnonzero(letter[:-1] & ~letter[1:])


def _terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs of letters, lower-cased, and of their beginnings."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:len(data)], out=sums[1:])
    found = [mix((sums[ends] - sums[starts]) * down[starts])]
    for k in BEGINNINGS:
        long = starts[ends - starts > k]
        own, times = np.unique(mix((sums[long + k] - sums[long]) * down[long] + _SALTS[k]), return_counts=True)
        found += [own, mix(own[times >= 2] + _SALTS[0])]
    return np.concatenate(found)


def _patterns(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bool, bool, bool, bool]:
    """Votes of the pattern voters: repeated letters, capitals, loud marks, masked letters."""
    # Bit 5 set makes ASCII letters small, and nothing else becomes one.
    low, loud = data | 0x20, (data == ord("!")) | (data == ord("?"))
    same = low[1:] == low[:-1]
    repeats = _PLAIN[low[np.flatnonzero(same[1:] & same[:-1])]]
    caps = np.flatnonzero(ends - starts >= 4)
    caps = caps[_CAPITAL[data[starts[caps]]] & _CAPITAL[data[ends[caps] - 1]]]
    masked = np.flatnonzero(_MASK[data[ends[:-1]]])
    return (bool(repeats.any()), len(caps) >= 2 and int(_all(_CAPITAL[data], starts[caps], ends[caps]).sum()) >= 2,
            bool((loud[1:] & loud[:-1]).any()),
            len(masked) > 0 and bool(_all(_MASK[data], ends[masked], starts[masked + 1]).any()))


def _all(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the ranges have every flag set."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[ends] - sums[starts] == ends - starts


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): numbers of sample texts with the term, for terms of this partition."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(np.unique(_terms(*_runs(text))).tolist())
    terms = np.array(list(counts[0].keys() | counts[1].keys()), np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(signed(terms)), pa.array([counts[1][t] for t in terms.tolist()], pa.int64()),
                                      pa.array([counts[0][t] for t in terms.tolist()], pa.int64())], names=["term", "toxic", "clean"])


def _votes(lexicon: list[int]) -> callable:
    """Rows (doc_id, held_out, votes, hits): hits are the ranks of the terms in the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = np.array(lexicon, np.int64).view(np.uint64)
        order = np.argsort(terms)
        ordered = terms[order]
        for piece in pieces(batches):
            votes, hits = [], []
            for text in piece.column("text"):
                runs = _runs(text)
                own = _terms(*runs)
                at = np.searchsorted(ordered, own)
                at[at == len(ordered)] = 0
                kinds = np.unique(order[at[ordered[at] == own]]) if len(ordered) else np.zeros(0, np.int64)
                bits = np.zeros(VOTERS, bool)
                bits[kinds % LEXICONS] = True
                bits[LEXICONS:] = _patterns(*runs)
                votes.append(int((1 << np.flatnonzero(bits)).sum()))
                hits.append(kinds.tolist())
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("held_out"), pa.array(votes, pa.int32()), pa.array(hits, pa.list_(pa.int32()))],
                names=["doc_id", "held_out", "votes", "hits"])
    return run


def label_model(patterns: np.ndarray, counts: np.ndarray, clamped: np.ndarray) -> np.ndarray:
    """P(toxic | votes) of each pattern.

    ``counts``: unlabelled documents per pattern; ``clamped``: labelled ones, a row per class. The voters hang in a tree:
    each has the parent that shares most information with it given the class, so agreement that comes from correlation
    counts once.
    """
    x = (patterns[:, None] >> np.arange(VOTERS)) & 1
    share = (clamped.sum(axis=1) + 1) / (clamped.sum() + 2)
    given = np.stack([(clamped[y][:, None] * x).sum(axis=0) + 0.5 for y in (0, 1)]) / (clamped.sum(axis=1)[:, None] + 1)
    logs = np.stack([np.log(share[y]) + np.where(x, np.log(given[y]), np.log1p(-given[y])).sum(axis=1) for y in (0, 1)])
    weights = _posterior(logs)
    for _ in range(ROUNDS):
        mass = clamped + counts * weights
        share = (mass.sum(axis=1) + 1) / (mass.sum() + 2)
        joint = np.zeros((2, VOTERS, VOTERS, 2, 2))
        for y in (0, 1):
            for a in (0, 1):
                for b in (0, 1):
                    joint[y, :, :, a, b] = ((x == a) * mass[y][:, None]).T @ (x == b)
        joint = (joint + 0.25) / (mass.sum(axis=1)[:, None, None, None, None] + 1)
        one = np.stack([[joint[y, j, j].sum(axis=1) for j in range(VOTERS)] for y in (0, 1)])
        info = sum(share[y] * (joint[y] * np.log(joint[y] / (one[y][:, None, :, None] * one[y][None, :, None, :]))).sum(axis=(2, 3)) for y in (0, 1))
        parents = _tree(info)
        logs = np.stack([np.full(len(x), np.log(share[y])) for y in (0, 1)])
        for j, parent in enumerate(parents):
            for y in (0, 1):
                if parent < 0:
                    logs[y] += np.log(one[y][j])[x[:, j]]
                else:
                    table = joint[y, parent, j] / joint[y, parent, j].sum(axis=1, keepdims=True)
                    logs[y] += np.log(table)[x[:, parent], x[:, j]]
        weights = _posterior(logs)
    return weights[1]


def _posterior(logs: np.ndarray) -> np.ndarray:
    shifted = np.exp(logs - logs.max(axis=0))
    return shifted / shifted.sum(axis=0)


def _tree(info: np.ndarray) -> list[int]:
    """Parents in the spanning tree of largest information; the root has -1."""
    parents, best, inside = [-1] * len(info), info[0].copy(), {0}
    nearest = [0] * len(info)
    while len(inside) < len(info):
        j = max((k for k in range(len(info)) if k not in inside), key=lambda k: best[k])
        parents[j] = nearest[j]
        inside.add(j)
        for k in range(len(info)):
            if k not in inside and info[j][k] > best[k]:
                best[k], nearest[k] = info[j][k], j
    return parents


def _lexicon(train: DataFrame, n1: int, n0: int) -> list[int]:
    """The strongest terms of n1 toxic and n0 clean sample texts, by falling strength."""
    odds = F.log((F.col("toxic") + 0.5) / (n1 - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (F.greatest(F.lit(n0) - F.col("clean"), F.lit(0)) + 0.5))
    strongest = train.mapInArrow(_term_counts, "term long, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= LEAST_TOXIC).withColumn(
        "toxic", F.least("toxic", F.lit(n1))).withColumn("odds", odds).filter("odds > 2.5").orderBy(
        F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(TERMS)
    return [row.term for row in strongest.select("term").collect()]


def scored(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; documents have doc_id and text, labels doc_id and toxic."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = kept(labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "toxicity-sample")
    # At most fit_rows rows of two numbers.
    train = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")
    totals = dict(sample.groupBy("toxic").count().collect())
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    lexicon = _lexicon(train, n1, n0) if n1 and n0 else []
    if not lexicon:
        share = n1 / (n1 + n0) if n1 + n0 else 0.0
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(share).alias("score"), F.lit(int(share >= THRESHOLD)).alias("predicted"))
    rows = kept(docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _votes(lexicon), "doc_id long, held_out boolean, votes int, hits array<int>"), "toxicity-votes")
    fit = kept(rows.join(F.broadcast(sample), "doc_id"), "toxicity-fit")
    every = {row.votes: row["count"] for row in rows.groupBy("votes").count().collect()}
    known = {(row.votes, row.toxic): row["count"] for row in fit.groupBy("votes", "toxic").count().collect()}
    patterns = np.array(sorted(every), np.int64)
    clamped = np.array([[known.get((p, y), 0) for p in patterns.tolist()] for y in (0, 1)], float)
    counts = np.array([every[p] for p in patterns.tolist()], float) - clamped.sum(axis=0)
    posterior = label_model(patterns, counts, clamped)

    # At most 65,536 patterns.
    table = F.broadcast(spark.createDataFrame(list(zip(patterns.tolist(), posterior.tolist(), strict=True)), "votes int, toxic_share double"))
    soft = fit.drop("toxic").join(table, "votes")
    size = max(1, len(lexicon))
    multi_hot = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains("hits", i).cast("double"))
    both = soft.withColumn("features", array_to_vector(multi_hot)).select("features", F.inline(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("toxic_share").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("toxic_share")).alias("weight")))))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=60, standardization=False).fit(
        kept(both.filter("weight > 1e-6"), "toxicity-soft"))
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    margin = F.aggregate("hits", F.lit(float(model.intercept)), lambda a, i: a + F.element_at(F.col("weights"), i + 1))
    return rows.withColumn("weights", weights).select("doc_id", "held_out", (1 / (1 + F.exp(-margin))).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with all columns; rows without doc_id stay."""
    toxic = kept(scored(docs, labels).filter("predicted = 1 and doc_id is not null").select("doc_id").distinct(), "toxicity-rejected")
    return without_keys(docs, "doc_id", toxic)
