"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base counts of a text become rates in thousandths. A setting is a cutoff for some rules; a text is rejected by a setting if any
of its rates is above. Settings stand in one fixed order, each stricter than the one before: rule after rule, in the order of
``RULES``, from its largest cutoff to its smallest. The labelled good documents of a stratum are the holdout: with ``n`` of
them, ``k`` rejected by a setting, it is certified if the exact binomial tail P(Bin(n, risk) <= k) is at most ``error`` divided
by the number of strata that are tested (Bonferroni), and if all settings before it are. A fixed order that stops at the first failure needs
no correction of its own. So with probability 1 - ``error`` the strictest certified setting of no stratum, all rules together,
rejects more than ``risk`` of its good documents.

A stratum needs ``least_holdout`` documents for its first setting to be certifiable. Strata that have some but fewer are tested
together as one more stratum, for whose good documents as a whole the risk then holds. Which are, follows from the numbers of
labelled documents alone. Strata without any have no cutoffs.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; null ``lang`` is a stratum of its
own; a document labelled more than once counts with its lowest label; labels without a document, and null ids or labels,
teach nothing; repeated rows are judged alike; an empty table or empty labels give no cutoffs. Other columns are left
alone, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import _maybe, kept

#: Bits of the map that clears rows without a shuffle.
BITS = 1 << 22
SPACE = r"[\x20\x09-\x0D]"
#: Rate of each rule in thousandths; a rate above the cutoff is against the text. Prose has least of the first ones.
RULES = {
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "capitals": "1000 * n_capitals div greatest(word_chars, 1)",
}
CUTOFFS = [600, 400, 300, 200, 120, 80, 50, 30, 20, 10]
SETTINGS = len(RULES) * len(CUTOFFS)
#: Largest false rejection in a stratum, and the chance that the setting of any stratum breaks it.
RISK, ERROR = 0.01, 0.05
#: Languages are dealt to strata by a digest, so the table of cutoffs has a fixed size.
STRATA = 256
POOL = "pool"


def least_holdout(strata: int, risk: float = RISK, error: float = ERROR) -> int:
    """Holdout documents with which a setting that rejects none of them is certified, for so many strata."""
    return math.ceil(math.log(error / strata) / math.log(1 - risk))


def stratum(lang: str = "lang") -> Column:
    return F.substring(F.md5(F.coalesce(F.col(lang), F.lit("")).cast("binary")), 1, 2)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with columns ``q_words`` … appended: base counts of the whole text under names that start with ``q_``.

    Word triples are compared by their 64-bit hashes within a text. Only texts with an equal pair of hashes are sorted.
    """
    blank = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("q_text", blank).withColumn(
        "q_list", F.array_remove(F.split("q_text", f"{SPACE}+"), ""))
    found = found.withColumn("q_n", F.size("q_list")).withColumn("q_triples", F.expr(
        "case when q_n >= 3 then transform(sequence(0, q_n - 3), i -> xxhash64(q_list[i], q_list[i + 1], q_list[i + 2]))"
        " else cast(array() as array<bigint>) end"))
    found = found.withColumn("q_sorted", F.expr(
        "case when size(array_distinct(q_triples)) < size(q_triples)"
        " then sort_array(transform(q_triples, (h, i) -> struct(h as h, i as i))) end"))
    found = found.withColumn("q_hits", F.expr(
        "filter(q_sorted, (s, i) -> coalesce(s.h = get(q_sorted, i - 1).h, false) or coalesce(s.h = get(q_sorted, i + 1).h, false))"))
    lines = F.filter(F.split("q_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = found.withColumn("q_lines", lines)
    without = lambda pattern: F.length("q_text") - F.length(F.regexp_replace("q_text", pattern, ""))
    return found.select(
        *docs.columns,
        F.col("q_n").cast("long").alias("q_words"),
        F.length(F.array_join("q_list", "")).cast("long").alias("q_chars"),
        without(r"[#*$%&|<>]").cast("long").alias("q_symbols"),
        F.size("q_lines").cast("long").alias("q_line_count"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("q_dup_lines"),
        F.coalesce(F.size(F.array_distinct(F.flatten(F.transform(
            "q_hits", lambda s: F.array(s.i, s.i + 1, s.i + 2))))), F.lit(0)).cast("long").alias("q_repeats"),
        without("[A-Z]").cast("long").alias("q_capitals"),
    )


def base_counts(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns ``keys``, stratum, base counts, base_failed, a rate per rule) of every row."""
    # size() of a null array is -1 in some modes; texts without repeats must count as 0.
    rows = measured(docs.select(F.col(doc_id).alias("doc_id"), *keys, F.col(lang).alias("lang"), F.col(text).alias("text")))
    counts = rows.select(
        "doc_id", *keys, stratum().alias("stratum"), F.col("q_words").alias("n_words"), F.col("q_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"), F.col("q_line_count").alias("n_lines"),
        F.col("q_dup_lines").alias("n_dup_lines"), F.greatest("q_repeats", F.lit(0)).alias("n_repeat_words"),
        F.col("q_capitals").alias("n_capitals"))
    return counts.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        **{f"rate_{rule}": F.expr(rate) for rule, rate in RULES.items()},
    })


def first_setting() -> Column:
    """Number of the first setting that rejects a document; ``SETTINGS`` if none does."""
    found = []
    for i, rule in enumerate(RULES):
        step = F.lit(SETTINGS)
        for j, cutoff in reversed(list(enumerate(CUTOFFS))):
            step = F.when(F.col(f"rate_{rule}") > cutoff, i * len(CUTOFFS) + j).otherwise(step)
        found.append(step)
    return F.least(*found)


def _tail(risk: float) -> Column:
    """Logarithm of P(Bin(n, risk) <= k), summed in logarithms, for k below the mean."""
    odds = math.log(risk / (1 - risk))
    return F.expr(
        f"aggregate(case when k > 0 and k < {risk!r}D * n then sequence(1L, k) else cast(array() as array<bigint>) end,"
        f" named_struct('t', n * {math.log(1 - risk)!r}D, 's', n * {math.log(1 - risk)!r}D),"
        f" (a, i) -> named_struct('t', a.t + ln((n - i + 1) / i) + {odds!r}D,"
        f" 's', greatest(a.s, a.t + ln((n - i + 1) / i) + {odds!r}D) + ln(1 + exp(-abs(a.s - (a.t + ln((n - i + 1) / i) + {odds!r}D))))),"
        f" a -> a.s)")


def certified(tests: DataFrame, risk: float, error: float) -> DataFrame:
    """(place, settings): how many settings of each place are certified, for tests (place, setting, strata, n, k) of all of them."""
    passed = (F.col("k") < F.lit(risk) * F.col("n")) & (_tail(risk) <= F.log(F.lit(error) / F.col("strata")))
    return tests.groupBy("place").agg(F.coalesce(F.min(F.when(~passed, F.col("setting"))), F.lit(SETTINGS)).alias("settings"))


def cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, cutoff per rule or null): at most ``STRATA`` rows.

    ``labels`` has doc_id and quality (1 good, 0 bad). Texts that fail the base rule are not at stake and not counted.
    """
    good = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    # Counted under a condition: a filter would be pushed below the counting, and that be done twice.
    first = F.when(~F.col("base_failed"), first_setting())
    held = counts.join(good.select("doc_id"), "doc_id").select("stratum", first.alias("first"))
    sizes = kept(held.groupBy("stratum").agg(
        F.count("first").alias("n"), *[F.count_if(F.col("first") <= i).alias(f"k_{i}") for i in range(SETTINGS)]).filter("n > 0"), "quality-holdout")
    strata = sizes.count() + 1
    placed = sizes.withColumn("place", F.when(F.col("n") >= least_holdout(strata, risk, error), F.col("stratum")).otherwise(POOL))
    sums = placed.groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(f"k_{i}").alias(f"k_{i}") for i in range(SETTINGS)])
    tests = sums.select("place", "n", F.lit(sums.count()).alias("strata"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("setting"), F.col(f"k_{i}").alias("k")) for i in range(SETTINGS)])))
    chosen = placed.select("stratum", "place").join(F.broadcast(certified(tests, risk, error)), "place")
    ladder = F.array(*[F.lit(c).cast("long") for c in CUTOFFS])
    step = lambda i: F.least(F.col("settings") - i * len(CUTOFFS), F.lit(len(CUTOFFS)))
    return chosen.select("stratum", *[
        F.when(step(i) > 0, F.try_element_at(ladder, F.greatest(step(i), F.lit(1)).cast("int"))).alias(f"cut_{rule}") for i, rule in enumerate(RULES)])


def judged(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """The counted rows with ``kept``: they pass the base rule and no certified cutoff of their stratum is exceeded."""
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(F.col(f"rate_{rule}") > F.col(f"cut_{rule}"), F.lit(False))
    # At most STRATA rows of five columns. One CASE, so that a filter on it is not split and pushed below the counting.
    return counts.join(F.broadcast(limits), "stratum", "left").withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~over))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """doc_id, base counts, base_failed and kept of every document."""
    counts = kept(base_counts(docs), "quality-counts")
    limits = kept(cutoffs(counts, labels, risk, error), "quality-cutoffs")
    return judged(counts, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def good_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The kept rows with all their columns.

    Texts are measured once. Rejected rows are known by two hashes of id, language and text; only rows that a bitmap of
    fixed size cannot clear are shuffled.
    """
    hashes = [F.xxhash64("doc_id", "lang", "text").alias("q_key"), F.xxhash64(F.lit(1), "doc_id", "lang", "text").alias("q_other")]
    packed = docs.select(F.struct("*").alias("row"), *hashes)
    counts = kept(base_counts(packed.select("row.doc_id", "row.lang", "row.text", "q_key", "q_other"), keys=("q_key", "q_other")), "quality-counts")
    limits = kept(cutoffs(counts, labels, risk, error), "quality-cutoffs")
    gone = kept(judged(counts, limits).filter(~F.col("kept")).select("q_key", "q_other").distinct(), "quality-rejected")
    marked = _maybe(packed, "q_key", gone, BITS)
    doubtful = marked.filter("maybe").select("row.*").join(gone, ["q_key", "q_other"], "left_anti")
    return marked.filter(~F.col("maybe")).select("row.row.*").unionByName(doubtful.select("row.*"))


def sql(risk: float = RISK, error: float = ERROR) -> str:
    """The same in DuckDB SQL over views documents and labels."""
    steps = [" ".join(f"when rate_{rule} > {c} then {i * len(CUTOFFS) + j}" for j, c in enumerate(CUTOFFS)) for i, rule in enumerate(RULES)]
    first = "least(" + ", ".join(f"case {s} else {SETTINGS} end" for s in steps) + ")"
    cuts = ", ".join(
        f"case when settings > {i * len(CUTOFFS)} then {CUTOFFS}[least(settings - {i * len(CUTOFFS)}, {len(CUTOFFS)})] end as cut_{rule}"
        for i, rule in enumerate(RULES))
    over = " or ".join(f"coalesce(rate_{rule} > cut_{rule}, false)" for rule in RULES)
    rates = ", ".join(f"{rate.replace(' div ', ' // ')} as rate_{rule}" for rule, rate in RULES.items())
    return rf"""
with texts as (select doc_id, lang, coalesce(text, '') as text from documents),
split as (select doc_id, lang, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from texts),
triples as (select doc_id, p, count(*) over (partition by doc_id, t) as c from (select doc_id,
  unnest(range(1, len(ws) - 1)) as p, unnest(list_zip(ws[:-3], ws[2:-2], ws[3:])) as t from split where len(ws) >= 3)),
repeats as (select doc_id, count(distinct q) as n_repeat_words
  from (select doc_id, unnest([p, p + 1, p + 2]) as q from triples where c > 1) group by doc_id),
base as (select s.doc_id, substr(md5(coalesce(lang, '')), 1, 2) as stratum, len(ws) as n_words,
  length(array_to_string(ws, '')) as word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
  length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_capitals,
  len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from split s left join repeats r on r.doc_id = s.doc_id),
counts as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed, {rates} from base),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
held as (select stratum, {first} as first from counts join good using (doc_id) where not base_failed),
sizes as (select stratum, count(*) as n from held group by stratum),
number as (select count(*) + 1 as strata from sizes),
placed as (select stratum, case when n >= ceil(ln({error} / strata) / ln(1 - {risk})) then stratum else '{POOL}' end as place from sizes, number),
totals as (select place, count(*) as n from held join placed using (stratum) group by place),
tests as (select place, setting, n, coalesce((select count(*) from held h join placed p using (stratum)
    where p.place = totals.place and h.first <= setting), 0) as k from totals, range({SETTINGS}) as s(setting)),
places as (select count(*) as strata from totals),
judged as (select *, k < {risk} * n and list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
    - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) <= {error} / strata as passed from tests, places),
certified as (select place, coalesce(min(setting) filter (not passed), {SETTINGS}) as settings from judged group by place),
limits as (select stratum, {cuts} from placed join certified using (place))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  (not base_failed and not ({over})) as kept
from counts left join limits using (stratum)"""
