"""License scan: sparse TF-IDF cosine to license templates, then inheritance from the nearest ancestor directory.

Units are the lines of a text that hold a licence word, and the whole text of a licence file. A licence file is one whose
name says so, or whose whole text has a cosine of at least ``WHOLE`` to a template. Terms are runs of a-z and 0-9 in lower
case. Document frequencies of the templates' terms are counted over the units of all files; any other term weighs as one
that no unit holds. A file's own licence is its best template with a cosine of at least ``HEADER``. A file without one
takes that of the licence file in the nearest directory above it, found by a join on directory paths.

Licence files, and texts that hold a licence word, are also compared as a whole with the full texts in the folder
``licence_texts``; there a cosine of at least ``FULL`` counts, before that of any line, and makes the text a licence file.
The frequencies for that are those of the full texts, and lines that name an owner are left out, so the verdict depends
neither on other files nor on the holder's name. ``SPDX-License-Identifier`` lines, and lines of licence files that are
no more than a title, have a cosine of 1 to the licence they name.

Defined cases: null and empty texts and paths have no units and may inherit nothing if the path is null; equal cosines
are decided by the larger licence name, several licence files of one directory by cosine, then licence name; repeated
rows are scanned alike; no rows, no results; columns other than the id, path and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import kept, union_all

# Notices by which the licences ask to be named.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
LICENCE_WORD = r"(?i)licen[cs]e|copyright|redistribution|spdx"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"
HEADER, WHOLE = 0.7, 0.8
#: Different licences come to 0.92 (GPL-2.0 and GPL-3.0) or, as versions, more; then the better one wins.
FULL = 0.93
OWNER = r"(?m)^[^a-z0-9\n]*copyright[ \t]+(\(c\)|©|[0-9]{4}).*$"
SPDX = r"(?i)spdx-license-identifier:[ \t]*(.*)"
# Lines that are nothing but a title, as their terms.
TITLES = {
    "mit license": "MIT",
    "the mit license": "MIT",
    "the mit license mit": "MIT",
    "apache license version 2 0": "Apache-2.0",
    "bsd 3 clause license": "BSD-3-Clause",
    "mozilla public license version 2 0": "MPL-2.0",
    **{f"{start}{terms} 4 0 international{end}": name for start, end in (("", ""), ("creative commons ", ""), ("creative commons ", " public license"))
       for terms, name in (("attribution", "CC-BY-4.0"), ("attribution noncommercial", "CC-BY-NC-4.0"), ("attribution sharealike", "CC-BY-SA-4.0"))},
}


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def full_texts() -> dict[str, str]:
    """The full licence texts, read where the plan is made."""
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in (resources.files("pulsegrid.llm") / "licence_texts").iterdir()}


def _full_matches(source: DataFrame, texts: dict[str, str], full: float) -> DataFrame:
    """(id, path, is_file, best) of the whole texts that come close to a full licence text."""
    counted = {k: Counter(re.findall("[a-z0-9]+", re.sub(OWNER, "", v.lower()))) for k, v in texts.items()}
    weights = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in Counter(t for c in counted.values() for t in c).items()}
    norms = {k: math.sqrt(sum((n * weights[t]) ** 2 for t, n in c.items())) for k, c in counted.items()}
    # Some hundred or thousand terms for each of a few texts.
    known = source.sparkSession.createDataFrame(
        [(k, t, n * weights[t] / norms[k], weights[t]) for k, c in counted.items() for t, n in c.items()], "licence string, term string, t double, idf double")
    units = kept(source.filter(F.col("text").isNotNull() & (F.col("named") | F.col("text").rlike(LICENCE_WORD))).select(
        "id", "path", F.xxhash64("id", "path", "text").alias("key"), _terms(F.regexp_replace(F.lower("text"), OWNER, "")).alias("terms")), "license-texts")
    weighed = _counted(units, "key").join(F.broadcast(known.select("term", "idf").distinct()), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(math.log(1 + len(texts)) + 1)))
    lengths = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("w_norm"))
    dots = weighed.filter("idf is not null").join(F.broadcast(known.select("licence", "term", "t")), "term").groupBy(
        "key", "licence").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    best = dots.join(lengths, "key").groupBy("key").agg(
        F.max(F.struct(F.lit(1).alias("level"), F.round(F.col("dot") / F.col("w_norm"), 6).alias("cosine"), "licence")).alias("best"))
    return units.select("key", "id", "path").join(best.filter(F.col("best.cosine") >= full), "key").select("id", "path", F.lit(True).alias("is_file"), "best")


def _named_licences(source: DataFrame, names: list[str]) -> DataFrame:
    """(id, path, is_file, best) of the licences that SPDX lines, or titles in licence files, name."""
    forms = source.sparkSession.createDataFrame([*TITLES.items(), *((n.lower(), n) for n in names)], "name string, licence string")
    lines = source.filter(F.col("named") | F.col("text").rlike(SPDX)).select("id", "path", "named", F.explode(F.split("text", "\n")).alias("line"))
    ids = F.transform(F.regexp_extract_all(F.lower(F.regexp_extract("line", SPDX, 1)), F.lit("[a-z0-9.+-]+"), F.lit(0)),
                      lambda x: F.regexp_replace(x, r"(-only|-or-later|\+)$", ""))
    title = F.when(F.col("named"), F.array(F.array_join(_terms(F.col("line")), " "))).otherwise(F.array().cast("array<string>"))
    said = lines.select("id", "path", F.col("named").alias("is_file"), F.explode(F.concat(ids, title)).alias("name"))
    return said.join(F.broadcast(forms), "name").select(
        "id", "path", "is_file", F.struct(F.lit(0).alias("level"), F.lit(1.0).alias("cosine"), "licence").alias("best"))


def scanned(files: DataFrame, templates: dict[str, str] | None = None, header: float = HEADER, whole: float = WHOLE,
            texts: dict[str, str] | None = None, full: float = FULL) -> DataFrame:
    """(id, path, licence, cosine, via) of every file; ``files`` has id, path and text. ``via`` is own, inherited or null."""
    spark = files.sparkSession
    notices = spark.createDataFrame(list((templates or TEMPLATES).items()), "licence string, notice string")
    # The templates are a parameter: some hundred terms at most.
    known = _counted(notices.select("licence", _terms(F.col("notice")).alias("terms")), "licence")
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    source = files.select("id", "path", "text", named.alias("named"))
    # A text that is hardly more than a notice may be a licence file: its lines with a licence word hold most of it.
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(LICENCE_WORD))
    noted = F.aggregate(lines, F.lit(0), lambda a, line: a + F.length(line))
    units = F.concat(
        F.transform(lines, lambda line: F.struct(line.alias("unit"), F.lit(False).alias("is_file"))),
        F.when(F.col("named") | ((F.size(lines) > 0) & (2 * noted >= F.length("text"))),
               F.array(F.struct(F.col("text").alias("unit"), F.lit(True).alias("is_file")))).otherwise(
            F.array().cast("array<struct<unit:string,is_file:boolean>>")))
    unit_rows = source.filter(F.col("text").isNotNull() & (named | F.col("text").rlike(LICENCE_WORD))).select(
        "id", "path", F.posexplode(units).alias("number", "u")).select(
        "id", "path", "number", "u.is_file", F.xxhash64("u.unit").alias("digest"), _terms(F.col("u.unit")).alias("terms"))
    unit_rows = kept(unit_rows.withColumn("key", F.xxhash64("id", "path", "number", "digest")), "license-units")
    counts = _counted(unit_rows, "key", "is_file")

    total = unit_rows.select("key").distinct().agg(F.count("*").alias("units"))
    vocabulary = known.select("term").distinct()
    frequency = counts.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.countDistinct("key").alias("df"))
    units_in_all = total.first()[0]
    weight = lambda df: F.log((F.lit(1.0) + units_in_all) / (1 + df)) + 1
    # One row per term of the templates.
    known = kept(known.join(frequency, "term", "left").select(
        "licence", "term", (F.col("tf") * weight(F.coalesce("df", F.lit(0)))).alias("t"), weight(F.coalesce("df", F.lit(0))).alias("idf")), "license-templates")
    norms = known.groupBy("licence").agg(F.sqrt(F.sum(F.col("t") * F.col("t"))).alias("t_norm"))
    idf = known.select("term", "idf").distinct()
    weighed = counts.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", weight(F.lit(0))))
    lengths = weighed.groupBy("key", "is_file").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("w_norm"))
    dots = weighed.filter("idf is not null").join(F.broadcast(known.select("licence", "term", "t")), "term").groupBy(
        "key", "is_file", "licence").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    cosine = dots.join(lengths, ["key", "is_file"]).join(F.broadcast(norms), "licence").select(
        "key", "is_file", "licence", F.round(F.col("dot") / (F.col("w_norm") * F.col("t_norm")), 6).alias("cosine"))
    best = cosine.groupBy("key", "is_file").agg(F.max(F.struct("cosine", "licence")).alias("best"))
    by_name = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    noticed = unit_rows.select("key", "id", "path", "is_file").join(best, ["key", "is_file"]).filter(
        F.col("best.cosine") >= F.when(F.col("is_file") & ~by_name, whole).otherwise(header)).select(
        "id", "path", (F.col("is_file") | by_name).alias("is_file"), F.struct(F.lit(0).alias("level"), "best.cosine", "best.licence").alias("best"))
    texts = full_texts() if texts is None else texts
    judged = kept(union_all([noticed, _full_matches(source, texts, full), _named_licences(source, sorted({*(templates or TEMPLATES), *texts}))]), "license-units")

    own = judged.groupBy("id", "path").agg(F.max("best").alias("own"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    covers = judged.filter("is_file and path is not null").groupBy(folder.alias("folder")).agg(F.max("best").alias("covered"))
    own_key = own.select(F.col("id").alias("own_id"), F.col("path").alias("own_path"), "own")
    all_files = files.select("id", "path")
    marked = all_files.join(own_key, F.col("id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left").select("id", "path", "own")
    # The ancestors of a path, nearest first, by their depth.
    depth = F.size(F.split("path", "/")) - 1
    climbing = marked.filter("own is null and path is not null").select("id", "path").distinct().select(
        "id", "path", F.explode(F.sequence(F.lit(0), depth)).alias("depth")).withColumn("folder", F.expr("substring_index(path, '/', depth)"))
    near = climbing.join(covers, "folder").groupBy("id", "path").agg(F.max(F.struct("depth", "covered")).alias("near")).select(
        F.col("id").alias("near_id"), F.col("path").alias("near_path"), "near.covered")
    out = marked.join(near, F.col("id").eqNullSafe(F.col("near_id")) & F.col("path").eqNullSafe(F.col("near_path")), "left")
    found = F.coalesce("own", "covered")
    return out.select(
        "id", "path", found["licence"].alias("licence"), found["cosine"].alias("cosine"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("covered").isNotNull(), "inherited").alias("via"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source, then language, then the id as name."""
    blank = F.lit("")
    return docs.select(F.col("doc_id").alias("id"), F.concat_ws("/", F.coalesce("source", blank), F.coalesce("lang", blank), F.coalesce(
        F.col("doc_id").cast("string"), blank)).alias("path"), "text")


def sql(header: float = HEADER, whole: float = WHOLE) -> str:
    """The scan of ``document_files`` in DuckDB SQL over the view documents (whose names are no licence files)."""
    values = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())
    terms = lambda c: f"list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda w: w <> '')"
    word = LICENCE_WORD
    return f"""
with files as (select doc_id as id, concat_ws('/', coalesce(source, ''), coalesce(lang, ''), coalesce(doc_id::varchar, '')) as path, text from documents),
lined as (select *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{word}')) as ls from files where regexp_matches(text, '{word}')),
units as (select id, path, false as is_file, unnest(ls) as unit, generate_subscripts(ls, 1) as number from lined
  union all select id, path, true, text, 0 from lined where len(ls) > 0 and 2 * list_sum(list_transform(ls, lambda l: length(l))) >= length(text)),
keyed as (select row_number() over () as key, * from units),
counts as (select key, term, count(*) as tf from (select key, unnest({terms('unit')}) as term from keyed) group by all),
known as (select licence, term, count(*) as tf from (select licence, unnest({terms('notice')}) as term from (values {values}) as t(licence, notice)) group by all),
n as (select count(*)::double as units from keyed),
df as (select term, count(distinct key) as df from counts where term in (select term from known) group by term),
idf as (select k.term, ln((1 + any_value(units)) / (1 + coalesce(any_value(df), 0))) + 1 as idf from known k left join df using (term), n group by k.term),
t as (select licence, term, tf * idf as t from known join idf using (term)),
w as (select key, term, idf, tf * coalesce(idf, ln(1 + units) + 1) as w from counts left join idf using (term), n),
dots as (select key, licence, sum(w * t) as dot from w join t using (term) group by all),
cosine as (select key, licence, round(dot / (w_norm * t_norm), 6) as cosine from dots
  join (select key, sqrt(sum(w * w)) as w_norm from w group by key) using (key)
  join (select licence, sqrt(sum(t * t)) as t_norm from t group by licence) using (licence)),
judged as (select id, path, is_file, licence, cosine from keyed join cosine using (key)
  qualify row_number() over (partition by key order by cosine desc, licence desc) = 1),
passed as (select * from judged where cosine >= case when is_file then {whole} else {header} end),
own as (select id, path, licence, cosine from passed qualify row_number() over (partition by id, path order by cosine desc, licence desc) = 1),
covers as (select regexp_extract(path, '^(.*)/[^/]*$', 1) as folder, licence, cosine from passed where is_file
  qualify row_number() over (partition by folder order by cosine desc, licence desc) = 1),
near as (select f.id, f.path, c.licence, c.cosine from files f join covers c on starts_with(f.path, c.folder || '/')
  qualify row_number() over (partition by f.id, f.path order by length(c.folder) desc) = 1)
select f.id as doc_id, f.path, coalesce(o.licence, near.licence) as licence, coalesce(o.cosine, near.cosine) as cosine,
  case when o.licence is not null then 'own' when near.licence is not null then 'inherited' end as via
from files f left join own o on o.id = f.id and o.path = f.path left join near on near.id = f.id and near.path = f.path"""
