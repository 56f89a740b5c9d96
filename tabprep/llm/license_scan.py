"""License scans with DataFrame operations only.

Terms are the lower-case runs of a-z and 0-9.  A template (a licence name and
a notice) is a TF-IDF vector over its terms; document frequencies of the
templates' terms are counted over all texts, and a term that no template has
gets the frequency zero.  Three kinds of units are compared with the templates
by cosine: every line of a text that holds a marker word (a header), every
block around such a line (a run of comment lines, and a run of lines without
an empty one), and the whole text (a licence file).  Templates are the notices
(``TEMPLATES``) and, with a vocabulary of their own, the standard file headers
and full texts in ``licenses/`` (``TEXTS``); lines are compared with the
notices only, and file headers with blocks only.  A text's own licence is that of its best
header, if the cosine reaches ``least``.  A text whose whole cosine reaches
``least_file`` is a licence file and declares its licence for the directory
of its path; a text without an own licence inherits from the nearest ancestor
directory with a declaration, its own directory first.  Inheritance joins
the distinct directories, not the files, with their ancestors.

Best means: highest cosine rounded to six digits, then the smallest licence
name, then the first line (of a block, its first).  Results: a null or empty text has no own licence
and may inherit; a null path lies in no directory and inherits nothing; rows
with equal id and text get equal results; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, sized

#: Licence notices, a parameter of the scan.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Use of this source code is governed by the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike."),
    ("CC0-1.0", "To the extent possible under law, all copyright is waived; released to the public domain under CC0 1.0."),
    ("GPL-2.0", "This program is free software licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and distribute this software is granted under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, the Unlicense."),
)
#: Standard file headers (*-header.txt, *.header.txt) and full texts: (licence, text, whether a whole text may be it).
TEXTS = tuple((re.sub(r"\.[a-z-]*header$", "", p.stem), p.read_text(), not p.stem.endswith("header")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt")))
#: A line without any of these is no header.
MARKERS = r"(?i)licen[cs]|copyright|copyleft|public domain|permission|spdx|redistribut|creative commons|\bcc0\b|\bcc[ -]by"
SPLIT = "[^a-z0-9]+"
#: Comment lines by their beginning; comments over several lines, by what opens (at a line's beginning) and closes them.
COMMENT = r"(?i)^\s*(#|//|\*|--|;|%|!|'|/\*|<!--|\(\*|\x22{3}|\.\.\s|dnl\b|rem\b)"
OPEN, CLOSE, QUOTES = r"^\s*(/\*|<!--|\(\*|\{-)", r"\*/|-->|\*\)|-\}", r"\x22{3}|'{3}"


def terms(column: Column) -> Column:
    return F.filter(F.split(F.lower(column), SPLIT), lambda t: t != "")


def template_terms(templates=TEMPLATES) -> set[str]:
    return {t for _, notice, *_ in templates for t in re.split(SPLIT, notice.lower()) if t}


def _idf(documents: DataFrame, vocabulary: list[str]) -> tuple[DataFrame, Column, int]:
    """(term, idf) of the templates' terms over all texts; the idf of other terms."""
    n = documents.count()
    known = F.array(*(F.lit(t) for t in vocabulary))
    count = documents.select(F.explode(F.array_intersect(F.split(F.lower("__text"), SPLIT), known)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    all_terms = documents.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string")
    weight = F.log((F.lit(n) + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0
    return all_terms.join(F.broadcast(count), "term", "left").select("term", weight.alias("idf")), F.log(F.lit(n) + 1.0) + 1.0, n


def _cosines(units: DataFrame, idf: DataFrame, other: Column, templates) -> DataFrame:
    """(id, th, line, last, license, cos): best licence of every unit.  units:
    (id, th, line, last, words); a template may say that no whole text is it."""
    spark = units.sparkSession
    given = spark.createDataFrame([(k, name, t, all(file)) for k, (name, t, *file) in enumerate(templates)], "tid int, license string, notice string, file boolean")
    weight = given.select("tid", "license", "file", F.explode(terms(F.col("notice"))).alias("term")).groupBy("tid", "license", "file", "term").agg(F.count("*").alias("tf")).join(F.broadcast(idf), "term")
    weight = weight.select("tid", "license", "file", "term", (F.col("tf") * F.col("idf")).alias("tw"))
    length = weight.groupBy("tid").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    weight = weight.join(F.broadcast(length), "tid")
    unit = ["id", "th", "line", "last"]
    words = units.select(*unit, F.explode("words").alias("term")).groupBy(*unit, "term").agg(F.count("*").alias("tf"))
    words = words.join(F.broadcast(idf), "term", "left").select(*unit, "term", (F.col("tf") * F.coalesce("idf", other)).alias("w"))
    # dot products and the unit's own norm in one aggregate: a term no template has only adds to the norm
    lists = weight.groupBy("term").agg(F.collect_list(F.struct("tid", "license", "file", (F.col("tw") / F.col("tn")).alias("x"))).alias("in"))
    scored = words.join(F.broadcast(lists), "term", "left")
    norm = scored.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = scored.select(*unit, "w", F.explode("in").alias("t")).where("line >= 0 or t.file").groupBy(*unit, "t.tid", "t.license").agg(F.sum(F.col("w") * F.col("t.x")).alias("dot"))
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"d.{c}")) for c in unit]
    both = dot.alias("d").join(norm.alias("n"), same)
    cos = F.round(F.col("dot") / F.col("norm"), 6)
    return both.groupBy(*(F.col(f"d.{c}").alias(c) for c in unit)).agg(F.min(F.struct((-cos).alias("c"), "license")).alias("b")).select(*unit, F.col("b.license").alias("license"), (-F.col("b.c")).alias("cos"))


def _blocks(lines: DataFrame) -> DataFrame:
    """(id, th, line, last, words): the runs of comment lines, and the runs of
    lines with a term, that hold a marker; ``line`` is the first.  lines:
    (id, th, line, l)."""
    order = Window.partitionBy("id", "th").orderBy("line")
    opened = F.when(F.col("l").rlike(CLOSE), False).when(F.col("l").rlike(OPEN), True)
    quoted = F.sum(F.regexp_count("l", F.lit(QUOTES))).over(order.rowsBetween(Window.unboundedPreceding, -1)) % 2 == 1
    inside = F.coalesce(F.last(opened, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)) | F.coalesce(quoted, F.lit(False))
    flagged = lines.withColumn("comment", inside | F.col("l").rlike(COMMENT)).withColumn("full", F.lower("l").rlike("[a-z0-9]"))
    parts = []
    for kind in ("comment", "full"):
        run = F.sum(F.when(~F.col(kind), 1).otherwise(0)).over(order)
        blocks = flagged.withColumn("run", run).where(kind).groupBy("id", "th", "run").agg(
            F.min("line").alias("line"), F.max("line").alias("last"), F.array_sort(F.collect_list(F.struct("line", "l"))).alias("ls"), F.max(F.col("l").rlike(MARKERS)).alias("marked"))
        parts.append(blocks.where("marked").select("id", "th", "line", "last", terms(F.array_join("ls.l", "\n")).alias("words")))
    return parts[0].unionByName(parts[1])


def _ancestors(path: Column) -> Column:
    """The directories above a path or directory, from the root ('') down."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def scan_licenses(documents: DataFrame, path: Column, *, id_col: str = "doc_id", text: str = "text", least: float = 0.6, least_file: float = 0.6,
                  templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """(id, path, own_license, own_line, own_score, declared, inherited_license,
    inherited_from, license) of every row; lines count from 0."""
    scratch = Scratch(documents.sparkSession, "licenses")
    source = documents.select(documents[id_col].alias("id"), F.xxhash64(documents[text]).alias("th"), path.alias("path"), documents[text].alias("__text"))
    idf, other, _ = _idf(source, sorted(template_terms(templates) | template_terms(texts)))
    idf = scratch.save(idf, "idf")
    marked = source.where(F.col("__text").rlike(MARKERS)).select("id", "th", "__text").dropDuplicates(["id", "th"])
    marked = scratch.save(marked, "marked")
    every = marked.select("id", "th", F.posexplode(F.split("__text", "\n")).alias("line", "l"))
    lines = every.where(F.col("l").rlike(MARKERS)).select("id", "th", "line", F.col("line").alias("last"), terms(F.col("l")).alias("words"))
    blocks = scratch.save(_blocks(every).dropDuplicates(["id", "th", "line", "last"]), "blocks")
    whole = marked.select("id", "th", F.lit(-1).alias("line"), F.lit(-1).alias("last"), terms(F.col("__text")).alias("words"))
    notices = lines.unionByName(blocks.where("last > line")).unionByName(whole)
    own_terms = lambda t: idf.where(F.col("term").isin(sorted(template_terms(t))))
    found = _cosines(notices, own_terms(templates), other, templates)
    if texts:
        found = found.unionByName(_cosines(blocks.unionByName(whole), own_terms(texts), other, texts))
    found = found.groupBy("id", "th", "line").agg(F.min(F.struct((-F.col("cos")).alias("c"), "license")).alias("b")).select("id", "th", "line", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cos"))
    found = scratch.save(found, "cosines")
    own = found.where((F.col("line") >= 0) & (F.col("cos") >= least)).groupBy("id", "th").agg(F.min(F.struct((-F.col("cos")).alias("c"), "license", "line")).alias("o"))
    file = found.where((F.col("line") < 0) & (F.col("cos") >= least_file)).select("id", "th", F.col("license").alias("declared"), F.col("cos").alias("file_score"))
    both = own.alias("a").join(file.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.th") == F.col("b.th")), "full")
    both = scratch.save(both.select(F.coalesce("a.id", "b.id").alias("i"), F.coalesce("a.th", "b.th").alias("t"), F.col("o.license").alias("own_license"), F.col("o.line").alias("own_line"),
                                    (-F.col("o.c")).alias("own_score"), "declared", "file_score"), "own")
    rows = source.select("id", "th", "path").join(sized(both, both.count() * 2), F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left").drop("i", "t", "th")
    rows = rows.withColumn("dir", directory(F.col("path")))
    declared = rows.where("declared is not null and dir is not null").groupBy(F.col("dir").alias("from")).agg(F.min(F.struct((-F.col("file_score")).alias("c"), "declared")).alias("f"))
    declared = scratch.save(declared.select("from", F.col("f.declared").alias("inherited_license")), "declared")
    folders = source.select(directory(F.col("path")).alias("folder")).where("folder is not null").distinct()
    above = folders.select("folder", F.posexplode(F.array_distinct(_ancestors(F.col("folder")))).alias("depth", "from"))
    nearest = above.join(sized(declared, declared.count()), "from").groupBy("folder").agg(F.max(F.struct("depth", "from", "inherited_license")).alias("m"))
    nearest = scratch.save(nearest.select("folder", F.col("m.from").alias("inherited_from"), F.col("m.inherited_license").alias("inherited_license")), "nearest")
    out = rows.join(sized(nearest, nearest.count()), F.col("dir") == F.col("folder"), "left")
    takes = F.col("own_license").isNull()
    return out.select(F.col("id").alias(id_col), "path", "own_license", "own_line", "own_score", "declared", F.when(takes, F.col("inherited_license")).alias("inherited_license"),
                      F.when(takes, F.col("inherited_from")).alias("inherited_from"), F.coalesce("own_license", F.col("inherited_license")).alias("license"))


def oracle_sql(templates=TEMPLATES, least: float = 0.6, least_file: float = 0.6) -> str:
    """The same over ``documents`` (unique ids), for DuckDB, of lines, whole
    texts and notices; the results agree where no block, standard header or
    full text scores higher (compared on sf0.001)."""
    values = ", ".join(f"({k}, '{name}', '{notice}')" for k, (name, notice) in enumerate(templates))
    marker = MARKERS.replace("(?i)", "")
    return f"""
with given(tid, license, notice) as (values {values}),
tterm as (select tid, license, term, count(*) as tf from (select tid, license, unnest(string_split_regex(lower(notice), '{SPLIT}')) as term from given) where term <> '' group by all),
n as (select count(*) as n from documents),
seen as (select term, count(*) as df from (select distinct doc_id, unnest(string_split_regex(lower(text), '{SPLIT}')) as term from documents) where term in (select term from tterm) group by term),
idf as (select v.term, ln((n.n + 1.0) / (coalesce(s.df, 0) + 1.0)) + 1.0 as idf from (select distinct term from tterm) v left join seen s using (term), n),
tw as (select tid, license, term, tf * idf as tw from tterm join idf using (term)),
tn as (select tid, sqrt(sum(tw * tw)) as tn from tw group by tid),
marked as (select doc_id, text from documents where regexp_matches(text, '{marker}', 'i')),
lines as (select doc_id, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from marked),
unit as (select doc_id, line, l from lines where regexp_matches(l, '{marker}', 'i') union all select doc_id, -1, text from marked),
word as (select doc_id, line, term, count(*) as tf from (select doc_id, line, unnest(string_split_regex(lower(l), '{SPLIT}')) as term from unit) where term <> '' group by all),
w as (select doc_id, line, term, tf * coalesce(idf, ln(n.n + 1.0) + 1.0) as w from word left join idf using (term), n),
norm as (select doc_id, line, sqrt(sum(w * w)) as norm from w group by all),
dot as (select doc_id, line, tid, license, sum(w * tw / tn) as dot from w join tw using (term) join tn using (tid) group by all),
cos as (select doc_id, line, license, round(dot / norm, 6) as cos from dot join norm using (doc_id, line)),
best as (select doc_id, line, license, cos from cos qualify row_number() over (partition by doc_id, line order by cos desc, license) = 1),
own as (select doc_id, license as own_license, line as own_line, cos as own_score from best where line >= 0 and cos >= {least} qualify row_number() over (partition by doc_id order by cos desc, license, line) = 1),
file as (select doc_id, license as declared, cos as file_score from best where line < 0 and cos >= {least_file}),
r as (select d.doc_id, d.source || '/' || d.lang || '/' || d.doc_id as path, d.source || '/' || d.lang as dir, d.source as up, o.*exclude(doc_id), f.*exclude(doc_id) from documents d left join own o using (doc_id) left join file f using (doc_id)),
decl as (select dir, declared as lic from r where declared is not null qualify row_number() over (partition by dir order by file_score desc, declared) = 1)
select doc_id, path, own_license, own_line, own_score, declared,
       case when own_license is null then lic end as inherited_license, case when own_license is null and lic is not null then r.dir end as inherited_from, coalesce(own_license, lic) as license
from r left join decl on r.dir = decl.dir
"""
