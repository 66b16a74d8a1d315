"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-grams of all texts are hashed and joined to the positions of
the same k-grams in the templates (k = 2; a base phrase's third word, where there
is one, is compared in the join, as are the words behind the hash). A match of
text position p with template position t votes for the diagonal p - t. Votes are
aggregated by (row, template, diagonal). A base phrase stands where one
diagonal holds all its k-grams. For license templates neighbouring diagonals
(at most GAP apart: words put in or left out) are merged into a span, which is
verified: its k-grams must cover MIN_COVERAGE of the template's words (rounded
down, so that one word of a short template may differ) and the words that tell
the template from others, within MAX_STRETCH times its length.

The template table is fixed, so the broadcast of its k-grams is bounded. Texts
are read once: matches are written with a number for each row, and a row of its
own for each text carries its word count. Only matches are shuffled.

Cases: NULL text is empty (0 words, no place). Every row gets its own result,
whatever its doc_id. An empty table gives no rows. Extra columns are ignored. A
text's words are one array in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partwise.llm.common import stored

#: FIXED VALUES: base phrases, found as they stand, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: FIXED VALUES: license notices, found with words changed, put in or left out, and their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: FIXED VALUES: the words that tell a label's templates from others, of which none may be missing.
TELLING = {
    "apache-2.0": "apache 2",
    "mit": "mit",
    "cc-by-nc-4.0": "nc",
    "cc-by-sa-4.0": "sa",
    "gpl-3.0": "gnu 3",
    "gpl-2.0": "gnu 2",
    "gpl-notice": "gnu",
    "mpl-2.0": "mozilla",
    "unlicense": "unencumbered",
}
GAP = 3
MIN_COVERAGE = 0.85
MAX_STRETCH = 1.5

#: What separates words once A-Z are lowered.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalized(text: Column) -> Column:
    """The words of ``text``, one space between them.

    lower() also lowers characters beyond A-Z; that moves no word boundary, and
    the one that it turns into ASCII letters used by a phrase (the Kelvin sign)
    is put aside first.
    """
    return F.trim(F.regexp_replace(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))), _BREAK, " "))


def word_count(norm: Column) -> Column:
    return F.when(norm == "", F.lit(0)).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def needed(words: list[str]) -> int:
    """Words of a template that a span must cover."""
    return int(MIN_COVERAGE * len(words))


def telling(words: list[str], label: str) -> list[int]:
    """Places in a template of the words that tell its label from others."""
    return [words.index(w) for w in TELLING.get(label, "").split() if w in words]


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """(template, label, base, n_template_words, grams, needed, telling, t, w0, w1, w2) per k-gram position of each template;
    w2 for base phrases only."""
    rows = []
    for number, (text, label) in enumerate([*phrases.items(), *templates.items()]):
        words, base = text.split(), number < len(phrases)
        grams = max(1, len(words) - (2 if base else 1))
        for t in range(grams):
            third = words[t + 2] if base and len(words) > 2 else None
            rows.append((number, label, base, len(words), grams, needed(words), [] if base else telling(words, label), t, words[t], words[t + 1], third))
    schema = "template int, label string, base boolean, n_template_words int, grams int, needed int, telling array<int>, t int, w0 string, w1 string, w2 string"
    return spark.createDataFrame(rows, schema).withColumn("h", F.xxhash64("w0", "w1"))


def matches(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """One row a text (row, doc_id, n_words, p = -1), and one (row, template, diagonal, p, t ...) for each template k-gram found at a text's position p."""
    words = docs.select("row", "doc_id", word_count(F.col("norm")).alias("n_words"), F.split("norm", " ").alias("w"))
    n = F.size("w")
    # One more word in front, at position -1, is the text's own row.
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("w"))
    following = F.arrays_zip(shifted.alias("a"), F.col("w").alias("b"), F.slice("w", 2, n).alias("c"))
    rolled = words.select("row", "doc_id", "n_words", F.posexplode(following).alias("p", "g")).select(
        "row", "doc_id", "n_words", (F.col("p") - 1).cast("bigint").alias("p"), F.col("g.a").alias("d0"), F.col("g.b").alias("d1"), F.col("g.c").alias("d2")
    )
    rolled = rolled.withColumn("dh", F.xxhash64("d0", "d1"))
    same = (F.col("dh") == F.col("h")) & (F.col("d0") == F.col("w0")) & (F.col("d1") == F.col("w1")) & (F.col("w2").isNull() | (F.col("d2") == F.col("w2")))
    found = rolled.join(F.broadcast(grams), same, "left").filter("p = -1 or template is not null")
    kept = ["row", "doc_id", "n_words", "template", "label", "base", "n_template_words", "grams", "needed", "telling", "p", "t"]
    return found.select(*kept).withColumn("diagonal", F.col("p") - F.col("t"))


def places(found: DataFrame) -> DataFrame:
    """Spans (row, label, base, first, coverage): whole base phrases, and verified license notices."""
    key = ["row", "template", "label", "base", "n_template_words", "grams", "needed", "telling"]
    votes = found.groupBy(*key, "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.collect_set("t").alias("ts"), F.min("p").alias("first"), (F.max("p") + 2).alias("last"))
    base = votes.filter("base and votes = grams").select("row", "label", "base", "first", F.lit(1.0).alias("coverage"))

    along = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= GAP, 0).otherwise(1)
    spans = (
        votes.filter("not base")
        .withColumn("fresh", fresh)
        .withColumn("span", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "span")
        .agg(F.flatten(F.collect_list("ts")).alias("ts"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    covered = F.array_union(F.col("ts"), F.transform("ts", lambda t: t + 1))
    verified = spans.withColumn("covered", covered).filter(
        (F.size("covered") >= F.col("needed")) & (F.size(F.array_except("telling", "covered")) == 0) & (F.col("last") - F.col("first") <= MAX_STRETCH * F.col("n_template_words"))
    )
    return base.unionByName(verified.select("row", "label", "base", "first", (F.size("covered") / F.col("n_template_words")).cast("double").alias("coverage")))


def scan(docs: DataFrame, phrases: dict[str, str] = BASE_PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalized(F.col("text")).alias("norm"), F.monotonically_increasing_id().alias("row"))
    found = stored(matches(rows, template_grams(spark, phrases, templates)), "license-matches")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    own = F.when(F.col("base"), F.col("first"))
    hits = places(found.filter("p >= 0")).groupBy("row").agg(
        F.count(own).alias("n_base"), F.min(own).alias("first_word"), F.max(own).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("coverage").alias("score"),
    )
    return found.filter("p = -1").join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle_sql(phrases: dict[str, str] = BASE_PHRASES, templates: dict[str, str] = TEMPLATES) -> str:
    """The scan of ``documents`` in DuckDB SQL: words, all template positions, votes, spans."""
    values = []
    for number, (text, label) in enumerate([*phrases.items(), *templates.items()]):
        words, base = text.split(), number < len(phrases)
        values.append(f"({number}, '{label}', {str(base).lower()}, {needed(words)}, {[] if base else telling(words, label)}::bigint[], '{text}')")
    return f"""
with template as (select template, label, base, needed, telling, string_split(words, ' ') tw from (values {", ".join(values)}) v(template, label, base, needed, telling, words)),
gram as (select template, label, base, needed, telling, len(tw) n, g grams, unnest(range(g)) t, tw from (select *, greatest(1, len(tw) - if(base, 2, 1)) g from template)),
doc as (select row_number() over () r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') w from documents),
word as (select r, unnest(range(len(w))) p, unnest(w) d0, unnest(w[2:] || [null]) d1, unnest(w[3:] || [null, null]) d2 from doc where len(w) > 1),
hit as (select r, template, label, base, needed, telling, n, grams, p, t, p - t diagonal from word join gram
    on d0 = tw[t + 1] and d1 = tw[t + 2] and (not base or n < 3 or d2 = tw[t + 3])),
vote as (select r, template, label, base, needed, telling, n, grams, diagonal, count(*) votes, list(t) ts, min(p) p0, max(p + 2) p1 from hit group by all),
step as (select *, case when diagonal - lag(diagonal) over (partition by r, template order by diagonal) <= {GAP} then 0 else 1 end fresh from vote where not base),
span as (select *, sum(fresh) over (partition by r, template order by diagonal) s from step),
merged as (select r, template, label, needed, telling, n, s, flatten(list(ts)) ts, min(p0) p0, max(p1) p1 from span group by r, template, label, needed, telling, n, s),
spread as (select label, r, p0, p1, n, needed, telling, list_distinct(list_concat(ts, list_transform(ts, lambda x: x + 1))) covered from merged),
place as (select r, label, true base, p0, 1.0::double coverage from vote where base and votes = grams
    union all select r, label, false, p0, len(covered) / n from spread where len(covered) >= needed and list_has_all(covered, telling) and p1 - p0 <= {MAX_STRETCH} * n),
found as (select r, count(*) filter (where base) n_base, min(p0) filter (where base) first_word, max(p0) filter (where base) last_word,
    string_agg(distinct label, ',' order by label) filter (where base) base_labels, string_agg(distinct label, ',' order by label) as labels, max(coverage) score from place group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word, last_word::bigint last_word,
    coalesce(base_labels, '') base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double score
from doc left join found using (r)
"""
