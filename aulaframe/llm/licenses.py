"""License scans as an exact set-similarity join, in DataFrame functions only.

Text blocks are joined with license templates. The blocks of a template are the
windows of ceil(words / ``threshold``) consecutive words that start at any word
of the whole text (shorter at its end), so lines don't matter. A block meets a
template when it holds at least ``threshold`` of the template's distinct words,
all words that tell it from similar ones, and none of those that belong to
another license. Words are put in one global order, rarest first, by their
document frequency over all texts. Of a template with t words that needs o of
them, only the first t - o + 1 (its prefix) are indexed: a block without any of
these can't hold o. So the places of prefix words probe the index, each with the
words around it; the length filter drops places with fewer than o of the
template's words around them, the positional filter those after which too few
remain on either side, and the windows that hold the place are verified by
intersecting the sets. The template table is a fixed parameter (tens of rows),
so the index is broadcast.

Base labels come from phrases: places where their words stand consecutively in
the whole text.

Defined results: null text is empty; a text without words has n_words 0, no
places and score 0; null ids and repeated rows are rows of their own; an empty
table gives an empty result; other columns are ignored. ``score`` is the
largest containment among the templates that are met (1 for a base phrase), 0
if there is none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, documents, lower_ascii

#: a word after lower-casing, and the same before
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases of the base result, and public license statements.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# label, statement, words that a block must hold, words that it must not hold
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0", ("apache", "2"), ()),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("applicable",), ()),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution",), ()),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", ("endorse",), ()),
    ("cc-by", "licensed under cc by 4 0", ("by", "cc"), ("nc", "nd", "sa")),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", ("attribution",), ("noderivatives", "noncommercial", "sharealike")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("by", "nc"), ("nd", "sa")),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("2", "general"), ("affero", "lesser", "library")),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("3", "general"), ("affero", "lesser", "library")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("fee",), ()),
    ("mit", "released under the mit license", ("mit",), ()),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("obtaining",), ()),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla",), ()),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered",), ()),
)
THRESHOLD = 0.8


def _needed(words: set[str], threshold: float) -> int:
    return max(1, math.ceil(threshold * len(words) - 1e-9))


def _width(text: str, threshold: float) -> int:
    """Words of a block: more could hold too few of the template's."""
    return math.ceil(len(text.split()) / threshold - 1e-9)


def template_index(vocabulary: list[str], templates, threshold: float) -> list[tuple]:
    """(token, template, place, size, needed, label, words, width, required,
    excluded) for every word of every template's prefix; ``vocabulary`` is in
    the global order."""
    place = {w: i for i, w in enumerate(vocabulary)}
    rows = []
    for k, (label, text, required, excluded) in enumerate(templates):
        words = sorted(set(text.split()), key=place.__getitem__)
        need = _needed(set(words), threshold)
        rows += [(w, k, i + 1, len(words), need, label, words, _width(text, threshold), list(required), list(excluded))
                 for i, w in enumerate(words[:len(words) - need + 1])]
    return rows


def _either(words) -> str:
    """One of the words as a whole word, in any ASCII case (the words are
    letters and digits)."""
    edge = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
    return f"(?i)(?<!{edge})(?:{'|'.join(sorted(words))})(?!{edge})"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, text: str = "text",
         doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score for every row of ``docs``."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    vocabulary = sorted({w for _, x, *_ in (*templates, *phrases) for w in x.split()})
    lit_array = lambda ws: F.array(*[F.lit(w) for w in ws])
    # document frequency of the template words over all texts: one row a word
    seen = F.array_intersect(lit_array(vocabulary), F.regexp_extract_all(F.lower("t"), F.lit(WORD), F.lit(0)))
    freq = {r.w: r.n for r in src.select(F.explode(seen).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    vocabulary.sort(key=lambda w: (freq.get(w, 0), w))
    index_rows = template_index(vocabulary, templates, threshold)
    index = spark.createDataFrame(index_rows, "token string, template int, place int, size int, needed int, label string, words array<string>, "
                                                "width int, required array<string>, excluded array<string>")
    # a phrase's rarest word must occur for the phrase to occur
    rarest = {min(x.split(), key=vocabulary.index) for _, x in phrases}
    prefix = sorted({r[0] for r in index_rows})
    widest = max((r[7] for r in index_rows), default=1)
    probe = _either({*prefix, *rarest})

    counted = src.withColumn("n_words", F.regexp_count("t", F.lit(ANY_CASE_WORD)).cast("long"))
    hit = F.col("t").rlike(probe)
    none = F.lit(None).cast("long")
    without = counted.filter(~hit).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_base"), none.alias("first_word"), none.alias("last_word"),
        F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))

    some = counted.filter(hit).withColumn("t", lower_ascii(F.col("t"))).withColumn("row", F.monotonically_increasing_id())
    words = F.regexp_extract_all("t", F.lit(WORD), F.lit(0))

    def places(phrase: str):
        """Starts of the phrase: the words that equal its rarest word, checked
        against the words around them."""
        parts = phrase.split()
        anchor = min(range(len(parts)), key=lambda i: vocabulary.index(parts[i]))
        at = F.transform("w", lambda x, i: F.when(x == parts[anchor], i - anchor).otherwise(F.lit(-1)))
        return F.filter(at, lambda s: (s >= 0) & F.forall(
            F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(parts)]),
            lambda q: F.coalesce(F.get(F.col("w"), s + q["k"]) == q["p"], F.lit(False))))

    some = some.withColumn("w", words)
    for i, (_, phrase) in enumerate(phrases):
        holds = F.array_contains("w", F.lit(min(phrase.split(), key=vocabulary.index)))
        some = some.withColumn(f"p{i}", F.when(holds, places(phrase)).otherwise(F.array().cast("array<int>")))

    def around(at):
        """Each place with its word and the words that a block with it can hold."""
        return F.transform(at, lambda p: F.struct(
            F.get("w", p).alias("token"), F.least(p, F.lit(widest - 1)).alias("c"),
            F.slice("w", F.greatest(p - (widest - 1), F.lit(0)) + 1, F.least(p, F.lit(widest - 1)) + widest).alias("b")))

    every = F.flatten(F.array(*[F.col(f"p{i}") for i in range(len(phrases))]))
    base_labels = F.filter(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(phrases)]), lambda x: x.isNotNull())
    some = cut(some.withColumn("every", every).select(
        "row", "doc_id", "n_words", F.size("every").cast("long").alias("n_base"), F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"), base_labels.alias("base"),
        around(F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(prefix), i)))).alias("places")))

    place = some.select("row", F.inline("places")).join(F.broadcast(index), "token")
    reach = F.slice("b", F.greatest(F.col("c") - F.col("width") + 1, F.lit(0)) + 1, F.least(F.col("c"), F.col("width") - 1) + F.col("width"))
    near = place.withColumn("own", F.array_intersect(lit_array(vocabulary), reach)) \
        .withColumn("at", F.array_position("own", F.col("token")) - 1) \
        .filter(F.size(F.array_intersect("own", "words")) >= F.col("needed")) \
        .filter("1 + least(size - place, size(own) - at - 1) + least(place - 1, at) >= needed")

    def common(start):
        block = F.slice("b", start + 1, F.col("width"))
        told = F.forall("required", lambda r: F.array_contains(block, r)) & ~F.arrays_overlap(block, "excluded")
        return F.when(told, F.size(F.array_intersect("words", block)))

    starts = F.sequence(F.greatest(F.col("c") - F.col("width") + 1, F.lit(0)), F.col("c"))
    matched = near.withColumn("common", F.array_max(F.transform(starts, common))).filter("common >= needed")
    found = matched.groupBy("row").agg(F.collect_set("label").alias("met"), F.max(F.col("common") / F.col("size")).alias("share"))
    joined = some.join(found, "row", "left")
    sets = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    with_hits = joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", sets("base").alias("base_labels"),
        sets(F.concat("base", F.coalesce("met", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
    return without.unionByName(with_hits)


def op10_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _oracle() -> str:
    quote = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    places = []
    for label, phrase in PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(f"list_filter(range(len(w)), lambda i: coalesce({test}, false))")
    shares = []
    for _, text, required, excluded in TEMPLATES:
        words, block = quote(sorted(set(text.split()))), f"w[i + 1:i + {_width(text, THRESHOLD)}]"
        told = f"list_has_all({block}, {quote(required)})" + (f" AND NOT list_has_any({block}, {quote(excluded)})" if excluded else "")
        shares.append(f"CASE WHEN len(list_intersect(seen, {words})) >= {_needed(set(text.split()), THRESHOLD)} THEN "
                      f"list_max(list_transform(range(len(w)), lambda i: CASE WHEN {told} THEN len(list_intersect({block}, {words})) END)) END")
    sizes = [len(set(t.split())) for _, t, *_ in TEMPLATES]
    met = [f"CASE WHEN m{k} >= {_needed(set(t.split()), THRESHOLD)} THEN '{label}' END" for k, (label, t, *_) in enumerate(TEMPLATES)]
    part = [f"CASE WHEN m{k} >= {_needed(set(t.split()), THRESHOLD)} THEN CAST(m{k} AS DOUBLE) / {sizes[k]} END" for k, (_, t, *_) in enumerate(TEMPLATES)]
    base = [f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (label, _) in enumerate(PHRASES)]
    join = lambda xs: f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))), ',')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS w, list_distinct(regexp_extract_all(t, '{word}')) AS seen FROM d),
p AS (SELECT doc_id, len(w) AS n, {', '.join(f'{x} AS p{i}' for i, x in enumerate(places))},
             {', '.join(f'{x} AS m{k}' for k, x in enumerate(shares))} FROM w),
q AS (SELECT *, list_concat(list_concat(p0, p1), p2) AS every FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base,
       CAST(list_min(every) AS BIGINT) AS first_word, CAST(list_max(every) AS BIGINT) AS last_word,
       {join(base)} AS base_labels, {join(base + met)} AS labels,
       CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(greatest({', '.join(part)}), 0.0::DOUBLE) END AS score
FROM q
"""


OP10_SQL = _oracle()
