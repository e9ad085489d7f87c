"""License scans by diagonal voting, in DataFrame functions.

Every rolling pair of words of a document is joined with the same pairs of the templates. A
match votes for its diagonal, the document's position minus the template's. Votes are counted
per diagonal, and neighbouring diagonals are chained into spans as long as the gaps between
them are small, so that a word put in or left out does not part a passage. A span is verified:
it has to cover enough of the template's pairs, and all of its telling ones, the pairs that no
similar template has, such as the one with the version. A phrase of the base list needs all its
pairs on one diagonal.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that add labels of their own; a parameter of ``scan``.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "released under the mit license": "mit-notice",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files": "mit-text",
    "redistribution and use in source and binary forms with or without modification are"
    " permitted provided that the following conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or"
    " without fee is hereby granted": "isc-text",
    "this program is free software you can redistribute it and or modify it under the terms of"
    " the gnu general public license as published by the free software foundation": "gpl-text",
}
K = 2
#: Most diagonals between two that are chained, the share of a template's pairs that a span
#: must cover, and the share of its pairs that another template has if the two are similar.
GAP, COVER, SIMILAR = 4, 0.8, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    text = F.coalesce(text, F.lit(""))
    # for ASCII both are the same, and lower() is the faster
    small = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))
    parts = F.split(small, SEPARATORS)
    n = F.size(parts)
    first = F.when(parts[0] == "", 2).otherwise(1)
    last = F.when((n > 1) & (F.element_at(parts, -1) == ""), n - 1).otherwise(n)
    return F.slice(parts, first, F.greatest(last - first + 1, F.lit(0)))


def _pairs(text: str) -> list[str]:
    parts = text.split(" ")
    return [" ".join(parts[i:i + K]) for i in range(len(parts) - K + 1)]


def telling(text: str, templates: Iterable[str]) -> list[int]:
    """Positions of the pairs that set a template apart from all similar ones."""
    own = _pairs(text)
    others = [set(_pairs(t)) for t in templates if t != text]
    alike = [o for o in others if sum(p in o for p in own) >= SIMILAR * len(own)]
    known = set().union(*alike)
    return [i for i, p in enumerate(own) if alike and p not in known]


def _grams(templates: dict[str, str], exact: bool) -> list[tuple]:
    """(template, label, exact, pairs, telling, position, pair) of each template's word pairs;
    ``telling`` are the positions that a span needs."""
    rows = []
    for text, label in templates.items():
        pairs = _pairs(text)
        needed = [] if exact else telling(text, templates)
        rows += [(text, label, exact, len(pairs), needed, i, p) for i, p in enumerate(pairs)]
    return rows


def votes(docs: DataFrame, notices: dict[str, str]) -> DataFrame:
    """(doc, doc_id, n_words, template, label, exact, pairs, telling, at, position): every match of a
    document's word pair with a template's, and one row without a template per document.

    ``doc`` numbers the rows, so repeated ids are kept apart. The template table comes from
    the arguments and is a few hundred rows, whatever the data, so it is broadcast.
    """
    spark = docs.sparkSession
    grams = spark.createDataFrame(
        _grams(PHRASES, True) + _grams(notices, False),
        "template string, label string, exact boolean, pairs int, telling array<int>, position int, "
        "pair string",
    ).withColumn("hash", F.xxhash64("pair"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"), "doc_id", words(F.col("text")).alias("w"))
    n = F.size("w")
    placed = rows.select(
        "doc", "doc_id", n.cast("long").alias("n_words"), "w",
        F.posexplode_outer("w").alias("at", "word"))
    pair = F.concat_ws(" ", F.col("word"), F.get("w", F.col("at") + 1))
    hashed = placed.select("doc", "doc_id", "n_words", "at", pair.alias("seen")).withColumn(
        "hash", F.xxhash64("seen"))
    met = hashed.join(F.broadcast(grams), "hash", "left").where(
        "pair = seen or at is null or at = 0")
    match = F.col("pair") == F.col("seen")
    return met.select(
        "doc", "doc_id", "n_words", "at",
        *[F.when(match, F.col(c)).alias(c)
          for c in ("template", "label", "exact", "pairs", "telling", "position")])


def _chains(docs: DataFrame, notices: dict[str, str]) -> DataFrame:
    """(doc, doc_id, n_words, template, label, exact, pairs, telling, chain, met, cover, first,
    last): votes by chain of diagonals, and a row without a template for each document. The
    chain of a base phrase is its diagonal."""
    voted = votes(docs, notices).repartition("doc")
    keys = ["doc", "doc_id", "n_words", "template", "label", "exact", "pairs", "telling"]
    per_diagonal = voted.groupBy(
        *keys, (F.col("at") - F.col("position")).cast("long").alias("diagonal"),
    ).agg(F.collect_set("position").alias("met"), F.min("at").alias("first"),
          F.max("at").alias("last"))
    # a diagonal is a place, as a template is short; the rows are those of one document
    order = Window.partitionBy("doc", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, F.lit(False))
    chain = F.when(F.col("exact"), F.col("diagonal")).otherwise(
        F.sum(F.col("apart").cast("long")).over(order))
    met = F.array_distinct(F.flatten(F.collect_list("met")))
    return (
        per_diagonal.withColumn("apart", apart).withColumn("chain", chain)
        .groupBy(*keys, "chain")
        .agg(met.alias("met"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("cover", F.size("met") / F.col("pairs")))


def _found() -> tuple[Column, Column]:
    """Conditions on chains: a base phrase stands there; a span there is verified."""
    n = F.size("met")
    exact = F.col("exact") & (n == F.col("pairs"))
    told = F.size(F.array_except("telling", "met")) == 0
    return exact, exact | (~F.col("exact") & (n >= F.ceil(F.col("pairs") * COVER)) & told)


def spans(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(doc_id, label, exact, cover, first_word, last_word): verified spans of whole texts, in
    words from 0, the last one included. ``exact`` spans are base phrases. Null and empty texts
    have none, repeated rows repeat theirs, and an empty table gives an empty one."""
    return _chains(docs, notices).where(_found()[1]).select(
        "doc_id", "label", "exact", "cover", F.col("first").cast("long").alias("first_word"),
        (F.col("last") + K - 1).cast("long").alias("last_word"))


def labels(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best cover; 1 with a base phrase, 0 without any span).

    Null and empty texts have no words and no labels (empty strings). Repeated rows give
    repeated rows; null ids stay null. An empty table gives an empty one. Columns besides
    doc_id and text are not read.
    """
    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    exact, counts = _found()
    return _chains(docs, notices).groupBy("doc", "doc_id", "n_words").agg(
        F.count_if(exact).alias("n_base"),
        F.min(F.when(exact, F.col("chain"))).alias("first_word"),
        F.max(F.when(exact, F.col("chain"))).alias("last_word"),
        joined(exact).alias("base_labels"), joined(counts).alias("labels"),
        F.coalesce(F.max(F.when(counts, F.col("cover"))), F.lit(0.0)).alias("score"),
    ).drop("doc")


def _sql_templates() -> str:
    rows = _grams(PHRASES, True) + _grams(NOTICES, False)
    return ", ".join(f"('{t}', '{x}', {e}, {n}, {len(needed)}, {i in needed}, {i}, '{p}')"
                     for t, x, e, n, needed, i, p in rows)


ORACLE_SQL = rf"""
WITH grams(template, label, exact, pairs, needed, telling, position, pair) AS (
  VALUES {_sql_templates()}),
d AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (
  SELECT doc, unnest(range(len(w) - 1)) AS pos, unnest(list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM d),
v AS (
  SELECT doc, template, label, exact, pairs, needed, telling, position,
    pos - position AS diagonal
  FROM p JOIN grams USING (pair)),
g AS (
  SELECT *, CASE WHEN exact THEN diagonal ELSE count(*) FILTER (far) OVER (
    PARTITION BY doc, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) END AS chain
  FROM (SELECT *, diagonal - lag(diagonal) OVER (
    PARTITION BY doc, template ORDER BY diagonal) > {GAP} AS far FROM v)),
c AS (
  SELECT doc, template, label, exact, pairs, chain, count(DISTINCT position) AS n FROM g
  GROUP BY doc, template, label, exact, pairs, needed, chain
  HAVING CASE WHEN exact THEN n = pairs ELSE n >= ceil(pairs * {COVER})
    AND count(DISTINCT position) FILTER (telling) = needed END),
s AS (
  SELECT doc, count(*) FILTER (exact) AS n_base, min(chain) FILTER (exact) AS first_word,
    max(chain) FILTER (exact) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(n / pairs) AS score
  FROM c GROUP BY doc)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN s USING (doc)
"""
