"""License scan by diagonal voting, in DataFrame functions only.

Every template (a short phrase or the wording of a license notice) and every
document is a sequence of words.  All rolling grams of ``KEY_WORDS`` words of
the documents are joined by hash with the grams of the templates; notices ask
for one more equal word, and the words themselves are compared.  A match of
the document's word ``p`` with the template's word ``q`` is a vote for the
diagonal ``p - q``, the place where the template would start.  Votes are
counted per diagonal; neighbouring diagonals of one notice (words added or
left out move the rest to the next ones) merge into one span; a span counts
when its votes cover enough of the template: all of a phrase, on one
diagonal, or ``LEAST_COVER`` of a notice.

Texts are read once.  Only the matches and one row per text go on, as a stored
table; they are grouped by a number of the row given before that, so rows that
repeat or lack an id stay apart.  The template grams are broadcast while the
templates hold at most ``BROADCAST_WORDS`` words.

Edge cases: a null text is empty, has no words, no labels and score 0; a text
of over ``PIECE`` characters is read in pieces which own the words that start
in them and see the words that follow, so nothing is lost at a cut; equal and
repeated rows give equal results, a row each; grams that stand in several
templates vote for each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.common import stored

WORD_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP_CHARS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY_WORDS = 2
NOTICE_WORDS = 3
#: Share of a notice's words that a span must cover.
LEAST_COVER = 0.6
#: Diagonals of a notice at most this far apart belong to one span.
SHIFT = 8
PIECE = 1 << 20
BROADCAST_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    kind: str  # "base" or "phrase": every word, in a row; "notice": most words


# The phrases and labels that the contract names.
BASE = [Template("mit", "mit license", "base"), Template("apache", "apache license", "base"),
        Template("gpl", "general public license", "base")]

# Names of further licenses, and the usual notices.
FURTHER = [
    Template("bsd", "bsd license", "phrase"),
    Template("cc", "creative commons", "phrase"),
    Template("cc", "cc by", "phrase"),
    Template("mpl", "mozilla public license", "phrase"),
    Template("isc", "isc license", "phrase"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files, to deal in the software without restriction", "notice"),
    Template("apache", "Unless required by applicable law or agreed to in writing, software distributed under the license "
             "is distributed on an as is basis, without warranties or conditions of any kind", "notice"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation", "notice"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", "notice"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted", "notice"),
    Template("mpl", "This source code form is subject to the terms of the Mozilla Public License", "notice"),
    Template("unlicense", "This is free and unencumbered software released into the public domain", "notice"),
]
TEMPLATES = BASE + FURTHER


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(text: Column) -> Column:
    """The words of a lower-cased text."""
    return F.regexp_extract_all(text, F.lit(WORD_CHARS + "+"), F.lit(0))


def _grams(words: Column) -> Column:
    """Each word with the ones that follow it (null past the end)."""
    after = [F.slice(words, k + 1, F.greatest(F.size(words), F.lit(1))) for k in range(1, NOTICE_WORDS)]
    return F.arrays_zip(words.alias("w0"), *[a.alias(f"w{k}") for k, a in enumerate(after, 1)])


def _key(gram: str) -> Column:
    return F.xxhash64(*[F.col(f"{gram}.w{k}") for k in range(KEY_WORDS)])


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """template, label, kind, t_len and the grams with their positions."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.kind).alias("kind"),
                              F.lit(t.text).alias("text")) for i, t in enumerate(templates)])
    named = spark.range(1).select(F.explode(rows).alias("t")).select("t.*").withColumn("w", _words(_lowered(F.col("text"))))
    grams = named.select("template", "label", "kind", F.size("w").alias("t_len"),
                         F.posexplode(_grams(F.col("w"))).alias("t_pos", "t_gram"))
    asks = F.when(F.col("kind") == "notice", NOTICE_WORDS).otherwise(KEY_WORDS)
    return grams.where(F.col("t_pos") + asks <= F.col("t_len")).withColumn("t_key", _key("t_gram"))


def matches(docs: DataFrame, templates: list[Template] = TEMPLATES, piece: int = PIECE) -> DataFrame:
    """Stored votes: _row, doc_id, piece, n_own, pos, and the template's gram
    there; a row whose ``template`` is null stands for its piece alone."""
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    if sum(len(t.text.split()) for t in templates) <= BROADCAST_WORDS:
        grams = F.broadcast(grams)

    text = _lowered(F.coalesce(F.col("text"), F.lit("")))
    size = F.length("_text")
    last = F.greatest(F.ceil(size / piece) - 1, F.lit(0)).cast("int")
    cut = (docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", text.alias("_text"))
           .select("*", last.alias("_last")).select("*", F.explode(F.sequence(F.lit(0), "_last")).alias("piece")))
    at = F.col("piece") * piece
    one = F.col("_last") == 0
    body = F.when(one, F.col("_text")).otherwise(F.substring("_text", at + 1, F.lit(piece)))
    inside = (F.col("piece") > 0) & F.substring("_text", at, F.lit(1)).rlike(WORD_CHARS)
    body = F.when(inside, F.regexp_replace(body, f"^{WORD_CHARS}++", "")).otherwise(body)
    # The rest of the last word and the words that its grams need.
    follow = f"^{WORD_CHARS}*+(?:{GAP_CHARS}++{WORD_CHARS}++){{0,{NOTICE_WORDS - 1}}}"
    rest = F.substring("_text", at + piece + 1, size)
    head = F.when(F.col("piece") < F.col("_last"), F.regexp_extract(rest, follow, 0)).otherwise("")
    own = cut.select("_row", "doc_id", "piece", "_last", body.alias("_body"), head.alias("_head"))
    split = own.select("_row", "doc_id", "piece", "_last", "_body",
                       _words(F.when(one, F.col("_body")).otherwise(F.concat("_body", "_head"))).alias("_w"))
    n_own = F.when(one, F.size("_w")).otherwise(F.size(_words(F.col("_body"))))
    rolled = (split.select("_row", "doc_id", "piece", n_own.alias("n_own"), "_w")
              .select("_row", "doc_id", "piece", "n_own", F.posexplode_outer(_grams(F.col("_w"))).alias("pos", "gram")))
    same = F.col("_k") == F.col("t_key")
    for k in range(KEY_WORDS):
        same &= F.col(f"gram.w{k}") == F.col(f"t_gram.w{k}")
    for k in range(KEY_WORDS, NOTICE_WORDS):
        same &= (F.col("kind") != "notice") | (F.col(f"gram.w{k}") == F.col(f"t_gram.w{k}"))
    same &= F.col("pos") < F.col("n_own")
    voted = (rolled.withColumn("_k", _key("gram")).join(grams, same, "left")
             .where(F.col("template").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)))
    return stored(voted.select("_row", "doc_id", "piece", F.col("n_own").cast("long").alias("n_own"),
                               F.col("pos").cast("long").alias("pos"), "template", "label", "kind", "t_len",
                               "t_pos"), "license-votes")


def _texts(votes: DataFrame) -> DataFrame:
    """One row per text: its words, and the words of each of its pieces."""
    heads = votes.where(F.coalesce("pos", F.lit(0)) == 0)
    return (heads.groupBy("_row", "doc_id").agg(F.collect_set(F.struct("piece", "n_own")).alias("_pieces"))
            .withColumn("n_words", F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, x: a + x.n_own)))


def spans(votes: DataFrame, least_cover: float = LEAST_COVER, shift: int = SHIFT) -> DataFrame:
    """_row, doc_id, label, kind, template, first_word, last_word, cover: the
    verified places of the templates.  Positions count words of the text."""
    texts = _texts(votes).select("_row", "_pieces")
    earlier = F.aggregate(F.filter("_pieces", lambda x: x.piece < F.col("piece")), F.lit(0).cast("long"),
                          lambda a, x: a + x.n_own)
    whole = (votes.where("template is not null").join(texts, "_row")
             .withColumn("diagonal", F.col("pos") + earlier - F.col("t_pos")))
    # A diagonal has at most one vote per word of its template.
    diagonals = whole.groupBy("_row", "doc_id", "template", "label", "kind", "t_len", "diagonal").agg(
        F.collect_set("t_pos").alias("at"))
    exact = diagonals.where((F.col("kind") != "notice") & (F.size("at") == F.col("t_len") - (KEY_WORDS - 1)))
    exact = exact.select("_row", "doc_id", "label", "kind", "template", F.col("diagonal").alias("first_word"),
                         (F.col("diagonal") + F.col("t_len") - 1).alias("last_word"), F.lit(1.0).alias("cover"))

    order = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > shift, F.lit(True))
    numbered = (diagonals.where("kind = 'notice'").select("*", apart.cast("int").alias("_new"))
                .withColumn("_span", F.sum("_new").over(order)))
    merged = numbered.groupBy("_row", "doc_id", "template", "label", "kind", "t_len", "_span").agg(
        F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("at") + NOTICE_WORDS - 1).alias("last_word"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + NOTICE_WORDS - 1)))))
    close = (merged.withColumn("cover", covered / F.col("t_len")).where(F.col("cover") >= least_cover)
             .select("_row", "doc_id", "label", "kind", "template", "first_word", "last_word", "cover"))
    return exact.unionByName(close)


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, piece: int = PIECE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word
    (of the base phrases), base_labels, labels, score, and ``spans``, the
    number of all verified places.  score is the largest cover of a span."""
    votes = matches(docs, templates, piece)
    base = F.col("kind") == "base"
    found = spans(votes).groupBy("_row").agg(
        F.count(F.lit(1)).alias("spans"), F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"), F.max("cover").alias("score"))

    def joined(name: str) -> Column:
        return F.coalesce(F.array_join(F.array_sort(name), ","), F.lit("")).alias(name)

    return _texts(votes).join(found, "_row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        joined("base_labels"), joined("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", F.lit(0).cast("long")).alias("spans"))
