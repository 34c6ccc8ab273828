"""Licence scan as an exact set-similarity join, in built-in functions only.

Every licence notice (template) is a set of words, and so is every block of a
text: blocks are windows of words, each starting in the middle of the one
before, so that a notice of up to half a block stands whole in one. The join
finds every (block, template) with a containment |both| / |template| of at
least ``containment``; nothing is sampled or approximated.

* The words of templates are ordered by their frequency over all documents,
  rare first. A block that reaches ``need`` words of a template holds one of
  the template's first ``size - need + 1`` words (prefix filter). Only these
  words enter the join; texts that do not even hold ``need`` words of any
  template are not cut into blocks.
* A block with fewer template words than ``need`` is no candidate (length
  filter).
* A candidate that first meets at place i of the template and j of the block,
  both in that order, can share 1 + min(rest of the template, rest of the
  block) words at most (positional filter).
* What is left is compared whole.

The phrase search beside it (labels that hold in any case) reads the same
words. Templates are a parameter, a few hundred words at any input size: they
are the broadcast side. Rows of a text come from one task, so they are one row
again before the only shuffle, which carries no text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: A word, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACES = "array<struct<start:int,label:string>>"
#: What stands between words of a lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_PLACES = "array<struct<start:int,label:string>>"
#: One character of a word before lower-casing, and one between words.
ANY_WORD, GAP = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of a template's words, in hundredths, that a block must hold.
CONTAINMENT = 90

#: Phrases whose words, standing consecutively, give a label.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Licence notices, by label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at apache"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial license"),
    ("cc-by-sa", "creative commons attribution sharealike license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]                                     # distinct, in the global order
    need: int                                                  # words that a block must share

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[:len(self.words) - self.need + 1]


def _words() -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _read(docs: DataFrame, phrases, sets: list[Template]) -> DataFrame:
    """``row, doc_id, n_words, present, text`` of every row, stored: the words
    of templates and phrases that the text holds, and the text itself where
    these can make up a template or a phrase. One pass over all texts."""
    known = _texts(sorted({w for t in sets for w in t.words} | {w for p, _ in phrases for w in p.split()}))
    # lower() also changes other letters; that parts no word and can only add to what is present
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.split(F.lower(F.coalesce("text", F.lit(""))), GAP + "+").alias("w"))
    ends = F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0) + F.when(F.element_at("w", -1) == "", 1).otherwise(0)
    rows = rows.select("doc_id", "text", F.greatest(F.size("w") - ends, F.lit(0)).cast("long").alias("n_words"),
                       F.array_intersect("w", known).alias("present"))
    shared = lambda words: F.size(F.array_intersect("present", _texts(words)))
    can = [shared(t.words) >= t.need for t in sets] + [shared(p.split()) == len(set(p.split())) for p, _ in phrases]
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "present",
                              F.when(reduce(or_, can, F.lit(False)), F.col("text")).alias("text")), "licence-rows")


def word_order(rows: DataFrame, templates) -> list[str]:
    """The global order of the templates' words: by the number of documents
    that hold them (``present``), rare first, then by the word. An aggregate
    with a row for each word."""
    held = rows.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    count = {r["word"]: r["n"] for r in held.collect()}
    return sorted({w for _, notice in templates for w in notice.split()}, key=lambda w: (count.get(w, 0), w))


def in_order(templates, order: list[str], containment: int) -> list[Template]:
    place = {w: i for i, w in enumerate(order)}
    sets = [(label, sorted(set(notice.split()), key=place.__getitem__)) for label, notice in templates]
    return [Template(label, tuple(w), max(1, ceil(len(w) * containment / 100))) for label, w in sets if w]


def _places_of(phrase: str, label: str) -> Column:
    """Array of (start, label) of all places where the phrase's words stand
    consecutively; looked for only in texts that have all its words."""
    p = phrase.split()

    def here(i):
        ok = F.get("words", i + (len(p) - 1)) == p[-1]         # the last word is the one that names the licence
        for k, w in enumerate(p[:-1]):
            ok = ok & (F.get("words", i + k) == w)
        return ok

    starts = F.filter(F.sequence(F.lit(0), F.size("words") - len(p)), here)
    holds = (F.size("words") >= len(p)) & (F.size(F.array_intersect("words", _texts(p))) == len(set(p)))
    return F.when(holds, F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))).otherwise(
        F.array().cast(_PLACES))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, containment: int = CONTAINMENT) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score`` and ``blocks`` (label, containment, start and
    end word of every block that reaches a template).

    NULL and empty texts have no words and no labels. Repeated rows (also of
    one doc_id) and rows without a doc_id are scanned one by one. Texts are
    read whole at any length. A word said twice in a block counts once; blocks
    that tie are all reported. Without templates only phrases are looked for.
    Extra columns are not read; an empty table gives no rows.

    ``score`` is the largest containment found, 1 where a phrase stands, else 0.
    """
    rows = _read(docs, phrases, in_order(templates, sorted({w for _, n in templates for w in n.split()}), containment))
    order = word_order(rows, templates)
    ordered = in_order(templates, order, containment)
    known, leads = _texts(order), _texts({w for t in ordered for w in t.prefix})
    half = max([len(notice.split()) for _, notice in templates], default=1)

    rows = rows.select("row", "doc_id", "n_words", F.when(F.col("text").isNotNull(), _words()).otherwise(_texts([])).alias("words"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - half - 1, F.lit(0)), F.lit(half)),
                      lambda s: F.struct(s.alias("at"), F.slice("words", s + 1, 2 * half).alias("block")))
    blocks = F.filter(cut, lambda b: F.arrays_overlap(b["block"], leads))
    rows = rows.select("row", "doc_id", "n_words",
                       F.concat(F.array().cast(_PLACES), *[_places_of(p, label) for p, label in phrases]).alias("places"),
                       F.when(F.arrays_overlap("words", leads), blocks).alias("cut"))
    # rows of a text come from one task, so they are one again before the shuffle
    each = rows.select("row", "doc_id", "n_words", "places", F.explode_outer("cut").alias("b")) \
               .select("row", "doc_id", "n_words", "places", "b.at", F.least(F.col("b.at") + 2 * half, F.col("n_words")).alias("end"),
                       F.array_intersect("b.block", known).alias("own"))
    met = _joined(each, ordered, order)
    found = met.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("places").alias("places"),
        F.max("containment").alias("best"),
        F.collect_set(F.when(F.col("containment").isNotNull(), F.struct("label", "containment", F.col("at").alias("start"), "end"))).alias("blocks"))
    starts, base = F.col("places.start"), F.col("places.label")
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), listed(base).alias("base_labels"),
        listed(F.concat(base, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.array_sort("blocks").alias("blocks"))


def _joined(each: DataFrame, ordered: list[Template], order: list[str]) -> DataFrame:
    """Rows of ``each`` (with ``own``: a block's template words) with the
    templates they reach: ``label, containment``; NULL where none."""
    if not ordered:
        return each.withColumns({"label": F.lit(None).cast("string"), "containment": F.lit(None).cast("double")})
    place = F.create_map(*[x for i, w in enumerate(order) for x in (F.lit(w), F.lit(i))])
    lists = [(i, t.label, list(t.words), t.need, k, w) for i, t in enumerate(ordered) for k, w in enumerate(t.prefix)]
    index = each.sparkSession.createDataFrame(lists, "template int, label string, wanted array<string>, need int, i int, word string")
    sorted_own = F.transform(F.array_sort(F.transform("own", lambda w: F.struct(place[w].alias("p"), w.alias("w")))), lambda s: s["w"])
    probe = each.withColumn("own", sorted_own)
    probe = probe.select(*probe.columns, F.posexplode_outer("own").alias("j", "word"))
    size = F.size("own")
    pairs = (probe.join(F.broadcast(index), "word", "left")
             .withColumn("fits", (size >= F.col("need"))
                         & (1 + F.least(F.size("wanted") - F.col("i") - 1, size - F.col("j") - 1) >= F.col("need"))))
    both = F.size(F.array_intersect("own", "wanted"))
    share = F.when(F.col("fits") & (both >= F.col("need")), both / F.size("wanted"))
    return pairs.withColumn("containment", share).withColumn("label", F.when(F.col("containment").isNotNull(), F.col("label")))


def op11(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("blocks")


OP11_SQL = """
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
phrases(label, p) AS (VALUES
  ('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])),
base AS (
  SELECT r, i, label FROM (SELECT r, label, p, w, unnest(range(1, len(w) - len(p) + 2)) AS i FROM w, phrases WHERE len(w) >= len(p))
  WHERE w[i:i + len(p) - 1] = p),
b AS (SELECT r, count(*) AS n, min(i) - 1 AS lo, max(i) - 1 AS hi FROM base GROUP BY 1),
notices(label, t) AS (VALUES
  ('mit', 'released under the mit license'),
  ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
  ('apache-2', 'licensed under the apache license version 2 0'),
  ('apache-2', 'you may not use this file except in compliance with the license you may obtain a copy of the license at apache'),
  ('cc-by-nc', 'licensed under cc by nc 4 0'),
  ('cc-by-nc', 'creative commons attribution noncommercial license'),
  ('cc-by-sa', 'creative commons attribution sharealike license'),
  ('gpl-2', 'licensed under the gnu general public license version 2'),
  ('gpl-3', 'licensed under the gnu general public license version 3'),
  ('lgpl', 'gnu lesser general public license'),
  ('agpl', 'gnu affero general public license'),
  ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that'),
  ('mpl-2', 'subject to the terms of the mozilla public license v 2 0'),
  ('isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted')),
t AS (SELECT label, list_distinct(string_split(t, ' ')) AS t FROM notices),
half AS (SELECT max(len(string_split(t, ' '))) AS h FROM notices),
blocks AS (
  SELECT r, list_distinct(w[s + 1:s + 2 * h]) AS block
  FROM (SELECT r, w, h, unnest(range(0, greatest(len(w) - h - 1, 0) + 1, h)) AS s FROM w, half)),
hit AS (
  SELECT r, label, c FROM (SELECT r, label, len(list_intersect(block, t)) / len(t) AS c, len(list_intersect(block, t)) AS shared, len(t) AS size
                           FROM blocks, t) WHERE 100 * shared >= 90 * size),
labels AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM base UNION SELECT r, label FROM hit) GROUP BY 1),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM base) GROUP BY 1),
best AS (SELECT r, max(c) AS c FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
       CAST(hi AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN coalesce(n, 0) > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN bl USING (r) LEFT JOIN labels USING (r) LEFT JOIN best USING (r)
"""
