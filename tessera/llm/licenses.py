"""License scans: TF-IDF cosine of lines and licence files to templates, then directory inheritance.

Every line of every whole text is compared with short licence templates, a
licence file (``LICENSE``, ``LICENCE``, ``COPYING``, any ending) also as a
whole. Terms are lower-cased words of letters and digits. Document frequencies
are counted over all files for all words: the most common ones go to the tasks,
the others are joined by word to the lines that could be a file's best. Only
terms shared with a template add to a product, so lines without any are not
looked at again.

A file's own licence is the template with the best cosine of at least
``THRESHOLD`` (ties: the name that sorts first). A file without one inherits from the nearest
directory at or above its own that holds a licence file: its path is joined,
once per ancestor, with the directories' licences.

Defined cases: null and empty texts have no licence of their own; a null path
inherits nothing; several licence files of a directory: the best score, then
the name that sorts first; repeated rows are rows of their own; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, materialize, table

# templates: the notice each licence asks for or is commonly referred to by
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}
THRESHOLD = 0.7
COMMON = 100_000  # words whose document frequencies the tasks hold; those of rarer words come by a join
OPEN = "array<struct<rank int, dot double, total double, words array<struct<word binary, tf int>>>>"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying)(\.[^/]*)?$"


class Templates:
    """Vocabulary, weights and unit vectors of a set of templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        words = W.split_words(pa.array([templates[n] for n in self.names], pa.string()), W.NOT_ALNUM, lower=True)
        codes, distinct = words.distinct()
        self.terms = {t: i for i, t in enumerate(distinct)}
        self.counts = np.zeros((len(self.names), len(distinct)))
        np.add.at(self.counts, (words.text_of_word(), codes), 1)

    def weigh(self, frequency: dict[bytes, int], n_files: int, rest: tuple[int, int] = (0, 0)) -> None:
        """``rest``: least and most files that hold a word which ``frequency`` does not name."""
        def idf(df):
            return np.log((1 + n_files) / (1 + np.asarray(df, dtype=np.float64))) + 1

        self.words = dict(zip(frequency, idf(list(frequency.values())).tolist()))
        self.most, self.least = float(idf(rest[0])), float(idf(rest[1]))
        own = self.counts * idf([frequency.get(t, 0) for t in self.terms])
        self.unit = own / np.maximum(np.sqrt((own ** 2).sum(axis=1)), 1e-300)[:, None]

    def compare(self, texts: pa.Array) -> Spans:
        """The texts that share a term with a template, each with its best template."""
        words = W.split_words(texts, W.NOT_ALNUM, lower=True)
        codes, distinct = words.distinct()
        n = len(distinct)
        known = np.fromiter((self.terms.get(w, -1) for w in distinct), np.int64, n)
        idf = np.fromiter((self.words.get(w, np.nan) for w in distinct), np.float64, n)
        if self.least == self.most:
            idf[np.isnan(idf)] = self.most
        text = words.text_of_word()
        some = np.unique(text[known[codes] >= 0]) if n else np.empty(0, np.int64)
        place = np.full(len(words.bounds), -1, np.int64)
        place[some] = np.arange(len(some))
        keep = place[text] >= 0
        key, tf = np.unique(place[text[keep]] * max(n, 1) + codes[keep], return_counts=True)
        row, code = key // max(n, 1), key % max(n, 1)
        weight = tf * idf[code]
        open_ = np.isnan(weight)
        at = np.flatnonzero(known[code] >= 0)
        best, dot = np.zeros(len(some), np.int64), np.zeros(len(some))
        for i, unit in enumerate(self.unit):
            product = np.bincount(row[at], weights=weight[at] * unit[known[code[at]]], minlength=len(some))
            best[product > dot] = i
            np.maximum(dot, product, out=dot)
        total = np.bincount(row, weights=np.where(open_, 0, weight) ** 2, minlength=len(some))
        rest = np.bincount(row[open_], weights=tf[open_].astype(np.float64) ** 2, minlength=len(some))
        return Spans(some, best, dot, total, rest, row[open_], tf[open_], [distinct[c] for c in code[open_]])


class Spans(NamedTuple):
    """Compared texts: place, best template, product with it, norm without open words, squares of the open words' counts.

    Open words are those of unknown document frequency: (span, count, word).
    """

    at: np.ndarray
    template: np.ndarray
    dot: np.ndarray
    total: np.ndarray
    rest: np.ndarray
    open_span: np.ndarray
    open_tf: np.ndarray
    open_word: list[bytes]


def word_frequency(files: DataFrame) -> DataFrame:
    """(word, n): in how many files each word stands; the empty word has the number of files."""
    bounded_batches(files.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                words = W.split_words(part.column("text"), W.NOT_ALNUM, lower=True)
                codes, distinct = words.distinct()
                size = max(len(distinct), 1)
                pairs = np.unique(words.text_of_word() * size + codes)
                n = np.bincount(pairs % size, minlength=len(distinct))[:len(distinct)]
                yield pa.RecordBatch.from_arrays([pa.array([*distinct, b""], pa.binary()),
                                                  pa.array([*n.tolist(), part.num_rows], pa.int64())], names=["word", "n"])

    return materialize(files.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "word binary, n long")
                       .groupBy("word").agg(F.sum("n").alias("n")))


def own_licenses(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                 all_words: bool = False, common: int = COMMON) -> DataFrame:
    """``files`` (doc_id, path, text) as (doc_id, path, is_licence_file, own_license, score).

    ``all_words``: every word has its own document frequency; otherwise only
    the templates' words have, any other that of a word no file holds.
    """
    model = Templates(templates or TEMPLATES)
    frequency = word_frequency(files)
    is_term = F.col("word").isin([bytearray(t) for t in [*model.terms, b""]])
    named = {bytes(r["word"]): int(r["n"]) for r in frequency.where(is_term).collect()}  # as many as template terms
    n_files, rest = named.pop(b"", 0), (0, 0)
    if all_words:
        top = frequency.where(F.col("word") != F.lit(b"")).orderBy(F.desc("n"), "word").limit(common + 1).collect()
        if len(top) > common:
            rest = (1, int(top.pop()["n"]))
        named |= {bytes(r["word"]): int(r["n"]) for r in top}
    model.weigh(named, n_files, rest)
    is_file = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    rows = (files.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("path").cast("string").alias("path"), is_file.alias("is_licence_file"),
                         F.col("text").cast("string").alias("text")))
    scored = rows.mapInArrow(_scorer(model), f"row long, doc_id long, path string, is_licence_file boolean, "
                             f"best struct<score double, rank int>, open {OPEN}")
    if model.least != model.most:
        scored = materialize(scored)
        idf = F.log((1 + F.lit(n_files)) / (1 + F.col("n"))) + 1
        spans = (scored.select("row", F.posexplode("open").alias("span", "o")).select("row", "span", "o.*")
                 .select("row", "span", "rank", "dot", "total", F.explode("words").alias("w"))
                 .select("row", "span", "rank", "dot", "total", "w.tf", "w.word").join(frequency, "word")
                 .groupBy("row", "span", "rank", "dot", "total").agg(F.sum((F.col("tf") * idf) ** 2).alias("more")))
        settled = (spans.select(F.col("row"), F.struct((F.col("dot") / F.sqrt(F.col("total") + F.col("more"))).alias("score"),
                                                       "rank").alias("late"))
                   .groupBy("row").agg(F.max("late").alias("late")))
        scored = scored.join(settled, "row", "left").withColumn("best", F.greatest("best", "late"))
    name = F.element_at(F.array(*[F.lit(n) for n in model.names]), 1 - F.col("best.rank"))
    return scored.select("doc_id", "path", "is_licence_file",
                         F.when(F.col("best.score") >= threshold, name).alias("own_license"),
                         F.col("best.score").alias("score"))


def _scorer(model: Templates):
    """The best cosine that is known of each file, and the spans with open words that could be better.

    A span's cosine lies between those with every open word as frequent and as
    rare as such words can be. Spans whose upper bound is below another's lower
    bound are done with; the others' open words are looked up by a join.
    ``rank`` is minus the template's number, so the greatest (score, rank) has the name that sorts first.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                texts = pc.fill_null(part.column("text").cast(pa.large_string()), "")
                lines = pc.split_pattern(texts, "\n")
                found = [(pc.list_parent_indices(lines).to_numpy(), model.compare(lines.flatten()))]
                whole = np.flatnonzero(part.column("is_licence_file").to_numpy(zero_copy_only=False))
                if len(whole):
                    found.append((whole, model.compare(texts.take(pa.array(whole)))))
                owner = np.concatenate([of[s.at] for of, s in found])
                template, dot, total, rest = (np.concatenate([s[i] for _, s in found]) for i in range(1, 5))
                low, high = (dot / np.sqrt(total + rest * w ** 2) for w in (model.most, model.least))
                least = np.zeros(part.num_rows)
                np.maximum.at(least, owner, low)
                score, rank = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int32)
                done = np.flatnonzero(rest == 0)
                by = done[np.lexsort((-template[done], low[done], owner[done]))]
                score[owner[by]], rank[owner[by]] = low[by], -template[by]  # the last of an owner is its best
                wait = np.flatnonzero((rest > 0) & (high >= least[owner] * (1 - 1e-9)))
                span = np.concatenate([s.open_span + k for (_, s), k in zip(found, [0, len(found[0][1].at)])])
                words = [w for _, s in found for w in s.open_word]
                tf = np.concatenate([s.open_tf for _, s in found])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "doc_id", "path", "is_licence_file")),
                     pa.StructArray.from_arrays([pa.array(score), pa.array(rank)], ["score", "rank"]),
                     _open_spans(part.num_rows, owner, wait, template, dot, total, span, tf, words)],
                    names=["row", "doc_id", "path", "is_licence_file", "best", "open"])

    return work


def _open_spans(n, owner, wait, template, dot, total, span, tf, words) -> pa.Array:
    """Per file the spans ``wait`` as Arrow lists (type ``OPEN``)."""
    wait = wait[np.argsort(owner[wait], kind="stable")]
    place = np.full(len(owner), -1, np.int64)
    place[wait] = np.arange(len(wait))
    mine = np.flatnonzero(place[span] >= 0)
    mine = mine[np.argsort(place[span[mine]], kind="stable")]
    entries = pa.StructArray.from_arrays([pa.array([words[i] for i in mine], pa.binary()),
                                          pa.array(tf[mine].astype(np.int32))], ["word", "tf"])
    inner = np.searchsorted(place[span[mine]], np.arange(len(wait) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(-template[wait].astype(np.int32)), pa.array(dot[wait]), pa.array(total[wait]),
         pa.ListArray.from_arrays(pa.array(inner), entries)], ["rank", "dot", "total", "words"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[wait], np.arange(n + 1)).astype(np.int32)), spans)


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, the root ("") last but not least."""
    parts = F.split(directory, "/")
    steps = F.sequence(F.lit(0), F.when(directory == "", 0).otherwise(F.size(parts)))
    return F.transform(steps, lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))


def scan_licenses(files: DataFrame, templates: dict[str, str] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, own_license, score, license, licensed_by): licensed_by is the directory inherited from."""
    own = materialize(own_licenses(files, templates, threshold, all_words=True))
    held = (own.where("is_licence_file and own_license is not null")
            .groupBy(_directory(F.col("path")).alias("dir"))
            .agg(F.min(F.struct((-F.col("score")).alias("s"), "own_license")).alias("b"))
            .select("dir", F.col("b.own_license").alias("dir_license")))
    # one row per directory and ancestor, not per file
    above = (own.where("path is not null").select(_directory(F.col("path")).alias("own_dir")).distinct()
             .select("own_dir", F.explode(_ancestors(F.col("own_dir"))).alias("a"))
             .select("own_dir", "a.depth", "a.dir").join(held, "dir")
             .groupBy("own_dir").agg(F.max(F.struct("depth", "dir", "dir_license")).alias("near"))
             .select("own_dir", F.col("near.dir").alias("dir"), F.col("near.dir_license").alias("dir_license")))
    with_dir = own.withColumn("own_dir", F.when(F.col("own_license").isNull(), _directory(F.col("path"))))
    return (with_dir.join(above, "own_dir", "left")
            .select("doc_id", "path", "own_license", F.round("score", 6).alias("score"),
                    F.coalesce("own_license", "dir_license").alias("license"),
                    F.when(F.col("own_license").isNull(), F.col("dir")).alias("licensed_by")))


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as files source/lang/block/name: one in 64 is its block's LICENSE, one in 4096 its language's."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    block = F.concat_ws("/", top, F.floor(F.col("doc_id") / 64).cast("string"))
    path = (F.when(F.col("doc_id") % 4096 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
            .when(F.col("doc_id") % 64 == 0, F.concat_ws("/", block, F.lit("LICENSE")))
            .when(F.col("doc_id").isNotNull(), F.concat_ws("/", block, F.concat(F.col("doc_id").cast("string"),
                                                                               F.lit(".txt")))))
    return docs.select("doc_id", path.alias("path"), "text")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(document_files(table(spark, sf_dir, "documents")))
