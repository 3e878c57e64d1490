"""Benchmark decontamination over a stored positional inverted index.

The index is a table of (term, slice of documents, positions), written to the shared scratch folder in buckets by term; a
slice is a run of documents of bounded size, so a frequent term is many bounded rows.  Windows of the test items are a
table, too.  Each window's terms are ordered by how often the documents hold them; a term that they don't hold ends it.
The postings of the rarest term name the slices in which the window may occur.  There its postings, less the term's
offset, are the candidate starts, and the other terms' lists, adjusted by their offsets, are intersected with them from the
rarer to the more frequent.  All windows of a slice go through each step together, in numpy.  Nothing is broadcast.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, scratch_path, stash, text_slices

#: Lower-cases A-Z and turns what is no word character (``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``) into spaces.
_FOLD = bytes((c + 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Bytes of texts in one slice (a longer text is one of its own).
SLICE = 4 << 20
#: Buckets of terms that the index is stored in.
TERM_BUCKETS = 16
#: Windows that meet a slice at once, about; more are dealt to several groups.
BLOCK_WINDOWS = 100_000
#: Words by which a window's terms may be farther apart in a proximity match.
SLACK = 7


def words(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


INDEX = "slice long, term string, n int, positions binary, doc_ids array<long>, hashes array<long>, counts array<int>"


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, hash, text): for each slice a row for every term with its positions (as steps), and one without a term
    that lists the documents.  A free position after each document keeps phrases from crossing into the next."""
    number = TaskContext.get().partitionId() << 24
    schema = pa.schema([("slice", pa.int64()), ("term", pa.string()), ("n", pa.int32()), ("positions", pa.binary())])
    schema = schema.append(pa.field("doc_ids", pa.list_(pa.int64()))).append(pa.field("hashes", pa.list_(pa.int64()))).append(pa.field("counts", pa.list_(pa.int32())))
    for batch in batches:
        for lo, hi, texts in text_slices(batch.column(2), SLICE):
            tokens = [words(x) for x in texts]
            counts = np.fromiter(map(len, tokens), np.int64, hi - lo)
            numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
            flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(tokens)), np.int32, int(counts.sum()))
            del tokens
            place = np.arange(len(flat), dtype=np.int32) + np.repeat(np.arange(hi - lo, dtype=np.int32), counts)
            order = np.argsort(flat, kind="stable")
            steps = place[order]
            n = np.bincount(flat, minlength=len(numbers)).astype(np.int32)
            ends = np.cumsum(n)
            steps[1:] -= steps[:-1].copy()
            steps[(ends - n)[1:]] = place[order[(ends - n)[1:]]]
            if len(numbers):
                held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(steps)])
                terms = pa.array(list(numbers), pa.binary()).cast(pa.string())
                empty = [pa.nulls(len(n), f.type) for f in schema][4:]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), number)), terms, pa.array(n), held, *empty], schema=schema)
            listed = {"slice": number, "n": hi - lo, "doc_ids": batch.column(0).slice(lo, hi - lo).to_pylist(), "hashes": batch.column(1).slice(lo, hi - lo).to_pylist()}
            yield pa.RecordBatch.from_pylist([listed | {"counts": counts.tolist()}], schema=schema)
            number += 1


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs(doc_id, text)``: INDEX's columns and ``bucket`` (by term; -1 lists documents)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("hash"), F.col("text").cast("string").alias("text"))
    tasks = max(1, rows.rdd.getNumPartitions())  # they follow the size of the input
    bucket = F.when(F.col("term").isNull(), -1).otherwise(F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS)).cast("int"))
    # a bucket is several parts for each task that it would fill, so neither a frequent term nor a bucket is one task's
    salt = F.pmod(F.xxhash64("slice"), F.lit(-(-4 * tasks // TERM_BUCKETS)))
    path = scratch_path(spark, "positional-index")
    made = rows.mapInArrow(_postings, INDEX).withColumn("bucket", bucket).repartition(tasks, "bucket", salt)
    made.sortWithinPartitions("bucket", "term").write.option("compression", "zstd").partitionBy("bucket").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _windows(tests: DataFrame, window: int) -> DataFrame:
    """(w, item, n, terms) of the distinct windows of each item; item is its id as text, or ``n`` for null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = [w.decode() for w in words((text or "").encode())]
                pieces = list(dict.fromkeys(tuple(held[i : i + window]) for i in range(max(1, len(held) - window + 1)))) if held else []
                for at in range(0, len(pieces), 4096):
                    part = list(map(list, pieces[at : at + 4096]))
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.string()), pa.array(part, pa.list_(pa.string()))], ["item", "terms"])

    item = F.coalesce(F.col("item_id").cast("long").cast("string"), F.lit("n"))
    cut_ = tests.select(item.alias("item"), F.col("text").cast("string").alias("text")).mapInArrow(cut, "item string, terms array<string>").distinct()
    return stash(cut_.select(F.monotonically_increasing_id().alias("w"), "item", F.size("terms").alias("n"), "terms"), "test-windows")


class Slice:
    """The postings of test terms in one slice: positions, sorted, by number of the term."""

    def __init__(self, keys: np.ndarray, steps: list[bytes], counts: np.ndarray) -> None:
        self.keys = np.sort(keys)
        lists = [np.cumsum(np.frombuffer(steps[i], np.int32), dtype=np.int64) for i in np.argsort(keys).tolist()]
        self.frequency = np.fromiter(map(len, lists), np.int64, len(lists))
        self.first = np.cumsum(self.frequency) - self.frequency
        self.positions = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        self.begin = np.cumsum(counts + 1) - counts - 1
        self.end = self.begin + counts
        self.span = int(counts.sum()) + len(counts) + 1
        self.places = np.repeat(np.arange(len(lists)), self.frequency) * self.span + self.positions

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The terms' numbers, -1 for those without postings here (and for keys of -1)."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(keys.shape, -1)

    def starts(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of each of ``term``, and the index into ``term`` that each is of."""
        n = self.frequency[term]
        owner = np.repeat(np.arange(len(term)), n)
        return self.positions[np.repeat(self.first[term] - (np.cumsum(n) - n), n) + np.arange(len(owner))], owner

    def documents(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, position, side="right") - 1

    def phrases(self, terms: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of each exact occurrence.  Rows of ``terms`` and ``offsets`` go from the rarest term on; -1 ends one."""
        place, owner = self.starts(terms[:, 0])
        start = place - offsets[owner, 0]
        for step in range(1, terms.shape[1]):
            term = terms[owner, step]
            want = term * self.span + start + offsets[owner, step]
            at = np.minimum(np.searchsorted(self.places, want), len(self.places) - 1)
            keep = (term < 0) | ((self.places[at] == want) & (start >= 0))
            owner, start = owner[keep], start[keep]
        return owner, start

    def near(self, terms: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of each occurrence of the rarest term that has all others, in any order, in the same document
        at most ``reach`` words away."""
        place, owner = self.starts(terms[:, 0])
        for step in range(1, terms.shape[1]):
            doc = self.documents(place)
            term = terms[owner, step]
            low, high = np.maximum(place - reach[owner], self.begin[doc]), np.minimum(place + reach[owner], self.end[doc] - 1)
            at = np.searchsorted(self.places, term * self.span + low)
            found = self.places[np.minimum(at, len(self.places) - 1)]
            keep = (term < 0) | ((at < len(self.places)) & (found <= term * self.span + high))
            owner, place = owner[keep], place[keep]
        return owner, place


FOUND = "slice long, doc int, spans array<struct<a:int,b:int>>, items array<string>, near array<string>"


def _intersected(asked: pd.DataFrame, held: pd.DataFrame, slack: int) -> pd.DataFrame:
    """Matches in a slice, of windows (item, n, keys, offsets; rarest first) among postings (key, positions; -1 lists counts)."""
    columns = [x.split()[0] for x in FOUND.split(", ")][:5]
    if not len(asked) or not len(held):
        return pd.DataFrame([], columns=columns)
    counts = np.asarray(held["counts"][held["key"] == -1].iloc[0], np.int64)
    held = held[held["key"] >= 0]
    index = Slice(held["key"].to_numpy(), held["positions"].tolist(), counts)
    n = asked["n"].to_numpy(np.int64)
    keys = np.full((len(n), int(n.max())), -1, np.int64)
    offsets = np.zeros_like(keys)
    own = np.arange(keys.shape[1]) < n[:, None]
    keys[own], offsets[own] = np.concatenate(asked["keys"].tolist()), np.concatenate(asked["offsets"].tolist())
    terms = index.numbers(keys)
    alive = np.flatnonzero(((terms >= 0) | ~own).all(axis=1))  # a term without postings here ends its windows
    if not len(alive):
        return pd.DataFrame([], columns=columns)
    terms, offsets, n, items = terms[alive], offsets[alive], n[alive], asked["item"].to_numpy()[alive]
    spans, exact, near = defaultdict(list), defaultdict(set), defaultdict(set)
    window, start = index.phrases(terms, offsets)
    edges = np.zeros(index.span + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + n[window], -1)
    inside = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)]))
    begins, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    for doc, a, b in zip(index.documents(begins).tolist(), begins.tolist(), ends.tolist(), strict=True):
        spans[doc].append({"a": a, "b": b})
    for doc, w in zip(index.documents(start).tolist(), window.tolist(), strict=True):
        exact[doc].add(items[w])
    window, place = index.near(terms, n + slack - 1)
    pairs = np.unique(np.stack([index.documents(place), window]), axis=1)
    for doc, w in pairs.T.tolist():
        near[doc].add(items[w])
    rows = [(int(asked["at"].iloc[0]), doc, spans[doc], sorted(exact[doc]), sorted(near[doc])) for doc in sorted(near)]
    return pd.DataFrame(rows, columns=columns)


def _matches(docs: DataFrame, tests: DataFrame, window: int, slack: int) -> DataFrame:
    """(doc_id, hash, n_words, n_hit, items, near) of every row; the last two are distinct item texts, null without any."""
    index = build_index(docs)
    windows = _windows(tests, window)
    places = windows.select("w", F.posexplode("terms").alias("offset", "term"))
    wanted = places.select("term").distinct()
    often = index.where("bucket >= 0").select("term", "n").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("often"))
    terms = stash(often.select(F.monotonically_increasing_id().alias("key"), "term", "often"), "test-terms")
    order = F.sort_array(F.collect_list(F.struct("often", "offset", "key")))  # a window's terms: ``window`` of them at most
    live = places.join(terms, "term").groupBy("w").agg(order.alias("order")).join(windows.select("w", "item", "n"), "w").where(F.size("order") == F.col("n"))
    live = stash(live.select("w", "item", "n", F.col("order.key").alias("keys"), F.col("order.offset").alias("offsets")), "live-windows")
    blocks = max(1, -(-live.count() // BLOCK_WINDOWS))

    used = live.select(F.explode("keys").alias("key")).distinct().join(terms, "key").select("key", "term")
    postings = index.where("bucket >= 0").join(used, "term").select("slice", "key", "positions")
    asked = live.select(F.get("keys", F.lit(0)).alias("key"), F.pmod(F.xxhash64("w"), F.lit(blocks)).cast("int").alias("block"), "item", "n", "keys", "offsets")
    there = index.where("bucket >= 0").join(used, "term").select(F.col("slice").alias("at"), "key")
    asked = asked.join(there, "key").select("at", F.col("block").alias("part"), "item", "n", "keys", "offsets")
    listed = index.where("bucket = -1").select("slice", "doc_ids", "hashes", "counts")
    held = postings.select("slice", "key", "positions", F.lit(None).cast("array<int>").alias("counts")).unionByName(
        listed.select("slice", F.lit(-1).cast("long").alias("key"), F.lit(None).cast("binary").alias("positions"), "counts")
    )
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = asked.groupBy("at", "part").cogroup(held.groupBy("slice", "block")).applyInPandas(lambda a, b: _intersected(a, b, slack), FOUND)
    hit = F.size(F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("spans")), lambda s: F.sequence(s["a"], s["b"] - 1)))))
    merged = found.groupBy("slice", "doc").agg(
        hit.cast("long").alias("n_hit"), *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")]
    )
    each = listed.select("slice", F.posexplode(F.arrays_zip("doc_ids", "hashes", "counts")).alias("doc", "of"))
    each = each.select("slice", "doc", F.col("of.doc_ids").alias("doc_id"), F.col("of.hashes").alias("hash"), F.col("of.counts").cast("long").alias("n_words"))
    return each.join(merged, ["slice", "doc"], "left").select("doc_id", "hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), "items", "near")


def find_matches(docs: DataFrame, tests: DataFrame, window: int = 13, slack: int = SLACK) -> DataFrame:
    """Where items of ``tests(item_id, text)`` occur in ``docs(doc_id, text)``: one row per row of ``docs``.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one; items without words have none.
    Returns doc_id, n_words, n_hit (words inside any exact match of a window), items (ids with an exact match, in order)
    and near (ids with a match by proximity: all the window's words, in any order, in the document at most its length and
    ``slack`` less 1 from an occurrence of the one that is rarest in all documents, the earliest of equally rare ones).
    Null and empty texts have no words and no matches.  Items that share an id count once, those with a null id as one item
    of null id.  Repeated rows count each; an empty table of items matches nothing.
    """
    ids = lambda c: F.sort_array(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.when(x != "n", x.cast("long"))))
    return _matches(docs, tests, window, slack).select("doc_id", "n_words", "n_hit", ids("items").alias("items"), ids("near").alias("near"))


def clean_documents(docs: DataFrame, tests: DataFrame, window: int = 13, share: int | None = 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`contamination` doesn't call contaminated; with ``share``
    None, those without any word inside a test window."""
    hit = F.col("n_hit") > 0
    bad = _matches(docs, tests, window, SLACK).where(hit if share is None else hit & (share * F.col("n_hit") >= F.col("n_words")))
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("hash").alias("_bad_hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_bad_hash"))
    return docs.join(bad, same, "left_anti")


def contamination(docs: DataFrame, tests: DataFrame, window: int = 13, share: int = 20, slack: int = SLACK) -> DataFrame:
    """Contaminated documents: at least one word in ``share`` is inside an exact match of a test window.

    Returns doc_id, n_words, n_hit, n_items, items_sha256 (of the matching item ids, sorted as strings, comma-joined; a null
    one is ``null``), contaminated, n_near (items that match by proximity).  For nulls, repeats and empty tables see
    :func:`find_matches`.
    """
    ids = F.array_join(F.sort_array(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit("null")))), ",")
    return find_matches(docs, tests, window, slack).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )
