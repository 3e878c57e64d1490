"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

Training documents are split into a retained and a deleted part.  Maximum-likelihood estimates from the retained counts
are mixed with weights that depend on how often the context occurs (powers of two are the buckets); the weights are
learned by expectation-maximisation on the deleted part's counts.  Scores use the counts of both parts.

N-grams are never rows.  Documents are cut into chunks of some million tokens, written once as number arrays.  A chunk
asks for the counts of its distinct n-grams: sorted 64-bit keys, dealt by key to buckets of bounded size, one packed row
per chunk and bucket that it has keys for, with the chunk's own counts.  A bucket adds up what all chunks hold and answers
in the order asked.  A frequent n-gram is therefore one entry per chunk, however many documents hold it.

Expectation-maximisation is exact: held-out pairs whose three counts agree are one row, and each round is a sum over those
rows by context bucket.  The number of tasks follows the data, so a task's share doesn't grow with it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import doc_fold, lowered_words, mix64, stash, text_slices

#: Bytes of text in one chunk, at most (a longer text is a chunk of its own).
CHUNK_BYTES = 8 << 20
#: Distinct n-grams that a bucket is asked for, about.
BUCKET_ENTRIES = 700_000
#: Entries asked for, and tokens of chunks answered, in one task, about.
TASK_ENTRIES = 2_800_000
#: Rows that EM runs on in the driver, at most; more stay where they are, and every round sums them there.
EM_ROWS = 1_000_000
#: The end of a text; no word holds a line break.
END = b"\n"
TESTED, DELETED, RETAINED = 0, 1, 2
CONTEXTS = 64
_KEEP = 1e-6


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, dtype, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)


CHUNKS = "chunk long, part int, doc_ids array<long>, lengths binary, n_tokens long, n_words long, hashes binary, tokens binary"


def _chunks(docs: DataFrame, folds: int) -> DataFrame:
    """Packed chunks of ``docs(doc_id, text)``: the distinct words' hashes and, by document, the words' numbers."""
    fold = doc_fold("doc_id", folds)
    part = F.when(fold == 0, TESTED).when(fold == 1, DELETED).otherwise(RETAINED)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 24) + 1
        for batch in batches:
            parts = batch.column(2).to_numpy(zero_copy_only=False)
            for p in np.unique(parts):
                own = batch.filter(pa.array(parts == p))
                ids = own.column(0).to_pylist()
                for lo, hi, texts in text_slices(own.column(1), CHUNK_BYTES):
                    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
                    end = numbers[END]
                    flat: list[int] = []
                    lengths = []
                    for text in texts:
                        words = lowered_words(text)
                        flat.extend(map(numbers.__getitem__, words))
                        flat.append(end)
                        lengths.append(len(words) + 1)
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "chunk": number, "part": int(p), "doc_ids": ids[lo:hi], "lengths": _pack(np.array(lengths, np.int32)),
                                "n_tokens": len(flat), "n_words": len(numbers), "hashes": _pack(hashes), "tokens": _pack(np.array(flat, np.uint32)),
                            }
                        ],
                        schema=_CHUNK_SCHEMA,
                    )
                    number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), part.alias("part")).mapInArrow(cut, CHUNKS)


_CHUNK_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary())]
    + [("n_tokens", pa.int64()), ("n_words", pa.int64()), ("hashes", pa.binary()), ("tokens", pa.binary())]
)


class _Grams:
    """A chunk's distinct words and word pairs in the order in which it asks for them."""

    def __init__(self, row: dict, buckets: int) -> None:
        hashes = _unpack(row["hashes"], np.uint64, row["n_words"])
        self.tokens = _unpack(row["tokens"], np.uint32, row["n_tokens"])
        self.n_words = len(hashes)
        codes = np.empty(len(self.tokens), np.int64)  # the end of a text is what stands before the next one
        codes[0], codes[1:] = 0, self.tokens[:-1]
        codes *= self.n_words
        codes += self.tokens
        pairs, pair_of = np.unique(codes, return_inverse=True)
        del codes
        self.pair_of = pair_of.astype(np.int32)
        del pair_of
        self.context, self.word = (pairs // self.n_words).astype(np.int32), (pairs % self.n_words).astype(np.int32)
        del pairs
        keys = mix64(hashes)[self.context]
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys += hashes[self.word]
        keys = np.concatenate([mix64(hashes), mix64(keys)])
        bucket = (keys % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        self.order = np.argsort(bucket, kind="stable").astype(np.int32)
        held, first = np.unique(bucket[self.order], return_index=True)
        del bucket
        #: The buckets that the chunk has keys for, and where each one's keys begin and end.
        self.buckets, self.ends = held.astype(np.int64), np.append(first, len(self.order))
        self.keys = keys[self.order]
        del keys
        self.n = np.concatenate([np.bincount(self.tokens, minlength=self.n_words), np.bincount(self.pair_of, minlength=len(self.context))])
        self.is_word = self.order < self.n_words

    def answered(self, rows: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
        """Global counts of the words and of the pairs."""
        out = np.zeros(len(self.keys), np.int64)
        for at, data in zip(np.searchsorted(self.buckets, rows["bucket"].to_numpy()).tolist(), rows[column], strict=True):
            lo, hi = self.ends[at], self.ends[at + 1]
            out[self.order[lo:hi]] = _unpack(data, np.int64, hi - lo)
        return out[: self.n_words], out[self.n_words :]


ASKED = "bucket int, chunk long, part int, n long, n_words long, keys binary, held binary"
ANSWERS = "chunk long, bucket int, part int, n_all binary, n_deleted binary, distinct long"


def _ask(chunks: DataFrame, buckets: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                grams = _Grams(row, buckets)
                held = grams.n[grams.order]
                out = [
                    (b, row["chunk"], row["part"], hi - lo, int(grams.is_word[lo:hi].sum()), grams.keys[lo:hi].tobytes(), _pack(held[lo:hi]))
                    for b, lo, hi in zip(grams.buckets.tolist(), grams.ends[:-1].tolist(), grams.ends[1:].tolist(), strict=True)
                ]
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                for at in range(0, len(out), 256):
                    columns = zip(*out[at : at + 256], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in ASKED.split(", ")])

    return chunks.select("chunk", "part", "n_tokens", "n_words", "hashes", "tokens").mapInArrow(ask, ASKED)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Add up a bucket: of each key asked for, the count in all training documents and in the deleted part."""
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in group["keys"]])
    held = np.concatenate([_unpack(h, np.int64, n) for h, n in zip(group["held"], group["n"], strict=True)])
    part = np.repeat(group["part"].to_numpy(), group["n"].to_numpy())
    # words come first in each row; a word and a pair stay apart even if their keys should agree
    within = np.arange(len(keys)) - np.repeat(np.cumsum(group["n"].to_numpy()) - group["n"].to_numpy(), group["n"].to_numpy())
    is_word = within < np.repeat(group["n_words"].to_numpy(), group["n"].to_numpy())
    deleted, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    distinct = 0
    for kind in (True, False):
        own = np.flatnonzero(is_word == kind)
        _, where = np.unique(keys[own], return_inverse=True)
        if not len(own):
            continue
        d = np.bincount(where, np.where(part[own] == DELETED, held[own], 0)).astype(np.int64)
        a = np.bincount(where, np.where(part[own] != TESTED, held[own], 0)).astype(np.int64)
        deleted[own], total[own] = d[where], a[where]
        distinct += int((a > 0).sum()) if kind else 0
    ends = np.cumsum(group["n"].to_numpy())
    return pd.DataFrame(
        {
            "chunk": group["chunk"],
            "bucket": group["bucket"],
            "part": group["part"],
            "n_all": [_pack(x) for x in np.split(total, ends[:-1])],
            "n_deleted": [_pack(x) for x in np.split(deleted, ends[:-1])],
            "distinct": [distinct] + [0] * (len(group) - 1),
        }
    )


def frequency_bucket(n: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + the whole part of the count's binary logarithm."""
    return np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) + 1, 0)


def learned_weights(total: np.ndarray, shares: Callable[[np.ndarray], np.ndarray], rounds: int = 60) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) by context bucket that make the held-out counts likeliest.

    ``total`` are held-out counts by bucket; ``shares(weights)`` are, by bucket, the parts of them that the three estimates
    account for under ``weights``.  Each weight stays at least a millionth (the bigram's in bucket 0 is 0).  A bucket without
    counts has the weights of the next lower one that has some, or else of the next higher one.  Rounds end early when no
    weight moves by more than 1e-10.
    """
    buckets = len(total)
    weights = np.full((buckets, 3), 1 / 3)
    weights[0] = (0.0, 0.5, 0.5)
    for _ in range(rounds):
        before = weights
        weights = np.where(total[:, None] > 0, shares(weights) / np.maximum(total, 1e-300)[:, None], weights)
        weights = np.maximum(weights, _KEEP)
        weights[0, 0] = 0.0
        weights /= weights.sum(axis=1, keepdims=True)
        if np.abs(weights - before).max() <= 1e-10:
            break
    seen = np.flatnonzero(total[1:] > 0) + 1
    for b in range(1, buckets):
        if total[b] == 0 and len(seen):
            lower = seen[seen < b]
            weights[b] = weights[lower[-1] if len(lower) else seen[0]]
    return weights


def expectation_maximisation(bucket: np.ndarray, held: np.ndarray, bigram: np.ndarray, unigram: np.ndarray, uniform: float, buckets: int = CONTEXTS, rounds: int = 60) -> np.ndarray:
    """:func:`learned_weights` of counts in arrays."""
    p = np.stack([bigram, unigram, np.full(len(held), uniform)])

    def shares(weights: np.ndarray) -> np.ndarray:
        mixed = weights[bucket].T * p
        parts = mixed / np.maximum(mixed.sum(axis=0), 1e-300) * held
        return np.stack([np.bincount(bucket, x, buckets) for x in parts], axis=1)

    return learned_weights(np.bincount(bucket, held, buckets), shares, rounds)


def expectation_maximisation_of(table: DataFrame, uniform: float) -> np.ndarray:
    """:func:`learned_weights` of the rows of ``table(bucket, held, bigram, unigram)``, which may be many."""
    if table.count() <= EM_ROWS:
        held = table.toArrow()  # 28 bytes a row
        return expectation_maximisation(*(held.column(c).to_numpy() for c in ("bucket", "held", "bigram", "unigram")), uniform)
    total = np.zeros(CONTEXTS)
    for r in table.groupBy("bucket").agg(F.sum("held")).collect():  # a row for each bucket
        total[r[0]] = r[1]

    def shares(weights: np.ndarray) -> np.ndarray:
        of = [F.get(F.array(*map(F.lit, weights[:, i].tolist())), F.col("bucket")) * p for i, p in enumerate((F.col("bigram"), F.col("unigram"), F.lit(uniform)))]
        mixed = table.select("bucket", "held", *[x.alias(f"p{i}") for i, x in enumerate(of)])
        each = F.col("held") / F.greatest(F.col("p0") + F.col("p1") + F.col("p2"), F.lit(1e-300))
        out = np.zeros((CONTEXTS, 3))
        for r in mixed.groupBy("bucket").agg(*[F.sum(each * F.col(f"p{i}")) for i in range(3)]).collect():
            out[r[0]] = r[1:]
        return out

    return learned_weights(total, shares)


HELD = "context long, pair long, word long, held long"


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text, ...)``, learned from those whose crc32(doc_id as text) mod ``folds``
    isn't 0 (of these, remainder 1 is the deleted part).

    A-Z are lower-cased; tokens are words ``[^\\x20\\x09-\\x0D]+`` and one end.  Returns doc_id, held_out (remainder 0),
    n_tokens, n_known (tokens that training has), train_tokens, base_score (add-0.1 unigrams) and score, both sums of
    log10 over the tokens.  Null texts are empty (one end token), a null doc_id is held out, repeated rows count each.
    Without a deleted part the weights are equal; an empty table gives an empty result.  Words are told apart by 64-bit
    hashes.
    """
    spark = docs.sparkSession
    chunks = stash(_chunks(docs, folds), "lm-chunks", codec="uncompressed")
    sizes = {r.part: r.n for r in chunks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    n_all, n_retained = sizes.get(RETAINED, 0) + sizes.get(DELETED, 0), sizes.get(RETAINED, 0)
    buckets, tasks = (max(1, -(-sum(sizes.values()) // n)) for n in (BUCKET_ENTRIES, TASK_ENTRIES))
    asked = _ask(chunks, buckets).repartition(tasks, "bucket")
    answers = stash(asked.groupBy("bucket").applyInPandas(_answer, ANSWERS), "lm-answers", codec="uncompressed")
    vocabulary = answers.agg(F.sum("distinct")).first()[0]
    uniform = 1.0 / (vocabulary + 1)

    def held_out(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """A deleted chunk's pairs: how often each occurs there, and the retained counts of its context, itself and its word."""
        grams = _Grams(own.iloc[0].to_dict(), buckets)
        (w_all, p_all), (w_del, p_del) = grams.answered(found, "n_all"), grams.answered(found, "n_deleted")
        words, pairs = w_all - w_del, p_all - p_del
        context, word, held = words[grams.context], words[grams.word], grams.n[grams.n_words :]
        order = np.lexsort((word, pairs, context))
        context, pairs, word = context[order], pairs[order], word[order]
        first = np.flatnonzero(np.append(True, (np.diff(context) != 0) | (np.diff(pairs) != 0) | (np.diff(word) != 0)))
        return pd.DataFrame({"context": context[first], "pair": pairs[first], "word": word[first], "held": np.add.reduceat(held[order], first)})

    def joined(fn, schema: str, part: int | None = None) -> DataFrame:
        a, b = (chunks, answers) if part is None else (chunks.where(F.col("part") == part), answers.where(F.col("part") == part))
        share = tasks if part is None else max(1, -(-tasks * sizes.get(part, 0) // sum(sizes.values())))
        a, b = a.repartition(share, "chunk"), b.drop("part", "distinct").repartition(share, "chunk")
        return a.groupBy("chunk").cogroup(b.groupBy("chunk")).applyInPandas(fn, schema)

    context, pair, word = F.col("context"), F.col("pair"), F.col("word")
    table = stash(
        joined(held_out, HELD, DELETED)
        .groupBy("context", "pair", "word")
        .agg(F.sum("held").cast("double").alias("held"))
        .select(
            F.when(context > 0, F.length(F.bin(context))).otherwise(0).cast("int").alias("bucket"),
            "held",
            F.when(context > 0, pair / context).otherwise(0.0).alias("bigram"),
            (word / F.lit(max(n_retained, 1))).alias("unigram"),
        ),
        "lm-held",
    )
    weights = expectation_maximisation_of(table, uniform)

    def score(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = own.iloc[0].to_dict()
        grams = _Grams(row, buckets)
        words, pairs = grams.answered(found, "n_all")
        base = np.log10((words + 0.1) / (n_all + 0.1 * (vocabulary + 1)))
        context = words[grams.context]
        w = weights[frequency_bucket(context)]
        mixed = w[:, 0] * np.where(context > 0, pairs / np.maximum(context, 1), 0.0) + w[:, 1] * (words[grams.word] / max(n_all, 1)) + w[:, 2] * uniform
        lengths = _unpack(row["lengths"], np.int32, len(row["doc_ids"])).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
                "held_out": row["part"] == TESTED,
                "n_tokens": lengths,
                "n_known": np.add.reduceat((words > 0)[grams.tokens].astype(np.int64), first),
                "train_tokens": n_all,
                "base_score": np.add.reduceat(base[grams.tokens], first),
                "score": np.add.reduceat(np.log10(mixed)[grams.pair_of], first),
            }
        )

    return joined(score, result)
