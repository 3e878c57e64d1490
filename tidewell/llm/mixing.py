"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import running_sums, stash

WORD = r"[^\x20\x09-\x0D]+"
#: Sources that the driver apportions itself; more stay a table, over which the same is computed.
MAX_SOURCES = 500_000


def water_filled(sizes: Sequence[int], weights: Sequence[float], cap: float) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``cap`` times its size; what exceeds goes to the others by weight."""
    targets, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
        left -= sum(targets[i] for i in over)
        full = set(over)
        open_ = [i for i in open_ if i not in full]
    return targets


def sainte_lague(shares: Sequence[float], seats: int, limits: Sequence[int] | None = None) -> list[int]:
    """``seats`` dealt to the highest quotients share / (2 k + 1), k the seats held; ties to the earlier entry.

    The seats that any divisor method deals at a slightly too large divisor are given at once, the last few by a heap,
    so the cost doesn't depend on ``seats``.  ``limits`` are most seats by entry; if all are full, seats stay over.
    """
    caps = [seats] * len(shares) if limits is None else list(limits)
    total = sum(shares)
    if seats <= 0 or total <= 0:
        return [0] * len(shares)
    divisor = total / seats * 1.0000001

    def dealt(d: float) -> list[int]:
        return [min(c, int(s / d + 0.5)) if s > 0 else 0 for s, c in zip(shares, caps, strict=True)]

    low, high = divisor / 2, divisor
    while sum(dealt(high)) > seats:
        low, high = high, high * 2
    for _ in range(60):  # the smallest divisor that doesn't deal too many
        mid = (low + high) / 2
        if sum(dealt(mid)) > seats:
            low = mid
        else:
            high = mid
    held = dealt(high * (1 + 1e-9))  # seats that tie go through the heap
    heap = [(-s / (2 * k + 1), i) for i, (s, k, c) in enumerate(zip(shares, held, caps, strict=True)) if s > 0 and k < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(held)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        held[i] += 1
        if held[i] < caps[i]:
            heapq.heappush(heap, (-shares[i] / (2 * held[i] + 1), i))
    return held


PLAN = "skey string, source_size long, target double, quota long"


def _planned(found: list, weights: Sequence[float], cap: int, block_tokens: int) -> list[tuple]:
    """PLAN's rows of sources (skey, size), in their order."""
    targets = water_filled([r.size for r in found], [weights[i % len(weights)] for i in range(len(found))], cap)
    limits = [-(-cap * r.size // block_tokens) for r in found]
    quotas = sainte_lague(targets, round(sum(targets) / block_tokens), limits)
    return [(r.skey, r.size, t, n) for r, t, n in zip(found, targets, quotas, strict=True)]


def _planned_table(sources: DataFrame, weights: Sequence[float], cap: int, block_tokens: int) -> DataFrame:
    """:func:`_planned` of a table of sources.  The level up to which weights are filled and the divisor of the quotas are
    found by sums over the table; seats that tie at the divisor go to the highest quotients, ties to the earlier source."""
    order = [F.col("skey") == "n", F.col("skey")]
    ranked = running_sums(sources.select("skey", "size", F.lit(1).alias("one")), order, "one")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before") % len(weights)).cast("int"))
    rows = stash(ranked.select("skey", "size", F.col("before").alias("place"), weight.alias("weight")), "mix-ranked")
    total, all_weights = rows.agg(F.sum("size"), F.sum("weight")).first()
    full, level = F.lit(cap) * F.col("size"), 0.0
    while True:  # the level only rises, and a source that is full stays full
        below = full < F.lit(level) * F.col("weight")
        held, left = rows.agg(F.sum(F.when(below, full).otherwise(0)), F.sum(F.when(below, 0.0).otherwise(F.col("weight")))).first()
        after = (total - held) / left if left else level
        if after <= level * (1 + 1e-12):
            break
        level = after
    target = F.least(full.cast("double"), F.lit(level) * F.col("weight"))
    rows = stash(rows.select("skey", "size", "place", target.alias("target"), F.ceil(full / block_tokens).alias("most")), "mix-targets")
    shared = rows.agg(F.sum("target")).first()[0]
    seats = round(shared / block_tokens)
    dealt = lambda d: F.least(F.col("most"), F.floor(F.col("target") / F.lit(d) + 0.5))
    low, high = shared / max(seats, 1) / 2, shared / max(seats, 1) * 2
    while rows.agg(F.sum(dealt(high))).first()[0] > seats:
        low, high = high, high * 2
    for _ in range(12):  # 32 divisors at a time
        tried = [low + (high - low) * (i + 1) / 32 for i in range(31)]
        sums = rows.agg(*[F.sum(dealt(d)) for d in tried]).first()
        good = next((i for i, n in enumerate(sums) if n <= seats), 31)
        low, high = (tried[good - 1] if good else low), (tried[good] if good < 31 else high)
    rows = stash(rows.withColumn("quota", dealt(high * (1 + 1e-9))), "mix-dealt")
    over = seats - rows.agg(F.sum("quota")).first()[0]
    quotient = F.col("target") / (2 * F.col("quota") + 1)
    more = rows.where((F.col("target") > 0) & (F.col("quota") < F.col("most"))).orderBy(quotient.desc(), "place").limit(max(over, 0)).select(F.col("skey").alias("k"))
    return rows.join(more, F.col("skey") == F.col("k"), "left").select(
        "skey", F.col("size").alias("source_size"), "target", (F.col("quota") + F.col("k").isNotNull().cast("int")).cast("long").alias("quota")
    )


def _laid_out(docs: DataFrame, weights: Sequence[float], cap: int, block_tokens: int, rows_per_shard: int, seed: int, carried: Column | None) -> DataFrame:
    """Rows with size, source_size, target and taken; with ``carried``, that expression of ``docs`` as ``row``, too."""
    columns = [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("skey"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("draw"),
    ]
    sized = stash(docs.select(*columns), "mix-rows")
    sources = sized.groupBy("skey").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = sources.limit(MAX_SOURCES + 1).collect()
    if len(found) <= MAX_SOURCES:
        found.sort(key=lambda r: (r.skey == "n", r.skey))
        n_rows = sum(r.rows for r in found)
        by_source = docs.sparkSession.createDataFrame(_planned(found, weights, cap, block_tokens), PLAN)
    else:
        sources = stash(sources, "mix-sources")
        n_rows = sources.agg(F.sum("rows")).first()[0]
        by_source = _planned_table(sources, weights, cap, block_tokens)
    shards = max(1, -(-n_rows // rows_per_shard))

    shard = F.pmod(F.col("draw"), F.lit(shards))
    # Words given up to a shard: the quota's rounded part, but in no shard more than cap times its words; what that cuts
    # off or rounding leaves goes to later shards.
    so_far = Window.partitionBy("skey").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    capped, b = F.lit(cap) * F.col("words"), F.lit(block_tokens)
    due = b * F.floor(F.col("quota") * (F.col("words") / F.greatest(F.col("source_size"), F.lit(1))) + 0.5)
    per_shard = (
        sized.groupBy(shard.alias("shard"), "skey")
        .agg(F.sum("size").alias("shard_size"))
        .join(F.broadcast(by_source) if len(found) <= 10_000 else by_source, "skey")
        .withColumn("words", F.sum("shard_size").over(so_far))
        .withColumn("upto", capped + F.least(F.lit(0), F.min(due - capped).over(so_far)))
        .withColumn("given", F.col("upto") - F.lag("upto", 1, 0).over(Window.partitionBy("skey").orderBy("shard")))
        .select("shard", "skey", "shard_size", "source_size", "target", "given")
    )

    rows = sized if carried is None else docs.select(*columns, carried.alias("row"))
    st = F.col("shard_size")
    upto = Window.partitionBy("shard", "skey").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = (
        rows.withColumn("shard", shard)
        .join(per_shard, ["shard", "skey"])
        .withColumn("end", F.sum("size").over(upto))
        .withColumn("begin", F.col("end") - F.col("size"))
        .withColumn("whole", F.floor(F.col("given") / F.greatest(st, F.lit(1))))
        .withColumn("first", F.pmod(F.xxhash64("shard", "skey", F.lit(seed)), F.greatest(F.ceil(st / b), F.lit(1))) * b)
        .withColumn("last", F.col("first") + F.col("given") - F.col("whole") * st)
    )

    def overlap(lo, hi):
        return F.greatest(F.lit(0), F.least(F.col("end"), hi) - F.greatest(F.col("begin"), lo))

    run = overlap(F.col("first"), F.col("last")) + overlap(F.lit(0), F.col("last") - st)
    return laid.withColumn("taken", (F.col("whole") * F.col("size") + run).cast("long"))


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, block_tokens: int = 8, rows_per_shard: int = 500, seed: int = 17
) -> DataFrame:
    """How many words a mix takes of each row of ``docs(doc_id, text, source, ...)``.

    Sources in code-point order (null last) have the repeated ``weights``; targets share all words and stop at ``cap``
    times a source's words.  Rows are dealt to shards of about ``rows_per_shard`` by a seeded hash.  The
    sources get integer quotas of ``block_tokens``-word blocks by Sainte-Lague, which are split over their shards by
    cumulative rounding in shard order; a shard's part takes all its words as often as it goes, and the rest as a run of blocks from a seeded one on, over its rows in seeded order.  A row's words
    are those of its blocks.

    Returns doc_id, source, size, source_size, target, taken.  Null text: size 0, taken 0.  Repeated rows and doc_ids
    count each for itself; ties in the seeded order are between rows that are alike in id and size.  An empty table gives
    an empty result.  Other columns are not read.
    """
    laid = _laid_out(docs, weights, cap, block_tokens, rows_per_shard, seed, None)
    return laid.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, block_tokens: int = 8, rows_per_shard: int = 500, seed: int = 17
) -> DataFrame:
    """The mix of :func:`mix_sources` as rows: each row of ``docs``, whole and with all its columns, as often as the words
    taken of it are its size, rounded (never, if that is less than half, as it is for each row twice as long as its run)."""
    laid = _laid_out(docs, weights, cap, block_tokens, rows_per_shard, seed, F.struct(*[docs[c] for c in docs.columns]))
    return _repeated(laid, F.round(F.col("taken") / F.col("size")))


def drawn_documents(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, block_tokens: int = 8, rows_per_shard: int = 500, seed: int = 17
) -> DataFrame:
    """:func:`mixed_documents`, but a row whose copies rounding would fix whatever the seed, since the run of its source and
    shard or what that leaves is shorter than half the row, is taken once more if the run covers its middle word.  So rows of
    every length come as often, on average, as words are taken."""
    laid = _laid_out(docs, weights, cap, block_tokens, rows_per_shard, seed, F.struct(*[docs[c] for c in docs.columns]))
    size, st, middle = F.col("size"), F.col("shard_size"), F.col("begin") + F.floor(F.col("size") / 2)
    run = F.col("last") - F.col("first")
    covered = ((middle >= F.col("first")) & (middle < F.col("last"))) | (middle < F.col("last") - st)
    fixed = (2 * run < size) | (2 * (st - run) < size)
    return _repeated(laid, F.when(fixed, F.col("whole") + covered.cast("int")).otherwise(F.round(F.col("taken") / size)))


def _repeated(laid: DataFrame, copies: Column) -> DataFrame:
    copies = F.when(F.col("size") > 0, copies.cast("int")).otherwise(0)
    return laid.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")
