"""N-gram Jaccard join with size-banded tiles, bitmap signatures and exact intersection.

Vertices are distinct lower-cased texts, so exact copies are one vertex from the start.  Two texts can only reach the
threshold if they share a shingle of their prefixes (the first ``n - ceil(0.8 n) + 1`` shingles in one global order, in
which frequent shingles come last) and if their sizes are in a band.  So:

1. Frequent shingles are counted over all documents; which ones are listed changes the cost and never the result.
2. Star edges: texts that share one of their smallest shingles and a size band are tested against the group's most
   typical text.  Verified stars join most copies of a large group through one vertex, in a number of edges that is linear.
3. Tiles: the texts with one prefix shingle.  In a tile, texts of different star components and fitting sizes are paired;
   bit counts of their bitmap signatures bound the overlap from above, and pairs whose bound is too low go.
4. What is left is verified by exact intersection of sorted shingle arrays, and components are made of all verified links.

Pairs within a star component aren't needed: components are what is asked for.  Prefix entries travel as packed arrays to
buckets of bounded size, so nothing is ever gathered by a shingle alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, lowered_words, mix64, slices, stash, text_slices
from tidewell.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words in a shingle.
WORDS = 5
#: Shingles on the list of frequent ones, at most: a size bound for the broadcast, without effect on results.
FREQUENT = 1 << 20
#: Prefix entries in one bucket, about.
BUCKET_ENTRIES = 1_000_000
#: Texts in a tile whose pairs are listed at once; in larger ones bitmaps decide first.
SMALL_TILE = 16
#: Documents in one file of a table that is small beside the texts.
FILE_DOCS = 5_000
#: Smallest shingles by which stars are formed.
STARS = 4
#: Pairs held at once in a bucket.
PAIRS = 250_000
#: Bytes of text shingled at once, and words whose hashes are remembered.
SHINGLE_BYTES, MEMO = 2 << 20, 200_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Bits of the sieve by which texts are read again: at most 16 MB are sent, of which 1 in 16 is set up to 8 M texts.
SIEVE_BITS = (20, 27)


def digest(text: bytes) -> bytes:
    return hashlib.md5(text.lower()).digest()


def digest_column(text: str) -> Column:
    """:func:`digest` as an expression."""
    return F.unhex(F.md5(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER).cast("binary")))


class Shingler:
    """64-bit shingle hashes of texts, with a memo of word hashes that is emptied now and then."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All shingles of ``texts`` one after the other, repeats included, and how many each text has."""
        if len(self.words) > MEMO:
            self.words.clear()
        memo, flat, lengths = self.words, [], []
        for text in texts:
            words = lowered_words(text)
            flat += words
            lengths.append(len(words))
        for w in set(flat).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, flat), np.uint64, len(flat))
        n = np.array(lengths, np.int64)
        of = np.maximum(n - WORDS + 1, np.minimum(n, 1))
        begin = np.cumsum(n) - n
        at = np.repeat(begin - (np.cumsum(of) - of), of) + np.arange(int(of.sum()))
        short = np.repeat(n < WORDS, of)
        padded = np.concatenate([h, np.zeros(WORDS, np.uint64)])
        total = np.zeros(len(at), np.uint64)
        for k, factor in enumerate(_FACTORS):
            word = padded[at + k]
            if short.any():
                word = np.where(short & (np.repeat(n, of) <= k), np.uint64(k), word)
            total += mix64(word + np.uint64(k)) * factor
        return mix64(total), of

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Each text's distinct shingles, sorted."""
        flat, of = self.hashes(texts)
        ends = np.cumsum(of)
        return [np.unique(flat[e - n : e]) for e, n in zip(ends.tolist(), of.tolist(), strict=True)]


def prefix_length(n: int) -> int:
    """Shingles that a text of ``n`` must show so that no link at 0.8 is missed."""
    return n - (4 * n + 4) // 5 + 1


def bitmap(shingles: np.ndarray) -> bytes:
    """At least two bits a shingle, a power of two in all, so that a larger bitmap folds to a smaller one's size."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def overlap_bounds(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Most common shingles that rows of two bitmap matrices (uint64 words) can have; the wider one is folded."""
    while x.shape[1] > y.shape[1]:
        x = x[:, : x.shape[1] // 2] | x[:, x.shape[1] // 2 :]
    while y.shape[1] > x.shape[1]:
        y = y[:, : y.shape[1] // 2] | y[:, y.shape[1] // 2 :]
    return np.minimum(nx - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), ny - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))


def enough(common: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Whether 100 * intersection >= 80 * union."""
    return 100 * common >= 80 * (nx + ny - common)


class Bitmaps:
    """Bitmap signatures of some texts, as one matrix for each width."""

    def __init__(self, signatures: list[bytes], n: np.ndarray) -> None:
        self.n = n
        width = np.fromiter(map(len, signatures), np.int64, len(signatures))
        self.kind, self.row = np.zeros(len(width), np.int64), np.zeros(len(width), np.int64)
        self.matrices = []
        for k, w in enumerate(np.unique(width).tolist()):
            own = np.flatnonzero(width == w)
            self.kind[own], self.row[own] = k, np.arange(len(own))
            self.matrices.append(np.frombuffer(b"".join(signatures[i] for i in own.tolist()), np.uint64).reshape(len(own), -1))

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of numbers of texts, whether the bound reaches the threshold."""
        out = np.zeros(len(a), bool)
        kinds = self.kind[a] * len(self.matrices) + self.kind[b]
        for kind in np.unique(kinds).tolist():
            ka, kb = divmod(kind, len(self.matrices))
            own = np.flatnonzero(kinds == kind)
            step = max(1, (32 << 20) // (8 * max(self.matrices[ka].shape[1], self.matrices[kb].shape[1])))
            for at in range(0, len(own), step):
                i = own[at : at + step]
                x, y, nx, ny = a[i], b[i], self.n[a[i]], self.n[b[i]]
                out[i] = enough(overlap_bounds(self.matrices[ka][self.row[x]], nx, self.matrices[kb][self.row[y]], ny), nx, ny)
        return out


def _frequent(docs: DataFrame) -> np.ndarray:
    """Shingles that are frequent, sorted: those that occur three times in some slice of documents and 16 times in all."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                texts = list(dict.fromkeys(texts))  # copies in a slice count once
                parts = [texts[a:b] for a, b in slices([len(t) for t in texts], SHINGLE_BYTES)]
                keys, n = np.unique(np.concatenate([shingler.hashes(part)[0] for part in parts]), return_counts=True)
                often = n >= 3
                yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(scan, "shingle long, n long")
    listed = found.groupBy("shingle").agg(F.sum("n").alias("n")).where("n >= 16").orderBy(F.col("n").desc(), "shingle").limit(FREQUENT)
    return np.sort(listed.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


SETS = "doc_id long, node binary, id long, n long, common double, bitmap binary, prefix binary, smallest array<long>"


def _sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """One row per document; what belongs to the text stands in the first row of a text in each task only."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = sent.value
        sieve = np.zeros(1 << 22, bool)
        sieve[(listed >> np.uint64(42)).astype(np.int64)] = True
        shingler = Shingler()
        seen: dict[bytes, int] = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, texts in text_slices(batch.column(1), SHINGLE_BYTES):
                nodes = [digest(t) for t in texts]
                new = {}
                for i, node in enumerate(nodes):
                    if node not in seen:
                        new.setdefault(node, i)
                rows: list[tuple] = [()] * (hi - lo)
                for (node, i), s in zip(new.items(), shingler.sets([texts[i] for i in new.values()]), strict=True):
                    seen[node] = len(s)
                    if not len(s):
                        rows[i] = (0.0, None, None, None)
                        continue
                    often = sieve[(s >> np.uint64(42)).astype(np.int64)]
                    if often.any():
                        at = np.flatnonzero(often)
                        place = np.minimum(np.searchsorted(listed, s[at]), len(listed) - 1)
                        often[at] = listed[place] == s[at]
                    first = np.concatenate([s[~often], s[often]])[: prefix_length(len(s))]
                    rows[i] = (float(often.mean()), bitmap(s), first.tobytes(), s[:STARS].view(np.int64).tolist())
                kinds = (pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                columns = zip(*(r or (None,) * 4 for r in rows), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), pa.array(nodes, pa.binary()), pa.array(np.frombuffer(b"".join(nodes), np.int64)[::2])]
                    + [pa.array([seen[x] for x in nodes], pa.int64())]
                    + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [x.split()[0] for x in SETS.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, SETS)


class Sieve:
    """A table of bits that digests of wanted texts pass, as wide as their number asks for, within SIEVE_BITS; others
    seldom pass it, which costs time and changes no result."""

    def __init__(self, nodes: DataFrame) -> None:
        low, high = SIEVE_BITS
        self.width = min(max((16 * nodes.count()).bit_length(), low), high)
        slot = F.shiftright(F.conv(F.substring(F.hex("node"), 1, 7), 16, 10).cast("long"), 28 - self.width) + 1
        found = nodes.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
        self.bytes = np.zeros(1 << (self.width - 3), np.uint8)
        for k, bits in found:  # at most 2 ** 12 rows of 4 KB
            part = np.frombuffer(bits, np.uint8)[: len(self.bytes)]
            self.bytes[(k - 1) * 4096 : (k - 1) * 4096 + len(part)] = part

    def passes(self, node: bytes) -> bool:
        slot = int.from_bytes(node[:4], "big") >> (32 - self.width)
        return bool(self.bytes[slot >> 3] >> (slot & 7) & 1)


LINKS = "a binary, b binary"


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose texts link, by exact intersection.  Texts come from ``docs`` again: of those that a :class:`Sieve`
    lets pass, one of each digest, compressed."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    sent = docs.sparkSession.sparkContext.broadcast(Sieve(ends.distinct()))  # of a fixed size at most

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        seen: set[bytes] = set()
        for batch in batches:
            out: dict[bytes, bytes] = {}
            for _, _, texts in text_slices(batch.column(0)):
                for text in texts:
                    node = digest(text)
                    if node not in seen and wanted.passes(node):
                        seen.add(node)
                        out[node] = len(text).to_bytes(8, "big") + pa.compress(text, codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], ["node", "text"])

    texts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(read, "node binary, text binary")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        restored = lambda x: pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "big"), codec="zstd", asbytes=True)
        for batch in batches:
            good = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != last[0]:
                    last = (b, shingler.sets([restored(y)])[0])
                s, t = shingler.sets([restored(x)])[0], last[1]
                small, large = (s, t) if len(s) <= len(t) else (t, s)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum()) if len(small) else 0
                if common and enough(np.array(common), len(s), len(t)):
                    good.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in good], pa.binary()) for i in (0, 1)], ["a", "b"])

    x, y = texts.select(F.col("node").alias("a"), F.col("text").alias("x")), texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, LINKS)


def _star_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (text, most typical text of its group) that sizes and bitmaps let link.  A group is what shares one of the
    smallest shingles and a size band; most typical is who has the largest share of frequent shingles."""
    entries = nodes.select("node", "n", "common", F.explode("smallest").alias("key")).withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.25))))
    middle = entries.groupBy("key", "band").agg(F.min(F.struct((-F.col("common")).alias("less"), F.col("node").alias("node"))).alias("first"), F.count("*").alias("members"))
    pairs = (
        entries.join(middle.where("members > 1").select("key", "band", F.col("first.node").alias("b")), ["key", "band"])
        .where("node <> b")
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    x, y = (nodes.select(F.col("node").alias(p), F.col("n").alias(f"n{p}"), F.col("bitmap").alias(f"bitmap{p}")) for p in ("a", "b"))
    return _bounded(pairs.join(x, "a").join(y, "b"))


PACKED = "bucket int, keys binary, owners binary, ids binary, sizes binary"
TILES = "bucket int, left binary, right binary, ids binary, lengths binary, members binary"


def _meetings(tile: np.ndarray, member: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of ``member`` (numbers that go up with the sizes ``n``) in each tile whose sizes let them link, in
    batches of about PAIRS."""
    wide = int(n.max()) + 1
    size = n[member]
    # in its tile a member meets those after it, up to the end of its size band
    last = np.searchsorted(tile * wide + size, tile * wide + np.minimum(size * 5 // 4, wide - 1), side="right")
    meets = last - np.arange(len(member)) - 1
    done = np.cumsum(meets)
    at = 0
    while at < len(member):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, side="right")))
        k = meets[at:end]
        i = np.repeat(np.arange(at, end), k)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
        yield member[i], member[j]
        at = end


def _tiles(sets: DataFrame, buckets: int) -> DataFrame:
    """By bucket, the pairs of its small tiles (as two arrays of ids), and its large tiles: their lengths, and their
    members as numbers into an array of ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes = (batch.column(i).to_numpy() for i in (0, 1))
            prefixes = batch.column(2).to_pylist()
            keys = np.frombuffer(b"".join(prefixes), np.uint64)
            owner = np.repeat(np.arange(len(ids)), [len(p) // 8 for p in prefixes])
            bucket = (mix64(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            held, first = np.unique(bucket[order], return_index=True)
            for b, lo, hi in zip(held.tolist(), first.tolist(), np.append(first[1:], len(order)).tolist(), strict=True):
                own = order[lo:hi]
                used, number = np.unique(owner[own], return_inverse=True)
                data = (keys[own], number.astype(np.int32), ids[used], sizes[used].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)], [x.split()[0] for x in PACKED.split(", ")]
                )

    def tile(group: pd.DataFrame) -> pd.DataFrame:
        tables = [np.frombuffer(x, np.int64) for x in group["ids"]]
        shift = np.cumsum([0, *map(len, tables)])
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"]])
        owner = np.concatenate([np.frombuffer(x, np.int32) + s for x, s in zip(group["owners"], shift, strict=False)])
        sizes = np.concatenate([np.frombuffer(x, np.int32) for x in group["sizes"]]).astype(np.int64)
        table = np.concatenate(tables)
        # number texts by size, copies of one text in several tasks alike
        by_size = np.lexsort((table, sizes))
        new = np.append(True, (table[by_size][1:] != table[by_size][:-1]) | (sizes[by_size][1:] != sizes[by_size][:-1]))
        number = np.empty(len(table), np.int64)
        number[by_size] = np.cumsum(new) - 1
        ids, n = table[by_size[new]], sizes[by_size[new]]
        owner = number[owner]
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
        keys, owner = keys[fresh], owner[fresh]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        lengths = np.diff(np.append(first, len(keys)))
        small, large = (lengths > 1) & (lengths <= SMALL_TILE), lengths > SMALL_TILE
        pairs = np.zeros(0, np.int64)
        if small.any():
            inside = np.repeat(small, lengths)
            found = [np.unique(a * len(ids) + b) for a, b in _meetings(np.repeat(np.arange(len(lengths)), lengths)[inside], owner[inside], n)]
            pairs = np.unique(np.concatenate(found))
        used, members = np.unique(owner[np.repeat(large, lengths)], return_inverse=True)
        arrays = (ids[pairs // len(ids)], ids[pairs % len(ids)], ids[used], lengths[large].astype(np.int32), members.astype(np.int32))
        return pd.DataFrame([(int(group["bucket"].iloc[0]), *(x.tobytes() for x in arrays))], columns=[x.split()[0] for x in TILES.split(", ")])

    rows = sets.where("prefix is not null").select("id", "n", "prefix").mapInArrow(pack, PACKED)
    return rows.groupBy("bucket").applyInPandas(tile, TILES)


def _bounded(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, na, nb, bitmapa, bitmapb), those that sizes and bitmaps let link."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                m = part.num_rows
                n = np.concatenate([part.column(i).to_numpy() for i in (2, 3)])
                signs = Bitmaps(part.column(4).to_pylist() + part.column(5).to_pylist(), n)
                keep = pa.array(signs.may_link(np.arange(m), np.arange(m, 2 * m)))
                yield pa.RecordBatch.from_arrays([part.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    fit = pairs.where("5 * least(na, nb) >= 4 * greatest(na, nb)")
    return fit.select("a", "b", "na", "nb", "bitmapa", "bitmapb").mapInArrow(bounded, LINKS)


def _tile_pairs(tiles: DataFrame, nodes: DataFrame, stars: DataFrame, files: int) -> DataFrame:
    """Pairs of texts in different star components that meet in a tile, fit in size and whose bitmaps let them link."""
    known = nodes.join(stars.select(F.col("vertex").alias("node"), "component"), "node", "left")
    known = stash(known.select("id", "node", "n", F.coalesce("component", "node").alias("component")), "near-known", files=files)
    signs = nodes.select("id", "bitmap")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
                for at in range(0, len(a), 65_536):
                    yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 65_536]), pa.array(b[at : at + 65_536])], ["ia", "ib"])

    def side(p: str) -> DataFrame:
        return known.select(F.col("id").alias(f"i{p}"), F.col("node").alias(p), F.col("n").alias(f"n{p}"), F.col("component").alias(f"c{p}"))

    small = tiles.select("left", "right").mapInArrow(listed, "ia long, ib long").distinct()
    small = small.join(side("a"), "ia").join(side("b"), "ib").where("ca <> cb and a <> b and 5 * least(na, nb) >= 4 * greatest(na, nb)").drop("ca", "cb")
    for p in ("a", "b"):  # bitmaps last, for what is left
        small = small.join(signs.select(F.col("id").alias(f"i{p}"), F.col("bitmap").alias(f"bitmap{p}")), f"i{p}")
    small = _bounded(small)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(own), pa.int32()), pa.array(own)], ["bucket", "id"])

    def pairs(own: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(texts):
            return pd.DataFrame([], columns=["a", "b"])
        texts = texts.sort_values(["n", "node"], ignore_index=True)
        number = {x: i for i, x in enumerate(texts["id"].tolist())}
        place = np.array([number[x] for x in np.frombuffer(own["ids"].iloc[0], np.int64).tolist()], np.int64)
        n = texts["n"].to_numpy(np.int64)
        component = pd.factorize(texts["component"])[0]
        lengths = np.frombuffer(own["lengths"].iloc[0], np.int32).astype(np.int64)
        member = place[np.frombuffer(own["members"].iloc[0], np.int32)]
        first = np.cumsum(lengths) - lengths
        mixed = np.repeat(np.minimum.reduceat(component[member], first) != np.maximum.reduceat(component[member], first), lengths)
        tile, member = np.repeat(np.arange(len(lengths)), lengths)[mixed], member[mixed]
        order = np.lexsort((member, tile))
        tile, member = tile[order], member[order]
        signs = Bitmaps(texts["bitmap"].tolist(), n)
        kept = np.zeros(0, np.int64)
        for a, b in _meetings(tile, member, n) if len(member) else ():
            apart = component[a] != component[b]
            pair = np.unique(a[apart] * len(n) + b[apart])
            pair = pair[~np.isin(pair, kept)]
            kept = np.union1d(kept, pair[signs.may_link(pair // len(n), pair % len(n))])
        names = texts["node"].to_numpy()
        return pd.DataFrame({"a": names[kept // len(n)], "b": names[kept % len(n)]})

    big = tiles.where("length(ids) > 0").select("bucket", "ids", "lengths", "members")
    asked = big.select("bucket", "ids").mapInArrow(members, "bucket int, id long")
    large = big.groupBy("bucket").cogroup(asked.join(known, "id").join(signs, "id").groupBy("bucket")).applyInPandas(pairs, LINKS)
    return small.unionByName(large).distinct()


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, node, n), and those of rows with words with their component (a node)."""
    bounded_batches(docs.sparkSession)
    sets = stash(_sets(docs, _frequent(docs)), "near-sets")
    n_docs, entries = sets.agg(F.count("*"), F.sum(F.octet_length("prefix") / 8)).first()
    files = 1 + n_docs // FILE_DOCS
    nodes = stash(
        sets.where("n > 0 and bitmap is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("id", "n", "common", "bitmap", "smallest")]),
        "near-nodes",
        files=files,
    )
    buckets = max(1, -(-int(entries or 0) // BUCKET_ENTRIES))
    star_links = stash(_verified(docs, stash(_star_pairs(nodes), "near-stars", files=files)), "near-star-links", files=files)
    stars = connected_components(star_links, "a", "b", files)
    tiles = stash(_tiles(sets, buckets), "near-tiles", files=files)
    tile_links = stash(_verified(docs, stash(_tile_pairs(tiles, nodes, stars, files), "near-pairs", files=files)), "near-tile-links", files=files)
    # star components stand for their members from here on
    joined = stars.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(tile_links)
    classes = connected_components(joined, "a", "b", files)

    rows = sets.select("doc_id", "node", "n")
    full = rows.where("n > 0").join(classes.select(F.col("vertex").alias("node"), "component"), "node", "left")
    return rows, full.select("doc_id", "node", "n", F.coalesce("component", "node").alias("component"))


def components(docs: DataFrame) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text, ...)``: doc_id, n_shingles, component_id for every row.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``.  A row's set is its distinct 5-word shingles, the whole
    sequence if it has fewer words.  Rows link when 100 * intersection >= 80 * union; component_id is the smallest doc_id
    that is reachable.  Without words (null and empty texts, too) the set is empty, the row links with nothing and is its
    own component.  A null doc_id stays null only if no other id is reachable.  Repeated ids are rows of their own, linked
    by texts alone.  An empty table gives an empty result.
    """
    rows, full = _classes(docs)
    # written, so that the join below is one of two plain shuffles, which AQE can split where a class is large
    lowest = stash(full.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-lowest")
    linked = full.join(lowest, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which no near duplicate of smaller doc_id (null last), nor any
    repeat, stays.  Rows without words all stay."""
    _, full = _classes(docs)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("node").alias("node"))
    first = full.groupBy("component").agg(F.min(order).alias("f")).select(F.col("f.id").alias("_kept_id"), F.col("f.node").alias("_kept_node"))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), digest_column("text").alias("_node"))
    has_words = F.coalesce(F.col("_row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_node") == F.col("_kept_node"))
    kept = keyed.where(has_words).join(first, same, "left_semi").dropDuplicates(["_id", "_node"])
    return kept.select("_row.*").unionByName(keyed.where(~has_words).select("_row.*"))
