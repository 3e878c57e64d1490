"""Sharding of documents by best-fit-decreasing bin packing.

Indivisible groups (documents with equal texts) are packed into fixed-capacity shards.  The large ones (a bounded number:
those of at least one part in ``head_per_shard`` of a shard) are placed one by one in the driver, largest first, each into
the tightest remaining capacity that a balanced tree finds.  What follows in decreasing order is small beside every shard,
and best fit then fills the tightest shard to its end before it turns to the next; so the small groups are laid out end to
end, larger size classes first, over the remaining capacities, tightest first, by a distributed running sum.  Where a
group would cross from one shard to the next (at most one for each shard), it is put back and placed by the tree, too.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import running_sums, stash

SCHEMA = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


class CapacityTree:
    """Ordered set of (remaining capacity, bin) as an AA tree: add, remove, tightest fit and roomiest in O(log n)."""

    __slots__ = ("_root",)

    def __init__(self) -> None:
        self._root: list | None = None  # node: [key, level, left, right]

    @staticmethod
    def _skew(node):
        left = node[2]
        if left is not None and left[1] == node[1]:
            node[2], left[3] = left[3], node
            return left
        return node

    @staticmethod
    def _split(node):
        right = node[3]
        if right is not None and right[3] is not None and right[3][1] == node[1]:
            node[3], right[2] = right[2], node
            right[1] += 1
            return right
        return node

    def add(self, key: tuple[int, int]) -> None:
        def insert(node):
            if node is None:
                return [key, 1, None, None]
            side = 2 if key < node[0] else 3
            node[side] = insert(node[side])
            return self._split(self._skew(node))

        self._root = insert(self._root)

    def remove(self, key: tuple[int, int]) -> None:
        def level(node):
            return 0 if node is None else node[1]

        def delete(node, key):
            if node is None:
                return None
            if key == node[0]:
                if node[2] is None:
                    return node[3]
                if node[3] is None:
                    return node[2]
                heir = node[3]
                while heir[2] is not None:
                    heir = heir[2]
                node[0] = heir[0]
                node[3] = delete(node[3], heir[0])
            else:
                side = 2 if key < node[0] else 3
                node[side] = delete(node[side], key)
            lowest = min(level(node[2]), level(node[3])) + 1
            if lowest < node[1]:
                node[1] = lowest
                if node[3] is not None and lowest < node[3][1]:
                    node[3][1] = lowest
            node = self._skew(node)
            if node[3] is not None:
                node[3] = self._skew(node[3])
                if node[3][3] is not None:
                    node[3][3] = self._skew(node[3][3])
            node = self._split(node)
            if node[3] is not None:
                node[3] = self._split(node[3])
            return node

        self._root = delete(self._root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin of least remaining capacity that still takes ``size``."""
        node, best = self._root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def roomiest(self) -> tuple[int, int]:
        node = self._root
        while node[3] is not None:
            node = node[3]
        return node[0]


class Bins:
    """Bins that take items by best fit.

    With ``capacity``, bins of that capacity are opened as needed (a larger item has a bin of its own).  With ``shards``,
    that many bins share the total equally: the first items, as long as they are above the fair share of what is left, take
    a bin each, and what fits no bin enters the roomiest one.
    """

    def __init__(self, capacity: int | None = None, shards: int | None = None, total: int = 0) -> None:
        if shards is None and (capacity is None or capacity <= 0):
            raise ValueError("capacity must be positive where shards isn't given")
        self.capacity, self.shards, self.left, self.opened = capacity, shards, total, 0
        self.room: dict[int, int] = {}
        self.tree: CapacityTree | None = None if shards else CapacityTree()

    def _share_out(self) -> None:
        """Open the shards that no oversized item took."""
        self.tree, free = CapacityTree(), self.shards - self.opened
        for b in range(self.opened, self.shards):
            self.room[b] = -(-self.left // free)
            self.tree.add((self.room[b], b))
        self.opened = self.shards

    def place(self, size: int) -> int:
        if self.tree is None:
            free = self.shards - self.opened
            if free > 1 and size * free > self.left:
                self.left, self.opened = self.left - size, self.opened + 1
                self.room[self.opened - 1] = 0
                return self.opened - 1
            self._share_out()
        found = self.tree.tightest(size)
        if found is None and self.shards is None:
            found = (max(self.capacity, size), self.opened)
            self.opened += 1
        else:
            found = found or self.tree.roomiest()
            self.tree.remove(found)
        self.room[found[1]] = found[0] - size
        self.tree.add((self.room[found[1]], found[1]))
        return found[1]

    def spread(self, size: int) -> list[tuple[int, int]]:
        """Stretches (room, bin), tightest first, that ``size`` is laid over in small pieces; all that room is used up."""
        if self.tree is None:
            self._share_out()
        out, held = [], 0
        rooms = sorted((r, b) for b, r in self.room.items() if r > 0)
        if self.shards is not None:  # where a bin holds more than its share, the others share what that leaves
            over = sum(r for r, _ in rooms) - size
            for at, (r, _) in enumerate(rooms):
                less = over // (len(rooms) - at)
                if less < r:
                    rooms = [(r - less, b) for r, b in rooms[at:]]
                    break
                over -= r
        for room, b in rooms:
            if held >= size:
                break
            out.append((room, b))
            held += room
        while held < size and self.shards is None:
            out.append((self.capacity, self.opened))
            self.room[self.opened] = self.capacity
            self.tree.add((self.capacity, self.opened))
            held += self.capacity
            self.opened += 1
        return out

    def used(self, b: int, size: int) -> None:
        """``size`` more is in bin ``b``."""
        if size:
            self.tree.remove((self.room[b], b))
            self.room[b] -= size
            self.tree.add((self.room[b], b))


def best_fit_decreasing(items: Iterable[tuple[Hashable, int]], capacity: int | None = None, shards: int | None = None) -> dict[Hashable, int]:
    """Bin of each (name, size) item by :class:`Bins`, largest first; ties go by name, then by the lower bin."""
    order = sorted(items, key=lambda x: (-x[1], str(x[0])))
    bins = Bins(capacity, shards, sum(size for _, size in order))
    return {name: bins.place(size) for name, size in order}


def pack_shards(docs: DataFrame, shards: int | None = 16, capacity: int | None = None, head_per_shard: int = 4096, rows_per_cell: int = 1000) -> DataFrame:
    """Put every row of ``docs(doc_id, text, ...)`` into a shard: one of ``shards`` of near-equal bytes, or, with ``shards``
    None, of as few shards of ``capacity`` bytes as best-fit-decreasing packing takes (a group above it has its own).

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32 (unsigned), law ('bytes'), shard, slot (gapless
    from 0 within the shard) and grown_shard (null).  Equal texts stay in one shard.  A null text has no bytes: size 1,
    crc32 0, grouped with empty texts.  Rows that repeat, or have a null doc_id, are rows of their own.  An empty table
    gives an empty result; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    Bins(capacity, shards)  # refuses what can't be packed
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stash(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
        ),
        "shard-rows",
    )
    groups = stash(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "shard-groups")
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("rows")).first()
    if total is None:
        return spark.createDataFrame([], SCHEMA)
    wanted = shards or -(-total // capacity)
    pieces = max(64, min(head_per_shard, (1 << 18) // wanted))
    # at most 2 * pieces * wanted groups have that part of the bytes or rows; of each, the driver holds a name and a number
    part = F.lit(pieces * wanted)
    is_head = (F.col("bytes") * part >= F.lit(total)) | (F.col("rows") * part >= F.lit(n_rows))
    head = sorted(((r[0], r[1]) for r in groups.where(is_head).select("group", "bytes").collect()), key=lambda x: (-x[1], x[0]))
    bins = Bins(capacity, shards, total)
    placed = [(name, bins.place(size)) for name, size in head]

    # the others: cells of one size class and a part of its groups, laid out one after the other
    tail = groups.where(~is_head)
    n_tail = tail.count()
    chosen = tail.select("group", "bytes", F.lit(None).cast("int").alias("shard")).where("false")
    if n_tail:
        salts = max(1, n_tail // 200)
        cell = [F.length(F.bin("bytes")).alias("class"), F.pmod(F.xxhash64("group"), F.lit(salts)).alias("salt")]
        tail = tail.select("group", "bytes", *cell)
        cells = running_sums(tail.groupBy("class", "salt").agg(F.sum("bytes").alias("held")), [F.col("class").desc(), F.col("salt")], "held")
        within = Window.partitionBy("class", "salt").orderBy(F.col("bytes").desc(), "group").rowsBetween(Window.unboundedPreceding, -1)
        begin = F.col("before") + F.coalesce(F.sum("bytes").over(within), F.lit(0))
        laid = tail.join(cells.select("class", "salt", "before"), ["class", "salt"]).select("group", "bytes", begin.alias("begin"))
        stretches = bins.spread(total - sum(size for _, size in head))
        bounds, at = [], 0
        for room, b in stretches:
            bounds.append((b, at, at + room))
            at += room
        laid = stash(_into(laid, bounds), "shard-tail")
        crossing = F.col("begin") + F.col("bytes") > F.col("upto")
        filled = laid.where(~crossing).groupBy("bin").agg(F.sum("bytes")).collect()  # a row for each shard
        for b, size in filled:
            bins.used(b, size)
        over = sorted(((r[0], r[1]) for r in laid.where(crossing).select("group", "bytes").collect()), key=lambda x: (-x[1], x[0]))  # one for each shard, at most
        placed += [(name, bins.place(size)) for name, size in over]
        chosen = laid.where(~crossing).select("group", F.col("bin").alias("shard"))
    # rows of large groups meet their plan where they are, the others in a shuffle without hot keys; a cell is a part of the
    # small groups, or of one large group
    schema = T.StructType([T.StructField("group", T.StringType()), T.StructField("shard", T.IntegerType())])
    large = F.broadcast(spark.createDataFrame(placed[: len(head)], schema).join(groups.where(is_head), "group").select("group", "shard", F.ceil(F.col("rows") / rows_per_cell).alias("salts")))
    small = stash(chosen.select("group", "shard").unionByName(spark.createDataFrame(placed[len(head) :], schema)), "shard-plan")
    known = rows.join(large, "group", "left")
    of_large = known.where("shard is not null").select(
        "doc_id", "size", "text_crc32", "shard", F.concat(F.col("group"), F.lit("/"), F.pmod(F.xxhash64("doc_id", "size"), F.col("salts")).cast("string")).alias("cell")
    )
    of_small = known.where("shard is null").drop("shard", "salts").join(small, "group").select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("group"), F.lit(max(1, n_rows // rows_per_cell))).cast("string").alias("cell")
    )
    placed_rows = of_large.unionByName(of_small)
    placed_rows = stash(placed_rows, "shard-placed")
    cells = running_sums(placed_rows.groupBy("shard", "cell").agg(F.count("*").alias("n")), [F.col("shard"), F.col("cell")], "n")
    first = cells.groupBy("shard").agg(F.min("before").alias("first"))
    cells = cells.join(first, "shard").select(F.col("shard").alias("s"), F.col("cell").alias("c"), (F.col("before") - F.col("first")).alias("offset"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32")
    return placed_rows.join(cells, (F.col("shard") == F.col("s")) & (F.col("cell") == F.col("c"))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _into(laid: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """``laid`` with the bin of the stretch that ``begin`` is in, and that stretch's end.  The stretches hold all of ``laid``."""
    spark = laid.sparkSession
    starts = [b[1] for b in bounds]
    place = F.lit(0)
    if len(bounds) <= 64:
        for s in starts[1:]:
            place = place + (F.col("begin") >= s).cast("int")
        of = lambda k: F.get(F.array(*[F.lit(b[k]) for b in bounds]), F.col("k"))
        return laid.withColumn("k", place).select("group", "bytes", "begin", of(0).alias("bin"), of(2).alias("upto"))
    table = spark.createDataFrame(bounds, "bin int, low long, upto long")
    step = max(1, bounds[-1][2] // len(bounds))
    grid = table.select("bin", "low", "upto", F.explode(F.sequence(F.floor(F.col("low") / step), F.floor((F.col("upto") - 1) / step))).alias("g"))
    return laid.withColumn("g", F.floor(F.col("begin") / step)).join(grid, "g").where("begin >= low and begin < upto").select("group", "bytes", "begin", "bin", "upto")
