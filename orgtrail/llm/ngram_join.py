"""N-gram Jaccard join: who shares most word shingles with whom, exactly.

A document's set is that of its distinct word shingles; documents link when
``100 * intersection >= percent * union``. Documents of equal sets are one class from the
start, and everything below is about classes.

*Groups.* Shingles are hashed into groups. Two linked sets differ in at most ``d`` shingles
(a bound that follows from their sizes), so in at most ``d`` groups, and of the groups in
their fixed order one of the first ``d + 1`` that a set fills is alike in both, content and
all. A class is therefore listed under its first ``d + 1`` filled groups, which is complete, and
a listing is shared by few sets but near copies: a passage that many documents share fills a
group alone only by chance. Each octave of sizes has its own number of groups; a set near the
top of its octave is listed in the next one, too.

*Points.* Within a listing, classes are points: their counts in ``DIMENSIONS`` groups, in bytes, and what
of larger counts the bytes do not hold as one more coordinate. An R-tree over the points, folded to
``FOLDED`` coordinates, bounds the overlap of a class with all below a node by the sum of
coordinate minima with the node's upper corner, and with a single point likewise on all
coordinates. What does not reach the overlap that its size asks for is passed over.

*Rounds.* First each class takes, in each listing, its two best bounded partners; these pairs
are verified on the whole sets, and the links give components. Then all bounded pairs across
components are verified; pairs within a component can change nothing. So no link between
components is lost, and a large group of near copies does not give all its pairs. Near copies stand
in many listings together: in the second round the first of them gives the pair, and few others.

*Verification.* A pair is first bounded once more on finer counts, about one count per shingle,
which pass little but links; only the texts of what passes are read again for their whole sets.

One pass over the texts writes classes, counts and listing keys. Keys are counted, and a bitmap
of those that occur again cuts the others where they are read, before anything is sorted.
Listings with equal members are worked on once; a long listing is cut into tiles. Classes go
by 64-bit hashes of their sets, shingles by 64-bit hashes of their words. Tables that the
search writes for itself are deleted when the components are known.

Edge cases: a null text or one without words has an empty set, is linked with nothing and is
its own component; with fewer words than a shingle the whole sequence is one; rows that
repeat a doc_id are rows of one document each and share the id; a null id never names a
component unless all its members are null; texts of any length are read whole; of partners with
equal bounds the lesser hash comes first; an empty table gives no rows; columns that clash with
an output name are not read.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest
from orgtrail.operators.sides import maybe_listed, rest
from orgtrail.session import scratch_dir, scratch_released

#: Contract of the query.
WORDS, PERCENT = 4, 85
#: Coordinates of a point, and those the R-tree goes by; the excess over bytes comes on top.
DIMENSIONS, FOLDED = 128, 32
#: Points below a leaf of the R-tree, and nodes below a node.
LEAF, FAN = 32, 16
#: Best partners that a class takes in the first round.
BEST = 2
#: Classes in a tile of a long listing.
TILE = 2_000
#: Set hashes that a task remembers, so that it lists copies once.
REMEMBERED = 500_000
#: Least keys of a class by which a listing sees who has met in an earlier one.
LEAST = 32
#: Pairs that a task remembers, so that it does not repeat what several listings give.
REMEMBERED_PAIRS = 100_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for at in range(size):
        total = total * _ODD[at % 4] + hashes[at : len(words) - size + 1 + at]
    return np.unique(_mixed(total))


def set_hash(of: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(of.tobytes()) - (1 << 63)


def most_apart(a: int, b: int, percent: int = PERCENT) -> int:
    """Shingles in which linked sets of these sizes differ at most."""
    return (100 - percent) * (a + b) // (100 + percent)


def n_groups(octave: int, percent: int = PERCENT) -> int:
    """Groups of an octave: some more than linked sets in it can differ in."""
    top = (2 << octave) - 1
    most = most_apart(top, top, percent)
    return most + most // 3 + 4


def listings(of: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys of the groups under which a set is listed."""
    size = len(of)
    largest = 100 * size // percent
    apart = most_apart(size, largest, percent)
    if not apart:  # only equal sets are linked
        return np.empty(0, np.int64)
    own = size.bit_length() - 1
    keys = []
    for octave in sorted({own, largest.bit_length() - 1}):
        groups = n_groups(octave, percent)
        group = ((of >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
        # The set is sorted by hash, hence by group: a group is a run.
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        content = np.add.reduceat(_mixed(of + np.uint64(octave)), starts)
        filled = _mixed(content * _ODD[0] + group[starts] * _ODD[1] + np.uint64(octave))
        keys.append(filled[: apart + 1].view(np.int64))
        if len(starts) <= apart:  # such sets may agree in empty groups only
            lone = np.array([octave], np.uint64) * _ODD[2] + np.uint64(groups)
            keys.append(_mixed(lone).view(np.int64))
    return np.concatenate(keys)


def counts_of(of: np.ndarray) -> np.ndarray:
    """A point as bytes: counts of at most 255 each, and the sum of what is beyond in four bytes."""
    counts = np.bincount((of & np.uint64(DIMENSIONS - 1)).astype(np.int64), minlength=DIMENSIONS)
    held = np.minimum(counts, 255)
    beyond = np.array([counts.sum() - held.sum()], np.int32).view(np.uint8)
    return np.concatenate([held.astype(np.uint8), beyond])


def points_of(rows: list[bytes]) -> np.ndarray:
    """The points of ``counts_of``; the sum of minima bounds an overlap from above, the excess included."""
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), DIMENSIONS + 4)
    return np.concatenate([raw[:, :DIMENSIONS].astype(np.int32), raw[:, DIMENSIONS:].copy().view(np.int32)], axis=1)


def folded(points: np.ndarray) -> np.ndarray:
    """The points on fewer groups, each the sum of those that end in its bits."""
    whole = points.shape[1] // FOLDED * FOLDED
    groups = points[:, :whole].reshape(len(points), -1, FOLDED).sum(axis=1, dtype=np.int32)
    return np.concatenate([groups, points[:, whole:]], axis=1)


def bins_of(of: np.ndarray) -> np.ndarray:
    """Counts in as many bins as the set has shingles, up to the next power of two; at most 255 each."""
    bins = 1 << (len(of) - 1).bit_length()
    return np.minimum(np.bincount((of & np.uint64(bins - 1)).astype(np.int64), minlength=bins), 255).astype(np.uint8)


def may_link(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, percent: int = PERCENT) -> bool:
    """Whether the overlap that two sets' bins allow reaches what a link asks for."""
    if a.max() == 255 or b.max() == 255:  # such a bin may hold more than it says
        return True
    bins = min(len(a), len(b))
    # A bin of the smaller number holds all those of the larger that end in its bits.
    a, b = (x.reshape(-1, bins).sum(axis=0, dtype=np.int64) for x in (a, b))
    return int(np.minimum(a, b).sum()) * (100 + percent) >= percent * (size_a + size_b)


MEMBERS = (
    "doc_id long, n_shingles long, cls long, text_key binary, point binary, bins binary, keys array<long>"
)


def _member_rows(percent: int, words: int):
    """Rows of ``MEMBERS``; ``point``, ``bins`` and ``keys`` stand where a task meets the class first."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text, words) for text in part.column("text").to_pylist()]
                classes = [set_hash(s) if len(s) else None for s in sets]
                new = []
                for s, cls in zip(sets, classes, strict=True):
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    new.append(s if cls is not None and cls not in seen else None)
                    seen.add(cls)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(classes, pa.int64()),
                        part.column("text_key"),
                        pa.array([None if s is None else counts_of(s).tobytes() for s in new], pa.binary()),
                        pa.array([None if s is None else bins_of(s).tobytes() for s in new], pa.binary()),
                        pa.array([None if s is None else listings(s, percent) for s in new], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "cls", "text_key", "point", "bins", "keys"],
                )

    return rows


def _set_rows(words: int):
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = [shingle_set(text, words) for text in batch.slice(at, 256).column("text").to_pylist()]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_hash(s) for s in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["cls", "shingles"],
                )

    return rows


class VectorTree:
    """An R-tree over count vectors, packed by size and then by one coordinate after the other."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        fine, points = points, folded(points)
        slab = np.argsort(sizes, kind="stable")
        wide = np.argsort(-points.var(axis=0), kind="stable")[:2]
        order = [
            part[np.lexsort((points[part, wide[1]], points[part, wide[0]]))]
            for part in np.array_split(slab, max(1, round((len(slab) / LEAF) ** 0.5)))
        ]
        self.order = np.concatenate(order)
        self.points, self.fine, self.sizes = points[self.order], fine[self.order], sizes[self.order]
        self.levels = []  # from the leaves up: upper corner, least and largest size
        corner, low, high, fan = self.points, self.sizes, self.sizes, LEAF
        while not self.levels or len(corner) > 1:
            cuts = np.arange(0, len(corner), fan)
            corner, low, high = (
                np.maximum.reduceat(corner, cuts, axis=0),
                np.minimum.reduceat(low, cuts),
                np.maximum.reduceat(high, cuts),
            )
            self.levels.append((corner, low, high))
            fan = FAN

    def near(self, point: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Points whose bound reaches the overlap that a link asks for, and their bounds."""
        nodes, fine, point = np.arange(len(self.levels[-1][0])), point, folded(point[None])[0]
        for level in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[level]
            bound = np.minimum(point, corner[nodes]).sum(axis=1)
            least = np.maximum(low[nodes], -(-percent * size // 100))
            fits = (bound * (100 + percent) >= percent * (size + least)) & (high[nodes] * 100 >= percent * size)
            nodes = nodes[fits & (low[nodes] * percent <= 100 * size)]
            fan, total = (FAN, len(self.levels[level - 1][0])) if level else (LEAF, len(self.points))
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            nodes = nodes[nodes < total]
        coarse = np.minimum(point, self.points[nodes]).sum(axis=1)
        nodes = nodes[coarse * (100 + percent) >= percent * (size + self.sizes[nodes])]
        bound = np.minimum(fine, self.fine[nodes]).sum(axis=1)
        fits = bound * (100 + percent) >= percent * (size + self.sizes[nodes])
        return self.order[nodes[fits]], bound[fits]


def _arrays(column) -> np.ndarray:
    """The lists of an Arrow column as an array of arrays."""
    lists = np.empty(len(column), object)
    ends = np.cumsum(column.value_lengths().to_numpy())
    for i, part in enumerate(np.split(column.flatten().to_numpy(), ends[:-1])):
        lists[i] = part
    return lists


class Earlier:
    """Which classes of a tile have already met in a listing before the tile's own."""

    def __init__(self, keys: list[np.ndarray]):
        self.lengths = np.fromiter(map(len, keys), np.int64, len(keys))
        self.starts = np.cumsum(self.lengths) - self.lengths
        codes, self.codes = np.unique(np.concatenate(keys), return_inverse=True)
        self.marked = np.zeros(len(codes), bool)

    def met(self, one: int, others: np.ndarray) -> np.ndarray:
        """Per class of ``others`` whether one of its earlier listings is one of ``one``, too."""
        own = self.codes[self.starts[one] : self.starts[one] + self.lengths[one]]
        lengths = self.lengths[others]
        ends = np.cumsum(lengths)
        at = np.arange(lengths.sum()) + np.repeat(self.starts[others] - (ends - lengths), lengths)
        self.marked[own] = True
        shared = np.bincount(np.repeat(np.arange(len(others)), lengths), self.marked[self.codes[at]], len(others))
        self.marked[own] = False
        return shared > 0


def _pair_rows(percent: int, best: int | None):
    """Per tile of a listing the bounded pairs of different components.

    At most ``best`` of each class, repeated in other listings perhaps; without ``best`` those alone
    that have no known earlier listing in common, so that of all listings few but the first give the pair.
    """

    def partners(points, size):
        """Per point those whose bound is high enough, and the bounds."""
        if len(size) > LEAF:
            tree = VectorTree(points, size)
            for i in range(len(size)):
                yield tree.near(points[i], int(size[i]), percent)
            return
        # A tree of one leaf: its points are compared at once.
        bound = np.minimum(points[:, None], points[None]).sum(axis=2)
        fits = bound * (100 + percent) >= percent * (size[:, None] + size[None])
        for i in range(len(size)):
            near = np.flatnonzero(fits[i])
            yield near, bound[i, near]

    def of_tile(cls, label, size, side, point, earlier):
        if len(cls) < 2:
            return []
        found = []
        points = points_of(list(point))
        before = Earlier(list(earlier)) if best is None else None
        for i, (near, bound) in enumerate(partners(points, size)):
            other = label[near] != label[i]
            other &= (side[near] != side[i]) | (side[i] == 2)
            if before:  # each pair once, by its first class
                other &= near > i
            near, bound = near[other], bound[other]
            if before and len(near):
                near = near[~before.met(i, near)]
            elif not before and len(near) > best:
                near = near[np.lexsort((cls[near], -bound))[:best]]
            found += [(min(cls[i], cls[j]), max(cls[i], cls[j])) for j in near]
        return found

    def rows(batches):
        held = None  # the last tile, which the next batch may go on with
        given: set[tuple[int, int]] = set()

        def fresh(pairs):
            if len(given) >= REMEMBERED_PAIRS:
                given.clear()
            new = set(pairs) - given
            given.update(new)
            return _as_pairs(new)

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = np.stack([batch.column(n).to_numpy() for n in ("key", "low", "high")])
            columns = [batch.column(n).to_numpy() for n in ("cls", "label", "size", "side")]
            columns.append(np.array(batch.column("point").to_pylist() + [None], object)[:-1])
            columns.append(_arrays(batch.column("earlier")))
            cuts = [0, *(np.flatnonzero((tile[:, 1:] != tile[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            pairs = []
            for start, end in zip(cuts, cuts[1:], strict=False):
                now, own = tile[:, start].tolist(), [[c[start:end]] for c in columns]
                if held and held[0] == now:
                    own = [old + new for old, new in zip(held[1], own, strict=True)]
                elif held:
                    pairs += of_tile(*map(np.concatenate, held[1]))
                held = now, own
            yield fresh(pairs)
        if held:
            yield fresh(of_tile(*map(np.concatenate, held[1])))

    return rows


def _as_pairs(pairs):
    pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _link_rows(percent: int):
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keep = []
                for left, right in zip(part.column("left"), part.column("right"), strict=True):
                    left, right = left.values.to_numpy(), right.values.to_numpy()
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(left) + len(right) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def _likely_rows(percent: int):
    def rows(batches):
        for batch in batches:
            sides = (batch.column(n).to_pylist() for n in ("left", "left_size", "right", "right_size"))
            keep = [
                may_link(np.frombuffer(left, np.uint8), n, np.frombuffer(right, np.uint8), m, percent)
                for left, n, right, m in zip(*sides, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def bounded_pairs(listed: DataFrame, points: DataFrame, labels: DataFrame | None, percent: int, best: int | None) -> DataFrame:
    """Distinct pairs of classes that share a listing and pass both bounds, across components."""
    rows = listed.join(points.select("cls", "size"), "cls")
    if labels is None:
        rows = rows.withColumn("label", F.col("cls"))
    else:
        known = labels.withColumnRenamed("node", "cls")
        rows = rows.join(known, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    per_key = rows.groupBy("key").agg(
        F.min("label").alias("_first"), F.max("label").alias("_last"), F.count(F.lit(1)).alias("_all")
    )
    open_keys = per_key.filter("_first < _last").select("key", "_all")
    opened = rows.join(open_keys, "key")
    if best is None:
        opened = at_rest(opened, "open-listings")
    placed = (
        opened
        .withColumn("_tile", F.floor((F.row_number().over(Window.partitionBy("key").orderBy("size", "cls")) - 1) / TILE))
        .withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_all") - 1) / TILE))))
        .select(
            "key",
            F.least("_tile", "_with").alias("low"),
            F.greatest("_tile", "_with").alias("high"),
            # Within a tile all pairs count (2), between two tiles those across (0 and 1).
            F.when(F.col("_tile") == F.col("_with"), 2).when(F.col("_tile") < F.col("_with"), 0).otherwise(1).alias("side"),
            "cls",
            "label",
            "size",
        )
    )
    if best is None:
        # A class has as many keys as its size allows; the least of them tell most of what two have in common.
        # What they do not tell makes a pair come twice and loses none.
        keys = opened.groupBy("cls").agg(F.slice(F.array_sort(F.collect_list("key")), 1, LEAST).alias("_keys"))
        placed = placed.join(keys, "cls").withColumn("earlier", F.filter("_keys", lambda k: k < F.col("key"))).drop("_keys")
    else:
        placed = placed.withColumn("earlier", F.array().cast("array<long>"))
    pairs = (
        placed.join(points.select("cls", "point"), "cls")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInArrow(_pair_rows(percent, best), "a long, b long")
        .distinct()
    )
    left = points.select(F.col("cls").alias("a"), F.col("bins").alias("left"), F.col("size").alias("left_size"))
    right = points.select(F.col("cls").alias("b"), F.col("bins").alias("right"), F.col("size").alias("right_size"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_likely_rows(percent), "a long, b long")


def links_of(pairs: DataFrame, texts: DataFrame, members: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs that are links, tested on the whole sets of their classes."""
    pairs = at_rest(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    ids = members.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("_id"))
    # The hash of a null id is not null, so texts without an id pass like others.
    ids = rest(ids.select(F.xxhash64("_id").alias("_key")).distinct(), "ids")
    chosen = maybe_listed(texts.select("text", F.xxhash64("doc_id").alias("_key")), ids, "_key")
    every = chosen.select("text").mapInArrow(_set_rows(words), "cls long, shingles array<long>")
    sets = at_rest(every.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_link_rows(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node that it reaches, for all nodes with a link.

    Alternating stars: each node's larger, then its smaller neighbours are tied to its least
    one, until nothing changes. Every round is written to the shared folder; the run that writes it
    also tells whether the edges are still the same, so that they are not read again for that.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        # ``a`` > ``b`` in what comes in and goes out.
        if larger:
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("_least")).withColumn("_least", F.least("_least", "a"))
            tied = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        else:
            least = edges.groupBy("a").agg(F.min("b").alias("_least"))
            tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
            tied = tied.unionByName(least.select("a", F.col("_least").alias("b")))
        return tied.filter("a > b").distinct()

    def written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        seen = Observation()
        edges = at_rest(edges.observe(seen, F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")), name)
        found = seen.get
        return edges, (found.get("rows"), found.get("sum"))

    edges, before = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    while True:
        edges, now = written(star(star(edges, larger=True), larger=False), "stars")
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )


def _members_and_labels(docs: DataFrame, percent: int, words: int, text_key: Column) -> tuple[DataFrame, DataFrame]:
    """Per row ``doc_id``, ``n_shingles``, ``cls`` and ``text_key``; and ``cls`` with its component's ``label``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key.alias("text_key"))
    members_path, labels_path = scratch_dir(spark, "members"), scratch_dir(spark, "labels")
    with scratch_released(spark):
        wide = at_rest(texts.mapInArrow(_member_rows(percent, words), MEMBERS), "classes")
        members = at_rest(wide.select("doc_id", "n_shingles", "cls", "text_key"), "members", members_path)
        keyed = wide.select("cls", F.explode("keys").alias("key"))
        again = rest(keyed.groupBy("key").count().filter("count > 1").select("key"), "keys")
        # Keys that only copies of one class have, and those that share a bit, are counted out below.
        shared = at_rest(maybe_listed(keyed, again, "key").select("key", "cls").distinct(), "listings")
        alike = shared.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("cls")).alias("_sum"))
        once = alike.filter("_n > 1").groupBy("_n", "_sum").agg(F.min("key").alias("key")).select("key")
        listed = at_rest(shared.join(once, "key", "left_semi"), "distinct-listings")
        # Read from the narrow column, so that classes without a listing are cut before the shuffle.
        wanted = rest(listed.select("cls").distinct(), "listed-classes")
        first_met = wide.filter("point is not null").select("cls", F.col("n_shingles").alias("size"), "point", "bins")
        points = at_rest(
            maybe_listed(first_met, wanted, "cls").join(wanted.frame, "cls", "left_semi").dropDuplicates(["cls"]), "points"
        )
        first = bounded_pairs(listed, points, None, percent, BEST)
        first = at_rest(links_of(first, texts, members, percent, words), "first-links")
        labels = components(first)
        second = bounded_pairs(listed, points, labels, percent, None)
        second = links_of(second, texts, members, percent, words)
        labels = at_rest(components(first.unionByName(second)), "labels", labels_path)
    return members, labels.withColumnRenamed("node", "cls")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id it reaches."""
    members, labels = _members_and_labels(docs, percent, words, F.lit(None).cast("binary"))
    of_class = members.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("_id"))
    named = of_class.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    ids = named.groupBy("label").agg(F.min("_id").alias("component_id"))
    final = named.join(ids, "label").select("cls", "component_id")
    return members.join(final, "cls", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents with exactly one row of each component; those without words all stay.

    The first row stays by id, null last, then by the hash of the text; of rows that share both
    the least by its columns in their order. Other texts under the same id are not touched.
    """
    text_key = F.unhex(F.md5(F.col("text").cast("string").cast("binary")))
    members, labels = _members_and_labels(docs, percent, words, text_key)
    members = members.filter("cls is not null")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    of_class = members.groupBy("cls").agg(F.min(row).alias("_first"))
    named = of_class.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    firsts = named.groupBy("label").agg(F.min("_first").alias("first"))
    # Read from rest, so that the join can split a hot class.
    first_of = at_rest(named.join(firsts, "label").select("cls", "first"), "firsts")
    marked = members.join(first_of, "cls").select("doc_id", "text_key", (row == F.col("first")).alias("first"))
    rows = marked.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    # Rows of one id and text are of one class: all of them are the first, or none is.
    counted = rows.agg(F.first("first").alias("__first"), F.count(F.lit(1)).alias("__rows")).filter("not __first or __rows > 1")
    counted = at_rest(counted, "not-alone")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_key == F.col("__key"))
    # A null text has no words and stays, but a null key would not compare.
    alone = docs.join(counted.select("__id", "__key"), same, "left_anti")
    several = docs.join(counted.filter("__first").select("__id", "__key"), same)
    columns = [F.col(f"`{name}`") for name in docs.columns]
    one = several.groupBy("__id", "__key").agg(F.min(F.struct(*columns)).alias("__row"))
    return alone.unionByName(one.select(*[F.col(f"__row.`{name}`") for name in docs.columns]))
