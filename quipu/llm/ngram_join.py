"""N-gram Jaccard join with prefix trees.

Two documents link when the Jaccard similarity of their sets of word 5-grams is at least
``PERCENT`` / 100.  Sets are ordered globally: 5-grams that few documents hold come first.

1. One pass counts the 5-grams of all documents in a sketch of fixed size (the order only
   steers the work, any order gives the same links) and hashes each set; equal sets are one
   class from here on.
2. Two sets that link share one of the first n - ceil(0.8 n) + 1 elements of either, and
   their sizes are in the same or neighbouring bands.  Rows (element, class) of these prefixes
   are sorted by element; of each element and band the smallest class is the leader, and all
   classes that meet a leader form the leader's group.  So every link lies inside a group.
   A set leaves a group if its profile (counts of its elements by parts of the hash range)
   shows that it can't link with any other there.
3. The sets of a group are stored in a prefix tree.  Each set walks down the tree, sharing
   the overlap so far with all sets below a node, and leaves a subtree whose remaining lengths
   cannot reach the similarity any more, or whose sets are all connected with it already.
4. Components of the links found, in distributed rounds.

How it scales.  Only prefixes are shuffled, copies only once for each task; texts move once
more for classes that share an element.  In a first round a class meets the group of its
smallest leader only; after that, groups whose sets are all connected are left out.  A group
beyond ``GRAMS`` elements is dealt over blocks that all hold the leader; only the sets that
are not connected with the leader then meet the other blocks.  So a large group of near
copies costs a walk for each member and not all pairs, and no task holds an unbounded group.

5-grams and sets are compared by 64-bit hashes.  Defined results: a document without words
has an empty set and links with nothing; one of fewer than five words has its whole sequence
as one element; rows of a null id take part, but name no component; repeated rows link.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import U64, RunHashes, byte_list, connected, cut_rows, groups_of, id_text, mix64, row_key, table_of
from quipu.llm.span_dedup import word_hashes
from quipu.operators.corpus import pin_table

SHINGLE, PERCENT = 5, 80
BITS, PART = 20, 1 << 12      # slots of the sketch (a power of two); slots in a row of it
GRAMS = 2_000_000             # elements in one block of a group
SLOTS = 256                   # counts in a set's profile
_SETS = pa.schema([("rk", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("profile", pa.binary())])
_PREFIX = pa.schema([("gram", pa.int64()), ("class", pa.int64()), ("band", pa.int16())])


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct word 5-grams; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, U64)
    return np.unique(RunHashes(word_hashes(words)).all(min(SHINGLE, len(words))))


def slot_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - BITS)).astype(np.int64)


def class_of(grams: np.ndarray) -> int:
    return int(mix64(grams + U64(0x5851F42D4C957F2D)).sum(dtype=U64).astype(np.int64))


def profile_of(grams: np.ndarray) -> bytes:
    """How many elements fall into each of ``SLOTS`` parts of the hashes' range: two sets share
    no more than the sum of the smaller counts."""
    counts = np.bincount((grams & U64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    return counts.astype("<u4").astype("<u2" if counts.max(initial=0) < 1 << 16 else "<u4").tobytes()


def plausible(profiles: list[bytes], n: np.ndarray) -> np.ndarray:
    """Which sets may link with any other of a group, by the bound of their profiles."""
    x = np.stack([np.frombuffer(p, "<u2" if len(p) == 2 * SLOTS else "<u4").astype(np.int32) for p in profiles])
    may = np.zeros(len(x), bool)
    for i in range(len(x)):
        if i >= 64 and may[i]:
            continue  # most sets of a group of near copies are found by the first few
        shared = np.minimum(x[i], x).sum(1)
        fits = (100 + PERCENT) * shared >= PERCENT * (n + n[i])
        fits[i] = False
        may |= fits
        may[i] |= fits.any()
    return may


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketch = np.zeros(1 << BITS, np.int64)
    for batch in cut_rows(batches, "text"):
        sets = [shingles(t or b"") for t in byte_list(batch.column("text"))]
        if any(map(len, sets)):
            sketch += np.bincount(slot_of(np.concatenate(sets)), minlength=1 << BITS)
        n = len(sets)
        yield table_of({"rk": batch.column("rk"), "doc_id": batch.column("doc_id"), "n": list(map(len, sets)),
                        "class": [class_of(s) if len(s) else None for s in sets], "part": [None] * n, "counts": [None] * n,
                        "profile": [profile_of(s) if len(s) else None for s in sets]}, _SETS)
    parts = [(i, sketch[i * PART:(i + 1) * PART]) for i in range(len(sketch) // PART)]
    parts = [(i, zlib.compress(x.astype("<i8").tobytes(), 1)) for i, x in parts if x.any()]
    none = [None] * len(parts)
    yield table_of({"rk": none, "doc_id": none, "n": none, "class": none,
                    "part": [i for i, _ in parts], "counts": [x for _, x in parts], "profile": none}, _SETS)


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(counts), "<i8")
            total[part] = total[part] + x if part in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["part", "counts"])


class _Node:
    """Elements on the way from the parent, sets lo..hi below, and their lengths' bounds."""

    __slots__ = ("segment", "depth", "lo", "hi", "least", "most", "children")


class PrefixTree:
    """Ordered sets in a trie whose unbranched ways are one node each."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        """sets: ascending numbers, in the global order."""
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        shared = np.zeros(max(0, len(sets) - 1), np.int64)
        for i, (a, b) in enumerate(zip(self.sets, self.sets[1:])):  # noqa: B905
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared[i] = differ[0] if len(differ) else n
        self.root = self._node(0, len(sets), 0)
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.hi - node.lo == 1:
                continue
            between = shared[node.lo:node.hi - 1]
            cuts = [node.lo, *(np.flatnonzero(between == node.depth) + node.lo + 1).tolist(), node.hi]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                upto = len(self.sets[lo]) if hi - lo == 1 else int(shared[lo:hi - 1].min())
                child = self._node(lo, hi, node.depth, upto)
                node.children.append(child)
                todo.append(child)

    def _node(self, lo: int, hi: int, start: int, end: int = 0) -> _Node:
        node = _Node()
        node.segment, node.depth, node.lo, node.hi, node.children = self.sets[lo][start:end] if hi > lo else None, end, lo, hi, []
        node.least, node.most = (int(self.sizes[lo:hi].min()), int(self.sizes[lo:hi].max())) if hi > lo else (0, 0)
        return node

    def links(self, part: np.ndarray, first: int | None = None) -> Iterator[tuple[int, int]]:
        """Links that connect sets of different parts (labels by the order of the input),
        which become one part; those that would connect nothing new are not looked for."""
        part = part[self.order]
        probes = list(range(len(self.sets)))
        if first is not None:
            probes.sort(key=lambda i: self.order[i] != first)
        has = np.zeros(max((int(s[-1]) for s in self.sets if len(s)), default=0) + 1, bool)
        for x in probes:
            own, n = self.sets[x], len(self.sets[x])
            if (part == part[x]).all():
                return
            has[own] = True
            todo = [(child, 0) for child in self.root.children] or [(self.root, 0)]
            while todo:
                node, overlap = todo.pop()
                if (part[node.lo:node.hi] == part[x]).all():
                    continue
                if len(node.segment):
                    overlap += int(np.count_nonzero(has[node.segment]))
                    left = n - int(np.searchsorted(own, node.segment[-1], "right"))
                else:
                    left = n - overlap if not node.depth else n - int(np.searchsorted(own, self.sets[node.lo][node.depth - 1], "right"))
                size = min(max(node.depth + left, node.least), node.most)
                if (100 + PERCENT) * (overlap + min(left, size - node.depth)) < PERCENT * (n + size):
                    continue
                if not node.children:
                    part[part == part[node.lo]] = part[x]
                    yield self.order[x], self.order[node.lo]
                else:
                    todo += [(child, overlap) for child in node.children]
            has[own] = False


def band_of(n: int) -> int:
    """Sizes of sets that link are in the same band or in neighbouring ones."""
    return int(np.log(n) / np.log(100 / PERCENT) + 1e-9)


def group_links(group: pa.Table, counts: np.ndarray) -> list[tuple[int, int]]:
    """Links inside one block of a group, by a walk of each set down the block's prefix tree."""
    ids, component = (group.column(c).to_numpy() for c in ("class", "component"))
    ids, at = np.unique(ids, return_index=True)
    if len(ids) < 2 or (component[at] == component[at[0]]).all():
        return []
    raw = group.column("grams").to_pylist()
    grams = [np.frombuffer(raw[i], "<u8") for i in at.tolist()]
    known, number = np.unique(np.concatenate(grams), return_inverse=True)
    place = np.empty(len(known), np.int64)
    place[np.lexsort((known, counts[slot_of(known)]))] = np.arange(len(known))  # the global order, numbered within the block
    sets = [np.sort(x) for x in np.split(place[number], np.cumsum([len(g) for g in grams])[:-1])]
    leader = np.flatnonzero(ids == group.column("leader")[0].as_py())
    found = PrefixTree(sets).links(component[at].copy(), int(leader[0]) if len(leader) else None)
    return [(int(ids[i]), int(ids[j])) for i, j in found]


def in_blocks(pairs: DataFrame, grams: int) -> DataFrame:
    """Rows (leader, class, n, ..) dealt over blocks of about ``grams`` elements; the leader is
    in every block of its group."""
    size = pairs.groupBy("leader").agg(F.ceil(F.sum("n") / grams).cast("int").alias("blocks"))
    placed = pairs.join(size, "leader").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    return placed.withColumn("block", F.explode(F.when(F.col("class") == F.col("leader"), F.sequence(F.lit(0), F.col("blocks") - 1))
                                                .otherwise(F.array("block"))))


def linked_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grams: int = GRAMS) -> DataFrame:
    """(rk, doc_id, n, part) for every row of ``docs``: its row key, its set's size and the
    label of what it is connected with, null for an empty set."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumn("rk", row_key())
    made = pin_table(rows.mapInArrow(_sets, "rk long, doc_id long, n long, class long, part int, counts binary, profile binary"), "sets")
    sets = made.filter("part is null").select("rk", "doc_id", "n", "class")
    counts = np.zeros(1 << BITS, np.int64)
    for r in (made.filter("part is not null").select("part", "counts").repartition("part")
              .mapInArrow(_add_up, "part int, counts binary").collect()):
        counts[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(bytes(r["counts"]), "<i8")
    often = spark.sparkContext.broadcast(counts)

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in cut_rows(batches, "text"):
            out, classes, bands = [], [], []
            for text in byte_list(batch.column("text")):
                g = shingles(text or b"")
                if not len(g) or (c := class_of(g)) in seen:
                    continue
                seen.add(c)
                out.append(g[np.lexsort((g, often.value[slot_of(g)]))[:prefix_size(len(g))]])
                classes.append(np.full(len(out[-1]), c))
                bands.append(np.full(len(out[-1]), band_of(len(g)), np.int16))
            if out:
                yield table_of({"gram": np.concatenate(out).view(np.int64), "class": np.concatenate(classes), "band": np.concatenate(bands)}, _PREFIX)

    def lead(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(leader, class) from rows sorted by (gram, class): the smallest class of each gram and
        band leads.  A set is in its own band and the next, so sets that link meet in one."""
        last, held = None, {}
        for batch in batches:
            g, c, band = (np.tile(batch.column(x).to_numpy(), 2) for x in ("gram", "class", "band"))
            if not len(g):
                continue
            band = band.astype(np.int64)
            band[len(band) // 2:] += 1
            begins = g[0]
            order = np.lexsort((c, band, g))
            g, c, band = g[order], c[order], band[order]
            new = np.append(True, (g[1:] != g[:-1]) | (band[1:] != band[:-1]))
            lead_of = c[new][np.cumsum(new) - 1]
            if begins == last:  # the first gram goes on from the batch before
                for i in np.flatnonzero(g == last).tolist():
                    lead_of[i] = held.get(int(band[i]), lead_of[i])
            ends = g == batch.column("gram")[-1].as_py()
            now = dict(zip(band[ends].tolist(), lead_of[ends].tolist(), strict=True))
            held = held | now if batch.column("gram")[-1].as_py() == last else now
            last = batch.column("gram")[-1].as_py()
            pairs = np.unique(np.stack([lead_of, c], 1)[lead_of != c], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["leader", "class"])

    shared = (rows.select("text").filter("text is not null").mapInArrow(prefixes, "gram long, class long, band short")
              .repartition("gram").sortWithinPartitions("gram", "class").mapInArrow(lead, "leader long, class long"))
    pairs = pin_table(shared.distinct(), "groups")
    pairs = pairs.unionByName(pairs.select("leader", F.col("leader").alias("class")).distinct())
    one = (made.join(pairs.select("class").distinct(), "class", "left_semi").groupBy("class")
           .agg(F.min("rk").alias("rk"), F.min("n").alias("n"), F.any_value("profile").alias("profile")))

    def may_link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets of a group that may link with another; all of a group of several blocks."""
        for group in groups_of(batches, ["leader", "block"]):
            if group.column("blocks")[0].as_py() == 1:
                group = group.filter(pa.array(plausible(group.column("profile").to_pylist(), group.column("n").to_numpy())))
            yield from group.select(["leader", "class", "n", "rk"]).to_batches()

    pairs = (in_blocks(pairs.join(one, "class"), grams).repartition("leader", "block").sortWithinPartitions("leader", "block")
             .mapInArrow(may_link, "leader long, class long, n long, rk long"))
    pairs = pin_table(pairs.distinct(), "pairs")
    # each class first meets the smallest of its leaders only
    home = pairs.groupBy("class", "n", "rk").agg(F.min("leader").alias("leader"))
    home = home.unionByName(pairs.filter("class = leader").join(home.select("leader").distinct(), "leader").select("class", "n", "rk", "leader")).distinct()
    home = in_blocks(home, grams)

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            got = [shingles(t).astype("<u8").tobytes() for t in byte_list(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("homes"), pa.array(got, pa.binary())], names=["class", "homes", "grams"])

    def walk(placed: DataFrame, *block: str) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in groups_of(batches, ["leader", *block]):
                found = group_links(group, often.value)
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        return (placed.select("leader", "class", "component", "grams", *block).repartition("leader", *block)
                .sortWithinPartitions("leader", *block).mapInArrow(run, "a long, b long"))

    homes = home.groupBy("class", "rk").agg(F.collect_list(F.struct("leader", "block")).alias("homes"))
    members = pin_table(rows.select("rk", "text").join(homes.hint("shuffle_hash"), "rk")
                        .dropDuplicates(["rk"]).select("class", "homes", "text").mapInArrow(load, "class long, homes array<struct<leader:long,block:int>>, grams binary"), "members")
    at_home = members.select("class", F.col("class").alias("component"), "grams", F.explode("homes").alias("at")).select("*", "at.*")
    links = pin_table(walk(at_home, "block"), "links")
    parts = connected(links).withColumnRenamed("node", "class")
    # groups that hold more than one component still may hold links
    labelled = pairs.drop("rk").join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    open_groups = (labelled.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                   .filter("low < high").select("leader"))
    placed = pin_table(in_blocks(labelled.join(open_groups, "leader"), grams), "open")
    sets_of = members.select("class", "grams")
    more = pin_table(walk(placed.join(sets_of, "class"), "block"), "more")
    if not more.isEmpty():
        links = pin_table(links.unionByName(more), "links")
        parts = connected(links).withColumnRenamed("node", "class")
    large = placed.filter("blocks > 1")
    if not large.isEmpty():
        # what isn't connected with its leader meets every block of the group
        large = large.drop("component").join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
        heads = large.filter("class = leader").select("leader", F.col("component").alias("main")).distinct()
        rest = large.join(heads, "leader").filter("component <> main").select("leader", "class", "component", "n").distinct()
        much = rest.groupBy("leader").agg(F.ceil(F.sum("n") / grams).cast("int").alias("rests"))
        rest = rest.join(much, "leader").withColumn("rest", F.pmod(F.xxhash64("class", F.lit(1)), "rests").cast("int"))
        groups = large.select("leader", "blocks").distinct()
        visit = rest.join(groups, "leader").select("leader", "class", "component", "rest",
                                                   F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        hosts = large.join(much, "leader").select("leader", "class", "component", "block",
                                                  F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"))
        both = visit.unionByName(hosts).distinct().join(sets_of, "class")
        parts = connected(links.unionByName(walk(both, "block", "rest"))).withColumnRenamed("node", "class")
    return (sets.join(parts, "class", "left")
            .select("rk", "doc_id", "n", F.coalesce("component", "class").alias("part")))


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grams: int = GRAMS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    named = linked_parts(docs, id_col, text_col, grams)
    lowest = named.filter("part is not null").groupBy("part").agg(F.min("doc_id").alias("lowest"))
    return named.join(lowest, "part", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                     F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without all but one of each group of connected
    documents: the one of the smallest id stays.  Documents without words stay."""
    named = linked_parts(docs, id_col, text_col)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rk"))["rk"]
    one = named.filter("part is not null").groupBy("part").agg(best.alias("rk")).select("rk", F.lit(True).alias("grouped"))
    kept = one.unionByName(named.filter("part is null").select("rk", F.lit(False).alias("grouped")).distinct())
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("whole", row_key().alias("rk")).join(kept, "rk")
    single = F.when(F.col("grouped"), F.lit(0)).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("single", single).dropDuplicates(["rk", "single"]).select("whole.*")
