"""Near duplicates by n-gram Jaccard similarity, joined over vertical fragments."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, components, dropped, small_batches, with_row_key, without, written

# Fragments of the global order, cut at equal shares of all shingles.
FRAGMENTS = 8
# Counters of shingles by hash, whatever the size of the corpus: only their logarithms are used,
# and any counts give right results.
BUCKET_BITS = 18
# Candidate pairs for each row of the prefix index up to which all of them are compared at once.
PAIRS_A_ROW = 4
# A round that leaves more than this share of the candidate pairs has not helped.
SLOW = 0.9
# Nodes of a group that are all compared at once.
SMALL = 32
# Cells of a set's parities, 64 to a number.
CELLS = 512
# Different words whose hashes a worker keeps, and shingles it counts at once.
CACHE_WORDS = 400_000
COUNTED = 1 << 20

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
# An element is a shingle's commonness (6 bits) and its hash (58 bits).
_HASH_BITS = 58


def _factor(k: int) -> np.uint64:
    """An odd number for the k-th word of a shingle."""
    return _MIX[k] if k < len(_MIX) else np.uint64(xxhash.xxh3_64_intdigest(b"%d" % k) | 1)


class _Hashes(dict):
    """64-bit hash of each word; forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and similarity as a fraction: linked when den * intersection >= num * union."""

    shingle: int
    num: int
    den: int

    def probed(self, n):
        """Elements of a set's prefix, the first of the global order: a linked set has at least
        num / den of the larger one's, so the prefixes share one."""
        return n - -(-n * self.num // self.den) + 1

    def shared(self, small, large):
        """Elements of their prefixes that linked sets of these sizes have in common at least: as
        many of the larger one come after its prefix as it lacks from ``probed``."""
        return -(-(small + large) * self.num // (self.den + self.num)) - (large - self.probed(large))


# The rule of op6, and of the pipeline's stage.
CONTRACT, STAGE = Rule(3, 90, 100), Rule(5, 80, 100)


def _scatter(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, rule: Rule = CONTRACT) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - rule.shingle + 1)
    total = np.full(n, np.uint64(min(len(h), rule.shingle)), np.uint64)
    for k in range(min(len(h), rule.shingle)):
        total = _scatter(total + h[k:k + n] * _factor(k))
    return np.unique(total)


def ordered(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A set's elements in the global order: rare shingles first, by hash among equally rare ones."""
    common = classes[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    return np.sort((common << np.uint64(_HASH_BITS)) | (s & np.uint64((1 << _HASH_BITS) - 1)))


def node_of(s: np.ndarray) -> int | None:
    """A hash of a whole set."""
    if not len(s):
        return None
    return int(_scatter(np.add.reduce(_scatter(s ^ _MIX[1]), keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def parities(s: np.ndarray) -> np.ndarray:
    """For each cell of hashes whether the set has an odd number there. An element that only one of
    two sets has changes one cell, so the cells that differ are at most the elements that do."""
    odd = np.bincount((s % np.uint64(CELLS)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _order(docs: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(classes, pivots): the logarithm of each counter, and where the global order is cut.

    Shingles of all documents are counted in 2^18 counters by hash, one partial histogram a task;
    the driver gets the sums, as many at every size of the corpus. One that very many documents
    share stands out of its counter's chance content and comes late in the order.
    """
    def count(batches):
        n, held, size = np.zeros(1 << BUCKET_BITS, np.int64), [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append((shingle_set(text, rule) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
                size += len(held[-1])
                if size > COUNTED:
                    n += np.bincount(np.concatenate(held), minlength=len(n))
                    held, size = [], 0
        if held:
            n += np.bincount(np.concatenate(held), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])

    sums = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    classes = np.zeros(1 << BUCKET_BITS, np.uint64)
    classes[bucket] = np.log2(np.maximum(n, 1)).astype(np.uint64)
    totals = np.bincount(classes[bucket].astype(np.int64), weights=n, minlength=64)
    ends = np.cumsum(totals)
    pivots = []
    for k in range(1, FRAGMENTS):
        share = ends[-1] * k / FRAGMENTS
        c = int(np.searchsorted(ends, share, side="right"))
        inside = (share - (ends[c] - totals[c])) / totals[c] if c < 64 and totals[c] else 0.0
        pivots.append((min(c, 63) << _HASH_BITS) + int(inside * (1 << _HASH_BITS)))
    return classes, np.array(pivots, dtype=np.uint64)


# What a row of the sketch is.
DOCUMENT, KEY = 0, 1


def _sketch(docs: DataFrame, rule: Rule, classes: np.ndarray) -> DataFrame:
    """One pass over the texts. DOCUMENT rows: doc_id, n (elements), node (a hash of the whole set,
    null for an empty one), parities. KEY rows: one for each element of the node's prefix, with its place. A
    task passes on the prefix of a set once (of up to ``CACHE_WORDS`` sets it remembers)."""
    names = ["kind", "doc_id", "n", "node", "parity", "key", "pos"]
    small = classes.astype(np.uint8)

    def rows(kind, doc, n, node, parity, key, pos):
        size = len(n)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(size, kind, np.int8)), pa.nulls(size, pa.int64()) if doc is None else doc, pa.array(n, pa.int64()),
            pa.array(node, pa.int64()), pa.array(parity if parity else [None] * size, pa.list_(pa.int64())),
            pa.nulls(size, pa.int64()) if key is None else pa.array(key),
            pa.nulls(size, pa.int32()) if pos is None else pa.array(pos)], names=names)

    def measure(batches):
        known, order = set(), small.astype(np.uint64)
        for batch in batches:
            sizes, nodes, parity, prefixes = [], [], [], []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                s = shingle_set(text, rule)
                node = node_of(s)
                sizes.append(len(s))
                nodes.append(node)
                parity.append(parities(s))
                if node is not None and doc is not None and node not in known:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known.add(node)
                    prefixes.append((len(s), node, ordered(s, order)[:rule.probed(len(s))]))
            if sizes:
                yield rows(DOCUMENT, batch.column("doc_id"), sizes, nodes, parity, None, None)
            if prefixes:
                n, node, keys = zip(*prefixes)
                long = [len(k) for k in keys]
                yield rows(KEY, None, np.repeat(np.array(n), long), np.repeat(np.array(node), long), None,
                           np.concatenate(keys).view(np.int64), np.concatenate([np.arange(m, dtype=np.int32) for m in long]))

    return docs.mapInArrow(measure, "kind byte, doc_id long, n long, node long, parity array<long>, key long, pos int")


def _fragments(texts: DataFrame, rule: Rule, classes: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(node, fragment, elements): the sets of documents that stand for a node, cut at the pivots."""
    names = ["node", "fragment", "elements"]
    small = classes.astype(np.uint8)

    def cut(batches):
        order = small.astype(np.uint64)
        for batch in batches:
            found, part, lists = [], [], []
            for node, text in zip(*(batch.column(c).to_pylist() for c in ("node", "text"))):
                s = shingle_set(text, rule)
                if node_of(s) == node:  # a repeated doc_id also brings texts of other sets
                    s = ordered(s, order)
                    for f, piece in enumerate(np.split(s, np.searchsorted(s, pivots))):
                        if len(piece):
                            found.append(node)
                            part.append(f)
                            lists.append(piece.view(np.int64))
            if found:
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array(part, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))], names=names)

    return texts.select("node", "text").mapInArrow(cut, "node long, fragment int, elements array<long>")


def _linked(pairs: DataFrame, fragments: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, na, b, nb) that are linked: overlaps are counted for each fragment by itself
    and summed per pair."""
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("elements").alias("x"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("elements").alias("y"))
    # Sets grow with the corpus: the same merge join at every size, split at run time where hot.
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), ["b", "fragment"])
    # A repeated doc_id may have brought a set twice.
    counted = both.select("a", "na", "b", "nb", "fragment", F.size(F.array_intersect("x", "y")).cast("long").alias("part")) \
        .groupBy("a", "na", "b", "nb", "fragment").agg(F.max("part").alias("part"))
    return counted.groupBy("a", "na", "b", "nb").agg(F.sum("part").alias("both")).where(
        F.col("both") * rule.den >= (F.col("na") + F.col("nb") - F.col("both")) * rule.num).select("a", "b")


def _grouped(held: DataFrame, rule: Rule) -> DataFrame:
    """(key, node, n, pos, own, many): the holders of a key by groups of size bands, two bands to a group.

    held: (key, node, n, pos). Sizes that can be linked are in one band or in neighbouring ones, so a node is in
    the group of its band (own) and in that of the next; two nodes meet in a group that one of them
    owns. key is a hash of key and group. many: groups of more than ``SMALL`` nodes.
    """
    width = math.log(rule.den / rule.num) * 1.0001  # a little wider: logarithms are rounded
    band = F.floor(F.log("n") / width)
    placed = held.withColumn("band", band).select(
        "key", "node", "n", "pos", "band", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("g"))
    placed = placed.select(F.xxhash64("key", "g").alias("key"), "node", "n", "pos", (F.col("band") == F.col("g")).alias("own"))
    size = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("own").alias("owned")).where("size > 1 and owned")
    return placed.join(size.select("key", (F.col("size") > SMALL).alias("many")).hint("merge"), "key")


def _alone(fragments: DataFrame) -> DataFrame:
    """(node, alone): elements that no other node here has."""
    holders = fragments.select("node", F.explode("elements").alias("e")).groupBy("e").agg(
        F.min("node").alias("node"), F.max("node").alias("high"))
    return holders.where("node = high").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def _can_link(x: str, y: str, rule: Rule):
    """Whether two rows (struct columns) of a key can be of linked sets: their sizes are near enough, as many
    elements as needed are shared with any node, places leave enough after the key, and parities
    differ in no more cells than linked sets of these sizes can."""
    n, m, pos = ([F.col(f"{z}.{c}") for z in (x, y)] for c in ("n", "m", "pos"))
    total = sum(n[1:], n[0])
    most = F.least(*pos) + 1 + F.least(*[a - p - 1 for a, p in zip(n, pos)])
    cells = [F.bit_count(F.col(f"{x}.parity")[k].bitwiseXOR(F.col(f"{y}.parity")[k])) for k in range(CELLS // 64)]
    return ((F.col(f"{x}.own") | F.col(f"{y}.own")) & (F.least(*n) * rule.den >= F.greatest(*n) * rule.num) & (F.least(*m) * (rule.den + rule.num) >= total * rule.num)
            & (most * (rule.den + rule.num) >= total * rule.num)
            & (sum(cells[1:], cells[0]) * (rule.den + rule.num) <= total * (rule.den - rule.num)))


def _candidates(met: DataFrame, rule: Rule, unseen: DataFrame | None = None) -> DataFrame:
    """(a, na, b, nb) with na <= nb, once each, of the pairs that can be linked.

    met: rows x and y that can be, for each key that two prefixes share. Linked sets share so many
    of their prefixes' keys that the larger one's rest can make up what is needed. unseen: (node,
    unseen), a node's keys that met does not have and two nodes may share.
    """
    ends = F.struct("x.n", "x.node"), F.struct("y.n", "y.node")
    shared = met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).groupBy(
        F.col("a.node").alias("a"), F.col("a.n").alias("na"), F.col("b.node").alias("b"), F.col("b.n").alias("nb")).agg(
        F.count(F.lit(1)).alias("c"))
    if unseen is not None:
        for k in ("a", "b"):
            shared = shared.join(unseen.select(F.col("node").alias(k), F.col("unseen").alias(f"unseen_{k}")).hint("merge"), k, "left")
        shared = shared.select("a", "na", "b", "nb", (F.col("c") + F.least(
            *[F.coalesce(f"unseen_{k}", F.lit(0)) for k in ("a", "b")])).alias("c"))
    # needed(nb) - 1 elements of the larger set come after its prefix.
    rest = F.ceil(F.col("nb") * rule.num / rule.den) - 1
    return shared.where((F.col("c") + rest) * (rule.den + rule.num) >= (F.col("na") + F.col("nb")) * rule.num).drop("c")


# What is known of a node at a key.
_AT = ("node", "n", "m", "pos", "own", "parity")


def _pairs_of_small(grouped: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that can be linked and meet in a group of few nodes."""
    few = grouped.where("not many").join(nodes.select("node", "parity").hint("merge"), "node").withColumn("m", F.col("n"))
    left, right = (few.select("key", F.struct(*_AT).alias(x)) for x in "xy")
    met = left.join(right.withColumnRenamed("key", "same").hint("merge"),
                    (F.col("key") == F.col("same")) & (F.col("x.node") < F.col("y.node")) & _can_link("x", "y", rule))
    return _candidates(met, rule, grouped.where("many").groupBy("node").agg(F.count(F.lit(1)).alias("unseen")))


def _links(held: DataFrame, fragments: DataFrame, rule: Rule, roots: DataFrame | None) -> DataFrame | None:
    """(node, component) of the nodes that have a linked one; roots: what is known of it.

    held: (key, node, n, m, pos, own, parity), the groups of many nodes, m elements being shared with any node.
    fragments: the nodes' sets. A pair of nodes that are known to be connected is not compared any
    more. First each node meets one of the holders of its keys, the one with most of its elements
    shared, then one drawn anew in each round, so that a family of near copies is connected by a few
    pairs a node. When a round has not helped or few pairs are left, all pairs of a key that are not
    connected are looked at.
    """
    seed, before, now = 0, float("inf"), held
    while True:
        old, now = now, now.drop("root", "most")
        if roots is None:
            now = now.withColumn("root", F.col("node"))
        else:
            now = now.join(roots.hint("merge"), "node", "left").withColumn(
                "root", F.coalesce("component", "node")).drop("component")
        groups = now.groupBy("key", "root").agg(F.count(F.lit(1)).cast("double").alias("m"))
        mixed = written(groups.groupBy("key").agg(
            F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("within"), F.count(F.lit(1)).alias("roots"),
            F.max(F.struct("m", "root")).getField("root").alias("most")).where("roots > 1"), "mixed")
        rows, pairs = mixed.agg(F.sum("m"), F.sum((F.col("m") * F.col("m") - F.col("within")) / 2)).first()
        if not rows:
            dropped(old, mixed)
            return roots
        now = written(now.join(mixed.select("key", "most").hint("merge"), "key"), "held")
        dropped(old, mixed)
        last, before = 0 < seed and pairs <= PAIRS_A_ROW * rows or pairs > SLOW * before, pairs
        row = F.struct(*_AT, "root")
        if last:
            # The nodes of a key's most frequent root never meet each other: others meet all.
            left = now.where("root <> most").select("key", row.alias("x"))
            right = now.select(F.col("key").alias("same"), row.alias("y"), (F.col("root") == F.col("most")).alias("common"))
            met, spare = left.join(right, (F.col("key") == F.col("same")) & (F.col("x.root") != F.col("y.root")) & (
                F.col("common") | (F.col("x.node") < F.col("y.node"))) & _can_link("x", "y", rule)), []
        else:
            lonely = (F.col("n") - F.col("m")) / F.col("n") if seed == 0 else F.lit(0.0)
            drawn = F.struct(lonely.alias("lonely"), F.xxhash64(F.lit(seed), "node").alias("draw"), *_AT, "root")
            hubs = written(now.groupBy("key").agg(F.min(drawn).alias("y")), "hubs")
            met, spare = now.select("key", row.alias("x")).join(hubs.hint("merge"), "key").where(
                (F.col("x.root") != F.col("y.root")) & _can_link("x", "y", rule)).select(
                "x", F.struct(*[F.col(f"y.{c}").alias(c) for c in _AT]).alias("y")), [hubs]
        chosen = written(_candidates(met, rule), "pairs")
        found = written(_linked(chosen, fragments, rule), "links")
        dropped(chosen, *spare)
        if found.limit(1).count():
            # What is known is one edge a node, whatever was compared before.
            known = found if roots is None else found.unionAll(roots.select(F.col("node").alias("a"), F.col("component").alias("b")))
            merged = components(known, "a", "b", "links")
            if roots is not None:
                dropped(roots)
            roots = merged
        dropped(found)
        if last:
            dropped(now)
            return roots
        seed += 1


def near_duplicates(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, by shingles and similarity of ``rule``.

    Documents with equal sets are one node from the start, however many copies there are. The
    global order puts rare shingles first; sets that can be linked share one of their first elements
    (prefix), at places that leave enough. Overlaps of such pairs are counted for each fragment of
    the global order and summed per pair.
    component_id is the smallest doc_id reached. Null, empty or wordless texts have no shingles
    and stay by themselves. Rows with equal doc_id are judged each by its own text. Rows with
    null doc_id belong to the component of an equal set that has an id, else to none (null). An
    empty table gives no rows. Other columns than doc_id and text are not read.

    Sets are compared as 58-bit hashes of their shingles, of one counter's class.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classes, pivots = _order(source, rule)
    sketch = written(_sketch(source, rule, classes), "sketch")
    measured = written(sketch.where(F.col("kind") == DOCUMENT).select("doc_id", "n", "node", "parity"), "documents")
    seen = measured.select("doc_id", F.col("n").alias("n_shingles"), "node")
    keys = sketch.where(F.col("kind") == KEY).select("key", "node", "n", "pos")
    several = written(keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where(
        "low < high").select("key"), "several")
    again = written(keys.join(several.hint("merge"), "key"), "held")
    held = written(again.distinct(), "held")
    dropped(several, again, sketch)
    grouped = written(_grouped(held, rule), "grouped")
    dropped(held)
    # One document for each node.
    nodes = written(measured.where("doc_id is not null and node is not null").join(
        grouped.select("node").distinct().hint("merge"), "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("parity").alias("parity")), "nodes")
    pairs = written(_pairs_of_small(grouped, nodes, rule), "pairs")
    crowd = written(grouped.where("many").drop("many"), "crowd")
    dropped(grouped)
    # Lists of documents grow with the corpus: the same merge join at every size.
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).unionAll(crowd.select("node"))
    stands = written(nodes.join(ends.distinct().hint("merge"), "node"), "stands")
    dropped(nodes)
    fragments = written(_fragments(source.join(stands.select("node", "doc_id").hint("merge"), "doc_id"), rule, classes, pivots), "fragments")
    able = stands.select("node", "n", "parity").join(_alone(fragments).hint("merge"), "node", "left").withColumn(
        "m", F.col("n") - F.coalesce("alone", F.lit(0))).where(F.col("m") * rule.den >= F.col("n") * rule.num)
    meeting = written(crowd.join(able.select("node", "m", "parity").hint("merge"), "node"), "held")
    dropped(crowd, stands)
    found = written(_linked(pairs, fragments, rule), "links")
    roots = components(found, "a", "b", "links") if found.limit(1).count() else None
    dropped(pairs, found)
    linked = _links(meeting, fragments, rule, roots)
    dropped(fragments)
    lowest = seen.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    if linked is None:
        rooted = lowest.withColumn("root", F.col("node"))
    else:
        rooted = lowest.join(linked, "node", "left").select("node", "low", F.coalesce("component", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    nodes = rooted.join(named, "root").select("node", "component_id")
    return seen.where("node is not null").join(nodes, "node").select("doc_id", "n_shingles", "component_id") \
        .unionAll(seen.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by ``STAGE``, the one with the smallest id.

    Rows without an id come after those with one and are compared like them. Of rows with equal
    doc_id and different texts each is judged by its own; equal rows (doc_id and text) are one
    group. Texts without words are in no group and all stay.
    """
    words = F.coalesce(F.col("text").rlike(r"[^\x09-\x0d ]"), F.lit(False))
    # Equal rows become one in their task first, so many of them do not meet in one.
    once = with_row_key(docs.where(words)).dropDuplicates(list(ROW))
    # Keys stand for ids in the join: unlike these they are never null, and never shared.
    keys = with_row_key(docs.where(words)).select("doc_id", "text", *ROW)
    groups = near_duplicates(keys.select(F.col(ROW[0]).alias("doc_id"), "text"), STAGE)
    groups = groups.select(F.col("doc_id").alias(ROW[0]), "component_id").distinct()
    members = written(keys.select(F.col("doc_id").cast("long").alias("id"), *ROW).distinct().join(
        groups.hint("merge"), ROW[0]), "members")
    order = F.struct(F.col("id").isNull().alias("last"), "id", *ROW)
    first = members.groupBy("component_id").agg(F.min(order).alias("first"))
    others = members.join(first, "component_id").where(
        f"{ROW[0]} <> first.{ROW[0]} or {ROW[1]} <> first.{ROW[1]}")
    return without(once, others).unionByName(docs.where(~words))
