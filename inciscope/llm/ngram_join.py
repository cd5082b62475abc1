"""Exact similarity self-join on sets of word shingles, and the groups that its links make.

Two texts link when ``100 * |A and B| >= 75 * |A or B|``. Equal sets are one *node* from the start, so copies cost nothing
further. Then, with every step sure to keep each pair that links:

1. *Which nodes can link at all.* Shingles are ordered by hash. Of two nodes that link, the first shingles they share
   stand among the first quarter and a tenth of either, so a node must find a tenth of its size there in other nodes.
2. *T-occurrence search.* For the nodes left, all shingles are counted; a node needs three quarters of its shingles in
   others. Ordered by how many nodes have them, the short inverted lists of a node (all but the T - 1 longest) must hold
   whatever links with it. Lists are shuffled by shingle and merged there; they name pairs of clusters, not of nodes.
3. *Clusters.* Before that, each node is compared with one leader that it shares many shingles with, and hung on it if
   they link. Members of a cluster are connected already and are never paired with each other.
4. *Verification.* Members of the smaller cluster query an inverted index over a block of the larger one by DivideSkip:
   short lists are merged, the long ones probed by binary search, and nodes that reach the overlap are links.

The links go to ``components``. Nothing that grows with the input reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inciscope.llm.common import keyed_text
from inciscope.llm.components import components
from inciscope.llm.shingles import set_hash, shingle_sets, text_slices, words
from inciscope.session import materialise

#: Shingles shared by more nodes than this are ordered as if by so many.
MOST_COUNTED = 1000
#: Shingles by which a node looks for its leader, and rounds of looking.
LEADER_SHINGLES, LEADER_ROUNDS = 16, 2
#: Members of a cluster that one index holds.
INDEX_NODES = 512
#: Bits of the filter that tells which texts are still needed. It has a fixed size; a full one lets all texts pass, which
#: costs time and changes no result.
FILTER_BITS = 1 << 24
BUCKET_BITS = 1 << 15


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` must share with any that it links with."""
    return -(-75 * n // 100)


def links(n: int, m: int, overlap: int) -> bool:
    return 100 * overlap >= 75 * (n + m - overlap)


def visible(n: int) -> int:
    """Shared shingles that two sets, the lesser of size ``n``, show each other in step 1."""
    return max(1, -(-n // 10))


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def nodes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node) of each row; the empty set has no node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in text_slices(batches):
            sets = shingle_sets(*words(data, borders))
            nodes = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, nodes], ["doc_id", "n_shingles", "node"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long")


def distinct_sets(data: np.ndarray, borders: np.ndarray) -> dict[int, np.ndarray]:
    return {set_hash(s): s for s in shingle_sets(*words(data, borders)) if len(s)}


# ---- step 1

SEEN_ONCE, SEEN_MORE = 0, 1  # flags of a posting; a higher one is a count (plus one) that only passes through


def first_postings(docs: DataFrame) -> DataFrame:
    """(shingle, node, flag): the first shingles of each node in order of hash.

    A shingle that several nodes of one slice have goes out once, flagged, and is counted for these nodes at once: a very
    common shingle gives a posting for each slice, not for each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, borders in text_slices(batches):
            sets = distinct_sets(data, borders)
            heads = [s[: len(s) // 4 + visible(len(s))] for s in sets.values()]
            if not heads:
                continue
            node = np.repeat(np.fromiter(sets, np.int64, len(sets)), [len(h) for h in heads])
            shingle = signed(np.concatenate(heads))
            order = np.argsort(shingle, kind="stable")
            shingle, node = shingle[order], node[order]
            first = np.concatenate([[True], shingle[1:] != shingle[:-1]])
            repeated = ~first
            more = np.append(repeated[1:], False)
            counted, times = np.unique(node[repeated | more], return_counts=True)
            rows = [
                np.concatenate([shingle[first], counted]),
                np.concatenate([node[first], counted]),
                np.concatenate([np.where(more[first], SEEN_MORE, SEEN_ONCE), times + 1]).astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), ["shingle", "node", "flag"])

    return docs.mapInArrow(run, "shingle long, node long, flag int")


def shared_counts(postings: DataFrame) -> DataFrame:
    """(node, shared): of how many of its first shingles another node has each. May count high, never low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64), False)  # last shingle, its node, already counted
        for batch in batches:
            shingle, node, flag = (c.to_numpy() for c in batch.columns)
            passed = flag > SEEN_MORE
            counts = [(node[passed], flag[passed] - 1)]
            shingle, node, flag = shingle[~passed], node[~passed], flag[~passed]
            done = np.zeros(len(shingle) + len(held[0]), dtype=bool)
            done[: len(held[0])] = held[2]
            shingle, node = np.concatenate([held[0], shingle]), np.concatenate([held[1], node])
            flag = np.concatenate([np.full(len(held[0]), int(held[2])), flag])
            if len(shingle):
                first = np.concatenate([[True], shingle[1:] != shingle[:-1]])
                other = np.concatenate([[False], (shingle[1:] == shingle[:-1]) & (node[1:] != node[:-1])])
                run_of = np.cumsum(first) - 1
                shared = np.bincount(run_of, weights=other | (flag == SEEN_MORE)) > 0
                same = np.concatenate([[False], (shingle[1:] == shingle[:-1]) & (node[1:] == node[:-1])])
                counts.append((node[shared[run_of] & ~same & ~done], None))
                held = (shingle[-1:], node[-1:], bool(shared[-1]))
            named = np.concatenate([c[0] for c in counts])
            times = np.concatenate([counts[0][1], np.ones(len(named) - len(counts[0][1]), np.int64)])
            found, at = np.unique(named, return_inverse=True)
            sums = np.bincount(at, weights=times, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums)], ["node", "shared"])

    dealt = postings.repartition("shingle").sortWithinPartitions("shingle", "node")
    return dealt.mapInArrow(run, "node long, shared long").groupBy("node").agg(F.sum("shared").alias("shared"))


@dataclass(frozen=True)
class IdFilter:
    """Bits set by ids, in buckets as the SQL functions for bitmaps have them."""

    size: int
    buckets: dict[int, np.ndarray]

    def passes(self, value: int) -> bool:
        bit = value % self.size
        bucket, place = (1 + (bit - 1) // BUCKET_BITS, (bit - 1) % BUCKET_BITS) if bit else (0, 0)
        return bucket in self.buckets and bool(self.buckets[bucket][place >> 3] >> (place & 7) & 1)


def id_filter(nodes: DataFrame, size: int) -> IdFilter:
    """At most ``size`` bits reach the driver, however many nodes there are."""
    bit = F.pmod(F.col("node"), F.lit(size))
    built = nodes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    return IdFilter(size, {r["bucket"]: np.frombuffer(r["bits"], dtype=np.uint8) for r in built.collect()})


# ---- step 2


def all_postings(docs: DataFrame, bits: IdFilter) -> DataFrame:
    """(shingle, node, n): all shingles of the nodes that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # FILTER_BITS bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, borders in text_slices(batches):
            sets = {k: s for k, s in distinct_sets(data, borders).items() if shared.value.passes(k)}
            sizes = np.array([len(s) for s in sets.values()], dtype=np.int64)
            shingle = np.concatenate([*map(signed, sets.values()), np.empty(0, np.int64)])
            node, n = np.repeat(np.fromiter(sets, np.int64, len(sets)), sizes), np.repeat(sizes, sizes).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(node), pa.array(n)], ["shingle", "node", "n"])

    return docs.mapInArrow(run, "shingle long, node long, n int")


def counted(postings: DataFrame) -> DataFrame:
    """(node, n, shingle, lists): shingles that several nodes have, with how many (at most ``MOST_COUNTED``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]
        full = None  # a shingle whose first rows went out as had by MOST_COUNTED nodes
        for batch in batches:
            columns = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            shingle, node, n = columns
            if not len(shingle):
                continue
            keep = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])])
            shingle, node, n = shingle[keep], node[keep], n[keep]
            borders = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            lists = np.diff(np.append(borders, len(shingle)))
            last = borders[-1]
            count = np.repeat(lists, lists)
            if full is not None and shingle[0] == full:
                count[: lists[0]] = MOST_COUNTED
            if lists[-1] > MOST_COUNTED or full is not None and shingle[-1] == full:
                # the last row stays, to see whether its node comes again
                full, count[last:], last = int(shingle[-1]), MOST_COUNTED, len(shingle) - 1
            held = [shingle[last:], node[last:], n[last:]]
            yield _rows(node[:last], n[:last], shingle[:last], count[:last])
        shingle, node, n = held
        yield _rows(node, n, shingle, np.full(len(node), MOST_COUNTED if len(node) and full == shingle[0] else len(node)))

    def _rows(node, n, shingle, count) -> pa.RecordBatch:
        several = count > 1
        columns = (node, n, shingle, np.minimum(count, MOST_COUNTED).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c[several]) for c in columns], ["node", "n", "shingle", "lists"])

    dealt = postings.repartition("shingle").sortWithinPartitions("shingle", "node")
    return dealt.mapInArrow(run, "node long, n int, shingle long, lists int")


def rare_first(found: DataFrame) -> DataFrame:
    """(node, n, m, shingles): the ``m`` shared shingles of each node that has enough, from short lists to long ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(table: pa.Table, complete: bool) -> tuple[pa.RecordBatch, pa.Table]:
            node, n, shingle = (table.column(c).to_numpy() for c in ("node", "n", "shingle"))
            borders = np.append(np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])), len(node))
            stop = len(borders) - 1 if complete else len(borders) - 2
            rows = []
            for lo, hi in zip(borders[:stop].tolist(), borders[1 : stop + 1].tolist()):
                if hi - lo >= least_overlap(int(n[lo])):
                    rows.append((int(node[lo]), int(n[lo]), hi - lo, shingle[lo:hi].tobytes()))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            return pa.RecordBatch.from_arrays(columns, ["node", "n", "m", "shingles"]), table.slice(borders[stop])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            ready, rest = out(pa.concat_tables([rest, new]) if rest is not None else new, False)
            yield ready
        if rest is not None:
            yield out(rest, True)[0]

    dealt = found.repartition("node").sortWithinPartitions("node", "lists", "shingle")
    return dealt.mapInArrow(run, "node long, n int, m int, shingles binary")


# ---- step 3


def leaders(nodes: DataFrame) -> DataFrame:
    """(node, leader): for each node, the one that most often is the most central of those it shares a shingle with."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, m = (batch.column(c).to_numpy() for c in ("node", "n", "m"))
            least = [np.sort(np.frombuffer(b, np.int64))[:LEADER_SHINGLES] for b in batch.column("shingles").to_pylist()]
            sizes = [len(x) for x in least]
            columns = (np.concatenate([*least, np.empty(0, np.int64)]), np.repeat(m / n, sizes), np.repeat(node, sizes))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["shingle", "central", "node"])

    votes = materialise(nodes.mapInArrow(keys, "shingle long, central double, node long"), "ngram-votes")
    # the most central node of each shingle is aggregated before the shuffle, and a shingle that very many nodes have can
    # be split in the join; ties go to the lesser node
    central = F.max(F.struct("central", F.bitwise_not("node").alias("turned"), "node")).alias("best")
    elected = votes.groupBy("shingle").agg(central).select("shingle", F.col("best.node").alias("leader"))
    counts = votes.join(elected, "shingle").groupBy("node", "leader").count()
    best = counts.groupBy("node").agg(F.max(F.struct("count", F.bitwise_not("leader").alias("turned"), "leader")).alias("best"))
    return best.select("node", F.col("best.leader").alias("leader")).where("node <> leader")


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those (node, leader) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, x, b, m, y = (batch.column(c).to_pylist() for c in ("node", "n", "x", "leader", "m", "y"))
            rows = zip(n, x, m, y)
            linked = pa.array([links(n, m, _common(x, y)) for n, x, m, y in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "leader"]).filter(linked)

    sets = nodes.select("node", "n", F.col("shingles").alias("x"))
    lead = nodes.select(F.col("node").alias("leader"), F.col("n").alias("m"), F.col("shingles").alias("y"))
    return pairs.join(sets, "node").join(lead, "leader").mapInArrow(run, "node long, leader long")


def _common(x: bytes, y: bytes) -> int:
    both = np.concatenate([np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def clusters(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with their cluster and its size, and the (node, leader) links that make the clusters."""
    left, found = nodes, None
    for _ in range(LEADER_ROUNDS):
        hung = materialise(verified(leaders(left), left), "ngram-hung")
        # a leader that hangs on another itself would make a chain: its members stay with it as their cluster's name
        found = hung if found is None else materialise(found.union(hung), "ngram-hung")
        placed = found.select("node").union(found.select("leader")).distinct()
        left = nodes.join(placed, "node", "left_anti")
    # leaders may hang on leaders; a cluster is whatever hangs together
    roots = components(found.select(F.col("node").alias("a"), F.col("leader").alias("b")))
    named = nodes.join(roots, "node", "left").select("node", "n", "m", "shingles", F.coalesce("root", "node").alias("cluster"))
    sizes = named.groupBy("cluster").agg(F.count("*").alias("members"))
    return materialise(named.join(sizes, "cluster"), "ngram-clusters"), found


# ---- step 2, on clusters


def cluster_pairs(members: DataFrame) -> DataFrame:
    """(small, large): clusters that stand together in a short list and may link by their sizes.

    If the first list that two nodes share is the i-th of one of them, they share at most the ``m - i`` lists from there
    on. A link needs 3/7 of the sum of both sizes, so the other may have at most ``7/3 * (m - i) - n`` shingles (``most``).
    """

    def short_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "m", "shingles", "cluster", "members")))
            shingle, most, info = [], [], []
            for n, m, shingles, cluster, size in rows:
                # all but the T - 1 longest lists; the n - m lists of the node alone are the shortest
                head = np.frombuffer(shingles, np.int64)[: max(0, n - least_overlap(n) + 1 - (n - m))]
                shingle.append(head)
                most.append((7 * (m - np.arange(len(head))) - 3 * n) // 3)
                info.append((len(head), cluster, size, n))
            times, cluster, size, n = (np.array(c, dtype=np.int64) for c in zip(*info)) if info else [np.empty(0, np.int64)] * 4
            columns = [
                np.concatenate([*shingle, np.empty(0, np.int64)]), *(np.repeat(c, times) for c in (cluster, size, n)),
                np.concatenate([*most, np.empty(0, np.int64)]),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["shingle", "cluster", "members", "n", "most"])

    lists = members.mapInArrow(short_lists, "shingle long, cluster long, members long, n long, most long")
    merged = lists.groupBy("shingle", "cluster", "members").agg(F.min("n").alias("low"), F.max("most").alias("most"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, there = None, []
        for batch in batches:
            pairs = set()
            for shingle, cluster, _, low, most in zip(*(c.to_pylist() for c in batch.columns)):
                if shingle != last:
                    last, there = shingle, []
                for other, other_low, other_most in there:  # sorted by members: the others are smaller
                    if low <= other_most and other_low <= most:
                        pairs.add((other, cluster))
                there.append((cluster, low, most))
            columns = list(zip(*pairs)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["small", "large"])

    dealt = merged.repartition("shingle").sortWithinPartitions("shingle", "members", "cluster")
    met = dealt.select("shingle", "cluster", "members", "low", "most").mapInArrow(meet, "small long, large long")
    return met.distinct()


# ---- step 4


class Index:
    """Inverted lists over the shingles of some nodes."""

    def __init__(self, sets: list[tuple[int, int, np.ndarray]]):
        self.nodes = [node for node, _, _ in sets]
        self.sizes = np.array([n for _, n, _ in sets], dtype=np.int64)
        shingle = np.concatenate([s for _, _, s in sets])
        owner = np.repeat(np.arange(len(sets)), [len(s) for _, _, s in sets])
        order = np.lexsort((owner, shingle))
        self.shingle, self.owner = shingle[order], owner[order]

    def search(self, n: int, shingles: np.ndarray) -> int | None:
        """A node that links with a set of ``n``, by DivideSkip, or None."""
        need = least_overlap(n)
        low = np.searchsorted(self.shingle, shingles, side="left")
        length = np.searchsorted(self.shingle, shingles, side="right") - low
        low, length = low[length > 0], length[length > 0]
        if len(length) < need:
            return None
        order = np.argsort(length, kind="stable")
        low, length = low[order], length[order]
        # a node on need lists is on one at least that is not among the need - 1 longest; more lists are taken as short
        # while merging them costs less than probing them would
        divide = len(length) - (need - 1)
        while divide < len(length) and length[divide] <= 2 * math.log2(len(self.owner) + 1):
            divide += 1
        short = np.concatenate([self.owner[a : a + k] for a, k in zip(low[:divide], length[:divide])])
        candidates, counts = np.unique(short, return_counts=True)
        probes = len(length) - divide
        fits = (counts + probes >= need) & (100 * self.sizes[candidates] >= 75 * n) & (75 * self.sizes[candidates] <= 100 * n)
        candidates, counts = candidates[fits], counts[fits]
        for a, k in zip(low[divide:].tolist(), length[divide:].tolist()):
            if not len(candidates):
                return None
            owners = self.owner[a : a + k]
            place = np.minimum(np.searchsorted(owners, candidates), k - 1)
            counts = counts + (owners[place] == candidates)
            probes -= 1
            alive = counts + probes >= need
            candidates, counts = candidates[alive], counts[alive]
        for candidate, overlap in zip(candidates.tolist(), counts.tolist()):
            if links(n, int(self.sizes[candidate]), overlap):
                return self.nodes[candidate]
        return None


def cluster_links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): for each member of a small cluster and each block of a paired large one, one link if there is any."""
    blocks = F.ceil(F.col("members") / INDEX_NODES).cast("int")
    sized = members.select("cluster", F.col("members").alias("members")).distinct()
    targets = pairs.select(F.col("large").alias("cluster")).distinct().join(members, "cluster").select(
        "cluster", F.pmod(F.col("node"), blocks).cast("int").alias("block"), F.lit(0).alias("query"), "node", "n", "shingles"
    )
    asked = pairs.join(sized.withColumnRenamed("cluster", "large"), "large").select(
        "small", F.col("large").alias("target"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    )
    queries = asked.join(members, asked["small"] == members["cluster"]).select(
        F.col("target").alias("cluster"), "block", F.lit(1).alias("query"), "node", "n", "shingles"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets, index = None, [], None
        for batch in batches:
            out = []
            for cluster, block, query, node, n, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if (cluster, block) != key:
                    key, sets, index = (cluster, block), [], None
                own = np.frombuffer(shingles, np.int64)
                if not query:
                    sets.append((node, n, own))
                elif sets:
                    index = index or Index(sets)
                    found = index.search(n, own)
                    if found is not None:
                        out.append((node, found))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    dealt = targets.unionByName(queries).repartition("cluster", "block").sortWithinPartitions("cluster", "block", "query")
    return dealt.mapInArrow(run, "a long, b long")


def grouped(keyed: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, root): root names the group of linked nodes; it is null, like node, for empty sets."""
    rows = materialise(nodes_of(keyed), "ngram-nodes")
    sizes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("n_shingles").alias("n"))
    sizes = materialise(sizes, "ngram-sizes")
    enough = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("n") * 75 / 100) / 10))
    shared = shared_counts(first_postings(keyed)).join(sizes, "node").where(F.col("shared") >= enough).select("node")
    bits = id_filter(shared, FILTER_BITS)
    found = materialise(rare_first(counted(all_postings(keyed, bits))), "ngram-sets")
    members, hung = clusters(found)
    pairs = materialise(cluster_pairs(members), "ngram-pairs")
    edges = hung.select(F.col("node").alias("a"), F.col("leader").alias("b")).union(cluster_links(pairs, members))
    roots = components(edges)
    named = sizes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", "node", "root")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, component_id): component_id is the least doc_id that links reach, its own included.

    A null text is empty; texts without words have an empty set, link with nothing, not with each other, and have no
    node. Rows are told apart by their sets, so repeated rows and rows without doc_id are grouped like others; a group of
    rows without any doc_id has null. An empty table gives an empty result. Other columns are not read. Sets are told
    apart by 64-bit hashes of their shingles' 64-bit hashes.
    """
    rows = grouped(keyed_text(docs, id_col, text_col))
    rows = materialise(rows, "ngram-rows")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component"))
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return rows.join(least, "root", "left").select("doc_id", "n_shingles", "node", own.alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each group: that of the least doc_id.

    Rows without doc_id come after all others, of rows with one doc_id the least set (by hash) stays, of repeated rows
    one. Texts without words belong to no group and stay.
    """
    key, node = "_group_key", "_group_node"
    rows = grouped(keyed_text(docs, id_col, text_col)).where("root IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("first")
    chosen = rows.groupBy("root").agg(first).select(F.concat_ws(":", "first.node", "first.doc_id").alias(key))
    at = docs.columns.index(text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pyarrow.compute.fill_null(batch.column(at), "")
            whole = pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "_text"])
            for part, data, borders in text_slices([whole], whole.num_columns - 1):
                nodes = [set_hash(s) if len(s) else None for s in shingle_sets(*words(data, borders))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(nodes, pa.int64())], [*batch.schema.names, node]
                )

    schema = StructType([*docs.schema.fields, StructField(node, LongType())])
    marked = docs.mapInArrow(mark, schema)
    keyed = marked.where(F.col(node).isNotNull()).withColumn(key, F.concat_ws(":", node, F.col(id_col).cast("long")))
    kept = keyed.join(chosen, key, "left_semi")
    again = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns)))
    kept = kept.withColumn(node, again).where(F.col(node) == 1).drop(key, node)
    return kept.select(*docs.columns).union(marked.where(F.col(node).isNull()).select(*docs.columns))


def oracle() -> str:
    """Every pair that shares a shingle compared, and all links followed."""
    return r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) < 5 THEN list_filter([array_to_string(w, ' ')], lambda g: g <> '')
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM split),
        shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
            WHERE 100 * n >= 75 * (len(a.s) + len(b.s) - n)),
        reached(doc_id, root) AS (
            SELECT doc_id, doc_id FROM sets UNION SELECT y, root FROM reached JOIN links ON x = doc_id)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(root) AS component_id
        FROM sets JOIN reached USING (doc_id) GROUP BY ALL"""
