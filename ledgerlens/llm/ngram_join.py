"""N-gram Jaccard join by a prefix tree.

Every text becomes the set of its word n-grams. Two sets link when
``den * |A & B| >= num * |A | B|``. The join is exact:

1. A fixed-size count sketch of all n-grams gives one global order, rare
   n-grams first (any order is right; a rare-first one makes short lists).
2. Texts with equal sets collapse to one representative.
3. Linked sets share an n-gram in their *prefixes* (the first
   ``n - ceil(t*n) + 1`` n-grams in global order). Prefix n-grams without a
   second holder of linkable size are dropped, those held by the
   same sets are kept once, with their number as weight.
4. The kept prefixes meet in blocks, one per prefix n-gram, and a trie of
   them finds the pairs whose prefixes overlap enough for a link; a hot
   n-gram is split into pairs of bounded chunks.
5. Sets connected by such pairs form candidate groups. A group of bounded
   size is one block to which each of its sets travels once, whole; a larger
   one is split by prefix n-gram (and chunks) again, so no block grows with
   the data. There the whole sets go into a trie.

In both steps a probe walks the trie, shares the partial overlap of common
paths and leaves a subtree when the overlap so far plus the remaining length
cannot reach the required overlap. A block emits one row per connected set,
never all pairs; step 5 also counts the links of every set, each pair in the
one block of the first prefix n-gram it shares (or of its group), a set as
often as it has copies.

6. Connected components of the links, and the sum of every set's counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    SLOT_BITS, Stages, binary_text, by_key, connected_components, hash_words, in_bitmap, lower_ascii, ready,
    slot_bitmap, window_hashes,
)

#: slots of the count sketch (2 bytes each when broadcast: 1 MB, whatever the input)
SKETCH_BITS = 19
#: sets, and n-grams in all of them, that one block may hold
BLOCK_SETS, BLOCK_GRAMS = 2000, 4_000_000


def ngram_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes; a text of fewer words is one n-gram."""
    words = lower_ascii(text).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(window_hashes(hash_words(words), min(n, len(words))))


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _order(grams: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Global order: sketch rank, then hash (the input is sorted by hash)."""
    return grams[np.argsort(rank[_slots(grams)], kind="stable")]


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-num * size // den) + 1


def sketch_ranks(texts: DataFrame, n: int) -> np.ndarray:
    """Frequency rank of every sketch slot, from all n-grams of all texts."""
    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for b in batches:
            found = [_slots(ngram_set(t, n)) for t in b.column(0).to_pylist() if t]
            if found:
                total += np.bincount(np.concatenate(found), minlength=len(total))
        slots = np.flatnonzero(total)
        for at in range(0, len(slots), 1 << 17):
            part = slots[at:at + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["slot", "cnt"])

    counts = (texts.select("text").mapInArrow(count, "slot int, cnt long")
              .groupBy("slot").agg(F.sum("cnt").alias("cnt")).toArrow())
    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    total[counts["slot"].to_numpy()] = counts["cnt"].to_numpy()
    return np.minimum(np.log2(total + 1) * 1024, 65535).astype(np.uint16)


class _Trie:
    """Radix trie of ordered sets; every node knows the greatest weight of a
    set and the smallest size below it."""

    __slots__ = ("seg", "kids", "ends", "longest", "least")

    def __init__(self, seg, longest=0, least=1 << 60):
        self.seg, self.kids, self.ends, self.longest, self.least = seg, {}, [], longest, least

    def insert(self, grams: list[int], weight: int, size: int, ident: int) -> None:
        node, at = self, 0
        while True:
            node.longest, node.least = max(node.longest, weight), min(node.least, size)
            if at == len(grams):
                node.ends.append(ident)
                return
            kid = node.kids.get(grams[at])
            if kid is None:
                kid = node.kids[grams[at]] = _Trie(grams[at:], weight, size)
                kid.ends.append(ident)
                return
            k, seg = 0, kid.seg
            most = min(len(seg), len(grams) - at)
            while k < most and seg[k] == grams[at + k]:
                k += 1
            if k < len(seg):  # split the edge
                mid = _Trie(seg[:k], kid.longest, kid.least)
                mid.kids[seg[k]] = kid
                kid.seg = seg[k:]
                node.kids[grams[at]] = kid = mid
            node, at = kid, at + k


def block_links(reps, sizes, sets, before, num: int, den: int, side=None, weights=None, spare=None,
                copies=None, links=None):
    """The connected sets inside one block, as index pairs of a set and the
    one of smallest id it is connected with.

    ``sets``: arrays of n-grams in global order; ``weights``: how many n-grams
    each entry of a set stands for (default 1); ``spare``: n-grams of each set
    that are not listed but might still overlap (prefixes; a larger set must
    not have fewer); ``before``: for a block that is one prefix n-gram, each
    set's kept n-grams ahead of it (a pair sharing one of those is met in that
    block), else None; ``side``: 0/1 of a block between two chunks, where only
    pairs across are tested. ``links`` (zeros) gets for each set the number of
    ``copies`` of the sets it links with; without it, pairs already connected
    are skipped.
    """
    root = list(range(len(reps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    # n-grams that one set of the block holds cannot overlap
    ids, where = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(where, minlength=len(ids)) > 1
    weight_of = [1] * len(ids)
    if weights is not None:
        flat = np.zeros(len(ids), dtype=np.int64)
        flat[where] = np.concatenate(weights)
        weight_of = flat.tolist()
    cut = np.cumsum([0, *map(len, sets)])
    trie = _Trie([])
    for x in sorted(range(len(reps)), key=lambda i: (sizes[i], reps[i])):
        w = where[cut[x]:cut[x + 1]]
        mine = w[shared[w]].tolist()
        nx, least_y = sizes[x], -(-num * sizes[x] // den)
        extra = spare[x] if spare is not None else 0
        left, total = {}, 0  # weight of the set behind each of its n-grams
        for g in reversed(mine):
            left[g] = total
            total += weight_of[g]

        def need(ny):  # smallest listed overlap that links sizes nx and ny
            return -(-num * (nx + ny) // (num + den)) - extra

        stack = [(trie, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            must = need(max(node.least, least_y))
            for g in node.seg:
                depth += weight_of[g]
                rest = left.get(g)
                if rest is None:
                    if overlap + node.longest - depth < must:
                        break
                else:
                    overlap += weight_of[g]
                    if overlap + rest < must:
                        break
            else:
                for y in node.ends:
                    if sizes[y] >= least_y and overlap >= need(sizes[y]):
                        if side is not None and side[x] == side[y]:
                            continue
                        a, b = find(x), find(y)
                        if (a != b or links is not None) and (before is None or before[x].isdisjoint(before[y])):
                            root[max(a, b)] = min(a, b)
                            if links is not None:
                                links[x] += copies[y]
                                links[y] += copies[x]
                for kid in node.kids.values():
                    if overlap + min(kid.longest - depth, total) >= need(max(kid.least, least_y)):
                        stack.append((kid, overlap, depth))
        trie.insert(mine, total, nx, x)
    least: dict[int, int] = {}
    for x in sorted(range(len(reps)), key=reps.__getitem__):
        least.setdefault(find(x), x)
    return [(x, least[find(x)]) for x in range(len(reps)) if least[find(x)] != x]


def _with_partner(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (of ``key, size, pos, gram``) that can link with another holder of
    the n-gram: linked sizes differ by ``num/den`` at most. ``first`` tells
    whether it can be the first one the two share: no more than the allowed
    difference of two linked sets stands ahead of that. Only neighbours by
    size are looked at, as a sorted stream."""
    holders = Window.partitionBy("gram")
    by_size = holders.orderBy("size")
    return (posts.withColumn("below", F.lag("size").over(by_size)).withColumn("above", F.lead("size").over(by_size))
            .withColumn("lead", F.min("pos").over(holders))
            .where((den * F.col("below") >= num * F.col("size")) | (num * F.col("above") <= den * F.col("size")))
            .withColumn("first", (F.col("pos") + F.col("lead")) * num <= (den - num) * F.col("size"))
            .drop("below", "above", "lead"))


ROUTED = pa.schema([("block", pa.string()), ("key", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()),
                    ("side", pa.int32()), ("before", pa.list_(pa.int64())), ("grams", pa.binary())])
LINKED = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("key", pa.int64()), ("links", pa.int64())])


PREFIXES = pa.schema([("block", pa.string()), ("key", pa.int64()), ("size", pa.int32()), ("side", pa.int32()),
                      ("ahead", pa.int32()), ("grams", pa.binary()), ("weight", pa.binary())])


class _Rows:
    """Rows gathered into Arrow batches of a bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int):
        self.rows.append(row)
        self.size += size + 64
        if self.size > 1 << 22:
            yield from self.rest()

    def rest(self):
        if self.rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.size = [], 0


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                       num: int = 90, den: int = 100) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, n_links``.

    Words are runs without ASCII white space, A-Z lower-cased; a text of
    fewer than ``n`` words is one n-gram of all its words. Sets link when
    their Jaccard similarity is at least ``num/den``; ``component_id`` is the
    smallest id reachable by links. ``n_links`` is the number of other rows
    whose set links with the row's, equal sets among them. Null or blank texts
    have 0 n-grams and link with nothing (their component is their own id).
    Rows with a null id keep their count of n-grams, have a null component and
    null links and are no one's link. Rows that repeat an id are returned each,
    with the links of their own set; the component is that of all their links
    together. Other columns of
    ``docs`` are ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ready(spark)
    st = Stages(spark, "ngram-join")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_text(text_col).alias("text"))
    rank = spark.sparkContext.broadcast(sketch_ranks(texts, n))

    def prefixes(batches):
        for b in batches:
            sizes, digests, firsts = [], [], []
            for t in b.column(1).to_pylist():
                g = ngram_set(t, n)
                sizes.append(len(g))
                digests.append(_digest(g))
                firsts.append(_order(g, rank.value)[:prefix_length(len(g), num, den) if len(g) else 0].view(np.int64))
            offsets = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            values = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["doc_id", "size", "sid", "prefix"])

    sets = st.write(texts.mapInArrow(prefixes, "doc_id long, size long, sid binary, prefix array<long>")
                    .withColumn("row", F.monotonically_increasing_id()), "sets")
    live = sets.where("size > 0 and doc_id is not null")
    reps = live.groupBy("sid").agg(F.min(F.struct("doc_id", "row")).alias("low"), F.count("*").alias("copies")).select(
        "sid", F.col("low.doc_id").alias("rep"), F.col("low.row").alias("rep_row"), "copies")
    # a set goes by the id it is represented by, or by its digest where that id stands for several sets
    several = reps.groupBy("rep").count().where("count > 1").select(F.col("rep").alias("shared_rep"))
    reps = st.write(reps.join(several, reps.rep == several.shared_rep, "left").select(
        "sid", "rep", "rep_row", "copies", F.when(F.col("shared_rep").isNull(), F.col("rep")).otherwise(F.xxhash64("sid")).alias("key")),
        "reps")
    posts = (live.join(reps, "sid").where("row = rep_row")
             .select("key", F.col("size").cast("int"), F.posexplode("prefix").alias("pos", "gram")))
    near = st.write(_with_partner(posts, num, den), "near")
    # n-grams held by the same sets make the same pairs: keep the first of them
    grams = (near.groupBy("gram").agg(F.count("*").alias("holders"), F.sum("size").alias("load"),
                                      F.min("pos").alias("lead"), F.bit_xor(F.xxhash64("key")).alias("x"),
                                      F.sum(F.xxhash64("key", F.lit(7)).cast("decimal(38,0)")).alias("s"))
             .where("holders > 1").groupBy("holders", "x", "s", "load")
             .agg(F.min(F.struct("lead", "gram")).getField("gram").alias("gram"), F.count("*").alias("weight"))
             .select("gram", "holders", "load", "weight"))
    member = st.write(near.join(grams, "gram").groupBy("key", "size").agg(
        F.array_sort(F.collect_list(F.struct("pos", "gram", "holders", "load", "weight", "first"))).alias("kept")),
        "members")

    def blocks_of(kept, body):
        """(block, side, kept n-grams ahead) of a set for each prefix n-gram
        that can be the first one it shares with a linked set."""
        ahead = []
        for k in kept:
            if not k["first"]:
                ahead.append(k["gram"])
                continue
            chunks = max(1, -(-k["holders"] // BLOCK_SETS), -(-k["load"] // BLOCK_GRAMS))
            mine = xxhash.xxh3_64_intdigest(body) % chunks
            for c in range(chunks):
                low, high = min(c, mine), max(c, mine)
                yield f"n{k['gram']}/{low}/{high}", -1 if low == high else int(mine == high), list(ahead)
            ahead.append(k["gram"])

    def route_prefixes(batches):
        for b in batches:
            out = _Rows(PREFIXES)
            for key, size, kept in zip(*(c.to_pylist() for c in b.columns)):
                grams = np.array([k["gram"] for k in kept], dtype=np.int64).tobytes()
                weight = np.array([k["weight"] for k in kept], dtype=np.int32).tobytes()
                for block, side, ahead in blocks_of(kept, key.to_bytes(8, "big", signed=True)):
                    yield from out.add((block, key, size, side, len(ahead), grams, weight), len(grams) * 2)
            yield from out.rest()

    def join_prefixes(batches):
        for _, rows in by_key(batches, 0):
            if len(rows) < 2:
                continue
            _, ids, size, sides, ahead, grams, weight = zip(*rows)
            lists = [np.frombuffer(x, dtype=np.int64) for x in grams]
            pairs = block_links(ids, size, lists, [set(x[:k].tolist()) for x, k in zip(lists, ahead)], num, den,
                                None if sides[0] < 0 else sides, [np.frombuffer(x, dtype=np.int32) for x in weight],
                                [n - prefix_length(n, num, den) for n in size])
            if pairs:
                yield pa.RecordBatch.from_pydict({"u": [ids[a] for a, _ in pairs], "v": [ids[b] for _, b in pairs]})

    candidates = (member.mapInArrow(route_prefixes, "block string, key long, size int, side int, ahead int, "
                                                    "grams binary, weight binary")
                  .repartition("block").sortWithinPartitions("block").mapInArrow(join_prefixes, "u long, v long"))
    groups = st.write(connected_components(candidates, st), "groups")
    sizes = member.join(groups, member.key == groups.node).groupBy("component").agg(
        F.count("*").alias("g_sets"), F.sum("size").alias("g_grams"))
    small = (F.col("g_sets") <= BLOCK_SETS) & (F.col("g_grams") <= BLOCK_GRAMS)
    placed = st.write(groups.join(reps, groups.node == reps.key).select("key", "component", "sid", "rep", "copies"), "placed")
    routed = (member.join(placed, "key").join(sizes, "component")
              .select("key", "sid", "rep", "copies", F.when(small, F.col("component")).alias("grp"),
                      F.when(~small, F.col("kept")).alias("kept")))
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - SLOT_BITS)
    grouped = spark.sparkContext.broadcast(slot_bitmap(
        placed.select(F.col("rep").alias("doc_id")).select(slot.alias("slot"))))

    def only_grouped(batches):  # spares the shuffle most of the texts; the join decides
        for b in batches:
            b = b.filter(pa.array(in_bitmap(grouped.value, b.column(2).to_numpy()))).select([0, 1])
            sids = [_digest(ngram_set(t, n)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sids, pa.binary())], ["doc_id", "text", "text_sid"])

    some = (texts.where("doc_id is not null").select("doc_id", "text", slot.alias("slot"))
            .mapInArrow(only_grouped, "doc_id long, text binary, text_sid binary"))
    wanted = some.join(routed, (some.doc_id == routed.rep) & (some.text_sid == routed.sid)).select(
        "key", "rep", "copies", "grp", "kept", "text")

    def route(batches):
        """One row per block of a set, with the set in global order."""
        for b in batches:
            out = _Rows(ROUTED)
            for key, rep, copies, grp, kept, text in zip(*(c.to_pylist() for c in b.columns)):
                body = _order(ngram_set(text, n), rank.value).tobytes()
                if grp is not None:
                    yield from out.add((f"g{grp}", key, rep, copies, -1, [], body), len(body))
                else:
                    for block, side, ahead in blocks_of(kept, key.to_bytes(8, "big", signed=True)):
                        yield from out.add((block, key, rep, copies, side, ahead, body), len(body))
            yield from out.rest()

    def join_blocks(batches):
        for block, rows in by_key(batches, 0):
            # a row that repeats id and text brings its set again
            _, keys, ids, copies, sides, before, grams = zip(*{r[1]: r for r in rows}.values())
            bodies = [np.frombuffer(x, dtype=np.uint64) for x in grams]
            links = [0] * len(keys)
            pairs = block_links(ids, [len(x) for x in bodies], bodies,
                                [set(x) for x in before] if block.startswith("n") else None,
                                num, den, None if sides[0] < 0 else sides, copies=copies, links=links)
            if pairs:
                out = _Rows(LINKED)
                for a, b in pairs:
                    yield from out.add((ids[a], ids[b], None, None), 0)
                for key, count in zip(keys, links):
                    if count:
                        yield from out.add((None, None, key, count), 0)
                yield from out.rest()

    linked = st.write(
        wanted.mapInArrow(route, "block string, key long, rep long, copies long, side int, before array<long>, grams binary")
        .repartition("block").sortWithinPartitions("block").mapInArrow(join_blocks, "u long, v long, key long, links long"),
        "linked")
    links = linked.where("u is not null").select("u", "v")
    counts = linked.where("key is not null").groupBy("key").agg(F.sum("links").alias("links"))
    of_set = reps.join(counts, "key", "left").select(
        "sid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    copies = live.join(reps, "sid").where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = connected_components(links.union(copies), st)
    out = (sets.join(found, sets.doc_id == found.node, "left").join(of_set, "sid", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")))
    st.drop(near, member, groups, placed)
    return out
