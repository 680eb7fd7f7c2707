"""N-gram Jaccard self-join by chosen paths.

A document is the set of its five-word shingles; documents of equal sets are
copies and enter the join once.  A set is embedded as TOKENS min-hash values,
so that the share of equal values estimates the Jaccard similarity.

Chosen-path tree: at a node every set goes to BRANCHES children, each named by
one sampled position and the set's own value there, so two sets stay together
at a child with a probability equal to their similarity.  A node of at most
LEAF sets is a leaf; a larger one is split again, to DEPTH levels, unless it
kept nearly all of its parent's sets: such a dense node is compared as it is,
as pairs of blocks in many tasks.  Two sets of
similarity s share a leaf of one run unless a branching process with
Binomial(BRANCHES, s) children dies out (probability 0.06 at s = 0.8), so the
number of independent runs follows from the target recall (`runs_for`).

Leaves are compared by brute force: first on the embedding, which prunes sets
without a likely partner there, then on the real shingle sets (leaves of the
same remaining sets, which the runs find again and again, only once).  A leaf
yields a spanning forest of its verified links, never all pairs.  Classes are the
connected components of the forests.  Links only exist inside a class, so the
exact number of partners (different sets of similarity >= SIMILARITY) is then
counted inside the classes, in blocks of BLOCK sets: a larger class is handled
as pairs of blocks in many tasks.

Defined results: null text is empty; texts without words have equal (empty)
sets and are copies of each other; fewer than five words make one shingle;
repeated rows are copies and each appears in the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SIMILARITY, hash_words, keep_rows, mix, shingles, slices, split_words, stored, text_hash

TOKENS = 64
BRANCHES = 2
LEAF = 4096
DEPTH = 8
BLOCK = 256
RECALL = 0.9999        # target recall of links at the similarity threshold
DENSE = 0.6            # a child this near its parent's size is dense: splitting on is useless
CELLS = 32_000_000     # cells of an incidence matrix held at once
SURVIVAL_SLACK = 0.1   # an embedding of TOKENS values may show a smaller share
LIKELY = 0.5           # share of equal values below which a pair is not verified

_SEEDS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def runs_for(recall: float, similarity: float) -> int:
    """Independent trees until a pair of this similarity is missed by all with
    a probability of at most 1 - recall."""
    s, dead = similarity - SURVIVAL_SLACK, 0.0
    for _ in range(DEPTH):
        dead = (1 - s + s * dead) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(dead)))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, codes, offsets = split_words(column)
    hashed = hash_words(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    every, offs = shingles(hashed, offsets)
    out, ends = [], [0]
    for i in range(len(offs) - 1):
        own = np.unique(every[offs[i]:offs[i + 1]])
        out.append(own)
        ends.append(ends[-1] + len(own))
    return (np.concatenate(out) if out else every), np.array(ends, np.int64)


def embed(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """TOKENS min-hash values per set (0 for the empty set)."""
    out = np.zeros((len(offsets) - 1, TOKENS), np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        starts = offsets[some]
        for k in range(TOKENS):
            value = ((flat ^ _SEEDS[k]) * _SEEDS[k])
            out[some, k] = np.minimum.reduceat(value >> np.uint64(32), starts)
    return out


def _keys(flat: np.ndarray, offs: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(flat[offs[i]:offs[i + 1]].tobytes()) for i in range(len(offs) - 1)]


def _embed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        flat, offs = shingle_sets(part.column("text"))
        tokens = embed(flat, offs)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), part.column("text_hash"), pa.array(_keys(flat, offs), pa.binary()),
             pa.array(np.diff(offs)), pa.array([row.tobytes() for row in tokens], pa.binary()),
             pa.array([row.tobytes() for row in tokens.astype(np.uint8)], pa.binary())],
            names=["doc_id", "text_hash", "set_key", "size", "tokens", "brief"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        flat, offs = shingle_sets(part.column("text"))
        items = [flat[offs[i]:offs[i + 1]].tobytes() for i in range(part.num_rows)]
        yield pa.RecordBatch.from_arrays([pa.array(_keys(flat, offs), pa.binary()), pa.array(items, pa.binary())],
                                         names=["set_key", "items"])


def _children(runs: int):
    """Paths of the children of each row (path null: the roots of the runs)."""
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
            path = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys, parents = batch.column("set_key"), batch.column("n")
            for j in range(BRANCHES * runs):
                at = (mix(path + np.uint64((j + 1) * 0xD1342543DE82EF95 % 2**64)) % np.uint64(TOKENS)).astype(np.int64)
                value = tokens[np.arange(len(path)), at].astype(np.uint64)
                child = mix(mix(path * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)) + (value << np.uint64(8)) + at.astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), keys, parents], names=["path", "set_key", "up"])
    return expand


def tree_leaves(sets: DataFrame, runs: int) -> DataFrame:
    """Leaves (path, part, set_key) of all runs that hold two sets or more;
    dense nodes and nodes still larger than LEAF at the last level are cut
    into pairs of blocks."""
    nodes = sets.select(F.lit(0).cast("long").alias("path"), "set_key", F.lit(0).cast("long").alias("n"), "tokens")
    leaves, roots = None, runs
    for level in range(DEPTH):
        placed = stored(nodes.mapInArrow(_children(roots), "path long, set_key binary, up long"), f"paths-{level}")
        roots = 1
        # path counts are combined per task: a hot path is one row per task
        counted = placed.groupBy("path").agg(F.count("*").alias("n"), F.max("up").alias("up")).filter("n > 1")
        kept = stored(placed.select("path", "set_key").join(counted, "path"), f"nodes-{level}")
        found = kept.filter(F.col("n") <= LEAF).select("path", F.lit(0).alias("part"), "set_key")
        large = kept.filter(F.col("n") > LEAF)
        last = level == DEPTH - 1
        done = F.lit(last) | (F.col("n") >= F.col("up") * DENSE) if level else F.lit(last)
        found = found.unionAll(block_pairs(large.filter(done), "path", "set_key", F.col("n"), LEAF // 4))
        leaves = found if leaves is None else leaves.unionAll(found)
        large = large.filter(~done)
        if large.isEmpty():
            break
        nodes = large.select("path", "set_key", "n").join(sets.select("set_key", "tokens"), "set_key")
    return leaves


def block_pairs(rows: DataFrame, group: str, key: str, n, block: int) -> DataFrame:
    """Rows of a group dealt to blocks of about ``block`` rows, each sent to
    every pair of blocks that holds its own: (group, part, key)."""
    blocks = F.ceil(n / F.lit(block)).cast("int")
    own = rows.withColumns({"_blocks": blocks, "_own": F.pmod(F.xxhash64(key, F.lit(7)), blocks).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    dealt = own.select(group, key, "_own", "_blocks", other.alias("_other"))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return dealt.select(group, (low * F.col("_blocks") + high).cast("int").alias("part"), key)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the number of each row's group, from rows
    that come sorted by ``keys``; a group cut by a batch's end waits for the
    next batch."""
    rest: pa.Table | None = None

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            col = table.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.cumsum(new)
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        group = numbered(rest)
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield rest.slice(0, last), group[:last]
            rest = rest.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, numbered(rest)


def likely_rows(tokens: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which rows have another row of their group (contiguous) with LIKELY or
    more equal values: each row against the next, the second next, ..."""
    out = np.zeros(len(tokens), bool)
    at, step = np.arange(len(tokens)), 1
    while True:
        at = at[at + step < len(tokens)]
        at = at[group[at] == group[at + step]]
        todo = at[~(out[at] & out[at + step])]
        if not len(at):
            return out
        for a in range(0, len(todo), 8192):
            one = todo[a:a + 8192]
            hit = one[(tokens[one] == tokens[one + step]).sum(axis=1) >= LIKELY * TOKENS]
            out[hit] = True
            out[hit + step] = True
        step += 1


def _prune_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a likely partner, under a number that depends on the leaf's
    remaining sets alone."""
    for table, group in whole_groups(batches, ["path", "part"]):
        tokens = np.frombuffer(b"".join(table.column("brief").to_pylist()), np.uint8).reshape(-1, TOKENS)
        keep = likely_rows(tokens, group)
        if not keep.any():
            continue
        keys = table.column("set_key").filter(pa.array(keep))
        heads = np.frombuffer(b"".join(keys.to_pylist()), np.uint64)[::2]
        _, member = np.unique(group[keep], return_inverse=True)
        sums = np.zeros(member.max() + 1, np.uint64)
        np.add.at(sums, member, mix(heads))
        yield pa.RecordBatch.from_arrays([pa.array(sums[member].view(np.int64)), keys.combine_chunks()], names=["leaf", "set_key"])


def similar(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the numbers of the sets whose Jaccard similarity with it
    is at least SIMILARITY (itself left out)."""
    n, sizes = len(sets), np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1                                # other items are in no overlap
    owner, code = owner[shared], (np.cumsum(times > 1) - 1)[code[shared]]
    width = int((times > 1).sum())

    def hits(i: int, common: np.ndarray) -> tuple[int, np.ndarray]:
        union = sizes[i] + sizes - common
        hit = (common >= SIMILARITY * union - 1e-9) & (union > 0)
        hit[i] = False
        return i, np.flatnonzero(hit)
    if n * width <= CELLS:
        cells = np.zeros((n, width), np.float32)
        cells[owner, code] = 1.0
        for a in range(0, n, 256):
            for i, common in enumerate(cells[a:a + 256] @ cells.T, a):
                yield hits(i, np.rint(common))
        return
    order = np.argsort(code, kind="stable")
    by_item, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code, minlength=width))])
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    for i in range(n):
        mine = code[ends[i]:ends[i + 1]]
        spans = starts[mine + 1] - starts[mine]
        at = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
        yield hits(i, np.bincount(by_item[at], minlength=n))


def _items(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _star(keys: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Star of every linked component of a leaf: (a, b), b its smallest key."""
    parent = list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i, hits in similar(sets):
        for j in hits:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    least: dict[int, bytes] = {}
    for i, k in enumerate(keys):
        r = root(i)
        least[r] = min(least.get(r, k), k)
    return [(k, least[root(i)]) for i, k in enumerate(keys) if least[root(i)] != k]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in whole_groups(batches, ["leaf"]):
        keys, sets = table.column("set_key").to_pylist(), _items(table.column("items").to_pylist())
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        edges = [e for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1 for e in _star(keys[a:b], sets[a:b])]
        yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.binary()),
                                          pa.array([e[1] for e in edges], pa.binary())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(set_key, class_key): smallest key of each connected component.

    Every round takes the least label of the neighbours, then the label of the
    label, and ends when no label changes.  Neighbours' labels are combined
    per task, so a hub's many edges are no hot group."""
    both = stored(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select("a", F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("near")), "b")
                .groupBy("a").agg(F.min("near").alias("near")))
        step = labels.join(near, "a").select("a", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        jump = labels.select(F.col("a").alias("new"), F.col("label").alias("far"))
        after = stored(step.join(jump, "new", "left").select(
            "a", F.least("new", F.coalesce("far", "new")).alias("label"), "old"), "labels")
        changed = after.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = after.select("a", "label")
        if not changed:
            return labels.select(F.col("a").alias("set_key"), F.col("label").alias("class_key"))


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the partners of each set inside one pair of blocks; partners in
    the same block count where the pair is a block with itself."""
    for table, group in whole_groups(batches, ["class_key", "low", "high"]):
        keys, sets = table.column("set_key").to_pylist(), _items(table.column("items").to_pylist())
        own, low, high, texts = (table.column(c).to_numpy() for c in ("own", "low", "high", "texts"))
        n = np.zeros(len(group), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            for i, hits in similar(sets[a:b]):
                same = own[a + hits] == own[a + i]
                n[a + i] = texts[a + hits[same if low[a] == high[a] else ~same]].sum()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n)], names=["set_key", "links"])


def count_links(classes: DataFrame, items: DataFrame) -> DataFrame:
    """(set_key, links): exact number of texts of the partners inside the
    class.  ``items``: (set_key, items, texts)."""
    sizes = classes.groupBy("class_key").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = (classes.join(sizes, "class_key").withColumn("blocks", blocks)
            .withColumn("own", F.pmod(F.xxhash64("set_key", F.lit(7)), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    rows = rows.select("class_key", "set_key", "own", F.least("own", "other").alias("low"),
                       F.greatest("own", "other").alias("high"))
    return (grouped(rows.join(items, "set_key"), "class_key", "low", "high")
            .mapInArrow(_count_links, "set_key binary, links long")
            .groupBy("set_key").agg(F.sum("links").alias("links")))


def grouped(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a group together and in sequence; groups here are bounded."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def jaccard_join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (largest doc_id of its connected
    group of near duplicates), links (other texts whose shingle sets have a
    similarity >= SIMILARITY, those with the same set included; copies of a text
    count once), class_size (documents), set_id (largest doc_id among the
    documents with the same shingle set), text_hash, stays (whether it is the
    document that stands for its group)."""
    rows = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    embedded = stored(rows.mapInArrow(
        _embed_rows, "doc_id long, text_hash long, set_key binary, size long, tokens binary, brief binary"), "embedded")
    sets = stored(embedded.filter("size > 0").groupBy("set_key").agg(
        F.first("tokens").alias("tokens"), F.first("brief").alias("brief"),
        F.max(F.struct("doc_id", "text_hash")).alias("reader")), "sets")
    leaves = tree_leaves(sets, runs_for(recall, SIMILARITY))
    pruned = stored(grouped(leaves.join(sets.select("set_key", "brief"), "set_key"), "path", "part")
                    .mapInArrow(_prune_leaves, "leaf long, set_key binary").distinct(), "likely")
    # one document of each likely set is read again for its shingles
    readers = (sets.join(pruned, "set_key", "left_semi")
               .select(F.col("reader.doc_id").alias("_id"), F.col("reader.text_hash").alias("_hash")))
    again = rows["doc_id"].eqNullSafe(readers["_id"]) & (rows["text_hash"] == readers["_hash"])
    items = stored(rows.join(readers, again, "left_semi").select("text")
                   .mapInArrow(_set_rows, "set_key binary, items binary").dropDuplicates(["set_key"]), "items")
    edges = (grouped(pruned.join(items, "set_key"), "leaf")
             .mapInArrow(_forests, "a binary, b binary"))
    classes = components(edges)
    # Copies of a text are combined per task first.
    per_text = embedded.groupBy("set_key", "text_hash").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    per_set = stored(per_text.groupBy("set_key").agg(F.max(F.struct("doc_id", "text_hash")).alias("first"),
                                                     F.sum("copies").alias("copies"), F.count("*").alias("texts")), "per-set")
    links = count_links(classes, items.join(per_set.select("set_key", "texts"), "set_key"))
    found = stored(classes.join(links, "set_key"), "classes")
    known = stored(per_set.join(found, "set_key", "left").select(
        "set_key", "first", "copies", F.coalesce("class_key", "set_key").alias("class_key"),
        (F.coalesce("links", F.lit(0).cast("long")) + F.col("texts") - 1).alias("links")), "set-classes")
    whole = known.groupBy("class_key").agg(F.max("first").alias("winner"), F.sum("copies").alias("class_size"))
    return (embedded.select("doc_id", "text_hash", "set_key").join(known.join(whole, "class_key"), "set_key")
            .select("doc_id", F.col("winner.doc_id").alias("class_id"), "links", "class_size",
                    F.col("first.doc_id").alias("set_id"), "text_hash",
                    F.struct("doc_id", "text_hash").eqNullSafe(F.col("winner")).alias("stays")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that of the largest
    doc_id; columns unchanged."""
    stay = stored(jaccard_join(docs).filter("stays").select("doc_id", "text_hash").distinct(), "jaccard-kept")
    return keep_rows(docs, stay, "left_semi")
