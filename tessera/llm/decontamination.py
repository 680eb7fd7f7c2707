"""Benchmark decontamination by greedy string tiling.

A benchmark item that a document shares a five-word seed with is tiled over
the document: the longest common runs of words that no tile covers yet are
found by running Karp-Rabin (hashes of windows of a falling length, looked up
in a table and compared word by word), marked, and so on down to MIN_TILE
words.  The document is contaminated when the tiles cover at least COVERAGE of
an item's words, in whatever order its passages come.

The benchmark is the query set.  It is taken in blocks of at most
BLOCK_ITEMS items and BLOCK_WORDS words; a block is what a task holds in
memory, and each block is one map over all documents, without a shuffle.
The join on seeds is a sorted lookup in the task.

Words are compared lower-cased and without punctuation at their ends.

Defined results: null texts and ids are empty texts and null ids, an item
without words contaminates nothing, an item shorter than MIN_TILE words is one
tile of its own length, repeated items and documents are each answered, ties
go to the smallest item_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE, SIMILARITY, gram_hashes, hash_words, keep_rows, slices, split_words, stored, text_hash

MIN_TILE = SHINGLE
COVERAGE = SIMILARITY
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 2_000_000
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’…¿¡"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every compared word, and offsets of the texts."""
    raw, codes, offsets = split_words(texts)
    bare = pc.utf8_trim(pc.utf8_lower(raw), characters=EDGE)
    hashed = hash_words(bare)
    some = pc.not_equal(bare, "").to_numpy(zero_copy_only=False)
    keep = some[codes] if len(codes) else np.zeros(0, bool)
    return hashed[codes[keep]] if len(codes) else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(keep)])[offsets]


def _free_windows(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` words of which none is marked."""
    if len(free) < size:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size])


def tile(item: np.ndarray, doc: np.ndarray, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, doc start, words) of two arrays of word
    hashes: the longest match first, on ties the leftmost in the item, then in
    the document; no word of either side is in two tiles."""
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles, size = [], min(len(item), len(doc))
    while size >= min_tile:
        wi, wd = _free_windows(free_i, size), _free_windows(free_d, size)
        matched = False
        if len(wi) and len(wd):
            hi, hd = gram_hashes(item, size)[wi], gram_hashes(doc, size)[wd]
            order = np.argsort(hd, kind="stable")
            hd, wd = hd[order], wd[order]
            for h, i in zip(hi, wi):
                if not free_i[i:i + size].all():
                    continue
                k = np.searchsorted(hd, h)
                while k < len(hd) and hd[k] == h:
                    d = wd[k]
                    if free_d[d:d + size].all() and (item[i:i + size] == doc[d:d + size]).all():
                        free_i[i:i + size] = False
                        free_d[d:d + size] = False
                        tiles.append((int(i), int(d), size))
                        matched = True
                        break
                    k += 1
        if not matched or size > min_tile:
            size = _next_size(item, doc, free_i, free_d, size - 1, min_tile)
        else:
            break
    return tiles


def _next_size(item, doc, free_i, free_d, most: int, least: int) -> int:
    """Longest window length up to ``most`` that the unmarked words still
    share (a shared window's own prefixes are shared, so halving finds it)."""
    low, high = least - 1, most
    while low < high:
        size = (low + high + 1) // 2
        wi, wd = _free_windows(free_i, size), _free_windows(free_d, size)
        if len(wi) and len(wd) and np.isin(gram_hashes(item, size)[wi], gram_hashes(doc, size)[wd]).any():
            low = size
        else:
            high = size - 1
    return low


def covered(item: np.ndarray, doc: np.ndarray) -> tuple[float, list[tuple[int, int, int]]]:
    if not len(item):
        return 0.0, []
    tiles = tile(item, doc, min(MIN_TILE, len(item)))
    return sum(t[2] for t in tiles) / len(item), tiles


class Seeds:
    """Windows of the smallest tile size of a block's items, by hash."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        self.lengths = np.diff(offsets)
        self.sizes = np.minimum(self.lengths, MIN_TILE)
        self.each = np.unique(self.sizes[self.sizes > 0]).tolist()
        found = [(gram_hashes(words[offsets[k]:offsets[k + 1]], int(n)), k) for k, n in enumerate(self.sizes) if n]
        hashes = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owner = np.concatenate([np.full(len(h), k) for h, k in found])[order] if found else np.zeros(0, np.int64)
        self.at = np.concatenate([np.arange(len(h)) for h, _ in found])[order] if found else np.zeros(0, np.int64)

    def bounds(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(items that share a window with the document, largest coverage each
        can have: its words inside shared windows), the largest bound first."""
        held = []
        for size in self.each if len(self.hashes) else ():
            grams = gram_hashes(doc, size)
            at = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
            hits = np.unique(grams[self.hashes[at] == grams])
            first = np.searchsorted(self.hashes, hits)
            counts = np.searchsorted(self.hashes, hits, side="right") - first
            held.append(np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum()))
        held = np.concatenate(held) if held else np.zeros(0, np.int64)
        if not len(held):
            return held, np.zeros(0)
        owner, at = self.owner[held], self.at[held]
        order = np.lexsort((at, owner))
        owner, at = owner[order], at[order]
        size = self.sizes[owner]
        gap = np.append(at[1:] - at[:-1], 0)
        last = np.append(owner[1:] != owner[:-1], True)
        items, group = np.unique(owner, return_inverse=True)
        words = np.bincount(group, weights=np.where(last, size, np.minimum(gap, size)))
        bound = words / self.lengths[items]
        order = np.argsort(-bound, kind="stable")
        return items[order], bound[order]


def _tiler(ids: list, words: np.ndarray, offsets: np.ndarray):
    """Function over batches (key, doc_id, text) that tiles one block.  An item
    is tiled with the document only if it can reach COVERAGE or be the best:
    tiles lie inside shared windows."""
    seeds = Seeds(words, offsets)

    def smaller(a, b) -> bool:
        return a is not None and (b is None or a < b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, offs = words_of(part.column("text"))
            out = {"coverage": [], "item_id": [], "tiles": [], "items": []}
            for i in range(part.num_rows):
                doc = hashed[offs[i]:offs[i + 1]]
                best, which, spans, items = 0.0, None, [], []
                for k, bound in zip(*(x.tolist() for x in seeds.bounds(doc))):
                    if bound < COVERAGE and (bound < best or (bound == best and not smaller(ids[k], which))):
                        continue
                    share, tiles = covered(words[offsets[k]:offsets[k + 1]], doc)
                    if share >= COVERAGE:
                        items.append(ids[k])
                    if share > best or (share == best and share and smaller(ids[k], which)):
                        best, which, spans = share, ids[k], tiles
                out["coverage"].append(best)
                out["item_id"].append(which)
                out["tiles"].append([{"item_word": a, "doc_word": b, "words": n} for a, b, n in spans])
                out["items"].append(sorted(x for x in items if x is not None))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("text_hash"), pa.array(out["coverage"], pa.float64()),
                 pa.array(out["item_id"], pa.int64()),
                 pa.array(out["tiles"], pa.list_(pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())]))),
                 pa.array(out["items"], pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "coverage", "item_id", "tiles", "items"])
    return run


RESULT = ("doc_id long, text_hash long, coverage double, item_id long, "
          "tiles array<struct<item_word int, doc_word int, words int>>, items array<long>")


def blocks(benchmark: DataFrame) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """The query set in blocks of bounded size, one at a time on the driver."""
    ids, texts, words = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        n = len((r["text"] or "").split())
        if ids and (len(ids) == BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield (ids, *words_of(pa.array(texts, pa.string())))
            ids, texts, words = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        words += n
    if ids:
        yield (ids, *words_of(pa.array(texts, pa.string())))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, coverage (largest over the
    items), item_id and tiles of that item, items (all that reach COVERAGE),
    contaminated."""
    rows = docs.select("doc_id", text_hash().alias("text_hash"), "text")
    parts = [rows.mapInArrow(_tiler(*block), RESULT) for block in blocks(benchmark)]
    if not parts:
        parts = [rows.mapInArrow(_tiler([], np.zeros(0, np.uint64), np.zeros(1, np.int64)), RESULT)]
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionAll(p)
        best = F.max_by(F.struct("item_id", "tiles"), F.struct("coverage", -F.coalesce("item_id", F.lit(2**62))))
        n = len(parts)
        out = (out.groupBy("doc_id", "text_hash")
               .agg(F.max("coverage").alias("coverage"), best.alias("best"), F.count("*").alias("_rows"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
               .withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_rows") / n).cast("int"))))
               .select("doc_id", "text_hash", "coverage", "best.item_id", "best.tiles", "items"))
    return out.withColumn("contaminated", F.col("coverage") >= COVERAGE)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; columns unchanged."""
    bad = stored(contamination(docs, benchmark).filter("contaminated").select("doc_id", "text_hash"), "contaminated")
    return keep_rows(docs, bad.distinct(), "left_anti")
