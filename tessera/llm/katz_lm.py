"""Katz backoff language model of order 2, fitted and evaluated in one shuffle
of the corpus.

Tokens are the words of the lower-cased (A-Z) text and one end per text; a
token's context is the token before it (a start before the first).  With c the
training counts,

    P(w | h) = d_c * c(h, w) / (c(h) + 1)       if c(h, w) > 0
             = weight(h) * P(w)                 if c(h) > 0
             = P(w)                             else
    P(w)     = (c(w) + 1) / (N + V + 1)

evaluated token by token.  Counts up to CUT are discounted by Good and Turing's
estimate, d_r = (r*/r - x) / (1 - x), r* = (r + 1) n_{r+1} / n_r,
x = (CUT + 1) n_{CUT+1} / n_1; larger counts are trusted, and every context
holds back one count more, so that something is always left.  The weight of a
context is exactly what is left over,

    (1 - sum of P(w | h)) / (1 - sum of P(w))   over the w seen after h,

and P(w) sums to one over the V known words and one unknown class, so that
every context's probabilities sum to one.

Work.  The unigram table is a grouped count.  Its most frequent words (at most
2^HEAD_BITS, a fixed bound) go to every task; a shard gets the counts of the
rarer words that it meets by a join.  Tokens are dealt to shards by context, as
packed arrays per slice of texts (equal tokens of a text counted, words and
contexts named once per slice).  A shard merges its n-grams (this is the
partitioned n-gram table), scores what needs no global number, and keeps, per
text, how often each count up to CUT occurred and which contexts it backed off
from.  When all shards are written, the discounts follow from their counts of
counts, one map finishes the scores, packed per slice, and a slice's sums of all
shards are added at once.  A text is its number in its slice; its key travels
once.

Hot contexts (more than `limit` tokens) are split over several shards by word,
their sums are merged before the finish; hot n-grams are counted ahead and dealt
by text.  There are at most 2^20 of either, whatever the corpus.

Words are 64-bit hashes.  Defined results: null text is empty and has the end
only; a null doc_id has the empty string's checksum; repeated rows are each
learnt from and scored; with no training rows every probability is that of the
unknown class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix, slices, small_batches, split_words, stored

CUT = 5                 # counts above are not discounted
FOLDS, HELD_OUT = 7, 2  # crc32(doc_id) mod FOLDS == HELD_OUT is not learnt from
START, END = np.uint64(1), np.uint64(2)
HEAD_BITS = 20          # frequent words that every task holds
SHARD_TOKENS = 3_000_000
PACK_ROWS, PACK_BYTES = 4096, 5 << 20    # texts of one packed slice
COUNT_ROWS, COUNT_BYTES = 2048, 3 << 19  # texts counted at once
PARTS = 8                                # a shard's contexts are merged in so many parts, one at a time
BATCH_ROWS = 1000                        # rows that a task gets from the JVM at once
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, each text's closed by END, and offsets."""
    words, codes, offsets = split_words(pc.ascii_lower(pc.fill_null(column, "")), pc.ascii_split_whitespace)
    hashed = hash_words(words)
    hashed = np.where(hashed < 16, hashed + np.uint64(16), hashed)
    n = len(offsets) - 1
    out = np.full(len(codes) + n, END, np.uint64)
    at = np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(offsets))
    out[at] = hashed[codes] if len(codes) else out[:0]
    return out, offsets + np.arange(n + 1)


def before(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The token before each token, START before a text's first."""
    out = np.concatenate([[START], tokens[:-1]]) if len(tokens) else tokens
    out[offsets[:-1]] = START
    return out


def _texts(batches: Iterator[pa.RecordBatch], rows: int = COUNT_ROWS, size: int = COUNT_BYTES) -> Iterator[tuple]:
    for part in slices(batches, "text", rows, size):
        tokens, offsets = token_hashes(part.column("text"))
        pa.default_memory_pool().release_unused()
        yield part, tokens, before(tokens, offsets), np.repeat(np.arange(part.num_rows), np.diff(offsets))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(h * GOLDEN + w)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n) of the training texts, equal words of a slice counted."""
    for part, tokens, _, row in _texts(batches):
        train = ~part.column("held_out").to_numpy(zero_copy_only=False)[row]
        words, n = np.unique(tokens[train], return_counts=True)
        yield pa.RecordBatch.from_arrays([_long(words), pa.array(n)], names=["word", "n"])


def good_turing(n: dict[int, int]) -> dict[int, float]:
    """Discount of each count up to CUT from the numbers n[r] of n-grams seen
    r times; where the estimate is undefined or outside (0, 1), (r - 1/2) / r."""
    out = {}
    x = (CUT + 1) * n.get(CUT + 1, 0) / n[1] if n.get(1) else None
    for r in range(1, CUT + 1):
        d = None
        if x is not None and x != 1 and n.get(r):
            d = ((r + 1) * n.get(r + 1, 0) / n[r] / r - x) / (1 - x)
        out[r] = d if d is not None and 0 < d < 1 else (r - 0.5) / r
    return out


def _columns(df: DataFrame) -> list[np.ndarray]:
    """A bounded table's two long columns on the driver, as packed bytes."""
    a, b = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy().tobytes()], pa.binary()) for c in batch.columns],
                                                 names=["a", "b"])
    rows = df.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).mapInArrow(run, "a binary, b binary").collect()
    return [np.frombuffer(b"".join(bytes(r[k]) for r in rows), np.int64) for k in ("a", "b")]


@dataclass
class Plan:
    """What every task knows: frequent words, hot contexts and n-grams."""
    shards: int
    limit: int
    unknown: float                       # probability of one unknown word
    head: np.ndarray                     # frequent words, sorted
    head_n: np.ndarray
    hot: np.ndarray                      # hot contexts, sorted
    hot_n: np.ndarray
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))   # hot n-grams, sorted
    pairs_n: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @staticmethod
    def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return at, sorted_keys[at] == keys

    def shard_of(self, h: np.ndarray, w: np.ndarray, row_key: np.ndarray) -> np.ndarray:
        """A context's shard; a hot context has several, a word is in one of
        them; a hot n-gram goes where its text says."""
        at, is_hot = self.find(self.hot, h)
        split = np.ones(len(h), np.uint64)
        if len(self.hot):
            split[is_hot] = (-(-self.hot_n[at[is_hot]] // self.limit)).astype(np.uint64)
        key = mix(h + GOLDEN * (mix(w ^ h) % split))
        dealt = self.find(self.pairs, _pair(h, w))[1]
        key = np.where(dealt, mix(row_key), key)
        return (key % np.uint64(self.shards)).astype(np.int32)


def _ahead(plan: Plan):
    """Rows (shard, context, word, n): rarer words that a shard meets (n 0),
    and the counts of n-grams of two hot words (shard -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, ctx, row in _texts(batches):
            keys = part.column("row_key").to_numpy().view(np.uint64)[row]
            rare = ~plan.find(plan.head, tokens)[1]
            shard = plan.shard_of(ctx[rare], tokens[rare], keys[rare])
            _, at = np.unique(mix(tokens[rare] * GOLDEN + shard.astype(np.uint64)), return_index=True)
            zero = np.zeros(len(at), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard[at]), pa.array(zero), _long(tokens[rare][at]), pa.array(zero)],
                                             names=["shard", "context", "word", "n"])
            train = ~part.column("held_out").to_numpy(zero_copy_only=False)[row]
            both = train & plan.find(plan.hot, ctx)[1] & plan.find(plan.hot, tokens)[1]
            _, at, n = np.unique(_pair(ctx[both], tokens[both]), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), -1, np.int32)), _long(ctx[both][at]), _long(tokens[both][at]),
                                              pa.array(n)], names=["shard", "context", "word", "n"])
    return run


PACKED = ("shard int, slice long, n_texts long, row_keys binary, texts binary, held binary, contexts binary, runs binary, words binary, word_at binary, row_at binary, "
          "times binary")


def _narrow(x: np.ndarray) -> bytes:
    """Small numbers in one, two or four bytes each, compressed."""
    most = int(x.max(initial=0))
    return zstandard.compress(x.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32).tobytes(), 1)


def _wide(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, {n: np.uint8, 2 * n: np.uint16}.get(len(raw), np.uint32)).astype(np.int64)


def _pack(plan: Plan):
    """One row per slice and shard: tokens in the order of their context, and
    the numbers of their texts in the slice.  One of a slice's rows has the keys
    of all its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, ctx, row in _texts(batches, PACK_ROWS, PACK_BYTES):
            row_keys = part.column("row_key").to_numpy().view(np.uint64)
            held = np.packbits(part.column("held_out").to_numpy(zero_copy_only=False)).tobytes()
            _, at, times = np.unique(mix(_pair(ctx, tokens) + row.astype(np.uint64)), return_index=True, return_counts=True)
            tokens, ctx, row = tokens[at], ctx[at], row[at]
            shard = plan.shard_of(ctx, tokens, row_keys[row])
            order = np.lexsort((ctx, shard))
            cuts = np.searchsorted(shard[order], np.arange(plan.shards + 1))
            out: list[list] = [[] for _ in PACKED.split(", ")]
            name, used = xxhash.xxh64_intdigest(row_keys.tobytes()), np.flatnonzero(np.diff(cuts))
            for s in used:
                own = order[cuts[s]:cuts[s + 1]]
                h, first = np.unique(ctx[own], return_index=True)
                w, word_at = np.unique(tokens[own], return_inverse=True)
                texts, row_at = np.unique(row[own], return_inverse=True)
                flags = np.unpackbits(np.frombuffer(held, np.uint8), count=len(row_keys))[texts]
                keys = row_keys.tobytes() if s == used[name % len(used)] else b""
                for column, value in zip(out, (int(s), name, len(texts), keys, _narrow(np.diff(texts, prepend=-1) - 1), np.packbits(flags).tobytes(),
                                               h.tobytes(), _narrow(np.diff(np.append(first, len(own)))), w.tobytes(),
                                               _narrow(word_at), _narrow(row_at), _narrow(times[own]))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), _long(np.array(out[1], np.uint64)), pa.array(out[2], pa.int64()),
                                              *[pa.array(c, pa.binary()) for c in out[3:]]],
                                             names=[c.split()[0] for c in PACKED.split(", ")])
    return run


MERGED = ("slices array<long>, n_texts array<long>, row_keys array<binary>, texts binary, n_tokens binary, n_known binary, base binary, fixed binary, small binary, event_row binary, event_at binary, "
          "event_times binary, event_context binary, event_sums binary, hot_context binary, hot_sums binary, counts array<long>")
SUMS = CUT + 3          # per context: n-grams of count 1 .. CUT, tokens of larger counts, sum of P(w), total


def _buffers(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Buffer]]:
    """Binary columns of each row, not copied."""
    columns = {f.name: batch.column(f.name) for f in batch.schema if pa.types.is_binary(f.type)}
    for i in range(batch.num_rows):
        yield {name: column[i].as_buffer() for name, column in columns.items()}


def _unpacked(packed: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
    """Numbers (in their slices, as steps) and held-out flags of a shard's texts,
    and its tokens (context, word, row, times) dealt to ``parts`` by context."""
    texts, held, dealt, base_row = [], [], [[] for _ in range(parts)], 0
    many = iter(packed.column("n_texts").to_pylist())
    for r in (r for batch in packed.to_batches() for r in _buffers(batch)):
        n_own = next(many)
        contexts = np.frombuffer(r["contexts"], np.uint64)
        runs = _wide(r["runs"], len(contexts))
        n = int(runs.sum())
        texts.append(_wide(r["texts"], n_own))
        held.append(np.unpackbits(np.frombuffer(r["held"], np.uint8), count=n_own).astype(bool))
        part = np.repeat((mix(contexts) >> np.uint64(40)) % np.uint64(parts), runs)
        ctx, word = np.repeat(contexts, runs), np.frombuffer(r["words"], np.uint64)[_wide(r["word_at"], n)]
        row = _wide(r["row_at"], n).astype(np.int32) + np.int32(base_row)
        times = _wide(r["times"], n).astype(np.int32)
        for k in range(parts):
            at = np.flatnonzero(part == k)
            dealt[k].append((ctx[at], word[at], row[at], times[at]))
        base_row += n_own
    return np.concatenate(texts), np.concatenate(held), dealt


def _merge(plan: Plan):
    """One row per shard.  Its n-grams are merged in PARTS by context, one after
    the other, which bounds what a task holds besides the tokens."""
    types = {"binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in MERGED.split(", ")])

    def run(packed: pa.Table, rare: pa.Table) -> pa.Table:
        if not len(packed):
            return schema.empty_table()
        texts, held, dealt = _unpacked(packed, PARTS)
        cells = {name: packed.column(of).to_pylist() for name, of in (("slices", "slice"), ("n_texts", "n_texts"), ("row_keys", "row_keys"))}
        rare_w, rare_c = (rare.column(k).to_numpy() for k in ("word", "c"))
        order = np.argsort(rare_w.view(np.uint64))
        rare_w, rare_c = rare_w.view(np.uint64)[order], rare_c[order]
        del packed, rare, order
        n_rows, n_used, total = len(texts), 0, {}
        lists: dict[str, list[bytes]] = {c: [] for c in ("event_row", "event_at", "event_times", "event_context", "event_sums",
                                                         "hot_context", "hot_sums")}
        while dealt:
            tokens = dealt.pop()
            if not any(len(t[0]) for t in tokens):
                continue
            ctx, word, row, times = (np.concatenate(c) for c in zip(*tokens))
            del tokens
            sums, events, used = _merge_part(plan, held, n_rows, ctx, word, row, times, rare_w, rare_c)
            for name, value in sums.items():
                if name in total:
                    total[name] += value
                else:
                    total[name] = value
            events["event_at"] = events["event_at"] + np.int32(n_used)
            n_used += used
            for name, value in events.items():
                lists[name].append(value.tobytes())
        row = {**cells, "texts": _narrow(texts), **{c: _narrow(total[c]) for c in ("n_tokens", "n_known", "small")},
               **{c: total[c].tobytes() for c in ("base", "fixed")}, **{c: b"".join(v) for c, v in lists.items()}, "counts": total["counts"]}
        row["event_times"] = _narrow(np.frombuffer(row["event_times"], np.int32))
        return pa.Table.from_pylist([row], schema)
    return run


def _merge_part(plan: Plan, held: np.ndarray, n_rows: int, ctx: np.ndarray, word: np.ndarray, row: np.ndarray, times: np.ndarray,
                rare_w: np.ndarray, rare_c: np.ndarray) -> tuple[dict, dict, int]:
    """Sums per text, events per backed-off token, and the number of contexts
    that the events name, of some of a shard's contexts."""
    # n-grams of this part, with their training counts
    pair, first, gram = np.unique(_pair(ctx, word), return_index=True, return_inverse=True)
    h, w = ctx[first], word[first]
    c = np.bincount(gram, weights=np.where(held[row], 0, times), minlength=len(pair)).astype(np.int64)
    at, ahead = plan.find(plan.pairs, pair)
    if ahead.any():
        c[ahead] = plan.pairs_n[at[ahead]]
    at, known = plan.find(plan.head, w)
    c_w = np.where(known, plan.head_n[at] if len(plan.head_n) else 0, 0)
    at, in_rare = plan.find(rare_w, w)
    if in_rare.any():
        c_w[in_rare] = rare_c[at[in_rare]]
    p = (c_w + 1) * plan.unknown
    # contexts
    contexts, of = np.unique(h, return_inverse=True)
    own = ~ahead                                      # n-grams counted ahead are added once, at the end
    sums = np.zeros((len(contexts), SUMS))
    for r in range(1, CUT + 1):
        sums[:, r - 1] = np.bincount(of, weights=own & (c == r), minlength=len(contexts))
    sums[:, CUT] = np.bincount(of, weights=np.where(own & (c > CUT), c, 0), minlength=len(contexts))
    sums[:, CUT + 1] = np.bincount(of, weights=np.where(own & (c > 0), p, 0.0), minlength=len(contexts))
    total = np.bincount(of, weights=np.where(own, c, 0), minlength=len(contexts))
    at, is_hot = plan.find(plan.hot, contexts)
    if is_hot.any():
        total[is_hot] = plan.hot_n[at[is_hot]]
    sums[:, CUT + 2] = total
    # texts
    add = lambda value: np.bincount(row, weights=value, minlength=n_rows)
    log_p = np.log10(p)
    seen = c > 0
    fixed = np.where(seen, np.log10(np.maximum(c, 1) / (total[of] + 1)), log_p)
    small = np.stack([add(np.where(c[gram] == r, times, 0)).astype(np.int32) for r in range(1, CUT + 1)], axis=1)
    backed = ~seen & (total[of] > 0)                  # these take their context's weight, too
    events = np.flatnonzero(backed[gram])
    used, event_at = np.unique(of[gram[events]], return_inverse=True)
    return ({"n_tokens": add(times).astype(np.int64), "n_known": add(np.where(c_w[gram] > 0, times, 0)).astype(np.int64),
             "base": add(times * log_p[gram]), "fixed": add(times * fixed[gram]), "small": small,
             "counts": np.bincount(np.minimum(c[own & seen], CUT + 2), minlength=CUT + 3)[1:CUT + 2]},
            {"event_row": row[events].astype(np.int32), "event_at": event_at.astype(np.int32), "event_times": times[events].astype(np.int32),
             "event_context": contexts[used], "event_sums": sums[used], "hot_context": contexts[is_hot], "hot_sums": sums[is_hot]},
            len(used))


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for h, s in zip(batch.column("hot_context").to_pylist(), batch.column("hot_sums").to_pylist()):
            sums = np.frombuffer(s, float).reshape(-1, SUMS)
            yield pa.RecordBatch.from_arrays([_long(np.frombuffer(h, np.uint64).copy()), *[pa.array(sums[:, k]) for k in range(CUT + 2)]],
                                             names=["context", *[f"s{k}" for k in range(CUT + 2)]])


SCORED = "slice long, row_keys binary, texts binary, n_tokens binary, n_known binary, base_score binary, score binary"
SCORED_ROWS = 64        # packed rows of a batch


def _finish(discount: dict[int, float], hot: np.ndarray, hot_sums: np.ndarray):
    """A shard's part of the scores, one packed row per slice."""
    rate = np.array([discount[r] for r in range(1, CUT + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r in enumerate(_buffers(batch)):
                fixed = np.frombuffer(r["fixed"], float)
                n_rows = len(fixed)
                score = fixed + _wide(r["small"], n_rows * CUT).reshape(-1, CUT) @ np.log10(rate)
                contexts, sums = np.frombuffer(r["event_context"], np.uint64), np.frombuffer(r["event_sums"], float).reshape(-1, SUMS).copy()
                at, is_hot = Plan.find(hot, contexts)
                if is_hot.any():
                    sums[is_hot, :CUT + 2] = hot_sums[at[is_hot]]
                kept = sums[:, :CUT] @ (rate * np.arange(1, CUT + 1)) + sums[:, CUT]
                weight = np.log10((1 - kept / (sums[:, CUT + 2] + 1)) / (1 - sums[:, CUT + 1]))
                extra = weight[(event_at := np.frombuffer(r["event_at"], np.int32))] * _wide(r["event_times"], len(event_at))
                score = score + np.bincount(np.frombuffer(r["event_row"], np.int32), weights=extra, minlength=len(score))
                small = [_wide(r[c], n_rows) for c in ("texts", "n_tokens", "n_known")]
                large = [np.frombuffer(r["base"], float), score]
                slices, n_texts, row_keys = (batch.column(c)[i].as_py() for c in ("slices", "n_texts", "row_keys"))
                ends = np.cumsum([0, *n_texts])
                for k in range(0, len(slices), SCORED_ROWS):
                    own = [slice(*x) for x in zip(ends[k:k + SCORED_ROWS], ends[k + 1:k + 1 + SCORED_ROWS])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slices[k:k + SCORED_ROWS], pa.int64()), pa.array(row_keys[k:k + SCORED_ROWS], pa.binary()),
                         *[pa.array([_narrow(c[x]) for x in own], pa.binary()) for c in small],
                         *[pa.array([c[x].tobytes() for x in own], pa.binary()) for c in large]],
                        names=[c.split()[0] for c in SCORED.split(", ")])
    return run


def _add(parts: pa.Table) -> pa.Table:
    """Rows (row_key, n_tokens, n_known, base_score, score) of one slice's texts
    from all shards' parts."""
    keys = np.frombuffer(next(k for k in parts.column("row_keys").to_pylist() if k), np.int64)
    counts = {c: np.zeros(len(keys), np.int64) for c in ("n_tokens", "n_known")}
    sums = {c: np.zeros(len(keys)) for c in ("base_score", "score")}
    for r in (r for batch in parts.to_batches() for r in _buffers(batch)):
        n = len(r["score"]) // 8
        at = np.cumsum(_wide(r["texts"], n) + 1) - 1
        for c, total in counts.items():
            total[at] += _wide(r[c], n)
        for c, total in sums.items():
            total[at] += np.frombuffer(r[c], float)
    return pa.table({"row_key": keys, **counts, **sums})


class Katz:
    """Model fitted on rows (row_key, text, held_out) and the scores of all of
    them: ``scores`` has (row_key, n_tokens, n_known, base_score, score)."""

    def __init__(self, rows: DataFrame, shard_tokens: int = SHARD_TOKENS):
        with small_batches(rows.sparkSession, BATCH_ROWS):      # all passes over the texts run in here
            self._fit(rows, shard_tokens)

    def _fit(self, rows: DataFrame, shard_tokens: int) -> None:
        words = stored(rows.select("text", "held_out").mapInArrow(_count_words, "word long, n long")
                       .groupBy("word").agg(F.sum("n").alias("c")), "unigrams")
        total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.unigrams, self.tokens, self.words = words, int(total["n"]), int(total["v"])
        plan = self.plan = self._plan(shard_tokens)
        rows = rows.select("row_key", "text", "held_out")
        ahead = rows.mapInArrow(_ahead(plan), "shard int, context long, word long, n long")
        ahead = stored(ahead.groupBy("shard", "context", "word").agg(F.sum("n").alias("n")), "ahead")
        hot_pairs = ahead.filter((F.col("shard") < 0) & (F.col("n") > plan.limit)).toPandas()    # at most tokens / limit
        if len(hot_pairs):
            h, w = (hot_pairs[k].to_numpy().view(np.uint64) for k in ("context", "word"))
            pair = _pair(h, w)
            order = np.argsort(pair)
            plan.pairs, plan.pairs_n = pair[order], hot_pairs["n"].to_numpy()[order]
        rare = ahead.filter("shard >= 0").select("shard", "word").join(words, "word")
        packed = rows.mapInArrow(_pack(plan), PACKED)
        merged = packed.groupBy("shard").cogroup(rare.groupBy("shard")).applyInArrow(_merge(plan), MERGED)
        self.shards = stored(merged, "katz-shards", rows_per_file=1)      # a row is a shard: tens of MB
        counts = [F.sum(F.col("counts")[k]).alias(str(k + 1)) for k in range(CUT + 1)]
        self.discount = good_turing({int(k): int(v or 0) for k, v in self.shards.agg(*counts).first().asDict().items()})
        hot = (self.shards.select("hot_context", "hot_sums").mapInArrow(
            _hot_rows, ", ".join(["context long", *[f"s{k} double" for k in range(CUT + 2)]]))
            .groupBy("context").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(CUT + 2)])).toPandas()
        contexts = hot["context"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(contexts)
        contexts, sums = contexts[order], hot[[f"s{k}" for k in range(CUT + 2)]].to_numpy(float)[order].copy()
        if len(hot_pairs):                                # each adds its tokens and its word's P(w) once
            at, _ = Plan.find(contexts, h)
            np.add.at(sums[:, CUT], at, hot_pairs["n"].to_numpy())
            in_head, _ = Plan.find(plan.head, w)
            np.add.at(sums[:, CUT + 1], at, (plan.head_n[in_head] + 1) * plan.unknown)
        self.scores = (self.shards.mapInArrow(_finish(self.discount, contexts, sums), SCORED)
                       .groupBy("slice").applyInArrow(_add, "row_key long, n_tokens long, n_known long, base_score double, score double")
                       .groupBy("row_key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]))

    def _plan(self, shard_tokens: int) -> Plan:
        """Frequent words: the most frequent powers of two of counts that
        together are at most 2^HEAD_BITS words."""
        level = F.floor(F.log2("c")).cast("int")
        least, held = 63, 0
        for r in sorted(self.unigrams.groupBy(level.alias("k")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["k"]):
            held += r["n"]
            if held > 1 << HEAD_BITS:
                break
            least = r["k"]
        limit = max(1, shard_tokens // 8, self.tokens >> 20)
        frequent = self.unigrams.filter((F.col("c") >= F.lit(float(2**least))) | (F.col("c") > limit))
        head, n = _columns(frequent.select("word", "c"))
        head = head.view(np.uint64)
        order = np.argsort(head)
        head, n = head[order], n[order]
        # as a context, START is as frequent as END; END is none
        end, found = Plan.find(head, np.array([END]))
        hot = (n > limit) & (head != END)
        contexts, many = head[hot], n[hot]
        if found[0] and n[end[0]] > limit:
            contexts, many = np.append(contexts, START), np.append(many, n[end[0]])
        order = np.argsort(contexts)
        shards = max(1, math.ceil(self.tokens * FOLDS / (FOLDS - 1) / shard_tokens))
        return Plan(shards, limit, 1.0 / (self.tokens + self.words + 1), head, n, contexts[order], many[order])


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def score_documents(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"),
                       held_out().alias("held_out"), "text")
    model = Katz(rows, shard_tokens)
    known = rows.groupBy("row_key", "doc_id", "held_out").agg(F.count("*").alias("copies"))
    joined = known.join(model.scores, "row_key").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    per = lambda c: (F.col(c) / F.col("copies")).alias(c)
    return joined.select("doc_id", "held_out", per("n_tokens").cast("long").alias("n_tokens"), per("n_known").cast("long").alias("n_known"),
                         F.lit(model.tokens).cast("long").alias("train_tokens"), per("base_score"), per("score"))
