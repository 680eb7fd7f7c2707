"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A tokenizer of the tokenizers library encodes every pre-token by itself, so a
text's token count is the sum of its pre-tokens' lengths (in tokens), and most
pre-tokens of a corpus are among few.

1. A sample of about ``SAMPLE_DOCS`` documents, chosen by a hash of the id,
   gives the ``FREQUENT`` most frequent pre-tokens; their lengths are the table
   that is broadcast (at most ``FREQUENT`` strings of ``KEPT_CHARS``
   characters).  The sample only decides what is looked up fast, never a count.
2. Every task cuts its texts into pre-tokens, looks them up in that table and,
   failing that, in a cache of its own worker; what neither holds is encoded by
   the library.  Pre-tokens are never shuffled: the only exchange is that of
   the sample's counts.

For a byte-level pre-tokenizer with the usual split rule, texts without other
characters than ``COMMON`` ones are cut by the same rule in the regex library
(tests compare the two on every such character); other texts, and other
tokenizers, by the library's own pre-tokenizer.  Long texts are cut before
white space that follows another character, which no pre-token spans.

Added tokens inside a text count one each, as the library does by default.

Defined results: a null text is empty (0 bytes, 0 tokens, not over the limit);
repeated rows and null ids are rows like others; an empty table gives no rows;
columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

LIMIT = 1024
SAMPLE_DOCS = 2_000
FREQUENT = 1 << 16     # pre-tokens in the broadcast table
CACHED = 1 << 18       # pre-tokens in a worker's cache
KEPT_CHARS = 64        # longer pre-tokens are in neither
PIECE_CHARS = 1 << 18  # longer texts are cut

# The byte-level split rule (fixed value).
BYTE_LEVEL_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Latin letters, punctuation marks and the euro sign: the regex library and the
# tokenizers library class all of them alike.
COMMON = r"\x00-\u024f\u2010-\u2027\u20ac"
# White space after a character that is none to either library.
CUT = r"(?<=[^\s\x00-\x20\u180e\u200b-\u200f\u2060\ufeff])[ \n]"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Lengths(dict):
    """Length of a pre-token: the broadcast table, then this worker's cache,
    then the library."""

    def __init__(self, table: dict[str, int], encode) -> None:
        super().__init__(table)
        self.encode = encode
        self.cache: dict[str, int] = {}

    def __missing__(self, token: str) -> int:
        known = self.cache.get(token)
        if known is None:
            known = self.encode(token)
            if len(token) <= KEPT_CHARS:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                self.cache[token] = known
        return known


class TokenCounter:
    """Pre-tokens and token counts of texts under one tokenizer file."""

    def __init__(self, path: str, table: dict[str, int] | None = None) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        if not path.endswith(".json"):
            raise ValueError("token counts need a tokenizers .json file")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lengths = _Lengths(table or {}, self._encode)
        own = self.tokenizer.pre_tokenizer
        self.byte_level = (isinstance(own, pre_tokenizers.ByteLevel) and own.use_regex and not own.add_prefix_space
                           and self.tokenizer.normalizer is None)
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.rule = regex.compile(BYTE_LEVEL_RULE)
        self.uncommon = re.compile(f"[^{COMMON}]")
        self.cut = re.compile(CUT)
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Tokens that take white space with them or match after normalisation
        # are left to the library.
        plain = [t for t in added if not (t.single_word or t.lstrip or t.rstrip or t.normalized)]
        self.added = self._any([t.content for t in plain])
        self.other_added = self._any([t.content for t in added if t not in plain])

    @staticmethod
    def _any(contents: list[str]) -> re.Pattern | None:
        longest_first = sorted(contents, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest_first))) if contents else None

    def _encode(self, token: str) -> int:
        if self.byte_level:
            ((token, _),) = self.as_bytes.pre_tokenize_str(token)
        return len(self.tokenizer.model.tokenize(token))

    def _pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PIECE_CHARS:
            cut = self.cut.search(text, start + PIECE_CHARS)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:]

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without added tokens, piece by piece."""
        tokenizer = self.tokenizer
        if not self.byte_level:
            if tokenizer.normalizer is not None:
                text = tokenizer.normalizer.normalize_str(text)
            if text:
                yield ([token for token, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
                       if tokenizer.pre_tokenizer is not None else [text])
            return
        for piece in self._pieces(text):
            if piece.isascii() or not self.uncommon.search(piece):
                yield self.rule.findall(piece)
            else:
                yield [piece[start:end] for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(piece)]

    def count(self, text: str) -> int:
        if self.other_added is not None and self.other_added.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        if self.added is None:
            parts, total = [text], 0
        else:
            parts = self.added.split(text)
            total = len(parts) - 1
        length = self.lengths.__getitem__
        return total + sum(sum(map(length, tokens)) for part in parts for tokens in self.pre_tokens(part))


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS,
                     size: int = FREQUENT) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a sample of documents."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    sample = docs.where(draw < share).select(F.coalesce("text", F.lit("")).alias("_text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        found: Counter[str] = Counter()
        for part in slices(batches, "_text"):
            for text in part.column(0).to_pylist():
                for tokens in counter.pre_tokens(text):
                    found.update(t for t in tokens if len(t) <= KEPT_CHARS)
                if len(found) > 4 * size:
                    found = Counter(dict(found.most_common(2 * size)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()))],
                                             ["token", "n"])

    counts = sample.mapInArrow(tally, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("token")).limit(size).collect()
    encode = TokenCounter(path)._encode
    return {row["token"]: encode(row["token"]) for row in top}


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of
    every document.  ``path`` is the tokenizer file, readable by all executors.

    Runs the sample's count while the plan is built."""
    path = path or default_tokenizer()
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, table.value)
        for part in slices(batches, "_text"):
            total = [counter.count(text) for text in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(total, pa.int64())],
                                             [f.name for f in schema.fields])

    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
