"""SentencePiece encoding as a shortest path in a composed transducer.

Three transducers are compiled from the model file:

* the normaliser N rewrites, leftmost and longest first, what the model's
  character map lists (user-defined pieces and other characters pass), drops
  leading, trailing and repeated spaces where the model asks for it, puts a space
  in front of a non-empty text and maps spaces to U+2581;
* the piece transducer P spells each vocabulary piece from characters, with an
  arc per piece, and falls back to one byte piece per UTF-8 byte where a
  character has no piece (or to <unk> where the model has no byte pieces); a
  user-defined piece stays whole;
* the grammar G weighs sequences.  For a unigram model an arc's weight is the
  piece's negative score.  For a BPE model G has one state per piece, and the
  arc from piece a to piece b weighs 0 if merging a+b by rank yields exactly
  (a, b), else infinity: a sequence is the BPE encoding of its text if and
  only if all its neighbours are stable in this sense, so the only finite path
  is the encoding.

A text t is encoded by composing N o t with P and G and taking the shortest
path in the tropical semiring (min, +), position by position.  A character run
that no piece can cross (before U+2581 that follows another character, and
around punctuation that the vocabulary never joins with other characters)
is a segment of the lattice, so the path of a text is the concatenation of its
segments' paths; segments repeat, and a task keeps the paths of at most CACHE
of them, packed, and joins them for a text.

Decoding is the inverse transducer: pieces to characters, byte pieces to
UTF-8, U+2581 to space, without the first one.  Every text's path is decoded to
see whether the text comes back.

Defined results: null and empty texts have no ids; U+2581 in a text decodes to
a space, as in the reference format; repeated rows are encoded alike.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHE = 400_000                # segments whose path a task keeps (about 250 bytes each); half of them outlive it
ARCS = 500_000                 # weighed arcs of G that a task keeps
LONG_SEGMENT = 64              # longer ones are not kept
ID = np.dtype("i4")
INF = float("inf")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # fixed values of the model format
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        n = shift = 0
        while True:
            b = data[i]
            i += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n
    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[i:i + n]
            i += n


def _character_map(blob: bytes) -> dict[str, str]:
    """What a model's character map rewrites, and to what: a double array over
    UTF-8 bytes (its size, its units), then the outputs, each closed by 0."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, outputs = np.frombuffer(blob, "<u4", size // 4, 4), blob[4 + size:]
    labels, found = np.arange(1, 256, dtype=np.uint32), {}

    def base(at: int) -> int:
        unit = int(units[at])
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))
    todo = [(base(0), b"")]
    while todo:
        at, key = todo.pop()
        near = at ^ labels
        near = near[near < len(units)]
        for child in near[(units[near] & np.uint32(0x800000FF)) == (near ^ at)].tolist():
            own = key + bytes([child ^ at])
            if int(units[child]) >> 8 & 1:
                start = int(units[base(child)]) & 0x7FFFFFFF
                found[own.decode()] = outputs[start:outputs.index(b"\0", start)].decode()
            todo.append((base(child), own))
    return found


def _tree(words: dict[str, object]) -> dict:
    """Words as a tree: character -> (arcs from there, the word's value or None)."""
    root: dict = {}
    for word in sorted(words):                                 # prefixes first
        node = root
        for c in word[:-1]:
            node = node.setdefault(c, ({}, None))[0]
        node[word[-1]] = (node.get(word[-1], ({}, None))[0], words[word])
    return root


def _longest(root: dict, text: str, at: int) -> tuple[int, object]:
    """End and value of the longest word of a tree that starts at ``at``, or
    (at, None)."""
    node, found = root, (at, None)
    for j in range(at, len(text)):
        arc = node.get(text[j])
        if arc is None:
            break
        node, value = arc
        if value is not None:
            found = j + 1, value
    return found


class Normaliser:
    """N: rewriting arcs over the identity, and whether the output so far ends
    in a space as its state."""

    def __init__(self, spec: dict, whole: list[str]):
        rewritten = _character_map(spec.get(2, b""))
        self.dummy_prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.whole, self.arcs = _tree({p: p for p in whole}), _tree(rewritten)
        first = {*self.whole, *self.arcs} if rewritten else set()
        self._first = re.compile(f"[{re.escape(''.join(sorted(first)))}]") if first else None

    def _outputs(self, text: str) -> Iterator[str]:
        """Outputs of the arcs along the text; arcs of the identity in runs."""
        i, n = 0, len(text)
        while i < n:
            at = self._first.search(text, i) if self._first else None
            if at is None:
                yield from self._run(text[i:])
                return
            j = at.start()
            if j > i:
                yield from self._run(text[i:j])
            end, out = _longest(self.whole, text, j)
            if out is None:
                end, out = _longest(self.arcs, text, j)
            i = end if out is not None else j + 1
            yield text[j] if out is None else out

    def _run(self, run: str) -> Iterator[str]:
        if self.squeeze:
            yield from re.findall(" |[^ ]+", run)
        else:
            yield run

    def compose(self, text: str) -> str:
        """The output of N o text."""
        if self.squeeze:
            parts, spaced, some = [], True, False
            for own in self._outputs(text):
                some = some or own != " "
                own = own.lstrip(" ") if spaced else own
                if own:
                    parts.append(own)
                    spaced = own[-1] == " "
        else:
            parts, some = self._outputs(text), text
        if not some:
            return ""
        out = "".join(parts)
        out = (" " + out if self.dummy_prefix else out).replace(" ", SPACE)
        return out.rstrip(SPACE) if self.squeeze else out


class Transducer:
    """The compiled transducers of one model."""

    def __init__(self, model: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("unigram and BPE models only")
        self.pieces = pieces
        self.ids = {p: k for k, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER)}
        self.whole = {p: k for k, (p, _, t) in enumerate(pieces) if t == USER}
        self.normaliser = Normaliser(normaliser, list(self.whole))
        self.dummy_prefix = self.normaliser.dummy_prefix
        normal = [s for _, s, t in pieces if t == NORMAL]
        self.least, most = min(normal, default=0.0), max(normal, default=0.0)
        # a user-defined piece outweighs others (fixed rule of the format, its length in bytes)
        self.scores = [len(p.encode()) * most - 0.1 if t == USER else s for p, s, t in pieces]
        self.bytes = {int(p[3:5], 16): k for k, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.unknown = next((k for k, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        self.surface: list[str | int] = [int(p[3:5], 16) if t == BYTE else "" if t == CONTROL else " ⁇ " if t == UNKNOWN else p
                                         for p, _, t in pieces]
        surface = [bytes([x]) if isinstance(x, int) else x.replace(SPACE, " ").encode() for x in self.surface]
        self._spelt = pa.array(surface, pa.binary())
        self._stable: dict[int, dict[int, bool]] = {}
        self._arcs = 0
        self._paths = _Paths(self)
        self.root = self._spelling()
        self._cut = self._cuts()
        self._apart = (re.compile("|".join(re.escape(p) for p in sorted(self.whole, key=len, reverse=True)))
                       if self.whole and self.kind == BPE else None)

    def _cuts(self) -> re.Pattern | None:
        """Segments that no piece crosses: U+2581 with what follows up to the
        next one, where punctuation that pieces never join with other
        characters stands apart."""
        body = [p.lstrip(SPACE) for p in self.ids]
        if any(SPACE in p for p in body):
            return None                            # pieces cross words
        marks = {c for p in body for c in p if unicodedata.category(c)[0] in "PSZC"} | {"\n"}
        while joined := {c for p in body if not marks.isdisjoint(p) for c in p} - marks:
            marks |= joined                        # with what some piece joins to them
        if any(c.isascii() and c.isalpha() for c in marks):
            marks = {"\n"} - {c for p in body if len(p) > 1 for c in p}
        own = re.escape("".join(sorted(marks)))
        if not own:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"{SPACE}*(?:[{own}]+|[^{SPACE}{own}]+)|{SPACE}+")

    def normalise(self, text: str) -> str:
        """Composition of the text with N."""
        return self.normaliser.compose(text)

    def segments(self, normal: str) -> list[str]:
        """Under BPE nothing merges with a user-defined piece: each is a segment."""
        if self._apart is None:
            return self._between(normal)
        out, i = [], 0
        for found in self._apart.finditer(normal):
            out += self._between(normal[i:found.start()])
            out.append(found.group())
            i = found.end()
        return out + self._between(normal[i:])

    def _between(self, normal: str) -> list[str]:
        return self._cut.findall(normal) if self._cut else [normal] if normal else []

    def merge(self, text: str) -> list[str]:
        """Pieces after merging neighbours by the best score, leftmost first
        (the definition that G's arcs encode; used for pairs of pieces)."""
        parts = list(text)
        while True:
            best, at = -INF, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and self.scores[i] > best:
                    best, at = self.scores[i], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _spelling(self) -> dict:
        """P as a tree: character -> (arcs from there, piece spelt or -1).
        Pieces that merging never yields have no path."""
        root: dict = {}
        for piece, k in sorted(self.ids.items()):          # prefixes first
            if self.kind == BPE and len(piece) > 1 and self.merge(piece) != [piece]:
                continue
            node = root
            for c in piece[:-1]:
                node = node.setdefault(c, ({}, -1))[0]
            node[piece[-1]] = (node.get(piece[-1], ({}, -1))[0], k)
        return root

    def stable(self, a: int, b: int) -> bool:
        """Whether G's arc from piece a to piece b has weight 0 (BPE)."""
        left, right = self.pieces[a][0], self.pieces[b][0]
        if self._arcs >= ARCS:
            self._stable.clear()
            self._arcs = 0
        self._arcs += 1
        ok = self._stable.setdefault(a, {})[b] = self.merge(left + right) == [left, right]
        return ok

    def shortest_path(self, segment: str) -> tuple[int, ...]:
        """Piece ids of the shortest path through segment o P o G.

        Positions are states in topological order.  Under BPE a position has
        one finite state, its last piece: all other paths to it weigh
        infinity.  Characters without a piece neither merge nor constrain."""
        n, bpe = len(segment), self.kind == BPE
        weight = [INF] * (n + 1)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        weight[0] = 0.0
        root, scores, none = self.root, self.scores, {}
        if bpe and segment in self.whole:
            return (self.whole[segment],)
        missing = 0.0 if bpe else 10.0 - self.least
        for i in range(n):
            cost = weight[i]
            if cost == INF:
                continue
            a, node = last[i], root
            known = self._stable.get(a, none)
            for j in range(i, n):
                arc = node.get(segment[j])
                if arc is None:
                    break
                node, b = arc
                if b < 0:
                    continue
                if bpe:
                    if a >= 0:
                        ok = known.get(b)
                        if not (self.stable(a, b) if ok is None else ok):
                            continue
                    weight[j + 1], last[j + 1], back[j + 1] = cost, b, i
                elif cost - scores[b] < weight[j + 1]:
                    weight[j + 1], last[j + 1], back[j + 1] = cost - scores[b], b, i
            if segment[i] not in root or root[segment[i]][1] < 0:      # bytes, or unknown
                if cost + missing < weight[i + 1]:
                    weight[i + 1], last[i + 1], back[i + 1] = cost + missing, -1, i
        out: list[int] = []
        j = n
        while j > 0:
            i = back[j]
            if last[j] >= 0:
                out.append(last[j])
            else:
                raw = segment[i].encode("utf-8", "replace")
                out += [self.bytes[b] for b in reversed(raw)] if self.bytes else [self.unknown]
            j = i
        out.reverse()
        return tuple(out)

    def packed(self, text: str | None) -> bytes:
        """Piece ids of a text, four bytes each: its segments' paths in a row."""
        return b"".join(map(self._paths.__getitem__, self.segments(self.normalise(text or ""))))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), ID).tolist()

    def same(self, text: str | None, packed: bytes) -> bool:
        """Whether the ids decode to the text."""
        ids = np.frombuffer(packed, ID)
        return self.came_back(pa.array([text], pa.string()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))[0].as_py()

    def came_back(self, texts: pa.Array, ids: pa.ListArray) -> pa.Array:
        """Whether each text's ids decode to it (U+2581 as a space): the inverse
        transducer, arc by arc, over all paths of a slice."""
        spelt = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self._spelt.take(ids.values)), b"").cast(pa.large_binary())
        want = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ").cast(pa.large_binary())
        if not self.dummy_prefix:
            return pc.equal(spelt, want)
        led = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), want, pa.scalar(b"", pa.large_binary()))
        return pc.if_else(pc.starts_with(spelt, b" "), pc.equal(spelt, led), pc.equal(spelt, want))

    def decode(self, ids) -> str:
        surface, parts, raw = self.surface, [], bytearray()
        for i in ids:
            if i is None:
                continue
            s = surface[i] if 0 <= i < len(surface) else surface[self.unknown]
            if s.__class__ is int:
                raw.append(s)
            else:
                if raw:
                    parts.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                parts.append(s)
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        text = "".join(parts).replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


class _Paths(dict):
    """Shortest paths of segments, packed; those used since the last two
    turnovers are kept."""

    def __init__(self, fst: Transducer):
        super().__init__()
        self.fst, self.older = fst, {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = array("i", self.fst.shortest_path(segment)).tobytes()
        if len(segment) <= LONG_SEGMENT:
            if len(self) >= CACHE // 2:
                self.older = dict(self)
                self.clear()
            self[segment] = found
        return found


_COMPILED: dict[int, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """The transducers of a model, compiled once per worker process."""
    key = hash(model)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _others(df: DataFrame, *replaced: str) -> list:
    """Fields of ``df`` without those called like ``replaced`` in any case."""
    names = {name.lower() for name in replaced}
    return [f for f in df.schema.fields if f.name.lower() not in names]


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", check: str = "round_trip") -> DataFrame:
    """``df`` with the ids of ``text`` in place of the text, and whether
    decoding them gives the text back.  Columns of ``df`` that are called like
    the new ones, in any case, are replaced."""
    fields = _others(df, text, ids, check)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + [f"`{ids}` array<int>", f"`{check}` boolean"])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model)
        for part in slices(batches, text):
            coded = [fst.packed(t) for t in part.column(text).to_pylist()]
            ends = np.cumsum([0, *[len(own) // ID.itemsize for own in coded]], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(coded), ID))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [lists, fst.came_back(part.column(text), lists)],
                                             names=[*names, ids, check])
        fst._paths.older = {}
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text of ``ids`` in place of the ids (null: empty).  A
    null id spells nothing, an id outside the vocabulary what the unknown piece
    spells.  A column of ``df`` that is called like the new one is replaced."""
    fields = _others(df, ids, text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{text}` string"])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model)
        for batch in batches:
            texts = [fst.decode(i or []) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(texts, pa.string())],
                                             names=[*names, text])
    return df.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """One row per document: doc_id, ids, n_ids, round_trip."""
    return (encode(docs.select("doc_id", "text"), read_model(model_path))
            .select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip"))
