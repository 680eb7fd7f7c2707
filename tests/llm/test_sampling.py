"""Importance resampling, embedding whitening and token counts against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm import embedding_whitening, importance_resampling, queries, token_counts
from tessera.llm.common import documents
from tools.oracle_check import duck

SF = "/root/testdata/sf0.001"

# ---- importance resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def buckets(text):
    words = WORD.findall(lower(text or ""))
    runs = [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute_draw(rows, target):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    coded = [(i, *buckets(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, b in coded:
        s.update(b)
    for text in target:
        t.update(buckets(text)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (ss + 10_000.0) / ((s[b] + 1.0) * (tt + 10_000.0))))
            for b in range(10_000)]
    out = []
    for i, n, b in coded:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        out.append((i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = Counter()
    rest = {}
    for place, r in enumerate(fit[:5 * len(fit) // 100], 1):
        rest.setdefault(r[:4], []).append(place)
    result = []
    for r in out:
        left = rest.get(r[:4])
        result.append((*r[:4], left.pop(0) if left and r[4] >= 20 else None))
    assert not ranks
    return result


def key(row):
    return tuple((v is None, v) for v in row)


def drawn(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(11)
    vocabulary = ["Über", "straße", "naïve", "12", "a1b2", "WORLD", "x" * 200, "日本語", "İx", "été", "foo", "bar"]
    text = lambda n: rng.choice([" ", "-", "\n", "\t,"]).join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " .,-"), (403, "one"), (404, "two words"), (405, "a\x00b"), (None, text(40)), (None, None)]
    rows += [(500, "same row " * 30)] * 60                     # repeated rows
    rows += [(600 + i, "same text " * 30) for i in range(40)]   # copies
    rows += [(700, "very long text, " * 60_000), (701, "y" * 600_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n_words string, _part int")


def test_draw_is_brute_force(spark, odd_rows):
    target = ["foo bar world", "straße über 12", None, "foo bar world foo bar"]
    got = importance_resampling.resample(frame(spark, odd_rows), spark.createDataFrame([(t,) for t in target], "text string"))
    want = brute_draw(odd_rows, target)
    assert drawn(got) == sorted(want, key=key)
    assert sorted(r["rank"] for r in got.where("drawn").collect()) == list(range(1, got.where("drawn").count() + 1))


def test_draw_on_the_tables(spark):
    d, b = documents(spark, SF), documents(spark, SF, "benchmark")
    want = brute_draw([(r["doc_id"], r["text"]) for r in d.collect()], [r["text"] for r in b.collect()])
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert drawn(got) == sorted(want, key=key)
    assert sorted(duck(SF).execute(importance_resampling.SQL).fetchall(), key=key) == drawn(got)


def test_draw_ties_fall_to_the_smaller_id(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(importance_resampling, "gumbel", lambda doc_id="doc_id": F.lit(0).cast("long"))
    same = frame(spark, [(i, "word " * 25) for i in range(100, 0, -1)])
    got = importance_resampling.resample(same, same.limit(0)).where("drawn").orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2, 3, 4, 5]


def test_draw_of_empty_tables(spark, odd_rows):
    empty = frame(spark, [])
    assert importance_resampling.resample(empty, empty).count() == 0
    got = importance_resampling.resample(frame(spark, odd_rows[:50]), empty)
    assert drawn(got) == sorted(brute_draw(odd_rows[:50], []), key=key)


def test_drawn_documents_keep_their_columns(spark, odd_rows):
    df = frame(spark, odd_rows[:300])
    out = importance_resampling.drawn_documents(df, df.limit(5))
    fit = sum(buckets(t)[0] >= 20 for _, t in odd_rows[:300])
    assert out.columns == df.columns and out.count() == 5 * fit // 100 > 0


def test_run_crcs_are_zlib():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcß日") for _ in range(rng.choice([1, 3, 20, 64, 65, 300, 5000]))).encode() for _ in range(40)]
    runs = importance_resampling.run_crcs(np.array([zlib.crc32(w) for w in words], np.uint32),
                                          np.array([len(w) for w in words], np.int64))
    for k, run in enumerate(runs, 1):
        assert run.tolist() == [zlib.crc32(b" ".join(words[i:i + k])) for i in range(len(words) - k + 1)]


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("ab é.\n9") for _ in range(5000))
    whole = importance_resampling.Words().of(text)
    monkeypatch.setattr(importance_resampling, "PIECE_CHARS", 50)
    cut = importance_resampling.Words().of(text)
    assert all((a == b).all() for a, b in zip(whole, cut))


# ---- embedding whitening

def brute_white(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:8]
    return ((n * x - s) ** 2).sum(1), centred @ (vecs[:, order] / np.sqrt(values[order])), values[order] / np.trace(cov)


def check_white(rows, ids, vectors):
    """Rows against numpy, up to the sign of each component."""
    dev, white, explained = brute_white(vectors)
    k = white.shape[1]
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    sign = {}
    for c in range(1, k + 1):
        dot = sum(got[i][c][0]["whitened"] * white[at, c - 1] for at, i in enumerate(ids))
        sign[c] = 1 if dot > 0 else -1
    for at, i in enumerate(ids):
        assert sorted(got[i]) == list(range(1, k + 1))
        for c in range(1, k + 1):
            assert all(r["n"] == len(ids) and r["deviation"] == dev[at] for r in got[i][c])
            assert got[i][c][0]["whitened"] * sign[c] == pytest.approx(white[at, c - 1], abs=1e-8)
            assert got[i][c][0]["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
            assert got[i][c][0]["identity_error"] < 1e-10


def test_whitening_of_the_table(spark):
    rows = documents(spark, SF, "embeddings").collect()
    got = queries.op12_embedding_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_white(got.collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def vectors(spark, rows, kind="array<float>"):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding {kind}, row int, x string")


def test_whitening_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_whitening, "ROWS_PER_BLOCK", 16)
    rng = np.random.default_rng(1)
    data = (rng.normal(size=(333, 12)) * np.linspace(3, 0.5, 12)).astype(np.float32).tolist()
    df = vectors(spark, list(enumerate(data))).repartition(5)
    got = embedding_whitening.whiten(df).collect()
    assert len(got) == 333 * 8
    check_white(got, list(range(333)), data)


def test_invalid_vectors_are_dropped(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(40, 3)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(data)] + [(100 + i, v) for i, v in enumerate(bad)]
    rng.shuffle(rows)
    got = embedding_whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 40 * 3                       # fewer dimensions than 8 components
    check_white(got, list(range(40)), data)


def test_repeated_rows_and_null_ids_count(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(30, 4)).astype(np.float32).tolist()
    rows = [(i, data[i]) for i in range(30)] + [(5, data[5])] * 20 + [(None, data[6])]
    got = embedding_whitening.whiten(vectors(spark, rows)).collect()
    counts = Counter(r["vec_id"] for r in got)
    assert len(got) == 51 * 4 and counts[5] == 21 * 4 and counts[None] == 4
    dev, white, _ = brute_white([v for _, v in rows])
    assert {r["deviation"] for r in got if r["vec_id"] == 5} == {dev[5]}


def test_flat_components_and_empty_tables(spark):
    assert embedding_whitening.whiten(vectors(spark, [])).count() == 0
    assert embedding_whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    same = embedding_whitening.whiten(vectors(spark, [(i, [0.5, 0.25]) for i in range(9)])).collect()
    assert len(same) == 18 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0
                                   and r["identity_error"] == 0.0 for r in same)
    line = embedding_whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    live = [r for r in line if r["component"] == 1]
    assert all(abs(r["explained"] - 1) < 1e-9 and r["whitened"] is not None for r in live)
    assert all(r["whitened"] is None for r in line if r["component"] > 1)


def test_large_entries_keep_exact_deviations(spark):
    data = [[2.0 ** 40, 1.0], [-(2.0 ** 40), 0.0], [0.0, 3.0]]
    got = embedding_whitening.whiten(vectors(spark, list(enumerate(data)), "array<double>")).collect()
    assert len(got) == 6 and all(r["deviation"] is None for r in got if r["vec_id"] < 2)
    x = [[int(1024 * v) + 100_000 for v in row] for row in data]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert exact[0] > 2 ** 63 and {r["deviation"] for r in got if r["vec_id"] == 2} == {exact[2]}


# ---- token counts

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.default_tokenizer())


def tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_of_the_table(spark, library):
    rows = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    got = queries.op13_token_counts(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = {(i, len((t or "").encode()), tokens(library, t), tokens(library, t) > 1024) for i, t in rows.items()}
    assert {tuple(r) for r in got.collect()} == want


def test_odd_texts(spark, library):
    rng = random.Random(8)
    letters = " \n\t '\x1c\x00\x85abcséñ12.,!-$’　中文🙂́İ​﻿"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "<|endoftext|>"), (503, "a <|endoftext|><|endoftext|> b  <|endoftext|>  "),
             (504, "we've they'll I'M 's  's"), (None, "null id"), (505, "x" * 100_000), (506, "so many words " * 50_000),
             (507, " " * 300_000 + "end"), (506, "repeated id"), (508, "<|endoftext|" + "é" * 70)]
    df = spark.createDataFrame([(*r, 3, "z") for r in rows], "doc_id long, text string, n_tokens int, _text string")
    got = Counter(tuple(r) for r in token_counts.count_tokens(df).collect())
    assert got == Counter((i, len((t or "").encode()), tokens(library, t), tokens(library, t) > 1024) for i, t in rows)
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def test_common_characters_are_cut_alike(library):
    """Every character of COMMON, in several contexts, by both libraries."""
    counter = token_counts.TokenCounter(token_counts.default_tokenizer())
    common = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20ac]]
    assert not any(counter.uncommon.search(c) for c in common) and counter.uncommon.search("ɐ")
    for c in common:
        for text in (f"a{c}b", f" {c} {c}1", f"{c}{c} x", f"1{c}'s", f"  {c}  "):
            want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert counter.rule.findall(text) == want
            assert counter.count(text) == tokens(library, text)


def test_long_texts_are_cut_where_no_token_spans(library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 20)
    rng = random.Random(9)
    counter = token_counts.TokenCounter(token_counts.default_tokenizer())
    for _ in range(200):
        text = "".join(rng.choice(" \n\t\x1c ab'se1.é中") for _ in range(300))
        assert counter.count(text) == tokens(library, text)


def test_worker_cache_stays_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 10)
    counter = token_counts.TokenCounter(token_counts.default_tokenizer(), {"the": 1})
    text = " ".join(f"the w{i}" for i in range(100))
    assert counter.count(text) == tokens(library, text) and len(counter.lengths.cache) <= 10
    assert set(counter.lengths) == {"the"}


def test_other_tokenizer_files(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    texts = ["Hello  World! we've 123", "", "<|startoftext|>a B\n\nc", "Ünï cödé"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path).collect()}
    assert got == {i: len(other.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    with pytest.raises(ValueError):
        token_counts.TokenCounter(public_tokenizers.path("piece_bpe_32k.model"))


def test_schemas(spark):
    assert queries.op13_token_counts(spark, SF).schema["over_limit"].dataType == T.BooleanType()
    types = dict(queries.op11_importance_resampling(spark, SF).dtypes)
    assert set(types.values()) == {"bigint"}
