"""Language ID, decontamination, SentencePiece, chat rotation."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import chat_rotation, decontamination, language_id, queries, sentencepiece_fst
from tessera.llm.common import documents

SF = "/root/testdata/sf0.001"


# ---- language ID

def test_documents_are_accepted_and_identified(spark):
    rows = language_id.identify_documents(documents(spark, SF)).collect()
    assert len(rows) == 200
    assert all(r["accepted"] for r in rows)
    assert sum(r["language"] == r["declared"] for r in rows) >= 198
    assert sum(r["text_language"] == r["declared"] for r in rows) >= 195


def test_wrong_or_missing_declarations_yield_to_the_text(spark):
    d = documents(spark, SF)
    long = d.filter("length(text) > 500").limit(60)
    wrong = long.selectExpr("doc_id + 1000 as doc_id", "text", "case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then 'xx' "
                            "else case lang when 'en' then 'de' else 'en' end end as lang", "null as source")
    truth = {r["doc_id"] + 1000: r["lang"] for r in long.collect()}
    got = language_id.identify_documents(d.select("doc_id", "text", "lang", "source").unionByName(wrong)).filter("doc_id >= 1000").collect()
    assert len(got) == len(truth)
    assert sum(r["language"] == truth[r["doc_id"]] for r in got) >= 0.95 * len(truth)


def test_rejects_go_and_columns_stay(spark):
    d = spark.createDataFrame([(1, "the and of that with from", "en", "s", 3), (2, None, "en", "s", 0), (2, "", None, None, 0),
                               (3, "123 !!", "en", "s", 6), (None, "the and of", "en", "s", 9), (1, "the and of that with from", "en", "s", 3)],
                              "doc_id long, text string, lang string, source string, _text_hash int")
    out = language_id.accepted_documents(d)
    assert out.columns == d.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 1]
    assert language_id.identify_documents(d.limit(0)).count() == 0


def test_other_languages_and_junk_are_rejected(spark):
    rng = random.Random(4)
    foreign = ["Все люди рождаются свободными и равными в своем достоинстве и правах. " * 8,
               "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione.",
               "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。" * 4,
               "".join(rng.choice("!@#$%^&*()_+{}[]0123456789abcxyz") for _ in range(1000)),
               "".join(rng.choice("0123456789=%") + rng.choice("abcxyz") for _ in range(500))]
    known = ["All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience.",
             "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt."]
    d = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang", "source")
    more = spark.createDataFrame([(10**6 + i, x, None, None) for i, x in enumerate(foreign + known)],
                                 "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language_id.identify_documents(d.unionByName(more)).collect()}
    assert [got[10**6 + i]["accepted"] for i in range(7)] == [False] * 5 + [True] * 2
    assert [got[10**6 + i]["language"] for i in range(7)] == [None] * 5 + ["en", "de"]
    assert all(r["accepted"] for i, r in got.items() if i < 10**6)


def test_languages_follow_from_declared_values(spark):
    rng = random.Random(5)
    words = "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti essi sono dotati di ragione e coscienza".split()
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    d = documents(spark, SF).select("doc_id", "text", "lang", "source")
    more = spark.createDataFrame([(10**6 + i, x, "it" if i < 25 else None, None) for i, x in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    got = language_id.identify_documents(d.unionByName(more)).filter("doc_id >= 1000000").collect()
    assert len(got) == 30 and all(r["language"] == r["text_language"] == "it" and r["accepted"] for r in got)


def test_page_evidence(spark):
    rows = queries.op9_language_id_pages(spark, SF).collect()
    assert len(rows) == 50 and sum(r["language"] == r["declared"] for r in rows) >= 48
    urls = spark.createDataFrame([("http://a.example.de/x",), ("http://a.com/fr/1",), (None,), ("no",), ("http://U:p@H.Es:8/",)], "u string")
    got = [tuple(r) for r in urls.select(language_id.host_of(urls.u), language_id.address_language(urls.u)).collect()]
    assert got == [("a.example.de", "de"), ("a.com", "fr"), (None, None), ("", None), ("h.es", "es")]


def test_host_prior_shrinks_towards_domain(spark):
    ev = spark.createDataFrame([("a.x.de", "de")] * 50 + [("b.x.de", "en")] + [("c.y.com", "en")] * 50, "host string, verdict string")
    p = {r["host"]: r for r in language_id.host_priors(ev).collect()}
    assert p["b.x.de"]["p_de"] > 0.5 > p["c.y.com"]["p_de"]
    assert all(abs(sum(r[f"p_{x}"] for x in language_id.LANGUAGES) - 1) < 1e-9 for r in p.values())


# ---- decontamination

def naive_tiles(item, doc, least):
    fi, fd, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for size in range(min(len(item), len(doc)), least - 1, -1):
            for i in range(len(item) - size + 1):
                for d in range(len(doc) - size + 1):
                    if all(fi[i:i + size]) and all(fd[d:d + size]) and list(item[i:i + size]) == list(doc[d:d + size]):
                        best = (i, d, size)
                        break
                if best:
                    break
            if best:
                break
        if not best:
            return tiles
        i, d, size = best
        fi[i:i + size] = [False] * size
        fd[d:d + size] = [False] * size
        tiles.append(best)


@pytest.mark.parametrize("seed", range(8))
def test_tiles_are_greedy(seed):
    rng = np.random.default_rng(seed)
    item = rng.integers(0, 4, 18).astype(np.uint64) * np.uint64(10**15)
    doc = rng.integers(0, 4, 25).astype(np.uint64) * np.uint64(10**15)
    got = decontamination.tile(item, doc, 3)
    want = naive_tiles(item, doc, 3)
    assert [t[2] for t in got] == [t[2] for t in want]
    assert got[:1] == want[:1]


def test_reordered_passages_are_caught(spark):
    rng = random.Random(3)
    item = [f"b{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    moved = noise(30) + item[20:] + noise(10) + item[:20] + noise(5)
    shouted = [w.upper() + "!!" for w in item]
    docs = [(1, " ".join(moved)), (2, " ".join(shouted)), (3, " ".join(noise(20) + item[:24] + noise(20))), (4, None), (5, ""),
            (6, " ".join(noise(8000) + item + noise(8000))), (None, " ".join(item)), (1, " ".join(moved)), (7, "short one")]
    bench = [(10, " ".join(item)), (11, None), (12, "..."), (13, "short one"), (10, " ".join(item))]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, coverage int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = decontamination.contamination(d, b).collect()
    assert len(got) == len(docs)
    bad = sorted((r["doc_id"] or 0) for r in got if r["contaminated"])
    assert bad == [0, 1, 1, 2, 6, 7]
    assert all(0.5 < r["coverage"] < 0.8 for r in got if r["doc_id"] == 3)
    assert all(sorted(t["words"] for t in r["tiles"]) == [20, 20] for r in got if r["doc_id"] == 1)
    clean = decontamination.clean_documents(d, b)
    assert clean.columns == d.columns and sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5]
    assert decontamination.contamination(d, b.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination(d.limit(0), b).count() == 0


def test_blocks_of_the_benchmark_change_nothing(spark, monkeypatch):
    d, b = documents(spark, SF), documents(spark, SF, "benchmark")
    whole = {r["doc_id"]: r for r in decontamination.contamination(d, b).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 9)
    parts = decontamination.contamination(d, b).collect()
    assert len(parts) == len(whole)
    assert all(tuple(r[c] for c in ("coverage", "item_id", "items", "contaminated"))
               == tuple(whole[r["doc_id"]][c] for c in ("coverage", "item_id", "items", "contaminated")) for r in parts)
    assert any(r["contaminated"] for r in parts)


# ---- SentencePiece

@pytest.fixture(scope="module")
def fst():
    return sentencepiece_fst.Transducer(sentencepiece_fst.read_model())


def test_pieces_equal_the_library(fst):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    rng = random.Random(1)
    letters = "ab ▁\n\té漢😀Z1 ẞ…  'ingth.$²"
    texts = ["", " ", "  a", "a" * 3000] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x24FF), rng.randint(0x4E00, 0x9FFF)])) for _ in range(20))
              for _ in range(800)]
    for t in texts:
        ids = fst.encode(t)
        assert ids == sp.encode(t)
        assert fst.decode(ids) == t.replace("▁", " ")


def test_segments_do_not_change_the_path(fst):
    for t in ("Is and retitioning, ouen... the\nof (x)$$$ of", "a²b ². .²", "  two  spaces  "):
        normal = fst.normalise(t)
        assert [i for s in fst.segments(normal) for i in fst.shortest_path(s)] == list(fst.shortest_path(normal))


def test_cache_turnover_changes_nothing(fst, monkeypatch):
    monkeypatch.setattr(sentencepiece_fst, "CACHE", 4)
    monkeypatch.setattr(sentencepiece_fst, "ARCS", 10)
    small = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    text = "the quick brown fox jumps over the lazy dog, then the quick fox sleeps"
    assert small.encode(text) == fst.encode(text) and len(small._paths) <= 2


def unigram_model():
    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data
    import struct
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -3.5, 1), ("▁a", -2.5, 1), ("bb", -2.2, 1)]
    body = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, t])) for p, s, t in pieces)
    return body + field(2, b"\x18\x01") + field(3, b"\x18\x01\x20\x00")


def test_unigram_path_is_the_cheapest():
    fst = sentencepiece_fst.Transducer(unigram_model())
    pieces = {p: -s for p, s, t in fst.pieces if t == 1}

    def cheapest(s):
        if not s:
            return 0.0
        return min((c + cheapest(s[len(p):]) for p, c in pieces.items() if s.startswith(p)), default=float("inf"))
    for t in ("ab", "abb", "abbb", "aab bb", "b"):
        cost = sum(-fst.scores[i] for i in fst.encode(t))
        assert cost == pytest.approx(cheapest(fst.normalise(t)))


def test_round_trip_of_documents(spark):
    d = documents(spark, SF).selectExpr("*", "1 as ids").unionByName(
        spark.createDataFrame([(-1, None, "en", "s", 0, 1), (-2, "", "en", "s", 0, 1)], "doc_id long, text string, lang string, source string, n_chars long, ids int"))
    model = sentencepiece_fst.read_model()
    coded = sentencepiece_fst.encode(d, model)
    back = sentencepiece_fst.decode(coded, model)
    want = {r["doc_id"]: r["text"] or "" for r in d.collect()}
    assert {r["doc_id"]: r["text"] for r in back.collect()} == want
    assert coded.filter("not round_trip").count() == 0
    assert sentencepiece_fst.encode_documents(d.limit(0)).count() == 0


# ---- chat rotation

CONV = "conv_id long, turn long, role string, text string, speaker int"


def rotate(spark, rows):
    return chat_rotation.rotate(spark.createDataFrame([(*r, 0) for r in rows], CONV)).collect()


def test_every_speaker_is_assistant_once(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "hé"), (1, 3, "ann", None), (2, 0, "system", "alone"),
            (1, 2, "bob", "hé"), (None, None, None, "x")]
    got = {(r["conv_id"], r["speaker"]): r for r in rotate(spark, rows)}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    ann = got[1, "ann"]
    assert ann["text"] == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user name=bob|>\nhé<|end|>\n<|assistant|>\n<|end|>\n")
    assert [ann["text"][s["start"]:s["end"]] for s in ann["loss_spans"]] == ["hi < |end|><|end|>\n", "<|end|>\n"]
    assert ann["mask"] == [False, True, False, True] and ann["n_messages"] == 4
    assert got[1, "bob"]["mask"] == [False, False, True, False]


def test_long_and_tied_conversations_come_in_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"m{i}") for i in range(300)] + [(2, 0, "ab"[i % 2], f"m{i}") for i in range(1000)]
    got = rotate(spark, rows)
    assert {r["part"] for r in got if r["conv_id"] == 1} == set(range(5))
    assert max(r["n_messages"] for r in got) <= 4 * chat_rotation.PART_TURNS
    for conv, n in ((1, 300), (2, 1000)):
        own = [r for r in got if r["conv_id"] == conv]
        assert sum(r["n_messages"] for r in own) == 2 * n and sum(sum(r["mask"]) for r in own) == n
    assert rotate(spark, []) == []


def test_later_parts_open_with_the_system_message(spark):
    n = chat_rotation.PART_TURNS
    rows = [(1, 0, "system", "be kind"), (1, 1, "system", "second")] + [(1, t, "ab"[t % 2], f"t{t}") for t in range(2, 2 * n + 1)]
    rows += [(2, t, "ab"[t % 2], f"t{t}") for t in range(n + 1)] + [(2, n + 1, "system", "late")]
    got = {(r["conv_id"], r["speaker"], r["part"]): r for r in rotate(spark, rows)}
    assert len(got) == 2 * 3 + 2 * 2
    for who in "ab":
        parts = [got[1, who, k]["text"] for k in range(3)]
        assert all(p.startswith("<|system|>\nbe kind<|end|>\n") for p in parts)
        assert parts[0].count("<|system|>") == 2 and parts[1].count("<|system|>") == parts[2].count("<|system|>") == 1
        copy = len("<|system|>\nbe kind<|end|>\n")
        own = [(s, t) for c, _, s, t in rows if c == 1]
        assert parts[0] + parts[1][copy:] + parts[2][copy:] == chat_rotation.render(own, who)[0]
        for k in range(3):
            r = got[1, who, k]
            assert all(r["text"][a["start"]:a["end"]].endswith("<|end|>\n") for a in r["loss_spans"]) and len(r["mask"]) == r["n_messages"]
        assert not got[2, who, 0]["text"].startswith("<|system|>") and got[2, who, 1]["text"].count("late") == 1


def test_a_prompt_that_many_items_share_is_not_tiled_for_each(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    prompt = "answer the following question with one word"
    items = [(i, f"{prompt} {some(rng.randint(5, 30))}") for i in range(3000)] + [(None, prompt + " x"), (5000, "w1 w2"), (5001, "")]
    doc = f"{some(40)} {prompt} {some(40)} {items[7][1]} {some(3)}"
    ids = [i for i, _ in items]
    words_, offsets = decontamination.words_of(pa.array([t for _, t in items]))
    tiled = []
    real = decontamination.covered
    monkeypatch.setattr(decontamination, "covered", lambda *a: tiled.append(1) or real(*a))
    for text in (doc, some(30), prompt, f"{some(9)} {prompt}", items[9][1], "w1 w2 " + prompt):
        one = pa.record_batch({"doc_id": [1], "text_hash": [2], "text": [text]})
        tiled.clear()
        (got,) = list(decontamination._tiler(ids, words_, offsets)(iter([one])))
        assert len(tiled) < 60
        own, _ = decontamination.words_of(pa.array([text]))
        every = [(real(words_[offsets[k]:offsets[k + 1]], own)[0], ids[k]) for k in range(len(ids))]
        best = max(s for s, _ in every)
        named = [i for s, i in every if s == best and i is not None]
        got = got.to_pylist()[0]
        assert got["coverage"] == best and got["item_id"] == (min(named) if best and named else None)
        assert got["items"] == sorted(i for s, i in every if s >= decontamination.COVERAGE and i is not None)


def test_names_differ_in_more_than_case(spark):
    model = sentencepiece_fst.read_model()
    d = spark.createDataFrame([(1, "one two", 5, "x")], "doc_id long, text string, IDS int, Round_Trip string")
    coded = sentencepiece_fst.encode(d, model)
    assert coded.columns == ["doc_id", "ids", "round_trip"]
    assert sentencepiece_fst.decode(coded, model).first()["text"] == "one two"


def test_null_and_unknown_ids_decode(spark):
    model = sentencepiece_fst.read_model()
    fst = sentencepiece_fst.Transducer(model)
    ids = fst.encode("one two")
    d = spark.createDataFrame([(1, [*ids, None]), (2, None), (3, [10**6]), (4, [-1])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in sentencepiece_fst.decode(d, model).collect()}
    assert got == {1: "one two", 2: "", 3: " ⁇ "[1:], 4: " ⁇ "[1:]}


def test_a_lossy_path_is_noticed():
    fst = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    fst.bytes = {}                                  # no byte pieces: unknown characters are lost
    for text, same in (("plain words", True), ("日\U0001f9ff本", False), ("plain words", True)):
        assert fst.same(text, fst.packed(text)) == same == (fst.decode(fst.encode(text)) == text)


def test_region_tags_and_rare_languages_are_kept(spark):
    rng = random.Random(6)
    words = "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti essi sono dotati di ragione e coscienza".split()
    d = documents(spark, SF).select("doc_id", "text", "lang", "source")
    more = [(10**6 + i, " ".join(rng.choice(words) for _ in range(40)), "it", None) for i in range(4)]
    more += [(2 * 10**6 + i, t, lang, None) for i, (t, lang) in enumerate(
        [("All human beings are born free and equal in dignity and rights.", "en-US"), ("All human beings are born free.", "EN"),
         ("Alle Menschen sind frei und gleich an Würde und Rechten geboren.", " de_AT ")])]
    both = d.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string"))
    got = {r["doc_id"]: r for r in language_id.identify_documents(both).filter("doc_id >= 1000000").collect()}
    assert all(r["accepted"] for r in got.values())
    assert [got[10**6 + i]["language"] for i in range(4)] == ["it"] * 4
    assert [(got[2 * 10**6 + i]["declared"], got[2 * 10**6 + i]["language"]) for i in range(3)] == [("en", "en"), ("en", "en"), ("de", "de")]
    # where every document has a region
    only = d.withColumn("lang", F.concat("lang", F.lit("-XX")))
    assert language_id.identify_documents(only).filter("accepted").count() == d.count()


# ---- SentencePiece: character maps, user-defined pieces, decoding of every text

def trained(tmp_path, name, **options):
    lines = ["the café of ﬁne ①②③ Ｆｕｌｌ width […]", "<sep> a b <sep>c <mask> <mask>x the cat", "½ cup, don’t ﬀ ㌔ ℡ 한글"] * 30
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    sentencepiece.SentencePieceTrainer.train(input=str(tmp_path / "lines.txt"), model_prefix=str(tmp_path / name), vocab_size=330,
                                             hard_vocab_limit=False, byte_fallback=True, minloglevel=2, num_threads=1, **options)
    path = str(tmp_path / f"{name}.model")
    return sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_fst.Transducer(sentencepiece_fst.read_model(path)), path


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_character_maps_and_user_pieces_equal_the_library(tmp_path, kind, rule, squeeze):
    sp, fst, _ = trained(tmp_path, "m", model_type=kind, normalization_rule_name=rule, remove_extra_whitespaces=squeeze,
                         user_defined_symbols=["<sep>", "<mask>", "<mask>x"])
    rng = random.Random(5)
    parts = ["the ", "café", "café", "ﬁ", "①", "Ｆｕ", "  ", " ", "　", " ", "\t", "\n", "<sep>", "<mask>", "<mask>x", "<se", "x",
             "㌔", "​", "½", "한", "하", "̈", "’", "▁", "😀", "¨", "ẞ", "\u0001"]
    texts = ["", " ", "   ", "　", "​", "<sep>", " <sep> ", "a ̈"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    for t in texts:
        ids = sp.encode(t)
        assert fst.encode(t) == ids, t
        assert fst.same(t, fst.packed(t)) == (fst.decode(ids) == t.replace("▁", " ")), t


def test_every_path_is_decoded(spark, tmp_path):
    _, _, path = trained(tmp_path, "m", model_type="bpe", normalization_rule_name="nfkc")
    d = spark.createDataFrame([(1, "the cat"), (2, "ﬁne"), (3, None), (4, "a  b")], "doc_id long, text string")
    got = {r["doc_id"]: r["round_trip"] for r in sentencepiece_fst.encode_documents(d, path).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}


def test_a_wrong_path_does_not_come_back(monkeypatch):
    fst = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    monkeypatch.setattr(fst, "shortest_path", lambda segment: (fst.ids["a"],))
    assert not fst.same("two words", fst.packed("two words"))
