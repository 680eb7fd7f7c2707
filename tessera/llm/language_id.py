"""Language ID by Bayesian evidence fusion.

    posterior(l)  ~  host prior(l) * P(declared | l) * P(address | l) * P(text | l)^TEMPER

* text: byte trigrams of the whole text under one multinomial per language,
  fitted on at most SAMPLE_DOCS documents per declared language and mixed with
  a fixed share of uniform trigrams, so that unseen ones are equally likely in
  all languages whatever their sample sizes;
* declared: the declared (markup) language, through a confusion table that one
  grouped aggregation over all rows estimates against the text's own verdict;
* address: the language that the address suffix or its first path part names;
* host prior: text verdicts counted per host, shrunk (Dirichlet) towards the
  registered domain, that towards the suffix, that towards all rows.

The text is read once and its evidence (one number per language and row) is
kept in a small table; priors are grouped aggregations over it.  The languages
are the ISO 639-1 codes that any row declares, alone or with a region (en-US,
pt_BR; one grouped count); a rare one has a small sample and little prior.  A
row is rejected when it has no letter, when no language explains its
trigrams of letters better than uniform trigrams do (another language or junk:
no text_language, no language, no part in the priors), or when no language
reaches MIN_POSTERIOR.

Defined results: null text counts as empty and is rejected for lack of
letters; a text without a trigram of letters and white space only is judged by
its trigrams that have a letter; null or unknown declared language, host or address are no evidence;
repeated rows get the same answer; ties go to the first language by name;
where no row declares a language, LANGUAGES are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_rows, slices, stored, text_hash

LANGUAGES = ("de", "en", "es", "fr")   # where no row declares a language
UNIFORM = 0.02             # share of uniform trigrams in each language
SAMPLE_DOCS = 500          # documents per declared language that the text model is fitted on
CODES = 1 << 16            # hashed byte trigrams
TEMPER = 0.2               # trigrams overlap, so their log likelihoods count in part
SHRINK = 20.0              # pseudo rows with which a parent level weighs in
DECLARED_SHRINK = 10.0
ADDRESS_TRUST = 0.8        # share of addresses whose language mark is right
MIN_POSTERIOR = 0.5
# Languages that country suffixes stand for.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "es": "es", "mx": "es", "ar": "es", "fr": "fr",
                   "uk": "en", "us": "en", "au": "en", "ie": "en"}
# ISO 639-1.
ISO_LANGUAGES = tuple("""aa ab ae af ak am an ar as av ay az ba be bg bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv
dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja
jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl
nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te
tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu""".split())
# Bytes of a trigram of letters: 2 letters (and parts of other characters), 1 white space.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 13, 32]] = 1
_KIND[ord("a"):ord("z") + 1] = 2
_KIND[128:] = 2


def _codes(data: np.ndarray) -> np.ndarray:
    """Hashed trigram that starts at each byte."""
    x = data.astype(np.uint32)
    key = x[:-2] | (x[1:-1] << np.uint32(8)) | (x[2:] << np.uint32(16))
    return (key * np.uint32(2654435761)) >> np.uint32(16)


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as one byte array, each between two spaces, and the
    offsets of the texts."""
    texts = pc.utf8_lower(pc.fill_null(column, "")).cast(pa.large_string())
    padded = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts,
                                         pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    offsets = np.frombuffer(padded.buffers()[1], np.int64)[padded.offset:padded.offset + len(padded) + 1]
    data = np.frombuffer(padded.buffers()[2], np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts' trigrams, their offsets, and how much of each is
    letters (2: letters and white space, 1: with a letter, 0: without); none
    for a text of white space only."""
    data, offsets = _text_bytes(column)
    counts = np.maximum(np.diff(offsets) - 2, 0)
    codes = _codes(data) if len(data) > 2 else np.zeros(0, np.uint32)
    inside = np.ones(len(codes), bool)
    for end in offsets[1:-1]:                      # windows that cross into the next text
        inside[max(0, end - 2):end] = False
    kind = _KIND[data]
    kinds = (kind[:-2], kind[1:-1], kind[2:])
    letters = (np.maximum.reduce(kinds) == 2) * (1 + (np.minimum.reduce(kinds) > 0))
    return codes[inside], np.concatenate([[0], np.cumsum(counts)]), letters[:len(codes)][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for part in slices(batches, "text"):
        codes, offsets, _ = _trigrams(part.column("text"))
        for i, lang in enumerate(part.column("declared").to_pylist()):
            own = total.setdefault(lang, np.zeros(CODES, np.int64))
            own += np.bincount(codes[offsets[i]:offsets[i + 1]], minlength=CODES)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "code": at.astype(np.int32), "n": n[at]})


def declared_languages(df: DataFrame) -> dict[str, int]:
    """Languages of the rows (declared) and how many rows declare them."""
    counted = df.filter(F.col("declared").isin(*ISO_LANGUAGES)).groupBy("declared").agg(F.count("*").alias("n"))
    found = {r["declared"]: r["n"] for r in counted.collect()}           # as many as there are codes, at most
    return dict(sorted(found.items())) or dict.fromkeys(LANGUAGES, 0)


def fit_text_model(rows: DataFrame, languages=LANGUAGES) -> np.ndarray:
    """Log likelihood per language of each trigram code (languages x CODES)
    from rows (text, declared); the sample bounds what reaches the driver."""
    counted = rows.select("text", "declared").mapInArrow(_count, "lang string, code int, n long")
    at = {x: k for k, x in enumerate(languages)}
    table = np.zeros((len(at), CODES))
    for r in counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toLocalIterator():
        table[at[r["lang"]], r["code"]] += r["n"]
    total = table.sum(axis=1, keepdims=True)
    shares = np.where(total > 0, table / np.maximum(total, 1), 1 / CODES)
    return np.log((1 - UNIFORM) * shares + UNIFORM / CODES).astype(np.float32)


def sample_rows(df: DataFrame, languages: dict[str, int]) -> DataFrame:
    """At most SAMPLE_DOCS rows of each declared language, chosen by a hash.
    The hash leaves about twice as many before they are put in order."""
    shares = F.create_map(*[F.lit(v) for x, n in languages.items() for v in (x, min(1.0, 2.0 * SAMPLE_DOCS / max(1, n)))])
    draw = F.pmod(F.xxhash64("row_key", F.lit(17)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    few = df.filter(F.col("declared").isin(*languages)).filter(draw < F.try_element_at(shares, F.col("declared")))
    order = Window.partitionBy("declared").orderBy(draw, "row_key")
    ranked = few.select("text", "declared", "row_key").withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= SAMPLE_DOCS).select("text", "declared")


def _scorer(model: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_langs = len(model)
        for part in slices(batches, "text"):
            codes, offsets, of_letters = _trigrams(part.column("text"))
            total, gain = np.zeros((part.num_rows, n_langs)), np.full(part.num_rows, -np.inf)
            some = np.flatnonzero(np.diff(offsets))
            if len(some):                              # trigrams with a letter where none is of letters only
                most = np.maximum.reduceat(of_letters, offsets[some])
                counted = (of_letters > 0) & (of_letters == np.repeat(most, np.diff(offsets)[some]))
            for k in range(n_langs) if len(some) else ():
                own = model[k][codes]
                total[some, k] = np.add.reduceat(own, offsets[some], dtype=np.float64)
                over = np.add.reduceat(np.where(counted, own + np.float32(np.log(CODES)), 0), offsets[some], dtype=np.float64)
                gain[some] = np.maximum(gain[some], over)
            letters = pc.match_substring_regex(pc.fill_null(part.column("text"), ""), r"\p{L}")
            keep = [c for c in part.schema.names if c != "text"]
            values = pa.array(total.ravel())
            ends = pa.array(np.arange(len(total) + 1, dtype=np.int32) * n_langs)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.ListArray.from_arrays(ends, values), letters,
                                                  pa.array(gain >= 0)],
                names=[*keep, "loglik", "letters", "known"])
    return score


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def address_language(url: Column, languages=LANGUAGES) -> Column:
    """Language named by the first path part or else by the country suffix."""
    part = F.lower(F.regexp_extract(url, r"://[^/?#]*/([A-Za-z]{2})(?:[/?#-]|$)", 1))
    suffix = F.regexp_extract(host_of(url), r"\.([a-z]+)$", 1)
    known = F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv])
    return F.when(part.isin(*languages), part).otherwise(F.try_element_at(known, suffix))


def _argmax(values: Column, languages) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in languages]),
                        F.array_position(values, F.array_max(values)).cast("int"))


def _level(counted: DataFrame, key: str, parent: DataFrame | None, parent_key: str | None, languages) -> DataFrame:
    """Dirichlet-smoothed share of each language per ``key``."""
    sums = counted.groupBy(*[k for k in (key, parent_key) if k]).agg(
        *[F.sum(f"n_{x}").alias(f"n_{x}") for x in languages])
    total = sum((F.col(f"n_{x}") for x in languages), F.lit(0.0))
    if parent is None:
        return sums.select(key, *[((F.col(f"n_{x}") + 1.0) / (total + float(len(languages)))).alias(f"p_{x}")
                                  for x in languages])
    up = parent.withColumnsRenamed({f"p_{x}": f"up_{x}" for x in languages})
    return sums.join(up, parent_key).select(
        key, *[((F.col(f"n_{x}") + SHRINK * F.col(f"up_{x}")) / (total + SHRINK)).alias(f"p_{x}")
               for x in languages])


def host_priors(evidence: DataFrame, languages=LANGUAGES) -> DataFrame:
    """(host, p_<language>...) from evidence rows (host, verdict)."""
    hosts = evidence.groupBy("host").agg(
        *[F.coalesce(F.sum((F.col("verdict") == x).cast("double")), F.lit(0.0)).alias(f"n_{x}") for x in languages])
    labels = F.split("host", r"\.")
    hosts = hosts.withColumns({
        "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."),
        "suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise(""), "everything": F.lit("")})
    hosts = stored(hosts, "langid-hosts")
    top = _level(hosts, "everything", None, None, languages)
    suffixes = _level(hosts, "suffix", top, "everything", languages)
    domains = _level(hosts, "domain", suffixes, "suffix", languages)
    return _level(hosts, "host", domains, "domain", languages)


def confusion(evidence: DataFrame, languages=LANGUAGES) -> DataFrame:
    """One row per language: declared, array of log P(declared | language) in
    the order of ``languages`` (model parameters: their number squared)."""
    at = {x: k for k, x in enumerate(languages)}
    known = evidence.filter(F.col("declared").isin(*languages) & F.col("verdict").isNotNull())
    n = np.zeros((len(at), len(at)))
    for r in known.groupBy("declared", "verdict").agg(F.count("*").alias("n")).collect():
        n[at[r["declared"]], at[r["verdict"]]] = r["n"]
    prior = np.full(n.shape, 0.1 / max(1, len(at) - 1))
    np.fill_diagonal(prior, 0.9 if len(at) > 1 else 1.0)
    logs = np.log((n + DECLARED_SHRINK * prior) / (n.sum(axis=0) + DECLARED_SHRINK))
    rows = [(x, [float(v) for v in logs[k]]) for x, k in at.items()]
    return evidence.sparkSession.createDataFrame(rows, "declared string, declared_logs array<double>")


def identify(df: DataFrame, languages: dict[str, int]) -> DataFrame:
    """Fuse the evidence of rows with columns row_key (long, to draw the
    sample by), text, declared, host, address (others are carried along): adds language, posterior, text_language and
    accepted; text is dropped."""
    model = fit_text_model(sample_rows(df, languages), languages)
    carried = [f for f in df.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
                       + ["loglik array<double>", "letters boolean", "known boolean"])
    scored = df.mapInArrow(_scorer(model), schema)
    evidence = stored(scored.withColumns({"host": F.coalesce("host", F.lit("")),
                                          "verdict": F.when(F.col("known") | ~F.col("letters"), _argmax(F.col("loglik"), languages))}),
                      "langid-evidence")
    priors = host_priors(evidence, languages)
    joined = evidence.join(priors, "host").join(F.broadcast(confusion(evidence, languages)), "declared", "left")
    logs = []
    for i, x in enumerate(languages):
        declared = F.coalesce(F.col("declared_logs")[i], F.lit(0.0))
        address = (F.when(F.col("address") == x, F.lit(float(np.log(ADDRESS_TRUST))))
                   .when(F.col("address").isin(*languages), F.lit(float(np.log((1 - ADDRESS_TRUST) / max(1, len(languages) - 1)))))
                   .otherwise(F.lit(0.0)))
        logs.append(F.ln(f"p_{x}") + declared + address + F.lit(TEMPER) * F.col("loglik")[i])
    fused = joined.withColumn("_log", F.array(*logs))
    top = F.array_max("_log")
    weight = F.aggregate("_log", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    decided = fused.withColumns({"language": F.when(F.col("verdict").isNotNull(), _argmax(F.col("_log"), languages)), "posterior": F.lit(1.0) / weight,
                                 "text_language": F.col("verdict")})
    decided = decided.withColumn("accepted", F.col("letters") & F.col("known") & (F.col("posterior") >= MIN_POSTERIOR))
    names = [f.name for f in carried if f.name != "host"]
    return decided.select(*names, "host", "language", "posterior", "text_language", "accepted")


def language_code(declared: Column) -> Column:
    """The language of a declared value in lower case, without its region."""
    return F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]+)(?:[-_].*)?\s*$", 1))


def identify_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, declared (its language code), language,
    posterior, text_language, accepted, and the key (doc_id, text_hash) of its
    row."""
    rows = docs.select("doc_id", "text", language_code(F.col("lang")).alias("declared"), F.col("source").alias("host"),
                       F.lit(None).cast("string").alias("address"),
                       text_hash().alias("text_hash"), F.xxhash64("doc_id", "text").alias("row_key"))
    return identify(rows, declared_languages(rows)).drop("address", "row_key")


def identify_pages(pages: DataFrame) -> DataFrame:
    """One row per page, from its visible characters, the language of its
    markup, its address and its host."""
    html = F.coalesce("html", F.lit(""))
    visible = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?(</\1\s*>|$)|<!--.*?(-->|$)", " "),
                               r"<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2})", 1))
    languages = declared_languages(pages.select(declared.alias("declared")))
    rows = pages.select("page_id", visible.alias("text"), declared.alias("declared"),
                        host_of(F.col("url")).alias("host"), address_language(F.col("url"), languages).alias("address"),
                        F.xxhash64("page_id", "html").alias("row_key"))
    return identify(rows, languages).drop("row_key")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that language ID rejects; columns unchanged."""
    rejected = stored(identify_documents(docs).filter(~F.col("accepted")).select("doc_id", "text_hash"),
                      "langid-rejected")
    return keep_rows(docs, rejected, "left_anti")
