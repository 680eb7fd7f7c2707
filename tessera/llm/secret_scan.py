"""Secret scan: fixed patterns, and a battery of randomness tests.

Three patterns find assignments, access keys and hexadecimal runs.  Further
tokens of 20 or more characters are put to three tests of the hypothesis that
they are random strings in their inferred encoding: chi-squared uniformity
over the encoding's alphabet, a runs test about the alphabet's middle, and
lag-one serial correlation; Fisher's method combines the p-values.  Tokens for
which the hypothesis is rejected are words, names or paths.  Rejections are
controlled at a false-discovery rate of FDR within strata of encoding and
length (Benjamini-Hochberg on a fine grid of p-values), and a stratum's
survivors only count as secrets from the length on at which the battery would
reject ordinary writing (`least_length`).

All steps are DataFrame functions.  A match's position follows from the
lengths of the matches and of the gaps between them.  The texts are read once;
their candidates are kept in a small table, from which the thresholds (one
number per stratum) are aggregated.

Defined results: null text is empty; repeated rows are each scanned; a text
without findings has counts 0 and empty span lists; positions are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Patterns and least lengths of the base kinds.
ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"      # AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"             # [0-9a-f]+ of 24 or more characters
LEAST_ASSIGN = 6
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
FDR = 0.05
POWER_Z = 2 * 1.645                # 5 % level and 95 % power
COINCIDENCE = 0.0667               # chance that two letters of English writing are equal
STEPS = 20                         # grid points per power of ten of a p-value
MOST_STEPS = 400

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Encoding: (pattern, alphabet), the first that fits.
ENCODINGS = {
    "decimal": ("^[0-9]+$", DIGITS),
    "hex": ("^[0-9a-f]+$", DIGITS + "abcdef"),
    "HEX": ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    "base32": ("^[A-Z2-7]+$", UPPER + "234567"),
    "base62": ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    "mixed": ("", UPPER + LOWER + DIGITS + "+/-_"),
}
NOT_SECRET = ("decimal",)          # digits alone are numbers


def least_length(symbols: int) -> int:
    """Length at which the chi-squared test rejects ordinary writing."""
    excess = max(symbols * COINCIDENCE - 1.0, 0.6)
    return math.ceil(POWER_Z * math.sqrt(2.0 * (symbols - 1)) / excess)


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, hit>>."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(
        F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        found = F.array(F.struct(begin.alias("start"), (begin + x["size"]).alias("end"), x["hit"].alias("hit")))
        return F.struct(F.coalesce(begin + x["size"], begin).alias("at"),
                        F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"))
    return F.when(F.size(hits) > 0, F.aggregate(pairs, start, add, lambda acc: acc["out"])).otherwise(start["out"])


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (polynomial 26.2.17 of Abramowitz and
    Stegun, error below 1e-7)."""
    a = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2.0) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1.0 - upper)


def _let(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def p_random(token: Column, alphabet: Column) -> Column:
    """Combined p-value of the hypothesis that ``token`` is a random string
    over ``alphabet``."""
    def tests(s: Column) -> Column:
        x, n, k = s["x"], s["n"], s["k"]
        chi = k / n * s["pairs"] - n
        df = k - 1.0
        p_chi = normal_tail((F.pow(chi / df, F.lit(1 / 3)) - (1.0 - 2.0 / (9.0 * df))) / F.sqrt(2.0 / (9.0 * df)))
        ones = s["ones"]
        expected = 2.0 * ones * (n - ones) / n
        spread = expected * (expected - 1.0) / (n - 1.0)
        p_runs = F.when(spread > 0, 2.0 * normal_tail(F.abs((s["runs"] - expected - 1.0) / F.sqrt(spread)))).otherwise(0.0)
        variance = s["squares"] - s["sum"] * s["sum"] / n
        mean = s["sum"] / n
        # sum of (x_i - m)(x_{i+1} - m) from plain sums
        lagged = s["lag"] - mean * (2.0 * s["sum"] - x[0] - F.element_at(x, -1)) + (n - 1.0) * mean * mean
        p_serial = F.when(variance > 0, 2.0 * normal_tail(F.abs((lagged / variance + 1.0 / n) * F.sqrt(n)))).otherwise(0.0)
        half = sum((-F.ln(F.greatest(p, F.lit(1e-30))) for p in (p_chi, p_runs, p_serial)), F.lit(0.0))
        return F.least(F.exp(-half) * (1.0 + half + half * half / 2.0), F.lit(1.0))

    def sums(v: Column) -> Column:
        x, k = v["x"], v["k"]
        total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, b: a + b)
        after = F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0)))
        before = F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0)))
        high = lambda c: F.when(c * 2.0 >= k, 1.0).otherwise(0.0)
        return F.struct(x.alias("x"), F.size(x).cast("double").alias("n"), k.alias("k"),
                        total(F.transform(F.split(v["token"], ""), lambda c: (
                            F.length(v["token"]) - F.length(F.replace(v["token"], c, F.lit("")))).cast("double"))).alias("pairs"),
                        total(x).alias("sum"), total(F.transform(x, lambda c: c * c)).alias("squares"),
                        total(F.zip_with(before, after, lambda a, b: a * b)).alias("lag"),
                        total(F.transform(x, high)).alias("ones"),
                        (total(F.zip_with(before, after, lambda a, b: F.abs(high(a) - high(b)))) + 1.0).alias("runs"))
    symbols = F.transform(F.split(token, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    first = F.struct(token.alias("token"), symbols.alias("x"), F.length(alphabet).cast("double").alias("k"))
    return _let(first, lambda v: _let(sums(v), tests))


def _encoding(token: Column) -> Column:
    out = F.lit("mixed")
    for name, (pattern, _) in reversed([e for e in ENCODINGS.items() if e[1][0]]):
        out = F.when(token.rlike(pattern), name).otherwise(out)
    return out


def _candidates(tokens: Column) -> Column:
    """Encoding, stratum and p-value step of each token span."""
    alphabets = F.create_map(*[F.lit(x) for name, (_, a) in ENCODINGS.items() for x in (name, a)])
    least = F.create_map(*[x for name, (_, a) in ENCODINGS.items() for x in (F.lit(name), F.lit(least_length(len(a))))])

    def described(s: Column) -> Column:
        bare = F.regexp_replace(s["hit"], "=+$", "")

        def rated(name: Column) -> Column:
            p = p_random(bare, F.element_at(alphabets, name))
            step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS), F.lit(MOST_STEPS)).cast("int")
            band = F.floor(F.log2(F.length(bare).cast("double")) * 2).cast("int")
            return F.struct(s["start"].alias("start"), s["end"].alias("end"),
                            F.concat_ws("/", name, band.cast("string")).alias("stratum"), step.alias("step"),
                            ((F.length(bare) >= F.element_at(least, name)) & ~name.isin(*NOT_SECRET)).alias("strong"))
        return _let(_encoding(bare), rated)
    return F.transform(tokens, described)


def thresholds(found: DataFrame) -> Column:
    """Map stratum -> least p-value step at which randomness is rejected
    (Benjamini-Hochberg on the grid); strata without a rejection are absent.
    Its size is bounded by encodings x length bands."""
    cells = (found.select(F.explode("candidates").alias("c")).groupBy(F.col("c.stratum").alias("stratum"), F.col("c.step").alias("step"))
             .agg(F.count("*").cast("double").alias("n")))
    per = cells.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("step", "n"))).alias("grid"))   # at most MOST_STEPS + 1
    total = F.aggregate("grid", F.lit(0.0), lambda a, x: a + x["n"])
    below = lambda s: F.aggregate(F.filter("grid", lambda y: y["step"] >= s), F.lit(0.0), lambda a, y: a + y["n"])
    passing = F.filter("grid", lambda x: total * F.pow(F.lit(10.0), -x["step"] / float(STEPS)) <= FDR * below(x["step"]))
    cut = per.select("stratum", F.array_min(F.transform(passing, lambda x: x["step"])).alias("cut")).filter(F.col("cut").isNotNull())
    return cut.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cut"))).alias("m")).select("m").scalar()


def _named(array: Column, order: int, kind: str) -> Column:
    return F.transform(array, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
                                                 F.lit(kind).alias("kind")))


def _joined(array: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(array), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(df: DataFrame) -> DataFrame:
    """One row per row of ``df``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_random (spans that the battery adds)."""
    text = F.coalesce("text", F.lit(""))
    assign = F.filter(spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= LEAST_ASSIGN)
    found = df.select("doc_id", assign.alias("assign"), spans(text, ACCESS).alias("access"), spans(text, HEX).alias("hex"),
                      spans(text, TOKEN).alias("tokens"))
    found = found.select("doc_id", F.concat(_named(F.col("assign"), 0, "assign"), _named(F.col("access"), 1, "access"),
                                            _named(F.col("hex"), 2, "hex")).alias("base"),
                         F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
                         F.size("hex").cast("long").alias("n_hex"), _candidates(F.col("tokens")).alias("candidates"))
    found = stored(found, "secrets")
    found = found.withColumn("cuts", thresholds(found))
    inside = lambda c: F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
    random = F.filter("candidates", lambda c: c["strong"] & ~inside(c) & (
        c["step"] < F.coalesce(F.try_element_at(F.col("cuts"), c["stratum"]), F.lit(MOST_STEPS + 1))))
    base = _joined(F.col("base"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        _joined(F.concat("base", _named(random, 3, "random"))).alias("spans"),
                        F.size(random).cast("long").alias("n_random"))
