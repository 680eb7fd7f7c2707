"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host, registered domain
and suffix.  Each level's rate is shrunk towards its parent's through a beta
prior whose weight (pseudo pages) is fitted to that level by the method of
moments: suffixes towards the rate of all labels, domains towards their
suffix, hosts towards their domain.  A host without labels has its domain's
rate as prior and nothing else.  A page is blocked when the lower bound of its
host's posterior bad rate exceeds MAX_BAD, unless a rule decides it.

Outcomes are combined per task and host before any shuffle; all tables are
joined as Spark sees fit (a hot host's pages are split by its skew join).

A page's labels are those of the document whose number ends its url's path
(/fr/825, /fr/825/ and /fr/825.html are document 825; other paths have none).
The registered domain is the last label below the suffix.  The suffix is the
last label, or the last two where a general label (LONG_SUFFIX) stands before a
country code of two letters.  An IPv4 address is a domain of its own.

Defined results: a url that is null or has no :// has empty host and path and
the reputation of the empty host; labels that no page has are ignored, a page
with several labels counts each, and a label counts for every page that shows
its document; repeated pages are each judged; without any label nothing is
blocked by reputation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# General labels under country codes.
LONG_SUFFIX = r"^(ac|co|com|edu|gob|gouv|gov|go|mil|ne|net|nom|org|or)\.[a-z]{2}$"
ADDRESS = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
DOCUMENT = r"/([0-9]{1,18})(\.[A-Za-z]+)?/?\z"   # at the end of a path
MAX_BAD = 0.3       # tolerated share of bad pages
BOUND_Z = 1.645     # one-sided 95 % bound
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(found, UPPER, UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def document(path_: Column) -> Column:
    """Number of the document that a path shows, or null."""
    return F.regexp_extract(path_, DOCUMENT, 1).try_cast("long")


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null where none."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def levels(host_: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    name = F.regexp_replace(host_, r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - (k - 1), F.lit(1)), F.lit(k)), ".")
    long, address = last(2).rlike(LONG_SUFFIX), name.rlike(ADDRESS)
    return (F.when(address, name).when(long, last(3)).otherwise(last(2)),
            F.when(address, F.lit("ip")).when(long, last(2)).otherwise(last(1)))


def _weight(groups: DataFrame) -> float:
    """Pseudo pages of the prior of rows (n, bad, prior): method of moments
    for the beta-binomial, from the spread of rates around their priors."""
    spread = F.sum(F.when(F.col("n") > 0, F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), F.lit(2.0))))
    noise = F.avg(F.when(F.col("n") > 0, F.col("prior") * (1 - F.col("prior"))))
    k = F.count(F.when(F.col("n") > 0, 1)) - 1
    total, squares = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    rho = F.try_divide(spread - noise * k, noise * (total - F.try_divide(squares, total) - k))
    bounded = F.least(F.greatest(F.coalesce(rho, F.lit(0.001)), F.lit(0.001)), F.lit(0.5))
    return float(groups.agg((1.0 / bounded - 1.0).alias("w")).first()["w"])


def reputations(hosts: DataFrame) -> DataFrame:
    """(host, labelled, bad_rate, bad_bound) from rows (host, n, bad).

    The counts are written once; what comes to the driver is one number per
    level (the rate of all labels, the weights of the priors)."""
    domain, suffix = levels(F.col("host"))
    base = stored(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"),
                               F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad")), "hosts")
    overall = base.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0)).alias("p")).first()["p"]
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    mean = lambda w: (F.col("bad") + F.lit(w) * F.col("prior")) / (F.col("n") + F.lit(w))
    by_suffix = base.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall))
    suffixes = by_suffix.select("suffix", mean(_weight(by_suffix)).alias("prior"))
    by_domain = base.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix")
    domains = by_domain.select("domain", mean(_weight(by_domain)).alias("prior"))
    by_host = base.join(domains, "domain")
    w = _weight(by_host)
    rate = mean(w)
    deviation = F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(w) + 1))
    return by_host.select("host", F.col("n").cast("long").alias("labelled"), rate.alias("bad_rate"),
                          (rate - BOUND_Z * deviation).alias("bad_bound"))


def judge(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, labelled,
    bad_bound.  ``outcomes``: (document, bad boolean)."""
    url = F.col("url")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    labels = outcomes.groupBy("document").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    # Pages of one host and document are combined before the join.
    shown = rows.groupBy("host", document(F.col("path")).alias("document")).agg(F.count("*").alias("pages"))
    counted = shown.join(labels, "document", "left").withColumns({"n": F.col("n") * F.col("pages"),
                                                                  "bad": F.col("bad") * F.col("pages")})
    hosts = counted.groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    known = reputations(hosts)
    name, verdict = rule(F.col("host"), F.col("path"))
    own = F.when(F.col("bad_bound") > MAX_BAD, "block").otherwise("allow")
    return rows.join(known, "host").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "labelled", F.round("bad_bound", 6).alias("bad_bound"))


def judge_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (doc_id, quality, toxic) are outcomes of the pages that show
    the document: bad if of low quality or toxic, null values are unknown."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = labels.select(F.col("doc_id").alias("document"), bad.alias("bad")).filter(F.col("bad").isNotNull())
    return judge(pages, outcomes)


SQL = """
WITH p AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rows_ AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
          TRY_CAST(regexp_extract(path, '%(document)s', 1) AS BIGINT) AS document FROM p),
o AS (SELECT doc_id AS document, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
             string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l
      FROM rows_ LEFT JOIN o USING (document) GROUP BY host),
b AS (SELECT host, n, bad, regexp_replace(host, ':[0-9]*$', '') AS name, array_to_string(l[greatest(len(l) - 1, 1):], '.') AS last2, l[len(l)] AS last1,
             array_to_string(l[greatest(len(l) - 2, 1):], '.') AS last3 FROM h),
c AS (SELECT host, n, bad, CASE WHEN a THEN name WHEN g THEN last3 ELSE last2 END AS domain,
             CASE WHEN a THEN 'ip' WHEN g THEN last2 ELSE last1 END AS suffix
      FROM (SELECT *, regexp_matches(last2, '%(long)s') AS g, regexp_matches(name, '%(address)s') AS a FROM b)),
overall AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0.0 END AS p FROM c),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT p FROM overall) AS prior FROM c GROUP BY suffix),
sw AS (SELECT %(weight)s AS w FROM s),
sm AS (SELECT suffix, (bad + w * prior) / (n + w) AS prior FROM s, sw),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM c GROUP BY domain, suffix),
dp AS (SELECT d.*, sm.prior FROM d JOIN sm USING (suffix)),
dw AS (SELECT %(weight)s AS w FROM dp),
dm AS (SELECT domain, (bad + w * prior) / (n + w) AS prior FROM dp, dw),
hp AS (SELECT c.host, c.n, c.bad, dm.prior FROM c JOIN dm USING (domain)),
hw AS (SELECT %(weight)s AS w FROM hp),
r AS (SELECT host, n, (bad + w * prior) / (n + w) AS m, n + w + 1 AS t FROM hp, hw),
k AS (SELECT host, n::BIGINT AS labelled, m - 1.645 * sqrt(m * (1 - m) / t) AS bound FROM r),
f AS (SELECT page_id, host, path, labelled, bound,
  CASE WHEN (host = 'example.org' OR host LIKE '%%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
       WHEN (host = 'example.org' OR host LIKE '%%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
       WHEN (host = 'com' OR host LIKE '%%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
       WHEN (host = 'com' OR host LIKE '%%.com') AND starts_with(path, '/de/') THEN 'com/de/'
       WHEN (host = 'org' OR host LIKE '%%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM rows_ JOIN k USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN bound > 0.3 THEN 'block' ELSE 'allow' END AS verdict,
  labelled, round(bound, 6) AS bad_bound
FROM f
""" % {"document": DOCUMENT, "long": LONG_SUFFIX, "address": ADDRESS, "weight": """1.0 / least(greatest(coalesce(
    (sum(CASE WHEN n > 0 THEN n * power(bad / n - prior, 2) END)
     - avg(CASE WHEN n > 0 THEN prior * (1 - prior) END) * (count(CASE WHEN n > 0 THEN 1 END) - 1))
    / nullif(avg(CASE WHEN n > 0 THEN prior * (1 - prior) END)
             * (sum(n) - sum(n * n) / nullif(sum(n), 0) - (count(CASE WHEN n > 0 THEN 1 END) - 1)), 0),
    0.001), 0.001), 0.5) - 1.0"""}
