"""URL filter: empirical-Bayes host reputation, with path rules before it.

Labelled pages vote on their host. The good share of a host is shrunk through
three beta-binomial levels: the suffix's prior is the table's overall good
share, a registered domain's prior is its suffix's posterior mean, a host's
prior is its domain's posterior mean, each without the child's own votes, so
that no vote counts twice. The weight of each prior (its pseudo-count) is fitted to the data by moments: the spread of the observed
shares of a level's children around their parent, beyond what binomial noise
explains, held within ``WEIGHTS``. A host is blocked when the upper bound of
its posterior good share (mean plus ``Z`` standard deviations of the beta
posterior) is below the overall share less ``MARGIN``; a host that was never
labelled is judged by its domain's, its suffix's, or the overall posterior.

A path rule, where one fits, decides first; the longest rule wins.

Everything is aggregates with a map side and equi-joins on the host: no UDF.
A host, domain or suffix with a third of the pages costs one row a task in
the counts; its join partition is split by the skew join.

Defined results: a null url, or one without ``://``, has an empty host and
path and is judged as the empty host; a null label is no vote; a page that
repeats gives a row each; labels that repeat for a page are counted once each;
without any label everything is allowed; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import landed, read_table

# The rules of the contract as (rule, verdict).
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
WEIGHTS = (2.0, 200.0)  # least and largest pseudo-count of a prior
Z = 1.64
MARGIN = 0.1
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting (rule, verdict) as a struct, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        site, _, rest = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def sites(df: DataFrame) -> DataFrame:
    """``df`` with ``domain`` (the last two labels of ``host``) and ``suffix``
    (the last one)."""
    return df.withColumn("domain", F.substring_index("host", ".", -2)).withColumn(
        "suffix", F.substring_index("host", ".", -1))


def _weight(level: DataFrame) -> float:
    """The pseudo-count of the children's common prior by moments.

    With a share p of n votes around a prior m, E[(p - m)^2] is
    m(1-m)/n + (1 - 1/n) m(1-m)/(w + 1); summed over the children with weight
    n and solved for w."""
    spread = F.col("prior") * (1 - F.col("prior"))
    off = F.col("good") / F.col("n") - F.col("prior")
    row = level.agg(F.sum(F.col("n") * off * off).alias("seen"), F.sum(spread).alias("noise"),
                    F.sum((F.col("n") - 1) * spread).alias("extra")).first()
    least, most = WEIGHTS
    over = (row.seen or 0.0) - (row.noise or 0.0)
    return min(max(row.extra / over - 1, least), most) if over > 0 else most


def reputations(votes: DataFrame) -> tuple[float, dict[str, DataFrame]]:
    """The overall good share, and by level (key, a, b): the beta posterior of
    every suffix, domain and host with a vote. ``votes``: (host, good 0/1)."""
    counts = landed(sites(votes.where("good is not null").groupBy("host").agg(
        F.count("*").cast("double").alias("n"), F.sum("good").cast("double").alias("good"))), "url-votes")
    total = counts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    n, good = total.n or 0.0, total.good or 0.0
    out, above = {}, None
    for level, parent in zip(LEVELS, (None, "suffix", "domain")):
        own = counts.groupBy(*filter(None, (level, parent))).agg(
            F.sum("n").alias("n"), F.sum("good").alias("good"))
        if parent:
            own = own.join(above, parent)
        else:  # the whole table, with one vote of either kind before it
            own = own.withColumns({"up_n": F.lit(n), "up_good": F.lit(good), "up_prior": F.lit(0.5),
                                   "up_weight": F.lit(2.0)})
        rest = F.col("up_good") - F.col("good") + F.col("up_weight") * F.col("up_prior")
        own = own.withColumn("prior", rest / (F.col("up_n") - F.col("n") + F.col("up_weight")))
        weight = _weight(own)
        a = F.col("good") + weight * F.col("prior")
        out[level] = own.select(level, a.alias("a"), (F.col("n") + weight - a).alias("b"))
        above = own.select(level, F.col("n").alias("up_n"), F.col("good").alias("up_good"),
                           F.col("prior").alias("up_prior"), F.lit(weight).alias("up_weight"))
    return (good + 1) / (n + 2), out


def judge(pages: DataFrame, votes: DataFrame, rules=RULES, z: float = Z,
          margin: float = MARGIN) -> DataFrame:
    """(page_id, host, path, rule, verdict, reputation, bound), a row per row
    of ``pages``; ``votes`` is (page_id, good 0/1)."""
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    voted = placed.join(votes.select("page_id", "good"), "page_id").select("host", "good")
    overall, rep = reputations(voted)
    hosts = sites(placed.select("host").distinct())  # every host, judged once
    for level in LEVELS:
        known = rep[level].withColumnRenamed("a", f"a_{level}").withColumnRenamed("b", f"b_{level}")
        hosts = hosts.join(known, level, "left")
    a = F.coalesce("a_host", "a_domain", "a_suffix", F.lit(overall))
    b = F.coalesce("b_host", "b_domain", "b_suffix", F.lit(1 - overall))
    mean = a / (a + b)
    bound = mean + z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    hosts = hosts.select("host", mean.alias("reputation"), bound.alias("bound"),
                         F.when(bound < overall - margin, "block").otherwise("allow").alias("method"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    return (placed.join(hosts, "host").withColumn("found", found)
            .select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", "method").alias("verdict"), "reputation", "bound"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes: the labelled documents of the pages, good when of quality and
    not toxic."""
    labels = read_table(spark, sf_dir, "labels")
    good = F.when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(),
                  ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int"))
    votes = labels.select(F.col("doc_id").alias("page_id"), good.alias("good"))
    return judge(read_table(spark, sf_dir, "pages"), votes).select(
        "page_id", "host", "path", "rule", "verdict")


def _level_sql(level: str, parent: str | None) -> str:
    up = f"{parent}_p" if parent else "total_p"
    keys = f"{level}, {parent}" if parent else level
    on = f"USING ({parent})" if parent else "ON true"
    least, most = WEIGHTS
    return f"""
{level}_n AS (
  SELECT c.*, (u.good - c.good + u.w * u.prior) / (u.n - c.n + u.w) AS prior
  FROM (SELECT {keys}, sum(n) AS n, sum(good) AS good FROM counts GROUP BY {keys}) c JOIN {up} u {on}),
{level}_w AS (
  SELECT CASE WHEN seen - noise > 0 THEN least(greatest(extra / (seen - noise) - 1, {least}), {most})
              ELSE {most} END AS w
  FROM (SELECT sum(n * (good / n - prior) * (good / n - prior)) AS seen,
               sum(prior * (1 - prior)) AS noise, sum((n - 1) * prior * (1 - prior)) AS extra
        FROM {level}_n)),
{level}_p AS (
  SELECT {level}, n, good, prior, w, good + w * prior AS a, n + w - (good + w * prior) AS b
  FROM {level}_n, {level}_w)"""


# Fixed value: the rules once more, written out for the SQL; the longest first.
RULE_SQL = """CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
    THEN {'rule': 'example.org/en/1', 'verdict': 'block'}
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
    THEN {'rule': 'example.org/es/', 'verdict': 'block'}
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/')
    THEN {'rule': 'com/fr/', 'verdict': 'allow'}
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/')
    THEN {'rule': 'com/de/', 'verdict': 'block'}
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/')
    THEN {'rule': 'org/', 'verdict': 'allow'} END"""


OP1_SQL = f"""
WITH placed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
counts AS (
  SELECT *, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
  FROM (SELECT host, CAST(count(*) AS DOUBLE) AS n,
               CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) AS good
        FROM placed JOIN labels ON page_id = doc_id
        WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY host)),
total_p AS (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(good), 0) AS good, 0.5 AS prior, 2.0 AS w FROM counts),
overall AS (SELECT (good + 1) / (n + 2) AS prior FROM total_p),
{",".join(_level_sql(x, y) for x, y in zip(LEVELS, (None, "suffix", "domain")))},
hosts AS (
  SELECT DISTINCT host, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain,
         regexp_extract(host, '[^.]*$') AS suffix FROM placed),
beta AS (
  SELECT h.host, o.prior, coalesce(x.a, d.a, s.a, o.prior) AS a, coalesce(x.b, d.b, s.b, 1 - o.prior) AS b
  FROM hosts h LEFT JOIN host_p x ON h.host = x.host LEFT JOIN domain_p d ON h.domain = d.domain
       LEFT JOIN suffix_p s ON h.suffix = s.suffix JOIN overall o ON true),
method AS (
  SELECT host, CASE WHEN a / (a + b) + {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1))
                         < prior - {MARGIN} THEN 'block' ELSE 'allow' END AS method
  FROM beta),
ruled AS (SELECT *, {RULE_SQL} AS found FROM placed)
SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, method) AS verdict
FROM ruled JOIN method USING (host)
""".replace("\\\\", "\\")
