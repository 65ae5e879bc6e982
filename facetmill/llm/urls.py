"""URL filters: rules first, else a logistic regression on hashed character n-grams, in DataFrame functions only.

The regression is trained from a small labelled table of URLs. Its weights, one
for each hash bucket, become a literal array; a URL's score is the logistic of the
sum over its n-grams.

Defined cases: a null URL or one without ``://`` has empty host and path, no rule,
and is allowed by the method with score 0; repeated rows get equal results; a table
without rows gives none; extra columns pass through, and input columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import column, others
from .licenses import lowered

BUCKETS = 1 << 11
SIZES = (3, 4, 5)
# Rules are a literal of the plan; a longer list belongs into a table.
MAX_RULES = 1_000

# Host and path prefix, and what follows.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

ADDED = ["host", "path", "rule", "score", "verdict"]

# The training table: every subject of a kind is combined with each form of URL.
BLOCKED = (
    "adult-x", "adult-video", "casino-win", "casino-online", "win-casino", "free-bets", "sports-bets", "cheap-pills", "pills-online", "cheap-meds",
    "ads-track", "track-clicks", "adserver", "spam-farm", "link-farm", "xxx-cams", "poker-bonus", "lottery-win", "free-money", "porn-tube",
)
ALLOWED = (
    "library", "museum", "thestory", "theatre", "weather", "research", "university", "hiking", "cooking", "theory", "nation", "station",
    "thinking", "history", "gardens", "mathematics", "thread", "northern", "other", "thousand", "reading", "science", "language", "gazette",
    "there", "therapy", "ththing", "tionbook", "theron", "ththan",
)
FORMS = ("http://www.{}.example.com/en/12.html", "https://{}.example.org/de/345", "https://blog.{}.example.net/fr/6/?page=2", "http://m.{}.example.com/es/78#top")


def training_table(spark: SparkSession) -> DataFrame:
    """(url, label) with label 1 for what is to be blocked."""
    rows = [(form.format(name), label) for label, names in ((1.0, BLOCKED), (0.0, ALLOWED)) for name in names for form in FORMS]
    table = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])
    return spark.range(1).select(F.inline(table))


def host_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _grams(kind: str, text: Column, n: int) -> Column:
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    at = F.sequence(F.lit(1), F.greatest(F.char_length(marked) - n + 1, F.lit(1)))
    return F.transform(at, lambda i: F.concat(F.lit(kind), F.substr(marked, i, F.lit(n))))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, apart from each other, with their ends marked."""
    return F.concat(*[_grams(kind, text, n) for kind, text in (("h", host), ("p", path)) for n in SIZES])


def train(labelled: DataFrame, reg: float = 1e-3) -> list[float]:
    """Weights by hash bucket, the intercept last, from (url, label)."""
    rows = labelled.select(grams(host_of(F.col("url")), path_of(F.col("url"))).alias("grams"), "label")
    # Buckets are those of the scoring expression, written as words of their number.
    numbered = rows.select(F.transform("grams", lambda g: _bucket(g).cast("string")).alias("grams"), "label")
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=8 * BUCKETS)
    model = LogisticRegression(regParam=reg, maxIter=100, standardization=False).fit(tf.transform(numbered))
    # HashingTF has its own hash: read each bucket's weight back by its name.
    weights, intercept = model.coefficients.toArray(), float(model.intercept)
    return [float(weights[tf.indexOf(str(b))]) for b in range(BUCKETS)] + [intercept]


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _scored(weights: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(repr, weights[:-1]))), ",").cast("array<double>")
    total = F.aggregate(grams(F.col("host"), F.col("path")), F.lit(0.0), lambda a, g: a + F.get(table, _bucket(g)))
    return F.when(F.col("host") == "", F.lit(0.0)).otherwise(1 / (1 + F.exp(-(total + weights[-1]))))


def _rule(rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule (text, verdict) that fits host and path, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    parts = [(rule, *rule.partition("/"), verdict) for rule, verdict in rules]
    table = F.array(
        *[F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"), F.lit(h).alias("h"), F.lit(s + p).alias("p"), F.lit(v).alias("v")) for r, h, s, p, v in parts]
    ).cast("array<struct<size:int,rule:string,h:string,p:string,v:string>>")
    fits = lambda r: ((F.col("host") == r["h"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["h"]))) & F.startswith(F.col("path"), r["p"])
    return F.array_max(F.filter(table, fits))


def judge(pages: DataFrame, weights: list[float], rules=RULES, keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, score (1: to be blocked) and verdict of their url."""
    kept = others(pages.select(*map(column, pages.columns if keep is None else keep)), [*ADDED, "__r"])
    split = pages.select(*map(column, kept), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = split.select("*", _rule(tuple(rules)).alias("__r"), _scored(weights).alias("score"))
    return ruled.select(
        *map(column, kept),
        "host",
        "path",
        F.col("__r.rule").alias("rule"),
        "score",
        F.coalesce(F.col("__r.v"), F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
    )
