"""URL filters: path rules first, then a classifier of host and path.

The classifier is a logistic regression on hashed character n-grams. It is trained from a small
labelled table; the weights are one number per hash bucket, and a URL's score is the sum of the
weights of its n-grams, a row-wise expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8192
N_GRAMS = (3, 4, 5)
#: Weight of the blocked rows of a fit together; most URLs are to be allowed.
BLOCKED_SHARE = 0.25
SHRINK = 0.0001
#: Scores from here on are blocked.
BLOCK_AT = 0.4
#: Rows of a labelled table that a fit takes at most, in the order of their hash.
LABELLED_ROWS = 5000

# The verdicts of rules, by host and beginning of the path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Labelled hosts. Each stands behind every front, so that fronts and paths tell nothing.
BLOCKED = (
    "cheap-pills", "pills-online", "buy-pills-now", "cheap-meds", "discount-pharmacy",
    "casino-win", "casino-royal", "best-casino", "win-big-slots", "slots-poker",
    "free-bets", "sports-bets", "bets-today", "poker-free", "lucky-win",
    "adult-x", "adult-videos", "xxx-adult", "x-cams", "hot-dates-x",
    "spam-farm", "link-farm", "seo-spam", "mail-spam", "content-farm",
    "ads-track", "track-ads", "ad-tracker", "click-ads", "popup-ads",
    "free-download-crack", "warez-crack", "get-rich-quick", "payday-loans", "fake-watches",
)
ALLOWED = (
    "news", "library", "museum", "garden", "weather", "science", "history", "travel", "recipes",
    "school", "university", "courses", "teaching", "cooking", "reading", "writing", "painting",
    "mountain", "river", "forest", "kitchen", "theatre", "health", "research", "journal",
    "reading-room", "open-data", "city-council", "slow-travel", "old-books",
)
# Ordinary made-up names are two of the commonest letter groups of English.
GROUPS = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "tion", "ou")
FRONTS = ("", "www.", "blog.", "m.")
DOMAINS = ("example.com", "example.net", "example.org")
LANGUAGES = ("en", "de", "fr", "es")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``url``, ``label`` (1: to be blocked)."""
    made_up = [a + b for a in GROUPS for b in GROUPS]
    rows = [
        (
            f"https://{front}{name}.{DOMAINS[(i + j) % 3]}"
            f"/{LANGUAGES[(i // 3 + j) % 4]}/{(37 * i + 211 * j) % 1000}",
            label,
        )
        for label, names in ((1, BLOCKED), (0, [*ALLOWED, *made_up]))
        for i, name in enumerate(names)
        for j, front in enumerate(FRONTS)
    ]
    return spark.createDataFrame(rows, "url string, label int")


def _lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def _after_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``; empty without one."""
    found = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(_lower(found), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def rule_of(
    host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES
) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does.

    A rule is a host, which stands for its subdomains too, and the beginning of a path. Of rules as
    long the first in the list wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def buckets(host: Column, path: Column, count: int = BUCKETS) -> Column:
    """Hash buckets of the character n-grams of host and path, and of nothing else."""
    text = F.concat(F.lit("^"), host, F.lit("$"), path)
    grams = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))),
            lambda i, n=n: F.pmod(F.xxhash64(F.substring(text, i, n)), F.lit(count)).cast("int"),
        )
        for n in N_GRAMS
    ]
    return F.array_distinct(F.concat(*grams))


def _weights(values: Sequence[float]) -> Column:
    """The weights as one constant array."""
    text = F.lit(",".join(f"{v:.6g}" for v in values))
    return F.split(text, ",").cast("array<double>")


def score(found: Column, weights: Sequence[float]) -> Column:
    """The probability of label 1. The last weight is the intercept."""
    w = _weights(weights)
    total = F.aggregate(found, F.lit(0.0), lambda a, i: a + F.get(w, i))
    scaled = total / F.sqrt(F.greatest(F.size(found), F.lit(1))) + F.lit(float(weights[-1]))
    return 1 / (1 + F.exp(-scaled))


def fit(
    labelled: DataFrame,
    count: int = BUCKETS,
    shrink: float = SHRINK,
    rows: int = LABELLED_ROWS,
) -> list[float]:
    """Weights of the buckets and the intercept, by Spark's logistic regression.

    At most ``rows`` labelled rows take part; a null label does not. The blocked rows together
    weigh ``BLOCKED_SHARE``. Without both labels every weight is 0 and everything scores one half.
    """
    parts = labelled.where("label IS NOT NULL").select(
        buckets(host(F.col("url")), path(F.col("url")), count).alias("found"), "label"
    )
    sample = parts.orderBy(F.xxhash64("found", "label"), "label").limit(rows)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return [0.0] * (count + 1)
    held = F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.array_contains("found", i).cast("double") / F.sqrt(F.size("found")),
    )
    share = F.when(F.col("label") == 1, BLOCKED_SHARE / sizes[1]).otherwise(
        (1 - BLOCKED_SHARE) / sizes[0]
    )
    ready = sample.select(array_to_vector(held).alias("features"), "label", share.alias("weight"))
    model = LogisticRegression(
        regParam=shrink, standardization=False, weightCol="weight", maxIter=50
    ).fit(ready)
    return [*map(float, model.coefficients.toArray()), float(model.intercept)]


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """``keep`` and ``host, path, rule, verdict, score`` of every row.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by
    the classifier. Repeated rows are judged alike; other columns are not read.
    """
    weights = fit(labelled)
    parts = pages.select(*keep, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return (
        parts.withColumn("rule", rule)
        .withColumn("score", score(buckets(F.col("host"), F.col("path")), weights))
        .withColumn("verdict", F.coalesce(verdict, own))
        .select(*keep, "host", "path", "rule", "verdict", "score")
    )
