"""URL filters: host and path rules first, a logistic regression on hashed character n-grams for the rest.

The regression is trained from a small labelled URL table on the cluster's JVM side;
scoring and rules are column expressions, so a page table is read once and nothing is shuffled.
"""

from __future__ import annotations


from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM_SIZES = (3, 4, 5)
BUCKETS = 1 << 14
MAX_RULES = 1_000  # rules are part of the plan; a longer list is refused, not cut

# Rules of the page query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# The labelled URL table is made by a rule from these names (``labelled_urls``).
UNWANTED_TOPICS = """
ads adserver adult affiliate banner betting bets bingo bonus botnet casino cheap-loans cheap-meds clickbait coupons
counterfeit cracks dating diet-pills discount-pharma doorway dropship escort fake-reviews followers forex-signals
gambling get-rich giveaway hookup instant-loan jackpot keygen linkfarm lottery malware miracle-cure nudes payday
pharmacy-deals phishing pills poker popup porn prizes pyramid replica scam sexcam slots spam spyware sweepstakes
torrents tracker viagra warez xxx
""".split()
WANTED_TOPICS = """
academy agriculture archive architecture arts astronomy atlas biology books botany bulletin ceramics chemistry chess
chronicle cinema climate college cooking courier culture cycling dictionary drama economy education encyclopedia
engineering essays farming fishing forestry forum gallery gardens gazette geography geology guide hiking history
hospital journal kitchen knitting language law library linguistics literature magazine maps mathematics medicine
meteorology mountains museum music nature news observatory observer opera orchestra painting parliament philosophy
photography physics poetry press railway recipes research review sailing school science sculpture society stories
teaching theatre travel tribune university weather wildlife woodwork
""".split()
MODIFIERS = "online my best the daily top new world city go get club hub zone central direct plus pro live net".split()
SUBDOMAINS = ["", "", "www.", "www.", "m.", "blog.", "en.", "shop."]
DOMAINS = [".com", ".org", ".net", ".info", ".co.uk", ".de", ".fr", ".io", ".example.com", ".example.org", ".example.net"]
PATHS = ["", "/", "/en/12", "/de/310.html", "/fr/7?page=2", "/es/55/", "/2024/05/17/1234", "/index.php?id=7", "/a/b.html#top", "/tag/list?page=2"]
VARIANTS = 24  # urls of a topic
BRANDS = 2_000  # urls of hosts whose names mean nothing


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits a host or its parent domains; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = lambda rule: (((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2]))
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    found = [F.when(fits(r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict")))
             for r in longest_first]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def _pick(values: list[str], *salt: Column | str) -> Column:
    """One of the values by a hash of the row's id and the salt."""
    at = F.pmod(F.xxhash64("id", *[F.lit(x) for x in salt]), F.lit(len(values))).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled URL table (url, label; 1: unwanted; topic) of the default model, the same at every call.

    VARIANTS urls a topic: its name alone, before or after a modifier that both labels share, with a number, or
    as a folder of a host that means nothing; and BRANDS urls of such hosts, two to four
    syllables each, wanted: a name is unwanted for what it says, not for being unknown.
    """
    topics = [(t, 1.0) for t in UNWANTED_TOPICS] + [(t, 0.0) for t in WANTED_TOPICS]
    total = len(topics) * VARIANTS
    syllable = lambda i: F.concat(_pick(list("bcdfghjklmnprstvwz") + ["th", "sh", "ch", "st", "tr"], "a", str(i)),
                                  _pick(list("aeiou") + ["ea", "ou", "er", "on", "in"], "b", str(i)))
    syllables = F.array(*[syllable(i) for i in range(4)])
    rows = spark.range(total + BRANDS).select(
        "id", (F.col("id") % len(topics)).cast("int").alias("t"), (F.col("id") < total).alias("named"),
        F.array_join(F.slice(syllables, 1, 2 + F.pmod(F.xxhash64("id"), F.lit(3)).cast("int")), "").alias("brand"),
        _pick(MODIFIERS, "modifier").alias("m"))
    topic = F.when(F.col("named"), F.get(F.array(*[F.lit(t) for t, _ in topics]), F.col("t")))
    label = F.when(F.col("named"), F.get(F.array(*[F.lit(n) for _, n in topics]), F.col("t"))).otherwise(0.0)
    rows = rows.withColumn("topic", topic).withColumn("label", label)
    form = F.floor(F.col("id") / len(topics)) % 7
    number = F.pmod(F.xxhash64("id", F.lit("number")), F.lit(1000)).cast("string")
    name = (F.when(~F.col("named") | (form == 6), F.col("brand")).when(form == 0, F.col("topic"))
            .when(form == 1, F.concat("m", F.lit("-"), "topic")).when(form == 2, F.concat("topic", F.lit("-"), "m"))
            .when(form == 3, F.concat("m", "topic")).when(form == 4, F.concat("topic", "m")).otherwise(F.concat("topic", number)))
    folder = F.when(F.col("named") & (form == 6), F.concat(F.lit("/"), "topic")).otherwise("")
    url = F.concat(F.lit("http://"), _pick(SUBDOMAINS, "sub"), name, _pick(DOMAINS, "domain"), folder, _pick(PATHS, "path"))
    return rows.select(url.alias("url"), "label", "topic")


def _characters(host: Column, path: Column) -> Column:
    """``^host$path`` as single characters: an n-gram knows the start and the end of a host."""
    return F.split(F.concat(F.lit("^"), host, F.lit("$"), path), "")


def fit(labelled: DataFrame, url: str = "url", label: str = "label") -> PipelineModel:
    """Train on a labelled URL table; rows without a url or a label are left out."""
    known = (labelled.filter(F.col(url).isNotNull() & F.col(label).isNotNull())
             .select(_characters(host_of(F.col(url)), path_of(F.col(url))).alias("characters"),
                     F.col(label).cast("double").alias("label")).coalesce(1))
    grams = [step for n in GRAM_SIZES for step in (
        NGram(n=n, inputCol="characters", outputCol=f"grams{n}"),
        HashingTF(numFeatures=BUCKETS, binary=True, inputCol=f"grams{n}", outputCol=f"hashed{n}"))]
    joined = VectorAssembler(inputCols=[f"hashed{n}" for n in GRAM_SIZES], outputCol="features")
    regression = LogisticRegression(regParam=0.002, maxIter=60, standardization=False)
    return Pipeline(stages=[*grams, joined, regression]).fit(known)


def judge_urls(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES,
               key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: ``key``, host, path, rule, verdict, score (the model's probability of "unwanted").

    A null url and one without ``://`` have an empty host and path: no rule fits, and
    the model sees the two boundary marks only.  The regression decides where no rule
    fits: block at a probability of 0.5 or more.  Repeated rows stay; other columns play no part.
    """
    from pyspark.ml.functions import vector_to_array

    parts = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = parts.withColumn("characters", _characters(F.col("host"), F.col("path")))
    scored = model.transform(parts).withColumn("score", vector_to_array("probability")[1])
    rule = rule_verdict(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("key").alias(key), "host", "path", rule["rule"].alias("rule"),
                         F.coalesce(rule["verdict"], method).alias("verdict"), "score")
