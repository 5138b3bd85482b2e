"""URL filters by association rules.

Given rules on hosts and paths decide first, the longest that fits. The distinct URLs that they decide are labelled rows:
FP-growth mines the combinations of URL tokens that go with a verdict, and rules of enough support and confidence
judge the pages that no given rule fits. A mined rule is posted under one of its tokens in an inverted index;
a page looks up its own tokens there and tests the few rules it finds. Mining and matching use DataFrame functions only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.session import materialize

# Host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
VERDICTS = ("allow", "block")

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
# Labelled URLs that a rule has to hold in, at least, however few there are.
LEAST_ROWS = 5
# Lists of the inverted index.
SLOTS = 256
_LABEL = "verdict="
_PART, _PIECE = "part=", "piece="


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to the end of the host, with A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to the query, the fragment or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest given rule that fits, else null. Of equally long ones the first in the list wins."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda rule: len(rule[0]) + len(rule[1])):
        fit = fits(host, path, rule_host, rule_path)
        name = F.when(fit, rule_host + rule_path).otherwise(name)
        verdict = F.when(fit, says).otherwise(verdict)
    return name, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: top-level domain, domain, site before the domain, first label and number of labels of the
    host, and the parts of the path, whole and in pieces between hyphens.

    Parts with digits name single pages and are left out.
    """
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    count = F.size(labels)
    last = lambda n: F.array_join(F.slice(labels, F.greatest(count - n + 1, F.lit(1)), n), ".")
    of_host = F.array(
        F.when(count >= 1, F.concat(F.lit("top="), last(1))),
        F.when(count >= 2, F.concat(F.lit("domain="), last(2))),
        F.when(count >= 3, F.concat(F.lit("site="), F.get(labels, count - 3))),
        F.when(count >= 4, F.concat(F.lit("first="), F.get(labels, F.lit(0)))),
        F.when(count >= 1, F.concat(F.lit("labels="), count.cast("string"))),
    )
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    pieces = F.flatten(F.transform(F.filter(parts, lambda x: x.contains("-")), lambda x: F.filter(F.split(x, "-"), lambda y: y != "")))
    named = lambda xs, name: F.transform(xs, lambda x: F.concat(F.lit(name), x))
    return F.array_distinct(F.concat(F.array_compact(of_host), named(parts, _PART), named(pieces, _PIECE)))


def of_path(token: Column) -> Column:
    return token.startswith(_PART) | token.startswith(_PIECE)


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``antecedent, verdict, confidence, support`` of the rules found in ``tokens, verdict``.

    A rule has to hold a token of the path: those of the host alone say which sites the given rules are about, not
    what is on a page. A rule that holds more tokens than another with the same verdict and at least its confidence
    is left out.
    """
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.select("antecedent", F.col("consequent")[0].alias("label"), "confidence", "support")
    rules = rules.where(F.col("label").startswith(_LABEL) & ~F.exists("antecedent", lambda x: x.startswith(_LABEL)))
    rules = rules.select(
        F.array_sort("antecedent").alias("antecedent"), F.substring("label", len(_LABEL) + 1, 99).alias("verdict"), "confidence", "support"
    )
    rules = rules.where(F.exists("antecedent", of_path))
    # Shorter rules with the same verdict; the number of rules is bounded by the support, not by the data.
    kept = materialize(rules, "rules")
    a, b = kept.alias("a"), kept.alias("b")
    shorter = (
        (F.col("a.verdict") == F.col("b.verdict"))
        & (F.size("b.antecedent") < F.size("a.antecedent"))
        & (F.size(F.array_except("b.antecedent", "a.antecedent")) == 0)
        & (F.col("b.confidence") >= F.col("a.confidence"))
    )
    return a.join(b, shorter, "left_anti")


def index_of(rules: DataFrame) -> DataFrame:
    """One row with the inverted index: an array of SLOTS lists, by the hash of a rule's posting token.

    A rule is posted under its token that the fewest rules have.
    """
    token = rules.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    first = Window.partitionBy("antecedent", "verdict").orderBy("n", "token")
    posted = (
        rules.withColumn("token", F.explode("antecedent"))
        .join(token, "token")
        .withColumn("at", F.row_number().over(first))
        .where(F.col("at") == 1)
        .groupBy(slot_of(F.col("token")).alias("slot"))
        .agg(F.collect_list(F.struct("antecedent", "verdict", "confidence", "support")).alias("rules"))
    )
    lists = F.map_from_entries(F.collect_list(F.struct("slot", "rules")))
    empty = F.array().cast("array<struct<antecedent:array<string>,verdict:string,confidence:double,support:double>>")
    return posted.agg(lists.alias("lists")).select(
        F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.coalesce(F.col("lists")[i], empty)).alias("index")
    )


def slot_of(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(SLOTS)).cast("int")


def judge(pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_confidence`` for each row of ``page_id, url``.

    ``rule`` is the given rule that decides, else null; then the mined rule of the highest confidence decides, of equal
    ones that of the larger support, then block before allow; ``DEFAULT`` where none fits. A url that is null or has
    no ``://`` has an empty host and path and so the default. All distinct URLs that given rules decide are mined in.
    Repeated rows are judged each; an empty table gives an empty result; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = given_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumns({"rule": name, "given": verdict, "tokens": tokens_of(F.col("host"), F.col("path"))})
    # Each URL once, however many pages have it; its query and fragment do not matter.
    labelled = judged.where("given is not null").dropDuplicates(["host", "path"]).select("tokens", F.col("given").alias("verdict"))
    labelled = materialize(labelled, "labelled")
    least = max(min_support, min(1.0, LEAST_ROWS / max(1, labelled.count())))
    index = index_of(mined(labelled, least, min_confidence))
    # The index is one row, whose size the support bounds.
    found = F.flatten(F.transform("tokens", lambda token: F.element_at(F.col("index"), slot_of(token) + 1)))
    fitting = F.filter(found, lambda rule: F.size(F.array_except(rule.antecedent, F.col("tokens"))) == 0)
    ranked = F.array_max(F.transform(fitting, lambda rule: F.struct(rule.confidence.alias("confidence"), rule.support.alias("support"), rule.verdict.alias("verdict"))))
    with_index = judged.withColumn("index", index.scalar())
    return with_index.withColumn("best", F.when(F.col("given").isNull(), ranked)).select(
        "page_id", "host", "path", "rule", F.coalesce("given", "best.verdict", F.lit(DEFAULT)).alias("verdict"), F.col("best.confidence").alias("mined_confidence")
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of each row of ``pages``; see ``judge`` for nulls, repeated rows and empty tables."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict", "mined_confidence")
