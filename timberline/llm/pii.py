"""Personal data by boosted trees over candidate spans, with DataFrame functions only.

Patterns of fixed kinds with their checks give the base spans. Looser generators propose further candidates, which may
overlap. Gradient-boosted trees are trained on the candidates of all documents, with the checks of the base
kinds as labels that the features do not show: they describe the format of a candidate (counts of kinds of characters,
groups, changes) and its context. Candidates of equal features are one row with a weight. The trees become one SQL expression, so that all candidates are scored where
their text is read, without a shuffle. A threshold for each generator is set on held-out candidates of its kind whose label
is known, such that the wanted share of what it lets pass is right. Of accepted spans that overlap the best one stays, and
then each next one that overlaps none that stays.

Places are code points. All patterns are written such that Java's matcher takes linear time and no recursion.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.session import materialize

# Patterns of the base kinds. A match begins at the start of its run of characters or where the match
# before has ended, as no later start in the same run could match; possessive repeats match the same text.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of the method, with more recall than precision.
GENERATORS = {
    "mail_like": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]{2,}+[ ]?(?:\(at\)|\[at\]|\{at\}| at )[ ]?[a-z0-9-]{2,}+(?:[ ]?(?:\(dot\)|\[dot\]|\{dot\}| dot )[ ]?[a-z0-9-]{2,}+)++",
    "number_like": r"\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
    "secret": r"(?i:password|passwd|pwd|token|secret|api[_-]?key)[ ]{0,3}[=:][ ]{0,3}[\"']?[^\s\"']{6,}+[\"']?|\b[A-Z0-9]{16,}+\b|\b[A-Fa-f0-9]{24,}+\b",
}
# What a text has to contain for a pattern to be tried: each match of the pattern contains it.
NEEDS = {
    "email": "@",
    "ip": "[0-9]",
    "card": "[0-9]",
    "phone": r"\+",
    "mail_like": r"(?i)\(dot\)|\[dot\]|\{dot\}| dot ",
    "number_like": "[0-9]",
    "secret": r"(?i:password|passwd|pwd|token|secret|api[_-]?key)[ ]{0,3}[=:]|\b[A-Z0-9]{16}|\b[A-Fa-f0-9]{24}",
}
KINDS = [*BASE, *GENERATORS]
_KEYWORD = r"(?i)(password|passwd|pwd|token|secret|key|mail|phone|tel|call|card|iban|ssn|account)"
_PHRASE = r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]{2,}+ at [a-z0-9-]{2,}+(?! dot |[ ]?[(\[{]dot)"
_SURE_SECRET = r"(?i)^(password|passwd|pwd|token|secret|api[_-]?key)[ ]{0,3}[=:]|^AKIA[A-Z0-9]{16}$"

TREES, DEPTH, SEED = 10, 4, 7
# All words of a text are learned from as plain ones; together they weigh as much as so many candidates, each at most as one.
PLAIN_WORDS = 10
# Weights are summed in millionths, so that the sums do not depend on their order.
UNIT = 1_000_000
PRECISION = 0.95
LEAST_OF_A_CLASS = 20
HELD_OUT = 5

SPAN = "struct<kind:string,start:long,end:long>"
FEATURES = ["length", "digits", "upper", "lower", "other", "distinct", "runs", "changes", "touches_before", "touches_after", "assigned", "keyword"]


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches: ``kind, start, end, text, before, after`` with their surroundings.

    The pieces between the matches and the matches themselves, one after the other, give the places.
    """
    row = "struct<kind:string,start:long,end:long,text:string,before:string,after:string>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    ahead = F.slice(between, 2, F.size(between))

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        one = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["match"].alias("text"),
            F.right(x["piece"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(1)).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(one)).alias("spans"))

    zipped = F.filter(
        F.arrays_zip(between.alias("piece"), found.alias("match"), ahead.alias("next")), lambda x: x["match"].isNotNull()
    )
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{row}>").alias("spans"))
    spans = F.aggregate(zipped, nothing, add, lambda done: done["spans"])
    return F.when(text.rlike(NEEDS.get(kind, pattern)), spans).otherwise(F.array().cast(f"array<{row}>"))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.filter(F.split(F.reverse(number), ""), lambda x: x != "")
    weighed = F.transform(each, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((x.cast("int") * 2) % 10 + F.floor(x.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(weighed, F.lit(0), lambda total, x: total + x) % 10 == 0


def holds(span: Column) -> Column:
    """The check of a base kind."""
    number = digits_of(span["text"])
    small = F.forall(F.split(span["text"], r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(F.try_to_number(F.lpad(F.right(x, F.lit(3)), 3, "0"), F.lit("999")), F.lit(999)) <= 255))
    return (
        F.when(span["kind"] == "email", True)
        .when(span["kind"] == "ip", small)
        .when(span["kind"] == "card", F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False))
        .otherwise(F.length(number).between(9, 15))
    )


def described(span: Column) -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    text = span["text"]
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    size = F.length(text).cast("double")
    return {
        "length": size,
        "digits": count("[0-9]"),
        "upper": count("[A-Z]"),
        "lower": count("[a-z]"),
        "other": size - count("[A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(text, ""))).cast("double"),
        "runs": count("[0-9]++"),
        "changes": count("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "touches_before": flag(span["before"].rlike("[A-Za-z0-9]$")),
        "touches_after": flag(span["after"].rlike("^[A-Za-z0-9]")),
        "assigned": flag(text.rlike("[=:]")),
        "keyword": flag(F.concat(span["before"], text).rlike(_KEYWORD)),
    }


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def covers(a: Column, b: Column) -> Column:
    return (a["start"] <= b["start"]) & (b["end"] <= a["end"])


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_tried``, the matches of the base kinds, and ``_base``, those that pass their check."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tried = F.concat(*[matches(text, kind, pattern) for kind, pattern in BASE.items()])
    return docs.withColumn("_tried", tried).withColumn("_base", F.filter("_tried", holds))


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_found``, the candidates of the generators, and ``_more``, those that no base span covers."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = F.concat(*[matches(text, kind, pattern) for kind, pattern in GENERATORS.items()])
    return docs.withColumn("_found", found).withColumn("_more", F.filter("_found", lambda x: ~F.exists("_base", lambda b: covers(b, x))))


def known(x: Column) -> Column:
    """The label of a candidate of a generator, where something else says it, else null.

    Numbers: whether a base span lies in them or around them, or a match of a base kind that failed its check. Secrets:
    right with a keyword or a known form, wrong if they are letters or digits alone.
    """
    secret = F.when(x["text"].rlike(_SURE_SECRET), 1).when(x["text"].rlike("^([A-Za-z]+|[0-9]+)$"), 0)
    near = lambda spans: F.exists(spans, lambda b: overlaps(b, x) & (b["kind"] != "email"))
    number = F.when(near("_base"), 1).when(near("_tried"), 0)
    return F.when(x["kind"] == "secret", secret).when(x["kind"] == "number_like", number)


def training_rows(docs: DataFrame) -> DataFrame:
    """``fold``, ``kind``, ``label``, the features and ``weight``, of all candidates whose label is known.

    Matches of base patterns have the label of their check, candidates of generators that of ``known``. Addresses in disguise have
    no check, so base addresses are disguised; phrases with ``at`` and no dot are wrong. The words of a text are
    wrong and weigh PLAIN_WORDS together. Candidates of which nothing is known are not learned from. There is one row for all candidates
    that are equal in all of this; ``weight`` is their number.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)).alias("fold")
    own = with_candidates(with_base(docs.select("doc_id", "text")))
    zero = F.lit(0).cast("long")

    def candidate(text: Column, kind: str, before: Column, after: Column) -> Column:
        parts = {"kind": F.lit(kind), "start": zero, "end": zero, "text": text, "before": before, "after": after}
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    def labelled(spans, label) -> Column:
        return F.transform(spans, lambda x: F.struct(x.alias("span"), label(x).cast("double").alias("label")))

    disguised = lambda x: F.replace(F.replace(x["text"], F.lit("@"), F.lit(" at ")), F.lit("."), F.lit(" dot "))
    mails = F.transform(F.filter("_base", lambda x: x["kind"] == "email"), lambda x: candidate(disguised(x), "mail_like", x["before"], x["after"]))
    phrases = F.transform(matches(F.coalesce("text", F.lit("")), "phrase", _PHRASE), lambda x: candidate(x["text"], "mail_like", x["before"], x["after"]))
    none = F.array().cast(own.schema["_more"].dataType)
    spans = own.select(
        fold,
        F.explode(
            F.concat(
                labelled(F.col("_tried"), holds),
                labelled(F.col("_found"), known),
                labelled(mails, lambda x: F.lit(1)),
                labelled(F.coalesce(phrases, none), lambda x: F.lit(0)),
            )
        ).alias("one"),
    ).where("one.label is not null")
    spans = spans.select("fold", "one.span", "one.label", F.lit(UNIT).cast("long").alias("units"))
    # Words are counted before they are described, as most of them come again.
    every = F.regexp_extract_all(F.col("text"), F.lit(r"[^\s0-9]{4,}+"), F.lit(0))
    texts = docs.select(fold, every.alias("words"))
    share = F.greatest(F.lit(UNIT * PLAIN_WORDS).cast("long") / F.greatest(F.size("words"), F.lit(PLAIN_WORDS)), F.lit(1)).cast("long")
    words = texts.select("fold", share.alias("units"), F.explode("words").alias("word")).groupBy("fold", "word").agg(F.sum("units").alias("units"))
    words = words.select("fold", candidate(F.col("word"), "word", F.lit(" "), F.lit(" ")).alias("span"), F.lit(0.0).alias("label"), "units")
    span = F.col("span")
    rows = spans.unionByName(words).select("fold", span["kind"].alias("kind"), "label", *[c.alias(n) for n, c in described(span).items()], "units")
    return rows.groupBy("fold", "kind", "label", *FEATURES).agg((F.sum("units") / UNIT).alias("weight"))


class Scorer:
    """Trees as expressions, and the threshold of each kind that goes with them."""

    def __init__(self, trees: list[tuple[float, str]], thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def passes(self, x: Column) -> Column:
        """Whether a candidate with its ``margin`` reaches the threshold of its kind."""
        test = F.lit(False)
        for kind, threshold in self.thresholds.items():
            test = F.when(x["kind"] == kind, x["margin"] >= threshold).otherwise(test)
        return test

    def margin(self, features: dict[str, Column]) -> Column:
        total = F.lit(0.0)
        for weight, lines in self.trees:
            total = total + F.lit(weight) * _tree(iter(lines.splitlines()), [features[name] for name in FEATURES])
        return total


_IF = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def _tree(lines, features: list[Column]) -> Column:
    """One printed tree as nested conditions."""
    line = next(lines).strip()
    leaf = _LEAF.match(line)
    if leaf:
        return F.lit(float(leaf.group(1)))
    test = _IF.match(line)
    if test is None:
        return _tree(lines, features)
    left = _tree(lines, features)
    next(lines)  # the other side of the same test
    return F.when(features[int(test.group(1))] <= float(test.group(3)), left).otherwise(_tree(lines, features))


def learned(docs: DataFrame) -> Scorer | None:
    """Boosted trees from all candidates of ``docs``; none where there are too few examples of a class."""
    rows = materialize(training_rows(docs), "candidates")
    classes = {row.label: row.n for row in rows.where("fold > 0").groupBy("label").agg(F.sum("weight").alias("n")).collect()}
    if min(classes.get(0.0, 0), classes.get(1.0, 0)) < LEAST_OF_A_CLASS:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1, weightCol="weight").fit(data.where("fold > 0"))
    scorer = Scorer([(weight, tree.toDebugString.split("\n", 1)[1]) for weight, tree in zip(model.treeWeights, model.trees)], {})
    # Rounded down, so that a threshold lets pass what it was set by; a few hundred values at most.
    margin = (F.floor(scorer.margin({name: F.col(name) for name in FEATURES}) * 100) / 100).alias("margin")
    held = rows.where("fold = 0").groupBy("kind", margin).agg(F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n")).collect()
    for kind in GENERATORS:
        own = [row for row in held if row.kind == kind]
        # A kind with too few labels of its own is judged by all of them.
        few = min(sum(row.right for row in own), sum(row.n - row.right for row in own)) < LEAST_OF_A_CLASS
        scorer.thresholds[kind] = calibrated(held if few else own)
    return scorer


def calibrated(held: list) -> float:
    """The least margin, 0 at least, from which PRECISION of the rows ``margin, right, n`` are right; infinite if there is none."""
    right = number = 0.0
    threshold = float("inf")
    for row in sorted(held, key=lambda row: -row.margin):
        right, number = right + row.right, number + row.n
        if right / number >= PRECISION:
            threshold = row.margin
    return max(threshold, 0.0)


def undisputed(spans: Column | str) -> Column:
    """Of ``kind, start, end, margin`` the best one, then each next one that overlaps none taken before, in their given order.

    Equal margins: the earlier start first, then the kind.
    """
    order = F.array_sort(F.transform(spans, lambda x: F.struct((-x["margin"]).alias("less"), x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    nothing = F.array().cast("array<struct<less:double,start:bigint,kind:string,end:bigint>>")
    taken = F.aggregate(order, nothing, lambda done, x: F.when(F.exists(done, lambda y: overlaps(x, y)), done).otherwise(F.concat(done, F.array(x))))
    same = lambda x, y: (x["start"] == y["start"]) & (x["kind"] == y["kind"]) & (x["end"] == y["end"])
    return F.filter(spans, lambda x: F.exists(taken, lambda y: same(x, y)))


def found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of ``kind, start, end``, in the order of KINDS and then of places.

    ``docs`` needs ``doc_id, text``. ``spans`` has the base spans and what the trees accept beside them, as ``undisputed`` says.
    A null or empty text has none; rows without an id and repeated rows are each worked on; an empty table gives an
    empty result; texts are worked on whole; columns of ``docs`` with the names of the two are replaced.
    """
    scorer = learned(docs)
    held = with_base(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text"))
    names = [F.col("_row").getField(name).alias(name) for name in docs.columns if name not in ("base", "spans")]
    plain = lambda spans: F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    base = plain(F.col("_base"))
    if scorer is None:
        return held.select(*names, base.alias("base"), base.alias("spans"))
    scored = F.transform(
        "_more",
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), scorer.margin(described(x)).alias("margin")),
    )
    held = with_candidates(held).withColumn("_passed", F.filter(scored, scorer.passes))
    return held.select(*names, base.alias("base"), F.concat(base, plain(undisputed("_passed"))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined. They are in the order of their kinds and places already."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``[kind]`` in the place of each span; ``n_chars``, if there, follows. Spans that overlap become one."""
    held = found(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.col("text").cast("string").alias("text")))
    order = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    text = F.col("text")

    def put(done: Column, x: Column) -> Column:
        new = F.concat(done["out"], F.substring(text, done["at"].cast("int") + 1, (x["start"] - done["at"]).cast("int")), F.lit("["), x["kind"], F.lit("]"))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), F.when(x["start"] >= done["at"], new).otherwise(done["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"].cast("int") + 1, F.length(text)))
    out = held.withColumn("_text", F.when(F.size("spans") > 0, F.aggregate(order, start, put, rest)).otherwise(text))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        size = F.length("_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("spans") > 0, size).otherwise(F.col("_row.n_chars"))
    return out.select(*[new.get(name, F.col("_row").getField(name)).alias(name) for name in docs.columns])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of each row of ``documents``, with the number of spans and of those of each added kind; see ``found``."""
    docs = found(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    of = lambda spans, kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return docs.select(
        "doc_id",
        *[of("base", kind) for kind in BASE],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        *[of("spans", kind) for kind in GENERATORS],
    )
