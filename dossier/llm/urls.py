"""Filters on addresses of pages: rules first, else a classifier; DataFrame functions only.

Rules allow or block a host with its subdomains below a path. Addresses that no
rule fits go to a logistic regression on hashed character n-grams of host and
path, trained from a small table of labelled addresses.

Defined results: a null address, and one without ``://``, has an empty host and
path and fits no rule; a classifier trained on no address or on one kind only
gives every address that kind, or ``allow``; repeated rows are judged each by
itself; an empty table gives no rows. Other columns stay as they are.
"""

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.staging import staged

ALLOW, BLOCK = "allow", "block"

# The table of labelled addresses has at most so many rows.
MAX_LABELLED = 4096
NGRAMS = (3, 4)
HASH_BUCKETS = 1 << 12
REGULARISATION = 1e-3
ITERATIONS = 50
# Rules are one expression; a longer list would belong in a table.
MAX_RULES = 500

_SLOTS = 1 << 30


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(after, r"\A[^?#]*", 0)


def with_parts_of_url(pages: DataFrame, url: str = "url") -> DataFrame:
    host, path = split_url(F.col(url))
    return pages.withColumns({"host": host, "path": path})


def _fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & F.col("path").startswith(rule.path)


def with_rule(addresses: DataFrame, rules: list[Rule]) -> DataFrame:
    """``addresses`` with ``rule`` and ``rule_verdict`` of the longest rule that fits, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, not {len(rules)}")
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r)):
        text = F.when(_fits(rule), F.lit(rule.text)).otherwise(text)
        verdict = F.when(_fits(rule), F.lit(rule.verdict)).otherwise(verdict)
    return addresses.withColumns({"rule": text, "rule_verdict": verdict})


def ngrams(host: Column, path: Column) -> Column:
    """The character n-grams of host and of path, marked by which they are from."""

    def of_size(letters, mark, n):
        starts = F.when(
            F.size(letters) >= n, F.sequence(F.lit(1), F.size(letters) - (n - 1))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(letters, i, F.lit(n)), ""))
        )

    def of(text, mark):
        letters = F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))
        # Bound by a lambda, the letters are split once, not for each n-gram.
        return F.transform(letters, lambda x: F.concat(*[of_size(x, mark, n) for n in NGRAMS]))

    return F.flatten(F.concat(of(host, "h"), of(path, "p")))


class UrlClassifier(NamedTuple):
    """A fitted model, or the one verdict that all labelled addresses had."""

    model: object | None
    only: str = ALLOW

    def classify(self, addresses: DataFrame) -> DataFrame:
        """``addresses`` (with ``host`` and ``path``) with ``block_score`` in [0, 1]."""
        if self.model is None:
            return addresses.withColumn("block_score", F.lit(float(self.only == BLOCK)))
        given = addresses.withColumn("_grams", ngrams(F.col("host"), F.col("path")))
        scored = self.model.transform(_hashed(given))
        return scored.withColumn("block_score", vector_to_array("_probability")[1]).drop(
            "_grams", "_features", "_raw", "_probability", "_prediction"
        )


def _hashed(given: DataFrame) -> DataFrame:
    hashing = HashingTF(numFeatures=HASH_BUCKETS, binary=True, inputCol="_grams", outputCol="_features")
    return hashing.transform(given)


def train(labelled: DataFrame, most: int = MAX_LABELLED) -> UrlClassifier:
    """A classifier from ``host``, ``path`` and ``verdict``.

    Of more than about ``most`` distinct addresses those with the smallest hashes are
    used. An address labelled both ways counts as blocked.
    """
    hashed = labelled.withColumn("_order", F.xxhash64("host", "path"))
    # Addresses are told apart only among about as many as are wanted, not among all.
    distinct = hashed.agg(F.approx_count_distinct("_order", 0.02)).first()[0]
    share = min(1.0, most / max(1, distinct))
    table = (
        hashed.where(F.pmod("_order", F.lit(_SLOTS)) < int(share * _SLOTS))
        .groupBy("host", "path", "_order")
        .agg(F.max((F.col("verdict") == BLOCK).cast("int")).alias("_label"))
        .orderBy(F.pmod("_order", F.lit(_SLOTS)), "host", "path")
        .limit(most)
        .select(ngrams(F.col("host"), F.col("path")).alias("_grams"), F.col("_label").cast("double"))
    )
    table = staged(table, "url-labels")
    kinds = [row[0] for row in table.select("_label").distinct().collect()]  # at most two rows
    if len(kinds) < 2:
        return UrlClassifier(None, BLOCK if kinds == [1.0] else ALLOW)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability",
        rawPredictionCol="_raw", predictionCol="_prediction",
        regParam=REGULARISATION, maxIter=ITERATIONS,
    )
    return UrlClassifier(regression.fit(_hashed(table)))


def judge_urls(pages: DataFrame, rules: list[Rule], classifier: UrlClassifier, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``block_score`` and ``verdict``."""
    judged = classifier.classify(with_rule(with_parts_of_url(pages, url), rules))
    by_model = F.when(F.col("block_score") >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.withColumn("verdict", F.coalesce("rule_verdict", by_model)).drop("rule_verdict")


def labelled_by_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Labelled addresses: those of ``pages`` that a rule decides."""
    decided = with_rule(with_parts_of_url(pages.select(url), url), rules).where("rule IS NOT NULL")
    return decided.select("host", "path", F.col("rule_verdict").alias("verdict"))
