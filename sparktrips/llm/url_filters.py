"""URL filter: host and path rules first, gradient-boosted trees for the rest.

The trees see lexical features only (length, depth, digit ratio, character
entropy, parameter counts) and statistics of the host's suffix. They learn from
the URLs that a rule labels. Everything but the fit covers every row; the fit
uses at most ``MAX_TRAIN`` labelled rows, those with the smallest hash of the
URL, and all of them where there are fewer.

Defined results: a null URL, or one without ``://``, has empty host and path, no
rule, and is judged by the trees like any other; repeated rows and equal ids
give one row each; an empty table gives an empty result; without labelled rows
of both verdicts the only label seen (or ``allow``) is given to all the rest;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrips.llm.common import cut, lower_ascii

#: Most labelled rows that the trees are fitted on.
MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 12, 4, 7
#: Weight of the overall block rate in a suffix's block rate, in rows.
PRIOR_ROWS = 20.0


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

LEXICAL = ("url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio",
           "url_entropy", "n_params", "has_fragment", "n_hyphens")
SUFFIX = ("suffix_share", "suffix_block_rate")


def _location(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def _occurrences(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")
    each = F.transform(F.array_distinct(F.split(text, "")),
                       lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    return F.when(F.length(text) > 0, F.aggregate(each, F.lit(0.0), lambda s, k: s - F.when(k > 0, k / n * F.log2(k / n)).otherwise(0.0))).otherwise(0.0)


def with_location(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(id, url)`` rows with host, path, the longest fitting rule and its verdict."""
    located = pages.withColumns({"host": lower_ascii(_location(F.col("url"), 1)), "path": _location(F.col("url"), 2)})
    fitting = [(r, r.fits(F.col("host"), F.col("path"))) for r in sorted(rules, key=lambda r: -len(r.name))]
    rule = F.coalesce(*[F.when(fits, r.name) for r, fits in fitting], F.lit(None).cast("string"))
    labelled = located.withColumn("rule", rule)
    named = reduce(lambda c, r: c.when(F.col("rule") == r.name, r.verdict), rules, F.when(F.lit(False), F.lit(None).cast("string")))
    return labelled.withColumn("rule_verdict", named)


def with_lexical(located: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return located.withColumns({
        "url_length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "path_depth": _occurrences(F.col("path"), "/").cast("double"),
        "digit_ratio": _occurrences(url, "[0-9]") / n,
        "url_entropy": _entropy(url),
        "n_params": F.when(query == "", 0.0).otherwise(_occurrences(query, "&") + 1.0),
        "has_fragment": F.instr(url, "#").cast("boolean").cast("double"),
        "n_hyphens": _occurrences(url, "-").cast("double"),
        "suffix": F.substring_index("host", ".", -1),
    })


def with_suffix_statistics(rows: DataFrame) -> DataFrame:
    """Adds each suffix's share of all rows and its smoothed share of blocked rows
    among the labelled ones. The statistics are one row per suffix, counted with
    partial sums; Spark broadcasts them only where they are small when it runs."""
    blocked = (F.col("rule_verdict") == "block").cast("double")
    per_suffix = rows.groupBy("suffix").agg(F.count("*").alias("n"), F.count("rule_verdict").alias("n_labelled"),
                                            F.coalesce(F.sum(blocked), F.lit(0.0)).alias("n_blocked"))
    overall = per_suffix.agg(F.sum("n").alias("n"), F.sum("n_labelled").alias("l"), F.sum("n_blocked").alias("b")).first()
    rate = overall.b / overall.l if overall.l else 0.5
    statistics = per_suffix.select(
        "suffix", (F.col("n") / F.lit(float(overall.n or 1))).alias("suffix_share"),
        ((F.col("n_blocked") + F.lit(rate * PRIOR_ROWS)) / (F.col("n_labelled") + F.lit(PRIOR_ROWS))).alias("suffix_block_rate"))
    return rows.join(statistics, "suffix", "left")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: tuple[Rule, ...] = RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """Per row: id, host, path, rule (null where none fits), verdict, and
    ``block_probability`` where the trees decided (else null)."""
    rows = with_lexical(with_location(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), rules))
    rows = with_suffix_statistics(rows)
    features = [*LEXICAL, *SUFFIX]
    labelled = (rows.where(F.col("rule_verdict").isNotNull())
                .select((F.col("rule_verdict") == "block").cast("double").alias("label"), *features,
                        F.xxhash64("url").alias("order"))
                .orderBy("order", *features).limit(max_train).drop("order"))
    sample = cut(labelled)
    seen = {r.label for r in sample.select("label").distinct().collect()}
    out = [F.col("id").alias(id_col), "host", "path", "rule"]
    if len(seen) < 2:
        only = "block" if seen == {1.0} else "allow"
        return rows.select(*out, F.coalesce("rule_verdict", F.lit(only)).alias("verdict"),
                           F.lit(None).cast("double").alias("block_probability"))
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3)
    model = trees.fit(assembler.transform(sample).select("label", "features"))
    judged = model.transform(assembler.transform(rows))
    from pyspark.ml.functions import vector_to_array
    probability = vector_to_array("probability")[1]
    free = F.col("rule_verdict").isNull()
    return judged.select(*out,
                         F.when(~free, F.col("rule_verdict")).when(F.col("prediction") == 1.0, "block").otherwise("allow").alias("verdict"),
                         F.when(free, probability).alias("block_probability"))
