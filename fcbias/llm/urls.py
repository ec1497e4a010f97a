"""URL verdicts: rules of hosts and paths first, then boosted trees over lexical features of the URL.

The trees learn from URLs that a rule labels. Features are SQL expressions, so a scan, the features, the model and the
verdict run as one job of the JVM; only fitting, on a bounded sample, takes more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts, or suffixes, whose counts are sent to every scan at most; with more, pages are shuffled by them.
BROADCAST_ROWS = 100_000
#: Labels at the end of a host that its statistics are taken over.
SUFFIXES = {"suffix": r"[^.]*$", "domain": r"[^.]*(?:\.[^.]*)?$"}
FEATURES = ["url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "suffix_rate", "suffix_known", "domain_rate", "domain_known"]


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and a beginning of the path, such as ``example.net/en/``; and allow or block."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for a null URL or one without ``://``."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(found > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matched(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Add host, path, and rule and verdict of the longest rule that fits (of equal ones the first), else null."""
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) & F.startswith(F.col("path"), F.lit(r.path))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return pages.withColumns({"rule": rule, "verdict": verdict})


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.char_length(text)
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """Add the features that a URL has on its own, and the last label and the last two labels of its host."""
    url, n = F.coalesce("url", F.lit("")), F.char_length(F.coalesce("url", F.lit("")))
    return pages.withColumns({
        **{name: F.regexp_extract("host", pattern, 0) for name, pattern in SUFFIXES.items()},
        "url_length": n.cast("double"),
        "host_length": F.char_length("host").cast("double"),
        "path_length": F.char_length("path").cast("double"),
        "labels": F.regexp_count("host", F.lit(r"[^.]+")).cast("double"),
        "depth": F.regexp_count("path", F.lit(r"[^/]+")).cast("double"),
        "digit_ratio": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": _entropy(url),
        "parameters": F.regexp_count(url, F.lit(r"[?&][^?&#=]+=")).cast("double"),
        "hyphens": F.regexp_count(url, F.lit("-")).cast("double"),
    })


def label_counts(known: DataFrame) -> dict[str, DataFrame]:
    """Blocked and all labelled URLs by host, and of the hosts together by each kind of suffix."""
    counts = {"host": kept(known.groupBy("host", *SUFFIXES).agg(F.sum("label").alias("blocked"), F.count("*").alias("labelled")), "url-hosts")}
    for name in SUFFIXES:
        counts[name] = kept(counts["host"].groupBy(name).agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")), f"url-{name}")
    counts["host"] = counts["host"].drop(*SUFFIXES)
    return {name: F.broadcast(c) if c.count() <= BROADCAST_ROWS else c for name, c in counts.items()}


def with_suffix_rates(pages: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """Add, for each kind of suffix, the blocked share of the other hosts under it and how many URLs it rests on.

    A host's own labels are taken off, so that no URL is judged, in the fit or later, by its own label or its neighbours'.
    """
    for name, c in counts.items():
        pages = pages.join(c.withColumnsRenamed({"blocked": f"{name}_blocked", "labelled": f"{name}_labelled"}), name, "left")

    def others(name: str, what: str) -> Column:
        return F.coalesce(f"{name}_{what}", F.lit(0)) - F.coalesce(f"host_{what}", F.lit(0))

    rates = {}
    for name in SUFFIXES:
        rates[f"{name}_rate"] = (others(name, "blocked") + 1) / (others(name, "labelled") + 2)
        rates[f"{name}_known"] = F.log1p(others(name, "labelled"))
    return pages.withColumns(rates)


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 20_000, trees: int = 10, depth: int = 4, seed: int = 5) -> DataFrame:
    """Judge each URL: page_id, host, path, rule, verdict (allow or block) and score, the model's probability of block.

    The model decides where no rule fits, at 0.5. It is fitted on at most ``sample_rows`` distinct URLs of each verdict
    that rules gave, in the order of a hash; suffix statistics are over all rows but those of the URL's own host. Where rules gave one verdict only that is
    everyone's, where none then allow. Null and empty URLs have empty host and path; repeated rows are judged each;
    columns other than page_id and url are ignored.
    """
    judged = lexical(matched(pages.select("page_id", "url"), rules))
    known = judged.filter("verdict is not null").withColumn("label", (F.col("verdict") == "block").cast("double"))
    counts = label_counts(known)
    order = [F.xxhash64("url"), F.col("url")]
    distinct = known.select("url", "label").distinct()
    sample = [distinct.filter(F.col("label") == y).orderBy(*order).limit(sample_rows) for y in (0.0, 1.0)]
    sample = kept(sample[0].unionAll(sample[1]), "url-sample")
    there = [bool(sample.filter(F.col("label") == y).take(1)) for y in (0.0, 1.0)]
    result = ["page_id", "host", "path", "rule"]
    if not all(there):
        only = "block" if there[1] else "allow"
        return judged.select(*result, F.coalesce("verdict", F.lit(only)).alias("verdict"), F.lit(float(there[1])).alias("score"))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = assemble.transform(with_suffix_rates(lexical(matched(sample, rules)), counts)).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, cacheNodeIds=False, maxMemoryInMB=64).fit(train)
    scored = model.transform(assemble.transform(with_suffix_rates(judged, counts)))
    score = vector_to_array("probability")[1]
    verdict = F.coalesce("verdict", F.when(score >= 0.5, "block").otherwise("allow"))
    return scored.select(*result, verdict.alias("verdict"), score.alias("score"))
