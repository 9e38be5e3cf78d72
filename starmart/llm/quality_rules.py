"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document gets counts and rule failures; hosts get the failure rate of each
rule, shrunk toward the rate of all hosts with a beta prior fitted to the spread
between hosts (method of moments); a host whose shrunken rate of failing documents
is too high is rejected with all its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.common import stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The rules of a document: name -> failure, over the counts.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "100 * n_dup_lines > 30 * greatest(n_lines, 1)",
}
BASE_RULES = ("short", "repeats")


@dataclass(frozen=True)
class HostPolicy:
    """max_rate: the shrunken share of failing documents above which a host is rejected.
    min_documents: hosts with fewer documents are never rejected."""

    max_rate: float = 0.75
    min_documents: int = 20


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `COUNTS` and `n_lines` (all long) of the column `text`; null text counts as empty.

    Words are `[^\\x20\\x09-\\x0D]+`. `n_repeat_words` counts the words in three-word
    windows that are found twice or more, the first one included.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_words", F.array_remove(F.split(whole, r"[ \t-\r]+"), ""))
    df = df.withColumn("_lines", F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^ \t-\r]")))
    windows = F.transform(
        F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    df = df.withColumn("_windows", windows).withColumn("_sorted", F.sort_array("_windows"))
    df = df.withColumn("_repeated", F.size(F.array_distinct("_sorted")) < F.size("_sorted"))
    # Only a text with some window twice has its windows sorted with their places.
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(F.col("_repeated"), placed))
    twice = F.filter("_placed", lambda x, k: (x.h == F.get("_placed", k - 1).h) | (x.h == F.get("_placed", k + 1).h))
    df = df.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x.i)))
    covered = F.aggregate(
        F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1), p + 3) - p)),
        F.lit(0).cast("long"),
        lambda total, more: total + more,
    )
    n_chars = F.char_length(whole)
    df = df.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (n_chars - F.char_length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return df


def with_failures(df: DataFrame) -> DataFrame:
    """One boolean `fails_<rule>` for each of RULES, and `fails_any`."""
    df = df.withColumns({f"fails_{name}": F.expr(rule) for name, rule in RULES.items()})
    return df.withColumn("fails_any", F.expr(" OR ".join(f"fails_{name}" for name in RULES)))


def host_rates(df: DataFrame, host: str = "host") -> DataFrame:
    """For each host: n_docs and, per rule, `n_<rule>` failures and the shrunken `rate_<rule>`.

    Beta prior: mean m = failures / documents over all hosts; its strength follows
    from how much more the hosts' rates vary than documents drawn at rate m would,
    within [1, 10^6] documents.
    """
    rules = [*RULES, "any"]
    hosts = df.groupBy(host).agg(
        F.count("*").alias("n_docs"), *[F.count_if(F.col(f"fails_{r}")).alias(f"n_{r}") for r in rules]
    )
    # One row of sums over the hosts, looked up as scalar subqueries.
    sums = hosts.agg(
        F.sum("n_docs").alias("docs"), F.count("*").alias("hosts"),
        *[F.sum(f"n_{r}").alias(f"f_{r}") for r in rules],
        *[F.sum(F.col(f"n_{r}") * F.col(f"n_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in rules],
    )
    for r in rules:
        m = F.col(f"f_{r}") / F.col("docs")
        spread = F.col(f"q_{r}") / F.col("docs") - m * m  # of the hosts' rates, weighted by documents
        drawn = m * (1 - m) * F.col("hosts") / F.col("docs")
        strength = F.when(spread > drawn, m * (1 - m) / (spread - drawn) - 1)
        sums = sums.withColumn(f"m_{r}", m).withColumn(
            f"k_{r}", F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.coalesce(strength, F.lit(1e6))))
        )
    prior = sums.select(F.struct(*[F.struct(f"m_{r}", f"k_{r}").alias(r) for r in rules]).alias("prior")).scalar()
    hosts = hosts.withColumn("_prior", prior)
    for r in rules:
        m, k = F.col(f"_prior.{r}.m_{r}"), F.col(f"_prior.{r}.k_{r}")
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"n_{r}") + m * k) / (F.col("n_docs") + k))
    return hosts.drop("_prior")


def _host(host: Column | str) -> Column:
    name = F.col(host) if isinstance(host, str) else host
    return F.coalesce(name.cast("string"), F.lit(""))


def _verdicts(rows: DataFrame, policy: HostPolicy) -> DataFrame:
    return host_rates(rows).select(
        "host",
        ((F.col("n_docs") >= policy.min_documents) & (F.col("rate_any") > policy.max_rate)).alias("host_rejected"),
    )


_BASE_FAILED = " OR ".join(f"fails_{r}" for r in BASE_RULES)


def judged(docs: DataFrame, host: Column | str = "source", text: str = "text", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """`docs` without its text, with COUNTS, `base_failed`, `host_rejected` and `kept`.

    A null host is a host of its own, named ''. Null and empty texts have zero
    counts and fail the base rules. Each row is judged by itself, so repeated rows and
    repeated ids stay. No rows give no rows. The counts are stored once; the hosts
    are summed from them with partial sums, so a hot host reaches the shuffle as a
    row per task, and joined back by an equi-join that adaptive execution may split.
    """
    rows = docs.select("doc_id", F.col(text).alias("_text"), _host(host).alias("host"))
    rows = stored(with_failures(with_counts(rows, "_text").drop("_text")), "quality")
    return (
        rows.join(_verdicts(rows, policy), "host")
        .withColumn("base_failed", F.expr(_BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .select("doc_id", *COUNTS, "base_failed", "kept", "host", "host_rejected")
    )


def kept_documents(docs: DataFrame, host: Column | str = "source", text: str = "text", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """The rows of `docs`, with all their columns, that `judged` keeps.

    The counts are made once for the hosts and again for the documents, so that no text is
    stored or shuffled: the rejected hosts are stored first, so their size is known when the
    join is planned, and only where they are many do the documents meet them by a shuffle.
    Columns of any name may be there.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text"), _host(host).alias("host"))
    # Observing the rows keeps the optimizer from computing the counts anew inside the filter below.
    counted = with_failures(with_counts(rows, "_text")).observe("counted", F.count("*").alias("rows"))
    rejected = _verdicts(stored(counted.drop("_row", "_text"), "quality"), policy).where("host_rejected").select("host")
    rejected = stored(rejected, "rejected")
    kept = counted.where(f"NOT ({_BASE_FAILED})").join(rejected, "host", "left_anti")
    return kept.select("_row.*")
