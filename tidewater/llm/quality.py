"""Quality rules with host-level verdicts, in built-in SQL functions only.

Every document is measured by its whole text. Failures of each rule are summed
per host (the ``source`` column), the host's failure rate is shrunk towards
the pooled rate by a beta prior fitted to all hosts (method of moments), and a
host whose shrunk rate passes ``max_host_rate`` for any rule loses all its
documents. A document is kept when it passes its own base rules and its host
passes.

Defined results: a null text has no words and fails; a document without a host
(null source) is judged by its own rules only; repeated rows are judged row by
row; an empty table gives an empty result; columns of the input that share a
name with a measure are left alone, for the input row travels as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep_table

SPACE_CHARS = " \t\n\x0b\f\r"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOLS_PER_WORD = 0.3
MAX_DUP_LINE_SHARE = 0.3
WORD_LENGTH = (2.0, 15.0)
MAX_HOST_RATE = 0.5
MAX_PRIOR_STRENGTH = 1e6
SALTS = 32

RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def _window_hashes(words: str) -> Column:
    """One 64-bit hash for each window of WINDOW words, by position; empty for shorter texts."""
    w = F.col(words)
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                         lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(WINDOW)]))
    return F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def measure(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``doc`` (the input row as a struct), ``host``, the five measures, ``n_lines`` and ``base_failed``.

    Words of repeated windows are found inside the row: window hashes are
    sorted with their positions, neighbours with equal hashes are starts of
    repeated windows, and the union of [start, start + 5) is summed from the gaps
    between starts. Texts without a repeated hash skip the sort.
    """
    d = docs.select(F.struct("*").alias("doc"), F.col(host).cast("string").alias("host"),
                    F.coalesce(F.col(text), F.lit("")).alias("body"))
    d = d.select("doc", "host", "body", _words(F.col("body")).alias("words"),
                 F.filter(F.split("body", "\n"), lambda line: line.rlike(WORD_CLASS)).alias("lines"))
    d = d.select("doc", "host", "words",
                 F.size("words").cast("long").alias("n_words"),
                 F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _window_hashes("words").alias("hashes"))
    rest = ["doc", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    sorted_windows = F.array_sort(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*rest, F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"),
                               sorted_windows).alias("windows"))
    w = F.col("windows")
    starts = F.array_sort(F.transform(
        F.filter(w, lambda x, j: (x["h"] == F.get(w, j - 1)["h"]).eqNullSafe(True)
                 | (x["h"] == F.get(w, j + 1)["h"]).eqNullSafe(True)),
        lambda x: x["i"]))
    d = d.select(*rest, F.when(w.isNotNull(), starts).alias("starts"))
    s = F.col("starts")
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size(s)), F.lit(0).cast("long"),
        lambda acc, j: acc + F.least(F.lit(WINDOW), F.coalesce(F.get(s, j) - F.get(s, j - 1), F.lit(WINDOW))))
    repeated = F.when(s.isNotNull(), covered).otherwise(F.lit(0).cast("long"))
    # a filter on the measures stops at the generator, so that nothing is computed over and over inside it
    d = d.select("doc", "host", F.inline(F.array(F.struct(*rest[2:], repeated.alias("n_repeat_words")))))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _failures() -> dict[str, Column]:
    n = F.col("n_words")
    mean_length = F.col("word_chars") / F.greatest(n, F.lit(1))
    return {
        "few_words": n < MIN_WORDS,
        "repeats": F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"),
        "word_length": (n > 0) & ~mean_length.between(*WORD_LENGTH),
    }


def host_verdicts(measured: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, the shrunk failure rate of each rule, ``host_ok``.

    Counts are partially aggregated before the shuffle, so a host with most of
    the rows costs one row per task. The prior has one row.
    """
    fails = _failures()
    hosts = (measured.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count("*").alias("n_docs"),
                  *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in fails.items()]))
    n, total, count = F.col("n_docs"), F.sum("n_docs"), F.count("*")
    sums = hosts.agg(total.alias("total"), count.alias("n_hosts"),
                     *[F.sum(f"f_{r}").alias(f"t_{r}") for r in RULES],
                     *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / n).alias(f"q_{r}") for r in RULES])
    prior = []
    for r in RULES:
        mean = F.col(f"t_{r}") / F.col("total")
        spread = F.col(f"q_{r}") / F.col("total") - mean * mean
        binomial = mean * (1 - mean) * (F.col("n_hosts") - 1) / F.col("total")
        between = spread - binomial
        strength = F.when(between <= mean * (1 - mean) / MAX_PRIOR_STRENGTH, F.lit(MAX_PRIOR_STRENGTH)) \
            .otherwise(F.greatest(mean * (1 - mean) / between - 1, F.lit(1.0)))
        prior += [mean.alias(f"m_{r}"), strength.alias(f"s_{r}")]
    shrunk = hosts.crossJoin(F.broadcast(sums.select(*prior)))  # one row
    rates = [((F.col(f"f_{r}") + F.col(f"m_{r}") * F.col(f"s_{r}")) / (n + F.col(f"s_{r}"))).alias(f"rate_{r}")
             for r in RULES]
    out = shrunk.select("host", "n_docs", *rates)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return out.withColumn("worst_rate", worst).withColumn("host_ok", worst <= max_host_rate)


def judge(measured: DataFrame, hosts: DataFrame, key: str) -> DataFrame:
    """Host verdicts joined back to documents; ``kept`` is the document's verdict.

    A host may have a third of all documents, so each verdict is repeated for
    SALTS parts of its documents, dealt by ``key``. Where the verdicts are small
    by the size of their table, Spark broadcasts them and shuffles no document.
    """
    part = F.pmod(F.xxhash64(key), F.lit(SALTS).cast("long"))
    parts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    back = hosts.select("host", "host_ok", "worst_rate", F.explode(parts).alias("part"))
    return (measured.withColumn("part", part).join(back, ["host", "part"], "left").drop("part")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_ok"), F.lit(True))))


def keep_good(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Texts are measured once for the host rates and once more for the filter,
    so that whole texts need not be shuffled by document.
    """
    measured = measure(docs)
    hosts = keep_table(host_verdicts(measured, max_host_rate), "hosts")
    return judge(measured, hosts, "doc.doc_id").where("kept").select("doc.*")
