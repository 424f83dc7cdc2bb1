"""Quality rules judged twice: on each document, and on the host it came from.

Every document is measured inside its own row, with array functions and no shuffle of texts. Rule failures are
then summed per host. A host's failure rate is shrunk towards the corpus with a beta prior whose mean and
strength are fitted to all hosts by the method of moments: small hosts lean on the prior, large ones on their
own record. Hosts whose shrunk rate exceeds ``HOST_LIMIT`` are rejected with all their documents.

Only DataFrame functions are used. Defined results: a null text has no words and fails; a null host is a host
like any other; an empty table gives an empty result. Repeated rows count as often as they occur. All
other columns of the input are kept by ``kept_documents`` and ignored by ``host_verdicts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import free_names, staged

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20  # of the words, in five-word windows found more than once
MAX_SYMBOL_PERCENT = 10  # symbols of the word characters
MAX_DUP_LINE_PERCENT = 30  # lines equal to an earlier one, of the lines with a word
HOST_LIMIT = 0.5
STRENGTH = (1.0, 1000.0)  # bounds of the prior's weight, in documents

WINDOW = 5
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _windows(hashes: Column) -> Column:
    def window(start: Column) -> Column:
        return F.xxhash64(*[hashes[start + k] for k in range(WINDOW)])

    some = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), window)
    return F.when(F.size(hashes) >= WINDOW, some).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words in windows that occur more than once: repeated windows by sorting, then the union of their ranges."""
    pairs = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        def twice(e: Column, k: Column) -> Column:
            before = F.when(k > 0, s[F.greatest(k - 1, F.lit(0))]["x"] == e["x"]).otherwise(F.lit(False))
            after = F.when(k < F.size(s) - 1, s[F.least(k + 1, F.size(s) - 1)]["x"] == e["x"]).otherwise(F.lit(False))
            return before | after

        return F.array_sort(F.transform(F.filter(s, twice), lambda e: e["i"]))

    def union(p: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(p) - 1)
        return F.aggregate(steps, F.lit(WINDOW), lambda total, k: total + F.least(F.lit(WINDOW), p[k] - p[k - 1]))

    return _let(_let(pairs, repeated), union)


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """One narrow row per document: (doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACES))
    no_words = F.array().cast("array<string>")
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(no_words)
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(_SPACES))) > 0)
    rows = docs.select("doc_id", F.col(host).alias("host"), F.xxhash64("text").alias("text_key"), text.alias("text"), words.alias("words"), lines.alias("lines"))
    windows = _let(F.transform("words", lambda w: F.xxhash64(w)), _windows)
    repeats = _let(windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(g)))

    def length_without(characters: str) -> Column:
        return F.length(F.translate("text", characters, ""))

    return rows.select(
        "doc_id", "host", "text_key",
        F.size("words").cast("long").alias("n_words"),
        length_without(_SPACES).cast("long").alias("word_chars"),
        (F.length("text") - length_without(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        repeats.cast("long").alias("n_repeat_words"),
    )


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _any_failed() -> Column:
    return (
        F.col("base_failed")
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"))
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """(host, documents, failures, shrunk_rate) from rows (host, failed)."""
    hosts = judged.groupBy("host").agg(F.count("*").alias("documents"), F.sum(F.col("failed").cast("long")).alias("failures"))
    hosts = staged(hosts, "hosts")
    n, f = F.sum("documents"), F.sum("failures")
    squares = F.sum(F.col("failures") * F.col("failures") / F.col("documents"))
    prior = hosts.agg(n.alias("n"), f.alias("f"), squares.alias("squares"), F.count("*").alias("hosts")).first()
    mean, strength = 0.0, STRENGTH[1]
    if prior.n:
        mean = prior.f / prior.n
        spread = mean * (1 - mean)
        # variance between hosts, less what sampling alone would show
        between = prior.squares / prior.n - mean * mean - spread * prior.hosts / prior.n
        if between > 0:
            strength = min(max(spread / between - 1, STRENGTH[0]), STRENGTH[1])
    shrunk = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return hosts.select("host", "documents", "failures", shrunk.alias("shrunk_rate"))


def host_verdicts(docs: DataFrame, host: str = "source") -> DataFrame:
    """The measures of every document with base_failed and kept: false if it failed itself or its host is rejected."""
    rows = measured(docs, host).withColumn("base_failed", _base_failed()).withColumn("failed", _any_failed())
    rows = staged(rows, "measured")
    rejected = host_rates(rows).where(F.col("shrunk_rate") > HOST_LIMIT).select(F.col("host").alias("bad_host"), F.lit(True).alias("bad"))
    joined = rows.join(rejected, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("bad").isNull()).drop("bad", "bad_host", "failed")


def kept_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept."""
    dropped_id, dropped_key = free_names(docs, "dropped_id", "dropped_key")
    dropped = host_verdicts(docs, host).where(~F.col("kept")).select(F.col("doc_id").alias(dropped_id), F.col("text_key").alias(dropped_key))
    same = F.col("doc_id").eqNullSafe(F.col(dropped_id)) & (F.xxhash64("text") == F.col(dropped_key))
    return docs.join(dropped, same, "left_anti")
