"""Quality rules with line frequencies across documents, in DataFrame functions only.

A line that many documents of one host share is boilerplate: it is taken out, and a document that then has
too little left is rejected. The rules on the text itself (length, repeated word windows) come first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.sources import stage

SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 10
    window: int = 5
    #: Rejected if repeated windows cover more than this percentage of the words.
    max_repeat_percent: int = 20
    #: A line is boilerplate on a host if more documents than this hold it, ...
    max_line_docs: int = 20
    #: ... and more than this percentage of the host's documents.
    max_line_percent: float = 1.0
    #: Rejected if fewer than this percentage of its words are left without boilerplate lines.
    min_left_percent: int = 50


def _spaced(text: Column) -> Column:
    """The words with one space between them."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def _count_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))


def text_counts(rows: DataFrame, rules: LineRules) -> DataFrame:
    """``rows`` with the counts of each text in the place of ``text`` (which is not null).

    Every array that a lambda looks things up in is a column of its own, so it is computed once. Windows are
    hashed where they stand. Only texts with fewer distinct windows than windows go on: there, windows are
    sorted by hash, neighbours with equal hashes are the repeated ones, and their positions, sorted again,
    tell how many words they cover together.
    """
    span = rules.window
    others = [name for name in rows.columns if name != "text"]
    counts = {
        "n_words": F.when(F.col("spaced") == "", 0).otherwise(_count_spaces(F.col("spaced")) + 1),
        "word_chars": F.length("spaced") - _count_spaces(F.col("spaced")),
        "n_symbols": F.length("text") - F.length(F.translate("text", SYMBOLS, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
    }
    rows = rows.withColumns({"spaced": _spaced(F.col("text")), "lines": _lines_with_words(F.col("text"))})
    rows = rows.select(
        *others, *(c.cast("long").alias(name) for name, c in counts.items()), F.split("spaced", " ").alias("words")
    )
    following = ", ".join(f"get(words, k + {ahead})" for ahead in range(1, span))
    windows = f"slice(transform(words, (word, k) -> xxhash64(word, {following})), 1, greatest(size(words) - {span - 1}, 0))"
    rows = rows.select(*others, *counts, F.expr(windows).alias("windows"))
    ordered = F.sort_array(F.transform("windows", lambda w, k: F.struct(w.alias("w"), k.alias("k"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.select(*others, *counts, F.when(repeats, ordered).alias("ordered"))
    again = "x.w = get(ordered, i - 1).w OR x.w = get(ordered, i + 1).w"
    rows = rows.withColumn("at", F.expr(f"array_sort(transform(filter(ordered, (x, i) -> {again}), x -> x.k))"))
    covered = (
        f"aggregate(at, named_struct('n', 0L, 'last', {-span}),"
        f" (seen, k) -> named_struct('n', seen.n + least({span}, k - seen.last), 'last', k), seen -> seen.n)"
    )
    return rows.select(*others, *counts, F.coalesce(F.expr(covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def _lines(rows: DataFrame) -> DataFrame:
    """``rows`` with an array ``lines`` of (hash of host and normalised line, words) in the place of ``text``."""

    def hashed(line: Column) -> Column:
        spaced = F.lower(_spaced(line))
        return F.struct(
            F.xxhash64("host", spaced).alias("line"), (_count_spaces(spaced) + 1).cast("long").alias("words")
        )

    lines = F.transform(_lines_with_words(F.col("text")), hashed)
    return rows.select(*(c for c in rows.columns if c != "text"), lines.alias("lines"))


def boilerplate_lines(rows: DataFrame, rules: LineRules) -> DataFrame:
    """``line``: hashes of the lines that too many documents of a host share."""
    per_host = rows.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    lines = _lines(rows.select("host", "text"))
    return (
        lines.select("host", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > rules.max_line_docs)
        .join(per_host.withColumnRenamed("host", "other"), F.col("host").eqNullSafe(F.col("other")))
        .where(F.col("n") * 100 > F.col("documents") * rules.max_line_percent)
        .select("line")
        .distinct()
    )


def apply_line_rules(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``n_left`` (words outside boilerplate lines), ``kept``.

    A null text counts as empty and fails for its length. Documents without a host form one host. Every row
    counts as a document in line frequencies and gives a row, repeated rows too. Other columns are ignored; an
    empty table gives an empty result. A line counts once per document, and all its occurrences go. Line
    frequencies are combined before the shuffle, so a hot host or line costs no task more than others; the
    texts are never shuffled.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # equal rows share a name of 96 bits, and nothing else does
    name = {"x": F.xxhash64("doc_id", "host", "text"), "y": F.hash("text", "doc_id", "host")}
    named = rows.withColumns(name)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = (
        text_counts(named.drop("host"), rules)
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("doc_id", *counts)))
    )
    common = stage(boilerplate_lines(rows, rules), "boilerplate")
    gone = (
        _lines(named)
        .select("x", "y", F.inline("lines"))
        .join(common, "line")
        .groupBy("x", "y")
        .agg(F.sum("words").alias("all_gone"))
    )
    left = F.col("n_words") - F.coalesce(F.col("all_gone") / F.col("copies"), F.lit(0)).cast("long")
    base_failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    depleted = (F.col("n_left") < rules.min_words) | (F.col("n_left") * 100 < F.col("n_words") * rules.min_left_percent)
    return (
        counted.join(gone, ["x", "y"], "left")
        .select("doc_id", *counts, base_failed.alias("base_failed"), left.alias("n_left"), "copies")
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .drop("copies", "copy")
    )
