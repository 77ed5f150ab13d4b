"""Removing passages that repeat anywhere in the corpus, by spans of consecutive sentences.

The shortest run of sentences with at least ``min_words`` words is hashed, from each sentence on and up to each
sentence; so runs within a passage of so many words cover all of it. A passage that two documents share holds the
same runs in both, whatever stands around it. Runs meet in one global join; every run but the first of its kind
marks its sentences, and marked sentences are cut out. Sentences that are long count as several, parted at commas
and semicolons. What stays of a shared passage are its parts of sentences at either end, and stretches between
sentence ends of less than ``min_words`` words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm.arrow import begin_task, in_slices, record_batch
from plantmetrics.llm.names import unused
from plantmetrics.sources import stage

END = re.compile(r"[.!?…。]+[\"'”’)\]]*\s+|\s*\n\s*")
PART = re.compile(r"[,;][\"'”’)\]]*\s+")
#: Words beyond which a sentence is parted.
LONG = 16


@dataclass(frozen=True)
class SpanSettings:
    min_sentences: int = 2
    min_words: int = 16
    #: A sentence of so many words is a run by itself.
    long_sentence: int = 16


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, stop) of each sentence, with the white space after it; together they are the whole text.

    A sentence ends with a full stop, question or exclamation mark before white space, or with its line; one of
    more than ``LONG`` words also with each comma and semicolon before white space.
    """
    cuts = [0, *(found.end() for found in END.finditer(text)), len(text)]
    found = []
    for a, b in zip(cuts, cuts[1:]):
        parts = [a, b]
        if b - a > 2 * LONG and len(text[a:b].split()) > LONG:
            parts[1:1] = (part.end() for part in PART.finditer(text, a, b))
        found += [(x, y) for x, y in zip(parts, parts[1:]) if x < y]
    return found


def runs(text: str, settings: SpanSettings) -> list[tuple[bytes, int, int]]:
    """(hash, first sentence, one past the last) of each run; words are compared in lower case."""
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    joined = [" ".join(one) for one in words]
    total = [0, *accumulate(map(len, words))]
    spans = set()
    stop = start = 0
    for begin in range(len(words)):  # the shortest from each sentence on
        while stop < len(words) and not _enough(stop - begin, total[stop] - total[begin], settings):
            stop += 1
        if _enough(stop - begin, total[stop] - total[begin], settings):
            spans.add((begin, stop))
    for end in range(1, len(words) + 1):  # the shortest up to each sentence
        while _enough(end - start - 1, total[end] - total[start + 1], settings):
            start += 1
        if _enough(end - start, total[end] - total[start], settings):
            spans.add((start, end))
    return [(xxhash.xxh3_128_digest(" ".join(filter(None, joined[a:b])).encode()), a, b) for a, b in sorted(spans)]


def _enough(size: int, words: int, settings: SpanSettings) -> bool:
    return size > 0 and words >= (settings.min_words if size >= settings.min_sentences else settings.long_sentence)


def repeated_spans(docs: DataFrame, settings: SpanSettings = SpanSettings()) -> DataFrame:
    """``(name, at, start, stop)``: the runs of a document (named by a hash of doc_id and text, and by its place
    ``at`` in the order of documents) that another occurrence comes before.

    Occurrences are ordered by doc_id, null ids last, then by place in the text. Rows that share a doc_id
    count as one document in this order, so runs at the same place of two such rows are both first.
    """
    kind = StructType.fromDDL("run binary, name long, doc_id long, start int, stop int")
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in in_slices(batches):
            columns = [[], [], [], [], []]
            for name, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for run, start, stop in runs(text or "", settings):
                    for column, value in zip(columns, (run, name, doc_id, start, stop), strict=True):
                        column.append(value)
            yield record_batch(columns, arrow)

    spans = docs.select(_name(docs).alias("name"), F.col("doc_id").cast("long"), "text").mapInArrow(read, kind)
    place = (_at(F.col("doc_id")) + F.col("start")).cast("decimal(38,0)")
    spans = spans.select("run", "name", place.alias("place"), "start", "stop")
    first = spans.groupBy("run").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times"))
    first = stage(first.where("times > 1").select("run", "first"), "repeated-runs")
    at = (F.col("place") - F.col("start")).cast("decimal(38,0)").alias("at")
    return spans.join(first, "run").where("place > first").select("name", at, "start", "stop")


def _name(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def _at(doc_id: Column) -> Column:
    """Where a document's sentences begin in the order of all: by doc_id, null ids last."""
    last = F.lit(2**63 - 1).cast("long")
    step = F.lit(2**32).cast("decimal(11,0)")
    return (F.coalesce(doc_id.cast("long"), last).cast("decimal(20,0)") * step).cast("decimal(38,0)")


def remove_repeated_spans(
    docs: DataFrame, settings: SpanSettings = SpanSettings(), n_removed: str = "_n_removed"
) -> DataFrame:
    """``docs`` with repeated sentences cut out of ``text``, and ``n_removed``, the number of them.

    A null or empty text stays as it is. A document may be left with an empty text; no row is dropped.
    Repeated rows are one document and are treated alike. Other columns pass through, whatever their names, but
    for one named ``n_removed``, which is replaced; a column ``n_chars`` is counted anew where something was
    cut. An empty table gives an empty result. What a document's marks take is bounded by its own sentences.
    """
    marks = repeated_spans(docs, settings).groupBy("name", "at").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    name, at, own, own_at, spans, done = unused(docs, "_name", "_at", "_own", "_own_at", "_marks", "_cut")
    same = (F.col(own) == F.col(name)) & (F.col(own_at) == F.col(at))
    named = docs.withColumns({own: _name(docs), own_at: _at(F.col("doc_id"))})
    marked = named.join(marks.toDF(name, at, spans), same, "left")
    kind = StructType.fromDDL("text string, n int")

    from pyspark.sql.functions import pandas_udf

    @pandas_udf(kind)
    def cut(text, marks):
        import pandas as pd

        texts, counts = [], []
        for one, spans in zip(text, marks, strict=True):
            if one is None or spans is None:
                texts.append(one)
                counts.append(0)
                continue
            gone = {k for span in spans for k in range(span["start"], span["stop"])}
            kept = [one[a:b] for k, (a, b) in enumerate(sentences(one)) if k not in gone]
            texts.append("".join(kept).rstrip() if gone else one)
            counts.append(len(gone))
        return pd.DataFrame({"text": texts, "n": counts})

    result = marked.withColumn(done, cut("text", spans))
    columns = {"text": F.col(f"{done}.text"), n_removed: F.col(f"{done}.n")}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        counted = F.when(F.col(f"{done}.n") > 0, F.length(f"{done}.text").cast(kind)).otherwise(F.col("n_chars"))
        columns["n_chars"] = counted
    return result.select(
        *(columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns if c != n_removed),
        columns[n_removed].alias(n_removed),
    )
