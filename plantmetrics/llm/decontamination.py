"""Benchmark items in documents, also with other numbers, names and units.

Both sides are read as templates: numbers, units and names become typed placeholders (slots). Windows of the
templates are hashed and joined. A document holds an item if windows of at least half of the item are found in
one occurrence, and the slots are consistent there: each value of the item stands for one value of the occurrence
and the other way round. So a verbatim copy is found, and a question with its parameters exchanged as well, also
side by side. Windows of the words themselves are joined as well: they find verbatim copies in any case, also of
items that are little but slots, in lower or upper case, and behind any character.

Windows are made only where a document has a run of tokens that are all known to the benchmark, long enough for a
window: no other can match. Tables of bits of fixed size, made from the benchmark's tokens and windows, let tasks
pass over the rest; what remains is decided by the join.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm.arrow import begin_task, in_slices, map_columns, record_batch
from plantmetrics.llm.names import digests, unused
from plantmetrics.sources import stage

# Readings of a text: templates with first words as words or as names, and the words themselves, whose windows
# are told apart by another seed.
PLAIN, NAMED, EXACT = range(3)
WORDS_SEED = 1 << 32
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£°]|[.!?\n]+")
# Words for numbers, and units.
NUMBERS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = set(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ton tons "
    "ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
    "percent % $ € £ ° dollar dollars euro euros cent cents degree degrees".split()
)


@dataclass(frozen=True)
class LeakSettings:
    #: Tokens in a window. Items with fewer are one window by themselves.
    window: int = 8
    #: Items of fewer tokens are looked for word for word only: a template of few tokens fits too much.
    min_template: int = 5
    #: Tokens of a window that are no slots, at least, in percent.
    min_literal_percent: int = 60
    #: Windows of an item that a document must hold, in percent.
    min_percent: int = 50
    #: Tokens that an occurrence may have more or fewer than the item, up to any place in it.
    max_shift: int = 32
    #: Bits in each of the tables that spare documents' tokens and windows the work.
    bits: int = 1 << 22
    #: Spellings whose answer a task remembers.
    remembered: int = 200_000


def template(text: str | None) -> tuple[list[str], list[str | None]]:
    """(canonical tokens, value of the slot at each token or None). Case is kept out of both.

    A capitalised word is a name unless it begins the text, a sentence or a line. A unit is one after a number.
    """
    tokens, values, _, _ = _read(text)
    return tokens, values


def _is_number(word: str, low: str) -> bool:
    return word[0].isdigit() or low in NUMBERS


def _is_name(word: str) -> bool:
    return len(word) > 1 and word[0].isupper() and word[1:].islower()


def _read(text: str | list[str] | None, begins: bool = True, after_number: bool = False):
    """``template``, all words in lower case, and the places of capitalised words that begin something: these
    may be names or not.

    ``text`` may be a stretch of a text's ``TOKEN`` matches; then ``begins`` and ``after_number`` say whether a
    sentence begins there and whether the token before it is a number.
    """
    tokens, values, words, either = [], [], [], []
    for word in text if isinstance(text, list) else TOKEN.findall(text or ""):
        if word[0] in ".!?\n":
            begins = True
            continue
        low = word.lower()
        words.append(low)
        number = _is_number(word, low)
        if number:
            tokens.append("<number>")
            values.append(low)
        elif low in UNITS and (after_number or not low.isalpha()):
            tokens.append("<unit>")
            values.append(low)
        elif _is_name(word):
            if begins:
                either.append(len(tokens))
            tokens.append(low if begins else "<name>")
            values.append(None if begins else low)
        else:
            tokens.append(low)
            values.append(None)
        begins, after_number = False, number
    return tokens, values, words, either


#: What ``KnownTokens`` says of a match: no token of the benchmark, one, or the end of a sentence.
UNKNOWN, KNOWN, ENDS = range(3)


@dataclass(frozen=True)
class Stretch:
    """Matches of ``TOKEN`` that follow each other in a text: the place of the first token, the matches, whether a
    sentence begins there, and whether the token before is a number."""

    place: int
    matches: list[str]
    begins: bool = True
    after_number: bool = False


class KnownTokens(dict):
    """Spelling -> whether it can be a token of a benchmark window, in any reading: from a table of bits by token.

    The answer for a spelling doesn't depend on where it stands, so it may be yes where no reading has it.
    """

    def __init__(self, table: np.ndarray, remembered: int):
        self.table, self.bits, self.limit = table.tobytes(), len(table), remembered
        self.number, self.unit, self.name = map(self._has, ("<number>", "<unit>", "<name>"))

    def _has(self, token: str) -> bool:
        return self.table[xxhash.xxh3_64_intdigest(token) % self.bits] == 1

    def __missing__(self, word: str) -> int:
        head, low = word[0], word.lower()
        if head in ".!?\n":
            answer = ENDS
        elif self.table[xxhash.xxh3_64_intdigest(low) % self.bits]:
            answer = KNOWN
        elif (self.number and _is_number(word, low)) or (self.name and _is_name(word)) or (self.unit and low in UNITS):
            answer = KNOWN
        else:
            answer = UNKNOWN
        if len(self) >= self.limit:
            self.clear()
        self[word] = answer
        return answer

    def runs(self, text: str | None, least: int) -> Iterator[Stretch]:
        """The runs of at least ``least`` known tokens."""
        every = TOKEN.findall(text or "")
        answers = bytes(map(self.__getitem__, every))
        place = counted = 0
        for found in re.finditer(rb"\x01(?:\x02*\x01){%d,}" % (least - 1), answers):
            start, stop = found.span()
            place += start - counted - answers.count(ENDS, counted, start)
            counted = start
            before = start - 1
            while before >= 0 and answers[before] == ENDS:
                before -= 1
            number = before >= 0 and _is_number(every[before], every[before].lower())
            yield Stretch(place, every[start:stop], before < start - 1 or before < 0, number)


def windows(text: str | None, lengths, settings: LeakSettings) -> list[tuple[np.ndarray, np.ndarray, int, list, int]]:
    """``stretch_windows`` of a whole text."""
    return stretch_windows([Stretch(0, TOKEN.findall(text or ""))], lengths, settings)[0]


def stretch_windows(stretches: list[Stretch], lengths, settings: LeakSettings):
    """(windows, stretch of each token): the windows of stretches of texts, put one behind the other; none reaches
    from one into the next.

    Windows are (hashes, positions, length, slot values, kind of reading) for each of ``lengths`` and reading.
    Templates need enough literals, and are read with the first words of sentences as words and, where that makes
    a difference, as names. Windows of the words themselves, which have no slots, need none.
    """
    tokens, values, words, either, sizes = [], [], [], [], []
    for one in stretches:
        own = _read(one.matches, one.begins, one.after_number)
        either.extend(len(tokens) + k for k in own[3])
        for whole, part in zip((tokens, values, words), own):
            whole.extend(part)
        sizes.append(len(own[0]))
    of = np.repeat(np.arange(len(sizes)), sizes)
    digest = xxhash.xxh3_64_intdigest
    plain = np.fromiter(map(digest, tokens), np.uint64, len(tokens))
    named, names = plain, values
    if either:
        named, names = plain.copy(), list(values)
        named[either] = digest("<name>")
        for k in either:
            names[k] = words[k]
    exact = plain.copy()
    for k, value in enumerate(values):
        if value is not None:
            exact[k] = digest(words[k])
    found = []
    for length in lengths:
        count = len(tokens) - length + 1
        if count < 1:
            continue
        inside = of[:count] == of[length - 1 :]
        begun = np.zeros(len(tokens), bool)
        begun[either] = True
        differs = _count(begun, length) > 0
        for hashes, own, some, kind in ((plain, values, None, PLAIN), (named, names, differs, NAMED)):
            if some is None or some.any():
                literal = length - _count(np.array([value is not None for value in own]), length)
                good = inside & (100 * literal >= settings.min_literal_percent * length)
                good = np.flatnonzero(good if some is None else good & some)
                found.append((_rolled(hashes, length, length)[good], good, length, own, kind))
        good = np.flatnonzero(inside)
        found.append((_rolled(exact, length, length + WORDS_SEED)[good], good, length, [None] * len(tokens), EXACT))
    return found, of


def _rolled(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    count = len(hashes) - length + 1
    rolled = np.full(count, seed, np.uint64)
    for k in range(length):
        rolled = (rolled ^ hashes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    return rolled


def _count(flags: np.ndarray, length: int) -> np.ndarray:
    """How many flags each window of ``length`` has."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[length:] - total[:-length]


def benchmark_windows(benchmark: DataFrame, settings: LeakSettings) -> DataFrame:
    """``(window, item_id, exact, named, item_at, item_slots, length, n_windows)``: the windows of each item text as
    templates and, where ``exact``, word for word; ``n_windows`` are the places of that kind.

    Null ids and texts have no windows, items of fewer than ``min_template`` tokens only one of their words. Rows that
    share an id are read as one item with the windows of all.
    """
    kind = StructType.fromDDL(
        "window long, item_id long, exact boolean, named boolean, item_at int, item_slots array<string>, length int"
    )
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in kind]
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = min(settings.window, len(template(text)[0]))
                if key is None or not size:
                    continue
                for hashes, positions, length, values, reading in windows(text, [size], settings):
                    if size < settings.min_template and reading != EXACT:
                        continue
                    for window, at in zip(hashes.view(np.int64).tolist(), positions.tolist(), strict=True):
                        own = [value for value in values[at : at + length] if value is not None]
                        row = (window, key, reading == EXACT, reading == NAMED, at, own, length)
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
            yield record_batch(columns, arrow)

    found = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(read, kind)
    counts = found.groupBy("item_id", "exact").agg(F.countDistinct("item_at").alias("n_windows"))
    return found.join(counts, ["item_id", "exact"])


def held_percent(hits: list[tuple[int, int, list, list]], n_windows: int, settings: LeakSettings) -> float:
    """Percent of an item's windows that its best occurrence in a document holds with consistent slots.

    ``hits`` are (item_at, doc_at, item's slots, document's slots). An occurrence is what lies at one alignment
    doc_at - item_at, that with what lies up to ``max_shift`` beside it, each place used once, or the whole document.
    """
    by = defaultdict(list)
    for hit in hits:
        by[hit[1] - hit[0]].append(hit)
    order, best = sorted(by), _consistent(hits)
    for at in sorted(by, key=lambda one: (-len(by[one]), one)):
        if best >= n_windows:
            break
        beside = order[bisect_left(order, at - settings.max_shift) : bisect_right(order, at + settings.max_shift)]
        if len({hit[0] for one in beside for hit in by[one]}) <= best:
            continue
        near, ours, theirs = [], set(), set()
        for one in sorted(beside, key=lambda one: abs(one - at)):
            for hit in by[one]:
                if hit[0] not in ours and hit[1] not in theirs:
                    near.append(hit)
                    ours.add(hit[0])
                    theirs.add(hit[1])
        best = max(best, _consistent(by[at]), _consistent(near))
    return 100 * best / n_windows


def _consistent(hits) -> int:
    """The number of item windows without a value that stands for several others among these hits."""
    partners = defaultdict(set), defaultdict(set)
    for _, _, ours, theirs in hits:
        for one, other in zip(ours, theirs, strict=True):
            partners[0][one].add(other)
            partners[1][other].add(one)
    torn = [{one for one, others in table.items() if len(others) > 1} for table in partners]
    return len({hit[0] for hit in hits if torn[0].isdisjoint(hit[2]) and torn[1].isdisjoint(hit[3])})


def known_tokens(benchmark: DataFrame, settings: LeakSettings) -> np.ndarray:
    """The table of bits of all tokens of the benchmark: its words, templates, and the type <name> where a word may be one."""
    kind = StructType.fromDDL("bit long")
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                tokens, _, words, either = _read(text)
                found.update(tokens, words, ["<name>"] if either else [])
            yield record_batch([[xxhash.xxh3_64_intdigest(token) % settings.bits for token in found]], arrow)

    return _bits(benchmark.select("text").mapInArrow(read, kind).distinct(), settings)


def _bits(marked: DataFrame, settings: LeakSettings) -> np.ndarray:
    """A table of ``bits`` from the numbers in ``bit``: that many rows at most reach the driver."""
    table = np.zeros(settings.bits, bool)
    table[marked.toPandas()["bit"].to_numpy(np.int64)] = True
    return table


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """``(x, y, item_id, percent)``: documents (named by two digests of doc_id and text) that hold an item."""
    spark = docs.sparkSession
    items = stage(benchmark_windows(benchmark, settings), "benchmark-windows")
    lengths = sorted(row[0] for row in items.select("length").distinct().collect())  # window's lengths: few
    marked = items.select(F.pmod("window", F.lit(settings.bits)).alias("bit")).distinct()
    tables = (_bits(marked, settings), known_tokens(benchmark, settings))
    shared = spark.sparkContext.broadcast((*map(np.packbits, tables), lengths))
    kind = StructType.fromDDL("window long, x long, y long, doc_named boolean, doc_at int, doc_slots array<string>")
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        packed, tokens, sizes = shared.value
        table = np.unpackbits(packed).view(bool)
        known = KnownTokens(np.unpackbits(tokens).view(bool), settings.remembered)
        least = min(sizes, default=None)
        for batch in in_slices(batches):
            columns = [[] for _ in kind]
            xs, ys, texts = (c.to_pylist() for c in batch.columns)
            owners, stretches = [], []
            for k, text in enumerate(texts) if least else ():
                for run in known.runs(text, least):
                    owners.append(k)
                    stretches.append(run)
            every, of = stretch_windows(stretches, sizes, settings)
            first = np.searchsorted(of, np.arange(len(stretches)))
            for hashes, positions, length, values, reading in every:
                hashes = hashes.view(np.int64)
                for k in np.flatnonzero(table[hashes % settings.bits]):
                    at = int(positions[k])
                    run = int(of[at])
                    own = [value for value in values[at : at + length] if value is not None]
                    place = stretches[run].place + at - int(first[run])
                    row = (int(hashes[k]), xs[owners[run]], ys[owners[run]], reading == NAMED, place, own)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            yield record_batch(columns, arrow)

    x, y = digests("doc_id", "text")
    found = docs.select(x.alias("x"), y.alias("y"), "text").mapInArrow(read, kind)
    hit = F.struct("item_at", "doc_at", "item_slots", "doc_slots", (F.col("named") | F.col("doc_named")).alias("named"))
    # one row per pair and kind of window; rows of copies count once
    pairs = found.join(items, "window").groupBy("x", "y", "item_id", "exact")
    pairs = pairs.agg(F.collect_set(hit).alias("hits"), F.first("n_windows").alias("n_windows"))
    found_at = F.size(F.array_distinct("hits.item_at"))
    pairs = pairs.where(found_at * 100 >= F.col("n_windows") * settings.min_percent)

    def judge(xs, ys, item_ids, all_hits, counts):
        percent = []
        for hits, n in zip(all_hits, counts, strict=True):
            every = [tuple(hit.values())[:4] for hit in hits]
            # a first word read as a name may be none, and then tears names that are
            plain = [one for one, hit in zip(every, hits, strict=True) if not hit["named"]]
            percent.append(max(held_percent(one, n, settings) for one in (every, plain)))
        return xs, ys, item_ids, percent

    judged = map_columns(pairs.drop("exact"), judge, "x long, y long, item_id long, percent double")
    return judged.where(F.col("percent") >= settings.min_percent).groupBy("x", "y", "item_id").agg(F.max("percent").alias("percent"))


def mark_leaks(
    docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings(), name: str = "_leaked_items"
) -> DataFrame:
    """``docs`` plus ``name`` (sorted item ids, empty if clean).

    A null or empty text is clean. Repeated rows are one document and are marked alike. An empty benchmark
    leaves all documents clean; empty documents give an empty result; other columns pass through, whatever their
    names, except that a column named ``name`` is replaced.
    """
    leaks = find_leaks(docs, benchmark, settings).groupBy("x", "y").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    x, y, own_x, own_y, items = unused(docs, "_x", "_y", "_own_x", "_own_y", "_items")
    leaks = stage(leaks.toDF(x, y, items), "leaks")
    named = docs.withColumns(dict(zip((own_x, own_y), digests("doc_id", "text"))))
    named = named.join(leaks, (F.col(own_x) == F.col(x)) & (F.col(own_y) == F.col(y)), "left")
    found = F.coalesce(F.col(items), F.array().cast("array<bigint>"))
    return named.withColumn(name, found).drop(x, y, own_x, own_y, items)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """The documents that hold no item; rows as they are."""
    (name,) = unused(docs, "_leaked_items")
    return mark_leaks(docs, benchmark, settings, name).where(F.size(name) == 0).select(*docs.columns)
