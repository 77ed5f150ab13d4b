"""Exact set-similarity join on word n-grams, with work skipped by how the sets relate.

* Equal sets are one class and share one answer.
* Every class is indexed under its rarest shingles only (prefix filter): two sets that link share one.
* The list of a shingle is kept in the order (set size, position of the shingle in the set's prefix) and cut
  into blocks. A probe skips whole blocks whose sizes or positions rule out enough overlap.
* Answers are derived from a similar set's answers: the first set of a list becomes a leader, sets that pass
  the filters with it are its members and are compared with it alone, not with one another. Two members
  whose links with the leader hold are connected through it. Only where such a link proves false (an orphan)
  is the orphan held against the leader's other members, by their parities and within a task.
* Every candidate pair is decided on the whole sets.

Lists longer than ``max_list`` are cut into a grid of smaller lists that together meet every pair. Shingles
are 64-bit hashes; classes are named by a 128-bit digest of the whole set.
"""

from __future__ import annotations

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
from plantmetrics.llm.components import connected_components
from plantmetrics.sources import stage

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BYTE_ONES = np.array([bin(value).count("1") for value in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class JoinSettings:
    """``percent``: two sets link if 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80
    #: Counters (a power of two) in the table of approximate shingle frequencies that orders prefixes. The
    #: table has this many integers at any size of input; it decides how much work is skipped, not the result.
    counters: int = 1 << 18
    #: Rows of one shingle's list that a task takes together.
    max_list: int = 20_000
    #: Lists up to this length are compared pair by pair, longer ones by blocks and leaders.
    short_list: int = 8
    #: Of the 64 parities of a sketch, how many may differ between a leader and a member. Unrelated sets
    #: differ in 32; a pair that is not taken for leader and member is a candidate itself, so this decides
    #: only how much work is skipped.
    alike_bits: int = 18
    #: Rows in a block of a list.
    block: int = 128
    #: Bits in the table that spares documents outside all candidate pairs the last pass.
    bits: int = 1 << 22


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * M1
    values = (values ^ (values >> np.uint64(27))) * M2
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles; of all words as one if there are fewer."""
    found = (text or "").encode().lower().split()  # on bytes both know ASCII only
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    span = min(words, len(hashes))
    rolled = np.full(len(hashes) - span + 1, span, np.uint64)
    for k in range(span):
        rolled = _mix(rolled + hashes[k : len(hashes) - span + 1 + k])
    return np.unique(rolled)


def _digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of how many shingles fall on each of ``bits`` bits, as integers: two of them differ in no more
    bits than the sets differ in shingles."""
    counts = np.bincount((shingles >> np.uint64(16)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


def _parity_bits(size: int) -> int:
    """A power of two, at least 512 and the set's size: unrelated sets then differ in near half of the bits."""
    return max(512, 1 << (size - 1).bit_length()) if size else 512


def _level(sizes):
    """How often a set of this size is halved for its sketch: to 64 to 128 shingles."""
    return np.maximum(np.frexp(np.asarray(sizes, np.float64))[1] - 7, 0)


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """64 parities of a part of the set that is chosen by hash."""
    level = int(_level(len(shingles)))
    return _parity(shingles[(shingles >> np.uint64(40)) & np.uint64((1 << level) - 1) == 0], 64)


def _counter(shingles: np.ndarray, counters: int) -> np.ndarray:
    return (shingles & np.uint64(counters - 1)).astype(np.int64)


def _scan(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """One pass over the texts: a row per document, and a row per counter and task."""
    kind = StructType.fromDDL("doc_id long, n_shingles long, class binary, parity array<long>, counter int, n long")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        counts = np.zeros(settings.counters, np.int64)
        for batch in in_slices(batches):
            ids, texts = (column.to_pylist() for column in batch.columns)
            sets = [shingle_set(text, settings.words) for text in texts]
            if sets:
                counts += np.bincount(_counter(np.concatenate(sets), settings.counters), minlength=settings.counters)
            none = [None] * len(ids)
            parity = [_parity(one, _parity_bits(len(one))) for one in sets]
            yield record_batch([ids, list(map(len, sets)), list(map(_digest, sets)), parity, none, none], arrow)
        seen = np.flatnonzero(counts)
        none = [None] * len(seen)
        yield record_batch([none, none, none, none, seen.tolist(), counts[seen].tolist()], arrow)

    return docs.mapInArrow(run, kind)


def _frequencies(scanned: DataFrame, settings: JoinSettings) -> np.ndarray:
    """The counters over all documents: ``settings.counters`` integers, however large the input."""
    summed = scanned.where("counter IS NOT NULL").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(settings.counters, np.int64)
    table[summed["counter"].to_numpy()] = summed["n"].to_numpy()
    return table


def _prefixes(docs: DataFrame, frequencies, settings: JoinSettings, heavy_only: bool) -> DataFrame:
    """``(token, place, parity, sketch, class)`` for the shingles in the prefix of each set, rarest first.

    ``place`` is the set's size and the position, in one integer that sorts by both. Copies of a set that a
    task meets again are left out. ``heavy_only`` keeps tokens that may be in more than ``max_list`` sets.
    """
    kind = StructType.fromDDL("token long, place long, parity long, sketch long, class binary")
    arrow = to_arrow_schema(kind)
    percent, words, counters, most = settings.percent, settings.words, settings.counters, settings.max_list

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        table, met = frequencies.value, set()
        for batch in in_slices(batches):
            tokens, places, parities, sketches, classes = [], [], [], [], []
            for text in batch.column(0).to_pylist():
                shingles = shingle_set(text, words)
                name = _digest(shingles)
                if name is None or name in met:
                    continue
                met.add(name)
                size = len(shingles)
                length = size - (size * percent + 99) // 100 + 1
                counts = table[_counter(shingles, counters)]
                first = np.lexsort((shingles, counts))[:length]
                position = np.arange(length, dtype=np.int64)
                if heavy_only:
                    heavy = counts[first] > most
                    first, position = first[heavy], position[heavy]
                tokens.append(shingles[first].view(np.int64))
                places.append((size << 32) + position)
                parities.append(np.full(len(first), _parity(shingles, 64)[0]))
                sketches.append(np.full(len(first), _sketch(shingles)[0]))
                classes.extend([name] * len(first))
            if classes:
                numbers = map(np.concatenate, (tokens, places, parities, sketches))
                yield record_batch([*map(pa.array, numbers), classes], arrow)

    return docs.select("text").mapInArrow(run, kind)


def _gap(size_a, size_b, percent: int):
    """By how many shingles sets of these sizes may differ and still link."""
    return (size_a + size_b) * (100 - percent) // (100 + percent)


def _differing(parity_a: np.ndarray, parity_b) -> np.ndarray:
    return BYTE_ONES[(parity_a ^ parity_b).view(np.uint8).reshape(-1, 8)].sum(axis=1)


def _may_link(size, position, other_size, other_position, percent: int):
    """Size filter (``other_size`` is not the smaller) and position filter: whether the sets may still
    overlap enough if this shingle is the first that they share."""
    most = np.minimum(size - position, other_size - other_position)
    return (100 * size >= percent * other_size) & ((100 + percent) * most >= percent * (size + other_size))


class _List:
    """One shingle's list in the order (size, position), cut into blocks."""

    def __init__(self, places: np.ndarray, parities: np.ndarray, sketches: np.ndarray, settings: JoinSettings):
        self.sketch, self.level, self.alike = sketches, _level(places >> 32), settings.alike_bits
        self.size, self.position, self.parity, self.percent = places >> 32, places & 0xFFFFFFFF, parities, settings.percent
        self.starts = np.arange(0, len(places), settings.block)
        self.least_size, self.most_size = self.size[self.starts], np.maximum.reduceat(self.size, self.starts)
        self.least_position = np.minimum.reduceat(self.position, self.starts)
        self.step, self.scans = settings.block, 0

    def near(self, rows: np.ndarray, among: np.ndarray, slack: int = 0) -> np.ndarray:
        """Rows behind the first of ``rows`` that may pass all filters with one of these, judged by the first one's
        parities with ``slack`` bits more; ``among`` marks those still asked for. One scan of the blocks.

        Skipped are blocks with sizes too far above, or positions too far back whatever the size.
        """
        self.scans += 1
        first, size = rows[0], self.size[rows]
        least, most, ahead = size.min(), size.max(), (size - self.position[rows]).max()
        open_ = (self.starts + self.step > first + 1) & (100 * most >= self.percent * self.least_size)
        shared = np.minimum(ahead, self.most_size - self.least_position)
        open_ &= (100 + self.percent) * shared >= self.percent * (least + self.least_size)
        found = []
        for start in self.starts[open_]:
            others = np.arange(max(start, first + 1), min(start + self.step, len(self.size)))
            others = others[among[others]]
            ahead_of = np.minimum(ahead, self.size[others] - self.position[others])
            fits = (100 + self.percent) * ahead_of >= self.percent * (least + self.size[others])
            others = others[fits & (100 * most >= self.percent * self.size[others])]
            apart = _differing(self.parity[others], self.parity[first])
            found.append(others[apart <= _gap(most, self.size[others], self.percent) + slack])
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def partners(self, row: int, answers: np.ndarray) -> np.ndarray:
        """Those of ``answers`` behind ``row`` that pass all filters with it."""
        others = answers[answers > row]
        others = others[_may_link(self.size[row], self.position[row], self.size[others], self.position[others], self.percent)]
        apart = _differing(self.parity[others], self.parity[row])
        return others[apart <= _gap(self.size[row], self.size[others], self.percent)]

    def pairs(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(row, partners, whether the row is their leader): every pair that passes the filters is there, or
        both of the pair are members of one leader. Members are rows that look much like their leader.

        Members don't scan the list again: parities obey the triangle inequality, so whatever is near a member is
        among what its leader's scan finds with as many bits more as the member differs from it in.
        """
        free, leader_of = np.ones(len(self.size), bool), np.full(len(self.size), -1)
        groups: list[np.ndarray] = []
        for row in range(len(self.size)):
            if free[row]:
                members = self.partners(row, self.near(np.array([row]), free))
                members = members[self.level[members] == self.level[row]]
                members = members[_differing(self.sketch[members], self.sketch[row]) <= self.alike]
                free[members] = free[row] = False
                leader_of[members] = leader_of[row] = row
                groups.append(np.concatenate([[row], members]))
                if len(members):
                    yield row, members, True
        for group in groups:
            slack = int(_differing(self.parity[group], self.parity[group[0]]).max())
            answers = self.near(group, leader_of != group[0], slack)
            for row in group if len(answers) else ():
                others = self.partners(row, answers)
                if len(others):
                    yield row, others, False


def _candidates(entries: DataFrame, settings: JoinSettings) -> DataFrame:
    """``(a, b, leads)`` from all lists; ``entries`` come sorted by (token, cell, place, class) in each task."""
    kind = StructType.fromDDL("a binary, b binary, leads boolean")
    arrow = to_arrow_schema(kind)
    percent, short = settings.percent, settings.short_list

    def lists(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, cell, place, parity, sketch = (table.column(k).to_numpy() for k in range(5))
        classes = table.column(5).combine_chunks().cast(pa.binary(16))
        words = np.frombuffer(classes.buffers()[1], np.int64).reshape(-1, 2)[classes.offset : classes.offset + len(classes)]
        new_list = np.concatenate([[True], (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])])
        copy = np.concatenate([[False], (words[1:] == words[:-1]).all(axis=1)]) & ~new_list
        kept = np.flatnonzero(~copy)  # a list begins with its first copy, so no list is lost
        place, parity, sketch, starts = place[kept], parity[kept], sketch[kept], np.flatnonzero(new_list[kept])
        sizes = np.diff(np.append(starts, len(kept)))
        list_of, size, position = np.repeat(np.arange(len(starts)), sizes), place >> 32, place & 0xFFFFFFFF

        def batch(first, second, leads):
            names = (classes.take(pa.array(kept[rows])).cast(pa.binary()) for rows in (first, second))
            return record_batch([*names, pa.array(leads)], arrow)

        for apart in range(1, short):  # all pairs of all short lists, one distance at a time
            rows = np.flatnonzero((sizes[list_of[:-apart]] <= short) & (list_of[apart:] == list_of[:-apart]))
            other = rows + apart
            good = _may_link(size[rows], position[rows], size[other], position[other], percent)
            rows, other = rows[good], other[good]
            good = _differing(parity[rows], parity[other]) <= _gap(size[rows], size[other], percent)
            if good.any():
                yield batch(rows[good], other[good], np.zeros(good.sum(), bool))
        for k in np.flatnonzero(sizes > short):
            own, found, waiting = slice(starts[k], starts[k] + sizes[k]), [], 0
            for row, partners, leading in _List(place[own], parity[own], sketch[own], settings).pairs():
                found.append((np.full(len(partners), row), partners, np.full(len(partners), leading)))
                waiting += len(partners)
                if waiting > 50_000:
                    first, second, leads = map(np.concatenate, zip(*found, strict=True))
                    yield batch(starts[k] + first, starts[k] + second, leads)
                    found, waiting = [], 0
            if found:
                first, second, leads = map(np.concatenate, zip(*found, strict=True))
                yield batch(starts[k] + first, starts[k] + second, leads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches):
            yield from lists(table)

    return entries.select("token", "cell", "place", "parity", "sketch", "class").mapInArrow(run, kind)


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``batches``, which begin with (token, cell) and come sorted by them, with no list cut apart."""
    rest = None  # rows of the list that goes on in the next batch; a cell's rows are bounded
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        token, cell = table.column(0).to_numpy(), table.column(1).to_numpy()
        tail = np.flatnonzero((token != token[-1]) | (cell != cell[-1]))
        cut = int(tail[-1]) + 1 if len(tail) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None:
        yield rest


def _split_lists(entries: DataFrame, heavy: DataFrame, settings: JoinSettings) -> DataFrame:
    """``entries`` with a cell: 0, or for long lists one row per cell of a triangular grid of blocks. ``heavy``
    holds the entries of all lists that may be long."""
    long_lists = stage(
        heavy.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > settings.max_list)
        .select("token", F.ceil(F.col("n") * 2 / settings.max_list).alias("blocks")),
        "long-lists",
    )
    kept = [name for name in entries.columns if name != "token"]
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    other = F.expr("explode(sequence(0L, coalesce(blocks, 1L) - 1L))")
    return (
        entries.join(long_lists, "token", "left")
        .select("token", *kept, "blocks", F.coalesce(block, F.lit(0)).alias("block"), other.alias("other"))
        .withColumn(
            "cell",
            F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(
                F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
            ),
        )
        .select("token", F.col("cell").cast("long"), *kept)
    )


def _verify(pairs: DataFrame, sets: DataFrame, settings: JoinSettings) -> DataFrame:
    """``pairs`` (a, b, ...) with ``linked``, decided on the whole sets."""
    percent = settings.percent

    def work(a, b, set_a, set_b):
        linked = []
        for one, other in zip(set_a, set_b, strict=True):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return a, b, linked

    pairs = pairs.select("a", "b")
    # a small table of names is sent to the sets; a large one meets them in a shuffle like the pairs themselves
    names = stage(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "names")
    sets = sets.join(names, "class", "left_semi")
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    return map_columns(
        pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"),
        work,
        "a binary, b binary, linked boolean",
    )


def _near(pairs: DataFrame, classes: DataFrame, settings: JoinSettings) -> DataFrame:
    """Pairs whose whole parities leave a link possible, with ``apart``, the bits they differ in."""

    def side(name):
        return classes.select(
            F.col("class").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("parity").alias(f"parity_{name}")
        )

    def folded(name, other):  # a parity of twice the bits is brought to the other's; the halves' parities add up
        half = f"cast(size({name}) / 2 AS int)"
        halves = f"zip_with(slice({name}, 1, {half}), slice({name}, {half} + 1, {half}), (x, y) -> x ^ y)"
        return f"CASE WHEN size({name}) > size({other}) THEN {halves} ELSE {name} END"

    both = f"{folded('parity_a', 'parity_b')}, {folded('parity_b', 'parity_a')}"
    # lengths further apart than twofold say nothing: their sum is null
    apart = f"coalesce(aggregate(zip_with({both}, (x, y) -> bit_count(x ^ y)), 0, (total, x) -> total + x), 0)"
    most = f"floor((n_a + n_b) * {100 - settings.percent} / {100 + settings.percent})"
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(f"100 * least(n_a, n_b) >= {settings.percent} * greatest(n_a, n_b)")
        .withColumn("apart", F.expr(apart))
        .where(f"apart <= {most}")
        .select(*pairs.columns, "apart")
    )


def _needed_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, settings: JoinSettings) -> DataFrame:
    """``(class, shingles)`` of the classes in ``pairs``, made anew from one document of each.

    A table of bits, of fixed size, lets tasks pass over documents that no class is made from, so that
    neither their texts nor their sets are shuffled; the join decides.
    """
    names = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = stage(classes.join(names, "class").select("first_id", "class"), "wanted")
    bit = F.pmod(F.xxhash64("first_id"), F.lit(settings.bits)).alias("bit")
    marked = np.zeros(settings.bits, bool)
    marked[wanted.select(bit).distinct().toPandas()["bit"].to_numpy(np.int64)] = True  # settings.bits rows at most
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))
    kind = StructType.fromDDL("class binary, shingles binary")
    arrow = to_arrow_schema(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in in_slices(batches):
            marked = np.flatnonzero(bits[batch.column(1).to_numpy()])
            texts = batch.column(0).take(pa.array(marked)).to_pylist()
            sets = [shingle_set(text, settings.words) for text in texts]
            yield record_batch([list(map(_digest, sets)), [one.tobytes() for one in sets]], arrow)

    own_bit = F.pmod(F.xxhash64("doc_id"), F.lit(settings.bits))
    found = docs.select("text", own_bit).mapInArrow(read, kind)
    # joined and made distinct by class alone, so the sets are shuffled once
    return stage(found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"]), "sets")


def jaccard_components(
    docs: DataFrame, settings: JoinSettings = JoinSettings(), *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id that links reach.

    Words are runs of anything but ASCII white space, A-Z folded. Null and empty texts, and texts without
    words, have no shingles and link with nothing, so each is its own component. Repeated rows are copies
    like any others and each gives a row. A null doc_id stays null and is never a component's least id unless
    all of the component's ids are null; such a document alone has a null component. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scanned = stage(_scan(docs, settings), "shingles")
    rows = scanned.where("counter IS NULL").select("doc_id", "n_shingles", "class", "parity")
    frequencies = spark.sparkContext.broadcast(_frequencies(scanned, settings))
    classes = stage(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("parity").alias("parity")),
        "classes",
    )
    entries = _split_lists(
        _prefixes(docs, frequencies, settings, False), _prefixes(docs, frequencies, settings, True), settings
    )
    lists = entries.repartition("token", "cell").sortWithinPartitions("token", "cell", "place", "class")
    ordered = _candidates(lists, settings).select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        (F.col("leads") & (F.col("a") < F.col("b"))).alias("a_leads"),
        (F.col("leads") & (F.col("a") > F.col("b"))).alias("b_leads"),
    )
    pairs = ordered.groupBy("a", "b").agg(F.max("a_leads").alias("a_leads"), F.max("b_leads").alias("b_leads"))
    raw = stage(pairs, "pairs")
    pairs = stage(_near(raw, classes, settings), "near-pairs")
    sets = _needed_sets(docs, classes, pairs, settings)
    # the nearest pair of each class first: most other pairs are then within one component
    nearest = stage(_nearest(pairs), "nearest")
    decided = stage(_verify(nearest, sets, settings), "decided")
    roots = stage(connected_components(decided.where("linked")), "roots")
    open_pairs = stage(_apart(pairs.join(nearest, ["a", "b"], "left_anti"), roots).select("a", "b"), "open-pairs")
    more = stage(_verify(open_pairs, sets, settings), "decided-later")
    roots = _linked_further(roots, more)
    failed = _failed_leads(raw, pairs, decided.union(more).where("NOT linked"))
    if not failed.isEmpty():
        orphans = _orphan_candidates(raw, failed, roots, classes, settings)
        if not orphans.isEmpty():
            found = stage(_verify(orphans, _needed_sets(docs, classes, orphans, settings), settings), "decided-orphans")
            roots = _linked_further(roots, found)
    return _label(rows, classes, roots)


def _linked_further(roots: DataFrame, decided: DataFrame) -> DataFrame:
    """``roots`` after more links. Each component goes on as a star, so its own links are not gone through again."""
    links = decided.where("linked").select("a", "b")
    if links.isEmpty():
        return roots
    return stage(connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)), "roots")


def _nearest(pairs: DataFrame) -> DataFrame:
    """For each class the pair whose parities differ least."""
    both = pairs.select("a", "b", "apart").union(pairs.select("b", "a", "apart")).toDF("a", "b", "apart")
    best = both.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("best")).select("a", "best.b")
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of classes that are not yet in one component."""
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(named, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.where("root_a != root_b").drop("root_a", "root_b")


def _members(pairs: DataFrame) -> DataFrame:
    """``(leader, member)`` of the pairs in which one leads."""
    sides = pairs.where("a_leads").select(F.col("a").alias("leader"), F.col("b").alias("member"))
    return sides.union(pairs.where("b_leads").select("b", "a"))


def _failed_leads(raw: DataFrame, pairs: DataFrame, failed: DataFrame) -> DataFrame:
    """The pairs of a leader and a member whose link proved false, on the sets or by their parities."""
    leading = raw.where("a_leads OR b_leads").select("a", "b", "a_leads", "b_leads")
    too_far = leading.join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    return stage(leading.join(failed.select("a", "b"), ["a", "b"]).union(too_far), "failed-leads")


def _orphan_candidates(
    raw: DataFrame, failed: DataFrame, roots: DataFrame, classes: DataFrame, settings: JoinSettings
) -> DataFrame:
    """``(a, b)``: a member whose link with its leader proved false, with another member of the leader, where
    they are not yet connected. ``failed`` are pairs of the first kind with their leaders."""
    failed = _members(failed)
    led = _members(raw).join(failed.select("leader").distinct(), "leader", "left_semi")
    led = led.join(failed.withColumn("orphan", F.lit(True)), ["leader", "member"], "left")
    entries = (
        led.withColumnRenamed("member", "class")
        .join(classes, "class")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select(
            F.xxhash64("leader").alias("token"),
            "n_shingles",
            F.expr(
                "transform(sequence(0, 7), k -> aggregate(sequence(k, size(parity) - 1, 8), 0L, (x, i) -> x ^ parity[i]))"
            ).alias("parity"),
            F.coalesce("root", "class").alias("root"),
            F.coalesce("orphan", F.lit(False)).alias("orphan"),
            "class",
        )
    )
    entries = stage(entries, "led")
    lists = _split_lists(entries, entries, settings).repartition("token", "cell").sortWithinPartitions("token", "cell")
    met = _meet(lists, settings).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    unknown = met.join(raw.select("a", "b"), ["a", "b"], "left_anti")
    return stage(_near(unknown, classes, settings).select("a", "b"), "orphans")


def _meet(entries: DataFrame, settings: JoinSettings) -> DataFrame:
    """``(a, b)``: orphans with those of their leader's members, in other components, that sizes and 512
    parities leave possible; other pairs never leave the task."""
    kind = StructType.fromDDL("a binary, b binary")
    arrow = to_arrow_schema(kind)

    def lists(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, cell, size = (table.column(k).to_numpy() for k in range(3))
        parity = table.column(3).combine_chunks().flatten().to_numpy().reshape(-1, 8)
        root = table.column(4).combine_chunks().dictionary_encode().indices.to_numpy()
        orphan, classes = table.column(5).to_numpy(), table.column(6).combine_chunks()
        starts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])]))
        first, second, waiting = [], [], 0

        def batch():
            sides = (classes.take(pa.array(np.concatenate(rows))) for rows in (first, second))
            return record_batch([*sides], arrow)

        for start, stop in zip(starts, [*starts[1:], len(token)], strict=True):
            order = start + np.argsort(size[start:stop])
            sizes = size[order]
            for row in order[orphan[order]]:
                low = np.searchsorted(100 * sizes, settings.percent * size[row])
                high = np.searchsorted(settings.percent * sizes, 100 * size[row], side="right")
                rows = order[low:high]
                rows = rows[root[rows] != root[row]]
                differing = BYTE_ONES[(parity[rows] ^ parity[row]).view(np.uint8)].sum(axis=1)
                rows = rows[differing <= _gap(size[row], size[rows], settings.percent)]
                if len(rows):
                    first.append(np.full(len(rows), row))
                    second.append(rows)
                    waiting += len(rows)
                if waiting > 50_000:
                    yield batch()
                    first, second, waiting = [], [], 0
        if waiting:
            yield batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches):
            yield from lists(table)

    return entries.select("token", "cell", "n_shingles", "parity", "root", "orphan", "class").mapInArrow(run, kind)


def _label(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Documents with the least doc_id of their component; groups are reduced to classes before any join."""
    grouped = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "first_id", F.coalesce("root", "class").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(least, "root").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
