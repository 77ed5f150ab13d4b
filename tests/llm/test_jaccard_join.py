import random

import numpy as np
import pytest

from plantmetrics.llm.components import connected_components
from plantmetrics.llm.jaccard_join import JoinSettings, _linked_further, _List, _parity, _sketch, jaccard_components
from plantmetrics.sources.scratch import written


def brute(rows, words, percent):
    sets = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        span = min(words, len(found))
        sets.append({tuple(found[k : k + span]) for k in range(len(found) - span + 1)} if found else set())
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted(((d, len(sets[k]), least.get(root(k))) for k, (d, _) in enumerate(rows)), key=str)


def near_copies(seed, groups, size):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [rng.choice(["the", "of", "and", "in", f"w{rng.randint(0, 300)}"]) for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 40)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "settings",
    [
        JoinSettings(words=3, percent=90),
        JoinSettings(words=2, percent=50, max_list=6, short_list=3, block=4, counters=1 << 8),
        JoinSettings(words=2, percent=60, short_list=2, block=2, alike_bits=64),  # leaders that often prove false
    ],
)
def test_equals_brute_force(documents, settings):
    rows = near_copies(settings.percent, 25, 20)
    rows += [(1000, ""), (1001, None), (1002, " \t\n"), (1003, "A b"), (1004, "a  B"), (1004, "a  B"), (None, "a b")]
    got = jaccard_components(documents(rows), settings).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, settings.words, settings.percent)


def test_long_sets_of_sizes_about_a_power_of_two(documents):
    """Parities of 512, 1,024 and 2,048 bits meet; some pairs link and some just don't."""
    rng, rows = random.Random(5), []
    for length in (512, 1020, 1030):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
        for changed in (0, 0, 3, 9, 16, 17, 18, 19, 40):
            copy = base + [f"e{rng.randint(0, 9)}" for _ in range(changed)]
            for place in rng.sample(range(length), changed):
                copy[place] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(copy)))
    settings = JoinSettings(words=3, percent=90)
    got = jaccard_components(documents(rows), settings).collect()
    expected = brute(rows, 3, 90)
    assert sorted(map(tuple, got), key=str) == expected
    assert 3 < len({component for _, _, component in expected}) < len(rows)


def test_empty_table(documents):
    assert jaccard_components(documents([])).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 101), (None, 3), (100, 101)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_members_take_their_answers_from_their_leader():
    """Lists of groups of near copies: no pair that passes the filters is lost, and only leaders scan the blocks."""
    rng = np.random.default_rng(4)
    settings = JoinSettings(words=5, percent=80, block=16)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, 60 + rng.integers(0, 60), dtype=np.uint64)
        for _ in range(25):
            one = base.copy()
            changed = rng.integers(0, len(one), rng.integers(0, 6))
            one[changed] = rng.integers(0, 1 << 63, len(changed), dtype=np.uint64)
            sets.append(np.unique(one))
    position = rng.integers(0, 5, len(sets))
    place = np.array([(len(one) << 32) + int(at) for one, at in zip(sets, position)])
    order = np.argsort(place, kind="stable")
    sets = [sets[k] for k in order]
    parity = np.array([_parity(one, 64)[0] for one in sets])
    sketch = np.array([_sketch(one)[0] for one in sets])
    own = _List(place[order], parity, sketch, settings)
    found, leads = set(), {}
    for row, partners, leading in own.pairs():
        found |= {(int(row), int(p)) for p in partners}
        if leading:
            leads |= {int(p): int(row) for p in partners}
    leaders = [leads.get(k, k) for k in range(len(sets))]
    for a in range(len(sets)):
        rest = np.arange(a + 1, len(sets))
        for b in own.partners(a, rest).tolist():
            assert (a, b) in found or leaders[a] == leaders[b]
    assert len(set(leaders)) < 100 and own.scans == 2 * len(set(leaders))


def test_stars_take_no_round_and_links_only_the_rounds_they_need(spark):
    kind, stars = "a long, b long", [(1, k) for k in range(2, 30)] + [(40, 50), (60, 50 + 11), (61, 60)]
    before = written(spark)
    roots = connected_components(spark.createDataFrame(stars, kind))
    assert written(spark) == before + 1  # the edges alone
    want = {(1, k) for k in range(1, 30)} | {(40, 40), (40, 50), (60, 60), (60, 61)}
    assert {(r.root, r.node) for r in roots.collect()} == want
    decided = spark.createDataFrame([(2, 3, False), (50, 61, False)], f"{kind}, linked boolean")
    assert _linked_further(roots, decided) is roots
    more = spark.createDataFrame([(50, 61, True), (70, 71, True), (5, 40, False)], f"{kind}, linked boolean")
    want = {(1, k) for k in range(1, 30)} | {(40, k) for k in (40, 50, 60, 61)} | {(70, 70), (70, 71)}
    assert {(r.root, r.node) for r in _linked_further(roots, more).collect()} == want
