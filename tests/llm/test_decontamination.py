from plantmetrics.llm.decontamination import (
    TOKEN,
    KnownTokens,
    LeakSettings,
    Stretch,
    benchmark_windows,
    drop_leaks,
    known_tokens,
    mark_leaks,
    stretch_windows,
    template,
)
from plantmetrics.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
QUESTION = "A farmer called Alice has 12 apples and gives 5 kg of them to her neighbour Bob, how many apples does Alice keep at the end of the day?"


def test_template():
    tokens, values = template("The train left. Paris is 30 km from Rome, about two hours.")
    assert tokens[3] == "paris" and tokens[5:8] == ["<number>", "<unit>", "from"] and "<name>" in tokens
    assert [v for v in values if v] == ["30", "km", "rome", "two", "hours"]
    assert template(None) == template("") == ([], [])


def test_verbatim_reparameterised_and_inconsistent(spark, documents):
    other = QUESTION.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "340").replace("5 kg", "7 tons")
    torn = QUESTION.replace("Alice has", "Carol has").replace("does Alice", "does Erin")
    rows = [(1, f"Intro text here. {QUESTION} And then more."), (2, other.upper().lower()), (3, f"So: {other}")]
    rows += [(4, "Nothing of the sort is in this clean text at all, only words of its own."), (5, None), (6, "")]
    rows += [(7, torn), (1, f"Intro text here. {QUESTION} And then more."), (None, QUESTION)]
    items = [(1, QUESTION), (2, "Too shrt"), (None, QUESTION), (3, None), (4, "exactly these five words matter")]
    rows += [(8, "We know exactly these five words matter a lot.")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.text): r._leaked_items for r in mark_leaks(documents(rows), benchmark).collect()}
    leaked = {k[0]: v for k, v in got.items()}
    assert leaked[1] == leaked[3] == leaked[None] == [1] and leaked[8] == [4]
    assert leaked[4] == leaked[5] == leaked[6] == []
    assert leaked[7] == []  # Alice can't be Carol and Erin at once
    kept = drop_leaks(documents(rows), benchmark)
    assert kept.columns == documents(rows).columns and {4, 5, 6, 7} <= {r.doc_id for r in kept.collect()}
    assert drop_leaks(documents(rows), benchmark.limit(0)).count() == len(rows)
    assert mark_leaks(documents([]), benchmark).count() == 0


def test_each_occurrence_is_judged_by_itself(spark, documents):
    other = QUESTION.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "340").replace("5 kg", "7 tons")
    third = QUESTION.replace("Alice", "Erin").replace("Bob", "Alice").replace("12", "5").replace("5 kg", "12 g")
    twin = "we know that Tom has 3 red pens in a box, we know that Ann has 9 red pens in a box, who has more?"
    wordy = other.replace("neighbour", "very old and friendly neighbour").replace("apples and", "apples in a big basket and")
    torn = QUESTION.replace("Alice has", "Carol has").replace("does Alice", "does Erin")
    rows = [(1, f"So: {QUESTION} Or: {other}"), (2, f"So: {other} Or: {third} Or: {QUESTION}"), (3, f"Now {twin}")]
    rows += [(4, f"So: {wordy} Or: {third}"), (5, f"So: {torn} Or: {torn}")]
    rows += [(6, " ".join([f"So: {other}", *["He gives 8 kg of them to her neighbour Max, how many?"] * 3]))]
    benchmark = spark.createDataFrame([(1, QUESTION), (2, twin)], "item_id long, text string")
    got = {r.doc_id: r._leaked_items for r in mark_leaks(documents(rows), benchmark).collect()}
    assert got == {1: [1], 2: [1], 3: [2], 4: [1], 5: [], 6: [1]}


def test_verbatim_copies_of_slots_cases_and_first_words(spark, documents):
    items = ["Compute 48 + 72 - 13 * 5 and round to 2 places", "Alice Bob Carol Dave Erin Frank Grace", "Name all rivers of Asia now"]
    items += ["Which town did Anna, Bernd and Clara visit with Doris in the spring before they left?"]
    rows = [(k, f"Some words before it: {one}, and some behind.") for k, one in enumerate(items)]
    rows += [(k + 10, f"some words. {one.upper()}") for k, one in enumerate(items)]
    rows += [(k + 20, f'He said "{one.lower()}" again.') for k, one in enumerate(items)]
    rows += [(33, "We ask. Which town did Emil,\nFranz and Greta visit with Helga in the spring before they left?")]
    rows += [(43, "We ask. Which town did Emil, Franz and Greta visit with Helga in the spring before Helga left?")]
    rows += [(40, "Compute 1 + 2 - 3 * 4 only."), (41, "Grace Frank Erin Dave Carol Bob Alice")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: r._leaked_items for r in mark_leaks(documents(rows), benchmark).collect()}
    assert got == {doc_id: [doc_id % 10] if doc_id < 40 or doc_id == 43 else [] for doc_id, _ in rows}


def test_verbatim_items_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    holding = {d.doc_id: sorted(i.item_id for i in items if i.text in (d.text or "")) for d in docs}
    got = {r.doc_id: r.leaked_items for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    assert set(got) == set(holding)
    for doc_id, found in holding.items():
        assert set(found) <= set(got[doc_id])
    assert sum(map(bool, got.values())) == sum(map(bool, holding.values()))


def _words(text):
    return [w.lower() for w in TOKEN.findall(text or "") if w[0] not in ".!?\n"]


def test_items_of_any_length_equal_a_word_for_word_matcher(spark, documents):
    """Items cut out of the tables' documents, of 1 to 40 tokens, against every run of words of every document."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400").collect()]
    items = []
    for k, size in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 40] * 2):
        words = _words(docs[k * 13][1])
        items.append((k, " ".join(words[len(words) // 3 :][:size])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    settings = LeakSettings(min_percent=100)
    got = {r.doc_id: set(r._leaked_items) for r in mark_leaks(documents(docs), benchmark, settings).collect()}
    for doc_id, text in docs:
        line = " " + " ".join(_words(text)) + " "
        held = {k for k, item in items if item and f" {item} " in line}
        assert held <= got[doc_id], doc_id
        # beyond that only re-parameterised templates: none for the shortest
        assert {k for k in got[doc_id] - held if len(items[k][1].split()) < 5} == set()


def test_runs_have_every_window_that_can_match(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    settings = LeakSettings()
    known = KnownTokens(known_tokens(benchmark, settings), 50)
    wanted = set()
    for row in benchmark_windows(benchmark, settings).collect():
        wanted.add(row.window)
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    docs += [r.text for r in benchmark.collect()] + ["5 km. Paris is 5 km", "Two. km Alice 3", "", None]

    def found(stretches):
        every, of = stretch_windows(stretches, [8], settings)
        first = {run: min(k for k in range(len(of)) if of[k] == run) for run in set(of.tolist())}
        return {
            (int(h), stretches[of[at]].place + int(at) - first[of[at]], reading)
            for hashes, positions, _, _, reading in every
            for h, at in zip(hashes.view("int64"), positions)
            if int(h) in wanted
        }

    several = 0
    for text in docs:
        runs = list(known.runs(text, 8))
        several += len(runs) > 1
        assert found([Stretch(0, TOKEN.findall(text or ""))]) == found(runs)
    assert several > 5


def test_columns_of_any_name_pass_through(spark, documents):
    from pyspark.sql import functions as F

    names = ["_x", "_Y", "_own_x", "_items", "_leaked_items", "_name", "items", "window", "item_id"]
    docs = documents([(1, QUESTION), (2, "Nothing here.")]).withColumns({n: F.lit(f"own {n}") for n in names})
    benchmark = spark.createDataFrame([(1, QUESTION, "b")], "item_id long, text string, _x string")
    kept = drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns and [(r.doc_id, r["_leaked_items"], r["_Y"]) for r in kept.collect()] == [(2, "own _leaked_items", "own _Y")]
    assert {r.doc_id: r.found for r in mark_leaks(docs, benchmark, name="found").collect()} == {1: [1], 2: []}


def test_a_very_long_text(spark, documents):
    benchmark = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    filler = "words of no question at all " * 100_000
    rows = [(1, filler + QUESTION + filler), (2, filler)]
    assert {r.doc_id: r._leaked_items for r in mark_leaks(documents(rows), benchmark).collect()} == {1: [1], 2: []}
