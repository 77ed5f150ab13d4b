from plantmetrics.llm.sentence_spans import SpanSettings, remove_repeated_spans, runs, sentences

PASSAGE = " ".join(f"This is sentence {name} of the shared passage, with words." for name in "abcdef")


def brute(rows, settings):
    seen, result = {}, []
    for doc_id, text in sorted((r for r in rows if r[1]), key=lambda r: (r[0] is None, r[0] or 0)):
        words = [text[a:b].lower().split() for a, b in sentences(text)]
        gone = set()
        for start in range(len(words)):
            for stop in range(start + 1, len(words) + 1):
                joined = tuple(w for one in words[start:stop] for w in one)
                long = len(joined) >= (settings.min_words if stop - start >= settings.min_sentences else settings.long_sentence)
                if long:
                    if seen.setdefault(joined, (doc_id, start)) != (doc_id, start):
                        gone.update(range(start, stop))
                    break
        kept = "".join(text[a:b] for k, (a, b) in enumerate(sentences(text)) if k not in gone)
        result.append((doc_id, kept.rstrip() if gone else text, len(gone)))
    return result + [(d, t, 0) for d, t in rows if not t]


def test_equals_brute_force(documents):
    own = [" ".join(f"Document {k} says thing {j} here quite alone." for j in range(4)) for k in range(6)]
    rows = [(k, f"{own[k]} {PASSAGE} {own[k][::-1]}") for k in range(5)]
    rows += [(10, None), (11, ""), (12, own[5]), (13, "Short. Short. Short."), (14, "Short. Short. Short.")]
    rows += [(15, f"{PASSAGE}\n{own[5].upper()}\n{PASSAGE}"), (None, PASSAGE), (17, "No end " * 50), (18, "no end " * 50)]
    docs = documents(rows).withColumnRenamed("source", "marks")
    got = remove_repeated_spans(docs)
    assert got.columns == [*docs.columns, "_n_removed"]
    assert sorted(((r.doc_id, r.text, r._n_removed) for r in got.collect()), key=str) == sorted(brute(rows, SpanSettings()), key=str)
    first, second = (next(r for r in got.collect() if r.doc_id == k) for k in (0, 1))
    assert PASSAGE in first.text and "shared" not in second.text and second.n_chars == len(second.text)


def test_repeated_rows_and_empty_table(documents):
    twice = remove_repeated_spans(documents([(1, PASSAGE), (1, PASSAGE)])).collect()
    assert [r.text for r in twice] == [PASSAGE, PASSAGE]
    assert remove_repeated_spans(documents([])).count() == 0


def test_runs_cover_a_passage():
    found = runs(f"Before it. {PASSAGE} After it all.", SpanSettings())
    inside = [r for r in found if r[0] in {x[0] for x in runs(PASSAGE, SpanSettings())}]
    assert {k for _, a, b in inside for k in range(a, b)} == set(range(1, 7))


def left_over(rows, width=50):
    """Words in windows of ``width`` that came before in rows of (doc_id, text)."""
    seen, left = set(), 0
    for doc_id, text in sorted(rows):
        words = text.lower().split()
        gone = set()
        for at in range(len(words) - width + 1):
            window = tuple(words[at : at + width])
            gone |= set(range(at, at + width)) if window in seen else set()
        seen |= {tuple(words[at : at + width]) for at in range(len(words) - width + 1)}
        left += len(gone)
    return left


def test_no_window_of_fifty_words_stays(documents):
    def words(name, n):
        return " ".join(f"{name}{j}" for j in range(n))

    tail = f"{words('a', 20)}. {words('b', 20)}. {words('c', 10)}. {words('d', 10)}. {words('e', 3)}."
    middle = f"{words('f', 15)}. {words('g', 20)}. {words('h', 18)}"
    parts = f"{words('i', 18)}, {words('k', 20)}; {words('l', 18)}"
    rows = [(1, f"{words('p', 9)}. {tail} {words('q', 9)}."), (2, f"{words('r', 30)}. {tail} {words('s', 7)}.")]
    rows += [(3, f"Own {middle} and more."), (4, f"Quite other {middle} without it.")]
    rows += [(5, f"{words('t', 12)} {parts} {words('u', 12)}."), (6, f"{words('v', 5)} {parts} {words('w', 30)}.")]
    got = {r.doc_id: r.text for r in remove_repeated_spans(documents(rows)).collect()}
    assert left_over(rows) > 150 and left_over(got.items()) == 0
    assert got[2] == f"{words('r', 30)}. {words('s', 7)}."
    assert "g0 " not in got[4] and got[4].startswith("Quite other") and got[4].endswith("without it.")
    assert "k0 " not in got[6] and {got[k] for k in (1, 3, 5)} == {text for k, text in rows if k in (1, 3, 5)}


def test_windows_that_stay_in_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text]
    got = [(r.doc_id, r.text) for r in remove_repeated_spans(docs).collect() if r.text]
    before, after = left_over(rows), left_over(got)
    print(f"words in repeated windows of 50: {before} before, {after} after")
    assert after <= before // 50


def test_columns_of_any_name_pass_through(spark, documents):
    from pyspark.sql import functions as F

    passage = "One sentence of eight words stands in here. Another one of nine words comes right behind it."
    names = ["_name", "_AT", "_own", "_own_at", "_marks", "_cut", "name", "_n_removed"]
    docs = documents([(1, passage), (2, "First. " + passage)]).withColumns({n: F.lit(f"own {n}") for n in names})
    rows = {r.doc_id: r for r in remove_repeated_spans(docs, n_removed="gone").collect()}
    assert [rows[2][n] for n in names] == [f"own {n}" for n in names]
    assert (rows[1].gone, rows[2].gone, rows[2].text) == (0, 2, "First.")
    assert remove_repeated_spans(docs).columns[-1] == "_n_removed"
