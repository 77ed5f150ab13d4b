import re
from collections import Counter

from plantmetrics.llm.line_rules import LineRules, apply_line_rules

SCHEMA = "doc_id long, text string, source string, host string, copies int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, rules):
    def plain(line):
        return " ".join(WORD.findall(line)).lower()

    hosts, frequency = Counter(r[2] for r in rows), Counter()
    for _, text, host, *_ in rows:
        frequency.update((host, line) for line in {plain(x) for x in (text or "").split("\n")} - {""})
    for doc_id, text, host, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        spans = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        again = {p for k, s in enumerate(spans) if spans.count(s) > 1 for p in range(k, k + 5)}
        lines = [x for x in text.split("\n") if plain(x)]
        seen = [(host, plain(x)) for x in lines]
        gone = sum(
            len(x.split(" "))
            for h, x in seen
            if frequency[h, x] > rules.max_line_docs and frequency[h, x] * 100 > hosts[h] * rules.max_line_percent
        )
        n, left = len(words), len(words) - gone
        failed = n < 10 or 100 * len(again) > 20 * n
        kept = not failed and left >= 10 and left * 2 >= n
        symbols, copies = sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines))
        yield doc_id, n, sum(map(len, words)), symbols, copies, len(again), failed, left, kept


def test_equals_brute_force(spark):
    prose = " ".join(f"word{k}" for k in range(12))
    rows = [(k, f"Share  THIS page\n{prose} é😀 {k}\n share this\tpage", "hot", "x", 1) for k in range(40)]
    rows += [(100, None, "hot", "x", 1), (101, "", None, None, None), (102, "Share this page", "cold", "x", 1)]
    rows += [(103, "a b c d e f g a b c d e a b c d e\n\n \t\nq#*$%&|<>", "cold", "x", 1)] * 2
    rows += [(None, "same\nsame\n" + prose, None, "x", 1), (105, "Share this page\n" * 9 + "ten words", "hot", "x", 1)]
    rows += [(106, " ".join(str(k % 700) for k in range(3000)), "cold", "x", 1)]
    rules = LineRules(max_line_docs=5)
    got = apply_line_rules(spark.createDataFrame(rows, SCHEMA), rules)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_left kept".split()
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(brute(rows, rules), key=str)
    assert "Python" not in got._jdf.queryExecution().toString()


def test_empty_table(spark):
    assert apply_line_rules(spark.createDataFrame([], SCHEMA)).count() == 0
