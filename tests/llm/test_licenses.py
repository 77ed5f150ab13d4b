import math
import random
import textwrap
from collections import Counter

import pytest

from plantmetrics.llm.licenses import NOTICES, OPENINGS, TEXTS, LicenseSettings, Notices, resolve_licenses, scan_notices, terms
from plantmetrics.llm.queries import QUERIES

FILES = "path string, text string, license string"


def test_headers_files_and_inheritance(spark):
    rows = [("a/LICENSE", "Copyright us\n" + NOTICES["MIT"] + "\nmore words that are not the notice at all, many of them"),
            ("a/x.py", "code without notice"), ("a/b/c/y.py", None), ("a/b/c/z.py", "# Licensed under the Apache License, Version 2.0\n" + "def run(files): return [load(one) for one in files]\n" * 5),
            ("a/b/COPYING", NOTICES["GPL-3.0"]), ("q/r.py", ""), ("top.py", "text"), (None, NOTICES["MIT"]), ("a/x.py", "code without notice")]
    got = resolve_licenses(spark.createDataFrame([(*r, "x") for r in rows], FILES)).collect()
    assert len(got) == len(rows)
    found = {r.path: (r.license, r.origin, r.origin_path) for r in got}
    assert found["a/LICENSE"] == ("MIT", "file", None) and found["a/x.py"] == ("MIT", "inherited", "a")
    assert found["a/b/c/y.py"] == ("GPL-3.0", "inherited", "a/b")
    assert found["a/b/c/z.py"] == ("Apache-2.0", "header", None) and found["a/b/COPYING"][1] == "file"
    assert found["q/r.py"] == found["top.py"] == (None, "none", None)
    assert resolve_licenses(spark.createDataFrame([], FILES)).count() == 0


def test_notices_of_the_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_license_scan"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        own = {name for name, notice in NOTICES.items() if notice in text.split("\n")}
        assert (got[doc_id].license in own) if own else got[doc_id].origin in ("none", "inherited"), doc_id


def test_licence_texts_wrapped_headers_and_tags(spark):
    def wrapped(text, mark="", width=70):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    code = "def run(files):\n    return [load(one) for one in files]\n" * 20
    long = [(name, [text for other, text in TEXTS if other == name]) for name in sorted({name for name, _ in TEXTS})]
    rows = [(f"{name}/{k}/LICENSE", f"Some License\n\nCopyright (c) 2019 A. Person\n\n{wrapped(text)}") for name, texts in long for k, text in enumerate(texts)]
    rows += [(f"{name}/{k}/x.py", code) for name, texts in long for k in range(len(texts))]
    rows += [(f"{name}/header{k}.py", wrapped(text, "# ") + "\n\n" + code) for name, texts in long for k, text in enumerate(texts)]
    rows += [(f"tag/of-{name}.c", f"// SPDX-License-Identifier: {name}\n{code}") for name in NOTICES]
    rows += [("tag/of-GPL-2.0-or-later.c", f"/* SPDX-License-Identifier: GPL-2.0-or-later */\n{code}")]
    rows += [("line/MIT.txt", f"{code} and some words. It was released under the\nMIT License. Then there are many other words. {code}")]
    got = {r.path: r for r in resolve_licenses(spark.createDataFrame([(*r, "x") for r in rows], FILES)).collect()}
    for path, row in got.items():
        expected = path.split("/")[0] if path.split("/")[0] not in ("tag", "line") else path.split("/")[1].rsplit(".", 1)[0].removeprefix("of-").removesuffix("-or-later")
        origin = "file" if path.endswith("LICENSE") else "inherited" if path.endswith("x.py") else "header"
        assert (row.license, row.origin) == (expected, origin), path


def cosine(one, other, idf):
    """Of two texts, from whole vectors over all their terms."""
    a, b = Counter(terms(one)), Counter(terms(other))
    both = sorted({*a, *b})
    x, y = ([counts[t] * idf(t) for t in both] for counts in (a, b))
    size = math.sqrt(sum(v * v for v in x)) * math.sqrt(sum(v * v for v in y))
    return sum(v * w for v, w in zip(x, y)) / size if size else 0.0


def test_scores_against_whole_vectors(spark):
    """Lines, files and runs of terms against every notice, one by one."""
    notices = [("A-1", "one two three four five"), ("B-1", "six seven three eight"), ("C-1", "one two nine ten")]
    words = "one two three four five six seven eight nine ten other words here".split()
    random_ = random.Random(3)
    texts = ["\n".join(" ".join(random_.choices(words, k=random_.randrange(9))) for _ in range(random_.randrange(4))) for _ in range(150)]
    texts += ["", "one two three four five", "one two three four five\nsix seven three eight", "filler " * 50_000 + "six seven three eight"]
    held = {t: sum(t in terms(text) for text in texts) for _, notice in notices for t in terms(notice)}

    def idf(term):
        return 1 + math.log((1 + len(texts)) / (1 + held.get(term, 0)))

    settings = LicenseSettings(min_line=0.8, min_file=0.7, min_shared=2)
    rows = spark.createDataFrame([(str(k), text) for k, text in enumerate(texts)], "path string, text string")
    got = {int(r.path): r for r in scan_notices(rows, notices, settings).collect()}
    assert len(got) == len(texts)
    caught = 0
    for k, text in enumerate(texts):
        shared = [one for one in (text.split("\n")) if sum(t in held for t in set(terms(one))) >= 2]
        best = max([cosine(one, notice, idf) for one in shared for _, notice in notices], default=0.0)
        found = terms(text)[-1000:]
        for _, notice in notices:
            size = min(len(terms(notice)), len(found))
            runs = [found[at : at + size] for at in range(len(found) - size + 1)] if size else []
            runs = [" ".join(run) for run in runs if sum(t in held for t in set(run)) >= 2]
            best = max([best, *(cosine(run, notice, idf) for run in runs)])
        assert (got[k].line_score >= 0.8) == (best >= 0.8), text[:80]
        if best >= 0.8:
            caught += 1
            assert got[k].line_score == pytest.approx(best)
        whole = max(cosine(text, notice, idf) for _, notice in notices) if len(set(terms(text)) & set(held)) >= 2 else 0.0
        if whole >= 0.7:
            assert got[k].file_score == pytest.approx(whole)
        else:
            assert got[k].file_score < 0.7
    assert caught > 10


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_inheritance_against_a_walk_up_the_tree(spark, broadcast_rows):
    random_ = random.Random(4)
    names = sorted(NOTICES)
    rows = []
    for k in range(300):
        directory = "/".join(random_.choices("abc", k=random_.randrange(5)))
        licensed = random_.random() < 0.15
        text = NOTICES[random_.choice(names)] if licensed else "no notice"
        rows.append((f"{directory}/" * bool(directory) + (f"LICENSE.{k}" if licensed else f"f{k}"), text, "x"))
    rows += [(f"a/b/hot{k}", "no notice", "x") for k in range(200)]
    settings = LicenseSettings(broadcast_rows=broadcast_rows)
    got = resolve_licenses(spark.createDataFrame(rows, FILES), settings).collect()
    assert len(got) == len(rows)
    own = {r.path: (r.license, r.score) for r in got if r.origin == "file"}
    assert own.keys() == {path for path, text, _ in rows if text != "no notice"}
    above = {}
    for path, (name, score) in sorted(own.items(), key=lambda one: (-one[1][1], one[0])):
        above.setdefault(path.rpartition("/")[0], name)  # ties: the first by path
    for row in got:
        if row.origin == "file":
            continue
        directory, expected = row.path.rpartition("/")[0], (None, "none", None)
        while True:
            if directory in above:
                expected = (above[directory], "inherited", directory)
                break
            if not directory:
                break
            directory = directory.rpartition("/")[0]
        assert (row.license, row.origin, row.origin_path) == expected, row.path


def test_long_licences_are_known_without_their_name(spark):
    openings = [(name, text) for name, text in TEXTS if OPENINGS.match(text)]
    assert {name for name, _ in openings} >= {"GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "Apache-2.0", "MPL-2.0", "CC0-1.0", "CC-BY-4.0"}
    body = " ".join(f"clause {k} of the terms that follow, in words of its own." for k in range(20_000))
    rows = [(f"{name}/text.txt", f"   {text}\n\n{body}") for name, text in openings]
    rows += [(f"{name}/x.py", "no notice") for name, _ in openings]
    rows += [("later/essay.txt", f"{body}\n{openings[0][1]}\n{body}"), ("later/x.py", "no notice")]
    rows += [("code/x.py", f"# {openings[0][1]}\n{body}"), ("code/y.py", "no notice")]
    got = {r.path: r for r in resolve_licenses(spark.createDataFrame([(*r, "x") for r in rows], FILES)).collect()}
    for name, _ in openings:
        assert (got[f"{name}/text.txt"].license, got[f"{name}/text.txt"].origin) == (name, "file")
        assert (got[f"{name}/x.py"].license, got[f"{name}/x.py"].origin_path) == (name, name)
    assert got["later/essay.txt"].origin == got["code/x.py"].origin == "header"
    assert got["later/x.py"].origin == got["code/y.py"].origin == "none"


def test_no_notice_scores_nothing():
    known = Notices(list(NOTICES.items()), {}, 0)
    assert known.possible({"nothing"}, 0.8) == [] and known.head([], [], 0.8, 2) == (0.0, None)
