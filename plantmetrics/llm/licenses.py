"""Licences of files: notices by TF-IDF, and inheritance from the nearest directory above.

Each line of each file is compared with known notices, headers and licence texts by the cosine of sparse TF-IDF
vectors, as is each run of as many terms as the notice has, over line breaks, and each file as a whole; files none
of whose terms could reach a notice are passed over. SPDX tags are read as they are. Document frequencies of the
notices' terms are counted over all files. A file that is a licence as a whole, or is named like one, licenses its
directory. A file without a notice of its own inherits from the nearest directory above it that has a licence: the
directories' ancestors are joined with the licensed ones. Of long licences (GNU, Apache, Mozilla, Creative Commons)
the template is what they begin with: a file that begins so, and not as a comment, is the licence itself, whatever
its name and however long it is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.arrow import map_columns
from plantmetrics.sources import stage

# Short notices by which licences are announced, and names of licence files.
NOTICES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Usual headers, short licence texts, and of long ones what they begin with.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
    "the Free Software Foundation, either version {2} of the License, or (at your option) any later version. "
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details."
)
_GNU_TEXT = (
    "GNU {} Version {} Copyright (C) {} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim "
    "copies of this license document, but changing it is not allowed."
)
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
_CC_TEXT = (
    "Creative Commons {0} 4.0 International Public License By exercising the Licensed Rights (defined below), You accept "
    "and agree to be bound by the terms and conditions of this Creative Commons {0} 4.0 International Public License"
)
_CC_KINDS = {"CC-BY-4.0": "Attribution", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-SA-4.0": "Attribution-ShareAlike"}
TEXTS = [
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", 3, ":")),
    ("AGPL-3.0", _GNU_TEXT.format("AFFERO GENERAL PUBLIC LICENSE", "3, 19 November 2007", 2007)),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
        "AND DISTRIBUTION",
    ),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAME + _BSD_END),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "CC0-1.0",
        "CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer "
        "exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s)",
    ),
    ("GPL-2.0", _GNU.format("program", "General Public License", 2, ";")),
    ("GPL-2.0", _GNU_TEXT.format("GENERAL PUBLIC LICENSE", "2, June 1991", "1989, 1991")),
    ("GPL-3.0", _GNU.format("program", "General Public License", 3, ":")),
    ("GPL-3.0", _GNU_TEXT.format("GENERAL PUBLIC LICENSE", "3, 29 June 2007", 2007)),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", "2.1", ";")),
    ("LGPL-2.1", _GNU_TEXT.format("LESSER GENERAL PUBLIC LICENSE", "2.1, February 1999", "1991, 1999")),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "MPL-2.0",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that "
        "creates, contributes to the creation of, or owns Covered Software.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    *((name, form.format(kind)) for name, kind in _CC_KINDS.items() for form in (_CC, _CC_TEXT)),
]
# "MIT OR Apache-2.0" is read up to the first licence that is known.
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]+)", re.I)
SPDX_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"
# How comments begin.
COMMENT = re.compile(r"\s*(?:#|//|/\*|--|;|%|\"\"\"|'''|<!--|\(\*|\.\. )")
#: What long licences begin with, of ``TEXTS``.
OPENINGS = re.compile(
    r"GNU [A-Z ]+LICENSE Version|Apache License Version|CC0 1\.0 Universal|Mozilla Public License Version|Creative Commons .* Public License By"
)
TERM = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+(?:\d+)?")


@dataclass(frozen=True)
class LicenseSettings:
    #: Least cosine of a notice in a line, and of a whole file to be a licence file.
    min_line: float = 0.8
    min_file: float = 0.7
    #: Different terms that a line shares with a notice before their cosine is taken.
    min_shared: int = 2
    #: Directories that inherit, up to which their table is broadcast; beyond, it is joined in as many parts as ``salts``.
    broadcast_rows: int = 100_000
    salts: int = 32


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").lower())


class Notices:
    """Normalised TF-IDF vectors of the notices and texts, by term and one by one."""

    def __init__(self, notices: list[tuple[str, str]], frequencies: dict[str, int], files: int):
        self.files, self.frequencies = files, frequencies
        self.postings: dict[str, list[tuple[tuple[str, int], float]]] = {}
        self.vectors: list[tuple[str, int, dict[str, float]]] = []
        self.openings: set[int] = set()
        for k, (name, text) in enumerate(sorted(notices)):
            found = terms(text)
            weights = {term: n * self.idf(term) for term, n in Counter(found).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            if OPENINGS.match(text):
                self.openings.add(k)
            self.vectors.append((name, len(found), {term: weight / norm for term, weight in weights.items()}))
            for term, weight in weights.items():
                self.postings.setdefault(term, []).append(((name, k), weight / norm))
        self.names = {name.lower(): name for name, _ in notices}

    def possible(self, present: set[str], least: float) -> list[int]:
        """Places of the notices that some text of these terms can reach a cosine of ``least`` with."""
        bounds = [0.0] * len(self.vectors)
        for term in present.intersection(self.postings):
            for (_, k), weight in self.postings[term]:
                bounds[k] += weight * weight
        return [k for k, bound in enumerate(bounds) if bound >= least * least - 1e-9]

    def head(self, found: list[str], possible: list[int], least: float, min_shared: int) -> tuple[float, str | None]:
        """(cosine, licence) of the opening of a long licence that the terms begin with: of the most similar run of
        its length among twice as many terms, so that a title may stand before it."""
        best = (0.0, None)
        for k in self.openings.intersection(possible):
            score = self.window(found[: 2 * self.vectors[k][1]], [k], least, min_shared)
            best = max(best, score, key=lambda x: (round(x[0], 9), x[1] or ""))
        return best

    def window(self, found: list[str], possible, least: float, min_shared: int) -> tuple[float, str | None]:
        """(cosine, notice) of the most similar run of terms as long as the notice, if it reaches ``least``."""
        idf = np.array([self.idf(term) for term in found])
        squares, best = np.concatenate([[0], np.cumsum(idf * idf)]), (0.0, None)
        for name, length, vector in (self.vectors[k] for k in possible):
            size = min(length, len(found))
            dots = np.concatenate([[0], np.cumsum(idf * [vector.get(term, 0.0) for term in found])])
            dots = dots[size:] - dots[:-size]
            # the norm is greater where terms repeat: this bounds the cosine
            bounds = dots / np.sqrt(squares[size:] - squares[:-size])
            for at in np.argsort(-bounds, kind="stable"):
                if bounds[at] < max(least, best[0]) - 1e-9:
                    break
                run = Counter(found[at : at + size])
                if sum(term in self.postings for term in run) >= min_shared:
                    score = dots[at] / math.sqrt(sum((n * self.idf(term)) ** 2 for term, n in run.items()))
                    if score >= least and score > best[0] + 1e-9:
                        best = (float(score), name)
        return best

    def tagged(self, text: str) -> str | None:
        """The licence of the text's first SPDX tag that names a known one."""
        for tag in SPDX.findall(text):
            for one in SPDX_ID.findall(tag):
                name = self.names.get(re.sub(r"-(only|or-later)$", "", one.lower()))
                if name:
                    return name
        return None

    def idf(self, term: str) -> float:
        """Terms outside the notices count as if no file had them."""
        return 1 + math.log((1 + self.files) / (1 + self.frequencies.get(term, 0)))

    def best(self, found: Counter, min_shared: int) -> tuple[float, str | None]:
        """(cosine, notice) of the most similar notice; the first name among equals."""
        if sum(term in self.postings for term in found) < min_shared:
            return 0.0, None
        dots: dict[tuple[str, int], float] = {}
        norm = 0.0
        for term, n in found.items():
            weight = n * self.idf(term)
            norm += weight * weight
            for name, other in self.postings.get(term, ()):
                dots[name] = dots.get(name, 0.0) + weight * other
        score, name = max(((dot, name) for name, dot in dots.items()), key=lambda x: (round(x[0], 9), x[1]))
        return score / math.sqrt(norm), name[0]


def term_frequencies(files: DataFrame, notices: list[tuple[str, str]]) -> tuple[dict[str, int], int]:
    """(files that hold each term of the notices, number of files), over all files."""
    known = {term for _, text in notices for term in terms(text)}

    def work(texts):
        return ([sorted(known.intersection(terms(text))) for text in texts],)

    held = map_columns(files.select("text"), work, "terms array<string>")
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").count()
    return {row["term"]: row["count"] for row in counted.collect()}, files.count()  # a row per known term


def scan_notices(files: DataFrame, notices: list[tuple[str, str]], settings: LicenseSettings) -> DataFrame:
    """``(path, line_license, line_score, file_license, file_score)`` per row of ``files``: the best line, window
    of terms or SPDX tag, and the file as a whole or, if that reaches nothing, its head; scores that settings don't
    reach may be 0."""
    frequencies, count = term_frequencies(files, notices)

    def work(paths, texts):
        known = Notices(notices, frequencies, count)
        lines, wholes = [], []
        for text in texts:
            found = terms(text)
            least = min(settings.min_line, settings.min_file)
            possible, tag = known.possible(set(found), least), known.tagged(text or "")
            if not possible:
                lines.append((1.0, tag) if tag else (0.0, None))
                wholes.append((0.0, None))
                continue
            each = [Counter(terms(line)) for line in (text or "").split("\n")]
            lines.append(max((known.best(one, settings.min_shared) for one in each), key=lambda x: x[0]))
            window = known.window(found, possible, settings.min_line, settings.min_shared)
            if tag:
                lines[-1] = (1.0, tag)
            elif window[0] > lines[-1][0] + 1e-9:
                lines[-1] = window
            wholes.append(known.best(Counter(found), settings.min_shared))
            if wholes[-1][0] < settings.min_file and not COMMENT.match(text):
                head = known.head(found, possible, settings.min_line, settings.min_shared)
                wholes[-1] = max(wholes[-1], head, key=lambda x: x[0])
        line_scores, line_names = zip(*lines, strict=True)
        file_scores, file_names = zip(*wholes, strict=True)
        return paths, line_names, line_scores, file_names, file_scores

    kind = "path string, line_license string, line_score double, file_license string, file_score double"
    return map_columns(files.select("path", "text"), work, kind)


def resolve_licenses(
    files: DataFrame, settings: LicenseSettings = LicenseSettings(), notices: dict[str, str] | None = None
) -> DataFrame:
    """``path, license, score, origin, origin_path`` per row of ``files`` (path, text).

    ``origin`` is ``header`` (a line, a passage over lines or an SPDX tag of its own), ``file`` (the file is a licence), ``inherited`` (from the
    directory ``origin_path``) or ``none``. Where several licence files lie in a directory, the one with the
    highest score counts, the first by path among equals. A null text has no notice; a null path has no
    directory and inherits nothing. Repeated rows give repeated results; other columns are ignored; an empty
    table gives an empty result. A directory may hold any share of all files: its files are joined with the licence
    above them by broadcast, where these tables were counted small, else in ``salts`` parts.
    """
    known = list(notices.items()) if notices else [*NOTICES.items(), *TEXTS]
    scanned = stage(scan_notices(files, known, settings), "notices")
    scanned = scanned.withColumns(
        {
            "directory": F.regexp_extract("path", r"^(.*)/[^/]*$", 1),
            "basename": F.regexp_extract("path", r"([^/]*)$", 1),
        }
    )
    named = F.rlike("basename", F.lit(LICENCE_NAME)) & (F.col("line_score") >= settings.min_line)
    whole = F.col("file_score") >= settings.min_file
    scanned = scanned.withColumn("is_license", F.coalesce(whole | named, F.lit(False)))
    licence_files = scanned.where("is_license AND path IS NOT NULL").select(
        "directory",
        F.struct((-F.greatest("file_score", "line_score")).alias("order"), "path").alias("rank"),
        F.when(whole, F.col("file_license")).otherwise(F.col("line_license")).alias("license"),
    )
    licensed = licence_files.groupBy("directory").agg(F.min_by("license", "rank").alias("above"))
    # ancestors of each directory, not of each file
    directories = scanned.where("path IS NOT NULL").select("directory").distinct()
    parts = F.split("directory", "/")
    ancestors = directories.select("directory", F.posexplode(F.sequence(F.lit(0), F.size(parts))).alias("depth", "n")).select(
        "directory", "depth", F.array_join(F.slice(parts, 1, F.col("n")), "/").alias("ancestor")
    )
    nearest = (
        ancestors.join(licensed.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory")
        .agg(F.max_by(F.struct("above", "ancestor"), "depth").alias("given"))
    )
    nearest = stage(nearest, "nearest")
    if nearest.count() <= settings.broadcast_rows:
        joined = scanned.join(F.broadcast(nearest), "directory", "left")
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1)))
        salted = scanned.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(settings.salts)).cast("int"))
        joined = salted.join(nearest.withColumn("part", parts), ["directory", "part"], "left")
    header = F.col("line_score") >= settings.min_line
    return joined.select(
        "path",
        F.when(F.col("is_license") & whole, F.col("file_license"))
        .when(header, F.col("line_license"))
        .otherwise(F.col("given.above"))
        .alias("license"),
        F.when(F.col("is_license") & whole, F.col("file_score")).when(header, F.col("line_score")).alias("score"),
        F.when(F.col("is_license"), "file")
        .when(header, "header")
        .when(F.col("given").isNotNull(), "inherited")
        .otherwise("none")
        .alias("origin"),
        F.when(~F.col("is_license") & ~header, F.col("given.ancestor")).alias("origin_path"),
    )
