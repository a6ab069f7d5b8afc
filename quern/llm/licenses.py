"""License scans by an exact set-similarity join of text blocks with notice templates."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.base import slices, stage, texts

# Phrases with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Published notices of licenses; label, words that a match must hold, text.
TEMPLATES = (
    (
        "apache-2.0",
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "apache spdx", "SPDX-License-Identifier: Apache-2.0"),
    (
        "bsd",
        "",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
        HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("bsd", "redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "bsd", "Released under the BSD License."),
    ("bsd", "bsd spdx", "SPDX-License-Identifier: BSD-3-Clause"),
    ("cc-by", "attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-nd", "noncommercial noderivatives", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "noncommercial sharealike", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nd", "noderivatives", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-sa", "sharealike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "sa", "Licensed under CC BY-SA 4.0."),
    (
        "gpl",
        "gnu",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of
        the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this
        program. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    ("gpl", "gnu", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "gnu", "This work is licensed under the GNU General Public License, version 3."),
    (
        "isc",
        "",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    ("isc", "fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "mit",
        "",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("mit", "charge", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "mit", "Released under the MIT License."),
    ("mit", "mit spdx", "SPDX-License-Identifier: MIT"),
    (
        "mpl-2.0",
        "mozilla",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
    ("mpl-2.0", "mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "lgpl",
        "lesser",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version
        2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along
        with this library; if not, see <https://www.gnu.org/licenses/>.""",
    ),
    ("lgpl", "lesser", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    (
        "agpl",
        "affero",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License
        along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    ("agpl", "affero", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    (
        "ofl-1.1",
        "font",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software, to use, study, copy, merge, embed, modify, redistribute, and sell modified and unmodified copies
        of the Font Software, subject to the following conditions""",
    ),
    ("ofl-1.1", "font ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is available with a FAQ at: https://openfontlicense.org OFL"),
    (
        "font-permission",
        "font",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of the fonts accompanying this license ("Fonts") and associated documentation files (the "Font Software"), to reproduce
        and distribute the Font Software, including without limitation the rights to use, copy, merge, publish, distribute, and/or sell copies of the Font Software, and to permit persons to whom the
        Font Software is furnished to do so, subject to the following conditions""",
    ),
    ("font-permission", "font charge", "Permission is hereby granted, free of charge, to any person obtaining a copy of this font software and associated documentation files"),
    (
        "unlicense",
        "unencumbered",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "cc0-1.0",
        "cc0",
        """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without
        any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software.""",
    ),
    (
        "zlib",
        "misrepresented",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to
        anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must
        not be misrepresented; you must not claim that you wrote the original software.""",
    ),
    ("epl-2.0", "eclipse", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    (
        "bsl-1.0",
        "organization",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce,
        display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so""",
    ),
    ("bsl-1.0", "boost", "Distributed under the Boost Software License, Version 1.0."),
)

# Identifiers of the public list of licenses, with the label of each.
IDENTIFIERS = (
    ("agpl", "AGPL-3.0-only"), ("agpl", "AGPL-3.0-or-later"), ("bsd", "BSD-2-Clause"), ("bsl-1.0", "BSL-1.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-nc", "CC-BY-NC-4.0"), ("cc-by-nd", "CC-BY-ND-4.0"),
    ("cc-by-sa", "CC-BY-SA-4.0"), ("cc0-1.0", "CC0-1.0"), ("epl-2.0", "EPL-2.0"), ("gpl", "GPL-2.0-only"), ("gpl", "GPL-2.0-or-later"), ("gpl", "GPL-3.0-only"), ("gpl", "GPL-3.0-or-later"), ("isc", "ISC"),
    ("lgpl", "LGPL-2.1-only"), ("lgpl", "LGPL-2.1-or-later"), ("lgpl", "LGPL-3.0-only"), ("lgpl", "LGPL-3.0-or-later"), ("mpl-2.0", "MPL-2.0"), ("ofl-1.1", "OFL-1.1"), ("unlicense", "Unlicense"), ("zlib", "Zlib"),
)
# A line that names a license must hold every word of the identifier.
TEMPLATES += tuple((label, f"spdx identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}", f"SPDX-License-Identifier: {name}") for label, name in IDENTIFIERS)
#: The share of a template's tokens that a block must hold.
CONTAINMENT = 0.8

#: A-Z to lower case; everything below 0x80 but digits and letters separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _frequencies(vocabulary: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, body in slices(batch):
                for text in body:
                    counts.update(filter(vocabulary.__contains__, words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])

    return run


def phrase_places(tokens: list[bytes]) -> tuple[int, int | None, int | None, set[str]]:
    """How often the phrases stand among ``tokens``, their first and last word, and their labels."""
    joined = b" " + b" ".join(tokens) + b" "
    starts, labels = [], set()
    for phrase, label in PHRASES:
        mark = b" " + phrase.encode() + b" "
        at, word, done = joined.find(mark), 0, 0
        while at >= 0:
            word, done = word + joined.count(b" ", done, at), at
            starts.append(word)
            labels.add(label)
            at = joined.find(mark, at + 1)
    return len(starts), min(starts, default=None), max(starts, default=None), labels


_BLOCK = pa.struct([("places", pa.list_(pa.int32())), ("ranks", pa.list_(pa.int32()))])
_SCANNED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
    + [("base_labels", pa.list_(pa.string())), ("blocks", pa.list_(_BLOCK))]
)


def blocks_of(tokens: list[bytes], ranks: dict[bytes, int], prefix: frozenset, reach: int) -> list[dict]:
    """The stretches of a text within ``reach`` words of some prefix token: places and ranks of the template tokens there."""
    marks = [i for i, t in enumerate(tokens) if t in prefix]
    out, k = [], 0
    while k < len(marks):
        first = marks[k]
        while k + 1 < len(marks) and marks[k + 1] - marks[k] <= 2 * reach:
            k += 1
        places = [i for i in range(max(0, first - reach), min(len(tokens), marks[k] + reach + 1)) if tokens[i] in ranks]
        out.append({"places": places, "ranks": [ranks[tokens[i]] for i in places]})
        k += 1
    return out


def _scans(ranks: dict[bytes, int], prefix: frozenset, reach: int):
    """Of each text: the phrases, and the blocks around prefix tokens of some template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for ids, body in slices(batch):
                out = []
                for i, text in zip(ids, body, strict=True):
                    n, first, last, labels = phrase_places(tokens := words(text))
                    blocks = [] if prefix.isdisjoint(tokens) else blocks_of(tokens, ranks, prefix, reach)
                    out.append((row, i, len(tokens), n, first, last, sorted(labels), blocks))
                    row += 1
                yield pa.RecordBatch.from_pylist([dict(zip(_SCANNED.names, x, strict=True)) for x in out], schema=_SCANNED)

    return run


def matches(places: list[int], ranks: list[int], tokens: frozenset, width: int, need: int, marks: frozenset) -> list[tuple[int, int, int]]:
    """(overlap, first, last) of each window of ``width`` words that starts with a token of the template and holds ``need`` of them, ``marks`` among them.

    A window whose first token comes again in it says no more than a later one. ``last`` is where the last of its tokens is first seen.
    """
    held = [(p, r) for p, r in zip(places, ranks, strict=True) if r in tokens]
    times: Counter = Counter()
    out, end = [], 0
    for k, (start, rank) in enumerate(held):
        while end < len(held) and held[end][0] < start + width:
            times[held[end][1]] += 1
            end += 1
        if times[rank] == 1 and len(times) >= need and all(m in times for m in marks):
            first = {r: p for p, r in reversed(held[k:end])}
            out.append((len(times), start, max(first.values())))
        times[rank] -= 1
        if not times[rank]:
            del times[rank]
    return out


def best_labels(found: list[tuple[str, float, int, int, int]]) -> tuple[set[str], float]:
    """Labels and largest share of the matches (label, share, overlap, first, last) but those that a match of another label with more tokens covers by over half."""
    kept = [
        (label, share)
        for label, share, n, a, b in found
        if not any(other != label and m > n and 2 * (min(b, d) - max(a, c) + 1) > b - a + 1 for other, _, m, c, d in found)
    ]
    return {label for label, _ in kept}, max((share for _, share in kept), default=0.0)


_FOUND = pa.schema([("row", pa.int64()), ("labels", pa.list_(pa.string())), ("best", pa.float64())])


def _verified(notices: list[tuple[str, frozenset, int, int, frozenset]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                found = []
                for k in r["templates"]:
                    label, tokens, width, need, marks = notices[k]
                    found += [(label, n / len(tokens), n, a, b) for n, a, b in matches(r["places"], r["ranks"], tokens, width, need, marks)]
                labels, best = best_labels(list(set(found)))
                out.append({"row": r["row"], "labels": sorted(labels), "best": best})
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return run


def find_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """For every row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays, sorted), score.

    A block is a window of a template's number of words, across lines, seen as a set of words; it matches the template if it holds
    ``containment`` of the template's set, and the words that the template requires. Of matches that lie on each other by over
    half, those of the label with most words count. Tokens are ordered by how rare they are in the whole corpus; only stretches
    that share a token in a template's prefix, are long enough and can still reach the overlap from that token's place are
    compared in full. ``templates`` (label, required words, text) fit in memory. ``score`` is 1 if a phrase stands in the text,
    else the largest containment that counts, else 0. A null text is empty. Repeated rows each get their row.
    """
    spark = docs.sparkSession
    sets = [(label, frozenset(words(text.encode())), len(words(text.encode())), frozenset(words(marks.encode()))) for label, marks, text in templates]
    vocabulary = frozenset().union(*(s[1] for s in sets))
    binary = texts(docs, binary=True)
    counts = binary.mapInArrow(_frequencies(vocabulary), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    seen = {bytes(r.token): r.n for r in counts.collect()}  # a row for each template token at most
    ranks = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (seen.get(t, 0), t)))}
    rows, index, notices = [], [], []
    for number, (label, tokens, width, marks) in enumerate(sets):
        ordered = sorted(ranks[t] for t in tokens)
        need = max(1, math.ceil(containment * len(ordered) - 1e-9))
        rows.append((number, len(ordered), need))
        notices.append((label, frozenset(ordered), width, need, frozenset(ranks[m] for m in marks)))
        index += [(t, number, k) for k, t in enumerate(ordered[: len(ordered) - need + 1])]
    by_rank = sorted(ranks, key=ranks.get)
    prefix = frozenset(by_rank[t] for t, _, _ in index)
    scan = _scans(ranks, prefix, max((s[2] for s in sets), default=1))
    block = "array<struct<places:array<int>,ranks:array<int>>>"
    scanned = stage(binary.mapInArrow(scan, f"row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks {block}"), "scanned")
    sizes = spark.createDataFrame(rows, "template int, size int, need int")
    prefixes = spark.createDataFrame(index, "token int, template int, at int").join(sizes, "template")
    blocks = scanned.select("row", F.posexplode("blocks").alias("block", "b")).select("row", "block", "b.places", "b.ranks").withColumn("held", F.array_sort(F.array_distinct("ranks")))
    probes = blocks.select("row", "block", F.size("held").alias("n"), F.posexplode("held").alias("place", "token"))
    pairs = probes.join(prefixes, "token").filter((F.col("n") >= F.col("need")) & (F.least(F.col("size") - F.col("at"), F.col("n") - F.col("place")) >= F.col("need")))
    pairs = pairs.groupBy("row", "block").agg(F.collect_set("template").alias("templates"))
    verified = blocks.join(pairs, ["row", "block"]).select("row", "places", "ranks", "templates").mapInArrow(_verified(notices), "row long, labels array<string>, best double")
    matched = verified.groupBy("row").agg(F.flatten(F.collect_set("labels")).alias("found"), F.max("best").alias("best"))
    joined = scanned.join(matched, "row", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"],
        F.array_sort(F.array_union("base_labels", F.coalesce("found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
