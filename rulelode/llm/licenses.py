"""License scans: Dice coefficient over word bigrams against licence templates.

A text is normalised to its runs of lower-case letters and digits. Each template is compared with the whole text and
with stretches of it: those that begin with one of the template's bigrams and end with the last one within the
template's length, or within the greatest length of the size bound. The coefficient is 2*I/(a+b) of the kinds of
bigrams of template and stretch. Templates are pruned per document by size bounds: 2*I/(a+b) >= t needs b between
a*t/(2-t) and a*(2-t)/t, and as b >= I, it needs I >= a*t/(2-t), so a document with fewer kinds of a template's bigrams
than that is never compared with it. Bodies of long licences can be given as files, see `read_templates`.

Overlapping matches keep the one of higher coefficient, then the longer, then the first in order of templates.
Defined results: null and empty texts match nothing; repeated rows match alike; extra columns are ignored; an
empty table gives an empty result. A very long text is walked in parts; memory goes with its words.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

THRESHOLD = 0.8

#: Public wording of licence notices and file headers, by SPDX identifier. The long licences have no body here.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3 of the License.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3 of the License. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
)

_WORD = np.zeros(256, bool)
_WORD[48:58] = True
_WORD[97:123] = True
_WORD[128:] = True


def bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, number in its row, words of each row) of the word bigrams of normalised texts."""
    buf, offs = tx.buffers(pc.utf8_lower(column))
    start, end = tx.runs(_WORD, buf, offs)
    first = np.searchsorted(start, offs)
    n = np.diff(first)
    if len(start) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), n
    h, g = tx.word_keys(buf, start, end)
    row = np.repeat(np.arange(len(n)), n)
    # Either word gives another one of its keys: a bigram is not mistaken for its reverse.
    two = tx.mix(h[:-1] * tx.U(0x9E3779B97F4A7C15) + g[1:])
    at = np.flatnonzero(row[1:] == row[:-1])
    return two[at], row[at], at - first[row[at]], n


class Matcher:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> None:
        self.names, self.threshold = [n for n, _ in templates], threshold
        self.sets, self.words, table = [], [], {}
        for i, (_, text) in enumerate(templates):
            h, _, _, n = bigrams(pa.array([text]))
            self.sets.append({int(x) for x in h})
            self.words.append(int(n[0]))
            for x in self.sets[-1]:
                table.setdefault(x, []).append(i)
        self.keys = np.array(sorted(table), np.uint64)
        self.owners = [table[int(x)] for x in self.keys]

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, int, float]]]:
        """For each row the matches (first word, end word, template, coefficient) by position."""
        h, row, number, n_words = bigrams(column)
        out: list[list] = [[] for _ in range(len(column))]
        k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[k] == h)
        if not len(hit):
            return out
        begin = np.flatnonzero(np.concatenate([[True], row[hit][1:] != row[hit][:-1]]))
        at = np.searchsorted(row, np.arange(len(column) + 1))
        for a, b in zip(begin, np.append(begin[1:], len(hit)), strict=True):
            r = int(row[hit[a]])
            own_row = h[at[r] : at[r + 1]]
            seen: dict[int, list[tuple[int, int]]] = {}
            for j, key in zip(number[hit[a:b]].tolist(), k[hit[a:b]].tolist(), strict=True):
                for t in self.owners[key]:
                    seen.setdefault(t, []).append((j, key))
            found, before = [], None
            for t, own in seen.items():
                size, kinds = len(self.sets[t]), len({key for _, key in own})
                if kinds < self._least(size):
                    continue
                if before is None:
                    order = np.argsort(own_row, kind="stable")
                    before = np.full(len(own_row), -1)
                    same = own_row[order][1:] == own_row[order][:-1]
                    before[order[1:][same]] = order[:-1][same]
                found += self._stretches(t, own, own_row, before)
                lo, hi = size * self.threshold / (2 - self.threshold), size * (2 - self.threshold) / self.threshold
                if len(own_row) >= lo:
                    whole = len(np.unique(own_row))
                    if lo <= whole <= hi and 2 * kinds >= self.threshold * (whole + size):
                        found.append((0, int(n_words[r]), t, 2 * kinds / (whole + size)))
            out[r] = apart(found)
        return out

    def _least(self, size: int) -> int:
        """Common bigrams without which no text reaches the threshold: 2 * i / (size + kinds) with kinds >= i."""
        return math.ceil(self.threshold * size / (2 - self.threshold) - 1e-9)

    def _stretches(self, t: int, own: list[tuple[int, int]], row: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int, float]]:
        """Of each place where a bigram of the template stands, the stretch of greatest coefficient that begins there.

        A stretch ends with a bigram of the template. It need not go on to where its first bigram stands again, as
        without the first one it would be as good; nor once it has more kinds of bigrams than the threshold allows.
        `before` has for each bigram of the row its last place before, or -1.
        """
        size, need = len(self.sets[t]), self._least(len(self.sets[t]))
        most = size * (2 - self.threshold) / self.threshold
        step = int(4 * most)
        place = np.array([p for p, _ in own])
        last: dict[int, int] = {}
        prior, onward = np.full(len(own), -1), np.full(len(own), len(own))
        for i, (_, key) in enumerate(own):
            if key in last:
                prior[i] = last[key]
                onward[last[key]] = i
            last[key] = i
        out = []
        for i, start in enumerate(place.tolist()):
            best, at, common, kinds, lo = 0.0, -1, 0, 0, i
            while lo < onward[i]:
                # Ends within some words more; counts of distinct bigrams go on from the words before.
                past = start if lo == i else int(place[lo - 1]) + 1
                hi = min(int(np.searchsorted(place, past + step, "right")), int(onward[i]))
                hi = max(hi, lo + 1)
                new = np.cumsum(prior[lo:hi] < i) + common
                seen = np.cumsum(before[past : place[hi - 1] + 1] < start) + kinds
                of = seen[place[lo:hi] - past]
                score = 2 * new / (of + size)
                k = int(score.argmax())
                if score[k] > best and new[k] >= need:
                    best, at = float(score[k]), lo + k
                common, kinds, lo = int(new[-1]), int(of[-1]), hi
                if kinds > most:
                    break
            if best >= self.threshold:
                out.append((start, int(place[at]) + 2, t, best))
        return out


def apart(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Of overlapping matches the one of higher coefficient, then the longer, then the first template, then the first place."""
    starts: list[int] = []
    taken: list[tuple[int, int, int, float]] = []
    for m in sorted(set(found), key=lambda m: (-m[3], m[0] - m[1], m[2], m[0])):
        i = bisect.bisect_left(starts, m[0])
        if (i == 0 or taken[i - 1][1] <= m[0]) and (i == len(starts) or m[1] <= starts[i]):
            starts.insert(i, m[0])
            taken.insert(i, m)
    return taken


def read_templates(spark: SparkSession, folder: str) -> tuple[tuple[str, str], ...]:
    """Templates beside TEMPLATES: the text files of a folder, each named by its licence (LICENCE.txt), whole."""
    files = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1).alias("name"), "value")
    return tuple((r["name"], r["value"]) for r in files.orderBy("name").collect())


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license (of the best match, or null), dice, n_matches, matches (array of license, first word, end word, dice)."""
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("dice", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch in batches:
            for part, _, _ in tx.pieces(batch, "text"):
                rows = matcher.scan(pc.fill_null(part.column("text"), ""))
                best = [max(m, key=lambda x: (x[3], x[1] - x[0], -x[2])) if m else None for m in rows]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([matcher.names[b[2]] if b else None for b in best], pa.string()),
                    pa.array([round(b[3], 9) if b else 0.0 for b in best]), pa.array([len(m) for m in rows], pa.int64()),
                    pa.array([[{"license": matcher.names[t], "start": s, "end": e, "dice": round(d, 9)} for s, e, t, d in m] for m in rows], kind),
                ], ["doc_id", "license", "dice", "n_matches", "matches"])

    return (
        ut.only(docs, doc_id="long", text="string")
        .mapInArrow(
            run, "doc_id long, license string, dice double, n_matches long, matches array<struct<license:string,start:long,`end`:long,dice:double>>",
        )
    )


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(ut.table(spark, sf_dir, "documents"))
