"""License texts in documents: MinHash bands over overlapping windows, then exact containment.

Texts become words (letters and digits, lower case) and five-word shingles. Windows of 8 and of 64
shingles, each overlapping the next by half, are summarised by ``BANDS`` minimum hashes of one row each.
Templates are cut into windows of the same sizes at every offset, so a document window inside a license text
meets a template window with the same words; with one row a band and similarity s the two collide with
probability 1 - (1 - s)^8, 0.996 at s = 0.5. Templates too short for such windows are met by single shingles,
which always collide. Collisions are combined by text and template; then each retrieved pair is verified: the share
of the template's different shingles that the whole text holds, wherever they stand, must reach ``containment``. All
of it is built-in expressions. The first pass moves hashes only; the second reads the texts again, keeps those that
were retrieved by a bitmap of fixed size, and moves these alone.

Defined results: NULL and empty texts match nothing. A text or template of fewer than five words is one shingle.
A template is reported once for each row, with its containment and the first word of the first of its shingles there.
Long texts are read whole; repeated rows and rows with the same id are matched each for itself, and a missing id is
kept. Of templates that tie, each is reported. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.functions import probably_in
from tontine.llm.common import narrow, stored

WORDS = 5
BANDS = 8
STEP = 4
SMALL, LARGE = 8, 64
#: Template keys beyond this number are not broadcast by hint.
BROADCAST_KEYS = 200_000

# Lines, notices and whole texts of public licenses.
TEMPLATES = (
    # Lines that name a license
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("MIT-line", "Released under the MIT License."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-line", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-line", "Licensed under the GNU Lesser General Public License."),
    ("AGPL-line", "Licensed under the GNU Affero General Public License."),
    ("MPL-2.0-line", "Licensed under the Mozilla Public License, version 2.0."),
    ("BSD-2-Clause-line", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause-line", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0-line", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-long-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0-long-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0-long-line", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    # Identifiers of five words or more
    ("Apache-2.0-SPDX", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause-SPDX", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause-SPDX", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0-SPDX", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0-SPDX", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC0-1.0-SPDX", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0-only-SPDX", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0-or-later-SPDX", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1-only-SPDX", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("MPL-2.0-SPDX", "SPDX-License-Identifier: MPL-2.0"),
    # Notices that stand in files
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    # Whole texts, in parts where files often have only one of them
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "MIT-warranty",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-warranty",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
        "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles_of(hashes: str) -> Column:
    """Hashes of shingles from the column of the words' hashes; of the whole if it is shorter; none if there
    are no words. The shifted copies keep the work linear: no place looks into the array anew."""
    n = F.greatest(F.size(hashes) - WORDS + 1, F.lit(1))
    shifted = F.arrays_zip(*[F.slice(hashes, i + 1, n).alias(f"w{i}") for i in range(WORDS)])
    return F.transform(shifted, lambda x: F.xxhash64(*[x[f"w{i}"] for i in range(WORDS)]))


def _numbers(n: Column) -> Column:
    """0 .. n - 1 for n of 1 or more; 0 otherwise."""
    return F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)


def _mask(band: int) -> int:
    """A fixed pseudo-random signed number for each band."""
    value = (band + 1) * 0x9E3779B97F4A7C15 % 2**64
    value = (value ^ (value >> 31)) * 0xBF58476D1CE4E5B9 % 2**64
    return value - 2**64 if value >> 63 else value


def minima(shingles: list[Column]) -> Column:
    """For each band the least of the shingles' hashes, each combined with the band's number. Missing
    shingles don't count."""
    return F.array(*[F.least(*[x.bitwiseXOR(F.lit(mask)) for x in shingles]) for mask in map(_mask, range(BANDS))])


def least_of(lows: list[Column]) -> Column:
    """Band by band, the least of several minima; missing ones don't count."""
    return F.array(*[F.least(*[F.get(low, F.lit(k)) for low in lows]) for k in range(BANDS)])


def band_keys(low: Column, size: int) -> Column:
    return F.transform(low, lambda x, k: F.xxhash64(F.lit(size), k, x))


def template_keys(templates: DataFrame) -> DataFrame:
    """``key, template, wanted, span``: the retrieval keys of templates (template, text)."""
    base = templates.select("template", hashes_of(words_of(F.col("text"))).alias("h"))
    base = base.select("template", shingles_of("h").alias("s"))
    base = stored(base, "templates").withColumn("span", F.size("s")).filter("span > 0")

    def windows(size: int) -> Column:
        return F.flatten(
            F.transform(_numbers(F.size("s") - size + 1), lambda o: band_keys(minima([F.get("s", o + i) for i in range(size)]), size))
        )

    keys = F.when(F.col("span") < SMALL, F.col("s")).when(F.col("span") < LARGE, windows(SMALL)).otherwise(windows(LARGE))
    return base.select("template", F.array_distinct("s").alias("wanted"), "span", F.explode_outer(F.array_distinct(keys)).alias("key"))


def default_templates(spark) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "template string, text string")


def scan(
    docs: DataFrame, templates: DataFrame | None = None, containment: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, template, containment, first_word`` of each row and each template found in it."""
    keys = stored(template_keys(templates if templates is not None else default_templates(docs.sparkSession)), "template-keys")
    if keys.count() <= BROADCAST_KEYS:
        # The shingles of all templates are no more than their keys.
        keys = F.broadcast(keys)
    texts = narrow(docs, id_col, text_col).withColumn("same", F.xxhash64("id", "text"))
    rows = texts.select("same", hashes_of(words_of(F.col("text"))).alias("h"))
    rows = rows.select("same", shingles_of("h").alias("s"))
    # Minima of blocks of STEP shingles, and of LARGE / 2; a window is two neighbouring blocks. Elements are
    # read by place, since a slice inside a lambda would copy the whole array each time.
    half = LARGE // 2 // STEP

    def parts(of: str, count: int, make: Callable[[list[Column]], Column]) -> Column:
        number = F.ceil(F.size(of) / count).cast("int")
        return F.transform(_numbers(number), lambda j: make([F.get(of, j * count + i) for i in range(count)]))

    def windows(of: str, size: int) -> Column:
        return F.flatten(
            F.transform(_numbers(F.size(of) - 1), lambda j: band_keys(least_of([F.get(of, j), F.get(of, j + 1)]), size))
        )

    rows = rows.withColumn("b", parts("s", STEP, minima))
    rows = rows.withColumn("c", parts("b", half, least_of))
    rows = rows.select("same", F.concat("s", windows("b", SMALL), windows("c", LARGE)).alias("keys"))
    # The outer form keeps the optimiser from repeating all of the above in a filter on empty arrays.
    met = rows.select("same", F.explode_outer("keys").alias("key")).join(keys.select("template", "key"), "key")
    # A text's matches are combined before they are moved: one short row for each text and template.
    met = met.groupBy("same", "template").agg(F.count("*").alias("met"))
    retrieved = stored(met.groupBy("same").agg(F.collect_set("template").alias("found")), "retrieved")
    # Only texts with a match are read into shingles again, whole, and only they are moved.
    again = probably_in(texts, retrieved, ["same"]).join(retrieved, "same")
    again = again.select("id", "found", hashes_of(words_of(F.col("text"))).alias("h"))
    again = again.select("id", shingles_of("h").alias("s"), F.explode("found").alias("template"))
    wanted = keys.select("template", "wanted").dropDuplicates(["template"])
    common = F.array_intersect("wanted", "s")
    verified = again.join(wanted, "template").select(
        F.col("id").alias("doc_id"), "template",
        (F.size(common) / F.size("wanted")).alias("containment"),
        (F.array_min(F.transform(common, lambda x: F.array_position("s", x))) - 1).alias("first_word"),
    )
    return verified.filter(F.col("containment") >= containment)
