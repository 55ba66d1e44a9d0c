"""Licences in documents, found by MinHash bands over overlapping windows of words.

Only DataFrame functions. A text becomes the hashes of its runs of three words; windows of five of these,
starting every three, are compared with windows of the notices. A band is one minimum, so two windows
whose sets have similarity s meet in one of the bands with probability 1 - (1 - s) ** bands: each
run of words of a notice lies in a window whose similarity to a listed one is 0.6 or more, and is missed
with probability 2e-5. A window retrieves the notices whose windows it met, and its runs are compared with
those notices': a notice counts if one stretch of the document, hardly longer than the notice, holds
enough of its runs. `SPDX-License-Identifier` tags are read beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, WIDTH, STRIDE, BANDS = 3, 5, 3, 12
# Share of a notice's runs that a stretch must hold, and the most notices and runs of them that are broadcast.
CONTAINED, MOST_NOTICES, MOST_RUNS = 0.8, 500, 20_000
# A stretch is longer than the notice by this share, or by so many runs if that is more.
SLACK, LEAST_SLACK = 0.25, 2

# Wordings of public licences. The SPDX name, or that of the family where the wording leaves the
# version open, stands before the slash.
_WARRANTY = ("without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
             "{name}General Public License for more details.")
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.")
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."),
    "Apache-2.0/terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    "MIT": "Released under the MIT License.",
    "MIT/distributed": "Distributed under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "0BSD/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    "BSD/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "BSD/conditions": _BSD_CONDITIONS,
    "BSD-3-Clause/third": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL/grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "GPL/warranty": _WARRANTY.format(name=""),
    "GPL-2.0-or-later/header": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version."),
    "GPL-2.0-only/header": (
        "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    "GPL-3.0-or-later/header": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."),
    "LGPL/warranty": _WARRANTY.format(name="Lesser "),
    "LGPL-2.1-or-later/header": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0-or-later/header": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0-or-later/header": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL/warranty": _WARRANTY.format(name="Affero "),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0/file": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0/header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "EPL-1.0/header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "BSL-1.0/header": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib/text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    "Unlicense/text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    "CC0-1.0/statement": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0/work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0/work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0/work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
}
_NAME = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
# A tag's first name, and those joined to the name before by AND or OR; an exception behind WITH is passed over.
TAG = (r"(?:(?i:SPDX-License-Identifier):[ \t(]*|(?!\A)\G[ \t)]+(?:AND|OR)[ \t(]+)"
       rf"({_NAME})(?:[ \t]+WITH[ \t]+{_NAME})?")


def runs_of(text: Column) -> Column:
    """Hashes of the runs of three words, in order. Words are lower-cased; ASCII signs part them."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-/:-@\[-`{-\x7f]+"), lambda w: w != "")

    def hashed(ws: Column) -> Column:
        last = F.size(ws) - SHINGLE
        return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                        lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(SHINGLE)])))
    return F.transform(F.array(words), hashed)[0]


def windows_of(text: Column) -> Column:
    """The windows of a text: where each starts and its `WIDTH` runs, those beyond the end null. Only windows
    leave the expression: to carry the runs beside them would copy all for each."""
    def cut(runs: Column) -> Column:
        last = F.floor((F.size(runs) - 1) / STRIDE).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.struct(
            (k * STRIDE).alias("start"), *[F.get(runs, k * STRIDE + i).alias(f"r{i}") for i in range(WIDTH)]))
    return F.transform(F.array(runs_of(text)), cut)[0]


def _seed(band: int) -> int:
    return ((band + 1) * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63)


def minimum(runs: list[Column], band: int) -> Column:
    """The smallest of the runs under the band's order; null runs do not count."""
    return F.least(*[r.bitwiseXOR(F.lit(_seed(band))) for r in runs])


def array_minimum(window: str, band: int) -> Column:
    return F.array_min(F.transform(window, lambda r: r.bitwiseXOR(F.lit(_seed(band)))))


def notice_table(spark: SparkSession, notices: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(sorted((notices or NOTICES).items()), "license string, notice string")


def _notice_windows(listed: DataFrame) -> DataFrame:
    """Windows of the notices: all of `WIDTH` runs, and shorter ones at both ends."""
    n = F.size("runs")
    cuts = F.concat(
        F.transform(F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))), lambda i: F.slice("runs", i + 1, WIDTH)),
        *[F.array(F.slice("runs", 1, k), F.slice("runs", F.greatest(n - k, F.lit(0)) + 1, k))
          for k in range(SHINGLE, WIDTH)])
    return listed.select("license", F.explode(cuts).alias("window"))


def _kin(listed: DataFrame) -> DataFrame:
    """`license, kin`: the notices that share at least half of a notice's runs."""
    runs = listed.select("license", F.explode(F.array_distinct("runs")).alias("run"),
                         F.size(F.array_distinct("runs")).alias("n")).distinct()
    shared = (runs.join(runs.select(F.col("license").alias("other"), "run"), "run").filter("license <> other")
              .groupBy("license", "other", "n").agg(F.count("*").alias("shared")).filter("2 * shared >= n"))
    return shared.groupBy("license").agg(F.collect_set("other").alias("kin"))


def _most_in_a_stretch(hits: Column, span: Column) -> Column:
    """The most distinct runs among hits (`at`, `run`) that start within `span` runs of one another."""
    return F.array_max(F.transform(hits, lambda first: F.size(F.array_distinct(F.transform(
        F.filter(hits, lambda h: (h["at"] >= first["at"]) & (h["at"] < first["at"] + span)), lambda h: h["run"])))))


def tags(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, spdx`: the licences that a document's `SPDX-License-Identifier` tags name, once each."""
    text = F.col(text_col).cast("string")
    return (docs.filter(F.col(id_col).isNotNull() & F.contains(F.lower(text), F.lit("spdx-license-identifier")))
            .select(F.col(id_col).cast("long").alias("doc_id"),
                    F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TAG), 1))).alias("spdx")).distinct())


def scan(docs: DataFrame, notices: DataFrame | None = None, *, id_col: str = "doc_id",
         text_col: str = "text", contained: float = CONTAINED) -> DataFrame:
    """A row for each document and notice in it: `doc_id`, `license`, `spdx`, `containment`, `n_runs`, `n_found`,
    `closest`.

    `containment` is the largest share of the notice's distinct runs of three words that one stretch of the
    document holds, as far as its windows were retrieved; rows have `contained` of it or more. A stretch has
    the notice's number of runs and `SLACK` more, so words scattered over a text are no notice. `spdx` is what
    stands before the slash in `license`. `closest` is false where a notice that shares half of this one's runs
    has more of its own in the document, as version 3 of a header beside version 2. A tag is a row with the
    `license` "NAME/tag" and without numbers of runs; tags are read where `notices` is not given.

    `notices` has `license` and `notice`: at most `MOST_NOTICES` of five words or more each with `MOST_RUNS` runs
    in all, which is checked. Null, empty and short texts hold no notice; rows without an id are left out; of
    rows that repeat an id each text is searched apart and the best counts. Notices that are equal are found
    together; of notices that repeat a name all runs count. Either table may be empty: then there is no row.
    """
    own = notices is None
    notices = notice_table(docs.sparkSession) if own else notices
    listed = notices.filter("notice is not null").select("license", runs_of(F.col("notice")).alias("runs"))
    checks = listed.agg(F.count("*").alias("n"), F.min(F.size("runs")).alias("least"),
                        F.sum(F.size("runs")).alias("all_runs")).first()
    if checks["n"] > MOST_NOTICES or (checks["all_runs"] or 0) > MOST_RUNS:
        raise ValueError(f"more than {MOST_NOTICES} notices or {MOST_RUNS} runs of them")
    if checks["n"] and checks["least"] < SHINGLE:
        raise ValueError("a notice has fewer than five words")
    windows = _notice_windows(listed)
    met_by = windows.select("license", F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), array_minimum("window", b).alias("least")) for b in range(BANDS)])).alias("m")
        ).select("license", "m.*").distinct()
    bands = windows.select(*[array_minimum("window", b).alias(f"b{b}") for b in range(BANDS)]).collect()
    text = F.col(text_col).cast("string")
    cut = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("same"), F.inline_outer(windows_of(text)))
    columns = [F.col(f"r{i}") for i in range(WIDTH)]
    met = [minimum(columns, b).isin(sorted({row[b] for row in bands})) for b in range(BANDS)]
    found = cut.filter(reduce(Column.__or__, met) if bands else F.lit(False))
    retrieved = found.select("doc_id", "same", "start", F.array(*columns).alias("runs"), F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), minimum(columns, b).alias("least")) for b in range(BANDS)])).alias("m")
        ).select("doc_id", "same", "start", "runs", "m.*").join(F.broadcast(met_by), ["band", "least"])
    wanted = listed.groupBy("license").agg(
        F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"), F.sum(F.size("runs")).alias("length")).select(
        "license", F.explode("runs").alias("run"), F.size("runs").cast("long").alias("n_runs"),
        (F.col("length") + F.greatest(F.lit(LEAST_SLACK), F.ceil(F.col("length") * SLACK))).alias("span"))
    hits = (retrieved.select("doc_id", "same", "license", "start", F.posexplode("runs").alias("i", "run"))
            .join(F.broadcast(wanted), ["license", "run"])
            .select("doc_id", "same", "license", "n_runs", "span", (F.col("start") + F.col("i")).alias("at"), "run")
            .distinct())
    # Any stretch lies in one of the overlapping places of twice its length, so groups stay as small as notices.
    place = F.floor(F.col("at") / F.col("span"))
    held = (hits.withColumn("place", F.explode(F.array(place - 1, place)))
            .groupBy("doc_id", "same", "license", "n_runs", "span", "place")
            .agg(F.collect_list(F.struct("at", "run")).alias("hits"))
            .filter(F.size(F.array_distinct("hits.run")) >= contained * F.col("n_runs"))
            .groupBy("doc_id", "license", "n_runs")
            .agg(F.max(_most_in_a_stretch(F.col("hits"), F.col("span"))).cast("long").alias("n_found"))
            .withColumn("containment", F.col("n_found") / F.col("n_runs"))
            .filter(F.col("containment") >= contained))
    # A document has at most one row a notice here.
    beside = (held.join(F.broadcast(_kin(listed)), "license", "left").groupBy("doc_id").agg(
        F.collect_list(F.struct("license", "containment", "n_runs", "n_found", "kin")).alias("found")))
    closest = F.transform("found", lambda row: F.struct(
        row["license"].alias("license"), F.substring_index(row["license"], "/", 1).alias("spdx"),
        row["containment"].alias("containment"), row["n_runs"].alias("n_runs"), row["n_found"].alias("n_found"),
        (~F.exists("found", lambda other: F.coalesce(F.array_contains(row["kin"], other["license"]), F.lit(False))
                   & (other["containment"] > row["containment"]))).alias("closest")))
    by_notice = beside.select("doc_id", F.inline(closest))
    if not own:
        return by_notice
    return by_notice.unionByName(tags(docs, id_col=id_col, text_col=text_col).select(
        "doc_id", F.concat("spdx", F.lit("/tag")).alias("license"), "spdx", F.lit(1.0).alias("containment"),
        F.lit(None).cast("long").alias("n_runs"), F.lit(None).cast("long").alias("n_found"), F.lit(True).alias("closest")))
