"""License scans: MinHash bands over text windows retrieve templates, exact containment verifies.

Texts and templates are words of letters and digits, lower case, in five-word shingles.  Templates
are cut into windows at every place, texts into overlapping windows; window sizes are 1, 4 and 16
shingles, and a template uses the largest that it fills at every offset to a text's steps.  Windows meet if a band of their MinHash
values is equal.  A template's windows stand at every place, so a text that holds one more
shingle run than a step holds an equal window, which meets in every band; windows of similarity s
meet with probability 1 - (1 - s^r)^b.  Retrieved templates are verified: the part of a template's
distinct shingles that the text holds must reach the threshold.

Templates are a parameter of bounded size (``MAX_KEYS`` band keys).  Defined cases: a null or empty
text, or one of fewer than five words, holds none; a row without doc_id is reported with null; rows
are judged one by one, so repeated rows give repeated results; a template of fewer than five words
is refused; a text of any length is one row's arrays of words and hashes; a containment equal to the threshold counts;
other columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

SHINGLE = 5
CONTAINED = 0.8
#: (shingles of a window, step, bands, rows of a band); a band key is exact for single shingles.
WINDOWS = [(1, 1, 1, 1), (4, 2, 4, 1), (16, 8, 6, 2)]
MAX_KEYS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices and headers of public licenses.
TEMPLATES = {
    "apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "mit notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "gpl-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "mpl-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "cc-by-nc-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")


def shingles(word: Column) -> Column:
    """Hashes of the shingles at every place of an array column of words."""
    n = F.size(word)
    at = lambda i: F.xxhash64(*[F.get(word, i + t) for t in range(SHINGLE)])
    return F.when(n < SHINGLE, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n - SHINGLE), at))


def _band_keys(df: DataFrame, column: str, size: int, step: int, bands: int, rows: int, out: str) -> DataFrame:
    """``out``: keys of all bands of the windows of ``size`` shingles, one every ``step`` and one at the end."""
    if size == 1:
        return df.withColumn(out, F.col(column))
    hashes = bands * rows
    for j in range(hashes):
        df = df.withColumn(f"__h{j}", F.transform(column, lambda h: F.xxhash64(h, F.lit(j))))  # noqa: B023
    n = F.size(column)
    starts = F.when(n < size, F.array().cast("array<int>")).otherwise(F.array_union(F.sequence(F.lit(1), n - size + 1, F.lit(step)), F.array(n - size + 1)))
    df = df.withColumn("__starts", starts)

    def band_keys(band: int) -> Column:
        least = lambda start: [F.array_min(F.slice(f"__h{band * rows + r}", start, size)) for r in range(rows)]
        return F.transform("__starts", lambda start: F.xxhash64(F.lit(size), F.lit(band), *least(start)))

    keys = F.flatten(F.array(*[band_keys(b) for b in range(bands)]))
    return df.withColumn(out, keys).drop("__starts", *[f"__h{j}" for j in range(hashes)])


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, shingles, size): distinct shingle hashes and the window size of each template."""
    listed = [F.struct(F.lit(k).alias("template"), F.lit(v).alias("text")) for k, v in sorted(templates.items())]
    table = spark.range(1).select(F.inline(F.array(*listed)))
    table = table.withColumn("places", shingles(words(F.col("text"))))
    size = F.lit(WINDOWS[0][0])
    for window, step, _, _ in WINDOWS[1:]:
        # Only from here on does every copy hold a whole window at one of a text's steps.
        size = F.when(F.size("places") >= window + step - 1, window).otherwise(size)
    checked = F.when(F.size("places") > 0, size).otherwise(F.raise_error(F.concat(F.lit("template too short: "), "template")))
    return table.withColumn("size", checked).withColumn("shingles", F.array_distinct("places"))


def _listed(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def scan(df: DataFrame, templates: dict[str, str] | None = None, text: str = "text", contained: float = CONTAINED) -> DataFrame:
    """doc_id, template, n_shared, containment: templates of which a text holds at least ``contained``."""
    table = stage(template_table(df.sparkSession, TEMPLATES if templates is None else templates), "templates")
    hits = df.select("doc_id", F.col(text).alias("text")).withColumn("__words", words(F.col("text"))).withColumn("__s", shingles(F.col("__words"))).drop("__words", "text")
    # A text that shares no shingle with any template holds none: its windows need no bands.
    listed = table.select(F.explode("shingles").alias("shingle")).distinct().limit(MAX_KEYS + 1).collect()  # bounded by the templates
    if len(listed) > MAX_KEYS:
        raise ValueError("templates have too many shingles")
    none = F.array().cast("array<bigint>")
    hits = hits.withColumn("__s", F.when(F.arrays_overlap("__s", _listed([r.shingle for r in listed])), F.col("__s")).otherwise(none))
    keys: dict[str, list[int]] = {}
    for size, step, bands, rows in WINDOWS:
        own = _band_keys(table.where(F.col("size") == size), "places", size, 1, bands, rows, "keys")
        # Bounded by the templates, which are a parameter.
        own = {r.template: r.keys for r in own.select("template", F.array_distinct("keys").alias("keys")).collect()}
        keys |= own
        every = sorted({k for ks in own.values() for k in ks})
        if len(every) > MAX_KEYS:
            raise ValueError("templates have too many band keys")
        # Windows of a text that meet no template go before any row is made of them.
        hits = _band_keys(hits, "__s", size, step, bands, rows, f"__k{size}").withColumn(f"__k{size}", F.array_intersect(f"__k{size}", _listed(every)))
    hits = hits.withColumn("__keys", F.concat(*[f"__k{size}" for size, *_ in WINDOWS]))
    # A row keeps its own list of retrieved templates, so that equal rows stay apart.
    met = [F.when(F.arrays_overlap("__keys", _listed(ks)), F.lit(name)) for name, ks in sorted(keys.items())]
    retrieved = F.array_compact(F.array(*met)) if met else F.array().cast("array<string>")
    hits = hits.select("doc_id", "__s", retrieved.alias("__t"))
    # The outer form: the optimizer would push a test for empty lists through all steps above and expand them.
    each = hits.select("doc_id", "__s", F.explode_outer("__t").alias("template")).where("template IS NOT NULL").join(F.broadcast(table.select("template", "shingles")), "template")
    each = each.withColumn("n_shared", F.size(F.array_intersect("shingles", "__s")).cast("long")).withColumn("containment", F.col("n_shared") / F.size("shingles"))
    return each.where(F.col("containment") >= contained).select("doc_id", "template", "n_shared", "containment")


def sql(templates: dict[str, str] | None = None, contained: float = CONTAINED) -> str:
    """The same rows in DuckDB, by comparing every text with every template."""
    listed = ", ".join("('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in sorted((templates or TEMPLATES).items()))
    cut = rf"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+') IF x <> '']"
    grams = "[array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 3, 1))]"
    return f"""
WITH templates(template, text) AS (VALUES {listed}),
parts AS (SELECT template, list_distinct({grams}) AS s FROM (SELECT template, {cut} AS w FROM templates)),
docs AS (SELECT doc_id, list_distinct({grams}) AS s FROM (SELECT doc_id, {cut} AS w FROM documents)),
pairs AS (SELECT doc_id, template, len(list_intersect(p.s, d.s)) AS n, len(p.s) AS size FROM docs d, parts p)
SELECT doc_id, template, CAST(n AS BIGINT) AS n_shared, n / size AS containment FROM pairs WHERE n / size >= {contained}
"""
