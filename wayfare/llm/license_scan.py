"""Licence scans: canonical texts are digested and looked up among known licence digests.

A unit is a whole text, or one line of it (``kind`` tells which). Its canonical
form is lower case with equivalent spellings unified, copyright lines removed,
and every run of other characters than letters and digits turned into one blank.
Units meet the known digests in an equi-join on SHA-256, so equal means equal as
a whole; the known table is part of the package (wordings here, longer whole texts
in ``licenses``) and its size is checked before it is broadcast. Null and empty texts have no unit that matches; repeated rows and
null doc_ids are carried along; only doc_id and text are read. All work is done
by built-in functions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import text_of

# Wordings of public licence notices and of short public licences.
KNOWN: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License 2.0",
        "Released under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License",
        "This project is licensed under the MIT License",
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License v3",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC0-1.0": ("Released under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"),
    "ISC": (
        "SPDX-License-Identifier: ISC",
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause",),
    "BSD-3-Clause": ("SPDX-License-Identifier: BSD-3-Clause", "Released under the 3-Clause BSD License"),
    "MPL-2.0": ("SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
}
# Titles that may stand above a whole text.
TITLES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'),
}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# Spellings that mean the same in licence texts; the first becomes the second.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("licensor's", "licensors"),
    ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("non-commercial", "noncommercial"),
    ("sub-license", "sublicense"),
    ("whilst", "while"),
)
#: Lines of a copyright note: a year or a sign must follow, so that prose about copyright stays.
COPYRIGHT_LINE = r"(?md)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*(?:\(c\)|©|\d{4})[^\n]*$"
MAX_KNOWN = 10_000


def canonical(text: Column) -> Column:
    """Canonical form; line ends survive, so a text can be cut into lines afterwards."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def flat(unit: Column) -> Column:
    """A canonical unit on one line."""
    return F.trim(F.regexp_replace(unit, r"[ \n]+", " "))


def digest(flat_unit: Column) -> Column:
    return F.sha2(flat_unit.cast("binary"), 256)


def known_wordings() -> dict[str, tuple[str, ...]]:
    """KNOWN with the whole texts of the package, and the usual forms of whole texts.

    Forms: below a title, with all rights reserved, with bullets for numbers of
    clauses (BSD), without what follows the terms, with either scheme in addresses.
    """
    out: dict[str, list[str]] = {name: list(wordings) for name, wordings in KNOWN.items()}
    for file in sorted(files("wayfare.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt").removesuffix(".regents"), file.read_text("utf-8")
        forms = [text]
        if END_OF_TERMS in text:
            terms = text[: text.index(END_OF_TERMS)]
            forms += [terms, terms + END_OF_TERMS]
        if name.startswith("BSD"):
            forms.append(re.sub(r"(?m)^\s*\d\. ", "* ", text))
        forms += [f.replace("https://", "http://") for f in forms] + [f.replace("http://", "https://") for f in forms]
        out.setdefault(name, []).extend(forms)
    for name, titles in TITLES.items():
        whole = [w for w in out[name] if "\n" in w]
        whole += [f"All rights reserved.\n{w}" for w in whole]
        out[name] += [f"{title}\n{w}" for title in ("", *titles) for w in whole]
    return {name: tuple(wordings) for name, wordings in out.items()}


def known_digests(spark: SparkSession, known: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """license, digest: one row per known wording."""
    table = known_wordings() if known is None else known
    pairs = sorted({(name, wording) for name, wordings in table.items() for wording in wordings})
    if len(pairs) > MAX_KNOWN:
        raise ValueError(f"{len(pairs)} known wordings; at most {MAX_KNOWN} are broadcast")
    frame = spark.createDataFrame(pairs, "license string, wording string")
    return frame.select("license", flat(canonical(F.col("wording"))).alias("f")).where("f != ''").select("license", digest(F.col("f")).alias("digest")).distinct()


def license_units(docs: DataFrame, known: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """doc_id, kind (``text`` or ``line``), line (from 0; null for texts), license: every unit that is a known licence.

    Lines of a text that is a licence as a whole are looked up as well.
    """
    prepared = docs.select("doc_id", canonical(text_of()).alias("c"))
    units = F.concat(
        F.array(F.struct(F.lit(None).cast("int").alias("line"), flat(F.col("c")).alias("f"))),
        F.transform(F.split("c", "\n"), lambda x, i: F.struct(i.alias("line"), flat(x).alias("f"))),
    )
    rows = prepared.select("doc_id", F.explode(F.filter(units, lambda u: u["f"] != "")).alias("u"))
    digested = rows.select("doc_id", "u.line", digest(F.col("u.f")).alias("digest"))
    kind = F.when(F.col("line").isNull(), "text").otherwise("line").alias("kind")
    return digested.join(F.broadcast(known_digests(docs.sparkSession, known)), "digest").select("doc_id", kind, "line", "license")


def license_scan(docs: DataFrame, known: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per doc_id with a licence: text_license (of the whole text, else null), licenses (sorted, blank-separated), n_lines.

    Rows that share a doc_id are pooled. Only matches are shuffled, and they are counted before that.
    """
    found = license_units(docs, known)
    return found.groupBy("doc_id").agg(
        F.min(F.when(F.col("kind") == "text", F.col("license"))).alias("text_license"),
        F.array_join(F.array_sort(F.collect_set("license")), " ").alias("licenses"),
        F.count(F.when(F.col("kind") == "line", F.lit(1))).alias("n_lines"),
    )
