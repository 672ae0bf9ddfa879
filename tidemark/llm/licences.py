"""Licence scan by sentence rules, with DataFrame and SQL functions only.

A text is cut into sentences; each is normalised to lower-case words and looked up in a
table of known licence sentences.  A document's identifiers, in text order, are then
matched against licence rules in their order: a rule is a run of identifiers, and what
an earlier rule has matched is no longer there for a later one, so a long licence is
not also reported as the shorter one that it contains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import once

# Sentences of public licences, by identifier.
SENTENCES = [
    ("mit-name", "Released under the MIT License."),
    ("mit-name", "Licensed under the MIT License."),
    ("mit-name", "This project is licensed under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd3-name", "Licensed under the BSD 3-Clause License."),
    ("apache2-name", "Licensed under the Apache License, Version 2.0."),
    ("apache2-grant", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at"),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-warranty", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache2-terms", "See the License for the specific language governing permissions and limitations under the License."),
    ("gpl2-name", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl3-name", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl2-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl3-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl3-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl-terms", "See the GNU General Public License for more details."),
    ("mpl2-grant", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-name", "Licensed under CC BY 4.0."),
    ("cc-by-sa-name", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-name", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-nd-name", "Licensed under CC BY-NC-ND 4.0."),
    ("cc0-name", "Licensed under CC0 1.0 Universal."),
    ("reserved", "All rights reserved."),
]

# Licence rules in order; the first that matches takes its identifiers.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache2-grant", "apache2-copy", "apache2-warranty", "apache2-terms"]),
    ("Apache-2.0", ["apache2-grant"]),
    ("GPL-3.0-or-later", ["gpl3-or-later", "gpl-warranty", "gpl-terms"]),
    ("GPL-3.0-or-later", ["gpl3-or-later"]),
    ("GPL-2.0-or-later", ["gpl2-or-later", "gpl-warranty", "gpl-terms"]),
    ("GPL-2.0-or-later", ["gpl2-or-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-or-later"]),
    ("MPL-2.0", ["mpl2-grant"]),
    ("MIT", ["mit-name"]),
    ("BSD-3-Clause", ["bsd3-name"]),
    ("Apache-2.0", ["apache2-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-name"]),
    ("CC0-1.0", ["cc0-name"]),
]

_ENDS = r"(?<=[.!?])\s+|\n\s*\n"
_OTHER = r"[^\p{L}\p{N}]+"


def normalised(sentence: Column) -> Column:
    """Lower-case words with single spaces."""
    return F.trim(F.regexp_replace(F.lower(sentence), _OTHER, " "))


def _sentences(text: Column) -> Column:
    """Stretches up to the end of a sentence or paragraph.

    A known sentence may hold a line break, and may follow a heading without a full
    stop; so each stretch up to a sentence or paragraph end is looked up whole and, if it
    has line breaks, line by line.
    """
    return F.split(F.coalesce(text, F.lit("")), _ENDS)


def _known(spark) -> DataFrame:
    rows = spark.createDataFrame(SENTENCES, "identifier string, sentence string")
    cut = rows.select("identifier", F.posexplode(_sentences(F.col("sentence"))).alias("i", "part"))
    # A known sentence that is cut inside stands for its first part, the longest run of
    # words that identifies it; the parts after it are passed over.
    first = cut.where("i = 0").select("identifier", normalised(F.col("part")).alias("key"))
    return first.where("key != ''").groupBy("key").agg(F.min("identifier").alias("identifier"))


def licence_sentences(docs: DataFrame) -> DataFrame:
    """``(doc_id, i, j, identifier)``: the known sentences of each document, in text order."""
    parts = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.posexplode(_sentences(F.col("text"))).alias("i", "part")
    )
    whole = F.array(F.struct(F.lit(-1).alias("j"), F.col("part").alias("raw")))
    by_line = F.transform(
        F.split("part", "\n"), lambda raw, j: F.struct(j.alias("j"), raw.alias("raw"))
    )
    readings = F.when(F.contains("part", F.lit("\n")), F.concat(whole, by_line)).otherwise(whole)
    read = parts.select("doc_id", "i", F.explode(readings).alias("r"))
    keyed = read.select("doc_id", "i", "r.j", normalised(F.col("r.raw")).alias("key"))
    # A fixed table of a few dozen rows.
    return keyed.join(F.broadcast(_known(docs.sparkSession)), "key").drop("key")


def _matched(sequence: Column) -> Column:
    """Licences whose rule matches, in rule order."""
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in ids)).alias("run"))
            for name, ids in RULES
        ]
    )
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["run"])
        return F.struct(
            F.replace(state["left"], rule["run"], F.lit("#")).alias("left"),
            F.when(hit, F.array_append(state["found"], rule["name"]))
            .otherwise(state["found"])
            .alias("found"),
        )

    return F.array_distinct(F.aggregate(rules, start, step)["found"])


def licence_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, identifiers, licences)`` of the documents with a known licence sentence.

    ``identifiers`` are joined by spaces in text order, ``licences`` by commas in rule
    order; no rule may match ("All rights reserved" names no licence).  Null and
    empty texts and null ids give no row; rows that share a doc_id count as one document.
    Other columns are not looked at; an empty table gives no rows.
    """
    found = licence_sentences(docs).groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.struct("i", "j", "identifier"))).alias("places")
    )
    ids = F.transform("places", lambda p: p["identifier"])
    listed = found.select("doc_id", ids.alias("ids"))
    sequence = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    licences = once(sequence, _matched)
    return listed.select(
        "doc_id",
        F.array_join("ids", " ").alias("identifiers"),
        F.array_join(licences, ",").alias("licences"),
    )
