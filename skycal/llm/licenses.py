"""Licence scan by sentence rules: normalised sentences become identifiers, identifier sequences match rules.
Built-in functions only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Sentences of licence texts and notices, with identifiers of our own.
SENTENCES = {
    "apache-notice": ["Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
                      "This project is licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "apache-obtain": ["You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-url": ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-unless": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
                      "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "apache-without": ["WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License"],
    "mit-notice": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
                   "SPDX-License-Identifier: MIT", "The MIT License", "MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-include": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "as-is-software": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "gpl3-notice": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
                    "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl2-notice": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
                    "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl-see": ["See the GNU General Public License for more details"],
    "lgpl-notice": ["This work is licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"],
    "mpl-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0",
                    "SPDX-License-Identifier: MPL-2.0"],
    "mpl-obtain": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"],
    "bsd-notice": ["Licensed under the BSD License", "Released under the BSD License", "SPDX-License-Identifier: BSD-3-Clause"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0"],
    "cc0": ["Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "all-rights": ["All rights reserved"],
}

# Identifier sequences in the order in which they are tried, and the licence that each tells.
RULES = [
    (["apache-notice", "apache-obtain", "apache-url", "apache-unless", "apache-without", "apache-see"], "Apache-2.0"),
    (["apache-notice", "apache-obtain", "apache-unless", "apache-without", "apache-see"], "Apache-2.0"),
    (["apache-notice", "apache-obtain", "apache-unless", "apache-see"], "Apache-2.0"),
    (["mit-notice", "mit-grant", "mit-include", "as-is-software"], "MIT"),
    (["mit-grant", "mit-include", "as-is-software"], "MIT"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"], "BSD-3-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary"], "BSD-2-Clause"),
    (["gpl-free", "gpl-hope", "gpl-see"], "GPL-3.0-or-later"),
    (["gpl2-free", "gpl-hope", "gpl-see"], "GPL-2.0-or-later"),
    (["mpl-subject", "mpl-obtain"], "MPL-2.0"),
    (["apache-notice"], "Apache-2.0"),
    (["mit-notice"], "MIT"),
    (["mit-grant"], "MIT"),
    (["gpl3-notice"], "GPL-3.0"),
    (["gpl2-notice"], "GPL-2.0"),
    (["gpl-free"], "GPL-3.0-or-later"),
    (["gpl2-free"], "GPL-2.0-or-later"),
    (["lgpl-notice"], "LGPL-3.0"),
    (["mpl-subject"], "MPL-2.0"),
    (["bsd-notice"], "BSD-3-Clause"),
    (["bsd-grant"], "BSD"),
    (["cc-by"], "CC-BY-4.0"),
    (["cc-by-sa"], "CC-BY-SA-4.0"),
    (["cc-by-nc"], "CC-BY-NC-4.0"),
    (["cc-by-nc-nd"], "CC-BY-NC-ND-4.0"),
    (["cc0"], "CC0-1.0"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = "\x01"
MARKS = r"(^|\n)[ \t]*(//+|#+|\*+|/\*+|--+|;+|>+|%+)[ \t]*"       # comment signs that begin a line
WRAP = r"[ \t]*\r?\n[ \t]*([a-z0-9(])"                             # a line that goes on with the sentence
STOP = r"[.!?][.!?\"')]*[ \t\r\n\f]+"                                # the end of a sentence
LINE = r"[\r\n]+"
# Only here, not in the SQL: list numbers, and known sentences that go on in the next line whatever its case.
LISTED = r"(:[ \t]*)\r?\n[ \t]*\(?(?:[0-9]{1,3}|[A-Za-z])[.)][ \t]+"     # a list begins after a colon
MARKER = r"^[ \t]*\(?(?:[0-9]{1,3}|[A-Za-z])\)[ \t]+"                     # 1) or (a) before a sentence
NUMBER = r"^([0-9]{1,3}|[a-z])?$"                                      # nothing but a list number or a bullet


def normalised(sentence: str) -> str:
    """What the scan makes of one sentence."""
    return re.sub(r"[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" ")


def known_sentences() -> list[tuple[str, str]]:
    return sorted((normalised(s), i) for i, forms in SENTENCES.items() for s in forms)


def broken_pattern() -> str:
    """A known sentence between breaks, with line ends between its words but no blank line. Shorter ones come first: what
    ends with a line is not joined to the next."""
    gap = "(?:[^A-Za-z0-9\x01\r\n]+|[^A-Za-z0-9\x01\r\n]*\r?\n[^A-Za-z0-9\x01\r\n]*)"
    forms = "|".join(s.replace(" ", gap) for s in sorted({s for s, _ in known_sentences()}, key=lambda s: (len(s), s)))
    edge = "[^A-Za-z0-9\x01\r\n]*"
    return f"(?i)(?:^|[\x01\r\n]){edge}(?:(?:[0-9]{{1,3}}|[a-z])\\)[ \\t]+)?({forms})(?={edge}(?:[\x01\r\n]|$))"


def _rule_text(ids: list[str]) -> str:
    return "".join(f"{i} " for i in ids)


def rule_pattern() -> str:
    """Rules in their order, else one identifier; an identifier is never cut."""
    return "(" + "|".join(_rule_text(ids) for ids, _ in RULES) + "|[a-z0-9-]+ )"


def _fixed(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    return spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(r, names))) for r in rows))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per rule that matches in a document: id, license, rule (its identifiers), run_start (number, from 0,
    of the sentence that begins the run of known sentences), place (of the match among those of the run),
    sentences (in the rule).

    Sentences end at . ! ? before white space and at line ends, unless the next line goes on in lower case or with
    the rest of a known sentence. Comment signs, case, punctuation and list numbers don't count, though a list
    number has a place in run_start. A match needs consecutive sentences; in a run the first
    rule of the list that fits is taken, then what follows it. Null and empty texts and texts without licence
    sentences give no row; repeated rows give theirs again. Sentences are met with a fixed table of a few
    dozen; what is grouped afterwards is one run of one document."""
    spark = docs.sparkSession
    known = _fixed(spark, known_sentences(), ["sentence", "sid"])
    rules = _fixed(spark, [(_rule_text(ids), name, len(ids)) for ids, name in RULES], ["rule", "license", "sentences"])
    text = F.regexp_replace(F.col(text_col), MARKS, "\n")
    text = F.regexp_replace(text, LISTED, f"$1{BREAK}")
    text = F.regexp_replace(text, WRAP, " $1")
    text = F.regexp_replace(text, STOP, BREAK)
    broken = F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(broken_pattern()), F.lit(1)), lambda s: s.contains("\n")))
    text = F.aggregate(broken, text, lambda all_, s: F.replace(all_, s, F.translate(s, "\r\n", "  ")))
    text = F.regexp_replace(text, LINE, BREAK)
    numbered = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.split(text, BREAK).alias("parts"))
    split = numbered.select("id", "row", F.posexplode("parts").alias("pos", "raw"))
    plain = F.trim(F.regexp_replace(F.translate(F.regexp_replace("raw", MARKER, ""), UPPER, LOWER), "[^a-z0-9]+", " "))
    # parts that are only a number do not separate the sentences around them
    met = split.select("id", "row", "pos", F.when(F.length("raw") >= 3, plain).alias("sentence"), plain.rlike(NUMBER).alias("number")).join(
        F.broadcast(known), "sentence", "left").where("sid IS NOT NULL OR number")
    order = Window.partitionBy("row").orderBy("pos")
    runs = (met.withColumn("run", F.col("pos") - F.row_number().over(order)).where("sid IS NOT NULL").groupBy("id", "row", "run")
            .agg(F.min("pos").alias("run_start"), F.array_sort(F.collect_list(F.struct("pos", "sid"))).alias("found")))
    matches = runs.select("id", "run_start", F.posexplode(F.regexp_extract_all(
        F.concat(F.array_join("found.sid", " "), F.lit(" ")), F.lit(rule_pattern()), F.lit(1))).alias("place", "rule"))
    return matches.join(F.broadcast(rules), "rule").select(
        F.col("id").alias(id_col), "license", F.rtrim("rule").alias("rule"), "run_start", "place", "sentences")


def scan_sql(table: str = "documents") -> str:
    """The scan in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in known_sentences())
    rules = ", ".join(f"({quote(_rule_text(ids))}, {quote(name)}, {len(ids)})" for ids, name in RULES)
    return f"""
WITH known(sentence, sid) AS (VALUES {known}), rules(rule, license, sentences) AS (VALUES {rules}),
cut AS (SELECT doc_id, row_number() OVER () AS "row", string_split(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, {quote(MARKS)}, chr(10), 'g'), {quote(WRAP)}, ' \\1', 'g'),
    {quote(STOP)}, chr(1), 'g'), {quote(LINE)}, chr(1), 'g'), chr(1)) AS parts FROM {table} WHERE text IS NOT NULL),
each AS (SELECT doc_id, "row", unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS pos FROM cut),
met AS (SELECT doc_id, "row", pos, sid FROM (SELECT *, trim(regexp_replace(translate(raw, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' ')
        AS sentence FROM each) JOIN known USING (sentence)),
runs AS (SELECT doc_id, "row", min(pos) AS run_start, string_agg(sid || ' ', '' ORDER BY pos) AS ids FROM
         (SELECT *, pos - row_number() OVER (PARTITION BY "row" ORDER BY pos) AS run FROM met) GROUP BY doc_id, "row", run),
found AS (SELECT doc_id, run_start, regexp_extract_all(ids, {quote(rule_pattern())}) AS m FROM runs),
placed AS (SELECT doc_id, run_start, unnest(m) AS rule, generate_subscripts(m, 1) - 1 AS place FROM found)
SELECT doc_id, license, rtrim(rule, ' ') AS rule, CAST(run_start AS INTEGER) AS run_start, CAST(place AS INTEGER) AS place, sentences
FROM placed JOIN rules USING (rule)
"""
