"""Licence scans by sentences, in DataFrame functions only.

Texts are cut into sentences, which are normalised; known ones become
identifiers. Line ends separate sentences, but a known one may also run over
several lines, with or without comment marks: it starts and ends at a sentence's
end, a blank line or a line's end, and between its words lines may end. The
sequence of a document is then matched against ordered rules: a rule lists the identifiers that must follow each other,
with any number of other sentences in between. The sentences of a rule that
matched do not count again for a later one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# where a sentence ends: a mark and white space, or a line's end
END, END_TO = "([.!?;])[\\x20\\x09-\\x0D]+", "\n"

# Comment marks that would end a sentence or add a word to it; other marks vanish when words are normalised.
MARKS = "(?md)^[\\x20\\x09]*(?:[;!]+|rem|dnl)(?=[\\x20\\x09\\n]|$)"
# Steps from lower-case text to words and breaks (capitals, as the text has none): P at blank lines, H at sentence ends, S at line ends.
# A web address that stands alone on its line belongs to the words before it.
BREAKS = [
    ("\\r\\n", "\n"), (MARKS, ""), ("[.!?;][\\x20\\x09-\\x0D]+", "H"), ("\\n[^a-z0-9H]*\\n", "P"), ("[P\\n][^a-z0-9HP\\n]*(?=https?://)", "S"),
    ("\\n", "S"), ("[^a-z0-9HPS]+", " "), (" ?([HPS]) ?", "$1"),
]

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "apache_notice": "Licensed under the Apache License, Version 2.0.",
    "apache_notice_the_license": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache_compliance": "you may not use this file except in compliance with the License.",
    "apache_obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    "apache_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit_notice": "Released under the MIT License.",
    "mit_notice_licensed": "Licensed under the MIT License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to '
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:",
    "mit_condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_as_is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "gpl3_notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl_redistribute": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl_warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "cc_by_notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc_by_nc_notice": "Licensed under CC BY-NC 4.0.",
    "cc_by_sa_notice": "Licensed under CC BY-SA 4.0.",
    "cc0_notice": "Released into the public domain under CC0.",
    "unlicense_domain": "This is free and unencumbered software released into the public domain.",
    "mpl_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "reserved": "All rights reserved.",
}

# Rules in order of precedence; name, licence, sentences that follow each other.
RULES = [
    ("apache_header", "Apache-2.0", ["apache_notice_the_license", "apache_compliance", "apache_obtain", "apache_as_is", "apache_see"]),
    ("apache_header_short", "Apache-2.0", ["apache_notice_the_license", "apache_compliance"]),
    ("mit_text", "MIT", ["mit_grant", "mit_condition", "mit_as_is"]),
    ("isc_text", "ISC", ["isc_grant"]),
    ("bsd_3_text", "BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("bsd_2_text", "BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("gpl_3_later_header", "GPL-3.0-or-later", ["gpl_redistribute", "gpl_warranty"]),
    ("gpl_3_later_grant", "GPL-3.0-or-later", ["gpl_redistribute"]),
    ("apache_notice", "Apache-2.0", ["apache_notice"]),
    ("mit_notice", "MIT", ["mit_notice"]),
    ("mit_notice_licensed", "MIT", ["mit_notice_licensed"]),
    ("gpl_3_notice", "GPL-3.0-only", ["gpl3_notice"]),
    ("cc_by_notice", "CC-BY-4.0", ["cc_by_notice"]),
    ("cc_by_nc_notice", "CC-BY-NC-4.0", ["cc_by_nc_notice"]),
    ("cc_by_sa_notice", "CC-BY-SA-4.0", ["cc_by_sa_notice"]),
    ("cc0_notice", "CC0-1.0", ["cc0_notice"]),
    ("unlicense_text", "Unlicense", ["unlicense_domain"]),
    ("mpl_2_notice", "MPL-2.0", ["mpl_notice"]),
    ("all_reserved", "proprietary", ["reserved"]),
]

@dataclass(frozen=True)
class Rules:
    """Known sentences by identifier, and rules in order of precedence."""

    sentences: dict[str, str]
    rules: list[tuple[str, str, list[str]]]

    def __post_init__(self):
        for name, text in self.sentences.items():
            if re.search(END, text):
                raise ValueError(f"{name} is more than one sentence")
        for name, _, needs in self.rules:
            if not needs or not set(needs) <= set(self.sentences):
                raise ValueError(f"rule {name} needs known sentences")

    def codes(self) -> dict[str, str]:
        """Two letters per identifier, for sequences as text."""
        return {k: LOWER[n // 26] + LOWER[n % 26] for n, k in enumerate(self.sentences)}

    def known(self) -> dict[str, str]:
        """Code by normalised sentence."""
        codes = self.codes()
        return {plain(text): codes[k] for k, text in self.sentences.items()}

    def pattern(self, needs: list[str]) -> str:
        codes = self.codes()
        return "(" + ")(.*?)(".join(f"<{codes[k]}>" for k in needs) + ")"

    def rest(self, needs: list[str], group: str = "$") -> str:
        """What stays of a sequence where the rule matched: what stood in between."""
        return "".join(f"{group}{2 * (k + 1)}" for k in range(len(needs) - 1))


RULES_OF_NOTICES = Rules(SENTENCES, RULES)


def plain(text: str) -> str:
    """A sentence in normal form: a-z and 0-9, everything else one space."""
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    return " ".join("".join(c if c in LOWER or c in "0123456789" else " " for c in lowered).split())


def sentence_count(text: Column) -> Column:
    """Number of sentences with a letter or digit, cut at every line's end."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), END, "$1" + END_TO), "\n")
    normal = F.transform(lines, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))
    return F.size(F.filter(normal, lambda s: s != ""))


def known_sentences(text: Column, rules: Rules) -> Column:
    """The known sentences in order, in normal form but with S where a line ends inside."""
    words = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for pattern, to in BREAKS:
        words = F.regexp_replace(words, pattern, to)
    # of two that start alike, the longer one
    known = "|".join(s.replace(" ", "[ S]+") for s in sorted(rules.known(), key=len, reverse=True) if s) or "(?!)"
    return F.regexp_extract_all(F.concat(F.lit("H"), F.trim(words), F.lit("H")), F.lit(f"(?<=[HPS])(?:{known})(?=[HPS])"), 0)


def scan_licenses(docs: DataFrame, rules: Rules = RULES_OF_NOTICES, text: str = "text") -> DataFrame:
    """``docs`` with n_sentences, n_known, found_rules and licenses (arrays in order of the rules).

    n_sentences counts lines as sentences of their own, except the lines of one
    known sentence. A rule counts once per document. A text that is null or has no sentence has
    zeros and empty arrays. Columns of ``docs`` named like a result are
    replaced.
    """
    docs = docs.drop("n_sentences", "n_known", "found_rules", "licenses", "_known", "_left", "_hits")
    docs = docs.withColumn("_known", known_sentences(F.col(text), rules))
    known = rules.known()
    names, codes = F.lit(list(known)), F.lit(list(known.values()))
    code = lambda s: F.get(codes, F.array_position(names, F.regexp_replace(s, "[ S]+", " ")).cast("int") - 1)
    joined = F.aggregate("_known", F.lit(0), lambda n, s: n + F.size(F.split(s, "S+")) - 1)
    # only known sentences are kept in the sequence: a rule allows others in between
    docs = docs.select(
        "*", (sentence_count(F.col(text)) - joined).cast("long").alias("n_sentences"), F.size("_known").cast("long").alias("n_known"),
        F.array_join(F.transform("_known", lambda s: F.concat(F.lit("<"), code(s), F.lit(">"))), "").alias("_left"),
    )
    # rules take turns on what the rules before have left of the sequence
    state = F.struct(F.col("_left").alias("left"), F.array().cast("array<int>").alias("hits"))
    table = F.array(*(
        F.struct(F.lit(k).alias("k"), F.lit(rules.pattern(needs)).alias("p"), F.lit(rules.rest(needs)).alias("r"))
        for k, (_, _, needs) in enumerate(rules.rules)
    ))
    turn = lambda s, rule: F.when(
        F.rlike(s["left"], rule["p"]),
        F.struct(F.regexp_replace(s["left"], rule["p"], rule["r"]).alias("left"), F.concat(s["hits"], F.array(rule["k"])).alias("hits")),
    ).otherwise(s)
    hits = F.when(F.col("_left") == "", F.array().cast("array<int>")).otherwise(F.aggregate(table, state, turn, lambda s: s["hits"]))
    docs = docs.withColumn("_hits", hits)
    rule_names, licences = F.lit([r[0] for r in rules.rules]), F.lit([r[1] for r in rules.rules])
    return docs.withColumns({
        "found_rules": F.transform("_hits", lambda k: F.get(rule_names, k)),
        "licenses": F.array_distinct(F.transform("_hits", lambda k: F.get(licences, k))),
    }).drop("_known", "_left", "_hits")
