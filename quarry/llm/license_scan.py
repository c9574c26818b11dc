"""Licence scan: known sentences become identifiers, identifier sequences meet ordered rules.

DataFrame functions only, row by row, without a shuffle. A text becomes its
words (ASCII lower case) with one mark between each two: an empty line, an
end mark before white space or after a list mark, a line break unless the next line goes
on in lower case, or a blank. Comment signs and indents are part of the mark. A
known sentence stands between two marks; line breaks may lie inside it, and
end marks where the published notice has them (``STOPS``). The known sentences
give their identifiers in order of appearance. A rule is an
ordered list of identifiers that must appear in that order, unknown sentences
between them allowed but no other rule's opening sentence. Where one rule's
list begins another's at the same sentence, the longest that matches is reported.

Only texts that hold a word every known sentence shares are cut at all; this
test is part of the sentence table (``TRIGGER``) and is checked by a test.
A ``*`` in a known sentence stands for a name. SPDX lines count where they give
one name alone, not an expression. Null and empty texts have no sentence, an
empty table no rows; texts are read whole; repeated rows get equal results.
Columns named ``sentence_ids`` and ``licences`` are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import let
from quarry.llm.common import ascii_lower, read
from quarry.llm.registry import query

# Known licence sentences: identifier -> normalised sentence (lower case, letters and digits, single spaces).
SENTENCES = {
    "mit_name": "the mit license mit",
    "mit_title": "mit license",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache_licensed": "licensed under the apache license version 2 0",
    "apache_the_license": "licensed under the apache license version 2 0 the license",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at",
    "apache_as_is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl2_licensed": "licensed under the gnu general public license version 2",
    "gpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_details": "see the gnu general public license for more details",
    "gpl_received": "you should have received a copy of the gnu general public license along with this program",
    "lgpl21_licensed": "licensed under the gnu lesser general public license version 2 1",
    "lgpl3_licensed": "licensed under the gnu lesser general public license version 3",
    "agpl3_licensed": "licensed under the gnu affero general public license version 3",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2_form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2_copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense_domain": "this is free and unencumbered software released into the public domain",
    "cc_by_nc_4": "licensed under cc by nc 4 0",
    "cc_by_4": "licensed under cc by 4 0",
    "cc_by_sa_4": "licensed under cc by sa 4 0",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_nc_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0_work": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "all_rights": "all rights reserved",
    "gpl2_only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl2_only_of": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2 of the license",
    "lesser_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lesser_details": "see the gnu lesser general public license for more details",
    "affero_details": "see the gnu affero general public license for more details",
    "boost_title": "boost software license version 1 0 august 17th 2003",
    "boost_distributed": "distributed under the boost software license version 1 0",
    "boost_grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib_as_is": "this software is provided as is without any express or implied warranty",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
}
# The grant of the "or later" notices, for each thing that is free, family and version.
GRANT = "this {0} is free software you can redistribute it and or modify it under the terms of the gnu {1} general public license as published by the free software foundation either version {2} of the license or at your option any later version"
GRANTS = {
    f"{ident}_{thing}": (licence, GRANT.format(thing, family, version))
    for ident, licence, family, version in (("lgpl2", "LGPL-2.0-or-later", "library", "2"), ("lgpl21", "LGPL-2.1-or-later", "lesser", "2 1"), ("lgpl3", "LGPL-3.0-or-later", "lesser", "3"), ("agpl3", "AGPL-3.0-or-later", "affero", "3"))
    for thing in ("program", "library")
}
SENTENCES |= {ident: sentence for ident, (_, sentence) in GRANTS.items()}
# Licence names that an SPDX line may give alone.
SPDX = [
    "MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    *[f"{family}-{how}" for family in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for how in ("only", "or-later")],
]
SPDX_IDS = {"spdx_" + name.lower(): name for name in SPDX}
SENTENCES |= {ident: "spdx license identifier " + name.lower().replace("-", " ").replace(".", " ") for ident, name in SPDX_IDS.items()}

# Ordered rules: licence, then the identifiers that must follow one another. Longer rules come first.
RULES = [
    ("BSD-3-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("Apache-2.0", ["apache_licensed", "apache_comply", "apache_obtain"]),
    ("Apache-2.0", ["apache_the_license", "apache_comply", "apache_obtain"]),
    ("GPL-3.0-or-later", ["gpl3_free", "gpl_hope"]),
    ("GPL-2.0-or-later", ["gpl2_free", "gpl_hope"]),
    ("MPL-2.0", ["mpl2_form", "mpl2_copy"]),
    ("MIT", ["mit_released"]),
    ("MIT", ["mit_licensed"]),
    ("Apache-2.0", ["apache_licensed"]),
    ("Apache-2.0", ["apache_the_license"]),
    ("GPL-3.0", ["gpl3_work"]),
    ("GPL-3.0", ["gpl3_licensed"]),
    ("GPL-2.0", ["gpl2_licensed"]),
    ("LGPL-2.1", ["lgpl21_licensed"]),
    ("LGPL-3.0", ["lgpl3_licensed"]),
    ("AGPL-3.0", ["agpl3_licensed"]),
    ("MPL-2.0", ["mpl2_form"]),
    ("ISC", ["isc_grant"]),
    ("Unlicense", ["unlicense_domain"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_4"]),
    ("CC-BY-4.0", ["cc_by_4"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_4"]),
    ("CC-BY-4.0", ["cc_by_work"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_work"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_work"]),
    ("CC0-1.0", ["cc0_work"]),
    ("GPL-2.0-only", ["gpl2_only"]),
    ("GPL-2.0-only", ["gpl2_only_of"]),
    ("Zlib", ["zlib_as_is", "zlib_grant"]),
    ("BSL-1.0", ["boost_distributed"]),
    ("BSL-1.0", ["boost_grant"]),
    *[(licence, [ident]) for ident, (licence, _) in GRANTS.items()],
    *[(name, [ident]) for ident, name in SPDX_IDS.items()],
]
TRIGGER = r"licen[sc]e|copyright|permission|warrant|redistribut|public[^a-z]+(?:(?:dnl|rem)[^a-z]+)?domain|rights[^a-z]+(?:(?:dnl|rem)[^a-z]+)?reserved|mozilla"
# End marks inside a known sentence: the words of the published notice that they follow.
STOPS = {
    "gpl3_free": ("program is free software", "free software foundation"),
    "gpl2_free": ("program is free software", "free software foundation"),
    "gpl_hope": ("without any warranty",),
    "mpl2_form": ("public license v",),
    "gpl2_only": ("program is free software",),
    "gpl2_only_of": ("program is free software", "free software foundation"),
    "lesser_hope": ("without any warranty",),
} | {ident: ("is free software", "free software foundation") for ident in GRANTS} | {ident: ("license identifier",) for ident in SPDX_IDS}
# Marks are capitals, which lower-cased text does not hold: H empty line, S end mark, L line break.
WORD = r"a-z0-9\x{80}-\x{10ffff}"
COMMENT_WORD = rf"(?i)(^|[\n\r])[^{WORD}\n\r]*(?:dnl|rem)(?=\s)"
SPDX_LINE = r"(?i)(SPDX-License-Identifier:[^\n\r]*+)"  # ends its sentence, whatever the next line is
COMMENT_SIGN = rf"(^|[\n\r])[^{WORD}\n\r]+"
LIST_MARK = rf"((?:^|[\n\r])[^{WORD}\n\r]*(?:[0-9]{{1,2}}|[a-z]|[ivx]{{1,4}}))\)(?=\s)"
LINE_END = r"(?:\r\n?+|\n)"
MARKS = [
    (LIST_MARK, "$1."),
    (COMMENT_SIGN, "$1"),
    (r"[.!?;:](?=\s)", "S"),
    (rf"(?<![^{WORD}])[^{WORD}\n\r]*+{LINE_END}[^{WORD}\n\r]*+{LINE_END}[^{WORD}]*+", "H"),
    (rf"(?<![^{WORD}])[^{WORD}HS]*+S[^{WORD}]*+", "S"),
    (rf"(?<![^{WORD}])[^{WORD}HS\n\r]*+[\n\r][^{WORD}]*+", "L"),
    (rf"[^{WORD}HSL]++", " "),
]


def marked(text: Column) -> Column:
    """The words of a text in lower case, with one mark or blank between each two."""
    lines = F.regexp_replace(F.regexp_replace(text, SPDX_LINE, "$1\n\n"), COMMENT_WORD, "$1#")
    out = ascii_lower(F.regexp_replace(lines, r"\n(?=[a-z])", " "))
    for pattern, mark in MARKS:
        out = F.regexp_replace(out, pattern, mark)
    return F.trim(out)


SLOT = 12  # words at most that a name in a sentence (``*``) may have, end marks between them allowed


def known_pattern() -> str:
    """Any known sentence in marked text, the longest first."""

    def one(ident, sentence):
        for stop in STOPS.get(ident, ()):
            sentence = sentence.replace(f"{stop} ", f"{stop}_")
        sentence = sentence.replace(" * ", " # ").replace(" ", "[ L]").replace("_", "[ LS]")
        return sentence.replace("#[ L]", rf"(?:[{WORD}]++[ LS]){{1,{SLOT}}}?")

    ordered = sorted(SENTENCES.items(), key=lambda kv: -len(kv[1]))
    return "(?<![^HSL])(?:" + "|".join(one(k, s) for k, s in ordered) + ")(?![^HSL])"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.array(*[F.lit(s) for s in SENTENCES.values()])
    ident = F.array(*[F.lit(k) for k in SENTENCES])
    found = F.regexp_extract_all(marked(text), F.lit(known_pattern()), F.lit(0))
    slots = [x.split("*") for x in SENTENCES.values() if "*" in x]

    def plain(s):
        for head, tail in slots:  # whatever name was found, the sentence of the table
            s = F.when(s.startswith(head) & s.endswith(tail), F.lit(f"{head}*{tail}")).otherwise(s)
        return s

    ids = F.transform(found, lambda s: F.element_at(ident, F.array_position(known, plain(F.translate(s, "LS", "  "))).cast("int")))
    return F.when(ascii_lower(text).rlike(TRIGGER), ids).otherwise(F.array().cast("array<string>"))


def _matches(ids: Column, rule: list[str]) -> Column:
    """True where a rule's identifiers appear in order with no opening of another rule between them.

    One walk over the identifiers, however many: the state is how far the rule has got."""
    if len(rule) == 1:
        return F.array_contains(ids, rule[0])
    done, steps = len(rule), F.array(*[F.lit(r) for r in rule])
    openings = sorted({r[0] for _, r in RULES} - set(rule))

    def step(at, x):
        return F.when(at == done, at).when(x == F.get(steps, at), at + 1).when(x.isin(openings), F.lit(0)).otherwise(at)

    return F.aggregate(ids, F.lit(0), step, lambda at: at == done)


def _starts(ids: Column, rule: list[str]) -> Column:
    """The opening sentences a rule matches from, each as its number among the openings.

    Where the rule opens again before it is done, the later opening counts. The
    state holds, for each part of the rule, the last opening it has been reached from."""
    done = len(rule)
    openings = sorted({r[0] for _, r in RULES} - set(rule))
    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("n"), *[none.alias(f"s{k}") for k in range(done)], F.array().cast("array<int>").alias("hits"))

    def step(at, x):
        n = at["n"] + (x == rule[0]).cast("int")
        parts = [F.when(x.isin(openings), none).when(x == rule[k], at[f"s{k - 1}"] if k else n).otherwise(at[f"s{k}"]) for k in range(done)]
        new = parts[-1]
        hits = F.when(new.isNotNull() & ~new.eqNullSafe(F.get(at["hits"], F.size(at["hits"]) - 1)), F.array_append(at["hits"], new)).otherwise(at["hits"])
        return F.struct(n.alias("n"), *[p.alias(f"s{k}") for k, p in enumerate(parts)], hits.alias("hits"))

    return F.aggregate(ids, start, step, lambda at: at["hits"])


def licences(ids: Column) -> Column:
    """Sorted distinct licences whose rules match an identifier sequence."""

    def found(s):
        hits = []
        for name, rule in RULES:
            own = _matches(s, rule)
            # a shorter rule stands only at an opening from which no longer rule of another licence matches
            above = [r for other, r in RULES if other != name and len(r) > len(rule) and r[: len(rule)] == rule]
            if above:
                left = _starts(s, rule)
                for r in above:
                    left = F.array_except(left, _starts(s, r))
                own = own & (F.size(left) > 0)
            hits.append(F.when(own, F.lit(name)))
        return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))

    return F.when(F.size(ids) > 0, let(ids, found)).otherwise(F.array().cast("array<string>"))


def scan_licences(docs, text: str = "text"):
    """``docs`` with sentence_ids and licences added (both arrays)."""
    return docs.withColumn("sentence_ids", sentence_ids(F.coalesce(F.col(text), F.lit("")))).withColumn("licences", licences(F.col("sentence_ids")))


@query("op10_license_scan")
def op10_license_scan(spark, d):
    """Licences of every whole document, with the known sentences that show them."""
    s = scan_licences(read(spark, d, "documents").select("doc_id", "text")).drop("text")
    return s.select("doc_id", F.size("sentence_ids").cast("bigint").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))
