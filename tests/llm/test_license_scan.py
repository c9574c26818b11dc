import random
import re
import textwrap

from pyspark.sql import functions as F

from quarry.llm import license_scan as L
from quarry.llm.common import read

from .edge import documents, rows_of

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def brute(text):
    """Sentences cut, looked up and matched in plain Python."""
    ids = []
    back = {v: k for k, v in L.SENTENCES.items()}
    for s in re.split(r"[.!?;:](?=[ \t\n\x0b\f\r])|\n(?=[^a-z])|\r", text or ""):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
        key = re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", low).strip(" ")
        if key in back:
            ids.append(back[key])
    return ids, brute_licences(ids)


def brute_licences(ids):
    found = set()
    opens = {r[0] for _, r in L.RULES}

    def match(rule):
        for a in [i for i, x in enumerate(ids) if x == rule[0]]:
            at, i = 1, a + 1
            while at < len(rule) and i < len(ids):
                if ids[i] == rule[at]:
                    at += 1
                elif ids[i] in opens - set(rule):
                    break
                i += 1
            if at == len(rule):
                return True
        return False

    for name, rule in L.RULES:
        longer = [r for _, r in L.RULES if len(r) > len(rule) and r[: len(rule)] == rule]
        if match(rule) and not any(match(r) for r in longer):
            found.add(name)
    return sorted(found)


TEXTS = [
    MIT, MIT.replace("The above copyright", "Something else"), "Intro.\nReleased under the MIT License.\nEnd", "x\nLicensed under the Apache License, Version 2.0.",
    "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n   http://x",
    "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3.", "the licence of nothing", "RELEASED UNDER THE MIT LICENSE!",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. x\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\nRedistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "released under the mit license\nReleased under the MIT License", "A sentence. Released under the MIT License", "reléased under the MIT License",
]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for r in rows_of(L.scan_licences(df)):
        ids, names = brute(r["text"])
        assert (r["sentence_ids"], r["licences"]) == (ids, names), r["text"]
    got = {r["doc_id"]: r["licences"] for r in rows_of(L.scan_licences(df))}
    assert got[0] == ["MIT"] and got[1] == [] and got[2] == ["MIT"] and got[4] == ["Apache-2.0"] and got[5] == ["CC-BY-NC-4.0", "GPL-3.0"] and got[8] == ["BSD-2-Clause"]


def test_rules_on_random_sequences(spark):
    r = random.Random(3)
    pool = [i for _, rule in L.RULES if len(rule) > 1 for i in rule] + ["all_rights", "mit_liability", "gpl_details", "mit_released"]
    rows = [(n, [r.choice(pool) for _ in range(r.randint(0, 14))]) for n in range(300)]
    for n, (_, rule) in enumerate(L.RULES):  # each rule whole, with strangers between, and cut by a foreign opening
        rows += [(1000 + n, rule), (2000 + n, [x for i in rule for x in (i, "all_rights")]), (3000 + n, rule[:1] + ["isc_grant"] + rule[1:])]
    got = {x["n"]: x["l"] for x in rows_of(spark.createDataFrame(rows, "n int, ids array<string>").select("n", L.licences(F.col("ids")).alias("l")))}
    assert got == {n: brute_licences(ids) for n, ids in rows}


def test_very_long_text(spark):
    """Tens of thousands of known sentences between the parts of one rule."""
    s = L.SENTENCES
    text = s["mit_grant"] + ". " + "All rights reserved. " * 50_000 + s["mit_notice"] + ". " + s["mit_warranty"] + "."
    row = rows_of(L.scan_licences(spark.createDataFrame([(1, text)], "doc_id bigint, text string")))[0]
    assert row["licences"] == ["MIT"] and len(row["sentence_ids"]) == 50_003  # all of them, and the three of the rule


def test_whole_table(spark, sf):
    n = 0
    for r in rows_of(L.scan_licences(read(spark, sf, "documents").select("doc_id", "text"))):
        ids, names = brute(r["text"])
        assert (r["sentence_ids"], r["licences"]) == (ids, names)
        n += bool(names)
    assert n > 0


def test_trigger_covers_every_sentence():
    assert [k for k, s in L.SENTENCES.items() if not re.search(L.TRIGGER, s)] == []
    assert {i for _, r in L.RULES for i in r} <= set(L.SENTENCES)


def test_edges(spark):
    docs = documents(spark)
    got = rows_of(L.scan_licences(docs))
    assert len(got) == docs.count() and all(r["licences"] == [] and r["size"] == "kept" for r in got)
    assert L.scan_licences(docs.limit(0)).count() == 0


# The notices as their licences publish them.
PUBLISHED = {
    "MIT": """Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
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
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.""",
    "LGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU Affero General Public License for more details.""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
}
WHOLE = {
    "MIT": ["mit_grant", "mit_notice", "mit_warranty", "mit_liability"], "BSD-3-Clause": ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"],
    "Apache-2.0": ["apache_the_license", "apache_comply", "apache_obtain", "apache_as_is", "apache_see"], "GPL-3.0-or-later": ["gpl3_free", "gpl_hope", "gpl_details", "gpl_received"],
    "GPL-2.0-or-later": ["gpl2_free", "gpl_hope", "gpl_details"], "MPL-2.0": ["mpl2_form", "mpl2_copy"], "ISC": ["isc_grant"], "Unlicense": ["unlicense_domain"],
    "GPL-2.0-only": ["gpl2_only"], "LGPL-2.1-or-later": ["lgpl21_library", "lesser_hope", "lesser_details"], "LGPL-3.0-or-later": ["lgpl3_program"], "AGPL-3.0-or-later": ["agpl3_program", "gpl_hope", "affero_details"],
    "BSL-1.0": ["boost_distributed"], "Zlib": ["zlib_as_is", "zlib_grant"],
}


def rewrapped(text, width):
    """Each paragraph filled anew: lines begin at other words, capitals as well."""
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n"))


def test_published_notices(spark):
    """Unmodified, indented, in comments, with other line ends and rewrapped: every sentence and the licence are found."""
    lines = lambda before, text, end="\n": end.join((before + line).rstrip(" ") for line in text.split("\n"))
    ways = [
        lambda x: x, lambda x: lines("    ", x), lambda x: lines("# ", x), lambda x: "/*\n" + lines(" * ", x) + "\n */", lambda x: lines("// ", x), lambda x: lines(";; ", x), lambda x: lines("dnl ", x),
        lambda x: lines("REM ", x), lambda x: lines("", x, "\r\n"), lambda x: lines("# ", x, "\r\n"), lambda x: re.sub(r"(?m)^1\.", "*", x).replace("\n2. ", "\n* ").replace("\n3. ", "\n* "),
        lambda x: x.replace("\n1. ", "\n(a) ").replace("\n2. ", "\nb) ").replace("\n3. ", "\n3) "), *[lambda x, w=w: rewrapped(x, w) for w in (20, 33, 40, 50, 60, 67, 90, 10_000)], lambda x: lines(" * ", rewrapped(x, 30)),
    ]
    rows = [(name, n, f"def f():\n    pass\n\n{way(text)}\n\nThe end") for name, text in PUBLISHED.items() for n, way in enumerate(ways)]
    for r in rows_of(L.scan_licences(spark.createDataFrame(rows, "name string, way int, text string"))):
        assert (r["licences"], r["sentence_ids"]) == ([r["name"]], WHOLE[r["name"]]), (r["name"], r["way"], r["text"])


def test_sentences_do_not_join_over_empty_lines_or_foreign_stops(spark):
    texts = ["Released under the\n\nMIT License", "Released under. The MIT License", "not released under the MIT License", "released under the MIT License of old"]
    for r in rows_of(L.scan_licences(spark.createDataFrame([(t,) for t in texts], "text string"))):
        assert r["licences"] == [], r["text"]


def test_long_runs_without_words(spark):
    text = "-" * 200_000 + "\n" * 200_000 + ". " * 100_000 + "Released under the MIT License" + " \n" * 100_000
    assert rows_of(L.scan_licences(spark.createDataFrame([(text,)], "text string")))[0]["licences"] == ["MIT"]


def test_shorter_rule_is_dropped_at_its_own_opening_only(spark):
    three, two = WHOLE["BSD-3-Clause"], WHOLE["BSD-3-Clause"][:3]
    both, no = ["BSD-2-Clause", "BSD-3-Clause"], ["BSD-3-Clause"]
    rows = [(three + two, both), (two + three, both), (three + ["isc_grant"] + two, sorted([*both, "ISC"])), (three, no), (two, ["BSD-2-Clause"]), (three + three, no), (three * 3 + two[:2], no), (two + two + three, both), (two + ["bsd_redistribution", "bsd_endorse"], no)]
    df = spark.createDataFrame([(n, ids) for n, (ids, _) in enumerate(rows)], "n int, ids array<string>")
    got = {r["n"]: r["l"] for r in rows_of(df.select("n", L.licences(F.col("ids")).alias("l")))}
    assert got == {n: want for n, (_, want) in enumerate(rows)}


def test_trigger_reads_over_line_ends(spark):
    texts = ["All rights\nreserved", "All rights\r\n * reserved.", "This is free and unencumbered software released into the public\n# domain.", "ALL RIGHTS\nREM RESERVED"]
    got = [r["sentence_ids"] for r in rows_of(L.scan_licences(spark.createDataFrame([(t,) for t in texts], "text string")))]
    assert got == [["all_rights"], ["all_rights"], ["unlicense_domain"], ["all_rights"]]


def test_named_holders_and_spdx_lines(spark):
    bsd = PUBLISHED["BSD-3-Clause"]
    texts = [(bsd.replace("the copyright holder", who), ["BSD-3-Clause"]) for who in ("Example, Inc.", "the University of Nowhere", "the <ORGANIZATION>", "A. B. Writer (and friends)")]
    texts += [(bsd.replace("the copyright holder", "x " * L.SLOT), ["BSD-3-Clause"]), (bsd.replace("the copyright holder", "x " * (L.SLOT + 1)), ["BSD-2-Clause"])]
    for name in L.SPDX:
        texts += [(way.format(name), [name]) for way in ("SPDX-License-Identifier: {}", "// SPDX-License-Identifier: {}\n#include <x>", "// spdx-license-identifier: {}\nint x;", "/* SPDX-License-Identifier: {} */\nint x;", "#!/bin/sh\n# spdx-license-identifier: {}\n\necho")]
    texts += [("SPDX-License-Identifier: MIT OR Apache-2.0", []), ("SPDX-License-Identifier: Unknown-1.0", []), ("Boost Software License - Version 1.0 - August 17th, 2003", [])]
    df = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(texts)], "n int, text string")
    assert {r["n"]: r["licences"] for r in rows_of(L.scan_licences(df))} == {n: want for n, (_, want) in enumerate(texts)}
