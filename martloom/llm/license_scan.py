"""License scans: sentences of known licences, then ordered rules over their identifiers.

A text is cut into sentences, each brought to lower-case words, and looked up in a table of
known licence sentences. The identifiers found, in the order of the text, are matched against
rules; rules are tried in order, and the first that matches decides for its licence.

A sentence may stand on a line of its own, with no full stop before it, or run over several
lines, so a text is read twice: cut at line ends, and with single line ends as spaces.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import own, whole_text

# Sentences of public licences and of the notes that name them, in lower-case
# words as they come out of ``sentences``, by identifier.
SENTENCES = {
    "apache-grant": "licensed under the apache license version 2 0",
    "apache-grant-defined": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software "
    "distributed under the license is distributed on an as is basis without warranties or "
    "conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and "
    "limitations under the license",
    "mit-release": "released under the mit license",
    "mit-grant": "licensed under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy "
    "of this software and associated documentation files the software to deal in the software "
    "without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-grant": "licensed under the gnu general public license version 3",
    "gpl3-terms": "this program is free software you can redistribute it and or modify it under "
    "the terms of the gnu general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular "
    "purpose",
    "gpl-details": "see the gnu general public license for more details",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without "
    "modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this "
    "list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior "
    "written permission",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 "
    "international license",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international "
    "license",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "rights-reserved": "all rights reserved",
}

# The GNU notices, as full stops, colons and semicolons cut them: version 2 stands in a sentence
# of its own, version 3 mostly not.
GNU = {"gpl": "gnu general", "lgpl": "gnu lesser general", "agpl": "gnu affero general"}
LATER = "either version {} of the license or at your option any later version"
for _name, _words in GNU.items():
    _grant = (
        f"you can redistribute it and or modify it under the terms of the {_words} public license "
        "as published by the free software foundation"
    )
    SENTENCES[f"{_name}-redistribute"] = _grant
    SENTENCES[f"{_name}3-redistribute"] = f"{_grant} {LATER.format(3)}"
SENTENCES |= {
    "gnu-version-2": LATER.format(2),
    "gnu-version-2-1": LATER.format("2 1"),
    "gnu-version-3": LATER.format(3),
    "mpl2-source": "this source code form is subject to the terms of the mozilla public license v",
    "isc-permission": "permission to use copy modify and or distribute this software for any "
    "purpose with or without fee is hereby granted provided that the above copyright notice and "
    "this permission notice appear in all copies",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "epl2-terms": "this program and the accompanying materials are made available under the terms "
    "of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "cc0-work": "this work is licensed under cc0 1 0 universal",
    "mit-project": "this project is licensed under the mit license",
}

#: Licence, name of the rule, identifiers that must follow each other in this order. Others
#: may stand between them, but not before a version. A licence's rules go from the fullest to
#: the barest.
VERSION = "gnu-version"
RULES = [
    (
        "Apache-2.0",
        "header",
        ["apache-grant-defined", "apache-comply", "apache-copy", "apache-as-is", "apache-see"],
    ),
    ("Apache-2.0", "short-header", ["apache-grant-defined", "apache-comply"]),
    ("Apache-2.0", "reference", ["apache-grant"]),
    ("Apache-2.0", "defined-reference", ["apache-grant-defined"]),
    ("MIT", "text", ["mit-permission", "mit-notice", "mit-as-is"]),
    ("MIT", "release", ["mit-release"]),
    ("MIT", "reference", ["mit-grant"]),
    ("GPL-3.0", "header", ["gpl3-terms", "gpl-hope", "gpl-details"]),
    ("GPL-3.0", "terms", ["gpl3-terms"]),
    ("GPL-3.0", "work", ["gpl3-work"]),
    ("GPL-3.0", "reference", ["gpl3-grant"]),
    ("GPL-3.0", "notice", ["gpl3-redistribute"]),
    ("GPL-3.0", "split-notice", ["gpl-redistribute", "gnu-version-3"]),
    ("GPL-2.0", "notice", ["gpl-redistribute", "gnu-version-2"]),
    ("LGPL-3.0", "notice", ["lgpl3-redistribute"]),
    ("LGPL-3.0", "split-notice", ["lgpl-redistribute", "gnu-version-3"]),
    ("LGPL-2.1", "notice", ["lgpl-redistribute", "gnu-version-2-1"]),
    ("AGPL-3.0", "notice", ["agpl3-redistribute"]),
    ("AGPL-3.0", "split-notice", ["agpl-redistribute", "gnu-version-3"]),
    ("MPL-2.0", "notice", ["mpl2-source"]),
    ("ISC", "text", ["isc-permission"]),
    ("Unlicense", "text", ["unlicense-domain"]),
    ("EPL-2.0", "notice", ["epl2-terms"]),
    ("CC0-1.0", "work", ["cc0-work"]),
    ("MIT", "project", ["mit-project"]),
    (
        "BSD-3-Clause",
        "text",
        ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"],
    ),
    ("BSD-2-Clause", "text", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("CC-BY-NC-4.0", "reference", ["cc-by-nc"]),
    ("CC-BY-NC-4.0", "work", ["cc-by-nc-work"]),
    ("CC-BY-4.0", "reference", ["cc-by"]),
    ("CC-BY-4.0", "work", ["cc-by-work"]),
    ("CC-BY-SA-4.0", "reference", ["cc-by-sa"]),
    ("Proprietary", "reserved", ["rights-reserved"]),
]

# SPDX tags, of every licence above but the reserved rights; those of the GNU say whether later
# versions count, too.
for _licence in dict.fromkeys(licence for licence, _, _ in RULES if licence != "Proprietary"):
    for _end in ["", "-only", "-or-later"] if "GPL" in _licence else [""]:
        _tag = f"{_licence}{_end}".lower().replace(".", "-")
        SENTENCES[f"spdx-{_tag}"] = f"spdx license identifier {_tag.replace('-', ' ')}"
        RULES.append((_licence, f"spdx{_end}", [f"spdx-{_tag}"]))

#: A tag's colon would cut it in two.
TAG, JOINED_TAG = r"(?i)SPDX-License-Identifier:[\x20\t]*", "SPDX-License-Identifier "
#: What is licensed, in up to four words, and the words that all such sentences are brought to.
SUBJECT = "^([a-z0-9]+ ){1,4}(is|are) (licensed|released|available) under "
GRANT = "licensed under "
#: Sentences that begin so grant nothing, or not for sure.
NO_GRANT = r"^(if|unless|when|where|whether|no|none|nothing|neither|not)\b"
#: Where a sentence ends.
ENDS = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+$|\n+"
#: A line end that is no paragraph's end.
SOFT_ENDS = r"(?<!\n)\n(?!\n)"
#: Every known sentence holds one of these words, in any case.
HINT = (
    "(?i)licen[sc]|permi(t|ss)|software|warrant|redistribut|copyright|reserved|program"
    "|released|available"
)


def sentences(text: Column) -> Column:
    """The sentences of a text as lower-case words of a to z and 0 to 9."""
    return F.transform(
        F.filter(F.split(text, ENDS, -1), lambda s: s.rlike(HINT)),
        lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")),
    )


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A sentence that isn't known as it stands counts as the one without what it speaks of.
    """
    known = F.create_map(*[F.lit(x) for name, words in SENTENCES.items() for x in (words, name)])

    def name(s: Column) -> Column:
        general = F.when(~s.rlike(NO_GRANT), F.regexp_replace(s, SUBJECT, GRANT))
        return F.coalesce(F.try_element_at(known, s), F.try_element_at(known, general))

    found = F.transform(sentences(F.regexp_replace(text, TAG, JOINED_TAG)), name)
    return F.filter(found, lambda name: name.isNotNull())


def rule_pattern(names: list[str]) -> str:
    """Matches identifiers, each between spaces, that hold ``names`` in their order.

    A version belongs to the grant right before it, whatever notices follow one another.
    """
    return ".*".join(f" {name} " for name in names).replace(f".* {VERSION}", f" {VERSION}")


def decided(*readings: Column) -> Column:
    """licence:rule of every licence that a rule finds in a reading, the first rule of each."""
    spaced = [F.concat(F.lit("  "), F.array_join(r, "  "), F.lit("  ")) for r in readings]
    each = []
    for licence in dict.fromkeys(licence for licence, _, _ in RULES):
        first = F.lit(None).cast("string")
        for name, rule, needs in reversed(RULES):
            if name == licence:
                found = [r.rlike(rule_pattern(needs)) for r in spaced]
                first = F.when(reduce(or_, found), f"{licence}:{rule}").otherwise(first)
        each.append(first)
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, sentence_ids, licenses.

    ``sentence_ids`` are the known sentences, in order, of the text cut at line ends, then
    those of the text with single line ends as spaces, if they differ; ``licenses`` the
    licences, with the rule that decided, of either reading; both joined by commas. Null texts
    count as empty and hold none. Rows stand for themselves: null keys and repeated rows are
    like others, and no rows give none. Other columns are not looked at.
    """
    content = whole_text(own(docs, text))
    nothing = F.expr("cast(array() AS array<string>)")
    hinted = content.rlike(HINT)
    rows = docs.select(
        own(docs, key).alias("key"),
        F.when(hinted, identifiers(content)).otherwise(nothing).alias("lines"),
        F.when(hinted, identifiers(F.regexp_replace(content, SOFT_ENDS, " ")))
        .otherwise(nothing)
        .alias("paragraphs"),
    )
    both = F.when(F.col("lines") == F.col("paragraphs"), F.col("lines")).otherwise(
        F.concat("lines", "paragraphs")
    )
    some = F.size("lines") + F.size("paragraphs") > 0
    found = decided(F.col("lines"), F.col("paragraphs"))
    return rows.select(
        F.col("key").alias(key),
        F.size(both).cast("long").alias("n_sentences"),
        F.array_join(both, ",").alias("sentence_ids"),
        F.when(some, F.array_join(F.array_sort(found), ",")).otherwise("").alias("licenses"),
    )
