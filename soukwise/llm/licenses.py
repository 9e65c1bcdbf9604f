"""Licence scan by sentence rules: known sentences become identifiers, rules match their order.

A text is cut into sentences at full stops before white space and at line ends, but
not where the next line goes on in lower case. A sentence is lower-cased, and its runs
of other characters than letters and digits become one space. Those in the table of
known sentences leave their identifiers, in order. Rules then name the licences: a
rule is a sequence of identifiers that follow each other, with other known sentences in
between or not. It takes the sentences that it covers, and longer rules come first, so a whole MIT text is one
finding and not two.

All of it works on one row at a time, so nothing is shuffled.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Creative Commons licences: conditions in short, and as the long name spells them.
CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
      "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
      "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0")


def cc_sentences(short: str, version: str) -> tuple[str, ...]:
    """How notices name a Creative Commons licence, by its short and by its long name."""
    place = {"4.0": "International", "3.0": "Unported"}.get(version, "Generic")
    spaced = (CC[short].replace("NonC", "Non-C").replace("ShareAlike", "Share Alike").replace("NoD", "No-D")
              .replace("Derivatives", "Derivs"))
    brief = [f"{start} {article}CC {short} {version}{end}" for end in ("", " license", f" {place}") for article in ("", "a ", "the ")
             for start in ("Licensed under", "This work is licensed under", "Released under")]
    full = [f"{start} Creative Commons {name} {version} {end}" for name in (CC[short], CC[short].replace("Derivatives", "Derivs"), spaced) for end in (f"{place} License", "License")
            for start in ("Licensed under a", "Licensed under the", "This work is licensed under a", "This work is licensed under the")]
    return *brief, *full


# How GNU notices begin, and their licences: identifier, kind and versions.
TERMS = ("you can redistribute it and/or modify it", "you may redistribute it and/or modify it")
GNU = (("gpl", "", ("2", "3")), ("lgpl", "Lesser", ("2.1", "3")), ("llgpl", "Library", ("2",)), ("agpl", "Affero", ("3",)))
SPDX = {"gpl": "GPL", "lgpl": "LGPL", "llgpl": "LGPL", "agpl": "AGPL"}

# Known sentences: identifier, then the sentence as licences print it, or several of the same meaning.
SENTENCES = {
    "mit-name": "Released under the MIT License",
    "mit-name-2": "Licensed under the MIT License",
    "mit-name-3": "This project is licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "apache-name": "Licensed under the Apache License, Version 2.0",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-name-2": "Licensed under the GNU General Public License, version 3",
    "gpl2-name": "Licensed under the GNU General Public License, version 2",
    # Sentences with a colon or semicolon are cut there, and each part is known by itself.
    "gpl-free": ("This program is free software", "This file is free software", "This software is free software"),
    "lgpl-free": "This library is free software",
    **{f"{name}-{part}": tuple(f"{start} under the terms of {way}" for start in TERMS for way in text.split(" | "))
       for name, kind, versions in GNU for part, text in (
           ("terms", f"the GNU {kind} General Public License as published by the Free Software Foundation".replace("  ", " ")),
           *((f"{v}-later", f"the GNU {kind} General Public License as published by the Free Software Foundation, either version "
                            f"{v} of the License, or (at your option) any later version".replace("  ", " ")) for v in versions),
           *((f"{v}-only", f"version {v} of the GNU {kind} General Public License as published by the Free Software Foundation | "
                           f"the GNU {kind} General Public License version {v} as published by the Free Software Foundation"
                           .replace("  ", " ")) for v in versions))},
    **{f"either-{v}": f"either version {v} of the License, or (at your option) any later version" for v in ("2", "2.1", "3")},
    **{f"this-{v}": (f"version {v} of the License", f"version {v} of the License only") for v in ("2", "2.1", "3")},
    "gpl-warranty": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
                     "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    "lgpl-name": "Licensed under the GNU Lesser General Public License",
    "agpl-name": "Licensed under the GNU Affero General Public License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                 "the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission",
    "bsd-name": "Licensed under the BSD License",
    "mpl-name": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc0": "This work is dedicated to the public domain under CC0 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
    "apache-name-2": ("Released under the Apache License, Version 2.0", "Licensed under the Apache License 2.0",
                      "Released under the Apache License 2.0", "Licensed under the Apache 2.0 License",
                      "This project is licensed under the Apache License 2.0",
                      "This project is licensed under the Apache License, Version 2.0"),
    "mit-name-4": ("Licensed under MIT", "Licensed under the MIT Licence", "Released under the MIT Licence",
                   "Distributed under the MIT License", "This software is released under the MIT License",
                   "This software is licensed under the MIT License"),
    "isc-name": ("Licensed under the ISC License", "Released under the ISC License", "ISC License"),
    "bsd2-name": ("Licensed under the BSD 2-Clause License", "Released under the BSD 2-Clause License", "BSD 2-Clause License",
                  "Licensed under the Simplified BSD License"),
    "bsd3-name": ("Licensed under the BSD 3-Clause License", "Released under the BSD 3-Clause License", "BSD 3-Clause License",
                  "Licensed under the New BSD License"),
    "gpl3-name-3": ("Licensed under the GNU General Public License v3.0", "Licensed under the GPLv3", "Licensed under the GPL v3",
                    "Released under the GNU General Public License, version 3", "Released under the GPLv3"),
    "gpl2-name-2": ("This work is licensed under the GNU General Public License, version 2", "Licensed under the GPLv2",
                    "Licensed under the GNU General Public License v2.0", "Licensed under the GPL v2",
                    "Released under the GNU General Public License, version 2", "Released under the GPLv2"),
    "lgpl21-name": ("Licensed under the GNU Lesser General Public License, version 2.1", "Licensed under the LGPL v2.1",
                    "Licensed under the LGPLv2.1"),
    "lgpl3-name": ("Licensed under the GNU Lesser General Public License, version 3", "Licensed under the LGPLv3",
                   "Licensed under the LGPL v3", "Licensed under the GNU Lesser General Public License v3.0"),
    "agpl3-name": ("Licensed under the GNU Affero General Public License, version 3", "Licensed under the AGPLv3",
                   "Licensed under the AGPL v3", "Licensed under the GNU Affero General Public License v3.0"),
    "mpl-name-2": ("Licensed under the Mozilla Public License 2.0", "Licensed under the Mozilla Public License, version 2.0",
                   "Licensed under MPL 2.0", "Licensed under the MPL 2.0"),
    "epl-name": ("Licensed under the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 2.0",
                 "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    "boost-name": ("Distributed under the Boost Software License, Version 1.0", "Licensed under the Boost Software License, Version 1.0",
                   "Boost Software License - Version 1.0"),
    "zlib-grant": "This software is provided 'as-is', without any express or implied warranty",
    "wtfpl-name": ("Do What The Fuck You Want To Public License", "Licensed under the WTFPL"),
    "cc0-2": ("Licensed under CC0 1.0", "Released under CC0 1.0", "This work is licensed under CC0 1.0", "CC0 1.0 Universal",
              "Licensed under CC0 1.0 Universal"),
    "public": ("This work is in the public domain", "Released into the public domain", "This file is in the public domain"),
    **{f"cc-{short}-{version}": cc_sentences(short, version) for short in CC for version in CC_VERSIONS},
}

# Rules, those that are tried first at the top: licence, then its identifiers in order. Those joined by + are parts of one
# sentence, with nothing known in between.
RULES = (
    ("MIT", "mit-title mit-grant mit-notice"), ("MIT", "mit-title-2 mit-grant mit-notice"), ("MIT", "mit-grant mit-notice"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-endorse"), ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    *((f"{SPDX[name]}-{v if '.' in v else v + '.0'}-{end}", ids) for name, _, versions in GNU for v in versions for end, ids in (
        ("or-later", f"{name}-{v}-later"), ("or-later", f"{name}-terms+either-{v}"), ("only", f"{name}-terms+this-{v}"),
        ("only", f"{name}-{v}-only"))),
    ("Apache-2.0", "apache-header+apache-use apache-copy"), ("Apache-2.0", "apache-header+apache-use"),
    ("MIT", "mit-name"), ("MIT", "mit-name-2"), ("MIT", "mit-name-3"), ("MIT", "mit-title"), ("MIT", "mit-title-2"),
    ("ISC", "isc-grant"), ("Apache-2.0", "apache-name"), ("Apache-2.0", "apache-header"),
    ("GPL-3.0-only", "gpl3-name"), ("GPL-3.0-only", "gpl3-name-2"), ("GPL-2.0-only", "gpl2-name"),
    ("LGPL", "lgpl-name"), ("AGPL", "agpl-name"),
    ("BSD", "bsd-name"), ("MPL-2.0", "mpl-name"), ("CC0-1.0", "cc0"), ("Unlicense", "unlicense"), ("All-Rights-Reserved", "reserved"),
    ("Apache-2.0", "apache-name-2"), ("MIT", "mit-name-4"), ("ISC", "isc-name"), ("BSD-2-Clause", "bsd2-name"),
    ("BSD-3-Clause", "bsd3-name"), ("GPL-3.0-only", "gpl3-name-3"), ("GPL-2.0-only", "gpl2-name-2"), ("LGPL-2.1-only", "lgpl21-name"),
    ("LGPL-3.0-only", "lgpl3-name"), ("AGPL-3.0-only", "agpl3-name"), ("MPL-2.0", "mpl-name-2"), ("EPL-2.0", "epl-name"),
    ("BSL-1.0", "boost-name"), ("Zlib", "zlib-grant"), ("WTFPL", "wtfpl-name"), ("CC0-1.0", "cc0-2"), ("Public-Domain", "public"),
    *((f"CC-{short.upper()}-{version}", f"cc-{short}-{version}") for short in CC for version in CC_VERSIONS),
)
#: Where a sentence ends, and what stands between its words.
ENDS = r"\n(?![a-z(])|[.!?;:](?=\s|$)"
OTHER = r"[^\p{L}\p{N}]+"


def normal(sentence: str) -> str:
    """A sentence of the table in the form that a text's sentence gets, up to its first end."""
    return regex.sub(OTHER, " ", regex.split(ENDS, sentence)[0].lower()).strip()


def known_sentences() -> dict[str, str]:
    """The normalised sentences with their identifiers; no sentence may have two."""
    known: dict[str, str] = {}
    for sid, sentences in SENTENCES.items():
        for sentence in [sentences] if isinstance(sentences, str) else sentences:
            if known.setdefault(normal(sentence), sid) != sid:
                raise ValueError(f"{sid} and {known[normal(sentence)]} are the same up to their first end: {normal(sentence)}")
    return known


def rule_pattern(ids: str) -> str:
    """The pattern of a rule in a sequence where each identifier has a space on either side."""
    return "(?: [^ ]+ )*?".join(" " + known.replace("+", "  ") + " " for known in ids.split())


def without_rule(at: str, ids: str) -> Column:
    """A sequence, in the column ``at``, without what a rule covers.

    In such a sequence " x " occurs at whole identifiers only, so any characters may stand for those in between, which Java
    matches in a loop. Nothing is looked for behind the last place of the rule's last identifier, nor where the
    identifiers do not follow each other at all, so a search that fails does not start again at each identifier.
    """
    parts = [" " + known.replace("+", "  ") + " " for known in ids.split()]
    if len(parts) == 1:
        return F.regexp_replace(at, parts[0], "")
    behind = F.substring_index(at, parts[-1], -1)
    head = F.substr(F.col(at), F.lit(1), F.length(at) - F.length(behind))
    place = F.lit(1)
    for part in parts:
        # A place of 0 stays: nothing is found from there on.
        place = F.call_function("locate", F.lit(part), head, place)
    return F.when(place > 0, F.concat(F.regexp_replace(head, ".*?".join(parts), ""), behind)).otherwise(F.col(at))


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentences, licences) for each row of ``docs``: the identifiers found, in order, and the licences, sorted.

    A text without a known sentence, also an empty or null one, has neither.
    Repeated rows and null ids each keep a row; other columns are not looked at;
    an empty table gives an empty one.
    """
    known = known_sentences()
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    pieces = F.transform(F.split(text, ENDS, -1), lambda p: F.trim(F.regexp_replace(F.lower(p), OTHER, " ")))
    found = F.filter(pieces, lambda p: p.isin(list(known)))
    rows = docs.select(F.col(id_col).alias("id"), found.alias("found"))
    rows = rows.select("id", F.transform("found", lambda p: table[p]).alias("sentences"))
    rows = rows.select("*", F.array_join(F.transform("sentences", lambda i: F.concat(F.lit(" "), i, F.lit(" "))), "").alias("_0"))
    for k, (_, ids) in enumerate(RULES):
        rows = rows.select("*", F.when(F.col(f"_{k}") == "", "").otherwise(without_rule(f"_{k}", ids)).alias(f"_{k + 1}"))
    named = F.array(*[F.when(F.col(f"_{k}") != F.col(f"_{k + 1}"), name) for k, (name, _) in enumerate(RULES)])
    return rows.select("id", "sentences", F.array_sort(F.array_distinct(F.array_compact(named))).alias("licences"))


def oracle_sql() -> str:
    """The same in DuckDB SQL. Its patterns cannot look ahead, so ends are marked first."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    known = ", ".join(f"{text(s)}: {text(i)}" for s, i in known_sentences().items())
    steps = ["m0 as (select doc_id, ids, list_aggregate(list_transform(ids, lambda i: ' ' || i || ' '), "
             "'string_agg', '') as s0 from sequences)"]
    for k, (_, ids) in enumerate(RULES):
        steps.append(f"m{k + 1} as (select *, regexp_replace(coalesce(s{k}, ''), {text(rule_pattern(ids))}, '', 'g') as s{k + 1} "
                     f"from m{k})")
    named = ", ".join(f"case when coalesce(s{k}, '') <> s{k + 1} then {text(name)} end" for k, (name, _) in enumerate(RULES))
    return f"""with marked as (
  select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '[.!?;:](\\s|$)', chr(1) || '\\1', 'g'),
                                '\\n([^a-z(]|$)', chr(1) || '\\1', 'g') as text
  from documents),
pieces as (
  select doc_id, list_transform(string_split(text, chr(1)), lambda p:
    trim(regexp_replace(lower(p), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) as pieces
  from marked),
sequences as (
  select doc_id, list_transform(list_filter(pieces, lambda p: map_contains(known, p)), lambda p: known[p]) as ids
  from pieces, (select map {{{known}}} as known)),
{", ".join(steps)}
select doc_id, coalesce(array_to_string(ids, ','), '') as sentences,
       coalesce(array_to_string(list_sort(list_distinct(list_filter([{named}], lambda x: x is not null))), ','), '') as licences
from m{len(RULES)}"""
