"""License scans with DataFrame functions only: known sentences become identifiers, and sequences
of identifiers are matched against ordered rules."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import licence_names
from plumbline.llm.common import ascii_lower

#: Known sentences by identifier, in lower case; compared after normalisation (see `sentences`).
#: The words are those of the public licence texts and notices.
SENTENCES: dict[str, list[str]] = {
    "copyright": [],
    "apache_notice": ["licensed under the apache license, version 2.0."],
    "apache_must": ["you may not use this file except in compliance with the license."],
    "apache_copy": ["you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0"],
    "apache_as_is": [
        "unless required by applicable law or agreed to in writing, software distributed under the license "
        "is distributed on an as is basis, without warranties or conditions of any kind, either express or implied."
    ],
    "mit_notice": ["released under the mit license.", "licensed under the mit license."],
    "mit_permission": [
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the software), to deal in the software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the software, and to permit persons to whom the software is furnished to do so, subject to the "
        "following conditions:"
    ],
    "mit_conditions": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software."
    ],
    "as_is_any_kind": [
        "the software is provided as is, without warranty of any kind, express or implied, including but not "
        "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."
    ],
    "isc_permission": [
        "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "bsd_start": [
        "redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "bsd_endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ],
    "gpl3_notice": ["this work is licensed under the gnu general public license, version 3."],
    "gpl_may": [
        "you can redistribute it and/or modify it under the terms of the gnu general public license as published "
        "by the free software foundation, either version 3 of the license, or (at your option) any later version."
    ],
    "gpl_hope": [
        "this program is distributed in the hope that it will be useful, but without any warranty; without even "
        "the implied warranty of merchantability or fitness for a particular purpose."
    ],
    "cc_by_nc_notice": ["licensed under cc by-nc 4.0."],
    "cc_by_notice": ["licensed under cc by 4.0."],
    "cc_by_sa_notice": ["licensed under cc by-sa 4.0."],
    "cc0_notice": ["released under cc0 1.0."],
}


@dataclass(frozen=True)
class LicenceRule:
    """A licence is recognised where its identifiers follow each other in this order; identifiers
    in between are allowed only if the rule before has not used them up."""

    licence: str
    sequence: tuple[str, ...]


#: Rules in the order in which they are tried: full texts before notices.
RULES = [
    LicenceRule("MIT", ("mit_permission", "mit_conditions", "as_is_any_kind")),
    LicenceRule("ISC", ("isc_permission",)),
    LicenceRule("BSD-3-Clause", ("bsd_start", "bsd_source", "bsd_binary", "bsd_endorse")),
    LicenceRule("BSD-2-Clause", ("bsd_start", "bsd_source", "bsd_binary")),
    LicenceRule("Apache-2.0", ("apache_notice", "apache_must", "apache_copy", "apache_as_is")),
    LicenceRule("GPL-3.0-or-later", ("gpl_may", "gpl_hope")),
    LicenceRule("Apache-2.0", ("apache_notice",)),
    LicenceRule("MIT", ("mit_notice",)),
    LicenceRule("MIT", ("mit_permission", "mit_conditions")),
    LicenceRule("GPL-3.0-only", ("gpl3_notice",)),
    LicenceRule("GPL-3.0-or-later", ("gpl_may",)),
    LicenceRule("CC-BY-NC-4.0", ("cc_by_nc_notice",)),
    LicenceRule("CC-BY-SA-4.0", ("cc_by_sa_notice",)),
    LicenceRule("CC-BY-4.0", ("cc_by_notice",)),
    LicenceRule("CC0-1.0", ("cc0_notice",)),
]

#: Identifiers that notices of these licences have in `SENTENCES`; other notices have one of their own.
_HAVE = {"MIT": "mit_notice", "Apache-2.0": "apache_notice", "GPL-3.0-only": "gpl3_notice", "CC0-1.0": "cc0_notice",
         "CC-BY-4.0": "cc_by_notice", "CC-BY-SA-4.0": "cc_by_sa_notice", "CC-BY-NC-4.0": "cc_by_nc_notice"}
NOTICES = {_HAVE.get(x, f"notice_{x.lower()}"): names for x, names in licence_names.NAMES.items()}
#: `SENTENCES` and `RULES` with the further texts and licences; what a scan uses by default.
KNOWN = {k: SENTENCES.get(k, []) + licence_names.TEXTS.get(k, []) for k in [*SENTENCES, *licence_names.TEXTS]}
ALL_RULES = [
    *RULES,
    *(LicenceRule(x, (name, "gpl_hope")) for x, name in licence_names.GNU.items()),
    *(LicenceRule(x, (name,)) for x, name in licence_names.GNU.items()),
    LicenceRule("Unlicense", ("unlicense_text",)),
    *(LicenceRule(x, (f"notice_{x.lower()}",)) for x in licence_names.NAMES if x not in _HAVE),
]

#: A sentence that may be a copyright notice ends at a line end, or at . ! ? : with a blank after it.
SENTENCE_END = r"\n|(?:[.!?:][ \t\r]+)"
_NOISE = r"[^a-z0-9]+"
MARK = "©"


def normalise(sentence: str) -> str:
    """What `sentences` makes of a known sentence; here for the table of known ones."""
    kept = "".join(c if c.isascii() and (c.islower() or c.isdigit()) else " " for c in sentence)
    return " ".join(kept.split())


def sentences(text: Column) -> Column:
    """Sentences of a text: A-Z lower-cased, all but a-z and 0-9 turned into single blanks."""
    parts = F.split(ascii_lower(text), SENTENCE_END, -1)
    return F.transform(parts, lambda s: F.trim(F.regexp_replace(s, _NOISE, " ")))


def running(text: Column) -> Column:
    """The words of a text in one line, after a mark at its start. Line ends, comment marks and
    punctuation are blanks, so the places of line ends don't matter; `MARK` stands before a
    sentence that starts with `copyright` and holds a year."""
    notice = lambda s: s.startswith("copyright ") & s.rlike(" [12][0-9]{3}( |$)")
    text = F.regexp_replace(text, r"(?i)(gpl[- ]?v?[0-9.]+)\+", "$1-or-later")
    text = F.regexp_replace(text, licence_names.LINE, licence_names.TAG)
    parts = F.transform(sentences(text), lambda s: F.when(notice(s), F.concat(F.lit(MARK + " "), s)).otherwise(s))
    return F.concat(F.lit("| "), F.array_join(F.filter(parts, lambda s: s != ""), " "), F.lit(" "))


def identifiers(text: Column, known: dict[str, list[str]], notices: dict[str, list[str]]) -> Column:
    """The known sentences of a text in their order, by identifier: found as whole words anywhere in
    the running text, of those that start at one word the longest. `notices` holds
    names of licences, which count behind words like `licensed under the`, an SPDX tag, a line `License:`, or
    `or` and `and` after another; behind `not` neither they nor known sentences count. A sentence that starts with `copyright` and holds a year is `copyright`."""
    names = {normalise(t): name for name, texts in known.items() for t in texts} | {MARK: "copyright"}
    named = {x: name for name, texts in notices.items() for x in texts}
    either = lambda xs: "|".join(sorted(xs, key=len, reverse=True))
    strict = f"{licence_names.UNDER}|{licence_names.TAG}"
    before = f"{strict}|{licence_names.WIDE}"
    pattern = f"(?<= ){licence_names.NOT}(?:{either(names)})(?= )"
    bare_names = sorted(x for x in named if x in licence_names.BARE)
    if whole := [x for x in named if x not in licence_names.BARE]:
        pattern += f"|(?:(?<= ){licence_names.NOT}(?:{before})|{licence_names.NEXT})(?:{either(whole)})(?= )"
    if bare_names:
        pattern += f"|(?:(?<= ){licence_names.NOT}(?:{strict})|{licence_names.NEXT_BARE})(?:{either(bare_names)})(?= )"
    table = F.create_map(*(F.lit(x) for pair in (named | names).items() for x in pair))
    found = F.regexp_extract_all(running(text), F.lit(pattern), F.lit(0))
    bare = lambda s: F.regexp_replace(s, f"^(?:{before}| (?:or|and) (?:the )?)", "")
    return F.transform(found, lambda s: F.coalesce(F.try_element_at(table, s), F.try_element_at(table, bare(s))))


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    known: dict[str, list[str]] = KNOWN,
    rules: list[LicenceRule] = ALL_RULES,
    notices: dict[str, list[str]] = NOTICES,
) -> DataFrame:
    """One row per row of `docs`: struct `row`, `sentence_ids` (identifiers of its known sentences, in
    order), `licences` (those found, in the order of the rules) and `n_unused` (identifiers no
    rule has used).

    By default, full texts of MIT, ISC, BSD-2/3-Clause, the Apache-2.0 header, the GNU notices and the
    Unlicense are known, and notices and SPDX tags of the licences in `licence_names.NAMES`; others are not.

    Rules are tried in order. The identifiers of a rule must follow one another directly, but for
    `copyright`; all their occurrences are used up, so that a weaker rule doesn't see them again.
    A null or empty text has no identifiers. Every text is worked on in its own row: no shuffle,
    no join, and the tables of sentences and rules are part of the expression.
    """
    ids = identifiers(F.coalesce(F.col(text), F.lit("")), known, notices)
    out = docs.select(F.struct("*").alias("row"), ids.alias("ids"))
    chain = F.concat(F.lit("|"), F.array_join(F.filter("ids", lambda s: s != "copyright"), "||"), F.lit("|"))
    out = out.withColumn("chain0", F.when(F.size("ids") > 0, chain).otherwise(""))
    # neighbouring rules of one identifier each don't affect one another: they are one step
    steps = [list(g) for _, g in groupby(rules, lambda r: len(r.sequence) == 1 or r)]
    found = []
    for k, step in enumerate(steps):
        wanted = ["|" + "||".join(rule.sequence) + "|" for rule in step]
        hits = [F.when(F.col(f"chain{k}").contains(w), F.lit(r.licence)) for w, r in zip(wanted, step, strict=True)]
        used = "|".join(re.escape(w) for w in wanted)
        out = out.withColumn(
            f"hit{k}", F.when(F.col(f"chain{k}") != "", F.array_compact(F.array(*hits)))
        ).withColumn(f"chain{k + 1}", F.regexp_replace(f"chain{k}", used, "|-|"))
        found.append(F.coalesce(f"hit{k}", F.array().cast("array<string>")))
    rest = F.filter(F.split(F.col(f"chain{len(steps)}"), r"\|", -1), lambda s: (s != "") & (s != "-"))
    return out.select(
        "row",
        F.col("ids").alias("sentence_ids"),
        F.array_distinct(F.flatten(F.array(*found))).alias("licences"),
        F.size(rest).cast("long").alias("n_unused"),
    )
