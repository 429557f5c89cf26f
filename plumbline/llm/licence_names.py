"""Names of the common public licences, as notices and SPDX lines write them."""

from __future__ import annotations


def _versions(name: str, version: str) -> list[str]:
    """A name with its version, as it is normalised: words in lower case."""
    v = version.replace(".", " ")
    whole = [v] if not v.endswith(" 0") else [v, v[:-2]]
    return [f"{name}{middle}{x}" for x in whole for middle in (" ", " version ", " v ", " v", "v")]


def _names() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {
        "MIT": ["mit license", "mit licence", "mit expat license", "expat license", "mit"],
        "MIT-0": ["mit no attribution license", "mit 0 license", "mit 0"],
        "ISC": ["isc license", "isc"],
        "0BSD": ["zero clause bsd license", "0bsd license", "bsd zero clause license", "0bsd"],
        "BSD-2-Clause": ["simplified bsd license", "freebsd license", "2 clause bsd license", "bsd 2 clause license",
                         "two clause bsd license", "bsd 2 clause"],
        "BSD-3-Clause": ["new bsd license", "modified bsd license", "revised bsd license", "3 clause bsd license",
                         "bsd 3 clause license", "three clause bsd license", "bsd 3 clause"],
        "BSD": ["bsd license", "bsd licence", "bsd style license", "bsd style licence"],
        "Unlicense": ["unlicense"],
        "Zlib": ["zlib license", "zlib"],
        "WTFPL": ["wtfpl"],
        "CC0-1.0": ["cc0 1 0 universal", "creative commons zero v1 0 universal", "cc0 1 0", "cc0"],
    }
    for spdx, version, names in (
        ("Apache-2.0", "2.0", ["apache license", "apache software license", "apache"]),
        ("MPL-2.0", "2.0", ["mozilla public license", "mpl"]),
        ("MPL-1.1", "1.1", ["mozilla public license", "mpl"]),
        ("EPL-1.0", "1.0", ["eclipse public license", "epl"]),
        ("EPL-2.0", "2.0", ["eclipse public license", "epl"]),
        ("EUPL-1.2", "1.2", ["european union public licence", "european union public license", "eupl"]),
        ("BSL-1.0", "1.0", ["boost software license", "bsl"]),
        ("Artistic-2.0", "2.0", ["artistic license", "artistic"]),
        ("CDDL-1.0", "1.0", ["common development and distribution license", "cddl"]),
    ):
        out[spdx] = [x for name in names for x in _versions(name, version)]
    for kind, long, versions in (
        ("GPL", "general public license", ("2.0", "3.0")),
        ("LGPL", "lesser general public license", ("2.1", "3.0")),
        ("LGPL", "library general public license", ("2.0",)),
        ("AGPL", "affero general public license", ("3.0",)),
    ):
        short = kind.lower()
        heads = [f"gnu {long}", long, f"gnu {short}", short]
        heads += [f"{h} {short}" for h in heads[:2]]
        for version in versions:
            plain = [x for h in heads for x in _versions(h, version)]
            out[f"{kind}-{version}-only"] = [*plain, *(f"{x} only" for x in plain)]
            out[f"{kind}-{version}-or-later"] = [
                f"{x} {end}" for x in plain
                for end in ("or later", "or any later version", "or at your option any later version")
            ]
    for kind, words in {
        "BY": [""], "BY-SA": [" sharealike", " share alike"], "BY-NC": [" noncommercial", " non commercial"],
        "BY-ND": [" noderivatives", " noderivs", " no derivatives"],
        "BY-NC-SA": [" noncommercial sharealike", " non commercial share alike"],
        "BY-NC-ND": [" noncommercial noderivatives", " noncommercial noderivs", " non commercial no derivatives"],
    }.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            v = version.replace(".", " ")
            out[f"CC-{kind}-{version}"] = [f"cc {kind.lower().replace('-', ' ')} {v}"] + [
                f"creative commons attribution{w}{end} {v}" if end == " license" or not end
                else f"creative commons attribution{w} {v}{end}"
                for w in words for end in ("", " license", " international", " unported", " generic")
            ]
    return out


#: Names by SPDX identifier, and BSD where the clauses are not said. A name is a licence only behind `UNDER` or
#: `WIDE`, an SPDX tag, a line `License:`, or `or` / `and` after another.
NAMES = _names()
#: Names that are also those of a body, a library or a mark: not behind `WIDE`, and not behind `and`.
BARE = {"mit", "isc", "zlib", "cc0"}

_TERMS = r" (?:either )?(?:of )?(?:(?:the|a|an) )?(?:terms (?:and conditions )?of (?:the |a )?)?(?:gnu (?=gnu ))?"
#: What stands before a name, normalised.
UNDER = rf"(?:licensed|licenced|released|distributed|redistributed|available) under{_TERMS}"
#: What stands before a name that can't be anything but a licence.
WIDE = rf"(?:(?:published|provided|offered|covered|dedicated) under|governed by|subject to){_TERMS}"
TAG = r"spdx license identifier "
#: A line that names the licence is read as an SPDX tag.
LINE = r"(?i)(?<![-a-z])licen[sc]e\s*:\s*"
#: A notice behind one of these says the opposite.
NOT = r"(?<! not )(?<! never )(?<! no longer )(?<! isn t )(?<! aren t )"
#: Only directly behind what was found before.
NEXT = r"\G (?:or|and) (?:the )?"
NEXT_BARE = r"\G or (?:the )?"

#: The sentences of the GNU notices for each licence and version, and of the Unlicense.
TEXTS: dict[str, list[str]] = {
    "unlicense_text": ["this is free and unencumbered software released into the public domain"],
    "gpl_hope": [
        f"this {x} is distributed in the hope that it will be useful, but without any warranty; without even "
        "the implied warranty of merchantability or fitness for a particular purpose."
        for x in ("library", "software", "file", "work", "package")
    ],
    "bsd_endorse": [
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."
    ],
    "isc_permission": [
        "permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "mit_conditions": [
        "the above copyright notice and this permission notice (including the next paragraph) shall be included in "
        "all copies or substantial portions of the software."
    ],
    "apache_copy": ["you may obtain a copy of the license at https://www.apache.org/licenses/license-2.0"],
}
#: Identifier of a GNU notice by licence.
GNU: dict[str, str] = {}
for _kind, _long in (("GPL", ""), ("LGPL", "lesser "), ("LGPL", "library "), ("AGPL", "affero ")):
    for _v in ("2", "2.1", "3"):
        _spdx = f"{_kind}-{_v if '.' in _v else _v + '.0'}"
        if f"{_spdx}-only" not in NAMES:
            continue
        _head = f"it under the terms of the gnu {_long}general public license"
        for _end, _tails in {
            "or-later": [f"either version {_v} of the license, or (at your option) any later version",
                         f"either version {_v}, or (at your option) any later version"],
            "only": [f"version {_v} of the license", f"version {_v}"],
        }.items():
            _id = GNU.setdefault(f"{_spdx}-{_end}", f"{_spdx}-{_end}".lower().replace("-", "_").replace(".", "_") + "_may")
            TEXTS.setdefault(_id, []).extend(f"{_head} as published by the free software foundation{_c} {_t}" for _t in _tails for _c in ("", ";"))
            if _end == "only":
                TEXTS[_id].append(f"{_head} version {_v} as published by the free software foundation")
