"""Ordered signature rules for license texts, over normalised words.

A rule matches the document's words joined by single spaces. Rules are tried
only where their keyword occurs. The lower its tier, the more a rule says; rules
of one tier are ordered as listed.
"""

from __future__ import annotations

from typing import NamedTuple

TAG, NOTICE, NAME, GENERIC = range(4)

# The phrases of the base scan and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Rule(NamedTuple):
    tier: int
    label: str
    keyword: str
    pattern: str
    confidence: float


LIC = "licen[cs]e"
VER = "(?:version |v ?)?"
# What notices of the GNU licenses put between the name and the version.
ISSUED = "(?:as published by the free software foundation (?:either )?)?"
# Optional words after a Creative Commons name without its version.
REST = f"(?: international| unported| generic)?(?: public)?(?: {LIC})?"
NC, ND, SA = "non ?commercial", "no ?deriv(?:ative)?s?(?: works)?", "share ?alike"
# Label, identifier as words, keyword and pattern of the name. A more exact
# version stands before the family it belongs to.
LICENSES = [
    ("agpl-3.0", "agpl 3 0", "affero general public", f"(?:(?:gnu )?affero general public {LIC} {ISSUED}{VER}3(?: 0)?|version 3(?: 0)? of the (?:gnu )?affero general public {LIC})"),
    ("agpl-1.0", "agpl 1 0", "affero general public", f"(?:(?:gnu )?affero general public {LIC} {ISSUED}{VER}1(?: 0)?|version 1(?: 0)? of the (?:gnu )?affero general public {LIC})"),
    ("agpl", "agpl", "affero general public", f"(?:gnu )?affero general public {LIC}"),
    ("lgpl-3.0", "lgpl 3 0", "lesser general public", f"(?:(?:gnu )?lesser general public {LIC} {ISSUED}{VER}3(?: 0)?|version 3(?: 0)? of the (?:gnu )?lesser general public {LIC})"),
    ("lgpl-2.1", "lgpl 2 1", "lesser general public", f"(?:(?:gnu )?lesser general public {LIC} {ISSUED}{VER}2 1|version 2 1 of the (?:gnu )?lesser general public {LIC})"),
    ("lgpl-2.0", "lgpl 2 0", "library general public", f"(?:(?:gnu )?library general public {LIC} {ISSUED}{VER}2(?: 0)?|version 2(?: 0)? of the (?:gnu )?library general public {LIC})"),
    ("lgpl", "lgpl", "general public", f"(?:gnu )?(?:lesser|library) general public {LIC}"),
    ("gpl-3.0", "gpl 3 0", "general public", f"(?:gnu general public {LIC} {ISSUED}{VER}3(?: 0)?|version 3(?: 0)? of the gnu general public {LIC})"),
    ("gpl-2.0", "gpl 2 0", "general public", f"(?:gnu general public {LIC} {ISSUED}{VER}2(?: 0)?|version 2(?: 0)? of the gnu general public {LIC})"),
    ("gpl-1.0", "gpl 1 0", "general public", f"(?:gnu general public {LIC} {ISSUED}{VER}1(?: 0)?|version 1(?: 0)? of the gnu general public {LIC})"),
    ("gpl", "gpl", "general public", f"gnu general public {LIC}"),
    ("gfdl-1.3", "gfdl 1 3", "free documentation", f"gnu free documentation {LIC} {VER}1 3"),
    ("gfdl-1.2", "gfdl 1 2", "free documentation", f"gnu free documentation {LIC} {VER}1 2"),
    ("gfdl", "gfdl", "free documentation", f"gnu free documentation {LIC}"),
    ("apache-2.0", "apache 2 0", "apache", f"apache (?:software )?{LIC} {VER}2(?: 0)?"),
    ("apache-1.1", "apache 1 1", "apache", f"apache (?:software )?{LIC} {VER}1 1"),
    ("apache-1.0", "apache 1 0", "apache", f"apache (?:software )?{LIC} {VER}1 0"),
    ("apache", "apache", "apache", f"apache (?:software )?{LIC}"),
    ("mit-0", "mit 0", "mit no attribution", f"mit no attribution(?: {LIC})?"),
    ("mit", "mit", "mit licen", f"mit {LIC}"),
    ("x11", "x11", "x11 licen", f"x11 {LIC}"),
    ("expat", "expat", "expat licen", f"expat {LIC}"),
    ("isc", "isc", "isc licen", f"isc {LIC}"),
    ("bsd-4-clause", "bsd 4 clause", "bsd", f"(?:(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause) {LIC}"),
    ("bsd-3-clause", "bsd 3 clause", "bsd", f"(?:(?:new|revised|modified|3 clause|three clause) bsd|bsd (?:3|three) clause) {LIC}"),
    ("bsd-2-clause", "bsd 2 clause", "bsd", f"(?:(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause) {LIC}"),
    ("bsd-1-clause", "bsd 1 clause", "bsd", f"(?:(?:1 clause|one clause) bsd|bsd (?:1|one) clause) {LIC}"),
    ("0bsd", "0bsd", "bsd", f"(?:(?:zero clause|0 clause|free public) bsd|bsd (?:0|zero) clause) {LIC}"),
    ("bsd", "bsd", "bsd", f"bsd (?:style )?{LIC}"),
    ("mpl-2.0", "mpl 2 0", "mozilla public", f"mozilla public {LIC} {VER}2(?: 0)?"),
    ("mpl-1.1", "mpl 1 1", "mozilla public", f"mozilla public {LIC} {VER}1 1"),
    ("mpl-1.0", "mpl 1 0", "mozilla public", f"mozilla public {LIC} {VER}1 0"),
    ("mpl", "mpl", "mozilla public", f"mozilla public {LIC}"),
    ("npl", "npl 1 1", "netscape public", f"netscape public {LIC}"),
    ("epl-2.0", "epl 2 0", "eclipse public", f"eclipse public {LIC} {VER}2(?: 0)?"),
    ("epl-1.0", "epl 1 0", "eclipse public", f"eclipse public {LIC} {VER}1(?: 0)?"),
    ("epl", "epl", "eclipse public", f"eclipse public {LIC}"),
    ("edl-1.0", "edl 1 0", "eclipse distribution", f"eclipse distribution {LIC}(?: {VER}1 0)?"),
    ("cpl-1.0", "cpl 1 0", "common public licen", f"common public {LIC}(?: {VER}1 0)?"),
    ("cddl-1.1", "cddl 1 1", "common development", f"common development and distribution {LIC} {VER}1 1"),
    ("cddl-1.0", "cddl 1 0", "common development", f"common development and distribution {LIC}(?: {VER}1 0)?"),
    ("cpal-1.0", "cpal 1 0", "common public attribution", f"common public attribution {LIC}"),
    ("ms-pl", "ms pl", "microsoft public", f"microsoft public {LIC}"),
    ("ms-rl", "ms rl", "microsoft reciprocal", f"microsoft reciprocal {LIC}"),
    ("artistic-2.0", "artistic 2 0", "artistic licen", f"artistic {LIC} {VER}2(?: 0)?"),
    ("artistic-1.0", "artistic 1 0", "artistic licen", f"artistic {LIC} {VER}1 0"),
    ("artistic", "artistic", "artistic licen", f"artistic {LIC}"),
    ("bsl-1.0", "bsl 1 0", "boost software", f"boost software {LIC}(?: {VER}1 0)?"),
    ("busl-1.1", "busl 1 1", "business source", f"business source {LIC}(?: {VER}1 1)?"),
    ("sspl-1.0", "sspl 1 0", "server side public", f"server side public {LIC}"),
    ("elastic-2.0", "elastic 2 0", "elastic licen", f"elastic {LIC}(?: {VER}2 0)?"),
    ("unlicense", "unlicense", "unlicen", f"(?:the )?un{LIC}"),
    ("wtfpl", "wtfpl", "you want to public", f"do what the fuck you want to public {LIC}"),
    ("zlib", "zlib", "zlib", f"zlib (?:libpng )?{LIC}"),
    ("libpng", "libpng", "libpng", f"libpng {LIC}"),
    ("curl", "curl", "curl licen", f"curl {LIC}"),
    ("openssl", "openssl", "openssl", f"openssl {LIC}"),
    ("postgresql", "postgresql", "postgresql", f"postgresql {LIC}"),
    ("psf-2.0", "psf 2 0", "python software foundation", f"python software foundation {LIC}"),
    ("python-2.0", "python 2 0", "python licen", f"python {LIC}(?: {VER}2 0)?"),
    ("php-3.01", "php 3 01", "php licen", f"php {LIC}(?: {VER}3 01)?"),
    ("ruby", "ruby", "ruby licen", f"ruby {LIC}"),
    ("vim", "vim", "vim licen", f"vim {LIC}"),
    ("tcl", "tcl", "tcl", f"tcl(?: tk)? {LIC}"),
    ("ncsa", "ncsa", "ncsa", f"(?:university of illinois )?(?:uiuc )?ncsa (?:open source )?{LIC}"),
    ("w3c", "w3c", "w3c", f"w3c (?:software (?:notice and )?)?{LIC}"),
    ("afl-3.0", "afl 3 0", "academic free", f"academic free {LIC}(?: {VER}3 0)?"),
    ("osl-3.0", "osl 3 0", "open software licen", f"open software {LIC}(?: {VER}3 0)?"),
    ("ecl-2.0", "ecl 2 0", "educational community", f"educational community {LIC}(?: {VER}2 0)?"),
    ("eupl-1.2", "eupl 1 2", "european union public", f"european union public {LIC} {VER}1 2"),
    ("eupl", "eupl", "european union public", f"european union public {LIC}"),
    ("cecill-2.1", "cecill 2 1", "cecill", f"cecill (?:free software )?{LIC}(?: {VER}2 1)?"),
    ("qpl-1.0", "qpl 1 0", "q public", f"q public {LIC}(?: {VER}1 0)?"),
    ("ipl-1.0", "ipl 1 0", "ibm public", f"ibm public {LIC}(?: {VER}1 0)?"),
    ("spl-1.0", "spl 1 0", "sun public", f"sun public {LIC}(?: {VER}1 0)?"),
    ("apsl-2.0", "apsl 2 0", "apple public source", f"apple public source {LIC}(?: {VER}2 0)?"),
    ("upl-1.0", "upl 1 0", "universal permissive", f"universal permissive {LIC}(?: {VER}1 0)?"),
    ("ofl-1.1", "ofl 1 1", "open font", f"(?:sil )?open font {LIC}(?: {VER}1 1)?"),
    ("odbl-1.0", "odbl 1 0", "open database", f"(?:open data commons )?open database {LIC}"),
    ("odc-by-1.0", "odc by 1 0", "open data commons", f"open data commons attribution {LIC}"),
    ("pddl-1.0", "pddl 1 0", "public domain dedication", f"public domain dedication and {LIC}"),
    ("blueoak-1.0.0", "blueoak 1 0 0", "blue oak", f"blue oak model {LIC}"),
    ("mulanpsl-2.0", "mulanpsl 2 0", "mulan", f"mulan (?:psl|permissive software {LIC})"),
    ("openrail", "openrail", "openrail", f"(?:creativeml |bigscience )?openrail(?: m)?(?: {LIC})?"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "by nc nd", f"cc by nc nd {VER}4 0"),
    ("cc-by-nc-nd", "cc by nc nd", "by nc nd", f"cc by nc nd(?: {VER}[123] [05])?"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "by nc sa", f"cc by nc sa {VER}4 0"),
    ("cc-by-nc-sa", "cc by nc sa", "by nc sa", f"cc by nc sa(?: {VER}[123] [05])?"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "by nc", f"cc by nc {VER}4 0"),
    ("cc-by-nc", "cc by nc", "by nc", f"cc by nc(?: {VER}[123] [05])?"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "by nd", f"cc by nd {VER}4 0"),
    ("cc-by-nd", "cc by nd", "by nd", f"cc by nd(?: {VER}[123] [05])?"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "by sa", f"cc by sa {VER}4 0"),
    ("cc-by-sa", "cc by sa", "by sa", f"cc by sa(?: {VER}[123] [05])?"),
    ("cc-by-4.0", "cc by 4 0", "cc by", f"cc by {VER}4 0"),
    ("cc-by-3.0", "cc by 3 0", "cc by", f"cc by {VER}3 0"),
    ("cc-by-2.0", "cc by 2 0", "cc by", f"cc by {VER}2 [05]"),
    ("cc-by", "cc by", "cc by", "cc by"),
    ("cc0-1.0", "cc0 1 0", "cc0", f"cc0(?: {VER}1 0)?(?: universal)?(?: {LIC})?"),
    ("cc0-1.0", "", "creative commons zero", f"creative commons zero(?: {VER}1 0)?(?: universal)?(?: {LIC})?"),
    ("cc-by-nc-nd-4.0", "", "attribution non", f"creative commons attribution {NC} {ND}(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-nc-nd", "", "attribution non", f"creative commons attribution {NC} {ND}(?:(?: {LIC})? {VER}[123] [05])?{REST}"),
    ("cc-by-nc-sa-4.0", "", "attribution non", f"creative commons attribution {NC} {SA}(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-nc-sa", "", "attribution non", f"creative commons attribution {NC} {SA}(?:(?: {LIC})? {VER}[123] [05])?{REST}"),
    ("cc-by-nc-4.0", "", "attribution non", f"creative commons attribution {NC}(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-nc", "", "attribution non", f"creative commons attribution {NC}(?:(?: {LIC})? {VER}[123] [05])?{REST}"),
    ("cc-by-nd-4.0", "", "attribution no", f"creative commons attribution {ND}(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-nd", "", "attribution no", f"creative commons attribution {ND}(?:(?: {LIC})? {VER}[123] [05])?{REST}"),
    ("cc-by-sa-4.0", "", "attribution share", f"creative commons attribution {SA}(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-sa", "", "attribution share", f"creative commons attribution {SA}(?:(?: {LIC})? {VER}[123] [05])?{REST}"),
    ("cc-by-4.0", "", "creative commons attribution", f"creative commons attribution(?: {LIC})? {VER}4 0{REST}"),
    ("cc-by-3.0", "", "creative commons attribution", f"creative commons attribution(?: {LIC})? {VER}3 0{REST}"),
    ("cc-by-2.0", "", "creative commons attribution", f"creative commons attribution(?: {LIC})? {VER}2 [05]{REST}"),
    ("cc-by", "", "creative commons attribution", f"creative commons attribution(?:(?: {LIC})? {VER}1 0)?{REST}"),
    ("0bsd", "", "free public licen", f"free public {LIC}(?: 1 0 0)?"),
    ("cc", "", "creative commons", f"creative commons {LIC}"),
]

# Abbreviated names, which say less: label, keyword and pattern. Abbreviations that
# are words of their own (mit, isc, zlib, ruby) count only before "license", above.
ABBREVIATIONS = [
    ("agpl-3.0", "agpl", f"(?:gnu )?agpl ?{VER}3(?: 0)?"),
    ("agpl-1.0", "agpl", f"agpl ?{VER}1(?: 0)?"),
    ("agpl", "agpl", "(?:gnu )?agpl"),
    ("lgpl-3.0", "lgpl", f"(?:gnu )?lgpl ?{VER}3(?: 0)?"),
    ("lgpl-2.1", "lgpl", f"(?:gnu )?lgpl ?{VER}2 1"),
    ("lgpl-2.0", "lgpl", f"(?:gnu )?lgpl ?{VER}2(?: 0)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("gpl-3.0", "gpl", f"(?:gnu )?gpl ?{VER}3(?: 0)?"),
    ("gpl-2.0", "gpl", f"(?:gnu )?gpl ?{VER}2(?: 0)?"),
    ("gpl-1.0", "gpl", f"(?:gnu )?gpl ?{VER}1(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gfdl-1.3", "fdl", f"(?:gnu fdl|gfdl) ?{VER}1 3"),
    ("gfdl-1.2", "fdl", f"(?:gnu fdl|gfdl) ?{VER}1 2"),
    ("gfdl", "fdl", "(?:gnu fdl|gfdl)"),
    ("apache-2.0", "apache", f"apache ?{VER}2(?: 0)? {LIC}"),
    ("apache-2.0", "apache", f"apache ?{VER}2 0(?! [0-9])"),
    ("apache-2.0", " asl", f"asl ?{VER}2 0"),
    ("apache-1.1", "apache", f"apache {VER}1 1 {LIC}"),
    ("apache-1.0", "apache", f"apache {VER}1 0 {LIC}"),
    ("bsd-4-clause", "bsd", "(?:bsd (?:4|four) clause|(?:4|four) clause bsd)"),
    ("bsd-3-clause", "bsd", "(?:bsd (?:3|three) clause|(?:3|three) clause bsd|bsd3)"),
    ("bsd-2-clause", "bsd", "(?:bsd (?:2|two) clause|(?:2|two) clause bsd|bsd2)"),
    ("bsd-1-clause", "bsd", "(?:bsd (?:1|one) clause|(?:1|one) clause bsd)"),
    ("0bsd", "bsd", "(?:bsd (?:0|zero) clause|(?:0|zero) clause bsd|0bsd)"),
    ("mpl-2.0", " mpl", f"mpl ?(?:{VER}2 0|v ?2)"),
    ("mpl-1.1", " mpl", f"mpl ?{VER}1 1"),
    ("mpl-1.0", " mpl", f"mpl ?{VER}1 0"),
    ("epl-2.0", " epl", f"epl ?(?:{VER}2 0|v ?2)"),
    ("epl-1.0", " epl", f"epl ?(?:{VER}1 0|v ?1)"),
    ("cpl-1.0", " cpl", f"cpl ?{VER}1 0"),
    ("cddl-1.1", "cddl", f"cddl ?{VER}1 1"),
    ("cddl-1.0", "cddl", f"cddl(?: ?{VER}1 0)?"),
    ("ms-pl", " ms pl", "ms pl"),
    ("ms-rl", " ms rl", "ms rl"),
    ("artistic-2.0", "artistic", f"artistic {VER}2 0"),
    ("bsl-1.0", " bsl", f"bsl ?{VER}1 0"),
    ("busl-1.1", " bsl", f"bsl ?{VER}1 1"),
    ("busl-1.1", "busl", f"busl ?{VER}1 1"),
    ("sspl-1.0", "sspl", f"sspl(?: ?{VER}1(?: 0)?)?"),
    ("wtfpl", "wtfpl", f"wtfpl(?: ?{VER}2(?: 0)?)?"),
    ("afl-3.0", " afl", f"afl ?{VER}3 0"),
    ("osl-3.0", " osl", f"osl ?{VER}3 0"),
    ("eupl-1.2", "eupl", f"eupl ?{VER}1 2"),
    ("eupl", "eupl", "eupl"),
    ("apsl-2.0", "apsl", f"apsl ?{VER}2(?: 0)?"),
    ("upl-1.0", " upl", f"upl ?{VER}1 0"),
    ("ofl-1.1", " ofl", f"(?:sil )?ofl ?{VER}1 1"),
    ("ofl-1.1", "sil ofl", "sil ofl"),
    ("odbl-1.0", "odbl", f"odbl(?: ?{VER}1 0)?"),
    ("pddl-1.0", "pddl", f"pddl ?{VER}1 0"),
]

# Sentences that belong to one license, whatever name stands near them.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", "permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification"),
    ("gpl", "under the terms of the gnu", f"under the terms of the gnu general public {LIC}"),
    ("gpl", "free software you can redistribute", "is free software you can redistribute it and or modify it"),
    ("apache-2.0", "you may not use this file", f"you may not use this file except in compliance with the {LIC}"),
    ("mpl-2.0", "source code form is subject", "source code form is subject to the terms of the mozilla public"),
    ("unlicense", "released into the public domain", "free and unencumbered software released into the public domain"),
    ("zlib", "provided as is without any express", "this software is provided as is without any express or implied warranty"),
    ("public-domain", "public domain", "(?:released into|placed in|dedicated to) the public domain"),
    ("cc-by-4.0", "creativecommons org", f"creativecommons org {LIC}s by 4 0"),
    ("cc-by-3.0", "creativecommons org", f"creativecommons org {LIC}s by 3 0"),
    ("cc-by-2.0", "creativecommons org", f"creativecommons org {LIC}s by 2 [05]"),
    ("cc-by", "creativecommons org", f"creativecommons org {LIC}s by 1 0"),
    ("cc-by-sa-4.0", "creativecommons org", f"creativecommons org {LIC}s by sa 4 0"),
    ("cc-by-sa", "creativecommons org", f"creativecommons org {LIC}s by sa [123] [05]"),
    ("cc-by-nc-4.0", "creativecommons org", f"creativecommons org {LIC}s by nc 4 0"),
    ("cc-by-nc", "creativecommons org", f"creativecommons org {LIC}s by nc [123] [05]"),
    ("cc-by-nd-4.0", "creativecommons org", f"creativecommons org {LIC}s by nd 4 0"),
    ("cc-by-nd", "creativecommons org", f"creativecommons org {LIC}s by nd [123] [05]"),
    ("cc-by-nc-sa-4.0", "creativecommons org", f"creativecommons org {LIC}s by nc sa 4 0"),
    ("cc-by-nc-sa", "creativecommons org", f"creativecommons org {LIC}s by nc sa [123] [05]"),
    ("cc-by-nc-nd-4.0", "creativecommons org", f"creativecommons org {LIC}s by nc nd 4 0"),
    ("cc-by-nc-nd", "creativecommons org", f"creativecommons org {LIC}s by nc nd [123] [05]"),
    ("cc0-1.0", "creativecommons org", "creativecommons org publicdomain zero 1 0"),
]

OTHERS = [
    ("proprietary", "all rights reserved", "all rights reserved", 0.3),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", 0.4),
    ("public-domain", "public domain", "public domain", 0.2),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 0.2),
    ("unknown-license", "licensed under", "licensed under(?: the)?", 0.1),
    ("unknown-license", "licenced under", "licenced under(?: the)?", 0.1),
]

GRANT = (
    f"(?:(?:is |are |be )?(?:{LIC}d|released|distributed|available|published|provided|made available) )"
    "(?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
)


def rules() -> list[Rule]:
    """All rules in order: identifiers, notices, names, generic phrases.

    Each license has three forms: its identifier after an SPDX tag, its name in
    a grant, and its name alone; an abbreviation has the last two.
    """
    out = []
    for label, words, _, _ in LICENSES:
        if words:
            pattern = f"spdx {LIC} identifier {words}(?: only| or later)?"
            out.append(Rule(TAG, label, "spdx", pattern, 1.0))
    for label, keyword, pattern in SENTENCES:
        out.append(Rule(NOTICE, label, keyword, pattern, 0.95))
    for label, _, keyword, name in LICENSES:
        out.append(Rule(NOTICE, label, keyword, GRANT + name, 0.9))
    for label, _, keyword, name in LICENSES:
        out.append(Rule(NAME, label, keyword, name, 0.6))
    for label, keyword, name in ABBREVIATIONS:
        out.append(Rule(NOTICE, label, keyword, GRANT + name, 0.9))
    for label, keyword, name in ABBREVIATIONS:
        out.append(Rule(NAME, label, keyword, name, 0.5))
    for label, keyword, pattern, confidence in OTHERS:
        out.append(Rule(GENERIC, label, keyword, pattern, confidence))
    return out


# Every rule and base phrase needs one of these somewhere in its words.
STEMS = (
    "licen", "spdx", "copyright", "domain", "rights", "proprietary", "permission", "redistribut",
    "creative", "openrail", "mulan", "cc0", "attribution", "software", "source code",
    "gpl", "fdl", "apache", "bsd", "cddl", "artistic", "busl", "sspl", "wtfpl", "eupl", "apsl", "odbl", "pddl",
    "asl", "mpl", "epl", "cpl", "ms pl", "ms rl", "bsl", "afl", "osl", "upl", "ofl",
)
# Those of them that many words contain: they count only where a word starts.
AT_START = ("asl", "mpl", "epl", "cpl", "ms pl", "ms rl", "bsl", "afl", "osl", "upl", "ofl")
