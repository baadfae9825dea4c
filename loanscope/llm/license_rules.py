"""Licence signature rules: hand-written regexes over normalised words.

A rule's regex is written over lower-case words joined by one space ("apache license version 2 0").
Any match contains one of ``keywords`` (pieces of words); they gate the regex.  Priority 1 is the
strongest: identifiers and texts, then notices and addresses, then titles, then general hints.
"""

from __future__ import annotations

from dataclasses import dataclass

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

L = "licen[cs]e"
V = "(?:version |v )?"

# Label, title regex, identifier regex (after "spdx license identifier"), address regex.
FAMILIES: list[tuple[str, str, str, str]] = [
    ("apache-1.0", f"apache (?:software )?{L} {V}1 0", "apache 1 0", "apache org licenses license 1 0"),
    ("apache-1.1", f"apache (?:software )?{L} {V}1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", f"apache (?:software )?{L} {V}2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("gpl-1.0", f"(?:gnu )?(?:gpl|general public {L}) {V}1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 1 0"),
    ("gpl-2.0", f"(?:gnu )?(?:gpl|general public {L}) {V}2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", f"(?:gnu )?(?:gpl|general public {L}) {V}3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("lgpl-2.0", f"(?:gnu )?(?:lgpl|(?:lesser|library) general public {L}) {V}2(?: 0)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    ("lgpl-2.1", f"(?:gnu )?(?:lgpl|(?:lesser|library) general public {L}) {V}2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", f"(?:gnu )?(?:lgpl|lesser general public {L}) {V}3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("agpl-3.0", f"(?:gnu )?(?:agpl|affero general public {L}) {V}3(?: 0)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("gfdl-1.1", f"(?:gnu )?(?:gfdl|free documentation {L}) {V}1 1", "gfdl 1 1(?: only| or later)?", "gnu org licenses (?:old licenses )?fdl 1 1"),
    ("gfdl-1.2", f"(?:gnu )?(?:gfdl|free documentation {L}) {V}1 2", "gfdl 1 2(?: only| or later)?", "gnu org licenses (?:old licenses )?fdl 1 2"),
    ("gfdl-1.3", f"(?:gnu )?(?:gfdl|free documentation {L}) {V}1 3", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("mit", f"(?:the )?(?:mit|expat)(?: x11)? {L}", "mit", "opensource org licenses mit"),
    ("mit-0", f"mit no attribution {L}", "mit 0", "opensource org licenses mit 0"),
    ("x11", f"x11 {L}", "x11", "spdx org licenses x11"),
    ("isc", f"isc {L}", "isc", "opensource org licenses isc"),
    ("bsd-1-clause", f"(?:1|one) clause bsd {L}", "bsd 1 clause", "opensource org licenses bsd 1 clause"),
    ("bsd-2-clause", f"(?:(?:2|two) clause bsd|(?:simplified|freebsd) bsd|bsd (?:2|two) clause) {L}", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", f"(?:(?:3|three) clause bsd|(?:new|modified|revised) bsd|bsd (?:3|three) clause) {L}", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", f"(?:(?:4|four) clause bsd|original bsd|bsd (?:4|four) clause) {L}", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", f"(?:zero clause bsd|0bsd|bsd zero clause) {L}", "0bsd", "opensource org licenses 0bsd"),
    ("mpl-1.0", f"mozilla public {L} {V}1 0", "mpl 1 0", "mozilla org mpl 1 0"),
    ("mpl-1.1", f"mozilla public {L} {V}1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", f"mozilla public {L} {V}2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("epl-1.0", f"eclipse public {L} {V}1 0", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", f"eclipse public {L} {V}2 0", "epl 2 0", "eclipse org legal epl 2 0"),
    ("cddl-1.0", f"common development and distribution {L}(?: {V}1 0)?", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl-1.1", f"common development and distribution {L} {V}1 1", "cddl 1 1", "opensource org licenses cddl 1 1"),
    ("cpl-1.0", f"common public {L}(?: {V}1 0)?", "cpl 1 0", "opensource org licenses cpl 1 0"),
    ("ipl-1.0", f"ibm public {L}(?: {V}1 0)?", "ipl 1 0", "opensource org licenses ipl 1 0"),
    ("eupl-1.1", f"european union public {L} {V}1 1", "eupl 1 1", "joinup ec europa eu eupl 1 1"),
    ("eupl-1.2", f"european union public {L} {V}1 2", "eupl 1 2", "joinup ec europa eu eupl 1 2"),
    ("artistic-1.0", f"artistic {L} {V}1 0", "artistic 1 0", "opensource org licenses artistic 1 0"),
    ("artistic-2.0", f"artistic {L} {V}2 0", "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("bsl-1.0", f"boost software {L}(?: {V}1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", f"business source {L}(?: {V}1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("zlib", f"zlib(?: libpng)? {L}", "zlib", "opensource org licenses zlib"),
    ("unlicense", "the unlicense", "unlicense", "unlicense org"),
    ("wtfpl", f"(?:wtfpl|do what the fuck you want to public {L})", "wtfpl", "wtfpl net"),
    ("python-2.0", f"python software foundation {L}(?: {V}2)?", "python 2 0", "docs python org license"),
    ("php-3.01", f"php {L} {V}3 01", "php 3 01", "php net license 3 01"),
    ("postgresql", f"postgresql {L}", "postgresql", "opensource org licenses postgresql"),
    ("openssl", f"openssl {L}", "openssl", "openssl org source license"),
    ("ofl-1.1", f"(?:sil )?open font {L}(?: {V}1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("ncsa", f"(?:university of illinois )?ncsa (?:open source )?{L}", "ncsa", "opensource org licenses ncsa"),
    ("afl-3.0", f"academic free {L} {V}3 0", "afl 3 0", "opensource org licenses afl 3 0"),
    ("osl-3.0", f"open software {L} {V}3 0", "osl 3 0", "opensource org licenses osl 3 0"),
    ("ms-pl", f"microsoft public {L}", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", f"microsoft reciprocal {L}", "ms rl", "opensource org licenses ms rl"),
    ("sspl-1.0", f"server side public {L}(?: {V}1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2.0", f"elastic {L} {V}2(?: 0)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("odbl-1.0", f"open (?:data commons open )?database {L}", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", f"open data commons attribution {L}", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", f"public domain dedication and {L}", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cc0-1.0", "(?:creative commons zero|cc0)(?: 1 0(?: universal)?)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
]

# Titles with an abbreviation beside the long form: either word gates them.
ABBREVIATED = {"gpl": ("gpl", "licen"), "lgpl": ("lgpl", "licen"), "agpl": ("agpl", "licen"), "gfdl": ("gfdl", "licen"),
               "wtfpl": ("wtfpl", "licen"), "cc0": ("cc0", "creative")}

CC_PARTS = {
    "by": ("by", "attribution"), "by-sa": ("by sa", "attribution share ?alike"), "by-nd": ("by nd", "attribution no ?deriv(?:ative)?s"),
    "by-nc": ("by nc", "attribution non ?commercial"), "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Sentences of licence texts and general hints: label, priority, confidence, keyword, regex.
SENTENCES: list[tuple[str, int, float, str | tuple[str, ...], str]] = [
    ("mit", 1, 0.98, "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 1, 0.95, "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 1, 0.95, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", 1, 0.9, "altered", "altered source versions must be plainly marked as such"),
    ("bsl-1.0", 1, 0.9, "machine", "machine executable object code generated by a source language processor"),
    ("unlicense", 1, 0.98, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("gpl", 1, 0.9, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 1, 0.9, "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", 1, 0.9, "affero", "under the terms of the gnu affero general public license"),
    ("apache-2.0", 1, 0.9, "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", 3, 0.6, "gnu", f"gnu (?:gpl|general public {L})"), ("lgpl", 3, 0.6, "gnu", f"gnu (?:lgpl|lesser general public {L})"),
    ("agpl", 3, 0.6, "affero", f"affero general public {L}"), ("gfdl", 3, 0.6, "gnu", f"gnu free documentation {L}"),
    ("apache", 3, 0.5, "apache", f"apache (?:software )?{L}"), ("bsd", 3, 0.5, "bsd", f"bsd (?:style )?{L}"),
    ("mpl", 3, 0.5, "mozilla", f"mozilla public {L}"), ("cc", 3, 0.4, "creative", f"creative commons {L}"),
    ("public-domain", 3, 0.6, "domain", "(?:released into|placed in|dedicated to|in) the public domain"),
    ("proprietary", 3, 0.6, "proprietary", "(?:confidential and proprietary|proprietary and confidential|proprietary license)"),
    ("no-redistribution", 3, 0.6, "reproduc", "(?:may not|must not|no part of this \\w+ may) be reproduced"),
    ("personal-use", 3, 0.5, "personal", "for personal(?: and)? non ?commercial use(?: only)?"),
    ("no-warranty", 4, 0.2, "warrant", "without (?:any )?warrant(?:y|ies) of any kind"),
    ("as-is", 4, 0.2, "provided", "provided (?:as is|by the copyright holders)"),
    ("copyright", 4, 0.3, "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("licensed", 4, 0.1, ("licen", "released"), "(?:licen[cs]ed|released) under"),
]


@dataclass(frozen=True)
class Rule:
    rule: int
    label: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]
    regex: str  # words joined by one space; matched between word boundaries


def _keyword(regex: str) -> str:
    """A plain piece that every match contains: the longest literal run of the regex outside groups and options."""
    depth, plain, runs = 0, "", []
    for i, c in enumerate(regex + " "):
        depth += (c in "([") - (c in ")]")
        if c.isalnum() and not depth and regex[i + 1:i + 2] != "?":
            plain += c
        else:
            runs.append(plain)
            plain = ""
    return max(runs, key=len)


def rules() -> list[Rule]:
    """The ordered rules: base phrases first (priority 0, never suppressed), then families by form, then sentences."""
    out: list[tuple[str, int, float, str | tuple[str, ...], str]] = []
    for phrase, label in BASE.items():
        out.append((label, 0, 0.5, max(phrase.split(), key=len), phrase))
    notice = ("(?:licen[cs]ed|released|distributed|published|provided|(?:made )?available|covered)(?: to you)? (?:under|by)"
              "(?: the)?(?: terms(?: and conditions)? of)?(?: the)? ")
    for label, title, ident, url in FAMILIES:
        out.append((label, 1, 1.0, "spdx", f"spdx {L} identifier {ident}"))
        either = ABBREVIATED.get(label.split("-")[0], _keyword(title))
        out.append((label, 2, 0.95, either, notice + f"(?:{title})"))
        out.append((label, 2, 0.9, _keyword(url), url))
        out.append((label, 3, 0.7, either, title))
    for part, (short, name) in CC_PARTS.items():
        for version in CC_VERSIONS:
            label = f"cc-{part}-{version.replace(' ', '.')}"
            out.append((label, 1, 1.0, "cc", f"(?:spdx {L} identifier )?cc {short} {version}"))
            out.append((label, 2, 0.95, "creative", f"creative commons {name}(?: {version})(?: international| unported| generic)?(?: {L})?"))
            out.append((label, 2, 0.9, "creativecommons", f"creativecommons org licenses {short} {version}"))
        out.append((f"cc-{part}", 3, 0.7, "cc", f"cc {short}"))
        out.append((f"cc-{part}", 3, 0.7, "creative", f"creative commons {name}(?: {L})?"))
    out.extend(SENTENCES)
    return [Rule(i, label, priority, conf, (kw,) if isinstance(kw, str) else kw, regex)
            for i, (label, priority, conf, kw, regex) in enumerate(out)]
