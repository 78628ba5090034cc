"""License signature rules.

A rule is a label, a priority, a keyword and a regular expression over the
normalised text: lower-case words parted by single spaces, punctuation gone
("Apache-2.0" reads "apache 2 0").  A rule's expression is tried only where
its keyword, which every match of it contains, occurs.  Priorities: 3 sentences of a license's own text, 2 notices,
addresses and identifiers that name it in full, 1 loose mentions.
"""

from __future__ import annotations

import re

_V = "(?:version |v)?"
_L = "licen[cs]e"

# Public license names, with their words as they are written.
_GNU = [("agpl", "affero general public", ("3",)), ("lgpl", "(?:lesser|library) general public", ("2", "2 1", "3")),
        ("gpl", "general public", ("1", "2", "3")), ("gfdl", "free documentation", ("1 1", "1 2", "1 3"))]
_CREATIVE = [("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
             ("by nc sa", "attribution non ?commercial share ?alike"), ("by nc", "attribution non ?commercial"),
             ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"), ("by sa", "attribution share ?alike"),
             ("by", "attribution")]
_CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# label, name as an expression, identifier as an expression, keyword
_NAMED = [
    ("mit", f"mit(?: x11)? {_L}", "mit", "mit"),
    ("x11", f"x11 {_L}", "x11", "x11"),
    ("apache-1", f"apache (?:software )?{_L} {_V}1(?: [01])?", "apache 1 [01]", "apache"),
    ("apache-2", f"apache (?:software )?{_L} {_V}2(?: 0)?", "apache 2 0", "apache"),
    ("bsd-2", f"(?:simplified|freebsd|2 clause|two clause) bsd {_L}", "bsd 2 clause", "bsd"),
    ("bsd-3", f"(?:modified|revised|new|3 clause|three clause) bsd {_L}", "bsd 3 clause", "bsd"),
    ("bsd-4", f"(?:original|4 clause|four clause) bsd {_L}", "bsd 4 clause", "bsd"),
    ("0bsd", f"(?:zero clause|0 clause) bsd {_L}", "0bsd", "bsd"),
    ("isc", f"isc {_L}", "isc", "isc"),
    ("mpl-1.1", f"mozilla public {_L} {_V}1 [01]", "mpl 1 [01]", "mozilla public"),
    ("mpl-2", f"mozilla public {_L} {_V}2(?: 0)?", "mpl 2 0", "mozilla public"),
    ("epl-1", f"eclipse public {_L} {_V}1(?: 0)?", "epl 1 0", "eclipse public"),
    ("epl-2", f"eclipse public {_L} {_V}2(?: 0)?", "epl 2 0", "eclipse public"),
    ("edl-1", f"eclipse distribution {_L}(?: {_V}1(?: 0)?)?", "edl 1 0", "eclipse distribution"),
    ("cddl-1", f"common development and distribution {_L} {_V}1(?: [01])?", "cddl 1 [01]", "common development"),
    ("cpl-1", f"common public {_L} {_V}1(?: 0)?", "cpl 1 0", "common public"),
    ("eupl-1.1", f"european union public licen[cs]e {_V}1 1", "eupl 1 1", "european union"),
    ("eupl-1.2", f"european union public licen[cs]e {_V}1 2", "eupl 1 2", "european union"),
    ("artistic-1", f"artistic {_L} {_V}1(?: 0)?", "artistic 1 0", "artistic"),
    ("artistic-2", f"artistic {_L} {_V}2(?: 0)?", "artistic 2 0", "artistic"),
    ("zlib", f"zlib(?: libpng)? {_L}", "zlib", "zlib"),
    ("libpng", f"libpng {_L}", "libpng(?: 2 0)?", "libpng"),
    ("bsl-1", f"boost software {_L}(?: {_V}1(?: 0)?)?", "bsl 1 0", "boost software"),
    ("busl-1.1", f"business source {_L}(?: {_V}1 1)?", "busl 1 1", "business source"),
    ("python-2", f"(?:python software foundation|psf) {_L}(?: {_V}2(?: 0)?)?", "(?:psf|python) 2 0", "licen"),
    ("postgresql", f"postgresql {_L}", "postgresql", "postgresql"),
    ("openssl", f"openssl {_L}", "openssl", "openssl"),
    ("php-3", f"php {_L}(?: {_V}3(?: 01?)?)?", "php 3 01?", "php"),
    ("ruby", f"ruby {_L}", "ruby", "ruby"),
    ("perl", f"same terms as perl(?: itself)?", "artistic 1 0 perl", "perl"),
    ("unlicense", f"(?:the|this) unlicen[cs]e", "unlicense", "unlicen"),
    ("wtfpl", "do what the f ?u ?c ?k you want to public licen[cs]e", "wtfpl", "do what the f"),
    ("beerware", f"beer ?ware {_L}", "beerware", "beer"),
    ("ms-pl", f"microsoft public {_L}", "ms pl", "microsoft public"),
    ("ms-rl", f"microsoft reciprocal {_L}", "ms rl", "microsoft reciprocal"),
    ("ofl-1.1", f"sil open font {_L}(?: {_V}1 1)?", "ofl 1 [01]", "sil open font"),
    ("afl-3", f"academic free {_L} {_V}3(?: 0)?", "afl 3 0", "academic free"),
    ("osl-3", f"open software {_L} {_V}3(?: 0)?", "osl 3 0", "open software"),
    ("ecl-2", f"educational community {_L}(?: {_V}2(?: 0)?)?", "ecl 2 0", "educational community"),
    ("ncsa", f"university of illinois ncsa open source {_L}", "ncsa", "ncsa"),
    ("upl-1", f"universal permissive {_L}(?: {_V}1(?: 0)?)?", "upl 1 0", "universal permissive"),
    ("vim", f"vim {_L}", "vim", "vim"),
    ("ipl-1", f"ibm public {_L}(?: {_V}1(?: 0)?)?", "ipl 1 0", "ibm public"),
    ("spl-1", f"sun public {_L}(?: {_V}1(?: 0)?)?", "spl 1 0", "sun public"),
    ("qpl-1", f"q public {_L}(?: {_V}1(?: 0)?)?", "qpl 1 0", "q public"),
    ("lppl-1.3", f"latex project public {_L}(?: {_V}1 3[ac]?)?", "lppl 1 3[ac]?", "latex project"),
    ("cecill-2", f"cecill (?:free software )?{_L}(?: {_V}2(?: [01])?)?", "cecill 2 [01]", "cecill"),
    ("mulan-2", f"mulan psl {_V}2|mulan permissive software {_L} {_V}2", "mulanpsl 2 0", "mulan"),
    ("sspl-1", f"server side public {_L}(?: {_V}1)?", "sspl 1 0", "server side public"),
    ("elastic-2", f"elastic {_L} {_V}2(?: 0)?", "elastic 2 0", "elastic"),
    ("commons-clause", f"commons clause(?: {_L})?", "commons clause", "commons"),
    ("odbl-1", f"open (?:data commons )?(?:open )?database {_L}(?: {_V}1(?: 0)?)?", "odbl 1 0", "database"),
    ("odc-by-1", f"open data commons attribution {_L}(?: {_V}1(?: 0)?)?", "odc by 1 0", "open data commons"),
    ("pddl-1", f"(?:open data commons )?public domain dedication and {_L}", "pddl 1 0", "public domain"),
    ("ogl-3", f"open government licen[cs]e {_V}3(?: 0)?", "ogl uk 3 0", "open government"),
    ("openrail", f"(?:creative ml )?open ?rail(?: m)?(?: {_L})?", "openrail", "rail"),
    ("llama-2", f"llama 2 community {_L}", "llama2", "llama"),
]

# label, keyword, sentence or address of the license's own
_SENTENCES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "furnished", "to permit persons to whom the software is furnished to do so subject to the following"),
    ("mit", "opensource", "opensource org licen[cs]es mit"),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "neither the name", "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "apache", "apache org licen[cs]es licen[cs]e 2 0"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the licen[cs]e"),
    ("apache-1", "apache", "this product includes software developed by the apache (?:group|software foundation)"),
    ("gpl", "redistribute it", "free software you can redistribute it and or modify it under the terms of the gnu general public"),
    ("gpl", "warranty", "gpl comes with absolutely no warranty"),
    ("lgpl", "redistribute it", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public"),
    ("agpl", "redistribute it", "redistribute it and or modify it under the terms of the gnu affero general public"),
    ("gpl", "gnu", "gnu org licen[cs]es(?: gpl)?(?: \\d 0)?"),
    ("gfdl", "gnu", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public"),
    ("mpl-2", "mozilla", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-1", "eclipse", "eclipse org legal epl v10(?: html)?"),
    ("epl-2", "eclipse", "eclipse org legal epl (?:2 0|v20)"),
    ("zlib", "freely", "to alter it and redistribute it freely subject to the following restrictions"),
    ("bsl-1", "boost", "boost org licen[cs]e 1 0 txt"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicen", "unlicen[cs]e org"),
    ("wtfpl", "wtfpl", "wtfpl net"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("ofl-1.1", "scripts sil", "scripts sil org ofl"),
    ("cddl-1", "common development", "subject to the terms of the common development and distribution"),
    ("python-2", "python", "python software foundation all rights reserved"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("cc0-1", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("cc0-1", "waived", "waived all copyright and related or neighboring rights"),
    ("proprietary", "strictly prohibited", "unauthorized (?:copying|use|reproduction) (?:\\S+ ){0,12}strictly prohibited"),
    ("proprietary", "confidential", "proprietary and confidential"),
]

def _literal(pattern: str) -> str:
    """The characters that every match of a pattern begins with."""
    first = re.match("[a-z0-9 ]*", pattern).group()
    return first[:-1] if pattern[len(first):len(first) + 1] == "?" else first


def _label(name: str, version: str) -> str:
    short = version.replace(" ", ".")
    return f"{name}-{short[:-2] if short.endswith('.0') else short}"


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, expression); expressions match whole words."""
    out: list[tuple[str, int, str, str]] = []

    def add(label: str, priority: int, keyword: str, pattern: str) -> None:
        out.append((label, priority, keyword, f"(?<= )(?:{pattern})(?= )"))

    for label, keyword, sentence in _SENTENCES:
        add(label, 3, keyword, sentence)
    for label, name, ident, keyword in _NAMED:
        add(label, 2, keyword, name)
        add(label, 2, "spdx", f"spdx {_L} identifier {ident}")
        add(label, 1, "licen", f"licen[cs]ed? (?:under )?(?:the )?(?:terms of )?(?:the )?{ident}")
        if " " in ident:
            add(label, 1, _literal(ident) or " 2 0", ident)
    for short, name, versions in _GNU:
        add(short, 1, "gnu", f"gnu {name} {_L}")
        add(short, 1, short, f"(?:under the|the) {short}(?: {_L})?")
        for v in versions:
            label = _label(short, v)
            own = f"{v}(?: 0)?" if len(v) == 1 else v
            add(label, 2, "gnu", f"gnu {name} {_L}(?: as published by the free software foundation)? (?:either )?{_V}{own}")
            add(label, 2, short, f"(?:gnu )?{short} ?{_V}{own}(?: only)?")
            add(f"{label}-or-later", 2, "later", f"(?:gnu )?(?:{short}|{name} {_L}) ?{_V}{own} or (?:\\S+ ){{0,4}}?later(?: version)?")
            add(label, 2, "spdx", f"spdx {_L} identifier {short} {own}(?: only)?")
            add(f"{label}-or-later", 2, "spdx", f"spdx {_L} identifier {short} {own} or later")
    for short, name in _CREATIVE:
        label = "cc-" + short.replace(" ", "-")
        add(label, 1, "creative commons", f"creative commons {name}(?: \\d 0)?(?: (?:inter|un)(?:national|ported))?(?: {_L})?")
        add(label, 1, " cc ", f"cc {short}")
        add(label, 2, "creativecommons", f"creativecommons org licen[cs]es {short}(?: \\d \\d)?")
        for v in _CREATIVE_VERSIONS:
            add(_label(label, v), 2, " cc ", f"cc {short} {v}")
            add(_label(label, v), 2, "spdx", f"spdx {_L} identifier cc {short} {v}")
            add(_label(label, v), 2, "creative commons", f"creative commons {name} {v}(?: (?:inter|un)(?:national|ported))?(?: {_L})?")
    add("cc0-1", 2, "cc0", "cc0(?: 1 0)?(?: universal)?")
    add("cc", 1, "creative commons", f"creative commons {_L}")
    add("proprietary", 1, "all rights reserved", "all rights reserved")
    add("public-domain", 1, "public domain", "in the public domain")
    return out


def _gate() -> tuple[str, ...]:
    words = {"licen", "gpl", "gfdl"}  # one of them is in every "or later"
    for _, _, keyword, pattern in rules():
        bare, n = pattern[len("(?<= )(?:"):-len(")(?= )")], 1
        while n:  # what no group holds
            bare, n = re.subn(r"\([^()]*\)(?:[?*+]|\{[^}]*\}\??)?", "#", bare)
        if keyword != "later":
            words.add(next((w for w in ("licen", "gpl") if w in bare and "|" not in bare), keyword))
    return tuple(sorted(w for w in words if not any(o != w and o in w for o in words)))


#: Every match of a rule contains one of these.
GATE = _gate()
