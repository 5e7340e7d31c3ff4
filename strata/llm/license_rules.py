"""Signature rules of the licence scan: hand-written patterns over normalised words.

Patterns see lower-case words with one space between them ("Apache-2.0" is "apache 2 0").
A family gives up to three rules, by what stands around the name; sentences and addresses
are rules of their own. A rule's keyword stands in each of its matches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Kinds in order of priority, and how sure each makes a document's licence.
KINDS = {"text": 1.0, "tag": 0.95, "grant": 0.9, "name": 0.6}

L = "licen[cs]e"
V = "(?: version| ver| v)?"
LICENSED = f"(?:dual |multi |re )?{L}d"
RELEASED = "(?:released|distributed|redistributed|provided|available|published|covered)"
UNDER = "(?:to you )?(?:under|by|with) (?:an? )?(?:the )?(?:terms (?:and conditions )?of )?(?:an? )?(?:the )?"
TAG = f"spdx {L} identifier "


def _gnu(kind: str, short: str, version: str) -> tuple[str, str]:
    """Name and short form of a GNU licence with a version."""
    words = f"(?:gnu )?{kind}general public {L}(?: {short})?(?: as published by the free software foundation)?(?: either)?{V} ?v?{version}(?: 0)?"
    return words, f"(?:gnu )?{short}{V} ?v?{version}(?: 0)?"


def _creative(parts: str, letters: str, version: str) -> tuple[str, str]:
    return f"creative commons {parts}(?: international| unported)?{V} {version} 0(?: international| unported)?(?: public)?(?: {L})?", f"cc {letters} {version} 0"


# Label; name that stands for itself; name that needs a grant in front; identifier.
FAMILIES: list[tuple[str, str, str, str]] = [
    ("mit", f"mit(?: x11)?(?: open source)? {L}", "mit(?: x11)?", "mit"),
    ("mit", f"expat {L}", "expat", ""),
    ("mit-0", f"mit no attribution(?: {L})?", "mit 0", "mit 0"),
    ("x11", f"x11 {L}", "x11", "x11"),
    ("apache", f"apache(?: software)? {L}", "apache", ""),
    ("apache-1.0", f"apache(?: software)? {L}{V} 1 0", "apache 1 0", "apache 1 0"),
    ("apache-1.1", f"apache(?: software)? {L}{V} 1 1", "apache 1 1", "apache 1 1"),
    ("apache-2.0", f"apache(?: software)?(?: foundation)? {L}{V} ?v?2(?: 0)?", f"apache{V} ?v?2(?: 0)?(?: {L})?", "apache 2 0"),
    ("gpl", f"(?:gnu )?general public {L}", "", ""),
    ("gpl", f"(?:gnu )?gpl {L}", "(?:gnu )?gpl", ""),
    ("gpl-1.0", *_gnu("", "gpl", "1"), "gpl 1 0(?: only)?"),
    ("gpl-2.0", *_gnu("", "gpl", "2"), "gpl 2 0(?: only)?"),
    ("gpl-2.0-or-later", _gnu("", "gpl", "2")[0] + "(?: of the licen[cs]e)? or(?: at your option)? any later(?: version)?", "gplv?2 or later", "gpl 2 0 or later"),
    ("gpl-3.0", *_gnu("", "gpl", "3"), "gpl 3 0(?: only)?"),
    ("gpl-3.0-or-later", _gnu("", "gpl", "3")[0] + "(?: of the licen[cs]e)? or(?: at your option)? any later(?: version)?", "gplv?3 or later", "gpl 3 0 or later"),
    ("lgpl", f"(?:gnu )?(?:lesser|library) general public {L}", "", ""),
    ("lgpl", f"(?:gnu )?lgpl {L}", "(?:gnu )?lgpl", ""),
    ("lgpl-2.0", *_gnu("(?:library|lesser) ", "lgpl", "2"), "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", f"(?:gnu )?lesser general public {L}(?: lgpl)?{V} 2 1", f"lgpl{V} ?v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", *_gnu("lesser ", "lgpl", "3"), "lgpl 3 0(?: only| or later)?"),
    ("agpl", f"(?:gnu )?affero general public {L}", "affero gpl", ""),
    ("agpl-1.0", f"affero general public {L}{V} 1(?: 0)?", "", "agpl 1 0(?: only| or later)?"),
    ("agpl-3.0", *_gnu("affero ", "agpl", "3"), "agpl 3 0(?: only| or later)?"),
    ("gfdl", f"(?:gnu )?free documentation {L}", "", ""),
    ("gfdl-1.2", f"(?:gnu )?free documentation {L}{V} 1 2", "", "gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", f"(?:gnu )?free documentation {L}{V} 1 3", "", "gfdl 1 3(?: only| or later)?"),
    ("bsd", f"bsd(?: style)? {L}", "bsd(?: style)?", ""),
    ("bsd-1-clause", f"bsd (?:1|one) clause(?: {L})?|(?:1|one) clause bsd {L}", "(?:1|one) clause bsd", "bsd 1 clause"),
    ("bsd-2-clause", f"(?:simplified|freebsd) bsd {L}|bsd (?:2|two) clause(?: {L})?|(?:2|two) clause bsd {L}", "(?:2|two) clause bsd", "bsd 2 clause"),
    ("bsd-3-clause", f"(?:new|revised|modified) bsd {L}|bsd (?:3|three) clause(?: {L})?|(?:3|three) clause bsd {L}", "(?:3|three) clause bsd", "bsd 3 clause"),
    ("bsd-4-clause", f"(?:original|old) bsd {L}|bsd (?:4|four) clause(?: {L})?|(?:4|four) clause bsd {L}", "(?:4|four) clause bsd", "bsd 4 clause"),
    ("0bsd", f"zero clause bsd(?: {L})?|bsd zero clause {L}", "0bsd", "0bsd"),
    ("isc", f"isc {L}", "isc", "isc"),
    ("zlib", f"zlib(?: libpng)? {L}", "zlib", "zlib"),
    ("libpng", f"libpng {L}(?:{V} 2)?", "", "libpng 2 0"),
    ("mpl", f"mozilla public {L}", "", ""),
    ("mpl-1.0", f"mozilla public {L}{V} 1 0", "", "mpl 1 0"),
    ("mpl-1.1", f"mozilla public {L}{V} 1 1", "", "mpl 1 1"),
    ("mpl-2.0", f"mozilla public {L}{V} ?v?2(?: 0)?", f"mpl{V} ?v?2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", f"eclipse public {L}{V} 1(?: 0)?", f"epl{V} ?v?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", f"eclipse public {L}{V} 2(?: 0)?", f"epl{V} ?v?2(?: 0)?", "epl 2 0"),
    ("epl", f"eclipse public {L}", "", ""),
    ("edl-1.0", f"eclipse distribution {L}(?:{V} 1(?: 0)?)?", "", ""),
    ("cddl-1.0", f"common development and distribution {L}(?: cddl)?(?:{V} 1(?: 0)?)?", f"cddl(?:{V} 1(?: 0)?)?", "cddl 1 0"),
    ("cddl-1.1", f"common development and distribution {L}(?: cddl)?{V} 1 1", f"cddl{V} 1 1", "cddl 1 1"),
    ("cpl-1.0", f"common public {L}(?:{V} 1(?: 0)?)?", "", "cpl 1 0"),
    ("ipl-1.0", f"ibm public {L}(?:{V} 1(?: 0)?)?", "", "ipl 1 0"),
    ("eupl-1.1", f"european union public {L}(?: eupl)?{V} 1 1", f"eupl{V} ?v?1 1", "eupl 1 1"),
    ("eupl-1.2", f"european union public {L}(?: eupl)?{V} 1 2", f"eupl{V} ?v?1 2", "eupl 1 2"),
    ("artistic-1.0", f"artistic {L}{V} 1(?: 0)?|original artistic {L}", "artistic 1 0", "artistic 1 0"),
    ("artistic-2.0", f"artistic {L}{V} 2(?: 0)?", "artistic 2 0", "artistic 2 0"),
    ("artistic", f"artistic {L}", "", ""),
    ("perl", f"same terms as perl(?: itself)? {L}", "same terms as perl(?: 5)?(?: itself)?", ""),
    ("bsl-1.0", f"boost software {L}(?:{V} 1(?: 0)?)?", "boost", "bsl 1 0"),
    ("busl-1.1", f"business source {L}(?:{V} 1 1)?", "", "busl 1 1"),
    ("sspl-1.0", f"server side public {L}(?:{V} 1)?", "", "sspl 1 0"),
    ("elastic-2.0", f"elastic {L}(?:{V} 2(?: 0)?)?", "", "elastic 2 0"),
    ("unlicense", "unlicen[cs]e", "", "unlicense"),
    ("wtfpl", "wtfpl", "", "wtfpl"),
    ("ms-pl", f"microsoft public {L}", "", "ms pl"),
    ("ms-rl", f"microsoft reciprocal {L}", "", "ms rl"),
    ("psf-2.0", f"python software foundation {L}(?:{V} 2)?|psf {L}(?:{V} 2)?", "psf", "(?:psf|python) 2 0"),
    ("python-2.0", f"python {L}(?:{V} 2(?: 0)?)?", "", ""),
    ("ruby", f"ruby {L}", "", "ruby"),
    ("php-3.01", f"php {L}(?:{V} 3 0(?:1| 1)?)?", "", "php 3 01"),
    ("postgresql", f"postgresql {L}", "", "postgresql"),
    ("openssl", f"openssl(?: ssleay)? {L}", "", "openssl"),
    ("curl", f"curl {L}", "", "curl"),
    ("ncsa", f"(?:university of illinois )?ncsa open source {L}", "ncsa", "ncsa"),
    ("afl-3.0", f"academic free {L}(?:{V} 3 0)?", "", "afl 3 0"),
    ("osl-3.0", f"open software {L}(?:{V} 3 0)?", "", "osl 3 0"),
    ("upl-1.0", f"universal permissive {L}(?:{V} 1 0)?", "", "upl 1 0"),
    ("ecl-2.0", f"educational community {L}(?:{V} 2 0)?", "", "ecl 2 0"),
    ("cecill-2.1", f"cecill(?: free software)? {L}(?: agreement)?(?:{V} 2 1)?", "cecill", "cecill 2 1"),
    ("ofl-1.1", f"(?:sil )?open font {L}(?:{V} 1 1)?", "", "ofl 1 1"),
    ("odbl-1.0", f"open (?:data commons open )?database {L}(?: odbl)?(?:{V} 1 0)?", "", "odbl 1 0"),
    ("odc-by-1.0", f"open data commons attribution {L}(?:{V} 1 0)?", "", "odc by 1 0"),
    ("pddl-1.0", f"public domain dedication and {L}(?: pddl)?", "", "pddl 1 0"),
    ("ogl-uk-3.0", f"open government {L}(?:{V} 3 0)?", "", "ogl uk 3 0"),
    ("vim", f"vim {L}", "", "vim"),
    ("tcl", f"tcl(?: tk)? {L}", "", "tcl"),
    ("jquery", f"jquery {L}", "", ""),
    ("openrail", f"(?:creativeml |bigscience )?openrail(?: m)? {L}", "(?:creativeml |bigscience )?openrail(?: m)?", ""),
    ("llama-community", f"llama(?: [0-9]+)?(?: [0-9]+)? community {L}(?: agreement)?", "", ""),
    ("cc0-1.0", f"cc0(?: 1 0)?(?: universal)? {L}", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc0-1.0", "creative commons zero(?: v?1 0)?(?: universal)?", "", ""),
    ("cc-by-2.0", *_creative("attribution", "by", "2"), "cc by 2 0"),
    ("cc-by-3.0", *_creative("attribution", "by", "3"), "cc by 3 0"),
    ("cc-by-4.0", *_creative("attribution", "by", "4"), "cc by 4 0"),
    ("cc-by-sa-2.0", *_creative("attribution share ?alike", "by sa", "2"), "cc by sa 2 0"),
    ("cc-by-sa-3.0", *_creative("attribution share ?alike", "by sa", "3"), "cc by sa 3 0"),
    ("cc-by-sa-4.0", *_creative("attribution share ?alike", "by sa", "4"), "cc by sa 4 0"),
    ("cc-by-nd-3.0", *_creative("attribution no ?deriv(?:ative)?s?", "by nd", "3"), "cc by nd 3 0"),
    ("cc-by-nd-4.0", *_creative("attribution no ?deriv(?:ative)?s?", "by nd", "4"), "cc by nd 4 0"),
    ("cc-by-nc-3.0", *_creative("attribution non ?commercial", "by nc", "3"), "cc by nc 3 0"),
    ("cc-by-nc-4.0", *_creative("attribution non ?commercial", "by nc", "4"), "cc by nc 4 0"),
    ("cc-by-nc-sa-3.0", *_creative("attribution non ?commercial share ?alike", "by nc sa", "3"), "cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", *_creative("attribution non ?commercial share ?alike", "by nc sa", "4"), "cc by nc sa 4 0"),
    ("cc-by-nc-nd-3.0", *_creative("attribution non ?commercial no ?deriv(?:ative)?s?", "by nc nd", "3"), "cc by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", *_creative("attribution non ?commercial no ?deriv(?:ative)?s?", "by nc nd", "4"), "cc by nc nd 4 0"),
    ("cc", f"creative commons(?: [^ ]+){{0,3}} {L}", "creative commons", ""),
]

# Label, a sentence of the licence's own text.
TEXTS: list[tuple[str, str]] = [
    ("mit", f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)?"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "neither the name of(?: [^ ]+){1,12} nor the names of (?:its|his|their) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non ?exclusive no charge royalty free irrevocable (?:copyright|patent|except)"),
    ("gpl-2.0-or-later", "either version 2 of the licen[cs]e or at your option any later version"),
    ("gpl-3.0-or-later", "either version 3 of the licen[cs]e or at your option any later version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl", "you should have received a copy of the gnu general public licen[cs]e along with this program"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with this (?:library|program)"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[cs]e along with this program"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("bsl-1.0", "distributed under the boost software licen[cs]e version 1 0"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original(?: [^ ]+){0,3} permission"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form(?: [^ ]+){0,30} licen[cs]e"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights(?: [^ ]+){0,8} waived all copyright"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "this (?:work|file|software|code|program) is (?:in the )?public domain"),
    ("psf-2.0", "copyright c (?:[0-9]+ ){1,20}python software foundation all rights reserved"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("ofl-1.1", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ncsa", "permission is hereby granted free of charge(?: [^ ]+){5,20} to deal with the software without restriction"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit(?: [^ ]+){0,6} licen[cs]e"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("wtfpl", "do what the fuck you want to public licen[cs]e"),
    ("beerware", "beer ?ware licen[cs]e"),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)(?: [^ ]+){0,12} copyright(?: [^ ]+){0,12} all rights reserved"),
    ("proprietary", "unauthori[sz]ed (?:copying|reproduction|distribution) of this (?:file|software|work)(?: [^ ]+){0,12} (?:prohibited|forbidden)(?: [^ ]+){0,12} copyright"),
]

# Label, words of an address.
ADDRESSES: list[tuple[str, str]] = [
    ("apache-2.0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache org licenses license 1 1"),
    ("mit", "opensource org licenses? mit"),
    ("mit", "mit license org"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses? bsd 3 clause"),
    ("isc", "opensource org licenses? isc"),
    ("artistic-2.0", "opensource org licenses? artistic 2 0"),
    ("gpl", "gnu org licenses gpl"),
    ("gpl-2.0", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu org licenses gpl 3 0"),
    ("lgpl", "gnu org licenses lgpl"),
    ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu org licenses fdl(?: 1 [0-9])?"),
    ("mpl-1.1", "mozilla org mpl mpl 1 1 licenses?"),
    ("mpl-2.0", "mozilla org licenses? mpl 2 0"),
    ("mpl-2.0", "mozilla org mpl 2 0 licenses?"),
    ("epl-2.0", "eclipse org licenses? epl 2 0"),
    ("epl-1.0", "eclipse org licenses? epl v10"),
    ("bsl-1.0", "boost org license 1 0"),
    ("unlicense", "unlicense org"),
    ("wtfpl", "wtfpl net"),
    ("ofl-1.1", "scripts sil org ofl licenses?"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "creativecommons org licenses by nc nd 4 0"),
]

#: Every match of every rule has one of these; texts without them are not looked into.
STEMS = ("licen", "copyright", "permission", "warrant", "redistribut", "domain", "commons", "clause", "attribution", "wtfpl", "advertising", "endorse", "royalty")


@dataclass(frozen=True)
class Rule:
    order: int
    kind: str
    label: str
    keyword: str
    pattern: str

    @property
    def priority(self) -> int:
        return list(KINDS).index(self.kind)


def alternatives(pattern: str) -> list[str]:
    """The pattern cut at the bars outside all groups."""
    depth, cuts = 0, [-1]
    for i, c in enumerate(pattern):
        depth += (c in "([") - (c in ")]")
        if c == "|" and not depth:
            cuts.append(i)
    return [pattern[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], len(pattern)], strict=True)]


def keyword(pattern: str) -> str:
    """The longest text that stands in every match: outside groups and classes, not optional."""
    many = r"(?:[?*+]|\{[^}]*\})?"
    while "(" in pattern:
        pattern = re.sub(r"\([^()]*\)" + many, "\n", pattern)
    pattern = re.sub(r"\[[^]]*\]" + many, "\n", pattern)
    return max(re.sub(r".\?", "\n", pattern).split("\n"), key=len).strip()


def rules() -> list[Rule]:
    """All rules, in the order in which equal matches are decided."""
    found: list[tuple[str, str, str]] = [("text", label, pattern) for label, pattern in TEXTS]
    found += [("tag", label, pattern) for label, pattern in ADDRESSES]
    found += [("tag", label, f"{TAG}(?:{spdx})") for label, _, _, spdx in FAMILIES if spdx]
    for label, names, shorts, _ in FAMILIES:
        for name in alternatives(names):
            found += [("grant", label, f"(?:{LICENSED}|{RELEASED}) {UNDER}{name}"), ("name", label, name)]
        for short in alternatives(shorts) if shorts else ():
            found += [("grant", label, f"{LICENSED} {UNDER}{short}"), ("grant", label, f"{RELEASED} {UNDER}{short} {L}")]
    return [Rule(i, kind, label, keyword(pattern), pattern) for i, (kind, label, pattern) in enumerate(found)]
