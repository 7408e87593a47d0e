"""License scans: fixed phrases by words, and ordered signature rules behind a keyword prefilter.

Rules are hand-written signatures of short names and of the licenses' own sentences, and names of a table of licenses within a few
sentence frames. One pass finds which of the rules' keywords a text holds; a rule runs only if its own, a piece without
separators that its pattern cannot match without, is among them. A detection that lies inside another is dropped; of
two with the same interval the earlier rule's stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb

#: Phrases of the base and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label, SPDX identifier, how the name is written (spaces stand for any run of other characters), own keyword.
LICENSES = """
agpl-3.0|agpl-3.0|gnu affero general public licen[cs]e|affero
agpl-3.0|agpl-3.0-only|affero gpl|affero
agpl-3.0|agpl-3.0-or-later|agplv3|agpl
lgpl-2.1|lgpl-2.1|gnu (?:lesser|library) general public licen[cs]e(?: \\S{1,12})? (?:version |v ?)2(?: 1)?|general public
lgpl-3.0|lgpl-3.0|gnu lesser general public licen[cs]e(?: \\S{1,12})? (?:version |v ?)3|lesser
lgpl-2.1|lgpl-2.1|gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation(?: either)? (?:version |v ?)2(?: 1)?|general public
lgpl-3.0|lgpl-3.0|gnu lesser general public licen[cs]e as published by the free software foundation(?: either)? (?:version |v ?)3|lesser
lgpl|lgpl|gnu (?:lesser|library) general public licen[cs]e|general public
lgpl-2.1|lgpl-2.1-or-later|lgplv2|lgpl
lgpl-3.0|lgpl-3.0-or-later|lgplv3|lgpl
gpl-2.0|gpl-2.0|gnu general public licen[cs]e(?: \\S{1,12})?,? (?:version |v ?)2|general public
gpl-3.0|gpl-3.0|gnu general public licen[cs]e(?: \\S{1,12})?,? (?:version |v ?)3|general public
gpl-1.0|gpl-1.0|gnu general public licen[cs]e(?: \\S{1,12})?,? (?:version |v ?)1|general public
gpl-2.0|gpl-2.0|gnu general public licen[cs]e as published by the free software foundation(?: either)? (?:version |v ?)2|general public
gpl-3.0|gpl-3.0|gnu general public licen[cs]e as published by the free software foundation(?: either)? (?:version |v ?)3|general public
gpl-1.0|gpl-1.0|gnu general public licen[cs]e as published by the free software foundation(?: either)? (?:version |v ?)1|general public
gpl|gpl|gnu general public licen[cs]e|general public
gpl-2.0|gpl-2.0-only|gplv2|gpl
gpl-3.0|gpl-3.0-only|gplv3|gpl
gpl-2.0|gpl-2.0-or-later|gpl 2 0 or later|gpl
gpl-3.0|gpl-3.0-or-later|gpl 3 0 or later|gpl
gfdl-1.3|gfdl-1.3|gnu free documentation licen[cs]e|free documentation
apache-2.0|apache-2.0|apache (?:software )?licen[cs]e,? (?:version |v ?)2|apache
apache-1.1|apache-1.1|apache (?:software )?licen[cs]e,? (?:version |v ?)1 1|apache
apache-1.0|apache-1.0|apache (?:software )?licen[cs]e,? (?:version |v ?)1 0|apache
apache|apache|apache (?:software )?licen[cs]e|apache
mit-0|mit-0|mit no attribution(?: licen[cs]e)?|no attribution
mit|mit|mit licen[cs]e|mit
mit|x11|x11 licen[cs]e|x11
expat|expat|expat licen[cs]e|expat
bsd-4-clause|bsd-4-clause|(?:4 clause|original) bsd licen[cs]e|bsd
bsd-3-clause|bsd-3-clause|(?:3 clause|new|revised|modified) bsd licen[cs]e|bsd
bsd-2-clause|bsd-2-clause|(?:2 clause|simplified|freebsd) (?:bsd )?licen[cs]e|licen
bsd-3-clause|bsd-3-clause-clear|clear bsd licen[cs]e|bsd
0bsd|0bsd|zero clause bsd(?: licen[cs]e)?|bsd
bsd|bsd|bsd(?: style)? licen[cs]e|bsd
isc|isc|isc licen[cs]e|isc
mpl-1.1|mpl-1.1|mozilla public licen[cs]e,? (?:version |v ?)1 1|mozilla
mpl-2.0|mpl-2.0|mozilla public licen[cs]e,? (?:version |v ?)2|mozilla
mpl|mpl|mozilla public licen[cs]e|mozilla
epl-1.0|epl-1.0|eclipse public licen[cs]e(?: v)? 1|eclipse
epl-2.0|epl-2.0|eclipse public licen[cs]e(?: v)? 2|eclipse
epl|epl|eclipse public licen[cs]e|eclipse
eupl-1.2|eupl-1.2|european union public licen[cs]e|european
cddl-1.0|cddl-1.0|common development and distribution licen[cs]e|common development
cpl-1.0|cpl-1.0|common public licen[cs]e|common public
cpal-1.0|cpal-1.0|common public attribution licen[cs]e|attribution
artistic-1.0|artistic-1.0|artistic licen[cs]e 1 0|artistic
artistic-2.0|artistic-2.0|artistic licen[cs]e 2 0|artistic
artistic|artistic|artistic licen[cs]e|artistic
bsl-1.0|bsl-1.0|boost software licen[cs]e|boost
busl-1.1|busl-1.1|business source licen[cs]e|business source
elastic-2.0|elastic-2.0|elastic licen[cs]e|elastic
sspl-1.0|sspl-1.0|server side public licen[cs]e|server side
python-2.0|python-2.0|python software foundation licen[cs]e|python
psf-2.0|psf-2.0|psf licen[cs]e|psf
php-3.01|php-3.01|php licen[cs]e|php
ruby|ruby|ruby licen[cs]e|ruby
zlib|zlib|zlib licen[cs]e|zlib
libpng|libpng-2.0|libpng licen[cs]e|libpng
openssl|openssl|openssl licen[cs]e|openssl
postgresql|postgresql|postgresql licen[cs]e|postgresql
ncsa|ncsa|university of illinois ncsa open source licen[cs]e|ncsa
ms-pl|ms-pl|microsoft public licen[cs]e|microsoft
ms-rl|ms-rl|microsoft reciprocal licen[cs]e|microsoft
osl-3.0|osl-3.0|open software licen[cs]e|open software
afl-3.0|afl-3.0|academic free licen[cs]e|academic free
ecl-2.0|ecl-2.0|educational community licen[cs]e|educational community
ofl-1.1|ofl-1.1|sil open font licen[cs]e|open font
wtfpl|wtfpl|do what the fuck you want to public licen[cs]e|fuck
unlicense|unlicense|the unlicense|unlicense
odbl-1.0|odbl-1.0|open (?:data commons open )?database licen[cs]e|database
odc-by-1.0|odc-by-1.0|open data commons attribution licen[cs]e|open data
pddl-1.0|pddl-1.0|public domain dedication and licen[cs]e|dedication
cc0-1.0|cc0-1.0|cc0(?: 1 0)?(?: universal)?|cc0
openrail|openrail|open ?rail(?: m)? licen[cs]e|rail
llama|llama|llama (?:\\d )?community licen[cs]e|llama
upl-1.0|upl-1.0|universal permissive licen[cs]e|permissive
zpl-2.1|zpl-2.1|zope public licen[cs]e|zope
qpl-1.0|qpl-1.0|q public licen[cs]e|q public
nasa-1.3|nasa-1.3|nasa open source agreement|nasa
w3c|w3c|w3c software (?:notice and )?licen[cs]e|w3c
vim|vim|vim licen[cs]e|vim
json|json|json licen[cs]e|json
beerware|beerware|beerware licen[cs]e|beer
commercial|licenseref-proprietary|(?:commercial|proprietary) licen[cs]e|licen
"""
#: Hand-written signatures in their order: label, how sure, pattern. Short names first, then sentences of the licenses' own texts.
SIGNATURES = """
agpl-3.0 0.9 => (?:gnu )?agpl ?(?:version |v ?)?3
agpl-3.0 0.9 => affero general public licen[cs]e
gpl-3.0 0.9 => (?:gnu )?gpl ?(?:version |v ?)?3
gpl-2.0 0.9 => (?:gnu )?gpl ?(?:version |v ?)?2
gpl-1.0 0.8 => (?:gnu )?gpl (?:version |v ?)1
gpl-3.0 0.9 => (?:gnu )?gpl licen[cs]e ?(?:version |v ?)?3
gpl-2.0 0.9 => (?:gnu )?gpl licen[cs]e ?(?:version |v ?)?2
gpl-3.0 0.9 => general public licen[cs]e version 3
gpl-2.0 0.9 => general public licen[cs]e version 2
lgpl-3.0 0.9 => (?:gnu )?lgpl ?(?:version |v ?)?3
lgpl-2.1 0.9 => (?:gnu )?lgpl ?(?:version |v ?)?2 1
lgpl-2.0 0.85 => (?:gnu )?lgpl (?:version |v ?)2(?: 0)?
lgpl-3.0 0.9 => lesser general public licen[cs]e (?:version |v ?)3
lgpl-2.1 0.9 => lesser general public licen[cs]e (?:version |v ?)2
lgpl 0.7 => (?:gnu )?lgpl
gpl 0.7 => gnu gpl
gpl 0.7 => gpl licen[cs]e(?:d)?
gpl 0.7 => (?:under|of) the gpl
gpl 0.7 => released under gpl
gfdl-1.3 0.9 => gfdl ?(?:version |v ?)?1 3
gfdl-1.2 0.9 => gfdl ?(?:version |v ?)?1 2
gfdl 0.7 => gnu fdl
gfdl 0.7 => gfdl
apache-2.0 0.9 => apache 2(?: 0)? licen[cs]e(?:d)?
apache-2.0 0.85 => apache ?(?:v)?2 0
apache-2.0 0.85 => apache licen[cs]e 2(?: 0)?
apache-2.0 0.85 => asl 2 0
apache-2.0 0.95 => www apache org licenses license 2 0
mit 0.8 => mit x11(?: licen[cs]e)?
mit 0.8 => mit expat(?: licen[cs]e)?
mit 0.75 => licen[cs]ed under (?:the )?mit
mit 0.75 => released under (?:the )?mit
mit 0.75 => mit licen[cs]ed
mit 0.75 => mit style licen[cs]e
mit 0.9 => opensource org licenses mit
bsd-4-clause 0.85 => bsd 4 clause
bsd-3-clause 0.85 => bsd 3 clause
bsd-2-clause 0.85 => bsd 2 clause
bsd-1-clause 0.85 => bsd 1 clause
bsd-3-clause 0.85 => (?:3|three) clause bsd
bsd-2-clause 0.85 => (?:2|two) clause bsd
bsd-4-clause 0.85 => (?:4|four) clause bsd
bsd-3-clause 0.8 => new bsd
bsd-2-clause 0.8 => simplified bsd
bsd 0.7 => licen[cs]ed under (?:the )?bsd
bsd-3-clause 0.9 => opensource org licenses bsd 3 clause
bsd-2-clause 0.9 => opensource org licenses bsd 2 clause
0bsd 0.85 => bsd zero clause
0bsd 0.85 => 0bsd
isc 0.7 => licen[cs]ed under (?:the )?isc
mpl-2.0 0.85 => mpl ?(?:version |v ?)?2(?: 0)?
mpl-1.1 0.85 => mpl ?(?:version |v ?)?1 1
mpl-2.0 0.95 => mozilla org mpl 2 0
mpl 0.7 => under the mpl
epl-2.0 0.85 => epl ?(?:version |v ?)?2 0
epl-1.0 0.85 => epl ?(?:version |v ?)?1 0
epl-2.0 0.95 => eclipse org legal epl 2 0
epl-1.0 0.95 => eclipse org legal epl v10
eupl-1.2 0.85 => eupl ?(?:version |v ?)?1 2
eupl-1.1 0.85 => eupl ?(?:version |v ?)?1 1
cddl-1.1 0.85 => cddl ?(?:version |v ?)?1 1
cddl-1.0 0.85 => cddl ?(?:version |v ?)?1(?: 0)?
cddl-1.0 0.7 => cddl
cpl-1.0 0.8 => cpl ?(?:version |v ?)?1 0
osl-3.0 0.8 => osl ?(?:version |v ?)?3 0
afl-3.0 0.8 => afl ?(?:version |v ?)?3 0
ofl-1.1 0.85 => (?:sil )?ofl ?(?:version |v ?)?1 1
ofl-1.1 0.9 => scripts sil org ofl
artistic-2.0 0.85 => artistic licen[cs]e (?:version |v ?)2
artistic-1.0 0.85 => artistic licen[cs]e (?:version |v ?)1
artistic-1.0-perl 0.8 => same terms as perl itself
bsl-1.0 0.9 => boost org license 1 0
bsl-1.0 0.85 => boost licen[cs]e
zlib 0.8 => zlib libpng licen[cs]e
unlicense 0.9 => unlicense org
wtfpl 0.85 => wtfpl
sspl-1.0 0.85 => sspl ?(?:version |v ?)?1
busl-1.1 0.85 => busl ?1 1
elastic-2.0 0.85 => elastic licen[cs]e (?:version |v ?)?2
cc0-1.0 0.95 => publicdomain zero 1 0
cc0-1.0 0.85 => creative commons zero
cc0-1.0 0.85 => creative commons cc0
public-domain 0.8 => creativecommons org publicdomain mark
public-domain 0.7 => released to the public domain
public-domain 0.7 => dedicated to the public domain
public-domain 0.7 => placed in the public domain
odbl-1.0 0.85 => odbl ?(?:version |v ?)?1 0
odbl-1.0 0.75 => odbl
odc-by-1.0 0.85 => odc by(?: 1 0)?
pddl-1.0 0.85 => pddl(?: 1 0)?
openrail 0.85 => (?:creativeml|bigscience|bigcode) openrail(?: m)?
openrail 0.8 => bigscience rail
llama 0.85 => llama ?(?:2|3) licen[cs]e
gemma 0.85 => gemma terms of use
psf-2.0 0.85 => psf licen[cs]e agreement
php-3.01 0.85 => php licen[cs]e (?:version |v ?)3 01
ms-pl 0.85 => ms pl
ms-rl 0.85 => ms rl
ncsa 0.8 => university of illinois ncsa
curl 0.8 => curl licen[cs]e
ftl 0.85 => freetype (?:project )?licen[cs]e
ijg 0.85 => independent jpeg group s software
openldap 0.85 => openldap public licen[cs]e
sleepycat 0.85 => sleepycat licen[cs]e
hpnd 0.85 => historical permission notice and disclaimer
cecill-2.1 0.85 => cecill ?(?:version |v ?)?2 1
cecill 0.75 => cecill
mulanpsl-2.0 0.85 => mulan psl ?(?:v)?2
mulanpsl-2.0 0.85 => mulan permissive software licen[cs]e
blueoak-1.0.0 0.85 => blue oak model licen[cs]e
polyform 0.85 => polyform (?:noncommercial|small business|strict|shield) licen[cs]e
commons-clause 0.85 => commons clause
ogl-3.0 0.85 => open government licen[cs]e (?:version |v ?)?3
ogl 0.8 => open government licen[cs]e
etalab-2.0 0.85 => licence ouverte
cdla-permissive-2.0 0.85 => cdla permissive(?: 2 0)?
apsl-2.0 0.85 => apple public source licen[cs]e
ipl-1.0 0.85 => ibm public licen[cs]e
lppl-1.3c 0.85 => latex project public licen[cs]e
nposl-3.0 0.85 => non profit open software licen[cs]e
oldap-2.8 0.85 => oldap 2 8
rpl-1.5 0.85 => reciprocal public licen[cs]e
sgi-b-2.0 0.85 => sgi free software licen[cs]e b
tcl 0.85 => tcl tk licen[cs]e
watcom-1.0 0.85 => sybase open watcom public licen[cs]e
xfree86-1.1 0.85 => xfree86 licen[cs]e
eudatagrid 0.85 => eu datagrid software licen[cs]e
intel 0.85 => intel open source licen[cs]e
gpl-3.0 0.95 => gnu general public license version 3 29 june 2007
gpl-2.0 0.95 => gnu general public license version 2 june 1991
lgpl-2.1 0.95 => gnu lesser general public license version 2 1 february 1999
lgpl-3.0 0.95 => gnu lesser general public license version 3 29 june 2007
agpl-3.0 0.95 => gnu affero general public license version 3 19 november 2007
gpl 0.9 => the gnu general public license is a free copyleft license
gpl 0.85 => the licenses for most software are designed to take away your freedom
gpl 0.9 => this program is distributed in the hope that it will be useful but without any warranty
lgpl 0.9 => this library is free software you can redistribute it and or modify
lgpl 0.9 => this library is distributed in the hope that it will be useful
apache-2.0 0.95 => unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 0.95 => terms and conditions for use reproduction and distribution
mit 0.9 => the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit 0.85 => merchantability fitness for a particular purpose and noninfringement
isc 0.9 => provided that the above copyright notice and this permission notice appear in all copies
isc 0.85 => the author disclaims all warranties with regard to this software
bsd 0.85 => redistributions of source code must retain the above copyright notice
bsd 0.85 => redistributions in binary form must reproduce the above copyright notice
bsd-3-clause 0.95 => may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause 0.95 => all advertising materials mentioning features or use of this software must display
bsd 0.85 => this software is provided by the copyright holders and contributors as is
mpl-2.0 0.9 => if a copy of the mpl was not distributed with this file
mpl-1.1 0.9 => the contents of this file are subject to the mozilla public license
epl 0.9 => this program and the accompanying materials are made available under the terms of the eclipse
cddl-1.0 0.9 => subject to the terms of the common development and distribution license
zlib 0.9 => altered source versions must be plainly marked as such
zlib 0.9 => the origin of this software must not be misrepresented
unlicense 0.9 => anyone is free to copy modify publish use compile sell or distribute this software
wtfpl 0.9 => you just do what the fuck you want to
bsl-1.0 0.9 => solely in the form of machine executable object code generated by a source language processor
ofl-1.1 0.9 => the font software may not be sold by itself
ofl-1.1 0.9 => the goals of the open font license ofl are to stimulate worldwide development
artistic 0.85 => the intent of this document is to state the conditions under which a package may be copied
postgresql 0.9 => in no event shall the university of california be liable to any party
php-3.01 0.9 => this product includes php software
openssl 0.9 => this product includes software developed by the openssl project
apache-1.1 0.9 => this product includes software developed by the apache software foundation
beerware 0.9 => you can buy me a beer in return
vim 0.85 => there are no restrictions on distributing unmodified copies of vim
json 0.9 => the software shall be used for good not evil
cc0-1.0 0.9 => to the greatest extent permitted by but not in contravention of applicable law affirmer
cc 0.7 => some rights reserved
commercial 0.7 => proprietary and confidential
commercial 0.7 => unauthorized copying of this file via any medium is strictly prohibited
"""
#: Sentence frames in their order, with how sure a detection is; NAME is the license's name, ID its identifier.
FRAMES = (
    ("identifier", r"spdx license identifier ID(?![\w.+-])", 1.0),
    ("granted", r"(?:licensed|released|distributed|available|published|covered|provided)(?: \S{1,20}){0,3} under(?: the)?(?: terms of)?(?: the)? NAME", 0.95),
    ("named", r"(?:see|read|under|per|subject to|according to)(?: the)? NAME", 0.8),
    ("mention", r"NAME", 0.6),
)
#: Sentences of the licenses themselves, and Creative Commons marks (label with the found parts).
TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95, "hereby"),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose", 0.95, "permission to use"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", 0.9, "redistribution"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", 0.9, "compliance"),
    ("gpl", r"this program is free software you can redistribute it and or modify", 0.9, "redistribute"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public", 0.95, "mozilla"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 0.95, "unencumbered"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization", 0.9, "organization"),
    ("public-domain", r"(?:in|into|to) the public domain", 0.7, "public domain"),
    ("all-rights-reserved", r"all rights reserved", 0.5, "all rights"),
)
CC = r"(?:cc|creative commons(?: licen[cs]e)?) (by(?: (?:nc|nd|sa))*|zero)(?: (?:licen[cs]e )?(?:version |v)?([1-4]) ([05]))?"
CC_WORDS = r"creative commons attribution( noncommercial| non commercial)?( no ?deriv(?:ative|ative works|s|atives))?( share ?alike)?"
CC_LINK = r"creativecommons org licenses (by(?: (?:nc|nd|sa))*) ([1-4]) ([05])"

_WORD = ~(tb.byte_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123)])) | (np.arange(256) >= 0x80))
_PHRASE = [([tb.word_hash(w) for w in p.split()], label) for p, label in PHRASES.items()]


def _pattern(text: str) -> re.Pattern:
    """Spaces become any run of characters other than letters and digits, taken whole: no run is tried at its parts."""
    return re.compile(r"(?<![^\W_])" + text.replace(",?", "").replace(" ?", r"(?:[\W_]++)?").replace(" ", r"[\W_]++") + r"(?![^\W_])")


def _gate(keyword: str) -> str:
    """The longest word of a keyword: whatever stands between its words, this one stands whole."""
    return max(keyword.split(), key=len)


def _implied(body: str) -> str:
    """The longest piece of a word that every match of a signature has: no part of a group, of a set of letters or of what may be missing."""
    fixed = re.sub(r"\(\?:[^()]*\)\??|\[\w+\]|[\w ]\?", " ", body)
    return max(reversed(re.findall(r"\w+", fixed)), key=len)


@cache
def rules() -> list[tuple[str, str, re.Pattern, str, float]]:
    """(kind, label, pattern, own keyword, how sure), in the order of their priority."""
    rows = [x.split("|") for x in re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)|\|", lambda m: m[0].replace("|", "\0") if len(m[0]) > 1 else m[0], LICENSES.strip()).splitlines()]
    out = []
    for frame, text, sure in FRAMES:
        for label, spdx, name, keyword in rows:
            name = name.replace("\0", "|")
            body = text.replace("NAME", name).replace("ID", re.escape(spdx))
            own = "spdx" if frame == "identifier" else _gate(keyword)
            out.append((frame, label, _pattern(body), own, sure))
    out += [("text", label, _pattern(p), _gate(keyword), sure) for label, p, sure, keyword in TEXTS]
    for row in SIGNATURES.strip().splitlines():
        head, body = row.split(" => ")
        label, sure = head.split()
        out.append(("signature", label, _pattern(body), _implied(body), float(sure)))
    return out


@cache
def _keywords():
    """An automaton over the rules' keywords; each gives the numbers of its rules."""
    import ahocorasick

    found = ahocorasick.Automaton()
    by: dict[str, list[int]] = {}
    for k, rule in enumerate(rules()):
        by.setdefault(rule[3], []).append(k)
    for word, numbers in by.items():
        found.add_word(word, (word, numbers))
    found.make_automaton()
    return found


def _cc(found: re.Match) -> str:
    kind, major, minor = found.groups()
    if kind == "zero":
        return "cc0-1.0"
    parts = "-".join(re.split(r"[\W_]+", kind))
    return f"cc-{parts}-{major}.{minor}" if major else f"cc-{parts}"


def _cc_words(found: re.Match) -> str:
    return "cc-by" + "-nc" * bool(found[1]) + "-nd" * bool(found[2]) + "-sa" * bool(found[3])


_CC = ((_pattern(CC_LINK), _cc, 0.95), (_pattern(CC), _cc, 0.9), (_pattern(CC_WORDS), _cc_words, 0.85))


#: An SPDX tag, and what an expression after it is made of; within parentheses it may go on over lines and their comment marks.
_TAG = re.compile(r"(?<![^\W_])spdx[\W_]++license[\W_]++identifier[^\w(]*+")
_TOKEN = re.compile(r"[()]|[a-z0-9](?:[a-z0-9.:-]*[a-z0-9])?\+?")
_BLANK, _LINES = re.compile(r"[ \t]*+"), re.compile(r"[\s*#/;!-]*+")


@cache
def identifiers() -> dict[str, str]:
    """Label of each SPDX identifier of the table; the earliest row's."""
    out: dict[str, str] = {}
    for frame, label, pattern, _, _ in rules():
        if frame == "identifier":
            out.setdefault(re.sub(r"\\(.)", r"\1", _SPDX_ID.search(pattern.pattern)[1]), label)
    return out


_SPDX_ID = re.compile(r"identifier\[\\W_\]\+\+(.*?)\(\?!")


def _known(spdx: str) -> str | None:
    plain = spdx.removesuffix("+")
    return identifiers().get(plain) or identifiers().get(re.sub(r"-(?:only|or-later)$", "", plain))


#: Identifiers of a tag that no row has, but that are made like one: a name, a hyphen, a version.
_VERSIONED = re.compile(r"[a-z][a-z0-9]*(?:-[a-z0-9]+)*-\d+(?:\.\d+)*[a-z]?")


def _tagged(spdx: str) -> str | None:
    plain = re.sub(r"-(?:only|or-later)$", "", spdx.removesuffix("+"))
    return _known(spdx) or (plain if _VERSIONED.fullmatch(plain) else None)


def _expressions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, label) of the known licenses of all SPDX expressions; that of the first starts at its tag."""
    out = []
    for tag in _TAG.finditer(text):
        at, depth, start, joined = tag.end(), 0, tag.start(), True
        while token := _TOKEN.match(text, (_LINES if depth else _BLANK).match(text, at).end()):
            word, at = token[0], token.end()
            if word == "(" and joined:
                depth += 1
            elif word == ")" and depth and not joined:
                depth -= 1
            elif joined and word not in ("(", ")"):
                label = _tagged(word) if joined != "with" else None
                if label:
                    out.append((token.start() if start is None else start, at, label))
                start, joined = None, False
            elif not joined and word in ("and", "or", "with"):
                joined = word
            else:
                break
    return out


#: Identifiers joined by "or" and "and" on a line without a tag, at least one of them with a version or a hyphen.
_CHOICE = re.compile(r"(?<![\w.+-])[a-z0-9][a-z0-9.-]*\+?\)?(?:[ \t]++(?:or|and)[ \t]++\(?[a-z0-9][a-z0-9.-]*\+?\)?)++")


def _choices(text: str) -> list[tuple[int, int, str]]:
    """(start, end, label) of the licenses of expressions whose every operand is a known identifier."""
    out = []
    for m in _CHOICE.finditer(text):
        words = [w for w in _TOKEN.finditer(text, m.start(), m.end()) if w[0] not in ("(", ")", "or", "and")]
        if any("-" in w[0] for w in words) and all(_known(w[0]) for w in words):
            out += [(w.start(), w.end(), _known(w[0])) for w in words]
    return out


def detect(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, label, how sure) of the detections that stay, in a text with A-Z lower-cased."""
    held = dict(hit for _, hit in _keywords().iter(text))
    found = []
    for rank in sorted(k for numbers in held.values() for k in numbers):
        _, label, pattern, _, sure = rules()[rank]
        found += [(m.end() - m.start(), rank, m.start(), m.end(), label, sure) for m in pattern.finditer(text)]
    if "spdx" in text:
        found += [(end - start, -2, start, end, label, 1.0) for start, end, label in _expressions(text)]
    if " or " in text or " and " in text:
        found += [(end - start, -2, start, end, label, 0.9) for start, end, label in _choices(text)]
    if "cc" in text or "creative" in text:
        for pattern, name, sure in _CC:
            found += [(m.end() - m.start(), -1, m.start(), m.end(), name(m), sure) for m in pattern.finditer(text)]
    # by start; of one start the longest, then the earliest rule. What ends inside the longest reach so far lies inside an earlier detection.
    found.sort(key=lambda x: (x[2], -x[0], x[1]))
    out, reach = [], -1
    for _, _, start, end, label, sure in found:
        if end > reach:
            out.append((start, end, label, sure))
            reach = end
    return out


def _scan_slice(buf: np.ndarray, offs: np.ndarray) -> dict[str, list]:
    n = len(offs) - 1
    r = tb.runs(buf, offs, _WORD)
    h = tb.run_hash(buf, r, tb.LOWER)
    first, last, count, labels = np.full(n, -1), np.full(n, -1), np.zeros(n, np.int64), [set() for _ in range(n)]
    for words, label in _PHRASE:
        at = np.flatnonzero(h == np.uint64(words[0]))
        at = at[at + len(words) <= r.n]
        for k, w in enumerate(words[1:], 1):
            at = at[h[at + k] == np.uint64(w)]
        at = at[r.doc[at] == r.doc[at + len(words) - 1]] if len(at) else at
        for i in at.tolist():
            d = int(r.doc[i])
            w = i - int(r.first[d])
            count[d] += 1
            first[d] = w if first[d] < 0 else min(first[d], w)
            last[d] = max(last[d], w)
            labels[d].add(label)
    low = tb.LOWER[buf].tobytes()
    every, score, spans = [], np.zeros(n), []
    for d in range(n):
        part = low[offs[d] : offs[d + 1]]
        got = detect(part.decode())
        every.append(",".join(sorted(labels[d] | {x[2] for x in got})))
        score[d] = max([0.5 * bool(labels[d]), *(x[3] for x in got)])
        spans.append(",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in got))
    none = lambda x: [None if v < 0 else int(v) for v in x]
    return {"n_words": np.diff(r.first).tolist(), "n_base": count.tolist(), "first_word": none(first), "last_word": none(last), "base_labels": [",".join(sorted(x)) for x in labels], "labels": every, "score": score.tolist(), "spans": spans}


_COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [x.split() for x in _COLUMNS.split(", ")]
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(1)):
            got = _scan_slice(buf, offs)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *(pa.array(got[c], _TYPES[t]) for c, t in fields)], names=["doc_id", *(c for c, _ in fields)])


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every document.

    score is the surest detection's (0.5 for a base phrase alone, 0 without any); spans lists label:start:end of the
    rules' detections in code points. A null or empty text has no words and empty labels. Repeated rows are scanned each
    for itself; an empty table gives an empty one; columns other than doc_id and text are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: tb.tidy(_batches(batches)), "doc_id long, " + _COLUMNS)
